"""Personal data: fixed patterns against plain regular expressions, decoding against plain Viterbi."""

import re

import numpy as np
import odd
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm import crf, pii
from fleetpulse.llm.arrowtext import text_bytes

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    found = []
    for place, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
                       for i, d in enumerate(reversed(digits))]
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip"
                else False, "card": 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                    "phone": 9 <= len(digits) <= 15}[kind]:
                found.append((m.start(), place, kind, m.end()))
    return [(b, k, e) for b, _, k, e in sorted(found)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab01249@.+-() %_é\n", max_size=60))
def test_fixed_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_fixed_patterns_on_documents(spark, sf_dir):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = pii.annotate(pa.array(texts), pii.model())
    assert [base for base, _ in found] == [plain_spans(t) for t in texts]


def test_many_signs_take_no_time():
    for text in ("9" * 200_000, "a" * 300_000, "1." * 100_000, "+1 " * 50_000, "@" * 100_000):
        pii.base_spans(text)


def test_labelled_table_is_learned():
    for line in pii.LABELLED:
        plain = pii._MARK.sub(lambda m: m[2], line)
        base, added = pii.annotate(pa.array([plain]), pii.model())[0]
        got = [(kind, plain[b:e]) for b, kind, e in pii._merged(base, added)]
        assert got == [(m[1], m[2]) for m in pii._MARK.finditer(line)]


def test_unseen_forms():
    text = "é call (415) 555-0199 or pay 4556 1234 8765 0981 to the clerk in 1999 for 35 days"
    base, added = pii.annotate(pa.array([text]), pii.model())[0]
    assert {(k, text[b:e]) for b, k, e in [*base, *added]} >= {("phone", "(415) 555-0199")}
    assert not any("1999" in text[b:e] or "35" == text[b:e] for b, _, e in [*base, *added])


def plain_viterbi(model, values, bounds):
    out, scores = np.zeros(len(values), dtype=int), model.scores(values)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if a == b:
            continue
        best, back = scores[a], []
        for t in range(a + 1, b):
            moves = best[:, None] + model.steps
            back.append(moves.argmax(axis=0))
            best = moves.max(axis=0) + scores[t]
        state = int(best.argmax())
        out[b - 1] = state
        for t in range(b - 1, a, -1):
            state = back[t - a - 1][state]
            out[t - 1] = state
    return out


def test_decoding_is_whole(spark, sf_dir):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["", "1", "+1 (743) 555-3824 and 555 0134 and 1 2 3", "4111 1111 1111 1111 x 10.0.0.1 y"]
    data, offsets = text_bytes(pa.array(texts))
    _, _, bounds, values = crf.features(data, offsets)
    model = pii.model()
    rng = np.random.default_rng(2)
    for steps in (model.steps, rng.normal(0, 2, model.steps.shape)):
        other = crf.Model(model.tables, steps)
        assert (crf.viterbi(other, values, bounds) == plain_viterbi(other, values, bounds)).all()


def test_redacted(spark):
    out = {r.doc_id: r for r in pii.redact(odd.odd_documents(spark)).collect()}
    assert out[10].text == "write to [EMAIL] or [PHONE] from [IP]"
    assert out[10].n_chars == len(out[10].text)
    assert out[4].text is None and out[1].text == odd.PLAIN and out[1].n_chars == 1
