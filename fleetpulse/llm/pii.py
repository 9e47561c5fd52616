"""Personal data (operator 1): fixed patterns, and a conditional random field that adds to them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm import crf
from fleetpulse.llm.arrowtext import steps, text_bytes

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match begins where a run of digits begins: from inside the run it would have failed alike
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")

# The small labelled table: {kind:span} marks personal data, all else is outside.
LABELLED = """
please write to {email:ann.lee@mail.example.org} before noon
contact {email:bob_77@mx1.example.com}, or the desk on the left
{email:the.office@example.net} is the address of the house
send it to <{email:r.k.moss@post.example.org}> and wait
her new address: {email:jane-doe.12@web.example.co.uk}.
und schreib an {email:karl.heinz@post.example.de} bis morgen
escribe a {email:maria_lopez@correo.example.es} por favor
mail {email:x.99@mail8.example.com} and {email:y.11@mail7.example.com} today
user {email:no.reply+list@lists.example.org} left the list
the host {ip:192.0.2.17} did not answer
ping {ip:198.51.100.4} and {ip:203.0.113.250} again
traffic from {ip:10.0.0.8} to {ip:172.16.254.1}, then nothing
server at {ip:152.143.123.131} was down
die adresse {ip:192.168.1.20} ist frei
blocked {ip:8.8.4.4} at the gate
call {phone:+1 (743) 555-3824} after six
tel {phone:+1 (523) 555-1055}, ask for the clerk
my number is {phone:+44 20 7946 0958} in the city
reach us at {phone:+49 30 901820} or by letter
appelez le {phone:+33 1 70 18 99 00} avant midi
ring {phone:(212) 555-0187} or {phone:(310) 555-0142} now
phone {phone:555-867-5309} is the old one
fax {phone:1-800-555-0199} at any hour
call me on {phone:0044 20 7946 0123} please
telefon {phone:030-901820-44} im amt
number {phone:212-555-0176} was changed
pay with {card:4111 1111 1111 1111} at the door
card {card:4785380592391139} was used twice
the card {card:5500-0000-0000-0004} has ended
visa {card:4012888888881881}, name on the back
charge {card:3782 822463 10005} for the room
karte {card:4716 3821 0039 4451} ist neu
{card:6011000990139424} and {card:4222222222222} are cards
in the year 1998 there were 4512 units of it
the price rose from 12.50 to 13.75 within 3 days
version 1.2.3 of the tool, build 20240131
at 12:30 on 2021-07-04 the train left
see page 214 and chapters 3, 4 and 5
about 3.14159 or 22/7 by the book
population 1,250,000 in 2010, 1,310,000 in 2020
the code 24be64439e3e49cf46b2d7c90f3602a3d0b907ff was shown
token = "9f86d081884c7d659a2feaa0c55ad015"
area of 640 acres, 2 roads and 1 well
sections 4.1.2 and 4.1.3 were cut
score 3-2 after 90 minutes, 21000 came
order 100234 shipped in 2 boxes of 12
temperatures of -12.5 and +30 degrees
de la calle 14 al numero 27 hay 500 metros
im jahr 1871 waren es 41058792 leute
the room 101, row 7, seat 33
isbn 978 0 13 468599 1 of the book
10 20 30 40 50 60 70 80 90 100
the### of$$$ and%%% it*** was&&& here.%%% Then,$$$ on***
# the $$ and %% of *** it &amp; <b> | ~ ^ \\ so?
Here. There, Then; Where? What! "Quoted," (said) he: 'so'.
UPPER CASE LINES, TOO. AND MIXED-CASE WORDS; e.g. this one
| cell | in | a | table | of, | words. |
THE!! END!! OF!! ALL!! THINGS!!
a plain line of words without any number in it
there is nothing of that sort to be found here
und das ist ein satz ohne zahlen darin
il n'y a rien de tout cela dans cette phrase
no hay nada de eso en esta frase larga
thtion onere ingea; thereat, (and the) "others" said: so be it.
""".strip().splitlines()

_MARK = re.compile(r"\{(\w+):([^}]*)\}")
_EDGE = re.compile(r"^[^\w+(]+|[^\w)]+$")


@cache
def model() -> crf.Model:
    """The field, trained on the labelled table; the same weights wherever it is trained."""
    values, labels = [], []
    for line in LABELLED:
        plain, spans, last = "", [], 0
        for mark in _MARK.finditer(line):
            plain += line[last:mark.start()]
            spans.append((len(plain), len(plain) + len(mark[2]), 1 + KINDS.index(mark[1])))
            plain, last = plain + mark[2], mark.end()
        plain += line[last:]
        data, offsets = text_bytes(pa.array([plain]))
        starts, ends, _, found = crf.features(data, offsets)
        at = np.zeros(len(starts), dtype="int64")
        for begin, end, kind in spans:  # the table is ASCII: bytes are characters
            at[(starts < end) & (ends > begin)] = kind
        values.append(found)
        labels.append(at)
    return crf.train(values, labels, 1 + len(KINDS))


def _luhn(digits: str) -> bool:
    ones = [int(d) for d in reversed(digits)]
    return (sum(ones[::2]) + sum(sum(divmod(2 * d, 10)) for d in ones[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @: the run of local characters before it, the domain after."""
    last = 0
    while (at := text.find("@", last)) >= 0:
        begin = last + len(text[last:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        last = domain.end() if domain else at + 1


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns' matches, by start, then in the order of KINDS."""
    found = [(begin, 0, end) for begin, end in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(begin, KINDS[kind], end) for begin, kind, end in sorted(found)]


def _plausible(kind: str, span: str) -> bool:
    """Whether what the field marked can be of that kind at all."""
    digits = sum(c.isdigit() for c in span)
    if kind == "email":
        return "@" in span[1:-1]
    if kind == "ip":
        return span.count(".") == 3 and digits >= 4
    return (12 <= digits <= 19) if kind == "card" else (7 <= digits <= 15)


def annotate(texts: pa.Array, field: crf.Model) -> list[tuple[list, list]]:
    """For every text its base spans and the spans that the field adds, each (start, kind, end).

    The field decodes whole texts. A run of words with the same label is a span, without the signs
    around it; it is added if it is plausible for its kind and overlaps no base span.
    """
    data, offsets = text_bytes(texts)
    starts, ends, bounds, values = crf.features(data, offsets)
    labels = crf.viterbi(field, values, bounds)
    marked = np.flatnonzero(labels)
    signs = np.zeros(len(data) + 1, dtype="int64")
    np.cumsum((data == 64) | ((data >= 48) & (data <= 57)), out=signs[1:])
    has_sign = signs[offsets[1:]] > signs[offsets[:-1]]
    rows = np.searchsorted(offsets, starts[marked], side="right") - 1
    out: list[tuple[list, list]] = [([], [])] * len(texts)
    of_row = np.searchsorted(rows, np.arange(len(texts) + 1))
    for row in np.flatnonzero(has_sign | (np.diff(of_row) > 0)):
        raw = data[offsets[row]:offsets[row + 1]].tobytes()
        text = raw.decode("utf-8", "replace")
        base = base_spans(text)
        added, group = [], []
        words = marked[of_row[row]:of_row[row + 1]]
        for w in [*words, None]:
            if group and (w is None or w != group[-1] + 1 or labels[w] != labels[group[0]]):
                begin = len(raw[:starts[group[0]] - offsets[row]].decode("utf-8", "replace"))
                span = raw[starts[group[0]] - offsets[row]:ends[group[-1]] - offsets[row]].decode(
                    "utf-8", "replace")
                lead = _EDGE.match(span)
                begin += lead.end() if lead and lead.start() == 0 else 0
                span = _EDGE.sub("", span)
                kind, end = KINDS[labels[group[0]] - 1], begin + len(span)
                if _plausible(kind, span) and not any(b < end and begin < e for b, _, e in base):
                    added.append((begin, kind, end))
                group = []
            if w is not None:
                group.append(w)
        out[row] = (base, added)
    return out


def _digest(spans: list) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, kind, end in spans)


def _merged(base: list, added: list) -> list:
    return sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[1])))


FOUND = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "spans string, n_added long")


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts and digest of the base spans, all spans as text.

    Null and empty texts have no spans. Rows are independent, so repeated rows get equal results;
    other columns are not read.
    """
    field = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = annotate(batch.column(1), field)
            counts = [pa.array([sum(s[1] == kind for s in base) for base, _ in found],
                               type=pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), *counts,
                pa.array([hashlib.sha256(_digest(base).encode()).hexdigest() for base, _ in found]),
                pa.array([_digest(_merged(*both)) for both in found]),
                pa.array([len(added) for _, added in found], type=pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.select(F.col(f"`{id_column}`").alias("doc_id"),
                       F.col(f"`{text_column}`").alias("text")).mapInArrow(run, FOUND)


def masked(text: str, spans: list) -> str:
    """``text`` with every span, or run of overlapping spans, replaced by its first kind's name."""
    parts, last = [], 0
    for begin, kind, end in spans:
        if begin >= last:
            parts += [text[last:begin], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*parts, text[last:]])


def redact(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in its text, and its length column, if any, made true.

    All rows and all other columns stay as they are; null texts stay null.
    """
    field, names = model(), docs.columns
    text, length = names.index(text_column), (
        names.index(length_column) if length_column in names else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text_column):
            columns = list(batch.columns)
            texts = columns[text]
            values = {}
            for row, (base, added) in enumerate(annotate(texts, field)):
                if base or added:
                    values[row] = masked(texts[row].as_py(), _merged(base, added))
            if values:
                changed = pa.array([values.get(i) for i in range(len(texts))], type=texts.type)
                columns[text] = pa.compute.coalesce(changed, texts)
                if length is not None:
                    sizes = pa.array([len(values[i]) if i in values else None
                                      for i in range(len(texts))], type=columns[length].type)
                    columns[length] = pa.compute.coalesce(sizes, columns[length])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
