"""Record layouts of the messages and tables the jobs read.

Epoch seconds are doubles: a 32-bit float steps by 128 s at today's epoch values.
"""

from pyspark.sql.types import StructType


def layout(fields: str) -> StructType:
    """``name type`` pairs, separated by commas; needs no running session."""
    out = StructType()
    for pair in fields.split(","):
        name, kind = pair.split()
        out = out.add(name, kind)
    return out


# Field names and their order must equal those of the producers.
WORKFLOW_MESSAGE = layout(
    """
    workflow_id string, workflow_type string, workflow_name string, category string, device string,
    device_num integer, user string, data_source string, upload_ttl double, bag_nums integer,
    workflow_input string, workflow_output string, log string, workflow_status string, priority integer,
    tag string, hook string, create_time string, update_time string, batch_id_id string,
    tos_id string, metric string
    """
)

BAG_MESSAGE = layout(
    """
    result_id string, pod_id string, job_id string, type string, node_name string,
    cluster_name string, status string, pod_start_timestamp double, playback_start_timestamp double,
    playback_end_timestamp double, device string, device_num integer, priority integer, group string,
    error_type string, error_details string, error_stage string, log string, data_source string,
    input_bag string, output_bag string, metric string, release string, coredump string,
    backtrace string, final_attempt boolean, config string
    """
)

JOB_MESSAGE = layout(
    "node_name string, job_status string, job_name string, timestamp string"
)

NODE_MESSAGE = layout(
    """
    cluster_name string, node_name string, msg string, msg_level string, fault_type string,
    timestamp double
    """
)

POD_MESSAGE = layout(
    """
    pod_id string, status string, job_start_timestamp double, job_finish_timestamp double,
    device string, group string, reason string, log string
    """
)

RESULT_TABLE = layout(
    """
    id string, input_md5 string, output_md5 string, log string, metric string,
    create_time timestamp_ntz, update_time timestamp_ntz, workflow_id_id string,
    error_details string, error_stage string, error_type string
    """
)

WORKFLOW_TABLE = layout(
    """
    workflow_id string, workflow_type string, workflow_name string, user string,
    workflow_input string, workflow_output string, log string, workflow_status string, priority integer,
    tag string, create_time timestamp_ntz, update_time timestamp_ntz, batch_id_id string,
    hook string, device string, tos_id string, device_num integer, data_source string, category string,
    upload_ttl double, bag_nums integer, metric string
    """
)

STATISTICS_TABLE = layout("name string, period string, stat_date string, info string")
