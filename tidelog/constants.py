"""Fixed values of the log format. They must stay as they are for existing logs to be readable."""

# Reserved header names.
PRODUCE_TIMESTAMP_HEADER = "psc.produce.timestamp"
KEY_SIZE_HEADER = "psc.message.key.size.bytes"
VALUE_SIZE_HEADER = "psc.message.value.size.bytes"
SYSTEM_HEADER_PREFIX = "psc."

# Metadata keys a table may declare.
SYSTEM_HEADERS_KEY = "psc-headers"
METADATA_KEYS = ["topic-uri", "partition", "headers", SYSTEM_HEADERS_KEY, "offset", "timestamp"]

# Message tags.
PAYLOAD_CORRUPTED = "PAYLOAD_CORRUPTED"
KEY_DESERIALIZATION_FAILED = "KEY_DESERIALIZATION_FAILED"
VALUE_DESERIALIZATION_FAILED = "VALUE_DESERIALIZATION_FAILED"
HEADER_TIMESTAMP_NOT_FOUND = "HEADER_TIMESTAMP_NOT_FOUND"
HEADER_TIMESTAMP_CORRUPTED = "HEADER_TIMESTAMP_CORRUPTED"
KEY_SIZE_MISMATCH = "KEY_SIZE_MISMATCH_WITH_KEY_SIZE_HEADER"
VALUE_SIZE_MISMATCH = "VALUE_SIZE_MISMATCH_WITH_VALUE_SIZE_HEADER"

# Topic names: <protocol>:/<standard>:<service>:<environment>:<cloud_region>:<classifier>:<cluster>:<topic>
DEFAULT_PROTOCOL = "plaintext"
RN_STANDARD = "rn"
URI_PATTERN = r"^(([a-zA-Z0-9_.-]+):/)?([a-zA-Z0-9_.:-]+)$"
RN_PATTERN = (
    r"^[a-zA-Z0-9_.-]+:[a-zA-Z0-9_.-]+:[a-zA-Z0-9_.-]+:[a-zA-Z0-9.-]+_[a-zA-Z0-9.-]+"
    r":[a-zA-Z0-9_.-]*:[a-zA-Z0-9_.-]+:([a-zA-Z0-9_.-]+)?$"
)

# Composite offset: batch offset above, message offset in the low bits.
MESSAGE_OFFSET_BITS = 19
MESSAGE_OFFSET_MASK = (1 << 19) - 1

# Lowest rate a single task may be limited to, records per second (exclusive).
MIN_TASK_RATE = 0.1

# Row kinds of a changelog.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"

# Columns of a topic log.
LOG_COLUMNS = ["topic_uri", "partition", "offset", "timestamp", "key", "value", "headers"]
LOG_DDL = (
    "topic_uri STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, "
    "key BINARY, value BINARY, headers MAP<STRING, BINARY>"
)
