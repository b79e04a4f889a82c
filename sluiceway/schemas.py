"""Table shapes shared by the operators (DDL strings, in column order)."""

SEGMENTS = (
    "conn_id BIGINT, remote_addr STRING, seq BIGINT, recv_ts TIMESTAMP, payload BINARY"
)

# A framing fault is a row of the same table with `error_class` set.
FRAMES = (
    "conn_id BIGINT, remote_addr STRING, frame_no BIGINT, recv_ts TIMESTAMP, "
    "size BIGINT, frame BINARY, error_class STRING, detail STRING"
)

ENTRY = (
    "time_sec BIGINT, time_nanos INT, event_ts TIMESTAMP, record STRING, record_raw BINARY"
)

DECODED = (
    "conn_id BIGINT, remote_addr STRING, frame_no BIGINT, recv_ts TIMESTAMP, kind STRING, "
    f"mode STRING, tag STRING, entries ARRAY<STRUCT<{ENTRY}>>, chunk STRING, "
    "compressed STRING, error_class STRING, detail STRING, frame BINARY"
)

REQUESTS = (
    "conn_id BIGINT, remote_addr STRING, frame_no BIGINT, recv_ts TIMESTAMP, mode STRING, "
    f"tag STRING, entries ARRAY<STRUCT<{ENTRY}>>, chunk STRING, compressed STRING"
)

EVENTS = (
    "conn_id BIGINT, frame_no BIGINT, pos INT, tag STRING, time_sec BIGINT, time_nanos INT, "
    "event_ts TIMESTAMP, record STRING, record_raw BINARY, chunk STRING"
)

REJECTS = (
    "conn_id BIGINT, frame_no BIGINT, recv_ts TIMESTAMP, error_class STRING, detail STRING, "
    "frame BINARY"
)

CLIENTS = (
    "ord INT, host STRING, network STRING, shared_key STRING, usernames ARRAY<STRING>"
)
USERS = "username STRING, password STRING"

# One row per secured connection: what the server had sent in its greeting.
HANDSHAKES = "conn_id BIGINT, nonce BINARY, user_salt BINARY"

PINGS = (
    "conn_id BIGINT, remote_addr STRING, nonce BINARY, user_salt BINARY, "
    "client_hostname STRING, key_salt STRING, key_digest STRING, username STRING, "
    "password_digest STRING"
)
