"""Queries on recorded handshakes: networks, users, verdicts, PONGs, admission.

The verdict of each ping is known beforehand: keys and digests are damaged by rules on the
customer key, and the SQL states the rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.functions import packing as P
from sluiceway.operators.admission import (
    AdmissionConfig, admit, check_pings, decode_pings, effective_key, eligible_users,
    match_clients, network_rejects, parse_networks, pong_rows)
from sluiceway.plans.traffic import hex_array, table

GLOBAL_KEY = "global-key"
CLOSED = AdmissionConfig("server-1", GLOBAL_KEY, user_auth=True, allow_anonymous=False)
OPEN = AdmissionConfig("server-1", GLOBAL_KEY, user_auth=False, allow_anonymous=True)


def network_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping networks, hosts, IPv6 networks and broken specs, by nation key."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"))
    kind = F.expr("n % 5")
    return n.select(
        F.col("n").alias("ord"),
        F.when(kind == 2, F.expr("concat('10.', n % 8, '.', n * 10 % 256, '.1')")).alias("host"),
        F.when(kind == 0, F.expr("concat('10.', n % 8, '.0.0/16')"))
        .when(kind == 1, F.expr("concat('10.', n % 8, '.', n * 10 % 256, '.77/19')"))
        .when(kind == 3, F.expr("concat('2001:db8:', n, '::/48')"))
        .when(kind == 4, F.expr("concat('10.1.', n, '.0/33')")).alias("network"),
        F.expr("CASE WHEN n % 4 <> 0 THEN concat('key-', n) END").alias("shared_key"),
        F.lit(None).cast("array<string>").alias("usernames"))


def matched(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.expr("concat('10.', user_id % 8, '.', event_id % 256, '.1')").alias("remote_addr"))
    return match_clients(events, network_clients(spark, sf_dir)).select(
        "event_id", "remote_addr", "client_ord")


MATCH_SQL = """
WITH e AS (SELECT event_id, user_id % 8 AS b, event_id % 256 AS c FROM events),
m AS (
  SELECT event_id, min(n_nationkey) AS client_ord
  FROM e JOIN nation ON n_nationkey % 8 = b AND (
    n_nationkey % 5 = 0
    OR (n_nationkey % 5 = 1 AND n_nationkey * 10 % 256 // 32 = c // 32)
    OR (n_nationkey % 5 = 2 AND n_nationkey * 10 % 256 = c))
  GROUP BY event_id)
SELECT e.event_id, '10.' || b || '.' || c || '.1' AS remote_addr, client_ord
FROM e LEFT JOIN m ON m.event_id = e.event_id"""


def specs(spark, sf_dir):
    """Prefixes of all suppliers' and customers' networks, one per row."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("ord"), F.lit(None).cast("string").alias("host"),
        F.expr("concat('10.', c_custkey % 256, '.', c_nationkey, '.255/', 8 + c_custkey % 27)").alias("network"))
    parsed = parse_networks(rows.withColumns({
        "shared_key": F.lit(None).cast("string"), "usernames": F.lit(None).cast("array<string>")}))
    return parsed.select("ord", "network", "family", "plen", "prefix_bits")


SPECS_SQL = """
WITH c AS (
  SELECT CAST(c_custkey AS INTEGER) AS ord, c_custkey % 256 AS b, c_nationkey AS n,
    CAST(8 + c_custkey % 27 AS INTEGER) AS plen FROM customer)
SELECT ord, '10.' || b || '.' || n || '.255/' || plen AS network,
  CASE WHEN plen <= 32 THEN CAST(4 AS INTEGER) END AS family,
  CASE WHEN plen <= 32 THEN plen END AS plen,
  CASE WHEN plen <= 32 THEN substr(lpad(bin(167772160 + b * 65536 + n * 256 + 255), 32, '0'), 1, plen)
    END AS prefix_bits
FROM c"""


def bad_specs(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("ord"), F.lit(None).cast("string").alias("host"),
        F.expr("""concat('192.168.', c_custkey % 256, '.0',
            CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN '/xx'
                 WHEN c_custkey % 4 = 2 THEN '.9/20' ELSE '/20' END)""").alias("network"))
    return network_rejects(customers)


BAD_SPECS_SQL = """
WITH c AS (
  SELECT CAST(c_custkey AS INTEGER) AS ord, c_custkey % 4 AS k, '192.168.' || c_custkey % 256 || '.0' AS base
  FROM customer),
s AS (SELECT *, base || CASE k WHEN 0 THEN '' WHEN 1 THEN '/xx' WHEN 2 THEN '.9/20' END AS network FROM c WHERE k < 3)
SELECT ord, CAST(NULL AS VARCHAR) AS host, network,
  CASE WHEN k = 2 THEN 'not an address literal: ' || base || '.9' ELSE 'not base/length: ' || network END
    AS spec_error
FROM s"""


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One client network per nation; some have a key or a list of names of their own."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n")).select(
        F.col("n").alias("ord"), F.lit(None).cast("string").alias("host"),
        F.expr("concat('10.', n, '.0.0/16')").alias("network"),
        F.expr("CASE WHEN n % 4 <> 0 THEN concat('key-', n) END").alias("shared_key"),
        F.expr("""CASE WHEN n % 3 = 1 THEN array()
                       WHEN n % 3 = 2 THEN array(concat('user-', n), concat('user-', (n + 1) % 25),
                                                 concat('user-', (n + 5) % 25)) END""")
        .cast("array<string>").alias("usernames"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as users; several share a name, each with a password of its own."""
    return table(spark, sf_dir, "supplier").select(
        F.expr("concat('user-', s_suppkey % 25)").alias("username"),
        F.expr("concat('pw-', s_suppkey)").alias("password"))


def _ping_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = lambda *parts: F.sha2(F.concat(*[F.expr(p).cast("binary") for p in parts]), 512)
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("c"), F.col("c_nationkey").alias("n"), (F.col("c_custkey") % 75).alias("x"))
    made = base.withColumns({
        "conn_id": F.col("c"),
        "remote_addr": F.expr("""CASE WHEN c % 19 = 0 THEN '192.168.0.1'
            ELSE concat('10.', n, '.', c div 256 % 256, '.', c % 256) END"""),
        "nonce": F.expr("concat('nonce-', c)").cast("binary"),
        "user_salt": F.expr("concat('auth-', c)").cast("binary"),
        "client_hostname": F.expr("concat('host-', c)"),
        "key_salt": F.expr("concat('salt-', c)"),
        "key": F.expr(f"""CASE WHEN c % 11 = 0 THEN 'wrong'
            WHEN c % 19 = 0 OR n % 4 = 0 THEN '{GLOBAL_KEY}' ELSE concat('key-', n) END"""),
        "username": F.expr("concat('user-', x % 25)"),
        "password": F.expr("CASE WHEN c % 17 = 0 THEN 'nope' ELSE concat('pw-', x) END")})
    digest = sha("key_salt", "client_hostname", "nonce", "key")
    return made.select(
        "conn_id", "remote_addr", "nonce", "user_salt", "client_hostname", "key_salt",
        F.when(F.col("c") % 13 == 0, F.upper(digest)).otherwise(digest).alias("key_digest"),
        "username", sha("user_salt", "username", "password").alias("password_digest"))


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ping_columns(spark, sf_dir)


_VERDICT = """
c AS (
  SELECT c_custkey AS c, c_nationkey AS n, c_custkey % 75 AS x,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_nationkey END AS client_ord FROM customer),
u AS (
  SELECT *,
    client_ord IS NULL OR n % 3 <> 2 OR x % 25 IN (n, (n + 1) % 25, (n + 5) % 25) AS may_use,
    c % 17 <> 0 AND x IN (SELECT s_suppkey FROM supplier) AS right_password,
    c % 11 <> 0 AND c % 13 <> 0 AS right_key FROM c),
v AS (
  SELECT *,
    CASE WHEN client_ord IS NULL THEN 'Anonymous client disallowed.'
         WHEN NOT right_key THEN 'Shared key mismatch'
         WHEN NOT (may_use AND right_password) THEN 'username/password mismatch' END AS reason,
    CASE WHEN NOT right_key THEN 'Shared key mismatch' END AS open_reason
  FROM u)"""


def verdicts(spark, sf_dir):
    return check_pings(pings(spark, sf_dir), clients(spark, sf_dir), users(spark, sf_dir), CLOSED)


VERDICTS_SQL = f"""
WITH {_VERDICT}
SELECT c AS conn_id, client_ord, reason IS NULL AS ok, reason FROM v"""


def open_verdicts(spark, sf_dir):
    return check_pings(pings(spark, sf_dir), clients(spark, sf_dir), users(spark, sf_dir), OPEN)


OPEN_SQL = f"""
WITH {_VERDICT}
SELECT c AS conn_id, client_ord, open_reason IS NULL AS ok, open_reason AS reason FROM v"""


def keys(spark, sf_dir):
    return effective_key(clients(spark, sf_dir), GLOBAL_KEY).select("ord", "effective_key")


KEYS_SQL = f"""
SELECT n_nationkey AS ord,
  CASE WHEN n_nationkey % 4 = 0 THEN '{GLOBAL_KEY}' ELSE 'key-' || n_nationkey END AS effective_key
FROM nation"""


def known_users(spark, sf_dir):
    return eligible_users(pings(spark, sf_dir), clients(spark, sf_dir), users(spark, sf_dir))


KNOWN_USERS_SQL = f"""
WITH {_VERDICT}
SELECT c AS conn_id, client_ord, 'user-' || x % 25 AS username, count(*) AS users
FROM v JOIN supplier ON s_suppkey % 25 = x % 25 WHERE may_use GROUP BY ALL"""


def pongs(spark, sf_dir):
    """PONGs; the length of digest and message stand for bytes SQL here cannot hash."""
    sent = pings(spark, sf_dir)
    known = clients(spark, sf_dir)
    results = check_pings(sent, known, users(spark, sf_dir), CLOSED)
    return pong_rows(results, sent, known, CLOSED).select(
        "conn_id", "ok", "reason", "hostname", F.length("digest").alias("digest_chars"),
        F.octet_length("pong_bytes").alias("message_bytes"))


PONGS_SQL = f"""
WITH {_VERDICT}
SELECT c AS conn_id, reason IS NULL AS ok, coalesce(reason, '') AS reason,
  CASE WHEN reason IS NULL THEN 'server-1' ELSE '' END AS hostname,
  CAST(CASE WHEN reason IS NULL THEN 128 ELSE 0 END AS INTEGER) AS digest_chars,
  CAST(CASE WHEN reason IS NULL THEN 1 + 5 + 1 + 1 + 9 + 130
            ELSE 1 + 5 + 1 + length(reason) + 1 + 2 END AS INTEGER) AS message_bytes
FROM v"""


def _order_requests(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("conn_id"), F.col("o_orderkey").alias("frame_no"),
        F.col("o_orderstatus").alias("tag"))


def admitted(spark, sf_dir):
    results = verdicts(spark, sf_dir)
    return admit(_order_requests(spark, sf_dir), results)


ADMITTED_SQL = f"""
WITH {_VERDICT}
SELECT o_custkey AS conn_id, o_orderkey AS frame_no, o_orderstatus AS tag
FROM orders JOIN v ON c = o_custkey WHERE reason IS NULL"""


def admitted_any_verdict(spark, sf_dir):
    return admit(_order_requests(spark, sf_dir), verdicts(spark, sf_dir), strict=False)


ANY_VERDICT_SQL = """
SELECT o_custkey AS conn_id, o_orderkey AS frame_no, o_orderstatus AS tag
FROM orders JOIN customer ON c_custkey = o_custkey"""


def handshake_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Frames of customers' connections (noise, a PING, then their orders) and what the secured were greeted with.

    Every third connection is open and sends its orders only. Of the others, every fifth
    sends a nil and a number before the PING, every seventh none, and every eleventh one
    with a user name that is not text.
    """
    sent = pings(spark, sf_dir)
    name = F.when(F.col("conn_id") % 11 == 0, P.pack_int("conn_id")).otherwise(P.pack_str("username"))
    ping = F.concat(
        hex_array(6), P.pack_str(F.lit("PING")), P.pack_str("client_hostname"), P.pack_str("key_salt"),
        P.pack_str("key_digest"), name, P.pack_str("password_digest"))
    frame = lambda df, no, col: df.select(
        "conn_id", "remote_addr", F.lit(no).cast("bigint").alias("frame_no"), col.alias("frame"))
    secured = sent.where("conn_id % 3 <> 0")
    noisy = secured.where("conn_id % 5 = 0")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("conn_id"), F.lit("10.0.0.1").alias("remote_addr"),
        (F.col("o_orderkey") + 3).alias("frame_no"),
        F.concat(hex_array(3), P.pack_str("o_orderstatus"), P.pack_int(F.lit(5)),
                 P.map_header(F.lit(0))).alias("frame"))
    frames = (
        frame(noisy, 0, P.hex_bytes("C0")).unionByName(frame(noisy, 1, P.hex_bytes("05")))
        .unionByName(frame(secured.where("conn_id % 7 <> 0"), 2, ping)).unionByName(orders))
    frames = frames.select(
        "conn_id", "remote_addr", "frame_no", F.timestamp_micros(F.lit(0)).alias("recv_ts"),
        F.octet_length("frame").cast("bigint").alias("size"), "frame",
        F.lit(None).cast("string").alias("error_class"), F.lit(None).cast("string").alias("detail"))
    return frames, secured.select("conn_id", "nonce", "user_salt")


def _handshake(spark: SparkSession, sf_dir: str):
    return decode_pings(*handshake_frames(spark, sf_dir))


def decoded_pings(spark, sf_dir):
    return _handshake(spark, sf_dir).pings.select(
        "conn_id", "remote_addr", F.decode("nonce", "UTF-8").alias("nonce"), "client_hostname",
        "key_salt", F.length("key_digest").alias("digest_chars"), "username")


DECODED_SQL = """
SELECT c_custkey AS conn_id,
  CASE WHEN c_custkey % 19 = 0 THEN '192.168.0.1'
       ELSE '10.' || c_nationkey || '.' || c_custkey // 256 % 256 || '.' || c_custkey % 256 END AS remote_addr,
  'nonce-' || c_custkey AS nonce, 'host-' || c_custkey AS client_hostname,
  'salt-' || c_custkey AS key_salt, CAST(128 AS INTEGER) AS digest_chars,
  'user-' || c_custkey % 75 % 25 AS username
FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0"""

_FRAMES_SQL = """
s AS (
  SELECT c_custkey AS c, c_custkey % 3 <> 0 AS secured,
    c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AS good FROM customer),
f AS (
  SELECT c AS conn_id, unnest([0, 1]) AS frame_no FROM s WHERE secured AND c % 5 = 0
  UNION ALL SELECT c, 2 FROM s WHERE secured AND c % 7 <> 0
  UNION ALL SELECT o_custkey, o_orderkey + 3 FROM orders)"""


def rejected_pings(spark, sf_dir):
    return _handshake(spark, sf_dir).rejects.select("conn_id", "frame_no", "error_class")


BAD_PINGS_SQL = f"""
WITH {_FRAMES_SQL}
SELECT conn_id, frame_no, 'BAD_PING' AS error_class
FROM f JOIN s ON c = conn_id WHERE secured AND (NOT good OR frame_no < 2)"""


def after_handshake(spark, sf_dir):
    return _handshake(spark, sf_dir).frames.select("conn_id", "frame_no", "size")


AFTER_SQL = f"""
WITH {_FRAMES_SQL}
SELECT conn_id, frame_no, CAST(1 + 1 + length(o_orderstatus) + 1 + 1 AS BIGINT) AS size
FROM f LEFT JOIN s ON c = conn_id JOIN orders ON o_orderkey = frame_no - 3 AND o_custkey = conn_id
WHERE NOT coalesce(secured, FALSE) OR good"""


QUERIES = {
    "match_clients": (matched, MATCH_SQL),
    "parse_networks": (specs, SPECS_SQL),
    "network_rejects": (bad_specs, BAD_SPECS_SQL),
    "effective_key": (keys, KEYS_SQL),
    "eligible_users": (known_users, KNOWN_USERS_SQL),
    "check_pings": (verdicts, VERDICTS_SQL),
    "check_pings_open": (open_verdicts, OPEN_SQL),
    "pong_rows": (pongs, PONGS_SQL),
    "admit": (admitted, ADMITTED_SQL),
    "admit_any_verdict": (admitted_any_verdict, ANY_VERDICT_SQL),
    "decode_pings": (decoded_pings, DECODED_SQL),
    "bad_pings": (rejected_pings, BAD_PINGS_SQL),
    "frames_after_ping": (after_handshake, AFTER_SQL),
}
