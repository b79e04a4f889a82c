"""Which connections may send: recorded handshakes checked in bulk."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway import schemas
from sluiceway.functions.networks import BITS_DDL, SPEC_DDL, address_bits, client_specs
from sluiceway.functions.packing import hex_bytes, pack_str
from sluiceway.functions.pings import PARSED_DDL, parse_pings
from sluiceway.operators.joins import spread_join
from sluiceway.session import shared_folder


@dataclass(frozen=True)
class AdmissionConfig:
    self_hostname: str
    shared_key: str | None = None
    user_auth: bool = False
    allow_anonymous: bool = True


# The reasons a PONG gives.
ANONYMOUS = "Anonymous client disallowed."
KEY_MISMATCH = "Shared key mismatch"
USER_MISMATCH = "username/password mismatch"
NO_KEY = "No shared key configured."

#: Names with more passwords are tried with those in use first; so many pings of a name tell which these are.
FEW = 64
#: Passwords of a name that lie in one row.
PIECE = 1024
#: Digests that one task makes, up to so many tasks, and what a name's pings are dealt over.
TASK_PAIRS = 1 << 22
MOST_TASKS = 1 << 12
PARTS = 16


def sha512_hex(*parts) -> Column:
    """Lower-case hex SHA-512 of the parts joined as bytes."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 512)


def parse_networks(clients: DataFrame) -> DataFrame:
    """Clients with the network they stand for, or `spec_error`.

    A host is a network of full length and takes the place of the client's network.
    """
    # Declared nondeterministic so that filters on the result do not run it a second time.
    spec = F.pandas_udf(client_specs, SPEC_DDL).asNondeterministic()
    return (
        clients.withColumn("_spec", spec("host", "network"))
        .select(*clients.columns, "_spec.family", "_spec.plen", "_spec.prefix_bits", "_spec.spec_error"))


def network_rejects(clients: DataFrame) -> DataFrame:
    return parse_networks(clients).where("spec_error IS NOT NULL").select(
        "ord", "host", "network", "spec_error")


def match_clients(df: DataFrame, clients: DataFrame, addr_col: str = "remote_addr",
                  spread_by: list[str] | None = None) -> DataFrame:
    """Add `client_ord`: the first client in list order whose host or network fits.

    Containment becomes an equi-join on (family, prefix length, prefix): each distinct
    address is tried once per prefix length in use, at most 33 + 129 of them.
    """
    networks = parse_networks(clients).where("spec_error IS NULL").groupBy(
        "family", "plen", "prefix_bits").agg(F.min("ord").alias("ord"))
    lengths = networks.select("family", "plen").distinct()
    bits = F.pandas_udf(address_bits, BITS_DDL).asNondeterministic()    # once per distinct address
    addresses = (
        df.select(F.col(addr_col).alias("_addr")).where("_addr IS NOT NULL").distinct()
        .withColumn("_bits", bits("_addr"))
        .select("_addr", "_bits.family", "_bits.bits").where("family IS NOT NULL"))
    tried = addresses.join(F.broadcast(lengths), "family").select(
        "_addr", "family", "plen", F.expr("substring(bits, 1, plen)").alias("prefix_bits"))
    found = tried.join(networks, ["family", "plen", "prefix_bits"]).groupBy("_addr").agg(
        F.min("ord").alias("client_ord"))
    spread = spread_by or [c for c in ("conn_id", "frame_no") if c in df.columns] or df.columns
    return spread_join(df.withColumn("_addr", F.col(addr_col)), found, "_addr", "left", spread).drop("_addr")


def effective_key(clients: DataFrame, global_key: str | None) -> DataFrame:
    """Each client's own key, or else the global one."""
    return clients.withColumn(
        "effective_key", F.coalesce("shared_key", F.lit(global_key).cast("string")))


def _with_client(pings: DataFrame, clients: DataFrame, cfg: AdmissionConfig) -> DataFrame:
    """Pings with `client_ord`, the key that counts and the names the client may use."""
    keyed = effective_key(clients, cfg.shared_key).select(
        F.col("ord").alias("client_ord"), F.col("effective_key").alias("key"), "usernames")
    joined = spread_join(
        match_clients(pings, clients), keyed, "client_ord", "left", ["conn_id"])
    return joined.withColumn("key", F.when(
        F.col("client_ord").isNull(), F.lit(cfg.shared_key).cast("string")).otherwise(F.col("key")))


def _may_use(usernames: str, name: str) -> Column:
    return (
        F.col(usernames).isNull() | (F.size(usernames) == 0)
        | F.array_contains(usernames, F.col(name)))


def eligible_users(pings: DataFrame, clients: DataFrame, users: DataFrame,
                   cfg: AdmissionConfig | None = None) -> DataFrame:
    """How many users of the ping's name there are, if the matched client may use the name.

    One row per ping and name: users of one name differ in their password only, which
    does not leave this module, so pairs would say no more than the count.
    """
    named = users.groupBy("username").agg(F.count("*").alias("users"))
    with_client = _with_client(pings, clients, cfg or AdmissionConfig(""))
    return spread_join(
        with_client.where(_may_use("usernames", "username")), named, "username", "inner", ["conn_id"]
    ).select("conn_id", "client_ord", "username", "users")


def _stored(rows: DataFrame) -> DataFrame:
    path = f"{shared_folder(rows.sparkSession)}-pings"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _password_digest(password: Column) -> Column:
    return sha512_hex(F.col("user_salt"), F.col("username"), password)


def _fits_one(passwords: str) -> Column:
    """Whether the digest fits one of the passwords; ends at the first that does."""
    return F.coalesce(
        F.exists(passwords, lambda p: _password_digest(p) == F.col("password_digest")), F.lit(False))


def _in_use(tried: DataFrame, known: DataFrame) -> DataFrame:
    """(username, passwords): those that the pings of a sample fit, for names with more than FEW of them.

    A name's passwords go in parts, so that the digests of few names are made by many tasks.
    """
    sample = tried.groupBy("username", F.pmod(F.xxhash64("conn_id"), F.lit(FEW)).alias("_part")).agg(
        F.min_by(F.struct("user_salt", "password_digest"), "conn_id").alias("p")).groupBy("username").agg(
        F.collect_list("p").alias("tries"))
    tasks = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["username", "_part"]
    each = known.withColumn("_part", F.pmod(F.xxhash64("password"), F.lit(PARTS)).cast("int")).repartition(tasks, *keys)
    copies = sample.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).repartition(tasks, *keys)
    fits = F.exists("tries", lambda p: sha512_hex(
        p["user_salt"], F.col("username"), F.col("password")) == p["password_digest"])
    return each.join(copies.hint("merge"), keys).where(fits).groupBy("username").agg(
        F.collect_set("password").alias("passwords"))


def _fitting_rest(left: DataFrame, known: DataFrame, pairs: int) -> DataFrame:
    """The pings in ``left`` that fit any password of their name, each with all of its passwords.

    Passwords go in pieces and pings in parts, so that the work of a name, pings times passwords, is
    dealt over as many tasks as it fills.
    """
    counts = known.groupBy("username").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("_pieces"))
    pieces = spread_join(known, counts, "username", "inner", ["password"]).groupBy(
        "username", F.pmod(F.xxhash64("password"), F.col("_pieces")).alias("_piece")).agg(
        F.collect_list("password").alias("passwords"))
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-pairs // TASK_PAIRS), MOST_TASKS))
    keys = ["username", "_piece", "_part"]
    parts = pieces.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).repartition(tasks, *keys)
    each = spread_join(left, counts, "username", "inner", ["conn_id"]).select(
        *left.columns, F.pmod(F.xxhash64("conn_id"), F.lit(PARTS)).cast("int").alias("_part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces").cast("bigint") - 1)).alias("_piece"))
    return each.repartition(tasks, *keys).join(parts.hint("merge"), keys).where(
        _fits_one("passwords")).select(*left.columns).distinct()


def check_pings(pings: DataFrame, clients: DataFrame, users: DataFrame,
                cfg: AdmissionConfig) -> DataFrame:
    """Verdict and reason for each recorded PING; no key or password leaves this function.

    Each PING is salted on its own, so a name's passwords have to be tried one by one. Names with
    more than FEW passwords are tried with those first that a sample of their pings fit, then with
    all; so only pings that fit none of the former cost as many digests as their name has passwords.
    """
    digest = sha512_hex(F.col("key_salt"), F.col("client_hostname"), F.col("nonce"), F.col("key"))
    reason = F.lit(None).cast("string")
    if cfg.user_auth:
        reason = F.lit(USER_MISMATCH)
    reason = (
        F.when(F.col("client_ord").isNull() & F.lit(not cfg.allow_anonymous), F.lit(ANONYMOUS))
        .when(F.col("key").isNull(), F.lit(NO_KEY))
        .when(~F.coalesce(digest == F.col("key_digest"), F.lit(False)), F.lit(KEY_MISMATCH))
        .otherwise(reason))
    judged = _with_client(pings, clients, cfg).withColumn("reason", reason)
    columns = ["conn_id", "client_ord", F.col("reason").isNull().alias("ok"), "reason"]
    if not cfg.user_auth:
        return judged.select(*columns)

    known = users.select("username", "password").where(
        "username IS NOT NULL AND password IS NOT NULL").distinct()
    sizes = known.groupBy("username").agg(F.count("*").alias("_size"))
    small = sizes.where(F.col("_size") <= FEW).select("username")
    many = sizes.where(F.col("_size") > FEW)
    open_ = F.coalesce((F.col("reason") == USER_MISMATCH) & _may_use("usernames", "username"), F.lit(False))
    judged = judged.select(
        "conn_id", "client_ord", "reason", "username", "user_salt", "password_digest", open_.alias("_open"))
    whole = known.join(small, "username", "left_semi").groupBy("username").agg(
        F.collect_list("password").alias("passwords"))
    settle = lambda rows, passwords: spread_join(rows, passwords, "username", "left", ["conn_id"]).withColumn(
        "reason", F.when(~(F.col("_open") & _fits_one("passwords")), F.col("reason"))).drop("passwords")
    if many.isEmpty():
        return settle(judged, whole).select(*columns)

    judged = _stored(judged)
    names = many.select("username")
    known = known.join(names, "username", "left_semi")
    wanted = judged.where("_open").join(names, "username", "left_semi")
    judged = _stored(settle(judged, whole.unionByName(_in_use(wanted, known))))
    left = judged.where("_open AND reason IS NOT NULL").select(
        "username", "conn_id", "user_salt", "password_digest").join(many, "username")
    pairs = left.agg(F.sum("_size")).first()[0] or 0
    found = _fitting_rest(left.drop("_size"), known, pairs)
    fits = found.select([F.col(c).alias(f"_{c}") for c in found.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in found.columns]
    return judged.join(fits, same, "left").withColumn(
        "reason", F.when(F.col("_username").isNull(), F.col("reason"))).select(*columns)


class Handshake(NamedTuple):
    pings: DataFrame
    rejects: DataFrame
    frames: DataFrame       # what follows the handshake, or all of an open connection


def _starts_like_ping() -> Column:
    """Arrays of six whose first element is PING, in every encoding MessagePack allows."""
    # The headers of an array of six and of a text of four bytes.
    head = "^(96|DC0006|DD00000006)(A4|D904|DA0004|DB00000004)" + b"PING".hex().upper()
    return F.hex(F.substring("frame", 1, 14)).rlike(head)


def first_pings(frames: DataFrame, handshakes: DataFrame) -> DataFrame:
    """The earliest PING of each secured connection, well-formed or not, with what it was greeted with.

    `p` holds its fields; `p.ok` is false where one of them is not text. Only frames that start
    like a PING are parsed; narrow partial aggregate.
    """
    good = frames.where("error_class IS NULL") if "error_class" in frames.columns else frames
    candidates = good.where(_starts_like_ping()).select("conn_id", "remote_addr", "frame_no", "frame")
    parsed = candidates.mapInArrow(parse_pings, PARSED_DDL)
    return (
        parsed.groupBy("conn_id").agg(F.min_by(
            F.struct(*[c for c in parsed.columns if c != "conn_id"]), "frame_no").alias("p"))
        .join(handshakes.select("conn_id", "nonce", "user_salt"), "conn_id"))


def pings_of(first: DataFrame) -> DataFrame:
    """The well-formed ones of `first_pings` as `check_pings` takes them."""
    return first.where("p.ok").select(
        "conn_id", "p.remote_addr", "nonce", "user_salt", "p.client_hostname", "p.key_salt",
        "p.key_digest", "p.username", "p.password_digest")


def bad_pings(frames: DataFrame) -> DataFrame:
    return frames.select(
        "conn_id", "frame_no", "recv_ts", F.lit("BAD_PING").alias("error_class"),
        F.lit("not a valid PING").alias("detail"), "frame")


def decode_pings(frames: DataFrame, handshakes: DataFrame) -> Handshake:
    """Split secured connections into their PING and what comes after it.

    The PING is the first frame of the connection that is one; frames before it are
    rejected as `BAD_PING`. A PING with a field that is not text ends the connection: it
    gets no PING and everything after it is rejected with it. ``handshakes`` lists the
    secured connections and what each was greeted with.
    """
    secured = handshakes.select("conn_id")
    first = first_pings(frames, handshakes)
    turn = secured.join(first.select(
        "conn_id", F.when(F.col("p.ok"), F.col("p.frame_no")).alias("ping_no")), "conn_id", "left")
    marked = spread_join(
        frames, turn.withColumn("_secured", F.lit(True)), "conn_id", "left", ["conn_id", "frame_no"])
    open_ = F.col("_secured").isNull()
    before = F.col("ping_no").isNull() | (F.col("frame_no") < F.col("ping_no"))
    fault = F.col("error_class").isNotNull() if "error_class" in frames.columns else F.lit(False)
    rest = marked.where(
        open_ | fault | (F.col("frame_no") > F.col("ping_no"))).select(*frames.columns)
    return Handshake(pings_of(first), bad_pings(marked.where(~open_ & before & ~fault)), rest)


def pong_rows(ping_results: DataFrame, pings: DataFrame, clients: DataFrame,
              cfg: AdmissionConfig) -> DataFrame:
    """PONG fields for each verdict, and the message as bytes; the key is looked up again."""
    keyed = effective_key(clients, cfg.shared_key).select(
        F.col("ord").alias("client_ord"), F.col("effective_key").alias("key"))
    rows = spread_join(
        ping_results.join(pings.select("conn_id", "key_salt", "nonce"), "conn_id"),
        keyed, "client_ord", "left", ["conn_id"])
    key = F.when(F.col("client_ord").isNull(), F.lit(cfg.shared_key).cast("string")).otherwise(F.col("key"))
    own = F.lit(cfg.self_hostname)
    fields = rows.select(
        "conn_id", "ok", F.coalesce("reason", F.lit("")).alias("reason"),
        F.when(F.col("ok"), own).otherwise("").alias("hostname"),
        F.when(F.col("ok"), sha512_hex(F.col("key_salt"), own, F.col("nonce"), key))
        .otherwise("").alias("digest"))
    # An array of five, the message name, true or false.
    return fields.withColumn("pong_bytes", F.concat(
        hex_bytes("95"), pack_str(F.lit("PONG")),
        F.when(F.col("ok"), hex_bytes("C3")).otherwise(hex_bytes("C2")),
        pack_str("reason"), pack_str("hostname"), pack_str("digest")))


def admit(requests: DataFrame, ping_results: DataFrame, strict: bool = True) -> DataFrame:
    """Requests of connections with an accepted ping; ``strict=False`` takes any verdict."""
    accepted = ping_results.where("ok") if strict else ping_results
    return spread_join(
        requests, accepted.select("conn_id").distinct(), "conn_id", "left_semi",
        ["conn_id", "frame_no"])
