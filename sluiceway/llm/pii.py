"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import texts as tx

#: Kinds in the order in which spans of one start are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
#: Characters before and behind a span whose words count as context.
CONTEXT = 60
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
CONTEXT_WORDS = {
    "email": ("mail", "email", "contact", "contacto", "kontakt", "courriel", "correo", "write"),
    "ip": ("ip", "host", "server", "address", "adresse", "addr", "client", "login"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "telephone", "teléfono", "téléphone", "fax"),
    "iban": ("iban", "bank", "konto", "account", "compte", "cuenta", "transfer"),
    "ssn": ("ssn", "social", "security", "insured"),
}
AGAINST_WORDS = {
    "ip": ("version", "release", "section", "chapter"),
    "card": ("order", "tracking", "isbn", "serial"),
    "phone": ("score", "version"),
    "ssn": ("order", "part", "serial"),
}
RAISE, LOWER = 0.2, 0.3
#: Added kinds are reported from this score on; base spans always.
LEAST_ADDED = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The look-behind changes no match: a run of digits that fails at its start fails at every later one.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9]{4})")
_FOUR = re.compile(r" ?[A-Z0-9]{1,4}")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
# Characters of an account number by country, as registered.
_IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 "
    "FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
    "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
    "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    """Whether the last digit is Luhn's check digit of the others."""
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = int(c) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod_97(code: str) -> bool:
    """Whether an account number's check digits are right: letters as numbers, remainder 1."""
    text = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches without overlap: a match begins where the run in front of its @ does."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _iban_ends(text: str, start: int) -> list[int]:
    """Where an account number that begins at `start` may end: two to seven groups of four, then one to three characters or none."""
    ends, at = [], start + 4
    for groups in range(1, 9):
        found = _FOUR.match(text, at)
        if not found:
            break
        four, at = len(found[0].lstrip()) == 4, found.end()
        behind = text[at:at + 1]
        if (groups >= 2 + (not four)) and groups <= 7 + (not four) and not (behind.isascii() and behind.isalnum()):
            ends.append(at)
        if not four:
            break
    return ends


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers from left to right without overlap: of the country's length; of unknown countries the longest that passes."""
    found = _IBAN.search(text)
    while found:
        start, done = found.span()
        length = _IBAN_LENGTHS.get(text[start:start + 2])
        for end in reversed(_iban_ends(text, start)):
            code = text[start:end]
            if (length is None or len(code) - code.count(" ") == length) and mod_97(code):
                yield start, end
                done = end
                break
        found = _IBAN.search(text, done)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every confirmed span, by start, then kind as listed; code points."""
    text = text or ""
    found = [("email", a, b) for a, b in _emails(text)]
    if not any(c in text for c in "0123456789"):
        return found
    if "." in text:
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _small_parts(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    found += [("iban", a, b) for a, b in _ibans(text)]
    found += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def score(text: str, kind: str, start: int, end: int) -> float:
    """How sure a span is, 0 to 1: its kind's score, raised or lowered by words near it."""
    near = set(_WORD.findall((text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT]).lower()))
    value = BASE_SCORE[kind]
    value += RAISE if near.intersection(CONTEXT_WORDS[kind]) else 0
    value -= LOWER if near.intersection(AGAINST_WORDS.get(kind, ())) else 0
    return round(min(1.0, max(0.0, value)), 3)


def digest(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


_FOUND = """doc_id BIGINT, spans ARRAY<STRUCT<kind: STRING, start: BIGINT, stop: BIGINT, text: STRING, score: DOUBLE>>,
            base_sha256 STRING, joined STRING"""


def _find(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                               ("text", pa.string()), ("score", pa.float64())]))
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            lists, digests, joined = [], [], []
            for text in batch.column("text").to_pylist():
                rows = [(k, a, b, score(text, k, a, b)) for k, a, b in spans(text)]
                rows = [r for r in rows if r[0] in BASE or r[3] >= LEAST_ADDED]
                lists.append([{"kind": k, "start": a, "stop": b, "text": text[a:b], "score": s} for k, a, b, s in rows])
                digests.append(hashlib.sha256(digest([r[:3] for r in rows if r[0] in BASE]).encode()).hexdigest())
                joined.append(digest([r[:3] for r in rows]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lists, kind), pa.array(digests, pa.string()),
                 pa.array(joined, pa.string())], ["doc_id", "spans", "base_sha256", "joined"])


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, spans, base_sha256, joined) of each row of `docs(doc_id, text)`.

    A span has kind, start and stop in code points, its text and a score. Emails, addresses, card and
    phone numbers that pass their checks are always there; account numbers (mod 97) and
    security numbers are added if their score, with context, is high enough. Null and empty texts
    have none; repeated rows are searched each; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_find, _FOUND)


def pii_counts(found: DataFrame) -> DataFrame:
    """The spans of `find_pii` as counts and digests."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, "base_sha256", F.col("joined").alias("spans"))
