"""Archives, repaired conversations and spelling variants against plain Python."""

import gzip
import hashlib
import heapq
import io
import itertools
import random
import re
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import repair, spelling, warc


# --- spelling -----------------------------------------------------------------------------------------------------

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        out[w] = (best if best and counts[best] >= 2 * n else None, n, len(near))
    rows = []
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, near, counts[form] if form else None))
    return sorted(rows)


def test_variants_against_all_pairs(spark):
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.choice((4, 5, 5, 6, 7, 8, 9)))) for _ in range(500)}
    words |= {w[:3] + w[4:] for w in list(words)[:200]} | {"aaaaa", "aaaaaa", "aaaaaaa", "ÿ" * 60, "ÿ" * 59 + "a"}
    counts = {w: rnd.choice((3, 4, 6, 7, 12, 30)) for w in words if len(w) >= 5}
    frame = spark.createDataFrame(list(counts.items()), "word STRING, n LONG")
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.group_variants(frame).collect()]
    assert sorted(got) == plain_variants(counts)
    pairs = spelling.near_words(frame).collect()
    assert len(pairs) == len({(r["word"], r["near"]) for r in pairs}) == sum(one_edit(a, b) for a in counts for b in counts)


def test_words_of_odd_texts(spark):
    long = "Wörter " * 40_000 + "x" * 30_000
    rows = [(1, "Hello hello HELLO", 9), (2, None, 1), (3, "", 2), (None, "hello helo1hello", 3), (4, long, 4), (4, long, 4), (5, "ÀÉßén Ääbcd ÷×÷×÷", 5)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, Run LONG").withColumn("word", F.lit("n")).withColumn("h", F.lit(1))
    want = {}
    for doc, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 3 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] = want.get(run, 0) + 1
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert {r["word"]: r["n"] for r in spelling.count_words(spelling.misspelt(spelling.runs(docs), 3)).collect()} == want
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    again = spelling.spelling_variants(docs.repartition(13), 3)
    assert sorted(map(tuple, again.collect())) == plain_variants(want)


# --- conversations ------------------------------------------------------------------------------------------------

def plain_ways(codes, enter):
    """All states with the least (cost, audit), by plain relaxation over rows."""
    def closed(at):
        for _ in range(4):
            for s, (cost, audit) in list(at.items()):
                for to, more, letter in repair._inserts(s):
                    at[to] = min(at.get(to, (10 ** 9, "")), (cost + more, audit + letter))
        return at

    at = closed({enter: (0, "")})
    for code in codes:
        after = {}
        for s, (cost, audit) in at.items():
            for to, more, letter in repair._steps(code, s):
                after[to] = min(after.get(to, (10 ** 9, "")), (cost + more, audit + letter))
        at = closed(after)
    return at


def test_search_against_plain_relaxation():
    rnd = random.Random(5)
    some = ["".join(t) for n in range(3) for t in itertools.product("sSuUaAoOx", repeat=n)]
    some += ["".join(rnd.choices("sSuUaAoOx", [1, 1, 6, 1, 6, 1, 1, 1, 2], k=rnd.randint(3, 40))) for _ in range(150)]
    for codes in some:
        for enter in range(4):
            ways = plain_ways(codes, enter)
            for leave in range(4):
                assert repair.search(codes, enter, leave) == ways.get(leave), (codes, enter, leave)


def test_every_audit_of_short_conversations():
    """Nothing cheaper or smaller among all edit strings, tried one by one."""
    for codes in ["".join(t) for n in range(4) for t in itertools.product("sUaox", repeat=n)]:
        heap, found = [(0, "", 0, repair.START)], None
        while heap and (found is None or heap[0][0] <= found[0]):
            cost, audit, row, state = heapq.heappop(heap)
            if row == len(codes) and state in (repair.START, repair.ASSISTANT):
                found = min(found or (cost, audit), (cost, audit))
            if len(audit) < len(codes) + 4:
                for to, more, letter in repair._inserts(state):
                    heapq.heappush(heap, (cost + more, audit + letter, row, to))
                if row < len(codes):
                    for to, more, letter in repair._steps(codes[row], state):
                        heapq.heappush(heap, (cost + more, audit + letter, row + 1, to))
        ways = [w for w in (repair.search(codes, repair.START, x) for x in (repair.START, repair.ASSISTANT)) if w]
        assert min(ways) == found, codes


def plain_repair(rows):
    """The contract's result by plain Python."""
    blank = lambda t: not re.search(r"[^\x20\x09-\x0D]", t)
    held = {}
    for conv, turn, role, text in rows:
        held.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            held[conv] += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, turns in held.items():
        turns.sort()
        numbers = [t[1] for t in turns if t[0]]
        seen, codes, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in turns:
            first = repair.initial_of(role)
            fault = "blank" if blank(text) else "duplicate" if (role, text) in seen else \
                "truncated" if text.rstrip(repair.WHITE)[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            codes += first if fault is None else first.upper() if fault == "truncated" else "x"
        initials = [t[2][:1] for t in turns]
        ways = plain_ways(codes, repair.START)
        cost, audit = min(ways[x] for x in (repair.START, repair.ASSISTANT) if x in ways)
        lines, rest, state = [], iter(turns), repair.START
        for edit in audit:
            role, text = (None, "") if edit == "I" else next(rest)[2:]
            if edit == "D":
                continue
            said = role[:1] if edit == "K" else repair._NEXT[state]
            lines.append(f"{role if edit == 'K' else repair._NAMES[said]}:{text}")
            state = repair._SAID[state][said]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *counts.values(),
                     sum(a + b not in repair.PAIRS for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def odd_turns():
    rnd = random.Random(9)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher"]
    texts = ["Yes.", "No!\n", "Why? ", "cut", " \t\r\n", "", None, "ends.\x0b", "é…", "Same.", "x." * 50_000, "... "]
    rows = [(c, t, rnd.choice(roles), rnd.choice(texts)) for c in range(60) for t in range(rnd.randint(1, 12)) if rnd.random() < 0.9]
    rows += [(None, t, "user", "Hi.") for t in range(5)] + [(61, None, r, "Hm.") for r in roles]
    rows += [(62, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(700)] + [(63, t, "user", "Again.") for t in range(40)] + rows[:9]
    return rows + [(c, t, "user", "Gone.") for c in range(100, 400) for t in [next(t for t in range(1000) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)]][:5]


@pytest.mark.parametrize("bits, partitions", [(8, 8), (1, 3), (3, 31)])
def test_repair_against_plain_python(spark, monkeypatch, bits, partitions):
    monkeypatch.setattr(repair, "STRETCH_BITS", bits)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = odd_turns()
        frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id LONG, turn LONG, role STRING, text STRING, row INT, Kind STRING")
        names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
        got = {r["conv_id"]: tuple(r[n] for n in names) for r in repair.repair_table(frame.repartition(partitions)).collect()}
        assert got == plain_repair(rows)
        assert repair.repair_table(frame.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Yes."), (1, 2, "user", "Go."), (1, 3, "user", "On."), (1, 4, "assistant", "Done.")]
    found = repair.repair_conversations(spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING"))
    kept = [(r["role"], r["text"]) for r in found.rows.orderBy("row", "place").collect()]
    assert kept in ([("system", "Be brief."), ("user", "Yes."), ("assistant", "Go."), ("user", "On."), ("assistant", "Done.")],)
    assert found.summary.select("cost", "audit").first() == (2, "KRRKK")


# --- archives -----------------------------------------------------------------------------------------------------

def pages():
    rnd = random.Random(2)
    texts = ["<p>é " + "".join(rnd.choice("abcdef ") for _ in range(rnd.choice((10, 900, 1000, 5000)))) for _ in range(60)]
    rows = [(i, f"http://h/{i % 7}", texts[i % 60] if i % 3 else texts[0] + "z" * 1000) for i in range(200)]
    rows += [(500, None, None), (501, "http://a b\r\nX: y", ""), (None, "http://n", texts[0] + "z" * 1000), (None, None, "small"),
             (502, "u", "y" * 999), (503, "u", "y" * 999), (504, "u", "y" * 1000), (505, "u", "y" * 1000), (506, "u", "é" * 3_000_000),
             (-5, "neg", "y" * 1000), (507, "a", "w" * 2000), (507, "b", "w" * 2000), (507, "b", "w" * 2000)]
    return rows


def plain_records(rows):
    data = [((i is not None, i or 0, u is not None, u or ""), i, (h or "").encode()) for i, u, h in rows]
    last = {}
    for key, i, payload in data:
        if len(payload) >= 1000:
            last[payload] = max(last.get(payload, (key, i)), (key, i))
    out, used = [], set()
    for key, i, payload in data:
        first = payload not in last or last[payload][0] == key and payload not in used
        used |= {payload} if payload in last and first else set()
        out.append((str(i), len(payload), hashlib.sha1(payload).hexdigest(), "response" if first else "revisit", str(None if first else last[payload][1])))
    return sorted(out)


def test_archives(spark, tmp_path):
    rows = pages()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id LONG, url STRING, html STRING, Wide STRING")
    archives = []
    for k, (parts, roll) in enumerate([(1, 4000), (17, 4000), (5, 1 << 28)]):
        archive = warc.write_warc(frame.repartition(parts), str(tmp_path / f"a{k}"), shard_bytes=60_000, roll_bytes=roll)
        found = sorted(tuple(r) for r in archive.manifest.collect())
        assert {f[0] for f in found} == {p.name for p in (tmp_path / f"a{k}").glob("*.gz")} and not (tmp_path / f"a{k}/pending").exists()
        assert all(hashlib.sha256((tmp_path / f"a{k}" / f[0]).read_bytes()).hexdigest() == f[-1] for f in found)
        assert all(f[4] <= roll or f[3] == 1 for f in found)
        archives.append((archive, found))
    assert archives[0][1] == archives[1][1]
    assert len(archives[0][1]) > len(archives[2][1]) > 3
    records = warc.read_warc(spark, archives[0][0]).cache()
    # Members come in the order of the table; the payload, headers and digests are those of the page.
    at = [(r["page_id"] is not None, r["page_id"] or 0) for r in records.orderBy("file", "position").collect()]
    assert at == sorted(at)
    assert records.filter("NOT intact").count() == 0
    assert {(str(r["page_id"]), bytes(r["payload"])) for r in records.collect() if r["payload"] is not None} \
        <= {(str(i), (h or "").encode()) for i, _, h in rows}
    for archive, _ in archives:
        told = [(str(r[0]), r[1], r[2], r[3], str(r[4])) for r in warc.resolved(warc.read_warc(spark, archive)).collect()]
        assert sorted(told) == plain_records(rows)
    records.unpersist()


def test_plain_reader_reads_the_files(spark, tmp_path):
    archive = warc.write_warc(spark.createDataFrame([(7, "http://h/", "<p>hi")], "page_id LONG, url STRING, html STRING"), str(tmp_path / "a"))
    (path,) = Path(archive.folder).glob("*.gz")
    text = gzip.decompress(path.read_bytes())
    assert text.count(b"WARC/1.1\r\n") == 2 and b"WARC-Type: warcinfo\r\n" in text
    assert text.endswith(b"\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 5\r\n\r\n<p>hi\r\n\r\n")


def test_broken_files(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id LONG, url STRING, html STRING")
    archive = warc.write_warc(empty, str(tmp_path / "none"))
    assert archive.manifest.count() == 0 == warc.resolved(warc.read_warc(spark, archive)).count()
    member = warc._record([("WARC-Type", "response")], b"x" * 5000)
    assert [p for p, _ in warc.members(io.BytesIO(member * 3), 7)] == [0, len(member), 2 * len(member)]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(member[:-9])))
    with pytest.raises(ValueError):
        warc.parse_record(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")
    with pytest.raises(ValueError):
        warc.parse_record(b"HTTP/1.1 200\r\n\r\n")
    # A published file is not published twice, and a rename that was cut short is made up for.
    (tmp_path / "p/pending").mkdir(parents=True)
    (tmp_path / "p/pending/f.1").write_bytes(b"data")
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"name": ["f"], "pending": ["f.1"]})
    for _ in range(2):
        assert list(warc._publish([batch], str(tmp_path / "p"))) == [batch]
    assert (tmp_path / "p/f").read_bytes() == b"data"
    with pytest.raises(OSError):
        list(warc._publish([pa.RecordBatch.from_pydict({"name": ["g"], "pending": ["g.1"]})], str(tmp_path / "p")))
