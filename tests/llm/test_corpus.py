"""Operators on documents against plain Python on small fixtures."""

import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import decontaminate, mixing, near_dup, texts, token_files, toxicity
from sluiceway.llm.components import components
from sluiceway.llm.pii import find_pii, luhn, mod_97, pii_counts, spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id LONG, text STRING, source STRING, kept STRING, rank INT, key STRING"


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, k):
    words = WORD.findall(small(text))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def corpus(seed=3, n=60):
    rnd = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "élan", "omega", "zeta", "eta", "theta", "iota"]
    rows = [(None, "no id at all", "a"), (None, None, None), (1, None, "a"), (2, "", "b"), (3, " \n ", "b"), (4, "one two", None),
            (5, "ONE  two", "a")]
    for i in range(10, 10 + n):
        words = [rnd.choice(vocabulary) + str(rnd.randint(0, 30)) for _ in range(rnd.choice((4, 30, 80, 400)))]
        rows.append((i, " ".join(words), rnd.choice("abc")))
        for c in range(rnd.choice((0, 0, 1, 3))):
            copy = list(words)
            for _ in range(rnd.choice((0, 1, 2))):
                copy[rnd.randrange(len(copy))] = "changed"
            rows.append((1000 + 10 * i + c, "\n".join(copy), rnd.choice("abc")))
    rows += [rows[-1], (10, rows[-1][1], "a")]      # a repeated row; an id with two texts
    return [(*r, "x", 1, None) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.mark.parametrize("piece", [texts.PIECE, 16])
def test_shingles(monkeypatch, piece):
    monkeypatch.setattr(texts, "PIECE", piece)
    rnd = random.Random(1)
    rows = [None, "", " ", "a", "A b", "é É x"] + ["".join(rnd.choice("abAé \n\t") for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    value, starts = texts.shingles(*texts.words(pa.array(rows)), 3)
    seen = {}
    for i, row in enumerate(rows):
        want = frozenset(shingle_set(row, 3))
        assert starts[i + 1] - starts[i] == len(want)
        assert seen.setdefault(tuple(value[starts[i]:starts[i + 1]]), want) == want


def test_signature_estimates_similarity():
    import numpy as np

    rnd = np.random.default_rng(5)
    for size, both in ((40, 30), (200, 100), (1000, 900)):
        gaps = []
        for _ in range(30):
            pool = rnd.integers(0, 1 << 63, 2 * size - both).astype(np.uint64)
            sets = np.concatenate([pool[:size], pool[size - both:]])
            a, b = near_dup.signatures(sets, np.array([0, size, 2 * size]))
            gaps.append((a == b).mean() - both / (2 * size - both))
        assert abs(np.mean(gaps)) < 0.03


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(300)] + [(5000, 5000)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, words, percent):
    rows = corpus()
    sets = [(r[0], shingle_set(r[1], words)) for r in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets:
        for j, t in sets:
            if None not in (i, j) and s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=str)
    got = near_dup.near_duplicates(docs, words, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = near_dup.drop_near_duplicates(docs, words, percent)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted((i for i in ids if i is not None)) == sorted({i for i in parent if i is not None and root(i) == i})
    assert ids.count(None) == 2
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_mix(spark, docs):
    import duckdb

    frame = docs.select("doc_id", "text", "source", "key", "kept").groupBy("doc_id").agg(
        *[F.max(c).alias(c) for c in ("text", "source", "key", "kept")])
    got = mixing.mix_sources(frame)
    documents = frame.toArrow()     # noqa: F841  read by the SQL below
    want = duckdb.sql(f"WITH {mixing.MIX_SQL.format(documents='documents')} SELECT doc_id, size_, source_size_, target_, copies_ FROM mix")
    plain = lambda rows: sorted(((None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:3], round(r[3], 6), r[4]) for r in rows), key=str)
    assert plain(got.select("doc_id", "size", "source_size", "target", "copies").collect()) == plain(want.fetchall())
    by_source = {}
    for r in got.collect():
        assert 0 <= r["copies"] <= 3
        x = by_source.setdefault(r["source"], [0, r["target"], r["source_size"], 0])
        x[0] += r["size"] * r["copies"]
        x[3] = max(x[3], r["size"])
    for taken, target, size, largest in by_source.values():
        assert abs(taken - target) <= largest / 2 + 1e-6
        assert target <= 3 * size + 1e-9
    assert mixing.mixed_rows(frame).columns == frame.columns
    assert mixing.mixed_rows(frame).count() == sum(r["copies"] for r in got.collect())
    assert mixing.mix_sources(frame.limit(0)).count() == 0


def test_mix_weights(spark):
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                     F.when(F.col("id") % 4 == 0, "x").otherwise("y").alias("source"),
                                     (1 + F.col("id") % 2).alias("w"))
    rows = mixing.mix_sources(frame, weight=F.col("w")).collect()
    for source in "xy":
        mine = [r for r in rows if r["source"] == source]
        assert abs(sum(3 * r["copies"] for r in mine) - mine[0]["target"]) <= 3
    taken = [sum(r["copies"] for r in rows if r["source"] == "y" and r["w"] == w) / sum(r["w"] == w and r["source"] == "y" for r in rows)
             for w in (1, 2)]
    assert taken[0] < taken[1]


def plant(rnd, words, item, edits):
    copy = list(item)
    for _ in range(edits):
        at = rnd.randrange(len(copy))
        kind = rnd.randrange(3)
        if kind == 0:
            copy[at] = "swapped"
        elif kind == 1:
            copy.insert(at, "added")
        else:
            del copy[at]
    at = rnd.randrange(len(words))
    return words[:at] + copy + words[at:]


def best_distance(item, words):
    row = [0] * (len(words) + 1)
    for k, w in enumerate(item, 1):
        new = [k]
        for j, v in enumerate(words, 1):
            new.append(min(row[j - 1] + (w != v), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_leaks(spark):
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [[rnd.choice(vocabulary) for _ in range(rnd.choice((1, 3, 8, 16, 30, 59)))] for _ in range(24)]
    rows, hits = [], set()
    for i in range(240):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice((5, 100, 400)))]
        if i % 2:
            item = items[i % len(items)]
            words = plant(rnd, words, item, rnd.randrange(int(len(item) * 0.3) + 1))
        rows.append((i, " ".join(words).replace("w1", "W1").replace(" w2 ", ", w2;\n") if i % 3 else " ".join(words), "x"))
    rows += [(900, None, "x"), (901, "", "x"), (None, rows[3][1], "x"), rows[1]]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, item_id STRING")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(50, None), (51, ""), (None, "w1 w2")], "item_id LONG, text STRING")
    for doc, text, _ in rows:
        words = re.findall(r"[0-9a-z]+", (text or "").lower())
        for k, item in enumerate(items):
            if words and best_distance(item, words) <= decontaminate.allowed_edits(len(item)):
                hits.add((doc, k, best_distance(item, words)))
    got = decontaminate.find_leaks(docs, bench)
    found = {(r["doc_id"], r["item_id"], r["edits"]) for r in got.collect()}
    assert {x[:2] for x in found} <= {x[:2] for x in hits} and found <= hits
    assert len(found) >= 0.97 * len(hits)
    exact = {x for x in hits if x[2] == 0}
    assert exact <= found
    clean = decontaminate.drop_leaks(docs, bench)
    assert clean.columns == docs.columns
    bad = {x[0] for x in found}
    assert sorted((r["doc_id"] for r in clean.collect()), key=str) == sorted((r[0] for r in rows if r[0] not in bad), key=str)
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs.limit(0), bench).count() == 0


def test_tokens(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    extra = spark.createDataFrame([(7, "it's <|endoftext|> 12 x é Σας\x1cb", "a", "x", 1, None)], SCHEMA)
    frame = docs.unionByName(extra)
    rows = sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    path = str(tmp_path / "tokens")
    token_files.write_tokens(frame, path)
    read = token_files.read_tokens(spark, path)
    ids = {}
    for r in read.collect():
        ids.setdefault(r["doc_id"], []).append(list(r["tokens"]))
    for doc, text in rows:
        assert tokenizer.encode(text or "", add_special_tokens=False).ids + [2] in ids[doc]
    table = sorted(token_files.describe_tokens(read).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in table] == [d for d, _ in rows]
    at = 0
    for r in table:
        assert r["start"] == at
        at += r["n_tokens"]
        assert any(r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in t)) for t in ids[r["doc_id"]])
    some = token_files.read_tokens(spark, path, [4, 12])
    assert sorted(r["doc_id"] for r in some.collect()) == [4, 12]
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    assert token_files.token_table(docs.limit(0)).count() == 0


def test_tokens_of_end_signs():
    from tokenizers import Tokenizer

    path = token_files.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    rnd = random.Random(3)
    fronts = ["", "(", '"', "don'", "x1", "é", "e\u0301", "İ", "日本", "²", "a\u200d", "<|endoftext|>", "foo's"]
    words = ["(foo).", '"foo",', "foo]:", "foo/.", "foo_.", "don',", '"ab8c..."###']
    words += [f + rnd.choice(["foo", "7", "É", ""]) + "".join(rnd.choice(".,!?;:%$#*&)\"]_'/|>-’") for _ in range(rnd.randint(1, 4)))
              for f in fronts for _ in range(80)]
    for _ in range(2):      # the second time from memory
        for word, ids in zip(words, token_files.encode(words, path, 2), strict=True):
            assert list(memoryview(ids).cast("I")) == tokenizer.encode(word, add_special_tokens=False).ids + [2], word
    text = " ".join(words)
    assert list(memoryview(token_files.encode([text], path, 2)[0]).cast("I")) == tokenizer.encode(text, add_special_tokens=False).ids + [2]


def test_restoring():
    import numpy as np

    words = "the idiot and the stupid fool was here with an apple and all of them".split()
    counts = np.full((28, 28, 28), 0.1)
    for w in words * 20:
        line = [0, 0, *[ord(c) - 96 for c in w], 0]
        for a, b, c in zip(line, line[1:], line[2:], strict=False):
            counts[a, b, c] += 1
    model = np.log(counts / counts.sum(axis=2, keepdims=True)).astype(np.float32)
    restore = toxicity.Restorer(model)
    for written in ("1d10t", "i d i o t", "i.d.1.0.t", "!d!0t", "IDIOT"):
        assert "idiot" in restore.words(f"the {written} was"), written
    assert restore.word("idiooooot") == "idiot" and restore.word("apple") == "apple"


def test_toxicity(spark):
    rnd = random.Random(4)
    plain = ["".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        words = [rnd.choice(plain) for _ in range(rnd.choice((10, 60)))]
        bad = i % 9 == 0
        if bad:
            words.insert(rnd.randrange(len(words)), rnd.choice(("zupidhead", "zorkface", "z0rkface", "z u p i d h e a d")))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(bad)))
    rows += [(None, None, "s"), (5000, "", "s"), rows[0]]
    labels += [(None, 1), (7, None), (7, 0)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, score STRING")
    marks = spark.createDataFrame(labels, "doc_id LONG, toxic INT")
    scored = toxicity.score_toxicity(docs, marks)
    assert scored.columns == ["doc_id", "text", "score", "score_"]
    right = sum((r["score_"] >= 0.7) == (r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] % 9 == 0) for r in scored.collect())
    assert right >= len(rows) - 4
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.filter("doc_id IS NULL OR doc_id = 5000").count() == 2
    assert toxicity.score_toxicity(docs, marks.limit(0)).select("score_").distinct().count() == 1
    assert toxicity.score_toxicity(docs.limit(0), marks).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda t: re.sub("[^0-9]", "", t)
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], ("email", "ip", "card", "phone").index(s[0])))


def test_rare_entries_are_learnt(spark):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(200)]
    rows = [(i, " ".join([*rnd.choices(words, k=12), *(["zwrbqk"] if i < 8 else [])]), int(i < 2500)) for i in range(15000)]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING, toxic INT")
    lexicon, _ = toxicity.learn_lexicon(frame, toxicity.character_model(frame))
    assert "zwrbqk" in lexicon and not set(words) & set(lexicon)


def test_pii_spans():
    rnd = random.Random(6)
    for alphabet in ("a.@b-% ", "0123456789. -+", "a1@.-+ ()é", "4242 -42"):
        for _ in range(3000):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 45)))
            assert [s for s in spans(text) if s[0] in ("email", "ip", "card", "phone")] == plain_spans(text), text
    assert luhn("4242424242424242") and not luhn("4242424242424241")
    assert mod_97("DE89 3704 0044 0532 0130 00") and not mod_97("DE89 3704 0044 0532 0130 01")


def test_ibans_before_other_words():
    for code in ("ES9121000418450200051332", "AT611904300234573201", "DE89370400440532013000", "NO9386011117947", "ES91 2100 0418 4502 0005 1332",
                 "MT84MALT011000012345MTLCAST001S", "LC55HEMM000100010012001200023015", "GB82 WEST 1234 5698 7654 32"):
        for behind in ("", ".", " BIC CAIXESBB", " BANK", " BANK 12", " I", ", NEXT", "\n"):
            text = "IBAN " + code + behind
            assert [s for s in spans(text) if s[0] == "iban"] == [("iban", 5, 5 + len(code))], text
    assert [s[1:] for s in spans("AT611904300234573201 ES9121000418450200051332 BIC") if s[0] == "iban"] == [(0, 20), (21, 45)]
    for text in ("ES9121000418450200051333 BIC", "ES9121000418450200051332X", "xES9121000418450200051332", "ES91 2100", "AT61190430023457320"):
        assert not [s for s in spans(text) if s[0] == "iban"], text


def test_pii(spark):
    rows = [(1, "é mail me: ann.b@x-y.example.com, host 10.0.0.1", "q"), (2, None, "q"), (3, "", "q"), (None, "call +44 20 7946 0958", "q"),
            (4, "my iban is DE89370400440532013000; ssn 078-05-1120 of social security", "q"), (4, "card 4242 4242 4242 4242", "q")]
    found = find_pii(spark.createDataFrame(rows, "doc_id LONG, text STRING, spans STRING"))
    got = {(r["doc_id"], r["spans"]) for r in pii_counts(found).collect()}
    assert (1, "email:11:32,ip:39:47") in got and (2, "") in got and (3, "") in got
    assert (None, "phone:5:21") in got and (4, "card:5:24") in got
    assert any(d == 4 and "iban:" in s and "ssn:" in s for d, s in got)
