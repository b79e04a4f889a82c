"""Neighbours, pages, licenses and transcripts against plain Python on small fixtures."""

import random
import re

import numpy as np
import pytest

from sluiceway.llm import ann, html_text, licenses, transcripts


def vectors(n=3000, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((12, 24))
    rows = centres[rnd.integers(0, 12, n)] + 0.7 * rnd.standard_normal((n, 24))
    rows[1::7] = rows[0]        # one vector in a seventh of all rows
    return [(i, [float(np.float32(x)) for x in v], "label") for i, v in enumerate(rows)]


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 1000)
    rows = vectors()
    bad = [(9000, None, "x"), (9020, [0.0] * 24, "x"), (9040, [float("nan")] * 24, "x"), (9060, [float("inf")] + [1.0] * 23, "x"),
           (9080, [None] + [1.0] * 23, "x"), (None, rows[3][1], "x"), rows[40], (9100, [1.0, 2.0], "x"), (9120, [2.0, 1.0], "x")]
    frame = spark.createDataFrame(rows + bad, "vec_id LONG, embedding ARRAY<FLOAT>, rank STRING")
    found = ann.nearest(frame, frame.filter("vec_id % 20 = 0"))
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i, _, _ in rows if i % 20 == 0} | {9100, 9120}
    assert sorted(x[1] for x in got[9100]) == [9120]
    matrix = np.array([v for _, v, _ in rows], dtype=np.float64)
    hit = total = 0
    for q in range(0, len(rows), 20):
        score = (matrix * matrix[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(rows)), -score)) if i != q][:20]
        mine = sorted(got[q])
        assert [x[0] for x in mine] == list(range(1, 21))
        assert all(abs(s - score[i]) < 1e-9 for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit += len(set(order) & {x[1] for x in mine})
        total += 20
    assert hit >= 0.9 * total
    few = spark.createDataFrame(rows[:5], "vec_id LONG, embedding ARRAY<FLOAT>, label STRING")
    assert ann.nearest(few, few.filter("vec_id = 0")).count() == 4
    assert ann.nearest(few.limit(0), few).count() == 0 == ann.nearest(few, few.limit(0)).count()


PAGES = [
    ("<html><head><title>T</title></head><body><nav><ul><li>Home<li>About</ul></nav><div class='ad big'>Buy</div>"
     "<article><h1>One &amp; two</h1><p><b>First\n line.<br><p>Second&nbsp;&#233; <i>line</i>.</p><aside>See also</aside>"
     "<div id=comments><p>me too</div><form><p>name</form><script>var a='</p>';</script><ul><li>x<li>y</ul></article>"
     "<footer>&copy; us</footer>", "One & two\nFirst line.\nSecond é line.\nx\ny"),
    ("<main role=main><p>a < b and 3 > 2</p><!-- no <p>text</p> --><style>p{}</style></main>", "a < b and 3 > 2"),
    ("<article><p>cut off <b>here", "cut off here"),
    ("<body><div class=cookie-notice>We use</div><p>Plain page</p><div hidden>no</div></body>", "Plain page"),
    ("<p title='a > b'>quoted</p>", "quoted"),
    ("just words", "just words"), ("", ""), (None, ""), ("<p> \n </p>", ""),
]


def test_pages(spark):
    shared = "our shop sells many fine things to people all over the world every day"
    rows = [(i, f"http://h{i}.example.com/x", page, "n") for i, (page, _) in enumerate(PAGES)]
    for k in range(6):
        rows.append((100 + k, "https://site.example.org/%d" % k,
                     f"<body><div><p>{shared}</p></div><p>Number{k} says word{k} this way</p></body>", "n"))
    rows += [(200, None, f"<p>{shared}</p>", "n"), rows[-1], (None, None, "<p>no id</p>", "n")]
    frame = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, text STRING")
    found = [tuple(r) for r in html_text.extract_text(frame).collect()]
    got = {r[0]: r[2] for r in found}
    assert len(found) == len(rows)
    for i, (_, want) in enumerate(PAGES):
        assert got[i] == want, (i, got[i])
    for k in range(6):
        assert got[100 + k] == f"Number{k} says word{k} this way"
    assert got[200] == shared and got[None] == "no id"      # alone on its host; repeated rows are one page
    assert all(r[3] == len(r[2]) for r in found)
    assert html_text.extract_text(frame.limit(0)).count() == 0


def test_suffix_array():
    rnd = random.Random(3)
    words = np.array([rnd.randrange(3) for _ in range(200)], dtype=np.uint64)
    for length in (1, 2, 5, 8):
        order, rank = html_text.suffix_array(words, length)
        keys = [tuple(words[i:i + length]) for i in range(200)]
        assert [keys[i] for i in order] == sorted(keys)
        assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(0, 200, 7) for j in range(200))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def base_places(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    found = [(i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i:i + len(p)] == p]
    return words, sorted(found)


def test_licenses(spark):
    rnd = random.Random(8)
    pieces = ["MIT", "License", "license", "mit", "apache", "General", "public", "\n", " ", " ", " ", "-", "é", "x", "\x80", "İ", "😀", "licenses", "7"]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))), "b") for i in range(1500)]
    texts = {
        5000: ("Released under the MIT License. All rights reserved.", "all-rights-reserved,mit", 0.9),
        5001: ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0", 0.95),
        5002: ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause", 1.0),
        5003: ("the GNU Lesser General Public License v2.1 or the Mozilla Public License 2.0", "gpl,lgpl-2.1,mpl-2.0", 0.7),
        5004: ("nothing here", "", 0.0), 5005: (None, "", 0.0), 5006: ("", "", 0.0),
        5007: ("an mit/license note", "mit", 0.5),
    }
    rows += [(k, t, "b") for k, (t, _, _) in texts.items()] + [(None, "mit license", "b"), rows[0]]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING, labels STRING")
    got = [tuple(r) for r in licenses.license_table(frame).collect()]
    assert len(got) == len(rows)
    source = {r[0]: r[1] for r in rows}
    for doc, n_words, n_base, first, last, base, labels, score in got:
        words, found = base_places(source[doc])
        assert (n_words, n_base) == (len(words), len(found)), source[doc]
        assert (first, last) == ((found[0][0], found[-1][0]) if found else (None, None)), source[doc]
        assert base == ",".join(sorted({x for _, x in found}))
        if doc in texts:
            assert (labels, score) == texts[doc][1:], doc
    assert len(licenses.rules()) > 200
    assert licenses.license_table(frame.limit(0)).count() == 0


def sampled(pattern, rnd):
    """A text that the pattern matches, in small letters and ASCII."""
    from re import _parser

    spaces = (" ", "\n", "\t ", "  ")

    def part(op, arg):
        op = str(op)
        if op == "LITERAL":
            return chr(arg)
        if op == "IN":
            kind, value = rnd.choice(arg)
            return {"CATEGORY_SPACE": rnd.choice(spaces), "CATEGORY_DIGIT": "1", "CATEGORY_WORD": "it"}[str(value)] if str(kind) == "CATEGORY" \
                else chr(rnd.randint(*value)) if str(kind) == "RANGE" else chr(value)
        if op == "BRANCH":
            return all_of(rnd.choice(arg[1]))
        if op == "SUBPATTERN":
            return all_of(arg[-1])
        if op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            return "".join(all_of(inner) for _ in range(rnd.randint(low, min(high, low + 2))))
        return ""       # places without width

    def all_of(parts):
        return "".join(part(*x) for x in parts)

    return all_of(_parser.parse(pattern))


def test_every_license_rule_by_its_own_words(spark):
    rnd = random.Random(2)
    rows = [(len(licenses.rules()) * n + i, sampled(rule[2], rnd), rule[0]) for n in range(5) for i, rule in enumerate(licenses.rules())]
    plain = [("Released under CC-BY-SA 4.0", "cc-by-sa"), ("GPLv3", "gpl-abbreviated"), ("WTFPL", "wtfpl"), ("under 3-clause BSD", "bsd-3-clause"),
             ("provided without warranty of any kind", "warranty-disclaimer"), ("Proprietary and confidential", "proprietary"),
             ("the GNU General\nPublic License", "gpl"), ("licenced under CC0", "cc0-1.0"),
             ("Creative Commons Attribution Non-Commercial 4.0", "cc-by-nc"), ("Creative\nCommons Attribution-Share-Alike", "cc-by-sa")]
    rows += [(-1 - i, text, label) for i, (text, label) in enumerate(plain)]
    got = {r["doc_id"]: r for r in licenses.license_table(spark.createDataFrame(rows, "doc_id LONG, text STRING, rule STRING")).collect()}
    missed = [(text, label, got[i]["labels"]) for i, text, label in rows if label not in got[i]["labels"].split(",")]
    assert not missed, missed[:20]
    assert all(got[i]["score"] > 0 for i, _, _ in rows)


def test_long_text_of_licenses(spark):
    text = " ".join(["word"] * 60_000 + ["MIT License."] * 200)
    row = licenses.license_table(spark.createDataFrame([(1, text)], "doc_id LONG, text STRING")).first()
    assert (row["n_base"], row["first_word"], row["last_word"]) == (200, 60_000, 60_398) and row["labels"] == "mit"


def conversations():
    rnd = random.Random(5)
    rows = []
    for conv in range(80):
        role = "system" if conv % 4 == 0 else "user"
        for turn in range(rnd.randint(2, 9) if conv else 400):
            text = "\n".join(" ".join(rnd.choice(["alpha", "note: beta", "gamma", "delta?"]) for _ in range(rnd.randint(1, 12)))
                             for _ in range(rnd.randint(1, 3)))
            rows.append((conv, turn, role, text, "z"))
            role = "assistant" if role == "user" else "user"
    return rows


@pytest.mark.parametrize("stretch", [4096, 7])
def test_transcripts(spark, monkeypatch, stretch):
    monkeypatch.setattr(transcripts, "_STRETCH", stretch)
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING, conv STRING")
    raw = transcripts.raw_transcripts(frame)
    model = transcripts.learn(raw)
    parsed = transcripts.parse_transcripts(raw.drop("role"), model)
    turns = {(int(r["conv"]), r["turn"]): r for r in transcripts.render_turns(parsed).collect()}
    assert len(turns) == len(rows)
    right = sum(turns[c, t]["role"] == role for c, t, role, _, _ in rows)
    assert right >= 0.97 * len(rows)
    exact = sum(turns[c, t]["rendered"] == f"<|{role}|>\n{text}\n<|end|>" for c, t, role, text, _ in rows)
    assert exact >= 0.95 * len(rows)
    # The stretches give the one best path of a whole conversation.
    lines = {}
    for r in parsed.collect():
        lines.setdefault(r["conv"], []).append((r["stretch"], r["place"], r["text"], r["role"]))
    for r in raw.collect():
        pass
    for conv, mine in list(lines.items())[:10]:
        mine.sort()
        marks, blank, n = [], False, 0
        for row in sorted((r for r in raw.filter(f"conv_id = {conv}").collect()), key=lambda r: r["turn"]):
            for line in row["text"].split("\n"):
                if not line.strip():
                    blank = True
                    continue
                marks.append(transcripts.features(line, blank))
                blank, n = False, n + 1
        emitted = model.scores(np.array(marks))
        score, back = model.start + emitted[0], []
        for line in emitted[1:]:
            total = score[:, None] + model.move
            back.append(total.argmax(axis=0))
            score = total.max(axis=0) + line
        state = int(score.argmax())
        path = [state]
        for step in reversed(back):
            state = int(step[state])
            path.append(state)
        assert [transcripts.ROLES[s // 2] for s in reversed(path)] == [m[3] for m in mine]


def test_odd_transcripts(spark):
    frame = spark.createDataFrame([(None, None, "User: hi\n\nBot: yes"), (1, 0, None), (1, 1, ""), (2, 0, "hello"), (2, 0, "hello")],
                                  "conv_id LONG, turn LONG, text STRING")
    labelled = spark.createDataFrame([(1, 0, "user", "User: a"), (1, 1, "assistant", "Bot: b"), (1, 2, None, "x")],
                                     "conv_id LONG, turn LONG, role STRING, text STRING")
    model = transcripts.learn(labelled)
    rows = transcripts.parse_transcripts(frame, model).collect()
    assert len(rows) == 4
    assert [r["role"] for r in sorted((r for r in rows if r["conv"] is None), key=lambda r: r["line"])] == ["user", "assistant"]
    assert transcripts.render_turns(transcripts.parse_transcripts(frame.limit(0), model)).count() == 0


@pytest.mark.parametrize("stretch", [4096, 3])
def test_turns_of_transcripts_in_one_row(spark, monkeypatch, stretch):
    monkeypatch.setattr(transcripts, "_STRETCH", stretch)
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING, conv STRING")
    raw = transcripts.raw_transcripts(frame)
    model = transcripts.learn(raw)
    whole = {}
    for r in sorted(raw.collect(), key=lambda r: r["turn"]):
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["text"] + "\n"
    whole[900] = "User: hi\n\nBot: yes"
    one = spark.createDataFrame([(c, 0, t) for c, t in whole.items()], "conv_id LONG, turn LONG, text STRING")
    turns = {(int(r["conv"]), r["turn"]): r["rendered"] for r in
             transcripts.render_turns(transcripts.parse_transcripts(one.repartition(5), model)).collect()}
    assert turns[900, 0] == "<|user|>\nhi\n<|end|>" and turns[900, 1] == "<|assistant|>\nyes\n<|end|>"
    assert len(turns) == len(rows) + 2
    assert sum(turns[c, t] == f"<|{role}|>\n{text}\n<|end|>" for c, t, role, text, _ in rows) >= 0.95 * len(rows)
