"""Pages that no author would write: time, teasers, and runs that repeat, against a plain search."""

import random
import time

import pytest

from sluiceway.llm.html_text import RUN, blocks, extract_text

HOSTILE = {
    "tags without end": "<a " * 340_000,
    "end in quotes": "<a " * 330_000 + '">"',
    "quotes without end": '<a "' * 250_000,
    "deep and stray": "<div>" * 100_000 + "</x>" * 120_000,
    "inline below rules": "<p><div>" + "<b>" * 100_000 + "<hr>" * 100_000,
    "declarations": "<!" * 500_000,
    "sections": "<![CDATA[" * 110_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_grows_with_length(name):
    page = HOSTILE[name]
    took = []
    for part in (page[:len(page) // 4], page):
        start = time.process_time()
        blocks(part)
        took.append(time.process_time() - start)
    assert took[1] < 12 and took[1] < 10 * took[0] + 0.5, took


def test_tags():
    assert blocks('<p>a <b title="x>y">b</b> 3 < 4 <i c') == [("a b 3 < 4 <i c", False, False)]
    assert blocks("<p>a</p><!-- <p>b</p> --><![CDATA[c]]><p>d") == [("a", False, False), ("d", False, False)]
    assert blocks("<div><p>a<ul><li>b<li>c</ul></x></div>e") == [(t, False, False) for t in "abce"]
    assert blocks("") == blocks(None) == []


def _text(spark, pages):
    frame = spark.createDataFrame(pages, "page_id LONG, url STRING, html STRING")
    return {r["page_id"]: r["text"] for r in extract_text(frame).collect()}


def test_teaser_hides_no_body(spark):
    lead = "<p>the lead of a long report on rivers and boats</p>"
    got = _text(spark, [
        (1, "http://a.com/1", lead + "<article>t1</article><p>the rest of the report</p>"),
        (2, "http://a.com/2", "<p>by A. N.</p><article><p>an article longer than the line beside it</p></article>"),
    ])
    assert got[1] == "the lead of a long report on rivers and boats\nt1\nthe rest of the report"
    assert got[2] == "an article longer than the line beside it"


def test_text_of_the_host_beside_an_article_makes_it_no_teaser(spark):
    links = "<div>all the boats of this house are looked after by two men who live near the old harbour wall</div>"
    got = _text(spark, [
        (i, f"http://a.com/{i}", f"{links}<article><p>{text}</p></article><div>by {name}</div>")
        for i, text, name in ((1, "a boat was lost", "A. N."), (2, "a boat was found", "B. O."))
    ] + [(3, "http://b.com/3", f"{links}<article><p>a boat</p></article>")])
    assert got[1] == "a boat was lost" and got[2] == "a boat was found"
    assert got[3].endswith("old harbour wall\na boat")     # no other page of its host has the text


def test_repeated_runs_against_plain_search(spark):
    rng = random.Random(7)
    word = lambda: "w%d" % rng.randrange(10_000)
    shared = [" ".join(word() for _ in range(n)) for n in (7, 8, 9, 30)]
    pages = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(1, 20))) for _ in range(4)]
        parts += rng.sample(shared, rng.randint(0, 3))
        rng.shuffle(parts)
        pages.append((i, f"http://h{i % 3}.com/{i}", "".join(f"<p>{p}</p>" for p in parts)))
    got = _text(spark, pages)

    split = {i: [b[0].split() for b in blocks(page)] for i, _, page in pages}
    runs: dict = {}
    for i, found in split.items():
        flat = [w for b in found for w in b]
        for k in range(len(flat) - RUN + 1):
            runs.setdefault((i % 3, tuple(flat[k:k + RUN])), set()).add(i)
    for i, found in split.items():
        flat = [w for b in found for w in b]
        covered = {k + j for k in range(len(flat) - RUN + 1) if len(runs[i % 3, tuple(flat[k:k + RUN])]) > 1
                   for j in range(RUN)}
        at, own = 0, []
        for b in found:
            left = [w for k, w in enumerate(b) if at + k not in covered]
            at += len(b)
            if left:
                own.append(" ".join(left))
        assert got[i] == ("\n".join(own) or "\n".join(" ".join(b) for b in found)), i
