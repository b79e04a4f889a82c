"""Large groups of near copies against brute force: drifting chains, and copies that are near their origin only."""

import random

import pytest

from sluiceway.llm import near_dup


def groups(seed: int, chain: int, star: int):
    """Texts that each differ in a word from the last one; copies of a text, with some to many edits each."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randint(0, 10 ** 9)}"
    texts, now = [], [word() for _ in range(60)]
    for _ in range(chain):
        texts.append(list(now))
        now[rnd.randrange(len(now))] = word()
    for origin in ([word() for _ in range(90)] for _ in range(2)):
        edits = [[(rnd.randrange(90), word()) for _ in range(3)] for _ in range(8)]     # some edits are made by several copies
        for _ in range(star):
            copy = list(origin)
            for _ in range(rnd.randint(2, 8)):
                copy[rnd.randrange(90)] = word()
            for at, new in rnd.choice(edits) if rnd.random() < 0.3 else []:
                copy[at] = new
            texts.append(copy)
    rnd.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_groups_of_near_copies(spark, words, percent):
    rows = groups(words, 250, 350)
    sets = []
    for _, text in rows:
        t = text.split()
        sets.append({tuple(t[i:i + words]) for i in range(len(t) - words + 1)})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = [(i, root(i)) for i in range(len(rows))]
    assert 20 < len({r for _, r in want}) < len(rows) - 200
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id LONG, text STRING"), words, percent)
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == want
