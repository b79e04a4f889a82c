"""What is learnt doesn't depend on how rows are dealt to tasks."""

import random

import numpy as np
import pytest

from sluiceway.llm import toxicity, transcripts


@pytest.fixture
def dealt(spark):
    """Runs a function with a number of shuffle partitions that Spark doesn't join."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {n: spark.conf.get(n) for n in names}

    def run(n, fn):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "false")
        return fn()

    yield run
    for n, value in before.items():
        spark.conf.set(n, value)


def _lines():
    rng = random.Random(3)
    rows = [(9, 0, "user", "Q: a\n\nb\n"), (9, 1, "assistant", "\n \n"), (9, 2, "user", "\nlast?"), (None, None, "system", "\n\n")]
    for conv in range(12):
        for turn in range(rng.choice((1, 4, 60))):
            text = "\n".join(rng.choice(("", "", "User: hi", "yes?", "a line of more than twenty letters")) for _ in range(rng.randint(1, 5)))
            rows.append((100 + conv, turn, rng.choice(transcripts.ROLES), text))
    return rows


def test_transcript_model_is_that_of_one_plain_pass(spark, dealt):
    rows = _lines()
    start, move, emit = {}, {}, {}
    by_conv: dict = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((-1 if turn is None else turn, role, text))
    for turns in by_conv.values():
        last, blank = None, False
        for _, role, text in sorted(turns):
            for k, line in enumerate(text.split("\n")):
                if not line.strip():
                    blank = True
                    continue
                state = 2 * transcripts.ROLES.index(role) + (k > 0)
                if last is None:
                    start[state - state % 2] = start.get(state - state % 2, 0) + 1
                else:
                    move[last, state] = move.get((last, state), 0) + 1
                for i, value in enumerate(transcripts.features(line, blank)):
                    counts = emit.setdefault(i, {})
                    counts[state, value] = counts.get((state, value), 0) + 1
                last, blank = state, False
    plain = transcripts.Model.from_counts(start, move, emit)
    frame = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    for n in (1, 8, 64):
        got = dealt(n, lambda: transcripts.learn(frame))
        assert np.array_equal(got.start, plain.start) and np.array_equal(got.move, plain.move), n
        assert all(np.array_equal(a, b) for a, b in zip(got.emit, plain.emit, strict=True)), n


def test_lexicon_is_the_same_on_reruns(spark, dealt, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 250)
    rng = random.Random(4)
    rows = []
    for i in range(300):
        bad = i % 5 == 0
        words = [rng.choice(["one", "two", "three", "four", "five", "six", "seven"]) + str(rng.randrange(9)) for _ in range(12)]
        rows.append((i, " ".join([*words, "grumpf"] if bad else words), int(bad)))
    rows += [(5, "a copy under one id", 0), (5, "another copy under one id", 0), *rows[:40]]
    found = []
    for n, order in ((1, rows), (8, rows[::-1]), (32, sorted(rows, key=lambda r: r[1]))):
        frame = spark.createDataFrame(order, "doc_id LONG, text STRING, toxic INT").repartition(n)
        found.append(dealt(n, lambda: toxicity.learn_lexicon(frame, np.full((toxicity.CLASSES,) * 3, -3.0, dtype=np.float32))))
    assert found[0] == found[1] == found[2]
    assert "grumpf" in found[0][0]


def test_plain_words_get_the_tokenizer_s_ids():
    """Words whose pieces the model gets at once have the ids of whole texts, whatever letters, signs and memory."""
    import random
    from array import array

    from sluiceway.llm import token_files as tf
    path = tf.default_tokenizer()
    whole = tf._encoder(path)[0]
    rng = random.Random(3)
    letters = tf._LETTERS + "œİſ×÷ǅﬁ́'1.,!-"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 45))) + rng.choice(["", "", ".", ",;", "'s"])
                      for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, "", "<|endoftext|>A b.", "É'S ẞ. " * 3]
    known, tf.KNOWN_WORDS = tf.KNOWN_WORDS, 500
    try:
        got = [x for k in range(0, len(texts), 7) for x in tf.encode(texts[k:k + 7] + texts[:2], path, 2)[:len(texts[k:k + 7])]]
    finally:
        tf.KNOWN_WORDS = known
    want = [array("I", whole.encode(t or "", add_special_tokens=False).ids + [2]).tobytes() for t in texts]
    assert got == want
    tf._encoders.pop(path)
    tf.encode(["plain words, only plain words."], path, 2)
    learnt = tf._encoders[path][1]
    assert learnt.pieces and b"plain" in learnt and b"words" in learnt      # not by the tokenizer's own search for pieces
