"""Spelling variants: words one edit apart, grouped under their commonest form.

Asymmetric chunks: a word of L code points gives two disjoint chunks, its halves. One edit leaves
one of them whole, so it stands in the other word as a positional gram of that length, at the
same place or shifted by one. The half that the edit is in is cut in two again, and of its
halves one is whole by the same argument; both together are what words are joined on, so that a
common chunk makes no group in which all words meet. A word answers with those of its positional
grams that lie within shift one of a chunk of a word of its own length or of one code point
less, no others can meet one. What meets is verified by exact edit distance.

Nothing is dropped: keys are hashes of chunks, and equal hashes of other chunks only cost a check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.components import stored

# What counts as a letter, and the letters that are lower-cased.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many loses a code point in `misspelt`.
DAMAGE = 97
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2


def runs(docs: DataFrame) -> DataFrame:
    """(doc, run) for every maximal run of letters in `docs(doc_id, text)`, A-Z lower-cased.

    A null text has none; a null doc_id is the empty text. Other columns are ignored.
    """
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    return found.withColumn("run", F.when(F.col("run") == F.lower("run"), F.col("run"))
                            .otherwise(F.translate("run", UPPER, LOWER)))


def misspelt(found: DataFrame, every: int = DAMAGE) -> DataFrame:
    """Delete a code point of one run in `every`, by the checksum of `doc:run`."""
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return found.withColumn("h", h).select(
        "doc", F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("run"))


def count_words(found: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the runs of at least `length` code points that occur `count` times or more."""
    return found.filter(F.char_length("run") >= length).groupBy(F.col("run").alias("word")) \
        .agg(F.count("*").alias("n")).filter(F.col("n") >= count)


def _cuts(length: Column) -> list[Column]:
    """Where a word of this length is cut: at its half, and each half at its own."""
    half = F.floor(length / 2)
    return [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length]


def _keys(word: Column, length: Column, longer: int) -> list[Column]:
    """One key per quarter: what a word of `length` keeps if the edit is in that quarter.

    With `longer` 1 the word itself has a code point more, and what follows the edit is shifted by one.
    """
    cuts = [c.cast("int") for c in _cuts(length)]
    out = []
    for k in range(4):
        before = F.substring(word, F.lit(1), cuts[k])
        behind = F.substring(word, cuts[k + 1] + 1 + longer, length.cast("int"))
        out.append(F.struct(F.xxhash64(length.cast("int"), F.lit(k), before, behind).alias("key"),
                            F.lit(k).alias("quarter"), F.lit(longer).alias("longer")))
    return out


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all ordered pairs of distinct `words(word, n)` with edit distance one.

    Words are distinct and not null. Each pair comes once: two words of equal length differ in one
    quarter only; of different length, the first quarter that fits counts.
    """
    word, length = F.col("word"), F.char_length("word")
    chunks = words.select(F.col("word").alias("x"), F.col("n").alias("nx"),
                          F.inline(F.array(*_keys(word, length, 0)))).drop("longer")
    grams = words.select(F.col("word").alias("y"), F.col("n").alias("ny"), F.inline(F.array(
        *_keys(word, length, 0), *_keys(word, length - 1, 1))))
    cut = F.element_at(F.array(*_cuts(F.char_length("x"))), F.col("quarter") + 1).cast("int")
    rest = F.char_length("y")
    earlier = F.substring("x", cut + 1, rest) == F.substring("y", cut + 2, rest)
    met = chunks.join(grams, ["key", "quarter"]).filter(
        (F.col("x") != F.col("y"))
        & (F.char_length("y") == F.char_length("x") + F.col("longer"))
        & (F.levenshtein("x", "y", 1) == 1)
        & ((F.col("longer") == 0) | (F.col("quarter") == 0) | ~earlier))
    way = lambda a, b, n: F.struct(F.col(a).alias("word"), F.col(b).alias("near"), F.col(n).alias("near_n"))
    both = F.array(way("x", "y", "ny"), way("y", "x", "nx"))
    return met.select(F.inline(F.when(F.col("longer") == 1, both).otherwise(F.array(way("x", "y", "ny")))))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following `forms(word, form)`; each round doubles the steps taken.

    A form is at least twice as common as its word, so there are no rings and few rounds.
    """
    spark = forms.sparkSession
    now = stored(spark, forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(spark, now.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """`words(word, n)` with form, root, n_near and form_n.

    A word's form is its commonest near word (ties: the smaller in code-point order) if that is at
    least `ratio` times as common, else null. The root is what the forms lead to, the word itself if it
    has none. `ratio` must be over 1.
    """
    spark = words.sparkSession
    words = stored(spark, words.select("word", "n"))
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    common = F.col("best.less") * -1 >= F.col("n") * ratio
    joined = stored(spark, words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"),
        F.when(common, -F.col("best.less")).alias("form_n")))
    roots = _roots(joined.filter("form IS NOT NULL"))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, every: int | None = None) -> DataFrame:
    """The words of `docs(doc_id, text)` with their forms; with `every`, misspelt first.

    Null and empty texts and empty tables have no words; a text is read as a whole, whatever its
    length; repeated rows count again; other columns are ignored.
    """
    found = runs(docs)
    return group_variants(count_words(misspelt(found, every) if every else found))


def crc32_sql(codes: str) -> str:
    """SQL for the checksum of a list of bytes, bit by bit."""
    # Fixed value: the reversed polynomial of CRC-32.
    bit = "lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    byte = f"lambda c, b: xor(c // 256, list_reduce([xor(c, b) % 256] || range(8), {bit}))"
    return f"xor(4294967295, list_reduce([4294967295::BIGINT] || {codes}, {byte}))"


_CODES = "flatten(list_transform(string_split(s, ''), lambda c: " \
    "CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END))"

VARIANTS_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS raw FROM documents),
lowered AS (SELECT doc_id, translate(raw, '{UPPER}', '{LOWER}') AS run, count(*) AS n FROM runs GROUP BY ALL),
marked AS (
  SELECT run, n, {crc32_sql(_CODES)} AS h
  FROM (SELECT run, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s FROM lowered WHERE length(run) >= {LEAST_LENGTH})),
w AS (
  SELECT CASE WHEN h % {DAMAGE} = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n
  FROM marked GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND sum(n) >= {LEAST_COUNT}),
gone AS (
  SELECT DISTINCT word, i, left(word, i) || '_' || substr(word, i + 2) AS open, left(word, i) || substr(word, i + 2) AS less
  FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
shorter AS (SELECT DISTINCT word, less FROM gone),
near AS (
  SELECT a.word, b.word AS near FROM gone a JOIN gone b ON a.open = b.open AND a.word <> b.word
  UNION ALL SELECT s.word, w.word FROM shorter s JOIN w ON s.less = w.word
  UNION ALL SELECT w.word, s.word FROM shorter s JOIN w ON s.less = w.word),
best AS (
  SELECT near.word, count(*) AS n_near, min({{'less': -w.n, 'near': near.near}}) AS b
  FROM near JOIN w ON w.word = near.near GROUP BY 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -b.less >= {RATIO} * w.n THEN b.near END AS form, CASE WHEN -b.less >= {RATIO} * w.n THEN -b.less END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word),
follow AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT follow.word, formed.form FROM follow JOIN formed ON formed.word = follow.root WHERE formed.form IS NOT NULL),
ends AS (SELECT follow.word, root FROM follow JOIN formed ON formed.word = root WHERE form IS NULL)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN ends ON ends.word = formed.word"""
