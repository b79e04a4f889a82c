"""The operators over their whole tables: name -> (query, SQL that gives the same rows, or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import mixing, spelling, toxicity, transcripts
from sluiceway.llm.ann import nearest
from sluiceway.llm.decontaminate import find_leaks
from sluiceway.llm.html_text import extract_text
from sluiceway.llm.licenses import license_table
from sluiceway.llm.near_dup import near_duplicates
from sluiceway.llm.pii import find_pii, pii_counts
from sluiceway.llm.repair import REPAIR_SQL, repair_table
from sluiceway.llm.token_files import token_table
from sluiceway.llm.warc import WARC_SQL, warc_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP2_SQL = f"""WITH {mixing.MIX_SQL.format(documents="documents")}
SELECT doc_id, size_ AS size, source_size_ AS source_size, target_ AS target, size_ * copies_ AS taken FROM mix"""


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_counts(find_pii(_table(spark, sf_dir, "documents")))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_table(_table(spark, sf_dir, "documents"))


def op8_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as raw transcripts, parsed again: the turns found in them, their roles and canonical form.

    The model is learnt from one half of the conversations; `held_out` marks the turns of the other.
    """
    raw = transcripts.raw_transcripts(_table(spark, sf_dir, "conversations"))
    model = transcripts.learn(raw.filter(~transcripts.held_out(F.col("conv_id"))))
    turns = transcripts.render_turns(transcripts.parse_transcripts(raw.drop("role"), model))
    return turns.select(F.col("conv").cast("long").alias("conv_id"), transcripts.held_out(F.col("conv")).alias("held_out"), "turn", "role",
                        F.length("text").cast("long").alias("n_chars"), F.md5("rendered").alias("rendered_md5"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op11_warc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_table(_table(spark, sf_dir, "pages"))


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_table(_table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), spelling.DAMAGE)


QUERIES = {
    "op1_decontaminate": (op1_decontaminate, None),
    "op2_mix_sources": (op2_mix_sources, OP2_SQL),
    "op3_nearest": (op3_nearest, None),
    "op4_html_text": (op4_html_text, None),
    "op5_toxicity": (op5_toxicity, None),
    "op6_pii": (op6_pii, None),
    "op7_licenses": (op7_licenses, None),
    "op8_transcripts": (op8_transcripts, None),
    "op9_token_files": (op9_token_files, None),
    "op10_near_duplicates": (op10_near_duplicates, None),
    "op11_warc_files": (op11_warc_files, WARC_SQL),
    "op12_repair_conversations": (op12_repair_conversations, REPAIR_SQL),
    "op13_spelling_variants": (op13_spelling_variants, spelling.VARIANTS_SQL),
}
