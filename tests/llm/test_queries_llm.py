"""The registered queries and the pipeline on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from check_queries import difference, duck_rows, spark_rows
from sluiceway.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_whole_tables(spark, name):
    assert name in contract.queries()
    got = contract.queries()[name](spark, SF)
    table = {"op3_nearest": None, "op1_decontaminate": None, "op4_html_text": "pages", "op8_transcripts": "conversations",
             "op11_warc_files": "pages", "op12_repair_conversations": None, "op13_spelling_variants": None}.get(name, "documents")
    if table:
        assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    sql = QUERIES[name][1]
    if sql:
        assert difference(spark_rows(got), duck_rows(SF, sql)) is None


def test_pipeline(spark, tmp_path):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, counts = documents, [documents.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
    # The few labels of the smallest tables show no toxic word beyond chance; test_toxicity has more.
    assert counts[0] >= counts[1] > counts[2] >= counts[3] and counts[4] == counts[5] > 0
    rows = docs.orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
    assert rows[-1]["start"] + rows[-1]["n_tokens"] == docs.agg(F.sum("n_tokens")).first()[0]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, rows))
