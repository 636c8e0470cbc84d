"""The pipeline against brute force, stage by stage on what the stage before kept."""

import pytest
from pyspark.sql import functions as F
from test_packing import check
from test_simhash import slow_components, slow_fingerprint

import __spark_entry__ as driver
import corpus_pipeline
from conftest_llm import ODD_ROWS
from roomledger.llm import quality, toxicity
from roomledger.llm.common import read
from roomledger.llm.queries import QUERIES, quality_held_out, toxicity_held_out


def kept_by_brute_force(spark, rows, labels):
    """(doc_id, text) of the rows that reach the last stage."""
    schema = "doc_id long, text string"
    model = toxicity.fit(spark.createDataFrame(rows, schema), labels, toxicity_held_out())
    rows = [(i, t) for i, t in rows if model.score(t or "") < 0.5]
    model = quality.fit(spark.createDataFrame(rows, schema), labels, quality_held_out())
    rows = [(i, t) for i, t in rows if model.score(t or "") >= 0.7]
    groups = slow_components([(i, slow_fingerprint(t)) for i, t in rows], 3)
    found = {}
    for (i, t), group in zip(rows, groups):
        if i == group:
            found.setdefault(group, (i, t))
    return list(found.values())


def test_pipeline_equals_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    kept = kept_by_brute_force(spark, docs, read(spark, sf_dir, "labels"))
    pieces = driver.queries()["pipeline"](spark, sf_dir).collect()
    assert {p["doc_id"] for p in pieces} == {i for i, _ in kept}
    check(kept, pieces)


def test_stages_return_the_columns_of_documents(spark, sf_dir, documents):
    docs = documents([*ODD_ROWS, (9, "You idiot. " * 3)]).withColumn("text2", F.lit("extra"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert {r["doc_id"] for r in docs.collect()} == {1, 4, None}


@pytest.mark.parametrize("number", range(4))
def test_empty_tables(spark, sf_dir, documents, number):
    assert corpus_pipeline.STAGES[number][1](spark, documents([]), sf_dir).count() == 0


def test_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
