"""Each stage on what its predecessor kept, against plain versions."""

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import brute
import corpus_pipeline
from llm_rows import same
from panelwright.llm.queries import LLM_QUERIES, sentencepiece_model
from panelwright.plans.given_tables import table

SF = "/root/testdata/sf0.001"


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, tmp_path):
    docs, kept = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if name != "sentencepiece":
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs)
    quality, lines, near, clean, coded = kept

    scores = {r["doc_id"]: r["predicted"] for r in LLM_QUERIES["op7_quality_classifier"](spark, SF).collect()}
    assert {r[0] for r in quality.select("doc_id").collect()} == {i for i, p in scores.items() if p}

    cut = brute.line_dedup(_rows(quality), 50)
    same(_rows(lines), [(i, text) for i, _, removed, text in cut if not removed or text.strip()])
    assert lines.where(F.col("n_chars") != F.length("text")).count() == 0

    first = {i for i, _, _, stays in brute.near_duplicates(_rows(lines)) if stays}
    same(_rows(near), [(i, t) for i, t in _rows(lines) if i in first])

    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    gone = {r[0] for r in brute.contamination(_rows(near), items) if r[-1]}
    same(_rows(clean), [(i, t) for i, t in _rows(near) if i not in gone])

    library = SentencePieceProcessor(model_proto=sentencepiece_model())
    same(coded.select("doc_id", "ids").collect(), [(i, library.encode(t)) for i, t in _rows(clean)])
    assert coded.where("NOT round_trip OR n_ids <> size(ids)").count() == 0


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_and_no_documents(spark, docs, k):
    odd = docs.select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"),
        F.length("text").cast("long").alias("n_chars"),
    )
    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, odd, SF).count() <= odd.count()
    assert stage(spark, odd.where("false"), SF).count() == 0
