"""A training corpus from ``documents``: quality, repeated lines, near-duplicates, contamination, token ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of ``documents``; the last one adds the token ids.

In every stage an empty table gives an empty one, repeated rows are treated alike, further
columns are not read and not returned, and very long texts are worked on whole. What becomes of
null and empty texts is stated at each stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import decontamination, line_dedup, near_duplicates, piece_codec, rule_ensemble
from panelwright.llm.queries import sentencepiece_model
from panelwright.plans.given_tables import table
from panelwright.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject; null and empty texts are scored like any other."""
    model = rule_ensemble.train(docs, table(spark, sf_dir, "labels"))
    return rule_ensemble.scored(docs, model).where(F.col("__score") >= rule_ensemble.KEEP).select(*COLUMNS)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier; those of which nothing is left go.

    A null or empty text has no runs, so it stays as it is.
    """
    kept = line_dedup.drop_repeated_lines(docs)
    return kept.where((F.col("__n_removed") == 0) | (F.trim("text") != "")).select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("__n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Null and empty texts, and rows with a null id, are linked with nothing and stay.
    """
    return near_duplicates.drop_near_duplicates(docs).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate; null and empty texts stay."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether decoding these gives the text again.

    A null text has null ids and a null verdict, an empty one no ids.
    """
    return piece_codec.encoded(docs.select(*COLUMNS), sentencepiece_model()).withColumn(
        "n_ids", F.size("ids").cast("long")
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_deduplication),
    ("decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece_ids),
]

# The classifier is learned and the ids come from a tokenizer: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
