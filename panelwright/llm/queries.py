"""One query per operator over the whole given tables: name -> function of (spark, sf_dir)."""

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from panelwright.llm import (
    decontamination,
    license_scan,
    line_dedup,
    near_duplicates,
    personal_data,
    piece_codec,
    quality_rules,
    ranked_search,
    rule_ensemble,
    sharding,
    source_divergence,
    token_counts,
    vector_graph,
)
from panelwright.plans.given_tables import table
from panelwright.session import stored

TOKENIZERS = os.environ.get("PANELWRIGHT_TOKENIZERS", "/opt/tokenizers")
PIECES = "piece_bpe_32k.model"


def sentencepiece_model(folder: str = TOKENIZERS, name: str = PIECES) -> bytes:
    """The content of a model file on the driver."""
    with open(os.path.join(folder, name), "rb") as file:
        return file.read()


def vocabulary(model: bytes) -> list[str]:
    """The ordinary pieces of a model, the marker at word starts included."""
    pieces = SentencePieceProcessor(model_proto=model)
    return [
        pieces.id_to_piece(i) for i in range(pieces.get_piece_size())
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i) or pieces.is_unused(i))
    ]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary(sentencepiece_model()))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(documents(spark, sf_dir))

    def named(kind, arrays):
        spans = F.concat(*[
            F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for a in arrays
        ])
        return F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        )

    base = F.concat(*[named(k, [F.col(f"base_{k}")]) for k in personal_data.KINDS])
    kinds = [*personal_data.KINDS, *[k for k in personal_data.ADDED if k not in personal_data.KINDS]]
    every = F.concat(*[
        named(k, [F.col(f"{s}_{k}") for s in ("base", "added") if f"{s}_{k}" in found.columns]) for k in kinds
    ])
    return found.select(
        "doc_id", *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in personal_data.KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.rule_ledger(documents(spark, sf_dir))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"), quality_rules.passes().alias("kept"),
        "failure_bits",
    )


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy rejects, alone and together with others; the texts are read once."""
    ledger = stored(quality_rules.rule_ledger(documents(spark, sf_dir)).select("failure_bits"), "ledger")
    found = [quality_rules.ablation(ledger, p).withColumn("policy", F.lit(p)) for p in quality_rules.POLICIES]
    return reduce(DataFrame.unionByName, found)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_codec.encoded(documents(spark, sf_dir).select("doc_id", "text"), sentencepiece_model())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text"
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.sharded(documents(spark, sf_dir).select("doc_id", "text"), 8)
    return placed.select(
        "doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("__shard").alias("shard"), F.col("__slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = rule_ensemble.train(docs, table(spark, sf_dir, "labels"))
    return rule_ensemble.scored(docs, model).select(
        "doc_id", (rule_ensemble.fold("doc_id") == 0).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= rule_ensemble.KEEP).cast("int").alias("predicted"),
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(documents(spark, sf_dir))


def op13_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_personal_data, op3_quality_rules, quality_rule_ablations, op4_sentencepiece, op5_line_dedup, op6_sharding,
        op7_quality_classifier, op8_near_duplicates, op9_license_scan, op10_decontamination, op11_ranked_search,
        op12_source_divergence, op13_vector_graph, pipeline,
    )
}
