"""From documents to tokens: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`. Columns
other than doc_id and text pass through whatever their names are. Null and empty texts pass every filter (they hold
nothing to reject) and near-duplicate detection links them like any other text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import discard_all, materialize, named, tables
from quire.llm.decontaminate import overlap
from quire.llm.line_dedup import line_dedup
from quire.llm.sentencepiece_scan import encode
from quire.llm.simhash import near_duplicates
from quire.llm.toxicity import fit, toxicity_scores


def _annotated(docs: DataFrame, annotate: Callable[[DataFrame, list[str]], DataFrame], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`annotate` on docs whose columns have names that no result has; `keep` filters; then the names come back."""
    names = [f"__in_{i}" for i in range(len(docs.columns))]
    shadow = docs.select(*[named(c).alias(n) for c, n in zip(docs.columns, names, strict=True)], F.col("text").alias("text"))
    kept = keep(annotate(shadow, names))
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model is fitted on these documents' labels."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _annotated(docs, lambda d, names: toxicity_scores(d, model, names), lambda d: d.where("score < 0.5"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of recurring templates; n_chars, where there is one, counts the new text."""
    kept = line_dedup(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each near-duplicate group; repeated rows of it once.

    Rows of one id with different texts are judged one by one; rows of one id and text are one document, whatever their
    other columns. Rows without an id cannot be named as members of a group and stay, all of them.
    """
    keyed = docs.withColumn("__quire_key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    found = near_duplicates(keyed.select("doc_id", "text", "__quire_key"), keep=("__quire_key",))
    dropped = materialize(found.where("doc_id <> component_id").select("doc_id", "__quire_key").distinct(), "dropped")
    # a number for each row without id keeps such rows apart
    keyed = keyed.withColumn("__quire_row", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    kept = keyed.join(dropped, ["doc_id", "__quire_key"], "left_anti")
    # by the digest, not the text: the rows already lie where these keys are together
    return kept.dropDuplicates(["doc_id", "__quire_key", "__quire_row"]).select(*[named(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark; one such passage is enough to reject a document of any length."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _annotated(docs, lambda d, names: overlap(d, bench, names), lambda d: d.where("n_hit = 0"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the piece ids of each text, their number and digest, and whether decoding gives the text back."""
    return encode(docs.select("doc_id", "text"), ["doc_id"])


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = tables(spark)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard_all(spark, but=[*before, docs._quire_path])  # what the stage made on its way, and the stage before it
    return STAGES[-1][1](spark, docs, sf_dir)


#: The field's training, the trees and the tokeniser have no SQL; the tests hold the result against a plain version.
ORACLE_SQL = None
