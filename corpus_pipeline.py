"""From raw documents to training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns
the columns of ``documents``; the last returns pieces of sequences. Rows with the same or no
id are told apart by their file and their place in it. A stage writes down which rows it
decides on, never their texts, and removes its other tables before it returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm.common import own_folder, row_names, scratch, table, written
from roadstream.llm.decontaminate import leaks
from roadstream.llm.neardup import near_duplicates
from roadstream.llm.packing import pack
from roadstream.llm.quality import quality
from roadstream.llm.secrets import hidden, redact_rows, scan
from roadstream.plans import files, fits_broadcast


def _without(named: DataFrame, names: list[str], gone: DataFrame) -> DataFrame:
    """The rows of ``named`` but for those that the written table ``gone`` names; texts are
    shuffled only if these are too many to be sent to every task."""
    gone = F.broadcast(gone) if fits_broadcast(gone) else gone
    return named.join(gone, names, "left_anti").drop(*names)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit stay."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    named, names = row_names(docs)
    with scratch(spark):
        judged = quality(named, trusted, carry=tuple(names))
        gone = written(judged.where("not kept").select("row.*"), keep=True)
    return _without(named, names, gone)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are alike (five-word shingles, similarity 0.8) the one with the
    smallest id stays, of repeated rows the first, one without an id only if none has one."""
    named, names = row_names(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *names)
    with scratch(spark):
        found = near_duplicates(named.select(order.alias("place"), "text"), "place", size=5, percent=80)
        gone = written(found.where("not kept").select(*[f"id.{n}" for n in names]), keep=True)
    return _without(named, names, gone)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item stands go."""
    named, names = row_names(docs)
    with scratch(spark):
        rows = named.select(F.struct(*names).alias("row"), "text")
        found = leaks(rows, table(spark, sf_dir, "benchmark"), "row")
        gone = written(found.select("id.*").distinct(), keep=True)
    return _without(named, names, gone)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets but for examples are replaced in their texts."""
    named, names = row_names(docs)
    with scratch(spark):
        found = scan(named.select(F.struct(*names).alias("row"), "text", "source"), "row")
        at = found.select("id.*", hidden().alias("_at")).where(F.size("_at") > 0)
        at = written(at, keep=True)
    clean = redact_rows(named, at, names)
    if "n_chars" not in docs.columns:
        return clean
    changed = F.contains("text", F.lit("[SECRET]"))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(docs, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scan", secrets_stage),
    ("packing", packing_stage),
]

#: Models, shingle sets and the tokenizer are beyond SQL; the stages are tested by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to the written result of the one before, which
    is removed afterwards. Of the shared folder only the last result stays in use."""
    docs, folder = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        after = own_folder(spark)
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(after)
        docs = spark.read.schema(result.schema).parquet(after)
        if folder is not None:
            files.remove(spark, folder)
        folder = after
    return docs
