"""From raw documents to a training mix: quality rules, near duplicates, benchmark leaks, personal data, mixing.

Each stage works on all documents that its predecessor kept and returns the columns of documents (the last one
the drawn documents with their epoch). Stages are written as Parquet and read again.

NULL and empty texts have under ten words, so the quality rules reject them; in the other stages a NULL text is an empty
one that is no duplicate, leaks nothing, stays NULL and is never drawn. NULL ids are ids like others, last in order. Of rows
with equal id and text near-duplicate removal keeps one, and of equal texts the one with the smallest id. Texts of any length are
whole; an empty table stays empty. Further columns pass through all stages but the last, whatever their names but for
`_stage_key` and `_pii_print`, `_pii_extra`, which stages make themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlab.llm import mixing, neardup, pii, quality, tiling
from growthlab.llm.queries import WEIGHTS, source_tree
from growthlab.llm.storage import stored, without

KEY = "_stage_key"


def _key() -> Column:
    """Names a row by its id and text; ordered as ids are, NULL ids last. Repeated rows share it."""
    id_ = F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~"))
    return F.concat_ws("-", id_, F.hex(F.xxhash64("text")))


def _keyed(docs: DataFrame) -> DataFrame:
    return without(docs, KEY).withColumn(KEY, _key())


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 AND toxic = 0")
    keyed = _keyed(docs)
    verdict = quality.quality_rules(keyed, trusted, carry=(KEY,))
    return keyed.join(verdict.where("kept").select(KEY), KEY, "left_semi").drop(KEY)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates; repeated rows once."""
    keyed = _keyed(docs)
    classes = neardup.near_duplicates(keyed.select(KEY, "text"), id_col=KEY, shingle=5, percent=80)
    kept = classes.where("kept").select(KEY)
    return keyed.join(kept, KEY, "left_semi").dropDuplicates([KEY]).drop(KEY)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return tiling.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and n_chars of the new text."""
    size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return pii.redact_private(docs).withColumn("n_chars", size)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the source tree's weights, once for each epoch."""
    return mixing.mix_sources(docs, source_tree(), WEIGHTS, share_percent=80, max_epochs=2, seed="7", keep_text=True)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark leaks", leak_stage),
    ("personal data", private_data_stage),
    ("source mix", mixing_stage),
]

#: SQL expresses neither the stages' hashes nor the tiling; tests hold run() against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
