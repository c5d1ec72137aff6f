"""A corpus pipeline of five stages; each works on what its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet and reads back for the next one. All stages
but the last return the columns of documents; the last returns the packed pieces. Stages follow rows by id and text: of rows with equal texts one
stays, whatever their ids, and of each near-duplicate group one. Rows without an id are kept apart by their texts. Null texts count as empty, which the
quality rules reject. Further columns pass through, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import exact_dedup, mixing, near_dedup, packing, quality_rules
from tapewright.llm.common import documents, land


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row with the largest id."""
    return _only(docs, exact_dedup.exact_duplicates(docs).where("kept"), once=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8 or more), one row with the smallest id; rows without an id stay."""
    kept = near_dedup.near_duplicates(docs).where("kept")
    # Several texts of the smallest id are one group: the one with the smallest hash stays.
    kept = kept.groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash"))).agg(F.min("text_hash").alias("text_hash"))
    return _only(docs, kept, once=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics come near their target weights; equal rows are decided alike."""
    return _only(docs, mixing.mix(docs).where("sampled"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens with their sequences."""
    out = packing.packed(docs, with_ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _only(docs: DataFrame, decided: DataFrame, once: bool = False) -> DataFrame:
    """Rows of docs whose id and text are among the decided ones (doc_id, text_hash); null ids match each other. once: one row of each of them."""
    names = list(docs.columns)
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))  # names may clash
    id_, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    keyed = plain.withColumns({"key": F.coalesce(id_.cast("long"), F.lit(0)), "none": id_.isNull(), "hash": F.xxhash64(F.coalesce(text, F.lit("")))})
    rows = land(decided.select(F.coalesce("doc_id", F.lit(0)).alias("key"), F.col("doc_id").isNull().alias("none"), F.col("text_hash").alias("hash")), "pipeline-decided")
    out = keyed.join(rows.distinct(), ["key", "none", "hash"], "left_semi")
    if once and docs.count() != keyed.select("key", "none", "hash").distinct().count():
        out = out.dropDuplicates(["key", "none", "hash"])
    return out.drop("key", "none", "hash").toDF(*names)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixed", mixed), ("packed", packed)]

#: Suffix arrays, MinHash links and tokens are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
