"""Tab-separated sources and sinks. Quotes and backslashes are data; an empty field is null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_SCHEMA = "entity_id string, business_name string, business_address string, country string"
LIST_SCHEMA = "source1_entity_id string, ids string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The first path that exists, else the first."""
    return next((p for p in paths if exists(spark, p)), paths[0])


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", escape="", enforceSchema=True)


def read_source(spark: SparkSession, path_or_table: str | DataFrame) -> DataFrame:
    """A source by file, by table name, or as a table already at hand."""
    if isinstance(path_or_table, DataFrame):
        return path_or_table
    if path_or_table.endswith((".tsv", ".csv")) or exists(spark, path_or_table):
        return _read(spark, path_or_table, SOURCE_SCHEMA)
    return spark.table(path_or_table).select("entity_id", "business_name", "business_address", "country")


def limited(df: DataFrame, n: int | None) -> DataFrame:
    """The n records of smallest id: a limit that gives the same rows each time."""
    return df if n is None else df.orderBy("entity_id").limit(n)


def as_lists(pairs: DataFrame, spine: DataFrame, name: str) -> DataFrame:
    """One row per record of the spine: its candidate ids, ascending, joined by commas; empty if it has none."""
    ids = pairs.groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("candidate_entity_id")), ",").alias(name))
    return spine.select(F.col("entity_id").alias("source1_entity_id")).distinct().join(ids, "source1_entity_id", "left").fillna("", [name])


def from_lists(lists: DataFrame) -> DataFrame:
    """Candidate pairs from lists (source1_entity_id, ids), with constant provenance: all as if by channel a alone."""
    pairs = lists.select("source1_entity_id", F.explode(F.split("ids", ",", -1)).alias("candidate_entity_id")).where("candidate_entity_id <> ''")
    constant = {"total_priority": F.lit(100.0), "channels_fired": F.lit(1).cast("long"), "rank_order": F.lit(1).cast("long")}
    flags = {f"fired_chan_{c}": F.lit(int(c == "a")).cast("long") for c in ("a", "a2", "b", "c", "d", "e", "e2", "g")}
    return pairs.withColumns(constant | flags)


def read_lists(spark: SparkSession, path: str, only: DataFrame | None = None) -> DataFrame:
    """Candidate pairs of a list file, of the records in `only` (entity_id) if given."""
    lists = _read(spark, path, LIST_SCHEMA)
    if only is not None:
        lists = lists.join(only.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    return from_lists(lists)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def valid_pairs(pairs: DataFrame, s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """Distinct pairs of a known S1 record and a known S2 or S3 record of the same country."""
    l = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col("country").alias("_lc"))  # noqa: E741
    r = candidates.select(F.col("entity_id").alias("candidate_entity_id"), F.col("country").alias("_rc"))
    shaped = pairs.where(F.col("source1_entity_id").startswith("S1-") & F.col("candidate_entity_id").rlike("^S[23]-")).select("source1_entity_id", "candidate_entity_id")
    return shaped.join(l, "source1_entity_id").join(r, "candidate_entity_id").where("_lc = _rc").select("source1_entity_id", "candidate_entity_id").distinct()


def pruned(candidates: DataFrame, pairs: DataFrame) -> DataFrame:
    """The candidates that some pair names."""
    return candidates.join(pairs.select(F.col("candidate_entity_id").alias("entity_id")), "entity_id", "left_semi")
