"""Checks of result files, as tables of findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkspan.plans.durable import durable, release

RULES = {
    "duplicate_row": "record on more than one row",
    "repeated_id": "id twice within a list",
    "self_match": "id of the reference source in a list",
    "wrong_prefix": "id without an S2- or S3- prefix",
    "unknown_id": "id that neither candidate source has",
    "missing_record": "required record without a row",
    "unexpected_record": "row of a record that isn't required",
}
MATCHING_HEADER = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_HEADER = ["source1_entity_id", "candidate_entity_ids"]


def findings(lists: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(rule, source1_entity_id, value) over lists (source1_entity_id, ids: text with commas) and required (entity_id).

    Without `known` (entity_id) ids aren't looked up. A blank list is an empty one.
    """
    rows = lists.select("source1_entity_id", "ids")
    none = F.lit(None).cast("string")
    found = lambda df, rule, s1, value: df.select(F.lit(rule).alias("rule"), s1.alias("source1_entity_id"), value.alias("value"))
    s1 = F.col("source1_entity_id")
    listed = rows.where(F.trim(F.coalesce("ids", F.lit(""))) != "").select("source1_entity_id", F.split("ids", ",", -1).alias("l"))
    ids = listed.select("source1_entity_id", F.explode(F.array_distinct("l")).alias("id"))
    present = rows.select("source1_entity_id").distinct()
    need = required.select(F.trim("entity_id").alias("source1_entity_id")).distinct()
    out = [
        found(rows.groupBy("source1_entity_id").count().where("count > 1"), "duplicate_row", s1, none),
        found(listed.where(F.size(F.array_distinct("l")) < F.size("l")).distinct(), "repeated_id", s1, none),
        found(ids.where(F.col("id").startswith("S1-")), "self_match", s1, F.col("id")),
        found(ids.where(~F.col("id").rlike("^S[123]-")), "wrong_prefix", s1, F.col("id")),
        found(need.join(present, "source1_entity_id", "left_anti"), "missing_record", s1, none),
        found(present.join(need, "source1_entity_id", "left_anti"), "unexpected_record", s1, none),
    ]
    if known is not None:
        strange = ids.where(F.col("id").rlike("^S[23]-")).join(known.select(F.trim("entity_id").alias("id")).distinct(), "id", "left_anti")
        out.append(found(strange, "unknown_id", s1, F.col("id")))
    table = out[0]
    for x in out[1:]:
        table = table.unionByName(x)
    return table.distinct()


def outside(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """(source1_entity_id, value) of matched pairs that aren't candidates."""
    keys = ["source1_entity_id", "candidate_entity_id"]
    return matched.select(*keys).distinct().join(candidates.select(*keys), keys, "left_anti").select("source1_entity_id", F.col("candidate_entity_id").alias("value"))


def check_file(spark: SparkSession, path: str, header: list[str], required: DataFrame, known: DataFrame | None = None, examples: int = 5) -> list[str]:
    """What is wrong with a tab-separated result file, in words; an empty list if nothing is.

    Only `examples` offenders of each rule come to the driver.
    """
    from linkspan.sources.tsv import exists

    if not exists(spark, path):
        return [f"file not found: {path}"]
    lines = spark.read.text(path)
    first = lines.first()
    if first is None:
        return [f"{path} is empty"]
    if lines.where(~F.is_valid_utf8("value")).take(1):
        return [f"{path}: not valid UTF-8 text; it must be a plain tab-separated file"]
    if "\t" not in first[0] and "," in first[0]:
        return [f"{path}: the header has commas and no tab; the file must be tab-separated"]
    if [c.strip().lower() for c in first[0].split("\t")] != header:
        return [f"{path}: unexpected header {first[0]!r}"]
    body = lines.where(F.col("value") != first[0])
    broken = body.where(~F.col("value").contains("\t") & (F.trim("value") != "")).limit(examples).collect()
    out = [f"{path}: malformed row (no tab): {r[0]!r}" for r in broken]
    parts = F.split("value", "\t", 2)
    rows = body.where(F.col("value").contains("\t")).select(parts[0].alias("source1_entity_id"), parts[1].alias("ids"))
    table = durable(findings(rows, required, known))
    counts = {r["rule"]: r["count"] for r in table.groupBy("rule").count().collect()}
    some: dict[str, list[str]] = {}
    for rule, value in first_offenders(table, examples).collect():
        some.setdefault(rule, []).append(value)
    release(table)
    return sorted(out + [f"{path}: {RULES[rule]}: {n} total, e.g. {', '.join(sorted(some[rule]))}" for rule, n in counts.items()])


def first_offenders(table: DataFrame, n: int) -> DataFrame:
    """(rule, offender): the first n offenders of each rule, in order. Each task keeps n of a rule before they meet."""
    rank = F.dense_rank().over(Window.partitionBy("rule").orderBy("offender"))
    return table.select("rule", F.coalesce("value", "source1_entity_id").alias("offender")).withColumn("k", rank).where(F.col("k") <= n).select("rule", "offender").distinct()


def listed_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The pairs of a result file."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="", escape="", schema="source1_entity_id string, ids string", enforceSchema=True)
    return rows.select("source1_entity_id", F.explode(F.split("ids", ",", -1)).alias("candidate_entity_id")).where("candidate_entity_id <> ''")


def subset_warning(spark: SparkSession, matching: str, candidates: str, examples: int = 5) -> str | None:
    """A warning if matched ids aren't among the candidates, which a file may be and still be valid."""
    strange = outside(listed_pairs(spark, matching), listed_pairs(spark, candidates)).select("source1_entity_id").distinct()
    n = strange.count()
    if n:
        some = [r[0] for r in strange.orderBy("source1_entity_id").limit(examples).collect()]
        return f"{n} records have matched ids that are no candidates, e.g. {', '.join(some)}"


def main(argv: list[str] | None = None) -> int:
    """Check result files from the command line; exit code 0 if nothing is wrong."""
    import argparse
    import sys

    from linkspan.sources.tsv import exists, read_source

    p = argparse.ArgumentParser(description="Check matching_results.tsv and, if it is there, candidate_pairs.tsv.")
    p.add_argument("--matching", default="output/matching_results.tsv")
    p.add_argument("--candidates", default="output/candidate_pairs.tsv")
    p.add_argument("--test-dir", default="dataset")
    p.add_argument("--check-ids", action="store_true", help="look ids up in the candidate sources")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("linkspan-validate").getOrCreate()
    required = read_source(spark, f"{a.test_dir}/test_source1.tsv")
    known, warnings = None, []
    files = [f"{a.test_dir}/test_source{i}.tsv" for i in (2, 3)]
    missing = [f for f in files if a.check_ids and not exists(spark, f)]
    warnings += [f"{f} is missing: ids are not looked up" for f in missing]
    if a.check_ids and not missing:
        known = read_source(spark, files[0]).unionByName(read_source(spark, files[1]))
    problems = check_file(spark, a.matching, MATCHING_HEADER, required, known)
    if exists(spark, a.candidates):
        sound = not problems
        more = check_file(spark, a.candidates, CANDIDATE_HEADER, required, known)
        problems += more
        if sound and not more and (w := subset_warning(spark, a.matching, a.candidates)):
            warnings.append(w)
    else:
        warnings.append(f"{a.candidates} is missing")
    for w in warnings:
        print(f"warning: {w}", file=sys.stderr)
    print("\n".join(problems) or "nothing wrong")
    return int(bool(problems))


if __name__ == "__main__":
    raise SystemExit(main())
