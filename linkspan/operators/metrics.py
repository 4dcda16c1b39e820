"""Entity-level and pair-level metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkspan.plans.durable import durable

BUCKETS = {"group1_singleton": "true_n = 1", "group2_zero_match": "true_n = 0", "group3_multi_match": "true_n > 1"}


def _sets(df: DataFrame, name: str) -> DataFrame:
    return df.select("source1_entity_id", "candidate_entity_id").where("source1_entity_id is not null and candidate_entity_id is not null").distinct().withColumn(name, F.lit(1))


def entity_metrics(spine: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """(source1_entity_id, true_n, pred_n, hits, precision, recall, f05) of every record of the spine.

    A record without truth and prediction scores 1; with one of them only it scores 0. Counts come from one
    pass over the union of both pair sets.
    """
    keys = ["source1_entity_id", "candidate_entity_id"]
    both = _sets(predicted, "p").join(_sets(truth, "t"), keys, "full").fillna(0, ["p", "t"])
    counts = both.groupBy("source1_entity_id").agg(F.sum("t").alias("true_n"), F.sum("p").alias("pred_n"), F.sum(F.col("p") * F.col("t")).alias("hits"))
    x = spine.select("source1_entity_id").distinct().join(counts, "source1_entity_id", "left").fillna(0, ["true_n", "pred_n", "hits"])
    neither, one = (F.col("true_n") == 0) & (F.col("pred_n") == 0), (F.col("true_n") == 0) | (F.col("pred_n") == 0)
    grade = lambda v: F.when(neither, 1.0).when(one, 0.0).otherwise(v)
    x = x.withColumn("precision", grade(F.col("hits") / F.col("pred_n"))).withColumn("recall", grade(F.col("hits") / F.col("true_n")))
    weight = 0.25 * F.col("precision") + F.col("recall")
    return x.withColumn("f05", F.when(weight > 0, 1.25 * F.col("precision") * F.col("recall") / weight).otherwise(0.0))


def macro(metrics: DataFrame) -> DataFrame:
    """One row: macro F0.5, precision and recall, records, share of empty predictions, mean and total predictions. Zeros if there are no records."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return metrics.agg(
        mean("f05").alias("macro_f05"), mean("precision").alias("macro_precision"), mean("recall").alias("macro_recall"), F.count("*").alias("total_s1"),
        mean((F.col("pred_n") == 0).cast("double") * 100).alias("empty_pred_pct"), mean("pred_n").alias("avg_pred_matches"), F.coalesce(F.sum("pred_n"), F.lit(0)).alias("total_pred_matches"),
    )


def macro_by_group(metrics: DataFrame) -> DataFrame:
    """The same for records with one, no and several true matches, with a false positive rate; zeros for a group without records.

    The rate is the share of records with any prediction where there is no truth, and the share of wrong
    predictions elsewhere, both in percent.
    """
    spark = metrics.sparkSession
    group = F.lit(None).cast("string")
    for name, where in BUCKETS.items():
        group = F.when(F.expr(where), name).otherwise(group)
    mean = lambda c: F.avg(c)
    wrong = F.when(F.sum("pred_n") > 0, (F.sum("pred_n") - F.sum("hits")) / F.sum("pred_n") * 100).otherwise(0.0)
    rows = metrics.groupBy(group.alias("bucket")).agg(
        F.count("*").alias("count"), mean("f05").alias("macro_f05"), mean("precision").alias("macro_precision"), mean("recall").alias("macro_recall"), mean("pred_n").alias("avg_pred_matches"),
        F.when(F.max("true_n") == 0, F.avg((F.col("pred_n") > 0).cast("double")) * 100).otherwise(wrong).alias("false_positive_rate"),
    )
    names = spark.createDataFrame([(n,) for n in BUCKETS], "bucket string")
    return names.join(rows, "bucket", "left").fillna(0)


def evaluate(scored: DataFrame, truth: DataFrame, threshold: float, spine: DataFrame | None = None) -> DataFrame:
    """macro() of the pairs that score `threshold` or more, over the spine (by default the records with truth)."""
    spine = truth if spine is None else spine
    return macro(entity_metrics(spine, scored.where(F.col("score") >= threshold), truth))


def confusion(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row over (label, score): tp, fp, fn, tn, precision, recall, F0.5, log loss (clipped at 1e-7) and Brier score."""
    y, hit = F.col("label") == 1, F.col("score") >= threshold
    q = F.least(F.greatest(F.col("score"), F.lit(1e-7)), F.lit(1 - 1e-7))
    x = pairs.agg(
        F.count_if(y & hit).alias("tp"), F.count_if(~y & hit).alias("fp"), F.count_if(y & ~hit).alias("fn"), F.count_if(~y & ~hit).alias("tn"),
        F.avg(F.when(y, -F.log(q)).otherwise(-F.log(1 - q))).alias("log_loss"), F.avg((F.col("score") - F.col("label")) ** 2).alias("brier_score"),
    )
    share = lambda a, b: F.when(F.col(a) + F.col(b) > 0, F.col(a) / (F.col(a) + F.col(b))).otherwise(0.0)
    x = x.withColumn("pair_precision", share("tp", "fp")).withColumn("pair_recall", share("tp", "fn"))
    weight = 0.25 * F.col("pair_precision") + F.col("pair_recall")
    return x.withColumn("pair_f05", F.when(weight > 0, 1.25 * F.col("pair_precision") * F.col("pair_recall") / weight).otherwise(0.0))


def ranking(pairs: DataFrame) -> DataFrame:
    """One row over (label, score): ROC AUC (ties count half) and average precision; 0 if all labels are equal.

    Rows are first counted by score, so the ordered pass runs over distinct scores, whatever the number of rows. Its
    prefix sums come in two steps (ranges of scores, then within a range), so it isn't one task either.
    """
    by_score = pairs.groupBy("score").agg(F.sum("label").cast("double").alias("p"), F.sum(1 - F.col("label")).cast("double").alias("n"))
    # Written once: which range a score falls in must be the same for the totals and for the rows.
    ranged = durable(by_score.repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("p").alias("pp"), F.sum("n").alias("nn"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offset = totals.select("part", F.coalesce(F.sum("pp").over(before), F.lit(0.0)).alias("p0"), F.coalesce(F.sum("nn").over(before), F.lit(0.0)).alias("n0"))
    upto = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    x = ranged.join(F.broadcast(offset), "part").withColumn("tp", F.sum("p").over(upto) + F.col("p0")).withColumn("fp", F.sum("n").over(upto) + F.col("n0"))
    sums = x.agg(F.sum("p").alias("P"), F.sum("n").alias("N"), F.sum(F.col("n") * (F.col("tp") - F.col("p") / 2)).alias("wins"), F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ap"))
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return sums.select(F.when(ok, F.col("wins") / (F.col("P") * F.col("N"))).otherwise(0.0).alias("roc_auc"), F.when(ok, F.col("ap") / F.col("P")).otherwise(0.0).alias("pr_auc"))
