"""Top N items within every group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkspan.plans.skew import all_salts, salt, salts_by_slot

#: Cells of a group's score histogram.
CELLS = 64
#: Quantiles of the scores between which the cells lie.
QUANTILES = (0.001, 0.999)


def top_n(df: DataFrame, group: str, item: str, score: str, n: int = 10) -> DataFrame:
    """Per group the n items of highest score; equal scores are ordered by item ascending.

    1. Rows are placed once by (group, salt); only groups in slots that hold over 1/256 of all rows have
       more than one salt. There, an item that occurs more than once keeps its highest score.
    2. A histogram of scores per group, over cells between two outer quantiles of all scores (a few wild scores
       fall into the cells at the ends and leave the others as fine as they are), gives the highest cell at or above which the group has n items at least: everything below it is dropped,
       where the rows already lie.
    3. Only what is left moves to its group and is ranked exactly. Should a cell still hold very many rows
       (equal scores), Spark's partial rank keeps n of them per task before they move.

    Rows with a null group, a null item, or a null or NaN score take no part; infinite scores count. Groups
    of fewer than n items come out whole. Returns (group, item, score, rank). An empty input gives no rows.
    """
    rows = df.select(F.col(group).alias("g"), F.col(item).alias("i"), F.col(score).cast("double").alias("s")).where("g is not null and i is not null and s is not null and not isnan(s)")
    finite = F.when(F.abs("s") < float("inf"), F.col("s"))
    lo, hi = rows.agg(F.percentile_approx(finite, list(QUANTILES), 1000).alias("q")).first()["q"] or (None, None)
    salts = salts_by_slot(rows, F.col("g"))
    placed = (
        rows.withColumn("salt", salt(F.col("g"), F.col("i"), salts))
        .repartition("g", "salt")
        .groupBy("g", "salt", "i")
        .agg(F.max("s").alias("s"))
    )
    width = (hi - lo) / CELLS if lo is not None and hi > lo else 1.0
    cell = F.floor((F.greatest(F.least(F.col("s"), F.lit(hi)), F.lit(lo)) - F.lit(lo)) / F.lit(width)).cast("int") if lo is not None else F.lit(0)
    placed = placed.withColumn("cell", cell)
    histogram = placed.groupBy("g", "salt", "cell").agg(F.count("*").alias("c")).groupBy("g", "cell").agg(F.sum("c").alias("c"))
    above = F.sum("c").over(Window.partitionBy("g").orderBy(F.desc("cell")))
    threshold = histogram.withColumn("above", above).where(F.col("above") >= n).groupBy("g").agg(F.max("cell").alias("least"))
    threshold = threshold.withColumn("salt", all_salts(F.col("g"), salts) if salts else F.lit(0))
    kept = placed.join(threshold.hint("merge"), ["g", "salt"], "left").where("least is null or cell >= least")
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("s"), "i"))
    return kept.select("g", "i", "s").withColumn("rank", rank).where(F.col("rank") <= n).select(F.col("g").alias(group), F.col("i").alias(item), F.col("s").alias(score), "rank")


