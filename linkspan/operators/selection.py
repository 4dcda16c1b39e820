"""Exact order statistics per key that never bring a key's values together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkspan.plans.durable import durable, release
from linkspan.plans.skew import all_salts, salt, salts_by_slot

#: Characters by which one round narrows the value range of a key.
STEP = 3
#: Most keys whose state is broadcast; beyond it the state meets the rows in a salted shuffle.
MOST_BROADCAST = 100_000
#: Most cells of a key that are ordered in one task; beyond it a round narrows by one character only.
MOST_CELLS = 65_536


def _common(a: str, b: str, most: int = 64) -> str:
    """SQL for the length of the prefix that a and b share, looked for in `most` characters."""
    return (
        f"aggregate(sequence(0, least(char_length({a}), char_length({b}), {most})), 0, "
        f"(acc, i) -> if(i > 0 and acc = i - 1 and substring({a}, i, 1) = substring({b}, i, 1), i, acc))"
    )


def select_by_rank(df: DataFrame, key: str, value: str, num: int = 1, den: int = 2, most_broadcast: int = MOST_BROADCAST, most_cells: int = MOST_CELLS) -> DataFrame:
    """Per key the value at position ceil(n * num / den) of its n distinct values in ascending order.

    Values are strings, ordered by code point. Each round histograms the characters that follow what is
    already known of the answer, with counts that merge before the shuffle, and keeps the cell in which the
    rank falls; a key is done when its cell holds one value. Only counts move, never the values of a key, and a key
    has at most MOST_CELLS of them in one task, or one for each character that follows.

    Returns (key, value, n). Null keys and null values take no part; an empty input gives no rows; the
    empty string is a value; repeated rows count once. Other columns are ignored. num/den must lie in (0, 1].
    """
    if not 0 < num <= den:
        raise ValueError("the position must lie in (0, 1]")
    base = durable(df.select(F.col(key).alias("k"), F.col(value).cast("string").alias("v")).where("k is not null and v is not null").distinct())
    state = durable(
        base.groupBy("k")
        .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .withColumn("rank", F.floor((F.col("n") * num + (den - 1)) / den).cast("long"))
        .withColumn("prefix", F.expr(f"substring(lo, 1, {_common('lo', 'hi')})"))
        .select("k", "n", "rank", "prefix", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("answer"))
    )
    few = state.count() <= most_broadcast
    salts = {} if few else salts_by_slot(base, F.col("k"))
    done = state.where("answer is not null")
    state = state.where("answer is null")
    while state.take(1):
        s = state.select("k", "n", "rank", "prefix")
        if few:
            met = base.join(F.broadcast(s), "k")
        else:
            salted = s.withColumn("salt", all_salts(F.col("k"), salts))
            met = base.withColumn("salt", salt(F.col("k"), F.col("v"), salts)).join(salted, ["k", "salt"])
        for step in (STEP, 1):
            cells = durable(
                met.where("startswith(v, prefix)")
                .withColumn("cell", F.expr(f"substring(v, char_length(prefix) + 1, {step})"))
                .groupBy("k", "cell")
                .agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.first("n").alias("n"), F.first("rank").alias("rank"), F.first("prefix").alias("prefix"))
            )
            if step == 1 or not cells.groupBy("k").count().where(F.col("count") > most_cells).take(1):
                break
            release(cells)
        upto = F.sum("c").over(Window.partitionBy("k").orderBy("cell"))
        at = cells.withColumn("upto", upto).where("upto >= rank and upto - c < rank")
        rest = "substring(lo, char_length(prefix) + 1)", "substring(hi, char_length(prefix) + 1)"
        state = durable(
            at.select(
                "k", "n", F.expr("rank - (upto - c)").alias("rank"),
                F.expr(f"substring(lo, 1, char_length(prefix) + {_common(*rest)})").alias("prefix"),
                F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("answer"),
            )
        )
        release(cells)
        done = done.unionByName(state.where("answer is not null"))
        state = state.where("answer is null")
    release(base)
    return done.select(F.col("k").alias(key), F.col("answer").alias(value), "n")


def key_statistics(df: DataFrame, key: str, entity: str, name: str) -> DataFrame:
    """Per key: records (distinct entities), distinct non-null names and the middle entity.

    Distinct values are counted in two steps, first by (key, value) and then by key, so a hot key is spread
    over all tasks until only counts are left. A key whose names are all null has 0 distinct names.
    """
    names = (
        df.where(F.col(key).isNotNull() & F.col(name).isNotNull()).select(F.col(key), F.col(name).alias("_v")).distinct()
        .groupBy(key).agg(F.count("*").alias("distinct_names"))
    )
    middle = select_by_rank(df, key, entity)
    return (
        middle.join(names, key, "left")
        .select(key, F.col("n").alias("records"), F.coalesce("distinct_names", F.lit(0)).cast("long").alias("distinct_names"), F.col(entity).alias("middle_entity_id"))
    )
