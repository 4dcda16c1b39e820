"""Abbreviations and spellings mined from addresses that agree elsewhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkspan.llm.places import DIRECTIONS, TYPES
from linkspan.plans.durable import durable, release
from linkspan.plans.skew import all_salts, salt, salts_by_slot

#: Least likelihood ratio (G squared; 15.1 is p < 0.0001) and least support of a rewrite.
G2 = 15.1
SUPPORT = 3
#: Most rewrites that go to every task; beyond it words meet them in a join.
IN_MAP = 200_000


def _related(a: str, b: str) -> str:
    """SQL: b may be a short form of a (its letters in order, same first letter) or a misspelling of it."""
    short = f"(length({b}) < length({a}) and substring({a}, 1, 1) = substring({b}, 1, 1) and {a} rlike concat('^', regexp_replace({b}, '(.)', '$1.*')))"
    slip = f"(length({a}) >= 5 and length({b}) >= 5 and levenshtein({a}, {b}, 2) between 1 and 2)"
    return f"({short} or {slip})"


def facing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(lw, rw): the words of two addresses with equal number and postal code, for each pair of distinct writings, between blanks.

    Writings are compared, not records. A number and code with very many records meet in salted pieces.
    """
    short = lambda df, w: df.where("num is not null and code is not null and size(words) > 0").select("num", "code", F.array_join(F.array_sort(F.array_distinct("words")), " ").alias(w)).distinct()
    l, r = short(left, "lw"), short(right, "rw")
    key = F.struct("num", "code")
    salts = salts_by_slot(left.where("num is not null and code is not null").select("num", "code"), key)
    l, r = l.withColumn("salt", salt(key, F.col("lw"), salts)), r.withColumn("salt", all_salts(key, salts) if salts else F.lit(0))
    return l.join(r, ["num", "code", "salt"]).select("lw", "rw")


LEFT_OVER = "lw string, rw string, a string, b string, both string, agree boolean"


def _left_over(lw: str, rw: str, table: dict[str, str]) -> tuple | None:
    x, y = lw.split(" "), rw.split(" ")
    if table:
        x, y = [table.get(w, w) for w in x], [table.get(w, w) for w in y]
        lw, rw = " ".join(x), " ".join(y)
    here, there = dict.fromkeys(x), dict.fromkeys(y)
    a, b = [w for w in here if w not in there], [w for w in there if w not in here]
    if not a or not b:
        return None
    both = [f"{v} {w}" for v in a for w in b if v[0] == w[0] or (len(v) >= 5 and len(w) >= 5 and -2 <= len(v) - len(w) <= 2)]
    return lw, rw, " ".join(a), " ".join(b), "\n".join(both), any(len(w) >= 4 and w in there for w in here)


def left_over(pairs: DataFrame, table: dict[str, str]) -> DataFrame:
    """(lw, rw, a, b, both, agree): the words a and b that two writings, rewritten by the table, don't share, of the pairs in which both have some.

    both has the pairs of a word of each that could be forms of each other, a line for each; agree tells whether the
    writings share a word of four letters or more.
    """
    kinds = [pa.string()] * 5 + [pa.bool_()]

    def run(batches):
        for batch in batches:
            got = [x for lw, rw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (x := _left_over(lw, rw, table))]
            arrays = [pa.array(c, k) for c, k in zip(zip(*got) if got else [()] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split(" ")[0] for x in LEFT_OVER.split(", ")])

    return pairs.select("lw", "rw").mapInArrow(run, LEFT_OVER)


def aligned(now: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b, n), (a, na), (b, nb): in how many pairs of writings the words a and b are left over together, and each at all.

    Words are counted apart from their pairs, and pairs only of words that could be forms of each other, so the work
    goes with the words of an address.
    """
    both = now.where("both <> ''").select(F.explode(F.split("both", "\n")).alias("p")).groupBy("p").agg(F.count("*").alias("n"))
    both = both.select(F.substring_index("p", " ", 1).alias("a"), F.substring_index("p", " ", -1).alias("b"), "n")
    count = lambda c, n: now.select(F.explode(F.split(c, " ")).alias(c)).groupBy(c).agg(F.count("*").alias(n))
    return both, count("a", "na"), count("b", "nb")


def significant(counts: DataFrame, na: DataFrame, nb: DataFrame, total: int, frequency: DataFrame) -> DataFrame:
    """(src, dst) of the word pairs that face each other in far more of the `total` pairs of writings than chance, the best for each src.

    The likelihood ratio sets a pair's count against those of its words. The longer word is the full form;
    of a word and its misspelling, the one that occurs more often. Street types and compass directions in full
    are never rewritten.
    """
    related = counts.where(_related("a", "b") + " or " + _related("b", "a"))
    fixed = F.lit(False)
    for words in (TYPES, DIRECTIONS):
        fixed = fixed | (F.col("a").isin(words) & F.col("b").isin(words))
    x = related.where(~fixed & (F.col("n") >= SUPPORT)).join(na, "a").join(nb, "b")
    expected = F.col("na") * F.col("nb") / F.lit(float(max(total, 1)))
    x = x.withColumn("g2", 2 * F.col("n") * F.log(F.col("n") / expected)).where(F.col("g2") >= G2)
    x = x.join(frequency.select(F.col("word").alias("a"), F.col("f").alias("fa")), "a", "left").join(frequency.select(F.col("word").alias("b"), F.col("f").alias("fb")), "b", "left").fillna(0, ["fa", "fb"])
    slip = "least(length(a), length(b)) >= 4 and levenshtein(a, b, 2) between 1 and 2"
    forward = F.expr(f"case when not ({slip}) and length(a) <> length(b) then length(a) > length(b) else fa > fb or (fa = fb and a < b) end")
    both = x.select(F.when(forward, F.col("b")).otherwise(F.col("a")).alias("src"), F.when(forward, F.col("a")).otherwise(F.col("b")).alias("dst"), "n", F.when(forward, F.col("fb")).otherwise(F.col("fa")).alias("fs"), F.when(forward, F.col("fa")).otherwise(F.col("fb")).alias("fd"))
    # A misspelling is rarer than what it stands for; a short form (at most four letters) need not be.
    both = both.where("length(src) <= 4 or fs * 5 < fd").groupBy("src", "dst").agg(F.sum("n").alias("n"))
    both = both.where(~F.col("src").isin(TYPES + DIRECTIONS))
    best = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("n"), "dst"))
    return both.withColumn("k", best).where("k = 1").select("src", "dst")


def rewrite(df: DataFrame, rules: DataFrame | None, columns: list[str], in_map: int | None = None) -> DataFrame:
    """df with every word that has a rule replaced, in each of the array columns.

    Up to IN_MAP rules go to every task; more of them meet the words in a join.
    """
    if rules is None:
        return df
    if rules.count() <= (IN_MAP if in_map is None else in_map):
        table = {r["src"]: r["dst"] for r in rules.collect()}

        def run(batches):
            for b in batches:
                arrays = list(b.columns)
                for c in columns:
                    i = b.schema.get_field_index(c)
                    col = arrays[i].combine_chunks() if isinstance(arrays[i], pa.ChunkedArray) else arrays[i]
                    words = pa.array([table.get(w, w) for w in col.flatten().to_pylist()], pa.string())
                    sizes = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(col), 0)))]).astype(np.int32)
                    arrays[i] = pa.ListArray.from_arrays(pa.array(sizes), words)
                yield pa.RecordBatch.from_arrays(arrays, names=b.schema.names)

        return df.mapInArrow(run, df.schema)
    df = durable(df.withColumn("_row", F.monotonically_increasing_id()))
    for c in columns:
        words = df.select("_row", F.posexplode(c).alias("pos", "src")).join(rules.select("src", "dst"), "src", "left")
        again = words.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("dst", "src").alias("w")))).alias("l")).select("_row", F.expr("transform(l, x -> x.w)").alias("_words"))
        df = df.join(again, "_row", "left").withColumn(c, F.coalesce("_words", c)).drop("_words")
    return df.drop("_row")


def _rewritten(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """left_over() of pairs rewritten by the rules."""
    if rules.count() <= IN_MAP:
        return left_over(pairs, {r["src"]: r["dst"] for r in rules.collect()})
    lists = rewrite(pairs.select(F.split("lw", " ").alias("lw"), F.split("rw", " ").alias("rw")), rules, ["lw", "rw"])
    return left_over(lists.select(F.array_join("lw", " ").alias("lw"), F.array_join("rw", " ").alias("rw")), {})


def worded(df: DataFrame) -> DataFrame:
    """num, code and words of parsed rows."""
    words = F.when(F.col("line") == "", F.array().cast("array<string>")).otherwise(F.array_remove(F.split("line", " "), "|"))
    return df.select("num", "code", words.alias("words"))


def in_lines(df: DataFrame, key: str, rules: DataFrame) -> tuple[DataFrame, str, dict[str, str]]:
    """Parsed rows, their key and the rules as a table for places.of_line; if they are more than IN_MAP, the rows come rewritten."""
    if rules.count() <= IN_MAP:
        return df, key, {r["src"]: r["dst"] for r in rules.collect()}
    df = rewrite(df.withColumn("line", F.split("line", " ")), rules, ["line"])
    return df.withColumn("line", F.array_join("line", " ")), key, {}


def normalised(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both tables of parsed addresses with words in full form, and the rules (round, src, dst) applied."""
    rules = mined(left, right)
    return rewrite(left, rules, ["words"]), rewrite(right, rules, ["words"]), rules


def mined(left: DataFrame, right: DataFrame) -> DataFrame:
    """(round, src, dst): the rewrites that the addresses (num, code, words) of both sides tell.

    Each round rewrites the writings by the rules found last, matches them again (pairs that agree only by then
    enter, and those of which one side has nothing left over drop out for good), and mines what their left-over words
    tell; it ends when no new rewrite appears. A word is never given a second rule, so the rounds end.
    """
    spark = left.sparkSession
    words = left.select(F.explode("words").alias("word")).unionAll(right.select(F.explode("words").alias("word")))
    frequency = durable(words.groupBy("word").agg(F.count("*").alias("f")).where(F.col("f") >= SUPPORT))
    pairs = durable(left_over(facing(left, right), {}))
    rules, step, turn = None, None, 0
    while True:
        turn += 1
        if step is not None:
            again = durable(_rewritten(pairs, step))
            release(pairs)
            pairs = again
        now = pairs.where("agree")
        found = significant(*aligned(now), now.count(), frequency)
        if rules is not None:
            found = found.join(rules.select("src"), "src", "left_anti")
        found = durable(found.withColumn("round", F.lit(turn)).select("round", "src", "dst"))
        if not found.take(1):
            break
        # A rule whose full form has a rule itself in this round waits for the next.
        step = found.join(found.select(F.col("src").alias("dst")), "dst", "left_anti").select("round", "src", "dst")
        if not step.take(1):
            step = found.orderBy("src").limit(1)
        step = durable(step)
        if rules is None:
            rules = step
        else:  # earlier rules lead on to the new full forms
            onward = step.select(F.col("src").alias("dst"), F.col("dst").alias("_to"))
            rules = durable(rules.join(onward, "dst", "left").select("round", "src", F.coalesce("_to", "dst").alias("dst")).unionByName(step))
    release(pairs, frequency)
    return spark.createDataFrame([], "round int, src string, dst string") if rules is None else rules
