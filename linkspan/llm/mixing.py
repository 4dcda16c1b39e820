"""Mixing sources to target weights."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkspan.llm.bpe import token_counts
from linkspan.plans.durable import durable

#: Levels of the hashed uniform number of each document.
BINS = 4096
#: Most sources that a mixture may name; the targets are a hand-written table.
MOST_SOURCES = 10_000


def _bin(key: str, seed: int):
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(BINS)).cast("int")


def thresholds(rate: float, cap: int) -> list[int]:
    """Least bin from which a document has 1, 2 ... cap copies, by inverting Poisson(rate) at (bin + 0.5) / BINS.

    A value beyond cap counts as cap. A bin of BINS is never reached. An infinite rate gives cap copies each.
    """
    if cap <= 0 or rate <= 0:
        return [BINS] * max(cap, 0)
    if math.isinf(rate):
        return [0] * cap
    out, cdf = [], 0.0
    for k in range(cap):
        cdf += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        out.append(min(BINS, max(0, math.ceil(cdf * BINS - 0.5))))
    return out


def _reached(sizes: list[float], rate: float, cap: int) -> float:
    """Tokens that the source yields at this rate; sizes: tokens by bin."""
    return sum(sum(sizes[t:]) for t in thresholds(rate, cap))


def solve_rate(sizes: list[float], wanted: float, cap: int) -> float:
    """The Poisson rate at which min(count, cap) copies of each document add up to `wanted` tokens.

    Counts by inversion never fall as the rate grows, so the yield is monotone and bisection finds the rate;
    of the two sides of the last step the nearer one is taken. Wanting all that cap copies give, or more,
    gives an infinite rate.
    """
    most = sum(sizes) * cap
    if wanted <= 0 or most <= 0:
        return 0.0
    if wanted >= most * (1 - 1e-9):
        return math.inf
    lo, hi = 0.0, 1.0
    while _reached(sizes, hi, cap) < wanted and hi < 1e6:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        if _reached(sizes, mid, cap) < wanted:
            lo = mid
        else:
            hi = mid
    return min((lo, hi), key=lambda r: abs(_reached(sizes, r, cap) - wanted))


class Mixture:
    """Plan of a mixture: rates and thresholds by source, from token counts of all documents."""

    def __init__(self, docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", total: float | None = None, seed: int = 42, path: str | None = None) -> None:
        spark = docs.sparkSession
        rows = targets.where("source is not null").select("source", F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(0)).alias("cap")).limit(MOST_SOURCES + 1).collect()
        if len(rows) > MOST_SOURCES:
            raise ValueError("too many sources in the targets")
        self.targets = {r["source"]: (max(0.0, r["share"]), max(0, r["cap"])) for r in rows}
        self.docs, self.key, self.text, self.seed = docs, key, text, seed
        named = docs.where(F.col("source").isin(list(self.targets))) if self.targets else docs.limit(0)
        both = F.struct(F.col(key).alias("k"), F.col("source").alias("s")).alias("key")
        self.sizes = durable(token_counts(named.select(both, text), "key", text, path).select("key.k", "key.s", "n_tokens").withColumn("bin", _bin("k", seed)))
        by_bin = {s: [0.0] * BINS for s in self.targets}
        for r in self.sizes.groupBy("s", "bin").agg(F.sum("n_tokens").alias("n")).collect():  # at most sources x BINS rows
            by_bin[r["s"]][r["bin"]] += r["n"]
        full = {s: sum(v) for s, v in by_bin.items()}
        live = {s: share for s, (share, cap) in self.targets.items() if share > 0 and cap > 0 and full[s] > 0}
        scale = sum(live.values()) or 1.0
        self.attainable = {s: live.get(s, 0.0) / scale for s in self.targets}
        most = min((full[s] * self.targets[s][1] / self.attainable[s] for s in live), default=0.0)
        self.total = most if total is None else min(total, most)
        self.rates = {s: solve_rate(by_bin[s], self.attainable[s] * self.total, self.targets[s][1]) if s in live else 0.0 for s in self.targets}
        kind = T.StructType([T.StructField("source", T.StringType()), T.StructField("steps", T.ArrayType(T.IntegerType()))])
        self.steps = spark.createDataFrame([(s, thresholds(self.rates[s], self.targets[s][1])) for s in self.targets], kind)

    def _copies(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.steps), "source").withColumn("copies", F.size(F.filter("steps", lambda t: F.col("bin") >= t))).drop("steps")

    def records(self) -> DataFrame:
        """(key, source, copy, position, text): every document as often as drawn, in shuffled order.

        position is a hash of document and copy; ordering by it is the global shuffle.
        """
        docs = self.docs.select(F.col(self.key), "source", F.col(self.text)).where("source is not null").withColumn("bin", _bin(self.key, self.seed))
        drawn = self._copies(docs).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        placed = drawn.select(self.key, "source", "copy", F.xxhash64(F.col(self.key), F.col("copy"), F.lit(self.seed + 1)).alias("position"), self.text)
        return placed.repartitionByRange("position").sortWithinPartitions("position")

    def report(self) -> DataFrame:
        """One row per target: documents, copies, tokens, wanted and reached share, and the most copies of a document."""
        spark = self.docs.sparkSession
        kind = "source string, target_share double, attainable_share double, max_repeats int, rate double"
        rows = [(s, share, self.attainable[s], cap, self.rates[s]) for s, (share, cap) in self.targets.items()]
        sizes = self._copies(self.sizes.withColumnRenamed("s", "source"))
        used = sizes.groupBy("source").agg(
            F.count("*").alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum("n_tokens").alias("source_tokens"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"),
        )
        total = float(used.agg(F.sum("tokens")).first()[0] or 1)
        out = spark.createDataFrame(rows, kind).join(used, "source", "left")
        out = out.withColumn("actual_share", F.coalesce(F.col("tokens") / F.lit(total), F.lit(0.0)))
        return out.fillna(0, ["documents", "copies", "most_copies", "source_tokens", "tokens"])


def mix_sources(docs: DataFrame, targets: DataFrame, **options) -> Mixture:
    """Combine the documents of several sources in target shares of size.

    Sizes are tokens of byte_bpe_50k. Each document's number of copies is a Poisson count with the source's
    mean repetition rate, drawn by inverting the distribution at a number hashed from seed and key, and never
    above max_repeats. The rate of each source is solved so that the counts drawn in fact add up to the
    wanted tokens. The total is the largest at which every source that has documents can reach its share
    (or `total`, where that is less).

    Documents with a null source, or one that isn't a target, stay out. A target without documents or with
    no repeats gets nothing and the others share what it leaves, in proportion; the report shows both. Null
    and empty texts have size 0 and are drawn like others. Empty tables give no records. Rows that
    share a key are drawn alike.
    """
    return Mixture(docs, targets, **options)
