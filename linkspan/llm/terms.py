"""Frequency of every term and n-gram of terms."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkspan.plans.durable import durable

#: A term: a maximal run of ASCII letters and digits.
TERM = "[A-Za-z0-9]+"
#: Intervals that are held before they go out.
CHUNK = 20_000


def suffixes(df: DataFrame, record: str, fields: list[str], n: int | None) -> DataFrame:
    """(field, suffix, dup, occ): the distinct suffixes, whole or of n terms at most, with multiplicities.

    Within a record the suffixes are sorted, and each knows how many leading terms it shares with the one
    before it in the same record: dup. The suffix is the terms joined by blanks, which sort before any
    term's characters, so string order is the order of the suffix array.
    """
    field = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")
    terms = df.select(record, field).select("x.field", F.transform(F.expr(f"regexp_extract_all(x.value, '{TERM}', 0)"), F.lower).alias("t")).where("size(t) > 0")
    sorted_ = terms.select("field", F.expr(f"array_sort(transform(sequence(1, size(t)), i -> slice(t, i, {n or 'size(t)'})))").alias("s"))
    apart = "filter(sequence(0, least(size(x), size(s[i - 1])) - 1), k -> x[k] <> s[i - 1][k])"
    shared = f"coalesce(get({apart}, 0), least(size(x), size(s[i - 1])))"
    pairs = sorted_.select("field", F.explode(F.expr(f"transform(s, (x, i) -> struct(array_join(x, ' ') as suffix, if(i = 0, 0, {shared}) as dup))")).alias("p"))
    return pairs.groupBy("field", "p.suffix", "p.dup").agg(F.count("*").alias("occ"))


_FOUND = [("field", pa.string()), ("n", pa.int32()), ("term", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64()), ("cut", pa.bool_())]


def intervals(batches):
    """Scan of a sorted run of suffixes: an interval per prefix of whole terms, with its counts.

    A stack holds the open intervals of the last suffix, one a term; counts go to the deepest they hold for and
    are handed up when an interval closes. `cut`: it reaches an end of the run, so its neighbour may hold more of it.
    """
    out: list[list] = [[] for _ in _FOUND]
    field, terms, ends, suffix = None, [], [0], ""
    occ, dup, cut = [0], [0], [True]

    def close(depth: int, last: bool) -> None:
        while len(occ) > depth + 1:
            k, o, d, c = len(occ) - 1, occ.pop(), dup.pop(), cut.pop()
            for column, value in zip(out, (field, k, suffix[: ends[k]], o, o - d, c or last)):
                column.append(value)
            occ[-1] += o
            dup[-1] += d

    def flushed():
        batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(out, _FOUND)], names=[name for name, _ in _FOUND])
        for column in out:
            column.clear()
        return batch

    first = True
    for b in batches:
        for f, x, d, count in zip(*(b.column(name).to_pylist() for name in ("field", "suffix", "dup", "occ"))):
            new = x.split(" ")
            shared = 0
            if f == field:
                for left, right in zip(terms, new):
                    if left != right:
                        break
                    shared += 1
            close(shared, False)
            field, terms, suffix, ends = f, new, x, [0]
            at = -1
            for t in new:
                at += len(t) + 1
                ends.append(at)
            opened = len(new) - shared
            occ += [0] * opened
            dup += [0] * opened
            cut += [first] * opened
            first = False
            occ[-1] += count
            dup[d] += count
            if len(out[0]) >= CHUNK:
                yield flushed()
    close(0, True)
    yield flushed()


def term_frequencies(df: DataFrame, record: str, fields: list[str], n: int | None = 3) -> DataFrame:
    """(field, n, term, occurrences, records) of every n-gram of 1 to n terms, per field; of every length if n is None.

    A suffix array of the collection, cut into ranges: the distinct suffixes are ranged and sorted over all
    tasks, neighbours' common-prefix lengths delimit the interval of each n-gram, and the interval's
    multiplicities add up to its occurrences. A record in which the n-gram occurs m times contributes m
    suffixes to the interval, of which m - 1 follow another of the same record: those are the duplicate
    adjacencies counted beforehand within the record, and taking them off leaves the number of records.
    Intervals that a range boundary cuts are put together by a last sum; the others are whole.

    df must hold one row per record. Null and termless values have no terms. Frequent suffixes are added up
    before they move, so no task grows with a term's frequency. Without n, a value of m terms has m (m + 1) / 2
    n-grams, so values should be short. An empty input gives no rows.
    """
    spread = suffixes(df, record, fields, n)
    ordered = spread.repartitionByRange("field", "suffix").sortWithinPartitions("field", "suffix")
    found = durable(ordered.mapInArrow(intervals, "field string, n int, term string, occurrences long, records long, cut boolean"))
    cut = found.where("cut").groupBy("field", "n", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    return found.where("not cut").drop("cut").unionByName(cut)


def marked(frequencies: DataFrame, total: int, one_in: int = 50) -> DataFrame:
    """mark: rare if one record has the term, common if more than one in `one_in` of `total` has it, else null."""
    mark = F.when(F.col("records") == 1, "rare").when(F.col("records") * one_in > total, "common")
    return frequencies.withColumn("mark", mark)
