"""Queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkspan.llm.bpe import encode_corpus
from linkspan.llm.encoding import repairs
from linkspan.llm.ids import canonical_id
from linkspan.llm.linkage import link
from linkspan.llm.mixing import mix_sources
from linkspan.llm.places_match import prepared, same_places
from linkspan.llm.residue import residue
from linkspan.llm.splits import assign_rows, assigned, components, kept_together, members, report, split_components
from linkspan.llm.terms import marked, term_frequencies
from linkspan.llm.topn import top_n
from linkspan.plans.durable import durable
from linkspan.sources.tables import records, table

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def p1_repairs(spark, d):
    return repairs(records(spark, d, "test_source2"), "entity_id", ["business_name", "business_address"])


def p1_found(spark, d):
    return p1_repairs(spark, d).select("entity_id", "field")


def p2_found(spark, d):
    pairs = table(spark, d, "candidate_pairs").select(canonical_id(F.col("source1_entity_id")).alias("source1_entity_id"), "candidate_entity_id", "total_priority")
    return top_n(pairs, "source1_entity_id", "candidate_entity_id", "total_priority", 10).select("source1_entity_id", "candidate_entity_id")


def _terms(spark, d, n):
    rows = records(spark, d, "test_source2")
    return marked(term_frequencies(rows, "entity_id", ["business_name", "business_address"], n), rows.count())


def p3_found(spark, d):
    return _terms(spark, d, 1).where("mark is not null").select("field", "term", "mark")


def p3_ngrams(spark, d):
    return _terms(spark, d, None).select("field", "n", "term", "occurrences", "records", "mark")


def p4_matches(spark, d):
    left = records(spark, d, "test_source1").withColumnRenamed("entity_id", "id")
    right = records(spark, d, "test_source2").unionByName(records(spark, d, "test_source3")).withColumnRenamed("entity_id", "id")
    return link(left, right).select(F.col("l_id").alias("source1_entity_id"), F.col("r_id").alias("candidate_entity_id"), "confidence")


def p4_found(spark, d):
    return p4_matches(spark, d).drop("confidence")


def _members(spark, d):
    return members(table(spark, d, "candidate_pairs"), canonical_id(F.col("source1_entity_id")), "source1_entity_id", F.col("fired_chan_a") == 1)


def _splits(spark, d):
    return split_components(components(_members(spark, d)), SHARES)


def _assigned(spark, d):
    stored = _members(spark, d)
    return assigned(stored, split_components(components(stored), SHARES))


def p5_found(spark, d):
    return kept_together(_assigned(spark, d)).select(F.col("id").alias("source1_entity_id"))


def p5_report(spark, d):
    return report(_assigned(spark, d), SHARES)


def p5_check(spark, d):
    """One row of what must hold of the assignment: all rows with an id placed, no id torn apart, shares of rows and labels within 0.001."""
    placed = durable(_assigned(spark, d))
    torn = placed.groupBy("id").agg(F.countDistinct("split").alias("n")).where("n > 1").count()
    off = F.greatest(F.abs(F.col("row_share") - F.col("target")), F.abs(F.col("label_share") - F.col("target")))
    return report(placed, SHARES).agg(F.sum("rows").alias("rows"), F.sum("positives").alias("positives"), F.count("*").alias("splits"), F.lit(torn).alias("torn"), (F.max(off) <= 0.001).alias("within"))


def p5_splits(spark, d):
    return _splits(spark, d).select(F.col("id").alias("source1_entity_id"), "rows", "positives", "forms", "split")


def p5_rows(spark, d):
    pairs = table(spark, d, "candidate_pairs").select("source1_entity_id", "candidate_entity_id", "total_priority", "batch_date")
    return assign_rows(pairs, canonical_id(F.col("source1_entity_id")), _splits(spark, d), SHARES, "candidate_entity_id")


def _addresses(spark, d, name):
    return records(spark, d, name).select(F.col("entity_id").alias("id"), "business_address")


def p7_found(spark, d):
    pairs = same_places(_addresses(spark, d, "test_source1"), _addresses(spark, d, "test_source3"))
    return pairs.select(F.col("l_id").alias("source1_entity_id"), F.col("r_id").alias("source3_entity_id"))


def p7_rewrites(spark, d):
    return prepared(_addresses(spark, d, "test_source1"), _addresses(spark, d, "test_source3"))[2]


def p8_ids(spark, d):
    return encode_corpus(table(spark, d, "documents"))


def p9_mix(spark, d):
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets")).records()


def p9_report(spark, d):
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets")).report()


def p10_reasons(spark, d):
    return residue(table(spark, d, "documents"))


def p10_found(spark, d):
    return p10_reasons(spark, d).select("doc_id")


def p10_kept(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return docs.join(p10_found(spark, d), "doc_id", "left_anti")


QUERIES = {
    "p1_found": p1_found,
    "p1_repairs": p1_repairs,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_ngrams": p3_ngrams,
    "p4_found": p4_found,
    "p4_matches": p4_matches,
    "p5_found": p5_found,
    "p5_splits": p5_splits,
    "p5_rows": p5_rows,
    "p5_report": p5_report,
    "p5_check": p5_check,
    "p7_found": p7_found,
    "p7_rewrites": p7_rewrites,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_report": p9_report,
    "p10_found": p10_found,
    "p10_reasons": p10_reasons,
    "p10_kept": p10_kept,
}

#: The number follows the prefix, which may stand without a separator: the prefix goes first.
_CANONICAL = r"""'S1-' || lpad(ltrim(regexp_extract(regexp_replace(source1_entity_id, '^\s*[sS]1', ''), '([0-9]+)', 1), '0'), 9, '0')"""

_TERMS = """
  r AS (SELECT DISTINCT entity_id, business_name, business_address FROM test_source2 WHERE entity_id IS NOT NULL),
  f AS (SELECT entity_id, 'business_name' AS field, business_name AS v FROM r UNION ALL SELECT entity_id, 'business_address', business_address FROM r),
  l AS (SELECT entity_id, field, list_transform(regexp_extract_all(v, '[A-Za-z0-9]+'), lambda x: lower(x)) AS t FROM f WHERE v IS NOT NULL),
  p AS (SELECT entity_id, field, t, unnest(range(1, len(t) + 1)) AS i FROM l),
  g AS (SELECT entity_id, field, k AS n, array_to_string(t[i:i + k - 1], ' ') AS term FROM (SELECT *, unnest(range(1, len(t) - i + 2)) AS k FROM p)),
  c AS (SELECT field, CAST(n AS INT) AS n, term, count(*) AS occurrences, count(DISTINCT entity_id) AS records FROM g GROUP BY ALL),
  m AS (SELECT *, CASE WHEN records = 1 THEN 'rare' WHEN records * 50 > (SELECT count(DISTINCT entity_id) FROM test_source2) THEN 'common' END AS mark FROM c)"""

SQL = {
    "p2_found": f"""
WITH p AS (SELECT {_CANONICAL} AS source1_entity_id, candidate_entity_id, max(total_priority) AS s FROM candidate_pairs
  WHERE source1_entity_id IS NOT NULL AND candidate_entity_id IS NOT NULL AND total_priority IS NOT NULL AND NOT isnan(total_priority) GROUP BY ALL)
SELECT source1_entity_id, candidate_entity_id FROM p
QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY s DESC, candidate_entity_id) <= 10""",
    "p3_found": f"WITH {_TERMS} SELECT field, term, mark FROM m WHERE n = 1 AND mark IS NOT NULL",
    "p3_ngrams": f"WITH {_TERMS} SELECT field, n, term, occurrences, records, mark FROM m",
    "p5_check": "SELECT count(*) AS rows, CAST(sum(CASE WHEN fired_chan_a = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives, 3 AS splits, 0 AS torn, true AS within FROM candidate_pairs WHERE source1_entity_id IS NOT NULL",
    "p5_found": f"SELECT {_CANONICAL} AS source1_entity_id FROM candidate_pairs WHERE source1_entity_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source1_entity_id) > 1",
}
