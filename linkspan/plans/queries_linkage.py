"""Queries of the record-linkage pipeline, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from linkspan.operators.blocking import ADDRESS_STOPWORDS, CHANNELS, Blocking, candidate_tokens, channel_pairs, generate_candidates, keyed, rare_tokens
from linkspan.functions import regexes as R
from linkspan.functions import text as T
from linkspan.functions.normalise import address_columns, name_columns, normalise_records
from linkspan.operators.features import CHANNEL_FLAGS, FEATURES, GROUPS, attach_labels, feature_catalog, pair_features, provenance, split_groups
from linkspan.operators.metrics import confusion, entity_metrics, evaluate, macro_by_group, ranking
from linkspan.operators.model import MatchModel
from linkspan.operators.resolve import affinity, resolve
from linkspan.operators.validate import findings, first_offenders, outside
from linkspan.plans import blocking_sql, feature_sql, normal_sql, resolve_sql
from linkspan.plans.durable import durable, shared_dir
from linkspan.sources import tsv
from linkspan.sources.tables import records, table

CAP = 150


def pool(spark, d):
    """The candidates: both noisy sources, a bag union."""
    return records(spark, d, "test_source2").unionByName(records(spark, d, "test_source3"))


def _channel(c):
    def query(spark, d):
        return channel_pairs(records(spark, d, "test_source1"), pool(spark, d), Blocking(cap=CAP, channels=[c]))[c]

    return query


def _candidate_keys(spark, d):
    return keyed(pool(spark, d), "candidate_id", Blocking()).where("country is not null")


def rare_name_tokens(spark, d):
    return rare_tokens(candidate_tokens(_candidate_keys(spark, d), "name_tokens", 4), (2, 100))


def rare_addr_tokens(spark, d):
    return rare_tokens(candidate_tokens(_candidate_keys(spark, d), "address_tokens", 5, ADDRESS_STOPWORDS), (2, 100))


def rare_del_keys(spark, d):
    return _candidate_keys(spark, d).where("tail is not null").groupBy("country", F.col("tail").alias("del_key")).agg(F.count("*").alias("n")).where("n between 2 and 100")


def rare_ngrams(spark, d):
    keys = _candidate_keys(spark, d).where("ends is not null").select("country", F.col("ends.first").alias("p4"), F.col("ends.last").alias("s4"))
    return keys.groupBy("country", "p4", "s4").agg(F.count("*").alias("n")).where("n between 2 and 50")


def candidates_ranked(spark, d):
    return generate_candidates(records(spark, d, "test_source1"), pool(spark, d), Blocking(cap=CAP))


def candidates_cap5(spark, d):
    return generate_candidates(records(spark, d, "test_source1"), pool(spark, d), Blocking(cap=5))


def channel_coverage(spark, d):
    """Per channel: pairs that it fired for, distinct records on either side."""
    pairs = candidates_ranked(spark, d)
    flags = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"fired_chan_{c}").alias("fired")) for c in CHANNELS])).alias("x")
    fired = pairs.select("source1_entity_id", "candidate_entity_id", flags).where("x.fired = 1")
    return fired.groupBy("x.channel").agg(F.count("*").alias("pairs"), F.countDistinct("source1_entity_id").alias("s1_records"), F.countDistinct("candidate_entity_id").alias("candidates"))


QUERIES = {f"chan_{c}": _channel(c) for c in CHANNELS} | {
    "rare_name_tokens": rare_name_tokens,
    "rare_addr_tokens": rare_addr_tokens,
    "rare_del_keys": rare_del_keys,
    "rare_ngrams": rare_ngrams,
    "candidates_ranked": candidates_ranked,
    "candidates_cap5": candidates_cap5,
    "channel_coverage": channel_coverage,
}

_FLAGS = " UNION ALL ".join(f"SELECT '{c}' AS channel, source1_entity_id AS s, candidate_entity_id AS c FROM r WHERE fired_chan_{c} = 1" for c in CHANNELS)
SQL = {f"chan_{c}": f"{blocking_sql.BASE} {blocking_sql.channel(c, CAP)}" for c in CHANNELS} | {
    "rare_name_tokens": f"{blocking_sql.BASE} SELECT * FROM rare_n",
    "rare_addr_tokens": f"{blocking_sql.BASE} SELECT * FROM rare_a",
    "rare_del_keys": f"{blocking_sql.BASE} SELECT * FROM rare_g",
    "rare_ngrams": f"{blocking_sql.BASE} SELECT * FROM rare_c",
    "candidates_ranked": blocking_sql.candidates(CAP),
    "candidates_cap5": blocking_sql.candidates(5),
    "channel_coverage": f"WITH r AS ({blocking_sql.candidates(CAP)}), f AS ({_FLAGS}) SELECT channel, count(*) AS pairs, count(DISTINCT s) AS s1_records, count(DISTINCT c) AS candidates FROM f GROUP BY 1",
}


# --- lists, exports and pruning -----------------------------------------------------------------------------


def _pairs(spark, d):
    """The stored candidate pairs, each once."""
    return table(spark, d, "candidate_pairs").select("source1_entity_id", "candidate_entity_id").where("source1_entity_id is not null and candidate_entity_id is not null").distinct()


def _truth(spark, d):
    return table(spark, d, "match_labels").where("match_label = 1").select("source1_entity_id", "candidate_entity_id").distinct()


def export_pairs_validated(spark, d):
    return tsv.valid_pairs(_pairs(spark, d), records(spark, d, "test_source1"), pool(spark, d))


def export_lists(spark, d):
    return tsv.as_lists(_pairs(spark, d), records(spark, d, "test_source1"), "candidate_entity_ids")


def reload_lists(spark, d):
    return tsv.from_lists(export_lists(spark, d).withColumnRenamed("candidate_entity_ids", "ids"))


def pool_semi(spark, d):
    return tsv.pruned(pool(spark, d), _pairs(spark, d))


# --- features -----------------------------------------------------------------------------------------------


def features_all(spark, d):
    pairs = generate_candidates(records(spark, d, "test_source1"), pool(spark, d), Blocking(cap=CAP))
    return pair_features(pairs, records(spark, d, "test_source1"), pool(spark, d))


def _group(*groups):
    def query(spark, d):
        x = pair_features(_pairs(spark, d), records(spark, d, "test_source1"), pool(spark, d))
        return x.select("source1_entity_id", "candidate_entity_id", *[c for g in groups for c in GROUPS[g]])

    return query


def feat_country(spark, d):
    return _group("country")(spark, d)


def feat_provenance(spark, d):
    pairs = table(spark, d, "candidate_pairs")
    return pairs.select("source1_entity_id", "candidate_entity_id", *[c.alias(n) for n, c in provenance(pairs.columns).items()])


def feat_source(spark, d):
    return _group("source")(spark, d)


NAME_TOKENS = [c for c in GROUPS["name"] if "token" in c or c in ("name_raw_exact", "name_alphanumeric_exact", "name_length_diff", "business_word_overlap_count", "name_both_latin", "name_cross_script", "name_has_non_ascii", "name_missing_either")]


def feat_name_tokens(spark, d):
    return _group("name")(spark, d).select("source1_entity_id", "candidate_entity_id", *NAME_TOKENS)


def labels_attach(spark, d):
    return attach_labels(_pairs(spark, d), _truth(spark, d))


def split_group_sizes(spark, d):
    """Distinct S1 records in either part of the grouped split."""
    return split_groups(_pairs(spark, d)).groupBy("split_group").agg(F.countDistinct("source1_entity_id").alias("s1_records"))


# --- text ---------------------------------------------------------------------------------------------------


def _texts(spark, d):
    return pool(spark, d).unionByName(records(spark, d, "test_source1"))


def numeric_tokens(spark, d):
    return _texts(spark, d).where("business_address is not null").select("entity_id", F.array_join(F.array_sort(T.numbers(F.col("business_address"))), ",").alias("numbers"), F.coalesce(T.first_number(F.col("business_address")), F.lit("")).alias("first_number"))


def postal_codes(spark, d):
    return _texts(spark, d).where("business_address is not null").select("entity_id", F.array_join(F.array_sort(T.postal_codes(F.col("business_address"))), ",").alias("codes"))


def tokens_norm(spark, d):
    words = F.transform(T.words(F.col("business_name"), 2), lambda w: F.translate(w, "ς", "σ"))
    return _texts(spark, d).where("business_name is not null").select("entity_id", F.array_join(words, " ").alias("tokens"))


def char_ngrams(spark, d):
    grams = T.trigrams(T.ascii_alnum(T.lowered(F.col("business_name"))))
    return _texts(spark, d).where("business_name is not null").select("entity_id", F.array_join(F.array_sort(grams), ",").alias("grams"))


def script_detect(spark, d):
    return _texts(spark, d).select("entity_id", T.script(F.col("business_name")).alias("script"))


def legal_strip(spark, d):
    low = T.lowered(T.trimmed(F.col("business_name")))
    return _texts(spark, d).where("business_name is not null").select("entity_id", F.regexp_replace(low, R.LEGAL_ASCII, "").alias("core"), F.regexp_replace(low, R.PREFIX_ASCII, "").alias("no_prefix"))


def normalised_records(spark, d):
    return normalise_records(_texts(spark, d))


def _flat(df):
    return df.select(*[F.array_join(c, "|").alias(c) if k.startswith("array") else c for c, k in df.dtypes])


def normalised_names(spark, d):
    return _flat(name_columns(_texts(spark, d), "business_name", ["entity_id"]))


def normalised_addresses(spark, d):
    return _flat(address_columns(_texts(spark, d), "business_address", ["entity_id"]))


# --- resolve, metrics, checks -------------------------------------------------------------------------------


def resolve_affinity(spark, d):
    return affinity(_pairs(spark, d), records(spark, d, "test_source1"), pool(spark, d))


def resolve_exclusive(spark, d):
    return resolve(_pairs(spark, d), records(spark, d, "test_source1"), pool(spark, d), most=None)


def resolve_cap(spark, d):
    return resolve(_pairs(spark, d), records(spark, d, "test_source1"), pool(spark, d), strict_cap=True)


def _scored(spark, d):
    """Candidate pairs with a score from 0 to 1: the highest priority of a pair as a share of the highest of all."""
    pairs = table(spark, d, "candidate_pairs").where("source1_entity_id is not null and total_priority is not null and not isnan(total_priority)")
    best = pairs.groupBy("source1_entity_id", "candidate_entity_id").agg(F.max("total_priority").alias("p"))
    top = best.agg(F.max("p")).first()[0] or 1.0
    return best.select("source1_entity_id", "candidate_entity_id", (F.col("p") / F.lit(top)).alias("score"))


def s1_metrics(spark, d):
    predicted = _scored(spark, d).where("score >= 0.1")
    return entity_metrics(records(spark, d, "test_source1").withColumnRenamed("entity_id", "source1_entity_id"), predicted, _truth(spark, d))


def macro_f05(spark, d):
    return evaluate(_scored(spark, d), _truth(spark, d), 0.1)


def macro_groups(spark, d):
    return macro_by_group(s1_metrics(spark, d))


def _labelled(spark, d):
    labels = table(spark, d, "match_labels").where("match_label is not null").groupBy("source1_entity_id", "candidate_entity_id").agg(F.max("match_label").alias("label"))
    return labels.join(_scored(spark, d), ["source1_entity_id", "candidate_entity_id"]).select("label", "score")


def pair_confusion(spark, d):
    return confusion(_labelled(spark, d), 0.1)


def pair_auc(spark, d):
    return ranking(_labelled(spark, d))


def pair_auc_all(spark, d):
    """All scored candidate pairs against the reviewed matches."""
    return ranking(attach_labels(_scored(spark, d), _truth(spark, d)).select(F.col("match_label").alias("label"), "score"))


def validate_findings(spark, d):
    lists = _pairs(spark, d).groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("candidate_entity_id")), ",").alias("ids"))
    return findings(lists, records(spark, d, "test_source1"), pool(spark, d))


def validate_unchecked(spark, d):
    """Findings of lists as a careless writer leaves them: one for each record and candidate source, repeats kept."""
    pairs = table(spark, d, "candidate_pairs").where("source1_entity_id is not null and candidate_entity_id is not null")
    lists = pairs.groupBy("source1_entity_id", F.left("candidate_entity_id", F.lit(2)).alias("source")).agg(F.array_join(F.collect_list("candidate_entity_id"), ",").alias("ids"))
    return findings(lists, records(spark, d, "test_source1"), pool(spark, d))


def validate_examples(spark, d):
    """The first five offenders of each rule, as a report shows them."""
    return first_offenders(validate_unchecked(spark, d), 5)


def tsv_source(spark, d):
    """A source written as a tab-separated file and read again; tabs and line ends of its texts are blanks there."""
    path = f"{shared_dir(spark)}/linkspan-tsv-{uuid.uuid4().hex}"
    flat = [F.regexp_replace(c, r"[\t\n\r\x0B\f\x85\x{2028}\x{2029}]", " ").alias(c) for c in ("entity_id", "business_name", "business_address", "country")]
    tsv.write_tsv(records(spark, d, "test_source3").select(*flat), path)
    return tsv.read_source(spark, path + "/*.csv")


def smallest_ids(spark, d):
    """A limited scan in order."""
    return tsv.limited(records(spark, d, "test_source1"), 50).orderBy("entity_id").select("entity_id", "country")


def validate_subset(spark, d):
    return outside(_truth(spark, d), _pairs(spark, d))


# --- models -------------------------------------------------------------------------------------------------


def _training(spark, d):
    labels = table(spark, d, "match_labels").where("match_label is not null").groupBy("source1_entity_id", "candidate_entity_id").agg(F.max("match_label").alias("match_label"))
    return pair_features(labels, records(spark, d, "test_source1"), pool(spark, d)).join(labels, ["source1_entity_id", "candidate_entity_id"])


def _held_out(spark, d):
    """(training rows, held-out rows) of the reviewed pairs, whole records to either side."""
    data = durable(split_groups(_training(spark, d)))
    return data.where("split_group = 'train'"), data.where("split_group = 'val'")


def _fitted(kind, train, held):
    return MatchModel(kind).fit(train, held if kind.startswith("xgboost") else None)


def _model(kind):
    """Scores of the held-out pairs by a model of the operator's own size."""

    def query(spark, d):
        train, held = _held_out(spark, d)
        return _fitted(kind, train, held).predict(held).select("source1_entity_id", "candidate_entity_id", "match_label", "score", "is_match")

    return query


def model_importances(spark, d):
    return _fitted("random_forest", *_held_out(spark, d)).importances(spark)


#: Both kinds of boosted trees are one estimator.
CHECKED_KINDS = ("logistic_regression", "xgboost_weighted", "random_forest")


def model_checks(spark, d):
    """What must hold of each kind of model over all reviewed pairs, whatever it has learned."""
    train, held = _held_out(spark, d)
    out = None
    for kind in CHECKED_KINDS:
        model = _fitted(kind, train, held)
        scored = model.predict(train.unionByName(held), 0.5)
        total = model.importances(spark).agg(F.sum("importance")).first()[0]
        one = scored.agg(
            F.lit(kind).alias("kind"), F.count("*").alias("rows"), F.count_if(~F.col("score").between(0, 1) | F.isnan("score") | F.col("score").isNull()).alias("out_of_range"),
            F.count_if((F.col("score") >= 0.5).cast("int") != F.col("is_match")).alias("wrong_flags"), F.lit(len(model.features)).alias("features"),
            F.lit(kind == "logistic_regression" or abs(total - 1) < 1e-6).alias("importances_add_up"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def model_calibrated(spark, d):
    train, held = _held_out(spark, d)
    model = MatchModel("logistic_regression").fit(train).calibrate(held)
    return model.predict_proba(train.unionByName(held)).select("source1_entity_id", "candidate_entity_id", "match_label", "score")


def feature_list(spark, d):
    return feature_catalog(spark)


QUERIES |= {
    f.__name__: f
    for f in (
        export_pairs_validated, export_lists, reload_lists, pool_semi, features_all, feat_country, feat_name_tokens, feat_provenance, feat_source, labels_attach, split_group_sizes,
        numeric_tokens, postal_codes, tokens_norm, char_ngrams, script_detect, legal_strip, normalised_records, normalised_names, normalised_addresses, resolve_affinity, resolve_exclusive, resolve_cap,
        s1_metrics, macro_f05, macro_groups, pair_confusion, pair_auc, pair_auc_all, validate_findings, validate_unchecked, validate_examples, validate_subset, tsv_source, smallest_ids, model_importances, model_checks, model_calibrated, feature_list,
    )
} | {
    "feat_name": _group("name"), "feat_address": _group("address"), "feat_interactions": _group("interaction"),
    "model_logistic": _model("logistic_regression"), "model_boosted": _model("xgboost_weighted"), "model_forest": _model("random_forest"),
}

_S1 = "s1 AS (SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source1)"
_POOL = "pool AS (SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source2 UNION ALL SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source3)"
_PAIRS = "p AS (SELECT DISTINCT source1_entity_id, candidate_entity_id FROM candidate_pairs WHERE source1_entity_id IS NOT NULL AND candidate_entity_id IS NOT NULL)"
_TRUTH = "t AS (SELECT DISTINCT source1_entity_id, candidate_entity_id FROM match_labels WHERE match_label = 1)"
_TEXTS = f"{_S1}, {_POOL}, x AS (SELECT * FROM s1 UNION ALL SELECT * FROM pool)"
_LISTS = "l AS (SELECT s1.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT p.candidate_entity_id, ',' ORDER BY p.candidate_entity_id), '') AS candidate_entity_ids FROM s1 LEFT JOIN p ON p.source1_entity_id = s1.entity_id GROUP BY 1)"
_SCORED = """b AS (SELECT source1_entity_id, candidate_entity_id, max(total_priority) AS p FROM candidate_pairs WHERE source1_entity_id IS NOT NULL AND total_priority IS NOT NULL AND NOT isnan(total_priority) GROUP BY ALL),
  sc AS (SELECT source1_entity_id, candidate_entity_id, p / (SELECT max(p) FROM b) AS score FROM b)"""
_LABELLED = f"{_SCORED}, y AS (SELECT source1_entity_id, candidate_entity_id, max(match_label) AS label FROM match_labels WHERE match_label IS NOT NULL GROUP BY ALL), q AS (SELECT label, score FROM y JOIN sc USING (source1_entity_id, candidate_entity_id))"


def _metrics(spine: str) -> str:
    return f"""{_TRUTH}, {_SCORED}, pr AS (SELECT source1_entity_id, candidate_entity_id FROM sc WHERE score >= 0.1),
  a AS (SELECT source1_entity_id, count(*) AS n FROM t GROUP BY 1), c AS (SELECT source1_entity_id, count(*) AS n FROM pr GROUP BY 1),
  h AS (SELECT source1_entity_id, count(*) AS n FROM t JOIN pr USING (source1_entity_id, candidate_entity_id) GROUP BY 1),
  k AS (SELECT z.source1_entity_id, coalesce(a.n, 0) AS true_n, coalesce(c.n, 0) AS pred_n, coalesce(h.n, 0) AS hits
    FROM ({spine}) z LEFT JOIN a USING (source1_entity_id) LEFT JOIN c USING (source1_entity_id) LEFT JOIN h USING (source1_entity_id)),
  g AS (SELECT *, CASE WHEN true_n = 0 AND pred_n = 0 THEN 1.0 WHEN true_n = 0 OR pred_n = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / pred_n END AS precision,
    CASE WHEN true_n = 0 AND pred_n = 0 THEN 1.0 WHEN true_n = 0 OR pred_n = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / true_n END AS recall FROM k),
  m AS (SELECT *, CASE WHEN 0.25 * precision + recall > 0 THEN 1.25 * precision * recall / (0.25 * precision + recall) ELSE 0.0 END AS f05 FROM g)"""


_AUC = """s AS (SELECT score, CAST(sum(label) AS DOUBLE) AS p, CAST(sum(1 - label) AS DOUBLE) AS n FROM q GROUP BY 1),
  c AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM s WINDOW w AS (ORDER BY score DESC)),
  z AS (SELECT sum(p) AS pp, sum(n) AS nn, sum(n * (tp - p / 2)) AS wins, sum(p * tp / (tp + fp)) AS ap FROM c)
SELECT CASE WHEN pp > 0 AND nn > 0 THEN wins / (pp * nn) ELSE 0.0 END AS roc_auc, CASE WHEN pp > 0 AND nn > 0 THEN ap / pp ELSE 0.0 END AS pr_auc FROM z"""
_FINDINGS = f"""WITH {_S1}, {_PAIRS}, raw AS (SELECT source1_entity_id, candidate_entity_id, left(candidate_entity_id, 2) AS source FROM candidate_pairs WHERE source1_entity_id IS NOT NULL AND candidate_entity_id IS NOT NULL),
have AS (SELECT DISTINCT source1_entity_id FROM p)
SELECT 'self_match' AS rule, source1_entity_id, candidate_entity_id AS value FROM p WHERE candidate_entity_id LIKE 'S1-%'
UNION ALL SELECT 'wrong_prefix', source1_entity_id, candidate_entity_id FROM p WHERE NOT regexp_matches(candidate_entity_id, '^S[123]-')
UNION ALL SELECT 'unknown_id', source1_entity_id, candidate_entity_id FROM p WHERE regexp_matches(candidate_entity_id, '^S[23]-') AND candidate_entity_id NOT IN (SELECT entity_id FROM test_source2 UNION ALL SELECT entity_id FROM test_source3)
UNION ALL SELECT 'missing_record', entity_id, NULL FROM (SELECT DISTINCT entity_id FROM s1) WHERE entity_id NOT IN (SELECT source1_entity_id FROM have)
UNION ALL SELECT 'unexpected_record', source1_entity_id, NULL FROM have WHERE source1_entity_id NOT IN (SELECT entity_id FROM s1)"""
_UNCHECKED = f"""{_FINDINGS}
UNION ALL SELECT 'duplicate_row', source1_entity_id, NULL FROM (SELECT DISTINCT source1_entity_id, source FROM raw) GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'repeated_id', source1_entity_id, NULL FROM (SELECT source1_entity_id FROM raw GROUP BY source1_entity_id, source, candidate_entity_id HAVING count(*) > 1)"""
_ALL_S1 = "SELECT DISTINCT entity_id AS source1_entity_id FROM test_source1"
_LOW = "translate(lower(trim(business_name)), chr(962), chr(963))"
_WORDS = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+')"
_RANGES = {"devanagari": r"\x{0900}-\x{097F}", "tamil": r"\x{0B80}-\x{0BFF}", "gujarati": r"\x{0A80}-\x{0AFF}", "bengali": r"\x{0980}-\x{09FF}", "latin": r"A-Za-z\x{00C0}-\x{024F}"}
_COUNTS = ", ".join(f"length(regexp_replace(business_name, '[^{r}]', '', 'g')) AS {n}" for n, r in _RANGES.items())

SQL |= {
    "export_pairs_validated": f"WITH {_S1}, {_POOL}, {_PAIRS} SELECT DISTINCT p.* FROM p JOIN s1 ON s1.entity_id = p.source1_entity_id JOIN pool ON pool.entity_id = p.candidate_entity_id WHERE s1.country = pool.country AND p.source1_entity_id LIKE 'S1-%' AND (p.candidate_entity_id LIKE 'S2-%' OR p.candidate_entity_id LIKE 'S3-%')",
    "export_lists": f"WITH {_S1}, {_PAIRS}, {_LISTS} SELECT * FROM l",
    "reload_lists": f"""WITH {_S1}, {_PAIRS}, {_LISTS}, e AS (SELECT source1_entity_id, unnest(string_split(candidate_entity_ids, ',')) AS candidate_entity_id FROM l)
SELECT *, 100.0::DOUBLE AS total_priority, 1 AS channels_fired, 1 AS rank_order, 1 AS fired_chan_a, 0 AS fired_chan_a2, 0 AS fired_chan_b, 0 AS fired_chan_c, 0 AS fired_chan_d, 0 AS fired_chan_e, 0 AS fired_chan_e2, 0 AS fired_chan_g FROM e WHERE candidate_entity_id <> ''""",
    "pool_semi": f"WITH {_POOL} SELECT * FROM pool WHERE entity_id IN (SELECT candidate_entity_id FROM candidate_pairs WHERE source1_entity_id IS NOT NULL)",
    "feat_country": f"""WITH {_S1}, {_POOL}, {_PAIRS} SELECT p.*, CASE WHEN s1.country <> '' AND s1.country = pool.country THEN 1.0 ELSE 0.0 END::FLOAT AS country_exact_match,
  CASE WHEN coalesce(s1.country, '') = '' OR coalesce(pool.country, '') = '' THEN 1.0 ELSE 0.0 END::FLOAT AS country_missing_either
  FROM p LEFT JOIN s1 ON s1.entity_id = p.source1_entity_id LEFT JOIN pool ON pool.entity_id = p.candidate_entity_id""",
    "feat_source": feature_sql.SOURCE,
    "feat_provenance": "SELECT source1_entity_id, candidate_entity_id, " + ", ".join(f"coalesce({c}, 0)::FLOAT AS {c}" for c in CHANNEL_FLAGS)
    + ", coalesce(channels_fired, 1)::FLOAT AS channels_fired_count, CASE WHEN isnan(total_priority) THEN 0 ELSE coalesce(total_priority, 0) END::FLOAT AS blocking_priority_score, coalesce(rank_order, 1)::FLOAT AS blocking_rank_order FROM candidate_pairs",
    "feat_name_tokens": feature_sql.NAME_TOKENS,
    "feat_address": feature_sql.ADDRESS,
    "feat_name": feature_sql.NAME,
    "feat_interactions": feature_sql.INTERACTIONS,
    "features_all": feature_sql.every(blocking_sql.candidates(CAP)),
    "normalised_names": normal_sql.NAMES,
    "normalised_addresses": normal_sql.ADDRESSES,
    "resolve_affinity": resolve_sql.AFFINITY,
    "resolve_exclusive": resolve_sql.EXCLUSIVE,
    "resolve_cap": resolve_sql.CAPPED,
    "feature_list": "SELECT * FROM (VALUES " + ", ".join(f"({f.position}, '{f.name}', '{f.group}', '{f.dtype}', {f.missing}::DOUBLE)" for f in FEATURES) + ") AS x(position, name, \"group\", dtype, missing)",
    "pair_auc_all": f"""WITH {_TRUTH}, {_SCORED}, q AS (SELECT CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label, score FROM sc LEFT JOIN t USING (source1_entity_id, candidate_entity_id)), {_AUC}""",
    "labels_attach": f"WITH {_PAIRS}, {_TRUTH} SELECT p.*, CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS match_label FROM p LEFT JOIN t USING (source1_entity_id, candidate_entity_id)",
    "split_group_sizes": f"WITH {_PAIRS}, n AS (SELECT count(DISTINCT source1_entity_id) AS n FROM p) SELECT 'val' AS split_group, CAST(floor(n * 0.2) AS BIGINT) AS s1_records FROM n UNION ALL SELECT 'train', n - CAST(floor(n * 0.2) AS BIGINT) FROM n",
    "numeric_tokens": rf"""WITH {_TEXTS}, w AS (SELECT entity_id, list_transform(list_filter({_WORDS.format('business_address')}, lambda v: regexp_full_match(v, '\p{{Nd}}+')), lambda v: CASE WHEN ltrim(v, '0') = '' THEN '0' ELSE ltrim(v, '0') END) AS n FROM x WHERE business_address IS NOT NULL)
SELECT entity_id, array_to_string(list_sort(list_distinct(n)), ',') AS numbers, coalesce(n[1], '') AS first_number FROM w""",
    "postal_codes": rf"WITH {_TEXTS} SELECT entity_id, array_to_string(list_sort(list_distinct(list_filter({_WORDS.format('business_address')}, lambda v: regexp_full_match(v, '\p{{Nd}}{{5,6}}')))), ',') AS codes FROM x WHERE business_address IS NOT NULL",
    "tokens_norm": rf"WITH {_TEXTS} SELECT entity_id, array_to_string(list_filter({_WORDS.format('translate(lower(business_name), chr(962), chr(963))')}, lambda v: length(v) >= 2), ' ') AS tokens FROM x WHERE business_name IS NOT NULL",
    "char_ngrams": f"""WITH {_TEXTS}, k AS (SELECT entity_id, regexp_replace(lower(business_name), '[^a-z0-9]', '', 'g') AS s FROM x WHERE business_name IS NOT NULL)
SELECT entity_id, CASE WHEN length(s) < 3 THEN s ELSE array_to_string(list_sort(list_distinct(list_transform(range(1, length(s) + 1), lambda i: substring('^' || s || '$', i, 3)))), ',') END AS grams FROM k""",
    "script_detect": f"""WITH {_TEXTS}, k AS (SELECT entity_id, business_name, {_COUNTS} FROM x)
SELECT entity_id, CASE WHEN coalesce(business_name, '') = '' THEN 'empty' WHEN greatest({', '.join(_RANGES)}) = 0 THEN 'latin' {' '.join(f"WHEN {n} = greatest({', '.join(_RANGES)}) THEN '{n}'" for n in _RANGES)} END AS script FROM k""",
    "legal_strip": f"WITH {_TEXTS} SELECT entity_id, {blocking_sql._sub(_LOW, R.LEGAL_RE2)} AS core, {blocking_sql._sub(_LOW, R.PREFIX_RE2)} AS no_prefix FROM x WHERE business_name IS NOT NULL",
    "s1_metrics": f"WITH {_metrics(_ALL_S1)} SELECT * FROM m",
    "macro_f05": f"""WITH {_metrics('SELECT DISTINCT source1_entity_id FROM t')} SELECT avg(f05) AS macro_f05, avg(precision) AS macro_precision, avg(recall) AS macro_recall, count(*) AS total_s1,
  avg(CASE WHEN pred_n = 0 THEN 100.0 ELSE 0.0 END) AS empty_pred_pct, avg(pred_n) AS avg_pred_matches, CAST(sum(pred_n) AS BIGINT) AS total_pred_matches FROM m""",
    "macro_groups": f"""WITH {_metrics(_ALL_S1)}, g3 AS (SELECT CASE WHEN true_n = 1 THEN 'group1_singleton' WHEN true_n = 0 THEN 'group2_zero_match' ELSE 'group3_multi_match' END AS bucket, * FROM m)
SELECT bucket, count(*) AS count, avg(f05) AS macro_f05, avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(pred_n) AS avg_pred_matches,
  CASE WHEN bucket = 'group2_zero_match' THEN avg(CASE WHEN pred_n > 0 THEN 100.0 ELSE 0.0 END) WHEN sum(pred_n) > 0 THEN (sum(pred_n) - sum(hits)) / CAST(sum(pred_n) AS DOUBLE) * 100 ELSE 0.0 END AS false_positive_rate FROM g3 GROUP BY 1""",
    "pair_confusion": f"""WITH {_LABELLED}, k AS (SELECT count(*) FILTER (label = 1 AND score >= 0.1) AS tp, count(*) FILTER (label <> 1 AND score >= 0.1) AS fp, count(*) FILTER (label = 1 AND score < 0.1) AS fn, count(*) FILTER (label <> 1 AND score < 0.1) AS tn,
  avg(CASE WHEN label = 1 THEN -ln(least(greatest(score, 1e-7), 1 - 1e-7)) ELSE -ln(1 - least(greatest(score, 1e-7), 1 - 1e-7)) END) AS log_loss, avg((score - label) * (score - label)) AS brier_score FROM q),
  r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS pair_precision, CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS pair_recall FROM k)
SELECT *, CASE WHEN 0.25 * pair_precision + pair_recall > 0 THEN 1.25 * pair_precision * pair_recall / (0.25 * pair_precision + pair_recall) ELSE 0.0 END AS pair_f05 FROM r""",
    "pair_auc": f"WITH {_LABELLED}, {_AUC}",
    "validate_findings": _FINDINGS,
    "validate_unchecked": _UNCHECKED,
    "validate_examples": f"SELECT DISTINCT rule, offender FROM (SELECT rule, coalesce(value, source1_entity_id) AS offender FROM ({_UNCHECKED})) QUALIFY dense_rank() OVER (PARTITION BY rule ORDER BY offender) <= 5",
    "tsv_source": "SELECT DISTINCT " + ", ".join(rf"nullif(regexp_replace({c}, '[\t\n\r\x{{0B}}\f\x{{85}}\x{{2028}}\x{{2029}}]', ' ', 'g'), '') AS {c}" for c in ("entity_id", "business_name", "business_address", "country")) + " FROM test_source3 WHERE entity_id IS NOT NULL",
    "smallest_ids": "SELECT DISTINCT entity_id, country FROM test_source1 ORDER BY entity_id LIMIT 50",
    "model_checks": "WITH n AS (SELECT count(*) AS rows FROM (SELECT DISTINCT source1_entity_id, candidate_entity_id FROM match_labels WHERE match_label IS NOT NULL)) "
    + " UNION ALL ".join(f"SELECT '{k}' AS kind, rows, 0 AS out_of_range, 0 AS wrong_flags, {len(FEATURES)} AS features, true AS importances_add_up FROM n" for k in CHECKED_KINDS),
    "validate_subset": f"WITH {_PAIRS}, {_TRUTH} SELECT t.source1_entity_id, t.candidate_entity_id AS value FROM t WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.source1_entity_id = t.source1_entity_id AND p.candidate_entity_id = t.candidate_entity_id)",
}
