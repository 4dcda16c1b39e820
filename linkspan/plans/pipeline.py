"""From source files to match lists: block, compare, score, resolve, write."""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspan.operators.blocking import Blocking, generate_candidates
from linkspan.operators.features import pair_features
from linkspan.operators.model import MatchModel
from linkspan.operators.resolve import resolve
from linkspan.plans.durable import durable
from linkspan.session import ship
from linkspan.sources import tsv


#: Records of each candidate source for each S1 record of a smoke run.
POOL_PER_RECORD = 200


@dataclass
class Settings:
    threshold: float = 0.88
    cap: int = 150
    limit: int | None = None
    candidate_file: str | None = None  # reload candidates from a list file instead of blocking
    most_per_record: int = 8
    pool_limit: int | None = None  # records of each candidate source that take part, the first by id
    statistics: dict = field(default_factory=dict)  # filled by match()


def match(s1: DataFrame, pool: DataFrame, model: MatchModel, conf: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """(matches, candidates) of the S1 records against the pool.

    Reloaded candidates carry constant provenance, so their scores may differ from those of a full run.
    """
    conf = conf or Settings()
    s1 = tsv.limited(s1, conf.limit)
    start = time.time()
    if conf.candidate_file:
        pairs = tsv.read_lists(s1.sparkSession, conf.candidate_file, s1)
    else:
        pairs = generate_candidates(s1, pool, Blocking(cap=conf.cap))
    pairs = durable(pairs)
    seconds = time.time() - start
    counted = pairs.agg(F.count("*").alias("total_candidates"), F.max("rank_order").alias("most_per_record")).first()  # one narrow column of the stored table
    conf.statistics |= {**counted.asDict(), "runtime_seconds": seconds, "cap": conf.cap}
    scored = model.predict_proba(pair_features(pairs, s1, tsv.pruned(pool, pairs)))
    accepted = durable(scored.where(F.col("score") >= conf.threshold).select("source1_entity_id", "candidate_entity_id", "score"))
    return resolve(accepted, s1, tsv.pruned(pool, accepted), conf.most_per_record), pairs


def run(spark: SparkSession, data_dir: str, output_dir: str, model_path: str, conf: Settings | None = None) -> None:
    """Read test_source1..3.tsv, write matching_results.tsv and candidate_pairs.tsv (one row per S1 record)."""
    ship(spark)
    conf = conf or Settings()
    s1 = tsv.limited(tsv.read_source(spark, f"{data_dir}/test_source1.tsv"), conf.limit)
    first, second = (tsv.limited(tsv.read_source(spark, f"{data_dir}/test_source{i}.tsv"), conf.pool_limit) for i in (2, 3))
    matches, pairs = match(s1, first.unionByName(second), MatchModel.load(spark, model_path), conf)
    for df, name, file in ((matches, "matched_entity_ids", "matching_results.tsv"), (pairs, "candidate_entity_ids", "candidate_pairs.tsv")):
        tsv.write_tsv(tsv.as_lists(df, s1, name).orderBy("source1_entity_id"), f"{output_dir}/{file}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Match S1 records to S2 and S3 records.")
    p.add_argument("--data-dir", default="dataset")
    p.add_argument("--output-dir", default="output")
    p.add_argument("--model-path", default="models/match_model")
    p.add_argument("--threshold", type=float, default=0.88)
    p.add_argument("--cap", type=int, default=150)
    p.add_argument("--limit", type=int)
    p.add_argument("--smoke-test", action="store_true", help="the first 50 S1 records, unless --limit is given")
    p.add_argument("--candidates", help="a candidate list file to reload instead of blocking, if it is there")
    p.add_argument("--force-blocking", action="store_true", help="block even if the candidate file is there")
    p.add_argument("--temp-dir", help="where shuffles and spills go")
    a = p.parse_args(argv)
    limit = a.limit or (50 if a.smoke_test else None)
    output = "smoke_output" if limit and a.output_dir == "output" else a.output_dir
    builder = SparkSession.builder.appName("linkspan")
    spark = (builder.config("spark.local.dir", a.temp_dir) if a.temp_dir else builder).getOrCreate()
    reload = a.candidates if a.candidates and not a.force_blocking and tsv.exists(spark, a.candidates) else None
    conf = Settings(a.threshold, a.cap, limit, reload, pool_limit=limit * POOL_PER_RECORD if a.smoke_test else None)
    run(spark, a.data_dir, output, a.model_path, conf)
    print(conf.statistics)


if __name__ == "__main__":
    main()
