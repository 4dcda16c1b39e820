"""Match models over the pairwise features, on MLlib."""

from __future__ import annotations

import json
import time

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspan.operators.features import FEATURE_NAMES
from linkspan.plans.durable import durable

KINDS = ("logistic_regression", "xgboost", "xgboost_weighted", "random_forest")
#: Weight of the positive class of xgboost_weighted unless a parameter sets it.
POSITIVE_WEIGHT = 5.2


def _interpolated(xs: list[float], ys: list[float]):
    """A UDF: the curve through all points, flat beyond its ends. xs ascend; each value is looked up by binary search."""

    def at(score: pd.Series) -> pd.Series:
        return pd.Series(np.interp(score, xs, ys))

    return F.pandas_udf(at, "double")


class MatchModel:
    """A classifier by kind: logistic_regression, xgboost, xgboost_weighted (both boosted trees) or random_forest.

    params overrides the estimator's (MLlib's names; positive_weight for xgboost_weighted). Features are taken
    by name, in order; a missing one is an error. Rows need `match_label` to fit.
    """

    def __init__(self, kind: str = "xgboost", params: dict | None = None, seed: int = 42, features: list[str] | None = None) -> None:
        self.kind = kind.lower()
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}; one of {', '.join(KINDS)}")
        self.params, self.seed, self.features = dict(params or {}), seed, list(features or FEATURE_NAMES)
        self.fitted: PipelineModel | None = None
        self.calibration: dict | None = None
        self.seconds = {"training": 0.0, "inference": 0.0}

    def _prepared(self, df: DataFrame) -> DataFrame:
        missing = [f for f in self.features if f not in df.columns]
        if missing:
            raise ValueError(f"missing features: {', '.join(missing)}")
        return df.withColumns({f: F.col(f).cast("double") for f in self.features})

    def _stages(self, n: int) -> list:
        filled = [f"_{f}" for f in self.features]
        impute = Imputer(strategy="median", inputCols=self.features, outputCols=filled)
        p = {k: v for k, v in self.params.items() if k != "positive_weight"}
        common = {"labelCol": "_label", "weightCol": "_weight"}
        if self.kind == "logistic_regression":
            est = LogisticRegression(**{"featuresCol": "_scaled", "maxIter": 500, "regParam": 1.0 / max(n, 1), **common, **p})
            return [impute, VectorAssembler(inputCols=filled, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True), est]
        if self.kind == "random_forest":
            est = RandomForestClassifier(**{"featuresCol": "_raw", "numTrees": 200, "maxDepth": 12, "minInstancesPerNode": 5, "seed": self.seed, **common, **p})
        else:
            est = GBTClassifier(**{"featuresCol": "_raw", "maxIter": 300, "maxDepth": 5, "stepSize": 0.08, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5, "seed": self.seed, **common, **p})
        return [impute, VectorAssembler(inputCols=filled, outputCol="_raw"), est]

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> MatchModel:
        """Fit on train. With validation, boosted trees stop once it no longer gains."""
        start = time.time()
        df = self._prepared(train).withColumn("_label", F.col("match_label").cast("double"))
        n, positives = df.agg(F.count("*"), F.sum("_label")).first()
        positives = positives or 0.0
        if self.kind in ("logistic_regression", "random_forest") and 0 < positives < n:  # balanced classes
            weight = F.when(F.col("_label") == 1, n / (2 * positives)).otherwise(n / (2 * (n - positives)))
        elif self.kind == "xgboost_weighted":
            weight = F.when(F.col("_label") == 1, float(self.params.get("positive_weight", POSITIVE_WEIGHT))).otherwise(1.0)
        else:
            weight = F.lit(1.0)
        df = df.withColumn("_weight", weight)
        stages = self._stages(n)
        if validation is not None and isinstance(stages[-1], GBTClassifier):
            held = self._prepared(validation).withColumn("_label", F.col("match_label").cast("double")).withColumn("_weight", F.lit(1.0)).withColumn("_held", F.lit(True))
            df = df.withColumn("_held", F.lit(False)).unionByName(held, allowMissingColumns=True)
            stages[-1].setValidationIndicatorCol("_held")
        self.fitted = Pipeline(stages=stages).fit(df)
        self.calibration = None
        self.seconds["training"] = time.time() - start
        return self

    def _scored(self, df: DataFrame) -> DataFrame:
        if self.fitted is None:
            raise RuntimeError("fit the model first")
        out = self.fitted.transform(self._prepared(df).withColumn("_label", F.lit(0.0)).withColumn("_weight", F.lit(1.0)))
        return out.withColumn("score", vector_to_array("probability")[1])

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """df with `score`, the probability of a match (calibrated, if calibrate() was called)."""
        score = F.col("score")
        if self.calibration and self.calibration["method"] == "sigmoid":
            score = 1 / (1 + F.exp(-(F.lit(self.calibration["a"]) * F.col("score") + F.lit(self.calibration["b"]))))
        elif self.calibration:
            score = _interpolated(self.calibration["x"], self.calibration["y"])(score)
        return self._scored(df).withColumn("score", score).select(*df.columns, "score")

    def timed(self, df: DataFrame) -> DataFrame:
        """predict_proba(df), computed and stored; the seconds that takes are kept under `inference`."""
        start = time.time()
        out = durable(self.predict_proba(df))
        self.seconds["inference"] = time.time() - start
        return out

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return self.predict_proba(df).withColumn("is_match", (F.col("score") >= threshold).cast("int"))

    def calibrate(self, validation: DataFrame, method: str = "sigmoid") -> MatchModel:
        """Map scores to probabilities learned on validation: `sigmoid` (logistic) or `isotonic`."""
        if method not in ("sigmoid", "isotonic"):
            raise ValueError("method is sigmoid or isotonic")
        self.calibration = None
        df = self._scored(validation).select(F.col("match_label").cast("double").alias("label"), "score")
        if method == "sigmoid":
            fit = LogisticRegression().fit(VectorAssembler(inputCols=["score"], outputCol="features").transform(df))
            self.calibration = {"method": method, "a": float(fit.coefficients[0]), "b": float(fit.intercept)}
        else:
            fit = IsotonicRegression(featuresCol="score").fit(df)
            self.calibration = {"method": method, "x": list(map(float, fit.boundaries)), "y": list(map(float, fit.predictions))}
        return self

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance), descending: absolute coefficients or the trees' importances."""
        if self.fitted is None:
            raise RuntimeError("fit the model first")
        last = self.fitted.stages[-1]
        values = [abs(float(v)) for v in last.coefficients.toArray()] if self.kind == "logistic_regression" else [float(v) for v in last.featureImportances.toArray()]
        return spark.createDataFrame(list(zip(self.features, values)), "feature string, importance double").orderBy(F.desc("importance"), "feature")

    def save(self, spark: SparkSession, path: str) -> None:
        if self.fitted is None:
            raise RuntimeError("fit the model first")
        self.fitted.write().overwrite().save(f"{path}/pipeline")
        about = {"kind": self.kind, "params": self.params, "seed": self.seed, "features": self.features, "calibration": self.calibration, "seconds": self.seconds}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> MatchModel:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        model = cls(about["kind"], about["params"], about["seed"], about["features"])
        model.fitted, model.calibration, model.seconds = PipelineModel.load(f"{path}/pipeline"), about["calibration"], about["seconds"]
        return model
