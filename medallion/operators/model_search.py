"""Classifier search, with its results kept in a table that later runs reuse."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.operators.changelog import ChangeLog
from medallion.operators.ranking import latest_for
from medallion.session import literal_rows

FLAGS = "_flags"
TRIALS = "trial string, family string, params string, f1 double"
FORMAT = "%Y-%m-%dT%H:%M:%S.%f"


def _families(target: str) -> list[tuple[str, object, list]]:
    linear = LogisticRegression(labelCol=target, maxIter=20)
    forest = RandomForestClassifier(labelCol=target, numTrees=20, seed=0)
    return [
        ("logistic_regression", linear, ParamGridBuilder().addGrid(linear.regParam, [0.0, 0.1]).build()),
        ("random_forest", forest, ParamGridBuilder().addGrid(forest.maxDepth, [3, 6]).build()),
    ]


def encoded(rows: DataFrame, target: str, numeric: list[str], categorical: list[str], slots: int) -> DataFrame:
    """The target and a vector ``features``: the numbers, then each category as a one in one of ``slots`` places.

    The place is a hash of column and category, so nothing is fitted: no category comes to the
    driver however many there are, and what a fold learns from knows nothing of its other rows.
    Rows without a target or with a missing cell are left out.
    """
    known = rows.select(
        F.col(target).cast("double").alias(target),
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *categorical,
    ).dropna()
    parts = list(numeric)
    if categorical:
        flags = FeatureHasher(
            inputCols=list(categorical), outputCol=FLAGS, numFeatures=slots, categoricalCols=list(categorical)
        )
        known, parts = flags.transform(known), [*parts, FLAGS]
    return VectorAssembler(inputCols=parts, outputCol="features").transform(known).select("features", target)


def search_classifier(
    rows: DataFrame,
    target: str,
    numeric: list[str],
    categorical: list[str] = (),
    folds: int = 3,
    parallelism: int = 2,
    slots: int = 1024,
) -> DataFrame:
    """Cross-validate several classifiers; every trial with its mean F1, best first.

    Categories are hashed into ``slots`` places, see :func:`encoded`.
    """
    ready = encoded(rows, target, numeric, list(categorical), slots).persist()
    judge = MulticlassClassificationEvaluator(labelCol=target, metricName="f1")
    trials = []
    try:
        for family, estimator, grid in _families(target):
            search = CrossValidator(
                estimator=estimator,
                estimatorParamMaps=grid,
                evaluator=judge,
                numFolds=folds,
                parallelism=parallelism,
                seed=0,
            )
            scores = search.fit(ready).avgMetrics
            for params, f1 in zip(grid, scores):
                text = ", ".join(f"{param.name}={value}" for param, value in params.items())
                trials.append((uuid.uuid4().hex[:12], family, text, float(f1)))
    finally:
        ready.unpersist()
    found = literal_rows(rows.sparkSession, trials, TRIALS)
    return found.orderBy(F.desc("f1"), "family", "params")


class RunTable:
    """One row per finished search; rows are found by name, newest first."""

    def __init__(self, log: ChangeLog):
        self.log = log
        if log.latest_version() < 0:
            log.append(literal_rows(log.spark, [], "name string, date string"), operation="create")

    def latest(self, name: str) -> DataFrame:
        return latest_for(self.log.as_of(), F.col("name") == name, "date")

    def add(self, name: str, trials: DataFrame) -> None:
        """Append the best trial; its columns join the table's schema on first use."""
        best = trials.orderBy(F.desc("f1"), "family", "params").limit(1)
        date = datetime.now(timezone.utc).strftime(FORMAT)
        row = best.select(
            F.lit(name).alias("name"),
            F.lit(date).alias("date"),
            F.col("trial").alias("best_trial_run_id"),
            "family",
            "params",
            F.col("f1").cast("string").alias("f1"),
        )
        self.log.append(row)

    def forget(self, name: str) -> None:
        self.log.delete(F.col("name") == name)

    def get_or_search(self, name: str, search) -> DataFrame:
        """The latest row of ``name``; ``search()`` is run only where there is none."""
        if self.latest(name).isEmpty():
            self.add(name, search())
        return self.latest(name)
