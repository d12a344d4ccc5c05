"""Customer segments: scaling, an elbow sweep, k-means, labels and scoring."""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.cleaning import label_for
from medallion.operators.profiling import known
from medallion.session import literal_rows, scratch_dir

# The model's inputs, its segment names from the lowest spending up,
# the scaled range, and the tag its runs carry.
FEATURES = ["age", "annual_income", "spending_core"]
SEGMENTS = ["small_spenders", "medium_spenders", "large_spenders", "critical_spenders"]
SCALED_RANGE = (0.0, 10.0)
RUN_TAG = "retail_segmentation"
SQL_NAME = "get_customer_segmentation_cluster"

SWEEP = (
    "k int, inertia double, seconds double, status string, tag string, finished_at timestamp, reported double"
)


def bounds(rows: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """(min, max) per column, NaN left out: one aggregate, one row to the driver."""
    found = rows.agg(*[f(known(c)) for c in columns for f in (F.min, F.max)]).first()
    return {c: (found[2 * i], found[2 * i + 1]) for i, c in enumerate(columns)}


def scaled(column: str, low: float, high: float, span: tuple[float, float] = SCALED_RANGE) -> Column:
    """Min-max scaling; a column with one value becomes the lower bound."""
    if low is None or low == high:
        return F.when(F.col(column).isNotNull(), F.lit(span[0]))
    share = (F.col(column).cast("double") - F.lit(low)) / F.lit(high - low)
    return share * F.lit(span[1] - span[0]) + F.lit(span[0])


def scale(
    rows: DataFrame, columns: list[str] = FEATURES, span: tuple[float, float] = SCALED_RANGE
) -> DataFrame:
    found = bounds(rows, columns)
    return rows.withColumns({c: scaled(c, *found[c], span) for c in columns})


def squared_distance(columns: list[Column], centre: list[float]) -> Column:
    total = F.lit(0.0)
    for column, place in zip(columns, centre):
        total = total + (column - F.lit(float(place))) * (column - F.lit(float(place)))
    return total


def nearest(columns: list[Column], centres: list[list[float]]) -> Column:
    """(distance, cluster) of the nearest centre, the lower index on a tie; NULL on NULL input."""
    found = [
        F.struct(squared_distance(columns, centre).alias("distance"), F.lit(i).alias("cluster"))
        for i, centre in enumerate(centres)
    ]
    known = columns[0].isNotNull()
    for column in columns[1:]:
        known = known & column.isNotNull()
    return F.when(known, F.array_min(F.array(*found)))


def assign(rows: DataFrame, columns: list[str], centres: list[list[float]]) -> DataFrame:
    """Add ``distance`` (squared) and ``cluster``."""
    near = rows.withColumn("_near", nearest([F.col(c) for c in columns], centres))
    return near.select("*", "_near.distance", "_near.cluster").drop("_near")


def inertia(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("distance").alias("inertia"))


def weighted_points(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct feature vectors with their multiplicity.

    Fitting on them gives the same centres and inertia as fitting on every row, and
    copies of one point are counted where they are read instead of being iterated over.
    """
    known = rows.dropna(subset=columns).select(*[F.col(c).cast("double").alias(c) for c in columns])
    return known.groupBy(*columns).agg(F.count("*").cast("double").alias("weight"))


def written_points(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The weighted points as a table: fitting passes over them many times, and an
    executor lost on the way must not mean computing ``rows`` again."""
    path = scratch_dir(rows.sparkSession, "points")
    weighted_points(rows, columns).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _stages(columns: list[str], k: int, seed: int) -> list:
    low, high = SCALED_RANGE
    return [
        VectorAssembler(inputCols=columns, outputCol="raw"),
        MinMaxScaler(inputCol="raw", outputCol="features", min=low, max=high),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster", weightCol="weight"),
    ]


def elbow(
    rows: DataFrame,
    columns: list[str] = FEATURES,
    ks=range(2, 10),
    seed: int = 0,
    tag: str = RUN_TAG,
    parallelism: int = 8,
) -> DataFrame:
    """Fit k-means for every k, ``parallelism`` at a time; a row per k with its inertia.

    ``inertia`` is summed over the points for the final centres, those of all k in one scan; what a fit itself
    ``reported`` is from before the last move of its centres, so it is as large or a little larger. Scaling is fitted once. The scaled points are persisted over the fits, spilling
    to disk; a lost block is read again from the written points.
    """
    spark = rows.sparkSession
    assembler, scaler, _ = _stages(columns, 2, seed)
    points = assembler.transform(written_points(rows, columns))
    points = scaler.fit(points).transform(points).select("features", "weight").persist()

    def fit(k: int) -> tuple:
        started = time.monotonic()
        model = _stages(columns, k, seed)[2].fit(points)
        seconds = time.monotonic() - started
        cost = float(model.summary.trainingCost)
        centres[k] = [[float(x) for x in centre] for centre in model.clusterCenters()]
        return (k, cost, seconds, "FINISHED", tag, datetime.now(timezone.utc))

    centres: dict[int, list[list[float]]] = {}

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(fit), ks))
        distances = summed_distances(points, centres)
    finally:
        points.unpersist()
    return literal_rows(spark, [(k, distances[k], *rest, cost) for k, cost, *rest in results], SWEEP)


def summed_distances(points: DataFrame, centres: dict[int, list[list[float]]]) -> dict[int, float]:
    """For each number of centres the squared distances of ``points`` (features, weight) to their nearest one,
    summed; one aggregate over the points for all of them."""
    features = vector_to_array("features")

    def distance(centre: list[float]) -> Column:
        return sum(((features[i] - x) * (features[i] - x) for i, x in enumerate(centre)), F.lit(0.0))

    def nearest(of: list[list[float]]) -> Column:
        return F.least(*map(distance, of)) if len(of) > 1 else distance(of[0])

    sums = points.agg(*[F.sum(F.col("weight") * nearest(of)).alias(str(k)) for k, of in centres.items()]).first()
    return {k: float(sums[str(k)] or 0.0) for k in centres}


def register_segments(
    spark: SparkSession,
    name: str,
    limits: dict[str, tuple[float, float]],
    centres: list[list[float]],
    labels: dict[str, str],
) -> None:
    """A SQL function of the raw columns, inlined by the optimizer: no Python at run time.

    ``limits`` holds (min, max) of the input columns in order, ``centres`` are scaled.
    """
    low, high = SCALED_RANGE
    entries = []
    for i, centre in enumerate(centres):
        terms = []
        for (column, (least, most)), place in zip(limits.items(), centre):
            if least == most:
                continue
            unit = f"({column} - {least!r}D) / {most - least!r}D * {high - low!r}D + {low!r}D"
            terms.append(f"power({unit} - {place!r}D, 2)")
        label = labels[f"cluster_{i}"].replace("'", "\\'")
        distance = " + ".join(terms) or "0D"
        entries.append(f"named_struct('d', {distance}, 'i', {i}, 'label', '{label}')")
    known = " AND ".join(f"{column} IS NOT NULL" for column in limits)
    body = f"CASE WHEN {known} THEN array_min(array({', '.join(entries)})).label END"
    inputs = ", ".join(f"{column} DOUBLE" for column in limits)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({inputs}) RETURNS STRING RETURN {body}")


def register_segments_vectorised(
    spark: SparkSession,
    name: str,
    limits: dict[str, tuple[float, float]],
    centres: list[list[float]],
    labels: dict[str, str],
) -> None:
    """The same function over Arrow batches, the way to serve a model SQL cannot express."""
    low, high = SCALED_RANGE
    least = np.array([pair[0] for pair in limits.values()])
    span = np.array([pair[1] - pair[0] for pair in limits.values()])
    flat = span == 0
    span = np.where(flat, 1.0, span)
    places = np.array(centres)
    names = np.array([labels[f"cluster_{i}"] for i in range(len(centres))], dtype=object)

    def predict(*inputs: pd.Series) -> pd.Series:
        raw = np.column_stack([series.astype("float64").to_numpy() for series in inputs])
        known = ~np.isnan(raw).any(axis=1)
        unit = (raw - least) / span * (high - low) + low
        gap = unit[:, None, :] - places[None, :, :]
        gap[:, :, flat] = 0.0
        picked = np.full(len(raw), None, dtype=object)
        picked[known] = names[(gap[known] ** 2).sum(axis=2).argmin(axis=1)]
        return pd.Series(picked)

    spark.udf.register(name, F.pandas_udf(predict, "string"))


@dataclass
class SegmentModel:
    """A fitted scaler and k-means with named clusters; scores raw, unscaled columns."""

    pipeline: PipelineModel
    columns: list[str]
    labels: dict[str, str]

    @property
    def signature(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.DoubleType()) for c in self.columns])

    def check_input(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the model's columns cast to its types; fails if one is absent or no number."""
        known = {field.name: field.dataType for field in rows.schema}
        for field in self.signature:
            if not isinstance(known.get(field.name), T.NumericType):
                found = known.get(field.name)
                raise ValueError(f"model input {field.name} must be a number, found {found}")
        return rows.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in self.signature})

    def _parts(self) -> tuple[dict[str, tuple[float, float]], list[list[float]]]:
        scaler, means = self.pipeline.stages[1:]
        limits = zip(self.columns, scaler.originalMin.toArray(), scaler.originalMax.toArray())
        found = {c: (float(low), float(high)) for c, low, high in limits}
        return found, [[float(v) for v in centre] for centre in means.clusterCenters()]

    def cluster(self) -> Column:
        """Cluster index of a row as a plain expression over the raw columns.

        The pipeline maps a constant column to the middle of the range and
        :func:`scaled` to its lower end; that shifts all centres alike, so it is
        taken out of the distance.
        """
        found, centres = self._parts()
        live = [i for i, c in enumerate(self.columns) if found[c][0] != found[c][1]]
        kept = [scaled(self.columns[i], *found[self.columns[i]]) for i in live] or [F.lit(0.0)]
        places = [[centre[i] for i in live] or [0.0] for centre in centres]
        return nearest(kept, places)["cluster"]

    def segment(self) -> Column:
        return label_for(self.cluster(), self.labels)

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` plus ``segment``, batch or stream; NULL where an input is NULL."""
        self.check_input(rows)
        return rows.select("*", self.segment().alias("segment"))

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` plus the pipeline's ``cluster``; rows with a NULL input are left out."""
        known = self.check_input(rows).dropna(subset=self.columns)
        return self.pipeline.transform(known).drop("raw", "features")

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.active()
        about = json.dumps({"columns": self.columns, "labels": self.labels})
        row = literal_rows(spark, [(about,)], "value string")
        row.write.mode("overwrite").text(f"{path}/about")

    @staticmethod
    def load(path: str) -> SegmentModel:
        about = json.loads(SparkSession.active().read.text(f"{path}/about").first().value)
        pipeline = PipelineModel.load(f"{path}/pipeline")
        return SegmentModel(pipeline, about["columns"], about["labels"])

    # ---- SQL -----------------------------------------------------------------

    def register_sql(self, spark: SparkSession, name: str = SQL_NAME) -> None:
        """Make the model callable in SQL, see :func:`register_segments`."""
        register_segments(spark, name, *self._parts(), self.labels)

    def register_vectorised(self, spark: SparkSession, name: str = SQL_NAME) -> None:
        """The same over Arrow batches, see :func:`register_segments_vectorised`."""
        register_segments_vectorised(spark, name, *self._parts(), self.labels)


def fit_segments(
    rows: DataFrame,
    columns: list[str] = FEATURES,
    k: int = 4,
    names: list[str] = SEGMENTS,
    rank_by: str = "spending_core",
    seed: int = 0,
) -> SegmentModel:
    """Fit k clusters and name them.

    The index of a k-means cluster means nothing, so clusters are named in the
    order of their centre's ``rank_by``.
    """
    if len(names) != k:
        raise ValueError(f"{k} clusters need {k} names, got {len(names)}")
    pipeline = Pipeline(stages=_stages(columns, k, seed)).fit(written_points(rows, columns))
    centres = pipeline.stages[2].clusterCenters()
    position = columns.index(rank_by)
    ranked = sorted(range(len(centres)), key=lambda i: centres[i][position])
    labels = {f"cluster_{i}": names[rank] for rank, i in enumerate(ranked)}
    return SegmentModel(pipeline, list(columns), labels)


def cluster_profile(clustered: DataFrame, columns: list[str] = FEATURES, by: str = "cluster") -> DataFrame:
    """Mean of every feature per cluster, in one aggregate."""
    return clustered.groupBy(by).agg(*[F.avg(c).alias(c) for c in columns])


def distinct_labels(labelled: DataFrame, column: str = "cluster") -> DataFrame:
    return labelled.select(column).distinct()


def labelled_points(model: SegmentModel, rows: DataFrame) -> DataFrame:
    """The three features and the segment of every customer."""
    return model.score(rows).select(*model.columns, "segment")


def silhouette(model: SegmentModel, rows: DataFrame) -> float:
    """Mean silhouette of the clusters, squared Euclidean, on the scaled points."""
    return judged(model.pipeline.transform(weighted_points(rows, model.columns)))


def judged(points: DataFrame) -> float:
    """Mean silhouette of points (features, cluster, weight)."""
    judge = ClusteringEvaluator(
        featuresCol="features", predictionCol="cluster", metricName="silhouette", weightCol="weight"
    )
    return float(judge.evaluate(points))
