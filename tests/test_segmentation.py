from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.operators import segmentation as S

CENTRES = [(20, 100, 10), (40, 900, 35), (60, 100, 60), (80, 900, 90)]


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(1)
    rows = []
    for group, centre in enumerate(CENTRES):
        for i in range(30):
            age, income, score = (float(v) for v in rng.normal(centre, (1, 10, 1)))
            rows += [(f"{group}-{i}", group, age, income, score)] * (1 + i % 2)
    return spark.createDataFrame(rows, "id string, truth int, age double, annual_income double, spending_core double")


@pytest.fixture(scope="module")
def model(customers):
    return S.fit_segments(customers)


def test_clusters_are_named_by_spending(customers, model):
    got = model.score(customers).select("truth", "segment").distinct().collect()
    assert {row.truth: row.segment for row in got} == dict(enumerate(S.SEGMENTS)) and len(got) == 4


def test_every_way_to_score_agrees(spark, customers, model, folder):
    model.save(f"{folder}/model")
    loaded = S.SegmentModel.load(f"{folder}/model")
    loaded.register_sql(spark, "seg_sql")
    loaded.register_vectorised(spark, "seg_arrow")
    null_row = customers.limit(1).withColumns({"age": F.lit(None).cast("double"), "id": F.lit("null")})
    rows = loaded.score(customers.unionByName(null_row))
    rows.createOrReplaceTempView("scored")
    call = "(age, annual_income, spending_core)"
    got = spark.sql(f"SELECT id, segment, seg_sql{call} AS a, seg_arrow{call} AS b FROM scored").collect()
    assert all(row.segment == row.a == row.b for row in got)
    assert [row.segment for row in got if row.id == "null"] == [None]
    piped = model.transform(customers).withColumn("segment", S.label_for(F.col("cluster"), model.labels))
    assert {(r.id, r.segment) for r in piped.collect()} == {(r.id, r.segment) for r in got if r.id != "null"}


def test_scoring_a_stream(spark, customers, model, folder):
    customers.write.parquet(f"{folder}/in")
    stream = model.score(spark.readStream.schema(customers.schema).parquet(f"{folder}/in"))
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp")
    query.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == customers.count()


def test_a_constant_column_decides_nothing(spark, customers):
    flat = customers.withColumn("annual_income", F.lit(5.0))
    model = S.fit_segments(flat)
    scored = model.score(flat)
    model.register_sql(spark, "seg_flat")
    model.register_vectorised(spark, "seg_flat_arrow")
    scored.createOrReplaceTempView("flat")
    call = "(age, annual_income, spending_core)"
    got = spark.sql(f"SELECT segment, seg_flat{call} AS a, seg_flat_arrow{call} AS b FROM flat").collect()
    assert len({row.segment for row in got}) == 4 and all(row.segment == row.a == row.b for row in got)


def test_scaling_spans_the_range(spark, customers):
    row = S.scale(customers).agg(F.min("age"), F.max("age"), F.min("spending_core"), F.max("spending_core")).first()
    assert np.allclose(tuple(row), (0, 10, 0, 10))
    flat = S.scale(spark.createDataFrame([(3,), (3,), (None,)], "x int"), ["x"]).collect()
    assert [r.x for r in flat] == [0.0, 0.0, None]


def test_elbow_and_silhouette(customers, model):
    runs = sorted(S.elbow(customers).collect())
    assert [run.k for run in runs] == list(range(2, 10))
    assert runs[0].inertia > runs[2].inertia * 5 and {run.status for run in runs} == {"FINISHED"}
    assert S.silhouette(model, customers) > 0.8


def test_weighted_points_carry_all_rows(customers):
    points = S.weighted_points(customers, S.FEATURES)
    assert points.agg(F.sum("weight")).first()[0] == customers.count() and points.count() == 120


def test_inertia_is_the_sum_over_nearest_centres(customers):
    scaled = S.scale(customers)
    centres = [[1.0, 1.0, 1.0], [8.0, 8.0, 8.0]]
    data = np.array([list(r) for r in scaled.select(*S.FEATURES).collect()])
    want = ((data[:, None, :] - np.array(centres)[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assigned = S.assign(scaled, S.FEATURES, centres)
    assert np.isclose(S.inertia(assigned).first()[0], want)
    profile = {r.cluster: r.age for r in S.cluster_profile(assigned).collect()}
    assert set(profile) == {r.cluster for r in S.distinct_labels(assigned).collect()} == {0, 1}


def test_inputs_are_checked(customers, model):
    with pytest.raises(ValueError, match="age"):
        model.score(customers.drop("age"))
    with pytest.raises(ValueError, match="age"):
        model.score(customers.withColumn("age", F.col("age").cast("string")))
    with pytest.raises(ValueError, match="names"):
        S.fit_segments(customers, k=3)
    assert model.check_input(customers.withColumn("age", F.col("age").cast("int"))).schema["age"].dataType == model.signature["age"].dataType
