from __future__ import annotations

from medallion.operators import ChangeLog
from medallion.operators.model_search import RunTable, encoded, search_classifier


def test_search_ranks_trials(spark):
    rows = spark.range(240).selectExpr(
        "cast(id % 7 AS double) AS x", "if(id % 2 = 0, 'p', 'q') AS c", "if(id % 7 > 3, 1, 0) AS y"
    )
    trials = search_classifier(rows, "y", ["x"], ["c"], folds=2).collect()
    assert len(trials) == 4 and trials[0].f1 >= trials[-1].f1 and trials[0].f1 > 0.95
    assert {trial.family for trial in trials} == {"logistic_regression", "random_forest"}


def test_a_million_categories_are_hashed_not_collected(spark):
    rows = spark.range(1_000_000).selectExpr(
        "cast(id % 10 AS double) AS x", "concat('label ', id) AS c", "if(id % 3 = 0, true, null) AS b", "id % 2 AS y"
    )
    spark.sparkContext.setJobGroup("encode", "encode")
    ready = encoded(rows, "y", ["x"], ["c", "b"], 64)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("encode")) == 0
    assert ready.count() == 333_334
    first = ready.first()
    assert first.features.size == 65 and sum(first.features.toArray()[1:]) == 2


def test_a_category_seen_only_outside_a_fold_is_no_error(spark):
    rows = spark.range(60).selectExpr("concat('c', id) AS c", "cast(id % 2 AS double) AS x", "id % 2 AS y")
    assert search_classifier(rows, "y", ["x"], ["c"], folds=2, slots=16).count() == 4


def test_runs_are_reused_until_forgotten(spark, folder):
    runs, calls = RunTable(ChangeLog(spark, f"{folder}/runs")), []

    def search():
        calls.append(1)
        return spark.createDataFrame(
            [("t1", "forest", "depth=3", 0.5), ("t2", "linear", "reg=0", 0.7)],
            "trial string, family string, params string, f1 double",
        )

    first = runs.get_or_search("churn", search).first()
    assert (first.best_trial_run_id, first.f1) == ("t2", "0.7")
    assert runs.get_or_search("churn", search).first() == first and len(calls) == 1
    runs.get_or_search("other", search)
    runs.forget("churn")
    assert runs.latest("churn").isEmpty() and not runs.latest("other").isEmpty()
    runs.get_or_search("churn", search)
    assert len(calls) == 3
