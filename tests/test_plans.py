"""The physical plans the operators are written for."""

import pytest
from pyspark.sql import functions as F

from rarelens.contracts import FeatureContract, ThresholdPolicy
from rarelens.operators import curves, ingest, neighbors, profile, splits, sweep
from rarelens.plans import scoring
from rarelens.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def outside_subqueries(text):
    """Plan lines of the main query only (subqueries are drawn behind a colon)."""
    return "\n".join(line for line in text.splitlines() if not line.lstrip().startswith(":"))


@pytest.mark.parametrize("split", [
    lambda t: splits.three_way_split(t, "Class", ["row_id"]), lambda t: splits.k_folds(t, "Class", ["row_id"]),
    lambda t: splits.undersample(t, "Class", ["row_id"])])
def test_splits_never_shuffle_the_table(spark, small, split):
    text = outside_subqueries(plan(split(tables.transactions(spark, small))))
    assert "Exchange" not in text and "Sort" not in text and "FileScan" in text


def test_exact_sample_is_a_filter_on_the_scan(spark, small):
    lines = plan(ingest.sample_exact(spark.read.parquet(f"{small}/events.parquet"), ["event_id"], 100)).splitlines()
    main = lines[:next(i for i, line in enumerate(lines) if "+- Subquery" in line or ":- Subquery" in line)]
    assert "Filter" in "".join(main) and "Exchange" not in "".join(main)


def test_scoring_is_one_narrow_pass_without_python(spark, small):
    model = scoring.LogisticScorer(inputCols=["Amount_log1p"], weights=[1.0])
    scored = scoring.score_rows(tables.transactions(spark, small), model, ThresholdPolicy("p", 0.5),
                                FeatureContract(raw=("Time", "Amount")), ["row_id"])
    text = outside_subqueries(plan(scored))
    assert "Exchange" not in text and "Python" not in text and text.count("FileScan") == 1
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "user_id" not in scan and "props" not in scan


def test_sweep_scans_once_and_shuffles_cells_only(spark, small):
    text = plan(sweep.sweep(tables.scored_lineitems(spark, small)))
    assert text.count("FileScan") == 1 and "partial_sum(label" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string>" in text


def test_curve_keeps_offsets_on_the_broadcast_side(spark, small):
    text = plan(curves.ranking_metrics(curves.score_curve(tables.scored_lineitems(spark, small))))
    assert "BuildRight" in text and "BuildLeft" not in text and "partial_sum(label" in text


def test_curve_partitions_once_for_join_and_window(spark, small, monkeypatch):
    from rarelens.operators import ordered
    monkeypatch.setattr(ordered, "BROADCAST_LINE_LIMIT", 0)
    text = plan(curves.score_curve(tables.scored_lineitems(spark, small)))
    join, window = text.index("SortMergeJoin"), text.index("Window")
    assert window < join and "Exchange" not in text[window:join]


def test_top_rows_keep_k_per_task(spark, small):
    assert "TakeOrderedAndProject" in plan(profile.top_rows(tables.transactions(spark, small), "Amount", "row_id"))


def test_filters_reach_the_scan(spark, small):
    text = plan(tables.transactions(spark, small).where(F.col("Amount") > 50).select("row_id"))
    assert "GreaterThan(value,50.0)" in text


def test_group_limit_runs_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    text = plan(neighbors._first_per_group(rows, "g", [F.col("id")], 5))
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_mean_of_streams_needs_no_scalar_join(spark, small):
    text = plan(profile.value_counts(spark.read.parquet(f"{small}/events.parquet"), "event_type"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_registered_query_pairs_all_rows(spark, small):
    import __spark_entry__ as entry
    heavy = ("model", "search", "refit", "ab_", "cross_val", "stream", "pick_regul", "trained", "shallow", "experiment", "smote",
             "nearest_n", "round_trip")
    for name, run in entry.queries().items():
        if not any(h in name for h in heavy):
            text = plan(run(spark, small))
            assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_task_functions_load_without_the_package(tmp_path):
    """Workers started elsewhere cannot import the package; task code must travel with the task."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from rarelens.plans import explain
    (tmp_path / "f").write_bytes(cloudpickle.dumps([neighbors._nearest, neighbors._to_pivots, explain._ridge]))
    code = ("import pickle, numpy as np; n, p, r = pickle.load(open('f', 'rb')); x = np.arange(6.0).reshape(3, 2); "
            "print(n(x, x, np.arange(3), 1)[1].tolist(), p(x, x[:1]).shape)")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert out.stdout.strip() == "[0, 1, 2] (3, 1)", out.stderr
