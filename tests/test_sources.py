import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelens.contracts import RAW_SCHEMA, ContractError
from rarelens.operators import correlate
from rarelens.sources import configs, reports, tables


def test_csv_round_trip_and_preview(spark, tmp_path):
    df = spark.createDataFrame([tuple([1.5] * 30 + [0])], RAW_SCHEMA)
    path = str(tmp_path / "raw")
    tables.write_csv(df, path)
    back = tables.read_csv(spark, path)
    assert back.schema == RAW_SCHEMA and tables.preview(back, 1).count() == 1
    assert tables.read_csv(spark, path, None).schema["Class"].dataType.simpleString() == "int"
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, str(tmp_path / "absent"))


def test_split_reader_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 0, "train"), (2.0, 1, "test")], "Amount double, Class int, split string")
    path = str(tmp_path / "splits")
    tables.write_splits(df, path)
    one = tables.read_split(spark, path, "test")
    assert one.collect()[0].asDict() == {"Amount": 2.0, "Class": 1}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(ContractError):
        tables.read_split(spark, path, "test", "label")
    names, table = tables.features_and_label(df)
    assert names == ["Amount"] and table.columns == ["Amount", "Class"]


def test_nan_becomes_null_but_infinity_stays(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2)], "x double, k int")
    assert [r["x"] for r in tables.nan_to_null(df).orderBy("k").collect()] == [None, float("inf")]


def test_file_fingerprint(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"a,b\n1,2\n")
    r = tables.file_fingerprints(spark, str(tmp_path / "f.csv")).first()
    assert (r["bytes"], r["sha256"]) == (8, hashlib.sha256(b"a,b\n1,2\n").hexdigest())


def test_table_fingerprint_ignores_order_and_sees_changes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    mark = lambda df: tuple(tables.table_fingerprint(df).first())
    assert mark(a) == mark(a.orderBy(F.desc("k")).repartition(3))
    assert mark(a) != mark(a.dropDuplicates()) and mark(a) != mark(a.withColumn("k", F.col("k") + 1))


@pytest.mark.parametrize("doc,want", [
    ({"threshold": 0.1, "cases": [{"name": "a", "index": 5}, {"idx": 7}, {"test_index": 5}, {"name": "none"}]}, [5, 7]),
    ({"cases": {"tp": {"test_index": 3}, "tn": {"index": 1}}}, [3, 1]),
    ([{"index": 9}, {"index": 2}], [9, 2]), ({"tp": {"idx": 4}}, [4]),
    ({"first_index": 8, "note": "x", "Index2": "6"}, [8, 6])])
def test_case_files(spark, tmp_path, doc, want):
    path = tmp_path / "cases.json"
    path.write_text(json.dumps(doc, indent=1))
    got = configs.read_case_file(spark, str(path)).orderBy("position").collect()
    assert [r["row_index"] for r in got] == want


def test_case_file_without_cases_raises(spark, tmp_path):
    path = tmp_path / "cases.json"
    path.write_text('{"threshold": 0.5}')
    with pytest.raises(Exception, match="no case index"):
        configs.read_case_file(spark, str(path)).collect()


def test_config_records(spark, tmp_path):
    policy, schema, meta = (tmp_path / n for n in ("p.json", "s.json", "m.json"))
    policy.write_text(json.dumps({"policy_name": "p80", "policy_version": "7", "threshold": 0.1279,
                                  "reference_model_artifact": "models/m"}))
    schema.write_text(json.dumps({"schema_version": "v1", "raw_input_features": ["Time", "Amount"],
                                  "engineered_features": ["Hour"], "model_features": ["Time", "Amount", "Hour"]}))
    meta.write_text(json.dumps({"model_version": "m1", "git_commit": "c", "train_date": "2026-01-01", "task": "binary"}))
    view = configs.serving_view(spark, configs.load_policy(spark, str(policy)), configs.load_contract(spark, str(schema)),
                                configs.load_metadata(spark, str(meta))).first()
    assert (view["threshold_used"], view["schema_version"], view["task"], view["framework"]) == (0.1279, "v1", "binary", None)
    assert view["model_features"] == ["Time", "Amount", "Hour"]
    meta.write_text("{}")
    with pytest.raises(ValueError, match="lacks keys"):
        configs.load_metadata(spark, str(meta))


def test_report_values_become_plain():
    got = reports.plain({"a": np.int64(3), "b": [np.float64(0.5), np.array([1, 2])], 4: (np.bool_(True), None)})
    assert json.loads(json.dumps(got)) == {"a": 3, "b": [0.5, [1, 2]], "4": [True, None]}


def test_experiment_log_grows_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    one, two = (spark.createDataFrame([(v,)], f"{n} double") for n, v in (("f1", 0.5), ("f2", 0.7)))
    reports.append_results(reports.result_rows(spark, "rf", "valid", {"depth": np.int64(3)}, one, 1.5), path)
    reports.append_results(reports.result_rows(spark, "rf", "test", {"depth": 4}, two, 2.5), path)
    rows = {r["stage"]: r for r in reports.read_results(spark, path).collect()}
    assert rows["valid"]["params_json"] == '{"depth": 3}' and rows["valid"]["f2"] is None and rows["test"]["f2"] == 0.7
    with pytest.raises(FileNotFoundError):
        reports.read_results(spark, str(tmp_path / "none"))


def test_report_sink_writes_nested_json(spark, tmp_path):
    df = spark.range(1).select(F.struct(F.lit(1).alias("a")).alias("s"), F.array(F.lit("x")).alias("l"))
    reports.write_report(df, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().asDict(True) == {"s": {"a": 1}, "l": ["x"]}


def test_dense_and_pairwise_correlation_agree(spark, small):
    names = [f"e{i}" for i in range(5)]
    df = tables.embedding_features(spark, small, 5)
    dense = {(r[0], r[1]): r[2] for r in correlate.dense_pearson(df, names).collect()}
    for r in correlate.pearson_matrix(df, names).collect():
        assert dense[r["column_a"], r["column_b"]] == pytest.approx(r["value"])


def written(spark, path, docs):
    lines = spark.createDataFrame(list(docs.items()), "doc string, value string")
    lines.write.partitionBy("doc").text(str(path))
    return str(path)


def test_case_files_of_all_layouts(spark, tmp_path):
    from rarelens.sources.configs import read_case_files
    docs = {"list": '{"threshold": 0.5, "cases": [{"name": "b", "index": 7}, {"idx": "9"}, {"index": 7}, {"other": 1}, 5]}', "bare": '[{"test_index": 3}]',
            "map": '{"cases": {"z": {"index": 4}, "a": {"test_index": 2}}}', "plain": '{"z": {"index": 1}, "a": {"index": 0}}',
            "flat": '{"true_index": 8, "Index of fp": 6, "note": "x"}', "null": '{"cases": null, "first_index": 2}',
            "text": "hello", "number": "12", "nothing": '{"a": 1}'}
    rows = {}
    for r in read_case_files(spark, written(spark, tmp_path / "cases", docs)).collect():
        rows.setdefault(r["doc"], []).append((r["position"], r["name"], r["row_index"], r["layout"], r["error"]))
    assert {k: sorted(v, key=str) for k, v in rows.items()} == {
        "list": [(0, "b", 7, "list", None), (1, None, 9, "list", None)], "bare": [(0, None, 3, "list", None)],
        "map": [(0, "z", 4, "map", None), (1, "a", 2, "map", None)], "plain": [(0, "z", 1, "map", None), (1, "a", 0, "map", None)],
        "flat": [(0, "true_index", 8, "flat", None), (1, "Index of fp", 6, "flat", None)], "null": [(0, "first_index", 2, "flat", None)],
        "text": [(None, None, None, None, "not a JSON object or list")], "number": [(None, None, None, None, "not a JSON object or list")],
        "nothing": [(None, None, None, "flat", "no case index found in the document")]}


def test_policy_files_with_their_errors(spark, tmp_path):
    from rarelens.sources.configs import read_policy_files
    good = '{"policy_name": "p", "policy_version": "1", "threshold": 0.25, "reference_model_artifact": "m.bin", "more": [1]}'
    docs = {"good": good, "text": good.replace("0.25", '"0.25"'), "high": good.replace("0.25", "1.5"), "blank": good.replace("m.bin", "  "),
            "less": '{"policy_name": "p", "threshold": 1}', "list": "[]", "broken": "{", "bool": good.replace("0.25", "true")}
    got = {r["doc"]: (r["threshold"], r["errors"]) for r in read_policy_files(spark, written(spark, tmp_path / "policies", docs)).collect()}
    number = "threshold must be a number"
    assert got == {"good": (0.25, []), "text": (None, [number]), "bool": (None, [number]), "high": (1.5, ["threshold must lie in 0 to 1"]),
                   "blank": (0.25, ["reference_model_artifact must be a text that is not blank"]),
                   "less": (1.0, ["missing key: policy_version", "missing key: reference_model_artifact"]), "list": (None, ["not a JSON object"]),
                   "broken": (None, ["not a JSON object"])}
