"""Config records and case files."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarelens.contracts import FeatureContract, ThresholdPolicy

# Fixed values
CASE_INDEX_KEYS = ("index", "test_index", "idx")
POLICY_REQUIRED = ("policy_name", "policy_version", "threshold", "reference_model_artifact")
METADATA_REQUIRED = ("model_version", "git_commit", "train_date")


def read_json_record(spark: SparkSession, path: str) -> Any:
    """One small JSON document from any file system."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def load_policy(spark: SparkSession, path: str) -> ThresholdPolicy:
    return ThresholdPolicy.from_config(read_json_record(spark, path))


def load_contract(spark: SparkSession, path: str) -> FeatureContract:
    return FeatureContract.from_config(read_json_record(spark, path))


def load_metadata(spark: SparkSession, path: str) -> dict[str, Any]:
    record = read_json_record(spark, path)
    absent = [k for k in METADATA_REQUIRED if k not in record]
    if absent:
        raise ValueError(f"model metadata lacks keys: {absent}")
    return record


def serving_view(spark: SparkSession, policy: ThresholdPolicy, contract: FeatureContract,
                 metadata: dict[str, Any]) -> DataFrame:
    """One row that says what is being served: model, policy, schema and provenance."""
    optional = ("training_data_reference", "training_target", "framework", "task")
    text = lambda v: F.lit(v).cast("string")
    names = lambda xs: F.array(*[F.lit(x) for x in xs])
    return spark.range(1).select(
        text(metadata["model_version"]).alias("model_version"), text(policy.artifact).alias("model_artifact_path"),
        text(metadata["git_commit"]).alias("git_commit"), text(metadata["train_date"]).alias("train_date"),
        text(policy.name).alias("threshold_policy"), text(policy.version).alias("threshold_policy_version"),
        F.lit(float(policy.threshold)).alias("threshold_used"), text(contract.version).alias("schema_version"),
        names(contract.raw).alias("raw_input_features"), names(contract.engineered).alias("engineered_features"),
        names(contract.model).alias("model_features"), *[text(metadata.get(k)).alias(k) for k in optional])


def case_indices(documents: DataFrame, text: str = "value") -> DataFrame:
    """(position, row_index) of the cases named in JSON documents, first mention kept.

    Accepts {"cases": [..]}, {"cases": {name: ..}}, the same without the wrapper, and a flat record whose
    keys mention "index". A document that names no case raises.
    """
    as_map = F.from_json(F.col(text), "map<string,string>")
    body = F.coalesce(as_map["cases"], F.col(text))
    is_list = F.ltrim(body).startswith("[")
    listed = F.when(is_list, F.from_json(body, "array<string>"))
    mapped = F.when(~is_list, F.from_json(body, "map<string,string>"))
    entries = F.when(is_list, listed).otherwise(F.map_values(mapped))
    # Only entries that are themselves objects can carry an index key.
    objects = F.filter(entries, lambda e: F.ltrim(e).startswith("{"))
    chosen = F.transform(objects, lambda e: F.coalesce(*[
        F.get_json_object(e, f"$.{k}").try_cast("bigint") for k in CASE_INDEX_KEYS]))
    flat = F.map_values(F.map_filter(mapped, lambda k, v: F.lower(k).contains("index")))
    found = F.when(F.size(objects) > 0, chosen).otherwise(F.transform(flat, lambda v: v.try_cast("bigint")))
    found = F.filter(F.coalesce(found, F.array().cast("array<bigint>")), lambda i: i.isNotNull())
    checked = F.when(F.size(found) > 0, found).otherwise(
        F.raise_error(F.lit("no case index found in the document")).cast("array<bigint>"))
    return (documents.select(F.posexplode(checked).alias("position", "row_index"))
            .groupBy("row_index").agg(F.min("position").alias("position"))
            .select("position", "row_index"))


def read_case_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, layout, position, name, row_index, error) of all case files under a path, and the columns of its partition folders.

    Files are read whole, one task for some of them, through Spark's own readers, so any file system will do. Layouts are "list",
    "map" and "flat" as in `case_indices`; the first mention of an index in a file counts. A file that is not a JSON object or list,
    or names no case, is one row with an error instead of a failed job.
    """
    known = spark.read.text(path, wholetext=True)
    folders = [c for c in known.columns if c != "value"]
    as_variant = lambda c, kind: F.try_variant_get(c, "$", kind)
    docs = known.select(*folders, F.col("_metadata.file_path").alias("file"), "value", F.try_parse_json("value").alias("v"))
    docs = docs.withColumn("body", F.coalesce(F.when(~F.is_variant_null(F.coalesce(F.try_variant_get("v", "$.cases", "variant"), F.parse_json(F.lit("null")))),
                                                     F.try_variant_get("v", "$.cases", "variant")), F.col("v")))
    docs = docs.withColumn("kind", F.schema_of_variant("body"))
    listed = F.when(F.col("kind").startswith("ARRAY"), as_variant("body", "array<variant>"))
    # a variant sorts its keys; a map of texts keeps the order of the file
    texts = F.from_json(F.when(F.col("kind").startswith("OBJECT"), F.coalesce(F.get_json_object("value", "$.cases"), F.col("value"))), "map<string,string>")
    entries = F.coalesce(F.transform(listed, lambda e: F.struct(F.lit(None).cast("string").alias("key"), e.alias("e"))),
                         F.transform(F.map_entries(texts), lambda m: F.struct(m["key"].alias("key"), F.try_parse_json(m["value"]).alias("e"))))
    objects = F.filter(entries, lambda s: F.schema_of_variant(s["e"]).startswith("OBJECT"))
    index = lambda e: F.coalesce(*[F.try_variant_get(e, f"$.{k}", "bigint") for k in CASE_INDEX_KEYS])
    cases = F.transform(objects, lambda s: F.struct(F.coalesce(F.try_variant_get(s["e"], "$.name", "string"), s["key"]).alias("name"), index(s["e"]).alias("row_index")))
    flat = F.transform(F.filter(entries, lambda s: F.lower(s["key"]).contains("index")),
                       lambda s: F.struct(s["key"].alias("name"), as_variant(s["e"], "bigint").alias("row_index")))
    is_flat = F.coalesce(F.size(objects) == 0, F.lit(False)) & F.col("kind").startswith("OBJECT")
    found = F.filter(F.when(is_flat, flat).otherwise(cases), lambda c: c["row_index"].isNotNull())
    layout = F.when(is_flat, "flat").when(F.col("kind").startswith("OBJECT"), "map").when(F.col("kind").startswith("ARRAY"), "list")
    read = docs.select(*folders, "file", layout.alias("layout"), F.coalesce(found, F.array().cast("array<struct<name:string,row_index:bigint>>")).alias("cases"))
    # the first mention of an index
    once = F.filter("cases", lambda c, i: F.get(F.filter(F.transform("cases", lambda d, j: F.struct(d["row_index"].alias("r"), j.alias("j"))),
                                                         lambda d: d["r"] == c["row_index"]), F.lit(0))["j"] == i)
    error = F.when(F.col("layout").isNull(), "not a JSON object or list").when(F.size("cases") == 0, "no case index found in the document")
    return read.select(*folders, "file", "layout", error.alias("error"), F.posexplode_outer(once).alias("position", "case")).select(
        *folders, "file", "layout", "position", "case.name", "case.row_index", "error")


def read_policy_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, policy_name, policy_version, threshold, reference_model_artifact, errors) of all threshold configs under a path.

    `errors` lists what is wrong with a file, by the types its values were written with; it is empty for a good one.
    """
    known = spark.read.text(path, wholetext=True)
    folders = [c for c in known.columns if c != "value"]
    docs = known.select(*folders, F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
    kind = lambda k: F.coalesce(F.schema_of_variant(F.try_variant_get("v", f"$.{k}", "variant")), F.lit("ABSENT"))
    number = F.when(kind("threshold").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"), F.try_variant_get("v", "$.threshold", "double"))
    text = lambda k: F.when(kind(k) == "STRING", F.try_variant_get("v", f"$.{k}", "string"))
    whole = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    rules = [F.when(kind(k) == "ABSENT", F.lit(f"missing key: {k}")) for k in POLICY_REQUIRED]
    rules += [F.when((kind("threshold") != "ABSENT") & number.isNull(), F.lit("threshold must be a number")),
              F.when(~number.between(0.0, 1.0), F.lit("threshold must lie in 0 to 1")),
              F.when((kind("reference_model_artifact") != "ABSENT") & (F.coalesce(F.trim(text("reference_model_artifact")), F.lit("")) == ""),
                     F.lit("reference_model_artifact must be a text that is not blank"))]
    errors = F.when(~whole, F.array(F.lit("not a JSON object"))).otherwise(F.array_compact(F.array(*rules)))
    return docs.select(*folders, "file", text("policy_name").alias("policy_name"), F.try_variant_get("v", "$.policy_version", "string").alias("policy_version"),
                       number.alias("threshold"), text("reference_model_artifact").alias("reference_model_artifact"), errors.alias("errors"))


def read_case_file(spark: SparkSession, path: str) -> DataFrame:
    return case_indices(spark.read.text(path, wholetext=True))
