"""Sources, filters, profiling, features, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarelens.catalog.registry import HOUR, TX, TXH, query, rounded
from rarelens.contracts import align_lenient, align_strict, find_target, select_numeric
from rarelens.functions import features as fx
from rarelens.functions import vectors
from rarelens.operators import correlate, ingest, profile
from rarelens.operators.ordered import quantiles
from rarelens.plans.estimators import AmountFeatures, AutoScaler, PopulationScaler, TimeFeatures, engineer
from rarelens.sources import tables
from rarelens.sources.reports import report_column


def tx(spark, d):
    return tables.transactions(spark, d)


def txh(spark, d):
    return engineer(tx(spark, d))


def engineered_columns(spark, d):
    return txh(spark, d).select("Time", "Amount", "Hour", "hour_sin", "hour_cos", "Amount_log1p", "Class")


SEVEN = ("Time", "Amount", "Hour", "hour_sin", "hour_cos", "Amount_log1p", "Class")
SIX = SEVEN[:-1]

# Sources and projections ------------------------------------------------------------------------------------


@query("table_fingerprint", """
WITH v AS (SELECT [coalesce(length(x) || ':' || x, '-')
                   FOR x IN [event_id::VARCHAR, epoch_us(ts)::VARCHAR, user_id::VARCHAR, event_type, props]] AS v FROM events),
h AS (SELECT ('0x' || substr(md5(array_to_string(v, '')), 1, 15))::BIGINT AS h FROM v)
SELECT count(*) AS row_count, bit_xor(h) AS xor_hash, CAST(sum(h::HUGEINT) AS VARCHAR) AS sum_hash FROM h""")
def table_fingerprint(spark, d):
    e = tables.event_time(tables.sample_table(spark, d, "events"))
    return tables.table_fingerprint(e, ["event_id", F.unix_micros("ts"), "user_id", "event_type", "props"])


@query("target_only", f'WITH {TX} SELECT "Class", count(*) AS n FROM tx GROUP BY 1')
def target_only(spark, d):
    return tables.read_target(tx(spark, d)).groupBy("Class").agg(F.count(F.lit(1)).alias("n"))


@query("range_filter", f"""WITH {TX} SELECT row_id, "Amount", "Class" FROM tx
WHERE "Amount" > 50 AND "Amount" BETWEEN 60 AND 200 AND "Class" = 1""")
def range_filter(spark, d):
    return tx(spark, d).where((F.col("Amount") > 50) & F.col("Amount").between(60, 200) & (F.col("Class") == 1)) \
        .select("row_id", "Amount", "Class")


@query("derived_columns", f'WITH {TX} SELECT row_id, round("Amount" * 100, 6) AS cents, CAST(floor("Amount") AS INTEGER) AS whole FROM tx')
def derived_columns(spark, d):
    t = tx(spark, d).withColumn("cents", F.col("Amount") * 100).withColumn("whole", F.floor("Amount").cast("int"))
    return rounded(t.drop("Time", "Class").select("row_id", "cents", "whole"))


@query("numeric_projection", f'WITH {TX} SELECT row_id, user_id, round("Time", 6) AS "Time", "Amount", "Class" FROM tx')
def numeric_projection(spark, d):
    return rounded(select_numeric(tx(spark, d).withColumn("note", F.lit("text"))))


@query("label_names", f"""WITH {TX}, dim AS (SELECT * FROM (VALUES (0, 'Legit'), (1, 'Fraud')) v("Class", class_label))
SELECT class_label, count(*) AS n, round(sum("Amount"), 4) AS amount FROM tx LEFT JOIN dim USING ("Class") GROUP BY 1""")
def label_names(spark, d):
    dim = spark.createDataFrame([(0, "Legit"), (1, "Fraud")], "Class int, class_label string")  # two fixed rows
    joined = tx(spark, d).join(F.broadcast(dim), "Class", "left")
    return rounded(joined.groupBy("class_label").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("amount")), 4)


@query("label_map", f"""WITH {TX} SELECT CASE "Class" WHEN 0 THEN 'Legit' WHEN 1 THEN 'Fraud' END AS class_label,
count(*) AS n FROM tx GROUP BY 1""")
def label_map(spark, d):
    return tx(spark, d).groupBy(fx.class_name("Class").alias("class_label")).agg(F.count(F.lit(1)).alias("n"))


@query("binary_target", """SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS y, count(*) AS n FROM lineitem GROUP BY 1""")
def binary_target(spark, d):
    items = tables.sample_table(spark, d, "lineitem").select("l_linestatus")
    return ingest.binary_target(items, "l_linestatus", "y").groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query("strict_alignment", f"""WITH {TXH} SELECT round("Time", 6) AS "Time", "Amount", "Hour"::DOUBLE AS "Hour",
round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos, round("Amount_log1p", 6) AS "Amount_log1p" FROM txh""")
def strict_alignment(spark, d):
    return rounded(align_strict(txh(spark, d), SIX))


@query("lenient_alignment", f'WITH {TX} SELECT "Amount", round("Time", 6) AS "Time", 0.0::DOUBLE AS "V1" FROM tx')
def lenient_alignment(spark, d):
    return rounded(align_lenient(tx(spark, d), ["Amount", "Time", "V1"])[0])


@query("report_json", f"""WITH {TX} SELECT '{{"total":' || count(*) || ',"positives":' || sum("Class") || '}}' AS report FROM tx""")
def report_json(spark, d):
    return report_column(profile.basic_stats(tx(spark, d)).select("total", "positives"))


# Validation, duplicates, lookup, sampling --------------------------------------------------------------------

DUPLICATED = """dup AS (SELECT l_suppkey, l_linenumber, l_returnflag FROM lineitem)"""


@query("deduplicated", f"WITH {DUPLICATED} SELECT DISTINCT * FROM dup")
def deduplicated(spark, d):
    return ingest.deduplicate(tables.sample_table(spark, d, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag"))


@query("duplicate_counts", f"""WITH {DUPLICATED}, u AS (SELECT DISTINCT * FROM dup)
SELECT (SELECT count(*) FROM dup) AS row_count, (SELECT count(*) FROM u) AS distinct_rows,
       (SELECT count(*) FROM dup) - (SELECT count(*) FROM u) AS duplicate_rows""")
def duplicate_counts(spark, d):
    return ingest.duplicate_counts(
        tables.sample_table(spark, d, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag"))


# A text column with faults, derived from the events: every 13th amount is text, every 17th NaN, every 19th infinite.
FAULTY = TX + """, faulty AS (SELECT row_id, "Time", "Class", CASE WHEN row_id % 13 = 0 THEN 'n/a' WHEN row_id % 17 = 0 THEN 'NaN'
  WHEN row_id % 19 = 0 THEN 'Infinity' WHEN row_id % 23 = 0 THEN NULL ELSE CAST("Amount" AS VARCHAR) END AS raw FROM tx)"""
NUMBER = "TRY_CAST(raw AS DOUBLE)"


def faulty(spark, d):
    raw = (F.when(F.col("row_id") % 13 == 0, "n/a").when(F.col("row_id") % 17 == 0, "NaN")
           .when(F.col("row_id") % 19 == 0, "Infinity").when(F.col("row_id") % 23 == 0, F.lit(None))
           .otherwise(F.col("Amount").cast("string")))
    return tx(spark, d).withColumn("raw", raw)


@query("coercion_summary", f"""WITH {FAULTY}, v AS (SELECT CASE WHEN isnan({NUMBER}) THEN NULL ELSE {NUMBER} END AS v FROM faulty)
SELECT count(v) AS kept, count(*) - count(v) AS dropped, bool_and(v IS NULL OR (isinf(v) OR v = floor(v))) AS all_integral FROM v""")
def coercion_summary(spark, d):
    return ingest.coercion_summary(faulty(spark, d), "raw")


@query("non_finite_rows", f"""WITH {FAULTY} SELECT reason, count(*) AS n FROM (SELECT CASE WHEN raw IS NULL THEN 'raw: missing'
  WHEN {NUMBER} IS NULL THEN 'raw: not numeric' WHEN isnan({NUMBER}) THEN 'raw: NaN'
  WHEN isinf({NUMBER}) THEN 'raw: infinite' END AS reason FROM faulty) WHERE reason IS NOT NULL GROUP BY 1""")
def non_finite_rows(spark, d):
    reasons = F.explode(ingest.non_finite_reasons(["raw"])).alias("reason")
    return faulty(spark, d).select(reasons).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("median_imputation", f"""WITH {FAULTY}, v AS (SELECT row_id, CASE WHEN isnan({NUMBER}) OR isinf({NUMBER}) THEN NULL ELSE {NUMBER} END AS v FROM faulty)
SELECT row_id, round(coalesce(v, (SELECT quantile_cont(v, 0.5) FROM v)), 6) AS amount, v IS NULL AS amount_filled FROM v""")
def median_imputation(spark, d):
    v = ingest.coerce_numeric(faulty(spark, d), "raw", "amount")
    v = v.withColumn("amount", F.when(F.abs("amount") != float("inf"), F.col("amount")))
    return rounded(ingest.impute_median(v, "amount").select("row_id", "amount", "amount_filled"))


@query("constant_fill", f"""WITH {FAULTY} SELECT row_id, coalesce(CASE WHEN isnan({NUMBER}) OR isinf({NUMBER}) THEN NULL ELSE {NUMBER} END, 0.0) AS amount FROM faulty""")
def constant_fill(spark, d):
    v = ingest.coerce_numeric(faulty(spark, d), "raw", "amount")
    finite = F.when(F.abs("amount") != float("inf"), F.col("amount"))
    return ingest.fill_constant(v.select("row_id", finite.alias("amount")), ["amount"])


@query("lookup_by_id", f"""WITH {TX}, ids AS (SELECT DISTINCT o_custkey * 11 AS row_id FROM orders)
SELECT ids.row_id, "Amount", "Class", CASE WHEN tx.row_id IS NULL THEN 'not_found' ELSE 'found' END AS status
FROM ids LEFT JOIN tx USING (row_id)""")
def lookup_by_id(spark, d):
    ids = tables.sample_table(spark, d, "orders").select((F.col("o_custkey") * 11).alias("row_id")).distinct()
    return ingest.lookup(tx(spark, d).select("row_id", "Amount", "Class"), ids)


@query("head_rows", f'WITH {TX} SELECT row_id, "Amount" FROM tx ORDER BY row_id LIMIT 5')
def head_rows(spark, d):
    return ingest.head(tx(spark, d), "row_id").select("row_id", "Amount")


@query("tail_rows", f'WITH {TX} SELECT row_id, "Amount" FROM tx ORDER BY row_id DESC LIMIT 5')
def tail_rows(spark, d):
    return ingest.tail(tx(spark, d), "row_id").select("row_id", "Amount")


@query("slice_rows", f'WITH {TX} SELECT row_id, "Amount" FROM tx ORDER BY row_id LIMIT 10 OFFSET 20')
def slice_rows(spark, d):
    return ingest.slice_rows(tx(spark, d), "row_id", 20, 30).select("row_id", "Amount")


@query("sample_exact", f"""WITH {TX} SELECT row_id, "Amount" FROM tx ORDER BY md5(row_id || '|42') LIMIT 200""")
def sample_exact(spark, d):
    return ingest.sample_exact(tx(spark, d), ["row_id"], 200, 42).select("row_id", "Amount")


# Aggregation and profiling -----------------------------------------------------------------------------------

@query("basic_stats", f"""WITH {TX} SELECT count(*) AS total, sum("Class")::BIGINT AS positives, (count(*) - sum("Class"))::BIGINT AS negatives,
round(sum("Class") * 100.0::DOUBLE / count(*), 6) AS rate_percent FROM tx""")
def basic_stats(spark, d):
    return profile.basic_stats(tx(spark, d))


@query("class_balance", f"""WITH {TX}, c AS (SELECT "Class"::VARCHAR AS label, count(*) AS count FROM tx GROUP BY 1),
t AS (SELECT sum(count)::BIGINT AS total, max(count) AS mx, min(count) AS mn, sum(CASE WHEN label = '1' THEN count ELSE 0 END) AS pos FROM c)
SELECT label, count, round(count::DOUBLE / total * 100, 6) AS percent, total, round(pos * 100.0::DOUBLE / total, 6) AS fraud_rate,
round(mx::DOUBLE / mn, 6) AS majority_to_minority, round(100 / (pos * 100.0::DOUBLE / total), 6) AS one_positive_per_n FROM c, t""")
def class_balance(spark, d):
    b = profile.class_balance(tx(spark, d))
    return rounded(b.select(
        F.explode("labels").alias("label"), "counts", "percents", "total", "fraud_rate", "majority_to_minority",
        "one_positive_per_n").select("label", F.col("counts")[F.col("label")].alias("count"),
                                     F.col("percents")[F.col("label")].alias("percent"), "total", "fraud_rate",
                                     "majority_to_minority", "one_positive_per_n"))


@query("value_counts", """SELECT event_type AS value, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(*) FROM events), 6) AS share
FROM events GROUP BY 1""")
def value_counts(spark, d):
    return rounded(profile.value_counts(tables.sample_table(spark, d, "events"), "event_type"))


@query("value_counts_with_null", f"""WITH {FAULTY}, v AS (SELECT CASE WHEN raw IS NULL THEN NULL WHEN {NUMBER} IS NULL THEN 'text' ELSE 'number' END AS value FROM faulty)
SELECT value, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(*) FROM v), 6) AS share FROM v GROUP BY 1""")
def value_counts_with_null(spark, d):
    kind = F.when(F.col("raw").isNull(), F.lit(None)).when(F.col("raw").try_cast("double").isNull(), "text").otherwise("number")
    return rounded(profile.value_counts(faulty(spark, d).select(kind.alias("kind")), "kind", keep_null=True))


@query("amount_by_class", f"""WITH {TX} SELECT "Class", count("Amount") AS count, round(avg("Amount"), 6) AS mean, round(sum("Amount"), 4) AS sum,
round(quantile_cont("Amount", 0.5), 6) AS median FROM tx GROUP BY 1""")
def amount_by_class(spark, d):
    return rounded(profile.group_summary(tx(spark, d), "Class", "Amount")).withColumn("sum", F.round("sum", 4))


@query("mean_amount_by_hour", f'WITH {TXH} SELECT "Hour", round(avg("Amount"), 6) AS mean, count(*) AS count FROM txh GROUP BY 1')
def mean_amount_by_hour(spark, d):
    return rounded(profile.mean_by(txh(spark, d), "Hour", "Amount"))


@query("fraud_by_hour", f"""WITH {TXH} SELECT "Hour", count(*) AS total, sum("Class")::BIGINT AS positives, round(avg("Class"), 6) AS rate
FROM txh GROUP BY 1""")
def fraud_by_hour(spark, d):
    return profile.rate_by(txh(spark, d), "Hour")


@query("top_fraud_hours", f"""WITH {TXH} SELECT "Hour", count(*) AS total, sum("Class")::BIGINT AS positives, round(avg("Class"), 6) AS rate
FROM txh GROUP BY 1 ORDER BY rate DESC, "Hour" LIMIT 3""")
def top_fraud_hours(spark, d):
    return profile.top_rates(profile.rate_by(txh(spark, d), "Hour"), "Hour")


def describe_sql(source: str, column: str, name: str, digits: int = 4) -> str:
    c = f'"{column}"'
    r = lambda e, alias: f"round({e}, {digits}) AS {alias}"
    qs = ", ".join(r(f"quantile_cont({c}, {p})", f"q{int(p * 100):02d}") for p in (.01, .05, .25, .5, .75, .95, .99))
    return f"""SELECT '{name}' AS "column", count({c}) AS count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')},
{r(f'min({c})', 'min')}, {r(f'max({c})', 'max')}, {r(f'skewness({c})', 'skew')}, {r(f'kurtosis({c})', 'kurtosis')},
CASE WHEN skewness({c}) > 2 THEN 'heavy right skew' WHEN skewness({c}) > 1 THEN 'right skew' WHEN skewness({c}) < -1 THEN 'left skew'
ELSE 'approximately symmetric' END AS skew_label, {qs} FROM {source}"""


@query("describe_columns", f"WITH {TXH} " + describe_sql("txh", "Amount", "Amount") + " UNION ALL "
       + describe_sql("txh", "Time", "Time") + " UNION ALL " + describe_sql("txh", "Amount_log1p", "Amount_log1p"))
def describe_columns(spark, d):
    return rounded(profile.describe(txh(spark, d), ["Amount", "Time", "Amount_log1p"]), 4)


@query("amount_profile", f"""WITH {FAULTY}, v AS (SELECT CASE WHEN isnan({NUMBER}) OR isinf({NUMBER}) THEN NULL ELSE {NUMBER} END AS v FROM faulty)
SELECT * EXCLUDE ("column", skew_label), (SELECT round(avg(CAST(v >= 0 AS INTEGER)), 4) FROM v WHERE v IS NOT NULL) AS non_negative_ratio,
count = 0 AS empty FROM (""" + describe_sql("v", "v", "v") + ")")
def amount_profile(spark, d):
    return rounded(profile.amount_profile(faulty(spark, d), "raw"), 4)


FAULTY_COLUMNS = ("row_id", "ts", "user_id", "Time", "Amount", "Class", "raw")


@query("null_profile", f"WITH {FAULTY}, every AS (SELECT f.*, t.ts, t.user_id, t.\"Amount\" FROM faulty f JOIN tx t USING (row_id)) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls, round((count(*) - count("{c}"))::DOUBLE / count(*), 6) AS null_ratio FROM every"""
    for c in FAULTY_COLUMNS))
def null_profile(spark, d):
    return rounded(profile.top_null_ratios(faulty(spark, d)))


@query("domain_violations", f"""WITH {TX} SELECT 'Amount' AS "column", count(*) FILTER ("Amount" - 10 < 0) AS negatives FROM tx
UNION ALL SELECT 'Time', count(*) FILTER ("Time" < 0) FROM tx""")
def domain_violations(spark, d):
    return profile.domain_violations(tx(spark, d).withColumn("Amount", F.col("Amount") - 10))


@query("quality_gate", f"""WITH {TX}, m AS (SELECT user_id, "Class", CASE WHEN "Amount" < 1 THEN NULL ELSE "Amount" - 5 END AS "Amount" FROM tx)
SELECT rule, value, lim AS "limit", value <= lim AS passed FROM (
SELECT 'nulls' AS rule, (SELECT count(*) - count("Amount") FROM m) AS value, 0::BIGINT AS lim
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM m) - (SELECT count(*) FROM (SELECT DISTINCT * FROM m)), 1
UNION ALL SELECT 'negative_amounts', (SELECT count(*) FROM m WHERE "Amount" < 0), 0)""")
def quality_gate(spark, d):
    m = tx(spark, d).select("user_id", "Class", F.when(F.col("Amount") >= 1, F.col("Amount") - 5).alias("Amount"))
    return profile.quality_gate(m, max_duplicates=1)


@query("tail_share", f"""WITH {TX}, q AS (SELECT quantile_cont("Amount", 0.99) AS q FROM tx)
SELECT round(q, 6) AS "limit", round(avg(CAST("Amount" > q AS INTEGER)), 6) AS share FROM tx, q GROUP BY q""")
def tail_share(spark, d):
    return rounded(profile.tail_share(tx(spark, d)))


def hist_sql(source: str, column: str, bins: int, by: str = "", shared: bool = True) -> str:
    k, p = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    span = "" if shared else p
    return f"""b AS (SELECT {k}{column} AS v, min({column}) OVER ({span}) AS lo, max({column}) OVER ({span}) AS hi, count(*) OVER ({p}) AS n FROM {source}),
f AS (SELECT DISTINCT {k}lo, hi, n, unnest(range({bins})) AS bin FROM b),
c AS (SELECT {k}least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1}) AS bin, count(*) AS count FROM b GROUP BY ALL)
SELECT {k}f.bin::INTEGER AS bin, round(lo + f.bin * ((hi - lo) / {bins}), 6) AS "left", round(lo + (f.bin + 1) * ((hi - lo) / {bins}), 6) AS "right",
coalesce(count, 0) AS count, round(coalesce(count, 0) / (n * ((hi - lo) / {bins})), 6) AS density
FROM f LEFT JOIN c USING ({k}bin)"""


@query("hist_amount", f"WITH {TX}, " + hist_sql("tx", '"Amount"', 50))
def hist_amount(spark, d):
    return rounded(profile.histogram(tx(spark, d), "Amount", 50))


@query("hist_log_amount", f"WITH {TXH}, " + hist_sql("txh", '"Amount_log1p"', 40))
def hist_log_amount(spark, d):
    return rounded(profile.histogram(txh(spark, d), "Amount_log1p", 40))


@query("hist_hours_since_start", f'WITH {TX}, h AS (SELECT "Time" / 3600 AS h FROM tx), ' + hist_sql("h", "h", 48))
def hist_hours_since_start(spark, d):
    return rounded(profile.histogram(tx(spark, d).select(fx.hours_since_start("Time").alias("h")), "h", 48))


@query("hist_by_class_shared", f"WITH {TX}, " + hist_sql("tx", '"Amount"', 30, '"Class"'))
def hist_by_class_shared(spark, d):
    return rounded(profile.histogram(tx(spark, d), "Amount", 30, by="Class"))


@query("hist_by_class_own_range", f"WITH {TX}, " + hist_sql("tx", '"Amount"', 30, '"Class"', shared=False))
def hist_by_class_own_range(spark, d):
    return rounded(profile.histogram(tx(spark, d), "Amount", 30, by="Class", shared_range=False))


@query("hour_histogram", f"""WITH {TXH}, h AS (SELECT unnest(range(24))::INTEGER AS hour)
SELECT h.hour, h.hour - 0.5::DOUBLE AS "left", h.hour + 0.5::DOUBLE AS "right", count(txh."Hour") AS count FROM h LEFT JOIN txh ON h.hour = txh."Hour" GROUP BY 1""")
def hour_histogram(spark, d):
    return profile.hour_histogram(txh(spark, d))


@query("box_by_class", f"""WITH {TX}, q AS (SELECT "Class", quantile_cont("Amount", 0.25) AS q1, quantile_cont("Amount", 0.5) AS median,
quantile_cont("Amount", 0.75) AS q3 FROM tx GROUP BY 1),
j AS (SELECT *, "Amount" >= q1 - 1.5 * (q3 - q1) AND "Amount" <= q3 + 1.5 * (q3 - q1) AS inside FROM tx JOIN q USING ("Class"))
SELECT "Class", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, min("Amount") FILTER (inside) AS whisker_low,
max("Amount") FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers, count(*) AS count FROM j GROUP BY "Class", q1, median, q3""")
def box_by_class(spark, d):
    return rounded(profile.box_summary(tx(spark, d), "Amount", "Class"))


QUANTILE_PROBS = (0.001, 0.5, 0.9, 0.999)


@query("exact_quantiles", " UNION ALL ".join(
    f"""SELECT l_linestatus, '{c}' AS "column", {p}::DOUBLE AS prob, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem GROUP BY 1"""
    for c in ("l_extendedprice", "l_quantity") for p in QUANTILE_PROBS))
def exact_quantiles(spark, d):
    items = tables.sample_table(spark, d, "lineitem")
    return rounded(quantiles(items, ["l_extendedprice", "l_quantity"], QUANTILE_PROBS, ["l_linestatus"]).drop("n"))


@query("top_amounts", f'WITH {TX} SELECT row_id, "Amount", "Class" FROM tx ORDER BY "Amount" DESC, row_id LIMIT 5')
def top_amounts(spark, d):
    return profile.top_rows(tx(spark, d), "Amount", "row_id").select("row_id", "Amount", "Class")


@query("largest_deviations", f"""WITH {TX} SELECT row_id, round("Amount" - 50, 6) AS deviation FROM tx ORDER BY abs("Amount" - 50) DESC, row_id LIMIT 10""")
def largest_deviations(spark, d):
    t = tx(spark, d).select("row_id", (F.col("Amount") - 50).alias("deviation"))
    return rounded(profile.top_absolute(t, "deviation", "row_id", 10))


@query("multi_key_sort", f"""WITH {TXH} SELECT "Hour", "Class", count(*) AS n FROM txh GROUP BY 1, 2 ORDER BY "Class", n DESC, "Hour" LIMIT 20""")
def multi_key_sort(spark, d):
    g = txh(spark, d).groupBy("Hour", "Class").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.asc("Class"), F.desc("n"), F.asc("Hour")).limit(20)


@query("column_reductions", """SELECT 'l_quantity' AS "column", sum(l_quantity) AS sum, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std,
min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem UNION ALL SELECT 'l_linenumber', sum(l_linenumber)::DOUBLE, round(avg(l_linenumber), 6),
round(stddev_pop(l_linenumber), 6), min(l_linenumber)::DOUBLE, max(l_linenumber)::DOUBLE FROM lineitem""")
def column_reductions(spark, d):
    return rounded(profile.column_reductions(tables.sample_table(spark, d, "lineitem"), ["l_quantity", "l_linenumber"]))


@query("row_reductions", """SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 4) AS total, round(list_avg(embedding::DOUBLE[]), 4) AS mean,
round(list_stddev_pop(embedding::DOUBLE[]), 4) AS std FROM embeddings""")
def row_reductions(spark, d):
    e = tables.sample_table(spark, d, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    return rounded(e.select("vec_id", vectors.array_sum("v").alias("total"), vectors.array_mean("v").alias("mean"),
                            vectors.array_std("v").alias("std")), 4)


@query("vector_arithmetic", """WITH a AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), z AS (SELECT v AS o FROM a ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(list_inner_product(v, o), 4) AS dot, round(list_distance(v, o), 4) AS distance FROM a, z""")
def vector_arithmetic(spark, d):
    a = tables.sample_table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    first = a.agg(F.min_by("v", "vec_id")).scalar()
    return rounded(a.withColumn("o", first).select("vec_id", vectors.dot("v", "o").alias("dot"),
                                                   vectors.euclidean("v", "o").alias("distance")), 4)


# Features ----------------------------------------------------------------------------------------------------

@query("hour_features", f"""WITH {TXH} SELECT row_id, "Hour", round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos,
CAST("Hour" < 6 AS INTEGER) AS night_flag FROM txh""")
def hour_features(spark, d):
    out = TimeFeatures(hour="Hour", sin="hour_sin", cos="hour_cos", night="night_flag").transform(tx(spark, d))
    return rounded(out.select("row_id", "Hour", "hour_sin", "hour_cos", "night_flag"))


@query("hour_before_start", f"""WITH {TX}, s AS (SELECT row_id, "Time" - 1000000 AS "Time" FROM tx) SELECT row_id, {HOUR} AS hour FROM s""")
def hour_before_start(spark, d):
    return tx(spark, d).select("row_id", fx.hour_of_day(F.col("Time") - 1000000).alias("hour"))


AMOUNT_Q = 'q AS (SELECT quantile_cont("Amount", 0.5) AS q50, quantile_cont("Amount", 0.9) AS q90, quantile_cont("Amount", 0.95) AS q95, ' \
           'quantile_cont("Amount", 0.99) AS q99, avg("Amount") AS mu, stddev_pop("Amount") AS sd FROM tx)'


@query("amount_features", f"""WITH {TX}, {AMOUNT_Q} SELECT row_id, round(ln(1 + "Amount"), 6) AS log_amount, CAST("Amount" > q90 AS INTEGER) AS amount_gt_90,
CAST("Amount" > q95 AS INTEGER) AS amount_gt_95, CAST("Amount" > q99 AS INTEGER) AS amount_gt_99,
CAST("Amount" >= q50 AS INTEGER) + CAST("Amount" >= q90 AS INTEGER) + CAST("Amount" >= q99 AS INTEGER) AS amount_bin,
round(("Amount" - mu) / sd, 6) AS amount_scaled FROM tx, q""")
def amount_features(spark, d):
    t = tx(spark, d)
    out = AmountFeatures().fit(t).transform(t)
    return rounded(out.select("row_id", "log_amount", "amount_gt_90", "amount_gt_95", "amount_gt_99", "amount_bin", "amount_scaled"))


@query("engineered_set", f"""WITH {TXH} SELECT row_id, "Hour", round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos,
round("Amount_log1p", 6) AS "Amount_log1p" FROM txh""")
def engineered_set(spark, d):
    return rounded(txh(spark, d).select("row_id", "Hour", "hour_sin", "hour_cos", "Amount_log1p"))


@query("zscore_amount", f"""WITH {TX} SELECT row_id, round(("Amount" - (SELECT avg("Amount") FROM tx)) / (SELECT stddev_pop("Amount") FROM tx), 6) AS "Amount_scaled" FROM tx""")
def zscore_amount(spark, d):
    t = tx(spark, d)
    return rounded(PopulationScaler(inputCols=["Amount"], outputCols=["Amount_scaled"]).fit(t).transform(t)
                   .select("row_id", "Amount_scaled"))


@query("auto_scaling", f"""WITH {TX}, l AS (SELECT row_id, ln(1 + "Amount") AS v FROM tx) SELECT row_id,
round((v - (SELECT avg(v) FROM l)) / (SELECT stddev_pop(v) FROM l), 6) AS "Amount_scaled", CASE WHEN (SELECT skewness("Amount") FROM tx) > 1 THEN 'logz' ELSE 'zscore' END AS method FROM l""")
def auto_scaling(spark, d):
    t = tx(spark, d)
    model = AutoScaler(inputCol="Amount", outputCol="Amount_scaled").fit(t)
    return rounded(model.transform(t).select("row_id", "Amount_scaled", F.lit(model.method).alias("method")))


@query("minmax_scores", f"""WITH {TX} SELECT row_id, round(("Amount" - (SELECT min("Amount") FROM tx)) / ((SELECT max("Amount") FROM tx) - (SELECT min("Amount") FROM tx) + 1e-12), 6) AS score FROM tx""")
def minmax_scores(spark, d):
    t = tx(spark, d)
    ends = t.agg(F.struct(F.min("Amount").alias("lo"), F.max("Amount").alias("hi"))).scalar()
    return rounded(t.select("row_id", fx.min_max("Amount", ends["lo"], ends["hi"]).alias("score")))


# Correlation -------------------------------------------------------------------------------------------------

def pairs_sql(measure: str, source: str, columns) -> str:
    cols = list(columns)
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round({measure}("{a}"::DOUBLE, "{b}"::DOUBLE), 4) AS value FROM {source}"""
        for i, a in enumerate(cols) for b in cols[i:])


@query("corr_matrix", f"WITH {TXH} " + pairs_sql("corr", "txh", SEVEN))
def corr_matrix(spark, d):
    return rounded(correlate.pearson_matrix(engineered_columns(spark, d), SEVEN), 4)


@query("covariance_matrix", f"WITH {TXH} " + pairs_sql("covar_samp", "txh", SEVEN[1:]))
def covariance_matrix(spark, d):
    return rounded(correlate.covariance_matrix(engineered_columns(spark, d), SEVEN[1:]), 4)


@query("dense_corr_matrix", """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS i FROM embeddings)
SELECT 'e' || a.i AS column_a, 'e' || b.i AS column_b, round(corr(a.x, b.x), 4) AS value FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def dense_corr_matrix(spark, d):
    names = [f"e{i}" for i in range(64)]
    return rounded(correlate.dense_pearson(tables.embedding_features(spark, d, 64), names), 4)


@query("corr_target", f"WITH {TXH}, " + "c AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, corr("{c}"::DOUBLE, "Class"::DOUBLE) AS r FROM txh""" for c in SIX)
    + ") SELECT feature, round(r, 6) AS correlation FROM c ORDER BY abs(r) DESC, feature LIMIT 4")
def corr_target(spark, d):
    return rounded(correlate.correlation_with_target(engineered_columns(spark, d), SIX, top=4))


def average_rank_sql(column: str, source: str) -> str:
    return f'(rank() OVER (ORDER BY "{column}") + (count(*) OVER (PARTITION BY "{column}") - 1) / 2.0)::DOUBLE AS "{column}"'


RANKED = f"r AS (SELECT " + ", ".join(average_rank_sql(c, "txh") for c in ("Amount", "Hour", "hour_cos", "Class")) + " FROM txh)"
SPEARMAN_COLUMNS = ("Amount", "Hour", "hour_cos", "Class")


@query("spearman_matrix", f"WITH {TXH.replace('cos(2*pi()', 'round(cos(2*pi()').replace('AS hour_cos', ', 9) AS hour_cos')}, {RANKED} " + pairs_sql("corr", "r", SPEARMAN_COLUMNS))
def spearman_matrix(spark, d):
    t = txh(spark, d).withColumn("hour_cos", F.round("hour_cos", 9))
    return rounded(correlate.spearman_matrix(t, SPEARMAN_COLUMNS, "row_id"), 4)


@query("spearman_target", f"WITH {TXH}, {RANKED} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(corr("{c}", "Class"), 6) AS correlation FROM r""" for c in ("Amount", "Hour")))
def spearman_target(spark, d):
    return rounded(correlate.spearman_with_binary_target(txh(spark, d), ["Amount", "Hour"]))


def mi_sql(columns, bins: int) -> str:
    parts = []
    for c in columns:
        edges = ", ".join(f'quantile_cont("{c}", {i / bins})' for i in range(1, bins))
        parts.append(f"""SELECT '{c}' AS feature, len(list_filter((SELECT list_distinct([{edges}]) FROM txh), lambda e: e <= txh."{c}")) AS bin, "Class" AS y FROM txh""")
    return "l AS (" + " UNION ALL ".join(parts) + """), j AS (SELECT feature, bin, y, count(*)::DOUBLE AS c FROM l GROUP BY ALL),
m AS (SELECT *, sum(c) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature, bin) AS nx, sum(c) OVER (PARTITION BY feature, y) AS ny FROM j)
SELECT feature, round(sum(c / n * ln(c * n / (nx * ny))), 6) AS mutual_information FROM m GROUP BY 1"""


@query("mutual_information_binned", f"WITH {TXH}, " + mi_sql(("Time", "Amount", "Hour"), 10))
def mutual_information_binned(spark, d):
    return rounded(correlate.binned_mutual_information(txh(spark, d), ["Time", "Amount", "Hour"]))


@query("target_discovery", f'WITH {TX} SELECT \'Class\' AS target, count(*) AS n FROM tx')
def target_discovery(spark, d):
    t = tx(spark, d)
    return t.agg(F.lit(find_target(t)).alias("target"), F.count(F.lit(1)).alias("n"))
