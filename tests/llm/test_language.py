import pytest
from pyspark.sql import functions as F

from rarelens.llm import language
from rarelens.llm.catalog import QUERIES
from tests.llm.brute import no_docs, odd_docs


def test_documents_get_their_language(spark, small):
    got = QUERIES["op3_language_id"](spark, small).join(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == 200 and (got["language"] == got["lang"]).mean() > 0.97


def test_pages_get_their_language(spark, small):
    got = QUERIES["language_id_pages"](spark, small).toPandas()
    assert len(got) == 50 and got["language"].notna().mean() > 0.95


def test_host_priors_follow_the_hierarchy(spark):
    rows = [("a.x.com", [1.0, 0.0])] * 30 + [("b.x.com", [0.0, 1.0])] * 2 + [("c.org", [0.0, 1.0])] * 10 + [("", [0.5, 0.5])]
    df = spark.createDataFrame(rows, "host string, p array<double>").groupBy("host").agg(F.count("*").alias("n"), *language._sums("p", 2))
    got = {r["host"]: r["prior"] for r in language.host_priors(df, 2, kappa=4.0).collect()}

    def up(prior, own):
        return [(sum(p[i] for _, p in own) + 4.0 * prior[i]) / (len(own) + 4.0) for i in range(2)]
    for host, levels in (("a.x.com", ["", "com", "x.com", "a.x.com"]), ("b.x.com", ["", "com", "x.com", "b.x.com"]), ("c.org", ["", "org", "c.org"]), ("", [""])):
        prior = [0.5, 0.5]
        for level in levels:
            prior = up(prior, [r for r in rows if not level or r[0] == level or r[0].endswith("." + level)])
        assert got[host] == pytest.approx(prior)


def test_declared_language_suffix_and_host_decide_short_texts(spark):
    train = [("der und nicht die ist ein zu mit " * 20, "de"), ("the and of to in that with was " * 20, "en")] * 40
    model = language.fit_text(spark.createDataFrame(train, "text string, lang string"), F.col("text"), F.col("lang"), ("de", "en"))
    rows = [(t, "de" if lang == "de" else "en-GB", "x.de" if lang == "de" else "y.uk") for t, lang in train] + [("o", "de", "x.de"), ("o", "en", "y.uk"), ("12 34", "de", "x.de")]
    df = spark.createDataFrame(rows, "text string, tag string, host string")
    got = language.identify(df, declared=F.col("tag"), host=F.col("host"), suffix=F.substring_index("host", ".", -1), model=model).toPandas().tail(3)
    assert got["detected"].tolist()[:2] == ["de", "en"] and got["detected"].isna().tolist()[2]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = language.identify(docs, known_col="lang", declared=F.col("lang"), host=F.col("source"))
    assert out.columns == [*docs.columns, "detected", "confidence"] and out.count() == docs.count()
    got = {r["doc_id"]: r["detected"] for r in out.collect()}
    assert got[0] is None and got[1] is None and got[2] is None and got[10] == "en"
    assert language.identify(no_docs(spark), known_col="lang", host=F.col("source")).count() == 0
    unknown = docs.withColumn("lang", F.lit("xx"))
    assert language.identify(unknown, known_col="lang").where("detected is not null").count() == 0
    with pytest.raises(ValueError):
        language.identify(docs.withColumn("detected", F.lit(1)), known_col="lang")
