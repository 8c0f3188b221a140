import hashlib

from rarelens.llm import fingerprint
from rarelens.llm.catalog import QUERIES
from tests.llm.brute import no_docs, odd_docs


def edited(docs: dict):
    ids = sorted(docs, reverse=True)
    out = {}
    for i, n in zip(ids, ids[1:] + ids[:1]):
        text, half = docs[i] or "", len(docs[i] or "") // 2
        out[i] = text[:len(text) - half] + (docs[n] or "")[:half]
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_edited_texts_and_likeness(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op9_document_fingerprints"](spark, small).collect()}
    assert {i: r["edited_sha256"] for i, r in rows.items()} == {i: sha(t) for i, t in edited(docs).items()}
    assert all(r["n_chars"] == len(docs[i]) and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for i, r in rows.items())
    same = {}
    for i, r in rows.items():
        same.setdefault(docs[i], set()).add(r["fingerprint"])
    assert all(len(s) == 1 for s in same.values()) and len({r["fingerprint"] for r in rows.values()}) > 150
    mean = lambda c: sum(r[c] for r in rows.values()) / len(rows)
    assert mean("near_edited") > mean("near_next") + 0.1


def test_order_does_not_depend_on_the_ranges(spark):
    docs = {i * i * 37 % 1009: f"text number {i} has words {i % 7} and more" for i in range(50)}
    df = spark.createDataFrame(list(docs.items()), "id long, text string")
    for per_bucket in (1, 3, 1000):
        got = {r["id"]: r["next_id"] for r in fingerprint.with_next(df, per_bucket).collect()}
        ids = sorted(docs, reverse=True)
        assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_ids_far_apart_and_outlying(spark):
    ids = [-9 * 10**18, 5, 9 * 10**18, *range(100, 160)]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "id long, text string")
    for per_bucket in (1, 10, 1000):
        got = {r["id"]: (r["next_id"], r["next_text"]) for r in fingerprint.with_next(df, per_bucket).collect()}
        down = sorted(ids, reverse=True)
        assert got == {i: (n, f"text {n}") for i, n in zip(down, down[1:] + down[:1])}
    docs = df.where("abs(id) < 6 or abs(id) > 1000").withColumnRenamed("id", "doc_id")
    assert fingerprint.compare_edits(docs).count() == 3


def test_the_lexicon_is_the_band(spark):
    texts = [f"common w{i % 50} once{i}" for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    every = df.selectExpr("explode(split(text, ' ')) AS w").distinct()
    want = {r["h"] for r in every.selectExpr("w", "xxhash64(w) AS h").where("w LIKE 'w%'").collect()}
    assert {r["term"] for r in fingerprint.lexicon(df, 0.001, 0.1, 2).collect()} == want


def test_odd_rows(spark):
    got = {r["doc_id"]: r for r in fingerprint.compare_edits(odd_docs(spark)).collect()}
    docs = {r["doc_id"]: r["text"] for r in odd_docs(spark).where("doc_id is not null").collect()}
    assert {i: r["edited_sha256"] for i, r in got.items()} == {i: sha(t) for i, t in edited(docs).items()}
    assert got[7]["fingerprint"] == got[8]["fingerprint"] and got[0]["fingerprint"] == got[1]["fingerprint"]
    assert fingerprint.compare_edits(no_docs(spark)).count() == 0
    assert fingerprint.compare_edits(odd_docs(spark).where("doc_id = 7")).select("near_next").first()[0] in (0.0, 1.0)


def test_every_term_of_the_lexicon_counts(spark):
    texts = [f"common w{i // 4} v{i // 4}" for i in range(200)] + ["w1 v2", "w1 v3", "w1 v2", "never seen", "never seen", "other words", "", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    band = fingerprint.lexicon(rows, 0.001, 0.1, 3)
    found = {r["id"]: r["entries"] for r in fingerprint.fingerprints(rows, band, ["id"], []).collect()}
    assert all(found[i][0] == found[i - 1][0] for i in range(200) if i % 4)
    assert len({found[i][0] for i in range(0, 200, 4)}) == 50 and all(any(found[i][1:17]) for i in range(200))
    pairs = spark.createDataFrame([(found[a], found[b]) for a, b in ((200, 201), (200, 202), (203, 204), (203, 205), (206, 207))], "a array<int>, b array<int>")
    near = [r[0] for r in pairs.select(fingerprint.likeness("a", "b")).collect()]
    assert 0 < near[0] < 1 and near[1:] == [1.0, 1.0, 0.0, 1.0]
