import random
import zlib

import numpy as np

from rarelens.llm import toxicity
from rarelens.llm.catalog import QUERIES
from tests.llm.brute import no_docs, odd_docs


def labelled(n=900, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("abcdeo") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 150))]
        toxic = int(rng.random() < 0.2)
        for _ in range(toxic * rng.randint(1, 4)):
            words.insert(rng.randint(0, len(words)), rng.choice(["Villain!", "rottenest", "rottenly", "scoundrel."]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_documents(spark):
    rows = labelled()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    train = df.where("doc_id % 3 != 1")
    model = toxicity.fit(df, train.select("doc_id", "toxic"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    test = [(got[i], t) for i, _, t in rows if i % 3 == 1]
    assert all(0 <= s <= 1 for s, _ in test)
    assert sum(s >= 0.7 for s, t in test if t) >= 0.95 * sum(t for _, t in test) and sum(s >= 0.7 for s, t in test if not t) <= 2
    places = toxicity.passages(df.where("toxic = 1"), model).where("evidence > 0")
    texts = {i: t for i, t, _ in rows}
    for r in places.limit(20).collect():
        assert any(w in texts[r["doc_id"]].encode()[r["first_byte"]:r["end_byte"]].decode() for w in ("illain", "rotten", "scoundrel"))


def plain_segments(score):
    """All maximal segments by their recursive definition: the best one, then both sides of it."""
    def search(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += score[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12 or (abs(total - best[2]) <= 1e-12 and (j + 1 - i) < best[1] - best[0])):
                    best = (i, j + 1, total)
        return [] if best is None else [*search(a, best[0]), best, *search(best[1], b)]
    return search(0, len(score))


def test_segments_are_all_maximal_ones():
    rng = np.random.default_rng(8)
    for _ in range(200):
        score = np.where(rng.random(rng.integers(0, 25)) < 0.4, rng.random(), -rng.random()) * rng.random()
        got = toxicity.segments(score, 0, len(score), np.flatnonzero(score > 0))
        want = plain_segments(score)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]


def test_query_holds_out_a_third(spark, small):
    rows = QUERIES["op10_toxicity"](spark, small).collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    one_class = spark.createDataFrame([(1, 0), (2, 0), (3, None), (None, 1), (4, 7)], "doc_id long, toxic int")
    model = toxicity.fit(docs, one_class)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(scores) == 16 and len(set(scores.values())) == 1 and 0 < scores[0] < 0.5
    assert toxicity.score(no_docs(spark), model).count() == 0 and toxicity.passages(docs, model).count() == 0
    toxicity.fit(no_docs(spark), one_class.where("false"))


def test_half_of_the_labels_toxic(spark):
    rng = random.Random(9)
    rows = [(i, t, y) for i, t, y in labelled(2400, 11)]
    toxic = [r for r in rows if r[2]]
    clean = [r for r in rows if not r[2]][:len(toxic)]
    # the marks are in some clean texts as well
    clean = [(i, t + " " + rng.choice(["villain", "scoundrel"]) if rng.random() < 0.05 else t, y) for i, t, y in clean]
    df = spark.createDataFrame(toxic + clean, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.where("doc_id % 3 != 1").select("doc_id", "toxic"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    test = [(got[i], y) for i, _, y in toxic + clean if i % 3 == 1]
    assert len(model.features) and model.odds.max() > 0
    assert sum((s >= 0.5) == bool(y) for s, y in test) >= 0.9 * len(test)
