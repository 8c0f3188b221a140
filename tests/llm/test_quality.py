import math
import random
import zlib

import numpy as np

from rarelens.llm import quality
from rarelens.llm.catalog import QUERIES
from tests.llm.brute import ODD_TEXTS, no_docs, odd_docs


def arrays(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def plain_passages(text):
    """Byte ranges of a text's passages: 64 words each, beginning with their first word, the first with the text."""
    raw = (text or "").encode()
    starts = [i for i, b in enumerate(raw) if b not in b" \t\n\v\f\r" and (i == 0 or raw[i - 1] in b" \t\n\v\f\r")]
    begins = [0, *starts[64::64]]
    return list(zip(begins, [*begins[1:], len(raw)]))


def test_passages_cover_whole_texts():
    data, offsets = arrays(ODD_TEXTS)
    _, _, _, base, edges = quality.bags(data, offsets)
    for i, text in enumerate(ODD_TEXTS):
        got = [(int(a - offsets[i]), int(b - offsets[i])) for a, b in zip(edges[base[i]:base[i + 1]], edges[base[i] + 1:base[i + 1] + 1])]
        assert got == plain_passages(text)


def test_encoding_does_not_depend_on_chunks_or_neighbours(monkeypatch):
    data, offsets = arrays(ODD_TEXTS)
    whole, base, _ = quality.encoded(data, offsets)
    monkeypatch.setattr(quality, "CHUNK_BYTES", 500)
    assert np.array_equal(quality.encoded(data, offsets)[0], whole)
    for i, text in enumerate(ODD_TEXTS):
        assert np.allclose(quality.encoded(*arrays([text]))[0], whole[base[i]:base[i + 1]], atol=1e-6)


def test_encoding_of_a_small_passage():
    x = quality.encoded(*arrays(["Ab ab AB? 7"]))[0][0]
    shares = {(2, 1): 1, (1, 4): 2, (4, 1): 1, (1, 1): 1, (4, 2): 1, (2, 2): 1, (2, 10): 1, (10, 4): 1, (4, 3): 1}
    want = np.zeros(quality.KINDS ** 2)
    for (a, b), n in shares.items():
        want[a * quality.KINDS + b] = math.sqrt(n / 11)
    assert np.allclose(x[:len(want)], want)
    shapes = x[len(want):len(want) + 5]
    assert np.allclose(shapes, [4 / 64, (2 * math.log(3) + math.log(4) + math.log(2)) / 4, 3 / 4, 1 / 4, 1 / 4])


def plain_bag(w, rows):
    sig = lambda v: 1 / (1 + math.exp(-v))
    hs, es = [], []
    for x in rows:
        h = [math.tanh(sum(x[d] * w["W"][d][j] for d in range(len(x))) + w["b"][j]) for j in range(len(w["b"]))]
        gate = [math.tanh(sum(h[j] * w["V"][j][i] for j in range(len(h)))) * sig(sum(h[j] * w["U"][j][i] for j in range(len(h)))) for i in range(len(w["w"]))]
        hs.append(h)
        es.append(math.exp(sum(g * v for g, v in zip(gate, w["w"]))))
    a = [e / sum(es) for e in es]
    z = [sum(a[k] * hs[k][j] for k in range(len(rows))) for j in range(len(w["c"]))]
    return sig(sum(p * q for p, q in zip(z, w["c"])) + float(w["c0"])), a


def test_forward_equals_plain_attention():
    rng = np.random.default_rng(1)
    w = quality.start_weights(5, 3, 2)
    base = np.array([0, 1, 4, 11])
    x = rng.normal(size=(11, quality.DIMS))
    s = quality.forward(w, x, base)
    for i in range(3):
        p, a = plain_bag(w, x[base[i]:base[i + 1]])
        assert np.isclose(s["p"][i], p) and np.allclose(s["a"][base[i]:base[i + 1]], a)


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    w = {k: np.array(v + rng.normal(0, 0.1, v.shape)) for k, v in quality.start_weights(4, 3, 4).items()}
    base, y = np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    x = rng.normal(size=(9, quality.DIMS))

    def loss(v):
        p = quality.forward(v, x, base)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    g = quality.gradients(w, quality.forward(w, x, base), y, base)
    for k in w:
        for place in list(np.ndindex(w[k].shape))[:12]:
            up, down = {**w, k: w[k].copy()}, {**w, k: w[k].copy()}
            up[k][place] += 1e-5
            down[k][place] -= 1e-5
            assert np.isclose((loss(up) - loss(down)) / 2e-5, g[k][place], atol=1e-6)


def labelled(n, seed):
    """Bad documents hold one shouted or repeated passage somewhere among ordinary ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeorst") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(n):
        passages = [" ".join(word() for _ in range(64)) for _ in range(rng.randint(1, 8))]
        good = int(rng.random() < 0.6)
        if not good:
            passages[rng.randrange(len(passages))] = " ".join([word().upper() + "!!" for _ in range(64)] if i % 2 else [word()] * 64)
        rows.append((i, " ".join(passages), good))
    return rows


def test_held_out_documents_and_attention(spark):
    rows = labelled(900, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(df, df.where("doc_id % 3 != 1").select("doc_id", "quality"))
    got = {r["doc_id"]: r for r in quality.score(df, model).collect()}
    test = [(got[i], t, y) for i, t, y in rows if i % 3 == 1]
    assert sum((r["score"] >= 0.5) == bool(y) for r, _, y in test) >= 0.95 * len(test)
    bad = [(r, t) for r, t, y in test if not y and r["score"] < 0.5]
    seen = [t.encode()[r["top_first_byte"]:r["top_end_byte"]].decode().split() for r, t in bad]
    # the passage that makes a document bad is the one attended to
    assert sum(len(set(p)) == 1 or p[0].isupper() for p in seen) >= 0.8 * len(seen)


def test_query_holds_out_a_quarter(spark, small):
    rows = QUERIES["op13_quality"](spark, small).collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    one_class = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    model = quality.fit(docs, one_class)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert len(scores) == 16 and set(scores.values()) == {2.5 / 3}
    both = spark.createDataFrame([(0, 0), (1, 0), (7, 1), (8, 1), (8, 0), (10, 1)], "doc_id long, quality int")
    rows = quality.score(docs, quality.fit(docs, both)).collect()
    assert len(rows) == 17 and all(0 <= r["score"] <= 1 and r["n_passages"] >= 1 for r in rows)
    assert len({(r["doc_id"], r["score"]) for r in rows}) == 16
    assert quality.score(no_docs(spark), model).count() == 0
    assert quality.fit(no_docs(spark), both).weights is None and quality.fit(docs, both.where("false")).constant == 0.5
