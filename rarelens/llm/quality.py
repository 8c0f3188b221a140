"""Document quality: gated-attention multiple-instance learning over passages.

A document is a bag of passages of 64 words (the last is shorter; a text without words is one passage). The whole text is read.

- Every passage is encoded: square roots of the shares of byte-class pairs (letters by case, digits, spaces, kinds of marks),
  word shapes and repetition, and a signed hash projection of its words; standardised, then h = tanh(W x + b).
- Gated attention weighs passages: a_k is the softmax over the document of w . (tanh(V h_k) * sigmoid(U h_k)).
- The weighted passage representation sum a_k h_k is scored by a logistic unit. All weights are learned together from
  document labels alone.

Learning uses a bounded sample: at most about `max_labelled` labelled documents, drawn by the digest of the id, of at most
`max_learned_bytes` each; their encoded passages (under 400 bytes each) are all that reaches the driver. Scoring reads every
document once, in chunks of passages; the model is a few thousand numbers.

Defined results: null and empty texts are one passage without words; labels that are null or not 0/1 are not learned from; of
several labels of one id the greatest counts; without both classes every score is the smoothed share of label 1; repeated
rows get equal scores; other columns, whatever their names, are not read; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.llm.batches import Rolling, id_and_text, lowered, slices, words_of
from rarelens.session import ship_with_tasks

ship_with_tasks(__name__)

PASSAGE_WORDS = 64
#: Passages encoded at once have about so many bytes.
CHUNK_BYTES = 1 << 20
PROJECTIONS = 32


def _byte_classes() -> np.ndarray:
    """Class of every byte: 0 other control, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 full stop, 7 comma, 8 quotes and
    brackets, 9 hyphens and slashes, 10 other marks, 11 beyond ASCII."""
    kind = np.zeros(256, np.int64)
    kind[33:127] = 10
    kind[ord("a"):ord("z") + 1], kind[ord("A"):ord("Z") + 1], kind[ord("0"):ord("9") + 1] = 1, 2, 3
    for chars, k in ((" \t", 4), ("\n\r", 5), (".", 6), (",", 7), ("'\"()[]{}", 8), ("-_/\\", 9)):
        kind[[ord(c) for c in chars]] = k
    kind[128:] = 11
    return kind


CLASSES = _byte_classes()
KINDS = 12
DIMS = KINDS * KINDS + 5 + PROJECTIONS


def bags(data: np.ndarray, offsets: np.ndarray):
    """(word starts, word stops, first word of each passage and the end, passage of each text and the end, byte edges)."""
    start, stop, row = words_of(data, offsets)
    texts = len(offsets) - 1
    words = np.bincount(row, minlength=texts)
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    base = np.concatenate([[0], np.cumsum(passages)])
    first_word = np.concatenate([[0], np.cumsum(words)])
    within = np.arange(base[-1]) - np.repeat(base[:-1], passages)
    first = np.repeat(first_word[:-1], passages) + within * PASSAGE_WORDS
    # a text's first passage begins where the text does; the others at their first word
    begin = np.where(within == 0, np.repeat(offsets[:-1], passages), start[np.minimum(first, max(len(start) - 1, 0))] if len(start) else 0)
    return start, stop, np.append(first, len(start)), base, np.append(begin, offsets[-1])


def encoded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passages by DIMS, first passage of each text and the end, byte edges of the passages) of a slice of texts."""
    start, stop, first, base, edges = bags(data, offsets)
    count = len(edges) - 1
    out = np.zeros((count, DIMS), np.float32)
    a = 0
    while a < count:
        b = min(count, max(a + 1, int(np.searchsorted(edges, edges[a] + CHUNK_BYTES, "right")) - 1))
        words = slice(first[a], first[b])
        out[a:b] = _encode(data[edges[a]:edges[b]], edges[a:b + 1] - edges[a], start[words] - edges[a], stop[words] - edges[a], first[a:b + 1] - first[a])
        a = b
    return out, base, edges


def _encode(data: np.ndarray, edges: np.ndarray, start: np.ndarray, stop: np.ndarray, first: np.ndarray) -> np.ndarray:
    count, sizes, words = len(edges) - 1, np.diff(edges), np.diff(first)
    out = np.zeros((count, DIMS), np.float32)
    if not len(data):
        return out
    kind = CLASSES[data]
    passage = np.repeat(np.arange(count), sizes)
    # the pair of a passage's last byte and the next byte belongs to no passage
    inside = passage[1:] == passage[:-1]
    pairs = (passage[:-1] * KINDS + kind[:-1]) * KINDS + kind[1:]
    shares = np.bincount(pairs[inside], minlength=count * KINDS * KINDS).reshape(count, -1) / np.maximum(sizes, 1)[:, None]
    at = KINDS * KINDS
    out[:, :at] = np.sqrt(shares)
    out[:, at] = words / PASSAGE_WORDS
    if not len(start):
        return out
    owner = np.repeat(np.arange(count), words)
    some = np.maximum(words, 1)
    out[:, at + 1] = np.bincount(owner, np.log1p(np.minimum(stop - start, 1000)), count) / some
    hashes = Rolling(lowered(data)).of(start, stop)
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    out[:, at + 2] = np.bincount(owner[order], fresh, count) / some
    again = np.zeros(len(start), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out[:, at + 3] = np.bincount(owner, again, count) / some
    marks = CLASSES[data[stop - 1]]
    out[:, at + 4] = np.bincount(owner, (marks >= 8) & (marks <= 10), count) / some
    signs = ((hashes[:, None] >> np.arange(PROJECTIONS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
    full = np.flatnonzero(words)
    out[full, at + 5:] = np.add.reduceat(signs, first[:-1][full]) / np.sqrt(some[full])[:, None]
    return out


@dataclass
class Model:
    """Standardisation and weights; without weights the score is constant."""

    constant: float
    mean: np.ndarray = field(default_factory=lambda: np.zeros(DIMS, np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(DIMS, np.float32))
    weights: dict[str, np.ndarray] | None = None

    def bags(self, x: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score of every text, attention of every passage)."""
        if self.weights is None:
            return np.full(len(base) - 1, self.constant), 1 / np.repeat(np.diff(base), np.diff(base)).astype(float)
        state = forward(self.weights, (x - self.mean) * self.scale, base)
        return state["p"], state["a"]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def forward(w: dict[str, np.ndarray], x: np.ndarray, base: np.ndarray) -> dict[str, np.ndarray]:
    """All intermediate values of bags of standardised passages; bag i is passages base[i] to base[i + 1], never empty."""
    owner = np.repeat(np.arange(len(base) - 1), np.diff(base))
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
    e = (t * g) @ w["w"]
    e = np.exp(e - np.maximum.reduceat(e, base[:-1])[owner])
    a = e / np.add.reduceat(e, base[:-1])[owner]
    z = np.add.reduceat(a[:, None] * h, base[:-1])
    return {"x": x, "owner": owner, "h": h, "t": t, "g": g, "a": a, "z": z, "p": sigmoid(z @ w["c"] + w["c0"])}


def gradients(w: dict[str, np.ndarray], s: dict[str, np.ndarray], y: np.ndarray, base: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss of the bags."""
    out = (s["p"] - y) / len(y)
    down = (out[:, None] * w["c"])[s["owner"]]
    da = (down * s["h"]).sum(1)
    de = s["a"] * (da - np.add.reduceat(s["a"] * da, base[:-1])[s["owner"]])
    gated = de[:, None] * w["w"]
    dt, dg = gated * s["g"] * (1 - s["t"] ** 2), gated * s["t"] * s["g"] * (1 - s["g"])
    dh = (s["a"][:, None] * down + dt @ w["V"].T + dg @ w["U"].T) * (1 - s["h"] ** 2)
    return {"c": s["z"].T @ out, "c0": out.sum(), "w": (s["t"] * s["g"]).T @ de, "V": s["h"].T @ dt, "U": s["h"].T @ dg,
            "W": s["x"].T @ dh, "b": dh.sum(0)}


def start_weights(hidden: int, gates: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {"W": rng.normal(0, DIMS ** -0.5, (DIMS, hidden)), "b": np.zeros(hidden), "V": rng.normal(0, hidden ** -0.5, (hidden, gates)),
            "U": rng.normal(0, hidden ** -0.5, (hidden, gates)), "w": rng.normal(0, gates ** -0.5, gates), "c": rng.normal(0, hidden ** -0.5, hidden),
            "c0": np.zeros(())}


def learn(x: np.ndarray, base: np.ndarray, y: np.ndarray, hidden: int = 24, gates: int = 12, epochs: int = 20, batch: int = 128,
          rate: float = 5e-3, decay: float = 1e-4, seed: int = 42) -> Model:
    """Adam over batches of bags."""
    mean, spread = x.mean(0), x.std(0)
    model = Model(float(y.mean()), mean.astype(np.float32), np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0).astype(np.float32))
    x = (x - model.mean) * model.scale
    w = start_weights(hidden, gates, seed)
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    rng, step, sizes = np.random.default_rng(seed + 1), 0, np.diff(base)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            some, step = order[at:at + batch], step + 1
            own = np.concatenate([[0], np.cumsum(sizes[some])])
            rows = np.repeat(base[some] - own[:-1], sizes[some]) + np.arange(own[-1])
            g = gradients(w, forward(w, x[rows], own), y[some], own)
            for k in w:
                slope = g[k] + (decay * w[k] if k not in ("b", "c0") else 0)
                m[k], v[k] = 0.9 * m[k] + 0.1 * slope, 0.999 * v[k] + 0.001 * slope ** 2
                w[k] = w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    model.weights = {k: a.astype(np.float32) for k, a in w.items()}
    return model


def _encode_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, data, offsets in slices(batches):
        x, base, _ = encoded(data, offsets)
        x = x.astype(np.float16)
        yield pa.RecordBatch.from_arrays([ids, pa.array([x[a:b].tobytes() for a, b in zip(base[:-1], base[1:], strict=True)], pa.binary())], names=["id", "x"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = 6_000,
        max_learned_bytes: int = 200_000, **how) -> Model:
    """A model from at most about `max_labelled` of the labelled documents; `how` goes to `learn`."""
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
             .where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label")))
    share = min(1.0, max_labelled / max(known.count(), 1))
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # the sample's ids are few enough to broadcast
    rows = id_and_text(docs, id_col, text_col).where(F.octet_length("text") <= max_learned_bytes).join(F.broadcast(sample), "id").select("id", "text")
    found = rows.mapInArrow(_encode_sample, "id long, x binary").join(F.broadcast(sample), "id").toPandas()
    found = found.sort_values(["id", "x"])
    y = found["label"].to_numpy(float)
    ones = float(y.sum())
    if not 0 < ones < len(y):
        return Model((ones + 0.5) / (len(y) + 1.0))
    bags_of = [np.frombuffer(b, np.float16).reshape(-1, DIMS) for b in found["x"]]
    base = np.concatenate([[0], np.cumsum([len(b) for b in bags_of])])
    return learn(np.concatenate(bags_of).astype(np.float32), base, y, **how)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_passages, top_first_byte, top_end_byte, top_attention): a document's score and its most attended passage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in slices(batches):
            x, base, edges = encoded(data, offsets)
            p, a = shared.value.bags(x, base)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(base))
            top = np.lexsort((np.arange(len(a)), -a, owner))[base[:-1]]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(p.astype(float)), pa.array(np.diff(base)), pa.array((edges[top] - offsets[:-1]).astype(np.int64)),
                 pa.array((edges[top + 1] - offsets[:-1]).astype(np.int64)), pa.array(a[top].astype(float))],
                names=["id", "score", "n_passages", "top_first_byte", "top_end_byte", "top_attention"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "id long, score double, n_passages long, top_first_byte long, top_end_byte long, top_attention double").withColumnRenamed("id", id_col)
