"""Toxicity: maximal scoring segments over token log-odds, aggregated by extreme-value calibration.

Learning uses a bounded sample of labelled documents (`max_labelled`, drawn by the digest of the id):

- Features are words (ASCII letters in lower case, digits, bytes from 128) and their first 3 to 6 bytes. A feature's log-odds
  between toxic and clean documents is smoothed with a Dirichlet prior of the feature's overall frequency, whose mass in
  each class is `prior` times the class. Features are kept if they are significant, whatever their log-odds: the signed
  root of the likelihood ratio between their share of toxic documents and the overall share reaches `min_z`, or what
  chance alone reaches about once among so many features, sqrt(2 ln(features)), if that is more.
- A token scores the log-odds of its most significant feature, less `drift`; any other token costs `drift`. All maximal
  scoring segments of a text are found in one pass; each is a passage.
- For clean texts the best segment follows an extreme-value law: E = K n exp(-lambda S). Lambda solves
  sum p(s) exp(lambda s) = 1 over the clean tokens' scores, K comes from the clean texts. A text's evidence is the sum of
  -ln E over the passages with E < 1 (or the best one's), and a logistic curve fitted on the sample turns it into a score.

Scoring then reads every document once, with the features broadcast (their number is bounded by the sample).

Defined results: null and empty texts have no passage and get the score of no evidence; labels that are null or not 0/1 are
not learned from; without both classes every score is the smoothed share of toxic labels; repeated rows get equal scores;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.llm.batches import Rolling, id_and_text, lowered, mix, slices, words_of
from rarelens.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

PREFIXES = (3, 4, 5, 6)
SLOTS = 1 << 18


@dataclass
class Model:
    """Sorted feature hashes with their log-odds and significance, and the calibration."""

    features: np.ndarray
    odds: np.ndarray
    z: np.ndarray
    drift: float = 0.05
    scale: float = 1.0       # lambda
    log_k: float = 0.0
    intercept: float = 0.0
    slope: float = 0.0

    def evidence(self, n: int, passages: list[float]) -> float:
        """Summed -ln E of the significant passages, or that of the best one."""
        if not passages:
            return 0.0
        each = [self.scale * s - self.log_k - np.log(max(n, 1)) for s in passages]
        return max(0.0, max(each), sum(e for e in each if e > 0))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * evidence, -500, 500)))


def _inside(data: np.ndarray) -> np.ndarray:
    """Bytes of words: letters, digits and everything from 128."""
    return (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))


def _features(rolling: Rolling, start: np.ndarray, stop: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(token numbers, hashes): whole words, then prefixes of the words that are longer."""
    out = [(np.arange(len(start)), rolling.of(start, stop))]
    for k in PREFIXES:
        long = np.flatnonzero(stop - start > k)
        out.append((long, mix(rolling.of(start[long], start[long] + k) + np.uint64(k))))
    return out


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic documents, documents) of a slice of labelled (id, text, label) rows."""
    def labelled():
        for batch in batches:
            labels.append(np.asarray(batch.column(2).to_numpy(zero_copy_only=False), np.int64))
            yield batch
    labels: list[np.ndarray] = []
    done = 0
    for ids, data, offsets in slices(labelled()):
        own = np.concatenate(labels)[done:done + len(ids)]
        done += len(ids)
        data = lowered(data)
        start, stop, row = words_of(data, offsets, _inside(data))
        found = _features(Rolling(data), start, stop)
        hashes, rows = np.concatenate([h for _, h in found]), np.concatenate([row[t] for t, _ in found])
        order = np.lexsort((rows, hashes))
        hashes, rows = hashes[order], rows[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
        hashes, toxic = hashes[fresh], own[rows[fresh]]
        distinct, first, count = np.unique(hashes, return_index=True, return_counts=True)
        hits = np.add.reduceat(toxic, first) if len(first) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(hits.astype(np.int64)), pa.array(count.astype(np.int64))],
                                         names=["feature", "toxic", "docs"])


def token_scores(model: Model, data: np.ndarray, offsets: np.ndarray):
    """(start, stop, row, score) of the tokens of a slice."""
    data = lowered(data)
    start, stop, row = words_of(data, offsets, _inside(data))
    score, best = np.full(len(start), -model.drift), np.zeros(len(start))
    if len(start) and len(model.features):
        slots = np.zeros(SLOTS, bool)
        slots[(model.features % np.uint64(SLOTS)).astype(np.int64)] = True
        for token, hashes in _features(Rolling(data), start, stop):
            maybe = np.flatnonzero(slots[(hashes % np.uint64(SLOTS)).astype(np.int64)])
            token, hashes = token[maybe], hashes[maybe]
            place = np.minimum(np.searchsorted(model.features, hashes), len(model.features) - 1)
            hit = model.features[place] == hashes
            token, place = token[hit], place[hit]
            better = np.abs(model.z[place]) > best[token]
            token, place = token[better], place[better]
            best[token] = np.abs(model.z[place])
            score[token] = model.odds[place] - model.drift
    return start, stop, row, score


def segments(score: np.ndarray, begin: int, end: int, positive: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end token, score) of tokens begin..end in linear time.

    `positive` lists the tokens of a positive score; what lies between two of them is one step down.
    """
    sums = np.concatenate([[0.0], np.cumsum(score[begin:end])])
    found: list[list] = []                                  # first, end, sum before, sum after
    for p in positive.tolist():
        piece = [p, p + 1, sums[p - begin], sums[p + 1 - begin]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= piece[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= piece[3]:
                found.append([*piece, j])
                break
            piece = [found[j][0], piece[1], found[j][2], piece[3]]
            del found[j:]
    return [(f[0], f[1], f[3] - f[2]) for f in found]


def _passages(model: Model, data: np.ndarray, offsets: np.ndarray):
    """(row, tokens, segments) of every text of a slice, and the tokens' byte ranges."""
    start, stop, row, score = token_scores(model, data, offsets)
    edges = np.searchsorted(row, np.arange(len(offsets)))
    positive = np.flatnonzero(score > 0)
    bounds = np.searchsorted(positive, edges)
    for r in range(len(offsets) - 1):
        own = positive[bounds[r]:bounds[r + 1]]
        yield r, int(edges[r + 1] - edges[r]), segments(score, edges[r], edges[r + 1], own) if len(own) else [], start, stop


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps with a small ridge."""
    w, design = np.zeros(2), np.column_stack([np.ones(len(x)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), design.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _lambda(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1; one further hit at the best score keeps it finite."""
    if not len(scores) or scores.max() <= 0:
        return 1.0
    counts = counts + (scores == scores.max())
    p = counts / counts.sum()
    if (p * scores).sum() >= 0:
        return 1e-3
    low, high = 1e-3, 50.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if np.log(np.sum(p * np.exp(np.clip(mid * scores, -700, 700)))) < 0 else (low, mid)
    return low


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_labelled: int = 50_000, min_z: float = 3.0, prior: float = 0.1, drift: float = 0.05) -> Model:
    """A model from at most about `max_labelled` of the labelled documents.

    The sample is the documents whose id digest falls under a cut, so its ids are few enough to broadcast.
    """
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
             .where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label")))
    total = known.count()
    share = min(1.0, max_labelled / max(total, 1))
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "id").select("id", "text", "label")
    counts = materialize(rows.mapInArrow(_presence, "feature long, toxic long, docs long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs")).where("docs >= 3"), "features")
    classes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bad, good = classes.get(1, 0), classes.get(0, 0)
    base = float(np.log((bad + 0.5) / (good + 0.5)))
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), drift, intercept=base)
    if not bad or not good:
        return empty
    hits, misses, each = F.col("toxic"), F.col("docs") - F.col("toxic"), bad / (bad + good)
    odds = F.log((hits + prior * each * F.col("docs")) / bad) - F.log((misses + prior * (1 - each) * F.col("docs")) / good)
    # twice the log of the likelihood ratio; a count of 0 adds nothing
    gain = lambda n, share: F.when(n > 0, n * F.log(n / (F.col("docs") * share))).otherwise(F.lit(0.0))
    z = F.signum(F.col("odds")) * F.sqrt(F.greatest(2 * (gain(hits, each) + gain(misses, 1 - each)), F.lit(0.0)))
    least = max(min_z, float(np.sqrt(2 * np.log(max(counts.count(), 1)))))
    table = (counts.withColumn("odds", odds).withColumn("z", z)
             .where(F.abs("z") >= least).select("feature", "odds", "z").toPandas().sort_values("feature"))
    model = empty
    if not len(table):
        return model
    hashes = table["feature"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    model.features, model.odds, model.z = hashes[order], table["odds"].to_numpy()[order], table["z"].to_numpy()[order]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels_of: list[np.ndarray] = []

        def labelled():
            for batch in batches:
                labels_of.append(np.asarray(batch.column(2).to_numpy(zero_copy_only=False), np.int64))
                yield batch
        done = 0
        for ids, data, offsets in slices(labelled()):
            own = np.concatenate(labels_of)[done:done + len(ids)]
            done += len(ids)
            tokens, best = [], []
            for _, n, found, _, _ in _passages(shared.value, data, offsets):
                tokens.append(n)
                best.append([s for _, _, s in found])
            _, _, row, score = token_scores(shared.value, data, offsets)
            values, times = np.unique(np.round(score[own[row] == 0], 3), return_counts=True)
            spread = [[] for _ in tokens]
            if spread:
                spread[0] = [float(v) for pair in zip(values, times, strict=True) for v in pair]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(tokens, pa.int64()), pa.array(best, pa.list_(pa.float64())),
                                              pa.array(spread, pa.list_(pa.float64()))], names=["label", "n", "best", "spread"])

    seen = rows.mapInArrow(observe, "label long, n long, best array<double>, spread array<double>").toPandas()
    pairs = np.concatenate([np.asarray(s, float).reshape(-1, 2) for s in seen["spread"] if len(s)] or [np.zeros((0, 2))])
    values, at = np.unique(pairs[:, 0], return_inverse=True)
    if model.odds.max() - drift > 0:       # the best possible score counts as seen once
        values, at = np.append(values, model.odds.max() - drift), at
    model.scale = _lambda(values, np.bincount(at, pairs[:, 1], minlength=len(values)))
    clean = seen[seen["label"] == 0]
    # K: on average one clean text in each has a best segment beyond its own expectation
    tails = [model.scale * max(b) - np.log(max(n, 1)) for b, n in zip(clean["best"], clean["n"], strict=True) if len(b)]
    model.log_k = float(np.log(max(np.sum(np.exp(np.minimum(tails, 0))) / max(len(clean), 1), 1e-2)))
    x = np.array([model.evidence(n, list(b)) for b, n in zip(seen["best"], seen["n"], strict=True)])
    model.intercept, model.slope = _fit_logistic(x, seen["label"].to_numpy(float))
    model.slope = max(model.slope, 0.0)
    return model


def passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first_byte, end_byte, segment_score, evidence): every passage, significant (evidence > 0) or not."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in slices(batches):
            names, out = ids.to_pylist(), []
            for r, n, found, start, stop in _passages(shared.value, data, offsets):
                out += [(names[r], int(start[a] - offsets[r]), int(stop[b - 1] - offsets[r]), float(s), shared.value.evidence(n, [s]))
                        for a, b, s in found]
            yield pa.RecordBatch.from_pylist([dict(zip(("id", "first_byte", "end_byte", "segment_score", "evidence"), o, strict=True)) for o in out],
                                             pa.schema([("id", pa.int64()), ("first_byte", pa.int64()), ("end_byte", pa.int64()),
                                                        ("segment_score", pa.float64()), ("evidence", pa.float64())]))

    return (id_and_text(docs, id_col, text_col)
            .mapInArrow(run, "id long, first_byte long, end_byte long, segment_score double, evidence double").withColumnRenamed("id", id_col))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_passages, evidence, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in slices(batches):
            tokens, count, evidence = [], [], []
            for _, n, found, _, _ in _passages(shared.value, data, offsets):
                tokens.append(n)
                count.append(len(found))
                evidence.append(shared.value.evidence(n, [s for _, _, s in found]))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(tokens, pa.int64()), pa.array(count, pa.int64()), pa.array(evidence, pa.float64()),
                                              pa.array(shared.value.score(np.array(evidence)), pa.float64())],
                                             names=["id", "n_tokens", "n_passages", "evidence", "score"])

    return (id_and_text(docs, id_col, text_col)
            .mapInArrow(run, "id long, n_tokens long, n_passages long, evidence double, score double").withColumnRenamed("id", id_col))
