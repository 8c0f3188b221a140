"""Language identification by Bayesian fusion of four kinds of evidence.

log P(language | row) = host prior + text likelihood / temperature + log P(declared | language) + log P(suffix | language)

- Text: byte trigrams, hashed to `BINS`, under a naive Bayes model whose counts come from every row that has a known
  language. Overlapping trigrams are not independent, so the likelihood is divided by a temperature.
- Declared language (markup or metadata) and address suffix: their agreement with the text's verdict is counted over all
  rows by grouped aggregation and smoothed; an unknown or absent value says nothing.
- Host prior: sums of the text posteriors per host, then per parent domain up to the whole corpus. Every level is smoothed
  with its parent's prior: (own sums + kappa * parent prior) / (own rows + kappa).

A row is rejected (null language) when its text has no letter or its best posterior is under `min_posterior`.

Defined results: null texts are empty and hence rejected; null hosts, suffixes and declarations are absent evidence; repeated
rows are judged alike; an empty table gives an empty result; without any row of a known language every row is rejected.
Input columns are passed through untouched whatever their names, results are in columns of reserved names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarelens.llm.batches import bound_batches, lowered, mix, slices
from rarelens.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

BINS = 1 << 13
LANGUAGES = ("de", "en", "es", "fr")
KAPPA = 20.0
EVIDENCE = "__language_evidence"


@dataclass
class TextModel:
    languages: tuple[str, ...]
    log_p: np.ndarray            # languages x BINS
    known: bool


def _letters(data: np.ndarray) -> np.ndarray:
    return ((data >= 97) & (data <= 122)) | (data >= 128)


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, row) of the trigrams that hold a letter, within texts; white space and digits are folded."""
    data = lowered(data)
    letter = _letters(data)
    folded = np.where(letter, data, np.uint8(32)).astype(np.uint64)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = mix((folded[:-2] << np.uint64(16)) | (folded[1:-1] << np.uint64(8)) | folded[2:]) % np.uint64(BINS)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = (row[:-2] == row[2:]) & (letter[:-2] | letter[1:-1] | letter[2:])
    return code[keep].astype(np.int64), row[:-2][keep]


def fit_text(rows: DataFrame, text: Column, language: Column, languages: tuple[str, ...] = LANGUAGES, smooth: float = 0.5) -> TextModel:
    """Trigram probabilities from all rows of a listed language; tasks send one table of counts each."""
    names = sorted(languages)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(names), BINS), np.int64)
        for batch in batches:
            tags = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            done = 0
            for ids, data, offsets in slices(iter([batch])):
                own = tags[done:done + len(ids)]
                done += len(ids)
                code, row = _trigrams(data, offsets)
                totals += np.bincount(own[row] * BINS + code, minlength=len(names) * BINS).reshape(totals.shape)
        place, slot = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(slot.astype(np.int64)), pa.array(totals[place, slot])],
                                         names=["tag", "slot", "n"])

    tag = F.array_position(F.lit(list(names)), language) - 1
    known = rows.select(tag.alias("tag"), F.coalesce(text, F.lit("")).alias("text")).where("tag >= 0")
    counts = known.mapInArrow(count, "tag long, slot long, n long").groupBy("tag", "slot").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((len(names), BINS))
    table[counts["tag"], counts["slot"]] = counts["n"]
    p = (table + smooth) / (table + smooth).sum(axis=1, keepdims=True)
    return TextModel(tuple(names), np.log(p), bool(len(counts)))


def _likelihoods(model: TextModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x languages; NaN in rows without a letter."""
    code, row = _trigrams(data, offsets)
    n = len(offsets) - 1
    out = np.stack([np.bincount(row, model.log_p[i][code], minlength=n).astype(float) for i in range(len(model.languages))], axis=1)
    letters = np.concatenate([[0], np.cumsum(_letters(lowered(data)))])
    out[letters[offsets[1:]] == letters[offsets[:-1]]] = np.nan
    return out


def with_evidence(rows: DataFrame, model: TextModel, text_col: str) -> DataFrame:
    """Appends the text's log-likelihoods (null without a letter); all other columns pass through as they are."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    at = rows.columns.index(text_col)
    bound_batches(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column(at), batch.column(at)], names=["id", "text"])
            parts = [_likelihoods(shared.value, data, offsets) for _, data, offsets in slices(iter([pair]))]
            both = np.concatenate(parts) if parts else np.zeros((0, len(shared.value.languages)))
            listed = [None if np.isnan(x[0]) else x for x in both]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(listed, pa.list_(pa.float64()))], names=[*batch.schema.names, EVIDENCE])

    schema = T.StructType([*rows.schema.fields, T.StructField(EVIDENCE, T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, schema)


def _posterior(logs: Column, m: int) -> Column:
    """Normalised probabilities of an array of log weights."""
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _sums(col: str, m: int) -> list[Column]:
    return [F.sum(F.get(col, F.lit(i))).alias(f"s{i}") for i in range(m)]


def host_levels(host: Column) -> Column:
    """Host, parent domains and "" (everything), most specific first: at most the last four labels, then the whole host."""
    labels = F.split(host, r"\.")
    size = F.size(labels)
    parents = F.transform(F.sequence(F.least(size, F.lit(4)), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(labels, size - k + 1, k), "."))
    return F.when(host.isNull() | (host == ""), F.array(F.lit(""))).otherwise(F.array_distinct(F.concat(F.array(host), parents, F.array(F.lit("")))))


def host_priors(combos: DataFrame, m: int, kappa: float) -> DataFrame:
    own = combos.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(m)])
    nodes = own.select(F.posexplode(F.reverse(host_levels(F.col("host")))).alias("depth", "node"), "host", "n", *[f"s{i}" for i in range(m)])
    sums = nodes.groupBy("node").agg(F.sum("n").alias("n"), F.array(*[F.sum(f"s{i}") for i in range(m)]).alias("s"))
    # a host has at most six levels, so its chain is a short array
    chain = nodes.select("host", "depth", "node").join(sums, "node").groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("depth", "n", "s"))).alias("chain"))
    flat = F.lit([1.0 / m] * m)
    prior = F.aggregate("chain", flat, lambda prior, node: F.transform(
        prior, lambda x, i: (F.get(node["s"], i) + kappa * x) / (node["n"] + kappa)))
    return chain.select("host", prior.alias("prior"))


def _agreement(combos: DataFrame, column: str, m: int, smooth: float) -> DataFrame:
    """(value, log P(value | language)): text posteriors summed per value, smoothed and divided by their totals."""
    own = combos.where(F.col(column).isNotNull()).groupBy(column).agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(m)])
    totals = own.agg(*[F.sum(f"s{i}") for i in range(m)]).first()
    return own.select(column, F.array(*[
        F.log((F.col(f"s{i}") + smooth) / ((totals[i] or 0.0) + smooth * m)) for i in range(m)]).alias("log"))


def identify(rows: DataFrame, text_col: str = "text", known_col: str | None = None, declared: Column | None = None,
             host: Column | None = None, suffix: Column | None = None, languages: tuple[str, ...] = LANGUAGES,
             temperature: float = 3.0, min_posterior: float = 0.6, model: TextModel | None = None, kappa: float = KAPPA,
             smooth: float = 1.0) -> DataFrame:
    """The rows with `detected` (null: rejected) and `confidence` appended.

    `known_col` names the language that the text model is counted from, unless a model is given.
    """
    if model is None:
        model = fit_text(rows, F.col(text_col), F.lower(F.col(known_col)), languages)
    names, m = model.languages, len(model.languages)
    clash = {"detected", "confidence"} & set(rows.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    nothing = F.lit(None).cast("string")
    tag = F.lower(F.substring_index(F.trim(declared), "-", 1)) if declared is not None else nothing
    own = F.struct((F.coalesce(host, F.lit("")) if host is not None else F.lit("")).alias("host"),
                   F.when(tag.isin(*names), tag).alias("declared"),
                   (F.lower(suffix) if suffix is not None else nothing).alias("suffix"))
    flat = F.lit([0.0] * m)
    judged = with_evidence(rows.withColumn("__language_keys", own), model, text_col)
    logs = F.transform(F.col(EVIDENCE), lambda x: x / temperature)
    # counts of the corpus: only keys and posteriors go on
    seen = judged.where(F.col(EVIDENCE).isNotNull()).select("__language_keys.*", _posterior(logs, m).alias("p"))
    combos = materialize(seen.groupBy("host", "declared", "suffix").agg(F.count("*").alias("n"), *_sums("p", m)), "language")
    priors = host_priors(combos, m, kappa)
    out = judged.withColumn("__host", F.col("__language_keys.host")).join(
        priors.select(F.col("host").alias("__host"), F.col("prior").alias("__prior")), "__host", "left")
    total = F.zip_with(F.coalesce(logs, flat), F.transform(F.coalesce("__prior", F.lit([1.0 / m] * m)), lambda x: F.log(x)), lambda a, b: a + b)
    for name in ("declared", "suffix"):
        if {"declared": declared, "suffix": suffix}[name] is not None:
            table = _agreement(combos, name, m, smooth)
            out = out.withColumn(f"__{name}", F.col(f"__language_keys.{name}")).join(
                table.select(F.col(name).alias(f"__{name}"), F.col("log").alias(f"__{name}_log")), f"__{name}", "left")
            total = F.zip_with(total, F.coalesce(f"__{name}_log", flat), lambda a, b: a + b)
    posterior = _posterior(total, m)
    best = F.array_max("__posterior")
    sure = F.col(EVIDENCE).isNotNull() & (best >= min_posterior) & F.lit(model.known)
    return out.withColumn("__posterior", posterior).select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.when(sure, F.get(F.lit(list(names)), (F.array_position("__posterior", best) - 1).cast("int"))).alias("detected"),
        F.when(F.col(EVIDENCE).isNotNull(), best).alias("confidence"))
