"""What the operators on texts share: slices of Arrow batches, rolling hashes, packed rows for one exchange.

Texts are handled as one byte array per slice of a few megabytes, so the work inside a task is vectorised and its memory
does not depend on the partition. A text longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.session import ship_with_tasks

ship_with_tasks(__name__)

SLICE_BYTES = 2 << 20
#: Arrow batches are bounded by bytes as well as by rows, so long texts don't make large ones.
BATCH_BYTES = 16 << 20
U = np.uint64


def bound_batches(df: DataFrame) -> None:
    """Smaller Arrow batches than the default 64 MB, unless the session sets a size of its own."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) == "67108864b":
        conf.set(name, str(BATCH_BYTES))


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns `id` (long) and `text` (null texts are empty); other columns, whatever their names, are pruned."""
    bound_batches(df)
    return df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, bytes, offsets) of consecutive rows of (id, text) batches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
        _, at, data = texts.buffers()
        at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            stop = min(stop, len(texts))
            yield batch.column(0).slice(start, stop - start), data[at[start]:at[stop]], at[start:stop + 1] - at[start]
            start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Rolling:
    """Hashes of any substring of a byte array, from prefix sums of b[i] * R**i modulo 2**64."""

    R = 0x9E3779B97F4A7C15 | 1
    _powers = np.ones(1, U)
    _inverse = np.ones(1, U)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Rolling._powers) < n:
            up, down = np.full(n, self.R, U), np.full(n, pow(self.R, -1, 1 << 64), U)
            up[0] = down[0] = 1
            Rolling._powers, Rolling._inverse = np.cumprod(up), np.cumprod(down)
        self.sums = np.zeros(n, U)
        np.cumsum((data.astype(U) + U(1)) * Rolling._powers[:n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * Rolling._inverse[start] + (stop - start).astype(U))


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, row) of the maximal runs of bytes inside words; no run crosses rows.

    Unless told otherwise, all bytes but space and 9..13 are inside words.
    """
    if inside is None:
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, stop, np.searchsorted(offsets, start, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, byte by byte; other letters stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def packed(keys: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Rows dealt to parts by key, as one compressed block per part: (part, block)."""
    part = (keys % U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    columns = [c[order] for c in columns]
    for p in np.flatnonzero(np.diff(edges)):
        a, b = edges[p], edges[p + 1]
        block = b"".join(np.ascontiguousarray(c[a:b]).view(np.uint8).reshape(b - a, -1).T.tobytes() for c in columns)
        yield int(p), int(b - a).to_bytes(8, "little") + pa.compress(block, codec="zstd", asbytes=True)


def unpacked(block: bytes, *types) -> list[np.ndarray]:
    n = int.from_bytes(block[:8], "little")
    width = sum(np.dtype(t).itemsize for t in types)
    data = np.frombuffer(pa.decompress(block[8:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for t in types:
        w = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(data[at:at + n * w].reshape(w, n).T).view(t).reshape(n))
        at += n * w
    return out


def joined_blocks(blocks: list[bytes], *types) -> list[np.ndarray]:
    got = [unpacked(b, *types) for b in blocks]
    return [np.concatenate([g[i] for g in got]) if got else np.zeros(0, t) for i, t in enumerate(types)]


def _press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, data, offsets in slices(batches):
        whole = data.tobytes()
        out = [pa.compress(whole[a:b], codec="zstd", asbytes=True) if b > a else b"" for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(offsets).astype(np.int64)), pa.array(out, pa.binary())], names=["id", "n", "z"])


def pressed_texts(texts: DataFrame) -> DataFrame:
    """(id, n, z) of (id, text): each text compressed for a shuffle, and its bytes' number."""
    return texts.mapInArrow(_press, "id long, n long, z binary")


def unpressed(n: int, z: bytes) -> bytes:
    return pa.decompress(z, decompressed_size=n, codec="zstd", asbytes=True) if n else b""
