"""Suffix-array deduplication: maximal repeats from the interval trees of enhanced suffix arrays, one array per bucket batch.

A byte is removed when a string of `length` bytes that covers it also starts earlier (smaller id, or earlier in the text).

1. Anchors: in every window of `length` bytes the `GRAM`-byte string of the smallest hash. Equal windows have equal anchors
   at equal places, so an anchor with `length - GRAM` bytes on its left and `length` on its right, its context, holds every
   window it stands for. About three anchors come on a hundred bytes; only their digests, places and ids are shuffled, and
   of equal contexts in one slice of texts only the first.
2. A context that is equal to an earlier one is a repeat as a whole. Anchors with several different contexts are buckets.
3. The contexts of a bucket are read from the texts, and an enhanced suffix array of a batch of buckets is built: suffixes
   in order, their common prefixes and the bytes before them. A stack scan walks the tree of common-prefix intervals of
   `length` and more. Intervals whose occurrences follow different bytes are the maximal repeats (within the contexts),
   reported with all occurrences by `repeat_groups`; for removal each occurrence but the earliest is covered as far as
   its longest interval with an earlier one reaches.
4. Removed ranges of a document are merged and cut out.

`repeat_groups` keeps the place of every context: equal contexts are one class, which is in the array twice if it has two
places or more, and the groups found are joined back to the places of their classes. A string is reported by the anchor of
a window inside it, as only that anchor is there at every occurrence. Contexts of hot anchors go as suffixes, one for each
window, dealt by window. Equal contexts are known by 64-bit digests inside a bucket and not compared byte by byte.

Skew: exact copies collapse in steps 1 and 2. An anchor with very many different contexts (the edge of a passage that is
everywhere) is found beforehand in a 1/64 sample of the documents, which decides the route only: its contexts are cut
into single windows, which collapse like contexts and need no bucket. At most 100,000 anchors can be over the limit, since
it is at least a 100,000th of the sample.

Defined results: null and empty texts, and texts under `length` bytes, keep everything; rows without an id keep everything
and are no one's earlier copy; rows repeated as a whole are the same document; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.llm.batches import Rolling, id_and_text, joined_blocks, mix, packed, pressed_texts, slices, unpressed
from rarelens.session import materialize, ship_with_tasks, shuffle_width

ship_with_tasks(__name__)

U = np.uint64
LENGTH = 100
GRAM = 32
BUCKET_LIMIT = 8192
BATCH_BYTES = 1 << 20
SAMPLE = 64
#: Suffixes whose bytes are laid out at once.
PIECE = 8192
#: Text that is hashed at once, the same where anchors are hot, and text whose contexts are sent together.
SEND_PIECE, HOT_PIECE, SEND_BYTES = 1 << 20, 1 << 18, 4 << 20
#: In place of the byte before a suffix: the suffix starts its context; not a suffix but a whole context.
EDGE, WHOLE = -1, -2


def _over(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Smallest or largest value of every run of `width`."""
    out, have = values, 1
    while 2 * have <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, row, hash) of the anchors of a slice: every window of `length` bytes holds its smallest `gram`-string."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    if len(data) < length:
        return none
    h, size = data.astype(U) + U(1), 1
    while 2 * size <= gram:
        h = (h[:-size] * U(0xD6E8FEB86659FD93) + h[size:]) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(29)
        size *= 2
    if size < gram:
        h = mix(h[:len(h) - (gram - size)] * U(0xD6E8FEB86659FD93) + h[gram - size:])
    h |= U(1)                                              # 0 stands for no window
    width = length - gram + 1
    least = _over(h, width, np.minimum)
    at = np.arange(len(least))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    least[offsets[1:][row[:len(least)]] < at + length] = 0   # windows stay inside texts
    wide = np.zeros(len(least) + 2 * (width - 1), U)
    wide[width - 1:width - 1 + len(least)] = least
    place = np.flatnonzero(_over(wide, width, np.maximum)[:len(h)] == h)
    return place, row[place], h[place]


def _contexts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, start, stop, bucket, digest) of the anchors' contexts."""
    place, row, bucket = anchors(data, offsets, length, gram)
    start = np.maximum(offsets[row], place - (length - gram))
    stop = np.minimum(offsets[row + 1], place + length)
    digest = mix(Rolling(data).of(start, stop) + (place - start).astype(U)) if len(place) else bucket
    return row, start, stop, bucket, digest


def _cut_windows(data: np.ndarray, row, start, stop, bucket, digest, hot: np.ndarray, length: int):
    """Contexts of hot anchors as their single windows; the others as they are. The last result marks windows."""
    at = np.minimum(np.searchsorted(hot, bucket), len(hot) - 1)
    cut = hot[at] == bucket
    count = (stop - start - length + 1)[cut]
    first = np.repeat(start[cut], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    rolling = Rolling(data)
    w1 = rolling.of(first, first + length)
    w2 = mix(rolling.of(first, first + length // 2) * U(0xC2B2AE3D27D4EB4F) ^ rolling.of(first + length // 2, first + length))
    keep = ~cut
    join = lambda a, b: np.concatenate([a[keep], b])
    return (join(row, np.repeat(row[cut], count)), join(start, first), join(stop, first + length), join(bucket, w1), join(digest, w2),
            np.concatenate([np.zeros(keep.sum(), bool), np.ones(len(first), bool)]))


def _collapsed(bucket, digest, own, begin, end, single) -> tuple[list[np.ndarray], np.ndarray]:
    """The first of equal contexts, and (id, start, stop) of the others."""
    order = np.lexsort((begin, own, digest, bucket))
    columns = [x[order] for x in (bucket, digest, own, begin, end, single)]
    bucket, digest, own, begin, end, _ = columns
    again = np.zeros(len(order), bool)
    again[1:] = (bucket[1:] == bucket[:-1]) & (digest[1:] == digest[:-1])
    # a row that is there twice is the same place, not a copy of itself
    same = again.copy()
    same[1:] &= (own[1:] == own[:-1]) & (begin[1:] == begin[:-1])
    return [x[~again] for x in columns], np.stack([own, begin, end], axis=1)[again & ~same]


def _send(parts: int, length: int, gram: int, hot):
    """(part, block, spans): contexts dealt by bucket; of equal ones in some megabytes the first, the others are spans at once.

    Hot texts have about two windows for each byte, so they are cut and collapsed in small pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        spans: list[np.ndarray] = []
        size = 0

        def done() -> pa.RecordBatch:
            (bucket, digest, own, begin, end, single), more = _collapsed(*map(np.concatenate, zip(*held, strict=True)))
            blocks = list(packed(bucket >> U(20), parts, bucket, digest, own, begin.astype(np.uint32), (end - begin).astype(np.uint16), single))
            ranges = np.concatenate([*spans, more]).astype(np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([p for p, _ in blocks] + [size % parts], pa.int32()), pa.array([b for _, b in blocks] + [None], pa.binary()),
                pa.array([None] * len(blocks) + [ranges.tobytes()], pa.binary())], names=["part", "block", "spans"])

        for ids, data, offsets in slices(batches, HOT_PIECE if len(hot.value) else SEND_PIECE):
            names = np.asarray(ids.to_numpy(zero_copy_only=False), np.int64)
            row, start, stop, bucket, digest = _contexts(data, offsets, length, gram)
            single = np.zeros(len(row), bool)
            if len(hot.value) and len(row):
                row, start, stop, bucket, digest, single = _cut_windows(data, row, start, stop, bucket, digest, hot.value, length)
            first, more = _collapsed(bucket, digest, names[row], start - offsets[row], stop - offsets[row], single)
            held.append(first)
            spans.append(more)
            size += len(data)
            if size >= SEND_BYTES:
                yield done()
                held, spans, size = [], [], 0
        if held:
            yield done()
    return run


_FOUND = "bucket long, id long, start int, stop int"


def _found(bucket, own, begin, end) -> pa.RecordBatch:
    """Rows with a null bucket are removed ranges, the others contexts to be read."""
    return pa.RecordBatch.from_arrays([pa.nulls(len(own), pa.int64()) if bucket is None else pa.array(bucket.view(np.int64)), pa.array(own),
                                       pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], names=["bucket", "id", "start", "stop"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, list[bytes]] = {}
    for batch in batches:
        for part, block, spans in zip(*(batch.column(n).to_pylist() for n in ("part", "block", "spans")), strict=True):
            if block is not None:
                parts.setdefault(part, []).append(block)
            if spans:
                s = np.frombuffer(spans, np.int64).reshape(-1, 3)
                yield _found(None, np.ascontiguousarray(s[:, 0]), s[:, 1], s[:, 2])
    for blocks in parts.values():
        bucket, digest, own, begin, size, single = joined_blocks(blocks, U, U, np.int64, np.uint32, np.uint16, np.bool_)
        order = np.lexsort((begin, own, digest, bucket))
        bucket, digest, own, begin, size, single = (x[order] for x in (bucket, digest, own, begin, size, single))
        end = begin.astype(np.int64) + size
        fresh = np.ones(len(order), bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (digest[1:] != digest[:-1])
        place = np.ones(len(order), bool)
        place[1:] = (own[1:] != own[:-1]) | (begin[1:] != begin[:-1])
        copy = ~fresh & place
        yield _found(None, own[copy], begin[copy], end[copy])
        # buckets of several contexts
        bucket, own, begin, end, single = (x[fresh] for x in (bucket, own, begin, end, single))
        several = np.zeros(len(bucket), bool)
        if len(bucket) > 1:
            equal = (bucket[1:] == bucket[:-1]) & ~single[1:] & ~single[:-1]
            several[1:] |= equal
            several[:-1] |= equal
        yield _found(bucket[several], own[several], begin[several], end[several])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, id, start, context) of the asked contexts of each text."""
    held: list[tuple] = []

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
                                          names=["bucket", "id", "start", "context"])

    for batch in batches:
        for own, n, z, asked in zip(*(batch.column(c) for c in ("id", "n", "z", "asked")), strict=True):
            text, own, places = unpressed(n.as_py(), z.as_py()), own.as_py(), asked.values
            bucket, start, stop = (places.field(i).to_pylist() for i in range(3))
            held += [(b, own, x, text[x:y]) for b, x, y in zip(bucket, start, stop, strict=True)]
            if len(held) >= 4096:
                yield rows()
                held = []
    if held:
        yield rows()


class SuffixArray:
    """Enhanced suffix array of texts laid side by side, without what cannot start a maximal repeat.

    Suffixes are grouped by the digest of their first `length` bytes. A group of one, and a group whose suffixes all follow
    the same byte, is left out: its repeats are parts of those one byte to the left. The others are sorted by group and
    then by their bytes, of which the end of a text is the smallest (bytes are raised by one; UTF-8 has no byte 255).
    `places`: where the suffixes start; `common`: bytes that each shares with the one before; `left`: the byte before it,
    or a value of its own at the start of a text.
    """

    def __init__(self, texts: list[bytes], length: int, keys: np.ndarray | None = None, before: np.ndarray | None = None):
        """Texts with different `keys` share nothing; a text with `before` over WHOLE is one suffix that follows that byte."""
        sizes = np.array([len(t) for t in texts], np.int64)
        self.stops = np.cumsum(sizes)
        self.starts = self.stops - sizes
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.size = len(data)
        self.places = self.left = self.common = np.zeros(0, np.int64)
        room = np.repeat(self.stops, sizes) - np.arange(len(data))
        begin = np.flatnonzero(room >= length)
        text = np.searchsorted(self.stops, begin, "right") if keys is not None else None
        if before is not None:
            one = (before[text] == WHOLE) | (begin == self.starts[text])
            begin, text = begin[one], text[one]
        if not len(begin):
            return
        digest = Rolling(data).of(begin, begin + length)
        if keys is not None:
            digest = mix(digest ^ keys[text])
        order = np.argsort(digest, kind="stable")
        begin, digest = begin[order], digest[order]
        first = np.zeros(len(data), bool)
        first[self.starts[sizes > 0]] = True
        left = np.where(first[begin], -1 - begin, data[begin - 1].astype(np.int64))
        if before is not None:
            given = before[text[order]]
            left = np.where(given >= 0, given, left)
        fresh = np.flatnonzero(np.concatenate([[True], digest[1:] != digest[:-1]]))
        wanted = np.minimum.reduceat(left, fresh) != np.maximum.reduceat(left, fresh)
        group = np.repeat(np.arange(len(fresh)), np.diff(np.append(fresh, len(begin))))
        keep = wanted[group]
        begin, left, group = begin[keep], left[keep], group[keep]
        if not len(begin):
            return
        reach = int(room[begin].max())
        wide = length + -(-max(reach - length, 1) // 8) * 8
        at = np.arange(wide)
        raised = np.zeros(len(data) + wide, np.uint8)
        raised[:len(data)] = data + np.uint8(1)
        strings = np.lib.stride_tricks.sliding_window_view(raised, wide)

        def rows(places: np.ndarray) -> np.ndarray:
            out = strings[places]
            out[at >= room[places, None]] = 0
            return out

        # the suffixes' bytes are laid out a piece at a time: all of them would take hundreds of times the texts
        words = np.empty(((wide - length) // 8, len(begin)), U)
        for i in range(0, len(begin), PIECE):
            words[:, i:i + PIECE] = np.ascontiguousarray(rows(begin[i:i + PIECE])[:, length:]).view(">u8").T
        order = np.lexsort((*words[::-1], group))
        del words
        self.places, self.left, group = begin[order], left[order], group[order]
        same = np.empty(len(begin) - 1, np.int64)
        for i in range(0, len(same), PIECE):
            piece = rows(self.places[i:i + PIECE + 1])
            differs = piece[1:] != piece[:-1]
            same[i:i + PIECE] = np.where(differs.any(axis=1), differs.argmax(axis=1), wide)
        here = room[self.places]
        self.common = np.concatenate([[0], np.minimum(same, np.minimum(here[1:], here[:-1]))])
        if keys is not None:
            self.common[1:][group[1:] != group[:-1]] = 0

    def runs(self, length: int) -> list[tuple[int, int]]:
        """Ranges of suffixes that share at least `length` bytes."""
        cut = np.flatnonzero(self.common < length)
        ends = np.append(cut[1:], len(self.common))
        pick = ends - cut > 1
        return list(zip(cut[pick].tolist(), ends[pick].tolist(), strict=True))


def intervals(common: list[int], left: list[int], length: int) -> list[tuple[int, int, int]]:
    """(shared bytes, first, last) of the common-prefix intervals of a run whose occurrences follow different bytes.

    One scan with a stack of open intervals; each knows the byte before all its suffixes, or that these differ.
    """
    out: list[tuple[int, int, int]] = []
    mixed = None
    stack: list[list] = []                               # shared, first, byte before

    def meet(a, b):
        return a if a == b else mixed

    for i in range(1, len(left) + 1):
        here = common[i] if i < len(left) else 0
        first, before = i - 1, left[i - 1]
        while stack and stack[-1][0] > here:
            shared, first, known = stack.pop()
            before = meet(known, before)
            if before is mixed and shared >= length:
                out.append((shared, first, i - 1))
        if stack and stack[-1][0] == here:
            stack[-1][2] = meet(stack[-1][2], before)
        elif here >= length:
            stack.append([here, first, before])
    return out


def maximal_repeats(texts: list[bytes], length: int, keys: np.ndarray | None = None, before: np.ndarray | None = None) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(shared bytes, occurrences as (text, offset)) of the maximal repeats of at least `length` bytes among texts."""
    array = SuffixArray(texts, length, keys, before)
    text_of = np.searchsorted(array.stops, array.places, "right")
    offset = (array.places - array.starts[text_of]).tolist() if len(array.places) else []
    text_of = text_of.tolist()
    for a, b in array.runs(length):
        for shared, first, last in intervals(array.common[a:b].tolist(), array.left[a:b].tolist(), length):
            yield shared, [(text_of[a + i], offset[a + i]) for i in range(first, last + 1)]


def later_occurrences(common: list[int], rank: list[int], length: int) -> Iterator[tuple[int, int]]:
    """(suffix, bytes) of a run: how far each suffix but the earliest repeats an earlier one.

    The stack scan closes intervals from the inside; each hands on its earliest suffix, and the suffix that gives way repeats
    the interval's shared bytes. So every suffix is named at most once, in the longest interval that has an earlier one.
    """
    stack: list[list] = []                               # shared, earliest suffix
    for i in range(1, len(rank) + 1):
        here = common[i] if i < len(rank) else 0
        best = i - 1
        while stack and stack[-1][0] > here:
            shared, other = stack.pop()
            if rank[other] == rank[best]:
                continue
            if rank[other] < rank[best]:
                best, other = other, best
            yield other, shared
        if stack and stack[-1][0] == here:
            other = stack[-1][1]
            if rank[other] != rank[best]:
                if rank[other] < rank[best]:
                    best, other = other, best
                yield other, here
            stack[-1][1] = best
        elif here >= length:
            stack.append([here, best])


def repeated_ranges(texts: list[bytes], ids: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, stop): merged ranges of each text that repeat something earlier; texts start at `starts` of documents `ids`."""
    array = SuffixArray(texts, length)
    place = array.places
    text_of = np.searchsorted(array.stops, place, "right")
    own, at = ids[text_of], starts[text_of] + place - array.starts[text_of]
    order = np.lexsort((at, own))
    step = np.ones(len(order), np.int64)
    if len(order):
        step[1:] = (own[order][1:] != own[order][:-1]) | (at[order][1:] != at[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(step)                        # contexts of one document overlap: one place has one rank
    hits: list[tuple[int, int]] = []
    for a, b in array.runs(length):
        hits += [(a + i, n) for i, n in later_occurrences(array.common[a:b].tolist(), rank[a:b].tolist(), length)]
    depth = np.zeros(array.size + 1, np.int64)
    if hits:
        found = np.array(hits, np.int64)
        np.add.at(depth, place[found[:, 0]], 1)
        np.add.at(depth, place[found[:, 0]] + found[:, 1], -1)
    covered = np.cumsum(depth[:-1]) > 0
    cut = np.zeros(array.size + 1, bool)
    cut[array.starts] = True
    begin = np.flatnonzero(covered & np.concatenate([[True], ~covered[:-1]])[:array.size] | covered & cut[:-1])
    end = np.flatnonzero(covered & (np.concatenate([~covered[1:], [True]])[:array.size] | cut[1:])) + 1
    t = np.searchsorted(array.stops, begin, "right")
    return t, begin - array.starts[t], end - array.starts[t]


def _bucket_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(ids, starts, contexts) of whole buckets, about a megabyte at a time; rows come sorted by bucket.

    Equal windows have one bucket, so buckets are searched together without losing or adding repeats.
    """
    held: list[tuple] = []
    size = 0

    def done():
        return np.array([h[1] for h in held], np.int64), np.array([h[2] for h in held], np.int64), [h[3] for h in held]

    for batch in batches:
        for item in zip(*(batch.column(c).to_pylist() for c in ("bucket", "id", "start", "context")), strict=True):
            if size >= BATCH_BYTES and held[-1][0] != item[0]:
                yield done()
                held, size = [], 0
            held.append(item)
            size += len(item[3])
    if held:
        yield done()


_PLACES = "bucket long, digest long, id long, start int, stop int, at int, before int"


def _places(length: int, gram: int, hot):
    """Every context with its place, `at` bytes before its anchor; contexts of hot anchors as a suffix for each window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in slices(batches, HOT_PIECE if len(hot.value) else SEND_PIECE):
            names = np.asarray(ids.to_numpy(zero_copy_only=False), np.int64)
            place, row, bucket = anchors(data, offsets, length, gram)
            if not len(place):
                continue
            start, stop = np.maximum(offsets[row], place - (length - gram)), np.minimum(offsets[row + 1], place + length)
            before, rolling = np.full(len(row), WHOLE), Rolling(data)
            if len(hot.value):
                cut = hot.value[np.minimum(np.searchsorted(hot.value, bucket), len(hot.value) - 1)] == bucket
                count = np.where(cut, stop - start - length + 1, 1)
                pick = np.repeat(np.arange(len(row)), count)
                step = np.arange(len(pick)) - np.repeat(np.cumsum(count) - count, count)
                place, row, bucket, start, stop, cut = (x[pick] for x in (place, row, bucket, start, stop, cut))
                start = start + step
                before = np.where(cut, np.where(step > 0, data[np.maximum(start - 1, 0)].astype(np.int64), EDGE), WHOLE)
                bucket = np.where(cut, mix(bucket ^ rolling.of(start, start + length)), bucket)
            at = place - start
            digest = mix(mix(rolling.of(start, stop) + at.astype(U)) + before.astype(U))
            first = offsets[row]
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(names[row]),
                *[pa.array(x.astype(np.int32)) for x in (start - first, stop - first, at, before)]],
                names=["bucket", "digest", "id", "start", "stop", "at", "before"])
    return run


_CLASSES = "bucket long, digest long, n int, at int, before int, context binary"
_CLASS_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())


def _read_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked classes with the context, read from its first place."""
    def rows():
        for batch in batches:
            for n, z, asked in zip(*(batch.column(c) for c in ("n", "z", "asked")), strict=True):
                text, fields = unpressed(n.as_py(), z.as_py()), [asked.values.field(i).to_pylist() for i in range(7)]
                for bucket, digest, places, start, stop, at, before in zip(*fields, strict=True):
                    yield bucket, digest, places, at, before, text[start:stop]
    yield from _batched(rows(), lambda *r: r, ["bucket", "digest", "n", "at", "before", "context"], list(_CLASS_TYPES), 4096)


def _class_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Classes of whole buckets, about a megabyte at a time; rows come sorted by bucket and digest."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for item in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held and held[-1][:2] == item[:2]:
                continue                                 # a repeated row
            if size >= BATCH_BYTES and held[-1][0] != item[0]:
                yield held
                held, size = [], 0
            held.append(item)
            size += len(item[5])
    if held:
        yield held


def _repeat_groups(length: int):
    """(grp, shared, bucket, digest, skip): maximal repeats, and where they are in the contexts of classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for classes in _class_batches(batches):
                classes = [c for c in classes for _ in range(c[2])]
                texts = [c[5] for c in classes]
                keys, before = np.array([c[0] for c in classes], np.int64).view(U), np.array([c[4] for c in classes], np.int64)
                for shared, found in maximal_repeats(texts, length, keys, before):
                    t, o = found[0]
                    string = texts[t][o:o + shared]
                    inside, _, _ = anchors(np.frombuffer(string, np.uint8), np.array([0, shared]), length, GRAM)
                    if {classes[t][3] - o for t, o in found}.isdisjoint(inside.tolist()):
                        continue                         # another anchor is there at every occurrence
                    grp = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little", signed=True)
                    for bucket, digest, skip in {(*classes[t][:2], o) for t, o in found}:
                        yield grp, shared, bucket, digest, skip
        yield from _batched(rows(), lambda *r: r, ["grp", "shared", "bucket", "digest", "skip"],
                            [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()], 4096)
    return run


def _later_ranges(length: int):
    """Merged ranges (id, start, stop) of contexts that repeat something earlier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, texts in _bucket_batches(batches):
            t, first, stop = repeated_ranges(texts, ids, starts, length)
            yield pa.RecordBatch.from_arrays([pa.array(ids[t]), pa.array((starts[t] + first).astype(np.int32)), pa.array((starts[t] + stop).astype(np.int32))],
                                             names=["id", "start", "stop"])
    return run


def _hot_anchors(texts: DataFrame, length: int, gram: int, limit: int) -> np.ndarray:
    """Anchors with more than about `limit` different contexts, counted in a sample of the documents: it picks routes only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in slices(batches):
            _, _, _, bucket, digest = _contexts(data, offsets, length, gram)
            pairs = np.unique(np.stack([bucket, digest], axis=1), axis=0) if len(bucket) else np.zeros((0, 2), U)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0]).view(np.int64)), pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64))], names=["bucket", "digest"])

    sample = texts.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0).mapInArrow(run, "bucket long, digest long").distinct()
    counts = materialize(sample.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1), "anchors")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") > max(limit / SAMPLE, total / 100_000)).select("bucket").toPandas()["bucket"].to_numpy(np.int64)
    return np.sort(rows.view(U))


def _parts_of(docs: DataFrame, id_col: str, text_col: str, length: int, limit: int):
    """Compressed texts, ranges known to be removed, and the contexts of the buckets."""
    if length < GRAM + 8:
        raise ValueError(f"repeats of less than {GRAM + 8} bytes are not searched")
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    known = texts.where("id is not null")
    parts = shuffle_width(spark)
    hot = spark.sparkContext.broadcast(_hot_anchors(known, length, GRAM, limit))
    found = materialize(known.mapInArrow(_send(parts, length, GRAM, hot), "part int, block binary, spans binary")
                        .repartition(parts, "part").mapInArrow(_meet, _FOUND), "contexts")
    pressed = pressed_texts(texts)
    asked = found.where("bucket is not null").groupBy("id").agg(F.collect_list(F.struct("bucket", "start", "stop")).alias("asked"))
    contexts = (pressed.join(asked, "id").mapInArrow(_read, "bucket long, id long, start int, context binary")
                .repartition(parts, "bucket").sortWithinPartitions("bucket", "id", "start"))
    return pressed, found.where("bucket is null").select("id", "start", "stop"), contexts


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(grp, shared, id, start) of the maximal repeats within contexts, each with all its occurrences.

    The group's number is a digest of its string, so a string that several anchors report is one group.
    """
    if length < GRAM + 8:
        raise ValueError(f"repeats of less than {GRAM + 8} bytes are not searched")
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col).where("id is not null")
    hot = spark.sparkContext.broadcast(_hot_anchors(texts, length, GRAM, limit))
    places = materialize(texts.mapInArrow(_places(length, GRAM, hot), _PLACES).distinct(), "places")
    classes = places.groupBy("bucket", "digest").agg(F.least(F.count("*"), F.lit(2)).cast("int").alias("n"),
                                                     F.min(F.struct("id", "start", "stop", "at", "before")).alias("first"))
    # suffixes that all follow one byte are parts of longer ones
    several = (classes.groupBy("bucket").agg(F.sum("n").alias("places"), F.min("first.before").alias("low"), F.max("first.before").alias("high"))
               .where("places > 1 and (low < 0 or low < high)").select("bucket"))
    asked = classes.join(several, "bucket").groupBy("first.id").agg(
        F.collect_list(F.struct("bucket", "digest", "n", "first.start", "first.stop", "first.at", "first.before")).alias("asked"))
    contexts = (pressed_texts(texts).join(asked, "id").mapInArrow(_read_classes, _CLASSES)
                .repartition(shuffle_width(spark), "bucket").sortWithinPartitions("bucket", "digest"))
    groups = contexts.mapInArrow(_repeat_groups(length), "grp long, shared int, bucket long, digest long, skip int")
    found = materialize(groups.join(places, ["bucket", "digest"])
                        .select("grp", "shared", "id", (F.col("start") + F.col("skip")).alias("start")).distinct(), "groups")
    # contexts of one document overlap: one place alone is no repeat
    repeated = found.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1").select("grp")
    return found.join(repeated, "grp").select("grp", "shared", F.col("id").alias(id_col), "start")


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, length: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(id, n, z) of the texts, and (id, ranges), which overlap."""
    pressed, known, contexts = _parts_of(docs, id_col, text_col, length, limit)
    later = contexts.mapInArrow(_later_ranges(length), "id long, start int, stop int")
    return pressed, known.unionByName(later).groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _kept(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    edges = [0, *[e for r in ranges for e in r], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for own, n, z, ranges in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "z", "ranges")), strict=True):
            yield own, unpressed(n, z), merged([(r["start"], r["stop"]) for r in ranges or ()])


def _batched(rows, make, names: list[str], types: list[pa.DataType], limit: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(make(*row))
        if len(held) == limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, limit: int = BUCKET_LIMIT) -> DataFrame:
    """The rows with the repeats cut out of the text; characters that are cut in two go as well. Other columns stay."""
    _, ranges = _with_ranges(docs, id_col, text_col, length, limit)

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or t is None else _kept(t.encode(), merged([(r["start"], r["stop"]) for r in s])).decode("utf-8", "ignore")
                          for t, s in zip(text, spans, strict=True)], dtype=object)

    spans = ranges.select(F.col("id").alias("__id"), F.col("ranges").alias("__ranges"))
    joined = docs.join(spans, F.col(id_col).cast("long") == F.col("__id"), "left")
    return joined.withColumn(text_col, F.when(F.col("__ranges").isNull(), F.col(text_col)).otherwise(cut(F.col(text_col), F.col("__ranges")))).drop("__id", "__ranges")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make(own, text, ranges):
            return own, len(text), sum(b - a for a, b in ranges), len(ranges), hashlib.sha256(_kept(text, ranges)).hexdigest()
        yield from _batched(_rows(batches), make, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], [pa.int64()] * 4 + [pa.string()])

    pressed, ranges = _with_ranges(docs, id_col, text_col, length, limit)
    return (pressed.join(ranges, "id", "left")
            .mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col))
