"""Byte-level BPE: the distinct words of the whole corpus are shuffled and encoded once, and their ids are joined back.

1. A task cuts its texts into chunks of a few megabytes and every chunk into pre-tokens (vectorised; the pattern below).
   The chunk keeps, per text, the positions' word numbers; its distinct words are exploded to the part of their hash.
   Words of one hash are compared byte by byte, so no two words are ever taken for one.
2. Each part sees every word that hashes to it, and merges each distinct one once (the merging of a single word is the
   tiktoken library's, given the ranks; a task remembers up to a million words); ids go back to the chunks that asked.
3. Ids are joined to the chunk's word numbers and reassembled by position.

Only distinct words per chunk travel, so a word that fills a third of all positions is one entry per chunk. Decoding
joins ids with the token-byte table, whose size is the vocabulary's and is therefore broadcast.

Chunks are named by their content and made twice (once for the words, once for the positions): `docs` must return rows in
the same order when it is read again, as a file scan does; a chunk whose words are missing raises instead of losing text.

Defined results: a null or empty text has no ids and decodes to nothing; rows with a null id and repeated rows are encoded
like any other; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.llm.batches import Rolling, id_and_text, slices
from rarelens.session import shuffle_width, ship_with_tasks

ship_with_tasks(__name__)

CHUNK_BYTES = 4 << 20
CHUNKS = "chunk long, part int, ids array<long>, counts binary, numbers binary, words binary"
REPLIES = "chunk long, part int, sizes binary, tokens binary"
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
_classes: list[np.ndarray] = []


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks of a vocabulary file (base64 and a number per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def char_classes() -> np.ndarray:
    """Letter, number, white space or other for every code point."""
    if not _classes:
        import regex
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        out = np.full(0x110000, _OTHER, np.uint8)
        for code, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for run in regex.findall(pattern, every):
                out[np.frombuffer(run.encode("utf-32-le"), np.uint32)] = code
        _classes.append(out)
    return _classes[0]


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of the pre-tokens of valid UTF-8 texts, and the text of each one.

    Equal to matching, in each text,
    `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`:
    a token starts where the class of characters changes, one plain space before a visible run belongs to that run,
    other white space before it stays apart, and an apostrophe that starts a token takes a listed suffix with it.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = char_classes()[points]
    n = len(points)
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(at, offsets)] = True
    edge[n] = True
    change = edge.copy()
    change[1:n] |= kind[1:] != kind[:-1]
    start = change[:n].copy()
    last = change[1:]                                  # of its run
    blank = kind == _SPACE
    # the last white space of a run that is followed by something visible in the same text stands apart
    apart = np.flatnonzero(blank & last & ~edge[1:])
    start[apart] = True
    glued = apart[points[apart] == 32]
    start[glued + 1] = False
    # contractions: an apostrophe that starts a token, before letters
    quote = np.flatnonzero((points == 39) & start[:n] & last & ~edge[1:])
    if len(quote):
        quote = quote[kind[quote + 1] == _LETTER]
        first = points[quote + 1]
        two = quote + 2
        second = np.where((two < n) & ~edge[np.minimum(two, n)], points[np.minimum(two, n - 1)], 0)
        one = np.isin(first, [ord(c) for c in "stmd"])
        pair = (np.isin(first, [ord("r"), ord("v")]) & (second == ord("e"))) | ((first == ord("l")) & (second == ord("l")))
        start[quote[one | pair] + 1] = False
        for hit, length in ((one, 2), (pair, 3)):
            after = quote[hit] + length
            after = after[after < n]
            after = after[kind[after] == _LETTER]
            start[after] = True
    token = at[np.flatnonzero(start)]
    return token, np.searchsorted(offsets, token, "right") - 1


#: Words whose ids a task remembers at most.
KNOWN_WORDS = 1_000_000


def distinct_words(data: np.ndarray, token: np.ndarray, stop: np.ndarray):
    """(hashes, first occurrence, number of each token, counts) of the distinct tokens that tile `data`.

    Every token is compared with the first one of its hash, byte by byte; one that differs is told apart by a keyed digest.
    """
    hashes, size = Rolling(data).of(token, stop), stop - token
    while True:
        distinct, first, number, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        if not len(token):
            return distinct, first, number, count
        shift = np.repeat(token[first][number] - token, size)
        equal = data[np.minimum(np.arange(len(data)) + shift, len(data) - 1)] == data
        odd = np.flatnonzero((size != size[first][number]) | ~np.logical_and.reduceat(equal, token))
        if not len(odd):
            return distinct, first, number, count
        for i in odd.tolist():
            named = hashlib.blake2b(data[token[i]:stop[i]].tobytes(), digest_size=8, key=hashes[i].tobytes())
            hashes[i] = np.frombuffer(named.digest(), np.uint64)[0]


def _cut(parts: int, words_wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in slices(batches, CHUNK_BYTES):
            token, row = pretokens(data, offsets)
            stop = np.append(token[1:], len(data)) if len(token) else token
            named = hashlib.blake2b(data.tobytes(), digest_size=8, key=b"chunk")
            named.update(offsets.tobytes())
            chunk = int.from_bytes(named.digest(), "little", signed=True)
            distinct, first, number, count = distinct_words(data, token, stop)
            if words_wanted:
                part = (distinct >> np.uint64(32)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                whole = data.tobytes()
                begin, end = token[first[order]].tolist(), stop[first[order]].tolist()
                edges = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
                took = [p for p in range(parts) if edges[p] < edges[p + 1]]
                words = [_bundle([whole[b:e] for b, e in zip(begin[edges[p]:edges[p + 1]], end[edges[p]:edges[p + 1]], strict=True)]) for p in took]
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk] * len(took), pa.int64()), pa.array(took, pa.int32()), pa.nulls(len(took), pa.list_(pa.int64())),
                    pa.nulls(len(took), pa.binary()), pa.nulls(len(took), pa.binary()), pa.array(words, pa.binary())],
                    names=["chunk", "part", "ids", "counts", "numbers", "words"])
            else:
                # frequent words get small numbers, so the positions compress well
                place = np.empty(len(distinct), np.int64)
                by_count = np.argsort(-count, kind="stable")
                place[by_count] = np.arange(len(distinct))
                part = ((distinct >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                arrival = np.argsort(part, kind="stable")   # the order in which the parts' words come back
                rank = np.empty(len(distinct), np.uint32)
                rank[place[arrival]] = np.arange(len(distinct), dtype=np.uint32)
                counts = np.bincount(row, minlength=len(offsets) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk], pa.int64()), pa.array([-1], pa.int32()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([counts.tobytes()], pa.binary()),
                    pa.array([_press(place[number].astype(np.uint32))], pa.binary()),
                    pa.array([_press(rank)], pa.binary())],
                    names=["chunk", "part", "ids", "counts", "numbers", "words"])
    return run


def _press(numbers: np.ndarray) -> bytes:
    planes = numbers.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _expand(block: bytes) -> np.ndarray:
    size = int.from_bytes(block[:8], "little")
    planes = np.frombuffer(pa.decompress(block[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).reshape(-1)


def _bundle(words: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), np.uint32, len(words)).tobytes()
    block = b"".join([sizes, *words])
    return len(words).to_bytes(8, "little") + len(block).to_bytes(8, "little") + pa.compress(block, codec="zstd", asbytes=True)


def _unbundle(bundle: bytes) -> list[bytes]:
    count, size = int.from_bytes(bundle[:8], "little"), int.from_bytes(bundle[8:16], "little")
    block = pa.decompress(bundle[16:], decompressed_size=size, codec="zstd", asbytes=True)
    stops = (4 * count + np.cumsum(np.frombuffer(block[:4 * count], np.uint32))).tolist()
    return [block[a:b] for a, b in zip([4 * count, *stops], stops, strict=False)]


def _merge_words(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        merge = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks.value, special_tokens={}).encode_ordinary
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for chunk, part, words in zip(*(batch.column(n).to_pylist() for n in ("chunk", "part", "words")), strict=True):
                got = []
                for word in _unbundle(words):
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        ids = known[word] = merge(word.decode("utf-8"))
                    got.append(ids)
                sizes = np.fromiter(map(len, got), np.uint32, len(got))
                tokens = np.fromiter((i for ids in got for i in ids), np.uint32, int(sizes.sum()))
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "part": pa.array([part], pa.int32()),
                                                  "sizes": pa.array([_press(sizes)], pa.binary()),
                                                  "tokens": pa.array([_press(tokens)], pa.binary())})
    return run


def _reassemble(finish, names: list[str]):
    """Streams (chunk, part) in order: the positions of a chunk come first, then the ids of its words, part by part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def done():
            (_, ids, counts, numbers, rank), replies = held[0], held[1:]
            sizes = np.concatenate([_expand(r[0]) for r in replies]) if replies else np.zeros(0, np.uint32)
            tokens = np.concatenate([_expand(r[1]) for r in replies]) if replies else np.zeros(0, np.uint32)
            rank = _expand(rank)
            if len(sizes) != len(rank):
                raise RuntimeError("the texts were read in another order the second time; write them to a table first")
            begins = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            begins, sizes = begins[:-1][rank], sizes[rank]
            return finish(ids, np.frombuffer(counts, np.int64), _expand(numbers), begins, sizes, tokens)

        def rows():
            for batch in batches:
                yield from zip(*(batch.column(n).to_pylist() for n in ("chunk", "part", "ids", "counts", "numbers", "words", "sizes", "tokens")), strict=True)

        for chunk, part, ids, counts, numbers, words, sizes, tokens in rows():
            if part < 0:
                if held and held[0][0] == chunk:
                    # a chunk of equal content: its words come once, so its rows are appended
                    again = held[0]
                    held[0] = (chunk, again[1] + ids, again[2] + counts, _press(np.concatenate([_expand(again[3]), _expand(numbers)])), again[4])
                    continue
                if held:
                    yield done()
                held = [(chunk, ids, counts, numbers, words)]
            elif len(held) > 1 and held[-1][2] == part:
                continue                                 # asked for twice by chunks of equal content
            else:
                held.append((sizes, tokens, part))
        if held:
            yield done()
    return run


def _run(docs: DataFrame, ranks: dict[bytes, int], id_col: str, text_col: str, finish, schema: str) -> DataFrame:
    spark = docs.sparkSession
    parts = shuffle_width(spark)
    texts = id_and_text(docs, id_col, text_col)
    table = spark.sparkContext.broadcast(ranks)
    words = texts.mapInArrow(_cut(parts, True), CHUNKS).select("chunk", "part", "words")
    replies = words.repartition(parts, "part").mapInArrow(_merge_words(table), REPLIES)
    positions = texts.mapInArrow(_cut(parts, False), CHUNKS)
    both = positions.select("*", F.lit(None).cast("binary").alias("sizes"), F.lit(None).cast("binary").alias("tokens")).unionByName(
        replies.select("chunk", "part", "sizes", "tokens"), allowMissingColumns=True)
    names = [f.split()[0] for f in schema.split(", ")]
    return (both.repartition(parts, "chunk").sortWithinPartitions("chunk", "part")
            .mapInArrow(_reassemble(finish, names), schema))


def _spread(begins: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The ids of a run of words."""
    size = sizes[numbers].astype(np.int64)
    total = np.cumsum(size)
    shift = np.repeat(begins[numbers] - (total - size), size)
    return tokens[shift + np.arange(len(shift))]


def encode(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text."""
    def finish(ids, counts, numbers, begins, sizes, tokens):
        stops = np.cumsum(counts)
        rows = [_spread(begins, sizes, numbers[e - c:e], tokens).astype(np.int32) for c, e in zip(counts, stops, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.list_(pa.int32()))], names=["id", "ids"])

    return _run(docs, ranks, id_col, text_col, finish, "id long, ids array<int>").withColumnRenamed("id", id_col)


def token_table(spark, ranks: dict[bytes, int]) -> DataFrame:
    return spark.createDataFrame([(rank, token) for token, rank in ranks.items()], "token int, bytes binary")


def decode(tokens: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes) of id sequences; an unknown token raises, a null sequence decodes to nothing."""
    table = tokens.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = table.value
        for batch in batches:
            out = [b"".join([look[i] for i in ids]) if ids else b"" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "bytes"])

    return (tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
            .mapInArrow(run, "id long, bytes binary").withColumnRenamed("id", id_col))


def digests(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) without holding the ids of a chunk as rows.

    The decoded bytes are those of the ids: each distinct word's ids are looked up in the token-byte table.
    """
    table = docs.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def finish(ids, counts, numbers, begins, sizes, tokens):
        look = table.value
        listed, begin = tokens.tolist(), begins.tolist()
        text, raw = [], []
        for b, size in zip(begin, sizes.tolist(), strict=True):
            own = listed[b:b + size]
            text.append(",".join(map(str, own)))
            raw.append(b"".join([look[i] for i in own]))
        stops = np.cumsum(counts)
        n_tokens, id_hash, raw_hash = [], [], []
        for count, stop in zip(counts.tolist(), stops.tolist(), strict=True):
            own = numbers[stop - count:stop]
            n_tokens.append(int(sizes[own].sum()))
            own = own.tolist()
            id_hash.append(hashlib.sha256(",".join([text[i] for i in own]).encode()).hexdigest())
            raw_hash.append(hashlib.sha256(b"".join([raw[i] for i in own])).hexdigest())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(id_hash), pa.array(raw_hash)],
                                          names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _run(docs, ranks, id_col, text_col, finish,
                "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
