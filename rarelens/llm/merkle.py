"""Merkle manifest of a table: a ternary hash tree per group, a tree over the groups' roots, and a proof for every row.

Method: time-forward processing. Nodes are labelled level by level, so children come before their parents. A forward sweep
takes nodes in label order from a priority queue: a node's digest is a message to its parent's label. A reversed sweep takes
them in falling order: a node's proof suffix is a message to its children, who put their siblings before it.

The queue is external: labels are dealt to blocks of 3**6 neighbouring nodes of one level of a group. Inside a block, six
levels are swept with a heap of bounded size; messages between blocks are rows that Spark's sorted exchange brings to the
receiving block, first in its order. A round shrinks the nodes 729 times, so a hot group is many blocks, and a trillion rows
take five rounds. Texts are read once, by DataFrame functions; only digests, ids and suffixes travel.

- H is the lower-case hex sha256 of its inputs, concatenated; digests go in as hex text.
- A leaf is H of the row's columns: `-` if null, else the UTF-8 byte count, `:` and the value.
- Leaves ascend by the order column (null first, ties by digest) in each group; every 3 consecutive nodes become their H, the
  last run may be shorter, until one is left: the group's subroot. Groups ascend likewise (null first), up to the root.

Defined results: a lone leaf is its subroot and a lone subroot the root, with nothing to prove; equal rows are leaves of
their own, interchangeable; a null order value is a value like any other; a null group is a group; other columns, whatever
their names, are not read; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarelens.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

ARITY = 3
LEVELS = 6
BLOCK = ARITY ** LEVELS

NODE = "grp string, rank long, n long, digest binary"
PROVED = "grp string, rank long, id long, digest binary, places binary, proof binary, subroot binary, root binary, folded binary"


def field(value: Column) -> Column:
    """One column's part of a leaf."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def parent(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


def height(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Sweep:
    """The two sweeps over one block: at most 3**6 nodes of one level and what they become within `levels` levels."""

    def __init__(self, digests: Sequence[bytes], levels: int):
        self.first = [0]                                     # label of the first node of each level
        count = len(digests)
        for _ in range(levels):
            self.first.append(self.first[-1] + count)
            count = -(-count // ARITY)
        self.level_of_top = levels
        self.digests = list(digests)
        queue = [(self._up(0, i), i % ARITY, d) for i, d in enumerate(digests)] if levels else []
        heapq.heapify(queue)
        level = 1
        while queue:
            label, children = queue[0][0], []
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            self.digests.append(parent(children))
            while level < levels and label >= self.first[level + 1]:
                level += 1
            if level < levels:
                i = label - self.first[level]
                heapq.heappush(queue, (self._up(level, i), i % ARITY, self.digests[label]))

    def _up(self, level: int, i: int) -> int:
        return self.first[level + 1] + i // ARITY

    def top(self) -> bytes:
        return self.digests[-1]

    def suffixes(self, places: bytes, proof: bytes) -> Iterator[tuple[int, bytes, bytes]]:
        """(node, places, proof) of the block's lowest nodes, from what its top received.

        A place byte is 4 * (own place in the run) + (nodes in the run); a proof is the siblings' digests.
        """
        queue = [(-(len(self.digests) - 1), places, proof)]
        level = self.level_of_top
        while queue:
            negative, places, proof = heapq.heappop(queue)
            label = -negative
            while label < self.first[level]:
                level -= 1
            if not level:
                yield label, places, proof
                continue
            begin = self.first[level - 1] + (label - self.first[level]) * ARITY
            run = self.digests[begin:min(begin + ARITY, self.first[level])]
            for p in range(len(run)):
                heapq.heappush(queue, (-(begin + p), bytes([4 * p + len(run)]) + places, b"".join(run[:p] + run[p + 1:]) + proof))


def fold(leaf: bytes, places: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    at = 0
    for code in places:
        p, siblings = code // 4, [proof[at + 32 * i:at + 32 * (i + 1)] for i in range(code % 4 - 1)]
        at += 32 * len(siblings)
        leaf = parent([*siblings[:p], leaf, *siblings[p:]])
    return leaf


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (grp, block) at a time, from batches in that order."""
    held, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            own = row["grp"], row["block"]
            if held and own != key:
                yield held
                held = []
            key = own
            held.append(row)
    if held:
        yield held


def _rise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The top of every block."""
    schema = pa.schema([("grp", pa.string()), ("rank", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])
    out = []
    for rows in _blocks(batches):
        n = rows[0]["n"]
        top = Sweep([r["digest"] for r in rows], min(LEVELS, height(n))).top()
        out.append({"grp": rows[0]["grp"], "rank": rows[0]["block"], "n": -(-n // BLOCK), "digest": top})
        if len(out) == 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def _fall(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of a block with its proof; the block's first row is the message that its top received."""
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in PROVED.split(", ")])
    for message, *rows in _blocks(batches):
        out = []
        sweep = Sweep([r["digest"] for r in rows], min(LEVELS, height(rows[0]["n"])))
        for i, places, proof in sweep.suffixes(message["places"], message["proof"]):
            row = rows[i]
            out.append({"grp": row["grp"], "rank": row["rank"], "id": row["id"], "digest": row["digest"], "places": places, "proof": proof,
                        "subroot": message["subroot"], "root": message["root"],
                        "folded": fold(row["presented"], places, proof) if row["presented"] is not None else None})
        yield pa.RecordBatch.from_pylist(out, schema)


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "rank")


def _ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds `rank` of a node in its group and `n`, the group's nodes.

    Nodes are dealt by range and written with their place; the counts of (group, range) give each range its offset. Equal
    nodes are told apart by a running number, so a node that makes up a third of the table is spread as well.
    """
    keys = ["grp", *order, "again"]
    placed = materialize(nodes.withColumn("again", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .drop("again").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "merkle-placed")
    every = Window.partitionBy("grp")
    before = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("own"))
    offsets = ranges.select(F.col("grp").alias("g"), F.col("part").alias("p"), F.sum("own").over(every).alias("n"),
                            (F.coalesce(F.sum("own").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return (placed.join(offsets, F.col("grp").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
            .withColumn("rank", F.col("at") + F.col("shift")).drop("g", "p", "at", "part", "shift"))


def _rounds(leaves: DataFrame) -> list[DataFrame]:
    """Nodes of the block levels of every group, from the leaves to one node per group."""
    rounds, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = rounds[-1].select("grp", "rank", "n", "digest", F.expr(f"rank div {BLOCK}").alias("block"))
        rounds.append(materialize(_dealt(blocks).mapInArrow(_rise, NODE), "merkle-nodes"))
        most = -(-most // BLOCK)
    return rounds


def _proved(rounds: list[DataFrame], messages: DataFrame) -> DataFrame:
    """The reversed sweep: from a message per group to every leaf of `rounds`."""
    def row(df: DataFrame, **given: Column) -> DataFrame:
        names = "grp block rank n digest id presented places proof subroot root".split()
        kinds = dict(block="long", rank="long", n="long", id="long", grp="string")
        return df.select(*[given.get(c, F.col(c) if c in df.columns else F.lit(None)).cast(kinds.get(c, "binary")).alias(c) for c in names])

    for nodes in rounds[-1:0:-1]:
        found = _dealt(row(nodes, block=F.expr(f"rank div {BLOCK}")).unionByName(row(messages, rank=F.lit(-1)))).mapInArrow(_fall, PROVED)
        messages = found.select("grp", F.col("rank").alias("block"), "places", "proof", "subroot", "root")
    return _dealt(row(rounds[0], block=F.expr(f"rank div {BLOCK}")).unionByName(row(messages, rank=F.lit(-1)))).mapInArrow(_fall, PROVED)


def manifest(rows: DataFrame, columns: Sequence[str], group_col: str = "source", order_col: str = "doc_id",
             presented: Mapping[str, Column] | None = None) -> DataFrame:
    """(order column, leaf, subroot, root, places, proof, folded_root, verified) of every row; digests are hex.

    `presented` replaces columns by the values that a reader presents: its leaf is folded with the stored proof, and
    `verified` says whether that leads to the root. `proof` is the siblings' digests of 32 bytes from the leaf's level up, left
    to right; `places` has a byte for each level, see `Sweep.suffixes`.
    """
    presented = presented or {}
    leaves = materialize(rows.select(F.col(group_col).cast("string").alias("grp"), F.col(order_col).cast("long").alias("id"),
                                     leaf_digest([F.col(c) for c in columns]).alias("digest"),
                                     leaf_digest([presented.get(c, F.col(c)) for c in columns]).alias("presented")), "merkle-leaves")
    own = _rounds(materialize(_ranked(leaves, ["id", "digest"]), "merkle-ranked"))
    groups = own[-1].select(F.lit("all").alias("grp"), F.col("grp").alias("name"), "digest")
    top = _rounds(materialize(_ranked(groups, ["name"]), "merkle-groups"))
    nothing = F.lit(b"").cast("binary")
    start = top[-1].select("grp", F.lit(0).alias("block"), nothing.alias("places"), nothing.alias("proof"), F.col("digest").alias("root"))
    subroots = _proved(top, start).join(top[0].select("rank", "name"), "rank").select(
        F.col("name").alias("grp"), F.lit(0).alias("block"), "places", "proof", F.col("digest").alias("subroot"), "root")
    found = _proved(own, subroots)
    text = lambda c: F.lower(F.hex(c))
    return found.select(F.col("id").alias(order_col), text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
                        "places", "proof", text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
