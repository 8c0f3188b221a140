"""Best-fit packing into bins of several permitted sequence lengths.

Documents longer than the largest bin are cut into full bins and a rest. The rests and the shorter documents are dealt to
groups of about `group_size` pieces by a digest; the number of groups grows with the data. In a group the pieces go, longest
first, into the open bin with the least room that still holds them.

When none does, a bin is opened, of the size that costs least for each word it can be expected to hold. What it can be
expected to hold is read off the histogram of the lengths to come: the longest that fits, as often as it fits and is left,
then the next, and so on. The expected bin then shrinks to the smallest size that holds this, and costs
overhead + size + attention * size^2, as training on a sequence does. Lengths that one bin has been promised are not promised to
the next, so the sizes of all bins of a group are chosen together from what is left. At the end every bin shrinks to
the smallest permitted size that holds its contents.

Defined results: a null or negative length counts as 0; a piece of length 0 is placed in no bin (null bin, capacity and
offset); equal lengths go in order of id, piece and copy; rows of one id and length (or of no id) are told apart by their
`copy` number, from 0, and are dealt to groups like others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelens.session import ship_with_tasks

ship_with_tasks(__name__)

CAPACITIES = (256, 512, 1024, 2048, 4096)
SCHEMA = "id long, none boolean, copy long, piece int, start long, length long, bin string, capacity int, offset long"
COPIES_AT_ONCE = 10_000


def expected_fill(free: dict[int, int], lengths_left: int, length: int, size: int) -> tuple[int, list[tuple[int, int]]]:
    """(words, [(length, times)]) that a bin of `size` opened for a piece of `length` can be expected to hold.

    `free` counts the lengths that no bin has been promised; bit n of `lengths_left` tells whether length n is among them.
    """
    room, shorter_than, taken = size - length, size + 1, []
    while room > 0:
        fitting = lengths_left & ((1 << min(room + 1, shorter_than)) - 1)
        if not fitting:
            break
        longest = fitting.bit_length() - 1
        times = min(free[longest], room // longest)
        taken.append((longest, times))
        room -= times * longest
        shorter_than = longest
    return size - room, taken


def best_fit(lengths: list[int], capacities: tuple[int, ...], overhead: float, attention: float) -> tuple[list[int], list[int], list[int], list[int]]:
    """(bin, offset) of every length, which come longest first, the bins' final capacities, and those they were opened with."""
    sizes = sorted(capacities)
    cost = {s: overhead + s + attention * s * s for s in sizes}
    free = dict(Counter(lengths))
    lengths_left = sum(1 << n for n in free)
    fits = 0                                     # bit r: some open bin has r places left
    with_room: dict[int, list[int]] = {}
    filled: list[int] = []
    opened: list[int] = []
    bins, offsets = [], []
    for length in lengths:
        rest = fits >> length
        if rest:
            left = length + (rest & -rest).bit_length() - 1
            own = with_room[left].pop()
            if not with_room[left]:
                fits ^= 1 << left
        else:
            if free[length]:
                free[length] -= 1
                if not free[length]:
                    lengths_left ^= 1 << length
            options = []
            for size in sizes[bisect.bisect_left(sizes, length):]:
                words, taken = expected_fill(free, lengths_left, length, size)
                options.append((cost[sizes[bisect.bisect_left(sizes, words)]] / words, size, taken))
            _, size, taken = min(options, key=lambda o: o[:2])
            for n, times in taken:
                free[n] -= times
                if not free[n]:
                    lengths_left ^= 1 << n
            own, left = len(filled), size
            filled.append(0)
            opened.append(size)
        bins.append(own)
        offsets.append(filled[own])
        filled[own] += length
        left -= length
        if left:
            with_room.setdefault(left, []).append(own)
            fits |= 1 << left
    return bins, offsets, [sizes[bisect.bisect_left(sizes, f)] for f in filled], opened


def pack(docs: DataFrame, length: Column, capacities: tuple[int, ...] = CAPACITIES, overhead: float = 64.0, attention: float = 1 / 8192,
         group_size: int = 20_000, id_col: str = "doc_id") -> DataFrame:
    """(id, copy, piece, start, length, bin, capacity, offset): where each piece of each document goes."""
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities are positive")
    top = max(capacities)
    n = F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("n")
    # rows that cannot be told apart are counted before the shuffle and numbered after it
    alike = docs.select(F.col(id_col).cast("long").alias("id"), n).groupBy("id", "n").agg(F.count("*").alias("copies"))
    runs = alike.select("id", "n", "copies", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES_AT_ONCE}L)")).alias("from"))
    sized = runs.select("id", "n", F.explode(F.expr(f"sequence(from, least(copies, from + {COPIES_AT_ONCE}L) - 1)")).alias("copy"))
    pieces = sized.select("id", "copy", "n", F.explode(F.expr(f"sequence(0, cast(greatest((n - 1) div {top}, 0) as int))")).alias("piece")).select(
        "id", "n", "copy", "piece", (F.col("piece") * F.lit(top).cast("long")).alias("start"),
        F.least(F.col("n") - F.col("piece") * F.lit(top).cast("long"), F.lit(top).cast("long")).alias("length"))
    groups = max(1, -(-docs.count() // group_size))
    whole = F.col("length") == top
    name = F.concat_ws("-", F.lit("full"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.col("n").cast("string"), F.col("copy").cast("string"), F.col("piece").cast("string"))
    full = pieces.where(whole | (F.col("length") == 0)).select(
        "id", "copy", "piece", "start", "length", F.when(whole, name).alias("bin"),
        F.when(whole, F.lit(top)).cast("int").alias("capacity"), F.when(whole, F.lit(0)).cast("long").alias("offset"))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "none", "id", "piece", "copy"], ascending=[False, True, True, True, True], kind="stable").reset_index(drop=True)
        own, offset, capacity, _ = best_fit(rows["length"].tolist(), capacities, overhead, attention)
        return rows.assign(bin=[f"{key[0]}-{b}" for b in own], capacity=[capacity[b] for b in own], offset=offset)[
            ["id", "none", "copy", "piece", "start", "length", "bin", "capacity", "offset"]]

    # a missing id travels as a flag: pandas would turn the ids beside it into doubles
    rest = (pieces.where(~whole & (F.col("length") > 0)).drop("n").withColumn("none", F.col("id").isNull()).withColumn("id", F.coalesce("id", F.lit(0)))
            .withColumn("grp", F.pmod(F.xxhash64("id", "none", "piece", "length", "copy"), F.lit(groups))).groupBy("grp").applyInPandas(place, SCHEMA))
    rest = rest.withColumn("id", F.when(~F.col("none"), F.col("id"))).drop("none")
    return full.unionByName(rest).withColumnRenamed("id", id_col)


def word_count(text_col: str = "text") -> Column:
    """Runs of characters other than white space."""
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\S+"))
