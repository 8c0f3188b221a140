import random

from pyspark.sql import functions as F

from rarelens.llm import packing
from tests.llm.brute import no_docs, odd_docs


def plain_best_fit(lengths, capacities, overhead, attention):
    """(bin of each length, final and opened sizes) with lists instead of bit sets and counts."""
    cost = lambda s: overhead + s + attention * s * s
    shrunk = lambda n: min(c for c in capacities if c >= n)
    bins, free, out, opened = [], list(lengths), [], []
    for n in lengths:
        open_ = [(room - n, i) for i, (room, _) in enumerate(bins) if room >= n]
        if open_:
            # of equally tight bins the one that became so last
            tight = min(r for r, _ in open_)
            i = max((i for r, i in open_ if r == tight), key=lambda i: bins[i][1][-1][0])
        else:
            if n in free:
                free.remove(n)
            options = []
            for size in sorted(c for c in capacities if c >= n):
                room, taken = size - n, []
                for m in sorted(free, reverse=True):
                    if m <= room:
                        taken.append(m)
                        room -= m
                options.append((cost(shrunk(size - room)) / (size - room), size, taken))
            _, size, taken = min(options)
            for m in taken:
                free.remove(m)
            bins.append((size, []))
            opened.append(size)
            i = len(bins) - 1
        room, items = bins[i]
        items.append((len(out), n))
        bins[i] = room - n, items
        out.append(i)
    return out, [shrunk(sum(n for _, n in items)) for _, items in bins], opened


def test_best_fit_equals_the_plain_version():
    rng = random.Random(1)
    for trial in range(300):
        lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(0, 40))), reverse=True)
        sizes = ((16, 32, 64), (24, 50, 64), (64,))[trial % 3]
        attention = (0.0, 1 / 64)[trial % 2]
        bins, offsets, final, opened = packing.best_fit(lengths, sizes, 8.0, attention)
        assert (bins, final, opened) == plain_best_fit(lengths, sizes, 8.0, attention)
        for b in set(bins):
            own = sorted((o, n) for x, o, n in zip(bins, offsets, lengths) if x == b)
            assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]


def test_sizes_chosen_together_leave_less_room_than_any_single_size():
    lengths = [1000] * 300 + [2048] * 100
    _, _, sizes, opened = packing.best_fit(sorted(lengths, reverse=True), (3000, 4096), 64.0, 0.0)
    assert set(opened) == {3000, 4096} and sum(sizes) == 100 * 3000 + 50 * 4096
    for one in ((3000,), (4096,)):
        assert sum(sizes) < sum(packing.best_fit(sorted(lengths, reverse=True), one, 64.0, 0.0)[2])


def test_cost_of_all_sizes_is_below_that_of_the_largest(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    lengths = sorted((min(r["n"], 4096) for r in docs.select(packing.word_count("text").alias("n")).collect() if r["n"]), reverse=True)
    cost = lambda sizes: sum(64 + s + s * s / 8192 for s in sizes)
    _, _, joint, opened = packing.best_fit(lengths, packing.CAPACITIES, 64.0, 1 / 8192)
    _, _, largest, only = packing.best_fit(lengths, (4096,), 64.0, 1 / 8192)
    assert len(set(opened)) > 1 and set(only) == {4096}
    assert cost(joint) < cost(largest) and sum(joint) <= 1.05 * sum(lengths)


def test_every_word_is_packed_once(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = packing.pack(docs, packing.word_count("text"), capacities=(64, 256), group_size=50).toPandas()
    want = docs.select("doc_id", packing.word_count("text").alias("n")).toPandas().set_index("doc_id")["n"]
    assert (out.groupby("doc_id")["length"].sum() == want).all()
    placed = out[out["length"] > 0]
    filled = placed.groupby("bin")["length"].sum()
    size = placed.groupby("bin")["capacity"].first()
    assert (filled <= size).all() and ((size == 64) | (filled > 64)).all()
    for _, own in placed.sort_values("offset").groupby("bin"):
        assert own["offset"].tolist() == (own["length"].cumsum() - own["length"]).tolist()


def test_long_rows_without_an_id_or_repeated_get_bins_of_their_own(spark):
    rows = spark.createDataFrame([(None, 4096)] * 3 + [(5, 4096)] * 2 + [(5, 9000)] * 2 + [(None, 9000)], "doc_id long, n int")
    out = packing.pack(rows, F.col("n")).toPandas()
    assert out["bin"].notna().all() and out["length"].sum() == 5 * 4096 + 3 * 9000
    assert (out.groupby("bin")["length"].sum() <= out.groupby("bin")["capacity"].first()).all()
    assert (out.groupby("bin")["capacity"].nunique() == 1).all() and not out[["bin", "offset"]].duplicated().any()


def test_large_ids_beside_a_missing_one_stay_exact(spark):
    ids = [2**62 + 1, 2**62 + 3, None]
    out = packing.pack(spark.createDataFrame([(i, 10) for i in ids], "doc_id long, n int"), F.col("n"))
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted(ids, key=str)


def test_copies_of_one_row_are_dealt_to_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "COPIES_AT_ONCE", 64)
    rows = spark.range(1000).selectExpr("cast(null as long) AS doc_id", "10 AS n")
    out = packing.pack(rows, F.col("n"), group_size=50).toPandas()
    assert len(out) == 1000 and sorted(out["copy"]) == list(range(1000))
    groups = out["bin"].str.split("-").str[0]
    assert groups.nunique() == 20 and groups.value_counts().max() < 100


def test_odd_rows(spark):
    out = packing.pack(odd_docs(spark), packing.word_count("text"))
    rows = {(r["doc_id"], r["piece"]): r for r in out.collect()}
    assert rows[(0, 0)]["bin"] is None and rows[(0, 0)]["length"] == 0 and rows[(1, 0)]["length"] == 0
    assert sum(r["length"] for r in out.where("doc_id = 10").collect()) == 30_000
    assert out.where("doc_id = 7").count() == 2 and out.where("doc_id is null").count() == 1
    assert packing.pack(no_docs(spark), packing.word_count("text")).count() == 0
    bad = spark.createDataFrame([(1, None), (2, -5)], "doc_id long, k int")
    assert packing.pack(bad, F.col("k")).agg(F.sum("length")).first()[0] == 0
