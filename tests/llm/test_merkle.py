import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rarelens.llm import merkle
from rarelens.llm.catalog import QUERIES, SQL
from tests.compare import connect, difference
from tests.llm.brute import no_docs, odd_docs

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, rank int, digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    """(root, siblings of every leaf, path of every leaf): runs of three until one node is left."""
    nodes, members = list(leaves), [[i] for i in range(len(leaves))]
    proofs, paths = [[] for _ in leaves], [[] for _ in leaves]
    while len(nodes) > 1:
        above, owners = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a:a + 3]
            for p in range(len(run)):
                for i in members[a + p]:
                    proofs[i] += run[:p] + run[p + 1:]
                    paths[i].append((run[:p], run[p + 1:]))
            above.append(h(*run))
            owners.append([i for m in members[a:a + 3] for i in m])
        nodes, members = above, owners
    return nodes[0], proofs, paths


def brute(rows):
    """Sorted result rows of a list of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = tree([leaf(r) for r in groups[name]])
    root, proofs, paths = tree([trees[n][0] for n in names])
    out = []
    for k, name in enumerate(names):
        sub, own, ways = trees[name]
        for i, r in enumerate(groups[name]):
            shown = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                shown = (*r[:4], r[4].replace("\n", ""))
            at = leaf(shown)
            for left, right in ways[i] + paths[k]:
                at = h(*left, at, *right)
            out.append((str(r[0]), leaf(r), sub, root, h(*own[i], *proofs[k]), at, at == root))
    return sorted(out)


def run(df):
    cut = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = merkle.manifest(df, COLUMNS, presented={"text": F.when(cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))})
    rows = found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")).cast("binary"), 256), "folded_root", "verified").collect()
    return sorted((str(r[0]), *r[1:]) for r in rows)


def made(n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, i, i, i]), rng.choice([None, "", "a", "a", "a", "Z", "é", "漢"]), rng.choice([None, "en"]), rng.choice([None, -i]),
             rng.choice([None, "", "two\nlines\n", "x" * 50, f"text {i}\n"])) for i in range(n)]
    return rows + rows[:n // 5]


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_equals_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    rows = made(60, levels)
    assert run(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)) == brute(rows)


def test_one_hot_group_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(5, "s", "en", 1, "same\n")] * 200 + [(6, "s", "en", 1, "other"), (1, "t", "en", 1, "z" * 200_000)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(8)
    assert run(df) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_sweeps_of_a_block(n):
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    sweep = merkle.Sweep(digests, merkle.height(n))
    root, proofs, _ = tree([d.hex() for d in digests])
    assert sweep.top().hex() == root
    got = {i: (places, proof) for i, places, proof in sweep.suffixes(b"", b"")}
    assert [got[i][1].hex() for i in range(n)] == ["".join(p) for p in proofs]
    assert all(merkle.fold(digests[i], *got[i]).hex() == root for i in range(n))


def test_odd_and_empty_tables(spark):
    docs = odd_docs(spark).withColumn("n_chars", F.col("n"))
    rows = [tuple(r[c] for c in COLUMNS) for r in docs.collect()]
    assert run(docs) == brute(rows)
    assert run(no_docs(spark).withColumn("n_chars", F.col("n"))) == []
    one = docs.where("doc_id = 4")
    (got,) = run(one)
    assert got[1] == got[2] == got[3] and got[4] == h() and got[6]


def test_query_equals_sql(spark, small):
    problem, _ = difference(spark, QUERIES["op11_merkle_manifest"], SQL["op11_merkle_manifest"], connect(small), small)
    assert problem is None
