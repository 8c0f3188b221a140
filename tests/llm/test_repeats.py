import random

from rarelens.llm import repeats
from tests.llm.brute import no_docs, odd_docs, removal_row, removed


def plain_groups(texts, length):
    places = {}
    for i, t in enumerate(texts):
        for a in range(len(t)):
            for b in range(a + length, len(t) + 1):
                places.setdefault(t[a:b], set()).add((i, a))
    out = set()
    for w, at in places.items():
        left = {texts[i][a - 1] if a else ("start", i) for i, a in at}
        right = {texts[i][a + len(w)] if a + len(w) < len(texts[i]) else ("end", i) for i, a in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1:
            out.add((len(w), tuple(sorted(at))))
    return out


def test_interval_tree_lists_all_maximal_repeats():
    rng = random.Random(3)
    for _ in range(300):
        letters = rng.choice(["ab", "abc\0"])
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))).encode() for _ in range(rng.randint(1, 4))]
        got = {(n, tuple(sorted(at))) for n, at in repeats.maximal_repeats(texts, 5)}
        assert got == plain_groups(texts, 5)


def passages(seed=4):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(300)) for _ in range(4)]
    out = {}
    for i in range(120):
        b, a = rng.choice(base), rng.randint(0, 200)
        noise = lambda n: "".join(rng.choice("xyz") for _ in range(rng.randint(0, n)))
        out[i] = rng.choice([b, b * rng.randint(1, 3), "ab" * rng.randint(0, 200), "é" * rng.randint(0, 150), None,
                             *[noise(50) + b[a:a + rng.randint(80, 140)] + noise(120)] * 4])
    return out


def check(spark, docs: dict, **options):
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.digests(df, **options).collect()}
    assert got == {i: removal_row(*x) for i, x in removed(docs).items()}


def test_equals_brute_force_by_both_routes(spark, small):
    check(spark, passages())
    check(spark, passages(), limit=64)
    check(spark, {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()})


def test_groups_list_every_first_context(spark):
    docs = {1: "q" * 3 + "passage " * 1 + "abcdefghij" * 12 + "1", 2: "zz" + "abcdefghij" * 12 + "2", 3: "nothing"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    rows = repeats.repeat_groups(df).collect()
    assert rows and {r["doc_id"] for r in rows} <= {1, 2}
    for r in rows:
        same = {docs[x["doc_id"]][x["start"]:x["start"] + x["shared"]] for x in rows if x["grp"] == r["grp"]}
        assert len(same) == 1 and len(same.pop()) >= 100


def test_odd_rows(spark):
    got = {r["doc_id"]: r for r in repeats.digests(odd_docs(spark)).collect()}
    assert got[0]["n_bytes"] == 0 and got[9]["n_removed"] == 699 and got[10]["n_bytes"] == 150_000 and got[None]["n_removed"] == 0
    docs = odd_docs(spark)
    out = repeats.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[0] is None and texts[9] == "x" and texts[None] == "no id at all" and texts[6] == "漢字 and 𝄞"
    assert repeats.digests(no_docs(spark)).count() == 0 and repeats.without_repeats(no_docs(spark)).count() == 0


def places_of(docs, width):
    out = {}
    for i, t in docs.items():
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            out.setdefault(b[p:p + width], set()).add((i, p))
    return out


def check_groups(spark, docs, **options):
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    groups = {}
    for r in repeats.repeat_groups(df.unionByName(df.limit(5)), **options).collect():
        groups.setdefault((r["grp"], r["shared"]), []).append((r["doc_id"], r["start"]))
    plain = {i: (t or "").encode() for i, t in docs.items()}
    widths, strings, covered = {100: places_of(docs, 100)}, set(), set()
    for (_, n), at in groups.items():
        i, a = at[0]
        w = plain[i][a:a + n]
        if n not in widths:
            widths[n] = places_of(docs, n)
        assert len(at) == len(set(at)) > 1 and set(at) == widths[n][w] and w not in strings
        strings.add(w)
        for o in range(n - 99):
            if len(widths[100][w[o:o + 100]]) == len(at):
                covered.add(w[o:o + 100])
    assert covered == {w for w, at in widths[100].items() if len(at) > 1}


def test_groups_have_all_occurrences_by_both_routes(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage, copy = word(400), word(260)
    docs = {i: rng.choice([copy, word(30) + passage[:rng.randint(90, 400)] + word(90), word(50) + passage + word(50), None]) for i in range(90)}
    docs |= {90: word(300), 91: "ab" * 90, 92: "x" * 130, 93: copy[40:200]}
    check_groups(spark, {1: copy, 2: copy})
    check_groups(spark, docs)
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    check_groups(spark, docs, limit=1)
