import hashlib

import pytest
import tiktoken

from rarelens.llm import byte_bpe
from rarelens.llm.catalog import tokenizer_ranks
from tests.llm.brute import no_docs, odd_docs, thue_morse

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks():
    return tokenizer_ranks()


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def row(encoding, text):
    ids = encoding.encode_ordinary(text or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())


def check(spark, docs, ranks, encoding):
    texts = docs.select("doc_id", "text").collect()
    got = sorted(map(str, ((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.digests(docs, ranks).collect())))
    assert got == sorted(map(str, ((r["doc_id"], *row(encoding, r["text"])) for r in texts)))


def test_digests_equal_the_library(spark, small, ranks, encoding):
    check(spark, spark.read.parquet(f"{small}/documents.parquet"), ranks, encoding)
    check(spark, odd_docs(spark), ranks, encoding)


def test_chunks_of_equal_content(spark, ranks, encoding):
    docs = spark.createDataFrame([(i, "one text, said again") for i in range(8)], "doc_id long, text string").repartition(4)
    check(spark, docs, ranks, encoding)
    check(spark, spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), ranks, encoding)


def test_round_trip(spark, ranks, encoding):
    docs = odd_docs(spark)
    ids = byte_bpe.encode(docs, ranks)
    got = {r["doc_id"]: bytes(r["bytes"]).decode() for r in byte_bpe.decode(ids, ranks).collect()}
    assert got == {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert {r["doc_id"]: r["ids"] for r in ids.collect()}[11] == encoding.encode_ordinary(docs.where("doc_id = 11").first()["text"])


def test_empty_table(spark, ranks):
    assert byte_bpe.digests(no_docs(spark), ranks).count() == 0 and byte_bpe.encode(no_docs(spark), ranks).count() == 0


def test_words_with_one_hash(spark, ranks, encoding):
    words = [w for n in (1024, 2048) for w in thue_morse(n)]
    texts = [*words, " ".join(words), " ".join(reversed(words)), "-".join(words[:2] * 3)]
    check(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), ranks, encoding)


def test_few_remembered_words(spark, ranks, encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 3)
    check(spark, odd_docs(spark), ranks, encoding)
