"""The operators' queries over the given tables, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rarelens.llm import byte_bpe, fingerprint, hard_negatives, language, merkle, neighbours, ngram_join, packing, quality, repeats, secrets, toxicity, url_filter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, directory: str) -> DataFrame:
    """Every document's words packed into sequences of 256 to 4096."""
    return packing.pack(table(spark, directory, "documents"), packing.word_count("text"))


#: Fixed values: (action, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op2_url_filters", r"""
WITH rest AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(action, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT page_id, action, rhost || rpath AS rule,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS n
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (page_id)
""")
def url_filters(spark: SparkSession, directory: str) -> DataFrame:
    """Longest-match verdict of every page's url; urls that no rule fits are allowed."""
    return url_filter.filter_urls(table(spark, directory, "pages"), URL_RULES)


@query("op3_language_id")
def language_id(spark: SparkSession, directory: str) -> DataFrame:
    """Language of every document from its text, its declared language and its source's prior."""
    docs = table(spark, directory, "documents").select("doc_id", "text", "lang", "source")
    found = language.identify(docs, known_col="lang", declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", F.col("detected").alias("language"), F.round("confidence", 9).alias("confidence"))


def page_text(html: str) -> Column:
    """Visible text of a page: without scripts, styles and tags."""
    bare = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>", " ")


@query("language_id_pages")
def language_id_pages(spark: SparkSession, directory: str) -> DataFrame:
    """Language of every page from its text, markup, address suffix and host; the text model is that of the documents."""
    docs = table(spark, directory, "documents")
    model = language.fit_text(docs, F.col("text"), F.lower(F.col("lang")))
    pages = url_filter.with_parts(table(spark, directory, "pages")).select("page_id", "host", page_text("html").alias("text"), F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1).alias("declared"))
    found = language.identify(pages, declared=F.nullif(F.col("declared"), F.lit("")), host=F.col("host"),
                              suffix=F.nullif(F.substring_index("host", ".", -1), F.lit("")), model=model)
    return found.select("page_id", F.col("detected").alias("language"), F.round("confidence", 9).alias("confidence"))


@query("op4_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """What is left of every document without repeats of 100 bytes."""
    return repeats.digests(table(spark, directory, "documents"))


@query("op5_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    """The 5 nearest other vectors of each vector whose id is divisible by 50."""
    return neighbours.search(table(spark, directory, "embeddings"), every=50)


def tokenizer_ranks(path: str | None = None) -> dict[bytes, int]:
    import public_tokenizers
    return byte_bpe.read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query("op6_byte_bpe")
def byte_bpe_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return byte_bpe.digests(table(spark, directory, "documents"), tokenizer_ranks())


@query("op7_secret_scan")
def secret_scan(spark: SparkSession, directory: str) -> DataFrame:
    """Pattern and entropy spans of every document."""
    found = secrets.find_secrets(table(spark, directory, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(secrets.joined("base_spans"), 256).alias("base_sha256"), secrets.joined("secret_spans").alias("spans"))


@query("op8_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, directory: str) -> DataFrame:
    """Components of documents that share 90 % of their 3-word shingles."""
    return ngram_join.join_similar(table(spark, directory, "documents"))


@query("op9_document_fingerprints")
def document_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.compare_edits(table(spark, directory, "documents"))


@query("op10_toxicity")
def toxic_documents(spark: SparkSession, directory: str) -> DataFrame:
    """Toxicity of every document; a third of the labels is held out from learning."""
    docs = table(spark, directory, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.fit(docs, table(spark, directory, "labels").where(~held_out))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("score"),
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_passages", "evidence")


@query("op11_merkle_manifest", r"""
WITH RECURSIVE
crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id, source, lang, n_chars, text,
         CASE WHEN doc_id IS NULL THEN 1 ELSE xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) END AS crc
  FROM documents, crc_table),
seen AS (SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown FROM doc),
part AS (
  SELECT *, list_aggregate(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
              lambda v: CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END), 'string_agg', '') AS head FROM seen),
leaf AS (
  SELECT rid, doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS digest,
         sha256(head || CASE WHEN shown IS NULL THEN '-' ELSE strlen(shown) || ':' || shown END) AS shown FROM part),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaf),
own AS (
  SELECT source, 0 AS level, i, n, digest FROM ranked
  UNION ALL
  SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM own WHERE n > 1 GROUP BY source, level, n, i // 3),
sub AS (
  SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM own WHERE n = 1),
top AS (
  SELECT 0 AS level, i, n, subroot AS digest FROM sub
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, n, i // 3),
steps AS (
  SELECT r.rid, o.level, o.i < r.i // (3 ** o.level)::BIGINT AS is_left, o.i AS pos, o.digest
  FROM ranked r JOIN own o ON o.source IS NOT DISTINCT FROM r.source AND o.n > 1
    AND o.i // 3 = r.i // (3 ** (o.level + 1))::BIGINT AND o.i <> r.i // (3 ** o.level)::BIGINT
  UNION ALL
  SELECT r.rid, s.height + t.level, t.i < s.i // (3 ** t.level)::BIGINT, t.i, t.digest
  FROM ranked r JOIN sub s ON s.source IS NOT DISTINCT FROM r.source JOIN top t ON t.n > 1
    AND t.i // 3 = s.i // (3 ** (t.level + 1))::BIGINT AND t.i <> s.i // (3 ** t.level)::BIGINT),
sides AS (
  SELECT rid, level, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (is_left), '') AS lefts,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (NOT is_left), '') AS rights FROM steps GROUP BY ALL),
proof AS (SELECT rid, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof_sha256 FROM sides GROUP BY rid),
way AS (
  SELECT r.rid, r.shown, s.subroot, s.height + (SELECT max(level) FROM top) AS levels FROM ranked r JOIN sub s ON s.source IS NOT DISTINCT FROM r.source),
folds AS (
  SELECT rid, 0 AS level, shown AS digest, levels FROM way
  UNION ALL
  SELECT f.rid, f.level + 1, sha256(coalesce(s.lefts, '') || f.digest || coalesce(s.rights, '')), levels
  FROM folds f LEFT JOIN sides s ON s.rid = f.rid AND s.level = f.level WHERE f.level < f.levels)
SELECT r.doc_id, r.digest AS leaf, w.subroot, t.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root,
       f.digest = t.digest AS verified
FROM ranked r JOIN way w USING (rid) JOIN folds f ON f.rid = r.rid AND f.level = f.levels LEFT JOIN proof p ON p.rid = r.rid
CROSS JOIN (SELECT digest FROM top WHERE n = 1) t
""")
def merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; half of the documents are presented without their line ends."""
    docs = table(spark, directory, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], presented={"text": shown})
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


@query("op12_hard_negatives", """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
""")
def hard_negative_rows(spark: SparkSession, directory: str) -> DataFrame:
    """Negatives of 80 to 100 % of the positive's score, for the anchors whose id is divisible by 100; every seventh label is wrong."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, directory, "embeddings"), F.col("id") % 100 == 0, label=label)


@query("op13_quality")
def quality_of_documents(spark: SparkSession, directory: str) -> DataFrame:
    """Quality of every document; a quarter of the labels is held out from learning."""
    docs = table(spark, directory, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = quality.fit(docs, table(spark, directory, "labels").where(~held_out))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         "n_passages", "top_first_byte", "top_end_byte", "top_attention")
