"""I-Match fingerprints in DataFrame expressions only.

Terms are the distinct runs of letters and digits of a text in lower case, as 64-bit hashes. The lexicon holds the terms of
a band of document frequencies, [max(min_docs, low * N), high * N]; as a text has some hundred distinct terms, at most
(terms per text) / low terms reach the lower bound, whatever N is. So the lexicon is broadcast, after a check of its size,
and joined in a shuffle beyond it.

A text's fingerprint starts with one entry for all its terms in the lexicon. The others are of randomised lexicon subsets:
four families of 16 subsets by a hash of the term. The subsets of the first are a partition of the lexicon, so each of
its terms counts; those of the others hold 1/128, 1/512 and 1/2048 of the terms each and tell how much of a long text is
the same. An entry is the hash of the set of the text's terms in the subset (0 without one). Sets are hashed by exclusive
or of the terms' hashes, so a text's row is summed up before the shuffle, whatever its number of terms. A text without a
term in the lexicon has the hash of the whole text as its first entry.

Likeness of two fingerprints: 1 if the first entries are equal; else the share of equal entries among the first and those
where either has a term, in the sparsest family in which at least 8 have one (else in all).

Defined results: null texts are empty; equal texts have equal fingerprints and likeness 1; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarelens.operators.ordered import range_buckets
from rarelens.session import materialize

#: (subsets, slots of 1/4096 per subset): a partition of all slots, then densities 1/128, 1/512 and 1/2048.
SUBSETS = ((16, 256), (16, 32), (16, 8), (16, 2))
SLOTS = 4096
#: Most ranges of ids; the one window over all ranges orders no more lines than this.
RANGES = 10_000
LEXICON_BROADCAST = 2_000_000


def _members(term: Column) -> list[Column]:
    """For each subset whether a term is in it; each family has a digit of the hash of its own."""
    out = []
    for n, (count, width) in enumerate(SUBSETS):
        slot = F.pmod(F.shiftrightunsigned(term, 12 * n), F.lit(SLOTS))
        out += [(slot >= r * width) & (slot < (r + 1) * width) for r in range(count)]
    return out


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(texts: DataFrame, low: float, high: float, min_docs: int) -> DataFrame:
    """Terms of the band, from the document frequencies of all texts."""
    total = texts.count()
    return (texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("docs"))
            .where((F.col("docs") >= max(min_docs, low * total)) & (F.col("docs") <= max(high * total, min_docs))).select("term"))


def _entry(members: Column) -> Column:
    return F.when(members.isNotNull(), F.pmod(F.xxhash64(members), F.lit(2**31 - 1)) + 1).otherwise(F.lit(0)).cast("int")


def fingerprints(texts: DataFrame, band: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """keys, keep and `entries` of rows (keys, keep, text); rows with equal keys must be equal."""
    exploded = texts.select(*keys, *keep, F.xxhash64("text").alias("__text"), F.posexplode_outer(terms(F.col("text"))).alias("__at", "term"))
    bounded = F.broadcast(band) if band.count() <= LEXICON_BROADCAST else band
    marked = exploded.join(bounded.select("term", F.lit(True).alias("__in")), "term", "left")
    # a text's first line stays in any case, so that texts without a term in the lexicon have a row
    marked = marked.where(F.col("__in") | (F.coalesce("__at", F.lit(0)) == 0))
    term = F.when(F.col("__in"), F.col("term"))
    found = marked.groupBy(*keys).agg(F.bit_xor(term).alias("__all"), F.first("__text").alias("__text"), *[F.first(c).alias(c) for c in keep],
                                      *[F.bit_xor(F.when(m, term)).alias(f"__e{r}") for r, m in enumerate(_members(F.col("term")))])
    count = sum(n for n, _ in SUBSETS)
    return found.select(*keys, *keep, F.array(_entry(F.coalesce("__all", F.col("__text"))), *[_entry(F.col(f"__e{r}")) for r in range(count)]).alias("entries"))


def text_of(entries: str) -> Column:
    return F.array_join(F.transform(entries, lambda e: F.lpad(F.hex(e), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    pairs = F.zip_with(F.col(a), F.col(b), lambda x, y: F.struct(((x != 0) | (y != 0)).cast("int").alias("any"), ((x == y) & (x != 0)).cast("int").alias("same")))
    count = lambda part, field: F.aggregate(part, F.lit(0), lambda acc, p: acc + p[field])
    subsets = F.slice(pairs, 2, sum(n for n, _ in SUBSETS))
    share = lambda part: count(part, "same") / (count(part, "any") + 1)
    first, out = 0, share(subsets)
    for size, _ in SUBSETS:                     # the sparsest family that says enough is looked at first
        part = F.slice(subsets, first + 1, size)
        out = F.when(count(part, "any") >= 8, share(part)).otherwise(out)
        first += size
    return F.when(F.get(a, F.lit(0)) == F.get(b, F.lit(0)), F.lit(1.0)).otherwise(out)


def with_next(texts: DataFrame, per_bucket: int = 1000) -> DataFrame:
    """(id, text, next_id, next_text): the next document in descending order of id, after the last the first.

    Ids are cut into ranges of about `per_bucket` documents (at most `RANGES` ranges) at quantiles of a sample, so ids may
    lie anywhere; the order is a window inside a range, and each range also gets the first document of the next one.
    Repeated ids are reduced to one row.
    """
    total = texts.count()
    if not total:
        return texts.select("id", "text", F.col("id").alias("next_id"), F.col("text").alias("next_text"))
    cuts = range_buckets(texts.select("id"), ["id"], buckets=max(2, min(RANGES, -(-total // per_bucket))))
    texts = cuts.apply(texts.select("id", "text")).withColumnRenamed("_bucket_id", "bucket")
    first = materialize(texts.groupBy("bucket").agg(F.max("id").alias("id")), "ranges")
    # one row per range: the range before (in descending order) also gets this range's first document
    last_range = F.first("bucket").over(Window.orderBy("bucket"))
    ghosts = first.select("id", F.coalesce(F.lead("bucket").over(Window.orderBy("bucket")), last_range).alias("bucket"))
    rows = texts.select("id", "text", "bucket", F.lit(0).alias("ghost"))
    extra = texts.drop("bucket").join(ghosts, "id").select("id", "text", "bucket", F.lit(1).alias("ghost"))
    both = rows.unionByName(extra).repartition("bucket")
    once = both.withColumn("__n", F.row_number().over(Window.partitionBy("bucket", "ghost", "id").orderBy("text"))).where("__n = 1")
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc("id"))
    return (once.withColumn("next_id", F.lead("id").over(order)).withColumn("next_text", F.lead("text").over(order))
            .where("ghost = 0").select("id", "text", "next_id", "next_text"))


def edited(text: Column, other: Column) -> Column:
    """The last half of the text (rounded down) replaced by as many code points of the other's start, or all it has."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = 0.001, high: float = 0.1,
                  min_docs: int = 2) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see `with_next` and `edited`.

    Rows without an id have no place in the order of documents and are left out.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("id is not null")
    band = materialize(lexicon(texts, low, high, min_docs), "lexicon")
    pairs = with_next(texts).withColumn("other", edited(F.col("text"), F.col("next_text")))
    sides = pairs.select("id", F.length("text").cast("long").alias("n_chars"), "next_id", F.sha2("other", 256).alias("edited_sha256"),
                         F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text")), F.struct(F.lit(1).alias("side"), F.col("other").alias("text")))).alias("s"))
    found = fingerprints(sides.select("id", "n_chars", "next_id", "edited_sha256", "s.side", "s.text"), band, ["id", "side"], ["n_chars", "next_id", "edited_sha256"])
    docs_fp = materialize(found.groupBy("id").agg(
        F.first("n_chars").alias("n_chars"), F.first("next_id").alias("next_id"), F.first("edited_sha256").alias("edited_sha256"),
        F.max(F.when(F.col("side") == 0, F.col("entries"))).alias("own"), F.max(F.when(F.col("side") == 1, F.col("entries"))).alias("changed")), "fingerprints")
    following = docs_fp.select(F.col("id").alias("next_id"), F.col("own").alias("following"))
    return docs_fp.join(following, "next_id").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", text_of("own").alias("fingerprint"), text_of("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"))
