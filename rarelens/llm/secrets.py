"""Secret scans in DataFrame expressions only: token patterns, and sliding-window entropy of candidate strings.

Patterns are matched leftmost and without overlap per kind; matches under the kind's length are dropped afterwards, so what
a short match has consumed is not matched again. Spans are code points, end exclusive.

Entropy: candidates are runs of `[A-Za-z0-9+/_=-]` of a window's length at least. Each is scanned by a
window of its character class (hexadecimal digits and dashes, else the base-64 alphabet). Counts per character are kept and
changed by the entering and the leaving character, and so is the sum of c log2 c, from which the Shannon entropy follows.
The span goes from the first to the last window over the class's threshold. Candidates that match the allow-list, and spans
inside a pattern's span, are suppressed; pattern spans always stay.

Everything is one projection of a row: no shuffle, and no Python on the executors.

Defined results: null texts are empty; empty texts have no spans; equal spans of different kinds are both kept; repeated rows
give repeated results; input columns pass through, and a column named like a result raises.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order that they are listed with their pattern, the group that counts, and its least length.
KINDS = (
    ("assign", r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
ENTROPY = "entropy"
#: (alphabet, window, threshold in bits): the first class whose alphabet holds the whole candidate is used.
CLASSES = (("0123456789abcdefABCDEF-", 20, 3.0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.6))
#: Candidates that match one of these are not reported: numbers, dates, placeholders, and words in a row (lower case, upper
#: case or camel case, joined by anything of the alphabet, with up to four digits at the end). Letters whose case changes within
#: words are no words. The loops are possessive, so a long candidate is read once.
ALLOWED = (r"^[0-9_=+/-]+$", r"(?i)example|placeholder|x{4,}|your[_-]|0123456789|abcdefgh",
           r"^[/_=+-]*+(?:(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}(?![a-z])|[A-Za-z](?![A-Za-z]))[/_=+-]*+)*+[0-9]{0,4}$")


def _weight(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def entropy_window(candidate: Column, alphabet: str, window: int, threshold: float) -> Column:
    """(first, last): starts of the first and last window whose entropy reaches the threshold; null without one.

    One pass over the characters; the state holds the counts per character, their sum of c log2 c and the window's start.
    """
    chars = F.split(candidate, "")
    codes = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c).cast("int"))
    start = F.struct(F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("i"),
                     F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def step(acc: Column, code: Column) -> Column:
        leaving = F.when(acc["i"] >= window, F.get(codes, acc["i"] - window)).otherwise(F.lit(-1))
        c_in = F.get(acc["counts"], code)
        # a character that enters and leaves at once changes nothing
        same = leaving == code
        c_out = F.when(leaving >= 0, F.get(acc["counts"], leaving)).otherwise(F.lit(0))
        total = F.when(same, acc["sum"]).otherwise(
            acc["sum"] + _weight(c_in + 1) - _weight(c_in) + F.when(leaving >= 0, _weight(c_out - 1) - _weight(c_out)).otherwise(F.lit(0.0)))
        counts = F.when(same, acc["counts"]).otherwise(F.transform(
            acc["counts"], lambda c, k: c + (k == code).cast("int") - (k == leaving).cast("int")))
        hit = (acc["i"] >= window - 1) & (F.lit(math.log2(window)) - total / window >= threshold)
        at = acc["i"] - (window - 1)
        return F.struct(counts.alias("counts"), total.alias("sum"), (acc["i"] + 1).alias("i"),
                        F.when(hit & acc["first"].isNull(), at).otherwise(acc["first"]).alias("first"),
                        F.when(hit, at).otherwise(acc["last"]).alias("last"))

    return F.aggregate(codes, start, step, lambda acc: F.when(acc["first"].isNotNull(), F.struct(acc["first"].alias("first"), acc["last"].alias("last"))))


def find_secrets(rows: DataFrame, text_col: str = "text", classes=CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """The rows with `base_spans` and `secret_spans` appended: sorted arrays of (start, kind number, end).

    Kind numbers follow `KINDS`; the last one is entropy.
    """
    clash = {"base_spans", "secret_spans"} & set(rows.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    least = min(w for _, w, _ in classes)
    charset = r"[A-Za-z0-9+/_=-]"
    candidate = rf"(?<!{charset}){charset}{{{least},}}"
    patterns = [(p, k) for k, (_, p, _, _) in enumerate(KINDS)] + [(candidate, len(KINDS))]
    found = rows.select(*columns, text.alias("__text"), *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"__m{k}") for p, k in patterns])
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    located = found.select(*columns, *[
        F.when(F.size(f"__m{k}") > 0, _located("__text", f"__m{k}", p, k)).otherwise(empty).alias(f"__s{k}") for p, k in patterns])

    def long_enough(k: int) -> Column:
        _, pattern, group, size = KINDS[k]
        part = (lambda m: F.regexp_extract(m, pattern, group)) if group else (lambda m: m)
        return F.filter(f"__s{k}", lambda s: F.length(part(s["match"])) >= size)

    base = F.concat(*[long_enough(k) for k in range(len(KINDS))])
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    based = located.select(*columns, F.sort_array(bare(base)).alias("base_spans"), F.col(f"__s{len(KINDS)}").alias("__candidates"))

    def judged(s: Column) -> Column:
        out = F.lit(None).cast("struct<first:int,last:int>")
        width = F.lit(0)
        for alphabet, window, threshold in reversed(classes):
            fits = F.length(F.translate(s["match"], alphabet, "")) == 0
            out = F.when(fits, entropy_window(s["match"], alphabet, window, threshold)).otherwise(out)
            width = F.when(fits, F.lit(window)).otherwise(width)
        return F.struct(s["start"].alias("start"), out.alias("hit"), width.alias("width"))

    listed = F.filter("__candidates", lambda s: ~_any([s["match"].rlike(a) for a in allowed]))
    hits = F.filter(F.transform(listed, judged), lambda h: h["hit"].isNotNull())
    spans = F.transform(hits, lambda h: F.struct((h["start"] + h["hit"]["first"]).alias("start"), F.lit(len(KINDS)).alias("kind"),
                                                 (h["start"] + h["hit"]["last"] + h["width"]).alias("end")))
    added = based.select(*columns, "base_spans", F.when(F.size("__candidates") > 0, spans).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("__added"))
    outside = F.filter("__added", lambda s: ~F.exists("base_spans", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"])))
    return added.select(*columns, "base_spans", F.sort_array(F.concat("base_spans", outside)).alias("secret_spans"))


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _located(text: str, found: str, pattern: str, kind: int) -> Column:
    """Array of (start, kind, end, match) of a row's matches: lengths of the gaps between them and of them, summed up."""
    gaps = F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(F.col(found), gaps, lambda m, g: F.struct(F.length(g).alias("g"), F.length(m).alias("n"), m.alias("m")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, p: F.struct(
        (acc["at"] + p["g"] + p["n"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + p["g"]).alias("start"), F.lit(kind).alias("kind"),
                                              (acc["at"] + p["g"] + p["n"]).alias("end"), p["m"].alias("match")))).alias("out")),
        lambda acc: acc["out"])


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined in the order of the spans."""
    names = F.array(*[F.lit(k) for k, *_ in KINDS], F.lit(ENTROPY))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(rows: DataFrame, text_col: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """The rows with every secret span of the text replaced by a mark; overlapping spans share one. Needs `secret_spans`."""
    text = F.col(text_col)
    end = F.length(text) + 1
    # (text so far, first code point that is not written yet)
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.struct(
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out"),
        F.greatest(acc["at"], s["end"]).alias("at"))
    clean = F.aggregate("secret_spans", state, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, end)))
    return rows.withColumn(text_col, F.when(F.size("secret_spans") > 0, clean).otherwise(text)).drop("base_spans", "secret_spans")
