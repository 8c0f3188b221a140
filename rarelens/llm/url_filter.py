"""URL filters: a broadcast trie over reversed host labels and path segments; the longest matching rule decides.

A rule is (action, host, path). It fits its host and every subdomain when the url's path starts with the rule's path.
Among the fitting rules the one with the longest host wins, then the one with the longest path; of two equal rules the
block. A url without a fitting rule gets the default verdict.

Defined results: a null url, or one without `://`, has an empty host and path and gets the default verdict unless a rule
with an empty host fits; repeated rows give repeated results; no rules leave everything to the default; an empty table
gives an empty result. Columns of the input other than id and url are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.session import ship_with_tasks

ship_with_tasks(__name__)

#: A rule list beyond this many characters is joined instead of broadcast.
TRIE_CHARS = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


class Trie:
    """Nodes are dicts: host labels from the right, then path segments that end in a slash.

    "" leads from the host part to the path part, None holds the path tails after the last slash as (tail, action, rule).
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for action, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault((label,), {})
            node = node.setdefault("", {})
            *segments, tail = path.split("/")
            for segment in segments:
                node = node.setdefault(segment + "/", {})
            node.setdefault(None, []).append((tail, action, host + path))
        self._sort(self.root)

    def _sort(self, node: dict) -> None:
        waiting = [node]
        while waiting:
            for key, child in waiting.pop().items():
                if key is None:
                    child.sort(key=lambda x: (-len(x[0]), x[1] != "block"))
                else:
                    waiting.append(child)

    def _path(self, node: dict, path: str) -> tuple[str, str] | None:
        best, rest = None, path
        while True:
            for tail, action, rule in node.get(None, ()):
                if rest.startswith(tail):
                    best = action, rule
                    break
            head, slash, after = rest.partition("/")
            if not slash or head + "/" not in node:
                return best
            node, rest = node[head + "/"], after

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get((label,))
            if node is None:
                break
            if "" in node:
                best = self._path(node[""], path) or best
        return best or (None, None)


def with_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """`host` and `path` of a url, both empty where it is null or has no `://`."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(coalesce(cast(`{url_col}` as string), ''), instr(`{url_col}`, '://') + 3)")).otherwise("")
    return df.select("*", F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
                     F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))


def filter_urls(df: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url",
                trie_chars: int = TRIE_CHARS) -> DataFrame:
    """id, host, path, rule (null without one) and verdict of every url.

    The rules are a parameter of the job. Their trie is broadcast while their text stays under `trie_chars`; a longer list
    is a table that the urls' host suffixes and path prefixes are joined with.
    """
    if any(action not in ("allow", "block") for action, _, _ in rules):
        raise ValueError("a rule's action is allow or block")
    parts = with_parts(df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url").drop("_url")
    if sum(len(h) + len(p) for _, h, p in rules) > trie_chars:
        found = _joined(parts, rules)
    else:
        trie = df.sparkSession.sparkContext.broadcast(Trie(rules))

        @F.pandas_udf("struct<action:string,rule:string>")
        def judge(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            match = trie.value.match
            for host, path in pairs:
                yield pd.DataFrame([match(h, p) for h, p in zip(host, path, strict=True)], columns=["action", "rule"], dtype=object)

        found = parts.withColumn("_m", judge("host", "path")).select("_id", "host", "path", "_m.action", "_m.rule")
    return found.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def _joined(parts: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same decision by joins: candidates of a url are its host suffixes times its path prefixes that end in a slash."""
    spark = parts.sparkSession
    table = spark.createDataFrame([(a, h, "/".join(p.split("/")[:-1]), p.count("/"), p) for a, h, p in rules],
                                  "action string, r_host string, r_dir string, r_depth int, r_path string")
    urls = parts.select("host", "path").distinct()
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    keys = (urls.withColumn("_l", labels).withColumn("_s", segments)
            .withColumn("_i", F.explode(F.expr("sequence(1, size(_l))")))
            .withColumn("_d", F.explode(F.expr("sequence(0, size(_s) - 1)")))
            .select("host", "path", F.expr("array_join(slice(_l, _i, size(_l)), '.')").alias("r_host"),
                    F.expr("CASE WHEN _d = 0 THEN '' ELSE array_join(slice(_s, 1, _d), '/') END").alias("r_dir"), F.col("_d").alias("r_depth")))
    fits = keys.join(table, ["r_host", "r_dir", "r_depth"]).where("startswith(path, r_path)")
    best = fits.groupBy("host", "path").agg(F.max_by(
        F.struct("action", F.concat("r_host", "r_path").alias("rule")),
        F.struct(F.length("r_host"), F.length("r_path"), "action")).alias("_m"))
    return parts.join(best, ["host", "path"], "left").select("_id", "host", "path", "_m.action", "_m.rule")
