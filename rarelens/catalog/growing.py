"""Trees grown by histograms: boosting rounds, early stopping, class trees, and attributions along their paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarelens.catalog.registry import query, rounded
from rarelens.operators import trees
from rarelens.operators.trees import Growth
from rarelens.plans import attributions, ensembles, explain
from rarelens.sources import tables

WIDTH = 64
ALL = tuple(f"e{i}" for i in range(WIDTH))
BINS = 32

#: Every dimension of every vector in bins between distinct quantiles; `x` has a line per row and feature.
BINNED = f"""base AS (SELECT vec_id, (label = 0)::INTEGER AS y, embedding FROM embeddings),
x AS (SELECT vec_id, y, f - 1 AS f, embedding[f]::DOUBLE AS v FROM base, range(1, {WIDTH + 1}) r(f)),
ed AS (SELECT f, list_sort(list_distinct(quantile_disc(v, [{', '.join(repr(i / BINS) for i in range(1, BINS))}]))) AS e FROM x WHERE LEARNED GROUP BY f),
bx AS MATERIALIZED (SELECT vec_id, y, x.f, v, len(list_filter(e, lambda t: t <= v)) AS b, e FROM x JOIN ed USING (f))"""


def level_sql(step: str, rows: str, level: int, shift: str, gain: str, fits: str) -> str:
    """CTEs of one level: `rows`(vec_id, node, a, c) to the best splits and the rows' next nodes."""
    return f"""
h{step} AS (SELECT node, f, b, sum(a)::HUGEINT AS a, sum(c)::HUGEINT AS c, count(*) AS n FROM {rows} JOIN bx USING (vec_id) GROUP BY ALL),
s{step} AS (SELECT node, f, b, sum(a) OVER w AS la, sum(c) OVER w AS lc, sum(n) OVER w AS ln, sum(a) OVER p AS ta, sum(c) OVER p AS tc, sum(n) OVER p AS tn
  FROM h{step} WINDOW w AS (PARTITION BY node, f ORDER BY b), p AS (PARTITION BY node, f)),
v{step} AS (SELECT node, f, b, ln, tn, la / 2.0::DOUBLE ** {shift} AS la, lc / 2.0::DOUBLE ** {shift} AS lc, (ta - la) / 2.0::DOUBLE ** {shift} AS ra,
  (tc - lc) / 2.0::DOUBLE ** {shift} AS rc, ta / 2.0::DOUBLE ** {shift} AS ta, tc / 2.0::DOUBLE ** {shift} AS tc FROM s{step}),
g{step} AS (SELECT *, {gain} AS gain FROM v{step} WHERE ln < tn),
k{step} AS MATERIALIZED (SELECT g.*, ed.e[b + 1] AS threshold FROM g{step} g JOIN ed USING (f) WHERE gain > 1e-9 AND {fits}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, g.b) = 1),
n{step} AS MATERIALIZED (SELECT r.vec_id, r.a, r.c, CASE WHEN k.node IS NULL THEN r.node ELSE r.node || CASE WHEN bx.b <= k.b THEN 'L' ELSE 'R' END END AS node
  FROM {rows} r LEFT JOIN k{step} k ON k.node = r.node AND length(r.node) = {level} LEFT JOIN bx ON bx.vec_id = r.vec_id AND bx.f = k.f)"""


def nodes_sql(tree: int, splits: list[str], leaves: str, shift: str, value: str, cover: str) -> str:
    """(tree, path, feature, threshold, gain, rows, cover, value) of a tree, from its splits and its rows' leaves."""
    every = " UNION ALL ".join(f"SELECT node, f, threshold, gain FROM {s}" for s in splits)
    prefix = f"(SELECT DISTINCT substr(node, 1, i) AS path FROM {leaves}, range(0, {len(splits) + 1}) r(i) WHERE i <= length(node))"
    return f"""SELECT {tree} AS tree, p.path, coalesce(k.f, -1)::INTEGER AS feature, round(k.threshold, 6) AS threshold, round(coalesce(k.gain, 0.0), 6) AS gain,
 t.n AS rows, round({cover}, 6) AS cover, round({value}, 6) AS value
FROM {prefix} p LEFT JOIN ({every}) k ON k.node = p.path
JOIN LATERAL (SELECT count(*) AS n, sum(a)::HUGEINT / 2.0::DOUBLE ** {shift} AS ta, sum(c)::HUGEINT / 2.0::DOUBLE ** {shift} AS tc
 FROM {leaves} l WHERE starts_with(l.node, p.path)) t ON true"""


SHIFT = "(SELECT least(40, 60 - ceil(log2(16 * count(*) + 2))) FROM base)"
LAMBDA, ALPHA, RATE, CHILD = 1.0, 0.5, 0.5, 1.0


def _soft(v: str) -> str:
    return f"(sign({v}) * greatest(abs({v}) - {ALPHA}::DOUBLE, 0))"


def _part(a: str, c: str) -> str:
    return f"({_soft(a)} * {_soft(a)} / ({c} + {LAMBDA}::DOUBLE))"


GAIN = f"{_part('la', 'lc')} + {_part('ra', 'rc')} - {_part('ta', 'tc')}"
STEP = f"(- {_soft('ta')} / (tc + {LAMBDA}::DOUBLE))"


def boosting_sql(rounds: int, learned: str = "true") -> str:
    """CTEs of a few boosting rounds of depth 2: m<r>(vec_id, y, m) are the margins before round r, and n<r>b the leaves."""
    parts = [BINNED.replace("LEARNED", learned), "m0 AS (SELECT vec_id, y, 0.0::DOUBLE AS m FROM base)"]
    for r in range(rounds):
        p = "(1 / (1 + exp(-m)))"
        parts.append(f"""r{r} AS MATERIALIZED (SELECT vec_id, '' AS node, round(({p} - y) * 2.0::DOUBLE ** {SHIFT})::HUGEINT AS a,
 round(greatest({p} * (1 - {p}), 1e-16) * 2.0::DOUBLE ** {SHIFT})::HUGEINT AS c FROM m{r} WHERE {learned})""")
        fits = f"least(lc, rc) >= {CHILD}"
        parts += [level_sql(f"{r}a", f"r{r}", 0, SHIFT, GAIN, fits), level_sql(f"{r}b", f"n{r}a", 1, SHIFT, GAIN, fits)]
        # every row, learned from or not, goes to its leaf
        parts.append(f"""w{r} AS (SELECT node, {STEP} AS step FROM (SELECT node, sum(a)::HUGEINT / 2.0::DOUBLE ** {SHIFT} AS ta,
 sum(c)::HUGEINT / 2.0::DOUBLE ** {SHIFT} AS tc FROM n{r}b GROUP BY node)),
p{r} AS (SELECT m.vec_id, CASE WHEN k.node IS NULL THEN '' WHEN bx.b <= k.b THEN 'L' ELSE 'R' END AS node
 FROM m{r} m LEFT JOIN k{r}a k ON true LEFT JOIN bx ON bx.vec_id = m.vec_id AND bx.f = k.f),
q{r} AS (SELECT p.vec_id, CASE WHEN k.node IS NULL THEN p.node WHEN bx.b <= k.b THEN p.node || 'L' ELSE p.node || 'R' END AS node
 FROM p{r} p LEFT JOIN k{r}b k ON k.node = p.node LEFT JOIN bx ON bx.vec_id = p.vec_id AND bx.f = k.f),
m{r + 1} AS MATERIALIZED (SELECT vec_id, y, m + {RATE}::DOUBLE * step AS m FROM m{r} JOIN q{r} USING (vec_id) JOIN w{r} USING (node))""")
    return ",\n".join(parts)


GROWTH = Growth(max_depth=2, min_child=CHILD, reg_lambda=LAMBDA, reg_alpha=ALPHA)


def vectors(spark, d):
    return tables.embedding_features(spark, d, WIDTH)


def node_rows(forest, spark):
    shown = ensembles.node_table(forest, spark).select("tree", "path", "feature", F.when(F.col("feature") >= 0, F.col("threshold")).alias("threshold"), "gain",
                                                       "rows", "cover", "value")
    return rounded(shown)


def boosted(spark, d, rounds=2):
    return ensembles.boost(vectors(spark, d), ALL, "Class", rounds=rounds, rate=RATE, growth=GROWTH, bins=BINS)


@query("boosted_nodes", f"WITH {boosting_sql(2)}\n" + " UNION ALL ".join(
    nodes_sql(r, [f"k{r}a", f"k{r}b"], f"n{r}b", SHIFT, STEP, "tc") for r in range(2)))
def boosted_nodes(spark, d):
    """Nodes of two second-order trees over all dimensions."""
    return node_rows(boosted(spark, d), spark)


@query("boosted_scores", f"WITH {boosting_sql(2)} SELECT vec_id, y AS label, round(1 / (1 + exp(-m)), 6) AS score FROM m2")
def boosted_scores(spark, d):
    from rarelens.plans.models import ModelSpec, score_model
    how = {"n_estimators": 2, "max_depth": 2, "learning_rate": RATE, "subsample": 1.0, "min_child": CHILD, "reg_alpha": ALPHA, "reg_lambda": LAMBDA, "bins": BINS}
    table = vectors(spark, d)
    return rounded(score_model(ModelSpec("gradient_boosting", how, ALL).fit(table), table, keep=["vec_id"]))


HELD = "vec_id % 4 = 0"
LOSS = "avg(ln(1 + exp(-abs(m))) + greatest(CASE WHEN y = 1 THEN -m ELSE m END, 0.0))"


@query("boosting_rounds", f"WITH {boosting_sql(4, f'NOT ({HELD})')},\nloss AS (" + " UNION ALL ".join(
    f"SELECT {r} AS round, {LOSS} AS loss FROM m{r + 1} WHERE {HELD}" for r in range(4)) + """),
back AS (SELECT a.round, a.loss, (SELECT b.round FROM loss b WHERE b.round <= a.round ORDER BY b.loss, b.round LIMIT 1) AS best FROM loss a),
ends AS (SELECT coalesce(min(round) FILTER (round - best >= 1), 3) AS last FROM back)
SELECT round::INTEGER AS round, round(loss, 6) AS logloss, round = (SELECT best FROM back, ends WHERE back.round = ends.last) AS best FROM back, ends WHERE round <= last""")
def boosting_rounds(spark, d):
    """Validation loss of every round until one brings nothing; a quarter of the rows is held out."""
    table = vectors(spark, d).withColumn("held", F.col("vec_id") % 4 == 0)
    forest = ensembles.boost(table, ALL, "Class", validation="held", rounds=4, rate=RATE, growth=GROWTH, bins=BINS, patience=1, metric="logloss")
    lines = [(r, v, r == len(forest.trees) - 1) for r, v in enumerate(forest.history)]
    return rounded(spark.createDataFrame(lines, "round int, logloss double, best boolean"))


CLASS_ROWS = f"""cw AS (SELECT count(*) / (2.0::DOUBLE * sum(y)) AS w1, count(*) / (2.0::DOUBLE * (count(*) - sum(y))) AS w0 FROM base),
r0 AS MATERIALIZED (SELECT vec_id, '' AS node, CASE WHEN y = 0 THEN round(w0 * 2.0::DOUBLE ** {SHIFT}) ELSE 0 END::HUGEINT AS a,
 CASE WHEN y = 1 THEN round(w1 * 2.0::DOUBLE ** {SHIFT}) ELSE 0 END::HUGEINT AS c FROM base, cw)"""
GINI = " + ".join(f"({a} * {a} + {c} * {c}) / ({a} + {c})" for a, c in (("la", "lc"), ("ra", "rc"))) + " - (ta * ta + tc * tc) / (ta + tc)"
SPLIT, LEAF = 40, 8
CLASS_FITS = f"tn >= {SPLIT} AND least(ln, tn - ln) >= {LEAF}"


@query("class_tree_nodes", f"""WITH {BINNED.replace('LEARNED', 'true')}, {CLASS_ROWS}, {level_sql('a', 'r0', 0, SHIFT, GINI, CLASS_FITS)},
{level_sql('b', 'na', 1, SHIFT, GINI, CLASS_FITS)}, {level_sql('c', 'nb', 2, SHIFT, GINI, CLASS_FITS)}
{nodes_sql(0, ['ka', 'kb', 'kc'], 'nc', SHIFT, 'tc / (ta + tc)', 'ta + tc')}""")
def class_tree_nodes(spark, d):
    """A class-weighted tree with a least size of nodes that may be split."""
    growth = Growth("gini", max_depth=3, min_split=SPLIT, min_leaf=LEAF, class_weight="balanced")
    return node_rows(ensembles.average(vectors(spark, d), ALL, "Class", growths=[growth], bins=BINS), spark)


def _leaves_sql(r: int) -> str:
    """(node, v, f1, b1, f2, b2, z1, z2) of tree r's leaves: features and bins of the turns, and the cover they let through."""
    cover = lambda path: f"(SELECT sum(c)::DOUBLE FROM n{r}b WHERE starts_with(node, {path}))"
    return f"""lf{r} AS (SELECT w.node, w.step * {RATE}::DOUBLE AS v, ka.f AS f1, ka.b AS b1, kb.f AS f2, kb.b AS b2,
 {cover("substr(w.node, 1, 1)")} / {cover("''")} AS z1, {cover("w.node")} / {cover("substr(w.node, 1, 1)")} AS z2
 FROM w{r} w LEFT JOIN k{r}a ka ON length(w.node) >= 1 LEFT JOIN k{r}b kb ON length(w.node) = 2 AND kb.node = substr(w.node, 1, 1)),
o{r} AS (SELECT x1.vec_id, lf.*, ((x1.b <= b1) = (substr(node, 1, 1) = 'L'))::INTEGER AS o1, ((x2.b <= b2) = (substr(node, 2, 1) = 'L'))::INTEGER AS o2
 FROM lf{r} lf JOIN bx x1 ON x1.f = f1 LEFT JOIN bx x2 ON x2.f = f2 AND x2.vec_id = x1.vec_id)"""


def _phi_sql(r: int) -> str:
    """What tree r's leaves add to the features of their paths, one or two of them."""
    return f"""SELECT vec_id, f1 AS f, v * (o1 - z1) AS phi FROM o{r} WHERE f2 IS NULL UNION ALL
SELECT vec_id, f1, v * (o1 * o2 - z1 * z2) FROM o{r} WHERE f1 = f2 UNION ALL
SELECT vec_id, f1, v * (o1 - z1) * (z2 + o2) / 2 FROM o{r} WHERE f1 <> f2 UNION ALL
SELECT vec_id, f2, v * (o2 - z2) * (z1 + o1) / 2 FROM o{r} WHERE f1 <> f2"""


@query("tree_attributions", f"""WITH {boosting_sql(2)}, {_leaves_sql(0)}, {_leaves_sql(1)},
phi AS (SELECT vec_id, f, sum(phi) AS phi FROM ({_phi_sql(0)} UNION ALL {_phi_sql(1)}) GROUP BY ALL),
base AS (SELECT (SELECT sum(v * CASE WHEN f1 IS NULL THEN 1 WHEN f2 IS NULL THEN z1 ELSE z1 * z2 END) FROM lf0)
              + (SELECT sum(v * CASE WHEN f1 IS NULL THEN 1 WHEN f2 IS NULL THEN z1 ELSE z1 * z2 END) FROM lf1) AS base)
SELECT bx.vec_id, 'e' || bx.f AS feature, round(bx.v, 6) AS value, round(coalesce(phi, 0.0), 6) AS phi, round(base, 6) AS base
FROM bx CROSS JOIN base LEFT JOIN phi ON phi.vec_id = bx.vec_id AND phi.f = bx.f""".replace("base AS (SELECT (SELECT", "mean AS (SELECT (SELECT").replace(
    "CROSS JOIN base", "CROSS JOIN mean"))
def tree_attribution_rows(spark, d):
    """Exact attributions of every row and dimension along the paths of two boosted trees."""
    return rounded(attributions.tree_attributions(vectors(spark, d), boosted(spark, d), ALL, key="vec_id"))


@query("tree_importance", f"""WITH {boosting_sql(1)}, {_leaves_sql(0)},
reach AS (SELECT node, avg(o1 * coalesce(o2, 1)) AS share FROM o0 GROUP BY node),
back AS (SELECT vec_id, l.node, l.v, f1, f2, o1, o2, l.b1, l.b2 FROM o0 l),
pairs AS (SELECT a.node, a.f1, a.f2, a.v, a.o1, a.o2, b.o1 AS p1, b.o2 AS p2, a.n * b.n::DOUBLE AS w FROM
 (SELECT node, v, f1, f2, o1, o2, count(*) AS n FROM back GROUP BY ALL) a JOIN
 (SELECT node, o1, o2, count(*) AS n FROM back GROUP BY ALL) b USING (node)),
-- one or two features per leaf: the order of two features is averaged
each AS (SELECT node, f1 AS f, o1, o2, sum(w * v * CASE WHEN f2 IS NULL THEN o1 - p1 WHEN f1 = f2 THEN o1 * o2 - p1 * p2 ELSE (o1 - p1) * (o2 + p2) / 2.0::DOUBLE END) AS s, any_value(f2) AS f2
 FROM pairs GROUP BY ALL UNION ALL
 SELECT node, f2, o1, o2, sum(w * v * (o2 - p2) * (o1 + p1) / 2.0::DOUBLE), NULL FROM pairs WHERE f1 <> f2 GROUP BY ALL),
tot AS (SELECT count(*)::DOUBLE AS n FROM base),
ph AS (SELECT b.vec_id, e.f, sum(e.s / (n * c.cnt)) AS phi FROM back b JOIN
 (SELECT node, o1, o2, count(*) AS cnt FROM back GROUP BY ALL) c ON c.node = b.node AND c.o1 = b.o1 AND c.o2 IS NOT DISTINCT FROM b.o2
 JOIN each e ON e.node = b.node AND e.o1 = b.o1 AND e.o2 IS NOT DISTINCT FROM b.o2, tot GROUP BY ALL)
SELECT 'e' || d.f AS feature, round(coalesce((SELECT sum(abs(phi)) FROM ph WHERE ph.f = d.f) / (SELECT n FROM tot), 0.0), 6) AS mean_abs FROM (SELECT DISTINCT f FROM bx) d""")
def tree_importance(spark, d):
    """Mean absolute attribution of each dimension against all rows as background."""
    table = vectors(spark, d)
    return rounded(explain.global_importance(attributions.tree_attributions(table, boosted(spark, d, 1), ALL, key="vec_id", background=table)))


@query("balanced_forest")
def balanced_forest(spark, d):
    """Forest with class weights of each tree's own draw: share of leaves and rows by tree (draws come from key digests)."""
    from dataclasses import replace
    growth = Growth("gini", max_depth=6, bootstrap=True, features="sqrt", min_split=10, class_weight="balanced_subsample")
    forest = ensembles.average(vectors(spark, d), ALL, "Class", growths=[replace(growth, seed=s) for s in range(10)], key="vec_id")
    nodes = ensembles.node_table(forest, spark)
    return rounded(nodes.groupBy("tree").agg(F.count(F.when(F.col("left") < 0, 1)).alias("leaves"), F.max("depth").alias("depth"),
                                             F.sum(F.when(F.col("left") < 0, F.col("rows"))).alias("rows"), F.max(F.when(F.col("node") == 0, F.col("value"))).alias("root_value")))


@query("bin_edges", f"WITH {BINNED.replace('LEARNED', 'true')} SELECT ('e' || f) AS feature, unnest(range(len(e))) AS edge, round(unnest(e), 6) AS value FROM ed")
def bin_edges(spark, d):
    edges = trees.quantile_edges(vectors(spark, d), ALL, BINS)
    lines = [(ALL[f], i, v) for f, e in enumerate(edges) for i, v in enumerate(e)]
    return rounded(spark.createDataFrame(lines, "feature string, edge long, value double"))


def _digamma_sql(x: str) -> str:
    up = f"({x} + 6.0::DOUBLE)"
    series = "".join(f" - {c!r}::DOUBLE / {up} ** {2 * i}" for i, c in enumerate((1 / 12, -1 / 120, 1 / 252, -1 / 240, 1 / 132), start=1))
    return f"(ln({up}) - 0.5::DOUBLE / {up}{series}" + "".join(f" - 1.0::DOUBLE / ({x} + {i})" for i in range(6)) + ")"


@query("mutual_information_neighbours", f"""WITH x AS (SELECT vec_id, label AS y, f - 1 AS f, embedding[f]::DOUBLE AS v FROM embeddings, range(1, {WIDTH + 1}) r(f)),
cl AS (SELECT label AS y, count(*) AS nc, sum(count(*)) OVER () AS n FROM embeddings GROUP BY 1),
nb AS (SELECT a.vec_id, a.f, a.v, a.y, list_sort(list(abs(b.v - a.v)))[least(3, any_value(nc) - 1)] AS r FROM x a JOIN cl USING (y) JOIN x b ON b.f = a.f AND b.y = a.y AND b.vec_id <> a.vec_id GROUP BY ALL),
m AS (SELECT nb.vec_id, nb.f, nb.y, count(*) AS m FROM nb JOIN x ON x.f = nb.f AND (abs(x.v - nb.v) < r OR x.v = nb.v) GROUP BY ALL)
SELECT 'e' || f AS feature, round(greatest(max({_digamma_sql("n::DOUBLE")}) + avg({_digamma_sql("least(3, nc - 1)::DOUBLE")}) - avg({_digamma_sql("nc::DOUBLE")}) - avg({_digamma_sql("m::DOUBLE")}), 0), 6) AS mutual_information
FROM m JOIN cl USING (y) GROUP BY f""")
def mutual_information_neighbours(spark, d):
    """Between each dimension of all vectors and their label, of ten values."""
    from rarelens.operators.information import neighbor_mutual_information
    emb = tables.sample_table(spark, d, "embeddings")
    rows = emb.select("label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(ALL)])
    return rounded(neighbor_mutual_information(rows, ALL, "label"))


#: Ninety candidates: two criteria, five depths, three sizes to split, three sizes of a leaf.
GRID = {"criterion": ["gini", "entropy"], "max_depth": [3, 5, 8, 12, None], "min_split": [2, 10, 50], "min_leaf": [1, 5, 20], "class_weight": ["balanced"]}


@query("full_grid_search")
def full_grid_search(spark, d):
    """Ninety trees by three folds over all dimensions, in shared scans."""
    from rarelens.plans.search import grid
    from rarelens.plans.shared_search import shared_search
    return rounded(shared_search(vectors(spark, d), ALL, "Class", ["vec_id"], grid(GRID), 3, "recall", BINS).table)


def _fold_sql(c: int, f: int, leaf: int) -> str:
    """CTEs of a balanced gini tree of depth 2 learned from the rows outside fold f, and its score of those inside."""
    n = f"{c}{f}"
    fits = f"least(ln, tn - ln) >= {leaf}"
    return f"""cw{n} AS (SELECT count(*) / (2.0::DOUBLE * sum(y)) AS w1, count(*) / (2.0::DOUBLE * (count(*) - sum(y))) AS w0 FROM base WHERE vec_id % 2 <> {f}),
r{n} AS MATERIALIZED (SELECT vec_id, '' AS node, CASE WHEN y = 0 THEN round(w0 * 2.0::DOUBLE ** {SHIFT}) ELSE 0 END::HUGEINT AS a,
 CASE WHEN y = 1 THEN round(w1 * 2.0::DOUBLE ** {SHIFT}) ELSE 0 END::HUGEINT AS c FROM base, cw{n} WHERE vec_id % 2 <> {f}),
{level_sql(f"{n}a", f"r{n}", 0, SHIFT, GINI, fits)}, {level_sql(f"{n}b", f"n{n}a", 1, SHIFT, GINI, fits)},
l{n} AS (SELECT node, sum(c)::DOUBLE / (sum(a) + sum(c))::DOUBLE AS v FROM n{n}b GROUP BY node),
p{n} AS (SELECT m.vec_id, m.y, CASE WHEN k.node IS NULL THEN '' WHEN bx.b <= k.b THEN 'L' ELSE 'R' END AS node
 FROM base m LEFT JOIN k{n}a k ON true LEFT JOIN bx ON bx.vec_id = m.vec_id AND bx.f = k.f WHERE m.vec_id % 2 = {f}),
q{n} AS (SELECT p.vec_id, p.y, CASE WHEN k.node IS NULL THEN p.node WHEN bx.b <= k.b THEN p.node || 'L' ELSE p.node || 'R' END AS node
 FROM p{n} p LEFT JOIN k{n}b k ON k.node = p.node LEFT JOIN bx ON bx.vec_id = p.vec_id AND bx.f = k.f)"""


LEAVES = (5, 40)


@query("grid_fold_scores", f"WITH {BINNED.replace('LEARNED', 'true')}, " + ", ".join(_fold_sql(c, f, leaf) for c, leaf in enumerate(LEAVES) for f in range(2)) + " "
       + " UNION ALL ".join(f"""SELECT {c} AS candidate, {f} AS fold, round((count(*) FILTER (y = 1 AND v > 0.5))::DOUBLE / count(*) FILTER (y = 1), 6) AS score
FROM q{c}{f} JOIN l{c}{f} USING (node)""" for c in range(2) for f in range(2)))
def grid_fold_scores(spark, d):
    """Recall of two candidates in each of two folds that are given by the key's parity."""
    from rarelens.plans.shared_search import shared_search
    rows = vectors(spark, d).withColumn("parity", F.col("vec_id") % 2)
    candidates = [{"max_depth": 2, "min_leaf": leaf, "class_weight": "balanced"} for leaf in LEAVES]
    return rounded(shared_search(rows, ALL, "Class", ["vec_id"], candidates, 2, "recall", BINS, fold_col="parity").folds)
