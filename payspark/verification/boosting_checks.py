"""Checks of the boosted trees: the same fit written out in SQL, tree by tree and level by level."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boosting as b
from ..operators.ordering import contiguous_parts, with_positions
from ..operators.scoring import rank_importance
from ..session import work_path, written_once
from .bridge import PAID, check, paid
from .record_checks import LINE, LINE_SQL, in_order
from .text_checks import K, KEYS

#: Feature, as Spark and DuckDB both read it.
INPUTS = {
    "year": "CAST(year AS DOUBLE)",
    "line": "CAST(k2 AS DOUBLE)",
    "experience": "coalesce(CAST(estimated_yoe AS DOUBLE), 0.0)",
    "senior": "CASE WHEN lower(job_title) LIKE '%senior%' THEN 1.0 ELSE 0.0 END",
    "west": "CASE WHEN trim(upper(location_state)) IN ('CA', 'WA') THEN 1.0 ELSE 0.0 END",
    "unit": "CASE wage_unit WHEN 'Hour' THEN 1.0 WHEN 'Week' THEN 2.0 WHEN 'Month' THEN 3.0 ELSE 0.0 END",
}
NAMES = list(INPUTS)
WHOLE = b.Boosting(trees=3, depth=2, rate=0.3, rows=1.0, columns=1.0, bins=16)


def inputs(spark, sf):
    cols = [F.expr(sql).alias(name) for name, sql in INPUTS.items()]
    return paid(spark, sf).select(*KEYS, "wage_from", *cols, (F.col("annual_salary") / 1000).alias("pay"))


INPUT_SQL = PAID + f""", m AS (SELECT {K}, wage_from, annual_salary / 1000 AS y, [{', '.join(INPUTS.values())}] AS x FROM paid)"""


def _worth(g: str, h: str, p: b.Boosting) -> str:
    return f"(CASE WHEN abs({g}) > {p.l1} THEN (abs({g}) - {p.l1}) * (abs({g}) - {p.l1}) ELSE 0 END / ({h} + {p.l2}))"


def fit_sql(rows: str, p: b.Boosting, tag: str, cuts: str) -> str:
    """CTEs of a fit on ``rows`` (x, y and the keys), which ends in ``{tag}_m{trees}``: the rows with their margin m, and ``{tag}_nodes``."""
    parts = [f"""{tag}_start AS MATERIALIZED (SELECT avg(y) AS base, sum((y - a) * (y - a)) AS squares FROM {rows}, (SELECT avg(y) AS a FROM {rows})),
    {tag}_m0 AS MATERIALIZED (SELECT r.*, base AS m FROM {rows} r, {tag}_start)"""]
    nodes = []
    for t in range(p.trees):
        at = f"{tag}_{t}"
        parts.append(f"{at}_n0 AS MATERIALIZED (SELECT *, 0 AS node FROM {tag}_m{t})")
        for d in range(p.depth):
            parts.append(f"""{at}_s{d} AS MATERIALIZED (SELECT node, f, cut, sum(m - y) FILTER (x[f] < cut) AS gl, count(*) FILTER (x[f] < cut) AS hl, sum(m - y) AS g,
      count(*) AS h FROM {at}_n{d}, {cuts} GROUP BY node, f, cut),
    {at}_g{d} AS (SELECT *, ({_worth('gl', 'hl', p)} + {_worth('(g - gl)', '(h - hl)', p)} - {_worth('g', 'h', p)}) / 2 AS gain
      FROM {at}_s{d} WHERE hl >= {p.min_weight} AND h - hl >= {p.min_weight} AND node >= {2**d - 1}),
    {at}_b{d} AS MATERIALIZED (SELECT node, f, cut, gain FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain / squares, {b.GAIN_DIGITS}) DESC, f, cut) AS nth
      FROM {at}_g{d}, {tag}_start WHERE gain > {p.min_gain}) WHERE nth = 1),
    {at}_n{d + 1} AS MATERIALIZED (SELECT n.* REPLACE (CASE WHEN f IS NULL THEN n.node WHEN x[f] < cut THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node)
      FROM {at}_n{d} n LEFT JOIN {at}_b{d} b ON b.node = n.node)""")
            nodes.append(f"SELECT {t} AS tree, node, f, cut, NULL::DOUBLE AS value FROM {at}_b{d}")
        parts.append(f"""{at}_l AS MATERIALIZED (SELECT node, -sign(sum(m - y)) * greatest(abs(sum(m - y)) - {p.l1}, 0) / (count(*) + {p.l2}) AS value
      FROM {at}_n{p.depth} GROUP BY node),
    {tag}_m{t + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (node) REPLACE (m + {p.rate} * value AS m) FROM {at}_n{p.depth} n JOIN {at}_l USING (node))""")
        nodes.append(f"SELECT {t} AS tree, node, NULL, NULL, value FROM {at}_l")
    parts.append(f"{tag}_nodes AS (" + " UNION ALL ".join(nodes) + ")")
    return ",\n    ".join(parts)


def cuts_sql(rows: str, bins: int, name: str = "cuts") -> str:
    steps = ", ".join(f"{k}/{bins}::DOUBLE" for k in range(1, bins))
    each = " UNION ALL ".join(
        f"SELECT {i} AS f, unnest(list_distinct(quantile_disc(x[{i}], [{steps}]))) AS cut, (SELECT min(x[{i}]) FROM {rows}) AS least FROM {rows}"
        for i in range(1, len(INPUTS) + 1)
    )
    return f"{name} AS MATERIALIZED (SELECT f, cut FROM ({each}) WHERE cut > least)"


FITTED = f"{INPUT_SQL}, {cuts_sql('m', WHOLE.bins)}, {fit_sql('m', WHOLE, 'w', 'cuts')}"
NAME_SQL = f"([{', '.join(repr(n) for n in NAMES)}])[f]"


def whole_model(spark, sf, rows=None):
    return b.fit(b.binned(inputs(spark, sf) if rows is None else rows, NAMES, "pay", bins=WHOLE.bins), WHOLE)


@check(
    "boosted_tree_nodes",
    FITTED + f" SELECT tree, node, CASE WHEN f IS NOT NULL THEN {NAME_SQL} END AS feature, cut, round(value, 6) AS value FROM w_nodes",
)
def _(spark, sf):
    value = F.when(F.col("feature").isNull(), F.round("value", 6))
    return whole_model(spark, sf).table(spark).select("tree", "node", "feature", "cut", value.alias("value"))


@check("gbt_scores", FITTED + f" SELECT {K}, round(m, 6) AS prediction FROM w_m{WHOLE.trees}")
def _(spark, sf):
    rows = written_once(inputs(spark, sf), "inputs")  # fitted and scored
    return b.predict(whole_model(spark, sf, rows), rows, KEYS).withColumn("prediction", F.round("prediction", 6))


@check("saved_model_scores", FITTED + f" SELECT {K}, round(m, 6) AS prediction FROM w_m{WHOLE.trees}")
def _(spark, sf):
    root = work_path(spark, "models")
    rows = written_once(inputs(spark, sf), "inputs")  # fitted and scored
    b.save(spark, whole_model(spark, sf, rows), root, "20250101_000000")
    return b.saved_scores(rows, root, keep=KEYS).withColumn("prediction", F.round("prediction", 6))


GAIN_SQL = " UNION ALL ".join(f"SELECT f, gain FROM w_{t}_b{d}" for t in range(WHOLE.trees) for d in range(WHOLE.depth))


@check(
    "boosted_importance",
    FITTED + f""", gains AS ({GAIN_SQL}), every AS (SELECT unnest(range(1, {len(NAMES) + 1})) AS f),
    means AS (SELECT f, coalesce(avg(gain), 0) AS gain FROM every LEFT JOIN gains USING (f) GROUP BY f),
    shares AS (SELECT f, gain / sum(gain) OVER () AS v FROM means)
    SELECT {NAME_SQL} AS feature, upper(left({NAME_SQL}, 1)) || substr({NAME_SQL}, 2) AS display_name, round(v, 4) AS importance,
      round(v * 100, 2) AS importance_pct, round(v, 6) AS share FROM shares""",
)
def _(spark, sf):
    weights = spark.createDataFrame(list(whole_model(spark, sf).importance.items()), "feature string, importance double")
    return rank_importance(weights).withColumn("share", F.round("share", 6))


FOLD_SQL = f"SELECT *, row_number() OVER (ORDER BY {LINE_SQL}) - 1 AS spot, count(*) OVER () AS n FROM m"


def _fold_sql(folds: int) -> str:
    more, small = f"(n % {folds})", f"(n // {folds})"
    return f"""placed AS ({FOLD_SQL}), folded AS MATERIALIZED (SELECT *, CASE WHEN spot < {more} * ({small} + 1) THEN spot // ({small} + 1)
      ELSE {more} + (spot - {more} * ({small} + 1)) // {small} END AS fold FROM placed)"""


METRICS = """count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
      round(1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6) AS r2"""


@check(
    "contiguous_fold_scores",
    INPUT_SQL + f""", {_fold_sql(5)} SELECT fold::INT AS fold, min(spot) AS first, max(spot) AS last, {METRICS}
    FROM (SELECT *, y * 0.9 + x[2] AS p FROM folded) GROUP BY fold""",
)
def _(spark, sf):
    fixed = inputs(spark, sf).withColumn("p", F.col("pay") * 0.9 + F.col("line"))
    placed = with_positions(fixed, in_order(*LINE), "at")
    folded = contiguous_parts(placed, 5, placed.count(), "at", "fold")
    bounds = folded.groupBy("fold").agg((F.min("at") - 1).alias("first"), (F.max("at") - 1).alias("last"))
    scores = b.fold_scores(folded, "fold", "pay", "p").select("fold", "n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])
    return bounds.join(scores, "fold")


SMALL = b.Boosting(trees=2, depth=1, rate=0.5, rows=1.0, columns=1.0, bins=16)


def _held_sql(folds: int, p: b.Boosting, tag: str) -> tuple[str, str]:
    """CTEs that fit on all folds but each and score it, and the rows (fold, y, p) they end in."""
    parts, out = [], []
    for k in range(folds):
        at = f"{tag}{k}"
        parts.append(f"{at}_rows AS MATERIALIZED (SELECT {K}, x, y FROM folded WHERE fold <> {k})")
        parts.append(fit_sql(f"{at}_rows", p, at, "cuts"))
        value = f"(SELECT base FROM {at}_start)"
        for t in range(p.trees):
            leaf = f"SELECT value FROM {at}_{t}_l WHERE node = "
            b0 = f"{at}_{t}_b0"
            value += f" + {p.rate} * CASE WHEN x[(SELECT f FROM {b0})] < (SELECT cut FROM {b0}) THEN ({leaf}1) ELSE ({leaf}2) END"
        out.append(f"SELECT {k} AS fold, y, {value} AS p FROM folded WHERE fold = {k}")
    return ",\n    ".join(parts), " UNION ALL ".join(out)


def _validated_sql() -> str:
    parts, rows = _held_sql(3, SMALL, "h")
    return INPUT_SQL + f", {cuts_sql('m', SMALL.bins)}, {_fold_sql(3)}, {parts} SELECT fold::INT AS fold, {METRICS} FROM ({rows}) GROUP BY fold"


@check("cross_validated_trees", _validated_sql())
def _(spark, sf):
    scores = b.cross_validate(inputs(spark, sf), NAMES, "pay", in_order(*LINE), 3, SMALL)
    return scores.select("fold", "n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


GRID = [{"rate": 0.1, "l2": 1.0}, {"rate": 0.5, "l2": 1.0}, {"rate": 0.5, "l2": 1000.0}]


def _tuned_sql() -> str:
    parts, rows = [], []
    for i, choice in enumerate(GRID):
        fit, held = _held_sql(2, b.replace(SMALL, **choice), f"g{i}_")
        parts.append(fit)
        name = ", ".join(f"{k}={v}" for k, v in choice.items())
        rows.append(f"SELECT {i} AS choice, '{name}' AS params, avg(e) AS mae FROM (SELECT fold, avg(abs(y - p)) AS e FROM ({held}) GROUP BY fold)")
    return INPUT_SQL + f""", {cuts_sql('m', SMALL.bins)}, {_fold_sql(2)}, {', '.join(parts)}, means AS ({' UNION ALL '.join(rows)})
    SELECT choice, params, round(mae, 6) AS mae, choice = (SELECT arg_min(choice, (mae, choice)) FROM means) AS best FROM means"""


@check("tuned_trees", _tuned_sql())
def _(spark, sf):
    return b.tune(inputs(spark, sf), NAMES, "pay", in_order(*LINE), GRID, 2, SMALL).withColumn("mae", F.round("mae", 6))
