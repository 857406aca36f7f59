"""Descriptive reports over posting tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.words import flag, hits, strip
from ..session import written_once
from .broadcasts import one_row
from .features import skills_text
from .ranking import GROUP_ROWS, distribution, distribution_of_counts, distribution_of_groups

SALARY = "annual_salary"
EDA_LOW, EDA_HIGH = 30000.0, 1000000.0
QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def valid_salaries(df: DataFrame, low: float, high: float, column: str = SALARY) -> DataFrame:
    return df.where(F.col(column).between(low, high))


# --- salary summaries -----------------------------------------------------------------------------------


def salary_summary(df: DataFrame, column: str = SALARY) -> DataFrame:
    """One row over salaries in [50k, 1M]."""
    pct = {"percentile_25": 0.25, "median": 0.5, "percentile_75": 0.75, "percentile_90": 0.9}
    d = distribution(valid_salaries(df, 50000.0, 1e6, column), [], F.col(column), pct, ("mean", "std", "min", "max"))
    return d.select(
        F.col("n").alias("count"), "mean", "median", "std", "min", "max",
        "percentile_25", "percentile_75", "percentile_90",
    )


def merge_summary(df: DataFrame) -> DataFrame:
    """One row: sizes, distinct counts and salary statistics of the merged table."""
    sizes = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("employer_name").alias("unique_employers"),
        F.countDistinct("job_title").alias("unique_titles"),
    )
    d = distribution(df, [], F.col(SALARY), {"median": 0.5}, ("mean", "std", "min", "max"))
    stats = ("mean", "median", "std", "min", "max")
    row = sizes.withColumn("__s", one_row(d))
    return row.select(*sizes.columns, *[F.col(f"__s.{c}").alias(f"salary_{c}") for c in stats])


def salary_by_role(df: DataFrame, role: str = "search_query") -> DataFrame:
    """Per role: salary_avg statistics over values above 30k and the mean bounds, rounded half to even."""
    valid = df.where(F.col("salary_avg") > 30000)
    d = distribution(valid, [role], F.col("salary_avg"), {"median": 0.5}, ("mean", "std", "min", "max"))
    bounds = valid.groupBy(role).agg(F.avg("salary_min").alias("lo"), F.avg("salary_max").alias("hi"))
    stats = d.join(bounds, role)
    cols = {f"salary_avg_{c}": F.bround(c, 0) for c in ("mean", "median", "std", "min", "max")}
    cols |= {"salary_avg_count": F.col("n"), "salary_min_mean": F.bround("lo", 0), "salary_max_mean": F.bround("hi", 0)}
    return stats.select(role, *[v.alias(k) for k, v in cols.items()])


def group_medians(
    df: DataFrame, by: str, min_rows: int, top: int | None = None, moments: tuple[str, ...] = (),
    low: float = EDA_LOW, high: float = EDA_HIGH,
) -> DataFrame:
    """Count, median (and moments) per group with at least ``min_rows`` rows, best median first."""
    d = distribution(valid_salaries(df, low, high), [by], F.col(SALARY), {"median": 0.5}, moments)
    d = d.where(F.col("n") >= min_rows).select(by, F.col("n").alias("count"), "median", *moments)
    return d if top is None else d.orderBy(F.desc("median"), F.asc(by)).limit(top)


def salary_by_state(df: DataFrame, min_rows: int = 10, top: int | None = 15, state: str = "location_state"):
    return group_medians(df, state, min_rows, top, ("mean", "std"))


def state_tiers(df: DataFrame, state: str = "location_state", min_rows: int = 20, top: int = 15) -> DataFrame:
    """Best states with the top-quartile threshold of their medians and a comparison with the overall median."""
    states = group_medians(df, state, min_rows, top)
    cut = states.agg(F.percentile("median", F.lit(0.75)).alias("cut"))  # at most ``top`` rows
    overall = distribution(valid_salaries(df, EDA_LOW, EDA_HIGH), [], F.col(SALARY), {"median": 0.5})
    return states.withColumns(
        {"tier1_threshold": cut.scalar(), "overall_median": overall.select("median").scalar()}
    ).withColumns(
        {
            "tier1": F.col("median") >= F.col("tier1_threshold"),
            "above_overall": F.col("median") > F.col("overall_median"),
        }
    )


def salary_by_tier(df: DataFrame, tier: str = "company_tier") -> DataFrame:
    return group_medians(df, tier, 10)


def salary_by_wage_level(df: DataFrame, level: str = "wage_level") -> DataFrame:
    return group_medians(df, level, 10).orderBy(level)


def salary_by_title(df: DataFrame, min_rows: int = 20, top: int = 15, normalise: bool = False) -> DataFrame:
    """Best-paid titles; ``normalise`` lower-cases and trims titles first."""
    if normalise:
        df = df.withColumn("job_title", strip(F.lower("job_title")))
    return group_medians(df, "job_title", min_rows, top, ("mean",))


def salary_by_seniority(df: DataFrame, level: str = "seniority_level", min_rows: int = 10) -> DataFrame:
    """Box-plot numbers per level: quartiles and the extreme values inside the 1.5 IQR fences."""
    valid = valid_salaries(df, EDA_LOW, EDA_HIGH)
    boxes = distribution(valid, [level], F.col(SALARY), QUARTILES).where(F.col("n") >= min_rows)
    spread = (F.col("q75") - F.col("q25")) * 1.5
    whiskers = (
        valid.select(level, SALARY)
        .join(boxes, level)
        .where(F.col(SALARY).between(F.col("q25") - spread, F.col("q75") + spread))
        .groupBy(level)
        .agg(F.min(SALARY).alias("whisker_low"), F.max(SALARY).alias("whisker_high"))
    )
    return boxes.join(whiskers, level).select(
        level, F.col("n").alias("count"), "q25", "median", "q75", "whisker_low", "whisker_high"
    )


# --- table shape ----------------------------------------------------------------------------------------


def _melt(row: DataFrame, names: dict[str, str], key: str, value: str) -> DataFrame:
    """One-row frame to (key, value) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias("k"), F.col(c).alias("v")) for c, n in names.items()])
    return row.select(F.explode(pairs).alias("p")).select(F.col("p.k").alias(key), F.col("p.v").alias(value))


def present(df: DataFrame, column: str) -> Column:
    """The column's value, NaN as null."""
    c = F.col(column)
    return F.when(~F.isnan(c), c) if dict(df.dtypes).get(column) in ("float", "double") else c


def missing_counts(df: DataFrame) -> DataFrame:
    """Per column: rows, missing rows (null or NaN) and missing percent; one pass over the table."""
    names = {f"m{i}": c for i, c in enumerate(df.columns)}
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(present(df, c).isNull()).alias(k) for k, c in names.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(k).alias("v")) for k, c in names.items()])
    return row.select("rows", F.explode(pairs).alias("p")).select(
        F.col("p.k").alias("column_name"),
        "rows",
        F.col("p.v").alias("missing"),
        F.when(F.col("rows") > 0, F.col("p.v") * 100.0 / F.col("rows")).alias("missing_pct"),
    )


def table_profile(df: DataFrame, column: str = SALARY) -> DataFrame:
    """One row: rows, columns and the statistics of the present salaries."""
    d = distribution(df, [], F.col(column), QUARTILES, ("mean", "std", "min", "max"))
    sizes = df.agg(F.count(F.lit(1)).alias("records")).withColumn("columns", F.lit(len(df.columns)))
    stats = ("mean", "median", "std", "min", "max", "q25", "q75")
    row = sizes.withColumn("__s", one_row(d))
    return row.select(
        "records", "columns", F.col("__s.n").alias("salary_count"),
        *[F.col(f"__s.{c}").alias(f"salary_{c}") for c in stats],
    )


def missing_status(df: DataFrame, fields=("annual_salary", "job_title")) -> DataFrame:
    """Good / Fair / Poor label per critical column."""
    pct = F.col("missing_pct")
    label = F.when(pct < 5, "Good").when(pct < 20, "Fair").otherwise("Poor")
    return missing_counts(df.select(*fields)).select("column_name", "missing_pct", label.alias("status"))


def missing_report(df: DataFrame, top: int = 10) -> DataFrame:
    """Columns with missing values, most missing first."""
    return (
        missing_counts(df)
        .where(F.col("missing") > 0)
        .select("column_name", "missing", F.bround("missing_pct", 2).alias("percentage"))
        .orderBy(F.desc("missing"), "column_name")
        .limit(top)
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double")]


def numeric_describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max of every numeric column, exact."""
    cols = columns or numeric_columns(df)
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in cols])
    long = df.select(F.explode(pairs).alias("p")).select(F.col("p.k").alias("column_name"), F.col("p.v").alias("v"))
    d = distribution(long, ["column_name"], F.col("v"), QUARTILES, ("mean", "std", "min", "max"))
    return d.select("column_name", F.col("n").alias("count"), "mean", "std", "min", "q25", "median", "q75", "max")


def type_counts(df: DataFrame) -> DataFrame:
    """Number of columns per type (schema only)."""
    rows: dict[str, int] = {}
    for _, t in df.dtypes:
        rows[t] = rows.get(t, 0) + 1
    return df.sparkSession.createDataFrame(sorted(rows.items()), "dtype string, columns int")


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("data_source").agg(F.count(F.lit(1)).alias("records"))


def quality_by_source(df: DataFrame) -> DataFrame:
    """Mean, median and std of the quality score per source and overall (source "all")."""
    wide = df.select(F.explode(F.array("data_source", F.lit("all"))).alias("data_source"), "quality_score")
    d = distribution(wide, ["data_source"], F.col("quality_score"), {"median": 0.5}, ("mean", "std"))
    return d.select("data_source", F.col("n").alias("records"), "mean", "median", "std")


def title_cardinality(df: DataFrame) -> DataFrame:
    row = df.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("job_title").alias("unique_titles"))
    ratio = F.when(F.col("records") > 0, F.col("unique_titles") / F.col("records")).otherwise(0.0)
    return row.withColumn("ratio", ratio).withColumn("high_cardinality", F.col("ratio") > 0.5)


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Most common non-null values, ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), column).limit(n)


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width bins between min and max: bin, lower and upper edge, count (empty bins included); nulls and NaN count nowhere."""
    spark = df.sparkSession
    x = df.select(value.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    edges = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    same = F.col("lo") == F.col("hi")
    edges = edges.select(
        F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    ends = one_row(edges)
    step = (F.col("hi") - F.col("lo")) / bins

    def edge(i):
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * step)

    guess = F.least(F.floor((F.col("x") - F.col("lo")) / step), F.lit(bins - 1))
    # settle values that rounding put on the wrong side of an edge
    settled = (
        F.when(F.col("x") < edge(guess), guess - 1)
        .when((F.col("x") >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    counts = x.withColumn("__e", ends).select("x", "__e.lo", "__e.hi").groupBy(settled.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"), ends.alias("__e")).select(
        "bin", "__e.lo", "__e.hi"
    )
    return grid.join(F.broadcast(counts), "bin", "left").select(  # at most ``bins`` rows
        "bin",
        edge(F.col("bin")).alias("lower"),
        edge(F.col("bin") + 1).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def histogram_lines(df: DataFrame, value: Column) -> DataFrame:
    """The lines drawn into a histogram, in one row: mean and median of the present values."""
    return distribution(df, [], value, {"median": 0.5}, ("mean",)).select("mean", "median")


def outlier_report(df: DataFrame, low: float = EDA_LOW, high: float = EDA_HIGH, column: str = SALARY) -> DataFrame:
    """Quartiles, 1.5 IQR fences and the number and share of values outside them; one ranked pass."""
    valid = valid_salaries(df, low, high, column)
    d = distribution(valid, [], F.col(column), {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * 1.5
    d = d.withColumns({"lower_bound": F.col("q1") - spread, "upper_bound": F.col("q3") + spread})
    x = F.col(column)
    fences = one_row(d)
    outside = valid.agg(F.count_if((x < fences["lower_bound"]) | (x > fences["upper_bound"])).alias("outliers"))
    return d.withColumn("outliers", outside.scalar()).withColumn("outlier_pct", F.col("outliers") * 100.0 / F.col("n"))


def percentile_table(df: DataFrame, low: float = EDA_LOW, high: float = EDA_HIGH, column: str = SALARY) -> DataFrame:
    pct = {f"P{p}": p / 100 for p in (10, 25, 50, 75, 90, 95, 99)}
    d = distribution(valid_salaries(df, low, high, column), [], F.col(column), pct)
    return _melt(d, {k: k for k in pct}, "percentile", "value")


# --- skills -----------------------------------------------------------------------------------------------


def category_text(df: DataFrame) -> Column:
    """Lower-case skills and title as one text; the line break keeps a keyword from spanning both."""
    title = F.lower("job_title")
    return F.concat_ws("\n", skills_text(F.col("skills")), title) if "skills" in df.columns else title


def category_flags(text: Column) -> dict[str, Column]:
    """Per category: the skills match, else the title does."""
    return {name: flag(hits(text, words)) for name, words in rules.SKILL_CATEGORIES.items()}


def skill_category_coverage(df: DataFrame) -> DataFrame:
    """Rows, share and median salary per skill category, and whether that beats the overall median.

    The postings are read once: equal (categories, salary) cells are counted map side and written, and all figures come from the cells.
    """
    flags = category_flags(F.col("__text"))
    named = F.array_compact(F.array(*[F.when(v == 1, F.lit(k)) for k, v in flags.items()]))
    rows = df.select(F.col(SALARY).cast("double").alias(SALARY), category_text(df).alias("__text"))
    cells = written_once(rows.select(SALARY, named.alias("__names")).groupBy(SALARY, "__names").agg(F.count(F.lit(1)).alias("__c")), "coverage")
    counts = cells.agg(
        F.sum("__c").alias("__rows"),
        *[F.sum(F.when(F.array_contains("__names", k), F.col("__c")).otherwise(0)).alias(k) for k in flags],
    )
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in flags])
    coverage = counts.select("__rows", F.explode(pairs).alias("p")).select(
        F.col("p.k").alias("category"),
        F.col("p.v").alias("jobs"),
        F.when(F.col("__rows") > 0, F.col("p.v") * 100.0 / F.col("__rows")).alias("coverage_pct"),
    )
    # the overall median, over all salaries, is the group without a name
    paid = cells.where(F.col(SALARY).isNotNull() & ~F.isnan(SALARY))
    member = valid_salaries(paid, EDA_LOW, EDA_HIGH).select(F.explode("__names").alias("category"), SALARY, "__c")
    long = paid.select(F.lit("").alias("category"), SALARY, "__c").unionByName(member)
    ranked = distribution_of_counts(
        long.groupBy("category", SALARY).agg(F.sum("__c").alias("__c")), ["category"], SALARY, "__c", {"median_salary": 0.5}
    ).select("category", "median_salary")
    overall = ranked.where("category = ''").select("median_salary").scalar()
    return (
        coverage.join(ranked, "category", "left")
        .withColumn("overall_median", overall)
        .withColumn("above_overall", F.col("median_salary") > F.col("overall_median"))
    )


def category_overlap(df: DataFrame) -> DataFrame:
    """Rows by number of matched skill categories."""
    total = sum((v for v in category_flags(F.col("__text")).values()), F.lit(0))
    return df.select(category_text(df).alias("__text")).groupBy(total.alias("categories")).agg(F.count(F.lit(1)).alias("jobs"))


def skill_items(skills: Column) -> Column:
    """Lower-case trimmed non-empty items, repeats kept."""
    items = F.transform(skills, lambda s: strip(F.lower(s)))
    return F.filter(items, lambda s: s != "")


def skill_frequency(df: DataFrame, top: int = 30) -> DataFrame:
    """Most common skills with their median salary (0 without valid salaries)."""
    long = df.select(F.explode(skill_items(F.col("skills"))).alias("skill"), SALARY)
    common = top_values(long, "skill", top)
    paid = valid_salaries(long, EDA_LOW, EDA_HIGH).join(F.broadcast(common.select("skill")), "skill", "left_semi")
    medians = distribution(paid, ["skill"], F.col(SALARY), {"median_salary": 0.5}).drop("n")
    return common.join(medians, "skill", "left").select(
        "skill", "count", F.coalesce("median_salary", F.lit(0.0)).alias("median_salary")
    )


def best_paid_skills(df: DataFrame, min_rows: int = 10, top: int = 20) -> DataFrame:
    long = valid_salaries(df, EDA_LOW, EDA_HIGH).select(
        F.explode(skill_items(F.col("skills"))).alias("skill"), SALARY
    )
    d = distribution(long, ["skill"], F.col(SALARY), {"median_salary": 0.5}).where(F.col("n") >= min_rows)
    return d.select("skill", "n", "median_salary").orderBy(F.desc("median_salary"), "skill").limit(top)


def skill_cooccurrence(df: DataFrame, top: int = 20) -> DataFrame:
    """Symmetric co-occurrence counts of the top skills and their share of the row total.

    Per posting only the copies of each top skill are counted, so a posting yields at most top*(top+1)/2
    cells however long its skills list is; cells are summed map side.
    """
    items = df.select(skill_items(F.col("skills")).alias("items"))
    common = top_values(items.select(F.explode("items").alias("skill")), "skill", top)
    names = common.agg(F.sort_array(F.collect_list("skill"))).scalar()  # at most ``top`` names
    counted = items.where(F.size("items") > 0).select("items", names.alias("top")).select(
        F.filter(
            F.transform(
                F.col("top"),
                lambda s: F.struct(s.alias("s"), F.size(F.filter(F.col("items"), lambda x: x == s)).alias("c")),
            ),
            lambda t: t["c"] > 0,
        ).alias("t")
    )
    cells = F.flatten(
        F.transform(
            F.col("t"),
            lambda a: F.transform(
                F.filter(F.col("t"), lambda b: b["s"] >= a["s"]),
                lambda b: F.struct(
                    a["s"].alias("a"),
                    b["s"].alias("b"),
                    F.when(a["s"] == b["s"], a["c"].cast("bigint") * (a["c"] + 1) / 2)
                    .otherwise(a["c"].cast("bigint") * b["c"])
                    .cast("bigint")
                    .alias("n"),
                ),
            ),
        )
    )
    half = (
        counted.select(F.explode(cells).alias("p"))
        .groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b"))
        .agg(F.sum("p.n").alias("n"))
    )
    # at most top*(top+1)/2 rows from here on
    both = half.select(
        F.explode(
            F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
                F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
            )
        ).alias("k"),
        "n",
    )
    total = F.sum("n").over(Window.partitionBy("skill"))
    return both.select(F.col("k.a").alias("skill"), F.col("k.b").alias("other"), "n").select(
        "skill", "other", F.col("n").alias("count"), (F.col("n") * 100.0 / total).alias("row_pct")
    )


def percentile_reports(
    df: DataFrame, groups: dict[str, Column], value: Column, percentiles: dict[str, float] = QUARTILES, most: int = GROUP_ROWS
) -> DataFrame:
    """All grouped percentile reports at once, in long form: report, group_value, n, mean and the percentiles.

    The group columns and values are written once; each reading expands a row into a cell per report, and ``distribution_of_groups`` moves the cells
    of small groups once and those of large groups as counts.  A null group is left out of its report; a null or NaN value out of all.
    """
    v, named = value.cast("double"), {f"g{i}": name for i, name in enumerate(groups)}
    kept = df.select(v.alias("v"), *[group.cast("string").alias(c) for c, group in zip(named, groups.values())])
    rows = written_once(kept.where(F.col("v").isNotNull() & ~F.isnan("v")), "cells")
    cells = F.array(*[F.struct(F.lit(name).alias("report"), F.col(c).alias("group_value")) for c, name in named.items()])
    long = rows.select("v", F.explode(cells).alias("c")).select("c.report", "c.group_value", "v").where(F.col("group_value").isNotNull())
    return distribution_of_groups(long, ["report", "group_value"], "v", percentiles, most, "cells")


# --- relations between numeric columns ---------------------------------------------------------------------


def correlation_with(df: DataFrame, target: str = SALARY, columns: list[str] | None = None, top: int = 20):
    """Pearson correlation of each numeric column with the target over the rows that have both, best first; one pass."""
    cols = columns or numeric_columns(df)
    names = {f"c{i}": c for i, c in enumerate(cols)}
    row = df.agg(*[F.corr(present(df, c).cast("double"), present(df, target).cast("double")).alias(k) for k, c in names.items()])
    return _melt(row, names, "column_name", "correlation").orderBy(
        F.desc_nulls_last("correlation"), "column_name"
    ).limit(top)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """All pairwise correlations in long form; one pass."""
    cols = [(a, a) for a in columns] + list(combinations(columns, 2))
    row = df.agg(*[F.corr(present(df, a).cast("double"), present(df, b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(cols)])
    cells = []
    for i, (a, b) in enumerate(cols):
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"c{i}").alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("p")).select(
        F.col("p.a").alias("column_name"), F.col("p.b").alias("other"), F.col("p.r").alias("correlation")
    )


def poly_trend(df: DataFrame, x: str = "estimated_yoe", y: str = SALARY, min_rows: int = 10) -> DataFrame:
    """Least-squares a*x^2 + b*x + c in one row, null coefficients without more than ``min_rows`` rows.

    x is centred on its mean before the power sums are taken, which keeps the 3x3 solution stable.
    """
    pts = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    mean = pts.agg(F.avg("x")).scalar()
    pts = pts.withColumn("m", mean).withColumn("u", F.col("x") - F.col("m"))
    u, v = F.col("u"), F.col("y")
    s = pts.agg(
        F.count(F.lit(1)).alias("n"), F.max("m").alias("m"),
        *[F.avg(F.pow(u, F.lit(k))).alias(f"s{k}") for k in (1, 2, 3, 4)],
        *[F.avg(F.pow(u, F.lit(k)) * v).alias(f"t{k}") for k in (0, 1, 2)],
    )
    s1, s2, s3, s4, t0, t1, t2, m = (F.col(c) for c in ("s1", "s2", "s3", "s4", "t0", "t1", "t2", "m"))
    det = s4 * (s2 - s1 * s1) - s3 * (s3 - s1 * s2) + s2 * (s3 * s1 - s2 * s2)
    a = t2 * (s2 - s1 * s1) - s3 * (t1 - s1 * t0) + s2 * (t1 * s1 - s2 * t0)
    b = s4 * (t1 - s1 * t0) - t2 * (s3 - s1 * s2) + s2 * (s3 * t0 - t1 * s2)
    c = s4 * (s2 * t0 - t1 * s1) - s3 * (s3 * t0 - t1 * s2) + t2 * (s3 * s1 - s2 * s2)
    ok = (F.col("n") > min_rows) & (det != 0)
    qa, qb, qc = (F.when(ok, F.try_divide(k, det)) for k in (a, b, c))
    return s.select(
        "n",
        qa.alias("a"),
        (qb - 2 * qa * m).alias("b"),
        (qc - qb * m + qa * m * m).alias("c"),
    )


def feature_availability(tables: dict[str, DataFrame], features=rules.KEY_FEATURES) -> DataFrame:
    """Non-null percent of each key feature per table in long form; null where the column is absent."""
    parts = []
    for name, df in tables.items():
        have = [f for f in features if f in df.columns]
        row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(f).alias(f) for f in have])
        cells = F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    (F.col(f) * 100.0 / F.nullif(F.col("__n"), F.lit(0)) if f in have else F.lit(None).cast("double"))
                    .alias("completeness"),
                )
                for f in features
            ]
        )
        parts.append(row.select(F.lit(name).alias("source"), F.explode(cells).alias("p")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("source", F.col("p.feature").alias("feature"), F.col("p.completeness").alias("completeness"))


def availability_matrix(long: DataFrame, sources: list[str]) -> DataFrame:
    """One row per feature with "12.3%" or "N/A" per source."""
    label = F.coalesce(F.concat(F.format_number("completeness", 1), F.lit("%")), F.lit("N/A"))
    return long.withColumn("cell", label).groupBy("feature").pivot("source", sources).agg(F.first("cell"))
