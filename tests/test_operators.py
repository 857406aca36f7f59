"""Operators against brute force and invariants."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from payspark import rules
from payspark.operators import features as fe
from payspark.operators import profile as p
from payspark.operators import ranking
from payspark.operators import records as r
from payspark.operators import scoring as s
from payspark.operators.splits import stratified_split, temporal_split


def values(n=3000):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        g = rng.choice(["hot", "hot", "hot", "a", "b"])
        v = rng.choice([50000.0, rng.uniform(-5, 5), rng.uniform(3e4, 3e5), float(rng.randrange(10)), 1e12])
        rows.append((i, g, v))
    return rows + [(n, "one", 5.0), (n + 1, None, 1.0), (n + 2, "a", None)]


def test_percentiles_match_pandas(spark):
    rows = values()
    df = spark.createDataFrame(rows, "i int, g string, v double")
    pct = {"p10": 0.1, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
    got = ranking.distribution(df, ["g"], F.col("v"), pct, ("mean", "std", "min", "max")).toPandas().set_index("g")
    want = pd.DataFrame(rows, columns=["i", "g", "v"]).dropna().groupby("g")["v"]
    assert set(got.index) == {"hot", "a", "b", "one"}
    for g, x in want:
        assert got.n[g] == len(x)
        for k, q in pct.items():
            assert got[k][g] == pytest.approx(x.quantile(q), rel=1e-12)
        assert got["mean"][g] == pytest.approx(x.mean())
        assert (got["min"][g], got["max"][g]) == (x.min(), x.max())
        if len(x) > 1:
            assert got["std"][g] == pytest.approx(x.std())
        else:
            assert pd.isna(got["std"][g])


def test_percentiles_global_and_empty(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert ranking.distribution(df, [], F.col("v"), {"q": 0.25}).first().q == 25.0
    assert ranking.distribution(df.where("v < 0"), [], F.col("v"), {"q": 0.25}).count() == 0


def test_bucket_is_monotone(spark):
    rng = random.Random(1)
    xs = sorted({rng.uniform(-1, 1) * 10 ** rng.randrange(-3, 12) for _ in range(5000)})
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    b = [row[0] for row in df.orderBy("i").select(ranking.bucket(F.col("x"))).collect()]
    assert b == sorted(b)


def test_iqr_and_report(spark):
    rows = [("s", "t", 100000.0 + i) for i in range(50)] + [("s", "t", 500000.0), ("s", None, 1e5), ("s", "t", 10.0)]
    rows += [("few", "t", 40000.0), ("few", "t", 599999.0)]
    df = spark.createDataFrame(rows, "data_source string, job_title string, annual_salary double")
    kept = r.filter_iqr(r.require_fields(df))
    assert kept.groupBy("data_source").count().collect().__len__() == 2
    assert kept.where("annual_salary = 500000").count() == 0
    assert kept.where("data_source = 'few'").count() == 2  # too few rows for fences
    rep = {x.data_source: x for x in r.validation_report(df).collect()}
    assert (rep["s"].total, rep["s"].missing_fields, rep["s"].out_of_range, rep["s"].outliers, rep["s"].valid) == (53, 1, 1, 1, 50)
    assert rep["s"].below_minimum


def test_dedup_is_idempotent_and_hot_key_safe(spark):
    rows = [("t", "e", "CA", 2024, 1e5, None, "h1b", 1, i / 1000) for i in range(1000)]
    rows += [(f"t{i}", None, None, 2024, 1e5, None, "h1b", 1, 0.5) for i in range(20)]
    names = "job_title string, employer_name string, location_state string, year int, annual_salary double, job_url string, data_source string, source_priority int, quality_score double"
    df = spark.createDataFrame(rows, names)
    once = r.dedup_by_quality(df)
    assert once.count() == 21
    assert once.where("job_title = 't'").first().quality_score == 0.999
    assert r.dedup_by_quality(once).exceptAll(once).count() == 0
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan  # rows are cut to one per key before the shuffle


def test_best_record(spark):
    rows = [
        (1, "u", "p", "c", "", "2025-01-02"), (2, "u", "p", "c", "$5", "2025-01-01"), (3, "v", "p", "c", "Not specified", "2025-01-01"),
        (4, "v", "p", "c", None, "2025-01-03"), (5, "", "p", "c", "$5", "2025-01-03"), (6, "w", None, "c", "$5", "2025-01-03"),
    ]
    df = spark.createDataFrame(rows, "line int, job_url string, position string, company string, salary string, collected_at string")
    df = df.withColumn("skills", F.lit(None).cast("array<string>"))
    out = r.dedup_best_record(r.clean_scrape_records(df), [F.col("line")])
    assert {(x.job_url, x.line) for x in out.collect()} == {("u", 2), ("v", 4)}


def test_profile_errors_and_standardise(spark):
    with pytest.raises(ValueError, match="Unknown training profile"):
        r.profile_sources("nope")
    df = spark.createDataFrame([(None, "soc", "5")], "job_title string, soc_title string, wage_from string")
    df = df.withColumns({"data_source": F.lit("h1b"), "source_priority": F.lit(1)})
    out = r.standardize_source(df, "h1b").first()
    assert out.job_title is None  # the first existing column wins even where it is null
    assert out.annual_salary == 5.0 and out.location_city is None


@pytest.mark.parametrize("strata", ["year", None])
def test_stratified_split_sizes(spark, strata):
    df = spark.range(1000).select("id", F.when(F.col("id") < 700, 2024).otherwise(2025).alias("year"))
    out = stratified_split(df, ["id"], strata)
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000
    sizes = {(x.year, x.split): x["count"] for x in out.groupBy("year", "split").count().collect()}
    if strata:
        assert [sizes[(2024, k)] for k in ("test", "val", "train")] == [105, 105, 490]
        assert [sizes[(2025, k)] for k in ("test", "val", "train")] == [45, 45, 210]
    again = stratified_split(df.repartition(7), ["id"], strata)
    assert again.exceptAll(out).count() == 0


def test_temporal_split(spark):
    df = spark.range(100).select("id", (F.lit(2020) + F.col("id") % 6).cast("int").alias("year"))
    out = temporal_split(df, ["id"])
    assert out.where("split = 'test'").where("year < 2024").count() == 0
    older = df.where("year < 2024").count()
    assert out.where("split = 'val'").count() == int(older * 0.15)
    assert temporal_split(df.drop("year"), ["id"]).where("split = 'test'").count() == 20
    assert temporal_split(df.where("year >= 2024"), ["id"]).where("split = 'test'").count() == df.where("year >= 2024").count()


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    xs = np.concatenate([rng.normal(1e5, 3e4, 5000), np.linspace(3e4, 3e5, 51)])
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = p.histogram(df, F.col("v"), 50).orderBy("bin").toPandas()
    counts, edges = np.histogram(xs, bins=50)
    assert list(got["count"]) == list(counts)
    assert np.allclose(got.lower, edges[:-1]) and np.allclose(got.upper, edges[1:])
    flat = p.histogram(spark.createDataFrame([(5.0,)] * 3, "v double"), F.col("v"), 30)
    assert flat.agg(F.sum("count")).first()[0] == 3


def test_cooccurrence_matches_loops(spark):
    rng = random.Random(2)
    words = ["a", "b", "c", "d", " B "]
    rows = [[rng.choice(words) for _ in range(rng.randrange(6))] for _ in range(200)] + [None, ["", "a"]]
    df = spark.createDataFrame([(x,) for x in rows], "skills array<string>")
    want: dict = {}
    for skills in rows:
        items = [x.lower().strip() for x in (skills or []) if x.strip()]
        for i, x in enumerate(items):
            for y in items[i:]:
                want[x, y] = want.get((x, y), 0) + 1
                if x != y:
                    want[y, x] = want.get((y, x), 0) + 1
    got = {(x.skill, x.other): x["count"] for x in p.skill_cooccurrence(df).collect()}
    assert got == want


def test_poly_trend_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 30, 500).astype(float)
    y = 50000 + 4000 * x - 50 * x * x + rng.normal(0, 1000, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "estimated_yoe double, annual_salary double")
    row = p.poly_trend(df).first()
    assert (row.a, row.b, row.c) == pytest.approx(tuple(np.polyfit(x, y, 2)), rel=1e-6)
    assert p.poly_trend(df.limit(5)).first().a is None


def test_engineer_features_keeps_given(spark):
    df = spark.createDataFrame(
        [("Senior Engineer", "Google", "ca", None, ["Spark SQL"]), ("x", None, None, 9, None)],
        "job_title string, employer_name string, worksite_state string, estimated_yoe int, skills array<string>",
    )
    a, b = fe.engineer_features(df).collect()
    assert (a.estimated_yoe, a.company_tier, a.state_clean, a.skill_big_data, a.skill_data_engineering, a.skill_count) == (5, "faang", "CA", 1, 1, 2)
    assert (b.estimated_yoe, b.company_tier, b.skill_count) == (9, "unknown", 0)
    strict = fe.engineer_features(df, given_years_only=True).first()
    assert strict.estimated_yoe is None
    titled = fe.engineer_features(df.drop("skills").withColumn("job_title", F.lit("NLP Engineer"))).first()
    assert titled.skill_nlp == 1
    dated = df.withColumns({"received_date": F.lit("soon"), "created_date": F.lit("2024-11-05")})
    out = fe.engineer_features(dated).first()
    assert (out.year, out.quarter, out.month, out.is_peak_hiring) == (2024, 4, 11, 1)
    cols = fe.feature_columns(fe.encode_features(fe.engineer_features(dated)))
    assert cols[-2:] == ["company_tier_encoded", "state_clean_encoded"] and len(cols) == len(set(cols))


def test_band_and_curve(spark):
    df = spark.createDataFrame([(100000.0,)], "prediction double")
    row = s.prediction_band(df, 50000.0).first()
    assert (row.salary_low, row.salary_high) == (30000.0, 182250.0)
    assert s.prediction_band(df, 10000.0, 0.95).first().salary_low == 80400.0
    curve = s.density_curve(spark.createDataFrame([(1e5, 1.45e5, 1.9e5)], "lo double, mid double, hi double"), "lo", "mid", "hi")
    rows = curve.orderBy("point").collect()
    assert len(rows) == 100 and rows[0].salary == pytest.approx(1e5 - 90000 / 3.29)
    assert not rows[0].in_range and rows[50].in_range


FACTOR_WEIGHTS = {"skill_nlp": 0.3, "estimated_yoe": 0.02, "is_senior": 0.2, "state_clean_encoded": 0.03, "skill_mlops": 0.1, "company_tier_encoded": 0.05}
# skill_nlp, estimated_yoe, is_senior, state_clean_encoded, skill_mlops, company_tier_encoded; place, company, title; worked out by hand
FACTOR_CASES = [
    ((1, 10, 1, 1, 1, 1), ("OH", "Acme", "Senior Dev"), ["Skill: Nlp", "Experience", "Seniority", "Skill: Mlops"]),
    ((0, 10, 0, 1, 0, 1), ("OH", "Acme", "Dev"), ["Experience", "Company", "Location", "Seniority"]),
    ((0, 0, 0, 0, 0, 1), ("OH", "", "Team Lead"), []),
    ((0, 0, 0, 0, 0, 0), ("CA", None, "Dev"), ["Location", "Seniority"]),
    ((1, 20, 1, 0, 1, 1), ("NY", "Acme", "Senior Dev"), ["Experience", "Skill: Nlp", "Seniority", "Location"]),
]


def test_top_factors(spark):
    names = [*FACTOR_WEIGHTS, "location", "company", "job_title", "index"]
    df = spark.createDataFrame([(*f, *p, i) for i, (f, p, _) in enumerate(FACTOR_CASES)], names)
    got = s.top_factors(df, FACTOR_WEIGHTS).orderBy("index").collect()
    assert [[f.name for f in row.top_factors] for row in got] == [want for _, _, want in FACTOR_CASES]


def test_top_factors_keep_their_limits_without_a_fold(spark):
    weights = {"skill_nlp": 0.5, "skill_mlops": 0.4, "skill_deep_learning": 0.3, "is_staff": 0.2, "is_senior": 0.1, "estimated_yoe": 0.01, "other": 9.0}
    df = spark.createDataFrame([(1, 1, 1, 1, 1, 3, 1, "TX", "", "x"), (-1, 0, 1, -1, 1, None, 1, None, None, None)], [*weights, "location", "company", "job_title"])
    out = s.top_factors(df, weights)
    names = [[f.name for f in row.top_factors] for row in out.collect()]
    assert names == [["Skill: Nlp", "Skill: Mlops", "Seniority", "Location"], ["Skill: Deep Learning", "Seniority"]]
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_user_skills(spark):
    df = spark.createDataFrame([(0, 0, [" NLP "]), (0, 1, ["deep learning with torch"]), (1, 0, None)], "skill_nlp int, skill_deep_learning int, s array<string>")
    assert [tuple(x[:2]) for x in fe.apply_user_skills(df, "s").collect()] == [(1, 0), (0, 1), (1, 0)]


def test_rank_importance(spark):
    df = spark.createDataFrame([("estimated_yoe", 0.5), ("skill_deep_learning", 0.25), ("year", 0.0)], "feature string, importance double")
    rows = s.rank_importance(df, 2).collect()
    assert [(x.display_name, x.importance_pct) for x in rows] == [("Years of Experience", 50.0), ("Skill: Deep Learning", 25.0)]
    assert rows[0].share == pytest.approx(2 / 3)


def test_distribution_offsets_near_values_and_gaps(spark):
    rows = [("far", 1e9 + i % 2) for i in range(1000)] + [("near", i * 1e-9) for i in range(1000)]
    rows += [("nan", float("nan")), ("nan", 1.0), ("nan", 2.0), (None, 5.0), (None, 7.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = ranking.distribution(df, ["g"], F.col("v"), {"median": 0.5, "q9": 0.9}, ("mean", "std", "min", "max"), null_group=True)
    got = {r.g: r for r in out.collect()}
    assert got["far"].std == pytest.approx(np.std([0, 1] * 500, ddof=1), rel=1e-9) and got["far"].median == 1e9 + 0.5
    assert got["near"].q9 == pytest.approx(np.quantile([i * 1e-9 for i in range(1000)], 0.9), abs=1e-18)
    assert (got["nan"].n, got["nan"].median) == (2, 1.5)
    assert (got[None].n, got[None].median) == (2, 6.0)


def test_percentile_reports_move_small_groups_once_and_large_ones_as_counts(spark):
    rows = values() + [(i, "near", 7.0 + i * 1e-9) for i in range(500)] + [(i, "nan", float("nan")) for i in range(3)]
    df = spark.createDataFrame(rows, "i int, g string, v double")
    want = pd.DataFrame(rows, columns=["i", "g", "v"])
    want = pd.concat([want.assign(report="by_g"), want.assign(report="overall", g="all")]).dropna().groupby(["report", "g"])["v"]
    for most in (0, 100, 10**6):  # all groups large, some, none
        out = p.percentile_reports(df, {"by_g": F.col("g"), "overall": F.lit("all")}, F.col("v"), {"q1": 0.25, "median": 0.5, "p99": 0.99}, most)
        got = {(r.report, r.group_value): r for r in out.collect()}
        assert set(got) == {k for k, _ in want} and out.columns == ["report", "group_value", "n", "mean", "q1", "median", "p99"]
        for k, x in want:
            assert got[k].n == len(x) and got[k]["mean"] == pytest.approx(x.mean())
            assert [got[k].q1, got[k].median, got[k].p99] == pytest.approx([x.quantile(q) for q in (0.25, 0.5, 0.99)], rel=1e-14)


def test_building_a_distribution_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    ranking.distribution(spark.range(100).selectExpr("id % 3 AS g", "id AS v"), ["g"], F.col("v"), {"median": 0.5}, ("std",))
    assert not tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setJobGroup("other", "other")


def test_labels_unseen_are_unknown(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    codes = fe.label_codes(df, "c")
    got = fe.encode_labels(spark.createDataFrame([("a",), ("z",), (None,), ("b",)], "c string"), codes, "c").collect()
    assert {r.c: r.c_encoded for r in got} == {"a": 0.0, "b": 1.0, None: 2.0, "z": 2.0}


def test_few_label_codes_move_no_rows(spark):
    """Rows that share a label are not brought together: the join with the codes sends the codes."""
    df = spark.range(2_000_000).select("id", F.when(F.col("id") % 3 > 0, "a").alias("c"))
    out = fe.encode_labels(df, fe.label_codes(df, "c"), "c")
    assert sorted(r.n for r in out.groupBy("c_encoded").agg(F.count("*").alias("n")).collect()) == [666_667, 1_333_333]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(__label" not in plan
