"""From the merged table to a saved, evaluated model, and batch scoring with it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..operators import features as fe
from ..operators import model as m
from ..operators.records import apply_profile, filter_lookback
from ..operators.scoring import prediction_band, top_factors
from ..operators.splits import stratified_split


def model_table(
    merged: DataFrame, profile: str | None = None, lookback_years: int = 2, ref_year: int | None = None,
    date_col: str | None = "auto",
) -> tuple[DataFrame, list[str], str]:
    """Recent rows with engineered and encoded features in the target range, the feature names, the target."""
    df = apply_profile(merged, profile) if profile and profile != "all" else merged
    df = filter_lookback(df, lookback_years, ref_year or date.today().year)
    if "location_state" in df.columns and "worksite_state" not in df.columns:
        df = df.withColumnRenamed("location_state", "worksite_state")
    df = fe.encode_features(fe.engineer_features(df, date_col=date_col))
    target = fe.target_column(df)
    return fe.filter_target(df, target), fe.feature_columns(df), target


def train_pipeline(
    merged: DataFrame,
    ids: list[str],
    save_to: str | None = None,
    stamp: str = "",
    params: dict | None = None,
    tune: bool = False,
    cv: bool = False,
    **selection,
) -> tuple[m.PayModel, dict]:
    """Split 70/15/15 within each year, fit, evaluate on the test rows, optionally tune, validate and save."""
    spark = merged.sparkSession
    df, features, target = model_table(merged, **selection)
    narrow = df.select(*dict.fromkeys([*ids, "year", target, *features]))
    parts = stratified_split(narrow, ids, "year", 0.15, 0.15, 42)
    train, val, test = (parts.where(F.col("split") == s) for s in ("train", "val", "test"))
    extra: dict = {}
    if tune:
        extra["tuning"] = m.tune(train, features, target, ids)
        params = {**(params or {}), **extra["tuning"]["best_params"]}
    model = m.train(train, features, target, val, params)
    if cv:
        extra["cv"] = m.cross_validate(parts.where(F.col("split") != "test"), features, target, ids, params=params)
    model.metrics["test"] = m.evaluate(model, test, target)
    if save_to:
        extra["path"] = m.save_model(spark, model, save_to, stamp)
        m.feature_importance(spark, model, 15).coalesce(1).write.mode("overwrite").option("header", True).csv(
            f"{save_to}/feature_importance"
        )
    return model, extra


def request_features(requests: DataFrame) -> DataFrame:
    """Scoring requests (job_title, location, experience_years, company, skills) to feature rows."""
    base = requests.select(
        F.struct(*requests.columns).alias("__req"),
        "job_title",
        F.col("company").alias("employer_name"),
        F.upper("location").alias("worksite_state"),
    )
    df = fe.encode_features(fe.engineer_features(base, date_col=None))
    df = df.withColumns(
        {
            "estimated_yoe": F.coalesce(F.col("__req.experience_years"), F.lit(rules.RESUME_DEFAULT_YEARS)),
            "state_clean_encoded": fe.encode_state(F.col("worksite_state")),
            "__skills": F.col("__req.skills"),
        }
    )
    return fe.apply_user_skills(df, "__skills")


def score_requests(model: m.PayModel, requests: DataFrame, confidence: float = 0.9) -> DataFrame:
    """Requests with predicted salary, band and top factors."""
    df = request_features(requests)
    scored = prediction_band(m.predict(model, df), model.rmse, confidence)
    asked = ("location", "company")
    flat = scored.withColumns({c: F.col(f"__req.{c}") for c in asked})
    out = top_factors(flat, model.importance)
    return out.select(
        "__req.*",
        *[F.floor(c).cast("bigint").alias(c) for c in ("predicted_salary", "salary_low", "salary_high")],
        "top_factors",
    )
