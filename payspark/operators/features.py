"""Feature engineering for the pay model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.words import first_label, flag, has_any, hits, lookup, strip
from ..session import written_once

SKILL_FLAGS = [f"skill_{c}" for c in rules.SKILL_CATEGORIES]


SKILL_WORDS = {f"skill_{c}": words for c, words in rules.SKILL_CATEGORIES.items()}


def word_flags(text: Column, table: dict, lower: bool = False) -> dict[str, Column]:
    """0/1 per entry of a word table; ``lower`` says the text is a lower-case column."""
    test = hits if lower else has_any
    return {name: flag(test(text, words)) for name, words in table.items()}


def skill_flags(text: Column) -> dict[str, Column]:
    """0/1 per skill category from a text column."""
    return word_flags(text, SKILL_WORDS)


def skills_text(skills: Column) -> Column:
    """Lower-case items of a skills array joined by spaces; null for null."""
    return F.lower(F.array_join(skills, " "))


def skill_flags_from_array(skills: Column) -> dict[str, Column]:
    return word_flags(skills_text(skills), SKILL_WORDS)


def title_flags(title: Column) -> dict[str, Column]:
    return word_flags(title, rules.TITLE_FLAGS)


def title_years(flags: dict[str, Column]) -> Column:
    """Years of experience suggested by the title flags."""
    out = F
    for names, years in rules.TITLE_YEARS:
        out = out.when(reduce(lambda a, b: a | b, [flags[n] == 1 for n in names]), years)
    return out.otherwise(rules.DEFAULT_TITLE_YEARS)


def role_flags(title: Column) -> dict[str, Column]:
    return word_flags(title, rules.ROLE_FLAGS)


def company_tier(company: Column, lower: bool = False) -> Column:
    """Tier of the first word list that names the company."""
    return first_label(company, rules.COMPANY_TIERS.items(), "other", "unknown", lower)


def state_code(state: Column) -> Column:
    return F.substring(strip(F.upper(state)), 1, 2)


def location_features(state: Column) -> dict[str, Column]:
    """Cost multiplier and hub flags of a cleaned state code."""

    def member(codes):
        return flag(F.coalesce(state.isin(*codes), F.lit(False)))

    return {
        "col_multiplier": lookup(state, rules.LOCATION_MULTIPLIERS, 1.0),
        "is_major_tech_hub": member(rules.MAJOR_HUBS),
        "is_secondary_hub": member(rules.SECONDARY_HUBS),
        "is_remote_friendly": member(rules.REMOTE_FRIENDLY),
    }


def encode_state(state: Column) -> Column:
    codes = {s: i for i, s in enumerate(rules.STATE_CODES)}
    return lookup(F.upper(state), codes, len(codes))


def encode_tier(tier: Column) -> Column:
    codes = {t: i for i, t in enumerate(rules.TIER_CODES)}
    return lookup(tier, codes, codes["unknown"])


def time_features(date: Column) -> dict[str, Column]:
    quarter = F.quarter(date)
    return {
        "year": F.year(date),
        "quarter": quarter,
        "month": F.month(date),
        "is_peak_hiring": flag(quarter.isin(1, 4)),
    }


def first_dated_column(df: DataFrame, candidates=rules.DATE_COLUMNS) -> str | None:
    """First candidate column that holds a valid date; each look stops at the first hit."""
    for name in candidates:
        if name in df.columns:
            parsed = F.try_to_timestamp(F.col(name).cast("string"))
            if not df.where(parsed.isNotNull()).select(name).isEmpty():
                return name
    return None


def engineer_features(
    df: DataFrame,
    title_col: str = "job_title",
    company_col: str = "employer_name",
    state_col: str = "worksite_state",
    date_col: str | None = "auto",
    given_years_only: bool = False,
) -> DataFrame:
    """Append every model feature to ``df``.

    Columns already present win over derived ones.  A given ``estimated_yoe`` is filled from the title where
    null unless ``given_years_only``.  Skill flags come from the ``skills`` array when that column exists,
    else from the title.  ``date_col="auto"`` looks for the first date column with a valid value.
    """
    have = set(df.columns)
    if date_col == "auto":
        date_col = first_dated_column(df)

    # lower-case texts first: the many keyword tests below then share one copy of each
    title, skill_text = F.col("__title"), F.col("__skill_text")
    texts: dict[str, Column] = {}
    new: dict[str, Column] = {}
    if title_col in have:
        texts["__title"] = F.lower(title_col)
        new.update(word_flags(title, rules.TITLE_FLAGS, lower=True))
        new.update(word_flags(title, rules.ROLE_FLAGS, lower=True))
    if "skills" in have:
        is_array = dict(df.dtypes)["skills"].startswith("array")
        texts["__skill_text"] = skills_text(F.col("skills")) if is_array else F.lit(None).cast("string")
        new.update(word_flags(skill_text, SKILL_WORDS, lower=True))
    elif title_col in have:
        new.update(word_flags(title, SKILL_WORDS, lower=True))
    if company_col in have:
        texts["__company"] = F.lower(company_col)
        new["company_tier"] = company_tier(F.col("__company"), lower=True)
    if state_col in have:
        new["state_clean"] = state_code(F.col(state_col))

    # first level: everything read straight from the input columns
    dated = time_features(F.try_to_timestamp(F.col(date_col).cast("string"))) if date_col else {}
    keep = [c for c in df.columns if c not in dated]
    level1 = {k: v for k, v in new.items() if k not in have}
    df = df.withColumns(texts).select(
        *keep, *[v.alias(k) for k, v in level1.items()], *[v.alias(k) for k, v in dated.items()]
    )

    # second level: reads the flags of the first, so each keyword scan runs once
    level2: dict[str, Column] = {}
    if title_col in have:
        derived = title_years({n: F.col(n) for n in rules.TITLE_FLAGS})
        if "estimated_yoe" not in have:
            level2["estimated_yoe"] = derived
        elif not given_years_only:
            level2["estimated_yoe"] = F.coalesce(F.col("estimated_yoe"), derived)
    if state_col in have:
        level2.update(location_features(F.col("state_clean")))
    if SKILL_FLAGS[0] in df.columns:
        level2["skill_count"] = reduce(lambda a, b: a + b, [F.col(c) for c in SKILL_FLAGS])
    return df.withColumns(level2)


def encode_features(df: DataFrame) -> DataFrame:
    """Fixed integer codes for tier and state."""
    out = {}
    if "company_tier" in df.columns:
        out["company_tier_encoded"] = encode_tier(F.col("company_tier"))
    if "state_clean" in df.columns:
        out["state_clean_encoded"] = encode_state(F.col("state_clean"))
    return df.withColumns(out)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """``label``, ``code``: alphabetical numbers of the distinct labels of ``column``, null counting as "unknown".

    Labels are numbered inside groups of equal first letters and the groups follow one another, so that no window holds all
    labels and none of them comes to the driver.
    """
    labels = df.select(_label(column).alias("label")).distinct().withColumn("__head", F.substring("label", 1, 2))
    before = Window.orderBy("__head").rowsBetween(Window.unboundedPreceding, -1)
    heads = labels.groupBy("__head").agg(F.count(F.lit(1)).alias("__n"))
    heads = heads.select("__head", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__head").orderBy("label"))
    return labels.join(heads, "__head").select("label", (F.col("__start") + inside - 1).cast("double").alias("code"))


def encode_labels(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """``df`` with ``<column>_encoded``; a label that ``codes`` does not hold gets the code of "unknown", or -1 without one.

    The codes are written first, so that the planner knows their size: few of them are sent to the rows, which then need no shuffle by
    label and stay where they are however many share one.
    """
    codes = written_once(codes, "label-codes")
    unknown = codes.where(F.col("label") == "unknown").select("code").scalar()
    met = df.withColumn("__label", _label(column)).join(codes.withColumnRenamed("label", "__label"), "__label", "left")
    return met.select(*df.columns, F.coalesce("code", unknown, F.lit(-1.0)).alias(f"{column}_encoded"))


def _label(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("unknown"))


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs present in ``df``, in a fixed order and without repeats."""
    cols = df.columns
    wanted = [c for c in cols if c.startswith("skill_")]
    wanted += [*rules.TITLE_FLAGS, "estimated_yoe"]
    wanted += [c for c in cols if c.startswith("role_")]
    wanted += ["col_multiplier", "is_major_tech_hub", "is_secondary_hub", "is_remote_friendly", "skill_count"]
    wanted += ["year", "quarter", "is_peak_hiring"]
    wanted += [c for c in cols if c.endswith("_encoded")]
    return [c for c in dict.fromkeys(wanted) if c in cols]


def target_column(df: DataFrame) -> str | None:
    return next((c for c in rules.TARGET_COLUMNS if c in df.columns), None)


def filter_target(df: DataFrame, target: str, low: float = rules.TARGET_MIN, high: float = rules.TARGET_MAX):
    return df.where(F.col(target).between(low, high))


def numeric_matrix(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Columns as doubles, unparsable or missing values as 0, each name once."""
    names = [c for c in dict.fromkeys(columns) if c in df.columns]
    return df.select(*(keep or []), *[_number(df, c).alias(c) for c in names])


def align_features(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Exactly the training columns: absent ones are 0, extra ones are dropped."""
    return df.select(
        *(keep or []),
        *[(_number(df, c) if c in df.columns else F.lit(0.0)).alias(c) for c in dict.fromkeys(columns)],
    )


def _number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    c = F.col(name)
    c = c.try_cast("double") if kind in ("string", "boolean") else c.cast("double")
    return F.coalesce(c, F.lit(0.0))


def apply_user_skills(df: DataFrame, skills_col: str) -> DataFrame:
    """Set a skill flag to 1 where a given skill contains the category name or the name contains the skill."""
    low = F.transform(F.col(skills_col), lambda s: strip(F.lower(s)))
    updates = {}
    for c in [c for c in df.columns if c.startswith("skill_")]:
        name = F.lit(c.removeprefix("skill_").replace("_", " "))
        hit = F.exists(low, lambda s: F.contains(s, name) | F.contains(name, s))
        updates[c] = F.when(F.coalesce(hit, F.lit(False)), 1).otherwise(F.col(c))
    return df.withColumns(updates)
