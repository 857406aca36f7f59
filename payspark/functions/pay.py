"""Pay, experience, date and score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .words import bind, blank

HOURS_PER_YEAR = 2080


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def annualize_wage(wage: Column, unit: Column | None = None, week_first: bool = False) -> Column:
    """Yearly pay from a wage and its unit text.

    Bi-weekly pay counts 26 periods.  ``week_first=True`` tests "week" before "bi-week", which pays
    bi-weekly wages 52 times.
    """
    w = to_double(wage)
    if unit is None:
        return w
    u = F.coalesce(F.lower(unit), F.lit(""))
    fortnight = u.contains("bi-week") | u.contains("biweek")
    periods = F.when(u.contains("hour"), HOURS_PER_YEAR)
    if week_first:
        periods = periods.when(u.contains("week"), 52).when(fortnight, 26)
    else:
        periods = periods.when(fortnight, 26).when(u.contains("week"), 52)
    return w * periods.when(u.contains("month"), 12).otherwise(1)


def parse_salary_text(text: Column) -> Column:
    """Yearly salary from free text such as "$150K - $200K", "$50/hr" or "$150,000/yr".

    The mean of all numbers is taken, "k" multiplies by a thousand, marked hourly pay is multiplied by 2080
    and so are bare values under 300 when the result is plausible (30k to 700k).
    """
    low = F.lower(text)
    hourly = low.contains("/hr") | low.contains("per hour") | low.contains("hourly")
    bare = F.regexp_replace(low, r"\$|,|/yr|/hr|per hour|hourly", "")
    number = r"(\d+(?:\.\d+)?)(k?)"
    values = F.transform(
        F.arrays_zip(
            F.regexp_extract_all(bare, F.lit(number), F.lit(1)).alias("n"),
            F.regexp_extract_all(bare, F.lit(number), F.lit(2)).alias("k"),
        ),
        lambda x: x["n"].cast("double") * F.when(x["k"] == "k", 1000.0).otherwise(1.0),
    )
    usable = ~(blank(low) | low.isin("not specified", "none"))

    def yearly(x):
        mean = F.try_divide(F.aggregate(x["v"], F.lit(0.0), lambda a, n: a + n), F.size(x["v"]))
        return bind(
            F.struct(mean.alias("m"), x["hourly"].alias("hourly")),
            lambda y: F.when(
                y["hourly"] | ((y["m"] < 300) & (y["m"] * HOURS_PER_YEAR).between(30000, 700000)),
                y["m"] * HOURS_PER_YEAR,
            ).otherwise(y["m"]),
        )

    return F.when(usable, bind(F.struct(values.alias("v"), hourly.alias("hourly")), yearly))


def parse_experience_years(text: Column) -> Column:
    """Years from "5+ years", "3-6 years" (floored midpoint) or the first bare number."""
    low = F.lower(text)
    plus, span, bare = r"(\d+)\+", r"(\d+)\s*-\s*(\d+)", r"(\d+)"

    def num(pattern, group):
        return F.regexp_extract(low, pattern, group).try_cast("int")

    years = (
        F.when(low.rlike(plus), num(plus, 1))
        .when(low.rlike(span), F.floor((num(span, 1) + num(span, 2)) / 2).cast("int"))
        .when(low.rlike(bare), num(bare, 1))
    )
    return F.when(~blank(text) & (text != rules.NOT_SPECIFIED), years)


def salary_mid(low: Column, high: Column) -> Column:
    """Mean of the bounds that are present."""
    return F.coalesce((low + high) / 2, low, high)


def parse_date(text: Column) -> Column:
    """Timestamp or null for unparsable text."""
    return F.try_to_timestamp(text.cast("string"))


def fill_year(c: Column, default: int = rules.DEFAULT_YEAR) -> Column:
    return F.coalesce(to_double(c).try_cast("int"), F.lit(default))


def quality_score(skills: Column, source_priority: Column, present: dict[str, Column]) -> Column:
    """Weighted presence score in [0, 1].

    ``skills`` is an array column; ``present`` maps the other weighted field names to columns.
    """
    w = rules.QUALITY_WEIGHTS
    total = F.when(F.size(skills) > 0, w["skills"]).otherwise(0.0)
    for name in ("estimated_yoe", "education", "seniority_level", "employer_name", "location_state"):
        if name in present:
            total = total + F.when(present[name].isNotNull(), w[name]).otherwise(0.0)
    share = F.when(
        source_priority < rules.UNKNOWN_PRIORITY, F.lit(w["source_priority"]) * (F.lit(1.0) / source_priority)
    ).otherwise(0.0)
    return F.least(total + share, F.lit(1.0))
