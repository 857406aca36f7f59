"""Location, title and description text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .words import alternation, blank, first_label, has_any, lookup, strip, whole_words


def state_from_city(location: Column) -> Column:
    """Two-letter state after the last comma of "City, ST"."""
    parts = F.split(location, ",")
    last = strip(F.element_at(parts, -1))
    return F.when((F.size(parts) >= 2) & (F.length(last) == 2), F.upper(last))


def state_from_area(area: Column, substring: bool = False) -> Column:
    """State code of the first listed name in the area text, "Other" when none, "Unknown" for null.

    Names match as whole words; ``substring=True`` matches anywhere, so "Chicago" hits "ca".
    """
    low = F.lower(area)
    out = F.when(area.isNull(), F.lit("Unknown"))
    for name, code in rules.AREA_STATES:
        hit = low.contains(name) if substring else low.rlike(rf"\b{name}\b")
        out = out.when(hit, F.lit(code))
    return out.otherwise(F.lit("Other"))


def seniority_label(title: Column) -> Column:
    return first_label(title, rules.SENIORITY_LABELS, "Mid-level", "Unknown")


def is_remote(title: Column, location: Column) -> Column:
    return has_any(title, ("remote",)) | has_any(location, ("remote",))


def clean_state(state: Column) -> Column:
    """Upper-case, trim, and shorten the full names that have a code."""
    s = strip(F.upper(state))
    return F.coalesce(lookup(s, rules.STATE_NAMES), s)


def similarity_levenshtein(a: Column, b: Column) -> Column:
    """Case-insensitive 1 - edit distance / longer length, 0 for nulls; JVM-side."""
    x, y = F.lower(a), F.lower(b)
    longest = F.greatest(F.length(x), F.length(y))
    score = F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(x, y) / longest)
    return F.coalesce(score, F.lit(0.0))


def description_skills(text: Column) -> Column:
    """Listed skills found as whole words, in list order; "c++" needs no word after it."""
    low, none = F.lower(text), F.array().cast("array<string>")
    found = [whole_words(low, [s for s in rules.DESCRIPTION_SKILLS if not s.endswith("+")])]
    for skill in rules.DESCRIPTION_SKILLS:
        if skill.endswith("+"):  # the plain test spares most texts the regex
            held = low.contains(skill) & low.rlike(rf"\b{alternation([skill])}")
            found.append(F.when(held, F.array(F.lit(skill))).otherwise(none))
    listed = F.array_intersect(F.array(*map(F.lit, rules.DESCRIPTION_SKILLS)), F.concat(*found))
    return F.when(blank(text), none).otherwise(listed)


def experience_phrase(text: Column) -> Column:
    """"a-b years" or "a+ years" from a description, else "Not specified"."""
    unit = r"\s*(?:years?|yrs?)"
    span = rf"(?i)(\d+)\+?\s*(?:to|-)\s*(\d+){unit}"
    singles = (rf"(?i)(\d+)\+{unit}", rf"(?i)minimum\s+(?:of\s+)?(\d+){unit}", rf"(?i)at least\s+(\d+){unit}")
    out = F.when(
        text.rlike(span),
        F.concat(F.regexp_extract(text, span, 1), F.lit("-"), F.regexp_extract(text, span, 2), F.lit(" years")),
    )
    for p in singles:
        out = out.when(text.rlike(p), F.concat(F.regexp_extract(text, p, 1), F.lit("+ years")))
    return out.otherwise(F.lit(rules.NOT_SPECIFIED))


def education_level(text: Column) -> Column:
    return first_label(text, rules.EDUCATION_LEVELS, rules.NOT_SPECIFIED, rules.NOT_SPECIFIED)


def applicant_count(text: Column) -> Column:
    """N of "over N" / "N applicant", the upper end of "a-b", else 0."""
    named, span = r"(?i)over\s+(\d+)|(\d+)\s+applicant", r"(\d+)\s*-\s*(\d+)"

    def num(p, g):
        return F.regexp_extract(text, p, g).try_cast("int")

    return F.coalesce(
        F.when(text.rlike(named), F.coalesce(num(named, 1), num(named, 2))).when(text.rlike(span), num(span, 2)),
        F.lit(0),
    )


def ai_title(title: Column) -> Column:
    return has_any(title, rules.AI_TITLE_PATTERNS)


def relevant_title(title: Column) -> Column:
    """At least one include keyword and no exclude keyword."""
    return has_any(title, rules.INCLUDE_KEYWORDS) & ~has_any(title, rules.EXCLUDE_KEYWORDS)


def html_payload(content: Column) -> Column:
    """True when the first 100 bytes announce an HTML page."""
    raw = content.cast("binary")
    head = F.lower(F.substring(raw, 1, 100).cast("string"))
    return F.coalesce(head.contains("<!doctype html") | head.contains("<html"), F.lit(False))
