"""Free-text resume parsing, one projection per text row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from .words import SPACE, alternation, bind, hits, strip, whole_words

ASCII_SPACE = r"[\t-\r\x1c-\x20]+"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def clean_text(text: Column) -> Column:
    """Whitespace runs collapsed to one space, ends trimmed; null becomes empty.

    A text of as many bytes as characters holds white space of ASCII only, which a plain class finds in half the time.
    """
    given = F.coalesce(text, F.lit(""))
    plain = F.length(given) == F.octet_length(given)
    return F.trim(F.when(plain, F.regexp_replace(given, ASCII_SPACE, " ")).otherwise(F.regexp_replace(given, SPACE, " ")))


def text_lines(text: Column) -> Column:
    """Trimmed non-blank lines."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), LINE_BREAK), strip)
    return F.filter(parts, lambda x: x != "")


def summary_text(lower: Column) -> Column:
    return F.substring(lower, 1, rules.SUMMARY_WINDOW)


def listed_words(patterns) -> list[str]:
    """The literal words of patterns such as ``\\b(one|two words)\\b``."""
    bare = (p.removeprefix(r"\b").removesuffix(r"\b").removeprefix("(").removesuffix(")") for p in patterns)
    return [w for p in bare for w in p.split("|")]


def needed_words(pattern: str) -> list[list[str]]:
    """The steps of a pattern such as ``\\b(one|two words)\\s+three\\b``: of each, one of its words stands whole in every match."""
    steps = pattern.removeprefix(r"\b").removesuffix(r"\b").split(r"\s+")
    return [step.removeprefix("(").removesuffix(")").replace(r"\.?", "").split("|") for step in steps]


def word_bits(words) -> dict[str, int]:
    """A bit for each of at most 62 different words."""
    return {w: 1 << i for i, w in enumerate(dict.fromkeys(words))}


def found_bits(found: Column, bits: dict[str, int]) -> Column:
    """The bits of an array of found words in one long; words without a bit count for nothing, null stays null."""
    of = F.create_map(*[x for w, bit in bits.items() for x in (F.lit(w), F.lit(bit).cast("bigint"))])
    none = F.lit(0).cast("bigint")
    return F.aggregate(found, none, lambda seen, w: seen.bitwiseOR(F.coalesce(F.try_element_at(of, w), none)))


def has_bits(seen: Column, steps: list[int]) -> Column:
    """True when ``seen`` has a bit of every step; the steps of one word are tested together."""
    single = reduce(lambda a, b: a | b, [s for s in steps if s.bit_count() == 1], 0)
    tests = [seen.bitwiseAND(single) == single] if single else []
    return reduce(lambda a, b: a & b, tests + [seen.bitwiseAND(s) != 0 for s in steps if s.bit_count() > 1])


def title_words() -> list[str]:
    """The words that the title patterns are made of."""
    return [w for pattern, _ in rules.TITLE_PATTERNS for step in needed_words(pattern) for w in step]


def title_scores(lower: Column) -> Column:
    """Array of (score, order, title) for the title patterns found in the text; null when none is.

    One scan finds the words that the patterns are made of; a pattern is looked for only where all its steps are among them.
    """
    n, bits = len(rules.TITLE_PATTERNS), word_bits(title_words())

    def row(i: int, title: str):
        def scored(at: Column) -> Column:
            bonus = F.when(at <= rules.SUMMARY_WINDOW, 3).when(at <= rules.MID_WINDOW, 1).otherwise(0)
            score = (F.lit(n - i) + bonus).cast("double").alias("score")
            return F.when(at >= 0, F.struct(score, F.lit(-i).alias("order"), F.lit(title).alias("title")))

        return scored

    def rows(seen: Column) -> Column:
        out = []
        for i, (pattern, title) in enumerate(rules.TITLE_PATTERNS):
            steps = [sum({bits[w] for w in step}) for step in needed_words(pattern)]
            out.append(F.when(has_bits(seen, steps), bind(F.regexp_instr(lower, F.lit(pattern)) - 1, row(i, title))))
        return F.array_compact(F.array(*out))

    scores = bind(found_bits(whole_words(lower, title_words()), bits), rows)
    return F.when(hits(lower, rules.TITLE_NOUNS), bind(scores, lambda r: F.when(F.size(r) > 0, r)))


def best_title(lower: Column) -> Column:
    """Struct of the highest-scoring title (earlier pattern on ties); null when none matches.

    In a text no longer than the summary every pattern found has the same bonus, so that the first one found is the best.
    """
    n, first = len(rules.TITLE_PATTERNS), F
    for i, (pattern, title) in enumerate(rules.TITLE_PATTERNS):
        held = reduce(lambda a, b: a & b, [hits(lower, step) for step in reversed(needed_words(pattern))])
        score = F.lit(float(n - i + 3)).alias("score")
        first = first.when(held & lower.rlike(pattern), F.struct(score, F.lit(-i).alias("order"), F.lit(title).alias("title")))
    short = F.length(lower) <= rules.SUMMARY_WINDOW
    return F.when(short & hits(lower, rules.TITLE_NOUNS), first).when(~short, F.array_max(title_scores(lower)))


def resume_skills(lower: Column, found: Column | None = None) -> Column:
    """Names of the skills whose words stand in the text, sorted; one scan finds the words of all skills, unless ``found`` has them."""
    names: dict[str, list[str]] = {}
    for name, pattern in rules.SKILL_PATTERNS.items():
        for w in listed_words([pattern]):
            names.setdefault(w, []).append(name)
    of = F.create_map(*[x for w, held in names.items() for x in (F.lit(w), F.array(*map(F.lit, held)))])
    none = F.array().cast("array<string>")
    words = whole_words(lower, names) if found is None else found
    skills = F.flatten(F.transform(words, lambda w: F.coalesce(F.try_element_at(of, w), none)))
    return F.coalesce(F.sort_array(F.array_distinct(skills)), none)


def resume_location(lower: Column, found: Column | None = None) -> Column:
    """Struct (state, confidence) of the first state pattern found, in table order; one scan finds the words of all states,
    unless ``found`` has them."""
    none = F.struct(F.lit(None).cast("string").alias("state"), F.lit(0.0).alias("confidence"))
    words = listed_words(rules.STATE_PATTERNS.values())
    bits = word_bits(words)

    def first(seen: Column) -> Column:
        out = F.when(seen.isNull() | (seen == 0), none)
        for state, pattern in rules.STATE_PATTERNS.items():
            near = (F.length(lower) <= rules.MID_WINDOW) | (F.regexp_instr(lower, F.lit(pattern)) - 1 <= rules.MID_WINDOW)
            boost = F.when(near, 1.5).otherwise(1.0)
            here = seen.bitwiseAND(sum(bits[w] for w in listed_words([pattern]))) != 0
            out = out.when(here, F.struct(F.lit(state).alias("state"), boost.alias("confidence")))
        return out.otherwise(none)

    return bind(found_bits(whole_words(lower, words) if found is None else found, bits), first)


def resume_years(lower: Column, title: Column) -> Column:
    """Struct (years, confidence): written years, else words of the title, else words of the text."""

    def found(years, confidence):
        return F.struct(years.cast("int").alias("years"), F.lit(confidence).alias("confidence"))

    def capped(years):
        # a number too long for bigint is above the cap as well
        return F.least(F.coalesce(years, F.lit(rules.RESUME_MAX_YEARS)), F.lit(rules.RESUME_MAX_YEARS))

    def num(pattern, group):
        return F.regexp_extract(lower, pattern, group).try_cast("bigint")

    span = rules.RANGE_YEARS_PATTERN
    mid = F.bround((F.try_add(num(span, 1), num(span, 2))) / 2, 0)
    default = found(F.lit(rules.RESUME_DEFAULT_YEARS), 0.0)
    written = lower.contains("year")  # all written forms hold it, and most texts do not
    out = F.when(lower == "", default).when(written & lower.contains("-") & lower.rlike(span), found(capped(mid), 1.0))
    for p in rules.YEARS_PATTERNS:
        out = out.when(written & lower.rlike(p), found(capped(num(p, 1)), 1.0))
    for words, years in rules.TITLE_YEARS_HINTS:
        out = out.when(F.coalesce(F.lower(title).rlike(alternation(words)), F.lit(False)), found(F.lit(years), 0.5))
    text_hit = hits(lower, rules.TEXT_YEARS_WORDS)
    return out.when(text_hit, found(F.lit(rules.TEXT_YEARS), 0.4)).otherwise(default)


def match_title(lower: Column) -> Column:
    """First title pattern found in lower-case text."""
    out = F
    for p, title in rules.TITLE_PATTERNS:
        out = out.when(lower.rlike(p), F.lit(title))
    return out


def section_title(lines: Column) -> Column:
    """Struct (title, confidence) from the lines that follow an experience heading, else from any short line.

    The part of a line before a splitter such as " at " needs no test of its own: it ends at a word boundary, so
    where it matches a pattern the whole line does too.
    """
    heading = alternation(rules.SECTION_MARKERS)
    window = F.slice(lines, 1, rules.SECTION_WINDOW_LINES)
    sized = F.transform(window, lambda x: F.struct(F.lower(x).alias("low"), F.length(x).alias("n")))
    rows = F.transform(
        sized,
        lambda x: F.struct(
            match_title(x["low"]).alias("title"), x["n"].alias("n"), x["low"].rlike(heading).alias("heading")
        ),
    )

    def first(candidates, longest):
        return F.get(F.filter(candidates, lambda x: x["title"].isNotNull() & (x["n"] <= longest)), F.lit(0))["title"]

    def pick(r):
        below = F.transform(
            r, lambda x, i: F.slice(r, i + 2, F.when(x["heading"], rules.SECTION_LOOKAHEAD).otherwise(0))
        )
        near, loose = first(F.flatten(below), rules.SECTION_LINE_MAX), first(r, rules.LOOSE_LINE_MAX)
        return F.struct(
            F.coalesce(near, loose).alias("title"),
            F.when(near.isNotNull(), 0.7).when(loose.isNotNull(), 0.5).otherwise(0.0).alias("confidence"),
        )

    return bind(rows, pick)


def skills_title(skills: Column) -> Column:
    """Struct (title, confidence) whose required skills are all present, most preferred skills first."""
    rows = []
    for i, (title, required, preferred) in enumerate(rules.SKILL_TITLE_HINTS):
        ok = F.size(F.array_except(F.array(*map(F.lit, required)), skills)) == 0
        score = F.lit(0.4)
        if preferred:
            score = score + F.lit(0.05) * F.size(F.array_intersect(skills, F.array(*map(F.lit, preferred))))
        rows.append(
            F.when(ok, F.struct(score.alias("confidence"), F.lit(-i).alias("order"), F.lit(title).alias("title")))
        )
    best = F.array_max(F.array_compact(F.array(*rows)))
    return F.struct(best["title"].alias("title"), F.coalesce(best["confidence"], F.lit(0.0)).alias("confidence"))


def parse_documents(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the parsed resume fields to a table of texts.

    A projection per dependency level keeps each regex set evaluated once and each generated method small.
    Section titles (``section_title``) are not consulted: a line that matches a title pattern matches in the whole
    text as well, where it scores at least 1 against the 0.7 of a section title.
    """
    text = F.col(text_col)
    keep = df.columns
    step = df.select(*keep, clean_text(text).alias("_clean"))
    step = step.withColumn("_lower", F.lower("_clean"))
    listed = listed_words([*rules.SKILL_PATTERNS.values(), *rules.STATE_PATTERNS.values()])
    step = step.withColumn("_words", whole_words(F.col("_lower"), listed))  # one scan for skills and states
    step = step.select(
        *keep, "_clean", "_lower",
        best_title(F.col("_lower")).alias("_scored"),
        resume_skills(F.col("_lower"), F.col("_words")).alias("skills"),
        resume_location(F.col("_lower"), F.col("_words")).alias("_loc"),
    )
    step = step.withColumn("_hint", skills_title(F.col("skills")))
    step = step.withColumn("_title", _pick_title())
    step = step.withColumn("_years", resume_years(F.col("_lower"), F.col("_title.title")))
    ok = F.col("_clean") != ""
    return step.select(
        *keep,
        F.col("_title.title").alias("job_title"),
        F.col("_loc.state").alias("location"),
        F.col("_years.years").alias("experience_years"),
        "skills",
        F.struct(
            F.col("_title.confidence").alias("job_title"),
            F.col("_loc.confidence").alias("location"),
            F.col("_years.confidence").alias("experience"),
            F.when(F.size("skills") > 0, 1.0).otherwise(0.0).alias("skills"),
        ).alias("confidence"),
        F.when(ok, F.substring("_clean", 1, 500)).alias("extracted_text_preview"),
        ok.alias("success"),
        F.when(~ok, F.lit("Could not extract text from file. Please try a different format."))
        .when(F.col("_title.title").isNotNull(), F.lit("Resume parsed successfully"))
        .otherwise(F.lit("Resume parsed but no job title detected"))
        .alias("message"),
    )


def _pick_title() -> Column:
    """Pattern title, replaced by the title the skills suggest only when that one is more certain."""
    hint = F.col("_hint")
    scored = F.struct(
        F.col("_scored.title").alias("title"),
        F.coalesce(F.col("_scored.score"), F.lit(0.0)).alias("confidence"),
    )
    take = hint["title"].isNotNull() & (
        scored["title"].isNull() | (hint["confidence"] > scored["confidence"])
    )
    return F.when(take, hint).otherwise(scored)
