"""Quality rules as a short-circuit cascade.

A rule names a test on a document that says when to reject it.  ``plan_cascade`` runs every rule on a sample, takes
each rule's mean cost and the set of sample rows that it rejects, and orders the rules greedily by rejections per cost
among the rows that the rules before it let through.  ``apply_cascade`` then tests every document in that order and
stops at its first failed rule; measures are computed when a rule first asks for them, so a document rejected early
never pays for the later ones.  The verdict (``kept``) does not depend on the order; only the work does.

Defined cases: a null text has no words and counts as empty; an empty text fails the base rule; texts are read whole
whatever their length; an empty table gives an empty result and keeps the rules in the given order; columns of ``df``
other than the text and those asked for are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from time import perf_counter_ns

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .exact_dedup import arrow_schema

SAMPLE_ROWS = 2000
WHITE = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
CAPITALS, SMALL = bytes(range(65, 91)), bytes(range(97, 123))
ALPHANUMERIC = re.compile(rb"[0-9A-Za-z\x80-\xff]")
WINDOW = 8


class Document:
    """Measures of one text, each computed when first asked for."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that are neither white space nor the continuation of a code point."""
        return len(self.text.translate(None, WHITE + CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside an eight-word window that the text has twice or more, its first place included."""
        w = self.words
        if len(w) <= WINDOW:
            return 0
        windows = list(zip(*(w[i:] for i in range(WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        seen, covered, end = Counter(windows), 0, 0
        for i, window in enumerate(windows):
            if seen[window] > 1:
                covered += i + WINDOW - max(i, end)
                end = i + WINDOW
        return covered

    @cached_property
    def n_stutter(self) -> int:
        """Words equal to the word before."""
        return sum(a == b for a, b in zip(self.words, self.words[1:]))

    @cached_property
    def n_capitals(self) -> int:
        return len(self.text) - len(self.text.translate(None, CAPITALS))

    @cached_property
    def n_small(self) -> int:
        return len(self.text) - len(self.text.translate(None, SMALL))

    @cached_property
    def n_wordless(self) -> int:
        """Words without a letter or digit."""
        return sum(ALPHANUMERIC.search(x) is None for x in self.words)


BASE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Document], bool]


def base_failed(d: Document) -> bool:
    return d.n_words < 20 or 100 * d.n_repeat_words > 30 * d.n_words


RULES = (
    Rule("base", base_failed),
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 20 * d.n_words),
    Rule("duplicate_lines", lambda d: 2 * d.n_dup_lines > len(d.lines)),
    Rule("capitals", lambda d: d.n_capitals > d.n_small),
    Rule("exclamations", lambda d: 5 * d.text.count(b"!") > d.n_words),
    Rule("ellipses", lambda d: 5 * (d.text.count(b"...") + d.text.count("…".encode())) > d.n_words),
    Rule("stutter", lambda d: 5 * d.n_stutter > d.n_words),
    Rule("wordless", lambda d: 5 * d.n_wordless > d.n_words),
)


@dataclass(frozen=True)
class RuleCost:
    rule: str
    cost_ns: float
    rejected: float
    rate: float
    """Rejections per nanosecond among the sample rows that earlier rules let through."""


def _try_rules(rules: Sequence[Rule]):
    """Per sample row the bits of the rules it fails; per rule the nanoseconds on a document without any measure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, costs = [], []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                failed, spent = 0, []
                for i, rule in enumerate(rules):
                    d = Document(text)
                    start = perf_counter_ns()
                    failed |= bool(rule.fails(d)) << i
                    spent.append(perf_counter_ns() - start)
                bits.append(failed)
                costs.append(spent)
            yield pa.record_batch([pa.array(bits, pa.int64()), pa.array(costs, pa.list_(pa.int64()))], names=["bits", "costs"])

    return run


def plan_cascade(
    df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> list[RuleCost]:
    """The rules in the order to run them, with their figures on a sample of about ``sample_rows`` rows.

    Only one row per distinct set of failed rules comes to the driver, at most 2**len(rules) and never more than the
    sample; the sample bounds the estimate alone, the cascade itself runs on every row.
    """
    total = df.count()
    if total == 0:
        return [RuleCost(r.name, 0.0, 0.0, 0.0) for r in rules]
    sample = df.sample(min(1.0, sample_rows / total), seed) if total > sample_rows else df
    tried = sample.select(text_of(text).alias("text")).mapInArrow(_try_rules(rules), "bits long, costs array<long>")
    spent = [F.sum(F.col("costs")[i]).alias(f"c{i}") for i in range(len(rules))]
    rows = tried.groupBy("bits").agg(F.count(F.lit(1)).alias("n"), *spent).collect()
    sampled = sum(r["n"] for r in rows)
    if not sampled:
        return [RuleCost(r.name, 0.0, 0.0, 0.0) for r in rules]
    cost = [max(1.0, sum(r[f"c{i}"] for r in rows) / sampled) for i in range(len(rules))]
    left, alive, order = list(range(len(rules))), [(r["bits"], r["n"]) for r in rows], []
    while left:
        reach = max(1, sum(n for _, n in alive))
        hits = {i: sum(n for bits, n in alive if bits >> i & 1) for i in left}
        best = max(left, key=lambda i: (hits[i] / cost[i], -cost[i], -i))
        order.append(RuleCost(rules[best].name, cost[best], hits[best] / reach, hits[best] / reach / cost[best]))
        alive = [(bits, n) for bits, n in alive if not bits >> best & 1]
        left.remove(best)
    return order


def _cascade(rules: Sequence[Rule], measures: Sequence[str], flags: Sequence[Rule], kept_columns: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(len(measures) + len(flags) + 2)]
            for text in batch.column(kept_columns).cast(pa.binary()).to_pylist():
                d = Document(text)
                failed = next((r.name for r in rules if r.fails(d)), None)
                values = [getattr(d, m) for m in measures] + [bool(r.fails(d)) for r in flags] + [failed is None, failed]
                for column, v in zip(out, values):
                    column.append(v)
            arrays = batch.columns[:kept_columns]
            arrays += [pa.array(v, f.type) for v, f in zip(out, list(schema)[kept_columns:])]
            yield pa.record_batch(arrays, schema=schema)

    return run


def apply_cascade(
    df: DataFrame,
    order: Sequence[RuleCost] | None = None,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    columns: Sequence[str] = ("doc_id",),
    measures: Sequence[str] = (),
    flags: Sequence[str] = (),
) -> DataFrame:
    """``columns`` of every row, the asked-for measures and rule flags (computed for every row), kept, failed_rule.

    ``failed_rule`` is the first rule that failed in this order, null for documents that stay.
    """
    by_name = {r.name: r for r in rules}
    ordered = [by_name[c.rule] for c in (order if order is not None else plan_cascade(df, rules, text))]
    picked = df.select(*[F.col(f"`{c}`") for c in columns], text_of(text).alias("__text"))
    schema = picked.drop("__text").schema
    for m in measures:
        schema = schema.add(m, "long")
    for f in flags:
        schema = schema.add(f"{f}_failed", "boolean")
    schema = schema.add("kept", "boolean").add("failed_rule", "string")
    run = _cascade(ordered, measures, [by_name[f] for f in flags], len(columns), arrow_schema(df.sparkSession, schema))
    return picked.mapInArrow(run, schema)
