"""Keyword tests over text columns."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# every whitespace character, also the non-ASCII ones
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"


def strip(text: Column) -> Column:
    """``text`` without white space of any kind at either end."""
    return F.regexp_replace(text, rf"^{SPACE}|{SPACE}$", "")


def escaped(word: str) -> str:
    return re.sub(r"([.+*?^$()\[\]{}|\\/-])", r"\\\1", word)


def alternation(words: Iterable[str]) -> str:
    """One regex that matches any of the literal words; one scan of the text instead of one per word."""
    return "|".join(map(escaped, words))


def trie(words: Iterable[str]) -> str:
    """One regex that matches any of the literal words, branching letter by letter, so that a text position is given up at the first
    letter that no word goes on with."""
    words = sorted(set(words))
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    branches = [escaped(head) + trie(tails) for head, tails in heads.items()]
    if not branches:
        return ""
    whole = branches[0] if len(branches) == 1 and "" not in words else f"(?:{'|'.join(branches)})"
    return f"{whole}?" if "" in words else whole


def _place(words: list[str]) -> str:
    return rf"(?=[{''.join(sorted({escaped(w[0]) for w in words}))}])\b"


def whole_word(words: Iterable[str]) -> str:
    """One regex that finds any of the literal words between word boundaries; a position is first tested for a first letter."""
    words = list(words)
    return rf"{_place(words)}{trie(words)}\b"


def whole_words(text: Column, words: Iterable[str]) -> Column:
    """The listed words that stand between word boundaries, as an array with repeats; one scan of the text for all of them.

    The longest word of each place is found, and places may overlap; a listed word that a longer one starts with comes with it.
    """
    words = sorted(set(words))
    found = F.regexp_extract_all(text, F.lit(rf"{_place(words)}(?=({trie(words)}\b))"), F.lit(1))
    starts = {w: [v for v in words if re.match(rf"{re.escape(v)}\b", w)] for w in words}
    longer = {w: vs for w, vs in starts.items() if len(vs) > 1}
    if not longer:
        return found
    pairs = [x for w, vs in longer.items() for x in (F.lit(w), F.array(*map(F.lit, vs)))]
    return F.flatten(F.transform(found, lambda w: F.coalesce(F.try_element_at(F.create_map(*pairs), w), F.array(w))))


def hits(lower: Column, words: Iterable[str]) -> Column:
    """True when an already lower-case text column contains one of the words, false for null text.

    Plain substring tests are several times cheaper than one regex, as long as the text is a stored column.
    """
    return F.coalesce(reduce(lambda a, b: a | b, [lower.contains(w) for w in words]), F.lit(False))


def has_any(text: Column, words: Iterable[str]) -> Column:
    """The same for any text expression: lower-cased once, then one regex."""
    return F.coalesce(F.lower(text).rlike(alternation(words)), F.lit(False))


def flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def first_label(text: Column, rules, default: str, missing: str | None, lower: bool = False) -> Column:
    """Label of the first rule whose words occur in text; ``lower`` says the text is a lower-case column."""
    test = hits if lower else has_any
    out = F.when(text.isNull(), F.lit(missing))
    for label, words in rules:
        out = out.when(test(text, words), F.lit(label))
    return out.otherwise(F.lit(default))


def lookup(key: Column, mapping: dict, default=None) -> Column:
    """Literal-map lookup (no join, no shuffle) for the small rule tables."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    hit = F.try_element_at(F.create_map(*pairs), key)
    return hit if default is None else F.coalesce(hit, F.lit(default))


def blank(text: Column) -> Column:
    """Null or empty string."""
    return F.coalesce(text == "", F.lit(True))


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
