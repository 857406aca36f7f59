"""Job cards and job details out of raw HTML text columns."""

from __future__ import annotations

import re
import sys
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules
from ..functions import text

# the Arrow function and its parser travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CRITERIA = rules.DETAIL_CRITERIA
DETAIL_FIELDS = ["salary", "applicants", "description", *CRITERIA]
_SALARY = ("compensation__salary", "salary")
_APPLICANTS = ("num-applicants__caption", "num-applicants__figure")
_DESCRIPTION = ("description__text", "show-more-less-html__markup")
_CRITERION, _CRITERION_TEXT = "description__job-criteria-item", "description__job-criteria-text"
_DETAIL_CLASSES = frozenset((*_SALARY, *_APPLICANTS, *_DESCRIPTION, _CRITERION, _CRITERION_TEXT))
_ROLES = (_SALARY, _APPLICANTS, _DESCRIPTION, (_CRITERION,), (_CRITERION_TEXT,))
_ROLE_SALARY, _ROLE_APPLICANTS, _ROLE_DESCRIPTION, _ROLE_CRITERION, _ROLE_CRITERION_TEXT = (1 << i for i in range(len(_ROLES)))
_CARD_CLASSES = frozenset((*rules.CARD_CLASSES.values(), rules.CARD_LINK_CLASS, rules.CARD_LOGO_CLASS))
CARD_FIELDS = [*rules.CARD_CLASSES, "date", "job_url", "company_logo"]
#: Places in CARD_FIELDS of the fields that are texts, by class.
_CARD_TEXTS = {name: i for i, name in enumerate(rules.CARD_CLASSES.values())}
_SALARY_FIELD = CARD_FIELDS.index("salary")


def extract_job_cards(df: DataFrame, html_col: str = "html", require_salary: bool = False) -> DataFrame:
    """One row per list item that has a position and a company; only pages that name both classes are parsed."""
    keep = [c for c in df.columns if c != html_col]
    page = F.col(html_col)
    pages = df.where(page.contains(rules.CARD_CLASSES["position"]) & page.contains(rules.CARD_CLASSES["company"]))
    cards = pages.select(*keep, F.posexplode(card_fields(page)).alias("card_index", "__c"))
    salary = F.col("__c.salary")
    out = cards.select(
        *keep,
        "card_index",
        *[F.col(f"__c.{c}").alias(c) for c in ("position", "company", "location", "date")],
        F.when(salary == "", rules.NOT_SPECIFIED).otherwise(salary).alias("salary"),
        *[F.col(f"__c.{c}").alias(c) for c in ("job_url", "company_logo", "ago_time")],
    ).where((F.col("position") != "") & (F.col("company") != ""))
    return out.where(F.col("salary") != rules.NOT_SPECIFIED) if require_salary else out


# plain markup: tags with quoted attributes, comments and text
_ATTRIBUTE = r'[a-z][a-z0-9-]*(?:="(?:[^"<>&]|&(?:amp|lt|gt|quot|#39);)*+")?'
_TAG = re.compile(rf"(/?)([a-z][a-z0-9]*)((?:[ \t\n\r\f]+{_ATTRIBUTE})*+)[ \t\n\r\f]*+(/?)|!--(?:[^<>-]|-(?!-))*+--")
_PAIR = re.compile(r'([a-z][a-z0-9-]*)(?:(=)"([^"]*)")?')
#: Elements whose content is not markup, and those that a parser may come to treat so.
_RAW = frozenset("script style textarea title iframe noembed noframes noscript plaintext xmp svg math".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Kinds of a tag of plain markup; void elements have no content, however they are written.
_COMMENT, _START, _CLOSED, _END, _EMPTY = range(5)
_FIRST = (_COMMENT, "", None, None, False, 0)


def _tag(raw: str) -> tuple | None:
    """What stands between "<" and ">" as (kind, name, classes, attributes, whether a card reads it, roles); None where it is not plain."""
    found = _TAG.fullmatch(raw)
    if found is None:
        return None
    ends, name, given, closed = found.groups()
    if name is None:
        return _FIRST
    if ends:
        return None if given or closed else (_END, name, None, None, False, 0)
    if name in _RAW:
        return None
    attributes = {n: unescape(v) if e else None for n, e, v in _PAIR.findall(given)}
    classes = _classes(attributes)
    kind = _EMPTY if name in _VOID else _CLOSED if closed else _START
    return kind, name, classes, attributes, name == "time" or not classes.isdisjoint(_CARD_CLASSES), _roles(classes)


def _tokens(page: str, known: dict) -> list[tuple[tuple, str]] | None:
    """Tags of a page of plain markup, each with the text up to the next, after the text before the first; None for any other page.

    ``known`` keeps the tags read so far.
    """
    pieces = iter(page.split("<"))
    out = [(_FIRST, next(pieces))]
    for piece in pieces:
        raw, ends, text = piece.partition(">")
        if not ends:
            return None
        tag = known.get(raw)
        if tag is None:
            tag = _tag(raw)
            if tag is None:
                return None
            if len(known) > 20_000:
                known.clear()
            known[raw] = tag
        out.append((tag, text))
    return out


def _read(parser: _ClassText | _ListItems, page: str | None, known: dict) -> None:
    """The page into the parser: plain markup tag by tag, all else as HTMLParser reads it."""
    tokens = _tokens(page or "", known)
    if tokens is None:
        parser.feed(page)
        parser.close()
    else:
        parser.take(tokens)


class _ClassText(HTMLParser):
    """Collects the text of elements by the roles of their classes; markup nests its own tags, which one regex cannot follow."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.found: list[tuple[int, list[str], int]] = []
        self.live: list[tuple[int, list[str], int]] = []

    def take(self, tokens: list[tuple[tuple, str]]) -> None:
        """What the handlers do, for tags known to be plain."""
        opened, found, live = self.open, self.found, self.live
        for (kind, name, _, _, _, roles), text in tokens:
            if kind == _END:
                if opened and opened[-1] == name:
                    opened.pop()
                    if live and live[-1][2] > len(opened):
                        live.pop()
                else:
                    self.handle_endtag(name)
            elif kind == _START:
                opened.append(name)
                if roles:
                    item = (roles, [], len(opened))
                    found.append(item)
                    live.append(item)
            elif kind == _CLOSED and roles:
                found.append((roles, [], len(opened) + 1))
            if text and live:
                text = unescape(text) if "&" in text else text
                for x in live:
                    x[1].append(text)

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        self.open.append(tag)
        roles = _roles(_classes(dict(attrs)))
        if roles:
            item = (roles, [], len(self.open))
            self.found.append(item)
            self.live.append(item)

    def handle_endtag(self, tag):
        if tag not in self.open:
            return
        while self.open.pop() != tag:
            pass
        depth = len(self.open)
        while self.live and self.live[-1][2] > depth:
            self.live.pop()

    def handle_data(self, data):
        for x in self.live:
            x[1].append(data)


class _ListItems(HTMLParser):
    """The elements of a card inside each list item, an inner list's items included: tag, classes, attributes and texts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.items: list[list[tuple[str, frozenset, dict, list[str]]]] = []
        self.inside: list[tuple[int, list]] = []
        self.live: list[tuple[int, list[str]]] = []

    def take(self, tokens: list[tuple[tuple, str]]) -> None:
        """What the handlers do, for tags known to be plain."""
        opened, inside, live = self.open, self.inside, self.live
        for (kind, name, classes, attributes, read, _), text in tokens:
            if kind == _END:
                if opened and opened[-1] == name:
                    opened.pop()
                    depth = len(opened)
                    if live and live[-1][0] > depth:
                        live.pop()
                    if inside and inside[-1][0] > depth:
                        inside.pop()
                else:
                    self.handle_endtag(name)
            elif kind == _START and name == "li":
                self.handle_starttag(name, attributes)
            elif kind:
                if read and inside:
                    element = (name, classes, attributes, [])
                    for _, item in inside:
                        item.append(element)
                    if kind == _START:
                        live.append((len(opened) + 1, element[3]))
                if kind == _START:
                    opened.append(name)
            if text and live:
                text = unescape(text) if "&" in text else text
                for _, texts in live:
                    texts.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "li" and "li" in self.open:  # an item ends where its next sibling starts
            last = len(self.open) - 1 - self.open[::-1].index("li")
            if not {"ul", "ol"} & {*self.open[last:]}:
                self._close(last)
        element = self._element(tag, attrs)
        if tag in _VOID:
            return
        self.open.append(tag)
        if element is not None:
            self.live.append((len(self.open), element[3]))
        if tag == "li":
            self.items.append([])
            self.inside.append((len(self.open), self.items[-1]))

    def handle_startendtag(self, tag, attrs):
        self._element(tag, attrs)

    def _element(self, tag, attrs):
        """The element, noted in the items that are open; None where no card field reads it."""
        if not self.inside:
            return None
        attrs = dict(attrs)
        classes = _classes(attrs)
        if tag != "time" and classes.isdisjoint(_CARD_CLASSES):
            return None
        element = (tag, classes, attrs, [])
        for _, item in self.inside:
            item.append(element)
        return element

    def handle_endtag(self, tag):
        if tag in self.open:
            self._close(len(self.open) - 1 - self.open[::-1].index(tag))

    def _close(self, depth):
        del self.open[depth:]
        while self.live and self.live[-1][0] > depth:
            self.live.pop()
        while self.inside and self.inside[-1][0] > depth:
            self.inside.pop()

    def handle_data(self, data):
        for _, texts in self.live:
            texts.append(data)


def _classes(attrs: dict) -> frozenset:
    return frozenset((attrs.get("class") or "").split())


def _roles(classes: frozenset) -> int:
    """Which detail fields read an element of these classes, as the sum of their bits."""
    return 0 if classes.isdisjoint(_DETAIL_CLASSES) else sum(1 << i for i, names in enumerate(_ROLES) if not classes.isdisjoint(names))


def _card(item: list[tuple[str, frozenset, dict, list[str]]]) -> list[str | None]:
    """The values of CARD_FIELDS."""
    out: list = [""] * len(_CARD_TEXTS) + [None, None, None]
    dated = False
    for tag, classes, attributes, texts in item:
        for name in classes:
            field = _CARD_TEXTS.get(name)
            if field is not None:
                out[field] += "".join(texts)
            elif name == rules.CARD_LINK_CLASS and out[-2] is None:
                out[-2] = attributes.get("href") or ""
            elif name == rules.CARD_LOGO_CLASS and out[-1] is None:
                out[-1] = attributes.get("data-delayed-url") or ""
        if tag == "time" and not dated:
            out[-3], dated = attributes.get("datetime"), True
    for field in range(len(_CARD_TEXTS)):
        out[field] = out[field].strip()
    out[_SALARY_FIELD] = " ".join(out[_SALARY_FIELD].split())
    out[-2], out[-1] = out[-2] or "", out[-1] or ""
    return out


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in CARD_FIELDS])))
def card_fields(html: pa.Array) -> pa.Array:
    known: dict = {}
    ends, cards = [0], []
    for page in html.to_pylist():
        parser = _ListItems()
        _read(parser, page, known)
        cards += map(_card, parser.items)
        ends.append(len(cards))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _columns(cards, CARD_FIELDS))


def _columns(rows: list[list], names: list[str]) -> pa.Array:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], names)


def _detail(html: str | None, known: dict) -> list[str]:
    """The values of DETAIL_FIELDS."""
    page = _ClassText()
    _read(page, html, known)
    salary = description = None
    applicants, items = "", []
    for i, (roles, texts, _) in enumerate(page.found):
        if roles & _ROLE_SALARY and salary is None:
            salary = "".join(texts)
        if roles & _ROLE_APPLICANTS:
            applicants += "".join(texts)
        if roles & _ROLE_DESCRIPTION and description is None:
            description = "".join(texts)
        if roles & _ROLE_CRITERION:
            items.append((i, "".join(texts)))
    out = [(salary or "").strip(), applicants.strip(), (description or "").strip()]
    for label in CRITERIA.values():
        value = ""
        for i, whole in items:
            if label in whole:
                depth = page.found[i][2]
                for roles, texts, d in page.found[i + 1 :]:
                    if d <= depth:
                        break
                    if roles & _ROLE_CRITERION_TEXT:
                        value += "".join(texts)
        out.append(value.strip())
    return out


@F.arrow_udf(T.StructType([T.StructField(c, T.StringType()) for c in DETAIL_FIELDS]))
def detail_fields(html: pa.Array) -> pa.Array:
    known: dict = {}
    return _columns([_detail(h, known) for h in html.to_pylist()], DETAIL_FIELDS)


def extract_job_details(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Detail-page HTML to salary, criteria, applicants, description, skills, experience and education."""
    keep = [c for c in df.columns if c != html_col]
    raw = df.select(*keep, detail_fields(F.col(html_col)).alias("__d"))
    d = F.col("__d")

    def given(c):
        return F.when(d[c] == "", rules.NOT_SPECIFIED).otherwise(d[c]).alias(c)

    desc = d["description"]
    return raw.select(
        *keep,
        given("salary"),
        *[given(c) for c in CRITERIA],
        text.applicant_count(d["applicants"]).alias("applicant_count"),
        desc.alias("description"),
        text.description_skills(desc).alias("skills"),
        text.experience_phrase(desc).alias("experience_years"),
        text.education_level(desc).alias("education"),
    )


def reject_html_payloads(df: DataFrame, content_col: str) -> DataFrame:
    """Rows whose content is data, not a web page."""
    return df.where(~text.html_payload(F.col(content_col)))
