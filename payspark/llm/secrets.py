"""Secret scans: a random forest tells secrets from look-alikes among candidate strings.

Candidates are long runs of key characters that hold a digit, and values assigned to a name such as ``password``.  Features are a
candidate's length and alphabet, its transitions between character classes, the longest dictionary word inside it,
whether it stands in a path, and the words and marks beside it.  The forest is trained on labelled findings;
``findings_by_format`` labels the candidates whose format alone decides (issued key formats and assigned digests on one side,
plain numbers, paths, words with numbers and repeated characters on the other) where no reviewed findings are given.
Only DataFrame functions and Spark's own forest are used.

Defined cases: null and empty texts have no candidate; a text of any length is scanned whole; repeated rows are scanned each; findings of
one kind only make that kind's verdict the verdict on all; an empty table gives an empty result; other columns are ignored by ``scan``
and kept by ``redact``, where ``n_chars``, if there, is the length of the new text.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UID, numbered, stage, text_of

MAX_FINDINGS = 20_000
DICTIONARY_WORDS = 4000
MARK = "[SECRET]"

# --- fixed values: what names a secret, and public key formats ---------------------------------------------------
NAMES = r"passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key"
KEY = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}={0,2}"
ASSIGNED = rf"(?<=(?i:{NAMES})['\"]?\s{{0,3}}[=:]\s{{0,3}}['\"]?)[^\s'\"<>]{{6,}}"
ISSUED = r"^(AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{24,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$"
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|your|placeholder|x{6,}|1234567"

FEATURES = (
    "length", "digits", "capitals", "smalls", "others", "distinct", "hex_only", "digit_turns", "case_turns", "vowel_turns",
    "dictionary", "in_path", "slashes", "assigned", "quoted", "named", "placeholder",
)


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """``__uid``, start (0-based, in characters), token and the words and marks beside it, one row per candidate."""
    body = df.select(UID, text_of(text).alias("__t")).where(F.col("__t").rlike(rf"[0-9]|(?i:{NAMES})"))
    both = rf"{KEY}|{ASSIGNED}"
    named = F.col("__t").rlike(rf"(?i:{NAMES})")
    found = body.withColumn(
        "__found",
        F.when(named, F.regexp_extract_all("__t", F.lit(both), F.lit(0))).otherwise(F.regexp_extract_all("__t", F.lit(KEY), F.lit(0))),
    ).where(F.size("__found") > 0)
    gaps = F.when(named, F.split("__t", both, -1)).otherwise(F.split("__t", KEY, -1))
    beside = F.transform(
        gaps,
        lambda g: F.struct(
            F.length(g).alias("n"),
            F.regexp_extract(F.substring(g, -48, 48), r"(\S+\s+){0,3}(\S*\s*)$", 0).alias("last"),
            F.regexp_extract(F.substring(g, 1, 48), r"^\S*\s*\S*", 0).alias("first"),
        ),
    )
    rows = found.select(UID, "__found", beside.alias("__gaps")).select(
        UID,
        F.posexplode(
            F.transform(
                "__found",
                lambda c, i: F.struct(
                    c.alias("token"), F.element_at("__gaps", i + 1)["n"].alias("gap"),
                    F.element_at("__gaps", i + 1)["last"].alias("before"), F.element_at("__gaps", i + 2)["first"].alias("after"),
                ),
            )
        ).alias("__i", "__c"),
    )
    up_to = Window.partitionBy(UID).orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
    passed = F.sum(F.col("__c.gap") + F.length("__c.token")).over(up_to)
    return rows.select(UID, (passed - F.length("__c.token")).cast("bigint").alias("start"), "__c.token", "__c.before", "__c.after")


def dictionary(df: DataFrame, text: str = "text", words: int = DICTIONARY_WORDS) -> DataFrame:
    """The ``words`` words of 4 to 12 letters that most documents hold, over all documents: a table of bounded size."""
    held = df.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_of(text)), F.lit(r"(?<!\p{L})\p{L}{4,12}(?!\p{L})"), F.lit(0)))).alias("word"))
    counted = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "word").limit(words).select("word")


def longest_words(found: DataFrame, words: DataFrame) -> DataFrame:
    """Length of the longest dictionary word inside each token: its substrings of 4 to 12 letters met with the word table."""
    # long runs in windows that overlap by 11 letters, so that a word is whole in one of them
    runs = F.regexp_extract_all(F.lower("token"), F.lit(r"(?=(\p{L}{4,256}))\p{L}{1,245}"), F.lit(1))

    def cut(run: Column) -> Column:
        sizes = F.sequence(F.lit(4), F.least(F.lit(12), F.length(run)))
        return F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.length(run) - n + 1), lambda i: run.substr(i, n))))

    tokens = found.select("token").distinct().select("token", F.explode(F.array_distinct(runs)).alias("__run"))
    pieces = tokens.select("token", F.explode(F.array_distinct(cut(F.col("__run")))).alias("word"))
    return pieces.join(F.broadcast(words), "word").groupBy("token").agg(F.max(F.length("word")).alias("longest"))


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with FEATURES as doubles."""
    t, before, after = F.col("token"), F.col("before"), F.col("after")
    n = F.length(t)
    made = {
        "length": n,
        "digits": count_of(t, "[0-9]") / n,
        "capitals": count_of(t, "[A-Z]") / n,
        "smalls": count_of(t, "[a-z]") / n,
        "others": count_of(t, "[^A-Za-z0-9]") / n,
        "distinct": F.size(F.array_distinct(F.split(t, ""))) / n,
        "hex_only": t.rlike("^[0-9a-fA-F]+$"),
        "digit_turns": count_of(t, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])") / n,
        "case_turns": count_of(t, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / n,
        "vowel_turns": count_of(t, "(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])") / n,
        "dictionary": F.coalesce(F.col("longest"), F.lit(0)) / n,
        "in_path": before.rlike(r"(?i)(https?:|www\.|[./@\\?&])\S*$") | after.rlike(r"^[./@\\?&]\w"),
        "slashes": count_of(t, "/"),
        "assigned": before.rlike(r"[=:]\s*['\"]?$"),
        "quoted": before.rlike(r"['\"]$"),
        "named": before.rlike(rf"(?i)({NAMES}|key|credential)\W*$"),
        "placeholder": t.rlike(PLACEHOLDER) | before.rlike(r"(?i)example|sample|dummy"),
    }
    joined = found.join(longest_words(found, words), "token", "left")
    return joined.select(*found.columns, *[made[f].cast("double").alias(f) for f in FEATURES])


def findings_by_format(featured: DataFrame) -> DataFrame:
    """Candidates whose format alone decides, with ``label`` 1 (a secret) or 0."""
    t = F.col("token")
    secret = t.rlike(ISSUED) | ((F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("hex_only") == 1) & (F.col("length") >= 16))
    secret = secret & (F.col("placeholder") == 0)
    harmless = (
        t.rlike(r"^[0-9+/_-]+$") & (F.col("named") == 0) | (F.col("placeholder") == 1) | (F.col("distinct") * F.col("length") <= 3)
        | ((F.col("assigned") == 0) & ((F.col("in_path") == 1) | (F.col("dictionary") >= 0.4) | (F.col("slashes") >= 2)))
    )
    return featured.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0)).where("label IS NOT NULL")


class SecretModel:
    """A forest, or one verdict where the findings knew one kind only."""

    def __init__(self, forest, share: float):
        self.forest, self.share = forest, share

    def score(self, featured: DataFrame) -> DataFrame:
        if self.forest is None:
            return featured.withColumn("score", F.lit(self.share))
        made = VectorAssembler(inputCols=list(FEATURES), outputCol="__x").transform(featured)
        scored = self.forest.transform(made)
        return scored.withColumn("score", vector_to_array("__p")[1]).drop("__x", "__raw", "__p", "__y")


def fit(findings: DataFrame, trees: int = 40, depth: int = 8, max_findings: int = MAX_FINDINGS, seed: int = 17) -> SecretModel:
    """The forest over at most ``max_findings`` labelled findings of each kind, drawn by a hash of token and place."""
    sizes = {r["label"]: r["n"] for r in findings.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return SecretModel(None, max(sizes, default=0.0))
    place = F.pmod(F.xxhash64(F.lit(seed), "token", "start"), F.lit(1_000_000))
    chosen = None
    for label, n in sizes.items():
        part = findings.where((F.col("label") == label) & (place < int(min(1.0, max_findings / n) * 1_000_000)))
        chosen = part if chosen is None else chosen.unionByName(part)
    made = VectorAssembler(inputCols=list(FEATURES), outputCol="__x").transform(chosen).select("__x", "label")
    forest = RandomForestClassifier(
        featuresCol="__x", labelCol="label", rawPredictionCol="__raw", probabilityCol="__p", predictionCol="__y",
        numTrees=trees, maxDepth=depth, seed=seed,
    )
    return SecretModel(forest.fit(made), 0.5)


def scan(df: DataFrame, text: str = "text", findings: DataFrame | None = None) -> DataFrame:
    """One row per candidate: ``__uid``, start, token, its features, score, is_secret.

    ``df`` carries ``__uid``.  ``findings``: reviewed rows with FEATURES and ``label``; by default labelled by format.
    """
    featured = stage(with_features(stage(candidates(df, text), "candidates"), dictionary(df, text)), "features")
    model = fit(findings_by_format(featured) if findings is None else findings)
    return model.score(featured).withColumn("is_secret", F.col("score") >= 0.5)


def redact(df: DataFrame, text: str = "text", mark: str = MARK) -> DataFrame:
    """``df`` with each secret replaced by ``mark``; rows without one are unchanged."""
    rows = numbered(df, "secret-rows")
    spans = scan(rows, text).where("is_secret").groupBy(UID).agg(
        F.sort_array(F.collect_list(F.struct("start", F.length("token").alias("n")))).alias("__spans")
    )
    joined = rows.join(spans, UID, "left")
    body = F.col(f"`{text}`")
    built = F.aggregate(
        "__spans", F.struct(F.lit("").alias("made"), F.lit(0).cast("bigint").alias("at")),
        lambda s, x: F.struct(
            F.concat(s["made"], body.substr((s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark)).alias("made"),
            (x["start"] + x["n"]).alias("at"),
        ),
        lambda s: F.concat(s["made"], body.substr((s["at"] + 1).cast("int"), F.length(body))),
    )
    fresh = F.when(F.col("__spans").isNotNull(), built).otherwise(body)
    out = []
    for c in df.columns:
        if c == text:
            out.append(fresh.alias(c))
        elif c == "n_chars":
            gained = F.aggregate("__spans", F.lit(0), lambda n, x: n + len(mark) - x["n"])
            length = (F.length(body) + gained).cast(df.schema[c].dataType)
            out.append(F.when(F.col("__spans").isNotNull(), length).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return joined.select(*out)
