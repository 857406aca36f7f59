"""The registered queries of this subpackage beside the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import importance, mixing, quality_classifier, secrets, sentencepieces, toxicity, vector_codes
from .common import UID, numbered, ship
from .exact_dedup import exact_groups
from .near_dedup import near_groups
from .packing import pack_documents
from .quality_rules import BASE_MEASURES, apply_cascade
from .sharding import shuffle_into_shards
from .token_counts import saved_histogram
from .tokens import vocabulary_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_groups(documents(spark, sf)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op6_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
  sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t)"""


@query
def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = shuffle_into_shards(documents(spark, sf), shards=8)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return saved_histogram(documents(spark, sf))


@query
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return apply_cascade(documents(spark, sf), measures=BASE_MEASURES, flags=("base",)).drop("failed_rule")


ORACLES["op5_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, list_slice(words, i, i + 7) AS g FROM w, unnest(range(1, greatest(len(words) - 6, 1))) t(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 8)) t(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, text, lines, len(words) AS n_words, words,
  coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered c USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed
  OR 10 * n_symbols > n_words OR NOT (2 * n_words <= word_chars AND word_chars <= 20 * n_words)
  OR 2 * n_dup_lines > len(lines)
  OR length(regexp_replace(text, '[^A-Z]', '', 'g')) > length(regexp_replace(text, '[^a-z]', '', 'g'))
  OR 5 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
  OR 5 * (len(string_split(text, '...')) - 1 + len(string_split(text, '…')) - 1) > n_words
  OR 5 * (SELECT count(*) FROM unnest(range(2, len(words) + 1)) t(i) WHERE words[i] = words[i - 1]) > n_words
  OR 5 * len(list_filter(words, lambda x: NOT regexp_matches(x, '[0-9A-Za-z]|[^\x00-\x7F]'))) > n_words) AS kept FROM b"""


@query
def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(documents(spark, sf))


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")


@query
def op1_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    shapes = quality_classifier.measured(documents(spark, sf), extra={"held_out": F.coalesce(held_out, F.lit(False))})
    trusted = labels(spark, sf).where((F.col("quality") == 1) & ~held_out)
    model = quality_classifier.fit(shapes.where(~F.col("held_out")), trusted)
    return quality_classifier.score(shapes, model).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    scored = toxicity.score(docs, toxicity.fit(docs, labels(spark, sf)))
    return scored.withColumns({"toxic": (F.col("grade") > 0).cast("int"), "kept": F.col("grade") == 0})


@query
def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_groups(documents(spark, sf)).select("doc_id", "class_id", "class_size", "kept")


@query
def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = numbered(documents(spark, sf).select("doc_id", "text"), "secret-rows")
    found = secrets.scan(rows).select(
        UID, "start", F.length("token").cast("bigint").alias("length"), F.sha2("token", 256).alias("token_sha256"), "score", "is_secret"
    )
    return rows.select(UID, "doc_id").join(found, UID).drop(UID)


@query
def op2_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = sentencepieces.load_model(vocabulary_path("piece_bpe_32k.model"))
    decoded = sentencepieces.decode(F.col("ids"), model)
    return sentencepieces.encode(documents(spark, sf), model).withColumns(
        {"n_ids": F.size("ids").cast("bigint"), "decoded_crc32": F.crc32(decoded.cast("binary"))}
    )


@query
def op13_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf))
    return mixed.select("doc_id", "size", "source_size", "target", mixing.taken_words().alias("taken"))


@query
def op12_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    scored = importance.score(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"), max_run=1)
    return importance.draw(scored).select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op12_importance_resampling"] = r"""
WITH steps AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
texts AS (SELECT 'd' AS kind, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
words AS (SELECT kind, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w FROM texts),
met AS (SELECT w, hex(w) AS h, count(*) FILTER (kind = 'd') AS nd, count(*) FILTER (kind = 'b') AS nb FROM words GROUP BY w),
sums AS (SELECT w, nd, nb, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2),
    lambda k: ('0x' || substr(h, k, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket FROM met, steps),
gains AS (SELECT bucket, floor(1000 * ln((sum(nb) + 1)::DOUBLE * (sum(sum(nd)) OVER () + 10000)
    / ((sum(nd) + 1)::DOUBLE * (sum(sum(nb)) OVER () + 10000))))::BIGINT AS gain FROM sums GROUP BY bucket),
weights AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM words JOIN sums USING (w) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= n * 10 // 100 THEN r END AS rank FROM ranked"""


@query
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    codes, books = vector_codes.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))
    found = vector_codes.with_label_errors(codes)
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _codes_sql(rounds: int = 4) -> str:
    """Plain k-means over (vector, part, position) rows, one step of assignment and one of renewal per round."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
far{t} AS (SELECT vec_id, x.part, e.entry, sum((x.v - e.v) * (x.v - e.v)) AS d FROM x JOIN book{t} e USING (part, pos) GROUP BY ALL),
near{t} AS MATERIALIZED (SELECT vec_id, part, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM far{t} GROUP BY vec_id, part)""")
        if t < rounds:
            steps.append(f"""
mean{t} AS (SELECT n.part, n.entry, pos, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v FROM near{t} n JOIN x USING (vec_id, part) GROUP BY n.part, n.entry, pos),
book{t + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(m.v, b.v) AS v FROM book{t} b LEFT JOIN mean{t} m USING (part, entry, pos))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, label, embedding AS e, row_number() OVER (ORDER BY vec_id) - 1 AS nth FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS MATERIALIZED (SELECT vec_id, nth, (i * 4) // len(e) AS part, i % (len(e) // 4) AS pos, floor(1024 * e[i + 1]::DOUBLE)::BIGINT AS v
  FROM (SELECT *, unnest(range(len(e))) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, nth AS entry, pos, v FROM x WHERE nth < 256),{",".join(steps)},
code AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN code USING (vec_id), digest"""


ORACLES["op11_vector_codes"] = _codes_sql()
