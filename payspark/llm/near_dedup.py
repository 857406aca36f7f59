"""Near-duplicates by ProbMinHash: signatures of weighted five-word shingles, banding, verification.

A shingle of weight w sends out arrivals of a Poisson process with rate w; each arrival falls into one of the signature's
slots, and a slot keeps the shingle that arrived first.  Arrivals of a document stop once they come later than every slot's
first (early termination), so a signature costs about one arrival per shingle and a few per slot.  Two documents agree
in a slot with a chance equal to their probability Jaccard similarity.  32 bands of 5 slots find a pair of similarity 0.8 with
a chance of 1 - 3e-6.

Documents of equal words are one node, so copies are never compared.  Candidates are checked exactly (probability Jaccard of the
shingle counts) against hubs: in each band bucket every member meets the member with the least hash, not every other.
Then all pairs of different components that share a band and that the signatures do not rule out are checked, so that no such link
is lost.  Where these pairs, counted once for each shared band, are few (``few``), they are joined.  Where they are more, members
first meet the hubs of finer buckets (two bands shared), in ``rounds`` rounds and on as long as a round closes a tenth of what
is open; what is left is checked inside tasks, in blocks of a bucket that a task can hold, and only links leave the task.

Defined cases: null and empty texts are equal to each other and to nothing else; a text of fewer than five words is one
shingle; words are what lies between white space, in lower case; of a group the row with the smallest id stays, null ids last,
then the row read first; repeated rows are copies; an empty table gives an empty result; other columns are ignored by
``near_groups`` and returned unchanged by ``drop_near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import UID, numbered, stage, text_of
from .components import components, grown
from .exact_dedup import arrow_schema

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
ROUNDS = 2
NODES_PER_FILE = 50_000
CACHED_WORDS = 400_000
FEW_PAIRS = 100_000
BLOCK_NODES, BLOCK_BYTES = 2000, 16 << 20
MIX, STEP, ODD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = WordHashes()


def scatter(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: well spread 64-bit values of 64-bit values."""
    x = x + STEP
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * ODD
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and how often each occurs."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(HASHES) > CACHED_WORDS:
        HASHES.clear()
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    s = np.zeros(n, np.uint64)
    for i in range(min(width, len(h))):
        s = scatter(s ^ h[i : i + n])
    return np.unique(s, return_counts=True)


def prob_minhash(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, documents: int, slots: int) -> np.ndarray:
    """Signatures (documents x slots) of the weighted elements; ``owner`` is each element's document.

    Element e's r-th arrival comes an exponential time of rate w after the one before; time and slot depend on
    (e, r) alone, so that equal shingles arrive alike in every document.
    """
    first = np.full(documents * slots, np.inf)
    who = np.zeros(documents * slots, np.uint64)
    last = np.full(documents, np.inf)
    e, w, d, t, r = elements, weights, owner, np.zeros(len(elements)), 0
    while len(e):
        r += 1
        x = scatter(e ^ scatter(np.array([r], np.uint64)))
        t = t - np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / w
        going = t < last[d]
        e, w, d, t, x = e[going], w[going], d[going], t[going], x[going]
        if not len(e):
            break
        at = d * slots + (scatter(x) % np.uint64(slots)).astype(np.int64)
        sooner = np.flatnonzero(t < first[at])
        if len(sooner):
            sooner = sooner[np.argsort(-t[sooner], kind="stable")]  # of several, the last written is the soonest
            first[at[sooner]] = t[sooner]
            who[at[sooner]] = e[sooner]
        live = np.unique(d)
        last[live] = first.reshape(documents, slots)[live].max(axis=1)
    return who.reshape(documents, slots)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64) * STEP, (len(signatures), bands))
    for i in range(rows):
        keys = scatter(keys ^ signatures.reshape(-1, bands, rows)[:, :, i])
    return keys.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i), for counts x and y."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    common, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(common)
    if a[1].max() == 1 and b[1].max() == 1:
        return len(common) / union
    x = np.concatenate([a[1][in_a], np.delete(a[1], in_a), np.zeros(len(b[0]) - len(common))])
    y = np.concatenate([b[1][in_b], np.zeros(len(a[0]) - len(common)), np.delete(b[1], in_b)])
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / x, np.inf)
    order = np.argsort(ratio, kind="stable")
    below = np.concatenate([[0.0], np.cumsum(x[order])])
    above = np.concatenate([np.cumsum(y[order][::-1])[::-1], [0.0]])
    own = ratio[: len(common)]
    k = np.searchsorted(ratio[order], own, side="right")
    return float((1 / (below[k] / x[: len(common)] + above[k] / y[: len(common)])).sum())


def _sign(bands: int, rows: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                texts = part.column(2).to_pylist()
                made = [shingles(t) for t in texts]
                sizes = [len(m[0]) for m in made]
                signature = prob_minhash(
                    np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made]).astype(np.float64),
                    np.repeat(np.arange(len(made)), sizes), len(made), bands * rows,
                )
                keys = band_keys(signature, bands, rows).ravel()
                marks = signature.ravel().astype(np.uint8).view(np.int8)
                slots = pa.array(np.arange(0, len(marks) + 1, bands * rows), pa.int32())
                offsets = pa.array(np.arange(0, len(keys) + 1, bands), pa.int32())
                content = [xxhash.xxh3_128_digest(" ".join(t.lower().split())) for t in texts]
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(content, pa.binary()),
                     pa.ListArray.from_arrays(offsets, pa.array(keys), type=schema.field(3).type), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(slots, pa.array(marks), type=schema.field(5).type)],
                    schema=schema)

    return run


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, None
        for batch in batches:
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            keep = []
            for x, y, s, t in zip(a, b, text_a, text_b):
                if y != hub:
                    hub, own = y, shingles(t)
                keep.append(probability_jaccard(shingles(s), own) >= similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_groups(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of ``df``: ``__uid``, the id, class_id (id of the row that stays), class_size, kept."""
    if UID not in df.columns:
        df = numbered(df.select(id_col, text), "near-rows")
    spark, id_type = df.sparkSession, df.schema[id_col].dataType
    docs = df.select(UID, F.col(id_col).alias("__id"), text_of(text).alias("__text"))
    schema = T.StructType([
        T.StructField(UID, T.LongType()), T.StructField("__id", id_type), T.StructField("__content", T.BinaryType()),
        T.StructField("__bands", T.ArrayType(T.LongType())), T.StructField("__size", T.LongType()),
        T.StructField("__marks", T.ArrayType(T.ByteType())),
    ])
    signed = stage(docs.mapInArrow(_sign(bands, rows, arrow_schema(spark, schema)), schema), "signatures")
    best = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col(UID).alias("uid")))
    nodes = stage(signed.groupBy("__content").agg(best.alias("__best"), F.count(F.lit(1)).alias("__n")), "nodes")
    singles = nodes.select(F.col("__best.uid").alias(UID))
    found = signed.where("__size > 0").join(singles, UID, "left_semi").select(F.col(UID).alias("node"), F.explode("__bands").alias("band"))
    found = stage(found, "bands")
    shared = found.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1").drop("n")
    buckets = stage(found.join(shared, "band").withColumn("comp", F.col("node")), "buckets")
    texts = stage(
        docs.join(buckets.select(F.col("node").alias(UID)).distinct(), UID, "left_semi").select(F.col(UID).alias("node"), "__text"), "texts"
    )
    size = nodes.count()  # above FEW_PAIRS or eight a node the open pairs are not joined but met in blocks; both ways check all
    comps = _join_buckets(buckets, signed, texts, similarity, max(FEW_PAIRS, 8 * size), bands, rounds, max(1, size // NODES_PER_FILE))
    node = F.col("__best.uid")
    comp = comps.select(F.col("node").alias("__node"), "comp")
    placed = nodes.join(comp, node == F.col("__node"), "left").select(
        "__content", "__best", "__n", F.coalesce("comp", node).alias("__comp")
    )
    classes = placed.groupBy("__comp").agg(F.min("__best").alias("__keep"), F.sum("__n").alias("class_size"))
    verdict = placed.join(classes, "__comp").select("__content", "__keep", "class_size")
    return signed.select(UID, "__id", "__content").join(verdict, "__content").select(
        UID, F.col("__id").alias(id_col), F.col("__keep.id").alias("class_id"), "class_size", (F.col(UID) == F.col("__keep.uid")).alias("kept")
    )


def _join_buckets(buckets: DataFrame, signed: DataFrame, texts: DataFrame, similarity: float, few: int, bands: int, rounds: int, files: int) -> DataFrame:
    """Components of the nodes that share a band and are similar: ``node``, ``comp``.  Thin tables are written in ``files`` files.

    A node first meets one hub, the one it shares most bands with; its other hubs then only where they are of another component.
    """
    hubs = buckets.where("node != hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    hubs = stage(hubs.coalesce(files), "hubs")

    def tried(met: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The new pairs among ``met`` and those of them that are links."""
        pairs = met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs.coalesce(files), "pairs")
        return pairs, stage(verified(pairs, texts, similarity), "links")

    tested = None
    tested, linked = tried(hubs.groupBy("node").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub")))
    comps, opened, before = components(linked), buckets, 0
    for turn in count():
        if turn == 0:
            met = _apart(hubs, comps)
        else:
            left, opened = _open_buckets(opened, comps, files)  # a bucket of one component stays so
            if not left:
                break
            if left <= few:
                met = _shortlist(_across(opened, signed), signed, similarity)
            elif turn <= rounds or left <= 0.9 * before:
                met = _with_hubs(_refined(opened, signed, bands, turn, files), turn)
            else:
                return grown(comps, stage(_checked_in_blocks(opened, signed, texts, similarity), "links"))
            before = left
        pairs, linked = tried(met)
        tested = tested.unionByName(pairs)
        comps = grown(comps, linked)
        if turn and left <= few:
            break
    return comps


def _apart(hubs: DataFrame, comps: DataFrame) -> DataFrame:
    """The nodes and hubs that are not joined yet."""
    own = hubs.select("node", "hub").join(comps, "node", "left").select("node", "hub", F.coalesce("comp", "node").alias("comp"))
    of_hub = comps.select(F.col("node").alias("hub"), F.col("comp").alias("hub_comp"))
    return own.join(of_hub, "hub", "left").where(F.col("comp") != F.coalesce("hub_comp", "hub")).select("node", "hub")


def _with_hubs(buckets: DataFrame, turn: int) -> DataFrame:
    """Each member of a bucket with the bucket's hub, its least node by a hash, where they are not joined yet.

    Buckets of one component, those of one node among them, have no hub, so their rows are met by none.
    """
    order = F.xxhash64(F.lit(turn), "node")
    hubs = buckets.groupBy("band").agg(
        F.min(F.struct(order.alias("h"), "node", "comp")).alias("__h"), F.min("comp").alias("least"), F.max("comp").alias("most")
    )
    hubs = hubs.where("least < most").select("band", F.col("__h.node").alias("hub"), F.col("__h.comp").alias("hub_comp"))
    return buckets.join(hubs, "band").where("node != hub AND comp != hub_comp")


def _open_buckets(buckets: DataFrame, comps: DataFrame, files: int) -> tuple[int, DataFrame]:
    """How many pairs between different components share a band, and the buckets that hold them."""
    named = buckets.select("band", "node").join(comps, "node", "left").select("band", "node", F.coalesce("comp", "node").alias("comp"))
    named = stage(named.coalesce(files), "named")
    sizes = named.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("band").agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.count(F.lit(1)).alias("parts")
    )
    sizes = stage(sizes.where("parts > 1").coalesce(files), "open-bands")
    left = sizes.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()[0] or 0
    return int(left), stage(named.join(sizes.select("band"), "band").coalesce(files), "open")


def _refined(opened: DataFrame, signed: DataFrame, bands: int, turn: int, files: int) -> DataFrame:
    """The nodes of open buckets in finer buckets: those that share two bands, ``turn`` apart."""
    nodes = opened.select("node", "comp").distinct().join(signed.select(F.col(UID).alias("node"), "__bands"), "node")
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(F.element_at("__bands", i + 1), F.element_at("__bands", (i + turn) % bands + 1)),
    )
    return stage(nodes.select("node", "comp", F.explode(keys).alias("band")).coalesce(files), "refined")


def _across(opened: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs of different components in open buckets, each in the first band that the two share."""
    held = opened.join(signed.select(F.col(UID).alias("node"), F.col("__bands").alias("held")), "node")
    other = held.select("band", F.col("node").alias("hub"), F.col("comp").alias("hub_comp"), F.col("held").alias("hub_held"))
    first = F.element_at(F.array_intersect("held", "hub_held"), 1) == F.col("band")
    return held.join(other, "band").where((F.col("comp") < F.col("hub_comp")) & first).select("node", "hub")


def _shortlist(pairs: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose signatures agree in as many slots as five standard deviations below the asked-for similarity."""
    marks = signed.select(F.col(UID).alias("node"), F.col("__marks").alias("m"))
    other = marks.select(F.col("node").alias("hub"), F.col("m").alias("n"))
    agree = F.size(F.filter(F.zip_with("m", "n", lambda x, y: x == y), lambda same: same))
    low = F.lit(similarity) - 5 * F.sqrt(F.lit(similarity * (1 - similarity)) / F.size("m"))
    return pairs.join(marks, "node").join(other, "hub").where(agree >= low * F.size("m"))


def _links_of_block(similarity: float):
    """Links between different components in a block of a bucket: all pairs of one part, or those across two parts."""

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("part")
        part, node, root = (block.column(c).to_numpy() for c in ("part", "node", "comp"))
        root = root.copy()
        marks, held = (block.column(c).combine_chunks().flatten().to_numpy().reshape(len(node), -1) for c in ("m", "held"))
        texts, made = block.column("__text"), {}
        least = len(marks[0]) * (similarity - 5 * np.sqrt(similarity * (1 - similarity) / len(marks[0])))
        at = int(np.flatnonzero(held[0] == block.column("band")[0].as_py())[0])
        i, j = block.column("i")[0].as_py(), block.column("j")[0].as_py()
        split = int(np.searchsorted(part, i, side="right"))

        def bag(n: int) -> tuple[np.ndarray, np.ndarray]:
            if n not in made:
                made[n] = shingles(texts[n].as_py())
            return made[n]

        links: list[tuple[int, int]] = []
        for a in range(split):
            others = np.arange(a + 1 if i == j else split, len(node))
            others = others[root[others] != root[a]]
            others = others[np.count_nonzero(marks[others] == marks[a], axis=1) >= least]
            others = others[~(held[others, :at] == held[a, :at]).any(axis=1)]  # a pair belongs to the first band it shares
            for b in others.tolist():
                if root[b] != root[a] and probability_jaccard(bag(a), bag(b)) >= similarity:
                    links.append((node[a], node[b]))
                    root[root == root[b]] = root[a]  # what is joined needs no further link
        return pa.table({"a": pa.array([min(x) for x in links], pa.int64()), "b": pa.array([max(x) for x in links], pa.int64())})

    return run


def _checked_in_blocks(opened: DataFrame, signed: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join all similar nodes of different components in open buckets.

    A bucket's members are salted into parts of at most about BLOCK_NODES nodes and BLOCK_BYTES of text, and every two parts meet.
    """
    sized = opened.join(texts.select("node", F.octet_length("__text").alias("__b")), "node")
    parts = sized.groupBy("band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("__b") / BLOCK_BYTES)).cast("int").alias("parts")
    )
    salted = opened.join(parts, "band").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    met = salted.select("band", "node", "comp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    met = met.select("band", "node", "comp", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    own = signed.select(F.col(UID).alias("node"), F.col("__bands").alias("held"), F.col("__marks").alias("m"))
    return met.join(own, "node").join(texts, "node").groupBy("band", "i", "j").applyInArrow(_links_of_block(similarity), "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are as similar as asked."""
    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("__text").alias("ta")), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("__text").alias("tb")), "b")
    return with_b.select("a", "b", "ta", "tb").mapInArrow(_verify(similarity), "a bigint, b bigint")


def drop_near_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of near-duplicates, with its own columns."""
    rows = numbered(df, "near-rows")
    kept = near_groups(rows, text, id_col, similarity).where("kept").select(UID)
    return rows.join(kept, UID, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
