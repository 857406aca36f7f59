"""Vector code compression: product codebooks fitted by exact integer k-means that skips scans by norm-of-sum bounds.

A vector's components become integers; its consecutive parts are each coded by the nearest of up to 256 entries of the part's codebook.
Every part of every vector keeps its entry, an upper bound on the distance to it, a lower bound on the distance to all
other entries, and the round at which each bound was exact.  The codebooks of all rounds are retained (a few hundred entries each), so
a bound is carried to the present by the true distance between the entry then and now - the norm of the sum of its moves, never more than
the sum of their norms.  A part whose upper bound stays below its lower bound keeps its entry; else the upper bound is made
exact; only if that does not settle it are all entries scanned.  Bounds are rounded outwards, so the result is that of plain k-means.

A round is one pass over the written rows of the last.  It writes the rows with their new state and, from each task, what the moved
parts add to and take from the sums of their entries; these differences are summed by entry and the codebooks (bounded by their
parameters) are renewed on the driver.  No step groups rows, so copies of one vector in any number are spread as they were read.

Defined cases: a vector is dropped when it is null, holds null or a non-finite component, or is not as long as the kept vector of the smallest
id; components are held to +-16384 before scaling, so that distances are exact; lengths that the number of parts does not divide are
cut as evenly as possible; null ids come after all others, and equal ids are ordered by their vectors; null labels are one label;
fewer vectors than entries make shorter codebooks; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage
from .exact_dedup import arrow_schema

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = 16384.0
CHUNK = 4096
SAFE = 1e-9


@dataclass
class Codebooks:
    """``books[part]``: entries by position, integers.  ``scans``: by assignment, how many parts were scanned in full."""

    books: list[np.ndarray]
    scans: list[int]
    rows: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.books for v in book.ravel().tolist()).encode()).hexdigest()


def cuts(width: int, parts: int) -> list[slice]:
    return [slice(width * p // parts, width * (p + 1) // parts) for p in range(parts)]


def whole_numbers(scale: int, schema: pa.Schema):
    """Rows with usable vectors, their components as integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
            offsets = np.asarray(lists.offsets)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            good = (bad[offsets[1:]] == bad[offsets[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
            flat = np.nan_to_num(np.clip(flat, -LARGEST, LARGEST))
            numbers = pa.ListArray.from_arrays(lists.offsets, pa.array(np.floor(flat * scale).astype(np.int32)))
            keep = pa.array(good)
            columns = [batch.column(0), batch.column(1), numbers]
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], schema=schema)

    return run


def square_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries: by a product of matrices where doubles hold them, else by position."""
    largest = max((int(np.abs(a).max(initial=0)) for a in (x, book)), default=0)
    if 4 * largest * largest * max(1, x.shape[1]) < 1 << 53:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    out = np.zeros((len(x), len(book)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - book[None, :, i]) ** 2
    return out


def own_distances(x: np.ndarray, book: np.ndarray, entry: np.ndarray) -> np.ndarray:
    return ((x - book[entry]) ** 2).sum(1)


class Moves:
    """How far the entries of one part's codebook have come since each round; ``others[s, a]`` is the farthest of all but entry a."""

    def __init__(self, history: list[np.ndarray]):
        now = history[-1].astype(np.float64)
        self.own = self.others = np.array([np.sqrt(((then - now) ** 2).sum(1)) for then in history])
        if not len(now):
            return
        farthest = self.own.argmax(1)
        rest = self.own.copy()
        rest[np.arange(len(rest)), farthest] = 0
        self.others = np.repeat(self.own.max(1, keepdims=True), self.own.shape[1], 1)
        self.others[np.arange(len(rest)), farthest] = rest.max(1)


@dataclass
class State:
    """Of a batch, by row and part: entry (-1: none yet), bounds and the rounds at which they were exact."""

    entry: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    upper_at: np.ndarray
    lower_at: np.ndarray

    @classmethod
    def new(cls, n: int, parts: int) -> State:
        whole, real = (lambda v: np.full((n, parts), v, np.int32)), (lambda v: np.full((n, parts), v, np.float32))
        return cls(whole(-1), real(np.inf), real(0), whole(0), whole(0))


def assign_part(x: np.ndarray, history: list[np.ndarray], moves: Moves, state: State, p: int) -> int:
    """Brings part ``p`` of ``state`` to the last codebook of ``history``; the number of rows that were scanned in full."""
    now, book = len(history) - 1, history[-1]
    entry = state.entry[:, p]
    open_rows = np.flatnonzero(entry < 0)
    held = np.flatnonzero(entry >= 0)
    if len(held):
        own = entry[held]
        upper = state.upper[held, p].astype(np.float64) + moves.own[state.upper_at[held, p], own]
        lower = (state.lower[held, p].astype(np.float64) - moves.others[state.lower_at[held, p], own]) * (1 - SAFE)
        unsure = upper * (1 + SAFE) >= lower
        held, lower = held[unsure], lower[unsure]
        exact = np.sqrt(own_distances(x[held], book, entry[held]).astype(np.float64))
        state.upper[held, p] = np.nextafter(exact.astype(np.float32), np.float32(np.inf))
        state.upper_at[held, p] = now
        open_rows = np.concatenate([open_rows, held[exact * (1 + SAFE) >= lower]])
    for i in range(0, len(open_rows), CHUNK):
        rows = open_rows[i : i + CHUNK]
        far = square_distances(x[rows], book)
        nearest = far.argmin(1)  # the first of equals
        at = np.arange(len(rows))
        least = far[at, nearest]
        far = far.astype(np.float64)
        far[at, nearest] = np.inf
        state.entry[rows, p] = nearest
        state.upper[rows, p] = np.nextafter(np.sqrt(least.astype(np.float64)).astype(np.float32), np.float32(np.inf))
        state.lower[rows, p] = np.nextafter(np.sqrt(far.min(1)).astype(np.float32), np.float32(0))
        state.upper_at[rows, p] = state.lower_at[rows, p] = now
    return len(open_rows)


STATE = [("entry", np.int32), ("upper", np.float32), ("lower", np.float32), ("upper_at", np.int32), ("lower_at", np.int32)]


def _read(batch: pa.RecordBatch, width: int, parts: int) -> tuple[np.ndarray, State]:
    n = batch.num_rows

    def flat(name: str, dtype, columns: int) -> np.ndarray:
        held = batch.column(batch.schema.get_field_index(name))
        return held.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, columns)

    known = batch.schema.get_field_index("entry") >= 0
    state = State(*(flat(name, dtype, parts) for name, dtype in STATE)) if known else State.new(n, parts)
    return flat("x", np.int64, width), state


def _lists(a: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, k = a.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(a.ravel(), kind))


def _round(history, width: int, parts: int, schema: pa.Schema):
    """One round: rows with their new state, then the task's differences by part and entry (entry -1: the number of full scans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, at = history.value, cuts(width, parts)
        moves = [Moves(h) for h in books]
        sums = [np.zeros((len(h[-1]), s.stop - s.start), np.int64) for h, s in zip(books, at)]
        counts, scans = [np.zeros(len(h[-1]), np.int64) for h in books], [0] * parts
        for batch in batches:
            if not batch.num_rows:
                continue
            x, state = _read(batch, width, parts)
            before = state.entry.copy()
            for p in range(parts):
                own = x[:, at[p]]
                scans[p] += assign_part(own, books[p], moves[p], state, p)
                moved = np.flatnonzero(state.entry[:, p] != before[:, p])
                left = moved[before[moved, p] >= 0]
                for rows, entries, sign in ((moved, state.entry[moved, p], 1), (left, before[left, p], -1)):
                    np.add.at(counts[p], entries, sign)
                    np.add.at(sums[p], entries, sign * own[rows])
            kinds = [schema.field(name).type.value_type for name, _ in STATE]
            made = [_lists(getattr(state, name), kind) for (name, _), kind in zip(STATE, kinds)]
            none = [pa.nulls(batch.num_rows, schema.field(name).type) for name in ("part", "of_entry", "n", "total")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made, *none], schema=schema)
        rows = [(p, -1, scans[p], []) for p in range(parts)]
        for p in range(parts):
            met = np.flatnonzero((counts[p] != 0) | (sums[p] != 0).any(1))
            rows += [(p, int(e), int(counts[p][e]), sums[p][e].tolist()) for e in met]
        blank = [pa.nulls(len(rows), f.type) for f in list(schema)[:-4]]
        told = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[-4:])]
        yield pa.RecordBatch.from_arrays([*blank, *told], schema=schema)

    return run


def _coded(history, width: int, parts: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, at = history.value, cuts(width, parts)
        moves = [Moves(h) for h in books]
        for batch in batches:
            x, state = _read(batch, width, parts)
            error, scans = np.zeros(batch.num_rows, np.int64), 0
            for p in range(parts):
                scans += assign_part(x[:, at[p]], books[p], moves[p], state, p)
                error += own_distances(x[:, at[p]], books[p][-1], state.entry[:, p])
            hexed = state.entry.astype(np.uint8).tobytes().hex()
            codes = [hexed[i : i + 2 * parts] for i in range(0, len(hexed), 2 * parts)] if parts else [""] * batch.num_rows
            scanned = np.zeros(batch.num_rows, np.int64)
            scanned[:1] = scans
            made = [pa.array(codes, pa.string()), pa.array(error), pa.array(scanned)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], schema=schema)

    return run


def compress(
    df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, vector: str = "embedding",
    id_col: str = "vec_id", label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error) of every kept vector, written, and the codebooks.  ``entries`` is at most 256, a code two hex digits a part."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark = df.sparkSession
    kinds = {c: df.schema[c].dataType for c in (id_col, label)}
    known = T.StructType().add(id_col, kinds[id_col]).add(label, kinds[label])
    numbers = T.StructType(list(known)).add("x", T.ArrayType(T.IntegerType()))
    read = df.select(id_col, label, F.col(vector).cast("array<double>").alias("x"))
    rows = stage(read.mapInArrow(whole_numbers(scale, arrow_schema(spark, numbers)), numbers), "vectors")

    ordered = [F.asc_nulls_last(id_col), "x"]
    first = rows.orderBy(*ordered).limit(1).collect()
    width = len(first[0].x) if first else 0
    rows = rows.where(F.size("x") == width)
    least = rows.orderBy(*ordered).limit(entries).collect()
    start = np.array([r.x for r in least], np.int64).reshape(len(least), width)
    at = cuts(width, parts)
    history = [[start[:, s]] for s in at]
    sums = [np.zeros_like(h[0]) for h in history]
    counts = [np.zeros(len(start), np.int64) for _ in at]

    schema = T.StructType(list(numbers))
    for name, dtype in STATE:
        schema.add(name, T.ArrayType(T.FloatType() if dtype is np.float32 else T.IntegerType()))
    schema.add("part", "integer").add("of_entry", "integer").add("n", "long").add("total", T.ArrayType(T.LongType()))
    scans = []
    for _ in range(rounds if first else 0):
        known_books = spark.sparkContext.broadcast(history)
        written = stage(rows.mapInArrow(_round(known_books, width, parts, arrow_schema(spark, schema)), schema), "codes-round")
        told = written.where("part IS NOT NULL").select("part", "of_entry", "n", "total")
        by_entry = told.groupBy("part", "of_entry").agg(F.sum("n").alias("n")).collect()
        scans.append(sum(r.n for r in by_entry if r.of_entry < 0))
        for r in by_entry:
            if r.of_entry >= 0:
                counts[r.part][r.of_entry] += r.n
        by_place = told.where("of_entry >= 0").select("part", "of_entry", F.posexplode("total"))
        for r in by_place.groupBy("part", "of_entry", "pos").agg(F.sum("col").alias("s")).collect():
            sums[r.part][r.of_entry, r.pos] += r.s
        for h, s, n in zip(history, sums, counts):
            h.append(np.where(n[:, None] > 0, s // np.maximum(n, 1)[:, None], h[-1]))
        rows = written.where("part IS NULL").drop("part", "of_entry", "n", "total")
    coded = T.StructType(list(known)).add("code", "string").add("error", "long").add("__scans", "long")
    last = spark.sparkContext.broadcast(history)
    codes = stage(rows.mapInArrow(_coded(last, width, parts, arrow_schema(spark, coded)), coded), "codes")
    told = codes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("__scans"), F.lit(0)).alias("s")).first()
    return codes.drop("__scans"), Codebooks([h[-1] for h in history], [*scans, told.s], told.n)


def decode(codes: DataFrame, books: Codebooks, scale: int = SCALE, code: str = "code") -> DataFrame:
    """``codes`` with the ``vector`` that each code stands for: the middles of its entries' integer steps, in the first scale."""
    held = codes.sparkSession.sparkContext.broadcast(books.books)
    schema = T.StructType([*codes.schema, T.StructField("vector", T.ArrayType(T.DoubleType()))])
    at, made = codes.columns.index(code), arrow_schema(codes.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry = np.frombuffer(bytes.fromhex("".join(batch.column(at).to_pylist())), np.uint8).reshape(batch.num_rows, -1)
            x = np.concatenate([(book[entry[:, p]] + 0.5) / scale for p, book in enumerate(held.value)], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(x, pa.float64())], schema=made)

    return codes.mapInArrow(run, schema)


def with_label_errors(codes: DataFrame, label: str = "label") -> DataFrame:
    """``codes`` with ``label_error``: the error summed over rows of the same label, nulls together."""
    totals = codes.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")
