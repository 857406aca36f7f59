"""Exact deduplication by Grace hashing: equal texts, compared by complete content, fold into one group.

Three steps.  (1) Every task folds the copies inside its own rows in an open-addressing table and writes one thin
row per document plus one row with the text per distinct local text: a text that fills a third of the table leaves
each task once.  (2) The local texts are hash-partitioned; a partition that outgrows its memory budget is split
again, with another hash seed at each level, into spill files of the task until every bucket fits a table.
(3) Documents meet the verdict on their local text by that text's row number, which no more rows share than one
task has read.

Defined cases: a null text counts as empty; texts are equal when identical after each run of white space becomes
one blank; the row with the smallest id stays, null ids last, and of repeated ids the row that was read first;
an empty table gives an empty result; other columns are ignored by ``exact_groups`` and returned unchanged by
``drop_copies``, whatever their names (names that start with two underscores are reserved).
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import UID, numbered, stage, text_of

TABLE_BYTES = 48 << 20
FANOUT = 16
WHITE = b" \t\n\r\x0b\x0c"


def squeeze(text: bytes) -> bytes:
    """Each run of [space, \\t, \\n, \\v, \\f, \\r] becomes one blank."""
    words = text.split()
    if not words:
        return b" " if text else b""
    return (b" " if text[0] in WHITE else b"") + b" ".join(words) + (b" " if text[-1] in WHITE else b"")


class ContentTable:
    """Open addressing with linear probing; a hit needs equal hashes and equal contents."""

    def __init__(self, slots: int = 1024):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, content: bytes, h: int) -> tuple[int, int]:
        """(entry, slot): the entry that holds ``content``, or -1 and the free slot where it belongs."""
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry, at
            at = (at + 1) & mask
        return -1, at

    def insert(self, content: bytes, h: int, slot: int) -> int:
        entry = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 100
        self.slots[slot] = entry
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        size = 4 * len(self.slots)
        self.slots = [-1] * size
        for entry, h in enumerate(self.hashes):
            at = h & (size - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slots[at] = entry


def _order(row_id, uid):
    return (row_id is None, 0 if row_id is None else row_id, uid)


def _fold_locally(table_bytes: int, schema: pa.Schema):
    """Map side: one thin row per document and, per table filled, one row with the text per distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, groups, shas = ContentTable(), [], []

        def flush() -> pa.RecordBatch:
            ids, uids = [g[2] for g in groups], [g[3] for g in groups]
            n = len(groups)
            return pa.record_batch(
                [pa.nulls(n, schema.field(0).type), pa.nulls(n, schema.field(1).type), pa.array([g[0] for g in groups], pa.int64()),
                 pa.nulls(n, pa.string()), pa.array([h - (1 << 63) for h in table.hashes], pa.int64()),
                 pa.array([g[1] for g in groups], pa.int64()), pa.array(ids, schema.field(6).type),
                 pa.array(uids, pa.int64()), pa.array(table.contents, pa.binary())], schema=schema)

        for batch in batches:
            uids, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            reps, digests = [], []
            for uid, row_id, text in zip(uids, ids, batch.column(2).cast(pa.binary()).to_pylist()):
                content = squeeze(text)
                h = xxhash.xxh3_64_intdigest(content)
                entry, slot = table.find(content, h)
                if entry < 0:
                    if table.bytes > table_bytes:
                        yield flush()
                        table, groups, shas = ContentTable(), [], []
                        entry, slot = table.find(content, h)
                    entry = table.insert(content, h, slot)
                    groups.append([uid, 0, row_id, uid])
                    shas.append(hashlib.sha256(content).hexdigest())
                g = groups[entry]
                g[1] += 1
                if _order(row_id, uid) < _order(g[2], g[3]):
                    g[2:] = row_id, uid
                reps.append(g[0])
                digests.append(shas[entry])
            n = len(uids)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(reps, pa.int64()), pa.array(digests, pa.string()),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, schema.field(6).type),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], schema=schema)
        if groups:
            yield flush()

    return run


def grace_fold(rows: Iterator[tuple], table_bytes: int, level: int, folder: str) -> Iterator[list]:
    """Groups of equal content among (content, n, best_id, best_uid, rep) rows: [n, best_id, best_uid, reps].

    A text enters the table while there is room; afterwards rows of other texts go to spill files by this level's
    hash, and each file is folded in turn.  A text is either in the table from its first row on or never.
    """
    table, groups, spills = ContentTable(), [], {}
    for content, n, best_id, best_uid, rep in rows:
        h = xxhash.xxh3_64_intdigest(content, level + 1)
        entry, slot = table.find(content, h)
        if entry < 0:
            if table.bytes > table_bytes:
                bucket = (h >> 40) % FANOUT
                if bucket not in spills:
                    spills[bucket] = open(os.path.join(folder, f"{level}-{bucket}"), "wb")
                pickle.dump((content, n, best_id, best_uid, rep), spills[bucket])
                continue
            entry = table.insert(content, h, slot)
            groups.append([0, best_id, best_uid, []])
        g = groups[entry]
        g[0] += n
        g[3].append(rep)
        if _order(best_id, best_uid) < _order(g[1], g[2]):
            g[1:3] = best_id, best_uid
    yield from groups
    del table, groups
    for f in spills.values():
        f.close()
    for f in spills.values():
        with tempfile.TemporaryDirectory(dir=folder) as inner:
            yield from grace_fold(_reread(f.name), table_bytes, level + 1, inner)
        os.unlink(f.name)


def _reread(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _fold_partition(table_bytes: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            for n, best_id, best_uid, reps in grace_fold(rows, table_bytes, 0, folder):
                out.extend((rep, best_id, best_uid, n) for rep in reps)
                if len(out) >= 10_000:
                    yield made()
                    out.clear()
            if out:
                yield made()

    return run


def exact_groups(df: DataFrame, text: str = "text", id_col: str = "doc_id", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``df``: ``__uid``, the id, keep_id, group_size, kept and text_sha256.

    ``df`` may carry ``__uid`` (see ``numbered``); otherwise rows are numbered here.
    """
    spark, id_type = df.sparkSession, df.schema[id_col].dataType
    uid = F.col(UID) if UID in df.columns else F.monotonically_increasing_id().alias(UID)
    thin = df.select(uid, F.col(id_col).alias("__id"), text_of(text).alias("__text"))
    folded = T.StructType([
        T.StructField(UID, T.LongType()), T.StructField("__id", id_type), T.StructField("__rep", T.LongType()),
        T.StructField("__sha", T.StringType()), T.StructField("__hash", T.LongType()), T.StructField("__n", T.LongType()),
        T.StructField("__best_id", id_type), T.StructField("__best", T.LongType()), T.StructField("__content", T.BinaryType()),
    ])
    local = stage(thin.mapInArrow(_fold_locally(table_bytes, arrow_schema(spark, folded)), folded), "exact")
    verdict_type = T.StructType([
        T.StructField("__rep", T.LongType()), T.StructField("keep_id", id_type),
        T.StructField("__best", T.LongType()), T.StructField("group_size", T.LongType()),
    ])
    verdicts = (
        local.where(F.col("__n").isNotNull())
        .repartition("__hash")
        .select("__content", "__n", "__best_id", "__best", "__rep")
        .mapInArrow(_fold_partition(table_bytes, arrow_schema(spark, verdict_type)), verdict_type)
    )
    members = local.where(F.col("__n").isNull()).select(UID, "__id", "__rep", "__sha")
    return members.join(verdicts, "__rep").select(
        UID, F.col("__id").alias(id_col), "keep_id", "group_size",
        (F.col(UID) == F.col("__best")).alias("kept"), F.col("__sha").alias("text_sha256"),
    )


def arrow_schema(spark, schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def drop_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``df`` that stay, with their own columns."""
    rows = numbered(df, "exact-rows")
    kept = exact_groups(rows, text, id_col, table_bytes).where("kept").select(UID)
    return rows.join(kept, UID, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
