"""Best-fit packing of token pieces into sequences, improved by a swap-based local search.

Documents are encoded once, whole; those longer than a sequence are cut into full pieces and a rest.  Pieces are dealt
by hash into blocks that a task can hold; a block starts from best fit by decreasing length and then empties bins: from
the least filled bin, pieces are moved, exchanged one for one, or two for one, with other underfull bins whenever that makes the
fuller bin fuller, which raises the sum of squared fills at each step and so must end.  Bins that a block leaves
underfull, the emptiest first and at most half of its pieces, are opened again in the next round, in blocks over all of
them, until one block holds the rest; the number of rounds is the logarithm of the number of blocks.

Defined cases: null and empty texts are a piece of the end token alone; repeated rows and null ids are pieces of their
own; a text of any length is cut, never shortened; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import UID, stage, text_of
from .exact_dedup import arrow_schema
from .tokens import id_bytes, shared_encoder, vocabulary_path

CAPACITY = 4096
END_TOKEN = 1
BLOCK_PIECES = 20_000
OPEN_BELOW = 0.98


def _cut(path: str, capacity: int, end: bytes, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width, keep = shared_encoder(path, id_bytes), 4 * capacity, "ids" in schema.names
        for batch in batches:
            for i in range(0, batch.num_rows, 250):
                part = batch.slice(i, 250)
                texts = part.column(2).to_pylist()
                encoder.learn(texts)
                columns: list[list] = [[] for _ in schema]
                for uid, doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    ids = b"".join([*encoder.values(text), end])
                    for piece, at in enumerate(range(0, len(ids), width)):
                        own = ids[at : at + width]
                        row = (uid, doc, piece, at // 4, len(own) // 4, zlib.crc32(own), own) if keep else (uid, doc, piece, at // 4, len(own) // 4, zlib.crc32(own))
                        for c, v in zip(columns, row):
                            c.append(v)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def token_pieces(
    df: DataFrame, capacity: int = CAPACITY, text: str = "text", id_col: str = "doc_id", vocabulary: str | None = None,
    end_token: int = END_TOKEN, with_ids: bool = True,
) -> DataFrame:
    """Encoded pieces, written once: __uid, id, piece, start, length, ids_crc32 and, where wanted, ids (little-endian 32-bit)."""
    schema = (
        T.StructType().add(UID, "long").add(id_col, df.schema[id_col].dataType).add("piece", "integer").add("start", "long")
        .add("length", "long").add("ids_crc32", "long")
    )
    if with_ids:
        schema.add("ids", "binary")
    uid = F.col(UID) if UID in df.columns else F.monotonically_increasing_id()
    run = _cut(vocabulary or vocabulary_path(), capacity, id_bytes([end_token]), arrow_schema(df.sparkSession, schema))
    return stage(df.select(uid, F.col(id_col), text_of(text)).mapInArrow(run, schema), "pieces")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the bin with the smallest gap that takes it."""
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, open_gaps = [], 0  # bit g of open_gaps: some bin has gap g
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        size = lengths[i]
        fitting = open_gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps &= ~(1 << gap)
            bins[b].append(i)
        else:
            gap, b = capacity, len(bins)
            bins.append([i])
        if gap > size:
            by_gap[gap - size].append(b)
            open_gaps |= 1 << (gap - size)
    return bins


def _best_step(donor: list[int], receiver: list[int], gap: int) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    """The step that fills ``gap`` best: (gain, lengths that leave the donor, lengths that leave the receiver)."""
    best = (0, (), ())
    give = [(d, (d,)) for d in sorted(set(donor))]
    pairs = {(donor[i] + donor[j]): (donor[i], donor[j]) for i in range(len(donor)) for j in range(i)}
    both = give + sorted(pairs.items())
    singles = sorted(both)
    sizes, single_sizes = [s for s, _ in singles], [s for s, _ in give]

    def attempt(options, keys, back, returned):
        nonlocal best
        at = bisect_right(keys, back + gap) - 1
        if at >= 0 and keys[at] - back > best[0]:
            best = (keys[at] - back, options[at][1], returned)

    attempt(give, single_sizes, 0, ())
    for r in set(receiver):
        if best[0] == gap:
            return best
        attempt(singles, sizes, r, (r,))
    for back, returned in {receiver[i] + receiver[j]: (receiver[i], receiver[j]) for i in range(len(receiver)) for j in range(i)}.items():
        if best[0] == gap:
            return best
        attempt(give, single_sizes, back, returned)
    return best


def empty_bins(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """The local search: bins of piece numbers, as few as it can make them.

    Every step moves length from a bin to one at least as full, so squared fill rises.  A donor that found no step is
    not tried again, nor is its like, until some bin has changed; bins with equal contents count as one receiver.
    """
    bins = [list(b) for b in bins]
    fill = [sum(lengths[i] for i in b) for b in bins]
    size = [sorted(lengths[i] for i in b) for b in bins]
    least = max(-(-sum(fill) // capacity), sum(2 * n > capacity for n in lengths))
    alive = {b for b in range(len(bins)) if fill[b] < capacity}
    count, failed = len(bins), set()

    def shift(source: int, target: int, moved: tuple[int, ...]) -> None:
        for n in moved:
            i = next(i for i in bins[source] if lengths[i] == n)
            bins[source].remove(i)
            bins[target].append(i)
        for b in (source, target):
            size[b] = sorted(lengths[i] for i in bins[b])
            fill[b] = sum(size[b])

    while count > least:
        donor = min((b for b in alive if tuple(size[b]) not in failed), key=lambda b: (fill[b], b), default=None)
        if donor is None:
            break
        stuck, tried = True, set()
        for other in sorted(alive - {donor}, key=lambda b: (-fill[b], b)):
            if fill[donor] == 0 or fill[other] < fill[donor] or (key := tuple(size[other])) in tried:
                continue
            tried.add(key)
            while fill[donor] and fill[other] < capacity:
                gain, out, back = _best_step(size[donor], size[other], capacity - fill[other])
                if not gain:
                    break
                shift(donor, other, out)
                shift(other, donor, back)
                stuck = False
            if fill[other] == capacity:
                alive.discard(other)
        if fill[donor] == 0:
            alive.discard(donor)
            count -= 1
        if stuck:
            failed.add(tuple(size[donor]))
        else:
            failed.clear()
    return [b for b in bins if b]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    return empty_bins(best_fit(lengths, capacity), lengths, capacity)


def _pack_block(capacity: int, round_no: int, full: int, schema: pa.Schema):
    def run(block: pa.Table) -> pa.Table:
        n, lengths = block.num_rows, block.column("length").to_pylist()
        sequence, offset, opened = [0] * n, [0] * n, [0] * n
        first = (round_no << 56) | (block.column("__block")[0].as_py() << 24)
        fills = []
        for number, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = first | number, at
                at += lengths[i]
            fills.append((at, number, members))
        room = (n + 1) // 2
        for fill, _, members in sorted(fills):
            room -= len(members)
            if fill >= full or room < 0:
                break
            for i in members:
                opened[i] = 1
        columns = [block.column(f.name) for f in list(schema)[:-3]]
        return pa.table([*columns, *(pa.array(c, pa.int64()) for c in (sequence, offset, opened))], schema=schema)

    return run


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES, open_below: float = OPEN_BELOW
) -> DataFrame:
    """``pieces`` (with __uid, piece and length; without ids) placed: sequence_id and offset for each.

    Each round is written to the shared folder, so a lost executor costs one round's rows at most.
    """
    spark, done, round_no, block_pieces = pieces.sparkSession, None, 0, max(2, block_pieces)
    own = [c for c in pieces.columns if c != "ids"]
    left, count = pieces.select(*own), pieces.count()
    while True:
        blocks = max(1, -(-count // block_pieces))
        block = F.pmod(F.xxhash64(F.lit(round_no), UID, "piece"), F.lit(blocks)).alias("__block")
        schema = T.StructType(list(left.schema)).add("sequence_id", "long").add("offset", "long").add("__open", "long")
        packed = left.select("*", block).groupBy("__block").applyInArrow(
            _pack_block(capacity, round_no, int(open_below * capacity), arrow_schema(spark, schema)), schema
        )
        packed = stage(packed, "packed")
        if blocks == 1:
            final = packed.drop("__open")
            return final if done is None else done.unionByName(final)
        closed = packed.where("__open = 0").drop("__open")
        done = closed if done is None else done.unionByName(closed)
        left = packed.where("__open = 1").select(*own)
        count, round_no = left.count(), round_no + 1


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """Token ids per sequence, its pieces in the order of their offsets: sequence_id, length, ids (binary)."""
    joined = pieces.select(UID, "piece", "ids").join(placed.select(UID, "piece", "sequence_id", "offset", "length"), [UID, "piece"])
    parts = joined.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    return parts.select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def pack_documents(
    df: DataFrame, capacity: int = CAPACITY, text: str = "text", id_col: str = "doc_id", vocabulary: str | None = None
) -> DataFrame:
    """Placement of every piece of every document: id, piece, start, length, ids_crc32, sequence_id, offset."""
    placed = pack(token_pieces(df, capacity, text, id_col, vocabulary, with_ids=False), capacity)
    return placed.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
