"""SentencePiece encoding and decoding as a relational lattice.

Encoding.  Texts are cut into words wherever no piece can cross, that is between two characters that no piece holds side by side; every
distinct word of the corpus is encoded once.  Pieces that their own best split beats in score are on no best path and are left out first.  A word's substrings up to
the longest piece are exploded and met with the piece table by an equi-join; the edges found, packed into one long each, are grouped by word
and folded with Spark's ``aggregate`` into the path of the best summed score: the edges come in the order of their ends, each is touched
once, and the state holds the scores of the last positions that a piece can reach back to.  Characters without a piece become the model's byte
pieces.  Words are spread over tasks by the size of their lattices, and a word of any length is exploded window by window and folded in
time in proportion to its length.  ``fold="merges"`` gives instead the ids that a BPE model's own library gives, which the best path of its
scores is not: the words go through the model's merges, best score first.

Words come back to their documents in two ways: the frequent ones, at most ``hot``, as a dictionary sent to the tasks; all others by a join on the
word.  Documents are taken in blocks of neighbours: a block names each of its rare words once, and its texts are moved once, compressed.

Decoding joins nothing: each id's bytes are looked up in one array of pieces and the bytes of a document are decoded together.

Defined cases: null and empty texts have no ids and decode to the empty text; the marker character in a text is read as a
blank, as the library does; repeated rows are encoded each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import UID, stage, text_of
from .exact_dedup import arrow_schema

BLANK = "▁"
HOT_WORDS = 400_000
RUNS = regex.compile(rf"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n").findall
#: Blank-separated units, and characters read, that a task counts before it gives out their words.
COUNTED_UNITS, COUNTED_CHARS = 500_000, 64_000_000
#: Starts of a word that are exploded together, positions whose choices are kept in one array, and substrings for one task.
WINDOW = 256
RUN = 64
TASK_SUBSTRINGS = 2_000_000
#: Documents whose words, rare words and ids a task holds as Python objects at a time.
HELD_ROWS = 500
#: A block of documents ends with the row that reaches one of these.
BLOCK_BYTES = 16_000_000
BLOCK_ROWS = 16_384
#: An edge in one long: its end above bit 32, its size above bit 24, and an id or, under the flag, a character without a piece.
END_BIT, SIZE_BIT, UNKNOWN = 32, 24, 1 << 23
NORMAL, BYTE, UNIGRAM, BPE = 1, 6, 1, 2


@dataclass
class PieceModel:
    """Pieces of a SentencePiece model: a small table whose size is the vocabulary's."""

    pieces: list[tuple[int, str, float]]
    kind: int
    first_byte: int
    hex_of: list[str]
    word_pattern: str
    longest: int
    unknown_score: float

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.pieces, "id int, piece string, score double")


def load_model(path: str) -> PieceModel:
    """Models with byte pieces, an identity normaliser and the leading blank that the library adds by default."""
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    rules = m.normalizer_spec
    if not m.trainer_spec.byte_fallback or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
        raise ValueError("a model with byte pieces, the identity normaliser and a leading blank is needed")
    pieces = [(i, p.piece, float(p.score)) for i, p in enumerate(m.pieces) if p.type == NORMAL]
    spelled = [p.piece.replace(BLANK, " ").encode().hex() if p.type == NORMAL else "" for p in m.pieces]
    first = next(i for i, p in enumerate(m.pieces) if p.type == BYTE)
    spelled[first : first + 256] = [f"{b:02x}" for b in range(256)]
    if any(len(p) > 255 for _, p, _ in pieces) or len(m.pieces) > UNKNOWN:
        raise ValueError("pieces do not fit a packed edge")
    if any(BLANK in p.lstrip(BLANK) or "\n" in p for _, p, _ in pieces):
        raise ValueError("pieces cross the white space between words")
    latin = "A-Za-zÀ-ɏ"
    crossing = any(regex.search(f"[{latin}]", p) and regex.search(f"[^{latin}{BLANK}]", p) for _, p, _ in pieces)
    inside = rf"{BLANK}*[^{BLANK}\n]+" if crossing else rf"{BLANK}*[{latin}]+|{BLANK}*[^{BLANK}\n{latin}]+"
    pattern = rf"{inside}|{BLANK}+|\n"
    low = min(s for _, _, s in pieces)
    return PieceModel(pieces, m.trainer_spec.model_type, first, spelled, pattern, max(len(p) for _, p, _ in pieces), low - 10.0)


def _find_words(pattern: str):
    find = regex.compile(pattern).findall
    return lambda text: find(BLANK + text.replace(" ", BLANK)) if text else []


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, HELD_ROWS):
            yield batch.slice(at, HELD_ROWS)


def _units(text: str) -> list[str]:
    """The text between its single blanks, which stand before each unit but one that starts with a line's end.

    A text in which blanks meet is cut before runs of blanks and at its lines' ends; such units are marked by one more blank character.
    """
    if not text:
        return []
    spaced = text.replace(BLANK, " ").replace("\n", " \n")
    if spaced[0] == " " or "  " in spaced:
        return [BLANK + u for u in RUNS(BLANK + text.replace(" ", BLANK))]
    return spaced.split(" ")


def _different_units(texts: list[str]) -> list[str]:
    units: dict[str, None] = {}
    for t in texts:
        units.update(dict.fromkeys(_units(t)))
    return [*units]


def neighbours(pieces: list[tuple[int, str, float]]) -> np.ndarray:
    """All pairs of characters that some piece holds side by side, in order."""
    return np.array(sorted({ord(a) << 32 | ord(b) for _, p, _ in pieces for a, b in zip(p, p[1:])}), np.uint64)


def _cut(units: list[str], joined: np.ndarray) -> tuple[list[str], list[int]]:
    """The words of all units, cut between characters that no piece joins, and where each unit's words start and the last ones end."""
    if not units:
        return [], [0]
    texts = [u[1:] if u.startswith(BLANK) else u if u.startswith("\n") else BLANK + u for u in units]
    whole = "".join(texts)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    pairs = codes[:-1] << np.uint64(32) | codes[1:]
    starts = np.cumsum([0, *map(len, texts)])
    apart = np.ones(len(codes) + 1, bool)
    if len(joined):
        apart[1:-1] = joined[np.minimum(np.searchsorted(joined, pairs), len(joined) - 1)] != pairs
    apart[starts] = True
    ends = np.flatnonzero(apart)
    at = ends.tolist()
    return [whole[a:b] for a, b in zip(at, at[1:])], np.searchsorted(ends, starts).tolist()


def _different_words(joined: np.ndarray) -> Callable[[list[str]], list[str]]:
    """Words of several texts in the order of their first units; a word may come again."""
    return lambda texts: _cut(_different_units(texts), joined)[0]


def _count_words(joined: np.ndarray):
    """Words of a task's texts with their counts, given out whenever COUNTED_UNITS are held or COUNTED_CHARS are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, read = Counter(), 0

        def told() -> pa.RecordBatch:
            words, starts = _cut([*units], joined)
            counts: dict[str, int] = {}
            for w, n in zip(words, np.repeat([*units.values()], np.diff(starts)).tolist()):
                counts[w] = counts.get(w, 0) + n
            units.clear()
            return pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], ["word", "n"])

        for batch in _slices(batches):
            for text in batch.column(0).to_pylist():
                units.update(_units(text))
                read += len(text)
                if len(units) > COUNTED_UNITS or read > COUNTED_CHARS:
                    yield told()
                    read = 0
        yield told()

    return run


def needed_pieces(model: PieceModel) -> list[tuple[int, str, float]]:
    """The pieces that can be on a best path: those whose own best split into others does not beat them."""
    score_of = {p: score for _, p, score in model.pieces}

    def split(piece: str) -> float:
        best = [0.0] + [float("-inf")] * len(piece)
        for end in range(1, len(piece) + 1):
            for start in range(end):
                part = piece[start:end]
                if len(part) < len(piece):
                    own = score_of.get(part, model.unknown_score if end - start == 1 else float("-inf"))
                    best[end] = max(best[end], best[start] + own)
        return best[-1]

    # a margin for the rounding of sums
    return [(i, p, score) for i, p, score in model.pieces if len(p) == 1 or split(p) <= score + 1e-9 * abs(score)]


def lattice(words: DataFrame, model: PieceModel) -> DataFrame:
    """``wid``, ``word`` and its edges, packed and in the order of their ends; ``words`` has wid and word, one row each.

    Every character has an edge, its own piece or, without one, its code point under the flag.
    """
    n, longest = F.length("word"), model.longest
    size = words.agg(F.sum(n * F.least(n, F.lit(longest)))).first()[0] or 0
    spread = words.repartition(max(1, -(-size // TASK_SUBSTRINGS)), "wid")
    windows = spread.select("wid", "word", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / WINDOW).cast("int"))).alias("k"))
    cut = windows.select("wid", "word", (F.col("k") * WINDOW).alias("at"), F.substr("word", F.col("k") * WINDOW + 1, F.lit(WINDOW + longest - 1)).alias("t"))
    # starts and sizes are exploded one after the other, which stays compiled; start 0 of the first window is the word itself, in one row of its own
    first = F.when(F.col("at") == 0, 0).otherwise(1)
    starts = cut.select("*", F.explode(F.sequence(first, F.least(F.lit(WINDOW), F.length("t")))).alias("s"))
    own = F.col("s") == 0
    most = F.when(own, 0).otherwise(F.least(F.lit(longest), F.length("t") - F.col("s") + 1))
    sizes = starts.select("*", F.explode(F.sequence(F.when(own, 0).otherwise(1), most)).alias("k"))
    head = F.shiftleft((F.col("at") + F.col("s") - 1 + F.col("k")).cast("bigint"), END_BIT) + F.shiftleft(F.col("k").cast("bigint"), SIZE_BIT)
    subs = sizes.select(
        "wid", F.when(own, F.col("word")).alias("word"), F.when(~own, head).alias("head"), F.when(~own, F.substr("t", F.col("s"), F.col("k"))).alias("piece")
    )
    known = subs.join(F.broadcast(model.table(words.sparkSession).select("piece", "id")), "piece", "left")
    single = F.shiftright("head", SIZE_BIT).bitwiseAND(255) == 1
    edge = F.when(F.col("id").isNotNull(), F.col("head") + F.col("id")).when(single, F.col("head") + UNKNOWN + F.ascii("piece"))
    rows = known.select("wid", "word", edge.alias("edge")).where("word IS NOT NULL OR edge IS NOT NULL")
    return rows.groupBy("wid").agg(F.max("word").alias("word"), F.sort_array(F.collect_list("edge")).alias("edges"))


def _kept(state: Column, value: Column) -> list[Column]:
    """``tail`` and ``full`` of a state with one more value: arrays of RUN, so that a long word's choices are not copied at every step."""
    filled = F.size(state["tail"]) >= RUN
    return [
        F.when(filled, F.array(value)).otherwise(F.array_append(state["tail"], value)).alias("tail"),
        F.when(filled, F.array_append(state["full"], state["tail"])).otherwise(state["full"]).alias("full"),
    ]


def _all(state: Column) -> Column:
    """The values kept, in their order; ``full`` starts with one empty array."""
    return F.when(F.size(state["full"]) == 1, state["tail"]).otherwise(F.concat(F.flatten(state["full"]), state["tail"]))


def best_path(model: PieceModel) -> Column:
    """Ids of the path with the best summed score over ``edges``; of equal paths the one reached from the leftmost start."""
    scores = [0.0] * (1 + max((i for i, _, _ in model.pieces), default=0))
    for i, _, score in model.pieces:
        scores[i] = score
    score_of = F.split(F.lit(",".join(map(repr, scores))), ",").cast("array<double>")
    longs = F.array().cast("array<bigint>")
    start = F.struct(
        F.struct(F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("edge")).alias("best"),
        F.array().cast("array<double>").alias("back"), longs.alias("tail"), F.array(longs).cast("array<array<bigint>>").alias("full"),
    )

    def step(state: Column, edge: Column) -> Column:
        """Of the edges with one end that of size 1 comes first, and every end has it; ``back`` has the scores before the end, nearest first."""
        size = F.shiftright(edge, SIZE_BIT).bitwiseAND(255).cast("int")
        # a character without a piece is beyond the scores
        own = F.coalesce(F.get(score_of, edge.bitwiseAND((1 << SIZE_BIT) - 1).cast("int")), F.lit(model.unknown_score))
        best, back = state["best"], state["back"]
        longer = F.array_prepend(back, best["score"])
        later = F.struct(
            F.struct((best["score"] + own).alias("score"), edge.alias("edge")).alias("best"),
            F.when(F.size(back) < 2 * model.longest, longer).otherwise(F.slice(longer, 1, model.longest)).alias("back"), *_kept(state, best["edge"]),
        )
        # of equal scores the greater edge is the longer one
        reached = F.struct((F.get(back, size - 1) + own).alias("score"), edge.alias("edge"))
        same = F.struct(F.greatest(best, reached).alias("best"), back.alias("back"), state["tail"].alias("tail"), state["full"].alias("full"))
        return F.when(size == 1, later).otherwise(same)

    def choices(state: Column) -> Column:
        return F.slice(F.array_append(_all(state), state["best"]["edge"]), 2, 1 << 30)

    def back_step(state: Column, choice: Column) -> Column:
        passed = F.struct((state["skip"] - 1).alias("skip"), state["tail"].alias("tail"), state["full"].alias("full"))
        taken = F.struct((F.shiftright(choice, SIZE_BIT).bitwiseAND(255) - 1).alias("skip"), *_kept(state, choice.bitwiseAND((1 << SIZE_BIT) - 1)))
        return F.when(state["skip"] > 0, passed).otherwise(taken)

    def taken(chosen: Column) -> Column:
        none = F.struct(F.lit(0).cast("bigint").alias("skip"), longs.alias("tail"), F.array(longs).cast("array<array<bigint>>").alias("full"))
        return F.aggregate(F.reverse(chosen), none, back_step, lambda s: F.reverse(_all(s)))

    def spelled(path: Column) -> Column:
        ids = F.flatten(F.transform(path, lambda v: F.when(v < UNKNOWN, F.array(v)).otherwise(_byte_ids(v - UNKNOWN, model.first_byte))))
        return F.when(F.exists(path, lambda v: v >= UNKNOWN), ids).otherwise(path).cast("array<int>")

    # a plain let: the path is named once, as it is used three times
    return F.element_at(F.transform(F.array(taken(F.aggregate("edges", start, step, choices))), spelled), 1)


def _byte_ids(code: Column, first_byte: int) -> Column:
    """Ids of a code point's UTF-8 bytes."""
    low = lambda shift: F.shiftright(code, shift).bitwiseAND(63) + 128 + first_byte
    high = lambda shift, mark: F.shiftright(code, shift) + mark + first_byte
    return (
        F.when(code < 0x80, F.array(code + first_byte)).when(code < 0x800, F.array(high(6, 192), low(0)))
        .when(code < 0x10000, F.array(high(12, 224), low(6), low(0))).otherwise(F.array(high(18, 240), low(12), low(6), low(0)))
    )


def merged_ids(word: str, table: dict[str, tuple[float, int]], longest: int, first_byte: int) -> list[int]:
    """A word's merges: joinable neighbours wait in a heap, best score first, then leftmost."""
    n = len(word)
    end, before, alive, heap = [i + 1 for i in range(n)], [i - 1 for i in range(n)], [True] * n, []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and end[j] - i <= longest and (found := table.get(word[i : end[j]])):
            heapq.heappush(heap, (-found[0], i, j, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if alive[i] and alive[j] and end[i] == j and end[j] == e:
            alive[j], end[i] = False, e
            if e < n:
                before[e] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
    ids, i = [], 0
    while i < n:
        found = table.get(word[i : end[i]])
        ids += [found[1]] if found else [b + first_byte for b in word[i : end[i]].encode()]
        i = end[i]
    return ids


def _merged(model: PieceModel):
    table = {p: (score, i) for i, p, score in model.pieces}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [merged_ids(w, table, model.longest, model.first_byte) for w in b.column(0).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])

    return run


def encode_words(words: DataFrame, model: PieceModel, fold: str = "best") -> DataFrame:
    """``word`` (distinct) -> ``ids``: of the best path through its lattice, or of the model's merges."""
    if fold == "merges":
        return words.select("word").mapInArrow(_merged(model), "word string, ids array<int>")
    if "wid" not in words.columns:
        words = stage(words.select("word", F.monotonically_increasing_id().alias("wid")), "words")
    needed = needed_pieces(model)
    model = replace(model, pieces=needed, longest=max(len(p) for _, p, _ in needed))
    return lattice(words.select("wid", "word"), model).select("word", best_path(model).alias("ids"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Neighbouring rows (row, id, text) of a task together, cut by the sizes of the texts alone."""
    held, size, rows = [], 0, 0
    for batch in batches:
        start = 0
        for at, n in enumerate(pc.binary_length(batch.column(2)).to_pylist(), 1):
            size, rows = size + n, rows + 1
            if size >= BLOCK_BYTES or rows >= BLOCK_ROWS:
                yield pa.Table.from_batches([*held, batch.slice(start, at - start)])
                held, size, rows, start = [], 0, 0, at
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _packed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, ids and texts compressed); a block has the number of its first row."""
    for table in _blocks(batches):
        sink, kept = pa.BufferOutputStream(), table.select([1, 2])
        with pa.ipc.new_stream(sink, kept.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
            out.write_table(kept.combine_chunks())
        yield pa.RecordBatch.from_arrays([pa.array([table.column(0)[0].as_py()], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "packed"])


def _rare_words(pattern: str, hot, words_of: Callable | None = None):
    """(row, k, word) for the k-th different word of a text that is not in the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, known = words_of or _find_words(pattern), hot.value
        for batch in _slices(batches):
            uids, places, words = [], [], []
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = dict.fromkeys(w for w in find(text) if w not in known)
                uids += [uid] * len(own)
                places += range(len(own))
                words += own
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(places, pa.int32()), pa.array(words, pa.string())], [UID, "k", "word"])

    return run


def _rare_words_of_blocks(pattern: str, hot, joined: np.ndarray):
    """``_rare_words`` of whole blocks, each as one row of many texts."""
    rare = _rare_words(pattern, hot, _different_words(joined))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            texts = pa.array([table.column(2).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([table.column(0).combine_chunks()[:1], texts], [UID, "t"])

    return lambda batches: rare(rows(batches))


def _ids_as_bytes(ids: pa.ChunkedArray) -> list[bytes]:
    """Each list's 32-bit ids as bytes."""
    out = []
    for chunk in ids.chunks:
        flat, ends = memoryview(chunk.values.to_numpy()).cast("B"), [4 * e for e in chunk.offsets.to_pylist()]
        out += [bytes(flat[a:b]) for a, b in zip(ends, ends[1:])]
    return out


def _stitch(hot, joined: np.ndarray, schema: pa.Schema):
    """A block's documents: the ids of their words, from the dictionary or from the block's rare words, one after the other."""

    def run(packed: pa.Table, rare: pa.Table) -> pa.Table:
        known, places = hot.value, {}
        ids_of = dict(zip(rare.column("k").to_pylist(), _ids_as_bytes(rare.column("ids"))))
        found = pa.ipc.open_stream(packed.column("packed")[0].as_buffer()).read_all()
        texts = found.column(1).to_pylist()

        def ids(word: str) -> bytes:
            return known[word] if word in known else ids_of[places.setdefault(word, len(places))]

        units = _different_units(texts)
        words, starts = _cut(units, joined)
        spelled = [ids(w) for w in words]
        of = {u: b"".join(spelled[a:b]) for u, a, b in zip(units, starts, starts[1:])}
        rows = [b"".join([of[u] for u in _units(t)]) for t in texts]
        ends = [0, *accumulate(len(r) // 4 for r in rows)]
        values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(rows))])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        return pa.Table.from_arrays([found.column(0).cast(schema.field(0).type), lists.cast(schema.field(1).type)], schema=schema)

    return run


def frequent(counted: DataFrame, most: int) -> DataFrame:
    """The words met at least 2^k times, for the least k that leaves at most ``most`` of them."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r.k: r.words for r in counted.groupBy(power.alias("k")).agg(F.count(F.lit(1)).alias("words")).collect()}
    k, held = 64, 0
    while k > 0 and held + sizes.get(k - 1, 0) <= most:
        k -= 1
        held += sizes.get(k, 0)
    return counted.where(power >= k)


def encode(
    df: DataFrame, model: PieceModel, text: str = "text", id_col: str = "doc_id", hot_words: int = HOT_WORDS, fold: str = "best"
) -> DataFrame:
    """The id and ``ids`` of every row of ``df``; whole texts."""
    spark = df.sparkSession
    uid = F.col(UID) if UID in df.columns else F.monotonically_increasing_id().alias(UID)
    docs = df.select(uid, F.col(id_col), text_of(text).alias("t"))
    # the merges may take any piece on their way
    joined = neighbours(model.pieces if fold == "merges" else needed_pieces(model))
    met = docs.select("t").mapInArrow(_count_words(joined), "word string, n bigint")
    counted = met.groupBy("word").agg(F.sum("n").alias("n"))
    counted = stage(counted.withColumn("wid", F.monotonically_increasing_id()), "words")
    encoded = stage(encode_words(counted, model, fold), "encoded")
    top = encoded.join(frequent(counted, hot_words).select("word"), "word").toArrow()
    hot = spark.sparkContext.broadcast(dict(zip(top.column("word").to_pylist(), _ids_as_bytes(top.column("ids")))))
    # rare words of a block: no word here is frequent, so neither join meets a hot key
    pairs = docs.mapInArrow(_rare_words_of_blocks(model.word_pattern, hot, joined), f"{UID} bigint, k int, word string")
    rare = pairs.join(encoded, "word").select(F.col(UID).alias("block"), "k", "ids")
    packed = docs.mapInArrow(_packed_blocks, "block bigint, packed binary")
    schema = T.StructType().add(id_col, df.schema[id_col].dataType).add("ids", T.ArrayType(T.IntegerType()))
    return packed.groupBy("block").cogroup(rare.groupBy("block")).applyInArrow(_stitch(hot, joined, arrow_schema(spark, schema)), schema)


def decode(ids: Column, model: PieceModel) -> Column:
    """The text of ``ids`` without its leading blank."""
    spelled = F.split(F.lit(",".join(model.hex_of)), ",")
    text = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(spelled, i + 1)), "")), "UTF-8")
    return F.regexp_replace(text, "^ ", "")

