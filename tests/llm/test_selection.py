"""Source mixing, importance resampling and vector codes against plain computations."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from payspark.llm import importance, mixing, queries, vector_codes

SOURCES = "doc_id bigint, text string, source string, size int, target string, pieces string"


def sourced(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "own", "own") for i, t, s in rows], SOURCES)


def words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))


def shared(sizes, weights=(5, 2, 1), repeats=3):
    """Targets by doing what the words say: share by weight, stop at the limit, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, opened = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and opened:
        unit, spare = left / sum(weight[s] for s in opened), 0.0
        for s in list(opened):
            target[s] += weight[s] * unit
            if target[s] >= repeats * sizes[s]:
                spare += target[s] - repeats * sizes[s]
                target[s] = float(repeats * sizes[s])
                opened.discard(s)
        left = spare
    return target


def highest_quotients(target, places, most):
    won = dict.fromkeys(target, 0)
    for _ in range(places):
        free = [s for s in sorted(target, key=lambda s: (s is None, s)) if won[s] < most[s] and target[s] > 0]
        if free:
            won[max(free, key=lambda s: target[s] / (2 * won[s] + 1))] += 1
    return won


MIXED = [
    {"a": 500, "b": 40, "c": 9000, None: 300, "z": 0},
    {"a": 10, "b": 10, "c": 10, "d": 10},
    {"a": 3, "b": 100_000, "é": 2000, "𝒳": 2000, "Z": 999},
    {None: 700},
    {"a": 0, "b": 0},
]


@pytest.mark.parametrize("sizes", MIXED)
def test_targets_and_quotas(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    quotas = mixing.apportion(mixing.source_targets(table), block_words=8, shards=5)
    rows = {r.source: r for r in quotas.collect()}
    want = shared(sizes)
    assert rows.keys() == sizes.keys()
    for s, r in rows.items():
        assert r.target == pytest.approx(want[s], rel=1e-9, abs=1e-6) and r.target <= 3 * sizes[s]
    places = math.floor(sum(r.target for r in rows.values()) / 8 + 0.5)
    most = {s: 3 * -(-n // 8) for s, n in sizes.items()}
    for shard in range(5):
        won = highest_quotients({s: r.target for s, r in rows.items()}, places * (shard + 1) // 5, most)
        assert {s: r.quotas[shard] for s, r in rows.items()} == won


def test_mix_fills_each_place_once_and_reruns_agree(spark, odd_texts):
    rows = [(i, t, "odd") for i, t in enumerate(odd_texts)]
    rows += [(1000 + i, words(5 + 13 * i % 90), ("big", "big", "big", None, "Ä")[i % 5]) for i in range(400)]
    rows += [(5, "repeated row of words", "big")] * 3 + [(None, "no id here", "big"), (None, None, None)]
    df = sourced(spark, rows)
    mixed = mixing.mix(df, block_words=16, shards=3, buckets=7)
    out = mixed.collect()
    assert len(out) == len(rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, r["size"]) for r in out) == Counter((i, s, count(t)) for i, t, s in rows)
    by_source, blocks, filled = defaultdict(int), defaultdict(lambda: defaultdict(int)), defaultdict(Counter)
    for r in out:
        by_source[r.source] += r["size"]
        assert [p.from_word for p in r.pieces] == [sum(q.words for q in r.pieces[:k]) for k in range(len(r.pieces))]
        assert sum(p.words for p in r.pieces) == r["size"] and all(len(p.shards) <= 3 for p in r.pieces)
        for p in r.pieces:
            blocks[r.source][p.block] += p.words
            assert filled[r.source].setdefault(p.block, len(p.shards)) == len(p.shards)
    want = shared(dict(by_source))
    for r in out:
        assert r.source_size == by_source[r.source] and r.target == pytest.approx(want[r.source])
    for s, held in blocks.items():
        assert sorted(held) == list(range(-(-by_source[s] // 16)))
        assert all(held[b] == 16 for b in held if b != max(held))
        assert max(filled[s].values()) - min(filled[s].values()) <= 1  # all blocks once before any comes again
    taken = mixed.groupBy("source").agg(F.sum(mixing.taken_words()).alias("taken"), F.first("target").alias("target")).collect()
    for r in taken:
        assert abs(r.taken - r.target) <= 3 * 16 + 1
    assert sum(r.words for r in mixing.mixed_pieces(mixed).collect()) == sum(r.taken for r in taken)
    again = mixing.mix(df.repartition(5), block_words=16, shards=3, buckets=7)
    keep = ["doc_id", "source", "size", F.to_json("pieces").alias("p")]
    assert Counter(map(tuple, mixed.select(*keep).collect())) == Counter(map(tuple, again.select(*keep).collect()))


def test_mix_of_nothing(spark):
    empty = mixing.mix(sourced(spark, []))
    assert empty.count() == 0 and "pieces" in empty.columns
    blank = mixing.mix(sourced(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.target, r.pieces) for r in blank] == [(0.0, []), (0.0, [])]


def plain_features(text, max_run):
    plain = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    found = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain)
    return found, [b" ".join(found[i : i + n]) for n in range(1, max_run + 1) for i in range(len(found) - n + 1)]


@pytest.mark.parametrize("max_run,share", [(1, 1 / 20_000), (2, 0.01), (3, 0.9)])
def test_importance_scores(spark, docs, odd_texts, max_run, share, monkeypatch):
    texts = odd_texts + ["A2b C2B-é É é", "x" * 3000] + [words(10 + i, "ab"[i % 2]) for i in range(60)]
    ids = [*range(len(texts) - 2), None, 3]
    aim = spark.createDataFrame([("a1 a2 a3 A4 b",), (None,), ("the same text",)], "text string")
    got = importance.score(docs(texts, ids), aim, max_run=max_run, buckets=97, head_share=share).collect()
    raw, want = Counter(), Counter()
    for t in texts:
        raw.update(zlib.crc32(f) % 97 for f in plain_features(t, max_run)[1])
    for r in aim.collect():
        want.update(zlib.crc32(f) % 97 for f in plain_features(r.text, max_run)[1])
    s_all, t_all = sum(raw.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[b] + 1) * (s_all + 97) / ((raw[b] + 1) * (t_all + 97)))) for b in range(97)]
    expected = Counter()
    for i, t in zip(ids, texts):
        found, features = plain_features(t, max_run)
        weight = sum(gain[zlib.crc32(f) % 97] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        expected[(i, len(found), len(features), weight, score)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == expected


def test_slices_of_a_text_join(monkeypatch):
    monkeypatch.setattr(importance, "SLICE_BYTES", 10)
    text = "One two33 three-four ééé five six sevenseven eight 9 ten".encode()
    for n in (1, 2, 3, 4):
        got = Counter(f if k == 1 else b" ".join(f) for k, found in importance.runs(text, n) for f in found)
        assert got == Counter(plain_features(text.decode(), n)[1])


def test_draw_takes_the_highest(spark, docs, odd_texts):
    texts = odd_texts + [words(20 + i % 7) for i in range(95)] + ["few words"] * 5
    ids = [*range(len(texts) - 2), 4, None]
    df = docs(texts, ids)
    aim = spark.createDataFrame([("w1 w2 w3",)], "text string")
    scored = importance.score(df, aim)
    ranked = importance.draw(scored, 30).collect()
    enough = [r for r in ranked if r.n_words >= 20]
    n = 30 * len(enough) // 100
    best = sorted(enough, key=lambda r: (-r.score, r.doc_id is None, r.doc_id))[:n]
    drawn = sorted((r for r in ranked if r["rank"] is not None), key=lambda r: r["rank"])
    assert len(ranked) == len(texts) and [r["rank"] for r in drawn] == list(range(1, n + 1))
    assert [(r.score, r.doc_id) for r in drawn] == [(r.score, r.doc_id) for r in best]
    kept = importance.resample(df, aim, 30)
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in drawn)
    none = df.where("false")
    assert importance.draw(importance.score(none, aim)).count() == 0
    assert importance.score(df, aim.where("false")).count() == len(texts)


VECTORS = "vec_id bigint, embedding array<float>, label int, code string, x int"


def plain_codes(rows, parts, entries, rounds):
    """Lloyd's rounds on Python integers; rows: (id, integers) in the order of the first codebook."""
    width = len(rows[0][1])
    at = [slice(width * p // parts, width * (p + 1) // parts) for p in range(parts)]
    books = [[list(x[s]) for _, x in rows[:entries]] for s in at]

    def nearest():
        out = []
        for _, x in rows:
            own = []
            for s, book in zip(at, books):
                far = [sum((a - b) ** 2 for a, b in zip(x[s], e)) for e in book]
                own.append((min(far), far.index(min(far))))
            out.append(own)
        return out

    for _ in range(rounds):
        chosen = nearest()
        for p, s in enumerate(at):
            for e in range(len(books[p])):
                mine = [x[s] for (_, x), own in zip(rows, chosen) if own[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    return books, [("".join(f"{e:02x}" for _, e in own), sum(d for d, _ in own)) for own in nearest()]


@pytest.mark.parametrize("scale,parts,width", [(0.3, 4, 10), (9000.0, 3, 7)])
def test_vector_codes(spark, scale, parts, width):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(12, width)) * scale
    x = (middles[rng.integers(0, 12, 400)] + rng.normal(size=(400, width)) * scale / 20).astype(np.float32)
    x[200:230] = x[3]  # copies of one vector
    rows = [(int(i), v.tolist(), int(i) % 3 or None, "own", 1) for i, v in enumerate(x)]
    odd = [(900, None, 1), (901, [], 1), (902, [1.0, None] + [0.0] * (width - 2), 1), (903, [float("nan")] * width, 1),
           (904, [float("inf")] + [0.0] * (width - 1), None), (905, [0.5] * (width + 1), 2)]
    kept = [(None, [0.25] * width, 2), (7, [0.125] * width, 1), (906, [1e30] * width, None)]
    df = spark.createDataFrame(rows + [(*r, "own", 1) for r in odd + kept], VECTORS).repartition(6)
    codes, books = vector_codes.compress(df, parts=parts, entries=16, rounds=4)
    usable = [(r[0], r[1]) for r in rows] + [(i, v) for i, v, _ in kept]
    whole = [(i, [math.floor(min(max(float(np.float32(c)), -16384.0), 16384.0) * 1024) for c in v]) for i, v in usable]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want_books, want = plain_codes(whole, parts, 16, 4)
    got = codes.collect()
    assert Counter((r.vec_id, r.code, r.error) for r in got) == Counter((i, c, e) for (i, _), (c, e) in zip(whole, want))
    assert [b.tolist() for b in books.books] == want_books
    assert books.rows == len(whole) and books.scans[0] == parts * len(whole)
    assert sum(books.scans[1:]) < 0.9 * 4 * parts * len(whole)  # the bounds save scans
    summed = Counter()
    for r in got:
        summed[r.label] += r.error
    assert all(r.label_error == summed[r.label] for r in vector_codes.with_label_errors(codes).collect())
    near = {r.vec_id: r.vector for r in vector_codes.decode(codes, books).collect()}
    assert len(near[0]) == width
    assert codes.columns == ["vec_id", "label", "code", "error"]


def test_vector_codes_of_few_or_no_rows(spark):
    few = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], None, "", 0)] * 3, VECTORS)
    codes, books = vector_codes.compress(few)
    assert {(r.code, r.error) for r in codes.collect()} == {("00000000", 0)} and len(books.books[0]) == 3
    codes, books = vector_codes.compress(few.where("false"))
    assert codes.count() == 0 and vector_codes.with_label_errors(codes).count() == 0
    assert books.digest() == hashlib.sha256(b"").hexdigest()
    codes, _ = vector_codes.compress(few.select("vec_id", F.lit(None).cast("array<float>").alias("embedding"), "label"))
    assert codes.count() == 0


def test_queries_of_this_kind(spark, sf):
    mixed = queries.QUERIES["op13_mixing"](spark, sf).toPandas()
    assert (mixed.taken <= 3 * mixed["size"]).all()
    drawn = queries.QUERIES["op12_importance_resampling"](spark, sf)
    assert drawn.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    coded = queries.QUERIES["op11_vector_codes"](spark, sf)
    assert coded.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
