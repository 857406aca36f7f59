"""The near-duplicate join and the total order against plain computations."""

import random

import pytest
from pyspark.sql import functions as F

from payspark.operators import ordering, similar


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text):
    for _ in range(rng.randint(0, 5)):
        at = rng.randint(0, len(text))
        text = rng.choice([text[:at] + rng.choice("abé") + text[at:], text[:at] + text[at + 1 :], text[:at] + "b" + text[at + 1 :]])
    return text


@pytest.mark.parametrize("threshold,split_over", [(0.7, 1), (0.85, 3), (0.85, 1000), (0.95, 1), (1.0, 2)])
def test_pairs_equal_a_full_comparison(spark, threshold, split_over):
    rng = random.Random(7)
    roots = ["senior data engineer", "data engineer ii", "é𝒳 naïve analyst of things", "ab", "a" * 30]
    texts = {edited(rng, rng.choice(roots)) for _ in range(150)} | {"", "a", "b", "abc", "abd", "x" * 70, "x" * 64}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {(r.a, r.b): (r.distance, r.similarity) for r in similar.similar_pairs(df, threshold, split_over).collect()}
    want = {}
    for a in texts:
        for b in texts:
            if (len(a), a.encode()) < (len(b), b.encode()) and 1 - distance(a, b) / len(b) >= threshold:
                want[a, b] = (distance(a, b), 1 - distance(a, b) / len(b))
    assert got == want


def test_membership_and_drop(spark):
    rows = [(1, "Google LLC", "CA", 3), (2, "google llc", "ca", 1), (3, "Google LLC.", "CA", 2), (4, None, None, 9), (5, None, "CA", 1), (6, "Lyft", None, 5)]
    df = spark.createDataFrame(rows, "id int, name string, state string, copies_ int")
    members, pairs = similar.near_duplicates(df, ["name", "state"])
    by_id = {r.id: (r.key_text, r.copies, r.links) for r in members.collect()}
    assert by_id == {
        1: ("google llc ca", 2, 1), 2: ("google llc ca", 2, 1), 3: ("google llc. ca", 1, 1), 4: (None, 0, 0), 5: (" ca", 1, 0), 6: ("lyft ", 1, 0)
    }
    assert [(r.a, r.b, r.distance) for r in pairs.collect()] == [("google llc ca", "google llc. ca", 1)]
    kept = similar.drop_near_duplicates(df, ["name", "state"], [F.col("copies_")])
    assert sorted(r.id for r in kept.collect()) == [2, 4, 5, 6] and kept.columns == df.columns
    assert similar.drop_near_duplicates(df.where("false"), ["name"], [F.col("id")]).count() == 0
    with pytest.raises(ValueError):
        similar.similar_pairs(df.select(F.col("name").alias("text")), 0.3)


def test_positions_are_a_total_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 1, 2, 9]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "v int, id int").repartition(7)
    placed = ordering.with_positions(df, [F.desc_nulls_last("v"), "id"]).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.v, r.id) for r in sorted(placed, key=lambda r: r.position)] == want
    assert sorted(r.position for r in ordering.with_positions(df, ["v"]).collect()) == list(range(1, 501))
    assert ordering.with_positions(df.where("false"), ["v"]).count() == 0


@pytest.mark.parametrize("rows,parts", [(10, 3), (2, 5), (9, 3), (0, 2)])
def test_contiguous_parts(spark, rows, parts):
    df = spark.range(1, rows + 1).withColumnRenamed("id", "position")
    got = [r.part for r in ordering.contiguous_parts(df, parts, rows).orderBy("position").collect()]
    sizes = [rows // parts + (p < rows % parts) for p in range(parts)]
    assert got == [p for p, n in enumerate(sizes) for _ in range(n)]


def test_history_reads_each_file_once(spark, tmp_path):
    import json
    import os

    from payspark.sources import ledger

    def land(folder, name, urls):
        os.makedirs(tmp_path / folder, exist_ok=True)
        with open(tmp_path / folder / name, "w") as f:
            f.writelines(json.dumps({"job_url": u, "position": f"{name}-{i}"}) + "\n" for i, u in enumerate(urls))
            f.write("not json\n")

    folders = [(str(tmp_path / "processed"), "consolidated-*.jsonl"), (str(tmp_path / "raw"), "batch-*.jsonl")]
    root = str(tmp_path / "state")
    os.makedirs(tmp_path / "processed")
    land("raw", "batch-2.jsonl", ["a", "b", "b", None])
    first, n = ledger.advance_history(spark, folders, root)
    assert n == 1 and {r.job_url: r.position for r in first.collect()} == {"a": "batch-2.jsonl-0", "b": "batch-2.jsonl-1"}
    land("raw", "batch-1.jsonl", ["b", "c"])
    land("processed", "consolidated-9.jsonl", ["c"])
    second, n = ledger.advance_history(spark, folders, root)
    want = {"a": "batch-2.jsonl-0", "b": "batch-1.jsonl-0", "c": "consolidated-9.jsonl-0"}
    assert n == 2 and {r.job_url: r.position for r in second.collect()} == want
    again, n = ledger.advance_history(spark, folders, root)
    assert n == 0 and {r.job_url: r.position for r in again.collect()} == want
    kept = ledger.read_ledger(spark, root)
    assert sorted(r.run for r in kept.collect()) == [0, 1, 1]


def test_numbered_names_meet_by_their_rests(spark):
    """Names alike but for a few digits share most segments: they meet by what is left without the wrong characters, not all with all."""
    rng = random.Random(3)
    texts = {f"customer#{rng.randint(0, 4000):09d}"[rng.randint(0, 3) :] for _ in range(150)} | {edited(rng, "aab" * rng.randint(1, 7)) for _ in range(60)}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    want = {(a, b) for a in texts for b in texts if (len(a), a.encode()) < (len(b), b.encode()) and 1 - distance(a, b) / len(b) >= 0.85}
    assert {(r.a, r.b) for r in similar.similar_pairs(df, 0.85, 2).collect()} == want
    shorter = similar._rests(df, 0.85, partners=True).withColumnRenamed("text", "a")
    longer = similar._rests(df, 0.85, partners=False).withColumnRenamed("text", "b")
    met = {(r.a, r.b) for r in shorter.join(longer, "h").select("a", "b").distinct().collect()}
    assert {(a, b) for a, b in want if len(b) <= similar.REST_LENGTH} <= met and len(met) < len(texts) ** 2 / 4


def test_texts_look_for_longer_ones_and_share_two_segments_with_them(spark):
    rng = random.Random(9)
    pairs = []
    for i in range(150):
        text = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 60)))
        other = text
        for _ in range(len(text) // 5):  # as many errors as 0.8 permits
            at = rng.randrange(len(other))
            other = other[:at] + rng.choice(["", rng.choice("abxyz"), rng.choice("xyz") + other[at]]) + other[at + 1 :]
        a, b = sorted((text, other), key=lambda t: (len(t), t))
        if a != b and 1 - distance(a, b) / len(b) >= 0.8:
            pairs.append((i, a, b))
    assert len(pairs) > 100
    df = spark.createDataFrame(pairs, "id int, a string, b string")
    look = similar._looked_up(df.select(F.col("a").alias("text")).distinct(), 0.8, F.lit(max(len(b) for _, _, b in pairs))).withColumnRenamed("text", "a")
    index = similar._indexed(df.select(F.col("b").alias("text")).distinct(), 0.8).withColumnRenamed("text", "b")
    met = df.join(look.join(index, ["i", "h"]), ["a", "b"]).groupBy("id").agg(F.count_distinct("i").alias("n"))
    assert {r.id: r.n for r in met.collect() if r.n >= 2}.keys() == {i for i, _, _ in pairs}
    # a text of the greatest length looks for its equals alone: 14 segments, each moved by at most 6 either way
    long = spark.createDataFrame([("".join(rng.choice("abcdefgh") for _ in range(60)),) for _ in range(20)], "text string")
    assert similar._looked_up(long, 0.8, F.lit(60)).count() <= 20 * 14 * 13
