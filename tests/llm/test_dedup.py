"""Exact and near deduplication against brute force, and their defined cases."""

import hashlib
import random
import re

import numpy as np
import pytest

from payspark.llm import exact_dedup as ex
from payspark.llm import near_dedup as nd
from payspark.llm.components import components, grown


def rows_of(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is None, r[key] or 0))


def brute_groups(texts, ids):
    groups = {}
    for i, t in zip(ids, texts):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    return groups


def test_exact_groups_match_brute_force(docs, odd_texts):
    ids = list(range(100, 100 + len(odd_texts)))
    got = rows_of(ex.exact_groups(docs(odd_texts, ids)))
    groups = brute_groups(odd_texts, ids)
    for text, members in groups.items():
        for r in got:
            if r["doc_id"] in members:
                assert (r["keep_id"], r["group_size"]) == (min(members), len(members))
                assert r["kept"] == (r["doc_id"] == min(members))
                assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_tiny_tables_spill_and_give_the_same(docs):
    rng = random.Random(3)
    texts = ["t" * 200 + str(rng.randrange(150)) for _ in range(800)]
    df = docs(texts).repartition(4)
    a, b = (rows_of(ex.exact_groups(df, table_bytes=n).drop("__uid")) for n in (1 << 30, 2000))
    assert a == b and sum(r["kept"] for r in a) == len(set(texts))


def test_grace_fold_recurses(tmp_path):
    rows = [(b"%d" % (i % 500) * 20, 1, i, i, i) for i in range(3000)]
    out = list(ex.grace_fold(iter(rows), 3000, 0, str(tmp_path)))
    assert len(out) == 500 and all(g[0] == 6 and len(g[3]) == 6 for g in out)
    assert {g[1] for g in out} == set(range(500)) and not any(tmp_path.iterdir())


def test_content_table_compares_contents():
    t = ex.ContentTable(4)
    for content in (b"x", b"y", b"z", b"v"):
        entry, slot = t.find(content, 7)  # equal hashes
        assert entry == -1
        t.insert(content, 7, slot)
    assert [t.find(c, 7)[0] for c in (b"x", b"y", b"z", b"v")] == [0, 1, 2, 3]


@pytest.mark.parametrize("drop", [ex.drop_copies, nd.drop_near_copies])
def test_drop_keeps_columns_null_ids_and_repeats(docs, drop):
    df = docs(["one text of six short words", "one text of six short words", "other"], [None, 5, None])
    out = drop(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text, r.kept) for r in out.collect()) == [(0, "other", "own"), (5, "one text of six short words", "own")]
    twice = df.unionAll(df).where("doc_id = 5")
    assert drop(twice).count() == 1
    assert drop(df.where("false")).count() == 0


def brute_classes(texts, similarity=0.8):
    made = [nd.shingles(t or "") for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if nd.probability_jaccard(made[i], made[j]) >= similarity:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))]


def edited(rng, words, share):
    return " ".join("e%d" % rng.randrange(10**6) if rng.random() < share else w for w in words)


def test_near_groups_match_brute_force(docs, odd_texts):
    rng = random.Random(5)
    texts = list(odd_texts)
    for _ in range(25):
        words = ["v%d" % rng.randrange(4000) for _ in range(rng.choice([6, 40, 300]))]
        texts += [edited(rng, words, share) for share in (0, 0, 0.004, 0.01, 0.02, 0.05)]
    got = {r["doc_id"]: r for r in nd.near_groups(docs(texts)).collect()}
    want = brute_classes(texts)
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    assert all(got[i]["kept"] == (want[i] == i) and got[i]["class_size"] == want.count(want[i]) for i in range(len(texts)))


def test_many_near_copies_take_the_hub_rounds(docs, monkeypatch):
    rng = random.Random(6)
    words = ["v%d" % i for i in range(400)]
    texts = [edited(rng, words, 0.002) for _ in range(120)] + ["quite other words %d in this text" % i for i in range(20)]
    df = docs(texts)
    full = {r.doc_id: r.class_id for r in nd.near_groups(df).collect()}
    real = nd._join_buckets
    monkeypatch.setattr(nd, "_join_buckets", lambda b, s, t, sim, few, *rest: real(b, s, t, sim, 0, *rest))
    assert {r.doc_id: r.class_id for r in nd.near_groups(df).collect()} == full
    assert [full[i] for i in range(140)] == brute_classes(texts)


def test_pairs_inside_a_dense_group_are_found(docs, monkeypatch):
    """A thousand copies of one text around the threshold: most are similar to a few others only, which need not be hubs."""
    rng = random.Random(8)
    words, texts = ["v%d" % i for i in range(100)], []
    for i in range(500):
        own = list(words)
        for at in rng.sample(range(5, 95), 2):
            own[at] = "e%d" % rng.randrange(10**9)
        texts.append(" ".join(own))
        own[rng.randrange(100)] = "f%d" % i
        texts.append(" ".join(own))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    of = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if of[i] != of[j] and 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                low, high = sorted((of[i], of[j]))
                of = [low if c == high else c for c in of]
    assert 20 < len(set(of)) < 900
    real = nd._join_buckets
    monkeypatch.setattr(nd, "_join_buckets", lambda b, s, t, sim, few, *rest: real(b, s, t, sim, 0, *rest))
    monkeypatch.setattr(nd, "BLOCK_NODES", 300, raising=False)
    got = {r.doc_id: r.class_id for r in nd.near_groups(docs(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == of


def naive_probability_jaccard(x, y):
    total = 0.0
    for i in x.keys() & y.keys():
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    return total


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(4)
    for _ in range(30):
        x, y = ({int(k): int(rng.integers(1, 6)) for k in rng.integers(0, 40, 25)} for _ in range(2))
        pack = lambda m: (np.array(sorted(m), np.uint64), np.array([m[k] for k in sorted(m)]))
        assert nd.probability_jaccard(pack(x), pack(y)) == pytest.approx(naive_probability_jaccard(x, y))
    x, y = {k: 1 + k % 4 for k in range(300)}, {k: 1 + k % 4 for k in range(60, 360)}
    spread = [np.array([nd.scatter(np.array([k], np.uint64))[0] for k in m], np.uint64) for m in (x, y)]
    weights = [np.array(list(m.values()), float) for m in (x, y)]
    s = nd.prob_minhash(np.concatenate(spread), np.concatenate(weights), np.repeat([0, 1], 300), 2, 4096)
    assert (s[0] == s[1]).mean() == pytest.approx(naive_probability_jaccard(x, y), abs=0.04)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (20, 10), (7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 20: 10, 7: 7}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_signatures_do_not_depend_on_the_batch(docs, odd_texts):
    made = [nd.shingles(t or "") for t in odd_texts]
    full = nd.prob_minhash(np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made]).astype(float),
                           np.repeat(np.arange(len(made)), [len(m[0]) for m in made]), len(made), 160)
    for i, m in enumerate(made):
        own = nd.prob_minhash(m[0], m[1].astype(float), np.zeros(len(m[0]), np.int64), 1, 160)
        assert (own[0] == full[i]).all()


def test_edges_met_before_are_not_read_again(docs, spark, monkeypatch):
    rng, handed = random.Random(9), []
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choice(["x", "y", "z"]) + str(rng.randrange(9)) if rng.random() < 0.004 * (i % 7) else w for w in base) for i in range(150)]

    def counted(edges):
        handed.append(edges.count())
        return components(edges)

    monkeypatch.setattr(nd, "components", counted)
    monkeypatch.setattr("payspark.llm.components.components", counted)
    got = {r.doc_id: r.class_id for r in nd.near_groups(docs(texts)).collect()}
    assert len(set(got.values())) < len(texts)
    assert sum(handed) < len(texts)


def test_grown_components_equal_those_of_all_edges(spark):
    rng = random.Random(4)
    edges = [tuple(sorted(rng.sample(range(60), 2))) for _ in range(40)]
    table = lambda part: spark.createDataFrame(part, "a bigint, b bigint")
    whole = {tuple(r) for r in components(table(edges)).collect()}
    comps = components(table(edges[:15]))
    for part in (edges[15:30], [], edges[30:]):
        comps = grown(comps, table(part))
    assert {tuple(r) for r in comps.select("node", "comp").collect()} == whole
