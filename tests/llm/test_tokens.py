"""Encoding, token counts, packing, sharding and word pieces against libraries and brute force."""

import random
import struct
import zlib
from collections import Counter

import pytest
import sentencepiece as sp
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from payspark.llm import packing, queries, sentencepieces, sharding, token_counts, tokens
from payspark.llm.common import UID, numbered, running_start

PATH = tokens.vocabulary_path()
TRICKY = ["it's 12 <|endoftext|> é ÉÉ ok", "a\x1cb c", "İstanbul ΣΑΣ ŉx K Å don't_we", "word%%% OTHER!! x|y", "éte", "", "  \n", "你好 мир"]


def library_ids(text):
    return tokens.load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def test_chunks_give_the_library_s_ids(odd_texts):
    encoder = tokens.ChunkEncoder(PATH, tokens.id_bytes, cached_chunks=50)
    assert encoder.by_chunk and encoder.by_word
    for t in [x or "" for x in odd_texts] + TRICKY:
        encoder.learn([t])
        ids = library_ids(t)
        assert b"".join(encoder.values(t)) == struct.pack(f"<{len(ids)}I", *ids)


def test_token_histogram(docs, odd_texts):
    df = docs(odd_texts + TRICKY)
    lengths = [len(library_ids(t)) for t in odd_texts + TRICKY]
    sums = token_counts.saved_histogram(df)
    assert {r["length"]: r.n_docs for r in sums.collect()} == dict(Counter(lengths))
    for r in sums.collect():
        assert r.docs_from == sum(n >= r["length"] for n in lengths) and r.tokens_from == sum(n for n in lengths if n >= r["length"])
        assert r.truncated_total == sum(min(n, r["length"]) for n in lengths)
    one = df.sparkSession.range(1)
    limits = (0, 3, 7, 10**9)
    got = one.select(*[token_counts.truncated_total(sums, m) for m in limits], *[token_counts.length_quantile(sums, q) for q in (0.1, 0.5, 1.0)]).first()
    assert list(got)[:4] == [sum(min(n, m) for n in lengths) for m in limits]
    assert list(got)[4:] == [sorted(lengths)[-(-len(lengths) * q // 10) - 1] for q in (1, 5, 10)]
    assert token_counts.saved_histogram(df.where("false")).count() == 0


def test_packing_places_every_token_once(docs, odd_texts):
    texts = odd_texts + TRICKY + ["some words to encode %d" % i for i in range(60)]
    df = docs(texts)
    capacity = 40
    pieces = packing.token_pieces(df, capacity)
    placed = packing.pack(pieces, capacity, block_pieces=30)
    rows = placed.collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        ids = library_ids(t) + [1]
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [(k, k * capacity, min(capacity, len(ids) - k * capacity)) for k in range(-(-len(ids) // capacity))]
        assert all(r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length])) for r in own)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= capacity
    made = {r.sequence_id: r for r in packing.sequences(pieces, placed).collect()}
    assert {k: (r["length"], len(r.ids)) for k, r in made.items()} == {k: (n, 4 * n) for k, n in filled.items()}
    assert packing.pack_documents(df.where("false")).count() == 0


def test_underfull_bins_of_different_blocks_are_merged(spark):
    pieces = spark.createDataFrame([(i, 0, 35) for i in range(81)], "__uid bigint, piece int, length bigint")
    placed = packing.pack(pieces, capacity=100, block_pieces=10).collect()
    assert len(placed) == 81 and len({r["__uid"] for r in placed}) == 81
    assert len({r.sequence_id for r in placed}) == 41  # two to a sequence


@pytest.mark.parametrize("seed", range(6))
def test_local_search_reaches_the_bound_or_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 60) for _ in range(300)]
    loose = [[i] for i in range(len(lengths))]
    bins = packing.empty_bins(loose, lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(300)) and all(sum(lengths[i] for i in b) <= 100 for b in bins)
    least = max(-(-sum(lengths) // 100), sum(2 * n > 100 for n in lengths))
    assert len(bins) <= 1.1 * least  # from the worst start, one piece per bin
    assert len(packing.pack_lengths(lengths, 100)) <= least + 1 <= len(packing.best_fit(lengths, 100)) + 1


def test_exchange_two_for_one():
    gain, out, back = packing._best_step([2, 5], [6], 1)  # neither a move nor a single exchange fits
    assert (gain, sorted(out), back) == (1, [2, 5], (6,))
    gain, out, back = packing._best_step([9], [2, 5], 2)
    assert (gain, out, sorted(back)) == (2, (9,), [2, 5])


def test_shards(docs, odd_texts):
    texts = odd_texts + ["text %d" % i for i in range(200)]
    df = docs(texts).withColumn("slot", F.lit("clash"))
    out = sharding.shuffle_into_shards(df, shards=8, bucket_bytes=3000)
    rows = out.collect()
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "kept", "shard", "slot"}
    assert {r.doc_id: r.text for r in rows} == dict(enumerate(texts))
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    again = sharding.shuffle_into_shards(df.repartition(7), shards=8, bucket_bytes=3000)
    assert {(r.doc_id, r.shard, r.slot) for r in again.collect()} == {(r.doc_id, r.shard, r.slot) for r in rows}
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20
    assert sharding.shuffle_into_shards(df.where("false")).count() == 0
    assert sharding.shuffle_into_shards(docs(["x"] * 5, [None] * 5), shards=2).count() == 5


def test_no_id_overfills_a_bucket(docs, monkeypatch):
    texts = ["text %d" % i for i in range(300)] + ["own %d" % i for i in range(150)] + ["same"] * 150
    df = docs(texts, list(range(300)) + [None] * 150 + [7] * 150)
    sizes, real = [], sharding.running_start
    monkeypatch.setattr(sharding, "running_start", lambda c, *rest: sizes.append([r["__n"] for r in c.collect()]) or real(c, *rest))
    placed = [sharding.shuffle_into_shards(d, bucket_bytes=2000).collect() for d in (df, df.repartition(7))]
    assert all(sum(s) == 600 and max(s) < 75 for s in sizes)
    first, again = (sorted((r.shard, r.slot, r.doc_id is None, r.doc_id, r.text) for r in rows) for rows in placed)
    assert first == again and Counter(x[4] for x in first) == Counter(texts)


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding.fisher_yates(3, [1, s])) for s in range(3000))
    assert len(seen) == 6 and min(seen.values()) > 400
    assert list(sharding.fisher_yates(0, [1])) == [] and list(sharding.fisher_yates(1, [1])) == [0]


def test_running_start(spark):
    counts = spark.createDataFrame([(i * 3, i + 1) for i in range(50)], "k bigint, n bigint")
    got = {r.k: r.s for r in running_start(counts, "k", "n", "s", width=10).collect()}
    assert got == {i * 3: sum(range(1, i + 1)) for i in range(50)}


PIECES = tokens.vocabulary_path("piece_bpe_32k.model")
SENTENCES = [None, "", " ", "  Two  blanks\n\nlines\t", "été ＡＢ 你好 ☃", "Hello, hello world's (end).", "x" * 40, "1234 a1b2 ▁marked", "A B A B", "A B A B", "x" * 3000 + "Qu9" * 300 + "été☃" * 90]


def test_pieces_equal_the_library_and_decode_back(docs):
    model, library = sentencepieces.load_model(PIECES), sp.SentencePieceProcessor(model_file=PIECES)
    out = sentencepieces.encode(docs(SENTENCES), model, hot_words=3, fold="merges")
    rows = out.withColumn("back", sentencepieces.decode(F.col("ids"), model)).collect()
    assert len(rows) == len(SENTENCES)
    for r in rows:
        text = SENTENCES[r.doc_id] or ""
        assert r.ids == library.encode(text)
        assert r.back == text.replace("▁", " ")
    assert sentencepieces.encode(docs(SENTENCES).where("false"), model).count() == 0


TABLES = {}


def piece_table(key, model):
    if key not in TABLES:
        TABLES[key] = model, {p: (s, i) for i, p, s in model.pieces}
    return TABLES[key][1]


def brute_viterbi(word, model, longest=10**9):
    best = [(0.0, None, None)] + [None] * len(word)
    table = piece_table(id(model), model)
    for s in range(len(word)):
        for e in range(s + 1, min(len(word), s + longest) + 1):
            piece = word[s:e]
            score, ident = table.get(piece, (model.unknown_score, None) if e == s + 1 else (None, None))
            if score is not None and (best[e] is None or best[s][0] + score > best[e][0]):
                best[e] = (best[s][0] + score, s, ident)
    ids, at = [], len(word)
    while at:
        _, s, ident = best[at]
        ids = ([ident] if ident is not None else [b + model.first_byte for b in word[s:at].encode()]) + ids
        at = s
    return ids


def test_unigram_viterbi_equals_brute_force_and_the_library(spark, tmp_path):
    m = sentencepiece_model_pb2.ModelProto()
    m.ParseFromString(open(PIECES, "rb").read())
    m.trainer_spec.model_type = sentencepieces.UNIGRAM
    rng = random.Random(2)
    for p in m.pieces:  # log probabilities as a unigram model has them
        if p.type == sentencepieces.NORMAL:
            p.score = -rng.uniform(4, 14)
    path = tmp_path / "unigram.model"
    path.write_bytes(m.SerializeToString())
    model, library = sentencepieces.load_model(str(path)), sp.SentencePieceProcessor(model_file=str(path))
    words = ["▁Hello", "▁wonderful", "world", "▁été☃", "▁", "\n", "▁internationalisation", "x" * 1500 + "Qu9" * 300 + "été☃𝒳" * 90]
    got = {r.word: r.ids for r in sentencepieces.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    assert got == {w: brute_viterbi(w, model) for w in words}
    assert got["▁Hello"] == library.encode("Hello") and got["▁internationalisation"] == library.encode("internationalisation")


def test_best_path_of_every_word(spark, sf):
    """The query's own fold against brute force on all different words of the smallest table."""
    model = sentencepieces.load_model(PIECES)
    find = sentencepieces._find_words(model.word_pattern)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    words = sorted({w for t in texts for w in find(t)})
    got = {r.word: r.ids for r in sentencepieces.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    longest = model.longest
    assert len(got) == len(words) and all(got[w] == brute_viterbi(w, model, longest) for w in words)


def test_best_path_of_documents(docs):
    model = sentencepieces.load_model(PIECES)
    find = sentencepieces._find_words(model.word_pattern)
    out = sentencepieces.encode(docs(SENTENCES, [None, *range(1, len(SENTENCES))]), model, hot_words=3)
    rows = out.withColumn("back", sentencepieces.decode(F.col("ids"), model)).collect()
    for r in rows:
        text = (SENTENCES[r.doc_id] if r.doc_id else None) or ""
        assert r.ids == [i for w in find(text) for i in brute_viterbi(w, model, model.longest)]
        assert r.back == text.replace("▁", " ")
    assert len(rows) == len(SENTENCES)


def test_frequent_words_are_bounded(spark):
    counted = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate([1, 1, 2, 3, 4, 9, 100])], "word string, n bigint")
    assert {m: sentencepieces.frequent(counted, m).count() for m in (0, 1, 2, 3, 4, 5, 6, 7)} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7}


def test_piece_query_decodes_every_row(spark, docs, tmp_path):
    texts = [None, "", "two  blanks and\na line", " ünï 漢字 \U0001f600", "x" * 300]
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.decoded_crc32 for r in queries.op2_sentencepiece(spark, str(tmp_path)).collect()}
    assert got == {i: zlib.crc32((t or "").encode()) for i, t in enumerate(texts)}


def test_numbered_rows_stay_apart(docs):
    df = docs(["a", "a", "a"], [1, 1, None])
    assert numbered(df, "t").select(UID).distinct().count() == 3


def test_rare_words_are_held_for_few_documents_at_a_time():
    import pyarrow as pa
    from types import SimpleNamespace

    from payspark.llm import sentencepieces as sp

    ids, texts = [*range(1200)], [f"a{i % 7} b{i} b{i}" for i in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts)], ["u", "t"])
    given = list(sp._rare_words(r"\S+", SimpleNamespace(value={}))([batch]))
    assert len(given) >= 3
    rows = [r for b in given for r in zip(*(c.to_pylist() for c in b.columns))]
    assert rows == [(i, k, w) for i, t in zip(ids, texts) for k, w in enumerate(dict.fromkeys((sp.BLANK + t.replace(" ", sp.BLANK)).split()))]


def test_texts_move_once_in_blocks_that_name_a_rare_word_once():
    import pyarrow as pa
    from types import SimpleNamespace

    from payspark.llm import sentencepieces as sp

    model = sp.load_model(PIECES)
    joined, find = sp.neighbours(sp.needed_pieces(model)), sp._find_words(model.word_pattern)
    texts = [t or "" for t in SENTENCES] + [" lead", "\nline", "end ", "a\n b \n\nc", "\x00 \x1c", "rare" * 3] * 50
    for t in texts:  # cut further than the words of the pattern, and nowhere else
        words, starts = sp._cut(sp._units(t), joined)
        assert "".join(words) == "".join(find(t)) and len(words) >= len(find(t)) and starts[-1] == len(words)
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts))), pa.array(texts)], ["u", "doc_id", "t"])
    batches = [rows.slice(i, 40) for i in range(0, rows.num_rows, 40)]
    given = [r for b in sp._rare_words_of_blocks(model.word_pattern, SimpleNamespace(value={}), joined)(batches) for r in b.to_pylist()]
    assert {r[UID] for r in given} == {0} and len({r["word"] for r in given}) == len(given)
    packed = list(sp._packed_blocks(batches))
    assert len(packed) == 1 and packed[0].column(0).to_pylist() == [0]
    assert pa.ipc.open_stream(packed[0].column(1)[0].as_buffer()).read_all().column("t").to_pylist() == texts


def test_blocks_are_cut_by_their_rows_alone(docs, monkeypatch):
    import pyarrow as pa

    from payspark.llm import sentencepieces as sp

    monkeypatch.setattr(sp, "BLOCK_BYTES", 50)
    rows = pa.RecordBatch.from_arrays([pa.array(range(90), pa.int64()), pa.array(range(90)), pa.array(["x" * (i % 30) for i in range(90)])], ["u", "i", "t"])
    cuts = [[t.column(0).to_pylist() for t in sp._blocks([rows.slice(i, n) for i in range(0, 90, n)])] for n in (7, 90)]
    assert cuts[0] == cuts[1] and sum(cuts[0], []) == [*range(90)] and len(cuts[0]) > 10


def test_pieces_beaten_by_their_split_are_left_out():
    model = sentencepieces.load_model(PIECES)
    needed = {p for _, p, _ in sentencepieces.needed_pieces(model)}
    assert len(needed) < len(model.pieces) / 2 and all(p in needed for _, p, _ in model.pieces if len(p) == 1)
    rng = random.Random(3)
    few = sentencepieces.replace(model, pieces=[x for x in model.pieces if x[1] in needed])
    for _, p, _ in rng.sample(model.pieces, 300):
        word = p + rng.choice(model.pieces)[1]
        assert brute_viterbi(word, model) == brute_viterbi(word, few)
