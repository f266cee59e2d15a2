"""Packing: ids against tokenizers, an exact round trip, neighbours against plain BM25."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from corpus_pipeline import pack as pack_stage
from tidemark.llm import packing
from tidemark.llm.queries import op7_packing, table, tokenizer_path

TEXTS = [None, "", "Hello  world's\n\n end <|endoftext|> é𝄞 123", "a" * 30_000, "word " * 9_000, "tie", "tie", "\x00\t \x1c"]


def reference(texts):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def check(rows, texts, window=2048):
    """texts: by document id. Every id lies in one piece, sequences have no holes and need no padding."""
    ids = dict(zip(texts, reference(texts.values())))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == texts.keys()
    for spans, sizes in ((pieces, {k: len(x) for k, x in ids.items()}), (sequences, None)):
        for k, found in spans.items():
            end = 0
            for start, length in sorted(found):
                assert start == end
                end += length
            assert end == sizes[k] if sizes else end == window or end & (end - 1) == 0 and end < window


def test_round_trip(spark, small):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, start int")
    check(packing.pack(docs, tokenizer_path()).collect(), dict(enumerate(TEXTS)))
    check(packing.pack(docs.repartition(3), tokenizer_path(), window=64, shard_bytes=100).collect(), dict(enumerate(TEXTS)), 64)
    assert packing.pack(docs.where("false"), tokenizer_path()).count() == 0
    check(op7_packing(spark, small).collect(), {r.doc_id: r.text for r in table(spark, small, "documents").collect()})


def test_repeated_rows_and_null_keys(spark):
    docs = spark.createDataFrame([(None, "x y"), (7, "x y"), (7, "x y")], "doc_id long, text string")
    rows = packing.pack(docs.coalesce(1), tokenizer_path(), window=4).collect()
    n = len(reference(["x y"])[0])
    assert sum(r.length for r in rows) == 3 * n and sum(r.length for r in rows if r.doc_id is None) == n


def test_neighbours_are_bm25(k1=1.2, b=0.75):
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint32) for _ in range(50)]
    index, unused = packing.Index(docs), rng.random(50) < 0.8
    df = Counter(t for d in docs for t in set(d.tolist()))
    mean = np.mean([len(d) for d in docs])
    for seed in range(50):
        terms = sorted((t for t in set(docs[seed].tolist()) if df[t] > 1), key=lambda t: (df[t], t))[:12]
        scores = {}
        for i, d in enumerate(docs):
            tf = Counter(d.tolist())
            if unused[i] and any(tf[t] for t in terms):
                scores[i] = sum(
                    math.log1p((50 - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(d) / mean))
                    for t in terms
                )
        got = index.neighbours(seed, unused, 12).tolist()
        assert set(got) == set(scores)
        ranked = [scores[i] for i in got]
        assert all(x >= y - 1e-9 for x, y in zip(ranked, ranked[1:]))


def test_copies_meet_in_a_window():
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 5000, 100).astype(np.uint32) for _ in range(40)]
    pieces = packing.pack_shard([base[i % 40] for i in range(120)], 300)
    home = defaultdict(set)
    for d, _, _, sequence, _ in pieces:
        home[d % 40].add(sequence)
    assert np.mean([len(s) for s in home.values()]) < 1.5


def test_queries_give_the_ids_of_tokenizers_at_its_defaults(spark, tmp_path):
    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x  <|endoftext|>\n y", "<|endoftext|><|endoftext|> <|endoftext", "none"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for rows in (op7_packing(spark, str(tmp_path)), pack_stage(spark, docs, str(tmp_path))):
        got = {}
        for r in rows.collect():
            got.setdefault(r.doc_id, []).append(r)
        for i, text in enumerate(texts):
            ids = np.array(plain.encode(text, add_special_tokens=False).ids + [1], "<u4")
            assert sum(r.length for r in got[i]) == got[i][0].doc_tokens == len(ids)
            for r in got[i]:
                assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_neighbours_meet_across_the_corpus(spark):
    common = "the day was long and the road went on over hills and fields "
    texts = [f"{common * 3} topic{i % 100}word rare{i % 100}thing {common}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartitionByRange(8, "doc_id")
    home = defaultdict(set)
    for r in packing.pack(docs, tokenizer_path(), shard_bytes=20_000).collect():
        home[r.doc_id % 100].add(r.sequence_id >> 33)
    assert all(len(tasks) == 1 for tasks in home.values())


def test_all_terms_of_the_seed_count():
    docs = [np.array(x, np.uint32) for x in ([*range(20)], [*range(12)], [*range(12, 20)], [19, 30], [31, 32])]
    index = packing.Index(docs)
    assert set(index.neighbours(0, np.array([False, True, True, True, True])).tolist()) == {1, 2, 3}
    assert len(index.neighbours(0, np.array([False, True, True, True, True]), most=1)) == 1


def test_a_shrunk_index_answers_the_same():
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, rng.choice([9, 60, 900]), rng.integers(1, 80)) for _ in range(160)]
    whole, small, unused = packing.Index(docs), packing.Index(docs), np.ones(160, bool)
    for seed in rng.permutation(160):
        unused[seed] = False
        if rng.random() < 0.1:
            small.shrink(unused)
        assert small.neighbours(seed, unused).tolist() == whole.neighbours(seed, unused).tolist()
        assert small.neighbours(seed, unused, most=5).tolist() == whole.neighbours(seed, unused, most=5).tolist()


def test_equal_chunks_are_encoded_once(monkeypatch):
    import tiktoken

    seen = []
    for name in ("encode", "encode_to_numpy"):
        plain = getattr(tiktoken.Encoding, name)
        monkeypatch.setattr(tiktoken.Encoding, name, lambda self, text, *a, _plain=plain, **b: seen.append(len(text)) or _plain(self, text, *a, **b))
    texts = ["first " + "the same old story, again. " * 400 + f"and number {i}" for i in range(50)]
    got = packing.byte_bpe(tokenizer_path())(texts)
    assert [[*map(int, x), 1] for x in got] == reference(texts)
    assert sum(seen) < sum(map(len, texts)) / 100


def test_chunks_have_the_ids_of_whole_texts():
    plain = Tokenizer.from_file(tokenizer_path())
    parts = [*" \n\t\r\x0b\x0c\x1c\x7f\x85\xa0　  aStéß中文ё😀²½…’.$'|<", "  ", " \n ", "the", "'s", "'ll", "12", "***", " rent", "<|endoftext|>", "<|endoftext", "|>"]
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(rng.choice(parts, rng.choice([4, len(parts)])), rng.choice([0, 1, 2, 9, 40]))) for _ in range(3000)]
    got = packing.byte_bpe(tokenizer_path(), True)(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert packing.byte_bpe(tokenizer_path())([]) == [] and [len(x) for x in packing.byte_bpe(tokenizer_path())(["", ""])] == [0, 0]
