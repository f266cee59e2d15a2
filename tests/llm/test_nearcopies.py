"""Near copies against all pairs; the estimate against the exact similarity."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import nearcopies
from tidemark.llm.queries import op5_minhash_dedup, table
from tidemark.llm.words import END


def bag(text):
    w = re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(1, len(w)))))


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def brute(docs, threshold=0.8):
    bags = {i: bag(t) for i, t in docs if bag(t)}
    posting = defaultdict(set)
    for i, b in bags.items():
        for s in b:
            posting[s].add(i)
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, b in bags.items():
        shared = Counter(j for s in b for j in posting[s] if j < i)
        for j in shared:
            if find(i) != find(j) and similarity(b, bags[j]) >= threshold:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    rows = op5_minhash_dedup(spark, folder).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute(docs)
    assert all(r.kept == (r.class_id == r.doc_id) for r in rows) and not all(r.kept for r in rows)


def test_planted_groups(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    docs = []
    for size in (120, 40, 300, 60, 8, 2000):
        base = [word() for _ in range(size)]
        for copy in range(14):
            text = list(base)
            for _ in range(rng.randrange(1 + size // 60)):
                text[rng.randrange(size)] = word()
            docs.append((len(docs), " ".join(text)))
    # A chain whose ends are far apart.
    chain = [word() for _ in range(200)]
    for k in range(8):
        docs.append((len(docs), " ".join(chain[k * 8 :] + [word() for _ in range(k * 8)])))
    docs += [(1000, None), (1001, ""), (1002, "!!"), (1003, " . "), (1004, "one two"), (1005, "One, two."), (1006, "one")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, place int")
    got = {r.doc_id: r.class_id for r in nearcopies.near_copies(df).collect()}
    assert got == brute(docs)
    left = nearcopies.drop_near_copies(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(got.values()))


def test_repeated_rows_null_keys_and_empty(spark):
    text = "a b c d e f g h"
    rows = [(3, text), (3, text), (2, "x " + text * 9), (2, text), (None, text), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id or 0, r.class_id or 0, r.kept) for r in nearcopies.near_copies(df).collect()))
    assert out == [(0, 0, True), (0, 0, True), (2, 2, True), (2, 2, True), (3, 2, False), (3, 2, False)]
    assert nearcopies.near_copies(df.where("false")).count() == 0
    assert nearcopies.drop_near_copies(df).count() == 4


def test_estimates_are_unbiased():
    rng = random.Random(1)
    texts, truth = [], []
    for _ in range(60):
        words = [rng.choice("abc") for _ in range(rng.randrange(1, 60))] + ["z"] * rng.randrange(40)
        other = words[: rng.randrange(1, len(words) + 1)] + [rng.choice("abc") for _ in range(rng.randrange(20))]
        texts += [" ".join(words), " ".join(other)]
        truth.append(similarity(bag(texts[-2]), bag(texts[-1])))
    column = pa.array([t.encode() + bytes([END]) for t in texts], pa.binary())
    sign = nearcopies.signatures(*nearcopies.multisets(column), len(texts), 1024)
    assert np.isfinite(sign).all()
    got = (sign[::2] == sign[1::2]).mean(1)
    error = (got - truth) / np.sqrt(np.maximum(np.array(truth) * (1 - np.array(truth)), 1e-9) / 1024 + 1e-9)
    assert np.abs(error).max() < 4.5 and abs(error.mean()) < 0.5


def test_a_repeated_key_with_unlike_texts_keeps_all_links(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    x, y = [word() for _ in range(80)], [word() for _ in range(80)]
    docs = [(5, " ".join(x)), (5, " ".join(y)), (6, " ".join([*x[:-3], "other"])), (7, " ".join([*y[:-3], "else"])), (8, "apart from all of these")]
    assert similarity(bag(docs[0][1]), bag(docs[2][1])) >= 0.8 <= similarity(bag(docs[1][1]), bag(docs[3][1]))
    out = nearcopies.near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id) for r in out) == [(5, 5), (5, 5), (6, 5), (7, 5), (8, 8)]


def test_a_crowded_tile_holds_few_pairs_at_a_time():
    rng = np.random.default_rng(4)
    prints = np.tile(rng.integers(0, 1 << 14, 128).astype(np.uint16), (1500, 1))
    prints[:, 0] = rng.integers(0, 1 << 14, 1500)
    prints[700:] ^= 1  # two groups, of 1.4 million pairs
    tile = pd.DataFrame({"id": rng.permutation(1500), "prints": list(prints.view(np.int64))})
    tracemalloc.start()
    out = nearcopies._loosely_linked(100)(tile)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ids = tile["id"].to_numpy()
    assert sorted(zip(out["a"], out["b"])) == sorted([*((ids[0], x) for x in ids[1:700]), *((ids[700], x) for x in ids[701:])])
    assert peak < 30e6


def test_shared_shingles_count_by_the_smaller_multiplicity():
    rng = np.random.default_rng(5)
    bags = [Counter(rng.integers(0, 40, rng.integers(0, 300)).tolist()) for _ in range(30)] + [Counter({1: 20_000_000}), Counter({1: 17_000_001, 2: 1})]
    row, h, count = (np.array(x) for x in zip(*[(i, k, n) for i, b in enumerate(bags) for k, n in b.items()]))
    want = [[sum((a & b).values()) for b in bags] for a in bags]
    for columns in (1, 7, 1024):
        got = nearcopies._shared(row, h.astype(np.uint64), count, len(bags), columns)
        assert all(got[i, j] == want[i][j] for i in range(32) for j in range(32) if i != j)


def test_long_texts_are_compared_in_tiles_of_bounded_size(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    docs, base = [], [word() for _ in range(400)]
    for k in range(40):  # neighbours are near copies, others less and less
        docs.append((k, " ".join([*base[: 400 - 6 * k], *[word() for _ in range(6 * k)]])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(nearcopies, "BLOCK_BYTES", 20_000)
    texts = df.select(F.lit(1).alias("loose"), F.col("doc_id").alias("id"), "text")
    tiles = nearcopies._tiles(texts, ["loose"], 300, F.octet_length("text"), nearcopies.BLOCK_BYTES).groupBy("i", "j")
    held = [r.held for r in tiles.agg(F.sum(F.octet_length("text")).alias("held")).collect()]
    assert max(held) < 80_000 < sum(len(t) for _, t in docs)
    assert {r.doc_id: r.class_id for r in nearcopies.near_copies(df).collect()} == brute(docs)
