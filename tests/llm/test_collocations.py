"""Collocations against counting everything in one place."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tidemark.llm import collocations as co
from tidemark.llm.queries import op12_collocations

SCHEMA = "text string, lang string, phrase string, n int"


def brute(docs, least=10, top=2000):
    f, total = Counter(), Counter()
    for text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    rows, longer = [], Counter()
    for (lang, *w), a in f.items():
        if len(w) == 3 and a >= least:
            for pair in (w[:2], w[1:]):
                longer[lang, *pair] = max(longer[lang, *pair], a)
    for (lang, *w), a in f.items():
        if len(w) == 1 or a < least or (len(w) == 2 and 100 * longer[lang, *w] >= 50 * a and longer[lang, *w]):
            continue
        cuts = [(10**6 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows.append((lang, -score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def odd():
    pick = random.Random(3)
    words = ["the", "The", "of", "é", "ÉA", "x", "Zz", "(a)", "naïve", "rare", "b\x0bb", "#", "longer-word", "quiteaverylongwordindeed" * 3]
    seps = [" ", "  ", "\t", ", ", ".", "\n", "; ", " "]
    docs = []
    for _ in range(400):
        body = "".join(pick.choice(words[: pick.choice([3, 14])]) + pick.choice(seps) for _ in range(pick.choice([0, 1, 2, 30, 60])))
        docs.append((body, pick.choice(["en", "de", None, ""]), "own", 1))
    docs += [(None, "en", "own", 1), ("", None, "own", 1), (" .,\n", "xx", "own", 1)] + [("same old story again", "en", "own", 1)] * 90
    docs += [(f"late bloom {i} wakes the morning" if i % 4 else "late bloom wakes the sun", "la", "own", 1) for i in range(44)]
    return docs


@pytest.mark.parametrize("shards", [1, 3])
def test_equals_counting_everything(spark, odd, shards):
    df = spark.createDataFrame(odd, SCHEMA).repartition(5)
    got = co.collocations(df, shards=shards)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(odd)
    assert sorted(map(tuple, got.collect())) == want and len({r[0] for r in want}) >= 5


def test_ranks_are_cut_and_a_higher_threshold(spark, odd):
    df = spark.createDataFrame(odd, SCHEMA)
    assert sorted(map(tuple, co.collocations(df, least=25, top=4, shards=2).collect())) == brute(odd, 25, 4)


def test_longer_phrases_wait_for_their_parts(spark, odd):
    found, _ = co.frequent_phrases(spark.createDataFrame(odd, SCHEMA), shards=3)
    since = {size: {(r.lang, r.phrase): r.since for r in df.collect()} for size, df in found.items()}
    assert set(since[1].values()) <= {0, 1, 2} and max(since[2].values()) > 1
    for size in (2, 3):
        for (lang, phrase), scan in since[size].items():
            w = phrase.split(" ")
            parts = [since[size - 1][lang, " ".join(p)] for p in (w[:-1], w[1:])]
            assert max(parts) < scan <= max(parts) + 3


def test_empty_and_one_very_long_text(spark):
    assert co.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = [("a b c d " * 300_000 + "e", "en", "own", 1), ("w" * 5_000_000 + " a b", "en", "own", 1)]
    assert sorted(map(tuple, co.collocations(spark.createDataFrame(docs, SCHEMA)).collect())) == brute(docs)


def test_filters_forget_nothing():
    h = np.random.default_rng(1).integers(0, 2**64, 5000, np.uint64)
    table = np.zeros(1 << (co._BITS - 6), np.uint64)
    at = co._Filter.slots(h)
    np.bitwise_or.at(table, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    some = co._Filter(table)
    assert some(h).all() and not co._Filter.union([]).table.any() and co._Filter.union([some, co._Filter.union([])])(h).all()
    assert some(np.random.default_rng(2).integers(0, 2**64, 5000, np.uint64)).mean() < 0.01


def test_crowded_filters_lose_no_phrase(spark, odd, monkeypatch):
    """In filters of 512 bits most phrases are held by mistake; what begins sooner is still counted for its full cycle."""
    monkeypatch.setattr(co, "_BITS", 9)
    pick = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    docs = odd + [(" ".join(pick.choices(words, range(60, 0, -1), k=40)), "en", "own", 1) for _ in range(300)]
    assert sorted(map(tuple, co.collocations(spark.createDataFrame(docs, SCHEMA)).collect())) == brute(docs)


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{small}/documents.parquet'")
    want = con.execute(co.ORACLE)
    names = [d[0] for d in want.description]
    got = op12_collocations(spark, small)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_scans_store_rows_per_bucket_not_per_phrase(spark, monkeypatch):
    stored, plain = [], co.stage
    monkeypatch.setattr(co, "stage", lambda df, label: stored.append((label, plain(df, label))) or stored[-1][1])
    pick = random.Random(4)
    docs = [(" ".join(f"w{int(9000 * pick.random() ** 3)}" for _ in range(60)), pick.choice(["en", "de"]), "own", 1) for _ in range(600)]
    assert sorted(map(tuple, co.collocations(spark.createDataFrame(docs, SCHEMA).repartition(4)).collect())) == brute(docs)
    scans = [df for label, df in stored if label == "scan"]
    buckets = 1 << (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    kinds = 2 * (1 + 3 + 3)  # words, and pairs and triples begun in each scan of the cycle, often held or not
    assert len(scans) >= 3 and all(df.count() <= kinds * buckets for df in scans)
    assert len({w for text, *_ in docs for w in text.split()}) > 3 * kinds * buckets


def test_counts_of_one_hash_add_up_across_tasks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(co, "_AT_ONCE", 50)
    texts = ["a b a. c a b " * k for k in range(1, 40)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * len(texts)), pa.array([t.encode() + b"\xff" for t in texts], pa.binary())], names=["lang", "text"]
    )
    rows = [x for k in range(0, len(texts), 7) for x in co._counted({}, range(0), True, 2)([batch.slice(k, 7)])]
    merged = [co._merged(5)(part) for b in range(4) if (part := (t := pa.Table.from_batches(rows)).filter(pa.compute.equal(t["bucket"], b))).num_rows]
    n = sorted(x for part in merged for blob in part["n"].to_pylist() for x in np.frombuffer(blob, np.int64).tolist())
    assert len(rows) > 1 and n == sorted(Counter(w for t in texts for w in t.replace(".", "").split()).values())


def test_filters_travel_packed():
    import pickle

    table = np.zeros(1 << (co._BITS - 6), np.uint64)
    table[5::999] = 3
    packed = pickle.dumps(co._Filter(table))
    assert len(packed) < table.nbytes / 20 and (pickle.loads(packed).table == table).all()
