"""Removed bytes against a plain search of all windows; suffix arrays against sorting."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.queries import op1_suffix_dedup, table
from tidemark.llm.suffixes import SuffixArray


def brute(docs, length=100):
    """docs: (key, text), a key may repeat: places at one start are not earlier than one another."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    first = {}
    raws = [(t or "").encode() for _, t in docs]
    for i in order:
        for p in range(len(raws[i]) - length + 1):
            w = raws[i][p : p + length]
            place = (docs[i][0] is None, docs[i][0] or 0, p)
            first[w] = min(first.get(w, place), place)
    out = []
    for (key, _), raw in zip(docs, raws):
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < (key is None, key or 0, p):
                gone[p : p + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((key, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    assert rows(op1_suffix_dedup(spark, folder)) == sorted(brute(docs), key=str)


def planted():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    base, line, passage = text(900), text(98) + "\n", text(150)
    docs = [(1, base), (2, base[300:] + text(50)), (0, None), (3, ""), (4, "a" * 700), (5, "ab" * 160 + "a" * 120), (6, base[:99]), (7, base[:100])]
    docs += [(k, text(rng.randrange(60)) + line + text(rng.randrange(300)) + line + passage[: rng.randrange(151)]) for k in range(8, 60)]
    docs += [(60, base), (61, "x" + base + base), (-5, base[500:700]), (62, "\x00" * 250), (63, (line + "\n") * 12)]
    docs += [(64, line), (64, passage + base), (64, "a" * 300), (None, base[200:800]), (None, base[100:900]), (65, line), (65, line)]
    return docs


@pytest.mark.parametrize("limits", [{}, {"chunk": 500, "many": 2, "per_shard": 3}, {"many": 1}])
def test_planted_repeats(spark, limits):
    docs = planted()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, v int").repartition(5)
    out = repeats.remove_repeats(df, keep_text=True, **limits)
    assert rows(out) == sorted(brute(docs), key=str)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in out.collect())


def test_texts_of_one_key_with_equal_32_bit_hashes(spark):
    """Two texts that Spark's hash cannot tell apart, found among many, are two texts."""
    rng = random.Random(11)
    head = "".join(rng.choice("abcdefgh") for _ in range(60))
    texts = spark.range(400_000).selectExpr("id", f"concat(substr(sha2(cast(id as string), 256), 1, 40), '{head}', substr(sha2(cast(-id as string), 256), 1, 52)) as t")
    pairs = texts.groupBy(texts.t.substr(1, 0), F.hash("t").alias("h")).agg(F.collect_list("t").alias("ts")).where("size(ts) > 1")
    a, b = pairs.first().ts[:2]
    docs = [(1, b), (64, a), (64, b)]
    assert rows(repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))) == sorted(brute(docs), key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(df).count() == 0


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(1, 60))) for _ in range(rng.choice([1, 3, 20]))]
        strings += [strings[0]] * 2
        array = SuffixArray(strings)
        suffixes = [s[i:] for s in strings for i in range(len(s))]
        found = [suffixes[i] for i in array.order]
        assert found == sorted(found)
        for a, b, common in zip(found, found[1:], array.common[1:]):
            shared = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared == common
