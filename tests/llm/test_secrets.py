"""The secret scan against Python's re, and its links against a search of all pairs."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tidemark.llm import secrets
from tidemark.llm.queries import op3_secret_scan, table

BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
KEY = "AKIA" + "Q" * 16
TEXTS = [
    None,
    "",
    "token=abc token: 'abcdef' PASSWORD = x1234567 secret=token=abcdefg",
    f"é𝄞 {KEY} and {'ab12' * 10}.",
    f"{KEY}{KEY} api_key:{'0a' * 30}",
    "AKIA short and deadbeef",
    f"user=alice password=hunter22 https://vault.example.com/x {'Ab3/' * 10}",
    f"user=alice {'z ' * 300} password=hunter22",
    f"{'Ab3/' * 10} near {KEY}",
    f"{'Ab3/' * 10} alone, 10.0.0.1",
    f"10.0.0.1 {KEY} token=abcdef12",
    "password=hunter22" + " word" * 50_000 + " password=hunter23",
]


def base_of(text):
    found = []
    for place, (kind, pattern, group, least) in enumerate(BASE):
        found += [(m.start(), place, kind, m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return sorted(found)


def rows(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _note string")


def check(out, texts):
    for i, text in texts.items():
        found, row = base_of(text or ""), out[i]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(f[2] == k for f in found) for k, *_ in BASE)
        spans = [f"{kind}:{a}:{b}" for a, _, kind, b in found]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(row.spans.split(",")) or not spans


def test_base_spans_match_re(spark, small):
    check({r.doc_id: r for r in secrets.scan(rows(spark)).collect()}, dict(enumerate(TEXTS)))
    docs = {r.doc_id: r.text for r in table(spark, small, "documents").collect()}
    check({r.doc_id: r for r in op3_secret_scan(spark, small).collect()}, docs)


def test_weak_parts_need_their_complements(spark):
    spans = {r.doc_id: r.spans for r in secrets.scan(rows(spark)).collect()}
    assert "user:0:10" in spans[6] and "endpoint:" in spans[6] and "key40:" in spans[6]
    assert "user" not in spans[7]
    assert spans[8].startswith("key40:0:40")
    assert spans[9] == ""
    assert spans[10].startswith("endpoint:0:8")


def test_links_match_all_pairs(spark):
    text = " ".join(
        ["user=alice", "pad " * 45, "password=hunter22", "pad " * 20, "10.1.2.3", "pad " * 55, "login: bob12", KEY] * 4
    )
    got = secrets.scan(rows(spark, [text]), scope=200).first().spans.split(",")
    found = []
    for kind, pattern, group, least in secrets.STRONG + secrets.WEAK:
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    near = lambda a, b: b[0] <= a[2] + 200 and b[2] + 200 >= a[0]
    want = [
        f for f in found
        if f[1] not in secrets.NEEDS
        or all(any(secrets.ROLES[g[1]] == need and near(f, g) for g in found) for need in secrets.NEEDS[f[1]])
    ]
    assert got == [f"{k}:{a}:{b}" for a, k, b in sorted(want, key=lambda f: (f[0], secrets.KINDS[f[1]]))]


def test_repeated_rows_empty_table_and_redaction(spark):
    twice = rows(spark).unionByName(rows(spark))
    assert secrets.scan(twice).count() == 2 * len(TEXTS)
    assert secrets.scan(rows(spark).where("false")).count() == 0
    clean = {r.doc_id: r.text for r in secrets.redact(rows(spark)).collect()}
    assert clean[0] is None and clean[1] == "" and clean[5] == TEXTS[5]
    assert clean[3] == "é𝄞 [SECRET] and [SECRET]."
    assert clean[8] == "[SECRET] near [SECRET]"
    again = secrets.scan(secrets.redact(rows(spark)))
    assert again.agg(F.sum(F.col("n_assign") + F.col("n_access") + F.col("n_hex"))).first()[0] == 0


def test_links_of_long_parts_at_any_offset(spark):
    rng = random.Random(4)
    parts = [KEY, "Ab3/" * 10, "ab12" * 16, "ab12" * 300, "token=" + "x" * 100, "login: " + "b" * 700, "10.1.2.3", "https://" + "h" * 450]
    texts = ["." * 189 + f" {KEY} " + "." * 192 + " " + "Ab3/" * 10]
    for _ in range(150):
        text = "~" * rng.randrange(400)
        for _ in range(rng.randrange(2, 6)):
            text += f" {rng.choice(parts)} " + "~" * rng.choice([0, 100, 190, rng.randrange(180, 215), rng.randrange(420)])
        texts.append(text)
    near = lambda a, b: b[0] <= a[2] + 200 and b[2] + 200 >= a[0]
    got = {r.doc_id: r.spans for r in secrets.scan(rows(spark, texts), scope=200).collect()}
    assert got[0].split(",")[-1].startswith("key40:")
    for i, text in enumerate(texts):
        found = [
            (m.start(), kind, m.end()) for kind, pattern, group, least in secrets.STRONG + secrets.WEAK
            for m in re.finditer(pattern, text) if len(m.group(group)) >= least
        ]
        want = [
            f for f in found
            if all(any(secrets.ROLES[g[1]] == need and near(f, g) for g in found) for need in secrets.NEEDS.get(f[1], ()))
        ]
        assert got[i] == ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(want, key=lambda f: (f[0], secrets.KINDS[f[1]])))
