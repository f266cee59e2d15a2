"""Containment against the SQL and against sets, with long documents and edge cases."""

import re

import duckdb
import pytest

from tidemark.llm import contamination
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    want = [dict(zip(columns, r)) for r in want.fetchall()]
    got = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
    order = lambda r: [str(r[c]) for c in sorted(r)]
    assert len(want) > 0 and sorted(got, key=order) == sorted(want, key=order)


def grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(1, len(w))))}


def test_against_sets(spark):
    item = " ".join(f"w{i}" for i in range(30))
    noise = [" ".join(f"{'abcdefgh'[j % 8]}{(i * 7919 + j) % 9973}" for j in range(40_000)) for i in range(3)]
    items = [(1, item), (2, "one two"), (3, None), (4, "!!"), (5, item), (None, " ".join(f"n{i}" for i in range(11)))]
    part = " ".join(f"w{i}" for i in range(26))
    less = " ".join(f"w{i}" for i in range(22))
    docs = [
        (1, item.upper()), (2, noise[0] + " " + item + " " + noise[1]), (3, noise[2] + " " + part), (4, less), (5, "One, two!"),
        (6, "one two three four five"), (7, None), (8, ""), (9, item), (9, "other words"), (None, item), (10, " ".join(f"n{i}" for i in range(11))),
    ]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, shared int")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, id int")
    got = {(r.doc_id, r.item_id): round(r.containment, 9) for r in contamination.contained(d, b).collect()}
    want = {}
    for di, dt in docs:
        for bi, bt in items:
            q = grams(bt)
            if q and len(q & grams(dt)) / len(q) >= 0.8:
                want[di, bi] = max(want.get((di, bi), 0), round(len(q & grams(dt)) / len(q), 9))
    assert got == want and (2, 1) in want and (3, 5) in want and (4, 1) not in want
    left = contamination.decontaminate(d, b)
    assert left.columns == d.columns and sorted(r.doc_id for r in left.collect()) == [4, 6, 7, 8]
    assert contamination.contained(d.where("false"), b).count() == 0
    assert contamination.decontaminate(d, b.where("false")).count() == len(docs)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    from tidemark.llm.queries import op4_decontamination

    want = sorted(op4_decontamination(spark, SF).collect())
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", 0)
    assert sorted(op4_decontamination(spark, SF).collect()) == want
