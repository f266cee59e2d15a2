"""The filter audit against every document judged one by one."""

import random
import re
from itertools import permutations

import duckdb
import pytest

from tidemark.llm import filteraudit
from tidemark.llm.queries import op11_filter_audit
from tidemark.session import new_folder

SCHEMA = "doc_id long, text string, source string, mask string, n int"


def brute(docs, labels):
    quality = {i for i, q, _ in labels if q == 1}
    bad = {i for i, _, t in labels if t == 1}
    fails = []
    for i, text, source, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = {"A"} if len(words) < 200 else set()
        f |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        f |= {"D"} if re.search("[#$%&*|]", text) else set()
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in docs):
            f.add("E")
        fails.append((source or "", f, i in quality, i in bad))
    out = {}
    for order in map("".join, permutations("ABCDE")):
        for source, f, good, toxic in fails:
            gone = False
            for step, name in enumerate(order, 1):
                row = out.setdefault((source, order, step), [0] * 7)
                hit = name in f
                row[0] += not gone and not hit
                row[1] += not gone and hit
                row[2] += gone and hit
                row[3] += f == {name}
                row[4] += not gone and hit and good
                row[5] += not gone and hit and toxic
                gone |= hit
    shapley = {}
    for (source, order, step), row in out.items():
        shapley[source, order[step - 1]] = shapley.get((source, order[step - 1]), 0) + row[1]
    return {k: (*row[:6], shapley[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


def found(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def odd():
    pick = random.Random(5)
    prose = ["a b c " * 70, "plain words here now", "SHOUT loud", "x|y", "", None, " ".join(map(str, range(250))), "é" * 3000 + " #", "tab\tand\x0bnew\nline " * 60]
    docs = [(pick.choice([None, *range(40)]), pick.choice(prose), pick.choice([None, "", "a", "b"]), "own", 7) for _ in range(300)]
    docs += [(i, "the same text", "hot", "own", 7) for i in range(900, 500, -1)] + [(501, "the same text", "a", "own", 7)] * 3
    docs += [(2**62 + i, "far ids", "a", "own", 7) for i in range(3)]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in [*range(0, 900, 3), *range(0, 40, 2), None, 2**62 + 1, 2**62 + 2]]
    return docs, labels


def test_equals_judging_each_document(spark, odd):
    docs, labels = odd
    path = new_folder(spark, "audit-docs") + "/documents.parquet"
    # Ids mostly fall from file to file, so that earlier masks are retracted.
    spark.createDataFrame(docs, SCHEMA).repartition(6).write.parquet(path)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = found(filteraudit.audit(spark, path, marks))
    best = {}
    for i, q, t in labels:
        best[i] = tuple(int(a or b == 1) for a, b in zip(best.get(i, (0, 0)), (q, t)))
    assert got == brute(docs, [(i, *m) for i, m in best.items() if i is not None])


def test_smaller_ids_that_come_later_retract(spark, odd):
    docs, labels = odd
    labels = list({r[0]: r for r in labels if r[0] is not None}.values())
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    root, path = new_folder(spark, "audit"), new_folder(spark, "audit-landing")
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    audit, seen = None, []
    for part in (order[:200], order[200:600], order[600:]):
        df = spark.createDataFrame(part, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(path)
        audit = filteraudit.Audit(spark, root, df.schema)
        audit.drain(path, marks, 1)
        seen += part
        assert found(filteraudit.report(audit.counters())) == brute(seen, labels)
    before = found(filteraudit.report(audit.counters()))
    audit.drain(path, marks, 1)  # nothing new
    assert found(filteraudit.report(audit.counters())) == before
    assert audit.spark.read.parquet(f"{root}/changes/batch=*").where("n < 0").count() > 0


def test_empty_table_has_no_parts(spark):
    path = new_folder(spark, "audit-none")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(spark, path, marks).count() == 0


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    want = con.execute(filteraudit.ORACLE)
    names = [d[0] for d in want.description]
    df = op11_filter_audit(spark, small)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())
