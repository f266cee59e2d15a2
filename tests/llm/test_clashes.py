"""The filtering stages on tables whose columns bear the names that the stages use."""

import numpy as np

from tidemark.llm import contamination, nearcopies, secrets, toxicity

NAMES = ["_key", "_strong", "_weak", "_base", "_spans", "_more", "_block", "_gone", "_hit", "_closed", "id", "b", "score"]
LONG = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [(1, LONG), (2, LONG), (3, "password = hunter22 and more"), (None, None), (5, "")]


def test_columns_of_any_name_pass_through(spark):
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in NAMES)
    docs = spark.createDataFrame([(*r, *(f"{c} {r[0]}" for c in NAMES)) for r in ROWS], schema)
    bench = spark.createDataFrame([(7, LONG)], "item_id long, text string")
    no_model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), -9.0)

    def kept(out):
        assert out.columns == docs.columns
        rows = out.collect()
        assert all(r[c] == f"{c} {r.doc_id}" for r in rows for c in NAMES)
        return sorted(((r.doc_id, r.text) for r in rows), key=str)

    assert kept(toxicity.drop_toxic(docs, no_model)) == sorted(ROWS, key=str)
    assert kept(nearcopies.drop_near_copies(docs)) == sorted(ROWS[:1] + ROWS[2:], key=str)
    assert kept(contamination.decontaminate(docs, bench)) == sorted(ROWS[2:], key=str)
    redacted = [r if r[0] != 3 else (3, "password = [SECRET] and more") for r in ROWS]
    got = kept(secrets.redact(docs))
    assert [r for r in got if r[0] != 3] == sorted((r for r in redacted if r[0] != 3), key=str)
    assert "hunter22" not in dict(got)[3] and "[SECRET]" in dict(got)[3]
