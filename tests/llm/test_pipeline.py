"""Each stage against a brute-force version of it on its own input."""

import re

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.test_contamination import grams
from tests.llm.test_nearcopies import brute as near_classes
from tests.llm.test_packing import check as check_packed
from tests.llm.test_secrets import BASE, base_of
from tidemark.llm import toxicity
from tidemark.llm.queries import table

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents").withColumn("extra", F.lit("kept"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}

    before, after = seen["toxicity"]
    model = toxicity.train(before, table(spark, SF, "labels"))
    want = {r.doc_id for r in toxicity.score(before, model).collect() if not r.predicted}
    assert set(texts(after)) == want and 0 < len(want) < before.count()
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    clean = [i for i in texts(before) if labels.get(i) == 0]
    assert sum(i in want for i in clean) >= 0.97 * len(clean)

    before, after = map(texts, seen["near-dedup"])
    classes = near_classes(list(before.items()))
    assert set(after) == set(classes.values()) and all(after[i] == before[i] for i in after)

    before, after = map(texts, seen["decontamination"])
    passages = [g for r in table(spark, SF, "benchmark").collect() if (g := grams(r.text))]
    clean = {i for i, t in before.items() if not any(len(q & grams(t)) >= 0.8 * len(q) for q in passages)}
    assert set(after) == clean and len(clean) < len(before)

    before, after = map(texts, seen["secrets"])
    assert before.keys() == after.keys()
    hit = [i for i, t in before.items() if base_of(t or "")]
    assert hit and not any(base_of(after[i] or "") for i in after)
    for i, t in before.items():
        if i not in hit and "[SECRET]" not in (after[i] or ""):
            assert after[i] == t
        kept = re.split(re.escape("[SECRET]"), after[i] or "")
        assert all(part in (t or "") for part in kept)
    assert len(BASE) == 3
    lengths = {r.doc_id: r.n_chars for r in seen["secrets"][1].collect()}
    assert all(lengths[i] == len(t) for i, t in after.items())

    check_packed(docs.collect(), after)


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and "ids_crc32" in rows.columns
