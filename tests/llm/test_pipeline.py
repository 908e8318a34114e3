"""The pipeline stage by stage on a small corpus, each against plain Python on its own input."""

from collections import Counter

import corpus_pipeline
from tests.llm import brute, cases


def test_pipeline(spark, tmp_path):
    folder = str(tmp_path)
    docs = cases.frame(spark)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(cases.BENCHMARK, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    inputs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append([(r.doc_id, r.text) for r in now.collect()])
        stage(spark, now, folder).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        assert k == 4 or after.columns == docs.columns
        now = after
    assert len(corpus_pipeline.STAGES) == 5
    assert Counter(inputs[1]) == Counter(x for x in inputs[0] if not brute.quality(x[1])[-1] and x[0] not in (12, 19))
    ids = [(i, comp) for (i, _), (_, comp) in zip(inputs[1], brute.components(inputs[1]), strict=True)]
    assert Counter(i for i, _ in inputs[2]) == Counter(dict.fromkeys((i for i, c in ids if i == c), 1))
    assert Counter(inputs[3]) == Counter(x for x in inputs[2] if brute.benchmark_hits(x[1], cases.BENCHMARK)[1] == 0)
    assert [i for i, _ in sorted(inputs[4], key=str)] == [i for i, _ in sorted(inputs[3], key=str)]
    assert not any(brute.personal(t) for _, t in inputs[4])
    mixed = now.collect()
    copies = {(r.doc_id, r.text): r.copies for r in mixed}
    assert Counter((r.doc_id, r.text) for r in mixed) == Counter(copies) and set(copies) <= set(inputs[4])
    whole = Counter((r.doc_id, r.text, r.copy) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == Counter((r.doc_id, r.text, r.copy) for r in mixed)
