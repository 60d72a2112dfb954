import re

import corpus_pipeline
from linksift.llm.common import table
from linksift.llm.quality import quality_scores
from test_jaccard_join import brute


def test_stages_against_plain_versions(spark, sf):
    docs = table(spark, sf, "documents")
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    good = {r.doc_id for r in quality_scores(docs, table(spark, sf, "labels")).filter("predicted = 1").collect()}
    groups = brute([(i, text[i]) for i in sorted(good)])
    first = {i for i in good if groups[i][1] == i}
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [plain(r.text) for r in table(spark, sf, "benchmark").collect()]
    want = {i for i in first if not any(b in plain(text[i]) for b in items)}
    assert want < first < good < set(text)
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want)
    assert all(r.lossless for r in got)


def test_stages_keep_columns_and_odd_rows(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
