from collections import Counter

import corpus_pipeline
from corpuslens.llm import decontaminate, neardup
from corpuslens.llm.common import table


def test_stages_keep_columns_and_take_effect(spark, small):
    docs = table(spark, small, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, small)
        assert after.dtypes == docs.dtypes, name
        assert not Counter(map(tuple, after.collect())) - Counter(map(tuple, before.collect())), name
        if name == "near_duplicates":
            groups = neardup.near_duplicates(before).where("kept")
            assert {r[0] for r in after.select("doc_id").collect()} == {r[0] for r in groups.select("doc_id").collect()}
            assert not neardup.near_duplicates(after).where("NOT kept").count()
        before = after
    dirty = decontaminate.digest(decontaminate.scan(before, table(spark, small, "benchmark"))).where("contaminated")
    assert dirty.count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, before, small)
    assert packed.select("doc_id").distinct().count() == before.count()


def test_odd_documents_pass(spark, odd_docs, no_docs, small):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, small)
            if name != "packing":
                assert out.columns == docs.columns
                kept = [r["doc_id"] for r in out.collect()]
                if docs.count() and name == "near_duplicates":
                    assert sorted(x for x in kept if x is not None) == [1, 3, 4, 5, 6, 7, 8] and kept.count(None) == 2


def test_an_unlike_text_under_a_repeated_id_stays(spark, small):
    a, b = (" ".join(f"{name}{n}" for n in range(60)) for name in "ab")
    docs = spark.createDataFrame([(1, a, "en", "s", 1), (5, a, "en", "s", 1), (5, b, "en", "s", 1), (5, b, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, small).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, a), (5, b)]
