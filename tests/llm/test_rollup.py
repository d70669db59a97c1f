import uuid

import pytest

from corpuslens.llm import rollup
from corpuslens.llm.queries import tokenizer_path
from corpuslens.sources.tables import shared_root


@pytest.fixture
def book(spark):
    return rollup.Rollup(spark, f"{shared_root(spark)}/test-{uuid.uuid4().hex}")


def state(book):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in book.totals().collect()}


def test_batches_add_up_once(spark, book):
    make = lambda rows: spark.createDataFrame(rows, "source string, lang string, tokenizer string, tokens long, was long")
    load = make([("a", "en", "t", 5, 0), ("a", "en", "t", 7, 0), ("b", None, "t", 1, 0), ("b", None, "t", None, 0)])
    assert state(book) == {}
    book.commit("one", rollup.inserts(load))
    book.commit("one", rollup.inserts(load))
    assert state(book) == {("a", "en", "t"): (2, 12), ("b", None, "t"): (2, 1)}
    book.commit("two", rollup.deletes(make([("a", "en", "t", 5, 0)])))
    book.compact()
    book.commit("two", rollup.deletes(make([("a", "en", "t", 5, 0)])))
    book.commit("three", rollup.revisions(make([("a", "en", "t", 10, 7)])))
    book.commit("none", rollup.inserts(load.limit(0)))
    want = {("a", "en", "t"): (1, 10), ("b", None, "t"): (2, 1)}
    assert state(book) == want
    book.compact()
    assert state(book) == want
    book.compact()
    assert state(book) == want


def test_batch_names(spark, book):
    with pytest.raises(ValueError):
        book.commit("../x", spark.range(0))


def test_counts(odd_docs, no_docs):
    rows = {(r["doc_id"], r["tokenizer"]): r["tokens"] for r in rollup.counted(odd_docs).where("doc_id IS NOT NULL").collect()}
    assert (rows[1, "space-1"], rows[3, "space-1"], rows[6, "alnum-1"], rows[5, "alnum-1"]) == (14, 0, 0, 30_000)
    assert (rows[7, "space-1"], rows[7, "alnum-1"]) == (7, 7)
    assert rollup.counted(no_docs).count() == 0
    ids = {r["doc_id"]: r["tokens"] for r in rollup.vocabulary_counts(odd_docs, tokenizer_path(), "bpe").where("doc_id IS NOT NULL").collect()}
    assert ids[3] == 0 and ids[1] >= 14


def test_a_batch_committed_during_compaction_counts_once(spark, book, monkeypatch):
    make = lambda n: rollup.inserts(spark.createDataFrame([("a", "en", "t", n)], "source string, lang string, tokenizer string, tokens long"))
    book.commit("one", make(5))
    summed = book._sum

    def late(number, batches):
        book.commit("two", make(7))  # after the batches were listed, before they are summed
        return summed(number, batches)

    monkeypatch.setattr(book, "_sum", late)
    book.compact()
    monkeypatch.undo()
    assert state(book) == {("a", "en", "t"): (2, 12)}
    book.compact()
    assert state(book) == {("a", "en", "t"): (2, 12)}


def test_vocabulary_query_by_brute_force(spark, small):
    from tokenizers import Tokenizer

    from corpuslens.llm.queries import op8_vocabulary_counts

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source").collect():
        docs, tokens = want.setdefault((r["source"], r["lang"], "word_bpe_49k"), [0, 0])
        if r["doc_id"] % 50:
            docs, tokens = docs + 1, tokens + len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
        want[r["source"], r["lang"], "word_bpe_49k"] = [docs, tokens]
    got = {(r["source"], r["lang"], r["tokenizer"]): [r["docs"], r["tokens"]] for r in op8_vocabulary_counts(spark, small).collect()}
    assert got == want
