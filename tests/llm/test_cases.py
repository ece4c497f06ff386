"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import cases
from tidemark.llm import (
    decontaminate,
    language,
    licences,
    pages,
    quality,
    queries,
    scoring,
    sentencepieces,
    simhash,
    substrings,
    tokenfiles,
)


def _benchmark(spark):
    rows = [(1, cases.PASSAGE), (2, None), (3, ""), (4, "two words"), (None, cases.PASSAGE)]
    return spark.createDataFrame(rows, "item_id long, text string")


def _tokens(spark, docs):
    return tokenfiles.digests(spark, tokenfiles.write(docs, queries.vocabulary(queries.BYTE_PAIRS)))


PER_ROW = {
    "substrings": lambda spark, docs: substrings.remove_repeats(docs),
    "scoring": lambda spark, docs: scoring.score(docs),
    "sentencepieces": lambda spark, docs: sentencepieces.encode(
        docs, queries.vocabulary(queries.PIECES)
    ),
    "simhash": lambda spark, docs: simhash.near_duplicates(docs),
    "language": lambda spark, docs: language.identify(docs),
    "quality": lambda spark, docs: quality.judge(docs),
    "tokenfiles": _tokens,
}
FILTERS = {
    "quality": lambda spark, docs: quality.keep_good(docs),
    "simhash": lambda spark, docs: simhash.keep_one(docs),
    "substrings": lambda spark, docs: substrings.cut_repeats(docs),
    "decontaminate": lambda spark, docs: decontaminate.keep_clean(docs, _benchmark(spark)),
}


@pytest.fixture(scope="module")
def docs(spark):
    return cases.documents(spark)


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_for_each_row(spark, docs, name):
    got = PER_ROW[name](spark, docs).collect()
    assert Counter(row["doc_id"] for row in got) == Counter(row[0] for row in cases.DOCUMENTS)
    assert len({tuple(map(str, row)) for row in got if row["doc_id"] == 7}) == (
        2 if name == "tokenfiles" else 1
    )


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_an_empty_table_gives_an_empty_result(spark, name):
    assert PER_ROW[name](spark, cases.documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_keep_columns_and_values(spark, docs, name):
    got = FILTERS[name](spark, docs)
    assert got.schema.names == docs.schema.names
    rows = got.collect()
    assert all(row[clash] == "x" for row in rows for clash in cases.CLASHES)
    kept = Counter(row["doc_id"] for row in rows)
    if name == "decontaminate":
        assert kept == Counter(r[0] for r in cases.DOCUMENTS) - Counter({6: 1, 7: 2})
    if name == "simhash":
        assert kept[3] == kept[4] == 0 and kept[2] == 1  # no words, like 2
        assert kept[7] == 2 and kept[8] == 2 and kept[None] == 2
    if name == "substrings":
        texts = {(r["doc_id"], r["text"]) for r in rows}
        assert (7, "other words") in texts and (6, f"before {cases.PASSAGE} after") in texts
        assert (4, " \t\n \x0b ") in texts and (2, None) in texts


def test_values_of_odd_texts(spark, docs):
    by = lambda frame: {r["doc_id"]: r for r in frame.collect() if r["doc_id"] in (2, 3, 4)}
    for row in by(quality.judge(docs)).values():
        assert row["n_words"] == 0 and row["base_failed"] and not row["kept"]
    for row in by(language.identify(docs)).values():
        assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    for row in by(scoring.score(docs)).values():
        assert row["n_tokens"] == 1
    for row in by(substrings.remove_repeats(docs)).values():
        assert (row["n_words"], row["kept_text"]) == (0, "")
    for row in by(simhash.near_duplicates(docs)).values():
        assert (row["fingerprint"], row["component_id"]) == ("0" * 16, 2)


def test_searches_on_odd_tables(spark, docs):
    found = decontaminate.contaminated(docs, _benchmark(spark)).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in found) == {(6, 1): 1, (7, 1): 2}
    none = _benchmark(spark).where("false")
    assert decontaminate.contaminated(docs, none).collect() == []
    assert decontaminate.contaminated(cases.documents(spark, []), _benchmark(spark)).collect() == []
    assert {r["family"] for r in licences.scan(docs).collect() if r["confirmed"]} == set()
    assert licences.scan(cases.documents(spark, [])).collect() == []


def test_odd_pages(spark):
    rows = [(1, "http://a/x", None), (2, None, ""), (3, "no host", "<p>t"), (None, "http://a/y", "<p>é"),
            (3, "no host", "<p>t")]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = made.selectExpr("*", "'x' as _host", "'x' as text", "1 as keys", "2 as _html")
    got = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in pages.extract(made).collect()]
    assert Counter(got) == Counter(
        [(1, "http://a/x", "", 0), (2, None, "", 0), (3, "no host", "t", 1), (None, "http://a/y", "é", 1),
         (3, "no host", "t", 1)]
    )
    assert pages.extract(made.where("false")).collect() == []


def test_the_pipeline_on_the_smallest_data(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf_dir, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "simhash near-dedup", "substring dedup", "benchmark decontamination",
        "sentencepiece",
    ]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    # The same by the operators' own results, one after the other.
    good = {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}
    docs = docs.where(docs["doc_id"].isin(list(good)))
    ones = {r["doc_id"] for r in simhash.near_duplicates(docs).collect() if r["component_id"] == r["doc_id"]}
    docs = docs.where(docs["doc_id"].isin(list(ones)))
    docs = substrings.cut_repeats(docs)
    leaks = {r["doc_id"] for r in decontaminate.contaminated(docs, queries.table(spark, sf_dir, "benchmark")).collect()}
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()} - leaks
    assert all(r["decodes_back"] and r["n_tokens"] == len(r["ids"]) for r in got)
