from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import zstandard

from tests.llm import cases
from tidemark.llm import compressed
from tidemark.llm.queries import op13_quality_classifier, table

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_labels_are_predicted(spark):
    got = {r.doc_id: r for r in op13_quality_classifier(spark, SF_DIR).collect()}
    docs = [r.doc_id for r in table(spark, SF_DIR, "documents").collect()]
    assert Counter(docs) == Counter(list(got))
    assert all(r.held_out == (crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(got[r.doc_id], r.quality) for r in table(spark, SF_DIR, "labels").collect() if got[r.doc_id].held_out]
    right = {q: np.mean([row.predicted == q for row, label in held if label == q]) for q in (0, 1)}
    assert right[1] >= 0.95 and right[0] >= 0.7, right
    # Calibrated: the mean score of texts not learnt from is near their share of good labels.
    assert abs(np.mean([row.score for row, _ in held]) - np.mean([q for _, q in held])) < 0.06


def test_differences_are_sizes_by_whole_texts():
    good, bad = compressed.train([b"plain words of a text " * 3]), compressed.train([b"%%% ### $$$ " * 5])
    texts = [b"", None, b"plain words of a text", b"### $$$ %%%", b"plain words " * 5000]
    import pyarrow as pa

    got = compressed.differences(good, bad, pa.array(texts, pa.binary()))

    def size(dictionary, text):
        made = zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_dict_id=False
        )
        return sum(len(made.compress(text[i : i + 2048])) for i in range(0, len(text), 2048))

    want = [(size(bad, t) - size(good, t)) / len(t) if t else 0.0 for t in texts]
    assert got.tolist() == want and got[2] > 0 > got[3] and got[0] == got[1] == 0


def test_the_curve_is_the_likeliest_one():
    rng = np.random.default_rng(1)
    steps = np.round(rng.normal(0, 0.1, 20000) * 512) / 512
    labels = rng.random(20000) < 1 / (1 + np.exp(-(30 * steps + 1)))
    at = np.unique(steps)
    ones = np.array([(labels & (steps == s)).sum() for s in at])
    every = np.array([(steps == s).sum() for s in at])
    slope, intercept = compressed.fit(at, ones, every - ones)
    assert abs(slope - 30) < 1.5 and abs(intercept - 1) < 0.1
    slope, _ = compressed.fit(np.array([-1.0, 1.0]), np.array([0, 50]), np.array([50, 0]))
    assert np.isfinite(slope) and slope > 3


GOOD = [(i, f"The quiet river {i} runs past old houses and green fields towards the sea.") for i in range(40)]
BAD = [(100 + i, f"$$$ {i} ### BUY!! NOW!! %%% ### $$$ CLICK!! {i} $$$") for i in range(40)]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1) for i, _ in GOOD] + [(i, 0) for i, _ in BAD]
    odd = [(None, 1), (5, None), (6, 0), (0, 7), (10_000, 1), (1, 1)]
    made = spark.createDataFrame(rows + odd, "doc_id long, quality int")
    return made.selectExpr("*", "'x' as text", "1 as id", "2 as label")


def test_odd_rows(spark, labels):
    docs = cases.documents(spark, [*cases.DOCUMENTS, *[(i, t, "en", "a") for i, t in GOOD + BAD]])
    docs = docs.selectExpr("*", "1 as id", "'x' as label", "0.5 as score", "'y' as quality")
    rows = compressed.score(docs, labels).collect()
    every = [r[0] for r in cases.DOCUMENTS] + [i for i, _ in GOOD + BAD]
    assert Counter(r.doc_id for r in rows) == Counter(every)
    by = {r.doc_id: r for r in rows}
    assert by[39].predicted == 1 and by[139].predicted == 0
    assert by[None].held_out is False
    empty = {r.score for r in rows if r.difference == 0.0 and r.doc_id in (2, 3)}
    assert len(empty) == 1


def test_little_to_learn_from(spark, labels):
    docs = cases.documents(spark, [(i, t, "en", "a") for i, t in GOOD + BAD])
    none = compressed.score(docs, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    one = compressed.score(docs, labels.where("quality = 1")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.8
    assert compressed.score(docs.where("false"), labels).collect() == []


def test_a_label_of_many_rows_and_bounded_learning(spark, labels):
    """A third of all rows share one labelled id; the sample of labels is far below their number."""
    rows = [(i, t, "en", "a") for i, t in GOOD + BAD] + [(0, GOOD[0][1], "en", "a")] * 40
    got = compressed.score(cases.documents(spark, rows), labels, sample_rows=40).collect()
    assert len(got) == len(rows)
    right = [r.predicted == (r.doc_id < 100) for r in got]
    assert sum(right) / len(right) > 0.9
