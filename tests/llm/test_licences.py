import numpy as np
import pytest

from tidemark.llm import licences
from tidemark.llm.queries import op9_license_scan, table

SF_DIR = "/root/testdata/sf0.01"
MARKS = {
    "CC BY-NC": "cc-by-nc", "GNU General": "gpl", "Apache License": "apache", "MIT License": "mit",
    "All rights reserved": "proprietary",
}


def test_the_query_finds_all_planted_lines_and_no_other(spark):
    want = set()
    for r in table(spark, SF_DIR, "documents").collect():
        for number, line in enumerate(r.text.split("\n")):
            want |= {(r.doc_id, number, f) for mark, f in MARKS.items() if mark in line}
    got = op9_license_scan(spark, SF_DIR).collect()
    assert {(r.doc_id, r.line, r.family) for r in got if r.confirmed} == want and want


@pytest.fixture(scope="module")
def model():
    plain = [f"this is plain line {i} of words that say little {i * 7}".encode() for i in range(300)]
    return licences.Classifier([licences.line_words(line) for line in plain])


def test_held_out_variations_and_calibration(model):
    assert model.held_accuracy > 0.95 and 0.2 < model.temperature < 5
    lines = [b"Licensed under the Apache License, Version 1.1.", b"released under the MIT license",
             b"nothing of that kind is said here", b""]
    best, chance = model.classify([licences.line_words(line) for line in lines])
    assert [model.classes[i] for i in best[:3]] == ["apache", "mit", licences.UNKNOWN]
    assert ((chance > 0) & (chance <= 1)).all()


def test_lines_keep_their_features_apart():
    lines = [[b"a", b"b"], [], [b"c"], [b"a", b"b", b"c"]]
    at, sizes = licences.feature_rows(lines)
    assert sizes.tolist() == [3, 0, 1, 5]
    alone = [licences.feature_rows([line])[0] for line in lines]
    assert np.concatenate(alone).tolist() == at.tolist()


def test_wrapped_and_embedded_long_notices(model):
    import textwrap

    import pyarrow as pa

    texts, want = [], []
    for family, notices in licences.NOTICES.items():
        for notice in notices:
            if len(licences.pairs_of(licences.line_words(notice.encode()))) >= 20:
                head = "plain line of words that say little\n\n"
                texts += [head + textwrap.fill(notice, 72) + "\n\nplain line", " ".join(
                    ["words that say little"] * 60 + [notice] + ["plain line of words"] * 60)]
                want += [(family, 2), (family, 0)]
    batch = pa.RecordBatch.from_pydict({"_id": list(range(len(texts))), "_text": [t.encode() for t in texts]})
    got = [r for b in licences._scan(model)([batch]) for r in b.to_pylist() if r["confirmed"]]
    assert {(r["_id"], r["family"], r["line"]) for r in got} == {(i, *w) for i, w in enumerate(want)} and want
