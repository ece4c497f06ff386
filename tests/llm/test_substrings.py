import hashlib
from collections import defaultdict

import pytest

from tidemark.llm import substrings
from tidemark.llm.queries import op1_substring_dedup, table

SF_DIR = "/root/testdata/sf0.001"


def brute(docs, width):
    first = {}
    for doc, words in sorted(docs):
        for at in range(len(words) - width + 1):
            first.setdefault(tuple(words[at : at + width]), doc)
    out = {}
    for doc, words in docs:
        gone = [False] * len(words)
        for at in range(len(words) - width + 1):
            if first[tuple(words[at : at + width])] < doc:
                gone[at : at + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text.encode().split()) for r in table(spark, SF_DIR, "documents").collect()]


def test_the_query_equals_brute_force(spark, texts):
    got = op1_substring_dedup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute(texts, 50)


@pytest.mark.parametrize("bucket_strings", [1, 1 << 16])
def test_short_windows_and_hot_buckets_equal_brute_force(spark, texts, bucket_strings):
    docs = table(spark, SF_DIR, "documents")
    got = substrings.remove_repeats(docs, width=6, seed=2, bucket_strings=bucket_strings).collect()
    want = brute(texts, 6)
    assert sum(x[1] for x in want.values()) > 100
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def test_windows_of_a_packed_string():
    assert substrings.windows_of(b"a bb c dd", 2) == [b"a bb", b"bb c", b"c dd"]
