import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import tokenfiles
from tidemark.llm.queries import BYTE_PAIRS, op10_token_output, table, vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary(BYTE_PAIRS))


def packed(library, text, *more):
    return np.asarray([*library.encode(text, add_special_tokens=False).ids, *more], "<u4").tobytes()


def test_the_query_equals_the_library(spark, library):
    texts = sorted((r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect())
    got = {r.doc_id: r for r in op10_token_output(spark, SF_DIR).collect()}
    start = 0
    for doc, text in texts:
        ids, r = packed(library, text, 2), got[doc]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


def test_odd_texts_equal_the_library(library):
    random.seed(5)
    letters = "abc the ing.\n\t ,!?é日0123 's 're  ​ 　\x1c<|endoftext|>\U0001f600"
    texts = ["", " ", "\n", "a ", "\na", "a\n", " a\n\nb", "it's <|endoftext|>a"]
    texts += ["".join(random.choices(letters, k=random.randint(1, 50))) for _ in range(2000)]
    own = tokenfiles.Encoder(vocabulary(BYTE_PAIRS))
    assert own.by_word and own.encode(texts) == [packed(library, text) for text in texts]


def test_files_are_in_order_and_pruned(spark, library):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id long, text string")
    path = tokenfiles.write(docs.repartition(5), vocabulary(BYTE_PAIRS))
    rows = [r.doc_id for r in tokenfiles.read(spark, path).orderBy("start").collect()]
    assert rows == list(range(400))
    found = tokenfiles.lookup(spark, path, [7, 399, 1000])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert {r.doc_id: r.ids for r in found.collect()} == {
        i: [*library.encode(f"text {i}", add_special_tokens=False).ids, 2] for i in (7, 399)
    }
