import random
import zlib

import numpy as np
import pytest
import sentencepiece

from tidemark.llm import sentencepieces
from tidemark.llm.queries import PIECES, op3_sentencepiece, table, vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))


def test_the_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    got = op3_sentencepiece(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids) and r.decodes_back
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_odd_texts_equal_the_library(library):
    random.seed(4)
    letters = "abcdefgh ▁éß\n\tthe ing er  tion,.!?0123日\U0001f600"
    texts = ["", " ", "\n", "\n\na", "  a  ", "a▁ b", "<s> <0x0A>", " " * 40 + "x", "aaaaaaaaaaaaaaa"]
    texts += ["".join(random.choices(letters, k=random.randint(1, 60))) for _ in range(1500)]
    model = sentencepieces.Transducer(vocabulary(PIECES))
    for text in texts:
        ids = model.encode(text)
        assert ids == library.encode(text), text
        assert model.decode(ids) == library.decode(ids)
        assert "▁" in text or model.decode(ids) == text


def test_a_small_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "MEMO_ENTRIES", 3)
    model = sentencepieces.Transducer(vocabulary(PIECES))
    text = "Words that come and words that go, come and go again."
    assert model.encode(text) == library.encode(text)


def test_decoding_rows(spark):
    docs = spark.createDataFrame([(1, "a b\nc"), (2, None)], "doc_id long, text string")
    ids = sentencepieces.encode(docs, vocabulary(PIECES))
    back = sentencepieces.decode(ids.select("doc_id", "ids"), vocabulary(PIECES))
    assert {r.doc_id: r.text for r in back.collect()} == {1: "a b\nc", 2: ""}


def test_odd_ids(spark, library):
    random.seed(5)
    model = sentencepieces.Transducer(vocabulary(PIECES))
    unknown = library.decode([0])
    hello = library.encode("hello there")
    for _ in range(2000):
        kinds = [0, 1, 2, 35, random.randrange(259, 32000), random.randrange(40, 120)]
        ids = random.choices(kinds, k=random.randint(0, 8))
        assert model.decode(ids) == library.decode(ids), ids
    for odd in (-1, None, 10**6):
        assert model.decode([odd, *hello]) == unknown + " hello there"
    rows = spark.createDataFrame([(1, [None, -1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    back = sentencepieces.decode(rows, vocabulary(PIECES))
    assert {r.doc_id: r.text for r in back.collect()} == {1: 2 * unknown, 2: None, 3: ""}


def test_words_that_begin_alike_and_long_ones(library):
    random.seed(6)
    parts = ["th", "er", "tion", "é", "日", "ing", "x", "#", "."]
    words = ["".join(random.choices(parts, k=random.randint(1, 9))) for _ in range(3000)]
    words += [w[:cut] for w in words[:500] for cut in (1, 3)] + ["ab" * 300, "x" * 64, "x" * 63]
    texts = [" ".join(random.choices(words, k=20)) + random.choice(["", "\n", "\nthe"]) for _ in range(400)]
    model = sentencepieces.Transducer(vocabulary(PIECES))
    got = model.encode_all(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == library.encode(texts)
