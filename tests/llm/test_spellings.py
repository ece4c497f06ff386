import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import cases
from tidemark.llm import spellings
from tidemark.llm.queries import op12_spelling_variants, table

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def counts(docs, every=31):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += len(run) >= 7
    return {word: n for word, n in total.items() if n >= 2}


def near(one, other):
    """One edit apart, by the plain recurrence over both words."""
    if abs(len(one) - len(other)) > 1 or one == other:
        return False
    row = list(range(len(other) + 1))
    for i, a in enumerate(one, 1):
        last, row = row, [i]
        for j, b in enumerate(other, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return row[-1] == 1


def brute(n):
    """Every word with each of its neighbours, met through all its deletions."""
    holders = defaultdict(set)
    for word in n:
        for at in range(len(word)):
            holders[word[:at] + word[at + 1 :]].add(word)
        holders[word].add(word)
    met = defaultdict(set)
    for group in holders.values():
        for one in group:
            met[one] |= group
    found = {}
    for word in n:
        others = [other for other in met[word] if near(word, other)]
        best = min(others, key=lambda other: (-n[other], other), default=None)
        found[word] = (len(others), best if others and n[best] >= 10 * n[word] else None)
    rows = set()
    for word, (k, form) in found.items():
        root = word
        while found[root][1]:
            root = found[root][1]
        rows.add((word, form, root, n[word], k, n[form] if form else None))
    return rows


def as_set(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {tuple(r[c] for c in COLUMNS) for r in rows}


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]


def test_the_query_equals_brute_force(spark, texts):
    got = as_set(op12_spelling_variants(spark, SF_DIR))
    assert got == brute(counts(texts)) and sum(row[1] is not None for row in got) > 100


#: Few letters and one common front, so that all blocks are large and pairs meet in many ways.
def crowd(letters, size, seed, front=""):
    rng = np.random.default_rng(seed)
    made = {front + "".join(rng.choice(list(letters), rng.integers(7, 11))) for _ in range(size)}
    return {word: int(2 + 3 ** rng.integers(0, 9)) for word in sorted(made)}


@pytest.mark.parametrize(
    "front, bounds",
    [("", (4096, 1024, 1 << 17)), ("vorneweg", (4096, 1024, 1 << 17)), ("é", (16, 8, 1 << 17)), ("", (4096, 1024, 90))],
)
def test_crowded_blocks_equal_brute_force(spark, monkeypatch, front, bounds):
    for name, value in zip(("BLOCK_WORDS", "INDEX_WORDS", "BLOCK_LETTERS"), bounds):
        monkeypatch.setattr(spellings, name, value)
    n = crowd("abé", 700, len(front), front)
    rows = [(i, word, count) for i, (word, count) in enumerate(n.items())]
    docs = spark.createDataFrame(rows, "doc_id long, word string, n int")
    docs = docs.selectExpr("doc_id", "repeat(word || '. ', n) as text")
    assert as_set(spellings.variants(docs)) == brute(n)


def test_one_edit_in_bits_equals_the_recurrence():
    rng = np.random.default_rng(9)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(5, 7))) for _ in range(200)})
    letters = np.array(words, "U6").view(np.uint32).reshape(-1, 6)
    alphabet, coded = np.unique(letters, return_inverse=True)
    coded = coded.reshape(letters.shape)
    lengths = (letters > 0).sum(1)
    index = spellings.Index(coded, lengths, len(alphabet), 5)
    for longer in (False, True):
        asked = np.flatnonzero(lengths == 5 + longer)
        rows, found = spellings._pairs(index.one_apart(coded[asked], longer))
        got = {(words[asked[i]], words[j]) for i, j in zip(rows, found)}
        assert got == {(a, b) for a in words for b in words
                       if len(a) == 5 + longer and near(a, b) and 5 in (len(a), len(b))}


def test_chains_lead_to_the_last_form(spark):
    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    rows = [(i, word, 2 * 10**i) for i, word in enumerate(chain)]
    docs = spark.createDataFrame(rows, "doc_id long, word string, n int")
    docs = docs.selectExpr("doc_id", "repeat(upper(word) || ' ', n) as text")
    got = {r.word: r for r in spellings.variants(docs).collect()}
    assert {got[word].root for word in chain} == {chain[-1]}
    assert [got[word].form for word in chain] == [*chain[1:], None]


def test_odd_rows(spark):
    long = "x" * 300 + "y" * 300
    rows = [*cases.DOCUMENTS, (None, "Wandering wandering Ärgernis ärgernis ärgernis", None, None),
            (20, f"{long} {long} {long}z {long}z {long[:-1]} {long[:-1]}", "en", "a"),
            (21, "İstanbullu İstanbullu İı naïveté× naïveté× naïveté÷ naïveté÷ abcdef abcdef", "en", "a")]
    docs = cases.documents(spark, rows).selectExpr("*", "'x' as word", "1 as n", "2 as m", "'y' as form")
    for every in (None, 2, 31):
        got = as_set(spellings.variants(docs, drop_one_in=every))
        assert got == brute(counts([(r[0], r[1]) for r in rows], every))
    assert ("ärgernis", None, "ärgernis", 2, 0, None) in as_set(spellings.variants(docs))
    assert spellings.variants(docs.where("false"), drop_one_in=31).collect() == []
