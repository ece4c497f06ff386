import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import decontaminate
from tidemark.llm.queries import op5_decontamination, table

SF_DIR = "/root/testdata/sf0.01"


def brute(docs, items, similarity=0.8):
    """Pairs of a document and an item with a window of the item's size so similar."""
    cut = lambda words: [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    items = {i: cut(t.lower().split()) for i, t in items}
    holders = defaultdict(set)
    for i, parts in items.items():
        for part in parts:
            holders[part].add(i)
    weight = lambda part: 1 if len(holders.get(part, ())) > 1 else 2
    found = set()
    for doc, text in docs:
        parts = cut(text.lower().split())
        for item in {i for part in parts for i in holders.get(part, ())}:
            own, size = Counter(items[item]), len(items[item])
            for at in range(len(parts) - size + 1):
                window = Counter(parts[at : at + size])
                low = sum(weight(p) * min(n, own[p]) for p, n in window.items())
                high = sum(weight(p) * max(window[p], own[p]) for p in window | own)
                if low >= similarity * high:
                    found.add((doc, item))
                    break
    return found


def test_the_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    got = op5_decontamination(spark, SF_DIR).collect()
    assert {(r.doc_id, r.item_id) for r in got} == exact(docs, items) and got
    assert all(r.similarity >= 0.8 for r in got)


@pytest.fixture(scope="module")
def planted(spark):
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    items = [(i, " ".join(words(f"i{i}w", 40 + i))) for i in range(6)]
    items.append((90, items[0][1].upper()))
    docs = []
    for i, (item, text) in enumerate(items[:6]):
        parts = text.split()
        around = words(f"d{i}x", 30)
        one = parts[:1] + ["other"] + parts[2:]
        docs += [
            (10 * i, " ".join([*around, *parts, *around])),
            (10 * i + 1, " ".join([*around, *one, *around])),
            (10 * i + 2, " ".join([*around, *parts[:12], *around])),
            (10 * i + 3, " ".join(parts)),
            (10 * i + 4, "  \n".join(["start", *parts[2:]])),
        ]
    return docs, items


def test_near_copies_and_parts(spark, planted):
    docs, items = planted
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(items, "item_id long, text string"))
    got = decontaminate.contaminated(*frames).collect()
    want = exact(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert (0, 0) in want and (0, 90) in want and (2, 0) not in want and (51, 5) in want
    starts = {r.doc_id: r.start for r in got if r.item_id == 3}
    assert starts[30] == 30 and starts[33] == 0


def test_no_python_in_the_plan(spark):
    plan = op5_decontamination(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def exact(docs, items, similarity=0.8):
    """As :func:`brute`, and a document shorter than an item is compared as a whole."""
    found = brute(docs, items, similarity)
    cut = lambda text: Counter(zip(*[text.lower().split()[k:] for k in range(5)]))
    own = {i: cut(t) for i, t in items}
    held = Counter(part for parts in own.values() for part in parts)
    weight = lambda part: 1 if held[part] > 1 else 2
    for doc, text in docs:
        window = cut(text)
        for item, parts in own.items():
            if sum(window.values()) < sum(parts.values()):
                low = sum(weight(p) * n for p, n in (window & parts).items())
                high = sum(weight(p) * n for p, n in (window | parts).items())
                if low and low >= similarity * high:
                    found.add((doc, item))
    return found


def both_ways(spark, docs, items):
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(items, "item_id long, text string"))
    got = decontaminate.contaminated(*frames).collect()
    assert {(r.doc_id, r.item_id) for r in got} == exact(docs, items)
    clean = {r.doc_id for r in decontaminate.keep_clean(*frames).collect()}
    assert clean == {d for d, _ in docs} - {r.doc_id for r in got}
    return {(r.doc_id, r.item_id): r for r in got}


def test_documents_shorter_than_an_item_are_one_window(spark, planted):
    docs, items = planted
    words = items[0][1].split()
    docs = [*docs, (100, " ".join(words[1:])), (101, " ".join(words[:-1])), (102, " ".join(words[:33])),
            (103, " ".join(words[:32])), (104, " ".join(words[:4])), (105, " ".join(words[:20] + words[22:]))]
    got = both_ways(spark, docs, items)
    assert {(10 * i + 4, i) for i in range(6)} <= set(got) and {(100, 0), (101, 90), (102, 0)} <= set(got)
    assert not {103, 104} & {doc for doc, _ in got}
    assert (got[100, 0].start, got[100, 0].n_words) == (0, 39) and got[100, 0].similarity == 35 / 36


def test_edited_copies_near_the_limit_are_all_found(spark):
    """One to five of an item's shingles changed, for items stored twice and for templated items."""
    items, docs = [], []
    for n, length in enumerate([17, 56, 43] * 20):
        words = [f"n{n}w{k}" for k in range(length)]
        if n % 3 == 2:
            words[:20] = [f"template{k}" for k in range(20)]
        items += [(2 * n, " ".join(words))] + ([(2 * n + 1, " ".join(words))] if n % 3 < 2 else [])
        for changed in range(1, 6):
            # The word so far from the end is in that many shingles.
            new = words[:-changed] + [f"n{n}c{changed}"] + words[len(words) - changed + 1 :]
            docs.append((100 * n + changed, " ".join(["before"] * 9 + new + ["after"] * 9)))
    found = both_ways(spark, docs, items)
    assert sum(r.similarity < 0.86 for r in found.values()) >= 100
