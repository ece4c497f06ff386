import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.queries import op6_simhash_dedup, table

SF_DIR = "/root/testdata/sf0.001"


def brute_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or (
        [b" ".join(words)] if words else []
    )
    codes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def brute_parts(ids, prints, bits=3):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = root(ids[a]), root(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_the_query_equals_brute_force(spark):
    docs = [(r.doc_id, brute_print(r.text)) for r in table(spark, SF_DIR, "documents").collect()]
    parts = brute_parts([d for d, _ in docs], [p for _, p in docs])
    got = op6_simhash_dedup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        d: (f"{p:016x}", parts[d]) for d, p in docs
    }


def test_the_code_is_perfect():
    code = simhash.Golay()
    assert (code.leader != 0).sum() == 2**11 - 1
    words = np.arange(1 << 23)
    assert (np.bincount(code.index(words)) == 2**11).all()


def test_all_pairs_within_three_bits_share_a_bucket():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.where(rng.random(4000) < 0.9, np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64), np.uint64(0))
    near = [set(zip(*(a.tolist() for a in simhash.bucket_keys(p)))) for p in (x, y)]
    shared = near[0] & near[1]
    assert {row for row, _ in shared} == set(range(4000))
    # And still if their buckets are dealt out again.
    for row, key in list(shared)[:3000]:
        keys = [set(simhash.sub_keys(p[row : row + 1], np.array([key]))[1].tolist()) for p in (x, y)]
        pair = key >> 24
        i, j = ((0, 1), (0, 2), (1, 2))[pair]
        apart = [int(np.bitwise_count((x[row] ^ y[row]) >> np.uint64(s) & np.uint64((1 << w) - 1)))
                 for s, w in simhash._SEGMENTS]
        if apart[i] + apart[j] <= 2:
            assert keys[0] & keys[1]


@pytest.mark.parametrize("bucket_nodes", [2, 1 << 14])
def test_dense_groups_link_as_by_brute_force(spark, bucket_nodes):
    rng = np.random.default_rng(3)
    prints = []
    for centre in rng.integers(0, 2**63, 6, dtype=np.uint64):
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            prints.append(int(centre) ^ sum(1 << int(b) for b in flips))
    prints = sorted(set(prints))
    ids = list(range(100, 100 + len(prints)))
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in zip(ids, prints)]
    frame = spark.createDataFrame(rows, "node long, fp long")
    links = simhash.links(frame, 3, bucket_nodes)
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    want = brute_parts(ids, prints)
    assert {i: got.get(i, i) for i in ids} == want and len(set(want.values())) < len(ids)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    frame = spark.createDataFrame(edges, "x long, y long")
    got = {r.node: r.component for r in components(frame, "x", "y").collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(frame.where("false"), "x", "y").collect() == []
