import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import scoring
from tidemark.llm.queries import table

SF_DIR = "/root/testdata/sf0.001"


def brute(docs):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    ones, twos = Counter(), Counter()
    for i, found in tokens.items():
        if not held[i]:
            ones.update(found)
            twos.update(zip(["start", *found[:-1]], found))
    n, v = sum(ones.values()), len(ones)
    total, kinds = Counter(), defaultdict(Counter)
    for (h, _), c in twos.items():
        total[h] += c
        kinds[h][min(c, 3)] += 1
    of = Counter(twos.values())
    share = of[1] / (of[1] + 2 * of[2])
    off = {0: 0.0} | {r: min(max(r - (r + 1) * share * of[r + 1] / of[r], 0.05), r - 0.05) for r in (1, 2, 3)}
    out = {}
    for i, found in tokens.items():
        base = score = 0.0
        for h, w in zip(["start", *found[:-1]], found):
            root = (ones[w] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(root)
            if total[h]:
                c = twos[h, w]
                free = sum(off[r] * k for r, k in kinds[h].items()) / total[h]
                root = max(c - off[min(c, 3)], 0) / total[h] + free * root
            score += math.log10(root)
        out[i] = (held[i], len(found), sum(ones[w] > 0 for w in found), n, base, score)
    return out


@pytest.mark.parametrize("block_bytes", [20_000, 16 << 20])
def test_scores_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", block_bytes)
    docs = table(spark, SF_DIR, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = scoring.score(docs).collect()
    assert len(got) == len(want)
    for r in got:
        *exact, base, score = want[r.doc_id]
        assert [r.held_out, r.n_tokens, r.n_known, r.train_tokens] == exact
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_the_model_beats_the_root_on_texts_left_out(spark):
    got = scoring.score(table(spark, "/root/testdata/sf0.01", "documents")).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert sum(r.score > r.base_score for r in got) > 0.8 * len(got)


def test_counts_travel_in_few_bytes():
    for most, width in ((0, 1), (255, 1), (256, 2), (65536, 4), (2**40, 8)):
        counts = np.array([0, 1, most], np.int64)
        packed = scoring.narrow(counts)
        assert len(packed) == 1 + 3 * width and scoring.widen(packed).tolist() == counts.tolist()
    assert scoring.widen(scoring.narrow(np.zeros(0, np.int64))).tolist() == []
