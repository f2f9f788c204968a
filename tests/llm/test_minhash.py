import random

import numpy as np
import pytest
from helpers_llm import empty, roots, shingles

from seriesprep.llm import minhash_dedup as mh
from seriesprep.llm.shingles import WordHashes, shingle_set


def brute(rows):
    sets = [shingles(t, 3) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    group = roots(len(rows), pairs)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else doc
        out.append((doc, len(sets[i]), least, doc is not None and doc == least))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def family(rng, size, spread, length=150):
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randint(0, spread)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        yield " ".join(words)


def test_halves_match_like_minhashes():
    """A hash of DEPTH minhashes agrees with probability J ** DEPTH, and half the tables need both sides."""
    rng = np.random.default_rng(5)
    agree, pairs = np.zeros(2 * mh.SIDE), 300
    for _ in range(pairs):
        shared, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (900, 50, 50))
        grid = mh.halves([np.unique(np.concatenate((shared, x))) for x in (a, b)])
        agree += grid[0] == grid[1]
    assert abs(agree.mean() / pairs - 0.9**mh.DEPTH) < 0.03
    assert abs(agree / pairs - 0.9**mh.DEPTH).max() < 0.15
    assert len(np.unique(mh.table_keys(grid[0, : mh.SIDE], grid[0, mh.SIDE :]))) == mh.SIDE**2


def test_verified_finds_the_groups_of_all_linked_pairs():
    rng = random.Random(2)
    hashes = WordHashes()
    sets = [shingle_set(t, hashes, 3) for k in (4, 9) for t in family(rng, 25, k)]
    want = [(i, j) for i in range(50) for j in range(i) if mh.linked(sets[i], sets[j])]
    grid = mh.halves(sets)
    assert roots(50, mh.verified(sets, grid)) == roots(50, want)
    side = [i % 2 for i in range(50)]
    across = [(i, j) for i, j in want if side[i] != side[j]]
    assert roots(50, mh.verified(sets, grid, side, list(range(50)))) == roots(50, across)
    assert mh.verified(sets, grid, side, [0] * 50) == []


@pytest.mark.parametrize("tile", [512, 3])
def test_near_duplicates(spark, docs, tile, monkeypatch):
    monkeypatch.setattr(mh, "TILE_CLASSES", tile)
    got = mh.near_duplicates(docs)
    assert result(got) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    rng = random.Random(7)
    texts = [t for size, k in ((40, 3), (40, 9), (30, 14), (1, 0)) for t in family(rng, size, k)]
    texts += [" ".join(t.split()[:3]) for t in texts[:5]] + [texts[0]] * 30
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert result(mh.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))) == brute(rows)


def test_empty_table(spark):
    assert mh.near_duplicates(empty(spark)).count() == 0
