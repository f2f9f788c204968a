import hashlib
import random

import numpy as np
import pytest
from helpers_llm import empty, roots, shingles

from seriesprep.llm import exact_dedup, graph, jaccard_join, line_dedup, signature_tree
from seriesprep.llm.graph import components


# ------------------------------------------------------------------- exact
@pytest.mark.parametrize("memory", [1 << 30, 500, 0])
def test_resolve_spills_and_compares_contents(memory):
    rng = random.Random(1)
    contents = [f"text {rng.randint(0, 60)}" * rng.randint(1, 3) for _ in range(800)]
    clash = "0" * 64  # every hash collides: only the contents tell rows apart
    for digest in (lambda c: hashlib.sha256(c.encode()).hexdigest(), lambda c: clash):
        found = exact_dedup.resolve(((digest(c), c, i) for i, c in enumerate(contents)), memory=memory)
        want = {c: {i for i, x in enumerate(contents) if x == c} for c in contents}
        assert sorted(map(sorted, found)) == sorted(map(sorted, want.values()))


def test_exact_dedup(spark, docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    want = []
    for doc, text in rows:
        group = [d for d, t in rows if t == text]
        keep = max((d for d in group if d is not None), default=None)
        want.append((doc, keep, len(group), doc == keep, hashlib.sha256(text.encode()).hexdigest()))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in exact_dedup.deduplicate(docs).collect()), key=key) == sorted(want, key=key)
    assert exact_dedup.deduplicate(empty(spark)).count() == 0


# ------------------------------------------------------------------- lines
def test_chunks_are_found_again_after_an_insertion():
    rng = random.Random(2)
    lines = [f"line {rng.random()}" for _ in range(60)]
    a = {c for _, _, c in line_dedup.chunks("\n".join(lines))}
    b = {c for _, _, c in line_dedup.chunks("\n".join(["new", "lines", *lines[:30], "more", *lines[30:]]))}
    assert len(a & b) >= len(a) - 3


def test_line_dedup(spark, docs):
    rows = {(r["doc_id"], r["text"]) for r in docs.collect()}
    order = spark.createDataFrame(list(rows), "i bigint, t string").selectExpr("i", "t", "xxhash64(t) h").collect()
    order.sort(key=lambda r: (r["i"] is None, r["i"] or 0, r["h"]))
    first, want = {}, {}
    for r in order:
        if r["t"] is not None:
            lines, cut = r["t"].split("\n"), []
            for a, n, c in line_dedup.chunks(r["t"]):
                if first.setdefault(c, (r["i"], r["t"], a)) != (r["i"], r["t"], a):
                    cut.append((a, n))
            for a, n in reversed(cut):
                del lines[a : a + n]
            want[r["i"], r["t"]] = "\n".join(lines)
    source = docs.withColumn("original", docs["text"])
    got = line_dedup.deduplicate(source)
    assert got.columns == source.columns
    got = got.collect()
    assert len(got) == docs.count()
    assert any(r["text"] != r["original"] for r in got)
    for r in got:
        assert r["text"] == want.get((r["doc_id"], r["original"]))
    assert line_dedup.deduplicate(empty(spark)).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 6])
def test_planted_passages_go_whole(spark, count):
    rng = random.Random(count)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows, want = [], []
    for i in range(12):
        passage = [line(-(-60 // count)) for _ in range(count)]
        for k in range(3):
            before, after = [[line(12) for _ in range(rng.randint(0, 4))] for _ in range(2)]
            rows.append((3 * i + k, "\n".join(before + passage + after)))
            want.append((3 * i + k, "\n".join(before + (passage if k == 0 else []) + after)))
    again = line(10)
    rows += [(100, "\n".join([again] * 20)), (None, rows[0][1])]  # repeats inside a document, overlapping its first place
    want += [(100, "\n".join([again] * 5)), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = line_dedup.deduplicate(docs, least_words=50, spans="removed").collect()
    assert {r["doc_id"]: r["text"] for r in got} == dict(want)
    for r in got:
        assert all(a["line"] + a["lines"] < b["line"] for a, b in zip(r["removed"], r["removed"][1:]))
    assert line_dedup.deduplicate(docs.limit(0), least_words=50).count() == 0


# --------------------------------------------------------------- components
@pytest.mark.parametrize("task", [400_000, 20])
def test_components(spark, task, monkeypatch):
    monkeypatch.setattr(graph, "TASK_EDGES", task)
    rng = random.Random(3)
    for pairs in ([], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)]):
        found = components(spark.createDataFrame(pairs, "a bigint, b bigint").repartition(3))
        want = roots(100, pairs)
        got = {r["node"]: r["root"] for r in found.collect()}
        assert got == {x: want[x] for p in pairs if p[0] != p[1] for x in p}


# ------------------------------------------------------------------ Jaccard
def test_signature_tree_loses_no_link():
    rng = np.random.default_rng(1)
    draw = lambda n: np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    for _ in range(40):
        base = [draw(rng.integers(1, 60)) for _ in range(6)]
        sets = []
        for _ in range(rng.integers(1, 60)):
            b = base[rng.integers(0, 6)]
            sets.append(np.unique(np.concatenate((b[rng.random(len(b)) < rng.choice([1, 0.95, 0.85])], draw(rng.integers(0, 6))))))
        sets = [s for s in sets if len(s)]
        linked = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))]
        half = len(sets) // 2
        assert roots(len(sets), signature_tree.links(sets)) == roots(len(sets), linked)
        assert roots(len(sets), signature_tree.links(sets[:half], sets[half:])) == roots(len(sets), [(i, j) for i, j in linked if i < half <= j])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    group = roots(len(rows), pairs)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None) if sets[i] else doc))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile", [1024, 2])
def test_near_duplicates(spark, docs, tile, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE_DOCUMENTS", tile)
    found = jaccard_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_near_duplicates_of_an_empty_table(spark):
    assert jaccard_join.near_duplicates(empty(spark)).count() == 0
