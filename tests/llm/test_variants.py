import random
import re
import warnings
import zlib

import numpy as np
import pytest
from helpers_llm import empty

from seriesprep.llm import spelling_variants as sv


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least_length, least_count, factor):
    total = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] = total.get(run, 0) + 1
    n = {w: k for w, k in total.items() if len(w) >= least_length and k >= least_count}
    out, form = {}, {}
    for w in n:
        others = sorted((-n[v], v) for v in n if near(w, v))
        if others and -others[0][0] >= factor * n[w]:
            form[w] = others[0][1]
        out[w] = (n[w], len(others))
    rows = set()
    for w, (k, m) in out.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, k, m, form.get(w), n.get(form.get(w)), root))
    return rows


def result(df):
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("q", [1, 2, 4, 30])
def test_neighbourhood_holds_every_near_reduced_word(q):
    rng = random.Random(q)
    letters = "abcdezÀÿ"
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        for _ in range(60):
            word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
            around = set(sv.neighbourhood(word, lambda n: q).tolist())
            i = rng.randrange(len(word))
            for other in (word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word + "z"):
                assert sv.reduced_hash(sv.symbols(other, q)) in around
            n = len(word)
            assert len(around) <= 1 + n + n * (q - 1) + (n + 1) * q


def test_alphabet_grows_with_the_vocabulary():
    small, large = sv.alphabet({8: 1000}), sv.alphabet({8: 10**9, 0: 5})
    assert small(8) < large(8) and large(8) ** 8 >= 32 * 10**9 and large(70) == sv.LEAST_SYMBOLS


@pytest.mark.parametrize("table_words", [200_000, 3])
def test_variants_equal_brute_force(spark, docs, table_words, monkeypatch):
    monkeypatch.setattr(sv, "TABLE_WORDS", table_words)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for least_length, least_count, factor in ((1, 1, 2), (3, 2, 5)):
        assert result(sv.variants(docs, least_length=least_length, least_count=least_count, factor=factor)) == brute(rows, least_length, least_count, factor)


def test_chains_ties_and_long_words(spark):
    long = "x" * 3000
    words = {"abcdef": 500, "abcdefg": 60, "abcdefgh": 7, "zzzzzz": 5, "zzzzzy": 25, "azzzzz": 25, "Écouter": 30, "écouter": 5, long: 30, long + "y": 5, "seul÷e": 9}
    rows = [(i, f"{w} " * n) for i, (w, n) in enumerate(words.items())] + [(None, None), (None, ""), (None, "Abcdef"), (7, "1 2 3")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'w' word", "'n' n", "1 id", "2 h", "'r' root")
    got = result(sv.variants(docs))
    assert got == brute(rows, 6, 5, 5)
    root = {r[0]: r[5] for r in got}
    assert root["abcdefgh"] == "abcdef" and root[long + "y"] == long
    assert next(r for r in got if r[0] == "zzzzzz")[3] == "azzzzz"


def test_empty_table(spark):
    assert sv.variants(empty(spark)).count() == 0
    assert np.array_equal(sv.powers(1), [1])


def test_neighbourhoods_are_never_broadcast(spark):
    words = spark.createDataFrame([(i, f"wordin{chr(97 + i)}", 5 + i) for i in range(9)], "id bigint, word string, n bigint")
    plan = sv.near_words(words)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [h#" in plan and "BroadcastHashJoin [h#" not in plan
    assert sv.near_words(words).count() == 72
