import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers_llm import empty

from seriesprep.llm import token_alignment as ta


@pytest.fixture(scope="module")
def vocabularies():
    return ta.vocabularies()


def tokens(text, vocabularies, cache={}):
    """Ids and byte ends of both tokenizers by the libraries themselves, or nothing."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not cache:
        cache["a"] = Tokenizer.from_str(vocabularies[0])
        cache["a"].encode_special_tokens = True
        cache["b"] = sentencepiece.SentencePieceProcessor(model_proto=vocabularies[1])
    a, b = cache["a"], cache["b"]
    if not text:
        return [], []
    letters = ta.byte_letters()
    x = a.encode(" " + text, add_special_tokens=False)
    xs = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in x.ids]
    ys = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        ys.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (xs, ys) if all(b"".join(t for _, t in s) == raw for s in (xs, ys)) else ([], [])


def brute(rows, vocabularies):
    parts = []
    for doc, text in rows:
        xs, ys = tokens(text, vocabularies)
        spans = []
        for side in (xs, ys):
            at, out = 0, []
            for i, t in side:
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        texts, links, lo = [], [], 0
        for hi in common:
            texts.append("|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in spans))
            links += [(i, j) for i, s, e in spans[0] if lo <= s < hi for j, u, v in spans[1] if lo <= u < hi and max(s, u) < min(e, v)]
            lo = hi
        parts.append((doc, len(xs), len(ys), texts, links))
    count = Counter(p for *_, links in parts for p in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc, na, nb, texts, links in parts:
        digest = hashlib.sha256(";".join(texts).encode()).hexdigest() if texts else ""
        out.append((doc, na, nb, len(texts), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), digest))
    return sorted(out, key=str)


def texts_with_surprises():
    odd = ["", " ", "a", "  two  spaces\n\n\tand tabs ", "a <|endoftext|> b <s> </s> <0x41>", "▁ already", "naïve café \U0001f642\U0001f469‍\U0001f52c 漢字かな ½²", "é", "\x00\x01\x1c\x85\xa0", "ﬁ ① Å", "supercalifragilistic" * 30, "x" * 5000, "﻿bom", "don't it's we'll", "1234567890 3.14159"]
    rng = random.Random(4)
    letters = "aeio tn\n\t <|>é漢🙂's1."
    return odd + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(60)]


@pytest.mark.parametrize("chunk", [1_500_000, 50])
def test_align_equals_brute_force(spark, docs, vocabularies, chunk, monkeypatch):
    monkeypatch.setattr(ta, "CHUNK_LINKS", chunk)
    monkeypatch.setattr(ta, "MERGE_PAIRS", chunk)
    monkeypatch.setattr(ta, "PIECE_LINKS", chunk // 2)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 20_000] + list(enumerate(texts_with_surprises(), 1000))
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 chunk", "2 bucket", "3 kind").repartition(4)
    got = sorted((tuple(r) for r in ta.align(table, *vocabularies).collect()), key=str)
    assert got == brute(rows, vocabularies)
    assert sum(r[1] > 0 for r in got) > 60 and any(r[1] == 0 for r in got)


def test_groups_as_text(spark, vocabularies):
    rows = list(enumerate(texts_with_surprises()))
    got = {r["doc_id"]: r for r in ta.groups(spark.createDataFrame(rows, "doc_id bigint, text string"), *vocabularies).collect()}
    want = {r[0]: r for r in brute(rows, vocabularies)}
    for i, r in got.items():
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == want[i][1:5]
        assert (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") == want[i][7]


def test_long_text_and_empty_table(spark, docs, vocabularies):
    long = docs.filter("doc_id IN (103, 104)")
    got = {r["doc_id"]: r for r in ta.align(long, *vocabularies).collect()}
    assert got[103]["n_a"] > 60_000 and got[104]["n_links"] > got[103]["n_links"]
    assert ta.align(empty(spark), *vocabularies).count() == 0


def test_terminals_over_long_chains():
    """Tokens that never end together until the last byte: one component, found by doubling."""
    n = 4097
    ends_a, ends_b = np.append(np.arange(2, 2 * n, 2), 2 * n + 1), np.arange(1, 2 * n + 2, 2)
    assert set(ta.terminals(ends_a, ends_b).tolist()) == {n}
    assert ta.terminals(np.array([3, 5, 9]), np.array([3, 9])).tolist() == [0, 1, 1, 0, 1]


def test_code_type():
    assert ta._code_type(50_257, 32_000) == "<u4" and ta._code_type(1 << 20, 1 << 20) == "<u8"


def test_ranks_give_the_ids_of_the_library(vocabularies):
    side = ta.ByteSide(vocabularies[0])
    rng = random.Random(8)
    latin = "".join(map(chr, range(0x250)))
    texts = ["".join(rng.choice(latin if k % 2 else "aehtil  '\n\t1.,sdé") for _ in range(rng.randint(0, 200))) for k in range(3000)] + [" " * 5000, "y" * 5000, "\n" * 399 + "z"]
    assert side.by_rank is not None
    assert side.encode(texts) == [e.ids for e in side.library().encode_batch([" " + t for t in texts], add_special_tokens=False)]
