import base64
import random
import uuid

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers_llm import empty
from tokenizers import Tokenizer

from seriesprep.llm import byte_bpe, token_blocks
from seriesprep.layout import shared_folder

ALPHABET = " \n\t\r  'streallmdABz09²½é漢字Ⅷ\x1c\x85\xa0　_-!?.,\x00\U0001f642́ ΣσßİΙ"


def strings(n=4000, most=50):
    rng = random.Random(5)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most))) for _ in range(n)]


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def plain_bpe():
    with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_rank_library_and_round_trips():
    coder, plain = byte_bpe.Encoder(*byte_bpe.vocabulary()), plain_bpe()
    for texts in (strings(), ["", " ", "  ", "a" * 3000, " the" * 2000]):
        for text, raw in zip(texts, coder.encode(texts)):
            assert ids_of(raw) == plain.encode_ordinary(text)
            assert coder.decode(raw) == text.encode()


def test_byte_bpe_keeps_its_answer_when_the_table_is_emptied(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 5)
    coder, plain = byte_bpe.Encoder(*byte_bpe.vocabulary()), plain_bpe()
    for text in strings(200):
        assert ids_of(coder.encode([text])[0]) == plain.encode_ordinary(text)


def test_byte_bpe_on_a_table(spark, docs):
    model, pattern = byte_bpe.vocabulary()
    coded = byte_bpe.decode(byte_bpe.encode(docs, model, pattern), model, pattern)
    plain = plain_bpe()
    for r in coded.collect():
        assert ids_of(r["ids"]) == plain.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert coded.columns == [*docs.columns, "ids", "decoded"]
    assert byte_bpe.encode_and_decode(empty(spark), model, pattern).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.encode(docs, model, pattern, out="lang")


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000, 5001])
@pytest.mark.parametrize("most", [1, 2, 300, 49_408, 2**32])
def test_blocks_round_trip(n, most):
    ids = np.random.default_rng(n).integers(0, most, n, dtype=np.uint64).astype(np.uint32)
    if n > 9:
        ids[7] = 2**32 - 1
    starts, payload = token_blocks.encode_blocks(ids)
    assert len(starts) == -(-n // token_blocks.BLOCK) + 1
    assert (token_blocks.decode_blocks(starts, payload) == ids).all()


def plain_words():
    tk = Tokenizer.from_file(public_tokenizers.path(token_blocks.VOCABULARY))
    return lambda text: tk.encode(text, add_special_tokens=False).ids


def test_words_equal_the_library():
    with open(public_tokenizers.path(token_blocks.VOCABULARY), encoding="utf-8") as f:
        coder = token_blocks.WordEncoder(f.read())
    plain = plain_words()
    special = ["a <|endoftext|> b", "x<|startoftext|>y", "<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|EndOfText|>", "<| endoftext |>", "é<|endoftext|>漢", "<|endoftext|", "<|endoftext|>"]
    texts = strings(3000) + special
    for text, raw in zip(texts, coder.encode(texts, b"")):
        assert ids_of(raw) == plain(text)
    assert ids_of(coder.encode(special[:1], b"")[0]) == [320, 49407, 321]


def test_files_hold_all_documents_in_order(spark, docs, monkeypatch):
    monkeypatch.setattr(token_blocks, "SEGMENT_TOKENS", 50)
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    token_blocks.write(docs, path)
    plain = plain_words()
    rows = [(r["doc_id"], np.array([*plain(r["text"] or ""), 1], "<u4").tobytes()) for r in docs.collect()]
    rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    at, want = 0, []
    for doc, ids in rows:
        want.append((doc, at, ids))
        at += len(ids) // 4
    got = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in token_blocks.read(spark, path).orderBy("start").collect()]
    assert got == want


def test_files_of_an_empty_table(spark):
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    token_blocks.write(empty(spark), path)
    assert token_blocks.read(spark, path).count() == 0


def test_pretokens_are_merged_once_in_two_rounds():
    with open(public_tokenizers.path(token_blocks.VOCABULARY), encoding="utf-8") as f:
        coder = token_blocks.WordEncoder(f.read())
    plain = plain_words()
    merged = []
    merge = coder.merge
    coder.tokens.merge = lambda letters: merged.append(letters) or merge(letters)
    texts = ["Zoé's ñandú, 3½ times zoé", "\xa1¿qué! ß\xb5\xff \x7eé", ""]
    for _ in range(3):  # each time the table before is kept as the older one
        assert [ids_of(raw) for raw in coder.encode(texts, b"")] == [plain(t) for t in texts]
        coder.tokens = token_blocks.Pretokens(coder.tokens.merge, coder.letters, coder.tokens)
        assert not coder.tokens.older.older
    assert merged and len(merged) == len(set(merged))
