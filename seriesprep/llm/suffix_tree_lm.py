"""Language-model scores from a probabilistic suffix tree.

Symbols are words (A-Z in lower case) and an end mark.  The root predicts by smoothed counts,
``(c + 0.5) / (N + 0.5 (V + 1))``; a longer context s with parent s' (one word less) by

    P(w | s) = (n(s, w) + ALPHA P(w | s')) / (n(s) + ALPHA)

and a symbol is scored by the longest suffix of what precedes it that the tree has as a state.  The memory is three
words: every context of one, two or three words that training text holds is judged, and retained if its next symbols
diverge from its parent's: the log-likelihood ratio over its own training symbols, each left out of its own counts, must be positive.
A context that occurs once has no symbol left to learn from, its ratio is 0: it is never a state, so nothing is asked
about it.  ``LEAST_SHARE`` and ``WORD_SHARES`` make a smaller tree, if a caller wants one.

Counts are exact over all training documents and grow with the corpus.  Work is laid out in chunks of about a million
tokens, written once as word numbers and bucketed by chunk, so that only questions and answers move.  Three times a
chunk asks buckets and is handed the totals over all chunks: of its distinct words, dealt by word; of its distinct word
pairs, dealt by the first word; and of its distinct runs of three and four words, dealt by the last two words
of the context.  All symbols after a context meet in one bucket, which judges it.  A frequent word, pair or
run costs one entry per chunk, not one row per occurrence.  No list of contexts is broadcast, and of the words only the totals of
the most frequent ones (``OFTEN``), which questions then need not carry.

Edge cases: null and empty texts have the end mark as their only token; a null id counts as the empty id when folds are
drawn; repeated rows are rows of their own; without training rows every token is unknown; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.layout import shared_folder
from seriesprep.llm.byte_bpe import slices
from seriesprep.llm.common import query, shuffle_width, stage, table, text_or_empty

CHUNK = 1_000_000  # tokens
CHUNK_DOCUMENTS = 1 << 15
LEAST_SHARE = 0.0  # of all tokens, for a context; 0: every context
WORD_SHARES = (0.0, 0.0, 0.0)  # of all tokens, for each word of a context of 1, 2, 3 words; 0: every word
ALPHA = 100.0
OFTEN = 2e-5  # of all tokens: every task knows the totals of such words, at most 1 / OFTEN, so no question repeats them
PART = 2_000_000  # training tokens per bucket of contexts, at least shuffle partitions of them
END = b"\n"  # never a word


class Numbers(dict):
    """Word to the number in which it first came up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def packed(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0]


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash; sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """``(bucket, from, to)`` of sorted hashes."""
    ends = np.searchsorted(buckets_of(hashes, buckets), np.arange(buckets + 1))
    return [(b, int(ends[b]), int(ends[b + 1])) for b in range(buckets) if ends[b] < ends[b + 1]]


FACTS = np.dtype([("id", "<i8"), ("null", "u1"), ("held", "u1"), ("n", "<i8")])


def chunked(docs: DataFrame, buckets: int) -> DataFrame:
    """One row per chunk (``facts, tokens``), and its words' training counts per bucket (``a`` hashes, ``b`` counts)."""
    schema = "chunk bigint, bucket int, a binary, b binary, facts binary, tokens binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        numbers, facts, parts, size = Numbers(), [], [], 0

        def flush():
            names = sorted(numbers, key=numbers.__getitem__)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
            hashes, place = np.unique(hashes, return_inverse=True)
            tokens = place[np.concatenate(parts)]
            about = np.array(facts, FACTS)
            trains = np.repeat(about["held"] == 0, about["n"])
            counts = np.bincount(tokens[trains], minlength=len(hashes))
            rows = [(b, hashes[s:e].tobytes(), packed(counts[s:e]), None, None) for b, s, e in _runs(hashes, buckets)]
            rows.append((-1, None, None, about.tobytes(), packed(tokens)))
            kinds = [pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * len(rows), pa.int64()), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                ["chunk", "bucket", "a", "b", "facts", "tokens"],
            )

        for batch in batches:
            ids, held = batch["doc_id"].to_pylist(), batch["held"].to_pylist()
            at = 0
            for texts in slices(batch["text"]):
                for text in texts:
                    words = text.encode("utf-8", "surrogatepass").lower().split()
                    words.append(END)
                    if facts and (size + len(words) > CHUNK or len(facts) == CHUNK_DOCUMENTS):
                        yield from flush()
                        chunk, numbers, facts, parts, size = chunk + 1, Numbers(), [], [], 0
                    parts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                    facts.append((ids[at] or 0, ids[at] is None, held[at], len(words)))
                    size += len(words)
                    at += 1
        if facts:
            yield from flush()

    return docs.mapInArrow(run, schema)


def by_chunk(chunks: DataFrame, width: int) -> DataFrame:
    """Write the chunks to the shared folder, bucketed where they are, and read them back: their text is not moved again."""
    spark = chunks.sparkSession
    name = f"lm_chunks_{uuid.uuid4().hex}"
    chunks.write.bucketBy(width, "chunk").option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


ANSWERS = ["kind", "chunk", "bucket", "a", "b", "c", "d"]  # what a chunk is told: by kind 1 words, 2 pairs, 3 longer runs
ANSWER = "kind int, chunk bigint, bucket int, a binary, b binary, c binary, d binary"
BLOBS = [f"x{i}" for i in range(8)]
QUESTION = "chunk bigint, bucket int, " + ", ".join(f"{b} binary" for b in BLOBS)


def _answers(kind: int, chunks: list[int], bucket: int, *blobs: list[bytes]) -> pa.RecordBatch:
    none = [None] * len(chunks)
    columns = [pa.array([kind] * len(chunks), pa.int32()), pa.array(chunks, pa.int64()), pa.array([bucket] * len(chunks), pa.int32())]
    return pa.RecordBatch.from_arrays([*columns, *[pa.array(b, pa.binary()) for b in [*blobs, none, none][:4]]], ANSWERS)


def by_bucket(questions: DataFrame, columns: list[str], answer: Callable[[int, list[int], list[list[bytes]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``answer(bucket, chunks, blobs of each)`` for every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunks, held = None, [], []
        for batch in batches:
            for bucket, chunk, *blobs in zip(*(batch[c].to_pylist() for c in ("bucket", "chunk", *columns))):
                if chunks and bucket != now:
                    yield from answer(now, chunks, held)
                    chunks, held = [], []
                now = bucket
                chunks.append(chunk)
                held.append(blobs)
        if chunks:
            yield from answer(now, chunks, held)

    rows = questions.select("bucket", "chunk", *columns)
    return rows.repartition(F.col("bucket")).sortWithinPartitions("bucket", "chunk").mapInArrow(run, schema)


def word_totals(counts: DataFrame, buckets: int, often: float) -> DataFrame:
    """Answers to each chunk for its words: ``a`` ranks by total within the bucket, ``b`` totals.

    A row of chunk -1 per bucket has the totals of its words counted at least ``often`` times (``b``, by rank) and its number of
    distinct training words ``distinct``.
    """

    def answer(bucket, chunks, held):
        hashes = [np.frombuffer(a, "<u8") for a, _ in held]
        known, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([unpacked(b) for _, b in held]), minlength=len(known)).astype(np.int64)
        rank = np.empty(len(known), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(known))
        if len(known) * buckets >= 1 << 32:
            raise ValueError("a bucket has too many words: raise spark.sql.shuffle.partitions")
        mine = np.split(place, np.cumsum([len(h) for h in hashes])[:-1])
        most = np.sort(total[(total >= often) & (total > 0)])[::-1]
        told = _answers(1, [*chunks, -1], bucket, [*[packed(rank[p]) for p in mine], None], [*[packed(total[p]) for p in mine], packed(most)])
        yield told.append_column("distinct", pa.array([*[None] * len(chunks), int((total > 0).sum())], pa.int64()))

    return by_bucket(counts, ["a", "b"], answer, ANSWER + ", distinct bigint")


@dataclass(frozen=True)
class Model:
    """What every task knows: sizes of the training text and the parameters."""

    n: int
    v: int
    alpha: float
    least: float  # occurrences of a context
    words: tuple[float, float, float]  # occurrences of each word of a context of 1, 2, 3 words
    buckets: int  # of words
    parts: int  # buckets of contexts
    often: float  # occurrences of the words below
    often_words: np.ndarray  # in ascending order
    often_totals: np.ndarray

    def told(self, total: np.ndarray) -> np.ndarray:
        """Totals as questions carry them: 0 for the words that every task knows."""
        return np.where(total >= self.often, 0, total)

    def known(self, word: np.ndarray, told: np.ndarray) -> np.ndarray:
        """The totals of words from what a question carries."""
        if not len(self.often_words):
            return told
        at = np.minimum(np.searchsorted(self.often_words, word), len(self.often_words) - 1)
        return np.where(self.often_words[at] == word, self.often_totals[at], told)

    def base(self, total: np.ndarray) -> np.ndarray:
        return (total + 0.5) / (self.n + 0.5 * (self.v + 1))

    def longer(self, count: np.ndarray, of: np.ndarray, below: np.ndarray) -> np.ndarray:
        return (count + self.alpha * below) / (of + self.alpha)

    def retained(self, context: np.ndarray, of: np.ndarray, count: np.ndarray, below: np.ndarray, contexts: int) -> np.ndarray:
        """Of each context: its gain is positive.  One entry per (context, symbol) counted ``count`` times in training."""
        fine = (count > 0) & (of >= self.least)
        context, of, count, below = context[fine], of[fine], count[fine], below[fine]
        gain = count * np.log((count - 1 + self.alpha * below) / (of - 1 + self.alpha) / below)
        return np.bincount(context, weights=gain, minlength=contexts) > 0


def model_of(words: DataFrame, n: int, buckets: int) -> Model:
    found = words.filter("chunk < 0").select("bucket", "b", "distinct").collect()  # a row per bucket, at most 1 / OFTEN totals
    totals = [unpacked(r["b"]).astype(np.int64) for r in found]
    numbers = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(t)) * buckets + r["bucket"] for r, t in zip(found, totals)]])
    order = np.argsort(numbers)
    totals = np.concatenate([np.zeros(0, np.int64), *totals])[order]
    # below two occurrences the gain of a context is 0
    least = tuple(max(2.0, max(s, LEAST_SHARE) * n) for s in WORD_SHARES)
    return Model(n, sum(r["distinct"] for r in found), ALPHA, max(2.0, LEAST_SHARE * n), least, buckets, max(buckets, n // PART), max(1.0, OFTEN * n), numbers[order], totals)


def part_of(last: np.ndarray, second: np.ndarray, parts: int) -> np.ndarray:
    """Bucket of the contexts that end in two words."""
    mixed = second.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return buckets_of(mixed, parts)


def _spans(x: np.ndarray) -> list[tuple[int, int]]:
    """``(from, to)`` of each run of equal numbers."""
    ends = np.flatnonzero(np.diff(x, append=-1)) + 1
    return list(zip([0, *ends[:-1]], ends))


def _before(x: np.ndarray, k: int) -> np.ndarray:
    """``x`` of the token k places before; whether there is one, the caller knows."""
    return np.concatenate((np.zeros(min(k, len(x)), x.dtype), x[: max(0, len(x) - k)]))


class Chunk:
    """A chunk and what it has been told."""

    def __init__(self, model: Model, text: pa.Table, told: pa.Table):
        row = text.slice(0, 1).to_pylist()[0]
        told = {kind: sorted((r for r in told.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"]) for kind in (1, 2, 3)}
        self.model, self.told = model, told
        self.about = np.frombuffer(row["facts"], FACTS)
        self.tokens = unpacked(row["tokens"]).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.about["n"])[:-1]))
        self.back = np.arange(len(self.tokens)) - np.repeat(self.first, self.about["n"])
        self.trains = np.repeat(self.about["held"] == 0, self.about["n"])
        ranks = [unpacked(r["a"]).astype(np.int64) for r in told[1]]
        self.bucket = np.repeat([r["bucket"] for r in told[1]], [len(r) for r in ranks])
        self.word = np.concatenate(ranks) * model.buckets + self.bucket  # its number in the whole corpus
        self.total = np.concatenate([unpacked(r["b"]) for r in told[1]]).astype(np.int64)
        # distinct (word before, token) of the positions whose word before can be a context
        self.fits = [(self.total >= least)[self.tokens] for least in model.words]
        one = np.flatnonzero((self.back >= 1) & _before(self.fits[0], 1))
        width = len(self.word)
        keys, place = np.unique(self.tokens[one - 1] * width + self.tokens[one], return_inverse=True)
        self.pair = np.full(len(self.tokens), -1, np.int64)
        self.pair[one] = place
        self.pair_word, self.pair_token = keys // width, keys % width
        self.pair_count = np.bincount(place[self.trains[one]], minlength=len(keys))
        # in the order in which buckets are asked, and answer
        part = part_of(self.word, self.word, model.parts)[self.pair_word]
        self.pair_order = np.lexsort((self.pair_word, part))
        self.pair_part, self.pair_first = part[self.pair_order], self.pair_word[self.pair_order]

    def ask_pairs(self) -> Iterator[tuple]:
        """Per bucket of the word before: those words, their numbers of pairs, and of the pairs the token, its total and the count."""
        for s, e in _spans(self.pair_part):
            words, sizes = np.unique(self.pair_first[s:e], return_counts=True)
            o = self.pair_order[s:e]
            token = self.pair_token[o]
            yield int(self.pair_part[s]), self.word[words], sizes, self.word[token], self.model.told(self.total[token]), self.pair_count[o]

    def hear_pairs(self) -> None:
        """The total of each pair, and whether its first word is a state."""
        answers = self.told[2]
        self.pair_total = np.empty(len(self.pair_order), np.int64)
        self.pair_total[self.pair_order] = np.concatenate([np.zeros(0, np.int64), *[unpacked(r["a"]).astype(np.int64) for r in answers]])
        state = np.zeros(len(self.word), bool)
        state[self.pair_first[np.flatnonzero(np.diff(self.pair_first, prepend=-1))]] = np.concatenate([np.zeros(0, np.uint32), *[unpacked(r["b"]) for r in answers]]) > 0
        self.pair_state = state[self.pair_word]
        # distinct (third last word or none, pair before, token) of the positions whose two words before can be a context
        often = np.zeros(len(self.tokens), np.int64)
        here = self.pair >= 0
        often[here] = self.pair_total[self.pair[here]]
        least, fits = self.model.least, self.fits
        two = (self.back >= 2) & _before(fits[1], 1) & _before(fits[1], 2) & (_before(often, 1) >= least)
        three = two & (self.back >= 3) & (_before(often, 2) >= least)
        for k in (1, 2, 3):
            three &= _before(fits[2], k)
        at = np.flatnonzero(two)
        pairs, width = len(self.pair_word), len(self.word)
        far = np.where(three[at], self.pair[at - 2], pairs + self.tokens[at - 2])
        keys, where, place = np.unique(far * max(1, pairs) + self.pair[at], return_index=True, return_inverse=True)
        where = at[where]
        self.run_last, self.run_second = self.tokens[where - 1], self.tokens[where - 2]
        self.run_third = np.where(three[where], self.word[self.tokens[np.maximum(where - 3, 0)]] + 1, 0)
        self.run_pair = self.pair[where]
        self.run_part = part_of(self.word[self.run_last], self.word[self.run_second], self.model.parts)
        self.run_order = np.lexsort((self.run_third, self.run_second * width + self.run_last, self.run_part))
        self.run_count = np.bincount(place[self.trains[at]], minlength=len(keys))
        self.run_at, self.run_place, self.run_often = at, place, _before(often, 1)

    def ask_runs(self) -> Iterator[tuple]:
        """Per bucket: last, second last and third last word (plus 1; 0 for none), token, its total, that of its pair and of the last word, count."""
        order = self.run_order
        part = self.run_part[order]
        for s, e in _spans(part):
            o = order[s:e]
            pair, last = self.run_pair[o], self.run_last[o]
            token = self.pair_token[pair]
            yield (int(part[s]), self.word[last], self.word[self.run_second[o]], self.run_third[o], self.word[token],
                   self.model.told(self.total[token]), self.pair_total[pair], self.model.told(self.total[last]), self.run_count[o])

    def probabilities(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each token: by the root, and by the longest state."""
        base = self.model.base(self.total[self.tokens])
        p = base.copy()
        at = np.flatnonzero(self.pair >= 0)
        at = at[self.pair_state[self.pair[at]]]
        pair = self.pair[at]
        p[at] = self.model.longer(self.pair_total[pair], self.total[self.pair_word[pair]], p[at])
        if self.told[3]:
            heard = np.empty((4, len(self.run_order)), np.int64)
            heard[:, self.run_order] = [np.concatenate([unpacked(r[c]) for r in self.told[3]]) for c in "abcd"]
            two, states, three, of = heard[:, self.run_place]
            for state, count, n in ((states & 1, two, self.run_often[self.run_at]), (states & 2, three, of)):
                yes = state > 0
                at = self.run_at[yes]
                p[at] = self.model.longer(count[yes], n[yes], p[at])
        return base, p


def _asked(chunk: int, questions: Iterator[tuple]) -> pa.Table:
    rows = [(chunk, bucket, *map(packed, parts), *[None] * (len(BLOBS) - len(parts))) for bucket, *parts in questions]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * len(BLOBS)]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["chunk", "bucket", *BLOBS])


def meet(texts: DataFrame, told: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Every chunk with all it has been told."""
    return texts.groupBy("chunk").cogroup(told.select(*ANSWERS).groupBy("chunk")).applyInArrow(run, schema)


def _parts(held: list[list[bytes]], i: int) -> np.ndarray:
    return np.concatenate([unpacked(h[i]) for h in held]).astype(np.int64)


def _shares(x: np.ndarray, sizes: list[int]) -> list[bytes]:
    return [packed(part) for part in np.split(x, np.cumsum(sizes)[:-1])]


def pair_totals(texts: DataFrame, told: DataFrame, shared: Broadcast[Model]) -> DataFrame:
    """Answers to each chunk for its pairs: ``a`` totals, ``b`` whether each first word is a state."""

    def ask(text: pa.Table, answers: pa.Table) -> pa.Table:
        return _asked(text["chunk"][0].as_py(), Chunk(shared.value, text, answers).ask_pairs())

    def answer(bucket, chunks, held):
        model = shared.value
        words, sizes = _parts(held, 0), _parts(held, 1)
        known, place = np.unique(words, return_inverse=True)
        context, token = np.repeat(place, sizes), _parts(held, 2)
        _, first, entry = np.unique(context << 32 | token, return_index=True, return_inverse=True)
        count = np.bincount(entry, weights=_parts(held, 4), minlength=len(first)).astype(np.int64)
        of = np.bincount(context[first], weights=count, minlength=len(known))
        below = model.base(model.known(token[first], _parts(held, 3)[first]))
        state = model.retained(context[first], of[context[first]], count, below, len(known))
        yield _answers(2, chunks, bucket, _shares(count[entry], [len(unpacked(h[2])) for h in held]), _shares(state[place], [len(unpacked(h[0])) for h in held]))

    return by_bucket(meet(texts, told, ask, QUESTION), BLOBS[:5], answer, ANSWER)


def run_totals(texts: DataFrame, told: DataFrame, shared: Broadcast[Model]) -> DataFrame:
    """Answers to each chunk for its longer runs: ``a`` total after two words, ``b`` 1 if these are a state, plus 2 if the three are,
    ``c`` total after three words, ``d`` their occurrences."""

    def ask(text: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(shared.value, text, answers)
        chunk.hear_pairs()
        return _asked(text["chunk"][0].as_py(), chunk.ask_runs())

    def answer(bucket, chunks, held):
        model = shared.value
        last, second, third, token, of_token, of_pair, of_last, count = (_parts(held, i) for i in range(len(BLOBS)))
        below = model.longer(of_pair, model.known(last, of_last), model.base(model.known(token, of_token)))
        _, two = np.unique(last.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64), return_inverse=True)
        _, three = np.unique(two << 32 | third, return_inverse=True)
        out = []
        for context, valid in ((two, None), (three, third > 0)):
            _, first, entry = np.unique(context << 32 | token, return_index=True, return_inverse=True)
            total = np.bincount(entry, weights=count, minlength=len(first)).astype(np.int64)
            of = np.bincount(context, weights=count).astype(np.int64)
            state = model.retained(context[first], of[context[first]], total, below[first], len(of))[context]
            out.append((total[entry], of[context], state if valid is None else state & valid))
            below = model.longer(total[entry], of[context], below)
        (a, _, s), (c, d, t) = out
        sizes = [len(unpacked(h[0])) for h in held]
        yield _answers(3, chunks, bucket, *(_shares(x, sizes) for x in (a, s + 2 * t, c, d)))

    return by_bucket(meet(texts, told, ask, QUESTION), BLOBS, answer, ANSWER)


def scored(texts: DataFrame, told: DataFrame, shared: Broadcast[Model]) -> DataFrame:
    """The scores of all documents of each chunk, from all it has been told."""

    def run(text: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(shared.value, text, answers)
        chunk.hear_pairs()
        base, p = chunk.probabilities()
        about = chunk.about
        add = lambda x: np.add.reduceat(x, chunk.first)
        return pa.table({
            "doc_id": pa.array(about["id"], mask=about["null"].astype(bool)),
            "held_out": about["held"] == 1,
            "n_tokens": about["n"],
            "n_known": add((chunk.total[chunk.tokens] > 0).astype(np.int64)),
            "base_score": add(np.log10(base)),
            "score": add(np.log10(p)),
        })

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    return meet(texts, told, run, schema)


def score(docs: DataFrame, held_out, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, learning where ``held_out`` is false."""
    buckets = shuffle_width(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out.cast("int").alias("held"), text_or_empty(text_col).alias("text"))
    chunks = by_chunk(chunked(rows, buckets), buckets)
    texts = chunks.filter("bucket < 0").select("chunk", "facts", "tokens")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            about = [np.frombuffer(x.as_py(), FACTS) for x in batch["facts"]]
            yield pa.RecordBatch.from_pydict({"n": pa.array([int(f["n"][f["held"] == 0].sum()) for f in about], pa.int64())})

    n = texts.select("facts").mapInArrow(lengths, "n bigint").agg(F.sum("n")).first()[0] or 0
    words = stage(word_totals(chunks.filter("bucket >= 0"), buckets, OFTEN * n), "lm-words")
    model = docs.sparkSession.sparkContext.broadcast(model_of(words, n, buckets))
    told = words.filter("chunk >= 0").select(*ANSWERS)
    told = told.unionByName(stage(pair_totals(texts, told, model), "lm-pairs"))
    told = told.unionByName(run_totals(texts, told, model))
    out = scored(texts, told, model)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")


@query("op9_suffix_tree_lm")
def op9(spark, sf_dir):
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    return score(table(spark, sf_dir, "documents"), held)
