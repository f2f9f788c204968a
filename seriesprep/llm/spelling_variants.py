"""Spelling variants: words one edit apart, found over a reduced alphabet.

1. Words are counted inside tasks (bounded tables, flushed when full) and summed by Spark.
2. Letters are hashed to a few symbols (code point modulo q).  Every word of the vocabulary is indexed by its reduced
   form, and generates the full one-edit neighbourhood of its reduced form: itself, deletions, replacements and
   insertions over the q symbols.  One edit of a word is at most one edit of its reduced form, so the
   join of neighbourhoods with the reduced vocabulary loses no pair.
3. Joined pairs are verified on the original strings.
4. A word's form is its near word of largest count; roots are found by doubling the form pointers.

q belongs to the length of the *indexed* word and follows the number of words of that length, so that the reduced
words of a length keep apart as the vocabulary grows; a word generates its deletions over the alphabet of length
L - 1, its replacements over that of L and its insertions over that of L + 1.  Reduced words are 64-bit
polynomial hashes, so that a neighbourhood costs 8 bytes an entry at any length; a hash collision
only adds a pair that the verification removes.

Edge cases: null and empty texts have no words; a null id is the empty string in the hash that picks changed runs;
equal rows count as often as they come; words of any length are whole; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm.byte_bpe import slices
from seriesprep.llm.common import query, stage, table, text_or_empty

RUN = "[A-Za-zÀ-ÿ]+"
CHANGE = 199  # a run changes where this divides its hash
LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
TABLE_WORDS = 200_000  # distinct words that a task counts before it hands them on
TABLE_LETTERS = 10_000_000
LEAST_SYMBOLS, SPARSENESS = 4, 32  # q**L is at least SPARSENESS times the words of length L
BATCH_HASHES = 1_000_000
BASE = 0x9E3779B97F4A7C15


# ------------------------------------------------------------------ counting
def changed(run: str, prefix: int) -> str:
    """The run, less one code point where the hash says so; ``prefix`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), prefix)
    if h % CHANGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col="doc_id", text_col="text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(word, n)`` of all words of at least ``least_length`` code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(RUN.replace("A-Z", "")).findall  # the text is in lower case by then
        total: Counter = Counter()
        letters = 0

        def flush():
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
            total.clear()

        for batch in batches:
            names, at = batch["id"].to_pylist(), 0
            for texts in slices(batch["text"]):
                for text in texts:
                    prefix = zlib.crc32(f"{names[at]}:".encode())
                    at += 1
                    for word, n in Counter(find(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():
                        if len(word) >= least_length:  # a change never lengthens a run
                            word = changed(word, prefix)
                            if len(word) >= least_length:
                                total[word] += n
                                letters += len(word) if total[word] == n else 0
                    if len(total) > TABLE_WORDS or letters > TABLE_LETTERS:
                        yield from flush()
                        letters = 0
        yield from flush()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------ reduced words
def symbols(word: str, q: int) -> np.ndarray:
    """Symbols 1..q of the letters."""
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) % np.uint64(q) + np.uint64(1)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def length_part(n: int) -> np.uint64:
    return np.uint64(n * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)


def reduced_hash(s: np.ndarray) -> int:
    """sum of s[i] * BASE**i and a part for the length, modulo 2**64."""
    return int(np.append(s * powers(len(s)), length_part(len(s))).sum(dtype=np.uint64))


def neighbourhood(word: str, q_of) -> np.ndarray:
    """Distinct hashes of all reduced words within one edit; ``q_of`` gives the alphabet size of a length."""
    n = len(word)
    p = powers(n + 2)
    out = []
    for m in (n - 1, n, n + 1):
        q = q_of(m)
        s = symbols(word, q)
        at = s * p[:n]
        head = np.concatenate((np.zeros(1, np.uint64), np.cumsum(at, dtype=np.uint64)))  # head[i]: letters before i
        tail = head[-1] - head  # letters from i on
        every = np.arange(1, q + 1, dtype=np.uint64)
        if m < n:  # letters after the deleted one move down; tail / BASE is a sum over the lower powers
            low = np.concatenate((np.zeros(1, np.uint64), np.cumsum(s[1:] * p[: n - 1], dtype=np.uint64)))
            out.append(head[:-1] - low + low[-1] + length_part(m))
        elif m == n:  # includes the reduced word itself
            out.append(((every[:, None] - s) * p[:n] + head[-1] + length_part(m)).ravel())
        else:
            out.append((head + tail * np.uint64(BASE) + every[:, None] * p[: n + 1] + length_part(m)).ravel())
    return np.unique(np.concatenate(out))


def alphabet(words_of_length: dict[int, int]):
    """q by length; lengths without words, or too long to matter, take the least."""
    q = {}
    for length, n in words_of_length.items():
        q[length] = LEAST_SYMBOLS
        while length and q[length] ** length < SPARSENESS * n:
            q[length] += 1
    return lambda length: q.get(length, LEAST_SYMBOLS)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``(id, n2, word2)``: for every word of ``(id, word, n)`` the words one edit away."""
    # One row for each length below 64; longer words always take the least alphabet.
    sizes = vocabulary.groupBy(F.char_length("word").alias("l")).agg(F.count(F.lit(1)).alias("k")).filter("l < 64").collect()
    q_of = alphabet({r["l"]: r["k"] for r in sizes})

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        hashes: list[np.ndarray] = []
        held = 0

        def flush():
            repeated = np.repeat(np.array(ids, np.int64), [len(h) for h in hashes])
            return pa.RecordBatch.from_pydict({"h": np.concatenate(hashes).view(np.int64), "id": repeated})

        for batch in batches:
            for i, word in zip(batch["id"].to_pylist(), batch["word"].to_pylist()):
                ids.append(i)
                hashes.append(neighbourhood(word, q_of))
                held += len(hashes[-1])
                if held > BATCH_HASHES:
                    yield flush()
                    ids, hashes, held = [], [], 0
        if ids:
            yield flush()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.fromiter((reduced_hash(symbols(w, q_of(len(w)))) for w in batch["word"].to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_pydict({"h": h.view(np.int64), "id2": batch["id"], "word2": batch["word"], "n2": batch["n"]})

    around = vocabulary.select("id", "word").mapInArrow(generate, "h bigint, id bigint")
    # Few words beside their neighbourhoods, which the optimizer takes for no larger than the vocabulary: never broadcast.
    indexed = stage(vocabulary.select("id", "word", "n").mapInArrow(index, "h bigint, id2 bigint, word2 string, n2 bigint"), "spelling-index")
    met = around.hint("merge").join(indexed, "h").filter("id <> id2").select("id", "word2", "n2")
    return met.join(vocabulary.select("id", "word"), "id").filter(F.levenshtein("word", "word2", 1) == 1).select("id", "n2", "word2")


# --------------------------------------------------------------------- forms
def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for words with a form, from ``(word, form)``; forms grow in count, so there is no cycle."""
    now = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = stage(now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, id_col="doc_id", text_col="text", least_length=LEAST_LENGTH, least_count=LEAST_COUNT, factor=FACTOR) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)``: one row per word."""
    counted = word_counts(docs, id_col, text_col, least_length).filter(F.col("n") >= least_count)
    vocabulary = stage(stage(counted, "spelling-counts").withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    near = near_words(vocabulary).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n2")).alias("n2"), "word2")).alias("best"))
    words = vocabulary.join(near, "id", "left")
    strong = -F.col("best.n2") >= factor * F.col("n")
    words = words.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.word2")).alias("form"), F.when(strong, -F.col("best.n2")).alias("form_n"))
    words = stage(words, "spelling-forms")
    found = roots(words.filter("form IS NOT NULL"))
    return words.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))


# Table of the CRC-32 polynomial, from its rule; words are near if one is the other less one letter, or both are equal but for one.
SQL = r"""
WITH RECURSIVE bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
per AS (SELECT d, w, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY d, w),
bytes AS (SELECT w, n, list_transform(range(1, strlen(d || ':' || w) + 1), lambda k: ('0x' || substr(hex(encode(d || ':' || w)), (2 * k - 1)::BIGINT, 2))::BIGINT) AS b FROM per),
hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
results AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w) + 2)::BIGINT) ELSE w END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, k, substr(word, 1, k - 1) AS a, substr(word, k + 1) AS z FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM words)),
less AS (SELECT DISTINCT c.word AS u, c.a || c.z AS v FROM cuts c JOIN words w ON w.word = c.a || c.z),
near AS MATERIALIZED (SELECT u AS word, v AS other FROM less UNION SELECT v, u FROM less
  UNION SELECT x.word, y.word FROM cuts x JOIN cuts y ON x.k = y.k AND x.a = y.a AND x.z = y.z AND x.word <> y.word),
best AS (SELECT r.word, count(*) AS n_near, arg_min(r.other, (-o.n, r.other)) AS other, max(o.n) AS other_n FROM near r JOIN words o ON o.word = r.other GROUP BY r.word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form,
  CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (SELECT word, word AS at, form AS onward FROM forms UNION ALL SELECT k.word, k.onward, f.form FROM walk k JOIN forms f ON f.word = k.onward)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, k.at AS root FROM forms f JOIN walk k ON k.word = f.word WHERE k.onward IS NULL
"""


@query("op13_spelling_variants", SQL)
def op13(spark, sf_dir):
    return variants(table(spark, sf_dir, "documents"))
