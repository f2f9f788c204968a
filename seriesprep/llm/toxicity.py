"""Toxicity by the nearest labelled examples under TF-IDF cosine.

``fit`` learns from labelled rows only: features (words and word beginnings) that lean towards the
positive label by a chi-square test, their document frequencies over the whole corpus, a block-max
inverted index of the labelled examples, and a calibration.  ``score`` finds each text's ``K`` nearest
examples exactly: blocks of examples are visited in order of their upper bound (sum of query weight times
the block's largest weight per term) until no block can hold a nearer one; ties go to the smaller
example id.  Votes are weighted by distance and by how many labelled rows an example stands for, and a
logistic curve fitted on the examples (each left out of its own vote) turns them into a probability.

Bound: at most ``MAX_EXAMPLES`` labelled rows of each label, those of smallest id hash, are used
(the documented sample of the fit); so features, index and calibration are a few MB at any corpus size.
Document frequencies count every document.

Edge cases: null text counts as empty; a text without a feature gets the share of positives among
such examples; null labels are no labels, several labels of one document count as positive if one is; a null id is held out, as it can have no label; without
labelled rows every score is 0; the input's own columns pass through ``score``, and an input
column called like an output column raises ``ValueError``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm.byte_bpe import slices
from seriesprep.llm.common import give_back, crc_remainder, query, stage, table, text_or_empty

MAX_EXAMPLES = 4000  # of each label
LEAST_DOCUMENTS = 3  # positives that must hold a feature
LEAST_SHARE = 0.015  # and this share of all positives, so that one family of copies makes no feature; every one that passes is kept
LEAST_CHI = 25.0
LEAST_LEAN = 20.0  # times more frequent among positives
BEGINNINGS = (4, 5, 6)  # letters of word beginnings
K = 15
BLOCK = 64
CACHE_ENTRIES = 150_000

words = re.compile(r"\w+").findall


def names(word: str) -> list[str]:
    """The features of a word: itself and its beginnings, marked with a final ``*``."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) >= n]]


class Extractor(dict):
    """Word to the tuple of its selected features, filled as words turn up."""

    def __init__(self, features: dict[str, int]):
        self.features = features

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(sorted(self.features[n] for n in names(word) if n in self.features))
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = found
        return found

    def vector(self, text: str) -> tuple[list[int], list[int]]:
        counts = Counter(f for fs in map(self.__getitem__, words(text.lower())) if fs for f in fs)
        order = sorted(counts)
        return order, [counts[f] for f in order]


class BlockMaxIndex:
    """Postings of unit vectors by term and block of ``BLOCK`` examples, with each block's maximum per term."""

    def __init__(self, vectors: list[dict[int, float]], ids: list[int], terms: int):
        # Examples with the same strongest terms share blocks, which keeps the bounds tight.
        order = sorted(range(len(ids)), key=lambda i: (sorted(vectors[i], key=lambda t: -vectors[i][t])[:3], ids[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.order = order
        blocks = -(-len(order) // BLOCK)
        self.top = np.zeros((terms, blocks))
        lists: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for place, i in enumerate(order):
            block, slot = divmod(place, BLOCK)
            for t, w in vectors[i].items():
                lists.setdefault((block, t), []).append((slot, w))
                self.top[t, block] = max(self.top[t, block], w)
        self.postings = {k: (np.array([s for s, _ in v], np.int64), np.array([w for _, w in v])) for k, v in lists.items()}

    def nearest(self, vector: dict[int, float], k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """``(similarities, places)`` of the k best examples with a common term, without place ``skip``."""
        terms = sorted(vector)
        weights = np.array([vector[t] for t in terms])
        bounds = weights @ self.top[terms]
        best = np.zeros(0)
        at = np.zeros(0, np.int64)
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or len(best) == k and bounds[block] < best[-1] - 1e-12:
                break
            sums = np.zeros(BLOCK)
            for t, w in zip(terms, weights):
                if (found := self.postings.get((int(block), t))) is not None:
                    sums[found[0]] += w * found[1]
            hit = np.flatnonzero(sums > 0)
            places = hit + block * BLOCK
            own = places != skip
            best, at = np.concatenate((best, sums[hit][own])), np.concatenate((at, places[own]))
            keep = np.lexsort((self.ids[at], -np.round(best, 12)))[:k]
            best, at = best[keep], at[keep]
        return best, at


@dataclass
class Model:
    features: dict[str, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    index: BlockMaxIndex | None = None
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: float = 1.0
    offset: float = 0.0
    prior: float = 0.0  # of a text without features

    def unit(self, terms, counts) -> dict[int, float]:
        raw = {t: (1 + math.log(c)) * self.idf[t] for t, c in zip(terms, counts)}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in raw.items()}

    def vote(self, vector: dict[int, float], skip: int = -1) -> tuple[float, list[int]]:
        """Between -1 and 1, with the ids of the neighbours, nearest first."""
        near, at = self.index.nearest(vector, K, skip)
        if not len(at):
            return 2 * self.prior - 1, []
        pull = self.weights[at] / (1.05 - np.minimum(near, 1.0))
        return float((pull * (2 * self.labels[at] - 1)).sum() / pull.sum()), self.index.ids[at].tolist()

    def score(self, terms, counts) -> tuple[float, list[int]]:
        if not len(terms) or self.index is None:
            return self.prior, []
        vote, evidence = self.vote(self.unit(terms, counts))
        return 1 / (1 + math.exp(-(self.slope * vote + self.offset))), evidence

    def calibrate(self, votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Logistic curve by Newton steps, with smoothed targets for few or one-sided examples."""
        ones, zeros = weights[labels == 1].sum(), weights[labels == 0].sum()
        goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        x = np.stack((votes, np.ones_like(votes)))
        at = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
            slope = (x * (weights * (goal - p))).sum(axis=1) - 1e-3 * at
            bend = (x * (weights * p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
            step = np.linalg.solve(bend, slope)
            at = at + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = float(at[0]), float(at[1])


def _examples(labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The sample ``(doc_id, y)`` and how many labelled rows there are of each label."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y"))
    known = known.filter(crc_remainder() != 0)
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.filter(F.col("y") == y).orderBy(*order).limit(MAX_EXAMPLES) for y in (0, 1)]
    return stage(parts[0].unionByName(parts[1]), "toxic-examples"), totals


def _select(texts: DataFrame) -> dict[str, int]:
    """The features that lean most towards the positive label in the examples."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [Counter(), Counter()]

        def flush():
            keys = list(both[0].keys() | both[1].keys())
            for at in range(0, len(keys), 50_000):
                part = keys[at : at + 50_000]
                yield pa.RecordBatch.from_pydict({"feature": part, "no": [both[0][f] for f in part], "yes": [both[1][f] for f in part]})
            for counter in both:
                counter.clear()

        for batch in batches:
            labels, at = batch["y"].to_pylist(), 0
            for texts in slices(batch["text"]):
                for text in texts:
                    both[labels[at]].update({n for w in set(words(text.lower())) for n in names(w)})
                    at += 1
                if len(both[0]) + len(both[1]) > CACHE_ENTRIES:
                    yield from flush()
        yield from flush()
        give_back()

    n = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}
    both = texts.mapInArrow(counts, "feature string, no bigint, yes bigint").groupBy("feature").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    a, b = F.col("yes").cast("double"), F.col("no").cast("double")
    c, d = n[1] - a, n[0] - b
    chi = (n[0] + n[1]) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * float(n[0]) * n[1])
    leaning = both.filter(F.col("yes") >= max(LEAST_DOCUMENTS, LEAST_SHARE * n[1])).filter(a / n[1] > LEAST_LEAN * b / n[0]).withColumn("chi", chi)
    best = leaning.filter(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "feature")
    return {r["feature"]: i for i, r in enumerate(best.select("feature").collect())}


def vectors(docs: DataFrame, features: dict[str, int], text_col="text", out="_vector") -> DataFrame:
    """Add the struct ``out`` of ``terms`` and ``counts``."""

    @F.arrow_udf("terms array<int>, counts array<int>")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        get = Extractor(features)
        kind = pa.list_(pa.int32())
        for batch in batches:
            terms, counts = [], []
            for texts in slices(batch):
                for text in texts:
                    t, c = get.vector(text)
                    terms.append(t)
                    counts.append(c)
            yield pa.StructArray.from_arrays([pa.array(terms, kind), pa.array(counts, kind)], ["terms", "counts"])
        del get
        give_back()

    return docs.withColumn(out, extract(text_or_empty(text_col)))


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text") -> tuple[Model, DataFrame]:
    """The model, and the staged feature vectors ``(doc_id, _vector)`` of all documents."""
    sample, totals = _examples(labels)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    features = _select(texts.join(F.broadcast(sample), "doc_id").select("y", "text"))  # at most 2 * MAX_EXAMPLES ids
    staged = stage(vectors(texts, features).drop("text"), "toxic-vectors")
    seen = staged.select(F.explode("_vector.terms").alias("t")).groupBy("t").count().collect()  # a row per feature
    df = np.zeros(len(features))
    for r in seen:
        df[r["t"]] = r["count"]
    model = Model(features, np.log((1 + staged.count()) / (1 + df)) + 1)
    rows = staged.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("_vector").alias("v")).orderBy("doc_id").collect()
    if not rows:
        return model, staged
    used = Counter(r["y"] for r in rows)
    weight = {y: totals[y] / used[y] for y in used}
    zero = [r for r in rows if not r["v"]["terms"]]
    ones = sum(weight[1] for r in zero if r["y"])
    model.prior = (ones + 0.5) / (sum(weight[r["y"]] for r in zero) + 1) if zero else 0.0
    known = [r for r in rows if r["v"]["terms"]]
    if known:
        units = [model.unit(r["v"]["terms"], r["v"]["counts"]) for r in known]
        model.index = BlockMaxIndex(units, [r["doc_id"] for r in known], len(features))
        order = model.index.order
        model.labels = np.array([float(known[i]["y"]) for i in order])
        model.weights = np.array([weight[known[i]["y"]] for i in order])
        votes = np.array([model.vote(units[i], place)[0] for place, i in enumerate(order)])
        model.calibrate(votes, model.labels, model.weights)
    return model, staged


def score_vectors(rows: DataFrame, model: Model, vector="_vector") -> DataFrame:
    """Replace the vector by ``score`` and ``evidence``, the ids of the nearest examples."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # a few MB by MAX_EXAMPLES and LEAST_SHARE

    @F.arrow_udf("score double, evidence array<bigint>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[tuple, tuple] = {}
        for batch in batches:
            scores, evidence = [], []
            for terms, counts in zip(batch.field("terms").to_pylist(), batch.field("counts").to_pylist()):
                key = (tuple(terms), tuple(counts))
                if key not in known:
                    if len(known) >= CACHE_ENTRIES // 8:
                        known.clear()
                    known[key] = shared.value.score(terms, counts)
                scores.append(known[key][0])
                evidence.append(known[key][1])
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], ["score", "evidence"])

    return rows.withColumn("_judged", judge(vector)).select("*", "_judged.*").drop("_judged", vector)


def score(docs: DataFrame, model: Model, text_col="text") -> DataFrame:
    """``docs`` with ``score`` and ``evidence`` added: one scan, no shuffle."""
    clash = {"score", "evidence", "_judged"} & set(docs.columns)
    if clash:
        raise ValueError(f"the table already has {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB by MAX_EXAMPLES and LEAST_SHARE

    @F.arrow_udf("score double, evidence array<bigint>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        get = Extractor(shared.value.features)
        for batch in batches:
            scores, evidence = [], []
            for texts in slices(batch):
                for text in texts:
                    s, e = shared.value.score(*get.vector(text))
                    scores.append(s)
                    evidence.append(e)
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], ["score", "evidence"])
        del get
        give_back()

    return docs.withColumn("_judged", judge(text_or_empty(text_col))).select("*", "_judged.*").drop("_judged")


@query("op2_toxicity")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model, staged = fit(docs, table(spark, sf_dir, "labels"))
    return score_vectors(staged, model).select(
        "doc_id",
        (F.coalesce(crc_remainder(), F.lit(0)) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "evidence",
    )
