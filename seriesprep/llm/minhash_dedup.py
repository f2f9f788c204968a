"""MinHash near-duplicates by tensored banding: groups linked by 3-word shingle Jaccard similarity of 0.85 or more.

1. Every set gets two collections of ``SIDE`` small hashes, each made of ``DEPTH`` minhashes.  A table
   key is a pair (one hash of the left collection, one of the right): SIDE * SIDE tables of 2 * DEPTH
   minhashes each for 2 * SIDE * DEPTH minhashes, about the square root of what tables of their own would take.
2. Equal sets become one class, so copies go no further.  A pair can only share a table key if it shares both halves: hashes
   that only one class has are left out before pairs are formed, which leaves most classes without any key.
3. Classes that share a table key are candidates.  Each key ties its classes to the least of them, the components
   of these ties are clusters, and no pair is written out.
4. Inside a cluster every pair of classes with a common key is verified on the full sets, unless both are in
   one group already.  A cluster too large for one task is dealt to tiles: each tile by itself, then one
   member of each group found with its like, and then pairs of tiles that share a key and hold members of different groups.
5. Components of the verified links give each class, and so each document, its smallest reachable id.

A linked pair misses all tables with probability of at most 1 - (1 - (1 - 0.85**DEPTH)**SIDE)**2, 1.6e-6 for the
defaults; no link is ever wrong but for collisions of 64-bit shingle hashes.

Edge cases: null text counts as empty; texts without words have an empty set and no links; fewer than three words are
one shingle; rows with equal ids are rows of their own; a null id has no component of its own id (null), is not
kept, but links like any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm.byte_bpe import slices
from seriesprep.llm.common import query, small, stage, table, text_or_empty
from seriesprep.llm.graph import components
from seriesprep.llm.shingles import WordHashes, mixed, shingle_set, signature

SIZE = 3
NUM, DEN = 85, 100
SIDE, DEPTH = 24, 5
TILE_CLASSES, TILE_SHINGLES = 512, 1_000_000
SLICE_TOKENS = 20_000  # shingles whose minhashes are computed together


# ----------------------------------------------------------------- minhashes
def multipliers() -> np.ndarray:
    """Odd factors, one per minhash, by a fixed rule."""
    return mixed(np.arange(1, 2 * SIDE * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def halves(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, 2 * SIDE) hashes: the left collection, then the right one; no set may be empty."""
    tokens = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), 2 * SIDE), np.uint64)
    factors = multipliers().reshape(2 * SIDE, DEPTH)
    for slot in range(2 * SIDE):
        h = np.full(len(sets), slot + 1, np.uint64)
        for a in factors[slot]:
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(tokens * a, starts))
        out[:, slot] = h
    return out


def table_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Keys of all pairs of a left and a right hash; the hashes hold their slot."""
    return mixed(left[:, None] * np.uint64(3) + mixed(right)[None, :]).ravel()


def described(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, s1, s2, halves)`` of every text; no halves for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def rows(names: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            full = [s for s in sets if len(s)]
            found = iter(halves(full)) if full else iter(())
            signs = [signature(s) for s in sets]
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array(names, pa.int64()),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "s1": pa.array([a for a, _ in signs], pa.int64()),
                "s2": pa.array([b for _, b in signs], pa.int64()),
                "halves": pa.array([next(found).astype("<u8").tobytes() if len(s) else None for s in sets], pa.binary()),
            })

        for batch in batches:
            names, at = batch["doc_id"].to_pylist(), 0
            for texts in slices(batch["text"]):
                held: list[np.ndarray] = []
                size = 0
                for text in texts:
                    held.append(shingle_set(text, hashes, SIZE))
                    size += len(held[-1])
                    if size > SLICE_TOKENS:
                        yield rows(names[at : at + len(held)], held)
                        at, held, size = at + len(held), [], 0
                if held:
                    yield rows(names[at : at + len(held)], held)
                    at += len(held)

    return docs.mapInArrow(run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, halves binary")


# ---------------------------------------------------------------- candidates
def _half_rows(classes: DataFrame) -> DataFrame:
    """``(key, slot, half)``: one row per class and small hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = np.frombuffer(b"".join(batch["halves"].to_pylist()), "<i8")
            yield pa.RecordBatch.from_pydict({
                "key": np.repeat(batch["key"].to_numpy(), 2 * SIDE),
                "slot": pa.array(np.tile(np.arange(2 * SIDE, dtype=np.int32), batch.num_rows)),
                "half": grid,
            })

    return classes.select("key", "halves").mapInArrow(run, "key bigint, slot int, half bigint")


def _repeated(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Rows whose value of ``column`` comes more than once; counted with partial sums, so that no value is hot."""
    often = stage(rows.groupBy(column).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(column), name)
    return rows.join(small(often), column, "left_semi")


def _table_rows(classes: DataFrame) -> DataFrame:
    """``(key, bucket)``: the table keys that several classes share."""
    shared = _repeated(_half_rows(classes), "half", "minhash-halves")
    sides = shared.groupBy("key").agg(
        F.collect_list(F.when(F.col("slot") < SIDE, F.col("half"))).alias("l"), F.collect_list(F.when(F.col("slot") >= SIDE, F.col("half"))).alias("r")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: list, found: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": np.repeat(np.array(keys, np.int64), [len(f) for f in found]), "bucket": np.concatenate(found).view(np.int64)})

        for batch in batches:
            keys: list = []
            found: list[np.ndarray] = []
            for key, left, right in zip(*(batch[c].to_pylist() for c in ("key", "l", "r"))):
                keys.append(key)
                found.append(table_keys(np.array(left, np.int64).view(np.uint64), np.array(right, np.int64).view(np.uint64)))
                if len(keys) == 1000:
                    yield out(keys, found)
                    keys, found = [], []
            if keys:
                yield out(keys, found)

    pairs = sides.filter("size(l) > 0 AND size(r) > 0").mapInArrow(run, "key bigint, bucket bigint")
    return stage(_repeated(stage(pairs, "minhash-pairs"), "bucket", "minhash-buckets"), "minhash-tables")


def _clusters(tables: DataFrame) -> DataFrame:
    """``(key, cluster)`` of every class that shares a table key."""
    least = stage(tables.groupBy("bucket").agg(F.min("key").alias("least")), "minhash-least")
    ties = tables.join(small(least), "bucket").filter("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()
    return stage(components(ties).select(F.col("node").alias("key"), F.col("root").alias("cluster")), "minhash-clusters")


# -------------------------------------------------------------- verification
def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a Jaccard similarity of NUM / DEN or more."""
    if DEN * min(len(a), len(b)) < NUM * max(len(a), len(b)):
        return False
    both = np.sort(np.concatenate((a, b)), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return DEN * shared >= NUM * (len(a) + len(b) - shared)


def verified(sets: list[np.ndarray], grid: np.ndarray, side: list[int] | None = None, labels: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between sets that share a table key, enough to connect all groups.

    ``grid`` has a row of halves per set.  With ``side`` only pairs of different sides count; sets of equal
    ``labels`` are in one group from the start.
    """
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    if labels is not None:
        first: dict[int, int] = {}
        for i, x in enumerate(labels):
            parent[i] = first.setdefault(x, i)
    out = []
    lengths = np.array([len(s) for s in sets])
    for x in range(1, len(sets)):
        same = grid[:x] == grid[x]
        met = same[:, :SIDE].any(1) & same[:, SIDE:].any(1)
        met &= (DEN * lengths[:x] >= NUM * lengths[x]) & (DEN * lengths[x] >= NUM * lengths[:x])
        # the likeliest partner first: once linked, all others of its group are done
        for y in sorted(np.flatnonzero(met).tolist(), key=lambda y: -int(same[y].sum())):
            if (side is None or side[x] != side[y]) and find(x) != find(y) and linked(sets[x], sets[y]):
                out.append((x, y))
                parent[find(x)] = find(y)
    return out


def _edges(group: pa.Table, found: list[tuple[int, int]]) -> pa.Table:
    keys = group["key"].to_pylist()
    return pa.table({"a": pa.array([keys[x] for x, _ in found], pa.int64()), "b": pa.array([keys[y] for _, y in found], pa.int64())})


def _members(group: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    sets = [np.frombuffer(x.as_py(), "<u8") for x in group["tokens"]]
    return sets, np.frombuffer(b"".join(group["halves"].to_pylist()), "<u8").reshape(-1, 2 * SIDE)


def _inside(rows: DataFrame) -> DataFrame:
    """Links inside each tile."""

    def run(group: pa.Table) -> pa.Table:
        return _edges(group, verified(*_members(group)))

    return rows.select("cluster", "tile", "key", "tokens", "halves").groupBy("cluster", "tile").applyInArrow(run, "a bigint, b bigint")


def _tiled(rows: DataFrame) -> DataFrame:
    """Add ``tile`` and ``tiles``: rows of one cluster are dealt to as many tiles as their size asks for."""
    sizes = rows.groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / TILE_CLASSES), F.ceil(F.sum("n") / TILE_SHINGLES)).alias("tiles"))
    many = stage(sizes.filter("tiles > 1"), "minhash-tiles")
    placed = rows.join(small(many), "cluster", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    return placed.withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))


def _rooted(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Add ``root``, the group of each row's key under the links found so far."""
    known = stage(components(found), "minhash-roots").withColumnRenamed("node", "key")
    return rows.join(small(known), "key", "left").withColumn("root", F.coalesce("root", "key"))


def _across(rows: DataFrame, found: DataFrame, tables: DataFrame) -> DataFrame:
    """Links between the tiles of large clusters, given the links inside tiles."""
    leaders = _rooted(rows, found).filter("key = root").drop("tile", "tiles", "root")
    found = stage(_inside(_tiled(leaders)).unionByName(found), "minhash-leaders")
    rooted = stage(_rooted(rows, found), "minhash-rooted")
    places = stage(rooted.select("key", "cluster", "tile", "root"), "minhash-places")
    keys = tables.groupBy("key").agg(F.collect_list("bucket").alias("buckets"))  # at most SIDE * SIDE of a class
    held = keys.join(small(places), "key").select("cluster", "tile", "root", F.explode("buckets").alias("bucket"))
    held = held.groupBy("cluster", "bucket", "tile").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
    # Tables that still tie different groups together, and the pairs of tiles that meet there.
    mixed_tables = held.groupBy("cluster", "bucket").agg(F.min("r1").alias("m1"), F.max("r2").alias("m2")).filter("m1 <> m2").select("bucket")
    held = stage(held.join(small(stage(mixed_tables, "minhash-open")), "bucket", "left_semi"), "minhash-held")
    x, y = (held.select("bucket", "cluster", *[F.col(c).alias(f"{c}_{s}") for c in ("tile", "r1", "r2")]) for s in "xy")
    open_ = x.join(y, ["bucket", "cluster"]).filter("tile_x < tile_y AND NOT (r1_x = r2_x AND r1_y = r2_y AND r1_x = r1_y)")
    open_ = stage(open_.select("cluster", "tile_x", "tile_y").distinct(), "minhash-tile-pairs")
    sides = [rooted.withColumnRenamed("tile", f"tile_{s}").join(small(open_), ["cluster", f"tile_{s}"]).withColumn("side", F.lit(k)) for k, s in enumerate("xy")]

    def run(group: pa.Table) -> pa.Table:
        return _edges(group, verified(*_members(group), group["side"].to_pylist(), group["root"].to_pylist()))

    columns = ["cluster", "tile_x", "tile_y", "side", "key", "root", "tokens", "halves"]
    crossing = sides[0].select(columns).unionByName(sides[1].select(columns)).groupBy("cluster", "tile_x", "tile_y").applyInArrow(run, "a bigint, b bigint")
    return found.unionByName(crossing)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add ``tokens`` to the wanted classes: the texts that stand for them are hashed again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            signs, at = list(zip(batch["s1"].to_pylist(), batch["s2"].to_pylist())), 0
            for texts in slices(batch["text"]):
                sets = [shingle_set(t, hashes, SIZE) for t in texts]
                right = [i for i, s in enumerate(sets) if signature(s) == signs[at + i]]  # equal ids may hold other texts
                if right:
                    part = batch.slice(at, len(sets)).drop_columns(["text", "s1", "s2"]).take(pa.array(right))
                    part = part.append_column("halves", pa.array([h.astype("<u8").tobytes() for h in halves([sets[i] for i in right])], pa.binary()))
                    yield part.append_column("tokens", pa.array([sets[i].tobytes() for i in right], pa.binary()))
                at += len(sets)

    joined = docs.join(small(wanted.withColumnRenamed("doc_id", "_id")), F.col("doc_id").eqNullSafe(F.col("_id")))
    found = joined.select("key", "cluster", "n", "text", "s1", "s2").mapInArrow(run, "key bigint, cluster bigint, n bigint, halves binary, tokens binary")
    return found.dropDuplicates(["key"])  # rows may repeat id and text


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, class_id)``: one row per row of ``docs``.

    ``class_id`` tells equal sets apart (128 bits as text, null for empty sets).
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    nodes = stage(described(texts), "minhash-documents")
    facts = [F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.first("halves").alias("halves")]
    firsts = nodes.filter("n > 0").groupBy("s1", "s2").agg(*facts)
    classes = stage(firsts.withColumn("key", F.monotonically_increasing_id()), "minhash-classes")
    tables = _table_rows(classes)
    wanted = stage(classes.join(small(_clusters(tables)), "key").drop("copies", "halves"), "minhash-wanted")
    rows = stage(_tiled(_sets(texts, wanted)), "minhash-sets")
    found = stage(_inside(rows), "minhash-links")
    large = rows.filter("tiles > 1")
    if not large.isEmpty():
        found = stage(_across(large, found, tables).unionByName(found), "minhash-links")
    grouped = _rooted(classes.select("key", "s1", "s2", "copies", F.col("doc_id").alias("least")), found)
    reach = grouped.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("rows"))
    reach = stage(reach.filter("rows > 1").select("root", "component_id"), "minhash-reach")
    named = stage(grouped.join(small(reach), "root").select("s1", "s2", "component_id"), "minhash-components")
    # All rows without a copy or link are a component of their own.
    rows = nodes.drop("halves").join(small(named), ["s1", "s2"], "left")
    group = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    kind = F.when(F.col("n") > 0, F.concat(F.hex("s1"), F.hex("s2")))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), group.alias("component_id"), F.coalesce(F.col("doc_id") == group, F.lit(False)).alias("kept"), kind.alias("class_id"))


@query("op11_minhash_dedup")
def op11(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
