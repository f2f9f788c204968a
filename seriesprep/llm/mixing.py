"""Mix sources to target weights by hash thresholds, without sorting documents.

Sizes are word counts.  Per source, tokens are summed by the leading bits of a hash of the
document's id and text; running sums over these at most 4096 buckets find the bucket in which the budget
ends; only that boundary bucket is summed again by its next bits.  After ``levels`` rounds one
threshold per source remains, and a document is taken if its hash lies below it.  Thresholds
are nested: a larger budget takes a superset.

A source with a target above its size is taken whole as often as it fits, and the rest by the
threshold, so no document is taken more than ``max_repeat`` times.

Edge cases: null text has size 0; a null source is a source of its own, last in order; rows with
the same id and text share one hash and are taken together, so they can move a source from its target by half their words;
rows without an id are told apart by their texts; an empty table gives an empty result; other
columns, whatever their names, pass through ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesprep.llm.common import WORD, query, small, stage, table

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BITS = 12  # per level
LEVELS = 4


def document_hash(doc_id="doc_id", text="text"):
    """48 bits of the MD5 of the id written as text, a colon and the text's own MD5, the same in any engine."""
    written, content = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (doc_id, text))
    both = F.concat(written, F.lit(":"), F.md5(content.cast("binary")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, 12), 16, 10).cast("bigint")


def sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """``(doc_id, source, size, hash)``, the only columns the mix needs."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        document_hash(id_col, text_col).alias("hash"),
    )


def targets(sized: DataFrame, weights=WEIGHTS, max_repeat=MAX_REPEAT) -> DataFrame:
    """``(source, source_size, target)``: weights dealt in source order, capped, excess reshared.

    One row per source; the windows without a key run over sources only, never over documents.
    Capping in order of cap per weight makes the repeated resharing one pass of running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    deal = F.array(*[F.lit(float(w)) for w in weights])
    per = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("w", F.element_at(deal, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
        .withColumn("rate", F.col("cap") / F.col("w"))
    )
    everyone = Window.partitionBy()
    filling = Window.orderBy("rate", F.col("source").asc_nulls_last())
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("place", F.row_number().over(filling))
        .withColumn("left", F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("w_left"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("rate"), F.struct("place", "level"))).over(everyone)["level"])
    )
    return per.select("source", "source_size", F.least(F.col("cap"), F.col("level") * F.col("w")).alias("target"))


def thresholds(sized: DataFrame, goals: DataFrame, max_repeat=MAX_REPEAT, bits=BITS, levels=LEVELS) -> DataFrame:
    """``(source, source_size, target, whole, below)``: copies of every document, then of hashes under ``below``."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(ratio), F.lit(max_repeat)).cast("bigint")
    state = goals.withColumn("whole", whole).select(
        "source",
        "source_size",
        "target",
        "whole",
        F.lit(0).cast("bigint").alias("prefix"),  # hashes with a smaller prefix are taken
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"),
    )
    total = bits * levels
    for level in range(1, levels + 1):
        prefix = F.shiftright("hash", total - bits * level)
        named = state.select(F.col("source").alias("s"), F.col("prefix").alias("p"), "budget")
        inside = sized.join(small(named), F.col("source").eqNullSafe(F.col("s")))
        if level > 1:
            inside = inside.filter(F.shiftright("hash", total - bits * (level - 1)) == F.col("p"))
        hist = inside.groupBy("source", prefix.alias("bucket")).agg(F.sum("size").alias("size"), F.max("budget").alias("budget"))
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        # The last level takes the boundary bucket too when that comes nearer to the budget.
        ends = F.col("before") + F.col("size") * (1.0 if level < levels else 0.5) > F.col("budget")
        first = F.min(F.when(ends, F.struct("bucket", "before")))
        cut = hist.groupBy("source").agg(first.alias("cut"), F.max("bucket").alias("last"), F.sum("size").alias("all"))
        state = (
            state.join(cut.select(F.col("source").alias("s"), "cut", "last", "all"), F.col("source").eqNullSafe(F.col("s")), "left")
            .select(
                "source",
                "source_size",
                "target",
                "whole",
                F.coalesce(F.col("cut")["bucket"], F.col("last") + 1, F.col("prefix") * (1 << bits)).alias("prefix"),
                (F.col("budget") - F.coalesce(F.col("cut")["before"], F.col("all"), F.lit(0))).alias("budget"),
            )
        )
        state = stage(state, "mix-level")
    return state.select("source", "source_size", "target", "whole", F.col("prefix").alias("below"))


def plan(docs: DataFrame, weights=WEIGHTS, max_repeat=MAX_REPEAT, **columns) -> tuple[DataFrame, DataFrame]:
    """The staged narrow table of documents and the thresholds of their sources."""
    sized = stage(sizes(docs, **columns), "mix-sizes")
    return sized, thresholds(sized, stage(targets(sized, weights, max_repeat), "mix-targets"), max_repeat)


def copies(hash_col, whole="whole", below="below"):
    return (F.col(whole) + F.when(hash_col < F.col(below), 1).otherwise(0)).cast("bigint")


def taken(docs: DataFrame, **kw) -> DataFrame:
    """Words taken of each document: ``doc_id, source, size, source_size, target, taken``."""
    sized, cuts = plan(docs, **kw)
    cuts = small(cuts.withColumnRenamed("source", "s"))
    both = sized.join(cuts, F.col("source").eqNullSafe(F.col("s")))
    return both.select("doc_id", "source", "size", "source_size", "target", (copies(F.col("hash")) * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **kw) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, columns unchanged."""
    _, cuts = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **kw)
    cuts = small(cuts.select(F.struct("source", "whole", "below").alias("_mix")))
    both = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(source_col).cast("string").alias("_s"), document_hash(id_col, text_col).alias("_h"))
    both = both.join(cuts, F.col("_s").eqNullSafe(F.col("_mix.source")))
    times = F.col("_mix.whole") + F.when(F.col("_h") < F.col("_mix.below"), 1).otherwise(0)
    return both.withColumn("_n", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select("_row.*")


SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS h FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
wts AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM src),
caps AS (SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / w AS rate FROM wts),
fill AS (SELECT *, row_number() OVER o AS place,
  ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
  ((sum(w) OVER ()) - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv
  FROM caps WINDOW o AS (ORDER BY rate, encode(source) NULLS LAST)),
lev AS (SELECT lv FROM fill WHERE lv <= rate ORDER BY place LIMIT 1),
goal AS (SELECT source, source_size, least(cap, lev.lv * w) AS target FROM fill, lev),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS whole FROM goal),
run AS (
  SELECT s.doc_id, s.size, s.h, c.source_size, c.target, c.whole, c.target - c.whole * c.source_size AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.h) AS own
  FROM sized s JOIN cut c ON s.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN upto - own + own * 0.5 > budget THEN 0 ELSE 1 END) * size)::BIGINT AS taken FROM run
"""


@query("op7_mixing_weights", SQL)
def op7(spark, sf_dir):
    rows = taken(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")
