"""Fourier transform of a series that does not fit one block.

The transform of any length n is a convolution with a chirp (Bluestein 1970),
padded to a power of two M = R * C.  A transform of length M is C transforms of
length R, a twiddle factor and R transforms of length C; each small transform is
one row, and the reordering between the two steps is the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..layout import KEY, attach, split_blocks


def _size(n: Column) -> Column:
    """Exponent of the padded length: 2^e >= 2n - 1."""
    return F.ceil(F.log2(F.col("n") * 2 - 1)).cast("int")


def _angle(num: Column, den: Column) -> Column:
    return num.cast("double") * 2 * F.pi() / den


def split_transform(cells: DataFrame) -> DataFrame:
    """Forward transform of rows (KEY, n, e, t, re, im), missing t meaning zero; same layout out."""
    key = [*KEY, "n", "e"]
    half = F.floor(F.col("e") / 2).cast("int")
    rows = F.pow(F.lit(2.0), half).cast("bigint")
    cols = F.pow(F.lit(2.0), F.col("e") - half).cast("bigint")
    sized = cells.withColumn("rows", rows).withColumn("cols", cols)
    key = [*key, "rows", "cols"]

    def step(frame: DataFrame, group: str, index: str, length: str) -> DataFrame:
        packed = frame.groupBy(*key, group).agg(F.collect_list(F.struct(F.col(index).alias("i"), "re", "im")).alias("z"))
        done = packed.withColumn("f", kernels.transform_cells("z", length))
        return done.select(*key, group, F.posexplode("f").alias("k", "y")).select(
            *key, group, F.col("k").cast("bigint").alias("k"), F.col("y.re").alias("re"), F.col("y.im").alias("im")
        )

    grid = sized.withColumn("c", F.col("t") % F.col("cols")).withColumn("r", F.floor(F.col("t") / F.col("cols")))
    first = step(grid, "c", "r", "rows")
    turn = _angle(-(F.col("c") * F.col("k")), F.col("rows") * F.col("cols"))
    turned = first.select(
        *key,
        F.col("k").alias("r"),
        "c",
        (F.col("re") * F.cos(turn) - F.col("im") * F.sin(turn)).alias("re"),
        (F.col("re") * F.sin(turn) + F.col("im") * F.cos(turn)).alias("im"),
    )
    second = step(turned, "r", "c", "cols")
    return second.select(
        *KEY, "n", "e", (F.col("r") + F.col("rows") * F.col("k")).alias("t"), "re", "im"
    )


def _chirp(t: Column) -> Column:
    """Angle pi t^2 / n with t^2 reduced modulo 2n."""
    return F.pmod(t * t, F.col("n") * 2).cast("double") * F.pi() / F.col("n")


def long_cells(points: DataFrame, sizes: DataFrame, block_len: int) -> DataFrame:
    """One row per bin ``t`` with ``amp`` = 2|F_k|/n, k < n // 2, for the series in ``sizes``."""
    rows = attach(split_blocks(points, block_len=block_len), sizes, block_len).withColumn("e", _size(F.col("n")))
    a = _chirp(F.col("t"))
    left = rows.select(
        *KEY, "n", "e", "t", (F.col("v") * F.cos(a)).alias("re"), (-F.col("v") * F.sin(a)).alias("im")
    )
    mirror = F.pow(F.lit(2.0), F.col("e")).cast("bigint") - F.col("t")
    spots = F.when(F.col("t") == 0, F.array("t")).otherwise(F.array(F.col("t"), mirror))
    right = rows.select(
        *KEY, "n", "e", F.explode(spots).alias("t"), F.cos(a).alias("re"), F.sin(a).alias("im")
    )
    cell = [*KEY, "n", "e", "t"]
    x = split_transform(left)
    y = split_transform(right).withColumnRenamed("re", "re2").withColumnRenamed("im", "im2")
    # the inverse transform is the conjugate of the forward one of the conjugate
    product = x.join(y, cell).select(
        *cell,
        (F.col("re") * F.col("re2") - F.col("im") * F.col("im2")).alias("re"),
        (-(F.col("re") * F.col("im2") + F.col("im") * F.col("re2"))).alias("im"),
    )
    back = split_transform(product).filter(F.col("t") < F.floor(F.col("n") / 2))
    amp = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")) / F.pow(F.lit(2.0), F.col("e")) * 2 / F.col("n")
    return back.select(*KEY, "n", "t", amp.alias("amp"))


def long_power(points: DataFrame, sizes: DataFrame, block_len: int) -> DataFrame:
    """One row per bin ``t`` with ``power`` = |F_k|^2 of a zero-mean series padded to a power of two, and ``half``, the last bin."""
    exponent = F.ceil(F.log2(F.col("n"))).cast("int")
    rows = attach(split_blocks(points, block_len=block_len), sizes, block_len).withColumn("e", exponent)
    cells = split_transform(rows.select(*KEY, "n", "e", "t", F.col("v").alias("re"), F.lit(0.0).alias("im")))
    half = F.pow(F.lit(2.0), F.col("e") - 1).cast("bigint")
    power = F.col("re") * F.col("re") + F.col("im") * F.col("im")
    return cells.select(*KEY, "n", "t", half.alias("half"), power.alias("power")).filter("t <= half")
