"""CSV layouts, tensors and the driver contract."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import table
from seriesprep.layout import arrays_to_points, longest_series
from seriesprep.sources import tables
from seriesprep.sources.npy import NpyTensorSource, read_tensor


def write(path, text):
    path.write_text(text)


def test_csv_layouts(spark, tmp_path):
    d = tmp_path / "dated"
    d.mkdir()
    write(d / "x.csv", "date,data,cols\n0,1.5,0\n1,2.5,0\n")
    write(d / "y.CSV", "date,data,cols\n0,9,0\n")
    write(d / "note.txt", "no series")
    (d / "sub").mkdir()
    write(d / "sub" / "z.csv", "date,data,cols\n0,7,0\n")
    got = table(tables.read_long_csv(spark, str(d)), ("t",))
    assert {k: v["v"] for k, v in got.items()} == {("x", "0", 0): 1.5, ("x", "0", 1): 2.5, ("y", "0", 0): 9.0}
    write(d / "w.csv", "data,cols\n4,a\n5,a\n")
    got = table(tables.read_long_csv(spark, str(d)), ("t",))
    assert {k: v["v"] for k, v in got.items() if k[0] == "w"} == {("w", "a", 0): 4.0, ("w", "a", 1): 5.0} and len(got) == 5
    u = tmp_path / "undated"
    u.mkdir()
    write(u / "m.csv", "data,cols\n1,a\n2,a\n,b\n4,b\n1,label\n0,label\n")
    rows = tables.drop_labels(tables.read_long_csv(spark, str(u)))
    assert {k[1:]: v["v"] for k, v in table(rows, ("t",)).items()} == {("a", 0): 1.0, ("a", 1): 2.0, ("b", 0): None, ("b", 1): 4.0}
    full = table(tables.drop_missing(rows), ("t",))
    assert full[("m", "b", 0)]["v"] == 4.0


def test_unequal_channels_are_reported(spark, tmp_path):
    write(tmp_path / "m.csv", "data,cols\n1,a\n2,a\n3,b\n")
    rows = table(tables.channel_lengths(tables.read_long_csv(spark, str(tmp_path))))
    assert rows[("m", "a")]["n"] == 2 and not rows[("m", "b")]["equal_lengths"]


def test_npy_tensor(spark, tmp_path):
    x = np.random.default_rng(0).normal(size=(5, 7, 1)).astype("float32")
    np.save(tmp_path / "data.npy", x)
    spark.dataSource.register(NpyTensorSource)
    df = spark.read.format("npy_tensor").option("pointsPerTask", 14).load(str(tmp_path / "data.npy"))
    got = {r[0]: r[1] for r in df.collect()}
    assert len(got) == 5 and np.allclose(got["data_3"], x[3, :, 0])
    assert tables.length_range(df).first() == (7, 7)
    assert longest_series(arrays_to_points(df)) == 7


def test_one_dimensional_tensor_is_one_series(spark, tmp_path):
    np.save(tmp_path / "line.npy", np.arange(9.0))
    spark.dataSource.register(NpyTensorSource)
    rows = spark.read.format("npy_tensor").load(str(tmp_path / "line.npy")).collect()
    assert [(r[0], r[1]) for r in rows] == [("line_0", list(np.arange(9.0)))]


def test_large_whole_number_times_keep_their_order(spark):
    base = 1_700_000_000_000_000_000
    rows = [("s", base + i, float(i)) for i in np.random.default_rng(0).permutation(50).tolist()]
    frame = spark.createDataFrame(rows, "s string, at bigint, v double")
    got = table(tables.points_from_rows(frame, F.col("s"), F.col("at"), F.col("v")), ("t",))
    assert all(r["v"] == float(k[2]) for k, r in got.items()) and len(got) == 50


def test_no_shared_folder_is_an_error(spark):
    from seriesprep.layout import shared_folder

    def session(master, folder):
        return SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {}, sparkContext=SimpleNamespace(master=master, applicationId="a"))

    assert shared_folder(session("spark://host:7077", "hdfs://shared/x/")) == "hdfs://shared/x"
    assert shared_folder(session("local[4]", None)) == shared_folder(session("local", None))
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            shared_folder(session(master, None))


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and {"Trend", "keep", "reasons"} <= set(rows[0].asDict())


@pytest.mark.parametrize("limit", [0, 1 << 30])
@pytest.mark.parametrize("shape, kind", [((5, 7, 1), "float32"), ((3, 20_011), "float64"), ((40_000,), "int16"), ((2, 3, 4), "float64"), ((0, 4), "float64")])
def test_tensor_by_the_readers_of_spark(spark, tmp_path, limit, shape, kind):
    """Whole files and ranges of records give the same samples; ranges are forced to be small."""
    x = (np.random.default_rng(1).normal(size=shape) * 100).astype(kind)
    np.save(tmp_path / "a b.npy", x)
    (tmp_path / "note.txt").write_text("no tensor")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.input.fileinputformat.split.maxsize", "50000")
    try:
        got = {r[0]: r[1] for r in read_tensor(spark, f"file://{tmp_path}", limit).collect()}
    finally:
        conf.unset("mapreduce.input.fileinputformat.split.maxsize")
    rows = x.reshape(1, -1) if x.ndim == 1 else x.reshape(len(x), -1) if len(x) else []
    assert got == {f"a b_{i}": [float(v) for v in row] for i, row in enumerate(rows)}


def test_tensor_in_fortran_order(spark, tmp_path):
    x = np.asfortranarray(np.arange(12.0).reshape(3, 4))
    np.save(tmp_path / "f.npy", x)
    got = {r[0]: r[1] for r in read_tensor(spark, str(tmp_path)).collect()}
    assert got == {f"f_{i}": list(x[i]) for i in range(3)}
    with pytest.raises(ValueError, match="C order"):
        read_tensor(spark, str(tmp_path), 0)
