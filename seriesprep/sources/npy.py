"""SRC2: ``.npy`` tensors of shape (N, L, 1), (N, L) or (L,) as a Spark data source.

    spark.dataSource.register(NpyTensorSource)
    spark.read.format("npy_tensor").load("/shared/data.npy")

The header gives the shape, so the driver plans sample ranges without reading
data; every task memory-maps the file and copies out its own range.

``read_tensor`` gives the same rows from any store that Spark can open, by Spark's own file readers.
"""

from __future__ import annotations

import glob
import io
import math
import os
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class SampleRange(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class NpyTensorReader(DataSourceReader):
    def __init__(self, path: str, points_per_task: int):
        self.path, self.points_per_task = path, points_per_task

    def files(self) -> list[str]:
        if os.path.isdir(self.path):
            return sorted(glob.glob(os.path.join(self.path, "*.npy")))
        return [self.path]

    def partitions(self):
        import numpy as np

        out = []
        for path in self.files():
            shape = np.load(path, mmap_mode="r").shape
            if len(shape) == 1:  # one series: its length is the only dimension
                out.append(SampleRange(path, 0, 1))
                continue
            length = shape[1]
            step = max(1, self.points_per_task // max(length, 1))
            out += [SampleRange(path, a, min(a + step, shape[0])) for a in range(0, shape[0], step)]
        return out

    def read(self, partition):
        import numpy as np
        import pyarrow as pa

        data = np.load(partition.path, mmap_mode="r")
        data = (data[None] if data.ndim == 1 else data)[partition.start : partition.stop]
        data = np.asarray(data, dtype="float64").reshape(len(data), -1)
        name = os.path.splitext(os.path.basename(partition.path))[0]
        ids = [f"{name}_{i}" for i in range(partition.start, partition.stop)]
        offsets = np.arange(len(data) + 1, dtype="int32") * data.shape[1]
        values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(data.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(ids), values], names=["series_id", "values"])


class NpyTensorSource(DataSource):
    @classmethod
    def name(cls):
        return "npy_tensor"

    def schema(self):
        return "series_id string, values array<double>"

    def reader(self, schema):
        return NpyTensorReader(self.options["path"], int(self.options.get("pointsPerTask", 4_000_000)))


WHOLE_BYTES = 128 << 20  # files up to this size are read as one row
HEADER_BYTES = 4096
RECORD_BYTES = 64 << 10
SCHEMA = "series_id string, values array<double>"


def read_tensor(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``(series_id, values)`` of a ``.npy`` file or the ``.npy`` files of a folder, of any store that Spark can open.

    Files up to ``whole_bytes`` are one row each.  A larger file is split by Spark into ranges of fixed-length
    records; the driver reads only its header, and pieces of a sample meet in a shuffle.  A larger file
    must be in C order.  An empty tensor has no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path)
    rows = files.filter(F.col("length") <= whole_bytes).select("path", "content").mapInArrow(_whole_files, SCHEMA)
    for large in files.filter(F.col("length") > whole_bytes).select("path", "length").collect():
        rows = rows.unionByName(_large_file(spark, large["path"], large["length"]))
    return rows


def _name(path: str) -> str:
    return os.path.splitext(path.rsplit("/", 1)[-1])[0]


def _header(head: bytes) -> tuple[tuple[int, ...], bool, object, int]:
    """Shape, Fortran order, number type and first byte of the numbers."""
    import numpy as np

    file = io.BytesIO(head)
    version = np.lib.format.read_magic(file)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, fortran, kind = read(file)
    return (shape if len(shape) > 1 else (1, *shape)), fortran and len(shape) > 1, kind, file.tell()


def _samples(ids: list[str], values):
    """One Arrow batch of equally long samples, the rows of ``values``."""
    import numpy as np
    import pyarrow as pa

    offsets = np.arange(len(values) + 1, dtype="int32") * values.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values, "float64").ravel()))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), lists], names=["series_id", "values"])


def _whole_files(batches: Iterator) -> Iterator:
    import numpy as np

    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            data = content.as_buffer()
            shape, fortran, kind, at = _header(data.slice(0, min(HEADER_BYTES, data.size)).to_pybytes())
            tensor = np.frombuffer(data, kind, math.prod(shape), at).reshape(shape, order="F" if fortran else "C")
            width, name = math.prod(shape[1:]), _name(path)
            step = max(1, 1_000_000 // max(width, 1))
            for a in range(0, shape[0], step):
                part = tensor[a : a + step].reshape(-1, width) if width else np.empty((min(step, shape[0] - a), 0))
                yield _samples([f"{name}_{i}" for i in range(a, a + len(part))], part)


def _large_file(spark: SparkSession, path: str, length: int) -> DataFrame:
    """Samples of one file from fixed-length records, the longest whole numbers that divide its length."""
    unit = math.gcd(length, 16)
    record = max(r for r in range(unit, RECORD_BYTES + 1, unit) if length % r == 0)
    # The input format and its setting.
    form = "org.apache.spark.input.FixedLengthBinaryInputFormat"
    records = spark.sparkContext.newAPIHadoopFile(
        path, form, "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable", conf={f"{form}.recordLength": str(record)}
    )
    head = b"".join(bytes(x) for _, x in records.take(-(-min(HEADER_BYTES, length) // record)))
    shape, fortran, kind, first = _header(head)
    if fortran:
        raise ValueError(f"{path}: a file over the limit of whole files must be in C order")
    width, size = math.prod(shape[1:]), kind.itemsize
    if record % size:
        raise ValueError(f"{path}: {length} bytes are no whole number of {kind} values")
    most, name, code = max(1, (1 << 20) // record), _name(path), kind.str

    def pieces(rows):
        """Bytes of one sample each, from neighbouring records joined."""
        rows = iter(rows)
        while some := list(islice(rows, most)):
            data, at = b"".join(bytes(x) for _, x in some), some[0][0] * record - first
            data, at = data[max(-at, 0) :], max(at, 0)
            while data:
                sample, place = divmod(at // size, width)
                part = data[: (width - place) * size]
                yield sample, place, part
                data, at = data[len(part) :], at + len(part)

    def decode(batches):
        import numpy as np

        for batch in batches:
            for sample, parts in zip(batch["sample"].to_pylist(), batch["parts"]):
                data = b"".join(x["data"] for x in parts.as_py())
                yield _samples([f"{name}_{sample}"], np.frombuffer(data, code)[None])

    cut = spark.createDataFrame(records.mapPartitions(pieces), "sample bigint, place bigint, data binary")
    whole = cut.groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("place", "data"))).alias("parts"))
    return whole.mapInArrow(decode, SCHEMA)


def write_tensor_parts(arrays, path: str, samples_per_file: int = 100_000) -> None:
    """Write equal-length samples as ``.npy`` parts of one folder, one or more per task.

    ``path`` must be reachable by all executors.  A retried or repeated task
    rewrites the same file names.
    """

    def save(batches):
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        for pdf in batches:
            for a in range(0, len(pdf), samples_per_file):
                data = np.stack(pdf["values"].iloc[a : a + samples_per_file]).astype("float64")[:, :, None]
                os.makedirs(path, exist_ok=True)
                target = os.path.join(path, f"part-{part:05d}-{count:05d}.npy")
                np.save(f"{target}.tmp.npy", data)
                os.replace(f"{target}.tmp.npy", target)
                count += 1
        yield pd.DataFrame({"files": [count]})

    arrays.select("values").mapInPandas(save, "files bigint").agg({"files": "sum"}).collect()
