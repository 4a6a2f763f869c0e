"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.session import ship  # noqa: F401  (the operators take it from here)

#: Bytes of text one numpy step works on; a single longer text is a step of its own.
BLOCK_BYTES = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a local session (one process, as in tests) gets a folder of its own; on a
    cluster that would lose rows, so there the missing setting raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not folder:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="wearline-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/wearline-llm/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor's later tasks read the files again instead of
    recomputing, and several readers share one computation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._landed_at = path
    return out


def discard(*landed: DataFrame) -> None:
    """Delete the files of landed tables whose last reader has ended.

    Only tables that nothing written later is going to read again: what was computed from them has
    been landed itself, so a lost executor does not need them.
    """
    for df in landed:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._landed_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Keys of more than 1 in this many rows (and of more than ``HOT_LEAST``) are looked up by broadcast.
HOT_SHARE, HOT_LEAST = 65_536, 64
#: Facts of a lookup that are broadcast whatever they weigh.
FEW_FACTS = 200_000


def hot_bar(rows: int) -> int:
    return max(HOT_LEAST, rows // HOT_SHARE)


def looked_up(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, bar: int) -> DataFrame:
    """Inner join of ``rows`` with ``facts`` (one row for each key), whose ``weight`` counts the key's rows.

    Keys of more than ``bar`` rows, of which there are at most ``rows / bar``, are in a broadcast
    table, so their rows stay where they are; the rest is joined by a shuffle. Where there are no
    more than ``FEW_FACTS`` facts in all, all of them are broadcast.
    """
    if facts.limit(FEW_FACTS + 1).count() <= FEW_FACTS:
        return rows.join(F.broadcast(facts), keys)
    hot, usual = facts.filter(F.col(weight) > bar), facts.filter(F.col(weight) <= bar)
    own = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(own.join(usual, keys))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, mod: int):
    """crc32 of an id's decimal text, modulo ``mod``: the folds of the scoring contracts."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(mod))


def no_key_clash(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that would clash with the ones an operator is going to add."""
    return df.drop(*[c for c in df.columns if c in names])


def fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and the offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    n = len(column)
    kind = np.int64 if wide else np.int32
    if where is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no block holds more than ``size`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            stop = min(batch.num_rows, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            start = stop


def small_batches(frames: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for columns in frames:
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (SplitMix64), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: An odd multiplier and its inverse modulo 2**64, for hashes of spans from prefix sums.
BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


class SpanHashes:
    """Hashes of byte spans of one text: equal spans have equal hashes, wherever they stand."""

    def __init__(self, data: np.ndarray, values: np.ndarray | None = None) -> None:
        n = len(data)
        v = (_BYTE_VALUES if values is None else values)[data]
        v *= powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(v, out=self.sums[1:])
        self.back = powers(n + 1, _BASE_INVERSE)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def gather_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the given spans, one after the other, and their offsets."""
    lens = ends - starts
    offsets = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lens)
    return data[index], offsets


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow binary column from bytes and offsets."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    )
