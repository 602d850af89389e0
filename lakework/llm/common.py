"""Helpers that several operators share: staging, Arrow plumbing, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.session import shared_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run of an operator, under the shared folder."""
    return f"{shared_dir(spark)}/lakework-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The files are replicated by the shared store, so a lost executor costs
    nothing that is already staged.  Compressed Parquet keeps them small.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (Spark ignores case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` of a function of one batch."""

    def run(batches):
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


_SLICE_BYTES = 8 << 20


def small_slices(*arrays: pa.Array) -> Iterator[list[pa.Array]]:
    """The arrays in slices of some megabytes, at least one, so that long texts don't become Python objects all at once."""
    n, size = len(arrays[0]), sum(a.nbytes for a in arrays)
    step = max(1, n * _SLICE_BYTES // max(size, 1))
    for i in range(0, max(n, 1), step):
        yield [a.slice(i, step) for a in arrays]


def arrow_column(fn: Callable[[list], list], returns: T.DataType, *columns: Column) -> Column:
    """A column computed by ``fn`` from lists of the given columns' values, batch by batch.

    The rest of the row stays on the JVM's side, so extra columns can't clash.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_type = to_arrow_type(returns)

    @F.arrow_udf(returns)
    def apply(*arrays: pa.Array) -> pa.Array:
        parts = [pa.array(fn(*(a.to_pylist() for a in part)), type=arrow_type) for part in small_slices(*arrays)]
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    return apply(*columns)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


#: What a broadcast side may weigh; rows count with this many bytes besides their texts and arrays.
BROADCAST_BYTES, ROW_BYTES = 48 << 20, 64


def small_or_plain(df: DataFrame, most: int, *sized: str, bytes_: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows and weighs at most ``bytes_``, else without.

    ``sized`` are the columns (strings, binaries) whose lengths vary.  Only ``most + 1``
    rows are looked at, so the check costs the same at any size.  A side with such columns
    that fails it is merged: by itself Spark broadcasts files under its threshold, and
    compressed strings may take many times their files' bytes.
    """
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in sized), F.lit(ROW_BYTES).cast("long"))
    n, weight = df.limit(most + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    if n <= most and weight <= bytes_:
        return F.broadcast(df)
    return df.hint("merge") if sized else df


_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers, modulo 2**64, of the multiplier and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        _powers = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)]), dtype=np.uint64) for x in (_MULTIPLIER, _INVERSE))
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hash(data: bytes) -> np.ndarray:
    """Prefix sums of a polynomial hash; ``range_hash`` reads substrings from them."""
    a = np.frombuffer(data, np.uint8)
    out = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[a] * powers(len(a))[0], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end); equal strings have equal hashes anywhere."""
    return mixed((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


def window_hashes(prefix: np.ndarray, size: int) -> np.ndarray:
    """``range_hash`` of all substrings of one size, in order."""
    n = len(prefix) - size
    return mixed((prefix[size:] - prefix[:n]) * powers(len(prefix))[1][:n])


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than space and \\t to \\r."""
    a = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(a) + 2, bool)
    inside[1:-1] = ~((a == 32) | ((a >= 9) & (a <= 13)))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]
