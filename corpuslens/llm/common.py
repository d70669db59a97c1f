"""What the operators share: table access, words as bytes, Arrow columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Maps A-Z to a-z, keeps a-z, 0-9 and every byte of a non-ASCII character, and blanks the rest.
ALNUM_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alnum_words(data: bytes) -> list[bytes]:
    """Words of ASCII letters, digits and non-ASCII characters; A-Z lower-cased."""
    return data.translate(ALNUM_TABLE).split()


def space_words(data: bytes) -> list[bytes]:
    """Words between ASCII white space; A-Z lower-cased."""
    return data.translate(ASCII_LOWER).split()


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "binary": T.BinaryType(),
}


def fields(spec: str) -> T.StructType:
    """``"name type, ..."`` as a schema; unlike DDL it needs no session, so tasks can use it."""
    pairs = (item.split() for item in spec.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about ``limit`` bytes of text (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        if not len(sizes):
            continue
        block = np.cumsum(sizes.astype("int64")) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
        for first, last in zip(cuts, cuts[1:]):
            yield batch.slice(first, last - first)


#: Functions that empty what a worker process keeps from task to task.
CACHES: list[Callable[[], None]] = []


def release() -> None:
    """Give memory back to the system: a worker process outlives its task, and so would what it held."""
    for clear in CACHES:
        clear()
    trim()


def trim() -> None:
    """Give freed memory back, and keep the caches."""
    pa.default_memory_pool().release_unused()
    freed = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if freed is not None:
        freed(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task that starts without what earlier tasks of its worker left and leaves nothing itself."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def crc_mod(key: Column, modulus: int) -> Column:
    """``crc32`` of the key as text, modulo; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh_name(wanted: str, taken: list[str]) -> str:
    """A column name that is not taken; case does not count."""
    lowered = {name.lower() for name in taken}
    while wanted.lower() in lowered:
        wanted += "_"
    return wanted
