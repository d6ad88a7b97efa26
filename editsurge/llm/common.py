"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editsurge.session import ensure_checkpoint_dir
from editsurge.sources.tables import read_table


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once for each application, so
    that functions of its modules can be imported there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="editsurge-src-"), "editsurge_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The whole documents table, only the named columns."""
    return read_table(spark, sf_dir, "documents", *columns)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it from
    there: its lineage ends and a lost executor loses nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that an explicit exchange should use (the session's setting)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[list[list]], list[list]]],
             rows: int = 256) -> DataFrame:
    """``mapInArrow`` over small slices.  ``make()`` runs once per task and
    returns a function from input columns (lists) to output columns (lists);
    at most ``rows`` input rows are held as Python objects at a time."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                cols = fn([c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(cols, out)], schema=out)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xBF58476D1CE4E5B9)
MIX_C = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants) over uint64 values."""
    with np.errstate(over="ignore"):
        x = x + MIX_A
        x = (x ^ (x >> np.uint64(30))) * MIX_B
        x = (x ^ (x >> np.uint64(27))) * MIX_C
        return x ^ (x >> np.uint64(31))


def utf8_crc32_mod3(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3 (the fold of a document)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


#: Hash values from 0 up to this one; so fine that a share of any table is not rounded to none.
HASH_RANGE = 1 << 62


def hash_part(*columns: Column | str) -> Column:
    """A hash of the columns from 0 to ``HASH_RANGE``, alike at every run."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def hash_bound(size: int, n: int) -> int:
    """Rows whose ``hash_part`` is below this are about ``size`` of ``n`` (all, if there are fewer)."""
    return HASH_RANGE if n <= size else HASH_RANGE * size // n
