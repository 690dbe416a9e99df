"""What the training-data operators share: shared storage, hold-out rule, UDF plumbing."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the contracts, as a character class body.
WHITE = r"\x20\x09-\x0D"

_spooled: dict[str, SparkSession] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.  A private one only where it is unset and all runs in one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext._jsc.sc()
    if not context.getCheckpointDir().isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="curblake-"))
    return context.getCheckpointDir().get()


def spool(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the real size, so that it
    broadcasts what is small and shuffles what is not.  Removed by `release`, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark).rstrip('/')}/spool-{uuid.uuid4().hex}-{name}"
    _spooled[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.spooled = path
    return out


def release(*frames: DataFrame | None) -> None:
    """Delete spooled tables that nothing will read again."""
    for df in frames:
        path = vars(df).get("spooled") if df is not None else None
        spark = _spooled.pop(path, None)
        if spark is None:
            continue
        try:
            jvm = spark.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # noqa: BLE001, S110  the session may be gone; its cluster then cleans up
            pass


class _Path:
    def __init__(self, spooled: str) -> None:
        self.spooled = spooled


def unspool() -> None:
    """Delete every spooled table; results that still read one must have been written before."""
    release(*map(_Path, list(_spooled)))


atexit.register(unspool)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Fold 0 of 5 by CRC-32 of the id's decimal text; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5 == 0, F.lit(False))


def below(rate: Column, *key: str) -> Column:
    """A repeatable sample: true for the share ``rate`` of rows, chosen by a hash of ``key``."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < F.floor(rate * (1 << 30))


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Send Arrow batches of few rows, as texts may be long; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Return freed memory to the system, as an idle Python worker stays beside the JVM for the next stages."""
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        import ctypes

        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def by_batch(df: DataFrame, schema: str, fn: Callable[..., list], *columns: str, done: Callable[[], object] | None = None) -> DataFrame:
    """``df[columns]`` through ``fn(lists of values) -> lists of values``, an Arrow batch at a time; ``done()`` ends a task."""
    from pyspark.sql.types import StructType

    target = _arrow(StructType.fromDDL(schema))
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # long texts: few at once
                part = batch.slice(at, 256)
                out = fn(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(out, target, strict=True)], schema=target)
        if done:
            done()
        give_back()

    return df.select(*columns).mapInArrow(run, schema)


def _arrow(schema):  # noqa: ANN001, ANN202
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
