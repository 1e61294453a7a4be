"""Session settings, and intermediate tables that go when they are no longer needed."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

# What the library relies on: runtime re-planning with skew-join splitting, and UTC text.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "mdcatalog", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; extra settings as keyword arguments
    with underscores for dots are not supported, pass a dict: ``**{"spark.x": "y"}``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def qualified(spark: SparkSession, path: str) -> str:
    """A path with scheme and authority, so that driver, readers and every task mean the same file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(found).toString()
    return re.sub(r"^file:/+", "file:///", uri)


def as_uri(spark: SparkSession, path: str) -> str:
    """``qualified`` with everything escaped that a URI may not hold, for readers that parse it."""
    return quote(qualified(spark, path), safe=":/@")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, or, for a local session without one, its own.

    The folder is the one the cluster names in ``spark.checkpoint.dir``.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="mdcatalog-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


#: Where tables are written: the innermost scratch folder, or a folder of this process.
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)
_process: dict[str, str] = {}


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all that is in it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _process_folder(spark: SparkSession) -> str:
    """A folder of this process, deleted when it ends."""
    base = shared_folder(spark)
    if base not in _process:
        folder = _process[base] = f"{base}/{uuid.uuid4().hex}"
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

        def clean() -> None:
            with suppress(Exception):  # the session's process may be gone already
                system.delete(target, True)

        atexit.register(clean)
    return _process[base]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A folder for all intermediate tables made inside, deleted on leaving.

    A result is computed inside, too: written by its user, or by the given function, which writes a table that
    stays and belongs to what is around.
    """
    outer = _scratch.get()
    folder = f"{outer or _process_folder(spark)}/{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield lambda df: _written(df, f"{outer or _process_folder(spark)}/{uuid.uuid4().hex}")
    finally:
        _scratch.reset(token)
        delete(spark, folder)


def new_folder(spark: SparkSession) -> str:
    """The name of a new folder that driver and executors share."""
    return f"{_scratch.get() or _process_folder(spark)}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` and drop its lineage: as a checkpoint, or, inside of a scratch folder, as a table there."""
    if _scratch.get():
        return as_table(df)
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_table(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For results that several branches of a plan use, each with other columns: every branch
    scans only what it needs, and lost executors cost a re-read, not a recomputation.
    """
    return _written(df, new_folder(df.sparkSession))


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a query inside shuffles is deleted when that query ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def packed_table(df: DataFrame) -> DataFrame:
    """``as_table`` for tables as large as the input: packed closer, and what was shuffled for them is deleted."""
    spark, path = df.sparkSession, new_folder(df.sparkSession)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that ``as_table`` or a scratch folder's function wrote."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete(df.sparkSession, folder)
