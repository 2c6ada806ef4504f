"""Hand-offs on shared storage, and size-checked broadcasts."""

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER_CONF = "spark.checkpoint.dir"
FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST_ROWS = 100_000
_OWNER: contextvars.ContextVar[str | None] = contextvars.ContextVar("clientela_staging_owner", default=None)


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by the session. Only where none is set, as in local tests, a
    temporary one is made and set."""
    root = spark.conf.get(FOLDER_CONF, None) or spark.sparkContext.getConf().get(FOLDER_CONF)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{FOLDER_CONF} must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="clientela-")
        spark.conf.set(FOLDER_CONF, root)
    return root.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A place of its own; within `owned`, in the folder of the job."""
    owner = _OWNER.get()
    root = staging_root(spark) if owner is None else f"{staging_root(spark)}/{owner}"
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Hand-offs stored within belong to one job and are deleted when it ends, also by an error. What
    the job returns must not read them: it writes its results elsewhere. Within another job, that one
    owns them."""
    if _OWNER.get() is not None:
        yield
        return
    name = f"job-{uuid.uuid4().hex}"
    mark = _OWNER.set(name)
    try:
        yield
    finally:
        _OWNER.reset(mark)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query made and run within are deleted when it ends, not when the driver next
    collects garbage: nothing reads them again, but they fill the disk beside the next step's."""
    before = spark.conf.get(FREE_CONF, "false")
    spark.conf.set(FREE_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_CONF, before)


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write and read back: later steps scan a table instead of repeating the plan, and a lost
    executor costs a re-read. In folders `by` a column without nulls, a reader of one value opens its folder alone."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    with freed(spark):
        rows = df.select("*")  # a query of its own: `df` may be run again
        (rows.write if by is None else rows.write.partitionBy(by)).parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    return held if by is None else held.select(*[f"`{c}`" for c in df.columns])  # in the order it had


def broadcast_if_bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that the frame is small; else leave the join to
    shuffle. The frame is stored, as it is needed again right after the count."""
    held = staged(df, "bounded")
    return F.broadcast(held) if held.limit(rows + 1).count() <= rows else held
