"""Hand-offs between jobs in the shared folder, and small helpers on frames."""

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clientela.sources.staging import staged

SMALL_ROWS = 20_000
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def mapped(df: DataFrame, work: Callable, schema: str | StructType) -> DataFrame:
    """mapInArrow whose Python workers find this package where the driver found it. On a cluster
    the package is installed, or shipped with --py-files, as any other."""
    env = df.sparkSession.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    return df.mapInArrow(work, schema)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back; a lost executor costs a re-read."""
    return staged(df, f"llm-{name}")


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A stored frame with a broadcast hint if it is counted to be small, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def renamed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only what an operator needs, under names that cannot clash with other columns."""
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def free_name(docs: DataFrame, name: str) -> str:
    """`name`, with as many `_` behind as no column of `docs` has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
