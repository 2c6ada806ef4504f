"""CSV and Parquet snapshots in and out."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientela import contracts as C


NULL = r"\N"   # a text with a backslash is written with two, so none reads as this

CSV = {"header": True, "quote": '"', "escape": '"', "nullValue": NULL, "emptyValue": '""',
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
       "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}


def _escaped(df: DataFrame) -> DataFrame:
    """Texts on one line each: backslash, line feed and carriage return as two characters."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = {c: F.replace(F.replace(F.replace(F.col(f"`{c}`"), F.lit("\\"), F.lit("\\\\")),
                                  F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")) for c in texts}
    return df.withColumns(out) if out else df


def _unescaped(text: Column) -> Column:
    """The texts that _escaped wrote. Doubled backslashes are set aside first."""
    parts = F.transform(F.split(text, r"\\\\", -1), lambda x: F.replace(F.replace(
        x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(text.contains("\\"), F.array_join(parts, "\\")).otherwise(text)


def read_csv_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      sep: str = ",", foreign: bool = False) -> DataFrame:
    """CSV with header, as `write_snapshot` writes it. Columns are matched by name and cast to
    `schema`, so a file may hold an unnamed index column or another column order; bad values
    become null. Without a schema every column is text, since types should not depend on a file's
    content.

    A `foreign` file may have line breaks inside quotes, so it is read by one task; its
    backslashes are plain characters and its empty fields null."""
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "inferSchema": False,
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "multiLine": foreign,
               "nullValue": "" if foreign else NULL}
    raw = spark.read.options(**options).csv(path)
    raw = raw.drop(*[c for c in raw.columns if c in C.INDEX_COLUMNS])
    if not foreign and raw.columns:
        raw = raw.select(*[_unescaped(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    if schema is None:
        return raw
    have = set(raw.columns)
    return raw.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast("string"))
        .try_cast(f.dataType).alias(f.name) for f in schema.fields])


def write_snapshot(df: DataFrame, path: str, fmt: str = "csv", sep: str = ",",
                   partition: str | None = None, mode: str = "overwrite") -> None:
    """CSV, TSV or Parquet. Partitioned Parquet replaces only the partitions it writes. In CSV,
    line breaks are escaped, so files can be split; null, empty text and outer blanks are kept
    apart."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    out = _escaped(df) if fmt == "csv" else df
    writer = out.write.mode(mode)
    if partition is not None:
        writer = balanced(out, partition).write.mode(mode).partitionBy(partition).option(
            "partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer.options(**CSV, sep=sep).csv(path)
    else:
        writer.parquet(path)


def balanced(df: DataFrame, col: str) -> DataFrame:
    """Few files per label without one task per label: adaptive execution gathers small labels
    and splits large ones."""
    return df.hint("rebalance", F.col(col))


def write_by_segment(df: DataFrame, path: str, col: str = "rfm", fmt: str = "csv") -> None:
    """One folder per segment label; rows without a label are left out. The whole table is
    replaced, so a label that no longer occurs leaves no folder behind."""
    labelled = df.filter(F.col(col).isNotNull())
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    texts = labelled.drop(col).columns
    out = _escaped(labelled.select(*[F.col(f"`{c}`") for c in texts], F.col(col))) if fmt == "csv" else labelled
    writer = balanced(out, col).write.mode("overwrite").partitionBy(col).option(
        "partitionOverwriteMode", "static")
    if fmt == "csv":
        writer.options(**CSV).csv(path)
    else:
        writer.parquet(path)


POINTER = "_current-"
KEPT = 2   # versions that stay, so a reader that has resolved one can finish


def _folder(spark: SparkSession, root: str):
    """The file system of a folder, the folder, and the class of its paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(root)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder, path


def _numbers(fs, folder, prefix: str) -> dict[int, list[str]]:
    """Names in a folder by the number behind the prefix."""
    found: dict[int, list[str]] = {}
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        name = status.getPath().getName()
        number = name.removeprefix(prefix).split("-")[0]
        if name.startswith(prefix) and number.isdigit():
            found.setdefault(int(number), []).append(name)
    return found


def published(spark: SparkSession, root: str) -> str:
    """Folder of the version that readers of `root` should read: the one the latest pointer names."""
    fs, folder, path = _folder(spark, root)
    pointers = _numbers(fs, folder, POINTER)
    if not pointers:
        raise FileNotFoundError(f"nothing published in {root}")
    name = pointers[max(pointers)][0]
    return f"{root}/{name.split('-', 2)[2]}"


def publish(df: DataFrame, root: str, fmt: str = "csv", sep: str = ",") -> str:
    """Write a new version of the table and switch readers to it at once; returns its folder.

    The version is a folder of its own. Only when it is whole, an empty pointer file with its number
    and name gets its place by one rename. A writer that breaks off leaves the old version in place,
    a reader sees one version or the next, and two writers cannot take the same number. The KEPT
    latest versions stay; older ones, and what broken writers left, go with the next publication."""
    spark = df.sparkSession
    fs, folder, path = _folder(spark, root)
    number = max(_numbers(fs, folder, POINTER), default=0) + 1
    name = f"v{number:08d}-{uuid.uuid4().hex}"
    write_snapshot(df, f"{root}/{name}", fmt, sep, mode="error")
    draft, pointer = path(f"{root}/_draft-{name}"), path(f"{root}/{POINTER}{number:08d}-{name}")
    fs.create(draft, True).close()
    if number in _numbers(fs, folder, POINTER) or not fs.rename(draft, pointer):
        raise RuntimeError(f"version {number} of {root} was published by another writer")
    for prefix in (POINTER, "v"):  # pointers first: none names a folder that is gone
        for old, names in _numbers(fs, folder, prefix).items():
            for each in names if old <= number - KEPT else ():
                fs.delete(path(f"{root}/{each}"), True)
    return f"{root}/{name}"


def publish_latest(df: DataFrame, archive: str, latest: str, fmt: str = "csv") -> str:
    """The same result to the month's archive and to the place readers look at, whose current version
    is returned. The plan runs once: the second copy is made from the first."""
    write_snapshot(df, archive, "parquet")
    stored = df.sparkSession.read.schema(df.schema).parquet(archive)
    return publish(stored, latest, fmt)
