"""Token ids as Parquet list columns, in files that can be read in part.

A folder holds two tables. `tokens` has a row per document in ascending order of its id: doc_id,
part (its file), at (row of the file), offset (ids before it in the file), n_tokens and ids. The ids
are dictionary encoded, as they are few; the ascending numbers are delta encoded. Row groups and
pages are small enough that bounds of the numbers, which stand in the footers and page indexes, let
a reader skip what it does not need. `files` has a row per file: part, documents, tokens, base (ids in
all files before it), first_id and last_id. A document starts at base + offset."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientela.llm import encoders
from clientela.llm.store import mapped, renamed
from clientela.llm.textbytes import slices

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
ASCENDING = ("part", "at", "offset")

_LOADED: dict[int, encoders.Encoder] = {}


def _loaded(source) -> encoders.Encoder:
    key = hash(source.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = encoders.byte_level(source.value)
    return _LOADED[key]


def layout(id_col: str) -> dict[str, str]:
    """Options of the Parquet writer."""
    numbers = {f"parquet.enable.dictionary#{c}": "false" for c in (*ASCENDING, id_col)}
    return {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true",
            "parquet.block.size": str(ROW_GROUP_BYTES), "parquet.page.size": str(PAGE_BYTES),
            "parquet.dictionary.page.size": str(1 << 20), "parquet.page.row.count.limit": str(PAGE_ROWS),
            "compression": "zstd", **numbers}


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts (null: empty) to the ids of the tokenizers library, with `end_id` behind each,
    and write them to a new folder.

    Rows are dealt by ranges of their id and sorted, rows without an id first. Rows of one id follow
    each other by a hash of their text; however many there are, they are dealt over several files.
    Equal rows are all written. An empty table leaves a folder without rows."""
    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = renamed(docs, id_col, text_col)
    order = ["id", "mark", "spread"]
    rows = (rows.withColumn("mark", F.xxhash64("text")).withColumn("spread", F.monotonically_increasing_id())
            .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
            .select("id", "text", "part"))
    end = np.array([] if end_id is None else [end_id], "<i4").tobytes()

    def work(batches) -> Iterator[pa.RecordBatch]:
        encoder, at, offset = _loaded(source), 0, 0
        for piece in slices(batches):
            found = [ids + end for ids in encoder.ids([t or "" for t in piece.column(1).to_pylist()])]
            counts = np.array([len(x) // 4 for x in found], np.int64)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            flat = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield pa.record_batch({
                "id": piece.column(0), "part": piece.column(2), "at": pa.array(np.arange(at, at + len(found))),
                "offset": pa.array(offset + bounds[:-1]), "n_tokens": pa.array(counts),
                "ids": pa.ListArray.from_arrays(bounds.astype(np.int32), flat)})
            at, offset = at + len(found), offset + int(bounds[-1])

    kind = rows.schema["id"].dataType.simpleString()
    encoded = mapped(rows, work, f"id {kind}, part int, at long, offset long, n_tokens long, ids array<int>")
    encoded = encoded.withColumnRenamed("id", id_col)
    encoded.write.options(**layout(id_col)).parquet(f"{folder}/tokens")
    held = docs.sparkSession.read.schema(encoded.schema).parquet(f"{folder}/tokens")
    files = held.groupBy("part").agg(
        F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"),
        F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    files.coalesce(1).write.parquet(f"{folder}/files")


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """A row per file."""
    return spark.read.parquet(f"{folder}/files")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of `tokens` and start, the ids of all documents before. What is not selected is
    not read: columns besides `ids` come from a small part of the files."""
    files = files_of(spark, folder).select("part", "base")
    held = spark.read.parquet(f"{folder}/tokens")
    return held.join(F.broadcast(files), "part").withColumn("start", F.col("base") + F.col("offset")).drop("base")


def read_ids_between(spark: SparkSession, folder: str, low, high, id_col: str = "doc_id") -> DataFrame:
    """Documents whose ids lie in a closed range: other files, row groups and pages are skipped."""
    return read_tokens(spark, folder).where(F.col(id_col).between(low, high))


def read_stretch(spark: SparkSession, folder: str, first: int, count: int) -> DataFrame:
    """(doc_id, ..., first_token, ids) of `count` ids from the `first` on of all ids in a row, as a
    trainer reads them: `ids` are cut to the stretch, first_token is where they begin. Only files
    that the stretch touches are opened, and of them the row groups and pages with its documents."""
    stop = first + count
    met = files_of(spark, folder).where((F.col("base") < stop) & (F.col("base") + F.col("tokens") > first))
    span = met.agg(F.min("part").alias("low"), F.max("part").alias("high"), F.min_by("base", "part").alias("base"),
                   F.max_by("base", "part").alias("top")).first()
    rows = read_tokens(spark, folder)
    if span.low is None:
        return rows.where("false").withColumn("first_token", F.col("start"))
    rows = rows.where(F.col("part").between(span.low, span.high))
    if span.low == span.high:  # the offsets bound it too
        rows = rows.where((F.col("offset") < stop - span.base) & (F.col("offset") + F.col("n_tokens") > first - span.base))
    skip = F.greatest(F.lit(first) - F.col("start"), F.lit(0))
    size = F.least(F.col("start") + F.col("n_tokens"), F.lit(stop)) - F.col("start") - skip
    return (rows.where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > first))
            .withColumn("first_token", F.col("start") + skip)
            .withColumn("ids", F.slice("ids", (skip + 1).cast("int"), size.cast("int"))))


def checksums(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of rows of `read_tokens`: n_tokens counts the list that was
    read, ids_crc32 is the unsigned crc32 of its ids as little-endian unsigned 32-bit integers."""
    rows = tokens.select(F.col(f"`{id_col}`").alias("id"), "start", "ids")

    def work(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            bounds = lists.offsets.to_numpy().tolist()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            sums = [zlib.crc32(flat[s:e]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.record_batch({"id": batch.column(0), "start": batch.column(1), "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                                   "ids_crc32": pa.array(sums, pa.int64())})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"id {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)
