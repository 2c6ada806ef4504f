"""Secret scans with ownership frequency, in DataFrame operations only.

Candidates are found by pattern in every text. Across the corpus, each candidate value (by digest,
never in clear) is counted by distinct repositories and owners: what several owners or many
repositories hold is a copied example, what few repositories of one owner hold looks live.
Live-looking bare tokens become spans too."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela.llm.store import keep

# Fixed values of the scan: kind, pattern, group of the value, least length of the value.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
BARE = ("bare", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
OWNERS = 1  # most owners of a value that still looks live
REPOSITORIES = 20  # and most repositories, copies of one text counted once

SPAN = "array<struct<start:int,rank:int,end:int,digest:string>>"


def _matches(text: Column, rank: int, pattern: str, group: int, least: int) -> Column:
    """Spans of a pattern, leftmost and without overlap, whose value is long enough. The pieces
    between matches give the positions."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def step(acc: Column, piece: Column) -> Column:
        start = acc["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["all"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                        F.md5(piece["value"].cast("binary")).alias("digest"))
        good = F.coalesce(F.length(piece["value"]) >= least, F.lit(False))
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["spans"], F.array(span).cast(SPAN)))
                        .otherwise(acc["spans"]).alias("spans"))

    none = F.array().cast(SPAN)
    found = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _listed(spans: Column) -> Column:
    """kind:start:end, by start, then kind as listed."""
    kinds = F.array(*[F.lit(k[0]) for k in (*BASE, BARE)])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat(
        F.get(kinds, s["rank"]), F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")


def _mixed(text: Column, span: Column) -> Column:
    value = F.substring(text, span["start"] + 1, span["end"] - span["start"])
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example.

    A document is a repository, `owner_col` its owner. Positions are code points, ends exclusive.
    n_live and n_example split all base spans and candidate tokens by whether at most OWNERS owners
    and REPOSITORIES repositories hold their value. Copies of one text count as one repository; a
    repository without an owner counts as an owner of its own. `spans` holds the base spans and
    the live-looking bare tokens (20 or more of A-Z, a-z, 0-9, +/_=-, with a digit and letters of
    both cases) that overlap no base span. A null text counts as empty. Rows that repeat an id are
    one repository, and each is returned."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{owner_col}`").alias("owner"), text.alias("text"))
    kinds = [k[0] for k in BASE]
    raw = rows.select("id", "owner", "text", *[
        _matches(F.col("text"), rank, *rest).alias(kind) for rank, (kind, *rest) in enumerate((*BASE, BARE))])
    base = raw.withColumn("base", F.concat(*kinds)).withColumn("bare", F.filter("bare", lambda b: ~F.exists(
        "base", lambda s: (s["start"] < b["end"]) & (b["start"] < s["end"])) & _mixed(F.col("text"), b)))
    found = keep(base.select(
        F.monotonically_increasing_id().alias("row"), "id", "owner", F.xxhash64("text").alias("copy"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), "base", "bare"), "secrets")

    candidates = found.where("size(base) + size(bare) > 0").select(
        "row", "id", "owner", "copy", F.explode(F.concat("base", "bare")).alias("span")).select(
        "row", "id", "owner", "copy", "span", F.col("span.digest").alias("digest"))
    holder = F.when(F.col("owner").isNull(), F.struct(F.lit(None).cast("string").alias("owner"), "copy")).otherwise(
        F.struct(F.col("owner").cast("string").alias("owner"), F.lit(None).cast("long").alias("copy")))
    frequency = candidates.groupBy("digest").agg(
        F.least(F.count_distinct(F.coalesce(F.col("id").cast("string"), F.concat(F.lit("copy "), "copy"))),
                F.count_distinct("copy")).alias("repositories"),
        F.count_distinct(holder).alias("owners"))
    judged = candidates.join(frequency, "digest").withColumn(
        "live", (F.col("owners") <= OWNERS) & (F.col("repositories") <= REPOSITORIES))
    bare = F.lit(len(BASE))
    verdicts = judged.groupBy("row").agg(
        F.count_if(F.col("live")).alias("n_live"), F.count_if(~F.col("live")).alias("n_example"),
        F.collect_list(F.when(F.col("live") & (F.col("span.rank") == bare), F.col("span"))).alias("added"))
    none = F.lit(0).cast("long")
    return found.join(verdicts, "row", "left").select(
        F.col("id").alias(id_col), *[f"n_{k}" for k in kinds], "base_sha256",
        _listed(F.concat("base", F.coalesce("added", F.array().cast(SPAN)))).alias("spans"),
        F.coalesce("n_live", none).alias("n_live"), F.coalesce("n_example", none).alias("n_example"))
