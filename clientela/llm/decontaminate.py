"""Benchmark decontamination by SimHash windows, in DataFrame operations only.

Items, and windows of a document that are as long as an item, get a 64-bit SimHash of their words.
Fingerprints within RADIUS bits agree on one of RADIUS + 1 blocks of bits at least, so joining on
blocks finds all of them. A block of changed words costs few shingles but many bits, so the windows
of a document that holds enough of an item's shingles are candidates too, however far their
fingerprints are. Candidates are confirmed by the weighted similarity of their shingles. A
window without a shingle of an item cannot be confirmed: windows are laid only where an item's
shingle stands in the text, so that it has its place in the window."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela.llm.store import keep, renamed, small

WORDS = 5            # per shingle
PERCENT = 75         # least similarity
RADIUS = 7           # bits
BLOCK_BITS = 64 // (RADIUS + 1)
ITEM_ROWS = 200_000  # shingles, blocks or ids, a few numbers each, up to which they are broadcast
ITEM_WORDS = 2_000_000  # words of items, 8 bytes each, up to which their hashes are broadcast


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def _shingles(hashes: str, n: int) -> Column:
    """Hash of each n consecutive entries of a column of word hashes."""
    parts = ", ".join(f"get({hashes}, i + {k})" for k in range(n))
    return F.expr(f"IF(size({hashes}) >= {n}, transform(sequence(0, size({hashes}) - {n}), "
                  f"i -> xxhash64({parts})), CAST(array() AS array<bigint>))")


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))


def _simhash(hashes: str) -> Column:
    """Bit b is set where more than half of the word hashes have it."""
    votes = f"aggregate({hashes}, 0, (s, h) -> s + CAST(shiftrightunsigned(h, b) & 1L AS INT))"
    return F.expr(f"aggregate(sequence(0, 63), 0L, (f, b) -> "
                  f"f | IF(2 * {votes} > size({hashes}), shiftleft(1L, b), 0L))")


def _blocks(df: DataFrame) -> DataFrame:
    """A row for each block of the fingerprint."""
    mask = (1 << BLOCK_BITS) - 1
    return df.withColumn("block", F.explode(F.expr(
        f"transform(sequence(0, {RADIUS}), k -> struct(k, shiftrightunsigned(fingerprint, k * {BLOCK_BITS}) & {mask}L AS v))")))


def _similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two lists of shingles: sum of lesser over sum of greater counts."""
    count = lambda xs: f"size(filter({xs}, y -> y = x))"
    both = F.expr(f"aggregate(array_intersect({a}, {b}), 0, (s, x) -> s + least({count(a)}, {count(b)}))")
    return both / (F.size(a) + F.size(b) - both)


def _small(items: DataFrame, hashes: str) -> DataFrame:
    """Stored rows with a broadcast hint if all their lists together are counted to be small."""
    total = items.agg(F.sum(F.size(hashes) + 4)).first()[0] or 0
    return F.broadcast(items) if total <= ITEM_WORDS else items


def _counted(cut: DataFrame, hits: DataFrame, seeds: DataFrame, known: DataFrame) -> DataFrame:
    """Windows of the documents that hold at least PERCENT of an item's shingles, each as often as
    the item does: the similarity is at most the share of the item that the document holds. Nor can
    it be over the lesser number of shingles by the greater."""
    own = seeds.groupBy("mark", "k", "shingle").agg(F.count("*").alias("wanted"))
    held = hits.groupBy("id", "k", "shingle").agg(F.count("*").alias("there"))
    shared = (held.join(small(own, ITEM_ROWS), ["k", "shingle"]).groupBy("id", "mark")
              .agg(F.sum(F.least("wanted", "there")).alias("joint")))
    most = F.col("n") - F.col("k") + 1
    pairs = (shared.join(_small(known.select("mark", "item", "n", "k", F.col("hashes").alias("own")), "own"), "mark")
             .where(100 * F.col("joint") >= PERCENT * most))
    there = F.size("hashes") - F.col("k") + 1
    return (cut.select("id", "start", "hashes").join(pairs, "id")
            .where((100 * there >= PERCENT * most) & (100 * most >= PERCENT * there))
            .select("id", "start", "hashes", "item", "k", "own"))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item of which a window is found in it: id, item, start (word of
    the text, from 0), n_words, similarity of the best window, the earliest among equals.

    Words are runs outside white space (0x20, 0x09-0x0D), lower-cased; an item of fewer than 5
    words is one shingle. Null and empty texts and items match nothing; rows without an id are
    left out. Where an id repeats, the windows of all its texts count. In a text shorter than an
    item the window is the whole text. Every laid window is found whose shingles are similar
    enough, by its fingerprint or by the count of the item's shingles in its document."""
    docs = renamed(docs, id_col, text_col).where("id IS NOT NULL")
    known = (renamed(items, item_col, item_text).select(F.col("id").alias("item"), _words(F.col("text")).alias("words"))
             .where("size(words) > 0").select("item", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
             .withColumn("n", F.size("hashes")).withColumn("k", F.least("n", F.lit(WORDS))))
    known = keep(known.distinct().withColumn("mark", F.monotonically_increasing_id()), "items")
    lengths = [r.k for r in known.select("k").distinct().collect()]  # at most WORDS values

    hashed = _hashed(docs)
    seeds = hits = None
    for k in lengths or [WORDS]:
        own = (known.where(F.col("k") == k)
               .select("mark", "n", "k", F.posexplode(_shingles("hashes", k)).alias("offset", "shingle")))
        places = hashed.select("id", F.size("hashes").alias("length"), F.lit(k).alias("k"),
                               F.posexplode(_shingles("hashes", k)).alias("pos", "shingle"))
        held = places.join(small(own.select("shingle").distinct(), ITEM_ROWS), "shingle", "left_semi")
        seeds, hits = (own, held) if hits is None else (seeds.union(own), hits.union(held))
    seeds, hits = keep(seeds, "seeds"), keep(hits, "hits")
    windows = hits.join(small(seeds.select("n", "k", "offset", "shingle").distinct(), ITEM_ROWS), ["k", "shingle"]).select(
        "id", "n", F.greatest(F.lit(0), F.least(F.col("pos") - F.col("offset"), F.col("length") - F.col("n"))).alias("start"))
    windows = keep(windows.distinct(), "windows")

    held = small(keep(windows.select("id").distinct(), "held"), ITEM_ROWS)  # only their texts are split again
    cut = (_hashed(docs.join(held, "id", "left_semi")).join(windows, "id")
           .select("id", "start", F.slice("hashes", F.col("start") + 1, F.col("n")).alias("hashes")))
    cut = keep(cut.withColumn("fingerprint", _simhash("hashes")), "fingerprints")
    marked = keep(known.withColumn("fingerprint", _simhash("hashes")), "marked")
    near = (_blocks(cut.select("id", "start", "hashes", "fingerprint"))
            .join(small(_blocks(marked).select("mark", "block", F.col("fingerprint").alias("other")), ITEM_ROWS), "block")
            .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= RADIUS)
            .join(_small(known.select("mark", "item", "k", F.col("hashes").alias("own")), "own"), "mark")
            .drop("mark", "block", "fingerprint", "other"))
    near = near.unionByName(_counted(cut, hits, seeds, known)).distinct()
    sides = near.select("id", "item", "start", F.size("hashes").alias("n_words"),
                        F.expr(_per_length("hashes")).alias("a"), F.expr(_per_length("own")).alias("b"))
    good = sides.withColumn("similarity", _similarity("a", "b")).where(100 * F.col("similarity") >= PERCENT)
    best = good.groupBy("id", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("best.back")).alias("start"),
                       F.col("best.n_words").alias("n_words"), F.col("best.similarity").alias("similarity"))


def _per_length(hashes: str) -> str:
    """Shingles of an item's own length: WORDS words, or all of a shorter item."""
    cases = []
    for k in range(1, WORDS + 1):
        parts = ", ".join(f"get({hashes}, i + {j})" for j in range(k))
        cases.append(f"WHEN k = {k} THEN IF(size({hashes}) >= {k}, transform(sequence(0, size({hashes}) - {k}), "
                     f"i -> xxhash64({parts})), CAST(array() AS array<bigint>))")
    return f"CASE {' '.join(cases)} END"
