"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame functions.

1. Anchors. A window is similar to an item only if they share a shingle, so windows are
   taken only where a text holds a shingle of the benchmark: each such place, less the
   shingle's place in an item, is the start of one window as long as that item.
2. Fingerprints. Every distinct window and item gets a 64-bit SimHash of its weighted
   shingles. A shingle of n items weighs 1 / n, others weigh 1. The print takes square
   roots, so that its cosine is of the weights themselves: at a weighted Jaccard
   similarity of 0.75 it is at least 6/7, whatever the weights.
3. Search. A window meets the items of its length within RADIUS differing bits: the 64
   bits are four blocks, two fingerprints within 19 bits agree in one block but for 4
   bits, and every item is entered under all 2,517 values that close to each of its
   blocks. So the equi-join misses nothing within the radius. The radius itself is
   probable, not certain: in simulations with random
   prints and weights of 1, 1 / 2 and 1 / 10, under 1 % of pairs right at 0.75 lay outside.
4. Verification. Candidates stay where the exact weighted Jaccard similarity of the
   shingles reaches the threshold.

Texts are exploded into shingles where they lie and meet the benchmark there; what is
shuffled is what hits. The benchmark's shingles are broadcast only up to a counted
number of rows; beyond it they are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import perhaps_among
from affinia.sources.workspace import staged

WIDTH = 5
SIMILARITY = 0.75
RADIUS = 19
BLOCKS = 4
BLOCK_BITS = 16
#: Most rows (24 bytes each) of the benchmark's shingles that are broadcast.
MOST_BROADCAST = 1 << 20
BLANK = r"\x20\x09-\x0D"


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words of a text, in order."""
    trimmed = F.regexp_replace(F.lower(text), f"^[{BLANK}]+|[{BLANK}]+$", "")
    words = F.split(trimmed, f"[{BLANK}]+")
    return F.when(F.char_length(trimmed) > 0, F.transform(words, lambda w: F.xxhash64(w))).otherwise(
        F.array().cast("array<bigint>")
    )


def grams(words: str, width: int) -> Column:
    """Fingerprints of all runs of ``width`` words, given the column of word hashes."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(width))
    return F.expr(
        f"CASE WHEN size({words}) >= {width} THEN transform(sequence(0, size({words}) - {width}),"
        f" i -> xxhash64({parts})) ELSE array() END"
    )


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, length, width and distinct shingles of every item that has words."""
    rows = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id"), word_hashes(F.col("text")).alias("words")
    )
    made = None
    for width in range(1, WIDTH + 1):
        own = F.size("words") >= WIDTH if width == WIDTH else F.size("words") == width
        part = rows.where(own).select(
            "item_id", F.size("words").alias("length"), F.lit(width).alias("width"), grams("words", width).alias("grams")
        )
        made = part if made is None else made.unionByName(part)
    return made


def _hits(texts: DataFrame, items: DataFrame) -> DataFrame:
    """version, start, length, width of every window that an anchor asks for."""
    places = staged(
        items.select("length", "width", F.posexplode("grams").alias("before", "gram")).distinct(), "anchors"
    )
    found = None
    few = places.count() <= MOST_BROADCAST
    for width in sorted(r["width"] for r in places.select("width").distinct().collect()):  # at most WIDTH
        own = places.where(F.col("width") == width)
        rows = texts.select(
            "version", F.size("words").alias("size"), F.posexplode(grams("words", width)).alias("place", "gram")
        )
        met = rows.join(F.broadcast(own) if few else own, "gram")
        start = F.greatest(F.lit(0), F.least(F.col("place") - F.col("before"), F.col("size") - F.col("length")))
        part = met.select("version", start.alias("start"), "length", "width")
        found = part if found is None else found.unionByName(part)
    return None if found is None else found.distinct()


def simhash(weighted: str) -> Column:
    """64-bit SimHash of a column of (gram, weight) structs, by the roots of the weights."""
    roots = f"transform({weighted}, s -> struct(s.gram AS gram, sqrt(s.weight) AS root))"
    tally = "aggregate(roots, 0D, (t, s) -> t + IF((shiftright(s.gram, b) & 1L) = 1L, s.root, -s.root))"
    bits = f"transform(sequence(0, 63), b -> IF({tally} > 0, shiftleft(1L, b), 0L))"
    return F.expr(f"element_at(transform(array({roots}), roots -> aggregate({bits}, 0L, (t, x) -> t | x)), 1)")


def _weighted(rows: DataFrame, key: str, weights: DataFrame) -> DataFrame:
    """Rows with ``weighted``: their distinct shingles as (gram, weight), and the print."""
    single = rows.select(key, F.explode(F.array_distinct("grams")).alias("gram"))
    met = single.join(weights, "gram", "left").select(
        key, F.struct("gram", F.coalesce("weight", F.lit(1.0)).alias("weight")).alias("one")
    )
    grouped = met.groupBy(key).agg(F.sort_array(F.collect_list("one")).alias("weighted"))
    return grouped.withColumn("print", simhash("weighted"))


def _block(number: int, bits: str = "print") -> Column:
    return F.expr(f"shiftrightunsigned({bits}, {number * BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1}L")


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of equal length whose prints differ in at most RADIUS bits; none is missed."""
    near = F.expr(
        f"filter(sequence(0L, {(1 << BLOCK_BITS) - 1}L), x -> bit_count(x) <= {RADIUS // BLOCKS})"
    )
    blocks = F.explode(F.array(*[F.struct(F.lit(b).alias("block"), _block(b).alias("value")) for b in range(BLOCKS)]))
    entered = items.select("item_id", "length", F.col("print").alias("item_print"), blocks.alias("at"))
    entered = entered.select("item_id", "length", "item_print", "at.block", "at.value", F.explode(near).alias("change"))
    entered = entered.withColumn("value", F.col("value").bitwiseXOR(F.col("change"))).drop("change")
    asked = windows.select("window", "length", "print", blocks.alias("at")).select(
        "window", "length", "print", "at.block", "at.value"
    )
    # The planner sees the items before they are entered 10,068 times, so it is told to shuffle.
    met = asked.join(entered.hint("merge"), ["length", "block", "value"])
    close = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS
    return met.where(close).select("window", "item_id").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """``version, item_id, similarity, start``: texts that hold a benchmark item.

    ``version`` is the fingerprint of a text, ``start`` the word where the most similar
    window begins. An item of fewer than five words is one shingle and is found where
    all its words stand in a row. Missing or empty texts and items hold nothing and are
    found nowhere; empty tables give an empty result.
    """
    empty = "version long, item_id long, similarity double, start int"
    items = staged(_items(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()), "items")
    texts = docs.where("text is not null").select(F.col("text").cast("string"))
    texts = texts.select(F.xxhash64("text").alias("version"), "text")
    hits = _hits(texts.select("version", word_hashes(F.col("text")).alias("words")), items)
    if hits is None:
        return docs.sparkSession.createDataFrame([], empty)
    hits = staged(hits, "hits")
    starts = hits.groupBy("version").agg(F.collect_set(F.struct("start", "length", "width")).alias("asked"))
    held = perhaps_among(texts, hits, "version").groupBy("version").agg(F.min("text").alias("text"))
    held = held.join(starts, "version").select("version", "asked", word_hashes(F.col("text")).alias("words"))
    cut = held.select("version", "words", F.explode("asked").alias("asked")).select(
        "version", "asked.*", F.expr("slice(words, asked.start + 1, asked.length)").alias("part")
    )
    cut = cut.withColumn("grams", F.lit(None).cast("array<bigint>"))
    for width in range(1, WIDTH + 1):
        cut = cut.withColumn("grams", F.when(F.col("width") == width, grams("part", width)).otherwise(F.col("grams")))
    windows = staged(
        cut.select("version", "start", "length", F.xxhash64("grams", "length").alias("window"), "grams"), "windows"
    )
    weights = items.select("item_id", F.explode(F.array_distinct("grams")).alias("gram"))
    weights = weights.groupBy("gram").agg((1 / F.countDistinct("item_id")).alias("weight"))
    distinct = windows.groupBy("window").agg(F.first("grams").alias("grams"), F.first("length").alias("length"))
    window_prints = staged(
        _weighted(distinct, "window", weights).join(distinct.select("window", "length"), "window"), "prints"
    )
    item_prints = staged(
        _weighted(items, "item_id", weights).join(items.select("item_id", "length"), "item_id"), "prints"
    )
    pairs = within_radius(window_prints, item_prints)
    met = pairs.join(window_prints.select("window", F.col("weighted").alias("x")), "window").join(
        item_prints.select("item_id", F.col("weighted").alias("y")), "item_id"
    )
    total = "aggregate({}, 0D, (t, s) -> t + s.weight)"
    scored = met.select(
        "window", "item_id",
        F.expr(total.format("array_intersect(x, y)")).alias("common"),
        (F.expr(total.format("x")) + F.expr(total.format("y"))).alias("both"),
    ).withColumn("similarity", F.col("common") / (F.col("both") - F.col("common")))
    similar = scored.where(F.col("similarity") >= similarity - 1e-12).select("window", "item_id", "similarity")
    placed = windows.select("version", "start", "window").join(similar, "window")
    return staged(
        placed.groupBy("version", "item_id").agg(
            F.max("similarity").alias("similarity"),
            F.min_by("start", F.struct(-F.col("similarity"), F.col("start"))).alias("start"),
        ),
        "leaks",
    )


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, start``, one row per document and item it holds.

    Repeated rows of one doc_id and text give one row; rows without doc_id are not
    reported. Other columns are not looked at.
    """
    named = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("version")
    )
    met = named.join(leaks(docs, benchmark), "version")
    return met.groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"), F.min_by("start", -F.col("similarity")).alias("start")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, columns unchanged."""
    found = leaks(docs, benchmark).select(F.col("version").alias("leak_version_")).distinct()
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(staged(found, "versions"), own == F.col("leak_version_"), "left_anti")
