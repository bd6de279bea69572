"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Words are runs of letters and digits in lower case, so case and punctuation do not matter. Shingles are runs of five
words; an item of one to four words is one shingle, and so are the windows it is compared with. An item's window
has as many words as the item. A window of w shingles that reaches SIMILARITY with an item of s shares at least
SIMILARITY (w + s) / (1 + SIMILARITY) places with it. So of all windows of an item's length, wherever they begin, those are
taken in which so many places hold shingles of items of this length, at whatever place of the item.

Each window and item gets a 64-bit SimHash of its shingles. The fingerprint has 8 blocks of 8 bits; of two
fingerprints that differ in at most 23 bits, one block differs in at most 2, so items are entered under
all values within 2 bits of each block, and a window looks up its own 8: no pair within
23 bits is missed. A pair at similarity 0.8 differs in about 10 bits. Candidates of the same
length and within the radius are verified: the weighted Jaccard similarity of the shingles, each
counted as often as it occurs, has to reach SIMILARITY.

A window that would reach over an end of its document is moved inside; a document shorter than an item is one window.
Null and empty texts have no shingles and match nothing, on either side. Rows with a null id are compared like others. Rows of one doc_id
with different texts are compared each by itself. Only built-in functions are used. What is broadcast, if anything, the engine decides by size; the filter of item shingles has a fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm import bloom
from loadkeeper.llm.shared import cut, folded_words, shingle_hashes

WIDTH, SIMILARITY = 5, 0.8
BLOCKS, FLIPS = 8, 2
BLOCK_BITS = 64 // BLOCKS
#: Fingerprints at most this far apart always share a block up to FLIPS bits.
RADIUS = BLOCKS * (FLIPS + 1) - 1


def simhash(hashes: Column) -> Column:
    """bigint: the bits set in over half of the hashes; 0 without any."""

    def bit(out: Column, place: Column) -> Column:
        ones = F.size(F.filter(hashes, lambda h: F.call_function("shiftright", h, place).bitwiseAND(1) == 1))
        return F.when(2 * ones > F.size(hashes), out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))).otherwise(out)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), bit)


def weighted_jaccard(one: Column, other: Column) -> Column:
    """double: the shingles of both, each as often as in the poorer one, to those of either, as in the richer one."""
    times = lambda a, x: F.size(F.filter(a, lambda y: y == x))
    shared = F.aggregate(F.array_intersect(one, other), F.lit(0), lambda n, x: n + F.least(times(one, x), times(other, x)))
    return shared / (F.size(one) + F.size(other) - shared)


def _block(fingerprint: Column, number: int) -> Column:
    return F.shiftrightunsigned(fingerprint, number * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1)


def _near_values(value: Column) -> Column:
    """All block values within FLIPS bits of one."""
    near = [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= FLIPS]
    return F.array(*(value.bitwiseXOR(F.lit(m).cast("bigint")) for m in near))


def _starts(places: Column, total: Column, size: Column) -> Column:
    """array<int>: where windows of ``size`` shingles begin that hold enough of some ascending places to reach SIMILARITY."""
    window = F.least(size, total)
    enough = F.ceil(SIMILARITY / (1 + SIMILARITY) * (window + size) - 1e-9).cast("int")

    def begins(j: Column) -> Column:
        # windows with the places from j - enough + 1 to j in them, less those of the places one before
        low = F.greatest(F.lit(0), F.get(places, j) - window + 1, F.get(places, j - enough) + 1)
        high = F.least(F.get(places, j - enough + 1), total - window)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    ends = F.when(F.size(places) >= enough, F.sequence(enough - 1, F.size(places) - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(ends, begins))


def _windows(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, start, n, window): the windows of docs(doc_id, text) that hold enough shingles of items of n words."""
    grams = items.select("n", F.explode("hashes").alias("h")).distinct()
    held = bloom.build(grams, "h")
    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    hashes = shingle_hashes(folded_words(F.col("text")), width).alias("hashes")
    hashed = rows.select("doc_id", "row", hashes)
    found = hashed.select("doc_id", "row", F.size("hashes").alias("total"), F.posexplode("hashes").alias("place", "h"))
    met = found.filter(bloom.may_hold(held, F.col("h"))).join(grams, "h")
    places = met.groupBy("doc_id", "row", "n", "total").agg(F.sort_array(F.collect_set("place")).alias("places"))
    size = F.col("n") - (width - 1)
    taken = places.select("doc_id", "row", "n", _starts(F.col("places"), F.col("total"), size).alias("starts"))
    taken = cut(taken.filter(F.size("starts") > 0))
    # few documents are left, whose words are cut again instead of being carried along
    texts = rows.filter(bloom.may_hold(bloom.build(taken, "row"), F.col("row"))).groupBy("row").agg(F.first("text").alias("text"))
    open_ = taken.join(texts.select("row", hashes), "row")
    begun = open_.select("doc_id", "row", "n", "hashes", F.explode("starts").alias("start"))
    return begun.select("doc_id", "row", "n", "start", F.slice("hashes", F.col("start") + 1, size).alias("window"))


def _matches(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words, distance) for items(item_id, n, hashes, fp) of one shingle width."""
    windows = cut(_windows(docs, items, width)).withColumn("fp", simhash(F.col("window")))
    blocks = lambda c: F.array(*(F.struct(F.lit(b).alias("block"), _block(c, b).alias("value")) for b in range(BLOCKS)))
    looked = windows.withColumn("at", F.explode(blocks(F.col("fp")))).select("*", "at.block", "at.value").drop("at")
    entered = items.select("item_id", F.col("n").alias("item_n"), F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"))).alias("at"))
    entered = entered.select("item_id", "item_n", "item_fp", F.col("at.block").alias("item_block"), F.explode(_near_values(F.col("at.value"))).alias("item_value"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    same = (F.col("n") == F.col("item_n")) & (F.col("block") == F.col("item_block")) & (F.col("value") == F.col("item_value"))
    pairs = looked.join(entered, same & (distance <= RADIUS)).withColumn("distance", distance)
    earlier = F.lit(False)
    for b in range(BLOCKS):
        earlier = earlier | (F.col("block") > b) & (F.bit_count(_block(F.col("fp"), b).bitwiseXOR(_block(F.col("item_fp"), b))) <= FLIPS)
    pairs = pairs.filter(~earlier).select("doc_id", "item_id", "item_fp", "start", "n", "window", "distance")
    wanted = items.select(F.col("item_id").alias("wanted_id"), F.col("n").alias("wanted_n"), F.col("fp").alias("wanted_fp"), "hashes").distinct()
    same = F.col("item_id").eqNullSafe(F.col("wanted_id")) & (F.col("n") == F.col("wanted_n")) & (F.col("item_fp") == F.col("wanted_fp"))
    exact = pairs.join(wanted, same).withColumn("similarity", weighted_jaccard(F.col("window"), F.col("hashes")))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n", "distance")).alias("best")
    rows = exact.filter(F.col("similarity") >= SIMILARITY).groupBy("doc_id", "item_id").agg(best)
    return rows.select("doc_id", "item_id", "best.similarity", (-F.col("best.before")).alias("start"), F.col("best.n").alias("n_words"), "best.distance")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words, distance): the items of benchmark(item_id, text) that docs(doc_id, text) hold.

    One row for a document and an item, with the most similar window; ``start`` counts words, the earliest of equals.
    """
    words = benchmark.select("item_id", folded_words(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    widths = F.array_sort(F.collect_set(F.least("n", F.lit(WIDTH))))
    found = None
    for width in words.filter("n > 0").agg(widths).first()[0] or [WIDTH]:
        own = words.filter(F.col("n") == width if width < WIDTH else F.col("n") >= width)
        hashed = own.select("item_id", "n", shingle_hashes(F.col("words"), width).alias("hashes"))
        rows = _matches(docs.select("doc_id", "text"), cut(hashed.withColumn("fp", simhash(F.col("hashes")))), width)
        found = rows if found is None else found.unionByName(rows)
    return found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs(doc_id, text, ...) that hold no benchmark item. Rows without a doc_id stay."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
