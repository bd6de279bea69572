"""Document fingerprints: bottom-k sketches of shingle hashes, from built-in functions only.

A sketch is the sorted array of the ``size`` smallest distinct 64-bit hashes of a text's shingles:
runs of five words, A-Z folded; a text of one to four words has its whole sequence as its only
shingle; a null or blank text has none, and its sketch is empty. Sketches of parts merge to the
sketch of the whole, so a collection can be sketched part by part.

Resemblance and containment are estimated on the k smallest hashes of the union, a uniform sample of
the united shingles; with fewer shingles than the sketch holds they are exact. Two empty sketches
resemble each other fully, an empty and a full one not at all; an empty one is contained in any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkeeper.llm.shared import cut, lower_ascii, shingle_hashes, words_of

SIZE, WIDTH = 128, 5
#: Ids of one window task; levels of windows over windows, each over as many of the level below.
SPAN_BITS, LEVELS = 14, 3
NULL_KEY = -(2**63)


def sketch(text: Column, size: int = SIZE, width: int = WIDTH) -> Column:
    """array<bigint>: the bottom-k sketch of a text."""
    hashes = shingle_hashes(words_of(lower_ascii(text)), width)
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def merge(one: Column, other: Column, size: int = SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(one, other)), 1, size)


def merge_groups(parts: DataFrame, group: str, column: str, size: int = SIZE) -> DataFrame:
    """(group, sketch): one sketch for all parts of a group, of any number.

    Hashes are made distinct and then ranked; a task passes on at most ``size`` of a group, so a
    group with a third of all parts is no larger than another one when it meets. A group whose parts
    are all empty or null has an empty sketch; null is a group like any other.
    """
    rows = parts.select(F.col(group).alias("_group"), F.explode_outer(column).alias("_hash"))
    ranked = Window.partitionBy("_group").orderBy(F.col("_hash").asc_nulls_last())
    least = rows.distinct().withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= size)
    joined = least.groupBy("_group").agg(F.sort_array(F.collect_list("_hash")).alias("sketch"))
    return joined.withColumnRenamed("_group", group)


def resemblance(one: Column, other: Column, size: int = SIZE) -> Column:
    """double, 0 to 1: shared shingles to shingles of either."""
    union = merge(one, other, size)
    shared = F.size(F.array_intersect(union, F.array_intersect(one, other)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def containment(one: Column, other: Column, size: int = SIZE) -> Column:
    """double, 0 to 1: shared shingles to the shingles of ``one``."""
    union = merge(one, other, size)
    own = F.size(F.array_intersect(union, one))
    shared = F.size(F.array_intersect(union, F.array_intersect(one, other)))
    return F.when(F.size(one) == 0, F.lit(1.0)).when(own == 0, F.lit(0.0)).otherwise(shared / own)


def distinct_shingles(one: Column, size: int = SIZE) -> Column:
    """double: the number of distinct shingles; exact below the sketch's size."""
    share = (F.element_at(one, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(one) < size, F.size(one).cast("double")).otherwise((size - 1) / share)


def _followed(nodes: DataFrame, span: Column, at: Column, level: int) -> DataFrame:
    """nodes(at, ...) with ``next``: the least ``at`` of a later node; null for the last of all.

    Windows run within spans of ids. The last node of a span is followed by the first of the next
    span that has nodes; finding that is the same task over far fewer rows.
    """
    if level == 0:
        return nodes.withColumn("next", F.lead(at).over(Window.orderBy(at)))
    spans = nodes.withColumn("_span", span)
    inner = spans.withColumn("next", F.lead(at).over(Window.partitionBy("_span").orderBy(at)))
    firsts = spans.groupBy("_span").agg(F.min(at).alias("_first"))
    names = firsts.select(F.struct("_span", "_first").alias("_at"))
    coarser = F.shiftright(F.col("_at._span"), SPAN_BITS)
    after = _followed(names, coarser, F.col("_at"), level - 1).select(
        F.col("_at._span").alias("_span"), F.col("next._first").alias("_after")
    )
    return inner.join(after, "_span", "left").withColumn("next", F.coalesce("next", "_after")).drop("_span", "_after")


def successors(nodes: DataFrame) -> DataFrame:
    """(at, next): every distinct ``at``, a struct whose first field ``key`` is a long, and its successor; the last has the first."""
    nodes = nodes.select("at")
    linked = _followed(nodes, F.shiftright(F.col("at.key"), SPAN_BITS), F.col("at"), LEVELS)
    return linked.withColumn("next", F.coalesce("next", nodes.agg(F.min("at")).scalar()))


def edited(docs: DataFrame) -> DataFrame:
    """(doc_id, text, edited, next_sketch) for every row of docs(doc_id, text).

    ``edited`` is the text with the last floor(n / 2) of its n code points replaced by as many from
    the start of the next document, ascending doc_id, the last being followed by the first. A null
    doc_id comes before all others. Rows of one doc_id follow each other in the order of their
    text's hash; equal rows count as one document there and each get their own result row. A null
    text is an empty one. A single document follows itself.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("key"), text.alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    # used twice with the same columns, so the texts are shuffled once
    unique = rows.groupBy("key", "h").agg(F.first("text").alias("text"))
    times = rows.groupBy("key", "h").agg(F.count("*").alias("n"))
    nodes = rows.select("key", "h", F.floor(F.char_length("text") / 2).cast("int").alias("half")).distinct()
    nodes = cut(nodes.select(F.struct("key", "h", "half").alias("at")))
    links = successors(nodes).select(
        F.col("at.key").alias("of_key"), F.col("at.h").alias("of_h"), F.col("at.half").alias("half"),
        F.col("next.key").alias("key"), F.col("next.h").alias("h"),
    )
    starts = unique.join(links, ["key", "h"]).select(
        F.col("of_key").alias("key"), F.col("of_h").alias("h"),
        F.substring("text", F.lit(1), F.col("half")).alias("start"), sketch(F.col("text")).alias("next_sketch"),
    )
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.char_length("text") - half)
    whole = unique.join(starts, ["key", "h"]).join(times, ["key", "h"]).withColumn("edited", F.concat(kept, "start"))
    copies = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    doc_id = F.when(F.col("key") != NULL_KEY, F.col("key"))
    return copies.select(doc_id.alias("doc_id"), "text", "edited", "next_sketch")


def as_text(column: Column) -> Column:
    """A sketch as text: its hashes in order, separated by commas."""
    return F.array_join(column.cast("array<string>"), ",")
