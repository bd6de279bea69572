"""SimHash near-duplicates: 64-bit fingerprints, candidates by pigeonring filtering, then the Hamming check.

A text's words lie between white space, with A-Z in lower case. Its shingles are all runs of
``width`` words, repeats included; fewer words give the whole sequence as the only one. A bit of the
fingerprint is 1 if it is set in over half the shingles' hashes (XXH64, seed 42). A text without
words, null texts among them, has the fingerprint 0, which links like any other.

Two fingerprints link if they differ in at most r bits. Cut into m = 2r + 1 segments on a ring, such a
pair has a segment from which every chain of l consecutive segments has at most l * r / m differing
bits (rounded down). So the first two segments of that chain are equal, and the next two differ in one bit
at most: one of them is equal as well. Equal values of these three segments are the join key, 2 m keys for a
fingerprint; the budgets of all longer chains are tested on the pairs that meet, the whole ring last.

Copies are one fingerprint from the start. A fingerprint has a bounded number of others within r
bits, so links grow with the fingerprints even inside a group of near copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm.components import components
from loadkeeper.llm.shared import cut

WIDTH, DISTANCE, BITS = 3, 2, 64
#: Hashes whose bits are counted at a time; bounds the memory for a very long text.
CHUNK = 16_384


def _majority(hashes: Iterator[int], n: int) -> int:
    """The bits set in over half of n hashes, as a signed 64-bit number."""
    values = np.fromiter(hashes, np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, CHUNK):
        part = values[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """bigint: the SimHash of a text."""

    @F.arrow_udf("bigint")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from xxhash import xxh64_intdigest

        hashed = partial(xxh64_intdigest, seed=42)
        for texts in batches:
            out = []
            for t in texts.cast(pa.binary()):
                words = (t.as_py() or b"").lower().split()
                if len(words) <= width:
                    out.append(_majority(map(hashed, [b" ".join(words)]), 1) if words else 0)
                else:
                    runs = zip(*(words[i:] for i in range(width)))
                    out.append(_majority(map(hashed, map(b" ".join, runs)), len(words) - width + 1))
            yield pa.array(out, pa.int64())

    return simhash(text)


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the 2 r + 1 segments."""
    m = 2 * distance + 1
    ends = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _mask(part: list[tuple[int, int]]) -> int:
    """The bits of some segments, as a signed number."""
    bits = sum((1 << width) - 1 << first for first, width in part)
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _chains_hold(one: Column, other: Column, start: Column, distance: int) -> Column:
    """Whether every chain from segment ``start`` on stays within its budget."""
    ring = segments(distance)
    m, differing, out = len(ring), one.bitwiseXOR(other), F.lit(False)
    for i in range(m):
        chain = [ring[(i + k) % m] for k in range(m)]
        held = [F.bit_count(differing.bitwiseAND(F.lit(_mask(chain[:n])))) <= n * distance // m for n in range(3, m + 1)]
        out = F.when(start == i, reduce(Column.__and__, held)).otherwise(out)
    return out


def _keys(fingerprint: Column, distance: int) -> Column:
    """array<struct<start, key>>: for each ring position, the values that a linked fingerprint shares."""
    ring = segments(distance)
    m, out = len(ring), []
    for i in range(m):
        for k in (2, 3) if m > 3 else ():
            out.append((i, k, _mask([ring[i], ring[(i + 1) % m], ring[(i + k) % m]])))
        if m <= 3:
            out.append((i, 1, _mask([ring[i], ring[(i + 1) % m]])))
    return F.array(*(F.struct(F.lit(i).alias("start"), F.lit(k).alias("kind"), fingerprint.bitwiseAND(F.lit(mask)).alias("key")) for i, k, mask in out))


def links(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): the pairs of distinct values of fingerprints(fp) that differ in 1 to ``distance`` bits, a < b."""
    if not 0 <= distance <= 15:
        raise ValueError("distance: 0 to 15")
    if distance == 0:
        return fingerprints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    rows = fingerprints.select("fp", F.explode(_keys(F.col("fp"), distance)).alias("at")).select("fp", "at.*")
    one, other = rows.alias("one"), rows.alias("other")
    met = [F.col(f"one.{c}") == F.col(f"other.{c}") for c in ("start", "kind", "key")]
    a, b = F.col("one.fp"), F.col("other.fp")
    near = (a < b) & _chains_hold(a, b, F.col("one.start"), distance)
    return one.join(other, reduce(Column.__and__, [*met, near])).select(a.alias("a"), b.alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs(doc_id, text).

    ``component_id`` is the smallest doc_id that can be reached over links, its own included. Rows
    without a doc_id link like others and never give the id; a component of such rows alone has a
    null one. Repeated rows are copies of each other and stay as many rows. Other columns are not
    read, whatever their names.
    """
    marked = cut(docs.select("doc_id", fingerprint(F.col("text"), width).alias("fp")))
    least = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(least.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    classes = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = cut(classes.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = cut(classes.join(ids, "root").select("fp", "component_id"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(classes, "fp").select("doc_id", shown.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """The documents whose doc_id is their component's: one of each group. Rows without a doc_id all stay."""
    classes = near_duplicates(docs.select("doc_id", "text"), width, distance)
    gone = classes.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
