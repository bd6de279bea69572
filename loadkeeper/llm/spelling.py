"""Spelling variants: words one inserted, deleted or replaced code point apart, found by dense prefix-suffix tiling.

Two words are near if the length of their common prefix plus that of their common suffix reaches the longer
length minus one: then exactly one edit lies between. Such words share either the first half of the longer length
or the rest at the end, so every word enters four buckets: by its first code points and by its last, once as the longer
word and once as the shorter by one. A bucket's words are laid out as padded matrices of code points, and every
block of them is compared with every block as one dense tile. A large bucket is cut into blocks by hash; each
pair of blocks is a tile of its own, so no task holds a bucket. A tile passes on, for each word, how
many near words it has there and the commonest of them, never the pairs.

Words are the maximal runs of letters, in lower case A-Z, of at least LEAST_LENGTH code points and LEAST_COUNT occurrences. A word's
form is the commonest of its near words (of equal ones the first in code-point order) if that is at
least RATIO times as common; its root is the end of the chain of forms.

Null texts and texts without letters have no words, rows without a doc_id count as if it were empty, and repeated rows count
each. Input columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm.shared import cut, lower_ascii

#: The letters of a run once A-Z are in lower case.
LETTERS = "a-z\\u00C0-\\u00FF"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: Of the occurrences of a word one in so many loses a code point, as contracted.
SPOILED = 31
#: The most words and the most code points a block of a bucket is meant to hold, and rows that small tiles are compared together in.
BLOCK, CELLS, TOGETHER = 512, 1 << 15, 128
#: Tiles of one bucket key are spread over so many partitions when its blocks are looked up.
SALTS = 32
FOUND = "word string, n bigint, n_near bigint, best_n bigint, best string"


def spoiled(run: Column, doc_id: Column) -> Column:
    """The run as it counts: where SPOILED divides the checksum of ``<doc_id>:<run>``, one code point is cut out."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(check, F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(check % SPOILED == 0, shorter).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct words of the texts that are long and frequent enough, with their occurrences."""
    runs = F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(f"[{LETTERS}]+"), F.lit(0))
    long = F.filter(runs, lambda r: F.char_length(r) >= LEAST_LENGTH)
    counted = docs.select("doc_id", F.explode(long).alias("run")).select(spoiled(F.col("run"), F.col("doc_id")).alias("word"))
    words = counted.filter(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return words.filter(F.col("n") >= LEAST_COUNT)


def matrices(words: list[str], width: int, filler: int) -> tuple[np.ndarray, np.ndarray]:
    """The code points of some words, one column per word: aligned at their starts, and at their ends turned round."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ahead = np.full((width, len(words)), filler, np.int32)
    back = ahead.copy()
    ahead[place, owner] = points
    back[lengths[owner] - 1 - place, owner] = points
    return ahead, back


def common(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many leading rows two matrices share, for each column of the one and each of the other."""
    same = np.ones((one.shape[1], other.shape[1]), bool)
    length = np.zeros(same.shape, np.int32)
    for row, column in zip(one, other):
        same &= row[:, None] == column[None, :]
        if not same.any():
            break
        length += same
    return length


def near(left: list[str], right: list[str], longest: int, by_end: bool) -> np.ndarray:
    """Which words of the one list are a single edit from which of the other, if the longer has ``longest`` code points.

    Pairs that meet by their first half are left out of the buckets by the end, so each pair is found once.
    """
    ahead, back = matrices(left, longest, -1)
    other, other_back = matrices(right, longest, -2)
    prefix = common(ahead, other)
    sizes, other_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))
    found = np.maximum(sizes[:, None], other_sizes[None, :]) == longest
    found &= (prefix < longest // 2) == by_end
    found &= (prefix < sizes[:, None]) | (sizes[:, None] != other_sizes[None, :])  # not the word itself
    if not found.any():
        return found
    return found & (prefix + common(back, other_back) >= longest - 1)


def keyed(words: DataFrame) -> DataFrame:
    """The words in their buckets: longest bigint, by_end boolean, key bigint, word, n."""
    size = F.char_length("word")

    def buckets(longest: Column) -> list[Column]:
        half = F.floor(longest / 2).cast("int")
        start, end = F.substring("word", F.lit(1), half), F.substring("word", size - (longest - half) + 1, longest - half)
        return [
            F.struct(longest.alias("longest"), F.lit(at_end).alias("by_end"), F.xxhash64(part).alias("key"))
            for at_end, part in ((False, start), (True, end))
        ]

    return words.select("word", "n", F.inline(F.array(*buckets(size), *buckets(size + 1))))


def tiles(words: DataFrame) -> DataFrame:
    """The words of every bucket once per pair of blocks their own belongs to: a, b number the blocks, ``first`` tells which one it is."""
    bucket = ["longest", "by_end", "key"]
    rows = keyed(words)
    size = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(CELLS) / F.col("longest"))))
    counts = rows.groupBy(*bucket).agg(F.count("*").alias("members")).filter("members > 1")
    counts = counts.select(*bucket, F.ceil(F.col("members") / size).alias("blocks"))
    # most buckets are one block; only the others are looked up, each repeated for every salt
    large = counts.filter("blocks > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.hash("word"), F.lit(SALTS))).join(large, [*bucket, "salt"], "left")
    blocks = F.coalesce("blocks", F.lit(1).cast("bigint"))
    own = F.pmod(F.xxhash64("word"), blocks)
    rows = rows.select(*bucket, "word", "n", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("other"))
    return rows.select(
        *bucket, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") <= F.col("other")).alias("first"), "word", "n"
    )


def _best(found: np.ndarray, words: list[str], n: np.ndarray, rank: np.ndarray) -> Iterator[tuple[int, int, int, str]]:
    """Of each row of a matrix of hits: its number, how many hits, and the first of their columns by rank."""
    hits = found.sum(axis=1)
    rows = np.flatnonzero(hits)
    if len(rows):
        ordered = np.argsort(rank, kind="stable")
        first = ordered[found[rows][:, ordered].argmax(axis=1)]
        for row, column in zip(rows.tolist(), first.tolist()):
            yield row, int(hits[row]), int(n[column]), words[column]


def _ranked(words: list[str], n: np.ndarray) -> np.ndarray:
    """The place of each word in the order commonest first, then by code points."""
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    out = np.empty(len(words), np.int64)
    out[order] = np.arange(len(words))
    return out


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles, each one's rows in a row, to FOUND: for each word its near words within a tile, counted, and the commonest."""
    out: list[tuple[str, int, int, int, str]] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 5
        out.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n", "n_near", "best_n", "best"])

    def one(words: list[str], n: list[int], group: np.ndarray, longest: int, by_end: bool) -> None:
        """Small whole buckets side by side: a dense square, in which only members of the same bucket count."""
        counts = np.array(n)
        found = near(words, words, longest, by_end) & (group[:, None] == group[None, :])
        out.extend((words[i], n[i], hits, m, w) for i, hits, m, w in _best(found, words, counts, _ranked(words, counts)))

    def two(left: list[str], ln: list[int], right: list[str], rn: list[int], longest: int, by_end: bool) -> None:
        """One block against another."""
        found, lc, rc = near(left, right, longest, by_end), np.array(ln), np.array(rn)
        out.extend((left[i], ln[i], hits, m, w) for i, hits, m, w in _best(found, right, rc, _ranked(right, rc)))
        out.extend((right[i], rn[i], hits, m, w) for i, hits, m, w in _best(found.T, left, lc, _ranked(left, lc)))

    pack: list[tuple[list[str], list[int]]] = []
    kind: tuple[int, bool] = (0, False)

    def unpack() -> None:
        if pack:
            group = np.repeat(np.arange(len(pack)), [len(w) for w, _ in pack])
            one([x for w, _ in pack for x in w], [x for _, m in pack for x in m], group, *kind)
            pack.clear()

    def tile(name: tuple, rows: list[tuple[bool, str, int]]) -> None:
        nonlocal kind
        longest, by_end, _, a, b = name
        if len(rows) < 2:
            return
        if a != b:
            sides = [([w for f, w, _ in rows if f == side], [m for f, _, m in rows if f == side]) for side in (True, False)]
            if sides[0][0] and sides[1][0]:
                two(*sides[0], *sides[1], longest, by_end)
            return
        held = sum(len(w) for w, _ in pack)
        if kind != (longest, by_end) or held + len(rows) > TOGETHER or (held + len(rows)) * longest > CELLS:
            unpack()
        kind = (longest, by_end)
        pack.append(([w for _, w, _ in rows], [m for *_, m in rows]))

    name, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for longest, by_end, key, a, b, first, word, n in zip(*columns):
            if name != (longest, by_end, key, a, b):
                if name is not None:
                    tile(name, rows)
                name, rows = (longest, by_end, key, a, b), []
            rows.append((first, word, n))
        if len(out) > 10_000:
            yield flush()
    if name is not None:
        tile(name, rows)
    unpack()
    yield flush()


def neighbours(words: DataFrame) -> DataFrame:
    """words(word, n) with n_near, and with best, best_n: the commonest near word, null without one."""
    names = ["longest", "by_end", "key", "a", "b"]
    laid = tiles(words).repartition(*names).sortWithinPartitions(*names)
    found = laid.mapInArrow(compare, FOUND)
    none = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("bigint").alias("best_n"), F.lit(None).cast("string").alias("best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))))
    merged = found.unionByName(none).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n", "n_near", (-F.col("best.m")).alias("best_n"), F.col("best.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for forms(word, form): the end of each chain. Chains get half as long with every round.

    A form is RATIO times as common as its word, so a chain has fewer links than a count has digits.
    """
    chains = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chains = cut(chains.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if chains.filter("moved").isEmpty():
            return chains.select("word", "root")
        chains = chains.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the texts."""
    rows = neighbours(cut(vocabulary(docs)))
    kept = F.col("best_n") >= RATIO * F.col("n")
    rows = cut(rows.select("word", F.when(kept, F.col("best")).alias("form"), "n", "n_near", F.when(kept, F.col("best_n")).alias("form_n")))
    ends = roots(rows.filter("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
