"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard, distributed union-find.

A line is what lies between line ends, trimmed; blank lines take no part and stay. Its shingles are the runs
of SHINGLE characters, as UTF-8 bytes with A-Z in lower case; a shorter line is one shingle. Lines whose shingle
sets have a Jaccard similarity of at least SIMILARITY link, equal lines always; of each component
the first line stays, by doc_id and place, and the others go.

Candidates are lines that agree in all ROWS minima of one of BANDS bands: a pair at the threshold is
missed with probability (1 - 0.8 ** 4) ** 10, half a percent; one above it far more rarely. Every
candidate is verified on the exact sets, all lines of a band's bucket at once, as a product of
matrices; only as many links leave a bucket as connect its lines. Large buckets are split into parts,
each two of which are compared by a task of their own. Equal lines are one from the start.

Rows without a doc_id are not compared and keep all lines, null and empty texts have no lines. Rows
of the same doc_id count as one document. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm import bloom
from loadkeeper.llm.components import components
from loadkeeper.llm.shared import cut

SHINGLE, SIMILARITY = 8, 0.8
BANDS, ROWS = 10, 4
#: Lines a task remembers having sent, but for those of one batch; then it forgets them.
SEEN = 1 << 17
#: A line with more than one in so many of all places is spread over several tasks.
FEW = 1000
BLANKS = " \t\r\x0b\x0c"
#: Bytes of text whose shingles are hashed at a time, so many of which are sent on together, lines of a bucket that are
#: compared in one group, bytes of them that are compared at a time, and shingles that are counted at a time; with a
#: single longer line they bound the memory of a worker.
CHUNK, TOGETHER, PART, BYTES, COLUMNS = 1 << 16, 8, 256, 1 << 19, 4096


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values scrambled one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _orders() -> list[tuple[np.uint32, np.uint32]]:
    """A mask and an odd factor for each minimum, the same ones every time: each pair orders the values in its own way."""
    seeds = _mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).astype(np.uint32)
    return list(zip(seeds[::2], seeds[1::2] | np.uint32(1)))


def shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of some lines as 64-bit values, and the place of each line's first one."""
    padded = [line if len(line) >= SHINGLE else line.ljust(SHINGLE, b"\0") for line in lines]
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    counts = lengths - (SHINGLE - 1)
    text = b"".join(padded)
    windows = np.ndarray((len(text) - SHINGLE + 1,), "<u8", text, strides=(1,))
    starts = np.cumsum(counts) - counts
    # the windows of a line begin SHINGLE - 1 places later for every line before it
    places = np.arange(counts.sum()) + np.repeat(np.arange(len(lines)) * (SHINGLE - 1), counts)
    return windows[places], starts


def band_keys(lines: list[bytes]) -> np.ndarray:
    """The BANDS band values of each line, one row per line."""
    padded = [line.ljust(SHINGLE, b"\0") for line in lines]
    text = b"".join(padded)
    values = np.ndarray((len(text) - SHINGLE + 1,), "<u8", text, strides=(1,)).copy()
    hashed = (_mixed(values) >> np.uint64(32)).astype(np.uint32)
    # each line's shingles, then the few that reach into the next line, whose minima are left out
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    starts = np.cumsum(lengths) - lengths
    places = np.stack([starts, starts + lengths - (SHINGLE - 1)], axis=1).reshape(-1)[:-1]
    ordered, least = np.empty_like(hashed), np.empty((BANDS * ROWS, len(lines)), np.uint32)
    for i, (mask, factor) in enumerate(_orders()):
        np.bitwise_xor(hashed, mask, out=ordered)
        np.multiply(ordered, factor, out=ordered)
        least[i] = np.minimum.reduceat(ordered, places)[::2]
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(lines), 1))
    for row in range(ROWS):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + least[row::ROWS].T.astype(np.uint64) + np.uint64(1))
    return keys


def jaccard(one: bytes, other: bytes) -> float:
    """The exact similarity of two lines' shingle sets."""
    padded = (x.ljust(SHINGLE, b"\0") for x in (one, other))
    a, b = (set(np.ndarray((len(x) - SHINGLE + 1,), "<u8", x, strides=(1,)).tolist()) for x in padded)
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared)


def similar(lines: list[bytes]) -> np.ndarray:
    """For some lines, which pairs of them reach the threshold: an exact matrix, built from the shingles that several lines have.

    It takes several passes over more than BYTES of text; each counts the shingles of one residue of their hashes.
    """
    shared, sizes = np.zeros((len(lines), len(lines)), np.float32), np.zeros(len(lines), np.int64)
    passes = -(-sum(map(len, lines)) // BYTES) or 1
    for turn in range(passes):
        parts = [_residue(first, part, turn, passes) for first, part in _runs(lines)]
        values, own = (np.concatenate(x) for x in zip(*parts))
        names, numbers = np.unique(values, return_inverse=True)
        cells = np.unique(numbers * len(lines) + own)
        names, own = cells // len(lines), cells % len(lines)
        sizes += np.bincount(own, minlength=len(lines))
        often = np.bincount(names)
        order = np.cumsum(often > 1) - 1
        kept = often[names] > 1
        names, own = order[names[kept]], own[kept]
        columns = int(order[-1]) + 1 if len(order) else 0
        for first in range(0, columns, COLUMNS):
            part = slice(*np.searchsorted(names, (first, first + COLUMNS)))
            held = np.zeros((len(lines), min(COLUMNS, columns - first)), np.float32)
            held[own[part], names[part] - first] = 1
            shared += held @ held.T
    return shared >= SIMILARITY * (sizes[:, None] + sizes[None, :] - shared) - 1e-4


def _runs(lines: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """The lines in runs of about BYTES, each with the number of its first line."""
    first, size = 0, 0
    for n, line in enumerate(lines):
        size += len(line)
        if size >= BYTES:
            yield first, lines[first : n + 1]
            first, size = n + 1, 0
    if first < len(lines):
        yield first, lines[first:]


def _residue(first: int, lines: list[bytes], turn: int, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, number of the line) of the lines' shingles with one residue of their hashes."""
    values, starts = shingles(lines)
    own = np.repeat(np.arange(first, first + len(lines)), np.diff(np.append(starts, len(values))))
    if passes == 1:
        return values, own
    kept = _mixed(values) % np.uint64(passes) == turn
    return values[kept], own[kept]


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what a matrix of pairs connects: one less than the members of each component."""
    open_, out = np.ones(len(near), bool), []
    for start in range(len(near)):
        queue = [start] if open_[start] else []
        open_[start] = False
        while queue:
            one = queue.pop()
            for other in np.flatnonzero(near[one] & open_):
                open_[other] = False
                queue.append(other)
                out.append((one, other))
    return out


def linked(lines: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of numbers of lines that connect all similar ones."""
    if len(lines) == 2 and len(lines[0]) + len(lines[1]) <= BYTES:
        return [(0, 1)] if jaccard(*lines) >= SIMILARITY else []
    return forest(similar(lines))


def _bands(docs: DataFrame) -> DataFrame:
    """(band, line): the band values of the lines of some documents, repeated ones seldom more than once a task; ``line`` is the line's hash."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        def rows(done: list[tuple[list[int], np.ndarray]]) -> pa.RecordBatch:
            hashes = np.concatenate([np.array(h, np.uint64) for h, _ in done])
            keys = np.concatenate([k for _, k in done])
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(hashes, BANDS).view(np.int64))], names=["band", "line"]
            )

        seen: set[int] = set()
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            done, part, size = [], {}, 0
            for text in batch["text"].cast(pa.binary()):
                for line in (text.as_py() or b"").split(b"\n"):
                    line = line.strip(BLANKS.encode())
                    key = xxh64_intdigest(line, seed=42)
                    if line and key not in seen:
                        seen.add(key)
                        part[key] = line.lower()
                        size += len(line)
                        if size >= CHUNK:
                            done.append((list(part), band_keys(list(part.values()))))
                            part, size = {}, 0
                if len(done) >= TOGETHER:
                    yield rows(done)
                    done = []
            if part:
                done.append((list(part), band_keys(list(part.values()))))
            if done:
                yield rows(done)

    return docs.select("text").mapInArrow(banded, "band bigint, line bigint")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, place, line, text): every line of docs(doc_id, text) that is not blank; ``line`` is the hash of the trimmed text."""
    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("place", "text"))
    rows = rows.withColumn("text", F.btrim("text", F.lit(BLANKS))).filter("text <> ''")
    return rows.select("doc_id", "place", F.xxhash64("text").alias("line"), "text")


def _verified(members: DataFrame) -> DataFrame:
    """(a, b): links between the lines of each group of members(band, low, high, line, text), enough to connect all that are similar."""

    def named(lines: dict[int, bytes]) -> list[tuple[int, int]]:
        names = list(lines)
        return [(names[a], names[b]) for a, b in linked(list(lines.values()))] if len(names) > 1 else []

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lines = None, {}
        for batch in batches:
            out: list[tuple[int, int]] = []
            keys = zip(*(batch[c].to_pylist() for c in ("band", "low", "high")))
            for key, line, text in zip(keys, batch["line"].to_pylist(), batch["text"].cast(pa.binary())):
                if key != group:
                    out += named(lines)
                    group, lines = key, {}
                lines[line] = text.as_py().lower()
            yield made(out)
        yield made(named(lines))

    def made(rows: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["a", "b"])

    keys = ("band", "low", "high")
    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(links, "a bigint, b bigint")


def classes(docs: DataFrame) -> DataFrame:
    """(node, root): the hashes of the lines of docs(doc_id, text) that have near duplicates, each with its component."""
    # the filter keeps nothing out; with it both uses of the bands are one shuffle
    banded = _bands(docs.filter("doc_id IS NOT NULL")).filter("band IS NOT NULL").repartition("band")
    # few bands hold different lines, and only theirs are made distinct, counted and kept
    several = banded.groupBy("band").agg(F.min("line").alias("low"), F.max("line").alias("high")).filter("low < high").select("band")
    buckets = cut(banded.join(several.hint("shuffle_hash"), "band").distinct())
    sums = [F.bit_xor(c).alias(f"sum{i}") for i, c in enumerate((F.col("line"), F.xxhash64("line")))]
    sized = buckets.groupBy("band").agg(F.count("*").alias("n"), *sums)
    # buckets of the same lines are looked into once
    chosen = sized.groupBy("n", "sum0", "sum1").agg(F.min("band").alias("band")).select("band", "n")
    members = cut(buckets.join(chosen, "band"))
    involved = members.select("line").distinct()
    held = bloom.build(involved, "line")
    texts = occurrences(docs).select("line", "text").filter(bloom.may_hold(held, F.col("line")))
    # one row for each line before anything is shuffled by it
    texts = texts.groupBy("line").agg(F.first("text").alias("text")).join(involved, "line", "left_semi")
    # a large bucket becomes groups of two of its parts, so that any two lines meet in one
    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    members = members.withColumn("own", F.pmod(F.xxhash64("line"), parts).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    met = members.select("band", "line", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return components(_verified(met.join(cut(texts), "line")).distinct())


def drops(docs: DataFrame) -> DataFrame:
    """(doc_id, gone): for each document that loses lines, array<struct<place, line>> of them by place."""
    docs = docs.select("doc_id", "text")
    found = cut(occurrences(docs).select("doc_id", "place", "line"))
    firsts = found.groupBy("line").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n"))
    roots = classes(docs).withColumnRenamed("node", "line")
    known = firsts.join(roots, "line", "left").filter("n > 1 OR root IS NOT NULL")
    known = cut(known.select("line", F.coalesce("root", "line").alias("root"), "first", "n"))
    kept = known.groupBy("root").agg(F.min("first").alias("kept"))
    kept = cut(known.join(kept, "root").select("line", "kept", "n"))
    # a line with more than its share of all places is split; of such lines there are at most FEW
    share = F.greatest(F.lit(1.0), found.agg(F.count("*") / F.lit(FEW)).scalar())
    common = F.broadcast(kept.filter(F.col("n") > share).select("line", F.ceil(F.col("n") / share).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    copies = kept.drop("n").join(common, "line", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    split = found.join(common, "line", "left").withColumn("part", F.pmod(F.xxhash64("doc_id", "place"), parts).cast("int")).drop("parts")
    gone = split.join(copies, ["line", "part"]).filter(F.struct("doc_id", "place") != F.col("kept")).select("doc_id", "place", "line").distinct()
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("gone"))


def without(text: Column, gone: Column) -> Column:
    """The text without the lines listed in ``gone``."""
    lines = F.split(text, "\n", -1)
    hashed = lambda x: F.xxhash64(F.btrim(x, F.lit(BLANKS)))
    stays = lambda x, i: ~F.array_contains(gone, F.struct(i.alias("place"), hashed(x).alias("line")))
    return F.when(gone.isNull(), text).otherwise(F.array_join(F.filter(lines, stays), "\n"))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs(doc_id, text, ...) with their texts less all lines that stand elsewhere first.

    A document of which no line but blank ones is left, and that had others, goes as a whole.
    """
    gone = drops(docs).withColumnRenamed("gone", "_gone")
    rows = docs.join(gone, "doc_id", "left").withColumn("text", without(F.col("text"), F.col("_gone")))
    return rows.filter(F.col("_gone").isNull() | (F.btrim("text", F.lit(BLANKS + "\n")) != "")).select(*docs.columns)
