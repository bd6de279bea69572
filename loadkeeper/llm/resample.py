"""Importance resampling towards a target: hashed n-gram features, and the draw of the best by a distributed quickselect.

Features are the runs of one to WIDTH words, hashed into BUCKETS. A bucket's gain is the smoothed log ratio of its share in the
target and in the corpus; an array of gains, whose size is fixed, scores every document. Adding noise
of the Gumbel distribution, here from a hash of the doc_id, makes taking the highest scores a draw without replacement in
proportion to the weights.

The draw orders documents by a composite key: score downwards, then doc_id, then the other columns. Rounds of
quickselect find the k-th key: a few random keys of what is left are pivots, one pass counts exactly what lies before,
on and after each, and only the keys between the two pivots around the k-th place go on. Only winners are sorted; their
ranks are their places within the partitions of that sort, plus what the partitions before hold.

Words are runs of digits, letters a-z and all code points from U+0080, A-Z in lower case. Null texts and texts without
words have no features and weight 0. A row without a doc_id is drawn as if its id were empty, and comes last among equal scores;
repeated rows are drawn each for itself. Input columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm.shared import cut

BUCKETS, WIDTH = 10_000, 3
#: Words of a document that may be drawn, at least; the percentage that is drawn; the steps of a gain.
LEAST_WORDS, PERCENT, STEPS = 20, 5, 1000
#: Keys that are tried as pivots in a round.
PIVOTS = 8
#: Bytes of text that are worked on at a time, and the length up to which words are hashed side by side.
CHUNK, SHORT = 1 << 20, 48
COUNTS = "bucket int, n bigint"
WEIGHTS = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
#: Bytes a word consists of, after A-Z have become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_SPACE = 32


def _table() -> np.ndarray:
    """The table of the reflected CRC-32 polynomial."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, np.uint32(0xEDB88320) ^ (out >> 1), out >> 1).astype(np.uint32)
    return out


_CRC = _table()


def _step(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _CRC[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def _on(state: np.ndarray, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksum states carried on over a word each: short words side by side, one byte after the other."""
    out = state.copy()
    short = np.flatnonzero(lengths <= SHORT)
    order = short[np.argsort(-lengths[short], kind="stable")]
    for place in range(int(lengths[order[0]]) if len(order) else 0):
        order = order[: np.searchsorted(-lengths[order], -place, side="left")]
        out[order] = _step(out[order], text[starts[order] + place])
    for i in np.flatnonzero(lengths > SHORT):
        word = text[starts[i] : starts[i] + lengths[i]].tobytes()
        out[i] = np.uint32(zlib.crc32(word, int(~out[i] & 0xFFFFFFFF))) ^ np.uint32(0xFFFFFFFF)
    return out


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text number) of every feature of some texts, and the number of words of each text."""
    text = np.frombuffer(b"\0".join(t.translate(_FOLD) for t in texts) + b"\0", np.uint8)
    inside = np.concatenate([[False], _WORD[text], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    words = np.bincount(owner, minlength=len(texts))
    state = _on(np.full(len(starts), 0xFFFFFFFF, np.uint32), text, starts, lengths)
    buckets, owners = [state ^ np.uint32(0xFFFFFFFF)], [owner]
    for more in range(1, WIDTH):
        # runs that are one word longer: those whose next word is of the same text
        held = np.flatnonzero(owner[: len(owner) - more] == owner[more:])
        state = _on(_step(state[held], _SPACE), text, starts[held + more], lengths[held + more])
        buckets.append(state ^ np.uint32(0xFFFFFFFF))
        owners.append(owner[held])
        whole = np.zeros(len(starts), np.uint32)
        whole[held] = state
        state = whole
    return np.concatenate(buckets) % np.uint32(BUCKETS), np.concatenate(owners), words


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in runs of about CHUNK bytes, each with the number of its first text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket; a task sends each bucket once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, part in _chunks(_texts(batch)):
                total += np.bincount(features(part)[0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(count, COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> list[int]:
    """The gain of every bucket: at most BUCKETS numbers of each side come to the driver."""
    s, t = ({r["bucket"]: float(r["n"]) for r in bucket_counts(side).collect()} for side in (corpus, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    ratio = lambda b: (t.get(b, 0.0) + 1) * (all_s + BUCKETS) / ((s.get(b, 0.0) + 1) * (all_t + BUCKETS))
    return [math.floor(STEPS * math.log(ratio(b))) for b in range(BUCKETS)]


def weights(docs: DataFrame, gain: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    table = np.array(gain, np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, part in _chunks(_texts(batch)):
                bucket, owner, words = features(part)
                weight = np.zeros(len(part), np.int64)
                np.add.at(weight, owner, table[bucket])
                numbers = [words, np.bincount(owner, minlength=len(part)), weight]
                columns = [ids.slice(first, len(part)), *[pa.array(x.astype(np.int64)) for x in numbers]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(weigh, WEIGHTS)


def noise(doc_id: Column) -> Column:
    """A Gumbel draw in STEPS, the same one for the same doc_id."""
    seed = F.sha2(F.concat(F.lit("42:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(seed, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-STEPS) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def composite(*columns: str) -> Column:
    """The key whose ascending order is: first column downwards, the others upwards, nulls last."""
    first, *rest = columns
    return F.struct((-F.col(first)).alias("_0"), *[x for i, c in enumerate(rest) for x in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_{i + 1}"))])


def select_kth(keys: DataFrame, k: int) -> Column | None:
    """The ``k``-th smallest ``key`` (a struct, counted from 1) of keys(key), as a literal; None if there are fewer.

    Each round's keys stay in the shared folder, and are on average a fifth of those before; equal keys are
    counted together, so they cannot stop it.
    """
    left, key = cut(keys.select("key")), F.col("key")
    kind = left.schema["key"].dataType
    for turn in range(10_000):
        if k < 1 or left.isEmpty():
            return None
        drawn = left.orderBy(F.xxhash64("key", F.lit(turn)), "key").limit(PIVOTS).distinct().collect()
        pivots = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r["key"], kind.fields)]) for r in drawn]
        counts = left.agg(*[F.array(F.count_if(key < p), F.count_if(key == p)) for p in pivots]).first()
        ordered = sorted(zip(counts, pivots), key=lambda c: tuple(c[0]))
        low, high, passed = None, None, 0
        for (before, equal), pivot in ordered:
            if before < k <= before + equal:
                return pivot
            if before + equal < k:
                low, passed = pivot, before + equal
            elif high is None:
                high = pivot
        # the k-th key lies strictly between two pivots
        if low is not None:
            left = left.filter(key > low)
        if high is not None:
            left = left.filter(key < high)
        left, k = cut(left), k - passed
    raise AssertionError("every round leaves out a key")


def ranked(rows: DataFrame, order: Column) -> DataFrame:
    """The rows with ``rank`` 1, 2, 3 ... in an order, without any task that holds them all.

    They are sorted over many partitions and written; a row's rank is its place in its partition plus
    the rows of the partitions before, whose number is all that leaves them.
    """
    place = F.monotonically_increasing_id()
    in_part = place.bitwiseAND((1 << 33) - 1)
    sorted_rows = cut(rows.orderBy(order).select("*", F.shiftright(place, 33).alias("_part"), in_part.alias("_at")))
    sizes = sorted_rows.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    starts, before = [], 0
    for r in sizes:
        starts += [F.lit(r["_part"]), F.lit(before)]
        before += r["n"]
    if not starts:
        return sorted_rows.select(*rows.columns, F.lit(None).cast("bigint").alias("rank"))
    start = F.element_at(F.create_map(*starts), F.col("_part"))
    return sorted_rows.select(*rows.columns, (start + F.col("_at") + 1).cast("bigint").alias("rank"))


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every document's weight and score, and the drawn ones' rank.

    Of the documents with LEAST_WORDS words PERCENT in a hundred are drawn, rounded down: the highest scores,
    ties to the smaller doc_id. Of rows equal in all columns each has a rank of its own.
    """
    scored = weights(docs, gains(docs, target)).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    scored = cut(scored).withColumn("key", composite("score", "doc_id", "n_features", "weight"))
    may = scored.filter(F.col("n_words") >= LEAST_WORDS)
    wanted = may.count() * PERCENT // 100
    last = select_kth(may, wanted)
    shown, none = ["doc_id", "n_features", "weight", "score"], F.lit(None).cast("bigint").alias("rank")
    if last is None:
        return scored.select(*shown, none)
    wins = (F.col("n_words") >= LEAST_WORDS) & (F.col("key") <= last)
    winners = ranked(scored.filter(wins).select(*shown, "key"), F.col("key"))
    # of rows equal to the last one only as many as are wanted have a rank
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")
    return scored.filter(~wins).select(*shown, none).unionByName(winners.select(*shown, rank))
