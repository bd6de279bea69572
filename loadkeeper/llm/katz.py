"""Language-model scores: a Katz bigram model with Good-Turing discounts and exactly normalised backoff weights.

A text's tokens are its words, A-Z in lower case, cut at white space, and one end. The first one follows a start mark,
which is no token itself. With c the counts in the training texts, N all tokens and V distinct ones:

- P(w) = d(c) c / N for a known token; what the discounts leave is the probability of the class of all unknown ones.
- P(w | v) = d(c(v w)) c(v w) / c(v) for a pair that was seen; a(v) P(w) for a known v otherwise; P(w) for an unknown v.
- a(v) = (1 - sum of P(w | v) over seen pairs) / (1 - sum of P(w) over the same w), so each context sums to 1.

Counts up to TURING are discounted by Good-Turing: with n the counts of counts, r* = (r + 1) n(r + 1) / n(r), d(r) =
(r* / r - m) / (1 - m), m = (TURING + 1) n(TURING + 1) / n(1). Where that is no number between 0 and 1, it is 1 - 1 / 2r. If nothing is discounted in a
context, or among the single tokens, one unseen event is added to the total, so something is always left.

Texts are taken together in blocks of about BLOCK tokens. A block sends each of its words and pairs once, with its count, to
the part of the table that holds it, and gets the totals back; so a frequent word
costs no more than a rare one in any part. Parts grow in number with the corpus, not in size. Pairs are parted by their
first word; those of the at most HOT most frequent words, by both. Blocks and parts travel as packed arrays.

Null and empty texts have the end as their only token. Rows without a doc_id are held out. Repeated rows count, and are scored, as often
as they occur. Without training texts every token is unknown, with probability 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm.shared import cut

TURING = 5
BLOCK = 1 << 20
#: Bytes of text for each part of the table of words, and of pairs: about a million entries.
WORD_PART, PAIR_PART = 1 << 26, 1 << 23
HOT = 1024
#: The hashes that stand for the end and the start of a text.
END, START = np.uint64(0xEF46DB3751D8E999), np.uint64(0x9E3779B185EBCA87)
BLOCKS = "block bigint, docs binary, missing binary, train binary, lengths binary, tokens binary, spread binary, vocabulary binary"
BACK = "block bigint, kind int, part int, a binary, b binary, c binary, context bigint, n array<bigint>, s double"
PAIRS = "part int, block bigint, one binary, other binary, counts binary, seconds binary, hot binary"
RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _pack(values: np.ndarray, kind: str) -> bytes:
    """An array, compressed with all first bytes before all second ones and so on: high bytes are mostly zero."""
    width = np.dtype(kind).itemsize
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).view("u1").reshape(-1, width).T.tobytes())


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "u1")
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _steps(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Ascending runs of values as steps from one to the next; a run's first value stays."""
    return np.where(new, values, np.diff(values, prepend=0))


def _from_steps(steps: np.ndarray, new: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps)
    starts = np.flatnonzero(new)
    return total - np.repeat(total[starts] - steps[starts], np.diff(np.append(starts, len(steps))))


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def blocks(docs: DataFrame, learned: Callable[[int], bool], parts: int) -> DataFrame:
    """The texts of docs(doc_id, text) as blocks of word numbers; a text is never split.

    ``vocabulary`` has the hash of each word of a block, the most frequent first, ``spread`` its part of the table of words.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        schema, number = _schema(BLOCKS), TaskContext.get().partitionId() << 32
        ids, texts, lengths = [], [], []

        def row() -> pa.RecordBatch:
            tokens = np.concatenate(texts)
            vocabulary, numbers, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            words = np.append(vocabulary[order], START)
            train = np.array([i is not None and learned(i) for i in ids])
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "block": number,
                        "docs": _pack(np.array([i or 0 for i in ids]), "<i8"),
                        "missing": _pack(np.array([i is None for i in ids]), "u1"),
                        "train": _pack(train, "u1"),
                        "lengths": _pack(np.array(lengths), "<i8"),
                        "tokens": _pack(rank[numbers], "<u4"),
                        "spread": _pack(words % np.uint64(parts), "<u4"),
                        "vocabulary": words.astype("<u8").tobytes(),
                    }
                ],
                schema,
            )

        size = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary())):
                words = (text.as_py() or b"").lower().split()
                texts.append(np.append(np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)), END))
                ids.append(doc_id)
                lengths.append(len(words) + 1)
                size += len(words) + 1
                if size >= BLOCK:
                    yield row()
                    ids, texts, lengths, size, number = [], [], [], 0, number + 1
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(coded, BLOCKS)


class Block:
    """One block, opened: tokens by their place in the vocabulary, whose last entry is the start mark."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.spread = _unpack(row["spread"], "<u4").astype(np.int64)
        self.size = len(self.spread)
        self.tokens = _unpack(row["tokens"], "<u4").astype(np.int64)
        self.lengths = _unpack(row["lengths"], "<i8")
        self.train = _unpack(row["train"], "u1").astype(bool)
        self.docs, self.missing = _unpack(row["docs"], "<i8"), _unpack(row["missing"], "u1").astype(bool)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.trained = np.repeat(self.train, self.lengths)

    def word_counts(self) -> np.ndarray:
        """How often each word of the vocabulary occurs in training texts; for the start mark, the texts."""
        out = np.bincount(self.tokens[self.trained], minlength=self.size)
        out[-1] = self.train.sum()
        return out

    def pairs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and second word of the distinct pairs, their training counts, and each token's pair; in the order of the words' numbers."""
        order = np.argsort(numbers)
        place = np.empty_like(order)
        place[order] = np.arange(self.size)
        tokens = place[self.tokens]
        before = np.roll(tokens, 1)
        before[self.starts] = place[-1]
        both, at = np.unique(before * self.size + tokens, return_inverse=True)
        counts = np.bincount(at, weights=self.trained, minlength=len(both)).astype(np.int64)
        return order[both // self.size], order[both % self.size], counts, at


def _by_part(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each part that has any, the places of its entries, in order."""
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    return ((p, order[a:b]) for p, (a, b) in enumerate(zip(ends, ends[1:])) if a < b)


def discounts(counts: list[int]) -> np.ndarray:
    """d(0), d(1) ... d(TURING) from the counts of counts n(1) ... n(TURING + 1); d(0) is not used."""
    n = [0, *counts]
    out = np.ones(TURING + 1)
    m = (TURING + 1) * n[TURING + 1] / n[1] if n[1] else 1.0
    for r in range(1, TURING + 1):
        d = ((r + 1) * n[r + 1] / n[r] / r - m) / (1 - m) if n[r] and m < 1 else 0.0
        out[r] = d if 0 < d < 1 else 1 - 0.5 / r
    return out


@dataclass
class Words:
    """The single tokens: what all blocks and parts have to know of them."""

    total: int
    distinct: int
    counts: list[int]
    parts: int
    factors: np.ndarray = field(init=False)
    unknown: float = field(init=False)
    whole: int = field(init=False)

    def __post_init__(self):
        self.factors = discounts(self.counts)
        left = float(sum((1 - self.factors[r]) * r * self.counts[r - 1] for r in range(1, TURING + 1)))
        self.whole = self.total if left > 0 else self.total + 1
        self.unknown = (left or 1.0) / self.whole

    def probability(self, counts: np.ndarray) -> np.ndarray:
        known = self.factors[np.minimum(counts, TURING + 1) % (TURING + 1)] * counts / self.whole
        return np.where(counts > 0, known, self.unknown)

    def discounted(self, factors: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return factors[np.minimum(counts, TURING + 1) % (TURING + 1)] * counts


def _counted(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, TURING + 2), minlength=TURING + 3)[1 : TURING + 2].tolist()


def _words_back(coded: DataFrame, parts: int) -> DataFrame:
    """BACK rows, kind 0: numbers (a) and total counts (b) of a block's words; kind 1: a part's total, distinct and counts of counts."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                counts, vocabulary = block.word_counts(), np.frombuffer(row["vocabulary"], "<u8")
                rows = [
                    {"part": p, "block": block.number, "words": vocabulary[at].tobytes(), "counts": _pack(counts[at], "<u4")}
                    for p, at in _by_part(block.spread, parts)
                ]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())]))

    def totalled(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words = [np.frombuffer(r["words"], "<u8") for r in rows]
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.bincount(at, weights=np.concatenate([_unpack(r["counts"], "<u4") for r in rows])).astype(np.int64)
        numbers = np.arange(len(distinct)) * parts + rows[0]["part"]
        out, first = [], 0
        for r, own in zip(rows, words):
            mine = at[first : first + len(own)]
            first += len(own)
            out.append({"block": r["block"], "kind": 0, "part": r["part"], "a": _pack(numbers[mine], "<u8"), "b": _pack(totals[mine], "<u8")})
        known = totals[(distinct != START) & (totals > 0)]
        out.append({"kind": 1, "part": rows[0]["part"], "n": [int(known.sum()), len(known), *_counted(known)]})
        return _table(out, _schema(BACK))

    return coded.mapInArrow(sent, "part int, block bigint, words binary, counts binary").groupBy("part").applyInArrow(totalled, BACK)


def _numbered(block: Block, back: list[dict], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and total count of each word of a block."""
    numbers, counts = np.zeros(block.size, np.int64), np.zeros(block.size, np.int64)
    own = {r["part"]: r for r in back if r["kind"] == 0}
    for p, at in _by_part(block.spread, parts):
        numbers[at], counts[at] = _unpack(own[p]["a"], "<u8"), _unpack(own[p]["b"], "<u8")
    return numbers, counts


def _pair_parts(one: np.ndarray, other: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """The part of each pair: by its first word, or by both if the first is hot."""
    mixed = (one.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed += np.where(hot, (other.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0))
    return ((mixed >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)


def _ordered(block: Block, numbers: np.ndarray, counts: np.ndarray, words: Words, parts: int):
    """A block's pairs in the order in which parts see them: by first word, then second. Also each token's pair."""
    first, second, own, at = block.pairs(numbers)
    hot = counts[first] * HOT >= max(words.total, 1)
    return first, second, own, at, hot, _pair_parts(numbers[first], numbers[second], hot, parts)


def _pairs_back(coded: DataFrame, back: DataFrame, words: Words, parts: int) -> DataFrame:
    """BACK rows, kind 2: for a block's pairs, the total counts (a), and for each run of one first word the counts of counts (b)
    and the summed P of the second words (c); kind 3: the same for a hot first word, of one part; kind 4: a part's counts of counts."""

    def sent(left: pa.Table, right: pa.Table) -> pa.Table:
        block, rows = Block(left.to_pylist()[0]), []
        numbers, counts = _numbered(block, right.to_pylist(), words.parts)
        first, second, own, _, hot, part = _ordered(block, numbers, counts, words, parts)
        for p, at in _by_part(part, parts):
            one, other = numbers[first[at]], numbers[second[at]]
            new = np.append(True, np.diff(one) != 0)
            rows.append(
                {
                    "part": p, "block": block.number, "one": _pack(np.diff(one, prepend=0), "<i8"), "other": _pack(_steps(other, new), "<i8"),
                    "counts": _pack(own[at], "<u4"), "seconds": _pack(counts[second[at]], "<u8"), 
                    "hot": _pack(hot[at], "u1"),
                }
            )
        return _table(rows, _schema(PAIRS))

    def totalled(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        cat = lambda c, kind: np.concatenate([_unpack(r[c], kind) for r in rows]).astype(np.int64)
        steps = [_unpack(r["one"], "<i8") for r in rows]
        news = [np.append(True, x[1:] != 0) for x in steps]
        one = np.concatenate([np.cumsum(x) for x in steps])
        other = np.concatenate([_from_steps(_unpack(r["other"], "<i8"), new) for r, new in zip(rows, news)])
        order = np.lexsort((other, one))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(other[order]) != 0)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        totals = np.bincount(at, weights=cat("counts", "<u4")).astype(np.int64)
        lead = order[new]
        seen, contexts = totals > 0, one[lead]
        starts = np.flatnonzero(np.append(True, np.diff(contexts) != 0))
        runs = np.stack([np.add.reduceat(totals == r, starts, dtype=np.int64) for r in range(1, TURING + 1)], axis=1)
        sums = np.add.reduceat(np.where(seen, words.probability(cat("seconds", "<u8")[lead]), 0.0), starts)
        run_of = np.searchsorted(contexts[starts], one)
        out, first = [], 0
        for r, new in zip(rows, news):
            mine = slice(first, first + len(new))
            first += len(new)
            own, found = run_of[mine][new], totals[at[mine]]
            # a block needs the sums only of first words that it has in pairs never seen
            wanted = np.logical_or.reduceat(found == 0, np.flatnonzero(new))
            out.append(
                {
                    "block": r["block"], "kind": 2, "part": r["part"], "a": _pack(found, "<u8"), "b": _pack(runs[own].T.reshape(-1), "<u4"),
                    "c": _pack(np.where(wanted, sums[own], 0.0), "<f8"),
                }
            )
        hot = cat("hot", "u1")[lead][starts] == 1
        for i in np.flatnonzero(hot):
            out.append({"kind": 3, "context": int(contexts[starts[i]]), "n": runs[i].tolist(), "s": float(sums[i])})
        out.append({"kind": 4, "part": rows[0]["part"], "n": _counted(totals[seen])})
        return _table(out, _schema(BACK))

    pairs = coded.groupBy("block").cogroup(back.groupBy("block"))
    sent_pairs = pairs.applyInArrow(sent, PAIRS)
    return sent_pairs.groupBy("part").applyInArrow(totalled, BACK)


def _scored(coded: DataFrame, back: DataFrame, words: Words, parts: int, factors: np.ndarray, hot: dict[int, tuple]) -> DataFrame:
    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        block, rows = Block(left.to_pylist()[0]), right.to_pylist()
        numbers, counts = _numbered(block, rows, words.parts)
        first, second, _, at, _, part = _ordered(block, numbers, counts, words, parts)
        totals, runs, sums = np.zeros(len(first), np.int64), np.zeros((len(first), TURING)), np.zeros(len(first))
        own = {r["part"]: r for r in rows if r["kind"] == 2}
        for p, places in _by_part(part, parts):
            run = np.cumsum(np.append(False, np.diff(first[places]) != 0))
            totals[places] = _unpack(own[p]["a"], "<u8")
            runs[places] = _unpack(own[p]["b"], "<u4").reshape(TURING, -1).T[run]
            sums[places] = _unpack(own[p]["c"], "<f8")[run]
        for number, (n, s) in hot.items():
            places = np.flatnonzero(numbers[first] == number)
            runs[places], sums[places] = n, s
        contexts = counts[first]
        left_over = runs @ ((1 - factors[1:]) * np.arange(1, TURING + 1))
        whole = np.where(left_over > 0, contexts, contexts + 1)
        backoff = np.where(left_over > 0, left_over, 1.0) / whole / (1 - sums)
        alone = words.probability(counts[second])
        p = np.where(totals > 0, words.discounted(factors, totals) / whole, np.where(contexts > 0, backoff * alone, alone))
        logs, known = np.log10(p)[at], counts[block.tokens]
        base = np.log10((known + 1) / (words.total + words.distinct + 1))
        return pa.table(
            {
                "doc_id": pa.array(block.docs, pa.int64(), mask=block.missing),
                "held_out": ~block.train,
                "n_tokens": block.lengths,
                "n_known": np.add.reduceat((known > 0).astype(np.int64), block.starts),
                "base_score": np.add.reduceat(base, block.starts),
                "score": np.add.reduceat(logs, block.starts),
            }
        )

    return coded.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(scored, RESULT)


def score(docs: DataFrame, learned: Callable[[int], bool]) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs(doc_id, text).

    ``learned`` says of a doc_id whether the model learns from it. ``base_score`` is the sum of the base-10 logarithms of (c + 1) / (N + V + 1).
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, pair_parts = size // WORD_PART + 1, size // PAIR_PART + 1
    coded = blocks(docs, learned, parts)
    back = cut(_words_back(coded, parts))
    coded = coded.drop("vocabulary")
    sums = [F.sum(F.get("n", F.lit(i))) for i in range(TURING + 3)]
    total, distinct, *counts = (x or 0 for x in back.filter("kind = 1").agg(*sums).first())
    words = Words(total, distinct, counts, parts)
    numbers = back.filter("kind = 0")
    pairs = cut(_pairs_back(coded, numbers, words, pair_parts))
    counts = [x or 0 for x in pairs.filter("kind = 4").agg(*sums[: TURING + 1]).first()]
    contexts = pairs.filter("kind = 3").groupBy("context").agg(*(s.alias(f"n{i}") for i, s in enumerate(sums[:TURING])), F.sum("s").alias("s"))
    hot = {r["context"]: ([r[f"n{i}"] for i in range(TURING)], r["s"]) for r in contexts.collect()}
    rows = _scored(coded, numbers.unionByName(pairs.filter("kind = 2")), words, pair_parts, discounts(counts), hot)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")


def learned_rows(doc_id: int) -> bool:
    """Whether the crc32 of a doc_id as text does not leave 2 when divided by 7."""
    return zlib.crc32(str(doc_id).encode()) % 7 != 2
