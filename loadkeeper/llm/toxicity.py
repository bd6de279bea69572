"""Toxicity: maximal scoring segments over token log-odds, aggregated by extreme-value calibration.

Learning. Each distinct text of the labelled sample counts a feature once: its words (runs of letters and
digits, lower case) and the first PREFIX letters of longer ones. A feature's weight is the log-odds
ratio between toxic and clean texts with a Dirichlet prior in proportion to the feature's overall share;
features whose weight exceeds Z standard errors are kept. All other tokens share one weight,
the log-odds of being none of the kept, which is below zero.

Scoring. A linear scan finds all maximal segments of the token weights: the passages that cannot be
lengthened or shortened to a higher sum. In clean text the best segment of n tokens exceeds x with
probability 1 - exp(-K n exp(-lambda x)); lambda solves sum(p exp(lambda s)) = 1 over the clean token
distribution, K is fitted to clean sample texts that the weights have not seen. A segment's excess is
lambda x - ln(K n), so long texts need more than short ones. The best and the summed excess of a text
go through a logistic curve, fitted on the same texts, to a score between 0 and 1.

Bounds: at most SAMPLE labelled rows are learned from, those whose hashed doc_id is smallest, and at most FEATURES features are kept, the most
significant; so the model that tasks receive has a fixed largest size. All rows are scored, over their whole texts.

Null and empty texts have no tokens and get the score of a text without any evidence. Rows with a
null label or doc_id teach nothing; a doc_id with several labels counts as toxic if any of them says so. Without
labels of both kinds every score is the share of toxic labels (0 without any label). Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm.shared import cut

SAMPLE, FEATURES = 100_000, 50_000
PREFIX, LEAST_TEXTS, Z, PRIOR = 5, 3, 2.5, 0.1
#: One row in CALIBRATION of the sample fits K and the curve; the rest give the weights.
CALIBRATION = 4
TOKEN = re.compile(r"[^\W_]+")
PASSAGES = "array<struct<start:int,end:int,score:double,excess:double>>"


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """(first, last + 1, sum) of all maximal scoring segments, in order, in linear time.

    Each candidate remembers the sum before it, the sum up to its end, and the nearest earlier
    candidate whose sum before is smaller, so that a search never looks at the ones between again.
    A new candidate is joined with that earlier one if the latter ends on a smaller sum.
    """
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start, left = i, before
        while True:
            at = len(found) - 1
            while at >= 0 and found[at][2] >= left:
                at = found[at][4]
            if at < 0 or found[at][3] >= total:
                found.append((start, i + 1, left, total, at))
                break
            start, left = found[at][0], found[at][2]
            del found[at:]
    return [(a, b, right - left) for a, b, left, right, _ in found]


@dataclass
class Model:
    """What scoring needs: bounded by FEATURES."""

    weights: dict[str, float] = field(default_factory=dict)
    neutral: float = 0.0
    lam: float = 1.0
    k: float = 1.0
    curve: tuple[float, float, float] = (-30.0, 0.0, 0.0)

    def weight(self, word: str) -> float:
        return self.weights.get(word) or self.weights.get("^" + word[:PREFIX]) or self.neutral

    def hits(self, text: str) -> tuple[int, list[tuple[int, float]]]:
        """The number of tokens, and place and weight of those with a weight of their own."""
        words = [w.lower() for w in TOKEN.findall(text)]
        get, n = self.weights.get, PREFIX
        return len(words), [(i, s) for i, w in enumerate(words) if (s := get(w) or get("^" + w[:n]))]

    def passages(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of tokens, and (first token, last + 1, sum) of the maximal segments. Neutral runs count as one item."""
        n, hits = self.hits(text)
        scores, places, last = [], [], 0
        for i, s in hits:
            if i > last:
                scores.append((i - last) * self.neutral)
                places.append(last)
            scores.append(s)
            places.append(i)
            last = i + 1
        return n, [(places[a], places[b - 1] + 1, total) for a, b, total in segments(scores)]

    def excess(self, n: int, total: float) -> float:
        return self.lam * total - math.log(max(self.k * n, 1e-9))

    def evidence(self, text: str) -> tuple[float, float]:
        """The best excess of a segment, and the sum of those above zero; each with diminishing returns."""
        n, found = self.passages(text)
        above = [x for _, _, total in found if (x := self.excess(n, total)) > 0]
        return math.log1p(max(above, default=0.0)), math.log1p(sum(above))

    def score(self, text: str) -> float:
        best, both = self.evidence(text)
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * best + c * both))))


def _sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, calibrates) of one row per distinct text of the bounded sample."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    hashed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).join(F.broadcast(sample), "doc_id")
    unique = hashed.groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    return cut(unique.select("doc_id", F.col("toxic").cast("int").alias("toxic"), (F.pmod("h", F.lit(CALIBRATION)) == 0).alias("calibrates")))


def _counts(texts: DataFrame) -> DataFrame:
    """(feature, toxic, clean): texts of either kind that have a feature; the empty feature counts all features."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = {w.lower() for w in TOKEN.findall(text.as_py() or "")}
                features = words | {"^" + w[:PREFIX] for w in words if len(w) > PREFIX}
                by[toxic.as_py()].update(features)
                by[toxic.as_py()][""] += len(features)
        names = list(by[0].keys() | by[1].keys())
        for i in range(0, len(names), 50_000):
            part = names[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string())] + [pa.array([by[kind][f] for f in part], pa.int64()) for kind in (1, 0)],
                names=["feature", "toxic", "clean"],
            )

    rows = texts.select("text", "toxic").mapInArrow(counted, "feature string, toxic bigint, clean bigint")
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _lambda(shares: np.ndarray, scores: np.ndarray) -> float:
    """The positive solution of sum(shares exp(lambda scores)) = 1; 1 if there is none."""
    grown = lambda x: float(shares @ np.exp(x * scores)) - 1
    low, high = 1e-6, 1.0
    if shares @ scores >= 0:
        return 1.0
    while grown(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grown(middle) < 0 else (low, middle)
    return high


def _curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method with a small ridge; weights of evidence never fall below zero."""
    x = np.column_stack([np.ones(len(evidence)), evidence])
    for kept in ([0, 1, 2], [0, 1], [0, 2], [0]):
        part, w, ridge = x[:, kept], np.zeros(len(kept)), np.diag([1e-6] + [1e-2] * (len(kept) - 1))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            w = w + np.linalg.solve((part.T * (p * (1 - p))) @ part + ridge, part.T @ (toxic - p) - ridge @ w)
        if (w[1:] >= 0).all():
            break
    out = np.zeros(3)
    out[kept] = w
    return tuple(map(float, out))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from docs(doc_id, text) and labels(doc_id, toxic), both rows that may be learned from."""
    sample = _sampled(docs, labels)
    kinds = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return Model(curve=(30.0 if 1 in kinds else -30.0, 0.0, 0.0))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    counts = cut(_counts(texts.filter(~F.col("calibrates"))).filter(f"feature = '' OR toxic + clean >= {LEAST_TEXTS} AND toxic > 1"))
    total = counts.filter("feature = ''").first()
    if not total or not total["toxic"] or not total["clean"]:
        return Model(curve=(math.log(kinds[1] / kinds[0]), 0.0, 0.0))
    share = (F.col("toxic") + F.col("clean")) / (total["toxic"] + total["clean"])
    t, c = F.col("toxic") + PRIOR * total["toxic"] * share, F.col("clean") + PRIOR * total["clean"] * share
    odds = lambda y, n: F.log(y) - F.log(n * (1 + PRIOR) - y)
    weighed = counts.filter("feature <> ''").select(
        "feature", "clean", (odds(t, total["toxic"]) - odds(c, total["clean"])).alias("weight"), F.sqrt(1 / t + 1 / c).alias("error"),
        (t / (total["toxic"] * (1 + PRIOR))).alias("in_toxic"), (c / (total["clean"] * (1 + PRIOR))).alias("in_clean"),
    )
    best = (F.col("weight") / F.col("error")).desc()
    kept = weighed.filter(F.col("weight") > Z * F.col("error")).orderBy(best, "feature").limit(FEATURES).collect()
    model = Model({r["feature"]: r["weight"] for r in kept})
    shares = np.array([r["in_clean"] for r in kept])
    rest = max(1e-9, 1 - shares.sum())
    model.neutral = min(-1e-4, math.log(max(1e-9, 1 - sum(r["in_toxic"] for r in kept)) / rest))
    model.lam = _lambda(np.append(shares, rest), np.array([r["weight"] for r in kept] + [model.neutral]))
    return _calibrated(model, texts.filter("calibrates"))


def _calibrated(model: Model, texts: DataFrame) -> Model:
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.passages(t.as_py() or "") for t in batch["text"]]
            sums = [[total for _, _, total in found] for _, found in rows]
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"], pa.array([n for n, _ in rows], pa.int64()), pa.array(sums, pa.list_(pa.float64()))], names=["toxic", "n", "sums"]
            )

    own = texts.select("text", "toxic").mapInArrow(measured, "toxic int, n bigint, sums array<double>")
    rows = [(r["toxic"], r["n"], r["sums"]) for r in own.collect()]
    clean = [(n, max(sums, default=0.0)) for toxic, n, sums in rows if not toxic and n]
    decays = sum(n * math.exp(-model.lam * best) for n, best in clean)
    model.k = min(1.0, len(clean) / decays) if decays else 1.0
    above = [[x for s in sums if (x := model.excess(n, s)) > 0] for _, n, sums in rows]
    evidence = np.log1p(np.array([(max(x, default=0.0), sum(x)) for x in above]).reshape(-1, 2))
    toxic = np.array([float(t) for t, _, _ in rows])
    if 0 < toxic.sum() < len(toxic):
        model.curve = _curve(evidence, toxic)
    return model


def score(text: Column, model: Model) -> Column:
    """double: the score of a text."""
    shared = model

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array((shared.score(t.as_py() or "") for t in texts), pa.float64())

    return scored(text)


def passages(text: Column, model: Model) -> Column:
    """array<struct<start, end, score, excess>>: the significant passages of a text, in code points, end exclusive."""
    shared = model

    @F.arrow_udf(PASSAGES)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("excess", pa.float64())]))
        for texts in batches:
            out = []
            for t in texts:
                text = t.as_py() or ""
                n, segs = shared.passages(text)
                places = [m.span() for m in TOKEN.finditer(text)] if segs else []
                rows = [{"start": places[a][0], "end": places[b - 1][1], "score": s, "excess": shared.excess(n, s)} for a, b, s in segs]
                out.append([r for r in rows if r["excess"] > 0])
            yield pa.array(out, kind)

    return found(text)


def learnable(doc_id: Column) -> Column:
    """Whether a row may be learned from; the others are held out. Rows without a doc_id are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, held_out, score): every row of docs(doc_id, text) scored by a model of the learnable rows."""
    rows = docs.select("doc_id", "text")
    model = train(rows.filter(learnable(F.col("doc_id"))), labels.select("doc_id", "toxic").filter(learnable(F.col("doc_id"))))
    return rows.select("doc_id", "text", (~learnable(F.col("doc_id"))).alias("held_out"), score(F.col("text"), model).alias("score"))
