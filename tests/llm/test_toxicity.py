import random

import pytest
from pyspark.sql import functions as F

from loadkeeper.llm import toxicity
from loadkeeper.llm.queries import QUERIES


def maximal(scores):
    """Maximal segments by definition: the best segment, then the best ones left and right of it."""

    def within(a, b):
        sums = [(sum(scores[i:j]), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        if not sums or max(sums)[0] <= 0:
            return []
        top = max(s for s, *_ in sums)
        _, i, j = max((j - i, i, j) for s, _, i, j in sums if s == top)
        return [*within(a, i), (i, j, top), *within(j, b)]

    return within(0, len(scores))


@pytest.mark.parametrize("seed", range(30))
def test_segments_are_the_maximal_ones(seed):
    dice = random.Random(seed)
    scores = [dice.uniform(-2, 2) for _ in range(dice.randrange(25))]
    got, expected = toxicity.segments(scores), maximal(scores)
    assert [s[:2] for s in got] == [s[:2] for s in expected]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, expected))


def test_segments_take_linear_time():
    falling = [x for i in range(100_000) for x in (1.0, -1.0 - 1e-6 * i)]
    assert len(toxicity.segments(falling)) == 100_000
    assert len(toxicity.segments([x for i in range(100_000) for x in (2.0, -1.0)])) == 1


@pytest.fixture(scope="module")
def made(spark):
    dice = random.Random(7)
    plain = [f"w{i}" for i in range(200)]
    bad = ["vile", "nasty", "rotten"]
    rows = []
    for i in range(800):
        words, toxic = [dice.choice(plain) for _ in range(dice.randrange(20, 120))], i % 5 == 0
        if toxic:
            at = dice.randrange(len(words))
            words[at:at] = [dice.choice(bad + plain[:3]) for _ in range(10)]
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic"), rows


def test_held_out_accuracy(made):
    docs, labels, rows = made
    truth = {i: t for i, _, t in rows}
    got = [r for r in toxicity.scored(docs, labels).collect() if r["held_out"]]
    right = sum((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in got)
    assert len(got) > 100 and right / len(got) > 0.97


def test_passages(made):
    docs, labels, _ = made
    model = toxicity.train(docs, labels)
    text = "w50 w60 " * 20 + "vile NASTY rotten vile" + " w70" * 30
    (r,) = docs.limit(1).select(toxicity.passages(F.lit(text), model).alias("p")).collect()
    assert [text[p["start"] : p["end"]] for p in r["p"]] == ["vile NASTY rotten vile"]


def test_odd_rows(odd, nothing, table, made):
    labels = table("doc_id bigint, toxic int, score int", (1, 1, 0), (1, 0, 0), (3, None, 0), (None, 1, 0), (4, 0, 0), (99, 0, 0))
    got = toxicity.scored(odd, labels)
    assert got.count() == odd.count() and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.scored(nothing, labels).collect() == []
    assert toxicity.scored(odd, labels.limit(0)).filter("score > 0.01").count() == 0
    scores = {r["text"]: r["score"] for r in odd.select("text", toxicity.score(F.col("text"), toxicity.train(*made[:2])).alias("score")).collect()}
    assert scores[None] == scores[""] < 0.3


def test_query(spark):
    folder = "/root/testdata/sf0.1"
    try:
        labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    except Exception:
        pytest.skip("sample data is not here")
    got = QUERIES["op7_toxicity"](spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    toxic, clean = ([s for s, t in held if t == kind] for kind in (1, 0))
    above = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / len(toxic) / len(clean)
    assert above > 0.93
