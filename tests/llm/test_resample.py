import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadkeeper.llm import resample

TEXTS = ["One two, three!", "", None, "Zwölf Boxkämpfer jagen Viktor", "a-b_c 1x2 \0 x\x7fy", "ÀÉ İ 日本 語", "x" * 200 + " " + "y" * 47 + " " + "z" * 48 + " " + "q" * 49, " . "]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def by_hand(docs, target):
    """[(doc_id, n_features, weight, score, rank)] of every document."""
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(features(x))
    for x in target:
        t.update(features(x))
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for i, x in docs:
        f = features(x)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((len(words(x)), i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[0] >= 20), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    drawn = {}
    for place, r in enumerate(order[: len(order) * 5 // 100], 1):
        drawn.setdefault(r, []).append(place)
    return [(*r[1:], drawn[r].pop() if drawn.get(r) else None) for r in rows]


def shown(df):
    return [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()]


def test_features_are_checksums_of_joined_words():
    for texts in ([t or "" for t in TEXTS], [""], []):
        bucket, owner, counts = resample.features([t.encode() for t in texts]) if texts else (np.zeros(0), np.zeros(0), [])
        for n, text in enumerate(texts):
            assert Counter(bucket[owner == n].tolist()) == Counter(features(text)) and counts[n] == len(words(text))


def test_draw_against_brute_force(docs, table):
    dice = random.Random(2)
    vocabulary = ["".join(dice.choice("abcdeé") for _ in range(3)) for _ in range(40)]
    rows = [(i, " ".join(dice.choice(vocabulary) for _ in range(dice.randrange(5, 60)))) for i in range(400)]
    rows += [(1000 + i, TEXTS[i]) for i in range(len(TEXTS))]
    target = [" ".join(vocabulary[:20]), None, ""]
    got = shown(resample.resample(docs(rows), table("item_id int, text string, bucket int", *((i, t, 0) for i, t in enumerate(target)))))
    assert sorted(got, key=repr) == sorted(by_hand(rows, target), key=repr)
    assert sum(r[4] is not None for r in got) == sum(len(words(t)) >= 20 for _, t in rows) * 5 // 100 > 5


def test_repeated_rows_and_ties(docs, table):
    """A third of all rows are one row: each is drawn for itself, and equal keys do not stop the search."""
    text = " ".join(f"word{i}" for i in range(25))
    rows = [(7, text)] * 100 + [(i, text + f" more{i}") for i in range(200)] + [(None, text)] * 3
    got = shown(resample.resample(docs(rows), table("text string", (text,))))
    hand = by_hand(rows, [text])
    assert sorted(got, key=repr) == sorted(hand, key=repr)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 303 * 5 // 100 + 1))


@pytest.mark.parametrize("parts", [1, 7])
def test_quickselect_and_ranks(spark, parts):
    dice = random.Random(1)
    values = [dice.choice([dice.randrange(50), dice.randrange(10**6), 13]) for _ in range(2000)]
    rows = spark.createDataFrame([(v, i % 9) for i, v in enumerate(values)], "score bigint, doc_id bigint").repartition(parts)
    rows = rows.withColumn("key", resample.composite("score", "doc_id"))
    order = sorted(((v, i % 9) for i, v in enumerate(values)), key=lambda r: (-r[0], r[1]))
    for k in (1, 2, 100, 700, 1999, 2000):
        pivot = resample.select_kth(rows, k)
        found = rows.filter(F.col("key") == pivot).select("score", "doc_id").first()
        assert tuple(found) == order[k - 1]
    assert resample.select_kth(rows, 0) is None and resample.select_kth(rows, 2001) is None
    ranks = {r["rank"]: (r["score"], r["doc_id"]) for r in resample.ranked(rows, F.col("key")).collect()}
    assert [ranks[i] for i in range(1, 2001)] == order


def test_odd_rows(odd, nothing, table):
    target = table("text string", ("some words",))
    assert resample.resample(nothing, target).collect() == []
    got = resample.resample(odd, target.limit(0))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and got.count() == odd.count()
    assert all(r["weight"] == 0 and r["n_features"] == 0 for r in got.filter("doc_id IN (3, 4, 5)").collect())
