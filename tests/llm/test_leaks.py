import random
import re
from collections import Counter

from pyspark.sql import functions as F

from loadkeeper.llm import leaks
from loadkeeper.llm.queries import QUERIES
from tests.llm.conftest import FOLDER


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(w, width):
    return Counter(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else Counter()


def best(doc, item):
    """The highest similarity of any window of the item's length."""
    d, i = words(doc), words(item)
    width = min(5, len(i))
    if not d or not i:
        return 0.0
    wanted, top = shingles(i, width), 0.0
    if not shingles(d, width) & wanted:
        return top
    for s in range(max(1, len(d) - len(i) + 1)):
        own = shingles(d[s : s + len(i)], width)
        top = max(top, sum((own & wanted).values()) / sum((own | wanted).values()))
    return top


def by_hand(docs, items):
    return {(d, i): x for d, t in docs for i, u in items if (x := best(t, u)) >= leaks.SIMILARITY}


def found(df):
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in df.collect()}


def test_planted_passages(table):
    dice = random.Random(4)
    text = lambda n: [f"{dice.choice('bdfgk')}{dice.choice('aeiou')}{dice.randrange(60)}" for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate([1, 3, 4, 5, 6, 20, 30, 45, 60])]
    docs = [(100 + i, " ".join(text(80))) for i in range(5)]
    for i, item in items:
        w = item.split()
        docs += [(i, " ".join(text(30) + w + text(20))), (200 + i, " ".join(w)), (300 + i, "!! ".join(text(9) + w).upper())]
        if len(w) > 10:
            docs += [(400 + i, " ".join(text(9) + w[1:] + text(9))), (500 + i, " ".join(text(9) + w[: len(w) // 2] + text(30))), (600 + i, " ".join(w[2:] + text(40)))]
            docs += [(700 + i, " ".join(text(9) + w + w + w[:3])), (800 + i, " ".join(w[:-1]))]
    got = found(leaks.leaks(table("doc_id bigint, text string", *docs), table("item_id bigint, text string", *items)))
    expected = by_hand(docs, items)
    assert set(got) == set(expected) and all(abs(got[k] - x) < 1e-9 for k, x in expected.items())


def test_parts_in_another_order_in_the_middle_of_a_document(table):
    dice = random.Random(7)
    text = lambda n: [f"{dice.choice('bdfgk')}{dice.choice('aeiou')}{dice.randrange(60)}" for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate([16, 40, 48, 59, 59])]
    docs = []
    for i, item in items:
        w, at = item.split(), len(item.split()) // 2
        docs += [(i, " ".join(text(70) + w[at:] + w[:at] + text(70))), (10 + i, " ".join(text(30) + w[-15:] + w[:-15]))]
        docs += [(20 + i, " ".join(w[:5] + text(40) + w[5:] + text(3))), (30 + i, " ".join(w[at:] + text(1) + w[:at] + text(9)))]
    got = found(leaks.leaks(table("doc_id bigint, text string", *docs, *docs[:2]), table("item_id bigint, text string", *items)))
    expected = by_hand(docs, items)
    assert got.keys() == expected.keys() and {(3, 3), (4, 4), (13, 3)} <= got.keys()
    assert all(abs(got[k] - x) < 1e-9 for k, x in expected.items())


def test_starts_are_those_of_all_windows_with_enough_places(table):
    dice, rows = random.Random(8), []
    for k in range(200):
        total, size = dice.randrange(1, 40), dice.randrange(1, 25)
        rows.append((k, total, size, sorted(dice.sample(range(total), dice.randrange(total + 1)))))
    df = table("k int, total int, size int, places array<int>", *rows)
    for r in df.withColumn("starts", leaks._starts(F.col("places"), F.col("total"), F.col("size"))).collect():
        window = min(r["size"], r["total"])
        held = [sum(s <= p < s + window for p in r["places"]) for s in range(r["total"] - window + 1)]
        assert r["starts"] == [s for s, x in enumerate(held) if x / (window + r["size"] - x) >= leaks.SIMILARITY]


def test_fingerprints_within_the_radius_always_share_a_block(table):
    dice = random.Random(5)
    for _ in range(300):
        a = dice.getrandbits(64)
        b = a ^ sum(1 << i for i in dice.sample(range(64), leaks.RADIUS))
        assert min(((a ^ b) >> 8 * k & 255).bit_count() for k in range(8)) <= leaks.FLIPS


def test_simhash(table):
    dice = random.Random(6)
    hashes = [dice.getrandbits(64) - 2**63 for _ in range(9)] + [5, 5]
    got = table("h array<bigint>", (hashes,), ([],)).select(leaks.simhash(F.col("h")).alias("f")).collect()
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert got[0]["f"] % 2**64 == expected and got[1]["f"] == 0


def test_odd_rows(odd, nothing, table):
    items = table("item_id bigint, text string, n int, fp int", (1, "the same text of some words that go on", 1, 1), (2, None, 1, 1), (3, "", 1, 1), (None, "without an id", 1, 1))
    got = leaks.leaks(odd, items).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got), key=repr) == [(1, 1), (2, 1), (None, None)]
    assert leaks.leaks(nothing, items).collect() == [] and leaks.leaks(odd, items.limit(0)).collect() == []
    kept = leaks.clean(odd, items)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=repr) == [3, 4, 5, 6, None]


def test_query_and_its_plan(spark, sample):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    df = QUERIES["op5_decontamination"](spark, FOLDER)
    assert found(df).keys() == by_hand(sample[1], items).keys()
    plan = df._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
