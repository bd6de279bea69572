import random

import pytest
import xxhash
from pyspark.sql import functions as F

from loadkeeper.llm import simhash
from loadkeeper.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, ODD
from tests.llm.test_components import by_hand as joined


def fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def classes(rows, distance=2):
    """{(doc_id, fingerprint): component} by comparing all pairs."""
    fps = sorted({fingerprint(t) for _, t in rows})
    root = dict(joined([(a, b) for a in fps for b in fps if a <= b and (a ^ b).bit_count() <= distance]))
    least = {}
    for i, t in rows:
        if i is not None:
            r = root[fingerprint(t)]
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{fingerprint(t):016x}", least.get(root[fingerprint(t)])) for i, t in rows), key=repr)


@pytest.mark.parametrize("distance", [1, 2, 3, 5])
def test_links_are_all_close_pairs(table, rows, distance):
    dice = random.Random(distance)
    fps = {0, 2**64 - 1} | {dice.getrandbits(64) for _ in range(40)}
    for x in list(fps)[:25]:
        for _ in range(8):
            fps.add(x ^ sum(1 << b for b in dice.sample(range(64), dice.randrange(1, distance + 3))))
    got = rows(simhash.links(table("fp bigint", *((signed(x),) for x in fps)), distance))
    assert got == sorted(((a, b) for a in map(signed, fps) for b in map(signed, fps) if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance), key=repr)


def test_distance_zero_links_equal_ones_only(table, rows):
    assert rows(simhash.links(table("fp bigint", (1,), (3,)), 0)) == []


def test_odd_rows(odd, rows):
    assert rows(simhash.near_duplicates(odd)) == classes(ODD)


def test_nothing_and_no_ids(nothing, docs, rows):
    assert rows(simhash.near_duplicates(nothing)) == []
    assert rows(simhash.near_duplicates(docs([(None, "a b c")])).select("component_id")) == [(None,)]


def test_a_very_long_text(docs, rows):
    text = " ".join(str(i % 977) for i in range(40_000))
    assert rows(simhash.near_duplicates(docs([(7, text)]))) == [(7, f"{fingerprint(text):016x}", 7)]


def test_one_of_each_group_stays(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 1, 3, 6]
    assert kept.filter(F.col("doc_id").isNull()).count() == 1


def test_query(spark, sample, rows):
    assert rows(QUERIES["op4_simhash_dedup"](spark, FOLDER)) == classes(sample[1])
