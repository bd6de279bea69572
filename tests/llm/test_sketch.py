import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from loadkeeper.llm import sketch
from loadkeeper.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, ODD


def hashed(text, width=sketch.WIDTH):
    words = (text or "").encode().lower().split()
    out = set()
    for i in range(max(1, len(words) - width + 1) if words else 0):
        h = 42
        for w in words[i : i + width]:
            h = xxhash.xxh64_intdigest(w, seed=h)
        out.add(h - 2**64 if h >= 2**63 else h)
    return out


def bottom(hashes):
    return sorted(hashes)[: sketch.SIZE]


def likeness(a, b):
    union = bottom(set(a) | set(b))
    return sum(h in a and h in b for h in union) / len(union) if union else 1.0


def test_sketches(odd):
    for r in odd.select("text", sketch.sketch(F.col("text")).alias("s")).collect():
        assert r["s"] == bottom(hashed(r["text"]))


def test_merging_is_sketching_the_whole(table, rows):
    dice = random.Random(1)
    texts = [" ".join(dice.choice("abcdefgh") * 2 for _ in range(n)) for n in (0, 3, 50, 400, 700)]
    df = table("g int, t string", *((i % 2, t) for i, t in enumerate(texts)), (None, None)).select("g", sketch.sketch(F.col("t")).alias("s"))
    merged = {r["g"]: r["sketch"] for r in sketch.merge_groups(df, "g", "s").collect()}
    assert merged == {g: bottom(set().union(*(hashed(t) for t in texts[g::2]))) for g in (0, 1)} | {None: []}
    one, other = (F.lit([*map(int, bottom(hashed(t)))]) for t in texts[3:])
    both = df.select(sketch.merge(one, other).alias("m"), sketch.containment(one, other).alias("c"), sketch.resemblance(one, other).alias("r")).first()
    assert both["m"] == bottom(hashed(texts[3]) | hashed(texts[4]))
    a, b = hashed(texts[3]), hashed(texts[4])
    assert abs(both["r"] - len(a & b) / len(a | b)) < 0.2 and abs(both["c"] - len(a & b) / len(a)) < 0.2


def test_number_of_shingles(table):
    text = " ".join(map(str, range(3000)))
    got = table("t string", (text,), ("a b c d e f g",), (None,)).select(sketch.distinct_shingles(sketch.sketch(F.col("t"))).alias("n"))
    many, few, none = (r["n"] for r in got.collect())
    assert abs(many - 2996) < 0.3 * 2996 and few == 3 and none == 0


def test_successors_over_wide_gaps(table, rows):
    ids = sorted({random.Random(2).randrange(-(2**62), 2**62) for _ in range(300)} | {0, 1, 2, 1 << 14, 1 << 28})
    df = table("key bigint", *((i,) for i in ids)).select(F.struct("key").alias("at"))
    got = rows(sketch.successors(df).select("at.key", F.col("next.key").alias("next")))
    assert got == sorted(zip(ids, ids[1:] + ids[:1]), key=repr)


def by_hand(rows):
    """The distinct rows in order, each with its edited text."""
    order = sorted({(sketch.NULL_KEY if i is None else i, xxhash.xxh64_intdigest((t or "").encode(), seed=42), t or "") for i, t in rows}, key=lambda r: (r[0], r[1] - 2**64 * (r[1] >= 2**63)))
    out = {}
    for (i, _, t), (_, _, following) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        out[i, t] = (t[: len(t) - half] + following[:half], following)
    return out


def test_edited_texts(odd):
    expected = by_hand(ODD)
    got = sketch.edited(odd).collect()
    assert len(got) == len(ODD)
    for r in got:
        text, following = expected[sketch.NULL_KEY if r["doc_id"] is None else r["doc_id"], r["text"]]
        assert r["edited"] == text and r["next_sketch"] == bottom(hashed(following))


def test_one_row_and_none(docs, nothing):
    assert sketch.edited(nothing).collect() == []
    assert [r["edited"] for r in sketch.edited(docs([(9, "abcde")])).collect()] == ["abcab"]


def test_query(spark, sample):
    expected, got = by_hand(sample[1]), QUERIES["op2_fingerprints"](spark, FOLDER).collect()
    texts = dict(sample[1])
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        edited, following = expected[r["doc_id"], text]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == ",".join(map(str, bottom(hashed(text))))
        assert r["edited_fingerprint"] == ",".join(map(str, bottom(hashed(edited))))
        assert abs(r["near_edited"] - likeness(hashed(text), hashed(edited))) < 1e-9
        assert abs(r["near_next"] - likeness(hashed(text), hashed(following))) < 1e-9


def test_main_path_has_no_python(spark, sample):
    plan = QUERIES["op2_fingerprints"](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
