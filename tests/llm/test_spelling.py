import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loadkeeper.llm import spelling


def is_near(a, b):
    """A single inserted, deleted or replaced code point, by trying them all."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(counts):
    """{word: (form, root, n, n_near, form_n)} from all pairs of words."""
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def shown(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def words_table(table, counts):
    return table("word string, n bigint", *counts.items())


@pytest.fixture
def dense():
    """Words over few letters, so that many are near, with a suffix that a third of them share."""
    dice = random.Random(5)
    out = {}
    while len(out) < 500:
        size = dice.randrange(4, 8)
        word = "".join(dice.choice("abé") for _ in range(size)) + ("tionen" if len(out) % 3 == 0 else "".join(dice.choice("ab") for _ in range(4)))
        out[word] = dice.choice([2, 3, 20, 21, 300, 4000])
    return out


def expected_near(counts):
    hand = by_hand(counts)
    out = {}
    for w, (_, _, n, hits, _) in hand.items():
        vs = [v for v in counts if is_near(w, v)]
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        out[w] = (n, hits, counts[best] if best else None, best)
    return out


@pytest.mark.parametrize("block, together", [(512, 128), (16, 4)])
def test_near_words_against_all_pairs(table, dense, monkeypatch, block, together):
    """Also with buckets cut into many blocks."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "TOGETHER", together)
    got = spelling.neighbours(words_table(table, dense))
    assert {r["word"]: (r["n"], r["n_near"], r["best_n"], r["best"]) for r in got.collect()} == expected_near(dense)


def test_a_large_bucket_is_spread_over_tiles(table, dense, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 8)
    tiles = spelling.tiles(words_table(table, dense)).groupBy("longest", "by_end", "key", "a", "b").count()
    largest = tiles.agg(F.max("count")).first()[0]
    assert largest <= 60 and tiles.count() > 1000


def test_very_long_words(table):
    a = "ab" * 20_000
    counts = {a: 50, a[:7000] + "x" + a[7001:]: 5, a + "y": 2, a[1:]: 4, a[:-2] + "zz": 3}
    got = spelling.neighbours(words_table(table, counts))
    assert {r["word"]: (r["n"], r["n_near"], r["best_n"], r["best"]) for r in got.collect()} == expected_near(counts)


def test_chains_end_at_their_root(table, rows):
    names = [f"w{i}" for i in range(18)]
    links = table("word string, form string", *zip(names, names[1:]))
    assert rows(spelling.roots(links)) == sorted(((n, names[-1]) for n in names[:-1]), key=repr)
    assert spelling.roots(links.limit(0)).collect() == []


def test_letters_counts_and_ties(docs):
    text = " ".join(["abcdefgh"] * 40 + ["abcdefgx"] * 3 + ["abcdefgy"] * 40 + ["Straße_straße", "LONGWORD longWORD", "ÉCOLIERS écoliers", "kürzer"] * 2)
    df = docs([(i, text) for i in (1, 1, 2)] + [(3, None), (None, "")])
    counts = Counter()
    for i in (1, 1, 2):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    got = shown(spelling.variants(df))
    assert got == by_hand(counts)
    assert {"Écoliers", "écoliers", "longword", "straße"} & set(got) == {"Écoliers", "écoliers", "longword"}  # only A-Z are lowered
    assert got["abcdefgx"][0] == "abcdefgh"  # of two forms as common the first


def test_odd_rows(odd, nothing):
    assert spelling.variants(nothing).collect() == []
    got = shown(spelling.variants(odd))
    assert got == {} or all(n >= 2 and len(w) >= 7 for w, (_, _, n, _, _) in got.items())
    assert spelling.variants(odd).columns == ["word", "form", "root", "n", "n_near", "form_n"]
