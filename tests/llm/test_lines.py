import random
import tracemalloc

import numpy as np

from loadkeeper.llm import lines
from loadkeeper.llm.queries import QUERIES
from tests.llm.conftest import FOLDER
from tests.llm.test_components import by_hand as joined


def shingles(line):
    raw = line.encode().lower()
    return {raw[i : i + lines.SHINGLE].ljust(lines.SHINGLE, b"\0") for i in range(max(1, len(raw) - lines.SHINGLE + 1))}


def by_hand(docs):
    """{(doc_id, place)} of the lines to drop, from all pairs of lines that share a shingle."""
    found = sorted({(i, k, s) for i, t in docs if i is not None for k, x in enumerate((t or "").split("\n")) if (s := x.strip(lines.BLANKS))})
    texts = sorted({s for *_, s in found})
    sets, holding = [shingles(s) for s in texts], {}
    for n, own in enumerate(sets):
        for x in own:
            holding.setdefault(x, []).append(n)
    pairs = {(a, b) for ns in holding.values() if len(ns) < 2000 for k, a in enumerate(ns) for b in ns[k:]}
    near = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= lines.SIMILARITY]
    root = dict(joined(near + [(n, n) for n in range(len(texts))]))
    number, kept, gone = {s: n for n, s in enumerate(texts)}, {}, set()
    for i, k, s in found:
        if kept.setdefault(root[number[s]], (i, k)) != (i, k):
            gone.add((i, k))
    return gone


def dropped(df):
    return {(r["doc_id"], g["place"]) for r in df.collect() for g in r["gone"]}


def test_shingles_and_similarity():
    texts = [b"", b"short", b"exactly8", b"a somewhat longer line of text", "längere zeile".encode()]
    values, starts = lines.shingles(texts)
    for text, a, b in zip(texts, starts, [*starts[1:], len(values)]):
        assert {v.tobytes() for v in values[a:b]} == shingles(text.decode())
    assert lines.jaccard(texts[3], texts[3]) == 1 and lines.jaccard(texts[2], texts[3]) == 0
    a, b = "one line of text that is long enough", "one line of text that is long enougH!"
    assert abs(lines.jaccard(a.lower().encode(), b.lower().encode()) - len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))) < 1e-12


def test_bands_meet_as_often_as_they_should():
    dice, met = np.random.default_rng(1), 0
    for _ in range(100):
        line = bytes(dice.integers(97, 123, 200).astype(np.uint8))
        other = line[:95] + b"0" + line[96:]
        assert lines.jaccard(line, other) > 0.9
        met += bool((lines.band_keys([line]) == lines.band_keys([other])).any())
    assert met >= 99
    assert not (lines.band_keys([b"an entirely different line of text"]) == lines.band_keys([line])).any()


def test_variants_chains_and_copies(docs):
    dice = random.Random(3)
    word = lambda: "".join(dice.choice("abcdefghij") for _ in range(dice.randrange(3, 9)))
    rows, line = [], [word() for _ in range(40)]
    for i in range(60):  # a chain: each differs a little from the one before, and much from the first
        line[dice.randrange(40)] = word()
        rows.append((i, " ".join(line) + "\n" + " ".join(word() for _ in range(9))))
    rows += [(100 + i, "  one line that many documents hold  \n\n" + word() + " " + word()) for i in range(50)]
    rows += [(200, "own\nown\nOWN\n own"), (201, None), (202, ""), (None, "one line that many documents hold"), (203, rows[0][1]), (203, rows[0][1])]
    df = docs(rows)
    gone, expected = dropped(lines.drops(df)), by_hand(rows)
    assert gone == expected and len(gone) > 100
    kept = {r["doc_id"]: r["text"] for r in lines.dedup(df).select("doc_id", "text").collect()}
    assert lines.dedup(df).columns == df.columns
    assert kept[200] == "own" and kept[201] is None and kept[202] == "" and kept[None] == rows[-3][1]
    assert 203 not in kept and kept[100] == rows[60][1]
    for i, t in rows[61:110]:
        assert kept[i] == "\n".join(t.split("\n")[1:])


def test_odd_rows(odd, nothing):
    assert dropped(lines.drops(odd)) == {(2, 0)}
    assert lines.drops(nothing).collect() == [] and lines.dedup(nothing).collect() == []


def test_query(spark, sample):
    expected = by_hand(sample[1])
    got = QUERIES["op9_line_dedup"](spark, FOLDER).collect()
    lengths = {i: len((t or "").split("\n")) for i, t in sample[1]}
    assert {r["doc_id"]: r["n_lines"] for r in got} == lengths
    gone = {(r["doc_id"], int(p)) for r in got for p in r["dropped"].split(",") if p}
    assert gone <= expected and len(gone) >= 0.99 * len(expected)
    assert all(r["n_dropped"] == len([p for p in r["dropped"].split(",") if p]) for r in got)


def test_long_lines_in_little_memory(monkeypatch):
    """512 near copies of a line of 20 KB, compared a part of the shingles at a time: as exact, and under 150 MB."""
    dice = random.Random(6)
    base = dice.choices(b"abcdefgh ", k=20_000)

    def variant(edits):
        out = list(base)
        for _ in range(edits):
            out[dice.randrange(len(out))] = dice.choice(b"xyz")
        return bytes(out)

    few = [variant(e) for e in (0, 5, 40, 120, 250, 300)] + [b"short", b"shorter", bytes(dice.choices(b"abc", k=900))]
    exact = {(i, k) for i, a in enumerate(few) for k, b in enumerate(few) if i < k and lines.jaccard(a, b) >= lines.SIMILARITY}
    pairs = lambda: set(zip(*map(list, np.triu(lines.similar(few), 1).nonzero())))
    assert pairs() == exact
    monkeypatch.setattr(lines, "BYTES", 3_000)
    assert pairs() == exact != set()
    monkeypatch.undo()
    many = [variant(20) for _ in range(512)]
    tracemalloc.start()
    found = lines.linked(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 511 and peak < 150 << 20
