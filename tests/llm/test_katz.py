import math
from collections import Counter, defaultdict

import pytest

from loadkeeper.llm import katz
from loadkeeper.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, ODD


class ByHand:
    """The model from plain counts."""

    def __init__(self, texts):
        self.words, self.pairs, self.contexts, self.after = Counter(), Counter(), Counter(), defaultdict(set)
        for w in texts:
            self.words.update(w)
            for a, b in zip(["start", *w], w):
                self.pairs[a, b] += 1
                self.contexts[a] += 1
                self.after[a].add(b)
        self.total = sum(self.words.values())
        self.d1, n1 = self.discounts(self.words)
        self.d2, _ = self.discounts(self.pairs)
        left = sum((1 - self.d1[r]) * r * n1[r] for r in range(1, 6))
        self.whole = self.total if left > 0 else self.total + 1
        self.unknown = (left or 1) / self.whole
        self.backoffs = {}

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        m, out = 6 * n[6] / n[1] if n[1] else 1.0, {}
        for r in range(1, 6):
            d = ((r + 1) * n[r + 1] / n[r] / r - m) / (1 - m) if n[r] and m < 1 else 0
            out[r] = d if 0 < d < 1 else 1 - 1 / (2 * r)
        return out, n

    def alone(self, w):
        c = self.words[w]
        return self.d1.get(c, 1) * c / self.whole if c else self.unknown

    def backoff(self, a):
        if a not in self.backoffs:
            left = sum((1 - self.d2[c]) * c for b in self.after[a] if (c := self.pairs[a, b]) <= 5)
            whole = self.contexts[a] if left > 0 else self.contexts[a] + 1
            self.backoffs[a] = (left or 1) / whole / (1 - sum(map(self.alone, self.after[a]))), whole
        return self.backoffs[a]

    def after_word(self, a, b):
        if not self.contexts[a]:
            return self.alone(b)
        weight, whole = self.backoff(a)
        c = self.pairs[a, b]
        return self.d2.get(c, 1) * c / whole if c else weight * self.alone(b)


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def compare(docs, rows):
    learned = lambda i: i is not None and katz.learned_rows(i)
    model = ByHand([tokens(t) for i, t in docs if learned(i)])
    expected = []
    for i, t in docs:
        w = tokens(t)
        base = sum(math.log10((model.words[x] + 1) / (model.total + len(model.words) + 1)) for x in w)
        score = sum(math.log10(model.after_word(a, b)) for a, b in zip(["start", *w], w))
        known = sum(model.words[x] > 0 for x in w)
        expected.append((i, not learned(i), len(w), known, model.total, round(base, 6) + 0.0, round(score, 6) + 0.0))
    got = [(*tuple(r)[:5], round(r["base_score"], 6) + 0.0, round(r["score"], 6) + 0.0) for r in rows]
    for a, b in zip(sorted(got, key=repr), sorted(expected, key=repr), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-4 and abs(a[6] - b[6]) < 1e-4
    return model


def test_many_blocks_and_parts(spark, sample, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK", 20_000)
    monkeypatch.setattr(katz, "WORD_PART", 100_000)
    monkeypatch.setattr(katz, "PAIR_PART", 60_000)
    model = compare(sample[1], katz.score(sample[0], katz.learned_rows).collect())
    for context in ["start", *list(model.after)[:20]]:
        total = sum(model.after_word(context, w) for w in model.words) + model.after_word(context, "never seen")
        assert abs(total - 1) < 1e-9


def test_query(spark, sample):
    compare(sample[1], QUERIES["op8_language_model"](spark, FOLDER).collect())


def test_odd_rows(odd, nothing):
    compare(ODD, katz.score(odd, katz.learned_rows).collect())
    assert katz.score(nothing, katz.learned_rows).collect() == []


def test_nothing_learned(odd):
    got = katz.score(odd, lambda i: False).collect()
    assert len(got) == len(ODD) and all(r["score"] == r["base_score"] == 0 and r["held_out"] and r["train_tokens"] == 0 for r in got)


@pytest.mark.parametrize("counts", [[0] * 6, [10, 0, 0, 0, 0, 0], [5, 9, 1, 1, 1, 9], [100, 40, 20, 10, 5, 2]])
def test_discounts_are_proper(counts):
    assert all(0 < d < 1 for d in katz.discounts(counts)[1:])
