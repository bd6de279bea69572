import random

import pytest

from loadkeeper.llm.components import components


def by_hand(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return sorted(((x, find(x)) for x in root), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(table, rows, seed):
    dice = random.Random(seed)
    links = [(dice.randrange(60) - 20, dice.randrange(60) - 20) for _ in range(40)]
    links = [(a, b) for a, b in links if a != b]
    assert rows(components(table("a bigint, b bigint", *links))) == by_hand(links)


def test_a_path_and_a_hub(table, rows):
    links = [(i, i + 1) for i in range(30)] + [(1000, 1001 + i) for i in range(200)]
    assert rows(components(table("a bigint, b bigint", *links))) == by_hand(links)


def test_nulls_loops_and_nothing(table, rows):
    assert rows(components(table("a bigint, b bigint", (None, 1), (2, None), (3, 3)))) == []
    assert rows(components(table("a bigint, b bigint"))) == []
