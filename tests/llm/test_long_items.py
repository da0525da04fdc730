"""Long benchmark items are found at the limit of edits."""

import random

import pytest

from fleetlens.llm import decontaminate as D
from tests.llm.test_lines_and_leaks import plain_distance


@pytest.mark.parametrize("n", [64, 250, 1000])
def test_long_items_at_the_limit(n):
    rng = random.Random(n)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(n))) for i in range(20)]
    index = D.ItemIndex(items)
    for i, text in items:
        v = text.split()
        for p in sorted(rng.sample(range(n), D.edits_allowed(n)), reverse=True):
            v[p : p + rng.randrange(2)] = ["other"] * (rng.randrange(2) if i % 2 else 1)
        got = {m[0]: m for m in index.matches(" ".join(["a b c", *v, "d e f"]))}
        assert i in got and got[i][3] <= D.edits_allowed(n)


def test_columns_equal_the_plain_table():
    rng = random.Random(5)
    for _ in range(150):
        item = [rng.randrange(5) for _ in range(rng.randrange(1, 15))]
        words = [rng.randrange(5) for _ in range(rng.randrange(0, 30))]
        edits, first, last = D.best_fit_long(item, words, len(item))
        assert edits == plain_distance(item, words) == D.best_fit(item, words)[0]
        assert D.best_fit(item, words)[2] == last and D.best_fit(item, words[first:last])[0] == edits
