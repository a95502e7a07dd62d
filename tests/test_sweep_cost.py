"""What the forest sweep sends and walks: few copies of a tree, few passes, and no way walked twice."""

import numpy as np
import pytest

from stopline.models import grove
from stopline.session import compiled_methods


def test_a_tree_is_sent_once_for_two_million_rows():
    """A tree grows with its rows: copies of it for each quarter of a million rows grew with their square."""
    assert grove.PART_ROWS >= 1 << 21 and grove.GROUP_ROWS >= 1 << 20


def small_tree(rng, width, size, depth):
    """Feature, mask and children of a random tree whose leaves lie at different depths."""
    feature, mask, child, todo = [], [], [], [0]
    while todo:
        d = todo.pop(0)
        inner = d == 0 or (d < depth and rng.random() < 0.8)
        feature.append(rng.integers(width) if inner else -1)
        mask.append(rng.random(size) < 0.5)
        child.append([0, 0])
        if inner:
            child[-1] = [len(feature) + len(todo), len(feature) + len(todo) + 1]
            todo += [d + 1, d + 1]
    return np.array(feature, np.int16), np.array(mask), np.array(child)


def plain_walk(x, feature, mask, child, node=0):
    way = []
    while feature[node] >= 0:
        way.append(node)
        node = child[node][0 if mask[node][x[feature[node]]] else 1]
    return node, way


@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_walks_and_the_nodes_that_ask_first(kind):
    rng = np.random.default_rng(3)
    for _ in range(5):
        feature, mask, child = small_tree(rng, 4, 6, 7)
        x, z = rng.integers(0, 6, (2, 80, 4)).astype(kind)
        asked = np.full(x.shape, -1, np.int64)
        end = grove.walk(np.zeros(80, np.int64), x, feature, mask, child, asked)
        ways = [plain_walk(r, feature, mask, child) for r in x]
        assert end.tolist() == [e for e, _ in ways]
        for i, (_, way) in enumerate(ways):
            for j in range(4):
                assert asked[i, j] == next((n for n in way if feature[n] == j), -1)
        row, column = np.nonzero((asked >= 0) & (x != z))
        got = grove.walk(asked[row, column], x, feature, mask, child, None, row, (column, z[row, column]))
        for i, j, e in zip(row, column, got):
            other = x[i].copy()
            other[j] = z[i, j]
            assert e == plain_walk(other, feature, mask, child)[0]


def test_upper_nodes_count_as_a_whole_tree_does():
    """Sums of two kinds in one come apart exactly, also for many copies."""
    rng = np.random.default_rng(4)
    w, y, cell = rng.integers(1, 9, 5000), rng.integers(0, 2, 5000), rng.integers(0, 40, 5000)
    weight, ones = grove.apart(np.bincount(cell, w * (1.0 + grove.BOTH * y), 50))
    assert weight.tolist() == np.bincount(cell, w, 50).tolist() and ones.tolist() == np.bincount(cell, w * y, 50).tolist()


def test_the_setting_of_the_session_comes_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError):
        with compiled_methods(spark):
            assert spark.conf.get(name) == "8000"
            1 / 0
    assert spark.conf.get(name) == before
