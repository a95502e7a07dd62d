"""Mixing with more levels than any bound: every source is raked to its own marginal."""

import numpy as np
import pytest

from stopline.llm import mixing


@pytest.fixture(scope="module")
def many(spark):
    """200 sources of very different sizes in three languages, some rows without id, text or source."""
    rng = np.random.RandomState(4)
    rows = [(i, "word " * int(rng.randint(1, 40)), ["en", "fr", "xx"][rng.randint(3)],
             f"s{min(int(rng.pareto(0.7)), 199)}") for i in range(6000)]
    rows += [(6000 + i, "word " * 5, "en", f"s{i}") for i in range(200)]
    rows += [(None, f"text {i} without id", "en", None) for i in range(300)] + [(9000, None, None, "s1"), (9000, None, None, "s1")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)


def marginal(rows, axis):
    return (rows["n_tokens"] * rows["weight"]).groupby(rows[axis]).sum()


def brute(rows, targets=None):
    """Fitted weights by plain loops over a dictionary of cells."""
    cells = {}
    for s, lang, t, n in zip(rows["source"], rows["lang"], rows["topic"], rows["n_tokens"]):
        cells[s, lang, t] = cells.get((s, lang, t), 0) + n
    total = sum(cells.values())
    x = {c: float(n) for c, n in cells.items()}
    for _ in range(400):
        for k, axis in enumerate(mixing.AXES):
            have, tokens = {}, {}
            for c in cells:
                have[c[k]] = have.get(c[k], 0) + x[c]
                tokens[c[k]] = tokens.get(c[k], 0) + cells[c]
            goal = {v: (targets[axis].get(v, 0.0) if targets and axis in targets else max(n, 1) ** mixing.TEMPERATURES[axis]) * (n > 0)
                    for v, n in tokens.items()}
            scale = total / sum(goal.values())
            x = {c: v * (goal[c[k]] * scale / have[c[k]] if have[c[k]] else 1) for c, v in x.items()}
    return {c: x[c] / cells[c] if cells[c] else 0.0 for c in cells}


@pytest.mark.parametrize("cells", [mixing.CELLS, 10])
def test_two_hundred_sources(many, monkeypatch, cells):
    """As arrays, and as a table raked in Spark."""
    monkeypatch.setattr(mixing, "CELLS", cells)
    rows = mixing.mix_rows(many).toPandas()
    assert rows["source"].nunique() > 64 and "(null)" in set(rows["source"])
    want = brute(rows)
    for r in rows.itertuples():
        assert r.weight == pytest.approx(want[r.source, r.lang, r.topic], rel=1e-4, abs=1e-6)
        assert r.probability <= 1
    assert abs((rows["probability"] * rows["n_tokens"]).sum() / rows["n_tokens"].sum() - mixing.BUDGET) < 1e-3


def test_targets_of_small_sources(many):
    # marginals that these two sources can meet together
    targets = {"source": {"s150": 3.0, "s151": 1.0, "absent": 5.0}, "lang": {"en": 1.0}, "topic": {"note": 1.0}}
    rows = mixing.mixed(many, targets=targets).select("mix.*").toPandas()
    have = marginal(rows, "source")
    assert have["s150"] == pytest.approx(3 * have["s151"], rel=1e-4)
    assert have.drop(["s150", "s151"]).abs().max() == 0
    assert set(rows[rows["kept"]]["source"]) == {"s150", "s151"}


def test_documents_without_id_are_drawn_one_by_one(many):
    rows = mixing.mixed(many, budget=0.2).where("doc_id is null").select("mix.*").toPandas()
    assert rows["probability"].nunique() == 1 and rows["probability"].iat[0] < 0.6
    assert abs(rows["kept"].mean() - rows["probability"].iat[0]) < 0.15
