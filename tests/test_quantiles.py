"""Exact quantiles against sorted values, on columns that are hard for brackets."""

import random

import numpy as np
import pytest

from tidegrid.operators import distribution as X


@pytest.mark.parametrize("few,drawn", [(10_000, 10_000), (7, 10_000), (50, 150)])
def test_quantiles_equal_sorted_values(spark, monkeypatch, few, drawn):
    monkeypatch.setattr(X, "FEW", few)
    monkeypatch.setattr(X, "DRAWN", drawn)  # few: brackets often miss the rank
    rng = random.Random(1)
    n = 4001
    rows = [
        (
            rng.gauss(0, 1), float(i % 2), 5.0, rng.choice([0.0, 0.0, 0.0, rng.random()]),
            None if i % 3 else float(i), float("nan") if i % 5 == 0 else rng.random() ** 9, None,
        )
        for i in range(n)
    ]
    names = ["normal", "two", "one", "zeros", "gaps", "nans", "none"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    probs = [0.0, 0.25, 0.5, 0.9995, 1.0]
    got = {(r.feature, r.prob): r.value for r in X.exact_quantiles(df, names, probs).collect()}
    least = {(r.feature, r.prob): r.value for r in X.exact_quantiles(df, names, probs, "inverse").collect()}
    assert {c for c, _ in got} == set(names) - {"none"}
    for i, c in enumerate(names[:-1]):
        v = np.sort([r[i] for r in rows if r[i] is not None and r[i] == r[i]])
        for p in probs:
            assert got[c, p] == pytest.approx(np.quantile(v, p), abs=1e-12), (c, p)
            assert least[c, p] == v[max(0, int(np.ceil(round(p * len(v), 6))) - 1)]
