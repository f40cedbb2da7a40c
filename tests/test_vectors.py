from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from citeloom.functions.vectors import cosine

NAN = float("nan")

CASES = [
    ([1.0, 2.0], [2.0, 1.0], 0.8),
    ([1.0, 2.0, 3.0], [1.0, 2.0], 0.597614),
    (None, [1.0], 0.0),
    ([1.0], None, 0.0),
    (None, None, 0.0),
    ([], [1.0], 0.0),
    ([0.0, 0.0], [1.0, 0.0], 0.0),
    ([1.0, None], [1.0, 1.0], 0.0),
    ([1.0, 1.0], [None, 1.0], 0.0),
    ([NAN, 1.0], [1.0, 1.0], 0.0),
    ([1.0, 0.0], [-1.0, 0.0], -1.0),
    ([1e-200], [1e-200], 0.0),
]


def test_cosine_edge_cases(spark):
    rows = [(n, a, b) for n, (a, b, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "n int, a array<double>, b array<double>")
    got = {r.n: r.c for r in df.select("n", cosine(F.col("a"), F.col("b")).alias("c")).collect()}
    for n, (_, _, want) in enumerate(CASES):
        assert got[n] == pytest.approx(want, abs=1e-6), CASES[n]


def test_overflowing_norm_gives_nan(spark):
    df = spark.createDataFrame([([1e200], [1e200])], "a array<double>, b array<double>")
    assert math.isnan(df.select(cosine(F.col("a"), F.col("b")).alias("c")).first().c)


def test_cosine_against_plain_python(spark):
    rng = random.Random(5)
    rows = [([rng.gauss(0, 1) for _ in range(9)], [rng.gauss(0, 1) for _ in range(rng.choice([5, 9]))]) for _ in range(60)]
    df = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(rows)], "n int, a array<double>, b array<double>")
    got = {r.n: r.c for r in df.select("n", cosine(F.col("a"), F.col("b")).alias("c")).collect()}
    for n, (a, b) in enumerate(rows):
        want = sum(x * y for x, y in zip(a, b)) / (math.hypot(*a) * math.hypot(*b))
        assert got[n] == pytest.approx(want, abs=1e-12)
        assert -1 - 1e-9 <= got[n] <= 1 + 1e-9
