"""SF7: rounding of doubles equals Python's round on the exact value."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.rounding import py_round

NAMED = [0.0025, 2.6745, 2.675, 1.0005, 0.5, 1.5, 2.5, -2.5, 0.125, 0.375, -0.0625, 1e-9, 4.999e-4, 5e-4, 0.0005000000000000001,
         0.00097656, 2.0**-10, 2.0**-11, 2.0**52, 2.0**52 - 0.5, 2.0**53 + 2, 1e300, -1e300, 0.0, -0.0, 4503599627370495.5,
         8.999e12, 9007199254740.9995, 1234567.0005, 5e-324]


def doubles():
    rng = random.Random(7)
    out = list(NAMED)
    for _ in range(3000):
        out.append(rng.choice([1, -1]) * rng.randrange(10**9) / 10 ** rng.randrange(8))
    for _ in range(1500):  # a tie of the decimal text, above or below it in binary
        out.append((2 * rng.randrange(10**6) + 1) / 2 / 10 ** rng.randrange(4))
    for _ in range(1500):
        x = struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0]
        out.append(x if math.isfinite(x) else 0.0)
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_py_round_equals_python(spark, n):
    df = spark.createDataFrame([(x,) for x in doubles()], "x double").repartition(4)
    wrong = [(r.x, r.y) for r in df.select("x", py_round("x", n).alias("y")).collect() if r.y != round(r.x, n)]
    assert wrong == []


def test_py_round_of_nothing_and_of_no_number(spark):
    df = spark.createDataFrame([(None,), (math.nan,), (math.inf,), (-math.inf,)], "x double")
    got = [r.y for r in df.select(py_round(F.col("x"), 3).alias("y")).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [math.inf, -math.inf]
    with pytest.raises(ValueError, match="0 to 3"):
        py_round("x", 4)


def test_spark_rounding_differs_where_the_text_ties(spark):
    """Why py_round exists: the shortest text of a double is not its value."""
    row = spark.range(1).select(F.bround(F.lit(2.6745), 3).alias("b"), py_round(F.lit(2.6745), 3).alias("p")).first()
    assert (row.b, row.p) == (2.674, 2.675)
