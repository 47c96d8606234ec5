"""Greatest common divisors take as many steps as their numbers need, and no fixed many."""

import math

from pyspark.sql import functions as F

from terrafold.functions import dialect


def test_gcd_and_lcm(spark):
    fib = [1, 1]
    while fib[-1] < 2**61:
        fib.append(fib[-1] + fib[-2])
    pairs = [*zip(fib, fib[1:]), *zip(fib[1:], fib), (0, 0), (0, 7), (7, 0), (-12, 18), (12, -18), (10**18, 10**9), (99999, 100000), (5, None), (None, 5), (None, 0), (2**63 - 1, 2**62)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a long, b long")
    got = {r["k"]: r["g"] for r in df.select("k", dialect.gcd(F.col("a"), F.col("b")).alias("g")).collect()}
    assert got == {k: None if None in p else math.gcd(*p) for k, p in enumerate(pairs)}
    assert df.where("k = 0").select(dialect.lcm(F.lit(4), F.lit(6)).alias("x")).first()["x"] == 12
    assert "sequence(1, 93" not in df.select(dialect.gcd(F.col("a"), F.col("b")))._jdf.queryExecution().analyzed().toString()
