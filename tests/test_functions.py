import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crivo.functions import credit, distributions
from crivo.functions.hashing import hash32, uniforms
from crivo.functions.numeric import clip, logistic, round_half_even, unsigned_zero
from crivo.functions.uri import normalise_uri


def values(spark, data, expression, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_clip_keeps_missing_values(spark):
    got = values(spark, [None, float("nan"), -1.0, 5.0, 2.0], clip(F.col("x"), 0.0, 3.0))
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [0.0, 3.0, 2.0]


def test_rounding_ties_go_to_even(spark):
    assert values(spark, [250.0, 350.0, -250.0], round_half_even(F.col("x"), -2)) == [
        200.0, 400.0, -200.0,
    ]
    assert values(spark, [0.5, 1.5, 2.5], round_half_even(F.col("x"))) == [0.0, 2.0, 2.0]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.floats(-1e9, 1e9), min_size=30, max_size=60),
    st.sampled_from([-2, 0, 2, 3, 4]),
)
def test_rounding_is_that_of_numpy(spark, data, digits):
    got = values(spark, data, round_half_even(F.col("x"), digits))
    assert got == [float(v) for v in np.round(np.array(data), digits)]


def test_unsigned_zero(spark):
    got = values(spark, [-0.0, 0.0, -1.5, None], unsigned_zero(F.col("x")))
    assert math.copysign(1, got[0]) == 1 and got[1:] == [0.0, -1.5, None]


def test_logistic_saturates_without_error(spark):
    assert values(spark, [-1e4, 0.0, 1e4], logistic(F.col("x"))) == [0.0, 0.5, 1.0]


def test_instalment_without_interest_spreads_the_principal(spark):
    payment = credit.instalment(F.lit(1200.0), F.col("x"), F.lit(12))
    free, cheap = values(spark, [0.0, 1e-7], payment)
    assert free == 100.0 and cheap == pytest.approx(100.0, rel=1e-5)


def test_instalment_repays_the_loan(spark):
    (payment,) = values(spark, [0.02], credit.instalment(F.lit(1000.0), F.col("x"), F.lit(24)))
    balance = 1000.0
    for _ in range(24):
        balance = balance * 1.02 - payment
    assert balance == pytest.approx(0.0, abs=1e-6)


def test_commitment_without_income_is_missing(spark):
    got = values(spark, [0.0, 12.0, 1200.0, None], credit.commitment_ratio(F.lit(10.0), F.col("x")))
    assert got == [None, 3.0, 0.1, None]


def test_class_at_exactly_one_half(spark):
    got = values(spark, [0.5, 0.4999999, 1.0], credit.threshold_class(F.col("x")))
    assert got == [1, 0, 1]


def test_bernoulli(spark):
    assert values(spark, [0.2, 0.5, 0.9], credit.bernoulli(F.col("x"), F.lit(0.5))) == [1, 0, 0]


def test_unknown_label_raises(spark):
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException, match="label outside"):
        values(spark, [0, 2], credit.known_class(F.col("x"), (0, 1)), "bigint")


def test_draws_do_not_depend_on_partitions(spark):
    ids = spark.range(1000)
    draws = uniforms("t", 1, F.col("id"), 5)
    one = ids.coalesce(1).select("id", *draws).collect()
    five = ids.repartition(5).select("id", *draws).orderBy("id").collect()
    assert one == five
    flat = [v for r in one for v in r[1:]]
    assert 0 < min(flat) and max(flat) < 1
    assert np.mean(flat) == pytest.approx(0.5, abs=0.02)


def test_hash_is_the_start_of_md5(spark):
    import hashlib

    (got,) = spark.range(7, 8).select(hash32("label", F.col("id"))).first()
    assert got == int(hashlib.md5(b"label|7").hexdigest()[:8], 16)


def test_distributions_have_their_moments(spark):
    u = uniforms("m", 3, F.col("id"), 8)
    row = (
        spark.range(20000)
        .select(*[c.alias(f"u{i}") for i, c in enumerate(u)])
        .select(
            distributions.normal(F.col("u0"), F.col("u1"), 640.0, 90.0).alias("n"),
            distributions.beta([F.col(f"u{i}") for i in range(2, 6)], 2).alias("b"),
            distributions.poisson(F.col("u6"), 1.5).alias("p"),
            distributions.weighted_choice(F.col("u7"), [24, 36], [0.3, 0.7]).alias("w"),
        )
        .agg(F.avg("n"), F.stddev("n"), F.avg("b"), F.avg("p"), F.variance("p"), F.avg("w"))
        .first()
    )
    assert row[0] == pytest.approx(640, abs=3) and row[1] == pytest.approx(90, abs=2)
    assert row[2] == pytest.approx(0.4, abs=0.01)
    assert row[3] == pytest.approx(1.5, abs=0.05) and row[4] == pytest.approx(1.5, abs=0.1)
    assert row[5] == pytest.approx(32.4, abs=0.2)


@pytest.mark.parametrize(
    "uri, encoded, wanted",
    [
        ("file:///tmp/a%20b+c%25d/k.json", True, "/tmp/a b+c%d/k.json"),
        ("file:/tmp/a b+c%d/k.json", False, "/tmp/a b+c%d/k.json"),
        ("dbfs:/Volumes/c/s/v/k.json", True, "/Volumes/c/s/v/k.json"),
        ("s3a://a/k.json", True, "s3a://a/k.json"),
        ("s3a://b/k.json", True, "s3a://b/k.json"),
        ("hdfs://host/k.json", True, "hdfs://host/k.json"),
        ("/plain/100%.json", True, "/plain/100%.json"),
        (None, True, None),
    ],
)
def test_uri(spark, uri, encoded, wanted):
    assert values(spark, [uri], normalise_uri(F.col("x"), encoded), "string") == [wanted]


def test_instalment_of_a_tiny_rate_nears_the_plain_share(spark):
    rates = [(10.0**-e,) for e in range(8, 19)] + [(0.0,)]
    value = credit.instalment(F.lit(12_000.0), F.col("rate"), F.lit(24))
    found = spark.createDataFrame(rates, "rate double").select(value.alias("v")).collect()
    assert all(abs(r.v - 500.0) < 1e-3 for r in found)


@pytest.mark.parametrize("mean", [0.0, 1.5, 30.0, 60.0, 200.0])
def test_poisson_steps_reach_the_end_of_the_distribution(mean):
    from crivo.functions.distributions import poisson_steps

    steps = poisson_steps(mean)
    assert steps == sorted(steps) and 1.0 - steps[-1] < 2.0**-33
    assert mean == 0.0 or len(steps) > mean


def test_poisson_of_a_large_mean_raises():
    from crivo.functions.distributions import poisson_steps

    with pytest.raises(ValueError, match="Poisson"):
        poisson_steps(1e6)
