"""The scale-minded join forms against the plain (brute-force) Spark joins
on small random inputs with null keys, duplicate keys and orphans."""

import random
from datetime import datetime, timedelta

import pytest

from conftest import rows
from postlens.operators import joins as J


def _random_sides(spark, seed, n_left=120, n_right=90, keys=6, span=400):
    rnd = random.Random(seed)
    base = datetime(2024, 3, 10, 1, 58, 0)

    def key():
        return None if rnd.random() < 0.2 else f"k{rnd.randrange(keys)}"

    left = [(f"l{i}", key(), base + timedelta(seconds=rnd.uniform(0, span))) for i in range(n_left)]
    right = [(f"r{i}", key(), base + timedelta(seconds=rnd.uniform(-60, span))) for i in range(n_right)]
    left.append(("lnull_t", "k1", None))
    right.append(("rnull_t", "k1", None))
    l = spark.createDataFrame(left, "lid string, lk string, lt timestamp_ntz")
    r = spark.createDataFrame(right, "rid string, rk string, rt timestamp_ntz")
    return l, r


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_interval_join_matches_bruteforce(spark, how, null_safe, seed):
    l, r = _random_sides(spark, seed)
    lower, upper = 0, 60
    out = J.interval_join(l, r, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
                          lower=lower, upper=upper, how=how, null_safe=null_safe)
    key = l.lk.eqNullSafe(r.rk) if null_safe else (l.lk == r.rk)
    from postlens.functions.time import seconds
    cond = key & (l.lt >= r.rt + seconds(lower)) & (l.lt <= r.rt + seconds(upper))
    brute = l.join(r, cond, {"full": "full_outer", "left": "left_outer", "right": "right_outer",
                             "inner": "inner"}[how])
    assert rows(out, "lid", "rid") == rows(brute, "lid", "rid")


def test_interval_join_negative_lower_and_small_bucket(spark):
    l, r = _random_sides(spark, 7)
    out = J.interval_join(l, r, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
                          lower=-30, upper=45, how="full", bucket_seconds=10)
    from postlens.functions.time import seconds
    cond = (l.lk == r.rk) & (l.lt >= r.rt + seconds(-30)) & (l.lt <= r.rt + seconds(45))
    assert rows(out, "lid", "rid") == rows(l.join(r, cond, "full_outer"), "lid", "rid")


@pytest.mark.parametrize("seed", [3, 4])
def test_full_outer_join_matches_native(spark, seed):
    l, r = _random_sides(spark, seed, keys=4)
    ours = J.full_outer_join(l, r, "lk", "rk")
    native = l.join(r, l.lk == r.rk, "full_outer")
    assert rows(ours, "lid", "lk", "rid", "rk") == rows(native, "lid", "lk", "rid", "rk")


def test_full_outer_using_key(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, a int")
    b = spark.createDataFrame([("x", 10), ("z", 30), (None, 40)], "k string, b int")
    out = J.full_outer_join(a, b, "k", coalesce_key=True)
    assert out.columns == ["k", "a", "b"]
    assert rows(out) == sorted([("x", 1, 10), ("y", 2, None), (None, 3, None), ("z", None, 30),
                                (None, None, 40)], key=repr)


@pytest.mark.parametrize("tz", ["America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("typ", ["timestamp_ntz", "timestamp"])
def test_interval_join_across_dst_in_any_zone(spark, tz, typ):
    """Buckets come from zone-free epoch seconds: a daylight-saving jump in
    the session zone (the fixtures straddle 2024-03-10 02:00) loses no pair."""
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", tz)
        l, r = _random_sides(spark, 9)
        l = l.withColumn("lt", l.lt.cast(typ))
        r = r.withColumn("rt", r.rt.cast(typ))
        out = J.interval_join(l, r, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
                              lower=0, upper=60, how="full", null_safe=True)
        from postlens.functions.time import seconds
        cond = l.lk.eqNullSafe(r.rk) & (l.lt >= r.rt + seconds(0)) & (l.lt <= r.rt + seconds(60))
        assert rows(out, "lid", "rid") == rows(l.join(r, cond, "full_outer"), "lid", "rid")
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_every_spelling_of_a_join_kind():
    for kind, names in {"inner": ["inner", "INNER"], "left": ["left", "left_outer", "leftOuter", "leftouter"],
                        "right": ["right", "rightOuter", "right_outer", "rightouter"],
                        "full": ["full", "outer", "fullOuter", "full_outer", "fullouter"]}.items():
        assert {J._norm_how(n) for n in names} == {kind}
    with pytest.raises(ValueError):
        J._norm_how("anti")
