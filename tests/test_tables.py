"""Table operators on hand-made rows: nulls, ties, empty groups, NaN."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import cohort, collab, consistency, outlier, profile, quality, sweetspot, topk


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# cleaning


@pytest.fixture(scope="module")
def dirty(spark):
    data = [
        ("a", 0.0, 1.0),
        (None, 0.5, 0.5),
        ("b", None, 0.5),
        ("c", -0.1, 0.5),
        ("d", 0.5, 1.1),
        ("e", 1.1, -0.1),
        ("f", math.nan, 0.2),
        ("g", 0.3, None),
    ]
    return spark.createDataFrame(data, "k string, x double, y double")


RANGES = quality.unit_ranges(["x", "y"])


def test_probe(dirty):
    assert rows(quality.probe(dirty, ["k"], RANGES)) == [(8, 1, 3, 2, 4)]


def test_cleaning_steps(dirty):
    kept = quality.drop_null(dirty, ["k", "x"])
    assert [r[0] for r in rows(kept, "k")] == ["a", "c", "d", "e", "g"]
    assert [r[0] for r in rows(quality.filter_ranges(kept, RANGES))] == ["a"]
    report = quality.clean_report(dirty, ["k", "x"], RANGES).first()
    assert report["rows_in"] == 8 and report["removed_null"] == 3
    assert report["rows_out"] == quality.clean(dirty, ["k", "x"], RANGES).count() == 1
    assert report["removed_range"] == 4 and report["removed_total"] == 7


def test_float_boundaries(spark):
    df = spark.createDataFrame([(0.8,), (0.3,), (1.0,)], "x float")
    # A 32-bit 0.8 is above the 64-bit 0.8, and 0.3 is not below 0.3.
    assert df.filter(F.col("x") > F.lit(0.8)).count() == 2
    assert df.filter(F.col("x") < F.lit(0.3)).count() == 0
    assert quality.filter_ranges(df, {"x": (0, 1)}).count() == 3


def test_require_rows(spark):
    with pytest.raises(ValueError):
        quality.require_rows(spark.range(0))


# profiles


@pytest.fixture(scope="module")
def mixed(spark):
    data = [(1, 1.0, "a", True), (2, -0.0, "a", False), (2, 0.0, None, None), (None, 4.0, "b", True)]
    return spark.createDataFrame(data, "`odd name` int, x double, s string, f boolean")


def test_profile_counts(mixed):
    got = {r["column"]: tuple(r)[1:] for r in profile.profile_counts(mixed).collect()}
    assert got == {
        "odd name": ("integer", 4, 1, 3, 3),
        "x": ("double", 4, 0, 4, 3),
        "s": ("string", 4, 1, 3, 3),
        "f": ("boolean", 4, 1, 3, 3),
    }


def test_profile_counts_of_odd_values(spark):
    nan, zero = float("nan"), 0.0
    rows = [
        (nan, bytearray(b"a"), [1, None], (None, 1), "null"),
        (nan, bytearray(b"A"), [1], (None, 1), "null"),
        (zero, None, None, None, None), (-zero, bytearray(b"a"), [1, None], (1, None), "NULL"),
    ]
    schema = "d double, b binary, a array<int>, s struct<x:int,y:int>, t string"
    df = spark.createDataFrame(rows, schema)
    got = {r["column"]: tuple(r)[2:] for r in profile.profile_counts(df).collect()}
    three = (4, 1, 3, 3)
    assert got == {"d": (4, 0, 4, 2), "b": three, "a": three, "s": three, "t": three}
    sketched = profile.profile_counts(df, approximate=True).collect()
    assert {r["column"]: tuple(r)[2:] for r in sketched} == got
    empty = profile.profile_counts(df.limit(0)).collect()
    assert {tuple(r)[2:] for r in empty} == {(0, 0, 0, 0)} and len(empty) == 5


def test_profile_counts_needs_no_expand(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    plan = profile.profile_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("HashAggregate(keys=[number") >= 4


def test_profile_numeric(mixed):
    got = {r["column"]: r for r in profile.profile_numeric(mixed).collect()}
    assert set(got) == {"odd name", "x"}
    assert got["odd name"]["mean"] == pytest.approx(5 / 3)
    assert got["odd name"]["p50"] == 2 and got["x"]["max"] == 4.0
    assert got["x"]["stddev"] == pytest.approx(1.892969)


def test_percentiles_stay_within_their_tolerance(spark):
    n = 50_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("x"))
    got = profile.profile_numeric(df, accuracy=1000).first()
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert abs(got[name] - share * n) <= n / 1000


def _passes(monkeypatch):
    passes = []
    real = profile._count_digits
    monkeypatch.setattr(profile, "_count_digits", lambda *a: passes.append(1) or real(*a))
    return passes


@pytest.mark.parametrize(
    "values",
    [
        "exp(id / 4)",
        "CAST(id % 2 AS double)",
        "CAST(id < 1000 AS double)",
        "CAST(0.1 * (id % 11) AS double)",
        "7.5D",
        "IF(id % 2 = 0, 0.0D, -0.0D)",
        "IF(id % 3 = 0, double('NaN'), IF(id % 3 = 1, double('Infinity'), double('-Infinity')))",
        "IF(id % 5 = 0, CAST(id AS double), 1.0D)",
    ],
)
def test_exact_percentiles_take_few_passes(spark, monkeypatch, values):
    df = spark.range(2000).selectExpr(f"{values} AS x")
    shares = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    clean = sorted(r["x"] for r in df.collect() if not math.isnan(r["x"]))
    passes = _passes(monkeypatch)
    got = profile.exact_percentiles(df, ["x"], shares)
    assert got == {("x", p): clean[max(1, math.ceil(p * len(clean))) - 1] for p in shares}
    assert len(passes) <= 5


def test_digits_of_doubles(spark):
    powers = [math.ldexp(1.0, e) for e in range(-1074, 1024)]
    around = {math.nextafter(x, y) for x in powers for y in (0.0, math.inf)} | set(powers)
    values = [(x,) for x in around | {-x for x in around if x}]
    rows = profile._exponents(spark.createDataFrame(values, "x double")).collect()
    assert len(rows) == len(values)
    for r in rows:
        pattern = struct.unpack("<q", struct.pack("<d", abs(r["x"])))[0] >> 52
        assert r["digit"] == (-pattern if r["x"] < 0 else pattern)
    for some in (1.5, -1.5, 2.0**-1040, -(2.0**-1040), 1.5 * 2.0**900, 2.0**-1022):
        near = [some]
        for _ in range(50):
            near.append(math.nextafter(near[-1], math.copysign(math.inf, some)))
        unit, one, factor = profile._scale(some)
        bits = ((F.col("x") / unit - one) * factor).cast("long")
        got = spark.createDataFrame([(x,) for x in near], "x double").select("x", bits).collect()
        for x, found in got:
            pattern = struct.unpack("<q", struct.pack("<d", abs(x)))[0] % 2**52
            assert found == (-pattern if x < 0 else pattern)


def test_exact_percentiles(spark):
    rng = random.Random(1)
    spread = [rng.choice([-1, 1]) * 10 ** rng.uniform(-8, 9) for _ in range(700)]
    special = [math.inf, -math.inf, 1.7e308, -1.7e308, math.nan, None, 0.0, 0.5]
    same = [3.0] * 708
    df = spark.createDataFrame(list(zip(spread + special, same)), "x double, y double")
    df = df.withColumn("none", F.lit(None).cast("double"))
    shares = (0.0, 0.001, 0.25, 0.5, 0.77, 1.0)
    got = profile.exact_percentiles(df, ["x", "y", "none"], shares)
    clean = sorted(v for v in spread + special if v is not None and not math.isnan(v))
    for p in shares:
        assert got["x", p] == clean[max(1, math.ceil(p * len(clean))) - 1]
        assert got["y", p] == 3.0 and got["none", p] is None


def test_profile_top_values_drops_null_after_ranking(spark):
    data = [("a",)] * 3 + [(None,)] * 2 + [("c",)] * 2 + [("b",)] * 2 + [("d",)]
    df = spark.createDataFrame(data, "s string")
    assert rows(profile.profile_top_values(df, k=3), F.desc("value_count"), "value") == [
        ("s", "a", 3),
        ("s", "b", 2),
    ]


def test_profile_boolean(mixed, spark):
    (got,) = rows(profile.profile_boolean(mixed))
    assert got[:3] == ("f", 2, 1) and got[3] == pytest.approx(200 / 3)
    empty = spark.createDataFrame([(None,)], "f boolean")
    assert rows(profile.profile_boolean(empty)) == [("f", 0, 0, None, None)]


# flags and cohorts


@pytest.fixture(scope="module")
def flagged(spark):
    data = [
        ("up", True, 30, 0.9),
        ("up", False, 10, 0.1),
        ("down", True, 10, 0.2),
        ("down", False, 30, 0.4),
        ("same", True, 15, 0.5),
        ("same", False, 10, 0.5),
        ("only_on", True, 90, 0.7),
        ("null_flag", None, 50, 0.7),
        (None, True, 1, 0.1),
        (None, False, 90, 0.3),
    ]
    return spark.createDataFrame(data, "g string, f boolean, s int, v double")


def test_flag_impact(flagged):
    impact = cohort.flag_impact(flagged, by="g", flag="f", score="s")
    assert rows(impact, "g") == [
        ("down", 10.0, 30.0, -20.0, "Negative"),
        ("same", 15.0, 10.0, 5.0, "Neutral"),
        ("up", 30.0, 10.0, 20.0, "Positive"),
    ]
    assert rows(cohort.flag_impact_counts(impact)) == [(1, 1, 1)]
    assert rows(cohort.flag_impact_top(impact, by="g"), "impact") == [
        ("Negative", 1, "down", -20.0),
        ("Positive", 1, "up", 20.0),
    ]


def test_flag_impact_top_limits_each_side(spark):
    data = [(f"g{i:02}", f, 100 + (i if f else 0)) for i in range(-30, 30) for f in (True, False)]
    df = spark.createDataFrame(data, "g string, f boolean, s int")
    impact = cohort.flag_impact(df, by="g", flag="f", score="s", threshold=2)
    top = cohort.flag_impact_top(impact, by="g", k=3).orderBy("impact", "rank").collect()
    assert [(r["impact"], r["difference"]) for r in top] == [
        ("Negative", -30.0),
        ("Negative", -29.0),
        ("Negative", -28.0),
        ("Positive", 29.0),
        ("Positive", 28.0),
        ("Positive", 27.0),
    ]


def test_flag_by_bucket_and_pattern(flagged, spark):
    buckets = cohort.flag_by_bucket(flagged, score="s", flag="f", value="v")
    got = {r["bucket"]: r for r in buckets.collect()}
    assert got["0.9-1.0"]["pattern"] == "Explicit_More_Positive"
    assert got["0.5-0.6"]["pattern"] == "Neutral" and got["0.5-0.6"]["flag_count"] == 0
    # 0.0-0.1 and 0.5-0.6 have one side only; 0.1-0.2 and 0.3-0.4 have both.
    (row,) = rows(cohort.dominant_pattern(buckets, n=3))
    assert row == ("Explicit_More_Positive", 2, False) or row[1] >= 2
    none = buckets.filter("bucket = 'x'")
    assert rows(cohort.dominant_pattern(none)) == [("", 0, False)]


def test_dominant_pattern_tie_goes_to_first_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "pattern string")
    assert rows(cohort.dominant_pattern(df, n=2)) == [("a", 2, True)]


def test_mode_per_group(spark):
    data = [(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")]
    df = spark.createDataFrame(data, "g int, v string")
    assert rows(cohort.mode_per_group(df, by="g", value="v"), "g") == [(1, "a", 2), (2, "z", 1)]


def test_two_cohorts(spark):
    data = [("x", 0.9, 0.9, 10), ("x", 0.9, 0.8, 99), ("y", 0.1, 0.2, 40), ("z", 0.2, 0.1, 60)]
    df = spark.createDataFrame(data, "g string, a double, b double, s int")
    groups = cohort.two_cohorts(df, by="g", features=["a", "b"], score="s")
    assert [(r[0], r[1], r[2], r[5]) for r in rows(groups, "cohort", "g")] == [
        ("high", "x", 10.0, 1),
        ("low", "y", 40.0, 1),
        ("low", "z", 60.0, 1),
    ]
    assert rows(cohort.two_cohorts_summary(groups)) == [(1, 10.0, 2, 50.0, -40.0, "Negative")]
    lone = groups.filter("cohort = 'low'")
    assert rows(cohort.two_cohorts_summary(lone)) == [(0, None, 2, None, None, None)]
    with pytest.raises(ValueError):
        cohort.two_cohorts(df, by="g", features=["a"], score="s", high=0.2, low=0.3)


# members


@pytest.fixture(scope="module")
def credits(spark):
    data = [
        ("A;B", 50),
        ("A;B", 70),
        ("B;A", 10),
        ("X;Y", 5),
        ("X;Y", 5),
        (" C ; A", 8),
        ("A", 20),
        ("A", 40),
        ("B", 30),
        ("C", 90),
        ("D", None),
        ("D;E", 1),
        (None, 7),
    ]
    return spark.createDataFrame(data, "m string, s int")


def test_collab(credits):
    roles = dict(members="m", score="s")
    top = collab.top_groups(credits, k=3, **roles)
    assert [r[:2] for r in rows(top)] == [("A;B", 2), ("X;Y", 2), (" C ; A", 1)]
    solo = {r[0]: r[1] for r in rows(collab.solo_avg(credits, **roles))}
    assert solo == {"A": 30.0, "B": 30.0, "C": 90.0, "D": None}
    got = {r["m"]: r for r in collab.boost(credits, k=10, **roles).collect()}
    # A and B tie at 30; the first listed wins.
    assert (got["A;B"]["weakest_member"], got["A;B"]["boost"]) == ("A", 30.0)
    assert got["B;A"]["weakest_member"] == "B"
    assert got["X;Y"]["boost"] is None and got["D;E"]["boost"] is None
    assert got[" C ; A"]["weakest_member"] == "A"
    (summary,) = rows(collab.summary(credits, **roles))
    assert summary == (7, pytest.approx((30 - 20 - 22) / 3), False)


def test_collab_summary_without_groups(spark):
    df = spark.createDataFrame([("A", 1)], "m string, s int")
    assert rows(collab.summary(df, members="m", score="s")) == [(0, 0.0, False)]


# standouts


def test_outlier(spark):
    data = [
        ("weak", "hit", 90, 1.0),
        ("weak", "rest", 0, 0.5),
        ("weak", "null", None, 9.0),
        ("strong", "hit", 95, 1.0),
        ("strong", "rest", 60, 0.1),
        ("edge", "at80", 80, 0.2),
        ("edge", "low", 1, 0.3),
        (None, "hit", 99, 1.0),
        (None, "low", 0, 1.0),
    ]
    df = spark.createDataFrame(data, "album string, t string, s int, e double")
    hits = outlier.items_vs_group(df, by="album", score="s", keep=["t"])
    assert rows(hits) == [("hit", "weak", 90, 45.0)]
    gap = outlier.feature_gap(df, by="album", score="s", features=["e"])
    assert rows(gap) == [(1.0, 0.5, 0.5)]


# sweet spots


def test_sweetspot(spark):
    data = [
        ("g1", 90.0, 10),
        ("g1", 110.0, 30),
        ("g1", 150.0, 30),
        ("g2", 90.0, 50),
        ("g2", 95.0, None),
        ("g3", 100.0, 1),
    ]
    df = spark.createDataFrame(data, "g string, tempo double, s int")
    roles = dict(by="g", score="s", x="tempo", top=2)
    best = sweetspot.best_bucket(df, **roles)
    got = {r["g"]: tuple(r)[1:] for r in best.collect()}
    assert got["g2"] == (50.0, "Slow (<100 BPM)", 50.0, None)
    assert got["g1"][1:] == ("Medium (100-120 BPM)", 30.0, 20.0)
    assert got["g1"][0] == pytest.approx(70 / 3)
    assert rows(sweetspot.summary(best)) == [(2, 20.0, True)]
    stats = sweetspot.bucket_stats(df, **roles)
    assert stats.filter("g = 'g2'").select("row_count", "avg_x").collect() == [(2, 92.5)]
    none = best.filter("g = 'none'")
    assert rows(sweetspot.summary(none)) == [(0, 0.0, False)]


# consistency


def test_consistency(spark):
    data = [("even", 10 + i % 2, "k1" if i else "k2") for i in range(6)]
    data += [("wide", 10 * i, f"k{i}") for i in range(7)]
    data += [("flat", 5, "k")] * 9 + [("few", 1 + i, "k") for i in range(4)]
    data += [("quiet", i % 2, "k") for i in range(8)] + [("even;wide", 3, "k")] * 9
    df = spark.createDataFrame(data, "a string, s int, c string")
    ranked = consistency.rank_entities(df, entity="a", score="s")
    assert [r[0] for r in rows(ranked)] == ["even", "wide"]
    full = consistency.diversity(df, entity="a", score="s", category="c")
    got = {r["a"]: r for r in full.collect()}
    assert got["even"]["primary_category"] == "k1" and got["even"]["category_count"] == 2
    assert got["even"]["primary_percentage"] == pytest.approx(500 / 6)
    assert got["wide"]["primary_category"] == "k0" and got["wide"]["diversity"] == "Highly_Diverse"
    assert rows(consistency.diversity_summary(full)) == [(1, 0, 1, 50.0, False)]
    nobody = full.filter("a = 'x'")
    assert rows(consistency.diversity_summary(nobody)) == [(0, 0, 0, 0.0, False)]


# top k


def test_topk(spark):
    data = [("g", 1, 60000, 0.9, 10), ("g", 2, 120000, 0.9, 20), ("h", 3, 120000, 0.81, 30)]
    data += [("h", 4, 999999, 0.8, 99), ("g", 5, None, 0.9, 99), (None, 6, 999999, 0.9, 99)]
    df = spark.createDataFrame(data, "g string, id int, d int, f double, s int")
    roles = dict(by="g", score="s", rank_by="d", feature="f")
    top = topk.top_vs_group(df, k=2, keep=["id"], **roles)
    got = {r["id"]: r for r in top.collect()}
    assert set(got) == {2, 3}
    assert got[2]["d_units"] == 2.0 and got[2]["group_avg_score"] == 43.0
    assert got[3]["score_vs_group"] == 30 - 64.5
    everything = (10 + 20 + 30 + 99 + 99) / 5
    assert rows(topk.top_vs_all(df, k=2, keep=["id"], **roles)) == [
        (25.0, everything, 25.0 - everything)
    ]
    none = df.filter("f > 5")
    assert rows(topk.top_vs_all(none, **roles)) == [(0.0, 0.0, 0.0)]


def test_topk_settles_ties(spark):
    df = spark.createDataFrame([(i, 7) for i in range(50)], "id int, v int").repartition(7)
    assert [r[0] for r in rows(topk.top_k(df, [F.desc("v")], 3, ["id"]))] == [0, 1, 2]
