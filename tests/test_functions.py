import pytest
from pyspark.sql import functions as F

from sparkloom.functions import (
    by_bounds,
    cut_label,
    equal_width,
    impact_label,
    is_multi,
    member_list,
    sign_label,
    smallest_free_color,
)
from sparkloom.functions.labels import DIVERSITY_LABELS


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expr).collect()]


def test_by_bounds_edges(spark):
    values = [99.9, 100.0, 120.0, 120.1, 140.0, 140.1, None]
    got = column(spark, values, "double", by_bounds("x"))
    slow, medium, fast, very = (
        "Slow (<100 BPM)",
        "Medium (100-120 BPM)",
        "Fast (121-140 BPM)",
        "Very Fast (>140 BPM)",
    )
    assert got == [slow, medium, medium, fast, fast, very, very]


def test_by_bounds_needs_matching_lengths():
    with pytest.raises(ValueError):
        by_bounds("x", bounds=[1.0], labels=["a"], closed=[True])


def test_equal_width(spark):
    values = [-5, 0, 9, 10, 30, 70, 89, 90, 100, None]
    got = column(spark, values, "int", equal_width("x"))
    starts = [0, 0, 0, 1, 3, 7, 8, 9, 9, 9]
    assert got == [f"{s / 10:.1f}-{(s + 1) / 10:.1f}" for s in starts]


def test_labels(spark):
    differences = [5.1, 5.0, -5.0, -5.1, None]
    assert column(spark, differences, "double", impact_label(F.col("x"))) == [
        "Positive",
        "Neutral",
        "Neutral",
        "Negative",
        "Neutral",
    ]
    assert column(spark, [0.1, -0.1, 0.0, None], "double", sign_label(F.col("x"), "+-0")) == list(
        "+-00"
    )
    few, some, many = DIVERSITY_LABELS
    assert column(spark, [1, 2, 3, 5, 6], "int", cut_label(F.col("x"))) == [
        few,
        few,
        some,
        some,
        many,
    ]


def test_members(spark):
    values = ["A;B", "B;A", "A;", " A ; B\t;; ", "A", ";"]
    assert column(spark, values, "string", member_list("x")) == [
        ["A", "B"],
        ["B", "A"],
        ["A"],
        ["A", "B"],
        ["A"],
        [],
    ]
    assert column(spark, values, "string", is_multi("x")) == [True] * 4 + [False, True]
    assert column(spark, ["a.b", "a|b"], "string", member_list("x", ".")) == [["a", "b"], ["a|b"]]


def test_smallest_free_color(spark):
    values = [[], [0], [1], [0, 1, 2], [0, 2], [5, 0, 1]]
    assert column(spark, values, "array<int>", smallest_free_color("x")) == [0, 1, 0, 3, 1, 2]
