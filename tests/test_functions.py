"""Native column functions on hand-derived cases."""

import pytest
from pyspark.sql import functions as F

from folioscope.functions import refs, text, vectors
from folioscope.operators import images


def values(spark, rows, kind, *columns):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], f"k int, x {kind}")
    return [tuple(r) for r in df.orderBy("k").select(*columns).collect()]


def test_display(spark):
    x = F.col("x")
    assert values(spark, ["  　 ", "abcdef", "a \n b", None], "string", text.snippet(x, 4)) == [("(no text)",), ("abc…",), ("a b",), ("(no text)",)]
    bars = values(spark, [-0.2, 0.5, 1.4, 2.5 / 14], "double", text.score_bar(x))
    assert [b[0].count("█") for b in bars] == [0, 7, 14, 2] and all(len(b[0]) == 14 for b in bars)
    assert values(spark, ["a" * 70, "b c"], "string", text.label(x)) == [("a" * 63 + "…",), ("b c",)]
    assert values(spark, ["abcdef"], "string", text.shown(x, 3), text.shown(x, 3, full=True), text.shown(x, 0))[0][1:] == ("abcdef", "abcdef")
    assert values(spark, ["abcdef"], "string", text.shown(x, 3, 2))[0][0].startswith("abc\n\n…[truncated — run `show 2 full`")


def test_headings(spark):
    x = F.col("x")
    assert values(spark, ["\n\n  a b \nc", "", "##\n# Two"], "string", text.first_line(x)) == [("a b",), ("",), ("##",)]
    assert values(spark, ["t\n## \n### Three", "x"], "string", text.first_heading(x)) == [("Three",), ("",)]
    assert values(spark, ["```\n# setup\n```\n# Real", "## no", "#x\n # y "], "string", text.first_h1(x)) == [("setup",), (None,), ("y",)]


def test_references(spark):
    x = F.col("x")
    scope = ["", "/x.png", "#x", "http://x", "{{x}}.png", "HTTP://x/y.png", "{x}.png", "a/b.png", "mailto:a", "//c"]
    assert [v for v, (ok,) in zip(scope, values(spark, scope, "string", refs.in_scope(x))) if ok] == ["HTTP://x/y.png", "{x}.png", "a/b.png"]
    assert values(spark, ["a.PNG", "a.tiff", "a.txt", "png", ".png", "d.x/y"], "string", refs.supported(x)) == [(True,), (True,), (False,), (False,), (False,), (False,)]
    assert values(spark, ['p.png "t"', "p q.png", "p.png 't\""], "string", refs.without_title(x)) == [("p.png",), ("p q.png",), ("p.png",)]
    assert values(spark, ["./x.png", "../y/./z.png", "../../../w"], "string", refs.resolved(F.lit("a/b"), x)) == [("a/b/x.png",), ("a/y/z.png",), ("w",)]


def test_vectors(spark):
    x = F.col("x")
    rows = [[3.0, 4.0], [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    found = values(spark, rows, "array<double>", vectors.norm(x), vectors.cosine(x, F.array(F.lit(3.0), F.lit(4.0))), vectors.finite(x))
    assert found[0][0] == 5 and found[0][1] == pytest.approx(1) and found[1][:2] == (0, 0)
    assert [f[2] for f in found] == [True, True, False, False]
    assert values(spark, [[0.0, 0.0]], "array<double>", vectors.normalised(x)) == [([0.0, 0.0],)]


def test_image_arithmetic(spark):
    x = F.col("x")
    size = values(spark, [8193, 100], "int", vectors.resized(x, F.lit(10), 4096))
    assert [tuple(s[0]) for s in size] == [(4096, 5, True), (100, 10, False)]
    assert [tuple(s[0]) for s in values(spark, [1, 4, 5, 53], "int", vectors.grid(x))] == [(1, 1), (2, 2), (3, 2), (8, 7)]
    assert images.target_size(8193, 10, 4096) == (4096, 5, True) and images.grid_shape(5) == (3, 2)
