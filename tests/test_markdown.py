"""Article rules: hand-derived cases, and properties of random articles."""

import json
import random
import sys

import pytest

from folioscope.functions import markdown as m

CLEANED = [
    ("import X from 'x'", ""),
    ("foo <!-- c --> bar", "foo\n\n bar"),
    ("a --> b <!-- c -->", "a --> b\n\n b <!-- c -->"),
    ("export your settings\nrest of it", "rest of it"),
    ("<Callout>Hi</Callout>", "Hi"),
    ("<Card><Note>x</Note></Card>", "<Note>x</Note>"),
    ("<Card><B>x</B></Card>", "**x**"),
    ('<Link to="/x"> go </Link>', "go"),
    ('<a href="u"><b>t</b></a>', "[**t**](u)"),
    ("{foo}", ""),
    ("a {foo}", "a {foo}"),
    ("a\n\n\n\n\nb", "a\n\n\nb"),
    ("x < b and c > d", "x ** d"),
    ("a<br/>b<u>c</u><em>d</em><div>e</div>", "a\nbc*d*e"),
    ("x{props.a.b}>y", "y"),
]


@pytest.mark.parametrize(("body", "content"), CLEANED)
def test_cleaning(body, content):
    assert m.clean(body) == content


def test_fences_are_kept():
    body = "t\n```js\n<X />\n{y}\n```\nu"
    assert m.clean(body) == "t\n\n```js\n<X />\n{y}\n```\n\nu"
    assert m.chunks("```\na\n````\nb") == [("fence", "```\na\n````\nb\n")]
    assert m.chunks("```x```\na") == [("fence", "```x```\na\n")]
    assert m.chunks("~~~\na\n~~~ \nb") == [("fence", "~~~\na\n~~~ \n"), ("text", "b\n")]


def test_comments():
    assert "b" in m.clean("x <!-- a --> y <!-- b --> z")
    assert m.chunks("a\n<!-- x\ny") == [("text", "a\n"), ("comment", "<!-- x\ny")]
    assert m.chunks("<!-- x\ny --> z\nw") == [("comment", "<!-- x\ny -->"), ("text", " z\nw\n")]


@pytest.mark.parametrize(
    ("body", "found"),
    [
        ("![a](p_(1).png)", ["p_(1).png"]),
        ('![a](p.png "t")', ["p.png"]),
        ("[![a](i.png)](big.png)", ["i.png"]),
        ("![a](no-close\n![b](c.png)", ["c.png"]),
        ("```\n![a](x.png)\n```\n<!-- ![b](y.png) -->![c](z.png)", ["z.png"]),
        ("![a](x.png) ![a](x.png)", ["x.png", "x.png"]),
    ],
)
def test_image_destinations(body, found):
    assert [m.dest_without_title(d) for d in m.image_dests(m.effective_body(body))] == found


def front(text):
    own = m.frontmatter(text)
    return own["title"], own["body"], json.loads(own["meta_json"]), own["error"] is not None


def test_frontmatter():
    pytest.importorskip("yaml")
    assert front("---\ntitle: T\n---\nbody") == ("T", "body", {}, False)
    assert front("---\nno close") == ("", "---\nno close", {}, False)
    assert front("---\n[a\n---\nbody") == ("", "body", {}, True)
    assert front("---\n- a\n---\nbody") == ("", "body", {}, False)
    assert front("------\nbody")[1] == "body"
    assert front("---\ntitle: 5\npath: x\n---\n  b")[:2] == ("5", "  b")
    assert m.frontmatter("---\nb: 2023-01-02\na: [1, é]\n---\n")["meta_json"] == '{"a": [1, "é"], "b": "2023-01-02"}'
    assert front("---\nd: 2023-02-31\n---\nb")[3]
    assert front("---\non: 1\nx: .nan\n---\nb")[2] == {"True": 1, "x": None}


def test_frontmatter_without_yaml_is_an_error(monkeypatch):
    monkeypatch.setitem(sys.modules, "yaml", None)
    assert front("no block") == ("", "no block", {}, False)
    with pytest.raises(ImportError):
        front("---\ntitle: T\nlist:\n- a\n---\nbody")


def test_random_articles_keep_fences_and_clean_the_same_twice():
    r = random.Random(7)
    parts = ["text\n", "```\n<A />\n```\n", "<!-- c -->\n", "{x}\n", "<B>y</B>\n", "![i](j.png)\n", "import z\n", "\n\n\n\n"]
    for _ in range(300):
        body = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        kinds = m.chunks(body)
        assert m.clean(body) == m.clean(body)
        for kind, chunk in kinds:
            if kind == "fence":
                assert chunk.strip("\n") in m.clean(body)
        assert m.effective_body(body) == "".join(t for k, t in kinds if k == "text")


def test_udfs_agree_with_functions(spark):
    from pyspark.sql import functions as F

    bodies = [b for b, _ in CLEANED] + [None, "", "![a](b.png)"]
    rows = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k int, body string").repartition(3)
    made = rows.select("k", "body", m.cleaned(F.col("body")).alias("c"), m.tokenise(F.col("body")).alias("t"), m.dests(F.col("body")).alias("d"), m.split_frontmatter(F.col("body")).alias("f"), m.stripped_code(F.col("body")).alias("e")).collect()
    for x in made:
        if x["body"] is None:
            assert x["c"] is None and x["t"] is None
            continue
        assert x["c"] == m.clean(x["body"])
        assert [tuple(t) for t in x["t"]] == m.chunks(x["body"])
        assert x["d"] == [m.dest_without_title(d) for d in m.image_dests(m.effective_body(x["body"]))]
        assert x["f"]["body"] == x["body"] and x["e"] == m.effective_body(x["body"])
