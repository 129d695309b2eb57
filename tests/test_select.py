"""Selectors: sets in document order, results per node, positions, predicates, fallbacks."""

import time

import pytest
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, first_half, first_non_empty, head
from pagelarder.operators.select import page
from pagelarder.operators.shred import shred


@pytest.fixture(scope="module")
def evaluate(spark):
    def run(html, *columns):
        df = spark.createDataFrame([(html,)], "html string")
        named = [c.alias(f"c{i}") for i, c in enumerate(columns)]
        found = tuple(shred(df).select(*named).first())
        return found[0] if len(columns) == 1 else found

    return run


def test_token_and_exact_class(evaluate):
    html = '<i class="a b">1</i><i class="a">2</i><b class="a">3</b><i class="ab">4</i><i class=" a">5</i>'
    doc = page()
    assert evaluate(
        html,
        doc.css("i", "a").text(),
        doc.css(None, "a").text(),
        doc.xclass("a").text(),
        doc.xclass("a b", "i").text(),
        doc.css("i").not_class("a").text(),
    ) == (["1", "2", "5"], ["1", "2", "3", "5"], ["2", "3"], ["1"], ["1", "4", "5"])


def test_direct_text_and_string_value(evaluate):
    html = "<p>a<b>b<i>c</i></b>d</p><p>e</p><p></p>"
    doc = page()
    assert evaluate(
        html, doc.css("p").text(), doc.css("p").texts(), doc.css("p").string(),
        doc.css("p").strings(), doc.css("q").string(), first(doc.css("q").text()),
    ) == (["a", "d", "e"], ["a", "b", "c", "d", "e"], "abcd", ["abcd", "e", ""], "", None)


def test_nested_nodes_are_a_set_but_within_is_not(evaluate):
    html = '<div class="x">1<div class="x">2<a>k</a></div>3</div>'
    boxes = page().css("div", "x")
    assert evaluate(
        html, boxes.text(), boxes.texts(), boxes.descendants("a").text(),
        boxes.within(lambda b: b.css("a").text()), boxes.within(lambda b: b.text()),
        boxes.css("div").text(), boxes.xclass("x").text(),
    ) == (
        ["1", "2", "3"], ["1", "2", "k", "3"], ["k"], ["k", "k"], ["1", "3", "2"],
        ["1", "2", "3"], ["2"],
    )


def test_css_includes_the_node_itself(evaluate):
    html = '<a class="x" href="1"><b>t</b></a>'
    box = page().css("a", "x")
    assert evaluate(
        html, box.within(lambda n: n.css("a").attr("href")), box.descendants("a").attr("href")
    ) == (["1"], [])


def test_child_positions_count_per_parent(evaluate):
    html = "<ul><li>1</li><b>x</b><li>2</li></ul><ul><li>3</li></ul><ul><b><li>no</li></b></ul>"
    lists = page().css("ul")
    assert evaluate(
        html, lists.child("li").text(), lists.child("li", nth=1).text(), lists.child("li", nth=2).text(),
        lists.child().child().text(),
    ) == (["1", "2", "3"], ["1", "3"], ["2"], ["no"])


def test_all_descendant_elements(evaluate):
    items = page().css("ul").descendants()
    assert evaluate(
        "<ul><li>2 dl <a>leite</a></li></ul>", items.map(lambda n: F.array_join(n.texts(), " "))
    ) == ["2 dl  leite", "leite"]


def test_attributes(evaluate):
    html = '<input type="text" v="0"><input type="number"><input type="number" v="4"><input v="">'
    inputs = page().css("input")
    assert evaluate(
        html, inputs.attr("v"), inputs.where_attr("type", "number").attr("v"), inputs.attr("w")
    ) == (["0", "4", ""], ["4"], [])


def test_slices_and_fallbacks(evaluate):
    html = "<i>1</i><i>2</i><i>3</i><u>4</u>"
    doc = page()
    items = doc.css("i")
    assert evaluate(
        html, head(items.text(), 2), items.head(first_half).strings(),
        first_non_empty(doc.css("q").strings(), doc.css("u").strings(), items.strings()),
        first_non_empty(doc.css("q").strings()),
    ) == (["1", "2"], ["1"], ["4"], None)


def test_steps_from_the_page_itself(evaluate):
    html = "a<p x=1>b<i>c</i></p>d<p>e</p><u>f</u>"
    doc = page()
    assert evaluate(
        html, doc.text(), doc.texts(), doc.string(), doc.child("p").texts(), doc.child(nth=2).texts(),
        doc.child("i").texts(),
    ) == (["a", "d"], ["a", "b", "c", "d", "e", "f"], "abcdef", ["b", "c", "e"], ["e"], [])
    for step in (
        lambda: doc.attr("x"), lambda: doc.where_attr("x", "1"), lambda: doc.not_class("x"),
        lambda: doc.strings(), lambda: doc.map(lambda n: n.string()), lambda: doc.head(first_half),
    ):
        with pytest.raises(ValueError, match="starts from elements"):
            step()


def test_sets_from_nested_nodes(evaluate):
    html = "<div>a<i>b</i><div>c<i>d</i></div><i>e</i></div><i>f</i><div>g</div>"
    divs = page().css("div")
    assert evaluate(
        html, divs.texts(), divs.css("i").texts(), divs.descendants("div").strings(), divs.css("div").strings()
    ) == (["a", "b", "c", "d", "e", "g"], ["b", "d", "e"], ["cd"], ["abcde", "cd", "g"])


@pytest.mark.parametrize("nested", [True, False])
def test_sets_from_many_nodes(spark, nested):
    n = 4000
    html = "".join(f"<div>{i}" for i in range(n)) + "</div>" * n if nested else "".join(f"<div>{i}</div>" for i in range(n))
    divs = page().css("div")
    nodes = shred(spark.createDataFrame([(html,)], "html string")).cache()
    query = nodes.select(divs.texts().alias("a"), F.size(divs.descendants().at).alias("b"))
    query.collect()
    start = time.monotonic()
    row = query.first()
    assert row.a == [str(i) for i in range(n)] and row.b == (n - 1 if nested else 0)
    assert time.monotonic() - start < 3


def test_steps_from_a_node_do_not_gather_its_nodes(spark):
    """Steps go by positions; `slice` would make an array of the nodes of every subtree."""
    items = page().css("li", "x")
    columns = [
        items.map(lambda li: first(li.css("b", "y").text())),
        items.map(lambda li: F.concat(*[F.size(li.descendants(t).at) for t in ("b", ("b", "i"))])),
        items.child("b").text(), items.strings(), items.texts(), items.map(lambda li: li.string()),
    ]
    html = "".join(f'<li class="x">{i}<b class="y">b{i}</b><i></i>' for i in range(3)) + '<li class="x">'
    df = shred(spark.createDataFrame([(html,)], "html string")).select(*columns)
    assert tuple(df.first()) == (
        ["b0", "b1", "b2", None], ["12", "12", "12", "00"], ["b0", "b1", "b2"],
        ["0b0", "1b1", "2b2", ""], ["0", "b0", "1", "b1", "2", "b2"], ["0b0", "1b1", "2b2", ""],
    )
    assert "slice(nodes" not in df._jdf.queryExecution().optimizedPlan().toString()
