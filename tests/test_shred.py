"""Shredding: structure, recovery from bad markup, and a round trip of generated trees."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelarder.operators.shred import _Nodes, _shred_batches, shred


def nodes_of(page):
    nodes = _Nodes()
    nodes.add_page(page)
    return nodes.to_arrow().to_pylist()[0]


def outline(page):
    """Nested lists of tags and texts."""
    nodes = nodes_of(page)

    def build(at):
        node = nodes[at]
        if node["kind"] == "t":
            return node["text"]
        inner = [n["pre"] for n in nodes if n["parent"] == at]
        return [node["tag"], *[build(i) for i in inner]]

    return [build(n["pre"]) for n in nodes if n["parent"] == -1]


def test_positions_and_attributes():
    nodes = nodes_of('<div class="a  b" id=x data-e="&lt;&amp;" checked>t<br/>u</div>')
    assert [(n["pre"], n["end"], n["parent"], n["depth"]) for n in nodes] == [
        (0, 3, -1, 0), (1, 1, 0, 1), (2, 2, 0, 1), (3, 3, 0, 1),
    ]
    assert nodes[0]["cls"] == "a  b" and nodes[0]["classes"] == ["a", "b"]
    assert dict(nodes[0]["attrs"]) == {"class": "a  b", "id": "x", "data-e": "<&", "checked": ""}
    assert nodes[1]["cls"] is None and nodes[1]["classes"] == []


def test_implied_ends():
    assert outline("<p><b>x<br><p>y") == [["p", ["b", "x", ["br"]]], ["p", "y"]]
    assert outline("<ul><li>a<li>b</ul>c") == [["ul", ["li", "a"], ["li", "b"]], "c"]
    assert outline("<table><tr><td>a<td>b<tr><td>c</table>") == [
        ["table", ["tr", ["td", "a"], ["td", "b"]], ["tr", ["td", "c"]]]
    ]
    assert outline("<dl><dt>a<dd>b<dt>c</dl>") == [["dl", ["dt", "a"], ["dd", "b"], ["dt", "c"]]]
    assert outline("<p>a<ul><li><ul><li>b</ul></ul>") == [
        ["p", "a"], ["ul", ["li", ["ul", ["li", "b"]]]],
    ]
    assert outline("<head><title>t</title><p>x") == [["head", ["title", "t"]], ["p", "x"]]


def test_wrong_end_tags():
    assert outline("a</i>b") == ["ab"]
    assert outline("<div><b>x</div>y") == [["div", ["b", "x"]], "y"]
    assert outline("<table><tr><td>a</span></div>b</td></tr></table>") == [
        ["table", ["tr", ["td", "ab"]]]
    ]
    assert outline("<div><span>a</b></span></DIV >b") == [["div", ["span", "a"]], "b"]


def test_raw_text_comments_and_entities():
    assert outline('<script>var t="</p>&amp;<b>";</script>x') == [
        ["script", 'var t="</p>&amp;<b>";'], "x",
    ]
    assert outline("<!DOCTYPE html>a<!-- <b> -->b<?pi?>c") == ["a", "b", "c"]
    assert outline("&copy;&amp;amp; 1 < 2 & 3 <4") == ["©&amp; 1 < 2 & 3 <4"]
    assert outline("<style>p{}") == [["style", "p{}"]]


def test_attribute_edge_cases():
    assert outline('<a title="x>y" href=/a/b>t</a>') == [["a", "t"]]
    assert dict(nodes_of('<a title="x>y" href=/a/b>t</a>')[0]["attrs"]) == {
        "title": "x>y", "href": "/a/b",
    }
    assert dict(nodes_of("<a x='1' X=2 =y z>t")[0]["attrs"])["x"] == "1"
    assert outline('<a href="open>t</a>')[0][0] == "a"
    assert outline("<a") == [["a"]]
    assert outline("x<a href='") == ["x", ["a"]]
    assert outline("<b/>x") == [["b"], "x"]


def test_same_tag_written_alike_keeps_its_own_attributes():
    nodes = nodes_of('<a title="1>" id="2"></a><a title="1>" id="3"></a>')
    assert [dict(n["attrs"])["id"] for n in nodes if n["tag"] == "a"] == ["2", "3"]


def test_adversarial_sizes_stay_linear():
    assert len(nodes_of("<div>" * 20_000)) == 20_000
    assert len(nodes_of("<a b='" * 5_000)) > 0
    assert len(nodes_of("<span>" * 30_000 + "</b></i>" * 30_000)) == 30_000
    assert len(nodes_of("<b><span>" * 20_000 + "</b>" * 20_000)) == 40_000
    assert len(nodes_of("<" * 100_000)) == 1
    assert len(nodes_of("<!--" * 50_000)) == 0


def test_output_batches_follow_content():
    pages = ["<p>x" * 30_000, "", None, "<i>y", "<p>x" * 30_000]
    batch = pa.RecordBatch.from_pydict({"id": list(range(5)), "html": pages})
    out = list(_shred_batches(iter([batch])))
    assert [b.num_rows for b in out] == [1, 4]
    assert [i for b in out for i in b.column("id").to_pylist()] == [0, 1, 2, 3, 4]


TREES = st.recursive(
    st.text("abc é&<>\"'\n", min_size=1, max_size=6),
    lambda inner: st.tuples(
        st.sampled_from(["div", "span", "em", "section"]),
        st.dictionaries(st.sampled_from(["class", "id", "x-y"]), st.text("a &\"'<>", max_size=4)),
        st.lists(inner, max_size=4),
    ),
    max_leaves=20,
)


def markup(tree):
    if isinstance(tree, str):
        return tree.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    tag, attrs, inner = tree
    written = "".join(
        f' {k}="{v.replace("&", "&amp;").replace(chr(34), "&quot;")}"' for k, v in attrs.items()
    )
    return f"<{tag}{written}>{''.join(map(markup, inner))}</{tag}>"


def rows(trees, depth=0, at=0):
    """Expected (tag, attrs, text, depth, size) in document order; neighbouring texts merge."""
    merged = []
    for tree in trees:
        if isinstance(tree, str) and merged and isinstance(merged[-1], str):
            merged[-1] += tree
        else:
            merged.append(tree)
    out = []
    for tree in merged:
        if isinstance(tree, str):
            out.append((None, {}, tree, depth, 1))
        else:
            inner = rows(tree[2], depth + 1)
            out.append((tree[0], tree[1], None, depth, 1 + len(inner)))
            out += inner
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(TREES, max_size=3))
def test_round_trip(trees):
    found = [
        (n["tag"], dict(n["attrs"]), n["text"], n["depth"], n["end"] - n["pre"] + 1)
        for n in nodes_of("".join(map(markup, trees)))
    ]
    assert found == rows(trees)


def test_shred_in_spark(spark):
    df = spark.createDataFrame(
        [(1, "u", "<p>a<p>b"), (2, None, None), (3, "w", "")], "id int, url string, html string"
    )
    out = {r.id: r for r in shred(df).collect()}
    assert [n.tag for n in out[1].nodes] == ["p", None, "p", None]
    assert out[2].nodes == [] and out[2].url is None and out[3].nodes == []
    assert shred(df, keep=["id"]).columns == ["id", "nodes"]
    assert shred(df).select(F.sum(F.size("nodes"))).first()[0] == 4
