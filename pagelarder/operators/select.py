"""Select nodes of a shredded page with Column expressions.

A selection is a list of node positions. Positions are plain integers, so document order is
a primitive sort and set semantics a hash-based distinct, both linear in practice. Steps
that start at one node or at the whole page need neither.

There are two ways to continue from several nodes, and they differ when the nodes overlap:
the step methods (`css`, `child`, `descendants`, `text`) give a set in document order;
`within` and `map` run once per node and keep the results apart.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, let
from pagelarder.operators.shred import Reads

Test = Callable[[Column], Column]


def _element(
    tag: str | tuple[str, ...] | None = None,
    token: str | None = None,
    cls: str | None = None,
) -> Test:
    """Test for an element by tag, by class token, or by the exact class attribute."""

    def test(node: Column) -> Column:
        parts = []
        if tag is not None:
            tags = (tag,) if isinstance(tag, str) else tag
            # Never null, so that what follows is not looked at for text nodes.
            parts.append(reduce(or_, [node["tag"].eqNullSafe(t) for t in tags]))
        if token is not None:
            parts.append(F.array_contains(node["classes"], token))
        if cls is not None:
            parts.append(node["cls"] == cls)
        if not parts:
            return node["kind"] == "e"
        result = parts[0]
        for part in parts[1:]:
            result = result & part
        return result

    return test


class Selection:
    """Nodes of one page.

    `at` lists their positions; it is None for the page itself, whose children are the nodes
    without a parent and which has no attributes. Inside `map` and `within` a selection is one
    node, whose position `one` needs no list.

    `reads` notes the attributes and classes that the steps from a page ask for, so that the
    shredder can leave out the others. Whoever takes the bare `nodes` may read anything.
    """

    def __init__(
        self, nodes: Column, at: Column | None = None, one: Column | None = None, reads: Reads | None = None
    ):
        self._nodes = nodes
        self.reads = Reads() if reads is None else reads
        self.at = F.array(one) if one is not None and at is None else at
        self._one = one

    @property
    def nodes(self) -> Column:
        self.reads.everything = True
        return self._nodes

    # -- positions ---------------------------------------------------------------------

    def _find(self, test: Test, own: bool) -> Column:
        """Positions below (`own`: and at) the selected nodes that pass the test."""
        if self.at is None:
            return F.filter(self._nodes, test)["pre"]
        return self._below(lambda p: self._at(self._subtree(p, own), test))

    def _below(self, step: Callable[[Column], Column]) -> Column:
        """As `_step`, for steps that reach the whole subtree of each node.

        A node inside another selected one adds nothing to such a set, so only the outermost
        nodes step. Their subtrees are disjoint: what they give is in order and without repeats,
        and takes time in proportion to the page, however deep the selected nodes are nested.
        """
        if self._one is not None:
            return step(self._one)
        return F.flatten(F.transform(self._outermost(), step))

    def _outermost(self) -> Column:
        none = F.struct(F.lit(-1).alias("to"), F.array().cast("array<int>").alias("at"))

        def pick(seen: Column, p: Column) -> Column:
            end = F.get(self._nodes, p)["end"]
            grown = F.struct(end.alias("to"), F.concat(seen["at"], F.array(p)).alias("at"))
            return F.when(p > seen["to"], grown).otherwise(seen)

        def picked(at: Column) -> Column:
            return F.aggregate(F.sort_array(at), none, pick, lambda seen: seen["at"])

        return let(self.at, lambda at: F.when(F.size(at) < 2, at).otherwise(picked(at)))

    def _step(self, step: Callable[[Column], Column]) -> Column:
        """Positions that `step` finds from each selected node, as a set in document order."""
        if self._one is not None:
            return step(self._one)
        return F.sort_array(F.array_distinct(F.flatten(F.transform(self.at, step))))

    def _subtree(self, position: Column, own: bool = True) -> Column:
        """Positions of a subtree: its nodes are looked at where they are, not gathered into a new array."""
        end = F.get(self._nodes, position)["end"]
        if own:
            return F.sequence(position, end)
        none = F.array().cast("array<int>")
        return F.when(end > position, F.sequence(position + 1, end)).when(end == position, none)

    def _at(self, positions: Column, test: Test) -> Column:
        """The positions whose nodes pass the test."""
        return F.filter(positions, lambda i: test(F.get(self._nodes, i)))

    def _texts_of(self, positions: Column) -> Column:
        return F.transform(positions, lambda i: F.get(self._nodes, i)["text"])

    def pick(self, at: Column) -> Selection:
        """The nodes at the given positions of the page."""
        return Selection(self._nodes, at, reads=self.reads)

    def whole_page(self) -> Selection:
        return Selection(self._nodes, reads=self.reads)

    def _listed(self, step: str) -> Column:
        if self.at is None:
            raise ValueError(f"`{step}` starts from elements; select some of the page first")
        return self.at

    def _keep(self, test: Test, step: str) -> Selection:
        return self.pick(self._at(self._listed(step), test))

    def _text_nodes(self, position: Column, own: bool = False) -> Column:
        return self._at(self._subtree(position, own), lambda n: n["kind"] == "t")

    # -- steps to other nodes ----------------------------------------------------------

    def css(self, tag: str | None = None, token: str | None = None) -> Selection:
        """Elements with a class token, at or below the selected nodes."""
        if token is not None:
            self.reads.tokens.add(token)
        return self.pick(self._find(_element(tag, token), own=True))

    def xclass(self, cls: str, tag: str | None = None) -> Selection:
        """Elements whose class attribute is exactly `cls`, below the selected nodes."""
        self.reads.classes.add(cls)
        return self.pick(self._find(_element(tag, cls=cls), own=False))

    def descendants(self, tag: str | tuple[str, ...] | None = None) -> Selection:
        """Elements below the selected nodes: with one of the tags, or all of them."""
        return self.pick(self._find(_element(tag), own=False))

    def child(self, tag: str | None = None, nth: int | None = None) -> Selection:
        """Child elements; `nth` (from 1) counts per parent."""
        test = _element(tag)

        def step(p: Column) -> Column:
            found = self._at(self._subtree(p, own=False), lambda n: (n["parent"] == p) & test(n))
            return found if nth is None else F.slice(found, nth, 1)

        if self.at is None:
            found = F.filter(self._nodes, lambda n: (n["parent"] < 0) & test(n))["pre"]
            return self.pick(found if nth is None else F.slice(found, nth, 1))
        return self.pick(self._step(step))

    # -- tests on the selected nodes ---------------------------------------------------

    def where_attr(self, name: str, value: str) -> Selection:
        self.reads.attrs.add(name)
        return self._keep(lambda n: n["attrs"][name] == value, "where_attr")

    def not_class(self, cls: str) -> Selection:
        """Nodes whose class attribute is missing or differs from `cls`."""
        self.reads.classes.add(cls)
        return self._keep(lambda n: n["cls"].isNull() | (n["cls"] != cls), "not_class")

    # -- one result per node -----------------------------------------------------------

    def within(self, body: Callable[[Selection], Column]) -> Column:
        """Run `body` at each node and concatenate the lists it gives."""
        return F.flatten(self.map(body))

    def map(self, body: Callable[[Selection], Column]) -> Column:
        """Run `body` at each node; one value per node."""
        return F.transform(self._listed("map"), lambda p: body(Selection(self._nodes, one=p, reads=self.reads)))

    def head(self, at: Callable[[Column], Column]) -> Selection:
        """Reduce the list of nodes, for example to its first half."""
        return self.pick(at(self._listed("head")))

    # -- values ------------------------------------------------------------------------

    def text(self) -> Column:
        """Each text node directly below a selected node."""

        def step(p: Column) -> Column:
            return self._at(self._subtree(p, own=False), lambda n: (n["parent"] == p) & (n["kind"] == "t"))

        if self.at is None:
            return F.filter(self._nodes, lambda n: (n["kind"] == "t") & (n["parent"] < 0))["text"]
        if self._one is not None:
            return self._texts_of(step(self._one))
        return self._texts_of(self._step(step))

    def texts(self) -> Column:
        """Each text node anywhere below the selected nodes."""
        if self.at is None:
            return F.filter(self._nodes, lambda n: n["kind"] == "t")["text"]
        return self._below(lambda p: self._texts_of(self._text_nodes(p)))

    def attr(self, name: str) -> Column:
        """The attribute of each selected node that has it."""
        self.reads.attrs.add(name)
        values = F.transform(self._listed("attr"), lambda p: F.get(self._nodes, p)["attrs"][name])
        return F.filter(values, lambda v: v.isNotNull())

    def string(self) -> Column:
        """String value of the first selected node; '' when nothing is selected."""
        if self.at is None:
            return F.array_join(self.texts(), "")
        return F.coalesce(let(first(self.at), self._string_value), F.lit(""))

    def strings(self) -> Column:
        """String value of each selected node."""
        return F.transform(self._listed("strings"), self._string_value)

    def _string_value(self, position: Column) -> Column:
        return F.array_join(self._texts_of(self._text_nodes(position, own=True)), "")


def page(nodes: str | Column = "nodes") -> Selection:
    """The whole page, as the start of a selection."""
    return Selection(F.col(nodes) if isinstance(nodes, str) else nodes)
