"""Shred HTML text into one ordered node array per page.

The array holds elements and text nodes in document order. `pre` is the position of a node
in the array and `end` the position of the last node of its subtree, so a subtree is a slice
and every selector is a Column expression over one row: no shuffle and no Python after this
step (the pre/end encoding is the one of Grust, "Accelerating XPath Location Steps", 2002).

The Python part is a small event loop that Spark runs per Arrow batch. Recovery from bad
markup follows the usual lenient rules: void elements, implied end tags, an end tag closes
everything above its start tag, an end tag without a start tag is ignored and may not reach
out of a table cell or block. Very malformed markup can still differ in nesting from what
another lenient parser builds; the text and its order are always kept.
"""

from __future__ import annotations

import html as html_entities
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import accumulate, chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Executors need no copy of this package: the worker function travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE = T.StructType(
    [
        T.StructField("pre", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("cls", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
    ]
)
NODES = T.ArrayType(NODE)

# An output batch is closed after this many nodes, so its size follows the content and not
# the number of pages. A single page is never split.
_NODES_PER_BATCH = 50_000

_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(
    r"[\s/]*([^\s=>/][^\s=>/]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?"
)
_TAG_END = re.compile(r"[^>]*>?")
_CLASS_GAP = re.compile(r"[ \t\r\n]+")

_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CELL = {"td", "th", "p", "a", "b", "font", "u", "span"}
_ROW = {"td", "th", "tr", "p", "caption", "col", "colgroup"}
_BLOCKS = {
    "address", "blockquote", "center", "dir", "div", "dl", "fieldset", "hr", "menu", "ol", "pre",
    "ul",
} | _HEADINGS
_HEAD_CONTENT = {
    "html", "head", "title", "meta", "link", "base", "script", "style", "noscript", "template",
}
_VOID = {
    "area", "base", "br", "col", "embed", "frame", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
_RAW_TEXT = {"script", "style"}

# Start tag -> open elements it ends, applied from the innermost element outwards.
_ENDS = {
    **{tag: {"p"} for tag in _BLOCKS},
    "p": {"p", "b", "big", "s", "small", "strike", "tt", "u"} | _HEADINGS,
    "a": {"a"},
    "li": {"li", "p", "address"} | _HEADINGS,
    "dd": {"dd", "dt", "p", "address"},
    "dt": {"dd", "dt", "p", "address"},
    "option": {"option"},
    "optgroup": {"option", "optgroup"},
    "form": {"p"} | _HEADINGS,
    "table": {"p", "a"} | _HEADINGS,
    "tr": _ROW,
    "td": _CELL,
    "th": _CELL,
    "thead": _ROW | {"tbody", "thead", "tfoot"},
    "tbody": _ROW | {"tbody", "thead", "tfoot"},
    "tfoot": _ROW | {"tbody", "thead", "tfoot"},
    "body": {"head", "title", "p"},
}

# An end tag does not reach past an open element of higher rank.
_RANK = {
    "div": 1, "td": 2, "th": 2, "tr": 3, "thead": 4, "tbody": 4, "tfoot": 4, "table": 5,
    "head": 6, "body": 6, "html": 7,
}


@dataclass
class Reads:
    """What selectors read of start tags: attributes, whole class attributes, class tokens.

    The shredder emits nothing else, so it never crosses from Python to the JVM. A selection
    notes here what its steps ask for; `everything` is for readers that can't tell.
    """

    attrs: set[str] = field(default_factory=set)
    classes: set[str] = field(default_factory=set)
    tokens: set[str] = field(default_factory=set)
    everything: bool = False

    def __or__(self, other: Reads) -> Reads:
        return Reads(
            self.attrs | other.attrs, self.classes | other.classes, self.tokens | other.tokens,
            self.everything or other.everything,
        )


_ALL = Reads(everything=True)


class _StartTag:
    """A start tag as written. Pages repeat few distinct ones, so they are parsed once."""

    __slots__ = ("tag", "cls", "classes", "attrs", "empty", "ends", "leaves_head", "raw_text")

    def __init__(self, name: str, attrs: dict[str, str], self_closed: bool, reads: Reads = _ALL):
        self.tag = tag = name.lower()
        self.cls = attrs.get("class")
        self.classes = [t for t in _CLASS_GAP.split(self.cls or "") if t]
        self.attrs = list(attrs.items())
        if not reads.everything:
            self.cls = self.cls if self.cls in reads.classes else None
            self.classes = [t for t in self.classes if t in reads.tokens]
            self.attrs = [(k, v) for k, v in self.attrs if k in reads.attrs]
        self.empty = self_closed or tag in _VOID
        self.ends = _ENDS.get(tag, ())
        self.leaves_head = tag not in _HEAD_CONTENT
        self.raw_text = (
            re.compile(rf"</{tag}(?![^\s/>])", re.I) if tag in _RAW_TEXT else None
        )


def _start_tag(page: str, pos: int, reads: Reads = _ALL) -> tuple[_StartTag, int]:
    """Parse the start tag whose name begins at `pos`; also gives the position after it."""
    name = _TAG_NAME.match(page, pos)
    attrs: dict[str, str] = {}
    pos = name.end()
    while match := _ATTRIBUTE.match(page, pos):
        key, *values = match.groups()
        value = next((v for v in values if v is not None), "")
        attrs.setdefault(key.lower(), html_entities.unescape(value) if "&" in value else value)
        pos = match.end()
    rest = _TAG_END.match(page, pos)
    return _StartTag(name[0], attrs, rest[0].endswith("/>"), reads), rest.end()


class _Nodes:
    """Column buffers of the nodes of one output batch. Text nodes have no start tag."""

    def __init__(self, reads: Reads = _ALL) -> None:
        self.reads = reads
        self.sizes: list[int] = []
        self.end: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.tags: list[_StartTag | None] = []
        self.text: list[str | None] = []
        self._known: dict[str, _StartTag] = {}

    def __len__(self) -> int:
        return len(self.tags)

    def add_page(self, page: str) -> None:
        base = len(self.tags)
        open_at = [-1]  # positions of the open elements, below an outermost "no parent"
        open_tags = [""]
        open_count: dict[str, int] = {}  # by tag, so that a stray end tag costs no search
        pending: list[str] = []  # text since the last node boundary
        known = self._known

        def add(tag: _StartTag | None, text: str | None) -> int:
            at = len(self.tags) - base
            self.tags.append(tag)
            self.text.append(text)
            self.parent.append(open_at[-1])
            self.depth.append(len(open_at) - 1)
            self.end.append(at)
            return at

        def flush() -> None:
            text = "".join(pending)
            pending.clear()
            if text:
                add(None, text)

        def close(keep: int) -> None:
            if pending:
                flush()
            last = len(self.tags) - 1 - base
            while len(open_at) > keep:
                self.end[base + open_at.pop()] = last
                open_count[open_tags.pop()] -= 1

        pos, size, after = 0, len(page), 0
        while pos < size:
            at = page.find("<", pos)
            stop = size if at < 0 else at
            if stop > pos:
                run = page[pos:stop]
                pending.append(html_entities.unescape(run) if "&" in run else run)
            if at < 0:
                break
            lead = page[at + 1 : at + 2]
            if after <= at:  # past the next ">"; looked up once, however many "<" precede it
                after = page.find(">", at) + 1 or size
            if lead == "/":
                pos = after
                if page[at + 2 : after - 1] == open_tags[-1]:  # the usual case
                    close(len(open_tags) - 1)
                    continue
                name = _TAG_NAME.match(page, at + 2)
                if name is None:
                    continue
                tag = name[0].lower()
                if not open_count.get(tag):
                    continue
                rank = _RANK.get(tag, 0)
                for i in range(len(open_tags) - 1, 0, -1):
                    if open_tags[i] == tag:
                        close(i)
                        break
                    if _RANK.get(open_tags[i], 0) > rank:
                        break
            elif lead.isascii() and lead.isalpha():
                written = page[at + 1 : after]
                start = known.get(written)
                if start is None:
                    start, pos = _start_tag(page, at + 1, self.reads)
                    # A ">" inside quotes ends `written` early; such a tag is not remembered.
                    if pos == after:
                        known[written] = start
                else:
                    pos = after
                keep = len(open_tags)
                while open_tags[keep - 1] in start.ends:
                    keep -= 1
                if start.leaves_head and open_tags[keep - 1] == "head":
                    keep -= 1
                if keep < len(open_tags):
                    close(keep)
                elif pending:
                    flush()
                element = add(start, None)
                if start.empty:
                    continue
                open_at.append(element)
                open_tags.append(start.tag)
                open_count[start.tag] = open_count.get(start.tag, 0) + 1
                if start.raw_text:
                    found = start.raw_text.search(page, pos)
                    stop = found.start() if found else size
                    pending.append(page[pos:stop])
                    pos = stop
            elif lead in ("!", "?"):  # comment, doctype, processing instruction
                if pending:
                    flush()
                if page.startswith("<!--", at):
                    found = page.find("-->", at + 4)
                    pos = size if found < 0 else found + 3
                else:
                    pos = after
            else:
                pending.append("<")
                pos = at + 1
        close(1)
        self.sizes.append(len(self.tags) - base)

    def to_arrow(self) -> pa.Array:
        """Start tags become columns once, however many nodes repeat them; 0 stands for a text node."""
        kinds: dict[_StartTag | None, int] = {None: 0}
        which = pa.array([kinds.setdefault(t, len(kinds)) for t in self.tags], pa.int32())
        tags = list(kinds)

        def offsets(counts):
            return pa.array([0, *accumulate(counts)], pa.int32())

        written = {
            "kind": pa.array(["e" if t else "t" for t in tags], pa.string()),
            "tag": pa.array([t.tag if t else None for t in tags], pa.string()),
            "cls": pa.array([t.cls if t else None for t in tags], pa.string()),
            "classes": pa.array([t.classes if t else [] for t in tags], pa.list_(pa.string())),
            "attrs": pa.array([t.attrs if t else [] for t in tags], pa.map_(pa.string(), pa.string())),
        }
        columns = {
            "pre": pa.array(list(chain.from_iterable(map(range, self.sizes))), pa.int32()),
            "end": pa.array(self.end, pa.int32()),
            "parent": pa.array(self.parent, pa.int32()),
            "depth": pa.array(self.depth, pa.int32()),
            **{name: column.take(which) for name, column in written.items()},
            "text": pa.array(self.text, pa.string()),
        }
        nodes = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
        return pa.ListArray.from_arrays(offsets(self.sizes), nodes)


def _shred_batches(batches: Iterator[pa.RecordBatch], reads: Reads = _ALL) -> Iterator[pa.RecordBatch]:
    """Replace the last column (HTML text) by the node arrays; pass the others through."""
    for batch in batches:
        kept = batch.select(batch.schema.names[:-1])
        nodes, start = _Nodes(reads), 0
        for row, page in enumerate(batch.column(batch.num_columns - 1)):
            nodes.add_page(page.as_py() or "")
            if len(nodes) >= _NODES_PER_BATCH or row == batch.num_rows - 1:
                part = kept.slice(start, row + 1 - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, nodes.to_arrow()], names=[*part.schema.names, "nodes"]
                )
                nodes, start = _Nodes(reads), row + 1


def shred(
    pages: DataFrame, html: str = "html", keep: list[str] | None = None, reads: Reads = _ALL
) -> DataFrame:
    """Replace the `html` column by `nodes`; a null text gives an empty array.

    Filters and column pruning do not pass through this step, so apply them before it: `keep`
    names the columns to carry along (all by default). `reads` names the attributes and classes
    that selectors will look at (all by default); the others are left out of the nodes.
    """
    keep = [c for c in pages.columns if c != html] if keep is None else keep
    schema = T.StructType(
        [*[pages.schema[c] for c in keep], T.StructField("nodes", NODES)]
    )
    return pages.select(*keep, html).mapInArrow(partial(_shred_batches, reads=reads), schema)
