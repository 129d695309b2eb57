"""String functions with the white-space and delimiter rules the extractors need.

Everything here is a built-in Column expression, so it stays inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python counts as white space. Spark's one-argument trim()
# knows U+0020 only and Java's (?U)\s leaves out U+001C..U+001F, hence the explicit list.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a pattern: White_Space by property (which is quicker than listing it) and the
# four separators the property leaves out.
SPACE_RUN = r"(?U)[\s\x1C-\x1F]+"

# Fixed value: the line breaks of Python's splitlines(), as a Java pattern.
LINE_BREAK = r"\r\n|[\n\r\u000B\u000C\u001C-\u001E\u0085\u2028\u2029]"

# Fixed value: the white space of XML, which is all that normalize-space() folds.
XML_SPACE = r"[ \t\r\n]+"


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column) -> Column:
    """Split on runs of white space; never yields an empty word."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def delete(text: Column, *parts: str) -> Column:
    """Remove every occurrence of each literal part, one part after the other."""
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def single_spaced(text: Column) -> Column:
    """One left-to-right pass that turns each pair of spaces into one space."""
    return F.replace(text, F.lit("  "), F.lit(" "))


def after_last(text: Column, delimiter: str) -> Column:
    """Text after the last delimiter, the whole text when there is none."""
    return F.substring_index(text, delimiter, -1)


def before_first(text: Column, delimiter: str) -> Column:
    """Text before the first delimiter, the whole text when there is none."""
    return F.substring_index(text, delimiter, 1)


def substring_after(text: Column, mark: str) -> Column:
    """Text after the first mark, '' when the mark does not occur."""
    at = F.instr(text, F.lit(mark))
    return F.when(at > 0, F.substr(text, at + len(mark))).otherwise(F.lit(""))


def normalize_space(text: Column) -> Column:
    """Fold XML white space to single spaces and trim; other white space is kept."""
    return F.trim(F.regexp_replace(text, XML_SPACE, " "))


def concat_missing_as_empty(*parts: Column) -> Column:
    """Concatenate, with '' in place of every missing part."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def clean_lines(text: Column) -> Column:
    """Split at line breaks, strip each line, drop the empty ones."""
    lines = F.transform(F.split(text, LINE_BREAK), strip)
    return F.array_remove(lines, "")


def drop_blank(texts: Column) -> Column:
    """Delete line feeds inside each text, then drop blank texts without stripping the rest."""
    joined = F.transform(texts, lambda t: delete(t, "\r\n", "\n"))
    return F.filter(joined, lambda t: strip(t) != "")


def part_of(value: Column, constant: str) -> Column:
    """Is the value a substring of the constant? '' is, null stays null."""
    return F.contains(F.lit(constant), value)
