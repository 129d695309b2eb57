"""Unicode compatibility decomposition, for which Spark has no built-in."""

from __future__ import annotations

import sys
import unicodedata

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need no copy of this package: the worker function travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _decompose(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFKD", text)


@F.arrow_udf(T.StringType())
def _nfkd_text(texts: pa.Array) -> pa.Array:
    return pa.array([_decompose(t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def _nfkd_list(lists: pa.Array) -> pa.Array:
    flat = pa.array([_decompose(t) for t in lists.flatten().to_pylist()], pa.string())
    counts = [0 if n is None else n for n in lists.value_lengths().to_pylist()]
    offsets = [0]
    for n in counts:
        offsets.append(offsets[-1] + n)
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), flat, mask=lists.is_null()
    )


def _is_plain(text: Column) -> Column:
    return ~text.rlike(r"[^\x00-\x7F]")


def nfkd(text: Column) -> Column:
    """NFKD of a text. ASCII-only rows reach Python as nulls and are returned as they are."""
    return F.coalesce(_nfkd_text(F.when(~_is_plain(text), text)), text)


def nfkd_each(texts: Column, needed: Column | None = None) -> Column:
    """NFKD of every text of a list; rows where `needed` is false never reach Python."""
    relevant = F.exists(texts, lambda t: ~_is_plain(t))
    if needed is not None:
        relevant = needed & relevant
    return F.coalesce(_nfkd_list(F.when(relevant, texts)), texts)
