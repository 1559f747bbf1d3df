"""Expressions the text operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space words are separated by.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Inside a character class: whatever some library may take for white space, and controls.
MAYBE_BLANK = r"\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``doc_id`` and ``text``; a null text is empty.

    All other columns stay behind, so none can clash with what an operator adds.
    """
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    A column used inside a lambda is evaluated again for every element; bound
    as the element of a one-element array it is not.
    """
    return F.transform(F.array(value), body)[0]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow column of texts (or binary) without nulls, and the place where each begins, then where the last ends."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    starts = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def stretches(data, lengths: np.ndarray) -> pa.Array:
    """Consecutive stretches of the bytes, of these lengths, as an Arrow column."""
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def distinct(column: pa.Array) -> tuple[list, np.ndarray]:
    """The different values of a column without nulls, and which of them each value is."""
    found = column.dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()


def row_groups(column: pa.Array, most: int):
    """The texts in slices of about ``most`` bytes; a longer text is one of its own, or the last of a slice."""
    starts, begin = utf8(column)[1], 0
    while begin < len(column):
        end = min(len(column), int(np.searchsorted(starts, starts[begin] + most)))
        yield column.slice(begin, end - begin)
        begin = end
