"""Byte-level BPE encoding and decoding by a local rank file.

Tasks encode whole texts with the tiktoken library. A long text is first cut
where no match of the splitting pattern can span: after a character that is
surely no white space and before an ASCII blank. Only the whole text decides the
ids, so cutting bounds the work of one call and nothing else. Very long runs of
white space, on which the splitting pattern fails for want of memory, are matched
here: all but the last blank is one match, or the whole run at the end of a text.
This rule belongs to patterns that end in ``\\s+(?!\\S)|\\s+`` and take white space
nowhere else but one blank before a word; other patterns are used as they are. Decoding gives raw
bytes. There is no shuffle, and a task holds one batch of rows.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows are
independent, so nulls in other columns, repeated rows and extra columns have no
effect; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabloom.llm.common import MAYBE_BLANK, texts

#: Characters of a text that are encoded at once; a longer run without a blank stays whole.
CHUNK = 1 << 15
#: White space as the library's patterns know it, and the run from which it is matched here.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = 1 << 12
_RUN = re.compile(rf"[{SPACE}]{{{RUN},}}")
_ENDING = r"|\s+(?!\S)|\s+"
_SAFE_END = re.compile(rf"[^{MAYBE_BLANK}](?=[ \n\t\r])")


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str):
    """The encoding of a rank file, once per worker."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    name = hashlib.md5(f"{ranks}\n{pattern}".encode()).hexdigest()
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=table, special_tokens={})


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """The text in pieces that can be encoded one by one."""
    pieces, start = [], 0
    while len(text) - start > size:
        end = _SAFE_END.search(text, start + size)
        if end is None:
            break
        pieces.append(text[start : end.end()])
        start = end.end()
    return [*pieces, text[start:]]


def _with_runs(text: str, pattern: str):
    """Parts of a text in order, and whether one is a single match of white space."""
    start = 0
    if pattern.endswith(_ENDING) and r"\s" not in pattern[: -len(_ENDING)].replace(r"[^\s", ""):
        for run in _RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            yield text[start : run.start()], False
            yield text[run.start() : end], True
            start = end
    yield text[start:], False


def encode_text(text: str, ranks: str, pattern: str):
    """The ids as a numpy array of unsigned 32-bit integers, little-endian."""
    import numpy as np

    own = encoding(ranks, pattern)
    parts = []
    for part, is_match in _with_runs(text, pattern):
        if is_match:
            parts.append(np.array(own._encode_single_piece(part.encode()), "<u4"))
        else:
            parts += [own.encode_to_numpy(piece, disallowed_special=()) for piece in chunks(part) if piece]
    return np.concatenate(parts).astype("<u4") if parts else np.empty(0, "<u4")


def _by_row(df: DataFrame, name: str, added: list[tuple[str, T.DataType]], work) -> DataFrame:
    """Runs ``work(value)`` on one column; ``doc_id`` passes through. Output batches stay small."""
    schema = T.StructType([T.StructField("doc_id", df.schema["doc_id"].dataType)] + [T.StructField(*a) for a in added])
    types = [pa.int64() if isinstance(t, T.LongType) else pa.binary() for _, t in added]

    def run(batches):
        for batch in batches:
            ids, values = batch.column(0), batch.column(1)
            done, rows, size = 0, [], 0
            for i in range(batch.num_rows):
                rows.append(work(values[i].as_py()))
                size += sum(len(x) for x in rows[-1] if isinstance(x, bytes))
                if size > 1 << 23 or i + 1 == batch.num_rows:
                    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                    yield pa.RecordBatch.from_arrays([ids.slice(done, len(rows)), *columns], schema.names)
                    done, rows, size = i + 1, [], 0

    return df.select("doc_id", name).mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit)."""

    def work(text):
        ids = encode_text(text, ranks, pattern)
        return len(ids), ids.tobytes()

    return _by_row(texts(docs, id_col, text_col), "text", [("n_tokens", T.LongType()), ("ids", T.BinaryType())], work)


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id`` and the raw bytes ``data`` of the ids."""

    def work(ids):
        import numpy as np

        return (encoding(ranks, pattern).decode_bytes(np.frombuffer(ids or b"", "<u4").tolist()),)

    return _by_row(encoded, "ids", [("data", T.BinaryType())], work)


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``data``, the bytes the ids decode to, in one pass."""

    def work(text):
        ids = encode_text(text, ranks, pattern)
        return len(ids), ids.tobytes(), encoding(ranks, pattern).decode_bytes(ids.tolist())

    added = [("n_tokens", T.LongType()), ("ids", T.BinaryType()), ("data", T.BinaryType())]
    return _by_row(texts(docs, id_col, text_col), "text", added, work)
