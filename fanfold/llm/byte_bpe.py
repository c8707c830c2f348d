"""Byte-level BPE encoding and decoding with the tiktoken library.

The ranks come from a local rank file whose path is a parameter; every executor
loads the file once per Python worker.  Long texts are first cut where the split pattern
is bound to begin a new match: before white space, and between an ASCII letter and a digit.
A run of more than LONG_SPACE white space, for which the library's splitter runs out of
stack, is one match but for its last character, so it is encoded as one piece that needs no
splitting.  Decoding gathers the raw bytes of the ids from one array of all tokens' bytes,
and never goes through text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Texts of more characters than this are cut at safe places first.
LONG_TEXT = 8192
#: White space of the split pattern: fixed values.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACE = 4096
_RUN = re.compile(rf"[{_SPACE}]{{{LONG_SPACE},}}")
_SAFE = re.compile(rf"(?<=[^{_SPACE}])(?=[{_SPACE}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
#: About this many bytes of text are encoded between two output batches.
BATCH_CHARS = 1 << 21


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    """The tiktoken encoding of a rank file, without special tokens."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str):
    """``(bytes, starts, sizes)`` of the tokens of a rank file by id; an id without a token
    has the size -1."""
    import numpy as np

    by_id = {i: token for token, i in read_ranks(path).items()}
    sizes = np.full(max(by_id, default=-1) + 1, -1, dtype=np.int64)
    sizes[list(by_id)] = [len(x) for x in by_id.values()]
    whole = np.frombuffer(b"".join(by_id[i] for i in sorted(by_id)), dtype=np.uint8)
    return whole, np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0), sizes


def decode_ids(table, packed: bytes | None) -> bytes:
    """The bytes of packed ids; an id that the rank file doesn't have is an error."""
    import numpy as np

    whole, starts, sizes = table
    ids = np.frombuffer(packed or b"", dtype="<u4").astype(np.int64)
    n = sizes[ids]
    if (n < 0).any():
        raise KeyError(f"no token has the id {ids[n < 0][0]}")
    place = np.arange(n.sum()) + np.repeat(starts[ids] - (np.cumsum(n) - n), n)
    return whole[place].tobytes()


def safe_pieces(text: str, size: int = LONG_TEXT) -> Iterator[tuple[str, bool]]:
    """Cut a text into pieces that the split pattern treats alone as it treats them in place,
    of ``size`` characters or more where it can be cut, and whether a piece is one match."""
    start = 0
    for run in [*_RUN.finditer(text), None]:
        end = run.start() if run else len(text)
        while end - start > size:
            cut = _SAFE.search(text, start + size, end)
            if cut is None:
                break
            yield text[start : cut.start()], False
            start = cut.start()
        if start < end:
            yield text[start:end], False
        if run:
            # the match leaves the last character to what follows, if anything does
            start = run.end() - (run.end() < len(text))
            yield text[end:start], True


def encode_text(enc, text: str) -> list[int]:
    if len(text) <= LONG_SPACE:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece, one in safe_pieces(text):
        ids += enc._encode_single_piece(piece) if one else enc.encode_ordinary(piece)
    return ids


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_decoded: bool = False) -> DataFrame:
    """One row ``(id, ids)`` per row of ``df``: token ids packed as little-endian
    unsigned 32-bit integers.  ``with_decoded`` adds ``decoded``, the bytes that the packed
    ids stand for, in the same pass: one Python worker a task serves both ways.  A null or empty text has no ids; a text of any length is
    encoded whole; repeated rows and null keys stay as they are; further columns are not
    read; an empty table gives an empty result."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        enc, table = encoder(ranks_path, pattern), token_bytes(ranks_path) if with_decoded else None
        for batch in batches:
            for part in slices(batch, 1, BATCH_CHARS):
                out = [np.asarray(encode_text(enc, t or ""), dtype="<u4").tobytes() for t in part.column(1).to_pylist()]
                back = [pa.array([decode_ids(table, x) for x in out], pa.binary())] if with_decoded else []
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary()), *back], names)

    names = ["key", "ids", "decoded"] if with_decoded else ["key", "ids"]
    schema = f"key {kind}, ids binary" + (", decoded binary" if with_decoded else "")
    return df.select(F.col(id_col).alias("key"), F.col(text_col).alias("t")).mapInArrow(run, schema).withColumnRenamed("key", id_col)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``df`` and the raw bytes of the packed ids; null ids give no bytes."""

    def bytes_of(ids):
        import pandas as pd

        table = token_bytes(ranks_path)
        return pd.Series([decode_ids(table, x) for x in ids], dtype=object)

    return df.withColumn(out_col, F.pandas_udf(bytes_of, "binary")(F.col(ids_col)))
