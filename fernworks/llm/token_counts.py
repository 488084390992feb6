"""Token counts: batches balanced by bytes, long texts split where no token can cross, only lengths returned.

A text may be cut before an ASCII white-space character that follows a character which is not white space: no token of
a byte-level pre-tokenizer crosses that point, special strings hold no white space, and nothing looks behind it.

Defined cases. Null text: as empty; empty text: no bytes, no tokens. Null or repeated ids, repeated rows: one result
row for each row. Empty table: no rows. A very long text is cut at safe points only; where there is none it is encoded
in one piece. Special strings inside a text count as their special token. Other columns have no effect.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import tokenizer
from .common import packs, prepare
from .words import pack_source

#: Bytes that a batch for the encoder holds at most, but for one longer piece, and characters from which a text is cut.
BATCH_BYTES, LONG = 1 << 20, 1 << 16

#: Texts in which a cut at any safe point must change nothing, for a tokenizer to be taken.
_PROBES = ("a b  c\n\nd", "it's  x\ty\r\n z", "12 345, <|endoftext|> é ü\n", "A .B !C\t\t(d)  ", "naïve  数学 и 👩‍👧 end")

_SAFE = re.compile(r"(?<=\S)(?=[ \n\t\r])")


def cut(text: str, long: int = LONG) -> list[str]:
    """text in pieces of at least `long` characters that are encoded alike alone; joined they are text."""
    out, start = [], 0
    while len(text) - start > long:
        m = _SAFE.search(text, start + long)
        if not m:
            break
        out.append(text[start : m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def cuts_are_safe(path: str) -> bool:
    """Whether the tokenizer gives the same ids for a text and for its pieces, cut at every safe point of the probes."""
    ids = lambda s: tokenizer(path).encode(s, add_special_tokens=False).ids
    return all(ids(p) == [i for x in cut(p, 1) for i in ids(x)] for p in _PROBES)


def token_counts(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, long: int = LONG) -> DataFrame:
    """id_col, n_bytes (UTF-8) and n_tokens for each document. See the module for the defined cases.

    Raises ValueError for a tokenizer whose tokens cross the points at which long texts are cut.
    """
    if not cuts_are_safe(tokenizer_path):
        raise ValueError(f"{tokenizer_path}: its ids change where long texts are cut")
    prepare(docs.sparkSession)

    def run(batches):
        encode = tokenizer(tokenizer_path).encode_batch_fast
        for _, table in packs(batches, "text", batch_bytes):
            texts = table.column("text").to_pylist()
            piece, of, weight = [], [], []
            for i, (t, size) in enumerate(zip(texts, pa.compute.binary_length(table.column("text")).to_pylist(), strict=True)):
                pieces = cut(t, long) if len(t) > long else [t]
                piece += pieces
                of += [i] * len(pieces)
                weight += [size] if len(pieces) == 1 else [len(p.encode()) for p in pieces]
            total, start = np.zeros(len(texts), np.int64), 0
            while start < len(piece):  # one long text has many pieces
                stop, size = start, 0
                while stop < len(piece) and (stop == start or size + weight[stop] <= batch_bytes):
                    size += weight[stop]
                    stop += 1
                got = encode(piece[start:stop], add_special_tokens=False)
                np.add.at(total, np.array(of[start:stop]), np.fromiter(map(len, got), np.int64, stop - start))
                start = stop
            size = pa.compute.binary_length(table.column("text")).cast(pa.int64())
            yield from pa.table([table.column("k0"), size, pa.array(total)], names=["k0", "n_bytes", "n_tokens"]).to_batches()

    import pyarrow.compute  # noqa: F401

    kind = T.StructType([T.StructField("k0", docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return pack_source(docs, [id_col], text_col).mapInArrow(run, kind).withColumnRenamed("k0", id_col)
