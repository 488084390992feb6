"""Packing: documents in sequences of several context sizes, each full, so that little or nothing is padded.

A document's ids, with an end id, are cut at the longest context; what is left of it is routed to a tier, the shortest
context that holds it. Chunks are dealt to cells of a bounded number of ids. In a cell, tiers are packed from the
longest on: a window takes the longest chunk of its tier, the gap is filled from whatever is shorter, longest first,
and where nothing fits the longest chunk left is cut, its rest going back to the tier that it then fits. So every
window is full, and at most one document is cut for each window. What is left at a cell's end is cut at powers of two,
so it is not padded either. A cell's sequences are dealt to step groups with about equal numbers of ids, and equal
sums of squares of their pieces (the cost of attention) as far as that allows.

The chunks are a written table, so that cells can be made again, and always alike, when executors are lost. A cell is
given by a hash of the chunk's number, so neither a source nor copies nor a very long document meet in one.

Defined cases. Null text: as empty; an empty text has its end id only. Null or repeated ids and repeated rows: each row
is a document with pieces of its own. Empty table: no pieces. Other columns have no effect, whatever their names. Texts
of any length are packed whole. Ties: by the chunk's number.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, packs, prepare, written
from .words import pack_source

#: Bytes of text that are encoded at once, ids of a cell, windows of the longest context in a step.
PACK_BYTES, CELL_IDS, STEP_WINDOWS = 16 << 20, 1 << 22, 64
CONTEXTS = (4096, 2048, 1024, 512, 256)
#: Sequences of a cell are numbered from cell * CELL_NUMBERS.
CELL_NUMBERS = 1 << 24


def chunks(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, longest: int = CONTEXTS[0], pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(k0, number, start, length, doc_tokens, ids): each document's ids and its end id, cut at every `longest`.

    number: of the document, by the place of its row; ids: little-endian, of two bytes where the vocabulary allows it.
    """
    prepare(docs.sparkSession)
    from .ids import Ids, ids_of

    short = np.dtype("<u2") if max(len(Ids(tokenizer_path).last), end_id + 1) <= 1 << 16 else np.dtype("<u4")
    kind = T.StructType([T.StructField("k0", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("number", "start", "length", "doc_tokens")), T.StructField("ids", T.BinaryType())])

    def run(batches):
        ids, end, seen = ids_of(tokenizer_path), np.array([end_id], short).tobytes(), 0
        for number, table in packs(batches, "text", pack_bytes):
            base = number >> 32 << 32
            text = table.column("text").combine_chunks()
            flat, counts = ids.of(text if isinstance(text, pa.Array) else pa.concat_arrays(text.chunks))
            blob, width = flat.astype(short).tobytes(), short.itemsize
            del flat
            stops = np.cumsum(counts) * width
            row, start, length, ids_out = [], [], [], []
            for i, (n, stop) in enumerate(zip(counts.tolist(), stops.tolist(), strict=True)):
                first = stop - n * width
                for at in range(0, n + 1, longest):
                    last = at + longest > n
                    row.append(i)
                    start.append(at)
                    length.append(n + 1 - at if last else longest)
                    ids_out.append(blob[first + at * width : stop] + end if last else blob[first + at * width : first + (at + longest) * width])
            row = np.array(row, np.int64)
            columns = [table.column("k0").take(pa.array(row)).combine_chunks(), pa.array(base + seen + row), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(counts[row].astype(np.int64) + 1), pa.array(ids_out, pa.binary())]
            seen += len(counts)
            yield from pa.table(columns, names=kind.names).to_batches(max_chunksize=4096)
        give_back()

    return pack_source(docs, [id_col], text_col).mapInArrow(run, kind)


class Chunks:
    """Chunks by length: the longest of at most some length is found at once, whatever their number."""

    def __init__(self, lengths: list[int]):
        self.held: dict[int, list[tuple[int, int]]] = {}
        self.mask = 0
        for i in range(len(lengths) - 1, -1, -1):  # the first of equal length is taken first
            self.put(lengths[i], i, 0)

    def put(self, length: int, i: int, at: int) -> None:
        self.held.setdefault(length, []).append((i, at))
        self.mask |= 1 << length

    def longest(self, most: int | None = None) -> int:
        """The greatest length of at most `most` that there is; 0: none."""
        return max(0, (self.mask if most is None else self.mask & ((1 << most + 1) - 1)).bit_length() - 1)

    def take(self, length: int) -> tuple[int, int]:
        out = self.held[length].pop()
        if not self.held[length]:
            self.mask ^= 1 << length
        return out


def fill(lengths: list[int], contexts: tuple[int, ...] = CONTEXTS) -> list[list[tuple[int, int, int]]]:
    """Sequences of (chunk, from, length): each as long as a context, or at the end as a smaller power of two."""
    left, out = Chunks(lengths), []
    window: list[tuple[int, int, int]] = []
    for k, context in enumerate(contexts):
        shorter = contexts[k + 1] if k + 1 < len(contexts) else 0
        while (length := left.longest(context)) > shorter:
            window, gap = [], context
            while gap and length:
                window.append((*left.take(length), length))
                gap -= length
                length = left.longest(gap)
            if gap and (length := left.longest()):  # all that is left is longer
                i, at = left.take(length)
                window.append((i, at, gap))
                left.put(length - gap, i, at + gap)
                gap = 0
            if gap:
                break  # nothing is left at all
            out.append(window)
            window = []
    return out + by_powers(window)


def by_powers(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Pieces cut into sequences of powers of two, the longest first."""
    out, total = [], sum(n for _, _, n in window)
    pieces = window[::-1]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        out.append([])
        while size:
            i, at, n = pieces.pop()
            use = min(n, size)
            out[-1].append((i, at, use))
            size -= use
            if n > use:
                pieces.append((i, at + use, n - use))
    return out


def steps(sequences: list[list[tuple[int, int, int]]], step_ids: int) -> list[int]:
    """The step of each sequence: the one with the fewest ids so far, then the least cost; the longest sequences first."""
    size = [sum(n for _, _, n in s) for s in sequences]
    cost = [sum(n * n for _, _, n in s) for s in sequences]
    groups = [(0, 0, g) for g in range(max(1, round(sum(size) / step_ids)))]
    out = [0] * len(sequences)
    for k in sorted(range(len(sequences)), key=lambda k: (-size[k], -cost[k], k)):
        n, c, g = heapq.heappop(groups)
        out[k] = g
        heapq.heappush(groups, (n + size[k], c + cost[k], g))
    return out


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, contexts: tuple[int, ...] = CONTEXTS, cell_ids: int = CELL_IDS, step_windows: int = STEP_WINDOWS, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """A row for each piece: id_col, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset,
    context (the sequence's length) and step. See the module for the method and the defined cases.

    contexts: falling powers of two. A task holds one cell; cells grow in number, not in size.
    """
    if any(c & (c - 1) or c < 1 for c in contexts) or list(contexts) != sorted(set(contexts), reverse=True):
        raise ValueError(f"contexts must be falling powers of two: {contexts}")
    table = written(chunks(docs, tokenizer_path, id_col=id_col, text_col=text_col, end_id=end_id, longest=contexts[0], pack_bytes=pack_bytes), "chunks")
    found = table.agg(F.sum("length"), F.max(F.octet_length("ids") / F.col("length"))).first()
    cells, short = max(1, round((found[0] or 0) / cell_ids)), np.dtype("<u2") if (found[1] or 2) == 2 else np.dtype("<u4")
    longs = ("start", "length", "doc_tokens", "sequence_id", "offset", "context", "step")
    kind = T.StructType([table.schema["k0"], *(T.StructField(c, T.LongType()) for c in longs), T.StructField("ids", T.BinaryType())])

    def run(cell: pa.Table) -> pa.Table:
        number = cell.column("cell")[0].as_py()
        cell = cell.sort_by([("number", "ascending"), ("start", "ascending")]).combine_chunks()
        start, ids = cell.column("start").to_numpy(), cell.column("ids").to_pylist()
        sequences = fill(cell.column("length").to_pylist(), contexts)
        group = steps(sequences, step_windows * contexts[0])
        rows, put, blobs, width = [], [], [], short.itemsize
        for k, (sequence, g) in enumerate(zip(sequences, group, strict=True)):
            offset, context = 0, sum(n for _, _, n in sequence)
            for i, at, n in sequence:
                rows.append(i)
                put.append((start[i] + at, n, number * CELL_NUMBERS + k, offset, context, (number << 20) + g))
                blobs.append(np.frombuffer(ids[i], short)[at : at + n].astype("<u4").tobytes())
                offset += n
        row, columns = pa.array(rows, pa.int64()), np.array(put, np.int64).reshape(-1, 6)
        here = dict(zip(("start", "length", "sequence_id", "offset", "context", "step"), columns.T, strict=True))
        made = [pa.array(here[c]) if c in here else cell.column(c).take(row) for c in longs]
        return pa.table([cell.column("k0").take(row), *made, pa.array(blobs, pa.binary())], names=kind.names)

    dealt = table.withColumn("cell", F.pmod(F.xxhash64("number", "start"), F.lit(cells)))
    out = dealt.groupBy("cell").applyInArrow(run, kind)
    return out.select(F.col("k0").alias(id_col), "start", "length", "ids", *longs[2:])


def sequences(pieces: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, step, context, ids, pieces) from the rows of `pack`: what a trainer reads, one row for a sequence.

    ids: of the whole sequence, as bytes; pieces: (offset, length, id_col, start) in order, for attention masks. A
    sequence has at most as many pieces as ids, so a group is bounded by the context.
    """
    put = F.array_sort(F.collect_list(F.struct("offset", "length", F.col(id_col).alias("doc"), "start", "ids")))
    out = pieces.groupBy("sequence_id").agg(F.first("step").alias("step"), F.first("context").alias("context"), put.alias("put"))
    joined = F.unhex(F.array_join(F.transform("put", lambda p: F.hex(p["ids"])), ""))
    return out.select("sequence_id", "step", "context", joined.alias("ids"), F.transform("put", lambda p: F.struct(p["offset"].alias("offset"), p["length"].alias("length"), p["doc"].alias(id_col), p["start"].alias("start"))).alias("pieces"))
