"""The distinct-word table: each distinct word of the corpus meets its data once, and goes back by position.

Documents are taken in packs of a bounded size. A pack names each of its distinct words once, in word buckets
(bucket = hash of the word). All packs' words of a bucket stream through one task, bucket after bucket, where each
distinct word is looked at once; the answer goes back to the pack, which holds the texts, and is joined to the words
there by position. So what is shuffled is each pack's vocabulary and a compressed copy of the texts, never a row for
each token, and a very common word has one entry for each pack, not for each use. A task holds the distinct words of
one bucket at most, and the number of buckets grows with the texts.

Or texts are split once for all (`numbered`): a pack then holds the numbers of its words instead of its texts.

Packs are made once: in a table, or in an exchange that both readers share. So both see the same packs, however the
input is cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeze, give_back, packs, prepare, table_bytes, text_of, thaw

#: Bytes of text in a pack. A pack's texts, vocabulary and answers are in one Python worker's memory together.
PACK_BYTES = 16 << 20

#: Words of so many bytes have their buckets reckoned together, longer ones one by one.
SHORT = 32

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def split(text: bytes, lower: bool) -> list[bytes]:
    """Words: the longest runs without ASCII white space (space, \\t, \\n, \\v, \\f, \\r)."""
    return (text.translate(LOWER) if lower else text).split()


def distinct(texts: list[bytes], lower: bool) -> dict[bytes, None]:
    """The words of texts, in the order in which they first come up."""
    out: dict[bytes, None] = {}
    for t in texts:
        out.update(dict.fromkeys(split(t, lower)))
    return out


def positions(text: bytes, lower: bool, at: dict[bytes, int]) -> np.ndarray:
    """The number of each word of a text."""
    ws = split(text, lower)
    return np.fromiter(map(at.__getitem__, ws), np.int32, len(ws))


def buckets_of(words: list[bytes], n: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % n


def in_buckets(words, n: int) -> Iterator[tuple[int, list[bytes]]]:
    """Distinct words by bucket, in the order given: that in which they first come up in their pack."""
    ordered = list(words)
    b = buckets_of(ordered, n)
    order = np.argsort(b, kind="stable")
    cuts = np.flatnonzero(np.diff(b[order], prepend=-1))
    for i, start in enumerate(cuts):
        stop = cuts[i + 1] if i + 1 < len(cuts) else len(order)
        yield int(b[order[start]]), [ordered[k] for k in order[start:stop]]


def bucket_count(text_bytes: int, pack_bytes: int = PACK_BYTES) -> int:
    """Word buckets for so many bytes of text: distinct words grow more slowly than texts."""
    return max(64, round((text_bytes / pack_bytes) ** 0.75))


def pack_source(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """keep under the names k0, k1, ... and the text (null: empty) as text: no name clashes inside."""
    return docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], text_of(docs, text_col).alias("text"))


def texts(source: DataFrame, pack_bytes: int) -> DataFrame:
    """(pack, body): the packs, compressed."""
    prepare(source.sparkSession)

    def run(batches):
        for pack, table in packs(batches, "text", pack_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([pack], pa.int64()), pa.array([freeze(table)], pa.binary())], names=["pack", "body"])

    return source.mapInArrow(run, "pack long, body binary")


def vocabularies(packed: DataFrame, n: int, *, lower: bool) -> DataFrame:
    """(pack, bucket, words, counts): each pack's distinct words by bucket, one to a line; nothing is counted.

    packed: see texts.
    """
    prepare(packed.sparkSession)

    def run(batches):
        for batch in batches:
            for pack, body in zip(batch.column("pack").to_pylist(), batch.column("body"), strict=True):
                rows = [(b, b"\n".join(ws)) for b, ws in in_buckets(distinct(table_bytes(thaw(body.as_buffer()).column("text")), lower), n)]
                if rows:
                    bs, ws = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([pack] * len(bs), pa.int64()), pa.array(bs, pa.int32()), pa.array(ws, pa.binary()), pa.array([b""] * len(bs), pa.binary())], names=["pack", "bucket", "words", "counts"])
        give_back()

    return packed.mapInArrow(run, "pack long, bucket int, words binary, counts binary")


def _hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    """A hash of each word, for its bucket."""
    if not len(words):
        return np.zeros(0, np.uint64)
    start = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data, length = np.frombuffer(words.buffers()[2] or b"", np.uint8), np.diff(start)
    out = np.full(len(words), 0xCBF29CE484222325, np.uint64)
    for k in range(min(SHORT, int(length.max()))):
        at = np.flatnonzero(length > k)
        out[at] = (out[at] ^ data[start[at] + k]) * np.uint64(0x100000001B3)
    for i in np.flatnonzero(length > SHORT).tolist():
        out[i] = zlib.crc32(words[i].as_buffer())
    return out ^ (out >> np.uint64(32))


def number_pack(text: pa.Array, n: int, lower: bool) -> tuple[np.ndarray, np.ndarray, pa.LargeBinaryArray, np.ndarray]:
    """(number of each text's words; each word's number, text after text; the distinct words by bucket; their buckets).
    Words are numbered as the distinct ones stand."""
    text = text.cast(pa.large_string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    size = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    del parts
    number, known = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.large_binary())
    length = pc.binary_length(known).to_numpy(zero_copy_only=False)
    bucket = (_hashes(known) % np.uint64(n)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    if not length.all():  # white space at an end of a text leaves an empty word there
        order, real = order[length[order] > 0], length[number] > 0
        size = np.bincount(np.repeat(np.arange(len(size)), size)[real], minlength=len(size))
        number = number[real]
    place = np.zeros(len(known), np.int32)
    place[order] = np.arange(len(order))
    return size, place[number], known.take(pa.array(order)), bucket[order]


def numbered(source: DataFrame, n: int, *, lower: bool, pack_bytes: int, counted: Callable) -> DataFrame:
    """(pack, bucket, words, counts, body): each pack's distinct words by bucket, one to a line, with an int64 for each
    word's uses in the rows that counted(pack's table), booleans, is true for; and one row of bucket -1 whose body is the
    pack's other columns with each text as `numbers`, the numbers of its words, compressed. Words are numbered from 0
    through the pack's buckets in their order. Each text is split once, here.
    """
    prepare(source.sparkSession)

    def run(batches):
        for pack, table in packs(batches, "text", pack_bytes):
            text = table.column("text")
            size, number, words, bucket = number_pack(text.cast(pa.large_string()).combine_chunks(), n, lower)
            table = table.drop_columns("text")
            counts = np.bincount(number[np.repeat(np.asarray(counted(table), bool), size)], minlength=len(words)).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(words))
            lines = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), words), pa.scalar(b"\n", pa.large_binary()))
            parts = [counts[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            del text, words
            table = table.replace_schema_metadata({"words": str(len(counts))}).append_column("numbers", pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int64()), pa.array(number)))
            k = len(parts)
            yield pa.RecordBatch.from_arrays([pa.array([pack] * (k + 1), pa.int64()), pa.array([*bucket[cuts[:-1]].tolist(), -1], pa.int32()), pa.array([*lines.to_pylist(), None], pa.binary()), pa.array([*parts, None], pa.binary()), pa.array([None] * k + [freeze(table)], pa.binary())], names=["pack", "bucket", "words", "counts", "body"])
        give_back()

    return source.mapInArrow(run, "pack long, bucket int, words binary, counts binary, body binary")


def in_turn(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by the first key, each task's in the order of all of them."""
    return df.repartition(keys[0]).sortWithinPartitions(*keys)


def totals(vocabulary: DataFrame, most: int = 1 << 16) -> DataFrame:
    """(pack, bucket, words, counts) with pack -1: each counted word of the corpus once, with its count."""

    def run(batches):
        bucket, number = None, {}

        def out():
            ws = sorted(number)
            for k in range(0, len(ws), most):
                part = ws[k : k + most]
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([bucket], pa.int32()), pa.array([b"\n".join(part)], pa.binary()), pa.array([np.array([number[w] for w in part], np.int64).tobytes()], pa.binary())], names=["pack", "bucket", "words", "counts"])
            number.clear()

        for batch in batches:
            for b, ws, cs in zip(*(batch.column(c).to_pylist() for c in ("bucket", "words", "counts")), strict=True):
                if b != bucket:
                    yield from out()
                    bucket = b
                for w, c in zip(ws.split(b"\n"), np.frombuffer(cs, np.int64).tolist(), strict=True):
                    if c:
                        number[w] = number.get(w, 0) + c
        yield from out()
        give_back()

    return in_turn(vocabulary, "bucket").mapInArrow(run, "pack long, bucket int, words binary, counts binary")


def answers(words: DataFrame, begin: Callable) -> DataFrame:
    """(pack, bucket, check, payload): begin() makes a bucket's answer(words, counts), which gives each line's payload.

    Lines of pack -1 come first in their bucket and have no payload: answer only learns from them.
    """

    def run(batches):
        bucket, answer = None, None
        for batch in batches:
            for p, b, ws, cs in zip(*(batch.column(c).to_pylist() for c in ("pack", "bucket", "words", "counts")), strict=True):
                if b != bucket:
                    bucket, answer = b, begin()
                payload = answer(ws.split(b"\n"), np.frombuffer(cs, np.int64), p < 0)
                if p >= 0:
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([b], pa.int32()), pa.array([zlib.crc32(ws)], pa.int64()), pa.array([payload], pa.binary())], names=["pack", "bucket", "check", "payload"])
        give_back()

    return in_turn(words, "bucket", "pack").mapInArrow(run, "pack long, bucket int, check long, payload binary")


def joined(packed: DataFrame, replies: DataFrame, n: int, finish: Callable, schema: str, *, lower: bool) -> DataFrame:
    """Each pack with its replies: finish(table, texts, known) -> pa.Table.

    texts: of the pack, as bytes; known: (words of a bucket, payload) for each bucket. A reply to other words than
    the pack's is an error: packs are made once.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        replied = {b: (c, p) for b, c, p in zip(right.column("bucket").to_pylist(), right.column("check").to_pylist(), right.column("payload").to_pylist(), strict=True)}
        for body in left.column("body").to_pylist():
            table = thaw(body)
            text = table_bytes(table.column("text"))
            table = table.drop_columns("text")
            seen = distinct(text, lower)  # words are split anew where they are needed: a list of all of them is far larger
            known = []
            for b, ws in in_buckets(seen, n):
                c, p = replied[b]
                if c != zlib.crc32(b"\n".join(ws)):
                    raise RuntimeError("a pack's words and their replies differ")
                known.append((ws, p))
            del seen
            out.append(finish(table, text, known))
        return pa.concat_tables(out) if out else None

    return _together(packed, replies, run, schema)


def met(packed: DataFrame, replies: DataFrame, item: np.dtype, finish: Callable, schema) -> DataFrame:
    """Each pack of `numbered` with its replies: finish(table, payload) -> pa.Table. payload: from `answers`, whose payloads
    are arrays of item, one for each word; here of all buckets, so in the order of the words' numbers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        payload = right.column("payload").to_pylist()
        payload = np.frombuffer(b"".join(payload[i] for i in np.argsort(right.column("bucket").to_numpy())), item)
        out = []
        for body in left.column("body").to_pylist():
            table = thaw(body)
            if int(table.schema.metadata[b"words"]) != len(payload):
                raise RuntimeError("a pack's words and their replies differ")
            out.append(finish(table, payload))
        return pa.concat_tables(out) if out else None

    return _together(packed, replies, run, schema)


def _together(packed: DataFrame, replies: DataFrame, run: Callable, schema) -> DataFrame:
    """run(a pack's rows, its replies) for each pack."""

    def safe(left: pa.Table, right: pa.Table) -> pa.Table:
        got = run(left, right)
        give_back()
        return got if got is not None else empty

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    empty = to_arrow_schema(kind).empty_table()
    return packed.groupBy("pack").cogroup(replies.groupBy("pack")).applyInArrow(safe, kind)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists flat[starts[i]:starts[i]+lengths[i]] for i in which, one after another, and their lengths."""
    n = lengths[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64) + np.repeat(starts[which] - (ends - n), n)
    return flat[at], n
