"""BPE encoding and decoding over a distinct-word table.

Texts are split into words at ASCII white space. Such a split is safe for a tokenizer whose pre-tokenizer drops white
space and whose normaliser works inside words (see `splits_at_spaces`): the ids of a text are then the ids of its words
one after another. Each distinct word is encoded once in the whole corpus; its ids are joined back to the texts by
position. Decoding joins the table of pieces on the id (once for each distinct word) and puts the pieces back by the
same positions.

Defined cases. Null text: as empty; empty or blank text: no ids, decoded to the empty string. Repeated rows: each has
its own result row. Null or repeated ids: carried as they are. Empty table: no rows. Other columns are left out unless
`keep` names them. A text of any length, and a single word of any length, is encoded whole. Special strings inside a
text become their special token, as the library does by default.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

#: Words of which Python objects are held at once where a slice of a pack is enough.
SLICE_WORDS, SLICE_TEXTS = 1 << 16, 64
#: Distinct words of a bucket whose ids are held; a bucket with more begins anew, and its words may be encoded again.
HELD_WORDS = 1 << 20


@lru_cache(maxsize=4)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def pieces(path: str) -> np.ndarray:
    """The id-to-piece table."""
    t = tokenizer(path)
    table = np.full(max(t.get_vocab(with_added_tokens=True).values(), default=-1) + 1, b"", dtype=object)
    for piece, i in t.get_vocab(with_added_tokens=True).items():
        table[i] = piece.encode()
    return table


def splits_at_spaces(path: str) -> bool:
    """Whether words may be encoded alone: no decoder, and white space leaves no trace in the ids."""
    t = tokenizer(path)
    probe = ["a b", "a  b", "a\nb", " a b ", "a ́b", "a<|endoftext|> b's", " a b c"]
    ids = lambda s: t.encode(s, add_special_tokens=False).ids
    return t.decoder is None and all(ids(s) == [i for w in s.encode().split() for i in ids(w.decode())] for s in probe)


def _encode(ws: list[bytes], path: str) -> list[list[int]]:
    out: list[list[int]] = []
    for k in range(0, len(ws), 4096):
        out += [e.ids for e in tokenizer(path).encode_batch_fast([w.decode() for w in ws[k : k + 4096]], add_special_tokens=False)]
    return out


def _pack_ids(lists: list[list[int]]) -> bytes:
    n = np.fromiter(map(len, lists), np.int32, len(lists))
    flat = np.fromiter((i for x in lists for i in x), np.int32, int(n.sum()))
    return pa.compress(np.concatenate([[len(lists)], n, flat]).astype(np.int32).tobytes(), codec="zstd", asbytes=True) + (4 * (1 + len(n) + len(flat))).to_bytes(8, "little")


def _unpack_ids(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    a = np.frombuffer(pa.decompress(blob[:-8], int.from_bytes(blob[-8:], "little"), codec="zstd", asbytes=True), np.int32)
    return a[1 : 1 + a[0]], a[1 + a[0] :]


def encode_decode(docs: DataFrame, tokenizer_path: str, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", pack_bytes: int = W.PACK_BYTES) -> DataFrame:
    """keep, ids (array<int>) and decoded (string) for each document. See the module for the defined cases.

    tokenizer_path: a file of the tokenizers library, readable on every executor. Raises ValueError for a tokenizer
    whose ids depend on the white space between words.
    """
    if not splits_at_spaces(tokenizer_path):
        raise ValueError(f"{tokenizer_path}: its ids depend on what stands between words")
    keep = list(keep)
    source = W.pack_source(docs, keep, text_col)
    n = W.bucket_count(source.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)

    def begin():
        held: dict[bytes, list[int]] = {}

        def answer(ws, _, __):
            if len(held) > HELD_WORDS:
                held.clear()
            new = [w for w in ws if w not in held]
            held.update(zip(new, _encode(new, tokenizer_path), strict=True))  # each distinct word once
            return _pack_ids([held[w] for w in ws])

        return answer

    def finish(table, texts, known):
        at: dict[bytes, int] = {}
        parts = [_unpack_ids(p) for _, p in known]
        for ws, _ in known:
            at.update(zip(ws, range(len(at), len(at) + len(ws)), strict=True))
        length = np.concatenate([np.zeros(0, np.int32), *(p[0] for p in parts)])
        flat = np.concatenate([np.zeros(0, np.int32), *(p[1] for p in parts)])
        del parts, known
        start = np.cumsum(length, dtype=np.int64) - length
        table_of = pieces(tokenizer_path)
        spelt: list[bytes] = []
        for k in range(0, len(length), SLICE_WORDS):  # id-to-piece join, once for each distinct word
            here = length[k : k + SLICE_WORDS].tolist()
            base = int(start[k])
            got = table_of[flat[base : base + sum(here)]].tolist()
            end = 0
            for n_ids in here:
                spelt.append(b" ".join(got[end : end + n_ids]))
                end += n_ids
        none = bool((length == 0).any())
        ids, decoded = [], []
        for k in range(0, len(texts), SLICE_TEXTS):  # results are made slice by slice, so that no list of all of them is held
            todo, spoken = [], []
            for t in texts[k : k + SLICE_TEXTS]:
                here = W.positions(t, False, at)
                todo.append(here)
                spoken.append(b" ".join(map(spelt.__getitem__, (here[length[here] > 0] if none else here).tolist())))
            got, each = W.gather(flat, start, length, np.concatenate(todo))
            ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum([0, *map(len, todo)])]
            ids.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(got, pa.int32())))
            decoded.append(pa.array(spoken, pa.string()))
        kept = [table.column(f"k{i}") for i in range(len(keep))]
        return pa.table([*kept, pa.chunked_array(ids, pa.list_(pa.int32())), pa.chunked_array(decoded, pa.string())], names=[*(f"k{i}" for i in range(len(keep))), "ids", "decoded"])

    schema = T.StructType([*(T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    packed = W.texts(source, pack_bytes).repartition("pack")  # one exchange, read for the words and for the join
    replies = W.answers(W.vocabularies(packed, n, lower=False), begin)
    out = W.joined(packed, replies, n, finish, schema, lower=False)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "ids", "decoded")


def decode(encoded: DataFrame, tokenizer_path: str, *, key: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """key, decoded: any table of ids decoded by a join with the id-to-piece table (for ids that were not made here).

    The piece table is as large as the vocabulary of the tokenizer, which bounds what is broadcast. An id outside it
    gives no piece. Each row is decoded by itself, whatever its key; a null list gives the empty string.
    """
    spark = encoded.sparkSession
    table = spark.createDataFrame([(i, p.decode()) for i, p in enumerate(pieces(tokenizer_path)) if p], "id int, piece string")
    numbered = encoded.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(ids_col).alias("ids"))
    long = numbered.select("row", "key", F.posexplode_outer("ids").alias("pos", "id"))
    put = F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("pos", "piece"))))
    return long.join(F.broadcast(table), "id", "left").groupBy("row").agg(F.first("key").alias(key), F.array_join(F.transform(put, lambda x: x["piece"]), " ").alias("decoded")).drop("row")
