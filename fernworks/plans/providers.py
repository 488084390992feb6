"""Models behind an interface. The stand-ins here are deterministic and offline; they are not trained models, and only
the relational meaning of what is built on them can be compared."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.workers import prepare

_WORD = re.compile(r"\w+")


class Provider(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray: ...
    def generate(self, prompts: list[str]) -> list[str]: ...
    def rerank(self, queries: list[str], documents: list[str]) -> list[float]: ...


class Standin:
    """Hashed bags of words as vectors, all candidates kept but the last, overlap of words as pair score."""

    def __init__(self, dimension: int = 64, prefix: str = ""):
        self.dimension, self.prefix = dimension, prefix

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for i, t in enumerate(texts):
            for w in _WORD.findall((self.prefix + (t or "")).lower()):
                out[i, int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") % self.dimension] += 1
        return out

    def generate(self, prompts: list[str]) -> list[str]:
        n = [len(re.findall(r"(?m)^\d+\. ", p)) for p in prompts]
        return [json.dumps({"keep": list(range(1, max(2, k)))}) for k in n]

    def rerank(self, queries: list[str], documents: list[str]) -> list[float]:
        sets = lambda xs: [set(_WORD.findall((x or "").lower())) for x in xs]
        return [len(a & b) / len(a | b) if a | b else 0.0 for a, b in zip(sets(queries), sets(documents), strict=True)]


PROVIDERS: dict[str, Callable[..., Provider]] = {"standin": Standin}


@contextmanager
def registered(mode: str, make: Callable[..., Provider]):
    """A provider under a name, for what is planned in this block."""
    PROVIDERS[mode] = make
    try:
        yield
    finally:
        del PROVIDERS[mode]


def provider(config: dict, defaults: dict | None = None) -> Provider:
    """The provider of a model's configuration: `mode` names its class, all else are its arguments; defaults are filled in."""
    return maker(config, defaults)()


def maker(config: dict, defaults: dict | None = None) -> Callable[[], Provider]:
    """What makes the provider of a configuration in a task; the class goes with it, so workers need no registry."""
    args = {**(defaults or {}), **config}
    make = PROVIDERS[args.pop("mode")]
    return lambda: make(**args)


def prompt_options(model: dict, task_prompt: str | None = None) -> tuple[str, dict[str, str]]:
    """The prefix of every text, and what is passed on about prompts: a task's own prompt where the model takes one,
    else the model's named prompt, else nothing."""
    if model.get("supports_prompt") and task_prompt:
        options = {"prompt": task_prompt}
    elif model.get("query_prompt_name"):
        options = {"prompt_name": model["query_prompt_name"]}
    else:
        options = {}
    return model.get("query_prefix", ""), options


def embedded(df: DataFrame, text: str, config: dict, defaults: dict | None = None) -> DataFrame:
    """(id, embedding) of (id, text). The provider is made once in each task."""
    prepare(df.sparkSession)
    make = maker(config, defaults)

    def run(batches: Iterator[pa.RecordBatch]):
        p = make()
        for b in batches:
            v = p.embed(b.column("text").to_pylist()).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("id"), lists], names=["id", "embedding"])

    return df.selectExpr("id", f"{text} as text").mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, embedding array<float>")


def generated(df: DataFrame, prompt: str, config: dict, defaults: dict | None = None) -> DataFrame:
    """(id, data, error) of (id, prompt): a batch that fails gives its message for each of its rows."""
    prepare(df.sparkSession)
    make = maker(config, defaults)

    def run(batches: Iterator[pa.RecordBatch]):
        p = make()
        for b in batches:
            try:
                data, error = p.generate(b.column("prompt").to_pylist()), [None] * b.num_rows
            except Exception as e:  # noqa: BLE001  whatever a model raises is a result
                data, error = [None] * b.num_rows, [f"{type(e).__name__}: {e}"] * b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(data, pa.string()), pa.array(error, pa.string())], names=["id", "data", "error"])

    return df.selectExpr("id", f"{prompt} as prompt").mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, data string, error string")


def pair_scores(pairs: DataFrame, config: dict, defaults: dict | None = None) -> DataFrame:
    """pairs (ad_id, onet_code, query, document) with rerank_score and error; where the model fails the score is null,
    never a made-up zero, and error is its message."""
    prepare(pairs.sparkSession)
    make = maker(config, defaults)

    def run(batches: Iterator[pa.RecordBatch]):
        p = make()
        for b in batches:
            try:
                s, error = p.rerank(b.column("query").to_pylist(), b.column("document").to_pylist()), [None] * b.num_rows
            except Exception as e:  # noqa: BLE001  whatever a model raises is a result
                s, error = [None] * b.num_rows, [f"{type(e).__name__}: {e}"] * b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("ad_id"), b.column("onet_code"), pa.array(s, pa.float64()), pa.array(error, pa.string())], names=["ad_id", "onet_code", "rerank_score", "error"])

    kind = lambda c: pairs.schema[c].dataType.simpleString()
    return pairs.select("ad_id", "onet_code", "query", "document").mapInArrow(run, f"ad_id {kind('ad_id')}, onet_code {kind('onet_code')}, rerank_score double, error string")
