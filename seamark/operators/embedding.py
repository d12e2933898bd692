"""Embeddings of chunks by any model that follows a small protocol, and the index of vectors."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.text import tokens

BATCH = 64


class Model(Protocol):
    """What an embedding model has to offer; one is made in each Python worker."""

    name: str
    dim: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class LocalModel:
    """A deterministic stand-in: numbers drawn from a generator seeded with name, size and text."""

    def __init__(self, dim: int = 64, name: str = "local-deterministic"):
        self.dim, self.name = dim, name

    def embed(self, texts: list[str]) -> list[list[float]]:
        def one(t):
            rng = random.Random(int(hashlib.sha1(f"{self.name}|{self.dim}|{t}".encode()).hexdigest()[:16], 16))
            return [rng.uniform(-1, 1) for _ in range(self.dim)]

        return [one(t) for t in texts]


class FileModel:
    """A model in a file, through the bindings that run it (``llama_cpp``), where they are installed."""

    def __init__(self, path: str, n_ctx: int = 4096, seed: int = 0):
        try:
            from llama_cpp import Llama
        except ImportError as e:
            raise RuntimeError("a model file needs the package llama_cpp") from e
        self.name = os.path.basename(path)
        self._model = Llama(model_path=path, n_ctx=n_ctx, seed=seed, embedding=True, verbose=False)
        self.dim = self._model.n_embd()

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [list(self._model.embed(t)) for t in texts]


def pick_model(files: dict[str, int]) -> str | None:
    """Of model files (path to size) the smallest whose name tells an embedding model, else the smallest;
    the smaller path on a tie."""
    some = [p for p in files if p.lower().endswith(".gguf")]
    named = [p for p in some if re.search(r"\b(bge|nomic|embed)\b", os.path.basename(p), re.I)]
    return min(named or some, key=lambda p: (files[p], p), default=None)


def model_files(folder: str) -> dict[str, int]:
    return {os.path.join(folder, n): os.path.getsize(os.path.join(folder, n)) for n in os.listdir(folder)} if os.path.isdir(folder) else {}


def health(make: Callable[[], Model]) -> dict:
    """Whether a model can be made and embeds a text: ``ok, error, model, dim``."""
    try:
        m = make()
        got = m.embed(["hello"])
        if len(got) != 1 or len(got[0]) != m.dim:
            raise ValueError(f"{len(got[0]) if got else 0} numbers instead of {m.dim}")
        return {"ok": True, "error": None, "model": m.name, "dim": m.dim}
    except Exception as e:
        return {"ok": False, "error": str(e), "model": None, "dim": None}


def embed(chunks: DataFrame, make: Callable[[], Model] | None = None, dim: int = 64, model: str = "local-deterministic", max_tokens: int = 512, done: DataFrame | None = None, batch: int = BATCH, fall_back: bool = False) -> DataFrame:
    """``doc_id, chunk_id, truncated, model, dim, text_sha1, embedding``: a vector for each text.

    ``make`` makes the model (``dim`` and ``model`` are its size and name; by default the local one), once in
    each worker; texts reach it ``batch`` at a time, cut after ``max_tokens`` words. With ``fall_back`` the local
    model of the same size takes over where ``make`` fails. Texts already embedded (``done``: ``chunk_id,
    model, text_sha1``) are skipped by an anti-join; null texts have no vector."""
    words = tokens(F.col("text"))
    cut = F.when(F.size(words) > max_tokens, F.array_join(F.slice(words, 1, max_tokens), " ")).otherwise(F.col("text"))
    base = chunks.where("text IS NOT NULL").select("doc_id", "chunk_id", (F.size(words) > max_tokens).alias("truncated"), F.lit(model).alias("model"), F.lit(dim).alias("dim"), F.sha1(cut).alias("text_sha1"), cut.alias("text"))
    if done is not None:
        base = base.join(done.select("chunk_id", "model", "text_sha1"), ["chunk_id", "model", "text_sha1"], "left_anti")
    local = lambda: LocalModel(dim, model)

    @F.pandas_udf("array<double>")
    def vector(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            m = (make or local)()
        except Exception:
            if not fall_back:
                raise
            m = local()
        for texts in series:
            rows = texts.tolist()
            yield pd.Series([v for at in range(0, len(rows), batch) for v in m.embed(rows[at : at + batch])], dtype=object)

    return base.withColumn("embedding", vector("text")).drop("text")


def embed_local(chunks: DataFrame, dim: int = 64, max_tokens: int = 512, model: str = "local-deterministic", done: DataFrame | None = None) -> DataFrame:
    """``embed`` with the local model."""
    return embed(chunks, None, dim, model, max_tokens, done)


def index(embedded: DataFrame) -> DataFrame:
    """The vectors as float32, the form of the index."""
    return embedded.select("doc_id", "chunk_id", "model", F.col("embedding").cast("array<float>").alias("vector"))
