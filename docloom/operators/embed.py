"""Embedding of chunks with an injected encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.config import Config
from docloom.errors import InputError
from docloom.functions.tokens import token_count

Encoder = Callable[[list[str]], np.ndarray]


def hashing_encoder(dim: int = 64) -> Encoder:
    """A deterministic encoder for tests: signed counts of hashed words. It says nothing about retrieval quality."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % dim] += 1 if h >> 63 else -1
            out[i, 0] += not out[i].any()
        return out

    return encode


def with_inputs(children: DataFrame, config: Config = Config()) -> DataFrame:
    """``children`` with ``embedding_input``: section, a blank line, text."""
    return children.withColumn("embedding_input", F.concat("section", F.lit("\n\n"), "text"))


def embed(children: DataFrame, load: Callable[[], Encoder], model: str, revision: str, config: Config = Config(), batch: int = 16) -> DataFrame:
    """``children`` with unit vectors and their model; inputs over the limit raise ``InputError`` before anything runs.

    ``load`` makes the encoder, once a task.
    """
    base = with_inputs(children, config)
    long = base.where(token_count("embedding_input") > config.input_limit).select("chunk_id").limit(5).collect()
    if long:
        raise InputError("inputs over the limit: " + ", ".join(r.chunk_id for r in long))

    @F.pandas_udf("array<float>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for s in texts:
            rows = [None] * len(s)
            have = [i for i, t in enumerate(s) if t is not None]
            for at in range(0, len(have), batch):
                part = have[at : at + batch]
                x = np.asarray(encoder([s.iloc[i] for i in part]), np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for i, v in zip(part, x.astype(np.float32)):
                    rows[i] = v
            yield pd.Series(rows)

    return base.withColumn("embedding", encode("embedding_input")).withColumn("model_name", F.lit(model)).withColumn("model_revision", F.lit(revision))
