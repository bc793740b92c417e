"""Encoders of texts and pictures as plug-ins, and an incremental store of their vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[Sequence[str]], np.ndarray]


def hashed_ngrams(size: int = 128, n: int = 3, seed: int = 0) -> Callable[[], Encoder]:
    """A stand-in where no model file is at hand: signed hashes of character n-grams, unit length. Empty texts give zeros."""

    def make() -> Encoder:
        import xxhash

        def encode(texts: Sequence[str]) -> np.ndarray:
            out = np.zeros((len(texts), size), np.float32)
            for i, t in enumerate(texts):
                padded = f" {t.lower()} " if t else ""
                for k in range(len(padded) - n + 1):
                    h = xxhash.xxh32_intdigest(padded[k : k + n], seed)
                    out[i, h % size] += 1 if h & 0x80000000 else -1
            length = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(length > 0, length, 1)

        return encode

    return make


def encode(df: DataFrame, key: str, text: str, make: Callable[[], Encoder], batch: int = 128) -> DataFrame:
    """(key, embedding array<float>): the encoder is built once per task and fed in batches. Filter rows before, not after."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make()
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                vectors = encoder(["" if t is None else t for t in part[text]])
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": list(vectors.astype(np.float32))})

    return df.select(key, text).mapInPandas(run, f"{key} {kind}, embedding array<float>")


def extend_store(df: DataFrame, store: DataFrame | None, key: str, text: str, make: Callable[[], Encoder]) -> DataFrame:
    """Vectors of rows that the store lacks; nothing that is stored is encoded again."""
    wanted = df.where(F.col(key).isNotNull()) if store is None else df.where(F.col(key).isNotNull()).join(store.select(key), key, "left_anti")
    return encode(wanted, key, text, make)
