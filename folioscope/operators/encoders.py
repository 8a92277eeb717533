"""Encoders: the interface to a frozen model, and a deterministic stand-in."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


class Encoder(Protocol):
    """A frozen model. Instances are pickled to executors, so they load weights lazily."""

    dim: int

    def ensure(self) -> None:
        """Make weights available; raise if they cannot be had."""

    def encode_documents(self, texts: list[str] | None, images: list[Any] | None) -> np.ndarray: ...

    def encode_queries(self, texts: list[str]) -> np.ndarray: ...


class HashEncoder:
    """Buckets words by a hash, counts and normalises. A test double for a model, not a claim of quality."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def ensure(self) -> None:
        pass

    def _vector(self, text: str) -> list[float]:
        words = [w for w in text.lower().replace("\t", " ").replace("\n", " ").split(" ") if w]
        counts = Counter(int(hashlib.md5(w.encode()).hexdigest()[:6], 16) % self.dim for w in words)
        norm = math.sqrt(sum(n * n for n in counts.values()))
        return [counts[k] / norm if norm else 0.0 for k in range(self.dim)]

    def encode_documents(self, texts: list[str] | None, images: list[Any] | None) -> np.ndarray:
        if texts is None:
            texts = ["" if image == "" else hashlib.md5(image if isinstance(image, bytes) else b"".join(image)).hexdigest() for image in images or []]
        return np.array([self._vector(t) for t in texts], np.float64).reshape(len(texts), self.dim)

    def encode_queries(self, texts: list[str]) -> np.ndarray:
        return self.encode_documents(texts, None)

    def column(self, text: Column) -> Column:
        """Vectors of a text column, by Arrow batches."""

        def run(column: pa.Array) -> pa.Array:
            return pa.array([self._vector(t or "") for t in column.to_pylist()], pa.list_(pa.float64()))

        return F.arrow_udf(run, "array<double>")(text)
