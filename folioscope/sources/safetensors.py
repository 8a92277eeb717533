"""Reading and writing one matrix in the public safetensors layout.

A file is an 8-byte little-endian header length, a JSON header with each tensor's
dtype, shape and byte range, and the data. Rows are read in slices on executors.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

KEY = "image_text_embeddings"
_SIZES = {"F32": 4, "F16": 2, "BF16": 2, "F64": 8}


def header(path: str) -> tuple[dict, int]:
    """The JSON header and where the data begins."""
    with open(path, "rb") as file:
        (n,) = struct.unpack("<Q", file.read(8))
        return json.loads(file.read(n)), 8 + n


def _floats(data: bytes, kind: str) -> np.ndarray:
    if kind == "BF16":
        return (np.frombuffer(data, "<u2").astype(np.uint32) << 16).view(np.float32)
    return np.frombuffer(data, {"F32": "<f4", "F16": "<f2", "F64": "<f8"}[kind]).astype(np.float32)


def bfloat16(values: np.ndarray) -> np.ndarray:
    """float32 rounded to bfloat16, halves to even, as its 16 bits."""
    bits = values.astype("<f4").view(np.uint32)
    rounded = ((bits + 0x7FFF + (bits >> 16 & 1)) >> 16).astype(np.uint16)
    return np.where(np.isnan(values), np.uint16(0x7FC0), rounded)


def read_matrix(spark: SparkSession, path: str, key: str = KEY, slice_rows: int = 4096) -> DataFrame:
    """(row_idx, embedding) of one tensor; a missing key is a KeyError that names those present."""
    about, base = header(path)
    if key not in about:
        raise KeyError(f"{path} has no tensor {key!r}, only {sorted(k for k in about if k != '__metadata__')}")
    kind, (rows, dim), (begin, _) = about[key]["dtype"], about[key]["shape"], about[key]["data_offsets"]
    width = _SIZES[kind] * dim
    slices = spark.range(0, rows, slice_rows, max(1, -(-rows // slice_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, "rb") as file:
            for batch in batches:
                for first in batch.column(0).to_pylist():
                    n = min(slice_rows, rows - first)
                    file.seek(base + begin + first * width)
                    values = _floats(file.read(n * width), kind)
                    ends = pa.array(np.arange(0, n * dim + 1, dim), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + n), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(values))], ["row_idx", "embedding"])

    return slices.mapInArrow(run, "row_idx long, embedding array<float>")


def write_matrix(index: DataFrame, path: str, key: str = KEY, bf16: bool = True) -> None:
    """Write (row_idx, embedding) in row order, streamed partition by partition, then renamed into place."""
    rows, dim = index.count(), len(index.orderBy("row_idx").select("embedding").first()[0])
    size = (2 if bf16 else 4) * rows * dim
    head = json.dumps({key: {"dtype": "BF16" if bf16 else "F32", "shape": [rows, dim], "data_offsets": [0, size]}}).encode()
    head += b" " * (-len(head) % 8)
    with open(path + ".tmp", "wb") as file:
        file.write(struct.pack("<Q", len(head)) + head)
        for row in index.orderBy("row_idx").select("embedding").toLocalIterator():
            values = np.asarray(row[0], np.float32)
            file.write((bfloat16(values) if bf16 else values.astype("<f4")).tobytes())
    os.replace(path + ".tmp", path)
