"""Packing token sequences by non-negative least squares.

Documents are tokenised once. A document is cut at every multiple of the window
(full pieces), then its remainder is cut into a body, the largest multiple of
``GRID`` tokens, and a tail shorter than that. Bodies therefore have few distinct
lengths, and so have tails. The histogram of piece lengths (at most
window / GRID + GRID counts, whatever the corpus size) goes to the driver, which

1. enumerates the shallow combinations of two to ``DEPTH`` body lengths that fill
   a window exactly,
2. solves for non-negative repeat counts that reproduce the histogram in the
   least-squares sense and rounds them down,
3. packs what remains greedily, longest first, a combination at a time, each
   repeated as often as the remaining counts allow.

The result is a plan of a few thousand rows at most. A piece finds its place in
it by its rank among the pieces of its length, which is the number of such pieces
in earlier partitions plus its number in its own: no group is ever sorted or
gathered, even if one length holds a third of all pieces.

Defined cases: a null or empty text is one end token. Repeated rows are packed
once each. An empty table gives an empty result. Columns other than the two named
are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .durable import save, small_batches

WINDOW, GRID, DEPTH, END = 4096, 64, 5, 2
REMEMBERED, SHORT = 700_000, 32
#: Texts with these are tokenised whole: white space does not bound words there, or case depends on what follows.
_WHOLE = ("\x1c", "\x1d", "\x1e", "\x1f", "<|", "\u03a3")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of a text, as packed unsigned 32-bit; words are remembered, since white space separates them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only: each ends with its first word-end token, so they share a call."""
        ids = np.array(self.model.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words):
            return self._ids(words)
        packed, cuts = ids.tobytes(), [0, *(4 * (last + 1)).tolist()]
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words not met before; full stops and commas behind letters are tokens of their own."""
        cores = {w: w.rstrip(".,") for w in words}
        letters = [c for c in dict.fromkeys(cores.values()) if c.isalpha() and c not in self.known]
        made = {w: b for k in range(0, len(letters), 200) for w, b in zip(letters[k : k + 200], self._letters(letters[k : k + 200]))}
        others = [w for w, c in cores.items() if not c.isalpha()]
        others += [t for t in {w[len(c) :] for w, c in cores.items() if c.isalpha()} if t and t not in self.known]
        made.update(zip(others, self._ids(others)))
        for w, c in cores.items():
            if w not in made:
                made[w] = b"".join(made[x] if x in made else self.known[x] for x in (c, w[len(c) :]) if x)
        return made

    def encode(self, text: str) -> bytes:
        low = text.lower()
        if any(s in text for s in _WHOLE) or not (text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", low)):
            return self._ids([text])[0]
        words = low.split()
        found = list(map(self.known.get, words))
        if None in found:
            made = self._new(list(dict.fromkeys(w for w, b in zip(words, found) if b is None)))
            found = [made[w] if b is None else b for w, b in zip(words, found)]
            if len(self.known) + len(made) > REMEMBERED:
                self.known = dict(islice(self.known.items(), REMEMBERED // 2))  # frequent words come early
            self.known.update((w, b) for w, b in made.items() if len(w) <= SHORT)
        return b"".join(found)


_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def cuts(n: int, window: int = WINDOW, grid: int = GRID) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    full, rest = divmod(n, window)
    pieces = [(k * window, window) for k in range(full)]
    if body := rest // grid * grid:
        pieces.append((full * window, body))
    if rest % grid:
        pieces.append((full * window + body, rest % grid))
    return pieces


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece, with its partition and its rank there among the pieces of its length."""
    small_batches(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "local_rank", *["ids"] * with_ids]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen = _tokenizer(path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, of = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                packed = own.encode(text) + END.to_bytes(4, "little")
                n = len(packed) // 4
                for start, length in cuts(n, window):
                    piece = packed[4 * start : 4 * (start + length)]
                    rows.append((start, length, zlib.crc32(piece), n, part, seen[length], *[piece] * with_ids))
                    seen[length] += 1
                    of.append(k)
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int32())), *columns], names)

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part int, local_rank long" + ", ids binary" * with_ids)


def combinations(units: int, depth: int = DEPTH) -> np.ndarray:
    """Columns of counts per body length (1 to units - 1): all sums of 2 to ``depth`` lengths that are ``units``."""
    found: list[list[int]] = []

    def extend(own: list[int], rest: int) -> None:
        if not rest:
            if len(own) > 1:
                found.append(own)
            return
        if len(own) < depth:
            for x in range(own[-1] if own else 1, rest + 1):
                if x == rest or x * 2 <= rest:
                    extend([*own, x], rest - x)

    extend([], units)
    columns = np.zeros((units - 1, len(found)))
    for k, own in enumerate(found):
        for x in own:
            if x < units:
                columns[x - 1, k] += 1
    return columns


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lawson and Hanson's active-set solution of min |ax - b| over x >= 0.

    Each round frees the variable that helps most and lessens the residual, so no set of
    free variables comes back; it ends when none helps, or when rounding lets none.
    """
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    residual = np.inf
    while True:
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        before, residual = residual, float(np.linalg.norm(b - a @ x))
        if residual >= before:
            break
        k = int(np.argmax(gradient)) if len(gradient) else 0
        if not len(gradient) or gradient[k] <= tolerance:
            break
        active[k] = True
        while True:
            at = np.flatnonzero(active)
            trial = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (trial > 0).all():
                x[:] = 0
                x[at] = trial
                break
            falling = trial <= 0
            step = np.min(x[at][falling] / np.maximum(x[at][falling] - trial[falling], 1e-300))
            x[at] += step * (trial - x[at])
            active[at[(x[at] <= 1e-12) & falling]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


def plan(counts: dict[int, int], window: int = WINDOW, grid: int = GRID, depth: int = DEPTH) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from_rank, to_rank, per_sequence, first_sequence, first_offset) placing every piece."""
    rest = {k: n for k, n in sorted(counts.items()) if n > 0}
    used: Counter = Counter()
    rows: list[tuple[int, int, int, int, int, int]] = []
    sequence = 0

    def place(lengths: dict[int, int], repeats: int) -> None:
        nonlocal sequence
        offset = 0
        for length in sorted(lengths, reverse=True):
            per = lengths[length]
            rows.append((length, used[length], used[length] + per * repeats, per, sequence, offset))
            used[length] += per * repeats
            rest[length] -= per * repeats
            if not rest[length]:
                del rest[length]
            offset += per * length
        sequence += repeats

    if window in rest:
        place({window: 1}, rest[window])
    units = window // grid
    columns = combinations(units, depth)
    histogram = np.array([rest.get(grid * k, 0) for k in range(1, units)], float)
    able = [k for k in range(columns.shape[1]) if (histogram[columns[:, k] > 0] > 0).all()]
    if able:
        repeats = np.floor(nnls(columns[:, able], histogram) + 1e-9).astype(int)
        for k, n in zip(able, repeats):
            own = {int(grid * (x + 1)): int(columns[x, k]) for x in np.flatnonzero(columns[:, k])}
            n = min([int(n), *(rest.get(x, 0) // c for x, c in own.items())])
            if n > 0:
                place(own, n)
    while rest:
        room, own = window, Counter()
        for length in sorted(rest, reverse=True):
            if take := min(room // length, rest[length]):
                own[length] = take
                room -= take * length
        place(dict(own), min(rest[x] // c for x, c in own.items()))
    return rows


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Saved pieces with sequence_id and offset."""
    spark = cut.sparkSession
    per_part = save(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most window / GRID + GRID rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    places = spark.createDataFrame(plan(totals, window), "length long, from_rank long, to_rank long, per long, first_sequence long, first_offset long")
    ranked = cut.join(offsets, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    # The plan has a row for each length of each combination in use: bounded by the grid, so it is broadcast.
    placed = ranked.join(F.broadcast(places), (ranked["length"] == places["length"]) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))).drop(places["length"])
    nth = F.col("rank") - F.col("from_rank")
    return placed.select(
        *[c for c in cut.columns if c not in ("part", "local_rank")],
        (F.col("first_sequence") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + (nth % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, **options) -> DataFrame:
    """Tokenise, cut and pack; ``with_ids`` adds each piece's packed ids."""
    return pack(save(pieces(docs, id_col, text_col, with_ids=with_ids, **options), "pieces"), options.get("window", WINDOW))


def sequences(packed: DataFrame, pad: int = 0, window: int = WINDOW) -> DataFrame:
    """sequence_id and tokens (binary, unsigned 32-bit) of pieces that carry ids; padded to the window, but for a power of two.

    A sequence holds at most ``window`` ids, so its group is bounded.
    """

    def join(group):
        import pandas as pd

        group = group.sort_values("offset")
        joined = b"".join(group["ids"])
        n = len(joined) // 4
        if n & (n - 1):
            joined += pad.to_bytes(4, "little") * (window - n)
        return pd.DataFrame({"sequence_id": group["sequence_id"].iloc[:1], "tokens": [joined]})

    return packed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, tokens binary")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
