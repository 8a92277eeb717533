"""Byte-level BPE encoding and decoding through a sentencepiece model.

The rank file's vocabulary is serialised directly as a sentencepiece BPE model:
every byte becomes one code point (U+2800 plus the byte), a piece's score is its
negative rank, and normalisation is the identity. Merging the best-scored
neighbours is then merging the lowest-ranked, so ids equal ranks. Texts are cut
into pre-tokens by the public pattern, each encoded on its own; decoding maps
ids to bytes by the inverse table.

A pre-token never reaches across a single space between two characters that are
not white space, so the text is first cut there and the ids of short segments
are remembered in each worker (at most ``REMEMBERED``; then it starts anew).

Defined cases: a null or empty text gives no ids and decodes to no bytes.
Repeated rows give repeated results. Columns other than the two named are
ignored.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import small_batches

BASE = 0x2800
REMEMBERED, SHORT = 1_000_000, 32
#: White space other than space and line feed, as the pattern or Python sees it: in ASCII, and beyond.
_RARE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_WIDE = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
#: A space between two characters that are no white space.
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")


def segments(text: str) -> list[str]:
    """Parts between single spaces that stand between characters other than white space."""
    plain = not ("\n " in text or " \n" in text or any(c in text for c in _RARE) or not text.isascii() and any(c in text for c in _WIDE))
    parts = text.split(" ") if plain else _CUT.split(text)
    return _CUT.split(text) if plain and "" in parts else parts


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    return [ranks[k] for k in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


_MAP = {b: chr(BASE + b) for b in range(256)}


def _mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_MAP)


def model_proto(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece ModelProto: BPE, the tokens in rank order, then the unknown piece."""
    pieces = [_field(1, _field(1, _mapped(t).encode()) + _field(2, -float(k)) + _field(3, 1)) for k, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens)) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


_one = struct.Struct("<i").pack


class Codec:
    """Encodes texts to little-endian int32 ids and ids to bytes."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self.ranks = {t: k for k, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.tokens))
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def _tokens(self, tokens: list[str]) -> dict[str, bytes]:
        """Packed ids of pre-tokens; merges run in one sentencepiece call."""
        coded = {t: t.encode() for t in tokens}
        wanted = [t for t, b in coded.items() if b not in self.ranks]
        made = self.model.encode([_mapped(coded[t]) for t in wanted], num_threads=1) if wanted else []
        return {t: _one(self.ranks[b]) for t, b in coded.items() if b in self.ranks} | {t: struct.pack(f"<{len(ids)}i", *ids) for t, ids in zip(wanted, made)}

    def _new(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of segments not met before, each with the space before it.

        Full stops or commas behind letters only are a pre-token of their own.
        """
        cores = {p: c for p in parts if (c := p.rstrip(".,")).isalpha()}
        found = {p: self.find(" " + p) for p in parts if p not in cores}
        wanted = [" " + c for c in cores.values() if c not in self.later]
        wanted += [p[len(c) :] for p, c in cores.items() if p != c]
        ids = self._tokens(list(dict.fromkeys([*wanted, *(t for own in found.values() for t in own)])))
        made = {p: b"".join(map(ids.__getitem__, own)) for p, own in found.items()}
        for p, c in cores.items():
            made[c] = self.later[c] if c in self.later else ids[" " + c]
            if p != c:
                made[p] = made[c] + ids[p[len(c) :]]
        return made

    def encode(self, text: str | None) -> bytes:
        head, *parts = segments(text or "")
        if head not in self.first:
            if len(self.first) > REMEMBERED // 10:
                self.first.clear()
            own = self.find(head)
            ids = self._tokens(list(dict.fromkeys(own)))
            begun = b"".join(map(ids.__getitem__, own))
            if len(head) <= SHORT:
                self.first[head] = begun
        else:
            begun = self.first[head]
        found = list(map(self.later.get, parts))
        if None in found:
            made = self._new(list(dict.fromkeys(p for p, b in zip(parts, found) if b is None)))
            found = [made[p] if b is None else b for p, b in zip(parts, found)]
            if len(self.later) + len(made) > REMEMBERED:
                self.later.clear()
            self.later.update((p, b) for p, b in made.items() if len(p) <= SHORT)
        return begun + b"".join(found)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of every text."""
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            packed = [own.encode(t.as_py()) for t in batch.column(1)]
            ends = [0]
            for p in packed:
                ends.append(ends[-1] + len(p) // 4)
            values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(packed))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["doc_id", "ids"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The rows of ``encode`` with the decoded bytes as ``decoded`` (binary)."""
    path = vocabulary or default_vocabulary()

    @F.arrow_udf("binary")
    def run(ids: pa.Array) -> pa.Array:
        own, values, ends = codec(path), ids.flatten().to_numpy(zero_copy_only=False).tolist(), ids.offsets.to_pylist()
        first = ends[0]
        return pa.array([own.decode(values[a - first : b - first]) for a, b in zip(ends, ends[1:])], pa.binary())

    return encoded.withColumn("decoded", run("ids"))


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    encoded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return decode(encoded).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
