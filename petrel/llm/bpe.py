"""Operator 8: byte-level BPE encoding and decoding as a tree reduction.

A text's encoding is an element of a monoid: ``join(encode(a), encode(b)) == encode(a + b)``.
A text longer than a leaf is halved recursively, each half is encoded by itself, and
neighbours are joined by re-encoding a window around the boundary. Both ends of the window
grow, from cut to cut, until both halves have a token boundary there. A cut is a place
between an ASCII letter or digit and a space. No alternative of the pattern goes on from
the one to the other, and none looks past a letter or digit further than at the next
character, so a match ends at a cut in every scan, of a half, of the window or of the
whole. Tokens outside the window are final. All ids come from the library's own encoder;
no other engine's character tables take part. Where a half has no cut its end is the
window's. Decoding concatenates the bytes of both halves up the same tree.

The pattern is a parameter; it must have the property above, as those of this family do.

Nulls are empty texts; an empty text has no ids, and its digests are those of empty
input. Repeated rows and ids give repeated results; no row is dropped.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from petrel.llm.common import mapped, table

#: Code points (in decoding: ids) of a leaf.
LEAF = 128
_SOLID = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")


class Codec:
    """A rank file, loaded once per process."""

    _loaded: dict[tuple[str, str], Codec] = {}

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = [0] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
        self.text = [str(i) for i in range(len(self.width))]

    @classmethod
    def get(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._loaded:
            cls._loaded[path, pattern] = cls(path, pattern)
        return cls._loaded[path, pattern]

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        return self._tree(text, 0, len(text), max(leaf, 1))

    def _tree(self, text: str, lo: int, hi: int, leaf: int) -> list[int]:
        if hi - lo <= leaf:
            return self.encoding.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self._tree(text, lo, mid, leaf), self._tree(text, mid, hi, leaf))

    def join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of text[lo:hi] from those of text[lo:mid] and of text[mid:hi]."""
        if not left or not right or (text[mid] == " " and text[mid - 1] in _SOLID):
            return left + right
        x, y = mid, mid
        i = j = None
        while i is None:
            x = self._cut_before(text, lo, x)
            i = self._from_end(left, len(text[x:mid].encode()))
        while j is None:
            y = self._cut_after(text, y + 1, hi)
            j = self._from_start(right, len(text[mid:y].encode()))
        return left[:i] + self.encoding.encode_ordinary(text[x:y]) + right[j:]

    @staticmethod
    def _cut_before(text: str, lo: int, at: int) -> int:
        """The last cut in text[lo:at], or lo."""
        p = text.rfind(" ", lo + 1, at)
        while p > lo and text[p - 1] not in _SOLID:
            p = text.rfind(" ", lo + 1, p)
        return max(p, lo)

    @staticmethod
    def _cut_after(text: str, at: int, hi: int) -> int:
        """The first cut in text[at:hi], or hi."""
        p = text.find(" ", at, hi)
        while p >= 0 and text[p - 1] not in _SOLID:
            p = text.find(" ", p + 1, hi)
        return p if p >= 0 else hi

    def _from_end(self, ids: list[int], n: int) -> int | None:
        """How many ids come before the last n bytes, or None if a token spans their start."""
        k, width = len(ids), self.width
        while n > 0:
            k -= 1
            n -= width[ids[k]]
        return None if n else k

    def _from_start(self, ids: list[int], n: int) -> int | None:
        k, width = 0, self.width
        while n > 0:
            n -= width[ids[k]]
            k += 1
        return None if n else k

    def decode(self, ids: list[int], leaf: int = LEAF) -> bytes:
        if len(ids) <= max(leaf, 1):
            return self.encoding.decode_bytes(ids)
        half = len(ids) // 2
        return self.decode(ids[:half], leaf) + self.decode(ids[half:], leaf)


def encode_texts(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """``keep`` columns, n_tokens and ids array<int> of each whole text; one row for each input row."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        codec = Codec.get(path, pattern)
        # numbers, not Python lists of them, wait for the batch's end
        ids = [np.array(codec.encode(x.as_py() or "", leaf), dtype=np.int32) for x in b.column(len(keep))]
        size = np.array([len(x) for x in ids], dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(size), lists], [*keep, "n_tokens", "ids"])

    src = docs.select(*keep, docs[text_col].cast("string").alias("text__"))
    kinds = dict(src.dtypes)
    return mapped(src, run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", n_tokens long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids", leaf: int = LEAF) -> DataFrame:
    """(id, bytes binary) of each id sequence; null ids decode to no bytes."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        codec = Codec.get(path, pattern)
        out = [codec.decode([i for i in x if i is not None] if x else [], leaf) for x in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], [id_col, "bytes"])

    src = encoded.select(id_col, ids_col)
    return mapped(src, run, f"{id_col} {dict(src.dtypes)[id_col]}, bytes binary")


def encode_digests(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """Encode and decode in one pass over a batch; only counts and digests leave it.

    Returns ``keep`` columns, n_tokens, ids_sha256 and decoded_sha256.
    """

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        codec = Codec.get(path, pattern)
        n, ids_hex, out_hex = [], [], []
        for x in b.column(len(keep)):
            ids = codec.encode(x.as_py() or "", leaf)
            text = codec.text
            n.append(len(ids))
            ids_hex.append(hashlib.sha256(",".join([text[i] for i in ids]).encode()).hexdigest())
            out_hex.append(hashlib.sha256(codec.decode(ids, leaf)).hexdigest())
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(out_hex, pa.string())], [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select(*keep, docs[text_col].cast("string").alias("text__"))
    kinds = dict(src.dtypes)
    return mapped(src, run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary() -> tuple[str, str]:
    """(rank file, pattern) of the production queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), *vocabulary())
