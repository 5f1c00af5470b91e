"""Shared pieces: vectorised word hashing over Arrow batches, sorted groups, and checkpoints.

Texts reach Python as Arrow batches. Words are found and hashed with numpy over the
concatenated UTF-8 bytes of a slice of the batch, so no Python loop runs per word.
Every separator used here is an ASCII byte, which UTF-8 never uses inside another
character, so byte positions split exactly where code points do.

A word's hash takes its bytes eight at a time through a bijective mixer, and a window's
hash joins the hashes of runs of 1, 2, 4, ... words in the same way: neither is a sum, so
no arrangement of letters or of words cancels out. They find candidates; operators that
remove, link or report compare the words themselves or a cryptographic digest of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.operators import checkpoints
from petrel.operators.shipping import shipped

#: Bytes of text that one numpy pass takes; a longer text is a pass of its own.
PASS_BYTES = 1 << 20
#: Bytes from which a word is hashed by itself.
LONG_WORD = 256

_U = np.uint64
_WORD_SEED, _JOIN_SEED, _STEP = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xD6E8FEB86659FD93)
#: The first k of eight little-endian bytes.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the hashes of two runs of words that of the run of both; order matters."""
    return mix((a * _STEP) ^ (b + _JOIN_SEED))


def _table(separators: list[tuple[int, int]], lower: bool) -> np.ndarray:
    """Byte to byte; 0 marks a separator. Byte 0 is itself a separator or becomes 255, which UTF-8 never holds."""
    t = np.arange(256, dtype=np.uint8)
    t[0] = 255
    if lower:
        t[65:91] += 32
    for a, b in separators:
        t[a : b + 1] = 0
    return t


#: Words [^\x20\x09-\x0D]+, unchanged.
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)], lower=False)
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z.
PLAIN = _table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)], lower=True)


class Words:
    """The words of some texts: ``start``/``end`` in bytes of ``raw``, ``doc`` (row number), ``hash`` (unless not asked for)."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, table: np.ndarray, hashed: bool = True) -> None:
        self.raw, self.bounds = raw, bounds
        n = len(raw)
        self._low = np.zeros(n + 8, dtype=np.uint8)  # eight bytes may be read from any place
        self._low[:n] = table[raw]
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = self._low[:n] != 0
        # a word ends where its text ends
        flips = np.flatnonzero(inside[1:] != inside[:-1])
        inner = bounds[1:-1]
        inner = np.unique(inner[(inner > 0) & (inner < n)])
        inner = inner[inside[inner] & inside[inner + 1]]
        if len(inner):
            flips = np.sort(np.concatenate([flips, inner, inner]))
        self.start, self.end = flips[0::2], flips[1::2]
        self.hash = self._hashes() if hashed else None
        self.doc = np.searchsorted(bounds, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, bounds, side="left")  # words first[d]:first[d+1] are row d's

    def forget(self) -> None:
        """Drop what only prefixes() and joined() need: a byte for each of the text's."""
        self._low = None

    def _eight(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first ``size`` (8 at most) bytes from each place."""
        view = np.ndarray(len(self._low) - 7, dtype="<u8", buffer=self._low.data, strides=(1,))
        return view[at] & _FIRST[np.minimum(size, 8)]

    def _hashes(self) -> np.ndarray:
        size = self.end - self.start
        h = mix(self._eight(self.start, size) ^ (size.astype(np.uint64) * _WORD_SEED))
        left, k = np.flatnonzero(size > 8), 8
        while len(left) and k < LONG_WORD:
            h[left] = joined_hash(h[left], self._eight(self.start[left] + k, size[left] - k))
            k += 8
            left = left[size[left] > k]
        for i in left.tolist():
            h[i] = int.from_bytes(hashlib.blake2b(self._low[self.start[i] : self.end[i]].tobytes(), digest_size=8).digest(), "little")
        return h

    def numbered(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal where the words are, and the words by number: compared, not hashed."""
        size = self.end - self.start
        low = self._low[:-8]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(low[low != 0].tobytes())])
        coded = words.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of the first n (8 at most) bytes of each word that has more."""
        at = np.flatnonzero(self.end - self.start > n)
        return at, mix(self._eight(self.start[at], np.full(len(at), n)) ^ _U(n) ^ _JOIN_SEED)

    def windows(self, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of each window of n consecutive words of one text."""
        m = len(self.hash) - n + 1
        if m < 1:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        run, size, done, out = mix(self.hash ^ _U(salt)) if salt else self.hash, 1, 0, None
        while size <= n:
            if n & size:
                part = run[done : done + m]
                out = mix(part ^ _U(n)) if out is None else joined_hash(out, part)
                done += size
            if 2 * size <= n:
                run = joined_hash(run[:-size], run[size:])
            size *= 2
        at = np.flatnonzero(self.doc[n - 1 :] == self.doc[:m])
        return at, out[at]

    def joined(self, row: int) -> bytes:
        """A row's words, as they are compared, joined by one space."""
        data = self._low[self.bounds[row] : self.bounds[row + 1]].tobytes()
        return b" ".join([x for x in data.split(b"\0") if x])


def sliced(text: pa.Array, size: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of slices of a string array; a null is an empty text."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    wide = pa.types.is_large_string(text.type)
    text = text.fill_null("") if text.null_count else text
    if not len(text):
        return
    buffers = text.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def mapped(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function of one Arrow batch to every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if (out := f(b)) is not None:
                yield out
        pa.default_memory_pool().release_unused()  # workers are used again; the next stage needs it

    shipped(df.sparkSession)
    return df.mapInArrow(run, schema)


def by_group(df: DataFrame, key: str, f: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply a function to all rows of each value of an integer column, a run of whole groups at a time.

    Rows are dealt and sorted by the key and read as a stream: a worker holds one batch and the group that goes
    on after it, not its partition. Groups must be bounded by their maker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(key).to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))  # where the batch's last group begins
            if held and held[-1].column(key)[0].as_py() != keys[0]:
                yield from f(pa.Table.from_batches(held)).to_batches()
                held = []
            if last:
                yield from f(pa.Table.from_batches([*held, b.slice(0, last)])).to_batches()
                held = []
            held.append(b.slice(last))
        if held:
            yield from f(pa.Table.from_batches(held)).to_batches()
        pa.default_memory_pool().release_unused()

    shipped(df.sparkSession)
    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


checkpointed = checkpoints.checkpointed


def gathered(df: DataFrame) -> DataFrame:
    """Small rows of a scan dealt anew, so that as many tasks write them as their size needs, not as many as read the texts.

    Each file that an executor opens on a local file system starts a process, whose copy of the executor's memory
    counts until it runs its program.
    """
    return df.hint("rebalance")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labels_modulus(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
