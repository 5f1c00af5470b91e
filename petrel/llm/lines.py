"""Operator 11: line deduplication over a sharded minimal perfect hash.

A line's key is the line without blanks at its ends and with A-Z in lower case. A key of
enough code points that two documents hold loses its lines everywhere but in the document
of smallest id. Keys are told apart by 96 bits of their SHA-256.

Rows are dealt into groups of some megabytes of text by their place in the table, so copies
spread. A group sends each distinct key once, with its smallest id, to the key's shard. A
shard's keys get a minimal perfect hash (levels of bits; a key is placed at the first level
where it falls on a bit alone), which indexes flat arrays: a fingerprint and a count a key,
and the smallest id of a key that is counted twice. A group then probes the arrays of each
shard with its keys and hears which are repeated and by whom they are kept; lines themselves
are never joined, and a line that a third of all documents hold is one entry a group.

A null or empty text is one empty line. A row of null id is returned unchanged and shortens
no other. Rows that share an id are one document: they never shorten each other. Very long
texts are groups of their own. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm.common import mix, partitions, sliced, table
from petrel.operators.shipping import shipped

#: Code points from which a key counts.
LEAST = 10
#: Bytes of text in a group, if there are more than a partition each, and groups for each shard.
GROUP_BYTES, PER_SHARD = 8 << 20, 4
#: Bits for each key that a level of the perfect hash has to place.
ROOM = 1.7

_U = np.uint64
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class PerfectHash:
    """n distinct keys of 96 bits to the numbers 0 to n - 1. A key that was not among them gets any number, or -1."""

    def __init__(self, sizes: list[int], bits: bytes) -> None:
        self.sizes, self.bits = sizes, bits
        self._levels, base = [], 0
        packed = np.frombuffer(bits, dtype=np.uint8)
        for m in sizes:
            level, packed = np.unpackbits(packed[: m // 8], bitorder="little").view(bool), packed[m // 8 :]
            number = np.cumsum(level, dtype=np.int64) + (base - 1)
            base += int(level.sum())
            self._levels.append((level, number))

    @staticmethod
    def _place(h: np.ndarray, h2: np.ndarray, level: int, m: int) -> np.ndarray:
        return (mix(h ^ mix(h2.astype(np.uint64) + (_U(level) << _U(32)))) % _U(m)).astype(np.int64)

    @classmethod
    def of(cls, h: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], np.arange(len(h))
        while len(left):
            m = 64 * (int(ROOM * len(left)) // 64 + 1)
            at = cls._place(h[left], h2[left], len(sizes), m)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            bits.append(np.packbits(alone, bitorder="little").tobytes())
            left = left[~alone[at]]
        return cls(sizes, b"".join(bits))

    def numbers(self, h: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out, left = np.full(len(h), -1, dtype=np.int64), np.arange(len(h))
        for k, (level, number) in enumerate(self._levels):
            at = self._place(h[left], h2[left], k, len(level))
            hit = level[at]
            out[left[hit]] = number[at[hit]]
            left = left[~hit]
        return out


def _fingerprint(h: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (mix(h + mix(h2.astype(np.uint64))) >> _U(32)).astype(np.uint32)


class Group:
    """The lines of a group's rows, and its distinct keys in order of shard and key: contents alone decide their numbers."""

    def __init__(self, rows: pa.Table, shards: int, least: int) -> None:
        ids = rows.column("id").combine_chunks()
        self.id, self.live = np.asarray(ids.fill_null(0)), ~np.asarray(ids.is_null())
        self.parts: list[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]] = []  # first row, bytes, line starts and ends, first line of a row
        row, keyed, digest, n = [], [], [], 0
        for i, j, raw, bounds in sliced(rows.column("text")):
            breaks = np.flatnonzero(raw == 10)
            start, end = np.sort(np.concatenate([bounds[:-1], breaks + 1])), np.sort(np.concatenate([breaks, bounds[1:]]))
            size = 1 + np.diff(np.searchsorted(breaks, bounds))
            of = np.repeat(np.arange(i, j), size)
            solid = np.flatnonzero(~_BLANK[raw])
            a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            full = np.flatnonzero((b > a) & self.live[of])
            first, last = solid[a[full]], solid[b[full] - 1] + 1
            enough = points[last] - points[first] >= least
            low, sha = _LOWER[raw].tobytes(), hashlib.sha256
            digest += [sha(low[x:y]).digest()[:12] for x, y in zip(first[enough].tolist(), last[enough].tolist())]
            keyed.append(full[enough] + n)
            row.append(of)
            self.parts.append((i, raw.tobytes(), start, end, np.concatenate([[0], np.cumsum(size)])))
            n += len(start)
        self.row = np.concatenate(row) if row else np.zeros(0, np.int64)
        self.keyed = np.concatenate(keyed) if keyed else np.zeros(0, np.int64)
        both = np.frombuffer(b"".join(digest), dtype=[("h", ">u8"), ("h2", ">u4")])
        h, h2 = both["h"].astype(np.uint64), both["h2"].astype(np.uint32)
        shard, doc = (h % _U(shards)).astype(np.int64), self.id[self.row[self.keyed]]
        order = np.lexsort((doc, h2, h, shard))
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        starts = np.flatnonzero(new)
        self.number = np.empty(len(h), dtype=np.int64)  # the distinct key of each keyed line
        self.number[order] = np.cumsum(new) - 1
        at, to = order[starts], order[np.append(starts[1:], len(h))[: len(starts)] - 1]
        self.h, self.h2, self.least, self.many = h[at], h2[at], doc[at], doc[at] != doc[to]
        self.cuts = np.searchsorted(shard[at], np.arange(shards + 1))


_SENT = pa.schema([("shard", pa.int32()), ("grp", pa.int32()), ("first", pa.int32()), ("n", pa.int32()), ("h", pa.binary()), ("h2", pa.binary()), ("least", pa.binary()), ("many", pa.binary())])
_INDEX = pa.schema([("shard", pa.int32()), ("n", pa.int32()), ("sizes", pa.list_(pa.int32())), ("bits", pa.binary()), ("fingerprint", pa.binary()), ("count", pa.binary()), ("keeper", pa.binary())])
_ANSWER = pa.schema([("grp", pa.int32()), ("n", pa.int32()), ("number", pa.binary()), ("keeper", pa.binary())])


def _sender(shards: int, least: int):
    def send(key: tuple, rows: pa.Table) -> pa.Table:
        g = Group(rows, shards, least)
        out = []
        for s in np.flatnonzero(np.diff(g.cuts)).tolist():
            i, j = int(g.cuts[s]), int(g.cuts[s + 1])
            out.append({"shard": s, "grp": key[0].as_py(), "first": i, "n": j - i, "h": g.h[i:j].tobytes(), "h2": g.h2[i:j].tobytes(), "least": g.least[i:j].astype("<i8").tobytes(), "many": np.packbits(g.many[i:j]).tobytes()})
        return pa.Table.from_pylist(out, _SENT)

    return send


def _joined(rows: list[dict], name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), dtype=kind)


def _build(key: tuple, sent: pa.Table) -> pa.Table:
    """The arrays of a shard: by a key's number its fingerprint and count (2: two documents or more), and of the latter the keepers."""
    rows = sent.to_pylist()
    h, h2, least = _joined(rows, "h", "<u8"), _joined(rows, "h2", "<u4"), _joined(rows, "least", "<i8")
    many = np.concatenate([np.unpackbits(np.frombuffer(r["many"], np.uint8), count=r["n"]) for r in rows])
    order = np.lexsort((least, h2, h))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    starts = np.flatnonzero(new)
    first, last = order[starts], order[np.append(starts[1:], len(h)) - 1]
    twice = (least[first] != least[last]) | (np.maximum.reduceat(many[order], starts) > 0)
    hashed = PerfectHash.of(h[first], h2[first])
    at = hashed.numbers(h[first], h2[first])
    fingerprint, count, keeper = np.empty(len(first), np.uint32), np.empty(len(first), np.uint8), np.empty(len(first), np.int64)
    fingerprint[at], count[at], keeper[at] = _fingerprint(h[first], h2[first]), 1 + twice, least[first]
    return pa.Table.from_pylist([{"shard": key[0].as_py(), "n": len(first), "sizes": hashed.sizes, "bits": hashed.bits, "fingerprint": fingerprint.tobytes(), "count": count.tobytes(), "keeper": keeper[count > 1].tobytes()}], _INDEX)


def _probe(key: tuple, sent: pa.Table, index: pa.Table) -> pa.Table:
    """To each group, the numbers of its keys in this shard that are counted twice, with the id that keeps them."""
    out = []
    for x in index.to_pylist():
        hashed = PerfectHash(x["sizes"], x["bits"])
        fingerprint, count, keeper = np.frombuffer(x["fingerprint"], np.uint32), np.frombuffer(x["count"], np.uint8), np.frombuffer(x["keeper"], np.int64)
        kept = np.cumsum(count > 1) - 1
        for r in sent.to_pylist():
            h, h2 = np.frombuffer(r["h"], "<u8"), np.frombuffer(r["h2"], "<u4")
            at = hashed.numbers(h, h2)
            here = np.flatnonzero((at >= 0) & (fingerprint[at] == _fingerprint(h, h2)) & (count[at] > 1))
            if len(here):
                out.append({"grp": r["grp"], "n": len(here), "number": (here + r["first"]).astype("<u4").tobytes(), "keeper": keeper[kept[at[here]]].tobytes()})
    return pa.Table.from_pylist(out, _ANSWER)


def _finisher(shards: int, least: int, digest: bool):
    def finish(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        g = Group(rows, shards, least)
        keeper = np.full(len(g.h), np.iinfo(np.int64).max)
        heard = answers.to_pylist()
        keeper[_joined(heard, "number", "<u4")] = _joined(heard, "keeper", "<i8")
        gone = np.zeros(len(g.row), dtype=bool)
        gone[g.keyed] = keeper[g.number] < g.id[g.row[g.keyed]]
        n_lines, n_dropped, kept, n = [], [], [], 0
        for _, data, start, end, first in g.parts:
            start, end = start.tolist(), end.tolist()
            for x, y in zip(first[:-1].tolist(), first[1:].tolist()):
                lost = int(gone[n + x : n + y].sum())
                text = b"\n".join([data[start[k] : end[k]] for k in range(x, y) if not gone[n + k]]) if lost else data[start[x] : end[y - 1]]
                n_lines.append(y - x)
                n_dropped.append(lost)
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
            n += len(start)
        return pa.table({"id": rows.column("id"), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64()), "kept": pa.array(kept, pa.string())})

    return finish


class _Dealt:
    """The rows of a table in groups, and what the groups send to the shards."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, least: int) -> None:
        spark = docs.sparkSession
        shipped(spark)
        size = docs.agg(F.sum(F.octet_length(docs[text_col].cast("string")))).first()[0] or 0
        groups = max(partitions(spark), size // GROUP_BYTES + 1)
        self.shards = groups // PER_SHARD + 1
        key = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int").alias("grp")
        self.rows = docs.select(key, docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
        self.sent = self.rows.groupBy("grp").applyInArrow(_sender(self.shards, least), "shard int, grp int, first int, n int, h binary, h2 binary, least binary, many binary")

    def index(self) -> DataFrame:
        return self.sent.groupBy("shard").applyInArrow(_build, "shard int, n int, sizes array<int>, bits binary, fingerprint binary, count binary, keeper binary")


def line_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """A row for each shard: (shard, n, sizes, bits, fingerprint, count, keeper), the perfect hash and its arrays."""
    return _Dealt(docs, id_col, text_col, least).index()


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, digest: bool = False) -> DataFrame:
    """(id, n_lines, n_dropped, kept): kept holds the lines that stay, joined by line feeds, or its SHA-256."""
    if least < 1:
        raise ValueError("a key has one code point or more")
    dealt = _Dealt(docs, id_col, text_col, least)
    answers = dealt.sent.groupBy("shard").cogroup(dealt.index().groupBy("shard")).applyInArrow(_probe, "grp int, n int, number binary, keeper binary")
    done = dealt.rows.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(_finisher(dealt.shards, least, digest), "id long, n_lines long, n_dropped long, kept string")
    return done.withColumnRenamed("id", id_col)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")
