"""Operator 6: n-gram Jaccard join by a MinHash LSH forest with exact verification.

Rows of equal word sequences become one node; copies are never paired. A node's signature
has TREES paths of DEPTH MinHash values, its leaves in TREES prefix tries. The target
recall gives the shortest prefix that may be needed: at LEAST values a pair at the
threshold misses all trees with less than one less the recall. Nodes that share such a
prefix form a subtree, which is read as a sorted array of paths. In it candidates are
looked for at full depth first; the matched prefix is then shortened by a value at a time,
and a node goes on only where a shorter prefix brings it mates that it is not united with.
So close copies meet deep, and only nodes whose mates are further away pay for short
prefixes; ``depth`` is the longest prefix by which a node found a mate.

Mates whose whole signatures (a byte a value) rule out the threshold are no candidates;
the rest form families. Families get their words back, and every pair inside is verified
exactly: words and shingles are numbered by comparing them, and sets of numbers are
intersected by population counts over bit sets. A subtree or family beyond a block is
split, and each pair of blocks is a piece of work of its own, so no task holds an
unbounded group and no link is lost; what leaves a piece is counts by node and one
spanning edge a node, not pairs.

Words are lower-cased (A-Z) runs of ASCII letters, digits and other characters from 0x80.
A text of fewer words than a shingle has one shingle, its whole sequence, and so is linked
to equal sequences only; a text without words is linked to none. Null texts are empty.
Rows of null id are never linked. Rows that share an id are rows like others. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm.common import PLAIN, Words, by_group, checkpointed, mapped, mix, sliced, table
from petrel.operators.components import components

SHINGLE, SIMILARITY = 5, 0.8
TREES, DEPTH, RECALL = 24, 10, 0.99999
#: Standard deviations below the threshold at which a signature's estimate rules a pair out.
DEVIATIONS = 5.5
#: Nodes of a block, and words of one.
BLOCK, BLOCK_WORDS = 512, 1 << 19
#: Rows up to which the wanted ids are broadcast (some ten megabytes); beyond, the join shuffles.
BROADCAST_ROWS = 500_000

_FACTORS = mix(np.arange(1, 1 + TREES * DEPTH, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def least_depth(similarity: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with the target recall."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(words: Words, rows: int, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingles of row d are hashes[bounds[d]:bounds[d + 1]]; none of shorter texts."""
    at, h = words.windows(n)
    doc = words.doc[at]
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16) if rows < 1 << 16 else doc[order], kind="stable")]
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[new], h[new]
    return h, np.searchsorted(doc, np.arange(rows + 1))


def _digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def _id(docs: DataFrame, id_col: str) -> tuple[Column, str]:
    """The id column and its type; whole numbers become longs, other types (strings, digests) stay."""
    kind = dict(docs.dtypes)[id_col]
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    return (docs[id_col].cast("long") if whole else docs[id_col]).alias("id"), "long" if whole else kind


def signatures(docs: DataFrame, id_col: str, text_col: str, least: int, n: int = SHINGLE) -> DataFrame:
    """(id, digest, words, small, prefixes): of the word sequence; its length; a byte a MinHash value; each tree's least prefix as one number."""
    names = ["id", "digest", "words", "small", "prefixes"]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        digest, count, small, prefixes = [], [np.zeros(0, np.int64)], [np.zeros((0, len(_FACTORS)), np.uint8)], [np.zeros((0, TREES), np.int64)]
        for i, j, raw, bounds in sliced(b.column(1)):
            words = Words(raw, bounds, PLAIN)
            digest += [_digest(words.joined(d)) for d in range(j - i)]
            count.append(np.diff(words.first))
            h, cuts = shingle_sets(words, j - i, n)
            some = np.flatnonzero(np.diff(cuts))
            sig = np.zeros((j - i, len(_FACTORS)), dtype=np.uint64)
            if len(some):
                for k, f in enumerate(_FACTORS):
                    sig[some, k] = np.minimum.reduceat(h * f, cuts[some])
            sig = mix(sig)  # the least products are small numbers; the mixed ones are even
            small.append((sig & np.uint64(255)).astype(np.uint8))
            tree = sig.reshape(j - i, TREES, DEPTH)
            key = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), (j - i, TREES)).copy()
            for k in range(least):
                key = mix(key ^ tree[:, :, k])
            prefixes.append(key.view(np.int64))
        bytes_, keys = np.concatenate(small), np.concatenate(prefixes)
        rows = len(keys)
        flat = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((np.arange(rows + 1) * bytes_.shape[1]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(bytes_))])
        lists = pa.ListArray.from_arrays(pa.array((np.arange(rows + 1) * TREES).astype(np.int32)), pa.array(keys.ravel()))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(digest, pa.binary()), pa.array(np.concatenate(count).astype(np.int64)), flat, lists], names)

    ident, kind = _id(docs, id_col)
    src = docs.select(ident, docs[text_col].cast("string").alias("text"))
    return mapped(src, run, f"id {kind}, digest binary, words long, small binary, prefixes array<long>")


def _pieces(rows: DataFrame, group: list[str], blocks: Column, node: str) -> DataFrame:
    """Each row once for every pair of blocks that its block is in: adds piece (a hash of group and pair) and side."""
    own = F.pmod(F.xxhash64(node), F.col("blocks")).cast("int")
    return (
        rows.withColumn("blocks", blocks.cast("int"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("piece", F.xxhash64(*group, F.least("own", "other"), F.greatest("own", "other")))
        .withColumn("side", F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2))
        .drop("blocks", "own", "other")
    )


class _Union:
    """Disjoint sets over 0..n-1 that take pairs as arrays."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def labels(self) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return up
            self.root = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            labels = self.labels()
            x, y = labels[a], labels[b]
            differ = x != y
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            if len(a):
                np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))


def _subtrees(agree: int, least: int):
    """Star edges (a, b, depth) between the nodes of a subtree whose signatures agree in enough places."""

    def run(rows: pa.Table) -> pa.Table:
        node, piece, side, tree = (rows.column(c).to_numpy() for c in ("node", "piece", "side", "tree"))
        small = np.frombuffer(b"".join(rows.column("small").to_pylist()), np.uint8).reshape(len(node), -1)
        path = np.zeros(len(node), dtype=np.int64)  # what follows the least prefix
        for k in range(least, DEPTH):
            path = path << 8 | small[np.arange(len(node)), tree * DEPTH + k]
        order = np.lexsort((path, piece))
        node, piece, side, path, small = node[order], piece[order], side[order], path[order], small[order]
        union, met = _Union(len(node)), np.zeros(len(node), dtype=np.int32)
        deeper = np.arange(len(node))  # where the run of an equal longer prefix begins
        for depth in range(DEPTH, least - 1, -1):
            prefix = path >> (8 * (DEPTH - depth))
            first = np.concatenate([np.ones(min(1, len(node)), dtype=bool), (piece[1:] != piece[:-1]) | (prefix[1:] != prefix[:-1])])
            run_of = np.flatnonzero(first)[np.cumsum(first) - 1]
            live, gap = np.arange(len(node) - 1), 1
            while len(live):  # rows that have a row of their run so far behind them
                live = live[live + gap < len(node)]
                live = live[run_of[live] == run_of[live + gap]]
                labels = union.labels()
                pair = live[(deeper[live] != deeper[live + gap]) | (depth == DEPTH)]
                pair = pair[((side[pair] == 0) | (side[pair] != side[pair + gap])) & (labels[pair] != labels[pair + gap])]
                for i in range(0, len(pair), 1 << 14):
                    p = pair[i : i + (1 << 14)]
                    near = p[(small[p] == small[p + gap]).sum(1) >= agree]
                    for x in (near, near + gap):
                        met[x] = np.maximum(met[x], depth)
                    union.add(near, near + gap)
                gap += 1
            deeper = run_of
        root, hit = union.labels(), met > 0
        return pa.table({"a": pa.array(node[hit]), "b": pa.array(node[root[hit]]), "depth": pa.array(met[hit])})

    return run


def _numbered(sets: list[bytes], n: int) -> list[np.ndarray]:
    """For each text (words joined by a space) the numbers of its distinct shingles; equal numbers are equal words."""
    words = pc.split_pattern(pa.array(sets, pa.binary()), b" ")
    ends = words.offsets.to_numpy()
    one = words.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)

    def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]

    m = max(0, len(one) - n + 1)
    run, size, done, out = one, 1, 0, None
    while size <= n:
        if n & size:
            out = run[:m] if out is None else both(out, run[done : done + m])
            done += size
        if 2 * size <= n:
            run = both(run[: max(0, len(run) - size)], run[size:])
        size *= 2
    return [np.unique(out[s : max(s, e - n + 1)]) for s, e in zip(ends[:-1], ends[1:])]


def _verified(top: int, bottom: int, n: int):
    """For each piece of a family: links by node (weighed by copies), and spanning edges; similarity >= top / bottom."""

    def one(node: np.ndarray, side: np.ndarray, copies: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = _numbered(texts, n)
        size = np.array([len(x) for x in own])
        # a shingle of one set alone is in no intersection
        _, inverse, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        place = np.cumsum(times > 1) - 1
        dims = int(place[-1]) + 1 if len(place) else 0
        bits = np.zeros((len(own), (dims + 63) // 64), dtype=np.uint64)
        lo = 0
        for r, x in enumerate(own):
            ids = inverse[lo : lo + len(x)]
            lo += len(x)
            flags = np.zeros(bits.shape[1] * 64, dtype=np.uint8)
            flags[place[ids[times[ids] > 1]]] = 1
            bits[r] = np.packbits(flags).view(np.uint64)
        links, union = np.zeros(len(own), dtype=np.int64), _Union(len(own))
        for r in range(len(own) - 1):
            rest = np.arange(r + 1, len(own))
            rest = rest[(side[r] == 0) | (side[rest] != side[r])]
            rest = rest[np.minimum(size[rest], size[r]) * bottom >= top * np.maximum(size[rest], size[r])]
            for i in range(0, len(rest), 256):
                q = rest[i : i + 256]
                shared = np.bitwise_count(bits[q] & bits[r]).sum(1, dtype=np.int64)
                q = q[(shared > 0) & (shared * (bottom + top) >= top * (size[q] + size[r]))]
                if len(q):
                    links[r] += copies[q].sum()
                    links[q] += copies[r]
                    union.add(np.full(len(q), r), q)
        hit = links > 0
        return node[hit], links[hit], node[union.labels()[hit]]

    def run(rows: pa.Table) -> pa.Table:
        node, piece, side, copies = (rows.column(c).to_numpy() for c in ("node", "piece", "side", "copies"))
        texts = rows.column("words")
        order = np.lexsort((node, side, piece))
        again = np.zeros(len(order), dtype=bool)  # rows repeated in full bring their words again
        again[1:] = (piece[order][1:] == piece[order][:-1]) & (node[order][1:] == node[order][:-1])
        order = order[~again]
        cuts = np.flatnonzero(np.concatenate([[True], piece[order][1:] != piece[order][:-1], [True]]))
        found = [(np.zeros(0, np.int64),) * 3]
        for s, e in zip(cuts[:-1], cuts[1:]):
            at = order[s:e]
            if len(at) > 1:
                found.append(one(node[at], side[at], copies[at], [texts[int(i)].as_py() for i in at]))
        return pa.table({c: np.concatenate([x[k] for x in found]) for k, c in enumerate(("node", "links", "root"))})

    return run


def _with_words(rows: DataFrame) -> DataFrame:
    """Rows (id, text, digest, ...) whose text has the word sequence that the digest names, with its words in place of the text."""
    names = [c for c in rows.columns if c not in ("id", "text", "digest")]
    kinds = dict(rows.dtypes)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        of = lambda c: b.column(b.schema.get_field_index(c))
        words = []
        for i, j, raw, bounds in sliced(of("text")):
            part = Words(raw, bounds, PLAIN)
            words += [part.joined(d) for d in range(j - i)]
        right = [_digest(w) == d for w, d in zip(words, of("digest").to_pylist())]
        out = pa.RecordBatch.from_arrays([*map(of, names), pa.array(words, pa.binary())], [*names, "words"])
        return out.filter(pa.array(right, pa.bool_()))

    return mapped(rows, run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", words binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(id, class_id, same_id, n_links, depth) of every row.

    ``n_links`` counts the other rows at the similarity or more, copies included; ``class_id`` is the least id of
    the row's component under these links, ``same_id`` the least id among rows of the same words, ``depth`` the
    longest prefix by which the row's node found a candidate (null: none).
    """
    top, bottom = round(similarity * 1000), 1000
    values, least = TREES * DEPTH, least_depth(similarity, recall)
    agree = int(np.ceil(values * similarity - DEVIATIONS * np.sqrt(values * similarity * (1 - similarity))))
    sig = checkpointed(signatures(docs, id_col, text_col, least, n).withColumn("row", F.monotonically_increasing_id()))
    live = sig.where("words > 0 and id is not null")
    sets = checkpointed(live.groupBy("digest").agg(F.min(F.struct("row", "id", "words", "small", "prefixes")).alias("m"), F.min("id").alias("same_id"), F.count(F.lit(1)).alias("copies")).select(F.col("m.row").alias("node"), F.col("m.id").alias("id"), "m.words", "m.small", "m.prefixes", "digest", "same_id", "copies"))
    # subtrees of two nodes or more; a hot one is counted map-side, and the join back can split it
    keys = sets.where(F.col("words") >= n).select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    shared = keys.groupBy("prefix").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = keys.join(shared, "prefix").join(sets.select("node", "small"), "node")
    met = _pieces(met, ["prefix"], F.ceil(F.col("size") / BLOCK), "node").select("piece", "side", "tree", "node", "small")
    edges = checkpointed(by_group(met, "piece", _subtrees(agree, least), "a long, b long, depth int"))
    family = checkpointed(components(edges.select("a", "b")))
    members = family.join(sets.select("node", "id", "digest", "copies", "words"), "node")
    sizes = members.groupBy("label").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("words") / BLOCK_WORDS)).alias("parts"))
    wanted = checkpointed(members.drop("words").join(sizes, "label"))
    text = docs.select(_id(docs, id_col)[0], docs[text_col].cast("string").alias("text"))
    found = text.join(F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted, "id")
    work = _pieces(_with_words(found), ["label"], F.col("parts"), "node").select("piece", "side", "node", "copies", "words")
    links = checkpointed(by_group(work, "piece", _verified(top, bottom, n), "node long, links long, root long"))
    label = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    depths = edges.groupBy(F.col("a").alias("node")).agg(F.max("depth").alias("depth"))
    by_node = sets.select("node", "digest", "same_id", "copies").join(label, "node", "left").join(counts, "node", "left").join(depths, "node", "left")
    by_node = by_node.withColumn("label", F.coalesce("label", "node"))
    classes = by_node.groupBy("label").agg(F.min("same_id").alias("class_id"))
    nodes = by_node.join(classes, "label").select(F.col("digest").alias("of"), "class_id", "same_id", "depth", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = sig.select("id", "digest", "words").join(nodes, (F.col("digest") == F.col("of")) & F.col("id").isNotNull() & (F.col("words") > 0), "left")
    return linked.select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("same_id", "id").alias("same_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "depth")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("depth")
