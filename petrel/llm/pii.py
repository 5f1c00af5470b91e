"""Operator 9: PII by information-theoretic sanitisation.

Formats with a checkable shape (e-mail, IP, card, phone) are the protected entities.
Corpus co-occurrence then estimates how strongly a term reveals one: for each entity e
and each term t in its contexts, ``p(e|t) = joint / count(t)`` and
``bits = log2(p(t|e) / p(t))``, with count(t) over the whole corpus. Every word outside
the entities counts and may be a term, short ones and those with digits too; common words
fail by p(e|t) and bits. A term that stands
near one entity in enough distinct contexts and exceeds the disclosure thresholds is
generalised (``term``) to a broader class or, when it all but names the entity, removed (``name``), at every
place of the corpus outside the entities, whether the entity is near or not.

Null texts are empty. Null and repeated ids are rows like others: one row out for each
row in. Contexts are counted per occurrence; copies of a context count once towards
the number of distinct contexts that a disclosure needs.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm.common import PLAIN, Words, checkpointed, gathered, mapped, sliced, table

KINDS = ["email", "ip", "card", "phone", "term", "name"]
BASE = 4
#: Words on either side of an entity that form its context.
CONTEXT = 6
#: Distinct contexts, p(e|t) and bits from which a term is generalised, and p(e|t) from which it is removed.
CONTEXTS, POSTERIOR, BITS, NAMING = 3, 0.5, 6.0, 0.9
#: Disclosing terms, of twelve bytes each, up to which they are broadcast; beyond, words meet them by a shuffle.
BROADCAST_TERMS = 2_000_000

SPANS = "array<struct<start:int,rank:int,end:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
_NEAR = pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("context", pa.int64())])
_WORD = pa.struct([("term", pa.int64()), *_SPAN])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain in linear time: each local part is read back from its @."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's rank, end) in code points, by start, then kind; leftmost, non-overlapping per kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _hash(x: str) -> int:
    return int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little", signed=True)


def _outside(raw: np.ndarray, start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(first code point, end, outside all spans) of a text's words, whose start and end are bytes of raw; the words of each span."""
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before a byte
    a, b = chars[start], chars[end]
    outside = np.ones(len(a), dtype=bool)
    places = []
    for s, _, e in spans:
        i, j = int(np.searchsorted(b, s, side="right")), int(np.searchsorted(a, e, side="left"))
        outside[i:j] = False
        places.append((i, j))
    return a, b, outside, places


def _near(text: str, spans: list[tuple[int, int, int]], places: list[tuple[int, int]], outside: np.ndarray, term: np.ndarray) -> list[dict]:
    """The words in the contexts of the spans."""
    out = []
    for (i, j), (s, _, e) in zip(places, spans):
        k = np.concatenate([np.arange(max(0, i - CONTEXT), i), np.arange(j, min(len(term), j + CONTEXT))])
        k = k[outside[k]]
        if len(k):
            # of the words in their order, and of how many stand before the entity
            context = int.from_bytes(hashlib.blake2b(term[k].tobytes() + bytes([int((k < i).sum())]), digest_size=8).digest(), "little", signed=True)
            entity = _hash(text[s:e].lower())
            out += [{"entity": entity, "term": int(term[x]), "context": context} for x in k]
    return out


def _observed(docs: DataFrame, text_col: str) -> DataFrame:
    """One row for each text with the terms near its entities and its number of words, and one for each batch with its words' counts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(0)
        all_near, all_words, counted = [], [], []
        for i, j, raw, bounds in sliced(column):
            words = Words(raw, bounds, PLAIN)
            words.forget()
            signed = words.hash.view(np.int64)
            free = np.ones(len(signed), dtype=bool)
            for d in range(i, j):
                text = column[d].as_py() or ""
                spans = entities(text)
                if spans:
                    x, y = words.first[d - i], words.first[d - i + 1]
                    at = bounds[d - i]
                    _, _, outside, places = _outside(raw[at : bounds[d - i + 1]], words.start[x:y] - at, words.end[x:y] - at, spans)
                    all_near.append(_near(text, spans, places, outside, signed[x:y]))
                    free[x:y] = outside
                else:
                    all_near.append([])
            counted.append(np.unique(signed[free], return_counts=True))
            all_words += np.diff(np.concatenate([[0], np.cumsum(free)])[words.first]).tolist()
        terms, inverse = np.unique(np.concatenate([np.zeros(0, np.int64), *(x for x, _ in counted)]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([np.zeros(0, np.int64), *(n for _, n in counted)]), minlength=len(terms)).astype(np.int64)
        rows, ends = len(column), np.zeros(len(column) + 2, dtype=np.int32)
        ends[-1] = len(terms)
        return pa.RecordBatch.from_arrays(
            [pa.array([*all_near, None], pa.list_(_NEAR)), pa.ListArray.from_arrays(pa.array(ends), pa.array(terms)), pa.ListArray.from_arrays(pa.array(ends), pa.array(counts)), pa.array([*all_words, None], pa.int64())],
            ["near", "terms", "counts", "n"],
        ) if rows else None

    src = docs.select(docs[text_col].cast("string").alias("text"))
    return mapped(src, run, "near array<struct<entity:long,term:long,context:long>>, terms array<long>, counts array<long>, n long")


def _marked(docs: DataFrame, id_col: str, text_col: str, told: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """(id, base, words) of each text: its entities, and the words outside them that are among the told terms.

    ``told`` are sorted term hashes and their ranks. Without it, all words outside the entities, of rank -1.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(1)
        all_spans, all_words = [], []
        for i, j, raw, bounds in sliced(column):
            words = Words(raw, bounds, PLAIN)
            words.forget()
            signed = words.hash.view(np.int64)
            rank = np.full(len(signed), -1, dtype=np.int32)
            hit = np.full(len(signed), told is None)
            if told is not None and len(told[0]):
                at = np.minimum(np.searchsorted(told[0], signed), len(told[0]) - 1)
                hit = told[0][at] == signed
                rank[hit] = told[1][at[hit]]
            hits = np.concatenate([[0], np.cumsum(hit)])[words.first]
            for d in range(i, j):
                spans = entities(column[d].as_py() or "")
                all_spans.append([{"start": s, "rank": k, "end": e} for s, k, e in spans])
                if hits[d - i] < hits[d - i + 1]:
                    x, y = words.first[d - i], words.first[d - i + 1]
                    at = bounds[d - i]
                    a, b, outside, _ = _outside(raw[at : bounds[d - i + 1]], words.start[x:y] - at, words.end[x:y] - at, spans)
                    k = np.flatnonzero(hit[x:y] & outside)
                    all_words.append([{"term": t, "start": s, "rank": r, "end": e} for t, s, r, e in zip(signed[x:y][k].tolist(), a[k].tolist(), rank[x:y][k].tolist(), b[k].tolist())])
                else:
                    all_words.append([])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(all_spans, pa.list_(_SPAN)), pa.array(all_words, pa.list_(_WORD))], [id_col, "base", "words"])

    src = docs.select(id_col, docs[text_col].cast("string").alias("text"))
    return mapped(src, run, f"`{id_col}` {kind}, base {SPANS}, words array<struct<term:long,start:int,rank:int,end:int>>")


def disclosures(observed: DataFrame, contexts: int = CONTEXTS, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(entity, term, joint, total, posterior, bits) of the pairs that stand together in enough distinct contexts."""
    pairs = observed.where("near is not null").select(F.explode("near").alias("x")).select("x.*")
    # contexts are counted from one row for each, so a hot pair is one row a context and map task
    joint = pairs.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("c")).groupBy("entity", "term").agg(F.sum("c").alias("joint"), F.count(F.lit(1)).alias("contexts"))
    spread = joint.groupBy("entity").agg(F.sum("joint").alias("around"))
    enough = checkpointed(joint.where(F.col("contexts") >= contexts).join(spread, "entity").select("entity", "term", "joint", "around"))
    # of all words' counts only those of these terms leave their task
    wanted = checkpointed(enough.select("term").distinct())
    counts = observed.where("size(terms) > 0").select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.counts").alias("n"))
    total = counts.join(F.broadcast(wanted) if wanted.count() <= broadcast_terms else wanted, "term").groupBy("term").agg(F.sum("n").alias("total"))
    all_words = observed.agg(F.sum("n").alias("words"))
    return enough.join(total, "term").join(F.broadcast(all_words)).select("entity", "term", "joint", "total", (F.col("joint") / F.col("total")).alias("posterior"), F.log2((F.col("joint") / F.col("around")) / (F.col("total") / F.col("words"))).alias("bits"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", contexts: int = CONTEXTS, posterior: float = POSTERIOR, bits: float = BITS, naming: float = NAMING, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(id, base, spans): sorted spans of the entities, and those with every occurrence of the terms that disclose one."""
    observed = checkpointed(_observed(docs, text_col))
    told = disclosures(observed, contexts, broadcast_terms).where((F.col("posterior") >= posterior) & (F.col("bits") >= bits))
    told = checkpointed(told.groupBy("term").agg(F.max(F.when(F.col("posterior") >= naming, 5).otherwise(4)).alias("rank")))
    if told.count() <= broadcast_terms:
        known = told.sort("term").toArrow()
        out = _marked(docs, id_col, text_col, (known.column("term").to_numpy(), known.column("rank").to_numpy()))
        extra = F.transform("words", lambda w: F.struct(w["start"], w["rank"], w["end"]))
    else:
        rows = checkpointed(_marked(docs, id_col, text_col, None).withColumn("row", F.monotonically_increasing_id()))
        words = rows.select("row", F.explode("words").alias("x")).select("row", "x.term", "x.start", "x.end")
        found = words.join(told, "term").groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("start", "rank", "end")).alias("extra"))
        out = rows.drop("words").join(found, F.col("row") == F.col("r"), "left")
        extra = F.coalesce("extra", F.array().cast(SPANS))
    return out.select(id_col, "base", F.sort_array(F.concat("base", extra.cast(SPANS))).cast(SPANS).alias("spans"))


def _broader(term: Column) -> Column:
    """The class that stands for a generalised term: of numbers, of codes with digits, of capitalised or of other words."""
    digits, digit, capital = term.rlike("^[0-9]+$"), term.rlike("[0-9]"), term.rlike(r"^\p{Lu}")
    return F.when(digits, "[NUMBER]").when(digit, "[CODE]").when(capital, "[PROPER NOUN]").otherwise("[WORD]")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each entity replaced by its kind in brackets, a generalised term by the broader class that its
    letters show, and a term that is to be removed by nothing.

    Where spans overlap, the earlier (then the longer-ranked) stands; what it covers goes with it.
    """
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS[:BASE]), F.lit(None).cast("string"), F.lit(""))
    start = F.struct(F.lit(0).alias("done"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        fits = s["start"] >= acc["done"]
        between = F.substring(text, acc["done"] + 1, s["start"] - acc["done"])
        instead = F.coalesce(F.element_at(names, s["rank"] + 1), _broader(F.substring(text, s["start"] + 1, s["end"] - s["start"])))
        return F.struct(F.when(fits, s["end"]).otherwise(F.greatest(acc["done"], s["end"])).alias("done"), F.when(fits, F.concat(acc["parts"], F.array(between, instead))).otherwise(acc["parts"]).alias("parts"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["done"] + 1, F.length(text)))))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: str, rank: int) -> Column:
    """Spans of one kind. A lambda with a second parameter, be it a default, would get the index."""
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    return gathered(found).select(
        "doc_id",
        *(counted("base", k).alias(f"n_{KINDS[k]}") for k in range(BASE)),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
