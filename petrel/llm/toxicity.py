"""Operator 10: toxicity by gradient-boosted trees over dense features.

Features of a text: densities of two lexicons (a hand-written one; one of words and
word beginnings learned from labelled texts), lexicon words near the second person,
capitals, punctuation, and obfuscation (digits or signs in place of letters). Isotonic
calibration turns log-odds into probabilities; it is fitted on scores that come from a
lexicon and trees learned without the row's own fold. The score is 99 parts of that and
one part of the raw probability, which orders texts of one level.

Training takes a bounded sample: of each class the SAMPLE labelled rows whose ids hash
lowest. Weights restore the classes' shares. Labels, language, source and id never
enter a score. Null and empty texts have features like others (no words) and a score.
Null labels are left out; several labels of one id count as toxic if one is. Without
labelled rows, or with one class alone, the score is that class's share (0 without any).
A row of null id is scored; it has no labels and is not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm.boost import Isotonic, Trees
from petrel.llm.common import PLAIN, Words, _table, checkpointed, gathered, labels_modulus, mapped, sliced, table

#: Labelled rows of each class that training takes at most; folds out of which calibration takes its scores.
SAMPLE, FOLDS = 12_000, 3
SAMPLE_PARTITIONS = 12
#: Share of the toxic sample that must hold a learned entry (and least texts), and times the clean sample's share.
ENTRY_SHARE, ENTRY_TEXTS, ENTRY_RATIO = 0.003, 5, 20.0
PREFIXES = (4, 5, 6)
NEAR = 4
CUT = 0.3
#: Share of the raw probability in the score; it orders texts that calibration puts at one level.
ORDER = 0.01

INSULTS = """idiot idiots moron morons stupid stupidity loser losers trash garbage scum pathetic worthless disgusting clown clowns dumb dumbass fool fools jerk jerks liar liars
    filth filthy vermin imbecile cretin retard bastard bitch crap shit fuck asshole hate kill
    dumm idioten trottel depp abschaum versager widerlich wertlos
    stupide connard imbécile ordure minable raté dégoûtant nul
    estúpido imbécil basura escoria perdedor inútil asqueroso payaso""".split()
PERSON = """you your yours yourself youre u ur du dich dir dein deine deinen deiner euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros""".split()

#: Signs read as the letters that they resemble.
_LEET = PLAIN.copy()
for _sign, _letter in {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "x", "+": "t"}.items():
    _LEET[ord(_sign)] = ord(_letter)
for _sign in "'_-.":
    _LEET[ord(_sign)] = PLAIN[ord(_sign)]

_SIGNS = np.isin(np.arange(256), np.frombuffer(b"@$*#%&|", np.uint8))
NAMES = ["insults", "insult_density", "learned", "learned_density", "near_person", "capitals", "shouted", "exclaims", "questions", "obfuscated", "signs", "log_words", "person_density"]


def _hashes(words: list[str]) -> np.ndarray:
    raw = "\n".join(words).encode()
    return np.unique(Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), PLAIN).hash)


_INSULTS, _PERSON = _hashes(INSULTS), _hashes(PERSON)


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(h):
        return np.zeros(len(h), dtype=bool)
    at = np.searchsorted(known, h)
    at[at == len(known)] = 0
    return known[at] == h


def _entries(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word, hash) of the words and of their beginnings."""
    return [(np.arange(len(words.hash)), words.hash), *(words.prefixes(n) for n in PREFIXES)]


def _per_segment(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags each of the adjoining segments holds."""
    out = np.add.reduceat(np.append(flags, False), bounds[:-1], dtype=np.int64)
    out[bounds[1:] <= bounds[:-1]] = 0
    return out


def features(text: pa.Array, *lexica: np.ndarray) -> list[np.ndarray]:
    """For each lexicon (sorted hashes of learned entries) a table with a row of NAMES for each text."""
    out: list[list[np.ndarray]] = [[np.zeros((0, len(NAMES)))] for _ in lexica]
    for _, _, raw, bounds in sliced(text):
        words, plain = Words(raw, bounds, PLAIN), Words(raw, bounds, _LEET)
        n = np.diff(words.first)
        w, size = np.maximum(n, 1), np.maximum(np.diff(bounds), 1)
        hand, person, hidden = _among(words.hash, _INSULTS), _among(words.hash, _PERSON), _among(plain.hash, _INSULTS)
        entries, plain_entries = _entries(words), _entries(plain)
        words.forget()
        plain.forget()
        # words from the last person word, and to the next, within a text
        close, at = np.zeros(len(hand), dtype=bool), np.flatnonzero(person)
        if len(at):
            i = np.arange(len(hand))
            nxt = np.searchsorted(at, i)
            for k in (np.minimum(nxt, len(at) - 1), np.maximum(nxt - 1, 0)):
                close |= (np.abs(at[k] - i) <= NEAR) & (words.doc[at[k]] == words.doc)
        upper = (raw >= 65) & (raw <= 90)
        long = words.end - words.start
        shouted = np.zeros(len(long), dtype=bool)
        if len(long):
            shouted = (long >= 3) & (np.add.reduceat(np.append(upper, False), np.column_stack([words.start, words.end]).ravel(), dtype=np.int64)[::2] == long)
        signs = [100 * _per_segment(flags, bounds) for flags in (upper, raw == 33, raw == 63, _SIGNS[raw])]
        hands, persons, shouts = (_per_segment(flags, words.first) for flags in (hand, person, shouted))
        for table, learned in zip(out, lexica):
            known, obscure = np.zeros(len(hand), dtype=bool), hidden.copy()
            for found, of in ((known, entries), (obscure, plain_entries)):
                for k, h in of:
                    found[k[_among(h, learned)]] = True
            bad = hand | known
            knowns = _per_segment(known, words.first)
            hiding = np.maximum(_per_segment(obscure, plain.first) - _per_segment(bad, words.first), 0)
            table.append(np.column_stack([hands, 100 * hands / w, knowns, 100 * knowns / w, _per_segment(bad & close, words.first), signs[0] / size, 100 * shouts / w, signs[1] / w, signs[2] / w, hiding, signs[3] / w, np.log1p(n), 100 * persons / w]))
    return [np.concatenate(x) for x in out]


@dataclass
class Model:
    learned: np.ndarray
    trees: Trees | None
    calibration: Isotonic | None
    share: float

    def score(self, text: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(text), self.share)
        raw = self.trees(features(text, self.learned)[0])
        return np.clip((1 - ORDER) * self.calibration(raw) + ORDER / (1 + np.exp(-raw)), 0.0, 1.0)


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(toxic, fold, text) of the bounded sample, checkpointed, and the number of labelled rows of each class."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).where(labels_modulus(id_col) != 2).groupBy(id_col).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64(id_col)
    # at most 2 * size ids and classes: some hundred kilobytes
    picked = F.broadcast(known.where("toxic = 1").orderBy(order, id_col).limit(size).union(known.where("toxic = 0").orderBy(order, id_col).limit(size)))
    # copies share a fold; the sample is bounded, so it needs no more partitions on more data
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    rows = docs.select(id_col, docs[text_col].cast("string").alias("text")).join(picked, id_col).select("toxic", fold, "text")
    return checkpointed(rows.repartition(SAMPLE_PARTITIONS)), n


def _runs(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs, and how often each occurs."""
    order = np.lexsort((of, h))
    h, of = h[order], of[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), dtype=bool), (h[1:] != h[:-1]) | (of[1:] != of[:-1])]))
    return h[new], of[new], np.diff(np.append(new, len(h)))


def learn_entries(rows: DataFrame) -> list[np.ndarray]:
    """Words and beginnings that toxic texts hold far more often than clean ones: of all rows, then without each fold.

    An entry stands in ENTRY_SHARE of the toxic sample at least, so their number is bounded by the sample's.
    """
    n = np.zeros((2, FOLDS), dtype=np.int64)
    for r in rows.groupBy("toxic", "fold").agg(F.count(F.lit(1)).alias("n")).collect():
        n[r["toxic"], r["fold"]] = r["n"]

    def counted(part: DataFrame, among: np.ndarray | None) -> DataFrame:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            folds, found = b.column(1).to_numpy(), []
            for i, _, raw, bounds in sliced(b.column(0)):
                words = Words(raw, bounds, PLAIN)
                doc, h = [], []
                for at, x in _entries(words):
                    known = slice(None) if among is None else _among(x, among)
                    doc.append(words.doc[at][known])
                    h.append(x[known])
                h, doc = _runs(np.concatenate(h), np.concatenate(doc))[:2]  # once for each text
                h, fold, n = _runs(h, folds[i + doc])  # a row for each hash and fold of the slice
                found.append((h.view(np.int64), fold.astype(np.int32), n))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, kind), *(x[k] for x in found)])) for k, kind in enumerate((np.int64, np.int32, np.int64))], ["h", "fold", "n"])

        by_fold = [F.sum(F.when(F.col("fold") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(FOLDS)]
        return mapped(part.select("text", "fold"), run, "h long, fold int, n long").groupBy("h").agg(*by_fold)

    def table_of(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        got = counts.toArrow()
        return got.column("h").to_numpy().view(np.uint64), np.column_stack([got.column(f"n{k}").to_numpy() for k in range(FOLDS)]).reshape(-1, FOLDS)

    every = sum((F.col(f"n{k}") for k in range(1, FOLDS)), F.col("n0"))
    # an entry that is frequent enough without a fold is so, less that fold's share of the bar, with it
    bar = max(ENTRY_TEXTS, int(ENTRY_SHARE * (n[1].sum() - n[1].max())))
    h, toxic = table_of(counted(rows.where("toxic = 1"), None).where(every >= bar))
    order = np.argsort(h)
    h, toxic = h[order], toxic[order]
    clean = np.zeros_like(toxic)
    if len(h):
        some, found = table_of(counted(rows.where("toxic = 0"), h))
        clean[np.searchsorted(h, some)] = found
    lexica = []
    for out in (None, *range(FOLDS)):
        use = [k for k in range(FOLDS) if k != out]
        n1, n0 = n[1][use].sum(), n[0][use].sum()
        t, c = toxic[:, use].sum(1), clean[:, use].sum(1)
        ratio = ((t + 0.5) / (n1 + 1)) / ((c + 0.5) / (n0 + 1))
        lexica.append(h[(ratio >= ENTRY_RATIO) & (t >= max(ENTRY_TEXTS, int(ENTRY_SHARE * n1)))])
    return lexica


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SAMPLE) -> Model:
    """A model of the bounded sample. What calibrates a row comes from a lexicon and trees that have not seen its fold."""
    rows, n = sample(docs, labels, id_col, text_col, size)
    if not (n.get(0) and n.get(1)):
        return Model(np.zeros(0, np.uint64), None, None, float(bool(n.get(1))))
    lexica = learn_entries(rows)
    columns = [f"{c}_{k}" for k in range(len(lexica)) for c in NAMES]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        tables = features(b.column(2), *lexica)
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c) for x in tables for c in x.T)], ["toxic", "fold", *columns])

    got = mapped(rows.select("toxic", "fold", "text"), run, "toxic int, fold int, " + ", ".join(f"{c} double" for c in columns)).toPandas().sort_values(["toxic", "fold", *columns], kind="stable")
    y, fold, x = got["toxic"].to_numpy(), got["fold"].to_numpy(), got[columns].to_numpy().reshape(len(got), len(lexica), len(NAMES))
    have = np.bincount(y, minlength=2)
    if not have.all():
        return Model(lexica[0], None, None, float(have[1] > 0))
    weight = np.where(y == 1, n[1] / have[1], n[0] / have[0]) / ((n[0] + n[1]) / len(y))
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        out = fold == k
        fit = ~out if np.bincount(y[~out], minlength=2).all() else np.ones(len(y), dtype=bool)
        raw[out] = Trees.fit(x[fit, k + 1], y[fit], weight[fit])(x[out, k + 1])
    return Model(lexica[0], Trees.fit(x[:, 0], y, weight), Isotonic.fit(raw, y, weight), n[1] / (n[0] + n[1]))


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows with a score each; a column of that name is replaced. ``keep``: only these columns come back from Python."""
    names = [c for c in (docs.columns if keep is None else keep) if c != score_col]
    kept = text_col in names and dict(docs.dtypes)[text_col] == "string"  # else the text goes to Python beside them
    src = docs.select(*names) if kept else docs.select(*names, docs[text_col].cast("string").alias("text__"))
    at = names.index(text_col) if kept else len(names)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        text = b.column(at)
        return pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(model.score(text))], [*names, score_col])

    return mapped(src, run, "".join(f"`{c}` {t}, " for c, t in src.dtypes[: len(names)]) + f"`{score_col}` double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, train(docs, table(spark, sf_dir, "labels")), keep=("doc_id",))
    return gathered(out).select("doc_id", F.coalesce(labels_modulus() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
