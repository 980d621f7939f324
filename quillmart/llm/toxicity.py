"""Toxicity scores by gradient-boosted trees over dense features (operator 3).

Features of a whole text: densities of a seed lexicon and of one learned from
labelled rows (whole words and beginnings of words), how close their words stand to a second person, capitals,
punctuation and obfuscation rates. The trees' margin is calibrated by isotonic
regression. Labels are learned from a bounded sample of the rows outside the
held-out fold (crc32 of the id as text, modulo 4, is 2): one part for the
lexicon, the other for the trees, cross-fitted for the calibration. Id, language, source and
label are not features.

Defined results: a null or empty text has all features zero and gets their
score; a null id is scored, not held out and never a labelled row; repeated
rows are scored alike; contradicting labels count as separate rows; without
labels of both kinds every score is the calibrated share of label 1 (0 without
any); other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.boosting import Boosted, Isotonic, fit_boosted, fit_isotonic
from quillmart.llm.common import map_batches, smallest_hashes, text_rows, words_of

# Common insults and abuse, and words for a second person.
SEED_LEXICON = frozenset("""
    idiot idiots stupid moron dumb loser scum trash garbage pathetic disgusting worthless clown fool
    hate kill ugly vile filthy shut
""".split())
SECOND_PERSON = frozenset("you your yours yourself u du dich dir dein deine ihr tu te toi ton vous votre tus usted".split())
# Characters written for letters.
LOOK_ALIKE = str.maketrans("013457@$!", "oleastasi")

_OBFUSCATED = re.compile(r"[^\W\d_]+[*@$!0-9][^\s,.;:?]*[^\W\d_](?=[\s,.;:?!]|$)")
_HIDERS = b"*@$!0123456789"
_CAPITALS = bytes(range(65, 91))
N_FEATURES = 17


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


STEMS = (4, 5)


class Lexicon:
    """Learned words and word beginnings with their weights."""

    def __init__(self, entries: list[tuple[int, str, float]]):
        """Entries (stem length or 0 for a whole word, string, weight)."""
        self.words = {w: v for k, w, v in entries if k == 0}
        self.stems = [(k, {w: v for n, w, v in entries if n == k}) for k in STEMS]

    def weight(self, word: str) -> float:
        """The largest weight of the word and its beginnings; 0 for none."""
        return max(self.words.get(word, 0.0), *(d.get(word[:k], 0.0) if len(word) > k else 0.0 for k, d in self.stems))

    def hits(self, words: list[str]) -> list[int]:
        whole, (a, first), (b, second) = self.words, *self.stems
        return [i for i, w in enumerate(words)
                if w in whole or (w[:a] in first and len(w) > a) or (w[:b] in second and len(w) > b)]


def entries_of(word: str) -> list[tuple[int, str]]:
    return [(0, word), *((k, word[:k]) for k in STEMS if len(word) > k)]


def features(text: str, lexicon: Lexicon) -> list[float]:
    words = words_of(text)
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    learned = lexicon.hits(words)
    seed = sum(map(SEED_LEXICON.__contains__, words))
    person = [i for i, w in enumerate(words) if w in SECOND_PERSON] if learned else []
    near = 0
    if person:
        at, place = np.array(learned), np.array(person)
        after = np.searchsorted(place, at)
        gaps = np.minimum(np.abs(at - place[np.maximum(after - 1, 0)]), np.abs(at - place[np.minimum(after, len(place) - 1)]))
        near = int((gaps <= 5).sum())
    weights = [lexicon.weight(words[i]) for i in learned]
    raw = text.encode()

    def among(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    hidden = [m for t in text.split() for m in _OBFUSCATED.findall(t)] if among(_HIDERS) else []
    plain = [h.lower().translate(LOOK_ALIKE) for h in hidden]
    hits = sum(lexicon.weight(p) > 0 or p in SEED_LEXICON for p in plain) + _spelled_out(words)
    return [
        len(learned) / n, np.log1p(len(learned)), sum(set(weights)), max(weights, default=0.0),
        len({words[i] for i in learned}), seed / n, np.log1p(seed), near, near / max(len(learned), 1),
        among(_CAPITALS) / len(raw), sum(map(str.isupper, text.split())) / n,
        among(b"!") / n, among(b"?") / n, text.count("!!") / n, len(hidden) / n, hits, np.log1p(n),
    ]


def _spelled_out(words: list[str]) -> int:
    """Seed words spelled letter by letter."""
    at = [i for i, w in enumerate(words) if len(w) == 1]
    found, run = 0, ""
    for i, nxt in zip(at, at[1:] + [-1]):
        run += words[i]
        if nxt != i + 1:
            found += len(run) >= 4 and run in SEED_LEXICON
            run = ""
    return found


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Boosted
    calibration: Isotonic

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts], float).reshape(-1, N_FEATURES)
        return np.clip(self.calibration(self.trees.margin(x)), 0.0, 1.0)


def _learn_lexicon(rows: DataFrame, most: int, least_docs: int) -> Lexicon:
    """Words and word beginnings whose documents are labelled 1 far more often than others: the
    smoothed log-odds, counted on the executors; at most ``most`` words, each in
    ``least_docs`` and 2 % of the documents labelled 1."""

    def make():
        def run(c: dict) -> dict:
            out = [(k, w, y) for t, y in zip(c["text"], c["toxic"])
                   for k, w in {e for w in set(words_of(t)) for e in entries_of(w)}]
            return {"stem": [k for k, _, _ in out], "word": [w for _, w, _ in out], "toxic": [y for _, _, y in out]}

        return run

    totals = rows.agg(F.sum("toxic"), F.count("*")).first()
    ones, zeros = totals[0] or 0, (totals[1] or 0) - (totals[0] or 0)
    odds = F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((F.col("n") - F.col("ones") + 0.5) / (zeros + 1))
    found = (map_batches(rows.select("text", "toxic"), make, "stem int, word string, toxic int").groupBy("stem", "word")
             .agg(F.sum("toxic").alias("ones"), F.count("*").alias("n")).where(F.col("ones") >= max(least_docs, 0.02 * ones))
             .select("stem", "word", odds.alias("odds"), (odds * F.col("ones")).alias("strength")).where("odds > 2")
             .orderBy(F.desc("strength"), "word", "stem").limit(most).collect())
    return Lexicon([(r["stem"], r["word"], round(r["odds"], 4)) for r in found])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, lexicon_words: int = 400, rounds: int = 60,
        id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learn from at most ``sample`` labelled rows outside the held-out fold
    whose documents are there, those of the smallest hashes of their ids; where
    ids have several documents, from at most four times as many, in the same
    order. So what is broadcast and collected has these bounds."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    labelled = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold != 2)
                .select(F.col("doc_id").cast("long"), F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")))
    there = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    chosen = smallest_hashes(labelled.join(there, "doc_id", "left_semi"), sample, "doc_id", "toxic")
    rows = text_rows(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10))
    rows = rows.withColumn("part", part)
    lexicon = _learn_lexicon(rows.where("part < 3"), lexicon_words, 3)

    def make():
        def run(c: dict) -> dict:
            return {"x": [features(t, lexicon) for t in c["text"]], "toxic": c["toxic"], "doc_id": c["doc_id"]}

        return run

    got = map_batches(rows.where("part >= 3"), make, "doc_id long, toxic int, x array<double>")
    got = sorted((tuple(r) for r in got.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", "x").limit(4 * sample).collect()))
    x, y = np.array([r[2] for r in got], float).reshape(-1, N_FEATURES), np.array([r[1] for r in got], int)
    # Each row's margin for the calibration comes from trees that have not seen it.
    margins, fold_of = np.zeros(len(y)), np.arange(len(y)) % 5
    for k in range(5):
        margins[fold_of == k] = fit_boosted(x[fold_of != k], y[fold_of != k], rounds=rounds).margin(x[fold_of == k])
    return ToxicityModel(lexicon, fit_boosted(x, y, rounds=rounds), fit_isotonic(margins, y))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: id, whether it is held out, score and prediction."""

    def make():
        def run(c: dict) -> dict:
            s = model.score(c["text"])
            return {"doc_id": c["doc_id"], "held_out": list(map(held_out, c["doc_id"])), "score": s,
                    "predicted": (s >= threshold).astype(np.int32)}

        return run

    return map_batches(text_rows(docs, id_col, text_col), make,
                       "doc_id long, held_out boolean, score double, predicted int")
