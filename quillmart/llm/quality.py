"""Quality rules with an isolation forest on rule statistics (operator 10).

One map stage turns each whole text into rule statistics. Trees of random
splits are grown over the statistics of a bounded sample of documents labelled
good; a document's mean path length gives its anomaly score, and the threshold
is calibrated on all other labelled rows so that at most ``max_good_lost`` of
the good ones go. A document is kept if it passes the base rules and its score stays
below the threshold.

Defined results: a null or empty text has no words and fails the base rules; a
null id stays null and is never a labelled row; repeated rows are judged
alike; repeated or contradicting labels count as separate labelled rows;
without labels of both kinds only the base rules decide; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.common import cut, drop_cut, filter_rows, map_batches, smallest_hashes, text_rows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_digits", "n_marks")
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b"!?;:\"'()[]{}/\\_=+~^@`"
_SPACES = b" \t\n\v\f\r"


def statistics(text: str) -> tuple[int, ...]:
    """The values of COUNTS and EXTRA for one whole text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = 0
    if n >= 3:
        runs = list(zip(words, words[1:], words[2:]))
        if len(set(runs)) < len(runs):
            seen = Counter(runs)
            hit = np.fromiter((seen[r] > 1 for r in runs), bool, n - 2)
            covered = np.zeros(n, bool)
            for shift in range(3):
                covered[shift:shift + n - 2] |= hit
            repeats = int(covered.sum())

    def among(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    return (n, len(text) - among(_SPACES), among(SYMBOLS), len(lines) - len(set(lines)), repeats,
            len(lines), among(_UPPER), among(_DIGITS), among(_MARKS))


N_FEATURES = 6


def features(stats: np.ndarray) -> np.ndarray:
    """Rates, free of a document's length, from rows of statistics."""
    s = dict(zip(COUNTS + EXTRA, np.asarray(stats, float).reshape(-1, len(COUNTS + EXTRA)).T))
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.stack([s["n_symbols"] / words, s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
                     s["n_upper"] / chars, s["n_marks"] / words, s["n_digits"] / chars], axis=1)


SPREADS = 4.0  # how many spreads above the sampled rows a rate counts as clearly out of line
LEAST_REACH = 0.1


def reach_above(x: np.ndarray) -> np.ndarray:
    """How far above the points a random split may fall, per feature: some
    spreads (from the median to the highest value) of the sampled good rows, so
    that a rate with a long tail among them must stand out further; never
    beyond 1, above which a rate of a text's parts can't lie."""
    if not len(x):
        return np.full(N_FEATURES, LEAST_REACH)
    high = x.max(0)
    return np.maximum(np.minimum(SPREADS * (high - np.median(x, 0)), 1 - high), LEAST_REACH)


def failed_base(stats: np.ndarray) -> np.ndarray:
    s = np.asarray(stats, np.int64).reshape(-1, len(COUNTS + EXTRA))
    return (s[:, 0] < 50) | (100 * s[:, 4] > 50 * s[:, 0])


@dataclass
class Forest:
    """Trees as arrays of one node table: split feature (-1: leaf), split
    value, left child (right: the next one) and the path length at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 ** -(mean path length / expected one)."""
        if not len(x) or not len(self.roots):
            return np.zeros(len(x))
        at = np.repeat(self.roots[None, :], len(x), 0)
        row = np.arange(len(x))[:, None]
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                break
            right = x[row, np.maximum(f, 0)] >= self.value[at]
            at = np.where(inner, self.left[at] + right, at)
        return 2.0 ** (-self.path[at].mean(1) / self.norm)


def _expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_forest(x: np.ndarray, trees: int = 100, points: int = 256, seed: int = 17) -> Forest:
    """Isolation trees, each over ``points`` rows drawn without repetition."""
    rng = np.random.default_rng(seed)
    reach = reach_above(x)
    points = min(points, len(x))
    deepest = int(np.ceil(np.log2(max(points, 2)))) + 2
    feature, value, left, path, roots = [], [], [], [], []

    def node() -> int:
        for column, empty in ((feature, -1), (value, 0.0), (left, 0), (path, 0.0)):
            column.append(empty)
        return len(feature) - 1

    for _ in range(trees if len(x) else 0):
        roots.append(node())
        todo = [(roots[-1], x[rng.choice(len(x), points, replace=False)], 0)]
        while todo:
            at, part, depth = todo.pop()
            low, high = part.min(0), part.max(0)
            if depth >= deepest or len(part) < 2:
                path[at] = depth + _expected_path(len(part))
                continue
            f = int(rng.integers(part.shape[1]))
            # The split is drawn from a range that reaches above the points'
            # own: a row far outside it falls into an empty branch early, also
            # where all the sampled rows agree.
            v = rng.uniform(low[f], high[f] + reach[f])
            feature[at], value[at] = f, v
            left[at], _unused = node(), node()
            goes = part[:, f] >= v
            for child, rows in ((left[at], part[~goes]), (left[at] + 1, part[goes])):
                if len(rows):
                    todo.append((child, rows, depth + 1))
                else:
                    path[child] = depth + 1.0
    return Forest(np.array(feature), np.array(value, float), np.array(left), np.array(path, float),
                  np.array(roots, np.int64), max(_expected_path(points), 1.0))


@dataclass
class Rules:
    forest: Forest
    threshold: float

    def rejects(self, stats: np.ndarray) -> np.ndarray:
        """Anomaly verdicts of statistics rows."""
        return self.forest.score(features(stats)) >= self.threshold


def calibrate(scored: DataFrame, max_good_lost: float) -> float:
    """A threshold that rejects at most that share of good rows, and none of
    them where that costs less than 1 % of the bad rows it would catch: half-way
    between the highest good score that stays and the next bad score above. Over
    all rows (quality, score); only counts and single scores leave Spark."""
    good, bad = scored.where("quality = 1"), scored.where("quality <> 1")
    n, highest = good.agg(F.count(F.lit(1)), F.max("score")).first()
    if not n or bad.isEmpty():
        return float("inf")
    top = good.orderBy(F.desc("score")).limit(int(max_good_lost * n) + 1).agg(F.min("score")).first()[0]
    caught, by_highest = bad.agg(F.count_if(F.col("score") > top), F.count_if(F.col("score") > highest)).first()
    if by_highest >= 0.99 * caught:
        top = highest
    above = bad.where(F.col("score") > top).agg(F.min("score")).first()[0]
    return float((top + above) / 2 if above is not None else np.nextafter(top, 2.0))


def _statistics_rows(rows: DataFrame) -> DataFrame:
    names = COUNTS + EXTRA
    extra = [c for c in rows.columns if c != "text"]
    kinds = dict(rows.dtypes)

    def make():
        def run(c: dict) -> dict:
            got = list(zip(*map(statistics, c["text"]))) or [[]] * len(names)
            return {**{k: c[k] for k in extra}, **dict(zip(names, got))}

        return run

    return map_batches(rows, make, ", ".join([f"{c} {kinds[c]}" for c in extra] + [f"{n} long" for n in names]))


def _scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """(quality, score) of rows of statistics."""
    def make():
        def run(c: dict) -> dict:
            stats = np.array([c[n] for n in COUNTS + EXTRA], np.int64).T
            return {"quality": c["quality"], "score": forest.score(features(stats))}

        return run

    return map_batches(rows.select("quality", *COUNTS, *EXTRA), make, f"quality {dict(rows.dtypes)['quality']}, score double")


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000, trees: int = 100, points: int = 256,
        max_good_lost: float = 0.0005, id_col: str = "doc_id", text_col: str = "text") -> Rules:
    """Grow the trees and calibrate the threshold on labelled rows whose
    documents are there. A tree is by its method grown over few points: these
    come from half of the good ones among the ``sample`` rows of the smallest
    hashes of their ids (where ids have several documents, at most four times as
    many, in the same order; so what is broadcast and collected has these
    bounds). All other labelled rows, however many, calibrate the threshold;
    they are scored and counted on the executors."""
    labelled = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long"), "quality")
    there = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    chosen = smallest_hashes(labelled.join(there, "doc_id", "left_semi"), sample, "doc_id", "quality")
    names = COUNTS + EXTRA
    # Statistics before the join: no text is shuffled.
    found = _statistics_rows(text_rows(docs, id_col, text_col).where("doc_id IS NOT NULL")).join(labelled, "doc_id")
    usable = cut(found.where("n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words"))
    half = (F.col("quality") == 1) & (F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(2)) == 0)
    marked = usable.join(F.broadcast(chosen.select("doc_id").distinct().withColumn("chosen", F.lit(True))), "doc_id", "left")
    marked = marked.withColumn("grows", half & F.coalesce("chosen", F.lit(False)))
    got = marked.where("grows").orderBy(F.xxhash64("doc_id"), "doc_id", *names).limit(4 * sample).select("doc_id", *names).collect()
    got.sort()
    forest = grow_forest(features(np.array([r[1:] for r in got], np.int64).reshape(-1, len(names))), trees, points)
    scored = cut(_scored(marked.where("NOT grows"), forest))
    rules = Rules(forest, calibrate(scored, max_good_lost))
    drop_cut(usable, scored)
    return rules


def judge(docs: DataFrame, rules: Rules, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, row key, the rule statistics, the base verdict,
    the anomaly score and whether the document is kept."""
    names = COUNTS + EXTRA

    def make():
        def run(c: dict) -> dict:
            stats = np.array([statistics(t) for t in c["text"]], np.int64).reshape(-1, len(names))
            base, score = failed_base(stats), rules.forest.score(features(stats))
            return {"doc_id": c["doc_id"], **{n: stats[:, i] for i, n in enumerate(names)},
                    "base_failed": base, "anomaly": score, "kept": ~base & (score < rules.threshold)}

        return run

    return map_batches(text_rows(docs, id_col, text_col), make,
                       "doc_id long, " + ", ".join(f"{n} long" for n in names)
                       + ", base_failed boolean, anomaly double, kept boolean")


def keep_good(docs: DataFrame, rules: Rules) -> DataFrame:
    """The documents that the rules keep, all columns as they are: the verdict
    is a column computed beside the row, without a shuffle."""

    def make():
        def passes(texts: list[str]) -> np.ndarray:
            stats = np.array([statistics(t) for t in texts], np.int64).reshape(-1, len(COUNTS + EXTRA))
            return ~failed_base(stats) & ~rules.rejects(stats)

        return passes

    return filter_rows(docs, make)
