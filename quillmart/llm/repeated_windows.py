"""Exact substring dedup by depth-limited radix passes (operator 5).

The repeated windows are the strings of ``depth`` bytes that start at two
places or more. Suffixes are ordered only through that depth, digit by digit,
most significant first, and a suffix leaves as soon as its digit is alone; the
groups that are equal at full depth are exactly the repeated windows.

So that not every suffix has to be moved, the first digit stands for a run of
suffixes. Among the places of a window where a string of ``digit`` bytes can
start, the one with the smallest hash (then the first) is its anchor; equal
windows have equal anchors at the same distance. Neighbouring windows with the
same anchor form a run: about one in 50 bytes.

    pass 1  counts runs per anchor digit; alone: leaves
    pass 2  orders the rest by the run's whole content; equal runs are repeated
            windows from end to end
    pass 3  digits with several different runs (the ends of shared passages):
            every window of one run of each content is ordered at full depth

Each pass is an aggregate, pre-aggregated before its shuffle, and an equi-join
whose other side has one row per digit. That side is aggregated in the stage of
the join, which adaptive execution does not split: the rows of a hot digit, and
the spans of one document, meet in one task. Content digits are 64-bit hashes
within a 64-bit anchor digit.

Defined results: a null or empty text has no bytes; texts under ``depth`` bytes
have no window; null ids are carried; repeated rows repeat each other's
strings like any copies; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.common import cut, drop_cut, map_batches, release, row_key, text_rows

LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)
STRETCH = 1 << 22  # bytes of a text handled at once; places fit 24 bits
RUNS = "d1 long, ch long, d long, k1 long, lo int, n int"
WINDOWS = "d1 long, h long, single boolean, d long, k1 long, lo int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, removed array<struct<start: long, `end`: long>>, kept_sha256 string"


class Powers:
    """Powers of the hash base and of its inverse modulo 2 ** 64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE, np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _INVERSE, np.uint64)], dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def digit_hashes(raw: np.ndarray, digit: int) -> np.ndarray:
    """Hash of the ``digit`` bytes from every place on."""
    up, down = _POWERS.of(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    h = (sums[digit:] - sums[:len(sums) - digit]) * down[:len(sums) - digit]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return x if n == width else np.minimum(x[:len(x) - (width - n)], x[width - n:])


def runs_of(raw: bytes, depth: int, digit: int) -> list[tuple[int, int, int]]:
    """(anchor digit, first window start, number of windows) of each run."""
    out = []
    for at in range(0, max(len(raw) - depth + 1, 0), STRETCH):
        part = np.frombuffer(raw, np.uint8, min(len(raw) - at, STRETCH + depth - 1), at)
        h = digit_hashes(part, digit)
        keyed = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_minimum(keyed, depth - digit + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        n = np.diff(np.r_[first, len(anchor)])
        out += zip(h[anchor[first]].view(np.int64).tolist(), (first + at).tolist(), n.tolist())
    return out


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _columns(names: str, rows: list[tuple]) -> dict:
    fields = [f.split()[0] for f in names.split(", ")]
    return dict(zip(fields, zip(*rows))) if rows else {f: [] for f in fields}


def repeated_spans(docs: DataFrame, depth: int = 200, digit: int = 120, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``d, k1`` (id and row key) and ``spans`` (first byte, byte after the
    last) of the repeated windows of each document that has any."""
    spark, rows = docs.sparkSession, text_rows(docs, id_col, text_col)
    keyed = rows.select(F.coalesce("doc_id", F.lit(LAST)).alias("d"), row_key()[0], "text")

    def digits():
        def run(c: dict) -> dict:
            return {"d1": [r[0] for t in c["text"] for r in runs_of(t.encode(), depth, digit)]}

        return run

    def all_runs():
        def run(c: dict) -> dict:
            out = []
            for d, k1, t in zip(c["d"], c["k1"], c["text"]):
                raw = t.encode()
                out += [(d1, _signed(xxhash.xxh3_64_intdigest(raw[lo:lo + n - 1 + depth])), d, k1, lo, n)
                        for d1, lo, n in runs_of(raw, depth, digit)]
            return _columns(RUNS, out)

        return run

    # Pass 1: anchor digits that occur more than once.
    shared = map_batches(keyed, digits, "d1 long").groupBy("d1").agg(F.count("*").alias("c")).where("c > 1").select("d1")
    # Pass 2: their runs, by content.
    runs = cut(map_batches(keyed, all_runs, RUNS).join(shared, "d1"))
    release(spark)
    one = F.min(F.struct("d", "k1", "lo", "n")).alias("one")
    contents = cut(runs.groupBy("d1", "ch").agg(F.count("*").alias("c"), one))
    whole = runs.join(contents.where("c > 1").select("d1", "ch"), ["d1", "ch"], "left_semi")
    whole = cut(whole.select("d", "k1", F.col("lo").cast("long").alias("a"), (F.col("lo") + F.col("n") + (depth - 1)).cast("long").alias("b"))
                .groupBy("d", "k1").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")))
    # Pass 3: digits with several contents, window by window.
    several = contents.groupBy("d1").agg(F.count("*").alias("c")).where("c > 1").select("d1")
    ends = contents.join(several, "d1", "left_semi").select(
        "d1", (F.col("c") == 1).alias("single"), "one.d", "one.k1", "one.lo", "one.n")
    by_doc = cut(ends.groupBy("d", "k1").agg(F.collect_list(F.struct("d1", "single", "lo", "n")).alias("runs")))
    drop_cut(runs, contents)
    del runs, contents, several, ends
    release(spark)

    def every_window():
        def run(c: dict) -> dict:
            out = []
            for d, k1, t, runs_here in zip(c["d"], c["k1"], c["text"], c["runs"]):
                raw = t.encode()
                for r in runs_here:
                    d1, single, lo = r["d1"], r["single"], r["lo"]
                    out += [(d1, _signed(xxhash.xxh3_64_intdigest(raw[p:p + depth])), single, d, k1, p)
                            for p in range(lo, lo + r["n"])]
            return _columns(WINDOWS, out)

        return run

    # A repeated row stands for its key more than once here; its runs are never single.
    windows = map_batches(keyed.join(by_doc, ["d", "k1"]).select("d", "k1", "text", "runs"), every_window, WINDOWS,
                          rows_per_call=16)
    twice = windows.groupBy("d1", "h").agg(F.count("*").alias("c")).where("c > 1").select("d1", "h")
    hits = windows.where("single").join(twice, ["d1", "h"], "left_semi")
    parts = cut(hits.select("d", "k1", F.col("lo").cast("long").alias("a"), (F.col("lo") + depth).cast("long").alias("b"))
                .groupBy("d", "k1").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")))
    drop_cut(by_doc)
    del windows, twice, hits, by_doc
    release(spark)
    return whole.unionByName(parts).groupBy("d", "k1").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches covered by the spans; neighbours join."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, depth: int = 200, digit: int = 120, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document (RESULT): bytes, removed bytes and maximal removed
    runs, their places, and the digest of the remaining bytes."""
    spans = repeated_spans(docs, depth, digit, id_col, text_col)
    rows = text_rows(docs, id_col, text_col)
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("d"), row_key()[0], "text")

    def make():
        def run(c: dict) -> dict:
            out = []
            for doc_id, text, found in zip(c["doc_id"], c["text"], c["spans"]):
                raw = text.encode()
                gone = merged([(s["a"], s["b"]) for s in found or []])
                kept, at = hashlib.sha256(), 0
                for a, b in gone:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                out.append((doc_id, len(raw), sum(b - a for a, b in gone), len(gone),
                            [{"start": a, "end": b} for a, b in gone], kept.hexdigest()))
            return _columns("doc_id, n_bytes, n_removed, n_spans, removed, kept_sha256", out)

        return run

    joined = rows.join(spans, ["d", "k1"], "left").select("doc_id", "text", "spans")
    return map_batches(joined, make, RESULT)
