"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 4).

Every distinct fingerprint emits all its variants within half the radius (the
fingerprint and its 64 one-bit neighbours); two fingerprints within two bits
share a variant. Shuffling on the variant brings them together. A variant's
bucket holds itself and its own one-bit neighbours at most, so a bucket is a
64-bit mask that is or-ed map-side: bounded state whatever the data. The
colliding pairs are deduplicated, verified by their bit distance and closed
into components.

Defined results: a null or empty text, or one without words, has fingerprint
zero and links like any other; a null id stays null and counts only where its
whole component has none; repeated rows are copies of each other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.common import cut, map_batches, row_key, text_rows
from quillmart.llm.graph import components

_hash = partial(xxhash.xxh64_intdigest, seed=42)
_BLOCK = 1 << 16


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` words of the text, repeats
    included; the whole sequence if it is shorter. A-Z are lower-cased; words
    are parted by ASCII white space."""
    w = text.encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) < words:
        return np.array([_hash(b" ".join(w))], np.uint64)
    runs = zip(*(w[i:] for i in range(words))) if words > 1 else ((x,) for x in w)
    return np.fromiter(map(_hash, map(b" ".join, runs)), np.uint64, len(w) - words + 1)


def fingerprints_of(hashes: list[np.ndarray]) -> np.ndarray:
    """A bit is 1 if it is set in over half the hashes; no hashes: zero."""
    out = np.zeros(len(hashes), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i, h in enumerate(hashes):
        if len(h):
            ones = np.zeros(64, np.int64)
            for at in range(0, len(h), _BLOCK):
                block = np.ascontiguousarray(h[at:at + _BLOCK], "<u8").view(np.uint8).reshape(-1, 8)
                ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int32)
            out[i] = weights[2 * ones > len(h)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, k1, k2, fp`` (fp: the fingerprint's 64 bits as a long)."""

    def make():
        def run(c: dict) -> dict:
            fps = fingerprints_of([shingle_hashes(t, words) for t in c["text"]])
            return {"doc_id": c["doc_id"], "k1": c["k1"], "k2": c["k2"], "fp": fps.view(np.int64)}

        return run

    rows = text_rows(docs, id_col, text_col)
    return map_batches(rows.select("doc_id", *row_key(), "text"), make, "doc_id long, k1 long, k2 long, fp long")


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """Deduplicated, verified pairs (a < b) of fingerprints that connect all
    fingerprints within ``max_bits`` (0 to 2): in each bucket, its smallest
    member with every other."""
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits must be 0, 1 or 2")
    if max_bits == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    ball = distinct.select("fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit"))
    ball = ball.selectExpr("if(bit < 0, fp, fp ^ shiftleft(1L, bit)) AS variant",
                           "if(bit < 0, 0L, shiftleft(1L, bit)) AS mask", "if(bit < 0, 1, 0) AS own")
    buckets = (ball.groupBy("variant").agg(F.expr("bit_or(mask)").alias("mask"), F.max("own").alias("own"))
               .where("bit_count(mask) + own > 1"))
    members = buckets.selectExpr(
        "variant", "own",
        "concat(if(own = 1, array(variant), array()), transform(filter(sequence(0, 63), "
        "i -> shiftrightunsigned(mask, i) & 1L = 1L), i -> variant ^ shiftleft(1L, i))) AS members")
    # Within one bit the centre must take part; within two any member will do.
    if max_bits == 1:
        members = members.where("own = 1").selectExpr("variant AS hub", "members")
    else:
        members = members.selectExpr("array_min(members) AS hub", "members")
    pairs = members.select("hub", F.explode("members").alias("fp")).where("fp != hub")
    return (pairs.select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b")).distinct()
            .where(F.expr(f"bit_count(a ^ b) <= {int(max_bits)}")))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, k1, k2, fp, component_id`` and ``keeper``
    (k1, k2 of the one row of the component that a deduplication keeps: the
    smallest id, then the smallest key)."""
    prints = cut(fingerprints(docs, words, id_col, text_col))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    distinct = cut(prints.groupBy("fp").agg(F.min(row).alias("best")))
    roots = components(links(distinct, max_bits))
    classes = cut(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                  .select("fp", F.coalesce("root", "fp").alias("root"), "best"))
    best = classes.groupBy("root").agg(F.min("best").alias("keeper"))
    of = classes.select("fp", "root").join(best, "root").select(
        "fp", F.col("keeper.doc_id").alias("component_id"), "keeper")
    return prints.join(of, "fp").select("doc_id", "k1", "k2", "fp", "component_id", "keeper")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents with one row of each component kept, all columns as they
    are. Keepers are found by the row key; repeated rows of a keeper collapse."""
    found = near_duplicates(docs, words, max_bits)
    a, b = names = [_free(docs, "k1"), _free(docs, "k2")]
    keepers = found.select(F.col("keeper.k1").alias(a), F.col("keeper.k2").alias(b)).distinct()
    keyed = docs.withColumns(dict(zip(names, row_key())))
    return keyed.join(keepers, names, "left_semi").dropDuplicates(names).drop(*names)


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name
