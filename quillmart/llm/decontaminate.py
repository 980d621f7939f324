"""Benchmark decontamination by size-partitioned MinHash containment search
(operator 8).

Items are partitioned by the power of two of their shingle counts. An item is
contained in a document if at least ``share`` of its distinct shingles occur
there, so the document misses at most n - ceil(share * n) of them: among any
one more than that, one occurs in the document. A partition's sketch length
follows from its largest size, and an item's sketch is that many of its
smallest shingle hashes (bottom-k MinHash). A document that holds none of an
item's sketch can't contain it, whatever the document's length, so the search
loses nothing. Candidates are verified by exact containment of the shingles.

The items are the stated query set: they are read in blocks of at most
``block`` items and ``block_chars`` characters, and each block's sketches are
broadcast by themselves, so their size is bounded at any number of items.

Shingles are runs of ``words`` words, lower case, without punctuation. An item
with fewer words is one shingle of all its words.

Defined results: an item or document that is null, empty or without words
matches nothing; a null id is carried as null; repeated documents give repeated
rows; repeated items with one id are separate items of that id and their best
match counts; no items or no documents: no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.common import filter_rows, map_batches, row_key, ship, text_rows, words_of

_MIX = np.uint64(0x9E3779B97F4A7C15)
_word_hash = xxhash.xxh3_64_intdigest
FOUND = "doc_id long, k1 long, k2 long, item_id long, n_found long, n_shingles long, containment double"


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """64-bit hash of every run of ``words`` word hashes."""
    n = len(hashes) - words + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(words):
        out = (out ^ hashes[i:i + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_word_hash, words), np.uint64, len(words))


class Sketches:
    """Search structure of a block of items, by shingle length: the sketch
    hashes in order with their items, and the items' exact shingles."""

    def __init__(self, items: list[tuple[int | None, str]], words: int, share: float):
        self.share = share
        self.ids: list[int | None] = []
        self.shingles: list[frozenset] = []
        by_length: dict[int, list[int]] = defaultdict(list)
        for item_id, text in items:
            w = words_of(text or "")
            if w:
                k = min(words, len(w))
                by_length[k].append(len(self.ids))
                self.ids.append(item_id)
                self.shingles.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)))
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, members in by_length.items():
            partitions: dict[int, list[int]] = defaultdict(list)
            for m in members:
                partitions[len(self.shingles[m]).bit_length()].append(m)
            pairs = []
            for part in partitions.values():
                most = max(len(self.shingles[m]) for m in part)
                # Missing shingles grow with the size: the largest item's length holds for its partition.
                length = most - self.needed(most) + 1
                for m in part:
                    sketch = sorted(int(shingle_hashes(_hashes(list(s)), k)[0]) for s in self.shingles[m])[:length]
                    pairs += [(h, m) for h in sketch]
            pairs.sort()
            self.tables[k] = (np.array([h for h, _ in pairs], np.uint64), np.array([m for _, m in pairs], np.int64))

    def needed(self, n: int) -> int:
        """The fewest shingles of n that make the share."""
        k = int(np.ceil(self.share * n - 1e-9))
        return max(k, 1)

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item, shingles found) of every contained item."""
        w = words_of(text)
        if not w:
            return []
        hashes, out = _hashes(w), []
        for k, (keys, owner) in self.tables.items():
            mine = shingle_hashes(hashes, k)
            if not len(mine):
                continue
            at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            hits = np.unique(mine[keys[at] == mine])
            if not len(hits):
                continue
            low, high = np.searchsorted(keys, hits), np.searchsorted(keys, hits, "right")
            candidates = set().union(*(owner[a:b].tolist() for a, b in zip(low, high)))
            have = set(zip(*(w[i:] for i in range(k))))
            for m in sorted(candidates):
                n = len(self.shingles[m] & have)
                if n >= self.needed(len(self.shingles[m])):
                    out.append((m, n))
        return out


def item_blocks(items: DataFrame, block: int, block_chars: int, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in blocks, streamed through the driver one partition at a time."""
    now, chars = [], 0
    for r in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        size = len(r[1] or "")
        if now and (len(now) >= block or chars + size > block_chars):
            yield now
            now, chars = [], 0
        now.append((r[0], r[1]))
        chars += size
    if now:
        yield now


def contained_items(docs: DataFrame, items: DataFrame, words: int = 5, share: float = 0.8,
                    block: int = 20_000, block_chars: int = 20_000_000, id_col: str = "doc_id",
                    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and contained item: ids, the document's row key,
    the item's shingles found and in all, and their ratio; of an item id's
    texts the best match. One map pass over the documents per block of items.
    With several blocks an item id may lie in more than one: then the matches
    (not the documents) are shuffled and the best one kept."""
    spark = docs.sparkSession
    ship(spark)
    rows = text_rows(docs, id_col, text_col)
    rows = rows.select("doc_id", *row_key(), "text")
    parts: list[DataFrame] = []
    for items_now in item_blocks(items, block, block_chars, item_id_col, item_text_col):
        sent = spark.sparkContext.broadcast(Sketches(items_now, words, share))

        def make(sent=sent):
            sketches = sent.value

            def run(c: dict) -> dict:
                out = []
                for d, k1, k2, t in zip(c["doc_id"], c["k1"], c["k2"], c["text"]):
                    best: dict = {}
                    for m, n in sketches.find(t):
                        item, of = sketches.ids[m], len(sketches.shingles[m])
                        best[item] = max(best.get(item, (0.0, 0, 0)), (n / of, n, of))
                    out += [(d, k1, k2, item, n, of, r) for item, (r, n, of) in best.items()]
                names = [f.split()[0] for f in FOUND.split(", ")]
                return dict(zip(names, zip(*out))) if out else {x: [] for x in names}

            return run

        parts.append(map_batches(rows, make, FOUND))
    if len(parts) < 2:
        return parts[0] if parts else spark.createDataFrame([], FOUND)
    found = reduce(DataFrame.unionByName, (p.withColumn("block", F.lit(i)) for i, p in enumerate(parts)))
    # A block with a match has one row for each repeated row of the document.
    best = found.groupBy("doc_id", "k1", "k2", "item_id").agg(
        F.max(F.struct("containment", "n_found", "n_shingles")).alias("b"),
        (F.count("*") / F.count_distinct("block")).cast("int").alias("copies"))
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return best.select("doc_id", "k1", "k2", "item_id", "b.n_found", "b.n_shingles", "b.containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, words: int = 5, share: float = 0.8,
                      block: int = 20_000, block_chars: int = 20_000_000, text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that contain no item, all columns as they are: a filter in
    the map stage, one pass per block of items."""
    for items_now in item_blocks(items, block, block_chars, item_id_col, item_text_col):
        sent = docs.sparkSession.sparkContext.broadcast(Sketches(items_now, words, share))

        def make(sent=sent):
            sketches = sent.value
            return lambda texts: [not sketches.find(t) for t in texts]

        docs = filter_rows(docs, make, text_col)
    return docs
