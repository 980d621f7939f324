"""Substring dedup by sliding sentence spans (operator 7).

For runs of consecutive sentences, at least ``sentences`` sentences and
``least_words`` words long, two are hashed per sentence: the shortest that
starts with it and the shortest that ends with it. Each sentence of a longer
run lies in one of these inside that run, so a sentence is found as if every
run were hashed. The hashes are joined globally, and a sentence goes if any run that is not the
first of its hash covers it. First: the smallest document id, then the row
key, then the place; so a passage stays in one document.

A text is cut into sentences once; a small row per document (ends, hashes and
word counts of its sentences) is checkpointed, and runs are made from that
both times they are needed. The first runs of repeated hashes are found by an
aggregate and checkpointed, so that the join of all runs with them is a join of
two shuffled sides, in which adaptive execution splits a hash with very many
runs; nothing is gathered per hash.

A sentence ends after . ! or ? and white space, or at a line break; its hash
takes its lower-case words without punctuation, so copies that differ in these
are found too. Sentences without words belong to the one before.

Defined results: a null or empty text has no sentences and stays empty; null
ids come last; repeated rows (same id and text) are one document, so they keep
the same sentences, but a run repeated within a document stays only at its
first place; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.common import cut, map_batches, release, row_key, text_rows, words_of

_BREAK = re.compile(r"[.!?]+[\"')\]]*\s+|\s*\n\s*")
LAST = (1 << 63) - 1
_TWO = struct.Struct("<qq")
SENTENCES = "d long, k1 long, ends binary, hashes binary, words binary"
RUNS = "h1 long, h2 long, d long, k1 long, at int, until int"
RESULT = ("doc_id long, n_sentences long, n_removed long, removed array<struct<start: long, `end`: long>>, "
          "kept_sha256 string, kept_text string")


def sentences_of(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, normalised words, number of words) of each sentence; the
    stretches cover the whole text."""
    out: list[list] = []
    start = 0
    ends = [m.end() for m in _BREAK.finditer(text)]
    for end in [*ends, len(text)] if not ends or ends[-1] < len(text) else ends:
        words = words_of(text[start:end])
        if words or not out:
            if out and not out[-1][3]:  # leading marks without a word
                out[-1][1:] = [end, " ".join(words), len(words)]
            else:
                out.append([start, end, " ".join(words), len(words)])
        else:
            out[-1][1] = end
        start = end
    return [tuple(s) for s in out if s[1] > s[0]]


def runs_of(words: list[int], hashes: bytes, sentences: int, least_words: int) -> list[tuple[int, int, int, int]]:
    """(hash high, hash low, first sentence, sentence after the last) of the
    shortest runs from each sentence on and up to each sentence, from the number
    of words and the 16-byte hash of each sentence."""
    spans, n = set(), len(words)
    j = total = 0
    for i in range(n):
        while j < n and (j - i < sentences or total < least_words):
            total += words[j]
            j += 1
        if j - i < sentences or total < least_words:
            break
        spans.add((i, j))
        total -= words[i]
    i = total = 0
    for j in range(1, n + 1):
        total += words[j - 1]
        while j - i > sentences and total - words[i] >= least_words:
            total -= words[i]
            i += 1
        if j - i >= sentences and total >= least_words:
            spans.add((i, j))
    digest, two = xxhash.xxh3_128_digest, _TWO.unpack
    return [(*two(digest(hashes[16 * i:16 * j])), i, j) for i, j in sorted(spans)]


def sentence_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (SENTENCES) per document row: where its sentences end, in code
    points, their hashes and numbers of words; checkpointed."""
    rows = text_rows(docs, id_col, text_col)
    keyed = rows.select(F.coalesce("doc_id", F.lit(LAST)).alias("d"), row_key()[0], "text")

    def make():
        def run(c: dict) -> dict:
            found = [sentences_of(t) for t in c["text"]]
            digest = xxhash.xxh3_128_digest
            return {"d": c["d"], "k1": c["k1"], "ends": [array("q", [s[1] for s in f]).tobytes() for f in found],
                    "hashes": [b"".join([digest(s[2].encode()) for s in f]) for f in found],
                    "words": [array("q", [s[3] for s in f]).tobytes() for f in found]}

        return run

    return cut(map_batches(keyed, make, SENTENCES))


def _runs(found: DataFrame, sentences: int, least_words: int) -> DataFrame:
    def make():
        def run(c: dict) -> dict:
            out = [(h1, h2, d, k1, i, j) for d, k1, hashes, words in zip(c["d"], c["k1"], c["hashes"], c["words"])
                   for h1, h2, i, j in runs_of(array("q", words).tolist(), hashes, sentences, least_words)]
            names = [f.split()[0] for f in RUNS.split(", ")]
            return dict(zip(names, zip(*out))) if out else {n: [] for n in names}

        return run

    return map_batches(found.select("d", "k1", "hashes", "words"), make, RUNS)


def first_runs(runs: DataFrame) -> DataFrame:
    """The first run of each hash that has several."""
    return (runs.groupBy("h1", "h2").agg(F.min(F.struct("d", "k1", "at")).alias("first"), F.count("*").alias("n"))
            .where("n > 1").select("h1", "h2", "first"))


def later_runs(runs: DataFrame, firsts: DataFrame) -> DataFrame:
    return runs.join(firsts, ["h1", "h2"]).where(F.struct("d", "k1", "at") != F.col("first"))


def repeated_sentences(found: DataFrame, sentences: int = 2, least_words: int = 20) -> DataFrame:
    """``d, k1`` (id and row key) and ``spans`` (first sentence, sentence after
    the last) of the runs of a document that are not the first of their hash."""
    firsts = cut(first_runs(_runs(found, sentences, least_words)))
    release(found.sparkSession)
    again = later_runs(_runs(found, sentences, least_words), firsts)
    return again.groupBy("d", "k1").agg(F.collect_set(F.struct("at", "until")).alias("spans"))


def remove_repeats(docs: DataFrame, sentences: int = 2, least_words: int = 20,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document (RESULT): its sentences, the removed stretches in
    code points, and the kept text."""
    found = sentence_rows(docs, id_col, text_col)
    repeats = cut(repeated_sentences(found, sentences, least_words))
    release(docs.sparkSession)
    rows = text_rows(docs, id_col, text_col)
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("d"), row_key()[0], "text")
    parts = found.select("d", "k1", "ends").dropDuplicates(["d", "k1"]).join(repeats, ["d", "k1"], "left")

    def make():
        def run(c: dict) -> dict:
            out = []
            for doc_id, text, ends, spans in zip(c["doc_id"], c["text"], c["ends"], c["spans"]):
                ends = array("q", ends).tolist()
                gone = sorted({s for r in spans or [] for s in range(r["at"], r["until"])})
                kept, removed, at = [], [], 0
                for s in gone:
                    a, b = ends[s - 1] if s else 0, ends[s]
                    if removed and removed[-1]["end"] == a:
                        removed[-1]["end"] = b
                    else:
                        removed.append({"start": a, "end": b})
                for r in removed:
                    kept.append(text[at:r["start"]])
                    at = r["end"]
                kept = "".join(kept) + text[at:]
                out.append((doc_id, len(ends), len(gone), removed, hashlib.sha256(kept.encode()).hexdigest(), kept))
            names = ("doc_id", "n_sentences", "n_removed", "removed", "kept_sha256", "kept_text")
            return dict(zip(names, zip(*out))) if out else {n: [] for n in names}

        return run

    joined = rows.join(parts, ["d", "k1"]).select("doc_id", "text", "ends", "spans")
    return map_batches(joined, make, RESULT)
