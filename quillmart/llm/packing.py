"""Lexical retrieval packing (operator 9).

A document's ids fill whole sequences first. What is left of it (shorter than
a sequence) is its rest. Document frequencies and the mean length are counted
over the rests of all documents. The rests are then range-partitioned over the
whole corpus by their rarest shared terms, rarest first, and cut in that order
into shards of bounded size: rests that share rare terms meet in a shard,
wherever their documents lay, and a hot term is split by the next ones and
then by the row's place. A shard has a BM25 inverted index. Sequences are
filled greedily: the next unused rest is the seed, the index returns its
unused neighbours by BM25 score, and they are appended until the window is
full. The last neighbour is cut to fit; its remaining ids seed the next
window. Only a shard's last sequence is padded. A seed's candidates are the
rests of its shard: rests that are alike but differ in their rarest shared
terms can still lie in two shards.

Defined results: a null or empty text is its end id alone; a null id is
carried as null; repeated rows are packed each; an empty table gives an empty
result; other columns are ignored. Sequence ids are unique, not consecutive:
the partition's number times 2^36 plus a count, for whole sequences of one
document 2^62 more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmart.llm.bpe import ByteEncoder, shared
from quillmart.llm.common import cut, map_batches, ship, text_rows

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "`offset` long")
SEQUENCES_PER_PARTITION = 1 << 36
WHOLE = 1 << 62
KEY_TERMS = 8  # rarest shared terms of a rest that its place in the order depends on


@dataclass
class Corpus:
    """Number of rests, their mean length, and for each term (token id) the
    number of rests that hold it."""

    n: int
    mean: float
    df: np.ndarray

    @staticmethod
    def of(rests: list[np.ndarray]) -> Corpus:
        df = np.zeros(1 << 16, np.int64)
        for r in rests:
            df[distinct(r)] += 1
        return Corpus(len(rests), sum(map(len, rests)) / max(len(rests), 1), df)

    def ranks(self) -> np.ndarray:
        """The place of each term from the rarest shared one on; terms that no
        two rests share come last."""
        order = np.lexsort((np.arange(1 << 16), np.where(self.df > 1, self.df, np.iinfo(np.int64).max)))
        ranks = np.empty(1 << 16, np.int64)
        ranks[order] = np.arange(1 << 16)
        return ranks


def distinct(ids: np.ndarray) -> np.ndarray:
    s = np.sort(ids)
    return s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


class ShardIndex:
    """BM25 inverted index of a shard's rests: for each term (token id) the
    rests that hold it, with their weights, as one array sorted by term. The
    statistics are those of ``corpus``, by default of the shard itself."""

    def __init__(self, rests: list[np.ndarray], corpus: Corpus | None = None, k1: float = 1.2, b: float = 0.75):
        self.n = len(rests)
        corpus = corpus or Corpus.of(rests)
        lengths = np.fromiter(map(len, rests), np.int64, self.n)
        norm = k1 * (1 - b + b * lengths / max(corpus.mean, 1.0))
        pairs = np.sort((np.repeat(np.arange(self.n), lengths) << 16) | np.concatenate(rests).astype(np.int64))
        first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
        tf = np.diff(first, append=len(pairs))
        doc, term = pairs[first] >> 16, pairs[first] & 0xFFFF
        weight = (tf * (k1 + 1) / (tf + norm[doc])).astype(np.float32)
        # Terms of each rest, then the postings in the order of terms.
        self.terms, self.own_ends = term, np.cumsum(np.bincount(doc, minlength=self.n))
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.df = np.bincount(term, minlength=1 << 16)
        self.starts = np.cumsum(self.df) - self.df
        # Terms of more than a quarter of the rests: a row of weights over all
        # rests is not four times their postings, and is added up faster.
        common = np.flatnonzero(self.df > self.n // 4)
        self.row = np.full(1 << 16, -1)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.n), np.float32)
        at = self.row[term[order]]
        self.dense[at[at >= 0], self.docs[at >= 0]] = self.weights[at >= 0]
        self.idf = np.log(1 + (corpus.n - corpus.df + 0.5) / (corpus.df + 0.5))

    def scores(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """BM25 scores of all rests for all terms of the seed; -1 for the used
        ones."""
        own = self.terms[self.own_ends[seed - 1] if seed else 0:self.own_ends[seed]]
        row = self.row[own]
        dense, own = own[row >= 0], own[(row < 0) & (self.df[own] > 1)]
        df = self.df[own]
        at = np.arange(df.sum()) + np.repeat(self.starts[own] - np.cumsum(df) + df, df)
        score = np.bincount(self.docs[at], self.weights[at] * np.repeat(self.idf[own], df), self.n)
        score = score + self.idf[dense].astype(np.float32) @ self.dense[row[row >= 0]]
        score[~unused] = -1
        return score


def whole_sequences(doc_id: int | None, ids: np.ndarray, size: int, sequence: int) -> list[tuple]:
    """Pieces (rows of SCHEMA) of a document that fill a sequence each."""
    return [(doc_id, i * size, size, zlib.crc32(ids[i * size:(i + 1) * size].astype("<u4").tobytes()), len(ids), sequence + i, 0)
            for i in range(len(ids) // size)]


def pack_shard(docs: list[tuple[int | None, np.ndarray]], size: int, end_id: int, sequence: int) -> tuple[list[tuple], int]:
    """Pieces (rows of SCHEMA) of a shard's documents and the next sequence id."""
    out, found = [], []
    for doc_id, ids in docs:
        ids = np.append(ids, np.uint16(end_id))
        out += whole_sequences(doc_id, ids, size, sequence)
        full = len(ids) // size
        sequence += full
        if len(ids) > full * size:
            found.append((doc_id, full * size, len(ids), ids[full * size:]))
    pieces, sequence = pack_rests(found, size, sequence)
    return out + pieces, sequence


def pack_rests(found: list[tuple[int | None, int, int, np.ndarray]], size: int, sequence: int,
               corpus: Corpus | None = None) -> tuple[list[tuple], int]:
    """Pieces of a shard's rests (document id, start, ids of the document, ids
    of the rest) and the next sequence id."""
    out: list[tuple] = []
    if not found:
        return out, sequence
    rests = [ids.astype("<u4") for *_, ids in found]
    index = ShardIndex(rests, corpus)
    unused = np.ones(len(rests), bool)
    used_to = np.zeros(len(rests), np.int64)  # ids of each rest that are packed
    left = np.array([len(r) for r in rests])
    at, carried = 0, -1

    def put(i: int, n: int, offset: int) -> None:
        a = int(used_to[i])
        part = rests[i][a:a + n]
        out.append((found[i][0], found[i][1] + a, n, zlib.crc32(part.tobytes()), found[i][2], sequence, offset))
        used_to[i] += n
        left[i] -= n

    while True:
        if carried >= 0:
            seed, carried = carried, -1
        else:
            while at < len(rests) and not unused[at]:
                at += 1
            if at == len(rests):
                break
            seed = at
        unused[seed] = False
        filled = int(left[seed])
        put(seed, filled, 0)
        score = index.scores(seed, unused)
        near = 8
        while filled < size:
            near = min(near, len(score))
            top = np.argpartition(-score, near - 1)[:near] if near < len(score) else np.arange(len(score))
            top = top[np.lexsort((top, -score[top]))]
            for i in top[score[top] >= 0].tolist():
                n = min(int(left[i]), size - filled)
                unused[i] = False
                score[i] = -1
                put(i, n, filled)
                filled += n
                if filled == size:
                    if left[i]:
                        carried = i
                    break
            if near == len(score):
                break
            near *= 8
        sequence += 1
    return out, sequence


def corpus_of(encoded: DataFrame, size: int) -> Corpus:
    """Statistics of the rests of all documents: each task counts its own, one
    row per term goes on."""
    ship(encoded.sparkSession)
    out = StructType.fromDDL("term int, n long")
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, length = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = np.frombuffer(raw, "<u2")
                rest = ids[len(ids) // size * size:]
                if len(rest):
                    df[distinct(rest)] += 1
                    n, length = n + 1, length + len(rest)
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *terms.tolist()], pa.int32()),
                                          pa.array([n, length, *df[terms].tolist()], pa.int64())], schema=arrow)

    got = dict(map(tuple, encoded.select("ids").mapInArrow(run, out).groupBy("term").agg(F.sum("n")).collect()))
    n, length = got.pop(-1, 0), got.pop(-2, 0)
    df = np.zeros(1 << 16, np.int64)
    df[list(got)] = list(got.values())
    return Corpus(n, length / max(n, 1), df)


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, shard_docs: int = 2048,
         shard_ids: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: its place in the document, the CRC of
    its ids (little-endian unsigned 32-bit), and its sequence and place there.
    ``vocabulary`` is a byte-level ``tokenizers`` BPE file, present on every
    executor; ``end_id`` closes each document. A shard holds at most
    ``shard_docs`` rests and about ``shard_ids`` ids. The encoded documents
    are checkpointed, as the statistics, the range bounds, the whole sequences
    and the rests are read from them."""
    ship(docs.sparkSession)
    out = StructType.fromDDL(SCHEMA)
    arrow = to_arrow_schema(out)

    def make_ids():
        encoder = shared(ByteEncoder, vocabulary)

        def run(c: dict) -> dict:
            return {"doc_id": c["doc_id"], "ids": [np.append(i, end_id).astype("<u2").tobytes() for i in encoder.encode(c["text"])]}

        return run

    encoded = cut(map_batches(text_rows(docs, id_col, text_col), make_ids, "doc_id long, ids binary", rows_per_call=1024))
    corpus = corpus_of(encoded, size)
    ranks = corpus.ranks()

    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*pieces)) or [[]] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    def wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = WHOLE + TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        for batch in batches:
            pieces = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pieces += whole_sequences(doc_id, np.frombuffer(raw, "<u2"), size, sequence)
                sequence += len(raw) // 2 // size
            yield rows(pieces)

    def make_rests():
        def run(c: dict) -> dict:
            got = []
            for doc_id, place, raw in zip(c["doc_id"], c["place"], c["ids"]):
                ids = np.frombuffer(raw, "<u2")
                rest = ids[len(ids) // size * size:]
                if len(rest):
                    key = np.sort(ranks[distinct(rest)])[:KEY_TERMS].astype(">u2").tobytes()
                    got.append((doc_id, place, len(ids) - len(rest), len(ids), rest.tobytes(), key))
            names = ("doc_id", "place", "start", "total", "ids", "key")
            return dict(zip(names, zip(*got))) if got else {n: [] for n in names}

        return run

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        shard, n_ids = [], 0
        for batch in batches:
            for doc_id, start, total, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids = np.frombuffer(raw, "<u2")
                if shard and (len(shard) >= shard_docs or n_ids + len(ids) > shard_ids):
                    pieces, sequence = pack_rests(shard, size, sequence, corpus)
                    yield rows(pieces)
                    shard, n_ids = [], 0
                shard.append((doc_id, start, total, ids))
                n_ids += len(ids)
        if shard:
            pieces, sequence = pack_rests(shard, size, sequence, corpus)
            yield rows(pieces)

    rests = map_batches(encoded.withColumn("place", F.monotonically_increasing_id()), make_rests,
                        "doc_id long, place long, start long, total long, ids binary, key binary")
    ordered = rests.repartitionByRange("key", "place").sortWithinPartitions("key", "place")
    return (encoded.where(F.octet_length("ids") >= 2 * size).mapInArrow(wholes, out)
            .unionByName(ordered.select("doc_id", "start", "total", "ids").mapInArrow(run, out)))
