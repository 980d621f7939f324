"""Language-model scores by online logistic context mixing (operator 13).

A text is its lower-cased words and one end. Frequent words are symbols of
their own; other words are spelled in pieces of two bytes. Each symbol has a
binary code (Huffman, by corpus counts), and what is predicted is one bit after
the other. The predictors of a bit know how often its two values followed in
the training documents, given the bits of the symbol before it and

* nothing else,
* within a word the piece before, else the last very frequent word (which
  tells the language),
* the two symbols before (behind a word's first piece: that piece),

the latter two as hashed contexts. Their opinions (log odds) are added with weights
that a gate chooses by which contexts are known; the weights follow the coding
error bit by bit through each stretch of a document (``CHUNK`` symbols), and a
table of observed hit rates per confidence refines the result, also online. The
sum of -log2 of the probabilities is the size of the text in bits.

How it runs. Counts of contexts grow with the corpus, so no task holds them.

1. One aggregate counts the training words. The driver gets the most frequent
   ones (at most ``words``, cut at a count so that no sort is needed) and the
   counts of pieces: the alphabet, bounded, broadcast.
2. Stretches of documents are dealt to groups of bounded size by a hash. A
   group asks for its distinct (context, symbol) pairs, with its own training
   counts: one compressed block per bucket of the hash space. A pair, however
   frequent, is in a block once, so no bucket is hot.
3. Each bucket adds up its blocks and answers each group with the log odds along
   the codes of the pairs that it asked for. Rare words are asked for in the same
   way and answered with their counts, for the base score.
4. Each group scores all its stretches side by side.

Blocks are as many as groups times buckets; groups and buckets both hold a fixed
number of symbols.

Defined results: a null text is empty and is its end alone; a null id is a
training document and carried as null; repeated rows count each and have equal
results; without training documents every count is 0; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmart.llm.common import cut, drop_cut, release, row_key, ship

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
END = b""  # no word is empty
CHUNK = 512  # symbols of a document that are scored in a row
GROUP = 1 << 20  # symbols of a group, about
RANK_BITS = 20
LANGUAGE_WORDS = 64  # most frequent words that serve as context
STEPS = 2.0  # log odds are kept in steps of one half
PRIOR = 0.4  # of either bit
RATE, HIT_RATE = 0.01, 0.02
LEVELS = 16  # of confidence
LANES = 1024  # stretches that are scored side by side
TOGETHER = 16  # bits of a stretch that are scored with the same weights
FINAL2, FINAL1, INNER1, PIECES = 1 << 16, 2 << 16, (2 << 16) + 256, (2 << 16) + 512
# Weights at first (no context, near context, two symbols), by the gate: whether
# the two symbols were seen before.
FIRST = np.array([[0.1, 0.95, 0.0], [0.05, 0.65, 0.5]], np.float32)

ENCODED = ("`group` int, k1 long, k2 long, chunk int, train boolean, before array<int>, symbols binary, rare binary, "
           "n_tokens long, n_known long, n_bytes long, logs double")
SCORED = "k1 long, k2 long, chunk int, n_tokens long, n_known long, n_bytes long, logs double, bits double"


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


def trains(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def pieces_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the two-byte pieces of words, one word after the other, and
    their number per word. A word's last piece is marked, and is one byte if
    the length is odd."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
    n = (sizes + 1) // 2
    ends = np.cumsum(n)
    at = 2 * (np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n)) + np.repeat(np.cumsum(sizes) - sizes, n)
    codes = data[at] << 8 | data[at + 1]
    last = ends - 1
    odd = sizes % 2 == 1
    codes[last[odd]] = FINAL1 + data[at[last[odd]]]
    codes[last[~odd]] += FINAL2
    return codes, n


def code_lengths(weights: np.ndarray) -> np.ndarray:
    """Lengths of a Huffman code; weights far below the total are raised so
    that no length exceeds 60."""
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(np.maximum(weights, max(1, int(weights.sum()) >> 40)).tolist())]
    heapq.heapify(heap)
    parent = np.zeros(2 * n - 1, np.int64)
    for node in range(n, 2 * n - 1):
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]] = parent[b[1]] = node
        heapq.heappush(heap, (a[0] + b[0], node))
    depth = np.zeros(2 * n - 1, np.int64)
    for node in range(2 * n - 3, -1, -1):
        depth[node] = depth[parent[node]] + 1
    return depth[:n]


def log_odds(same: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log odds of the bit that came, in steps; 0 where nothing is known."""
    return np.clip(np.rint(STEPS * np.log((same + PRIOR) / (other + PRIOR))), -127, 127).astype(np.int8)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    out = np.repeat(starts - ends + lengths, lengths)
    out += np.arange(len(out))
    return out


class Alphabet:
    """Symbols in the order of their codes, which is the order of the codes as
    bit strings: the symbols below a node of the code tree are neighbours.
    ``middle`` has, for each bit of each code, the first symbol with a 1 there."""

    def __init__(self, words: list[bytes], counts: np.ndarray, pieces: np.ndarray, piece_counts: np.ndarray, n_tokens: int, n_distinct: int):
        self.n_tokens, self.n_distinct = n_tokens, n_distinct
        single = np.arange(FINAL1, PIECES)
        of_piece = np.zeros(PIECES, np.int64)
        of_piece[pieces] = piece_counts
        of_piece[single] += 1
        pieces = np.flatnonzero(of_piece)
        weights = np.concatenate((counts, of_piece[pieces]))
        lengths = code_lengths(weights)
        order = np.lexsort((np.arange(len(weights)), lengths))
        rank = np.empty(len(weights), np.int64)
        rank[order] = np.arange(len(weights))
        self.lengths = lengths[order]
        self.words, self.counts, self.word_ranks = words, counts, rank[:len(words)]
        self.piece_rank = np.full(PIECES, -1, np.int32)
        self.piece_rank[pieces] = rank[len(words):]
        self.inner = np.zeros(len(weights), bool)  # symbols that don't end a word
        self.inner[rank[len(words):][(pieces < FINAL2) | (pieces >= INNER1)]] = True
        frequent = np.argsort(-counts[1:], kind="stable")[:LANGUAGE_WORDS] + 1  # the end is symbol 0
        self.language = np.zeros(len(weights), bool)
        self.language[self.word_ranks[frequent]] = True
        self.starts = np.cumsum(self.lengths) - self.lengths
        # Codes, left-aligned in 62 bits; their bits by blocks of symbols.
        step = (1 << (62 - self.lengths)).astype(np.int64)
        code, total = np.cumsum(step) - step, np.concatenate(([0], np.cumsum(weights[order])))
        self.middle = np.empty(int(self.lengths.sum()), np.int32)
        self.odds = np.empty(len(self.middle), np.int8)
        for at in range(0, len(code), 1 << 15):
            symbol = np.repeat(np.arange(at, min(at + (1 << 15), len(code))), self.lengths[at:at + (1 << 15)])
            where = slice(int(self.starts[at]), int(self.starts[at]) + len(symbol))
            below = 61 - (np.arange(where.start, where.stop) - self.starts[symbol])  # place of the bit
            low, half = code[symbol] >> (below + 1) << (below + 1), np.int64(1) << below
            middle = np.searchsorted(code, low + half)
            first, last = np.searchsorted(code, low), np.searchsorted(code, low + half + (half - 1), "right")
            zeros, ones, came = total[middle] - total[first], total[last] - total[middle], symbol >= middle
            self.middle[where], self.odds[where] = middle, log_odds(np.where(came, ones, zeros), np.where(came, zeros, ones))

    def __getstate__(self) -> dict:
        """The large tables are compressed on their way to the workers; what is
        made on first use is not sent along."""
        kept = {k: v for k, v in self.__dict__.items() if k not in ("of_word", "of_symbol")}
        return kept | {k: squeeze(kept[k]) for k in ("middle", "odds", "counts")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = state | {k: expand(state[k]) for k in ("middle", "odds", "counts")}

    @cached_property
    def of_word(self) -> dict[bytes, int]:
        """The symbol of each word that has its own."""
        return dict(zip(self.words, self.word_ranks.tolist()))

    @cached_property
    def of_symbol(self) -> np.ndarray:
        """The training count of each symbol that is a word."""
        counts = np.zeros(len(self.lengths), np.int64)
        counts[self.word_ranks] = self.counts
        return counts

    def spelled(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words without their own, one word after the other, and
        their number per word. A pair that was never seen is two bytes."""
        codes, n = pieces_of(words)
        symbols = self.piece_rank[codes]
        new = np.flatnonzero(symbols < 0)
        if len(new):
            pair = codes[new]
            second = self.piece_rank[np.where(pair >= FINAL2, FINAL1, INNER1) + (pair & 255)]
            symbols[new] = self.piece_rank[INNER1 + (pair % FINAL2 >> 8)]
            symbols = np.insert(symbols, new + 1, second)
            n = n + np.bincount(np.searchsorted(np.cumsum(n), new, "right"), minlength=len(n))
        return symbols, n


def squeeze(a: np.ndarray) -> bytes:
    """Compressed bytes of an array, all first bytes, then all second ones."""
    width = a.dtype.itemsize
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(-1, width).T).tobytes()
    return len(raw).to_bytes(4, "little") + a.dtype.char.encode() + pa.compress(raw, "zstd", asbytes=True)


def expand(data: bytes) -> np.ndarray:
    dtype = np.dtype(data[4:5].decode())
    raw = pa.decompress(data[5:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).reshape(-1)


def hashed(parts: list[np.ndarray], bits: int) -> np.ndarray:
    """A hash of ``bits`` bits of rows of small numbers."""
    h = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(64 - bits)


class Stretches:
    """The symbols of a group's stretches of documents, one after the other,
    with their two contexts."""

    def __init__(self, rows: pa.Table, alphabet: Alphabet, bits: int):
        symbols = [expand(b) for b in rows["symbols"].to_pylist()]
        self.lengths = np.array([len(s) for s in symbols], np.int64)
        lead = np.array(rows["before"].to_pylist(), np.int32).reshape(-1, 3)
        stream = np.concatenate([x for pair in zip(lead, symbols) for x in pair])
        starts = np.cumsum(self.lengths + 3) - self.lengths - 3
        at = ragged(starts + 3, self.lengths)
        self.train = np.repeat(rows["train"].to_numpy(zero_copy_only=False) if hasattr(rows["train"], "to_numpy") else rows["train"], self.lengths)
        # The last very frequent word at or before each place; each stretch
        # begins with the one before it.
        mark = np.append(alphabet.language, False)[stream]
        mark[starts] = True
        last = np.maximum.accumulate(np.where(mark, np.arange(len(stream)), 0))
        self.symbols = stream[at]
        one, two, near = stream[at - 1], stream[at - 2], stream[last[at - 1]]
        inner = np.append(alphabet.inner, False)  # -1: before the document
        inside = inner[one]
        # Behind a word's first piece both contexts are that piece: one question.
        same = inside & ~inner[two]
        self.near = hashed([np.where(inside, 1, 2), np.where(inside, one, near) + 1], bits)
        self.pair = np.where(same, self.near, hashed([np.where(inside, 3, 4), one + 1, two + 1], bits))
        self.counts = np.concatenate((self.train, self.train & ~same))

    def keys(self) -> np.ndarray:
        return np.concatenate((self.near, self.pair)) << np.uint64(RANK_BITS) | np.tile(self.symbols, 2).astype(np.uint64)


class Plan:
    """Sizes that requests and answers share."""

    def __init__(self, n_symbols: int):
        self.groups = self.buckets = max(1, -(-n_symbols // GROUP))
        self.bits = min(43, max(32, (2 * n_symbols).bit_length() + 6))  # of a context's hash

    def cuts(self, keys: np.ndarray, bits: int) -> np.ndarray:
        """Where the keys (sorted, hashes of ``bits`` bits and ranks) go on to
        the next bucket."""
        first = [-(-(b << bits) // self.buckets) for b in range(1, self.buckets)]
        return np.concatenate(([0], np.searchsorted(keys, np.array(first, np.uint64)), [len(keys)])).astype(np.int64)


def request(rows: pa.Table, alphabet: Alphabet, plan: Plan) -> Iterator[tuple]:
    """(bucket, group, kind, block) of a group: its distinct pairs and rare
    words with its own training counts."""
    group = rows["group"][0].as_py()
    s = Stretches(rows, alphabet, plan.bits)
    flagged = np.sort(s.keys() << np.uint64(1) | s.counts.astype(np.uint64))
    for kind, flagged, bits in ((0, flagged, plan.bits + RANK_BITS), (1, None, 63)):
        if kind:
            rare = [np.frombuffer(b.as_buffer(), "<u8") for b in rows["rare"]]
            train = np.repeat(np.array(rows["train"].to_pylist(), np.uint64), [len(r) for r in rare])
            flagged = np.sort(np.concatenate(rare) & ~np.uint64(1) | train) if rare else np.zeros(0, np.uint64)
        keys, counts = counted(flagged)
        cuts = plan.cuts(keys, bits)
        for bucket in range(plan.buckets):
            a, b = cuts[bucket], cuts[bucket + 1]
            if b > a:
                yield bucket, group, kind, packed_keys(keys[a:b]) + squeeze(counts[a:b])


def counted(flagged: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted (key, trains) numbers and how many of them train."""
    keys = flagged >> np.uint64(1)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    trained = np.concatenate(([0], np.cumsum((flagged & np.uint64(1)).astype(np.int64))))
    return keys[first], np.diff(trained[np.append(first, len(keys))]).astype(np.uint32)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences of contexts and the ranks."""
    parts = [squeeze(np.diff(keys >> np.uint64(RANK_BITS), prepend=np.uint64(0))),
             squeeze((keys & np.uint64((1 << RANK_BITS) - 1)).astype(np.uint32))]
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def unpacked_keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a block."""
    n = int.from_bytes(data[:4], "little")
    m = int.from_bytes(data[4 + n:8 + n], "little")
    contexts, ranks = expand(data[4:4 + n]), expand(data[8 + n:8 + n + m])
    return np.cumsum(contexts) << np.uint64(RANK_BITS) | ranks.astype(np.uint64), expand(data[8 + n + m:])


def code_odds(keys: np.ndarray, counts: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """For sorted distinct (context, symbol) keys with training counts: the log
    odds of each bit of the symbol's code in the context, one key after the
    other, and where each key's begin."""
    shift = np.uint64(RANK_BITS)
    context, symbol = keys >> shift, (keys & np.uint64((1 << RANK_BITS) - 1)).astype(np.int64)
    lengths = alphabet.lengths[symbol]
    starts = np.cumsum(lengths) - lengths
    odds = np.zeros(int(lengths.sum()), np.int8)
    total = np.concatenate(([0], np.cumsum(counts.astype(np.int64))))
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), context[1:] != context[:-1])))
    sizes = np.diff(first, append=len(keys))
    a, b = np.repeat(first, sizes), np.repeat(first + sizes, sizes)
    alive, depth = np.arange(len(keys)), 0
    alone = b - a == 1
    while True:
        # Where no other symbol is left below the node, all further bits agree.
        i = alive[alone]
        rest = lengths[i] - depth
        odds[ragged(starts[i] + depth, rest)] = np.repeat(log_odds(counts[i], 0.0 * counts[i]), rest)
        alive, a, b = alive[~alone], a[~alone], b[~alone]
        if not len(alive):
            return odds, starts
        middle = alphabet.middle[alphabet.starts[symbol[alive]] + depth]
        m = np.searchsorted(keys, context[alive] << shift | middle.astype(np.uint64))
        came = symbol[alive] >= middle
        zeros, ones = total[m] - total[a], total[b] - total[m]
        odds[starts[alive] + depth] = log_odds(np.where(came, ones, zeros), np.where(came, zeros, ones))
        a, b = np.where(came, m, a), np.where(came, b, m)
        depth += 1
        alone = b - a == 1


def answer(rows: pa.Table, alphabet: Alphabet) -> Iterator[tuple]:
    """(group, kind, bucket, block) for each block that came to a bucket."""
    bucket = rows["bucket"][0].as_py()
    kinds, groups = np.array(rows["kind"].to_pylist()), rows["group"].to_pylist()
    for kind in (0, 1):
        of = np.flatnonzero(kinds == kind).tolist()
        if not of:
            continue
        blocks = [unpacked_keys(rows["block"][i].as_py()) for i in of]
        keys = np.concatenate([k for k, _ in blocks])
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        new = np.concatenate((np.ones(1, bool), sorted_keys[1:] != sorted_keys[:-1]))
        first = np.flatnonzero(new)
        counts = np.add.reduceat(np.concatenate([c for _, c in blocks])[order].astype(np.int64), first)
        place = np.empty(len(keys), np.int64)
        place[order] = np.cumsum(new) - 1
        if not kind:
            odds, starts = code_odds(sorted_keys[first], counts, alphabet)
            lengths = alphabet.lengths[(sorted_keys[first] & np.uint64((1 << RANK_BITS) - 1)).astype(np.int64)]
        at = 0
        for i, (k, _) in zip(of, blocks):
            p = place[at:at + len(k)]
            at += len(k)
            yield groups[i], kind, bucket, squeeze(odds[ragged(starts[p], lengths[p])] if not kind else counts[p])


def mixed_bits(odds: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """Bits that each stretch takes: ``odds`` (per predictor, in steps, towards
    the bit that came), the stretches one after the other, of ``lengths`` bits,
    the longest first. All go on together, ``TOGETHER`` bits at a time, after
    which weights and hit rates, each stretch's own, follow what these bits
    were."""
    lanes = len(lengths)
    starts = np.cumsum(lengths) - lengths
    # By gate and predictor: the weights of all stretches.
    weights = [[np.full(lanes, w) for w in gate] for gate in FIRST]
    # Hit rates begin as the confidence itself has them.
    hits = np.tile(1 / (1 + np.exp(-(np.arange(LEVELS, dtype=np.float32) + 0.5) / 2)), 2 * lanes)
    cells = (np.arange(lanes) * (2 * LEVELS)).astype(np.float64)
    cost = np.zeros(lanes)
    one, half, rate, hit_rate = np.float32(1), np.float32(0.5), np.float32(RATE), np.float32(HIT_RATE)
    scale, low = np.float32(1 / STEPS), np.float32(2.0 ** -20)
    for begin in range(0, int(lengths[0]), TOGETHER):
        n = int(np.searchsorted(-lengths, -begin))  # stretches that are not at their end
        at = starts[:n] + np.arange(begin, begin + TOGETHER)[:, None]
        over = at >= starts[:n] + lengths[:n] if lengths[n - 1] < begin + TOGETHER else None
        if over is not None:
            at[over] = 0
        x = [v.take(at).astype(np.float32) for v in odds]  # (bits, stretches)
        for v in x:
            v *= scale
            if over is not None:
                v[over] = 0
        gate = (x[2] != 0).astype(np.float32)
        shut = one - gate
        a, b = ([w[:n] for w in ws] for ws in weights)
        dot = shut * (a[0] * x[0] + a[1] * x[1]) + gate * (b[0] * x[0] + b[1] * x[1] + b[2] * x[2])
        p = one / (one + np.exp(-np.maximum(dot, -20)))
        step = rate * (one - p)
        of_a, of_b = step * shut, step * gate
        for i in (0, 1):
            a[i] += (of_a * x[i]).sum(0)
        for i in (0, 1, 2):
            b[i] += (of_b * x[i]).sum(0)
        cell = (np.minimum(np.abs(dot + dot), LEVELS - 1).astype(np.int8) + gate * LEVELS + cells[:n]).astype(np.int64)
        hit = hits.take(cell)
        side = half * np.sign(dot)
        follow = hit_rate * (side + half - hit)
        p = half * (p + half) + side * (hit - half)
        np.clip(p, low, one - low, out=p)
        np.log2(p, out=p)
        if over is not None:
            p[over] = 0
            follow[over] = 0
        hits[cell] = hit + follow  # of bits of one confidence the last one counts
        cost[:n] -= p.sum(0)
    return cost


def score_group(rows: pa.Table, answers: pa.Table, alphabet: Alphabet, plan: Plan) -> pa.Table:
    """Rows of SCORED for the stretches of a group."""
    s = Stretches(rows, alphabet, plan.bits)
    keys = s.keys()
    distinct, place = np.unique(keys, return_inverse=True)
    blocks = sorted((k, b, i) for i, (k, b) in enumerate(zip(answers["kind"].to_pylist(), answers["bucket"].to_pylist())))
    joined = lambda kind, dtype: np.concatenate([expand(answers["block"][i].as_py()) for k, _, i in blocks if k == kind] or [np.zeros(0, dtype)])
    of_pair = joined(0, np.int8)
    lengths = alphabet.lengths[(distinct & np.uint64((1 << RANK_BITS) - 1)).astype(np.int64)]
    if len(of_pair) != lengths.sum():
        raise RuntimeError("a group's answers don't fit its questions")
    starts, n = np.cumsum(lengths) - lengths, len(s.symbols)
    near, pair = starts[place[:n]], starts[place[n:]]
    own = alphabet.lengths[s.symbols]
    edges = np.concatenate(([0], np.cumsum(s.lengths)))
    n_bits = np.diff(np.concatenate(([0], np.cumsum(own)))[edges])
    order = np.argsort(-n_bits, kind="stable")
    bits = np.empty(len(order))
    for at in range(0, len(order), LANES):  # stretches of like length
        lanes = order[at:at + LANES]
        some = ragged(edges[lanes], s.lengths[lanes])
        size = own[some]
        within = ragged(np.zeros(len(some), np.int64), size)
        odds = [table[np.repeat(begin[some], size) + within] for table, begin in
                ((alphabet.odds, alphabet.starts[s.symbols]), (of_pair, near), (of_pair, pair))]
        bits[lanes] = mixed_bits(odds, n_bits[lanes])
    rare = [np.frombuffer(b.as_buffer(), "<u8") for b in rows["rare"]]
    of_rare = np.concatenate(rare) >> np.uint64(1) if rare else np.zeros(0, np.uint64)
    _, which = np.unique(of_rare, return_inverse=True)
    counts = joined(1, np.int64)[which]
    sums = lambda v: np.diff(np.concatenate(([0], np.cumsum(v)))[np.cumsum([0, *map(len, rare)])])
    return pa.table({
        "k1": rows["k1"], "k2": rows["k2"], "chunk": rows["chunk"], "n_tokens": rows["n_tokens"],
        "n_known": pa.array(rows["n_known"].to_numpy() + sums((counts > 0).astype(np.int64)), pa.int64()), "n_bytes": rows["n_bytes"],
        "logs": pa.array(rows["logs"].to_numpy() + sums(np.log10(counts + 1.0)), pa.float64()), "bits": pa.array(bits, pa.float64())})


def words_in(ids: pa.Array, texts: pa.Array) -> tuple[pa.Table, int]:
    """(word, n) over the training documents among some documents, the end as
    the empty word, and the number of all their tokens."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([t or "" for t in texts.to_pylist()], pa.large_string())))
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    training = np.array([trains(i) for i in ids.to_pylist()], bool)
    counted = pc.value_counts(flat.filter(pc.and_(real, pa.array(training[pc.list_parent_indices(lists).to_numpy()]))))
    words, n = counted.field("values").cast(pa.large_binary()).cast(pa.binary()), counted.field("counts")
    if training.any():
        words, n = pa.concat_arrays([words, pa.array([END], pa.binary())]), pa.concat_arrays([n, pa.array([training.sum()], pa.int64())])
    return pa.table({"word": words, "n": n}), pc.sum(real, min_count=0).as_py() + len(texts)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the training documents, the end as the empty word; null
    is the number of all tokens of all documents. A task adds up before the
    shuffle, in a table of bounded size."""
    ship(texts.sparkSession)
    out = StructType.fromDDL("word binary, n long")
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows, n = [], 0, 0

        def added_up() -> pa.Table:
            return pa.concat_tables(seen).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            for part in in_parts(batch):
                found, some = words_in(part.column(0), part.column(1))
                seen, rows, n = [*seen, found], rows + len(found), n + some
                if rows > 500_000:
                    seen = [added_up()]
                    rows = len(seen[0])
                    if rows > 400_000:
                        yield from seen[0].select(["word", "n"]).cast(arrow).to_batches()
                        seen, rows = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([n], pa.int64())], schema=arrow)
        if seen:
            yield from added_up().select(["word", "n"]).cast(arrow).to_batches()

    return texts.select("doc_id", "text").mapInArrow(run, out).groupBy("word").agg(F.sum("n").alias("n"))


def in_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of (id, text) of some MB of text each, one document at
    the least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64) + 100)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + (1 << 22), "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def learn_alphabet(counts: DataFrame, words: int) -> tuple[Alphabet, int]:
    """The alphabet, with at most ``words`` words besides the end, and the
    number of all tokens. Words that occur once are spelled, so that spelling
    is learned."""
    ship(counts.sparkSession)
    size = F.floor(F.log2("n") * 64).cast("int")
    trained = counts.where("word IS NOT NULL")
    by_size = trained.groupBy((F.col("word") == END).alias("is_end"), size.alias("s")).agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    n_tokens, n_distinct = sum(r["n"] for r in by_size), sum(r["k"] for r in by_size)
    least, room = 10 ** 6, words
    for r in sorted((r for r in by_size if not r["is_end"] and r["s"] >= 64), key=lambda r: -r["s"]):
        if r["k"] > room:
            break
        least, room = r["s"], room - r["k"]
    own = trained.where((F.col("word") != END) & (size >= least)).toArrow()
    own = own.take(pa.compute.sort_indices(own, [("n", "descending"), ("word", "ascending")]))
    n_end = next((r["n"] for r in by_size if r["is_end"]), 0)
    out = StructType.fromDDL("piece int, n long")
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(PIECES, np.int64)
        for batch in batches:
            codes, sizes = pieces_of(batch.column(0).to_pylist())
            np.add.at(seen, codes, np.repeat(batch.column(1).to_numpy(), sizes))
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(seen[found], pa.int64())], schema=arrow)

    spelled = trained.where((F.col("word") != END) & (size < least)).select("word", "n").mapInArrow(run, out)
    pieces = spelled.groupBy("piece").agg(F.sum("n").alias("n")).orderBy("piece").toPandas()
    alphabet = Alphabet([END, *own["word"].to_pylist()], np.array([max(n_end, 1), *own["n"].to_pylist()], np.int64),
                        pieces["piece"].to_numpy(np.int64), pieces["n"].to_numpy(np.int64), n_tokens, n_distinct)
    alphabet.counts[0] = n_end
    total = counts.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    return alphabet, int(total)


def encode(docs: list[tuple[int | None, str | None, int, int]], alphabet: Alphabet, plan: Plan) -> list[tuple]:
    """Rows of ENCODED of some documents (id, text, k1, k2): each is cut at the
    first token beyond every ``CHUNK`` symbols."""
    split = [tokens(text) for _, text, _, _ in docs]
    n_words = np.fromiter(map(len, split), np.int64, len(docs)) + 1
    words = list(chain.from_iterable((*w, END) for w in split))
    found = np.array(list(map(alphabet.of_word.get, words, repeat(-1))), np.int64)
    rare = np.flatnonzero(found < 0)
    rare_words = [words[i] for i in rare.tolist()]
    letters, n_letters = alphabet.spelled(rare_words)
    sizes = np.ones(len(words), np.int64)
    sizes[rare] = n_letters
    ends = np.cumsum(sizes)
    starts = ends - sizes
    symbols = np.empty(int(ends[-1]) if len(words) else 0, "<i4")
    symbols[starts] = found
    if len(rare):
        symbols[ragged(starts[rare], n_letters)] = letters
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, rare_words), "<u8", len(rare))
    counts = np.where(found < 0, 0, alphabet.of_symbol[found])
    # Stretches: the document of each token, and where a new stretch begins.
    doc = np.repeat(np.arange(len(docs)), n_words)
    first_of_doc = np.cumsum(n_words) - n_words
    part = (starts - starts[first_of_doc][doc]) // CHUNK
    first = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
    last = np.append(first[1:], len(words))
    sums = [np.add.reduceat(v, first).tolist() for v in
            (counts > 0, np.fromiter(map(len, words), np.int64, len(words)) + 1, np.log10(counts + 1.0))]
    at, to = starts[first].tolist(), ends[last - 1].tolist()
    rare_at = np.searchsorted(rare, np.append(first, len(words))).tolist()
    # The last very frequent word up to each place, its document's only.
    marks = np.maximum.accumulate(np.where(alphabet.language[symbols], np.arange(len(symbols)), -1))
    rows, now, chunk, doc_start = [], -1, 0, 0
    for i, (d, a, b, n) in enumerate(zip(doc[first].tolist(), at, to, (last - first).tolist())):
        if d != now:
            now, chunk, doc_start, (doc_id, _, k1, k2) = d, 0, a, docs[d]
            train = trains(doc_id)
        before = [-1, -1, -1]
        if a > doc_start:
            near = marks[a - 1]
            before = [int(symbols[near]) if near >= doc_start else -1, int(symbols[a - 2]) if a - 2 >= doc_start else -1, int(symbols[a - 1])]
        rows.append(((k1 + chunk * 0x9E3779B1) % plan.groups, k1, k2, chunk, train, before, squeeze(symbols[a:b]),
                     hashes[rare_at[i]:rare_at[i + 1]].tobytes(), n, sums[0][i], sums[1][i], sums[2][i]))
        chunk += 1
    return rows


def score(docs: DataFrame, words: int = 1 << 18, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams), score (log10 probability of the text) and
    bits_per_byte. ``words`` bounds the words with symbols of their own."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        *row_key(id_col, text_col))
    counts = cut(word_counts(texts))
    alphabet, n_all = learn_alphabet(counts, words)
    drop_cut(counts)
    release(spark)
    plan = Plan(3 * n_all // 2)  # rare words are a few symbols
    shared = spark.sparkContext.broadcast(alphabet)

    def encoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, size = [], 0
        for batch in batches:
            for doc_id, text, k1, k2 in zip(batch.column(0).to_pylist(), batch.column(1), *(batch.column(i).to_pylist() for i in (2, 3))):
                docs.append((doc_id, text.as_py(), k1, k2))
                size += len(docs[-1][1] or "") + 100
                if size > 1 << 20:
                    yield batch_of(encode(docs, shared.value, plan), encoded_schema)
                    docs, size = [], 0
        if docs:
            yield batch_of(encode(docs, shared.value, plan), encoded_schema)

    def batch_of(rows: list, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

    asked, answered = "bucket int, `group` int, kind int, block binary", "`group` int, kind int, bucket int, block binary"
    encoded_schema, asked_schema, answered_schema = (to_arrow_schema(StructType.fromDDL(d)) for d in (ENCODED, asked, answered))
    encoded = texts.mapInArrow(encoded_rows, StructType.fromDDL(ENCODED))
    asks = encoded.groupBy("group").applyInArrow(
        lambda t: pa.Table.from_batches([batch_of(list(request(t, shared.value, plan)), asked_schema)]), asked)
    answers = asks.groupBy("bucket").applyInArrow(
        lambda t: pa.Table.from_batches([batch_of(list(answer(t, shared.value)), answered_schema)]), answered)
    # One job: what was shuffled by group is read for the questions and again
    # for the scores.
    scored = encoded.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(
        lambda t, a: score_group(t, a, shared.value, plan), SCORED)
    # Repeated rows have equal stretches.
    stretches = scored.dropDuplicates(["k1", "k2", "chunk"])
    of_doc = stretches.groupBy("k1", "k2").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "n_bytes", "logs", "bits")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    per_token = float(np.log10(alphabet.n_tokens + alphabet.n_distinct + 1))
    return texts.select("doc_id", "k1", "k2").join(of_doc, ["k1", "k2"]).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(alphabet.n_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * per_token).alias("base_score"), (-F.col("bits") * float(np.log10(2))).alias("score"),
        (F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"))
