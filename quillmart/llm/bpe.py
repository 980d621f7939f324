"""Byte-pair encoding of pre-tokens by rank-synchronous array merging.

A batch of pre-tokens is one ragged numpy array of symbol ids. In every round
each pre-token applies its own lowest-ranked pair at all its places at once
(left to right where places overlap), and pre-tokens without a pair that can
merge leave the batch. A merge makes a symbol that only later ranks use, so
the result is that of one merge at a time.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

NO_RANK = np.iinfo(np.int32).max
CHARACTERS_AT_ONCE = 1 << 22  # of the texts whose chunks are looked up together

# White space as the vocabularies' own pattern engine sees it (Unicode White_Space).
SPACE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = regex.compile("[" + SPACE + "]+")
WORD_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+")
BYTE_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
                            + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others take the code
    points from 256 on, in order."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class RankMerger:
    """Merge table of a ``tokenizers`` BPE file as numpy arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.final = np.array([vocab[c + end] for c in chars], np.int32)
        self.width = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        # Open addressing: a key lies at its hash or the next free place.
        self.bits = max(8, (3 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks, self.made = np.full(1 << self.bits, NO_RANK, np.int32), np.zeros(1 << self.bits, np.int32)
        todo, at = np.arange(len(keys)), self._hash(keys)
        while len(todo):
            free = np.flatnonzero(self.keys[at] == -1)
            slots, first = np.unique(at[free], return_index=True)
            taken = free[first]
            self.keys[slots], self.ranks[slots], self.made[slots] = keys[todo[taken]], todo[taken], made[todo[taken]]
            left = np.ones(len(todo), bool)
            left[taken] = False
            todo, at = todo[left], (at[left] + 1) % len(self.keys)
        self.specials = [t["content"] for t in spec["added_tokens"]]

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_RANK: none) and merged symbol of each pair."""
        key = left.astype(np.int64) * self.width + right
        at = self._hash(key)
        found = self.keys[at]
        open_ = np.flatnonzero((found != key) & (found != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.keys)
            found = self.keys[at[open_]]
            open_ = open_[(found != key[open_]) & (found != -1)]
        return self.ranks[at], self.made[at]

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol ids of all pieces, in order, and the number of ids of each
        piece. An empty piece has none."""
        return self.merge_raw(np.frombuffer(b"".join(pieces), np.uint8), np.fromiter(map(len, pieces), np.int64, len(pieces)))

    def merge_raw(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of pieces that follow each other in an array of bytes."""
        n = len(size)
        ids = self.inner[raw]
        ends = np.cumsum(size)
        last = ends[size > 0] - 1
        ids[last] = self.final[raw[last]]
        owner = np.repeat(np.arange(n, dtype=np.int32), size)
        done_ids: list[np.ndarray] = []
        done_owner: list[np.ndarray] = []
        rank = np.full(len(ids), NO_RANK, np.int32)
        made = np.zeros(len(ids), np.int32)
        fresh = np.flatnonzero(owner[:-1] == owner[1:]) if len(ids) else np.zeros(0, np.int64)
        while len(ids):
            rank[fresh], made[fresh] = self._look_up(ids[fresh], ids[fresh + 1])
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(ids)])
            lowest = np.minimum.reduceat(rank, starts)
            live = lowest < NO_RANK
            if not live.all():
                keep = np.repeat(live, lengths)
                done_ids.append(ids[~keep])
                done_owner.append(owner[~keep])
                ids, owner, rank, made = ids[keep], owner[keep], rank[keep], made[keep]
                if not len(ids):
                    break
                lowest, lengths = lowest[live], lengths[live]
            hit = rank == np.repeat(lowest, lengths)
            at = np.flatnonzero(hit)
            if len(at) > 1:
                # Overlapping places of one pair (x x x): take every other one of a run.
                run_start = np.r_[True, np.diff(at) > 1]
                if not run_start.all():
                    first = np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))
                    at = at[(np.arange(len(at)) - first) % 2 == 0]
            ids[at] = made[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            changed = np.zeros(len(ids), bool)
            changed[at] = True
            before = at[at > 0] - 1
            # The pair before a merged place starts one symbol earlier, or two if that symbol is itself gone.
            changed[np.where(stay[before], before, before - 1)] = True
            ids, owner, rank, made, changed = ids[stay], owner[stay], rank[stay], made[stay], changed[stay]
            rank[changed] = NO_RANK
            fresh = np.flatnonzero(changed[:-1] & (owner[:-1] == owner[1:]))
        if not done_ids:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        all_ids, all_owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(all_owner, kind="stable")
        return all_ids[order], np.bincount(all_owner, minlength=n)


class Memo(dict):
    """Results per text chunk. Emptied when full: a memo only, never a limit
    on what is computed."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def missing(self, wanted: set) -> list:
        """What of ``wanted`` is to be computed: all of it after a clearing."""
        new = [w for w in wanted if w not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            return list(wanted)
        return new


class WordCounter:
    """Token counts of whole texts for a vocabulary with word ends (lower
    case, white space dropped)."""

    def __init__(self, path: str, memo: int = 500_000):
        self.merger = RankMerger(path)
        self.pieces, self.chunks = Memo(memo), Memo(memo)
        self.special = regex.compile("|".join(map(regex.escape, self.merger.specials))) if self.merger.specials else None

    @staticmethod
    def normalise(text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # capital sigma: no word-final form
        return text.lower()

    def _parts(self, text: str) -> tuple[list[str], int]:
        """Normalised stretches between special strings; number of those."""
        if self.special is None or not any(s in text for s in self.merger.specials):
            return [self.normalise(text)], 0
        parts = self.special.split(text)
        return [self.normalise(p) for p in parts], len(parts) - 1

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """Stretches without white space. ``str.split`` also splits at four
        control characters that the vocabulary counts as symbols."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in SPACES.split(text) if c]
        return text.split()

    def count(self, texts: list[str]) -> np.ndarray:
        chunked, extra = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            parts, extra[i] = self._parts(t)
            chunked.append(self._chunks(parts[0]) if len(parts) == 1 else [c for p in parts for c in self._chunks(p)])
        new = self.chunks.missing(set().union(*chunked))
        if new:
            self._add(new)
        return extra + np.fromiter((sum(map(self.chunks.__getitem__, c)) for c in chunked), np.int64, len(texts))

    def _add(self, chunks: list[str]) -> None:
        pieces = list(map(WORD_PIECES.findall, chunks))
        todo = self.pieces.missing(set().union(*pieces))
        if todo:
            _, n = self.merger.merge([p.encode() for p in todo])
            self.pieces.update(zip(todo, n.tolist()))
        got = self.pieces.__getitem__
        self.chunks.update((c, sum(map(got, p))) for c, p in zip(chunks, pieces))


def _pieces_of_chunk(chunk: str) -> list[str]:
    """Pre-tokens of a chunk: letters, and letters with one mark behind them,
    need no pattern; a chunk begins with its line break or stands for itself
    behind a space."""
    body, lead = (chunk[1:], ["\n"]) if chunk[:1] == "\n" else (chunk, [])
    before = "" if lead else " "
    if body.isalpha():
        return [*lead, before + body]
    if body[:-1].isalpha() and body[-1] in ".,!?;:":
        return [*lead, before + body[:-1], body[-1]]
    return BYTE_PIECES.findall(chunk if lead else " " + chunk)


_LETTER = np.zeros(256, bool)
_LETTER[np.r_[65:91, 97:123, 0xC3]] = True
_LATIN = np.isin(np.arange(256), np.setdiff1d(np.r_[0x80:0xC0], [0x97, 0xB7]))  # letters behind 0xC3
_MARK = np.isin(np.arange(256), list(b".,!?;:"))


def _cut_chunks(chunks: pa.LargeStringArray, more: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes and sizes of the pieces of all chunks and then of ``more``,
    the number of pieces of each, and the places of the chunks in that order:
    Latin-1 letters, with or without one mark behind them, as arrays first."""
    offsets = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset:chunks.offset + len(chunks) + 1] if len(chunks) else np.zeros(1, np.int64)
    data = np.frombuffer(chunks.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    ends, size = offsets[1:] - offsets[0], np.diff(offsets)
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & _LATIN[data[1:]]
    letters = np.concatenate(([0], np.cumsum(letter)))
    letters = letters[ends] - letters[ends - size]
    marked = (size > 1) & (letters == size - 1)
    marked[marked] = _MARK[data[ends[marked] - 1]]
    plain = marked | ((size > 0) & (letters == size))
    long, marked = size[plain] + 1, marked[plain]
    raw = np.full(long.sum(), 32, np.uint8)
    body = np.ones(len(raw), bool)
    body[np.cumsum(long) - long] = False
    raw[body] = data[np.repeat(plain, size)]
    counts = 1 + marked
    sizes = np.ones(counts.sum(), np.int64)
    sizes[np.cumsum(counts) - counts] = long - marked
    rest = [*map(_pieces_of_chunk, chunks.filter(pa.array(~plain)).to_pylist()), *more]
    pieces = [p.encode() for c in rest for p in c]
    return (np.concatenate((raw, np.frombuffer(b"".join(pieces), np.uint8))), np.concatenate((sizes, np.fromiter(map(len, pieces), np.int64, len(pieces)))),
            np.concatenate((counts, np.fromiter(map(len, rest), np.int64, len(rest)))), np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain))))


class ByteEncoder:
    """Ids of whole texts for a byte-level vocabulary, as little-endian
    unsigned 16-bit values (vocabularies up to 65,536 ids)."""

    def __init__(self, path: str, memo: int = 500_000):
        self.merger, self.memo = RankMerger(path), memo
        self.pieces = Memo(memo // 2)
        self._forget()
        specials = self.merger.specials
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        with open(path, encoding="utf-8") as f:
            self.special_id = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # A chunk is a word with the space before it, or with the line break
        # before it. Where white space follows white space its pieces depend on
        # more than the chunk; such texts are cut into pieces as a whole.
        out: list = [None] * len(texts)
        whole: dict[int, list[str]] = {}
        group, size = [], 0
        for i, t in enumerate(texts):
            if self.special is not None and any(s in t for s in self.special_id):
                whole[i] = []
                for part in self.special.split(t):
                    whole[i] += [part] if part in self.special_id else BYTE_PIECES.findall(part)
            elif "  " in t or "\n\n" in t or " \n" in t or "\n " in t:
                whole[i] = BYTE_PIECES.findall(t)
            else:
                if group and size + len(t) > CHARACTERS_AT_ONCE:
                    self._by_chunks(texts, group, out)
                    group, size = [], 0
                group.append(i)
                size += len(t)
        if group:
            self._by_chunks(texts, group, out)
        if whole:
            self._by_pieces(whole, out)
        return out

    def _by_chunks(self, texts: list[str], group: list[int], out: list) -> None:
        """The texts at the places ``group``: each distinct chunk is looked up
        once, its ids are then copied to all of its places as arrays."""
        lists = pc.split_pattern(pc.replace_substring(pa.array([texts[i] for i in group], pa.large_string()), "\n", " \n"), " ")
        begins = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        heads, place = np.unique(at[begins[:-1]], return_inverse=True)
        at[begins[:-1]] = len(words) + place  # a text's first chunk has no space before it
        known = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(known < 0)
        new = words.take(pa.array(missing))
        raw, sizes, counts, order = _cut_chunks(new, [BYTE_PIECES.findall(w) for w in words.take(pa.array(heads)).to_pylist()])
        ids, n = self.merger.merge_raw(raw, sizes)
        ends = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(counts)))]
        # Where the ids of each word, and behind them of each head, lie: in the memo's pool or behind it.
        pool = np.concatenate((self.pool, ids.astype("<u2")))
        made_begin, made_size = len(self.pool) + ends[:-1], np.diff(ends)
        begin, size = np.empty(len(words) + len(heads), np.int64), np.empty(len(words) + len(heads), np.int64)
        old, fresh = np.flatnonzero(known >= 0), missing[order]
        begin[old], size[old] = self.begin[known[old]], self.size[known[old]]
        begin[fresh], size[fresh] = made_begin[:len(new)], made_size[:len(new)]
        begin[len(words):], size[len(words):] = made_begin[len(new):], made_size[len(new):]
        length = size[at]
        to = np.cumsum(length)
        found = pool[np.repeat(begin[at] - to + length, length) + np.arange(to[-1])]
        to = np.concatenate(([0], to))[begins].tolist()
        for i, a, b in zip(group, to, to[1:]):
            out[i] = found[a:b]
        if len(self.known) + len(new) > self.memo:
            self._forget()
        keep = new.take(pa.array(order))
        shift = len(self.pool) - (len(pool) - len(ids))
        self.known = pa.concat_arrays([self.known, keep])
        self.begin, self.size = np.concatenate((self.begin, made_begin[:len(new)] + shift)), np.concatenate((self.size, made_size[:len(new)]))
        self.pool = np.concatenate((self.pool, ids[:ends[len(new)]].astype("<u2")))

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.begin, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u2")

    def _by_pieces(self, whole: dict[int, list[str]], out: list) -> None:
        todo = [p for p in self.pieces.missing(set().union(*whole.values())) if p not in self.special_id]
        if todo:
            ids, n = self.merger.merge([p.encode() for p in todo])
            raw, ends = ids.astype("<u2").tobytes(), (np.cumsum(n) * 2).tolist()
            begin = 0
            for p, e in zip(todo, ends):
                self.pieces[p] = raw[begin:e]
                begin = e
        for s, i in self.special_id.items():
            self.pieces[s] = np.array([i], "<u2").tobytes()
        for i, pieces in whole.items():
            out[i] = np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), "<u2")


_ENCODERS: dict = {}


def shared(kind: type, path: str):
    """One encoder per Python worker and file; its memo lives across tasks."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]
