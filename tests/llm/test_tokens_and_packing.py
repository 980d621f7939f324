import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quillmart.llm import packing
from quillmart.llm.bpe import ByteEncoder, RankMerger, WordCounter
from quillmart.llm.packing import pack, pack_shard
from quillmart.llm.token_counts import count_tokens
from tests.llm.conftest import same

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = [*"ab  \n\n\t\r'sStT_-.,!?<|>123", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "aaaa", "the", "'re", "'LL",
         *map(chr, (0x3a3, 0x3c3, 0x130, 0xdf, 0x1e9e, 0xc9, 0xe9, 0x663, 0xbd, 0xb2, 0x301, 0x200d, 0x1c, 0x1f, 0x85,
                    0xa0, 0x3000, 0x2028, 0x65e5, 0xd55c, 0x1f600, 0x1c5, 0xfb01, 0, 0x345, 0xfeff, 0x180e, 0x1680))]


def library(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def random_texts():
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(1500)]


def test_word_counts_equal_the_library(random_texts):
    t = Tokenizer.from_file(WORD)
    texts = [*random_texts, "a" * 5000, "ab" * 3000, "naïve café " * 50]
    assert WordCounter(WORD).count(texts).tolist() == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_byte_ids_equal_the_library(random_texts):
    t = Tokenizer.from_file(BYTE)
    texts = [*random_texts, "a" * 5000, "x  y\n\n\nz", " lead", "trail "]
    for text, ids in zip(texts, ByteEncoder(BYTE).encode(texts)):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids


def test_a_full_memo_changes_nothing(random_texts):
    assert WordCounter(WORD, memo=3).count(random_texts[:50]).tolist() == WordCounter(WORD).count(random_texts[:50]).tolist()
    small, large = ByteEncoder(BYTE, memo=3), ByteEncoder(BYTE)
    for i in range(0, 60, 7):
        assert [x.tolist() for x in small.encode(random_texts[i:i + 7])] == [x.tolist() for x in large.encode(random_texts[i:i + 7])]


def test_chunks_of_latin_letters_and_marks_equal_the_library():
    t = Tokenizer.from_file(BYTE)
    words = ["Été", "été.", "a×", "×", "÷b", "Ã", "éà,", "ñ!", "ÿ÷", "e\u0301", "a.,", "don't", "x2", "\nword", "\nçà;", "日本"]
    texts = [" ".join(words[i:] + words[:i]).replace(" \n", "\n") for i in range(len(words))] + ["", " ", "\n", "été", "a "]
    for encoder in (ByteEncoder(BYTE), ByteEncoder(BYTE, memo=3)):
        for _ in range(2):
            for text, ids in zip(texts, encoder.encode(texts)):
                assert ids.tolist() == t.encode(text, add_special_tokens=False).ids


def test_a_memo_of_many_chunks_is_small():
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(1000)) for _ in range(60)]
    encoder = ByteEncoder(BYTE)
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    encoder.encode(texts)
    used = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert used < 100 * 60_000  # 60,000 distinct chunks


def test_overlapping_pairs_merge_left_to_right():
    m = RankMerger(BYTE)
    for n in (0, 1, 2, 3, 5, 8, 13):
        ids, count = m.merge([b"a" * n, b"", b"aa"])
        assert count.tolist() == [len(library(BYTE, "a" * n)), 0, len(library(BYTE, "aa"))]
        assert ids.tolist() == library(BYTE, "a" * n) + library(BYTE, "aa")


def test_count_tokens(docs, rows, empty):
    t = Tokenizer.from_file(WORD)
    expected = []
    for doc_id, text in rows:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 2048))
    same(count_tokens(docs, WORD).collect(), expected)
    assert count_tokens(empty, WORD).count() == 0


def test_packing(docs, rows, empty):
    t = Tokenizer.from_file(BYTE)
    got = pack(docs, BYTE, size=2048, shard_docs=64).collect()
    left = defaultdict(list)
    for doc_id, text in rows:
        left[doc_id].append(t.encode(text or "", add_special_tokens=False).ids + [1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(left)
    for doc_id, all_ids in left.items():
        # Rows with one id are told apart by their lengths; equal ones have equal pieces together.
        expected = defaultdict(int)
        for ids in all_ids:
            expected[len(ids)] += len(ids)
        found = defaultdict(int)
        for p in pieces[doc_id]:
            found[p["doc_tokens"]] += p["length"]
            fits = [ids for ids in all_ids if len(ids) == p["doc_tokens"]]
            part = [zlib.crc32(np.array(i[p["start"]:p["start"] + p["length"]], "<u4").tobytes()) for i in fits]
            assert p["ids_crc32"] in part
        assert found == expected
    padded = total = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        padded += 2048 - at
        total += 2048
    assert padded < 0.06 * total  # one open sequence a shard, and these shards are tiny
    assert pack(empty, BYTE).count() == 0


def test_neighbours_share_words():
    encoder = ByteEncoder(BYTE)
    topics = ["bridge river boat water fish", "planet orbit star comet moon"]
    texts = [" ".join(topics[i % 2].split() * 8) for i in range(16)]
    docs = [(i, ids) for i, ids in enumerate(encoder.encode(texts))]
    size = 4 * (len(docs[0][1]) + 1)
    rows, _ = pack_shard(docs, size, 1, 0)
    by_sequence = defaultdict(set)
    for r in rows:
        by_sequence[r[5]].add(r[0] % 2)
    assert sum(len(s) == 1 for s in by_sequence.values()) >= len(by_sequence) - 2


def test_neighbours_come_from_all_partitions(spark):
    rng = random.Random(3)
    topics = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6)] for _ in range(24)]
    # Partition p holds the p-th document of every topic, so no two of one topic lie together.
    rows = [(p * 100 + i, " " + " ".join(rng.sample(w, 6) * 4)) for p in range(4) for i, w in enumerate(topics)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "doc_id long, text string")
    of = defaultdict(list)
    for r in pack(docs, BYTE, size=512, shard_docs=32).collect():
        of[r["sequence_id"]].append(r)
    topic_of = [{r["doc_id"] % 100 for r in s} for s in of.values()]
    pieces = sum(len(s) for s in of.values())
    assert sum(map(len, topic_of)) < 0.75 * pieces


def test_statistics_cover_all_documents(spark, docs, rows):
    encoder, size = ByteEncoder(BYTE), 256
    ids = [np.append(i, 1).astype("<u2") for i in encoder.encode([t or "" for _, t in rows])]
    rests = [r for r in (i[len(i) // size * size:] for i in ids) if len(r)]
    df = np.zeros(1 << 16, int)
    for r in rests:
        df[list(set(r.tolist()))] += 1
    encoded = spark.createDataFrame([(i.tobytes(),) for i in ids], "ids binary").repartition(5)
    got = packing.corpus_of(encoded, size)
    assert got.n == len(rests) and (got.df == df).all() and abs(got.mean - np.mean([len(r) for r in rests])) < 1e-9


def test_scores_are_bm25_over_all_terms():
    rng = np.random.default_rng(4)
    rests = [np.minimum(rng.zipf(1.3, 400), 3000).astype("<u4") for _ in range(60)]
    index, df = packing.ShardIndex(rests), defaultdict(int)
    for r in rests:
        for w in set(r.tolist()):
            df[w] += 1
    mean = np.mean([len(r) for r in rests])
    for seed in (0, 7, 59):
        expected = []
        for r in rests:
            total = 0.0
            for w in set(rests[seed].tolist()) & set(r.tolist()):
                tf = (r == w).sum()
                # A term of the seed alone scores nothing for another rest.
                if df[w] > 1:
                    total += np.log(1 + (60 - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(r) / mean))
            expected.append(total)
        unused = np.ones(60, bool)
        unused[seed] = False
        got = index.scores(seed, unused)
        assert len(set(rests[seed].tolist())) > 32 and got[seed] == -1
        assert np.allclose(np.delete(got, seed), np.delete(expected, seed), rtol=1e-4)
