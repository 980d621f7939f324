import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillmart.llm import context_mixing as cm
from quillmart.llm import queries
from tests.llm.conftest import SF, same


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in lower.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w] + [b""]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute_base(rows):
    c = Counter(w for i, t in rows if not held(i) for w in words_of(t))
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
            for i, t in rows for w in [words_of(t)]]


def test_words_counted_as_arrays():
    texts = ["", None, "  a\tB\x0b\x0cc ", "\x1c x\x1f", "É é", "\x85a\xa0b", "ÀA\n\n", *["b a " * i for i in range(30)], "long " * 10 ** 6, "a"]
    ids = [None if i == 3 else i for i in range(len(texts))]
    parts = list(cm.in_parts(pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts)], names=["doc_id", "text"]).slice(1)))
    assert len(parts) > 1
    found, n = Counter(), 0
    for part in parts:
        words, some = cm.words_in(part.column(0), part.column(1))
        found.update(dict(zip(words["word"].to_pylist(), words["n"].to_pylist())))
        n += some
    expected = list(zip(ids, texts))[1:]
    assert found == Counter(w for i, t in expected if not held(i) for w in words_of(t))
    assert n == sum(len(words_of(t)) for _, t in expected)


def pieces(word):
    out = [("inner", word[i:i + 2]) for i in range(0, len(word), 2)]
    return [*out[:-1], ("final", out[-1][1])]


def brute_bits(rows, words):
    """Bits of each text by dictionaries of counts, one bit at a time."""
    counts = Counter(w for i, t in rows if not held(i) for w in words_of(t))
    sizes = Counter(int(math.log2(n) * 64) for w, n in counts.items() if w and n > 1)
    own, room = set(), words
    for s in sorted(sizes, reverse=True):
        if sizes[s] > room:
            break
        room -= sizes[s]
        own |= {w for w, n in counts.items() if w and n > 1 and int(math.log2(n) * 64) == s}
    seen = Counter(p for w, n in counts.items() if w and w not in own for p in pieces(w) for _ in range(n))
    for b in range(256):
        seen["inner", bytes([b])] += 1
        seen["final", bytes([b])] += 1
    number = lambda p: int.from_bytes(p[1], "big") + ((cm.INNER1 if p[0] == "inner" else cm.FINAL1) if len(p[1]) == 1 else cm.FINAL2 * (p[0] == "final"))
    listed = [("word", b"")] + [("word", w) for w in sorted(own, key=lambda w: (-counts[w], w))] + sorted(seen, key=number)
    weights = [max(counts[s[1]], 1) if s[0] == "word" and not s[1] else counts[s[1]] if s[0] == "word" else seen[s] for s in listed]
    lengths = cm.code_lengths(np.array(weights))
    code, at = {}, 0
    for i in sorted(range(len(listed)), key=lambda i: (lengths[i], i)):
        code[listed[i]] = format(at >> (62 - lengths[i]), f"0{lengths[i]}b")
        at += 1 << (62 - int(lengths[i]))
    frequent = {("word", w) for w in sorted(own, key=lambda w: (-counts[w], w))[:cm.LANGUAGE_WORDS]}

    def symbols(text):
        out = []
        for w in words_of(text):
            for s in [("word", w)] if not w or w in own else pieces(w):
                if s in code:
                    out.append(s)
                else:
                    out += [("inner", s[1][:1]), (s[0], s[1][1:])]
        return out

    def contexts(line):
        near = None
        for i, s in enumerate(line):
            one, two = (line[i - 1] if i else None), (line[i - 2] if i > 1 else None)
            if one in frequent:
                near = one
            inside = one is not None and one[0] == "inner"
            near_by = ("in", one) if inside else ("near", near)
            yield s, near_by, near_by if inside and not (two and two[0] == "inner") else ("two", one, two)

    node = Counter()
    for s, w in zip(listed, weights):
        for j in range(len(code[s])):
            node[None, code[s][:j + 1]] += w
    for i, t in rows:
        if not held(i):
            for s, *known in contexts(symbols(t)):
                for k in set(known):
                    for j in range(len(code[s])):
                        node[k, code[s][:j + 1]] += 1
    out = []
    for _, t in rows:
        bits, words_here, line = 0.0, words_of(t), symbols(t)
        # Where the stretches begin: at the first word beyond each CHUNK symbols.
        begins, at = set(), 0
        for w in words_here:
            size = len(symbols_of_word(w, own, code))
            begins.add((at // cm.CHUNK, at))
            at += size
        firsts = {min(a for c, a in begins if c == k) for k in {c for c, _ in begins}}
        done: list = []  # of the bits since the weights last changed

        def follow():
            for gate, x, p, level, hit, sign in done:
                weights_now[gate] += cm.RATE * (1 - p) * np.array(x) * [1, 1, gate]
                hits[gate, level] = hit + cm.HIT_RATE * ((1 if sign > 0 else 0 if sign < 0 else 0.5) - hit)
            done.clear()

        for place, (s, *known) in enumerate(contexts(line)):
            if place in firsts:
                done.clear()
                n_bits, weights_now, hits = 0, cm.FIRST.astype(float).copy(), np.tile(1 / (1 + np.exp(-(np.arange(cm.LEVELS) + 0.5) / 2)), (2, 1))
            for j, bit in enumerate(code[s]):
                x = []
                for k in (None, *known):
                    came, other = node[k, code[s][:j] + bit], node[k, code[s][:j] + "10"[int(bit)]]
                    x.append(np.clip(np.rint(cm.STEPS * math.log((came + cm.PRIOR) / (other + cm.PRIOR))), -127, 127) / cm.STEPS)
                gate = int(x[2] != 0)
                dot = float(weights_now[gate] @ x)
                p = 1 / (1 + math.exp(-max(dot, -20)))
                level = min(int(abs(2 * dot)), cm.LEVELS - 1)
                hit = hits[gate, level]
                refined = hit if dot > 0 else 1 - hit if dot < 0 else 0.5
                done.append((gate, x, p, level, hit, dot))
                n_bits += 1
                if n_bits % cm.TOGETHER == 0:
                    follow()
                bits -= math.log2(min(max((p + refined) / 2, 2 ** -20), 1 - 2 ** -20))
        out.append(bits)
    return out


def symbols_of_word(w, own, code):
    if not w or w in own:
        return [w]
    return [x for s in pieces(w) for x in ([s] if s in code else [1, 2])]


@pytest.fixture(scope="module")
def small(rows):
    return [(i, t) for i, t in rows if len(t or "") < 3000][:120] + [(77, "the theé zz一q the"), (77, "the theé zz一q the")]


def test_scores_against_dictionaries_of_counts(spark, small):
    df = spark.createDataFrame(small, "doc_id long, text string").selectExpr("*", "1 AS k1", "2 AS chunk", "3 AS bits").repartition(3)
    got = cm.score(df, words=300).collect()
    base = brute_base(small)
    assert sorted((str(r[0]), *r[1:4], r[4]) for r in got) == sorted((str(b[0]), *b[1:5]) for b in base)
    expected = sorted((str(b[0]), round(b[5], 6), bits) for b, bits in zip(base, brute_bits(small, 300)))
    found = sorted((str(r["doc_id"]), round(r["base_score"], 6), -r["score"] / math.log10(2)) for r in got)
    for e, f in zip(expected, found):
        assert e[:2] == f[:2] and f[2] == pytest.approx(e[2], rel=2e-3)  # single precision


def test_groups_and_buckets_do_not_change_scores(spark, small, monkeypatch):
    df = spark.createDataFrame(small, "doc_id long, text string")
    before = cm.score(df).collect()
    monkeypatch.setattr(cm, "GROUP", 3000)
    after = cm.score(df.repartition(5)).collect()
    line = lambda r: (str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 3))
    assert cm.Plan(60_000).groups == 20 and before
    same(map(line, after), map(line, before))


def test_empty_table_and_no_training_documents(spark, empty):
    assert cm.score(empty).count() == 0
    ids = [i for i in range(60) if held(i)]
    got = cm.score(spark.createDataFrame([(i, f"some text {i}") for i in ids], "doc_id long, text string")).collect()
    assert all(r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and r["score"] < 0 for r in got)


def test_the_two_bits_have_probability_one_together():
    odds = np.random.default_rng(3).integers(-127, 128, (3, 500)).astype(np.int8)
    one, other = (cm.mixed_bits(list(o), np.ones(500, np.int64)) for o in (odds, -odds))
    assert np.abs(2 ** -one + 2 ** -other - 1).max() < 1e-5


def test_blocks_of_keys_come_back():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 62, 5000).astype(np.uint64))
    counts = rng.integers(0, 9, len(keys)).astype(np.uint32)
    k, c = cm.unpacked_keys(cm.packed_keys(keys) + cm.squeeze(counts))
    assert (k == keys).all() and (c == counts).all()


def test_held_out_texts_are_predicted_better_than_by_unigrams(spark):
    got = queries.op13_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert got["score"].sum() > got["base_score"].sum()
    assert got["bits_per_byte"].mean() < 3


def test_query_against_unigrams(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_lm_scoring(spark, SF)
    assert got.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same([(*r[:5], round(r[5], 6)) for r in got.collect()], [(*b[:5], round(b[5], 6)) for b in brute_base(rows)])
