import hashlib
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from quillmart.llm import decontaminate, repeated_windows, sentence_spans, simhash
from quillmart.llm.graph import components
from tests.llm.conftest import PASSAGE, same


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_fingerprint(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    runs = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    """Smallest member of each fingerprint's component."""
    nodes = sorted(set(fps))
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="module")
def small(rows):
    return [(i, t) for i, t in rows if len(t or "") < 50_000]


def test_simhash_against_all_pairs(spark, small, empty):
    fps = [brute_fingerprint(t) for _, t in small]
    of = brute_components(fps, 2)
    best = {}
    for (i, _), fp in zip(small, fps):
        if i is not None:
            best[of[fp]] = min(best.get(of[fp], i), i)
    df = spark.createDataFrame(small, "doc_id long, text string").withColumns({"fp": F.lit(1), "root": F.lit(2)})
    got = simhash.near_duplicates(df.repartition(4)).selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') AS f", "component_id")
    same(got.collect(), [(i, f"{fp:016x}", best.get(of[fp])) for (i, _), fp in zip(small, fps)])
    assert simhash.near_duplicates(empty).count() == 0
    df = df.withColumns({"k1": F.lit("one"), "_K1": F.lit("two"), "__k1": F.lit("three"), "k2": F.lit("four")})
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and kept.first()["__k1"] == "three"
    classes = {of[fp] for fp in fps}
    found = [of[brute_fingerprint(r["text"])] for r in kept.collect()]
    assert len(found) == len(set(found)) and set(found) == classes


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_connect_like_all_pairs(spark, bits):
    import random
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b for x in base for b in [x, *(x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(25))]} | {0, 1, 2 ** 63, 2 ** 63 + 1}
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    root = {r["node"]: r["root"] for r in components(simhash.links(df, bits)).collect()}
    of = brute_components(fps, bits)
    groups = lambda f: sorted(sorted(k for k in fps if f(k) == g) for g in {f(k) for k in fps})
    assert groups(lambda k: of[k]) == groups(lambda k: root.get(k - 2 ** 64 if k >> 63 else k, k - 2 ** 64 if k >> 63 else k))


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1000 + i) for i in range(1, 300)] + [(2000 + i, 2001 + i) for i in range(0, 40, 2)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(300))
    assert got[2001] == 2000 and len(got) == 61 + 300 + 40


def test_repeated_windows_against_a_window_table(docs, rows, empty):
    depth = 200
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + depth] for b in texts for i in range(len(b) - depth + 1))
    expected = []
    for (doc_id, _), b in zip(rows, texts):
        mark = bytearray(len(b))
        for i in range(len(b) - depth + 1):
            if seen[b[i:i + depth]] > 1:
                mark[i:i + depth] = b"\1" * depth
        kept = bytes(x for x, m in zip(b, mark) if not m)
        spans = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        expected.append((doc_id, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    got = repeated_windows.remove_repeats(docs, depth).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    same(got.collect(), expected)
    assert repeated_windows.remove_repeats(empty).count() == 0


def test_runs_do_not_depend_on_where_a_text_is_cut(monkeypatch, spark):
    text = "".join(chr(97 + (i * i * 7 + i // 13) % 26) for i in range(3000))
    df = spark.createDataFrame([(1, text + "tail one"), (2, "head two " + text)], "doc_id long, text string").coalesce(1)
    whole = repeated_windows.runs_of(text.encode(), 200, 100)
    monkeypatch.setattr(repeated_windows, "STRETCH", 512)
    parts = repeated_windows.runs_of(text.encode(), 200, 100)
    assert sum(n for _, _, n in whole) == sum(n for _, _, n in parts) == 3000 - 199
    got = {r["doc_id"]: r["removed"] for r in repeated_windows.remove_repeats(df).collect()}
    # The passage and what happens to agree at its edges, nothing else.
    assert [(s["start"], s["end"]) for s in got[1]] == [(0, 3000)] and [(s["start"], s["end"]) for s in got[2]] == [(9, 3009)]


def span_runs(found):
    hashes = b"".join(xxhash.xxh3_128_digest(s[2].encode()) for s in found)
    return sentence_spans.runs_of([s[3] for s in found], hashes, 2, 20)


def test_sentence_spans_against_brute_force(docs, rows, empty):
    big = 1 << 63
    found = [sentence_spans.sentences_of(t or "") for _, t in rows]
    for (_, t), s in zip(rows, found):
        assert "".join((t or "")[a:b] for a, b, _, _ in s) == (t or "")
    first = {}
    for (i, t), s in zip(rows, found):
        for h1, h2, a, _ in span_runs(s):
            at = (big if i is None else i, a)
            first[h1, h2] = min(first.get((h1, h2), at), at)
    expected = []
    for (i, t), s in zip(rows, found):
        gone = {k for h1, h2, a, b in span_runs(s)
                if first[h1, h2] != (big if i is None else i, a) for k in range(a, b)}
        expected.append((i, len(s), len(gone), "".join((t or "")[x:y] for k, (x, y, _, _) in enumerate(s) if k not in gone)))
    got = sentence_spans.remove_repeats(docs).select("doc_id", "n_sentences", "n_removed", "kept_text").collect()
    same(got, expected)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[9007]["n_removed"] == 0 and "The mayor promised" not in by_id[9008]["kept_text"]
    assert by_id[9008]["kept_text"].startswith("Another start here")
    assert sentence_spans.remove_repeats(empty).count() == 0


def test_sentence_spans_against_all_runs(spark, small):
    words = lambda n, tag: " ".join(f"{tag}{i}" for i in range(n))
    shared = f"{words(10, 'a')}. {words(10, 'b')}. {words(3, 'c')}."
    rows = [*small, (20_001, f"{words(9, 'x')}. {shared} {words(12, 'y')}."), (20_002, f"{words(8, 'v')}. {shared} {words(14, 'w')}.")]
    found = [[x[2:] for x in sentence_spans.sentences_of(t or "")] for _, t in rows]

    def runs(s):
        for a in range(len(s)):
            n = 0
            for b in range(a, len(s)):
                n += s[b][1]
                if b - a >= 1 and n >= 20:
                    yield a, b + 1, tuple(w for w, _ in s[a:b + 1])

    first = {}
    for (i, _), s in zip(rows, found):
        for a, _, run in runs(s):
            at = (1 << 63 if i is None else i, a)
            first[run] = min(first.get(run, at), at)
    expected = []
    for (i, _), s in zip(rows, found):
        gone = {k for a, b, run in runs(s) if first[run] != (1 << 63 if i is None else i, a) for k in range(a, b)}
        expected.append((i, len(s), len(gone)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sentence_spans.remove_repeats(df).select("doc_id", "n_sentences", "n_removed").collect()
    same(got, expected)
    assert (20_002, 5, 3) in set(map(tuple, got))


def brute_containment(rows, items, words=5, share=0.8):
    out = []
    for doc_id, text in rows:
        w = decontaminate.words_of(text or "")
        best = {}
        for item_id, item in items:
            v = decontaminate.words_of(item or "")
            k = min(words, len(v))
            if not k:
                continue
            s = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)}
            n = len(s & {tuple(w[i:i + k]) for i in range(len(w) - k + 1)})
            if n and n >= share * len(s) - 1e-9:
                best[item_id] = max(best.get(item_id, (0, 0, 0)), (n / len(s), n, len(s)))
        out += [(doc_id, item_id, n, of) for item_id, (_, n, of) in best.items()]
    return out


def test_decontamination_against_brute_force(spark, docs, rows, empty):
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    w = PASSAGE.split()
    items += [(901, PASSAGE.upper()), (902, " ".join(w[:20])), (903, "two words"), (904, "x"), (905, None), (906, " ,. "), (None, " ".join(w[5:30])),
              (907, " ".join(w[:30] + ["changed"] + w[31:])), (907, "never seen words of an item"), (908, " ".join(x if i % 6 else "zzz" for i, x in enumerate(w)))]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_containment(rows, items)
    assert {(9009, 901), (9009, 907), (9005, 903)} <= {e[:2] for e in expected} and 908 not in {e[1] for e in expected}
    for block in (20_000, 7):  # an item id may stand in two blocks; its best match counts
        got = decontaminate.contained_items(docs, table, block=block)
        assert got.columns == [f.split()[0] for f in decontaminate.FOUND.split(", ")]
        same(got.select("doc_id", "item_id", "n_found", "n_shingles").collect(), expected)
    bad = {e[0] for e in expected}
    kept = decontaminate.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    same(kept.select("doc_id", "text").collect(), [r for r in rows if not (set(x[0] for x in brute_containment([r], items)) & {r[0]})])
    assert bad and decontaminate.contained_items(empty, table).count() == 0
    assert decontaminate.contained_items(docs, table.where("false")).count() == 0
    assert decontaminate.drop_contaminated(docs, table.where("false")).count() == len(rows)


@pytest.fixture
def tiny_skew(spark):
    """Adaptive execution that takes a few KB for a hot partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skew_is_split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_run_is_split(spark, tiny_skew):
    from quillmart.llm.common import cut
    runs = spark.range(60_000).repartition(8).selectExpr("if(id % 3 = 0, id, 7L) AS h1", "if(id % 3 = 0, id, 7L) AS h2", "id AS d", "id AS k1", "0 AS at", "2 AS until")
    later = sentence_spans.later_runs(cut(runs), cut(sentence_spans.first_runs(runs)))
    assert skew_is_split(later) and later.count() == 39_999 + 1 - 1


def test_a_hub_is_split(spark, tiny_skew, monkeypatch):
    from quillmart.llm import graph
    edges = graph.cut(spark.range(1, 60_000).repartition(8).selectExpr("if(id % 3 = 0, id, 0L) AS a", "id + 100000 AS b"))
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = graph.cut(both.groupBy("a").agg(F.min("b").alias("m")))
    assert skew_is_split(both.where("b > a").join(least, "a"))
