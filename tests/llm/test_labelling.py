import hashlib
import re
import zlib

import numpy as np
import pytest

from quillmart.llm import boosting, pii, quality, toxicity
from tests.llm.conftest import same

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------ personal data
def brute_base(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 14 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.fixture(scope="module")
def pii_model(docs):
    return pii.fit(docs, examples=3000)


def test_base_spans_against_the_plain_patterns(rows):
    import random
    rng = random.Random(2)
    parts = [*"ab@@..--  ++()0123456789_%\u00e9\u0663", "4111111111111111", "1.2.3.4", "255.255.0.1", "+1 (555) 555-1234", "a@b.c", "00"]
    texts = [t or "" for _, t in rows] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    for t in texts:
        assert pii.base_spans(t) == brute_base(t)


def test_selected_spans(pii_model):
    m = pii_model
    text = "write to jane (at) example (dot) org, call (212) 555-0188, or pay with 4111.1111.1111.1111 today; see 1.2.3.4"
    found = {(k, text[a:b]) for k, a, b in m.spans(text)}
    assert ("ip", "1.2.3.4") in found and {k for k, _ in found} >= {"ip", "phone"}
    for clean in ("It was 2021-03-04 when order 1234567 came in.", "nothing here", "in 12, 13, 14, 155 ways", "a 1.234.5678 value", ""):
        assert m.spans(clean) == []
    # Long runs stay linear.
    for long in ("a" * 200_000, "1" * 200_000, "1." * 50_000, "@" * 50_000, "a@b.c " * 20_000, "1 " * 50_000):
        m.spans(long)


@pytest.mark.parametrize("text, values", [
    ("555-123-4567 / 555-987-6543", ["555-123-4567", "555-987-6543"]),
    ("212-555-0188 212-555-0199", ["212-555-0188", "212-555-0199"]),
    ("0301/1234567 - 0301/7654321", ["0301/1234567", "0301/7654321"]),
    ("(212) 555-0188. 24 hours", ["(212) 555-0188"]),
])
def test_neighbouring_numbers(pii_model, text, values):
    proposed = set(pii.proposals(text))
    for v in values:
        assert ("phone", text.index(v), text.index(v) + len(v)) in proposed
    red = pii.redacted(f"call {text}", pii_model.spans(f"call {text}"))
    assert not any(part in red for v in values for part in re.findall("[0-9]{3,}", v))


def test_a_longer_proposal_stands_beside_its_base_span():
    class All:
        def probability(self, x):
            return np.ones(len(x))

    model = pii.PiiModel(All(), dict.fromkeys(pii.KINDS, 0.5))
    text = "to j\u00fcrgen@x.de now"
    assert pii.base_spans(text) == [("email", 5, 14)] and pii.redacted(text, model.spans(text)) == "to [EMAIL] now"


def test_find_and_redact(spark, docs, rows, empty, pii_model):
    got = pii.find(docs, pii_model).collect()
    same([(r["doc_id"], pii.joined([tuple(s) for s in r["base"]])) for r in got],
         [(i, pii.joined(brute_base(t or ""))) for i, t in rows])
    for r in got:
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}
    red = pii.redact(docs, pii_model)
    assert red.columns == docs.columns
    by = {r["doc_id"]: r for r in red.collect()}
    assert by[9012]["text"] == "mail [EMAIL] or [PHONE], [IP], [CARD]." and by[9012]["n_chars"] == len(by[9012]["text"])
    assert by[9001]["text"] is None
    assert pii.find(empty, pii.fit(empty, examples=300)).count() == 0 and pii.redact(empty, pii_model).count() == 0
    assert pii.redacted("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a[IP]f"


def test_digest():
    model = pii.PiiModel(boosting.fit_boosted(np.zeros((0, 30)), np.zeros(0)), dict.fromkeys(pii.KINDS, 2.0))
    text = "x a@b.co 1.2.3.4"
    assert pii.digest(text, model) == (1, 1, 0, 0, hashlib.sha256(b"email:2:8,ip:9:16").hexdigest(), "email:2:8,ip:9:16")


# ----------------------------------------------------------------- samples
def test_samples_are_full_where_few_rows_are_labelled(spark, monkeypatch):
    from pyspark.sql import functions as F
    labels = spark.range(60_000).select(F.col("id").alias("doc_id"), F.expr("if(id % 50 = 0, 1, null)").alias("quality"))
    chosen = []
    monkeypatch.setattr(quality, "smallest_hashes", lambda *a, f=quality.smallest_hashes: chosen.append(f(*a)) or chosen[0])
    docs = labels.selectExpr("doc_id", "'' AS text")
    quality.fit(docs, labels, sample=400)
    ids = [r[0] for r in labels.where("quality = 1").orderBy(F.xxhash64("doc_id")).limit(400).select("doc_id").collect()]
    assert len(ids) == 400 and [r["doc_id"] for r in chosen[0].collect()] == ids


# ---------------------------------------------------------------- boosting
def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    m = boosting.fit_boosted(x[:2000], y[:2000], rounds=40)
    assert ((m.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    one = boosting.fit_boosted(x, np.ones(3000))
    assert (one.probability(x) > 0.99).all()


def test_isotonic_is_monotone_and_calibrated():
    rng = np.random.default_rng(1)
    margin = rng.normal(size=4000)
    y = rng.random(4000) < 1 / (1 + np.exp(-2 * margin))
    f = boosting.fit_isotonic(margin, y)
    grid = f(np.linspace(-3, 3, 200))
    assert (np.diff(grid) >= 0).all() and abs(f(np.array([0.0]))[0] - 0.5) < 0.08
    assert abs(f(margin).mean() - y.mean()) < 0.01


# ---------------------------------------------------------------- toxicity
def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.93
    ones, zeros = ([got[i]["score"] for i in held if truth[i] == v] for v in (1, 0))
    assert np.mean([a > b for a in ones for b in zeros]) > 0.85
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


def test_toxicity_edges(spark, docs, rows, empty):
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1), (None, 1, 1), (3, None, None), (1, 1, 1)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.where("false"), labels.where("toxic = 0")):
        got = toxicity.score(docs, toxicity.fit(docs, table)).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
        assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


def test_toxic_features():
    lex = toxicity.Lexicon([(0, "idiot", 3.0), (4, "veju", 2.0)])
    f = toxicity.features("You are an idiot, vejuxyz! 1d10t i d i o t", lex)
    assert f[4] == 2 and f[7] == 2 and f[3] == 3.0 and f[15] >= 1
    assert toxicity.features("", lex) == [0.0] * toxicity.N_FEATURES
    assert len(f) == toxicity.N_FEATURES


# ----------------------------------------------------------------- quality
def test_second_person_counts_over_the_whole_text():
    lexicon = toxicity.Lexicon([(0, "zonk", 3.0)])
    text = "you " * 1500 + "calm " * 50 + "zonk you " + "calm " * 50 + "zonk " + "calm " * 50 + "you calm zonk"
    assert toxicity.features(text, lexicon)[7] == 2


def brute_statistics(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dups = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    runs = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(i, i + 3)} if len(runs) < 3000 else None
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dups, len(covered) if covered is not None else None)


def test_statistics_against_brute_force(rows):
    for _, t in rows:
        got, expected = quality.statistics(t or "")[:5], brute_statistics(t or "")
        assert got[:4] == expected[:4] and expected[4] in (None, got[4])


def test_quality_rejects_bad_and_keeps_good(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rules = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in quality.judge(docs, rules).collect()}
    good = [r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not got[r["doc_id"]]["base_failed"]]
    bad = [r["doc_id"] for r in labels.collect() if r["quality"] == 0]
    assert np.mean([got[i]["kept"] for i in good]) > 0.985 and np.mean([got[i]["kept"] for i in bad]) < 0.05
    kept = quality.keep_good(docs, rules)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


def test_quality_edges(spark, docs, rows, empty):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.where("false"), labels.where("quality = 1")):
        rules = quality.fit(docs, table)
        got = quality.judge(docs, rules).collect()
        assert len(got) == len(rows) and all(r["base_failed"] for r in got if not r["n_words"])
        assert not any(r["kept"] and r["base_failed"] for r in got)
    rules = quality.fit(empty, labels)
    assert quality.judge(empty, rules).count() == 0 and quality.keep_good(empty, rules).count() == 0


def test_planted_repeats_below_the_base_rule_stand_out(spark):
    import random
    rng = random.Random(9)
    words = ". ".join(" ".join("".join(rng.choice("aeioustnrl") for _ in range(rng.randrange(2, 9))) for _ in range(12)) for _ in range(10))
    sf = "/root/testdata/sf0.1"  # about as many labelled rows as the sample takes
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    planted = [(-1, words + " " + "the same few words " * 24), (-2, words)]
    rules = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(planted, "doc_id long, text string"), rules).collect()}
    assert 40 < 100 * got[-1]["n_repeat_words"] / got[-1]["n_words"] < 50
    assert not got[-1]["base_failed"] and got[-2]["kept"]
    good = quality.judge(docs, rules).join(labels.where("quality = 1"), "doc_id").where("NOT base_failed")
    above = good.selectExpr(f"avg(int(anomaly >= {got[-1]['anomaly']}))").first()[0]
    assert above < 0.01 and got[-2]["anomaly"] < got[-1]["anomaly"] - 0.1


def test_samples_come_from_labelled_documents_that_are_there(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    absent = spark.range(10 ** 6, 10 ** 6 + 500).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "CAST(id % 2 AS INT) AS toxic")
    more = labels.select("doc_id", "quality", "toxic").unionByName(absent)
    known = labels.join(docs.select("doc_id"), "doc_id", "left_semi").select("doc_id", "quality", "toxic")
    for table in (more, known):
        assert quality.fit(docs, table, sample=60).threshold == quality.fit(docs, known, sample=60).threshold


def test_threshold_is_calibrated_on_all_labelled_rows(spark, monkeypatch):
    """Beyond the sampled rows too: each labelled row grows a tree or counts."""
    from pyspark.sql import functions as F
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.expr(
        "concat_ws(' ', transform(sequence(1, 60), i -> concat('w', id, 'x', i, if(id % 3 = 0, '###', ''))))").alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 3 > 0, 1).otherwise(0).alias("quality"))
    seen = []
    monkeypatch.setattr(quality, "calibrate", lambda rows, lost, f=quality.calibrate: seen.append(rows.groupBy("quality").count().collect()) or f(rows, lost))
    rules = quality.fit(docs, labels, sample=100)
    counts = dict(map(tuple, seen[0]))
    assert counts[0] == 300 and 500 <= counts[1] < 600
    kept = quality.judge(docs, rules).where("kept").select(F.pmod("doc_id", F.lit(3)).alias("r")).groupBy("r").count().collect()
    assert sorted(map(tuple, kept)) == [(1, 300), (2, 300)]
