"""The pipeline's stages against brute force on the small documents."""

import __spark_entry__ as E
import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from quillmart.llm import pii, quality
from tests.llm.test_duplicates import brute_components, brute_containment, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    q = E.queries()
    assert "pipeline" in q and all(any(n.startswith(f"op{i}_") for n in q) for i in range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rules = quality.fit(docs, labels)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    stats = {i: quality.statistics(t or "") for i, t in texts}
    good = [(i, t) for i, t in texts if not quality.failed_base([stats[i]])[0] and not rules.rejects([stats[i]])[0]]
    fps = {i: brute_fingerprint(t) for i, t in good}
    of = brute_components(fps.values(), 2)
    best = {}
    for i in fps:
        best[of[fps[i]]] = min(best.get(of[fps[i]], i), i)
    single = [(i, t) for i, t in good if best[of[fps[i]]] == i]
    bad = {r[0] for r in brute_containment(single, items)}
    clean = {i: t for i, t in single if i not in bad}
    stages = dict(corpus_pipeline.STAGES)
    step = docs
    for name, expected in (("quality rules", {i for i, _ in good}), ("SimHash near-dedup", {i for i, _ in single}),
                           ("benchmark decontamination", set(clean))):
        step = stages[name](spark, step, SF)
        assert step.columns == docs.columns and {r["doc_id"] for r in step.collect()} == expected
    assert len(clean) < len(texts) and len(clean) > 0.5 * len(texts)
    redacted = stages["personal data"](spark, step, SF)
    assert redacted.columns == docs.columns
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {}
    for r in redacted.collect():
        base = pii.base_spans(clean[r["doc_id"]])
        assert not pii.base_spans(r["text"]) and (bool(base) or r["text"] == clean[r["doc_id"]]) and r["n_chars"] == len(r["text"])
        tokens[r["doc_id"]] = len(t.encode(r["text"], add_special_tokens=False).ids) + 1
    packed = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["length"]
    assert packed == tokens


def test_stages_with_edge_rows(spark, docs, rows, empty):
    """Null ids and texts, empty and long texts, repeated rows, clashing names."""
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
    kept = kept.cache()
    texts = [r["text"] for r in kept.collect()]
    assert all(t and t.strip() for t in texts) and len(texts) == len(set(texts))
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert packed.selectExpr("sum(length)").first()[0] > 0 and kept.select("__k1").distinct().count() == 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
