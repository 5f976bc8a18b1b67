"""The stages of the pipeline against plain restatements, each on what the one before kept."""

import random
import zlib

import cases
import numpy as np
from test_operators import ITEMS, contaminated, encoded, packed

import __spark_entry__ as entry
import corpus_pipeline
from larder.llm import quality
from larder.llm.common import cut


def test_registered():
    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert names == [f"op{n}" for n in range(1, 14)] and "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard", "decontamination", "pii", "packing"]


def test_stages(spark, tmp_path):
    sf = str(tmp_path)
    rows = [(*r, "extra") for r in cases.rows()]
    rows += [(i, t, *rows[0][2:]) for i, t in contaminated([])]
    docs = spark.createDataFrame(rows, cases.SCHEMA + ", n_hit string")
    docs.write.parquet(f"{sf}/documents.parquet")
    # one class only: its probability is one, so all stay
    spark.createDataFrame([(3, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    pairs = lambda df: cases.in_order((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    kinds = docs.dtypes

    good = cut(stages["quality_classifier"](spark, docs, sf))
    assert good.dtypes == kinds and pairs(good) == pairs(docs)

    single = cut(stages["ngram_jaccard"](spark, good, sf))
    before = pairs(good)
    # every row an id of its own; of a group the smallest doc_id stays, whichever of its equal rows
    groups = cases.components(list(enumerate(t for _, t in before)))
    members = {}
    for (nth, _, group), (doc_id, text) in zip(groups, before):
        members.setdefault(group, []).append((doc_id is None, doc_id, text))
    want = [min(m, key=lambda x: (x[0], x[1] or 0)) for m in members.values()]
    assert single.dtypes == kinds
    assert cases.in_order((w[1],) for w in want) == cases.in_order((i,) for i, _ in pairs(single))

    clean = cut(stages["decontamination"](spark, single, sf))
    hits = cases.hits(pairs(single), ITEMS)
    assert clean.dtypes == kinds and any(h[2] for h in hits)
    assert [i for i, _ in pairs(clean)] == [h[0] for h in hits if not h[2]]

    private = cut(stages["pii"](spark, clean, sf))
    assert private.dtypes == kinds
    for (i, old), (j, new) in zip(pairs(clean), pairs(private)):
        assert i == j and (old == new or sum(cases.personal(old)[0]) or "[" in new)
        assert not sum(cases.personal(new)[0])

    sequences = stages["packing"](spark, private, sf).collect()
    packed(sequences)
    ids = cases.in_order((r.doc_id, r.piece, r.length, r.ids_crc32) for r in sequences)
    want = []
    for i, t in pairs(private):
        x = encoded(t, 0)
        want += [(i, k, len(x[a : a + 2048]), zlib.crc32(x[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(x), 2048))]
    assert ids == cases.in_order(want)
    assert len(corpus_pipeline.run(spark, sf).collect()) == len(sequences)


def test_classifier_stage_drops_rows(spark, tmp_path):
    """Two classes: what goes is what a plain restatement of fit and score rejects."""
    sf = str(tmp_path)
    rng = random.Random(5)
    good = ["The " + " ".join(rng.choice("river stone lamp window bread of and".split()) for _ in range(40 + i)) + "." for i in range(60)]
    bad = [" ".join(rng.choice("# $$$ *** BUY!!! 123 | <a>".split()) for _ in range(8 + i)) for i in range(60)]
    texts = [x for pair in zip(good, bad) for x in pair] + [None, ""]
    rows = [(i, t, "x", i, "y", 0.5) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, statistics string, row int, score string, label double").write.parquet(f"{sf}/documents.parquet")
    labels = [(i, 1 - i % 2) for i in range(100)]
    spark.createDataFrame([(*r, 0) for r in labels], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    assert kept.dtypes == docs.dtypes

    x = np.array([quality.statistics(t or "") for t in texts])
    known = [(x[i], k) for i, k in labels if zlib.crc32(str(i).encode()) % 5]
    parts = {k: np.array([v for v, own in known if own == k]) for k in (0, 1)}
    n, d = len(known), x.shape[1]
    center = {k: v.mean(axis=0) for k, v in parts.items()}
    pooled = sum((v - center[k]).T @ (v - center[k]) for k, v in parts.items()) / n
    logs = {}
    for k, v in parts.items():
        own = max(quality.SHRINK, (d + 1) / (len(v) + d + 1))
        cov = (1 - own) * np.cov(v.T, bias=True) + own * pooled
        cov = (1 - quality.RIDGE) * cov + quality.RIDGE * np.diag(np.diag(pooled)) + 1e-4 * np.eye(d)
        far = np.einsum("ij,jk,ik->i", x - center[k], np.linalg.inv(cov), x - center[k])
        logs[k] = np.log(len(v) / n) - 0.5 * far - 0.5 * np.linalg.slogdet(cov)[1]
    score = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    want = {i for i, s in enumerate(score) if s >= quality.THRESHOLD}
    assert {r.doc_id for r in kept.collect()} == want and 50 < len(want) < 90
    made = {r.doc_id: r.score for r in quality.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert all(abs(made[i] - s) < 1e-6 for i, s in enumerate(score))


def test_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    cases.frame(spark, empty=True).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
