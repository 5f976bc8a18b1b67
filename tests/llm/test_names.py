"""Columns whose names the operators use inside pass through."""

import cases

from larder.llm import decontaminate, packing
from test_operators import ITEMS, contaminated

NAMES = ["_row", "_items", "_runs", "_in", "_text", "_id", "_slice", "_plan", "_nth", "_hit", "_length", "_n", "_before", "_rank"]


def test_decontamination(spark):
    texts = contaminated([]) + [(900, None), (901, "")]
    rows = [(i, t, *[f"{n}{i}" for n in NAMES]) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in NAMES))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    one, many = (decontaminate.hits(docs, bench, limit=limit) for limit in (decontaminate.BLOCK_CHARS, 60))
    plain = lambda df: cases.in_order(str((r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.spans, *[r[n] for n in NAMES])) for r in df.collect())
    assert one.columns == many.columns == [*docs.columns, "n_words", "n_hit", "items", "spans"]
    assert plain(one) == plain(many) and any(r.n_hit for r in many.collect())
    assert all(r[n] == f"{n}{r.doc_id}" for r in many.collect() for n in NAMES)


def test_packing(spark):
    rows = [(i, 1 + i * 37 % 90, *[f"{n}{i}" for n in NAMES]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, size long, " + ", ".join(f"{n} string" for n in NAMES)).repartition(4)
    out = packing.pack(df, "size", 100).collect()
    assert len(out) == 300 and all(r[n] == f"{n}{r.doc_id}" for r in out for n in NAMES)
    ends = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.size
    assert max(ends.values()) <= 100
