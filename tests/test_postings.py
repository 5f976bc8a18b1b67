"""Search from the written index against the scan, and the parts of the index against plain restatements."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.functions.analysis import porter_stem
from larder.operators import postings as p
from larder.operators import search as s

WORDS = "stone river lamp window bread käse relational relate related nationality nations caressed caresses walking walked walks lamps".split()
BOOSTS = {"title": 2.0, "body": 1.0}


def rows():
    rng = random.Random(11)
    made = []
    for i in range(400):
        body = [rng.choice(WORDS) for _ in range(rng.randint(0, 60))]
        if 200 <= i < 212:
            body = ["needle"] * 9 + body[:3]
        elif i % 37 == 0:
            body += ["needle"]
        made.append((i, " ".join(rng.sample(WORDS, 3)) if i % 5 else None, " ".join(body), i % 3))
    return made + [(1000, "", None, 0), (1001, "needle needle", "", 1)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "docs.parquet")
    spark.createDataFrame(rows(), "id long, title string, body string, kind int").coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    bits, p.REGION_BITS = p.REGION_BITS, 4
    p.write(docs, list(BOOSTS), path, attributes=["kind"], buckets=7)
    p.REGION_BITS = bits
    return p.read(spark, path)


def same(a, b, columns=("id", "score")):
    plain = lambda df: sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))
    got = plain(a)
    assert got == plain(b) and got


@pytest.mark.parametrize("text,tie", [("needle", 0.0), ("needle stone", 0.4), ("lamp the river", 0.0), ("käse", 0.4)])
def test_pages(index, docs, text, tie):
    q = p.query(index, text)
    for size, start in ((5, 0), (10, 7), (1000, 0)):
        same(p.search(index, q, BOOSTS, tie, size, start), s.search(docs, text, BOOSTS, tie_breaker=tie, size=size, start=start))
    same(p.total_hits(index, q, BOOSTS), s.total_hits(docs, text, BOOSTS), ["total"])
    same(p.explain_scores(index, q, BOOSTS), s.explain_scores(docs, text, BOOSTS), ["id", "field", "term", "tf", "df", "idf", "score"])


def test_filters_and_all_words(index, docs):
    keep = F.col("kind") == 1
    q = p.query(index, "needle stone")
    same(p.search(index, q, BOOSTS, size=8, where=keep), s.search(docs, "needle stone", BOOSTS, size=8, where=keep))
    same(p.search(index, q, BOOSTS, size=8, all_terms=True), s.search(docs, "needle stone", BOOSTS, size=8, all_terms=True))
    same(p.search(index, q, BOOSTS, size=8, all_terms=True, where=keep), s.search(docs, "needle stone", BOOSTS, size=8, all_terms=True, where=keep))
    same(p.total_hits(index, q, BOOSTS, keep, True), s.total_hits(docs, "needle stone", BOOSTS, where=keep, all_terms=True), ["total"])


@pytest.mark.parametrize("text,prefix", [("neadle lmap", 0), ("neadle lmap", 1), ("walkign relatde", 0), ("walkign relatde", 3), ("kase", 0)])
def test_fuzzy(index, docs, text, prefix):
    q = p.query(index, text, "fuzzy", prefix)
    same(p.search(index, q, BOOSTS, size=500), s.search(docs, text, BOOSTS, size=500, match=lambda w: s.fuzzy(w, prefix)))


@pytest.mark.parametrize("text", ["walks", "relating lamp", "caress national"])
def test_stems(index, docs, text):
    for every in (False, True):
        q = p.query(index, text, "stem")
        got, want = (x.collect() for x in (p.search(index, q, BOOSTS, size=500, all_terms=every), s.search(docs, text, BOOSTS, size=500, stem=True, all_terms=every)))
        assert [tuple(r) for r in got] == [(r.id, r.score) for r in want]


def test_dictionary(index, docs):
    """Every word of every text has its Porter stem, and its document frequency."""
    df = Counter((f, w) for r in docs.collect() for f in BOOSTS for w in set((r[f] or "").split()))
    got = {(r.field, r.term): (r.df, r.stem) for r in index.table("terms").collect()}
    assert got == {k: (n, porter_stem(k[1])) for k, n in df.items()}


def test_regions_are_skipped(index):
    """Of all blocks of the words only those of a few regions are opened for the best page."""
    q = p.query(index, "needle stone")
    blocks = p._blocks(index, q, BOOSTS)
    kept = p.kept_regions(index, q, BOOSTS, 5)
    opened = blocks.join(kept, "region", "left_semi").count()
    assert kept.count() <= 3 and opened * 4 < blocks.count()
    assert p.kept_regions(index, q, BOOSTS, 1000).count() == blocks.select("region").distinct().count()


def test_nothing_found(index):
    for match in ("exact", "fuzzy", "stem"):
        assert p.search(index, p.query(index, "zzzzzzzz", match), BOOSTS).count() == 0
    assert p.search(index, p.query(index, "the"), BOOSTS).count() == 0


def test_more_like_this(index, docs):
    own = F.col("id") == 205
    same(p.typical_terms(index, docs.where(own), "body"), s.typical_terms(docs, "body", own), ["term", "tf", "df", "weight"])
    same(p.more_like_this(index, docs, "body", own), s.more_like_this(docs, "body", own))


def test_empty_table(spark, docs, tmp_path):
    p.write(docs.limit(0), list(BOOSTS), str(tmp_path))
    index = p.read(spark, str(tmp_path))
    assert p.search(index, p.query(index, "needle"), BOOSTS).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


letters = st.text("abc", min_size=1, max_size=14)


@settings(max_examples=600, deadline=None)
@given(letters, letters, st.integers(0, 3))
def test_beginnings_meet(a, b, prefix):
    """Words within two edits, also with a prefix that has to be right, have a shortened beginning in common."""
    if edits(a, b) <= 2 and b.startswith(a[:prefix]):
        assert set(p.beginnings_of(a, 2, prefix)) & set(p.beginnings_of(b, 2))


def test_beginnings_are_the_same_in_spark(spark):
    words = ["a", "ab", "abc", "abcdefgh", "abcdefghij", "aabb", "käse"]
    got = {r.w: set(r.x) for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", p.beginnings(F.col("w")).alias("x")).collect()}
    assert got == {w: set(p.beginnings_of(w, 2)) for w in words}
    assert len(p.beginnings_of("abcdefgh", 2, 3)) < len(p.beginnings_of("abcdefgh", 2))


def test_writing_moves_a_posting_once(spark, tmp_path):
    """Words are counted in their row: only blocks, not (word, document) pairs, are grouped, and without a second shuffle."""
    rows = [(1, ["b", "a", "b"]), (2, []), (3, ["é"] * 4 + ["z"]), (4, None)]
    df = spark.createDataFrame(rows, "id int, words array<string>")
    counted = df.select("id", F.inline(p.word_counts(F.col("words"))))
    assert {tuple(r) for r in counted.collect()} == {(1, "a", 1.0), (1, "b", 2.0), (3, "z", 1.0), (3, "é", 4.0)}
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert len(p.beginnings_of("dictionary", 2)) <= 16
