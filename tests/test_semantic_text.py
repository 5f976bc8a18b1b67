"""Search by query text takes whole texts; the default encoder is held against brute force."""

import numpy as np
from pyspark.sql import functions as F

from larder.functions.embedding import HashingEncoder
from larder.operators.vectors import nearest
from larder.plans import semantic
from larder.plans.searching import QUERY


def test_match_after_first_line(spark, tmp_path):
    rows = [(1, f"zzzz\n{QUERY}"), (2, f"{QUERY[:3]}\nzzzz qqqq"), (4, "xx\nxx")]

    def found(query, name, rows):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / name / "documents.parquet"))
        return [r.id for r in query(spark, str(tmp_path / name)).collect()]

    assert found(semantic.v5_text, "first", rows)[0] == 2
    got = found(semantic.v5_whole_text, "whole", [*rows, (3, None), (5, ""), (6, "12\n34")])
    assert got[0] == 1 and sorted(got) == [1, 2, 4]


def test_default_encoder_against_brute_force(spark):
    rng = np.random.default_rng(5)
    words = "thai spicy curry rice lime basil chili coconut bread honey salt".split()
    texts = [(i, " ".join(rng.choice(words, rng.integers(2, 12)))) for i in range(60)]
    query = "spicy thai curry, with coconut"
    made = HashingEncoder().encode([t for _, t in texts] + [query]).astype(float)
    score = made[:-1] @ made[-1]
    want = sorted((-round(float(x), 5), i) for (i, _), x in zip(texts, score))[:10]
    got = semantic.nearest_recipes(spark.createDataFrame(texts, "id long, text string"), query, 60).collect()
    assert sorted((-round(r.score, 5), r.id) for r in got)[:10] == want


def test_recipes_by_title_and_ingredients(spark):
    texts = {r.id: r.text for r in semantic._texts(spark, "/root/testdata/sf0.001").collect()}
    ids = list(texts)
    made = HashingEncoder().encode([texts[i] for i in ids] + [QUERY]).astype(float)
    score = dict(zip(ids, made[:-1] @ made[-1]))
    got = semantic.v5_recipe_text(spark, "/root/testdata/sf0.001").collect()
    best = sorted(score.values(), reverse=True)[: len(got)]
    assert len(got) == 20 and np.allclose([r.score for r in got], best, atol=2e-6)
    assert np.allclose([score[r.id] for r in got], [r.score for r in got], atol=2e-6)


def test_vectors_of_texts_stay_in_python(spark, capsys):
    texts = spark.createDataFrame([(1, "thai curry"), (2, "")], "id long, text string")
    found = semantic.nearest_recipes(texts, "curry", 5)
    found.explain()
    plan = capsys.readouterr().out
    # one step encodes and compares, with no lambda over the values of a vector
    assert plan.count("ArrowEvalPython") == 1 and "lambda" not in plan
    assert [r.id for r in found.collect()] == [1]
    assert semantic.nearest_recipes(texts, "!", 5).collect() == []


def test_vectors_without_a_score_come_last(spark):
    rows = [(1, [0.0, 2.0]), (2, [3.0, 0.0]), (3, None), (4, [1.0, None]), (5, [1.0]), (6, [0.0, 0.0]), (7, [-1.0, 0.0]), (8, [])]
    given = spark.createDataFrame(rows, "id long, embedding array<float>")
    want = [(2, 1.0), (1, 0.0), (7, -1.0), (4, None), (5, None), (6, None), (8, None)]
    one = spark.range(1).select(F.array(F.lit(1.0), F.lit(0.0)).alias("v")).scalar()
    for query in ([1.0, 0.0], F.array(F.lit(1.0), F.lit(0.0)), one):
        got = nearest(given, query, 7)
        assert got.columns == ["id", "embedding", "score"]
        assert [(r.id, r.score) for r in got.collect()] == want


def test_encoder_keeps_words_between_calls():
    encoder, few = HashingEncoder(), HashingEncoder(8)
    few.KNOWN = 2
    texts = ["Thai curry, thai rice", "", None, "a b c d e f", "curry"]
    assert np.array_equal(encoder.encode(texts), np.concatenate([HashingEncoder().encode([t]) for t in texts]))
    assert np.array_equal(few.encode(texts), HashingEncoder(8).encode(texts)) and encoder.encode([]).shape == (0, 384)
