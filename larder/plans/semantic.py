"""Registered queries of the vector, document and post-selection groups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from larder import lexicon
from larder.functions.embedding import LetterEncoder, embed, embedding_text, parse_vector
from larder.operators import cells, posts, search, vectors
from larder.operators import documents as doc
from larder.plans.corpus import bridge, lines, oracle, recipes, table
from larder.plans.searching import QUERY, _scores, docs
from larder.session import checkpointed, shared_folder


def stored_vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _texts(spark, sf_dir):
    names = lines(spark, sf_dir).groupBy("recipe_id").agg(F.array_sort(F.collect_list("name")).alias("names"))
    r = recipes(spark, sf_dir).select("id", "title").join(names, F.col("id") == F.col("recipe_id"), "left")
    return r.select("id", embedding_text(F.col("title"), F.col("names")).alias("text"))


def v1(spark, sf_dir):
    return _texts(spark, sf_dir)


def v2(spark, sf_dir):
    """Encoded titles: dimensions and unit length."""
    e = embed(recipes(spark, sf_dir).select("id", "title"), "title")
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return e.select("id", F.size("embedding").alias("dims"), F.round(norm, 4).alias("norm"))


def v3(spark, sf_dir):
    """Stored are two of three recipes, half of them under an older text."""
    current = recipes(spark, sf_dir).select("id", F.col("title").alias("text"))
    old = F.when(F.col("id") % 2 == 0, F.concat(F.col("text"), F.lit(" old"))).otherwise(F.col("text"))
    stored = current.where("id % 3 <> 0").select("id", F.xxhash64(old).alias("text_hash"), F.array(F.lit(0.0).cast("float")).alias("embedding"))
    return vectors.backfill(current, stored).select("id", "state", F.size("embedding").alias("dims"))


def v3_sync(spark, sf_dir):
    """A sync after which three of five documents keep their vectors; a third of the stored titles has changed."""
    current = _documents(spark, sf_dir).where("NOT malformed")
    older = F.when(F.col("id") % 3 == 0, F.concat("title", F.lit(" old"))).otherwise(F.col("title"))
    stored = current.drop("malformed").where("id % 5 <> 0").withColumn("title", older)
    texts = vectors.document_text(stored).withColumn("text_hash", F.xxhash64("text"))
    known = embed(texts, "text", LetterEncoder).select("id", "text_hash", "embedding")
    synced, made = vectors.sync_with_vectors(stored, current.where("id % 3 = 0 OR id % 5 = 0"), known, LetterEncoder)
    # the fifth letter's share of the vector tells which text was encoded
    return synced.join(made.select("id", "state"), "id").select("id", "title", "state", F.round(F.element_at("embedding", 5).cast("double"), 4).alias("e"))


def _cells(spark, sf_dir):
    """The inverted file of the stored vectors; written once in a session."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _written:
        path = f"{shared_folder(spark)}/cells/{key[0]}-{uuid.uuid4().hex}"
        cells.build_cells(stored_vectors(spark, sf_dir), path)
        _written[key] = path
    return cells.read_cells(spark, _written[key])


_written: dict[tuple[str, str], str] = {}


def v5_cells(spark, sf_dir):
    """Exact, from the cells that can hold one of the ten nearest."""
    query = stored_vectors(spark, sf_dir).where("id = 7").first()["embedding"]  # one row
    return cells.search_cells(_cells(spark, sf_dir), query, 10, exact=True).select("id", "score")


def v5_cells_many(spark, sf_dir):
    """Every twentieth vector is a query for its ten nearest among all; approximate."""
    queries = stored_vectors(spark, sf_dir).where("id % 20 = 0").select(F.col("id").alias("query"), "embedding")
    return cells.search_many(_cells(spark, sf_dir), queries, 10, probes=16)


def v4(spark, sf_dir):
    e = stored_vectors(spark, sf_dir)
    text = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ","), F.lit("]"))
    cut = F.when(F.col("id") % 10 == 3, F.lit("[0.1,0.2]")).when(F.col("id") % 10 == 4, F.replace(text, F.lit("0."), F.lit("x."))).otherwise(text)
    parsed = e.select("id", "embedding", parse_vector(cut, 64).alias("v"))
    return parsed.select("id", (F.col("v") == F.col("embedding")).alias("same"))


def _vector_of(spark, sf_dir, id):
    return stored_vectors(spark, sf_dir).where(F.col("id") == id).select("embedding").scalar()


def v5(spark, sf_dir):
    return vectors.nearest(stored_vectors(spark, sf_dir), _vector_of(spark, sf_dir, 7), 10).select("id", "label", "score")


def v5_approx_recall(spark, sf_dir):
    """Share of the exact ten nearest that the approximate search finds."""
    v = checkpointed(stored_vectors(spark, sf_dir))
    query = v.where("id = 7").first()["embedding"]  # one row
    model, hashed = vectors.fit_hash_tables(v)
    approx = vectors.nearest_approx(model, hashed, query, 10).select("id", F.lit(True).alias("found"))
    exact = vectors.nearest(v, F.array(*[F.lit(float(x)) for x in query]), 10)
    return exact.join(approx, "id", "left").agg((F.count("found") >= 8).alias("recall_ok"), F.count("*").alias("n"))


def v6(spark, sf_dir):
    return vectors.nearest_to(stored_vectors(spark, sf_dir), F.col("id") == 11, 20).select("id", "score")


def v7(spark, sf_dir):
    """Similar to a given vector: the mean vector of one label."""
    e = stored_vectors(spark, sf_dir)
    mean = e.where("label = 3").select(F.posexplode("embedding")).groupBy("pos").agg(F.avg(F.col("col").cast("double")).alias("m"))
    query = mean.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("v")).scalar()
    return vectors.nearest(e, query, 10).select("id", "score")


def v8(spark, sf_dir):
    text = search.search_all(docs(spark, sf_dir), QUERY, search.TEXT_BOOSTS)
    near = vectors.nearest(stored_vectors(spark, sf_dir), _vector_of(spark, sf_dir, 7), 50)
    return vectors.hybrid(text, near, 60)


def _directed(embedded):
    """Texts without any word or letter have a zero vector, which is near to nothing."""
    return embedded.select("id", "embedding").where(F.exists("embedding", lambda x: x != 0))


def _whole_texts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return _directed(embed(d, "text", LetterEncoder))


def v5_whole_text(spark, sf_dir):
    """From a query text to the nearest whole documents."""
    return vectors.semantic_search(_whole_texts(spark, sf_dir), QUERY, 20, LetterEncoder).select("id", "score")


def v8_whole_text(spark, sf_dir):
    """One query text for both halves of the ranking, over whole documents."""
    hits = search.search_all(docs(spark, sf_dir), QUERY, search.TEXT_BOOSTS)
    return vectors.hybrid_search(hits, _whole_texts(spark, sf_dir), QUERY, 60, encoder=LetterEncoder)


def nearest_recipes(texts, query, k):
    """The k recipes (id, text) nearest to a query text, by the default encoder.

    Those without direction have no score and come last, so they can go after the limit; vectors stay in Python.
    """
    return vectors.semantic_search(embed(texts, "text"), query, k).select("id", "score").where("score IS NOT NULL")


def v5_recipe_text(spark, sf_dir):
    """From a query text to the nearest recipes by title and ingredient names."""
    return nearest_recipes(_texts(spark, sf_dir), QUERY, 20)


# --- documents ---------------------------------------------------------------------------------------------
def _doc_lines(spark, sf_dir):
    b = bridge(spark, sf_dir)
    long_name = F.when(F.col("recipe_id") % 50 == 3, F.rpad("name", 120, "x"))
    name = F.when((F.col("order_index") == 3) & (F.col("recipe_id") % 7 == 2), F.lit(None)).otherwise(F.coalesce(long_name, F.col("name")))
    order = F.struct("order_index", F.col("name").alias("n"), F.col("quantity").alias("q"), "line_tie").alias("order")
    return b.select("recipe_id", order, name.alias("name"), "quantity", "unit", "notes")


def _doc_recipes(spark, sf_dir):
    step = F.when(F.col("id") % 61 == 5, F.array(F.lit(lexicon.NO_STEPS_TEXT))).otherwise(F.col("instructions"))
    return recipes(spark, sf_dir).withColumn("instructions", step)


def _documents(spark, sf_dir):
    return doc.build_documents(_doc_recipes(spark, sf_dir), _doc_lines(spark, sf_dir), "order")


def d1(spark, sf_dir):
    d = _documents(spark, sf_dir)
    shown = F.transform(
        "ingredients",
        lambda i: F.concat_ws("/", i["name"], i["quantity"].cast("int").cast("string"), i["unit"], F.coalesce(i["notes"], F.lit("-"))),
    )
    return d.select(
        "id", "title", "malformed", F.array_join("instructions", " | ").alias("instructions"), F.array_join(shown, ";").alias("ingredients")
    )


def d2(spark, sf_dir):
    return doc.sync_counts(_documents(spark, sf_dir))


def d3(spark, sf_dir):
    r, n = _doc_recipes(spark, sf_dir), _doc_lines(spark, sf_dir)
    stored = doc.build_documents(r.where("id % 5 <> 0").withColumn("title", F.lit("old")), n, "order").where("NOT malformed").drop("malformed")
    recent = doc.changed_since(r, F.to_timestamp(F.lit("1999-01-01")))
    changed = doc.build_documents(recent, n.join(recent.select(F.col("id").alias("recipe_id")), "recipe_id", "left_semi"), "order")
    return doc.sync_documents(stored, changed).select("id", "title", F.size("ingredients").alias("n"))


# --- post selection ------------------------------------------------------------------------------------------
def submissions(spark, sf_dir):
    """Documents as submissions: the author is a role, so that comments of the same conversation match."""
    k = F.col("doc_id")
    role = F.element_at(F.array(F.lit("user"), F.lit("assistant"), F.lit("system"), F.lit(None).cast("string")), (k % 4 + 1).cast("int"))
    text = F.when(k % 3 == 0, F.concat(F.lit("Ingredients below. "), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        k.alias("id"), F.concat_ws(" ", F.lit("Post"), (k % 50).cast("string")).alias("title"), role.alias("author"), (k % 5 != 1).alias("is_self"),
        text.alias("selftext"), (k % 30).alias("num_comments"), (k * 3600 + 1_600_000_000.5).alias("created_utc"),
    )


def comments(spark, sf_dir):
    word = F.element_at(F.array(*[F.lit(w) for w in ["", " Total Time 5", " SERVINGS", ""]]), (F.col("turn") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("submission_id"), F.col("turn").alias("position"), F.col("role").alias("author"),
        F.concat("text", word).alias("body"),
    )


def p1_p2(spark, sf_dir):
    selected = posts.select_recipe_posts(submissions(spark, sf_dir), comments(spark, sf_dir))
    return posts.to_posts(selected).select(
        "date", "num_comments", "title", "user", "n_char", F.md5("comment").alias("comment_md5")
    )


def p3(spark, sf_dir):
    s = submissions(spark, sf_dir).where("author IS NOT NULL").withColumnRenamed("author", "user")
    history = s.where("id % 7 = 3").select("title", "user")
    return posts.unseen(s, history, "id").select("id", "title", "user")


def p3_new(spark, sf_dir):
    """Titles by number: those of the history are left out, of the others each comes once."""
    s = submissions(spark, sf_dir).withColumnRenamed("author", "user").withColumn("title", F.concat_ws(" ", F.lit("Post"), F.floor(F.col("id") / 3).cast("string")))
    return posts.unseen(s.where("user IS NOT NULL"), s.where("id % 7 = 3 AND user IS NOT NULL").select("title", "user"), "id").select("id", "title", "user")


def p4(spark, sf_dir):
    return posts.newest(submissions(spark, sf_dir)).select("id", "title", "created_utc")


# --- SQL -----------------------------------------------------------------------------------------------------
_COS = "round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST({} AS DOUBLE[])), 6)"
_V7 = "(SELECT embedding FROM embeddings WHERE vec_id = 7)"

# counts of letters, scaled to unit length in single precision as the encoder does
_LETTERS = "[" + ", ".join(f"(length(t) - length(replace(t, '{chr(c)}', '')))::FLOAT" for c in range(97, 123)) + "]"
_UNIT = "list_transform({0}, lambda x: (x / CAST(sqrt(list_sum(list_transform({0}, lambda y: y::DOUBLE * y))) AS FLOAT))::DOUBLE)"
_WHOLE_NEAR = f"""
letters AS (SELECT id, {_LETTERS} AS v FROM (
  SELECT doc_id AS id, lower(text) AS t FROM documents UNION ALL SELECT NULL, lower('{QUERY}'))),
units AS (SELECT id, {_UNIT.format('v')} AS u FROM letters),
near AS (SELECT id, round(list_cosine_similarity(u, (SELECT u FROM units WHERE id IS NULL)), 6) AS sim FROM units WHERE id IS NOT NULL
  AND list_sum(u) > 0)"""

_DOC_CTES = f"""
doc_lines AS (
  SELECT recipe_id, order_index, name AS n, quantity, line_tie, unit, notes,
    CASE WHEN order_index = 3 AND recipe_id % 7 = 2 THEN NULL WHEN recipe_id % 50 = 3 THEN rpad(name, 120, 'x') ELSE name END AS name FROM bridge),
doc_recipes AS (SELECT * REPLACE (CASE WHEN id % 61 = 5 THEN ['{lexicon.NO_STEPS_TEXT}'] ELSE instructions END AS instructions) FROM recipes),
doc_nested AS (
  SELECT recipe_id, count(*) AS n_all, count(name) AS n_kept,
    string_agg(concat_ws('/', name, CAST(quantity AS INT), unit, coalesce(notes, '-')), ';'
      ORDER BY order_index, n, quantity, line_tie, unit, coalesce(notes, '')) FILTER (name IS NOT NULL) AS ingredients
  FROM doc_lines GROUP BY 1),
doc_rows AS (
  SELECT r.*, n_all IS NULL OR id % 61 = 5 AS malformed, coalesce(n.ingredients, '') AS shown,
    coalesce(n_kept, 0)::INT AS n_kept FROM doc_recipes r LEFT JOIN doc_nested n ON id = recipe_id)
"""
_SUBMISSIONS = """
submissions AS (
  SELECT doc_id AS id, 'Post ' || (doc_id % 50) AS title, ['user', 'assistant', 'system', NULL][doc_id % 4 + 1] AS author,
    doc_id % 5 <> 1 AS is_self, CASE WHEN doc_id % 3 = 0 THEN 'Ingredients below. ' || text ELSE text END AS selftext,
    doc_id % 30 AS num_comments, doc_id * 3600 + 1600000000.5::DOUBLE AS created_utc FROM documents),
comments AS (
  SELECT conv_id AS submission_id, turn AS position, role AS author,
    text || ['', ' Total Time 5', ' SERVINGS', ''][turn % 4 + 1] AS body FROM conversations)
"""


def _any(c, words):
    return "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"


_P1 = f"""
WITH {_SUBMISSIONS},
own AS (SELECT submission_id, author, arg_min(body, position) AS body FROM comments WHERE {_any('body', lexicon.COMMENT_WORDS)} GROUP BY 1, 2),
picked AS (
  SELECT s.*, coalesce(CASE WHEN is_self AND {_any('selftext', lexicon.SELF_POST_WORDS)} THEN selftext END, body) AS recipe_text
  FROM submissions s LEFT JOIN own o ON o.submission_id = s.id AND o.author = s.author WHERE s.author IS NOT NULL)
SELECT strftime(to_timestamp(floor(created_utc)) AT TIME ZONE 'UTC', '%Y-%m-%d') AS date, num_comments::INT AS num_comments, title, author AS "user",
  length(recipe_text)::INT AS n_char, md5(recipe_text) AS comment_md5 FROM picked WHERE recipe_text IS NOT NULL
"""

ENTRIES = {
    "V1_embedding_text": (
        v1,
        oracle(
            """SELECT id, CASE WHEN names IS NULL THEN title ELSE title || '. ' || names END AS text FROM recipes LEFT JOIN
               (SELECT recipe_id, string_agg(name, ', ' ORDER BY name) AS names FROM lines GROUP BY 1) ON id = recipe_id"""
        ),
    ),
    "V2_encode": (v2, oracle("SELECT id, 384 AS dims, 1.0::DOUBLE AS norm FROM recipes")),
    "V3_backfill": (
        v3,
        oracle(
            """SELECT id, CASE WHEN id % 3 <> 0 AND id % 2 <> 0 THEN 'kept' ELSE 'encoded' END AS state,
               CASE WHEN id % 3 <> 0 AND id % 2 <> 0 THEN 1 ELSE 384 END AS dims FROM recipes"""
        ),
    ),
    "V3_vectors_follow_sync": (
        v3_sync,
        oracle(
            f"""SELECT id, title, CASE WHEN id % 3 = 0 OR id % 5 = 0 THEN 'encoded' ELSE 'kept' END AS state,
                 round(({_UNIT.format(_LETTERS)})[5], 4) AS e
                FROM (SELECT id, title, lower(title || coalesce(names, '')) AS t FROM doc_rows LEFT JOIN
                  (SELECT recipe_id, string_agg(name, '') AS names FROM doc_lines GROUP BY 1) ON id = recipe_id WHERE NOT malformed)""",
            _DOC_CTES,
        ),
    ),
    "V4_parse_vector": (
        v4, "SELECT vec_id AS id, CASE WHEN vec_id % 10 NOT IN (3, 4) THEN true END AS same FROM embeddings",
    ),
    "V5_semantic_top_k": (
        v5,
        f"SELECT vec_id AS id, label, {_COS.format(_V7)} AS score FROM embeddings ORDER BY score DESC, id LIMIT 10",
    ),
    "V5_nearest_from_cells": (
        v5_cells, f"SELECT vec_id AS id, {_COS.format(_V7)} AS score FROM embeddings ORDER BY score DESC, id LIMIT 10",
    ),
    # approximate, so beyond SQL: tests hold recall and a search of all cells against brute force
    "V5_many_from_cells": (v5_cells_many, None),
    "V5_approximate_recall": (v5_approx_recall, "SELECT true AS recall_ok, 10::BIGINT AS n FROM (SELECT count(*) FROM embeddings)"),
    "V6_similar_to_stored": (
        v6,
        f"""SELECT vec_id AS id, {_COS.format('(SELECT embedding FROM embeddings WHERE vec_id = 11)')} AS score
            FROM embeddings WHERE vec_id <> 11 ORDER BY score DESC, id LIMIT 20""",
    ),
    "V7_similar_to_given": (
        v7,
        f"""WITH mean AS (SELECT list(m ORDER BY pos) AS v FROM (SELECT pos, avg(x::DOUBLE) AS m FROM
              (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings WHERE label = 3) GROUP BY 1))
            SELECT vec_id AS id, {_COS.format('(SELECT v FROM mean)')} AS score FROM embeddings ORDER BY score DESC, id LIMIT 10""",
    ),
    "V8_hybrid": (
        v8,
        _scores(QUERY, search.TEXT_BOOSTS)
        + f""", near AS (SELECT vec_id AS id, {_COS.format(_V7)} AS sim FROM embeddings ORDER BY sim DESC, id LIMIT 50)
            SELECT id, round(coalesce(score, 0) + 0.5 * coalesce((1 + sim) / 2, 0), 6) AS score
            FROM scores FULL OUTER JOIN near USING (id) ORDER BY score DESC, id LIMIT 60""",
    ),
    "V5_whole_text": (v5_whole_text, f"WITH {_WHOLE_NEAR} SELECT id, sim AS score FROM near ORDER BY score DESC, id LIMIT 20"),
    "V8_whole_text": (
        v8_whole_text,
        _scores(QUERY, search.TEXT_BOOSTS)
        + f""", {_WHOLE_NEAR}, best AS (SELECT * FROM near ORDER BY sim DESC, id LIMIT 50)
            SELECT id, round(coalesce(score, 0) + 0.5 * coalesce((1 + sim) / 2, 0), 6) AS score
            FROM scores FULL OUTER JOIN best USING (id) ORDER BY score DESC, id LIMIT 60""",
    ),
    # the default encoder cannot be stated in SQL; a test holds the query against brute force
    "V5_recipe_text": (v5_recipe_text, None),
    "D1_build_documents": (
        d1,
        oracle(
            "SELECT id, title, malformed, array_to_string(instructions, ' | ') AS instructions, shown AS ingredients FROM doc_rows",
            _DOC_CTES,
        ),
    ),
    "D2_malformed_counts": (
        d2,
        oracle(
            """SELECT count(*) AS total, count(*) FILTER (NOT malformed) AS success, count(*) FILTER (malformed) AS skipped
               FROM doc_rows""",
            _DOC_CTES,
        ),
    ),
    "D3_incremental_sync": (
        d3,
        oracle(
            """SELECT id, CASE WHEN updated_at > TIMESTAMP '1999-01-01' THEN title ELSE 'old' END AS title, n_kept AS n
               FROM doc_rows WHERE NOT malformed AND (id % 5 <> 0 OR updated_at > TIMESTAMP '1999-01-01')""",
            _DOC_CTES,
        ),
    ),
    "P1_P2_select_posts": (p1_p2, _P1),
    "P3_unseen": (
        p3,
        f"""WITH {_SUBMISSIONS}, known AS (SELECT * FROM submissions WHERE author IS NOT NULL)
            SELECT min(id) AS id, title, author AS "user" FROM known
            WHERE title || '_' || author NOT IN (SELECT title || '_' || author FROM known WHERE id % 7 = 3) GROUP BY 2, 3""",
    ),
    "P3_unseen_titles": (
        p3_new,
        f"""WITH {_SUBMISSIONS}, known AS (SELECT id, 'Post ' || (id // 3) AS title, author FROM submissions WHERE author IS NOT NULL)
            SELECT min(id) AS id, title, author AS "user" FROM known
            WHERE title || '_' || author NOT IN (SELECT title || '_' || author FROM known WHERE id % 7 = 3) GROUP BY 2, 3""",
    ),
    "P4_newest": (
        p4, f"WITH {_SUBMISSIONS} SELECT id, title, created_utc FROM submissions ORDER BY created_utc DESC, id DESC LIMIT 25",
    ),
}
