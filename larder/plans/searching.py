"""Registered queries of the text-search group, over the whole texts of the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions.analysis import analyze, tokens
from larder.functions.staging import spread
from larder.lexicon import STOP_WORDS
from larder.operators import search as s
from larder.operators.ingredients import allowed_edits
from larder.plans.corpus import table
from larder.session import checkpointed

QUERY = "ononst ernt thtion"
MISSPELT = "onanst thtien reqq"


def docs(spark, sf_dir):
    """Documents with their first line as title and their last as instructions."""
    lines = F.split("text", "\n")
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("id"),
        F.element_at(lines, 1).alias("title"),
        F.col("text").alias("description"),
        F.col("source").alias("ingredients"),
        F.element_at(lines, -1).alias("instructions"),
        F.col("lang").alias("cuisine_type"),
        "n_chars",
    )


def t1(spark, sf_dir):
    words = docs(spark, sf_dir).select("id", F.explode(tokens(F.col("description"))).alias("term"))
    return words.groupBy("term").agg(F.count("*").alias("n"))


def t1_stemmed(spark, sf_dir):
    d = docs(spark, sf_dir).where("cuisine_type = 'en'")
    return d.select("id", F.size(analyze(F.col("description"))).alias("n_terms"))


def _page(df):
    return df.select("id", "score")


def t2(spark, sf_dir):
    return _page(s.search(docs(spark, sf_dir), QUERY, size=50))


def t2_index(spark, sf_dir):
    """The same scores from a built index: every hit."""
    index = s.build_index(docs(spark, sf_dir), list(s.DEFAULT_BOOSTS), cut=checkpointed)
    index |= {name: checkpointed(index[name]) for name in ("terms", "fields")}
    return s.search_index(index, QUERY, s.DEFAULT_BOOSTS)


def t3(spark, sf_dir):
    return _page(s.search(docs(spark, sf_dir), QUERY, s.TEXT_BOOSTS, size=50))


def t4(spark, sf_dir):
    return _page(s.search(docs(spark, sf_dir), QUERY + " es src3", s.ANY_FIELD_BOOSTS, tie_breaker=0.3, size=50))


def t5(spark, sf_dir):
    boosts = {"title": 3.0, "description": 1.0}
    return _page(s.search(docs(spark, sf_dir), MISSPELT, boosts, match=s.fuzzy, size=50))


def t5_prefix(spark, sf_dir):
    boosts = {"title": 3.0, "description": 1.0}
    return _page(
        s.search(docs(spark, sf_dir), MISSPELT, boosts, match=lambda w: s.fuzzy(w, prefix=2), size=50)
    )


def t6(spark, sf_dir):
    keep = (F.col("cuisine_type") == "en") & (F.col("n_chars") <= 2000)
    return _page(s.search(docs(spark, sf_dir), QUERY, size=50, where=keep))


def t7(spark, sf_dir):
    d = docs(spark, sf_dir)
    total = s.total_hits(d, QUERY).select("total").scalar()
    return _page(s.search(d, QUERY, size=10, start=20)).withColumn("total", total)


def t8(spark, sf_dir):
    d = docs(spark, sf_dir)
    marked = d.withColumn("marked", s.highlight(F.col("description"), QUERY))
    n = F.size(F.split("marked", "<em>")) - 1
    plain = F.replace(F.replace(F.col("marked"), F.lit("<em>"), F.lit("")), F.lit("</em>"), F.lit(""))
    return marked.select("id", n.alias("marks"), (plain == F.col("description")).alias("same_text"))


def t9(spark, sf_dir):
    return s.explain_scores(docs(spark, sf_dir), QUERY, {"title": 1.0, "description": 1.0})


def t24(spark, sf_dir):
    return _page(s.more_like_this(docs(spark, sf_dir), "description", F.col("id") == 1))


def t24_terms(spark, sf_dir):
    return s.typical_terms(docs(spark, sf_dir), "description", F.col("id") == 1)


def q3(spark, sf_dir):
    """All words must occur in title or description; ranked."""
    boosts = {"title": 1.0, "description": 1.0}
    return _page(s.search(docs(spark, sf_dir), "ononst ernt", boosts, size=20, all_terms=True, stem=False))


def q3_stemmed(spark, sf_dir):
    boosts = {"title": 1.0, "description": 1.0}
    return _page(s.search(docs(spark, sf_dir), "reinging heing", boosts, size=20, stem=True, all_terms=True))


_DOCS = """
docs AS (
  SELECT doc_id AS id, string_split(text, chr(10))[1] AS title, text AS description, source AS ingredients,
    string_split(text, chr(10))[-1] AS instructions, lang AS cuisine_type, n_chars FROM documents)
"""
_STOPS = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def _tokens(c: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}]+'), lambda w: NOT list_contains({_STOPS}, w))"
    )


def _scores(query: str, boosts: dict[str, float], test=None, tie: float = 0.0, where: str = "true", docs: str = _DOCS) -> str:
    """CTEs up to `scores(id, score)` and `parts`."""
    terms = s.query_terms(query)
    test = test or (lambda t: f"w = '{t}'")
    words = " UNION ALL ".join(f"SELECT id, '{f}' AS field, {_tokens(f)} AS ws, {boosts[f]} AS boost FROM docs" for f in boosts)
    tf = " UNION ALL ".join(
        f"SELECT id, field, boost, len(ws) AS dl, '{t}' AS term, len(list_filter(ws, lambda w: {test(t)})) AS tf FROM words" for t in terms
    )
    return f"""WITH {docs}, words AS MATERIALIZED ({words}), counted AS MATERIALIZED ({tf}),
    sizes AS (SELECT field, count(*) FILTER (len(ws) > 0)::DOUBLE AS n, sum(len(ws)) / (count(*) FILTER (len(ws) > 0)) AS average FROM words GROUP BY 1),
    dfs AS (SELECT field, term, count(*)::DOUBLE AS df FROM counted WHERE tf > 0 GROUP BY 1, 2),
    parts AS (SELECT id, field, boost, term, tf::DOUBLE AS tf, df, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf,
      ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / average)) AS score
      FROM counted JOIN sizes USING (field) JOIN dfs USING (field, term) WHERE tf > 0 AND id IN (SELECT id FROM docs WHERE {where})),
    per_field AS (SELECT id, field, sum(score) * any_value(boost) AS sc FROM parts GROUP BY 1, 2),
    scores AS (SELECT id, round(max(sc) + {tie} * (sum(sc) - max(sc)), 6) AS score FROM per_field GROUP BY 1)"""


def _fuzzy(prefix: int):
    def test(t: str) -> str:
        # DuckDB counts edits in bytes: stand in one byte for every character the (ASCII) query cannot hold
        plain = "regexp_replace(w, '[^ -~]', '#', 'g')"
        near = f"abs(length(w) - {len(t)}) <= {allowed_edits(t)} AND levenshtein({plain}, '{t}') <= {allowed_edits(t)}"
        return near + (f" AND starts_with(w, '{t[:prefix]}')" if prefix else "")

    return test


def _top(n: int, extra: str = "") -> str:
    return f" SELECT id, score FROM scores ORDER BY score DESC, id LIMIT {n}{extra}"


_MLT_TERMS = f"""
WITH {_DOCS}, words AS MATERIALIZED (SELECT id, {_tokens('description')} AS ws FROM docs),
own AS (SELECT w AS term, count(*) AS tf FROM (SELECT unnest(ws) AS w FROM words WHERE id = 1) GROUP BY 1),
spread AS (SELECT w AS term, count(DISTINCT id) AS df FROM (SELECT id, unnest(ws) AS w FROM words) GROUP BY 1),
best AS (SELECT term, tf, df, round(tf * (1 + ln((SELECT count(*) FROM words WHERE len(ws) > 0)::DOUBLE / (df + 1))), 6) AS weight
  FROM own JOIN spread USING (term) ORDER BY weight DESC, term LIMIT 12)
"""
_MLT = _MLT_TERMS + """,
counted AS (SELECT id, len(ws) AS dl, w AS term, count(*)::DOUBLE AS tf FROM (SELECT id, ws, unnest(ws) AS w FROM words)
  WHERE w IN (SELECT term FROM best) GROUP BY ALL),
sizes AS (SELECT count(*)::DOUBLE AS n, avg(len(ws)) AS average FROM words WHERE len(ws) > 0),
scores AS (SELECT c.id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * c.tf * 2.2 / (c.tf + 1.2 * (0.25 + 0.75 * dl / average))), 6) AS score
  FROM counted c JOIN best USING (term), sizes WHERE c.id <> 1 GROUP BY 1)
SELECT id, score FROM scores ORDER BY score DESC, id LIMIT 10
"""

ENTRIES = {
    "T1_analyzer": (
        t1,
        f"WITH {_DOCS} SELECT term, count(*) AS n FROM (SELECT unnest({_tokens('description')}) AS term FROM docs) GROUP BY 1",
    ),
    "T1_analyzer_stemmed": (
        t1_stemmed,
        f"WITH {_DOCS} SELECT id, len({_tokens('description')})::INT AS n_terms FROM docs WHERE cuisine_type = 'en'",
    ),
    "T2_multi_field": (t2, _scores(QUERY, s.DEFAULT_BOOSTS) + _top(50)),
    "T2_multi_field_from_index": (t2_index, _scores(QUERY, s.DEFAULT_BOOSTS) + " SELECT id, score FROM scores"),
    "T3_text_boosts": (t3, _scores(QUERY, s.TEXT_BOOSTS) + _top(50)),
    "T4_any_field_tie_breaker": (t4, _scores(QUERY + " es src3", s.ANY_FIELD_BOOSTS, tie=0.3) + _top(50)),
    "T5_fuzzy": (t5, _scores(MISSPELT, {"title": 3.0, "description": 1.0}, _fuzzy(0)) + _top(50)),
    "T5_fuzzy_with_prefix": (t5_prefix, _scores(MISSPELT, {"title": 3.0, "description": 1.0}, _fuzzy(2)) + _top(50)),
    "T6_filtered_search": (
        t6, _scores(QUERY, s.DEFAULT_BOOSTS, where="cuisine_type = 'en' AND n_chars <= 2000") + _top(50),
    ),
    "T7_page_and_total": (
        t7,
        _scores(QUERY, s.DEFAULT_BOOSTS)
        + " SELECT id, score, (SELECT count(*) FROM scores) AS total FROM scores ORDER BY score DESC, id LIMIT 10 OFFSET 20",
    ),
    "T8_highlight": (
        t8,
        f"""WITH {_DOCS} SELECT id, len(list_filter(regexp_extract_all(lower(description), '[\\p{{L}}\\p{{N}}]+'),
            lambda w: w IN ('ononst', 'ernt', 'thtion')))::INT AS marks, true AS same_text FROM docs""",
    ),
    "T9_explain": (
        t9,
        _scores(QUERY, {"title": 1.0, "description": 1.0})
        + " SELECT id, field, term, tf, df, round(idf, 6) AS idf, round(score, 6) AS score FROM parts",
    ),
    "T24_more_like_this": (t24, _MLT),
    "T24_typical_terms": (t24_terms, _MLT_TERMS + "SELECT term, tf, df, weight FROM best"),
    "Q3_all_words": (
        q3,
        _scores("ononst ernt", {"title": 1.0, "description": 1.0})
        + """ SELECT id, score FROM scores WHERE id IN (SELECT id FROM parts GROUP BY 1 HAVING count(DISTINCT term) = 2)
             ORDER BY score DESC, id LIMIT 20""",
    ),
    "Q3_stemmed_words": (q3_stemmed, None),
}
