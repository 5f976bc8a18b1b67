from collections import Counter

from pyspark.sql import functions as F

from larder.functions.analysis import analyze, porter_stem
from larder.operators import search
from larder.session import checkpointed

EXAMPLES = dict(
    caresses="caress", ponies="poni", ties="ti", caress="caress", cats="cat", feed="feed", agreed="agre",
    plastered="plaster", bled="bled", motoring="motor", sing="sing", conflated="conflat", troubled="troubl",
    sized="size", hopping="hop", tanned="tan", falling="fall", hissing="hiss", fizzed="fizz", failing="fail",
    filing="file", happy="happi", sky="sky", relational="relat", conditional="condit", rational="ration",
    digitizer="digit", predication="predic", operator="oper", feudalism="feudal", decisiveness="decis",
    hopefulness="hope", callousness="callous", sensibiliti="sensibl", triplicate="triplic", formative="form",
    electrical="electr", goodness="good", revival="reviv", allowance="allow", inference="infer", airliner="airlin",
    adjustable="adjust", replacement="replac", adjustment="adjust", dependent="depend", adoption="adopt",
    activate="activ", effective="effect", probate="probat", rate="rate", cease="ceas", controll="control", roll="roll",
    cooking="cook", cooked="cook", cookies="cooki",
)


def test_published_examples():
    assert {w: porter_stem(w) for w in EXAMPLES} == EXAMPLES
    assert porter_stem("crème") == "crème" and porter_stem("ab") == "ab"


def test_analyzer(spark):
    df = spark.createDataFrame([("The Cooked cookies, and 2 Pies!",), (None,)], "t string")
    rows = df.select(analyze(F.col("t")).alias("s"), analyze(F.col("t"), stem=False).alias("p")).collect()
    assert rows[0]["s"] == ["cook", "cooki", "2", "pi"] and rows[0]["p"] == ["cooked", "cookies", "2", "pies"]
    assert rows[1]["s"] == []


def test_stemmed_search(spark):
    from larder.operators.search import highlight, search_all

    rows = [(1, "cooking rice"), (2, "cooked beans slowly"), (3, "cookies"), (4, None)]
    docs = spark.createDataFrame(rows, "id int, title string")
    hits = {r["id"] for r in search_all(docs, "the cooks", {"title": 1.0}, stem=True).collect()}
    assert hits == {1, 2}
    assert {r["id"] for r in search_all(docs, "cooked", {"title": 1.0}).collect()} == {2}
    marked = docs.where("id = 1").select(highlight(F.col("title"), "RICE coo")).first()[0]
    assert marked == "cooking <em>rice</em>"


def test_index_keeps_its_layout(spark, tmp_path):
    from larder.operators import search

    """An index answers in full whatever the number of folders it was written with."""
    rows = [(i, f"alpha w{i} w{i % 10}") for i in range(50)]
    index = search.build_index(spark.createDataFrame(rows, "id long, title string"), ["title"])
    for buckets in (1, 16):
        path = str(tmp_path / f"index{buckets}")
        search.write_index(index, path, buckets=buckets, slices=2)
        read = search.read_index(spark, path)
        assert search.search_index(read, "alpha", {"title": 1.0}).count() == 50
        assert {r["id"] for r in search.search_index(read, "w17 w49", {"title": 1.0}).collect()} == {17, 49}


def test_index_of_repeated_ids(spark):
    texts = [(1, "alpha beta alpha"), (1, "beta gamma alpha"), (1, "beta"), (2, "delta"), (None, "alpha alpha"), (None, "alpha beta"), (3, None), (4, " - ")]
    index = search.build_index(spark.createDataFrame(texts, "id long, title string"), ["title"])
    words = [(i, len(t.split()), w) for i, t in texts if t and t != " - " for w in t.split()]
    want = Counter(words)
    got = index["postings"].collect()
    assert Counter({(r["id"], r["length"], r["term"]): r["tf"] for r in got}) == want and len(got) == len(want)
    assert {r["term"]: r["df"] for r in index["terms"].collect()} == Counter(w for _, _, w in want)
    assert [tuple(r) for r in index["fields"].collect()] == [("title", 6, 12 / 6)]
    assert index["postings"].dtypes == [("field", "string"), ("term", "string"), ("id", "bigint"), ("length", "int"), ("tf", "bigint")]


def test_index_splits_texts_once(spark, capsys):
    docs = spark.createDataFrame([(i, f"alpha w{i}") for i in range(20)], "id long, title string")
    index = search.build_index(docs, ["title"], cut=checkpointed)
    for name in ("postings", "terms", "fields"):
        index[name].explain()
    assert "regexp_extract_all" not in capsys.readouterr().out
    assert search.search_index(index, "w7", {"title": 1.0}).first()["id"] == 7
