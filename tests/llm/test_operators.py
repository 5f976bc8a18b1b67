"""Each operator against a restatement of its contract, on awkward rows and on empty tables."""

import collections
import hashlib
import zlib

import cases
import numpy as np
import pytest

from larder.llm import decontaminate, jaccard, packing, pii, quality, repeats, rules, secrets, token_files, warc
from larder.llm import spans as S
from larder.llm.common import new_folder


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """The rows as a table, in several files."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    cases.frame(spark).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return cases.frame(spark, empty=True)


@pytest.fixture(scope="module")
def pairs():
    return [(r[0], r[1]) for r in cases.rows()]


def test_secrets(docs, empty, pairs):
    out = secrets.secrets(docs)
    base = lambda f: [f"{s.kind}:{s.start}:{s.end}" for s in f if s.kind in secrets.BASE_KINDS]
    got = [(r.doc_id, base(r.found)) for r in out.collect()]
    assert cases.in_order(got) == cases.in_order([(i, cases.secrets(t)[1]) for i, t in pairs])
    kinds = collections.Counter(s.kind for r in out.collect() for s in r.found)
    assert kinds["host_token"] == 1 and kinds["jwt"] == 1 and kinds["mixed"] == 1
    assert secrets.secrets(empty).count() == 0


def test_secret_ownership(spark):
    value = "Zx9kQ7wB2rT5yU8iOp3aSdF6gHj"
    rows = [(i, f"see {value} there", f"owner{i % 5}") for i in range(40)] + [(99, f"mine {value[::-1]}", "me")]
    got = {r.doc_id: r.found for r in secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0] == [] and [(s.kind, s.owners, s.live) for s in got[99]] == [("mixed", 1, True)]


def test_secret_values(spark):
    """Only the right side of an assignment has to be long, and it is what copies are counted by."""
    value = "Zx9kQ7wB2rT5yU8iOp3aSdF6gHj"
    texts = [
        "token=abc", "password=x", "api_key=abcdefgh", "secret:'a=b'", "apikey==abcdefg", "PASSWD = =abc passwd=1234567",
        f"token={value}", f"password={value}", f"secret: {value}",
    ]
    rows = [(i, t, f"owner{i}") for i, t in enumerate(texts)]
    got = {r.doc_id: r.found for r in secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [[f"{s.kind}:{s.start}:{s.end}" for s in got[i]] for i in range(len(texts))] == [cases.secrets(t)[1] for t in texts]
    assert [[(s.owners, s.live) for s in got[i]] for i in (6, 7, 8)] == [[(3, False)]] * 3
    assert [s.hash for i in (6, 7, 8) for s in got[i]] == [cases.sha(value)] * 3


def test_secret_in_many_repositories(spark):
    copied, own = "Zx9kQ7wB2rT5yU8iOp3aSdF6gHj", "Qm4nV8cX1zL6kJ3hG9fD2sA7pOi"
    rows = [(i, f"see {copied} there", "hot") for i in range(300)] + [(1000 + i, f"mine {own}", "hot") for i in range(2)]
    got = {r.doc_id: r.found for r in secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] == [] for i in range(300))
    assert [(s.kind, s.owners, s.repositories, s.live) for s in got[1000]] == [("mixed", 1, 2, True)]


def test_personal_data(docs, empty, pairs):
    got = [
        (r.doc_id, [f"{s.kind}:{s.start}:{s.end}" for s in r.pii if s.kind in pii.BASE_KINDS], [s.kind for s in r.pii if s.kind not in pii.BASE_KINDS])
        for r in pii.findings(docs).collect()
    ]
    assert cases.in_order(g[:2] for g in got) == cases.in_order((i, cases.personal(t)[1]) for i, t in pairs)
    added = collections.Counter(k for g in got for k in g[2])
    assert added == {"iban": 2, "ssn": 1, "phone_local": 1}
    assert pii.findings(empty).count() == 0
    assert pii.findings(docs).drop("pii").columns == docs.drop("pii").columns


def test_redaction(docs, empty):
    out = pii.redact(docs)
    assert out.dtypes == docs.dtypes and pii.redact(empty).count() == 0
    texts = {r.doc_id: (r.text, r.n_chars, r.pii) for r in out.collect()}
    mail = texts[21][0]
    assert mail.startswith("mail [EMAIL][EMAIL] ") and "[IP]" in mail and "300.1.1.1" in mail
    assert all(n == len(t or "") and p == "p" for t, n, p in texts.values())
    card = texts[22][0]
    assert card.startswith("card [CARD], [CARD] and 4539148803436468; phone [PHONE] and +12 34; call [PHONE_LOCAL]")


def test_check_sums(spark):
    rows = [("4539148803436467", True), ("4539148803436468", False), ("0", True), ("18", True)]
    df = spark.createDataFrame(rows, "n string, good boolean")
    assert df.where(S.luhn(df.n) != df.good).count() == 0
    rows = [("GB82WEST12345698765432", True), ("GB82WEST12345698765433", False)]
    df = spark.createDataFrame(rows, "n string, good boolean")
    assert df.where(S.mod97(df.n) != df.good).count() == 0


def test_many_matches(spark):
    """Places stay right beyond the blocks in which lengths are summed."""
    text = "".join(f"é{i}a@b.c " for i in range(700))
    r = pii.findings(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [f"{s.kind}:{s.start}:{s.end}" for s in r.pii] == cases.personal(text)[1]


ITEMS = [(1, "the first test item is a sentence of more than ten plain words"), (2, "Short one"), (3, None), (4, " . "), (5, "Short one")]


def contaminated(pairs):
    return pairs + [
        (1000, "He said THE first, test-item is a sentence of more than ten plain words! short: one"),
        (1001, "the first test item is a sentence of more"),
        (1002, "first test item is a sentence of more than ten plain, and so on; the first test item is a sentence of more than"),
    ]


@pytest.mark.parametrize("limit", [decontaminate.BLOCK_CHARS, 20])
def test_decontamination(spark, pairs, limit):
    rows = contaminated(pairs)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.hits(spark.createDataFrame(rows, "doc_id long, text string"), items, limit=limit).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), cases.sha(",".join(sorted(map(str, r["items"])))), r.n_hit > 0) for r in out]
    assert cases.in_order(got) == cases.in_order(cases.hits(rows, ITEMS))
    spans = {r.doc_id: (r.text, r.spans) for r in out}
    text, found = spans[1000]
    assert [text[s.start : s.end] for s in found] == ["THE first, test-item is a sentence of more than ten plain words! short: one"]


def test_decontamination_empty(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.hits(empty, items).count() == 0
    assert decontaminate.hits(docs, items.limit(0)).where("n_hit > 0").count() == 0


def packed(rows, capacity=packing.CAPACITY):
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def encoded(text, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(encoded, "tokenizer"):
        encoded.tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return np.array(encoded.tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_packing(docs, empty, pairs):
    rows = packing.pack(packing.pieces(docs)).collect()
    want = []
    for i, t in pairs:
        ids = encoded(t, 0)
        want += [(i, k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert cases.in_order(got) == cases.in_order(want)
    assert packed(rows) == -(-sum(r.length for r in rows) // 2048)
    assert packing.pack(packing.pieces(empty)).count() == 0


def test_packing_plan():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = rng.integers(1, 60, 200).tolist()
        counts = dict(collections.Counter(lengths))
        plan = packing.plan(counts, 64)
        assert collections.Counter(x for bin_, n in plan for x in bin_ * n) == counts
        assert all(sum(bin_) <= 64 for bin_, _ in plan)
    for _ in range(50):
        counts = dict(collections.Counter(rng.integers(1, 20, 6).tolist()))
        sums = {0}
        for x, n in counts.items():
            for _ in range(n):
                sums |= {s + x for s in sums}
        assert sum(packing.fullest(counts, 40)) == max(s for s in sums if s <= 40)


@pytest.mark.parametrize("text", ["It's A TEST, don't", "naïve ÀÉ ß ÿ Ω Σας ΣΑΣ", "áb <|endoftext|>x", "１２ 12.5 ½ İstanbul ǅ", "tab\tand nbsp　x", "\x00 \x1f\x85", "--== ,,.. !?"])
def test_words_alone_have_the_ids_of_the_text(text):
    from larder.llm.tokens import WordEncoder, vocabulary_path

    assert WordEncoder(vocabulary_path()).encode(text) == encoded(text, 0)[:-1].tobytes()


def test_token_files(spark, docs, empty, pairs):
    folder = new_folder(spark, "tokens")
    token_files.write(docs, folder)
    rows = token_files.checksums(token_files.read(spark, folder)).collect()
    got = [(r.doc_id, r.n_tokens, r.ids_crc32) for r in rows]
    ids = [(i, encoded(t, 2)) for i, t in pairs]
    assert cases.in_order(got) == cases.in_order((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    known = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert known[0] is None and known[1:] == sorted(known[1:])
    plan = token_files.read(spark, folder).where("doc_id = 7").select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "tokens:array" not in plan.split("ReadSchema")[1] and "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)" in plan
    other = new_folder(spark, "tokens")
    token_files.write(empty, other)
    assert token_files.checksums(token_files.read(spark, other)).count() == 0


def test_rules(docs, empty, pairs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = rules.verdicts(docs).collect()
    assert cases.in_order((r.doc_id, *(r[n] for n in names)) for r in rows) == cases.in_order((i, *cases.measures(t)) for i, t in pairs)
    assert not any(r.kept and r.base_failed for r in rows) and any(r.kept for r in rows)
    assert rules.verdicts(empty).count() == 0


def test_host_rates(spark):
    rows = [("good", i % 20 == 0) for i in range(200)] + [("bad", i % 20 != 0) for i in range(200)] + [("small", True), (None, True)]
    got = {r.host: r.rate for r in rules.host_rates(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert got["good"] < 0.1 and got["bad"] > 0.9 and 0.5 < got["small"] < 1 and None not in got


def test_jaccard(docs, empty, pairs):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.joined(docs).collect()]
    assert cases.in_order(got) == cases.in_order(cases.components(pairs))
    assert jaccard.joined(empty).count() == 0


def test_jaccard_tiles(spark, monkeypatch):
    """Chains, near misses and dense groups, with tiles so small that sides are dealt in blocks."""
    monkeypatch.setattr(jaccard, "TILE", 4)
    rng = np.random.default_rng(5)
    rows = []
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(40)]
        for _ in range(25):
            copy = list(words)
            for p in rng.integers(0, 40, rng.integers(0, 4)):
                copy[p] = f"x{rng.integers(1 << 40)}"
            rows.append((len(rows), " ".join(copy)))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(cases.components(rows))


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_repeats(docs, empty, pairs, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    got = [
        (r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256) for r in repeats.repeats(docs).collect()
    ]
    assert cases.in_order(got) == cases.in_order(cases.repeated(pairs))
    assert repeats.repeats(empty).count() == 0


def test_two_stage_sorting():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 3, 26):
        sizes, data = [], b""
        for _ in range(60):
            run = bytes(rng.integers(97, 97 + letters, rng.integers(1, 90)).astype("u1"))
            data += (run + repeats._PAD)[:-1]
            sizes.append(len(run) + 49)
        windows = np.array(sizes) - 49
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = np.repeat(np.cumsum(sizes) - sizes, windows) + nth
        order = repeats.two_stage(np.frombuffer(data, np.uint8), starts, nth == 0, repeats._words(data))
        found = [data[p : p + 50] for p in starts[order]]
        assert sorted(order.tolist()) == list(range(len(starts))) and found == sorted(found)


def test_warc(spark):
    big, other = "é" * 600, "<p>" + "x" * 2000
    rows = [
        (1, "http://a/1", big), (2, "http://a/2 b\r\nc", big), (5, None, big), (5, "http://twice", big), (3, "u", "small"), (4, "u", "small"),
        (None, "http://none", big), (6, "h", None), (7, "h", ""), (8, "h", other), (None, None, "y" * 1500), (None, None, "y" * 1500),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = new_folder(spark, "warc")
    warc.write(warc.records(pages), folder)
    got = warc.read(spark, folder).collect()
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = h == big and i != 5
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None, None if revisit else data))
    assert cases.in_order((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) or (b"" if r.payload is not None else None)) for r in got) == cases.in_order(want)
    heads = warc.read(spark, folder, "page_id long, record_type string, refers_to long").where("record_type = 'revisit' and page_id is not null")
    assert sorted(r.page_id for r in heads.collect()) == [1, 2]
    assert "Filter (" not in heads._jdf.queryExecution().executedPlan().toString()
    none = new_folder(spark, "warc")
    warc.write(warc.records(pages.limit(0)), none)
    assert warc.read(spark, none).count() == 0


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in quality.op9_quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    assert sum(p == y for p, y in held) >= 0.95 * len(held) and len(held) > 50


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    out = quality.classify(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and not np.isnan(r.score) for r in out)
    assert quality.classify(empty, labels).count() == 0
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.keep_good(docs, labels.limit(0)).dtypes == docs.dtypes


def test_quality_is_the_log_density_difference():
    rng = np.random.default_rng(2)
    d = len(quality.FEATURES)
    means = {0: rng.normal(size=d), 1: rng.normal(size=d)}
    covs = {k: np.eye(d) + 0.1 * (a := rng.normal(size=(d, d))) @ a.T for k in (0, 1)}
    model = quality.Discriminant(means, {k: np.linalg.cholesky(c) for k, c in covs.items()}, {0: np.log(0.3), 1: np.log(0.7)})
    x = rng.normal(size=(5, d))
    dens = {k: np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - means[k], np.linalg.inv(covs[k]), x - means[k])) / np.sqrt(np.linalg.det(covs[k])) for k in (0, 1)}
    assert np.allclose(model.scores(x), 0.7 * dens[1] / (0.3 * dens[0] + 0.7 * dens[1]))


def test_links_within_components(spark, docs, pairs):
    """All similar pairs of different sets, also those that one component holds already."""
    base = [f"w{i}" for i in range(80)]
    near = [" ".join(base[:i * 8] + [f"x{i}"] + base[i * 8 + 1 :]) for i in range(1, 8)]
    for df, rows in ((docs, pairs), (spark.createDataFrame(list(enumerate(near)), "doc_id long, text string"), list(enumerate(near)))):
        sets = {frozenset(cases.shingles(t)) for _, t in rows} - {frozenset()}
        least = {s: min(i for i, t in rows if i is not None and cases.shingles(t) == s) for s in sets}
        want = {frozenset((least[a], least[b])) for a in sets for b in sets if a != b and 100 * len(a & b) >= 75 * len(a | b)}
        got = [frozenset((r.doc_a, r.doc_b)) for r in jaccard.links(df).collect()]
        assert want and len(got) == len(want) and set(got) == want
    assert len(want) == 21
