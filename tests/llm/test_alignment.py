"""Token alignment against a restatement by whole-text encoding and sets."""

import collections
import hashlib

import cases
import pytest
import sentencepiece
from tokenizers import Tokenizer

from larder.llm import alignment
from larder.llm.tokens import _byte_letters, vocabulary_path

BYTE_OF = {c: b for b, c in enumerate(_byte_letters())}


@pytest.fixture(scope="module")
def tokens_of():
    a = Tokenizer.from_file(vocabulary_path(alignment.A_VOCABULARY))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(alignment.B_VOCABULARY))

    def of(text):
        if not text:
            return [], []
        left = [(i, bytes(BYTE_OF[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (left, right) if all(b"".join(x for _, x in side) == want for side in (left, right)) else ([], [])

    return of


def groups_of(left, right):
    """Lists of (A ids, B ids), cut where both sides end."""
    ends = []
    for side in (left, right):
        at, own = 0, []
        for _, x in side:
            at += len(x)
            own.append(at)
        ends.append(own)
    cuts = sorted(set(ends[0]) & set(ends[1]))
    made = [([], []) for _ in cuts]
    for k, side in enumerate((left, right)):
        g = 0
        for (i, _), e in zip(side, ends[k]):
            while e > cuts[g]:
                g += 1
            made[g][k].append(i)
    return made


def brute(rows, tokens_of):
    docs = [(i, groups_of(*tokens_of(t))) for i, t in rows]
    links = [[(a, b) for x, y in groups for a in x for b in y] for _, groups in docs]
    count = collections.Counter(p for own in links for p in set(own))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (i, groups), own in zip(docs, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(own),
                sum(count[p] == best[p[0]] for p in own), sum(count[p] for p in own),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return cases.in_order(out)


AWKWARD = [
    "a  b", " lead", "trail ", "\n", " ", "\t\t", "a\n b", "a \nb", "x\n  y", "x \n y", "\n x", "a   b", "a\x1c \x1cb", "don't we're",
    "a▁b plain", "<|endoftext|> and <s> <unk> <0x41>", "漢字 かな 한국어", "é ﬁ Å", "😀 👩‍👩‍👧", "0123456789" * 30, "#" * 200, "x \r\n y\r\nz",
    "zq" * 4000, "aaaa" * 3000 + " " + "=" * 500,
]


def rows():
    made = [(i, t) for i, t, *_ in cases.rows()]
    return made + [(1000 + k, t) for k, t in enumerate(AWKWARD)] + [(1000, AWKWARD[0])]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    extra = [(i, t, "x", 1, "y") for i, t in rows()]
    spark.createDataFrame(extra, "doc_id long, text string, block string, pair int, digest string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_counts(docs, tokens_of):
    got = cases.in_order(tuple(r) for r in alignment.link_counts(docs).collect())
    want = brute(rows(), tokens_of)
    assert got == want
    assert sum(r[1] > 0 for r in want) > 40 and any(r[1] == 0 and r[7] == "" for r in want)


def test_small_blocks_and_segments(docs, tokens_of, monkeypatch):
    """Cuts of texts, calls and blocks change nothing."""
    texts = [(i, t or "") for i, t in rows()]
    paths = tuple(map(vocabulary_path, (alignment.A_VOCABULARY, alignment.B_VOCABULARY)))
    plain = list(alignment._measured(texts, paths))
    monkeypatch.setattr(alignment, "SEGMENT", 3)
    monkeypatch.setattr(alignment, "TOKENS", 40)
    monkeypatch.setattr(alignment, "BLOCK", 500)
    monkeypatch.setattr(alignment, "_WIDE", 2)
    monkeypatch.setattr(alignment, "_CACHE", 50)
    cut = list(alignment._measured(texts, paths))
    assert len(plain) == 1 and len(cut) > 5
    for name in plain[0].rows:
        assert [v for b in cut for v in b.rows[name]] == plain[0].rows[name]
    total = lambda blocks: sum(int(n.sum()) for b in blocks for n in b.counts)
    assert total(cut) == total(plain) == sum(plain[0].rows["n_links"])


def test_tokens_and_overlaps(docs, tokens_of):
    texts = dict(rows())
    for r in alignment.align(docs).collect():
        left, right = tokens_of(texts[r.doc_id])
        assert [x.id for x in r.a] == [i for i, _ in left] and [x.id for x in r.b] == [i for i, _ in right]
        spans = [list(zip([0, *[x.end for x in side]], [x.end for x in side])) for side in (r.a, r.b)]
        owner = [j for j, (low, high) in enumerate(spans[1]) for _ in range(low, high)]  # by byte
        want = {(i, owner[k]) for i, (low, high) in enumerate(spans[0]) for k in range(low, high)}
        assert {(x.a, x.b) for x in r.overlaps} == want
        groups = collections.defaultdict(lambda: ([], []))
        for k, side in enumerate((r.a, r.b)):
            for x in side:
                groups[x.group][k].append(x.id)
        assert [groups[g] for g in sorted(groups)] == groups_of(left, right)


def test_empty_tables(spark, docs):
    assert alignment.link_counts(docs.limit(0)).count() == 0 and alignment.align(docs.limit(0)).count() == 0
    only = spark.createDataFrame([(1, None), (None, ""), (2, "a▁b")], "doc_id long, text string")
    assert cases.in_order(tuple(r) for r in alignment.link_counts(only).collect()) == cases.in_order(
        (i, 0, 0, 0, 0, 0, 0, "") for i in (1, None, 2)
    )
