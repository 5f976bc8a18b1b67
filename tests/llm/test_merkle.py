"""The Merkle manifest against a tree that is built level by level."""

import hashlib
import zlib

import cases
import numpy as np
import pytest

from larder.llm import merkle

H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i - i % 16
        out.append((nodes[first:i], nodes[i + 1 : first + 16]))
        i //= 16
    return out


def brute(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees.append(levels_of([x[2] for x in groups[name]]))
    crown = levels_of([t[-1][0] for t in trees])
    root, out = crown[-1][0] if names else None, []
    for g, name in enumerate(names):
        for i, (_, _, digest, r) in enumerate(groups[name]):
            steps = path_of(trees[g], i) + path_of(crown, g)
            tried = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                tried = leaf((*r[:4], None if r[4] is None else cases.ascii_lower(r[4])))
            for left, right in steps:
                tried = H(*left, tried, *right)
            proof = H(*[d for left, right in steps for d in left + right])
            out.append((r[0], digest, trees[g][-1][0], root, proof, tried, tried == root))
    return cases.in_order(out)


def frame(spark, rows):
    """With columns whose names the operator uses itself, over several tasks."""
    extra = [(*r, "x", 1, "y", 2, "z") for r in rows]
    names = "doc_id long, source string, lang string, n_chars long, text string, digest string, chunk int, _group string, slice int, path string"
    return spark.createDataFrame(extra, names).repartition(5)


def proven(docs):
    return merkle.proofs(merkle.manifest(merkle.document_leaves(docs), "source", "doc_id"), "doc_id", "tried")


def rows():
    made = [(i, s, la, n, t) for i, t, la, s, n, *_ in cases.rows()]
    made += [(5000 + i, "hot", "de", None, f"Text {i} ÄB") for i in range(700)]
    made += [(9000 + i, f"s{i:03}", None, i, None if i % 2 else "A") for i in range(40)]
    made += [(1, "é", "en", 1, "AB"), (1, "é", "en", 1, "AB"), (1, "é", "en", 1, "ab"), (None, None, None, None, None), (3, "", "", 0, "")]
    return made + [(20000 + i, "sixteen", "en", 1, "Q") for i in range(16)] + [(30000 + i, "full", "en", 1, "Q") for i in range(256)]


def test_proofs(spark):
    got = cases.in_order(tuple(r) for r in proven(frame(spark, rows())).collect())
    want = brute(rows())
    assert got == want
    assert any(r[6] for r in want) and any(not r[6] for r in want)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 256, 257, 4096, 4097, 5000])
def test_sizes(n):
    """Rounds of builders end in the root of the plain tree, and their paths lead there."""
    leaves = [H(str(i)) for i in range(n)]
    rounds, nodes = [], leaves
    while not rounds or len(rounds[-1]) > 1:
        rounds.append([merkle.appended(nodes[i : i + 256], i // 256) for i in range(0, len(nodes), 256)])
        nodes = [log[-1] for log in rounds[-1]]
    want = levels_of(leaves)
    assert nodes == want[-1]
    for i in {0, 1, 15, 16, n // 2, n - 1} & set(range(n)):
        steps, at, count = [], i, n
        for logs in rounds:
            chunk = at // 256
            steps += merkle.path(merkle.runs("".join(logs[chunk]), chunk, min(256, count - chunk * 256)), at % 256)
            at, count = chunk, len(logs)
        assert [s for _, s in steps] == ["".join(a + b) for a, b in path_of(want, i)]
        assert merkle.folded(leaves[i], steps) == nodes[0] != merkle.folded(H("other"), steps)


@pytest.mark.parametrize("chunk,n", [(0, 1), (0, 5), (0, 16), (0, 40), (0, 256), (3, 1), (3, 17), (3, 200), (3, 256)])
def test_places(chunk, n):
    """Each place of a log belongs to one node, and the last is the top."""
    log = merkle.appended([H(str(i)) for i in range(n)], chunk)
    places, nodes = [], n
    for level in range(merkle.height(chunk, n) + 1):
        places += merkle.place_in_log(level, np.arange(nodes), n).tolist()
        nodes = -(-nodes // 16)
    assert sorted(places) == list(range(len(log))) and places[-1] == len(log) - 1


def test_empty(spark):
    assert proven(frame(spark, rows()).limit(0)).count() == 0
