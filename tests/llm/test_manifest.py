"""The Merkle manifest against a plain tree."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tallytide.llm import manifest as M
from tallytide.llm.queries import op12_manifest

DOC = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root, and of every leaf the (left, right) siblings of each level."""
    level, under, proofs = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        above, below = [], []
        for at in range(0, len(level), 8):
            run = level[at : at + 8]
            for i in range(len(run)):
                for x in under[at + i]:
                    proofs[x].append((run[:i], run[i + 1 :]))
            above.append(digest(*run))
            below.append([x for xs in under[at : at + 8] for x in xs])
        level, under = above, below
    return level[0], proofs


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r.lang].append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    least = lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))
    trees = {k: tree([leaf(r, r.text) for r in sorted(by_lang[k], key=least)]) for k in langs}
    root, upper = tree([trees[k][0] for k in langs]) if langs else (None, [])
    out = []
    for lang, more in zip(langs, upper, strict=True):
        subroot, proofs = trees[lang]
        for r, proof in zip(sorted(by_lang[lang], key=least), proofs, strict=True):
            path = proof + more
            own = leaf(r, r.text)
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            now = leaf(r, lower(r.text)) if tampered else own
            for left, right in path:
                now = digest(*left, now, *right)
            sibs = digest(*(d for left, right in path for d in (*left, *right)))
            out.append((r.doc_id, own, subroot, root, sibs, now, now == root))
    return out


def check(df):
    found = [tuple(r) for r in M.tamper_check(df).collect()]
    assert sorted(found, key=repr) == sorted(brute(df.collect()), key=repr)
    return found


@pytest.fixture
def low(monkeypatch):
    """Blocks of two levels, so that small trees have several tiers of them."""
    monkeypatch.setattr(M, "LEVELS", 2)


def test_odd_rows(odd):
    assert len(check(odd)) == 14


def test_an_empty_table(empty):
    assert M.tamper_check(empty).count() == 0


def test_one_row(spark):
    assert check(spark.createDataFrame([(0, None, None, None, None)], DOC))[0][-1] is True


@pytest.mark.parametrize("n", [7, 8, 9, 64, 65, 73, 513, 4100])
def test_trees_of_many_blocks(spark, low, n):
    rows = [(i * 7 % n, "s", None if i < n // 3 else "en", i, f"Text {i}") for i in range(n)]
    assert len(check(spark.createDataFrame(rows, DOC))) == n


def test_many_trees(spark, low):
    rows = [(i, None, f"l{i % 90}" if i % 3 else "hot", 1, "T") for i in range(600)]
    check(spark.createDataFrame(rows, DOC))


def test_repeated_rows_and_ids(spark, low):
    rows = [(5, "s", "en", 1, "T")] * 200 + [(5, "s", "en", 1, f"U{i}") for i in range(100)]
    check(spark.createDataFrame(rows, DOC))


def test_witnesses_joined_by_shuffle(spark, low, monkeypatch):
    monkeypatch.setattr("tallytide.operators.sizing.BROADCAST_LIMIT_BYTES", 0)
    check(spark.createDataFrame([(i, None, "en" if i % 5 else "de", 1, "T") for i in range(300)], DOC))


def test_the_query_over_all_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = [tuple(r) for r in op12_manifest(spark, folder).collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(found) == sorted(brute(docs.collect()))
    assert {r[-1] for r in found} == {True, False}
