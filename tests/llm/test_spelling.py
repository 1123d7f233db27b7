"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from tallytide.llm import spelling as S
from tallytide.llm.queries import op11_spelling


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words_of(rows, least=7, times=2):
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += len(run) >= least
    return {w: n for w, n in counts.items() if n >= times}


def neighbours(words):
    """Pairs of words that agree after taking out one code point at the same place, or of one."""
    near, gaps = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(counts):
    near = neighbours(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(
        (w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()
    )


def links(spark, words):
    found = S.variant_links(spark.createDataFrame([(w, 2) for w in words], "word string, n bigint"))
    got = sorted((r.word, r.near) for r in found.collect())
    assert got == sorted((w, v) for w, vs in neighbours(set(words)).items() for v in vs)
    return got


def test_edits_at_every_place(spark):
    letters = "abeß"
    word = "ababcdaa"
    near = {word}
    for i in range(len(word) + 1):
        near |= {word[:i] + c + word[i:] for c in letters} | {word[:i] + word[i + 1 :]}
        near |= {word[:i] + c + word[i + 1 :] for c in letters if i < len(word)}
    assert len(links(spark, sorted(near))) > 100


def test_runs_of_one_letter(spark):
    links(spark, ["a" * n for n in range(1, 9)] + ["aabaa", "abaa", "aaba", "baaa"])


@pytest.mark.parametrize("n", [31, 33])
def test_words_that_part_deep_in_the_trie(spark, n):
    stem = ("abcdefghij" * 100)[:n]
    links(spark, [stem, stem + "x", stem + "xy", stem[:-1] + "z", "q" + stem, stem[: n // 2] + stem[n // 2 + 1 :], stem * 3])


def test_very_long_words(spark):
    long = "abcdefghij" * 2000
    links(spark, [long, long[:-2] + "j", "other", "othr"])


def test_no_words(spark, empty):
    assert S.spelling_variants(empty).count() == 0
    assert links(spark, ["single"]) == []


def test_chains_of_forms_and_ties(spark):
    groups = {"abcdefgh": 2, "abcdefgx": 20, "abcdefyx": 200, "abcdefgz": 20, "zbcdefgz": 3, "unrelated": 9}
    text = " ".join(w for w, n in groups.items() for _ in range(n))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = sorted(map(tuple, S.spelling_variants(docs, misspelt=None).collect()))
    assert found == brute(groups)
    assert ("abcdefgh", "abcdefgx", "abcdefyx", 2, 2, 20) in found


def test_odd_rows(odd):
    assert sorted(map(tuple, S.spelling_variants(odd).collect())) == brute(words_of(odd.collect()))


def test_joins_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("tallytide.operators.sizing.BROADCAST_LIMIT_BYTES", 0)
    links(spark, ["abcdefg", "abcdefh", "abcdeg", "bbcdefg", "abxdefg", "abcdefgg", "axcdefh"])


def test_the_query_over_all_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = sorted(map(tuple, op11_spelling(spark, folder).collect()))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert found == brute(words_of(docs.collect()))
    assert sum(r[1] is not None for r in found) > 100
