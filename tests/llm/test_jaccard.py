"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from tallytide.llm import jaccard as J
from tallytide.llm.queries import op13_jaccard
from tallytide.operators.sizing import lookup_join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    sets = [shingles(r.text) for r in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                top[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
    return sorted(((r.doc_id, len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def check(df):
    found = sorted(map(tuple, J.similar_components(df).collect()), key=repr)
    assert found == brute(df.collect())
    return found


def corpus(spark, n=150, seed=1):
    """Near copies of a few texts, close to the threshold on both sides, and unrelated ones."""
    draw = random.Random(seed)
    stems = [[f"w{draw.randrange(60)}" for _ in range(draw.choice((8, 40, 90)))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(draw.choice(stems))
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(9)}"
        rows.append((i, " ".join(words if draw.random() < 0.9 else words[::-1])))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_near_copies(spark):
    found = check(corpus(spark))
    assert len({r[2] for r in found}) < len(found) * 0.8


def test_trees_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    monkeypatch.setattr(J, "NODE", 2)
    monkeypatch.setattr(J, "FANOUT", 2)
    check(corpus(spark, 120, 2))


def test_joins_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(J, "_join", lambda *a, **k: lookup_join(*a, **k, limit_bytes=0))
    check(corpus(spark, 60, 3))


def test_odd_rows(odd):
    check(odd)


def test_an_empty_table(empty):
    assert J.similar_components(empty).count() == 0


def test_bounds_never_lose_a_link():
    draw = random.Random(4)
    for _ in range(300):
        n = draw.choice((3, 30, 400, 3000))
        a = np.unique(np.array([draw.getrandbits(64) for _ in range(n)], np.uint64))
        b = a.copy()
        for i in draw.sample(range(len(a)), k=len(a) // 15):
            b[i] = draw.getrandbits(64)
        b = np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            bits = [J.cut(J.signature(x), J.BITS // 64) for x in (a, b)]
            used = [int(np.bitwise_count(x).sum()) for x in bits]
            assert J.overlap_bound(J.signature(a), len(a), J.signature(b), len(b)) >= both
            one, two = (
                J.Nodes(bits[i][None], *(np.array([v]) for v in (len(x), len(x), len(x) - u, i, i)))
                for i, (x, u) in enumerate(zip((a, b), used, strict=True))
            )
            assert J.may_link(one, two, 90)[0]
            none = (np.empty(0, np.uint64), np.empty(0, np.int64))
            small, large = sorted((a, b), key=len)
            near = J.prefix(small, 90, none)[: J.short_prefix(len(small), 90)]
            assert len(np.intersect1d(near, J.prefix(large, 90, none)))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_the_query_over_all_documents(spark, folder):
    found = sorted(map(tuple, op13_jaccard(spark, folder).collect()), key=repr)
    assert found == brute(spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert len({r[2] for r in found}) < len(found)


def test_rows_are_paired_with_those_of_their_size_and_with_few(spark):
    # token 1 has 40 rows; row 0 shares 30 more tokens with leaders of their own
    cells = [(1, row, 100 + row, 40) for row in range(40)]
    for token in range(2, 32):
        cells += [(token, 0, 100, 20), *((token, 100 * token + i, 100, 20) for i in range(19))]
    shared = spark.createDataFrame(cells, "token long, row long, n long, classes long")
    pairs = {tuple(r) for r in J._leaders(shared.withColumn("at", shared.n * 0)).collect()}
    assert all((row, row + 1) in pairs for row in range(39))
    assert all(u < v for u, v in pairs)
    assert len(pairs) <= len({row for _, row, _, _ in cells}) * (J.LED + J.FOLLOWED)


def test_rows_without_one_of_their_size_are_not_joined(spark):
    # token 7 is in sets of 20, 40 and 80; token 8 in two of one size; token 9 late in both of its sets
    sets = [(0, 20, [7]), (1, 40, [7]), (2, 80, [7]), (3, 60, [8]), (4, 60, [8])]
    sets += [(5, 50, [51, 52, 53, 54, 9]), (6, 50, [61, 62, 63, 64, 9])]
    # the first and the last shingle of a batch stay, whatever their sizes
    nodes = spark.createDataFrame([(10, 5, [-1]), *sets, (11, 5, [99])], "row long, n long, prefix array<long>")
    found = {(r.token, r.row) for r in J._shared(nodes.coalesce(1), 90).collect()}
    assert found == {(8, 3), (8, 4)}


def test_no_pair_that_links_is_lost_by_size_and_place(spark):
    draw = random.Random(8)
    stems = [[draw.getrandbits(62) for _ in range(draw.choice((20, 21, 60, 200)))] for _ in range(12)]
    sets = []
    for _ in range(160):
        one = list(draw.choice(stems))
        for _ in range(draw.randrange(len(one) // 8)):
            one[draw.randrange(len(one))] = draw.getrandbits(62)
        sets.append(np.unique(np.array(one, np.uint64)))
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    heads = [J.prefix(x, 90, none).view(np.int64).tolist() for x in sets]
    rows = [(i, len(x), h) for i, (x, h) in enumerate(zip(sets, heads, strict=True))]
    shared = J._shared(spark.createDataFrame(rows, "row long, n long, prefix array<long>"), 90).collect()
    kept = {(r.row, r.token) for r in shared}
    linked = 0
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 90 * (len(a) + len(sets[j]) - both):
                first = next(t for t in heads[i] if t in heads[j])
                assert {(i, first), (j, first)} <= kept
                linked += 1
    assert linked > 50


def test_followers_of_other_sizes_are_not_paired(spark):
    cells = [(1, row, 20 * (1 + row % 10) ** 2, 0, 40) for row in range(40)]
    shared = spark.createDataFrame(cells, "token long, row long, n long, at long, classes long")
    pairs = {tuple(r) for r in J._leaders(shared, 90).collect()}
    assert pairs and all(u % 10 == v % 10 for u, v in pairs)


def test_classes_are_those_of_about_the_size(spark):
    rows = [(row, 20 * (1 + row % 10) ** 2, [7]) for row in range(40)] + [(90, 5, [-1]), (91, 5, [99])]
    nodes = spark.createDataFrame(rows, "row long, n long, prefix array<long>")
    shared = J._shared(nodes.coalesce(1), 90)
    assert {(r.row, r.classes) for r in shared.collect()} == {(row, 4) for row in range(40)}
    assert J._leaders(shared, 90).count() == 0
