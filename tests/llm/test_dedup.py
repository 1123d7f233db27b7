"""Exact and near duplicates against brute force, and components on hand-made graphs."""

import collections
import hashlib

import pytest
import xxhash

from tallytide.llm.components import connected_components
from tallytide.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from tallytide.llm.simhash import (
    FLIPS,
    _leader_links,
    drop_near_duplicates,
    fingerprint,
    near_duplicates,
    wildcard_index,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(text):
    return (text or "").translate(LOWER)


def below(i):
    return -1 if i is None else i


def test_exact_duplicates_match_brute_force(odd, documents):
    for docs in (odd, documents):
        rows = [(r.doc_id, norm(r.text)) for r in docs.select("doc_id", "text").collect()]
        groups = collections.defaultdict(list)
        for i, t in rows:
            groups[t].append(below(i))
        found = exact_duplicates(docs).collect()
        expected = collections.Counter(
            (i, max(groups[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows
        )
        assert collections.Counter(
            (r.doc_id, below(r.keep_id), r.group_size, r.text_sha256) for r in found
        ) == expected
        assert sum(r.kept for r in found) == len(groups)
        assert all(r.kept <= (below(r.doc_id) == below(r.keep_id)) for r in found)


def test_survivors_keep_their_columns(odd):
    out = drop_exact_duplicates(odd)
    assert out.columns == odd.columns
    texts = [norm(r.text) for r in out.collect()]
    assert sorted(texts) == sorted({norm(r.text) for r in odd.collect()})


def brute_fingerprint(text, words=4):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + words]) for k in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes) > 0)


def test_fingerprints_match_brute_force(odd):
    for r in odd.collect():
        assert fingerprint(r.text, 4) % 2**64 == brute_fingerprint(r.text)


def linked(prints, bits):
    parent = {i: i for i in prints}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("bits", [3, 4, 6])
def test_components_match_brute_force(documents, bits):
    found = {r.doc_id: r for r in near_duplicates(documents, 4, bits).collect()}
    prints = {i: r.fp % 2**64 for i, r in found.items()}
    assert {i: r.component_id for i, r in found.items()} == linked(prints, bits)


def test_every_close_pair_shares_a_key(spark):
    base = 0x0123456789ABCDEF
    flips = [(0, 1, 2, 3), (0, 21, 42, 63), (20, 21, 41, 42), (63, 62, 1, 30), (5,), ()]
    nodes = spark.createDataFrame([(base,)], "fp bigint")
    for flip in flips:
        other = base
        for b in flip:
            other ^= 1 << b
        other -= 2**64 if other >= 2**63 else 0
        theirs = wildcard_index(spark.createDataFrame([(other,)], "fp bigint"), 4).select("key")
        assert wildcard_index(nodes, 4).join(theirs, "key").count() > 0


def test_leaders_of_a_crowded_bucket(spark):
    """Every fingerprint shares one segment, so its bucket is spread; links are those of the rule."""
    prints = [0x15555 + (i % 64 << 22) + (i // 64 << 45) for i in range(1500)]
    nodes = spark.createDataFrame([(p,) for p in prints], "fp bigint").repartition(8)
    found = {(r.u, r.v) for r in _leader_links(nodes, 4).collect()}
    buckets = collections.defaultdict(list)
    for p in prints:
        for i, (low, high) in enumerate(((0, 21), (21, 42), (42, 64))):
            buckets[i, p >> low & (1 << (high - low)) - 1].append(p)
    expected = set()
    for members in buckets.values():
        leaders = {pick(m ^ flip for m in members) ^ flip for flip in FLIPS for pick in (min, max)}
        expected |= {
            (m, a) for m in members for a in leaders if m != a and (m ^ a).bit_count() <= 4 and len(members) > 1
        }
    assert found == expected


def test_odd_rows_have_components(odd, empty):
    found = near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = collections.defaultdict(set)
    for r in found:
        by[r.fp].add(r.component_id)
    assert all(len(v) == 1 for v in by.values())
    assert {r.component_id for r in found if r.doc_id in (3, 4)} == {3}
    assert near_duplicates(empty).count() == 0 and exact_duplicates(empty).count() == 0
    assert drop_near_duplicates(empty).columns == empty.columns
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 2").count() == 0


def test_null_ids_are_not_the_text_null(spark):
    docs = spark.createDataFrame([("null", "a"), (None, "a"), (None, "b")], "doc_id string, text string")
    kept = drop_exact_duplicates(docs).collect()
    assert sorted(kept, key=lambda r: r.text) == [("null", "a"), (None, "b")]


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(0, i) for i in range(1, 50)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges = spark.createDataFrame(chain + star + ring + [(300, 300)], "u bigint, v bigint")
    found = {r.node: r.root for r in connected_components(edges).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 0 for i in range(50)} | {
        i: 200 for i in range(200, 209)
    }
    assert connected_components(edges.limit(0)).count() == 0
