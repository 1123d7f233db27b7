"""Packing and token counts against the tokenizer library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallytide.llm.packing import TextIds, pack, plan_best_fit
from tallytide.llm.token_counts import Chunks, token_counts
from tallytide.llm.tokens import by_rank, vocabulary

BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
PIECES = ["word", "É'S", "don't", " ", "  ", "\n", "\n\n", "\t", "12x", "ß", "İ", "<|endoftext|>", ".", ",;", "$$$", "\x85", "é", "😀", "tionnd"]


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(WORDS)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_pieces_are_the_tokens_of_the_text(odd, byte_tokenizer):
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    expected = []
    for i, t in texts:
        ids = byte_tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        expected += [(i, n, a, b - a, crc(ids[a:b])) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    found = pack(odd, BYTES).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, expected)) == sorted(key(tuple(r)[:5]) for r in found)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_an_empty_table_packs_to_nothing(empty):
    assert pack(empty, BYTES).count() == 0 and token_counts(empty, WORDS).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12))
@settings(max_examples=60, deadline=None)
def test_plan_fills_every_rank_once_and_is_best_fit(counts):
    slots = plan_best_fit(counts, 64)
    bins, ranks = {}, {}
    for length, low, high, first, base, per in slots:
        for rank in range(low, high):
            step = rank - low
            bins.setdefault(first + step // per, []).append((base + step % per * length, length))
            ranks.setdefault(length, []).append(rank)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [r for r in room if r >= length]
            if fit:
                room.remove(min(fit))
                room.append(min(fit) - length)
            else:
                room.append(64 - length)
    assert len(bins) == len(room)


def test_the_file_can_be_merged_by_rank():
    assert by_rank(BYTES)


@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join) | st.text(max_size=30))
@settings(max_examples=200, deadline=None)
def test_any_text_is_encoded_and_counted_as_the_library_does(text):
    text = text.encode("utf-8", "ignore").decode()
    ids, words = STATE["bytes"], STATE["words"]
    assert ids.text(text) == ids.whole(text)
    pieces, rare = words.count(text)
    model = words.tokenizer.model.tokenize
    total = pieces + sum(n * len(model(t)) for t, n in rare.items())
    assert total == len(words.tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("shape", ["a{0}b", "{0}", " {0} {0}{0}1"])
def test_ids_around_every_code_point_are_the_library_s(shape):
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(letters), 20_000):
        text = "\n~".join(map(shape.format, letters[at : at + 20_000]))
        assert STATE["bytes"].text(text) == STATE["bytes"].whole(text)


@pytest.mark.parametrize("text", [" " * 1_500_000 + "b", "a" * 300_000, "<|endoftext|>" * 999])
def test_ids_of_very_long_runs_are_the_library_s(text):
    assert STATE["bytes"].text(text) == STATE["bytes"].whole(text)


STATE = {"bytes": TextIds(BYTES, True), "words": Chunks(WORDS, {})}


def test_counts_are_the_lengths_of_encodings(odd, documents, word_tokenizer):
    for docs in (odd, documents):
        expected = sorted(
            (-1 if r.doc_id is None else r.doc_id, len((r.text or "").encode()), len(word_tokenizer.encode(r.text or "", add_special_tokens=False).ids))
            for r in docs.collect()
        )
        found = token_counts(docs, WORDS).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in found) == expected
        assert all(r.over_limit == (r.n_tokens > 2048) for r in found)
