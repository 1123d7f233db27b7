"""Public tokenizers inside tasks."""

from __future__ import annotations

import json
import os
import re

import tiktoken
from tokenizers import Tokenizer

LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: A word of Latin letters with a few marks after it. Every split pattern with letters and marks in
#: classes of their own cuts it between the two and nowhere else.
PLAIN_WORD = re.compile(f"([{LATIN}]+)([.,;:!?$%&*#|]{{0,3}})")
#: How byte-level files split text before merging (fixed value).
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def load(path: str) -> Tokenizer:
    """The tokenizer of a file, working on the task's own thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def vocabulary(name: str) -> str:
    """Where the public vocabulary file of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: bytes that print stand for themselves, the others
    for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_ranks(path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]]]:
    """Token bytes to id, and the merges in order, of a byte-level BPE file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, letters = content["model"], _alphabet()
    added = {t["content"] for t in content["added_tokens"]}
    spell = lambda token: bytes(letters[c] for c in token)
    ranks = {spell(t): i for t, i in model["vocab"].items() if t not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return ranks, [(spell(a), spell(b)) for a, b in pairs]


def _splits_bytes(path: str) -> bool:
    """Whether a file cuts text by ``SPLIT`` only, and takes its special tokens as they stand."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    splitter = content["pre_tokenizer"] or {}
    return (
        content["normalizer"] is None
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", False)
        and not splitter.get("add_prefix_space", True)
        and not any(
            t[flag]
            for t in content["added_tokens"]
            for flag in ("single_word", "lstrip", "rstrip", "normalized")
        )
    )


def by_rank(path: str) -> bool:
    """Whether merging by the ids of joined tokens gives what the file's list of merges gives.

    That holds when ids follow the merges and every merged token, cut by the merges before it, ends
    as the two parts its own merge names: then no other pair can ever stand where it would be joined.
    """
    if not _splits_bytes(path):
        return False
    ranks, merges = merge_ranks(path)
    for i, (a, b) in enumerate(merges):
        whole = a + b
        own = ranks.get(whole)
        if own != 256 + i:
            return False
        parts = [whole[k : k + 1] for k in range(len(whole))]
        while True:
            found = [ranks.get(x + y, own) for x, y in zip(parts, parts[1:], strict=False)]
            at = min(range(len(found)), key=found.__getitem__, default=None)
            if at is None or found[at] >= own:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if parts != [a, b]:
            return False
    return True


def rank_encoder(path: str) -> tiktoken.Encoding:
    """An encoder of whole texts, with the file's special tokens; only for files that are ``by_rank``."""
    ranks, _ = merge_ranks(path)
    with open(path, encoding="utf-8") as file:
        special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
