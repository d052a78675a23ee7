"""Cutting text into the pieces that byte-level BPE merges within, and the public vocabulary files."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import regex

# The usual byte-level BPE pattern, and the same for text below U+0250, where the letter
# and number classes can be listed and the standard module is faster.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = r"\t-\r \x85\xa0"


@lru_cache(maxsize=8)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function from a text to its pieces, in order."""
    whole = regex.compile(pattern).findall
    if pattern != BYTE_LEVEL:
        return whole
    latin = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
        rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
    ).findall
    other = re.compile("[^\x00-ɏ]").search
    return lambda text: whole(text) if other(text) else latin(text)


def chunks(texts: list[str | None], limit: int):
    """Slices of consecutive texts with about `limit` characters, one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
