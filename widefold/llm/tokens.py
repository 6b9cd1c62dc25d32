"""Token ids of whole texts by a public byte-level BPE, for use inside tasks."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Characters whose class no release of Unicode has changed lately, so that any two libraries cut them alike.
SETTLED = [*range(0x00, 0x1C), *range(0x20, 0x250), *range(0x400, 0x482), *range(0x2010, 0x2028), 0x20AC]
#: What the vocabulary's pre-tokenizer cuts a text into, a fixed rule.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_PIECES = 400_000
WINDOW = 1 << 20


class PieceIds(dict):
    """The ids of pieces met so far, as little-endian bytes.

    When full, what it holds becomes the older half, from which pieces met again are taken back; so
    frequent pieces stay and memory is bounded.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.older: dict[str, bytes] = {}
        self.added = [str(t) for t in tokenizer.get_added_tokens_decoder().values()]
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.merger = tiktoken.Encoding(
            "pieces", pat_str=r"(?s).+", mergeable_ranks=byte_ranks(vocabulary), special_tokens={}
        )

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_PIECES:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.merger.encode_ordinary(piece), "<u4").tobytes()
        self[piece] = ids
        return ids


def byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The vocabulary with its tokens as bytes. It writes bytes that don't print as later characters."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printing]
    byte_of = {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}
    known = {t: i for t, i in vocabulary.items() if all(c in byte_of for c in t)}
    return {bytes(byte_of[c] for c in t): i for t, i in known.items()}


def ids_of(tokenizer: Tokenizer, text: str) -> bytes:
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def members(test) -> str:
    """The settled characters that pass a test, as the inside of a character class."""
    return re.escape("".join(chr(c) for c in SETTLED if test(unicodedata.category(chr(c)))))


@cache
def patterns() -> tuple[re.Pattern, re.Pattern]:
    """What cuts a text as the vocabulary's pre-tokenizer does (a fixed rule), and what tells a settled text.

    Letters, numbers and the rest are spelled out, which is much faster than classes by property.
    """
    letter, number = members(lambda c: c[0] == "L"), members(lambda c: c[0] == "N")
    pieces = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+"
    return re.compile(pieces), re.compile(f"[{members(lambda c: True)}]*")


@cache
def loaded(path: str) -> PieceIds:
    return PieceIds(Tokenizer.from_file(path))


def windows(text: str):
    """The text in parts of about WINDOW characters, cut before a single space between two words."""
    start = 0
    while len(text) - start > WINDOW:
        cut = start + WINDOW
        while cut < len(text) and not (text[cut] == " " and text[cut - 1].isalnum() and text[cut + 1 : cut + 2].isalnum()):
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def token_bytes(text: str, path: str) -> bytes:
    """All ids of a text, four bytes each.

    The vocabulary merges only inside pieces, and pieces repeat, so each is merged once and looked up
    afterwards. A library that only merges does that in a third of the tokenizer's time. Texts with characters outside SETTLED, and those that hold the
    string of an added token, go to the tokenizer as a whole.
    """
    known, (pieces, settled) = loaded(path), patterns()
    if not settled.fullmatch(text) or any(t in text for t in known.added):
        return ids_of(known.tokenizer, text)
    return b"".join(b"".join(map(known.__getitem__, pieces.findall(part))) for part in windows(text))
