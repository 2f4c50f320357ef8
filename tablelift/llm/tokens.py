"""Ids of a public tokenizer, word by word with bounded caches.

Words are the runs between white space of ASCII. The tokenizer lower-cases and drops white space, so that the ids of a text are
the ids of its words one after another; words of plain Latin script skip the library's normalizer and patterns and run the merges
of its vocabulary directly. (All letters of PLAIN are in normal form already.)
"""

from __future__ import annotations

import functools
from array import array

import public_tokenizers
import regex

WORD_BPE = "word_bpe_49k.json"
# Pattern of the pre-tokenizer in that file (fixed value).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = b"\xff"
# Words outside of these letters and signs go through the whole library.
PLAIN = regex.compile(r"[\x21-\x3b\x3d-\x7eÀ-ÖØ-öø-įĲ-ňŊ-ž]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """bytes of a word -> its ids as little-endian unsigned 32-bit integers; at most ``entries`` words are kept."""

    def __init__(self, file: str, entries: int = 500_000) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(file)
        self.entries = entries
        # The vocabulary as ranks: ids are in the order of the merges, and the end of a word is one more byte that UTF-8 never
        # holds. The same merges then run without the library's normalizer, patterns and token objects.
        byte = {c: b for b, c in byte_letters().items()}
        special = self.library.get_added_tokens_decoder()
        ranks = {
            bytes(byte[c] for c in t.removesuffix("</w>")) + WORD_END * t.endswith("</w>"): i
            for t, i in self.library.get_vocab().items()
            if i not in special
        }
        self.merge = tiktoken.Encoding("ranks", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def piece(self, piece: bytes) -> bytes:
        """Ids of one lower-case piece of the pre-tokenizer."""
        return array("I", self.merge(piece + WORD_END)).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII
            if not word.islower():
                return self[word.lower()]
            ids = self.piece(word)
        elif len(word) > 1 and word[-1] in b".,;:!?" and word[-2:-1].isalpha() and b"<" not in word:
            return self[word[:-1]] + self[word[-1:]]  # kept under its plain form alone
        else:
            text = word.decode("utf-8", "replace")
            if len(text) < 100 and PLAIN.fullmatch(text):
                text = text.lower()
                ids = self.piece(text.encode()) if text.isalpha() else b"".join([self.piece(p.encode()) for p in PIECES.findall(text)])
            else:
                ids = array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if len(word) < 100:
            if len(self) >= self.entries:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole text (UTF-8 bytes)."""
        return b"".join([self[w] for w in text.split()])


@functools.lru_cache(maxsize=4)
def word_ids(file: str) -> WordIds:
    """One encoder per Python worker and vocabulary file."""
    return WordIds(file)


def vocabulary(name: str = WORD_BPE) -> str:
    return public_tokenizers.path(name)
