"""Byte-level BPE ids, as the `tokenizers` library gives them for a vocabulary file.

`tiktoken` does the work with ranks read from the same file, several times faster and with equal
ids. Texts that hold a special string go to `tokenizers` itself, which alone knows special ids.
Encoders are built once per Python worker.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import regex
import tiktoken
from public_tokenizers import PATTERN, path
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
TWO_SPACES = regex.compile(r"\s\s")
LOOKAHEAD = r"|\s+(?!\S)"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return path(name)


def _byte_alphabet() -> dict[str, int]:
    """Printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): rank
                 for token, rank in spec["model"]["vocab"].items() if token not in self.specials}
        self.full = tiktoken.Encoding("full", pat_str=PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        # Without two white-space characters in a row the look-ahead decides nothing, and a
        # pattern without it runs on the faster engine.
        self.plain = tiktoken.Encoding("plain", pat_str=PATTERN.replace(LOOKAHEAD, ""),
                                       mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(vocabulary)

    def ordinary(self, text: str) -> list[int]:
        """Special strings count as ordinary text."""
        return (self.full if TWO_SPACES.search(text) else self.plain).encode_ordinary(text)

    def ids(self, text: str) -> list[int]:
        if any(special in text for special in self.specials):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.ordinary(text)


@functools.lru_cache(maxsize=4)
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def as_array(ids: list[int]) -> np.ndarray:
    return np.array(ids, dtype="<u4")
