"""Byte-level BPE of whole texts, fast enough for a corpus.

The ids are those of ``tokenizers.Tokenizer.from_file(path).encode(text,
add_special_tokens=False)`` for a byte-level vocabulary; a test holds the two equal. The
merges run in ``tiktoken`` on the same vocabulary, and the one lookahead of the splitting
pattern is done by cutting the text at runs of white space beforehand, which lets the rest
run as a plain automaton.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

# The pattern that byte-level BPE splits by, without its lookahead branch, and
# the characters that Unicode calls white space.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: A run of white space before a word gives its last character to the word.
_CUT = re.compile(f"(?<=[{_WHITE}])(?=[{_WHITE}][^{_WHITE}])")


def default_vocabulary() -> str:
    """Return the path of the public 50k vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Undo the printable spelling of bytes: the others are numbered from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in printable}
    hidden = [b for b in range(256) if b not in set(printable)]
    return table | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """A byte-level vocabulary: ids of a text, and how many bytes each id stands for."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        specials = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"]}
        spelled = _byte_of_char()
        ranks = {
            bytes(spelled[c] for c in word): number
            for word, number in data["model"]["vocab"].items()
            if word not in specials
        }
        self._encode = tiktoken.Encoding(
            "byte-level", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._specials = specials
        self._split = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.n_bytes = np.zeros(max([*ranks.values(), *specials.values()]) + 1, np.int64)
        for word, number in ranks.items():
            self.n_bytes[number] = len(word)
        for word, number in specials.items():
            self.n_bytes[number] = len(word.encode())

    def ids(self, text: str) -> list[int]:
        """Return the ids of a whole text."""
        if self._split is None or not any(s in text for s in self._specials):
            return self._plain(text)
        out: list[int] = []
        for part in self._split.split(text):
            out += [self._specials[part]] if part in self._specials else self._plain(part)
        return out

    def _plain(self, text: str) -> list[int]:
        parts = _CUT.split(text)
        if len(parts) == 1:
            return self._encode(text)
        out: list[int] = []
        for part in parts:
            out += self._encode(part)
        return out


@lru_cache(maxsize=2)
def load(path: str | None) -> Bpe:
    """Return the vocabulary, read once in each Python process."""
    return Bpe(path or default_vocabulary())
