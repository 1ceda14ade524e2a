"""Token ids of a byte-level BPE vocabulary, by pre-tokens kept in a bounded cache.

The tokenizer's own pre-tokens never cross each other, so a text's ids are
those of its pre-tokens in order.  Texts of the characters listed here are
split by one compiled pattern and each distinct pre-token is encoded once;
any other text goes to the tokenizer whole.
"""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np

from lectern.llm.common import WordCache

SLICE = 1 << 20  # characters of a very long text handled at a time

# Characters whose class (letter, number, white space, other) is written out below.
LETTER = r"A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBER = r"0-9²³¹¼-¾"
OTHER = r"!-/:-@\[-`{-~¡-©«¬®-±´¶-¸»¿×÷‐-‧‰-⁞"
PLAIN = re.compile(rf"[ \t\n\r{LETTER}{NUMBER}{OTHER}]*")
SPLIT = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[{OTHER}]+|[ \t\n\r]+(?![{LETTER}{NUMBER}{OTHER}])|[ \t\n\r]+")
CUT = re.compile(r"(?<=[^ \t\n\r])(?=[ \n])")


class Encoder:
    """text -> ids as a little-endian uint32 array."""

    def __init__(self, path: str, cache_words: int = 200_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # byte-level vocabularies write a byte as itself if it is visible, else as the next free sign from 256 on
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        self.signs = {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.space = self.signs[32]
        self.cache = WordCache(self._ids, cache_words)

    def _ids(self, word: str) -> bytes:
        """The ids of one pre-token."""
        if word.isascii() and not word.isspace():  # then a blank can only come first
            signs = self.space + word[1:] if word[0] == " " else word
        else:
            signs = word.encode().decode("latin-1").translate(self.signs)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(signs)]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, SPLIT.findall(text)))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        if PLAIN.fullmatch(text) is None or any(s in text for s in self.special):
            return np.frombuffer(self._whole(text), dtype="<u4")
        if len(text) <= SLICE:
            return np.frombuffer(self._plain(text), dtype="<u4")
        out, at = [], 0
        while at < len(text):
            cut = CUT.search(text, min(at + SLICE, len(text)))
            end = cut.start() if cut else len(text)
            out.append(self._plain(text[at:end]))
            at = end
        return np.frombuffer(b"".join(out), dtype="<u4")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)
