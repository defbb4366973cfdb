"""Byte-level BPE from a tokenizer file, held once per Python worker.

The ids are those of the ``tokenizers`` library for the same file (tests
compare them); the merging is done by ``tiktoken`` with the file's own
vocabulary, which is several times faster. Its pattern matcher gives up on very
long runs of white space; such a text is cut at its words here, and a word of
over ``LONG`` characters is merged without the matcher. A cut at a word border
changes no word: the pattern looks ahead only at a word's end.
Special strings inside a text become their special ids, as that library does by
default.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
import regex

#: fixed value: the word pattern of byte-level BPE vocabularies of this kind
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LONG = 10_000  # characters of a word that the matcher is spared
_WORDS = regex.compile(PATTERN)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _letters() -> dict[str, int]:
    """The printable stand-ins for bytes in such files: printable Latin-1 bytes
    stand for themselves, the others for code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    out |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    return out


class Vocabulary:
    """Token bytes, ids, merges and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = lambda s: bytes(letters[c] for c in s)
        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.merges = [(self.ids[raw(a)], self.ids[raw(b)], self.ids[raw(a) + raw(b)]) for a, b in pairs]
        made = [m[2] for m in self.merges]
        if made != sorted(made) or len(made) + 256 != len(self.ids):
            raise ValueError("ids of the vocabulary do not follow its merges")
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=self.ids, special_tokens=self.special)
        self.split_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # the matcher's stack is too small for this text
            return self._by_words(text)

    def _by_words(self, text: str) -> np.ndarray:
        out, at = [np.zeros(0, np.uint32)], 0
        special = list(self.split_special.finditer(text)) if self.split_special else []
        for begin, end, token in [(m.start(), m.end(), self.special[m.group()]) for m in special] + [(len(text), len(text), None)]:
            for word in _WORDS.finditer(text, at, begin):
                if word.end() - word.start() > LONG or word.end() == begin or word.end() - at > 100 * LONG:
                    short = word.start() if word.end() - word.start() > LONG else word.end()
                    out.append(self.encoding.encode_to_numpy(text[at:short], disallowed_special=()))
                    if short < word.end():
                        out.append(np.array(self.encoding._core_bpe.encode_single_piece(word.group().encode()), np.uint32))
                    at = word.end()
            if token is not None:
                out.append(np.array([token], np.uint32))
            at = end
        return np.concatenate(out)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]
