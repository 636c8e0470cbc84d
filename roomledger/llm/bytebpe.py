"""Byte-level BPE of whole texts, with the merge table of a tokenizers file.

Ordinary texts take the tiktoken library, which is several times as fast as tokenizers and is
given the same vocabulary; texts where the two could differ (letters whose class depends on the
version of Unicode, very long words, special tokens) take tokenizers itself. The first text of
each batch is encoded by both, and a difference is an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import numpy as np

# Fixed value: how this kind of vocabulary cuts a text before merging.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: what is left to the tokenizers library: such letters, and words or blanks of that length
ODD = re.compile(r"[^\t\n\r -~\xa1-ɏ]")
LONG = 1000


def long_run(text: str) -> bool:
    """True if a word or a run of blanks has twice ``LONG`` letters; false if none has LONG."""
    for at in range(0, len(text) - LONG + 1, LONG):
        part = text[at : at + LONG]
        if len(part.split(None, 1)) < 2 and (part.isspace() or not (part[0].isspace() or part[-1].isspace())):
            return True
    return False


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such files: printable ones for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    letters.update((chr(256 + k), b) for k, b in enumerate(rest))
    return letters


class ByteEncoder:
    """Ids of texts for the tokenizers file at ``path``; ``token_bytes`` holds each id's bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.plain_library = Tokenizer.from_file(path)
        self.plain_library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letter = byte_letters()
        self.token_bytes: dict[int, bytes] = {}
        special = {t["id"]: t["content"] for t in content["added_tokens"]}
        for token, i in content["model"]["vocab"].items():
            if i not in special:
                self.token_bytes[i] = bytes(letter[c] for c in token)
        self.special = re.compile("|".join(map(re.escape, special.values()))) if special else None
        self.quick = tiktoken.Encoding(
            path,
            pat_str=CUT,
            mergeable_ranks={b: i for i, b in self.token_bytes.items()},
            special_tokens={s: i for i, s in special.items()},
        )

    def _by_library(self, text: str, special: bool) -> np.ndarray:
        library = self.library if special else self.plain_library
        return np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str, special: bool = True) -> np.ndarray:
        """Ids of a text. Special tokens in it count as such, or else as plain text."""
        if ODD.search(text) or long_run(text) or (special and self.special and self.special.search(text)):
            return self._by_library(text, special)
        return self.quick.encode_to_numpy(text, disallowed_special=())

    def encode_all(self, texts: Sequence[str], special: bool = True) -> list[np.ndarray]:
        found = [self.encode(t, special) for t in texts]
        if texts and not np.array_equal(found[0], self._by_library(texts[0], special)):
            raise ValueError(f"the two libraries differ on {texts[0]!r}")
        return found


_ENCODERS: dict[str, ByteEncoder] = {}


def byte_encoder(path: str) -> ByteEncoder:
    """One encoder for each path and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]
