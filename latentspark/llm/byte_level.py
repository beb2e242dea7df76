"""Byte-level BPE tokenizers of the tokenizers library, with the bytes of every id.

Where its merges are in order of id the same model is run by the tiktoken library, which is several times as fast.
Texts in which the two could part go to the tokenizers library itself: those with characters on whose class
versions of Unicode may differ, and those with very long words or blanks, on which tiktoken is slow.

Ids give back the bytes of the text, so a running sum of their lengths is where each token ends.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

_RUN = 2000              # characters of a word beyond which a text goes to the tokenizers library
_BLANKS = re.compile(r"\s{500}").search
# What the byte-level splitter of the tokenizers library matches, a fixed value.
_MATCHES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Blocks of settled classes: Latin, Cyrillic, dashes and quotes, kana, Chinese, Hangul.
_UNSETTLED = re.compile("[^\0-ɏЀ-џ‐-‧ぁ-ゖァ-ヺ一-龥가-힣]").search


class Pieces:
    """Bytes of every id, in one array."""

    def __init__(self, pieces: list[bytes]):
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after another, and where each ends."""
        length = self.length[ids]
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ends) else 0)
        return self.data[at + np.repeat(self.first[ids] - ends + length, length)], ends


def byte_of_letter() -> dict[str, int]:
    """Bytes by the letters that byte-level vocabularies write for them: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Ids of texts. ``controls`` become tokens of their own; names of other special tokens are plain text without
    ``controls``, and must not stand in texts with them."""

    def __init__(self, tokenizer_json: str, controls: tuple[str, ...] = ()):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.tokenizer.encode_special_tokens = not controls
        self.tokenizer.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in controls])
        self.controls = {c: self.tokenizer.token_to_id(c) for c in controls}
        letters, vocabulary = byte_of_letter(), self.tokenizer.get_vocab()
        pieces = [b""] * (max(vocabulary.values()) + 1)
        named = {*self.special, *controls}
        for piece, i in vocabulary.items():
            pieces[i] = piece.encode() if piece in named or not all(c in letters for c in piece) else bytes(
                map(letters.__getitem__, piece))
        self.pieces = Pieces(pieces)
        self.fast = self._by_ranks(json.loads(tokenizer_json), pieces, named)

    def _by_ranks(self, shape: dict, pieces: list[bytes], named: set[str]):
        import tiktoken

        split, model = shape.get("pre_tokenizer") or {}, shape["model"]
        vocabulary = model.get("vocab", {})
        made = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model.get("merges", [])]
        if shape.get("normalizer") or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get(
                "add_prefix_space") or None in made or made != sorted(made) or len(vocabulary.keys() - named) != 256 + len(set(made)):
            return None
        ranks = {pieces[i]: i for piece, i in vocabulary.items() if piece not in named}
        return tiktoken.Encoding("same", pat_str=_MATCHES, mergeable_ranks=ranks, special_tokens=self.controls)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit integers."""
        out, rest, controls = [b""] * len(texts), [], set(self.controls)
        for k, text in enumerate(texts):
            if self.fast and not _UNSETTLED(text) and max(map(len, text.split()), default=0) <= _RUN and not _BLANKS(text):
                found = self.fast.encode(text, allowed_special=controls, disallowed_special=()) if controls else (
                    self.fast.encode_ordinary(text))
                out[k] = array("I", found).tobytes()
            else:
                rest.append(k)
        for k, one in zip(rest, self.tokenizer.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
            out[k] = array("I", one.ids).tobytes()
        return out
