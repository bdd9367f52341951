"""Whole texts to token ids of a byte-level BPE, by way of a bounded cache of words.

Texts are cut into pretokens by the public pattern; each pretoken is encoded once per worker and kept as packed
little-endian 32-bit ids, so that a text's ids are one join of byte strings. The cut uses the `re` module where a text
has only characters whose class all regular-expression engines agree on, and the tokenizer itself on the whole text elsewhere.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from functools import cache

#: Letters and other characters on which the fast cut is exact.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏΑ-ΡΣ-ώА-я一-龥ぁ-ゖァ-ヺ가-힣"
_PLAIN = re.compile(rf"[\t-\r -~ -±´-¸º»¿-ɏ‐-‧€{_LETTERS}]*")
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")


#: The public pretoken pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def _pattern():
    import regex

    return regex.compile(PATTERN)


def words_of(text: str) -> list[str]:
    """The matches of the public pattern."""
    return _WORDS.findall(text) if _PLAIN.fullmatch(text) else _pattern().findall(text)


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


class _Packed(dict):
    """Word to packed ids; started anew when full, so a worker's memory is bounded."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        packed = array("I", self.encode(word.encode())).tobytes()
        self[word] = packed
        return packed


class Packer:
    """Packed ids of texts, equal to those of the tokenizer in `json_path` with add_special_tokens=False."""

    _of: dict[str, Packer] = {}

    def __init__(self, json_path: str, most: int = 400_000):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        ranks = load_ranks(json_path.removesuffix(".json") + ".tiktoken")
        bpe = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.cache = _Packed(bpe._core_bpe.encode_single_piece, most)

    @classmethod
    def at(cls, json_path: str) -> Packer:
        """One packer per worker process."""
        if json_path not in cls._of:
            cls._of[json_path] = cls(json_path)
        return cls._of[json_path]

    def pack(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.cache.__getitem__, _WORDS.findall(text)))
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
