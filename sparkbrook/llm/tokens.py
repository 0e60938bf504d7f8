"""Tokenizers behind one small interface, exact and memoised per worker process.

Vocabulary files are parameters: they are read where they are and never copied. Each
Python worker loads a file once and keeps the ids of the words it has met in a bounded
table.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_loaded: dict[tuple[str, str], object] = {}

#: Characters on whose class, case and composition all Unicode versions in use agree.
_PLAIN = re.compile("[\x00-\x1b\x20-ıĳ-ňŊ-žƀ-ɏΑ-ΡΤ-ώЀ-ԯ‐-‧‰-⁞₠-₿←-⇿─-╿、-〃ぁ-ゖァ-ヺ一-龥가-힣]*")
_NUMERIC = re.compile("[\xb2\xb3\xb9\xbc-\xbeİ]")
#: Fixed value: the word pattern of the vocabulary's pre-tokenizer, letters, digits and rest told apart.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def path_of(name: str) -> str:
    """The place of a public vocabulary file; a path is taken as it is."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load(name: str):
    """The tokenizers library's own tokenizer, without truncation and padding."""
    key = ("library", name)
    if key not in _loaded:
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path_of(name))
        found.no_truncation()
        found.no_padding()
        _loaded[key] = found
    return _loaded[key]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: printable Latin-1 for itself, the others from U+0100 up."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranks(name: str, suffix: str = "", end: bytes = b"") -> tuple[dict[bytes, int], dict[str, int]]:
    """Byte strings to ids, with ``suffix`` as ``end``; and the special tokens.

    Ids must rise in the order of the merges, for then the id is the merge's rank.
    """
    with open(path_of(name), encoding="utf-8") as f:
        data = json.load(f)
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    vocab, alphabet, ranks = data["model"]["vocab"], byte_alphabet(), {}
    for token, number in vocab.items():
        if token not in special:
            ends = suffix and token.endswith(suffix) and len(token) > len(suffix)
            ranks[bytes(alphabet[c] for c in (token.removesuffix(suffix) if ends else token))+ (end if ends else b"")] = number
    pairs = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
    merged = [vocab[a + b] for a, b in pairs]
    if merged != sorted(merged):
        raise ValueError(f"{name}: ids don't follow the merges")
    return ranks, special


class WordBpe:
    """Ids of texts under a lower-casing vocabulary with word ends, word by word.

    A word and its ends are one byte piece with 0xFF, which no UTF-8 text holds, in place
    of the end mark; pieces come from a fast encoder by the same ranks. Texts with special
    tokens or with characters that Unicode versions may class differently go through the
    tokenizers library itself.
    """

    LIMIT = 150_000  # about 55 MB, which stay with the worker

    def __init__(self, name: str):
        import tiktoken

        self.name = name
        ranks, self.special = _ranks(name, "</w>", b"\xff")
        self.one = tiktoken.Encoding("word", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.words: dict[str, bytes] = {}

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if _PLAIN.match(text).end() < len(text) or _NUMERIC.search(text) or any(s in text for s in self.special):
            return _pack(load(self.name).encode(text, add_special_tokens=False).ids)
        words = _WORDS.findall(unicodedata.normalize("NFC", text).lower())
        known = self.words
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > self.LIMIT:
                known.clear()
                new = set(words)
            for w in new:
                known[w] = _pack(self.one(w.encode() + b"\xff"))
        return b"".join(map(known.__getitem__, words))


def _pack(ids) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def word_bpe(name: str) -> WordBpe:
    key = ("word", name)
    if key not in _loaded:
        _loaded[key] = WordBpe(name)
    return _loaded[key]
