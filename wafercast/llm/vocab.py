"""Splitting texts into the pieces that byte-pair merging works on.

A tokenizer of this kind normalises (NFC, white space, lower case), cuts at
white space and by its pattern, and merges inside pieces only.  No step joins
what white space separates, so a text can be cut at ASCII white space first
and each chunk looked up: a chunk's pieces are worked out once per worker.
Caches are bounded in bytes (``CHUNK_BYTES``, ``PIECE_BYTES``) and skip long chunks.

That holds under the rules stated below.  A file with other rules, such as one
whose pieces contain white space, is read by the library's own normaliser and
pre-tokenizer over the whole text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from .common import ByteCache

CHUNK_BYTES = 160 << 20
PIECE_BYTES = 64 << 20
LONG = 64
#: The pattern of word_bpe_49k.json, for lower-case texts of ASCII
#: and the Latin letters below U+0250, which are their own normal form.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^a-zß-öø-ɏ0-9]+")
_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-įı-ɏ]*").fullmatch


#: The rules of word_bpe_49k.json.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}


def cuts_at_space(tok) -> bool:
    """Whether the tokenizer has the rules stated here."""
    rules = json.loads(tok.to_str())
    steps = (rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    split = {k: steps[0].get(k) for k in ("type", "pattern", "behavior", "invert")}
    return (rules["normalizer"] == _NORMALIZER and len(steps) == 2
            and split == {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
            and {k: steps[1].get(k) for k in _BYTES} == _BYTES)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for a byte: itself if it is printable Latin-1,
    else the next free letter from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return {b: chr(b if b in shown else next(free)) for b in range(256)}


_LETTERS = _byte_letters()


def load_tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class ChunkReader:
    """Maps a text to the values of its chunks: ``of_piece`` gives a piece's
    value, ``of_special`` that of an added token, ``total`` combines them."""

    def __init__(self, tok, of_piece: Callable, of_special: Callable, total: Callable):
        self.tok, self.of_piece, self.of_special, self.total = tok, of_piece, of_special, total
        special = sorted((t.content for t in tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.names = set(special)
        # with added tokens that begin alike, a chunk without that beginning has none of them
        self.mark = special[0][:2].encode() if len({t[:2] for t in special}) == 1 else b""
        self.by_chunk = cuts_at_space(tok)
        self.chunks, self.pieces = ByteCache(CHUNK_BYTES), ByteCache(PIECE_BYTES)

    def _piece(self, piece: str):
        if len(piece) > LONG:
            return self.of_piece(piece)
        got = self.pieces.get(piece, 6 * len(piece))
        return self.pieces.put(piece, self.of_piece(piece), 6 * len(piece)) if got is None else got

    def _word(self, word: str):
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(_LETTERS)
        return self._piece(word)

    def _split(self, text: str):
        normal = self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text
        return [p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(normal)] if self.tok.pre_tokenizer else [normal]

    def _chunk(self, chunk: bytes):
        if len(chunk) > LONG:
            return self._read(chunk)
        got = self.chunks.get(chunk, 4 * len(chunk))
        return self.chunks.put(chunk, self._read(chunk), 4 * len(chunk)) if got is None else got

    def _read(self, chunk: bytes):
        text = chunk.decode("utf-8", "replace")
        # some capitals below U+0250 have their small letter above it
        lower = text.lower()
        if _LATIN(lower) and self.mark not in chunk:
            words = _WORDS.findall(lower)
            return self.total([self._word(w) for w in words])
        return self._whole(text)

    def _whole(self, text: str):
        values = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.names:
                values.append(self.of_special(part))
            elif part:
                values += [self._piece(p) for p in self._split(part)]
        return self.total(values)

    def values(self, text: bytes) -> list:
        if not self.by_chunk:
            return [self._whole(text.decode("utf-8", "replace"))]
        cache, miss = self.chunks, self._chunk
        return [miss(c) if (v := cache.young.get(c)) is None else v for c in text.split()]
