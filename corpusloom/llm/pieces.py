"""Byte-level BPE vocabularies and the pre-tokenisation that goes with them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import regex

# Fixed value: the split pattern of byte-level BPE vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same cuts for texts in a common alphabet, where the classes can be spelled out: about twice as fast.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_COMMON = re.compile(rf" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s0-9{_LETTERS}]+| ?[0-9]+|\s+(?!\S)|\s+")
_UNCOMMON = re.compile("[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ‐-‧]")

DEFAULT_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Place of a tokenizer file; a name without a slash is looked up among the public ones.

    Resolved where it is used, so that each worker opens its own copy.
    """
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def printable_bytes() -> dict[str, int]:
    """Character by which a vocabulary writes each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Splitter:
    """Cuts a text at the special tokens of a vocabulary and, between them, into pieces."""

    def __init__(self, spec: dict):
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self._any = regex.compile(PATTERN).findall

    def split(self, text: str) -> list[str]:
        return self._any(text) if _UNCOMMON.search(text) else _COMMON.findall(text)

    def pieces(self, text: str) -> list[str]:
        """Pieces in order; a special token stands as its own string, which no plain piece can equal."""
        if self._special is None or not self._special.search(text):
            return self.split(text)
        out: list[str] = []
        end = 0
        for m in self._special.finditer(text):
            out += self.split(text[end:m.start()])
            out.append(m.group())
            end = m.end()
        return out + self.split(text[end:])


def load_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def chunks(texts: list[str], max_chars: int) -> Iterator[list[str]]:
    """Runs of texts with about ``max_chars`` characters each; a longer text stands alone."""
    run: list[str] = []
    size = 0
    for text in texts:
        if run and size + len(text) > max_chars:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run
