"""Token ids of texts by a byte-level BPE vocabulary file of the ``tokenizers`` library.

Ids are those of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``. Words repeat, so a worker
remembers the ids of space-separated words: with single spaces and line feeds between words, as in most texts, every
pre-token lies inside one word with the white space before it. New words are encoded many at a time by the vocabulary's
ranks; a text with any other white space or a special token's mark goes to the tokenizer whole. Tests hold the two
ways against each other.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Fixed value: the pre-token pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_IRREGULAR = re.compile(r"[^\S \n]|<\||[ \n][ \n]|\A[ \n]|[ \n]\Z|\x00")
CACHE = 300_000  # words a worker remembers
BLOCK = 1 << 20  # characters looked at together


def _bytes_of(vocabulary: dict[str, int], special: set[str]) -> dict[bytes, int]:
    """The vocabulary's tokens as bytes: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens") or []}
        self.whole = Tokenizer.from_file(path)
        ranks = _bytes_of(spec["model"]["vocab"], special)
        self.ranked = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.feed = ranks[b"\n"]
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, block, size = [], [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size > BLOCK:
                out += self._block(block)
                block, size = [], 0
        return out + self._block(block)

    def _block(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        split, new = [], set()
        for text in texts:
            if not text or _IRREGULAR.search(text):
                split.append(None)
                continue
            # a word stands for itself with a space before it; after a line feed or at the start for itself with that
            words = ("\x00" + text).replace("\n", " \n").split(" ")
            found = list(map(known.get, words))
            if None in found:
                new.update(w for w, v in zip(words, found, strict=True) if v is None)
            split.append(words)
        self._learn(new)
        return [self._ids(text) if words is None else b"".join(map(known.__getitem__, words))
                for text, words in zip(texts, split, strict=True)]

    def _ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Encode new words together, a line feed before each; no other pre-token has one."""
        order = list(words)
        if not order:
            return
        body = "".join(["\n" + w[1:] if w[0] in "\x00\n" else "\n " + w for w in order])
        ids = np.array(self.ranked.encode_ordinary(body), "<u4")
        cut = np.flatnonzero(ids == self.feed)
        raw = ids.tobytes()
        for w, a, b in zip(order, cut.tolist(), [*cut[1:].tolist(), len(ids)], strict=True):
            self.known[w] = raw[4 * a: 4 * b] if w[0] == "\n" else raw[4 * a + 4: 4 * b]
