"""Token ids of whole texts from a public byte-level BPE vocabulary.

Words repeat, so the ids of a word with its leading space are kept and texts are put together
from them. That gives the ids of the whole text, because this vocabulary never joins across a
space that stands before a word; texts with other white space after a space, or with the
special token in them, are encoded as a whole. tests/llm compare with the tokenizers library.
"""

from __future__ import annotations

import base64
import re
from array import array

import numpy as np

SPECIAL = "<|endoftext|>"
#: Words, and ids in all, that a process keeps before it starts anew.
KEPT_WORDS, KEPT_IDS = 400_000, 8_000_000
#: Characters of text put together at a time; a longer text is taken alone.
SLICE_CHARS = 2_000_000
_UNSAFE = re.compile(r" \s| $")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of texts, each followed by id 0; ``ranks`` is the path of the vocabulary."""

    def __init__(self, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={SPECIAL: len(table)}
        )
        self._reset()

    def _reset(self) -> None:
        self._index: dict[str, int] = {}
        self._starts, self._lengths = array("q", [0]), array("q", [1])
        self._ids = array("I", [0])  # entry 0: the end of a text

    def _add(self, ids: list[int]) -> int:
        self._starts.append(len(self._ids))
        self._lengths.append(len(ids))
        self._ids.extend(ids)
        return len(self._starts) - 1

    def _entries(self, text: str) -> list[int]:
        if SPECIAL in text or _UNSAFE.search(text):
            return [self._add(self._encoding.encode(text, allowed_special="all")), 0]
        first, *rest = text.split(" ")
        found = list(map(self._index.get, rest))
        if None in found:
            for i, entry in enumerate(found):
                if entry is None:
                    word = rest[i]
                    entry = self._index.get(word)
                    if entry is None:
                        entry = self._index[word] = self._add(self._encoding.encode_ordinary(" " + word))
                    found[i] = entry
        if first:
            found.insert(0, self._add(self._encoding.encode_ordinary(first)))
        found.append(0)
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (little-endian unsigned 32 bit), and where each text begins (and ends)."""
        if len(self._index) > KEPT_WORDS or len(self._ids) > KEPT_IDS:
            self._reset()
        entries: list[int] = []
        ends = [0]
        for text in texts:
            entries += self._entries(text)
            ends.append(len(entries))
        chosen = np.array(entries, np.int64)
        starts, lengths = (np.frombuffer(kept, np.int64)[chosen] for kept in (self._starts, self._lengths))
        after = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(after[-1]) + np.repeat(starts - after[:-1], lengths)
        return np.frombuffer(self._ids, np.uint32)[place].astype("<u4", copy=False), after[ends]


_encoders: dict[str, Encoder] = {}


def encoder(ranks: str) -> Encoder:
    """One encoder per process and vocabulary."""
    if ranks not in _encoders:
        _encoders[ranks] = Encoder(ranks)
    return _encoders[ranks]
