"""Pre-tokens and ids of a byte-level BPE vocabulary given as a rank file."""

from __future__ import annotations

import base64

import regex
import tiktoken

#: The pattern of this vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A match has looked at this many characters after its end, at most.
LOOKAHEAD = 2
_MEMO = 300_000
_loaded: dict[str, BytePairs] = {}


class BytePairs:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.end = max(ranks.values()) + 1
        # Without special tokens tiktoken searches for the empty string at every character. Texts
        # that hold this one are encoded as any other text, as no special token is allowed.
        special = {"<|endoftext|>": self.end}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.pattern = regex.compile(PATTERN)
        self.counts: dict[str, int] = {}

    def count(self, pretoken: str) -> int:
        found = self.counts.get(pretoken)
        if found is None:
            if len(self.counts) >= _MEMO:
                self.counts.clear()
            found = self.counts[pretoken] = len(self.encoding.encode_ordinary(pretoken))
        return found

    def ids(self, text: str) -> bytes:
        """All ids, as packed uint16."""
        if self.end > 0xFFFF:
            raise ValueError("ids need more than 16 bits")
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u2").tobytes()


def load(path: str) -> BytePairs:
    """The vocabulary, read once per process."""
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]
