"""Token ids by a byte-level BPE whose files are given by path."""

from __future__ import annotations

import base64
import re

import numpy as np

#: How a pattern may end: a run of whitespace leaves its last character to the word after it. Where no two such
#: characters meet, `PLAIN` in its place matches the same without looking ahead, which is much faster.
AHEAD, PLAIN = r"|\s+(?!\S)|\s+", r"|\s+"
#: Python's whitespace is the regex engine's and four control characters more.
SPACES = re.compile(r"\s\s")


class ByteBpe:
    """Ids as the tokenizer file `json_path` gives them with add_special_tokens=False.

    `ranks_path` holds the same vocabulary as ranks: it yields the same ids several times faster. A text that
    contains a special token's string goes through the tokenizer itself, which cuts at such strings first; one with
    neighbouring whitespace goes by the whole pattern.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str, special: str = "<|endoftext|>"):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        plain = pattern.removesuffix(AHEAD) + PLAIN if pattern.endswith(AHEAD) else pattern
        # without a special token, tiktoken looks for an empty one at each character
        self.whole, self.plain = (tiktoken.Encoding("byte_bpe", pat_str=p, mergeable_ranks=ranks, special_tokens={special: max(ranks.values()) + 1}) for p in (pattern, plain))
        self.json_path, self.special, self.exact = json_path, special, None

    def ids(self, text: str) -> np.ndarray:
        if self.special in text:
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_file(self.json_path)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        bpe = self.whole if SPACES.search(text) else self.plain
        return bpe.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


_loaded: dict[tuple, ByteBpe] = {}


def byte_bpe(json_path: str | None = None, ranks_path: str | None = None) -> ByteBpe:
    """One tokenizer for each Python worker; the paths default to the installed public files."""
    import public_tokenizers

    key = (json_path or public_tokenizers.path("byte_bpe_50k.json"), ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    if key not in _loaded:
        _loaded[key] = ByteBpe(*key, public_tokenizers.PATTERN)
    return _loaded[key]
