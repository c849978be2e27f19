"""Public byte-level BPE vocabularies, read from a folder that is a parameter and never copied."""

from __future__ import annotations

import base64
import os
from functools import cache

import tiktoken

#: Where the vocabulary files are, on every machine.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The free id after the last one of the vocabulary: end of text.
END = 50256

# Fixed value: the pattern that the vocabulary's pre-tokens follow.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def encoding(path: str = f"{FOLDER}/{VOCABULARY}") -> tiktoken.Encoding:
    """The vocabulary, read once by every Python worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
