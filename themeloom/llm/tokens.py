"""Tokenizers inside tasks, loaded once for each Python worker from a path that is a parameter."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np

#: The split pattern and the special token of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = {"<|endoftext|>": 50256}
#: Runs of white space that the regex engine's stack may not hold (it fails from about 1,000,000 on).
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")


@lru_cache(maxsize=2)
def ranked(path: str):
    """The byte-level vocabulary of a rank file; faster than its .json form in tokenizers, and fails on LONG_RUN alone."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
    return tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=END_OF_TEXT)


def _around_runs(held, text: str) -> np.ndarray:
    """Token ids of a text with long runs of white space, each of which is one piece of the split pattern.

    A run's last character belongs to what follows, unless the text or the special string does.
    """
    out, at = [], 0
    for run in LONG_RUN.finditer(text):
        end = run.end()
        if end < len(text) and not text.startswith(tuple(END_OF_TEXT), end):
            end -= 1
        out.append(held.encode_to_numpy(text[at : run.start()], allowed_special="all"))
        out.append(np.array(held._encode_single_piece(text[run.start() : end]), np.uint32))
        at = end
    return np.concatenate([*out, held.encode_to_numpy(text[at:], allowed_special="all")])


def rank_ids(path: str, text: str | None) -> np.ndarray:
    """Token ids as uint32; the special string in a text is the special token, as tokenizers does by default."""
    held = ranked(path)
    try:
        ids = held.encode_to_numpy(text or "", allowed_special="all")
    except ValueError:
        ids = _around_runs(held, text)
    return ids.astype(np.uint32, copy=False)


@lru_cache(maxsize=2)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    held = Tokenizer.from_file(path)
    held.no_truncation()
    held.no_padding()
    return held


def pieces(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all of `most` but the first, which takes what is over."""
    if n <= most:
        return [(0, n)]
    first = n % most or most
    return [(0, first), *((s, most) for s in range(first, n, most))]
