"""Token ids of the public byte-level vocabularies, in bulk."""

from __future__ import annotations

import json
import re
from base64 import b64decode
from collections.abc import Callable
from functools import lru_cache

import numpy as np

FILE = "byte_bpe_50k.json"
#: beyond these letters the two libraries' Unicode tables may differ
PLAIN = re.compile("[^\x00-ԯ‐-‧]")

#: runs of the pattern's white space beyond which its look-ahead would overflow the regex engine's stack
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others for code points from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(path: str) -> tuple[dict[bytes, int], set[str]]:
    """Words and ids of a vocabulary, and its special tokens' strings."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as file:
            return {b64decode(word): int(i) for word, i in map(bytes.split, file)}, set()
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    letters = byte_letters()
    special = {t["content"] for t in model["added_tokens"]}
    words = model["model"]["vocab"].items()
    return {bytes(letters[c] for c in word): i for word, i in words if word not in special}, special


@lru_cache(4)
def encoder(path: str | None = None) -> Callable[[list[str]], list[np.ndarray]]:
    """A function from texts to their ids, for a byte-level vocabulary file.

    `path` is a file's path or the name of a public one. No special tokens are added. Plain
    texts go through tiktoken, which merges the same pairs several times faster than
    `tokenizers`; for a file of the latter, a text with a special token's string or a rare
    script goes through `tokenizers` itself.

    Texts may be of any length. The pattern splits a run of white space before its last
    character, or not at all at the end of the text. So tiktoken gets a run of 10,000 or more
    as one piece without the pattern, and what lies between such runs with it: the same ids.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or FILE
    path = path if "/" in path else public_tokenizers.path(path)
    ranks, special = merge_ranks(path)
    quick = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    piece = tiktoken.Encoding("piece", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(path) if path.endswith(".json") else None
    marked = re.compile("|".join(map(re.escape, sorted(special)))) if special else None

    def ids(text: str) -> np.ndarray:
        if whole and (PLAIN.search(text) or marked and marked.search(text)):
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
        out, at = [], 0
        for run in LONG_BLANKS.finditer(text):
            last = run.end() - (run.end() < len(text))
            out += quick.encode_ordinary(text[at : run.start()])
            out += piece.encode_ordinary(text[run.start() : last])
            at = last
        return np.array(out + quick.encode_ordinary(text[at:]), np.uint32)

    return lambda texts: [ids(t) for t in texts]
