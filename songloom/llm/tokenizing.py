"""Public tokenizers on Spark's workers, one instance for each worker process.

A byte-level BPE file (``.json``) is run by tiktoken, which is four times as fast as the tokenizers
library, over the vocabulary, pattern and special tokens of that same file. Both give the same ids:
the tests compare them over all code points and over random strings. Any other ``.json`` file is run
by tokenizers, and a ``.model`` file by sentencepiece. tiktoken's pattern gives up on runs of white space
of about a million characters; such a text, whole, goes to the tokenizers library instead.
"""

from __future__ import annotations

import hashlib
import json
import os
from contextlib import suppress
from functools import lru_cache

import numpy as np
import public_tokenizers

DEFAULT_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer_version(path: str) -> str:
    """A digest of the tokenizer's file and of how texts are given to it."""
    with open(path, "rb") as file:
        return hashlib.sha256(b"utf-8, null as empty, no added tokens\n" + file.read()).hexdigest()


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes: themselves, or from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 32]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


@lru_cache(maxsize=4)
def _byte_level(path: str):
    import tiktoken

    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    if given["model"]["type"] != "BPE" or (given.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        return None
    if given.get("normalizer") or not all(t["special"] for t in given["added_tokens"]):
        return None
    special = {t["content"]: t["id"] for t in given["added_tokens"] if t["special"]}
    letters = _byte_letters()
    ranks = {
        bytes(letters[c] for c in token): rank
        for token, rank in given["model"]["vocab"].items() if token not in special
    }
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def _by_library(path: str):
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def token_ids(path: str, text: str) -> np.ndarray:
    """All token ids of a whole text, without begin, end or other added tokens."""
    path = path if os.path.exists(path) else tokenizer_path(os.path.basename(path))  # of this worker's own package
    fast = _byte_level(path) if path.endswith(".json") else None
    if fast is not None:
        with suppress(ValueError):
            return fast.encode_to_numpy(text, allowed_special="all")
    return np.array(_by_library(path)(text), np.uint32)
