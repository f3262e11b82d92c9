"""Token ids of whole texts as the tokenizers library gives them, in Python workers.

A byte-level BPE file may have the same vocabulary as ranks beside it (same name, ending .tiktoken). Where the two
agree token by token, ids are computed from the ranks, which takes a fifth of the time and gives the same ids; the
tests compare both over all code points. A text that the ranks' splitting pattern can't get through (about a million
white-space characters in a row) is encoded by the tokenizers library, as is every text of other tokenizers.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Callable
from functools import cache

import numpy as np

_loaded: dict[str, Callable[[str], np.ndarray]] = {}


def tokenizer_digest(path: str) -> str:
    """The tokenizer's version: the digest of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranks(path: str) -> dict[bytes, int] | None:
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if not path.endswith(".json") or not os.path.exists(ranks_path):
        return None
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or spec["model"].get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    letters, added = _byte_letters(), {t["content"] for t in spec["added_tokens"]}
    try:
        vocabulary = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in added}
    except KeyError:
        return None
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
    return ranks if plain and vocabulary == ranks else None


@cache
def library(path: str) -> Callable[[str], np.ndarray]:
    """The tokenizers library's own encoder."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    return lambda text: np.asarray(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids (uint32); special strings in the text are handled as the library's default."""
    if path in _loaded:
        return _loaded[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    ranks = _ranks(path)
    if ranks is not None:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> np.ndarray:
            try:
                return fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # the pattern's stack is full
                return library(path)(text)
    elif path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)

        def encode(text: str) -> np.ndarray:
            return np.asarray(pieces.encode(text, num_threads=1), dtype=np.uint32)
    else:
        encode = library(path)

    _loaded[path] = encode
    return encode
