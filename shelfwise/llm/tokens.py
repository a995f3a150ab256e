"""Token ids of the public byte-level vocabularies, inside tasks.

``engine`` loads a ``tokenizers`` JSON file of byte-level BPE into tiktoken's encoder: the same pieces, vocabulary and
merge order give the same ids (the tests compare them with the ``tokenizers`` library on whole tables), at a quarter of
its CPU seconds. A string of one of the file's added tokens, such as ``<|endoftext|>``, is one id wherever a text holds
it, as in the library's own encode.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(moved)}


@lru_cache(maxsize=4)
def engine(path: str) -> tiktoken.Encoding:
    """Encoder of a byte-level BPE file; its merges must stand in the order of the ids that they make."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, added = whole["model"], whole.get("added_tokens") or []
    if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: an added token takes its surroundings into account")
    vocab, alphabet = model["vocab"], byte_alphabet()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab[a + b] for a, b in merges]
    if made != sorted(made):
        raise ValueError(f"{path}: merges are not in the order of ids")
    special = {token["content"]: token["id"] for token in added}
    ranks = {bytes(alphabet[c] for c in piece): k for piece, k in vocab.items() if piece not in special}
    return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encoded(text: str, path: str, end: int | None = None) -> np.ndarray:
    """Ids of a whole text as unsigned 32-bit integers, with the end id behind them if one is given."""
    ids = engine(path).encode(text, allowed_special="all")
    if end is not None:
        ids.append(end)
    return np.array(ids, dtype="<u4")
