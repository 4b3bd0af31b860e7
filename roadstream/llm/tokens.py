"""Token ids by a public tokenizer's file."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

_ENCODERS: dict[str, Callable[[str], np.ndarray]] = {}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids, as ``tokenizers`` gives them for the file without special tokens added.

    A byte-level BPE whose ids are its merge ranks is run by ``tiktoken``, which gives the
    same ids four times as fast; any other file by ``tokenizers`` itself. Each process
    loads a file once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _ranked(path) or _plain(path)
    return _ENCODERS[path]


def _plain(path: str) -> Callable[[str], np.ndarray]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def _byte_of_symbol() -> dict[str, int]:
    """The printable symbols that stand for bytes in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the rest are numbered on from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranked(path: str) -> Callable[[str], np.ndarray] | None:
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    level = {"type": "ByteLevel", "add_prefix_space": False}
    if (
        model.get("type") != "BPE"
        or any(before.get(k) != v for k, v in level.items())
        or not before.get("use_regex", True)
        or spec.get("normalizer")
        or model.get("ignore_merges")
        or model.get("dropout")
    ):
        return None
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])):
        return None
    byte = _byte_of_symbol()
    ids = {token: i for token, i in model["vocab"].items() if token not in special}
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [ids.get("".join(m), -1) for m in merged]
    if -1 in made or made != sorted(made) or len(ids) != 256 + len(made):
        return None
    ranks = {bytes(byte[c] for c in token): i for token, i in ids.items()}
    fast = tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )
    return lambda text: fast.encode_to_numpy(text, allowed_special="all")


def with_end(ids: np.ndarray, end: int = 0) -> np.ndarray:
    """Ids as little-endian unsigned 32-bit numbers, and the id that ends a document."""
    out = np.empty(len(ids) + 1, "<u4")
    out[:-1] = ids
    out[-1] = end
    return out
