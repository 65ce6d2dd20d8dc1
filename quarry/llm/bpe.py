"""Byte-level BPE files of the tokenizers library, run by a faster library.

The ids are those of the file: a byte-level BPE whose merges are numbered in order is fully
given by the rank of every token, which is what ``tiktoken`` takes. ``core`` checks that a
file is of this kind. A mark for the end of a word, if the file has one, becomes a blank,
which no pre-token of such a file holds."""

from __future__ import annotations

import functools
import json
from typing import NamedTuple

import numpy as np


def alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the other bytes, in order, for 256 and up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe(NamedTuple):
    core: object  # tiktoken's core: encode_ordinary(str), encode_single_piece(bytes)
    end: bytes  # what a pre-token has to end with
    ids: np.ndarray  # the file's id of each rank


@functools.cache
def core(path: str, pattern: str) -> Bpe:
    """The BPE of a file; ``pattern`` cuts texts for ``encode_ordinary``."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, suffix, byte = model["vocab"], model.get("end_of_word_suffix") or "", alphabet()

    def raw(token: str) -> bytes:
        ends = suffix and token.endswith(suffix)
        return bytes(byte[c] for c in (token[: -len(suffix)] if ends else token)) + (b" " if ends else b"")

    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocab[a + b] for a, b in pairs]
    if model["type"] != "BPE" or order != sorted(order) or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
        raise ValueError(f"{path} is not a byte-level BPE whose merges are numbered in order")
    single = [t for t in vocab if len(t) == 1 or (suffix and len(t) == 1 + len(suffix) and t.endswith(suffix))]
    found = {raw(t): vocab[t] for t in single} | {raw(a + b): i for (a, b), i in zip(pairs, order)}
    ranked = sorted(found.items(), key=lambda x: x[1])
    ids = [i for _, i in ranked]
    ranks = {t: k for k, (t, _) in enumerate(ranked)}
    if b" " not in ranks:
        ranks[b" "] = len(ranks)  # never an id of its own: a pre-token is more than its end
    encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Bpe(encoding._core_bpe, b" " if suffix else b"", np.array(ids, "<u4"))
