"""Token ids of whole texts.

The ids are those of the tokenizers library for a tokenizer file. For a byte-level BPE whose
merges come in the order of their tokens' ids, the vocabulary is handed to tiktoken, which
gives the same ids in a quarter of the time; any other file, and a text that tiktoken can't
take, goes to the tokenizers library itself. Special tokens are cut out first in both cases.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import lru_cache

import regex

#: Fixed value: the public pre-tokenisation pattern of the byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class TextEncoder:
    """Ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = special_tokens(spec)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.ranks = _ranked(spec, self.special)

    def ids_bytes(self, text: str) -> bytes:
        if self.ranks is None:
            return _packed(self._library(text))
        if self.cut is None or not any(s in text for s in self.special):
            return _packed(self._fast(text))
        ids: list[int] = []
        for part in self.cut.split(text):
            ids += [self.special[part]] if part in self.special else self._fast(part)
        return _packed(ids)

    def _fast(self, text: str) -> list[int]:
        try:
            return self.ranks.encode_ordinary(text)
        except ValueError:  # its pattern engine has a stack limit
            return self._library(text)

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if out.itemsize != 4:
        out = array("L", ids)
    return out.tobytes()


def _ranked(spec: dict, special: dict[str, int]):
    """The file's vocabulary as a tiktoken encoding, if its merges are in the order of ids."""
    import tiktoken

    from clickmart.llm.bpe import byte_letters

    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (
        spec.get("normalizer") is None and model["type"] == "BPE" and not model.get("dropout")
        and not model.get("ignore_merges") and not model.get("byte_fallback")
        and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    )
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    letters = byte_letters()
    if not plain or any(c not in letters for t in vocab for c in t) or any(c not in vocab for c in letters):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab[a + b] for a, b in merges]
    if made != sorted(set(made)) or len(made) + len(letters) != len(vocab):
        return None
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def special_tokens(spec: dict) -> dict[str, int]:
    """Special token -> id, longest first. Only plain ones are supported."""
    tokens = spec.get("added_tokens") or []
    if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in tokens):
        raise ValueError("special tokens that strip or need word borders aren't supported")
    return {t["content"]: t["id"] for t in sorted(tokens, key=lambda t: -len(t["content"]))}


@lru_cache(maxsize=2)
def encoder_of(path: str) -> TextEncoder:
    """One encoder for all tasks of a worker process."""
    return TextEncoder(path)
