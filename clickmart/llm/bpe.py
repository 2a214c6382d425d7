"""BPE encoding and decoding (operator 7): a tokenization automaton built from the merges.

The automaton reads tokens, and accepts exactly the token sequences that BPE yields. It
starts as one state with an arc for every byte. Merges are taken in order; the gadget for
the merge of u and v into w, of rank m,

* gives the arcs labelled u a state of their own, from which the arc v is missing,
* adds the arc w to every state that has the arc u, into the state that followed v.

So the arc t is missing after s exactly if some merge (x, a) took it away: x is s or handed
its state on to s by later gadgets (w enters the state of its right part), a is t or was the
left part on which t's arc was built, and the removal came before the hand-on, or the
building, respectively. The construction stores these hand-on and building links with their
ranks; the 50,000-merge table would have 10^9 arcs if it were written out, so an arc is looked
up through the links and then kept in the transition table ``arc``.

A pre-split word is encoded by running all its prefixes through the automaton at once: a
prefix has one accepted path, so one last token per prefix is all the state there is, and a
token extends the path that ends where the token begins if its arc exists there. Which tokens
end at a byte is read from a second table, compiled once from the labels of all arcs: one
state for each beginning of a label, one transition for each byte, and with each state the
labels that end there, longest first. Decoding emits the labels (bytes) of the arcs.

Defined results: null counts as empty (no tokens; the checksums of the empty text); special
tokens of the vocabulary in a text become their ids, as in the tokenizers library; bytes that
aren't UTF-8 decode to the replacement character; rows are independent of each other, so
repeated rows, null ids and other columns change nothing; an empty table gives an empty
result. The tables of words and transitions are emptied at a fixed size, which bounds a
worker's memory and changes no result.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import plain_text, tokenizer_path
from clickmart.llm.words import PATTERN, special_tokens

NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """Letter of the vocabulary file -> byte. Printable bytes stand for themselves; the others
    take the letters from 256 on, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return letters | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """Tokens are numbered as in the vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        letters = byte_letters()
        self.label = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.removed: dict[tuple[int, int], int] = {}  # (x, a): rank at which x's state lost the arc a
        self.state_from: dict[int, tuple[int, int]] = {}  # w: (v, rank) w entered v's state of that time
        self.arc_from: dict[int, tuple[int, int]] = {}  # w: (u, rank) w's arcs were built on u's
        self.token: dict[bytes, int] = {self.label[vocab[c]]: vocab[c] for c in letters if c in vocab}
        for rank, (left, right) in enumerate(merges):
            self._gadget(vocab[left], vocab[right], vocab[left + right], rank)
        self.size = max(self.label, default=0) + 1
        self.arc: dict[int, bool] = {}  # s * size + t: may t follow s, as far as looked up
        self._compile()

    def _compile(self) -> None:
        """The table of label ends: ``step[s]`` maps a byte to the state of the longest
        beginning of a label that the bytes read so far end with (missing: state 0), ``ends[s]``
        holds (length, token) of the labels that end there, longest first."""
        grown: list[dict[int, int]] = [{}]
        own: list[tuple[int, int] | None] = [None]
        for raw, t in self.token.items():
            s = 0
            for byte in raw:
                nxt = grown[s].get(byte)
                if nxt is None:
                    nxt = grown[s][byte] = len(grown)
                    grown.append({})
                    own.append(None)
                s = nxt
            own[s] = (len(raw), t)
        # Breadth first, so the state of the longest shorter ending is complete before it is read.
        shorter, self.ends = [0] * len(grown), [()] * len(grown)
        order = [0]
        for s in order:
            if s:
                mine = (own[s],) if own[s] else ()
                self.ends[s] = mine + self.ends[shorter[s]]
            for byte, child in grown[s].items():
                back = shorter[s]
                while back and byte not in grown[back]:
                    back = shorter[back]
                shorter[child] = grown[back].get(byte, 0) if s else 0
                order.append(child)
        self.step, self._shorter = grown, shorter
        self.read: dict[int, int] = {}  # state * 256 + byte -> next state, as far as looked up

    def _next(self, s: int, byte: int) -> int:
        """Transition of the table of label ends."""
        back = s
        while back and byte not in self.step[back]:
            back = self._shorter[back]
        if len(self.read) > 2_000_000:
            self.read.clear()
        nxt = self.read[s << 8 | byte] = self.step[back].get(byte, 0)
        return nxt

    def _gadget(self, u: int, v: int, w: int, rank: int) -> None:
        if w in self.arc_from:
            raise ValueError("two merges that make the same token aren't supported")
        if self.token.get(self.label[u]) != u or self.token.get(self.label[v]) != v or not self._walk(u, v):
            return  # no state has u followed by v any more: the merge never applies, w has no arc
        self.removed[u, v] = rank
        self.state_from[w] = (v, rank)
        self.arc_from[w] = (u, rank)
        self.token[self.label[w]] = w

    def _walk(self, s: int, t: int) -> bool:
        """May t follow s?"""
        built = []  # t and what its arcs were built on, with the rank of building
        a, limit = t, NEVER
        while True:
            built.append((a, limit))
            if a not in self.arc_from:
                break
            a, limit = self.arc_from[a]
        x, handed = s, NEVER
        while True:
            for a, limit in built:
                m = self.removed.get((x, a), NEVER)
                if m < handed and m <= limit and m < NEVER:  # a gadget builds only after it removed
                    return False
            if x not in self.state_from:
                return True
            x, handed = self.state_from[x]

    def encode(self, word: bytes) -> list[int]:
        """The accepted path that spells ``word``."""
        return self.encode_sorted([word])[0]

    def encode_sorted(self, words: list[bytes]) -> list[list[int]]:
        """The paths of many words. Neighbours that share a prefix share its run through the
        automaton, so sorted words cost little more than their new endings."""
        label, ends, read, follow, arc, walk = self.label, self.ends, self.read, self._next, self.arc, self._walk
        many = self.size
        last, at, before, out = [-1], [0], b"", []  # last token of the path, and state, of each prefix
        for word in words:
            n = len(word)
            same, most = 0, min(n, len(before))
            while same < most and word[same] == before[same]:
                same += 1
            before = word
            del last[same + 1:], at[same + 1:]
            state = at[same]
            for end in range(same + 1, n + 1):
                key = state << 8 | word[end - 1]
                state = read.get(key, -1)
                if state < 0:
                    state = follow(key >> 8, key & 255)
                found = -1
                for size, t in ends[state]:
                    if size < end:
                        s = last[end - size]
                        if s < 0:
                            continue
                        known = arc.get(s * many + t)
                        if known is None:
                            if len(arc) > 2_000_000:
                                arc.clear()
                            known = arc[s * many + t] = walk(s, t)
                        if not known:
                            continue
                    found = t
                    break
                last.append(found)
                at.append(state)
            path = []
            while n:
                if last[n] < 0:
                    raise ValueError("the vocabulary has no path for these bytes")
                path.append(last[n])
                n -= len(label[last[n]])
            out.append(path[::-1])
        return out


class Codec:
    """Whole texts through the automaton, word by word."""

    def __init__(self, path: str, most: int = 1_000_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.special = special_tokens(spec)
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.automaton = Automaton(vocab, merges)
        self.label = self.automaton.label | {i: t.encode() for t, i in self.special.items()}
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.most = most
        self.kept: dict[str, bytes] = {}  # word -> ids, as little-endian 32-bit numbers

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        parts, of = [], []  # plain parts and special tokens, in order, and their texts
        for i, text in enumerate(texts):
            if self.cut is None or not any(s in text for s in self.special):
                parts.append(self.words.findall(text))
                of.append(i)
                continue
            for part in self.cut.split(text):
                parts.append([part] if part in self.special else self.words.findall(part))
                of.append(i)
        kept = self.kept
        new = {w for ws in parts for w in ws if w not in kept}
        if new:
            if len(kept) + len(new) > self.most:
                kept.clear()
                new = {w for ws in parts for w in ws}
            self._learn(new)
        out: list[list[int]] = [[] for _ in texts]
        for i, ws in zip(of, parts, strict=True):
            out[i] += np.frombuffer(b"".join([kept[w] for w in ws]), dtype="<u4").tolist()
        return out

    def _learn(self, words: set[str]) -> None:
        for w in words & self.special.keys():
            self.kept[w] = np.array([self.special[w]], dtype="<u4").tobytes()
        plain = sorted((w.encode("utf-8"), w) for w in words - self.special.keys())
        for (_, w), ids in zip(plain, self.automaton.encode_sorted([raw for raw, _ in plain]), strict=True):
            self.kept[w] = array("I", ids).tobytes()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    """One codec for all tasks of a worker process."""
    return Codec(path)


def _encoded(codec: Codec, texts: pa.Array, most: int = 4_000_000) -> Iterator[list[int]]:
    """Ids of each text, encoded together in groups of about ``most`` characters."""
    group, size = [], 0
    for t in texts:
        group.append(t.as_py())
        size += len(group[-1])
        if size >= most:
            yield from codec.encode_many(group)
            group, size = [], 0
    yield from codec.encode_many(group)


def encode_decode(
    docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    digests: bool = False,
) -> DataFrame:
    """id, ``ids`` and ``decoded`` of every text; with ``digests`` instead their number and
    SHA-256 (``n_tokens``, ``ids_sha256`` of the comma-joined ids, ``decoded_sha256``), so the
    tokens needn't leave the worker."""
    rows = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("text"))
    if digests:
        kinds = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
        made = [pa.int64(), pa.string(), pa.string()]
    else:
        kinds = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}
        made = [pa.list_(pa.int32()), pa.string()]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer or tokenizer_path())
        names: dict[int, str] = {i: str(i) for i in codec.label}
        for b in batches:
            out = []
            for ids in _encoded(codec, b.column("text")):
                decoded = codec.decode(ids)
                if digests:
                    joined = ",".join(map(names.__getitem__, ids))
                    out.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(),
                                hashlib.sha256(decoded.encode()).hexdigest()))
                else:
                    out.append((ids, decoded))
            cols = [pa.array([r[i] for r in out], made[i]) for i in range(len(made))]
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols], names=["id", *kinds])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType),
                           *[T.StructField(c, k) for c, k in kinds.items()]])
    return rows.mapInArrow(of, schema).withColumnRenamed("id", id_col)
