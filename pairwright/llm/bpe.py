"""Byte-level BPE by a tokenization automaton.

The automaton reads tokens. It starts as one state that accepts every byte and
returns to itself. Each merge, in order, is a gadget: the arc of the left token now
ends in a copy of its old target that lacks the right token's arc, and a new arc,
the merged token, goes straight to where both arcs led. All arcs of one token end
in the same state, so a state is named by the token before it, and a copy differs
from its original by one missing arc: the table ``missing`` has (token, arc) with the
number of the merge that took the arc away. The state after a merged token began as
the state after its right part at that time. From any state at most one path spells
a given word, the one BPE produces, so the automaton is deterministic over
prefixes: encoding walks it from left to right by table look-ups, keeping for every
prefix the last arc of its path.

Decoding emits the labels of the arcs.

Defined results: a missing text is an empty one, without ids; words of any length are
walked like others; equal rows have equal results and stay rows of their own, whatever
their ids; an empty table gives no rows. Columns other than id and text are not used.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import whole

# How byte-level vocabularies cut a text before merging (a fixed value).
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_WORDS = 250_000


def byte_signs() -> dict[str, int]:
    """Printable stand-ins of the bytes in vocabulary files: printable Latin-1 as it is, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Compiled merges: arcs (tokens) with labels, and states as chains of missing arcs."""

    def __init__(self, vocabulary_json: str):
        file = json.loads(vocabulary_json)
        signs = byte_signs()
        vocabulary = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.label = {
            i: token.encode() if token in self.special else bytes(signs[c] for c in token)
            for token, i in vocabulary.items()
        } | {i: token.encode() for token, i in self.special.items()}
        arc = {self.label[i]: i for token, i in vocabulary.items() if token not in self.special}
        # Every ending of a token's label, with the token that it is or -1: endings of a word are tried until none follows.
        self.endings = {label[start:]: -1 for label in arc for start in range(1, len(label))} | arc
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.missing: dict[tuple[int, int], int] = {}
        for number, merge in enumerate(file["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self._gadget(number, vocabulary[left], vocabulary[right], vocabulary[left + right])
        self.allowed: dict[tuple[int, int], bool] = {}
        self.split = regex.compile(PRE_SPLIT)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _gadget(self, number: int, left: int, right: int, merged: int) -> None:
        if self._lacks(left, right, number):
            return  # the pair never stands side by side by now: the merge changes nothing
        self.parts.setdefault(merged, (left, right, number))
        self.missing.setdefault((left, right), number)

    def _lacks(self, last: int, arc: int, before: int) -> bool:
        """Whether the state after ``last`` had lost ``arc`` before a merge."""
        while True:
            taken = self.missing.get((last, arc))
            if taken is not None and taken < before:
                return True
            if last not in self.parts:
                return False
            _, last, made = self.parts[last]
            before = min(before, made)

    def accepts(self, last: int, arc: int) -> bool:
        """Whether the state after ``last`` has ``arc``.

        It has a merged arc if it had the left part's arc when the merge was made,
        and has not lost the merged arc since.
        """
        known = self.allowed.get((last, arc))
        if known is None:
            known, before, part = True, 1 << 60, arc
            while known:
                known = not self._lacks(last, part, before)
                if part not in self.parts:
                    break
                part, right, before = self.parts[part]
                before += part == right  # of three equal arcs the first two merge, so the doubled arc never follows a single one
            if len(self.allowed) > 4 * CACHE_WORDS:
                self.allowed.clear()
            self.allowed[last, arc] = known
        return known

    def word(self, word: bytes) -> list[int]:
        """The path that spells a word."""
        endings, allowed, accepts, spells = self.endings.get, self.allowed, self.accepts, self._spells
        last = [-1]
        for end in range(1, len(word) + 1):
            found = -1
            for start in range(end - 1, -1, -1):
                token = endings(word[start:end])
                if token is None:
                    break  # no longer token ends like this
                if token < 0:
                    continue
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    known = allowed.get((before, token))
                    if known or (known is None and accepts(before, token)):
                        found = token
                        break
                elif spells(token):
                    found = token
            last.append(found)
        path, end = [], len(word)
        while end:
            path.append(last[end])
            end -= len(self.label[last[end]])
        return path[::-1]

    def _spells(self, token: int) -> bool:
        """Whether the token is reached by merges from its bytes at all."""
        return token in self.parts or len(self.label[token]) == 1

    def _words(self, text: str) -> list[str]:
        return self.split.findall(text)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; special tokens' strings become their ids."""
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        out, place = [], 0
        for match in self.specials.finditer(text):
            out += [self._plain(text[place : match.start()]), self.special[match.group()].to_bytes(4, "little")]
            place = match.end()
        return b"".join([*out, self._plain(text[place:])])

    def _plain(self, text: str) -> bytes:
        words = self._words(text)
        try:
            return b"".join(map(self.young.__getitem__, words))
        except KeyError:
            pass
        young, old = self.young, self.old
        for word in set(words):
            if word not in young:
                ids = old.get(word)
                if ids is None:
                    ids = np.array(self.word(word.encode()), dtype="<u4").tobytes()
                young[word] = ids
        encoded = b"".join(map(young.__getitem__, words))
        if len(young) > CACHE_WORDS:
            self.old, self.young = young, {}
        return encoded

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs in a row, as text."""
        emitted = b"".join(map(self.label.__getitem__, memoryview(ids).cast("I")))
        return emitted.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def automaton(vocabulary_json: str) -> Automaton:
    """The worker's automaton; compiled once, it serves many tasks."""
    return Automaton(vocabulary_json)


def round_trip(docs: DataFrame, vocabulary_json: str, keep: bool = False) -> DataFrame:
    """Encode and decode every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids, decoded``).

    A missing text is an empty one; equal texts have equal ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_json)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * keep

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = machine.encode(text)
                decoded = machine.decode(ids)
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                rows.append((*row, ids, decoded) if keep else row)
            types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()][: 3 + 2 * keep]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names[: 1 + len(arrays)])

    return docs.select("doc_id", whole("text").alias("text")).mapInArrow(code, schema)
