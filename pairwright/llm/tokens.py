"""Encoding with a public tokenizer file inside tasks, each distinct word once per worker."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept

CACHE_WORDS = 400_000
CHUNK_BYTES = 4_000_000
_MARKS = ".,;:!?"
_LATIN = re.compile("[A-Za-zÀ-ÖØ-Þß-öø-ÿ]+").fullmatch
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
# Where a word that ends in a letter or digit meets the punctuation in front of a blank.
_BEHIND = r"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~]+)([\t-\r ]|$)"
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _byte_signs() -> dict[int, str]:
    """Latin letters as the signs that byte-level tokenizers write for their bytes.

    Bytes that print stand for themselves; the others are numbered from 256 on.
    """
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printing]
    sign = {b: chr(b) if b in printing else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


_BYTE_SIGNS = _byte_signs()


def read_file(path: str) -> str:
    """A vocabulary file, read by the driver; its text travels to the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    A tokenizer that drops blanks and never looks across them encodes a text as the
    concatenation of its words, so words are encoded once and remembered. If it also
    lowers letters and parts a word from the marks behind it, an unknown word is put
    together from its lower-case stem and its marks. The memory has two generations of
    bounded size; words of the older one move up when met again. Any other tokenizer
    encodes whole texts.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.written = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.by_words = self._splits("it's one, \n two 3", "it's one, \n two 3".split())
        self.by_stems = self.by_words and all(
            self._splits(word, [stem, marks])
            for word, stem, marks in (("It's.", "it's", "."), ("Two3,", "two3", ","), ("aB!?...", "ab", "!?..."), ("É;", "É", ";"), ("7:", "7", ":"))
        )

        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [content.translate(_UPPER) for content in added]
        self.by_marks = self.by_stems and not any(re.search(r"\s", content) for content in added) and all(
            self._splits(f"Ab{marks} é{marks}\t7{marks}", ["ab", marks, "é", marks, "7", marks])
            for marks in (*punctuation, punctuation, ".###", ",'", "&&&")
        )

        sample = [*"abcdefghijklmnopqrstuvwxyzßàéîöøÿ", "straße", "therenon", "élève", "ñqueez", "lowerings", "übermäßig"]
        self.by_model = self.by_stems and hasattr(self.tokenizer.model, "tokenize") and self._modelled(sample) == self._library(sample)

    def _modelled(self, words: list[str]) -> list[bytes]:
        """Lower-case Latin words straight from the merges: nothing else of the tokenizer changes them."""
        tokenize, written = self.tokenizer.model.tokenize, self.written
        signs = (w if w.isascii() else w.translate(_BYTE_SIGNS) for w in words)
        return [b"".join([written[t.id] for t in tokenize(w)]) for w in signs]

    def _splits(self, text: str, parts: list[str]) -> bool:
        return b"".join(self._library(parts)) == self._library([text])[0]

    def _library(self, texts: list[str]) -> list[bytes]:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter((i for ids in encoded for i in ids), "<u4").tobytes()
        ends = list(accumulate(4 * len(ids) for ids in encoded))
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _stem(self, word: str) -> str:
        stem = word.rstrip(_MARKS)
        # Some capitals end in a mark of their own when lowered.
        if not self.by_stems or not stem or not stem.lower()[-1].isalnum():
            return word
        return stem.lower() if _LATIN(stem) else stem

    def _learn(self, words: set[str]) -> None:
        """Enter words that are not in the young generation."""
        if len(self.young) + 2 * len(words) > CACHE_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        parts: dict[str, tuple[str, str]] = {}
        plain: list[str] = []
        strange: set[str] = set()
        for word in words:
            ids = old.get(word)
            if ids is not None:
                young[word] = ids
            elif self.by_model and _PLAIN(word):
                plain.append(word)
            else:
                stem = self._stem(word)
                parts[word] = stem, word[len(stem) :]
                strange.update(parts[word])
        young.update(zip(plain, self._modelled(plain)))
        strange = {part for part in strange if part not in young}
        known = {part: old[part] for part in strange if part in old}
        young.update(known)
        plain = [part for part in strange if part not in known and self.by_model and _PLAIN(part)]
        young.update(zip(plain, self._modelled(plain)))
        listed = [part for part in strange if part not in young]
        young.update(zip(listed, self._library(listed)))
        for word, (stem, marks) in parts.items():
            young[word] = young[stem] + young[marks]

    def encode(self, texts: pa.Array | list[str]) -> Iterator[bytes]:
        """One value per text, in order; works through the texts in chunks of bounded size."""
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        sizes = pc.binary_length(column).to_pylist()
        start = 0
        while start < len(sizes):
            end, size = start, 0
            while end < len(sizes) and (end == start or size + sizes[end] <= CHUNK_BYTES):
                size += sizes[end]
                end += 1
            chunk = column.slice(start, end - start)
            start = end
            if self.by_words:
                yield from self._words(chunk)
            else:
                yield from self._library(chunk.to_pylist())

    def _parted(self, chunk: pa.Array) -> pa.Array:
        """The texts with A-Z lowered and words parted from the marks behind them, where ids stay the same.

        That leaves far fewer different words. Texts with the string of an added token, which
        counts as it is written, stay as they are.
        """
        if not self.by_marks:
            return chunk
        lowered = pc.ascii_lower(chunk)
        if any(pc.any(pc.match_substring(lowered, content)).as_py() for content in self.added):
            return chunk
        return pc.replace_substring_regex(lowered, _BEHIND, r"\1 \2\3")

    def _words(self, chunk: pa.Array) -> Iterator[bytes]:
        """Texts of a chunk by way of its distinct words."""
        # At other blanks than these a word stays whole and the tokenizer parts it.
        split = pc.ascii_split_whitespace(self._parted(chunk))
        coded = split.values.dictionary_encode()
        words = coded.dictionary.to_pylist()
        found = list(map(self.young.get, words))
        if None in found:
            self._learn({word for word, ids in zip(words, found) if ids is None})
            # A generation may have ended; what was found before still holds.
            found = [self.young[word] if ids is None else ids for word, ids in zip(words, found)]
        lengths = np.fromiter(map(len, found), np.int32, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        first = np.cumsum(lengths, dtype=np.int32) - lengths
        places = coded.indices.to_numpy(zero_copy_only=False)
        own = lengths[places]
        ends = np.zeros(len(own) + 1, np.int32)
        np.cumsum(own, out=ends[1:])
        taken = np.repeat(first[places] - ends[:-1], own)
        taken += np.arange(ends[-1], dtype=np.int32)
        flat = memoryview(ids[taken].view(np.uint8))
        bounds = (4 * ends[split.offsets.to_numpy()].astype(np.int64)).tolist()
        del split, coded, words, found, lengths, ids, first, places, own, ends, taken  # while others work with the ids
        for a, b in zip(bounds, bounds[1:]):
            yield bytes(flat[a:b])


def encoder(tokenizer_json: str) -> WordEncoder:
    """The worker's encoder for a tokenizer; it serves many tasks."""
    return kept("encoder", tokenizer_json, lambda: WordEncoder(tokenizer_json))
