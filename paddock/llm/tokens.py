"""Word-cached encoding with a tokenizer of the tokenizers library."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import ragged

# Encoding holds some thirty times a run of texts at once.
RUN_BYTES = 1 << 22


def short_runs(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in turn, in slices of at most so many bytes of text; a longer text stands alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends, start = np.cumsum(np.asarray(lengths), dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _unsafe() -> np.ndarray:
    """Marks the UTF-16 units of characters that libraries may compose, lower or split differently.

    Not marked: ASCII but the separators 0x1C to 0x1F, Latin letters and signs up to U+024F but the
    two wide spaces and the dotted capital I, and the common dashes and quotes.
    """
    marks = np.ones(1 << 16, bool)
    marks[0x20:0x250] = marks[0x00:0x1C] = marks[0x2010:0x2028] = False
    marks[[0x85, 0xA0, 0x130]] = True
    return marks


UNSAFE = _unsafe()


def _is_unsafe(text: str) -> bool:
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    return bool(UNSAFE[units].any()) or "<|" in text


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordEncoder(dict):
    """Encodes texts as the tokenizer file does, each distinct word once.

    No token of this kind of file crosses white space, so a text's ids are the ids of its words
    in turn. The mapping goes from a word to its place in the id store; it is emptied before a
    batch when it holds more than max_words words, which bounds its memory.
    """

    def __init__(self, path: str, max_words: int = 1_000_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.model, self.symbols, self.max_words = self.full.model, byte_symbols(), max_words
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.ids, self.starts, self.lengths = array("I"), array("q"), array("i")

    def __missing__(self, word: str) -> int:
        code, start = len(self.starts), len(self.ids)
        for piece in self.pattern.findall(word):
            if not piece.isascii() or not piece.isprintable():
                piece = "".join(self.symbols[b] for b in piece.encode())
            self.ids.extend([token.id for token in self.model.tokenize(piece)])
        self.starts.append(start)
        self.lengths.append(len(self.ids) - start)
        self[word] = code
        return code

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        if len(self) > self.max_words:
            self.empty()
        whole = {}
        if _is_unsafe("".join(texts)):
            for i, text in enumerate(texts):
                if _is_unsafe(text):
                    whole[i] = np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        lowered = pc.utf8_lower(pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.large_string()))
        words = pc.ascii_split_whitespace(lowered)
        counts = np.diff(np.asarray(words.offsets))
        # Words are looked up once for each batch; empty ones stand before and after white space.
        coded = words.flatten().dictionary_encode()
        known = np.array([self[word] for word in coded.dictionary.to_numpy(zero_copy_only=False)], np.int64)
        codes = known[np.asarray(coded.indices)] if len(known) else np.empty(0, np.int64)
        lengths = np.array(self.lengths, np.int64)[codes] if len(codes) else np.empty(0, np.int64)
        starts = np.array(self.starts, np.int64)[codes] if len(codes) else np.empty(0, np.int64)
        ids = np.frombuffer(self.ids, np.uint32)[ragged(starts, lengths)] if len(codes) else np.empty(0, np.uint32)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        per_text = ends[bounds[1:]] - ends[bounds[:-1]]
        if not whole:
            return ids, per_text
        places = np.concatenate([[0], np.cumsum(per_text)])
        parts = [whole.get(i, ids[places[i] : places[i + 1]]) for i in range(len(texts))]
        return np.concatenate(parts), np.array([len(part) for part in parts], np.int64)

    def encode_ended(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with end_id after each text."""
        ids, counts = self.encode(texts)
        ends = np.cumsum(counts)
        return np.insert(ids, ends, np.uint32(end_id)).astype(np.uint32, copy=False), counts + 1


@cache
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process."""
    return WordEncoder(path)
