"""Groups spelling variants: every word with the words one edit away, and the far more frequent one of them.

Words that differ by one code point are found by Bloom-guided neighbourhoods. All deletions and
replacements of a word are generated as hashes only (a polynomial hash changes by one term), and
each is looked up in a blocked Bloom filter of the words of its length. Positives alone become
strings and meet the vocabulary in an exact join, which removes the false ones. An insertion is the
deletion seen from the longer word, and a replacement is generated from the smaller word only,
so each near pair is found once.

The filters are broadcast with a size bound: one pass holds filter_bytes at most. A larger
vocabulary is dealt by a second hash into as many parts as it needs, one pass each.

Defined cases: null texts have no words; a null document id counts as an empty string where
occurrences are damaged; an empty table gives no rows; repeated rows are counted as often as they
stand. A word longer than MOST_LENGTHS code points shares its filter with all longer ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, mix, staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}

# Lengths with a filter of their own; bits a word takes in a filter, and bits set for it.
MOST_LENGTHS = 64
BITS_A_WORD, BITS_SET = 16, 6
LANES = 8  # 64-bit lanes of a block, which a word's bits never leave
BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 1 << 64)
VOCABULARY = "word string, n long"


def lowered(run: str) -> str:
    """Only A-Z become lower case."""
    return run.lower() if run.isascii() else run.translate(LOWER)


def misspelt(doc_id: int | None, word: str, one_in: int) -> str:
    """The word as its occurrences in a document are written: one in `one_in` words of a document lack a letter."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word if h % one_in else word[: h % len(word)] + word[h % len(word) + 1 :]


def vocabulary(
    docs: DataFrame, *, least_length: int = 7, least_count: int = 2, one_in: int = 31, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The words of all documents with how often they occur: word, n. A batch's words are added up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: Counter[str] = Counter()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own: Counter[str] = Counter()
                for run, n in Counter(RUN.findall(text)).items():
                    if len(run) >= least_length:
                        own[lowered(run)] += n
                for word, n in own.items():
                    totals[misspelt(doc_id, word, one_in)] += n
            words = [w for w in totals if len(w) >= least_length]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([totals[w] for w in words], pa.int64())], ["word", "n"])

    given = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    counted = given.where("text IS NOT NULL").mapInArrow(count, VOCABULARY)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _codes(words: list[str]) -> np.ndarray:
    """The code points of words of one length (word, place)."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    powers = np.full(length, BASE, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _hashes(codes: np.ndarray) -> np.ndarray:
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def _class(length: int) -> int:
    return min(length, MOST_LENGTHS)


class Filters:
    """One blocked Bloom filter for each length, side by side in one array of blocks; one part of the hashes."""

    def __init__(self, words: dict[int, int], parts: int):
        """words: how many there are of each length."""
        blocks = np.zeros(MOST_LENGTHS + 2, np.int64)
        for length, n in words.items():
            blocks[_class(length)] += n
        self.parts = parts
        self.sizes = np.ceil(blocks * BITS_A_WORD / (64 * LANES * parts)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.bits: np.ndarray | None = None

    @property
    def blocks(self) -> int:
        return int(self.sizes.sum())

    def places(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """The block of each hash among the words of that length."""
        size = np.uint64(max(1, self.sizes[_class(length)]))
        return (mix(hashes, 1) % size).astype(np.int64) + self.starts[_class(length)]

    def of_part(self, hashes: np.ndarray, part: int) -> np.ndarray:
        return mix(hashes, 2) % np.uint64(self.parts) == part

    @staticmethod
    def bits_of(hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The lane and the mask of each bit that is set for a word."""
        mixed = mix(hashes, 3)
        for i in range(BITS_SET):
            here = mixed >> np.uint64(9 * i)
            yield (here >> np.uint64(6)) & np.uint64(LANES - 1), np.uint64(1) << (here & np.uint64(63))

    def holds(self, hashes: np.ndarray, length: int, part: int) -> np.ndarray:
        """The places in `hashes` of those that the filter of that length may hold."""
        if not self.sizes[_class(length)]:
            return np.empty(0, np.int64)
        left = np.flatnonzero(self.of_part(hashes, part)) if self.parts > 1 else np.arange(len(hashes))
        some = hashes[left]
        blocks = self.places(some, length) * LANES
        kept = np.arange(len(left))
        for lane, bit in self.bits_of(some):
            kept = kept[(self.bits[blocks[kept] + lane[kept].astype(np.int64)] & bit[kept]) != 0]
        return left[kept]


def _marks(filters: Filters, part: int):
    """What each word adds to its block: block and lanes."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, words in _by_length(batch.column("word").to_pylist()):
                hashes = _hashes(_codes(words))
                hashes = hashes[filters.of_part(hashes, part)]
                lanes = np.zeros((LANES, len(hashes)), np.uint64)
                for lane, bit in filters.bits_of(hashes):
                    for i in range(LANES):
                        lanes[i] |= np.where(lane == i, bit, np.uint64(0))
                columns = [pa.array(filters.places(hashes, length)), *(pa.array(x.view(np.int64)) for x in lanes)]
                yield pa.RecordBatch.from_arrays(columns, ["block", *(f"lane{i}" for i in range(LANES))])

    return mark


def _by_length(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    yield from groups.items()


def _edits(filters_of, part: int, letters: np.ndarray, at_once: int = 1 << 20):
    """Candidates: each word with those of its deletions and greater replacements that a filter may hold."""

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: Filters = filters_of()
        for batch in batches:
            counts = dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True))
            pairs: list[tuple[str, str]] = []
            for length, words in _by_length(list(counts)):
                step = max(1, at_once // (length * (len(letters) + 1)))
                for first in range(0, len(words), step):
                    some = words[first : first + step]
                    codes = _codes(some)
                    pairs += _deletions(filters, part, some, codes)
                    pairs += _replacements(filters, part, some, codes, letters, at_once)
            columns = [pa.array([a for a, _ in pairs], pa.string()), pa.array([counts[a] for a, _ in pairs], pa.int64())]
            columns.append(pa.array([b for _, b in pairs], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "other"])

    return edit


def _deletions(filters: Filters, part: int, words: list[str], codes: np.ndarray) -> Iterator[tuple[str, str]]:
    terms = codes * _powers(codes.shape[1])
    before = np.cumsum(terms, axis=1) - terms
    after = terms.sum(axis=1, keepdims=True) - before - terms
    hashes = (before + after * np.uint64(UNBASE)).ravel()
    # Taking one of several equal letters in a row gives one word.
    first = np.concatenate([np.ones((len(words), 1), bool), codes[:, 1:] != codes[:, :-1]], axis=1).ravel()
    for place in filters.holds(hashes, codes.shape[1] - 1, part).tolist():
        if first[place]:
            word, i = words[place // codes.shape[1]], place % codes.shape[1]
            yield word, word[:i] + word[i + 1 :]


def _replacements(filters: Filters, part: int, words: list[str], codes: np.ndarray, letters: np.ndarray, at_once: int) -> Iterator[tuple[str, str]]:
    length, powers = codes.shape[1], _powers(codes.shape[1])
    hashes = (codes * powers).sum(axis=1, dtype=np.uint64)
    step = max(1, at_once // (len(words) * len(letters)))  # a very long word takes its places in turns
    for first in range(0, length, step):
        own = codes[:, first : first + step, None]
        changed = hashes[:, None, None] + (letters - own) * powers[None, first : first + step, None]
        greater = np.flatnonzero((letters > own).ravel())
        found = greater[filters.holds(changed.ravel()[greater], length, part)]
        for place in found.tolist():
            i, letter = divmod(place, len(letters))
            number, i = divmod(i, own.shape[1])
            word, i = words[number], first + i
            yield word, word[:i] + chr(int(letters[letter])) + word[i + 1 :]


def near_pairs(words: DataFrame, *, filter_bytes: int = 16 << 20) -> DataFrame:
    """Pairs of words that differ by one inserted, deleted or replaced code point, each once: word, n, other, other_n.

    words: word (distinct), n. filter_bytes bounds what is built, broadcast and collected in one pass.
    """
    spark = words.sparkSession
    lengths = words.groupBy(F.least(F.char_length("word"), F.lit(MOST_LENGTHS)).alias("length")).agg(F.count("*").alias("n"))
    sizes = {row["length"]: row["n"] for row in lengths.collect()}  # MOST_LENGTHS rows at most
    codes = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''").distinct()
    letters = np.array(sorted(ord(row["letter"]) for row in codes.collect()), np.uint64)  # the letters of RUN at most
    # The probing is all work and little data, so it is dealt to more tasks than the words' files make.
    dealt = words.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = max(1, ceil(sum(sizes.values()) * BITS_A_WORD / 8 / filter_bytes))
    found = None
    for part in range(parts):
        filters = Filters(sizes, parts)
        lanes = [f"lane{i}" for i in range(LANES)]
        marked = words.select("word").mapInArrow(_marks(filters, part), ", ".join(["block long", *(f"{x} long" for x in lanes)]))
        table = marked.groupBy("block").agg(*[F.bit_or(x).alias(x) for x in lanes]).toArrow()
        bits = np.zeros((max(1, filters.blocks), LANES), np.uint64)
        for i, lane in enumerate(lanes):
            bits[np.asarray(table["block"]), i] = np.asarray(table[lane]).view(np.uint64)
        filters.bits = bits.ravel()
        sent = spark.sparkContext.broadcast(filters)
        candidates = dealt.mapInArrow(_edits(lambda sent=sent: sent.value, part, letters), "word string, n long, other string")
        candidates = staged(candidates)
        sent.unpersist()
        found = candidates if found is None else found.unionByName(candidates)
    return found.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")


def _roots(forms: DataFrame) -> DataFrame:
    """The end of each word's chain of forms: word, root. A chain's counts grow, so it ends; steps are doubled."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        reached = staged(reached)
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = reached.join(on, "root", "left")
        if further.where("next IS NOT NULL").isEmpty():
            return reached
        reached = further.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, *, times: int = 10, filter_bytes: int = 16 << 20) -> DataFrame:
    """Each word with its form, the root of its chain of forms, and its near words' number: word, form, root, n, n_near, form_n.

    A word's form is the near word of largest n (ties: smallest in code-point order), if it occurs at
    least `times` as often; else null.
    """
    words = staged(words.select("word", "n"))
    pairs = near_pairs(words, filter_bytes=filter_bytes)
    both = F.explode(
        F.array(
            F.struct(F.col("word"), F.col("n"), F.col("other"), F.col("other_n")),
            F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")),
        )
    )
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = pairs.select(both.alias("pair")).select("pair.*").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(near, "word", "left")
    formed = -F.col("best.less") >= times * F.col("n")
    rows = staged(
        rows.select(
            "word",
            F.when(formed, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, -F.col("best.less")).cast("long").alias("form_n"),
        )
    )
    roots = _roots(rows.where("form IS NOT NULL").select("word", "form"))
    result = rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
    return result
