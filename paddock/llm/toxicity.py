"""A toxicity classifier that is held to score sentences alike when a group's name is swapped.

Features are the words a text holds. Words are counted over all labelled training texts (each
distinct text once); those whose association with the label is strong enough, and all identity
terms, have a weight. Texts never leave the task that reads them: what is joined with the labels is each
text's distinct words as 40-bit hashes, and the strings of the words chosen are read back in a second pass. Training minimises the logistic loss, an L2 penalty, and the squared
difference between a labelled sentence's logit and those of its copies in which identity terms
are swapped for others of the same language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_keys, drop_staged, staged

WORD = re.compile(r"[^\W\d_]+")

# Neutral names of groups, by language.
IDENTITY_TERMS = (
    ("women", "men", "muslims", "christians", "jews", "immigrants", "refugees", "gays", "lesbians", "blacks", "whites"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "homosexuels", "noirs", "blancs"),
    ("frauen", "männer", "muslime", "christen", "juden", "einwanderer", "flüchtlinge", "schwule", "schwarze", "weiße"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "negros", "blancos"),
    ("woman", "man", "muslim", "christian", "jew", "immigrant", "refugee", "gay", "lesbian", "black", "white"),
    ("femme", "homme", "musulman", "chrétien", "juif", "immigré", "réfugié", "homosexuel", "noir", "blanc"),
    ("frau", "mann", "muslim", "christ", "jude", "einwanderer", "flüchtling", "schwuler", "schwarzer", "weißer"),
    ("mujer", "hombre", "musulmán", "cristiano", "judío", "inmigrante", "refugiado", "negro", "blanco"),
)

# Bytes of a word's hash.
HASH = 5


@dataclass(frozen=True)
class ToxicityModel:
    words: dict[str, int]
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        logits = np.array([self.weights[_places(text, self.words)].sum() for text in texts]) + self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _places(text: str, words: dict[str, int]) -> list[int]:
    """The features that the text has, each once."""
    return [words[w] for w in words.keys() & WORD.findall(text.lower())]


def _counterfactuals(text: str, groups: tuple[tuple[str, ...], ...]) -> list[str]:
    """Copies in which each identity term is replaced by each other one of its list, in turn."""
    # A term of several lists belongs to the first.
    follows = {term: (group, i) for group in reversed(groups) for i, term in enumerate(group)}
    low = text.lower()
    longest = max((len(follows[w][0]) for w in WORD.findall(low) if w in follows), default=0)

    def swapped(step: int):
        def swap(match: re.Match) -> str:
            group, i = follows.get(match[0], ((match[0],), 0))
            return group[(i + step) % len(group)]

        return WORD.sub(swap, low)

    return [swapped(step) for step in range(1, longest)]


def _train(texts, labels, shares, words, groups, *, l2, swap_penalty, rounds) -> ToxicityModel:
    """Full-batch gradient descent with per-weight step sizes (Adam); the loss is convex.

    shares: how many training texts each given one of a label stands for.
    """
    y = np.array(labels, float)
    rows = [np.array(_places(t, words), np.int64) for t in texts]
    pairs = [(i, np.array(_places(c, words), np.int64)) for i, t in enumerate(texts) for c in _counterfactuals(t, groups)]
    at, cols = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([*rows, np.empty(0, np.int64)])
    n, size = len(rows), len(words)
    # Each pair is a row of differences between the sentence's features and its copy's.
    own = np.concatenate([*(rows[i] for i, _ in pairs), np.empty(0, np.int64)])
    other = np.concatenate([*(c for _, c in pairs), np.empty(0, np.int64)])
    own_at = np.repeat(np.arange(len(pairs)), [len(rows[i]) for i, _ in pairs])
    other_at = np.repeat(np.arange(len(pairs)), [len(c) for _, c in pairs])
    weight = np.array([shares[label] for label in labels], float)
    weight /= max(1.0, weight.sum())
    theta, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        w, b = theta[:size], theta[size]
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, w[cols], n) + b, -30, 30)))
        g = weight * (p - y)
        gw = np.bincount(cols, g[at], size) + l2 * w
        if pairs:
            gap = np.bincount(own_at, w[own], len(pairs)) - np.bincount(other_at, w[other], len(pairs))
            pull = 2 * swap_penalty * gap / len(pairs)
            gw += np.bincount(own, pull[own_at], size) - np.bincount(other, pull[other_at], size)
        grad = np.append(gw, g.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        step = 0.1 / (1 + 4 * t / rounds)
        theta = theta - step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    w, b = theta[:size], theta[size]
    return ToxicityModel(words, w, float(b))


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word) & ((1 << 8 * HASH) - 1)


class Hashes(dict):
    """Words and their hashes, each computed once; emptied when it holds very many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = _hash(word)
        return self[word]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct words as sorted hashes of HASH bytes."""
    hashes = Hashes()
    for batch in batches:
        packed = []
        for text in batch.column("text").to_pylist():
            codes = np.unique(np.array([hashes[w] for w in set(WORD.findall(text.lower()))], np.uint64))
            packed.append(codes.view(np.uint8).reshape(-1, 8)[:, :HASH].tobytes())
        columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "words"])


def _unpacked(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // HASH, 8), np.uint8)
    wide[:, :HASH] = np.frombuffer(packed, np.uint8).reshape(-1, HASH)
    return wide.view(np.int64).ravel()


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic (a) and other (b) texts of a batch each word stands."""
    for batch in batches:
        toxic = np.asarray(batch.column("toxic")) == 1
        lists = [_unpacked(packed) for packed in batch.column("words").to_pylist()]
        words, place = np.unique(np.concatenate([*lists, np.empty(0, np.int64)]), return_inverse=True)
        marked = np.repeat(toxic, [len(codes) for codes in lists])
        a = np.bincount(place[marked], minlength=len(words))
        b = np.bincount(place[~marked], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(a), pa.array(b)], ["word", "a", "b"])


def _named(chosen: frozenset[int]):
    """The strings of the words whose hashes are chosen."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, told = Hashes(), set()
        for batch in batches:
            found = {w for text in batch.column("text").to_pylist() for w in set(WORD.findall(text.lower())) if hashes[w] in chosen}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found - told), pa.string())], ["word"])
            told |= found

    return name


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    training_rows: int = 20_000,
    least_texts: int = 5,
    least_strength: float = 20.0,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    l2: float = 1e-5,
    swap_penalty: float = 1.0,
    rounds: int = 400,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Learn from the rows of labels (doc_id, toxic) that `labels` holds; the caller holds rows out.

    Words are counted over all of them; the weights are fitted on training_rows rows at most of
    each label, those with the least hash, which is what reaches the driver. A word needs
    least_texts texts and a chi-square of least_strength; all such words have a weight. Texts with contradicting
    labels count as both. Null labels and ids that match no document are passed over. With no row of one label, the score is 0 (no toxic row) or 1.
    """
    marked = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    marked = marked.where("toxic IN (0, 1) AND doc_id IS NOT NULL").distinct()
    keyed = document_keys(docs, id_col, text_col)
    # One document stands for all with its text and label. The joins are by shuffle at every size, and what
    # they move are ids and hashes.
    stands = keyed.select("doc_id", "text_hash").join(marked.hint("merge"), "doc_id")
    stands = staged(stands.groupBy("text_hash", "toxic").agg(F.min("doc_id").alias("doc_id")))
    lists = keyed.mapInArrow(_packed, "doc_id long, text_hash long, words binary")
    name = ["doc_id", "text_hash"]
    train = lists.join(stands.hint("merge"), name).groupBy(*name, "toxic").agg(F.first("words").alias("words"))
    train = staged(train.select("text_hash", "toxic", "words"))
    totals = {row["toxic"]: row["n"] for row in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    drop_staged(stands)
    if not n1 or not n0:
        drop_staged(train)
        return ToxicityModel({}, np.zeros(0), -30.0 if not n1 else 30.0)
    counted = (
        train.select("toxic", "words")
        .mapInArrow(_tallied, "word long, a long, b long")
        .groupBy("word")
        .agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
        .where(F.col("a") + F.col("b") >= least_texts)
    )
    c, d, n = n1 - F.col("a"), n0 - F.col("b"), float(n1 + n0)
    chi = n * F.pow(F.col("a") * d - F.col("b") * c, 2) / ((F.col("a") + F.col("b")) * F.greatest(c + d, F.lit(1.0)) * n1 * n0)
    strong = frozenset(r["word"] for r in counted.where(chi >= least_strength).select("word").collect())
    chosen = {r["word"] for r in keyed.select("text").mapInArrow(_named(strong), "word string").distinct().collect()}
    chosen |= {t for group in groups for t in group}
    words = {w: i for i, w in enumerate(sorted(chosen))}
    by_hash = {_hash(w): w for w in words}
    codes = np.array(sorted(by_hash), np.int64)
    sample = []
    for label in (1, 0):
        part = train.where(F.col("toxic") == label).orderBy(F.xxhash64(F.lit(7), "text_hash"), "text_hash").limit(training_rows)

        def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Only words with a weight travel to the driver.
            for batch in batches:
                kept = [np.intersect1d(_unpacked(packed), codes) for packed in batch.column("words").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([x.tolist() for x in kept], pa.list_(pa.int64()))], ["words"])

        rows = part.select("words").mapInArrow(reduce, "words array<long>").collect()
        sample += [(" ".join(sorted(by_hash[w] for w in r["words"])), label) for r in rows]
    drop_staged(train)
    sample.sort()
    texts, marks = zip(*sample, strict=True)
    shares = {1: max(1.0, n1 / training_rows), 0: max(1.0, n0 / training_rows)}
    return _train(texts, marks, shares, words, groups, l2=l2, swap_penalty=swap_penalty, rounds=rounds)


def score(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, text_hash, score. Null and empty texts score as no words do.

    Repeated rows and null ids are scored like any other; further columns are left out.
    """

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(scores, pa.float64())],
                ["doc_id", "text_hash", "score"],
            )

    return document_keys(docs, id_col, text_col).mapInArrow(rate, "doc_id long, text_hash long, score double")


def held_out(doc_id):
    """The rows whose label is never learnt from; a null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def drop_toxic(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all columns, that score under the threshold.

    Each row is judged by its whole text alone, so repeated rows stay or go together and ids may be null; a null
    text counts as empty. An empty table gives no rows.
    """

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).cast(pa.string()).to_pylist()]
            yield batch.filter(pa.array(model.scores(texts) < threshold))

    return docs.mapInArrow(sieve, docs.schema)
