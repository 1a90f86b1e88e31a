"""The corpus pipeline, stage by stage, on planted cases with nulls, repeats, clashing columns and empty tables."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paddock.llm import toxicity
from paddock.llm.queries import TOKENIZER
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, place string"


def prose(rng, n):
    return " ".join("".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    folder = str(tmp_path_factory.mktemp("corpus"))
    insults = ["vilest", "scumbag", "worthless"]
    benign = [prose(rng, rng.choice((5, 60, 150))) for _ in range(60)]
    toxic = [prose(rng, 30) + " " + " ".join(rng.sample(insults, 2)) + " " + prose(rng, 20) for _ in range(30)]
    passage = prose(rng, 40)
    texts = [*benign, *toxic]
    copies = [benign[5], benign[5].replace(" ", "  ", 1), benign[6].replace(" ", "\t", 3)]
    near = benign[7].split()
    base = prose(rng, 150).split()
    variants = []
    for k in range(3):
        words = list(base)
        words[20 * k + 10] = f"other{k}"
        variants.append(" ".join(words))
    leaked = [prose(rng, 60) + " " + passage + " " + prose(rng, 10)]
    rows = [(i, t, "en", "s", len(t), 3, "x") for i, t in enumerate([*texts, *copies, *variants, *leaked])]
    rows += [(900, None, None, None, None, None, None), (901, "", "en", "s", 0, 1, "x"), (None, prose(rng, 50), "en", "s", 1, 1, "x")]
    rows += [rows[2], (902, prose(rng, 9000), "en", "s", 1, 1, "x")]
    labels = [(i, 1, 0) for i in range(60)] + [(60 + i, 0, 1) for i in range(30)] + [(5, None, None), (None, 1, 1), (4444, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, passage), (1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, {"toxic": range(60, 90), "copies": (90, 91, 92), "near": (93, 94, 95), "leaked": (96,), "near_words": near}


def kept_by(spark, corpus):
    """The rows after each stage, by name, as run() chains them."""
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).checkpoint()
        found[name] = docs
    return found


def test_stages(spark, corpus):
    from paddock.session import shared_folder

    shared_folder(spark)
    folder, rows, planted = corpus
    stages = kept_by(spark, corpus)
    columns = stages["documents"].columns
    ids = {name: sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.select("doc_id").collect()) for name, df in stages.items()}
    for name in ("toxicity", "exact_dedup", "jaccard_join", "decontaminate"):
        assert stages[name].columns == columns

    def gone(before, after):
        return [x for x in ids[before] if x not in set(ids[after])]

    assert {i for _, i in gone("documents", "toxicity")} == set(planted["toxic"])
    # Equal texts keep the smallest id; the repeated row and the empty one beside the null one go.
    assert {i for _, i in gone("toxicity", "exact_dedup")} == {*planted["copies"], 901}
    assert sum(i == (False, 2) for i in ids["exact_dedup"]) == 1
    assert {i for _, i in gone("exact_dedup", "jaccard_join")} >= {94, 95} and (False, 93) in ids["jaccard_join"]
    assert {i for _, i in gone("jaccard_join", "decontaminate")} == set(planted["leaked"])
    # Clean documents all stay: every unplanted id is packed.
    left = set(range(60)) | {93, 902, 900}
    assert {i for null, i in ids["decontaminate"] if not null} == left
    packed = stages["best_fit_packing"].collect()
    assert {r["doc_id"] for r in packed} == left | {None} or {r["doc_id"] for r in packed} == left


def test_packed_tokens_are_those_of_the_texts(spark, corpus):
    folder, rows, _ = corpus
    full = Tokenizer.from_file(TOKENIZER)
    texts = {r[0]: r[1] or "" for r in rows}
    out = corpus_pipeline.run(spark, folder).collect()
    per_doc = {}
    for r in out:
        per_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, pieces in per_doc.items():
        if doc_id is None:
            continue
        tokens = np.array([*full.encode(texts[doc_id], add_special_tokens=False).ids, 1], "<u4")
        pieces.sort(key=lambda r: r["piece"])
        assert [r["start"] for r in pieces] == list(range(0, len(tokens), 4096))
        for r in pieces:
            part = tokens[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096


def test_empty_tables(spark, corpus, tmp_path):
    folder, _, _ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where(F.lit(False)).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_toxicity_is_learnt_as_by_a_plain_program(spark, corpus):
    folder, rows, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    marked = {(r["doc_id"], r["toxic"]) for r in labels.collect() if r["toxic"] is not None and r["doc_id"] is not None}
    texts = {(text or "", toxic) for doc_id, text, *_ in rows for i, toxic in marked if i == doc_id}
    n1, n0 = sum(t for _, t in texts), sum(1 - t for _, t in texts)
    held = [({w for w in re.findall(r"[^\W\d_]+", text.lower())}, toxic) for text, toxic in texts]
    strong = set()
    for word in set().union(*(words for words, _ in held)):
        a, b = sum(t for words, t in held if word in words), sum(1 - t for words, t in held if word in words)
        c, d = n1 - a, n0 - b
        if a + b >= 5 and (n1 + n0) * (a * d - b * c) ** 2 / ((a + b) * max(c + d, 1) * n1 * n0) >= 20:
            strong.add(word)
    terms = {t for group in toxicity.IDENTITY_TERMS for t in group}
    assert set(model.words) == strong | terms and strong
    words = {w: i for i, w in enumerate(sorted(model.words))}
    sample = sorted((" ".join(sorted(set(words) & ws)), toxic) for ws, toxic in held)
    plain = toxicity._train(*zip(*sample, strict=True), {0: 1.0, 1: 1.0}, words, toxicity.IDENTITY_TERMS, l2=1e-5, swap_penalty=1.0, rounds=400)
    np.testing.assert_allclose(model.weights, plain.weights, atol=1e-9)
    assert model.bias == pytest.approx(plain.bias)


def test_swapped_terms_stay_in_their_list():
    copies = toxicity._counterfactuals("a woman and some muslims", toxicity.IDENTITY_TERMS)
    assert "a man and some christians" in copies and not any("muslims" in c for c in copies)
    # A term of two lists is swapped within the first.
    assert "the christian" in toxicity._counterfactuals("the muslim", toxicity.IDENTITY_TERMS)
