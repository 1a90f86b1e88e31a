"""Conversation repair, spelling variants and nearest neighbours against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from paddock.llm import conversation_repair, neighbours, spelling
from paddock.llm.queries import ORACLE, QUERIES
from registry.compare import connect, difference

LEGAL = re.compile("(s?(ua)+)?")


def cheapest(turns: list[tuple[str, str, bool, bool]]) -> tuple[int, str, list[str]]:
    """Over all edits of a few turns (role, text, must go, no end): the least (cost, audit) and its lines."""
    best = None
    new = ("", "u", "a", "ua", "au")
    names = {"u": "user", "a": "assistant"}
    for edits in itertools.product(*[("D",) if must else ("D", "K", "u", "a") for *_, must, _ in turns]):
        for added in itertools.product(new, repeat=len(turns) + 1):
            cost, audit, lines = 0, "", []
            for i, extra in enumerate(added):
                cost, audit = cost + 3 * len(extra), audit + "I" * len(extra)
                lines += [names[x] + ":" for x in extra]
                if i == len(turns):
                    break
                role, text, _, endless = turns[i]
                audit += {"D": "D", "K": "K"}.get(edits[i], "R")
                cost += 4 if edits[i] == "D" else (0 if edits[i] == "K" else 3) + 3 * endless
                if edits[i] != "D":
                    lines.append(names.get(edits[i], role) + ":" + text)
            if LEGAL.fullmatch("".join(line[0] for line in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def expected_repair(rows):
    """rows: (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, marked, counts = set(), [], Counter()
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        counts[fault] += 1
        seen.add((role, text))
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = cheapest(marked)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha), lines


TURNS = "conv_id long, turn long, role string, text string, segment int, n string, audit int"


def test_repair_against_all_edits(spark):
    rng = random.Random(4)
    rows, ids = [], [*range(60), None]
    for conv_id in ids:
        for _ in range(rng.randint(0, 4)):
            # Turn numbers thousands apart stand in different segments.
            turn = rng.choice([None, 0, 1, 2, 3, 4096, 9000, 9001, -5000])
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool", ""])
            row = (conv_id, turn, role, rng.choice(["One.", "Two!", "No end", " \t", "", "Trois ? \n"]), 1, "x", 2)
            rows += [row] * rng.choice([1, 1, 1, 2])
    rows = [r for i, r in enumerate(rows) if sum(s[0] == r[0] for s in rows[:i]) < 4]
    rows += [(99, 1, None, None, 1, None, None)]
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    given = spark.createDataFrame([(i,) for i in [*ids, 99]], "conv_id long")
    report = conversation_repair.plan_repairs(turns, given)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.summaries(turns, report).collect()}
    written = defaultdict(list)
    for r in sorted(conversation_repair.repaired(turns, report).collect(), key=lambda r: r["position"]):
        written[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert set(got) == {*ids, 99}
    for conv_id in got:
        own = [(t, " " if role is None else role, " " if text is None else text) for c, t, role, text, *_ in rows if c == conv_id]
        want, lines = expected_repair(own)
        assert got[conv_id] == want, (own, want)
        assert written[conv_id] == lines


def test_repair_of_a_long_conversation_and_of_repeated_rows(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(20_000) if t != 7001]
    rows += [(2, 3, "user", "Same.")] * 5000
    report = conversation_repair.plan_repairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {r["conv_id"]: r for r in report.collect()}
    assert found[1]["gaps"] == 1 and found[1]["illegal"] == 1 and found[1]["cost"] == 3
    # The missing answer is put in; reroling or deleting would break the pairs that follow.
    assert found[1]["audit"] == "K" * 7001 + "I" + "K" * (20_000 - 7002)
    assert found[2]["duplicate"] == 4999 and found[2]["cost"] == 4 * 4999 + 3
    assert found[2]["audit"] == "K" + "D" * 4999 + "I"


def test_repair_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report = conversation_repair.plan_repairs(none, none.select("conv_id"))
    assert report.count() == 0 and conversation_repair.summaries(none, report).count() == 0


def words_by_hand(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    letters = sorted(set("".join(counts)))
    found = {}
    for word, n in counts.items():
        near = {word[:i] + word[i + 1 :] for i in range(len(word))}
        near |= {word[:i] + x + word[i + 1 :] for i in range(len(word)) for x in letters}
        near |= {word[:i] + x + word[i:] for i in range(len(word) + 1) for x in letters}
        near = sorted((w for w in near - {word} if w in counts), key=lambda w: (-counts[w], w))
        form = near[0] if near and counts[near[0]] >= 10 * n else None
        found[word] = (form, n, len(near), counts[form] if form else None)

    def root(word):
        return root(found[word][0]) if found[word][0] else word

    return {(w, form, root(w), n, near, form_n) for w, (form, n, near, form_n) in found.items()}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdeéÀß") for _ in range(rng.randint(6, 11))) for _ in range(60)] + ["x" * 200, "Übergrößen"]
    rows = []
    for i in range(400):
        some = []
        for _ in range(rng.randint(0, 30)):
            word = base[min(int(rng.expovariate(0.15)), len(base) - 1)]
            if rng.random() < 0.1:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "a", "é", word[at] + "b"]) + word[at + 1 :]
            some.append(word.upper() if rng.random() < 0.2 else word)
        rows.append((i, rng.choice([" ", ", ", "1"]).join(some), 5, "x", 1))
    rows += [(None, rows[3][1], 5, "x", 1), (7, None, 5, "x", 1), (8, "", 5, "x", 1), rows[5], rows[5]]
    return [*rows, (900, " ".join(rng.choice(base) for _ in range(30_000)), 5, None, 1)]


@pytest.mark.parametrize("filter_bytes", [16 << 20, 64])
def test_spelling_against_all_edits(spark, texts, filter_bytes):
    docs = spark.createDataFrame(texts, "doc_id long, text string, n long, word string, other int").repartition(4)
    words = spelling.vocabulary(docs)
    got = [tuple(r) for r in spelling.variants(words, filter_bytes=filter_bytes).collect()]
    assert len(got) == len(set(got)) and set(got) == words_by_hand(texts)
    assert any(form for _, form, *_ in got)


def test_spelling_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(docs)).count() == 0


def test_edits_are_found_without_false_negatives():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(3, 70))) for _ in range(300)})
    sizes = Counter(min(len(w), spelling.MOST_LENGTHS) for w in words)
    filters = spelling.Filters(sizes, 1)
    filters.bits = np.zeros((filters.blocks + 1) * spelling.LANES, np.uint64)
    for w in words:
        h = spelling._hashes(spelling._codes([w]))
        for lane, bit in filters.bits_of(h):
            filters.bits[filters.places(h, len(w)) * spelling.LANES + lane.astype(np.int64)] |= bit
    for w in words:
        assert len(filters.holds(spelling._hashes(spelling._codes([w])), len(w), 0)) == 1
    strange = ["".join(rng.choice("xyz") for _ in range(10)) for _ in range(3000)]
    wrong = filters.holds(spelling._hashes(spelling._codes(strange)), 10, 0)
    assert len(wrong) < 100


VECTORS = "vec_id long, embedding array<float>, rank int, bucket string, part int"


def exact(rows, k, usable):
    """query id -> its k nearest (score, id), by brute force on distinct rows."""
    rows = list(dict.fromkeys((i, tuple(v)) for i, v, *_ in rows if usable(v)))
    found = {}
    for i, v in rows:
        if i is not None and i % 20 == 0:
            others = [(-sum(np.float64(np.float32(a)) * np.float64(np.float32(b)) for a, b in zip(v, w, strict=True)), j is None, j or 0, j) for j, w in rows if j != i]
            found[i] = [(-s, j) for s, _, _, j in sorted(others)[:k]]
    return found


def usable(v):
    return v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("scale", [1.0, 250.0])
def test_neighbours_of_odd_rows(spark, scale):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * scale * (1 + i % 3)], 1, "x", 2) for i in range(150)]
    hot = rows[4][1]
    rows += [(1000 + i, hot, 1, "x", 2) for i in range(60)]  # copies: ties go to the smaller id
    rows += [rows[20], rows[20], (None, hot, 1, "x", 2), (None, rows[7][1], 1, "x", 2)]
    rows += [(2000, None, 1, "x", 2), (2020, [], 1, "x", 2), (2040, [0.0] * 8, 1, "x", 2), (2060, [1.0] * 5, 1, "x", 2)]
    rows += [(2080, [float("nan"), *[1.0] * 7], 1, "x", 2), (2100, [float("inf"), *[1.0] * 7], 1, "x", 2), (2120, [None, *[1.0] * 7], 1, "x", 2)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = defaultdict(list)
    for r in sorted(neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = exact(rows, 20, usable)
    assert set(got) == set(want)
    for query, best in want.items():
        assert [j for _, j in got[query]] == [j for _, j in best]
        np.testing.assert_allclose([s for s, _ in got[query]], [s for s, _ in best], rtol=1e-12)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 1.0), (0, 4, 4, 1.0)]
    assert neighbours.nearest(df.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.where("vec_id > 0"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_small_cells_give_the_same_and_recall_is_reached(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16))
    data = (centres[rng.integers(0, 30, 3000)] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "vec_id long, embedding array<float>")
    query = F.col("vec_id") % 20 == 0
    found = {cells: sorted(tuple(r) for r in neighbours.nearest(df, query, bucket_rows=200, cell_rows=cells).collect()) for cells in (4096, 20)}
    assert found[4096] == found[20]
    near = defaultdict(set)
    for q, _, j, _ in found[20]:
        near[q].add(j)
    scores = data[::20].astype(float) @ data.T.astype(float)
    hits = 0
    for n, q in enumerate(range(0, 3000, 20)):
        scores[n, q] = -np.inf
        assert len(near[q]) == 20
        hits += len(near[q] & set(np.argsort(-scores[n], kind="stable")[:20].tolist()))
    assert hits / (20 * 150) >= 0.9


def test_buckets_come_in_order_of_cost():
    costs = np.random.default_rng(3).uniform(0, 5, size=(3, neighbours.SLOTS))
    found = neighbours._cheapest(costs, neighbours.SLOTS**3)
    powers = neighbours.SLOTS ** np.arange(3)
    totals = [sum(costs[i, (key // powers[i]) % neighbours.SLOTS] for i in range(3)) for key in found]
    assert sorted(found) == list(range(neighbours.SLOTS**3)) and np.all(np.diff(totals) > -1e-9)


@pytest.mark.parametrize("name", ["op8_exact_dedup", "op11_conversation_repair", "op12_spelling_variants"])
def test_counterparts(spark, name):
    duck = connect(TESTDATA)
    assert difference(QUERIES[name](spark, TESTDATA).toPandas(), duck.sql(ORACLE[name]).df()) is None


def test_recall_on_the_given_vectors(spark):
    got = defaultdict(set)
    for r in QUERIES["op13_nearest_neighbours"](spark, TESTDATA).collect():
        got[r["query_id"]].add(r["vec_id"])
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{TESTDATA}/embeddings.parquet").collect()}
    hits = 0
    for q in (i for i in rows if i % 20 == 0):
        best = sorted((-float(rows[q] @ v), i) for i, v in rows.items() if i != q)[:20]
        hits += len(got[q] & {i for _, i in best})
    assert set(got) == {i for i in rows if i % 20 == 0} and hits >= 0.9 * 20 * len(got)
