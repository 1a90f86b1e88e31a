"""The text operators against brute force on one small table with nulls, ties, copies and odd columns."""

from __future__ import annotations

import dataclasses
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paddock.llm import (
    chunk_dedup,
    components,
    decontaminate,
    exact_dedup,
    html_extract,
    jaccard_join,
    packing,
    sharding,
    suffix_dedup,
    token_output,
    toxicity,
)
from paddock.llm.tokens import WordEncoder, short_runs

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, place int, bucket string, start long"


def words(rng, n):
    return " ".join("".join(rng.choice(("an", "the", "or", "li", "ver", "tu", "é")) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = [words(rng, rng.choice((3, 40, 90, 200))) for _ in range(24)]
    shared = words(rng, 120)
    texts = [*base, base[1], base[1] + "\n", None, "", "   ", "one", base[2].replace(" ", "  ", 1)]
    texts += [words(rng, 30) + " " + shared + " " + words(rng, 30) for _ in range(4)]
    changed = base[3].split() + words(rng, 150).split()
    for k in range(4):
        own = list(changed)
        own[10 * k] = f"changed{k}"
        texts.append(" ".join(own))
    texts.append("ab" * 700)
    texts.append(words(rng, 20_000))
    table = [(i * 3, t, 1, "x", 5) for i, t in enumerate(texts)]
    # The same id again, with its text and with another one; null ids.
    return [*table, table[5], (15, "another text of that id", 1, "x", 5), (None, base[4], 1, "x", 5), (None, None, 1, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_repeats_of_400_bytes(docs, rows, empty):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[k : k + 400] for _, b in data for k in range(len(b) - 399))
    expected = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = True
        rest = bytes(x for x, cut in zip(b, gone, strict=True) if not cut)
        n = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expected.append((i, len(b), n, hashlib.sha256(rest).hexdigest()))
    for largest in (4096, 2):  # the second splits nearly every group
        got = [(r.doc_id, r.n_bytes, len(r.spans), r.kept_sha256) for r in suffix_dedup.remove_repeats(docs, largest_group=largest).collect()]
        assert Counter(got) == Counter(expected)
    assert suffix_dedup.remove_repeats(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=12), min_size=1, max_size=20), st.integers(1, 3))
def test_suffix_order_is_that_of_the_bytes(texts, groups):
    group = np.arange(len(texts)) % groups
    data = [t.encode() for t in texts]
    order = suffix_dedup.Suffixes(data, group).order
    keys = [(group[i], data[i]) for i in order]
    assert keys == sorted(keys)


def test_contamination(spark, docs, rows, empty):
    rng = random.Random(8)
    item = words(rng, 60)
    broken = item[:40] + "zz" + item[42:]
    bench = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "", 0), (None, words(rng, 60), 0), (4, "one", 0)], "item_id long, text string, doc_id int")
    extra = [(900, words(rng, 20) + " " + item.upper().replace(" ", "\n") + " end"), (901, broken), (902, item[:20]), (903, None)]
    more = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in extra], SCHEMA)
    for block in (1_000_000, 1):
        found = decontaminate.find_contamination(docs.unionByName(more), bench, block_chars=block)
        pairs = {(r.doc_id, r.item_id): r for r in found.collect()}
        lone = {i for i, t, *_ in rows if t == "one"}
        assert set(pairs) == {(900, 1), (901, 1)} | {(i, 4) for i in lone}
        assert pairs[900, 1].edits == 0 and pairs[900, 1].segments_found == pairs[900, 1].segments
        assert 0 < pairs[901, 1].edits <= 8
    kept = decontaminate.drop_contaminated(more, bench)
    assert kept.columns == more.columns and sorted(r.doc_id for r in kept.collect()) == [902, 903]
    assert decontaminate.find_contamination(empty, bench).count() == 0
    assert decontaminate.drop_contaminated(more, bench.limit(0)).count() == 4


def exact_ids(rows):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(TOKENIZER)
    return [np.array([*full.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for _, t, *_ in rows]


def test_word_encoder_is_exact():
    from tokenizers import Tokenizer

    texts = ["", " ", "It's we've ''s !!'s <|endoftext|> a\x1cb", "ΟΔΟΣ İstanbul é", "日本 テスト 123a", "a\xa0b\x85c", "x’s “q” – …", "\0\x01 ab\x7f ½ ßŉǅ"]
    full = Tokenizer.from_file(TOKENIZER)
    expected = [full.encode(t, add_special_tokens=False).ids for t in texts]
    for most in (1_000_000, 0):
        encoder = WordEncoder(TOKENIZER, most)
        for _ in range(2):
            ids, counts = encoder.encode(texts)
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected


def test_texts_are_encoded_in_runs_of_bounded_size():
    texts = ["", "ab", None, "é" * 30, "cde", "", "f" * 9, "g", "h", "i" * 10, ""]
    batches = [pa.RecordBatch.from_pydict({"n": range(len(some)), "text": pa.array(some, pa.string())}) for some in (texts, [], texts[1:])]
    runs = list(short_runs(iter(batches), most=10))
    assert [text for run in runs for text in run.column("text").to_pylist()] == texts + texts[1:]
    assert [n for run in runs for n in run.column("n").to_pylist()] == [*range(11), *range(10)]
    assert all(run.num_rows == 1 or sum(len((t or "").encode()) for t in run.column("text").to_pylist()) <= 10 for run in runs)
    assert len(runs) < len(texts) * 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=400), st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    payload = token_output.pack_segment([7, None], np.array([len(ids), 0]), ids, percentile)
    segment = token_output.Segment(payload)
    assert segment.doc_ids == [7, None] and np.array_equal(segment.read(), ids)
    assert np.array_equal(segment.read(100, 300), ids[100:300])


def test_token_files(spark, docs, rows, empty, tmp_path):
    path = str(tmp_path / "tokens")
    token_output.write_tokens(docs, path, TOKENIZER, segment_ids=500)
    got = token_output.read_tokens(spark, path).collect()
    ids = exact_ids(rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (row[0], len(x), zlib.crc32(x)) for row, x in zip(rows, ids, strict=True)
    )
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    token_output.write_tokens(empty, path + "0", TOKENIZER)
    assert token_output.read_tokens(spark, path + "0").count() == 0


def test_near_duplicates(docs, rows, empty):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    n, links, root = len(rows), Counter(), list(range(len(rows)))
    for a in range(n):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                old, new = root[a], root[b]
                root = [new if x == old else x for x in root]
    least = defaultdict(list)
    for i, (doc, *_) in enumerate(rows):
        least[root[i]] += [] if doc is None else [doc]
    expected = Counter((rows[i][0], min(least[root[i]], default=None), links[i]) for i in range(n))
    for size in (1024, 2):  # the second extends paths and deals blocks
        got = jaccard_join.near_duplicates(docs, bucket_rows=size).select("doc_id", "class_id", "n_links")
        assert Counter(tuple(r) for r in got.collect()) == expected
    kept = jaccard_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({root[i] for i in range(n) if sets[i]}) + len({rows[i][:2] for i in range(n) if not sets[i]})
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_large_groups_of_near_copies_are_dealt_a_bounded_number_of_times(spark, monkeypatch):
    """Many blocks and tiles give each link once; a row is dealt SPREAD times, whatever the size of its group."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"x{rng.randint(0, 9)}"] + base[k:]) for k in (rng.randint(0, 60) for _ in range(300))]
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for t in texts)]
    links = [sum(i != j and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dealt = []
    blocked = jaccard_join._blocked

    def watched(df, blocks, key):
        dealt.append((blocks.agg(F.max("_blocks")).first()[0], key))
        return blocked(df, blocks, key)

    monkeypatch.setattr(jaccard_join, "_blocked", watched)
    for most in (32, 2):
        monkeypatch.setattr(jaccard_join, "BLOCK_TILES", most)
        dealt.clear()
        got = jaccard_join.near_duplicates(docs, bucket_rows=16).select("doc_id", "class_id", "n_links").collect()
        assert sorted(tuple(r) for r in got) == [(i, 0, n) for i, n in enumerate(links)]
        classes = len({t for t in map(tuple, map(sorted, sets))})
        assert dealt[-1] == (max(8, -(-classes // (most * 8))), "root")


def test_filter_of_wanted_texts(spark, monkeypatch):
    """Every wanted hash passes, negative ones and the ends of pieces too; of the others few, or many where it is full."""
    rng = random.Random(3)
    hashes = [0, 1, -1, 32767, 32768, 32769, 2**26, 2**63 - 1, -(2**63)] + [rng.randint(-(2**63), 2**63 - 1) for _ in range(2000)]
    keyed = spark.createDataFrame([(h, "t") for h in hashes], "text_hash long, text string")
    wanted = spark.createDataFrame([(h,) for h in hashes[:500]], "_hash long")
    for bits, most in ((1 << 26, 510), (1 << 10, 2009)):
        monkeypatch.setattr(jaccard_join, "FILTER_BITS", bits)
        got = [r.text_hash for r in jaccard_join.likely(keyed, wanted).collect()]
        assert set(hashes[:500]) <= set(got) and len(got) == len(set(got)) <= most
    assert jaccard_join.likely(keyed, wanted.limit(0)).isEmpty()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(40, 41), (42, 41), (50, 50)] + [(60, k) for k in range(61, 90)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 41: 40, 42: 40, **{k: 60 for k in range(60, 90)}}


def test_shards(spark, docs, rows, empty, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, shards=4, bucket_rows=7)
    got = sharding.read_shards(spark, path).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t or "") for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 4
    sharding.write_shards(docs, path + "2", shards=4, bucket_rows=7)
    again = {(r.doc_id, r.text, r.shard, r.slot) for r in sharding.read_shards(spark, path + "2").collect()}
    assert again == {(r.doc_id, r.text, r.shard, r.slot) for r in got}
    sharding.write_shards(empty, path + "0")


def test_fisher_yates_is_even():
    seen = Counter(tuple(sharding.fisher_yates(3, [s])) for s in range(3000))
    assert len(seen) == 6 and all(400 < n < 600 for n in seen.values())


def test_main_text(spark):
    shell = '<html><head><title>No</title><script>var a="</p>";</script></head><body><nav><a href="/">Home</a></nav>{}<footer>&copy; 2020</footer>'
    pages = [shell.format(f"<div class='ad'>Buy {i} now.</div><article><h1>Title {i}</h1><p>One &amp; two,\n three words {i}.<p>More <b>bo</b>ld text here, {i}.</article>") for i in range(30)]
    pages += [None, "", "<p", "<!-- only", shell.format("<article><p>One.</p><div class='comments'><p>A reader says things, at length.</p></div></article>")]
    table = spark.createDataFrame([(i, f"u{i}", p, "t") for i, p in enumerate(pages)] + [(0, None, pages[0], "t")], "page_id long, url string, html string, text string")
    model = html_extract.fit(table)
    got = html_extract.extract(table, model).collect()
    assert len(got) == len(pages) + 1
    expected = {i: f"Title {i} One & two, three words {i}. More bold text here, {i}." for i in range(30)} | {34: "One."}
    assert all(r.text == expected.get(r.page_id, "") and r.n_chars == len(r.text) for r in got)
    nothing = html_extract.fit(table.limit(0))
    assert html_extract.extract(table.limit(0), nothing).count() == 0 and nothing.main_text("<p>x") == ""


def test_chain_finds_main_text_in_other_markup():
    rng, texts = random.Random(1), [words(random.Random(i), 20) + "." for i in range(200)]
    make = lambda: html_extract.varied_page(rng.sample(texts, 5), ["Home", "Log in", *texts[:20]], texts, rng)
    model = html_extract.train([make() for _ in range(300)])
    pages = [make() for _ in range(100)]
    right = [a == b for blocks, labels in pages for a, b in zip(model.label(blocks), labels, strict=True)]
    assert np.mean(right) > 0.95


def test_toxicity(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        # Toxic sentences name one group far more often than others do.
        group = "muslims" if rng.random() < (0.6 if toxic else 0.05) else ""
        rows.append((i, f"{words(rng, 20)} {group} {rng.choice(('idiot', 'scum')) if toxic else ''} {words(rng, 9)}", "a"))
        labels.append((i, 1 if toxic else 0))
    rows += [(1000, None, "a"), (1001, "", "a"), (None, "idiot", "a"), (1002, "many muslims live here", "a"), (1003, "many women live here", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (1000, None), (5000, 1), (None, 1)], "doc_id long, toxic int")
    free, held = toxicity.fit(docs, marks, swap_penalty=0.0), toxicity.fit(docs, marks)
    score = {r.doc_id: r.score for r in toxicity.score(docs, held).collect()}
    assert all((score[i] >= 0.3) == (y == 1) for i, y in labels)
    assert score[1000] == score[1001] < 0.3 and score[None] >= 0.3
    gap = lambda m: abs(np.subtract(*m.scores(["many muslims live here", "many women live here"])))
    assert gap(held) < gap(free) / 2
    kept = toxicity.drop_toxic(docs, held)
    assert kept.columns == docs.columns and kept.count() == 600 - 120 + 4
    assert toxicity.fit(docs, marks.limit(0)).scores(["idiot"]) < 0.3


def test_exact_duplicates(docs, rows, empty):
    import re

    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t, *_ in rows]
    ids = defaultdict(list)
    for (i, *_), t in zip(rows, norm, strict=True):
        ids[t].append(i)
    expected = Counter()
    for (i, *_), t in zip(rows, norm, strict=True):
        keep = min((x for x in ids[t] if x is not None), default=None)
        expected[i, keep, len(ids[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    # Few bits make texts collide, so that chains are walked; small buckets make the directory double.
    for options in ({}, {"hash_bits": 3, "bucket_entries": 2}, {"bucket_entries": 2}):
        got = exact_dedup.find_duplicates(docs, **options).drop("chain")
        assert Counter(tuple(r) for r in got.collect()) == expected
    index = exact_dedup.build_index(docs, bucket_entries=4)
    assert index.depth >= 3 and max(r.entries for r in index.directory.collect()) <= 4
    assert index.entries.select("key").distinct().count() == len(ids)
    # Rows find their entries through the directory alone: none without pages, none where a page names other buckets.
    keyed = exact_dedup.keyed_rows(docs)
    assert exact_dedup.look_up(keyed, index).count() == len(rows)
    torn = [index.pages.limit(0), index.pages.withColumn("cells", F.transform("cells", lambda c: F.concat(c, F.lit("0"))))]
    for pages in torn:
        assert exact_dedup.look_up(keyed, dataclasses.replace(index, pages=pages)).isEmpty()
    assert index.entries.groupBy("bucket").count().where("count > 4").isEmpty()
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(ids)
    assert exact_dedup.find_duplicates(empty).count() == exact_dedup.drop_duplicates(empty).count() == 0


def test_exact_duplicates_of_hot_texts_and_pages_of_many_cells(spark, monkeypatch):
    """Hot texts are combined before they reach their owners, pages have many cells: same result, chains and all."""
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 400}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    expected = {(i, groups[t][0], len(groups[t])) for i, t in rows}
    read = lambda **options: {
        (r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.find_duplicates(docs, **options).collect()
    }
    assert read(bucket_entries=8) == expected
    monkeypatch.setattr(exact_dedup, "HOT_COPIES", 100)
    monkeypatch.setattr(exact_dedup, "OWNER_BITS", 2)
    assert read(bucket_entries=8) == expected
    assert read(bucket_entries=8, hash_bits=5) == expected
    pages = exact_dedup.build_index(docs, bucket_entries=8).pages
    assert pages.count() == 4 and pages.where(F.size("cells") < 8).isEmpty()


def test_packing(docs, rows, empty):
    for capacity, bins in ((4096, 4096), (64, 2)):
        got = packing.pack(docs, TOKENIZER, capacity=capacity, open_bins=bins, task_pieces=30).collect()
        expected = Counter()
        for (i, *_), x in zip(rows, exact_ids(rows), strict=True):
            for k in range(0, len(x), capacity):
                expected[i, k // capacity, k, len(x[k : k + capacity]), zlib.crc32(x[k : k + capacity])] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
        filled = defaultdict(list)
        for r in got:
            filled[r.sequence_id].append((r.offset, r.length))
        for parts in filled.values():
            parts.sort()
            assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
            assert sum(n for _, n in parts) <= capacity
    assert packing.pack(empty, TOKENIZER).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_open_bins_fit_best_and_close_the_fullest(sizes):
    bins, space = packing.OpenBins(20, 3), {}
    for size in sizes:
        fitting = [s for s in space.values() if s >= size]
        before = dict(space)
        got, offset = bins.place(size)
        if fitting:
            assert before[got] == min(fitting) and offset == 20 - min(fitting)
        else:
            assert got not in before and offset == 0
            if size < 20 and len(space) >= 3:
                del space[min(space, key=lambda b: (space[b], -b))]
        left = before.get(got, 20) - size
        space.pop(got, None)
        if left:
            space[got] = left
        assert len(space) <= 3 and bins.n_open == len(space)
        assert sorted(space.values()) == sorted(s for s, ids in enumerate(bins.by_space) for _ in ids)
        space = {b: s for s, ids in enumerate(bins.by_space) for b in ids}


def test_chunks(docs, rows, empty):
    got = chunk_dedup.drop_repeats(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, *_ in rows:
        if i is not None and i != 15:
            data, spans = (text or "").encode(), by_id[i].spans or []
            rest, at = b"", 0
            for s in spans:
                rest += data[at : s.start]
                at = s.stop
                assert s.stop - s.start >= 64
            assert bytes(by_id[i].kept) == rest + data[at:]
            rest.decode()
    # Of four documents with one passage of 120 words, three lose most of it; copies all go.
    lost = [sum(s.stop - s.start for s in by_id[3 * k].spans or []) for k in range(31, 35)]
    assert sorted(lost)[0] == 0 and sorted(lost)[1] > 300
    assert len(by_id[0].kept) == by_id[0].n_bytes
    assert chunk_dedup.drop_repeats(empty).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.binary(min_size=600, max_size=900), st.binary(max_size=90))
def test_cuts_come_back_after_an_insertion(data, inserted):
    at = [c for c in chunk_dedup.cuts(np.frombuffer(data, np.uint8), 32)]
    later = chunk_dedup.cuts(np.frombuffer(inserted + data, np.uint8), 32) - len(inserted)
    assert [c for c in at if c > 130] == [c for c in later.tolist() if c > 130]
