"""A benchmark of many blocks: stored block by block, with the answers of a single block."""

import random

from paddock.llm import decontaminate


def test_blocks_are_stored_one_by_one(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(60)) for _ in range(12)]
    benchmark = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in enumerate(texts)] + [(99, "clean")], "doc_id long, text string")
    whole = decontaminate.find_contamination(docs, benchmark)
    parts = decontaminate.find_contamination(docs, benchmark, block_chars=500)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    assert {r.item_id for r in parts.collect()} == set(range(12))
    # No plan holds the blocks any more.
    assert "MapInArrow" not in parts._jdf.queryExecution().toString()
