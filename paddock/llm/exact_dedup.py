"""Exact de-duplication through an extendible-hash index, in DataFrame operations alone.

A directory maps prefixes of the key hash to buckets: it doubles while any bucket is overfull,
where only overfull buckets split. It is stored in pages, one for each owner, a range of keys.
Texts go to the tasks of their owners. There each finds its bucket through the owner's page, is
compared byte by byte with the bucket's texts of the same key, as grouping keys, and different
texts of one key are numbered as a chain. The entries, one for each distinct text, are Parquet
files in the shared folder; a row finds its entry by page, bucket, key and digest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_staged, staged

SPACE = "[\\x20\\x09-\\x0D]+"
HOT_COPIES = 1024  # copies of one text that go to their owner as they are
HOT_KEYS = 100_000  # at most so many keys are told apart as hot; beyond, more copies make one
OWNER_BITS, PAGE_BITS = 12, 8  # a page has one cell while there are few owners, then at most 2 ** PAGE_BITS


@dataclass
class Index:
    """entries: owner, bucket, key, chain, sha, keep_id, group_size; directory: prefix, depth, entries; pages: owner, cells."""

    entries: DataFrame
    directory: DataFrame
    pages: DataFrame
    depth: int
    hash_bits: int

    def drop(self) -> None:
        for part in (self.entries, self.directory, self.pages):
            drop_staged(part)


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def _key(text: Column, hash_bits: int) -> Column:
    return F.xxhash64(text) if hash_bits == 64 else F.shiftright(F.xxhash64(text), 64 - hash_bits)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _texts(docs: DataFrame, id_col: str, text_col: str, hash_bits: int) -> DataFrame:
    text = normalised(docs[text_col])
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("norm")).withColumn(
        "key", _key(F.col("norm"), hash_bits)
    )


def keyed_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """doc_id, key and digest of every row, stored: all that is needed of a row beside its text."""
    return staged(_texts(docs, id_col, text_col, hash_bits).select("doc_id", "key", _digest(F.col("norm")).alias("sha")))


def _prefix(depth: int, hash_bits: int) -> Column:
    """The highest `depth` bits of the key as a number from 0."""
    return F.shiftright("key", hash_bits - depth) + F.lit(1 << (depth - 1))


def _counts(texts: DataFrame, depth: int, hash_bits: int) -> DataFrame:
    prefixes = texts.select(_prefix(depth, hash_bits).alias("prefix"))
    return prefixes.groupBy("prefix").agg(F.count("*").alias("entries")).withColumn("depth", F.lit(depth))


def _directory(texts: DataFrame, entries: int, bucket_entries: int, hash_bits: int) -> tuple[DataFrame, int]:
    """The buckets, (prefix, depth, entries), and the depth of the deepest."""
    # A directory of the first depth has no bucket to spare even if the hash is perfectly even.
    depth = min(hash_bits, max(1, (entries // bucket_entries).bit_length() - 1))
    level = staged(_counts(texts, depth, hash_bits))
    made, full, closed = [level], F.col("entries") > bucket_entries, [level]
    while depth < hash_bits and not (split := level.where(full).select(F.col("prefix").alias("parent"))).isEmpty():
        closed[-1] = level.where(~full)
        depth += 1
        halves = _counts(texts, depth, hash_bits).withColumn("parent", F.floor(F.col("prefix") / 2).cast("long"))
        level = staged(halves.join(split, "parent", "left_semi").drop("parent"))
        made.append(level)
        closed.append(level)
    directory = closed[0]
    for part in closed[1:]:
        directory = directory.unionByName(part)
    directory = staged(directory)
    for part in made:
        drop_staged(part)
    return directory, depth


def _owner_bits(depth: int) -> int:
    return min(depth, max(OWNER_BITS, depth - PAGE_BITS))


def _pages(directory: DataFrame, depth: int) -> DataFrame:
    """(owner, cells): the bucket of each slot of the owner, by name (its depth and prefix), null where there is none."""
    cells = 1 << (depth - _owner_bits(depth))
    width = F.pow(F.lit(2.0), F.lit(depth) - F.col("depth")).cast("long")
    slots = directory.select(
        F.explode(F.sequence(F.col("prefix") * width, (F.col("prefix") + 1) * width - 1)).alias("slot"),
        F.concat_ws(":", "depth", "prefix").alias("bucket"),
    ).select(F.floor(F.col("slot") / cells).cast("long").alias("owner"), F.pmod("slot", F.lit(cells)).cast("int").alias("cell"), "bucket")
    held = slots.groupBy("owner").agg(F.map_from_entries(F.collect_list(F.struct("cell", "bucket"))).alias("held"))
    page = F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda cell: F.try_element_at("held", cell))
    return staged(held.select("owner", page.alias("cells")))


def _owned(keyed: DataFrame, depth: int, hash_bits: int) -> DataFrame:
    return keyed.withColumn("owner", _prefix(_owner_bits(depth), hash_bits))


def _in_buckets(owned: DataFrame, pages: DataFrame, depth: int, hash_bits: int) -> DataFrame:
    """Add the bucket that the owner's page names for the key."""
    cell = F.pmod(_prefix(depth, hash_bits), F.lit(1 << (depth - _owner_bits(depth)))).cast("int")
    return owned.join(pages, "owner").withColumn("bucket", F.get("cells", cell)).drop("cells")


def _entries(texts: DataFrame, size: Column) -> DataFrame:
    """One entry for each text of a bucket, compared on all its bytes; texts of one key form a chain."""
    groups = texts.groupBy("owner", "bucket", "key", "norm").agg(F.min("doc_id").alias("keep_id"), size.alias("group_size"))
    entries = groups.select("owner", "bucket", "key", _digest(F.col("norm")).alias("sha"), "keep_id", "group_size")
    chain = F.row_number().over(Window.partitionBy("owner", "bucket", "key").orderBy(F.asc_nulls_last("keep_id"), "sha"))
    return entries.withColumn("chain", chain)


def build_index(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_entries: int = 1024,
    hash_bits: int = 64,
    rows: DataFrame | None = None,
) -> Index:
    """Write the directory, then group equal texts in their buckets and write the entries.

    rows are the `keyed_rows` of docs, where they are stored already. Copies of a hot text (more than
    HOT_COPIES, and more than one in HOT_KEYS of all rows) are combined in the map tasks first, so
    a text that a third of all rows share reaches its owner as one row for each task. A bucket that is overfull
    when the hash has no bits left stays as it is: its texts chain.
    """
    own = rows is None
    rows = keyed_rows(docs, id_col=id_col, text_col=text_col, hash_bits=hash_bits) if own else rows
    copies = staged(rows.groupBy("key", "sha").agg(F.count("*").alias("copies")))
    total = copies.agg(F.count("*").alias("entries"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
    directory, depth = _directory(copies, total["entries"], bucket_entries, hash_bits)
    pages = _pages(directory, depth)

    texts = _owned(_texts(docs, id_col, text_col, hash_bits), depth, hash_bits)
    hot = staged(copies.where(F.col("copies") > max(HOT_COPIES, total["rows"] // HOT_KEYS)).select("key").distinct())
    some_hot = not hot.isEmpty()
    # At most HOT_KEYS keys of 8 bytes.
    cold = texts.join(F.broadcast(hot), "key", "left_anti") if some_hot else texts
    # The owners' tasks: page, grouping and chain all follow without another exchange.
    entries = _entries(_in_buckets(cold.repartition("owner"), pages, depth, hash_bits), F.count("*"))
    if some_hot:
        combined = texts.join(F.broadcast(hot), "key", "left_semi").groupBy("owner", "key", "norm")
        combined = combined.agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
        combined = _in_buckets(combined.repartition("owner"), pages, depth, hash_bits)
        entries = entries.unionByName(_entries(combined, F.sum("n")))
    entries = staged(entries.sortWithinPartitions("bucket", "key", "chain"))
    for part in (copies, hot, *([rows] if own else [])):
        drop_staged(part)
    return Index(entries, directory, pages, depth, hash_bits)


def look_up(rows: DataFrame, index: Index) -> DataFrame:
    """`keyed_rows` with the entry of each: page, bucket, then the chain's entry of the same digest.

    The rows may be skewed; pages and entries have one row for each key of the joins, so these can be split where they are hot.
    """
    placed = _in_buckets(_owned(rows, index.depth, index.hash_bits), index.pages, index.depth, index.hash_bits).drop("owner")
    return placed.join(index.entries.drop("owner"), ["bucket", "key", "sha"])


def find_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    The smallest id of a group stays; a null id comes last, and stays only where all are null.
    Rows with the same id and text are one document and share one answer. Empty and null texts
    are one group. Other columns are left out; an empty table gives no row.
    """
    rows = keyed_rows(docs, id_col=id_col, text_col=text_col, hash_bits=options.get("hash_bits", 64))
    index = build_index(docs, id_col=id_col, text_col=text_col, rows=rows, **options)
    return look_up(rows, index).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "chain",
    )


def drop_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that stay, with all their columns; of equal rows with one id, one stays."""
    index = build_index(docs, id_col=id_col, text_col=text_col, **options)
    text = normalised(docs[text_col])
    row = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        docs[id_col].cast("long").alias("_id"),
        _key(text, index.hash_bits).alias("_key"),
        _digest(text).alias("_sha"),
    )
    keep = index.entries.select(
        F.col("key").alias("_key"), F.col("sha").alias("_sha"), F.col("keep_id").alias("_id"), "group_size"
    )
    match = [row[c].eqNullSafe(keep[c]) for c in ("_key", "_sha", "_id")]
    kept = row.join(keep, match[0] & match[1] & match[2], "inner").select("_row", keep["_key"], keep["_sha"], "group_size")
    single = kept.where(F.col("group_size") == 1).select("_row")
    # Only rows of real groups can repeat with one id; those alone are grouped once more.
    once = kept.where(F.col("group_size") > 1).groupBy("_key", "_sha").agg(F.first("_row").alias("_row")).select("_row")
    return single.unionByName(once).select("_row.*")
