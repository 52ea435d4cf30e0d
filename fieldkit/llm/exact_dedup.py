"""Exact duplicates through an extendible-hash index on shared files, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.llm.joins import FEW_ROWS, checked, kept_rows, rows_in
from fieldkit.session import settle

BUCKET_KEYS = 16_384
SALTS = 8

# White space is any run of space, tab, line feed, vertical tab, form feed and carriage return. A
# single space stays as it is, so only other runs are matched.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++"


def normalised(text: Column | str) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                            _RUNS, " ")


def raw_key(text: str) -> Column:
    """A hash of a text as it came; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _prefix(key: str, bits: int) -> Column:
    """The top bits of a key, its cell in a directory of that depth."""
    return F.shiftrightunsigned(F.col(key), 64 - bits) if bits else F.lit(0).cast("bigint")


def directory(keys: DataFrame, total: int, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``depth, bucket``: the buckets of the directory, each a prefix of ``depth`` bits.

    The directory starts with as many cells as ``total`` different keys need. While a bucket holds
    more than ``bucket_keys`` of them, the directory doubles: such buckets split by one more bit and
    the others keep their depth. A round reads only the keys of the buckets that split, and rounds go
    on until all buckets fit, which a key's 64 bits allow.
    """
    depth = max(0, ceil(log2(max(1, total) / bucket_keys)))
    fitting = []
    while True:
        held = settle(keys.groupBy(_prefix("key", depth).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n")), "buckets")
        full = (F.col("n") > bucket_keys) & F.lit(depth < 64)
        fitting.append(held.filter(~full).select(F.lit(depth).alias("depth"), "bucket"))
        split = held.filter(full).select("bucket")
        if split.isEmpty():
            return reduce(DataFrame.unionByName, fitting)
        keys = settle(keys.select("key").withColumn("bucket", _prefix("key", depth))
                      .join(split, "bucket", "left_semi").select("key"), "split-keys")
        depth += 1


def in_buckets(keys: DataFrame, cells: DataFrame, few_buckets: int = FEW_ROWS) -> DataFrame:
    """``keys`` with the ``depth`` and ``bucket`` that a settled directory routes each to."""
    found = []
    for row in cells.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).orderBy("depth").collect():
        here = cells.filter(F.col("depth") == row["depth"])
        here = F.broadcast(here) if row["n"] <= few_buckets else here
        found.append(keys.withColumn("bucket", _prefix("key", row["depth"])).join(here, "bucket"))
    return (reduce(DataFrame.unionByName, found) if found
            else keys.filter(F.lit(False)).withColumns(
                {"bucket": F.lit(0).cast("bigint"), "depth": F.lit(0)}))


def build_index(entries: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The index: one row per key with its bucket and the number of its rows, on shared files.

    ``entries`` has a 64-bit ``key`` per row. Rows of a key are counted before the shuffle, so copies
    do not fill a bucket. The files are dealt by ranges of buckets and keys, one owner task a range,
    and sorted, so a range is read without the others.
    """
    counted = settle(entries.groupBy("key").agg(F.count(F.lit(1)).alias("key_rows")), "key-counts")
    cells = settle(directory(counted, counted.count(), bucket_keys), "directory")
    return settle(in_buckets(counted, cells).repartitionByRange("depth", "bucket", "key")
                  .sortWithinPartitions("depth", "bucket", "key"), "index")


def chains(texts: DataFrame, index: DataFrame, few_keys: int = FEW_ROWS) -> DataFrame:
    """``key, text_sha256, group_size, keep_id``: the different texts of each key that rows share.

    ``texts`` has ``doc_id, key, text``. The index routes the texts of a shared key to the owner of
    its bucket's range; keys go to all tasks while their counted number is at most ``few_keys``, else by
    a shuffle join. Equal texts are first combined, within tasks and then in ``SALTS`` shares, so the
    copies of a text are ``SALTS`` rows at most when they reach its owner. There a key's texts lie in
    the order of their bytes, each is compared with the one before it, and where they differ the next
    text of the chain begins.
    """
    shared = checked(index.filter("key_rows > 1").select("key", "depth", "bucket"), few_keys)
    place = ["depth", "bucket", "key"]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    combined = (texts.join(shared, "key").withColumn("salt", salt)
                .groupBy(*place, "text", "salt")
                .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")))
    owned = combined.repartitionByRange(*place).sortWithinPartitions(*place, "text")
    chain = Window.partitionBy(*place).orderBy("text")
    begins = ~F.col("text").eqNullSafe(F.lag("text").over(chain))
    compared = owned.withColumn("begins", begins).withColumn(
        "link", F.sum(F.col("begins").cast("int")).over(
            chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    told = compared.select("key", "link", "n", "least", F.when(
        F.col("begins"), F.sha2("text", 256)).alias("text_sha256"))
    return told.groupBy("key", "link").agg(
        F.max("text_sha256").alias("text_sha256"), F.sum("n").alias("group_size"),
        F.min("least").alias("keep_id")).drop("link")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 bucket_keys: int = BUCKET_KEYS, few_keys: int = FEW_ROWS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, raw_key`` of every row.

    Texts are equal when they are the same bytes after each run of ASCII white space became one
    space. The row of the smallest id stays, and of rows with the same id and text one stays. A null
    id counts as larger than any other. A null text is an empty one; an empty table gives no rows;
    other columns are not read. ``raw_key`` is a hash of the text as it came.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       raw_key(text_column).alias("raw_key"), F.col(text_column).alias("raw"))
    texts = rows.withColumn("text", normalised("raw")).withColumn("key", F.xxhash64("text"))
    entries = settle(texts.select(
        "doc_id", "raw_key", "key", F.sha2("text", 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row_key")), "entries")
    index = build_index(entries, bucket_keys)
    # Only texts of shared keys are normalised again; they are found by the hash of the text as it came.
    shared = settle(index.filter("key_rows > 1").select("key"), "shared-keys")
    again = settle(entries.join(checked(shared, few_keys), "key", "left_semi")
                   .select("raw_key").distinct(), "shared-texts")
    found = (rows_in(rows, {"raw_key": F.col("raw_key")}, checked(again, few_keys), "left_semi")
             .withColumn("text", normalised("raw")).withColumn("key", F.xxhash64("text")))
    text = ["key", "text_sha256"]
    links = settle(chains(found.select("doc_id", "key", "text"), index, few_keys), "chains")
    stays = settle(entries.join(links, text).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
                   .groupBy(*text).agg(F.first("keep_id").alias("keep_id"),
                                       F.first("group_size").alias("group_size"),
                                       F.min("row_key").alias("keep")), "stays")
    single = entries.join(checked(shared, few_keys), "key", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", "raw_key")
    return single.unionByName(entries.join(stays, text).select(
        "doc_id", "keep_id", "group_size", (F.col("keep") == F.col("row_key")).alias("kept"),
        "text_sha256", "raw_key"))


def exact_survivors(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    bucket_keys: int = BUCKET_KEYS, few_rows: int = FEW_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of a row repeated whole, one.

    The rows that go are looked up by id and text hash, so texts stay where they are while those
    rows are few enough to send to all tasks.
    """
    groups = exact_groups(docs, id_column, text_column, bucket_keys)
    decided = groups.filter("group_size > 1").groupBy("doc_id", "raw_key").agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    key = {"doc_id": F.col(id_column).cast("bigint"), "raw_key": raw_key(text_column)}
    return kept_rows(docs, key, decided, few_rows)


def exact_sql() -> str:
    """DuckDB SQL for the columns of the query."""
    return r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)"""
