"""What five quality filters remove in every order, from a sparse matrix of documents and words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256
from itertools import count, permutations
from math import factorial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkit.llm.joins import FEW_ROWS, checked
from fieldkit.llm.pieces import groups_of_texts, prepare
from fieldkit.operators.ordering import running_total
from fieldkit.session import settle

FILTERS = "ABCDE"
FEWEST_WORDS = 50
DIFFERENT_PERCENT = 65
CAPITAL_PERCENT = 5
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"
SHARD_CHARS = 1 << 24
SHARD_WORDS = 250_000
SHARD_ROWS = 1 << 16
STRIP_ENTRIES = 1 << 15
BUCKET_BYTES = 1 << 26
BATCH_BYTES = 1 << 22

# A row group is read at once. By itself Parquet looks at its size after 100 rows, large as they are.
_SMALL_GROUPS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(1 << 20),
                 "parquet.enable.dictionary#indices.list.element": "false", "compression": "zstd"}
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHARD_BITS = 33
_ROW = "struct<doc_id:bigint,part:string,c:boolean,d:boolean,digest:binary>"
_ROW_TYPE = pa.struct([("doc_id", pa.int64()), ("part", pa.string()), ("c", pa.bool_()),
                       ("d", pa.bool_()), ("digest", pa.binary())])
_SHARD = (f"shard bigint, rows array<{_ROW}>, indptr array<int>, indices array<int>, data array<int>, "
          "buckets array<struct<bucket:int,words:array<string>>>")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``BATCH_BYTES`` for what runs meanwhile, where the session has not set a size."""
    if spark.conf.get(_ARROW_BYTES, None) is not None:
        yield
        return
    spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_ARROW_BYTES)


class _Shard:
    """Rows of a compressed sparse matrix, and the words that its columns stand for."""

    def __init__(self, number: int):
        self.number = number
        self.place: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.rows: list[list] = [[] for _ in _ROW_TYPE]
        self.counts, self.indices, self.data = [0], [], []
        self.chars = 0

    def add(self, doc_id: int | None, part: str, text: str) -> None:
        raw = text.encode()
        places = np.fromiter(map(self.place.__getitem__, raw.split()), np.int32)
        held, times = np.unique(places, return_counts=True)
        self.indices.append(held)
        self.data.append(times.astype(np.int32))
        self.counts.append(len(held))
        capitals = len(raw) - len(raw.translate(None, CAPITALS))
        row = (doc_id, part, capitals * 100 > len(text) * CAPITAL_PERCENT,
               len(raw.translate(None, SIGNS)) < len(raw), sha256(raw).digest())
        for values, value in zip(self.rows, row, strict=True):
            values.append(value)
        self.chars += len(text)

    def full(self) -> bool:
        return (self.chars >= SHARD_CHARS or len(self.place) >= SHARD_WORDS
                or len(self.indices) >= SHARD_ROWS)

    def batches(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """One row a strip; columns are numbered anew so that words of a bucket are next to each other.

        A strip has the next rows, of ``STRIP_ENTRIES`` entries at most or a single one of more. The
        first one has the words of all.
        """
        words = list(self.place)
        bucket = np.fromiter((crc32(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        column = np.empty(len(words), dtype=np.int32)
        column[order] = np.arange(len(words), dtype=np.int32)
        names, starts = np.unique(bucket[order], return_index=True)
        ends = np.append(starts, len(words)) if len(words) else np.zeros(1, np.int64)
        strings = pa.array([words[i].decode() for i in order.tolist()], pa.string())
        asked = pa.StructArray.from_arrays(
            [pa.array(names, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), strings)],
            names=["bucket", "words"])
        rows = pa.StructArray.from_arrays(
            [pa.array(values, field.type) for values, field in zip(self.rows, _ROW_TYPE, strict=True)],
            fields=list(_ROW_TYPE))
        indptr = np.cumsum(self.counts)
        first = 0
        while first < len(rows):
            last = max(first + 1, int(np.searchsorted(indptr, indptr[first] + STRIP_ENTRIES, "right")) - 1)
            lists = [rows.slice(first, last - first),
                     pa.array(indptr[first:last + 1] - indptr[first], pa.int32()),
                     pa.array(column[np.concatenate(self.indices[first:last])], pa.int32()),
                     pa.array(np.concatenate(self.data[first:last]), pa.int32()),
                     asked if first == 0 else asked.slice(0, 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.number], pa.int64()),
                 *(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
                   for part in lists)],
                names=["shard", "rows", "indptr", "indices", "data", "buckets"])
            first = last


def local_shards(texts: DataFrame, buckets: int) -> DataFrame:
    """``shard, rows, indptr, indices, data, buckets`` of ``doc_id, part, text``: sparse rows.

    A shard holds documents of about ``SHARD_CHARS`` characters, ``SHARD_WORDS`` different words or
    ``SHARD_ROWS`` documents, and more only if its last one has more. It comes in strips, so that no
    row is large, and the first one has its words in ``buckets`` by their hash. ``indices`` are places
    in the shard's words until these are numbered over all shards. ``data`` are how often a document
    holds each word; white space is ASCII's. ``rows`` have the flags that need no words.
    """
    prepare(texts.sparkSession)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << _SHARD_BITS)
        shard = _Shard(next(numbers))
        for batch in batches:
            for start, held in groups_of_texts(batch, "text"):
                names = (batch.column(c).slice(start, len(held)).to_pylist()
                         for c in ("doc_id", "part"))
                for doc_id, part, text in zip(*names, held, strict=True):
                    shard.add(doc_id, part, text)
                    if shard.full():
                        yield from shard.batches(buckets)
                        shard = _Shard(next(numbers))
                        pa.default_memory_pool().release_unused()
        yield from shard.batches(buckets)

    return texts.select("doc_id", "part", "text").mapInArrow(built, _SHARD)


def word_numbers(shards: DataFrame) -> DataFrame:
    """``shard, columns``: the number of each of a shard's words in the dictionary of all shards.

    A bucket's words from all shards are encoded together: each different one gets the next number
    behind those of the buckets before. A shard brings each of its words once, so a word of every
    document is one entry a shard; the sizes of all buckets, one number each, give the offsets.
    """
    def encoded(group: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        words = group.column("words").combine_chunks()
        codes = words.values.dictionary_encode()
        return pa.table({
            "bucket": group.column("bucket"), "shard": group.column("shard"),
            "codes": pa.ListArray.from_arrays(words.offsets, codes.indices.cast(pa.int64())),
            "different": pa.array([len(codes.dictionary)] * group.num_rows, pa.int64())})

    asked = shards.select("shard", F.explode("buckets").alias("at")).select("shard", "at.*")
    coded = settle(asked.groupBy("bucket").applyInArrow(
        encoded, "bucket int, shard bigint, codes array<bigint>, different bigint"), "codes",
        **_SMALL_GROUPS)
    starts, _ = running_total(coded.groupBy("bucket").agg(F.first("different").alias("different")),
                              ["bucket"], "different", "before")
    numbered = coded.join(starts.select("bucket", "before"), "bucket").select(
        "shard", F.struct("bucket", F.transform("codes", lambda c: c + F.col("before"))
                          .alias("numbers")).alias("part"))
    # Each row is one bucket's, so there is nothing to combine before the shuffle.
    return numbered.repartition("shard").groupBy("shard").agg(
        F.flatten(F.array_sort(F.collect_list("part"))["numbers"]).alias("columns"))


def term_matrix(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """``rows, indptr, indices, data`` of a strip, with columns numbered over the whole corpus."""
    found = shards.select("shard", "rows", "indptr", "indices", "data").join(
        numbers, "shard", "left")
    return found.withColumn("indices", F.transform(
        "indices", lambda i: F.get(F.col("columns"), i))).drop("columns", "shard")


def row_sums(matrix: DataFrame) -> DataFrame:
    """``row, words, different`` of a term matrix: sum and number of entries of each of its rows."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pa.default_memory_pool().release_unused()
            for i in range(batch.num_rows):
                rows, indptr, indices, data = (batch.column(c)[i].values for c in (
                    "rows", "indptr", "indices", "data"))
                ends = indptr.to_numpy()
                entries = np.concatenate([[0], np.cumsum(
                    indices.is_valid().to_numpy(zero_copy_only=False), dtype=np.int64)])
                sums = np.concatenate([[0], np.cumsum(data.to_numpy(), dtype=np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(np.diff(sums[ends]), pa.int64()),
                     pa.array(np.diff(entries[ends]), pa.int64())],
                    names=["row", "words", "different"])

    return matrix.select("rows", "indptr", "indices", "data").mapInArrow(
        counted, f"row {_ROW}, words bigint, different bigint")


def failing_filters(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    part_column: str = "source") -> DataFrame:
    """``doc_id, part, fails, n``: rows of each id and part, and a bit for each filter they fail.

    A: under 50 words; B: 100 times its different words are below 65 times its words; C: more than 5
    of 100 code points are A to Z; D: one of ``# $ % & * |``; E: a row with a smaller id holds the
    same text. Bit 0 is A. Rows equal in id, part and text are one with their number ``n``.

    A null text is an empty one. A null id is smaller than none and has no smaller one, so such rows
    never fail E, and rows of the same id do not make each other fail it. A null part is ``''``. An
    empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
                        text.alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    with small_batches(docs.sparkSession):
        shards = settle(local_shards(texts, size // BUCKET_BYTES + 1), "shards", **_SMALL_GROUPS)
        sums = row_sums(term_matrix(shards, word_numbers(shards)))
        few, same = F.col("words") < FEWEST_WORDS, (
            F.col("different") * 100 < F.col("words") * DIFFERENT_PERCENT)
        bits = [few, same, F.col("row.c"), F.col("row.d")]
        fails = sum((flag.cast("int") * (1 << i) for i, flag in enumerate(bits)), F.lit(0))
        rows = settle(sums.select("row.doc_id", "row.part", "row.digest", fails.alias("fails"))
                      .groupBy("doc_id", "part", "digest", "fails")
                      .agg(F.count(F.lit(1)).alias("n")), "filtered")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter(
        "doc_id IS NOT NULL").withColumn("first", F.lit(1 << 4))
    named = rows.filter("doc_id IS NOT NULL").join(first, ["digest", "doc_id"], "left")
    later = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    columns = ["doc_id", "part", "fails", "n"]
    return named.withColumn("fails", F.col("fails") + later).select(columns).unionByName(
        rows.filter("doc_id IS NULL").select(columns))


def audit_orders(profile: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What each filter does at each step of every order, from ``part, fails, good, toxic, n``.

    The profile has a row for each set of failed filters, so it is read instead of the documents and
    each of its rows meets every step of every order.
    """
    steps = []
    for order in permutations(range(len(filters))):
        for step, own in enumerate(order):
            steps.append(("".join(filters[i] for i in order), step + 1, 1 << own,
                          sum(1 << i for i in order[:step])))
    steps = F.array(*[F.struct(F.lit(name).alias("filter_order"), F.lit(step).alias("step"),
                               F.lit(own).alias("own"), F.lit(before).alias("before"))
                      for name, step, own, before in steps])
    met = profile.withColumn("at", F.explode(steps)).select("*", "at.*")
    fails, before = F.col("fails"), F.col("before")
    failing = fails.bitwiseAND(F.col("own")) != 0
    there = fails.bitwiseAND(before) == 0

    def rows(condition: Column, each: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, each).otherwise(0)).cast("bigint")

    first = (factorial(len(filters)) / F.bit_count("fails")).cast("bigint")
    return met.groupBy("part", "filter_order", "step").agg(
        rows(there & ~failing).alias("kept"), rows(there & failing).alias("removed"),
        rows(~there & failing).alias("redundant"), rows(fails == F.col("own")).alias("unique_fails"),
        rows(there & failing & F.col("good")).alias("good_lost"),
        rows(there & failing & F.col("toxic")).alias("toxic_lost"),
        rows(failing, F.when(failing, first) * F.col("n")).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
                  text_column: str = "text", part_column: str = "source",
                  few_rows: int = FEW_ROWS) -> DataFrame:
    """``part, filter_order, step`` and the counts of ``audit_orders`` for all documents.

    ``labels`` has ``doc_id, quality, toxic``; a document is good or toxic where one of its labels
    says 1. Labels without an id, and documents without a label, are neither. Edge cases of documents
    are those of ``failing_filters``; a part that is null and one that is ``''`` are the same part.
    """
    rows = failing_filters(docs, id_column, text_column, part_column)
    known = settle(labels.filter("doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(
            F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")),
        "labels")
    found = rows.join(checked(known, few_rows), "doc_id", "left")
    profile = found.groupBy("part", "fails", F.coalesce("good", F.lit(False)).alias("good"),
                            F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(
                                F.sum("n").alias("n"))
    return audit_orders(settle(profile, "profile"))


def audit_sql() -> str:
    """DuckDB SQL for the columns of the query."""
    return r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
known AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         {'A': len(words) < 50,
          'B': 100 * len(list_distinct(words)) < 65 * len(words),
          'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
          'D': regexp_matches(text, '[#$%&*|]'),
          'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)} AS f
  FROM texts LEFT JOIN known USING (doc_id)),
profile AS (
  SELECT part, good, toxic, concat(CASE WHEN f['A'] THEN 'A' ELSE '' END,
    CASE WHEN f['B'] THEN 'B' ELSE '' END, CASE WHEN f['C'] THEN 'C' ELSE '' END,
    CASE WHEN f['D'] THEN 'D' ELSE '' END, CASE WHEN f['E'] THEN 'E' ELSE '' END) AS failed,
    count(*) AS n
  FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS own, filter_order[:step - 1] AS before
  FROM orders, range(1, 6) AS r(step)),
met AS (
  SELECT *, contains(failed, own) AS failing,
         translate(failed, before, '') = failed OR before = '' AS there
  FROM profile, steps)
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (there AND NOT failing), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (there AND failing), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (NOT there AND failing), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (failed = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(n) FILTER (there AND failing AND good), 0)::BIGINT AS good_lost,
       coalesce(sum(n) FILTER (there AND failing AND toxic), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(length(failed), 1)) FILTER (failing), 0)::BIGINT AS shapley
FROM met GROUP BY part, filter_order, step"""
