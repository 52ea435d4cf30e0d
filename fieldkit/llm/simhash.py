"""SimHash fingerprints of word shingles, and groups of documents whose fingerprints are near."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.components import component_roots, local_roots
from fieldkit.llm.exact_dedup import raw_key
from fieldkit.llm.joins import FEW_ROWS, checked, kept_rows
from fieldkit.llm.pieces import prepare
from fieldkit.llm.tiles import TILE_ROWS, compared_blocks, in_runs, tile_pairs, whole_runs
from fieldkit.session import settle

SEED = 42
CHUNK = 1 << 18


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64 majority bits of the hashes of a text's word shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = list(zip(first[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(spans), CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans[i:i + CHUNK]],
                          dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(spans), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``doc_id, raw_key, fp``: the fingerprint of every whole text as a signed 64-bit number.

    ``raw_key`` is a hash of the text itself, which tells rows of one id apart.
    """
    prepare(docs.sparkSession)

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("raw_key"),
                 pa.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")],
                          pa.int64())], names=["doc_id", "raw_key", "fp"])

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       raw_key(text_column).alias("raw_key"),
                       F.col(text_column).alias("text")).mapInArrow(
                           printed, "doc_id bigint, raw_key bigint, fp bigint")


def near_edges(prints: DataFrame, radius: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges ``a, b`` that join every two fingerprints ``fp`` within ``radius`` bits.

    ``prints`` holds different fingerprints. Two within the radius agree in one of ``radius + 1``
    ranges of bits, so they meet in the group of that range's value, and no pair is lost. Groups are
    compared exactly, tile by tile, with exclusive-or and bit counts; tiles whose population counts
    differ by more than the radius are never paired, here or inside a task. Of the pairs found in a
    task, the edges that join the same fingerprints are returned, so their number stays below that
    of the rows compared.
    """
    bounds = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    ranges = [F.struct(F.lit(i).cast("tinyint").alias("range"),
                       F.shiftrightunsigned(F.shiftleft(F.col("fp"), 64 - high), 64 - high + low)
                       .alias("value"))
              for i, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False))]
    spread = prints.select("fp", F.bit_count("fp").cast("int").alias("ones"),
                           F.explode(F.array(*ranges)).alias("r")).select("fp", "ones", "r.*")
    met = in_runs(tile_pairs(settle(spread, "ranges"), ["range", "value"], "fp", "ones", radius,
                             tile_rows).select("run", "fp", "ones", "is_cross", "is_second"), "fp")

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_runs(batches, ["run"]):
            fp, ones = frame["fp"].to_numpy(), frame["ones"].to_numpy()
            found = []
            for left, right, same in compared_blocks(
                    starts, len(frame), frame["is_cross"].to_numpy(), frame["is_second"].to_numpy()):
                low, high = ones[left].min() - radius, ones[left].max() + radius
                if ones[right].max() < low or ones[right].min() > high:
                    continue
                apart = np.bitwise_count(
                    fp[left].view(np.uint64)[:, :, None] ^ fp[right].view(np.uint64)[:, None, :])
                g, i, j = np.nonzero(apart <= radius)
                if same:
                    g, i, j = (x[i < j] for x in (g, i, j))
                found.append((fp[left[g, i]], fp[right[g, j]]))
            if found:
                a, b = local_roots(*(np.concatenate(x) for x in zip(*found, strict=True)))
                yield pd.DataFrame({"a": a, "b": b})

    return met.mapInPandas(linked, "a bigint, b bigint")


def _rooted(prints: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """``fp, root, least``: each different fingerprint, that of its component, its smallest id."""
    classes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = component_roots(near_edges(classes.select("fp"), radius, tile_rows))
    return settle(classes.join(roots.withColumnsRenamed({"a": "fp", "b": "root"}), "fp", "left")
                  .withColumn("root", F.coalesce("root", "fp")), "rooted")


def near_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, id_column: str = "doc_id",
                text_column: str = "text", tile_rows: int = TILE_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    A fingerprint is 16 hex digits; the component is the smallest id of the documents that links of
    at most ``radius`` bits join. Words are lower-cased in A-Z and split at ASCII white space; a text
    of fewer words than a shingle is one shingle; a null, empty or blank text has fingerprint zero,
    which links like any other. Equal fingerprints are one node, so copies cost nothing. A null id
    is a row of its group but never its component's id; repeated rows each give a row; an empty
    table gives none; other columns are not read.
    """
    prints = settle(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    rooted = _rooted(prints, radius, tile_rows)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(rooted.join(least, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_survivors(docs: DataFrame, shingle: int = 3, radius: int = 2, id_column: str = "doc_id",
                   text_column: str = "text", few_rows: int = FEW_ROWS,
                   tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row of each group of ``docs``, all columns kept: that of the smallest id.

    Rows are told apart by id and text. A null id is larger than any other, of rows of one id the one
    whose text has the smallest hash stays, and of a row repeated whole one stays.
    """
    prints = settle(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    rows = settle(prints.groupBy("doc_id", "raw_key", "fp").agg(F.count(F.lit(1)).alias("n")), "rows")
    named = _rooted(prints, radius, tile_rows).select("fp", "root")
    placed = rows.join(named, "fp")
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "raw_key")
    chosen = settle(placed.groupBy("root").agg(F.min(row).alias("chosen"), F.sum("n").alias("held"))
                    .filter("held > 1").drop("held"), "chosen")
    decided = placed.join(checked(chosen, few_rows), "root").select(
        "doc_id", "raw_key", (row == F.col("chosen")).alias("stays"), "n")
    return kept_rows(docs, {"doc_id": F.col(id_column).cast("bigint"),
                            "raw_key": raw_key(text_column)}, decided, few_rows)
