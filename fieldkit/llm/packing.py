"""Packing the token pieces of documents into fixed-length sequences, by best fit and local search."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.pieces import CACHE_ENTRIES, PieceCache, groups_of_texts, prepare
from fieldkit.llm.token_counts import ids_of_pieces
from fieldkit.session import settle

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = "row_key bigint, " + PIECES + ", sequence_id bigint, offset bigint, fill bigint"
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
END_ID = 2
BLOCK_ROWS = 8192
BLOCKS_JOINED = 500


@cache
def _json_ids(path: str, entries: int) -> PieceCache:
    return PieceCache(lambda pieces: ids_of_pieces(path, pieces), entries)


def piece_bounds(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all of ``capacity`` but the first one."""
    first = total % capacity or min(total, capacity)
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = END_ID,
                 id_column: str = "doc_id", text_column: str = "text",
                 cached: int = CACHE_ENTRIES) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids and its end mark.

    ``cached`` bounds the word pieces a worker remembers, at some 200 bytes each and twice as many
    while generations change: more of them take more memory and less time.
    """
    prepare(docs.sparkSession)
    mark = end_id.to_bytes(4, "little")

    def cut_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups_of_texts(batch, "text"):
                rows = []
                for i, values in enumerate(_json_ids(path, cached).values(texts), first):
                    ids = b"".join(values) + mark
                    rows += [(i, k, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]))
                             for k, (start, n) in enumerate(piece_bounds(len(ids) // 4, capacity))]
                at, piece, start, length, crc = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(text_column).alias("text")).mapInArrow(cut_ids, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that has room for it."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        enough = rooms >> n
        if enough:
            room = n + (enough & -enough).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(item)
        with_room[room - n].append(chosen)
        rooms |= 1 << (room - n)
    return bins


class LocalSearch:
    """Swaps between underfull bins that raise the sum of squared fills, until bins are empty.

    The emptiest bin gives: an item moves into the room of a fuller bin, or is exchanged there for
    a shorter item, or for two of together less, or two of its items for one of less. Of all such
    steps the one that fills a fuller bin furthest is taken, so each step raises the squared fill.
    A bin with no such step left is passed over; the search ends when no bin has one.
    """

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.lengths, self.capacity = lengths.tolist(), capacity
        self.full, self.open = [], []
        for held in bins:
            fill = sum(self.lengths[i] for i in held)
            (self.full if fill == capacity else self.open).append(held)
        self.rooms = np.array([self.room(b) for b in self.open], dtype=np.int64)
        self.units: list[tuple] = [self.units_of(b) for b in self.open]

    def room(self, held: list[int]) -> int:
        return self.capacity - sum(self.lengths[i] for i in held)

    def units_of(self, held: list[int]) -> list[tuple[int, tuple[int, ...]]]:
        """What a bin can give in one step, by total length: nothing, one item or two."""
        by_length = {}
        for i in held:
            by_length.setdefault(self.lengths[i], []).append(i)
        units = {0: ()}
        for items in by_length.values():
            if len(items) > 1:
                units.setdefault(2 * self.lengths[items[0]], (items[0], items[1]))
        for a, b in combinations(by_length, 2):
            units.setdefault(a + b, (by_length[a][0], by_length[b][0]))
        units.update({n: (items[0],) for n, items in by_length.items()})
        return sorted(units.items())

    def run(self) -> list[list[int]]:
        self.index()
        tried: set[int] = set()
        while len(tried) < len(self.open):
            rooms = self.rooms.copy()
            rooms[list(tried)] = -1
            giver = int(rooms.argmax())
            if rooms[giver] < 0 or rooms[giver] == self.capacity:
                break
            while self.open[giver] and self.step(giver):
                pass
            if self.open[giver]:
                tried.add(giver)
            else:  # empty: it takes no further part, and the others have changed
                self.rooms[giver] = -1
                tried.clear()
        return self.full + [b for b in self.open if b]

    def index(self) -> None:
        """All units of all open bins as flat arrays, so a step looks at them at once."""
        self.unit_bin = np.concatenate(
            [np.full(len(u), b) for b, u in enumerate(self.units)] or [np.empty(0, int)])
        self.unit_length = np.array([n for u in self.units for n, _ in u], dtype=np.int64)
        self.unit_size = np.array([len(i) for u in self.units for _, i in u], dtype=np.int64)

    def step(self, giver: int) -> bool:
        """Take the best step of one bin; whether there was one."""
        fuller = self.rooms < self.rooms[giver]
        usable = fuller[self.unit_bin] & (self.rooms[self.unit_bin] > 0)
        room = self.rooms[self.unit_bin]
        best = None
        for given, items in reversed(self.units[giver]):
            if not items:
                continue
            gain = given - self.unit_length
            fits = usable & (gain > 0) & (gain <= room) & (len(items) + self.unit_size <= 3)
            fits &= (self.unit_size > 0) | (len(items) == 1)
            if not fits.any():
                continue
            left = np.where(fits, room - gain, self.capacity)
            at = int(left.argmin())
            if best is None or left[at] < best[0]:
                best = (int(left[at]), at, items)
            if best[0] == 0:
                break
        if best is None:
            return False
        _, at, items = best
        taker = int(self.unit_bin[at])
        back = dict(self.units[taker])[int(self.unit_length[at])]
        self.open[giver] = [i for i in self.open[giver] if i not in items] + list(back)
        self.open[taker] = [i for i in self.open[taker] if i not in back] + list(items)
        for b in (giver, taker):
            self.rooms[b] = self.room(self.open[b])
            self.units[b] = self.units_of(self.open[b])
        self.index_again({giver, taker})
        return True

    def index_again(self, changed: set[int]) -> None:
        keep = ~np.isin(self.unit_bin, list(changed))
        fresh = [(b, n, len(i)) for b in changed for n, i in self.units[b]]
        b, n, s = (np.array(x, dtype=np.int64) for x in zip(*fresh, strict=True))
        self.unit_bin = np.concatenate([self.unit_bin[keep], b])
        self.unit_length = np.concatenate([self.unit_length[keep], n])
        self.unit_size = np.concatenate([self.unit_size[keep], s])


def pack(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers for lengths of at most ``capacity``."""
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def _pack_blocks(pieces: DataFrame, block, capacity: int, first_id: int) -> DataFrame:
    """Pack each block of pieces by itself; sequence ids start at ``first_id + block << 32``."""

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row_key", ignore_index=True)
        lengths = rows["length"].to_numpy()
        number, offset, fill = (np.zeros(len(rows), dtype=np.int64) for _ in range(3))
        for i, held in enumerate(pack(lengths, capacity)):
            held = sorted(held)
            ends = np.cumsum(lengths[held])
            number[held], offset[held], fill[held] = i, ends - lengths[held], ends[-1]
        rows["sequence_id"] = first_id + (int(key[0]) << 32) + number
        rows["offset"], rows["fill"] = offset, fill
        return rows[[c.split()[0] for c in PACKED.split(", ")]]

    return pieces.withColumn("block", block).groupBy("block").applyInPandas(packed, PACKED)


def pack_pieces(pieces: DataFrame, capacity: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``sequence_id, offset`` so that no sequence holds more than ``capacity`` tokens.

    A full piece is a sequence by itself. The others are dealt by a hash into blocks of about
    ``block_rows``, so a block's size does not depend on the data, and each block is packed by itself.
    At most one bin of a block is left half empty or less; the pieces of such bins are packed once
    more, ``BLOCKS_JOINED`` blocks together.
    """
    keyed = settle(pieces.withColumn("row_key", F.monotonically_increasing_id()), "pieces")
    part = keyed.filter(F.col("length") < capacity)
    blocks = max(1, -(-part.count() // block_rows))
    first = settle(_pack_blocks(part, F.pmod(F.xxhash64("row_key"), F.lit(blocks)), capacity, 0),
                   "packed")
    half = F.col("fill") <= capacity // 2
    joined = _pack_blocks(
        first.filter(half), F.floor(F.shiftright("sequence_id", 32) / BLOCKS_JOINED), capacity,
        1 << 62)
    full = keyed.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": -1 - F.col("row_key"), "offset": F.lit(0).cast("bigint")})
    return (first.filter(~half).select(COLUMNS).unionByName(joined.select(COLUMNS))
            .unionByName(full.select(COLUMNS)))


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = END_ID,
                   id_column: str = "doc_id", text_column: str = "text",
                   block_rows: int = BLOCK_ROWS, cached: int = CACHE_ENTRIES) -> DataFrame:
    """Pieces of every document with their place in a sequence of at most ``capacity`` tokens.

    A document is the ids of its whole text by the byte-level tokenizer file at ``path``, without
    added special tokens, and ``end_id``. One of more than ``capacity`` ids is cut into pieces of
    ``capacity``, the first of which may be shorter. Sequences have no gaps.

    A null or empty text is the end mark alone; null ids stay null; repeated rows are documents of
    their own; equal lengths are ordered by row; an empty table gives no rows; other columns are not
    read.
    """
    return pack_pieces(
        token_pieces(docs, path, capacity, end_id, id_column, text_column, cached), capacity,
        block_rows)
