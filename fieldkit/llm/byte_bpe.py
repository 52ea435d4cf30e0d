"""Byte-level BPE by a rank file: encoding with a segment tree of pair ranks, and decoding."""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.pieces import PieceCache, groups_of_texts, prepare

NONE = np.iinfo(np.int64).max
LANE_BYTES = 64
CACHED_PIECES = 300_000


class RankedBytes:
    """Encoder and decoder of one rank file.

    A word is encoded by merging its leftmost pair of lowest rank until no pair has one. A segment
    tree over the word's byte positions holds ``rank << 32 | position`` of the pair that starts at
    each live position, so its root is the next merge. A merge changes the pair that starts there,
    the pair of the live neighbour before, and takes out the neighbour after: three point updates
    up the tree. Short words of about equal length run side by side as rows of one array of trees.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            rows = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(word): int(rank) for word, rank in rows}
        self.words = {rank: word for word, rank in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = sorted(
            (self.ranks[word[:i]] << 32 | self.ranks[word[i:]], rank)
            for word, rank in self.ranks.items() for i in range(1, len(word))
            if word[:i] in self.ranks and word[i:] in self.ranks)
        self.pairs = np.array([p for p, _ in pairs] + [NONE], dtype=np.int64)
        self.merged = np.array([r for _, r in pairs] + [-1], dtype=np.int64)
        self.rank_of = dict(pairs)

    def _pair_keys(self, left, right, position):
        """``rank << 32 | position`` of pairs of ids, or NONE where they do not merge."""
        wanted = (left << 32) | right
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.merged[at] << 32 | position, NONE)

    def _lanes(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of at most ``width`` bytes, a power of two, one tree a row."""
        rows = len(words)
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        ids = self.of_byte[raw.reshape(rows, width)]
        places = np.arange(width)
        ids[places >= size[:, None]] = -1
        after = np.tile(places + 1, (rows, 1))
        before = np.tile(places - 1, (rows, 1))
        tree = np.full((rows, 2 * width), NONE, dtype=np.int64)
        inside = places[:-1] + 1 < size[:, None]
        tree[:, width:-1] = np.where(
            inside, self._pair_keys(ids[:, :-1], ids[:, 1:] & 0xFFFFFFFF, places[:-1]), NONE)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])

        def update(lanes, position, keys):
            node = position + width
            tree[lanes, node] = keys
            while node[0] > 1:
                node = node >> 1
                tree[lanes, node] = np.minimum(tree[lanes, 2 * node], tree[lanes, 2 * node + 1])

        live = np.flatnonzero(tree[:, 1] != NONE)
        while live.size:
            best = tree[live, 1]
            here = best & 0xFFFFFFFF
            gone = after[live, here]
            ids[live, here] = best >> 32
            ids[live, gone] = -1
            follow = after[live, gone]
            after[live, here] = follow
            update(live, gone, np.full(live.size, NONE))
            has = follow < size[live]
            before[live[has], follow[has]] = here[has]
            right = ids[live, np.where(has, follow, 0)]
            update(live, here, np.where(has, self._pair_keys(best >> 32, right, here), NONE))
            back = before[live, here]
            has = back >= 0
            if has.any():
                lanes, back = live[has], back[has]
                update(lanes, back, self._pair_keys(ids[lanes, back], best[has] >> 32, back))
            live = live[tree[live, 1] != NONE]
        return [row[row >= 0].astype("<u4").tobytes() for row in ids]

    def _long(self, word: bytes) -> bytes:
        """Ids of one word of any length, by one tree."""
        n = len(word)
        width = 1 << max(1, (n - 1).bit_length())
        start = self.of_byte[np.frombuffer(word, np.uint8)]
        tree = np.full(2 * width, NONE, dtype=np.int64)
        tree[width:width + n - 1] = self._pair_keys(start[:-1], start[1:], np.arange(n - 1))
        level = width
        while level > 1:
            tree[level >> 1:level] = np.minimum(tree[level:2 * level:2], tree[level + 1:2 * level:2])
            level >>= 1
        ids, tree, rank_of, none = start.tolist(), tree.tolist(), self.rank_of, int(NONE)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def update(position, key):
            node = position + width
            tree[node] = key
            node >>= 1
            while node:
                left, right = tree[2 * node], tree[2 * node + 1]
                key = left if left < right else right
                if tree[node] == key:
                    return
                tree[node] = key
                node >>= 1

        def key_of(left, right, position):
            rank = rank_of.get(ids[left] << 32 | ids[right])
            return none if rank is None else rank << 32 | position

        while tree[1] != none:
            here, rank = tree[1] & 0xFFFFFFFF, tree[1] >> 32
            gone = after[here]
            follow = after[here] = after[gone]
            ids[here], ids[gone] = rank, -1
            update(gone, none)
            if follow < n:
                before[follow] = here
                update(here, key_of(here, follow, here))
            else:
                update(here, none)
            back = before[here]
            if back >= 0:
                update(back, key_of(back, here, back))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of different words, as little-endian unsigned 32-bit integers."""
        found, lanes = {}, defaultdict(list)
        for word in words:
            if word in self.ranks:
                found[word] = self.ranks[word].to_bytes(4, "little")
            elif len(word) <= LANE_BYTES:
                lanes[max(2, 1 << (len(word) - 1).bit_length())].append(word)
            else:
                found[word] = self._long(word)
        for width, same in lanes.items():
            found.update(zip(same, self._lanes(same, width), strict=True))
        return found

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, each match of the pattern encoded by itself."""
        split = [[word.encode() for word in self.find(piece)] for piece in pieces]
        ids = self.encode_words(list({word for words in split for word in words}))
        return [b"".join(map(ids.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.words.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def coder(path: str, pattern: str) -> RankedBytes:
    """One coder per rank file and Python worker."""
    return RankedBytes(path, pattern)


@cache
def _encoded(path: str, pattern: str) -> PieceCache:
    return PieceCache(coder(path, pattern).encode, CACHED_PIECES)


def encode_texts(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` with the ids of every whole text as little-endian unsigned 32-bit bytes.

    A null or empty text has no ids (an empty string of bytes); a null id stays null; repeated rows
    each give a row; an empty table gives none. Other columns are not read, whatever their names.
    """
    prepare(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in groups_of_texts(batch, "text"):
                ids = [b"".join(v) for v in _encoded(path, pattern).values(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)), pa.array(ids, pa.binary())],
                    names=["doc_id", "ids"])

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(text_column).alias("text")).mapInArrow(
                           encoded, "doc_id bigint, ids binary")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that each row's ids stand for; null ids give null."""
    prepare(encoded.sparkSession)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decode = coder(path, pattern).decode
            back = [decode(i.as_py()) if i.is_valid else None for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(back, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(
        decoded, "doc_id bigint, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """Digests of the ids of every text and of what they decode to; edge cases as above."""
    both = decode_ids(encode_texts(docs, path, pattern, id_column, text_column), path, pattern)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
