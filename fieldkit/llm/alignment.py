"""Tokens of two tokenizers over the same bytes: groups, links, and which links a corpus prefers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.pieces import PieceCache, groups_of_texts, prepare
from fieldkit.llm.token_counts import ids_of_pieces, tokenizer
from fieldkit.session import settle

SPACE = "▁"
CACHED_PIECES = 250_000
KNOWN_PAIRS = 1_000_000
# Before a space that follows anything but white space and is not the last character: there both
# tokenizers begin a token, whatever stands before.
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)


class Cuts(NamedTuple):
    """Pieces as one tokenizer cuts them: ids, byte ends over all pieces, and tokens a piece."""

    ids: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


def gallop(numbers: np.ndarray, low: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where each of ``numbers`` would stand in the rising ``ends``, sought from ``low`` on.

    The step doubles until it has passed the number, then the stretch between the last two steps is
    halved; all numbers go side by side. Each of them must be there or have a larger one behind it.
    """
    low, step = low.copy(), 1
    high = np.empty_like(low)
    live = np.arange(len(low))
    while live.size:
        at = np.minimum(low[live] + step - 1, len(ends) - 1)
        passed = ends[at] >= numbers[live]
        high[live[passed]] = at[passed]
        live = live[~passed]
        low[live] = at[~passed] + 1
        step *= 2
    live = np.flatnonzero(low < high)
    while live.size:
        middle = (low[live] + high[live]) >> 1
        passed = ends[middle] >= numbers[live]
        high[live[passed]] = middle[passed]
        low[live[~passed]] = middle[~passed] + 1
        live = live[low[live] < high[live]]
    return low


def overlaps(short: Cuts, long: Cuts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of ``short`` its first and last overlapping one of ``long``, and whether both
    end there. Both lists cut the same pieces.

    The ranks of the ends differ by the tokens between them: a token begins in the one in which the
    token before it ended, or behind that one if both ended there.
    """
    piece = np.repeat(np.arange(len(short.counts)), short.counts)
    last = gallop(short.ends, (np.cumsum(long.counts) - long.counts)[piece], long.ends)
    both = long.ends[last] == short.ends
    first = np.zeros_like(last)
    first[1:] = last[:-1] + both[:-1]
    return first, last, both


def align(a: Cuts, b: Cuts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links as positions in A and in B, and the group number of each A and each B token.

    The tokenizer with fewer tokens drives. A group ends where tokens of both end.
    """
    turned = len(a.ids) > len(b.ids)
    short, long = (b, a) if turned else (a, b)
    first, last, both = overlaps(short, long)
    runs = last - first + 1
    mine = np.repeat(np.arange(len(short.ids)), runs)
    other = np.arange(len(mine)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(first, runs)
    ended = np.zeros(len(long.ids), dtype=np.int64)
    ended[last[both]] = 1
    short_group = np.cumsum(both) - both
    long_group = np.cumsum(ended) - ended
    return ((other, mine, long_group, short_group) if turned
            else (mine, other, short_group, long_group))


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for.

    Bytes that are visible signs of Latin-1 stand for themselves; the others, in order, are the code
    points from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(others)}}


@cache
def _sentence_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Aligner:
    """Aligns pieces of texts by a byte-level ``.json`` file (A) and a sentencepiece model (B)."""

    def __init__(self, a_path: str, b_path: str):
        self.a_path, self.b = a_path, _sentence_model(b_path)
        signs = byte_of_sign()
        vocabulary = tokenizer(a_path, plain=True).get_vocab()
        self.a_bytes = {i: bytes(signs[c] for c in word) if set(word) <= signs.keys()
                        else word.encode() for word, i in vocabulary.items()}
        b_words = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(w[3:-1], 16)]) if self.b.is_byte(i)
                        else w.replace(SPACE, " ").encode() for i, w in enumerate(b_words)]
        self.b_size = len(b_words)
        self.a_lengths = np.zeros(max(self.a_bytes, default=0) + 1, dtype=np.int64)
        self.a_lengths[list(self.a_bytes)] = list(map(len, self.a_bytes.values()))
        self.b_lengths = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        most = max(len(self.a_lengths), self.b_size)
        self.texts = np.array([f"{i}{sign}" for sign in ",|;\n" for i in range(most)], dtype=object)
        # A piece of B with a space after another character could reach over a cut.
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", w) for w in b_words)

    def cut(self, text: str) -> list[str]:
        """Pieces of a text, which begins with a space, that may be encoded one by one."""
        return _CUT.split(text) if self.cuts else [text]

    def pieces(self, pieces: list[str]) -> list[tuple[int, str, bytes] | None]:
        """Number of A tokens, groups and pairs ``a * |B| + b`` of each link, for pieces that begin
        with a space; None where the bytes of A or B are not the piece's."""
        a_all = ids_of_pieces(self.a_path, pieces, plain=True)
        b_all = self.b.encode([p[1:] for p in pieces], num_threads=1)
        cuts = self._cuts(a_all, b_all)
        raw = [p.encode() for p in pieces]
        if self._spell(b"".join(raw), np.cumsum(list(map(len, raw))), *cuts):
            return self._aligned(*cuts)
        spelled = []
        for word, a, b in zip(raw, a_all, b_all, strict=True):
            spelled.append(self._spell(word, np.array([len(word)]), *self._cuts([a], [b])))
        found = iter(self._aligned(*self._cuts(
            [a for a, ok in zip(a_all, spelled, strict=True) if ok],
            [b for b, ok in zip(b_all, spelled, strict=True) if ok])))
        return [next(found) if ok else None for ok in spelled]

    def _cuts(self, a_all: list[bytes], b_all: list[list[int]]) -> tuple[Cuts, Cuts]:
        """What the tokenizers gave for pieces, as arrays over all of them."""
        a_ids = np.frombuffer(b"".join(a_all), "<u4").astype(np.int64)
        b_ids = np.fromiter(chain.from_iterable(b_all), np.int64)
        return (Cuts(a_ids, np.cumsum(self.a_lengths[a_ids]),
                     np.array([len(i) // 4 for i in a_all], dtype=np.int64)),
                Cuts(b_ids, np.cumsum(self.b_lengths[b_ids]),
                     np.array(list(map(len, b_all)), dtype=np.int64)))

    def _spell(self, raw: bytes, piece_ends: np.ndarray, a: Cuts, b: Cuts) -> bool:
        """Whether the tokens of A and those of B are the bytes of every piece."""
        return all(
            cuts.counts.all() and np.array_equal(cuts.ends[np.cumsum(cuts.counts) - 1], piece_ends)
            and b"".join(map(words.__getitem__, cuts.ids.tolist())) == raw
            for words, cuts in ((self.a_bytes, a), (self.b_bytes, b)))

    def _aligned(self, a: Cuts, b: Cuts) -> list[tuple[int, str, bytes]]:
        """The values of pieces that both tokenizers spell."""
        if not len(a.ids):
            return []
        a_ids, b_ids = a.ids, b.ids
        in_a, in_b, a_group, b_group = align(a, b)
        pairs = a_ids[in_a] * self.b_size + b_ids[in_b]
        a_piece, b_piece = (np.repeat(np.arange(len(c.counts)), c.counts) for c in (a, b))
        # All tokens by group, those of A first; behind each the sign that the next one asks for.
        side = np.concatenate([2 * a_group, 2 * b_group + 1])
        order = np.argsort(side, kind="stable")
        side, piece = side[order], np.concatenate([a_piece, b_piece])[order]
        sign = np.full(len(side), 3)
        sign[:-1] = np.where(piece[1:] != piece[:-1], 3, np.where(
            side[1:] == side[:-1], 0, np.where(side[1:] >> 1 == side[:-1] >> 1, 1, 2)))
        signed = sign * (len(self.texts) // 4) + np.concatenate([a_ids, b_ids])[order]
        groups = "".join(self.texts[signed].tolist()).split("\n")
        ends = (8 * np.searchsorted(a_piece[in_a], np.arange(1, len(a.counts) + 1))).tolist()
        raw = pairs.astype("<i8").tobytes()
        return [(n, text, raw[start:end]) for n, text, start, end in zip(
            a.counts.tolist(), groups[:-1], [0, *ends[:-1]], ends, strict=True)]


@cache
def _aligned(a_path: str, b_path: str) -> PieceCache:
    aligner = Aligner(a_path, b_path)
    return PieceCache(aligner.pieces, CACHED_PIECES, aligner.cut)


def vocabulary_sizes(a_path: str, b_path: str) -> tuple[int, int]:
    """How many ids the two files have."""
    return (tokenizer(a_path, plain=True).get_vocab_size(),
            _sentence_model(b_path).get_piece_size())


def align_texts(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times`` of every row.

    A encodes a space and the text, B the text, before which it puts the space itself. ``groups``
    are cut where tokens of both end, as ``a1,a2|b1;a3|b2,b3``; ``pairs`` are the different linked
    ``a * |B| + b`` in order and ``times`` how many links each has. Texts are cut before spaces where
    no token of either can cross, and equal pieces are aligned once per worker.

    A text that is null, empty, or not what the tokens of A or B spell has zeros, no groups (``''``)
    and no pairs. A null id stays null, repeated rows each give a row, an empty table gives none, and
    other columns are not read.
    """
    prepare(docs.sparkSession)
    a_size, b_size = vocabulary_sizes(a_path, b_path)
    small = a_size * b_size < 1 << 31
    pair_type = pa.int32() if small else pa.int64()
    schema = (f"doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              f"groups string, pairs array<{'int' if small else 'bigint'}>, times array<int>")

    def row(values: list) -> tuple:
        if not values or None in values:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        numbers, groups, pairs = zip(*values, strict=True)
        joined, raw = ";".join(groups), b"".join(pairs)
        n_a, n_groups = sum(numbers), joined.count(";") + 1
        different, times = np.unique(np.frombuffer(raw, "<i8"), return_counts=True)
        return (n_a, joined.count(",") + 2 * n_groups - n_a, n_groups, len(raw) // 8, joined,
                different, times)

    def lists(parts: tuple, kind: pa.DataType) -> pa.Array:
        ends = np.cumsum([0, *map(len, parts)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                        pa.array(np.concatenate(parts), kind, safe=False))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _aligned(a_path, b_path)
        for batch in batches:
            for start, texts in groups_of_texts(batch, "text"):
                values = cache.values([f" {text}" if text else None for text in texts])
                columns = list(zip(*[row(list(v)) for v in values], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)),
                     *[pa.array(c, pa.int64()) for c in columns[:4]],
                     pa.array(columns[4], pa.string()), lists(columns[5], pair_type),
                     lists(columns[6], pa.int32())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs",
                           "times"])

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(text_column).alias("text")).mapInArrow(aligned, schema)


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """``pair, held, best``: how many documents hold a pair linked, and whether that is the highest
    number of its A id. Pairs are counted within tasks first; the highest numbers are one row an id."""
    counted = settle(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("held")), "pairs")
    a_id = F.floor(F.col("pair") / b_size)
    # One row for each id of A's vocabulary at most, a bound that no corpus moves.
    top = F.broadcast(counted.groupBy(a_id.alias("a_id")).agg(F.max("held").alias("highest")))
    return settle(counted.join(top, a_id == F.col("a_id")).select(
        "pair", "held", (F.col("held") == F.col("highest")).alias("best")), "counted-pairs")


def preferred_links(aligned: DataFrame, b_size: int, known: int = KNOWN_PAIRS) -> DataFrame:
    """The rows of ``align_texts``, read twice and so settled, with ``n_best`` and ``count_sum``.

    ``row_key`` tells the rows apart. The pairs that most documents hold are sent to all tasks: those
    held at least ``links / known`` times, which cannot be more than ``known``. The links of the
    others are joined by shuffle, and none of those pairs is in many documents. A row's sums are
    added within its task first.
    """
    counts = pair_counts(aligned, b_size)
    held = counts.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    often = max(1, -(-held // known))
    links = aligned.select("row_key", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row_key", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    frequent = F.broadcast(counts.filter(F.col("held") >= often))
    rare = counts.filter(F.col("held") < often)

    def sums(found: DataFrame) -> DataFrame:
        return found.groupBy("row_key").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("held") * F.col("times")).alias("count_sum"))

    found = sums(links.join(frequent, "pair"))
    if often > 1:
        others = links.join(frequent.select("pair"), "pair", "left_anti")
        found = found.unionByName(sums(others.join(rare, "pair"))).groupBy("row_key").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.join(settle(found, "link-sums"), "row_key", "left").fillna(
        0, ["n_best", "count_sum"])


def _digest(groups: Column) -> Column:
    return F.when(groups == "", "").otherwise(F.sha2(groups, 256))


def audit_alignment(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id",
                    text_column: str = "text", known: int = KNOWN_PAIRS) -> DataFrame:
    """``doc_id``, the counts of ``align_texts``, ``n_best, count_sum`` and a digest of the groups."""
    rows = align_texts(docs, a_path, b_path, id_column, text_column)
    kept = settle(rows.withColumn("groups_sha256", _digest(F.col("groups"))).drop("groups")
                  .withColumn("row_key", F.monotonically_increasing_id()), "aligned")
    return preferred_links(kept, vocabulary_sizes(a_path, b_path)[1], known).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
