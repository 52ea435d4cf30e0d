"""Cutting texts where no byte-level BPE token can cross, and a bounded cache of what pieces give."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# A cut lies before ASCII white space that follows anything but white space, or between a letter and
# a full stop or comma. The tokenizers' pattern ends a match at each such place and never looks
# behind, and no special string holds one, so a text's tokens are those of its pieces in order.
_PIECES = re.compile(
    r"[ \t-\r]*+[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[., \t-\r])|[ \t-\r]*+[^ \t-\r]++|[ \t-\r]++")
_ODD_SPACE = re.compile(r"[^\S \t-\r][ \t-\r]")
_AFTER_WORD = re.compile(r"(?<=\S)(?=[ \t-\r])")

CACHED_CHARS = 64
CACHE_ENTRIES = 500_000
BATCH_BYTES = 1 << 18
ROWS_PER_BATCH = 1000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def cut(text: str) -> list[str]:
    """Pieces of ``text`` that a byte-level tokenizer may encode one by one; joined, they are it."""
    if not text.isascii() and _ODD_SPACE.search(text):
        return [p for p in _AFTER_WORD.split(text) if p]
    return _PIECES.findall(text)


def prepare(spark: SparkSession) -> None:
    """Set what Python tasks on whole texts need, where the session has not set it itself.

    Arrow batches hold a thousand rows at most, and workers look for this package where the driver
    found it, so a session started in another folder finds it too.
    """
    if spark.conf.get(_ARROW_ROWS) == "10000":
        spark.conf.set(_ARROW_ROWS, str(ROWS_PER_BATCH))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def by_bytes(pieces: Iterable[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of about ``most`` bytes; only the last piece of one may reach beyond that."""
    pieces = list(pieces)
    if not pieces:
        return
    ends = np.cumsum([len(piece.encode()) for piece in pieces])
    starts = np.flatnonzero(np.diff(np.maximum(ends - 1, 0) // most, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts[1:], len(pieces)], strict=True):
        yield pieces[start:end]


class PieceCache:
    """What ``encode`` gives for pieces, each short piece that keeps coming worked out once.

    ``encode`` takes a list of pieces and returns a value for each. The cache lives as long as the
    Python worker. It holds two generations of at most ``entries`` pieces: a full young one becomes
    the old one, and what is not asked for again before the next change goes. Long pieces are not
    kept, so memory is bounded.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence], entries: int = CACHE_ENTRIES,
                 cut: Callable[[str], list[str]] = cut):
        self.encode = encode
        self.entries = entries
        self.cut = cut
        self.young: dict = {}
        self.old: dict = {}

    def values(self, texts: Sequence[str | None]) -> Iterator[Iterator]:
        """The values of each text's pieces; a null text has none."""
        cuts = [self.cut(text) if text else [] for text in texts]
        if len(self.young) > self.entries:
            self.old, self.young = self.young, {}
        wanted = set().union(*cuts).difference(self.young)
        if self.old:
            again = wanted.intersection(self.old)
            self.young.update((piece, self.old[piece]) for piece in again)
            wanted -= again
        for batch in by_bytes(wanted):
            self.young.update(zip(batch, self.encode(batch), strict=True))
        for pieces in cuts:
            yield map(self.young.__getitem__, pieces)
        for piece in wanted:
            if len(piece) > CACHED_CHARS:
                del self.young[piece]


def groups_of_texts(batch: pa.RecordBatch, column: str,
                    most: int = 16 * BATCH_BYTES) -> Iterator[tuple[int, list]]:
    """Runs of rows whose texts hold about ``most`` characters: first row and the texts."""
    start, held, size = 0, [], 0
    for i, text in enumerate(batch.column(column)):
        value = text.as_py()
        held.append(value)
        size += len(value) if value else 0
        if size >= most:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held
