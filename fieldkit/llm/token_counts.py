"""Token counts of whole texts, by a public tokenizer file."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.pieces import PieceCache, by_bytes, cut, groups_of_texts, prepare

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
JOINED = 1000
_WORDS = re.compile(r"[ \n]?\S+(?:\n\S+)*").fullmatch


@cache
def tokenizer(path: str, plain: bool = False):
    """The tokenizer of a ``.json`` file, one per Python worker; Spark gives the parallelism.

    A ``plain`` one takes special strings inside texts as ordinary text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    if plain:
        loaded.encode_special_tokens = True
    return loaded


def ids_of_pieces(path: str, pieces: list[str], plain: bool = False) -> list[bytes]:
    """Ids of each piece of a byte-level tokenizer, as little-endian unsigned 32-bit integers.

    A line feed between words is a token of its own. So pieces that are words, or words with single
    line feeds before or between them, are joined by line feeds, and the library gets few texts of some
    length; the line feed that ends each piece is found by counting. Other pieces are encoded alone.
    """
    encode = tokenizer(path, plain).encode_batch_fast
    feed = tokenizer(path, plain).encode("\n", add_special_tokens=False).ids
    found: dict[str, bytes] = {}
    words = list(filter(_WORDS, pieces)) if len(feed) == 1 else []
    runs = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
    for run, got in zip(runs, encode(["\n".join(r) for r in runs], add_special_tokens=False),
                        strict=True):
        ids = np.array(got.ids, dtype="<u4")
        feeds = 4 * np.flatnonzero(ids == feed[0])
        last = np.cumsum([word.count("\n") + 1 for word in run])
        if len(feeds) == last[-1] - 1:
            raw, ends = ids.tobytes(), feeds[last[:-1] - 1].tolist()
            found.update(zip(run, [raw[a:b] for a, b in zip(
                [0, *(e + 4 for e in ends)], [*ends, len(raw)], strict=True)], strict=True))
    if len(found) < len(pieces):
        rest = [p for p in pieces if p not in found]
        for piece, got in zip(rest, encode(rest, add_special_tokens=False), strict=True):
            found[piece] = np.array(got.ids, dtype="<u4").tobytes()
    return list(map(found.__getitem__, pieces))


@cache
def _json_counts(path: str) -> PieceCache:
    return PieceCache(lambda pieces: [len(ids) // 4 for ids in ids_of_pieces(path, pieces)])


@cache
def _sentence_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _whole_counts(path: str, texts: list) -> Iterator[int]:
    """Lengths of whole texts, in batches of about equal bytes; nothing is cut."""
    for batch in by_bytes([t or "" for t in texts]):
        if path.endswith(".model"):
            yield from map(len, _sentence_model(path).encode(batch, num_threads=1))
        else:
            yield from map(len, tokenizer(path).encode_batch_fast(batch, add_special_tokens=False))


def _is_byte_level(path: str) -> bool:
    """Whether the file splits texts by the byte-level pattern alone, so pieces may be cut."""
    if not path.endswith(".json"):
        return False
    import json

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    before = parts["pre_tokenizer"] or {}
    return (parts["normalizer"] is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before["add_prefix_space"]
            and all(len(cut(t["content"])) == 1 and not t["lstrip"] and not t["rstrip"]
                    for t in parts["added_tokens"]))


def count_tokens(docs: DataFrame, path: str, limit: int, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, in input order of each partition.

    Texts are cut at safe boundaries when the tokenizer is a plain byte-level one, and pieces are
    encoded in batches of about equal bytes that give only their lengths; equal pieces are encoded
    once per worker. Other tokenizers (``.model`` files, ones that normalise) get whole texts.
    No special tokens are added; special strings inside a text count as the library's default has it.

    A null or empty text has no bytes and no tokens; a null id stays null; repeated rows each give a
    row; an empty table gives none. Other columns, whatever their names, are not read.
    """
    prepare(docs.sparkSession)
    safe = _is_byte_level(path)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in groups_of_texts(batch, "text"):
                n = (list(map(sum, _json_counts(path).values(texts))) if safe
                     else list(_whole_counts(path, texts)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)),
                     batch.column("n_bytes").slice(start, len(texts)),
                     pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.octet_length(text_column), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text_column).alias("text")).mapInArrow(counted, SCHEMA)
