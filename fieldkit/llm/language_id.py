"""Language of texts by bit-sliced Bloom filters that hold a mask of languages per n-gram."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.pieces import groups_of_texts, prepare
from fieldkit.session import settle

UNKNOWN = "und"
GRAM_SIZES = (2, 3, 4)
HASHES = 4
FALSE_RATE = 0.01
MIN_SHARE = 0.25
DOUBT = 10_000
SLICE_BYTES = 1 << 27
CHUNK_POSITIONS = 1 << 16
MAX_WORD = 40
KNOWN_WORDS = 200_000
HIT_BYTES = 1 << 27
_WORD = regex.compile(r"\p{L}+")


def held_out(doc_id: Column | str) -> Column:
    """Documents of which nothing is learned: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower())


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all 64-bit numbers, one to one."""
    z = values * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the n-grams of words with their ends marked, and the word of each.

    A very long word is taken in parts. The n-grams are windows over the code points of all words
    between blanks; a window with a blank inside belongs to no word.
    """
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if max(map(len, words)) > MAX_WORD:
        cut = [(i, word[at:at + MAX_WORD]) for i, word in enumerate(words)
               for at in range(0, len(word), MAX_WORD)]
        owner, words = np.array([i for i, _ in cut]), [part for _, part in cut]
    else:
        owner = np.arange(len(words))
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    blanks = np.cumsum(points == 32)
    keys, owners = [], []
    for size in GRAM_SIZES:
        n = len(points) - size + 1
        if n < 1:
            continue
        starts = np.flatnonzero(blanks[size - 2:size - 2 + n] == blanks[:n])
        key = np.full(len(starts), size, np.uint64)
        for i in range(size):
            key = mixed(key + points[starts + i])
        keys.append(key)
        owners.append(owner[blanks[starts] - 1])
    return np.concatenate(keys), np.concatenate(owners)


class Model(NamedTuple):
    """Languages, the filter's bits by slice, position and 64 languages, and the languages' false
    rates. The slices but the first are read when they are needed."""

    languages: list[str]
    positions: int
    slices: int
    false_rate: np.ndarray
    chunks: DataFrame


def positions_for(grams: int, rate: float = FALSE_RATE) -> int:
    """How many positions keep a language of ``grams`` n-grams at a false rate."""
    return max(64, ceil(grams * HASHES / -log(1.0 - rate ** (1.0 / HASHES))))


def places(keys: np.ndarray, positions: int) -> np.ndarray:
    """The filter positions of n-grams, ``HASHES`` each, by double hashing."""
    low, high = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((low[:, None] + steps * high[:, None]) % np.uint64(positions)).astype(np.int64)


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    """The slice of the filter that holds all positions of an n-gram."""
    return (mixed(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(slices)).astype(np.int64)


def gram_counts(docs: DataFrame, id_column: str, text_column: str, lang_column: str) -> DataFrame:
    """``lang, gram, n`` over all documents that may be learned from, counted within tasks first."""
    prepare(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in words.items():
                keys, owner = grams_of(list(counts))
                if len(keys):
                    times = np.fromiter(counts.values(), np.int64, len(counts))
                    grams, at = np.unique(keys, return_inverse=True)
                    n = np.bincount(at, times[owner]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()),
                         pa.array(grams.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
            words.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for start, texts in groups_of_texts(batch, "text"):
                for lang, text in zip(langs[start:], texts, strict=False):
                    words[lang].update(words_of(text))
                if sum(map(len, words.values())) > KNOWN_WORDS:
                    yield from out()
        yield from out()

    learned = docs.filter(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()
                          & ~held_out(id_column))
    part = learned.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    return (part.mapInArrow(counted, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def members(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``gram, bit``: the languages that an n-gram belongs to, from settled counts.

    It belongs to a language in which it is at least ``MIN_SHARE`` as frequent as it surely is in
    another. Surely is less than counted, by ``DOUBT`` n-grams more in the language's total: one find
    in a language of few texts is kept there and takes nothing from the others, and strange words in
    a language's texts do not fill its filter as the corpus grows.
    """
    rates = counts.join(F.broadcast(totals), "lang").select(
        "gram", "bit", (F.col("n") / F.col("total")).alias("rate"),
        (F.col("n") / (F.col("total") + DOUBT)).alias("sure"))
    seen = rates.groupBy("gram").agg(F.max("sure").alias("best"),
                                     F.collect_list(F.struct("bit", "rate")).alias("seen"))
    return seen.select("gram", F.explode(F.filter(
        "seen", lambda s: s["rate"] >= MIN_SHARE * F.col("best"))["bit"]).alias("bit"))


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          lang_column: str = "lang") -> Model:
    """The filter of all documents outside the held-out part.

    Its positions are counted for: the language with most n-grams has a false rate of
    ``FALSE_RATE``, and the others a lower one. A position has a word for each 64 languages. A filter
    of more than ``SLICE_BYTES`` is made in slices, and an n-gram lies in one of them.
    """
    counts = settle(gram_counts(docs, id_column, text_column, lang_column), "grams")
    spark = counts.sparkSession
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").collect()
    languages = [row.lang for row in totals]
    numbered = spark.createDataFrame([(row.lang, i, float(row.total)) for i, row in enumerate(totals)],
                                     "lang string, bit int, total double")
    owned = settle(members(counts, numbered), "members")
    held = {row.bit: row["count"] for row in owned.groupBy("bit").count().collect()}
    width = -(-max(1, len(languages)) // 64)
    wanted = positions_for(max(held.values(), default=0))
    slices = -(-wanted * width * 8 // SLICE_BYTES)
    positions = -(-wanted // slices)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("gram").to_numpy().view(np.uint64)
            at = places(keys, positions).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(slice_of(keys, slices), HASHES)),
                 pa.array(at // CHUNK_POSITIONS), pa.array(at % CHUNK_POSITIONS),
                 pa.array(np.repeat(batch.column("bit").to_numpy(), HASHES))],
                names=["slice", "chunk", "place", "bit"])

    def packed(group: pa.Table) -> pa.Table:
        bits = np.zeros((CHUNK_POSITIONS, width), np.uint64)
        bit = group.column("bit").to_numpy()
        np.bitwise_or.at(bits, (group.column("place").to_numpy(), bit // 64),
                         np.uint64(1) << (bit % 64).astype(np.uint64))
        filled = [int(np.count_nonzero(bits[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)))
                  for i in range(len(languages))]
        return pa.table({"slice": [group.column("slice")[0].as_py()],
                         "chunk": [group.column("chunk")[0].as_py()],
                         "bits": [bits.tobytes()], "filled": [filled]})

    chunks = settle(owned.mapInArrow(placed, "slice bigint, chunk bigint, place bigint, bit int")
                    .groupBy("slice", "chunk").applyInArrow(
                        packed, "slice bigint, chunk bigint, bits binary, filled array<bigint>"),
                    "filter")
    filled = chunks.select(F.posexplode("filled").alias("bit", "n")).groupBy("bit").agg(
        F.sum("n").alias("n")).collect()
    rate = np.zeros(len(languages))
    for row in filled:
        rate[row.bit] = (row.n / (positions * slices)) ** HASHES
    return Model(languages, positions, slices, rate, chunks.select("slice", "chunk", "bits"))


def filter_slice(model: Model, number: int) -> np.ndarray:
    """One slice of the filter, of ``SLICE_BYTES`` at most, by position and 64 languages."""
    width = -(-max(1, len(model.languages)) // 64)
    bits = np.zeros((-(-model.positions // CHUNK_POSITIONS) * CHUNK_POSITIONS, width), np.uint64)
    for row in model.chunks.filter(F.col("slice") == number).toLocalIterator():
        at = row["chunk"] * CHUNK_POSITIONS
        bits[at:at + CHUNK_POSITIONS] = np.frombuffer(row["bits"], np.uint64).reshape(-1, width)
    return bits


class Decider:
    """Counts finds of texts in a slice; what words hit is kept between texts, up to a bound."""

    def __init__(self, bits: np.ndarray, positions: int, number: int, slices: int, languages: int):
        self.bits, self.positions = bits, positions
        self.number, self.slices, self.languages = number, slices, languages
        self.most = max(1000, min(2 * KNOWN_WORDS, HIT_BYTES // (4 * (languages + 1))))
        self.known: dict[str, int] = {}
        self.hits = np.zeros((0, languages + 1), dtype=np.int32)

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """The languages that the filter holds each n-gram for, as words of 64 bits."""
        return np.bitwise_and.reduce(self.bits[places(keys, self.positions)], axis=1)

    def hits_of(self, words: list[str]) -> np.ndarray:
        """For each word its n-grams in this slice, and how many the filter finds in each language."""
        keys, owner = grams_of(words)
        if self.slices > 1:
            mine = slice_of(keys, self.slices) == self.number
            keys, owner = keys[mine], owner[mine]
        different, at = np.unique(keys, return_inverse=True)
        masks = self.masks(different)
        hits = np.zeros((len(words), self.languages + 1), dtype=np.int32)
        hits[:, 0] = np.bincount(owner, minlength=len(words))
        for i in range(self.languages):
            found = (masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(bool)[at]
            hits[:, i + 1] = np.bincount(owner[found], minlength=len(words))
        return hits

    def totals(self, texts: list[str | None]) -> np.ndarray:
        """For each text its n-grams in this slice and the finds in each language."""
        cuts = [words_of(text) if text else [] for text in texts]
        if len(self.known) > self.most:
            self.known, self.hits = {}, self.hits[:0]
        fresh = list(set().union(*cuts).difference(self.known))
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)),
                              strict=True))
        self.hits = np.concatenate([self.hits, self.hits_of(fresh)])
        found = np.zeros((len(texts), self.languages + 1), np.int64)
        for i, words in enumerate(cuts):
            if words:
                found[i] = self.hits[list(map(self.known.__getitem__, words))].sum(0, np.int64)
        return found


def best(totals: np.ndarray, languages: list[str],
         false_rate: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language of most n-grams of each text once chance finds are taken out, and its share."""
    n, found = totals[:, :1], totals[:, 1:]
    if not languages or not len(totals):
        return [UNKNOWN] * len(totals), np.zeros(len(totals))
    # A language whose filter is full tells nothing, so it has no true find.
    told = np.maximum(1.0 - false_rate, 1e-6)
    true = np.where(false_rate < 1.0 - 1e-6, np.maximum(0.0, (found - n * false_rate) / told), 0.0)
    top = true.argmax(axis=1)
    some = n[:, 0] > 0
    share = np.where(some, true[np.arange(len(n)), top] / np.maximum(n[:, 0], 1), 0.0)
    return ([languages[t] if s else UNKNOWN for t, s in zip(top.tolist(), some.tolist(), strict=True)],
            np.minimum(1.0, share))


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every whole text; the score is a share of n-grams.

    A filter of one slice decides where a text lies. With more slices each counts its finds in a scan
    of its own; the finds of a text, known by its digest, are added and decided then.
    """
    prepare(docs.sparkSession)
    context, languages, rates = docs.sparkSession.sparkContext, model.languages, model.false_rate
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       held_out(id_column).alias("held_out"), F.col(text_column).alias("text"))

    def decided(totals: np.ndarray) -> list[pa.Array]:
        names, share = best(totals, languages, rates)
        return [pa.array(names, pa.string()), pa.array(share, pa.float64())]

    if model.slices == 1:
        sent = context.broadcast((filter_slice(model, 0), model.positions, 0, 1, len(languages)))

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            decider = Decider(*sent.value)
            for batch in batches:
                for start, texts in groups_of_texts(batch, "text"):
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).slice(start, len(texts)) for c in ("doc_id", "held_out")],
                         *decided(decider.totals(texts))],
                        names=["doc_id", "held_out", "lang_pred", "score"])

        return rows.mapInArrow(
            placed, "doc_id bigint, held_out boolean, lang_pred string, score double")

    digest = F.sha2(F.coalesce("text", F.lit("")), 256)

    def counted(sent) -> DataFrame:
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            decider = Decider(*sent.value)
            for batch in batches:
                for start, texts in groups_of_texts(batch, "text"):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("digest").slice(start, len(texts)),
                         pa.array(decider.totals(texts).tolist(), pa.list_(pa.int64()))],
                        names=["digest", "totals"])

        part = rows.select(digest.alias("digest"), "text").mapInArrow(
            found, "digest string, totals array<bigint>")
        return settle(part.groupBy("digest").agg(F.first("totals").alias("totals")), "finds")

    parts = []
    for number in range(model.slices):
        sent = context.broadcast((filter_slice(model, number), model.positions, number,
                                  model.slices, len(languages)))
        parts.append(counted(sent))
        sent.unpersist()
    added = parts[0]
    for part in parts[1:]:
        more = part.withColumnRenamed("totals", "more")
        added = added.join(more, "digest").select("digest", F.zip_with(
            "totals", "more", lambda a, b: a + b).alias("totals"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = np.array(batch.column("totals").to_pylist(), np.int64).reshape(
                batch.num_rows, len(languages) + 1)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), *decided(totals)],
                                             names=["digest", "lang_pred", "score"])

    answers = added.mapInArrow(told, "digest string, lang_pred string, score double")
    return rows.withColumn("digest", digest).drop("text").join(
        settle(answers, "answers"), "digest").select("doc_id", "held_out", "lang_pred", "score")


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             lang_column: str = "lang") -> DataFrame:
    """Learn from the documents outside the held-out part and predict every one.

    A null text, or one without letters, is ``und`` with score 0, and so is every text when there is
    nothing to learn from. Ties go to the language first by name. A null id is not held out; null
    languages are not learned; repeated rows each count and give a row; an empty table gives none;
    other columns are not read. There may be any number of languages.
    """
    return predict(docs, learn(docs, id_column, text_column, lang_column), id_column, text_column)
