"""Personal data in texts: fixed kinds, and more found through the words that stand before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.joins import FEW_ROWS, checked
from fieldkit.llm.spans import (
    Kind,
    blanked,
    count_of,
    digits_of,
    in_order,
    joined,
    let,
    passes_luhn,
    spans_of,
)
from fieldkit.session import settle

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9])"


def _digit_count(value: Column, low: int, high: int) -> Column:
    return F.length(digits_of(value)).between(low, high)


# Possessive repeats and the tests of what stands before keep the work linear in the text. They
# change no match: within a run of such characters either all starts match or none does.
KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
                  r"(?:\.[A-Za-z0-9-]++)++", lambda t: F.contains(t, F.lit("@"))),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.rlike(r"[0-9]\.[0-9]"),
         lambda v: v.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
         lambda v: _digit_count(v, 14, 19) & passes_luhn(v)),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: F.contains(t, F.lit("+")),
         lambda v: _digit_count(v, 10, 15)),
]
# What may stand after a pattern: digit groups joined by spaces, brackets, dots or hyphens, a name at
# a host, and any token that is more than a plain word. All are taken to the end of their last token.
DIGIT_GROUPS = r"[(\[+]*+[0-9]++(?:[\x20().\[\]-]{1,4}+[0-9]++)*+\S*+"
NAME_AT_HOST = (r"\S++\x20(?i:at|\(at\)|\[at\])\x20"
                r"(?:\S*\p{L}\.\p{L}\S*+|\S++(?:\x20(?i:dot|\(dot\)|\[dot\])\x20\S++)++)")
ODD_TOKEN = r"\S*(?:[\p{N}@#_]|\p{L}[^\p{L}\s'’-]+\p{L})\S*+"
IDENTIFIER = r"[\p{N}@#_]|\p{L}[^\p{L}'’-]+\p{L}"
# Known identifiers are blanked by this character, which no candidate and no gap before one crosses.
BLANK = "\x0b"
# A word with a letter (of a long one its last 40 characters) and, looked at only, what may be an
# identifier after it. Digit groups hold no letter, so none is looked at again from inside.
OCCURRENCE = Kind("context", r"(?:(?<!\S)|(?=\S{40}\s))(?=\S{0,39}\p{L})(\S{1,40}+)[^\S\x0b]++"
                  rf"(?=({DIGIT_GROUPS}|{NAME_AT_HOST}|{ODD_TOKEN}))",
                  lambda t: t.rlike(r"[\p{N}@#_]|\p{L}[^\p{L}\s'’-]+\p{L}"
                                    r"|\x20(?i:at|\(at\)|\[at\])\x20"),
                  lambda v: v.rlike(IDENTIFIER), 2)
CONTEXTS = (
    "array<struct<span:struct<start:int,kind_no:int,end:int,kind:string,value:string>,"
    "word:string,seed:boolean>>")
LONGEST = 40
BEFORE = 60
ROUNDS = 3
SMOOTHING = 2.0
MIN_SEEDS = 5
MIN_SCORE = 0.8


def base_spans(text: Column) -> Column:
    """All spans of the fixed kinds in order."""
    return in_order(F.concat(*[spans_of(text, kind, i) for i, kind in enumerate(KINDS)]))


def _plain(word: Column) -> Column:
    """A word in lower case without what is not a letter at its ends."""
    return F.lower(F.regexp_replace(word, r"^[^\p{L}]+|[^\p{L}]+$", ""))


def _occurrence(place: Column, value: Column, word: Column, seed: bool) -> Column:
    return F.struct(
        F.struct(place["start"].alias("start"), F.lit(len(KINDS)).alias("kind_no"),
                 place["end"].alias("end"), F.lit(OCCURRENCE.name).alias("kind"),
                 value.alias("value")).alias("span"),
        _plain(word).alias("word"), F.lit(seed).alias("seed"))


def _seeds(text: Column, base: Column) -> Column:
    """Each known identifier with the word before it."""
    def before(span: Column) -> Column:
        first = F.greatest(span["start"] - BEFORE, F.lit(0))
        return F.regexp_extract(text.substr(first + 1, span["start"] - first), r"(\S+)\s*$", 1)

    return F.transform(base, lambda b: _occurrence(b, b["value"], before(b), True))


def _unknown(text: Column) -> Column:
    """What may be an identifier with the word before it; known identifiers are blank."""
    words = F.regexp_extract_all(text, F.lit(OCCURRENCE.pattern), F.lit(1))

    def occurrence(span: Column, word: Column) -> Column:
        token = F.regexp_replace(span["value"], r"[^\p{L}\p{N}]+$", "")
        place = F.struct(span["end"].alias("start"),
                         (span["end"] + F.char_length(token)).alias("end"))
        return _occurrence(place, token, word, False)

    # Every match gives a span here, so words and spans pair up by place; the test comes after.
    every = Kind(OCCURRENCE.name, OCCURRENCE.pattern, OCCURRENCE.may_hold, value_group=2)
    return let(spans_of(text, every, len(KINDS)), lambda spans: F.when(
        F.size(spans) > 0, let(words, lambda words: F.filter(
            F.zip_with(spans, words, occurrence),
            lambda o: OCCURRENCE.passes(o["span"]["value"])))))


def _contexts(text: Column, base: Column) -> Column:
    """Occurrences in a text: ``span``, the ``word`` before it, and whether it is a ``seed``."""
    none = F.array().cast(CONTEXTS)
    both = F.when(F.size(base) == 0, _unknown(text)).otherwise(F.concat(
        _seeds(text, base), F.coalesce(let(blanked(text, KINDS, BLANK), _unknown), none)))
    return F.filter(both, lambda o: o["word"] != "")


def seeded_patterns(occurrences: DataFrame, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``pattern``: the words that stand before at least ``min_seeds`` different seeds."""
    return occurrences.filter("seed").select("pattern", "instance").distinct().groupBy("pattern").agg(
        F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= min_seeds).select("pattern")


def word_totals(texts: DataFrame, wanted: DataFrame, few_rows: int = FEW_ROWS) -> DataFrame:
    """``pattern, total``: how often each wanted word is in the column ``text``, whatever follows it.

    Tokens are counted as they are, within tasks first, and only different ones are brought to the
    form of a pattern.
    """
    tokens = texts.select(F.explode(F.split("text", r"\s+")).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))
    words = tokens.select(_plain(F.right("token", F.lit(LONGEST))).alias("pattern"), "n")
    return words.join(checked(wanted, few_rows), "pattern").groupBy("pattern").agg(
        F.sum("n").alias("total"))


def bootstrap(occurrences: DataFrame, totals: DataFrame, rounds: int = ROUNDS,
              smoothing: float = SMOOTHING, min_score: float = MIN_SCORE) -> DataFrame:
    """``instance`` of the unseen identifiers that patterns of high confidence discover.

    ``occurrences`` has ``pattern, instance, seed``, and ``totals`` has ``pattern, total`` for the
    patterns with enough seeds; others score 0. The graph joins each pattern (a word) to the instances
    it stands before, with how often it does. Instances seen as seeds score 1. A pattern's score is
    the summed scores of what follows it over all its places in the corpus, so a word that mostly
    stands before plain words scores little however many seeds follow it; ``smoothing`` places that
    score nothing hold down rare ones. An unseen instance scores as its patterns do on average. So
    scores spread over the graph round by round. Those of at least ``min_score`` are returned.
    """
    graph = settle(occurrences.groupBy("pattern", "instance").agg(
        F.max("seed").alias("seed"), F.count(F.lit(1)).alias("times")), "graph")
    seeds = graph.groupBy("instance").agg(F.max("seed").alias("seed"))
    scores = settle(seeds.withColumn("score", F.col("seed").cast("double")), "scores")
    for _ in range(rounds):
        followed = graph.join(scores.drop("seed"), "instance").groupBy("pattern").agg(
            F.sum(F.col("score") * F.col("times")).alias("held"), F.sum("times").alias("seen"))
        places = F.greatest("total", "seen") + smoothing
        patterns = settle(followed.join(totals, "pattern", "left").select(
            "pattern", F.when(F.col("total").isNull(), 0.0).otherwise(F.col("held") / places)
            .alias("confidence")), "patterns")
        scores = settle(
            graph.join(patterns, "pattern").groupBy("instance").agg(
                F.max("seed").alias("seed"), F.avg("confidence").alias("mean"))
            .select("instance", "seed",
                    F.when(F.col("seed"), 1.0).otherwise(F.col("mean")).alias("score")), "scores")
    return scores.filter(~F.col("seed") & (F.col("score") >= min_score)).select("instance")


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       with_row: bool = False, min_seeds: int = MIN_SEEDS, **limits) -> DataFrame:
    """Spans of personal data in every whole text.

    Spans of the fixed kinds are always given. They are the seeds of a bootstrap over the corpus:
    words that stand before them are patterns, scored by the share of their places in the corpus at
    which a known identifier follows. Digit groups, names at hosts and tokens of any length that are not plain words are
    added as kind ``context`` where only such patterns find them and they overlap no fixed span.
    ``min_seeds`` different seeds make a word a pattern; other ``limits`` are those of ``bootstrap``.

    Columns: ``doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans, span_list``, and
    with ``with_row`` the whole input row as ``row``. Null text is empty; a null id stays null; repeated
    rows each give a row; an empty table gives none; other columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    row = [F.struct(*docs.columns).alias("row")] if with_row else []
    carry = ["row"] if with_row else []
    found = settle(
        docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text.alias("text"), *row)
        .withColumn("base", base_spans(F.col("text")))
        .withColumn("contexts", _contexts(F.col("text"), F.col("base")))
        .select("doc_id", *carry, "base", "contexts",
                F.monotonically_increasing_id().alias("row_key")), "personal-data")
    occurrences = settle(found.select("row_key", F.explode("contexts").alias("o")).select(
        "row_key", F.col("o.word").alias("pattern"), F.xxhash64("o.span.value").alias("instance"),
        "o.seed", "o.span"), "occurrences")
    wanted = settle(seeded_patterns(occurrences, min_seeds), "patterns")
    totals = settle(word_totals(docs.select(text.alias("text")), wanted), "pattern-totals")
    unseen = settle(bootstrap(occurrences, totals, **limits), "unseen")
    added = settle(occurrences.filter("NOT seed").join(unseen, "instance").groupBy("row_key").agg(
        F.collect_list("span").alias("added")), "added")
    spans = found.drop("contexts").join(added, "row_key", "left").withColumn(
        "span_list", F.when(F.col("added").isNull(), F.col("base")).otherwise(
            in_order(F.concat("base", "added"))))
    return spans.select(
        "doc_id", *carry, *[count_of(F.col("base"), i).alias(f"n_{kind.name}")
                            for i, kind in enumerate(KINDS)],
        F.coalesce(F.size("added").cast("bigint"), F.lit(0).cast("bigint")).alias("n_added"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("span_list")).alias("spans"), "span_list")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span as its kind in angle brackets; spans that overlap become one."""
    merged = F.aggregate(
        in_order(spans), F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"),
                F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                F.element_at(done, -1)["kind"].alias("kind")))))
        .otherwise(F.concat(done, F.array(F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))))

    def rebuilt(merged: Column) -> Column:
        parts = F.transform(merged, lambda s, i: F.concat(
            text.substr(F.when(i == 0, 0).otherwise(F.get(merged, i - 1)["end"]) + 1,
                        s["start"] - F.when(i == 0, 0).otherwise(F.get(merged, i - 1)["end"])),
            F.lit("<"), s["kind"], F.lit(">")))
        rest = text.substr(F.element_at(merged, -1)["end"] + 1, F.char_length(text))
        return F.concat(F.array_join(parts, ""), rest)

    return F.when(F.size(spans) > 0, let(merged, rebuilt)).otherwise(text)


def without_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                          length_column: str = "n_chars", **limits) -> DataFrame:
    """``docs`` with every span of personal data masked, and ``length_column`` set anew if there.

    Rows without a span stay as they are, a null text too.
    """
    found = find_personal_data(docs, id_column, text_column, with_row=True, **limits)
    row = found.select(
        *[F.col(f"row.`{c}`").alias(c) if c != text_column else
          masked(F.col(f"row.`{c}`"), F.col("span_list")).alias(c) for c in docs.columns],
        (F.size("span_list") > 0).alias("_changed_row"))
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        row = row.withColumn(length_column, F.when(
            F.col("_changed_row"), F.char_length(text_column).cast(kind))
            .otherwise(F.col(length_column)))
    return row.select(*docs.columns)
