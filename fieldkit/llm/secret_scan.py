"""Secrets in texts, told from widely copied examples by who owns the places they occur in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.spans import Kind, blanked, count_of, in_order, joined, let, spans_of
from fieldkit.session import settle

# Words that announce a secret, and what follows them.
ANNOUNCED = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]++)")
KINDS = [
    Kind("assign", ASSIGN, lambda t: let(F.lower(t), lambda low: F.exists(
        F.array(*map(F.lit, ANNOUNCED)), lambda word: F.contains(low, word))),
        lambda v: F.length(v) >= 6, 2),
    Kind("access", r"AKIA[A-Z0-9]++", lambda t: F.contains(t, F.lit("AKIA")),
         lambda v: F.length(v) >= 20),
    Kind("hex", r"[0-9a-f]{24,}+", lambda t: F.lit(True)),
]
MIN_DIFFERENT = 10


def _looks_random(value: Column) -> Column:
    """Letters of both cases, digits, and many different characters."""
    return (value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DIFFERENT))


CANDIDATE = Kind("candidate", r"[A-Za-z0-9+/_=-]{20,}+", lambda t: F.lit(True), _looks_random)


def find_secrets(docs: DataFrame, owner_column: str = "source", repository_column: str = "doc_id",
                 id_column: str = "doc_id", text_column: str = "text", max_owners: int = 1,
                 max_repositories: int = 20) -> DataFrame:
    """Secret spans of every whole text, and how many look live or like a copied example.

    Spans of the base kinds are always given. Other random-looking strings of 20 or more characters
    are candidates. The hashes of all values are counted over the corpus by different owners and
    repositories: a value is a live one of its owner up to ``max_owners`` and ``max_repositories``,
    beyond that a widely copied example. Live candidates that overlap no base span are added.

    Columns: ``doc_id, n_assign, n_access, n_hex, n_added, n_live, n_example, base_sha256, spans,
    span_list``. Null text is empty; a null owner or repository is the same as an empty one; a null id stays
    null; repeated rows each give a row, but are one repository; an empty table gives none; other
    columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = settle(
        docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                    F.coalesce(F.col(owner_column).cast("string"), F.lit("")).alias("owner"),
                    F.coalesce(F.col(repository_column).cast("string"), F.lit(""))
                    .alias("repository"),
                    *[spans_of(text, kind, i).alias(kind.name) for i, kind in enumerate(KINDS)],
                    let(blanked(text, KINDS), lambda rest: spans_of(rest, CANDIDATE, len(KINDS)))
                    .alias("candidate"))
        .select("doc_id", "owner", "repository", F.monotonically_increasing_id().alias("row_key"),
                in_order(F.concat(*[k.name for k in KINDS])).alias("base"), "candidate"), "secrets")
    values = found.select("row_key", "owner", "repository", F.explode(
        F.concat("base", "candidate")).alias("span")).withColumn(
            "hash", F.xxhash64(F.col("span.value")))
    values = settle(values.select("row_key", "owner", "repository", "hash", "span"), "values")
    owned = (values.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
             .groupBy("hash", "owner").agg(F.count("one").alias("repositories"))
             .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"),
                                  F.sum("repositories").alias("repositories")))
    verdicts = settle(owned.select("hash", (
        (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories))
        .alias("live")), "verdicts")
    judged = values.join(verdicts, "hash").groupBy("row_key").agg(
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example"),
        F.collect_list(F.when(F.col("live") & (F.col("span.kind_no") == len(KINDS)),
                              F.col("span"))).alias("added"))
    zero = F.lit(0).cast("bigint")
    spans = found.join(settle(judged, "judged"), "row_key", "left").withColumn(
        "span_list", F.when(F.col("added").isNull(), F.col("base")).otherwise(
            in_order(F.concat("base", "added"))))
    return spans.select(
        "doc_id", *[count_of(F.col("base"), i).alias(f"n_{kind.name}")
                    for i, kind in enumerate(KINDS)],
        F.coalesce(F.size("added").cast("bigint"), zero).alias("n_added"),
        F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("n_example", zero).alias("n_example"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("span_list")).alias("spans"), "span_list")
