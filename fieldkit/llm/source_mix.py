"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.llm.joins import FEW_ROWS, checked
from fieldkit.operators.ordering import running_total, with_row_index
from fieldkit.operators.skew import number_copies
from fieldkit.session import settle

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
_EXACT = "decimal(38,0)"


def word_count(text: str) -> Column:
    """Words of a text; a null one has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def draw_of(doc_id: Column, text: Column) -> Column:
    """52 random bits of a document, the same in every run: a digest of its id and text."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                     F.coalesce(F.md5(text), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   most: int = MOST_COPIES) -> DataFrame:
    """``source, source_no, source_size, target`` from settled ``source, source_size``.

    Sources are numbered by code point, null last, and their weights repeat in that order. They
    share the size of all; a target stops at ``most`` times its source's size, and what is left is
    shared by the others, so a target is ``least(cap, level * weight)``. A round finds the level of
    the sources below their caps and each later one caps more of them; two sums reach the driver.
    """
    parts = sizes.withColumn("_null", F.col("source").isNull())
    numbered, _ = with_row_index(parts, ["_null", "source"], "source_no")
    share = F.element_at(F.lit(list(weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    state = settle(numbered.select("source", "source_no", "source_size",
                                   share.cast("bigint").alias("weight"),
                                   (F.col("source_size") * most).alias("cap")), "sources")
    level, capped = 0.0, -1
    while True:
        below = F.col("cap") >= F.lit(level) * F.col("weight")
        sums = state.agg(
            F.sum("source_size").cast("double").alias("all"), F.count_if(~below).alias("capped"),
            F.coalesce(F.sum(F.when(~below, F.col("cap"))), F.lit(0)).cast("double").alias("full"),
            F.sum(F.when(below, F.col("weight"))).cast("double").alias("weight")).first()
        if sums["capped"] == capped or not sums["weight"]:
            break
        capped, level = sums["capped"], (sums["all"] - sums["full"]) / sums["weight"]
    return state.select("source", "source_no", "source_size", F.least(
        F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def inclusion(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``source_no, whole, rest, rate, certain_from`` of each source: how its documents are taken.

    Every document gets ``whole`` copies, the whole part of target over size. One more is sampled for
    the ``rest`` of the target, with a chance of ``rate`` times the document's size; documents of
    ``certain_from`` words or more, whose chance would be 1 or above, get it for certain, and
    ``rest`` is what remains for the others. Sizes are counted first: a source of n words has less
    than the root of 2n different ones.
    """
    counted = settle(rows.filter("size > 0").groupBy("source_no", "size").agg(
        F.count(F.lit(1)).alias("n")), "sizes")
    upto = Window.partitionBy("source_no").orderBy("size")
    every = Window.partitionBy("source_no")
    words = F.col("size").cast(_EXACT) * F.col("n")
    share = F.col("target") / F.col("source_size")
    sized = counted.join(checked(targets.filter("source_size > 0")), "source_no").select(
        "source_no", "size", F.floor(share).alias("whole"),
        (F.col("target") - F.floor(share) * F.col("source_size")).alias("rest"),
        F.sum(words * F.col("size")).over(upto).cast("double").alias("squares"),
        (F.sum(words).over(every) - F.sum(words).over(upto)).cast("double").alias("larger"))
    certain = F.col("squares") / F.col("size") + F.col("larger") <= F.col("rest")
    left = F.struct("size", "squares", "larger")
    by_source = sized.groupBy("source_no", "whole", "rest").agg(
        F.max(F.when(~certain, left)).alias("last"), F.min(F.when(certain, F.col("size")))
        .alias("certain_from"))
    rest = F.col("rest") - F.coalesce("last.larger", F.lit(0.0))
    return by_source.select("source_no", "whole", rest.alias("rest"),
                            (rest / F.col("last.squares")).alias("rate"), "certain_from")


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES,
                id_column: str = "doc_id", text_column: str = "text",
                source_column: str = "source", few_rows: int = FEW_ROWS) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row.

    ``copies`` says how often the mix takes a document, ``taken`` its words times that. Documents
    get whole copies as ``inclusion`` says. The others of a source are ranked by their random odds
    over their inclusion odds, and those of lowest rank are taken while their words fit into what is
    left; the sample's size is fixed in words. One document more is taken where it brings the source
    nearer to its target: of those left out the one whose size is nearest to the gap.

    A null or empty text has size 0 and is never taken. A null source is one of its own, last; an
    empty one is first. Null and repeated ids are rows of their own: ranks also depend on the text,
    and rows equal in id, text and source are numbered and then ranked one after another. An empty
    table gives no rows; other columns are not read. No source is one task's: ranks come from a
    range sort over all sources, and sums of its slices are added.
    """
    read = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(source_column).alias("source"), word_count(text_column).alias("size"),
                       draw_of(F.col(id_column).cast("bigint"), F.col(text_column)).alias("draw"))
    named = settle(number_copies(read, read.columns), "sized")
    sizes = settle(named.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    targets = settle(source_targets(sizes, weights, most), "targets")
    small = checked(targets.withColumnRenamed("source", "_source"), few_rows)
    rows = named.join(small, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ways = settle(inclusion(rows, targets), "inclusion")
    u = (F.col("draw") + F.lit(0.5)) / F.lit(float(1 << 52))
    p = F.col("rate") * F.col("size")
    certain = F.coalesce(F.col("size") >= F.col("certain_from"), F.lit(False))
    drawn = ~F.col("certain") & (p > 0) & (p < 1)
    ranked = (rows.join(checked(ways, few_rows), "source_no", "left")
              .withColumn("certain", certain)
              .withColumn("rank", F.when(drawn, (u / (1 - u)) / (p / (1 - p))))
              .withColumn("words", F.when(F.col("rank").isNotNull(), F.col("size")).otherwise(0)))
    order = ["source_no", "rank", "doc_id", "draw", "copy"]
    summed = settle(running_total(ranked, order, "words", "all_before")[0], "ranked")
    first = summed.groupBy("source_no").agg(F.min("all_before").alias("first"))
    placed = (summed.join(checked(settle(first, "starts"), few_rows), "source_no")
              .withColumn("through", F.col("all_before") - F.col("first") + F.col("words")))
    fits = F.col("rank").isNotNull() & (F.col("through") <= F.col("rest"))
    gap = settle(placed.filter("rank IS NOT NULL").groupBy("source_no", "rest").agg(
        F.max(F.when(fits, F.col("through"))).alias("fit")).select(
            "source_no", (F.col("rest") - F.coalesce("fit", F.lit(0))).alias("gap")), "gaps")
    left_out = placed.filter(F.col("rank").isNotNull() & ~fits).join(checked(gap, few_rows),
                                                                     "source_no")
    place = ["rank", "doc_id", "draw", "copy"]
    nearest = (left_out.withColumn("off", F.abs(F.col("size") - F.col("gap")))
               .filter("off < gap").groupBy("source_no").agg(F.min(F.struct(
                   "off", "rank", F.struct(F.col("doc_id").isNotNull(), "doc_id").alias("id"),
                   "draw", "copy")).alias("one"))
               .select("source_no", *[F.col(f"one.{c}" if c != "doc_id" else "one.id.doc_id")
                                      .alias(f"_{c}") for c in place],
                       F.lit(True).alias("one_more")))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place]
    chosen = checked(settle(nearest, "nearest").withColumnRenamed("source_no", "_source_no"),
                     few_rows)
    extra = placed.join(chosen, [F.col("source_no") == F.col("_source_no"), *same], "left")
    copies = (F.coalesce("whole", F.lit(0)) + F.col("certain").cast("bigint")
              + (fits | F.coalesce("one_more", F.lit(False))).cast("bigint"))
    return extra.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0)).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix_sql() -> str:
    """DuckDB SQL for the columns of the query."""
    return r"""
WITH named AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')),
                         1, 13))::BIGINT AS draw
  FROM documents),
rows AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, size, draw) - 1 AS copy FROM named),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
  FROM rows GROUP BY source),
weighed AS (
  SELECT *, 1 + source_no % 3 AS weight, 3 * source_size AS cap FROM sources),
filled AS (  -- the capped sources are those that reach their caps first
  SELECT *, coalesce(sum(cap) OVER others, 0) AS spent,
         sum(weight) OVER () - coalesce(sum(weight) OVER others, 0) AS open_weight
  FROM weighed
  WINDOW others AS (ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) - spent)::DOUBLE / open_weight::DOUBLE AS level
  FROM filled),
target AS (
  SELECT source, source_no, source_size, least(cap::DOUBLE, (
    SELECT level FROM levels WHERE cap >= level * weight ORDER BY cap / weight, source_no LIMIT 1)
    * weight) AS target
  FROM weighed),
counted AS (
  SELECT source_no, any_value(source_size) AS source_size, any_value(target) AS target, size,
         count(*) AS n
  FROM rows JOIN target ON rows.source IS NOT DISTINCT FROM target.source
  WHERE size > 0 GROUP BY source_no, size),
sized AS (
  SELECT source_no, size, floor(target / source_size) AS whole,
         target - floor(target / source_size) * source_size AS rest,
         sum(size::HUGEINT * size * n) OVER (PARTITION BY source_no ORDER BY size)::DOUBLE AS squares,
         coalesce(sum(size * n) OVER (PARTITION BY source_no ORDER BY size
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS larger
  FROM counted),
parted AS (
  SELECT *, squares / size + larger <= rest AS certain FROM sized),
ways AS (
  SELECT source_no, any_value(whole) AS whole,
         any_value(rest) - coalesce(max_by(larger, size) FILTER (NOT certain), 0) AS rest,
         max_by(squares, size) FILTER (NOT certain) AS squares,
         min(size) FILTER (certain) AS certain_from
  FROM parted GROUP BY source_no),
chances AS (
  SELECT rows.*, target.source_no, source_size, target, whole, rest,
         coalesce(size >= certain_from, false) AS certain, rest / squares * size AS p,
         (draw + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM rows JOIN target ON rows.source IS NOT DISTINCT FROM target.source
  LEFT JOIN ways ON ways.source_no = target.source_no),
ranked AS (
  SELECT *, CASE WHEN NOT certain AND p > 0 AND p < 1
                 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM chances),
placed AS (
  SELECT *, CASE WHEN rank IS NOT NULL THEN sum(size) FILTER (rank IS NOT NULL) OVER (
    PARTITION BY source_no ORDER BY rank, doc_id NULLS FIRST, draw, copy
    ROWS UNBOUNDED PRECEDING) END AS through
  FROM ranked),
gaps AS (
  SELECT source_no, any_value(rest) - coalesce(max(through) FILTER (through <= rest), 0) AS gap
  FROM placed WHERE rank IS NOT NULL GROUP BY source_no),
nearest AS (
  SELECT source_no, doc_id, draw, copy,
         row_number() OVER (PARTITION BY source_no ORDER BY abs(size - gap), rank,
                            doc_id NULLS FIRST, draw, copy) AS place
  FROM placed JOIN gaps USING (source_no)
  WHERE rank IS NOT NULL AND through > rest AND abs(size - gap) < gap)
SELECT placed.doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN size * (whole + certain::INT
         + (coalesce(through <= rest, false) OR nearest.place IS NOT NULL)::INT) ELSE 0
       END::BIGINT AS taken
FROM placed LEFT JOIN nearest ON nearest.source_no = placed.source_no AND nearest.place = 1
  AND nearest.doc_id IS NOT DISTINCT FROM placed.doc_id AND nearest.draw = placed.draw
  AND nearest.copy = placed.copy"""
