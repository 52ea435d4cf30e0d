"""Signals and boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkit.functions.text import float_text
from fieldkit.operators import boxes as B
from fieldkit.operators import signals as S
from fieldkit.plans.stand_ins import Query, blips, blips_sql, rounded_sql, table
from fieldkit.session import new_path
from fieldkit.sources.readers import BLIP_COLUMNS, read_blips
from fieldkit.sources.writers import write_lines

PRICE_BOX = B.Box("price", 50.0, 60.0, 3.0, 5.0, 2.0, 4.0)
QUANTITY_BOX = B.Box("quantity", 10.0, 12.0, 3.0, 5.0, 2.0, 4.0)
EMPTY_BOX = B.Box("empty", 500.0, 600.0, 3.0, 5.0, 2.0, 4.0)
NARROW_BOX = B.Box("narrow", 50.0, 50.6, 3.0, 3.0, 2.0, 2.0)

# Short lists, so that signals of the small tables have several.
SHORT_LIST = 4
_KEY_LIST = ", ".join(S.KEYS)

_COUNTS = """counts AS (SELECT frequency, ascension, declination, COUNT(*) AS blip_count
  FROM k GROUP BY ALL)"""
_TOP = """top AS (SELECT * FROM counts
  ORDER BY blip_count DESC, frequency, ascension, declination LIMIT 1)"""
_GAPS = """gaps AS (SELECT * FROM (SELECT frequency, ascension, declination, time,
  time - LAG(time) OVER (PARTITION BY frequency, ascension, declination ORDER BY time) AS gap
  FROM k) WHERE gap IS NOT NULL)"""


def _inside_sql(box: B.Box, k: str = "") -> str:
    return " AND ".join(f"{k}{key} BETWEEN {low}::DOUBLE AND {high}::DOUBLE"
                        for key, (low, high) in ((key, box.range_of(key)) for key in S.KEYS))


def _scan(spark: SparkSession, folder: str) -> DataFrame:
    """Blips written as text lines and read back."""
    path = new_path(spark, "blip-lines")
    texts = [float_text(F.col(c)) for c in BLIP_COLUMNS]
    write_lines(blips(spark, folder).select(F.concat_ws("  ", *texts).alias("line")), path)
    return read_blips(spark, path).rows


def _parts_sql(keys: str) -> str:
    """Times of a signal numbered in order, and so the list each belongs to."""
    return f"""parts AS (SELECT *, (row_number() OVER (PARTITION BY {keys} ORDER BY time) - 1)
        // {SHORT_LIST} + 1 AS part, COUNT(*) OVER (PARTITION BY {keys}) AS blip_count FROM inside)"""


def _mixed_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """One box per part, with widths that differ by powers of two on every coordinate."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("double")

    def width(step: int) -> Column:
        return F.pow(F.lit(2.0), ((key * step) % 12).cast("double") - 8)

    return table(spark, folder, "part").select(
        key.cast("string").alias("box_id"), (F.col("p_retailprice") / 20).alias("f_lo"),
        (F.col("p_retailprice") / 20 + width(1)).alias("f_hi"), (size / 6).alias("a_lo"),
        (size / 6 + width(5)).alias("a_hi"), (size / 10).alias("d_lo"),
        (size / 10 + width(7)).alias("d_hi"))


def _mixed_width_sql(step: int) -> str:
    return f"pow(2.0::DOUBLE, CAST((p_partkey * {step}) % 12 AS DOUBLE) - 8)"


_MIXED_SQL = f"""boxes AS (SELECT CAST(p_partkey AS VARCHAR) AS box_id,
  p_retailprice/20 AS f_lo, p_retailprice/20 + {_mixed_width_sql(1)} AS f_hi,
  CAST(p_size AS DOUBLE)/6 AS a_lo, CAST(p_size AS DOUBLE)/6 + {_mixed_width_sql(5)} AS a_hi,
  CAST(p_size AS DOUBLE)/10 AS d_lo, CAST(p_size AS DOUBLE)/10 + {_mixed_width_sql(7)} AS d_hi
  FROM part)"""


def _median_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """A box around the medians of each signal's blips."""
    found = B.median_boxes(blips(spark, folder), 0.3)
    return found.select("box_id", *[F.round(c, 6).alias(c) for c in found.columns[1:]])


_MEDIANS_SQL = ", ".join(f"round(median({k}) {sign} 0.3::DOUBLE, 6) AS {k[0]}_{end}"
                         for k in S.KEYS for sign, end in (("-", "lo"), ("+", "hi")))


def _round(df: DataFrame, column: str, decimals: int = 6) -> DataFrame:
    return df.withColumn(column, F.round(column, decimals))


def _item_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """One box per part, so there are more boxes than may become literals."""
    price, size = F.col("p_retailprice") / 20, F.col("p_size").cast("double")
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("box_id"),
        (price - 0.5).alias("f_lo"), (price + size / 50).alias("f_hi"),
        F.lit(1.0).alias("a_lo"), (F.lit(1.0) + size / 10).alias("a_hi"),
        F.lit(2.0).alias("d_lo"), F.lit(2.0).alias("d_hi"))


_ITEM_BOXES_SQL = """boxes AS (SELECT CAST(p_partkey AS VARCHAR) AS box_id,
  p_retailprice/20 - 0.5::DOUBLE AS f_lo,
  p_retailprice/20 + CAST(p_size AS DOUBLE)/50 AS f_hi, 1.0::DOUBLE AS a_lo,
  1.0::DOUBLE + CAST(p_size AS DOUBLE)/10 AS a_hi, 2.0::DOUBLE AS d_lo, 2.0::DOUBLE AS d_hi
  FROM part)"""

_TOTALS_SQL = """SELECT b.box_id, COUNT(k.time) AS total_blips FROM boxes b LEFT JOIN k
  ON k.frequency BETWEEN b.f_lo AND b.f_hi AND k.ascension BETWEEN b.a_lo AND b.a_hi
  AND k.declination BETWEEN b.d_lo AND b.d_hi GROUP BY b.box_id"""

_NAMED_BOXES = [PRICE_BOX, NARROW_BOX, EMPTY_BOX]


def _boxes_sql(boxes: list[B.Box]) -> str:
    rows = ", ".join(
        f"('{b.box_id}', " + ", ".join(f"{v}::DOUBLE" for key in S.KEYS for v in b.range_of(key))
        + ")" for b in boxes)
    return f"boxes(box_id, f_lo, f_hi, a_lo, a_hi, d_lo, d_hi) AS (VALUES {rows})"


_NAMED_SQL = _boxes_sql(_NAMED_BOXES)


def _median_box(spark: SparkSession, folder: str) -> DataFrame:
    inside = B.blips_inside(blips(spark, folder, "quantity"), QUANTITY_BOX)
    found = B.median_box(inside, 0.3)
    return found.select("box_id", *[F.round(c, 6).alias(c) for c in found.columns[1:]])


_QUANTITY_BOXES = [QUANTITY_BOX, B.Box("wide", 11.0, 30.0, 4.0, 9.0, 0.0, 3.0), EMPTY_BOX]
_QUANTITY_SQL = _boxes_sql(_QUANTITY_BOXES)
_MEDIAN_SQL = ", ".join(
    f"round(median({key}) {sign} 0.3::DOUBLE, 6) AS {name}"
    for key, names in zip(S.KEYS, [("f_lo", "f_hi"), ("a_lo", "a_hi"), ("d_lo", "d_hi")])
    for sign, name in zip("-+", names))

QUERIES = {
    "blip_scan": Query(_scan, f"WITH {blips_sql()} SELECT * FROM blips"),
    "blip_counts": Query(
        lambda s, d: S.blip_counts(blips(s, d)),
        f"WITH {rounded_sql(0)}, {_COUNTS} SELECT * FROM counts"),
    "ranked_counts": Query(
        lambda s, d: S.ranked_counts(S.blip_counts(blips(s, d))),
        f"""WITH {rounded_sql(0)}, {_COUNTS} SELECT *,
        CAST(rank() OVER (ORDER BY blip_count DESC) AS BIGINT) AS rank FROM counts"""),
    "formatted_counts": Query(
        lambda s, d: S.formatted_counts(S.blip_counts(blips(s, d))),
        f"""WITH {rounded_sql(0)}, {_COUNTS} SELECT '(' || CAST(frequency AS VARCHAR) || ', ' ||
        CAST(ascension AS VARCHAR) || ', ' || CAST(declination AS VARCHAR) || '): ' ||
        CAST(blip_count AS VARCHAR) AS line FROM counts"""),
    "top_signal": Query(
        lambda s, d: S.top_signal(blips(s, d)),
        f"WITH {rounded_sql(0)}, {_COUNTS}, {_TOP} SELECT * FROM top"),
    "top_signal_period": Query(
        lambda s, d: _round(S.top_signal_period(blips(s, d)), "period"),
        f"""WITH {rounded_sql(0)}, {_COUNTS}, {_TOP}, {_GAPS}
        SELECT frequency, ascension, declination, blip_count, round(avg(gap), 6) AS period
        FROM top JOIN gaps USING (frequency, ascension, declination) GROUP BY ALL"""),
    "signal_periods": Query(
        lambda s, d: _round(S.signal_periods(blips(s, d)), "period"),
        f"""WITH {rounded_sql(0)}, {_COUNTS}, {_GAPS}
        SELECT frequency, ascension, declination, blip_count, round(avg(gap), 6) AS period
        FROM counts LEFT JOIN gaps USING (frequency, ascension, declination) GROUP BY ALL"""),
    "signal_gaps": Query(
        lambda s, d: S.signal_gaps(blips(s, d)),
        f"WITH {rounded_sql(0)}, {_GAPS} SELECT * FROM gaps"),
    "top_signal_gaps": Query(
        lambda s, d: S.top_signal_gaps(blips(s, d)),
        f"""WITH {rounded_sql(0)}, {_COUNTS}, {_TOP}, {_GAPS}
        SELECT gaps.* FROM gaps SEMI JOIN top USING (frequency, ascension, declination)"""),
    "box_signals": Query(
        lambda s, d: B.box_signals(blips(s, d, "quantity"), QUANTITY_BOX, list_rows=SHORT_LIST),
        f"""WITH {rounded_sql(5, "quantity")}, inside AS (SELECT * FROM k
        WHERE {_inside_sql(QUANTITY_BOX)}), {_parts_sql(_KEY_LIST)}
        SELECT {_KEY_LIST}, part, list(time ORDER BY time) AS times, blip_count FROM parts
        GROUP BY ALL"""),
    "box_blips": Query(
        lambda s, d: B.box_blips(blips(s, d, "quantity"), QUANTITY_BOX),
        f"""WITH {rounded_sql(5, "quantity")} SELECT * FROM k
        WHERE {_inside_sql(QUANTITY_BOX)}"""),
    "formatted_boxes": Query(
        lambda s, d: B.formatted_boxes(B.box_signals(blips(s, d, "quantity"), QUANTITY_BOX,
                                                     list_rows=SHORT_LIST)),
        f"""WITH {rounded_sql(5, "quantity")}, inside AS (SELECT * FROM k
        WHERE {_inside_sql(QUANTITY_BOX)}), {_parts_sql(_KEY_LIST)}
        SELECT '(' || CAST(frequency AS VARCHAR) || ', ' ||
        CAST(ascension AS VARCHAR) || ', ' || CAST(declination AS VARCHAR) || '): Count = ' ||
        CAST(blip_count AS VARCHAR) || ', Times = [' ||
        string_agg(CAST(time AS VARCHAR), ', ' ORDER BY time) || ']' ||
        CASE WHEN part > 1 THEN ', Part = ' || CAST(part AS VARCHAR) ELSE '' END AS line
        FROM parts GROUP BY {_KEY_LIST}, part, blip_count"""),
    "signals_by_box": Query(
        lambda s, d: B.signals_by_box(blips(s, d, "quantity"), B.boxes_frame(s, _QUANTITY_BOXES),
                                      list_rows=SHORT_LIST),
        f"""WITH {rounded_sql(5, "quantity")}, {_QUANTITY_SQL}, inside AS (SELECT box_id, k.*
        FROM boxes b JOIN k ON k.frequency BETWEEN b.f_lo AND b.f_hi
        AND k.ascension BETWEEN b.a_lo AND b.a_hi AND k.declination BETWEEN b.d_lo AND b.d_hi),
        {_parts_sql("box_id, " + _KEY_LIST)}
        SELECT box_id, {_KEY_LIST}, part, list(time ORDER BY time) AS times, blip_count FROM parts
        GROUP BY ALL"""),
    "box_totals": Query(
        lambda s, d: B.box_totals(blips(s, d), B.boxes_frame(s, _NAMED_BOXES)),
        f"WITH {rounded_sql(5)}, {_NAMED_SQL} {_TOTALS_SQL}"),
    "box_totals_by_cell": Query(
        lambda s, d: B.box_totals(blips(s, d), _item_boxes(s, d)),
        f"WITH {rounded_sql(5)}, {_ITEM_BOXES_SQL} {_TOTALS_SQL}"),
    "box_totals_by_shuffle": Query(
        lambda s, d: B.box_totals(blips(s, d), _item_boxes(s, d), some_boxes=0,
                                  by_curve=False),
        f"WITH {rounded_sql(5)}, {_ITEM_BOXES_SQL} {_TOTALS_SQL}"),
    "box_totals_mixed": Query(
        lambda s, d: B.box_totals(blips(s, d), _mixed_boxes(s, d)),
        f"WITH {rounded_sql(5)}, {_MIXED_SQL} {_TOTALS_SQL}"),
    "box_totals_by_curve": Query(
        lambda s, d: B.box_totals(blips(s, d), _mixed_boxes(s, d), some_boxes=0, slice_rows=20_000),
        f"WITH {rounded_sql(5)}, {_MIXED_SQL} {_TOTALS_SQL}"),
    "median_box": Query(
        _median_box,
        f"""WITH {rounded_sql(5, "quantity")} SELECT 'median' AS box_id, {_MEDIAN_SQL}
        FROM k WHERE {_inside_sql(QUANTITY_BOX)}"""),
    "median_boxes": Query(
        _median_boxes,
        f"""WITH {blips_sql()}, named AS (SELECT *, '(' || {" || ', ' || ".join(
            f"CAST(round_even({k}, 0) AS VARCHAR)" for k in S.KEYS)} || ')' AS box_id FROM blips)
        SELECT box_id, {_MEDIANS_SQL} FROM named GROUP BY box_id"""),
}
