"""Year-keyed metric series, computed within each record: no joins and no shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.functions.text import parse_float, round_exactly, round_number
from sheetstar.operators.sheets import number

_DOCUMENT_METRICS = "map<string,map<string,struct<kind:string,text:string,num:double>>>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluating ``value`` once however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def years(year_values: Column) -> Column:
    """Year headers as text; null when the header row is missing or empty."""
    return F.when(F.size(year_values) > 0, year_values["text"])


def _point(pos: Column, year: Column, value: Column) -> Column:
    """Typed value: a sentinel kept, a number rounded, anything else kept raw."""
    sentinel = (value["kind"] == "str") & value["text"].isin(fixed.SENTINELS)
    return _let(
        number(value),
        lambda parsed: F.struct(
            pos.alias("pos"),
            year.alias("year"),
            F.when(sentinel, "sentinel").when(parsed.isNotNull(), "num").otherwise("raw").alias("kind"),
            F.when(~sentinel, round_number(parsed, fixed.METRIC_DECIMALS)).alias("num"),
            value["text"].alias("text"),
        ),
    )


def _last_per_year(pairs: Column) -> Column:
    """Points of pairs (pos, year, value); a repeated year keeps its last value at its first place."""
    return _let(
        pairs["year"],
        lambda all_years: F.transform(
            F.array_distinct(all_years),
            lambda year: _point(
                F.get(pairs, (F.array_position(all_years, year) - 1).cast("int"))["pos"],
                year,
                F.get(pairs, (F.size(pairs) - F.array_position(F.reverse(all_years), year)).cast("int"))["value"],
            ),
        ),
    )


def with_series(records: DataFrame, align: str = "packed") -> DataFrame:
    """Add ``series``: one entry (metric, points) per metric with values, null without year headers.

    Year i is paired with value i, cut to the shorter of the two (``align="packed"``), or with
    the value standing in the same sheet column (``align="column"``). A point is ``pos, year,
    kind, num, text`` with kind sentinel, num or raw.
    """
    if align not in ("packed", "column"):
        raise ValueError(f"align must be 'packed' or 'column', not {align!r}")
    header = F.col("year_values")

    def packed(values: Column) -> Column:
        paired = F.slice(header, F.lit(1), F.least(F.size(header), F.size(values)))
        return F.transform(
            paired,
            lambda y, i: F.struct(i.alias("pos"), y["text"].alias("year"), F.get(values, i).alias("value")),
        )

    def by_column(values: Column) -> Column:
        lookup = F.map_from_arrays(values["col_idx"], values)
        every = F.transform(
            header,
            lambda y, i: F.struct(
                i.alias("pos"), y["text"].alias("year"), F.element_at(lookup, y["col_idx"]).alias("value")
            ),
        )
        return F.filter(every, lambda p: p["value"].isNotNull())

    pair = packed if align == "packed" else by_column
    series = F.transform(
        F.filter("metric_rows", lambda m: F.size(m["values"]) > 0),
        lambda m: F.struct(m["metric"].alias("metric"), _let(pair(m["values"]), _last_per_year).alias("points")),
    )
    return records.withColumn("series", F.when(F.size(header) > 0, series))


def metric_points(records: DataFrame, exact_rounding: bool = False) -> DataFrame:
    """Long form of ``series``: ``file_id, metric, pos, year, kind, num, text``."""
    # The outer form: the plain one infers a filter on the size of the array, below which the
    # whole series would be worked out a second time.
    points = (
        records.select("file_id", F.inline_outer("series"))
        .select("file_id", "metric", F.inline_outer("points"))
        .filter(F.col("pos").isNotNull())
    )
    if exact_rounding:
        again = round_exactly(F.coalesce(parse_float(F.col("text")), F.col("num")), fixed.METRIC_DECIMALS)
        points = points.withColumn("num", F.when(F.col("kind") == "num", again))
    return points


def metrics_document() -> Column:
    """``series`` and the year headers as one document: years, metric -> year -> value, meaning
    of the sentinels. Null without year headers."""
    metrics = F.map_from_entries(
        F.transform(
            "series",
            lambda s: F.struct(
                s["metric"].alias("metric"),
                F.map_from_arrays(
                    s["points"]["year"],
                    F.transform(s["points"], lambda p: F.struct(p["kind"].alias("kind"), p["text"].alias("text"), p["num"].alias("num"))),
                ).alias("values"),
            ),
        )
    )
    sentinels = F.create_map(*[F.lit(x) for pair in fixed.SENTINEL_MEANINGS.items() for x in pair])
    return F.when(
        F.col("series").isNotNull(),
        F.struct(
            years(F.col("year_values")).alias("years"),
            metrics.cast(_DOCUMENT_METRICS).alias("metrics"),
            sentinels.alias("sentinels"),
        ),
    )


def document_json(document: str = "credit_metrics") -> Column:
    """A metrics document as JSON text, null values written out; null for no document."""
    return F.to_json(document, {"ignoreNullFields": "false"})


def explode_document(df: DataFrame, keys: list[str], document: str = "credit_metrics") -> DataFrame:
    """Long form of a metrics document: ``keys, metric, pos, year, kind, num, text``."""
    doc = F.col(document)
    long = df.select(*keys, doc["years"].alias("years"), F.explode(doc["metrics"]).alias("metric", "series"))
    return long.select(*keys, "years", "metric", F.explode("series").alias("year", "value")).select(
        *keys,
        "metric",
        (F.array_position("years", F.col("year")) - 1).cast("int").alias("pos"),
        "year",
        "value.kind",
        "value.num",
        "value.text",
    )
