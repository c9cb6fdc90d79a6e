"""Exact quantiles without holding a column's values in one task.

The built-in exact percentile keeps a map of all distinct values in the final task. Here the
bracket of values around each wanted rank is narrowed by counting, until it holds few enough rows
for one task to rank: each round counts the rows of 4096 equal parts of the bracket and keeps the
part with the rank. Where the values are so unevenly spread that this gains little, a round uses
Spark's quantile sketch instead and checks its answer by counting.

Brackets are in doubles, and no value leaves its order by becoming one. Values that doubles do not tell apart (of bigint,
long decimals, timestamps) are ranked as what they are once the bracket is small, so their quantiles are exact as well.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from fractions import Fraction
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import sqltext as sql
from plumbline.sources.readers import staged

# A bracket with at most this many rows is ranked directly.
RANKED_ROWS = 1_000_000
PARTS = 4096
SKETCH_ACCURACY = 10_000
MAX_ROUNDS = 40
# A wide table is searched in several plans.
COLUMNS_PER_JOB = 32


# Integers up to here, and decimals of so many digits, are doubles of their own.
WHOLE_DOUBLES = 2**53
DOUBLE_DIGITS = 15


@dataclass(frozen=True)
class Order:
    """The number that a column is ordered by, as SQL text. `wide`: doubles do not tell all of its values apart."""

    key: str
    wide: bool = False
    # At most some thousand values share a double.
    few: bool = True


def order_of(column: str, data_type: T.DataType) -> Order:
    name = sql.name(column)
    if isinstance(data_type, T.LongType):
        return Order(name, wide=True)
    if isinstance(data_type, T.DecimalType):
        return Order(name, wide=data_type.precision > DOUBLE_DIGITS, few=False)
    if isinstance(data_type, T.DateType):
        return Order(f"unix_date({name})")
    if isinstance(data_type, T.TimestampType):
        return Order(f"unix_micros({name})", wide=True)
    return Order(name)


@dataclass(frozen=True)
class _Span:
    """The rows of a column with low <= value <= high; `below` rows are smaller."""

    column: str
    order: Order
    low: float
    high: float
    below: int
    rows: int

    def value(self) -> Column:
        return F.expr(f"CAST({self.order.key} AS DOUBLE)")

    def ranked(self) -> Column:
        """What the rows are ordered by in the end."""
        return F.expr(self.order.key) if self.order.wide else self.value()

    def holds(self) -> Column:
        return self.value().isNotNull() & (self.value() >= self.low) & (self.value() <= self.high)

    @property
    def divisible(self) -> bool:
        return math.isfinite(self.low) and math.isfinite(self.high) and math.isfinite(self.high - self.low)

    @property
    def same(self) -> bool:
        """One double is left."""
        return self.low == self.high or (math.isnan(self.low) and math.isnan(self.high))

    def settled(self, ranked_rows: int) -> bool:
        return self.same or self.rows <= ranked_rows

    def rankable(self, ranked_rows: int) -> bool:
        return self.rows <= ranked_rows or (self.same and (self.order.few or not self.order.wide))


_Target = tuple[str, int]  # column and rank from 0


def _disjoint(spans: list[tuple[int, _Span]]) -> bool:
    ordered = sorted((span for _, span in spans), key=lambda span: span.low)
    return all(a.high < b.low for a, b in zip(ordered, ordered[1:]))


def _members(df: DataFrame, spans: list[tuple[int, _Span]], value=_Span.value, **fields) -> DataFrame:
    """A row (slot, v, fields) per row and span it lies in, of a column's spans. One scan serves all of them."""
    inside = df.where(reduce(lambda a, b: a | b, [span.holds() for _, span in spans]))
    fields = {"slot": None, "v": value, **fields}
    if not _disjoint(spans):
        entries = [
            F.when(span.holds(), F.struct(*[_field(f, slot, span).alias(name) for name, f in fields.items()]))
            for slot, span in spans
        ]
        return inside.select(F.inline(F.filter(F.array(*entries), lambda entry: entry.isNotNull())))
    # A row lies in one span only. Without an array and a generator for each, Spark compiles the whole pass.
    *others, (last_slot, last) = spans
    columns = []
    for name, field in fields.items():
        own = _field(field, last_slot, last)
        for slot, span in reversed(others):
            own = F.when(span.holds(), _field(field, slot, span)).otherwise(own)
        columns.append(own.alias(name))
    return inside.select(*columns)


def _field(build, slot: int, span: _Span) -> Column:
    return F.lit(slot) if build is None else build(span)


def _by_column(spans: Mapping[_Span, list[int]]) -> dict[str, list[tuple[int, _Span]]]:
    found: dict[str, list[tuple[int, _Span]]] = {}
    for slot, span in enumerate(spans):
        found.setdefault(span.column, []).append((slot, span))
    return found


def _part(span: _Span) -> Column:
    share = (span.value() - span.low) / (span.high - span.low)
    return F.least(F.floor(share * PARTS), F.lit(PARTS - 1))


def _by_parts(df: DataFrame, spans: Mapping[_Span, list[int]]) -> dict[_Target, _Span]:
    """For each span and its wanted ranks: the part of the span that holds the rank. One scan per column."""
    listed = list(spans)
    searches = []
    for own in _by_column(spans).values():
        counted = (
            _members(df, own, part=_part)
            .groupBy("slot", "part")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        )
        # At most 4096 rows per span are ordered here.
        order = Window.partitionBy("slot").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
        wanted = [F.struct(F.lit(slot).alias("slot"), F.lit(r - span.below).alias("rank")) for slot, span in own for r in spans[span]]
        ranks = F.transform(F.filter(F.array(*wanted), lambda w: w["slot"] == F.col("slot")), lambda w: w["rank"])
        searches.append(
            counted.withColumn("before", F.sum("n").over(order) - F.col("n"))
            .withColumn("rank", F.explode(ranks))
            .where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
            .select("slot", "rank", "before", "n", "low", "high")
        )
    found = {}
    for row in reduce(DataFrame.unionByName, searches).collect():  # one row per wanted rank
        span = listed[row["slot"]]
        found[(span.column, row["rank"] + span.below)] = _Span(
            span.column, span.order, row["low"], row["high"], span.below + row["before"], row["n"]
        )
    return found


def _by_sorting(df: DataFrame, spans: Mapping[_Span, list[int]]) -> dict[_Target, Any]:
    """The values at ranks of spans that no round could narrow: their values are counted and sorted by range.

    The sorted counts are written part by part; the part with a rank is known from the parts' sums, and only
    that part is ordered by a window.
    """
    values = {}
    for span, ranks in spans.items():
        counted = df.where(span.holds()).groupBy(span.ranked().alias("v")).agg(F.count(F.lit(1)).alias("n"))
        parts = staged(counted.orderBy("v").withColumn("part", F.spark_partition_id()))
        sums = parts.groupBy("part").agg(F.sum("n").alias("n"), F.min("v").alias("low")).collect()  # one row per task
        before = 0
        for row in sorted(sums, key=lambda r: (math.isnan(r["low"]), r["low"])):
            inside = [r for r in ranks if before <= r - span.below < before + row["n"]]
            if inside:
                upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
                own = parts.where(F.col("part") == row["part"]).withColumn("upto", upto)
                found = own.agg(
                    *[F.min(F.when(F.col("upto") > r - span.below - before, F.col("v"))).alias(f"r{r}") for r in inside]
                ).first()
                values |= {(span.column, r): found[f"r{r}"] for r in inside}
            before += row["n"]
    return values


def _by_sketch(df: DataFrame, spans: Mapping[_Span, list[int]], slack: float) -> dict[_Target, _Span]:
    """The same, for spans that equal parts do not divide well. A refused proposal leaves the span as it is."""
    asked, owners = [], []
    for span, ranks in spans.items():
        for rank in ranks:
            share = (rank - span.below) / span.rows
            ends = [F.lit(max(0.0, share - slack)), F.lit(min(1.0, share + slack))]
            inside = F.when(span.holds(), span.value())
            asked.append(
                F.percentile_approx(inside, F.array(*ends), F.lit(SKETCH_ACCURACY)).alias(f"e{len(owners)}")
            )
            owners.append((span, rank))
    proposed = df.agg(*asked).first()
    counts, tight = [], []
    for i, (span, _) in enumerate(owners):
        low, high = proposed[f"e{i}"]
        tight.append(replace(span, low=low, high=high))
        counts.append(F.count_if(span.holds() & (span.value() < low)).alias(f"b{i}"))
        counts.append(F.count_if(tight[i].holds()).alias(f"n{i}"))
    checked = df.agg(*counts).first()
    found = {}
    for i, (span, rank) in enumerate(owners):
        below, rows = span.below + checked[f"b{i}"], checked[f"n{i}"]
        if below <= rank < below + rows:
            found[(span.column, rank)] = replace(tight[i], below=below, rows=rows)
        else:
            found[(span.column, rank)] = span
    return found


def _grouped(targets: Mapping[_Target, _Span]) -> dict[_Span, list[int]]:
    spans: dict[_Span, list[int]] = {}
    for (_, rank), span in targets.items():
        spans.setdefault(span, []).append(rank)
    return spans


def _order_statistics(df: DataFrame, spans: Mapping[_Span, list[int]]) -> dict[_Target, Any]:
    """The value at each wanted rank of spans that are small enough to rank. Reads each column once."""
    listed = list(spans)
    searches = []
    for own in _by_column(spans).values():
        counted = _members(df, own, _Span.ranked).groupBy("slot", "v").agg(F.count(F.lit(1)).alias("n"))
        # A span has at most `ranked_rows` rows, or the few values that one double stands for.
        upto = F.sum("n").over(Window.partitionBy("slot").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        wanted = [F.struct(F.lit(slot).alias("slot"), F.lit(r - span.below).alias("rank")) for slot, span in own for r in spans[span]]
        ranks = F.filter(F.array(*wanted), lambda w: (w["slot"] == F.col("slot")))
        searches.append(
            counted.withColumn("upto", upto)
            .withColumn("rank", F.explode(F.transform(ranks, lambda w: w["rank"])))
            .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
            .select("slot", "rank", *_exact(own[0][1].order))
        )
    values = {}
    for row in reduce(DataFrame.unionByName, searches).collect():  # one row per wanted rank
        span = listed[row["slot"]]
        values[(span.column, row["rank"] + span.below)] = row["v"] if row["own"] is None else decimal.Decimal(row["own"])
    return values


def _exact(order: Order) -> list[Column]:
    # Columns of several types meet in one result: doubles as such, other numbers as text.
    value, nothing = F.col("v"), F.lit(None)
    kinds = (nothing, value) if order.wide else (value, nothing)
    return [kinds[0].cast("double").alias("v"), kinds[1].cast("string").alias("own")]


def between(low: Any, high: Any, share: float) -> float | decimal.Decimal:
    """The value at a share of the way from one value to the next. It is a double unless doubles would round it."""
    if isinstance(low, float) and isinstance(high, float):
        return low if low == high else low + (high - low) * share
    if float(low) == low and float(high) == high and (low == high or max(abs(low), abs(high)) <= WHOLE_DOUBLES):
        return between(float(low), float(high), share)
    exact = Fraction(low) + (Fraction(high) - Fraction(low)) * Fraction(share)
    with decimal.localcontext(prec=60):
        return decimal.Decimal(exact.numerator) / decimal.Decimal(exact.denominator)


_EPOCH = dt.datetime(1970, 1, 1)


def _restored(value: Any, data_type: T.DataType) -> Any:
    if isinstance(data_type, T.DateType):
        return _EPOCH + dt.timedelta(days=value)
    if isinstance(data_type, T.TimestampType):
        return _EPOCH + dt.timedelta(microseconds=math.floor(value))
    return value


def _facts(df: DataFrame, orders: Mapping[str, Order]) -> dict[str, tuple[int, float, float]]:
    asked, columns = [], list(orders)
    for i, name in enumerate(columns):
        value = F.expr(f"CAST({orders[name].key} AS DOUBLE)")
        asked += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"low{i}"), F.max(value).alias(f"high{i}")]
    known = df.agg(*asked).first()
    return {name: (known[f"n{i}"], known[f"low{i}"], known[f"high{i}"]) for i, name in enumerate(columns)}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    ranked_rows: int = RANKED_ROWS,
    facts: Mapping[str, tuple[int, float, float]] | None = None,
) -> dict[str, list[Any]]:
    """The quantiles of numeric columns, dates and timestamps, with linear interpolation between ranks.

    They are doubles, or decimals where a double would round them: of bigint beyond 2^53 and of decimals with more than 15
    digits. Those of dates and timestamps are `datetime` values in UTC. A column without values is left out. Each round reads a column that is still open once, all its brackets together.
    `facts` gives the (count, min, max) of each column where they are known already.
    """
    if len(columns) > COLUMNS_PER_JOB:
        parts = [columns[i : i + COLUMNS_PER_JOB] for i in range(0, len(columns), COLUMNS_PER_JOB)]
        return {k: v for part in parts for k, v in exact_quantiles(df, part, probabilities, ranked_rows, facts).items()}
    types = {name: df.select(sql.name(name)).schema[0].dataType for name in columns}
    orders = {name: order_of(name, types[name]) for name in columns}
    facts = facts or _facts(df, orders)
    wanted: dict[str, list[float]] = {}
    targets: dict[_Target, _Span] = {}
    for name in columns:
        rows, low, high = facts[name]
        if rows:
            wanted[name] = [p * (rows - 1) for p in probabilities]
            span = _Span(name, orders[name], low, high, 0, rows)
            for place in wanted[name]:
                targets[(name, math.floor(place))] = targets[(name, math.ceil(place))] = span
    if not wanted:
        return {}

    slow: set[_Target] = set()
    slack = 3.0 / SKETCH_ACCURACY
    for _ in range(MAX_ROUNDS):
        open_ = {t: s for t, s in targets.items() if not s.settled(ranked_rows)}
        if not open_:
            break
        sketched = {t: s for t, s in open_.items() if t in slow or not s.divisible}
        parted = {t: s for t, s in open_.items() if t not in sketched}
        found = _by_parts(df, _grouped(parted)) if parted else {}
        slow = {t for t, s in found.items() if s.rows * 10 > targets[t].rows}
        if sketched:
            narrowed = _by_sketch(df, _grouped(sketched), slack)
            if any(narrowed[t] == s for t, s in sketched.items()):
                slack *= 8
            found |= narrowed
        targets |= found
    stuck = {t: s for t, s in targets.items() if not s.rankable(ranked_rows)}
    values = _by_sorting(df, _grouped(stuck)) if stuck else {}
    values |= {t: s.low for t, s in targets.items() if s.low == s.high and not s.order.wide}
    rest = {t: s for t, s in targets.items() if t not in values}
    if rest:
        values |= _order_statistics(df, _grouped(rest))
    result = {}
    for name, places in wanted.items():
        result[name] = []
        for place in places:
            low, high = values[(name, math.floor(place))], values[(name, math.ceil(place))]
            result[name].append(_restored(between(low, high, place - math.floor(place)), types[name]))
    return result
