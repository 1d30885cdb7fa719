"""Grouped summaries that stay balanced when one group holds most rows.

A rollup over complete facts is one aggregation (``build``); where batches are
merged, or a percentile of real values is wanted, it runs in two steps.

``partials`` groups by the summary keys *plus* the value a percentile (or a
distinct count) is taken over, keeping only additive components.  Spark
combines these on the map side and spreads a hot summary key over as many
reducers as it has distinct values.

``finish`` merges partials to the summary grain.  A percentile is the first
value whose running row count reaches the target rank; it is exact and equals
the discrete percentile of the raw rows, with one row per distinct value to
look at instead of one per event.  Partials of different batches may simply be
unioned.

``state``, ``merge`` and ``result`` are what the streaming jobs use: a state
holds one row per key where values can be counted, and merging keeps it so.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROWS = "_rows"
_VALUES = "_values"


@dataclass(frozen=True)
class Measure:
    """A summary column: additive parts (SQL), how they combine, and the result.

    Expressions are kept as SQL text so summaries can be declared at import
    time, before a session exists.
    """

    name: str
    parts: tuple[tuple[str, str, str], ...]
    result: str


def rows(name: str) -> Measure:
    return Measure(name, (), _ROWS)


def rows_where(name: str, condition: str) -> Measure:
    return Measure(name, ((f"{name}__n", f"count_if({condition})", "sum"),), f"{name}__n")


def total(name: str, value: str) -> Measure:
    return Measure(name, ((f"{name}__s", f"sum(cast({value} as bigint))", "sum"),), f"{name}__s")


def total_cost(name: str, value: str) -> Measure:
    """Sum of USD, kept as decimals until the end: however small, every amount counts."""
    units = f"sum(cast({value} as decimal(38,18)))"
    return Measure(name, ((f"{name}__u", units, "sum"),), f"cast({name}__u as double)")


def total_exact(name: str, value: str, if_empty: float | None = None) -> Measure:
    """Sum of doubles that does not depend on the order of addition."""
    merged = f"cast({name}__d as double)"
    if if_empty is not None:
        merged = f"coalesce({merged}, {if_empty}D)"
    return Measure(name, ((f"{name}__d", f"sum(cast({value} as decimal(28,18)))", "sum"),), merged)


def known(name: str, value: str) -> Measure:
    """Number of rows in which the value is not NULL."""
    return Measure(name, ((f"{name}__k", f"count({value})", "sum"),), f"{name}__k")


def mean(name: str, value: str, digits: int) -> Measure:
    """Mean of integer values."""
    s, k = f"{name}__s", f"{name}__k"
    parts = ((s, f"sum(cast({value} as bigint))", "sum"), (k, f"count({value})", "sum"))
    return Measure(name, parts, f"round({s} / nullif({k}, 0), {digits})")


def mean_exact(name: str, value: str, digits: int) -> Measure:
    """Mean of double values, summed and divided as decimals."""
    d, k = f"{name}__d", f"{name}__k"
    parts = ((d, f"sum(cast({value} as decimal(28,18)))", "sum"), (k, f"count({value})", "sum"))
    return Measure(name, parts, f"cast(round(cast({d} as decimal(28,12)) / nullif({k}, 0), {digits}) as double)")


def peak(name: str, value: str) -> Measure:
    return Measure(name, ((f"{name}__m", f"max({value})", "max"),), f"{name}__m")


@dataclass(frozen=True)
class Percentile:
    """Discrete percentile of ``value``.

    ``bin_width`` counts the values of a group in ranges and ranks only those
    of the range that holds the percentile; set it where a group may hold very
    many distinct values (real-valued columns).  Without it the distinct values of one group are
    ranked in one task, which suits millisecond durations.
    """

    name: str
    value: str
    percent: int
    bin_width: float | None = None


@dataclass(frozen=True)
class DistinctCount:
    name: str
    value: str


@dataclass(frozen=True)
class Rollup:
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    percentile: Percentile | None = None
    distinct: DistinctCount | None = None
    columns: tuple[str, ...] = field(default=())

    def __post_init__(self):
        if self.percentile and self.distinct:
            raise ValueError("a rollup takes a percentile or a distinct count, not both")

    # -- step 1 -----------------------------------------------------------
    def partials(self, facts: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
        """Additive components per key and percentile/distinct value.

        ``extra_keys`` keeps attributes that are replaced before ``finish``,
        for example a user id that a later dimension join turns into a team.
        """
        have = set(facts.columns)
        grain = [F.col(k) for k in (*self.keys, *extra_keys) if k in have]
        if self.percentile:
            grain.append(F.col(self.percentile.value).alias("_value"))
        if self.distinct:
            grain.append(F.col(self.distinct.value).alias("_value"))
        parts = [F.count(F.lit(1)).alias(_ROWS)]
        parts += [F.expr(expression).alias(name) for m in self.measures for name, expression, _ in m.parts]
        return facts.groupBy(*grain).agg(*parts)

    # -- mergeable states: one row per key where values can be counted -----
    @property
    def _counts_values(self) -> bool:
        return self.percentile is not None and not self.percentile.bin_width

    def _merges(self) -> list[Column]:
        parts = [(_ROWS, "sum")] + [(name, how) for m in self.measures for name, _, how in m.parts]
        return [(F.max(name) if how == "max" else F.sum(name)).alias(name) for name, how in parts]

    def state(self, facts: DataFrame) -> DataFrame:
        """Rows that ``merge`` can combine and ``result`` turns into the summary.

        With a percentile of whole numbers there is one row per key: a map of
        value to count stands for all its values, so its size is bounded by the
        range of values.  Otherwise the rows are the partials, one per key and value.
        """
        parts = self.partials(facts)
        if not self._counts_values:
            return parts
        counted = F.when(F.col("_value").isNotNull(), F.struct("_value", _ROWS))
        return parts.groupBy(*self.keys).agg(*self._merges(), F.map_from_entries(F.collect_list(counted)).alias(_VALUES))

    def merge(self, states: DataFrame) -> DataFrame:
        """States of several batches as one row per key (and value).

        Counts of equal values are added map by map; a key has one map per
        state that is merged, few whatever the number of rows behind them.
        """
        if not self._counts_values:
            return states.groupBy(*self.keys, *(["_value"] if self.percentile or self.distinct else [])).agg(*self._merges())
        gathered = states.groupBy(*self.keys).agg(*self._merges(), F.collect_list(_VALUES).alias(_VALUES))
        both = "map_zip_with(a, m, (v, x, y) -> coalesce(x, 0L) + coalesce(y, 0L))"
        added = F.expr(f"aggregate(slice({_VALUES}, 2, greatest(size({_VALUES}) - 1, 0)), {_VALUES}[0], (a, m) -> {both})")
        return gathered.withColumn(_VALUES, added)

    def result(self, states: DataFrame) -> DataFrame:
        """The summary of merged or unmerged states."""
        if not self._counts_values:
            return self.finish(states)
        merged = self.merge(states)
        p, kind = self.percentile, merged.schema[_VALUES].dataType.keyType.simpleString()
        reached = f"aggregate(map_values({_VALUES}), 0L, (a, n) -> a + n)"
        rank = f"greatest(({reached} * {p.percent} + 99) div 100, 1L)"
        step = "if(a.hit is null and a.upto + e.value >= a.rank, e.key, a.hit)"
        walk = (
            f"aggregate(array_sort(map_entries({_VALUES})), struct(0L as upto, {rank} as rank, cast(null as {kind}) as hit), "
            f"(a, e) -> struct(a.upto + e.value as upto, a.rank as rank, {step} as hit), a -> a.hit)"
        )
        results = [F.expr(m.result).alias(m.name) for m in self.measures]
        out = merged.select(*self.keys, *results, F.expr(walk).alias(p.name))
        return out.select(*self.columns) if self.columns else out

    # -- step 2 -----------------------------------------------------------
    def finish(self, partials: DataFrame) -> DataFrame:
        merges = [F.sum(_ROWS).alias(_ROWS)]
        merges += [
            (F.max(name) if how == "max" else F.sum(name)).alias(name)
            for m in self.measures
            for name, _, how in m.parts
        ]
        results = [F.expr(m.result).alias(m.name) for m in self.measures]
        if self.percentile and self.percentile.bin_width:
            merged = self._refined_percentile(partials.withColumn("_weight", F.col(_ROWS)), merges, merges)
            results.append(F.col(self.percentile.name))
        elif self.percentile:
            by_value = Window.partitionBy(*self.keys).orderBy("_value")
            weight = F.when(F.col("_value").isNotNull(), F.col(_ROWS)).otherwise(F.lit(0))
            ranked = partials.withColumn(
                "_reached", F.sum(weight).over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            ).withColumn("_of", F.sum(weight).over(Window.partitionBy(*self.keys)))
            hit = (F.col("_reached") >= self._rank("_of")) & F.col("_value").isNotNull()
            merges.append(F.min(F.when(hit, F.col("_value"))).alias(self.percentile.name))
            merged = ranked.groupBy(*self.keys).agg(*merges)
            results.append(F.col(self.percentile.name))
        elif self.distinct:
            # Partials of several batches may repeat a value, so the distinct
            # count is taken over the merged rows.
            once = partials.groupBy(*self.keys, "_value").agg(*merges)
            merges.append(F.count("_value").alias(self.distinct.name))
            merged = once.groupBy(*self.keys).agg(*merges)
            results.append(F.col(self.distinct.name))
        else:
            merged = partials.groupBy(*self.keys).agg(*merges)
        out = merged.select(*self.keys, *results)
        return out.select(*self.columns) if self.columns else out

    def build(self, facts: DataFrame) -> DataFrame:
        """The summary of complete facts.

        A percentile of whole numbers is taken in the same single aggregation:
        it combines on the map side and holds one entry per distinct value, so
        a hot group costs no more than its value range.  Distinct counts take
        the two steps, and real values are selected by their histogram.
        """
        p = self.percentile
        if self.distinct:
            return self.finish(self.partials(facts))
        parts = [F.count(F.lit(1)).alias(_ROWS)]
        parts += [F.expr(expression).alias(name) for m in self.measures for name, expression, _ in m.parts]
        results = [F.expr(m.result).alias(m.name) for m in self.measures]
        if p and p.bin_width:
            values = facts.withColumns({"_value": F.col(p.value), "_weight": F.lit(1)})
            out = self._refined_percentile(values, parts, self._merges()).select(*self.keys, *results, p.name)
            return out.select(*self.columns) if self.columns else out
        if p:
            kind = facts.schema[p.value].dataType
            parts.append(F.expr(f"percentile_disc({p.percent}/100D) within group (order by {p.value})").cast(kind).alias(p.name))
            results.append(F.col(p.name))
        out = facts.groupBy(*self.keys).agg(*parts).select(*self.keys, *results)
        return out.select(*self.columns) if self.columns else out

    def totals(self, facts: DataFrame) -> DataFrame:
        """The same rows without percentile and distinct count: one aggregation by the keys, where only counts and sums are asked for."""
        return replace(self, percentile=None, distinct=None, columns=()).build(facts)

    def _rank(self, of: str) -> Column:
        """ceil(percent/100 * n), at least 1, in whole numbers."""
        p = self.percentile.percent
        return F.greatest(F.expr(f"({of} * {p} + 99) div 100"), F.lit(1))

    def _refined_percentile(self, values: DataFrame, parts: list[Column], merges: list[Column]) -> DataFrame:
        """Selection by histogram: counts per bin name the bin of the rank, and only that bin is ranked value by value.

        ``values`` has ``_value`` and ``_weight``; ``parts`` makes the
        components of a bin, ``merges`` those of a group from its bins.  The
        first pass moves one row per bin, the second the values of the bins
        that were named; both combine on the map side.  Ranks come from
        windows, which spill, so neither bins nor values are bounded.
        """
        keys, p = list(self.keys), self.percentile
        into = F.when(F.isnan("_value"), F.lit(2**63 - 1)).otherwise(F.floor(F.col("_value") / F.lit(p.bin_width)))
        binned = values.withColumn("_bin", into)
        total = F.sum(F.when(F.col("_value").isNotNull(), F.col("_weight")).otherwise(F.lit(0))).alias("_weight")

        by_bin = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        bins = binned.groupBy(*keys, "_bin").agg(*parts, total).withColumns(
            {"_upto": F.sum("_weight").over(by_bin), "_of": F.sum("_weight").over(Window.partitionBy(*keys))}
        )
        rank, before = self._rank("_of"), F.col("_upto") - F.col("_weight")
        hit = (F.col("_upto") >= rank) & (before < rank) & F.col("_bin").isNotNull()
        groups = bins.groupBy(*keys).agg(
            *merges, F.min(F.when(hit, F.col("_bin"))).alias("_bin"), F.min(F.when(hit, rank - before)).alias("_rank")
        )

        # One struct as key: its fields are equal when both are NULL, and what
        # is partitioned by it for the join is so for the ranking as well.  A
        # group without values has no bin, and finds its rows without one.
        place = F.struct(*keys, "_bin").alias("_place")
        groups = groups.select(place, "*").drop("_bin")
        counted = binned.groupBy(place, "_value").agg(total)
        by_value = Window.partitionBy("_place").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = groups.join(counted, "_place").withColumn("_reached", F.sum("_weight").over(by_value))
        names = [_ROWS] + [name for m in self.measures for name, _, _ in m.parts]
        return ranked.groupBy("_place").agg(
            *[F.max(name).alias(name) for name in names],
            F.min(F.when(F.col("_reached") >= F.col("_rank"), F.col("_value"))).alias(p.name),
        ).select("_place.*", *names, p.name).drop("_bin")
