"""Bucket and metric aggregations over the documents a query matches.

Requests are small immutable values; running them gives tidy DataFrames. All metrics of one level share
one ``groupBy``, every bucket level is one partial-then-final aggregation, and only the top buckets of a
level are carried into the next. Bucket aggregations that stand beside each other, and the metrics beside
them, share one scan and one ``groupBy``: a row is expanded to its bucket in each of them.

``aggregate`` returns ``{name: DataFrame}``. All top-level metrics come in one row under ``"metrics"``;
a bucket aggregation nested in another is under ``"outer>inner"`` with the outer keys as columns.
"""

from __future__ import annotations

from collections.abc import Mapping as Dict
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.errors import AggregationError
from quillspark.functions.values import facet_ancestors
from quillspark.mapping import Mapping
from quillspark.plans.compile import compile_query
from quillspark.plans.query import All, Query, as_query
from quillspark.sources.index import Index

# Default number of term buckets, default percents, units of fixed intervals in milliseconds.
BUCKETS = 10
STATS = ("count", "min", "max", "avg", "sum")
SPREAD = ("sum_of_squares", "variance_population", "variance_sampling", "std_deviation_population", "std_deviation_sampling")
PERCENTS = (1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0)
INTERVAL_MS = {"ms": 1, "s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}
PERCENTILE_ACCURACY = 10_000
# Reported buckets up to this many are broadcast to the next level; beyond it they are joined.
BROADCAST_BUCKETS = 10_000
# Empty buckets are made in runs of so many, so that no array holds all of a wide histogram.
GRID_RUN = 65_536

Aggs = Dict[str, "Aggregation"]


class Aggregation:
    """Base of all aggregation requests."""


@dataclass(frozen=True)
class Metric(Aggregation):
    """One number, or a few, over a field."""

    kind: str
    field: str
    percents: tuple[float, ...] = ()
    accuracy: int = PERCENTILE_ACCURACY
    exact: bool = False
    missing: float | None = None


@dataclass(frozen=True)
class Bucket(Aggregation):
    field: str
    aggs: Aggs = field(default_factory=dict)


@dataclass(frozen=True)
class Terms(Bucket):
    size: int = BUCKETS
    order: tuple[str, str] = ("_count", "desc")
    missing: object = None
    min_doc_count: int = 1


@dataclass(frozen=True)
class Histogram(Bucket):
    interval: float = 1.0
    min_doc_count: int = 0
    offset: float = 0.0
    hard_bounds: tuple[float, float] | None = None
    extended_bounds: tuple[float, float] | None = None


@dataclass(frozen=True)
class DateHistogram(Bucket):
    interval: str = "1d"
    min_doc_count: int = 0
    offset: str = "0d"
    hard_bounds: tuple[int, int] | None = None
    extended_bounds: tuple[int, int] | None = None


@dataclass(frozen=True)
class Ranges(Bucket):
    ranges: tuple[tuple[float | None, float | None, str | None], ...] = ()


@dataclass(frozen=True)
class TopHits(Aggregation):
    """The first ``size`` documents of every bucket, by a field or by several with a direction each."""

    sort: str | tuple[tuple[str, str], ...]
    size: int = 3
    descending: bool = True
    show: tuple[str, ...] = ()

    @property
    def keys(self) -> tuple[tuple[str, str], ...]:
        return ((self.sort, "desc" if self.descending else "asc"),) if isinstance(self.sort, str) else tuple(self.sort)


def terms(field: str, size: int = BUCKETS, order: tuple[str, str] = ("_count", "desc"), aggs: Aggs | None = None, missing=None,
          min_doc_count: int = 1) -> Terms:
    """Buckets of equal values, the most frequent first; order by ``_count``, ``_key`` or a metric."""
    return Terms(field, aggs or {}, size, order, missing, min_doc_count)


def histogram(field: str, interval: float, min_doc_count: int = 0, aggs: Aggs | None = None, offset: float = 0.0,
              hard_bounds=None, extended_bounds=None) -> Histogram:
    """Buckets of equal width; with ``min_doc_count`` 0 the gaps between them appear as empty buckets."""
    return Histogram(field, aggs or {}, interval, min_doc_count, offset, hard_bounds, extended_bounds)


def date_histogram(field: str, interval: str, min_doc_count: int = 0, aggs: Aggs | None = None, offset: str = "0d",
                   hard_bounds=None, extended_bounds=None) -> DateHistogram:
    """Buckets of a fixed time, such as ``30s``, ``1h`` or ``1d``, aligned to the epoch in UTC, or ``offset`` (``-6h``) from
    it. Bounds are milliseconds of the epoch."""
    return DateHistogram(field, aggs or {}, interval, min_doc_count, offset, hard_bounds, extended_bounds)


def ranges(field: str, spans: list[dict], aggs: Aggs | None = None) -> Ranges:
    """Buckets ``from`` (inclusive) ``to`` (exclusive); they may overlap and are all reported."""
    found = tuple((s.get("from"), s.get("to"), s.get("key")) for s in spans)
    return Ranges(field, aggs or {}, found)


def avg(field: str, missing: float | None = None) -> Metric:
    return Metric("avg", field, missing=missing)


def min_(field: str, missing: float | None = None) -> Metric:
    return Metric("min", field, missing=missing)


def max_(field: str, missing: float | None = None) -> Metric:
    return Metric("max", field, missing=missing)


def sum_(field: str, missing: float | None = None) -> Metric:
    return Metric("sum", field, missing=missing)


def count(field: str) -> Metric:
    """Documents that have a value in the field."""
    return Metric("count", field)


def stats(field: str, missing: float | None = None) -> Metric:
    return Metric("stats", field, missing=missing)


def extended_stats(field: str, missing: float | None = None) -> Metric:
    return Metric("extended_stats", field, missing=missing)


def percentiles(field: str, percents: tuple[float, ...] = PERCENTS, accuracy: int = PERCENTILE_ACCURACY) -> Metric:
    """Values at the given percents; the rank error is at most one in ``accuracy``, memory is bounded by it."""
    return Metric("percentiles", field, tuple(percents), accuracy)


def cardinality(field: str, exact: bool = False) -> Metric:
    """Distinct values, by a sketch of fixed size or exactly."""
    return Metric("cardinality", field, exact=exact)


# -- columns ---------------------------------------------------------------------------------


def _check(mapping: Mapping, name: str) -> Column:
    if not mapping.has(name):
        raise AggregationError(f"unknown field: {name}")
    if not mapping.field(name).fast:
        raise AggregationError(f"field {name} is not a fast field")
    return F.col(f"`{name}`")


def _numeric(mapping: Mapping, name: str) -> Column:
    column, kind = _check(mapping, name), mapping.type_of(name)
    if kind in ("u64", "i64", "f64"):
        return column
    if kind == "bool":
        return column.cast("int")
    if kind == "date":
        return F.unix_millis(column)
    raise AggregationError(f"field {name} of type {kind} has no numbers to aggregate")


def metric_columns(mapping: Mapping, name: str, metric: Metric, only: Column | None = None) -> list[Column]:
    """The aggregate columns of one metric, named ``name`` or ``name_part``; over the rows ``only`` tells, if given."""
    kind = metric.kind
    chosen = (lambda c: c) if only is None else (lambda c: F.when(only, c))
    if kind == "count":
        return [F.count(chosen(_check(mapping, metric.field))).alias(name)]
    if kind == "cardinality":
        column = chosen(_check(mapping, metric.field))
        found = F.count_distinct(column) if metric.exact else F.approx_count_distinct(column)
        return [found.alias(name)]
    value = _numeric(mapping, metric.field)
    if metric.missing is not None:
        value = F.coalesce(value, F.lit(metric.missing))
    value = chosen(value)
    simple = {"avg": F.avg, "min": F.min, "max": F.max}
    if kind in simple:
        return [simple[kind](value).alias(name)]
    total = F.coalesce(F.sum(value), F.lit(0))
    if kind == "sum":
        return [total.alias(name)]
    if kind == "percentiles":
        fractions = [p / 100.0 for p in metric.percents]
        found = F.approx_percentile(value, fractions, metric.accuracy)
        return [F.coalesce(found, F.array().cast(f"array<{'double' if mapping.type_of(metric.field) == 'f64' else 'bigint'}>")).alias(name)]
    parts = {"count": F.count(value), "min": F.min(value), "max": F.max(value), "avg": F.avg(value), "sum": total}
    if kind == "extended_stats":
        wide = value.cast("double")
        parts |= {
            "sum_of_squares": F.coalesce(F.sum(wide * wide), F.lit(0.0)),
            "variance_population": F.var_pop(wide),
            "variance_sampling": F.var_samp(wide),
            "std_deviation_population": F.stddev_pop(wide),
            "std_deviation_sampling": F.stddev_samp(wide),
        }
    elif kind != "stats":
        raise AggregationError(f"unknown metric: {kind}")
    return [c.alias(f"{name}_{part}") for part, c in parts.items()]


def metric_names(name: str, metric: Metric) -> list[str]:
    """The names of those columns, in their order."""
    parts = {"stats": STATS, "extended_stats": STATS + SPREAD}.get(metric.kind)
    return [f"{name}_{part}" for part in parts] if parts else [name]


def percentile_rows(metrics: DataFrame, name: str, metric: Metric) -> DataFrame:
    """``(percent, value)`` rows of a percentiles column."""
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in metric.percents]).alias("percent"), F.col(name).alias("value"))
    return metrics.select(F.inline(pairs)).toDF("percent", "value")


# -- scope -----------------------------------------------------------------------------------


def scope(index: Index, query: str | Query | list | None = None, fields: tuple[str, ...] = ()) -> DataFrame:
    """The documents to aggregate: all of them, or those a query matches."""
    if query is None or isinstance(query, All):
        return index.docs
    key = index.mapping.key
    compiled = compile_query(as_query(query, fields), index, filter_only=True)
    if compiled.condition is not None:
        return index.docs.filter(compiled.condition)
    return index.docs_of(compiled.keys(key), "left_semi")


# -- buckets ---------------------------------------------------------------------------------


def _interval_ms(interval: str) -> int:
    unit = next((u for u in ("ms", "s", "m", "h", "d") if interval.endswith(u) and interval[: -len(u)].isdigit()), None)
    if unit is None or int(interval[: -len(unit)]) == 0:
        raise AggregationError(f"invalid fixed interval: {interval}")
    return int(interval[: -len(unit)]) * INTERVAL_MS[unit]


def _offset_ms(offset: str) -> int:
    sign, size = (-1, offset[1:]) if offset.startswith("-") else (1, offset)
    return 0 if size.rstrip("msdh") == "0" else sign * _interval_ms(size)


def _below(value: float | None) -> float:
    return float("-inf") if value is None else value


def _number(value: float | None) -> str:
    if value is None:
        return "*"
    return str(int(value)) if float(value).is_integer() else repr(float(value))


def _zeroed(rows: DataFrame, metrics: Dict[str, Metric]) -> DataFrame:
    """What metrics say of no rows, where they are null."""
    zero = {}
    for n, m in metrics.items():
        names = {"sum": [n], "count": [n], "cardinality": [n], "stats": [f"{n}_count", f"{n}_sum"],
                 "extended_stats": [f"{n}_count", f"{n}_sum", f"{n}_sum_of_squares"]}.get(m.kind, [])
        zero |= {c: F.coalesce(c, F.lit(0)) for c in names}
        if m.kind == "percentiles":
            zero[n] = F.coalesce(n, F.array().cast(rows.schema[n].dataType))
    return rows.withColumns(zero) if zero else rows


class _Level:
    """One bucket aggregation at one depth: how rows get a key, and how its buckets are finished."""

    def __init__(self, mapping: Mapping, name: str, agg: Bucket, parents: list[_Level]):
        self.mapping, self.name, self.agg = mapping, name, agg
        self.outer = [p.key for p in parents]
        # Kept apart from the documents' own columns until the result is labelled.
        self.key = f"_bucket{len(parents)}"
        self.metrics = {n: a for n, a in agg.aggs.items() if isinstance(a, Metric)}

    def lanes(self) -> list[Column]:
        """The bucket of a row, null where it has none; ranges that overlap are told apart in several columns."""
        agg = self.agg
        if isinstance(agg, Terms):
            value = _check(self.mapping, agg.field)
            return [value if agg.missing is None else F.coalesce(value, F.lit(agg.missing))]
        if isinstance(agg, Histogram):
            if agg.interval <= 0:
                raise AggregationError("histogram interval must be positive")
            value = _numeric(self.mapping, agg.field)
            number = F.floor((value - F.lit(agg.offset)) / F.lit(float(agg.interval)))
            return [number if agg.hard_bounds is None else F.when(value.between(*agg.hard_bounds), number)]
        if isinstance(agg, DateHistogram):
            value = _numeric(self.mapping, agg.field)
            if self.mapping.type_of(agg.field) != "date":
                raise AggregationError(f"not a date field: {agg.field}")
            step = _interval_ms(agg.interval)
            millis = value - _offset_ms(agg.offset)
            number = ((millis - F.pmod(millis, F.lit(step))) / step).cast("bigint")
            return [number if agg.hard_bounds is None else F.when(value.between(*agg.hard_bounds), number)]
        if isinstance(agg, Ranges):
            value = _numeric(self.mapping, agg.field)
            lanes: list[tuple[float, Column]] = []  # where the last range ends, and the ranges so far
            ends = lambda i: (_below(agg.ranges[i][0]), i)
            for i in sorted(range(len(agg.ranges)), key=ends):
                low, high, _ = agg.ranges[i]
                tests = [value.isNotNull()]
                tests += [value >= low] if low is not None else []
                tests += [value < high] if high is not None else []
                test, end = reduce(lambda a, b: a & b, tests), float("inf") if high is None else high
                free = next((n for n, (last, _) in enumerate(lanes) if low is not None and last <= low), None)
                if free is None:
                    lanes.append((end, F.when(test, F.lit(i))))
                else:
                    lanes[free] = (max(end, lanes[free][0]), lanes[free][1].when(test, F.lit(i)))
            return [column for _, column in lanes]
        raise AggregationError(f"unknown aggregation: {agg!r}")

    def keyed(self, rows: DataFrame) -> DataFrame:
        """Rows with this level's key; rows without a value belong to no bucket."""
        lanes = self.lanes()
        if len(lanes) > 1:
            return rows.withColumn(self.key, F.explode(F.array_compact(F.array(*lanes))))
        return rows.withColumn(self.key, lanes[0]).filter(F.col(self.key).isNotNull())

    def counted(self, keyed: DataFrame) -> DataFrame:
        columns = [c for n, m in self.metrics.items() for c in metric_columns(self.mapping, n, m)]
        return keyed.groupBy(*self.outer, self.key).agg(F.count(F.lit(1)).alias("doc_count"), *columns)

    def order(self) -> list[Column]:
        by, direction = self.agg.order
        column = F.col({"_count": "doc_count", "_key": self.key}.get(by, by))
        return [column.desc() if direction == "desc" else column.asc(), F.col(self.key).asc()]

    def chosen(self, counted: DataFrame) -> DataFrame:
        """The buckets of a terms level that are reported, at most ``size`` per parent."""
        if not isinstance(self.agg, Terms):
            return counted
        everything = counted
        if self.agg.min_doc_count > 1:
            counted = counted.filter(F.col("doc_count") >= self.agg.min_doc_count)
        if not self.outer:
            others = everything.agg(F.coalesce(F.sum("doc_count"), F.lit(0))).scalar()
            top = counted.orderBy(*self.order()).limit(self.agg.size)
            return self._with_others(top, others)
        per_parent = Window.partitionBy(*self.outer)
        top = counted.withColumn("_rank", F.row_number().over(per_parent.orderBy(*self.order())))
        return top.filter(F.col("_rank") <= self.agg.size).drop("_rank")

    def _with_others(self, top: DataFrame, total: Column) -> DataFrame:
        shown = Window.partitionBy()  # over the reported buckets only: at most ``size`` rows
        return top.withColumn("sum_other_doc_count", total - F.sum("doc_count").over(shown))

    def filled(self, buckets: DataFrame) -> DataFrame:
        """Empty buckets where the request wants them."""
        agg = self.agg
        if isinstance(agg, Ranges):
            return self._all_ranges(buckets)
        if not isinstance(agg, (Histogram, DateHistogram)):
            return buckets
        if agg.min_doc_count > 0:
            return buckets.filter(F.col("doc_count") >= agg.min_doc_count)
        # Whole buckets are compared, so both uses below have one plan and Spark computes it once.
        whole = F.struct(self.key, *[c for c in buckets.columns if c != self.key])
        low, high = F.min(whole)[self.key], F.max(whole)[self.key]
        if agg.extended_bounds is not None:
            date = isinstance(agg, DateHistogram)
            step, shift = (_interval_ms(agg.interval), _offset_ms(agg.offset)) if date else (agg.interval, agg.offset)
            first, last = [int((b - shift) // step) for b in agg.extended_bounds]
            low, high = F.least(low, F.lit(first)), F.greatest(high, F.lit(last))
        ends = buckets.groupBy(*self.outer).agg(low.alias("_low"), high.alias("_high"))
        runs = ends.filter(F.col("_low").isNotNull()).select(
            *self.outer, "_high", F.explode(F.sequence("_low", "_high", F.lit(GRID_RUN).cast("long"))).alias("_run")
        )
        run = F.sequence("_run", F.least("_high", F.col("_run") + (GRID_RUN - 1)))
        grid = runs.select(*self.outer, F.explode(run).alias(self.key))
        return self._zeroed(grid.join(buckets, [*self.outer, self.key], "left"))

    def _all_ranges(self, buckets: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(len(self.agg.ranges) - 1))).alias(self.key)
        parents = buckets.select(*self.outer).distinct() if self.outer else buckets.sparkSession.range(1)
        grid = parents.select(*self.outer, every)
        return self._zeroed(grid.join(buckets, [*self.outer, self.key], "left"))

    def _zeroed(self, rows: DataFrame) -> DataFrame:
        return _zeroed(rows, self.metrics).withColumn("doc_count", F.coalesce("doc_count", F.lit(0)))

    def labelled(self, buckets: DataFrame, shown_as: str) -> DataFrame:
        """Bucket numbers to the keys a reader expects, under their final name."""
        agg, number = self.agg, F.col(self.key)
        columns = {shown_as: number}
        if isinstance(agg, Histogram):
            columns = {shown_as: number * F.lit(float(agg.interval)) + F.lit(float(agg.offset))}
        elif isinstance(agg, DateHistogram):
            millis = number * _interval_ms(agg.interval) + _offset_ms(agg.offset)
            text = F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss'Z'")
            columns = {shown_as: millis, f"{shown_as}_as_string": text}
        elif isinstance(agg, Ranges):
            names = [key or f"{_number(low)}-{_number(high)}" for low, high, key in agg.ranges]
            columns = {shown_as: F.get(F.array(*[F.lit(n) for n in names]), number)}
        rest = [F.col(f"`{c}`") for c in buckets.columns if c != self.key]
        return buckets.select(*[c.alias(n) for n, c in columns.items()], *rest)


class Results(dict[str, DataFrame]):
    """The DataFrames by name. What several of them read, a queried scope or counts, is kept until ``release``."""

    def __init__(self) -> None:
        super().__init__()
        self.shared: list[DataFrame] = []

    @property
    def kept(self) -> DataFrame | None:
        return self.shared[0] if self.shared else None

    def keep(self, frame: DataFrame) -> DataFrame:
        self.shared.append(frame.persist(StorageLevel.MEMORY_AND_DISK))
        return frame

    def release(self) -> None:
        for frame in self.shared:
            frame.unpersist()

    def __enter__(self) -> Results:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def _counted_together(
    mapping: Mapping, levels: list[_Level], metrics: dict[str, Metric], rows: DataFrame, results: Results
) -> tuple[list[DataFrame], DataFrame | None]:
    """The counts of levels that stand beside each other, and a row of the metrics beside them, by one scan.

    A row becomes one row for each of its buckets, with the number of the lane and the key in a column of that lane's
    type. Every metric sees the rows of its own lanes only."""
    outer = levels[0].outer
    lanes, own = [], []
    for level in levels:
        found = level.lanes()
        own.append(range(len(lanes), len(lanes) + len(found)))
        lanes += found
    kinds = [f.dataType for f in rows.select(*[c.alias(f"_k{j}") for j, c in enumerate(lanes)]).schema]
    whole = len(lanes)  # the lane of all rows, for metrics in no bucket
    entries = [
        F.struct(F.lit(i).alias("_lane"), *[(c if i == j else F.lit(None).cast(kinds[j])).alias(f"_k{j}") for j, c in enumerate(lanes)])
        for i in range(whole + bool(metrics))
    ]
    fields = _fields_of({**{str(i): x.agg for i, x in enumerate(levels)}, **metrics})
    read = [f"`{f.name}`" for f in mapping.doc_fields if f.name in fields]
    keys = [f"_k{j}" for j in range(whole)]
    spread = rows.select(*outer, *read, F.inline(F.array(*entries)))
    spread = spread.filter(reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys], F.col("_lane") == whole))
    columns, names = [], []  # every metric column under a number, and who reads which under what name
    for i, (asked, at) in enumerate([*zip((x.metrics for x in levels), own), (metrics, [whole])]):
        names.append({})
        for n, m in asked.items():
            parts = metric_columns(mapping, n, m, F.col("_lane").isin(list(at)))
            for c, part in zip(parts, metric_names(n, m), strict=True):
                names[i][f"_m{len(columns)}"] = part
                columns.append(c.alias(f"_m{len(columns)}"))
    counts = results.keep(spread.groupBy(*outer, "_lane", *keys).agg(F.count(F.lit(1)).alias("doc_count"), *columns))
    found = []
    for level, at, measured in zip(levels, own, names):
        key = F.coalesce(*[F.col(f"_k{j}") for j in at]).alias(level.key)
        part = counts.filter(F.col("_lane").isin(list(at)))
        found.append(part.select(*outer, key, "doc_count", *[F.col(c).alias(n) for c, n in measured.items()]))
    if not metrics:
        return found, None
    # An empty scope still has its row of metrics.
    empty = rows.sparkSession.range(1).select(F.lit(whole).alias("_lane"))
    part = counts.filter(F.col("_lane") == whole).select("_lane", *[F.col(c).alias(n) for c, n in names[-1].items()])
    return found, _zeroed(empty.join(part, "_lane", "left").drop("_lane"), metrics)


def _run_buckets(
    mapping: Mapping, path: str, aggs: Dict[str, Bucket], rows: DataFrame, parents: list[_Level], results: Results,
    metrics: Dict[str, Metric] = {},
) -> None:
    """Bucket aggregations that stand beside each other, and the metrics beside them at the top, then what is in them."""
    levels = [_Level(mapping, n, x, parents) for n, x in aggs.items()]
    if len(levels) + bool(metrics) > 1:
        counted, row = _counted_together(mapping, levels, dict(metrics), rows, results)
        if row is not None:
            results["metrics"] = row
    else:
        counted = [x.counted(x.keyed(rows)) for x in levels]
    for level, counts in zip(levels, counted):
        agg, own = level.agg, f"{path}{level.name}"
        reported = level.chosen(counts)
        shown = level.labelled(level.filled(reported), "key")
        for parent in reversed(parents):
            shown = parent.labelled(shown, parent.name)
        results[own] = shown
        inner = {n: x for n, x in agg.aggs.items() if not isinstance(x, Metric)}
        if not inner:
            continue
        inside = level.keyed(rows)
        if isinstance(agg, Terms):
            # Only reported buckets are looked into; a top level reports at most ``size`` of them.
            keep = reported.select(*level.outer, level.key)
            if not parents and agg.size <= BROADCAST_BUCKETS:
                keep = F.broadcast(keep)
            inside = inside.join(keep, [*level.outer, level.key], "left_semi")
        for n, x in inner.items():
            if isinstance(x, TopHits):
                results[f"{own}>{n}"] = _top_hits(mapping, x, inside, [*parents, level])
        deeper = {n: x for n, x in inner.items() if isinstance(x, Bucket)}
        if deeper:
            _run_buckets(mapping, f"{own}>", deeper, inside, [*parents, level], results)


def _top_hits(mapping: Mapping, agg: TopHits, rows: DataFrame, parents: list[_Level]) -> DataFrame:
    """``row_number`` up to a constant: Spark keeps ``size`` rows per bucket and task before it shuffles."""
    keys = [p.key for p in parents]
    by = [_check(mapping, name) for name, _ in agg.keys]
    by = [c.desc_nulls_last() if way == "desc" else c.asc_nulls_last() for c, (_, way) in zip(by, agg.keys)]
    sorts = [name for name, _ in agg.keys]
    shown = [n for n in agg.show if n not in (mapping.key, *sorts)]
    columns = [*keys, mapping.key, *[f"`{n}`" for n in (*sorts, *shown)]]
    if not parents:
        # At most ``size`` rows meet in one task to be numbered.
        first = rows.orderBy(*by, mapping.key).limit(agg.size)
        return first.select(*columns, F.row_number().over(Window.orderBy(*by, mapping.key)).alias("position"))
    order = Window.partitionBy(*keys).orderBy(*by, mapping.key)
    best = rows.select(*columns, F.row_number().over(order).alias("position"))
    best = best.filter(F.col("position") <= agg.size)
    for parent in reversed(parents):
        best = parent.labelled(best, parent.name)
    return best


def _fields_of(aggs: Aggs) -> set[str]:
    found = set()
    for agg in aggs.values():
        if isinstance(agg, TopHits):
            found |= {*(n for n, _ in agg.keys), *agg.show}
        else:
            found |= {agg.field} | (_fields_of(agg.aggs) if isinstance(agg, Bucket) else set())
    return found


def aggregate(
    index: Index, aggs: Aggs, query: str | Query | list | None = None, fields: tuple[str, ...] = ()
) -> Results:
    """Run several named aggregations over one scope."""
    rows = scope(index, query, fields)
    results = Results()
    together = any(isinstance(x, (Metric, Bucket)) for x in aggs.values())
    passes = together + sum(isinstance(x, TopHits) for x in aggs.values()) + _deeper_passes(aggs)
    if query is not None and passes > 1:
        # Several passes follow: keep the columns they read rather than match again for each, until ``release``.
        known = [n for n in _fields_of(aggs) if index.mapping.has(n)]
        needed = [f.name for f in index.mapping.doc_fields if f.name in known]
        rows = results.keep(rows.select(index.mapping.key, *[f"`{n}`" for n in needed]))
    return _run(rows, index.mapping, aggs, results)


def _deeper_passes(aggs: Aggs) -> int:
    inside = [x.aggs for x in aggs.values() if isinstance(x, Bucket)]
    return sum(any(not isinstance(y, Metric) for y in x.values()) + _deeper_passes(x) for x in inside)


def aggregate_rows(rows: DataFrame, mapping: Mapping, aggs: Aggs) -> Results:
    """Run named aggregations over documents already chosen."""
    return _run(rows, mapping, aggs, Results())


def _run(rows: DataFrame, mapping: Mapping, aggs: Aggs, results: Results) -> Results:
    metrics = {n: x for n, x in aggs.items() if isinstance(x, Metric)}
    buckets = {n: x for n, x in aggs.items() if isinstance(x, Bucket)}
    if buckets:
        _run_buckets(mapping, "", buckets, rows, [], results, metrics)
    elif metrics:
        results["metrics"] = rows.agg(*[c for n, m in metrics.items() for c in metric_columns(mapping, n, m)])
    for name, agg in aggs.items():
        if isinstance(agg, TopHits):
            results[name] = _top_hits(mapping, agg, rows, [])
    return results


def facet_counts(index: Index, field: str, query: str | Query | list | None = None) -> DataFrame:
    """Documents at or below every facet path."""
    rows = scope(index, query).select(F.explode(facet_ancestors(F.col(f"`{field}`"))).alias("path"))
    return rows.groupBy("path").agg(F.count(F.lit(1)).alias("doc_count"))
