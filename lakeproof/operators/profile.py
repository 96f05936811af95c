"""One-pass column profiles in long form: (side, table_name, column_name, metric, value).

Everything asked of a table is computed in one aggregation over one scan; the
only shuffle carries one row per task. Where a table is too wide for that, cells
are stacked and added up by column, still in one scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

from lakeproof.functions import text
from lakeproof.functions.digest import digest, digest_parts, value_hash
from lakeproof.functions.sqltext import literal, name
from lakeproof.session import local_frame
from lakeproof.sources import specs
from lakeproof.sources.specs import TableSpec

COLUMNS_AT_ONCE = 100
ROWS = "rows"
REFUSED = "refused"
VALUE = T.DecimalType(38, 4)


class Metric(NamedTuple):
    """A measurement of one column, by its kind.

    ``count`` of rows where ``value`` holds, exact ``sum`` of a number, what a
    sum has ``below`` its four decimals, or ``digest`` of a column of hashes.
    ``of`` is the number's decimal type and ``scale`` that of its column.
    """

    column: str
    name: str
    kind: str
    value: str
    of: T.DecimalType | None = None
    scale: int = 0

    @property
    def parts(self) -> tuple[str, ...]:
        """SQL aggregates that measure it: one, or the three of a digest."""
        if self.kind == "count":
            return (f"count_if({self.value})",)
        if self.kind == "digest":
            return digest_parts(self.value)
        total = f"sum({self.value})"
        return (exact(total) if self.kind == "sum" else below(total, self.scale),)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """One union of many frames, put together pairwise so that no plan is analysed over and over."""
    left = list(frames)
    while len(left) > 1:
        pairs = [left[i : i + 2] for i in range(0, len(left), 2)]
        left = [p[0].unionAll(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return left[0]


_VALUE = VALUE.simpleString()


def _cell(i: int, m: Metric) -> str:
    single = f"CAST(m{i}_0 AS {_VALUE})" if len(m.parts) == 1 else f"CAST(NULL AS {_VALUE})"
    sums = [f"m{i}_{j}" if len(m.parts) == 3 else "CAST(NULL AS BIGINT)" for j in range(3)]
    return (
        f"named_struct('column_name', {literal(m.column)}, 'metric', {literal(m.name)}, 'single', {single}, "
        f"'low', {sums[0]}, 'middle', {sums[1]}, 'high', {sums[2]})"
    )


def _one_pass(df: DataFrame, side: str, table: str, metrics: list[Metric]) -> DataFrame:
    wide = df.selectExpr(*[f"{p} AS m{i}_{j}" for i, m in enumerate(metrics) for j, p in enumerate(m.parts)])
    laid_out = wide.selectExpr(f"inline(array({', '.join(_cell(i, m) for i, m in enumerate(metrics))}))")
    # The digest is put together after the rows are laid out, by one expression.
    return laid_out.selectExpr(
        f"{literal(side)} AS side",
        f"{literal(table)} AS table_name",
        "column_name",
        "metric",
        f"if(metric = 'digest', CAST({digest('low', 'middle', 'high')} AS {_VALUE}), single) AS value",
    )


def _stacked(df: DataFrame, side: str, table: str, metrics: list[Metric]) -> DataFrame:
    """One scan for any width: what a row adds to each measurement is a row of its own, added up by number.

    Only additions leave a row, about one a cell, and every task adds them up
    before the exchange, which carries one row per measurement and task.
    """
    kinds = list(dict.fromkeys((m.of.simpleString(), m.scale) for m in metrics if m.of))

    def addition(i: int, m: Metric) -> str:
        hashed = m.value if m.kind == "digest" else "CAST(NULL AS BIGINT)"
        numbers = ", ".join(
            f"'d{j}', CAST({m.value if m.of and (m.of.simpleString(), m.scale) == (of, scale) else 'NULL'} AS {of})"
            for j, (of, scale) in enumerate(kinds)
        )
        there = m.value if m.kind == "count" else f"({m.value}) IS NOT NULL"
        return f"if({there}, named_struct('i', {i}, 'h', {hashed}{', ' if kinds else ''}{numbers}), NULL)"

    added = f"inline(filter(array({', '.join(addition(i, m) for i, m in enumerate(metrics))}), x -> x IS NOT NULL))"
    low, middle, high = digest_parts("h")
    sums = [F.expr(f"sum(d{j})").alias(f"s{j}") for j in range(len(kinds))]
    summed = df.selectExpr(added).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.expr(low).alias("low"), F.expr(middle).alias("middle"), F.expr(high).alias("high"), *sums
    )
    names = local_frame(
        df.sparkSession, [(i, m.column, m.name, m.kind) for i, m in enumerate(metrics)], "i int, column_name string, metric string, kind string"
    )
    total = ", ".join([f"CAST(s{j} AS {_VALUE})" for j in range(len(kinds))] + [f"CAST(0 AS {_VALUE})"])
    rest = ", ".join(
        [f"if(s{j} IS NULL, NULL, CAST({below(f's{j}', scale)} AS {_VALUE}))" for j, (_, scale) in enumerate(kinds) if scale > VALUE.scale]
        + [f"CAST(0 AS {_VALUE})"]
    )
    return names.join(summed, "i", "left").selectExpr(
        f"{literal(side)} AS side",
        f"{literal(table)} AS table_name",
        "column_name",
        "metric",
        f"CASE kind WHEN 'count' THEN CAST(coalesce(n, 0) AS {_VALUE}) WHEN 'digest' THEN CAST({digest('low', 'middle', 'high')} AS {_VALUE}) "
        f"WHEN 'sum' THEN coalesce({total}) ELSE coalesce({rest}) END AS value",
    )


def long_profile(df: DataFrame, side: str, table: str, metrics: list[Metric]) -> DataFrame:
    """Evaluate the metrics in one scan; the row count is always part of the answer.

    One aggregation holds the sums of up to ``COLUMNS_AT_ONCE`` columns side by
    side; beyond that, generated code grows too large and they are stacked.
    """
    wanted = [Metric("*", ROWS, "count", "true"), *metrics]
    at_once = len({m.column for m in metrics}) <= COLUMNS_AT_ONCE
    return (_one_pass if at_once else _stacked)(df, side, table, wanted)


def is_text(of: T.DataType) -> bool:
    return isinstance(of, T.StringType)


def exact(total: str) -> str:
    """An exact sum, 0 when there is nothing to add."""
    return f"CAST(coalesce({total}, 0) AS {_VALUE})"


def below(total: str, scale: int) -> str:
    """What a sum has below its four decimals, in units of the column's last digit.

    Units end at the eighteenth digit, where a product still fits a decimal.
    """
    k = min(scale, 18)
    return f"CAST(coalesce({total}, 0) % 0.0001BD AS DECIMAL({k + 1},{k})) * {10**k}BD"


def _count(column: str, metric: str, condition: str) -> Metric:
    return Metric(column, metric, "count", condition)


def null_metrics(fields: Iterable[T.StructField]) -> list[Metric]:
    return [_count(f.name, "nulls", f"{name(f.name)} IS NULL") for f in fields]


def text_metrics(fields: Iterable[T.StructField]) -> list[Metric]:
    """Empty strings, values holding a NUL byte, values that are one NUL byte."""
    out: list[Metric] = []
    for f in fields:
        if is_text(f.dataType):
            c = name(f.name)
            out += [
                _count(f.name, "empties", f"{c} = ''"),
                _count(f.name, "nul_bytes", f"contains({c}, char(0))"),
                _count(f.name, "nul_only", f"{c} = char(0)"),
            ]
    return out


def token_metrics(fields: Iterable[T.StructField]) -> list[Metric]:
    return [
        _count(f.name, f"token:{token}", f"{name(f.name)} = {literal(token)}")
        for f in fields
        if is_text(f.dataType)
        for token in text.WATCHED_TOKENS
    ]


def _sums(column: str, value: str, of: T.DecimalType, scale: int) -> list[Metric]:
    """The sum, and what is left below its four decimals where the column has more."""
    kinds = [("sum", "sum")] + ([("sum_below", "below")] if scale > VALUE.scale else [])
    return [Metric(column, metric, kind, value, of, scale) for metric, kind in kinds]


def sum_metrics(fields: Iterable[T.StructField]) -> list[Metric]:
    return [m for f in fields if isinstance(f.dataType, T.DecimalType) for m in _sums(f.name, name(f.name), f.dataType, f.dataType.scale)]


def _hash_name(column: str) -> str:
    return f"_hash_{column}"


def with_hashes(df: DataFrame, portable: bool = False) -> DataFrame:
    """``df`` with one hash per column beside it, so each value is hashed once."""
    hashes = {_hash_name(f.name): value_hash(name(f.name), f.dataType, portable) for f in df.schema.fields}
    return df.selectExpr("*", *specs.projection(hashes))


def digest_metrics(columns: Iterable[str]) -> list[Metric]:
    """Digests over the columns ``with_hashes`` adds."""
    return [Metric(c, "digest", "digest", name(_hash_name(c))) for c in columns]


def column_profile(df: DataFrame, side: str, table: str) -> DataFrame:
    """Nulls of every column, empties and NUL counts of the text columns."""
    fields = df.schema.fields
    return long_profile(df, side, table, null_metrics(fields) + text_metrics(fields))


def token_census(df: DataFrame, side: str, table: str) -> DataFrame:
    """Exact counts of the watched literals, per text column; only those present."""
    counts = long_profile(df, side, table, token_metrics(df.schema.fields))
    return counts.where("startswith(metric, 'token:') AND value > 0").selectExpr(
        "side",
        "table_name",
        "column_name",
        "substring_index(metric, ':', -1) AS token",
        "CAST(value AS BIGINT) AS n",
    )


def decimal_sums(df: DataFrame, side: str, table: str) -> DataFrame:
    sums = long_profile(df, side, table, sum_metrics(df.schema.fields))
    return sums.where("metric = 'sum'")


def column_digests(df: DataFrame, side: str, table: str, portable: bool = False) -> DataFrame:
    """Nulls and digest of every column; NULLs are counted, never hashed."""
    metrics = null_metrics(df.schema.fields) + digest_metrics(df.columns)
    return long_profile(with_hashes(df, portable), side, table, metrics)


def lake_profile(df: DataFrame, table: str, side: str = "lake") -> DataFrame:
    """Everything the checks ask of a stored table, in one scan."""
    fields = df.schema.fields
    metrics = null_metrics(fields) + text_metrics(fields) + token_metrics(fields) + sum_metrics(fields)
    return long_profile(with_hashes(df), side, table, metrics + digest_metrics(df.columns))


def source_profile(fields: DataFrame, spec: TableSpec, side: str = "source") -> DataFrame:
    """Everything the checks ask of an extract, in one parse of its text.

    Counts come from the fields' text, where NULL is an empty field and nothing
    else. Sums and digests come from the same row's values under the pinned
    types; a field that is refused there is counted, and the rest go on.
    """
    written = {c.name: f"_text_{c.name}" for c in spec.kept}
    both = fields.selectExpr(
        *specs.projection({c.name: specs.tried(c, name(c.name)) for c in spec.kept}),
        *specs.projection({written[c.name]: name(c.name) for c in spec.kept}),
    )
    hashes = {_hash_name(c.name): value_hash(name(c.name), c.stored) for c in spec.kept}
    hashed = both.selectExpr("*", *specs.projection(hashes))
    metrics: list[Metric] = []
    for c in spec.kept:
        as_written = name(written[c.name])
        metrics.append(_count(c.name, "empties", f"{as_written} IS NULL"))
        if is_text(c.stored):
            # In any other column a NUL byte is no value and fails the cast.
            metrics.append(_count(c.name, "nul_only", f"{as_written} = char(0)"))
            metrics += [_count(c.name, f"token:{t}", f"{as_written} = {literal(t)}") for t in text.WATCHED_TOKENS]
        else:
            metrics.append(_count(c.name, REFUSED, f"{as_written} IS NOT NULL AND {name(c.name)} IS NULL"))
        if isinstance(c.stored, T.DecimalType):
            # The written number itself, wider than its stored form.
            scale = min(38 - (c.stored.precision - c.stored.scale), c.stored.scale + 4)
            metrics += _sums(c.name, f"try_cast({as_written} AS DECIMAL(38,{scale}))", T.DecimalType(38, scale), c.stored.scale)
    return long_profile(hashed, side, spec.table, metrics + digest_metrics(c.name for c in spec.kept))


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows): all tables in one aggregation, reading no column."""
    tagged = union_all(df.select(F.lit(t).alias("table_name")) for t, df in frames.items())
    counted = tagged.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))
    spark = next(iter(frames.values())).sparkSession
    names = local_frame(spark, [(t,) for t in frames], "table_name string")
    # An empty table has no group; it is listed all the same.
    return names.join(counted, "table_name", "left").select(
        "table_name", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")
    )


def grouped_totals(df: DataFrame, key: str, amount: str, n: str = "n", total: str = "total") -> DataFrame:
    """Count and exact sum per group, in group order."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(n), F.expr(exact(f"sum({amount})")).alias(total)).orderBy(key)
