"""Delimited text: raw, pinned and inferred scans, conversion, ragged rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeproof.functions import text
from lakeproof.functions.sqltext import name as quoted
from lakeproof.sources import multiline, specs
from lakeproof.sources.specs import TableSpec
from lakeproof.session import local_frame

_BAD = "_ragged"
EXTRACT_ROWS = 500_000

# Doubled quotes inside quotes; blanks are data; empty fields come back as NULL.
_DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def header(spark: SparkSession, path: str, spec: TableSpec) -> list[str]:
    """The column names a file begins with."""
    return spark.read.options(**_DIALECT, multiLine=spec.multi_line, inferSchema=False).csv(path).columns


def by_name(spec: TableSpec, names: list[str]) -> T.StructType:
    """The text schema in the file's own order; missing, unknown and repeated names are refused."""
    known = {f.name: f for f in spec.text_schema.fields}
    missing, unknown = sorted(set(known) - set(names)), sorted(set(names) - set(known))
    if missing or unknown or len(names) != len(set(names)):
        raise ValueError(f"{spec.table}: columns missing {missing}, unknown {unknown}, header {names}")
    return T.StructType([known[n] for n in names])


def fields(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The kept columns as text under their lake names; an empty field is NULL.

    Columns are found by the names in the header. A row with fewer or more
    fields than the header raises, whatever columns are asked for; so does a
    further file whose header differs from the first one's.
    """
    schema = by_name(spec, header(spark, path, spec)).add(_BAD, "string")
    first = quoted(schema.fields[0].name)
    whole = f"if({_BAD} IS NULL, true, raise_error(concat('{spec.table}: not as many fields as the header: ', {_BAD}, coalesce(left({first}, 0), ''))))"
    raw = _broken_lines(spark, path, schema) if spec.multi_line else _single_lines(spark, path, schema)
    return raw.where(whole).selectExpr(*specs.projection({c.name: quoted(c.source_name) for c in spec.kept}))


def _single_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    options = {"columnNameOfCorruptRecord": _BAD, "columnPruning": "false", "enforceSchema": "false"}
    return spark.read.options(**_DIALECT, **options).schema(schema).csv(path)


def _broken_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same where text may hold line breaks: records are put together by all tasks, then parsed one by one."""
    options = {**_DIALECT, "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    named = [f.name for f in schema.fields if f.name != _BAD]
    parsed = multiline.records(spark, path).select(F.from_csv("record", schema.simpleString(), options).alias("f"), "first")
    listed = F.array(*[F.col("f").getField(n) for n in named])
    same = listed.eqNullSafe(F.array(*[F.lit(n) for n in named])) & F.col("f").getField(_BAD).isNull()
    refused = F.raise_error(F.concat(F.lit("a file's header differs from "), F.lit(",".join(named))))
    return parsed.where(F.when(~F.col("first"), F.lit(True)).when(same, F.lit(False)).otherwise(refused.cast("boolean"))).select("f.*")


def text_columns(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The same as written: nothing is NULL, an empty field is ''."""
    return fields(spark, path, spec).na.fill("")


def pin(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Fields to the stored types, NOT NULL enforced; both '' and NULL are empty."""
    empties = raw.selectExpr(*specs.projection({c.name: text.empty_to_null(quoted(c.name)) for c in spec.kept}))
    return empties.selectExpr(
        *specs.projection({c.name: specs.guarded(spec, c, specs.typed(spec, c, quoted(c.name))) for c in spec.kept})
    )


def pinned_scan(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    return pin(fields(spark, path, spec), spec)


# What a cell can be read as, and the types that hold all cells of such kinds; the first that does is the column's.
# A kind is one bit, so the kinds of a column are the bits of its cells put together, in any order and in parts.
_WHOLE = "rlike({x}, '^[+-]?[0-9]+$')"
_DAY = "[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}"
_KINDS = [
    ("int", f"{_WHOLE} AND try_cast({{x}} AS INT) IS NOT NULL"),
    ("bigint", f"{_WHOLE} AND try_cast({{x}} AS BIGINT) IS NOT NULL"),
    ("decimal(38,0)", f"{_WHOLE} AND try_cast({{x}} AS DECIMAL(38,0)) IS NOT NULL"),
    ("double", "try_cast({x} AS DOUBLE) IS NOT NULL"),
    ("date", f"rlike({{x}}, '^{_DAY}$') AND try_cast({{x}} AS DATE) IS NOT NULL"),
    ("timestamp", f"rlike({{x}}, '^{_DAY}[T ][0-9:.]+(Z|[+-][0-9:]+)?$') AND try_cast({{x}} AS TIMESTAMP) IS NOT NULL"),
    ("boolean", "lower({x}) IN ('true', 'false')"),
]
_CHAINS = [["int", "bigint", "decimal(38,0)", "double"], ["date", "timestamp"], ["boolean"]]


def _kind(cell: str) -> str:
    listed = " ".join(f"WHEN {test.format(x=cell)} THEN {1 << k}" for k, (_, test) in enumerate(_KINDS))
    return f"CASE WHEN {cell} <> '' THEN CASE {listed} ELSE {1 << len(_KINDS)} END END"


def _joined(kinds: str) -> str:
    """The least type of a chain that holds every kind met; text where the chains mix or nothing was met."""
    bit = {kind: 1 << k for k, (kind, _) in enumerate(_KINDS)}
    listed = []
    for chain in _CHAINS:
        for k, kind in enumerate(chain):
            listed.append(f"WHEN {kinds} & ~{sum(bit[x] for x in chain[: k + 1])} = 0 THEN '{kind}'")
    return f"CASE WHEN {kinds} IS NULL THEN 'string' {' '.join(listed)} ELSE 'string' END"


def inferred_types(raw: DataFrame) -> DataFrame:
    """(column_name, inferred, cells) for every column of a frame of text: the guessed type, and how many cells are not empty.

    One scan and one aggregation, of two numbers a column; empty cells and NULL
    tell nothing, and a column without any other cell is text. An empty table
    has text columns only.
    """
    stats = [x for c in raw.columns for x in (f"bit_or({_kind(quoted(c))})", f"count_if({quoted(c)} <> '')")]
    held = [f"struct({kinds} AS kinds, {cells} AS cells) AS {quoted(c)}" for c, kinds, cells in zip(raw.columns, stats[::2], stats[1::2], strict=True)]
    rows = raw.selectExpr(*held).unpivot([], raw.columns, "column_name", "found")
    return rows.selectExpr("column_name", f"{_joined('found.kinds')} AS inferred", "found.cells AS cells")


def inferred_scan(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The kept columns under guessed types; only good for showing drift. Reads the file once to guess."""
    raw = fields(spark, path, spec)
    types = {r.column_name: r.inferred for r in inferred_types(raw).collect()}  # a row per column
    return raw.selectExpr(*specs.projection({c: f"CAST(nullif({quoted(c)}, '') AS {types[c]})" for c in raw.columns}))


def schema_drift(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """(column_name, inferred, cells, pinned): columns whose guessed type differs from the pinned one."""
    pinned = local_frame(spark, [(c.name, c.stored.simpleString()) for c in spec.kept], "column_name string, pinned string")
    found = inferred_types(fields(spark, path, spec)).join(F.broadcast(pinned), "column_name")
    return found.where("inferred <> pinned")


def as_text(column: specs.PinnedColumn) -> str:
    """How the extract spells a value: bits as 1/0, everything else as cast."""
    value = f"CAST({quoted(column.name)} AS {column.stored.simpleString()})"
    if isinstance(column.stored, T.BooleanType):
        value = f"CAST({value} AS INT)"
    return f"CAST({value} AS STRING)"


def write_extract(df: DataFrame, path: str, spec: TableSpec) -> str:
    """Write typed columns as an extract: source names, minimal quoting.

    NULL and '' both become an empty field; blanks and NUL bytes are kept. Files
    are compressed, and one of them is read by one task, so its rows are bounded;
    text with line breaks stays as it is, because its reader splits files.
    """
    cells = {c.source_name: as_text(c) if c in spec.kept else "CAST(NULL AS STRING)" for c in spec.columns}
    packed = {} if spec.multi_line else {"compression": "lz4", "maxRecordsPerFile": EXTRACT_ROWS}
    df.selectExpr(*specs.projection(cells)).write.options(**_DIALECT, emptyValue="", **packed).csv(path)
    return path


def quote_minimal(cell: Column) -> Column:
    """A CSV cell: quoted only if it holds a comma, a quote or a line break."""
    doubled = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(cell.rlike('[,"\r\n]'), doubled).otherwise(cell)


def convert_delimited(spark: SparkSession, source: str, target: str, header: list[str], sep: str = "|") -> str:
    """Unquoted delimited lines to CSV with a header in every file.

    Blank lines are dropped, invalid UTF-8 is replaced, and a line with too few
    or too many fields is kept as it is, so that the ragged-row audit can see it.
    The finished line is written as one column whose name is the header; the
    writer's own separator and quote are control characters, so it adds nothing.
    """
    lines = spark.read.text(source).where(F.col("value") != "")
    fields = F.split(F.make_valid_utf8(F.col("value")), f"[{sep}]", -1)
    line = F.array_join(F.transform(fields, quote_minimal), ",")
    out = lines.select(line.alias(",".join(header)))
    out.write.options(
        header=True,
        sep="\x01",
        quote="\x02",
        escape="\x02",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(target)
    return target


def parsed_rows(spark: SparkSession, path: str, header: list[str], multi_line: bool = False) -> DataFrame:
    """Every row of a converted file, whatever its width: the header's fields, and in ``_ragged`` a row of another width.

    Column pruning is off for this scan: with it the parser would skip fields
    and miss short and long rows. The parser refuses a query that reads
    ``_ragged`` alone.
    """
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, _BAD]])
    if multi_line:
        return _broken_lines(spark, path, schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "columnPruning": False}
    return spark.read.options(**_DIALECT, **options).schema(schema).csv(path)


def ragged_rows(spark: SparkSession, path: str, header: list[str], multi_line: bool = False) -> DataFrame:
    """(rows, ragged): counted by parsing every field, never by counting lines."""
    parsed = parsed_rows(spark, path, header, multi_line)
    # Rows are counted through the first column, because of the rule above.
    first = quoted(header[0])
    return parsed.selectExpr(f"count({first}) + count_if({first} IS NULL) AS rows", f"count_if({_BAD} IS NOT NULL) AS ragged")
