"""The checks: does the lake hold what the extract holds?

Each function returns assertion rows. Profiles are long frames computed once
per side and table; keys, edges and hierarchies read the stored tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeproof.functions import text, typing
from lakeproof.functions.sqltext import name
from lakeproof.operators import edges as rel
from lakeproof.operators import hierarchy, keys, profile
from lakeproof.operators.assertions import ASSERTION, ASSERTION_SCHEMA, all_of, assertions, plain, stated
from lakeproof.operators.keys import Edge
from lakeproof.operators.reconcile import first_per_group, reconcile
from lakeproof.session import local_frame, settle
from lakeproof.sources import specs
from lakeproof.sources.specs import PinnedColumn, TableSpec

# Registry order of the report.
NAMES = (
    "known_baseline",
    "row_counts",
    "types",
    "type_mapping",
    "nullability_flags",
    "nullability_enforced",
    "null_reconciliation",
    "source_values",
    "value_digests",
    "primary_keys",
    "foreign_key_oracle",
    "referential_integrity",
    "hierarchies",
    "decimal_exactness",
    "copies_agree",
)

KNOWN_GAPS = (
    "Two rows that swap values within one column: digests and sums compare multisets.",
    "Relationships that are real but neither declared, derivable nor curated.",
    "A nullable key that is NULL throughout passes and tests nothing; the audit names it.",
    "Whether a source NULL was an empty string: the extract spells both the same way.",
)


def _column() -> Column:
    return F.concat_ws(".", "table_name", "column_name")


def _metric(frame: DataFrame, metric: str, value: str) -> DataFrame:
    return frame.where(F.col("metric") == metric).select("table_name", "column_name", F.col("value").alias(value))


def known_baseline(lake: DataFrame, known: Mapping[str, int]) -> DataFrame:
    """Documented totals: everything else compares two sides that may drift together."""
    totals = lake.agg(
        F.sum(F.when(F.col("metric") == profile.ROWS, F.col("value"))).alias("rows"),
        F.count_if(F.col("metric") == profile.ROWS).alias("tables"),
        F.count_if(F.col("metric") == "nulls").alias("columns"),
    )
    rows = totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("subject"),
                        F.lit(str(known[n])).alias("expected"),
                        F.col(n).cast("bigint").cast("string").alias("actual"),
                    )
                    for n in ("rows", "tables", "columns")
                ]
            )
        )
    )
    return assertions(rows, "known_baseline", F.col("subject"), F.col("expected"), F.col("actual"))


def _same_metric(check: str, source: DataFrame, lake: DataFrame, *metrics: str) -> DataFrame:
    asked = F.col("metric").isin(*metrics)
    sides = reconcile(source.where(asked), lake.where(asked))
    subject = F.col("table_name") if profile.ROWS in metrics else _column()
    return assertions(sides, check, subject, plain(F.col("left_value")), plain(F.col("right_value")))


def row_counts(source: DataFrame, lake: DataFrame) -> DataFrame:
    return _same_metric("row_counts", source, lake, profile.ROWS)


def types(catalog: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored type of every kept column against the restated mapping."""
    both = catalog.join(stored, ["table_name", "column_name"], "full_outer")
    wanted = F.when(
        F.col("sql_type").isNotNull(), typing.expected_type(F.col("sql_type"), F.col("precision"), F.col("scale"))
    )
    return assertions(both, "types", _column(), wanted, F.col("stored_type"))


def golden_frame(spark: SparkSession) -> DataFrame:
    return local_frame(
        spark, list(typing.GOLDEN_TYPES), "sql_type string, precision int, scale int, stored_type string"
    )


def type_mapping(spark: SparkSession, catalog: DataFrame) -> DataFrame:
    """The restated mapping against the golden cases; no type in use without a case."""
    golden = golden_frame(spark)
    got = typing.expected_type(F.col("sql_type"), F.col("precision"), F.col("scale"))
    case = F.format_string("%s(%s,%s)", "sql_type", "precision", "scale")
    cases = assertions(golden, "type_mapping", case, F.col("stored_type"), got)
    used = catalog.select("sql_type").distinct()
    unpinned = rel.type_coverage(golden, catalog).where(F.col("finding") == "unpinned").select("sql_type", "finding")
    pinned = used.join(unpinned, "sql_type", "left")
    return cases.unionAll(
        assertions(pinned, "type_mapping", F.col("sql_type"), F.lit("pinned"), F.coalesce("finding", F.lit("pinned")))
    )


def nullability_flags(catalog: DataFrame, stored: DataFrame, lake: DataFrame) -> DataFrame:
    """Required exactly where NOT NULL is pinned, and no NULL stored there."""
    both = catalog.join(stored, ["table_name", "column_name"], "full_outer")
    flags = assertions(both, "nullability_flags", _column(), ~F.col("nullable"), F.col("required"))
    nulls = catalog.where(~F.col("nullable")).join(_metric(lake, "nulls", "n"), ["table_name", "column_name"], "left")
    return flags.unionAll(
        assertions(nulls, "nullability_flags", F.concat(_column(), F.lit(" nulls")), F.lit("0"), plain(F.col("n")))
    )


def runs_clean(df: DataFrame) -> str | None:
    """Evaluate every cell without storing it; the error class if that fails."""
    try:
        df.write.format("noop").mode("overwrite").save()
    except PySparkException as exc:
        return exc.getCondition() or type(exc).__name__
    return None


def nullability_enforced(spark: SparkSession, clean: DataFrame, dirty: Mapping[str, DataFrame], label: str = "") -> DataFrame:
    """Clean data passes and becomes non-nullable; a NULL is rejected, and by the guard.

    ``clean`` has every guarded column, ``dirty`` for each of them a frame with
    a NULL. All end in the guard. Any other error than the guard's own is a
    failure: a broken guard also raises something.
    """
    accepted = runs_clean(clean)
    rows = [(f"{label}clean data", "accepted", accepted or "accepted", accepted is None)]
    with ThreadPoolExecutor(8) as pool:
        outcomes = dict(zip(dirty, pool.map(runs_clean, dirty.values()), strict=True))
    for column, rejected in outcomes.items():
        required = not clean.schema[column].nullable
        rows.append((f"{label}{column} clean schema", "required", "required" if required else "optional", required))
        rows.append((f"{label}{column} a NULL", "USER_RAISED_EXCEPTION", rejected or "accepted", rejected == "USER_RAISED_EXCEPTION"))
    return stated(spark, "nullability_enforced", rows)


def guard_enforced(
    spark: SparkSession, frames: Mapping[str, DataFrame], of: Mapping[str, TableSpec], guard: Callable[[TableSpec, PinnedColumn, str], str] = specs.guarded
) -> DataFrame:
    """The guard on every NOT NULL column of every table: one job a table as it is, and one row of NULL for each column."""

    def one(table: str) -> DataFrame:
        df, spec = frames[table], of[table]
        required = [c for c in spec.kept if not c.nullable]
        clean = df.selectExpr(*specs.projection({c.name: guard(spec, c, specs.quoted(c.name)) for c in required}))
        dirty = {
            c.name: spark.range(0, 1, 1, 1).selectExpr(f"{guard(spec, c, f'CAST(NULL AS {c.stored.simpleString()})')} AS {specs.quoted(c.name)}")
            for c in required
        }
        return nullability_enforced(spark, clean, dirty, f"{table}: ")

    guarded = [t for t in frames if any(not c.nullable for c in of[t].kept)]
    with ThreadPoolExecutor(4) as pool:
        out = list(pool.map(one, guarded))
    return all_of(out) if out else local_frame(spark, [], ASSERTION_SCHEMA)


def null_reconciliation(source: DataFrame, lake: DataFrame, catalog: DataFrame) -> DataFrame:
    """Text columns: as many NULLs stored as there are empty fields in the extract."""
    texts = catalog.where(typing.expected_type(F.col("sql_type"), F.col("precision"), F.col("scale")) == "string")
    both = (
        texts.select("table_name", "column_name")
        .join(_metric(source, "empties", "source_empties"), ["table_name", "column_name"], "left")
        .join(_metric(lake, "nulls", "lake_nulls"), ["table_name", "column_name"], "left")
    )
    return assertions(both, "null_reconciliation", _column(), plain(F.col("source_empties")), plain(F.col("lake_nulls")))


def source_values(source: DataFrame, lake: DataFrame) -> DataFrame:
    """Null-like literals survive on either side; NUL-only fields arrive as ''."""
    is_token = F.col("metric").startswith("token:")
    tokens = reconcile(source.where(is_token), lake.where(is_token))
    left, right = F.coalesce("left_value", F.lit(0)), F.coalesce("right_value", F.lit(0))
    seen = tokens.where((left > 0) | (right > 0))
    token = F.concat(_column(), F.lit(" "), F.substring_index("metric", ":", -1))
    out = assertions(seen, "source_values", token, plain(left), plain(right))
    nul = (
        _metric(source, "nul_only", "source_nul")
        .where("source_nul > 0")
        .join(_metric(lake, "empties", "lake_empties"), ["table_name", "column_name"], "left")
    )
    out = out.unionAll(
        assertions(nul, "source_values", F.concat(_column(), F.lit(" NUL")), plain(F.col("source_nul")), plain(F.col("lake_empties")))
    )
    left_over = _metric(lake, "nul_bytes", "n").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))
    return out.unionAll(
        assertions(left_over, "source_values", F.lit("values with NUL bytes in the lake"), F.lit("0"), F.col("n"))
    )


def value_digests(
    source: DataFrame, lake: DataFrame, tables: Callable[[str], tuple[DataFrame, DataFrame]] | None = None
) -> DataFrame:
    """Digests of every column, and no field of an extract that its type refuses.

    With ``tables``, which opens a table as extracted and as stored, a column
    whose digests differ shows the first two values each side has too many of.
    Only those columns of those tables are read again.
    """
    found = _same_metric("value_digests", source, lake, "digest")
    if tables is not None:
        bad: dict[str, list[str]] = {}
        for (table, _, column) in (r.subject.partition(".") for r in found.where("NOT ok").orderBy("subject").collect()):
            bad.setdefault(table, []).append(column)
        shown = [(f"{t}.{c}", s) for t, columns in bad.items() for c, s in value_examples(*tables(t), columns).items()]
        examples = local_frame(source.sparkSession, shown, "subject string, shown string")
        found = found.join(examples, "subject", "left").withColumn("actual", F.concat("actual", F.coalesce("shown", F.lit(""))))
    return found.select(*ASSERTION).unionAll(_refused("value_digests", source))


SHOWN_CHARS = 40


def value_examples(extracted: DataFrame, stored: DataFrame, columns: Sequence[str], n: int = 2) -> dict[str, str]:
    """Per column, the first values of which the extract and the lake hold too many.

    Values are counted, the lake's negatively, so equal ones cancel before and
    after the shuffle however often they come; n of each side and column are kept.
    """

    def cells(df: DataFrame, side: int) -> DataFrame:
        each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(name(c)).cast("string").alias("value")) for c in columns])
        return df.select(F.inline(each)).withColumn("side", F.lit(side))

    columns = [c for c in columns if c in extracted.columns and c in stored.columns]
    if not columns:
        return {}
    both = cells(extracted, 1).unionAll(cells(stored, -1)).where("value IS NOT NULL")
    surplus = both.groupBy("column_name", "value").agg(F.sum("side").alias("surplus")).where("surplus <> 0")
    sided = surplus.select("column_name", "value", (F.col("surplus") > 0).alias("extracted"))
    shown: dict[tuple[str, bool], list[str]] = {}
    for r in first_per_group(sided, ["column_name", "extracted"], ["value"], n).orderBy("value").collect():
        shown.setdefault((r.column_name, r.extracted), []).append(r.value[:SHOWN_CHARS])
    out: dict[str, str] = {}
    for side, label in ((True, "only in the extract"), (False, "only in the lake")):
        for c in columns:
            if (c, side) in shown:
                out[c] = f"{out.get(c, '')}; {label}: {', '.join(shown[c, side])}"
    return out


def decimal_exactness(source: DataFrame, lake: DataFrame) -> DataFrame:
    """Sums of the money text against sums of what is stored, no tolerance."""
    summed = source.where("metric = 'sum'").select("table_name", "column_name")
    refused = _refused("decimal_exactness", source.join(summed, ["table_name", "column_name"], "left_semi"))
    return _same_metric("decimal_exactness", source, lake, "sum", "sum_below").unionAll(refused)


def _refused(check: str, source: DataFrame) -> DataFrame:
    """One failed assertion for each column with fields that do not parse."""
    bad = source.where((F.col("metric") == profile.REFUSED) & (F.col("value") > 0))
    return assertions(bad, check, F.concat(_column(), F.lit(" refused fields")), F.lit("0"), plain(F.col("value")))


def primary_keys(frames: Mapping[str, DataFrame], of: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Unique and never NULL; a key that repeats is shown with its first three values."""
    spark = next(iter(frames.values())).sparkSession
    tested = settle(keys.key_audit(frames, of))
    bad = {(r.table_name, r.key_name) for r in tested.where("surplus > 0").collect()}
    shown = [
        (table, "+".join(columns), _spelled(keys.duplicate_examples(frames[table], columns).select(*columns).collect()))
        for table, columns in of
        if (table, "+".join(columns)) in bad
    ]
    examples = local_frame(spark, shown, "table_name string, key_name string, shown string")
    tested = tested.join(examples, ["table_name", "key_name"], "left")
    subject = F.concat_ws(".", "table_name", "key_name")
    counts = F.concat(F.col("surplus").cast("string"), F.lit(" surplus, "), F.col("null_rows").cast("string"), F.lit(" NULL"))
    found = F.concat(counts, F.coalesce(F.concat(F.lit(", such as "), "shown"), F.lit("")))
    return assertions(tested, "primary_keys", subject, F.lit("0 surplus, 0 NULL"), found)


def _spelled(rows: Sequence[tuple]) -> str:
    """Example keys: their parts joined by '/', one after another."""
    return ", ".join("/".join("NULL" if v is None else str(v) for v in r) for r in rows)


def foreign_key_oracle(
    catalog: DataFrame,
    classified: DataFrame,
    declared: DataFrame | None,
    curated: DataFrame,
    known: Mapping[str, int],
) -> DataFrame:
    """Declared edges exist and number what they should; curated ones are needed.

    Without a declared set, whether the derived edges are right cannot be told:
    a curated edge that is derived as well still fails, and otherwise there is
    no assertion, which the report shows as skipped.
    """
    derived, hierarchies = rel.derived_edges(classified), rel.hierarchy_edges(classified)
    others = [derived, hierarchies] + ([declared] if declared is not None else [])
    redundant = rel.not_minimal(curated, *others).select(rel.spelled().alias("edge"), "reason")
    listed = rel.canonical(curated).select(rel.spelled().alias("edge")).distinct()
    reasons = redundant.groupBy("edge").agg(F.max("reason").alias("reason"))
    out = assertions(
        listed.join(reasons, "edge", "left"),
        "foreign_key_oracle",
        F.col("edge"),
        F.lit("curated, not known otherwise"),
        F.coalesce("reason", F.lit("curated, not known otherwise")),
    )
    if declared is None:
        return out.where("NOT ok")
    totals = rel.edge_totals(declared)
    for name in ("constraints", "composites"):
        out = out.unionAll(
            assertions(totals, "foreign_key_oracle", F.lit(name), F.lit(str(known[name])), F.col(name))
        )
    broken = (
        rel.broken_structure(declared, catalog)
        .groupBy("edge")
        .agg(F.concat_ws(", ", F.array_sort(F.collect_list(F.concat_ws(".", "table_name", "column_name")))).alias("absent"))
    )
    checkable = declared.select(rel.spelled().alias("edge")).distinct().join(broken, "edge", "left")
    return out.unionAll(
        assertions(
            checkable,
            "foreign_key_oracle",
            F.col("edge"),
            F.lit("present"),
            F.coalesce(F.concat(F.lit("absent: "), "absent"), F.lit("present")),
        )
    )


def referential_integrity(
    audit: DataFrame, classified: DataFrame, frames: Mapping[str, DataFrame] | None = None, edges: Sequence[Edge] = ()
) -> DataFrame:
    """No orphans, unique targets, and no key column that nobody can place.

    With the tables at hand, an edge with orphans shows the first three of them.
    """
    zero = F.lit("0 orphans, 0 surplus")
    bad = {r.edge for r in audit.where("orphan_keys > 0").collect()} if frames else set()
    shown = [
        (keys.spell_edge(e), _spelled([r[:-1] for r in keys.orphan_examples(frames, e).collect()]))
        for e in edges
        if keys.spell_edge(e) in bad
    ]
    audit = audit.join(local_frame(audit.sparkSession, shown, "edge string, shown string"), "edge", "left")
    counts = F.concat(
        F.col("orphan_keys").cast("string"), F.lit(" orphans, "), F.col("target_surplus").cast("string"), F.lit(" surplus")
    )
    found = F.concat(counts, F.coalesce(F.concat(F.lit(", such as "), "shown"), F.lit("")))
    edges = assertions(audit, "referential_integrity", F.col("edge"), zero, found)
    strays = classified.where(F.col("kind") == "unclassified")
    return edges.unionAll(
        assertions(strays, "referential_integrity", _column(), F.lit("classified"), F.col("kind"))
    )


def edge_notes(classified: DataFrame, declared: DataFrame) -> DataFrame:
    """(subject, note): how many edges are declared and derived, declared and a hierarchy, only declared, only derived."""
    verdicts = rel.edge_diff(declared, rel.derived_edges(classified), rel.hierarchy_edges(classified))
    counted = verdicts.groupBy(F.col("verdict").alias("subject")).agg(F.count(F.lit(1)).alias("n"))
    each = local_frame(declared.sparkSession, [(v,) for v in ("agreed", "routed", "missed", "invented")], "subject string")
    return each.join(counted, "subject", "left").select("subject", F.concat(F.coalesce("n", F.lit(0)).cast("string"), F.lit(" edges")).alias("note"))


def audit_notes(audit: DataFrame) -> DataFrame:
    """(subject, note): what stood behind the edges that hold, and the edges that prove nothing."""
    total = audit.agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"), F.count(F.lit(1)).alias("n")).select(
        F.lit("coverage").alias("subject"),
        F.concat(F.col("compared").cast("bigint").cast("string"), F.lit(" values compared over "), F.col("n").cast("string"), F.lit(" edges")).alias("note"),
    )
    return total.unionAll(vacuous_edges(audit).select(F.col("edge").alias("subject"), F.lit("nothing to compare").alias("note")))


def type_notes(spark: SparkSession, catalog: DataFrame) -> DataFrame:
    """(subject, note): pinned types that no column uses."""
    found = rel.type_coverage(golden_frame(spark), catalog).where("finding = 'unexercised'")
    return found.select(F.col("sql_type").alias("subject"), F.lit("no column of this type").alias("note"))


def vacuous_edges(audit: DataFrame) -> DataFrame:
    """Edges without a single value to compare; they are no evidence."""
    return audit.where(F.col("compared") == 0).select("edge")


def _none_of(found: DataFrame, subject: str, n: int = 3) -> DataFrame:
    """An assertion that there are no such rows; if there are, their number and the first keys."""
    count = found.count()
    first = found.select(found.columns[0]).orderBy(found.columns[0]).limit(n).collect() if count else []
    told = f"{count}, such as {_spelled(first)}" if count else "0"
    return stated(found.sparkSession, "hierarchies", [(subject, "0", told, count == 0)])


def hierarchies(frames: Mapping[str, DataFrame], edges: Sequence[Edge]) -> DataFrame:
    out = []
    for table, (parent,), _, (key,) in edges:
        df = frames[table].select(key, parent)
        for what, found in (
            ("dangling", hierarchy.dangling_parents(df, key, parent)),
            ("conflicting", hierarchy.conflicting_parents(df, key, parent)),
            ("cyclic", hierarchy.cycle_starts(df, key, parent)),
        ):
            out.append(_none_of(found, f"{table}.{parent} {what}"))
    if not out:  # nothing to check is no failure: no rows, which the report shows as skipped
        none = next(iter(frames.values())).limit(0).select(F.lit(0).alias("n"))
        return assertions(none, "hierarchies", F.lit(""), F.lit("0"), F.col("n"))
    return all_of(out)


def copies_agree(readers: Mapping[str, Callable[[], DataFrame]], expected: DataFrame) -> DataFrame:
    """Every reader that answers counts the same rows as ``expected(table_name, rows)``.

    A reader yields (table_name, rows); one that cannot be reached is a failure,
    not left out.
    """
    spark = expected.sparkSession
    out = []
    for name, read in readers.items():
        try:
            counted = read().withColumnRenamed("rows", "read")
            both = expected.join(counted, "table_name", "full_outer")
            subject = F.concat(F.lit(f"{name} "), "table_name")
            out.append(assertions(both, "copies_agree", subject, F.col("rows"), F.col("read")))
        except PySparkException as exc:
            out.append(stated(spark, "copies_agree", [(name, "an answer", exc.getCondition() or "error", False)]))
    if not out:
        return local_frame(spark, [], ASSERTION_SCHEMA)
    return all_of(out)


def aggregates_agree(baseline: DataFrame, readers: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Grouped counts and sums equal to the baseline's, compared at two decimals."""

    def as_text(df: DataFrame, name: str) -> DataFrame:
        cells = [text.comparable(F.col(c).cast("string")) for c in df.columns if c != key]
        return df.select(F.col(key).cast("string").alias("group"), F.concat_ws(" | ", *cells).alias(name))

    wanted = as_text(baseline, "wanted")
    out = []
    for name, df in readers.items():
        both = wanted.join(as_text(df, "got"), "group", "full_outer")
        out.append(
            assertions(both, "aggregates_agree", F.concat(F.lit(f"{name} "), "group"), F.col("wanted"), F.col("got"))
        )
    return all_of(out)
