"""Declarative data-quality checks, fused into as few passes as possible.

A check states what to measure as aggregate columns and reads pass, count and detail
off the measured row. All checks of a table share one aggregation; every key set adds
one grouped count. A check that cannot run is recorded as failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class HasRows:
    name: str = "has_rows"

    def measures(self) -> list[Column]:
        return [F.count("*")]

    def outcome(self, counts: list[Column]) -> tuple[Column, Column, Column]:
        return counts[0] > 0, counts[0], F.concat(counts[0].cast("string"), F.lit(" rows"))


@dataclass(frozen=True)
class NoNulls:
    name: str
    columns: tuple[str, ...]

    def measures(self) -> list[Column]:
        gaps = [F.col(c).isNull() for c in self.columns]
        return [F.count_if(reduce(lambda a, b: a | b, gaps)), *[F.count_if(g) for g in gaps]]

    def outcome(self, counts: list[Column]) -> tuple[Column, Column, Column]:
        rows, per_column = counts[0], counts[1:]
        offenders = F.concat_ws(
            ", ",
            *[F.when(n > 0, F.concat(F.lit(f"{c}="), n.cast("string"))) for c, n in zip(self.columns, per_column)],
        )
        clean = F.lit(f"complete: {', '.join(self.columns)}")
        return rows == 0, rows, F.when(rows == 0, clean).otherwise(F.concat(F.lit("missing: "), offenders))


@dataclass(frozen=True)
class CountOf:
    """No row may satisfy the SQL condition; a missing operand satisfies nothing."""

    name: str
    condition: str
    wording: str
    numeric: str | None = None
    pair: tuple[str, str] | None = None

    def measures(self) -> list[Column]:
        return [F.count_if(F.expr(self.condition))]

    def outcome(self, counts: list[Column]) -> tuple[Column, Column, Column]:
        return counts[0] == 0, counts[0], F.concat(counts[0].cast("string"), F.lit(f" {self.wording}"))


def NonNegative(name: str, column: str) -> CountOf:
    return CountOf(name, f"`{column}` < 0", f"below zero in {column}", column)


def Positive(name: str, column: str) -> CountOf:
    return CountOf(name, f"`{column}` <= 0", f"zero or below in {column}", column)


def NotEqual(name: str, left: str, right: str) -> CountOf:
    return CountOf(name, f"`{left}` = `{right}`", f"with {left} equal to {right}", pair=(left, right))


@dataclass(frozen=True)
class UniqueKey:
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Query:
    """A check of one's own as a lazy frame: ``build(df)`` gives one row (passed, bad, detail).

    Nothing runs when it is built; the row joins the plan of the other checks of the table.
    """

    name: str
    build: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Custom:
    """A check of one's own: ``run(df)`` gives (passed, detail) and may use any Spark job of its own."""

    name: str
    run: Callable[[DataFrame], tuple[bool, str]]


def duplicate_rows(df: DataFrame, keys) -> DataFrame:
    """Rows beyond the first of their key; NULL keys count as equal."""
    counts = df.groupBy(*keys).count()
    return counts.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("dupes"))


def null_counts(df: DataFrame, columns) -> DataFrame:
    """Missing values per column, one row each, from one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = [F.struct(F.lit(c).alias("field_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*pairs)))


def _outcome(name: str, passed: Column, bad: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), passed.alias("passed"),
        bad.cast("bigint").alias("bad"), detail.alias("detail"),
    )


def observable(check, schema: T.StructType) -> bool:
    """Whether a check can be measured inside a write: plain aggregates of columns that cannot fail on any value."""
    kinds = {f.name: f.dataType for f in schema}
    if isinstance(check, HasRows):
        return True
    if isinstance(check, NoNulls):
        return all(c in kinds for c in check.columns)
    if isinstance(check, CountOf) and check.numeric:
        return isinstance(kinds.get(check.numeric), T.NumericType)
    if isinstance(check, CountOf) and check.pair:
        left, right = check.pair
        return left in kinds and kinds[left] == kinds.get(right)
    return False


def _comparable(df: DataFrame, check) -> None:
    """Raise, before anything runs, for a check the columns cannot answer."""
    if isinstance(check, Query):
        return
    if isinstance(check, UniqueKey):
        df.select(*check.columns)
        return
    df.agg(*check.measures())
    if isinstance(check, CountOf) and check.numeric:
        if not isinstance(df.schema[check.numeric].dataType, T.NumericType):
            raise TypeError(f"{check.numeric} is not numeric")


def run_checks(df: DataFrame, asset_key: str, checks, run_ts: datetime, measured: dict[str, list] | None = None) -> DataFrame:
    """One result row per check: passed, number of offending rows, detail.

    Expects a stored or staged table, which it reads once for all plain checks and
    once, keys only, per key set. ``measured`` holds, by check name, measures that the write took
    already (`observed.TableFigures`); these checks read nothing. The results are computed here and now, a row for each
    check; if the common pass crashes, the checks run one by one, and those that crash
    are recorded as failed. Every check needs a name of its own.
    """
    names = [c.name for c in checks]
    if len(set(names)) < len(names):
        raise ValueError(f"{asset_key}: check names repeat: {', '.join(sorted(n for n in set(names) if names.count(n) > 1))}")
    schema = "check_name string, passed boolean, bad bigint, detail string"
    spark, custom = df.sparkSession, [c for c in checks if isinstance(c, Custom)]
    plain = [c for c in checks if not isinstance(c, Custom)]
    found = [_run_custom(df, c) for c in custom]
    try:
        found += _measured(df, plain, measured).collect() if plain else []
    except Exception:
        for check in plain:
            try:
                found += _measured(df, [check], measured).collect()
            except Exception as exc:  # a crash at run time is a failed check too
                found.append(_crashed(check.name, exc))
    order = {name: at for at, name in enumerate(names)}
    rows = sorted((tuple(r) for r in found), key=lambda r: order[r[0]])
    return spark.createDataFrame(rows, schema).select(
        F.lit(asset_key).alias("asset_key"), "check_name", "passed", "bad", "detail",
        F.lit(run_ts).cast("timestamp").alias("checked_at"),
    )


def _crashed(name: str, exc: Exception) -> tuple:
    first_line = (str(exc).splitlines() or [type(exc).__name__])[0]
    return name, False, None, f"check crashed: {first_line}"


def _run_custom(df: DataFrame, check) -> tuple:
    try:
        passed, detail = check.run(df)
        return check.name, bool(passed), None, detail
    except Exception as exc:  # any crash is a failed check, never a silent pass
        return _crashed(check.name, exc)


def _measured(df: DataFrame, checks, measured: dict[str, list] | None = None) -> DataFrame:
    """The results of checks on columns and of lazy frames, as one plan."""
    rows: list[Column] = []
    keyed: list[UniqueKey] = []
    measures: list[Column] = []
    parts: list[DataFrame] = []
    taken: list[Column] = []
    pending = []
    for check in checks:
        if measured and check.name in measured:
            taken.append(_outcome(check.name, *check.outcome([F.lit(n) for n in measured[check.name]])))
            continue
        if isinstance(check, Query):
            try:
                row = check.build(df)
                parts.append(row.select(F.inline(F.array(
                    _outcome(check.name, F.col("passed"), F.col("bad"), F.col("detail"))
                ))))
            except Exception as exc:  # a frame that cannot be analysed is a failed check too
                name, passed, bad, detail = _crashed(check.name, exc)
                taken.append(_outcome(name, F.lit(passed), F.lit(bad), F.lit(detail)))
            continue
        try:
            _comparable(df, check)
        except Exception as exc:  # any crash is a failed check, never a silent pass
            name, passed, bad, detail = _crashed(check.name, exc)
            rows.append(_outcome(name, F.lit(passed), F.lit(bad), F.lit(detail)))
            continue
        if isinstance(check, UniqueKey):
            keyed.append(check)
        else:
            wanted = check.measures()
            pending.append((check, len(measures), len(wanted)))
            measures.extend(wanted)

    totals = df.agg(F.lit(None).alias("nothing"), *[m.alias(f"m{i}") for i, m in enumerate(measures)])
    for check, start, n in pending:
        rows.append(_outcome(check.name, *check.outcome([F.col(f"m{i}") for i in range(start, start + n)])))
    if rows:
        # Without a measure to take, nothing is read.
        parts.append((totals if measures else df.sparkSession.range(1)).select(F.inline(F.array(*rows))))
    if taken:
        parts.append(df.sparkSession.range(1).select(F.inline(F.array(*taken))))
    for check in keyed:
        dupes = F.col("dupes")
        detail = F.concat(dupes.cast("string"), F.lit(f" repeated on ({', '.join(check.columns)})"))
        parts.append(
            duplicate_rows(df, check.columns).select(
                F.inline(F.array(_outcome(check.name, dupes == 0, dupes, detail)))
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def row_parity(mart: DataFrame, raw: DataFrame) -> DataFrame:
    """Whether a mart kept every raw row: two row counts, side by side."""
    mart_rows = mart.agg(F.count("*").alias("n")).scalar()
    both = raw.agg(F.count("*").alias("raw_rows")).withColumn("mart_rows", mart_rows)
    text = F.concat(
        F.col("mart_rows").cast("string"), F.lit(" of "), F.col("raw_rows").cast("string"), F.lit(" raw rows joined")
    )
    return both.select((F.col("mart_rows") == F.col("raw_rows")).alias("passed"), "raw_rows", "mart_rows", text.alias("detail"))
