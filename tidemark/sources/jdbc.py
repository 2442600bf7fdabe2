"""An operational table read by many tasks: ranges of a time column, planned from the source's own counts.

The source is asked for the number of rows, and the least and largest instant at or after the mark.  Ranges start
with equal lengths; then, in one query a round, the source counts the rows of all ranges, and those that hold more than
``rows`` are cut in two, until none does (or ROUNDS are over: rows of one instant can't be cut).  Each range is a task
with its own condition, so a burst of rows is spread and an empty stretch costs nothing: neighbours with few rows
are joined.  The first range is open below (down to the mark) and the last one above, so rows that
come while the plan is made are read too; without a mark, rows without instant are a range of their own.

Conditions use the driver's ``{ts '...'}`` escape, which every JDBC driver turns into its own literal.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a task, about; most ranges of a plan; times that ranges are cut in two.
ROWS, RANGES, ROUNDS = 500_000, 1_000, 20

Bounds = list[tuple[datetime, int]]
"""Where each range starts, and its rows."""


def _at(instant: datetime) -> str:
    return f"{{ts '{instant:%Y-%m-%d %H:%M:%S.%f}'}}"


def _named(column: str) -> str:
    """Quoted as in standard SQL, so that the name's case is kept."""
    return '"' + column.replace('"', '""') + '"'


def _between(column: str, start: datetime, end: datetime | None) -> str:
    return f"{column} >= {_at(start)}" + (f" AND {column} < {_at(end)}" if end else "")


def _asked(spark: SparkSession, url: str, sql: str, options: dict[str, str]) -> tuple:
    return tuple(spark.read.format("jdbc").options(url=url, query=sql, **options).load().first())


def planned(spark: SparkSession, url: str, table: str, column: str, mark: datetime | None = None, rows: int = ROWS, **options: str) -> Bounds:
    """Starts of the ranges and their numbers of rows, in order; none if no row has an instant."""
    name = _named(column)
    since = f" WHERE {name} >= {_at(mark)}" if mark else ""
    n, low, high = _asked(spark, url, f"SELECT COUNT({name}) AS n, MIN({name}) AS low, MAX({name}) AS high FROM {table}{since}", options)
    if not n:
        return []
    parts = max(1, min(RANGES, -(-n // rows)))
    starts, counts = [low + (high - low) * i / parts for i in range(parts)], [n]
    for left in reversed(range(ROUNDS + 1)):
        ends = [*starts[1:], None]
        each = ", ".join(f"SUM(CASE WHEN {_between(name, s, e)} THEN 1 ELSE 0 END) AS n{i}" for i, (s, e) in enumerate(zip(starts, ends, strict=True)))
        counts = [int(c or 0) for c in _asked(spark, url, f"SELECT {each} FROM {table}{since}", options)]
        halves = [(s, s + ((e or high) - s) / 2) for s, e, c in zip(starts, ends, counts, strict=True) if c > rows]
        fresh = sorted(m for s, m in halves if m > s and m not in starts)
        if not left or not fresh or len(starts) + len(fresh) > RANGES:
            break
        starts = sorted([*starts, *fresh])
    out: Bounds = []
    for s, c in zip(starts, counts, strict=True):
        if out and out[-1][1] + c <= rows:
            out[-1] = out[-1][0], out[-1][1] + c
        else:
            out.append((s, c))
    return out


def conditions(column: str, starts: list[datetime], mark: datetime | None) -> list[str]:
    """A condition for each range; together they take every row once."""
    column = _named(column)
    if not starts:
        return [f"{column} >= {_at(mark)}"] if mark else ["1 = 1"]
    cuts = [mark, *starts[1:]]
    out = []
    for start, end in zip(cuts, [*starts[1:], None], strict=True):
        out.append(_between(column, start, end) if start else f"{column} < {_at(end)}" if end else f"{column} IS NOT NULL")
    return out if mark else [*out, f"{column} IS NULL"]


def ranges(spark: SparkSession, url: str, table: str, column: str, mark: datetime | None = None, rows: int = ROWS, **options: str) -> DataFrame:
    """Rows at or after the mark (without one all rows), a task for each planned range; filters and columns that
    follow reach the source as well."""
    found = planned(spark, url, table, column, mark, rows, **options)
    df = spark.read.jdbc(url, table, predicates=conditions(column, [s for s, _ in found], mark), properties=dict(options))
    return df if mark is None else df.where(F.col(column) >= F.lit(mark))
