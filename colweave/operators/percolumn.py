"""The same few aggregates for every column of a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.schema import batches, quoted

# Up to here all aggregates go into one row; beyond, generated code outgrows what the JVM compiles well.
NARROW_COLUMNS = 24
LONG_COLUMNS = 2000
# Sketches live as objects: beyond 128 groups a task would sort all its rows instead of hashing them.
SKETCH_COLUMNS = 120

Aggregates = Mapping[str, str]


def per_column(
    df: DataFrame,
    names: Sequence[str],
    aggregates: Aggregates | Callable[[str], Aggregates],
    value: Callable[[str], str] = quoted,
    more: Mapping[str, str] | None = None,
    per_pass: int = LONG_COLUMNS,
) -> tuple[dict[str, dict[str, Any]], dict[str, Any]]:
    """({column: {alias: aggregate}}, {alias: value of a whole-table aggregate in ``more``}).

    ``aggregates`` maps an alias to SQL text with ``{v}`` for the value, or is a
    function from the value's type to such a map. A narrow table is one global
    aggregation. A wide one is turned into (column number, value) rows inside
    each task and grouped: still one pass, with one small hash map per task and
    a shuffle of one row per column and task. ``per_pass`` bounds the columns of
    one pass; every pass reads only its own columns.
    """
    names = list(names)
    chosen = aggregates if callable(aggregates) else lambda _: aggregates
    # types are looked up only where the aggregates depend on them or rows are built
    wide = len(names) > NARROW_COLUMNS
    types = dict(zip(names, (t for _, t in df.selectExpr(*[value(n) for n in names]).dtypes), strict=True)) if names else {}
    out: dict[str, dict[str, Any]] = {n: dict.fromkeys(chosen(types[n])) for n in names}
    extras: dict[str, Any] = {}
    if more or (names and not wide):
        exprs = [f"{e} as more_{i}" for i, e in enumerate((more or {}).values())]
        for i, n in enumerate([] if wide else names):
            exprs += [f"{e.format(v=value(n))} as c{i}_{alias}" for alias, e in chosen(types[n]).items()]
        row = df.selectExpr(*exprs).first()
        extras = {alias: row[f"more_{i}"] for i, alias in enumerate(more or {})}
        for i, n in enumerate([] if wide else names):
            out[n] = {alias: row[f"c{i}_{alias}"] for alias in chosen(types[n])}
    for dtype in sorted(set(types.values())) if wide else []:
        for batch in batches([n for n in names if types[n] == dtype], per_pass):
            cells = ", ".join(f"struct({i} as c, {value(n)} as v)" for i, n in enumerate(batch))
            grouped = df.selectExpr(f"inline(array({cells}))").groupBy("c")
            found = grouped.agg(*[F.expr(e.format(v="v")).alias(alias) for alias, e in chosen(dtype).items()])
            for row in found.collect():
                out[batch[row["c"]]] = {alias: row[alias] for alias in chosen(dtype)}
    return out, extras
