"""Standardisation with population statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from colweave.operators.percolumn import per_column
from colweave.schema import literal, quoted


@dataclass(frozen=True)
class Scaler:
    """Fitted (mean, deviation) per column. A column that does not vary is divided by 1."""

    stats: Mapping[str, tuple[float | None, float | None]]
    single: bool = False

    @classmethod
    def fit(cls, df: DataFrame, names: Sequence[str], single: bool = False) -> Scaler:
        """One pass over all columns. ``single`` rounds values to single precision first."""
        found, _ = per_column(
            df, names, {"mean": "avg({v})", "deviation": "stddev_pop({v})"}, lambda n: _input(n, single)
        )
        stats = {n: (v["mean"], v["deviation"]) for n, v in found.items()}
        return cls(stats, single)

    def apply(self, df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            if c not in self.stats or self.stats[c][0] is None:
                out.append(quoted(c))
                continue
            mean, deviation = self.stats[c]
            scaled = f"({_input(c, self.single)} - {literal(mean)}) / {literal(deviation or 1.0)}"
            out.append(f"{f'cast({scaled} as float)' if self.single else scaled} as {quoted(c)}")
        return df.selectExpr(*out)

    def table(self, spark) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in self.stats.items()]
        return spark.createDataFrame(rows, "column string, mean double, deviation double")


def _input(name: str, single: bool) -> str:
    c = f"cast({quoted(name)} as double)"
    return f"cast(cast({c} as float) as double)" if single else c


def scale_each(tables: Sequence[DataFrame], names: Sequence[str]) -> list[DataFrame]:
    """Scale every table by its own statistics."""
    return [Scaler.fit(t, names).apply(t) for t in tables]
