"""One-hot, frequency and dictionary encoders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.operators.order import dense_codes
from colweave.operators.profile import ColumnProfile, profile
from colweave.schema import DEFAULT_ROLES, KEY, Roles, batches, col, is_number, literal, quoted
from colweave.session import discard, settle

# Limits of the encoder variants.
ONEHOT_MOST_VALUES = 20
BUDGET_MOST_VALUES = 100
BUDGET_MOST_COLUMNS = 10**4
CAP_MOST_COLUMNS = 1000
UNSEEN = -1

# A lookup column is broadcast only below both bounds; beyond them it is joined by shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
# A value is hot if it fills more rows than one task should sort; the most frequent ones are spread over tasks.
# The summary of a column tracks HOT_TRACKED values, so it misses none that fills over 1 / (0.75 HOT_TRACKED) of the rows.
HOT_ROWS = 20_000
HOT_VALUES = 1_000
HOT_TRACKED = 16_384


# ---------------------------------------------------------------- one-hot


def onehot_name(column: str, value: Any) -> str:
    return f"onehot_{column}={'nan' if value is None else value}"


def choose_by_count(profiles: Mapping[str, ColumnProfile], most: int = ONEHOT_MOST_VALUES) -> dict[str, int]:
    """Columns with more than 2 and at most ``most`` values, missing counted as a value."""
    return {n: p.values for n, p in profiles.items() if p.exact and 2 < p.values <= most}


def choose_by_budget(
    profiles: Mapping[str, ColumnProfile],
    width: int,
    most: int = BUDGET_MOST_VALUES,
    most_columns: int = BUDGET_MOST_COLUMNS,
) -> dict[str, int]:
    """Columns in ascending number of values while the table stays within ``most_columns``.

    Gives column -> number of values to encode. Encoding stops as soon as the
    table is two columns short of the limit, also inside a column.
    """
    ranked = sorted(choose_by_count(profiles, most).items(), key=lambda item: item[1])
    out: dict[str, int] = {}
    for name, values in ranked:
        if width + values > most_columns:
            continue
        room = max(1, most_columns - 2 - width)
        out[name] = min(values, room)
        width += out[name]
    return out


def choose_by_width(
    profiles: Mapping[str, ColumnProfile], width: int, big: bool = False, most_columns: int = CAP_MOST_COLUMNS
) -> dict[str, int]:
    """Columns in table order until the next one would pass ``most_columns``; none of a table the caller calls big.

    A column whose number of values is only estimated has more than any limit here allows for.
    """
    out: dict[str, int] = {}
    for name, p in {} if big else profiles.items():
        if width + p.distinct > most_columns:
            break
        if not p.exact:
            raise ValueError(f"{name}: over {most_columns} columns asked for, but its values are only estimated")
        out[name] = p.values
        width += p.values
    return out


@dataclass(frozen=True)
class OneHot:
    """Fitted values per column, in value order; None stands for missing.

    ``left_out`` has the values that a limit kept out of a chosen column.
    """

    values: Mapping[str, Sequence[Any]]
    left_out: Mapping[str, Sequence[Any]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, chosen: Mapping[str, int]) -> OneHot:
        """Collect the values of the chosen columns.

        The choice has bounded their number, so the sets are small on every
        task and on the driver.
        """
        types = {f.name: f.dataType for f in df.schema.fields}
        found: dict[str, list[Any]] = {}
        for batch in batches(list(chosen)):
            aggs = []
            for i, n in enumerate(batch):
                c = _comparable(n, types[n])
                aggs += [f"sort_array(collect_set({c})) as s{i}", f"bool_or({c} is null) as m{i}"]
            row = df.selectExpr(*aggs).first()
            for i, n in enumerate(batch):
                found[n] = list(row[f"s{i}"]) + ([None] if row[f"m{i}"] else [])
        cut = {n: v[chosen[n] :] for n, v in found.items() if len(v) > chosen[n]}
        return cls({n: v[: chosen[n]] for n, v in found.items()}, cut)

    def names(self) -> list[str]:
        return [onehot_name(c, v) for c, values in self.values.items() for v in values]

    def apply(self, df: DataFrame) -> DataFrame:
        """Add one 0/1 column per fitted value; missing and unseen values get 0 everywhere."""
        types = {f.name: f.dataType for f in df.schema.fields}
        block = []
        for n, values in self.values.items():
            c = _comparable(n, types[n])
            for v in values:
                hit = "0" if v is None else f"coalesce(cast({c} = {literal(v)} as int), 0)"
                block.append(f"{hit} as {quoted(onehot_name(n, v))}")
        return df.selectExpr("*", *block) if block else df

    def table(self, spark) -> DataFrame:
        """(column, value, position) with the value as text."""
        rows = [(c, None if v is None else str(v), i) for c, vs in self.values.items() for i, v in enumerate(vs)]
        return spark.createDataFrame(rows, "column string, value string, position int")

    def dropped(self, spark, profiles: Mapping[str, ColumnProfile] | None = None) -> DataFrame:
        """(column, value): values that a limit left out; with ``profiles`` also the columns with 3 or more
        values that were not encoded at all (value null and ``whole`` true)."""
        rows = [(c, None if v is None else str(v), False) for c, vs in self.left_out.items() for v in vs]
        rows += [(n, None, True) for n, p in (profiles or {}).items() if p.values > 2 and n not in self.values]
        return spark.createDataFrame(rows, "column string, value string, whole boolean")


def _comparable(name: str, dtype) -> str:
    c = quoted(name)
    return c if is_number(dtype) or dtype.simpleString() == "string" else f"cast({c} as string)"


def fit_onehot(df: DataFrame, names: Sequence[str] | None = None, most: int = ONEHOT_MOST_VALUES, roles: Roles = DEFAULT_ROLES) -> OneHot:
    names = roles.features(df.columns) if names is None else names
    return OneHot.fit(df, choose_by_count(profile(df, names), most))


def fit_onehot_budget(
    df: DataFrame, names: Sequence[str] | None = None, most: int = BUDGET_MOST_VALUES,
    most_columns: int = BUDGET_MOST_COLUMNS, roles: Roles = DEFAULT_ROLES,
) -> OneHot:
    names = roles.features(df.columns) if names is None else names
    width = len(df.columns) - int(roles.label in df.columns)
    return OneHot.fit(df, choose_by_budget(profile(df, names), width, most, most_columns))


def fit_onehot_width_cap(
    df: DataFrame, names: Sequence[str] | None = None, big: bool = False,
    most_columns: int = CAP_MOST_COLUMNS, roles: Roles = DEFAULT_ROLES,
) -> OneHot:
    names = roles.features(df.columns) if names is None else names
    width = len(df.columns) - int(roles.label in df.columns)
    return OneHot.fit(df, choose_by_width(profile(df, names), width, big, most_columns))


# ---------------------------------------------------------------- value lookups


def encoded_columns(names: Sequence[str], roles: Roles = DEFAULT_ROLES) -> list[str]:
    return roles.columns(names, "id", "string", "categorical")


def frequency_table(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value, n) of all named columns in one grouping, missing values left out."""
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), col(n).cast("string").alias("value")) for n in names])
    long = df.select(F.inline(pairs)).where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Lookup:
    """A written (column, value, n, code) table with the size of each column's part."""

    table: DataFrame
    rows: int
    sizes: Mapping[str, tuple[int, int]] = field(default_factory=dict)  # column -> entries, bytes

    @classmethod
    def of(cls, table: DataFrame, rows: int, names: Sequence[str]) -> Lookup:
        size = table.groupBy("column").agg(
            F.count(F.lit(1)).alias("entries"), F.sum(F.octet_length("value") + F.lit(24)).alias("bytes")
        )
        found = {r["column"]: (r["entries"], r["bytes"]) for r in size.collect()}
        return cls(table, rows, {n: found.get(n, (0, 0)) for n in names})

    def part(self, name: str) -> DataFrame:
        return self.table.where(F.col("column") == F.lit(name))

    def small(self, name: str, most_rows: int, most_bytes: int) -> bool:
        entries, size = self.sizes[name]
        return entries <= most_rows and size <= most_bytes

    def apply(
        self, df: DataFrame, most_rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
    ) -> DataFrame:
        """Replace each fitted column by its code; missing and unseen values get -1.

        The smallest columns take a broadcast join as long as each is within
        ``most_rows`` and all together within ``most_bytes``, so the table does
        not move. A larger column is joined by shuffle on value and salt: a hot
        value's rows are dealt over several salts, and its entry is repeated
        for each; missing values get a salt of their own per row. The hot values of all larger columns are
        found on the table that is scored, in one pass, so one that training never saw is spread too.
        """
        order, left, large = df.columns, most_bytes, []
        sizes = sorted(self.sizes, key=lambda n: (self.sizes[n][1], n))
        for name in sizes:
            if self.small(name, most_rows, left):
                left -= self.sizes[name][1]
            else:
                large.append(name)
        hot = self._hot(df, large, hot_rows)
        for i, name in enumerate(sizes):
            df = self._large(df, name, i, hot[name]) if name in hot else self._small(df, name, i)
        return df.select(*[col(c) for c in order])

    def _small(self, df: DataFrame, name: str, i: int) -> DataFrame:
        key, code = f"_v{i}", f"_c{i}"
        part = self.part(name).select(F.col("value").alias(key), F.col("code").alias(code))
        joined = df.join(F.broadcast(part), col(name).cast("string") == F.col(key), "left")
        return joined.withColumn(name, F.coalesce(F.col(code), F.lit(UNSEEN).cast("bigint"))).drop(key, code)

    def _hot(self, df: DataFrame, names: Sequence[str], hot_rows: int) -> dict[str, DataFrame]:
        """Column -> (hash, parts) of its values of over ``hot_rows`` rows, at most ``HOT_VALUES``.

        Mergeable summaries of the most frequent hashes, one per column and of fixed size, in a single pass over the
        table; a stream, which cannot be passed over first, takes the counts of training.
        """
        spark = df.sparkSession
        found: dict[str, list[tuple[int, int]]] = {}
        if names and not df.isStreaming:
            summaries = [
                f"approx_top_k(if({quoted(n)} is null, null, xxhash64(cast({quoted(n)} as string))), {HOT_VALUES}, {HOT_TRACKED}) as t{i}"
                for i, n in enumerate(names)
            ]
            row = df.agg(*[F.expr(s) for s in summaries]).first()
            found = {n: [(t["item"], t["count"]) for t in row[i] if t["item"] is not None] for i, n in enumerate(names)}
        elif names:
            top = self.table.where(F.col("column").isin(list(names)) & (F.col("n") > hot_rows)).orderBy(F.desc("n")).limit(HOT_VALUES)
            for r in top.select("column", F.xxhash64("value").alias("h"), "n").collect():
                found.setdefault(r["column"], []).append((r["h"], r["n"]))
        # Two values with one hash only share their number of salts.
        return {
            n: spark.createDataFrame([(h, -(-c // hot_rows)) for h, c in found.get(n, ()) if c > hot_rows], "h bigint, parts bigint")
            for n in names
        }

    def _large(self, df: DataFrame, name: str, i: int, hot: DataFrame) -> DataFrame:
        spread = F.xxhash64(col(KEY)) if KEY in df.columns else F.monotonically_increasing_id()
        text = col(name).cast("string")
        part = self.part(name).select(F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_c{i}"))
        hot = F.broadcast(hot.select(F.col("h").alias(f"_h{i}"), F.col("parts").alias(f"_p{i}")))  # at most HOT_VALUES rows
        marked = df.join(hot, F.xxhash64(text) == F.col(f"_h{i}"), "left").withColumns({
            f"_k{i}": text,
            f"_s{i}": F.when(text.isNull(), spread).otherwise(F.coalesce(F.pmod(spread, F.col(f"_p{i}")), F.lit(0))),
        }).drop(f"_h{i}", f"_p{i}")
        entries = part.join(hot, F.xxhash64(f"_v{i}") == F.col(f"_h{i}"), "left").withColumn(
            f"_vs{i}", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(f"_p{i}") - 1, F.lit(0).cast("bigint"))))
        ).drop(f"_h{i}", f"_p{i}")
        joined = marked.join(
            entries, (F.col(f"_k{i}") == F.col(f"_v{i}")) & (F.col(f"_s{i}") == F.col(f"_vs{i}")), "left"
        )
        value = F.coalesce(F.col(f"_c{i}"), F.lit(UNSEEN).cast("bigint"))
        return joined.withColumn(name, value).drop(f"_k{i}", f"_s{i}", f"_v{i}", f"_c{i}", f"_vs{i}")


def fit_frequency(df: DataFrame, names: Sequence[str] | None = None, roles: Roles = DEFAULT_ROLES) -> Lookup:
    """Value -> number of training rows that hold it, for id and text columns."""
    names = encoded_columns(df.columns, roles) if names is None else list(names)
    if not names:
        return Lookup(df.sparkSession.createDataFrame([], "column string, value string, n bigint, code bigint"), 0, {})
    counted = settle(frequency_table(df, names).withColumn("code", F.col("n")), "frequency")
    # the rows of any one column cannot exceed this, which is all the hot share needs
    most = counted.groupBy("column").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    return Lookup.of(counted, most or 0, names)


DICTIONARY_MOST_SHARE = 0.5


# Distinct estimates err by about 1.6 %: beyond this factor a column is out without an exact count.
ESTIMATE_SLACK = 1.2


def fit_dictionary(
    df: DataFrame, names: Sequence[str] | None = None, most_share: float = DICTIONARY_MOST_SHARE,
    profiles: Mapping[str, ColumnProfile] | None = None,
) -> Lookup:
    """Text columns with fewer than one distinct value per two rows -> codes in value order.

    Sketches rule out the columns that are mostly distinct (free text), so that
    only values of likely dictionary columns are grouped; the rule itself is
    then decided on exact counts.
    """
    text = [n for n, t in df.dtypes if t == "string"] if names is None else list(names)
    profiles = profiles or (profile(df, text) if text else {})
    rows = profiles[text[0]].rows if text else 0
    text = [n for n in text if profiles[n].distinct < most_share * ESTIMATE_SLACK * rows]
    if not text:
        return Lookup(df.sparkSession.createDataFrame([], "column string, value string, n bigint, code bigint"), 0, {})
    counted = settle(frequency_table(df, text), "dictionary")
    distinct = {r["column"]: r["d"] for r in counted.groupBy("column").agg(F.count(F.lit(1)).alias("d")).collect()}
    chosen = [n for n in text if rows and distinct.get(n, 0) / rows < most_share]
    coded = settle(dense_codes(counted.where(F.col("column").isin(chosen)), "column", "value"), "codes")
    discard(counted)
    return Lookup.of(coded, rows, chosen)
