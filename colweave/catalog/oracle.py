"""The registered queries as DuckDB SQL, written from their definitions."""

from __future__ import annotations

from collections.abc import Iterable

# ---------------------------------------------------------------- feature tables as SQL

ORDERS = """q as (select l_orderkey, sum(l_quantity) sq from lineitem group by l_orderkey),
f as (select o_orderkey line_id, q.sq number_0, cast(o_custkey % 7 as double) number_1,
 cast(o_custkey % 7 as double)*2+1 number_2,
 case when o_orderkey % 5 = 0 then null else cast(1 as double) end number_const,
 cast(null as double) number_null,
 case when o_orderkey % 13 = 0 then null else o_orderpriority end string_0,
 o_orderstatus string_1, cast(o_custkey as varchar) id_0,
 case when o_orderkey % 6 in (0,3) then strftime(o_orderdate,'%Y-%m-%d')
  when o_orderkey % 6 in (1,4) then strftime(o_orderdate + to_hours(cast(o_orderkey%24 as int))
   + to_minutes(cast(o_orderkey%60 as int)),'%Y-%m-%d %H:%M:%S')
  when o_orderkey % 6 = 2 then 'n/a' end datetime_0,
 cast(3 as double)*(o_custkey % 7) + cast(0.5 as double)*coalesce(q.sq,-1)
  + cast((o_orderkey*37) % 101 as double)/10 target
 from orders left join q on l_orderkey = o_orderkey)"""

PARSE = """case when length(datetime_0) = 10 then try_strptime(datetime_0, '%Y-%m-%d')
 when length(datetime_0) = 19 then try_strptime(datetime_0, '%Y-%m-%d %H:%M:%S') end"""

EMPTY = "timestamp '0001-01-01 00:00:00'"

PARTS = {
    "year": "year(t)",
    "weekday": "isodow(t) - 1",
    "month": "month(t)",
    "day": "day(t)",
    "hour": "hour(t)",
    "hour_of_week": "hour(t) + (isodow(t) - 1) * 24",
    "minute_of_day": "minute(t) + hour(t) * 60",
}
SIX = ["weekday", "month", "day", "hour", "hour_of_week", "minute_of_day"]
FIVE = ["year", "weekday", "month", "day", "hour"]

FOLDED = "((({k}) % 2147483648 + ((({k}) // 2147483648) % 2147483648 * 1103515245) % 2147483648) % 2147483648)"
HASH = f"({FOLDED} * 2654435761) % 4294967296"
FOLD_HASH = f"({FOLDED.format(k='line_id')} * 3266489917) % 4294967296"
IN_TEST = HASH.format(k="line_id") + " < 1073741824"

NUMBERS = ["number_0", "number_1", "number_2"]
FILLABLE = [*NUMBERS, "number_const", "number_null"]
COLUMNS = [*FILLABLE, "string_0", "string_1", "id_0", "datetime_0"]
LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def part(p: str) -> str:
    return f"cast({PARTS[p]} as integer)"


def part_name(p: str) -> str:
    return f"number_{p}_datetime_0"


DATES = [part_name(p) for p in SIX]


def orders(select: str, *more: str) -> str:
    """A select over ``f``, the orders features; ``more`` adds common table expressions."""
    return f"with {', '.join([ORDERS, *more])} {select}"


def parts(names: Iterable[str]) -> str:
    return ", ".join(f"{part(p)} {part_name(p)}" for p in names)


# x: the orders features with parsed dates and the six parts; xf: the same with -1 for missing
X = f"p as (select *, {PARSE} t from f), x as (select *, {parts(SIX)} from p)"
XF = (
    "xf as (select line_id, target, "
    + ", ".join(f"coalesce({c}, -1) {c}" for c in [*FILLABLE, *DATES])
    + ", "
    + ", ".join(f"coalesce({c}, '-1') {c}" for c in ["string_0", "string_1", "id_0"])
    + " from x)"
)


def r(expression: str, digits: int = 6) -> str:
    return f"round(cast({expression} as double), {digits}) + cast(0 as double)"


def quoted(name: str) -> str:
    return '"' + name + '"'


def union(parts_: Iterable[str]) -> str:
    return " union all ".join(parts_)


def indicator(column: str, value: str) -> str:
    """0/1 of one value given as SQL text."""
    return f"cast(coalesce(cast({column} = {value} as integer), 0) as integer)"


# Values found in the tables at every scale.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATES = ["F", "O", "P"]
SEVENS = [f"{i}.0" for i in range(7)]
ODDS = [f"{2 * i + 1}.0" for i in range(7)]


def onehots(column: str, values: Iterable[str], text: bool = False, missing: bool = False) -> list[tuple[str, str]]:
    """(name, expression) per value; the indicator of missing is 0 everywhere."""
    out = [(f"onehot_{column}={v}", indicator(column, f"'{v}'" if text else v)) for v in values]
    return [*out, (f"onehot_{column}=nan", "cast(0 as integer)")] if missing else out


def block(pairs: Iterable[tuple[str, str]]) -> str:
    return ", ".join(f"{expression} {quoted(name)}" for name, expression in pairs)


def scaled(pairs: Iterable[tuple[str, str]], source: str, label: str = "target") -> str:
    """Standardised columns over ``source``; no deviation means divide by 1."""
    pairs = list(pairs)
    inner = ", ".join(f"cast({e} as double) c{i}" for i, (_, e) in enumerate(pairs))
    outer = ", ".join(
        r(f"(c{i} - avg(c{i}) over ()) / case when max(c{i}) over () = min(c{i}) over () then 1 "
          f"else stddev_pop(c{i}) over () end") + f" {quoted(n)}"
        for i, (n, _) in enumerate(pairs)
    )
    return f"select line_id, {r(label)} {label}, {outer} from (select line_id, {label}, {inner} from {source})"


def corr(x: str, y: str) -> str:
    """Pearson r over the rows where both are filled; null where a side does not vary."""
    sides = f"stddev_pop(case when {y} is not null then {x} end) * stddev_pop(case when {x} is not null then {y} end)"
    return f"covar_pop({y}, {x}) / nullif({sides}, 0)"


def corr_pairs(names: list[str], source: str) -> str:
    return union(
        f"select '{a}' column_i, '{b}' column_j, {r(corr(a, b))} r from {source}"
        for i, a in enumerate(names) for b in names[i + 1 :]
    )


def distinct(names: Iterable[str], source: str) -> str:
    return union(f"select '{n}' \"column\", count(distinct {n}) n_distinct from {source}" for n in names)


def width_of(kind: str) -> str:
    """Smallest signed integer type that holds [lo, hi]."""
    low = "lo >= 0 and " if kind == "unsigned" else ""
    return (
        f"case when {low}lo >= -128 and hi <= 127 then 'tinyint' when {low}lo >= -32768 and hi <= 32767 then 'smallint' "
        f"when {low}lo >= -2147483648 and hi <= 2147483647 then 'int' else 'bigint' end"
    )


LINE_INTEGERS = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int"}
ORDER_METRICS = "select string_1 dataset, count(*) \"rows\", round(avg(target), 6) score from f group by 1"
EVENT_METRICS = (
    "select event_type dataset, count(*) \"rows\", count(distinct user_id) users, max(value) top from events group by 1"
)

_SQL: dict[str, str] = {}




# ---------------------------------------------------------------- what must hold of fits and random values

_EVENT_TEST = HASH.format(k="event_id") + " < 1073741824"
_NUMBER_FACTS = orders(f"select line_id, true is_finite, true beats_mean from f where {IN_TEST}")
_EVENT_FACTS = f"select event_id line_id, true in_range from events where {_EVENT_TEST}"
for _name in ("fit_gbt_reg", "fit_forest", "train_onehot", "train_freq"):
    _SQL[_name] = _NUMBER_FACTS
for _name in ("fit_gbt_cls", "fit_linear_svm", "predict_proba", "score_replay"):
    _SQL[_name] = _EVENT_FACTS
_SQL["fit_document_quality"] = "select doc_id line_id, true in_range from documents join labels using (doc_id)"
_SQL["fit_logistic"] = "select true every_feature, true balanced"
_SQL["run_id"] = "select cast(count(*) as bigint) \"rows\", cast(1 as bigint) ids, 36 length from orders"
_SQL["estimate_rows"] = "select count(*) \"rows\", true rows_near, true row_size_near from orders"
_SQL["pca_k99"] = "select cast(64 as bigint) components, true sums_to_one, true kept_by_rule"
_SQL["candidate_leaderboard"] = "select unnest(['boost_fast', 'boost_slow']) model, true scored, true timed"
_SQL["automl_leaderboard"] = (
    "select unnest(['linear', 'forest', 'boost_fast', 'boost_slow', 'linear_svm']) model, true scored, true timed"
)
_SQL["grid_search"] = (
    "select 'maxDepth=' || d || ', stepSize=' || s params, true scored from "
    "(select unnest(['2', '4']) d), (select unnest(['0.1', '0.3']) s)"
)
_SQL["depth_search"] = "select true in_order, true steady, true ended, true kept_rule"
_SQL["boost_curve"] = "select cast(10 as bigint) rounds, true comes_down, true positive"
_SQL["feature_response"] = "select true shares_one, true bounded"
_SQL["batch_runs"] = orders(
    "select s.*, true score_ok, true timed, true named, true sized, true with_parameters from ("
    "select 'orders' dataset, 'regression' \"mode\", cast(count(*) filter (not is_test) as bigint) \"rows\", "
    f"cast({len(COLUMNS) + 1 + len(FIVE)} as bigint) \"columns\", "
    "'LinearRegressionModel' \"method\", count(*) filter (is_test) predicted_rows, count(*) filter (is_test) written, "
    f"cast(sum(line_id) filter (is_test) as bigint) key_sum from (select line_id, {IN_TEST} is_test from f) "
    "union all select 'events', 'classification', count(*) filter (not is_test), 11, 'LogisticRegressionModel', count(*) filter (is_test), "
    f"count(*) filter (is_test), cast(sum(event_id) filter (is_test) as bigint) from (select event_id, {_EVENT_TEST} is_test from events)) s"
)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- scans and sinks

_CSV = orders("select * replace (nullif(datetime_0, 'n/a') as datetime_0) from f")
_SQL["scan_csv"] = _CSV
_SQL["scan_bounded"] = _CSV
_SQL["scan_csv_headers"] = _CSV
_SQL["scan_csv_quoted"] = "select doc_id line_id, text string_0 from documents"
_SQL["scan_limit"] = orders("select * from f order by line_id limit 500")
_SQL["scan_columns"] = orders("select line_id, number_0, string_1 from f")
_SQL["sink_prediction"] = orders("select line_id, round(target) + cast(0 as double) prediction from f")
_SQL["sink_metrics"] = orders(f"{ORDER_METRICS} union all {ORDER_METRICS}")
_SQL["metrics_by_schema"] = orders(
    "select upper(md5('datasetrowsscorerun_id')) schema_hash, count(*) n_rows, cast(1 as bigint) n_runs from a "
    "union all select upper(md5('datasetrowsuserstoprun_id')), 2 * count(*), cast(2 as bigint) from b",
    f"a as ({ORDER_METRICS})", f"b as ({EVENT_METRICS})",
)
_UNION = orders(
    "select dataset, \"rows\", score, cast(null as bigint) users, cast(null as double) top, 'run-1' run_id from a "
    "union all select dataset, \"rows\", null, users, top, run_id from b, (values ('run-1'), ('run-2')) v(run_id)",
    f"a as ({ORDER_METRICS})", f"b as ({EVENT_METRICS})",
)
_SQL["metrics_union"] = _UNION
_SQL["metrics_export"] = f"select dataset, \"rows\", score, users, top from ({_UNION}) where run_id = 'run-1'"

# least squares with penalty 1 on one column
RIDGE = (
    "ridge as (select regr_sxy(target, number_1) / (regr_sxx(target, number_1) + 1) b, avg(target) my, avg(number_1) mx,"
    " stddev_pop(number_1) sd from {source})"
)
_SQL["model_roundtrip"] = orders(
    f"select line_id, {r('my + b * (number_1 - mx)', 5)} prediction from f, ridge", RIDGE.format(source="f")
)
_SQL["predict_label"] = orders(
    f"select line_id, {r('my + b * (number_1 - mx)', 5)} prediction from f, ridge where {IN_TEST}",
    f"trained as (select * from f where not ({IN_TEST}))", RIDGE.format(source="trained"),
)
_SQL["fit_ridge"] = orders(
    f"select {r('b')} coefficient, {r('my - b * mx')} intercept from ridge", RIDGE.format(source="f")
)
_SQL["feature_response_linear"] = orders(
    f"select 'number_1' feature, {r('-b * sd / 2', 5)} fr_dec, {r('b * sd / 2', 5)} fr_inc, "
    f"{r('abs(b) * sd / 2', 5)} frd_abs, {r('abs(b) * sd / 2', 5)} fri_abs, {r('abs(b) * sd / 2', 5)} frd_mad, "
    f"{r('abs(b) * sd / 2', 5)} fri_mad, {r('sd / 2', 5)} delta from ridge",
    RIDGE.format(source="f"),
)

_DRAWN = ", ".join(
    f"cast({HASH.format(k=f'line_id * {2 * i + 3} + {i}')} as double) / 4294967296 number_{i}" for i in range(6)
)
_SQL["synth_table"] = orders(
    "select *, (number_0 + number_1) / nullif(number_2 * number_3, 0) number_depend, cast(0 as double) number_zero from d",
    f"d as (select line_id, {_DRAWN} from f)",
)
_SQL["inject_nulls"] = orders(
    "select * replace (case when not (line_id >= 3000 and line_id < 5000) then number_1 end as number_1, "
    "case when not (line_id >= 4000 and line_id < 6000) then number_0 end as number_0, "
    "case when not (line_id >= 5000 and line_id < 8000) then string_1 end as string_1) from f"
)

# ---------------------------------------------------------------- projections

_SQL["split_label"] = orders("select line_id, number_0, number_1, number_2, target from f")
_SQL["select_prefix"] = orders(f"select line_id, {', '.join(FILLABLE)} from f")
_SQL["select_deny"] = orders(f"select line_id, {', '.join(FILLABLE)}, string_1 from f")
_SQL["replay_columns"] = orders("select line_id, number_2, number_0, string_0 from f")
_SQL["select_dtype"] = orders(f"select line_id, {', '.join(FILLABLE)}, target from f")
_SQL["append_block"] = orders(
    "select line_id, number_0, number_1, number_0 + number_1 number_sum, number_0 - number_1 number_gap from f"
)
_SQL["guard_min_rows"] = orders("select count(*) \"rows\", least(count(*), 2) rows_checked from f")
_SQL["row_prefix_long"] = orders(
    "select * exclude (at_row) from (select *, row_number() over (order by line_id) at_row from f) "
    "where at_row <= (select count(*) * 4 // 5 from f)"
)
_SQL["filter_profile"] = orders(
    f"select * from ({distinct(COLUMNS, 'f')}) where n_distinct > 2 and n_distinct <= 20"
)


def value_table(names: Iterable[str], source: str) -> str:
    return union(
        f"select '{n}' \"column\", cast({n} as varchar) \"value\", count(*) n from {source} where {n} is not null group by 2"
        for n in names
    )


_SQL["column_roles"] = orders(value_table(["number_1", "string_0", "string_1"], "f"))
_SQL["freq_fit"] = orders(value_table(["string_0", "string_1", "id_0"], "f"))

# ---------------------------------------------------------------- missing values

_SQL["any_null"] = orders(
    "select 'orders_features' tab, coalesce(bool_or("
    + " or ".join(f"{c} is null" for c in [*COLUMNS, "target", "line_id"])
    + "), false) any_missing from f union all select 'lineitem', coalesce(bool_or(l_orderkey is null or l_quantity is null"
    " or l_shipdate is null or l_returnflag is null), false) from lineitem"
)


def filled(numbers: str = "-1", texts: str = "'-1'") -> str:
    return (
        "* replace ("
        + ", ".join(f"coalesce({c}, {numbers.format(c=c)}) as {c}" for c in FILLABLE)
        + (", " + ", ".join(f"coalesce({c}, {texts}) as {c}" for c in ["string_0", "string_1", "id_0", "datetime_0"]) if texts else "")
        + ")"
    )


_SQL["fill_const"] = orders(f"select {filled()} from f")
_SQL["fill_mean"] = orders(f"select {filled('(select avg({c}) from f)', '')} from f")
_SQL["fill_max"] = orders(f"select {filled('(select max({c}) from f)', '')} from f")
_MODE = "(select {c} from f where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"
_SQL["fill_mode"] = orders(
    "select * replace (" + ", ".join(f"coalesce({c}, {_MODE.format(c=c)}) as {c}" for c in [*FILLABLE, "string_0"]) + ") from f"
)
_SQL["fill_replay"] = orders(f"select {filled()} from f where {IN_TEST}")
_HOLLOW = f"h as (select line_id, case when line_id % 3 <> 0 then number_1 end number_1, number_2 from f where {IN_TEST})"
_SQL["fill_replay_mean"] = orders(
    f"select line_id, {r(f'coalesce(number_1, (select avg(number_1) from f where not ({IN_TEST})))', 9)} number_1, "
    f"{r('number_2', 9)} number_2 from h",
    _HOLLOW,
)
_SQL["fill_replay_self"] = orders(
    f"select line_id, {r('coalesce(number_1, (select avg(number_1) from h))', 9)} number_1, {r('number_2', 9)} number_2 from h",
    _HOLLOW,
)

# ---------------------------------------------------------------- dates and scalars

_SQL["parse_dt_null"] = orders(f"select line_id, strftime({PARSE}, '%Y-%m-%d %H:%M:%S') parsed from f")
_SQL["parse_dt_sentinel"] = orders(
    f"select line_id, coalesce(strftime({PARSE}, '%Y-%m-%d %H:%M:%S'), '0001-01-01 00:00:00') parsed from f"
)
for _p in PARTS:
    _source = f"coalesce({PARSE}, {EMPTY})" if _p == "year" else PARSE
    _SQL[f"dt_{_p}"] = orders(f"select line_id, {part(_p)} {quoted(_p)} from (select line_id, {_source} t from f)")
_SQL["datetime_expand6"] = orders(f"select line_id, {', '.join(DATES)} from x", X)
_SQL["datetime_expand6_zone"] = _SQL["datetime_expand6"]
_SQL["datetime_expand5"] = orders(
    f"select line_id, {parts(FIVE)} from (select line_id, coalesce({PARSE}, {EMPTY}) t from f)"
)
_SQL["round_scale"] = orders("select line_id, round_even(target * 10, 0) scaled from f")
_SQL["feature_arith"] = (
    "select l_orderkey, l_linenumber, (l_quantity + l_extendedprice) / nullif(l_discount * l_tax, 0) as share, "
    "l_quantity / nullif(l_extendedprice + cast(1e-16 as double), 0) + l_discount * l_tax as mix from lineitem"
)
_SQL["md5_upper"] = "select doc_id, upper(md5(\"text\")) digest from documents"
_SQL["zero_pad"] = orders(
    "select line_id, case when length(cast(line_id as varchar)) >= 4 then cast(line_id as varchar) "
    "else lpad(cast(line_id as varchar), 4, '0') end padded from f"
)

# ---------------------------------------------------------------- narrower types

_SQL["narrow_int"] = union(
    f"select '{c}' \"column\", '{t}' from_type, {width_of('signed')} to_type from (select min({c}) lo, max({c}) hi from lineitem)"
    for c, t in LINE_INTEGERS.items()
)
_SQL["narrow_unsigned"] = (
    "with l as (select *, l_suppkey - 50 signed from lineitem) select * from ("
    + union(
        f"select '{c}' \"column\", '{t}' from_type, {width_of('signed')} to_type from (select min({c}) lo, max({c}) hi from l) where lo >= 0"
        for c, t in {**LINE_INTEGERS, "signed": "bigint"}.items()
    )
    + ")"
)
_LOSS = "max(abs({c} - cast(cast({c} as float) as double))) <= 0.0005"
_SQL["narrow_float"] = (
    "select * from ("
    + union(
        f"select '{c}' \"column\", 'double' from_type, 'float' to_type from lineitem having {_LOSS.format(c=c)}" for c in LINES
    )
    + ")"
)
_SQL["narrow_apply"] = (
    "select cast(l_linenumber as tinyint) l_linenumber, cast(l_quantity as float) l_quantity, l_extendedprice, "
    "cast(l_discount as float) l_discount, l_tax from lineitem"
)


_CODES = ", ".join(
    f"d{i} as (select v, row_number() over (order by v) - 1 code from (select distinct {n} v from f where {n} is not null))"
    for i, n in enumerate(["string_0", "string_1", "id_0"])
)
_SQL["dictionary_encode"] = orders(
    "select line_id, coalesce(d0.code, -1) string_0, coalesce(d1.code, -1) string_1, coalesce(d2.code, -1) id_0 from f "
    "left join d0 on string_0 = d0.v left join d1 on string_1 = d1.v left join d2 on id_0 = d2.v",
    _CODES,
)
_BYTES = "case {t} when 'tinyint' then 1 when 'smallint' then 2 when 'int' then 4 else 8 end"
_NEW = " + ".join(
    "(select {b} from (select min({c}) lo, max({c}) hi from lineitem))".format(c=c, b=_BYTES.format(t=f"({width_of('signed')})"))
    for c in LINE_INTEGERS
) + " + " + " + ".join(f"(select case when {_LOSS.format(c=c)} then 4 else 8 end from lineitem)" for c in LINES)
_SQL["narrow_report"] = (
    "select old_bytes, new_bytes, round(old_bytes / new_bytes, 2) ratio from (select "
    "cast(count(*) * (8*3 + 4 + 8*4 + 8) + sum(strlen(l_returnflag)) + sum(strlen(l_linestatus)) as bigint) old_bytes, "
    f"cast(count(*) * (4*2 + 8 + {_NEW}) as bigint) new_bytes from lineitem)"
)
_SQL["transform_ds"] = orders(
    "select line_id, target, cast(number_0 as float) number_0, cast(number_1 as float) number_1, "
    "cast(number_2 as float) number_2, cast(number_null as float) number_null, "
    + ", ".join(
        f"cast({e} as tinyint) {quoted(n)}"
        for n, e in [*onehots("string_0", PRIORITIES, True, True), *onehots("string_1", STATES, True)]
    )
    + " from f"
)
_SQL["dtype_counts"] = orders(
    "select 'bigint' dtype, cast(1 as bigint) n_columns, count(line_id) n_values from f union all "
    f"select 'double', 6, {' + '.join(f'count({c})' for c in [*FILLABLE, 'target'])} from f union all "
    "select 'string', 4, count(string_0) + count(string_1) + count(id_0) + count(datetime_0) from f"
)
_SQL["is_big"] = (
    "select bytes, bytes > 524288000 is_big from (select cast(count(*) * (8*3 + 4 + 8*4 + 8) + sum(strlen(l_returnflag))"
    " + sum(strlen(l_linestatus)) as bigint) bytes from lineitem)"
)

# ---------------------------------------------------------------- encoders

_E1 = [
    *onehots("number_1", SEVENS), *onehots("number_2", ODDS), *onehots("string_0", PRIORITIES, True, True),
    *onehots("string_1", STATES, True),
]
_SQL["onehot_fit"] = orders(f"select line_id, {block(_E1)} from f")
_FILLED_PRIORITIES = ["-1", *PRIORITIES]
_SQL["onehot_budget"] = orders(
    "select line_id, "
    + block([
        *onehots("string_1", STATES, True), *onehots("string_0", _FILLED_PRIORITIES, True), *onehots("number_1", SEVENS[:6]),
    ])
    + " from xf",
    X, XF,
)
_SQL["onehot_width_cap"] = orders(
    "select line_id, "
    + block([
        *onehots("number_1", SEVENS), *onehots("string_0", PRIORITIES, True, True), *onehots("string_1", STATES, True),
    ])
    + " from f"
)
_SQL["onehot_replay"] = orders(
    "select line_id, "
    + block([
        *onehots("string_0", PRIORITIES, True, True), *onehots("string_1", STATES, True), *onehots("number_1", SEVENS),
    ])
    + " from (select * replace (case when line_id % 10 = 0 then 'no such value' else string_0 end as string_0) from f "
    f"where {IN_TEST})"
)


def frequencies(names: list[str], train: str) -> str:
    return ", ".join(
        f"d{i} as (select {n} v, count(*) n from {train} where {n} is not null group by 1)" for i, n in enumerate(names)
    )


def coded(names: list[str], source: str) -> tuple[str, str]:
    """(columns, joins) of the frequency codes of ``names`` in ``source``."""
    columns = ", ".join(f"coalesce(d{i}.n, -1) {n}" for i, n in enumerate(names))
    joins = " ".join(f"left join d{i} on {source}.{n} = d{i}.v" for i, n in enumerate(names))
    return columns, joins


_TEXT = ["string_0", "string_1", "id_0"]
_TRAIN = f"tr as (select * from f where not ({IN_TEST})), te as (select * from f where {IN_TEST})"
_columns, _joins = coded(_TEXT, "te")
_SQL["freq_replay"] = orders(f"select line_id, {_columns} from te {_joins}", _TRAIN, frequencies(_TEXT, "tr"))
_SQL["freq_replay_shuffled"] = _SQL["freq_replay"]
_SQL["freq_replay_skewed"] = orders(
    "select s.line_id, coalesce(c.n, -1) id_0 from s left join c on s.id_0 = c.id_0 where s.is_test",
    f"s as (select line_id, {IN_TEST} is_test, case when line_id % 8 < 4 then 'c' when line_id % 8 < 6 then 'new' "
    "when line_id % 8 = 6 then id_0 end id_0 from f)",
    "c as (select id_0, count(*) n from s where not is_test and id_0 <> 'new' group by 1)",
)



def running_target(name: str, rows: str) -> str:
    before = f"over (partition by {name} order by {FOLD_HASH}, line_id rows between unbounded preceding and 1 preceding)"
    return f"(coalesce(sum(target) {before}, 0) + (select avg(target) from {rows})) / (count(target) {before} + 1)"


_ENCODED = ["string_0", "string_1", "id_0"]
_SQL["ordered_target"] = orders(
    "select line_id, target, " + ", ".join(f"{r(running_target(c, 'f'))} {c}" for c in _ENCODED) + " from f"
).replace("select line_id, target,", f"select line_id, {r('target')} target,")
_SQL["ordered_target_skewed"] = orders(
    f"select line_id, {r('target')} target, {r(running_target('id_0', 's'))} id_0 from s",
    "s as (select line_id, target, case when line_id % 8 < 4 then 'c' when line_id % 8 >= 6 then id_0 end id_0 from f)",
)
_SQL["target_replay"] = orders(
    f"select line_id, {r('coalesce(a.m, p.m)')} string_0, {r('coalesce(b.m, p.m)')} id_0 from f cross join p "
    "left join a on f.string_0 is not distinct from a.string_0 left join b on f.id_0 is not distinct from b.id_0 "
    f"where {IN_TEST}",
    f"t as (select * from f where not ({IN_TEST}))", "p as (select avg(target) m from t)",
    *[f"{a} as (select {c}, (sum(target) + any_value(p.m)) / (count(target) + 1) m from t, p group by 1)" for a, c in (("a", "string_0"), ("b", "id_0"))],
)

# ---------------------------------------------------------------- profiles and selection

_SQL["drop_constant"] = orders("select * exclude (number_const) from f")
_SQL["profile_distinct"] = distinct(
    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINES, "l_returnflag", "l_linestatus", "l_shipdate"], "lineitem"
)
_WIDE = "cast((line_id * (2 * i + 3) + i) % (7 + i % 31) as double)"
_SQL["profile_distinct_wide"] = orders(
    f"select 'number_w' || i \"column\", count(distinct {_WIDE}) n_distinct from f, range(300) t(i) group by i "
    f"union all {distinct(COLUMNS, 'f')}"
)
_SQL["column_means_wide"] = orders(
    f"select 'number_w' || i \"column\", {r(f'avg({_WIDE})', 9)} mean from f, range(300) t(i) group by i"
)
_SQL["column_means"] = union(f"select '{c}' \"column\", {r(f'avg({c})', 5)} mean from lineitem" for c in LINES)
_SQL["distinct_values"] = "select distinct l_suppkey \"value\" from lineitem"
_SQL["value_counts"] = "select l_partkey \"value\", count(*) n from lineitem group by 1"
_SQL["corr_filter_sketched"] = """
with o as (select row_number() over (order by o_orderkey) as r, o_orderkey as k from orders),
v as (
  select i, r, cast(case when i % 3 = 2 and i > 2
    then (case when i % 2 = 1 then -1.0 else 1.0 end) * ((k * (2 * (i - 4) + 3) + (i - 4)) % (7 + (i - 4) % 31)) + (k * (2 * i + 5)) % 11 * (0.1 + i % 9 * 0.05)
    else (k * (2 * i + 3) + i) % (7 + i % 31) end as double) as x
  from o, range(400) c(i)
), m as (select i, avg(x) as mean, stddev_pop(x) as sd from v group by i),
z as (select i, cast(list((x - mean) / sd order by r) as double[]) as z, count(*) as n from v join m using (i) where sd > 0 group by i)
select 'number_' || b.i as "column" from z b
where exists (select 1 from z a where a.i < b.i and abs(list_inner_product(a.z, b.z) / a.n) > 0.95)
"""
_SQL["corr_matrix"] = orders(corr_pairs([*NUMBERS, "number_const", *DATES], "x"), X)
_SQL["corr_matrix_dense"] = (
    "with e as (select vec_id, unnest(embedding) v, generate_subscripts(embedding, 1) - 1 i from embeddings) "
    "select 'number_' || a.i column_i, 'number_' || b.i column_j, "
    + r("corr(cast(a.v as double), cast(b.v as double))")
    + " r from e a join e b on a.vec_id = b.vec_id and a.i < b.i group by a.i, b.i"
)
_SQL["corr_filter"] = orders(
    "select distinct column_j \"column\" from c where abs(r) > 0.95",
    X, XF, f"c as ({corr_pairs([*NUMBERS, 'number_const', *DATES], 'xf')})",
)
_NINE = [*NUMBERS, *DATES]
_SQL["target_corr_topk"] = orders(
    "select \"column\", abs_corr from ("
    + union(f"select '{n}' \"column\", {r(f'abs({corr(n, "target")})')} abs_corr from xf" for n in _NINE)
    + ") order by abs_corr desc nulls last, 1 limit 3",
    X, XF,
)
_SQL["variance_filter"] = "select * from (" + union(
    f"select '{c}' \"column\", {r(f'var_pop({c})', 2)} variance from lineitem having var_pop({c}) > 0.001" for c in LINES
) + ")"

_MI_COLUMNS = [*NUMBERS, "number_const", *DATES]


_SHARES = f"[{', '.join(str(k / 16) for k in range(1, 16))}]"
_CUTS = "cuts as (select " + ", ".join(
    f"list_distinct(quantile_disc(cast({c} as double), {_SHARES})) q_{c}" for c in [*_MI_COLUMNS, "target"]
) + " from xf)"
_BINNED = _CUTS + ", b as (select " + ", ".join(
    f"len(list_filter(q_{c}, lambda e: e < cast({c} as double))) b_{c}" for c in [*_MI_COLUMNS, "target"]
) + " from xf, cuts)"
_JOINT = "j as (" + union(
    f"select '{c}' \"column\", b_{c} bx, b_target byy, count(*) n from b group by 2, 3" for c in _MI_COLUMNS
) + ")"
_MI = (
    "mi as (select \"column\", sum(p * ln(p / (px * py))) mi from (select \"column\", "
    "cast(n as double) / sum(n) over (partition by \"column\") p, "
    "cast(sum(n) over (partition by \"column\", bx) as double) / sum(n) over (partition by \"column\") px, "
    "cast(sum(n) over (partition by \"column\", byy) as double) / sum(n) over (partition by \"column\") py from j) group by 1)"
)
_SQL["mutual_info"] = orders(f"select \"column\", {r('mi', 2)} mi from mi", X, XF, _BINNED, _JOINT, _MI)
_SQL["mutual_info_select"] = orders(
    f"select \"column\", {r('mi', 2)} mi from mi where mi > (select avg(mi) + 0.5 * stddev_pop(mi) from mi)",
    X, XF, _BINNED, _JOINT, _MI,
)
_SQL["pca_two_columns"] = orders(
    f"select cast(component as integer) component, {r('ratio')} ratio, {r('cumulative')} cumulative, kept from ("
    "select 1 component, big / (big + small) ratio, big / (big + small) cumulative, true kept from l union all "
    "select 2, small / (big + small), 1, big / (big + small) <= 0.999 from l)",
    "m as (select var_samp(number_0) a, var_samp(number_1) c, covar_samp(number_0, number_1) b from f where number_0 is not null)",
    "l as (select (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) big, (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) small from m)",
)

def neighbours_of(name: str) -> str:
    """Every row against every other one, on ranks."""
    rank = "row_number() over (order by {v}, md5(line_id::varchar || '{a}'), line_id) - 1 {a}"
    ranks = f"select line_id, {rank.format(v=name, a='x')}, {rank.format(v='target', a='y')} from f where {name} is not null and target is not null"
    return (
        f"select '{name}' \"column\", greatest(0, p3.psi + pn.psi - m) mi from (select count(*) n, avg(pa.psi + pb.psi) m from ("
        "select least(n - 1, x + d - 1) - greatest(0, x - d + 1) + 1 a, least(n - 1, y + d - 1) - greatest(0, y - d + 1) + 1 b from ("
        f"select p.x, p.y, min(greatest(abs(p.x - q.x), abs(p.y - q.y)), 3)[3] d from ({ranks}) p, ({ranks}) q where p.x <> q.x group by 1, 2), "
        f"(select count(*) n from ({ranks}))) join psi pa on pa.i = a join psi pb on pb.i = b) join psi pn on pn.i = n join psi p3 on p3.i = 3"
    )


_SQL["mutual_info_neighbours"] = orders(
    f"select \"column\", {r('mi', 5)} mi from ({neighbours_of('number_0')} union all {neighbours_of('number_1')})",
    "psi as (select range i, -0.57721566490153286::double + coalesce(sum(1.0::double / range) over "
    "(order by range rows between unbounded preceding and 1 preceding), 0) psi from range(1, (select count(*) + 1 from f)))",
)
# Power steps on the covariance of the vectors; the share of the last one.
_SQL["pca_leading"] = f"""with recursive x as (select vec_id, unnest(range(64)) i, unnest(embedding) v from embeddings),
 m as (select i, avg(v) a from x group by 1), z as (select vec_id, x.i, v - a v from x join m on x.i = m.i),
 c as (select p.i, q.i j, sum(p.v::double * q.v) s from z p join z q on p.vec_id = q.vec_id group by 1, 2),
 l as (select i, list(s order by j) s from c group by 1), w as (select list(s order by i) c from l),
 steps as (select 0 k, list_transform(range(64), lambda i: 1.0::double + i % 7) v, 0::double size from range(1) union all
  select k + 1, list_transform(u, lambda e: e / sqrt(list_dot_product(u, u))), sqrt(list_dot_product(u, u)) from (
   select k, list_transform(c, lambda row: list_dot_product(row, v)) u from steps, w where k < 500))
 select cast(1 as integer) component, {r("size / (select sum(s) from c where i = j)", 5)} ratio from steps where k = 500"""
_SQL["pca_leading_columns"] = orders(
    f"select line_id, {r('abs(cos(t) * x + sin(t) * y)', 4)} c1, {r('abs(cos(t) * y - sin(t) * x)', 4)} c2, {r('big / (a + c)', 4)} ratio from z, l",
    "z as (select line_id, coalesce(number_0 - avg(number_0) over (), 0) x, number_1 - avg(number_1) over () y from f)",
    "m as (select avg(x * x) a, avg(y * y) c, avg(x * y) b from z)",
    "l as (select a, c, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) big, atan2(2 * b, a - c) / 2 t from m)",
)


def scale_by(names: Iterable[str], source: str, stats: str, digits: int = 6, single: bool = False) -> str:
    def value(c: str) -> str:
        return f"cast(cast({c} as float) as double)" if single else f"cast({c} as double)"

    def narrow(e: str) -> str:
        return f"cast({e} as float)" if single else e

    return ", ".join(
        r(
            narrow(
                f"({value(c)} - (select avg({value(c)}) from {stats})) / (select case when max({c}) = min({c}) then 1 "
                f"else stddev_pop({value(c)}) end from {stats})"
            ),
            digits,
        )
        + f" {c}"
        for c in names
    )


_SQL["scale_fit"] = f"select l_orderkey, l_linenumber, {scale_by(LINES, 'lineitem', 'lineitem')} from lineitem"
_SQL["scale_float"] = (
    f"select l_orderkey, l_linenumber, {scale_by(LINES, 'lineitem', 'lineitem', 3, True)} from lineitem"
)
_SQL["scale_replay"] = orders(
    f"select line_id, {scale_by(FILLABLE, 'te', 'tr')} from te",
    f"g as (select {filled()} from f)",
    f"tr as (select * from g where not ({IN_TEST}))", f"te as (select * from g where {IN_TEST})",
)
_SQL["scale_independent"] = orders(
    f"select line_id, {scale_by(['number_1', 'number_2'], 'tr', 'tr')}, 'train' part from tr union all "
    f"select line_id, {scale_by(['number_1', 'number_2'], 'te', 'te')}, 'test' part from te",
    _TRAIN,
)
_SQL["nonconst_by_prefix"] = orders(
    "select step, cast("
    + " + ".join(f"cast(count(distinct {c}) <> 1 as integer)" for c in COLUMNS)
    + " as bigint) n_nonconstant from g, (select unnest(range(1, 10)) i) s, (select count(*) total from f) t, "
    "lateral (select total * i // 10 step) where at_row <= step group by step",
    "g as (select *, row_number() over (order by line_id) at_row from f)",
)

# ---------------------------------------------------------------- splits

_SQL["split_hash"] = orders(f"select line_id, {IN_TEST} is_test from f")
_SQL["split_ordered"] = orders(
    "select line_id, row_number() over (order by line_id) > floor(count(*) over () * 0.75) is_test from f"
)
_SQL["kfold_assign"] = orders(
    f"select line_id, cast(({FOLD_HASH}) * 3 // 4294967296 as integer) fold from f"
)
_SQL["ridge_grid"] = orders(
    f"select alpha, fold, n \"rows\", {r('(syy - 2 * b * sxy - 2 * a * sy + b * b * sxx + 2 * a * b * sx + n * a * a) / n')} mse, "
    f"{r('b')} weight, {r('a')} intercept from (select *, (ty - b * tx) / m a from (select *, "
    "(txy - tx * ty / m) / (txx - tx * tx / m + alpha) b from cells))",
    f"folds as (select cast(({FOLD_HASH}) * 3 // 4294967296 as integer) fold, count(*) n, sum(number_1) sx, sum(target) sy, "
    "sum(number_1 * number_1) sxx, sum(number_1 * target) sxy, sum(target * target) syy from f group by 1), "
    "cells as (select alpha, p.*, t.n - p.n m, t.sx - p.sx tx, t.sy - p.sy ty, t.sxx - p.sxx txx, t.sxy - p.sxy txy from folds p, "
    "(select sum(n) n, sum(sx) sx, sum(sy) sy, sum(sxx) sxx, sum(sxy) sxy from folds) t, "
    "(select cast(unnest([0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]) as double) alpha))",
)
_SQL["ridge_grid_wide"] = f"select vec_id line_id, true is_finite, true best_alpha from embeddings where {HASH.format(k='vec_id')} < 1073741824"
_SQL["stacked_out_of_fold"] = orders(
    f"select line_id, cast(({FOLD_HASH}) * 3 // 4294967296 as integer) fold, true is_finite, true no_worse from f where not ({IN_TEST})"
)
_SQL["sample_size_plan"] = (
    "with s as (select event_type model, count(*) n, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 secs, "
    "count(distinct user_id) users from events group by 1), "
    "v as (select *, n / secs fit, users / secs pred from s) "
    f"select model, n \"rows\", {r('fit')} fit_rows_s, greatest(cast(trunc(least((secs * 12 - 3 * n / fit) / 14 / "
    "(0.75::double / fit + 0.25::double / pred), n)) as bigint), 0) sample_rows from v"
)

# ---------------------------------------------------------------- model choice as rules

_BOARD = "board as (" + union(
    f"select '{n}' model, -(var_pop(target) - pow(covar_pop({n}, target), 2) / nullif(var_pop({n}), 0)) score from xf"
    for n in _MI_COLUMNS
) + ")"
_SQL["select_above_mean"] = orders(
    f"select model, {r('score', 4)} score, model = (select model from board order by score desc nulls last, model limit 1) "
    "is_winner from board where score >= (select avg(score) from board)",
    X, XF, _BOARD,
)
_SQL["first_best_rule"] = orders(
    "select cast(depth as integer) depth, score from (select *, sum(worse) over (order by depth) drops from ("
    "select depth, score, case when lag(score) over (order by depth) > score then 1 else 0 end worse from sc)) "
    "where drops = 0 order by depth desc limit 1",
    "g as (select depth, cast(id_0 as bigint) % depth slot, count(*) n, sum(target) s, sum(target * target) ss "
    "from f, (select unnest(range(2, 16)) depth) d group by 1, 2)",
    "sc as (select depth, round(-sum(ss - s * s / n) / sum(n), 4) score from g group by 1)",
)

# ---------------------------------------------------------------- scores

_GAP = "(target - round(target)) * (target - round(target))"
_SQL["score_rmse"] = orders(f"select {r(f'sqrt(avg({_GAP}))')} rmse from f")
_SQL["score_neg_mse"] = orders(f"select {r(f'-avg({_GAP})')} neg_mse from f")
_SQL["score_rmse_two_col"] = orders(f"select {r(f'sqrt(avg({_GAP}) / 2)')} rmse_two_col from f")
_SQL["align_prediction"] = orders("select line_id, target, round(target) + cast(0 as double) prediction from f")
_SQL["score_auc"] = (
    "with g as (select value, sum(cast(event_type = 'click' as int)) p, sum(cast(event_type <> 'click' as int)) n "
    "from events group by 1), w as (select *, sum(n) over (order by value) - n below from g) "
    f"select {r('sum(p * (below + n / 2)) / (sum(p) * sum(n))', 9)} auc from w"
)
_SQL["score_auc_distributed"] = _SQL["score_auc"]
_SQL["score_auc_labels"] = (
    "select " + r(
        "(count(*) filter (event_type = 'click' and value > 10) / count(*) filter (event_type = 'click')"
        " + count(*) filter (event_type <> 'click' and value <= 10) / count(*) filter (event_type <> 'click')) / 2", 9
    ) + " auc from events"
)

# ---------------------------------------------------------------- whole plans

_SLICE = [*NUMBERS, "number_const", *DATES]
_SQL["prep_slice"] = orders(f"select line_id, {', '.join(_SLICE)} from xf", X, XF)

WEEKDAYS = [str(i) for i in range(7)]
MONTHS = [str(i) for i in range(1, 13)]
HOURS = ["0", "1", "4", "7", "10", "13", "16", "19", "22"]


def plain(names: Iterable[str]) -> list[tuple[str, str]]:
    return [(n, n) for n in names]


# encode, drop the constant, fill, scale
_ONEHOT_RAW = [
    *onehots("number_1", SEVENS), *onehots("number_2", ODDS), *onehots("string_0", PRIORITIES, True),
    *onehots("string_1", STATES, True), *onehots("number_weekday_datetime_0", WEEKDAYS),
    *onehots("number_month_datetime_0", MONTHS), *onehots("number_hour_datetime_0", HOURS),
]
_FILLED_NUMBERS = [(n, f"coalesce({n}, -1)") for n in [*NUMBERS, "number_null", *DATES]]
_SQL["prep_onehot"] = orders(scaled([*_FILLED_NUMBERS, *_ONEHOT_RAW], "x"), X)
_SQL["prep_onehot_nan"] = _SQL["prep_onehot"]

# fill, encode with -1 as a value, drop the constant, scale
_ONEHOT_FILLED = [
    *onehots("number_1", SEVENS), *onehots("number_2", ODDS), *onehots("string_0", _FILLED_PRIORITIES, True),
    *onehots("string_1", STATES, True), *onehots("number_weekday_datetime_0", ["-1", *WEEKDAYS]),
    *onehots("number_month_datetime_0", ["-1", *MONTHS]), *onehots("number_hour_datetime_0", ["-1", *HOURS]),
]
_SQL["prep_fill_first"] = orders(scaled([*plain(_SLICE), *_ONEHOT_FILLED], "xf"), X, XF)
_SQL["run_metrics"] = orders(
    f"select count(*) \"rows\", cast({len(COLUMNS) + 1 + len(DATES)} as bigint) \"columns\", "
    "cast(count(distinct number_null) as bigint) constant_columns, "
    f"cast(7 as bigint) encoded_columns, cast({len(_ONEHOT_FILLED)} as bigint) onehot_columns, "
    f"cast({len(_SLICE)} as bigint) number_columns, cast({len(_SLICE) + len(_ONEHOT_FILLED)} as bigint) used_columns, "
    "'orders_features' dataset, 3 steps, true timed from xf",
    X, XF,
)

# fill, encode within 40 columns, drop the later of each correlated pair
_BUDGET = [
    *onehots("string_1", STATES, True), *onehots("string_0", _FILLED_PRIORITIES, True), *onehots("number_1", SEVENS),
]
_BUDGET_NUMBERS = [
    "number_0", "number_1", "number_const", "number_weekday_datetime_0", "number_month_datetime_0",
    "number_day_datetime_0", "number_hour_datetime_0",
]
_SQL["prep_budget"] = orders(f"select line_id, target, {', '.join(_BUDGET_NUMBERS)}, {block(_BUDGET)} from xf", X, XF)

_FREQ_NUMBERS = [*NUMBERS, "number_const", *[part_name(p) for p in FIVE]]
_XE = (
    f"xe as (select line_id, target, {', '.join(f'coalesce({c}, -1) {c}' for c in FILLABLE)}, "
    f"{', '.join(f"coalesce({c}, '-1') {c}" for c in _TEXT)}, {parts(FIVE)} "
    f"from (select *, coalesce({PARSE}, {EMPTY}) t from f))"
)
_columns, _joins = coded(_TEXT, "xe")
_SQL["prep_freq"] = orders(
    f"select line_id, target, {', '.join(_FREQ_NUMBERS)}, {_columns} from xe {_joins}", _XE, frequencies(_TEXT, "xe")
)
_columns, _joins = coded(_TEXT, "te")
_SQL["replay_freq"] = orders(
    f"select line_id, {', '.join(_FREQ_NUMBERS)}, {_columns} from te {_joins}", _XE,
    f"tr as (select * from xe where not ({IN_TEST})), te as (select * from xe where {IN_TEST})", frequencies(_TEXT, "tr"),
)

_SQL["select_by_samples"] = "select true winner_on_board, true winner_is_best, true mean_is_out, true learned"
_SQL["score_pipeline"] = _SQL["predict_label"]
_SQL["row_prefix"] = _SQL["scan_limit"]
