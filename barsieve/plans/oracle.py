"""SQL counterparts of the registered queries, written independently for DuckDB on the same tables."""

from __future__ import annotations

# Texts of the results, written out.
ALL_RECORDS = "**ALL RECORDS**"
SAME, MISSING = "both have as many rows", "rows that the target lacks: "
SOURCE, TARGET = "events", "events_checked"
DIRTY_KEYS = ["symbol", "d"]

BARS = """
days as (
  select n_name as symbol, case when o_orderstatus = 'F' then 'EQ' else 'BE' end as series,
    cast(o_orderdate as date) as generated_date,
    arg_min(o_totalprice, o_orderkey) as open, max(o_totalprice) as high, min(o_totalprice) as low,
    arg_max(o_totalprice, o_orderkey) as close, count(*) as totaltrades,
    cast(sum(o_orderkey % 9000) as bigint) as tottrdqty,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) as tottrdval
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  group by 1, 2, 3),
bars as (
  select symbol, series, open, high, low, close, close as last,
    case when day(generated_date) = 13 then 0.0
         else lag(close) over (partition by symbol, series order by generated_date) end as prevclose,
    tottrdqty, tottrdval, generated_date, totaltrades, 'IN' || symbol as isin
  from days)"""

DIRTY = """
dirty as (
  select event_id,
    case when event_id % 23 = 0 then null when event_id % 31 = 0 then 'M&M'
         else 'U' || cast(user_id as varchar) end as symbol,
    case when event_id % 13 = 0 then replace(cast(value as varchar), '.', ',') when event_id % 17 = 0 then null
         when event_id % 29 = 0 then cast(cast(floor(value) as bigint) as varchar)
         else cast(value as varchar) end as px,
    case when event_id % 19 = 0 then null when event_id % 11 = 0 then 'bad-date'
         else strftime(ts, '%d-%b-%Y') end as d
  from events),
keyed as (select * from dirty where symbol is not null and d is not null),
numbered as (
  select *, row_number() over (partition by symbol, d order by event_id, px nulls first) as rn from keyed)"""

HOT_KEY = """
hot_rows as (
  select *, row_number() over (partition by k order by v nulls first, cast(v as varchar)) as n from (
    select case when event_id % 10 < 7 then 'hot' when event_id % 10 = 7 then null else cast(user_id as varchar) end as k,
      case event_id % 5 when 0 then cast('-0.0' as double) when 1 then cast(0 as double) when 2 then null else value end as v
    from events)
  where k is not null)"""

PROPS = """
props_view as (
  select event_id, case when event_id % 10 = 0 then null else props end as props, event_type from events)"""

NUMBERS = """
numbers as (
  select event_id, case when event_id % 7 = 0 then lpad(cast(event_id as varchar), 21, '0')
    when event_id % 5 = 0 then lpad(cast(event_id as varchar), 12, '0')
    else cast(event_id as varchar) end as num
  from events)"""

# parts with the declared type that the metadata view gives them, and what the checks make of it
METADATA = """
declared as (
  select p_partkey, p_name, p_size, p_type,
    case p_partkey % 13
      when 0 then 'varchar(' || p_size || ')' when 1 then 'DECIMAL(' || p_size || ', 2)'
      when 2 then 'Number(' || p_size || ')' when 3 then ' DATE ' when 4 then 'DATETIME'
      when 5 then 'BIGINT' when 6 then 'INT' when 7 then 'INTEGER' when 8 then 'TINYINT'
      when 9 then 'SMALLINT' when 10 then 'FLOAT' when 11 then 'VARCHAR'
      else 'CHAR(' || p_size || ')' end as declared
  from part)"""


def _text(columns: list[str]) -> str:
    """Row text as the report prints it."""
    pairs = " || ', ' || ".join(f"'{c} -> ' || coalesce(cast({c} as varchar), 'null')" for c in columns)
    return f"'{{' || {pairs} || '}}'"


def _report(kind: str, keys: list[str], column: str, text: str, rest: str, column_is_sql: bool = False) -> str:
    shown = column if column_is_sql else f"'{column}'"
    return (
        f"select '{kind}' as \"Validation Type\", '{SOURCE}' as \"Source Table Name\", "
        f"'{TARGET}' as \"Target Table Name\", '{', '.join(keys)}' as \"Primary Key Field(s)\", "
        f"{shown} as \"Validation Column\", {text} as \"Unmatched Records\" {rest}"
    )


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


ALL_DIRTY = ["event_id", "symbol", "px", "d"]

NULL_KEY = _report(
    "Primary Key - Null Data Validation",
    DIRTY_KEYS,
    "case when symbol is null then 'symbol' else 'd' end",
    _text(ALL_DIRTY),
    "from dirty where symbol is null or d is null",
    column_is_sql=True,
)
DUPLICATE_KEY = _report(
    "Primary Key - Duplicate Data Validation", DIRTY_KEYS, "symbol, d", _text(ALL_DIRTY), "from numbered where rn > 1"
)

# the conditions under which a value breaks a rule
BAD_DATE = "try_strptime(d, '%d-%b-%Y') is null"
BAD_STRING = "not regexp_matches({c}, '^[a-zA-Z0-9 ]*$')"
BAD_INTEGER = "not regexp_matches({c}, '^[+-]?[0-9]+$')"
BAD_DECIMAL = "not regexp_matches({c}, '^[-+]?[0-9]*[.][0-9]+$')"


def _bad_precision(c: str, precision: int, scale: int) -> str:
    parts = f"string_split({c}, '.')"
    return (
        f"({c} is not null and case len({parts}) when 1 then length({c}) > {precision} "
        f"when 2 then length({parts}[1]) + length({parts}[2]) > {precision} or length({parts}[2]) > {scale} "
        f"else true end)"
    )


def _rule(kind: str, view: str, cte: str, keys: list[str], column: str, condition: str) -> str:
    shown = keys if column in keys else [*keys, column]
    return _with(cte) + _report(kind, keys, column, _text(shown), f"from {view} where {condition.format(c=column)}")


def _branch(kind: str, column: str, condition: str) -> str:
    shown = DIRTY_KEYS if column in DIRTY_KEYS else [*DIRTY_KEYS, column]
    return _report(kind, DIRTY_KEYS, column, _text(shown), f"from keyed where {condition.format(c=column)}")


def _whole(kind: str, column: str) -> str:
    return _report(kind, DIRTY_KEYS, column, f"'{ALL_RECORDS}'", "")


BROKEN = {
    "event_id": f"length(cast(event_id as varchar)) > 19 or {BAD_INTEGER.format(c='cast(event_id as varchar)')}",
    "symbol": f"length(symbol) > 3 or {BAD_STRING.format(c='symbol')}",
    "px": f"coalesce({_bad_precision('px', 5, 2)} or {BAD_DECIMAL.format(c='px')}, false)",
    "d": BAD_DATE,
}

REPORT_PARTS = [
    NULL_KEY,
    DUPLICATE_KEY,
    _branch("DataLength - BIGINT Validation", "event_id", "length(cast(event_id as varchar)) > 19"),
    _branch("DataType - BIGINT Validation", "event_id", BAD_INTEGER.format(c="cast(event_id as varchar)")),
    _branch("DataLength - VARCHAR(3) Validation", "symbol", "length(symbol) > 3"),
    _branch("DataType - VARCHAR(3) Validation", "symbol", BAD_STRING),
    _branch("DataLength - DECIMAL(5,2) Validation", "px", _bad_precision("px", 5, 2)),
    _branch("DataType - DECIMAL(5,2) Validation", "px", BAD_DECIMAL),
    _whole("DataLength - DATE Validation", "d"),
]
BAD_DATES = _branch("Date Format Validation", "d", BAD_DATE)

#: Rows of even events come first, those of odd ones in a second delivery; checks of a whole column are reported for both.
TWO_DELIVERIES = _with(DIRTY) + "\nunion all ".join(
    [
        *[p for p in REPORT_PARTS if p != DUPLICATE_KEY],
        *[p for p in REPORT_PARTS if ALL_RECORDS in p],
        BAD_DATES,
        DUPLICATE_KEY.replace(
            "from numbered where rn > 1",
            "from (select *, row_number() over (partition by symbol, d order by event_id % 2, event_id, px nulls first)"
            " as turn from keyed) where turn > 1",
        ),
    ]
)
FAILED_REPORT = _with(DIRTY) + "\nunion all ".join([*REPORT_PARTS, BAD_DATES])

UNSUPPORTED_REPORT = _with(DIRTY) + "\nunion all ".join(
    [
        _report(
            "Primary Key - Null Data Validation", ["symbol"], "symbol", _text(ALL_DIRTY),
            "from dirty where symbol is null",
        ),
        _report(
            "Primary Key - Duplicate Data Validation", ["symbol"], "symbol", _text(ALL_DIRTY),
            "from (select *, row_number() over (partition by symbol order by event_id, px nulls first, d nulls first)"
            " as n from dirty where symbol is not null) where n > 1",
        ),
        _report(
            "DataType - SMALLINT Validation", ["symbol"], "event_id", _text(["symbol", "event_id"]),
            f"from dirty where symbol is not null and {BAD_INTEGER.format(c='cast(event_id as varchar)')}",
        ),
        _report("DataLength - SMALLINT Validation", ["symbol"], "event_id", f"'{ALL_RECORDS}'", ""),
        _report(
            "DataLength - VARCHAR(3) Validation", ["symbol"], "symbol", _text(["symbol"]),
            "from dirty where length(symbol) > 3",
        ),
        _report(
            "DataType - VARCHAR(3) Validation", ["symbol"], "symbol", _text(["symbol"]),
            f"from dirty where {BAD_STRING.format(c='symbol')}",
        ),
        _report("DataLength - DATETIME Validation", ["symbol"], "px", f"'{ALL_RECORDS}'", ""),
        _report("DataLength - DATETIME Validation", ["symbol"], "px", f"'{ALL_RECORDS}'", ""),
        _report("DataLength - DATE Validation", ["symbol"], "d", f"'{ALL_RECORDS}'", ""),
        _report("Date Format Validation - New Format", ["symbol"], "d", f"'{ALL_RECORDS}'", ""),
    ]
)

PASSED_STRICT = _with(DIRTY) + (
    "select event_id, symbol, px, d from numbered where rn = 1 and "
    + " and ".join(f"not ({condition})" for condition in BROKEN.values())
)


def _gold(columns: str, source: str, cte: str, date: str, on_zero: str, close_frame: str = "") -> str:
    month = f"partition by symbol, year({date}), month({date}) order by {date}"
    ratio = f"(close - prevclose) * 100 / prevclose"
    returns = (
        f"case when prevclose = 0 then 0.0 else {ratio} end"
        if on_zero == "zero"
        else f"case when prevclose = 0 then null else {ratio} end"
    )
    return (
        _with(cte)
        + f"select {columns}, low - high as spread_high_low, close - open as spread_open_close, "
        f"{returns} as returns_perc, first_value(open) over ({month}) as open_monthly, "
        f"last_value(close) over ({month} {close_frame}) as close_monthly, "
        f"max(high) over ({month}) as high_monthly, min(low) over ({month}) as low_monthly from {source}"
    )


WHOLE_MONTH = "rows between unbounded preceding and unbounded following"
BAR_COLUMNS = (
    "symbol, series, open, high, low, close, last, prevclose, tottrdqty, tottrdval, generated_date, totaltrades, isin"
)

# several rows per day: the first open and last close of a day are those of its lowest and highest event id
TICKS = """
ticks as (
  select event_type as symbol, 'EQ' as series, value as open, value + 1 as high, value - 1 as low,
    value * 2 as close, case when event_id % 10 = 0 then 0.0 else value end as prevclose,
    cast(ts as date) as generated_date, event_id
  from events),
per_day as (
  select symbol, generated_date, arg_min(open, event_id) as o, arg_max(close, event_id) as c,
    max(high) as h, min(low) as l
  from ticks group by all),
so_far as (
  select symbol, generated_date,
    first_value(o) over (partition by symbol, year(generated_date), month(generated_date) order by generated_date) as o,
    last_value(c) over (partition by symbol, year(generated_date), month(generated_date) order by generated_date {frame}) as c,
    max(h) over (partition by symbol, year(generated_date), month(generated_date) order by generated_date) as h,
    min(l) over (partition by symbol, year(generated_date), month(generated_date) order by generated_date) as l
  from per_day)"""


def _ticks(frame: str = "") -> str:
    return _with(TICKS.format(frame=frame)) + """
select t.*, low - high as spread_high_low, close - open as spread_open_close,
  case when prevclose = 0 then 0.0 else (close - prevclose) * 100 / prevclose end as returns_perc,
  s.o as open_monthly, s.c as close_monthly, s.h as high_monthly, s.l as low_monthly
from ticks t join so_far s on t.symbol = s.symbol and t.generated_date = s.generated_date"""


EVENT_ROWS = "select event_id, user_id, event_type, value from events"

CENTS = "cast(floor(value * 100) as bigint) % 4294967296"
SNAPSHOTS = f"""
  event_id % 65536 as "Transcode", 4294967295 - event_id % 4294967296 as "Timestamp", 78 as "Message_Length",
  user_id % 65536 as "Security_Token", {CENTS} as "Last_Traded_Price", event_id % 1000 as "Best_Buy_Quantity",
  ({CENTS} + 1) % 4294967296 as "Best_Buy_Price", event_id % 777 as "Best_Sell_Quantity",
  ({CENTS} + 2) % 4294967296 as "Best_Sell_Price", (event_id * 7919) % 4294967296 as "Total_Traded_Quantity",
  ({CENTS} + 3) % 4294967296 as "Average_Traded_Price", ({CENTS} + 4) % 4294967296 as "Interval_Open_Price",
  ({CENTS} + 5) % 4294967296 as "Interval_High_Price", ({CENTS} + 6) % 4294967296 as "Interval_Low_Price",
  ({CENTS} + 7) % 4294967296 as "Interval_Close_Price", event_id % 100 as "Interval_Total_Traded_Quantity"
"""
SNAPSHOT_SMALL = ["Transcode", "Message_Length", "Security_Token"]


def _snapshots(extra: str = "") -> str:
    narrow = ", ".join(f'cast("{c}" as integer) as "{c}"' for c in SNAPSHOT_SMALL)
    return f"select * replace ({narrow}) from (select {SNAPSHOTS}{extra} from events)"


def _snapshot_report() -> str:
    """Prices of more than three digits in the columns declared as TINYINT, of the records in market files."""
    rows = _snapshots() + " where \"Transcode\" % 2 = 0"
    long = [c for c in ("Best_Buy_Quantity", "Best_Buy_Price", "Best_Sell_Quantity", "Best_Sell_Price")]
    parts = []
    for c in long:
        text = f"""'{{Timestamp -> ' || "Timestamp" || ', Security_Token -> ' || "Security_Token" || ', {c} -> ' || "{c}" || '}}'"""
        parts.append(
            "select 'DataLength - TINYINT Validation' as \"Validation Type\", 'staged snapshots' as \"Source Table Name\", "
            "'snapshots' as \"Target Table Name\", 'Timestamp, Security_Token' as \"Primary Key Field(s)\", "
            f"'{c}' as \"Validation Column\", {text} as \"Unmatched Records\" from snapshots "
            f'where length(cast("{c}" as varchar)) > 3'
        )
    return f"with snapshots as ({rows})\n" + "\nunion all ".join(parts)


SPINE = """
spine as (
  select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as trade_date
  from (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders))"""

SYMBOL_DAYS = """
spans as (
  select symbol, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as trade_date
  from (select symbol, cast(min(generated_date) as timestamp) as lo, cast(max(generated_date) as timestamp) as hi
        from bars group by symbol))"""


def _constant(column: str, value: str) -> str:
    return (
        f"select '{column}' as column_name, cast(min({value}) as varchar) as min_value, "
        f"cast(max({value}) as varchar) as max_value, min({value}) is not distinct from max({value}) as is_constant "
        "from dirty"
    )


def all_sql() -> dict[str, str]:
    duplicate = _with(DIRTY) + DUPLICATE_KEY
    gold_full = _gold(BAR_COLUMNS, "bars where series = 'EQ'", BARS, "generated_date", "zero", WHOLE_MONTH)
    staged = "symbol, series, open, high, low, close, last, prevclose, tottrdqty, tottrdval"
    renamed = (
        ", renamed as (select * replace (symbol || '-' || series as symbol), generated_date as \"timestamp\" from bars)"
    )
    props = ["event_id"]
    missing = _with(BARS, SYMBOL_DAYS) + (
        "select symbol, trade_date from spans s where not exists (select 1 from bars b where b.symbol = s.symbol "
        "and b.generated_date = s.trade_date and b.series = 'EQ')"
    )
    return {
        "gold_monthly": _gold(BAR_COLUMNS, "bars where series = 'EQ'", BARS, "generated_date", "zero")
        + " order by generated_date",
        "gold_month_close_full": gold_full,
        "gold_returns_null_on_zero": _gold(
            BAR_COLUMNS.replace("generated_date", '"timestamp"'), "renamed", BARS + renamed, '"timestamp"', "null"
        ),
        "gold_ticks": _ticks(),
        "gold_ticks_full": _ticks(WHOLE_MONTH),
        "gold_catalog": _gold(BAR_COLUMNS, "bars where series = 'EQ'", BARS, "generated_date", "zero"),
        "rule_null_key": _with(DIRTY) + NULL_KEY,
        "rule_duplicate_key": duplicate,
        "rule_duplicate_hot_key": _with(HOT_KEY)
        + _report(
            "Primary Key - Duplicate Data Validation", ["k"], "k", _text(["k", "v"]), "from hot_rows where n > 1"
        ),
        "rule_duplicate_copies": _with(DIRTY)
        + _report(
            "Primary Key - Duplicate Data Validation", ["symbol"], "symbol", _text(["symbol", "d"]),
            "from (select symbol, d, row_number() over (partition by symbol order by d nulls first) as n "
            "from dirty where symbol is not null) where n > 1",
        ),
        "rule_type_date": _rule("Date Format Validation", "keyed", DIRTY, DIRTY_KEYS, "d", BAD_DATE),
        "rule_type_date_optional": _rule(
            "Date Format Validation", "dirty", DIRTY, ["event_id"], "d", BAD_DATE + " and d is not null"
        ),
        "rule_type_date_mandatory": _rule("Date Format Validation", "dirty", DIRTY, ["event_id"], "d", BAD_DATE),
        "rule_type_string": _rule("DataType - VARCHAR(8) Validation", "props_view", PROPS, props, "props", BAD_STRING),
        "rule_type_string_mandatory": _rule(
            "DataType - STRING Validation", "props_view", PROPS, props, "props", BAD_STRING + " or props is null"
        ),
        "rule_type_string_symbol": _rule(
            "DataType - CHAR(3) Validation", "keyed", DIRTY, DIRTY_KEYS, "symbol", BAD_STRING
        ),
        "rule_type_integer": _rule("DataType - INTEGER Validation", "keyed", DIRTY, DIRTY_KEYS, "px", BAD_INTEGER),
        "rule_type_integer_mandatory": _rule(
            "DataType - SMALLINT Validation", "keyed", DIRTY, DIRTY_KEYS, "px", BAD_INTEGER + " or px is null"
        ),
        "rule_type_decimal": _rule(
            "DataType - DECIMAL(5,2) Validation", "keyed", DIRTY, DIRTY_KEYS, "px", BAD_DECIMAL
        ),
        "rule_type_decimal_mandatory": _rule(
            "DataType - NUMBER(5,2) Validation", "keyed", DIRTY, DIRTY_KEYS, "px", BAD_DECIMAL + " or px is null"
        ),
        "rule_len_string": _rule(
            "DataLength - VARCHAR(8) Validation", "props_view", PROPS, props, "props", "length({c}) > 8"
        ),
        "rule_len_string_key": _rule(
            "DataLength - VARCHAR(3) Validation", "keyed", DIRTY, DIRTY_KEYS, "symbol", "length({c}) > 3"
        ),
        "rule_len_bigint": _rule("DataLength - BIGINT Validation", "numbers", NUMBERS, props, "num", "length({c}) > 19"),
        "rule_len_int": _rule("DataLength - INT Validation", "numbers", NUMBERS, props, "num", "length({c}) > 10"),
        "rule_len_tinyint": _rule(
            "DataLength - TINYINT Validation", "numbers", NUMBERS, props, "num", "length({c}) > 3"
        ),
        "rule_len_decimal": _rule(
            "DataLength - DECIMAL(4,1) Validation", "keyed", DIRTY, DIRTY_KEYS, "px", _bad_precision("px", 4, 1)
        ),
        "rule_len_decimal_whole": _rule(
            "DataLength - NUMBER(3) Validation", "keyed", DIRTY, DIRTY_KEYS, "px", _bad_precision("px", 3, 0)
        ),
        "rule_unsupported": UNSUPPORTED_REPORT,
        "failed_report": FAILED_REPORT,
        "failed_report_other_order": FAILED_REPORT,
        "clean_report": _report("", ["o_orderkey"], "", "''", "from orders where false"),
        "sink_roundtrip": FAILED_REPORT,
        "incremental_check": FAILED_REPORT,
        "incremental_duplicates": TWO_DELIVERIES,
        "passed_null_key": _with(DIRTY) + "select * from keyed",
        "passed_strict": PASSED_STRICT,
        "except_all_surplus": _with(DIRTY)
        + "select symbol, d from dirty except all select distinct symbol, d from dirty",
        "dedup_keep_first": _with(DIRTY)
        + "select event_id, symbol, px, d from (select *, row_number() over (partition by symbol, d "
        "order by event_id, px nulls first) as n from dirty) where n = 1",
        "profile_counts": _with(DIRTY) + "select count(*) as n_rows, cast(7 as bigint) as n_columns from dirty",
        "profile_constant_columns": _with(DIRTY)
        + " union all ".join(
            [
                *[_constant(c, c) for c in ALL_DIRTY],
                _constant("same", "'x'"),
                _constant("same_or_null", "case when event_id % 2 = 0 then 'y' end"),
                _constant("nothing", "cast(null as varchar)"),
            ]
        ),
        "filter_min_quantity": _with(BARS) + f"select {BAR_COLUMNS} from bars where tottrdqty >= 5000",
        "bars_projection": _with(BARS)
        + "select symbol as SYMBOL, series as SERIES, open as OPEN, high as HIGH, low as LOW, close as CLOSE, "
        "last as LAST, prevclose as PREVCLOSE, cast(tottrdqty as varchar) as TOTTRDQTY, tottrdval as TOTTRDVAL, "
        "upper(strftime(generated_date, '%d-%b-%Y')) as generated_date, "
        "cast(totaltrades as varchar) as TOTALTRADES, isin as ISIN from bars",
        "silver_typed": _with(DIRTY)
        + "select event_id, symbol, try_cast(px as double) as px, "
        "cast(try_strptime(d, '%d-%b-%Y') as date) as d from keyed",
        "silver_bars": _with(BARS) + f"select {BAR_COLUMNS} from bars",
        "quality_job": _with(BARS) + f"select {BAR_COLUMNS} from bars",
        "bhav_unzip_entries": _with(BARS) + f"select {staged}, generated_date, totaltrades, isin from bars",
        "bhav_unzip": _with(BARS) + f"select {staged}, generated_date, totaltrades, isin from bars",
        "bhav_stage_same_entry": _with(BARS) + f"select {staged}, generated_date, totaltrades, isin from bars",
        "bhav_stage_csv": _with(BARS) + f"select {staged}, generated_date, totaltrades, isin from bars",
        "metadata_spec": _with(METADATA)
        + """
select 'c' || p_partkey as column_name, declared,
  case p_partkey % 13 when 3 then 'date' when 4 then 'unsupported' when 0 then 'string' when 11 then 'string'
    when 12 then 'string' when 1 then 'decimal' when 2 then 'decimal' when 10 then 'decimal'
    else 'integer' end as type_check,
  case p_partkey % 13 when 0 then 'string' when 11 then 'string' when 12 then 'string' when 5 then 'bigint'
    when 6 then 'int' when 7 then 'int' when 8 then 'tinyint' when 1 then 'decimal' when 2 then 'decimal'
    when 10 then 'decimal' else 'unsupported' end as length_check,
  case p_partkey % 13 when 0 then p_size when 12 then p_size when 5 then 19 when 6 then 10 when 7 then 10
    when 8 then 3 end as max_length,
  case when p_partkey % 13 in (1, 2) then p_size end as precision,
  case p_partkey % 13 when 1 then 2 when 2 then 0 end as scale,
  case when p_partkey % 13 = 3 then
    case p_partkey % 4 when 0 then 'dd-MMM-yyyy' when 1 then 'yyyy-MM-dd' end end as date_pattern,
  p_size < 10 as is_key, p_type = 'ECONOMY' as mandatory
from declared""",
        "metadata_keys": "select 'c' || p_partkey as column_name from part where p_size < 10",
        "metadata_mandatory": "select 'c' || p_partkey as column_name from part where p_type = 'ECONOMY'",
        "date_spine": _with(SPINE) + "select trade_date from spine",
        "expected_files": _with(SPINE)
        + """
select trade_date, strftime(trade_date, '%B%d%Y') as day_folder,
  'cm' || strftime(trade_date, '%d') || upper(strftime(trade_date, '%b')) || strftime(trade_date, '%Y')
    || 'bhav.csv.zip' as file_name,
  'archive/' || strftime(trade_date, '%Y') || '/' || upper(strftime(trade_date, '%b')) || '/cm'
    || strftime(trade_date, '%d') || upper(strftime(trade_date, '%b')) || strftime(trade_date, '%Y')
    || 'bhav.csv.zip' as location
from spine""",
        "missing_dates": missing,
        "missing_from_listing": missing,
        "available_dates": _with(BARS, SYMBOL_DAYS)
        + "select symbol, trade_date from spans s where exists (select 1 from bars b where b.symbol = s.symbol "
        "and b.generated_date = s.trade_date and b.series = 'EQ')",
        "ingest_audit": "select cast(ts as date) as trade_date, event_type as source_file, count(*) as n_records, "
        "cast(grouping(cast(ts as date)) * 2 + grouping(event_type) as integer) as total_level "
        "from events group by rollup (cast(ts as date), event_type)",
        "ingest_audit_files": "select trade_date, source_file, count(*) as n_records, "
        "cast(grouping(trade_date) * 2 + grouping(source_file) as integer) as total_level from "
        "(select cast(ts as date) as trade_date, coalesce(event_type, 'none') || '.csv' as source_file from events) "
        "group by rollup (trade_date, source_file)",
        "files_per_day": "select trade_date, count(*) as n_files, count(*) filter (user_id % 2 = 0) as n_market_files "
        "from (select distinct cast(ts as date) as trade_date, user_id from events) group by 1",
        "reconcile_counts": _with(BARS)
        + f"select n as source_rows, m as target_rows, n - m as missing_rows, case when n = m then '{SAME}' "
        f"else '{MISSING}' || (n - m) end as status from (select count(*) as n, "
        "count(*) filter (series = 'EQ') as m from bars)",
        "reconcile_tables": _with(BARS)
        + f"select n as source_rows, m as target_rows, n - m as missing_rows, case when n = m then '{SAME}' "
        f"else '{MISSING}' || (n - m) end as status from (select count(*) as n, "
        "count(*) filter (series = 'EQ') as m from bars)",
        "reconcile_equal": "select count(*) as source_rows, count(*) as target_rows, cast(0 as bigint) as missing_rows, "
        f"'{SAME}' as status from orders",
        "scan_csv_flat": EVENT_ROWS,
        "scan_csv_nested": EVENT_ROWS,
        "scan_csv_mixed": EVENT_ROWS,
        "scan_csv_infer": "select event_id, user_id, event_type, value, 'double' as value_family, "
        "'string' as event_type_family from events",
        "incremental_ingest": EVENT_ROWS,
        "mkt_decode": _snapshots(", cast(ts as date) as trade_date"),
        "mkt_decode_stream": _snapshots(", cast(ts as date) as trade_date"),
        "mkt_decode_named": _snapshots(", cast(ts as date) as trade_date") + " where \"Transcode\" % 2 = 0",
        "mkt_stage_csv": _snapshots(),
        "quality_job_snapshots": _snapshot_report(),
    }
