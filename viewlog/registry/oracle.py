"""The SQL each registered query is compared with, for DuckDB over the same tables.

Every statement starts from the same chain of common table expressions: the log adapter over
``events``, the dimensions with their keys, the facts and the marts.
"""

from __future__ import annotations

from viewlog import schema
from viewlog.registry.frames import AS_OF, LOADED_BEFORE, ONE_CONTRACT, ONE_DAY, ORDERS_AS_OF, ORDERS_DAYS, RANGE, SHORT
from viewlog.sources.adapter import SHIFT_DAYS

_APPS = ", ".join(f"'{app}'" for app in schema.KNOWN_APPS)


def _category(english: bool = False, app: str = "AppName") -> str:
    whens = "\n".join(
        f"      WHEN {app} IN ({', '.join(repr(a) for a in c.apps)}) THEN '{c.english if english else c.label}'"
        for c in schema.CATEGORIES
    )
    other = schema.UNKNOWN.english if english else schema.UNKNOWN.label
    return f"CASE\n{whens}\n      ELSE '{other}' END"


def _wide(kind: str, prefix: str, categories=schema.ALL_CATEGORIES) -> str:
    return ",\n".join(
        f"  CAST(SUM(CASE WHEN {kind} = '{c.label}' THEN coalesce(TotalDuration, 0) ELSE 0 END) AS BIGINT)"
        f" AS {prefix}_{c.suffix}"
        for c in categories
    )


def _sums(prefix: str, categories=schema.CATEGORIES) -> str:
    return ", ".join(f"CAST(SUM({prefix}_{c.suffix}) AS BIGINT) AS {prefix}_{c.suffix}" for c in categories)


def _pivot(english: bool = False) -> str:
    return ",\n".join(
        f"  CAST(coalesce(SUM(CASE WHEN {'EnType' if english else 'Type'} = '{c.english if english else c.label}'"
        f" THEN TotalDuration END), 0) AS BIGINT) AS \"{c.english if english else c.label}\""
        for c in schema.ALL_CATEGORIES
    )


def _best(columns: list[str], labels: list[str]) -> tuple[str, str]:
    top = f"greatest({', '.join(columns)}, 0)"
    whens = " ".join(f"WHEN {column} = {top} THEN '{label}'" for column, label in zip(columns, labels))
    return f"CASE WHEN {top} <= 0 THEN NULL {whens} END", top


_LABELS = [c.label for c in schema.CATEGORIES]
_BEST_LABEL, _BEST_SECONDS = _best([f"TotalDuration_{c.suffix}" for c in schema.CATEGORIES], _LABELS)
_BEST_EN = _best([f'"{c.english}"' for c in schema.CATEGORIES], [c.english for c in schema.CATEGORIES])
_BEST_VI = _best([f'"{c.label}"' for c in schema.CATEGORIES], _LABELS)


def _level(days: str, limits, levels) -> str:
    return (f"CASE WHEN {days} IS NULL THEN NULL WHEN {days} < {limits[0]} THEN '{levels[0]}' "
            f"WHEN {days} < {limits[1]} THEN '{levels[1]}' ELSE '{levels[2]}' END")


def _since_first(days: str) -> str:
    return _level(days, schema.SINCE_FIRST_LIMITS, schema.SINCE_FIRST_LEVELS)


def _span(days: str) -> str:
    return _level(days, schema.SPAN_LIMITS, schema.SPAN_LEVELS)


_APP_ROWS = ", ".join(
    f"({n}, '{app}', '{label}')"
    for n, (app, label) in enumerate(((a, c.label) for c in schema.CATEGORIES for a in c.apps), start=1))
_TYPE_ROWS = ", ".join(
    f"({n}, '{c.label}', '{c.description}')" for n, c in enumerate(schema.ALL_CATEGORIES, start=1))

_STEPS = {
    "staging": f"""
  SELECT concat('C', lpad(CAST(user_id AS VARCHAR), 5, '0')) AS Contract,
    CASE WHEN event_id % 97 = 0 THEN NULL
      ELSE concat('M', lpad(CAST(user_id * 2 + event_id % 4 AS VARCHAR), 6, '0')) END AS Mac,
    ([{_APPS}, 'OTHER'])[(event_id * 7 + user_id) % 16 + 1] AS AppName,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(round(value * 60) AS BIGINT) END AS TotalDuration,
    CAST(ts AS DATE) AS EventDate
  FROM events""",
    "typed": f"""
  SELECT *, {_category()} AS Type, {_category(english=True)} AS EnType FROM staging""",
    "dim_date": f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS DateValue,
    CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS Quarter,
    CAST(month(d) AS INTEGER) AS Month, strftime(d, '%B') AS MonthName, CAST(day(d) AS INTEGER) AS Day,
    CAST(dayofweek(d) + 1 AS INTEGER) AS DayOfWeek, strftime(d, '%A') AS DayName,
    CAST(CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend
  FROM (SELECT CAST(unnest(generate_series(DATE '{schema.CALENDAR_START}', DATE '{schema.CALENDAR_END}',
    INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dim_app": f"""
  SELECT CAST(k AS INTEGER) AS AppKey, a AS AppName, c AS AppCategory FROM (VALUES {_APP_ROWS}) t(k, a, c)""",
    "dim_content_type": f"""
  SELECT CAST(k AS INTEGER) AS ContentTypeKey, n AS TypeName, d AS Description
  FROM (VALUES {_TYPE_ROWS}) t(k, n, d)""",
    "dim_contract": """
  SELECT row_number() OVER (ORDER BY substr(md5(ContractID), 1, 3), ContractID) AS ContractKey, ContractID
  FROM (SELECT DISTINCT Contract AS ContractID FROM staging WHERE Contract IS NOT NULL)""",
    "dim_device": """
  SELECT row_number() OVER (ORDER BY substr(md5(MacAddress), 1, 3), MacAddress) AS DeviceKey,
    MacAddress, ContractKey
  FROM (SELECT Mac AS MacAddress, min(c.ContractKey) AS ContractKey
    FROM staging s JOIN dim_contract c ON s.Contract = c.ContractID WHERE Mac IS NOT NULL GROUP BY Mac)""",
    "early_contract": f"""
  SELECT row_number() OVER (ORDER BY substr(md5(ContractID), 1, 3), ContractID) AS ContractKey, ContractID
  FROM (SELECT DISTINCT Contract AS ContractID FROM staging
    WHERE Contract IS NOT NULL AND EventDate < DATE '{LOADED_BEFORE}')""",
    "grown_contract": f"""
  SELECT * FROM early_contract
  UNION ALL
  SELECT (SELECT coalesce(max(ContractKey), 0) FROM early_contract)
    + row_number() OVER (ORDER BY substr(md5(ContractID), 1, 3), ContractID), ContractID
  FROM (SELECT DISTINCT Contract AS ContractID FROM staging
    WHERE Contract IS NOT NULL AND EventDate >= DATE '{LOADED_BEFORE}'
      AND Contract NOT IN (SELECT ContractID FROM early_contract))""",
    "early_device": f"""
  SELECT row_number() OVER (ORDER BY substr(md5(MacAddress), 1, 3), MacAddress) AS DeviceKey,
    MacAddress, ContractKey
  FROM (SELECT Mac AS MacAddress, min(c.ContractKey) AS ContractKey
    FROM staging s JOIN early_contract c ON s.Contract = c.ContractID
    WHERE Mac IS NOT NULL AND EventDate < DATE '{LOADED_BEFORE}' GROUP BY Mac)""",
    "grown_device": f"""
  SELECT * FROM early_device
  UNION ALL
  SELECT (SELECT coalesce(max(DeviceKey), 0) FROM early_device)
    + row_number() OVER (ORDER BY substr(md5(MacAddress), 1, 3), MacAddress), MacAddress, ContractKey
  FROM (SELECT Mac AS MacAddress, min(c.ContractKey) AS ContractKey
    FROM staging s JOIN grown_contract c ON s.Contract = c.ContractID
    WHERE Mac IS NOT NULL AND EventDate >= DATE '{LOADED_BEFORE}'
      AND Mac NOT IN (SELECT MacAddress FROM early_device) GROUP BY Mac)""",
    "star": """
  SELECT d.DateKey, c.ContractKey, v.DeviceKey, a.AppKey, t.ContentTypeKey, s.TotalDuration
  FROM staging s
  JOIN dim_date d ON s.EventDate = d.DateValue
  JOIN dim_contract c ON s.Contract = c.ContractID
  JOIN dim_device v ON s.Mac = v.MacAddress
  JOIN dim_app a ON s.AppName = a.AppName
  JOIN dim_content_type t ON a.AppCategory = t.TypeName""",
    "fact": """
  SELECT DateKey, ContractKey, DeviceKey, AppKey, ContentTypeKey,
    CAST(SUM(coalesce(TotalDuration, 0)) AS BIGINT) AS TotalDuration, count(*) AS SessionCount
  FROM star GROUP BY ALL""",
    "summary": f"""
  SELECT f.DateKey, f.ContractKey, count(DISTINCT f.DeviceKey) AS TotalDevices,
{_wide('t.TypeName', 'TotalDuration')},
  CAST(SUM(coalesce(TotalDuration, 0)) AS BIGINT) AS TotalDuration_All
  FROM fact f JOIN dim_content_type t USING (ContentTypeKey) GROUP BY f.DateKey, f.ContractKey""",
    "days": """
  SELECT d.DateValue, d.Year, d.Quarter, d.Month, d.MonthName, d.Day, c.ContractID, s.*,
    min(d.DateValue) OVER (PARTITION BY c.ContractID) AS FirstDate
  FROM summary s JOIN dim_date d USING (DateKey) JOIN dim_contract c USING (ContractKey)""",
    "analytics": f"""
  SELECT DateValue, Year, Quarter, Month, MonthName, Day, ContractID, TotalDevices,
    {', '.join(f'TotalDuration_{c.suffix} AS Duration_{c.suffix}' for c in schema.ALL_CATEGORIES)},
    TotalDuration_All AS Duration_Total,
    {_BEST_LABEL} AS MostWatchContentType, CAST({_BEST_SECONDS} AS BIGINT) AS MostWatchDuration,
    CAST(DateValue - FirstDate + 1 AS INTEGER) AS ActivationDays,
    {_since_first('DateValue - FirstDate + 1')} AS ActivationLevel
  FROM days""",
    "daily": f"""
  SELECT d.DateValue, d.Year, d.Month, d.Day, count(DISTINCT ContractKey) AS TotalContracts,
    CAST(SUM(TotalDevices) AS BIGINT) AS TotalDevices, {_sums('TotalDuration')},
    CAST(SUM(TotalDuration_All) AS BIGINT) AS TotalDuration_All
  FROM summary s JOIN dim_date d USING (DateKey) GROUP BY d.DateValue, d.Year, d.Month, d.Day""",
    "trend": """
  SELECT d.DateValue, d.Year, d.Month, t.TypeName AS ContentType,
    CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration, CAST(SUM(SessionCount) AS BIGINT) AS TotalSessions,
    count(DISTINCT ContractKey) AS UniqueContracts
  FROM fact f JOIN dim_date d USING (DateKey) JOIN dim_content_type t USING (ContentTypeKey)
  GROUP BY d.DateValue, d.Year, d.Month, t.TypeName""",
}


def _chain(steps: dict[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items())


_CHAIN = _chain(_STEPS)


def _from(n: int) -> str:
    """Trailing window that keeps the day exactly ``n`` back."""
    return f"DateValue >= DATE '{AS_OF}' - {n}"


def _after(n: int) -> str:
    """Trailing window without that day."""
    return f"DateValue > DATE '{AS_OF}' - {n}"


def _hours(column: str, name: str) -> str:
    return f"{column} / 3600.0 AS {name}"


def _sum_hours(column: str, name: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT) / 3600.0 AS {name}"


_TAGS = {"TruyenHinh": "TH", "PhimTruyen": "PT", "GiaiTri": "GT", "ThieuNhi": "TN", "TheThao": "TT"}
_IN_RANGE = f"DateValue BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"
_DAY = f"DATE '{ONE_DAY}'"
_MEDIA = """
SELECT EventDate AS ReportDate, AppName, CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration,
  count(*) AS TotalAccess FROM staging GROUP BY EventDate, AppName"""


def _distribution(where: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c.label}' AS label, CAST(SUM(TotalDuration_{c.suffix}) AS BIGINT) / 3600.0 AS value"
        f" FROM daily WHERE {where}"
        for c in schema.CATEGORIES)


_LEADERBOARD = f"""
SELECT ContractID, CAST(SUM(TotalDevices) AS BIGINT) AS TotalDevices,
  {_sum_hours('Duration_Total', 'TotalDuration_Hours')}, {_sum_hours('Duration_TruyenHinh', 'Duration_TH_Hours')},
  {_sum_hours('Duration_PhimTruyen', 'Duration_PT_Hours')}, {_sum_hours('Duration_GiaiTri', 'Duration_GT_Hours')},
  max(MostWatchContentType) AS MostWatchContentType,
  {_sum_hours('MostWatchDuration', 'MostWatchDuration_Hours')},
  max(ActivationDays) AS ActivationDays, max(ActivationLevel) AS ActivationLevel
FROM analytics WHERE {_from(30)} GROUP BY ContractID ORDER BY TotalDuration_Hours DESC, ContractID"""


_ACTIVE = """CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration, CAST(SUM(SessionCount) AS BIGINT) AS TotalSessions,
  count(DISTINCT ContractKey) AS UniqueContracts"""


def _per_day(*expressions: str) -> str:
    return f"SELECT EventDate, {', '.join(expressions)}, count(*) AS RowsCount FROM staging GROUP BY ALL"


def _trailing_groups() -> str:
    parts = []
    for n in (1, 7, 30):
        for boundary, sign in ((1, ">="), (0, ">")):
            parts.append(
                f"SELECT CAST({n} AS INTEGER) AS Days, CAST({boundary} AS INTEGER) AS WithBoundary, EventDate,"
                f" count(*) AS RowsCount, CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration FROM staging"
                f" WHERE EventDate {sign} DATE '{AS_OF}' - {n} GROUP BY EventDate")
    return "\nUNION ALL\n".join(parts)


def _duplicates(table: str, column: str) -> str:
    return (f"SELECT '{{name}}' AS CheckName, count(*) AS Violations FROM"
            f" (SELECT {column} FROM {table} GROUP BY {column} HAVING count(*) > 1)")


_UNIQUE = "\nUNION ALL\n".join(
    _duplicates(table, column).format(name=name)
    for table, column, name in (
        ("dim_contract", "ContractID", "dim_contract.ContractID"),
        ("dim_device", "MacAddress", "dim_device.MacAddress"),
        ("dim_app", "AppName", "dim_app.AppName"),
        ("dim_content_type", "TypeName", "dim_content_type.TypeName"),
        ("daily", "DateValue", "dm_daily_summary.DateValue")))

# The check is run against the early dimensions, so that it has something to report.
_ORPHANS = "\nUNION ALL\n".join(
    f"SELECT '{name}.{key}' AS CheckName, count(*) AS Violations FROM {table}"
    f" WHERE {key} NOT IN (SELECT {key} FROM {dimension})"
    for table, key, dimension, name in (
        ("early_device", "ContractKey", "early_contract", "dim_device"),
        ("fact", "DateKey", "dim_date", "fact_viewing_session"),
        ("fact", "ContractKey", "early_contract", "fact_viewing_session"),
        ("fact", "DeviceKey", "early_device", "fact_viewing_session"),
        ("fact", "AppKey", "dim_app", "fact_viewing_session"),
        ("fact", "ContentTypeKey", "dim_content_type", "fact_viewing_session"),
        ("summary", "DateKey", "dim_date", "fact_contract_summary"),
        ("summary", "ContractKey", "early_contract", "fact_contract_summary")))

_NULLS = "\nUNION ALL\n".join(
    f"SELECT '{name}.{column}' AS CheckName, count(*) AS Violations FROM {table} WHERE {column} IS NULL"
    for table, name, columns in (
        ("fact", "fact_viewing_session",
         ("DateKey", "ContractKey", "DeviceKey", "AppKey", "ContentTypeKey", "TotalDuration")),
        ("analytics", "dm_contract_analytics",
         ("DateValue", "Year", "Quarter", "Month", "MonthName", "Day", "ContractID", "TotalDevices")),
        ("staging", "staging", ("Contract", "Mac", "AppName", "TotalDuration", "EventDate")))
    for column in columns)

_LEFT_JOINS = """
  FROM staging s
  LEFT JOIN dim_date d ON s.EventDate = d.DateValue
  LEFT JOIN early_contract c ON s.Contract = c.ContractID
  LEFT JOIN early_device v ON s.Mac = v.MacAddress
  LEFT JOIN dim_app a ON s.AppName = a.AppName
  LEFT JOIN dim_content_type t ON a.AppCategory = t.TypeName"""

_PROFILE_VI = f"""
  SELECT Contract,
{_pivot()},
  count(*) AS TotalDevices, CAST(max(EventDate) - min(EventDate) + 1 AS INTEGER) AS ActivationDays
  FROM typed WHERE Contract IS NOT NULL GROUP BY Contract"""
_PROFILE_EN = f"""
  SELECT Contract,
{_pivot(english=True)},
  count(*) AS TotalDevices, CAST(max(EventDate) - min(EventDate) + 1 AS INTEGER) AS ActivationDays
  FROM typed WHERE Contract IS NOT NULL GROUP BY Contract"""

_FLAT = """SELECT Contract, Mac, AppName, TotalDuration, strftime(EventDate, '%Y%m%d') AS Date"""
_KNOWN = """FROM staging s JOIN dim_app a USING (AppName)
  WHERE Contract IS NOT NULL AND Mac IS NOT NULL
    AND EventDate BETWEEN DATE '2020-01-01' AND DATE '2030-12-31'"""
_TOP_APPS = """
SELECT AppName, AppCategory, count(*) AS RowsCount FROM staging LEFT JOIN dim_app USING (AppName)
GROUP BY ALL ORDER BY RowsCount DESC, AppName ASC NULLS FIRST LIMIT 10"""
_DATE_TEXT = """CASE event_id % 4 WHEN 0 THEN strftime(CAST(ts AS DATE), '%Y%m%d')
    WHEN 1 THEN CAST(CAST(ts AS DATE) AS VARCHAR) WHEN 2 THEN 'zz' END"""

_QUERIES = {
    # Sources
    "raw_scan": f"{_FLAT} FROM staging",
    "raw_scan_many": """
SELECT strftime(EventDate, '%Y%m%d') AS Date, count(*) AS Lines, CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration
FROM staging GROUP BY 1""",
    "date_from_filename": "SELECT strftime(EventDate, '%Y%m%d') AS DateValue, count(*) AS Lines FROM staging GROUP BY 1",
    "sample_preview": """
SELECT * FROM staging ORDER BY EventDate, Contract, Mac NULLS FIRST, AppName NULLS FIRST, TotalDuration NULLS FIRST
LIMIT 10""",
    "staging_scan": "SELECT * FROM staging",
    # Projections and filters
    "flatten_log": f"{_FLAT}, strftime(EventDate, '%Y%m%d') AS DateValue FROM staging",
    "staging_rows": "SELECT * FROM staging",
    "process_date_filter": f"SELECT * FROM staging WHERE EventDate = {_DAY}",
    "app_category": "SELECT Contract, AppName, Type, EnType AS EnglishType, TotalDuration FROM typed",
    "not_null_keys": "SELECT * FROM staging WHERE Contract IS NOT NULL AND Mac IS NOT NULL AND AppName IS NOT NULL",
    "trailing_days": _trailing_groups(),
    "date_between": f"SELECT * FROM staging WHERE EventDate BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'",
    "contract_filter": f"SELECT * FROM analytics WHERE ContractID = '{ONE_CONTRACT}'",
    "hours_projection": "SELECT DateValue, " + ", ".join(
        _hours(f"TotalDuration_{c.suffix}", f"{c.suffix}_Hours") for c in schema.CATEGORIES) + " FROM daily",
    # Joins
    "profile_join_devices": f"SELECT * EXCLUDE (ActivationDays) FROM ({_PROFILE_VI})",
    "profile_join_activation": f"""
SELECT * EXCLUDE (TotalDevices), {_BEST_EN[0]} AS MostWatchContentType, CAST({_BEST_EN[1]} AS BIGINT) AS MostWatchDuration,
  {_span('ActivationDays')} AS ActivationLevel FROM ({_PROFILE_EN})""",
    "star_join": """
SELECT s.EventDate, s.Contract, s.Mac, s.AppName, a.AppCategory, d.DateKey, c.ContractKey, v.DeviceKey, a.AppKey,
  t.ContentTypeKey, CAST(SUM(s.TotalDuration) AS BIGINT) AS TotalDuration, count(*) AS SessionCount
FROM staging s JOIN dim_date d ON s.EventDate = d.DateValue JOIN dim_contract c ON s.Contract = c.ContractID
  JOIN dim_device v ON s.Mac = v.MacAddress JOIN dim_app a ON s.AppName = a.AppName
  JOIN dim_content_type t ON a.AppCategory = t.TypeName
GROUP BY ALL""",
    "contract_summary_join": """
SELECT d.DateValue, c.ContractID, t.TypeName, count(DISTINCT f.DeviceKey) AS Devices,
  CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration
FROM fact f JOIN dim_date d USING (DateKey) JOIN dim_contract c USING (ContractKey)
  JOIN dim_device v USING (DeviceKey) JOIN dim_content_type t USING (ContentTypeKey)
GROUP BY d.DateValue, c.ContractID, t.TypeName""",
    "mart_join": "SELECT * EXCLUDE (DateKey, ContractKey, FirstDate) FROM days",
    "new_contracts_anti": f"""
SELECT DISTINCT Contract AS ContractID FROM staging WHERE Contract IS NOT NULL
  AND EventDate >= DATE '{LOADED_BEFORE}' AND Contract NOT IN (SELECT ContractID FROM early_contract)""",
    "semi_delete": f"""
SELECT * FROM summary WHERE DateKey NOT IN (SELECT DateKey FROM dim_date WHERE DateValue = {_DAY})""",
    "dim_match_left": """
SELECT s.AppName, a.AppCategory, count(*) AS RowsCount,
  CAST(CASE WHEN a.AppKey IS NULL THEN 0 ELSE 1 END AS INTEGER) AS Matched
FROM staging s LEFT JOIN dim_app a ON s.AppName = a.AppName GROUP BY ALL""",
    "lateral_unpivot_top1": f"""
SELECT DateKey, ContractKey, {_BEST_LABEL} AS ContentType, CAST({_BEST_SECONDS} AS BIGINT) AS Duration FROM summary""",
    # Aggregations
    "device_rows": "SELECT Contract, count(*) AS TotalDevices FROM staging GROUP BY Contract",
    "devices_distinct": f"SELECT EventDate, Contract, count(DISTINCT Mac) AS TotalDevices {_KNOWN} GROUP BY 1, 2",
    "duration_by_category": """
SELECT Contract, Type, CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration FROM typed GROUP BY Contract, Type""",
    "duration_pivot": f"SELECT * EXCLUDE (ActivationDays, TotalDevices) FROM ({_PROFILE_VI})",
    "conditional_sum_wide": f"""
SELECT EventDate, Contract, count(DISTINCT Mac) AS TotalDevices,
{_wide('AppCategory', 'TotalDuration')},
  CAST(SUM(coalesce(TotalDuration, 0)) AS BIGINT) AS TotalDuration_All
{_KNOWN} GROUP BY EventDate, Contract""",
    "fact_viewing_session": "SELECT * FROM fact",
    "device_first_contract": "SELECT MacAddress, ContractKey FROM dim_device",
    "distinct_contracts": "SELECT DISTINCT Contract AS ContractID FROM staging ORDER BY 1",
    "daily_summary_agg": "SELECT * FROM daily",
    "content_trend_agg": "SELECT * FROM trend",
    "media_report": _MEDIA,
    "global_agg": """
SELECT CAST(coalesce(SUM(TotalDuration), 0) AS BIGINT) AS TotalDuration, min(EventDate) AS MinDate,
  max(EventDate) AS MaxDate, count(*) AS RowsCount, count(TotalDuration) AS DurationsCount,
  count(DISTINCT Contract) AS Contracts, count(DISTINCT Mac) AS Macs FROM staging""",
    "integer_avg": """
SELECT AppName, CAST(SUM(TotalDuration) // count(TotalDuration) AS BIGINT) AS AvgDuration
FROM staging GROUP BY AppName""",
    "partial_merge": """
SELECT Contract, Type, CAST(SUM(TotalDuration) AS BIGINT) AS TotalDuration FROM typed GROUP BY Contract, Type""",
    "distinct_on_contract": """
SELECT Contract, min(EventDate) AS FirstDate, max(EventDate) AS LastDate, count(*) AS RowsCount
FROM staging GROUP BY Contract""",
    "conditional_distinct": f"""
SELECT count(DISTINCT CASE WHEN AppName NOT IN ({_APPS}) THEN AppName END) AS UnlistedApps,
  count(DISTINCT CASE WHEN AppName IS NULL OR AppName NOT IN ({_APPS}) THEN Contract END) AS ContractsWithUnlistedApps,
  count(DISTINCT CASE WHEN Mac IS NULL THEN Contract END) AS ContractsWithoutMac FROM staging""",
    "scalar_subquery_counts": """
SELECT (SELECT count(*) FROM dim_contract) AS TotalContracts, (SELECT count(*) FROM dim_device) AS TotalDevices,
  (SELECT count(*) FROM fact) AS TotalSessions, (SELECT count(*) FROM summary) AS TotalSummaries""",
    # Windows and row-wise picks
    "activation_span": f"""
SELECT Contract, ActivationDays, {_span('ActivationDays')} AS ActivationLevel
FROM (SELECT Contract, CAST(max(EventDate) - min(EventDate) + 1 AS INTEGER) AS ActivationDays
  FROM staging GROUP BY Contract)""",
    "activation_since_first": f"""
SELECT DateValue, ContractID, FirstDate, CAST(DateValue - FirstDate + 1 AS INTEGER) AS ActivationDays,
  {_since_first('DateValue - FirstDate + 1')} AS ActivationLevel FROM days""",
    "most_watch": f"""
SELECT Contract, {_BEST_EN[0]} AS MostWatchContentType, CAST({_BEST_EN[1]} AS BIGINT) AS MostWatchDuration
FROM ({_PROFILE_EN})""",
    "most_watch_mart": "SELECT DateValue, ContractID, MostWatchContentType, MostWatchDuration FROM analytics",
    "activation_level": f"""
SELECT Contract, Days, {_span('Days')} AS SpanLevel, {_since_first('Days')} AS SinceFirstLevel
FROM (SELECT Contract, CAST(max(EventDate) - min(EventDate) + 1 AS INTEGER) AS Days {_KNOWN} GROUP BY Contract)""",
    # Ordering, top-k, unions
    "top_n_contracts": f"""
SELECT ContractID, {_sum_hours('Duration_Total', 'duration_hours')} FROM analytics WHERE {_from(30)}
GROUP BY ContractID ORDER BY duration_hours DESC, ContractID LIMIT 50""",
    "head_of_top": f"""
SELECT ContractID, TotalDuration_Hours FROM ({_LEADERBOARD} LIMIT 50)
ORDER BY TotalDuration_Hours DESC, ContractID LIMIT 10""",
    "order_by_date": "SELECT * FROM trend ORDER BY DateValue, ContentType",
    "union_by_name": f"""
SELECT Contract, Mac, CASE WHEN EventDate < DATE '{LOADED_BEFORE}' THEN NULL ELSE AppName END AS AppName,
  TotalDuration, EventDate FROM staging""",
    "union_all_distribution": _distribution("true"),
    "table_footprint": """
SELECT 'dm_contract_analytics' AS TableName, count(*) AS TableRows,
  CAST(coalesce(SUM(strlen(CAST(DateValue AS VARCHAR)) + strlen(ContractID)), 0) AS BIGINT) AS EstimatedBytes
FROM analytics
UNION ALL
SELECT 'dm_daily_summary', count(*), CAST(coalesce(SUM(strlen(CAST(DateValue AS VARCHAR))), 0) AS BIGINT) FROM daily
UNION ALL
SELECT 'dm_content_type_trend', count(*),
  CAST(coalesce(SUM(strlen(CAST(DateValue AS VARCHAR)) + strlen(ContentType)), 0) AS BIGINT) FROM trend""",
    # Scalar functions
    "fn_parse_date": f"""
SELECT event_id, DateText, coalesce(CAST(try_strptime(DateText, '%Y%m%d') AS DATE), try_cast(DateText AS DATE)) AS Parsed
FROM (SELECT event_id, {_DATE_TEXT} AS DateText FROM events)""",
    "fn_date_key": _per_day("CAST(strftime(EventDate, '%Y%m%d') AS INTEGER) AS DateKey"),
    "fn_calendar_parts": _per_day(
        "CAST(year(EventDate) AS INTEGER) AS Year", "CAST(quarter(EventDate) AS INTEGER) AS Quarter",
        "CAST(month(EventDate) AS INTEGER) AS Month", "CAST(day(EventDate) AS INTEGER) AS Day"),
    "fn_names": _per_day("strftime(EventDate, '%B') AS MonthName", "strftime(EventDate, '%A') AS DayName"),
    "fn_weekday": _per_day(
        "CAST(dayofweek(EventDate) + 1 AS INTEGER) AS DayOfWeek",
        "CAST(CASE WHEN dayofweek(EventDate) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend"),
    "fn_date_math": _per_day(
        "EventDate + 1 AS NextDay", "EventDate - 7 AS WeekBefore",
        f"CAST(DATE '{AS_OF}' - EventDate AS INTEGER) AS DaysToEnd",
        f"CAST(DATE '{AS_OF}' - EventDate + 1 AS INTEGER) AS DaysInclusive"),
    "fn_null_default": """
SELECT Contract, EventDate, coalesce(TotalDuration, 0) AS Duration, coalesce(Mac, 'none') AS MacOrNone,
  CAST(AppName IS NULL AS INTEGER) AS NoApp FROM staging""",
    "fn_case": """
SELECT CASE WHEN TotalDuration < 600 THEN 'short' WHEN TotalDuration < 3600 THEN 'middle' ELSE 'long' END AS Band,
  count(*) AS RowsCount FROM staging GROUP BY 1""",
    "fn_greatest": f"""
SELECT Contract, greatest({', '.join(f'"{c.english}"' for c in schema.CATEGORIES)}) AS Greatest FROM ({_PROFILE_EN})""",
    "fn_casts": """
SELECT Contract, CAST(TotalDuration AS VARCHAR) AS DurationText, CAST(TotalDuration AS INTEGER) AS DurationInt,
  try_cast(AppName AS BIGINT) AS AppNumber, try_cast(substr(Contract, 2, 5) AS BIGINT) AS ContractNumber FROM staging""",
    "fn_byte_length": """
SELECT Type, CAST(strlen(Type) AS BIGINT) AS Bytes, count(*) AS RowsCount FROM typed GROUP BY ALL""",
    "fn_regex_extract": _per_day(
        r"regexp_extract(concat('log_', strftime(EventDate, '%Y%m%d'), '.json'), '(\d{8})', 1) AS FromName",
        r"regexp_extract('log.json', '(\d{8})', 1) AS FromUndated"),
    # Dimensions and warehouse
    "dim_date": """
SELECT d.*, coalesce(n, 0) AS StagingRows FROM dim_date d
LEFT JOIN (SELECT EventDate, count(*) AS n FROM staging GROUP BY 1) s ON s.EventDate = d.DateValue""",
    "dim_app": """
SELECT a.*, coalesce(n, 0) AS StagingRows FROM dim_app a
LEFT JOIN (SELECT AppName, count(*) AS n FROM staging GROUP BY 1) s ON s.AppName = a.AppName""",
    "dim_content_type": f"""
SELECT t.*, coalesce(n, 0) AS StagingRows FROM dim_content_type t
LEFT JOIN (SELECT AppCategory, count(*) AS n {_KNOWN} GROUP BY 1) s ON s.AppCategory = t.TypeName""",
    "dim_contract": "SELECT * FROM grown_contract",
    "surrogate_keys": """
SELECT MacAddress, row_number() OVER (ORDER BY substr(md5(MacAddress), 1, 3), MacAddress) AS Position
FROM (SELECT DISTINCT Mac AS MacAddress FROM staging WHERE Mac IS NOT NULL)""",
    "dim_device": "SELECT * FROM grown_device",
    "load_warehouse": "SELECT * FROM fact",
    "fact_contract_summary": "SELECT * FROM summary",
    # Marts
    "mart_contract_analytics": "SELECT * FROM analytics",
    "mart_daily_summary": "SELECT * FROM daily",
    "mart_content_trend": "SELECT * FROM trend",
    "mart_media_report": _MEDIA,
    "load_mart": "SELECT * FROM analytics",
    "mart_clear": """
SELECT 'dm_contract_analytics' AS TableName, count(*) AS RowsBefore, CAST(0 AS BIGINT) AS RowsAfter FROM analytics
UNION ALL SELECT 'dm_daily_summary', count(*), 0 FROM daily
UNION ALL SELECT 'dm_content_type_trend', count(*), 0 FROM trend""",
    "contract_profile": f"""
SELECT *, {_BEST_VI[0]} AS MostWatchContentType, CAST({_BEST_VI[1]} AS BIGINT) AS MostWatchDuration,
  {_span('ActivationDays')} AS ActivationLevel FROM ({_PROFILE_VI})""",
    "load_warehouse_summary": "SELECT * FROM daily",
    "load_warehouse_members": """
SELECT 'contract' AS Kind, ContractID AS Member FROM dim_contract
UNION ALL SELECT 'device', MacAddress FROM dim_device""",
    "load_mart_daily": "SELECT * FROM daily",
    "load_mart_trend": "SELECT * FROM trend",
    "refresh_late_and_corrected": "SELECT * FROM analytics",
    "load_mart_behind": "SELECT * FROM analytics",
    "refresh_resumed": "SELECT * FROM analytics",
    "stream_refresh": "SELECT * FROM analytics",
    "load_side_by_side": """
SELECT * FROM daily WHERE DateValue IN (SELECT DISTINCT EventDate FROM staging ORDER BY EventDate LIMIT 2)""",
    "load_audited": f"""
SELECT 'kept' AS Load, CAST(NULL AS VARCHAR) AS TableName, CAST(NULL AS VARCHAR) AS Rule, CAST(0 AS BIGINT) AS RowsBroken,
  count(*) AS RowsVisible FROM fact JOIN dim_date USING (DateKey) WHERE DateValue = {_DAY}
UNION ALL
SELECT 'broken', 'fact_viewing_session', 'sessions are short', count(*), 0
FROM fact JOIN dim_date USING (DateKey) WHERE DateValue = {_DAY} AND NOT ({SHORT})""",
    "run_pipeline_range": f"SELECT * FROM daily WHERE {_IN_RANGE}",
    "run_pipeline_media": _MEDIA,
    "load_staging_undated": "SELECT * FROM staging",
    "load_staging_overlap": "SELECT * FROM staging",
    "run_pipeline": "SELECT * FROM daily",
    "load_staging": "SELECT * FROM staging",
    "staging_folded": "SELECT * FROM staging",
    "staging_rejected": """
SELECT CASE WHEN TotalDuration % 10 = 3 THEN 'not JSON' WHEN TotalDuration % 10 = 4 THEN 'no record' END AS Reason,
  CASE WHEN TotalDuration % 10 = 3 THEN '{"_source": ' || Contract
    WHEN TotalDuration % 10 = 4 THEN '{"other": "' || Contract || '"}' ELSE Contract END AS Line, count(*) AS Lines
FROM staging GROUP BY ALL""",
    "run_with_checks": """
SELECT 'TotalRows' AS CheckName, count(*) AS CheckValue FROM staging
UNION ALL SELECT 'MinDate', CAST(strftime(min(EventDate), '%Y%m%d') AS BIGINT) FROM staging
UNION ALL SELECT 'MaxDate', CAST(strftime(max(EventDate), '%Y%m%d') AS BIGINT) FROM staging
UNION ALL SELECT 'DistinctDates', count(DISTINCT EventDate) FROM staging
UNION ALL SELECT 'TotalContracts', count(*) FROM dim_contract
UNION ALL SELECT 'TotalDevices', count(*) FROM dim_device
UNION ALL SELECT 'TotalSessions', count(*) FROM fact
UNION ALL SELECT 'TotalSummaries', count(*) FROM summary""",
    # Reports
    "kpi_7d": f"""
SELECT CAST(coalesce(SUM(TotalContracts), 0) AS BIGINT) AS TotalContracts,
  CAST(coalesce(SUM(TotalDevices), 0) AS BIGINT) AS TotalDevices,
  CAST(coalesce(SUM(TotalDuration_All), 0) AS BIGINT) AS TotalDuration,
  CAST(coalesce(SUM(TotalDuration_All), 0) AS BIGINT) / 3600.0 AS TotalDuration_Hours,
  count(*) AS DaysCount FROM daily WHERE {_from(7)}""",
    "daily_hours_7d": f"""
SELECT DateValue, TotalContracts, TotalDevices, {_hours('TotalDuration_All', 'TotalDuration_Hours')}
FROM daily WHERE {_from(7)} ORDER BY DateValue""",
    "daily_table": f"""
SELECT DateValue, Year, Month, strftime(DateValue, '%B') AS MonthName, Day, TotalContracts, TotalDevices,
  {', '.join(_hours(f'TotalDuration_{suffix}', f'Duration_{tag}_Hours') for suffix, tag in _TAGS.items())},
  {_hours('TotalDuration_All', 'Duration_Total_Hours')}
FROM daily WHERE {_IN_RANGE} ORDER BY DateValue DESC""",
    "distribution_from_daily": _distribution(_IN_RANGE),
    "contract_leaderboard": f"{_LEADERBOARD} LIMIT 10",
    "trend_30d": f"""
SELECT DateValue, ContentType, {_hours('TotalDuration', 'Duration_Hours')}, TotalSessions, UniqueContracts
FROM trend WHERE {_from(30)} ORDER BY DateValue, ContentType""",
    "daily_duration_30d": f"""
SELECT DateValue AS time, {_hours('TotalDuration_All', 'duration_hours')} FROM daily WHERE {_after(30)} ORDER BY 1""",
    "distribution_30d": _distribution(_after(30)),
    "top10_contracts_30d": f"""
SELECT ContractID, {_sum_hours('Duration_Total', 'duration_hours')} FROM analytics WHERE {_after(30)}
GROUP BY ContractID ORDER BY duration_hours DESC, ContractID LIMIT 10""",
    "contract_series": f"""
SELECT DISTINCT DateValue AS time, ContractID,
  {', '.join(_hours(f'Duration_{c.suffix}', c.suffix) for c in schema.CATEGORIES)}
FROM analytics WHERE {_after(30)}""",
    "contract_details": f"""
SELECT ContractID, CAST(SUM(TotalDevices) AS BIGINT) AS TotalDevices,
  {_sum_hours('Duration_Total', 'TotalDuration_Hours')},
  {', '.join(_sum_hours(f'Duration_{suffix}', f'{tag}_Hours') for suffix, tag in _TAGS.items())}
FROM analytics WHERE {_after(30)} GROUP BY ContractID ORDER BY TotalDuration_Hours DESC, ContractID LIMIT 20""",
    "contract_list": "SELECT DISTINCT ContractID FROM analytics ORDER BY ContractID",
    "type_comparison": f"""
SELECT ContentType, {_sum_hours('TotalDuration', 'duration_hours')} FROM trend WHERE {_after(30)} GROUP BY ContentType""",
    "type_statistics": f"""
SELECT ContentType, {_sum_hours('TotalDuration', 'TotalDuration_Hours')},
  CAST(SUM(TotalSessions) AS BIGINT) AS TotalSessions, CAST(SUM(UniqueContracts) AS BIGINT) AS UniqueContracts,
  CAST(SUM(TotalDuration) // count(TotalDuration) AS BIGINT) / 3600.0 AS AvgDuration_Hours
FROM trend WHERE {_after(30)} GROUP BY ContentType""",
    "realtime_daily": f"""
SELECT DateValue AS time, TotalContracts, TotalDevices, {_hours('TotalDuration_All', 'Duration_Hours')}
FROM daily WHERE {_after(1)} ORDER BY 1 DESC""",
    "realtime_types": f"""
SELECT ContentType, {_sum_hours('TotalDuration', 'Duration_Hours')} FROM trend WHERE {_after(1)} GROUP BY ContentType""",
    # Rollups
    "rollup_leaderboard": f"{_LEADERBOARD} LIMIT 10",
    "rollup_details": f"""
SELECT ContractID, CAST(SUM(TotalDevices) AS BIGINT) AS TotalDevices,
  {_sum_hours('Duration_Total', 'TotalDuration_Hours')},
  {', '.join(_sum_hours(f'Duration_{suffix}', f'{tag}_Hours') for suffix, tag in _TAGS.items())}
FROM analytics WHERE {_after(30)} GROUP BY ContractID ORDER BY TotalDuration_Hours DESC, ContractID LIMIT 20""",
    "active_contracts": f"""
SELECT t.TypeName AS ContentType, {_ACTIVE}
FROM fact f JOIN dim_date d USING (DateKey) JOIN dim_content_type t USING (ContentTypeKey)
WHERE d.DateValue BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' GROUP BY t.TypeName""",
    "active_contracts_by_period": " UNION ALL ".join(f"""
SELECT '{level}' AS Level, CAST(date_trunc('{level}', d.DateValue) AS DATE) AS PeriodStart, {_ACTIVE}
FROM fact f JOIN dim_date d USING (DateKey) GROUP BY ALL""" for level in ("day", "week", "month")),
    "partial_distinct": f"SELECT DateKey, ContentTypeKey, {_ACTIVE} FROM fact GROUP BY DateKey, ContentTypeKey",
    # Data quality
    "dq_staging_profile": """
SELECT count(*) AS TotalRows, min(EventDate) AS MinDate, max(EventDate) AS MaxDate,
  count(DISTINCT EventDate) AS DistinctDates FROM staging""",
    "dq_dim_counts": """
SELECT (SELECT count(*) FROM dim_date) AS DimDate, (SELECT count(*) FROM dim_app) AS DimApp,
  (SELECT count(*) FROM dim_content_type) AS DimContentType, (SELECT count(*) FROM dim_contract) AS DimContract,
  (SELECT count(*) FROM dim_device) AS DimDevice""",
    "dq_day_profile": f"""
SELECT count(*) AS DayRows, count(DISTINCT Contract) AS DistinctContracts, count(DISTINCT Mac) AS DistinctMacs
FROM staging WHERE EventDate = {_DAY}""",
    "dq_app_match": """
SELECT count(DISTINCT s.AppName) AS DistinctInStaging, count(DISTINCT a.AppName) AS DistinctInDimension,
  count(DISTINCT CASE WHEN a.AppName IS NOT NULL THEN s.AppName END) AS Matched
FROM staging s LEFT JOIN dim_app a ON s.AppName = a.AppName""",
    "dq_category_match": """
SELECT count(DISTINCT a.AppCategory) AS DistinctInStaging, count(DISTINCT t.TypeName) AS DistinctInDimension,
  count(DISTINCT CASE WHEN t.TypeName IS NOT NULL THEN a.AppCategory END) AS Matched
FROM staging s LEFT JOIN dim_app a ON s.AppName = a.AppName
LEFT JOIN dim_content_type t ON a.AppCategory = t.TypeName""",
    "dq_date_match": """
SELECT count(DISTINCT s.EventDate) AS DistinctInStaging, count(DISTINCT d.DateValue) AS DistinctInDimension,
  count(DISTINCT CASE WHEN d.DateKey IS NOT NULL THEN s.EventDate END) AS Matched
FROM staging s LEFT JOIN dim_date d ON s.EventDate = d.DateValue""",
    "dq_joinable_rows": f"""
SELECT count(*) AS RowsThatCanJoin {_LEFT_JOINS}
WHERE d.DateKey IS NOT NULL AND c.ContractKey IS NOT NULL AND v.DeviceKey IS NOT NULL
  AND a.AppKey IS NOT NULL AND t.ContentTypeKey IS NOT NULL""",
    "dq_unjoinable": f"""
SELECT count(*) AS RowsCannotJoin,
  count(DISTINCT CASE WHEN d.DateKey IS NULL THEN s.EventDate END) AS MissingDates,
  count(DISTINCT CASE WHEN c.ContractKey IS NULL THEN s.Contract END) AS MissingContracts,
  count(DISTINCT CASE WHEN v.DeviceKey IS NULL THEN s.Mac END) AS MissingDevices,
  count(DISTINCT CASE WHEN a.AppKey IS NULL THEN s.AppName END) AS MissingApps,
  count(DISTINCT CASE WHEN t.ContentTypeKey IS NULL THEN a.AppCategory END) AS MissingContentTypes {_LEFT_JOINS}
WHERE d.DateKey IS NULL OR c.ContractKey IS NULL OR v.DeviceKey IS NULL
  OR a.AppKey IS NULL OR t.ContentTypeKey IS NULL""",
    "dq_top_apps": _TOP_APPS,
    "dq_fact_range": """
SELECT count(*) AS TotalSessions, min(DateKey) AS MinDateKey, max(DateKey) AS MaxDateKey FROM fact""",
    "dq_summary_for_day": f"""
SELECT s.*, d.DateValue FROM summary s JOIN dim_date d USING (DateKey) WHERE d.DateValue = {_DAY}""",
    "dq_complete_rows": f"""
SELECT count(*) AS CompleteRows FROM staging WHERE EventDate = {_DAY}
  AND Contract IS NOT NULL AND Mac IS NOT NULL AND AppName IS NOT NULL""",
    "dq_new_keys": f"""
SELECT (SELECT count(DISTINCT Contract) FROM staging WHERE EventDate = {_DAY} AND Contract IS NOT NULL
    AND Contract NOT IN (SELECT ContractID FROM early_contract)) AS NewContracts,
  (SELECT count(DISTINCT Mac) FROM staging WHERE EventDate = {_DAY} AND Mac IS NOT NULL
    AND Mac NOT IN (SELECT MacAddress FROM early_device)) AS NewDevices""",
    "dq_unique": _UNIQUE,
    "dq_foreign_keys": _ORPHANS,
    "dq_not_null": _NULLS,
    # Streaming
    "incremental_ingest": "SELECT * FROM staging",
    "live_daily_totals": """
SELECT EventDate AS DateValue, Type, CAST(SUM(coalesce(TotalDuration, 0)) AS BIGINT) AS TotalDuration,
  count(*) AS TotalSessions FROM typed GROUP BY EventDate, Type""",
}


# The larger log takes the place of staging; the rest of the chain stays as it is.
_ORDER_LOG = f"""
  SELECT concat('C', lpad(CAST(o_custkey AS VARCHAR), 7, '0')) AS Contract,
    concat('M', lpad(CAST(l_suppkey AS VARCHAR), 7, '0')) AS Mac,
    ([{_APPS}, 'OTHER'])[l_partkey % 16 + 1] AS AppName,
    CAST(l_quantity * 60 AS BIGINT) AS TotalDuration, CAST(l_shipdate AS DATE) + {SHIFT_DAYS} AS EventDate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_ORDER_CHAIN = _chain(_STEPS | {"staging": _ORDER_LOG})
_ORDER_QUERIES = {
    "contract_profile_orders": f"""
SELECT *, {_BEST_EN[0]} AS MostWatchContentType, CAST({_BEST_EN[1]} AS BIGINT) AS MostWatchDuration,
  {_span('ActivationDays')} AS ActivationLevel FROM ({_PROFILE_EN})""",
    "top_app_counts": _TOP_APPS,
    "media_report_orders": _QUERIES["media_report"],
    "mart_daily_summary_orders": _QUERIES["mart_daily_summary"],
    "contract_leaderboard_orders": _LEADERBOARD.replace(
        _from(30), f"DateValue >= DATE '{ORDERS_AS_OF}' - {ORDERS_DAYS}") + " LIMIT 50",
}


def all_sql() -> dict[str, str]:
    plain = {name: f"{_CHAIN}\n{body.strip()}" for name, body in _QUERIES.items()}
    return plain | {name: f"{_ORDER_CHAIN}\n{body.strip()}" for name, body in _ORDER_QUERIES.items()}
