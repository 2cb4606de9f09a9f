"""Calendar and clock with the trade rows of each day and minute, and unique business keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoarfrost.functions.scalars import seconds_of_day
from hoarfrost.operators.generate import HOLIDAYS, date_dimension, time_dimension
from hoarfrost.operators.keys import dedupe_business_key
from hoarfrost.plans.check_sql import key_of, small
from hoarfrost.plans.registry import query
from hoarfrost.sources import trade
from hoarfrost.sources.trade import read, trade_warehouse

AS_OF = trade.AS_OF
DAY = f"DATE '{AS_OF}'"


def _holidays() -> str:
    whens = " ".join(f"WHEN month(d) = {m} AND day(d) = {n} THEN '{name.replace(chr(39), chr(39) * 2)}'" for (m, n), name in HOLIDAYS.items())
    return f"CASE {whens} ELSE 'N/A' END"


GN_DATE = f"""SELECT {key_of('d')} AS DateKey, CAST(isoyear(d) * 100 + week(d) AS INTEGER) AS CalendarWeekKey,
    CAST(fy * 100 + fp AS INTEGER) AS FiscalPeriodKey, CASE WHEN isodow(d) >= 6 THEN 2 ELSE 1 END AS YesNoFlagKey, d AS FullDate,
    dayname(d) AS DayName, {small('dayofweek(d) + 1')} AS DayOfWeekNumber, {small('isodow(d)')} AS IsoDayOfWeekNumber,
    {small('day(d)')} AS DayOfMonthNumber, {small('dayofyear(d)')} AS DayOfYearNumber,
    CAST(CAST(strftime(d, '%U') AS INTEGER) + 1 AS SMALLINT) AS WeekOfYearNumber, {small('week(d)')} AS IsoWeekNumber,
    {small('month(d)')} AS CalendarMonthNumber, monthname(d) AS CalendarMonthName, strftime(d, '%b') AS CalendarMonthShortName,
    {small('quarter(d)')} AS CalendarQuarterNumber, {small('year(d)')} AS CalendarYearNumber, {small('fp')} AS FiscalPeriodNumber,
    {small('(fp - 1) // 3 + 1')} AS FiscalQuarterNumber, {small('fy')} AS FiscalYearNumber, isodow(d) >= 6 AS IsWeekend,
    {_holidays()} <> 'N/A' AS IsHoliday, {_holidays()} AS HolidayName,
    CAST(date_diff('day', DATE '0001-01-01', d) + 1 AS INTEGER) AS JulianDayNumber,
    CAST(date_diff('day', {DAY}, d) AS INTEGER) AS DaysFromToday,
    CAST(floor(date_diff('day', {DAY}, d) / 7.0) AS INTEGER) AS WeeksFromToday,
    CAST((year(d) - {AS_OF.year}) * 12 + month(d) - {AS_OF.month} AS INTEGER) AS MonthsFromToday,
    last_day(d) = d AS IsMonthEnd, last_day(d) = d AND month(d) IN (3, 6, 9, 12) AS IsQuarterEnd,
    month(d) = 12 AND day(d) = 31 AS IsYearEnd, OrderCount
  FROM (SELECT d, coalesce(n, 0) AS OrderCount, (month(d) + 5) % 12 + 1 AS fp, year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS fy
    FROM (SELECT CAST(day AS DATE) AS d FROM generate_series(DATE '{trade.CALENDAR_START}', DATE '{trade.CALENDAR_END}', INTERVAL 1 DAY) t(day)) c
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS ordered, count(*) AS n FROM orders GROUP BY 1) o ON ordered = d) x"""


@query("gn_date", GN_DATE)
def gn_date(spark, folder):
    wh = trade_warehouse(spark, folder)
    days = date_dimension(spark, trade.CALENDAR_START, trade.CALENDAR_END, AS_OF)
    ordered = wh["OrderCycle"].groupBy(F.col("OrderDateKey").alias("DateKey")).agg(F.count("*").alias("OrderCount"))
    return days.join(ordered, "DateKey", "left").fillna(0, ["OrderCount"])


GN_TIME = """SELECT CAST(s AS INTEGER) AS TimeOfDayKey, CAST(h // 8 + 1 AS INTEGER) AS ShiftCodeKey,
    strftime(TIMESTAMP '2000-01-01' + to_seconds(s), '%H:%M:%S') AS TimeValue, CAST(h AS SMALLINT) AS HourNumber,
    CAST(s // 60 % 60 AS SMALLINT) AS MinuteNumber, CAST(0 AS SMALLINT) AS SecondNumber, CAST(s // 60 AS SMALLINT) AS MinuteOfDayNumber,
    CAST(s AS INTEGER) AS SecondOfDayNumber, CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS AmPmCode,
    lpad(CAST(h AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(h AS VARCHAR), 2, '0') || ':59' AS HourBucketName,
    CASE WHEN h < 6 OR h >= 22 THEN 'Night' WHEN h < 14 THEN 'Day' ELSE 'Evening' END AS ShiftBucketName,
    h >= 8 AND h < 17 AS IsBusinessHour, strftime(TIMESTAMP '2000-01-01' + to_seconds(s), '%I:%M %p') AS DisplayTime, EventCount
  FROM (SELECT s, s // 3600 AS h, coalesce(n, 0) AS EventCount FROM range(0, 86400, 60) t(s)
    LEFT JOIN (SELECT hour(ts) * 3600 + minute(ts) * 60 AS minute_start, count(*) AS n FROM events GROUP BY 1) e ON minute_start = s) x"""


@query("gn_time", GN_TIME)
def gn_time(spark, folder):
    seconds = seconds_of_day("ts")
    minutes = read(spark, folder, "events").groupBy((seconds - seconds % 60).cast("int").alias("TimeOfDayKey"))
    counted = minutes.agg(F.count("*").alias("EventCount"))
    return time_dimension(spark).join(counted, "TimeOfDayKey", "left").fillna(0, ["EventCount"])


@query("gn_unique_bk", f"""SELECT p_partkey, CASE WHEN n = 1 THEN p_name ELSE left(p_name, 24 - length('-' || n)) || '-' || n END AS PartCode
  FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY sha256(CAST(p_partkey AS VARCHAR)), p_partkey) AS n FROM part) x""")
def gn_unique_bk(spark, folder):
    parts = read(spark, folder, "part").select("p_partkey", F.col("p_name").alias("PartCode"))
    return dedupe_business_key(parts, "PartCode", ["p_partkey"], limit=24)
