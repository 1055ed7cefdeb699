"""Registered queries: each one a Spark DataFrame over the test tables, and
the SQL that computes the same rows independently (run by DuckDB).

Every query reads whole tables (the football views of
``kickledger.sources.testdata``); none filters to a subset to make the
check cheaper. Columns carry the same names on both sides. Dates and
times in outputs are rendered as ISO text so both engines hand back the
same value type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickledger.functions import coerce, months, text
from kickledger.operators import pages as page_ops
from kickledger.operators import reports, rollup_state, rollups
from kickledger.plans import pipeline
from kickledger.session import materialize, shared_path, together
from kickledger.sources import ingest
from kickledger.sources import testdata as td
from kickledger.sources.warehouse import Warehouse
from kickledger.streaming import month_stream

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


# --- oracle building blocks (DuckDB SQL over the given tables) -----------------
VIEWS = {
    "valuations": """SELECT l_partkey AS player_id, CAST(l_shipdate AS DATE) AS date,
        l_extendedprice AS market_value, l_suppkey AS current_club_id,
        l_returnflag AS competition_id FROM lineitem""",
    "clubs": """SELECT s_suppkey AS club_id, s_name AS name,
        CAST(s_nationkey AS VARCHAR) AS domestic_competition_id FROM supplier""",
    "competitions": """SELECT CAST(n_nationkey AS VARCHAR) AS competition_id,
        lower(replace(n_name, '_', '-')) AS name,
        CASE WHEN n_nationkey < 20 THEN 'first_tier' ELSE 'second_tier' END AS sub_type,
        r_name AS country_name FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "players": "SELECT p_partkey AS player_id, p_name AS name FROM part",
    "vrows": f"""SELECT v.*, c.name AS club_name, c.domestic_competition_id
        FROM valuations v JOIN clubs c ON v.current_club_id = c.club_id
        WHERE v.date >= DATE '{td.START}' AND v.date < DATE '{td.END}'""",
    "lve": """SELECT domestic_competition_id,
        CAST(coalesce(sum(CAST(market_value AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_valuation,
        min(market_value) AS min_valuation, max(market_value) AS max_valuation,
        CAST(count(market_value) AS INTEGER) AS player_count,
        strftime(date, '%Y-%m-01') AS partition_date
        FROM vrows WHERE domestic_competition_id IS NOT NULL GROUP BY 1, 6""",
    "cve": """SELECT club_name,
        CAST(coalesce(sum(CAST(market_value AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_valuation,
        min(market_value) AS min_valuation, max(market_value) AS max_valuation,
        CAST(count(market_value) AS INTEGER) AS squad_size,
        (min(CASE WHEN competition_id IS NOT NULL THEN
             {'date': date, 'competition_id': competition_id} END)).competition_id
          AS domestic_competition_id,
        strftime(date, '%Y-%m-01') AS partition_date
        FROM vrows WHERE club_name IS NOT NULL GROUP BY club_name, strftime(date, '%Y-%m-01')""",
    "base": f"""SELECT l.domestic_competition_id, l.total_valuation, l.max_valuation, l.partition_date,
        c.name AS competition_name, c.country_name,
        CAST(year(CAST(l.partition_date AS DATE)) AS INTEGER) AS year
        FROM lve l JOIN competitions c ON l.domestic_competition_id = c.competition_id
        WHERE c.sub_type = 'first_tier' AND CAST(l.partition_date AS DATE) < DATE '{td.CUTOFF}'""",
    "yearly": """SELECT domestic_competition_id, year,
        max(total_valuation) AS total_valuation,
        array_to_string(list_transform(string_split(min(competition_name), '-'),
            lambda s: upper(substring(s, 1, 1)) || lower(substring(s, 2))), ' ') AS competition_name,
        min(country_name) AS country_name, max(max_valuation) AS max_valuation
        FROM base GROUP BY 1, 2""",
}

# Which views each view reads (so a query's WITH clause holds just what it needs).
_DEPENDS = {
    "vrows": ["valuations", "clubs"],
    "lve": ["vrows"],
    "cve": ["vrows"],
    "base": ["lve", "competitions"],
    "yearly": ["base"],
}


def with_views(*names: str, overrides: dict[str, str] | None = None) -> str:
    views = {**VIEWS, **(overrides or {})}
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in order) + "\n"


def top_sql(stat: str, n: int) -> str:
    return f"""SELECT domestic_competition_id, max({stat}) AS {stat} FROM base
        WHERE year = (SELECT max(year) FROM base) GROUP BY 1
        ORDER BY {stat} DESC NULLS LAST, domestic_competition_id LIMIT {n}"""


def report_sql(stat: str, n: int, overrides: dict[str, str] | None = None) -> str:
    other_stat = "max_valuation" if stat == "total_valuation" else "total_valuation"
    return with_views("yearly", overrides=overrides) + f""", top AS ({top_sql(stat, n)}),
    kept AS (SELECT * FROM yearly WHERE domestic_competition_id IN (SELECT domestic_competition_id FROM top)),
    other AS (SELECT 'Other' AS domestic_competition_id, year, max({stat}) AS {stat},
        CAST(NULL AS DOUBLE) AS {other_stat}, 'Other' AS competition_name,
        CAST((SELECT count(DISTINCT domestic_competition_id) FROM base) - (SELECT count(*) FROM top) AS VARCHAR)
          AS country_name
        FROM yearly WHERE domestic_competition_id NOT IN (SELECT domestic_competition_id FROM top)
        GROUP BY year),
    report AS (SELECT domestic_competition_id, year, total_valuation, max_valuation, competition_name, country_name
        FROM kept UNION ALL
        SELECT domestic_competition_id, year, total_valuation, max_valuation, competition_name, country_name
        FROM other)
    SELECT *, competition_name || ' (' || country_name || ')' AS league_label FROM report"""


# --- shared Spark inputs ---------------------------------------------------------
def _rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.league_valuation_evolution(td.valuations(spark, sf), td.clubs(spark, sf), td.START, td.END)


def _report(spark: SparkSession, sf: str, stat: str, n: int) -> DataFrame:
    return reports.first_league_report(_rollup(spark, sf), td.competitions(spark, sf), stat, n, td.CUTOFF)


# --- rollups ------------------------------------------------------------------------
@register("league_valuation_evolution", with_views("lve") + "SELECT * FROM lve")
def q_league_valuation_evolution(spark, sf):
    return _rollup(spark, sf)


@register("club_valuation_evolution", with_views("cve") + "SELECT * FROM cve")
def q_club_valuation_evolution(spark, sf):
    return rollups.club_valuation_evolution(td.valuations(spark, sf), td.clubs(spark, sf), td.START, td.END)


@register("join_valuations_clubs", with_views("vrows") + """SELECT player_id, CAST(date AS VARCHAR) AS date,
    market_value, current_club_id, competition_id, club_name, domestic_competition_id FROM vrows""")
def q_join_valuations_clubs(spark, sf):
    rows = rollups.valuation_rows(td.valuations(spark, sf), td.clubs(spark, sf), td.START, td.END)
    return rows.select("player_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "market_value",
                       "current_club_id", "competition_id", "club_name", "domestic_competition_id")


# --- reports --------------------------------------------------------------------------
@register("first_league_total", report_sql("total_valuation", 5))
def q_first_league_total(spark, sf):
    return _report(spark, sf, "total_valuation", 5)


@register("first_league_max", report_sql("max_valuation", 7))
def q_first_league_max(spark, sf):
    return _report(spark, sf, "max_valuation", 7)


@register("player_top100", with_views("valuations", "players", "clubs") + """
    SELECT p.player_id, p.name,
        CAST(sum(CAST(v.market_value AS DECIMAL(18,2))) AS DOUBLE) / count(v.market_value) AS avg_valuation,
        max(v.market_value) AS max_valuation, min(v.market_value) AS min_valuation, c.name AS club_name
    FROM valuations v JOIN players p ON v.player_id = p.player_id JOIN clubs c ON v.current_club_id = c.club_id
    GROUP BY p.player_id, p.name, c.name
    ORDER BY avg_valuation DESC NULLS LAST, p.player_id, p.name NULLS LAST, c.name NULLS LAST LIMIT 100""")
def q_player_top100(spark, sf):
    return reports.player_top100(td.valuations(spark, sf), td.players(spark, sf), td.clubs(spark, sf))


# --- scans, sources, sinks ------------------------------------------------------------
VALUATION_TEXT_SQL = """SELECT player_id, CAST(date AS VARCHAR) AS date, market_value, current_club_id,
    competition_id FROM valuations"""


def _valuation_text(df: DataFrame) -> DataFrame:
    return df.select("player_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "market_value",
                     "current_club_id", "competition_id")


@register("scan_project", with_views("valuations") + VALUATION_TEXT_SQL)
def q_scan_project(spark, sf):
    path = f"{sf.rstrip('/')}/lineitem.parquet"
    return spark.sql(f"""SELECT l_partkey AS player_id, date_format(l_shipdate, 'yyyy-MM-dd') AS date,
        l_extendedprice AS market_value, l_suppkey AS current_club_id, l_returnflag AS competition_id
        FROM parquet.`{path}`""")


@register("parquet_roundtrip", with_views("valuations") + VALUATION_TEXT_SQL)
def q_parquet_roundtrip(spark, sf):
    path = ingest.write_parquet(td.valuations(spark, sf), shared_path(spark, "parquet_roundtrip"))
    return _valuation_text(spark.read.parquet(path))


# Raw valuation text with bad cells in some lines (chosen by line number).
RAW_VALUATIONS_SPARK = {
    "player_id": "CAST(l_partkey AS STRING)",
    "date": """CASE l_linenumber WHEN 3 THEN 'N/A' WHEN 5 THEN '2015-02-30'
        WHEN 6 THEN concat(date_format(l_shipdate, 'yyyy-MM-dd'), ' 10:00:00')
        ELSE date_format(l_shipdate, 'yyyy-MM-dd') END""",
    "market_value_in_eur": """CASE l_linenumber WHEN 1 THEN concat(CAST(l_orderkey AS STRING), '.5')
        WHEN 2 THEN concat(CAST(l_orderkey AS STRING), 'd') WHEN 3 THEN concat(CAST(l_orderkey AS STRING), 'e2')
        WHEN 4 THEN 'n/a' WHEN 6 THEN '1,000' WHEN 7 THEN concat(' ', CAST(l_orderkey AS STRING), ' ')
        ELSE CAST(l_orderkey AS STRING) END""",
    "current_club_id": "CAST(l_suppkey AS STRING)",
    "player_club_domestic_competition_id": "CASE WHEN l_linenumber = 4 THEN NULL ELSE l_returnflag END",
}


@register("csv_ingest", """SELECT l_partkey AS player_id,
    CASE WHEN l_linenumber IN (3, 5, 6) THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
    CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN l_orderkey * 100 WHEN 4 THEN NULL
        WHEN 6 THEN NULL ELSE l_orderkey END AS market_value_in_eur,
    l_suppkey AS current_club_id,
    CASE WHEN l_linenumber = 4 THEN NULL ELSE l_returnflag END AS player_club_domestic_competition_id
    FROM lineitem""")
def q_csv_ingest(spark, sf):
    raw = td.table(spark, sf, "lineitem").select([F.expr(e).alias(n) for n, e in RAW_VALUATIONS_SPARK.items()])
    path = shared_path(spark, "csv_ingest")
    raw.write.mode("overwrite").option("header", True).csv(path)
    typed = ingest.load_dataset(spark, path, "player_valuations")
    return typed.select("player_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "market_value_in_eur",
                        "current_club_id", "player_club_domestic_competition_id")


@register("parquet_ingest", """SELECT l_partkey AS player_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date,
    CASE WHEN l_extendedprice = floor(l_extendedprice) THEN CAST(l_extendedprice AS BIGINT) END
      AS market_value_in_eur,
    l_suppkey AS current_club_id, l_returnflag AS player_club_domestic_competition_id FROM lineitem""")
def q_parquet_ingest(spark, sf):
    """Raw valuations that arrive as typed Parquet: the typed columns convert
    directly (a fractional value for an integer column is NULL)."""
    raw = td.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("player_id"), F.col("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("market_value_in_eur"), F.col("l_suppkey").alias("current_club_id"),
        F.col("l_returnflag").alias("player_club_domestic_competition_id"))
    path = shared_path(spark, "raw") + "/player_valuations.parquet"
    raw.write.parquet(path)
    typed = ingest.load_dataset(spark, path, "player_valuations")
    return typed.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


@register("month_partition_write", with_views("valuations") + VALUATION_TEXT_SQL.replace(
    "competition_id FROM valuations", "competition_id, strftime(date, '%Y-%m') AS partition_date FROM valuations"))
def q_month_partition_write(spark, sf):
    path = ingest.split_by_month(td.valuations(spark, sf), "date", shared_path(spark, "month_split"))
    back = ingest.read_months(spark, path)
    return back.select("player_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "market_value",
                       "current_club_id", "competition_id", "partition_date")


@register("month_write_time_of_day", """SELECT l_partkey AS player_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date,
    strftime(ts, '%Y-%m') AS partition_date
    FROM (SELECT *, l_shipdate + to_hours(6 * (l_linenumber - 1)) AS ts FROM lineitem)
    WHERE ts <= date_trunc('month', ts) + INTERVAL 1 MONTH - INTERVAL 1 DAY""")
def q_month_write_time_of_day(spark, sf):
    """Valuations with a time of day, split by the closed month: later than 00:00 on the last day is in no month."""
    rows = td.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("player_id"), F.expr(
        "timestampadd(HOUR, 6 * (l_linenumber - 1), CAST(l_shipdate AS TIMESTAMP_NTZ))").alias("date"))
    path = ingest.split_by_month(rows, "date", shared_path(spark, "month_split"), closed=True)
    return ingest.read_months(spark, path).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


# --- coercion -----------------------------------------------------------------------------
DATE_TEXT_SQL = """CASE l_linenumber WHEN 3 THEN 'N/A' WHEN 5 THEN '2015-02-30'
    WHEN 6 THEN strftime(l_shipdate, '%Y-%m-%d') || ' 10:00:00' WHEN 7 THEN NULL
    ELSE strftime(l_shipdate, '%Y-%m-%d') END"""


@register("coerce_dates", f"""SELECT l_orderkey, l_linenumber, raw_date,
    strftime(try_strptime(raw_date, '%Y-%m-%d'), '%Y-%m-%d') AS date
    FROM (SELECT l_orderkey, l_linenumber, {DATE_TEXT_SQL} AS raw_date FROM lineitem)""")
def q_coerce_dates(spark, sf):
    raw = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(
        DATE_TEXT_SQL.replace("strftime(l_shipdate, '%Y-%m-%d')", "date_format(l_shipdate, 'yyyy-MM-dd')"))
        .alias("raw_date"))
    return raw.withColumn("date", F.date_format(coerce.to_date_or_null("raw_date"), "yyyy-MM-dd"))


NUMBER_TEXT_SQL = """CASE l_linenumber WHEN 1 THEN CAST(l_orderkey AS VARCHAR) || 'd'
    WHEN 2 THEN ' ' || CAST(l_orderkey AS VARCHAR) || ' ' WHEN 3 THEN CAST(l_orderkey AS VARCHAR) || 'e2'
    WHEN 4 THEN 'n/a' WHEN 5 THEN printf('%.2f', l_extendedprice) WHEN 6 THEN '+' || CAST(l_orderkey AS VARCHAR)
    ELSE '1,' || CAST(l_orderkey AS VARCHAR) END"""


@register("coerce_numbers", f"""SELECT l_orderkey, l_linenumber, raw_number,
    CASE WHEN ok AND d = floor(d) THEN CAST(d AS BIGINT) END AS as_long,
    CASE WHEN ok THEN d END AS as_double
    FROM (SELECT *, TRY_CAST(trim(raw_number) AS DOUBLE) AS d,
        regexp_full_match(raw_number, '{coerce.NUMBER_PATTERN}') AS ok
      FROM (SELECT l_orderkey, l_linenumber, {NUMBER_TEXT_SQL} AS raw_number FROM lineitem))""")
def q_coerce_numbers(spark, sf):
    text = (NUMBER_TEXT_SQL.replace("AS VARCHAR", "AS STRING")
            .replace("printf('%.2f', l_extendedprice)", "format_string('%.2f', l_extendedprice)"))
    raw = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(text).alias("raw_number"))
    return raw.select("*", coerce.to_long_or_null("raw_number").alias("as_long"),
                      coerce.to_double_or_null("raw_number").alias("as_double"))


@register("stringify_nulls", """SELECT c_custkey, coalesce(c_name, 'nan') AS c_name, c_nationkey, c_acctbal,
    coalesce(CASE WHEN c_nationkey < 5 THEN NULL ELSE c_mktsegment END, 'nan') AS c_mktsegment FROM customer""")
def q_stringify_nulls(spark, sf):
    c = td.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        F.when(F.col("c_nationkey") >= 5, F.col("c_mktsegment")).alias("c_mktsegment"))
    return coerce.stringify_text_columns(c)


RAW_CLUBS_SPARK = {
    "club_id": "CAST(s_suppkey AS STRING)",
    "name": "CASE WHEN s_nationkey = 3 THEN NULL ELSE s_name END",
    "domestic_competition_id": "CASE WHEN s_nationkey = 4 THEN NULL ELSE CAST(s_nationkey AS STRING) END",
    "total_market_value": """CASE WHEN s_nationkey < 5 THEN 'n/a'
        WHEN s_nationkey < 10 THEN concat(CAST(s_suppkey AS STRING), '.0')
        WHEN s_nationkey < 12 THEN concat(CAST(s_suppkey AS STRING), '.5')
        ELSE CAST(CAST(rint(s_acctbal * 100) AS BIGINT) AS STRING) END""",
    "average_age": """CASE WHEN s_nationkey < 8 THEN CAST(s_acctbal AS STRING)
        WHEN s_nationkey < 12 THEN concat(CAST(s_acctbal AS STRING), 'd')
        ELSE concat(' ', CAST(s_acctbal AS STRING), ' ') END""",
    "foreigners_percentage": "CASE WHEN s_nationkey < 15 THEN '12.5' ELSE '1,5' END",
}


@register("csv_ingest_clubs", """SELECT s_suppkey AS club_id,
    coalesce(CASE WHEN s_nationkey = 3 THEN NULL ELSE s_name END, 'nan') AS name,
    coalesce(CASE WHEN s_nationkey = 4 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END, 'nan')
      AS domestic_competition_id,
    CASE WHEN s_nationkey < 5 THEN NULL WHEN s_nationkey < 10 THEN s_suppkey WHEN s_nationkey < 12 THEN NULL
         ELSE CAST(round(s_acctbal * 100) AS BIGINT) END AS total_market_value,
    CASE WHEN s_nationkey >= 8 AND s_nationkey < 12 THEN NULL ELSE s_acctbal END AS average_age,
    CASE WHEN s_nationkey < 15 THEN 12.5 END AS foreigners_percentage
    FROM supplier""")
def q_csv_ingest_clubs(spark, sf):
    """Club file typing with missing text stored as ``nan`` (the reference's form)."""
    raw = td.table(spark, sf, "supplier").select([F.expr(e).alias(n) for n, e in RAW_CLUBS_SPARK.items()])
    path = shared_path(spark, "csv_clubs")
    raw.write.mode("overwrite").option("header", True).csv(path)
    return ingest.load_dataset(spark, path, "clubs", null_strings="nan")


@register("league_valuation_evolution_nan", with_views("lve", overrides={
    "clubs": """SELECT s_suppkey AS club_id, s_name AS name,
        coalesce(CASE WHEN s_nationkey IN (3, 4) THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END, 'nan')
          AS domestic_competition_id FROM supplier"""}) + "SELECT * FROM lve")
def q_league_valuation_evolution_nan(spark, sf):
    """Clubs without a league, stored as ``nan`` text: the rollup keeps them as league ``nan``."""
    clubs = td.clubs(spark, sf).withColumn("domestic_competition_id", F.when(
        ~F.col("domestic_competition_id").isin("3", "4"), F.col("domestic_competition_id")))
    return rollups.league_valuation_evolution(td.valuations(spark, sf), coerce.stringify_text_columns(clubs),
                                              td.START, td.END)


# --- loads into the month-partitioned warehouse ---------------------------------------------
LOADED_VALUATIONS_SQL = f"""SELECT CAST(player_id AS INTEGER) AS player_id, CAST(date AS VARCHAR) AS date,
    CAST(market_value AS FLOAT) AS market_value, CAST(current_club_id AS INTEGER) AS current_club_id,
    competition_id, strftime(date, '%Y-%m') AS partition_date
    FROM valuations WHERE date >= DATE '{td.START}' AND date < DATE '{td.END}'"""


def _loaded_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _load_valuations(spark, sf) -> Warehouse:
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    wh.create_table("player_valuations")
    rows = pipeline.valuation_load_rows(td.valuations(spark, sf), td.START, td.END)
    wh.replace_months("player_valuations", rows, on_empty="delete", start=td.START, end=td.END)
    return wh


@register("load_valuations", with_views("valuations") + LOADED_VALUATIONS_SQL)
def q_load_valuations(spark, sf):
    return _loaded_text(_load_valuations(spark, sf).read("player_valuations"))


APPEARANCES_SQL = f"""SELECT CAST(event_id AS VARCHAR) AS appearance_id, CAST(event_id AS INTEGER) AS game_id,
    CAST(user_id AS INTEGER) AS player_id, CAST(user_id AS INTEGER) AS player_club_id,
    CAST(user_id AS INTEGER) AS player_current_club_id, ts + INTERVAL 2 DAY AS date,
    event_type AS player_name, event_type AS competition_id, CAST(trunc(value) AS INTEGER) AS yellow_cards,
    0 AS red_cards, CAST(length(props) AS INTEGER) AS goals, 0 AS assists,
    CAST(round(value) AS INTEGER) AS minutes_played FROM events"""


@register("load_appearances", f"""SELECT appearance_id, game_id, player_id, player_club_id, player_current_club_id,
    strftime(date, '%Y-%m-%d') AS date, player_name, competition_id, yellow_cards, red_cards, goals, assists,
    minutes_played, strftime(date, '%Y-%m') AS partition_date
    FROM ({APPEARANCES_SQL}) WHERE date <= CAST(last_day(CAST(date AS DATE)) AS TIMESTAMP)
      AND date >= TIMESTAMP '{months.CALENDAR_START}' AND date < TIMESTAMP '{months.CALENDAR_END}'""")
def q_load_appearances(spark, sf):
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    wh.create_table("player_appearances")
    rows = pipeline.appearance_load_rows(td.appearances(spark, sf), months.CALENDAR_START, months.CALENDAR_END,
                                        closed=True)
    wh.replace_months("player_appearances", rows, on_empty="delete",
                      start=months.CALENDAR_START, end=months.CALENDAR_END)
    return _loaded_text(wh.read("player_appearances"))


def _split_sql(closed: bool) -> str:
    keep = "AND date <= CAST(last_day(CAST(date AS DATE)) AS TIMESTAMP)" if closed else ""
    return f"""SELECT appearance_id, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date,
        strftime(date, '%Y-%m') AS partition_date FROM ({APPEARANCES_SQL})
        WHERE date >= TIMESTAMP '{months.CALENDAR_START}' AND date < TIMESTAMP '{months.CALENDAR_END}' {keep}"""


def _split(spark, sf, closed: bool) -> DataFrame:
    a = td.appearances(spark, sf).where(months.in_window("date", months.CALENDAR_START, months.CALENDAR_END))
    return months.with_month(a, "date", closed=closed).select(
        "appearance_id", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"), "partition_date")


@register("month_split_closed", _split_sql(True))
def q_month_split_closed(spark, sf):
    return _split(spark, sf, True)


@register("month_split_half_open", _split_sql(False))
def q_month_split_half_open(spark, sf):
    return _split(spark, sf, False)


# --- month calendar ----------------------------------------------------------------------------
@register("month_calendar", with_views("valuations") + """SELECT strftime(m, '%Y-%m-%d') AS month,
    strftime(m, '%Y-%m') AS month_key, strftime(m, '%Y-%m-%d') AS partition_key
    FROM (SELECT unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)),
        INTERVAL 1 MONTH)) AS m FROM valuations)""")
def q_month_calendar(spark, sf):
    cal = months.calendar_of(td.valuations(spark, sf), "date")
    return cal.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@register("missing_months", with_views("valuations") + f"""SELECT strftime(m, '%Y-%m-%d') AS month,
    strftime(m, '%Y-%m') AS month_key, strftime(m, '%Y-%m-%d') AS partition_key
    FROM (SELECT unnest(generate_series(DATE '{td.START}', DATE '{td.END}' - INTERVAL 1 MONTH,
        INTERVAL 1 MONTH)) AS m)
    WHERE strftime(m, '%Y-%m') NOT IN (SELECT DISTINCT strftime(date, '%Y-%m') FROM valuations
        WHERE date IS NOT NULL)""")
def q_missing_months(spark, sf):
    cal = months.calendar(spark, td.START, td.END)
    gap = months.missing_months(cal, td.valuations(spark, sf), "date")
    return gap.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


STORED_LVE_SQL = with_views("lve") + """SELECT domestic_competition_id, CAST(total_valuation AS FLOAT) AS total_valuation,
    CAST(min_valuation AS FLOAT) AS min_valuation, CAST(max_valuation AS FLOAT) AS max_valuation,
    player_count, partition_date FROM lve"""


@register("backfill_rollup", STORED_LVE_SQL)
def q_backfill_rollup(spark, sf):
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    v, c = td.valuations(spark, sf), td.clubs(spark, sf)
    pipeline.backfill_league_rollup(wh, v, c, td.START, td.END)
    # Running a part of the range again replaces those months with equal rows.
    pipeline.backfill_league_rollup(wh, v, c, "1997-01-01", "1999-01-01")
    return wh.read("league_valuation_evolution")


# --- warehouse table semantics -------------------------------------------------------------------
@register("ctas_if_not_exists", with_views("clubs") + "SELECT * FROM clubs")
def q_ctas_if_not_exists(spark, sf):
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    first = td.clubs(spark, sf)
    wh.ctas_if_absent("clubs", first)
    wh.ctas_if_absent("clubs", first.withColumn("name", F.upper("name")))  # no effect: first load wins
    return wh.read("clubs")


REPLACED_MONTH = "1998-03"


@register("month_replace", with_views("valuations") + LOADED_VALUATIONS_SQL.replace(
    "CAST(market_value AS FLOAT) AS market_value",
    f"CAST(CASE WHEN strftime(date, '%Y-%m') = '{REPLACED_MONTH}' THEN market_value * 2 ELSE market_value END"
    " AS FLOAT) AS market_value"))
def q_month_replace(spark, sf):
    wh = _load_valuations(spark, sf)
    fresh = pipeline.valuation_load_rows(td.valuations(spark, sf), td.START, td.END)
    fresh = fresh.withColumn("market_value", F.col("market_value") * 2)
    wh.replace_month("player_valuations", fresh, REPLACED_MONTH, on_empty="delete")
    return _loaded_text(wh.read("player_valuations"))


@register("month_replace_empty", with_views("valuations") + LOADED_VALUATIONS_SQL
          + f" AND strftime(date, '%Y-%m') <> '{REPLACED_MONTH}'")
def q_month_replace_empty(spark, sf):
    wh = _load_valuations(spark, sf)
    empty = pipeline.valuation_load_rows(td.valuations(spark, sf), td.START, td.END).limit(0)
    wh.replace_month("player_valuations", empty, REPLACED_MONTH, on_empty="delete")
    return _loaded_text(wh.read("player_valuations"))


@register("month_replace_keep", STORED_LVE_SQL)
def q_month_replace_keep(spark, sf):
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    v, c = td.valuations(spark, sf), td.clubs(spark, sf)
    pipeline.backfill_league_rollup(wh, v, c, td.START, td.END)
    empty = rollups.league_valuation_evolution(v, c, td.START, td.END).limit(0)
    wh.replace_month("league_valuation_evolution", empty, "1998-03-01", on_empty="keep")
    return wh.read("league_valuation_evolution")


# --- report parts --------------------------------------------------------------------------------
def _base(spark, sf) -> DataFrame:
    return materialize(reports.report_base(_rollup(spark, sf), td.competitions(spark, sf), td.CUTOFF))


BASE_COLUMNS = ["domestic_competition_id", "total_valuation", "max_valuation", "partition_date",
                "competition_name", "country_name", "year"]


@register("first_tier_join", with_views("lve", "competitions") + """SELECT l.domestic_competition_id,
    l.total_valuation, l.max_valuation, l.partition_date, c.name AS competition_name, c.country_name
    FROM lve l JOIN competitions c ON l.domestic_competition_id = c.competition_id
    WHERE c.sub_type = 'first_tier' ORDER BY l.partition_date""")
def q_first_tier_join(spark, sf):
    rows = reports.first_tier_months(_rollup(spark, sf), td.competitions(spark, sf))
    return rows.orderBy(F.asc_nulls_last("partition_date"))


@register("latest_year_slice", with_views("base") + f"""SELECT {', '.join(BASE_COLUMNS)} FROM base
    WHERE year = (SELECT max(year) FROM base)""")
def q_latest_year_slice(spark, sf):
    return reports.latest_year_slice(_base(spark, sf)).select(*BASE_COLUMNS)


@register("league_count", with_views("base") + """SELECT CAST(count(DISTINCT domestic_competition_id) AS INTEGER)
    AS league_count, CAST(max(year) AS INTEGER) AS latest_year FROM base""")
def q_league_count(spark, sf):
    base = _base(spark, sf)
    return base.agg(F.count_distinct(reports.ID).cast("int").alias("league_count"),
                    F.max("year").cast("int").alias("latest_year"))


@register("top_leagues_total", with_views("base") + top_sql("total_valuation", 5))
def q_top_leagues_total(spark, sf):
    return reports.top_leagues(_base(spark, sf), "total_valuation", 5)


@register("top_leagues_max", with_views("base") + top_sql("max_valuation", 7))
def q_top_leagues_max(spark, sf):
    return reports.top_leagues(_base(spark, sf), "max_valuation", 7)


@register("league_year_rollup", with_views("yearly") + "SELECT * FROM yearly")
def q_league_year_rollup(spark, sf):
    return reports.league_year_rollup(_base(spark, sf))


@register("other_bucket", report_sql("total_valuation", 5).split("report AS (")[0].rstrip().rstrip(",")
          + "\nSELECT domestic_competition_id, year, total_valuation, competition_name, country_name FROM other")
def q_other_bucket(spark, sf):
    base = _base(spark, sf)
    top = reports.top_leagues(base, "total_valuation", 5)
    return reports.other_bucket(reports.league_year_rollup(base), top, "total_valuation", reports.league_count(base))


@register("union_missing", report_sql("max_valuation", 7).split("SELECT *, competition_name ||")[0]
          + "SELECT * FROM report")
def q_union_missing(spark, sf):
    base = _base(spark, sf)
    top = reports.top_leagues(base, "max_valuation", 7)
    yearly = reports.league_year_rollup(base)
    kept = reports.keep_members(yearly, top.select(reports.ID), reports.ID, bounded=True)
    other = reports.other_bucket(yearly, top, "max_valuation", reports.league_count(base))
    return kept.unionByName(other, allowMissingColumns=True)


def _chart_sql(body: str) -> str:
    return report_sql("total_valuation", 5).replace(
        "SELECT *, competition_name || ' (' || country_name || ')' AS league_label FROM report",
        ", labelled AS (SELECT *, competition_name || ' (' || country_name || ')' AS league_label FROM report)\n"
        + body)


@register("legend_order", _chart_sql("""SELECT league_label, domestic_competition_id, s AS total_valuation,
    CAST(row_number() OVER (ORDER BY s DESC NULLS LAST, league_label, domestic_competition_id) AS INTEGER)
      AS position
    FROM (SELECT league_label, domestic_competition_id, max(total_valuation) AS s FROM labelled
      WHERE league_label IS NOT NULL GROUP BY 1, 2)"""))
def q_legend_order(spark, sf):
    return reports.legend_order(_report(spark, sf, "total_valuation", 5), "total_valuation")


@register("legend_logos", _chart_sql("""SELECT l.*, CASE WHEN s.competition_id IS NOT NULL
        THEN 'data/logos/leagues/' || l.domestic_competition_id || '.png'
        ELSE 'data/logos/leagues/default.png' END AS logo_path
    FROM (SELECT league_label, domestic_competition_id, s AS total_valuation,
        CAST(row_number() OVER (ORDER BY s DESC NULLS LAST, league_label, domestic_competition_id) AS INTEGER)
          AS position
      FROM (SELECT league_label, domestic_competition_id, max(total_valuation) AS s FROM labelled
        WHERE league_label IS NOT NULL GROUP BY 1, 2)) l
    LEFT JOIN (SELECT DISTINCT CAST(item_id AS VARCHAR) AS competition_id FROM benchmark) s
      ON l.domestic_competition_id = s.competition_id"""))
def q_legend_logos(spark, sf):
    """Legend of the total-value report with each league's logo file, or the
    default logo where none is stored (stored ids stand in as ``benchmark`` ids)."""
    legend = reports.legend_order(_report(spark, sf, "total_valuation", 5), "total_valuation")
    stored = td.table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("competition_id"))
    return reports.legend_logos(legend, stored)


@register("series_mean", _chart_sql("""SELECT league_label, year, avg(total_valuation) AS total_valuation
    FROM labelled WHERE league_label IS NOT NULL GROUP BY 1, 2"""))
def q_series_mean(spark, sf):
    return reports.series_mean(_report(spark, sf, "total_valuation", 5), "total_valuation")


@register("series_mean_repeated", with_views("base") + """, r AS (SELECT domestic_competition_id AS league_label, year,
    total_valuation FROM base WHERE total_valuation IS NOT NULL)
    SELECT league_label, year, round(avg(total_valuation), 4) AS total_valuation FROM r GROUP BY 1, 2""")
def q_series_mean_repeated(spark, sf):
    """A series with a value per month drawn by year: each point is the mean of the months."""
    base = reports.report_base(_rollup(spark, sf), td.competitions(spark, sf), td.CUTOFF)
    series = base.withColumn("league_label", F.col("domestic_competition_id"))
    return reports.series_mean(series, "total_valuation").withColumn("total_valuation", F.round("total_valuation", 4))


@register("player_valuation_stats", with_views("valuations", "players", "clubs") + """
    SELECT p.player_id, p.name,
        CAST(sum(CAST(v.market_value AS DECIMAL(18,2))) AS DOUBLE) / count(v.market_value) AS avg_valuation,
        max(v.market_value) AS max_valuation, min(v.market_value) AS min_valuation, c.name AS club_name
    FROM valuations v JOIN players p ON v.player_id = p.player_id JOIN clubs c ON v.current_club_id = c.club_id
    GROUP BY p.player_id, p.name, c.name""")
def q_player_valuation_stats(spark, sf):
    return reports.player_valuation_stats(td.valuations(spark, sf), td.players(spark, sf), td.clubs(spark, sf))


@register("club_ordinal", with_views("valuations", "players", "clubs") + """, top AS (
    SELECT p.player_id, p.name,
        CAST(sum(CAST(v.market_value AS DECIMAL(18,2))) AS DOUBLE) / count(v.market_value) AS avg_valuation,
        c.name AS club_name
    FROM valuations v JOIN players p ON v.player_id = p.player_id JOIN clubs c ON v.current_club_id = c.club_id
    GROUP BY p.player_id, p.name, c.name
    ORDER BY avg_valuation DESC NULLS LAST, p.player_id, p.name NULLS LAST, c.name NULLS LAST LIMIT 100),
    ranked AS (SELECT club_name, row_number() OVER (ORDER BY avg_valuation DESC NULLS LAST, player_id,
        name NULLS LAST, club_name NULLS LAST) AS position FROM top),
    firsts AS (SELECT club_name, CAST(min(position) AS INTEGER) AS first_position FROM ranked GROUP BY club_name)
    SELECT club_name, first_position,
        CAST(row_number() OVER (ORDER BY first_position) - 1 AS INTEGER) AS color_index FROM firsts""")
def q_club_ordinal(spark, sf):
    top = reports.player_top100(td.valuations(spark, sf), td.players(spark, sf), td.clubs(spark, sf))
    return reports.club_ordinal(top)


TOP100_SQL = """top AS (
    SELECT p.player_id, p.name,
        CAST(sum(CAST(v.market_value AS DECIMAL(18,2))) AS DOUBLE) / count(v.market_value) AS avg_valuation,
        c.name AS club_name
    FROM valuations v JOIN players p ON v.player_id = p.player_id JOIN clubs c ON v.current_club_id = c.club_id
    GROUP BY p.player_id, p.name, c.name
    ORDER BY avg_valuation DESC NULLS LAST, p.player_id, p.name NULLS LAST, c.name NULLS LAST LIMIT 100)"""


@register("player_bars", with_views("valuations", "players", "clubs") + ", " + TOP100_SQL + """,
    ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY avg_valuation DESC NULLS LAST, player_id,
        name NULLS LAST, club_name NULLS LAST) AS INTEGER) AS position FROM top),
    firsts AS (SELECT club_name, min(position) AS first_position FROM ranked GROUP BY club_name),
    colours AS (SELECT club_name, CAST(row_number() OVER (ORDER BY first_position) - 1 AS INTEGER) AS color_index
        FROM firsts)
    SELECT r.player_id, r.name, r.club_name, r.avg_valuation, r.position,
        CAST(count(*) OVER () - r.position AS INTEGER) AS bar_index, c.color_index,
        CAST(CAST(round_even(r.avg_valuation / 1000000.0, 0) AS BIGINT) AS VARCHAR) || 'M' AS value_label
    FROM ranked r LEFT JOIN colours c ON r.club_name IS NOT DISTINCT FROM c.club_name""")
def q_player_bars(spark, sf):
    top = reports.player_top100(td.valuations(spark, sf), td.players(spark, sf), td.clubs(spark, sf))
    return reports.player_bars(top)


# --- text functions -------------------------------------------------------------------------------
@register("slug_title", """SELECT p_partkey, slug,
    array_to_string(list_transform(string_split(slug, '-'),
        lambda s: upper(substring(s, 1, 1)) || lower(substring(s, 2))), ' ') AS title
    FROM (SELECT p_partkey, p_name || '-' || p_type || '--' || p_brand AS slug FROM part)""")
def q_slug_title(spark, sf):
    p = td.table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit("-"), "p_type", F.lit("--"), "p_brand").alias("slug"))
    return p.withColumn("title", text.slug_title("slug"))


@register("humanize", with_views("lve") + """SELECT domestic_competition_id, partition_date, total_valuation,
    CAST(CAST(round_even(total_valuation / 1000000000.0, 0) AS BIGINT) AS VARCHAR) || 'B' AS total_billions,
    CAST(CAST(round_even(total_valuation / 1000000.0, 0) AS BIGINT) AS VARCHAR) || 'M' AS total_millions,
    CAST(CAST(round_even(max_valuation / 1000.0, 0) AS BIGINT) AS VARCHAR) || 'K' AS max_thousands
    FROM lve""")
def q_humanize(spark, sf):
    lve = _rollup(spark, sf)
    return lve.select("domestic_competition_id", "partition_date", "total_valuation",
                      text.humanize("total_valuation", 1_000_000_000).alias("total_billions"),
                      text.humanize("total_valuation", 1_000_000).alias("total_millions"),
                      text.humanize("max_valuation", 1_000).alias("max_thousands"))


@register("base64_embed", """SELECT page_id,
    '![Image](data:image/jpeg;base64,' || to_base64(encode(html)) || ')' AS markdown FROM pages""")
def q_base64_embed(spark, sf):
    pg = td.pages(spark, sf)
    return pg.select("page_id", text.data_uri_markdown(spark, F.col("html").cast("binary")).alias("markdown"))


# --- pages and logos --------------------------------------------------------------------------------
LEAGUE_PAGES_SQL = "SELECT DISTINCT CAST(page_id AS VARCHAR) AS competition_id, url FROM pages"


def _league_pages(spark, sf) -> DataFrame:
    return td.pages(spark, sf).select(F.col("page_id").cast("string").alias("competition_id"), "url")


@register("distinct_urls", LEAGUE_PAGES_SQL)
def q_distinct_urls(spark, sf):
    return page_ops.distinct_urls(_league_pages(spark, sf))


@register("pending_logos", f"""SELECT competition_id, url, 'data/logos/leagues/' || competition_id || '.png'
    AS logo_path FROM ({LEAGUE_PAGES_SQL})
    WHERE competition_id NOT IN (SELECT CAST(item_id AS VARCHAR) FROM benchmark WHERE item_id IS NOT NULL)""")
def q_pending_logos(spark, sf):
    done = td.table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("competition_id"))
    return page_ops.logo_paths(page_ops.pending(page_ops.distinct_urls(_league_pages(spark, sf)), done))


EXTRACT_SQL = r"""SELECT page_id, url,
    CASE WHEN status = 'ok' THEN link END AS link, status FROM (
    SELECT page_id, url, link,
      CASE WHEN nav IS NULL THEN 'no_container' WHEN a_tag IS NULL THEN 'no_child'
           WHEN link IS NULL OR link = '' THEN 'no_attr' ELSE 'ok' END AS status
    FROM (SELECT *, nullif(regexp_extract(a_tag, '\shref\s*=\s*"([^"]*)"', 1), '') AS link FROM (
      SELECT *, nullif(regexp_extract(nav, '<a(\s[^>]*)?>', 0), '') AS a_tag FROM (
        SELECT page_id, url,
          nullif(regexp_extract(html, '(?s)<nav(\s[^>]*)?>(.*?)(</nav>|$)', 2), '') AS nav_body,
          CASE WHEN regexp_matches(html, '<nav(\s[^>]*)?>') THEN
            coalesce(regexp_extract(html, '(?s)<nav(\s[^>]*)?>(.*?)(</nav>|$)', 2), '') END AS nav
        FROM pages))))"""


@register("extract_link", EXTRACT_SQL)
def q_extract_link(spark, sf):
    return page_ops.extract_links(td.pages(spark, sf), container="nav", css_class=None, child="a", attr="href")


# --- incremental loads (Structured Streaming) -------------------------------------------------------
@register("stream_league_rollup", STORED_LVE_SQL)
def q_stream_league_rollup(spark, sf):
    """Valuations arrive in two halves that both span every month; the second
    run brings late rows for months the first one already loaded. The stored
    rollup must equal a full batch run."""
    source, checkpoint = shared_path(spark, "stream_source"), shared_path(spark, "stream_checkpoint")
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    for half in _valuation_halves(spark, sf):
        half.write.mode("append").parquet(source)
        month_stream.run_available(spark, source, half.schema, wh, td.clubs(spark, sf), td.START, td.END, checkpoint)
    return wh.read("league_valuation_evolution")


def _valuation_halves(spark, sf):
    """The valuations of lines 1 to 3, and the rest."""
    v = td.table(spark, sf, "lineitem")
    early = F.coalesce(F.col("l_linenumber") <= 3, F.lit(False))
    return [v.where(part).select(
        F.col("l_partkey").alias("player_id"), F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("market_value"), F.col("l_suppkey").alias("current_club_id"),
        F.col("l_returnflag").alias("competition_id")) for part in (early, ~early)]


@register("stream_two_sources", ORACLES["stream_league_rollup"])
def q_stream_two_sources(spark, sf):
    """Two streams, each with its own source and checkpoint, load one warehouse."""
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    for half in _valuation_halves(spark, sf):
        source = shared_path(spark, "stream_source")
        half.write.parquet(source)
        month_stream.run_available(spark, source, half.schema, wh, td.clubs(spark, sf), td.START, td.END,
                                   shared_path(spark, "stream_checkpoint"))
    return wh.read("league_valuation_evolution")


# --- changed months, late rows ---------------------------------------------------------------------------
CHANGED_MONTH = "1996-03"
CHANGED_VIEWS = {"valuations": VIEWS["valuations"] + f""" UNION ALL SELECT l_partkey, CAST(l_shipdate AS DATE),
    l_extendedprice * 2, l_suppkey, l_returnflag FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') = '{CHANGED_MONTH}'"""}


@register("backfill_changed_only", STORED_LVE_SQL.replace(VIEWS["valuations"], CHANGED_VIEWS["valuations"]).replace(
    "player_count, partition_date FROM lve", f"""player_count, partition_date,
    partition_date = '{CHANGED_MONTH}-01' AS recomputed FROM lve"""))
def q_backfill_changed_only(spark, sf):
    """A second backfill, after one month got further rows, computes that month alone."""
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    v, c = td.valuations(spark, sf), td.clubs(spark, sf)
    pipeline.backfill_changed(wh, v, c, td.START, td.END)
    more = v.where(months.month_key("date") == CHANGED_MONTH).withColumn("market_value", F.col("market_value") * 2)
    again = pipeline.backfill_changed(wh, v.unionByName(more), c, td.START, td.END)
    return wh.read("league_valuation_evolution").withColumn(
        "recomputed", F.substring("partition_date", 1, 7).isin(again))


def _late_rows(spark, sf) -> Warehouse:
    """Rollups of one half of the valuations, to which the other half, of the same months, comes late, and twice."""
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    early, late = _valuation_halves(spark, sf)
    clubs = td.clubs(spark, sf)
    rollup_state.rebuild(wh, early, td.START, td.END)
    for _ in range(2):  # a batch that is added again counts once
        pipeline.add_late_valuations(wh, late, clubs, "late-1", td.START, td.END)
    return wh


@register("rollup_late_rows", STORED_LVE_SQL)
def q_rollup_late_rows(spark, sf):
    return _late_rows(spark, sf).read("league_valuation_evolution")


@register("rollup_late_rows_clubs", with_views("cve") + """SELECT club_name,
    CAST(total_valuation AS FLOAT) AS total_valuation, CAST(min_valuation AS FLOAT) AS min_valuation,
    CAST(max_valuation AS FLOAT) AS max_valuation, squad_size, domestic_competition_id, partition_date FROM cve""")
def q_rollup_late_rows_clubs(spark, sf):
    return _late_rows(spark, sf).read("club_valuation_evolution")


# --- the whole pipeline, from raw CSV files ------------------------------------------------------------
RAW_CSV_SPARK = {
    "player_valuations": ("lineitem", {
        "player_id": "CAST(l_partkey AS STRING)",
        "date": "date_format(l_shipdate, 'yyyy-MM-dd')",
        "market_value_in_eur": "CAST(CAST(rint(l_extendedprice * 100) AS BIGINT) AS STRING)",
        "current_club_id": "CAST(l_suppkey AS STRING)",
        "player_club_domestic_competition_id": "l_returnflag"}),
    "clubs": ("supplier", {
        "club_id": "CAST(s_suppkey AS STRING)", "name": "s_name",
        "domestic_competition_id": "CAST(s_nationkey AS STRING)",
        "total_market_value": "CAST(CAST(rint(s_acctbal) AS BIGINT) AS STRING)",
        "average_age": "CAST(s_acctbal AS STRING)", "foreigners_percentage": "'n/a'"}),
    "players": ("part", {"player_id": "CAST(p_partkey AS STRING)", "name": "p_name"}),
    "appearances": ("events", {
        "appearance_id": "CAST(event_id AS STRING)", "game_id": "CAST(event_id AS STRING)",
        "player_id": "CAST(user_id AS STRING)", "player_club_id": "CAST(user_id AS STRING)",
        "player_current_club_id": "CAST(user_id AS STRING)", "date": "date_format(ts, 'yyyy-MM-dd')",
        "player_name": "event_type", "competition_id": "event_type", "yellow_cards": "'0'",
        "red_cards": "'0'", "goals": "CAST(length(props) AS STRING)", "assists": "'0'",
        "minutes_played": "CAST(CAST(value AS BIGINT) AS STRING)"}),
    "games": ("orders", {"game_id": "CAST(o_orderkey AS STRING)", "date": "date_format(o_orderdate, 'yyyy-MM-dd')",
                         "home_club_id": "CAST(o_custkey AS STRING)", "round": "o_orderpriority"}),
}

STORED_PIPELINE_VIEWS = {
    "valuations": """SELECT l_partkey AS player_id, CAST(l_shipdate AS DATE) AS date,
        CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS FLOAT) AS market_value, l_suppkey AS current_club_id,
        l_returnflag AS competition_id FROM lineitem""",
    "lve": """SELECT domestic_competition_id,
        CAST(CAST(coalesce(sum(CAST(market_value AS DECIMAL(18,2))), 0) AS DOUBLE) AS FLOAT) AS total_valuation,
        min(market_value) AS min_valuation, max(market_value) AS max_valuation,
        CAST(count(market_value) AS INTEGER) AS player_count,
        strftime(date, '%Y-%m-01') AS partition_date
        FROM vrows WHERE domestic_competition_id IS NOT NULL GROUP BY 1, 6""",
}


def write_raw_csvs(spark: SparkSession, sf: str, raw_dir: str) -> None:
    """The six raw datasets as CSV files with a header, derived from the given tables."""
    frames = {dataset: td.table(spark, sf, table).select([F.expr(e).alias(n) for n, e in columns.items()])
              for dataset, (table, columns) in RAW_CSV_SPARK.items()}
    comp = td.competitions(spark, sf).withColumn("url", F.concat(F.lit("https://leagues.example/"),
                                                                 F.col("competition_id")))
    together(*[lambda dataset=dataset, df=df: df.write.mode("overwrite").option("header", True).csv(
        f"{raw_dir}/{pipeline.RAW_FILES[dataset]}") for dataset, df in (frames | {"competitions": comp}).items()])


@register("pipeline_first_league_total", report_sql("total_valuation", 5, STORED_PIPELINE_VIEWS))
def q_pipeline_first_league_total(spark, sf):
    return _pipeline_result(spark, sf).first_league_total


@register("pending_logo_links", "SELECT competition_id, e.url, link, status FROM (" + EXTRACT_SQL + """) e
    JOIN (""" + LEAGUE_PAGES_SQL + """) c ON e.url = c.url
    WHERE competition_id NOT IN (SELECT CAST(item_id AS VARCHAR) FROM benchmark WHERE item_id IS NOT NULL)""")
def q_pending_logo_links(spark, sf):
    """Fetch step of the logo flow on stored pages: targets without a stored
    logo, their page, and the link found on it."""
    done = td.table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("competition_id"))
    targets = page_ops.distinct_urls(_league_pages(spark, sf))
    return page_ops.pending_links(targets, done, td.pages(spark, sf), container="nav", css_class=None,
                                  child="a", attr="href")


EXTRACT_BY_CLASS_SQL = r"""SELECT page_id, url, CASE WHEN status = 'ok' THEN link END AS link, status FROM (
    SELECT page_id, url, link,
      CASE WHEN body IS NULL THEN 'no_container' WHEN img IS NULL THEN 'no_child'
           WHEN link IS NULL THEN 'no_attr' ELSE 'ok' END AS status
    FROM (SELECT *, nullif(regexp_extract(img, '\ssrc\s*=\s*"([^"]*)"', 1), '') AS link FROM (
      SELECT *, nullif(regexp_extract(body, '<img(\s[^>]*)?>', 0), '') AS img FROM (
        SELECT page_id, url,
          CASE WHEN regexp_matches(html, '<div\s[^>]*class="([^"]*\s)?ad(\s[^"]*)?"') THEN
            coalesce(regexp_extract(html,
              '(?s)<div\s[^>]*class="(?:[^"]*\s)?ad(?:\s[^"]*)?"[^>]*>(.*?)(</div>|$)', 1), '') END AS body
        FROM pages))))"""


@register("extract_by_class", EXTRACT_BY_CLASS_SQL)
def q_extract_by_class(spark, sf):
    """The reference's shape (a div picked by class token, its first img, the src) on the
    test pages, whose only classed div holds no image."""
    return page_ops.extract_links(td.pages(spark, sf), container="div", css_class="ad", child="img", attr="src")


# --- month replacement and reads that must not lose rows --------------------------------------------
@register("month_replace_self", with_views("valuations") + LOADED_VALUATIONS_SQL.replace(
    "CAST(market_value AS FLOAT) AS market_value",
    f"CAST(CASE WHEN strftime(date, '%Y-%m') = '{REPLACED_MONTH}' THEN market_value * 2 ELSE market_value END"
    " AS FLOAT) AS market_value"))
def q_month_replace_self(spark, sf):
    """A stored month replaced by rows computed from itself."""
    wh = _load_valuations(spark, sf)
    doubled = wh.read("player_valuations").withColumn("market_value", F.col("market_value") * 2)
    wh.replace_month("player_valuations", doubled, REPLACED_MONTH, on_empty="delete")
    return _loaded_text(wh.read("player_valuations"))


@register("month_range_only", with_views("valuations") + LOADED_VALUATIONS_SQL.replace(
    "CAST(market_value AS FLOAT) AS market_value",
    "CAST(CASE WHEN date >= DATE '1998-03-01' AND date < DATE '1998-05-01' THEN market_value * 2 ELSE market_value END"
    " AS FLOAT) AS market_value"))
def q_month_range_only(spark, sf):
    """A frame of all months, written for two of them: the others keep their stored rows."""
    wh = _load_valuations(spark, sf)
    fresh = pipeline.valuation_load_rows(td.valuations(spark, sf), td.START, td.END)
    wh.replace_months("player_valuations", fresh.withColumn("market_value", F.col("market_value") * 2),
                      on_empty="delete", start="1998-03-01", end="1998-05-01")
    return _loaded_text(wh.read("player_valuations"))


@register("month_resplit_shrunk", with_views("valuations") + LOADED_VALUATIONS_SQL
          + f" AND strftime(date, '%Y-%m') <> '{REPLACED_MONTH}'")
def q_month_resplit_shrunk(spark, sf):
    """Split and load twice; the second time the raw data has lost a month."""
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    wh.create_table("player_valuations")
    raw, folder = td.valuations(spark, sf), wh.location("raw/valuation_partitions")
    for rows in (raw, raw.where(F.date_format("date", "yyyy-MM") != REPLACED_MONTH)):
        ingest.split_by_month(rows, "date", folder)
        wh.replace_months("player_valuations",
                          pipeline.valuation_load_rows(ingest.read_months(spark, folder), td.START, td.END),
                          on_empty="delete", start=td.START, end=td.END)
    return _loaded_text(wh.read("player_valuations"))


@register("csv_quoted_text", """SELECT doc_id, lang || ' "' || source || '", ' || chr(10) || '"x"' AS name FROM documents""")
def q_csv_quoted_text(spark, sf):
    """Quotes, commas and line breaks inside quoted cells survive the CSV scan."""
    path = shared_path(spark, "csv-quoted")
    name = F.concat("lang", F.lit(' "'), "source", F.lit('", \n"x"'))
    td.table(spark, sf, "documents").select("doc_id", name.alias("name")).write \
        .option("header", True).option("escape", '"').csv(path)
    return ingest.read_csv_text(spark, path, multi_line=True).select(F.col("doc_id").cast("long").alias("doc_id"), "name")


@register("pending_logo_links_shared", "SELECT competition_id || s.suffix AS competition_id, e.url, link, status FROM ("
          + EXTRACT_SQL + """) e JOIN (""" + LEAGUE_PAGES_SQL + """) c ON e.url = c.url
    CROSS JOIN (VALUES ('a'), ('b'), ('c')) s(suffix)""")
def q_pending_logo_links_shared(spark, sf):
    """Three competitions share every page: one row each, every page parsed once."""
    targets = page_ops.distinct_urls(_league_pages(spark, sf)).withColumn(
        "competition_id", F.explode(F.transform(F.array(F.lit("a"), F.lit("b"), F.lit("c")),
                                                lambda s: F.concat("competition_id", s))))
    done = targets.limit(0)
    return page_ops.pending_links(targets, done, td.pages(spark, sf), container="nav", css_class=None,
                                  child="a", attr="href")


@register("half_open_next_month", """SELECT l_orderkey, l_linenumber,
    strftime(l_shipdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
    date_trunc('month', l_shipdate) = DATE '1998-03-01' AS in_march FROM lineitem WHERE l_shipdate IS NOT NULL""")
def q_half_open_next_month(spark, sf):
    lines = td.table(spark, sf, "lineitem").where(F.col("l_shipdate").isNotNull())
    return lines.select("l_orderkey", "l_linenumber",
                        F.date_format(months.next_month("l_shipdate"), "yyyy-MM-dd").alias("next_month"),
                        months.half_open_month("l_shipdate", F.lit("1998-03-01")).alias("in_march"))


@register("sql_view_insert", with_views("valuations") + LOADED_VALUATIONS_SQL)
def q_sql_view_insert(spark, sf):
    """Rows registered as a view, inserted by SELECT from it, the view dropped after."""
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    wh.create_table("player_valuations")
    with wh.frame_view(pipeline.valuation_load_rows(td.valuations(spark, sf), td.START, td.END)) as view:
        wh.insert_select("player_valuations", f"SELECT * FROM {view}")
    return _loaded_text(wh.read("player_valuations"))


# --- stored rollups, fine sums, further inputs ---------------------------------------------------------
@register("club_rollup_stored", with_views("cve") + """SELECT club_name, CAST(total_valuation AS FLOAT) AS total_valuation,
    CAST(min_valuation AS FLOAT) AS min_valuation, CAST(max_valuation AS FLOAT) AS max_valuation,
    squad_size, domestic_competition_id, partition_date FROM cve""")
def q_club_rollup_stored(spark, sf):
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    pipeline.backfill_club_rollup(wh, td.valuations(spark, sf), td.clubs(spark, sf), td.START, td.END)
    return wh.read("club_valuation_evolution")


WHOLE_EUROS = {"valuations": VIEWS["valuations"].replace("l_extendedprice", "round_even(l_extendedprice, 0)")}


@register("league_rollup_stored", STORED_LVE_SQL.replace(VIEWS["valuations"], WHOLE_EUROS["valuations"]))
def q_league_rollup_stored(spark, sf):
    """The rollup of months read from the partitioned base table."""
    wh = Warehouse(spark, shared_path(spark, "warehouse"))
    wh.create_table("player_valuations")
    whole = td.valuations(spark, sf).withColumn("market_value", F.rint("market_value"))
    wh.replace_months("player_valuations", pipeline.valuation_load_rows(whole, td.START, td.END),
                      on_empty="delete", start=td.START, end=td.END)
    pipeline.backfill_league_rollup(wh, wh.read("player_valuations"), td.clubs(spark, sf), td.START, td.END)
    return wh.read("league_valuation_evolution")


@register("league_rollup_fine", with_views("lve", overrides={
    "valuations": VIEWS["valuations"].replace("l_extendedprice", "l_extendedprice / 10000"),
    "lve": VIEWS["lve"].replace("DECIMAL(18,2)", "DECIMAL(18,6)")}) + "SELECT * FROM lve")
def q_league_rollup_fine(spark, sf):
    """Values with six decimals, summed without loss."""
    fine = td.valuations(spark, sf).withColumn("market_value", F.col("market_value") / 10000)
    return rollups.league_valuation_evolution(fine, td.clubs(spark, sf), td.START, td.END)


@register("player_stats_nan", ORACLES["player_valuation_stats"].replace(
    "l_extendedprice AS market_value", "CASE WHEN day(l_shipdate) > 10 THEN l_extendedprice END AS market_value"))
def q_player_stats_nan(spark, sf):
    """Values that are not a number count as missing."""
    some = td.valuations(spark, sf).withColumn("market_value", F.when(
        F.dayofmonth("date") > 10, F.col("market_value")).otherwise(F.lit(float("nan"))))
    return reports.player_valuation_stats(some, td.players(spark, sf), td.clubs(spark, sf))


@register("csv_datetime_layout", """SELECT l_partkey AS player_id,
    strftime(l_shipdate + to_hours(l_linenumber), '%Y-%m-%d %H:%M:%S') AS date, l_suppkey AS current_club_id,
    CASE WHEN l_linenumber <> 2 THEN l_returnflag END AS player_club_domestic_competition_id FROM lineitem""")
def q_csv_datetime_layout(spark, sf):
    """CSV dates with a time of day, and cells that mark a missing value."""
    path = shared_path(spark, "csv-layout")
    td.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("player_id"),
        F.date_format(F.expr("timestampadd(HOUR, l_linenumber, CAST(l_shipdate AS TIMESTAMP_NTZ))"),
                      "dd.MM.yyyy HH:mm:ss").alias("date"),
        F.col("l_suppkey").alias("current_club_id"),
        F.when(F.col("l_linenumber") == 2, F.lit("N/A")).otherwise(F.col("l_returnflag"))
        .alias("player_club_domestic_competition_id")).write.option("header", True).csv(path)
    typed = ingest.load_dataset(spark, path, "player_valuations", date_format="dd.MM.yyyy HH:mm:ss")
    return typed.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


GAME_TYPES = {"game_id": "long", "home_club_id": "long", "home_club_goals": "double", "date": "timestamp"}


@register("games_typed", """SELECT home_club_id, count(*) AS games, sum(home_club_goals) AS goals,
    min(date) AS first_date, max(game_id) AS last_game FROM (SELECT o_orderkey AS game_id, o_custkey AS home_club_id,
      CAST(o_orderkey % 7 AS DOUBLE) AS home_club_goals, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders)
    GROUP BY home_club_id""")
def q_games_typed(spark, sf):
    """Columns of ``games`` with declared kinds add up and sort as numbers and dates."""
    path = shared_path(spark, "csv-games")
    td.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("game_id"), F.col("o_custkey").alias("home_club_id"),
        (F.col("o_orderkey") % 7).alias("home_club_goals"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")
    ).write.option("header", True).csv(path)
    games = ingest.load_dataset(spark, path, "games", types=GAME_TYPES)
    return games.groupBy("home_club_id").agg(
        F.count("*").alias("games"), F.sum("home_club_goals").alias("goals"),
        F.date_format(F.min("date"), "yyyy-MM-dd").alias("first_date"), F.max("game_id").alias("last_game"))


GAMES_INFERRED_SQL = """SELECT o_orderkey AS game_id,
    CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS home_club_id, o_totalprice AS attendance,
    o_orderstatus = 'F' AS played, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS neutral,
    strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(NULL AS DOUBLE) AS season,
    CAST(o_orderkey AS VARCHAR) || '0000000000000000000' AS wide_id,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END AS round,
    'bigint,double,double,boolean,string,string,double,string,string' AS types FROM orders"""


@register("games_inferred", GAMES_INFERRED_SQL.replace(
    "ELSE o_orderkey % 2 = 0 END", "WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END"))
def q_games_inferred(spark, sf):
    """Columns of ``games`` without a declared kind: each gets the type the loader gives its cells."""
    path = shared_path(spark, "csv-games-inferred")
    td.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS game_id", "CASE WHEN o_custkey % 11 = 0 THEN 'N/A' ELSE CAST(o_custkey AS STRING) END AS home_club_id",
        "o_totalprice AS attendance", "CASE WHEN o_orderstatus = 'F' THEN 'TRUE' ELSE 'False' END AS played",
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS neutral",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS date", "'nan' AS season",
        "concat(o_orderkey, '0000000000000000000') AS wide_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS STRING) ELSE o_orderpriority END AS round"
    ).write.option("header", True).csv(path)
    games = ingest.load_dataset(spark, path, "games")
    return games.withColumn("types", F.concat_ws(",", *[F.typeof(n) for n in games.columns]))


@register("csv_layout_found", with_views("valuations") + """SELECT player_id, CAST(date AS VARCHAR) AS date, layout
    FROM valuations, (SELECT unnest(['text month', 'time of day', 'day first']) AS layout)""")
def q_csv_layout_found(spark, sf):
    """Three files, each with a date layout of its own that no option names; the third is ambiguous until all
    cells vote."""
    parts = None
    for name, layout, rule in (("text month", "MMM d, yyyy", "first"), ("time of day", "yyyy-MM-dd HH:mm:ss", "first"),
                               ("day first", "dd/MM/yyyy", "vote")):
        path = shared_path(spark, "csv-layouts")
        td.valuations(spark, sf).select("player_id", F.date_format("date", layout).alias("date")) \
            .write.option("header", True).csv(path)
        part = ingest.load_dataset(spark, path, "player_valuations", layout_rule=rule).select(
            "player_id", F.date_format("date", "yyyy-MM-dd").alias("date"), F.lit(name).alias("layout"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _pipeline_result(spark, sf) -> pipeline.RunResult:
    """One run of the whole pipeline, from the tables as they are now: no run is kept for another query of the session."""
    raw_dir = shared_path(spark, "raw")
    write_raw_csvs(spark, sf, raw_dir)
    return pipeline.run(spark, raw_dir, shared_path(spark, "warehouse"), td.START, td.END, td.CUTOFF)


@register("pipeline_first_league_max", report_sql("max_valuation", 7, STORED_PIPELINE_VIEWS))
def q_pipeline_first_league_max(spark, sf):
    return _pipeline_result(spark, sf).first_league_max


@register("pipeline_top100", ORACLES["player_top100"].replace(
    VIEWS["valuations"], STORED_PIPELINE_VIEWS["valuations"]
    + f" WHERE l_shipdate >= DATE '{td.START}' AND l_shipdate < DATE '{td.END}'"))
def q_pipeline_top100(spark, sf):
    return _pipeline_result(spark, sf).player_top100


# Logo boxes put before the given pages: one with a logo, one whose image has no source, one without an image, none.
LOGO_BOXES = ["'<div class=\"row logo-box\"><img alt=\"x\" src=\"logos/' || page_id || '.png\"></div>'",
              "'<div class=\"logo-box\"><img alt=\"x\"></div>'", "'<div class=\"logo-box\">text</div>'", "''"]


@register("extract_logo_src", """SELECT page_id, url,
    CASE WHEN page_id % 4 = 0 THEN 'logos/' || page_id || '.png' END AS link,
    CASE page_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'no_attr' WHEN 2 THEN 'no_child' ELSE 'no_container' END AS status
    FROM pages""")
def q_extract_logo_src(spark, sf):
    """A div picked by one of its classes, its first image, the image's source: all four outcomes."""
    box = " ".join(f"WHEN {k} THEN {html}" for k, html in enumerate(LOGO_BOXES))
    boxed = td.pages(spark, sf).withColumn("html", F.expr(f"concat(CASE page_id % 4 {box} END, html)"))
    return page_ops.extract_links(boxed, container="div", css_class="logo-box", child="img", attr="src")


@register("binary_files", "SELECT page_id, octet_length(encode(html)) AS length, md5(html) AS digest FROM pages")
def q_binary_files(spark, sf):
    """One file per page, read back as bytes with its length."""
    # A row's number tells rows of one page apart; the byte after each text, that empty ones are files with a length.
    path = ingest.write_files(td.pages(spark, sf).select(
        F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit("_"),
                 F.monotonically_increasing_id().cast("string"), F.lit(".txt")).alias("name"),
        F.concat(F.coalesce("html", F.lit("")), F.lit("\u0001")).cast("binary").alias("content")),
        "name", "content", shared_path(spark, "binary-files"))
    files = ingest.read_binary_files(spark, path, "*.txt", tasks=512)
    page_id = F.regexp_extract("path", r"([^/_]+)_[0-9]+\.txt$", 1).try_cast("long")
    return files.select(page_id.alias("page_id"), (F.col("length") - 1).alias("length"),
                        F.md5(F.expr("substring(content, 1, CAST(length AS INT) - 1)")).alias("digest"))


@register("humanize_scaled", with_views("lve") + """SELECT domestic_competition_id, partition_date,
    CAST(CAST(round_even(total_valuation * 12345 / 1000000000.0, 0) AS BIGINT) AS VARCHAR) || 'B' AS total_billions,
    CAST(CAST(round_even(player_count * 500000 / 1000000.0, 0) AS BIGINT) AS VARCHAR) || 'M' AS count_millions
    FROM lve""")
def q_humanize_scaled(spark, sf):
    """Axis labels that vary, halves included."""
    return _rollup(spark, sf).select(
        "domestic_competition_id", "partition_date",
        text.humanize(F.col("total_valuation") * 12345, 1_000_000_000).alias("total_billions"),
        text.humanize(F.col("player_count").cast("bigint") * 500000, 1_000_000).alias("count_millions"))
