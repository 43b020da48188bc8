"""DuckDB SQL equal to each registered query, written over the base tables.

Hash keys are ``sha256(upper(trim(..)))``; a double in a hash is ``cast(x as varchar)``,
which ``double_text`` reproduces on the Spark side. Sums are cast to bigint, averages
rounded to 6 places, timestamps rendered with one explicit format.
"""

from __future__ import annotations

# Fixed parameters shared by the Spark queries and their SQL.
EVENTS_CUT_1 = "2024-01-20 00:00:00"
EVENTS_CUT_2 = "2024-01-15 00:00:00"
ORDERS_CUT_1 = "1999-01-01 00:00:00"
ORDERS_CUT_2 = "1998-01-01 00:00:00"
LINEITEM_CUT_1 = "2000-01-01 00:00:00"
LINEITEM_CUT_2 = "1999-01-01 00:00:00"
AS_OF_DATES = ["1995-07-01", "1996-01-01", "1996-07-01", "1997-01-01", "1997-07-01", "1998-01-01",
               "1998-07-01", "1999-01-01", "1999-07-01", "2000-01-01", "2000-07-01", "2001-01-01"]
ACCEPTED_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
NOT_IN_TARGET_SEGMENTS = ["AUTOMOBILE", "MACHINERY", "HOUSEHOLD"]
NOT_IN_BATCH_SEGMENTS = ["BUILDING", "FURNITURE", "AUTOMOBILE"]
FRESHNESS_NOW = "2024-02-01 00:00:00"
FRESH_WARN_S = 86400
FRESH_ERROR_S = 7 * 86400


def H(x: str) -> str:
    return f"sha256(upper(trim({x})))"


def S(x: str) -> str:
    return f"upper(trim({x}))"


def comp(parts: list[str]) -> str:
    return H(" || '|' || ".join(S(p) for p in parts))


def diff(parts: list[str]) -> str:
    return H(" || '|' || ".join(f"coalesce({p}, 'NULL')" for p in parts))


def vc(x: str) -> str:
    return f"cast({x} as varchar)"


# -- batches --------------------------------------------------------------------------
EVENTS = {None: "events",
          1: f"(select * from events where ts < timestamp '{EVENTS_CUT_1}')",
          2: f"(select * replace (value * 1.1::double as value) from events where ts >= timestamp '{EVENTS_CUT_2}')"}
ORDERS = {None: "orders",
          1: f"(select * from orders where o_orderdate < timestamp '{ORDERS_CUT_1}')",
          2: ("(select * replace (o_totalprice * 1.01::double as o_totalprice, "
              "case when o_orderstatus = 'P' then 'F' else o_orderstatus end as o_orderstatus) "
              f"from orders where o_orderdate >= timestamp '{ORDERS_CUT_2}')")}
LINEITEM = {None: "lineitem",
            1: f"(select * from lineitem where l_shipdate < timestamp '{LINEITEM_CUT_1}')",
            2: f"(select * replace (l_quantity + l_tax as l_quantity) from lineitem where l_shipdate >= timestamp '{LINEITEM_CUT_2}')"}


# -- staging ----------------------------------------------------------------------------
def stg_wikimedia(b=None) -> str:
    return ("select event_type as project, 'User_' || cast(user_id as varchar) as article, 'hourly' as granularity, "
            "'all-access' as access, 'all-agents' as agent, strftime(ts, '%Y%m%d%H') as ts_yyyymmddhh, "
            f"cast(floor(value) as bigint) as views from {EVENTS[b]} e")


def stg_worldbank(b=None) -> str:
    return ("select case when o_orderpriority = '1-URGENT' then 'SP.POP.TOTL' else o_orderpriority end as indicator_id, "
            "o_orderpriority as indicator_name, cast(n_nationkey as varchar) as country_id, "
            "n_name || '-' || cast(c_custkey as varchar) as country_name, n_name || '-' || cast(c_custkey as varchar) as country_iso3, cast(year(o_orderdate) as varchar) as year, '' as unit, '' as obs_status, "
            "'0' as decimal_places, max(o_totalprice) as value "
            f"from {ORDERS[b]} o join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey "
            "group by all")


def stg_openmeteo(b=None) -> str:
    return ("select l_suppkey / 10.0 as lat, l_linenumber / 10.0 as lon, strftime(l_shipdate, '%Y-%m-%dT%H:%M') as ts, "
            f"l_quantity as temperature_2m, l_discount as relativehumidity_2m from {LINEITEM[b]} l")


def stg_github(b=None) -> str:
    return ("select sha256(cast(o_orderkey as varchar)) as commit_sha, o_orderpriority as author_name, "
            "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as author_date, cast(o_custkey as varchar) as committer_name, "
            f"'order ' || cast(o_orderkey as varchar) as message, o_orderstatus = 'F' as verified from {ORDERS[b]} o")


def stg_openaq(b=None) -> str:
    return ("select l_suppkey as sensor_id, l_returnflag as parameter, l_linestatus as unit, "
            "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') as date_utc, l_quantity as value, "
            f"l_suppkey / 10.0 as lat, l_suppkey / 20.0 as lon from {LINEITEM[b]} l")


def stg_usgs(b=None) -> str:
    return ("select cast(event_id as varchar) as feature_id, 'M ' || cast(value as varchar) as title, "
            "event_type as place, value as magnitude, user_id / 10.0 as lon, user_id / 20.0 as lat, "
            f"value as depth_km, epoch_us(ts) // 1000 as epoch_ms from {EVENTS[b]} e")


STG = {"wikimedia": stg_wikimedia, "worldbank": stg_worldbank, "openmeteo": stg_openmeteo,
       "github": stg_github, "openaq": stg_openaq, "usgs": stg_usgs}


# -- vault ------------------------------------------------------------------------------
def hub(src: str, bkey: str, name: str, where: str = "") -> str:
    cond = f"({bkey}) is not null" + (f" and {where}" if where else "")
    return (f"select {H(bkey)} as hk_{name}, min({bkey}) as {name}_bkey "
            f"from ({STG[src]()}) s where {cond} group by 1")


LOC_BKEY = f"{S(vc('lat'))} || '|' || {S(vc('lon'))}"

HUB_SQL = {
    "hub_article": hub("wikimedia", "article", "article"),
    "hub_commit": hub("github", "commit_sha", "commit"),
    "hub_country": hub("worldbank", "country_iso3", "country"),
    "hub_indicator": hub("worldbank", "indicator_id", "indicator"),
    "hub_location": hub("openmeteo", LOC_BKEY, "location", "lat is not null and lon is not null"),
    "hub_sensor": hub("openaq", vc("sensor_id"), "sensor"),
}

LINK_SQL = {
    "link_country_indicator": (
        f"select distinct {comp(['country_iso3', 'indicator_id'])} as hk_country_indicator, "
        f"{H('country_iso3')} as hk_country, {H('indicator_id')} as hk_indicator "
        f"from ({stg_worldbank()}) s where country_iso3 is not null and indicator_id is not null"),
    "link_project_article": (
        f"select distinct {comp(['project', 'article'])} as hk_project_article, {S('project')} as project_id, "
        f"{H('article')} as hk_article from ({stg_wikimedia()}) s where project is not null and article is not null"),
}


def sat_article_views(b=None) -> str:
    return (f"select distinct {H('article')} as hk_article, {comp(['project', 'article'])} as hk_project_article, "
            f"{S('project')} as project_id, {comp(['project', 'article', vc('ts_yyyymmddhh')])} as hash_natural_key, "
            f"{diff([vc('views'), 'access', 'agent', 'granularity'])} as hd_attributes, "
            "views, access, agent, granularity, ts_yyyymmddhh "
            f"from ({stg_wikimedia(b)}) s "
            "where project is not null and article is not null and ts_yyyymmddhh is not null")


def sat_country_indicator_values(b=None) -> str:
    return (f"select distinct {H('country_iso3')} as hk_country, {H('indicator_id')} as hk_indicator, "
            f"{comp(['country_iso3', 'indicator_id', vc('try_cast(year as integer)')])} as hash_natural_key, "
            f"{diff([vc('value'), 'unit', 'obs_status', vc('decimal_places')])} as hd_attributes, "
            "value, unit, obs_status, decimal_places, try_cast(year as integer) as year "
            f"from ({stg_worldbank(b)}) s where country_iso3 is not null and indicator_id is not null "
            "and year is not null and try_cast(year as integer) is not null")


def sat_weather_hourly(b=None) -> str:
    return (f"select distinct {H(LOC_BKEY)} as hk_location, {comp([LOC_BKEY, 'ts'])} as hash_natural_key, "
            f"{diff([vc('temperature_2m'), vc('relativehumidity_2m')])} as hd_attributes, "
            "temperature_2m, relativehumidity_2m, ts "
            f"from ({stg_openmeteo(b)}) s where lat is not null and lon is not null and ts is not null")


def sat_commit_meta(b=None) -> str:
    return (f"select distinct {H('commit_sha')} as hk_commit, {H(S('commit_sha'))} as hash_natural_key, "
            f"{diff(['author_name', 'author_date', 'committer_name', 'message', vc('verified')])} as hd_attributes, "
            "author_name, author_date, committer_name, message, verified "
            f"from ({stg_github(b)}) s where commit_sha is not null")


def sat_sensor_measurements(b=None) -> str:
    return (f"select distinct {H(vc('sensor_id'))} as hk_sensor, "
            f"{comp([vc('sensor_id'), 'parameter', 'date_utc'])} as hash_natural_key, "
            f"{diff([vc('value'), 'unit', vc('lat'), vc('lon')])} as hd_attributes, "
            "parameter, unit, date_utc, value, lat, lon "
            f"from ({stg_openaq(b)}) s where sensor_id is not null and date_utc is not null and parameter is not null")


SAT = {"sat_article_views": sat_article_views, "sat_country_indicator_values": sat_country_indicator_values,
       "sat_weather_hourly": sat_weather_hourly, "sat_commit_meta": sat_commit_meta,
       "sat_sensor_measurements": sat_sensor_measurements}


def appended(sat: str) -> str:
    f = SAT[sat]
    return (f"with t as ({f(1)}), b as ({f(2)}) select * from t union all select * from b where not exists "
            "(select 1 from t where t.hash_natural_key = b.hash_natural_key and t.hd_attributes = b.hd_attributes)")


def upserted(sat: str) -> str:
    f = SAT[sat]
    return (f"with t as ({f(1)}), b as ({f(2)}), "
            "n as (select * from b where (hash_natural_key, hd_attributes) not in "
            "(select hash_natural_key, hd_attributes from t)) "
            "select * from t where not exists (select 1 from n where n.hash_natural_key = t.hash_natural_key) "
            "union all select * from n")


def appended_with_load(sat: str) -> str:
    f = SAT[sat]
    return (f"with t as ({f(1)}), b as ({f(2)}) select *, 1 as ld from t union all select *, 2 as ld from b "
            "where not exists (select 1 from t where t.hash_natural_key = b.hash_natural_key "
            "and t.hd_attributes = b.hd_attributes)")


# -- requests ---------------------------------------------------------------------------
def seg(x: str) -> str:
    return f"url_encode({x})"


def qv(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def request_sql() -> str:
    wb = (f"select distinct case when o_orderpriority = '1-URGENT' then 'SP.POP.TOTL' else o_orderpriority end as indicator, "
          f"n_name || '-' || cast(c_custkey as varchar) as country from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey")
    om = "select distinct l_suppkey / 10.0 as lat, l_linenumber / 10.0 as lon from lineitem"
    wk = ("select event_type as project, 'User ' || cast(user_id as varchar) as article, "
          "strftime(min(ts), '%Y%m%d') as start_d, strftime(max(ts), '%Y%m%d') as end_d from events group by all")
    gh = ("select distinct 'orders' as owner, o_orderpriority as repo, "
          "case when o_orderstatus = 'F' then 'main' end as sha from orders")
    aq = ("select l_suppkey as sensor_id, cast(min(cast(l_shipdate as date)) as varchar) as date_from, "
          f"case when max(l_shipdate) < timestamp '{LINEITEM_CUT_1}' then cast(max(cast(l_shipdate as date)) as varchar) end "
          "as date_to from lineitem group by 1")
    us = "select distinct event_type || '_day' as feed from events"
    ts = "20250101T000000Z"
    return f"""
select 'worldbank' as source,
  'https://api.worldbank.org/v2/country/' || country || '/indicator/' || indicator || '?format=json&per_page=20000' as url,
  'worldbank/' || indicator || '/' || country || '/{ts}.json.gz' as landing_key from ({wb})
union all
select 'openmeteo',
  'https://api.open-meteo.com/v1/forecast?latitude=' || {qv(vc('lat'))} || '&longitude=' || {qv(vc('lon'))}
    || '&timezone=auto&hourly=' || {qv("'temperature_2m,relativehumidity_2m'")},
  'openmeteo/' || cast(lat as varchar) || '_' || cast(lon as varchar) || '/{ts}.json.gz' from ({om})
union all
select 'wikimedia',
  'https://wikimedia.org/api/rest_v1/metrics/pageviews/per-article/' || project || '/all-access/all-agents/'
    || {seg('article')} || '/hourly/' || start_d || '/' || end_d,
  'wikimedia/' || project || '/' || {seg('article')} || '/' || start_d || '_' || end_d || '/{ts}.json.gz' from ({wk})
union all
select 'github',
  'https://api.github.com/repos/' || owner || '/' || repo || '/commits'
    || case when sha is null or sha = '' then '' else '?sha=' || {qv('sha')} end,
  'github/' || owner || '/' || repo || '/{ts}.json.gz' from ({gh})
union all
select 'openaq',
  'https://api.openaq.org/v3/sensors/' || cast(sensor_id as varchar) || '/measurements?limit=1000'
    || coalesce('&date_from=' || {qv('date_from')}, '') || coalesce('&date_to=' || {qv('date_to')}, ''),
  'openaq/sensors/' || cast(sensor_id as varchar) || '/measurements/' || coalesce(date_from, 'na') || '_'
    || coalesce(date_to, 'na') || '/{ts}.json.gz' from ({aq})
union all
select 'usgs', 'https://earthquake.usgs.gov/earthquakes/feed/v1.0/summary/' || feed || '.geojson',
  'usgs/earthquakes/' || feed || '/{ts}.geojson.gz' from ({us})
"""


def freshness_sql(table: str, col: str) -> str:
    age = f"(epoch_us(timestamp '{FRESHNESS_NOW}') - epoch_us(max({col}))) // 1000000"
    return (f"select '{table}' as source, strftime(max({col}), '%Y-%m-%d %H:%M:%S') as newest, {age} as age_s, "
            f"case when max({col}) is null then 'error' when {age} > {FRESH_ERROR_S} then 'error' "
            f"when {age} > {FRESH_WARN_S} then 'warn' else 'pass' end as status from {table}")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {f"stg_{s}": f() for s, f in STG.items()}
    seg_null = "case when c_mktsegment <> 'HOUSEHOLD' then c_mktsegment end"
    dates = ", ".join(f"timestamp '{d} 00:00:00'" for d in AS_OF_DATES)
    q.update({
        "scan_json_roundtrip": stg_wikimedia(),
        "landing_sink": stg_wikimedia(),
        "compact_parquet": stg_openaq(),
        "src_registry_scan": stg_usgs(),
        "filter_valid_json": (
            "select event_id, payload from (select event_id, case when event_type = 'error' "
            "then substr(props, 1, length(props) - 1) else props end as payload from events) where json_valid(payload)"),
        "explode_list": "select vec_id, unnest(cast(embedding as double[])) as x from embeddings",
        "zip_explode": ("select vec_id, unnest(cast(embedding as double[])) as a, "
                        "unnest(cast(embedding[1:40] as double[])) as b from embeddings"),
        "hash_key": f"select c_custkey, {H('c_name')} as hk_name, {H('c_mktsegment')} as hk_segment from customer",
        "hash_key_composite": (f"select o_orderkey, {comp(['o_orderpriority', 'o_orderstatus', vc('o_custkey')])} "
                               "as hk_composite from orders"),
        "hash_diff": (f"select o_orderkey, {diff([vc('o_totalprice'), "case when o_orderstatus <> 'P' then o_orderstatus end", 'o_orderpriority'])} "
                      "as hd_attributes from orders"),
        "double_text": ("select l_orderkey, l_linenumber, cast(l_extendedprice as varchar) as price_text, "
                        "cast(l_discount / 100.0::double as varchar) as small_text, "
                        "cast(l_extendedprice * 1000.0::double as varchar) as big_text from lineitem"),
    })
    q.update(HUB_SQL)
    q.update(LINK_SQL)
    q.update({
        "sat_append_article_views": appended("sat_article_views"),
        "sat_append_country_indicator": appended("sat_country_indicator_values"),
        "sat_upsert_weather": upserted("sat_weather_hourly"),
        "sat_upsert_commit": upserted("sat_commit_meta"),
        "sat_upsert_sensor": upserted("sat_sensor_measurements"),
        "sat_upsert_country_indicator": upserted("sat_country_indicator_values"),
        "not_in_null_aware": (
            "with c as (select *, cast(c_nationkey as varchar) || ':' || cast(cast(floor(c_acctbal / 1000) as integer) "
            "as varchar) as d from customer), "
            "t as (select case when not (c_nationkey < 10 and c_mktsegment = 'HOUSEHOLD') then c_mktsegment end as k, d "
            f"from c where c_mktsegment in ({', '.join(repr(v) for v in NOT_IN_TARGET_SEGMENTS)})), "
            "n as (select c_custkey, case when c_mktsegment <> 'BUILDING' then c_mktsegment end as k, d from c "
            f"where c_mktsegment in ({', '.join(repr(v) for v in NOT_IN_BATCH_SEGMENTS)})) "
            "select c_custkey, k, d from n where (k, d) not in (select k, d from t)"),
        "pit_article_day": (f"select hk_article, project_id, substr(ts_yyyymmddhh, 1, 8) as yyyymmdd, "
                            f"cast(sum(views) as bigint) as views_day from ({sat_article_views()}) s group by all"),
        "pit_country_indicator_year": (f"select hk_country, hk_indicator, year, max(value) as value_year "
                                       f"from ({sat_country_indicator_values()}) s group by all"),
        "pit_latest_version": (
            "select hk_country, hk_indicator, year, value, unit, obs_status, decimal_places from ("
            "select *, row_number() over (partition by hk_country, hk_indicator, year "
            f"order by ld desc, hd_attributes desc) as rn from ({appended_with_load('sat_country_indicator_values')}) s"
            ") where rn = 1"),
        "pit_as_of": (
            f"with d as (select unnest([{dates}]) as sd), v as (select o_custkey, sd, o_orderkey, o_totalprice, o_orderstatus, "
            "row_number() over (partition by o_custkey, sd order by o_orderdate desc, o_orderkey desc) as rn "
            "from orders join d on o_orderdate <= sd) "
            "select o_custkey, strftime(sd, '%Y-%m-%d') as snapshot_date, o_orderkey, o_totalprice, o_orderstatus "
            "from v where rn = 1"),
        "pit_weather_day": (
            "select hk_location, substr(ts, 1, 10) as day, min(temperature_2m) as temp_min, "
            "round(avg(temperature_2m), 6) as temp_avg, max(temperature_2m) as temp_max, "
            "min(relativehumidity_2m) as rh_min, round(avg(relativehumidity_2m), 6) as rh_avg, "
            f"max(relativehumidity_2m) as rh_max, count(*) as n_obs from ({sat_weather_hourly()}) s group by all"),
        "pit_sensor_hour": (
            "select hk_sensor, parameter, substr(date_utc, 1, 13) as hour, min(value) as value_min, "
            "round(avg(value), 6) as value_avg, max(value) as value_max, count(value) as n_obs "
            f"from ({sat_sensor_measurements()}) s group by all"),
        "pit_sensor_day": (
            "select hk_sensor, parameter, substr(date_utc, 1, 10) as day, min(value) as value_min, "
            "round(avg(value), 6) as value_avg, max(value) as value_max, count(value) as n_obs "
            f"from ({sat_sensor_measurements()}) s group by all"),
        "pit_quake_day": (
            "select cast(date '1970-01-01' + cast(floor(epoch_ms / 86400000) as integer) as varchar) as day, "
            f"count(*) as n_quakes, max(magnitude) as max_magnitude from ({stg_usgs()}) s "
            "where epoch_ms is not null group by 1"),
        "pit_commit_day": (
            "select substr(author_date, 1, 10) as day, count(*) as n_commits, "
            f"cast(sum(case when verified then 1 else 0 end) as bigint) as n_verified from ({sat_commit_meta()}) s group by 1"),
        "mart_article_traffic_daily": (
            f"with sat as ({sat_article_views()}), "
            "pit as (select hk_article, project_id, substr(ts_yyyymmddhh, 1, 8) as yyyymmdd, sum(views) as views_day "
            "from sat group by all), "
            f"hub as ({HUB_SQL['hub_article']}), link as ({LINK_SQL['link_project_article']}) "
            "select hub.article_bkey as article, pit.project_id as project, pit.yyyymmdd, "
            "cast(pit.views_day as bigint) as views_day from pit "
            "join link on link.hk_article = pit.hk_article and link.project_id = pit.project_id "
            "join hub on hub.hk_article = pit.hk_article"),
        "mart_population_by_country_year": (
            f"with pit as (select hk_country, hk_indicator, year, max(value) as value_year "
            f"from ({sat_country_indicator_values()}) s group by all), "
            f"c as ({HUB_SQL['hub_country']}), i as ({HUB_SQL['hub_indicator']}) "
            "select c.country_bkey as iso3, i.indicator_bkey as indicator, pit.year, pit.value_year "
            "from c join i on 1 = 1 join pit on pit.hk_country = c.hk_country and pit.hk_indicator = i.hk_indicator "
            "where upper(trim(i.indicator_bkey)) = 'SP.POP.TOTL'"),
        "dq_not_null": f"select * from (select c_custkey, {seg_null} as segment from customer) where segment is null",
        "dq_unique": (
            f"select upper(trim(article)) as value, count(*) as n from (select distinct article from ({stg_wikimedia()}) s "
            "where article is not null) group by 1 having count(*) > 1 "
            f"union all select project as value, count(*) as n from ({stg_wikimedia()}) s where project is not null "
            "group by 1 having count(*) > 1"),
        "dq_relationships": (
            "select o_custkey as value, count(*) as n from orders o where o_custkey is not null and not exists "
            "(select 1 from customer c where c.c_custkey = o.o_custkey and c.c_mktsegment <> 'BUILDING') group by 1"),
        "dq_accepted_values": (
            "select o_orderpriority as value, count(*) as n from orders where o_orderpriority is not null and "
            f"o_orderpriority not in ({', '.join(repr(v) for v in ACCEPTED_PRIORITIES)}) group by 1"),
        "dq_singular": ("select l_orderkey, l_linenumber from lineitem join orders on l_orderkey = o_orderkey "
                        "where l_shipdate < o_orderdate"),
        "dq_freshness": " union all ".join([freshness_sql("events", "ts"), freshness_sql("orders", "o_orderdate"),
                                             freshness_sql("lineitem", "l_shipdate")]),
        "filter_not_null": f"select * from (select c_custkey, {seg_null} as segment from customer) where segment is not null",
        "filter_not_null_all": (
            f"select * from (select c_custkey, {seg_null} as segment, case when c_nationkey >= 3 then c_nationkey end "
            "as nation from customer) where segment is not null and nation is not null"),
        "filter_std_equals": (f"select country_iso3, year, value from ({stg_worldbank()}) s "
                              "where upper(trim(indicator_id)) = 'SP.POP.TOTL'"),
        "case_boolean": ("select o_orderkey, coalesce(case when lower(case when o_orderstatus <> 'P' then o_orderstatus end) "
                         "= 'f' then true end, false) as is_final from orders"),
        "null_sentinel": f"select c_custkey, coalesce({seg_null}, 'NULL') as segment from customer",
        "scalar_functions": (
            "select event_id, try_cast(cast(value as varchar) as integer) as value_int, "
            "try_cast(cast(value as varchar) as double) as value_double, try_cast(props as integer) as props_int, "
            "substr(strftime(ts, '%Y%m%d%H'), 1, 8) as day8, "
            "url_encode('User ' || cast(user_id as varchar) || '/' || event_type || '*~') as article_enc, "
            "cast(date '1970-01-01' + cast(floor((epoch_us(ts) // 1000) / 86400000) as integer) as varchar) as day, "
            "strftime(ts, '%Y%m%dT%H%M%SZ') as stamp from events"),
        "request_plan": f"select source, url from ({request_sql()})",
        "landing_keys": f"select source, landing_key from ({request_sql()})",
        "row_counts": (
            "select 'orders' as table_name, count(*) as n, cast(null as varchar) as error from orders "
            "union all select 'lineitem', count(*), null from lineitem "
            "union all select 'events', count(*), null from events "
            "union all select 'customer', count(*), null from customer "
            "union all select 'missing_table', null, 'table not found: missing_table'"),
    })
    day = lambda pit, hub, hk, bkey, name: (
        f"select pit.* exclude ({hk}), hub.{bkey} as {name} from ({q[pit]}) pit join ({HUB_SQL[hub]}) hub on hub.{hk} = pit.{hk}")
    newest = ("select * from (select *, row_number() over (partition by feature_id order by ld desc, epoch_ms desc, magnitude desc) as rn "
              f"from (select *, 1 as ld from ({stg_usgs(1)}) union all select *, 2 as ld from ({stg_usgs(2)}))) where rn = 1")
    q.update({
        "mart_weather_daily": day("pit_weather_day", "hub_location", "hk_location", "location_bkey", "location"),
        "mart_air_quality_hourly": day("pit_sensor_hour", "hub_sensor", "hk_sensor", "sensor_bkey", "sensor"),
        "mart_air_quality_daily": day("pit_sensor_day", "hub_sensor", "hk_sensor", "sensor_bkey", "sensor"),
        "mart_quakes_daily": (
            "select cast(date '1970-01-01' + cast(floor(epoch_ms / 86400000) as integer) as varchar) as day, "
            f"count(*) as n_quakes, max(magnitude) as max_magnitude from ({newest}) s where epoch_ms is not null group by 1"),
        "mart_commits_daily": (
            "select substr(author_date, 1, 10) as day, count(*) as n_commits, "
            f"cast(sum(case when verified then 1 else 0 end) as bigint) as n_verified from ({upserted('sat_commit_meta')}) s group by 1"),
        "pit_article_day_incremental": (
            "select hk_article, project_id, substr(ts_yyyymmddhh, 1, 8) as yyyymmdd, cast(sum(views) as bigint) as views_day "
            f"from ({appended('sat_article_views')}) s group by all"),
        "pit_as_of_incremental": q["pit_as_of"],
        "pit_weather_day_incremental": (
            "select hk_location, substr(ts, 1, 10) as day, min(temperature_2m) as temp_min, "
            "round(avg(temperature_2m), 6) as temp_avg, max(temperature_2m) as temp_max, "
            "min(relativehumidity_2m) as rh_min, round(avg(relativehumidity_2m), 6) as rh_avg, "
            f"max(relativehumidity_2m) as rh_max, count(*) as n_obs from ({upserted('sat_weather_hourly')}) s group by all"),
        "materialize_view": HUB_SQL["hub_article"],
        "materialize_table": HUB_SQL["hub_article"],
        "dq_run_checks": " union all ".join(
            f"select '{model}' as model, '{col}' as \"column\", '{test}' as test, (select count(*) from ({sql})) as failures"
            for model, col, test, sql in [
                ("customer", "c_custkey", "not_null", "select 1 from customer where c_custkey is null"),
                ("customer", "segment", "not_null", f"select 1 from (select {seg_null} as segment from customer) where segment is null"),
                ("orders", "o_custkey", "unique", "select o_custkey from orders where o_custkey is not null group by 1 having count(*) > 1"),
                ("orders", "o_custkey", "relationships", q["dq_relationships"]),
                ("orders", "o_orderpriority", "accepted_values", q["dq_accepted_values"]),
                ("lineitem", "l_shipdate", "singular", q["dq_singular"])]),
    })
    return q
