"""Independent DuckDB SQL for every registered batch query.

Each statement is self-contained over the raw views (``events``, ``nation``, ``region``):
the shared CTEs below rebuild ``visit_actions`` and ``ad_log`` with the mapping of
FIXTURES.md, written from scratch in DuckDB's dialect. Times are compared as
``yyyy-MM-dd HH:mm:ss`` text; epoch millis use ``epoch_us // 1000`` (DuckDB's ``epoch_ms``
rounds, Spark's ``unix_millis`` truncates).
"""

from __future__ import annotations

from . import params as P

VISIT_ACTIONS = """
visit_actions as (
  select event_id,
         strftime(ts, '%Y-%m-%d') as date,
         user_id,
         concat(cast(user_id as varchar), ':', strftime(ts, '%Y-%m-%d')) as session_id,
         cast(1 + k % 7 as bigint) as page_id,
         date_trunc('second', ts) as action_time,
         case when event_type = 'view' then concat('kw', cast(k % 6 as varchar)) end as search_keyword,
         cast(case when event_type = 'click' then 1 + k % 20 else -1 end as bigint) as click_category_id,
         cast(case when event_type = 'click' then 1 + k else -1 end as bigint) as click_product_id,
         case when event_type = 'purchase'
              then concat(cast(1 + k % 20 as varchar), ',', cast(1 + event_id % 20 as varchar)) end as order_category_ids,
         case when event_type = 'purchase'
              then concat(cast(1 + k % 100 as varchar), ',', cast(1 + event_id % 100 as varchar)) end as order_product_ids,
         case when event_type = 'signup' then cast(1 + event_id % 20 as varchar) end as pay_category_ids,
         case when event_type = 'signup' then cast(1 + event_id % 100 as varchar) end as pay_product_ids,
         cast(1 + user_id % 26 as bigint) as city_id
  from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as integer) as k from events) e
)"""

AD_LOG = """
ad_log as (
  select e.event_id, e.ts,
         epoch_us(e.ts) // 1000 as ts_ms,
         strftime(e.ts, '%Y-%m-%d') as date,
         replace(r.r_name, ' ', '-') as area,
         replace(n.n_name, ' ', '-') as city,
         cast(e.user_id as varchar) as userid,
         cast(1 + cast(regexp_extract(e.props, '([0-9]+)', 1) as integer) % 6 as varchar) as adid
  from events e
  join nation n on n.n_nationkey = e.user_id % 25
  join region r on r.r_regionkey = n.n_regionkey
)"""

# Wire lines with the planted damage of FIXTURES.md, then their decoding.
AD_LINES = """
ad_lines as (
  select event_id,
         case when event_id % 107 = 0 then '-9999999999999999'
              when event_id % 103 = 0 then '9999999999999999'
              when event_id % 101 = 0 then 'x' || cast(ts_ms as varchar)
              else cast(ts_ms as varchar) end
         || ' ' || case when event_id % 97 = 0 then concat_ws(' ', area, city, userid)
                        else concat_ws(' ', area, city, userid, adid) end as line
  from ad_log
),
ad_decoded as (
  select event_id, line, parts,
         case when len(parts) < 5 then 'missing_field'
              when try_cast(parts[1] as bigint) is null then 'bad_timestamp'
              when abs(try_cast(parts[1] as bigint)) > 9223372036854775 then 'bad_timestamp' end as reason
  from (select event_id, line, string_split(rtrim(line, ' '), ' ') as parts from ad_lines)
)"""

CATEGORY_EVENTS = r"""
cat_events as (
  select event_id, cast(click_category_id as varchar) as category_id, 'click' as metric
  from visit_actions where coalesce(click_category_id, -1) <> -1
  union all
  select event_id, c, 'order' from (
    select event_id, unnest(string_split(order_category_ids, ',')) as c from visit_actions
    where coalesce(click_category_id, -1) = -1 and regexp_matches(coalesce(order_category_ids, ''), '[^\x00-\x20]'))
  where trim(c) <> ''
  union all
  select event_id, c, 'pay' from (
    select event_id, unnest(string_split(pay_category_ids, ',')) as c from visit_actions
    where coalesce(click_category_id, -1) = -1 and not regexp_matches(coalesce(order_category_ids, ''), '[^\x00-\x20]')
      and regexp_matches(coalesce(pay_category_ids, ''), '[^\x00-\x20]'))
  where trim(c) <> ''
),
funnel as (
  select category_id,
         count(*) filter (where metric = 'click') as click_count,
         count(*) filter (where metric = 'order') as order_count,
         count(*) filter (where metric = 'pay') as pay_count
  from cat_events group by category_id
),
top10 as (
  select * from (
    select row_number() over (order by click_count desc, order_count desc, pay_count desc, category_id) as rank,
           category_id, click_count, order_count, pay_count
    from funnel) where rank <= {k}
),
top_clicks as (
  select event_id, cast(click_category_id as varchar) as category_id, session_id from visit_actions
  where coalesce(click_category_id, -1) <> -1
    and cast(click_category_id as varchar) in (select category_id from top10)
)""".replace("{k}", str(P.TOP_CATEGORIES))

SEQ = """
seq as (
  select session_id, event_id, page_id, action_time,
         lead(page_id) over w as next_page_id,
         lead(action_time) over w as next_action_time,
         row_number() over w as step
  from visit_actions
  window w as (partition by session_id order by action_time, event_id)
)"""

FLOW_PAGES = [int(x) for x in P.TARGET_FLOW.split(",")]
_SOURCES = ", ".join(str(p) for p in sorted(set(FLOW_PAGES[:-1])))
_PAIRS = ", ".join(f"({a}, {b})" for a, b in sorted(set(zip(FLOW_PAGES[:-1], FLOW_PAGES[1:]))))
FLOW = f"""
flow_pairs(page_id, next_page_id) as (values {_PAIRS})"""

TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _ts_text(c: str) -> str:
    return TS_TEXT.format(c=c)


def _floor10(c: str, seconds: int = P.TREND_SLIDE_SECONDS) -> str:
    step = seconds * 1_000_000
    return f"make_timestamp((epoch_us({c}) // {step}) * {step})"


def _interval_us(text: str) -> int:
    """'10 minutes' -> microseconds."""
    n, unit = text.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult * 1_000_000


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


VISIT_COLS_TEXT = """event_id, date, user_id, session_id, page_id,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') as action_time, search_keyword, click_category_id,
  click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id"""


def oracle_sql() -> dict[str, str]:
    va = _with(VISIT_ACTIONS)
    cat = _with(VISIT_ACTIONS, CATEGORY_EVENTS)
    seq = _with(VISIT_ACTIONS, SEQ)
    seqf = _with(VISIT_ACTIONS, SEQ, FLOW)
    ad = _with(AD_LOG)
    lines = _with(AD_LOG, AD_LINES)
    T = P.BLACKLIST_THRESHOLD
    q: dict[str, str] = {}

    q["visit_actions"] = va + f"select {VISIT_COLS_TEXT} from visit_actions"
    q["visit_date_range"] = va + (f"select {VISIT_COLS_TEXT} from visit_actions "
                                  f"where date >= '{P.START_DATE}' and date <= '{P.END_DATE}'")
    q["category_action_events"] = cat + "select event_id, category_id, metric from cat_events"
    q["category_metric_counts"] = cat + "select category_id, metric, count(*) as n from cat_events group by 1, 2"
    q["category_funnel_counts"] = cat + "select * from funnel"
    q["category_top10"] = cat + "select rank, category_id, click_count, order_count, pay_count from top10"
    q["top_category_clicks"] = cat + "select event_id, category_id, session_id from top_clicks"
    q["category_session_clicks"] = cat + "select category_id, session_id, count(*) as n from top_clicks group by 1, 2"
    q["category_session_top10"] = cat + f"""
select category_id, rank, session_id, click_count from (
  select category_id, session_id, n as click_count,
         row_number() over (partition by category_id order by n desc, session_id) as rank
  from (select category_id, session_id, count(*) as n from top_clicks group by 1, 2))
where rank <= {P.TOP_SESSIONS}"""

    q["session_page_paths"] = seq + "select session_id, step, page_id from seq"
    q["session_path_text"] = seq + ("select session_id, string_agg(cast(page_id as varchar), '>' order by step) as path "
                                    "from seq group by session_id")
    q["session_page_hops"] = seq + "select session_id, page_id, next_page_id from seq where next_page_id is not null"
    q["page_visit_counts"] = va + (f"select page_id, count(*) as visits from visit_actions "
                                   f"where page_id in ({_SOURCES}) group by page_id")
    q["page_hop_counts"] = seqf + """
select s.page_id, s.next_page_id, count(*) as hops
from seq s join flow_pairs f on s.page_id = f.page_id and s.next_page_id = f.next_page_id
group by 1, 2"""
    q["page_conversion_rate"] = seqf + """
, visits as (select page_id, count(*) as visits from visit_actions group by page_id)
select h.page_id, h.next_page_id, h.hops, v.visits, h.hops / cast(v.visits as double) as rate
from (select s.page_id, s.next_page_id, count(*) as hops
      from seq s join flow_pairs f on s.page_id = f.page_id and s.next_page_id = f.next_page_id
      group by 1, 2) h
join visits v on v.page_id = h.page_id"""
    q["page_dwell_intervals"] = seq + """
select event_id, page_id, epoch_ms(next_action_time) - epoch_ms(action_time) as dwell_ms
from seq where next_action_time is not null"""
    q["page_dwell_time"] = seq + """
select page_id, count(*) as n,
       cast(cast(sum(d) as bigint) // count(*) as double) as avg_ms,
       cast(sum(d) as double) / count(*) as avg_ms_exact
from (select page_id, epoch_ms(next_action_time) - epoch_ms(action_time) as d
      from seq where next_action_time is not null)
group by page_id"""

    parsed_cols = f"""event_id, cast(parts[1] as bigint) as ts_ms,
  strftime(make_timestamp(cast(parts[1] as bigint) * 1000), '%Y-%m-%d') as date,
  parts[2] as area, parts[3] as city, parts[4] as userid, parts[5] as adid"""
    q["ad_log_parse"] = lines + f"select {parsed_cols} from ad_decoded where reason is null"
    q["ad_log_rejects"] = lines + "select event_id, line, reason from ad_decoded where reason is not null"
    q["ad_click_counts"] = ad + "select date, adid, userid, count(*) as n from ad_log group by 1, 2, 3"
    q["ad_click_counts_by_city"] = ad + "select date, area, city, adid, count(*) as n from ad_log group by 1, 2, 3, 4"
    q["ad_area_counts"] = ad + "select date, area, adid, count(*) as n from ad_log group by 1, 2, 3"
    q["ad_blacklist"] = ad + (f"select distinct userid from (select userid from ad_log "
                              f"group by date, adid, userid having count(*) >= {T})")
    q["ad_blacklist_filter"] = ad + f"""
, r as (select *, row_number() over (partition by date, adid, userid order by ts, event_id) as rn from ad_log),
  x as (select userid, min((ts, event_id)) as c from r where rn = {T} group by userid)
select a.event_id from ad_log a left join x on a.userid = x.userid
where x.c is null or (a.ts, a.event_id) <= x.c"""
    top3 = f"""
, ranked as (
  select date, area, rank, adid, n from (
    select date, area, adid, n, row_number() over (partition by date, area order by n desc, adid) as rank
    from (select date, area, adid, count(*) as n from ad_log group by 1, 2, 3))
  where rank <= {P.TOP_ADS})"""
    q["ad_top3_by_area"] = ad + top3 + "\nselect * from ranked"
    q["ad_top3_json"] = ad + top3 + """
select date, area, '{' || string_agg('"' || adid || '":' || cast(n as varchar), ',' order by rank) || '}' as top_ads
from ranked group by date, area"""
    q["ad_click_trend"] = ad + f"""
select {_ts_text(_floor10('ts'))} as bucket, count(*) as n from ad_log
where ts > (select max(ts) from ad_log) - interval {P.TREND_SPAN_SECONDS} second
group by 1"""
    per = P.TREND_WINDOW_SECONDS // P.TREND_SLIDE_SECONDS
    q["ad_click_trend_sliding"] = ad + f"""
select {_ts_text(f'b - to_seconds(i * {P.TREND_SLIDE_SECONDS})')} as window_start, {_ts_text('b')} as bucket, count(*) as n
from (select {_floor10('ts')} as b from ad_log) t, range({per}) r(i)
group by 1, 2"""

    q["fn_epoch_to_string"] = ad + "select event_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') as value from ad_log"
    q["fn_string_to_epoch"] = ad + "select event_id, epoch_us(date_trunc('second', ts)) // 1000 as value from ad_log"
    q["fn_floor_10s"] = ad + f"select event_id, {_ts_text(_floor10('ts'))} as value from ad_log"
    q["fn_split_ids"] = va + """
select event_id, value from (
  select event_id, unnest(string_split(order_category_ids, ',')) as value from visit_actions
  where order_category_ids is not null)
where trim(value) <> ''"""

    q["fn_non_blank"] = va + r"""
select event_id, coalesce(regexp_matches(v, '[^\x00-\x20]'), false) as value from (
  select event_id, case event_id % 7 when 0 then chr(9) when 1 then chr(10) when 2 then '  ' when 3 then chr(9) || '7 '
                                     when 4 then '' else order_category_ids end as v from visit_actions)"""
    q["fn_epoch_text"] = lines + """
select event_id, case when abs(ms) <= 9223372036854775 then strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') end as value
from (select event_id, try_cast(string_split(line, ' ')[1] as bigint) as ms from ad_lines)"""
    for name in ("category_top10", "category_session_top10"):
        q[f"{name}_records"] = f"select '{P.TASK_ID}' as task_id, * from ({q[name]})"
    sliced = f"""
, sliced as (select *, (event_id - (select min(event_id) from ad_log)) //
                cast(ceil(((select max(event_id) - min(event_id) + 1 from ad_log)) / {P.REPLAY_SLICES}.0) as bigint) as slice from ad_log)"""
    q["ad_click_trend_sorted_stream"] = ad + sliced + f"""
, so_far as (select b.slice as batch, {_floor10('ts')} as t, count(*) as n
             from sliced s join (select distinct slice from sliced) b on s.slice <= b.slice group by 1, 2)
select cast(batch as integer) as batch, row_number() over (partition by batch order by t) as position, {_ts_text('t')} as bucket, n
from so_far"""
    q["ad_unlisted_stream"] = ad + (f"select event_id from ad_log where userid not in (select userid from ad_log "
                                    f"group by date, adid, userid having count(*) >= {T})")
    q["ad_line_metrics_stream"] = lines + "select coalesce(reason, 'good') as metric, count(*) as n from ad_decoded group by 1"
    q["visit_metrics_observed"] = va + r"""
select metric, count(e.k) as n from (values ('click'), ('order'), ('pay'), ('other')) m(metric) left join (
  select case when coalesce(click_category_id, -1) <> -1 then 'click'
              when regexp_matches(coalesce(order_category_ids, ''), '[^\x00-\x20]') then 'order'
              when regexp_matches(coalesce(pay_category_ids, ''), '[^\x00-\x20]') then 'pay' else 'other' end as k
  from visit_actions) e on e.k = m.metric group by metric"""
    q["page_dwell_time_bucketed"] = q["page_dwell_time"]
    # the reference's own timing: a user's clicks pass up to the end of the batch that lists them
    q["ad_blacklist_batch_filter_stream"] = ad + f"""
, sliced as (select *, (event_id - (select min(event_id) from ad_log)) //
                cast(ceil(((select max(event_id) - min(event_id) + 1 from ad_log)) / {P.REPLAY_SLICES}.0) as bigint) as slice from ad_log),
  per as (select date, adid, userid, slice, count(*) as n from sliced group by 1, 2, 3, 4),
  runs as (select userid, slice, sum(n) over (partition by date, adid, userid order by slice) as total from per),
  listed as (select userid, min(slice) as slice from runs where total >= {T} group by userid)
select s.event_id from sliced s left join listed l on s.userid = l.userid
where l.slice is null or s.slice <= l.slice"""

    # the trend stream emits a bucket's rows once the watermark (latest event, in whole ms,
    # minus the delay) has reached the bucket's end
    delay_us = _interval_us(P.WATERMARK_DELAY)
    q["ad_click_trend_stream"] = ad + f"""
, wm as (select (epoch_us(max(ts)) // 1000) * 1000 - {delay_us} as w from ad_log)
select {_ts_text(f'b - to_seconds(i * {P.TREND_SLIDE_SECONDS})')} as window_start, {_ts_text('b')} as bucket, count(*) as n
from (select {_floor10('ts')} as b from ad_log) t, range({per}) r(i), wm
where epoch_us(b) + {P.TREND_SLIDE_SECONDS * 1_000_000} <= wm.w
group by 1, 2"""

    # sinks: what was written, read back, must equal the source query
    q["sink_table_roundtrip"] = q["category_top10"]
    q["sink_keyed_upsert"] = q["ad_click_counts"]

    # streams: final tables must equal their batch twins
    q["ad_log_stream_scan"] = q["ad_log_parse"]
    q["ad_log_rejects_stream"] = q["ad_log_rejects"]
    q["ad_click_counts_stream"] = q["ad_click_counts"]
    q["ad_click_counts_increments_stream"] = q["ad_click_counts"]
    q["ad_area_counts_stream"] = q["ad_area_counts"]
    q["ad_top3_stream"] = q["ad_top3_by_area"]
    q["ad_top3_json_stream"] = q["ad_top3_json"]
    q["ad_click_counts_by_city_stream"] = q["ad_click_counts_by_city"]
    q["ad_blacklist_stream"] = q["ad_blacklist"]
    q["ad_blacklist_filter_stream"] = q["ad_blacklist_filter"]
    q["ad_blacklist_state_filter_stream"] = q["ad_blacklist_filter"]
    q["ad_area_counts_state_stream"] = q["ad_area_counts"]
    for kind in ("late", "recovered", "state"):  # late rows, lost batches, results read from state: the same rows
        q[f"ad_blacklist_{kind}_stream"] = q["ad_blacklist"]
        if kind != "state":
            q[f"ad_click_counts_{kind}_stream"] = q["ad_click_counts"]
            q[f"ad_top3_{kind}_stream"] = q["ad_top3_by_area"]
    q["ad_click_counts_live_stream"] = q["ad_click_counts"]
    q["ad_blacklist_live_stream"] = q["ad_blacklist"]
    q["ad_click_counts_increments_recovered_stream"] = q["ad_click_counts"]
    return q
