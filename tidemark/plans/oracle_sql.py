"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: plain window/aggregate SQL over the
driver's views. ``with_(...)`` prepends the binding CTEs a query needs.
"""

from __future__ import annotations

import re

from tidemark.plans.fragments import (CORR_GROUPS, COVARIATES, FEATURES, MKT_SRC_COLS, PROMO_FILL,
                                      SEASONAL)
from tidemark.plans.params import HORIZON_MONTHS, TRAIN_END  # noqa: F401

A6 = repr(2.0 / 7.0)            # EMA alpha for span 6
B6 = repr(1.0 - 2.0 / 7.0)

_GEO = ("supplier join nation on s_nationkey = n_nationkey "
        "join region on n_regionkey = r_regionkey")

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "panel": (f"""
select key, business_type, date, num_transactions, sales_amount, units,
       sales_amount / nullif(units, 0) as ppu
from (select l_suppkey::varchar as key, r_name as business_type,
             date_trunc('month', l_shipdate)::date as date,
             count(distinct l_orderkey)::bigint as num_transactions,
             sum(trunc(l_extendedprice)::bigint)::bigint as sales_amount,
             sum(trunc(l_quantity)::bigint)::bigint as units
      from lineitem join {_GEO} on l_suppkey = s_suppkey
      group by 1, 2, 3)""", ()),
    "ap": ("""
select key, business_type, date, units as target, ppu from panel
where key in (select key from panel where date = (select max(date) from panel))""", ("panel",)),
}


def with_(*names: str) -> str:
    """WITH clause for the named CTEs plus their dependencies, in order."""
    seen: list[str] = []

    def visit(n):
        for d in CTES[n][1]:
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return "with " + ",\n".join(f"{n} as ({CTES[n][0]})" for n in seen) + "\n"


W_KD = "over (partition by key order by date"


def _lag_mean() -> str:
    return f"(select avg(target) from ap where date <= date '{TRAIN_END}')"


SQL: dict[str, str] = {}

SQL["monthly_rollup"] = with_("panel") + "select * from panel"

SQL["active_stores"] = with_("panel") + """
select * from panel
where key in (select key from panel where date = (select max(date) from panel))"""

SQL["lag_features"] = with_("ap") + f"""
select key, business_type, date, target, ppu,
       round_even(coalesce(lag(target, 12) {W_KD})::double, {_lag_mean()}), 4) as Lag12_y
from ap"""

SQL["moving_stats"] = with_("ap") + f"""
select key, business_type, date, target, ppu,
  round_even(coalesce(avg(target) {W_KD} rows between 6 preceding and 1 preceding), 0), 4) as MA6_y,
  round_even(coalesce(stddev_samp(target) {W_KD} rows between 6 preceding and 1 preceding), 0), 4)
    as STD6_y,
  round_even(coalesce(list_reduce(list(target::double) {W_KD}
      rows between unbounded preceding and 1 preceding),
      lambda acc, v: acc * {B6} + v * {A6}), 0), 4) as EMA6_y
from ap"""

SQL["ema"] = with_("ap") + f"""
select key, business_type, date, target, ppu,
  round_even(coalesce(list_reduce(list(target::double) {W_KD}
      rows between unbounded preceding and 1 preceding),
      lambda acc, v: acc * {repr(1.0 - 2.0 / 4.0)} + v * {repr(2.0 / 4.0)}), 0), 4) as EMA3_y,
  round_even(coalesce(list_reduce(list(target::double) {W_KD}
      rows between unbounded preceding and 1 preceding),
      lambda acc, v: acc * {repr(1.0 - 2.0 / 13.0)} + v * {repr(2.0 / 13.0)}), 0), 4) as EMA12_y
from ap"""

SQL["seasonality_index"] = with_("ap") + """,
shifted as (select month(date) as m,
                   lag(target) over (partition by month(date) order by date, key) as prev from ap),
mavg as (select m, avg(prev) as a from shifted group by m),
idx as (select m, round_even(a / nullif(avg(a) over (), 0), 2) as si from mavg)
select key, business_type, date, target, ppu, coalesce(si, 1.0::double) as Seasonality_Index
from ap left join idx on month(ap.date) = idx.m"""

SQL["seasonal_means"] = with_("ap") + """,
s as (select *,
        lag(target) over (partition by key, month(date) order by date) as pm,
        lag(target) over (partition by key, quarter(date) order by date) as pq from ap)
select key, business_type, date, target, ppu,
  round_even(avg(pm) over (partition by key, month(date)), 4) as target_seasonal_monthly,
  round_even(avg(pq) over (partition by key, quarter(date)), 4) as target_seasonal_quarterly
from s"""

SQL["rate_of_sale"] = with_("ap") + """,
s as (select key, year(date) as y, date, lag(target) over (partition by key order by date) as prev
      from ap),
g as (select key, y, sum(prev) / count(distinct date) as rate_of_sale
      from s where prev is not null group by key, y)
select ap.key, business_type, date, target, ppu, round_even(g.rate_of_sale, 4) as rate_of_sale
from ap left join g on ap.key = g.key and year(ap.date) = g.y"""

SQL["derivatives"] = with_("ap") + """,
mo as (select key, date_trunc('month', date)::date as year_month, sum(target)::double as t
       from ap group by 1, 2),
l as (select *, lag(t, 1) over w as p1, lag(t, 2) over w as p2, lag(t, 4) over w as p4,
             lag(t, 7) over w as p7
      from mo window w as (partition by key order by year_month)),
d1 as (select *, round_even((p1 - p2) / nullif(p2, 0) * 100, 2) as r1,
              round_even((p1 - p4) / nullif(p4, 0) * 100, 2) as r3,
              round_even((p1 - p7) / nullif(p7, 0) * 100, 2) as r6 from l),
d2 as (select *, round_even((r1 - lag(r1) over (partition by key order by year_month))
                  / nullif(lag(r1) over (partition by key order by year_month), 0) * 100, 2) as r2
       from d1),
f as (select key, year_month, coalesce(r1, 0) as deriv_1_pct, coalesce(r2, 0) as deriv_2_pct,
             coalesce(r3, 0) as deriv_3_pct, coalesce(r6, 0) as deriv_6_pct,
             max(p1) over (partition by key) as monthly_max_qty,
             min(p1) over (partition by key) as monthly_min_qty from d2)
select *, case when abs(deriv_2_pct) > 50 then 1 else 0 end as deriv_1_flag,
       case when deriv_2_pct > 0 then 'increasing' when deriv_2_pct < 0 then 'decreasing'
            else 'fluctuating' end as deriv_2_trend_flag
from f"""

# ---------------------------------------------------------------- calendar
CTES["spine"] = ("""
select unnest(generate_series(min(l_shipdate)::date, max(l_shipdate)::date, interval 1 day))::date
       as date from lineitem""", ())
CTES["yrs"] = (f"""
select unnest(generate_series(year(min(l_shipdate)::date) - 1,
                              year(max(l_shipdate)::date + interval {HORIZON_MONTHS} month) + 1))
       as y from lineitem""", ())
CTES["rng"] = ("""
select make_date(y::int, 6, 1) - (11 * (y - 1995))::int as s,
       make_date(y::int, 6, 1) - (11 * (y - 1995))::int + 29 as e
from yrs""", ("yrs",))
CTES["feast"] = ("""
select unnest(generate_series(e + 1, e + 3, interval 1 day))::date as fd, 'feast' as ev from rng
union all
select unnest(generate_series(e + 70, e + 72, interval 1 day))::date as fd, 'feast2' as ev from rng""",
                 ("rng",))
CTES["evf"] = ("""
select date,
  exists(select 1 from rng where date between s and e and year(date) = year(s))::int as is_range,
  exists(select 1 from rng where date >= s - 14 and date < s and year(date) = year(s))::int
    as pre_range,
  exists(select 1 from rng where date > e and date <= e + 7 and year(date) = year(s))::int
    as post_range,
  exists(select 1 from feast where ev = 'feast' and fd = date)::int as is_feast,
  exists(select 1 from feast where ev = 'feast2' and fd = date)::int as is_feast2,
  exists(select 1 from feast where ev = 'feast' and date >= fd - 7 and date < fd
         and year(date) = year(fd))::int as pre_feast
from spine""", ("spine", "rng", "feast"))
_BF = ("(abs(date - (make_date(year(date), 11, 30) - "
       "((dayofweek(make_date(year(date), 11, 30)) + 2) % 7)::int)) <= 3)::int")
CTES["cal_a"] = (f"""
select date, national_holiday_flag, ramadan_period, is_eid_fitr, is_eid_adha, pre_eid_shopping,
  greatest(is_eid_fitr, is_eid_adha, national_holiday_flag) as public_holidays,
  dubai_shopping_festival, dubai_summer_surprises, end_of_season_sales, year_end_sales,
  black_friday_week,
  greatest(is_eid_adha, pre_eid_shopping, dubai_summer_surprises, black_friday_week)
    as is_high_sales_intent_flag,
  greatest(dubai_shopping_festival, dubai_summer_surprises, end_of_season_sales, year_end_sales,
           black_friday_week, pre_eid_shopping) as shopping_event_code,
  (month(date) in (2, 9))::int as fashion_week_season
from (select date,
        (strftime(date, '%m-%d') in ('01-01', '06-05', '06-26', '11-30', '12-02', '12-03'))::int
          as national_holiday_flag,
        greatest(is_range, pre_range, post_range) as ramadan_period,
        is_feast as is_eid_fitr, is_feast2 as is_eid_adha, pre_feast as pre_eid_shopping,
        (month(date) = 12 or (month(date) = 1 and day(date) <= 15))::int as dubai_shopping_festival,
        (month(date) in (6, 7, 8))::int as dubai_summer_surprises,
        (month(date) in (2, 7, 11))::int as end_of_season_sales,
        (month(date) = 12 and day(date) >= 15)::int as year_end_sales,
        {_BF} as black_friday_week
      from evf)""", ("evf",))
CTES["cal_b"] = ("""
select *, greatest(fashion_week_season, riyadh_fashion_week, jeddah_fashion_week,
                   luxury_ramadan_eid_season, saudi_national_day_season) as luxury_season
from (select date, ramadan_period, pre_eid_shopping,
        greatest(is_eid_fitr, is_eid_adha, national_holiday_flag) as public_holidays,
        (ramadan_period = 1 and month(date) in (3, 4))::int as is_high_sales_intent_flag,
        greatest((month(date) = 9)::int, (month(date) in (3, 8))::int, (month(date) in (6, 7))::int,
                 pre_eid_shopping) as shopping_event_code,
        (month(date) in (2, 3, 9))::int as fashion_week_season,
        (month(date) = 3)::int as riyadh_fashion_week,
        (month(date) = 10)::int as jeddah_fashion_week,
        (month(date) in (2, 3, 4))::int as luxury_ramadan_eid_season,
        (month(date) = 9)::int as saudi_national_day_season
      from (select date, greatest(is_range, pre_range, post_range) as ramadan_period,
                   is_feast as is_eid_fitr, is_feast2 as is_eid_adha, pre_feast as pre_eid_shopping,
                   (strftime(date, '%m-%d') in ('02-22', '09-23'))::int as national_holiday_flag
            from evf))""", ("evf",))
CTES["peak"] = ("""
select date,
  (month(date) in (1, 7, 12) or festive = 1 or (month(date) = 9 and day(date) = 23)
   or (month(date) = 11 and day(date) between 20 and 30)
   or (month(date) = 2 and day(date) between 10 and 16)
   or (month(date) = 3 and day(date) between 15 and 25))::int as peak_flag,
  festive as festive_peak_flag
from (select date, greatest(is_range, is_feast, is_feast2) as festive from evf)""", ("evf",))
CTES["pr"] = ("""
select date_trunc('month', date)::date as date, sum(peak_flag)::bigint as peak_days,
       count(*) as days_in_month, sum(peak_flag) / count(*) as ksa_shopping_peak_ratio
from peak group by 1""", ("peak",))
CTES["hol"] = ("""
select fd as date from feast
union
select make_date(y::int, 2, 22) from yrs
union
select make_date(y::int, 9, 23) from yrs""", ("feast", "yrs"))

SQL["calendar_daily"] = with_("cal_a") + "select * from cal_a"
SQL["holiday_flags"] = with_("cal_a") + """
select date, national_holiday_flag, is_eid_fitr, is_eid_adha, public_holidays from cal_a"""
SQL["ramadan_flags"] = with_("evf") + """
select date, is_range as is_ramadan, pre_range as pre_ramadan, post_range as post_ramadan,
       greatest(is_range, pre_range, post_range) as ramadan_period from evf"""
SQL["eid_flags"] = with_("cal_a") + """
select date, is_eid_fitr, is_eid_adha, pre_eid_shopping from cal_a"""
SQL["shopping_events"] = with_("cal_a") + """
select date, dubai_shopping_festival, dubai_summer_surprises, end_of_season_sales, year_end_sales,
       black_friday_week, is_high_sales_intent_flag, shopping_event_code from cal_a"""
SQL["black_friday"] = with_("spine") + """
select date, make_date(year(date), 11, 30) - ((dayofweek(make_date(year(date), 11, 30)) + 2) % 7)::int
       as black_friday
from spine
where abs(date - (make_date(year(date), 11, 30)
      - ((dayofweek(make_date(year(date), 11, 30)) + 2) % 7)::int)) <= 3"""
SQL["luxury_season"] = with_("cal_b") + """
select date, fashion_week_season, riyadh_fashion_week, jeddah_fashion_week,
       luxury_ramadan_eid_season, saudi_national_day_season, luxury_season,
       is_high_sales_intent_flag, shopping_event_code, public_holidays from cal_b"""
_SEASON = ("case when month(date) in (12, 1, 2) then 1 when month(date) in (3, 4, 5) then 2 "
           "when month(date) in (6, 7, 8, 9) then 3 when month(date) in (10, 11) then 4 end")
SQL["calendar_monthly"] = with_("cal_a") + f"""
select *, day(last_day(date))::int as count_of_days, {_SEASON} as uae_seasons
from (select date_trunc('month', date)::date as date,
        sum(ramadan_period)::bigint as ramadan_period,
        sum(public_holidays)::bigint as public_holidays,
        sum(is_high_sales_intent_flag)::bigint as is_high_sales_intent_flag,
        sum(shopping_event_code)::bigint as shopping_event_code,
        sum(fashion_week_season)::bigint as fashion_week_season
      from cal_a group by 1)"""
SQL["calendar_monthly_b"] = with_("cal_b") + """
select date_trunc('month', date)::date as date, sum(ramadan_period)::bigint as ramadan_days,
  sum(public_holidays)::bigint as public_holiday_days,
  sum(greatest(fashion_week_season, luxury_season))::bigint as fashion_luxury_days,
  day(last_day(date_trunc('month', date)::date))::int as count_of_days
from cal_b group by 1"""
SQL["season_code"] = with_("ap") + f"select key, date, {_SEASON} as uae_seasons from ap"
SQL["peak_calendar"] = with_("peak") + "select * from peak"
SQL["peak_ratio"] = with_("pr") + """
select date, peak_days, days_in_month, round_even(ksa_shopping_peak_ratio, 4)
       as ksa_shopping_peak_ratio from pr"""
SQL["peak_calendar_join"] = with_("ap", "pr") + """
select ap.*, round_even(pr.ksa_shopping_peak_ratio, 4) as ksa_shopping_peak_ratio,
       peak.festive_peak_flag
from ap left join pr on date_trunc('month', ap.date) = pr.date
        left join peak on ap.date = peak.date"""
SQL["holiday_count"] = with_("ap", "hol") + """,
hc as (select year(date) as y, month(date) as m, count(*)::int as n from hol group by 1, 2)
select ap.*, coalesce(hc.n, 0) as holiday_count
from ap left join hc on year(ap.date) = hc.y and month(ap.date) = hc.m"""
SQL["pre_post_event_flag"] = with_("ap", "peak") + """,
j as (select ap.*, peak.festive_peak_flag from ap left join peak on ap.date = peak.date),
near as (select distinct d from (
           select date - interval 1 month as d from j where festive_peak_flag = 1
           union all
           select date + interval 1 month from j where festive_peak_flag = 1))
select j.*, case when j.date in (select d::date from near) then 1 else 0 end as pre_post_rm_flg
from j"""
_TP = "2 * pi()"
SQL["date_features"] = with_("ap") + f"""
select *, month(date)::int as month, quarter(date)::int as quarter, year(date)::int as year,
  (day(date) = 1)::int as is_month_start, (date = last_day(date))::int as is_month_end,
  day(last_day(date))::int as days_in_month,
  round_even(sin({_TP} * month(date) / 12), 6) + 0.0 as fourier_year_sin,
  round_even(cos({_TP} * month(date) / 12), 6) + 0.0 as fourier_year_cos,
  round_even(sin({_TP} * (quarter(date) - 1) / 4), 6) + 0.0 as quarter_sin,
  round_even(cos({_TP} * (quarter(date) - 1) / 4), 6) + 0.0 as quarter_cos
from ap"""

# ---------------------------------------------------------------- promotions
_CUT = "(select date_trunc('month', max(l_shipdate)::date)::date from lineitem)"
_END = (f"(select (date_trunc('month', max(l_shipdate)::date) + interval {HORIZON_MONTHS} month)::date "
        "from lineitem)")

CTES["rel"] = ("""
select *, (datediff('day', eff_from, eff_to) + 1)::int as promo_length
from (select l_suppkey::varchar as locationId, l_partkey as itemId,
        case l_returnflag when 'R' then 'RELATIVE' when 'A' then 'ABSOLUTE' else 'NONE' end
          as strategy,
        round(l_discount * 100)::int as amountOfDiscount,
        l_shipdate::date as eff_from, l_shipdate::date + (l_quantity::int - 1) as eff_to
      from lineitem)
where strategy = 'RELATIVE'""", ())
CTES["pm"] = ("""
select *, unnest(generate_series(ms, eff_to, interval 1 month))::date as date
from (select *, case when day(eff_from) = 1 then eff_from
                     else (date_trunc('month', eff_from) + interval 1 month)::date end as ms
      from rel)
where ms <= eff_to""", ("rel",))
CTES["pd"] = ("""
select locationId, date_trunc('month', d)::date as date, count(*)::int as promo_days_in_month
from (select distinct locationId, unnest(generate_series(eff_from, eff_to, interval 1 day))::date as d
      from rel where eff_from <= eff_to)
group by 1, 2""", ("rel",))
CTES["pmon"] = ("""
select locationId, date, count(distinct amountOfDiscount) as distinct_discount_levels,
       avg(amountOfDiscount) as avg_discount, max(amountOfDiscount)::double as max_discount,
       min(amountOfDiscount)::double as min_discount, avg(promo_length) as avg_promo_duration,
       round_even(count(distinct itemId) / any_value(total) * 100, 2) as percentage_products_on_promo
from pm join (select locationId, count(distinct itemId) as total from rel group by 1) t
     using (locationId)
group by locationId, date""", ("pm",))
CTES["pf"] = ("""
select locationId, date, distinct_discount_levels,
       round_even(coalesce(avg_discount, 0), 2) as avg_discount,
       round_even(coalesce(max_discount, 0), 2) as max_discount,
       round_even(coalesce(min_discount, 0), 2) as min_discount,
       round_even(coalesce(avg_promo_duration, 0), 2) as avg_promo_duration,
       percentage_products_on_promo, coalesce(promo_days_in_month, 0) as promo_days_in_month
from pmon left join pd using (locationId, date)""", ("pmon", "pd"))
_PF_COLS = ("locationId, date, distinct_discount_levels, avg_discount, max_discount, min_discount, "
            "avg_promo_duration, percentage_products_on_promo, promo_days_in_month")
CTES["sply_p"] = (f"""
select {_PF_COLS} from pf where date <= {_CUT}
union all
select {_PF_COLS.replace('date,', "(date + to_months((12 * k)::int))::date as date,", 1)}
from (select *, unnest(generate_series(1, (datediff('month', date, {_END}) // 12)::int))
        as k
      from (select *, max(date) over (partition by locationId) as l
            from pf where date <= {_CUT})
      where date > l - interval 12 month and datediff('month', date, {_END}) >= 12)""",
                    ("pf",))

SQL["promo_length"] = with_("rel") + """
select locationId, itemId, strategy, amountOfDiscount, eff_from, eff_to, promo_length,
       round_even(amountOfDiscount / promo_length, 4) as discount_efficiency from rel"""
SQL["promo_span"] = with_("rel") + """
select locationId, min(eff_from) as min_eff_from_date, max(eff_to) as max_eff_up_to_date
from rel group by 1"""
SQL["promo_days"] = with_("pd") + "select * from pd"
SQL["promo_monthly"] = with_("pmon") + """
select locationId, date, distinct_discount_levels, round_even(avg_discount, 4) as avg_discount,
       max_discount, min_discount, round_even(avg_promo_duration, 4) as avg_promo_duration,
       percentage_products_on_promo from pmon"""
SQL["promo_features"] = with_("pf") + "select * from pf"
SQL["sply_promo"] = with_("sply_p") + "select * from sply_p"
SQL["available_months"] = with_("sply_p") + """
select locationId, count(distinct date)::int as n_months,
       array_to_string(list_sort(list_distinct(list(strftime(date, '%Y-%m')))), ',')
         as available_months
from sply_p group by 1"""

# ---------------------------------------------------------------- marketing
CTES["mkt"] = ("""
select date, brand, campaign_name, source, total_cost_usd, impressions, clicks,
       clicks::double / nullif(impressions, 0)::double as ctr,
       total_cost_usd::double * 1000 / nullif(impressions, 0)::double as cpm,
       total_cost_usd::double / nullif(clicks, 0)::double as cpc,
       upper(nullif(regexp_extract(campaign_name, '(ASIA|EUROPE)', 1, 'i'), '')) as region
from (select o_orderdate::date as date, c_mktsegment as brand,
        lower(r_name) || '_' || o_orderkey as campaign_name,
        lower(split_part(o_orderpriority, '-', 2)) as source,
        o_totalprice::decimal(18,2) as total_cost_usd,
        trunc(o_totalprice)::bigint as impressions, (o_custkey % 50)::bigint as clicks
      from orders join customer on o_custkey = c_custkey
           join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)""", ())
CTES["mkf"] = ("""
select * from mkt
where (brand, region) in (('BUILDING', 'ASIA'), ('MACHINERY', 'EUROPE'), ('AUTOMOBILE', 'ASIA'),
                          ('HOUSEHOLD', 'EUROPE'), ('FURNITURE', 'ASIA'))""", ("mkt",))
CTES["mm"] = ("""
select date_trunc('month', date)::date as month, brand, region,
       sum(total_cost_usd)::decimal(38,2) as total_cost_usd, sum(impressions)::bigint as impressions,
       sum(clicks)::bigint as clicks,
       round_even(avg(ctr), 4) as ctr_l, round_even(avg(cpm), 4) as cpm_l,
       round_even(avg(cpc), 4) as cpc_l,
       round_even(sum(total_cost_usd)::double / nullif(sum(impressions), 0)::double * 1000, 4) as CPM,
       round_even(sum(total_cost_usd)::double / nullif(sum(clicks), 0)::double, 4) as CPC,
       round_even(sum(clicks)::double / nullif(sum(impressions), 0)::double * 100, 4) as CTR
from mkf group by 1, 2, 3""", ("mkf",))
_SRC = ["high", "low", "medium", "not specified", "urgent"]
CTES["mp"] = ("select mm.*, " + ", ".join(
    f"coalesce(s.\"{s}\", 0)::decimal(38,2) as \"total_cost_usd_{s}\"" for s in _SRC) + """
from mm left join (select date_trunc('month', date)::date as month, brand, region, """ + ", ".join(
    f"sum(total_cost_usd) filter (where source = '{s}') as \"{s}\"" for s in _SRC) + """
                   from mkf group by 1, 2, 3) s using (month, brand, region)""", ("mm",))

SQL["campaign_region"] = with_("mkt") + "select date, brand, campaign_name, region from mkt"
SQL["marketing_monthly"] = with_("mm") + "select * from mm"
SQL["marketing_pivot"] = with_("mp") + "select * from mp"
CTES["sply_m"] = (f"""
with base as (select * from mp where month <= {_CUT}),
gen as (select * exclude (l, k) replace ((month + to_months((12 * k)::int))::date as month)
        from (select *, unnest(generate_series(1,
                 (datediff('month', month, {_END}) // 12)::int)) as k
              from (select *, max(month) over (partition by brand, region) as l from base)
              where month > l - interval 12 month
                and datediff('month', month, {_END}) >= 12))
select *, true as is_actual from base
union all by name
select *, false as is_actual from gen""", ("mp",))
SQL["sply_marketing"] = with_("sply_m") + "select * from sply_m"

# ---------------------------------------------------------------- stores & encoders
CTES["stores"] = ("""
select s_suppkey::varchar as store, n_name as city,
       case when s_suppkey % 5 = 0 then 1 else 0 end as is_ecom_fullfillment_loc,
       case when s_suppkey % 5 = 0 then 'ecommerce' else 'retail' end as channel,
       s_acctbal as total_square_ft,
       case when s_suppkey % 7 = 0 then null else s_acctbal / 2 end as selling_square_ft,
       r_name as store_format
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""", ())
CTES["sb"] = ("""
select stores.* replace (coalesce(selling_square_ft, 0.0) as selling_square_ft),
  case when total_square_ft <= q.t[1] then 1 when total_square_ft <= q.t[2] then 2
       when total_square_ft <= q.t[3] then 3 else 4 end as total_square_ft_cat,
  case when coalesce(selling_square_ft, 0.0) <= q.s[1] then 1
       when coalesce(selling_square_ft, 0.0) <= q.s[2] then 2
       when coalesce(selling_square_ft, 0.0) <= q.s[3] then 3 else 4 end as selling_square_ft_cat
from stores, (select quantile_cont(total_square_ft, [0.25, 0.5, 0.75]) as t,
                     quantile_cont(coalesce(selling_square_ft, 0.0), [0.25, 0.5, 0.75]) as s
              from stores) q""", ("stores",))
CTES["aps"] = ("""
select ap.*, channel, store_format, city
from ap left join (select store as key, channel, store_format, city from stores) s using (key)""",
               ("ap", "stores"))


def _te(col: str) -> str:
    return f"""
te_{col} as (select {col}, case when n = 1 then p else p * (1 - sg) + m * sg end as {col}_encode
  from (select {col}, count(target) as n, avg(target::double) as m,
               1.0 / (1.0 + exp(-(count(target) - 20) / 10.0)) as sg,
               (select avg(target::double) from aps where date <= date '{TRAIN_END}') as p
        from aps where date <= date '{TRAIN_END}' group by 1))"""


SQL["quartile_bins"] = with_("sb") + "select * from sb"
SQL["target_encode"] = with_("aps") + "," + ",".join(
    _te(c) for c in ("channel", "store_format", "key")) + """
select aps.*, round_even(channel_encode, 4) as channel_encode,
       round_even(store_format_encode, 4) as store_format_encode,
       round_even(key_encode, 4) as key_encode
from aps left join te_channel using (channel) left join te_store_format using (store_format)
         left join te_key using (key)"""


def _ts(col: str) -> str:
    return f"""
ts_{col} as (select {col}, sum(target) / (select sum(target)::bigint from aps) as {col}_target_pct
             from aps where target is not null group by 1)"""


SQL["target_share_encode"] = with_("aps") + "," + ",".join(
    _ts(c) for c in ("channel", "store_format", "key")) + """
select aps.*, round_even(channel_target_pct, 6) as channel_target_pct,
       round_even(store_format_target_pct, 6) as store_format_target_pct,
       round_even(key_target_pct, 6) as key_target_pct
from aps left join ts_channel using (channel) left join ts_store_format using (store_format)
         left join ts_key using (key)"""
SQL["one_hot"] = with_("stores") + """
select * exclude (channel), (channel = 'retail')::int as channel_retail from stores"""
SQL["binary_encode"] = with_("stores") + """
select *,
       case when city = 'NATION_3' then 1 when city = 'NATION_13' then 0 end as city_code,
       case when channel = 'ecommerce' then 1 else 0 end as channel_code
from stores"""

SQL["binary_encode_sets"] = with_("stores") + """
select *, (lower(city) in ('nation_3', 'nation_13', 'nation_8'))::int as primary_city,
  case when lower(store_format) in ('asia', 'europe') then 1
       when lower(store_format) = 'africa' then 0 end as format_code
from stores"""

# ---------------------------------------------------------------- evaluation
CTES["fc"] = (f"""
select key, date, round_even(ma6, 0) as forecast_xgboost, round_even(lag12, 0) as forecast_lgbm,
       round_even((ma6 + lag12) / 2, 0) as forecast_random_forest, target::double as target
from (select key, date, target,
        coalesce(lag(target, 12) over w::double,
                 (select avg(target) from ap where date <= date '{TRAIN_END}')) as lag12,
        coalesce(avg(target) over (w rows between 6 preceding and 1 preceding), 0) as ma6
      from ap window w as (partition by key order by date))
where date > date '{TRAIN_END}'""", ("ap",))
CTES["ra"] = ("""
select *, abs(target - forecast_xgboost) / nullif(target, 0) * 100 as xgboost_row_mape,
          abs(target - forecast_lgbm) / nullif(target, 0) * 100 as lgbm_row_mape,
          abs(target - forecast_random_forest) / nullif(target, 0) * 100 as random_forest_row_mape
from fc""", ("fc",))
CTES["sc"] = ("""
select * from ra where target is not null and xgboost_row_mape is not null
  and lgbm_row_mape is not null and random_forest_row_mape is not null""", ("ra",))
CTES["cr"] = ("""
select * exclude (b), b.n as best_model_monthly, b.v as best_forecast_monthly, b.e as best_row_mape
from (select *, list_sort([
        {'e': xgboost_row_mape, 'o': 0, 'n': 'xgboost', 'v': forecast_xgboost},
        {'e': lgbm_row_mape, 'o': 1, 'n': 'lgbm', 'v': forecast_lgbm},
        {'e': random_forest_row_mape, 'o': 2, 'n': 'random_forest', 'v': forecast_random_forest}
      ])[1] as b from sc)""", ("sc",))


def _champ(src: str, four: bool = False) -> str:
    extra = ", sum(best_forecast_monthly) as best_forecast_monthly_sum" if four else ""
    cand4 = (""",
        {'e': best_forecast_monthly_mape, 'o': 3, 'n': 'best_monthly',
         'v': best_forecast_monthly_sum}""" if four else "")
    m4 = (", abs(target - best_forecast_monthly_sum) / nullif(target, 0) * 100"
          " as best_forecast_monthly_mape" if four else "")
    return f"""
select * exclude (b), b.n as best_model_store, b.v as best_forecast_store, b.e as best_mape,
       round_even(target / (sum(target) over ()) * 100, 2) as pct_demand
from (select *, list_sort([
        {{'e': xgboost_mape, 'o': 0, 'n': 'xgboost', 'v': forecast_xgboost}},
        {{'e': lgbm_mape, 'o': 1, 'n': 'lgbm', 'v': forecast_lgbm}},
        {{'e': random_forest_mape, 'o': 2, 'n': 'random_forest', 'v': forecast_random_forest}}{cand4}
      ])[1] as b
      from (select *, abs(target - forecast_xgboost) / nullif(target, 0) * 100 as xgboost_mape,
                   abs(target - forecast_lgbm) / nullif(target, 0) * 100 as lgbm_mape,
                   abs(target - forecast_random_forest) / nullif(target, 0) * 100
                     as random_forest_mape{m4}
            from (select key, sum(forecast_xgboost) as forecast_xgboost,
                         sum(forecast_lgbm) as forecast_lgbm,
                         sum(forecast_random_forest) as forecast_random_forest{extra},
                         sum(target) as target
                  from {src} group by key)))"""


CTES["cs"] = (_champ("sc"), ("sc",))
CTES["app"] = ("""
select sc.*, cs.best_model_store,
  case cs.best_model_store when 'xgboost' then forecast_xgboost when 'lgbm' then forecast_lgbm
       when 'random_forest' then forecast_random_forest end as best_forecast_by_store_model,
  abs(sc.target - best_forecast_by_store_model) / nullif(sc.target, 0) * 100 as mape_best_model
from sc left join (select key, best_model_store from cs) cs using (key)""", ("sc", "cs"))

_R4 = "round_even({0}, 4) as {0}"


def _r4(*cols: str) -> str:
    return ", ".join(_R4.format(c) for c in cols)


_APE = ("xgboost_row_mape", "lgbm_row_mape", "random_forest_row_mape")
_STORE = ("xgboost_mape", "lgbm_mape", "random_forest_mape", "best_mape")

SQL["forecast_wide"] = with_("fc") + "select * from fc"
SQL["forecast_long"] = with_("fc") + """
select key, date, model, forecast, key || '_' || strftime(date, '%Y-%m') as label from (
  select key, date, 'xgboost' as model, forecast_xgboost as forecast from fc
  union all select key, date, 'lgbm', forecast_lgbm from fc
  union all select key, date, 'random_forest', forecast_random_forest from fc)"""
SQL["row_mape"] = with_("ra") + f"select * replace ({_r4(*_APE)}) from ra"
SQL["forecast_clean"] = with_("sc") + f"select * replace ({_r4(*_APE)}) from sc"
SQL["metrics"] = with_("sc") + "select * replace (" + _r4(
    "mape", "wmape", "mae", "rmse", "std_actual", "r2", "rmse_over_std") + ") from (" + \
    " union all ".join(f"""
select '{m}' as model, avg(abs(target - forecast_{m}) / nullif(target, 0) * 100) as mape,
  sum(abs(target - forecast_{m})) / nullif(sum(target), 0) * 100 as wmape,
  avg(abs(target - forecast_{m})) as mae,
  sqrt(avg((target - forecast_{m}) * (target - forecast_{m}))) as rmse,
  stddev_samp(target) as std_actual,
  1 - sum((target - forecast_{m}) * (target - forecast_{m}))
      / nullif(var_pop(target) * count(target), 0) as r2,
  sqrt(avg((target - forecast_{m}) * (target - forecast_{m}))) / nullif(stddev_samp(target), 0)
    as rmse_over_std
from sc""" for m in ("xgboost", "lgbm", "random_forest")) + ")"
SQL["champion_row"] = with_("cr") + f"select * replace ({_r4(*_APE, 'best_row_mape')}) from cr"
SQL["champion_store"] = with_("cs") + f"select * replace ({_r4(*_STORE)}) from cs"
SQL["champion_store4"] = with_("cr") + ", cs4 as (" + _champ("cr", True) + ")\n" + \
    f"select * replace ({_r4(*_STORE, 'best_forecast_monthly_mape')}) from cs4"
SQL["champion_filtered"] = with_("sc") + ", csf as (" + _champ(
    "(select * from sc where month(date) in (5, 6, 7))") + ")\n" + \
    f"select * replace ({_r4(*_STORE)}) from csf"
SQL["champion_applied"] = with_("app") + \
    f"select * replace ({_r4(*_APE, 'mape_best_model')}) from app"
SQL["mape_by_month"] = with_("app") + """
select date, sum(target) as target, sum(best_forecast_by_store_model) as best_forecast_by_store_model,
  round_even(abs(sum(target) - sum(best_forecast_by_store_model)) / nullif(sum(target), 0) * 100, 4)
    as mape
from app group by date"""
SQL["mape_overall"] = with_("cs") + """
select """ + ", ".join(
    f"round_even(abs(sum(target) - sum({c})) / nullif(sum(target), 0) * 100, 4) as overall_mape_{n}"
    for c, n in (("forecast_xgboost", "xgboost"), ("forecast_lgbm", "lgbm"),
                 ("forecast_random_forest", "random_forest"), ("best_forecast_store", "best"))) + \
    " from cs"
SQL["champion_compare"] = with_("cr", "app") + """
select round_even((select avg(best_row_mape) from cr), 4) as row_wise_mape,
       round_even((select avg(mape_best_model) from app), 4) as store_wise_mape,
       round_even((select avg(best_mape) from cs), 4) as mean_store_best_mape"""
SQL["model_wins"] = with_("cr") + """
select best_model_monthly as model, count(*) as wins from cr group by 1"""
SQL["model_summary"] = with_("cs", "stores") + """
select store_format as brand, best_model_store, count(distinct key) as stores,
       round_even(avg(best_mape), 4) as avg_mape
from cs left join stores on cs.key = stores.store group by 1, 2"""
SQL["worst_stores"] = with_("cs") + """
select key, target, best_model_store, round_even(best_mape, 4) as best_mape
from cs order by best_mape desc, key limit 10"""
SQL["exclude_keys"] = with_("fc", "stores") + """
select * from fc where key not in (select store from stores where channel = 'ecommerce')"""
SQL["report_table"] = with_("fc", "pf", "mkf") + """
select fc.date, fc.key::bigint as store, 'ALL' as brand, target::bigint as actual_units,
  round_even(forecast_xgboost, 0)::bigint as forecasted_units,
  coalesce(round_even(abs(target - forecast_xgboost) / nullif(target, 0) * 100, 0), 0)::bigint
    as MAPE,
  'Monthly' as frequency, coalesce(pf.avg_discount, 0.0) as promo_depth,
  coalesce(sp.marketing_spend, 0.0) as marketing_spend
from fc left join pf on fc.key = pf.locationId and fc.date = pf.date
        left join (select date_trunc('month', date)::date as date,
                          sum(total_cost_usd)::double as marketing_spend from mkf group by 1) sp
          on fc.date = sp.date"""

# ---------------------------------------------------------------- profiling & hygiene
CTES["flag"] = (f"""
select key, business_type, date, target, ppu,
  round_even(coalesce(lag(target, 12) {W_KD})::double,
                      (select avg(target) from ap where date <= date '{TRAIN_END}')), 4) as Lag12_y,
  round_even(coalesce(avg(target) {W_KD} rows between 6 preceding and 1 preceding), 0), 4) as MA6_y,
  round_even(coalesce(stddev_samp(target) {W_KD} rows between 6 preceding and 1 preceding), 0), 4)
    as STD6_y,
  round_even(coalesce(list_reduce(list(target::double) {W_KD}
      rows between unbounded preceding and 1 preceding),
      lambda acc, v: acc * {B6} + v * {A6}), 0), 4) as EMA6_y
from ap""", ("ap",))
_FLAG_COLS = ["key", "business_type", "date", "target", "ppu", "Lag12_y", "MA6_y", "STD6_y",
              "EMA6_y"]
SQL["profile"] = with_("flag") + " union all ".join(f"""
select (select count(*) from flag) as rows, (select min(date) from flag) as min_date,
       (select max(date) from flag) as max_date, '{c}' as column_name,
       (select count_if({c} is null) from flag)::bigint as nulls, {len(_FLAG_COLS)} as columns"""
                                                    for c in _FLAG_COLS)
SQL["value_counts"] = with_("stores") + " union all ".join(f"""
select '{c}' as column_name, {c}::varchar as value, count(*) as count from stores group by 2"""
    for c in ("channel", "store_format", "city", "is_ecom_fullfillment_loc"))
_FEAT = ["target", "ppu", "Lag12_y", "MA6_y", "STD6_y", "EMA6_y"]
SQL["corr_pairs"] = with_("flag") + " union all ".join(
    f"select '{a}' as feature_a, '{b}' as feature_b, "
    f"round_even(corr({a}::double, {b}::double), 4) as corr from flag"
    for i, a in enumerate(_FEAT) for b in _FEAT[i + 1:])
SQL["csv_roundtrip"] = "select * from (" + SQL["forecast_wide"] + ")"
SQL["truncate_and_load"] = with_("stores") + """
select store, channel, store_format, 'during' as seen, true as empty_load_refused
from stores where channel = 'retail'
union all select store, channel, store_format, 'after', true from stores"""
SQL["blanket_fill"] = with_("stores") + """
select * replace (coalesce(total_square_ft, 0) as total_square_ft,
                  coalesce(selling_square_ft, 0) as selling_square_ft) from stores"""
SQL["promo_day_rows"] = with_("rel") + """
select distinct locationId, unnest(generate_series(eff_from, eff_to, interval 1 day))::date as day
from rel where eff_from <= eff_to"""
SQL["brand_panel"] = f"""
with p as (select l_suppkey::varchar as key, r_name as business_type,
             date_trunc('month', l_shipdate)::date as date,
             sum(trunc(l_extendedprice)::bigint)::bigint as target
           from lineitem join {_GEO} on l_suppkey = s_suppkey
           join part on l_partkey = p_partkey where p_brand = 'Brand#1' group by 1, 2, 3)
select * from p where key in (select key from p where date = (select max(date) from p))"""
SQL["dup_report"] = """
select l_orderkey as tran_seq_no, l_linenumber as line, count(*) as n from lineitem
group by 1, 2 having count(*) > 1"""
SQL["dedup_first"] = with_("rel") + """
select locationId, eff_from, itemId, strategy, amountOfDiscount, eff_to from rel
qualify row_number() over (partition by locationId, eff_from
                           order by itemId, eff_to, amountOfDiscount) = 1"""

# ---------------------------------------------------------------- scans & sinks
SQL["scan_sales"] = """
select l_suppkey::varchar as key, l_shipdate::date as date, l_orderkey as tran_seq_no,
       l_partkey as item, l_extendedprice as amount, l_quantity as quantity,
       n_name as country, r_name as business_type, p_brand as brand
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
     join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey
where p_brand in ('Brand#1', 'Brand#2', 'Brand#3') and n_name in ('NATION_3', 'NATION_13', 'NATION_8')
  and l_shipdate::date between date '1997-01-01' and date '1998-12-31'"""
CTES["active_ids"] = ("""
select distinct key from panel where date = (select max(date) from panel)""", ("panel",))
SQL["scan_promos"] = with_("active_ids") + """
select * from (select l_suppkey::varchar as locationId, l_partkey as itemId,
        case l_returnflag when 'R' then 'RELATIVE' when 'A' then 'ABSOLUTE' else 'NONE' end
          as strategy,
        round(l_discount * 100)::int as amountOfDiscount,
        l_shipdate::date as eff_from, l_shipdate::date + (l_quantity::int - 1) as eff_to
      from lineitem)
where eff_to >= date '1998-01-01' and eff_from <= date '1998-03-31'
  and locationId in (select key from active_ids)"""
SQL["scan_stores"] = with_("active_ids", "stores") + """
select * from stores where store in (select key from active_ids)"""
SQL["scan_marketing"] = with_("mkt") + """
select * exclude (region)
from mkt where brand = 'BUILDING' and date between date '1998-01-01' and date '1998-12-31'"""
SQL["sink_roundtrip"] = with_("pf") + f"""
select v.brand, v.train_end, pf.* from pf, (values ('all', '{TRAIN_END}'),
  ('other', '{TRAIN_END}'), ('all', '1999-12-31')) v(brand, train_end)"""

# ---------------------------------------------------------------- grids, series, feature store
H = HORIZON_MONTHS
SQL["horizon_dates"] = with_("panel") + f"""
select h::int as h, (m + to_months(h::int))::date as date, last_day((m + to_months(h::int))::date)
       as month_end
from (select max(date) as m from panel), range(1, {H + 1}) t(h)"""
SQL["future_grid"] = with_("active_ids") + f"""
select key, (l + to_months(h::int))::date as date
from active_ids, (select max(date) as l from panel), range(1, {H + 1}) t(h)"""
SQL["align_start"] = with_("ap", "pf", "mkf") + """
select * from ap
where date >= greatest((select min(date) from ap), (select min(date) from pf),
                       (select min(date_trunc('month', date))::date from mkf))"""
CTES["ms"] = ("""
select year(m)::int as year, monthname(m) as month, format('{:,}', n) || chr(160) as tourists
from (select date_trunc('month', o_orderdate)::date as m, count(*) as n from orders group by 1)""",
              ())
CTES["cms"] = ("""
select make_date(year, mn, 1) as date, year, mn as month,
       try_cast(replace(replace(tourists, ',', ''), chr(160), '') as bigint) as tourists
from (select *, list_position(['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep',
                               'Oct', 'Nov', 'Dec'], substr(month, 1, 3))::int as mn from ms)""",
               ("ms",))
SQL["clean_month_series"] = with_("cms") + "select * from cms"
SQL["sply_series"] = with_("cms") + """,
s as (select date, tourists from cms),
t as (select max(date) as l, (max(date) + interval 17 month)::date as te from s),
gen as (select (date + to_months((12 * k)::int))::date as date, tourists
        from (select s.*, t.*, unnest(generate_series(1, (datediff('month', date, te) // 12)::int))
                as k from s, t
              where date > l - interval 12 month and datediff('month', date, te) >= 12))
select date, tourists, year(date)::int as year, month(date)::int as month
from (select * from s union all select * from gen)"""
SQL["slug"] = with_("mkt") + """
select brand, replace(lower(brand || ' ' || campaign_name), ' ', '_') as slug from mkt"""
_FMTS = ["%m-%d-%Y", "%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%d-%m-%Y", "%Y/%m/%d %H:%M:%S",
         "%m-%d-%Y %H:%M:%S", "%m-%d-%Y %I:%M %p", "%d-%b-%Y", "%Y%m%d"]
SQL["detect_date_format"] = with_("panel") + """,
s as (select key, strftime(date, '%-m-%-d-%Y') as date_str from panel),
f as (select """ + ", ".join(
    f"count_if(date_str is not null and try_strptime(date_str, '{f}') is null) as f{i}"
    for i, f in enumerate(_FMTS)) + """ from s),
c as (select case """ + " ".join(f"when f{i} = 0 then {i}" for i in range(len(_FMTS))) + """
             end as ch from f)
select key, date_str,
  case ch """ + " ".join(f"when {i} then try_strptime(date_str, '{f}')::date"
                         for i, f in enumerate(_FMTS)) + """ end as parsed_date,
  case ch """ + " ".join(f"when {i} then '{f}'" for i, f in enumerate(_FMTS)) + """
  end as date_format_used
from s, c"""
SQL["train_test_split"] = with_("ap") + f"""
select *, (date > date '{TRAIN_END}')::int as Pred_Flag from ap"""
SQL["recency_weight"] = with_("ap") + f"""
select *, round_even(exp(-0.05::double * datediff('month', date_trunc('month', date),
                                                    date_trunc('month', date '{TRAIN_END}'))), 6)
          as weight
from ap where date <= date '{TRAIN_END}'"""
CTES["cm"] = (f"""
select *, day(last_day(date))::int as count_of_days, {_SEASON}::int as uae_seasons
from (select date_trunc('month', date)::date as date,
        sum(ramadan_period)::bigint as ramadan_period,
        sum(public_holidays)::bigint as public_holidays,
        sum(is_high_sales_intent_flag)::bigint as is_high_sales_intent_flag,
        sum(shopping_event_code)::bigint as shopping_event_code,
        sum(fashion_week_season)::bigint as fashion_week_season
      from cal_a group by 1)""", ("cal_a",))
# ---------------------------------------------------------------- horizon calendars
CTES["spine_h"] = (f"""
select unnest(generate_series(min(l_shipdate)::date,
                              last_day((max(l_shipdate)::date + interval {HORIZON_MONTHS} month)::date),
                              interval 1 day))::date as date from lineitem""", ())


def _horizon_copy(name: str, deps: tuple[str, ...]) -> None:
    body, old = CTES[name]
    for dep in ("spine", "evf", "cal_a", "peak"):
        body = re.sub(rf"\bfrom {dep}\b", f"from {dep}_h", body)
    CTES[name + "_h"] = (body, deps)


_horizon_copy("evf", ("spine_h", "rng", "feast"))
_horizon_copy("cal_a", ("evf_h",))
_horizon_copy("peak", ("evf_h",))
_horizon_copy("pr", ("peak_h",))
_horizon_copy("cm", ("cal_a_h",))


_SC = [f"total_cost_usd_{s}" for s in _SRC]
_FS_CTES = ("flag", "cm_h", "sply_m", "sb", "sply_p", "rel", "mkf")
SQL["feature_store"] = with_(*_FS_CTES) + f""",
fut as (select key, (l + to_months(h::int))::date as date
        from (select distinct key from flag), (select max(date) as l from flag), range(1, {H + 1}) t(h)),
r as (select * from flag where date >= greatest(
        (select min(date) from ap),
        (select min(date_trunc('month', eff_from))::date from rel),
        (select min(date_trunc('month', date))::date from mkf))
      union all by name select * from fut),
spend as (select month as date, """ + ", ".join(f'sum("{c}")::double as "{c}"' for c in _SC) + """
          from sply_m group by 1),
sbk as (select * exclude (store, city), store as key from sb),
pk as (select * exclude (locationId), locationId as key from sply_p)
select r.*, cm_h.* exclude (date), """ + ", ".join(f'coalesce(spend."{c}", 0.0) as "{c}"' for c in _SC) + \
    """, sbk.* exclude (key),
  coalesce(pk.distinct_discount_levels, 0) as distinct_discount_levels,
  coalesce(pk.avg_discount, 0) as avg_discount, coalesce(pk.max_discount, 0) as max_discount,
  coalesce(pk.min_discount, 0) as min_discount,
  coalesce(pk.avg_promo_duration, 0) as avg_promo_duration,
  coalesce(pk.percentage_products_on_promo, 0) as percentage_products_on_promo,
  coalesce(pk.promo_days_in_month, 0) as promo_days_in_month,""" + f"""
  (r.date > date '{TRAIN_END}')::int as Pred_Flag
from r left join cm_h using (date) left join spend using (date) left join sbk using (key)
       left join pk using (key, date)"""

# ---------------------------------------------------------------- recursion
_TMEAN = f"(select avg(target::double) from ap where date <= date '{TRAIN_END}')"


def _nf(h: str) -> dict[str, str]:
    """Next-month features of history list ``h`` (DuckDB list functions)."""
    n = f"len({h})"
    last = f"{h}[greatest({n} - 5, 1):{n}]"
    return {
        "Lag12_y": f"(case when {n} >= 12 then {h}[{n} - 11] else {_TMEAN} end)",
        "MA6_y": f"list_avg({last})",
        "STD6_y": f"list_stddev_samp({last})",
        "EMA6_y": f"list_reduce({h}, lambda acc, v: acc * {B6} + v * {A6})",
    }


CTES["hist"] = ("""
select key, list(target::double order by date) as h, max(date) as last_date from ap group by key""",
                ("ap",))
# The panel with the month to forecast appended to every store, and features recomputed on it.
CTES["nextm"] = ("""
select key, date, target::double as target, false as ahead from ap
union all
select key, (select (max(date) + interval 1 month)::date from ap), null, true
from (select distinct key from ap)""", ("ap",))


def _pct(cur: str, prev: str) -> str:
    return f"round_even(({cur} - {prev}) / nullif({prev}, 0) * 100, 2)"


_W = "over (partition by key order by date)"
SQL["recursive_features"] = with_("hist", "nextm") + f""",
l as (select *, lag(target, 1) {_W} as l1, lag(target, 2) {_W} as l2, lag(target, 4) {_W} as l4,
        lag(target, 7) {_W} as l7 from nextm),
d as (select *, {_pct('l1', 'l2')} as d1, {_pct('l1', 'l4')} as d3, {_pct('l1', 'l7')} as d6 from l),
e as (select *, coalesce({_pct('d1', f'lag(d1) {_W}')}, 0) as d2 from d),
ros as (select key, year(date) as y, sum(l1) / count(distinct date) as rate_of_sale
        from l where l1 is not null group by all),
everyone as (select m, avg(prev) as a from (
    select month(date) as m, lag(target) over (partition by month(date) order by date, key) as prev
    from nextm) group by m),
own as (select key, m, avg(prev) as a from (
    select key, month(date) as m,
      lag(target) over (partition by key, month(date) order by date) as prev from nextm)
  group by key, m),
ix as (select m, round_even(a / nullif((select avg(a) from everyone), 0), 2) as si from everyone),
ixk as (select key, m, round_even(a / nullif(avg(a) over (partition by key), 0), 2) as si from own)
select e.key, e.date, """ + ", ".join(
    f"round_even({v.replace('h)', 'hist.h)').replace('h[', 'hist.h[')}, 4) as {k}"
    for k, v in _nf("h").items()) + """,
  coalesce(ix.si, 1.0) as Seasonality_Index, coalesce(ixk.si, 1.0) as Seasonality_Index_key,
  round_even(ros.rate_of_sale, 4) as rate_of_sale, coalesce(e.d1, 0) as deriv_1_pct,
  e.d2 as deriv_2_pct, coalesce(e.d3, 0) as deriv_3_pct, coalesce(e.d6, 0) as deriv_6_pct,
  case when abs(e.d2) > 50 then 1 else 0 end as deriv_1_flag,
  case when e.d2 > 0 then 'increasing' when e.d2 < 0 then 'decreasing' else 'fluctuating' end
    as deriv_2_trend_flag
from e join hist using (key) left join ros on ros.key = e.key and ros.y = year(e.date)
left join ix on ix.m = month(e.date)
left join ixk on ixk.key = e.key and ixk.m = month(e.date)
where e.ahead"""
_NF = _nf("h")
SQL["recursive_forecast_naive"] = with_("ap", "sply_p") + f""",
o as (select date_trunc('month', date '{TRAIN_END}')::date as origin),
k as (select key, coalesce(list(target::double order by date) filter (date <= origin), []) as h
      from ap, o group by key),
c as (select key, list(coalesce(promo_days_in_month, 0)::double order by i) as c
      from (select distinct key from ap), o, range(1, {H + 1}) t(i)
      left join sply_p on locationId = key and date = (origin + to_months(i::int))::date
      group by key),
r as (
  with recursive rr(key, step, h) as (
    select key, 0, h from k
    union all
    select key, step + 1, list_append(h, 0.5 * {_NF['Lag12_y']}
      + 0.5 * coalesce({_NF['MA6_y']}, {_TMEAN}) + 0.1 * c[step + 1])
    from rr join c using (key) where step < {H})
  select * from rr where step = {H})
select key, (origin + to_months(i::int))::date as date,
       round_even(h[len(h) - {H} + i], 4) as forecast
from r, o, range(1, {H + 1}) t(i)"""
SQL["feature_contract"] = with_("flag") + """
select key, date, EMA6_y, case when month(date) = 1 then null else Lag12_y end as Lag12_y,
  -1.0::double as STD6_y, MA6_y, ppu,
  'extra: extra; missing: STD6_y; mistyped: Lag12_y' as problems from flag"""

_HOLD = f"where date > date '{TRAIN_END}'"
for _q, _flag in (("train_rf", "finite"), ("train_gbt", "finite"), ("train_gbt_fine", "finite"),
                  ("train_recency_weighted", "finite")):
    SQL[f"{_q}_facts"] = with_("ap") + f"""
select key, date, target::double as target, true as {_flag} from ap {_HOLD}"""
SQL["recursive_forecast_facts"] = with_("ap") + f"""
select k.key, (date_trunc('month', date '{TRAIN_END}') + to_months(i::int))::date as date,
  a.target::double as target, true as forecast_by_all
from (select distinct key from ap) k cross join range(1, {H + 1}) t(i)
left join ap a on a.key = k.key
  and a.date = (date_trunc('month', date '{TRAIN_END}') + to_months(i::int))::date"""
SQL["tune_model_facts"] = """
select 'random_forest' as model, 10::bigint as draws, 10::bigint as different,
  10::bigint as positive, 1::bigint as chosen"""
_FEATURE_ROWS = ", ".join(f"('{c}')" for c in FEATURES)
SQL["train_all_facts"] = f"""
select model, {len(FEATURES)}::int as features, true as has_error
from (values ('xgboost'), ('lgbm'), ('random_forest')) m(model)"""
SQL["feature_importance_facts"] = f"""
select feature, true as not_negative, 1.0::double as total from (values {_FEATURE_ROWS}) f(feature)"""
SQL["permutation_importance_facts"] = f"""
select feature, true as measured from (values {_FEATURE_ROWS}) f(feature)"""

CTES["dv"] = ("""
select key, year_month as date,
       case when d2 > 0 then 'increasing' when d2 < 0 then 'decreasing' else 'fluctuating' end
         as deriv_2_trend_flag
from (select key, year_month, coalesce(round_even((r1 - lag(r1) over w) / nullif(lag(r1) over w, 0)
                                                  * 100, 2), 0) as d2
      from (select key, year_month,
                   round_even((lag(t, 1) over w - lag(t, 2) over w) / nullif(lag(t, 2) over w, 0)
                              * 100, 2) as r1
            from (select key, date_trunc('month', date)::date as year_month, sum(target)::double as t
                  from ap group by 1, 2)
            window w as (partition by key order by year_month))
      window w as (partition by key order by year_month))""", ("ap",))
SQL["trend_label_encode"] = with_("ap", "dv") + f""",
rows as (select ap.*, dv.deriv_2_trend_flag from ap left join dv using (key, date)),
te as (select deriv_2_trend_flag,
              case when n = 1 then p else p * (1 - sg) + m * sg end as deriv_2_trend_flag_encode
       from (select deriv_2_trend_flag, count(target) as n, avg(target::double) as m,
                    1.0 / (1.0 + exp(-(count(target) - 20) / 10.0)) as sg,
                    (select avg(target::double) from rows where date <= date '{TRAIN_END}') as p
             from rows where date <= date '{TRAIN_END}' group by 1))
select rows.*, round_even(te.deriv_2_trend_flag_encode, 4) as deriv_2_trend_flag_encode
from rows left join te using (deriv_2_trend_flag)"""

# ---------------------------------------------------------------- master table
def _body(sql: str, prefix: str) -> str:
    """Turn '<with prefix>, a as (...) select ...' into 'with a as (...) select ...'."""
    assert sql.startswith(prefix)
    rest = sql[len(prefix):].lstrip()
    return "with " + rest.lstrip(",").lstrip() if rest.startswith(",") else rest


CTES["dvf"] = (_body(SQL["derivatives"], with_("ap")), ("ap",))
CTES["fsq"] = (_body(SQL["feature_store"], with_(*_FS_CTES)), _FS_CTES)
for _n in ("seasonality_index", "rate_of_sale", "seasonal_means"):
    CTES[f"q_{_n}"] = (_body(SQL[_n], with_("ap")), ("ap",))
CTES["tour"] = (_body(SQL["sply_series"], with_("cms")).replace(
    "select date, tourists, year(date)::int as year, month(date)::int as month",
    "select date, tourists"), ("cms",))


def _te_m(col: str) -> str:
    return f"""
te_{col} as (select {col}, case when n = 1 then p else p * (1 - sg) + m * sg end as {col}_encode
  from (select {col}, count(target) as n, avg(target::double) as m,
               1.0 / (1.0 + exp(-(count(target) - 20) / 10.0)) as sg,
               (select avg(target::double) from m2
                where date <= date '{TRAIN_END}' and target is not null) as p
        from m2 where date <= date '{TRAIN_END}' and target is not null group by 1))"""


_MENC = ["channel", "store_format", "key", "festive_peak_flag", "deriv_2_trend_flag"]
SQL["master_table"] = with_("fsq", "pr_h", "peak_h", "dvf", "hol", "tour", "q_seasonality_index",
                            "q_rate_of_sale", "q_seasonal_means") + f""",
m1 as (select fsq.*, pr_h.ksa_shopping_peak_ratio, peak_h.festive_peak_flag
       from fsq left join pr_h on date_trunc('month', fsq.date) = pr_h.date
                left join peak_h on fsq.date = peak_h.date),
sn as (select s.key, s.date, round_even(Seasonality_Index, 4) as Seasonality_Index, rate_of_sale,
         target_seasonal_monthly, target_seasonal_quarterly
       from q_seasonality_index s join q_rate_of_sale r on s.key = r.key and s.date = r.date
       join q_seasonal_means m on s.key = m.key and s.date = m.date),
m2 as (select m1.*, dvf.* exclude (key, year_month), sn.* exclude (key, date),
         month(m1.date)::int as month, quarter(m1.date)::int as quarter, year(m1.date)::int as year,
         (day(m1.date) = 1)::int as is_month_start, (m1.date = last_day(m1.date))::int as is_month_end,
         day(last_day(m1.date))::int as days_in_month,
         round_even(sin({_TP} * month(m1.date) / 12), 6) + 0.0 as fourier_year_sin,
         round_even(cos({_TP} * month(m1.date) / 12), 6) + 0.0 as fourier_year_cos,
         round_even(sin({_TP} * (quarter(m1.date) - 1) / 4), 6) + 0.0 as quarter_sin,
         round_even(cos({_TP} * (quarter(m1.date) - 1) / 4), 6) + 0.0 as quarter_cos,
         coalesce(hc.n, 0) as holiday_count
       from m1 left join dvf on m1.key = dvf.key and m1.date = dvf.year_month
               left join sn on m1.key = sn.key and m1.date = sn.date
               left join (select year(date) as y, month(date) as mo, count(*)::int as n
                          from hol group by 1, 2) hc
                 on year(m1.date) = hc.y and month(m1.date) = hc.mo),""" + ",".join(
    _te_m(c) for c in _MENC) + """,
m3 as (select m2.* exclude (channel), (m2.channel = 'retail')::int as channel_retail, """ + \
    ", ".join(f"round_even(te_{c}.{c}_encode, 4) as {c}_encode" for c in _MENC) + """
       from m2 """ + " ".join(f"left join te_{c} using ({c})" for c in _MENC) + """),
near as (select distinct d from (
           select date - interval 1 month as d from m3 where festive_peak_flag = 1
           union all select date + interval 1 month from m3 where festive_peak_flag = 1))
select m3.* replace (round_even(ksa_shopping_peak_ratio, 4) as ksa_shopping_peak_ratio),
       case when m3.date in (select d::date from near) then 1 else 0 end as pre_post_rm_flg,
       tour.tourists
from m3 left join tour using (date)"""


# ---------------------------------------------------------------- correlations of the master table
_NOT_NUMBERS = {"key", "date", "business_type", "store_format", "deriv_2_trend_flag"}
_MASTER_NUMBERS = ["target", "ppu", "Lag12_y", "MA6_y", "STD6_y", "EMA6_y", *COVARIATES,
                   "festive_peak_flag", "Pred_Flag", "deriv_1_pct", "deriv_3_pct", "deriv_6_pct",
                   "deriv_2_pct", "monthly_max_qty", "monthly_min_qty", "deriv_1_flag", *SEASONAL,
                   "month", "quarter", "year", "deriv_2_trend_flag_encode"]


def _pairs(cols) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def _corr_of(group: str, cols) -> str:
    """One row a pair; which column comes first follows the master table's order."""
    entries = ", ".join(
        f"""{{'a': '{a}', 'b': '{b}', 'c': corr("{a}"::double, "{b}"::double)}}"""
        for a, b in _pairs(cols))
    return (f"select '{group}' as grp, x.a as a, x.b as b, x.c as c "
            f"from (select unnest([{entries}]) as x from m)")


_MASTER_ORDER = [
    "festive_peak_flag", "target", "ppu", "Lag12_y", "MA6_y", "STD6_y", "EMA6_y",
    "ramadan_period", "public_holidays", "is_high_sales_intent_flag", "shopping_event_code",
    "fashion_week_season", "count_of_days", "uae_seasons", *MKT_SRC_COLS,
    "is_ecom_fullfillment_loc", "total_square_ft", "selling_square_ft", "total_square_ft_cat",
    "selling_square_ft_cat", *PROMO_FILL, "Pred_Flag", "ksa_shopping_peak_ratio", "deriv_1_pct",
    "deriv_3_pct", "deriv_6_pct", "deriv_2_pct", "monthly_max_qty", "monthly_min_qty",
    "deriv_1_flag", *SEASONAL, "month", "quarter", "year", "is_month_start", "is_month_end",
    "days_in_month", "fourier_year_sin", "fourier_year_cos", "quarter_sin", "quarter_cos",
    "holiday_count", *(f"{c}_encode" for c in _MENC), "channel_retail", "pre_post_rm_flg",
    "tourists"]
assert sorted(_MASTER_ORDER) == sorted(_MASTER_NUMBERS)
SQL["corr_matrix"] = ("with m as materialized (" + SQL["master_table"] + "), c as ("
                      + " union all ".join(_corr_of(g, cols) for g, cols in
                                           {"all": _MASTER_ORDER, **CORR_GROUPS}.items())
                      + """)
select grp, a as feature_a, b as feature_b,
  case when isfinite(c) then round_even(c, 3) + 0.0 end as corr from c""")
