"""Bronze insurance tables derived from the TPC-H style test tables.

Each text is one SELECT valid in Spark and in DuckDB, so the engine and the oracle start from the
same rows. ``{name}`` marks an input: a base table or an earlier bridge table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pcmarts.functions import classify
from pcmarts.sources import payloads

# Columns of the test tables. A stated schema spares the job that would infer it.
BASE: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Fixed texts: the bridge definition. In build order.
SQL: dict[str, str] = {
    "b_geo": """
select n.n_nationkey*4+z.z as geo_id, 'N'||lpad(cast(n.n_nationkey as string),2,'0') as state_code, n.n_name as state_name, r.r_name as region,
  cast(10000+n.n_nationkey*4+z.z as string) as zip_code, 'CZ-'||cast(n.n_nationkey as string)||'-'||cast(z.z+1 as string) as cresta_zone, 'USA' as country,
  cast(n.n_nationkey*4-5 as double) as latitude, cast(-120+n.n_nationkey as double) as longitude,
  z.z%3+1 as windstorm_zone, case z.z when 0 then 'X' when 1 then 'A' when 2 then 'AE' else 'V' end as flood_zone
from {nation} n join {region} r on n.n_regionkey=r.r_regionkey cross join (select 0 as z union all select 1 union all select 2 union all select 3) z""",
    "b_cust": """
select case when c_custkey%500=499 then null else c_custkey end as customer_id, c_name as customer_name,
  case when c_mktsegment in ('BUILDING','MACHINERY') then 'Business' else 'Individual' end as customer_type,
  'c'||cast(c_custkey as string)||'@mail.test' as email, case when c_custkey%10=0 then cast(5550000+c_custkey as string) end as phone,
  '19'||cast(50+c_custkey%50 as string)||'-0'||cast(1+c_custkey%9 as string)||'-15' as date_of_birth,
  c_nationkey*4+c_custkey%4 as geo_id,
  case c_custkey%5 when 0 then '<50k' when 1 then '50-100k' when 2 then '100-200k' when 3 then '200k-500k' else '>500k' end as income_bracket, 550+c_custkey%300 as credit_score,
  case when c_acctbal<4000 then 'Bronze' when c_acctbal<7000 then 'Silver' when c_acctbal<9000 then 'Gold' else 'Platinum' end as loyalty_tier,
  c_custkey%3<>0 as marketing_consent, '2015-01-'||lpad(cast(1+c_custkey%28 as string),2,'0') as signup_date
from {customer}""",
    "b_agent": """
select s_suppkey as agent_id, s_name as agent_name, case s_suppkey%5 when 0 then 'Agent' when 1 then 'Broker' when 2 then 'Direct' when 3 then 'Digital' else 'Aggregator' end as channel,
  'N'||lpad(cast(s_nationkey as string),2,'0') as license_state, case s_suppkey%3 when 0 then 'Personal' when 1 then 'Commercial' else 'Specialty' end as specialty_lob,
  cast(s_acctbal as decimal(18,2)) as ytd_commission_usd, '2010-0'||cast(1+s_suppkey%9 as string)||'-01' as hire_date, s_suppkey%12<>0 as active
from {supplier}""",
    "b_pol": """
select policy_id, customer_id, geo_id, agent_id, line_of_business,
  case line_of_business when 'Personal' then case policy_id%5 when 0 then 'Auto' when 1 then 'Home' when 2 then 'Life' when 3 then 'Renters' else 'Umbrella' end when 'Commercial' then case policy_id%5 when 0 then 'Property' when 1 then 'GeneralLiability' when 2 then 'WorkersComp' when 3 then 'DandO' else 'ProfessionalLiability' end else case policy_id%5 when 0 then 'Marine' when 1 then 'Aviation' when 2 then 'Cyber' when 3 then 'EnvironmentalLiability' else 'Energy' end end as product,
  policy_status, case customer_id%5 when 0 then 'Agent' when 1 then 'Broker' when 2 then 'Direct' when 3 then 'Digital' else 'Aggregator' end as channel, effective_date, date_add(effective_date, 365) as expiration_date, annual_premium_usd,
  cast(case when policy_id%211=0 then 0 else annual_premium_usd*(40+policy_id%461) end as decimal(18,2)) as sum_insured_usd,
  cast(annual_premium_usd*cast(0.1 as decimal(2,1)) as decimal(18,2)) as deductible_usd, 12 as policy_term_months, 'USD' as currency, policy_id%20<7 as reinsured,
  cast(cast(policy_id*37%1000 as decimal(9,0))*cast(0.1 as decimal(2,1)) as decimal(9,1)) as underwriter_score
from (select o_orderkey as policy_id, o_custkey as customer_id, ((c_nationkey+case when o_orderkey%9=0 then 1 else 0 end)%25)*4+o_orderkey%4 as geo_id,
        case when o_orderkey%50=0 then -1 else o_orderkey%10 end as agent_id, case when o_orderpriority in ('1-URGENT','2-HIGH','3-MEDIUM') then 'Personal' when o_orderpriority='4-NOT SPECIFIED' then 'Commercial' else 'Specialty' end as line_of_business,
        case when o_orderstatus in ('O','F') then 'Active' when o_orderkey%3=0 then 'Lapsed' when o_orderkey%3=1 then 'Cancelled' else 'Pending' end as policy_status,
        cast(o_orderdate as date) as effective_date, cast(o_totalprice as decimal(18,2)) as annual_premium_usd
      from {orders} join {customer} on o_custkey=c_custkey) t""",
    "b_prem": """
select cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string) as premium_id,
  l_orderkey as policy_id, p.line_of_business, p.product, cast(l_shipdate as date) as billing_month,
  cast(l_extendedprice as decimal(18,2)) as gross_premium_usd,
  cast(cast(l_extendedprice as decimal(18,2))*cast(l_tax as decimal(4,2)) as decimal(18,2)) as commission_usd,
  cast(cast(l_extendedprice as decimal(18,2))*cast(0.06 as decimal(3,2)) as decimal(18,2)) as tax_usd, l_linestatus='F' as paid,
  cast(cast(l_extendedprice as decimal(18,2))*cast(l_discount as decimal(4,2)) as decimal(18,2)) as ceded_to_reinsurance_usd
from {lineitem} join {b_pol} p on l_orderkey=p.policy_id
where l_returnflag<>'R'""",
    "b_clm": """
select claim_id, case when l_partkey%97=0 then -l_orderkey-1 else l_orderkey end as policy_id, line_of_business, product,
  case l_partkey%7 when 0 then 'Fire' when 1 then 'Wind' when 2 then 'Flood' when 3 then 'Theft' when 4 then 'Collision' when 5 then 'Earthquake' else 'Ransomware' end as peril,
  case when l_linenumber=7 then (geo_id+4)%100 else geo_id end as geo_id, loss_date, date_add(loss_date, cast(l_partkey%45 as int)) as report_date,
  case l_linenumber-1 when 0 then 'Open' when 1 then 'InvestigationInProgress' when 2 then 'Approved' when 3 then 'Denied' when 4 then 'Closed' else 'Litigation' end as claim_status,
  incurred as incurred_amount_usd, paid as paid_amount_usd, cast(incurred-paid as decimal(18,2)) as reserve_amount_usd,
  cast(paid*cast(l_discount as decimal(4,2)) as decimal(18,2)) as salvage_recovery_usd, cast(paid*cast(0.03 as decimal(3,2)) as decimal(18,2)) as subrogation_recovery_usd,
  l_quantity>48 as fraud_flag, case when l_partkey%10=0 then case l_suppkey%4 when 0 then 'CAT-HU-2024' when 1 then 'CAT-EQ-2024' when 2 then 'CAT-WF-2025' else 'CAT-FL-2025' end end as catastrophe_code
from (select l.*, p.line_of_business, p.product, p.geo_id, cast(l_shipdate as date) as loss_date,
        cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string) as claim_id,
        cast(l_extendedprice as decimal(18,2)) as incurred,
        cast(cast(l_extendedprice as decimal(18,2))*cast(60+l_suppkey%41 as decimal(9,0))*cast(0.01 as decimal(3,2)) as decimal(18,2)) as paid
      from {lineitem} l join {b_pol} p on l_orderkey=p.policy_id where l_returnflag='R') t""",
    "b_treaty": """
select s_suppkey as treaty_id, case s_suppkey%5 when 0 then 'QuotaShare' when 1 then 'SurplusShare' when 2 then 'ExcessOfLoss' when 3 then 'Stop-Loss' else 'CatastropheXL' end as treaty_type,
  'Reinsurer '||cast(s_suppkey%6 as string) as reinsurer, case s_suppkey%3 when 0 then 'Personal' when 1 then 'Commercial' else 'Specialty' end as line_of_business,
  cast(cast(100+s_suppkey%701 as decimal(9,0))*cast(0.001 as decimal(4,3)) as decimal(9,3)) as cession_pct,
  cast(abs(cast(s_acctbal as decimal(18,2)))*1000 as decimal(18,2)) as limit_usd, cast(abs(cast(s_acctbal as decimal(18,2)))*200 as decimal(18,2)) as retention_usd,
  cast(abs(cast(s_acctbal as decimal(18,2)))*500 as decimal(18,2)) as premium_ceded_usd,
  date_add(date '2001-01-01', cast(s_suppkey%300 as int)) as treaty_start, date_add(date '2002-01-01', cast(s_suppkey%300 as int)) as treaty_end, s_suppkey%9<>0 as active
from {supplier}""",
    "b_asset": """
select p_partkey as asset_id, case p_type when 'STANDARD' then 'Govt Bond' when 'PROMO' then 'Corp Bond IG' when 'ECONOMY' then 'Corp Bond HY' when 'MEDIUM' then 'Equity' when 'SMALL' then 'Real Estate' else 'MMF' end as asset_class,
  case p_size%8 when 0 then 'AAA' when 1 then 'AA' when 2 then 'A' when 3 then 'BBB' when 4 then 'BB' when 5 then 'B' when 6 then 'CCC' else 'NotRated' end as rating, p_name as issuer,
  case p_partkey%4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'GBP' else 'CHF' end as currency,
  cast(cast(p_retailprice as decimal(18,2))*p_size*1000 as decimal(18,2)) as market_value_usd,
  cast(cast(p_retailprice as decimal(18,2))*p_size*10*(92+p_partkey%17) as decimal(18,2)) as book_value_usd,
  cast(cast(20+p_partkey%80 as decimal(9,0))*cast(0.001 as decimal(4,3)) as decimal(9,4)) as yield_pct,
  cast(cast(p_partkey%150 as decimal(9,0))*cast(0.1 as decimal(2,1)) as decimal(9,2)) as duration_yrs,
  cast(date_add(date '1995-01-01', cast(p_partkey%2000 as int)) as string) as purchase_date, cast(date_add(date '2003-01-01', cast(p_partkey%5000 as int)) as string) as maturity_date,
  cast(cast(200+p_partkey%751 as decimal(9,0))*cast(0.1 as decimal(2,1)) as decimal(9,1)) as esg_score
from {part}""",
    "b_alert": """
select event_id as alert_id, case user_id%3 when 0 then 'Tornado Warning' when 1 then 'Flash Flood Warning' else 'Heat Advisory' end as event_type,
  case when value>100 then 'Extreme' when value>50 then 'Severe' when value>20 then 'Moderate' when value>5 then 'Minor' else null end as severity,
  case when value>50 then 'Immediate' else 'Expected' end as urgency,
  case when event_id%3=0 then 'N'||lpad(cast(user_id%30 as string),2,'0')||' County' else 'County, NATION_'||cast(user_id%30 as string) end as area_desc,
  cast(ts as timestamp) as effective_utc, cast(ts as timestamp) + interval 6 hours as expires_utc
from {events} where event_type='error'""",
    "b_cat": """
select event_id, case event_id%7 when 0 then 'Red Earthquake alert' when 1 then 'Orange TC warning' when 2 then 'Green Flood alert' when 3 then 'Green WF wildfire' when 4 then 'Orange Drought' when 5 then 'Red Volcan unrest' else 'Notice' end || ' ' || cast(user_id as string) as title,
  cast(user_id%180 as double)-90 as latitude, cast(event_id%360 as double)-180 as longitude, cast(ts as timestamp) as event_time_utc
from {events} where event_type='purchase'""",
    "b_quake": """
select event_id, 'Earthquake' as event_type, cast(cast(cast(value as decimal(9,2))*cast(0.02 as decimal(3,2)) as decimal(9,4)) as double) as magnitude,
  'place '||cast(user_id as string) as place, cast(user_id%100 as double) as depth_km, cast(ts as timestamp) as event_time_utc
from {events} where event_type='click'""",
    "b_weather": """
select event_id as observation_id, 'City '||cast(user_id%15 as string) as city, 'CZ-'||cast(user_id%25 as string)||'-1' as cresta_zone, cast(user_id%100 as double) as latitude,
  cast(user_id%110 as double) as temperature_f, value as wind_speed_mph, case when event_id%9=0 then null else value end as wind_gust_mph,
  cast(event_id%3 as double) as precipitation_in, cast(user_id%101 as double) as humidity_pct, cast(ts as timestamp) as observed_time_utc
from {events} where event_type='view'""",
    "b_news": """
select doc_id as news_id, case doc_id%6 when 0 then 'Flood in ' when 1 then 'Ransomware at ' when 2 then 'Outbreak of ' when 3 then 'Conflict near ' when 4 then 'Storm warning ' else 'Report on ' end || source as title,
  text as summary, date_add(date '2024-01-01', cast(doc_id%60 as int)) as published_date
from {documents}""",
    "b_pc_combined": """
select reporting_quarter, line_of_business, sub_line, loss_ratio_pct, expense_ratio_pct, loss_ratio_pct+expense_ratio_pct as combined_ratio_pct, gwp_eur_m
from (select cast(year(l_shipdate) as string)||'-Q'||cast(quarter(l_shipdate) as string) as reporting_quarter, p.line_of_business, p.product as sub_line,
  cast(sum(case when l_returnflag='R' then cast(l_extendedprice as decimal(18,2)) else 0 end) as double)/nullif(cast(sum(case when l_returnflag='A' then cast(l_extendedprice as decimal(18,2)) else 0 end) as double),0)*100 as loss_ratio_pct,
  cast(sum(cast(l_extendedprice as decimal(18,2))*cast(l_tax as decimal(4,2))) as double)/nullif(cast(sum(case when l_returnflag='A' then cast(l_extendedprice as decimal(18,2)) else 0 end) as double),0)*100 as expense_ratio_pct,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as gwp_eur_m
from {lineitem} join {b_pol} p on l_orderkey=p.policy_id group by 1,2,3) t""",
    "b_pc_triangle": """
select cast(year(l_shipdate) as int) as accident_year, l_linenumber as development_period, case l_suppkey%3 when 0 then 'Personal' when 1 then 'Commercial' else 'Specialty' end as line_of_business,
  sum(cast(l_extendedprice as decimal(18,2))) as incremental_paid_eur_m,
  sum(case when l_linestatus='O' then cast(cast(l_extendedprice as decimal(18,2))*cast(0.2 as decimal(2,1)) as decimal(18,2)) else 0 end) as case_reserves_eur_m
from {lineitem} where l_returnflag='R' group by 1,2,3""",
    "b_pc_treaty": """
select s_suppkey as treaty_id, case s_suppkey%4 when 0 then 'QuotaShare' when 1 then 'Surplus' when 2 then 'XL' else 'Stop-Loss' end as treaty_type, 'Reinsurer '||cast(s_suppkey%5 as string) as reinsurer,
  case s_suppkey%3 when 0 then 'Personal' when 1 then 'Commercial' else 'Specialty' end as line_of_business, cast(abs(cast(s_acctbal as decimal(18,2))) as decimal(18,2)) as limit_eur_m,
  cast(abs(cast(s_acctbal as decimal(18,2)))*cast(0.2 as decimal(2,1)) as decimal(18,2)) as ceded_premium_eur_m, cast(10+s_suppkey%71 as decimal(9,2)) as cession_pct,
  cast(date_add(date '2001-01-01', cast(s_suppkey%200 as int)) as string) as inception_date, cast(date_add(date '2002-01-01', cast(s_suppkey%200 as int)) as string) as expiry_date
from {supplier}""",
    "b_pc_solvency": """
select reporting_date, market as scr_market_risk, nonlife as scr_underwriting_non_life, life as scr_underwriting_life, health as scr_underwriting_health, credit as scr_credit_risk,
  operational as scr_operational_risk, 0e0-modules*0.25e0 as diversification_benefit, modules*0.75e0 as total_scr_eur_m, own as own_funds_eur_m, modules*0.3375e0 as mcr_eur_m,
  case when modules>0 then own/(modules*0.75e0)*100 end as solvency_ratio_pct
from (select *, market+nonlife+life+health+credit+operational as modules
  from (select last_day(make_date(cast(y as int), cast(q*3 as int), 1)) as reporting_date, premium*0.0625e0 as market, premium*0.125e0+loss*0.25e0 as nonlife, loss*0.0625e0 as life,
      tax*0.5e0 as health, discount*0.25e0 as credit, premium*0.03125e0 as operational, (premium-loss-loss)*0.75e0 as own
    from (select year(l_shipdate) as y, quarter(l_shipdate) as q, cast(sum(cast(l_extendedprice as decimal(18,2))) as double)/1000000e0 as premium,
        cast(sum(case when l_returnflag='R' then cast(l_extendedprice as decimal(18,2)) else 0 end) as double)/1000000e0 as loss,
        cast(sum(cast(l_extendedprice as decimal(18,2))*cast(l_tax as decimal(4,2))) as double)/1000000e0 as tax,
        cast(sum(cast(l_extendedprice as decimal(18,2))*cast(l_discount as decimal(4,2))) as double)/1000000e0 as discount
      from {lineitem} where l_shipdate is not null group by 1, 2) sums) charges) t""",
    "b_pc_pol": """
select o_orderkey as policy_id, line_of_business, product as sub_line, cast(o_totalprice as decimal(18,2)) as gwp_eur, cast(o_orderkey%100 as int) as risk_score,
  cast(cast(o_orderdate as date) as string) as inception_date, cast(date_add(cast(o_orderdate as date), 365) as string) as expiry_date
from {orders} join {b_pol} p on o_orderkey=p.policy_id""",
    "b_pc_clm": """
select l_orderkey as policy_id, cast(cast(l_shipdate as date) as string) as loss_date, cast(date_add(cast(l_shipdate as date), cast(l_suppkey%30 as int)) as string) as report_date,
  cast(l_extendedprice as decimal(18,2)) as paid_amount, case when l_partkey%13=0 then null else cast(l_extendedprice*0 + l_quantity as decimal(18,2)) end as reserved_amount, l_linenumber=7 as litigation_flag
from {lineitem} where l_returnflag='R'""",
    "b_pc_asset": """
select asset_id, asset_class, rating, cast(market_value_usd*cast(0.9 as decimal(2,1)) as decimal(18,2)) as market_value_eur, yield_pct, duration_yrs, esg_score,
  case asset_id%4 when 0 then 'Energy' when 1 then 'Banks' when 2 then 'Public' else 'Property' end as sector, cast(date_add(date '2026-01-01', cast(asset_id%3000 as int)) as string) as maturity_date
from {b_asset}""",
    "b_pc_risk": """
select o_orderkey as policy_id, cast(year(o_orderdate) as int) as exposure_year, cast(o_totalprice as decimal(18,2)) as pml_eur, cast(10+o_orderkey%490 as int) as return_period,
  cast(cast(o_orderkey%60 as decimal(9,0))*cast(0.01 as decimal(3,2)) as decimal(9,2)) as climate_risk_factor
from {orders}""",
    "b_pc_weather": """
select event_id, case user_id%3 when 0 then 'Hurricane' when 1 then 'Flood' else 'Wildfire' end as event_type, cast(cast(ts as date) as string) as event_date,
  cast(value as decimal(18,2)) as insured_loss_eur_m, cast(user_id%200 as double) as wind_speed, cast(event_id%300 as double) as rainfall
from {events} where event_type='signup'""",
    "b_pc_realtime": """
select event_id, cast(cast(ts as timestamp) as string) as event_timestamp, cast(cast(event_id%101 as decimal(9,0))*cast(0.01 as decimal(3,2)) as decimal(9,2)) as relevance_score, event_id%101>80 as action_required
from {events} where event_type='signup'""",
}

# bronze table -> bridge view
VIEWS = {
    "geography": "b_geo", "customers": "b_cust", "agents": "b_agent", "policies": "b_pol",
    "premiums": "b_prem", "claims": "b_clm", "reinsurance_treaties": "b_treaty",
    "asset_portfolio": "b_asset", "noaa_alerts": "b_alert", "catastrophe_events": "b_cat",
    "earthquakes": "b_quake", "weather_obs": "b_weather", "news": "b_news",
    "pc_policies": "b_pc_pol", "pc_claims": "b_pc_clm", "pc_investment_assets": "b_pc_asset",
    "pc_reinsurance_treaties": "b_pc_treaty", "pc_weather_events": "b_pc_weather",
    "pc_realtime_events": "b_pc_realtime", "pc_combined_ratios": "b_pc_combined",
    "pc_loss_development": "b_pc_triangle", "pc_risk_exposure": "b_pc_risk",
    "pc_solvency_metrics": "b_pc_solvency",
}


class BridgeReader:
    """Bronze reader over a folder of test tables; views are composed on demand."""

    def __init__(self, spark: SparkSession, folder: str, streaming: tuple[str, ...] = ()):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.streaming = streaming  # base tables to read as a file stream
        self._views: dict[str, DataFrame] = {}

    def as_stream(self, *names: str) -> "BridgeReader":
        return BridgeReader(self.spark, self.folder, streaming=names)

    def base(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if name not in self.streaming:
            return self.spark.read.schema(BASE[name]).parquet(path)
        # a file stream wants a folder or a pattern; this pattern matches the one path
        return self.spark.readStream.schema(BASE[name]).parquet(f"{path[:-1]}[{path[-1]}]")

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            if name in SQL:
                text = SQL[name]
                inputs = {i: self.view(i) for i in set(re.findall(r"\{(\w+)\}", text))}
                self._views[name] = self.spark.sql(text, **inputs)
            else:
                self._views[name] = self.base(name)
        return self._views[name]

    def __call__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.view(name)
        if name in DERIVED:
            return DERIVED[name](self)
        df = self.view(VIEWS[name])
        dress = _AS_FEED.get(name)
        return dress(df) if dress else df


def _iso(c: str):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _mail(c):
    return F.date_format(c, "d MMM yyyy HH:mm:ss 'GMT'")


def _fetched(c):
    """Feeds are polled hourly; the fetch stamp is the end of the hour of the event."""
    return F.date_format(F.date_trunc("hour", c) + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _alerts(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("alert_id").cast("string").alias("alert_id"), "event_type", "severity",
        F.lit("Likely").alias("certainty"), "urgency", "area_desc",
        F.concat_ws(" for ", "event_type", "area_desc").alias("headline"),
        _iso("effective_utc").alias("sent_utc"), _iso("effective_utc").alias("effective_utc"),
        _iso("expires_utc").alias("expires_utc"), _fetched(F.col("effective_utc")).alias("fetched_at_utc"),
        F.lit("alerts").alias("source"),
    )


def _catastrophes(df: DataFrame) -> DataFrame:
    weekday = F.element_at(
        F.array(*[F.lit(d) for d in ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")]), F.dayofweek("event_time_utc")
    )
    mail = F.concat(weekday, F.lit(", "), _mail("event_time_utc"))
    # every second item carries a mail-style date, as real RSS does; the others ISO
    when = F.when(F.col("event_id") % 2 == 0, mail).otherwise(_iso("event_time_utc"))
    return df.select(
        F.col("event_id").cast("string").alias("event_id"), "title",
        F.concat(F.lit("Bulletin: "), "title").alias("description"),
        classify.catastrophe_type("title").alias("event_type"),
        classify.alert_colour("title").alias("severity"), "latitude", "longitude",
        when.alias("event_time_utc"),
        F.concat(F.lit("https://feed.test/"), F.col("event_id").cast("string")).alias("link"),
        _fetched(F.col("event_time_utc")).alias("fetched_at_utc"), F.lit("disasters").alias("source"),
    )


def _quakes(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", "magnitude", "place",
        (F.col("depth_km") - 50).alias("longitude"), (F.col("depth_km") / 2).alias("latitude"), "depth_km",
        _iso("event_time_utc").alias("event_time_utc"),
        F.concat(F.lit("https://feed.test/quake/"), F.col("event_id").cast("string")).alias("url"),
        classify.earthquake_severity("magnitude").alias("severity"),
        _fetched(F.col("event_time_utc")).alias("fetched_at_utc"), F.lit("quakes").alias("source"),
    )


def _weather(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("observation_id").cast("string").alias("observation_id"), "city", "cresta_zone", "latitude",
        (F.col("latitude") - 120).alias("longitude"), _iso("observed_time_utc").alias("observed_time_utc"),
        "temperature_f", "wind_speed_mph", "wind_gust_mph", "precipitation_in",
        F.col("precipitation_in").alias("rain_in"), (F.col("humidity_pct") % 4).cast("int").alias("weather_code"),
        (F.col("humidity_pct") + 950).alias("pressure_mb"), "humidity_pct",
        _fetched(F.col("observed_time_utc")).alias("fetched_at_utc"), F.lit("weather").alias("source"),
    )


def _news(df: DataFrame) -> DataFrame:
    at = F.col("published_date").cast("timestamp")
    return df.select(
        F.col("news_id").cast("string").alias("news_id"), "title", "summary", _mail(at).alias("published_utc"),
        F.concat(F.lit("https://feed.test/news/"), F.col("news_id").cast("string")).alias("link"),
        classify.news_category("title").alias("category"),
        F.date_format(at + F.expr("interval 1 day"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at_utc"),
        F.lit("news").alias("source"),
    )


# Feeds arrive as text: timestamps are rendered the way the feeds spell them, then typed in silver.
_AS_FEED = {
    "noaa_alerts": _alerts, "catastrophe_events": _catastrophes, "earthquakes": _quakes,
    "weather_obs": _weather, "news": _news,
}


def raw_payloads(reader: BridgeReader, feed: str) -> DataFrame:
    """Raw answers of one feed rebuilt from the event and document rows: JSON or RSS text, some of it broken.

    Every tenth answer (id ending in 3) is cut off or not a feed, every tenth (ending in 7) failed.
    """
    columns = ("feed", "request", "fetched_at_utc", "status", "payload")

    def answer(df: DataFrame, feed: str, key: str, at: str, payload, request=None) -> DataFrame:
        whole = df.select(
            F.lit(feed).alias("feed"), (request if request is not None else F.lit(None).cast("string")).alias("request"),
            _fetched(F.col(at)).alias("fetched_at_utc"),
            F.when(F.col(key) % 10 == 7, 503).otherwise(200).alias("status"),
            (F.col(key) % 10 == 3).alias("bad"), payload.alias("payload"),
        )
        cut = F.substr(F.col("payload"), F.lit(4), F.length("payload") - 8)
        broken = F.lit("<html>upstream timeout</html>") if feed in payloads.RSS_FEEDS else cut
        return whole.withColumn("payload", F.when(F.col("bad"), broken).otherwise(F.col("payload"))).select(*columns)

    def text(c: str):
        return F.col(c).cast("string")

    def quake_feature(k: int):
        return F.struct(
            F.concat(F.lit("q"), text("event_id"), F.lit(f"-{k}")).alias("id"),
            F.struct(
                F.when(F.col("event_id") % 11 != 0, F.col("magnitude") + F.lit(0.25 * k)).alias("mag"), "place",
                F.when(F.col("event_id") % 13 != 0, F.unix_millis("event_time_utc") + F.lit(1000 * k)).alias("time"),
                F.concat(F.lit("https://feed.test/q/"), text("event_id")).alias("url"),
            ).alias("properties"),
            F.struct(F.array(F.col("depth_km") - 50, F.col("depth_km") / 2, F.col("depth_km")).alias("coordinates")).alias("geometry"),
        )

    def alert_feature(k: int):
        return F.struct(
            F.concat(F.lit("a"), text("alert_id"), F.lit(f"-{k}")).alias("id"),
            F.struct(
                F.col("event_type").alias("event"), "severity", F.lit("Likely").alias("certainty"), "urgency",
                F.col("area_desc").alias("areaDesc"), _iso("effective_utc").alias("sent"),
                _iso("effective_utc").alias("effective"), _iso("expires_utc").alias("expires"),
            ).alias("properties"),
        )

    def feature_collection(features) -> Column:
        return F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(*features).alias("features")))

    def item(fields: dict):
        parts = [F.concat(F.lit(f"<{n}>"), v, F.lit(f"</{n}>")) for n, v in fields.items()]
        return F.concat(F.lit("<item>\n"), *parts, F.lit("</item>"))

    def rss(*items):
        return F.concat(F.lit("<rss><channel><title>feed</title>"), *items, F.lit("</channel></rss>"))

    if feed == "earthquakes":
        rows = feature_collection(map(quake_feature, range(3)))
        return answer(reader.view("b_quake"), feed, "event_id", "event_time_utc", rows)
    if feed == "noaa_alerts":
        rows = feature_collection(map(alert_feature, range(2)))
        return answer(reader.view("b_alert"), feed, "alert_id", "effective_utc", rows)
    if feed == "weather":
        current = F.to_json(F.struct(F.struct(
            _iso("observed_time_utc").alias("time"), F.col("temperature_f").alias("temperature_2m"),
            F.col("wind_speed_mph").alias("wind_speed_10m"), F.col("wind_gust_mph").alias("wind_gusts_10m"),
            F.col("precipitation_in").alias("precipitation"), F.col("precipitation_in").alias("rain"),
            F.lit(3).alias("weather_code"), F.lit(1013.5).alias("pressure_msl"),
            F.col("humidity_pct").alias("relative_humidity_2m"),
        ).alias("current")))
        cities = F.array(*[F.lit(place[0]) for place in payloads.LOCATIONS])
        city = F.get(cities, F.substring("city", 6, 4).cast("int"))
        return answer(reader.view("b_weather"), feed, "observation_id", "observed_time_utc", current, city)
    if feed == "catastrophes":
        located = {
            "title": F.concat(F.lit(" "), F.col("title"), F.lit("\n")),
            "description": F.concat(F.lit("Bulletin for "), "title"), "pubDate": _mail("event_time_utc"),
            "geo:lat": text("latitude"), "geo:long": text("longitude"),
            "link": F.concat(F.lit("https://feed.test/c/"), text("event_id")),
        }
        unlocated = {"title": F.concat(F.lit("Update: "), "title"), "pubDate": _mail("event_time_utc")}
        rows = rss(item(located), item(unlocated))
        return answer(reader.view("b_cat"), feed, "event_id", "event_time_utc", rows)
    if feed == "news":
        story = {
            "title": F.concat(F.lit("Report from "), "source"),
            "description": F.concat(F.lit("\n  "), F.col("text"), F.lit("\n")),
            "pubDate": F.lit("2 Jan 2024 03:04:05 GMT"),
            "link": F.concat(F.lit("https://feed.test/n/"), text("doc_id")),
        }
        printed = reader.view("documents").withColumn("at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
        return answer(printed, feed, "doc_id", "at", rss(item(story)))
    raise ValueError(f"unknown feed: {feed}")


def notes(reader: BridgeReader) -> DataFrame:
    """Documents with one more line, some of which carry SQL."""
    lines = (
        "Do not join policies to claims here", "Use: SELECT total FROM orders", "group by urgency",
        "WHERE amount = 1", "SELECT t.amount, HAVING more", "Never select a.b where c.d is null",
        "- order by priority, not date", "ORDER BY o_total DESC", "Where appropriate, join the call",
    )
    line = F.get(F.array(*[F.lit(t) for t in lines]), (F.col("doc_id") % len(lines)).cast("int"))
    return reader.view("documents").select("doc_id", F.concat_ws("\n", "text", line).alias("text"))


def deliveries(reader: BridgeReader) -> DataFrame:
    """Alerts as delivered: every third one comes again an hour later with a corrected headline, some without a key."""
    once = reader("noaa_alerts")
    number = F.col("alert_id").cast("bigint")
    again = once.filter(number % 3 == 0).withColumns({
        "headline": F.concat(F.lit("CORRECTED "), "headline"),
        "fetched_at_utc": _later("fetched_at_utc"),
    })
    keyless = once.filter(number % 50 == 0).withColumn("alert_id", F.lit(None).cast("string"))
    return once.unionByName(again).unionByName(keyless)


def _later(c: str):
    return F.date_format(F.to_timestamp(c) + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


# tables that are not one bridge view; raw answers lie in one folder per feed
DERIVED = {"notes": notes, "deliveries": deliveries} | {
    f"raw_payloads/{f}": (lambda reader, f=f: raw_payloads(reader, f)) for f in payloads.PARSERS
}
