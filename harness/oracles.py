"""DuckDB SQL with the result each registered query must have."""

from __future__ import annotations

from ratings_engine.schemas import METADATA_RAW, REVIEW_RAW

RAW = ", ".join(f'"{c}"' for c in REVIEW_RAW.names)

_RV = """rv as (
  select cast(1 + (cast(l_quantity as int) - 1) % 5 as double) as rating,
         concat('t', l_linestatus) as title,
         concat_ws(' ', p_name, l_returnflag, cast(copy as varchar)) as "text",
         concat('A', l_partkey) as asin,
         concat(case when p_size % 10 = 9 then 'N' else 'P' end, l_partkey) as parent_asin,
         concat('U', l_suppkey) as user_id,
         cast(epoch_ms(l_shipdate) + l_linenumber * 3600123 as bigint) as "timestamp",
         cast(l_linenumber - 1 + copy as bigint) as helpful_vote,
         case when l_linenumber <> 7 then l_returnflag <> 'R' end as verified_purchase,
         p_type as category,
         date '2026-01-01' + cast(l_orderkey % 3 + copy as int) as ingestion_date
  from (select *, 0 as copy from lineitem
        union all select *, 1 from lineitem where l_returnflag = 'R')
  join part on p_partkey = l_partkey)"""

_MT = """mt as (
  select p_type as main_category, case when batch = 1 then p_name else 'old ' || p_name end as title,
         cast(p_size % 5 as double) as average_rating, cast(p_size as bigint) as rating_number,
         case when batch = 0 then null
              when p_size % 7 = 0 then 'Not available'
              when p_size % 7 = 1 then concat('from ', p_size, ' to 99')
              when p_size % 7 = 2 then concat('$1,', cast(p_retailprice as decimal(10,2)))
              when p_size % 7 = 3 then '' when p_size % 7 = 4 then null
              else concat('$', cast(p_retailprice as decimal(10,2))) end as price,
         p_brand as store, concat(p_type, '|', p_brand) as categories,
         concat('P', p_partkey) as parent_asin, p_type as category,
         date '2026-01-01' + batch as ingestion_date
  from (select *, 0 as batch from part union all select *, 1 from part))"""

_KEYED = """keyed as (
  select sha256(concat(coalesce(user_id, ''), '||', coalesce(parent_asin, ''), '||',
                       coalesce(cast("timestamp" as varchar), ''))) as review_id, rv.* from rv)"""

_DEDUP = """dedup as (
  select * from keyed qualify row_number() over (
    partition by review_id order by ingestion_date desc nulls last, asin nulls first,
    category nulls first, helpful_vote nulls first, parent_asin nulls first, rating nulls first,
    "text" nulls first, "timestamp" nulls first, title nulls first, user_id nulls first,
    verified_purchase nulls first) = 1)"""

_PRODUCTS = r"""products as (
  select parent_asin, category, title as product_title, main_category,
         average_rating as product_avg_rating,
         try_cast(regexp_extract(coalesce(price, ''), '(\d+(?:\.\d+)?)', 1) as double) as price
  from mt qualify row_number() over (
    partition by parent_asin, category order by ingestion_date desc) = 1)"""

_SV = """sv as (
  select review_id, user_id, asin, d.parent_asin, rating, title as review_title,
         "text" as review_text, "timestamp" as raw_timestamp,
         make_timestamp(("timestamp" // 1000) * 1000000) as review_timestamp,
         cast(make_timestamp(("timestamp" // 1000) * 1000000) as date) as review_date,
         helpful_vote, verified_purchase, d.category, ingestion_date, product_title,
         main_category, product_avg_rating, price
  from dedup d left join products p on d.parent_asin = p.parent_asin and d.category = p.category)"""

_DAILY = """daily as (
  select parent_asin, category, review_date, count(*) as daily_review_count,
         sum(rating) as daily_rating_sum, avg(price) as daily_avg_price
  from sv group by all)"""

_PM = """pm_full as (
  select parent_asin, category, review_date,
         cast(sum(daily_review_count) over sofar as bigint) as total_reviews,
         sum(daily_rating_sum) over sofar / sum(daily_review_count) over sofar as average_rating,
         sum(daily_rating_sum) over recent / sum(daily_review_count) over recent
           as rolling_30d_avg_rating,
         round(last_value(daily_avg_price ignore nulls) over recent, 6) as avg_price
  from (select *, date_diff('day', date '1970-01-01', review_date) as day_no from daily)
  window sofar as (partition by parent_asin, category order by day_no
                   rows between unbounded preceding and current row),
         recent as (partition by parent_asin, category order by day_no
                    range between 29 preceding and current row)),
pm as (select * from pm_full)"""

_CT = """ct as (
  select category, review_date, count(*) as daily_review_count, avg(rating) as daily_avg_rating,
         count(*) filter (round(rating) = 1) as count_1_star,
         count(*) filter (round(rating) = 2) as count_2_star,
         count(*) filter (round(rating) = 3) as count_3_star,
         count(*) filter (round(rating) = 4) as count_4_star,
         count(*) filter (round(rating) = 5) as count_5_star
  from sv group by category, review_date)"""

_VI = """vi as (
  select category, review_date, verified_purchase, count(*) as daily_review_count,
         avg(rating) as avg_rating
  from sv group by category, review_date, verified_purchase)"""

_FLAWED = """flawed as (
  select * replace (
    case when verified_purchase is null then '' else parent_asin end as parent_asin,
    case when helpful_vote <> 3 then rating + helpful_vote % 2 end as rating,
    helpful_vote - 1 as helpful_vote) from sv)"""

_LATEST = """latest as (
  select * from pm qualify row_number() over (
    partition by parent_asin, category order by review_date desc) = 1)"""

_BOARD = """board as (
  select category, cast(sum(daily_review_count) as bigint) as total_reviews,
         sum(daily_review_count * daily_avg_rating) / sum(daily_review_count)
           as weighted_avg_rating
  from ct {where} group by category)"""

_VALUE = """most_reviewed as (
  select * from latest where avg_price is not null and rolling_30d_avg_rating is not null
  qualify row_number() over (partition by category order by total_reviews desc, parent_asin) <= 50),
value as (
  select *, (rank() over (partition by category order by rolling_30d_avg_rating)
             + (count(*) over (partition by category, rolling_30d_avg_rating) - 1) / 2.0)
            / count(*) over (partition by category)
          - (rank() over (partition by category order by avg_price)
             + (count(*) over (partition by category, avg_price) - 1) / 2.0)
            / count(*) over (partition by category) as score
  from most_reviewed),
scored as (select * exclude (score), round(cast(score as double), 6) as value_score from value)"""

_UPLIFT = """uplift as (
  select category, avg(avg_rating) filter (verified_purchase) as verified_avg,
         avg(avg_rating) filter (not verified_purchase) as non_verified_avg
  from vi group by category)"""

_DECLINING = """declining as (
  select l.parent_asin, l.category, l.review_date, l.rolling_30d_avg_rating as current_rating,
         p.rolling_30d_avg_rating as prev_rating,
         p.rolling_30d_avg_rating - l.rolling_30d_avg_rating as rating_decline
  from latest l join pm p on p.parent_asin = l.parent_asin and p.category = l.category
       and p.review_date = l.review_date - 7
  where p.rolling_30d_avg_rating - l.rolling_30d_avg_rating > 0.5)"""

_BLOCKS = r"""aged as (
  select parent_asin, category, rating,
         regexp_replace(coalesce(review_text, ''), '^[\s\x0b\x1c-\x1f\x85\pZ]+|[\s\x0b\x1c-\x1f\x85\pZ]+$',
                        '', 'g') as bare,
         row_number() over (partition by parent_asin, category
                            order by review_timestamp desc, review_id) as age
  from {reviews} semi join {products} using (parent_asin, category)),
placed as (
  select *, row_number() over (partition by parent_asin, category order by age) as place
  from aged where age <= 50 and bare <> ''),
blocks as (
  select parent_asin, category, count(*) as review_count,
         string_agg(concat('[Rating: ', cast(rating as varchar), '] ',
                           case when length(bare) > 500 then concat(substring(bare, 1, 500), '...')
                                else bare end),
                    concat(chr(10), chr(10), '---', chr(10), chr(10)) order by place) as reviews_block
  from placed where place <= 30 group by parent_asin, category)"""

SILVER = (_RV, _MT, _KEYED, _DEDUP, _PRODUCTS, _SV)
PM = (*SILVER, _DAILY, _PM)
CT = (*SILVER, _CT)
VI = (*SILVER, _VI)


def _sql(ctes, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


def _two_deliveries(ctes):
    """The same tables when the reviews arrive in two deliveries, labelled by their day."""
    return (_RV.replace("date '2026-01-01' + cast(l_orderkey % 3 + copy as int)",
                        "date '2026-02-01' + case when l_orderkey % 3 + copy > 1 then 1 else 0 end"),
            *ctes[1:])


def _looking_back(ctes):
    """The same tables over the reviews of the newest batch's days and 29 days before them."""
    bounds = """bounds as (
      select min(review_date) as first_day, max(review_date) as last_day from all_sv
      where ingestion_date = date '2026-01-04'),
    sv as (select all_sv.* from all_sv, bounds
           where review_date between first_day - 29 and last_day)"""
    return [c.replace("sv as (", "all_sv as (", 1) + ",\n" + bounds if c.startswith("sv as (") else c
            for c in ctes]


def _period(first: int, last: int) -> str:
    return f"review_date between date '1999-06-15' - {first} and date '1999-06-15' - {last}"


def _lag(where: str) -> str:
    return f"""select * from (
      select parent_asin, category, review_date, rolling_30d_avg_rating, previous_rolling_avg,
             previous_rolling_avg - rolling_30d_avg_rating as rating_decline
      from (select *, lag(rolling_30d_avg_rating) over (
                        partition by parent_asin, category order by review_date)
                      as previous_rolling_avg from pm where {where}))
    where rating_decline > 0"""


_LABEL = ("case when verified_purchase then 'Verified' when not verified_purchase "
          "then 'Non-Verified' end as purchase_type")

_PM_ALL = _sql(PM, "select * from pm")
_SV_ALL = _sql(SILVER, "select * from sv")
_DAMAGED = """damaged as (
  select *, verified_purchase is not null and "text" not like '% R %' as readable from rv)"""

_LEGACY = """
        select l_quantity as rating,
               case when l_returnflag = 'R' then '' else l_linestatus end as title,
               case l_returnflag when 'R' then concat('None of it''s "True" ', l_quantity)
                                 when 'A' then '' else 'plain' end as "text",
               concat('A', l_partkey) as asin, concat('A', l_partkey) as parent_asin,
               concat('U', l_suppkey) as user_id, epoch_ms(l_shipdate) as "timestamp",
               cast(l_linenumber as bigint) as helpful_vote,
               case l_returnflag when 'R' then true when 'A' then false
                                 else l_linenumber > 3 end as verified_purchase
        from {rows}"""

ORACLES = {
    "src_read_jsonl": _sql([_RV], f"select {RAW} from rv"),
    "src_bulk_scan": _sql([_MT], f"select {', '.join(METADATA_RAW.names)} from mt"),
    "src_category_from_path": _sql([_RV], f"select {RAW}, category from rv"),
    "src_batch_label": _sql(
        [_RV], f"select {RAW}, 'Everything' as category, date '2026-02-01' as ingestion_date from rv"),
    "sink_dynamic_overwrite": _sql([_RV], """
        select * replace (case when ingestion_date = date '2026-01-02' then helpful_vote + 100
                               else helpful_vote end as helpful_vote) from rv"""),
    "sink_append": _sql([_RV], """
        select * from rv union all select * from rv where ingestion_date = date '2026-01-02'"""),
    "src_slice": _sql(SILVER, """
        select * from sv where category = 'ECONOMY'
          and review_date between date '1996-03-01' and date '1999-08-31'"""),
    "src_legacy_reviews": _LEGACY.format(rows="lineitem"),
    "src_mixed_encodings": _LEGACY.format(
        rows="(select * from lineitem union all select * from lineitem where l_returnflag = 'A')"),
    "src_missing_input": _sql([_RV], """
        select category, date '2026-02-01' as ingestion_date, count(*) as "count"
        from rv group by category"""),
    "sink_small_output": """select unnest([date '2026-01-01', date '2026-01-02']) as ingestion_date,
        true as few_files""",
    "silver_empty_batch": _sql(SILVER, 'select category, count(*) as "count" from sv group by category'),
    "src_legacy_metadata": """
        select case when p_size % 2 = 0 then p_type else 'Current' end as main_category,
               p_name as title, cast(p_size % 6 as double) as average_rating,
               cast(p_size as bigint) as rating_number,
               case when p_size % 2 = 0 then cast(p_retailprice as varchar) end as price,
               case when p_size % 2 = 0 then '' end as store,
               case when p_size % 2 = 0 then concat(p_type, '|', p_brand) else p_brand end
                 as categories,
               concat('P', p_partkey) as parent_asin
        from part""",
    "src_corrupt_dropped": _sql([_RV], f"""select {RAW} from rv where "text" not like '% R %'"""),
    "src_cap_per_category": _sql([_RV], """
        select * from rv qualify row_number() over (
          partition by category order by "timestamp", rating, title, "text", asin, parent_asin,
          user_id, helpful_vote, verified_purchase nulls first, ingestion_date) <= 10000"""),

    "silver_review_id": _sql((_RV, _KEYED),
                             'select review_id, user_id, parent_asin, "timestamp" from keyed'),
    "silver_event_time": _sql([_RV], """
        select user_id, asin, "timestamp",
               make_timestamp(("timestamp" // 1000) * 1000000) as review_timestamp,
               cast(make_timestamp(("timestamp" // 1000) * 1000000) as date) as review_date
        from rv"""),
    "silver_dedup": _sql((_RV, _KEYED, _DEDUP), "select * from dedup"),
    "silver_price_parse": _sql((_MT, _PRODUCTS), "select * from products"),
    "silver_enrich": _sql(SILVER, """
        select review_id, parent_asin, category, product_title, main_category,
               product_avg_rating, price from sv"""),
    "silver_build": _SV_ALL,
    "silver_upsert": _SV_ALL,
    "upsert_idempotent": _SV_ALL,

    "gold_recompute_window": _sql(SILVER, """
        select min(review_date) as output_start, max(review_date) as output_end,
               min(review_date) - 29 as source_start
        from sv where ingestion_date = date '2026-01-04'"""),
    "gold_output_range": _sql(PM, """
        select * from pm where review_date between date '1997-01-01' and date '1997-12-31'"""),
    "gold_daily_product": _sql((*SILVER, _DAILY), """
        select * replace (round(daily_avg_price, 6) as daily_avg_price) from daily"""),
    "gold_cumulative": _sql(PM, """
        select parent_asin, category, review_date, total_reviews, average_rating from pm"""),
    "gold_rolling_30d": _sql(PM, """
        select parent_asin, category, review_date, rolling_30d_avg_rating from pm"""),
    "gold_last_price": _sql(PM, "select parent_asin, category, review_date, avg_price from pm"),
    "gold_product_metrics": _PM_ALL,
    "gold_category_trends": _sql(CT, "select * from ct"),
    "gold_star_histogram": _sql((*SILVER, _FLAWED, """
        halves as (select * replace (rating - 0.5 * (helpful_vote % 3) as rating) from flawed)""",
        _CT.replace("from sv", "from halves")), "select * exclude (daily_avg_rating) from ct"),
    "gold_verified_impact": _sql(VI, "select * from vi"),
    "gold_upsert": _sql(VI, "select * from vi"),
    "gold_schema_evolution": _sql(CT, "select category, review_date, daily_review_count, "
        "daily_avg_rating, " + ", ".join(
            f"case when review_date >= date '1998-05-01' and dayofweek(review_date) < 5 "
            f"then count_{n}_star end as count_{n}_star" for n in range(1, 6)) + """,
            case when review_date >= date '1998-05-01' and dayofweek(review_date) < 4
                 then daily_review_count * 2 end as bar from ct"""),
    "upsert_after_crash": _sql(CT, "select * from ct where review_date <= date '1999-12-31' "
                                   "or review_date >= date '1999-06-01'"),
    "gold_touched_categories": _sql(SILVER, "select distinct category from sv"),
    "gold_compaction": _PM_ALL,
    "gold_incremental": _PM_ALL,
    "gold_incremental_full": _sql(VI, "select * from vi"),
    "gold_late_reviews": _sql((*SILVER, _DAILY), """
        select parent_asin, category, review_date, daily_review_count, daily_rating_sum,
               cast(sum(daily_review_count) over sofar as bigint) as total_reviews,
               sum(daily_rating_sum) over sofar as total_rating_sum
        from daily window sofar as (partition by parent_asin, category order by review_date
                                    rows between unbounded preceding and current row)"""),
    "gold_touched_intervals": _sql(SILVER, """
        select category, min(review_date) as "start", max(review_date) as "end"
        from (select *, sum(first) over (partition by category order by review_date) as island
              from (select category, review_date,
                           case when review_date - lag(review_date) over (
                                     partition by category order by review_date) <= 2 then 0 else 1 end as first
                    from (select distinct category, review_date from sv
                          where ingestion_date = date '2026-01-04' and helpful_vote = 3 and rating = 5)))
        group by category, island"""),
    "gold_incremental_lookback": _sql(_looking_back(PM), """
        select pm.* from pm, bounds where review_date between first_day and last_day"""),

    "bi_catalog": _sql(CT, """
        select string_agg(distinct category, '|' order by category) as categories,
               min(review_date) as min_date, max(review_date) as max_date from ct"""),
    "bi_leaderboard": _sql((*CT, _BOARD.format(
        where="where review_date between date '1996-01-01' and date '1999-12-31'")), """
        select * replace (round(weighted_avg_rating, 6) as weighted_avg_rating) from board"""),
    "bi_leaderboard_summary": _sql((*CT, _BOARD.format(where="")), """
        select count(*) as categories, cast(sum(total_reviews) as bigint) as total_reviews,
               round(avg(rating), 6) as avg_rating,
               arg_min(category, place) as top_category, arg_min(rating, place) as top_category_rating
        from (select *, round_even(weighted_avg_rating, 2) as rating,
                     row_number() over (order by total_reviews desc, category) as place from board)"""),
    "bi_default_range": _sql(CT, """
        select greatest(min(review_date), max(review_date) - 30) as start_date,
               max(review_date) as end_date from ct"""),
    "bi_latest_product": _sql((*PM, _LATEST), "select * from latest"),
    "bi_declining": _sql((*PM, _LATEST, _DECLINING), "select * from declining"),
    "bi_value_for_money": _sql((*PM, _LATEST, _VALUE), "select * from scored"),
    "bi_top_value": _sql((*PM, _LATEST, _VALUE), """
        select * from scored qualify row_number() over (
          partition by category order by value_score desc, parent_asin) <= 5"""),
    "bi_sentiment": _sql(CT, """
        select category, review_date,
               """ + ", ".join(f"100.0::double * count_{n}_star / total as count_{n}_star_pct"
                               for n in range(1, 6)) + """
        from (select *, count_1_star + count_2_star + count_3_star + count_4_star + count_5_star
                     as total from ct) where total > 0"""),
    "bi_overview": _sql((*PM, _CT, _VI, _LATEST, _UPLIFT), """
        select c.*, top_product, top_product_rating,
               round(verified_avg - non_verified_avg, 6) as verified_uplift
        from (select category, arg_max(daily_avg_rating, review_date) as latest_daily_avg_rating,
                     cast(sum(daily_review_count) as bigint) as reviews_in_range
              from ct group by category) c
        left join (select category, parent_asin as top_product,
                          rolling_30d_avg_rating as top_product_rating
                   from latest qualify row_number() over (
                     partition by category order by rolling_30d_avg_rating desc, parent_asin) = 1) t
          using (category)
        left join uplift using (category)"""),
    "bi_verified_uplift": _sql((*VI, _UPLIFT), """
        select category, round(verified_avg, 6) as verified_avg,
               round(non_verified_avg, 6) as non_verified_avg,
               round(verified_avg - non_verified_avg, 6) as verified_uplift from uplift"""),
    "bi_rating_trend": _sql(CT, """
        select category, review_date, daily_avg_rating, daily_review_count from ct"""),
    "bi_top_products": _sql((*PM, _LATEST), """
        select * from latest qualify row_number() over (
          partition by category order by rolling_30d_avg_rating desc, parent_asin) <= 10"""),
    "bi_product_ranking": _sql((*PM, _LATEST), "select * from latest"),
    "bi_trust_summary": _sql(VI, f"""
        select category, {_LABEL}, round(avg(avg_rating), 6) as avg_rating,
               cast(sum(daily_review_count) as bigint) as daily_review_count
        from vi where verified_purchase is not null group by category, verified_purchase"""),
    "bi_trust_trend": _sql(VI, f"""
        select category, review_date, {_LABEL}, avg_rating from vi
        where verified_purchase is not null"""),
    "bi_lag_decline": _sql(PM, _lag("true")),
    "bi_q_top_categories": _sql((*CT, _BOARD.format(where="where " + _period(7, 1))), """
        select * replace (round(weighted_avg_rating, 6) as weighted_avg_rating) from board"""),
    "bi_q_declining_month": _sql(PM, _lag(f"category = 'ECONOMY' and {_period(30, 1)}")),
    "bi_q_verified_on_date": _sql(VI, f"""
        select category, {_LABEL}, daily_review_count, avg_rating from vi
        where verified_purchase is not null and review_date = date '1999-06-15'"""),
    "bi_q_most_reviewed": _sql(PM, f"""
        select parent_asin, category,
               max(total_reviews) filter ({_period(7, 1)})
               - coalesce(max(total_reviews) filter (review_date < date '1999-06-15' - 7), 0)
                 as reviews_in_period
        from pm group by parent_asin, category having max(total_reviews) filter ({_period(7, 1)}) > 0"""),
    "bi_q_verified_last_week": _sql(VI, f"""
        select category, {_LABEL}, cast(sum(daily_review_count) as bigint) as review_count,
               round(sum(daily_review_count * avg_rating) / sum(daily_review_count), 6) as avg_rating
        from vi where verified_purchase is not null and {_period(7, 1)}
        group by category, verified_purchase"""),
    "bi_review_bundle": _sql(("""texts as (
          select source as parent_asin, lang as category, cast(doc_id as varchar) as review_id,
                 doc_id as review_timestamp, cast(1 + n_chars % 5 as double) as rating,
                 "text" as review_text from documents)""",
        """flagged as (select source as parent_asin, lang as category
                       from documents semi join (select * from labels where toxic = 1)
                       using (doc_id))""",
        _BLOCKS.format(reviews="texts", products="flagged")), "select * from blocks"),
    "bi_declining_bundle": _sql((*PM, _LATEST, _DECLINING, _BLOCKS.format(
        reviews="sv", products="declining")), "select * from blocks"),

    "sql_views": _sql((*PM, _CT, _VI), """
        select category, review_date, c.daily_review_count, products,
               cast(sum(v.daily_review_count) as bigint) as flagged_reviews
        from ct c join (select category, review_date, count(*) as products from pm group by all) p
          using (category, review_date) join vi v using (category, review_date)
        group by all"""),
    "sql_guarded_cte": _sql(CT, """
        select category, cast(year(review_date) as int) as review_year, 'UPDATE' as label,
               cast(sum(daily_review_count) as bigint) as reviews
        from ct group by all order by category, review_year limit 100"""),
    "sql_last_7_days": _sql(CT, f"select * from ct where {_period(7, 1)}"),
    "sql_last_month": _sql(VI, f"select * from vi where {_period(30, 1)}"),

    "dq_not_blank": _sql((*SILVER, _FLAWED), """
        select cast(0 as int) as position, 'not_blank' as rule, 'review_id' as "column",
               count(*) filter (review_id is null or review_id = '') as violations from flawed
        union all
        select 1, 'not_blank', 'parent_asin',
               count(*) filter (parent_asin is null or parent_asin = '') from flawed"""),
    "dq_rating_range": _sql((*SILVER, _FLAWED), """
        select cast(0 as int) as position, 'between' as rule, 'rating' as "column",
               count(*) filter (rating < 1 or rating > 5) as violations from flawed"""),
    "dq_helpful_vote": _sql((*SILVER, _FLAWED), """
        select cast(0 as int) as position, 'at_least' as rule, 'helpful_vote' as "column",
               count(*) filter (helpful_vote < 0) as violations from flawed"""),
    "dq_report": _sql((*SILVER, _FLAWED), """
        select count(*) filter (review_id is null or review_id = '') as null_review_id,
               count(*) filter (parent_asin is null or parent_asin = '') as null_parent_asin,
               count(*) filter (rating < 1 or rating > 5) as invalid_rating,
               count(*) filter (helpful_vote < 0) as invalid_helpful_vote from flawed"""),
    "dq_suite": _sql((*SILVER, _FLAWED), """
        select cast(0 as int) as position, 'not_null' as rule, 'rating' as "column",
               count(*) filter (rating is null) as violations from flawed
        union all select 1, 'between', 'rating', count(*) filter (rating < 2 or rating > 5) from flawed
        union all select 2, 'at_least', 'helpful_vote', count(*) filter (helpful_vote < 0)
        from flawed"""),

    "audit_raw": _sql([_RV], 'select category, count(*) as "count" from rv group by category'),
    "audit_bronze": _sql([_RV], """
        select category, ingestion_date, count(*) as "count" from rv group by all"""),
    "audit_silver": _sql(SILVER, 'select category, count(*) as "count" from sv group by category'),
    "audit_gold": _sql((*PM, _CT, _VI), """
        select 'product_metrics' as table_name, count(*) as "count" from pm
        union all select 'category_trends', count(*) from ct
        union all select 'verified_purchase_impact', count(*) from vi"""),
    "audit_dropoff": _sql((_RV, _DAMAGED), """
        select category, count(*) as raw_rows, count(*) filter (readable) as bronze_rows,
               count(distinct concat(user_id, '|', parent_asin, '|', "timestamp"))
                 filter (readable) as silver_rows,
               count(*) - count(*) filter (readable) as raw_to_bronze_drop,
               count(*) filter (readable)
               - count(distinct concat(user_id, '|', parent_asin, '|', "timestamp"))
                 filter (readable) as bronze_to_silver_drop
        from damaged group by category"""),
    "medallion_end_to_end": _sql(_two_deliveries(PM), "select * from pm"),
}
