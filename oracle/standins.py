"""DuckDB versions of the stand-in raw tables, staging, dimensions and facts.

Each entry is (name, sql); ``with_ctes`` puts the ones a query needs in front
of it. Team lookups and marts with an own structure are in ``models.py``.
"""

from __future__ import annotations

import re

CTES: list[tuple[str, str]] = []


def cte(name: str, sql: str) -> None:
    CTES.append((name, sql.strip()))


# --------------------------------------------------------------------------- stand-ins
cte("supplier_geo", """
select s.s_suppkey, s.s_name, s.s_acctbal + 0.0 as s_acctbal, r.r_name
from supplier s
left join nation n on s.s_nationkey = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey
""")

cte("ranked_suppliers", """
select *, row_number() over (order by s_acctbal desc, s_suppkey asc) as base_rank
from supplier_geo
""")

cte("raw_csapi_team_rankings", """
select
  cast(s.s_suppkey as varchar) as team_id,
  'csapi' as source,
  s.s_name as name,
  case when s.s_suppkey % 7 = 1 then s.r_name when s.s_suppkey % 2 = 0 then 'Global' end as region,
  case when s.s_suppkey % 10 <> 9 then s.base_rank + d.bump end as world_ranking,
  cast(floor(s.s_acctbal) as bigint) as vrs_points,
  cast(d.bump as bigint) as rank_diff,
  cast(0 as bigint) as points_diff,
  d.d as ranking_date,
  d.d || 'T06:00:00' as ingested_at
from ranked_suppliers s
cross join lateral (
  select '2026-04-06' as d, 0 as bump
  union all
  select '2026-05-04', case when s.s_suppkey % 4 = 0 then 1 else 0 end
) d
""")

cte("raw_liquipedia_teams", """
select
  'lp_' || cast(s.s_suppkey as varchar) as team_id,
  'liquipedia' as source,
  lower(s.s_name) as name,
  case when s.s_suppkey % 5 = 0 then s.r_name end as region,
  cast(null as bigint) as world_ranking,
  '2026-05-0' || cast(l.load as varchar) || 'T00:00:00' as ingested_at
from supplier_geo s
join (select 1 as load union all select 2) l
  on l.load = 1 or s.s_suppkey % 10 = 5
""")

cte("raw_valve_team_regions", """
select
  d.snapshot_date,
  case when s.s_suppkey % 3 <> 0 then 'Academy ' || s.s_name when s.s_suppkey % 2 = 0 then 'Team ' || s.s_name else upper(s.s_name) end as team_name,
  regexp_replace(lower(regexp_replace(trim(
      case when s.s_suppkey % 3 <> 0 then 'Academy ' || s.s_name when s.s_suppkey % 2 = 0 then 'Team ' || s.s_name else upper(s.s_name) end),
      '^team[\\s_-]+', '', 'i')), '[^a-z0-9]+', '', 'g') as normalized_team_name,
  r.region,
  cast(s.s_suppkey as bigint) as regional_rank,
  cast(null as bigint) as global_rank,
  cast(floor(s.s_acctbal) as bigint) as points,
  cast(null as varchar) as roster,
  '/team/' || cast(s.s_suppkey as varchar) as detail_path,
  'valve' as source
from supplier_geo s
cross join (select '2026-04-06' as snapshot_date union all select '2026-05-04') d
join (select 1 as k union all select 2) rk on rk.k = 1 or s.s_suppkey % 9 = 0
cross join lateral (select case when rk.k = 1 then s.r_name else 'OTHER' end as region) r
""")

cte("lineitem_dedup", """
select * from (
  select *, row_number() over (
      partition by l_orderkey, l_linenumber
      order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc,
               l_discount + 0.0 desc, l_tax + 0.0 desc, l_returnflag desc, l_linestatus desc) as rn
  from lineitem
) where rn = 1
""")

cte("lineitem_pairs", """
select a.l_orderkey, a.l_partkey as a_partkey, a.l_suppkey as a_suppkey, a.l_quantity as a_quantity,
       b.l_suppkey as b_suppkey, b.l_quantity as b_quantity
from lineitem_dedup a
join lineitem_dedup b
  on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1
where a.l_linenumber % 2 = 1 and a.l_suppkey <> b.l_suppkey
""")

cte("raw_matches_all", """
select
  cast(p.l_orderkey as varchar) as match_id,
  case o.o_orderstatus when 'O' then 'csapi' when 'F' then 'faceit' when 'P' then 'pandascore' end as source,
  cast(p.a_suppkey as varchar) as team_a_id,
  cast(p.b_suppkey as varchar) as team_b_id,
  case when p.a_quantity > p.b_quantity then cast(p.a_suppkey as varchar)
       when p.b_quantity > p.a_quantity then cast(p.b_suppkey as varchar) end as winner_id,
  strftime(o.o_orderdate, '%Y-%m-%d') as played_at,
  pt.p_brand as map_name,
  cast(p.a_quantity as bigint) as score_a,
  cast(p.b_quantity as bigint) as score_b,
  (p.a_quantity > 15 and p.b_quantity > 15) as is_overtime,
  case when p.l_orderkey % 2 = 0 then cast(p.a_suppkey % 60 + 1 as bigint) end as team_a_ranking,
  case when p.l_orderkey % 2 = 0 then cast(p.b_suppkey % 60 + 1 as bigint) end as team_b_ranking
from lineitem_pairs p
join orders o on o.o_orderkey = p.l_orderkey
left join part pt on pt.p_partkey = p.a_partkey
""")

cte("raw_player_rows", """
select
  cast(l.l_partkey as varchar) as player_id,
  case l.l_returnflag when 'R' then 'faceit' when 'A' then 'pandascore' when 'N' then 'csapi' end as source,
  pt.p_name as display_name,
  cast(l.l_suppkey as varchar) as team_id,
  'Supplier#' || lpad(cast(l.l_suppkey as varchar), 9, '0') as team_name,
  cast(null as varchar) as nationality,
  l.l_quantity as kills,
  cast(l.l_linenumber * 5 as double) as deaths,
  case when l.l_quantity <> 0 then l.l_extendedprice / l.l_quantity end as adr,
  case when l.l_linenumber <> 0 then l.l_quantity / cast(l.l_linenumber * 5 as double) end as kd_ratio,
  (1 - (l.l_discount + 0.0)) * 100 as kast,
  1 + (l.l_tax + 0.0) as rating,
  cast(null as double) as swing,
  cast(null as bigint) as matches_played,
  case when l.l_returnflag = 'R' then cast(pt.p_size * 100 as bigint) end as elo,
  cast(l.l_orderkey as varchar) as match_id,
  strftime(l.l_shipdate, '%Y-%m-%d') as recorded_at
from lineitem l
left join part pt on pt.p_partkey = l.l_partkey
union all
select cast(p_partkey as varchar), 'pandascore', p_name, null, null, null,
       null, null, null, null, null, null, null, null, null, null, '1994-12-31'
from part
""")





cte("raw_csapi_player_stats", """
select player_id, source, display_name, team_id, team_name, nationality, kills, deaths, adr, kd_ratio,
       kast, rating, swing, matches_played, elo, match_id, recorded_at
from raw_player_rows where source = 'csapi' and match_id is not null
""")

cte("event_rounds", """
select e.*,
  row_number() over (partition by user_id order by ts, event_id) - 1 as i,
  24 + (user_id % 4) * 3 as len
from events e
""")

cte("event_rounds2", """
select *,
  i // len as map_no,
  i % len + 1 as round_number,
  cast(user_id % 10 as varchar) as team1_id,
  cast((user_id + 1 + (i // len) % 9) % 10 as varchar) as team2_id,
  ((user_id + i // len) % 2 = 0) as start_ct,
  (event_type in ('click', 'view') or (event_type = 'purchase' and event_id % 2 = 0)) as t1_won
from event_rounds
""")

cte("event_rounds3", """
select *,
  case when round_number <= 12 then start_ct
       when round_number <= 24 then not start_ct
       when ((round_number - 25) // 3) % 2 = 0 then start_ct
       else not start_ct end as t1_ct,
  cast(user_id as varchar) || '-' || cast(map_no as varchar) as map_stats_id,
  sum(case when t1_won then 1 else 0 end) over (
      partition by user_id, map_no order by round_number
      rows between unbounded preceding and current row) as s1
from event_rounds2
""")

cte("raw_hltv_round_history", """
select
  'hltv_unofficial' as source,
  map_stats_id,
  cast(user_id as varchar) || '-' || cast(map_no // 3 as varchar) as match_id,
  'e' || cast(user_id % 5 as varchar) as event_id,
  'Event ' || cast(user_id % 5 as varchar) as event_name,
  'Map' || cast((user_id + map_no) % 7 as varchar) as map_name,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as played_at,
  cast(round_number as bigint) as round_number,
  case when t1_ct then team2_id else team1_id end as t_team_id,
  'Supplier#' || lpad(case when t1_ct then team2_id else team1_id end, 9, '0') as t_team_name,
  case when t1_ct then team1_id else team2_id end as ct_team_id,
  'Supplier#' || lpad(case when t1_ct then team1_id else team2_id end, 9, '0') as ct_team_name,
  case when t1_won = t1_ct then 'ct' else 't' end as winner_side,
  case when t1_won then team1_id else team2_id end as winner_team_id,
  'Supplier#' || lpad(case when t1_won then team1_id else team2_id end, 9, '0') as winner_team_name,
  team1_id,
  'Supplier#' || lpad(team1_id, 9, '0') as team1_name,
  team2_id,
  'Supplier#' || lpad(team2_id, 9, '0') as team2_name,
  cast(s1 as bigint) as score_team1_after,
  cast(round_number - s1 as bigint) as score_team2_after,
  case when round_number % 6 = 0 then cast(s1 as varchar) || '-' || cast(round_number - s1 as varchar) end
    as reported_score,
  case when t1_won = t1_ct then (case when event_type = 'purchase' then 'bomb_defused' else 'ct_win' end)
       else (case when event_type = 'purchase' then 'bomb_exploded' else 't_win' end) end as round_outcome,
  round_number > 24 as is_overtime,
  '2026-05-04T00:00:00' as ingested_at
from event_rounds3
""")


# Text macros (the oracle must be one plain SQL statement, so no CREATE MACRO):
#   xavg(x)      order-independent average: exact decimal sum / count, 10 decimals
#   sround(x, d) round half up on the shortest decimal text of x (Spark's round on doubles)
MACROS = {
    "xavg": lambda a: f"cast(round(sum(cast({a[0]} as decimal(28,10))) / count({a[0]}), 10) as double)",
    "sround": lambda a: f"cast(round(cast(cast({a[0]} as varchar) as decimal(38,18)), {a[1]}) as double)",
}


def _split_args(text: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in text:
        if ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
            continue
        depth += ch == "("
        depth -= ch == ")"
        cur += ch
    out.append(cur.strip())
    return out


def expand_macros(sql_text: str) -> str:
    changed = True
    while changed:
        changed = False
        for name, fn in MACROS.items():
            m = re.search(rf"\b{name}\(", sql_text)
            if not m:
                continue
            start, i, depth = m.start(), m.end(), 1
            while depth:
                depth += {"(": 1, ")": -1}.get(sql_text[i], 0)
                i += 1
            inner = sql_text[m.end():i - 1]
            sql_text = sql_text[:start] + fn(_split_args(inner)) + sql_text[i:]
            changed = True
    return sql_text


def with_ctes(final_sql: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``final_sql`` with the CTEs it needs (transitively), in definition order."""
    ctes = ctes if ctes is not None else CTES
    if final_sql.lstrip().startswith("with "):
        final_sql = f"select * from ({final_sql.strip()})"  # the query's own parts, behind the shared ones
    names = [n for n, _ in ctes]
    bodies = dict(ctes)
    need: set[str] = set()
    stack = [final_sql]
    while stack:
        text = stack.pop()
        for n in names:
            if n not in need and re.search(rf"\b{re.escape(n)}\b", text):
                need.add(n)
                stack.append(bodies[n])
    parts = [f"{n} as (\n{bodies[n]}\n)" for n in names if n in need]
    if not parts:
        return expand_macros(final_sql.strip())
    return expand_macros("with " + ",\n".join(parts) + "\n" + final_sql.strip())


# --------------------------------------------------------------------------- staging / core
cte("int_matches_unioned", """
select * replace (case when source = 'csapi' then team_a_ranking end as team_a_ranking,
                  case when source = 'csapi' then team_b_ranking end as team_b_ranking)
from raw_matches_all
where match_id is not null and source in ('faceit', 'pandascore', 'csapi')
  and (source <> 'csapi' or (team_a_id is not null and team_b_id is not null))
""")

_PCOLS = "player_id, source, display_name, team_id, nationality, kills, deaths, adr, kd_ratio, kast, rating, elo, match_id, recorded_at"
_PORDER = ", ".join(f"{c} desc nulls last" for c in _PCOLS.split(", "))

cte("players_unioned_raw", f"""
select {_PCOLS}
from (select * replace (if(source = 'csapi', kills, trunc(kills)) as kills, if(source = 'csapi', deaths, trunc(deaths)) as deaths,
                        case when source = 'csapi' then rating end as rating) from raw_player_rows)
where player_id is not null and source is not null and (source <> 'csapi' or match_id is not null)
""")

cte("int_players_unioned", f"""
select {_PCOLS} from (
  select *, row_number() over (
      partition by player_id, coalesce(match_id, '__profile__')
      order by case when source = 'faceit' then 2 when source = 'pandascore' then 3
                    when source = 'csapi' then 4 else 5 end asc, {_PORDER}) as _rn
  from players_unioned_raw
) where _rn = 1
""")

cte("dim_maps", """
select md5(coalesce(cast(map_name as varchar), '_dbt_utils_surrogate_key_null_')) as map_sk, map_name
from (select distinct map_name from int_matches_unioned where map_name is not null)
""")

cte("dim_players", f"""
select player_id, display_name, team_id, nationality, source as primary_source, recorded_at as last_updated
from (
  select *, row_number() over (partition by player_id order by recorded_at desc nulls first, {_PORDER}) as _rn
  from int_players_unioned
) where _rn = 1
""")

cte("stg_csapi_team_rankings", """
select team_id, 'csapi' as source, name, region, world_ranking, vrs_points, rank_diff, points_diff,
       ranking_date, ingested_at
from raw_csapi_team_rankings where team_id is not null and world_ranking is not null
""")

_MALL = ("match_id, source, team_a_id, team_b_id, winner_id, played_at, map_name, score_a, score_b, "
         "is_overtime, team_a_ranking, team_b_ranking")
_MORDER = ", ".join(f"{c} desc nulls last" for c in _MALL.split(", "))
_SK = "coalesce(cast({x} as varchar), '_dbt_utils_surrogate_key_null_')"

cte("fact_matches", f"""
select md5({_SK.format(x='m.match_id')} || '-' || {_SK.format(x='m.source')} || '-' || {_SK.format(x='m.map_name')})
         as match_sk,
       m.match_id, m.source, m.team_a_id, m.team_b_id, m.winner_id, mp.map_sk, m.map_name, m.played_at,
       m.score_a, m.score_b, m.is_overtime, m.team_a_ranking, m.team_b_ranking
from (
  select *, row_number() over (
      partition by match_id, source, map_name
      order by try_cast(played_at as date) desc nulls last, {_MORDER}) as _rn
  from int_matches_unioned
) m
left join dim_maps mp on m.map_name = mp.map_name
where m._rn = 1
""")

cte("fact_player_stats", f"""
select md5(concat_ws('-', {_SK.format(x='player_id')}, {_SK.format(x='match_id')}, {_SK.format(x='source')})) as player_stat_sk,
  * exclude (nationality),
  kills / case when deaths > 0 then deaths end as computed_kd,
  kills / case when kills + deaths > 0 then kills + deaths end as kill_share
from int_players_unioned where match_id is not null
""")


cte("stg_liquipedia_teams", "from raw_liquipedia_teams where team_id is not null")
cte("stg_valve_team_regions", "from raw_valve_team_regions where snapshot_date is not null and normalized_team_name is not null and region is not null")

cte("stg_hltv_round_history", """
select source, map_stats_id, match_id, event_id, event_name, map_name,
  try_cast(played_at as timestamp) as played_at, cast(round_number as int) as round_number,
  t_team_id, t_team_name, ct_team_id, ct_team_name, winner_side, winner_team_id, winner_team_name,
  team1_id, team1_name, team2_id, team2_name,
  cast(score_team1_after as int) as score_team1_after, cast(score_team2_after as int) as score_team2_after,
  reported_score, round_outcome, cast(is_overtime as boolean) as is_overtime,
  try_cast(ingested_at as timestamp) as ingested_at
from raw_hltv_round_history
where map_stats_id is not null and round_number is not null and winner_team_id is not null
  and team1_id is not null and team2_id is not null
""")

# --------------------------------------------------------------------------- team lookups and marts
from . import models  # noqa: E402,F401  (adds its CTEs here)

# Both teams of a ranked match are looked up in one join, then brought back side by side.
cte("ranked_sides", """
select match_sk, side.name as side, side.team_id, team_name, region, coalesce(side.rank, world_ranking) as ranking
from (select match_sk, unnest([{name: 'a', team_id: team_a_id, rank: team_a_ranking},
                               {name: 'b', team_id: team_b_id, rank: team_b_ranking}]) as side
      from fact_matches where source = 'csapi' and winner_id is not null)
left join dim_teams on dim_teams.team_id = side.team_id
""")

cte("sides_by_match", """
select match_sk,
  max(team_name) filter (side = 'a') as team_a_name, max(region) filter (side = 'a') as team_a_region,
  max(ranking) filter (side = 'a') as team_a_ranking, max(team_name) filter (side = 'b') as team_b_name,
  max(region) filter (side = 'b') as team_b_region, max(ranking) filter (side = 'b') as team_b_ranking,
  max(coalesce(ranking, 999)) - min(coalesce(ranking, 999)) as ranking_delta,
  case when min(coalesce(ranking, 999)) < max(coalesce(ranking, 999)) then arg_min(team_id, coalesce(ranking, 999)) end as favored_team_id
from ranked_sides group by match_sk
""")

cte("mart_upset_features", """
select f.* exclude (map_sk, team_a_ranking, team_b_ranking), s.* exclude (match_sk),
  ifnull(f.score_a, 0) - ifnull(f.score_b, 0) as score_diff, ifnull(f.score_a, 0) + ifnull(f.score_b, 0) as total_rounds,
  coalesce(s.ranking_delta > 5 and f.winner_id <> s.favored_team_id, false)::int as is_upset,
  coalesce(s.team_a_region <> s.team_b_region, false)::int as is_cross_region
from fact_matches f join sides_by_match s using (match_sk)
""")

cte("team_match_rows", """
select team_id, played_at, coalesce(winner_id = team_id, false)::int as is_win, coalesce(winner_id <> team_id, false)::int as is_loss,
  (winner_id is null)::int as is_draw
from (select unnest([team_a_id, team_b_id]) as team_id, winner_id, played_at from fact_matches)
""")

cte("mart_team_performance", """
with record as (
  select team_id, count(*) as total_matches, count_if(is_win = 1) as wins, count_if(is_loss = 1) as losses, count_if(is_draw = 1) as draws
  from team_match_rows group by team_id)
select r.team_id, t.team_name, t.region, t.world_ranking, r.* exclude (team_id), round(wins / total_matches, 4) as win_rate
from record r left join dim_teams t using (team_id)
""")

cte("mart_head2head", """
with paired as (select list_sort([team_a_id, team_b_id]) as pair, winner_id, played_at from fact_matches)
select pair[1] as team_1_id, pair[2] as team_2_id, count(*) as total_matches, count(*) filter (winner_id = pair[1]) as team_1_wins,
  count(*) filter (winner_id = pair[2]) as team_2_wins, count(*) - count(winner_id) as draws, min(played_at) as first_match,
  max(played_at) as last_match
from paired group by pair
""")

cte("mart_map_meta", """
with per_map as (
  select map_name, count(*) as times_played, count(winner_id) as decided, count(*) filter (winner_id = team_a_id) as a_won,
    count(*) filter (winner_id = team_b_id) as b_won, sum(ifnull(score_a, 0) + ifnull(score_b, 0)) as rounds
  from fact_matches group by map_name having map_name is not null)
select map_name, times_played, round(times_played / sum(times_played) over (), 4) as pick_rate,
  round(a_won / decided, 4) as team_a_win_rate, round(b_won / decided, 4) as team_b_win_rate,
  round(rounds / times_played, 1) as avg_total_rounds
from per_map
""")


# --------------------------------------------------------------------------- standings
cte("regional_standings", """
select snapshot_date, region, regional_rank as line_no, regional_rank,
  case when regional_rank % 6 <> 0 then points end as points, team_name,
  case when regional_rank % 4 = 0 then 'one, two' end as roster,
  case when regional_rank % 5 <> 0 then detail_path end as detail_path, normalized_team_name
from raw_valve_team_regions
""")

cte("global_standings", """
select v.snapshot_date, v.spelled, r.world_ranking + d.later as world_rank, (r.world_ranking + d.later, r.team_id::bigint) as place
from raw_csapi_team_rankings r
join (select distinct snapshot_date, regional_rank, normalized_team_name as spelled from raw_valve_team_regions) v
  on v.snapshot_date = r.ranking_date and v.regional_rank = r.team_id::bigint
join (values (0), (100000)) d(later) on d.later = 0 or r.team_id::bigint % 11 = 0
where r.world_ranking is not null and r.team_id::bigint % 13 <> 4
""")

cte("team_days", """
select match_sk, source, map_name, try_cast(played_at as date) as day, unnest([team_a_id, team_b_id]) as team_id,
  unnest([team_b_id, team_a_id]) as opponent_id,
  unnest([coalesce(winner_id = team_a_id, false), coalesce(winner_id = team_b_id, false)])::int as is_win
from fact_matches
""")

# --------------------------------------------------------------------------- lookups
cte("monthly_rankings", """
select ranking_date, cast(l_suppkey as varchar) as team_id,
  cast(row_number() over (partition by ranking_date order by revenue desc, l_suppkey asc) as bigint) as rank
from (
  select date_trunc('month', l_shipdate)::date as ranking_date, l_suppkey,
         sum(cast(l_extendedprice as decimal(28,2))) as revenue
  from lineitem group by 1, 2
)
""")

cte("asof_ranking", """
select m.match_id, m.map_name, m.team_a_id, m.team_b_id, m.match_date, m.asof_date,
       ra.rank as team_a_rank, rb.rank as team_b_rank
from (
  select f.*, (select max(d.ranking_date) from (select distinct ranking_date from monthly_rankings) d
               where d.ranking_date between f.match_date - interval 15 day and f.match_date - interval 1 day)::date
           as asof_date
  from (select match_id, map_name, team_a_id, team_b_id, try_cast(played_at as date) as match_date
        from fact_matches where source = 'csapi') f
) m
left join monthly_rankings ra on ra.ranking_date = m.asof_date and ra.team_id = m.team_a_id
left join monthly_rankings rb on rb.ranking_date = m.asof_date and rb.team_id = m.team_b_id
""")

cte("batch_keys", """
select source, d, 'raw/' || source || '/matches/year=' || strftime(d, '%Y') || '/month=' || strftime(d, '%m')
       || '/day=' || strftime(d, '%d') || '/matches.parquet' as object_key
from (select distinct source, try_cast(played_at as date) as d from fact_matches)
where d is not null
""")
