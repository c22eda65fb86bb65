"""DuckDB SQL for each registered query key (the correctness oracle)."""

from __future__ import annotations

from .standins import with_ctes

_SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    _SQL[name] = text


sql("stg_matches", """
select * from int_matches_unioned where source in ('faceit', 'pandascore')
""")
sql("stg_matches_ranked", "select * from int_matches_unioned where source = 'csapi'")
sql("stg_players", "select * from players_unioned_raw")
sql("stg_rankings", "select * from stg_csapi_team_rankings")
sql("stg_rounds", "select * from stg_hltv_round_history")
sql("union_matches", "select * from int_matches_unioned")
sql("union_players", "select * from players_unioned_raw")
sql("dedupe_priority", "select * from int_players_unioned")
sql("dim_maps", "select * from dim_maps")
sql("dim_players", "select * from dim_players")
sql("dim_teams", "select * from dim_teams")
sql("fact_matches", "select * from fact_matches")
sql("fact_player_stats", "select * from fact_player_stats")
sql("mart_upset_features", "select * from mart_upset_features")
sql("mart_team_performance", "select * from mart_team_performance")
sql("mart_head2head", "select * from mart_head2head")
sql("mart_map_meta", "select * from mart_map_meta")
sql("mart_player_leaderboard", """
select player_id, display_name, team_id, matches_played, avg_adr, avg_kd_ratio, avg_kast, avg_rating, avg_kills,
       avg_deaths, peak_elo, world_ranking, tier, adr_pct_rank, kd_pct_rank, kast_pct_rank, rating_pct_rank,
       kills_pct_rank
from mart_player_leaderboard
""")
sql("mart_hidden_gems", "select * from mart_hidden_gems")
sql("mart_choke_profile", "select * from mart_choke_profile")
sql("agg_percentile", "select * from tier_bars")
sql("agg_trend_windows", "select * from form_windows")
sql("agg_map_team", "select * from map_sides")
sql("map_team_flags", "select * from map_sides_flagged")
sql("agg_team_pressure", "select * from pressure")
sql("agg_league", "select * from league")
sql("mirror_team_rounds", """
select map_stats_id, match_id, map_name, played_at, round_number, winner_team_id, is_overtime, team_id, team_name,
       opponent_id, opponent_name, own_score_after, opp_score_after, won_round, own_score_before, opp_score_before
from round_sides
""")
sql("unpivot_team_rows", "select * from team_match_rows")
sql("gem_gap", """
select player_id, display_name, team_id, player_tier, stats_above_tier_threshold,
       round(recent_90_day_gap_to_tier_above, 6) as recent_gap,
       round(previous_90_day_gap_to_tier_above, 6) as previous_gap
from gem_candidates
""")


def oracle_sql() -> dict[str, str]:
    return {k: with_ctes(v) for k, v in _SQL.items()}


sql("latest_snapshot_filter", "select team_name, normalized_team_name, region from newest_regions")
sql("unique_keys_only", "select name_key as normalized_team_name, region from region_hints where kind = 'unique'")
sql("unambiguous_values", """
select kind, name_key, region from region_hints where kind <> 'unique'
""")
sql("join_cascade_lookup", """
select team_id, team_name, region, world_ranking, last_updated, ranking_source, ranking_source_priority
from ranked_teams
""")
sql("join_dim_left", """
select f.match_sk, f.map_name, d.map_sk as dim_map_sk from fact_matches f left join dim_maps d on f.map_name = d.map_name
""")
sql("join_computed_key", "select * from stat_rows")
sql("join_tier_above", """
select player_id, display_name, team_id, player_tier, adr_threshold, kd_threshold, kast_threshold, rating_threshold
from gem_candidates
""")
sql("asof_ranking", "select * from asof_ranking")
sql("anti_join_loaded", """
select source, d, object_key from batch_keys where d > date '1995-06-30' and source <> 'pandascore'
""")
sql("semi_join_selection", """
select match_sk, match_id, team_a_region, team_b_region from mart_upset_features
where team_a_region in ('EUROPE', 'ASIA', 'AFRICA') or team_b_region in ('EUROPE', 'ASIA', 'AFRICA')
""")
sql("latest_complete_snapshot", """
select * from (with files as (
  select distinct 'standings_' || case o_orderpriority when '1-URGENT' then 'americas' when '2-HIGH' then 'asia'
      when '3-MEDIUM' then 'europe' when '4-NOT SPECIFIED' then 'global' when '5-LOW' then 'global' end
      || '_' || strftime(o_orderdate, '%Y_%m_%d') || '.md' as filename
  from orders
), parsed as (
  select regexp_extract(filename, '^standings_([a-z]+)_(\\d{4})_(\\d{2})_(\\d{2})\\.md$', 1) as kind,
         try_cast(regexp_extract(filename, '^standings_([a-z]+)_(\\d{4})_(\\d{2})_(\\d{2})\\.md$', 2) as int) as year,
         make_date(try_cast(regexp_extract(filename, '^standings_([a-z]+)_(\\d{4})_(\\d{2})_(\\d{2})\\.md$', 2) as int),
                   try_cast(regexp_extract(filename, '^standings_([a-z]+)_(\\d{4})_(\\d{2})_(\\d{2})\\.md$', 3) as int),
                   try_cast(regexp_extract(filename, '^standings_([a-z]+)_(\\d{4})_(\\d{2})_(\\d{2})\\.md$', 4) as int))
           as snapshot_date
  from files where filename is not null
), ok as (
  select * from parsed where kind in ('americas', 'asia', 'europe', 'global') and year is not null
), per_date as (
  select snapshot_date, count(distinct kind) as kinds from ok
  where year = (select max(year) from ok) group by snapshot_date
)
select max(snapshot_date) as snapshot_date, count(*) as complete_dates from per_date where kinds = 4)
""")
sql("match_window", """
select match_sk, match_id, source, map_name, played_at from fact_matches
order by played_at desc, match_id desc, source asc, map_name asc nulls last limit 150
""")
sql("win_partition_max", """
select map_stats_id, round_number, team1_id, team2_id,
  max(round_number) over (partition by map_stats_id) as total_rounds,
  max(score_team1_after) over (partition by map_stats_id) as final_team1_score,
  max(score_team2_after) over (partition by map_stats_id) as final_team2_score
from stg_hltv_round_history
""")

# Rules: model, its rows, the key that names them, then columns.
_MODELS = {
    "stg_faceit_matches": ("int_matches_unioned where source = 'faceit'", "match_id"),
    "stg_pandascore_matches": ("int_matches_unioned where source = 'pandascore'", "match_id"),
    "stg_csapi_matches": ("int_matches_unioned where source = 'csapi'", "match_id"),
    "stg_csapi_team_rankings": ("stg_csapi_team_rankings", "team_id"),
    "stg_csapi_player_stats": ("players_unioned_raw where source = 'csapi'", "player_id"),
    "stg_valve_team_regions": ("stg_valve_team_regions", "team_name"),
    "stg_hltv_round_history": ("stg_hltv_round_history", "map_stats_id"),
    "stg_faceit_players": ("players_unioned_raw where source = 'faceit'", "player_id"),
    "stg_pandascore_players": ("players_unioned_raw where source = 'pandascore'", "player_id"),
    "stg_liquipedia_teams": ("stg_liquipedia_teams", "team_id"),
    "int_matches_unioned": ("int_matches_unioned", "match_id"), "int_players_unioned": ("int_players_unioned", "player_id"),
    "fact_matches": ("fact_matches", "match_sk"), "fact_player_stats": ("fact_player_stats", "player_stat_sk"),
    "dim_teams": ("dim_teams", "team_id"), "dim_players": ("dim_players", "player_id"), "dim_maps": ("dim_maps", "map_sk"),
    "mart_team_performance": ("mart_team_performance", "team_id"), "mart_player_leaderboard": ("mart_player_leaderboard", "player_id"),
    "mart_map_meta": ("mart_map_meta", "map_name"), "mart_head2head": ("mart_head2head", "team_1_id"),
    "mart_upset_features": ("mart_upset_features", "match_sk"), "mart_hidden_gems": ("mart_hidden_gems", "player_id"),
    "mart_choke_profile": ("mart_choke_profile", "team_id")}


def _rule(model: str, rule: str, column: str, fails: str) -> str:
    rows, key = _MODELS[model]
    return f"""select '{model}' as "table", '{rule}' as rule, '{column}' as "column", count(*) filter ({fails}) as failures,
  min({key}::varchar) filter ({fails}) as sample_key from (from {rows})"""


_PRESENT = """
stg_faceit_matches match_id source team_a_id team_b_id played_at
stg_pandascore_matches match_id source
stg_csapi_matches match_id source team_a_id team_b_id played_at
stg_csapi_team_rankings team_id source world_ranking ranking_date
stg_csapi_player_stats player_id source
stg_valve_team_regions snapshot_date source normalized_team_name region
stg_hltv_round_history source map_stats_id round_number winner_side winner_team_id
stg_faceit_players player_id source recorded_at
stg_pandascore_players player_id source
stg_liquipedia_teams team_id name ingested_at
int_matches_unioned match_id source
int_players_unioned player_id source
fact_matches match_sk match_id source team_a_id played_at
fact_player_stats player_stat_sk player_id match_id
dim_teams team_id team_name
dim_players player_id display_name
dim_maps map_sk map_name
mart_team_performance team_id win_rate
mart_player_leaderboard player_id
mart_map_meta map_name pick_rate
mart_head2head team_1_id team_2_id total_matches
mart_upset_features match_sk is_upset
mart_hidden_gems player_id is_hidden_gem prospect_score recent_90_day_maps_played minimum_recent_90_day_maps meets_recent_sample_size
mart_hidden_gems trend_direction
mart_choke_profile team_id team_name maps_analyzed rounds_analyzed overtime_maps_analyzed close_maps_analyzed maps_with_5plus_lead
mart_choke_profile minimum_stable_maps sample_quality lead_blown_rate_display halftime_leads_lost halftime_comeback_rate_display
mart_choke_profile comeback_metric_type halftime_data_available metric_source round_history_available clutch_data_available
mart_choke_profile bracket_data_available sample_size_warning
"""
sql("dq_not_null", "\nunion all\n".join(_rule(m, "not_null", c, f"{c} is null") for m, *cs in map(str.split, _PRESENT.strip().splitlines()) for c in cs))
sql("dq_accepted_values", "\nunion all\n".join(_rule(m, "accepted_values", c, f"{c} not in ({values})") for m, c, values in [
    ("stg_faceit_matches", "source", "'faceit'"), ("stg_pandascore_matches", "source", "'pandascore'"), ("stg_csapi_matches", "source", "'csapi'"),
    ("stg_csapi_team_rankings", "source", "'csapi'"), ("stg_csapi_player_stats", "source", "'csapi'"), ("stg_valve_team_regions", "source", "'valve'"),
    ("stg_hltv_round_history", "source", "'hltv_unofficial'"), ("stg_hltv_round_history", "winner_side", "'t', 'ct'"),
    ("int_matches_unioned", "source", "'faceit', 'pandascore', 'csapi'"), ("int_players_unioned", "source", "'faceit', 'pandascore', 'csapi'"),
    ("mart_upset_features", "is_upset", "0, 1"),
    ("mart_hidden_gems", "trend_direction", "'gap_growing', 'gap_shrinking', 'gap_flat', 'insufficient_history'"),
    ("mart_choke_profile", "sample_quality", "'limited', 'directional', 'stable'"), ("mart_choke_profile", "metric_source", "'hltv_unofficial'")]))
sql("dq_expression", "\nunion all\n".join(_rule("mart_choke_profile", "expression_is_true", f"{c} >= 0", f"{c} < 0") for c in (
    "maps_analyzed", "rounds_analyzed", "overtime_maps_analyzed", "close_maps_analyzed", "maps_with_5plus_lead", "minimum_stable_maps",
    "halftime_leads_lost")))
_UQ = ("select '{t}' as \"table\", 'unique' as rule, '{c}' as \"column\", cast(count(*) as bigint) as failures "
       "from (select {c} from {t} group by {c} having count(*) > 1)")
sql("dq_unique", "\nunion all\n".join([
    _UQ.format(t="fact_matches", c="match_sk"),
    _UQ.format(t="fact_matches", c="match_id,source,map_name"),
    _UQ.format(t="fact_player_stats", c="player_stat_sk"),
    _UQ.format(t="dim_teams", c="team_id"),
    _UQ.format(t="dim_players", c="player_id")]))
sql("dq_unique_models", "\nunion all\n".join(_UQ.format(t=t, c=c) for t, c in [
    ("dim_maps", "map_sk"), ("dim_maps", "map_name"), ("stg_liquipedia_teams", "team_id"), ("mart_team_performance", "team_id"),
    ("mart_map_meta", "map_name"), ("mart_upset_features", "match_sk"), ("mart_choke_profile", "team_id")]))
sql("dq_relationship", """
select 'fact_player_stats' as "table", 'relationships' as rule, 'player_id' as "column", cast(count(*) as bigint) as failures
from fact_player_stats s where s.player_id is not null
  and not exists (select 1 from dim_players p where p.player_id = s.player_id)
""")
sql("dq_non_empty", "\nunion all\n".join(
    f"select '{t}' as \"table\", cast(count(*) as bigint) as row_count, count(*) = 0 as is_empty from {t}"
    for t in ("mart_team_performance", "mart_player_leaderboard", "mart_upset_features", "mart_choke_profile")))

_RL = "case when trim({c}) is null or trim({c}) = '' or lower(trim({c})) = 'global' then 'Unknown' else trim({c}) end"
_TL = ("case when trim({n}) is not null and trim({n}) != '' then trim({n}) "
       "when trim(cast({i} as varchar)) is not null and trim(cast({i} as varchar)) != '' then 'Team ' || trim(cast({i} as varchar)) "
       "else 'Unknown team' end")
_LB = ("case when lower(trim(cast({c} as varchar))) in ('1', 'true', 't', 'yes', 'y') then true "
       "when lower(trim(cast({c} as varchar))) in ('0', 'false', 'f', 'no', 'n') then false end")

sql("serve_home_kpis", """
select u.matches, u.upsets, g.hidden_gems, c.pressure_teams, u.upsets::double / nullif(u.matches::double, 0) as upset_rate
from (select count(*) as matches, cast(sum(is_upset) as bigint) as upsets from mart_upset_features) u,
     (select count(*) as hidden_gems from mart_hidden_gems) g,
     (select count(*) as pressure_teams from mart_choke_profile) c
""")
_MF = f"""
select match_id, map_name, played_at, {_TL.format(n='team_a_name', i='team_a_id')} as team_a,
  {_TL.format(n='team_b_name', i='team_b_id')} as team_b,
  {_RL.format(c='team_a_region')} as team_a_region_label, {_RL.format(c='team_b_region')} as team_b_region_label,
  ranking_delta, case when is_upset = 1 then 'upset' else 'expected' end as outcome, is_cross_region
from mart_upset_features
where ({_RL.format(c='team_a_region')} in ('EUROPE', 'ASIA') or {_RL.format(c='team_b_region')} in ('EUROPE', 'ASIA'))
  and coalesce(ranking_delta, 0) >= 10
"""
sql("serve_match_filter", f"select * from ({_MF}) where outcome = 'upset'")
sql("serve_match_kpis", f"""
select count(*) as visible_matches, count_if(outcome = 'upset') as upsets,
  cast(sum(is_cross_region) as bigint) as cross_region, median(ranking_delta) as median_ranking_delta
from ({_MF})
""")
sql("scalar_labels", f"""
select match_sk, {_TL.format(n='team_a_name', i='team_a_id')} as team_a, {_TL.format(n='team_b_name', i='team_b_id')} as team_b,
  {_RL.format(c='team_a_region')} as team_a_region_label, {_RL.format(c='team_b_region')} as team_b_region_label,
  {_LB.format(c='is_overtime')} as overtime_flag, {_LB.format(c='is_upset')} as upset_flag
from mart_upset_features
""")
_GF = """select * from mart_hidden_gems where player_tier in (2, 3, 4) and stats_above_tier_threshold >= 3
  and coalesce(recent_90_day_maps_played, 0) >= 0"""
sql("serve_gem_filter", _GF)
sql("serve_gem_kpis", f"""
select count(*) as prospects, median(prospect_score) as median_prospect_score, median(matches_played) as median_maps,
  count_if(trend_direction = 'gap_growing') as gap_growing
from ({_GF})
""")
sql("topk_gems", """
select player_id, display_name, team_id, player_tier, prospect_score, trend_direction from mart_hidden_gems
order by prospect_score desc, player_id asc, team_id asc limit 8
""")
sql("melt_gap_windows", """
select player_id, display_name, 'Previous 90 days' as "window", previous_90_day_gap_to_tier_above as gap
from (select * from mart_hidden_gems order by prospect_score desc, player_id asc, team_id asc limit 15)
union all
select player_id, display_name, 'Recent 90 days', recent_90_day_gap_to_tier_above
from (select * from mart_hidden_gems order by prospect_score desc, player_id asc, team_id asc limit 15)
""")
sql("serve_team_filter", """
select team_id, team_name, total_maps, sample_quality, lead_blown_rate as metric_value from mart_choke_profile
where total_maps >= 20 and sample_quality in ('stable', 'directional') and lead_blown_rate is not null
order by lead_blown_rate desc nulls last, team_id asc limit 20
""")
sql("serve_team_kpis", """
select cast(sum(total_maps) as bigint) as maps, cast(sum(rounds_analyzed) as bigint) as rounds,
  median(lead_blown_rate) as median_lead_blown_rate, median(comeback_rate) as median_comeback_rate,
  median(ot_win_rate) as median_ot_win_rate, median(close_map_win_rate) as median_close_map_win_rate
from mart_choke_profile
""")
sql("serve_scatter", """
select team_id, team_name, lead_blown_rate, comeback_rate, total_maps from mart_choke_profile
where lead_blown_rate is not null and comeback_rate is not null
""")
sql("agg_value_counts", """
select 'trend_direction' as metric, coalesce(trend_direction, 'unknown') as value, count(*) as n
from mart_hidden_gems group by 2
union all
select 'sample_quality', coalesce(sample_quality, 'unknown'), count(*) from mart_choke_profile group by 2
""")
sql("agg_daily", """
select d, count(*) as matches, cast(sum(is_upset) as bigint) as upsets
from (select try_cast(played_at as date) as d, is_upset from mart_upset_features) where d is not null
group by d order by d desc limit 14
""")
sql("agg_share", """
select avg(cast(sample_quality = 'limited' as int)) as limited_share from mart_choke_profile
""")
sql("agg_bound", """
select 'ranking_delta' as "column", greatest(coalesce(max(try_cast(ranking_delta as int)), 1), 1) as bound
from mart_upset_features
union all
select 'matches_played', greatest(coalesce(max(try_cast(matches_played as int)), 1), 1) from mart_hidden_gems
union all
select 'total_maps', greatest(coalesce(max(try_cast(total_maps as int)), 1), 1) from mart_choke_profile
""")
sql("region_slots", f"""
select region, count(*) as slots from (
  select {_RL.format(c='team_a_region')} as region from mart_upset_features
  union all
  select {_RL.format(c='team_b_region')} from mart_upset_features
) group by region
""")
sql("distinct_sorted", """
select distinct region from (select team_a_region as region from mart_upset_features
                             union all select team_b_region from mart_upset_features)
where region is not null order by region
""")
sql("scalar_tier", """
select team_id, world_ranking, case when world_ranking between 1 and 10 then 1 when world_ranking between 11 and 30 then 2
  when world_ranking between 31 and 50 then 3 else 4 end as tier
from dim_teams
""")
sql("scalar_null", """
select team_id, ranking_date, coalesce(world_ranking, 999) as rank_or_default,
  vrs_points::double / nullif(rank_diff, 0)::double as points_per_rank_step,
  case when lower(region) = 'global' then null else region end as region
from stg_csapi_team_rankings
""")
sql("scalar_math", """
select match_sk, abs(score_diff) as abs_diff, greatest(score_a, score_b) as high_score, least(score_a, score_b) as low_score,
  sround(score_a / nullif(total_rounds, 0), 4) as share_a
from mart_upset_features
""")
sql("scalar_surrogate_key", """
select match_sk,
  md5(coalesce(cast(match_id as varchar), '_dbt_utils_surrogate_key_null_') || '-'
      || coalesce(cast(winner_id as varchar), '_dbt_utils_surrogate_key_null_')) as match_winner_sk,
  md5(coalesce(cast(map_name as varchar), '_dbt_utils_surrogate_key_null_')) as map_sk2
from fact_matches
""")
sql("scalar_cast", """
select map_stats_id, cast(round_number as int) as round_number, try_cast(played_at as timestamp) as played_ts,
  try_cast(reported_score as int) as reported_as_int,
  try_cast(split_part(reported_score, '-', 1) as int) as reported_team1,
  cast(is_overtime as int) as overtime_int
from raw_hltv_round_history
""")
sql("scalar_date", """
select match_sk, d, d - interval 1 day as day_before, d - interval 89 day as window_start, d >= date '2000-01-01' as is_recent
from (select match_sk, try_cast(played_at as date) as d from fact_matches) where d is not null
""")
sql("scalar_ratio", "select player_stat_sk, computed_kd, kill_share from fact_player_stats")
sql("scalar_flags", """
select match_sk, is_cross_region, ranking_delta > 5 as delta_over_5, team_a_region != team_b_region as regions_differ
from mart_upset_features
""")
sql("scalar_bool", f"""
select event_id, {_LB.format(c="case when event_type = 'click' then 'Yes' when event_type = 'view' then ' true ' when event_type = 'error' then '0' when event_type = 'signup' then 'N' else event_type end")} as flag
from events
""")
sql("scalar_record", """
select team_id, cast(wins as varchar) || '-' || cast(losses as varchar) as record,
  greatest(close_maps - close_map_wins, 0) as close_map_losses,
  case when sround(close_map_win_rate * 100, 1) is null then 'n/a'
       else cast(sround(close_map_win_rate * 100, 1) as varchar) || '%' end as close_rate_text
from mart_choke_profile
""")
sql("json_extract", """
select event_id, cast(json_extract_string(props, '$.k') as int) as k_path, cast(json_extract(props, '$.k') as int) as k_struct
from events
""")
sql("agg_player", """
select player_id, display_name, team_id, count(*) as matches_played, xavg(adr) as avg_adr, xavg(kast) as avg_kast,
  max(recorded_at) as latest
from stat_rows group by player_id, display_name, team_id
""")


# --------------------------------------------------------------------------- normalisers
_MAPID = "cast(cast(split_part({c}, '-', 1) as bigint) * 1000 + cast(split_part({c}, '-', 2) as bigint) as varchar)"
_NAME = "'Supplier#' || lpad({c}, 9, '0')"

sql("norm_match_json", """
select match_id, 'faceit' as source, coalesce(team_a_id, 'unknown') as team_a_id, coalesce(team_b_id, 'unknown') as team_b_id,
  winner_id, played_at, map_name, score_a, score_b, is_overtime
from raw_matches_all where source = 'faceit'
""")
sql("norm_match_array", """
select cast(cast(match_id as bigint) as varchar) as match_id, 'pandascore' as source, team_a_id, team_b_id, winner_id,
  played_at, map_name, score_a, score_b, is_overtime
from raw_matches_all where source = 'pandascore'
""")
sql("norm_rankings", """
select team_id, name, world_ranking, vrs_points, cast(null as varchar) as region, ranking_date from raw_csapi_team_rankings
""")
sql("norm_nested_explode", """
select player_id, 'faceit' as source, display_name, team_id, nationality, cast(null as bigint) as kills,
  cast(null as bigint) as deaths, elo, match_id
from raw_player_rows where source = 'faceit' and match_id is not null
""")
_NR = f"""
select 'hltv_unofficial' as source, {_MAPID.format(c='map_stats_id')} as map_stats_id,
  {_MAPID.format(c='match_id')} as match_id, regexp_extract(event_id, '(\\d+)$', 1) as event_id, event_name, map_name,
  strftime(cast(min(played_at) over (partition by map_stats_id) as timestamp), '%Y-%m-%d') as played_at,
  round_number, t_team_id, t_team_name, ct_team_id, ct_team_name, winner_side, winner_team_id, winner_team_name,
  team1_id, team1_name, team2_id, team2_name, score_team1_after, score_team2_after, reported_score, round_outcome,
  is_overtime, '2026-05-04T00:00:00' as ingested_at
from raw_hltv_round_history
"""
sql("norm_player_stats", """
select player_id, source, display_name, team_id, team_name, cast(null as varchar) as nationality, kills, deaths, adr,
  case when deaths > 0 then kills / deaths end as kd_ratio, kast, rating, 0.0::double as swing, 1::bigint as matches_played,
  cast(null as bigint) as elo, match_id, recorded_at
from raw_csapi_player_stats where display_name is not null and adr is not null
""")
sql("norm_rounds", _NR)
sql("running_score", f"select map_stats_id, round_number, score_team1_after, score_team2_after from ({_NR})")
sql("round_side_assignment", f"""
select cast(cast(split_part(map_stats_id, '-', 1) as bigint) * 1000 + cast(split_part(map_stats_id, '-', 2) as bigint) as bigint) as map_id,
  round_number,
  case when ct_team_id = team1_id then 'ct' else 't' end as team1_side
from raw_hltv_round_history
""")
sql("round_side", """
select map_stats_id, round_number, round_outcome,
  case when lower(trim(round_outcome)) in ('ct_win', 'bomb_defused', 'stopwatch') then 'ct'
       when lower(trim(round_outcome)) in ('t_win', 'bomb_exploded') then 't' end as side
from raw_hltv_round_history
""")
sql("score_parse", """
select map_stats_id, round_number, coalesce(reported_score, round_outcome) as text,
  case when regexp_matches(coalesce(reported_score, round_outcome), '^\\s*(\\d+)\\s*-\\s*(\\d+)\\s*$')
       then cast(regexp_extract(coalesce(reported_score, round_outcome), '^\\s*(\\d+)\\s*-\\s*(\\d+)\\s*$', 1) as bigint) end as score_1,
  case when regexp_matches(coalesce(reported_score, round_outcome), '^\\s*(\\d+)\\s*-\\s*(\\d+)\\s*$')
       then cast(regexp_extract(coalesce(reported_score, round_outcome), '^\\s*(\\d+)\\s*-\\s*(\\d+)\\s*$', 2) as bigint) end as score_2
from raw_hltv_round_history
""")
sql("reject_invalid_groups", f"""
select b.sign || {_MAPID.format(c='map_stats_id')} as map_stats_id, cast(count(*) as int) as rounds, b.sign = '' as kept
from raw_hltv_round_history join (values (''), ('-')) b(sign) on b.sign = '' or map_name in ('Map6', 'Map4', 'Map3')
group by map_stats_id, b.sign
""")
sql("start_sides", """
select cast(cast(split_part(map_stats_id, '-', 1) as bigint) * 1000 + cast(split_part(map_stats_id, '-', 2) as bigint) as bigint) as map_id,
  case when round_number <= 24 then -1 else (round_number - 25) // 3 end as slice,
  case when ct_team_id = team1_id then 'CT' else 'T' end as team1,
  case when ct_team_id = team1_id then 'T' else 'CT' end as team2
from raw_hltv_round_history
where round_number = 1 or (round_number > 24 and (round_number - 25) % 3 = 0)
""")
sql("batch_summary", """
select event_id as batch_id, count(*) + count_if(map_name in ('Map6', 'Map4', 'Map3')) as scanned, count(*) as valid,
  count_if(map_name in ('Map6', 'Map4', 'Map3')) as skipped, cast(sum(n) as bigint) as rows
from (select map_stats_id, max(event_id) as event_id, max(map_name) as map_name, count(*) as n
      from raw_hltv_round_history group by map_stats_id)
group by event_id
""")
_LP_PLAYERS = "(select distinct player_id::bigint as k, display_name from raw_player_rows where match_id is null)"
_LP_MONTHS = "(select date_trunc('month', o_orderdate)::date as month, count(*) as n, sum(o_totalprice::decimal(28, 2)) as total from orders group by 1)"
_LP_PLACES = "(select date_trunc('month', l_shipdate)::date as month, l_suppkey as k, count(*) as n from lineitem group by all)"
sql("entity_counts", f"""
select 'faceit' as source, 'match' as entity, count(*) as documents, null::bigint as records from raw_matches_all where source = 'faceit'
union all select 'pandascore', 'match', count(*), null from raw_matches_all where source = 'pandascore'
union all select 'csapi', 'ranking', count(distinct (ranking_date, world_ranking is null, coalesce(world_ranking, team_id::bigint) // 500)), null
  from raw_csapi_team_rankings
union all select 'faceit', 'match_stats', count(distinct match_id), null from raw_player_rows where source = 'faceit' and match_id is not null
union all select 'hltv', 'mapstats', count(distinct map_stats_id), null from raw_hltv_round_history
union all select 'hltv', 'match', count(distinct match_id), null from raw_csapi_player_stats
union all select 'liquipedia', 'team', count(*), count(*) from raw_liquipedia_teams
union all select 'liquipedia', 'player', count(*), count(*) from {_LP_PLAYERS}
union all select 'liquipedia', 'match', count(*), count(*) from raw_matches_all where source = 'csapi'
union all select 'liquipedia', 'tournament', count(*), count(*) from {_LP_MONTHS}
union all select 'liquipedia', 'placement', count(*), count(*) from {_LP_PLACES}
""")
sql("norm_liquipedia_players", f"""
select 'lp_player_' || k as player_id, 'liquipedia' as source, display_name, case when k % 3 = 0 then 'lp_' || k % 50 end as team_id,
  case when k % 4 = 0 then 'Nowhere' end as nationality, '2026-05-04T00:00:00' as recorded_at
from {_LP_PLAYERS}
""")
sql("norm_liquipedia_matches", """
select match_id, 'liquipedia' as source, case when match_id::bigint % 9 = 0 then 'unknown' else 'lp_' || team_a_id end as team_a_id,
  case when match_id::bigint % 8 = 0 then 'unknown' else 'lp_' || team_b_id end as team_b_id, 'lp_' || winner_id as winner_id,
  case when match_id::bigint % 10 = 0 then 'unknown' else played_at end as played_at
from raw_matches_all where source = 'csapi'
""")
sql("liquipedia_placements", f"""
with cups as (select strftime(month, 'cup_%Y_%m') as key, 'Cup of ' || strftime(month, '%Y-%m') as tournament_name,
    if(n % 2 = 0, 'S', 'A') as tier, month as start_date, if(month(month) % 2 = 0, last_day(month), null) as end_date,
    if(month(month) % 2 = 0, trunc(total), null)::double as prize_pool from {_LP_MONTHS}),
places as (select strftime(month, 'cup_%Y_%m') as cup, * from {_LP_PLACES})
select 'place_' || cup || '_' || k as page, p.tournament, 'lp_' || k as team, p.place, p.best_place::int as best_place,
  p.worst_place::int as worst_place, tournament_name, tier, start_date, end_date, prize_pool
from (select *, if(k % 6 <> 0, cup, null) as tournament,
    case when n <= 2 then n::varchar when n <= 4 then '3-4' when n <= 8 then ' 5 - 8 ' else 'DNF' end as place,
    case when n <= 2 then n when n <= 4 then 3 when n <= 8 then 5 end as best_place,
    case when n <= 2 then n when n <= 4 then 4 when n <= 8 then 8 end as worst_place from places) p
left join cups on cups.key = p.tournament
""")
_CACHED = """(select match_id::bigint as id, player_id::bigint as player, display_name, team_id::bigint as team, kills::bigint as k,
    deaths::bigint as d, adr, kast, rating from raw_csapi_player_stats)"""
sql("side_stats_flatten", f"""
select id::varchar as match_id, (id * 10 + n)::varchar as map_stats_id, 'Map' || n as map_name, if(team % 2 = 0, 'team1', 'team2') as team, side,
  player::varchar as player_id, display_name as nickname, if(player % 4 <> 0, 'Nowhere', null) as country, (k % 7)::double as opening_kills,
  (d % 5)::double as opening_deaths, (k % 7) / 2 as eco_opening_kills, (d % 5) / 2 as eco_opening_deaths,
  if(k % 2 = 1, k % 3, 0)::double as multi_kill_rounds, kast, kast / 2 as eco_kast, if(d % 2 = 0, k % 4, 0)::double as clutches_won,
  here::double as kills, (here // 3)::double as headshots, here / 4 as eco_kills, null::double as eco_headshots, (k % 6)::double as assists,
  (k % 2)::double as flash_assists, d::double as deaths, (d // 4)::double as traded_deaths, d / 2 as eco_deaths, 0::double as eco_traded_deaths,
  adr, adr / 2 as eco_adr, 1.5::double as swing, rating
from (select *, case side when 't' then k // 2 when 'ct' then k - k // 2 else k end as here
      from {_CACHED}, (values (1), (2)) maps(n), (values ('combined'), ('t'), ('ct')) sides(side))
where (n = 1 or (id % 3 <> 0 and id % 11 <> 0)) and (side <> 't' or id % 2 = 0)
""")
sql("match_player_stats", f"""
select id::varchar as match_id, if(team % 2 = 0, 'team1', 'team2') as team, player::varchar as player_id, display_name as nickname,
  'Nowhere' as country, (2 * k)::double as kills, (2 * d)::double as deaths, k / 2 as eco_kills, d / 2 as eco_deaths, -0.5::double as swing,
  adr, adr / 2 as eco_adr, kast, kast / 2 as eco_kast, rating
from {_CACHED} where player % 13 <> 0
""")
sql("parse_pipe_table", "select * from regional_standings")
sql("attach_first_rank", """
select t.snapshot_date, t.region, t.team_name, t.normalized_team_name, t.regional_rank, t.points,
  (select arg_min(g.world_rank, g.place) from global_standings g
   where g.snapshot_date = t.snapshot_date and g.spelled = t.normalized_team_name) as global_rank
from regional_standings t
""")
sql("normalize_name", """
select source, name, regexp_replace(lower(regexp_replace(trim(name), '^team[\\s_-]+', '', 'i')), '[^a-z0-9]+', '', 'g') as normalized
from (select distinct * from (
  select 'csapi' as source, name from raw_csapi_team_rankings
  union all select 'liquipedia', name from raw_liquipedia_teams
  union all select 'valve', team_name from raw_valve_team_regions))
""")
sql("stat_cell_parse", """
select player_id, match_id, kind, cell,
  case when kind in ('kd', 'colon') then kills end as pair_left,
  case when kind in ('kd', 'colon') then deaths end as pair_right,
  case when kind = 'paren' then kills end as main_value,
  case when kind = 'paren' then cast(cast(deaths / 5 as bigint) as double) end as paren_value,
  case when kind = 'pct' then cast(floor(kast) as double) end as percent
from (
  select player_id, match_id, kills, deaths, kast, k.kind,
    case k.kind when 'kd' then cast(cast(kills as bigint) as varchar) || '-' || cast(cast(deaths as bigint) as varchar)
      when 'colon' then cast(cast(kills as bigint) as varchar) || ' : ' || cast(cast(deaths as bigint) as varchar)
      when 'paren' then cast(cast(kills as bigint) as varchar) || ' (' || cast(cast(deaths / 5 as bigint) as varchar) || ')'
      when 'pct' then cast(cast(floor(kast) as bigint) as varchar) || '%'
      else 'n/a' end as cell
  from raw_csapi_player_stats
  cross join (select unnest(['kd', 'colon', 'paren', 'pct', 'junk']) as kind) k
  where player_id is not null and match_id is not null
)
""")
sql("half_scores", """
select map_stats_id, half, team1_rounds, team2_rounds from (
  select map_stats_id, 0 as half, h1 as team1_rounds, h2 as team2_rounds from m where h1 is not null
  union all select map_stats_id, 1, f1 - h1, f2 - h2 from m where h1 is not null
  union all select map_stats_id, 0, f1, f2 from m where h1 is null
) x, (select 1) dummy
""".replace("from m", "from (select map_stats_id, max(score_team1_after) as f1, max(score_team2_after) as f2, "
            "max(case when round_number = 12 then score_team1_after end) as h1, "
            "max(case when round_number = 12 then score_team2_after end) as h2 from stg_hltv_round_history group by map_stats_id) m"))
sql("series_result", """
select match_id, source, count_if(coalesce(score_a, 0) > coalesce(score_b, 0)) as team1_maps,
  count_if(coalesce(score_b, 0) > coalesce(score_a, 0)) as team2_maps,
  case when count_if(coalesce(score_a, 0) > coalesce(score_b, 0)) > count_if(coalesce(score_b, 0) > coalesce(score_a, 0)) then 1
       when count_if(coalesce(score_b, 0) > coalesce(score_a, 0)) > count_if(coalesce(score_a, 0) > coalesce(score_b, 0)) then 2 end
    as winner
from fact_matches group by match_id, source
""")


# --------------------------------------------------------------------------- model
cte_ml = """
select match_sk, played_at, cast(ranking_delta as double) as ranking_delta,
  cast(coalesce(cast(cast(is_cross_region as boolean) as int), 0) as double) as is_cross_region,
  coalesce(cast(team_a_ranking as double), -1.0) as team_a_ranking,
  coalesce(cast(team_b_ranking as double), -1.0) as team_b_ranking, cast(is_upset as int) as label
from mart_upset_features
"""
sql("ml_features", cte_ml)
sql("temporal_split", f"""
select match_sk, played_at,
  case when pos < greatest(1, least(floor(n * 0.8), n - 1)) then 'train' else 'test' end as split
from (select *, row_number() over (order by played_at asc nulls last, match_sk asc) - 1 as pos, count(*) over () as n
      from ({cte_ml}))
""")
_S3 = f"""
select *, case when pos < n - v - t then 'train' when pos < n - t then 'validation' else 'test' end as split
from (
  select *, case when v0 + t0 >= n then greatest(1, least(t0, n - greatest(1, least(v0, n - 2)) - 1)) else t0 end as t,
            case when v0 + t0 >= n then greatest(1, least(v0, n - 2)) else v0 end as v
  from (select *, greatest(1, floor(n * 0.2)) as t0, greatest(1, floor(n * 0.2)) as v0
        from (select *, row_number() over (order by played_at asc nulls last, match_sk asc) - 1 as pos,
                     count(*) over () as n from ({cte_ml})))
)
"""
sql("temporal_split3", f"select match_sk, played_at, split from ({_S3})")
_SC = "case when ranking_delta >= 0 then ranking_delta / (ranking_delta + 50.0) else 0.0 end"
_VAL = f"select {_SC} as score, label from ({_S3}) where split = 'validation'"
_TEST = f"select {_SC} as score, label from ({_S3}) where split = 'test'"
_THR = f"""
select case when p = 0 or p = nn or b is null then 0.5 else b.threshold end as threshold,
       case when p = 0 or p = nn then null else b.fbeta end as fbeta,
       case when p = 0 or p = nn then null else b.positive_rate end as positive_rate,
       p / nn as cap
from (select count(*) as nn, sum(label) as p from ({_VAL})) tot,
     (select max_by({{'threshold': threshold, 'fbeta': fbeta, 'positive_rate': positive_rate}}, [fbeta, -threshold]) as b
      from (
        select s as threshold,
          case when tp > 0 then (1.5625 * tp) / (1.5625 * tp + 0.5625 * (p - tp) + (pp - tp)) else 0.0 end as fbeta,
          pp / nn as positive_rate, p / nn as cap
        from (
          select s, sum(pos) over w as tp, sum(n) over w as pp, p, nn
          from (select score as s, sum(label) as pos, count(*) as n from ({_VAL}) group by score),
               (select count(*) as nn, sum(label) as p from ({_VAL}))
          window w as (order by s desc rows between unbounded preceding and current row)
        )
      ) where positive_rate <= cap)
"""
sql("ml_threshold", _THR)
sql("sink_metrics", _THR)
_AUC = """
select case when p = 0 or q = 0 then 0.5 else num / (2.0 * p * q) end as roc_auc
from (select sum(pos * (2 * below + neg)) as num, sum(pos) as p, sum(neg) as q
      from (select *, sum(neg) over (order by s rows between unbounded preceding and current row) - neg as below
            from (select score as s, sum(label) as pos, count(*) - sum(label) as neg from ({src}) group by score)))
"""
sql("ml_metrics", f"""
select threshold,
  case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision,
  case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall,
  case when tp > 0 then (2.0 * tp) / (2.0 * tp + fn + fp) else 0.0 end as f1,
  case when tp > 0 then (1.5625 * tp) / (1.5625 * tp + 0.5625 * fn + fp) else 0.0 end as fbeta,
  case when tp > 0 then (5.0 * tp) / (5.0 * tp + 4.0 * fn + fp) else 0.0 end as f2,
  (tp + fp) / n as predicted_positive_rate, validation_positive_rate_cap, a.roc_auc
from (select max(t.threshold) as threshold, max(t.cap) as validation_positive_rate_cap, sum(case when score >= t.threshold then label else 0 end) as tp,
             sum(case when score >= t.threshold then 1 - label else 0 end) as fp,
             sum(case when score < t.threshold then label else 0 end) as fn, count(*) as n
      from ({_TEST}), ({_THR}) t) m,
     ({_AUC.format(src=_TEST)}) a
""")
sql("ml_score", f"select match_sk, played_at, label, true as is_probability from ({_S3}) where split = 'test'")
sql("ml_attribution", f"""
select match_sk, cast(4 as bigint) as features, true as adds_up, true as is_model_score
from ({_S3}) where split = 'test'
""")
sql("ml_auc", _AUC.format(src=f"select {_SC} as score, label from ({cte_ml})"))
sql("ml_calibration", f"""
select (case when score > 0.2 then 1 else 0 end + case when score > 0.4 then 1 else 0 end
        + case when score > 0.6 then 1 else 0 end + case when score > 0.8 then 1 else 0 end) as bin,
  avg(score) as mean_predicted, avg(label) as fraction_positive, count(*) as n
from ({_TEST}) group by 1
""")
sql("ml_confusion", f"""
select label, cast(score >= t.threshold as int) as prediction, count(*) as n
from ({_TEST}), ({_THR}) t group by 1, 2
""")


# --------------------------------------------------------------------------- sources / sinks
sql("scan_parquet", "select * from raw_matches_all")
sql("partition_pruned_scan", "select * from raw_matches_all where source = 'csapi'")
sql("data_freshness", """
select 'raw_matches' as product, count(*) as row_count, true as has_loaded_at from raw_matches_all
union all select 'raw_players', count(*), true from raw_player_rows
union all select 'raw_csapi_team_rankings', count(*), true from raw_csapi_team_rankings
union all select 'raw_hltv_round_history', count(*), true from raw_hltv_round_history
""")
sql("incremental_load", "select * from raw_matches_all")
sql("merge_fact_matches", "select * from fact_matches")
sql("sink_date_partitions", """
select *, ranking_date[1:4] as year, ranking_date[6:7] as month, ranking_date[9:10] as day from raw_csapi_team_rankings
""")
sql("sink_batches", """
select batch_id, snapshot_date, count(*) as row_count, sum(points)::bigint as points
from (select unnest([replace(region, ' ', '_'), 'once']) as batch_id, snapshot_date, points from raw_valve_team_regions) group by all
""")
sql("warehouse_objects", "\nunion all\n".join(
    f"select '{model}' as model, '{kind}' as kind, count(*) as row_count from {source}" for model, kind, source in [
        ("stg_csapi_team_rankings", "view", "stg_csapi_team_rankings"),
        ("stg_liquipedia_teams", "view", "(from raw_liquipedia_teams where team_id is not null)"),
        ("stg_hltv_round_history", "view", "stg_hltv_round_history"), ("int_matches_unioned", "view", "int_matches_unioned"),
        ("mart_team_performance", "table", "mart_team_performance"), ("mart_head2head", "table", "mart_head2head"),
        ("mart_map_meta", "table", "mart_map_meta")]))
sql("norm_match_series", """
select cast(cast(match_id as bigint) as varchar) as match_id, 'csapi' as source, team_a_id, team_b_id, winner_id,
  played_at, cast(null as varchar) as map_name, score_a, score_b, cast(null as boolean) as is_overtime,
  team_a_ranking, team_b_ranking, case when score_a + score_b > 30 then 'bo3' else 'bo1' end as series_format
from raw_matches_all where source = 'csapi'
""")
sql("contract_validation", """
select source, true as contract_ok, count(*) as n from raw_matches_all where source in ('faceit', 'pandascore')
group by source
""")
sql("scan_documents", """
with m as (select split_part(map_stats_id, '-', 1)::bigint * 1000 + split_part(map_stats_id, '-', 2)::bigint as id, max(map_name) as map,
  count(*)::int as n from raw_hltv_round_history group by map_stats_id)
select 'map-' || id as document, 'valid' as verdict, id as map_id, n as rounds from m
union all select 'map-' || -id, 'invalid', null, 0 from m where map in ('Map3', 'Map4', 'Map6')
union all select 'cut-' || id, 'malformed', null, 0 from m where map = 'Map5'
union all select 'blank-' || id, 'malformed', null, 0 from m where map = 'Map2'
union all select 'list-' || id, 'malformed', null, 0 from m where map = 'Map1'
union all select 'bare-' || id, 'empty', null, 0 from m where map = 'Map0'
""")
sql("norm_players", """
select cast(cast(player_id as bigint) as varchar) as player_id, 'pandascore' as source, display_name, team_id,
  nationality, match_id, recorded_at
from raw_player_rows where source = 'pandascore'
""")
sql("norm_teams", """
select team_id, 'liquipedia' as source, name, region, cast(null as bigint) as world_ranking, ingested_at
from raw_liquipedia_teams
""")
sql("snapshot_roundtrip", "select * from mart_team_performance")


# ------------------------------------------------------------------ planned features
_RATE = "sround({w}::double / nullif({n}, 0), 4)"
sql("rolling_form", f"""
select match_sk, team_id, day, count(*) over last as matches_before,
  {_RATE.format(w="sum(is_win) over last", n="count(*) over last")} as form
from team_days where day is not null and team_id is not null
window last as (partition by team_id order by day, match_sk rows between 10 preceding and 1 preceding)
""")


def _before(prefix: str, same: str) -> str:
    """Matches and wins of the rows of ``team_days`` that meet ``same`` and lie on an earlier day."""
    return f"""(select (count(*), count(*) filter (t.is_win = 1)) from team_days t
      where {same} and t.day < m.day) as {prefix}"""


_PRIOR = {"h2h": "t.team_id = m.team_a_id and t.opponent_id = m.team_b_id",
          "h2h_map": "t.team_id = m.team_a_id and t.opponent_id = m.team_b_id and t.map_name = m.map_name",
          "team_a_map": "t.team_id = m.team_a_id and t.map_name = m.map_name",
          "team_b_map": "t.team_id = m.team_b_id and t.map_name = m.map_name"}
sql("prior_records", f"""
with known as (
  select match_sk, team_a_id, team_b_id, map_name, day, {", ".join(_before(k, v) for k, v in _PRIOR.items())}
  from (select *, try_cast(played_at as date) as day from fact_matches where source = 'csapi') m)
select match_sk, team_a_id, team_b_id, map_name, day,
  {", ".join(f"{k}[1] as {k}_matches, {_RATE.format(w=f'{k}[2]', n=f'{k}[1]')} as {k}_win_rate" for k in _PRIOR)}
from known
""")
sql("rating_differential", """
with sides as (select match_sk, try_cast(played_at as date) as day, unnest(['a', 'b']) as side, unnest([team_a_id, team_b_id]) as team_id
               from fact_matches where source = 'csapi'),
rated as (select team_id, try_cast(recorded_at as date) as day, round(rating * 10000)::bigint as units from fact_player_stats where rating is not null),
known as (select s.match_sk, s.side, sround(sum(r.units)::double / (count(*) * 10000), 4) as rating
          from sides s join rated r on r.team_id = s.team_id and r.day < s.day group by all)
select f.match_sk, team_a_id, team_b_id, try_cast(played_at as date) as day, a.rating as team_a_rating, b.rating as team_b_rating,
  sround(a.rating - b.rating, 4) as rating_differential
from fact_matches f left join known a on a.match_sk = f.match_sk and a.side = 'a'
left join known b on b.match_sk = f.match_sk and b.side = 'b' where f.source = 'csapi'
""")
sql("upset_rate_by_gap", """
with m as (select ranking_delta as gap, (winner_id <> favored_team_id)::int as upset from mart_upset_features where favored_team_id is not null),
placed as (select *, (10 * (rank() over (order by gap) - 1) // (select count(*) from m))::int as bucket from m),
b as (select bucket, min(gap) as min_gap, max(gap) as max_gap, count(*) as matches, sum(upset) as upsets, avg(upset) as p
      from placed group by bucket)
select bucket, min_gap, max_gap, matches, upsets, sround(p, 4) as upset_rate,
  round((p + 1.96 ** 2 / (2 * matches) - 1.96 * sqrt(p * (1 - p) / matches + 1.96 ** 2 / (4 * matches ** 2))) / (1 + 1.96 ** 2 / matches), 4) as lower,
  round((p + 1.96 ** 2 / (2 * matches) + 1.96 * sqrt(p * (1 - p) / matches + 1.96 ** 2 / (4 * matches ** 2))) / (1 + 1.96 ** 2 / matches), 4) as upper
from b
""")
sql("pressure_rates", f"""
with n as (
  select team_id, count(*) as maps, count(*) filter (largest_lead >= 10) as maps_led,
    count(*) filter (largest_lead >= 10 and final_own_score < final_opp_score) as leads_blown,
    count(*) filter (halftime_opp_score >= halftime_own_score + 3) as maps_trailed,
    count(*) filter (halftime_opp_score >= halftime_own_score + 3 and final_own_score > final_opp_score) as comebacks
  from map_sides group by team_id)
select *, {_RATE.format(w="leads_blown", n="maps_led")} as lead_blown_rate, {_RATE.format(w="comebacks", n="maps_trailed")} as comeback_rate from n
""")
_COHORT = {"adr": "avg_adr", "kd": "avg_kd_ratio", "kast": "avg_kast", "rating": "avg_rating", "kills": "avg_kills"}
sql("better_cohort_percentiles", f"""
with b as (from mart_player_leaderboard)
select player_id, display_name, team_id, tier, {", ".join(
    f"case when {c} is not null then (select sround(count(*) filter (o.{c} < b.{c}) / nullif(count(o.{c}), 0), 6) from b o "
    f"where o.tier = b.tier - 1) end as {s}_in_better_tier" for s, c in _COHORT.items())}
from b
""")
