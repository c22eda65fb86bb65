"""

The shapes differ from the Spark plans on purpose: name lookups are one long table read
through maps, statistics are unpivoted to (stat, value) rows and pivoted back, the two
sides of a round come from a list of structs, and every grain is one aggregate with
filters.
"""

from __future__ import annotations

from .standins import cte

STATS = {"adr": "adr", "kd_ratio": "kd", "kast": "kast", "rating": "rating"}  # column, short name


def normalised(x: str) -> str:
    return rf"regexp_replace(lower(regexp_replace(trim({x}), '^team[\s_-]+', '', 'i')), '[^a-z0-9]+', '', 'g')"


def tier(rank: str) -> str:
    """1 to 10, 11 to 30, 31 to 50, and everything else."""
    return f"case when {rank} between 1 and 10 then 1 when {rank} between 11 and 30 then 2 when {rank} between 31 and 50 then 3 else 4 end"


# ------------------------------------------------------------------ teams
cte("newest_regions", """
from raw_valve_team_regions
where snapshot_date is not null and normalized_team_name is not null and region is not null
qualify dense_rank() over (order by snapshot_date desc) = 1
""")

cte("region_hints", f"""
select 'unique' as kind, {normalised('name')} as name_key, any_value(region) as region
from raw_liquipedia_teams where team_id is not null and name is not null and region is not null
group by all having count(*) = 1
union all
select kind, name_key, any_value(region) from (
  select unnest(['exact', 'normalized']) as kind, unnest([lower(team_name), normalized_team_name]) as name_key, region
  from newest_regions)
where name_key is not null group by kind, name_key having len(list(distinct region)) = 1
""")

cte("hint_maps", """
select max(m) filter (where kind = 'unique') as by_unique, max(m) filter (where kind = 'exact') as by_exact,
       max(m) filter (where kind = 'normalized') as by_normalized
from (select kind, map_from_entries(list(struct_pack(k := name_key, v := region))) as m from region_hints group by kind)
""")

cte("ranked_teams", f"""
select team_id, name as team_name,
  list_filter([if(lower(region) = 'global', null, region), by_unique[{normalised('name')}], by_exact[lower(name)],
               by_normalized[{normalised('name')}]], lambda r: r is not null)[1] as region,
  world_ranking, ranking_date as last_updated, 'csapi' as ranking_source, 2 as ranking_source_priority
from stg_csapi_team_rankings, hint_maps
""")

cte("dim_teams", """
select unnest(best) from (
  select first(t order by p, last_updated desc nulls first, world_ranking asc nulls last, team_name desc nulls last,
               region desc nulls last) as best
  from (
    select 2 as p, last_updated, world_ranking, team_name, region, team_id,
      struct_pack(team_id, team_name, region, world_ranking, ranking_source, last_updated) as t from ranked_teams
    union all
    select 1, ingested_at, world_ranking, name, region, team_id,
      struct_pack(team_id := team_id, team_name := name, region := region, world_ranking := world_ranking,
                  ranking_source := 'liquipedia', last_updated := ingested_at)
    from raw_liquipedia_teams where team_id is not null
  ) group by team_id)
""")

# ------------------------------------------------------------------ players
cte("stat_rows", f"""
select s.player_id, s.display_name, k.team_id, t.team_name, t.region as team_region,
  try_cast(s.recorded_at as date) as recorded_at, s.adr, s.kd_ratio, s.kast, s.rating, s.kills,
  {tier('t.world_ranking')} as player_tier, t.world_ranking
from fact_player_stats s
left join dim_players p using (player_id)
cross join lateral (select coalesce(p.team_id, s.team_id) as team_id) k
left join dim_teams t on t.team_id = k.team_id
""")

_WHO = "player_id, display_name, team_id, team_name, team_region, world_ranking, player_tier"

cte("board", f"""
select s.player_id, s.display_name, coalesce(p.team_id, s.team_id) as team_id, count(*) as matches_played,
  sround(xavg(adr), 2) as avg_adr, sround(xavg(kd_ratio), 3) as avg_kd_ratio, sround(xavg(kast), 2) as avg_kast,
  sround(xavg(rating), 3) as avg_rating, sround(xavg(kills), 1) as avg_kills, sround(xavg(deaths), 1) as avg_deaths,
  max(elo) as peak_elo
from fact_player_stats s left join dim_players p using (player_id) group by all
""")

cte("mart_player_leaderboard", f"""
with b as (select board.*, t.world_ranking, {tier('t.world_ranking')} as tier
           from board left join dim_teams t using (team_id))
select *, {", ".join(
    f"(rank() over (partition by tier order by avg_{c} asc nulls last) - 1) / greatest(count(*) over (partition by tier) - 1, 1)"
    f" as {s}_pct_rank" for c, s in [("adr", "adr"), ("kd_ratio", "kd"), ("kast", "kast"), ("rating", "rating"),
                                     ("kills", "kills")])}
from b
""")

cte("profiles", f"""
select {_WHO}, count(*) as matches_played, xavg(adr) as avg_adr, xavg(kd_ratio) as avg_kd_ratio, xavg(kast) as avg_kast,
  xavg(rating) as avg_rating, xavg(kills) as avg_kills
from stat_rows group by all
""")

cte("tier_bars", f"""
select player_tier, {", ".join(f"max(bar) filter (where stat = 'avg_{c}') as {s}_threshold" for c, s in STATS.items())}
from (select player_tier, stat, quantile_cont(v, 0.85) as bar
      from (unpivot (select * from profiles) on avg_adr, avg_kd_ratio, avg_kast, avg_rating into name stat value v)
      group by all)
group by player_tier
""")

cte("form_windows", f"""
with dated as (select player_id, adr, kd_ratio, kast, rating,
    max(recorded_at) over (partition by player_id) - recorded_at as age from stat_rows),
w as (select *, case when age <= 89 then 'recent' when age <= 179 then 'previous' end as span from dated),
f as (select player_id, span, count(*) as maps, {", ".join(f"xavg({c}) as {c}" for c in STATS)} from w group by all)
select player_id, {", ".join(
    f"coalesce(max(maps) filter (where span = '{w}'), 0)::bigint as {w}_90_day_maps_played" for w in ("recent", "previous"))},
  {", ".join(f"max({c}) filter (where span = '{w}') as {w}_90_day_{c}" for w in ("recent", "previous") for c in STATS)}
from f group by player_id
""")

_ABOVE = "[" + ", ".join(f"avg_{c} >= {s}_threshold" for c, s in STATS.items()) + "]"


def _gap(w: str) -> str:
    """Mean relative distance to the bars of the tier above, over the stats that have one."""
    gaps = ", ".join(f"{w}_90_day_{c} / nullif({s}_threshold, 0) - 1" for c, s in STATS.items())
    return f"list_sum(list_filter([{gaps}], lambda g: g is not null)) / len(list_filter([{gaps}], lambda g: g is not null))"


cte("gem_candidates", f"""
with c as (select p.*, b.* exclude (player_tier), f.* exclude (player_id),
    len(list_filter({_ABOVE}, lambda x: coalesce(x, false)))::int as stats_above_tier_threshold
  from profiles p left join tier_bars b on b.player_tier + 1 = p.player_tier
  left join form_windows f on f.player_id = p.player_id
  where p.player_tier between 2 and 4)
select *, round(25 * stats_above_tier_threshold + least(matches_played, 50) / 10.0, 2) as prospect_score,
  {_gap('recent')} as recent_90_day_gap_to_tier_above, {_gap('previous')} as previous_90_day_gap_to_tier_above
from c
""")

_DIGITS = {"adr": 2, "kd_ratio": 3, "kast": 2, "rating": 3}
_FORM = ", ".join(f"round({w}_90_day_{c}, {d}) as {w}_90_day_{c}" for w in ("recent", "previous") for c, d in _DIGITS.items())

cte("mart_hidden_gems", f"""
with g as (select *, recent_90_day_gap_to_tier_above as now, previous_90_day_gap_to_tier_above as earlier
           from gem_candidates where stats_above_tier_threshold >= 3)
select {_WHO}, player_tier - 1 as comparison_tier, matches_played,
  {", ".join(f"round(avg_{c}, {d}) as avg_{c}" for c, d in _DIGITS.items())}, round(avg_kills, 1) as avg_kills,
  {", ".join(f"round({s}_threshold, {_DIGITS[c]}) as tier_above_{s}_threshold" for c, s in STATS.items())},
  stats_above_tier_threshold, prospect_score, recent_90_day_maps_played, previous_90_day_maps_played,
  20 as minimum_recent_90_day_maps, recent_90_day_maps_played >= 20 as meets_recent_sample_size, {_FORM},
  round(now, 4) as recent_90_day_gap_to_tier_above, round(earlier, 4) as previous_90_day_gap_to_tier_above,
  round(now - earlier, 4) as gap_delta_to_tier_above,
  case when now is null or earlier is null then 'insufficient_history' when now > earlier then 'gap_growing'
       when now < earlier then 'gap_shrinking' else 'gap_flat' end as trend_direction,
  true as is_hidden_gem
from g
""")

# ------------------------------------------------------------------ rounds
cte("round_sides", """
select map_stats_id, match_id, map_name, played_at, round_number, winner_team_id, is_overtime, side.*,
  (winner_team_id = side.team_id)::int as won_round,
  side.own_score_after - (winner_team_id = side.team_id)::int as own_score_before,
  side.opp_score_after - (winner_team_id <> side.team_id)::int as opp_score_before
from (select *, unnest([
    struct_pack(team_id := team1_id, team_name := team1_name, opponent_id := team2_id, opponent_name := team2_name,
                own_score_after := score_team1_after, opp_score_after := score_team2_after),
    struct_pack(team_id := team2_id, team_name := team2_name, opponent_id := team1_id, opponent_name := team1_name,
                own_score_after := score_team2_after, opp_score_after := score_team1_after)]) as side
  from stg_hltv_round_history)
""")

cte("map_sides", """
select map_stats_id, team_id, max(match_id) as match_id, max(map_name) as map_name, max(played_at) as played_at,
  max(team_name) as team_name, max(opponent_id) as opponent_id, max(opponent_name) as opponent_name,
  max(own_score_after) as final_own_score, max(opp_score_after) as final_opp_score, max(round_number) as total_rounds,
  coalesce(bool_or(is_overtime), false)::int as is_overtime_map,
  max(greatest(own_score_before - opp_score_before, own_score_after - opp_score_after))
    filter (where own_score_before - opp_score_before + own_score_after - opp_score_after is not null) as largest_lead,
  max(own_score_after) filter (where round_number = 12) as halftime_own_score,
  max(opp_score_after) filter (where round_number = 12) as halftime_opp_score
from round_sides group by all
""")

cte("map_sides_flagged", """
with d as (select *, coalesce(sign(final_own_score - final_opp_score), 0) as result,
    coalesce(sign(halftime_own_score - halftime_opp_score), 0) as half, coalesce(largest_lead >= 5, false) as led
  from map_sides)
select * exclude (result, half, led), (result = 1)::int as won_map, (result = -1)::int as lost_map,
  coalesce(abs(final_own_score - final_opp_score) <= 2, false)::int as is_close_map, led::int as had_5plus_lead,
  (led and result = -1)::int as lead_blown_5plus, (half = 1)::int as had_halftime_lead,
  (half = 1 and result = -1)::int as halftime_lead_lost, (half = -1 and result = 1)::int as halftime_comeback_win
from d
""")

_COUNTS = {"wins": "won_map = 1", "losses": "lost_map = 1", "maps_with_5plus_lead": "had_5plus_lead = 1",
           "leads_blown": "lead_blown_5plus = 1", "halftime_leads_lost": "halftime_lead_lost = 1",
           "halftime_comeback_wins": "halftime_comeback_win = 1", "ot_matches": "is_overtime_map = 1",
           "ot_wins": "is_overtime_map = 1 and won_map = 1", "ot_losses": "is_overtime_map = 1 and lost_map = 1",
           "close_maps": "is_close_map = 1", "close_map_wins": "is_close_map = 1 and won_map = 1"}
# rate: counted, out of, name of the league's
_RATES = {"lead_blown_rate": ("leads_blown", "maps_with_5plus_lead", "league_lead_blown_rate"),
          "comeback_rate": ("halftime_comeback_wins", "wins", "league_halftime_comeback_rate"),
          "ot_win_rate": ("ot_wins", "ot_matches", "league_ot_win_rate"),
          "close_map_win_rate": ("close_map_wins", "close_maps", "league_close_map_win_rate")}

cte("pressure", f"""
with n as (select team_id, max(team_name) as team_name, count(*) as total_maps, sum(total_rounds)::bigint as rounds_analyzed,
    max(largest_lead) as largest_lead, {", ".join(f"count(*) filter (where {w}) as {c}" for c, w in _COUNTS.items())}
  from map_sides_flagged group by team_id)
select *, {", ".join(f"round({a}::double / nullif({b}, 0), 4) as {r}" for r, (a, b, _) in _RATES.items())} from n
""")

cte("league", f"""
select {", ".join(f"round(sum({a})::double / nullif(sum({b}), 0), 4) as {name}" for a, b, name in _RATES.values())}
from pressure
""")

cte("mart_choke_profile", """
select p.* exclude (team_name, halftime_comeback_wins), coalesce(t.team_name, p.team_name) as team_name, t.world_ranking,
  total_maps as maps_analyzed, total_maps as total_scored_matches, halftime_comeback_wins as comebacks,
  comeback_rate as halftime_comeback_rate, ot_matches as overtime_maps_analyzed, close_maps as close_maps_analyzed,
  ifnull(lead_blown_rate, 0) as lead_blown_rate_display, ifnull(comeback_rate, 0) as halftime_comeback_rate_display,
  ifnull(ot_win_rate, 0) as ot_win_rate_display, ifnull(close_map_win_rate, 0) as close_map_win_rate_display,
  lead_blown_rate - league_lead_blown_rate as lead_blown_rate_delta,
  comeback_rate - league_halftime_comeback_rate as halftime_comeback_rate_delta,
  ot_win_rate - league_ot_win_rate as ot_win_rate_delta,
  close_map_win_rate - league_close_map_win_rate as close_map_win_rate_delta,
  'round_history_exact' as comeback_metric_type, 'hltv_unofficial' as metric_source, 50 as minimum_stable_maps,
  case when total_maps >= 50 then 'stable' when total_maps >= 20 then 'directional' else 'limited' end as sample_quality,
  total_maps < 20 as sample_size_warning, true as halftime_data_available, true as round_history_available,
  false as clutch_data_available, false as bracket_data_available, null::double as elimination_win_pct,
  null::double as winners_bracket_win_pct
from pressure p left join dim_teams t on t.team_id = p.team_id cross join league
""")
