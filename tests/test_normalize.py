"""Normalisers on hand-made documents (golden rows in the style of the reference's tests)."""

import json

from pyspark.sql import functions as F

from clutchforge.operators import normalize as N
from clutchforge.plans import lookups, ml

HLTV_DOC = {
    "id": 9001, "matchId": 77, "map": "Mirage", "date": 1735689600000,
    "team1": {"id": 1, "name": "Alpha"}, "team2": {"id": 2, "name": "Bravo"},
    "event": {"id": 5, "name": "Cup"},
    "startSides": {"team1": "CT", "team2": "T"},
    "overtimeStartSides": [{"team1": "T", "team2": "CT"}],
    "roundHistory": [
        {"round": 1, "winner": 1, "outcome": "ct_win"},
        {"round": 2, "winner": 2, "outcome": "bomb_exploded", "score": "1-1"},
        {"round": 13, "winner": 1, "outcome": "T_WIN "},
        {"round": 25, "winner": 2, "outcome": "ct_win", "score": "5-9"},
        {"round": 26, "winner": 2, "outcome": "stopwatch"},
    ],
}


def _docs(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")


def test_round_rows(spark):
    bad = dict(HLTV_DOC, id=9002, startSides=None)
    rows = N.hltv_rounds(_docs(spark, [HLTV_DOC, bad]), "2026-01-01T00:00:00").orderBy("round_number").collect()
    assert [r.map_stats_id for r in rows] == ["9001"] * 5          # the document without sides is rejected
    r1, r2, r13, r25, r26 = rows
    assert (r1.t_team_id, r1.ct_team_id, r1.winner_side, r1.winner_team_id) == ("2", "1", "ct", "1")
    assert (r1.score_team1_after, r1.score_team2_after) == (1, 0)
    assert (r2.score_team1_after, r2.score_team2_after, r2.winner_side) == (1, 1, "t")
    assert (r13.t_team_id, r13.winner_team_id, r13.winner_side, r13.score_team1_after) == ("1", "1", "t", 2)
    assert (r25.t_team_id, r25.score_team1_after, r25.score_team2_after, r25.is_overtime) == ("1", 5, 9, True)
    assert (r26.score_team1_after, r26.score_team2_after) == (5, 10)
    assert r1.played_at == "2025-01-01" and r1.team1_name == "Alpha" and r1.winner_team_name == "Alpha"


def test_start_sides_from_first_known_round(spark):
    got = {(r.map_id, r.slice): (r.team1, r.team2) for r in N.start_sides(_docs(spark, [HLTV_DOC])).collect()}
    assert got[(9001, -1)] == ("CT", "T")
    assert got[(9001, 0)] == ("T", "CT")


def test_pipe_table(spark):
    lines = spark.createDataFrame([
        (1, "# Regional Standings<br />"), (2, "| Standing | Points | Team Name | Roster | |"),
        (3, "| :- | -: | :- | :- | :- |"),
        (4, "| 1 | 2,081 | Team Vitality | apEX, ZywOo | [details](details/0001--vitality.md) |<br />"),
        (5, "| x | 10 | No rank | a |"), (6, "  | 2. |  | Natus Vincere | b | [Details]( d.md ) |"), (7, "| short | 1 | x |"),
        (8, "| 3 | 1900 | !!! | nameless |"), (9, "|  | 4 | No first cell | c |"), (10, "|| 5 | n/a | Doubled |  ||"),
        (11, "| 6 | -3 | Minus | d | [other](e.md) |"), (12, "7 | 1 | No pipe | e"), (13, None), (14, "")],
        "line_no int, line string")
    rows = N.pipe_table_rows(lines).orderBy("line_no").collect()
    assert [(r.line_no, r.regional_rank, r.points, r.team_name, r.normalized_team_name, r.roster, r.detail_path) for r in rows] == [
        (4, 1, 2081, "Team Vitality", "vitality", "apEX, ZywOo", "details/0001--vitality.md"),
        (6, 2, None, "Natus Vincere", "natusvincere", "b", "d.md"),
        (10, 5, None, "Doubled", "doubled", None, None),
        (11, 6, -3, "Minus", "minus", "d", None)]


def test_global_rank_is_that_of_the_first_line_of_the_snapshot(spark):
    table = [("a", 9, "| 4 | 10 | Team Alpha |"), ("a", 7, "| 1,002 | | ALPHA | |"), ("a", 3, "| n/a | 5 | alpha | x |"),
             ("a", 1, "| Standing | Points | Team Name |"), ("a", 11, "| 5 | Bravo |"), ("a", 12, "| 6 | 1 | ?? |"), ("b", 1, "| 8 | 1 | Bravo |")]
    ranks = N.global_ranks(spark.createDataFrame(table, "snapshot_date string, line_no long, line string"))
    assert {(r.snapshot_date, r.normalized_team_name): r.global_rank for r in ranks.collect()} == {("a", "alpha"): 1002, ("b", "bravo"): 8}
    regional = spark.createDataFrame([("a", "alpha"), ("a", "bravo"), ("b", "bravo"), ("b", "alpha")],
                                     "snapshot_date string, normalized_team_name string")
    got = {(r.snapshot_date, r.normalized_team_name): r.global_rank for r in N.attach_global_rank(regional, ranks).collect()}
    assert got == {("a", "alpha"): 1002, ("a", "bravo"): None, ("b", "bravo"): 8, ("b", "alpha"): None}


def test_stat_cells_and_halves(spark):
    df = spark.createDataFrame([("33-32",), ("0 : 1",), ("12 (3)",), ("85.7%",), ("-",)], "c string")
    r = N.stat_cells(df, "c").collect()
    assert (r[0].pair_left, r[0].pair_right) == (33.0, 32.0)
    assert (r[1].pair_left, r[1].pair_right) == (0.0, 1.0)
    assert (r[2].main_value, r[2].paren_value) == (12.0, 3.0)
    assert r[3].percent == 85.7
    assert all(v is None for v in r[4][1:])
    h = N.half_scores(spark.createDataFrame([("(16 : 14) ( 7 : 8 ) ( 9 : 6 )",), ("(13 : 2)",)], "t string"), "t").collect()
    assert [(x.team1_rounds, x.team2_rounds) for x in h[0].halves] == [(7, 8), (9, 6)]
    assert [(x.team1_rounds, x.team2_rounds) for x in h[1].halves] == [(13, 2)]


def test_latest_complete_snapshot_needs_all_four_files(spark):
    names = ["standings_americas_2026_04_06.md", "standings_asia_2026_04_06.md", "standings_europe_2026_04_06.md",
             "standings_global_2026_04_06.md", "standings_americas_2026_05_04.md", "standings_asia_2026_05_04.md",
             "standings_global_2026_05_04.md", "standings_global_2025_12_01.md"]
    got = lookups.latest_complete_from_listing(spark.createDataFrame([(n,) for n in names], "filename string")).collect()
    assert str(got[0].snapshot_date) == "2026-04-06"


def test_threshold_respects_positive_rate_cap(spark):
    df = spark.createDataFrame([(0, 0.10), (0, 0.40), (0, 0.50), (1, 0.60)], "label int, score double")
    t = ml.threshold_search(df, max_positive_rate=0.25).collect()[0]
    assert t.threshold == 0.6 and t.positive_rate <= 0.25
    one_class = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    assert ml.threshold_search(one_class).collect()[0].threshold == 0.5


def test_auc_matches_pairwise_definition(spark):
    pts = [(1, 0.9), (0, 0.9), (1, 0.7), (0, 0.3), (0, 0.7), (1, 0.2)]
    df = spark.createDataFrame(pts, "label int, score double")
    pos = [s for y, s in pts if y == 1]
    neg = [s for y, s in pts if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(ml.roc_auc(df).collect()[0].roc_auc - brute) < 1e-12


def test_shapley_values_add_up(spark):
    from collections import defaultdict

    from clutchforge.session import configure
    from clutchforge.sources.tables import Catalog
    from .conftest import SF_CHECK
    frame = ml.split3_frame(Catalog(configure(spark), SF_CHECK)).cache()
    model = ml.fit_model(frame.where("split = 'train'"))
    test = frame.where("split = 'test'")
    own = {r.match_sk: r.upset_probability for r in ml.score_rows(model, test).collect()}
    parts = defaultdict(list)
    for r in ml.tree_attribution(model, test).collect():
        parts[r.match_sk].append(r)
    assert set(parts) == set(own) and own
    for key, rows in parts.items():
        rows.sort(key=lambda r: r.position)
        assert [r.position for r in rows] == [0, 1, 2, 3] and {r.feature for r in rows} == set(ml.FEATURE_COLUMNS)
        assert [abs(r.phi) for r in rows] == sorted((abs(r.phi) for r in rows), reverse=True)
        assert abs(rows[0].base_value + sum(r.phi for r in rows) - rows[0].margin) < 1e-9
        assert abs(rows[0].upset_probability - own[key]) < 1e-9


def test_csapi_player_stats_rules(spark):
    import json
    player = {"id": 7, "name": "x", "k": 3, "d": 0, "swing": 0.5, "adr": 80, "kast": 70, "rating": 1.1}
    both = {"id": 1, "name": "A"}

    def doc(match, blocks):
        return (json.dumps({"match": match, "stats": blocks}),)

    match = {"id": "m", "date": "2026-01-01", "team1": both, "team2": {"id": 2, "name": "B"}}
    docs = spark.createDataFrame([
        doc(match, [{"id": 4, "name": "Map", "team1": {"players": [player]}},
                    {"id": 9, "name": "aLL", "team1": {"players": [player, None]}, "team2": {"id": 3, "name": "C", "players": [
                        {**player, "id": 8, "d": 2}, {**player, "rating": None}]}}]),
        doc({**match, "id": "n"}, [{"id": 1, "name": "Map", "team1": {"players": [player]}}]),
        doc({**match, "date": None}, [{"id": 0, "team1": {"players": [player]}}]),
        doc({**match, "id": None}, [{"id": 0, "team1": {"players": [player]}}]),
        ("not json",)], "doc string")
    got = sorted((r.player_id, r.team_id, r.team_name, r.kd_ratio, r.match_id, r.matches_played)
                 for r in N.csapi_player_stats(docs).collect())
    assert got == [("7", "1", "A", None, "m", 1), ("8", "3", "C", 1.5, "m", 1)]


def test_rounds_are_judged_per_document(spark):
    import json
    good = {"id": 1, "matchId": 2, "map": "M", "date": 0, "team1": {"id": 10, "name": "a"}, "team2": {"id": 20, "name": "b"},
            "startSides": {"team1": "CT", "team2": "T"},
            "roundHistory": [{"round": 1, "winner": 1, "outcome": "ct_win"}, {"round": 0, "winner": 2, "outcome": "t_win"}]}
    bad = [{**good, "date": None}, {**good, "matchId": None}, {**good, "map": None}, {**good, "roundHistory": []},
           {**good, "roundHistory": [{"round": 1, "winner": 1, "outcome": "ct_win", "score": "x-y"}]},
           {**good, "roundHistory": [{"round": 1, "winner": 1}]},
           {**good, "roundHistory": [{"round": 1, "outcome": "t_win", "tTeam": 10}]}]
    docs = spark.createDataFrame([(json.dumps(d),) for d in [good, good, *bad]], "doc string")
    got = sorted((r.round_number, r.score_team1_after, r.score_team2_after) for r in N.hltv_rounds(docs, "t").collect())
    assert got == [(1, 1, 0), (1, 1, 0), (2, 1, 1), (2, 1, 1)]


def test_every_file_has_a_verdict(spark, tmp_path):
    from clutchforge.sources import raw_io
    files = {"ok.json": json.dumps(HLTV_DOC, indent=2), "cut.json": json.dumps(HLTV_DOC, indent=2)[:200], "nothing.json": "", "blank.json": " \n ",
             "list.json": "[1]", "word.json": "null", "text_id.json": json.dumps(dict(HLTV_DOC, id={"a": 1})),
             "no_team.json": json.dumps(dict(HLTV_DOC, team1=None)), "no_rounds.json": json.dumps(dict(HLTV_DOC, roundHistory=[])),
             "null_rounds.json": json.dumps(dict(HLTV_DOC, roundHistory=None)), "below/deeper.json": json.dumps(dict(HLTV_DOC, extra=[1])),
             "bad_round.json": json.dumps(dict(HLTV_DOC, roundHistory=[*HLTV_DOC["roundHistory"], {"round": 27, "winner": 9, "outcome": "?"}]))}
    (tmp_path / "below").mkdir()
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    docs = N.judged_maps(raw_io.whole_files(spark, str(tmp_path), "*.json"))
    got = {r.file_path.rsplit("/", 1)[1]: r.verdict for r in docs.select("file_path", "verdict").collect()}
    assert got == {"ok.json": "valid", "cut.json": "malformed", "blank.json": "malformed", "list.json": "malformed",
                   "word.json": "malformed", "text_id.json": "malformed", "no_team.json": "invalid", "no_rounds.json": "empty",
                   "null_rounds.json": "empty", "deeper.json": "valid", "bad_round.json": "invalid"}


def test_cached_matches_reject_map_by_map(spark):
    full = {"playerId": 7, "nickname": "x", "kills": 3, "headshots": 1, "rating": 1.5, "swing": None, "unknown": [1]}
    maps = [{"mapstatsId": 1, "map": "Nuke", "playerStats": {"team1": {"combined": [full, None], "t": [full]}, "team2": {"ct": [dict(full, playerId=None)]}}},
            {"mapstatsId": 2, "error": "hltv_500"}, {"mapstatsId": 3, "playerStats": "n/a"}, {"mapstatsId": 4, "playerStats": None}, None,
            {"mapstatsId": 5, "playerStats": {"team2": {"combined": [dict(full, multiKillRounds=2)]}}}]
    docs = [{"id": 9, "maps": maps, "matchAggregateStats": {"team1": [{"playerId": 7, "kills": 8, "ecoAdr": 1}], "team2": [None, {"nickname": "no id"}]}},
            {"id": 10, "maps": None}, {"id": 11, "maps": [{"mapstatsId": 6, "error": "x"}], "matchAggregateStats": None}]
    rows = N.side_players(_docs(spark, docs)).collect()
    assert len(rows[0]) == 5 + 25
    assert sorted((r.match_id, r.map_stats_id, r.team, r.side, r.player_id, r.kills, r.multi_kill_rounds, r.swing) for r in rows) == [
        ("9", "1", "team1", "combined", "7", 3.0, 0.0, None), ("9", "1", "team1", "t", "7", 3.0, 0.0, None),
        ("9", "5", "team2", "combined", "7", 3.0, 2.0, None)]
    assert [(r.match_id, r.team, r.player_id, r.kills, r.eco_adr, r.rating) for r in N.match_players(_docs(spark, docs)).collect()] == [
        ("9", "team1", "7", 8.0, 1.0, None)]


def test_liquipedia_records_by_entity(spark):
    pages = [("player", {"result": [{"pagename": "p", "id": 7, "name": None}, {"pagename": "no handle"}, None]}),
             ("match", {"result": [{"match2id": "m", "team1": "", "winner": "w", "date": None}, {"team1": "a"}]}),
             ("tournament", {"result": [{"pagename": "c", "name": "Cup", "prizepool": 1000.5, "startdate": "2024-01-02", "tier": None}, {"pagename": "x"}]}),
             ("placement", {"result": [{"pagename": "q", "tournament": "c", "place": "3-4"}, {"pagename": "r", "place": 1, "tournament": "z"}]}),
             ("team", {"result": []}), ("team", {"error": "limit"}), ("other", {"result": [{"pagename": "q", "name": "n", "id": 1, "match2id": 2}]})]
    df = spark.createDataFrame([(e, json.dumps(d)) for e, d in pages] + [("team", "no json"), ("team", None)], "entity string, doc string")
    records = N.liquipedia_records(df)
    assert records.groupBy("entity").count().count() == 4
    assert [tuple(r) for r in N.liquipedia_players(records, "now").collect()] == [("p", "liquipedia", "7", None, None, "now")]
    assert [tuple(r) for r in N.liquipedia_matches(records).collect()] == [("m", "liquipedia", "unknown", "unknown", "w", "unknown")]
    assert N.liquipedia_teams(records).count() == 0
    got = {r.page: (r.best_place, r.worst_place, r.tournament_name, r.prize_pool) for r in N.liquipedia_placements(records).collect()}
    assert got == {"q": (3, 4, "Cup", 1000.5), "r": (1, 1, None, None)}


def test_documents_are_parsed_once(spark):
    """However many filters, lambdas and columns look into a document, its JSON is parsed once."""
    docs = _docs(spark, [HLTV_DOC])
    pages = docs.withColumn("entity", F.lit("team"))
    for df in (N.hltv_rounds(docs, "2026-01-01T00:00:00"), N.csapi_player_stats(docs), N.start_sides(docs), N.faceit_matches(docs),
               N.pandascore_matches(docs), N.csapi_matches(docs), N.ranking_rows(docs), N.faceit_stat_players(docs),
               N.pandascore_players(docs), N.judged_maps(docs), N.side_players(docs), N.match_players(docs),
               N.liquipedia_teams(N.liquipedia_records(pages))):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
