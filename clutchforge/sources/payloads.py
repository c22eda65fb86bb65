"""Provider documents (JSON text) built from the raw tables.

The reference ingests JSON documents from several providers and normalises
them record by record. Here the documents are produced from the raw tables
with ``to_json`` (one document per match / map / snapshot), so the normalisers
in ``operators.normalize`` run as Spark jobs over a column of JSON text, the
shape a file or stream source would deliver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.normalize import HLTV_MAP as MAP_DOCUMENT
from . import raw_io
from . import standins as raw
from .tables import Catalog

# Of the maps of these pools a second, malformed document arrives (under the negative id); the
# normaliser must reject it and keep the other one.
WITHOUT_SIDES, WITH_BAD_SCORE, WITHOUT_DATE = "Map6", "Map4", "Map3"


def faceit_match_docs(cat: Catalog) -> DataFrame:
    m = raw.raw_matches(cat, "faceit")
    both = F.col("score_a").isNotNull() & F.col("score_b").isNotNull()
    doc = F.struct(
        F.col("match_id").alias("match_id"), F.lit("cs2").alias("game"), F.lit("EU").alias("region"),
        F.concat(F.lit("Cup "), F.col("map_name")).alias("competition_name"),
        F.struct(F.struct(F.col("team_a_id").alias("faction_id")).alias("faction1"),
                 F.struct(F.col("team_b_id").alias("faction_id")).alias("faction2")).alias("teams"),
        F.struct(F.when(F.col("winner_id") == F.col("team_a_id"), F.lit("faction1"))
                 .when(F.col("winner_id") == F.col("team_b_id"), F.lit("faction2")).alias("winner"),
                 F.when(both, F.struct(F.col("score_a").cast("int").alias("faction1"),
                                       F.col("score_b").cast("int").alias("faction2"))).alias("score")).alias("results"),
        F.unix_timestamp(F.to_timestamp("played_at")).alias("finished_at"),
        F.col("map_name").alias("map"),
    )
    return m.select(F.lit("faceit").alias("source"), F.lit("match").alias("entity"), F.to_json(doc).alias("doc"))


def pandascore_match_docs(cat: Catalog) -> DataFrame:
    m = raw.raw_matches(cat, "pandascore")
    opp = lambda c: F.struct(F.struct(F.col(c).cast("long").alias("id"),
                                      F.concat(F.lit("Team "), F.col(c)).alias("name")).alias("opponent"))
    doc = F.struct(
        F.col("match_id").cast("long").alias("id"), F.concat(F.col("team_a_id"), F.lit(" vs "), F.col("team_b_id")).alias("name"),
        F.lit("finished").alias("status"),
        F.concat(F.col("played_at"), F.lit("T12:00:00Z")).alias("begin_at"),
        F.when(F.col("winner_id").isNotNull(), F.struct(F.col("winner_id").cast("long").alias("id"),
                                                        F.concat(F.lit("Team "), F.col("winner_id")).alias("name")))
        .alias("winner"),
        F.array(opp("team_a_id"), opp("team_b_id")).alias("opponents"),
        F.array(F.struct(F.col("score_a").cast("int").alias("score")),
                F.struct(F.col("score_b").cast("int").alias("score"))).alias("results"),
        F.col("map_name").alias("map"),
    )
    return m.select(F.lit("pandascore").alias("source"), F.lit("match").alias("entity"), F.to_json(doc).alias("doc"))


PAGE_TEAMS = 500


def ranking_snapshot_docs(cat: Catalog) -> DataFrame:
    """One document per ranking date with the list of teams.

    A provider page lists a bounded stretch of the ranking, so a document holds
    the teams of one date and page (``PAGE_TEAMS`` ranks or points), however many teams there are.
    """
    r = raw.raw_csapi_team_rankings(cat)
    team = F.struct(F.col("world_ranking").alias("rank"), F.col("vrs_points").alias("points"),
                    F.col("name").alias("name"), F.col("team_id").alias("id"), F.col("region").alias("region"))
    page = F.floor(F.coalesce(F.col("world_ranking"), F.col("team_id").cast("bigint")) / PAGE_TEAMS)
    per_date = r.groupBy("ranking_date", F.col("world_ranking").isNull().alias("unranked"), page.alias("page")) \
        .agg(F.collect_list(team).alias("teams"))
    doc = F.struct(F.col("ranking_date").alias("date"),
                   F.concat(F.lit("/ranking/"), F.col("ranking_date")).alias("url"), F.col("teams"))
    return per_date.select(F.lit("csapi").alias("source"), F.lit("ranking").alias("entity"),
                           F.to_json(doc).alias("doc"))


def faceit_stats_docs(cat: Catalog) -> DataFrame:
    """Per-match stats documents: rounds[] -> teams[] -> players[] (stat values are text)."""
    p = raw.raw_player_rows(cat).where((F.col("source") == "faceit") & F.col("match_id").isNotNull())
    player = F.struct(F.col("player_id").alias("player_id"), F.col("display_name").alias("nickname"),
                      F.col("nationality").alias("country"), F.col("elo").cast("int").alias("faceit_elo"),
                      F.create_map(F.lit("Kills"), F.col("kills").cast("string"),
                                   F.lit("Deaths"), F.col("deaths").cast("string")).alias("player_stats"))
    per_team = p.groupBy("match_id", "team_id").agg(F.collect_list(player).alias("players"))
    per_match = per_team.groupBy("match_id").agg(
        F.collect_list(F.struct(F.col("team_id").alias("team_id"), F.col("players"))).alias("teams"))
    doc = F.struct(F.col("match_id").alias("match_id"), F.array(F.struct(F.col("teams"))).alias("rounds"))
    return per_match.select(F.lit("faceit").alias("source"), F.lit("match_stats").alias("entity"),
                            F.to_json(doc).alias("doc"))


def hltv_map_docs(cat: Catalog, malformed: bool = True) -> DataFrame:
    """One map document per map: teams, event, start sides, overtime start
    sides and the round list (winner 1/2, outcome, reported score); with
    ``malformed``, a bad second document for the maps of three pools.

    A map holds at most a few dozen rounds, so collecting its rounds into one
    document is bounded by the game, not by the data size.
    """
    r = raw.raw_hltv_round_history(cat)
    t1_ct = F.col("ct_team_id") == F.col("team1_id")
    sides = F.struct(F.when(t1_ct, F.lit("CT")).otherwise(F.lit("T")).alias("team1"),
                     F.when(t1_ct, F.lit("T")).otherwise(F.lit("CT")).alias("team2"))
    rnd = F.struct(F.col("round_number").cast("int").alias("round"),
                   F.when(F.col("winner_team_id") == F.col("team1_id"), F.lit(1)).otherwise(F.lit(2)).alias("winner"),
                   F.col("round_outcome").alias("outcome"), F.col("reported_score").alias("score"),
                   F.col("is_overtime").alias("isOvertime"))
    ot_start = (F.col("round_number") > 24) & (((F.col("round_number") - 25) % 3) == 0)
    g = r.groupBy("map_stats_id").agg(
        F.max("match_id").alias("match_id"), F.max("map_name").alias("map_name"),
        F.min("played_at").alias("played_at"),
        F.max("team1_id").alias("team1_id"), F.max("team1_name").alias("team1_name"),
        F.max("team2_id").alias("team2_id"), F.max("team2_name").alias("team2_name"),
        F.max("event_id").alias("event_id"), F.max("event_name").alias("event_name"),
        F.min_by(sides, F.col("round_number")).alias("start_sides"),
        F.sort_array(F.collect_list(F.when(ot_start, F.struct(F.col("round_number").alias("r"), sides.alias("s")))))
        .alias("ot"),
        F.sort_array(F.collect_list(rnd)).alias("rounds"))
    copies = F.array(F.lit(False), F.lit(True)) if malformed else F.array(F.lit(False))
    pools = F.col("map_name").isin(WITHOUT_SIDES, WITH_BAD_SCORE, WITHOUT_DATE)
    g = g.select("*", F.explode(F.when(pools, copies).otherwise(F.array(F.lit(False)))).alias("bad"))
    is_bad = lambda pool: F.col("bad") & (F.col("map_name") == pool)
    num = lambda c: F.regexp_extract(F.col(c), r"(\d+)$", 1).cast("long")
    # numeric provider ids from the "user-n" keys: user * 1000 + n
    nid = lambda c: (F.split(F.col(c), "-").getItem(0).cast("long") * 1000
                     + F.split(F.col(c), "-").getItem(1).cast("long"))
    doc = F.struct(
        F.when(F.col("bad"), -nid("map_stats_id")).otherwise(nid("map_stats_id")).alias("id"),
        nid("match_id").alias("matchId"),
        F.col("map_name").alias("map"),
        F.when(~is_bad(WITHOUT_DATE), F.unix_timestamp(F.to_timestamp("played_at")) * 1000).alias("date"),
        F.struct(F.col("team1_id").cast("long").alias("id"), F.col("team1_name").alias("name")).alias("team1"),
        F.struct(F.col("team2_id").cast("long").alias("id"), F.col("team2_name").alias("name")).alias("team2"),
        F.struct(num("event_id").alias("id"), F.col("event_name").alias("name")).alias("event"),
        F.when(~is_bad(WITHOUT_SIDES), F.col("start_sides")).alias("startSides"),
        F.transform("ot", lambda x: x["s"]).alias("overtimeStartSides"),
        F.when(is_bad(WITH_BAD_SCORE), F.transform("rounds", lambda x: x.withField("score", F.lit("x-y"))))
        .otherwise(F.col("rounds")).alias("roundHistory"),
    )
    return g.select(F.lit("hltv").alias("source"), F.lit("mapstats").alias("entity"),
                    F.col("event_id").alias("batch_id"), F.to_json(doc).alias("doc"))


TABLE_HEAD = ("| Standing | Points | Team Name | Roster | |", "| :-- | --: | :-- | :-- | :-- |")


def _standing_line(rank: F.Column, points: F.Column, name: F.Column, key: F.Column, roster: F.Column, detail: F.Column) -> F.Column:
    """A standings row as it is published: points with thousands separators or missing, line ends as markup."""
    points = F.when(key % 6 == 0, F.lit("")).otherwise(F.format_number(points, 0))
    return F.concat(F.lit("| "), rank, F.lit(" | "), points, F.lit(" | "), name, F.lit(" | "), roster, F.lit(" |"),
                    F.when(key % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(" [details]("), detail, F.lit(") |"))),
                    F.when(key % 2 == 1, F.lit("<br />")).otherwise(F.lit("")))


def _heads(of: DataFrame, title: F.Column) -> DataFrame:
    """The lines around the rows of each document: headings, table head, a row that is too short and a nameless one."""
    lines = [(-4, F.concat(F.lit("### "), title, F.lit("<br />"))), (-3, F.lit("<br />")), (-2, F.lit(TABLE_HEAD[0])),
             (-1, F.lit(TABLE_HEAD[1])), (1_000_000, F.lit("| broken |")), (1_000_001, F.lit("| 7 | 1,000 | !!! | nobody | |"))]
    rows = F.explode(F.array(*[F.struct(F.lit(n).cast("bigint").alias("line_no"), line.alias("line")) for n, line in lines]))
    return of.distinct().select("*", rows.alias("h")).select(*of.columns, "h.line_no", "h.line")


def standings_lines(cat: Catalog) -> DataFrame:
    """Markdown standings of every region and valve snapshot, one row per line."""
    v = raw.raw_valve_team_regions(cat)
    key = F.col("regional_rank")
    rank = F.concat(key.cast("string"), F.when(key % 8 == 3, F.lit(".")).otherwise(F.lit("")))
    roster = F.when(key % 4 == 0, F.lit("one, two")).otherwise(F.lit(""))
    body = v.select("snapshot_date", "region", key.alias("line_no"),
                    _standing_line(rank, F.col("points"), F.col("team_name"), key, roster, F.col("detail_path")).alias("line"))
    title = F.concat(F.lit("Regional Standings for "), F.col("region"), F.lit(" as of "), F.col("snapshot_date"))
    return body.unionByName(_heads(v.select("snapshot_date", "region"), title))


def global_standings_lines(cat: Catalog) -> DataFrame:
    """Markdown standings of all teams of every valve snapshot, by world rank. Some teams are not
    ranked, some aren't listed, and of some a second line comes further down under another spelling."""
    r = raw.raw_csapi_team_rankings(cat).select(F.col("team_id").cast("bigint").alias("key"), "ranking_date", "world_ranking")
    v = raw.raw_valve_team_regions(cat).select(F.col("regional_rank").alias("key"), F.col("snapshot_date").alias("ranking_date"),
                                               "team_name", "points", "detail_path").distinct()
    t = v.join(r, ["key", "ranking_date"]).where("world_ranking is not null")
    again = F.when(F.col("key") % 11 == 0, F.array(F.lit(0), F.lit(100_000))).otherwise(F.array(F.lit(0)))
    t = t.select("*", F.explode(again).alias("later"))
    rank = F.when(F.col("key") % 13 == 4, F.lit("n/a")).otherwise(F.format_number(F.col("world_ranking") + F.col("later"), 0))
    name = F.when(F.col("later") > 0, F.lower("team_name")).otherwise(F.col("team_name"))
    # Equal ranks keep the order of their keys.
    line_no = (F.col("world_ranking") + F.col("later")) * 1_000_000 + F.col("key")
    body = t.select(F.col("ranking_date").alias("snapshot_date"), line_no.alias("line_no"),
                    _standing_line(rank, F.col("points"), name, F.col("key"), F.lit(""), F.col("detail_path")).alias("line"))
    title = F.concat(F.lit("Standings as of "), F.col("snapshot_date"))
    return body.unionByName(_heads(body.select("snapshot_date"), title))


def csapi_match_docs(cat: Catalog) -> DataFrame:
    """CS API series documents: teams with score and rank, maps, format text, winner."""
    m = raw.raw_matches(cat, "csapi")
    team = lambda side: F.struct(
        F.col(f"team_{side}_id").cast("long").alias("id"),
        F.concat(F.lit("Team "), F.col(f"team_{side}_id")).alias("name"),
        F.col(f"score_{side}").cast("int").alias("score"),
        F.col(f"team_{side}_ranking").cast("int").alias("rank"))
    doc = F.struct(
        F.col("match_id").cast("long").alias("id"), team("a").alias("team1"), team("b").alias("team2"),
        F.array(F.struct(F.col("map_name").alias("name"))).alias("maps"),
        F.when(F.col("score_a") + F.col("score_b") > 30, F.lit("Best of 3")).alias("format"),
        F.col("played_at").alias("date"), F.lit("Major").alias("event"),
        F.when(F.col("winner_id").isNotNull(), F.struct(F.col("winner_id").cast("long").alias("id"))).alias("winner"))
    return m.select(F.lit("csapi").alias("source"), F.lit("match").alias("entity"), F.to_json(doc).alias("doc"))


def write_document_files(cat: Catalog, folder: str) -> None:
    """Map documents as exported: one (pretty-printed, so multi-line) JSON document per file, named after it. Beside sound and invalid documents there are files cut off in the middle, blank ones, ones that hold
    no document and documents without rounds."""
    d = hltv_map_docs(cat).select(F.get_json_object("doc", "$.id").cast("long").alias("id"), F.get_json_object("doc", "$.map").alias("map"),
                                  F.to_json(F.from_json("doc", MAP_DOCUMENT), {"pretty": "true"}).alias("text"))
    other = lambda kind, when, text: F.when(when, F.struct(F.concat(F.lit(f"{kind}-"), F.col("id").cast("string")).alias("document"),
                                                          text.alias("text")))
    sound = F.col("id") >= 0  # the second documents of some maps have negative ids
    files = F.array_compact(F.array(
        F.struct(F.concat(F.lit("map-"), F.col("id").cast("string")).alias("document"), F.col("text").alias("text")),
        other("cut", sound & (F.col("map") == "Map5"), F.expr("substring(text, 1, length(text) div 2)")),
        other("blank", sound & (F.col("map") == "Map2"), F.lit("  ")),
        other("list", sound & (F.col("map") == "Map1"), F.lit("[1, 2]")),
        other("bare", sound & (F.col("map") == "Map0"), F.concat(
            F.lit('{"id": 1, "matchId": 2, "map": "m", "date": 3,\n "team1": {"id": 4}, "team2": {"id": 5}, "roundHistory": []}')))))
    raw_io.write_whole_files(d.select(F.explode(files).alias("f")).select("f.*"), folder, "document", "text")


def pandascore_player_docs(cat: Catalog) -> DataFrame:
    """PandaScore player objects; profile rows arrive without a current team."""
    p = raw.raw_player_rows(cat).where(F.col("source") == "pandascore")
    doc = F.struct(F.col("player_id").cast("long").alias("id"), F.col("display_name").alias("name"),
                   F.col("nationality").alias("nationality"),
                   F.when(F.col("team_id").isNotNull(), F.struct(F.col("team_id").cast("long").alias("id"),
                                                                 F.concat(F.lit("Team "), F.col("team_id")).alias("name")))
                   .alias("current_team"),
                   F.col("match_id").alias("match_id"), F.col("recorded_at").alias("recorded_at"))
    return p.select(F.lit("pandascore").alias("source"), F.lit("player").alias("entity"), F.to_json(doc).alias("doc"))


def liquipedia_team_docs(cat: Catalog) -> DataFrame:
    """Liquipedia API pages: ``{"result": [...]}`` with string fields only."""
    t = raw.raw_liquipedia_teams(cat)
    item = F.struct(F.col("team_id").alias("pagename"), F.col("name").alias("name"), F.col("region").alias("region"),
                    F.col("ingested_at").alias("date"))
    return t.select(F.lit("liquipedia").alias("source"), F.lit("team").alias("entity"),
                    F.to_json(F.struct(F.array(item).alias("result"))).alias("doc"))


def _page(entity: str, *records: F.Column) -> list[F.Column]:
    """A Liquipedia page of records (structs of any fields), as JSON text."""
    texts = F.array_join(F.array_compact(F.array(*[F.to_json(r) for r in records])), ",")
    return [F.lit("liquipedia").alias("source"), F.lit(entity).alias("entity"), F.concat(F.lit('{"result":['), texts, F.lit("]}")).alias("doc")]


def liquipedia_docs(cat: Catalog) -> DataFrame:
    """Liquipedia pages of all five entities. Numbers arrive as numbers or text, fields may be absent or empty,
    and some pages have a record that lacks what its entity requires."""
    key = F.col("player_id").cast("long")
    p = raw.raw_player_rows(cat).where(F.col("match_id").isNull())
    players = p.select(*_page("player", F.struct(
        F.concat(F.lit("lp_player_"), F.col("player_id")).alias("pagename"), F.col("display_name").alias("id"), F.lit(7).alias("extra"),
        F.when(key % 3 == 0, F.concat(F.lit("lp_"), (key % 50).cast("string"))).alias("teampagename"),
        F.when(key % 4 == 0, F.lit("Nowhere")).alias("nationality")),
        F.when(key % 9 == 0, F.struct(F.concat(F.lit("no_handle_"), F.col("player_id")).alias("pagename")))))
    m, number = raw.raw_matches(cat, "csapi"), F.col("match_id").cast("long")
    team = lambda c: F.concat(F.lit("lp_"), F.col(c))
    matches = m.select(*_page("match", F.struct(
        number.alias("match2id"), F.when(number % 9 == 0, F.lit("")).otherwise(team("team_a_id")).alias("team1"),
        F.when(number % 8 != 0, team("team_b_id")).alias("team2"), team("winner_id").alias("winner"),
        F.when(number % 10 != 0, F.col("played_at")).alias("date"), F.col("map_name").alias("tournament")),
        F.when(number % 7 == 0, F.struct(F.lit("a").alias("team1"), F.lit("b").alias("team2")))))
    o = cat.table("orders").groupBy(F.trunc("o_orderdate", "month").cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(28,2)")).alias("total"))
    cup, even = F.date_format("month", "'cup_'yyyy_MM"), F.month("month") % 2 == 0
    tournaments = o.select(*_page("tournament", F.struct(
        cup.alias("pagename"), F.concat(F.lit("Cup of "), F.date_format("month", "yyyy-MM")).alias("name"),
        F.date_format("month", "yyyy-MM-dd").alias("startdate"), F.when(even, F.date_format(F.last_day("month"), "yyyy-MM-dd")).alias("enddate"),
        F.when(even, F.col("total").cast("long")).alias("prizepool"), F.when(F.col("n") % 2 == 0, F.lit("S")).otherwise(F.lit("A")).alias("tier")),
        F.when(even, F.struct(F.lit("nameless").alias("pagename")))))
    li = cat.table("lineitem").groupBy(F.trunc("l_shipdate", "month").cast("date").alias("month"), "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    place = F.when(n <= 2, n.cast("string")).when(n <= 4, F.lit("3-4")).when(n <= 8, F.lit(" 5 - 8 ")).otherwise(F.lit("DNF"))
    placements = li.select(*_page("placement", F.struct(
        F.concat(F.lit("place_"), cup, F.lit("_"), F.col("l_suppkey").cast("string")).alias("pagename"),
        F.when(F.col("l_suppkey") % 6 != 0, cup).alias("tournament"), place.alias("place"),
        F.concat(F.lit("lp_"), F.col("l_suppkey").cast("string")).alias("team"))))
    parts = [liquipedia_team_docs(cat), players, matches, tournaments, placements]
    return reduce(DataFrame.unionByName, parts)


def cached_match_docs(cat: Catalog) -> DataFrame:
    """Cached match documents: player statistics per map, team and side, and over the match. A document has two maps; the
    second of every third was not loaded (an error instead of statistics), that of every eleventh has text in their place."""
    r = raw.raw_csapi_player_stats(cat).select(
        F.col("match_id").cast("long").alias("id"), F.col("player_id").cast("long").alias("player"), "display_name",
        F.col("team_id").cast("long").alias("team"), F.col("kills").cast("long").alias("k"), F.col("deaths").cast("long").alias("d"),
        "adr", "kast", "rating")

    def on_map(p: F.Column, kills: F.Column) -> F.Column:
        k, d, player = p["k"], p["d"], p["player"]
        return F.struct(
            player.alias("playerId"), p["display_name"].alias("nickname"), F.when(player % 4 != 0, F.lit("Nowhere")).alias("country"),
            (k % 7).alias("openingKills"), (d % 5).alias("openingDeaths"), ((k % 7) / 2).alias("ecoOpeningKills"),
            ((d % 5) / 2).alias("ecoOpeningDeaths"), F.when(k % 2 == 1, k % 3).alias("multiKillRounds"), p["kast"].alias("kast"),
            (p["kast"] / 2).alias("ecoKast"), F.when(d % 2 == 0, k % 4).alias("clutchesWon"), kills.alias("kills"),
            F.floor(kills / 3).alias("headshots"), (kills / 4).alias("ecoKills"), F.lit(None).cast("long").alias("ecoHeadshots"),
            (k % 6).alias("assists"), (k % 2).alias("flashAssists"), d.alias("deaths"), F.floor(d / 4).alias("tradedDeaths"),
            (d / 2).alias("ecoDeaths"), F.lit(0).alias("ecoTradedDeaths"), p["adr"].alias("adr"), (p["adr"] / 2).alias("ecoAdr"),
            F.lit(1.5).alias("swing"), p["rating"].alias("rating"))

    def over_match(p: F.Column) -> F.Column:
        k, d, player = p["k"], p["d"], p["player"]
        return F.struct(
            F.when(player % 13 != 0, player).alias("playerId"), p["display_name"].alias("nickname"), F.lit("Nowhere").alias("country"),
            (2 * k).alias("kills"), (2 * d).alias("deaths"), (k / 2).alias("ecoKills"), (d / 2).alias("ecoDeaths"), F.lit(-0.5).alias("swing"),
            p["adr"].alias("adr"), (p["adr"] / 2).alias("ecoAdr"), p["kast"].alias("kast"), (p["kast"] / 2).alias("ecoKast"),
            p["rating"].alias("rating"))

    half = lambda p: F.floor(p["k"] / 2)
    values = (("combined", lambda p: on_map(p, p["k"])), ("t", lambda p: on_map(p, half(p))),
              ("ct", lambda p: on_map(p, p["k"] - half(p))), ("match", over_match))
    # Line items of one order: a handful. A row is gathered once; what a document says of it is made behind the shuffle.
    rows = r.groupBy("id").agg(F.collect_list(F.struct(*[c for c in r.columns if c != "id"])).alias("rows"))
    first = F.filter("rows", lambda p: p["team"] % 2 == 0)
    others = F.filter("rows", lambda p: p["team"] % 2 != 0)
    g = rows.select("id", *[F.transform(of, value).alias(f"{name}_{side}") for name, of in (("team1", first), ("team2", others)) for side, value in values])
    sides = lambda team: F.struct(F.col(f"{team}_combined").alias("combined"),
                                  F.when(F.col("id") % 2 == 0, F.col(f"{team}_t")).alias("t"), F.col(f"{team}_ct").alias("ct"))
    head = lambda n: [(F.col("id") * 10 + n).alias("mapstatsId")]
    stats = F.struct(sides("team1").alias("team1"), sides("team2").alias("team2")).alias("playerStats")
    whole = lambda n: F.to_json(F.struct(*head(n), F.lit(f"Map{n}").alias("map"), stats))
    second = F.when(F.col("id") % 3 == 0, F.to_json(F.struct(*head(2), F.lit("hltv_500").alias("error")))) \
        .when(F.col("id") % 11 == 0, F.to_json(F.struct(*head(2), F.lit("n/a").alias("playerStats")))).otherwise(whole(2))
    doc = F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit(',"maps":['), whole(1), F.lit(","), second, F.lit('],"matchAggregateStats":'),
                   F.to_json(F.struct(F.col("team1_match").alias("team1"), F.col("team2_match").alias("team2"))), F.lit("}"))
    return g.select(F.lit("hltv").alias("source"), F.lit("match").alias("entity"), doc.alias("doc"))


def csapi_stats_docs(cat: Catalog) -> DataFrame:
    """Statistics documents of matches, one per match and team of the raw player rows. The wanted
    block goes by id or by name, and some blocks leave the team to the match. Every document
    also has a block of a single map, and of every seventh match a second document comes without a date."""
    p = raw.raw_csapi_player_stats(cat)
    player = F.struct(F.col("player_id").cast("bigint").alias("id"), F.col("display_name").alias("name"),
                      F.col("kills").alias("k"), F.col("deaths").alias("d"), F.lit(0.0).alias("swing"), "adr", "kast", "rating")
    # Line items of one order, supplier and day: a handful.
    per = p.groupBy("match_id", "team_id", "team_name", "recorded_at").agg(F.collect_list(player).alias("players"))
    key = F.col("match_id").cast("bigint")
    team = F.struct(F.col("team_id").cast("bigint").alias("id"), F.col("team_name").alias("name"))
    in_block = F.struct(F.when(key % 3 != 0, F.col("team_id").cast("bigint")).alias("id"),
                        F.when(key % 3 != 0, F.col("team_name")).otherwise(F.lit("")).alias("name"), "players")
    none = F.struct(F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("name"),
                    F.array().cast("array<struct<id:bigint,name:string,k:double,d:double,swing:double,adr:double,"
                                   "kast:double,rating:double>>").alias("players"))
    first = key % 2 == 0

    def block(id_, name):
        return F.struct(id_.alias("id"), name.alias("name"), F.when(first, in_block).otherwise(none).alias("team1"),
                        F.when(first, none).otherwise(in_block).alias("team2"))

    blocks = F.array(block(F.lit(5).cast("bigint"), F.lit("Map 1")),
                     block(F.when(key % 5 != 0, F.lit(0).cast("bigint")).otherwise(F.lit(9)),
                           F.when(key % 5 == 0, F.lit("ALL")).otherwise(F.lit("total"))))
    per = per.select("*", F.explode(F.when(key % 7 == 0, F.array(F.lit(True), F.lit(False)))
                                    .otherwise(F.array(F.lit(True)))).alias("dated"))
    match = F.struct(F.col("match_id").alias("id"), F.when(F.col("dated"), F.col("recorded_at")).alias("date"),
                     F.when(first, team).alias("team1"), F.when(~first, team).alias("team2"))
    doc = F.struct(match.alias("match"), blocks.alias("stats"))
    return per.select(F.lit("csapi").alias("source"), F.lit("match_stats").alias("entity"), F.to_json(doc).alias("doc"))
