"""Work dealt by game: bounded partitions, hot games apart, against plain Python."""

import random

from dimstack.operators.graph import player_partner_totals
from dimstack.operators.patterns import grouping_sets_games
from dimstack.plans.inspect import plan_text
from dimstack.plans.spread import partitions_for, split_hot

DETAILS = ("game_id long, team_id long, team_abbreviation string, player_id long, player_name string, pts double, "
           "line_no long")


def details(spark, n=400, seed=5):
    """Rows with a game that holds a third of them, equal names, missing values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = rng.randrange(30)
        team = p % 4
        rows.append((rng.choice([1, rng.randrange(2, 60), rng.randrange(2, 60)]), team, None if team == 3 else f"T{team}", p,
                     None if p == 29 else f"n{p // 2}", rng.choice([None, 1.0, 2.0, 7.0]), i))
    rows += [(None, 1, "T1", 1, "n0", 1.0, n)]
    return rows, spark.createDataFrame(rows, DETAILS)


def games(spark, seed=5):
    rng = random.Random(seed)
    rows = [(g, None if g % 7 == 0 else 2000 + g % 3, g % 4, (g + 1) % 4, rng.randrange(2)) for g in range(1, 60) if g % 9]
    rows += rows[:3]
    return rows, spark.createDataFrame(rows, "game_id long, season int, home_team_id long, visitor_team_id long, home_team_wins int")


def test_partitions_follow_the_rows(spark):
    df = spark.range(1000)
    assert [partitions_for(df, k) for k in (10_000, 300, 100)] == [1, 4, 11]


def test_hot_keys_apart(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 2 + [(None,)] * 9, "k int")
    light, heavy = split_hot(df, "k", 3)
    assert [r.k for r in light.collect()] == [2, 2] and [r.k for r in heavy.collect()] == [1] * 5
    light, heavy = split_hot(df, "k", 5)
    assert light.count() == 7 and heavy is None


def test_partner_totals_with_and_without_hot_games(spark):
    _, df = details(spark)

    def run(hot):
        out = player_partner_totals(df, order_cols=["line_no"], hot=hot)
        return out, sorted(map(str, out.select("player_id", "player_name", "edge_type", "partner_games", "own_points",
                                               "partner_points").collect()))
    by_window, plain = run(10_000)
    # one shuffle by game serves all roster levels
    assert "Join" not in plan_text(by_window, "simple")
    assert plain == run(10)[1] == run(0)[1] != []


def test_game_sets_with_and_without_hot_games(spark):
    rows, df = details(spark)
    grows, gdf = games(spark)
    want = {}
    for gid, season, home, visitor, wins in grows:
        for r in rows:
            if r[0] == gid:
                won = (r[1] == home and wins == 1) or (r[1] == visitor and wins == 0)
                name, team, s = r[4] or "(overall)", r[2] or "(overall)", "(overall)" if season is None else str(season)
                for key in (("player__team", name, team, "(overall)"), ("player__season", name, "(overall)", s),
                            ("team", "(overall)", team, "(overall)")):
                    pts, seen, of = want.setdefault(key, [[], set(), set()])
                    pts += [] if r[5] is None else [r[5]]
                    seen.add(gid)
                    of |= {gid} if won else set()
    want = sorted((*k, sum(p) if p else None, len(n), len(w)) for k, (p, n, w) in want.items())
    for hot in (10_000, 10, 0):
        out = grouping_sets_games(df, gdf, hot=hot)
        got = [tuple(r) for r in out.select("aggregation_level", "player_name", "team", "season", "total_pts", "n_games",
                                            "games_won").collect()]
        assert sorted(got, key=str) == sorted(want, key=str), hot
    # no row is expanded per set before it is grouped with its game
    text = plan_text(grouping_sets_games(df, gdf), "simple")
    assert text.index("Expand") < text.index("Window")
