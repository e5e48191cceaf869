"""Longest-prefix locations, strongest partners and visitor bitmaps against
plain Python."""

import datetime as dt
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from dimstack.operators import locate as lo
from dimstack.operators import partners as pa
from dimstack.operators import visitors as vi


def test_ipv4_number(spark):
    texts = ["0.0.0.0", "255.255.255.255", "1.2.3.4", "1.2.3", "1.2.3.4.5", "256.1.1.1", "a.b.c.d", "1.2.3.-4", "", None,
             " 1.2.3.4", "01.2.3.4"]
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    got = [r.n for r in df.select(lo.ipv4_number(F.col("ip")).alias("n")).collect()]
    assert got == [0, 2 ** 32 - 1, 16909060, *[None] * 8, 16909060]


@pytest.fixture(scope="module")
def nets():
    rng = random.Random(1)
    rows = [(rng.getrandbits(32), rng.choice([1, 4, 8, 12, 13, 16, 24, 32]), f"c{i}", None if i % 7 == 0 else f"s{i}", f"t{i}")
            for i in range(400)]
    # nested in each other, twice the same, none at all
    rows += [(0x0A000000, 8, "ten", "x", "x"), (0x0A010000, 16, "ten one", "x", "x"), (0x0A0100FF, 16, "also ten one", "x", "x"),
             (0x0A010203, 32, "host", "x", "x"), (None, 8, "no", "x", "x"), (1, 33, "no", "x", "x"), (1, -1, "no", "x", "x")]
    return rows


def test_locate_against_all_networks(spark, nets):
    rng = random.Random(2)
    ips = [str(ipaddress.ip_address(rng.getrandbits(32))) for _ in range(300)]
    ips += ["10.1.2.3", "10.1.9.9", "10.9.9.9", "no ip", None, "10.1.2.3"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ips)], "id int, ip string, geo string")
    table = spark.createDataFrame(nets, "network long, prefix_len int, country string, state string, city string")
    got = {r.id: r.geodata for r in lo.locate(df, table).collect()}

    def slow(ip):
        try:
            n = int(ipaddress.ip_address(ip))
        except ValueError:
            return "{}"
        hits = [(length, (c, s or "", t)) for base, length, c, s, t in nets
                if base is not None and 0 <= length <= 32 and base >> (32 - length) == n >> (32 - length)]
        longest = max((h[0] for h in hits), default=None)
        if longest is None:
            return "{}"
        c, s, t = min(v for length, v in hits if length == longest)
        return f'{{"country":"{c}","state":"{s}","city":"{t}"}}'
    assert len(got) == len(ips)
    assert got == {i: slow(t or "") for i, t in enumerate(ips)}


def test_locate_without_networks(spark):
    df = spark.createDataFrame([("1.2.3.4",)], "ip string")
    none = spark.createDataFrame([], "network long, prefix_len int, country string, state string, city string")
    assert [r.geodata for r in lo.locate(df, none).collect()] == ["{}"]
    assert lo.locate(df.limit(0), none).collect() == []


def details(spark, rows):
    return spark.createDataFrame([(p, g, x, i) for i, (p, g, x) in enumerate(rows)],
                                 "player_id long, game_id long, pts long, line_no int")


def slow_partners(rows, bound):
    first = {}
    for p, g, x in rows:
        if p is not None and g is not None:
            first.setdefault((p, g), x or 0)
    games = {}
    for (p, g), x in first.items():
        games.setdefault(p, {})[g] = x
    out = []
    for a in games:
        for b in games:
            shared = games[a].keys() & games[b].keys()
            if a != b and len(shared) >= bound:
                out.append((a, b, len(shared), sum(games[a][g] for g in shared), sum(games[b][g] for g in shared)))
    return sorted(out)


@pytest.mark.parametrize("bound", [2, 5])
def test_partners_against_all_pairs(spark, bound):
    rng = random.Random(bound)
    rows = [(p, g, rng.choice([None, 1, 2, 30])) for p in range(25) for g in rng.sample(range(40), rng.randint(0, 14))]
    rows += [(p, 1000 + k, 5) for p in range(25) for k in range(3)] + rows[:20] + [(None, 1, 1), (1, None, 1)]
    got = pa.strongest_partners(details(spark, rows), min_shared=bound)
    assert sorted(map(tuple, got.collect())) == slow_partners(rows, bound)


def test_crowded_games_form_no_pairs(spark):
    """300 players of the same two games and of one rare pair of them: with a
    bound of three only that pair meets."""
    rows = [(p, g, 1) for p in range(300) for g in (1, 2)] + [(p, 100 + p, 1) for p in range(300)]
    rows += [(7, 500, 1), (8, 500, 1)]
    df = details(spark, rows)
    crowded = pa.crowded_games(df.select("player_id", "game_id", "pts"), 2)
    assert {r.game_id for r in crowded.collect()} == {1, 2}
    assert sorted(map(tuple, pa.strongest_partners(df, min_shared=3).collect())) == [(7, 8, 3, 3, 3), (8, 7, 3, 3, 3)]
    with pytest.raises(ValueError):
        pa.strongest_partners(df, min_shared=1)


def test_visitors_of_any_span(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.randrange(50), rng.randrange(200_000)]),
             start + dt.timedelta(minutes=rng.randrange(60 * 24 * 45))) for _ in range(800)]
    rows += [("a", None, start), ("a", 1, None)]
    daily = vi.daily_visitors(spark.createDataFrame(rows, "host string, user_id long, event_time timestamp_ntz"), ["host"])
    first = {"day": lambda d: d, "week": lambda d: d - dt.timedelta(days=d.weekday()), "month": lambda d: d.replace(day=1)}
    for span, to in first.items():
        want = {}
        for host, user, ts in rows:
            if user is not None and ts is not None:
                want.setdefault((host, to(ts.date())), set()).add(user)
        got = {(r.host, r.first_day): r.n_visitors for r in vi.visitors_by(daily, ["host"], span).collect()}
        assert got == {k: len(v) for k, v in want.items()}
    week = {u for h, u, ts in rows if h == "a" and u is not None and ts is not None and dt.date(2024, 1, 3) <= ts.date() <= dt.date(2024, 1, 9)}
    got = {r.host: r.n_visitors for r in vi.visitors_between(daily, ["host"], "2024-01-03", "2024-01-09").collect()}
    assert got["a"] == len(week)


@pytest.mark.parametrize("small", [2, 6, 32])
def test_small_games_are_paired_crowded_ones_looked_up(spark, small):
    rng = random.Random(small)
    rows = [(p, g, rng.choice([None, 1, 2, 30])) for p in range(25) for g in rng.sample(range(40), rng.randint(0, 14))]
    rows += [(p, 1000 + k, 5) for p in range(25) for k in range(3)]
    df = details(spark, rows)
    got = pa.strongest_partners(df, min_shared=4, small=small)
    assert sorted(map(tuple, got.collect())) == slow_partners(rows, 4)


def test_games_of_few_players_need_no_lookup(spark, monkeypatch):
    monkeypatch.setattr(pa, "crowded_games", None)
    rows = [(p, g, 1) for p in range(10) for g in range(12)]
    got = pa.strongest_partners(details(spark, rows), min_shared=6)
    assert sorted(map(tuple, got.collect())) == slow_partners(rows, 6) != []
