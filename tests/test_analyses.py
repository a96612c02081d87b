"""All analyses over tables in the full warehouse schemas, against plain Python."""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from roundscope.operators.spearman import spearman_matrix
from roundscope.plans import analysis as an
from roundscope.schemas import WAREHOUSE

ITEMS = ["AWP", "AK-47", "M4A1-S", "MP9", "Nova", "Glock-18", "Knife"]


def _world():
    rng = random.Random(11)
    out = defaultdict(list)
    for m in range(4):
        for d in range(2):
            key, name = (f"m{m}", f"d{d}.dem"), f"map{(m + d) % 3}"
            rate = rng.choice([64.0, 128.0, None])
            out["header"].append(dict(match_id=key[0], demo_file=key[1], map_name=name, header_json="{}", tickrate=rate))
            for r in range(1, 14):
                base = dict(match_id=key[0], map_name=name, demo_file=key[1], round=r)
                start = r * 10_000
                winner = rng.choice(["ct", "CT", "t", None])
                out["rounds"].append(base | dict(winner=winner, start=start, end=start + rng.randint(1000, 6000)))
                for _ in range(rng.randint(0, 7)):
                    out["kills_slim"].append(
                        base | dict(
                            tick=start + rng.randint(0, 30) * 64, killerSide=rng.choice(["ct", "t", "t", None]), headshot=rng.choice([0, 1, None]),
                            victimSteamID=f"s{rng.randrange(10)}",
                        )
                    )
                if rng.random() < 0.5:
                    for _ in range(2):
                        out["events_bomb"].append(base | dict(event=rng.choice(["planted", "Planted", "defused"]), t_sec=rng.choice([None, 30.5, 41.0])))
                for s in range(rng.choice([10, 10, 5])):
                    items = rng.sample(ITEMS, 3)
                    out["round_loadouts"].append(
                        base | dict(steamid=f"s{s}", team="CT" if s < 5 else "T", has_helmet=rng.choice([0, 1, None]), inventory_json=json.dumps(items))
                    )
    return out


WORLD = _world()


@pytest.fixture(scope="module")
def tables(spark):
    out = {}
    for name, schema in WAREHOUSE.items():
        rows = [tuple(r.get(f.name) for f in schema.fields) for r in WORLD[name]]
        out[name] = spark.createDataFrame(rows, schema)
    return out


def _key(r):
    return r["match_id"], r["demo_file"], r["round"]


def _openings():
    """Tied first kills as (key, side)."""
    by = defaultdict(list)
    for k in WORLD["kills_slim"]:
        by[_key(k)].append(k)
    return [(key, k["killerSide"]) for key, ks in by.items() for k in ks if k["tick"] == min(x["tick"] for x in ks)]


def _winners():
    return {_key(r): (r["winner"] or "").lower() or None for r in WORLD["rounds"]}


def _cells(pairs):
    c = Counter(pairs)
    return tuple(c[x] for x in ((True, True), (True, False), (False, True), (False, False)))


def _abcd(row):
    return row.a, row.b, row.c, row.d


def _teams():
    out = {}
    for p in WORLD["round_loadouts"]:
        t = out.setdefault((*_key(p), p["team"]), dict(awp=0, rifles=0, smgs=0, heavy=0, pistols=0, helmets=0))
        for item in json.loads(p["inventory_json"]):
            t["awp"] |= item == "AWP"
            t["rifles"] += item in ("AK-47", "M4A1-S")
            t["smgs"] += item == "MP9"
            t["heavy"] += item == "Nova"
            t["pistols"] += item == "Glock-18"
        t["helmets"] += p["has_helmet"] or 0
    for t in out.values():
        t["score"] = 6 * t["awp"] + 3 * t["rifles"] + 1.5 * t["smgs"] + 1.5 * t["heavy"] + 0.5 * t["pistols"] + 0.75 * t["helmets"]
    return out


def _team(side, other=False):
    return {"ct": "T" if other else "CT", "t": "CT" if other else "T"}.get(side)


def test_openings(tables):
    winners = _winners()
    maps = {_key(r): r["map_name"] for r in WORLD["rounds"]}
    rows = [(maps[k], winners[k], s) for k, s in _openings() if s and winners[k]]
    whole = an.opening_win(tables["rounds"], tables["kills_slim"]).first()
    counts = Counter((w, s) for _, w, s in rows)
    assert _abcd(whole) == tuple(counts[x] for x in (("ct", "ct"), ("ct", "t"), ("t", "ct"), ("t", "t")))
    for r in an.opening_win_by_map(tables["rounds"], tables["kills_slim"]).collect():
        mine = Counter((w, s) for m, w, s in rows if m == r.map_name)
        assert _abcd(r) == tuple(mine[x] for x in (("ct", "ct"), ("ct", "t"), ("t", "ct"), ("t", "t")))
        assert r.p_holm >= r.p_chi2


def test_equipment(tables):
    teams = an.team_loadouts(tables["round_loadouts"])
    mine, winners, first = _teams(), _winners(), _openings()
    found = {(r.match_id, r.demo_file, r["round"], r.team): r for r in teams.collect()}
    assert {k: (r.awp, r.rifles, r.helmets, r.score) for k, r in found.items()} == {
        k: (int(t["awp"]), t["rifles"], float(t["helmets"]), t["score"]) for k, t in mine.items()
    }
    args = tables["rounds"], tables["kills_slim"], teams
    both = [(bool(mine[*k, team]["awp"]), team == _team(s)) for k, s in first for team in ("CT", "T") if (*k, team) in mine]
    assert _abcd(an.category_opening(*args).first()) == _cells(both)
    won = [(bool(mine[*k, _team(s)]["awp"]) if (*k, _team(s)) in mine else True, s is not None and winners[k] == s) for k, s in first]
    assert _abcd(an.category_conversion(*args).first()) == _cells(won)
    contrast = []
    for k, s in first:
        a, b = mine.get((*k, _team(s))), mine.get((*k, _team(s, True)))
        if a and b and a["score"] != b["score"]:
            contrast.append((a["score"] < b["score"], winners[k] == s))
    assert _abcd(an.underdog_conversion(*args).first()) == _cells(contrast)


def test_helmets(tables):
    helmet = {(*_key(p), p["steamid"]): p["has_helmet"] or 0 for p in WORLD["round_loadouts"]}
    pairs = [(helmet[*_key(k), k["victimSteamID"]] == 0, not k["headshot"]) for k in WORLD["kills_slim"] if (*_key(k), k["victimSteamID"]) in helmet]
    load = tables["round_loadouts"].withColumnRenamed("steamid", "victimSteamID")
    keys = ["match_id", "demo_file", "round", "victimSteamID"]
    assert _abcd(an.flag_test(tables["kills_slim"], load, keys, "has_helmet", "headshot").first()) == _cells(pairs)


def _rates():
    return {(h["match_id"], h["demo_file"]): h["tickrate"] for h in WORLD["header"]}


def test_durations(tables):
    planted = {_key(b) for b in WORLD["events_bomb"] if b["event"].lower() == "planted"}
    rates, maps = _rates(), {(h["match_id"], h["demo_file"]): h["map_name"] for h in WORLD["header"]}
    samples = defaultdict(list)
    for r in WORLD["rounds"]:
        rate = rates[r["match_id"], r["demo_file"]]
        if rate:
            samples[_key(r) in planted].append((r["end"] - r["start"]) / rate)
            samples[maps[r["match_id"], r["demo_file"]], _key(r) in planted].append((r["end"] - r["start"]) / rate)
    plain = an.round_durations(tables["rounds"], tables["header"], tables["events_bomb"])
    one = an.duration_test(plain).first()
    assert (one.n1, one.n0) == (len(samples[True]), len(samples[False]))
    assert one.median_diff == pytest.approx(np.median(samples[True]) - np.median(samples[False]))
    both = {r.planted: r for r in an.duration_summary(plain).collect()}
    assert both["yes"].std == pytest.approx(np.std(samples[True], ddof=1)) and both["no"].q3 == pytest.approx(np.percentile(samples[False], 75))
    mapped = an.round_durations(tables["rounds"], tables["header"], tables["events_bomb"], extra=["map_name"])
    for r in an.duration_by(mapped).collect():
        assert r.median_1 == pytest.approx(np.median(samples[r.map_name, True]))


def test_sides(tables):
    w = Counter(x for x in _winners().values() if x)
    one = an.side_rate(tables["rounds"]).first()
    assert (one.n, one.t_wins, one.ct_wins) == (w["t"] + w["ct"], w["t"], w["ct"])
    by = an.side_rate(an.with_map(tables["rounds"], tables["header"]), ["map_name"])
    assert sum(r.n for r in by.collect()) == one.n


def test_times(tables):
    first = {}
    for k in WORLD["kills_slim"]:
        first[_key(k)] = min(k["tick"], first.get(_key(k), k["tick"]))
    rates = _rates()
    seconds = [(t - k[2] * 10_000) / (rates[k[:2]] or 64.0) for k, t in first.items()]
    found = an.opening_seconds(tables["rounds"], tables["kills_slim"], tables["header"])
    timing = an.opening_timing(found).first()
    assert timing.n == len(seconds)
    assert [timing.q1, timing.median, timing.q3] == pytest.approx(list(np.percentile(seconds, [25, 50, 75])))
    counts, edges = np.histogram(seconds, bins=20)
    hist = sorted((r.bin, r.bin_lo, r.n) for r in an.timing_histogram(found).collect())
    assert [h[2] for h in hist] == list(counts) and [h[1] for h in hist] == pytest.approx(list(edges[:-1]))
    curve = sorted((r["T"], r.ret_rate) for r in an.trade_curve(an.trade_delays(tables["kills_slim"], tables["header"])).collect())
    assert len(curve) == 12 and all(0 <= a[1] <= b[1] <= 1 for a, b in zip(curve, curve[1:]))


def test_features(tables):
    teams = an.team_loadouts(tables["round_loadouts"])
    out = an.round_features(tables["rounds"], tables["kills_slim"], tables["header"], tables["events_bomb"], teams)
    rows = out.collect()
    assert len(rows) == len({_key(k) for k in WORLD["kills_slim"]})
    mine = _teams()
    for r in rows:
        key = (r.match_id, r.demo_file, r["round"])
        a, b = mine.get((*key, _team(r.side0))), mine.get((*key, _team(r.side0, True)))
        assert r.score_open == (a and a["score"]) and r.d_score == (a["score"] - b["score"] if a and b else None)
        assert r.trade_3s <= r.trade_5s <= r.trade_10s
        assert r.plant == float(r.time_to_plant_s is not None)
    matrix = {(r.f1, r.f2): r.rho for r in spearman_matrix(out, an.FEATURES).collect()}
    assert len(matrix) == 17 * 17 and all(v is None or abs(v) <= 1 + 1e-12 for v in matrix.values())
