"""Normals, percentiles, drought, phases and cyclones against plain Python."""

import datetime as dt
import math
import random
from collections import defaultdict
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridclim.functions import special
from gridclim.operators import climate, cyclones


def gamma_p(a, x):
    if x <= 0:
        return 0.0
    term = total = 1 / a
    k = 1
    while term > 1e-18 * total or k < x - a:
        term *= x / (a + k)
        total, k = total + term, k + 1
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def test_special_functions(spark):
    rows = [(a, x, p) for a in (0.05, 0.3, 1.0, 2.5, 17.0, 300.0) for x in (0.0, 1e-6, 0.5, 3.0, 20.0, 290.0, 310.0, 2000.0) for p in (1e-12, 1e-5, 0.01, 0.3, 0.5, 0.75, 0.999, 1 - 1e-9)]
    c = F.col
    df = spark.createDataFrame(rows, "a double, x double, p double")
    for r in df.select("a", "x", "p", special.log_gamma(c("a")).alias("l"), special.gamma_p(c("a"), c("x")).alias("g"), special.normal_quantile(c("p")).alias("z")).collect():
        assert r.l == pytest.approx(math.lgamma(r.a), rel=1e-12, abs=1e-12) and r.g == pytest.approx(gamma_p(r.a, r.x), abs=1e-10) and r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-15)
    out = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double").select(special.normal_quantile(c("p")).alias("z")).collect()
    assert [r.z for r in out] == [None] * 3


@pytest.mark.parametrize("buckets", [2, 16, 1024])
def test_percentiles_of_a_hot_group(spark, buckets):
    rng = random.Random(3)
    groups = {"hot": [rng.gauss(0, 1) for _ in range(4000)], "ties": [rng.choice([1.0, 2.0, 7.0]) for _ in range(999)], "one": [5.0], None: [3.0, -1.0], "signs": [-0.5, 0.0, 0.5, math.inf]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("one", None), ("one", math.nan), ("none", None)]
    rng.shuffle(rows)
    probabilities = [0.0, 1 / 3, 0.5, 0.9, 1.0]
    got = climate.grouped_percentiles(spark.createDataFrame(rows, "k string, x double"), ["k"], "x", probabilities, buckets).collect()
    assert len(got) == 5 * len(groups)
    for r in got:
        assert r.n == len(groups[r.k])
        if r.k != "signs" or r.probability <= 0.5:  # beyond, numpy makes inf - inf
            assert r.percentile == pytest.approx(np.quantile(groups[r.k], r.probability), abs=1e-12)


def test_percentiles_of_nothing(spark):
    none = spark.createDataFrame([], "k string, x double")
    assert climate.grouped_percentiles(none, ["k"], "x", [0.5]).count() == 0


def test_pentads_of_common_and_leap_years(spark):
    days = [dt.date(y, 1, 1) + dt.timedelta(k) for y in (1900, 2000, 2023, 2024) for k in range(366)]
    got = {r.d: r.p for r in spark.createDataFrame([(d,) for d in days], "d date").select("d", climate.pentad("d").alias("p")).collect()}
    for d, p in got.items():
        plain = dt.date(2023, d.month, 28 if (d.month, d.day) == (2, 29) else d.day).timetuple().tm_yday
        assert p == (12 if (d.month, d.day) == (2, 29) else (plain - 1) // 5 + 1)
    assert {got[d] for d in days} == set(range(1, 74))


def test_normals_count_the_years_that_are_there(spark):
    rows = [("a", dt.date(y, 2, d), 1.0 * y, float(d + y % 5)) for y in range(1990, 2003) for d in (1, 28)] + [("a", dt.date(1992, 2, 29), 0.0, 50.0), ("b", dt.date(1995, 2, 3), 9.0, None)]
    df = spark.createDataFrame(rows, "cell string, date date, tmax double, precip double")
    got = {r.cell: r for r in climate.normals(df, ["cell"], 1991, 2000, "month", ("tmax",), ("precip",)).collect()}
    sums = [29 + 2 * (y % 5) + (50 if y == 1992 else 0) for y in range(1991, 2001)]
    a, b = got["a"], got["b"]
    assert (a.n_years, a.bin, a.period, a.scale) == (10, 2, "1991-2000", "month") and a.precip_mean == np.mean(sums) and a.precip_sd == pytest.approx(np.std(sums, ddof=1))
    assert a.precip_p33 == pytest.approx(np.quantile(sums, 1 / 3)) and a.precip_p67 == pytest.approx(np.quantile(sums, 2 / 3))
    assert (b.n_years, b.tmax_mean, b.precip_mean, b.precip_p33) == (1, 9.0, None, None)
    leap = climate.normals(df.where("date = DATE'1992-02-29'"), ["cell"], 1991, 2000, "pentad", ("tmax",), ("precip",)).first()
    assert leap.bin == 12 and leap.precip_sd is None
    with pytest.raises(ValueError, match="unknown scale"):
        climate.normals(df, ["cell"], 1991, 2000, "week")


def brute_spi(series, scales, baseline):
    """month -> value of one cell; (month, scale) -> (total, spi)."""
    out = {}
    for s in scales:
        sums = {m: sum(series[m - k] for k in range(s)) for m in series if all(series.get(m - k) is not None for k in range(s))}
        for m, total in sums.items():
            own = [x for n, x in sums.items() if n % 12 == m % 12 and baseline[0] * 12 <= n < baseline[1] * 12 + 12]
            wet = [x for x in own if x > 0]
            spi = None
            if len(set(wet)) > 1:
                mean = sum(wet) / len(wet)
                gap = math.log(mean) - sum(map(math.log, wet)) / len(wet)
                alpha = (1 + math.sqrt(1 + 4 * gap / 3)) / (4 * gap)
                dry = 1 - len(wet) / len(own)
                p = dry + (1 - dry) * gamma_p(alpha, total * alpha / mean)
                spi = NormalDist().inv_cdf(p) if 0 < p < 1 else None
            out[m, s] = (total, spi)
    return out


def test_drought_index(spark):
    rng = random.Random(7)
    cells = {"wet": {m: round(rng.gammavariate(2, 30), 1) for m in range(2000 * 12, 2012 * 12)}, "dry": {m: rng.choice([0.0, 0.0, 5.0, 9.5, 20.0]) for m in range(2000 * 12, 2012 * 12)}, "same": {m: 4.0 for m in range(2000 * 12, 2004 * 12)}, None: {m: float(m % 7 + 1) for m in range(2000 * 12, 2008 * 12)}}
    del cells["wet"][2003 * 12 + 5]
    cells["wet"][2005 * 12 + 1] = None
    rows = [(c, m, v) for c, s in cells.items() for m, v in s.items()]
    df = spark.createDataFrame(rows, "cell string, month int, precip double")
    got = defaultdict(dict)
    for r in climate.drought_index(df, ["cell"], baseline=(2001, 2009)).collect():
        got[r.cell][r.month, r.scale] = (r.total, r.spi)
    for c, s in cells.items():
        want = brute_spi(s, climate.SCALES, (2001, 2009))
        assert got[c].keys() == want.keys()
        for k, (total, spi) in want.items():
            assert got[c][k][0] == pytest.approx(total) and (got[c][k][1] == pytest.approx(spi, abs=1e-7) if spi is not None else got[c][k][1] is None)
    assert not any(z for _, z in got["same"].values() if z is not None)


def test_alerts_by_share(spark):
    m = 2020 * 12 + 2
    index = spark.createDataFrame([("a", m, 3, -2.0), ("b", m, 3, 0.0), ("c", m, 3, None), ("d", m, 3, -1.0)], "cell string, month int, scale int, spi double")
    shares = spark.createDataFrame([("a", 1, 3.0), ("b", 1, 1.0), ("c", 1, 5.0), ("b", 2, 1.0), ("d", 3, 0.5), ("x", 4, 1.0)], "cell string, admin_id int, share double")
    got = {r.admin_id: (r.as_of, r.spi, r.n_cells, r.status) for r in climate.drought_alerts(index, shares, ["cell"]).collect()}
    day = dt.date(2020, 3, 1)
    assert got == {1: (day, -1.5, 2, "red"), 2: (day, 0.0, 1, "green"), 3: (day, -1.0, 1, "yellow")}
    edge = spark.createDataFrame([(x,) for x in (-1.5, -1.49, -1.0, -0.99, -0.5, -0.49, None)], "x double").select(climate.alert_status(F.col("x")).alias("s")).collect()
    assert [r.s for r in edge] == ["red", "yellow", "yellow", "watch", "watch", "green", None]


def brute_phases(series, threshold, least):
    sign = {t: 0 if v is None else 1 if v >= threshold else -1 if v <= -threshold else 0 for t, v in series.items()}
    out, run = {}, []
    for t in [*sorted(series), None]:
        if run and (t is None or t != run[-1] + 1 or sign[t] != sign[run[-1]]):
            held = sign[run[-1]] != 0 and len(run) >= least
            out |= {x: (sign[x] if held else 0, len(run) if held else 0) for x in run}
            run = []
        if t is not None:
            run.append(t)
    return out


@pytest.mark.parametrize("block", [3, 64])
def test_phases_equal_a_plain_loop(spark, block):
    rng = random.Random(1)
    names = {}
    for name in ("a", "b", None):
        value, series = 0.0, {}
        for t in range(-40, 300):
            value = 0.8 * value + rng.gauss(0, 0.6)
            if rng.random() > 0.05:
                series[t] = None if rng.random() < 0.05 else round(value, 2)
        names[name] = series
    names["long"] = {t: 0.5 for t in range(500)}
    names["short"] = {t: -0.5 for t in range(4)} | {t: -0.5 for t in range(5, 10)}
    rows = [(n, t, v) for n, s in names.items() for t, v in s.items()]
    got = defaultdict(dict)
    for r in climate.sustained_phases(spark.createDataFrame(rows, "name string, month int, value double"), ["name"], block=block).collect():
        got[r.name][r.month] = (r.phase, r.length)
    assert got == {n: brute_phases(s, 0.5, 5) for n, s in names.items()}
    assert {v for v in got["short"].values()} == {(0, 0), (-1, 5)} and set(got["long"].values()) == {(1, 500)}


def test_seasonal_anomaly(spark):
    series = {2000 * 12 + k: float(k % 12 + k // 12 * 3 + (k == 20)) for k in range(48) if k != 30}
    got = {r.month: r.value for r in climate.seasonal_anomaly(spark.createDataFrame([("x", m, v) for m, v in series.items()], "name string, month int, value double"), ["name"]).collect()}
    usual = {c: np.mean([v for m, v in series.items() if m % 12 == c]) for c in range(12)}
    off = {m: v - usual[m % 12] for m, v in series.items()}
    assert got == {m: pytest.approx(np.mean([off[m + k] for k in (-1, 0, 1)])) for m in off if m - 1 in off and m + 1 in off}


# Cyclones


def vector(lat, lon):
    a, b = math.radians(lat), math.radians(lon)
    return np.array([math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)])


def brute_distance(a, b, p):
    """Least distance over many points of the arc, then refined between its neighbours."""
    a, b, p = vector(*a), vector(*b), vector(*p)
    length = math.atan2(np.linalg.norm(np.cross(a, b)), a @ b)

    def at(t):
        x = np.tile(a, (len(t), 1)) if length < 1e-12 else (np.sin((1 - t) * length)[:, None] * a + np.sin(t * length)[:, None] * b) / math.sin(length)
        return np.arctan2(np.linalg.norm(np.cross(x, p), axis=1), x @ p)

    low, high = 0.0, 1.0
    for _ in range(24):
        steps = np.linspace(low, high, 9)
        k = int(np.argmin(at(steps)))
        low, high = steps[max(0, k - 1)], steps[min(8, k + 1)]
    return cyclones.EARTH_KM * float(at(np.array([(low + high) / 2]))[0])


TRACKS = {
    "line": [(10.0, -70.0), (12.0, -75.0), (15.0, -80.0)],
    "seam": [(-17.0, 178.0), (-18.0, 179.5), (-19.0, -178.5)],
    "pole": [(88.0, 10.0), (89.5, 100.0), (88.5, -150.0)],
    "south": [(-89.9, 0.0), (-89.0, 179.0)],
    "still": [(40.0, 20.0)],
    "twice": [(40.0, 20.0), (40.0, 20.0)],
    "far": [(0.0, 0.0), (5.0, 40.0)],
}


def test_exposure_equals_all_pairs(spark):
    start = dt.datetime(2020, 9, 1, 6)
    rows = [(s, start + dt.timedelta(days=20 * k), lat, lon, 30.0 + 40 * k, False) for s, points in TRACKS.items() for k, (lat, lon) in enumerate(points)]
    rows += [("line", start + dt.timedelta(days=90), 16.0, -90.0, 200.0, True), ("none", None, 1.0, 1.0, 1.0, False), ("none", start, None, 1.0, 1.0, None)]
    rng = random.Random(5)
    cells = {f"c{k}": (rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(300)}
    for s, points in TRACKS.items():
        for k in range(60):
            lat, lon = rng.choice(points)
            cells[f"{s}{k}"] = (max(-90.0, min(90.0, lat + rng.gauss(0, 3))), (lon + rng.gauss(0, 3) * (8 if abs(lat) > 80 else 1) + 540) % 360 - 180)
    cells |= {"north pole": (90.0, 0.0), "south pole": (-90.0, 77.0), "seam": (-18.5, 180.0), "seam2": (-18.5, -180.0)}
    tracks = spark.createDataFrame(rows, "storm_id string, obs_time timestamp, lat double, lon double, wind_kt double, is_forecast boolean")
    where = spark.createDataFrame([(c, *p) for c, p in cells.items()] + [("nowhere", None, None)], "cell string, lat double, lon double")
    found = cyclones.exposure(tracks, where, 300.0, ["cell"])
    assert not any(x in found._jdf.queryExecution().executedPlan().toString() for x in ("Cartesian", "NestedLoop"))
    got = {(r.storm_id, r.cell): r for r in found.collect()}
    want = {}
    for s, points in TRACKS.items():
        legs = list(zip(points, points[1:], strict=False)) or [(points[0], points[0])]
        for c, p in cells.items():
            near = [(brute_distance(a, b, p), k) for k, (a, b) in enumerate(legs)]
            inside = [k for km, k in near if km <= 300]
            if inside:
                last = max(inside) + (len(points) > 1)
                want[s, c] = (min(km for km, _ in near), 30.0 + 40 * last, (start + dt.timedelta(days=20 * min(inside))).date(), (start + dt.timedelta(days=20 * last)).date())
    assert got.keys() == want.keys() and len(want) > 150 and ("pole", "north pole") in want and ("seam", "seam2") in want
    for k, (km, wind, first, last) in want.items():
        r = got[k]
        assert r.closest_approach_km == pytest.approx(km, abs=1e-4) and (r.max_wind_kt, r.exposure_start, r.exposure_end) == (wind, first, last)


def test_forecast_positions_count_only_if_asked(spark):
    start = dt.datetime(2020, 9, 1)
    tracks = spark.createDataFrame([("s", start, 10.0, 10.0, 50.0, False), ("s", start + dt.timedelta(1), 10.0, 14.0, 90.0, True)], "storm_id string, obs_time timestamp, lat double, lon double, wind_kt double, is_forecast boolean")
    cells = spark.createDataFrame([("x", 10.0, 14.0)], "cell string, lat double, lon double")
    assert cyclones.exposure(tracks, cells, 50.0, ["cell"]).count() == 0 and cyclones.exposure(tracks, cells, 50.0, ["cell"], forecasts=True).first().max_wind_kt == 90.0


def test_categories(spark):
    winds = [0, 33.9, 34, 63, 64, 82, 83, 95, 96, 112, 113, 136, 137, 200, None]
    got = [r.c for r in spark.createDataFrame([(None if w is None else float(w),) for w in winds], "w double").select(cyclones.category(F.col("w")).alias("c")).collect()]
    assert got == ["TD", "TD", "TS", "TS", "1", "1", "2", "2", "3", "3", "4", "4", "5", "5", None]


# Skill, analogue years, vegetation


def left_out(xs):
    return [x - (sum(xs) - x) / (len(xs) - 1) for x in xs]


def test_hindcast_skill_leaves_each_year_out(spark):
    rng = random.Random(6)
    seen = {("a", m): rng.gauss(10, 3) for m in range(2000 * 12, 2012 * 12) if m % 12 < 5}
    seen |= {("b", m): 4.0 for m in range(2000 * 12, 2004 * 12)}
    issues = [(c, m - lead, lead, 0.7 * v + rng.gauss(2, 1)) for (c, m), v in seen.items() for lead in (0, 1, 13) for _ in range(2)]
    issues += [("a", 1990 * 12, 0, 5.0), ("a", 2000 * 12, 0, None), ("c", 2000 * 12, 0, 1.0)]
    observed = [(c, m, v) for (c, m), v in seen.items()] + [("a", 2000 * 12 + 7, None)]
    got = {(r.cell, r.calendar, r.lead): r for r in climate.hindcast_skill(spark.createDataFrame(issues, "cell string, init int, lead int, value double"), spark.createDataFrame(observed, "cell string, month int, value double"), ["cell"]).collect()}
    means = defaultdict(list)
    for c, init, lead, v in issues:
        if v is not None:
            means[c, init + lead, lead].append(v)
    pairs = defaultdict(list)
    for (c, m, lead), vs in sorted(means.items()):
        if (c, m) in seen:
            pairs[c, m % 12 + 1, lead].append((np.mean(vs), seen[c, m]))
    assert got.keys() == pairs.keys()
    for k, both in pairs.items():
        x, y = map(list, zip(*both, strict=True))
        r = got[k]
        assert r.n_years == len(x) and r.bias == pytest.approx(np.mean(x) - np.mean(y)) and r.hindcast_sd == pytest.approx(np.std(x, ddof=1)) and r.obs_sd == pytest.approx(np.std(y, ddof=1), abs=1e-12)
        if k[0] == "a":
            ax, ay = left_out(x), left_out(y)
            assert r.skill_acc == pytest.approx(np.dot(ax, ay) / math.sqrt(np.dot(ax, ax) * np.dot(ay, ay)))
        else:
            assert r.skill_acc is None
    table = climate.hindcast_skill(spark.createDataFrame(issues, "cell string, init int, lead int, value double"), spark.createDataFrame(observed, "cell string, month int, value double"), ["cell"])
    out = climate.calibrated(spark.createDataFrame([("a", 2020 * 12, 1, 9.0), ("z", 2020 * 12, 0, 9.0)], "cell string, init int, lead int, value double"), table, ["cell"]).orderBy("cell").collect()
    assert out[0].calibrated == pytest.approx(9.0 - got["a", 2, 1].bias) and out[0].skill_acc == got["a", 2, 1].skill_acc and out[1].calibrated is None


def test_analogue_years_equal_a_plain_search(spark):
    rng = random.Random(9)
    rows = [(c, y * 12 + m, round(rng.gauss(m, 2), 2), rng.choice([None, 1.0, 2.0, 3.0]), 7.0) for c in ("a", "b", None) for y in range(1990, 2003) for m in range(12) if rng.random() > 0.1]
    rows += [("a", y * 12 + m, 1.0 * y, 1.0 * m, 7.0) for y in (2010, 2011) for m in range(3)]
    months, targets = [1, 2, 3, 12], [1995, 2001, 2010, 1900]
    got = defaultdict(list)
    for r in climate.analogue_years(spark.createDataFrame(rows, "cell string, month int, rain double, index double, same double"), ["cell"], ["rain", "index", "same"], targets, months, 4).collect():
        got[r.cell, r.target].append((r["rank"], r.year, r.distance, r.n_parts))
    values = defaultdict(dict)
    for c, m, *vs in rows:
        if m % 12 + 1 in months:
            for name, v in zip(("rain", "index", "same"), vs, strict=True):
                if v is not None:
                    values[c, m % 12, name][m // 12] = v
    z = defaultdict(dict)
    for (c, m, name), by_year in values.items():
        if len(by_year) > 1 and (sd := np.std(list(by_year.values()), ddof=1)) > 0:
            for y, v in by_year.items():
                z[c, y][m, name] = (v - np.mean(list(by_year.values()))) / sd
    want = {}
    for c, t in z:
        if t in targets:
            near = []
            for d, y in z:
                both = z[c, t].keys() & z[d, y].keys()
                if d == c and y != t and both and 2 * len(both) >= len(z[c, t]):
                    near.append((round(math.sqrt(sum((z[c, t][p] - z[d, y][p]) ** 2 for p in both) / len(both)), 9), y, len(both)))
            if near:
                want[c, t] = [(k + 1, y, pytest.approx(d, abs=1e-8), n) for k, (d, y, n) in enumerate(sorted(near)[:4])]
    assert {k: sorted(v) for k, v in got.items()} == want and ("a", 1995) in want


def test_vegetation_keeps_missing_composites(spark):
    rng = random.Random(12)
    scenes = [(c, dt.date(y, m, d), round(rng.uniform(0.1, 0.9), 3), rng.choice([0, 0, 1, 2, None])) for c in ("a", "b") for y in range(2000, 2006) for m in (1, 2, 12) for d in (1, 5, 10, 11, 20, 21, 28) if rng.random() > 0.3]
    scenes += [("a", dt.date(2001, 1, 31), 2.5, 0), ("a", dt.date(2001, 1, 31), None, 0), ("b", dt.date(1999, 1, 1), 0.5, 0), ("same", dt.date(2000, 6, 1), 0.5, 0), *[("same", dt.date(y, 6, 2), 0.4, 1) for y in range(2001, 2005)]]
    got = {(r.cell, r.dekad_start): r for r in climate.vegetation_anomaly(spark.createDataFrame(scenes, "cell string, date date, ndvi double, quality int"), ["cell"], 2000, 2005).collect()}
    assert len(got) == 3 * 6 * 36
    best = defaultdict(list)
    for c, d, v, q in scenes:
        if v is not None and -1 <= v <= 1 and q is not None and q <= 1 and 2000 <= d.year <= 2005:
            best[c, d.month, min(d.day - 1, 29) // 10, d.year].append((q, -v))
    best = {k: -min(v)[1] for k, v in best.items()}
    for (c, start), r in got.items():
        k = (c, start.month, (start.day - 1) // 10)
        own, others = best.get((*k, start.year)), [best[*k, y] for y in range(2000, 2006) if y != start.year and (*k, y) in best]
        assert r.ndvi == own and (r.ndvi_lta == pytest.approx(np.mean(others)) if len(others) >= 2 else r.ndvi_lta is None)
        sd = np.std(others, ddof=1) if len(others) >= 2 else 0
        if own is None or sd < 1e-9:
            assert r.z is None
        else:
            assert r.z == pytest.approx((own - np.mean(others)) / sd, rel=1e-6) and r.anomaly_pct == pytest.approx((own / np.mean(others) - 1) * 100)
    june = got["same", dt.date(2000, 6, 1)]
    assert june.ndvi == 0.5 and june.ndvi_lta == pytest.approx(0.4) and june.z is None


def test_dekads(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(366)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", climate.dekad("d").alias("k")).collect()
    assert all(r.k == (r.d.month - 1) * 3 + (1 if r.d.day <= 10 else 2 if r.d.day <= 20 else 3) for r in got)
