"""Tropical cyclones: which cells a track came near, how near, when and how strong.

A distance-range join on the sphere as an equi-join. Tracks are cut into great-circle segments and these into pieces; a piece
names the bins of the globe that the circle around it can reach, across the antimeridian and around the poles too, and
cells join on the bin of their centre. Only cells of such bins are measured, by vectors.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclim.functions.special import let

EARTH_KM = 6371.0088
#: Degrees of a bin's side, most degrees of a piece, and seconds of a block of a track.
BIN, PIECE, BLOCK = 2.5, 4.0, 30 * 86400
# fixed values: the Saffir-Simpson scale, least sustained wind in knots
CATEGORIES = (("5", 137), ("4", 113), ("3", 96), ("2", 83), ("1", 64), ("TS", 34))


def category(wind: Column) -> Column:
    """The category of a sustained wind in knots; TD below all."""
    value = F.when(wind.isNotNull(), F.lit("TD"))
    for name, least in reversed(CATEGORIES):
        value = F.when(wind >= least, F.lit(name)).otherwise(value)
    return value


def unit_vector(lat: Column, lon: Column) -> Column:
    a, b = F.radians(lat), F.radians(lon)
    return F.struct((F.cos(a) * F.cos(b)).alias("x"), (F.cos(a) * F.sin(b)).alias("y"), F.sin(a).alias("z"))


def _dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def _cross(a: Column, b: Column) -> Column:
    return F.struct((a["y"] * b["z"] - a["z"] * b["y"]).alias("x"), (a["z"] * b["x"] - a["x"] * b["z"]).alias("y"), (a["x"] * b["y"] - a["y"] * b["x"]).alias("z"))


def _angle(a: Column, b: Column) -> Column:
    """From the chord, so that small angles stay exact."""
    gap = F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2) + F.pow(a["z"] - b["z"], 2))
    return 2 * F.asin(F.least(F.lit(1.0), gap / 2))


def segments(tracks: DataFrame, storm: str = "storm_id", block: int = BLOCK) -> DataFrame:
    """storm, t0, lat0, lon0, wind0 and t1, lat1, lon1, wind1: each observation with the next one of its storm; a storm's only one with itself.

    Followers are found within blocks of time, and across them by the next block's first observation, so that a storm of very many
    observations is dealt to many tasks. Observations of one time follow by place and wind. Those without a time or a place do not count.
    """
    sound = F.col("obs_time").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    point = F.struct(F.col("obs_time").alias("t"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.col("wind_kt").cast("double").alias("wind"))
    rows = tracks.where(sound).select(F.col(storm).alias("_s"), point.alias("p"), F.floor(F.unix_seconds(F.col("obs_time").cast("timestamp")) / block).alias("_b"))
    firsts = rows.groupBy("_s", "_b").agg(F.min("p").alias("first"), F.count("*").alias("n"))
    by_storm = Window.partitionBy("_s")
    nexts = firsts.select("_s", "_b", F.lead("first").over(by_storm.orderBy("_b")).alias("after"), (F.sum("n").over(by_storm) == 1).alias("alone"))
    led = rows.withColumn("q", F.lead("p").over(Window.partitionBy("_s", "_b").orderBy("p"))).alias("r").join(nexts.alias("n"), F.col("r._s").eqNullSafe(F.col("n._s")) & (F.col("r._b") == F.col("n._b")))
    both = led.select(F.col("r._s").alias(storm), "p", F.coalesce("q", "after", F.when(F.col("alone"), F.col("p"))).alias("q")).where("q is not null")
    return both.select(storm, *[F.col(f"{side}.{c}").alias(f"{c}{k}") for k, side in enumerate("pq") for c in ("t", "lat", "lon", "wind")])


def bins_within(lat: Column, lon: Column, reach: Column, size: float = BIN) -> Column:
    """Numbers of the bins that meet the circle of `reach` radians around a place: the rows of its latitudes, and in each the columns of
    its longitudes, which are all of them where a pole is inside."""
    columns, rows = round(360 / size), round(180 / size)

    def edges(v: Column) -> Column:
        degrees = F.degrees(v["reach"])
        span = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(v["reach"]) / F.cos(F.radians(v["lat"])))))
        row = lambda x: F.greatest(F.lit(0), F.least(F.lit(rows - 1), F.floor((x + 90) / size))).cast("int")
        polar, first = F.abs(v["lat"]) + degrees >= 90, F.floor((v["lon"] - span) / size).cast("int")
        last = F.least(F.floor((v["lon"] + span) / size).cast("int"), first + columns - 1)
        return F.struct(row(v["lat"] - degrees).alias("low"), row(v["lat"] + degrees).alias("high"), F.when(polar, 0).otherwise(first).alias("west"), F.when(polar, columns - 1).otherwise(last).alias("east"))

    def numbers(e: Column) -> Column:
        across = lambda r: F.transform(F.sequence(e["west"], e["east"]), lambda c: r * columns + F.pmod(c, F.lit(columns)))
        return F.flatten(F.transform(F.sequence(e["low"], e["high"]), across))

    return let(let(F.struct(lat.alias("lat"), lon.alias("lon"), reach.alias("reach")), edges), numbers)


def bin_of(lat: Column, lon: Column, size: float = BIN) -> Column:
    columns, rows = round(360 / size), round(180 / size)
    row = F.greatest(F.lit(0), F.least(F.lit(rows - 1), F.floor((lat + 90) / size))).cast("int")
    return row * columns + F.pmod(F.floor(lon / size).cast("int"), F.lit(columns))


def reached_bins(radius_km: float, size: float = BIN, piece: float = PIECE) -> Column:
    """The bins that the surroundings of a segment of `with_arcs` meet, each once: those of pieces of at most `piece` degrees."""
    ends = F.struct(_whole("_a").alias("a"), _whole("_b").alias("b"), F.greatest(F.lit(1), F.ceil(F.degrees("_length") / piece).cast("int")).alias("n"))
    whole = F.col("_length")

    def middle(v: Column, k: Column) -> Column:
        """A piece's middle, by its share of the way along the arc; where the ends are close together along the straight line."""
        share = (k + 0.5) / v["n"]
        u, w = (F.when(whole > 1e-6, F.sin(x * whole) / F.sin(whole)).otherwise(x) for x in (1 - share, share))
        return F.struct(*[(u * v["a"][c] + w * v["b"][c]).alias(c) for c in "xyz"])

    def around(v: Column, m: Column) -> Column:
        reach = whole / v["n"] / 2 + radius_km / EARTH_KM + 1e-9
        return bins_within(F.degrees(F.atan2(m["z"], F.sqrt(m["x"] * m["x"] + m["y"] * m["y"]))), F.degrees(F.atan2(m["y"], m["x"])), reach, size)

    pieces = lambda v: F.transform(F.sequence(F.lit(0), v["n"] - 1), lambda k: let(middle(v, k), lambda m: around(v, m)))
    return let(ends, lambda v: F.array_distinct(F.flatten(pieces(v))))


def _parts(v: Column, name: str) -> dict[str, Column]:
    return {f"{name}{c}": v[c] for c in "xyz"}


def _whole(name: str) -> Column:
    return F.struct(*[F.col(f"{name}{c}").alias(c) for c in "xyz"])


def with_arcs(legs: DataFrame) -> DataFrame:
    """Segments with their length and what a distance to them needs, as plain columns that are computed once a segment: both ends, the arc's
    normal, and the normals of the planes that bound what lies beside the arc."""
    rows = legs.withColumns(_parts(unit_vector(F.col("lat0"), F.col("lon0")), "_a") | _parts(unit_vector(F.col("lat1"), F.col("lon1")), "_b"))
    rows = rows.withColumns(_parts(_cross(_whole("_a"), _whole("_b")), "_n") | {"_length": _angle(_whole("_a"), _whole("_b"))})
    rows = rows.withColumn("_size", F.sqrt(_dot(_whole("_n"), _whole("_n"))))
    return rows.withColumns(_parts(_cross(_whole("_n"), _whole("_a")), "_f") | _parts(_cross(_whole("_b"), _whole("_n")), "_g"))


def distance_km() -> Column:
    """From a place (_px, _py, _pz) to the great-circle arc of `with_arcs`: across it where the place lies beside the arc, else to the
    nearer end."""
    p = _whole("_p")
    beside = (F.col("_size") > 1e-12) & (_dot(_whole("_f"), p) >= 0) & (_dot(_whole("_g"), p) >= 0)
    across = F.abs(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(_whole("_n"), p) / F.col("_size")))))
    return EARTH_KM * F.when(beside, across).otherwise(F.least(_angle(_whole("_a"), p), _angle(_whole("_b"), p)))


def exposure(tracks: DataFrame, cells: DataFrame, radius_km: float, keys: list[str], storm: str = "storm_id", forecasts: bool = False, size: float = BIN, piece: float = PIECE) -> DataFrame:
    """storm, keys, closest_approach_km, max_wind_kt, exposure_start, exposure_end: a row for each storm and cell whose centre a segment
    of the track comes within the radius of.

    tracks: storm, obs_time, lat, lon, wind_kt and, if there, is_forecast, whose rows count only with `forecasts`. cells: keys, lat, lon,
    one row each. The wind is the larger of a segment's ends, over the segments within the radius; the dates are those of the first's
    start and the last's end. Segments are shorter than half the globe. Cells without a place take no part. Each
    place is measured once a segment and summed up once a storm, however many cells are there; these get its row by an equi-join.
    """
    if "is_forecast" in tracks.columns and not forecasts:
        tracks = tracks.where(~F.coalesce("is_forecast", F.lit(False)))
    cut = with_arcs(segments(tracks, storm)).withColumn("_bin", F.explode(reached_bins(radius_km, size, piece)))
    known = cells.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(*keys, F.col("lat").cast("double").alias("_lat"), F.col("lon").cast("double").alias("_lon")).distinct()
    places = known.select("_lat", "_lon").distinct()
    at = places.select("_lat", "_lon", bin_of(F.col("_lat"), F.col("_lon"), size).alias("_bin"), *[x.alias(n) for n, x in _parts(unit_vector(F.col("_lat"), F.col("_lon")), "_p").items()])
    met = cut.join(at, "_bin").withColumn("_km", distance_km()).where(F.col("_km") <= radius_km)
    found = met.groupBy(storm, "_lat", "_lon").agg(F.min("_km").alias("closest_approach_km"), F.max(F.greatest("wind0", "wind1")).alias("max_wind_kt"), F.to_date(F.min("t0")).alias("exposure_start"), F.to_date(F.max("t1")).alias("exposure_end"))
    return found.join(known, ["_lat", "_lon"]).select(storm, *keys, "closest_approach_km", "max_wind_kt", "exposure_start", "exposure_end")
