"""Crop-model station files: header with TAV and AMP, and the daily lines, fixed width."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.functions import physics, text


def climatology(stored: DataFrame, keys: list[str], first_year: int = 1991, last_year: int = 2020) -> DataFrame:
    """keys, tav, amp, n_months: the plain mean of the monthly mean temperatures, half their range, and how many there are."""
    years = F.col("date").between(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))
    months = stored.where(years).groupBy(*keys, F.month("date").alias("mon")).agg(F.avg((F.col("tmax") + F.col("tmin")) / 2.0).alias("tmean"))
    return months.groupBy(*keys).agg(F.avg("tmean").alias("tav"), ((F.max("tmean") - F.min("tmean")) / 2.0).alias("amp"), F.count("*").cast("int").alias("n_months"))


def header(cells: DataFrame, climate: DataFrame) -> DataFrame:
    """A row for each cell of the grid table (child_id, lat, lon, elevation), with or without a climatology."""
    found = cells.join(climate, "child_id", "left")
    return found.select("child_id", F.col("child_id").alias("insi"), "lat", "lon", F.col("elevation").cast("double").alias("elev"), "tav", "amp", F.lit(2.0).alias("refht"), F.lit(2.0).alias("wndht"), F.coalesce("n_months", F.lit(0)).alias("n_months"))


def header_lines(head: DataFrame, year: int, rain: str = "era5") -> DataFrame:
    """child_id, ord, line: the four lines before the body."""
    own = rain.lower() == "era5"
    title = F.concat(F.lit("*WEATHER DATA : "), "insi", F.lit(" ERA5 0.25deg local-day" + ("" if own else f" + {rain.lower()} RAIN (product day)") + f" {year}"))
    numbers = F.concat(F.lit("  "), "insi", text.padded(text.decimals("lat", 3), 9), text.padded(text.decimals("lon", 3), 9), text.padded(text.decimals(F.coalesce("elev", F.lit(float(text.MISSING))), 0), 6), *[text.f6(c) for c in ("tav", "amp", "refht", "wndht")])
    return head.select("child_id", F.posexplode(F.array(title, F.lit(""), F.lit(text.STATION_LINE), numbers)).alias("ord", "line"))


def body(stored: DataFrame) -> DataFrame:
    """The station file's columns of stored rows: dew point, wind at 2 m in km a day."""
    return stored.select("child_id", "date", "srad", "tmax", "tmin", F.col("precip").alias("rain"), F.col("tdew").alias("dewp"), physics.wind_km_day("wind").alias("wind"), F.col("rh").alias("rhum"))


def body_lines(rows: DataFrame) -> DataFrame:
    """child_id, ord, line; ord is the day number, after the header's."""
    parts = [text.f6(c) for c in ("srad", "tmax", "tmin", "rain", "dewp", "wind")]
    line = F.concat(text.station_date("date"), *parts, F.lpad(F.lit(str(text.MISSING)), 6, " "), text.f6("rhum"))
    return rows.select("child_id", (F.dayofyear("date") + 10).alias("ord"), line.alias("line"))


def station_lines(stored: DataFrame, cells: DataFrame, year: int, rain: str = "era5", first_year: int = 1991, last_year: int = 2020) -> DataFrame:
    """child_id, ord, line of the files of all cells in the grid table, for one year."""
    head = header_lines(header(cells, climatology(stored, ["child_id"], first_year, last_year)), year, rain)
    days = stored.where(F.col("date").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")))
    named = head.where("ord = 3").select("child_id", F.lit(5).alias("ord"), F.lit(text.BODY_LINE).alias("line"))
    return head.unionByName(named).unionByName(body_lines(body(days).join(cells.select("child_id"), "child_id", "left_semi")))


def station_files(lines: DataFrame, year: int) -> DataFrame:
    """filename, content: one row for each cell that has days. A file has at most 371 lines, so a group is small."""
    whole = lines.groupBy("child_id").agg(F.array_sort(F.collect_list(F.struct("ord", "line"))).alias("all"), F.max("ord").alias("last")).where(F.col("last") > 5)
    return whole.select(text.station_filename("child_id", F.lit(year)).alias("filename"), F.concat(F.array_join(F.transform("all", lambda x: x["line"]), "\n"), F.lit("\n")).alias("content"))


def write_station_files(files: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Writes each file under its own name, from the executors, through Spark's file systems' local or mounted paths."""
    import os

    def put(rows):
        for r in rows:
            path = os.path.join(folder, r.filename)
            if overwrite or not os.path.exists(path):
                beside = f"{path}.{os.getpid()}"
                with open(beside, "w", encoding="ascii") as f:
                    f.write(r.content)
                os.replace(beside, path)

    os.makedirs(folder, exist_ok=True)
    files.foreachPartition(put)
