import datetime as dt
import io
import struct
import zlib

import numpy as np
import pytest

from gridclim.functions import grid
from gridclim.sources import geotiff, netcdf, raster

BANDS = np.arange(3 * 4 * 5, dtype="<f4").reshape(3, 4, 5)
BANDS[1, 2, 3] = -9999


def tiff(compression=1, planar=True, tiled=False):
    """Three bands of 4 x 5 pixels of 0.25 degrees, centres from (90, 0) on."""
    blocks = []
    layers = [b[:, :, None] for b in BANDS] if planar else [np.moveaxis(BANDS, 0, 2)]
    for a in layers:
        if tiled:
            padded = np.zeros((16, 16, a.shape[2]), "<f4")
            padded[:4, :5] = a
            blocks.append(padded.tobytes())
        else:
            blocks += [np.ascontiguousarray(a[:3]).tobytes(), np.ascontiguousarray(a[3:]).tobytes()]
    if compression == 8:
        blocks = [zlib.compress(b) for b in blocks]
    names = "<GDALMetadata>" + "".join(f'<Item name="DESCRIPTION" sample="{k}" role="description">{k}_2020-01-0{k + 1}</Item>' for k in range(3)) + "</GDALMetadata>"
    data, where = b"", []
    for b in blocks:
        where.append(8 + len(data))
        data += b
    place = ((322, 4, [16]), (323, 4, [16]), (324, 4, where), (325, 4, [len(b) for b in blocks])) if tiled else ((273, 4, where), (278, 4, [3]), (279, 4, [len(b) for b in blocks]))
    tags = [(256, 4, [5]), (257, 4, [4]), (258, 3, [32] * 3), (259, 3, [compression]), (277, 3, [3]), (284, 3, [2 if planar else 1]), (339, 3, [3] * 3), (33550, 12, [0.25, 0.25, 0.0]), (33922, 12, [0.0, 0.0, 0.0, -0.125, 90.125, 0.0]), (42112, 2, names.encode() + b"\0"), (42113, 2, b"-9999\0"), *place]
    tags.sort(key=lambda t: t[0])
    at = 8 + len(data)
    extra, entries = b"", b""
    base = at + 2 + 12 * len(tags) + 4
    for tag, kind, value in tags:
        raw = value if kind == 2 else struct.pack(f"<{len(value)}{ {3: 'H', 4: 'I', 12: 'd'}[kind] }", *value)
        n = len(value)
        if len(raw) <= 4:
            entries += struct.pack("<HHI", tag, kind, n) + raw.ljust(4, b"\0")
        else:
            entries += struct.pack("<HHII", tag, kind, n, base + len(extra))
            extra += raw
    return b"II" + struct.pack("<HI", 42, at) + data + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + extra


@pytest.mark.parametrize("how", [{}, {"compression": 8}, {"planar": False}, {"tiled": True}, {"tiled": True, "planar": False, "compression": 8}])
def test_tiff_bands(how):
    image = geotiff.Tiff(io.BytesIO(tiff(**how)))
    want = np.where(BANDS == -9999, np.nan, BANDS)
    assert all(np.array_equal(image.band(k), want[k], equal_nan=True) for k in range(3))
    assert image.dates()[2] == dt.date(2020, 1, 3) and image.axes()[0][:2] == [90.0, 89.75] and image.axes()[1][1] == 0.25


def test_tiff_lzw():
    data = bytes(np.random.default_rng(0).integers(0, 4, 9000, dtype=np.uint8))
    table, codes, prefix, width, out, held = {bytes([i]): i for i in range(256)}, [(256, 9)], b"", 9, 0, 0
    size = 258
    for b in data:
        if prefix + bytes([b]) in table:
            prefix += bytes([b])
            continue
        codes.append((table[prefix], width))
        table[prefix + bytes([b])] = size
        size += 1
        width = 12 if size >= 2047 + 1 - 0 else 11 if size >= 1023 + 1 else 10 if size >= 511 + 1 else 9
        if size >= 4094:
            codes.append((256, width))
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
        prefix = bytes([b])
    codes += [(table[prefix], width), (257, 12 if size >= 2047 else 11 if size >= 1023 else 10 if size >= 511 else 9)]
    for c, w in codes:
        out, held = out << w | c, held + w
    stream = (out << (-held % 8)).to_bytes((held + 7) // 8, "big")
    assert geotiff.lzw_decode(stream)[: len(data)] == data


def test_tiff_to_long_rows(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(tiff())
    spark.dataSource.register(geotiff.GeoTiffSource)
    tiles = spark.read.format("geotiff").option("paths", f"{tmp_path}/a.tif").option("window", "2").load()
    rows = raster.encode_grid(tiles).collect()
    assert len(rows) == 59 and {r.date for r in rows} == {dt.date(2020, 1, k) for k in (1, 2, 3)}
    assert [r.value for r in rows if r.child_id == grid.place(89.75, 0.25).child_id and r.date.day == 1] == [6.0]
    assert raster.pixel_counts(tiles).first().asDict() == {"n_pixels": 60, "n_valid": 59}


def classic():
    """Two record steps of a 2 x 2 field of scaled shorts."""
    name = lambda s: struct.pack(">i", len(s)) + s.encode().ljust(-(-len(s) // 4) * 4, b"\0")
    text = lambda k, s: name(k) + struct.pack(">ii", 2, len(s)) + s.encode().ljust(-(-len(s) // 4) * 4, b"\0")
    number = lambda k, kind, form, x: name(k) + struct.pack(">ii", kind, 1) + struct.pack(form, x).ljust(8 if kind == 6 else 4, b"\0")
    listed = lambda tag, items: struct.pack(">ii", tag if items else 0, len(items)) + b"".join(items)
    dims = [name("time") + struct.pack(">i", 0), name("latitude") + struct.pack(">i", 2), name("longitude") + struct.pack(">i", 2)]

    def variables(begins):
        put = lambda n, d, attributes, kind, size, begin: name(n) + struct.pack(f">i{len(d)}i", len(d), *d) + listed(12, attributes) + struct.pack(">iii", kind, size, begin)
        field = [number("scale_factor", 6, ">d", 0.5), number("add_offset", 6, ">d", 10.0), number("_FillValue", 3, ">h", -1)]
        return [put("latitude", [1], [], 5, 8, begins[0]), put("longitude", [2], [], 5, 8, begins[1]), put("time", [0], [text("units", "hours since 2020-01-01 00:00:00")], 4, 4, begins[2]), put("t2m", [0, 1, 2], field, 3, 8, begins[3])]

    head = lambda begins: b"CDF\x01" + struct.pack(">i", 2) + listed(10, dims) + struct.pack(">ii", 0, 0) + listed(11, variables(begins))
    n = len(head([0] * 4))
    body = struct.pack(">2f2f", 90.0, 89.75, 0.0, 0.25)
    for step, values in ((0, (0, 2, 4, -1)), (24, (6, 8, 10, 12))):
        body += struct.pack(">i4h", step, *values)
    return head([n, n + 8, n + 16, n + 20]) + body


def test_netcdf(spark, tmp_path):
    (tmp_path / "a.nc").write_bytes(classic())
    spark.dataSource.register(netcdf.NetcdfSource)
    tiles = spark.read.format("netcdf").option("paths", f"{tmp_path}/a.nc").load()
    rows = {(r.child_id, r.date.day): r.value for r in raster.encode_grid(tiles).collect()}
    assert len(rows) == 7 and rows["0000", 1] == 10.0 and rows["0001", 1] == 11.0 and rows[grid.place(89.75, 0.25).child_id, 2] == 16.0
    with pytest.raises(ValueError):
        netcdf.Classic(io.BytesIO(b"\x89HDF\r\n\x1a\n"))
