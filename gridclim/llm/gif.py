"""Media columns: GIF. LZW code streams, palettes, disposal, transparency, timed frames, colour histograms.

`store_gif` writes bytes losslessly as palette indices; `decode_gif` reads any GIF87a/89a. A null or empty text is an empty
payload, filled up like others; texts of any length are stored whole, in frames of FRAME_ROWS rows. A null, empty or broken
GIF gives the frames up to the fault and says why in `error`. Rows are judged alone, so repeated ones agree and there are no
ties; an empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_bytes, read_table, spread

ROW, FRAME_ROWS, DELAY_CS, BINS = 192, 256, 10, 8
#: Pixels of the largest canvas or frame that is decoded; beyond, `error` says so.
MOST_PIXELS = 1 << 24
GREY = bytes(x for i in range(256) for x in (i, i, i))


def _widths(first: int, n: int, min_code: int) -> np.ndarray:
    """Bits of the codes number first..first+n after a clear code: the reader's table is one entry behind."""
    entries = (1 << min_code) + 2 + np.maximum(0, np.arange(first, first + n) - 1)
    return np.minimum(12, np.maximum(min_code + 1, np.floor(np.log2(entries)).astype(np.int64) + 1))


_WIDTHS_8 = _widths(0, 4096, 8)


def lzw_encode(data: bytes) -> bytes:
    """Eight-bit samples as a GIF code stream, without sub-blocks."""
    clear, end, full = 256, 257, 4096
    codes, starts = [clear], [1]
    if data:
        table: dict[int, int] = {}
        entry, add, get = 258, codes.append, table.get
        prefix = data[0]
        for byte in data[1:]:
            key = prefix << 8 | byte
            code = get(key)
            if code is not None:
                prefix = code
                continue
            add(prefix)
            prefix = byte
            if entry < full:
                table[key] = entry
                entry += 1
            else:
                add(clear)
                starts.append(len(codes))
                table.clear()
                entry = 258
        add(prefix)
    codes.append(end)
    values = np.array(codes, np.int64)
    since = _since(len(values), starts)
    width = np.where(since < 0, 9, _WIDTHS_8[np.maximum(since, 0)])
    at = np.cumsum(width) - width
    moved = values << (at & 7)
    size = int(at[-1] + width[-1] + 7) // 8
    out = np.zeros(size + 2)
    for k in range(3):
        out += np.bincount((at >> 3) + k, weights=moved >> (8 * k) & 255, minlength=size + 2)
    return out[:size].astype(np.uint8).tobytes()


def _since(n: int, starts: list[int]) -> np.ndarray:
    """For each code its number since the last clear code; -1 for the first clear code."""
    begin = np.zeros(n, np.int64)
    begin[starts[1:]] = np.diff(starts)
    begin[0] = 1
    return np.arange(n) - np.cumsum(begin)


def lzw_decode(stream: bytes, min_code: int, most: int | None = None) -> bytes:
    """The samples of a code stream; codes between two clear codes are unpacked together. No more is decoded once there are `most`."""
    if not 1 <= min_code <= 11:
        raise ValueError("a code size out of range")
    clear, end = 1 << min_code, (1 << min_code) + 1
    data = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    bits, at, out = len(stream) * 8, 0, []
    basic = [bytes([i]) for i in range(clear)] + [b"", b""]
    table, number, previous, step, made = list(basic), 0, None, 4096, 0
    while at < bits and (most is None or made < most):
        width = _WIDTHS_8 if min_code == 8 and number == 0 else _widths(number, step, min_code)
        ends = at + np.cumsum(width)
        n = int(np.searchsorted(ends, bits, "right"))
        if n == 0:
            break
        begin = ends[:n] - width[:n]
        byte = begin >> 3
        codes = ((data[byte] | data[byte + 1] << 8 | data[byte + 2] << 16) >> (begin & 7)) & ((1 << width[:n]) - 1)
        stop = np.flatnonzero((codes == clear) | (codes == end))
        last = int(stop[0]) if len(stop) else n
        for code in codes[:last].tolist():
            known = len(table)
            if previous is None:
                if code >= clear:
                    raise ValueError("a code before its entry")
                text = table[code]
            else:
                if code < known:
                    text = table[code]
                    entry = previous + text[:1]
                elif code == known:
                    text = entry = previous + previous[:1]
                else:
                    raise ValueError("a code beyond the table")
                if known < 4096:
                    table.append(entry)
            out.append(text)
            made += len(text)
            previous = text
        if last == n:
            at, number = int(ends[n - 1]), number + n
        elif codes[last] == end:
            break
        else:
            at, table, number, previous = int(ends[last]), list(basic), 0, None
    return b"".join(out)


def _blocks(stream: bytes) -> bytes:
    return b"".join(bytes([len(x)]) + x for x in (stream[i : i + 255] for i in range(0, len(stream), 255))) + b"\0"


def gif_bytes(payload: bytes, row: int = ROW, frame_rows: int = FRAME_ROWS, delay_cs: int = DELAY_CS, palette: bytes = GREY) -> bytes:
    """A GIF whose frames hold the payload, whole rows of it, as palette indices in order."""
    rows = len(payload) // row
    out = [b"GIF89a", struct.pack("<HHBBB", row, min(rows, frame_rows), 0xF7, 0, 0), palette, b"\x21\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"]
    for at in range(0, rows, frame_rows):
        part = payload[at * row : (at + frame_rows) * row]
        out += [struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, delay_cs, 0, 0), struct.pack("<BHHHHB", 0x2C, 0, 0, row, len(part) // row, 0), b"\x08", _blocks(lzw_encode(part))]
    return b"".join([*out, b";"])


def _interlaced(height: int) -> list[int]:
    return [y for first, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(first, height, step)]


def read_frames(gif: bytes) -> Iterator[dict]:
    """Each frame in order: its samples as stored, its place and time, and the canvas as shown (RGB and what is opaque).

    Disposal 0 and 1 leave the frame, 2 clears its rectangle, 3 brings back what was there before.
    A frame partly outside the canvas is clipped when drawn. A frame that lacks samples is filled with index 0 and is the last,
    with an error. A canvas or frame of over MOST_PIXELS is an error before anything is allocated for it.
    """
    if gif[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack("<HHB", gif[6:11])
    at = 13
    shared = None
    if flags & 0x80:
        shared = gif[at : (at := at + 3 * (2 << (flags & 7)))]
    if width * height > MOST_PIXELS:
        raise ValueError(f"a canvas of {width} x {height} pixels, over {MOST_PIXELS}")
    canvas, opaque = np.zeros((height, width, 3), np.uint8), np.zeros((height, width), bool)
    disposal, transparent, delay, start, index = 0, None, 0, 0, 0

    def blocks() -> bytes:
        nonlocal at
        parts = []
        while n := gif[at]:
            parts.append(gif[at + 1 : at + 1 + n])
            at += n + 1
        at += 1
        return b"".join(parts)

    while at < len(gif) and gif[at] != 0x3B:
        kind = gif[at]
        if kind == 0x21:
            label = gif[at + 1]
            at += 2
            body = blocks()
            if label == 0xF9:
                disposal, delay = body[0] >> 2 & 7, struct.unpack("<H", body[1:3])[0] * 10
                transparent = body[3] if body[0] & 1 else None
            continue
        if kind != 0x2C:
            raise ValueError("an unknown block")
        left, top, w, h, local = struct.unpack("<HHHHB", gif[at + 1 : at + 10])
        at += 10
        if w * h > MOST_PIXELS:
            raise ValueError(f"a frame of {w} x {h} pixels, over {MOST_PIXELS}")
        palette = shared
        if local & 0x80:
            palette = gif[at : (at := at + 3 * (2 << (local & 7)))]
        if palette is None:
            raise ValueError("no palette")
        min_code = gif[at]
        at += 1
        samples = lzw_decode(blocks(), min_code, w * h)[: w * h]
        missing = w * h - len(samples)
        grid = np.frombuffer(samples.ljust(w * h, b"\0"), np.uint8).reshape(h, w)
        if local & 0x40:
            straight = np.empty_like(grid)
            straight[_interlaced(h)] = grid
            grid = straight
            samples = grid.tobytes()
        colours = np.zeros((256, 3), np.uint8)
        known = np.frombuffer(palette, np.uint8).reshape(-1, 3)
        colours[: len(known)] = known
        before = (canvas.copy(), opaque.copy()) if disposal == 3 else None
        seen = grid[: max(0, height - top), : max(0, width - left)]
        area = (slice(top, top + seen.shape[0]), slice(left, left + seen.shape[1]))
        shown = np.ones(seen.shape, bool) if transparent is None else seen != transparent
        if shown.all():
            canvas[area], opaque[area] = colours[seen], True
        else:
            canvas[area][shown] = colours[seen[shown]]
            opaque[area] |= shown
        yield {"frame": index, "start_ms": start, "delay_ms": delay, "left": left, "top": top, "width": w, "height": h, "disposal": disposal, "samples": samples, "canvas": canvas, "opaque": opaque, "screen": (width, height)}
        if missing:
            raise ValueError(f"{missing} samples are missing")
        if disposal == 2:
            canvas[area], opaque[area] = 0, False
        elif before:
            canvas, opaque = before
        start, index = start + delay, index + 1
        disposal, transparent, delay = 0, None, 0


def histogram(canvas: np.ndarray, opaque: np.ndarray) -> list[list[int]]:
    """Opaque pixels by level, BINS equal ranges for each of red, green and blue."""
    pixels = canvas.reshape(-1, 3) if opaque.all() else canvas[opaque]
    return [np.bincount(pixels[:, k] >> 5, minlength=BINS).tolist() for k in range(3)]


FRAME = T.StructType(
    [T.StructField(x, T.IntegerType()) for x in ("frame", "start_ms", "delay_ms", "left", "top", "width", "height", "disposal")]
    + [T.StructField(x, T.ArrayType(T.LongType())) for x in ("hist_r", "hist_g", "hist_b")]
    + [T.StructField("rgb", T.BinaryType())]
)
_FRAME_ARROW = pa.struct([(f.name, pa.int32() if f.dataType == T.IntegerType() else pa.binary() if f.dataType == T.BinaryType() else pa.list_(pa.int64())) for f in FRAME])


def store_gif(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes and `media`: each text's UTF-8 bytes, filled with spaces to a positive multiple of 192, as a GIF.

    One row for each input row, repeated rows and null ids included.
    """

    def run(batches):
        for batch in batches:
            size, media = [], []
            for text in column_bytes(batch.column(1)):
                size.append(len(text))
                media.append(gif_bytes(text.ljust(max(1, -(-len(text) // ROW)) * ROW, b" ")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    kind = df.schema[id_col].dataType
    return df.select(id_col, text_col).mapInArrow(run, T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]))


def decode_gif(df: DataFrame, media_col: str = "media", pixels: bool = False) -> DataFrame:
    """The input with `samples` (all frames' samples in order), `frames` and `error`; an input column of those names is replaced.

    frames: array of structs with place, time, disposal and the histograms of the canvas as shown; `rgb` holds
    the canvas itself with `pixels`, else null.
    """
    kept = df.drop("samples", "frames", "error")
    names = kept.columns

    def run(batches):
        for batch in batches:
            samples, frames, errors = [], [], []
            for gif in column_bytes(batch.column(names.index(media_col))):
                parts, found, error = [], [], None
                try:
                    for x in read_frames(gif):
                        parts.append(x["samples"])
                        counts = histogram(x["canvas"], x["opaque"])
                        found.append({k: x[k] for k in FRAME.names[:8]} | dict(zip(("hist_r", "hist_g", "hist_b"), counts, strict=True)) | {"rgb": x["canvas"].tobytes() if pixels else None})
                except (ValueError, IndexError, struct.error) as e:
                    error = str(e) or type(e).__name__
                samples.append(b"".join(parts))
                frames.append(found)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(samples, pa.binary()), pa.array(frames, pa.list_(_FRAME_ARROW)), pa.array(errors, pa.string())], [*names, "samples", "frames", "error"])

    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField("samples", T.BinaryType()), T.StructField("frames", T.ArrayType(FRAME)), T.StructField("error", T.StringType())]))


def timed_frames(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each frame of what decode_gif returned."""
    return decoded.select(id_col, F.explode("frames").alias("f")).select(id_col, "f.*")


def op1_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents stored as GIF and read back: digests of payload and stored form, frames and the red levels' histogram."""
    media = decode_gif(store_gif(spread(read_table(spark, sf_dir, "documents"))))
    levels = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.aggregate("frames", F.lit(0).cast("long"), lambda a, f: a + F.get(f["hist_r"], i)).cast("string"))
    last = F.element_at("frames", -1)
    return media.select(
        "doc_id",
        "n_bytes",
        F.length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(samples, -16)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws("|", F.concat(F.size("frames"), F.lit(" frames")), F.concat(last["start_ms"] + last["delay_ms"], F.lit(" ms")), F.concat_ws(",", levels)).alias("feature"),
        F.size("frames").alias("n_frames"),
        "error",
    )
