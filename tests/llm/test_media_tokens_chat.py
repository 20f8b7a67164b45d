import hashlib
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridclim.llm import chat, common, gif, tokens

HARD = ["", " ", "  ", "a  b", " a", "a ", "\n x", "a \n b", "a ▁b", "▁", "x  \n\n  y", "</s><s> <unk>", "<|endoftext|> it's we'll 's", "　a 　 b\x1f \x1fz", "tab\t x \t y", "日本語 テキスト  あ", "é   x", "\x00 \x01 a\x01", "Ā \x01", "word " * 3000, "🙂 🙂🙂"]


@pytest.fixture
def docs(spark):
    rows = [(k, t, "en", "s") for k, t in enumerate(HARD)] + [(None, "no id", None, None), (100, None, None, None), (101, "twice", "en", "s"), (101, "twice", "en", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, media string")


def empty(docs):
    return docs.where("false")


@pytest.mark.parametrize("data", [b"", b"a", b"ab" * 5000, b"a" * 9000, bytes(range(256)) * 30, os.urandom(60_000)])
def test_lzw_round_trip(data):
    assert gif.lzw_decode(gif.lzw_encode(data), 8) == data


def test_gif_query_columns(spark, docs):
    rows = gif.decode_gif(gif.store_gif(docs)).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    for k, t in enumerate(HARD):
        b = t.encode()
        assert bytes(by[k].samples) == b.ljust(max(1, -(-len(b) // 192)) * 192, b" ") and by[k].n_bytes == len(b) and by[k].error is None
    assert by[100].n_bytes == 0 and len(by[100].samples) == 192
    assert gif.decode_gif(gif.store_gif(empty(docs))).count() == 0


def test_long_payload_has_timed_frames(spark):
    text = "z" * 120_000
    rows = gif.timed_frames(gif.decode_gif(gif.store_gif(spark.createDataFrame([(1, text)], "doc_id long, text string")), pixels=True)).collect()
    assert [(r.frame, r.start_ms, r.delay_ms, r.height) for r in rows] == [(0, 0, 100, 256), (1, 100, 100, 256), (2, 200, 100, 113)]
    assert sum(rows[0].hist_r) == 192 * 256 and len(rows[0].rgb) == 3 * 192 * 256


def _animation():
    """Three frames on a 2 x 2 canvas: red all over; a transparent pixel and disposal 2; a blue pixel, interlaced, local palette."""
    head = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x80, 0, 0) + bytes([255, 0, 0, 0, 255, 0])
    control = lambda disposal, clear, delay: struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (clear is not None), delay, clear or 0, 0)

    def image(x, y, w, h, samples, flags=0, palette=b""):
        codes, at, value = [4, *samples, 5], 0, 0
        for k, c in enumerate(codes):
            width = 3 if k < 4 else 4
            value |= c << at
            at += width
        data = value.to_bytes((at + 7) // 8, "little")
        return struct.pack("<BHHHHB", 0x2C, x, y, w, h, flags) + palette + bytes([2, len(data)]) + data + b"\0"

    return head + control(1, None, 5) + image(0, 0, 2, 2, [0, 0, 0, 0]) + control(2, 0, 7) + image(0, 0, 2, 1, [0, 1]) + control(0, None, 9) + image(1, 1, 1, 1, [1], 0x80 | 0x40, bytes([9, 9, 9, 0, 0, 255])) + b";"


def test_palettes_disposal_and_transparency():
    shown = [(f["delay_ms"], f["start_ms"], f["canvas"].copy().tolist(), f["opaque"].copy().tolist()) for f in gif.read_frames(_animation())]
    red, green, blue, none = [255, 0, 0], [0, 255, 0], [0, 0, 255], [0, 0, 0]
    assert shown[0] == (50, 0, [[red, red], [red, red]], [[True, True], [True, True]])
    assert shown[1] == (70, 50, [[red, green], [red, red]], [[True, True], [True, True]])
    assert shown[2] == (90, 120, [[none, none], [red, blue]], [[False, False], [True, True]])


def test_broken_gifs(spark):
    rows = spark.createDataFrame([(1, None), (2, bytearray(b"")), (3, bytearray(b"GIF89a\x01")), (4, bytearray(_animation()[:40]))], "doc_id long, media binary")
    assert all(r.error for r in gif.decode_gif(rows).collect())


def test_known_bytes():
    """A code stream worked out by hand, and a 10 x 10 picture of four colours as its bytes stand."""
    assert gif.lzw_encode(b"\0\0\0") == bytes.fromhex("0001080c08")
    head, palette, control = "474946383961 0a000a00910000", "ffffff ff0000 0000ff 000000", "21f9040000000000"
    data = "8c2d99872a1cdc33a00275ec95faa8de608c04914c01"
    picture = bytes.fromhex(f"{head} {palette} {control} 2c000000000a000a0000 0216 {data} 00 3b")
    rows = ["1111122222"] * 3 + ["1110000222"] * 2 + ["2220000111"] * 2 + ["2222211111"] * 3
    (frame,) = gif.read_frames(picture)
    assert frame["samples"] == bytes(int(x) for r in rows for x in r) and frame["canvas"][0, 0].tolist() == [255, 0, 0]


def test_hostile_gifs(spark):
    huge = b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0x80, 0, 0) + bytes(6) + b";"
    frame = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6) + struct.pack("<BHHHHB", 0x2C, 0, 0, 65535, 65535, 0) + b"\x02\0;"
    early = _animation()[:19] + struct.pack("<BHHHHB", 0x2C, 0, 0, 2, 2, 0) + bytes([2, 1, 0x04, 0]) + b";"
    code = _animation()[:19] + struct.pack("<BHHHHB", 0x2C, 0, 0, 2, 2, 0) + bytes([200, 1, 0x04, 0]) + b";"
    rows = {r.doc_id: r for r in gif.decode_gif(spark.createDataFrame([(k, bytearray(x)) for k, x in enumerate((huge, frame, early, code))], "doc_id long, media binary")).collect()}
    assert "65535 x 65535" in rows[0].error and "65535 x 65535" in rows[1].error and "missing" in rows[2].error and rows[3].error
    assert [len(rows[k].frames) for k in range(4)] == [0, 0, 1, 0] and bytes(rows[2].samples) == b"\0"
    bomb = gif.lzw_encode(bytes(3_000_000))
    assert len(gif.lzw_decode(bomb, 8, 1000)) < 20_000_000 and gif.lzw_decode(bomb, 8)[:1000] == gif.lzw_decode(bomb, 8, 1000)[:1000]


def test_counts_equal_the_library(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_file("piece_bpe_32k.model"))
    rows = tokens.count_tokens(docs).collect()
    by = {r.doc_id: r for r in rows}
    for k, t in enumerate(HARD):
        assert by[k].n_tokens == len(model.encode(t)), repr(t)
    assert by[100].n_tokens == 0 and len(rows) == docs.count() and by[19].over_limit == (by[19].n_tokens > 4096)
    assert tokens.count_tokens(empty(docs)).count() == 0


def test_piece_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 50)
    with open(tokens.tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        counter = tokens.PieceCounter(f.read())
    texts = [" ".join(f"xq{k}{j}zv" for j in range(40)) for k in range(5)]
    assert [c for t in texts for c in counter.counts([t])] == [len(x) for x in counter.model.encode(texts)]
    assert len(counter.known) <= len(counter.whole) + 51


def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokens.tokenizer_file("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    manifest = tokens.write_token_files(docs, f"{tmp_path}/t", partitions=3)
    rows = sorted(tokens.read_token_files(manifest, f"{tmp_path}/t", with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, *range(len(HARD)), 100, 101, 101]
    text = dict(enumerate(HARD)) | {None: "no id", 100: "", 101: "twice"}
    at = 0
    for r in rows:
        ids = model.encode(text[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids) == (at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    again = tokens.write_token_files(docs, f"{tmp_path}/t", partitions=3)
    assert sorted(again.collect()) == sorted(manifest.collect())
    assert tokens.read_token_files(tokens.write_token_files(empty(docs), f"{tmp_path}/e"), f"{tmp_path}/e").count() == 0


def test_token_files_know_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"a {end} b", f"a  {end}  b", f"{end}{end}", f"x\n {end}'s <|endoftext", f"日本{end} é\0 {end}", "none"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    model, at = Tokenizer.from_file(tokens.tokenizer_file("byte_bpe_50k.json")), 0
    for r, t in zip(sorted(tokens.op6_token_files(spark, str(tmp_path)).collect()), texts, strict=True):
        ids = model.encode(t, add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_rotation(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 2000, "ann", "bye"), (1, None, None, "x"), (None, 0, "zoe", ""), (2, 0, None, "nobody"), (3, 1, "a", "same"), (3, 1, "a", "same")]
    got = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block_turns=4).collect()
    view = sorted((r for r in got if r.conv_id == 1 and r.perspective == "ann"), key=lambda r: r.char_start)
    whole = "".join(r.segment for r in view)
    assert whole == "<|im_start|>user\nx<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n"
    assert [whole[r.mask_start : r.mask_end] for r in view if r.mask_start >= 0] == ["hi<|im_end|>", "bye<|im_end|>"]
    assert all(whole[r.char_start : r.char_end] == r.segment for r in view)
    assert {r.perspective for r in got if r.conv_id is None} == {"zoe"} and not [r for r in got if r.conv_id == 2]
    assert sorted(r.char_start for r in got if r.conv_id == 3) == [0, len("<|im_start|>assistant\nsame<|im_end|>\n")]
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_words_of_long_texts(monkeypatch):
    texts = pa.array(["ab cd  é\t" * 50, None, "", " x", "y z", "long" * 40 + " s", "LONG" * 40])
    whole, first = common.word_hashes(texts, "space")
    parts = ["".join(x.decode() for x in common.plain_words(t, "space")) for t in common.column_bytes(texts)]
    counts = [common.count_words(t) for t in common.column_bytes(texts)]
    assert np.diff(first).tolist() == counts == [150, 0, 0, 1, 2, 2, 1] and whole[-1] == whole[-3]
    for block in (1, 2, 17):
        monkeypatch.setattr(common, "_BLOCK", block)
        again, places = common.word_hashes(texts, "space")
        assert (again == whole).all() and (places == first).all()
        assert ["".join(x.decode() for x in common.plain_words(t, "space")) for t in common.column_bytes(texts)] == parts
        assert [common.count_words(t) for t in common.column_bytes(texts)] == counts
    words = {w for t in common.column_bytes(texts) for w in common.word_list(t, "space")}
    assert len(set(whole.tolist())) == len(words)


def test_sha_of_query(spark, tmp_path):
    spark.createDataFrame([(1, "abc")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    r = gif.op1_gif_media(spark, str(tmp_path)).first()
    assert r.payload_sha256 == hashlib.sha256(b"abc".ljust(192)).hexdigest() and r.tail_crc32 == zlib.crc32(b" " * 16)
    assert F is not None
