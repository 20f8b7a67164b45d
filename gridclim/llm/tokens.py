"""Token counts with a whole-token shortcut, and flat files of token ids.

Both split a text where no merge can cross, count or encode each distinct piece once, and keep what
they have met in a bounded per-worker cache.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column_bytes, kept, read_table, spread

#: Pieces that a worker keeps: at most about 250 MB for ids, 100 MB for counts.
CACHED = 1_000_000


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCounter:
    """Counts a sentencepiece BPE model's tokens by pre-token.

    A pre-token is a run of word marks and what follows up to the next mark. The vocabulary is searched
    for a piece with a mark after another character: without one, no merge crosses a pre-token's start,
    and the counts of the pre-tokens add up. With one, whole texts are encoded. `whole` holds the
    pieces proved, by encoding each alone, to be one token: a pre-token among them counts 1. The proof is made once,
    where `whole` is not given, and shipped to the workers.
    """

    MARK = "▁"

    def __init__(self, model: bytes, whole: frozenset[str] | None = None):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.splits = not any(re.search(f"[^{self.MARK}]{self.MARK}", p) for p in pieces) and self._plain()
        plain = [p for p in pieces if p.startswith(self.MARK) and self.splits] if whole is None else []
        self.whole = whole if whole is not None else frozenset(p[1:] for p, ids in zip(plain, self._ids([p[1:] for p in plain]), strict=True) if len(ids) == 1)
        self.lone = len(self.model.encode("a ")) - len(self.model.encode("a"))
        self._restart()

    def _restart(self) -> None:
        self.known = {**dict.fromkeys(self.whole, 1), "": self.lone}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []

    def _plain(self) -> bool:
        """Whether the model puts one mark in front and neither drops nor folds spaces."""
        probes = ["a", " a", "a  b ", "  "]
        return all("".join(self.model.encode(p, out_type=str)) == self.MARK + p.replace(" ", self.MARK) for p in probes)

    def counts(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return [len(x) for x in self._ids(texts)]
        split = [self.pretokens(t) if t else [] for t in texts]
        rest = list(set().union(*split).difference(self.known))
        fresh = {}
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            fresh.update((w, len(ids)) for w, ids in zip(part, self._ids(part), strict=True))
        if len(self.known) + len(fresh) > CACHED:
            look = {**self.known, **fresh}
            self._restart()
        else:
            self.known.update(fresh)
            look = self.known
        return [sum(map(look.__getitem__, words)) for words in split]

    def pretokens(self, text: str) -> list[str]:
        """Each without its first mark, which the model puts back."""
        if self.MARK in text or "  " in text or text[0] == " ":
            marked = self.MARK + text.replace(" ", self.MARK)
            return [p[1:].replace(self.MARK, " ") for p in re.findall(f"{self.MARK}+[^{self.MARK}]*", marked)]
        return text.split(" ")


def _slices(texts: list[str], most: int = 4 << 20):
    """Runs of texts of about `most` characters."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 4096) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit. One row for each input row, repeated ones too; a null or empty text has 0 tokens.

    Texts of any length are counted whole; over_limit is n_tokens > limit, so a text of just the limit is not over it. An
    empty table gives no rows; other columns do not matter. The model's file is read and the whole tokens are proved on
    the driver; both travel with the tasks (their size is that of a vocabulary).
    """
    with open(path or tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    key, whole = (zlib.crc32(model), len(model)), PieceCounter(model).whole

    def run(batches):
        counter = kept("pieces", key, lambda: PieceCounter(model, whole))
        for batch in batches:
            texts = [x.decode() for x in column_bytes(batch.column(1))]
            n = [c for part in _slices(texts) for c in counter.counts(part)]
            size = [len(x.encode()) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([c > limit for c in n], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_col].dataType
    return df.select(id_col, text_col).mapInArrow(run, T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`count_tokens` of all documents."""
    return count_tokens(spread(read_table(spark, sf_dir, "documents")))


#: A space after which the next character is white space: there, a text is not cut at every space.
_HARD = re.compile(r" (?:\s|$)")
_CUT = re.compile(r"(?= \S)")


#: Characters on whose classes all regular-expression engines agree, and the byte-level pre-tokeniser's public pattern.
_PLAIN = re.compile(r"[\t\n\x20-\x7e\u00a1-\u024f]+")
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _spelling() -> list[str]:
    """The character that byte-level vocabularies have for each byte: itself if printable, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


_SPELLED = _spelling()
_SPELL_ROW = {**dict(enumerate(_SPELLED)), 0: f" {_SPELLED[0]} ", 1: " "}


class ByteEncoder:
    """Token ids by the tokenizers library, each distinct chunk encoded once.

    Chunks begin at a space before a non-space character, where the byte-level pre-tokeniser always starts
    a new pre-token, so the ids of the chunks in a row are the ids of the text.

    With `added`, the strings of added tokens (such as <|endoftext|>) become these tokens wherever a text holds them, as
    the library does by itself: texts are first split at them, each part a text of its own. Where an added token has
    options of its own (stripping, single words), whole texts go to the library. Without `added`, strings of special
    tokens are text like any other.
    """

    def __init__(self, definition: str, width: str, added: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_str(definition)
        self.model.encode_special_tokens = not added
        self.width = width
        entries = self.model.get_added_tokens_decoder() if added else {}
        self.added = {t.content: np.array([i], width).tobytes() for i, t in entries.items() if t.content}
        plain = len({t.normalized for t in entries.values()}) < 2 and not any(t.single_word or t.lstrip or t.rstrip for t in entries.values())
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})")
        self.splits = type(self.model.pre_tokenizer).__name__ == "ByteLevel" and self.model.normalizer is None and plain
        self.known: dict[str, bytes] = {}
        vocabulary = self.model.get_vocab()
        self.mark = vocabulary.get(_SPELLED[0])
        self.joint = self.splits and self.mark is not None and [t for t in vocabulary if _SPELLED[0] in t] == [_SPELLED[0]]
        # in bytes' spelling no added token is to be found: what a text holds of them is cut out before
        self.merger = Tokenizer.from_str(json.dumps(json.loads(definition) | {"added_tokens": []}) if added else definition)
        self.merger.encode_special_tokens = True
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()

    def _ids(self, chunks: list[str]):
        """Each chunk with its ids. Plain chunks are cut into pre-tokens here and go to the library's merges in rows,
        spelled as the vocabulary spells bytes, with byte 0 (in no longer entry, as checked) after each chunk."""
        plain, rest = [], []
        for c in chunks:
            (plain if self.joint and _PLAIN.fullmatch(c) else rest).append(c)
        for c, x in zip(rest, self.model.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            yield c, np.array(x.ids, self.width).tobytes()
        rows = [plain[at : at + 500] for at in range(0, len(plain), 500)]
        spelled = ["".join("\1".join(_PRETOKEN.findall(c)) + "\0" for c in r).encode().decode("latin-1").translate(_SPELL_ROW) for r in rows]
        for row, x in zip(rows, self.merger.encode_batch_fast(spelled, add_special_tokens=False), strict=True):
            ids = np.array(x.ids, self.width)
            data, step, start = ids.tobytes(), ids.itemsize, 0
            for c, end in zip(row, np.flatnonzero(ids == self.mark).tolist(), strict=True):
                yield c, data[start * step : end * step]
                start = end + 1

    def chunks(self, text: str) -> tuple[str, list[str]]:
        """The first chunk, and the others without the space they begin with."""
        if not self.splits:
            return text, []
        if _HARD.search(text):
            first, *rest = _CUT.split(text)
            return first, [c[1:] for c in rest]
        first, *rest = text.split(" ")
        return first, rest

    def encode(self, texts: list[str]) -> list[bytes]:
        if not (self.splits and self.added):
            return self._encode(texts)
        parts = [self.cut.split(t) if any(a in t for a in self.added) else [t] for t in texts]
        found = iter(self._encode([x for p in parts for x in p[::2]]))
        return [b"".join(self.added[x] if k % 2 else next(found) for k, x in enumerate(p)) for p in parts]

    def _encode(self, texts: list[str]) -> list[bytes]:
        hard = [k for k, t in enumerate(texts) if not self.splits or _HARD.search(t)]
        out: list[bytes] = [b""] * len(texts)
        for k, ids in zip(hard, self._encode_each([texts[k] for k in hard]), strict=True):
            out[k] = ids
        known = set(hard)
        easy = [k for k in range(len(texts)) if k not in known]
        for k, ids in zip(easy, self._encode_easy([texts[k] for k in easy]), strict=True):
            out[k] = ids
        return out

    def _encode_easy(self, texts: list[str]) -> list[bytes]:
        """Texts cut at every space, all at once: a table of the ids of the distinct chunks, and the table's rows in order."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets, flat = np.asarray(split.offsets), split.values.dictionary_encode()
        words = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        firsts = list(dict.fromkeys(t.split(" ", 1)[0] for t in texts))
        look, own = self._look(words), dict(self._ids(firsts))
        entries = [look[w] for w in words] + [own[f] for f in firsts]
        row = np.asarray(flat.indices).astype(np.int64)
        place = {f: len(words) + k for k, f in enumerate(firsts)}
        row[offsets[:-1]] = [place[t.split(" ", 1)[0]] for t in texts]
        step = np.dtype(self.width).itemsize
        size = np.fromiter(map(len, entries), np.int64, len(entries)) // step
        start, length = (np.cumsum(size) - size)[row], size[row]
        ends = np.cumsum(length)
        table = np.frombuffer(b"".join(entries), self.width)
        ids = table[np.repeat(start - (ends - length), length) + np.arange(ends[-1])].tobytes()
        bounds = (np.concatenate([[0], ends])[offsets] * step).tolist()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _look(self, words: list[str]) -> dict[str, bytes]:
        """Ids of chunks by the chunk without the space it begins with, from the cache or anew."""
        rest = [w for w in words if w not in self.known]
        fresh = {}
        for at in range(0, len(rest), 20_000):
            fresh.update((c[1:], ids) for c, ids in self._ids([" " + w for w in rest[at : at + 20_000]]))
        if len(self.known) + len(fresh) > CACHED:
            look = {**self.known, **fresh}
            self.known = {}
            return look
        self.known.update(fresh)
        return self.known

    def _encode_each(self, texts: list[str]) -> list[bytes]:
        split = [self.chunks(t) for t in texts]
        look = self._look(list(set().union(*(words for _, words in split))))
        firsts = dict(self._ids(list({first for first, _ in split})))
        return [firsts[first] + b"".join(map(look.__getitem__, words)) for first, words in split]


class Store:
    """A folder of files reached through its URI: local (or mounted) paths are memory-mapped, others go through pyarrow."""

    def __init__(self, uri: str):
        from pyarrow import fs

        local = re.match(r"^(?:file:/*(?=/)|(?=/))", uri)
        self.local = bool(local)
        if local:
            self.fs, self.base = fs.LocalFileSystem(), uri[local.end() :]
        else:
            self.fs, self.base = fs.FileSystem.from_uri(uri)

    def write(self, name: str, parts) -> None:
        """Whole or not at all: written beside and renamed, so a repeated task replaces it with the same bytes."""
        self.fs.create_dir(self.base, recursive=True)
        beside = f"{self.base}/.{name}.{os.getpid()}.{os.urandom(4).hex()}"
        with self.fs.open_output_stream(beside) as out:
            for part in parts:
                out.write(part)
        self.fs.move(beside, f"{self.base}/{name}")

    def read(self, name: str, dtype: str) -> np.ndarray:
        path = f"{self.base}/{name}"
        if self.local:
            return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
        with self.fs.open_input_file(path) as f:
            return np.frombuffer(f.read(), dtype)


#: Bytes of texts, and so many for each row besides, of one part.
PART_BYTES, ROW_BYTES = 64 << 20, 64


def part_count(df: DataFrame, text_col: str) -> int:
    """Parts of a size, so that their number grows with the table and what a task holds does not; a part for each core at least."""
    size = df.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_BYTES)).first()[0] or 0
    return max(-(-size // PART_BYTES), df.sparkSession.sparkContext.defaultParallelism)


_MANIFEST = T.StructType([T.StructField("part", T.LongType()), T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType())])


def write_token_files(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 2, partitions: int | None = None, added: bool = False) -> DataFrame:
    """Writes flat files in ascending id order and returns their manifest (part, n_docs, n_ids, base_doc, base_id).

    Documents are dealt by ranges of the id, in `partitions` or else in parts of about PART_BYTES, and sorted within; equal ids go by
    text, null ids come first, null texts are empty. part-N.bin holds unsigned 16-bit (or, for larger vocabularies, 32-bit) little-endian ids,
    part-N.idx a 64-bit count n, n + 1 offsets within the part, n ids and n null flags. Bases are prefix sums
    over the manifest, of one row for each file. With `added`, strings of added tokens in a text become these tokens,
    the library's default; else they are spelled out.
    """
    with open(path or tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    from tokenizers import Tokenizer

    largest = max(Tokenizer.from_str(definition).get_vocab_size() - 1, end_id)
    width = "<u2" if largest < 1 << 16 else "<u4"
    key = (zlib.crc32(definition.encode()), width, added)
    spark = df.sparkSession
    n = partitions or part_count(df, text_col)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, store = kept("ids", key, lambda: ByteEncoder(definition, width, added)), Store(folder)
        ids, sizes, nulls = array("q"), array("q"), bytearray()
        end = np.array([end_id], width).tobytes()

        def encoded():
            for batch in batches:
                ids.frombytes(batch.column(0).fill_null(0).to_numpy().astype("<i8").tobytes())
                nulls.extend(batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
                for some in _slices([x.decode() for x in column_bytes(batch.column(1))], 2 << 20):
                    for found in encoder.encode(some):
                        sizes.append(len(found) // len(end) + 1)
                        yield found + end

        store.write(f"part-{part:06d}.bin", encoded())
        offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        index = (np.array([len(ids)]), offsets, np.array(ids, np.int64), np.array(nulls, np.uint8))
        store.write(f"part-{part:06d}.idx", (x.astype("<i8").tobytes() for x in index))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([int(offsets[-1])], pa.int64())], _MANIFEST.names)

    dealt = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).repartitionByRange(n, "id").sortWithinPartitions("id", "text")
    found = sorted(dealt.mapInArrow(run, _MANIFEST).collect())
    rows, docs, at = [], 0, 0
    for x in found:
        rows.append((x.part, x.n_docs, x.n_ids, docs, at, width))
        docs, at = docs + x.n_docs, at + x.n_ids
    return spark.createDataFrame(rows, "part long, n_docs long, n_ids long, base_doc long, base_id long, width string")


def read_token_files(manifest: DataFrame, folder: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """id, start (ids before the document), n_tokens and ids_crc32, from the files; `ids` too with with_ids."""
    fields = [T.StructField(id_col, T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def run(batches):
        store = Store(folder)
        for batch in batches:
            for x in batch.to_pylist():
                name = f"part-{x['part']:06d}"
                ids, index = store.read(f"{name}.bin", x["width"]), store.read(f"{name}.idx", "<i8")
                n = int(index[0])
                offsets, doc, null = index[1 : n + 2], index[n + 2 : 2 * n + 2], index[2 * n + 2 :]
                for at in range(0, n, 5000):
                    k = range(at, min(n, at + 5000))
                    each = [ids[offsets[i] : offsets[i + 1]] for i in k]
                    columns = [pa.array([None if null[i] else int(doc[i]) for i in k], pa.int64()), pa.array(offsets[k.start : k.stop] + x["base_id"], pa.int64()), pa.array(np.diff(offsets[k.start : k.stop + 1]), pa.int64()), pa.array([zlib.crc32(e.astype("<u4").tobytes()) for e in each], pa.int64())]
                    if with_ids:
                        columns.append(pa.array([e.tolist() for e in each], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    n = max(2 * manifest.sparkSession.sparkContext.defaultParallelism, manifest.count())
    return manifest.repartition(n).mapInArrow(run, T.StructType(fields))


def token_files(df: DataFrame, name: str = "tokens") -> DataFrame:
    """Writes the token files of df, ids as by the library's default, to the shared folder and reads them back.

    Nulls, ties, repeated rows and empty tables as in `write_token_files`; texts of any length are encoded whole.
    """
    folder = Scratch(df.sparkSession, name).path("files")
    return read_token_files(write_token_files(df, folder, added=True), folder)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`token_files` of all documents."""
    return token_files(read_table(spark, sf_dir, "documents"))
