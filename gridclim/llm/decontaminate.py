"""Benchmark decontamination by suffix arrays of the training text.

Each shard (a run of about SHARD_WORDS words of the documents) gets a suffix array over all its words: suffixes sorted by
their words, as far as a word that no test item has, by prefix doubling. Every test suffix is binary-searched in every
shard's array, word by word, which narrows to the places of its window and on to those of its longest match; matches
shorter than the window are dropped, and what is left is compared word by word.

`decontaminate` and `drop_contaminated` ask which words are hit, so there each distinct window is searched once, and a place
counts for it once, however many items and places in items have it: what is held grows with the shard alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import U64, Scratch, column_bytes, map_arrow, read_table, release, slices, spread, word_hashes, word_list

WINDOW = 10
#: Words of test items that one broadcast holds; a larger benchmark goes in several, one after the other.
BLOCK_WORDS = 2_000_000
#: Words of a shard, and rows of a batch that are searched together.
SHARD_WORDS, ROWS = 1 << 20, 1000
#: Places, or pairs of documents and windows, that are handled together.
SLICE = 1 << 20


@dataclass
class TestSuffixes:
    """Items' words as numbers (1 and up, by the order of their hashes), end to end, each item followed by a number that no
    text has; and the windows: where each begins, its item and its length. `words` are the items' own words."""

    vocabulary: np.ndarray
    numbers: np.ndarray
    first: np.ndarray
    start: np.ndarray
    item: np.ndarray
    length: np.ndarray
    words: list[list[bytes]]
    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    known: tuple | None = None

    def distinct(self) -> tuple[TestSuffixes, dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
        """The windows, each once; the words' numbers by the words themselves, and the items' words so numbered; and the items that
        have each window, with where each window's begin."""
        if self.known:
            return self.known
        index: dict[bytes, int] = {}
        exact = np.zeros(len(self.numbers) + 1, np.int64)
        for first, words in zip(self.first.tolist(), self.words, strict=True):
            exact[first : first + len(words)] = [index.setdefault(w, len(index) + 1) for w in words]
        start, length, window, item = ([np.zeros(0, np.int64)] for _ in range(4))
        n = 0
        for size in np.unique(self.length).tolist():
            own = np.flatnonzero(self.length == size)
            name, span = exact, 1
            while span < size:
                step = min(span, size - span)
                name = np.unique(name[:-step] * (len(exact) + 1) + name[step:], return_inverse=True)[1]
                span += step
            _, at, which = np.unique(name[self.start[own]], return_index=True, return_inverse=True)
            pairs = np.unique(np.stack([which + n, self.item[own]]), axis=1)
            for into, x in zip((start, length, window, item), (self.start[own][at], np.full(len(at), size), *pairs), strict=True):
                into.append(x)
            n += len(at)
        start, length, window, item = (np.concatenate(x) for x in (start, length, window, item))
        self.known = replace(self, start=start, length=length, item=np.zeros(n, np.int64)), index, exact, item, np.searchsorted(window, np.arange(n + 1))
        return self.known

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number, 0 for words that no item has."""
        n = len(self.vocabulary)
        if not n:
            return np.zeros(len(hashes), np.int64)
        if not len(self.slots):
            size = 1 << max(16, n.bit_length() + 3)
            self.slots = np.full(size, -1, np.int32)
            at = (self.vocabulary & U64(size - 1)).astype(np.int64)
            self.slots[at] = np.arange(n)
            self.slots[np.flatnonzero(np.bincount(at, minlength=size) > 1)] = n
        guess = self.slots[(hashes & U64(len(self.slots) - 1)).astype(np.int64)].astype(np.int64)
        shared = np.flatnonzero(guess == n)
        guess[shared] = np.minimum(np.searchsorted(self.vocabulary, hashes[shared]), n - 1)
        return np.where((guess >= 0) & (self.vocabulary[guess] == hashes), guess + 1, 0)


def test_suffixes(items: list[tuple[object, bytes]], window: int = WINDOW) -> TestSuffixes:
    """All windows of the items; `item` counts items in the order given. Items without words have none."""
    hashes, first = word_hashes(pa.array([t for _, t in items], pa.binary()), "alnum")
    vocabulary = np.unique(hashes)
    numbers = np.full(len(hashes) + len(items), len(vocabulary) + 1, np.int64)
    sizes = np.diff(first)
    begin = first[:-1] + np.arange(len(items))
    numbers[np.arange(len(hashes)) + np.repeat(np.arange(len(items)), sizes)] = np.searchsorted(vocabulary, hashes) + 1
    size = np.minimum(window, sizes)
    n = np.where(size > 0, sizes - size + 1, 0)
    item = np.repeat(np.arange(len(items)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[item]
    return TestSuffixes(vocabulary, numbers, begin, start, item, size[item], [word_list(t, "alnum") for _, t in items])


class SuffixArray:
    """All suffixes of a shard in the order of their words, up to a word of number 0 or `depth` words."""

    def __init__(self, numbers: np.ndarray, largest: int, depth: int):
        n = len(numbers)
        self.numbers, self.bits = numbers, max(1, int(largest).bit_length())
        self.packed = max(1, min(62 // self.bits, depth))
        key = np.zeros(n, np.int64)
        wide = np.concatenate([numbers, np.zeros(self.packed, np.int64)])
        for j in range(self.packed):
            key = key << self.bits | wide[j : n + j]
        self.places = np.argsort(key)
        self.keys = key[self.places]
        new = np.ones(n, bool)
        new[1:] = self.keys[1:] != self.keys[:-1]
        self._refine(new, depth)

    def _refine(self, new: np.ndarray, depth: int) -> None:
        """Prefix doubling: suffixes alike in `span` words are sorted by the ranks of the suffixes `span` words on."""
        n, span = len(self.numbers), self.packed
        ends = np.append(np.flatnonzero(self.numbers == 0), n)
        reach = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
        rank = np.zeros(n + 1, np.int64)
        first = np.flatnonzero(new)
        rank[self.places] = np.repeat(first, np.diff(np.append(first, n))) + 1
        while span < depth:
            alone = new & np.append(new[1:], True)
            open_ = np.flatnonzero(~alone & (reach[self.places] > span))
            if not len(open_):
                break
            place = self.places[open_]
            key = rank[place] * (n + 2) + rank[np.minimum(place + span, n)]
            order = np.argsort(key)
            self.places[open_], key = place[order], key[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[1:] != key[:-1]
            new[open_[fresh]] = True
            at = np.flatnonzero(fresh)
            rank[self.places[open_]] = np.repeat(open_[at], np.diff(np.append(at, len(key)))) + 1
            span *= 2

    def search(self, test: TestSuffixes, on: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each test suffix the range of places at which its window stands (low, high), and the words of its longest match,
        0 where that is shorter than the window: binary searches, for the first few words at once and then word by word. Without
        `on` not beyond the window."""
        known = np.minimum(self.packed, test.length)
        prefix = np.zeros(len(test.start), np.int64)
        for j in range(self.packed):
            word = test.numbers[np.minimum(test.start + j, len(test.numbers) - 1)]
            prefix = prefix << self.bits | np.where(j < known, word, 0)
        width = np.int64(1) << (self.bits * (self.packed - known))
        low, high = np.searchsorted(self.keys, prefix), np.searchsorted(self.keys, prefix + width)
        out_low, out_high, longest = np.zeros_like(low), np.zeros_like(high), np.zeros(len(low), np.int64)
        open_, have = np.flatnonzero(low < high), known
        low, high, have = low[open_], high[open_], known[open_]
        while len(open_):
            whole = have == test.length[open_]
            out_low[open_[whole]], out_high[open_[whole]] = low[whole], high[whole]
            longest[open_] = np.where(have >= test.length[open_], have, 0)
            if not on:
                open_, low, high, have = open_[~whole], low[~whole], high[~whole], have[~whole]
            word = test.numbers[np.minimum(test.start[open_] + have, len(test.numbers) - 1)]
            low, high = self._bound(low, high, word, have, False), self._bound(low, high, word, have, True)
            going = low < high
            open_, low, high, have = open_[going], low[going], high[going], have[going] + 1
        return out_low, out_high, longest

    def _bound(self, low: np.ndarray, high: np.ndarray, word: np.ndarray, at: np.ndarray, after: bool) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            place = self.places[np.minimum(middle, len(self.places) - 1)] + at
            value = np.where(place < len(self.numbers), self.numbers[np.minimum(place, len(self.numbers) - 1)], 0)
            right = open_ & ((value <= word) if after else (value < word))
            low = np.where(right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low


def window_places(flat: np.ndarray, test: TestSuffixes, window: int, shard_words: int = SHARD_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The test suffix and the place of every window found in flat, shard by shard; shards overlap by a window less a word."""
    rows = []
    largest, depth = len(test.vocabulary) + 1, int(np.diff(np.append(test.first, len(test.numbers))).max(initial=1))
    for at in range(0, len(flat) if len(test.start) else 0, shard_words):
        array = SuffixArray(flat[at : at + shard_words + window - 1], largest, depth)
        low, high, _ = array.search(test)
        n = high - low
        which = np.repeat(np.arange(len(n)), n)
        place = array.places[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        own = place < shard_words
        rows.append((which[own], place[own] + at))
    return tuple(np.concatenate(x) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 2


def shard_matches(texts: pa.Array, test: TestSuffixes, window: int = WINDOW, shard_words: int | None = None) -> tuple[np.ndarray, list[tuple[int, int, int, int, int]]]:
    """Each text's number of words, and the maximal matches: (text, item, test_word, doc_word, n_words).

    Windows of an item that follow each other in a text are joined, so each match is as long as it can be; its words are
    compared themselves, so that equal hashes alone do not count.
    """
    hashes, first = word_hashes(texts, "alnum")
    sizes = np.diff(first)
    begin = first[:-1] + np.arange(len(sizes))
    flat = np.zeros(len(hashes) + len(sizes), np.int64)
    flat[np.arange(len(hashes)) + np.repeat(np.arange(len(sizes)), sizes)] = test.number(hashes)
    which, place = window_places(flat, test, window, shard_words or SHARD_WORDS)
    item, at_test = test.item[which], test.start[which]
    order = np.lexsort([place, place - at_test, item])
    item, at_test, place, size = item[order], at_test[order], place[order], test.length[which][order]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (place[1:] - at_test[1:] != place[:-1] - at_test[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(item))[: len(head)] - 1
    doc = np.searchsorted(begin, place[head], "right") - 1
    out, known = [], {}
    for d, i, t, p, n, least in zip(doc.tolist(), item[head].tolist(), (at_test[head] - test.first[item[head]]).tolist(), (place[head] - begin[doc]).tolist(), (place[tail] + size[tail] - place[head]).tolist(), size[head].tolist(), strict=True):
        if d not in known:
            known = {d: word_list(next(column_bytes(texts.slice(d, 1))), "alnum")}
        same = [x == y for x, y in zip(known[d][p : p + n], test.words[i][t : t + n], strict=True)]
        run = 0
        for k, x in enumerate([*same, False]):
            if x:
                run += 1
            elif run >= least:
                out.append((d, i, t + k - run, p + k - run, run))
            run = run if x else 0
    return sizes, out


def _dealt(counts: np.ndarray, most: int):
    """Runs of entries whose counts add up to about `most`, an entry alone if it has more: first and last, and a repeat of each entry with
    its place within."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        n = counts[at:end]
        yield np.repeat(np.arange(at, end), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = end


def shard_hits(texts: pa.Array, test: TestSuffixes, window: int = WINDOW, shard_words: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's number of words; the stretches of hit words (text, first word, words), which neither overlap nor touch; and the pairs
    (text, item) of items with a window in the text.

    Memory follows the words of the texts: a place counts once for each length of windows, in slices.
    """
    shard_words = shard_words or SHARD_WORDS
    hashes, first = word_hashes(texts, "alnum")
    sizes = np.diff(first)
    begin = first[:-1] + np.arange(len(sizes))
    flat = np.zeros(len(hashes) + len(sizes), np.int64)
    flat[np.arange(len(hashes)) + np.repeat(np.arange(len(sizes)), sizes)] = test.number(hashes)
    windows, index, item_words, owner, owner_first = test.distinct()
    exact, seen = np.zeros(len(flat) + window, np.int32), np.zeros(len(sizes), bool)
    edge, pairs, n_windows = np.zeros(len(flat) + 1, np.int32), [np.zeros(0, np.int64)], max(1, len(windows.start))
    for shard in range(0, len(flat) if len(windows.start) else 0, shard_words):
        array = SuffixArray(flat[shard : shard + shard_words + window - 1], len(test.vocabulary) + 1, window)
        low, high, _ = array.search(windows, on=False)
        for size in np.unique(windows.length[high > low]).tolist():
            own = np.flatnonzero((high > low) & (windows.length == size))
            for which, nth in _dealt((high - low)[own], SLICE):
                which = own[which]
                place = array.places[low[which] + nth]
                which, place = which[place < shard_words], place[place < shard_words] + shard
                doc = np.searchsorted(begin, place, "right") - 1
                for d in np.unique(doc[~seen[doc]]).tolist():
                    seen[d] = True
                    exact[begin[d] : begin[d] + sizes[d]] = [index.get(w, 0) for w in word_list(next(column_bytes(texts.slice(d, 1))), "alnum")]
                same = np.ones(len(place), bool)
                for j in range(size):
                    same &= exact[place + j] == item_words[windows.start[which] + j]
                which, place, doc = which[same], place[same], doc[same]
                np.add.at(edge, place, 1)
                np.add.at(edge, place + size, -1)
                pairs.append(np.unique(doc * n_windows + which))
    cover = np.diff((np.cumsum(edge[:-1]) > 0).astype(np.int8), prepend=0, append=0)
    head, tail = np.flatnonzero(cover == 1), np.flatnonzero(cover == -1)
    doc = np.searchsorted(begin, head, "right") - 1
    found = np.unique(np.concatenate(pairs))
    of_doc, of_window = found // n_windows, found % n_windows
    items, n_items = [np.zeros(0, np.int64)], max(1, len(test.first))
    for which, nth in _dealt(np.diff(owner_first)[of_window] if len(found) else found, SLICE):
        items.append(np.unique(of_doc[which] * n_items + owner[owner_first[of_window[which]] + nth]))
    both = np.unique(np.concatenate(items))
    return sizes, np.stack([doc, head - begin[doc] if len(doc) else doc, tail - head]), np.stack([both // n_items, both % n_items])


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int = BLOCK_WORDS):
    """The items in runs of about block_words words, read one partition at a time."""
    part, size = [], 0
    for item, text in benchmark.select(item_col, text_col).orderBy(item_col, text_col).toLocalIterator():
        data = (text or "").encode()
        part.append((item, data))
        size += len(data) // 2 + 1
        if size >= block_words:
            yield part
            part, size = [], 0
    if part:
        yield part


def _passes(rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, window: int, step: Callable, last: Callable, last_schema: T.StructType, block_words: int) -> DataFrame:
    """Rows after one pass for each block of items: step(batches, block), and last for the last one. Passes before the last are
    written and their block is freed, so that one block is live at a time."""
    spark, blocks, k = rows.sparkSession, benchmark_blocks(benchmark, item_col, text_col, block_words), 0
    scratch, block = Scratch(spark, "decontaminate"), next(blocks, [])
    while True:
        held = spark.sparkContext.broadcast(([i for i, _ in block], test_suffixes(block, window)))
        block = next(blocks, None)
        if block is None:
            return rows.mapInArrow(lambda batches, held=held: last(batches, *held.value), last_schema)
        rows = scratch.save(map_arrow(rows, lambda batches, held=held: step(batches, *held.value), rows.schema), f"block-{k}")
        scratch.drop(f"block-{k - 1}")
        held.destroy()
        k += 1


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """id, n_words and `spans`: array of (item, test_word, doc_word, n_words), the longest verbatim matches with the
    items' windows of `window` words, for each input row; spans is empty where nothing matches.

    A-Z are lower-cased; words are runs of letters, digits and bytes from 0x80. An item of fewer words than a window
    is one window. Nulls and empty texts have no words; repeated items match alike, and ids of items keep their type, null
    included. Texts of any length are searched whole, in shards that overlap. Repeated rows are rows of their own; there are
    no ties to break, as every match counts. Empty documents give no rows, an empty benchmark no matches; other columns do
    not matter. The benchmark is broadcast in blocks of a bounded size, one at a time.
    """
    kind = T.ArrayType(T.StructType([T.StructField("item", benchmark.schema[item_col].dataType), *[T.StructField(x, T.LongType()) for x in ("test_word", "doc_word", "n_words")]]))
    arrow = to_arrow_type(kind)
    own = T.StructField(id_col, docs.schema[id_col].dataType)

    def search(batches, ids, test):
        release()
        for batch in slices(batches, ROWS):
            spans = batch.column(2).to_pylist()
            n, found = shard_matches(batch.column(1), test, window)
            for doc, item, *rest in found:
                spans[doc].append(dict(zip(("item", "test_word", "doc_word", "n_words"), (ids[item], *rest), strict=True)))
            yield batch, n, pa.array(spans, arrow)

    def step(batches, ids, test):
        for batch, _, spans in search(batches, ids, test):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans], [id_col, "_text", "spans"])

    def last(batches, ids, test):
        for batch, n, spans in search(batches, ids, test):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), spans], [id_col, "n_words", "spans"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.array().cast(kind).alias("spans"))
    return _passes(rows, benchmark, item_col, item_text_col, window, step, last, T.StructType([own, T.StructField("n_words", T.LongType()), T.StructField("spans", kind)]), block_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows, with all their columns, in which no item has a window, as for `decontaminate`."""
    at = docs.columns.index(text_col)

    def step(batches, _, test):
        release()
        for batch in slices(batches, ROWS):
            clean = np.ones(batch.num_rows, bool)
            clean[shard_hits(batch.column(at), test, window)[1][0]] = False
            yield batch.filter(pa.array(clean))

    return _passes(docs, benchmark, item_col, item_text_col, window, step, step, docs.schema, block_words)


def hit_words():
    """The number of words that at least one span covers."""
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["doc_word"].alias("a"), (s["doc_word"] + s["n_words"]).alias("b"))))
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"), F.greatest(acc["end"], s["b"]).alias("end"))
    return F.aggregate(ordered, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")), step)["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """For each document n_words, n_hit (words in windows of items), `items` (ids as strings, sorted, each once), `spans` (stretches of hit
    words: doc_word, n_words) and whether it is contaminated.

    Nulls, empty and very long texts, repeated rows and ids, empty tables and other columns as in `matches`. Texts and items that
    repeat words very often take no more memory than others.
    """
    kind = T.ArrayType(benchmark.schema[item_col].dataType)
    span = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("doc_word", "n_words")]))
    own, arrow, span_arrow = T.StructField(id_col, docs.schema[id_col].dataType), to_arrow_type(kind), to_arrow_type(span)

    def search(batches, ids, test):
        release()
        for batch in slices(batches, ROWS):
            n, stretches, pairs = shard_hits(batch.column(1), test, window)
            spans, items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for doc, at, size in stretches.T.tolist():
                spans[doc].append({"doc_word": at, "n_words": size})
            for doc, item in pairs.T.tolist():
                items[doc].append(ids[item])
            yield batch, n, pa.array(spans, span_arrow), pa.array(items, arrow)

    def step(batches, ids, test):
        for batch, _, spans, items in search(batches, ids, test):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans, items], [id_col, "_text", "spans", "items"])

    def last(batches, ids, test):
        for batch, n, spans, items in search(batches, ids, test):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), spans, items], [id_col, "n_words", "spans", "items"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.array().cast(span).alias("spans"), F.array().cast(kind).alias("items"))
    schema = T.StructType([own, T.StructField("n_words", T.LongType()), T.StructField("spans", span), T.StructField("items", kind)])
    found = _passes(rows, benchmark, item_col, item_text_col, window, step, last, schema, block_words)
    names = F.array_sort(F.array_distinct(F.transform("items", lambda x: x.cast("string"))))
    return found.select(id_col, "n_words", hit_words().alias("n_hit"), names.alias("items"), "spans").withColumn("contaminated", F.col("n_hit") > 0)


def op10_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`decontaminate` of all documents against all items, with the items as a digest of their sorted ids."""
    found = decontaminate(spread(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
