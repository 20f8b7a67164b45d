"""Periodic runs of words by Lyndon arrays on an ordered alphabet, without suffix structures or hashes.

A run's Lyndon root is, in one of the two orders of the alphabet, the longest Lyndon word at its start; it ends where the
next smaller suffix begins. So for each order the next smaller suffixes are found with a stack, and with each the length
that both suffixes share. Of what was matched last, up to a rightmost place, later suffixes take their lengths over from
the part that they repeat, and only compare words beyond that place, so all comparisons together are linear in the words.
A shared length to the right and one to the left then tell whether there is a run and where it ends.

Words outside of every repeated window of six words can be in no run of twelve, so they are cut out first; windows are
named by sorting the names of their halves, for all texts of a batch at once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_bytes, map_arrow, read_table, release, sized, spread

#: Words of the shortest run.
LEAST = 12

Run = tuple[int, int, int]


def next_smaller(w: list) -> tuple[list[int], list[int]]:
    """For each place where its next smaller suffix begins (len(w): nowhere), and how many words the two share.

    A suffix that is a prefix of another is the smaller. `begin`, `back` and `reach` are the last match that came as far as any:
    w[begin:reach] repeats what stands `back` words before.
    """
    n = len(w)
    following, shared, previous, held = [n] * n, [0] * n, [-1] * n, [0] * n
    begin, back, reach = 0, 0, 0
    for i in range(1, n):
        q, m, popped = i - 1, 0, -1
        while True:
            grow = True
            if q >= begin and i < reach:
                b, c = q - back, i - back
                if b >= 0 and following[b] == c:
                    m = shared[b]
                elif c >= 0 and previous[c] == b:
                    m = held[c]
                else:
                    m = 0
                if i + m < reach:
                    grow = m == 0 and not (b >= 0 and (following[b] == c or previous[c] == b))
                else:
                    m = reach - i
            elif popped >= 0:
                x = held[popped]
                if x != m:
                    grow = False
                    if x < m:
                        m = x
            k = i + m
            if grow:
                at = q + m
                while k < n and w[at] == w[k]:
                    at += 1
                    k += 1
                m = k - i
                if k >= reach:
                    begin, back, reach = i, i - q, k
            if k < n and w[q + m] < w[k]:
                previous[i], held[i] = q, m
                break
            following[q], shared[q], popped = i, m, q
            q = previous[q]
            if q < 0:
                break
    return following, shared


def runs(w: list[int], least: int = LEAST) -> list[Run]:
    """(start, length, period) of all runs of at least `least` words, by start and period."""
    found, n = set(), len(w)
    for order in (w, [-x for x in w]):
        following, shared = next_smaller(order)
        for i, (j, right) in enumerate(zip(following, shared, strict=True)):
            if j == n:
                continue
            period = j - i
            left = max(0, period - right)
            if left and (left > i or w[i - 1] != w[j - 1] or w[i - left : i] != w[j - left : j]):
                continue
            while left < period and left < i and w[i - left - 1] == w[j - left - 1]:
                left += 1
            if left < period and period + left + right >= least:  # with a whole period to the left the run is that of i - period
                found.add((i - left, period + left + right, period))
    return sorted(found, key=lambda x: (x[0], x[2]))


def repeated(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which words lie in a window of six words that stands twice in their text. words, doc: numbers of words and texts, in order.

    A run of `n >= 12` words with period q <= n / 2 is covered by windows that begin in its first n - q - 5 words, each
    repeated q words on, and their copies.
    """
    n = len(words)
    names = {1: _named(doc * (int(words.max(initial=0)) + 1) + words)}
    for size, first, second in ((2, 1, 1), (4, 2, 2), (6, 4, 2)):
        a, b = names[first], names[second]
        out = np.full(n, -1, np.int64)
        at = np.flatnonzero(a[: max(0, n - first)] >= 0)
        at = at[(b[at + first] >= 0) & (at + size <= n)]
        at = at[doc[np.minimum(at + size - 1, n - 1)] == doc[at]]
        out[at] = _named(a[at] * n + b[at + first])
        names[size] = out
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(names[6] >= 0)
    edge[at] += 1
    edge[at + 6] -= 1
    return np.cumsum(edge[:-1]) > 0


def _named(keys: np.ndarray) -> np.ndarray:
    """Numbers under len(keys), equal for equal keys; -1 for a key that stands once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(keys)))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(np.where(size > 1, at, -1), size)
    return out


def texts_runs(texts: list[list[bytes]], least: int = LEAST) -> Iterator[list[Run]]:
    """The runs of each text's words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    number: dict[bytes, int] = {}
    flat = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    inside = repeated(flat, np.repeat(np.arange(len(texts)), sizes)) if least >= LEAST else np.ones(len(flat), bool)
    end = np.cumsum(sizes)
    for first, last in zip((end - sizes).tolist(), end.tolist(), strict=True):
        out: list[Run] = []
        edge = np.flatnonzero(np.diff(inside[first:last], prepend=False, append=False)).reshape(-1, 2)
        for a, b in edge[edge[:, 1] - edge[:, 0] >= least].tolist():
            out += [(a + s, size, p) for s, size, p in runs(flat[first + a : first + b].tolist(), least)]
        yield out


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those that a run holds beyond its first period."""
    if not found:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """Words that for one id in ten repeat a period of theirs up to the end; a null id changes nothing."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


SPAN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])
_SPANS = pa.list_(pa.struct([(f.name, pa.int64()) for f in SPAN]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, change=None) -> DataFrame:
    """id, n_words, `runs` (array of start, length, period, by start and period) and `collapsed`, the text with each run cut
    to its first period and one space between words; a row for each input row.

    Words lie between ASCII white space and count as they stand. `change(id, words)` may put other words in place of a text's.
    Null and empty texts have no words and an empty `collapsed`; ids may be null or repeated, and repeated rows are rows of their
    own. Runs of equal length all count. A text is one row and is taken whole, in memory of a few hundred bytes for each word that a
    repeated window covers. An empty table gives no rows; other columns do not matter.
    """

    def run(batches):
        release()
        for part in sized(batches, 1):
            ids = part.column(0).to_pylist()
            texts = [t.split() for t in column_bytes(part.column(1))]
            if change:
                texts = [change(i, t) for i, t in zip(ids, texts, strict=True)]
            found = list(texts_runs(texts, least))
            spans = pa.array([[dict(zip(SPAN.names, x, strict=True)) for x in f] for f in found], _SPANS)
            text = pa.array([b" ".join(collapsed(t, f)) for t, f in zip(texts, found, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), spans, text.cast(pa.string())], [id_col, "n_words", "runs", "collapsed"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(SPAN)), T.StructField("collapsed", T.StringType())])
    return map_arrow(docs.select(id_col, text_col), run, schema)


def op12_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`periodic_runs` of all documents, one in ten of which repeats a period of its own; the longest run and digests."""
    found = periodic_runs(spread(read_table(spark, sf_dir, "documents")), change=planted)
    longest = F.get(F.array_sort(F.transform("runs", lambda x: F.struct((-x["length"]).alias("size"), x["start"].alias("start"), x["period"].alias("period")))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.size")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.size) div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
