"""Language identification by compression: each language's sample is a zstandard raw-content dictionary.

A text is lower-cased and cut into chunks; each chunk is compressed with every language's dictionary, and the
language with the smallest total wins. The margin to the next one gives the score, and a narrow margin marks a rejection.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_bytes, kept, map_arrow, read_table, spread

#: Bound of the learned sample: pieces of PIECE characters for each language, drawn from all pieces of all learned texts.
SAMPLE_PIECES, PIECE = 400, 512
#: Bytes compressed at a time, zstandard's level, and the least margin that is not rejected.
CHUNK, LEVEL, MARGIN = 2048, 6, 0.01
_LETTER = regex.compile(r"\p{L}")


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_dictionaries(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_pieces: int = SAMPLE_PIECES, piece: int = PIECE) -> dict[str, bytes]:
    """A dictionary of each non-null language from sample_pieces pieces of its documents' texts, lowest hash of id and place first.

    Every piece of every text, to its end, is as likely as another. Rows without a text, language or id do not count; rows
    that share an id are texts of their own, equal ones count once. Ties of the hash go by the piece itself, so reruns and
    other partitions give the same. A first pass counts pieces, a second fetches those below a hash at which twice the
    sample is expected: a bounded number of rows for each language reaches the driver. An empty table, or one without
    languages, gives no dictionaries.
    """
    known = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.withColumn("n", F.ceil(F.length("text") / piece)).where("n > 0")
    counts = {r[0]: r[1] for r in known.groupBy("lang").agg(F.sum("n")).collect()}
    if not counts:
        return {}
    limits = F.broadcast(df.sparkSession.createDataFrame([(lang, min(2**63 - 1, 2**64 * sample_pieces // n)) for lang, n in counts.items()], "lang string, most long"))
    hash_of = lambda k: F.shiftrightunsigned(F.xxhash64("id", k), 1)
    places = F.filter(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda k: hash_of(k) <= F.col("most"))
    drawn = known.join(limits, "lang").select("id", "lang", "text", F.explode(places).alias("k"))
    pieces = drawn.select("lang", hash_of("k"), F.col("text").substr((F.col("k") * piece).cast("int") + 1, F.lit(piece)))
    found: dict[str, set] = {}
    for lang, value, text in pieces.collect():
        found.setdefault(lang, set()).add((value, text.lower().encode()))
    return {lang: b"\n".join(x for _, x in sorted(each)[:sample_pieces]).ljust(8, b"\n") for lang, each in sorted(found.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.by = [self._with(dictionaries[lang]) for lang in self.langs]

    @staticmethod
    def _with(data: bytes):
        import zstandard as z

        d = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        return z.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False).compress

    def sizes(self, text: bytes) -> list[int]:
        chunks = [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]
        return [sum(len(compress(c)) for c in chunks) for compress in self.by]

    def predict(self, text: bytes) -> tuple[str, float, float]:
        """Language, score and margin. The smallest size wins, a tie goes to the first in code-point order."""
        folded = text.decode("utf-8", "replace").lower()
        if not self.by or not _LETTER.search(folded):
            return "und", 0.0, 0.0
        sizes = self.sizes(folded.encode())
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        if len(order) == 1:
            return self.langs[0], 1.0, 1.0
        second = sizes[order[1]]
        return self.langs[order[0]], second / (best + second), (second - best) / second


def identify(df: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """id, lang_pred, score (0 to 1), margin, rejected (margin below the least one), for each input row.

    `und`, score 0, rejected: a null or empty text, one without letters (Unicode categories L), or no dictionaries. Texts of
    any length go through whole, in chunks. Ties go to the first language in code-point order. Equal texts get equal
    answers, repeated rows too; an empty table gives no rows, and other columns do not matter.
    """
    key = zlib.crc32(repr(sorted(dictionaries.items())).encode())

    def run(batches):
        model = kept("languages", key, lambda: Classifier(dictionaries))
        for batch in batches:
            found = [model.predict(text) for text in column_bytes(batch.column(1))]
            lang, score, gap = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(gap, pa.float64()), pa.array([g < margin for g in gap], pa.bool_())], [id_col, "lang_pred", "score", "margin", "rejected"])

    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return map_arrow(df.select(id_col, text_col), run, T.StructType(fields))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`identify` of all documents by what those that are not held out teach."""
    docs = spread(read_table(spark, sf_dir, "documents"))
    found = identify(docs, learn_dictionaries(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")
