"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, and the queries on a small table."""

import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from gridclim.llm import chat, common, decontaminate, langid, mixing, queries, setsketch, suffixes, tokens, toxicity

SF = "/root/testdata/sf0.001"
CLASH = "'a' AS h, 'b' AS g, 'c' AS component_id, 'd' AS kept, 'e' AS spans, 'f' AS n_words, 'g' AS size, 'h' AS taken, 'i' AS toxic, 'j' AS score, 'k' AS lang_pred, 'l' AS starts, 'm' AS n_tokens, 'n' AS node, 'o' AS words, 'p' AS _h, 'q' AS _of, 'r' AS _text"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def long_docs(spark):
    """Texts of a megabyte and more beside short ones; repeated rows, nulls, empties, ties."""
    rng = np.random.default_rng(17)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    long = " ".join(rng.choice(words, 200_000))
    near = " ".join([*long.split(" ")[:199_990], *["other"] * 10])
    rows = [(1, long), (2, near), (3, long), (4, " ".join(words[:300])), (4, " ".join(words[:300])), (5, None), (6, ""), (None, None), (None, "some words here"), (7, "x" * 1_200_000)]
    return spark.createDataFrame([(k, t, "en", "s1", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars int").selectExpr("*", *CLASH.split(", "))


def test_very_long_texts_and_clashing_columns(spark, long_docs):
    near = {(r.doc_id, r.n_shingles): r.component_id for r in setsketch.near_duplicates(long_docs).collect()}
    assert {k: v for (k, _), v in near.items()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, None: None, 7: 7} and len(near) == 9
    repeated = {r.doc_id: r.n_bytes - len(r.kept) for r in suffixes.remove_repeats(long_docs.where("doc_id < 7")).collect()}
    size = {r.doc_id: r.n for r in long_docs.selectExpr("doc_id", "octet_length(text) n").collect()}
    assert repeated[1] == size[1] and repeated[3] == size[3] and size[2] - 80 <= repeated[2] <= size[2] and repeated[4] == size[4] and repeated[5] == repeated[6] == 0
    item = long_docs.where("doc_id = 1").first().text.split(" ")[123_000:123_050]
    bench = spark.createDataFrame([("a", " ".join(item)), ("b", None), ("c", "")], "item_id string, text string")
    hit = {r.doc_id: r.n_hit for r in decontaminate.decontaminate(long_docs, bench).collect()}
    assert {k for k, n in hit.items() if n} == {1, 2, 3} and hit[1] >= 50
    counted = {r.doc_id: r.n_tokens for r in tokens.count_tokens(long_docs.where("doc_id in (1, 4, 5, 6)")).collect()}
    assert counted[1] > 200_000 and counted[5] == counted[6] == 0
    taken = mixing.mix(long_docs).taken.collect()
    assert len(taken) == 10 and sum(r.size for r in taken) == sum(len((r.text or "").split()) for r in long_docs.collect())
    assert mixing.mixed_documents(long_docs).columns == long_docs.columns == setsketch.drop_near_duplicates(long_docs).columns == decontaminate.drop_contaminated(long_docs, bench).columns
    model = toxicity.train(long_docs, spark.createDataFrame([(1, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int"))
    assert toxicity.score(long_docs, model).count() == 10 and toxicity.drop_toxic(long_docs, model).columns == long_docs.columns
    assert langid.identify(long_docs, langid.learn_dictionaries(long_docs)).where("doc_id = 1 and lang_pred = 'en'").count() == 1


def test_a_long_conversation_with_clashing_columns(spark):
    turns = spark.createDataFrame([(1, k, f"p{k % 2}", "w" * (1_000_000 if k == 3 else k)) for k in range(40)], "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS said", "2 AS speaker", "3 AS perspective", "4 AS n", "5 AS block", "6 AS segment")
    rows = chat.rotate(turns, block_turns=8).collect()
    assert len(rows) == 80 and {r.perspective for r in rows} == {"p0", "p1"}
    for p in ("p0", "p1"):
        view = sorted((r for r in rows if r.perspective == p), key=lambda r: r.char_start)
        assert [r.char_start for r in view] == [0, *[r.char_end for r in view[:-1]]] and [r.turn for r in view] == list(range(40))


def test_ties_of_languages_and_thresholds(spark):
    docs = spark.createDataFrame([(1, "qq")], "doc_id long, text string")
    assert langid.identify(docs, {"b": b"zzzzzzzz", "a": b"zzzzzzzz"}).first().lang_pred == "a"
    model = toxicity.Chain(["toxic"], {"qq": 0}, [[0]], [np.array([0.0, 0.0])], 0.5)
    assert toxicity.score(docs, model).first().toxic and toxicity.drop_toxic(docs, model).count() == 0


def test_every_stage_takes_an_empty_table(spark, documents):
    docs = documents.where("false").selectExpr("*", *CLASH.split(", "))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_stages_keep_columns_of_any_name(spark, documents):
    docs = documents.limit(60).selectExpr("*", *CLASH.split(", "))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name


def test_tables_by_either_writer(spark):
    rows = spark.range(1000, numPartitions=7).selectExpr("id", "cast(id as int) AS i", "array(struct(id AS a)) AS s", "cast(id as decimal(20,0)) AS d", "if(id % 3 = 0, null, string(id)) AS t", "timestamp_micros(id) AS at")
    for mounted in (True, False):
        scratch = common.Scratch(spark, "writers")
        scratch.mounted = scratch.mounted if mounted else None
        for name, df in (("all", rows), ("none", rows.where("false")), ("mapped", common.map_arrow(rows, lambda b: b, rows.schema))):
            again = scratch.save(df, name)
            assert again.dtypes == rows.dtypes and sorted(again.collect()) == sorted(df.collect())
        scratch.drop("all")


def test_queries_on_a_small_table(spark, documents):
    docs = {r.doc_id: (r.text or "") for r in documents.collect()}
    media = {r.doc_id: r for r in queries.QUERIES["op1_gif_media"](spark, SF).collect()}
    assert all(media[k].payload_sha256 == hashlib.sha256((b := t.encode()).ljust(max(1, -(-len(b) // 192)) * 192)).hexdigest() for k, t in docs.items())
    counts = {r.doc_id: r.n_tokens for r in queries.QUERIES["op2_token_counts"](spark, SF).collect()}
    import sentencepiece
    from tokenizers import Tokenizer

    pieces = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_file("piece_bpe_32k.model"))
    assert counts == {k: len(pieces.encode(t)) for k, t in docs.items()}
    assert queries.QUERIES["op3_perspective_rotation"](spark, SF).where("mask_start >= 0").count() == spark.read.parquet(f"{SF}/conversations.parquet").where("role is not null").count()
    found = {r.doc_id: r for r in queries.QUERIES["op4_repeated_strings"](spark, SF).collect()}
    seen: dict = {}
    for t in docs.values():
        b = t.encode()
        for i in range(len(b) - 399):
            key = hashlib.blake2b(b[i : i + 400], digest_size=12).digest()
            seen[key] = seen.get(key, 0) + 1
    for k, t in docs.items():
        b, gone = t.encode(), np.zeros(len(t.encode()) + 1, int)
        for i in range(len(b) - 399):
            if seen[hashlib.blake2b(b[i : i + 400], digest_size=12).digest()] > 1:
                gone[i], gone[i + 400] = gone[i] + 1, gone[i + 400] - 1
        cover = np.cumsum(gone)[:-1] > 0
        assert (found[k].n_removed, found[k].kept_sha256) == (int(cover.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~cover].tobytes()).hexdigest())
    judged = queries.QUERIES["op5_language_id"](spark, SF).join(documents.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang_pred == r.lang for r in judged]) > 0.9
    ids, at = Tokenizer.from_file(tokens.tokenizer_file("byte_bpe_50k.json")), 0
    for r in queries.QUERIES["op6_token_files"](spark, SF).orderBy("doc_id").collect():
        want = [*ids.encode(docs[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)
    mixed = queries.QUERIES["op7_golden_mixture"](spark, SF).collect()
    assert all(0 <= r.taken <= 3 * r.size for r in mixed) and len(mixed) == len(docs)
    scored = queries.QUERIES["op8_toxicity_chain"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("toxic", "label"), "doc_id").collect()
    assert np.mean([r.toxic == (r.label == 1) for r in scored]) > 0.9
    assert queries.QUERIES["op9_setsketch_near_duplicates"](spark, SF).where("kept").count() < len(docs)
    assert queries.QUERIES["op10_suffix_array_decontamination"](spark, SF).where("contaminated <> (n_hit > 0)").count() == 0
