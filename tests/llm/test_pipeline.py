import re
import zlib

import numpy as np

import corpus_pipeline
from gridclim.llm import tokens


def test_every_stage(spark, tmp_path):
    """Stages against plain versions on a small corpus with known toxic, copied and leaked documents."""
    rng = np.random.default_rng(12)
    vocabulary = ["".join(rng.choice(list("klmnopqrst"), 6)) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(k, prose(25)) for k in range(4)]
    rows, labels, toxic, copies, leaks = [], [], set(), set(), set()
    for k in range(400):
        text = prose(60)
        if k % 8 == 1:
            text, _ = text + " horridword horridword", toxic.add(k)
        elif k % 10 == 2 and k > 50:
            text, _ = rows[k - 50][1], copies.add(k)
        elif k % 20 == 3:
            text, _ = text + " " + items[k % 4][1], leaks.add(k)
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
        labels.append((k, 1, int(k in toxic)))
    copies -= {k for k in copies if k - 50 in toxic}
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([*rows, (None, None, None, None, None), (900, "", "en", None, 0)], columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels[:300], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "mixing", "tokens"]
    left = {k for k in range(400)} - toxic
    seen = {}
    for name in list(stages)[:4]:
        docs = stages[name](spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = [r.doc_id for r in docs.collect()]
    assert set(seen["toxicity"]) - {None, 900} == left
    text = {r[0]: r[1] for r in rows}
    first = {}
    for k in sorted(left):
        first.setdefault(text[k], k)
    assert set(seen["near_dedup"]) - {None, 900} == set(first.values())
    assert set(seen["decontamination"]) - {None, 900} == set(first.values()) - leaks
    assert set(seen["mixing"]) <= set(seen["decontamination"]) and max(seen["mixing"].count(k) for k in set(seen["mixing"])) <= 3
    out = stages["tokens"](spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == sorted(seen["mixing"])
    model = tokens.ByteEncoder(open(tokens.tokenizer_file("byte_bpe_50k.json")).read(), "<u4")
    for r in out[:20]:
        ids = model.encode([text[r.doc_id]])[0] + np.array([2], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(ids)
    assert re.match("s", rows[0][3])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(out)
