"""What must stay bounded or hold on whole tables: repetitive texts, many rows of one id, queries against plain versions."""

import hashlib
import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from gridclim.llm import audit, decontaminate, mixing, queries, tokens, toxicity

SF = "/root/testdata/sf0.001"


def split(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(texts, items, window=10):
    windows = {}
    for k, t in items:
        w = split(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(k)
    sizes = {len(x) for x in windows}
    for t in texts:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= got
        yield len(w), hit, found


@pytest.mark.parametrize("shard_words", [13, 1 << 20])
def test_hits_of_repetitive_texts(shard_words, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 7)
    rng = random.Random(4)
    items = [(k, " ".join(rng.choice("aab") for _ in range(rng.choice([0, 1, 2, 5, 6, 30])))) for k in range(12)]
    texts = [" ".join(rng.choice("aabc" if k % 2 else "a") for _ in range(rng.randint(0, 60))) for k in range(40)] + [None, ""]
    test = decontaminate.test_suffixes([(k, t.encode()) for k, t in items], 5)
    sizes, spans, pairs = decontaminate.shard_hits(pa.array(texts), test, 5, shard_words)
    for d, (n, hit, found) in enumerate(brute_hits(texts, items, 5)):
        own = [(a, m) for k, a, m in spans.T.tolist() if k == d]
        assert sizes[d] == n and {i for a, m in own for i in range(a, a + m)} == hit and sum(m for _, m in own) == len(hit)
        assert {i for k, i in pairs.T.tolist() if k == d} == found


def test_a_million_equal_words_against_equal_items():
    """In a process of its own, for its memory: under 1 GB in all."""
    code = """
import resource
import pyarrow as pa
from gridclim.llm import decontaminate as d
n = 1 << 20
test = d.test_suffixes([(k, b"a " * 1000) for k in range(10)])
sizes, spans, pairs = d.shard_hits(pa.array(["a " * n + "b " + "a " * 9]), test)
assert sizes.tolist() == [n + 10] and spans.T.tolist() == [[0, 0, n]] and pairs.T.tolist() == [[0, k] for k in range(10)]
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parents[2], timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 1_000_000


def test_decontamination_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = []
    for r, (n, hit, found) in zip(docs, brute_hits([r.text for r in docs], items), strict=True):
        want.append((r.doc_id, n, len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    got = queries.QUERIES["op10_suffix_array_decontamination"](spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(w[5] for w in want)


def test_many_texts_of_one_labelled_id(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    words = [word() for _ in range(300)]
    rows = [(k, " ".join([*rng.sample(words, 20), *(["nasty"] if k % 3 == 0 else [])])) for k in range(60)]
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(60)], "doc_id long, quality int, toxic int")
    plain = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    low = min(rows, key=lambda r: r[0])
    many = spark.createDataFrame(rows, "doc_id long, text string").union(spark.range(3000).selectExpr(f"{low[0]}L AS doc_id", "concat('other text ', id) AS text"))
    seen = []
    real = toxicity.fit_chain
    try:
        toxicity.fit_chain = lambda names, index, own, x, y, fold: seen.append(x.shape[0]) or real(names, index, own, x, y, fold)
        model = toxicity.train(many, labels)
    finally:
        toxicity.fit_chain = real
    assert seen == [60] and set(plain.index) >= {"nasty"} and "nasty" in model.index


def newton(x, y, l2):
    """Plain Newton steps, many of them."""
    x = np.column_stack([x, np.ones(len(x))])
    shrink = np.array([l2] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(x @ w)))
        w = w - 0.7 * np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(shrink), x.T @ (p - y) + shrink * w)
    return w


def test_toxicity_query_equals_a_plain_chain(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    labels = {r.doc_id: (int(r.quality == 0), int(r.toxic == 1)) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.doc_id in docs}
    features = {k: {f for w in set(re.findall(r"[^\W\d_]+", (t or "").lower())) for f in [w, *(w[:n] + "*" for n in (4, 5, 6) if len(w) > n)]} for k, t in docs.items()}
    ids = sorted(labels)
    n = len(ids)
    total = Counter(f for k in ids for f in features[k])
    y = np.array([labels[k] for k in ids], float)
    fold = np.array([zlib.crc32(str(k).encode()) % 4 for k in ids])
    outside, every, known = np.zeros((n, 0)), np.zeros((len(docs), 0)), sorted(docs)
    for c in range(2):
        own = Counter(f for k in ids if labels[k][c] for f in features[k])
        size = sum(labels[k][c] for k in ids)
        chi = {f: (own[f] * n - t * size) ** 2 / (t * max(1e-9, n - t)) for f, t in total.items() if t >= 4}
        best = sorted(chi, key=lambda f: (-chi[f], f))[:200] if 0 < size < n else []
        at = lambda rows, best=best: np.array([[f in features[k] for f in best] for k in rows], float).reshape(len(rows), len(best))
        x = np.column_stack([at(ids), outside])
        found = np.zeros(n)
        for f in set(fold.tolist()):
            w = newton(x[fold != f], y[fold != f, c], 0.1)
            found[fold == f] = 1 / (1 + np.exp(-(x[fold == f] @ w[:-1] + w[-1])))
        w = newton(x, y[:, c], 0.1)
        all_x = np.column_stack([at(known), every])
        every = np.column_stack([every, 1 / (1 + np.exp(-(all_x @ w[:-1] + w[-1])))])
        outside = np.column_stack([outside, found])
    got = {r.doc_id: r for r in queries.QUERIES["op8_toxicity_chain"](spark, SF).collect()}
    gap = max(abs(got[k].p_toxic - every[i, 1]) for i, k in enumerate(known))
    gap_first = max(abs(got[k].p_low_quality - every[i, 0]) for i, k in enumerate(known))
    assert gap < 0.02 and gap_first < 0.02
    limit = toxicity.best_threshold(outside[:, 1], y[:, 1])
    clear = [(k, p) for k, p in zip(known, every[:, 1].tolist(), strict=True) if abs(p - limit) > 0.02]
    assert len(clear) > 0.9 * len(known) and all(got[k].toxic == (p >= limit) for k, p in clear)


def test_filter_query_reads_the_documents_once(spark):
    plan = audit.op13_filter_cube(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan and "survivors" in plan


def test_parts_follow_the_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tokens, "PART_BYTES", 4_000)
    few = spark.range(200).selectExpr("id AS doc_id", "repeat('some words ', 20) AS text")
    many = spark.range(2000).selectExpr("id AS doc_id", "repeat('some words ', 20) AS text")
    n, m = tokens.part_count(few, "text"), tokens.part_count(many, "text")
    assert n == -(-200 * (220 + tokens.ROW_BYTES) // 4_000) and 9 * n < m <= 10 * n
    manifest = tokens.write_token_files(many, f"{tmp_path}/t").collect()
    assert 0.9 * m < len(manifest) <= m and sum(r.n_docs for r in manifest) == 2000 and max(r.n_docs for r in manifest) < 4 * 2000 / m
    rows = sorted(tokens.read_token_files(spark.createDataFrame(manifest), f"{tmp_path}/t").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == list(range(2000)) and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:], strict=False))
    assert tokens.part_count(many.selectExpr("doc_id", "CAST(NULL AS STRING) AS text"), "text") == max(8, -(-2000 * tokens.ROW_BYTES // 4_000))


def test_the_schedule_reaches_the_files(spark, tmp_path):
    rng = random.Random(13)
    rows = [(k, " ".join(f"d{k}w{i}" for i in range(rng.choice([0, 1, 3, 7, 40]))), rng.choice(["a", "b", "b", "b", None])) for k in range(120)]
    rows += [(7, "again one two", "a"), (7, "again other two", "a"), (None, "x y z", "b"), (500, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    blocks = mixing.scheduled_blocks(docs, block_words=5)
    got = sorted(blocks.collect())
    assert [r.slot for r in got] == list(range(len(got))) and all(r.n_words == len(r.text.split()) <= 5 for r in got)
    taken = Counter()
    for r in mixing.mix(docs, block_words=5).taken.collect():
        taken[r.doc_id] += r.taken
    seen = Counter(w for r in got for w in r.text.split())
    by_doc = Counter()
    for w, n in seen.items():
        if w.startswith("d"):
            by_doc[int(w[1:].split("w")[0])] += n
    assert all(by_doc[k] == n for k, n in taken.items() if k not in (7, None)) and sum(r.n_words for r in got) == sum(taken.values())
    totals = Counter()
    for r in got:
        totals[r.source] += r.n_words
    whole, so_far, words = sum(totals.values()), Counter(), 0
    for r in got:
        so_far[r.source] += r.n_words
        words += r.n_words
        assert all(abs(so_far[s] - totals[s] * words / whole) <= 3 * 5 for s in totals)
    manifest = tokens.write_token_files(blocks, f"{tmp_path}/t", id_col="slot")
    assert [r.slot for r in sorted(tokens.read_token_files(manifest, f"{tmp_path}/t", id_col="slot").collect(), key=lambda r: r.start)] == list(range(len(got)))
