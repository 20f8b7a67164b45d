import hashlib
import math
import random
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from gridclim.llm import audit, runs, vectors

SF = "/root/testdata/sf0.001"


# Exact search


def vector_rows():
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=5) * 0.4).round(3).tolist()) for k in range(130)]
    same = rng.normal(size=5).round(2).tolist()
    rows += [(k, same) for k in range(200, 290)]
    rows += [(300, None), (301, [None, 1.0, 1.0, 1.0, 1.0]), (302, [math.nan, 0.0, 0.0, 0.0, 0.0]), (303, [math.inf, 0.0, 0.0, 0.0, 0.0]), (304, []), (350, [-math.inf]), (400, [])]
    rows += [(None, same), (None, None), (50, rows[50][1]), (50, same), (51, rows[51][1]), (305, [0.1, 0.2]), (306, [0.3, 0.2]), (450, [0.3, -0.2]), (500, [9.0] * 7)]
    return rows


def brute_search(rows, k=5):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(sound):
        if q is None or q % 50:
            continue
        found = [(-sum(x * y for x, y in zip(v, w, strict=True)), i is None, i or 0, i) for b, (i, w) in enumerate(sound) if a != b and len(w) == len(v)]
        out += [(q, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("tile", "block", "first", "cells"), [(1 << 20, 1 << 20, 16, 64), (400, 120, 1, 3)])
def test_search_equals_brute_force(spark, monkeypatch, tile, block, first, cells):
    monkeypatch.setattr(vectors, "FIRST", first)
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, v int, query string").selectExpr("*", "1 AS cls", "2 AS score", "3 AS rank")
    got = vectors.top_k(df.repartition(3), df.vec_id % 50 == 0, cells=cells, tile_bytes=tile, block_bytes=block)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(rows)


def test_search_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.top_k(none, none.vec_id % 50 == 0).count() == 0
    one = spark.createDataFrame([(50, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert vectors.top_k(one, one.vec_id % 50 == 0).count() == 0


def test_a_component_or_score_beyond_a_long_is_an_error(spark):
    for x in (1e30, 1e15):
        df = spark.createDataFrame([(50, [x, 2.0]), (51, [x, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="fit a long|OVERFLOW"):
            vectors.top_k(df, df.vec_id % 50 == 0).collect()


def test_bounds_hold_and_are_not_trivial():
    rng = np.random.default_rng(6)
    for scale in (100, 2.0**40):
        x, q = np.floor(rng.normal(size=(500, 16)) * scale), np.floor(rng.normal(size=(20, 16)) * scale)
        codes, low, high = vectors.approximate(x)
        lower, upper = vectors.bounds(q, codes, low, high)
        exact = np.array([[sum(int(a) * int(b) for a, b in zip(y, z, strict=True)) for z in x] for y in q], object)
        assert (lower <= exact).all() and (exact <= upper).all()
        assert np.mean(upper - lower) < 0.5 * np.std(exact.astype(float))
    assert codes.max() == 63 and len(np.unique(codes[:, 0])) == 64


# Periodic runs


def brute_runs(w, least=12):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            a = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            n = i - a + p
            if i > a and n >= max(least, 2 * p):
                found.setdefault((a, n), p)  # the smallest period of these words comes first
            i += 1
    return sorted(((a, n, p) for (a, n), p in found.items()), key=lambda x: (x[0], x[2]))


def word_strings():
    rng = random.Random(11)
    for t in range(3000):
        letters, n = rng.choice([1, 2, 2, 3, 4]), rng.randint(0, 70)
        w = [rng.randrange(letters) for _ in range(n)]
        if t % 3 == 0 and n > 4:
            p = rng.randint(1, n // 2)
            w = [w[i % p] for i in range(n)]
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(n)] = rng.randrange(5)
        yield w


def test_runs_equal_brute_force():
    for w in word_strings():
        for least in (2, 12):
            assert runs.runs(w, least) == brute_runs(w, least)
        texts = [[b"%d" % x for x in v] for v in (w, [], w[::-1])]
        assert list(runs.texts_runs(texts)) == [brute_runs(w), [], brute_runs(w[::-1])]


def test_next_smaller_suffixes_and_what_they_share():
    for w in list(word_strings())[:600]:
        following, shared = runs.next_smaller(w)
        for i in range(len(w)):
            j = next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w))
            assert following[i] == j
            if j < len(w):
                assert shared[i] == next((k for k in range(len(w) - j) if w[i + k] != w[j + k]), len(w) - j)


class Counted:
    n = 0

    def __init__(self, value):
        self.value = value

    def __eq__(self, other):
        Counted.n += 1
        return self.value == other.value

    def __lt__(self, other):
        Counted.n += 1
        return self.value < other.value


@pytest.mark.parametrize("kind", ["equal", "blocks", "growing", "fibonacci", "copies", "ruler", "thue"])
def test_comparisons_are_linear(kind):
    n = 20_000
    rng = random.Random(2)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < n:
        fib.append(fib[-1] + fib[-2])
    w = {
        "equal": [0] * n,
        "blocks": ([0] * (n // 2) + [1]) * 2,
        "growing": [x for k in range(1, 200) for x in [0] * k + [1]],
        "fibonacci": fib[-1][:n],
        "copies": ([rng.randrange(2) for _ in range(2000)] + [5]) * 9,
        "ruler": [(i & -i).bit_length() for i in range(1, n)],
        "thue": [i.bit_count() & 1 for i in range(n)],
    }[kind]
    for order in (w, [-x for x in w]):
        Counted.n = 0
        runs.next_smaller([Counted(x) for x in order])
        assert Counted.n <= 6 * len(w)


def brute_digests(doc_id, text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if x]
    if doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join("%d,%d,%d\n" % x for x in found)), sha(kept), len(w))


def test_runs_of_the_query_equal_brute_force(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(None, "a b " * 9), (None, None), (9001, None), (9002, ""), (9003, " \x0b\x1f   "), (9004, "x " * 400), (9004, "x " * 400), (9005, "é ü " * 6), (9006, "a b c d e f " * 2), (9007, "a b c d e " * 2)]
    spark.createDataFrame([(k, t, 1, "s") for k, t in rows], "doc_id long, text string, runs int, collapsed string").write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.op12_lyndon_runs(spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = sorted((brute_digests(*r) for r in rows if len((r[1] or "").split()) < 900), key=repr)
    assert sorted((tuple(r) for r in got.collect() if r.n_words < 900), key=repr) == want and len(want) > 190


def test_runs_of_a_long_text_and_of_nothing(spark):
    long = "x y z " * 100_000 + "end"
    docs = spark.createDataFrame([(7, long), (8, "q " * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[7].runs] == [(0, 300_000, 3)] and got[7].collapsed == "x y z end"
    assert [tuple(x) for x in got[8].runs] == [(0, 300_000, 1)] and got[8].collapsed == "q"
    assert runs.periodic_runs(docs.where("false")).count() == 0


# Filters in all orders


def audit_rows():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(90)]
    texts = [" ".join(rng.choice(words[: rng.choice([20, 90])]) for _ in range(rng.choice([10, 49, 50, 80]))) for _ in range(40)]
    texts += [t.upper() for t in texts[:8]] + [t + " #" for t in texts[5:12]] + ["", None, " \t ", "é" * 60]
    rows = [(k, rng.choice(texts), rng.choice(["a", "b", "", None, "c"])) for k in range(150)]
    return rows + [(3, texts[0], "a"), (3, texts[0], "a"), rows[5], rows[6], (None, texts[1], "b"), (None, texts[1], "b"), (None, None, None), (500, "only here $", "z")]


def audit_labels():
    rng = random.Random(9)
    return [(k, rng.randrange(2), rng.randrange(2)) for k in range(0, 120)] + [(3, 1, 0), (3, 0, None), (4, None, None), (None, 1, 1), (9999, 1, 1)]


def brute_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    docs = []
    for i, t, part in rows:
        t = t or ""
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", t) if x]
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > least[t]}
        docs.append((part or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out, shapley = [], Counter()
    for order in map("".join, permutations("ABCDE")):
        for step, f in enumerate(order, 1):
            for part in {d[0] for d in docs}:
                own = [d for d in docs if d[0] == part]
                before = [d for d in own if not d[1] & set(order[: step - 1])]
                gone = [d for d in before if f in d[1]]
                shapley[part, f] += len(gone)
                out.append((part, order, step, len(before) - len(gone), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_equals_brute_force(spark):
    rows, labels = audit_rows(), audit_labels()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, n int, part string").selectExpr("*", "1 AS fails", "2 AS good", "3 AS digest", "4 AS A")
    got = audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, labels)
    assert dict(got.dtypes)["step"] == "int"
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.good_lost, r.toxic_lost) for r in audit.filter_audit(docs, none).collect()} == {(0, 0)}
    assert audit.filter_audit(docs.where("false"), none).count() == 0


def test_a_very_long_text_counts_whole(spark):
    docs = spark.createDataFrame([(1, "a " * 600_000 + "|", "s"), (2, "A" * 1_000_000 + " x" * 60, "s")], "doc_id long, text string, source string")
    got = audit.flag_counts(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).orderBy("C").collect()
    assert [tuple(r)[1:6] for r in got] == [(False, True, False, True, False), (False, True, True, False, False)]
