import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from gridclim.llm import common, decontaminate, langid, mixing, setsketch, suffixes, toxicity
from gridclim.llm.common import Scratch, word_hashes
from gridclim.llm.components import components

RNG = np.random.default_rng(8)
VOCABULARY = ["".join(RNG.choice(list("abcdefghij"), 5)) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY, n))


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def corpus():
    """Exact and near copies, chains, shared passages, repeats inside, short, empty and null texts, a repeated row, no id."""
    rng = np.random.default_rng(3)
    texts = {k: prose(int(rng.integers(30, 220)), rng) for k in range(60)}
    for k in range(60, 80):
        words = texts[k - 60].split(" ")
        words[int(rng.integers(len(words)))] = "changed"
        texts[k] = " ".join(words)
    for k in range(80, 90):
        texts[k] = texts[k - 60]
    passage = prose(110, rng)
    for k in range(90, 100):
        texts[k] = prose(int(rng.integers(3, 60)), rng) + " " + passage + " " + prose(int(rng.integers(3, 60)), rng)
    texts |= {100: "ab" * 700, 101: "one two", 102: "one two", 103: "One TWO", 104: "", 105: None, 106: "  \n ", 107: prose(5000, rng), 108: "é" * 500, 109: "x" * 399, 110: "x" * 400, 111: "x" * 401}
    rows = [(k, t) for k, t in texts.items()] + [(101, "one two"), (None, texts[5]), (None, "unlike all the others here"), (None, None)]
    return rows


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(k, t, "c", 1) for k, t in corpus()], "doc_id long, text string, component_id string, node int")


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_components(rows, n):
    """Component of each row's place."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (k, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((k, len(sets[i]), min(own) if own else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates_equal_brute_force(docs, n):
    got = setsketch.near_duplicates(docs, shingle=n).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(corpus(), n)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_remainder_in_small_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 3)
    rng = np.random.default_rng(5)
    base = prose(120, rng).split(" ")
    rows = []
    for k in range(60):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(0, 12)), replace=False):
            words[at] = f"w{k}x{at}"
        rows.append((k, " ".join(words)))
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows, 4)


def test_near_duplicates_of_nothing(docs):
    assert setsketch.near_duplicates(docs.where("false")).count() == 0
    assert [r.component_id for r in setsketch.near_duplicates(docs.where("doc_id in (104, 105, 106)")).orderBy("doc_id").collect()] == [104, 105, 106]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (900, 1100))
    union = setsketch.registers(np.union1d(a, b))
    assert (setsketch.merge(setsketch.registers(a), setsketch.registers(b)) == union).all()
    for similar in (0.3, 0.8, 0.95):
        both = rng.integers(0, 2**64, int(2000 * similar / (1 + similar)), dtype=np.uint64)
        x, y = (np.concatenate([both, rng.integers(0, 2**64, 1000 - len(both), dtype=np.uint64)]) for _ in range(2))
        true = len(both) / (2000 - len(both))
        about, keep = setsketch.estimate(*(setsketch.registers(v)[None] for v in (x, y)), np.array([1000.0]), np.array([1000.0]), 0.8)
        assert abs(about[0] - true) < 0.15 and keep[0] == (true > 0.5)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 99), (101, 99), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "cc").collect()}
    assert got == {k: 0 for k in range(41)} | {99: 99, 100: 99, 101: 99}


def brute_repeats(rows, length):
    seen = {}
    texts = [(k, (t or "").encode()) for k, t in rows]
    for _, b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for k, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((k, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowded", [20_000, 1])
def test_repeats_equal_brute_force(docs, monkeypatch, crowded):
    monkeypatch.setattr(suffixes, "CROWDED", crowded)
    got = suffixes.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.starts or ()), hashlib.sha256(r.kept).hexdigest()) for r in got), key=repr) == brute_repeats(corpus(), 400)
    assert suffixes.remove_repeats(docs.where("false")).count() == 0


def test_long_texts_go_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    text = rng.integers(97, 101, 5000, dtype=np.uint8)
    bounds = np.array([0, 1700, 1700, 1900, 2300, 5000])
    windows = lambda r: sorted((t, int(h), p, s) for t, h, p, a, b in zip(*r, strict=True) for s in range(a, b - 399))
    whole = windows(suffixes.runs(text, bounds))
    each = [windows(suffixes.runs(text[a:b], np.array([0, b - a]))) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert whole == sorted((t, h, p + bounds[t], s + bounds[t]) for t, found in enumerate(each) for _, h, p, s in found) and len(whole) == 1301 + 1 + 2301
    monkeypatch.setattr(suffixes, "_PIECE", 700)
    assert windows(suffixes.runs(text, bounds)) == whole
    assert all(len(x) == 0 for x in suffixes.runs(text[:0], np.array([0])))


def hostile(kind, n, rng):
    """Few letters, one letter, zeros at the end, a Fibonacci word, a short period, ordinary letters."""
    if kind == "fibonacci":
        a, b = "a", "ab"
        while len(b) < n:
            a, b = b, b + a
        return np.frombuffer(b[:n].encode(), np.uint8)
    return {
        "few": lambda: rng.integers(0, 2, n),
        "one": lambda: np.full(n, 7),
        "zeros": lambda: np.concatenate((rng.integers(0, 3, n - n // 2), np.zeros(n // 2))),
        "period": lambda: np.resize(rng.integers(0, 3, int(rng.integers(1, 20))), n),
        "letters": lambda: rng.integers(97, 123, n),
    }[kind]().astype(np.uint8)


@pytest.mark.parametrize("refined", [16, 1 << 14])
@pytest.mark.parametrize("kind", ["few", "one", "zeros", "fibonacci", "period", "letters"])
def test_refined_buckets_sort_like_strings(monkeypatch, refined, kind):
    monkeypatch.setattr(suffixes, "REFINED", refined)
    rng = np.random.default_rng(len(kind))
    for length in (3, 8, 9, 16, 40, 41, 100):
        pieces = [hostile(kind, int(rng.integers(length, length + 150)), rng) for _ in range(4)]
        pieces += [np.concatenate((pieces[0][1:], pieces[1][:9]))]
        of = lambda p, i: p[i : i + length].tobytes()
        count = Counter(of(p, i) for p in pieces for i in range(len(p) - length + 1))
        assert [x.tolist() for x in suffixes.repeated_windows(pieces, length)] == [[count[of(p, i)] > 1 for i in range(len(p) - length + 1)] for p in pieces]
        raw = np.concatenate(pieces).tobytes()
        order, pointer = suffixes.refined_buckets(np.frombuffer(raw, np.uint8), length)
        suffix = [raw[p:] + b"\0" * (-(len(raw) - p) % 8) for p in order]
        start = lambda x: x[: max(length, 8)]
        for a, b, same in zip(suffix, suffix[1:], np.diff(pointer[order]) == 0, strict=False):
            assert start(a) == start(b) if same else a < b
    assert suffixes.refined_buckets(np.zeros(0, np.uint8), 40)[0].size == 0


def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    items = [(1, prose(30, rng)), (2, "three short words"), (3, ""), (None, prose(12, rng)), (5, None), (6, prose(10, rng).upper()), (6, prose(11, rng)), (7, "a a a a a a a a a a a a")]
    cut = lambda t, a, b: " ".join(t.split(" ")[a:b])
    texts = [prose(50, rng), prose(20, rng) + ", " + cut(items[0][1], 5, 16) + "! " + prose(9, rng), cut(items[0][1], 0, 9), "x three SHORT, words-y", items[3][1], cut(items[5][1], 0, 10).lower() + " " + items[6][1], "a " * 30, "", None, "three short", items[0][1] * 2]
    docs = spark.createDataFrame([(k, t, "z") for k, t in enumerate(texts)] + [(0, texts[0], "z"), (None, texts[1], "z")], "doc_id long, text string, spans string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for k, t in items:
        w = split(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(k)
    want = []
    for k, t in [*enumerate(texts), (0, texts[0]), (None, texts[1])]:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= got
        want.append((k, len(w), len(hit), sorted(map(str, found - {None})), bool(hit)))
    rows = decontaminate.decontaminate(docs, benchmark).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, [x for x in r["items"] if x is not None], r.contaminated) for r in rows), key=repr) == sorted(want, key=repr)
    small = [b for b in decontaminate.benchmark_blocks(benchmark, "item_id", "text", 40)]
    assert len(small) > 1 and sum(map(len, small)) == len(items)
    assert decontaminate.drop_contaminated(docs, benchmark).count() == sum(not w[4] for w in want)
    assert decontaminate.decontaminate(docs, benchmark.where("false")).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs.where("false"), benchmark).count() == 0


def test_longest_matches():
    item = " ".join(f"w{k}" for k in range(30))
    test = decontaminate.test_suffixes([(0, item.encode())])
    text = "zz " + " ".join(f"w{k}" for k in range(4, 20)) + " yy"
    assert decontaminate.shard_matches(pa.array([None, text]), test)[1] == [(1, 0, 4, 1, 16)]
    assert decontaminate.shard_matches(pa.array([text * 3]), test, shard_words=7)[1] == decontaminate.shard_matches(pa.array([text * 3]), test)[1]


def test_suffix_array_against_sorting_and_scanning():
    rng = np.random.default_rng(21)
    numbers = rng.integers(0, 4, 400)
    numbers[200:290] = numbers[20:110]
    items = [(0, b"a b a a b c c a b a c b"), (1, b"c"), (2, b" ".join(b"xabc"[k : k + 1] for k in numbers[30:75] if k))]
    test = decontaminate.test_suffixes(items, 5)
    text = b" ".join(b"0abc"[k : k + 1] if k else b"unknown" for k in numbers)
    hashes, _ = word_hashes(pa.array([text]), "alnum")
    flat = np.append(test.number(hashes), 0)
    array = decontaminate.SuffixArray(flat, len(test.vocabulary) + 1, 64)
    cut = lambda at: flat[at : at + next(k for k in range(len(flat)) if flat[at + k] == 0)].tolist()
    order = [cut(p) for p in array.places.tolist()]
    assert sorted(array.places.tolist()) == list(range(len(flat))) and order == sorted(order)
    low, high, longest = array.search(test)
    for k, (start, size) in enumerate(zip(test.start.tolist(), test.length.tolist(), strict=True)):
        rest = test.numbers[start : test.first[test.item[k] + 1] - 1 if test.item[k] + 1 < len(items) else len(test.numbers) - 1].tolist()
        reach = [next((j for j in range(len(rest)) if p + j >= len(flat) or flat[p + j] != rest[j]), len(rest)) for p in range(len(flat))]
        assert sorted(array.places[low[k] : high[k]].tolist()) == [p for p, r in enumerate(reach) if r >= size]
        assert longest[k] == (max(reach) if max(reach) >= size else 0)


def morse(zero, one):
    """A word of 1024 letters and its complement: polynomial hashes modulo a power of two take them for equal."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    return "".join(one if b else zero for b in bits), "".join(zero if b else one for b in bits)


def test_words_that_simple_hashes_confuse(spark):
    x, y = morse("a", "b")
    docs = spark.createDataFrame([(1, f"{x} one two three"), (2, f"{y} one two three")], "doc_id long, text string")
    assert [r.component_id for r in setsketch.near_duplicates(docs, shingle=4).orderBy("doc_id").collect()] == [1, 2]
    found = decontaminate.decontaminate(docs, spark.createDataFrame([("t", x)], "item_id string, text string")).orderBy("doc_id").collect()
    assert [(r.n_hit, r["items"]) for r in found] == [(1, ["t"]), (0, [])]


def test_equal_hashes_alone_do_not_count(monkeypatch, spark):
    """With every word hashing alike, words themselves still decide."""
    real = common.word_hashes
    alike = lambda texts, kind: (np.full(len(real(texts, kind)[0]), 7, np.uint64), real(texts, kind)[1])
    monkeypatch.setattr(decontaminate, "word_hashes", alike)
    test = decontaminate.test_suffixes([(0, b" ".join(b"w%d" % k for k in range(12)))])
    assert decontaminate.shard_matches(pa.array([" ".join("v" * 1 for _ in range(30)), "x " + " ".join(f"w{k}" for k in range(12))]), test)[1] == [(1, 0, 0, 1, 12)]


def test_ids_of_any_value_and_type(spark):
    a, b = prose(40), prose(40)
    big = [(1 << 62, a), ((1 << 63) - 1, a), (-(1 << 63), b), (5, b + " more")]
    rows = {r.doc_id: r for r in setsketch.near_duplicates(spark.createDataFrame(big, "doc_id long, text string")).collect()}
    assert {k: (r.component_id, r.kept) for k, r in rows.items()} == {1 << 62: (1 << 62, True), (1 << 63) - 1: (1 << 62, False), -(1 << 63): (-(1 << 63), True), 5: (-(1 << 63), False)}
    named = spark.createDataFrame([("x", a), ("y", a), (None, a), (None, "only here"), (None, "only here"), (None, None)], "doc_id string, text string")
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in setsketch.near_duplicates(named).collect()), key=repr) == sorted([("x", "x", True), ("y", "x", False), (None, "x", False), (None, None, True), (None, None, True), (None, None, True)], key=repr)
    kept = setsketch.drop_near_duplicates(named.selectExpr("doc_id", "text", "1 AS h", "2 AS component_id"))
    assert kept.columns == ["doc_id", "text", "h", "component_id"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([("x", a), (None, "only here"), (None, None)], key=repr)


def test_blocks_of_items_go_one_after_another(spark):
    rng = np.random.default_rng(31)
    items = [(f"i{k}", prose(14, rng)) for k in range(6)]
    docs = spark.createDataFrame([(k, prose(9, rng) + " " + items[k % 6][1] + " " + prose(9, rng) if k % 2 else prose(40, rng)) for k in range(24)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    plain = lambda df: sorted((r.doc_id, r.n_words, sorted(map(tuple, r.spans))) for r in df.collect())
    one, many = (plain(decontaminate.matches(docs, benchmark, block_words=n)) for n in (10**6, 30))
    assert one == many and sum(bool(r[2]) for r in one) == 12
    assert decontaminate.drop_contaminated(docs, benchmark, block_words=30).count() == 12


def mixed_sample(spark):
    rng = np.random.default_rng(6)
    rows = [(k, " ".join("w" * int(rng.integers(0, 400))), None if k % 9 == 0 else f"s{k % 4 if k % 3 else 0}") for k in range(300)]
    rows += [(5, "again again", "s1"), (5, "again again", "s1"), (None, "no id", "s2"), (600, None, "s2"), (601, "w " * 3000, "tiny")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixture(spark):
    import duckdb

    docs = mixed_sample(spark)
    got = mixing.mix(docs)
    documents = docs.toPandas()
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.sql(mixing.OP7_SQL).fetchall()
    rows = [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got.taken.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert all(r[4] <= 3 * r[1] for r in rows)
    slots = got.slots.collect()
    targets = {r.src: r for r in got.targets.collect()}
    for src, t in targets.items():
        ranks = sorted(s["rank"] for s in slots if s.src == src)
        assert ranks == list(range(t.n_slots))
        some = sum(s.src == src for s in slots if s.slot < len(slots) // 2)
        assert abs(some - t.n_slots / 2) <= 4
    assert sorted(got.taken.collect(), key=repr) == sorted(mixing.mix(docs.repartition(7)).taken.collect(), key=repr)
    assert mixing.mix(docs.where("false")).taken.count() == 0
    assert [r.taken for r in mixing.mix(docs.where("doc_id = 600")).taken.collect()] == [0]


def test_caps_are_shared_again(spark):
    sized = spark.createDataFrame([(1, "a", 10), (2, "b", 1000), (3, "c", 1000)], "doc_id long, source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    assert found["a"] == 30 and found["b"] == pytest.approx(1980 * 2 / 3) and found["c"] == pytest.approx(1980 / 3)


def test_lattice_is_a_permutation():
    for n in (1, 2, 7, 1000, 4097):
        assert sorted(mixing.lattice(np.arange(n), mixing.golden_step(n), n).tolist()) == list(range(n))
    big = 10**12
    step = mixing.golden_step(big)
    assert mixing.lattice(np.array([big - 3]), step, big)[0] == (big - 3) * step % big


def plain_language(model, text):
    """The language whose plain compressor needs the fewest bytes over all chunks."""
    lower, total = text.lower().encode(), {}
    for lang in sorted(model):
        raw = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        one = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)
        total[lang] = sum(len(one.compress(lower[i : i + langid.CHUNK])) for i in range(0, len(lower), langid.CHUNK))
    return min(total, key=lambda lang: (total[lang], lang))


def test_languages(spark):
    rng = np.random.default_rng(7)
    words = {"aa": ["the", "and", "house", "which", "water"], "bb": ["der", "und", "haus", "welches", "wasser"], "cc": ["les", "dans", "maison", "quelle", "eaux"]}
    make = lambda lang: " ".join(rng.choice(words[lang], 60)) + f" {rng.integers(1000)}"
    rows = [(k, make(lang), lang, "z") for k, lang in enumerate([*words] * 60)] + [(900, None, "aa", "z"), (901, "123 456 !", "bb", "z"), (902, "", None, "z"), (None, make("cc"), "cc", "z"), (903, make("aa").upper() * 400, None, "z"), (904, "wasser und haus", None, "z"), (905, "½ ² Ⅷ ٣ _", "aa", "z"), (7, make("bb"), "bb", "z"), (7, rows_of_seven := make("aa"), "aa", "z"), (7, rows_of_seven, "aa", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.learn_dictionaries(docs.where(~langid.held_out()), sample_pieces=30)
    assert sorted(model) == ["aa", "bb", "cc"] and all(len(v) <= 30 * (langid.PIECE + 1) for v in model.values())
    found = langid.identify(docs, model).collect()
    got = {r.doc_id: r for r in found if r.doc_id != 7}
    assert sorted(r.lang_pred for r in found if r.doc_id == 7)[:2] == ["aa", "aa"] and got[905].lang_pred == "und"
    assert [got[k].lang_pred for k in (903, 904)] == [plain_language(model, next(r[1] for r in rows if r[0] == k)) for k in (903, 904)]
    assert all(got[k].lang_pred == plain_language(model, rows[k][1]) for k in range(0, 180, 9))
    tested = [k for k, _, lang, _ in rows[:180] if k != 7]
    assert np.mean([got[k].lang_pred == rows[k][2] for k in tested]) > 0.98
    assert [got[k].lang_pred for k in (900, 901, 902, None, 903, 904)] == ["und", "und", "und", "cc", "aa", "bb"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[900].rejected
    assert langid.learn_dictionaries(docs.where("false")) == {} and langid.identify(docs, {}).where("lang_pred <> 'und'").count() == 0
    assert langid.learn_dictionaries(docs.repartition(5), sample_pieces=30) == langid.learn_dictionaries(docs, sample_pieces=30)


def test_toxicity(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for k in range(500):
        toxic, low = k % 5 == 0, k % 7 == 0
        words = list(rng.choice(VOCABULARY, 80))
        if toxic:
            words[10:10] = [f"nasty{rng.choice(list('abc'))}"] * 2
        if low:
            words[5:5] = ["junkjunk"] * 3
        rows.append((k, " ".join(words), "z"))
        labels.append((k, int(not low), int(toxic)))
    rows += [(1000, None, "z"), (1001, "", "z"), (None, "nastya nastyb", "z"), (0, rows[0][1], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    marks = spark.createDataFrame([*labels[:400], (1, None, 1), (None, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    assert model.names == ["low_quality", "toxic"] and len(model.weights[1]) == len(model.own[1]) + 2
    got = toxicity.score(docs, model).collect()
    held = {r.doc_id: r for r in got if r.doc_id is not None and 400 <= r.doc_id < 500}
    assert all(held[k].toxic == (k % 5 == 0) for k in held)
    assert np.mean([(held[k].p_low_quality > 0.5) == (k % 7 == 0) for k in held]) > 0.97
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and not by[1000].toxic and not by[1001].toxic and by[None].toxic
    assert toxicity.drop_toxic(docs, model).count() == sum(not r.toxic for r in got)
    assert toxicity.train(docs, marks.where("false")) is None
    none = toxicity.score(docs, None).collect()
    assert not any(r.toxic for r in none) and none[0].p_toxic is None and toxicity.score(docs.where("false"), model).count() == 0


def test_chain_sees_out_of_fold_predictions():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (400, 6)).astype(float)
    first = (x[:, 0] + rng.normal(0, 0.4, 400) > 0.5).astype(float)
    y = np.column_stack([first, ((first + x[:, 1]) > 1).astype(float)])
    model = toxicity.fit_chain(["a", "b"], {str(k): k for k in range(6)}, [list(range(6))] * 2, x, y, np.arange(400) % 4)
    p = model.probabilities(x)
    assert ((p[:, 1] > 0.5) == (y[:, 1] > 0.5)).mean() > 0.85 and model.weights[1][6] > 0.3


def test_pieces_of_all_texts_to_their_ends_are_learned(spark):
    rows = [(k, "".join(f"<{k:04d}.{j:03d}" + "x" * 90 + ">" for j in range(12)), "en") for k in range(60)]
    pieces = [t[i : i + 100] for _, t, _ in rows for i in range(0, 1200, 100)]
    docs = spark.createDataFrame([*rows, *rows[:5], (3, "short", "en"), (None, "no id", "en"), (1, None, "en"), (2, "", "en")], "doc_id long, text string, lang string")
    every = langid.learn_dictionaries(docs, sample_pieces=10_000, piece=100)["en"].split(b"\n")
    assert sorted(every) == sorted(x.encode() for x in [*pieces, "short"])
    some = langid.learn_dictionaries(docs, sample_pieces=100, piece=100)["en"].split(b"\n")
    assert some == every[:100] and len({x[6:9] for x in some}) == 12
