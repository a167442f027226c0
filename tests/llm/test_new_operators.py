"""Quality fences, periodic runs and importance resampling."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_fixtures import no_docs, odd_docs  # noqa: F401
from quarry.llm import QUERIES, importance_resampling, periodic_runs, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules ----------------------------------------------------------


def repeated_words(words):
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i:i + 5])].append(i)
    return len({i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)})


@pytest.mark.parametrize("text", [
    "a b c d e f a b c d e", "a a a a a a a", "x\n\nx\n \n x\nx", "one two", "", "#a $b & c|d<e>%*", " \t\n",
    "a b c d e a b c d e a b c d e", "　 \x1c wide   space", "\U0001f44d é 日本 # x",
])
def test_measures_by_hand_rules(spark, text):
    docs = spark.createDataFrame([(1, text, "en", "a")], "doc_id long, text string, lang string, source string")
    (got,) = quality_rules.measure(docs).collect()
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    assert got["n_words"] == len(words) and got["word_chars"] == sum(map(len, words))
    assert got["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
    assert got["n_dup_lines"] == len(lines) - len(set(lines))
    assert got["n_repeat_words"] == repeated_words(words)
    assert got["base_failed"] == (len(words) < 10 or 100 * repeated_words(words) > 20 * len(words))


def test_buckets_are_exact_below_64_and_close_above(spark):
    rows = spark.range(200_000).select("id", quality_rules.bucket_of(F.col("id")).alias("b"))
    assert rows.filter("id < 64 and b <> id").count() == 0
    assert rows.filter("b > id or id - b > id / 32").count() == 0
    assert rows.select("b").distinct().count() < 64 + 32 * 12


def test_quartiles_of_merged_sketches_equal_those_of_all_rows(spark):
    rnd = random.Random(3)
    rows = [("en" if i % 3 else None, rnd.choice(["a", "b"]), rnd.choice([5, 40, 63, 900, 70_000])) for i in range(900)]
    frame = spark.createDataFrame(rows, "lang string, source string, v long")
    sketch = lambda f: quality_rules.quantile_sketch(f, ["lang", "source"], ["v"])
    halves = frame.filter("v > 50"), frame.filter("v <= 50")
    merged = quality_rules.merge_sketches(sketch(halves[0]).unionByName(sketch(halves[1])), ["lang", "source"])
    key = lambda r: (r[0] or "", r[1])
    got = sorted(map(tuple, quality_rules.quartiles(merged, ["lang", "source"]).collect()), key=key)
    assert got == sorted(map(tuple, quality_rules.quartiles(sketch(frame), ["lang", "source"]).collect()), key=key)
    for lang, source, _, n, q1, q3 in got:
        values = sorted(v for a, b, v in rows if a == lang and b == source)
        assert n == len(values)
        for q, share in ((q1, 0.25), (q3, 0.75)):
            exact = values[math.ceil(share * n) - 1]
            assert q <= exact <= q * 33 / 32 or q == exact


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def test_fences_follow_language_and_source(spark):
    """Symbols are normal in one source and drop a document in the other."""
    rnd = random.Random(5)
    coded = lambda: re.sub(" ", " $ ", prose(rnd, 60))
    rows = [(i, prose(rnd, 60), "en", "plain") for i in range(300)] + [(1000 + i, coded(), "en", "code") for i in range(900)]
    rows += [(5000, coded(), "en", "plain"), (5001, "word " * 9, "en", "plain"), (5002, "w " * 200, "en", "plain"),
             (5003, prose(rnd, 200).replace(" ", ""), "en", "plain"),
             (5004, "\n".join([prose(rnd, 12)] + ["same short line"] * 2 + [prose(rnd, 40)] * 1 + ["same short line"] * 2), "en", "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge_quality(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["kept"] for i, *_ in rows if i < 5000)
    assert got[5000]["reasons"] == "symbols" and got[5001]["reasons"] == got[5002]["reasons"] == got[5003]["reasons"] == "base"
    assert not got[5004]["kept"] and "dup_lines" in got[5004]["reasons"]


def test_earlier_sketches_widen_the_fences(spark):
    rnd = random.Random(6)
    schema = "doc_id long, text string, lang string, source string"
    today = spark.createDataFrame([(i, prose(rnd, 50), "en", "a") for i in range(40)] + [(99, prose(rnd, 50).replace(" ", " # "), "en", "a")], schema)
    before = spark.createDataFrame([(i, prose(rnd, 50).replace(" ", " # "), "en", "a") for i in range(200)], schema)
    kept = lambda d: {r["doc_id"] for r in d.filter("kept").collect()}
    sketch = quality_rules.quantile_sketch(quality_rules.measure(before), ["lang", "source"], list(quality_rules.MEASURES))
    assert 99 not in kept(quality_rules.judge_quality(today))
    assert 99 in kept(quality_rules.judge_quality(today, earlier=sketch))


def test_quality_query_keeps_clean_prose_and_drops_junk(spark):
    rows = QUERIES["op11_adaptive_quality"](spark, SF_SMALL).collect()
    assert all(r["kept"] for r in rows if r["n_words"] >= 10 and not r["n_symbols"] and not r["n_dup_lines"] and not r["n_repeat_words"])
    assert not any(r["kept"] for r in rows if r["base_failed"] or r["n_symbols"] * 8 > r["word_chars"] + 50)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    got = quality_rules.judge_quality(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["n_words"] == by_id[4]["n_words"] == by_id[5]["n_words"] == 0 and by_id[3]["reasons"] == "base"
    assert by_id[6]["n_words"] == by_id[6]["n_repeat_words"] == 48_000 and not by_id[6]["kept"]
    assert quality_rules.judge_quality(no_docs).collect() == []


# --- periodic runs ----------------------------------------------------------


def brute_runs(words, min_length=6, min_exponent=4):
    found = {}
    for p in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(min_length, min_exponent * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def periodic_text(rnd):
    letters = "abcdefgh"[:rnd.choice([1, 2, 2, 3, 5])]
    words = []
    for _ in range(rnd.randint(0, 5)):
        unit = [rnd.choice(letters) for _ in range(rnd.randint(1, 12))]
        words += (unit * 8)[:rnd.randint(1, len(unit) * 7)]
    return words * rnd.choice([1, 1, 1, 2, 5])


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        texts = [periodic_text(rnd) for _ in range(rnd.randint(1, 6))]
        for (length, exponent) in ((6, 4), (12, 5)):
            got = periodic_runs._scan([" ".join(w).encode() for w in texts], length, exponent)
            for words, (n, runs, kept) in zip(texts, got, strict=True):
                want = brute_runs(words, length, exponent)
                gone = {i for s, size, p in want for i in range(s + p, s + size)}
                assert n == len(words) and runs == want
                assert kept.decode().split() == [w for i, w in enumerate(words) if i not in gone]


def test_grammar_derives_its_text():
    """Every rule's places hold the same words, and no pair of the start sequence occurs twice."""
    rnd = random.Random(9)
    words = [rnd.choice("abc") for _ in range(400)] + list("abcab" * 30)
    first = {}
    ids = np.array([first.setdefault(w, i) for i, w in enumerate(words)])
    top, (rule, place), (half, whole) = periodic_runs.re_pair(ids)
    spans = defaultdict(set)
    for r, s in zip(rule.tolist(), place.tolist(), strict=True):
        spans[r].add("".join(words[s:s + whole[r]]))
        assert 0 < half[r] < whole[r]
    assert all(len(v) == 1 for v in spans.values()) and len(spans) == len(half)
    ends = [*top.tolist()[1:], len(words)]
    symbols = ["".join(words[a:b]) for a, b in zip(top.tolist(), ends, strict=True)]
    pairs = Counter(zip(symbols, symbols[1:]))
    assert len(top) < len(words) / 2 and max(pairs.values()) <= 2  # two only where they overlap or split unlike


def test_long_runs_take_no_quadratic_time():
    (a,) = periodic_runs._scan([b"a " * 200_000], 6, 4)
    assert a[1] == [(0, 200_000, 1)] and a[2] == b"a"
    unit = " ".join(str(i) for i in range(5000))
    (b,) = periodic_runs._scan([" ".join([unit] * 6).encode()], 6, 4)
    assert b[1] == [(0, 30_000, 5000)] and b[2].decode() == unit


def test_planted_periods(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 50))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for doc_id, text in periodic_runs.plant_periods(docs).collect():
        words = [f"w{k}" for k in range(doc_id % 50)]
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert text.split() == words


def test_runs_of_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    got = periodic_runs.find_runs(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in got}
    for i in (3, 4, 5):
        assert by_id[i]["n_words"] == 0 and by_id[i]["runs"] == [] and by_id[i]["collapsed"] == ""
    assert [tuple(r) for r in by_id[6]["runs"]] == [(0, 48_000, 8)]
    assert by_id[6]["collapsed"] == "the quick onion of the thing and that"
    assert periodic_runs.find_runs(no_docs).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(9, np.int64), np.array([0]), 6, 2)


# --- importance resampling --------------------------------------------------


def test_buckets_are_checksums_of_the_joined_words():
    words = importance_resampling.words_of("Über die-Brücke, 3 ÄPFEL\x00x".encode())
    assert [w.decode() for w in words] == re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "Über die-brücke, 3 ÄpfelX".replace("ÄpfelX", "ÄPFEL\x00x").translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    grams = words + [a + b" " + b for a, b in zip(words, words[1:])]
    assert importance_resampling.buckets_of(words).tolist() == [zlib.crc32(g) % 10_000 for g in grams]
    assert importance_resampling.buckets_of([]).tolist() == []


@pytest.mark.parametrize("k", [1, 2, 7, 50, 99, 100])
def test_bisection_finds_the_kth_value(spark, k):
    rnd = random.Random(k)
    values = [rnd.choice([-(2 ** 45), -3, 0, 0, 5, 2 ** 45 + rnd.randint(0, 3)]) for _ in range(100)]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    want = sorted(values, reverse=True)[k - 1]
    assert importance_resampling.least_of_top(frame, "v", k) == (want, sum(v > want for v in values))
    assert importance_resampling.least_of_top(frame, "v", 101) is None


def brute_resample(docs, target, share=25, min_words=20, seed=7, size=10_000):
    def grams(text):
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        return len(words), [zlib.crc32(g.encode()) % size for g in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]

    per_doc = [(i, *grams(t)) for i, t in docs]
    s, t = Counter(b for _, _, g in per_doc for b in g), Counter(b for x in target for b in grams(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + size) / ((s[b] + 1) * (n_t + size))))
    rows = []
    for i, n, g in per_doc:
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, g)) // len(g) if g else 0
        rows.append((i, n, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = [(r[0], *r[2:], k + 1) for k, r in enumerate(fit[:share * len(fit) // 100])]
    rest = [(r[0], *r[2:], None) for r in fit[len(drawn):] + [r for r in rows if r[1] < min_words]]
    return sorted(drawn + rest, key=repr)


@pytest.mark.parametrize("case", ["plain", "one id", "few", "no target"])
def test_resampling_equals_brute_force(spark, case):
    rnd = random.Random(case)
    text = lambda: " ".join(rnd.choice(["Red", "blue", "tree", "sky", "é1", "run"]) for _ in range(rnd.randint(0, 60)))
    docs = [(i, text()) for i in range(200)]
    if case == "one id":  # rows of one id and, by twos, one text: ties at the cutoff
        docs = [(5, t) for _, t in docs[:60] for _ in (0, 1)] + [(None, docs[0][1])] * 9
    if case == "few":
        docs = docs[:3]
    docs += [(900, None), (901, ""), (902, "# $")]
    target = [] if case == "no target" else [text() + " sky sky blue" for _ in range(30)] + [None]
    got = importance_resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"),
                                         spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(docs, target)


def test_resampling_of_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    got = importance_resampling.resample(odd_docs, odd_docs, share=50, min_words=2)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(rows, [t for _, t in rows], 50, 2)
    assert importance_resampling.resample(no_docs, odd_docs).collect() == []
