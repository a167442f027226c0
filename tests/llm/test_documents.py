"""Operators on documents against brute force, libraries and edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from conftest import SF_MID, SF_SMALL
from llm_fixtures import no_docs, odd_docs  # noqa: F401
from quarry.llm import (ORACLE, QUERIES, components, language_id, license_scan, lpt_sharding, minhash_dedup, mixing, pieces,
                        superminhash, token_counts, url_filter)
from quarry.llm.queries import PIECE_MODEL, RANKS, read_file
from quarry.plans.verify import compare, duck

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(sf):
    return duckdb.sql(f"SELECT * FROM '{sf}/documents.parquet' ORDER BY doc_id").df().to_dict("records")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    assert compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, duck(SF_SMALL))["match"]


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# --- sharding ---------------------------------------------------------------


def check_shards(rows, texts_by_id, n_shards):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r)
    for rs in by_shard.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    home = defaultdict(set)
    for r in rows:
        home[texts_by_id[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in home.values())
    return [sum(r["size"] for r in by_shard[s]) for s in range(n_shards)]


def test_shards_are_even_and_keep_groups(spark):
    docs = texts(SF_SMALL)
    rows = QUERIES["op7_lpt_shards"](spark, SF_SMALL).collect()
    text = {d["doc_id"]: d["text"] for d in docs}
    assert len(rows) == len(docs) and all(r["size"] == len(text[r["doc_id"]].encode()) + 16 for r in rows)
    loads = check_shards(rows, text, 40)
    groups = defaultdict(int)
    for d in docs:
        groups[d["text"]] += len(d["text"].encode()) + 16
    # the longest-processing-time bound
    assert max(loads) - min(loads) <= max(groups.values())
    assert max(loads) <= max(max(groups.values()), 4 / 3 * sum(loads) / 40)


def test_lpt_takes_the_least_loaded_shard():
    items = [(b"a", 7), (b"b", 6), (b"c", 5), (b"d", 4), (b"e", 3)]
    assert lpt_sharding.assign_lpt(items, 2) == [0, 1, 1, 0, 0]  # 7 | 6; 6+5; 7+4; tie of 11 to the lower shard


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    rows = lpt_sharding.lpt_shards(odd_docs, 3).collect()
    assert len(rows) == odd_docs.count()
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (3, 4)} == {(16, None), (16, 0)}
    assert len({r["shard"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert lpt_sharding.lpt_shards(no_docs, 3).count() == 0


# --- mixing -----------------------------------------------------------------


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    rows = mixing.mix(odd_docs, block_words=1).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by_source = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        s = by_source[r["source"]]
        s[0], s[1], s[2] = s[0] + r["taken"], s[1] + r["size"], r["target"]
        assert r["source_size"] >= r["size"]
    assert sorted(by_source, key=lambda s: (s is None, s)) == ["a", "b", "c", None]
    for taken, size, target in by_source.values():
        assert abs(taken - target) <= 2 and target <= 2 * size
    assert abs(sum(s[2] for s in by_source.values()) - 1.5 * sum(s[1] for s in by_source.values())) < 1e-6
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd_docs, block_words=1).collect()))
    assert mixing.mix(no_docs).count() == 0


def test_sainte_lague_by_hand(spark):
    rng = random.Random(5)
    for n in (1, 3, 12):
        votes = [rng.randint(1, 500) for _ in range(n)]
        seats = rng.randint(n, 200)
        want = [0] * n
        for _ in range(seats):
            i = max(range(n), key=lambda i: (votes[i] / (2 * want[i] + 1), -i))
            want[i] += 1
        df = spark.createDataFrame([(0, i, v * seats / sum(votes), seats) for i, v in enumerate(votes)], "g int, i int, x double, s int")
        got = mixing.sainte_lague(df, ["g"], "x", "s", ["i"], "won").orderBy("i").collect()
        assert [r["won"] for r in got] == want


# --- URL filter -------------------------------------------------------------


def brute_urls(pages):
    """The same model with dictionaries."""
    import math
    import zlib

    def parts(u):
        if u is None or "://" not in u:
            return "", ""
        rest = u[u.index("://") + 3:]
        host = re.match(r"[^/?#]*", rest)[0]
        return host.translate(ASCII_LOWER), re.match(r"[^?#]*", rest[len(host):])[0]

    def rule(host, path):
        fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits, key=lambda f: len(f[0])) if fits else (None, None)

    def cls(c):
        if c.isascii() and c.isalpha():
            return ord(c.upper()) - 64
        return 27 if c.isascii() and c.isdigit() else {".": 28, "/": 29, "-": 30, "_": 30}.get(c, 31)

    def grams(s):
        seq = [0] * 3 + [cls(c) for c in s] + [0]
        return [tuple(seq[i:i + 4]) for i in range(len(seq) - 3)]

    rows = [(pid, *parts(u)) for pid, u in pages]
    rows = [(pid, h, p, *rule(h, p)) for pid, h, p in rows]
    counts = {"allow": defaultdict(int), "block": defaultdict(int)}
    fold = lambda pid: zlib.crc32(str(pid).encode()) % 5
    for pid, h, p, _, v in rows:
        if v and fold(pid):
            for g in grams(h + p):
                for k in range(1, 5):
                    counts[v][g[4 - k:]] += 1
                    counts[v][("ctx", *g[4 - k:3])] += 1

    def prob(v, g):
        p = 1 / 32
        for k in range(1, 5):
            p = (counts[v][g[4 - k:]] + 4 * p) / (counts[v][("ctx", *g[4 - k:3])] + 4)
        return p

    def mean(s):
        gs = grams(s)
        return sum(round(math.log(prob("allow", g) / prob("block", g)) * 65536) for g in gs) / len(gs)

    held = [(math.floor(mean(h + p) / 1024), v) for pid, h, p, _, v in rows if v and not fold(pid)]
    a, b = [x for x, v in held if v == "allow"], [x for x, v in held if v == "block"]
    cut = 0.0
    if a and b:
        gain = {c: sum(x >= c for x in a) * len(b) + sum(x < c for x in b) * len(a) for c in {x for x, _ in held}}
        best = [c for c in gain if gain[c] == max(gain.values())]
        cut = (min(best) + max(best)) * 512.0
    return {pid: (h, p, r, v or ("allow" if mean(h + p) >= cut else "block")) for pid, h, p, r, v in rows}


def test_urls_match_brute_force(spark):
    pages = duckdb.sql(f"SELECT page_id, url FROM '{SF_MID}/pages.parquet'").fetchall()
    got = {r["page_id"]: tuple(r)[1:] for r in QUERIES["op4_url_ratio"](spark, SF_MID).collect()}
    want = brute_urls(pages)
    assert got.keys() == want.keys()
    assert {k for k in got if got[k] != want[k]} == set()


def test_urls_of_odd_rows(spark):
    urls = ["http://Example.COM/en/x", "https://www.example.com/en/y?q", "ftp://a.net/es/", "http://net/fr/z#t", "http://anet/es/",
            None, "", "no scheme.com/", "http://", "http://x.com?/y", "http://x.com", "http://a.org/" + "b/" * 40_000, "http://ü.org/Ä_-^@",
            "http://Example.COM/en/x"]
    pages = spark.createDataFrame([(i if i else None, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    got = url_filter.judge_urls(pages).collect()
    assert len(got) == len(urls)
    by = {r["page_id"]: r for r in got}
    assert by[13][1:5] == ("example.com", "/en/x", "example.com/en/", "block")
    assert by[1][1:5] == ("www.example.com", "/en/y", "www.example.com/en/", "allow")
    assert by[2]["rule"] == "net/es/" and by[3]["rule"] == "net/fr/" and by[4]["rule"] is None
    assert [(by[i]["host"], by[i]["path"], by[i]["rule"]) for i in (5, 6, 7, 8)] == [("", "", None)] * 4
    assert (by[9]["host"], by[9]["path"], by[9]["rule"], by[10]["path"]) == ("x.com", "", None, "")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


# --- SentencePiece ----------------------------------------------------------


def random_texts(n, seed=1):
    rng = random.Random(seed)
    pool = "abcdefghij the ing  on  ▁ éüñ 0123 \n\t.,;"
    out = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 90))) for _ in range(n)]
    wide = [(32, 126), (160, 600), (0x400, 0x4FF), (0x4E00, 0x4FFF), (0x1F600, 0x1F640)]
    out += ["".join(chr(rng.randint(*rng.choice(wide))) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    return [*out, "", " ", "   ", "a  b", "  lead", "trail  ", "x" * 500, " " * 70 + "x", "a\u0000b"]


def test_piece_ids_equal_the_library():
    import sentencepiece

    ours = pieces.Encoder(pieces.Model(read_file(PIECE_MODEL)))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    sample = random_texts(800) + [d["text"] for d in texts(SF_SMALL)]
    for text, ids in zip(sample, ours.encode(sample), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text), text[:80]


def test_unigram_models_take_the_best_score():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(read_file(PIECE_MODEL))
    proto.trainer_spec.model_type = 1
    rng = random.Random(3)
    for p in proto.pieces:
        if p.type == 1:
            p.score = -rng.uniform(3, 12) * (1 + 0.2 * len(p.piece))
    data = proto.SerializeToString()
    ours, library = pieces.Encoder(pieces.Model(data)), sentencepiece.SentencePieceProcessor(model_proto=data)
    score = lambda ids: sum(proto.pieces[i].score for i in ids if proto.pieces[i].type == 1)
    for text in ["the thing on the mat", "naturally, information theory", "abcdefgh ijkl"]:
        got = np.frombuffer(ours.encode([text])[0], "<i4").tolist()
        assert score(got) == pytest.approx(score(library.encode(text)), abs=1e-3)


def test_pieces_of_odd_rows(spark, odd_docs, no_docs):
    model = read_file(PIECE_MODEL)
    rows = pieces.decode(pieces.encode(odd_docs, model), model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["decoded"] == (r["text"].replace("▁", " ") if r["text"] is not None else None)
    assert pieces.encode(no_docs, model).count() == 0


def test_round_trip_of_the_query(spark):
    assert QUERIES["op6_sentencepiece"](spark, SF_SMALL).filter("not round_trip").count() == 0


def test_key_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 62, 5000, dtype=np.uint64))
    rng.shuffle(keys)
    table = pieces.KeyTable(4)
    for part in np.array_split(keys, 7):
        table.add(part)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1 << 63)) == -1).all()


# --- token counts -----------------------------------------------------------


def library_counts():
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, read_file(RANKS).splitlines())}
    enc = tiktoken.Encoding("all", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(enc.encode_ordinary(text))


def test_counts_follow_random_edits():
    count, counter, rng = library_counts(), token_counts.Counter(read_file(RANKS)), random.Random(4)
    pool = ["a", "b", " ", "  ", "\n", "'s", "'ll", "l", "1", "é", "漢", "!", "?? ", "\t"]
    for _ in range(300):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 400)))
        found = token_counts.splitter().findall(text)
        tree = token_counts.CountTree(text, *(x or [0] for x in token_counts.leaves(found, counter.counts(found))))
        for _ in range(6):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 0, 1, 2, 5, 60]))
            new = "".join(rng.choice(pool) for _ in range(rng.randint(0, 6)))
            tree.edit(a, b, new, counter)
            text = text[:a] + new + text[b:]
            assert tree.joined() == text and tree.tokens[1] == count(text)


def test_edited_counts_of_documents(spark):
    ranks, count = read_file(RANKS), library_counts()
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    rows = token_counts.edit_counts(token_counts.index_counts(docs, ranks), ranks, token_counts.REDACTIONS).collect()
    text = {d["doc_id"]: d["text"] for d in texts(SF_MID)}
    assert sum(r["n_edits"] for r in rows) > 20
    for r in rows:
        assert r["n_tokens"] == count(text[r["doc_id"]]) and r["n_tokens_edited"] == count(r["edited"])
        if r["n_edits"]:
            assert 0 < r["n_reencoded"] <= 8 * token_counts.BLOCK * r["n_edits"]
        else:
            assert r["edited"] == text[r["doc_id"]]


def test_edits_given_as_a_column(spark):
    ranks, count = read_file(RANKS), library_counts()
    text = "one two  three's a crowd\n" * 40
    docs = spark.createDataFrame([(1, text, [(0, 3, "ONE"), (4, 4, " and a half"), (len(text), len(text), "!")]), (2, None, None), (3, "", [(0, 0, "new")])],
                                 "doc_id long, text string, e array<struct<start:int,stop:int,insert:string>>")
    indexed = token_counts.index_counts(docs, ranks).join(docs.select("doc_id", "e"), "doc_id")
    rows = {r["doc_id"]: r for r in token_counts.edit_counts(indexed, ranks, edits_col="e").collect()}
    assert rows[1]["edited"] == "ONE  and a half" + text[4:] + "!" and rows[1]["n_tokens_edited"] == count(rows[1]["edited"])
    assert rows[2]["edited"] is None and rows[2]["n_tokens_edited"] == 0
    assert rows[3]["edited"] == "new" and rows[3]["n_tokens_edited"] == count("new")


def test_counts_of_odd_rows(spark, odd_docs, no_docs):
    ranks = read_file(RANKS)
    rows = token_counts.index_counts(odd_docs, ranks).collect()
    assert len(rows) == odd_docs.count() and all(r["n_tokens"] == 0 for r in rows if not r["text"])
    assert token_counts.edit_counts(token_counts.index_counts(no_docs, ranks), ranks, token_counts.REDACTIONS).count() == 0


# --- language ID ------------------------------------------------------------


def test_parse_equals_longest_matches():
    rng = random.Random(6)
    samples = {k: "".join(rng.choice(a) for _ in range(300)) for k, a in (("x", "abc "), ("y", "acde "))}
    parser = language_id.Parser(samples)
    lookup = parser.lookup()
    for _ in range(60):
        text = "".join(rng.choice("aBcdez é.1") for _ in range(rng.randint(0, 700)))
        clean = "".join(c.lower() if c.isalpha() else " " for c in text)
        clean = re.sub(" +", " ", clean).lstrip(" ")
        n, rates = parser.rates([text], lookup)
        assert n[0] == sum(c.isalpha() for c in text)
        for k, lang in enumerate(parser.languages):
            phrases = 0
            for i in range(0, len(clean), language_id.SEGMENT):
                rest = clean[i:i + language_id.SEGMENT]
                while rest:
                    m = 1
                    while m < len(rest) and rest[:m + 1] in samples[lang]:
                        m += 1
                    phrases += 1
                    rest = rest[m:]
            assert rates[0, k] == pytest.approx(phrases * parser.weight[k] / max(1, len(clean)))


def test_held_out_accuracy(spark):
    import zlib

    rows = QUERIES["op9_cross_parsing"](spark, SF_MID).collect()
    lang = {d["doc_id"]: d["lang"] for d in texts(SF_MID)}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97


def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    samples = language_id.language_samples(odd_docs)
    assert set(samples) <= {"en", "fr"} and samples
    rows = language_id.identify(odd_docs, samples).collect()
    assert len(rows) == odd_docs.count()
    assert {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5, 7)} == dict.fromkeys((3, 4, 5, 7), "und")
    assert all(r["lang_pred"] in samples for r in rows if r["doc_id"] in (1, 6, 8))
    assert language_id.language_samples(no_docs) == {}
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, {}).collect()} == {"und"}
    assert language_id.identify(no_docs, {}).count() == 0


def test_label_with_little_text_wins_nothing(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang")
    rare = next(i for i in range(10**6, 10**6 + 50) if zlib.crc32(str(i).encode()) % 5)
    more = docs.unionByName(spark.createDataFrame([(rare, "ok", "xx")], "doc_id long, text string, lang string"))
    samples = language_id.language_samples(more)
    assert samples["xx"] == "ok"
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in language_id.identify(docs, samples).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97


def test_samples_of_short_texts_are_filled(spark):
    """Also if copies come first and texts lie in several tasks."""
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(60)), "en") for i in range(3000)] + [(i, "copied text", "en") for i in range(3000, 4000)]
    got = language_id.language_samples(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7))
    first = sorted({hashlib.md5(t.encode()).hexdigest(): t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5}.items())
    assert got == {"en": language_id.squeeze(" ".join(t.strip() for _, t in first))[:language_id.SAMPLE_CHARS]}
    assert len(got["en"]) == language_id.SAMPLE_CHARS


# --- licences ---------------------------------------------------------------


def test_base_phrases_match_brute_force(spark):
    phrases = [(p.split(), label) for p, label in license_scan.BASE_PHRASES]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    rows = {r["doc_id"]: r for r in QUERIES["op10_license_scan"](spark, SF_MID).collect()}
    n_hits = 0
    for d in texts(SF_MID):
        w = word.findall(d["text"].translate(ASCII_LOWER))
        hits = [(k, label) for p, label in phrases for k in range(len(w)) if w[k:k + len(p)] == p]
        n_hits += len(hits)
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(hits), ",".join(sorted({x for _, x in hits})))
        assert (r["first_word"], r["last_word"]) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert n_hits > 10


def test_rules_and_suppression():
    rules = license_scan.default_rules()
    assert len(rules) > 300
    scan = license_scan.Scanner(rules).scan
    kept = lambda text: sorted({rules[i].label for i, _, _, keep in scan(text.encode())[1] if keep})
    assert kept("Licensed under the Apache License, Version 2.0 (the \"License\")") == ["apache-2"]
    assert kept("SPDX-License-Identifier: GPL-3.0-or-later") == ["gpl-3"]
    assert kept("Released under the BSD 3-Clause License.") == ["bsd-3"]
    assert kept("under CC BY-NC-SA 4.0 license") == ["cc-by-nc-sa"]
    assert kept("the general public went to the apache museum") == []
    n, found = scan(b"x Released under the MIT License y")
    spans = [(rules[i].name.split(":")[0], a, b, keep) for i, a, b, keep in found]
    assert n == 7 and ("released", 1, 5, True) in spans and ("named", 4, 5, False) in spans and ("base", 2, 5, False) in spans


def spelled(parsed):
    """All strings of a pattern's tree; a repeat stands its least and most times, any other character class is "x"."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            some = [chr(arg)]
        elif op == "IN":
            some = ["x"] if str(arg[0][0]) == "NEGATE" else [chr(v) for _, v in arg]
        elif op == "NOT_LITERAL":
            some = ["x"]
        elif op == "BRANCH":
            some = [x for branch in arg[1] for x in spelled(branch)]
        elif op == "SUBPATTERN":
            some = spelled(arg[3])
        else:
            assert op == "MAX_REPEAT", op
            low, high, inner = arg[0], min(int(arg[1]), max(1, int(arg[0])) + 1) if int(arg[1]) > 1 else int(arg[1]), spelled(arg[2])
            some = [x * low for x in inner[:1]] + [x * high for x in inner] if high > low else [x * low for x in inner]
        out = [a + b for a in out for b in some]
    return out


def test_rules_pass_their_own_keywords():
    import re._parser

    rules = license_scan.default_rules()
    scanner = license_scan.Scanner(rules)
    for i, r in enumerate(rules):
        words = spelled(re._parser.parse(r.pattern))
        if r.pattern.startswith("you may not use this file"):  # gated by the licence's name, see TEXTS
            words = [w + " apache" for w in words]
        for text in words:
            assert r.keywords <= set(text.split()), (r.name, text)
        for text in words[::max(1, len(words) // 8)]:
            assert i in {d[0] for d in scanner.scan(text.encode())[1]}, (r.name, text)


@pytest.mark.parametrize("text, label", [
    ("Licensed under Creative Commons Attribution Share Alike 3.0", "cc-by-sa"),
    ("Licensed under Creative Commons Attribution-NonCommercial 4.0", "cc-by-nc"),
    ("Licensed under Creative Commons Attribution Non Commercial 4.0", "cc-by-nc"),
    ("Licensed under Creative Commons Attribution NoDerivs 3.0", "cc-by-nd"),
    ("the Creative Commons Attribution Non-Commercial Share Alike 2.5 Generic License", "cc-by-nc-sa"),
    ("the Creative Commons Attribution 4.0 International License", "cc-by"),
    ("0BSD license", "bsd-0"), ("GPL2 license", "gpl-2"), ("LGPLv3 license", "lgpl-3"), ("AGPLv3 license", "agpl-3"),
    ("licensed under LGPLv2.1", "lgpl-2.1"), ("GPL license", "gpl"),
    ("subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
    ("under the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
    ("the Mozilla Public License", "mpl"), ("licensed under the Eclipse Public License", "epl"),
    ("released under the Eclipse Public License v2.0", "epl-2"),
    ("licensed under the GNU General Public License version 3", "gpl-3"),
    ("distributed under the GNU Lesser General Public License, version 2.1", "lgpl-2.1"),
    ("Apache License 2.0", "apache-2"),
])
def test_licence_names(text, label):
    rules = license_scan.default_rules()
    found = license_scan.Scanner(rules).scan(text.encode())[1]
    assert {rules[i].label for i, _, _, keep in found if keep} == {label}


GPL_HEADER = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License "
              "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later "
              "version. It is distributed in the hope that it will be useful; see the GNU {} Public License for more details.")
BSD_TEXT = "Redistribution and use in source and binary forms, with or without modification, are permitted"
ZERO_BSD = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            'granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES')
ISC_TEXT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.")
NOTICES = [
    (GPL_HEADER.format("General", "3", "General"), "gpl-3"), (GPL_HEADER.format("General", "2", "General"), "gpl-2"),
    (GPL_HEADER.format("Lesser General", "2.1", "Lesser General"), "lgpl-2.1"),
    (GPL_HEADER.format("Affero General", "3", "Affero General"), "agpl-3"),
    ("you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the "
     "Free Software Foundation.", "gpl-2"),
    (ZERO_BSD, "bsd-0"), (ISC_TEXT, "isc"),
    ("Copyright (c) 2011, A. Author. All rights reserved. " + BSD_TEXT, "bsd"),
    ("Copyright (c) 2011, A. Author. All rights reserved.", "proprietary"),
    ("All rights reserved. " + "word " * 150 + "MIT License", "mit,proprietary"),
    (BSD_TEXT + " ... Neither the name of the author nor the names of its contributors may be used to endorse or promote products",
     "bsd-3"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2,mit"),
    ("SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR MIT) AND BSD-3-Clause", "bsd-3,gpl-2,mit"),
    ("SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception", "apache-2"),
    ("SPDX-License-Identifier: MIT and so on", "mit"),
    ("text: CC BY-SA 4.0", "cc-by-sa"), ("CC0 1.0 Universal", "cc0"), ("cc by nc sa 4.0", "cc-by-nc,cc-by-nc-sa"),
    ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa"), ("Creative Commons Zero v1.0 Universal", "cc0"),
    ('BSD 2-Clause "Simplified" License', "bsd-2"), ('BSD 3-Clause "New" or "Revised" License', "bsd-3"),
    ("the GPL license", "gpl"), ("we sell 4.0 things by the mile", ""),
]


@pytest.mark.parametrize("text, labels", NOTICES)
def test_licence_notices(text, labels):
    rules = license_scan.default_rules()
    found = license_scan.Scanner(rules).scan(text.encode())[1]
    assert ",".join(sorted({rules[i].label for i, _, _, keep in found if keep})) == labels


def brute_scan(rules, compiled, text):
    """Every rule on every text, every pair of detections compared."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(ASCII_LOWER))
    line = " ".join(words)
    found = [(m.start(), m.end(), k) for k, regex in enumerate(compiled) for m in regex.finditer(line)]
    for m in re.finditer(r"(?<![^ ])spdx licen[cs]e identifier ", line):
        rest = re.sub(r" with (?:[^ ]+ ){1,4}?(?:exception|note)(?: \d \d)?(?![^ ])", lambda x: "\0" * len(x[0]), line[m.end():])
        at = m.end()
        for n, part in enumerate(re.split(r"( (?:or|and) )", rest)):
            term = part.rstrip("\0")
            if n % 2 == 0:
                fits = [(len(x[0]), -k) for k, r in enumerate(rules) if r.identifier for x in [re.match(f"(?:{r.identifier})(?![^ ])", term)] if x]
                if not fits:
                    break
                if n:
                    found.append((at, at + max(fits)[0], -max(fits)[1]))
                if max(fits)[0] < len(term):
                    break
            at += len(part)
    place = lambda c: line[:c].count(" ")
    rank = lambda d: (-rules[d[2]].priority, d[0] - d[1], d[2])
    out = [(k, place(a), place(b - 1), not any(
        e != (a, b, k) and e[0] <= a and e[1] >= b and rules[e[2]].priority >= rules[k].priority
        and ((e[0], e[1]) != (a, b) or rank(e) < rank((a, b, k))) for e in found)) for a, b, k in found]
    kept = [(rules[k].label, a) for k, a, _, keep in out if keep]

    def says_less(k, a):
        label = rules[k].label
        fuller = [x for x, _ in kept if x != "proprietary"] if label == "proprietary" else license_scan.GENERAL.get(label, ())
        return any(x in fuller and abs(b - a) <= license_scan.NOTICE_WORDS for x, b in kept)

    return len(words), sorted((k, a, b, keep and (rules[k].base or not says_less(k, a))) for k, a, b, keep in out)


def test_scan_equals_brute_force():
    rules = license_scan.default_rules()
    scanner = license_scan.Scanner(rules)
    compiled = [re.compile(f"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in rules]
    rng = random.Random(5)
    cases = [d["text"] for d in texts(SF_MID) if re.search("licen|reserved", d["text"] or "", re.I)][:40] + [t for t, _ in NOTICES]
    cases += [" ".join(rng.choice(NOTICES)[0] + " x" * rng.choice([0, 3, 90, 101]) for _ in range(4)) for _ in range(60)]
    seen = set()
    for text in cases:
        n, found = scanner.scan(text.encode())
        assert (n, sorted(found)) == brute_scan(rules, compiled, text), text
        seen |= {(rules[i].label, keep) for i, _, _, keep in found}
    assert len(seen) > 25


def test_licences_of_odd_rows(spark, odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in license_scan.scan_licenses(odd_docs).collect()}
    assert rows[3]["n_words"] == rows[4]["n_words"] == 0 and rows[3]["detections"] == []
    assert any(d["base"] and d["label"] == "mit" and d["first_word"] == 0 for d in rows[9]["detections"])
    assert license_scan.scan_licenses(no_docs).count() == 0


# --- near-duplicates --------------------------------------------------------


def word_sets(docs):
    out = {}
    for i, text in docs:
        w = WORD.findall((text or "").translate(ASCII_LOWER))
        out[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def brute_components(docs):
    sets = word_sets(docs)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def dedup(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_dedup.near_duplicates(df).collect()}


def test_near_duplicates_match_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in texts(SF_SMALL)]
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    # a text and copies of it: each is like the text, but not like the others
    hub = [word() for _ in range(400)]
    docs.append((100_000, " ".join(hub)))
    for k in range(40):
        w = list(hub)
        for j in rng.sample(range(0, 400, 8), 11):
            w[j] = word()
        docs.append((90_000 + k, " ".join(w)))
    # a chain: each text is like the next only
    for k in range(30):
        docs.append((110_000 + k, " ".join(hub[:0] + [f"c{j}" for j in range(k * 20, k * 20 + 200)])))
    got = dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got == brute_components(docs)
    assert len({c for i, (_, c) in got.items() if i >= 110_000}) == 1


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    rows = minhash_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert got[1] == (9, 1, True) and got[2] == (9, 1, False)
    assert [got[i] for i in (3, 4, 5)] == [(0, i, True) for i in (3, 4, 5)]
    assert got[6][0] == 8 and got[None][1:] == (None, True) and got[7] == (1, 7, True)
    assert minhash_dedup.near_duplicates(no_docs).count() == 0


def test_rows_of_a_repeated_id_keep_their_own_links(spark):
    """Ids repeat with other texts; each row has the component of its text."""
    rng = random.Random(12)
    base = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)) for _ in range(12)]
    near = [b + " one more" for b in base]
    docs = [(1, base[0]), (5, base[0]), (5, base[1]), (5, near[2]), (7, base[2]), (9, near[1]), (9, near[3]), (3, base[3]), (5, base[4]), (5, base[4])]
    docs += [(20 + i % 3, t) for i, t in enumerate(base[5:] + near[5:])]  # two texts and more an id
    sets = word_sets(list(enumerate(t for _, t in docs)))
    parent = list(range(len(docs)))
    for _ in docs:
        for a in range(len(docs)):
            for b in range(len(docs)):
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    parent[a] = parent[b] = min(parent[a], parent[b])
    least = {}
    for k, (i, _) in enumerate(docs):
        least[parent[k]] = min(i, least.get(parent[k], i))
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, place int")
    got = {r["row"]: (r["doc_id"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(frame, row_col="place").collect()}
    assert got == {k: (i, least[parent[k]], i == least[parent[k]]) for k, (i, _) in enumerate(docs)}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    for n in (2, 30, 400):
        errors = []
        for _ in range(40):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            b = a.copy()
            b[: n // 5] = rng.integers(0, 1 << 63, n // 5, dtype=np.uint64)
            s = superminhash.signatures([np.unique(a), np.unique(b)])
            errors.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04


def test_shingles_match_words():
    sample = [d["text"] for d in texts(SF_SMALL)] + ["", " \n", "a", "A  b\tC d", "a b c d e", "a b a b a b a b", None]
    sets = superminhash.shingle_sets([t.encode() if t is not None else None for t in sample])
    assert [len(s) for s in sets] == [len(s) for s in word_sets(list(enumerate(sample))).values()]


@pytest.mark.parametrize("limit", [1 << 18, 16])
def test_components(spark, monkeypatch, limit):
    monkeypatch.setattr(components, "FOREST_LINKS", limit)  # 16: star rounds to the end
    rng = random.Random(9)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1300)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    a, b = np.array(edges).T
    nodes, roots = components.union_find(a, b)
    assert got == dict(zip(nodes.tolist(), roots.tolist(), strict=True))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
