"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (importance_resampling, language_id, learned_partitions, license_scan, lpt_sharding, minhash_dedup, mixing,
               periodic_runs, pieces, pivot_index, quality_rules, token_counts, url_filter)
from .registry import register


def _table(spark, sf_dir: str, name: str, *columns: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def read_file(path: str) -> bytes:
    """A vocabulary file on the driver; tasks get its bytes with their code."""
    with open(path, "rb") as f:
        return f.read()


OP3_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents
), t AS (SELECT greatest(1, CAST(ceil(sum(size) / {mixing.SHARD_WORDS}) AS BIGINT)) AS shards FROM d),
r AS (SELECT d.*, CAST('0x' || substr(h, 1, 8) AS BIGINT) % shards AS shard FROM d, t),
c AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS cell FROM r GROUP BY ALL),
s1 AS (SELECT source, CAST(sum(cell) AS BIGINT) AS source_size,
              row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM c GROUP BY source),
s2 AS (SELECT *, CAST([5, 2, 1][CAST((rank - 1) % 3 AS INT) + 1] AS DOUBLE) AS w,
              CAST(2 * source_size AS DOUBLE) AS lim FROM s1),
s3 AS (SELECT *, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total,
              coalesce(sum(lim) OVER b, 0) AS lim_before, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS w_left
       FROM s2 WINDOW b AS (ORDER BY lim / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, lim <= w * (total - lim_before) / w_left AS held FROM s3),
s5 AS (SELECT source, source_size, rank, total, CASE WHEN held THEN lim ELSE
         w * (total - sum(CASE WHEN held THEN lim ELSE 0 END) OVER ())
         / sum(CASE WHEN held THEN 0 ELSE w END) OVER () END AS target FROM s4),
s6 AS (SELECT *, target / {mixing.BLOCK_WORDS} AS x, floor(total / {mixing.BLOCK_WORDS} + 0.5) AS seats FROM s5),
s7 AS (SELECT *, floor(x + 0.5) AS near, ceil(count(*) OVER () * x / greatest(sum(x) OVER (), 1e-300)) + 2 AS slack FROM s6),
s8 AS (SELECT *, seats - sum(greatest(near - slack, 0)) OVER () AS open FROM s7),
s9 AS (SELECT *, CAST(unnest(range(CAST(greatest(near - slack, 0) AS BIGINT) + 1, CAST(near + slack AS BIGINT) + 1)) AS DOUBLE) AS j FROM s8),
s10 AS (SELECT *, row_number() OVER (ORDER BY x / (2 * j - 1) DESC, rank, j) AS pos FROM s9),
s11 AS (SELECT source, source_size, target, rank,
               CAST(max(greatest(near - slack, 0)) + count(*) FILTER (WHERE pos <= open) AS BIGINT) AS blocks
        FROM s10 GROUP BY ALL),
q1 AS (SELECT s11.*, shard, cell,
              CASE WHEN source_size > 0 THEN CAST(blocks AS DOUBLE) * cell / source_size ELSE 0 END AS x
       FROM c JOIN s11 ON c.source IS NOT DISTINCT FROM s11.source),
q2 AS (SELECT *, floor(x + 0.5) AS near,
              ceil(count(*) OVER w * x / greatest(sum(x) OVER w, 1e-300)) + 2 AS slack FROM q1 WINDOW w AS (PARTITION BY rank)),
q3 AS (SELECT *, blocks - sum(greatest(near - slack, 0)) OVER (PARTITION BY rank) AS open FROM q2),
q4 AS (SELECT *, CAST(unnest(range(CAST(greatest(near - slack, 0) AS BIGINT) + 1, CAST(near + slack AS BIGINT) + 1)) AS DOUBLE) AS j FROM q3),
q5 AS (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY x / (2 * j - 1) DESC, shard, j) AS pos FROM q4),
q6 AS (SELECT source, source_size, target, shard, cell,
              least((max(greatest(near - slack, 0)) + count(*) FILTER (WHERE pos <= open)) * {mixing.BLOCK_WORDS}, 2 * max(cell)) AS words
       FROM q5 GROUP BY source, source_size, target, shard, cell),
l AS (SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY h, doc_id, size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start FROM r)
SELECT doc_id, size, source_size, target,
       CAST(greatest(least(words - start, size), 0) + greatest(least(words - cell - start, size), 0) AS BIGINT) AS taken
FROM l JOIN q6 ON l.source IS NOT DISTINCT FROM q6.source AND l.shard = q6.shard
"""


@register("op3_sainte_lague_mix", OP3_SQL)
def op3_sainte_lague_mix(spark, sf_dir):
    """Words each document gives to a mix of 150 % of all words."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@register("op7_lpt_shards")
def op7_lpt_shards(spark, sf_dir):
    """All documents in 40 shards of near equal bytes, equal texts together."""
    return lpt_sharding.lpt_shards(_table(spark, sf_dir, "documents", "doc_id", "text"), 40)


@register("op4_url_ratio")
def op4_url_ratio(spark, sf_dir):
    """Verdict on every page url: rules, else the calibrated model ratio."""
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


@register("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    """Licence labels of every document, base phrases apart."""
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("detections", lambda d: d["base"])
    kept = F.filter("detections", lambda d: d["kept"] | d["base"])
    labels = lambda ds: F.array_join(F.array_sort(F.array_distinct(F.transform(ds, lambda d: d["label"]))), ",")
    starts = F.transform(base, lambda d: d["first_word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(kept).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda d: d["priority"])) / 100.0, F.lit(0.0)).alias("score"))


@register("op9_cross_parsing")
def op9_cross_parsing(spark, sf_dir):
    """Language of every document, learned from four fifths of the labels."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = language_id.identify(docs, language_id.language_samples(docs))
    held_out = F.coalesce(language_id.bucket(F.col("doc_id")) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@register("op6_sentencepiece")
def op6_sentencepiece(spark, sf_dir):
    """Piece ids of every document, decoded again and compared."""
    model = read_file(PIECE_MODEL)
    coded = pieces.encode(_table(spark, sf_dir, "documents", "doc_id", "text"), model)
    back = pieces.decode(coded.withColumn("_ids", F.col("ids")), model, "_ids")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
                       F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@register("op2_superminhash")
def op2_superminhash(spark, sf_dir):
    """Near-duplicate component of every document."""
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op8_edited_counts")
def op8_edited_counts(spark, sf_dir):
    """Tokens of every document before and after redaction."""
    ranks = read_file(RANKS)
    indexed = token_counts.index_counts(_table(spark, sf_dir, "documents", "doc_id", "text"), ranks)
    return token_counts.edit_counts(indexed, ranks, token_counts.REDACTIONS).drop("edited")


@register("op1_learned_partitions")
def op1_learned_partitions(spark, sf_dir):
    """20 nearest vectors of every 20th, by learned partitions."""
    return learned_partitions.nearest(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=20, every=20)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


@register("op5_pivot_index", OP5_SQL)
def op5_pivot_index(spark, sf_dir):
    """5 largest integer inner products of every 50th vector, exactly."""
    return pivot_index.top_products(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=5, every=50)


_ROOMS_SQL = ", ".join(f"('{m}', {room}, {str(two).lower()})" for m, (room, two) in quality_rules.MEASURES.items())
_PRIOR, _FENCE = quality_rules.PRIOR, quality_rules.FENCE
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT rid, unnest(list_transform(range(1, len(words) - 3), lambda i: {{'i': i, 'g': array_to_string(words[i:i + 4], ' ')}})) AS x FROM w),
g2 AS (SELECT rid, x.i AS i, count(*) OVER (PARTITION BY rid, x.g) AS c FROM g),
g3 AS (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS n FROM g2 WHERE c > 1),
r AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n FROM g3 GROUP BY rid),
m1 AS (SELECT w.rid, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
              CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
              CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
              CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
              coalesce(r.n, 0) AS n_repeat_words
       FROM w LEFT JOIN r ON w.rid = r.rid),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             1000 * n_symbols // (word_chars + 50) AS symbols, 1000 * n_dup_lines // (n_lines + 5) AS dup_lines,
             1000 * n_repeat_words // (n_words + 20) AS repeats, 100 * word_chars // greatest(n_words, 1) AS word_length FROM m1),
v AS (UNPIVOT (SELECT rid, lang, source, base_failed, symbols, dup_lines, repeats, word_length FROM m)
      ON symbols, dup_lines, repeats, word_length INTO NAME measure VALUE val),
b AS (SELECT lang, source, measure, CASE WHEN val < 64 THEN val ELSE (val >> (length(bin(val)) - 6)) << (length(bin(val)) - 6) END AS bucket,
             count(*) AS n FROM v WHERE NOT base_failed GROUP BY ALL),
u AS (SELECT lang, source, measure, bucket, n, 0 AS whole FROM b
      UNION ALL SELECT lang, NULL, measure, bucket, sum(n), 1 FROM b GROUP BY lang, measure, bucket),
c AS (SELECT *, sum(n) OVER (PARTITION BY whole, lang, source, measure ORDER BY bucket) AS upto,
             sum(n) OVER (PARTITION BY whole, lang, source, measure) AS al FROM u),
q AS (SELECT whole, lang, source, measure, max(al) AS n, min(bucket) FILTER (WHERE 4 * upto >= al) AS q1,
             min(bucket) FILTER (WHERE 4 * upto >= 3 * al) AS q3 FROM c GROUP BY ALL),
q2 AS (SELECT s.lang, s.source, s.measure, (s.n * s.q1 + {_PRIOR} * l.q1) // (s.n + {_PRIOR}) AS q1,
              (s.n * s.q3 + {_PRIOR} * l.q3) // (s.n + {_PRIOR}) AS q3
       FROM q s JOIN q l ON s.whole = 0 AND l.whole = 1 AND s.lang IS NOT DISTINCT FROM l.lang AND s.measure = l.measure),
f AS (SELECT lang, source, measure, q3 + {_FENCE} * (q3 - q1) + room AS high,
             CASE WHEN two THEN q1 - {_FENCE} * (q3 - q1) - room ELSE 0 END AS low
      FROM q2 JOIN (VALUES {_ROOMS_SQL}) AS t(name, room, two) ON measure = name),
bad AS (SELECT DISTINCT v.rid FROM v JOIN f ON v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source
        AND v.measure = f.measure WHERE val > high OR val < low)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept FROM m
"""


@register("op11_adaptive_quality", OP11_SQL)
def op11_adaptive_quality(spark, sf_dir):
    """Base rules, then the fences of each document's language and source."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return quality_rules.judge_quality(docs).drop("reasons")


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes, a bit at a time."""
    digits = f"list_transform(range(1, len(hex({text})), 2), lambda i: CAST('0x' || substr(hex({text}), i, 2) AS BIGINT))"
    bits = f"flatten(list_transform({digits}, lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), {step}), 4294967295)"


OP12_SQL = f"""
WITH d0 AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words,
                   {_crc32_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
d1 AS (SELECT *, len(words) AS n, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM d0),
d2 AS (SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + (h // 10) % 8) END AS p FROM d1),
d AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(0, n), lambda i:
        words[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS words FROM d2),
w AS (SELECT rid, n, unnest(range(0, n)) AS i, unnest(words) AS word FROM d),
e AS (SELECT a.rid, b.i - a.i AS q, a.i AS i FROM w a JOIN w b ON a.rid = b.rid AND a.word = b.word AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
s AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM e),
r0 AS (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT rid, start, length, min(q) AS period FROM r0 GROUP BY rid, start, length),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS k FROM r) WHERE k = 1),
lists AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS body FROM r GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT w.rid, string_agg(word, ' ' ORDER BY w.i) AS body FROM w ANTI JOIN gone ON w.rid = gone.rid AND w.i = gone.i GROUP BY w.rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lists.body, '')) AS runs_sha256, sha256(coalesce(kept.body, '')) AS collapsed_sha256
FROM d LEFT JOIN best ON d.rid = best.rid LEFT JOIN lists ON d.rid = lists.rid LEFT JOIN kept ON d.rid = kept.rid
"""


@register("op12_grammar_runs", OP12_SQL)
def op12_grammar_runs(spark, sf_dir):
    """Runs of repeated words, with periods planted in a tenth of the documents."""
    found = periodic_runs.find_runs(periodic_runs.plant_periods(_table(spark, sf_dir, "documents", "doc_id", "text")))

    def steeper(a, b):
        """Greater length / period first, compared crosswise; then start and period."""
        sign = lambda x, y: F.when(x < y, -1).when(x > y, 1)
        return F.coalesce(sign(b["length"] * a["period"], a["length"] * b["period"]), sign(a["start"], b["start"]),
                          sign(a["period"], b["period"]), F.lit(0))

    best = F.get(F.array_sort("runs", steeper), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    runs_text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(runs_text.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def _ngrams_sql(table: str, key: str) -> str:
    """rid, feature and count of the word 1- and 2-grams of a table's texts."""
    return f"""
SELECT rid, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM (
  SELECT {key} AS rid, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM {table} WHERE text IS NOT NULL)
"""


_B = importance_resampling.BUCKETS
OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
fd AS MATERIALIZED (SELECT rid, f, count(*) AS n FROM ({_ngrams_sql("docs", "rid")}) GROUP BY ALL),
fb AS MATERIALIZED (SELECT f, count(*) AS n FROM ({_ngrams_sql("benchmark", "0")}) GROUP BY ALL),
fs AS MATERIALIZED (SELECT f, {_crc32_sql("f")} % {_B} AS bucket FROM (SELECT DISTINCT f FROM (SELECT f FROM fd UNION ALL SELECT f FROM fb))),
s AS (SELECT bucket, sum(n) AS n FROM fd JOIN fs USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM fb JOIN fs USING (f) GROUP BY bucket),
tot AS (SELECT CAST(coalesce((SELECT sum(n) FROM s), 0) AS DOUBLE) AS S, CAST(coalesce((SELECT sum(n) FROM t), 0) AS DOUBLE) AS T),
gain AS (SELECT r.b AS bucket, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (tot.S + {_B})
                / ((CAST(coalesce(s.n, 0) AS DOUBLE) + 1) * (tot.T + {_B})))) AS BIGINT) AS gain
         FROM range({_B}) r(b) CROSS JOIN tot LEFT JOIN s ON s.bucket = r.b LEFT JOIN t ON t.bucket = r.b),
wt AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
       FROM fd JOIN fs USING (f) JOIN gain USING (bucket) GROUP BY rid),
sc AS (SELECT docs.rid, doc_id, coalesce(n_features, 0) AS n_features,
              CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight,
              CAST('0x' || substr(sha256('{importance_resampling.SEED}:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
       FROM docs LEFT JOIN wt ON docs.rid = wt.rid),
sc2 AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM sc),
dr AS (SELECT *, n_features >= 2 * {importance_resampling.MIN_WORDS} - 1 AS fits FROM sc2),
ra AS (SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS k, count(*) OVER (PARTITION BY fits) AS n FROM dr)
SELECT doc_id, n_features, weight, score,
       CASE WHEN fits AND k <= {importance_resampling.SHARE} * n // 100 THEN k END AS rank FROM ra
"""


@register("op13_importance_resampling", OP13_SQL)
def op13_importance_resampling(spark, sf_dir):
    """A quarter of the documents, drawn towards the benchmark's n-grams."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return importance_resampling.resample(docs, _table(spark, sf_dir, "benchmark", "text"))
