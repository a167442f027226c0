"""URL filter: host/path rules first, then a character language-model ratio.

Two smoothed variable-order Markov models over the characters of host + path
are counted from all URLs that the rules decide: one for allowed, one for
blocked URLs.  A URL without a rule is judged by the length-normalised
difference of its two log-likelihoods, against a threshold calibrated on the
rule-decided URLs that were held out of the counts.

DataFrame operations only.  Characters fall in 32 classes, so a context of
``ORDER - 1`` classes and its next class make a code below ``32 ** ORDER``:
the finished model has that fixed number of rows, whatever the input.  The counts
behind it come from every rule-decided URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import materialize

ORDER = 4          # characters of an n-gram: contexts of 0 to 3 characters
CLASSES = 32
SMOOTHING = 4.0    # weight of the shorter context in an interpolation
SCALE = 65536      # log ratios are kept as whole multiples of 1 / SCALE
BIN = 1024         # threshold candidates: multiples of BIN / SCALE
FOLDS = 5          # fold 0 calibrates, the others are counted

# Fixed values: (verdict, host, path) of the contract's rules.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Classes 1-26 letters, 27 digit, 28 '.', 29 '/', 30 '-' and '_', 31 the rest;
# 0 pads the start and closes the end.  They are written as '@' + class.
_FROM = _LOWER + "0123456789" + "./-_" + "@[\\]^"
_TO = _UPPER + "[" * 10 + "\\]^^" + "_" * 5


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z
    lower-cased; path from there up to ``? #``.  Null or no ``://``: empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules) -> Column:
    """``struct(rule, verdict)`` of the longest fitting rule, else null.  A
    rule fits its host and all subdomains if the path starts with its path."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the longest is tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def char_classes(text: Column) -> Column:
    """Array of the characters' classes, with the closing 0."""
    coded = F.regexp_replace(F.translate(text, _FROM, _TO), r"[^@A-Z\[\\\]^_]", "_")
    chars = F.filter(F.split(coded, ""), lambda c: c != "")
    return F.concat(F.transform(chars, lambda c: F.ascii(c) - 64), F.array(F.lit(0)))


def ngram_codes(classes: Column) -> Column:
    """Code of the ORDER-gram that ends at each position (0 before the start).

    The padded array is bound as a lambda variable, else it would be computed
    again for every position.
    """
    padded = F.concat(F.array(*[F.lit(0)] * (ORDER - 1)), classes)

    def codes(p: Column) -> Column:
        at = lambda i: sum((F.get(p, i + k) * CLASSES ** (ORDER - 1 - k) for k in range(1, ORDER)), F.get(p, i) * CLASSES ** (ORDER - 1))
        return F.transform(F.sequence(F.lit(0), F.size(p) - ORDER), at)

    return F.get(F.transform(F.array(padded), codes), F.lit(0))


def train_ratio(grams: DataFrame) -> DataFrame:
    """``code, ratio`` for every code: the whole number nearest to
    SCALE * ln(p(last class | context; allowed) / p(...; blocked)).

    ``grams``: ``code int, allowed boolean, n`` (times seen).  An order-k estimate
    is (count + SMOOTHING * shorter estimate) / (context count + SMOOTHING), so
    a context never seen falls back to the next shorter one.
    """
    spark = grams.sparkSession
    seen = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    full = grams.groupBy("code").agg(seen(F.col("allowed")).alias("a"), seen(~F.col("allowed")).alias("b"))
    full = materialize(full, "url_ngrams")
    probs = None
    for k in range(1, ORDER + 1):
        n = CLASSES ** k
        counts = full.groupBy((F.col("code") % n).alias("id")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        contexts = counts.groupBy(F.floor(F.col("id") / CLASSES).alias("ctx")).agg(F.sum("a").alias("ca"), F.sum("b").alias("cb"))
        cells = spark.range(n).withColumn("ctx", F.floor(F.col("id") / CLASSES)).withColumn("short", F.col("id") % (n // CLASSES))
        cells = cells.join(counts, "id", "left").join(contexts, "ctx", "left")
        if probs is None:
            cells = cells.withColumn("pa", F.lit(1.0 / CLASSES)).withColumn("pb", F.lit(1.0 / CLASSES))
        else:
            cells = cells.join(probs.withColumnRenamed("id", "short"), "short")
        est = lambda c, t, p: (F.coalesce(c, F.lit(0)) + SMOOTHING * F.col(p)) / (F.coalesce(t, F.lit(0)) + SMOOTHING)
        probs = cells.select("id", est(F.col("a"), F.col("ca"), "pa").alias("pa"), est(F.col("b"), F.col("cb"), "pb").alias("pb"))
    return probs.select(F.col("id").cast("int").alias("code"),
                        F.round(F.log(F.col("pa") / F.col("pb")) * SCALE).cast("int").alias("ratio"))


def score_strings(strings: DataFrame, model: DataFrame) -> DataFrame:
    """``host, path`` (distinct) -> plus ``mean``: mean log ratio per position.

    The model has exactly CLASSES ** ORDER rows of two integers (8 MB), hence
    the broadcast.  All positions of a string are in one task, so the partial
    sums leave one row per string for the shuffle.
    """
    at = strings.select("host", "path", F.explode(ngram_codes(char_classes(F.concat("host", "path")))).alias("code"))
    return at.join(F.broadcast(model), "code").groupBy("host", "path").agg(
        (F.sum("ratio") / F.count("ratio")).alias("mean"))


def threshold(scored: DataFrame) -> Column:
    """Scalar: the mean ratio (in 1 / SCALE) that best separates the
    calibration URLs: largest sum of both hit rates, the middle of all best
    candidates; 0 without URLs of both kinds.

    ``scored``: ``mean double, allowed boolean``.  The candidates are multiples
    of BIN, of which there are a bounded number.
    """
    bins = scored.groupBy(F.floor(F.col("mean") / BIN).alias("bin")).agg(
        F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("b"))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = lambda c: F.coalesce(F.sum(c).over(upto), F.lit(0))
    # gain of "allowed from this bin on" times both totals: whole numbers
    gain = (F.sum("a").over(whole) - below("a")) * F.sum("b").over(whole) + below("b") * F.sum("a").over(whole)
    ranked = bins.withColumn("gain", gain).withColumn("both", (F.sum("a").over(whole) > 0) & (F.sum("b").over(whole) > 0))
    best = ranked.withColumn("best", F.max("gain").over(whole)).filter((F.col("gain") == F.col("best")) & F.col("both"))
    return best.agg(F.coalesce((F.min("bin") + F.max("bin")) * BIN / 2.0, F.lit(0.0))).scalar()


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict,
    score``.

    ``score`` is the calibrated mean log ratio (natural logarithm per
    character, 0 at the threshold); URLs without a rule are allowed from 0 on.
    Null URLs and URLs without ``://`` have empty host and path and are judged
    as an empty string.  If no URL, or none of one kind, is decided by rules,
    the missing model is uniform.  Repeated rows are judged alike and count
    each time; other columns of ``pages`` are ignored, whatever their names.
    """
    host, path = url_parts(F.col(f"`{url_col}`"))
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("_hit", matching_rule(F.col("host"), F.col("path"), rules))
    held_out = F.pmod(F.crc32(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0
    known = urls.filter("_hit is not null").select(
        "host", "path", (F.col("_hit.verdict") == "allow").alias("allowed"), held_out.alias("held_out"))

    train = known.filter(~F.col("held_out")).groupBy("host", "path", "allowed").agg(F.count(F.lit(1)).alias("n"))
    grams = train.select(F.explode(ngram_codes(char_classes(F.concat("host", "path")))).alias("code"), "allowed", "n")
    model = materialize(train_ratio(grams), "url_ratio")
    means = materialize(score_strings(urls.select("host", "path").distinct(), model), "url_means")
    cut = threshold(known.filter("held_out").join(means, ["host", "path"]).select("mean", "allowed"))
    judged = urls.join(means, ["host", "path"]).withColumn("_excess", F.col("mean") - cut)
    return judged.select(
        "page_id", "host", "path", F.col("_hit.rule").alias("rule"),
        F.coalesce(F.col("_hit.verdict"), F.when(F.col("_excess") >= 0, "allow").otherwise("block")).alias("verdict"),
        (F.col("_excess") / SCALE).alias("score"))
