"""Stage 4 queries: topic text, terms, vocabulary, c-TF-IDF keywords, topic
info and similarity, centroid assignment, representative documents, curated
label join (C8, C20, H8, M1-M10, D1, B6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import density as DN
from ..operators.aggregates import distinct_values, top_k_per_group
from ..operators import topics as TP
from ..operators.filters import keep_curated
from ..operators.joins import label_topics
from ..operators.text_vectors import fit_text_vectors, term_counts, text_vectors
from ..sources.readers import table
from ..sources.writers import materialize, scratch_path, write_report_csv
from . import oracle_sql as S
from . import tagging
from .cleaning import EN_LEN_SQL, english_articles
from .registry import register, sql_list, sql_str

STOP = TP.topic_stopwords()
STOP_SQL = sql_list(STOP)

_TITLE_SQL = S.normalize_text("trim(split_part(text, chr(10), 1))")
_CLEAN_SQL = S.light_clean(S.normalize_text("text"))
TOPIC_TEXT_SQL = f"{_TITLE_SQL} || '. ' || array_to_string({S.words_list(_CLEAN_SQL)}[1:{L.TOPIC_MAX_WORDS}], ' ')"

OCC_SQL = f"""
d AS (SELECT doc_id, source AS topic, {TOPIC_TEXT_SQL} AS tt FROM documents WHERE {EN_LEN_SQL}),
tok AS (SELECT doc_id, topic, list_filter({S.tokens('tt')}, lambda t: NOT list_contains({STOP_SQL}, t)) AS w FROM d),
occ AS (SELECT doc_id, topic,
               unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
        FROM tok)
"""

WEIGHTS_SQL = f"""
tf AS (SELECT topic, term, count(*) AS tf FROM occ GROUP BY ALL),
dfc AS (SELECT term, count(DISTINCT topic) AS df FROM occ GROUP BY term),
voc AS (SELECT term FROM dfc WHERE df >= {L.MIN_DF} AND df <= {L.MAX_DF} * (SELECT count(DISTINCT topic) FROM d)),
tfv AS (SELECT * FROM tf WHERE term IN (SELECT term FROM voc)),
tot AS (SELECT *, sum(tf) OVER (PARTITION BY topic) AS class_total, sum(tf) OVER (PARTITION BY term) AS term_total
        FROM tfv),
aw AS (SELECT floor(avg(n)) AS a FROM (SELECT topic, sum(tf) AS n FROM tfv GROUP BY topic)),
wt AS (SELECT topic, term, tf, tf / class_total * ln(1 + (SELECT a FROM aw) / term_total) AS weight FROM tot),
kw AS (SELECT topic, term, weight, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM wt)
       WHERE rank <= {L.TOP_N_WORDS})
"""


REP_SQL = """
dt AS (SELECT doc_id, topic, term, count(*) AS n FROM occ GROUP BY ALL),
idf AS (SELECT DISTINCT term, ln(1 + (SELECT a FROM aw) / term_total) AS idf FROM tot),
wn AS (SELECT topic, sqrt(sum(weight * weight)) AS wn FROM wt GROUP BY topic),
dv AS (SELECT dt.doc_id, dt.topic, dt.term, dt.n * idf.idf AS v FROM dt JOIN idf ON dt.term = idf.term),
pd AS (SELECT dv.doc_id, dv.topic, sum(dv.v * wt.weight) AS dot, sqrt(sum(dv.v * dv.v)) AS dn
       FROM dv JOIN wt ON dv.topic = wt.topic AND dv.term = wt.term GROUP BY ALL),
sim AS (SELECT pd.topic, pd.doc_id, pd.dot / (pd.dn * wn.wn) AS similarity FROM pd JOIN wn ON pd.topic = wn.topic),
rep AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(similarity, 9) DESC, doc_id) AS rank
                      FROM sim) WHERE rank <= 3)
"""


def topic_docs(spark, sf_dir):
    """Kept, cleaned articles with ``topic`` (= source) and the C8 topic text."""
    arts = english_articles(spark, sf_dir)
    return T.with_clean(arts, "text", "text_clean").select(
        F.col("article_id").alias("doc_id"),
        F.col("source").alias("topic"),
        T.topic_text(T.normalize_text("title"), "text_clean").alias("topic_text"),
    )


def occurrences_of(docs):
    return TP.doc_terms(docs, "topic_text", ["doc_id", "topic"], STOP)


def occurrences(spark, sf_dir):
    return occurrences_of(topic_docs(spark, sf_dir))


def weights_of(docs):
    """c-TF-IDF over the topic-level vocabulary (the vectoriser is fitted on
    one document per topic, so min/max document frequency count topics).

    (topic, term) counts are restricted to the vocabulary in the same pass and
    written once to the checkpoint folder, and so are the weights; every later
    step reads these small tables, never the text again.
    """
    n_topics = docs.select(F.count_distinct("topic")).scalar()
    tf = TP.topic_term_counts(occurrences_of(docs), "topic")
    tfv = materialize(TP.restrict_to_vocabulary(tf, L.MIN_DF, L.MAX_DF, n_topics), "topic_term_counts")
    return materialize(TP.class_tfidf(tfv, "topic"), "topic_weights")


def weights(spark, sf_dir):
    return weights_of(topic_docs(spark, sf_dir))


def written_docs(spark, sf_dir):
    """``topic_docs`` and ``text_clean``, cleaned once and written, for reports
    that read the texts more than once."""
    arts = T.with_clean(english_articles(spark, sf_dir), "text", "text_clean")
    return materialize(arts.select(
        "article_id", F.col("article_id").alias("doc_id"), F.col("source").alias("topic"), "text_clean",
        T.topic_text(T.normalize_text("title"), "text_clean").alias("topic_text")), "topic_docs")


@register("topic_text", f"""
SELECT doc_id, md5({TOPIC_TEXT_SQL}) AS text_md5 FROM documents WHERE {EN_LEN_SQL}
""")
def q_topic_text(spark, sf_dir):
    """Title + ". " + first 300 words of the cleaned text."""
    return topic_docs(spark, sf_dir).select("doc_id", F.md5("topic_text").alias("text_md5"))


@register("top_terms", f"""
WITH {OCC_SQL}
SELECT term, count(*) AS count FROM occ GROUP BY term ORDER BY count DESC, term LIMIT 50
""", headline=True)
def q_top_terms(spark, sf_dir):
    """C20 + H8: the 50 most frequent 1-2-grams after stop-word removal."""
    counts = TP.term_counts(occurrences(spark, sf_dir))
    return counts.orderBy(F.col("count").desc(), F.col("term")).limit(50)


@register("doc_freq_terms", f"""
WITH {OCC_SQL},
dfd AS (SELECT term, count(DISTINCT doc_id) AS df FROM occ GROUP BY term)
SELECT term, df FROM dfd
WHERE df >= {L.MIN_DF} AND df <= {L.MAX_DF} * (SELECT count(*) FROM d)
""")
def q_doc_freq_terms(spark, sf_dir):
    """M4 (unit = document): terms in at least 10 and at most 60 % of documents."""
    docs = topic_docs(spark, sf_dir)
    pairs = TP.unit_term_pairs(occurrences(spark, sf_dir), "doc_id")
    n_docs = docs.select(F.count(F.lit(1))).scalar()  # every fitted document counts, also an empty one
    return TP.vocabulary(pairs, "doc_id", L.MIN_DF, L.MAX_DF, n_docs).select("term", "df")


@register("ctfidf_keywords", f"""
WITH {OCC_SQL}, {WEIGHTS_SQL}
SELECT topic, term, rank, round(weight, 6) AS weight FROM kw
""", headline=True)
def q_ctfidf_keywords(spark, sf_dir):
    """M4 (unit = topic) + M5 + M6: top-10 c-TF-IDF terms per topic."""
    w = weights(spark, sf_dir)
    top = top_k_per_group(w, "topic", L.TOP_N_WORDS, [F.col("weight").desc(), F.col("term")], rank_col="rank")
    return top.select("topic", "term", "rank", F.round("weight", 6).alias("weight"))


@register("ctfidf_terms", f"""
WITH {OCC_SQL}, {WEIGHTS_SQL}
SELECT topic, term, tf, round(weight, 6) AS weight FROM wt
""")
def q_ctfidf_terms(spark, sf_dir):
    """M5: the class-based TF-IDF weight of every vocabulary term in every topic."""
    return weights(spark, sf_dir).select("topic", "term", "tf", F.round("weight", 6).alias("weight"))


@register("topic_info", f"""
WITH {OCC_SQL}, {WEIGHTS_SQL}, {REP_SQL},
ex AS (SELECT topic, string_agg(CAST(doc_id AS VARCHAR), ' | ' ORDER BY rank) AS representative_docs FROM rep GROUP BY topic),
words AS (SELECT topic, list(term ORDER BY rank) AS words FROM kw GROUP BY topic),
sizes AS (SELECT topic, count(*) AS count FROM d GROUP BY topic)
SELECT s.topic, s.count,
       s.topic || '_' || array_to_string(w.words[1:4], '_') AS name,
       array_to_string(w.words, ', ') AS keywords, ex.representative_docs
FROM sizes s LEFT JOIN words w ON s.topic = w.topic LEFT JOIN ex ON s.topic = ex.topic
""")
def q_topic_info(spark, sf_dir):
    """M7: per topic its size, ``<id>_<w1>_<w2>_<w3>_<w4>`` name, keywords and
    the ids of its three representative documents."""
    docs = written_docs(spark, sf_dir)
    w = weights_of(docs)
    info = TP.topic_info(docs, TP.topic_keywords(w, L.TOP_N_WORDS))
    examples = TP.example_docs(TP.representative_texts(occurrences_of(docs), w, 3))
    return info.join(examples, "topic", "left")


@register("topic_similarity", f"""
WITH {OCC_SQL}, {WEIGHTS_SQL},
g AS (SELECT a.topic AS topic_a, b.topic AS topic_b, sum(a.weight * b.weight) AS g
      FROM wt a JOIN wt b ON a.term = b.term GROUP BY ALL),
n AS (SELECT topic_a AS t, sqrt(g) AS norm FROM g WHERE topic_a = topic_b)
SELECT topic_a, topic_b, round(g / (na.norm * nb.norm), 6) AS similarity
FROM g JOIN n na ON g.topic_a = na.t JOIN n nb ON g.topic_b = nb.t
""")
def q_topic_similarity(spark, sf_dir):
    """Cosine similarity between the topics' c-TF-IDF vectors."""
    sim = TP.topic_similarity(weights(spark, sf_dir))
    return sim.select("topic_a", "topic_b", F.round("similarity", 6).alias("similarity"))


# --- vector topics (embeddings fixture: label plays the raw topic id) -----

CENTROID_SQL = """
ex AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x
       FROM embeddings, range(1, len(embedding) + 1) r(i)),
mean AS (SELECT label, i, avg(x) AS m FROM ex GROUP BY label, i),
nrm AS (SELECT label, sqrt(sum(m * m)) AS n FROM mean GROUP BY label),
cent AS (SELECT mean.label, list(m / n ORDER BY i) AS c FROM mean JOIN nrm USING (label) GROUP BY mean.label)
"""


def embedding_topics(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return emb.withColumnRenamed("label", "topic")


@register("nearest_centroid", f"""
WITH {CENTROID_SQL},
sc AS (SELECT e.vec_id, e.label, c.label AS t, list_dot_product(e.embedding::DOUBLE[], c.c) AS s
       FROM embeddings e, cent c)
SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(arg_max(t, (s, -t)) AS BIGINT) AS topic,
       round(max(s), 6) AS topic_score
FROM sc GROUP BY vec_id, label
""")
def q_nearest_centroid(spark, sf_dir):
    """M3: every vector to the nearest (cosine) topic centroid."""
    docs = embedding_topics(spark, sf_dir)
    cents = TP.centroids(docs, "embedding", "topic")
    out = TP.assign_nearest(docs.withColumnRenamed("topic", "label"), cents, "embedding", out="topic")
    return out.select("vec_id", "label", "topic", F.round("topic_score", 6).alias("topic_score"))


@register("representative_docs", f"""
WITH {CENTROID_SQL},
sc AS (SELECT e.label AS topic, e.vec_id, list_dot_product(e.embedding::DOUBLE[], c.c) AS similarity
       FROM embeddings e JOIN cent c ON e.label = c.label)
SELECT CAST(topic AS BIGINT) AS topic, rank, vec_id, round(similarity, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY similarity DESC, vec_id) AS rank FROM sc
) WHERE rank <= 3
""")
def q_representative_docs(spark, sf_dir):
    """M8: the three vectors closest to their own topic centroid."""
    docs = embedding_topics(spark, sf_dir)
    cents = TP.centroids(docs, "embedding", "topic")
    rep = TP.representative_docs(docs, cents, 3, "embedding", "topic", "vec_id")
    return rep.select("topic", "rank", "vec_id", F.round("similarity", 6).alias("similarity"))


_LABELS_VALUES = ", ".join(
    f"({t}, {sql_str(n)}, {sql_str(i)}, {k})" for t, n, i, k in L.TOPIC_LABELS
)


def topic_label_table(spark):
    """The curated 20-row topic-label dimension."""
    return spark.createDataFrame(L.TOPIC_LABELS, "topic int, topic_name string, industry_label string, keep int")


@register("topic_join_keep", f"""
WITH labels_dim(topic, topic_name, industry_label, keep) AS (VALUES {_LABELS_VALUES})
SELECT e.vec_id, CAST(e.label AS BIGINT) AS topic, l.topic_name, l.industry_label
FROM embeddings e LEFT JOIN labels_dim l ON e.label = l.topic
WHERE l.keep = 1
""")
def q_topic_join_keep(spark, sf_dir):
    """D1 + B6: attach curated labels to each item's topic, keep curated topics."""
    docs = embedding_topics(spark, sf_dir).select("vec_id", "topic")
    joined = label_topics(docs, topic_label_table(spark), "topic")
    return keep_curated(joined).select("vec_id", "topic", "topic_name", "industry_label")


# --- topic fit on vectors: reduce -> density clusters -> outliers ---------

# The test tables have a fiftieth of the corpus: smaller clusters for documents.
DOC_MIN_SAMPLES, DOC_MIN_CLUSTER_SIZE = 10, 60


def fitted_topics(spark, sf_dir):
    """M1 -> M2: 5-dimensional principal components, then density clusters with
    the published minimum sizes (noise = -1)."""
    emb = table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    red = materialize(TP.reduce_dims(emb, "embedding", L.REDUCED_DIMS, "reduced"), "reduced")
    topics = DN.density_clusters(red, "reduced", L.MIN_SAMPLES, L.MIN_CLUSTER_SIZE)
    return red.join(topics, "vec_id")


def document_vectors(spark, sf_dir):
    """E1 -> M1: ``doc_id, reduced`` of every document, whatever its language.
    Texts are split once; the components read written vectors."""
    docs = materialize(term_counts(table(spark, sf_dir, "documents", ["doc_id", "text"]), "text"), "term_counts")
    emb = text_vectors(docs, "terms", fit_text_vectors(docs, "terms"))
    emb = materialize(emb.select("doc_id", "embedding"), "text_vectors")
    return materialize(TP.reduce_dims(emb, "embedding", L.REDUCED_DIMS, "reduced"), "reduced")


@register("reduced_dims", None)
def q_reduced_dims(spark, sf_dir):
    """M1: principal components of the vectors (rows-only check: component
    signs are not unique, so no SQL oracle)."""
    emb = table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    red = TP.reduce_dims(emb, "embedding", L.REDUCED_DIMS, "reduced")
    return red.select("vec_id", F.transform("reduced", lambda x: F.round(x, 6)).alias("reduced"))


@register("density_topics", None)
def q_density_topics(spark, sf_dir):
    """M2: topic per vector from density clustering (-1 = noise)."""
    return fitted_topics(spark, sf_dir).select("vec_id", "topic")


@register("document_topics", None)
def q_document_topics(spark, sf_dir):
    """E1 -> M1 -> M2 on the texts: topic and membership strength of every
    document (the four languages have unlike words, so topics exist here)."""
    return DN.density_clusters(document_vectors(spark, sf_dir), "reduced", DOC_MIN_SAMPLES, DOC_MIN_CLUSTER_SIZE, "doc_id").select(
        "doc_id", "topic", F.round("strength", 6).alias("strength"))


@register("unseen_topics", None)
def q_unseen_topics(spark, sf_dir):
    """M3: clusters fitted on documents of even id; all others attached to them."""
    red = document_vectors(spark, sf_dir)
    fit = DN.fit_density(red.filter("doc_id % 2 = 0"), "reduced", DOC_MIN_SAMPLES, DOC_MIN_CLUSTER_SIZE // 2, "doc_id")
    return DN.attach_to_clusters(red.filter("doc_id % 2 <> 0"), fit, "reduced", DOC_MIN_SAMPLES, "doc_id").select(
        "doc_id", "topic", F.round("strength", 6).alias("strength"))


@register("outliers_reduced", None)
def q_outliers_reduced(spark, sf_dir):
    """M9: noise vectors moved to the nearest topic centroid (in the original
    space); clustered vectors keep their topic."""
    fit = fitted_topics(spark, sf_dir)
    emb = table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]).join(fit.select("vec_id", "topic"), "vec_id")
    cents = TP.centroids(emb.filter(F.col("topic") != -1), "embedding", "topic")
    if cents.limit(1).count() == 0:
        return emb.select("vec_id", "topic")
    return TP.reduce_outliers(emb, cents, "embedding", "topic").select("vec_id", "topic")


WINDOW = 4


@register("outliers_by_text", f"""
WITH {OCC_SQL}, {WEIGHTS_SQL},
labels_dim(topic, topic_name, industry_label, keep) AS (VALUES {_LABELS_VALUES}),
curated AS (SELECT 'src' || topic AS topic FROM labels_dim WHERE keep = 1),
nz AS (SELECT doc_id, w FROM tok WHERE topic NOT IN (SELECT topic FROM curated)),
tk AS (SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS term, len(w) AS n FROM nz),
ix AS (SELECT DISTINCT term, ln(1 + (SELECT a FROM aw) / term_total) AS idf FROM tot),
wv AS (SELECT doc_id, win, term, count(*) * any_value(idf) AS v FROM (
         SELECT doc_id, term, idf, unnest(range(greatest(0, pos - {WINDOW - 1}), least(pos, greatest(n - {WINDOW}, 0)) + 1)) AS win
         FROM tk JOIN ix USING (term)) GROUP BY doc_id, win, term),
wnorm AS (SELECT doc_id, win, sqrt(sum(v * v)) AS nv FROM wv GROUP BY doc_id, win),
tnorm AS (SELECT topic, sqrt(sum(weight * weight)) AS nt FROM wt GROUP BY topic),
sim AS (SELECT wv.doc_id, wv.win, wt.topic, sum(wv.v * wt.weight) AS dot FROM wv JOIN wt USING (term)
        WHERE wt.topic IN (SELECT topic FROM curated) GROUP BY ALL),
sc AS (SELECT doc_id, topic, sum(dot / (nv * nt)) AS score FROM sim JOIN wnorm USING (doc_id, win) JOIN tnorm USING (topic) GROUP BY ALL),
best AS (SELECT doc_id, topic, score / sum(score) OVER (PARTITION BY doc_id) AS share,
                row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, topic) AS rn FROM sc)
SELECT nz.doc_id, best.topic, round(best.share, 6) AS share FROM nz LEFT JOIN best ON nz.doc_id = best.doc_id AND best.rn = 1
""")
def q_outliers_by_text(spark, sf_dir):
    """M9 from the texts: documents outside the curated topics move to the
    curated topic that their token windows are most similar to (null: none)."""
    docs = written_docs(spark, sf_dir)
    curated = topic_label_table(spark).filter("keep = 1").select(F.concat(F.lit("src"), F.col("topic").cast("string")).alias("topic"))
    noise = docs.join(curated, "topic", "left_anti")
    scores = TP.window_topics(noise, weights_of(docs).join(curated, "topic", "left_semi"), "topic_text", STOP, WINDOW)
    best = top_k_per_group(scores, "doc_id", 1, [F.round("score", 9).desc(), F.col("topic")])
    return noise.select("doc_id").join(best.select("doc_id", "topic", F.round("share", 6).alias("share")), "doc_id", "left")


# --- text topic representatives and dashboard extracts --------------------

@register("representative_texts", f"""
WITH {OCC_SQL}, {WEIGHTS_SQL}, {REP_SQL}
SELECT topic, rank, doc_id, round(similarity, 6) AS similarity FROM rep
""")
def q_representative_texts(spark, sf_dir):
    """M8 on text topics: three documents closest to their topic's c-TF-IDF vector."""
    docs = written_docs(spark, sf_dir)
    rep = TP.representative_texts(occurrences_of(docs), weights_of(docs), 3)
    return rep.select("topic", "rank", "doc_id", F.round("similarity", 6).alias("similarity"))


SUMMARY_KEYWORDS = 8


def source_labels(spark):
    """Curated labels keyed as the sources are named: source N plays topic N."""
    return topic_label_table(spark).select(
        F.concat(F.lit("src"), F.col("topic").cast("string")).alias("topic"), "topic_name", "industry_label")


def most_frequent_tag(docs, dictionary, out):
    """(topic, ``out``): the label that most of the topic's articles carry
    (ties: first by name)."""
    arts = tagging.with_phrases(docs.select("article_id", "topic", "text_clean"), dictionary)
    counts = tagging.tag_counts(tagging.tag_articles(arts, "text_clean", {out: dictionary}), "topic", out)
    return top_k_per_group(counts, "topic", 1, [F.col("count").desc(), F.col(out)]).select("topic", out)


def topic_summary(spark, sf_dir, excerpt=lambda c: T.excerpt(c, L.EXCERPT_CHARS)):
    """K8 topics table.  The cleaned articles are written once and read by every part."""
    return summary_of(spark, written_docs(spark, sf_dir), excerpt)


def summary_of(spark, docs, excerpt=lambda c: T.excerpt(c, L.EXCERPT_CHARS)):
    """Of written articles: id, name, size, keywords, text of the best representative
    (cut by ``excerpt``), curated industry, most frequent technology and impact tag."""
    w = weights_of(docs)
    info = TP.topic_info(docs, TP.topic_keywords(w, L.TOP_N_WORDS)).select("topic", "name", "count")
    kw8 = TP.topic_keywords(w, SUMMARY_KEYWORDS).select("topic", "keywords")
    rep = TP.representative_texts(occurrences_of(docs), w, 1).select("topic", "doc_id")
    rep_text = rep.join(docs.select("doc_id", "topic_text"), "doc_id").select(
        "topic", excerpt(F.col("topic_text")).alias("representative_doc"))
    out = info.join(source_labels(spark).select("topic", "industry_label"), "topic", "left")
    for part in (kw8, rep_text, most_frequent_tag(docs, L.TECHNOLOGY_KEYWORDS, "technology"),
                 most_frequent_tag(docs, L.IMPACT_KEYWORDS, "impact_mode")):
        out = out.join(part, "topic", "left")
    return out.select(
        F.col("topic").alias("topic_id"), F.col("name").alias("final_topic"), F.col("count").alias("topic_size"), "keywords",
        "representative_doc", F.col("industry_label").alias("industry"), "technology", "impact_mode")


def _top_tag_sql(counts_sql, tag_col):
    return (f"SELECT industry_label AS topic, {tag_col} AS tag FROM (SELECT *, row_number() OVER (PARTITION BY industry_label "
            f"ORDER BY count DESC, {tag_col}) AS rn FROM ({counts_sql})) WHERE rn = 1")


def _summary_sql(doc):
    return f"""
WITH {OCC_SQL}, {WEIGHTS_SQL}, {REP_SQL},
labels_dim(topic, topic_name, industry_label, keep) AS (VALUES {_LABELS_VALUES}),
words AS (SELECT topic, list(term ORDER BY rank) AS words FROM kw GROUP BY topic),
sizes AS (SELECT topic, count(*) AS count FROM d GROUP BY topic),
r1 AS (SELECT rep.topic, {doc} AS doc FROM rep JOIN d ON rep.doc_id = d.doc_id WHERE rep.rank = 1),
tech AS ({_top_tag_sql(tagging.TECHNOLOGY_SQL, "technologies")}),
imp AS ({_top_tag_sql(tagging.IMPACT_SQL, "impact_modes")})
SELECT s.topic AS topic_id, s.topic || '_' || array_to_string(w.words[1:4], '_') AS final_topic,
       s.count AS topic_size, array_to_string(w.words[1:{SUMMARY_KEYWORDS}], ', ') AS keywords,
       r1.doc AS representative_doc, l.industry_label AS industry, tech.tag AS technology, imp.tag AS impact_mode
FROM sizes s LEFT JOIN words w ON s.topic = w.topic LEFT JOIN r1 ON s.topic = r1.topic
     LEFT JOIN labels_dim l ON s.topic = 'src' || l.topic LEFT JOIN tech ON s.topic = tech.topic LEFT JOIN imp ON s.topic = imp.topic
"""


@register("dashboard_topics", _summary_sql(f"substr(d.tt, 1, {L.EXCERPT_CHARS}) || '{L.EXCERPT_SUFFIX}'"))
def q_dashboard_topics(spark, sf_dir):
    """K8: the dashboard's topic table (8 keywords, 160-character excerpt)."""
    return topic_summary(spark, sf_dir)


@register("topic_summary", _summary_sql(f"substr(d.tt, 1, {L.SUMMARY_DOC_CHARS})"))
def q_topic_summary(spark, sf_dir):
    """K8 + C22: the topic summary with the first 500 characters of the best
    representative, written as a CSV report and read back."""
    summary = topic_summary(spark, sf_dir, lambda c: T.left(c, L.SUMMARY_DOC_CHARS))
    path = write_report_csv(summary, scratch_path(spark, "topic_summary"), single=False)
    return spark.read.schema(summary.schema).options(header=True, escape='"', multiLine=True).csv(path)


@register("headline_stats", f"""
WITH d AS (SELECT source AS topic FROM documents WHERE {EN_LEN_SQL}),
labels_dim(topic, topic_name, industry_label, keep) AS (VALUES {_LABELS_VALUES}),
s AS (SELECT topic, count(*) AS topic_size FROM d GROUP BY topic)
SELECT CAST(sum(topic_size) AS BIGINT) AS total_articles, count(*) AS topics,
       count(DISTINCT l.industry_label) AS industries
FROM s LEFT JOIN labels_dim l ON CAST(substr(s.topic, 4) AS INTEGER) = l.topic
""")
def q_headline_stats(spark, sf_dir):
    """Total curated articles, number of topics, industries covered."""
    sizes = english_articles(spark, sf_dir).groupBy(F.col("source").alias("topic")).agg(F.count(F.lit(1)).alias("topic_size"))
    return sizes.join(source_labels(spark), "topic", "left").agg(
        F.sum("topic_size").alias("total_articles"), F.count(F.lit(1)).alias("topics"),
        F.count_distinct("industry_label").alias("industries"))


@register("topic_table", f"""
WITH {OCC_SQL}, {WEIGHTS_SQL},
labels_dim(topic, topic_name, industry_label, keep) AS (VALUES {_LABELS_VALUES}),
words AS (SELECT topic, list(term ORDER BY rank) AS words FROM kw GROUP BY topic),
sizes AS (SELECT topic, count(*) AS count FROM d GROUP BY topic),
tech AS ({_top_tag_sql(tagging.TECHNOLOGY_SQL, "technologies")}),
imp AS ({_top_tag_sql(tagging.IMPACT_SQL, "impact_modes")})
SELECT s.topic AS final_topic, array_to_string(w.words[1:4], ', ') AS tags, l.industry_label AS industry,
       tech.tag AS technology, imp.tag AS impact_mode, format('{{:,}}', s.count) AS articles
FROM sizes s LEFT JOIN words w ON s.topic = w.topic LEFT JOIN labels_dim l ON s.topic = 'src' || l.topic
     LEFT JOIN tech ON s.topic = tech.topic LEFT JOIN imp ON s.topic = imp.topic
""")
def q_topic_table(spark, sf_dir):
    """K9 topic detail rows: first four keywords (C17), curated industry, main
    technology and impact, size with thousands separators (C18)."""
    return topic_summary(spark, sf_dir).select(
        F.col("topic_id").alias("final_topic"), T.head_of_list("keywords", 4).alias("tags"), "industry", "technology",
        "impact_mode", T.thousands("topic_size").alias("articles"))


@register("industry_labels", f"""
WITH labels_dim(topic, topic_name, industry_label, keep) AS (VALUES {_LABELS_VALUES})
SELECT DISTINCT l.industry_label,
       regexp_replace(regexp_replace(l.industry_label, {sql_str(r"[^\p{L}\p{N}_\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}-]")},
                      '', 'g'), ' ', '_', 'g') AS file_label
FROM embeddings e JOIN labels_dim l ON e.label = l.topic WHERE l.keep = 1
""")
def q_industry_labels(spark, sf_dir):
    """H13 + C19: distinct industries of the curated topics present in the
    data, with the file-name-safe form of each label."""
    docs = embedding_topics(spark, sf_dir).select("topic")
    curated = keep_curated(label_topics(docs, topic_label_table(spark), "topic"))
    return distinct_values(curated, "industry_label").withColumn("file_label", T.safe_label("industry_label"))
