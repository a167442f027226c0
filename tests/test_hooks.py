"""User-model hooks (encoder, entity model, sentiment model) with stub models,
and the streaming report against its batch form."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators.entities import extract_with
from quarry.operators.relevance import embed_with, similarity
from quarry.operators.sentiment import score_with
from quarry.plans import QUERIES
from quarry.plans.tagging import FIXTURE_TAGS
from quarry.streaming.incremental import run_tag_counts_stream


def test_embed_with_normalises_and_scores(spark):
    def make():
        def enc(texts):
            return np.array([[len(t), t.count("a"), 1.0] for t in texts])
        return enc

    df = spark.createDataFrame([(0, "banana"), (1, "kiwi"), (2, "")], "i int, t string")
    emb = embed_with(df, "t", make)
    rows = {r.i: r.embedding for r in emb.collect()}
    assert all(abs(np.linalg.norm(v) - 1) < 1e-6 for v in rows.values())
    q = F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))
    s = {r.i: r.semantic_score for r in similarity(emb, "embedding", q).collect()}
    assert s[0] > s[2]


def test_extract_with_one_row_to_many(spark):
    def make():
        def predict(texts):
            return [[{"entity_group": "ORG", "word": w, "score": 0.9} for w in t.split() if w.istitle()]
                    for t in texts]
        return predict

    df = spark.createDataFrame([(1, "Title", "Acme met Beta and x"), (2, "t", "none here")],
                               "article_id long, title_clean string, text_clean string")
    got = sorted((r.article_id, r.entity_text) for r in extract_with(df, make, keep=["article_id"]).collect())
    assert got == [(1, "Acme"), (1, "Beta"), (1, "Title")]


def test_score_with_lowercases_labels(spark):
    def make():
        return lambda texts: [("POSITIVE" if "good" in t else "Negative", 0.75) for t in texts]

    df = spark.createDataFrame([(1, "good day"), (2, "bad day"), (3, None)], "id long, text_clean string")
    got = {r.id: (r.sentiment, r.sentiment_score) for r in score_with(df, make).collect()}
    assert got == {1: ("positive", 0.75), 2: ("negative", 0.75), 3: ("negative", 0.75)}


def test_stream_equals_batch(spark):
    out = tempfile.mkdtemp(prefix="quarry-stream-")
    streamed = run_tag_counts_stream(spark, SF_SMALL, "documents.parquet", FIXTURE_TAGS,
                                     os.path.join(out, "r"), os.path.join(out, "c"))
    batch = QUERIES["tag_counts"](spark, SF_SMALL)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_python_udfs_unpickle_without_the_package(tmp_path):
    """Executors may not have this package on their path: every Python
    function Spark ships must pickle by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from quarry.functions.text import nfkc

    blobs = [cloudpickle.dumps(nfkc.func)]
    for i, b in enumerate(blobs):
        (tmp_path / f"f{i}.pkl").write_bytes(b)
    code = (
        "import sys, pickle, pandas as pd\n"
        "sys.path = [p for p in sys.path if 'repo' not in p and p not in ('', '.')]\n"
        f"f0 = pickle.load(open({str(tmp_path / 'f0.pkl')!r}, 'rb'))\n"
        "print(f0(pd.Series(['ﬁ']))[0])\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == ["fi"]


def test_stream_reads_a_folder_of_part_files(spark, tmp_path):
    rows = [(i, "src1" if i % 2 else "src2", "en", "Apache license. " + "plain words " * 60) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    docs.repartition(3).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "in" / "other.parquet"))  # not part of the source
    args = (spark, str(tmp_path / "in"), "documents.parquet", FIXTURE_TAGS, str(tmp_path / "out"), str(tmp_path / "state"))
    want = [("src1", "licensing", 3), ("src2", "licensing", 3)]
    assert sorted(map(tuple, run_tag_counts_stream(*args).collect())) == want
    assert sorted(map(tuple, run_tag_counts_stream(*args).collect())) == want  # run again: nothing new, the table stays


def test_stream_without_rows_gives_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = run_tag_counts_stream(spark, str(tmp_path), "documents.parquet", FIXTURE_TAGS, str(tmp_path / "out"), str(tmp_path / "state"))
    assert got.columns == ["industry_label", "tag", "count"] and got.count() == 0
