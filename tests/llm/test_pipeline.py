"""The pipeline against a brute-force version, stage by stage."""

import re

import duckdb
import pandas as pd
import sentencepiece
from llm_fixtures import no_docs, odd_docs  # noqa: F401

import corpus_pipeline
from conftest import SF_SMALL
from test_documents import brute_components
from quarry.llm import ORACLE
from quarry.llm.queries import PIECE_MODEL


def brute(docs: pd.DataFrame):
    """Documents with a letter -> least id of each group -> mix -> ids."""
    docs = docs[docs.text.map(lambda t: any(c.isalpha() for c in t))]
    comps = brute_components(list(zip(docs.doc_id, docs.text, strict=True)))
    docs = docs[docs.doc_id.map(lambda i: comps[i][1] == i)]
    con = duckdb.connect()
    con.register("documents", docs)
    taken = con.execute(ORACLE["op3_sainte_lague_mix"]).df().set_index("doc_id")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    out = []
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        size, n = int(taken.loc[i, "size"]), int(taken.loc[i, "taken"])
        for words in [size, n - size] if n > size else [n] if n else []:
            ends = [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
            out.append((i, tuple(library.encode(text if words == size else text[:ends[words - 1]]))))
    return sorted(out)


def test_pipeline_matches_brute_force(spark):
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in got) == brute(docs)
    assert all(r["n_ids"] == len(r["ids"]) for r in got)


def test_stages_keep_columns_and_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), odd_docs.schema)
            assert docs.columns == odd_docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).columns == ["doc_id", "n_ids", "ids"]


def test_language_stage_rejects_and_keeps(spark, odd_docs):
    kept = [r["doc_id"] for r in corpus_pipeline.language_stage(spark, odd_docs, SF_SMALL).collect()]
    assert not {3, 4, 5, 7} & set(kept) and kept.count(1) == 2 and {6, 8} <= set(kept)


FOREIGN = [
    "Litwo ojczyzno moja ty jesteś jak zdrowie ile cię trzeba cenić ten tylko się dowie kto cię stracił dziś piękność twą w całej ozdobie",
    "Mieleni minun tekevi aivoni ajattelevi lähteäni laulamahan saa'ani sanelemahan sukuvirttä suoltamahan lajivirttä laulamahan",
    "Korkma sönmez bu şafaklarda yüzen al sancak sönmeden yurdumun üstünde tüten en son ocak o benim milletimin yıldızıdır parlayacak",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van az emberek ésszel és lelkiismerettel bírván egymással szemben",
    "Мой дядя самых честных правил когда не в шутку занемог он уважать себя заставил и лучше выдумать не мог",
    "the thing and that for the and of the thing Мой дядя самых честных правил когда не в шутку занемог он",
]


def test_language_stage_decides_by_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    foreign = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(FOREIGN)], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs.unionByName(foreign), "").select("doc_id").collect()}
    assert not [t for i, t in enumerate(FOREIGN) if -1 - i in kept]
    assert {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"])} == kept


def test_dedup_stage_keeps_one_of_each_group(spark, odd_docs):
    kept = [r["doc_id"] for r in corpus_pipeline.dedup_stage(spark, odd_docs, SF_SMALL).collect()]
    assert 2 not in kept and {1, 3, 4, 5, 6, 7, 8, 9, None} == set(kept)


def test_dedup_stage_loses_no_unique_text(spark):
    """Id 5 repeats a text of id 1 and has one of its own; id 6 repeats itself."""
    a, b, c = ("the quick brown onion sat on the mat by the old door", "le chat est sur la chaise et le chien mange encore un peu",
               "der hund liegt auf dem teppich und die katze trinkt ihre milch")
    rows = [(1, a), (5, a), (5, b), (6, c), (6, c), (None, a), (8, None), (8, ""), (9, b)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_stage(spark, docs, SF_SMALL).collect()]
    assert sorted(kept, key=repr) == sorted([(1, a), (5, b), (6, c), (None, a), (8, None), (8, "")], key=repr)


def test_mix_stage_cuts_and_repeats(spark):
    docs = spark.createDataFrame([(1, "a  b\tc d", "en", "s", 8), (2, "e f g h", "en", "t", 7), (3, "i", "en", "u", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    rows = corpus_pipeline.mix_stage(spark, docs, SF_SMALL).collect()
    for r in rows:
        assert r["n_chars"] == len(r["text"])
        whole = {1: "a  b\tc d", 2: "e f g h", 3: "i"}[r["doc_id"]]
        assert whole.startswith(r["text"])
