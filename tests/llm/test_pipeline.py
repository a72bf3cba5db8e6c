"""The pipeline's stages against their operators, and its contract."""

import re
from collections import Counter

import corpus_pipeline
from dosewise.llm import pii, quality_fm
from dosewise.llm.common import table, word_count
from pyspark.sql import functions as F
from tests.llm.test_operators import odd_docs, slow_components, slow_fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_and_their_decisions(spark, tmp_path):
    docs = table(spark, SF, "documents")
    out, frames = {}, {}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, at, SF).write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        out[name], frames[name] = at.collect(), at
    assert all(frames[n].columns == docs.columns for n in ("quality", "near_dedup", "personal_data", "mix"))
    model = quality_fm.learn(docs, table(spark, SF, "labels"))
    good = {r["doc_id"] for r in quality_fm.score_quality(docs, model).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in out["quality"]} == good
    ids = sorted(good)
    text = {r["doc_id"]: r["text"] for r in out["quality"]}
    root = slow_components([slow_fingerprint(text[i]) for i in ids], ids)
    assert sorted(r["doc_id"] for r in out["near_dedup"]) == sorted(set(root))
    assert all(r["text"] == pii.masked(text[r["doc_id"]], pii.find(text[r["doc_id"]])) and r["n_chars"] == len(r["text"]) for r in out["personal_data"])
    clean = {r["doc_id"]: r["text"] for r in out["personal_data"]}
    times = Counter(r["doc_id"] for r in out["mix"])
    cut = [r for r in out["mix"] if r["text"] != clean[r["doc_id"]]]
    assert max(times.values()) <= 2 and len({r["source"] for r in cut}) == len(cut)
    assert all(re.findall(r"\S+", clean[r["doc_id"]])[: len(r["text"].split())] == r["text"].split() for r in cut)
    assert sum(r["words"] for r in out["pack"]) == frames["mix"].agg(F.sum(word_count(F.col("text")))).first()[0]
    bins = Counter((r["shard"], r["bin"], r["doc_id"]) for r in out["pack"])
    assert max(bins.values()) == 1


def test_stages_on_odd_and_empty_rows(spark):
    for docs in (odd_docs(spark), odd_docs(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, SF)
            got.count()
            assert name == "pack" or got.columns == docs.columns


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    extra = ("_doc", "_gone", "_twice", "_id", "_source", "_bucket", "_row", "size", "take", "target", "shard", "node", "root", "fp", "y", "a.b", "doc.text")
    docs = odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in extra))
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        rows = got.collect()
        if name != "pack":
            assert got.columns == docs.columns
            assert all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in rows for c in extra)


def test_texts_that_masking_makes_alike_share_no_bin(spark):
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"{line} mail {'abcdefgh'[i] * 9}.{i}@mail{i}.example.com", "en", f"s{i}", None) for i in range(8)]
    rows += [(100 + i, " ".join(f"x{i}y{j}" for j in range(40)), "en", f"t{i}", None) for i in range(8)]
    # a document's cut reading, unlike the whole: apart from it, and from what is near to either
    whole = " ".join(f"u{i}" for i in range(60))
    rows += [(50, whole, "en", "u", None), (50, " ".join(whole.split()[:9]), "en", "v", None), (51, whole.upper(), "en", "w", None), (52, " ".join(whole.upper().split()[:9]), "en", "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    masked = corpus_pipeline.personal_data(spark, docs, SF)
    got = corpus_pipeline.pack(spark, masked, SF).collect()
    assert len(got) == len(rows)
    for ids in (range(8), range(50, 53)):
        bins = [(r["shard"], r["bin"]) for r in got if r["doc_id"] in ids]
        assert len(bins) == len(set(bins))
