import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from dimweave.llm import decontam, langid
from dimweave.llm.common import table
from llm_fixtures import docs_of  # noqa: F401
from test_linededup import brute as brute_lines
from test_minhash import brute as brute_near

SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language id", "line dedup", "near dedup", "decontamination", "packing"]
    docs = table(spark, SMALL, "documents")
    kept = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SMALL).write.parquet(f"{tmp_path}/{k}")
        kept.append(spark.read.parquet(f"{tmp_path}/{k}"))
    for df in kept[1:-1]:
        assert df.columns == docs.columns
    rows = [sorted((r.doc_id, r.text) for r in df.collect()) for df in kept[:-1]]
    # Language id: only what has no recognised language goes.
    model = langid.train(docs)
    assert rows[1] == [r for r in rows[0] if (p := model.predict(r[1]))[0] != "und" and p[1] >= corpus_pipeline.LEAST_SCORE]
    assert rows[2] == sorted((d, t) for d, _, _, t in brute_lines(rows[1]) if t.strip() or not dict(rows[1])[d].strip())
    assert [d for d, _ in rows[3]] == sorted(d for d, n, c, keep in brute_near(rows[2]) if keep)
    found = decontam.find(kept[3], table(spark, SMALL, "benchmark")).where("contaminated").collect()
    assert rows[4] == [r for r in rows[3] if r[0] not in {f.doc_id for f in found}]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows[4])
    assert kept[5].agg({"length": "sum"}).first()[0] == total


def test_stages_on_edge_tables(spark, docs_of):
    """Empty tables, nulls, and columns with the operators' names."""
    base = docs_of([(1, None), (2, ""), (None, "the and of"), (3, "the and of " * 40), (3, "the and of " * 40), (4, "la de les " * 30)], lang="en")
    for docs in (base.limit(0), base, base.withColumn("score", base.text).withColumn("lang_pred", base.text)):
        docs.cache()
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, SMALL)
            assert name == "packing" or got.columns == docs.columns
            assert got.count() <= max(docs.count(), 1)


def test_run_returns_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 0
