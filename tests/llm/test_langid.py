import numpy as np
from pyspark.sql import functions as F

from dimweave.llm import langid
from dimweave.llm.queries import QUERIES
from llm_fixtures import docs_of  # noqa: F401


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op2_language_id"](spark, d).join(truth, "doc_id").where("held_out").select("lang", "lang_pred", "score").collect()
    right = [r.lang == r.lang_pred for r in got]
    assert len(got) > 250 and np.mean(right) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)
    # Calibrated: the mean score is near the accuracy.
    assert abs(np.mean([r.score for r in got]) - np.mean(right)) < 0.05


def test_a_third_is_never_learned_from(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    model = langid.train(wrong.where(~langid.held_out(F.col("doc_id"))))
    assert "zz" not in model.languages and model.languages
    assert model.weights.shape == (langid.FEATURES, len(model.languages)) and (model.weights == 0).mean() > 0.3  # sparse


def test_edge_rows(spark, docs_of):
    model = langid.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (None, "the and of"), (5, "the and of " * 20_000), (6, "\U00020000\U00020001"), (6, "\U00020000\U00020001")]
    got = {(r.doc_id, r.text and r.text[:3]): r for r in langid.predict(docs_of(rows), model, ["doc_id", "text"]).collect()}
    for key in ((1, None), (2, ""), (3, "123")):
        assert (got[key].lang_pred, got[key].score) == ("und", 0.0)
    assert got[(None, "the")].lang_pred == got[(5, "the")].lang_pred == "en"
    assert got[(6, "\U00020000\U00020001")].lang_pred in model.languages


def test_nothing_to_learn_from(docs_of):
    for rows in ([], [(1, None)], [(1, "abc")]):
        model = langid.train(docs_of(rows))
        assert model.languages == []
        assert [r.lang_pred for r in langid.predict(docs_of([(1, "abc")]), model, ["doc_id", "text"]).collect()] == ["und"]
    assert langid.train(docs_of([(1, "abc"), (2, "abd")], lang="en")).predict("abc")[0] == "en"


def test_ftrl_learns_and_l1_makes_it_sparse():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(300):
        y = i % 3
        cells = np.unique(np.concatenate([rng.integers(100 * y, 100 * y + 30, 10), rng.integers(1000, 3000, 10)]))
        rows.append((cells, np.full(len(cells), 1 / np.sqrt(len(cells)))))
        labels.append(y)
    w, b = langid.fit_ftrl(rows, np.array(labels), 3, l1=0.5)
    assert np.mean([int((x @ w[c] + b).argmax()) == y for (c, x), y in zip(rows, labels, strict=True)]) > 0.97
    loose, _ = langid.fit_ftrl(rows, np.array(labels), 3, l1=0.0)
    assert (w == 0).mean() > (loose == 0).mean()


def test_temperature_undoes_overconfidence():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(4000, 3))
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    labels = np.array([rng.choice(3, p=q) for q in p])
    assert abs(langid.fit_temperature(5 * z, labels) - 5) < 0.5


def test_symbols_beyond_the_basic_plane_are_no_letters(docs_of):
    emoji = "\U0001F600 \U0001F680\U0001F4A9 \U00010190"
    assert not len(langid.ngrams(emoji)) and len(langid.ngrams("\U00020000"))
    assert list(langid.ngrams("abc\U0001F600def")) == list(langid.ngrams("abc def"))
    model = langid.train(docs_of([(1, "abc"), (2, "abd")], lang="en"))
    assert model.predict(emoji) == ("und", 0.0) and model.predict("abc " + emoji)[0] == "en"
