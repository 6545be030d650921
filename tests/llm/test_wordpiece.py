import random

import public_tokenizers
from tokenizers import Tokenizer, models, pre_tokenizers

from dimweave.llm import wordpiece
from llm_fixtures import docs_of  # noqa: F401

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def greedy(word, initial, continuing):
    n, at, entries = 0, 0, initial
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in entries), None)
        if end is None:
            return 0
        n, at, entries = n + 1, end, continuing
    return n


def test_random_vocabularies():
    rng = random.Random(1)
    for _ in range(200):
        piece = lambda: "".join(rng.choices("ab" if rng.random() < .5 else "abc", k=rng.randint(1, 6)))
        initial, continuing = ({piece() for _ in range(rng.randint(0, 12))} for _ in range(2))
        count = wordpiece.PieceCounter(sorted(initial), sorted(continuing))
        for _ in range(60):
            word = "".join(rng.choices("abc", k=rng.randint(1, 14)))
            assert count(word) == greedy(word, initial, continuing), (word, initial, continuing)


def test_equals_the_word_piece_library(spark):
    initial, continuing = wordpiece.sentencepiece_entries(VOCABULARY)
    names = ["[UNK]", *initial, *("##" + c for c in continuing)]
    library = Tokenizer(models.WordPiece({w: i for i, w in enumerate(dict.fromkeys(names))}, unk_token="[UNK]", max_input_chars_per_word=10**6))
    library.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Split("", "isolated")][:1])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in wordpiece.token_counts(docs, VOCABULARY).collect()}
    for r in docs.collect():
        words = wordpiece.WORD.findall(r.text or "")
        pieces = [library.encode(w).tokens for w in words]
        unknown = sum(p == ["[UNK]"] for p in pieces)
        assert (got[r.doc_id].n_words, got[r.doc_id].n_tokens, got[r.doc_id].n_unknown) == (len(words), sum(map(len, pieces)), unknown)


def test_edge_rows(docs_of):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "the the"), (4, "a" * 100_000), (4, "a" * 100_000), (5, "\U0001F600!")]
    got = sorted(map(tuple, wordpiece.token_counts(docs_of(rows), VOCABULARY).collect()), key=repr)
    assert [g[:3] for g in got if g[0] in (1, 2, 3)] == [(1, 0, 0), (2, 0, 0), (3, 0, 0)]
    assert len([g for g in got if g[0] == 4]) == 2 and [g for g in got if g[0] is None][0][1] == 2
    assert wordpiece.token_counts(docs_of([]), VOCABULARY).collect() == []
