"""Token alignment against a brute-force version over all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dimweave.llm import align

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def some_texts(n=150):
    rng = random.Random(7)
    parts = ["the ", "of", " ing", "ation", "é", "ß", "中文", "😀", "\n", "  ", "\t", "123", "4.5", "'s", "<|endoftext|>", "<s>", "<0x41>",
             "x", "Q", "...", " ", "\x00", "kjwqx", "__", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(n)]
    return [*texts, "", None, " ", "a▁b", "the same text", "the same text", "word " * 2000, "x" * 5000]


def tokens(libraries, text):
    """(id, start, end) of both sides by the libraries, from the entries' bytes; none if they differ from the text."""
    a, b = libraries
    byte_of = align.byte_letters()
    left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in left]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in right]
    sides = []
    for side in (left, right):
        if b"".join(x for _, x in side) != (" " + text).encode():
            return [], []
        at, out = 0, []
        for i, x in side:
            out.append((i, at, at + len(x)))
            at += len(x)
        sides.append(out)
    return sides


def by_brute_force(libraries, rows):
    held = [(k, *(tokens(libraries, t) if t else ([], []))) for k, t in rows]
    links = [[(x[0], y[0]) for x in a for y in b if x[2] == y[2]] for _, a, b in held]
    counts = Counter(p for one in links for p in one)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for (k, a, b), one in zip(held, links, strict=True):
        groups, cuts = [], sorted({x[2] for x in a} & {y[2] for y in b})
        for lo, hi in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(x[0]) for x in side if lo < x[2] <= hi) for side in (a, b)))
        out.append((k, len(a), len(b), len(cuts), len(one), sum(counts[p] == most[p[1]] for p in one), sum(counts[p] for p in one),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return out


def test_ids_are_the_libraries(libraries):
    texts = [t for t in some_texts(400) if t]
    a, b = libraries
    assert [x.tolist() for x in align.ByteLevel(A_PATH).encode(texts)] == [e.ids for e in a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in align.Pieces(B_PATH).encode(texts)] == [b.encode(t) for t in texts]


def test_overlaps_are_all_pairs_that_share_a_byte(libraries):
    texts = some_texts(60)[:65]
    got = align.align_texts(texts, align.ByteLevel(A_PATH), align.Pieces(B_PATH))
    a_first = {d: (got.a_doc == d).argmax() for d in set(got.a_doc.tolist())}
    b_first = {d: (got.b_doc == d).argmax() for d in set(got.b_doc.tolist())}
    found = sorted((int(got.a_doc[i]), int(i - a_first[got.a_doc[i]]), int(j - b_first[got.b_doc[j]]))
                   for i, j in zip(got.over_a.tolist(), got.over_b.tolist(), strict=True))
    want = []
    for d, text in enumerate(texts):
        a, b = tokens(libraries, text) if text else ([], [])
        want += [(d, i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
    assert found == sorted(want)


@pytest.mark.parametrize("broadcast", [True, False])
def test_profiles(spark, libraries, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(align, "BROADCAST_PAIRS", 0)
    rows = [*enumerate(some_texts()), (3, "the same id"), (None, "no id")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n_a int").repartition(3)
    got = align.profiles(docs, A_PATH, B_PATH)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(by_brute_force(libraries, rows), key=str)
    assert align.profiles(docs.where("false"), A_PATH, B_PATH).count() == 0


def test_small_batches_change_nothing(libraries, monkeypatch):
    import pyarrow as pa

    batch = pa.record_batch({"doc_id": pa.array(range(100), pa.int64()), "text": pa.array(some_texts(100)[:100])})
    whole = [r for b in align._profile(A_PATH, B_PATH)([batch]) for r in b.to_pylist()]
    monkeypatch.setattr(align, "TOGETHER", 10)
    assert [r for b in align._profile(A_PATH, B_PATH)([batch]) for r in b.to_pylist()] == whole


def test_rows_of_align(spark, libraries):
    texts = ["the kjwqx of", None, "", "中文 and é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in align.align(docs, A_PATH, B_PATH).collect():
        a, b = tokens(libraries, texts[r.doc_id]) if texts[r.doc_id] else ([], [])
        assert r.a_ids == [x[0] for x in a] and r.b_ids == [y[0] for y in b]
        assert list(zip(r.overlap_a, r.overlap_b)) == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
        assert list(zip(r.group_end_a, r.group_end_b)) == [(i + 1, j + 1) for i, x in enumerate(a) for j, y in enumerate(b) if x[2] == y[2]]


def test_possible_pairs_is_a_bound(libraries):
    a, b = [b"ab", b"b", b"c"], [b"b", b"ab", b"xab", b"b"]
    assert align.possible_pairs(a, b) == sum(x.endswith(y) or y.endswith(x) for x in a for y in b)
