import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from dimweave.llm import packing
from llm_fixtures import docs_of  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["A\u030a\u0301 \u212b \u0130I \u03a3\u0391\u03a3 K\u212a ÀÉ", "<|ENDOFTEXT|> <|endoftext|>", "Wait... what?! (yes!) a.b, 3.5. x_. don't, \u0301. \u00e9, \u0065\u0301, 1st; x:\u2028y!,", None, "", " ", "Hello  world\n\nIt's 2024!", "a\u00a0b\u2003c e\u0301 É", "<|endoftext|> in x<|startoftext|>y", "word " * 9000, "x" * 5000, "same", "same",
         "tab\there\rthere\x0bvt\x0cff\x1fus", "'re 're're can't we'll", "\U0001F600 emoji"]


def check(rows, pieces, window):
    tokenizer = Tokenizer.from_file(PATH)
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for d, t in rows}
    by_doc, filled = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        filled[p.sequence_id].append((p.offset, p.length))
        want = ids[p.doc_id][p.start : p.start + p.length]
        assert p.length == len(want) > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    for d in ids:
        at = 0
        for p in sorted(by_doc[d], key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[d])
    assert sorted(filled) == list(range(len(filled)))
    for s, parts in filled.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or s == max(filled) and at <= window


def test_round_trip(docs_of):
    rows = list(enumerate(TEXTS))
    for window in (7, 4096):
        check(rows, packing.pack(docs_of(rows).repartition(5), PATH, window).collect(), window)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check([tuple(r) for r in docs.collect()], packing.pack(docs.repartition(3), PATH).collect(), 4096)


def test_null_ids_and_no_rows(docs_of):
    assert [(p.doc_id, p.length) for p in packing.pack(docs_of([(None, None)]), PATH).collect()] == [(None, 1)]
    assert packing.pack(docs_of([]), PATH).collect() == []


def test_words_have_the_tokenizers_ids():
    """Words of letters take a shorter way; all words get the library's ids."""
    import random

    from tokenizers import Tokenizer

    path = PATH
    encode, ids_of = Tokenizer.from_file(path).encode_batch, packing.WordIds(path)
    assert ids_of.encode_part is not None
    rng = random.Random(6)
    letters = "etaoinshrdlucmfwypvbgkjqxzéèüöäßçñ"
    entries = [t.removesuffix("</w>") for t in Tokenizer.from_file(path).get_vocab()]
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))) for _ in range(20_000)]
    words += ["".join(rng.choices(entries, k=rng.randrange(1, 4))).lower() for _ in range(20_000)]
    marks = letters + "!\"#$%&'()*+,-./0123456789:;<=>?@[]^_`{|}~"
    words += ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 12))) for _ in range(20_000)]
    words += ["".join(rng.choice(["'s", "'t", "'ll", "'", "x", "re", ".", "'re", "d", "é", "1"]) for _ in range(6)) for _ in range(5000)]
    words += ["don't", "x'll", "É", "ŉ", "ﬁ", "a" * 300, "3.5", "--", "ª", "µ", "÷", "<|endoftext|>", "İ"]
    got = [np.frombuffer(ids_of[w], "<u4").tolist() for w in words]
    assert got == [e.ids for e in encode(words, add_special_tokens=False)]
    long = "b" * 1000 + " a " + "b" * 1000
    assert np.frombuffer(ids_of.of(long), "<u4").tolist() == encode([long], add_special_tokens=False)[0].ids
    assert max(map(len, ids_of)) <= packing.LONGEST
