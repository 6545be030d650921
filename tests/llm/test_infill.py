"""Fill-in-the-middle on compressed frames against whole-text versions."""

import hashlib
import random
import re

import zstandard

from dimweave.llm import infill
from dimweave.llm.queries import ORACLE, QUERIES

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(doc_id, text, seed=42, rate=50, spm=80):
    """Form, prefix and middle code points, and output, from the whole text."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    lo, hi = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def some_texts(n=400):
    rng = random.Random(5)
    parts = ["a", "word", " ", "  ", "\n", "\t", "\x0b", "é", " ", " ", "😀", "<", "<P", "<S", ">", "M>", "\x1f", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]
    return [*texts, "", None, " ", " \n ", "x", " x", "x ", "a<P>b", "a <M> b", "<S>"]


def held(frames):
    return [f["data"] for f in frames]


def test_against_whole_texts(monkeypatch):
    for size in (4, 7, 1 << 15):
        monkeypatch.setattr(infill, "FRAME", size)
        for doc_id, text in enumerate(some_texts()):
            packed = infill.pack_text(text)
            form, p, m, out = infill.transform_text(packed, doc_id, 42, 50, 80)
            assert (packed.units, form, p, m, infill.read(held(out))) == plain_version(doc_id, text)
            assert infill.read(infill.restore_frames(form, held(out))) == (text or "")
            assert infill.digest(held(out)) == hashlib.sha256(infill.read(held(out)).encode()).hexdigest()


def test_every_cut_and_markers_across_frames(monkeypatch):
    monkeypatch.setattr(infill, "FRAME", 4)
    text = "ab  <P cd<S\n\né<M >x  "
    for doc_id in range(400):
        form, _, _, out = infill.transform_text(infill.pack_text(text), doc_id, 1, 100, 50)
        assert form != "plain" and infill.read(held(out)) == plain_version(doc_id, text, 1, 100, 50)[4]
        # The output may be cut anywhere: other frames of the same text give the same.
        again = [zstandard.ZstdCompressor().compress(x) for x in infill._pieces(infill.read(held(out)).encode())]
        assert infill.read(infill.restore_frames(form, again)) == text


def test_only_cut_frames_are_decompressed(monkeypatch):
    text = "word " * 100_000
    packed = infill.pack_text(text)
    assert len(packed.frames) == 16
    opened = []
    compress, decompress = infill._codec()
    monkeypatch.setattr(infill, "_codec", lambda: (compress, lambda d: opened.append(len(d)) or decompress(d)))
    form, p, m, out = infill.transform_text(packed, 3, 42, 100, 80)
    assert form != "plain" and len(opened) <= 2
    same = sum(f is g for f in out for g in packed.frames)
    assert same >= 14
    # All frames together are one zstandard file.
    assert zstandard.ZstdDecompressor().stream_reader(b"".join(held(out)), read_across_frames=True).read().decode() == plain_version(3, text, rate=100)[4]


def test_long_units(monkeypatch):
    for text in ("x" * 200_000, " " * 100_000, " " * 70_000 + "é" * 70_000 + " end"):
        packed = infill.pack_text(text)
        assert packed.units == len(UNIT.findall(text)) and packed.chars == len(text)
        for doc_id in range(12):
            form, p, m, out = infill.transform_text(packed, doc_id, 42, 100, 80)
            assert infill.read(held(out)) == plain_version(doc_id, text, rate=100)[4]


def test_frame_job(spark):
    rows = [(k, t, "x") for k, t in enumerate(some_texts(60))] + [(3, "same id", "x"), (None, "no id here", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    done = infill.transform(infill.store(docs))
    got = {(r.doc_id, r.output) for r in infill.texts(done).collect()}
    assert {(k, plain_version(k, t)[4]) for k, t, _ in rows if k is not None} <= got
    for r in infill.digests(done).collect():
        if r.doc_id is not None and r.doc_id != 3:
            want = plain_version(r.doc_id, rows[r.doc_id][1])
            assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[:4]
            assert r.output_sha256 == hashlib.sha256(want[4].encode()).hexdigest()
            assert r.restored_sha256 == hashlib.sha256((rows[r.doc_id][1] or "").encode()).hexdigest()
    empty = infill.digests(infill.transform(infill.store(docs.where("false"))))
    assert empty.count() == 0


def test_statement(spark, tmp_path):
    import duckdb

    rows = [(k, t) for k, t in enumerate(some_texts(150))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = con.sql(ORACLE["op12_infill"])
    want = {dict(zip(found.columns, r))["doc_id"]: dict(zip(found.columns, r)) for r in found.fetchall()}
    got = {r.doc_id: r.asDict() for r in QUERIES["op12_infill"](spark, str(tmp_path)).collect()}
    assert got == want and len(got) == len(rows)
