import random
import re

from dimweave.llm import linededup
from dimweave.llm.queries import ORACLE, QUERIES
from llm_fixtures import docs_of  # noqa: F401

WORD = re.compile("[^\x20\x09-\x0d]+")


def distance(a, b):
    """Word edit distance by dynamic programming."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    """Kept text and number of removed lines of each row, comparing all lines."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = [], []
    for i in order:
        text = rows[i][1]
        if text is None:
            out.append((rows[i][0], 0, 0, None))
            continue
        kept = []
        for line in text.split("\n"):
            w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in line))
            if not w:
                kept.append(line)
                continue
            if not any(w == s or min(len(w), len(s)) >= linededup.SHORTEST and abs(len(w) - len(s)) < 2 and distance(w, s) <= 1 for s in seen):
                kept.append(line)
            seen.append(w)
        n = len(text.split("\n"))
        out.append((rows[i][0], n, n - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"Wort{i}" for i in range(40)]
    lines = [" ".join(rng.choices(vocab, k=rng.choice([1, 3, 7, 8, 9, 12, 30]))) for _ in range(25)]
    rows = []
    for doc in range(60):
        text = []
        for _ in range(rng.randint(0, 8)):
            w = rng.choice(lines).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(w) + 1)
                kind = rng.choice("idr")
                w[k:k] = [rng.choice(vocab)] if kind != "d" else []
                if kind != "i" and k + (kind == "r") < len(w):
                    del w[k + (kind == "r")]
            text.append(rng.choice(["", "  "]) + "\t".join(w).upper() if rng.random() < .3 else " ".join(w))
            if rng.random() < .1:
                text.append("")
        rows.append((doc * 13 % 61, "\n".join(text)))
    return rows


def test_equals_brute_force(docs_of):
    for seed in (1, 2):
        rows = corpus(seed)
        got = sorted(map(tuple, linededup.dedup_lines(docs_of(rows)).select("doc_id", "n_lines", "n_removed", "text").collect()), key=repr)
        assert got == brute(rows)
        assert sum(g[2] for g in got) > 20


def test_many_lines_share_one_variant(docs_of):
    rows = [(i, f"user number {i} has joined the public channel now\nother {i}") for i in range(300)]
    got = linededup.dedup_lines(docs_of(rows)).collect()
    assert sum(r.n_removed for r in got) == 299 and [r.n_removed for r in got if r.doc_id == 0] == [0]


def test_edge_rows(docs_of):
    long = " ".join(f"z{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "Same line\n same  LINE"), (None, "Same line\nmine alone"), (5, long), (6, long + " end"), (7, "a\nb"), (8, "b")]
    got = sorted(map(tuple, linededup.dedup_lines(docs_of(rows)).select("doc_id", "n_lines", "n_removed", "text").collect()), key=repr)
    assert got == brute(rows)
    kept = linededup.clean(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    by = {r.doc_id: r for r in kept.collect()}
    assert set(by) == {1, 2, 3, 4, None, 5, 7} and by[4].text == "Same line" and by[4].n_chars == 9 and by[None].text == "mine alone"


def test_repeated_rows_and_ids(docs_of):
    rows = [(1, "x y\nz"), (1, "x y\nz"), (1, "z\nq"), (2, "q")]
    got = sorted((r.doc_id, r.text) for r in linededup.dedup_lines(docs_of(rows)).collect())
    assert got[:2] == [(1, "q"), (1, "x y\nz")] or got.count((1, "x y\nz")) == 2 or (1, "z\nq") in got
    assert got[-1] == (2, "")
    # The two equal rows have one place, and the same lines left.
    assert len({t for d, t in got if d == 1}) == 2


def test_empty_table(docs_of):
    assert linededup.dedup_lines(docs_of([])).collect() == []
    assert linededup.clean(docs_of([])).collect() == []


def test_within_one_is_the_edit_distance():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = (rng.choices("abc", k=rng.randint(0, 6)) for _ in range(2))
        assert linededup.within_one(a, b) == (distance(a, b) <= 1)


def test_words_are_the_same_in_code_and_statement(spark, tmp_path):
    """No-break and other spaces and letters beyond A-Z are parts of words."""
    import duckdb

    line = "this line has eight words and no more"
    odd = ["\xa0", "\x0b", "\x85", "\x1f", "\u2003", "\x0c", "\r", "\t"]
    rows = [line.replace(" ", s, 1) for s in odd] + [line.replace(" ", f" {s} ", 2) for s in odd]
    rows += ["ΟΔΟΣ is a street", "οδοσ is a street", "οδος is a street", "İstanbul once", "i̇stanbul once", "ÉTÉ here", "été here", "STRASSE Two", "strasse two", "K at 5", "k at 5", "\xa0", "\x85", "\x0b", " "]
    rows = list(enumerate([*rows, *rows[:3]]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(map(tuple, QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(rows) == sorted(con.sql(ORACLE["op7_line_dedup"]).fetchall(), key=repr)
