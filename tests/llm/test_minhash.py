import random
import re

import numpy as np

from dimweave.llm import minhash
from llm_fixtures import docs_of  # noqa: F401


def brute(rows):
    """component of each row by comparing all pairs of sets."""
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [shingles(t) for _, t in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and both and 100 * both >= 85 * len(sets[i] | sets[j]):
                at[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, len(s), low[root(i)] if d is not None else None, d is not None and low[root(i)] == d)
                   for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def corpus(seed=1, groups=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    rows, doc = [], 0
    for g in range(groups):
        base = rng.choices(vocab, k=rng.choice([3, 6, 40, 200, 700]))
        for _ in range(rng.choice([1, 2, 5, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5, 12]) if len(copy) > 30 else 0):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((doc * 7 % 1000, " ".join(copy).upper() if rng.random() < .2 else "\t".join(copy)))
            doc += 1
    return rows


def test_components_equal_brute_force(docs_of):
    rows = corpus()
    got = minhash.near_duplicates(docs_of(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_copies_that_are_only_linked_through_their_centre(docs_of):
    rng = random.Random(4)
    base = [f"c{i}" for i in range(400)]
    rows = [(500, " ".join(base))]
    for i in range(60):  # each 8 to 20 changes away from the centre, further from one another
        copy = list(base)
        for k in rng.sample(range(400), rng.choice([4, 6, 8, 20])):
            copy[k] = f"n{i}x{k}"
        rows.append((i, " ".join(copy)))
    got = minhash.near_duplicates(docs_of(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert len({r.component_id for r in got}) > 1


def test_edge_rows(docs_of):
    long_text = " ".join(f"v{i % 977}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b"), (5, "A  b"), (5, "A  b"), (None, "a b"), (6, "a b c"), (8, long_text), (7, long_text + " end")]
    got = minhash.near_duplicates(docs_of(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    kept = minhash.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 3, 4, 6, 7, None]
    # Rows that repeat a kept document count once.
    assert minhash.keep_one(docs_of([(1, "x y z"), (1, "x y z"), (1, "other")])).count() == 2


def test_empty_table(docs_of):
    assert minhash.near_duplicates(docs_of([])).collect() == []
    assert minhash.keep_one(docs_of([])).collect() == []


def test_every_pair_within_the_radius_shares_a_key():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, minhash.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[rng.permutation(minhash.SYMBOLS)[:minhash.RADIUS]] ^= 1
        ka, kb = minhash.chunk_keys(np.stack([a, b]))
        assert set(ka) & set(kb)
    # The worst spread: two errors in every chunk but one.
    b = a.copy().reshape(minhash.CHUNKS, -1)
    b[:, 0] ^= 1
    b[1:, 3] ^= 1
    ka, kb = minhash.chunk_keys(np.stack([a, b.ravel()]))
    assert set(ka) & set(kb)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        common, own = rng.integers(0, 2**63, 850, dtype=np.uint64), rng.integers(0, 2**63, 150, dtype=np.uint64)
        a = minhash.signature(np.concatenate([common, own[:75]]))
        b = minhash.signature(np.concatenate([common, own[75:]]))
        errors.append((a != b).sum())
    assert abs(np.mean(errors) / minhash.SYMBOLS - 0.15) < 0.02 and max(errors) <= minhash.RADIUS


def test_the_stage_links_from_80_per_cent(spark, docs_of):
    import corpus_pipeline

    rng = random.Random(6)
    rows = []
    for g in range(40):  # ten pairs each just under 0.80, at 0.80 to 0.85 (two kinds) and above 0.85
        base = [f"g{g}w{i}" for i in range(504)]  # 500 shingles; a changed word takes five
        copy = list(base)
        for i in range([12, 11, 9, 7][g % 4]):
            copy[20 + 40 * i] = "x"
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(copy))]
    rng.shuffle(rows)
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs_of(rows), "").collect()}
    assert kept == {d for d, _ in rows if d % 2 == 0 or d // 2 % 4 == 0}
    still = {r.doc_id for r in minhash.near_duplicates(docs_of(rows)).where("kept").collect()}  # op1: 85, as its SQL says
    assert still == {d for d, _ in rows if d % 2 == 0 or d // 2 % 4 != 3}


def test_every_pair_within_the_wider_radius_shares_a_key():
    rng, cut = np.random.default_rng(2), minhash.NEAR_80
    for _ in range(200):
        a = rng.integers(0, 1 << 16, cut.symbols).astype(np.uint16)
        b = a.copy()
        b[rng.permutation(cut.symbols)[:cut.radius]] ^= 1
        ka, kb = minhash.chunk_keys(np.stack([a, b]), cut.chunks)
        assert set(ka) & set(kb)
