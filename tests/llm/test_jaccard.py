"""The n-gram Jaccard join against all pairs."""

import random
import re

from pyspark.sql import functions as F

from dimweave.llm import jaccard

WORD = re.compile("[^\x20\x09-\x0d]+")


def word_sets(rows, width=4):
    out = []
    for doc_id, text in rows:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        w = min(width, len(words))
        out.append((doc_id, {tuple(words[i : i + w]) for i in range(len(words) - w + 1)} if words else set()))
    return out


def by_brute_force(rows, width=4, threshold=85):
    """(doc_id, set size, smallest doc_id reachable) of every row."""
    sets = word_sets(rows, width)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    judged = [k for k, (d, s) in enumerate(sets) if s and d is not None]
    for n, i in enumerate(judged):
        for j in judged[:n]:
            x, y = sets[i][1], sets[j][1]
            if min(len(x), len(y)) * 100 >= threshold * max(len(x), len(y)) and 100 * len(x & y) >= threshold * len(x | y):
                up[root(i)] = root(j)
    low = {}
    for k in judged:
        low[root(k)] = min(low.get(root(k), sets[k][0]), sets[k][0])
    return sorted(((d, len(s), low[root(k)] if k in set(judged) else d) for k, (d, s) in enumerate(sets)), key=str)


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x")).withColumn("n", F.lit(1))
    return sorted(map(tuple, jaccard.linked_classes(docs.repartition(3), **more).collect()), key=str)


def copies(rng, words, n, changes):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randrange(changes + 1)):
            w[rng.randrange(len(w))] = rng.choice("pqrstuvw") + str(rng.randrange(1000))
        out.append(" ".join(w))
    return out


def some_rows(seed=3):
    rng = random.Random(seed)
    vocabulary = [a + b for a in "abcdefgh" for b in "ijklmnop"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = text(60)
    texts = []
    for n in (7, 9, 12, 25, 40, 64, 70, 76, 80, 120, 400):  # near copies of every size, both sides of the limits
        texts += copies(rng, text(n), 12, max(1, n // 30))
    texts += [" ".join(text(30) + passage + text(40)) for _ in range(20)]  # a passage that many hold
    texts += [" ".join(passage + text(3)) for _ in range(20)]  # mostly that passage
    texts += copies(rng, text(100), 40, 9)  # a group whose members are far apart in part
    texts += ["", None, "  \n", "one", "ONE", "one two three", "one  two\tthree", "one two three four", " ".join(text(3000))]
    texts += [texts[5]] * 5 + [texts[100]] * 30
    rng.shuffle(texts)
    return [(10 * k, t) for k, t in enumerate(texts)]


def test_against_all_pairs(spark):
    rows = some_rows()
    want = by_brute_force(rows)
    assert len({c for _, _, c in want}) < len(want) - 100  # there is something to find
    assert found(spark, rows) == want


def test_other_width_and_threshold(spark):
    rows = some_rows(5)[:120]
    assert found(spark, rows, width=2, threshold=70) == by_brute_force(rows, 2, 70)


def test_ids_that_repeat_or_miss(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    rows = [(7, a), (7, b), (7, a), (3, b + " end"), (9, a + " end"), (None, a), (None, None), (1, None), (5, "")]
    got = found(spark, rows)
    # Each text of a repeated id keeps its own links.
    assert got == by_brute_force(rows) and (3, 48, 3) in got and (9, 48, 7) in got


def test_empty_table(spark):
    assert jaccard.linked_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_threshold_is_exact_and_links_chain(spark):
    """17 of 20 shingles in common is a link, the next smaller overlap is none;
    neighbours of a chain are linked, its ends are not."""
    rows = []
    for extra in range(30, 40):
        base = [f"w{extra}x{k}" for k in range(200)]
        rows += [(extra, " ".join(base)), (extra + 100, " ".join(base + [f"y{extra}x{k}" for k in range(extra)]))]
    words = [f"c{k}" for k in range(400)]
    rows += [(1000 - k, " ".join(words[5 * k : 5 * k + 200])) for k in range(30)]
    got = found(spark, rows)
    assert got == by_brute_force(rows) and {c for d, _, c in got if d > 900} == {971}


def test_no_join_makes_the_pairs_of_a_group(spark):
    """A group of near copies costs a few pairs for each copy."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, t) for k, t in enumerate(copies(rng, base, 400, 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = []
    whole = jaccard.linked

    def counted(pairs, cut, threshold):
        asked.append(pairs.count())
        return whole(pairs, cut, threshold)

    jaccard.linked = counted
    try:
        got = {r.component_id for r in jaccard.linked_classes(docs).collect()}
    finally:
        jaccard.linked = whole
    assert got == {c for *_, c in by_brute_force(rows)} and sum(asked) < 20 * len(rows)


def test_long_text(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(50_000)}" for _ in range(60_000)]
    other = list(words)
    for k in range(0, 60_000, 100):
        other[k] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:30_000]))]
    assert [c for _, _, c in found(spark, rows)] == [1, 1, 3]
