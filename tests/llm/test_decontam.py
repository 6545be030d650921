import pytest

from dimweave.llm import decontam
from llm_fixtures import docs_of  # noqa: F401

ITEM = "When Tom has 3 apples and walks 5 km to the market, then Tom gives his sister 3 apples and rides the bus all the way home again."
SAID = ITEM.replace("Tom", "{n}").replace("3", "{a}").replace("5 km", "{b}")
PAD = "Some opening words about nothing at all.\n{}\nAnd a closing line without any meaning."


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, ITEM), (2, "Which river runs through the old town of Springfield before it meets the sea at last?"), (3, None), (None, "x y z " * 9),
            (4, "12 13 14 15 16 17 18 19 20 21 22 23 24 25 26"), (5, "so it goes and goes"), (6, "too short"), (1, ITEM)]
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "item_id long, text string, doc_id string")


CASES = [  # text, items, reworded
    (PAD.format(ITEM), "1", 0),
    (PAD.format(ITEM.replace("When", "when")), "1", 0),
    (PAD.format(SAID.format(n="Anna", a="7", b="12 miles")), "1", 1),
    (PAD.format(SAID.format(n="Anna", a="7", b="12miles")), "1", 1),
    (PAD.format(SAID.format(n="Anna", a="7", b="7 km")), "", 0),  # two values became one
    (PAD.format(ITEM.replace("then Tom", "then Bob")), "", 0),  # one value became two
    (PAD.format(" ".join(ITEM.split()[8:22])), "1", 0),  # 14 words in a row
    (PAD.format(" ".join(ITEM.split()[8:19])), "", 0),  # 11 words in a row
    (PAD.format("41 42 43 44 45 46 47 48 49 50 51 52 53 54 55"), "", 0),  # a table of numbers says nothing
    (PAD.format("so it goes, and goes"), "5", 0),
    (PAD.format("it is too short"), "", 0),
    (ITEM + " " + ITEM, "1", 0),
    (ITEM + " Which river runs through the old town of Shelbyville before it meets the sea at last?", "1,2", 1),
    (None, "", 0), ("", "", 0), (" \n ", "", 0), ("w " * 50_000 + ITEM, "1", 0),
]


def test_cases(docs_of, benchmark):
    docs = docs_of([(i, t) for i, (t, _, _) in enumerate(CASES)])
    got = {r.doc_id: r for r in decontam.find(docs, benchmark).collect()}
    for i, (text, items, reworded) in enumerate(CASES):
        r = got[i]
        assert (r.items, r.reworded, r.contaminated, r.n_items) == (items, reworded, items != "", len(items.split(",")) if items else 0), text
    kept = decontam.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, c in enumerate(CASES) if not c[1]]


def test_null_and_repeated_ids(docs_of, benchmark):
    rows = [(None, ITEM), (None, "clean"), (7, ITEM), (7, ITEM), (7, "clean"), (8, "clean")]
    got = sorted(((r.doc_id, r.contaminated) for r in decontam.find(docs_of(rows), benchmark).collect()), key=repr)
    assert got == sorted([(None, True), (None, False), (7, True), (7, True), (7, False), (8, False)], key=repr)
    assert sorted(repr(r.doc_id) for r in decontam.clean(docs_of(rows), benchmark).collect()) == ["7", "8", "None"]


def test_empty_tables(docs_of, benchmark):
    assert decontam.find(docs_of([]), benchmark).collect() == []
    got = decontam.find(docs_of([(1, ITEM)]), benchmark.limit(0)).collect()
    assert [(r.doc_id, r.contaminated) for r in got] == [(1, False)]
    assert decontam.clean(docs_of([(1, ITEM)]), benchmark.limit(0)).count() == 1


def test_no_python_in_the_plan(spark, docs_of, benchmark):
    df = decontam.find(docs_of([(1, ITEM)]), benchmark)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def found_in(spark, docs_of, asked, said):
    items = spark.createDataFrame([(1, asked)], "item_id long, text string")
    return [r.items for r in decontam.find(docs_of(list(enumerate(said))), items).orderBy("doc_id").collect()]


def test_letter_case_does_not_hide_a_copy(spark, docs_of):
    thirteen = "Which river runs through the old town of Springfield before it meets the"  # a name inside, 13 words
    said = [PAD.format(thirteen.upper()), "boas eaea ndorea " + thirteen + " mado", thirteen.lower(), thirteen.upper().replace("RIVER", "ROAD"),
            "boas eaea " + thirteen.replace("Springfield", "Shelbyville") + " mado"]
    assert found_in(spark, docs_of, thirteen, said) == ["1", "1", "1", "", "1"]
    assert found_in(spark, docs_of, ITEM, [ITEM.upper(), ITEM.upper().replace("3", "8"), ITEM.upper().replace("5 KM", "3 KM")]) == ["1", "1", ""]


def test_names_that_start_a_sentence_and_numbers_with_separators(spark, docs_of):
    asked = "Tom has 3 apples. Tom buys 5 more. How many apples does Tom have?"
    said = [asked.replace("Tom", "Anna"), asked.replace("Tom", "Anna").replace("Anna buys", "Bob buys"), asked.upper(), asked]
    assert found_in(spark, docs_of, asked, [PAD.format(s) for s in said]) == ["1", "", "1", "1"]
    asked = "A barge with 1,200 crates of fruit and 3.5 tons of salt goes up the old canal"
    said = [asked.replace("1,200", "950").replace("3.5", "4"), asked.replace("3.5", "1,200"), asked.replace("3.5 tons", "9.25 TONS")]
    assert found_in(spark, docs_of, asked, [PAD.format(s) for s in said]) == ["1", "", "1"]


def test_mostly_slot_items_are_found_when_copied(spark, docs_of):
    asked = "What is 12 + 15 * 3 - 7 / 2 + 9 ?"
    said = [asked, asked.lower(), asked.replace("15", "16"), "what is 1 + 2 * 4 - 8 / 3 + 6"]
    assert found_in(spark, docs_of, asked, [PAD.format(s) for s in said]) == ["1", "1", "", ""]
    table = " ".join(str(i) for i in range(12, 27))
    assert found_in(spark, docs_of, table, [PAD.format(s) for s in (table, table.replace("19", "91"), "41 42 43 44 45 46 47 48 49 50 51 52 53 54 55")]) == ["1", "", ""]
