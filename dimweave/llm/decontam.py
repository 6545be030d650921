"""Benchmark decontamination by template canonicalisation (SQL functions only).

Texts become sequences of lower-case words in which numbers, names and units
are typed slots.  Windows of ``WINDOW`` words of the template are hashed and
joined with the benchmark's windows.  Matches of one document and item on one
alignment are put together; the alignment counts if it has enough windows and
its slots are consistent: equal values in the item stand for equal values in
the document, and the other way round.  So a question is found again when its
numbers, names or units were replaced, as well as when it was copied.

* number: a word that starts with a digit; unit: one of ``UNITS`` after a
  number; name: a capitalised word that does not start a sentence or a line.
* An alignment needs ``ENOUGH`` windows (13 words at a stretch), or all usable
  windows of a shorter item; a window is usable if at least half of its words
  are not slots.  An item of fewer than ``WINDOW`` words is one window of its
  own length if it has ``SHORTEST`` words or more; shorter ones match nothing.

``alignments`` is that template reading alone, which op4's SQL states.
``whole_alignments``, which ``find`` and ``clean`` use by default, has further
readings of the same words (``READINGS``), so that letter case does not decide:

* literal: every word as it stands, in lower case, and only numbers as slots.
  So a passage in capitals, or copied into the middle of a sentence, is found.
  Windows that are mostly numbers and units have no slots, so that mostly-slot
  windows count when they are copied, and tables of other numbers do not.
* named: a word that starts a sentence is a name if it also stands as one
  within a sentence of its text.

Texts whose numbers have separators (1,200 or 3.5) or whose units are in
capitals are also cut with each such number as one slot.

Edge cases: null, empty and blank texts match nothing and are not
contaminated; benchmark items without id or text are skipped, and items that
repeat an id count as that id; every document row comes back once, repeated
rows and null ids included; empty tables give empty results or no match;
documents may have extra columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import checkpoint, small

WINDOW = 8
SHORTEST = 5
ENOUGH = 6
#: Words that count as units after a number.
UNITS = (
    "mm cm m km inch inches ft foot feet yd yard yards mile miles mg g kg oz lb lbs pound pounds ton tons tonnes "
    "ml cl l liter liters litre litres gallon gallons sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years percent pct cent cents dollar dollars usd eur euro euros mph kmh kw watt watts "
    "volt volts degree degrees acre acres"
).split()

_START = "\u0001"  # a capital that starts a sentence
_CHAIN = (  # (pattern, replacement), in this order; $n are groups
    (rf"(^|[.!?:\n][^\p{{L}}\p{{N}}]*)(\p{{Lu}})", rf"$1{_START}$2"),
    (rf"[^\p{{L}}\p{{N}}{_START}]+", " "),
    (r"( )(\p{Lu})", "$1@$2"),
    (rf"([0-9]) ?({'|'.join(UNITS)})( |$)", "$1 %$2$3"),
)


_JOIN = "\u0002"  # a separator within a number
_CHAIN_JOINED = (  # as _CHAIN; a number keeps its separators, units have any case
    (r"(?<=[0-9])[.,](?=[0-9])", _JOIN),
    _CHAIN[0],
    (rf"[^\p{{L}}\p{{N}}{_START}{_JOIN}]+", " "),
    _CHAIN[2],
    (rf"([0-9]) ?@?((?i:{'|'.join(UNITS)}))( |$)", "$1 %$2$3"),
)


def words(text: Column) -> Column:
    """The text's words, lower-cased; names start with @, units with %."""
    for pattern, replacement in _CHAIN:
        text = F.regexp_replace(text, pattern, replacement)
    return F.split(F.lower(F.replace(F.trim(text), F.lit(_START), F.lit(""))), " ")


def is_slot(word: Column) -> Column:
    return F.substring(word, 1, 1).isin(*"@%0123456789")


def template(word: Column) -> Column:
    """The word, or the type of its slot."""
    head = F.substring(word, 1, 1)
    return F.when(head.isin("@", "%"), head).when(head.isin(*"0123456789"), F.lit("#")).otherwise(word)


def _rest(word: Column) -> Column:
    return F.substring(word, 2, 1 << 30)


def _all_words(df: DataFrame, carry: list[str]) -> DataFrame:
    """carry, cutting and words: the words of ``text`` by both chains (one row
    if they agree).  A word that starts a sentence and also stands as a name
    within one keeps _START before it."""
    for i, chain in enumerate((_CHAIN, _CHAIN_JOINED)):
        text = F.col("text")
        for pattern, replacement in chain:
            text = F.regexp_replace(text, pattern, replacement)
        df = df.withColumn(f"raw_{i}", F.split(F.lower(F.trim(text)), " "))
    names = lambda i, sign: F.transform(F.filter(f"raw_{i}", lambda w: F.startswith(w, F.lit(sign))), _rest)
    df = df.withColumns({f"names_{i}": F.array_intersect(names(i, _START), names(i, "@")) for i in (0, 1)})
    # The names are bound as a variable, so that they are not made again for each word.
    cut = F.flatten(F.array(*(F.transform(F.array(f"names_{i}"), _marked(f"raw_{i}")) for i in (0, 1))))
    return df.select(*carry, F.posexplode(F.array_distinct(cut)).alias("cutting", "words"))


def _marked(raw: str) -> Callable[[Column], Column]:
    return lambda names: F.transform(raw, _mark(names))


def _mark(names: Column) -> Callable[[Column], Column]:
    return lambda w: F.when(F.startswith(w, F.lit(_START)) & ~F.array_contains(names, _rest(w)), _rest(w)).otherwise(w)


def _head(word: Column, *signs: str) -> Column:
    return F.substring(word, 1, 1).isin(*signs)


def _plain(word: Column) -> Column:
    """The word without the sign of its type."""
    return F.when(_head(word, "@", "%", _START), _rest(word)).otherwise(word)


def _typed(word: Column) -> Column:
    """The template's word: what starts a sentence stands for itself."""
    return F.when(_head(word, _START), _rest(word)).otherwise(template(word))


def _named(word: Column) -> Column:
    """As _typed, with names that start a sentence as names."""
    return F.when(_head(word, _START), F.lit("@")).otherwise(template(word))


def _literal(word: Column) -> Column:
    """The word itself, whatever its case; numbers are slots."""
    return F.when(_head(word, *"0123456789"), F.lit("#")).otherwise(_plain(word))


def _bare(word: Column) -> Column:
    """1 for a number or a unit."""
    return F.when(_head(word, *"0123456789") | _plain(word).isin(*UNITS), 1).otherwise(0)


def _windows(df: DataFrame, carry: list[str], width: int) -> DataFrame:
    """carry, pos (from 0) and key: the hash of every run of ``width`` template words.

    Hashes of 1, 2, 4 .. words are paired by shifted copies of the array and
    put together by the binary digits of the width.
    """
    df = df.where(F.size("words") >= width).select(*carry, F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(template(w))).alias("run"))
    size, done = 1, 0
    while size <= width:
        if width & size:
            shifted = F.col("run") if not done else F.slice("run", done + 1, F.col("n"))
            df = df.withColumn("key", shifted if not done else F.zip_with("key", shifted, lambda a, b: F.xxhash64(a, b)))
            done += size
        if 2 * size <= width:
            df = df.withColumn("run", F.zip_with("run", F.slice("run", size + 1, F.col("n")), lambda a, b: F.xxhash64(a, b)))
        size *= 2
    return df.select(*carry, F.posexplode(F.slice("key", 1, F.col("n") - width + 1)).alias("pos", "key"))


def _items(benchmark: DataFrame) -> DataFrame:
    items = benchmark.where("item_id is not null and text is not null").select("item_id", words(F.col("text")).alias("words")).distinct()
    items = items.where(F.size("words") >= SHORTEST)
    return items.select("item_id", F.xxhash64("words").alias("variant"), "words", F.least(F.size("words"), F.lit(WINDOW)).alias("width"))


def alignments(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, first (word of the document that stands for
    the item's first), n_windows and same (no slot changed), for every match
    whose slots are consistent."""
    items = checkpoint(_items(benchmark))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most WINDOW - SHORTEST + 1
    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, item_id long, first int, n_windows int, same boolean")
    texts = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    usable = _usable(items, widths)
    need = usable.groupBy("item_id", "variant").agg(F.least(F.count(F.lit(1)), F.lit(ENOUGH)).alias("need"))
    hits = None
    for width in widths:
        keys = small(checkpoint(usable.where(F.col("width") == width).select("key", "item_id", "variant", F.col("pos").alias("item_pos"))))
        found = _windows(texts, ["doc_id", "text_hash"], width).join(keys, "key").select(
            "doc_id", "text_hash", "item_id", "variant", (F.col("pos") - F.col("item_pos")).alias("first"), "item_pos", F.lit(width).alias("width"))
        hits = found if hits is None else hits.unionByName(found)
    hits = (
        hits.groupBy("doc_id", "text_hash", "item_id", "variant", "first", "width")
        .agg(F.array_sort(F.collect_set("item_pos")).alias("at"))  # at most as many as the item has windows
        .join(need, ["item_id", "variant"]).where(F.size("at") >= F.col("need"))
    )
    hits = checkpoint(hits.join(items.select("item_id", "variant", F.col("words").alias("item_words")), ["item_id", "variant"]))
    # Only documents with a match are read again for their slot values.
    again = small(checkpoint(hits.select("doc_id", "text_hash").distinct()))
    mine = again.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    full = docs.where("text is not null").withColumn("text_hash", F.xxhash64("text")).select("doc_id", "text_hash", "text").join(
        mine, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left_semi"
    ).dropDuplicates(["doc_id", "text_hash"]).select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), words(F.col("text")).alias("doc_words"))
    covered = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + F.col("width") - 1))))
    slots = F.transform(
        F.filter(covered, lambda p: is_slot(F.get("item_words", p))),
        lambda p: F.struct(F.get("item_words", p).alias("asked"), F.get("doc_words", p + F.col("first")).alias("stands")),
    )
    put = hits.join(full, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))).withColumn("slots", slots)
    pairs, asked, stands = (F.size(F.array_distinct(c)) for c in (F.col("slots"), F.col("slots.asked"), F.col("slots.stands")))
    return put.where((pairs == asked) & (pairs == stands)).select(
        "doc_id", "text_hash", "item_id", "first", F.size("at").alias("n_windows"),
        F.forall("slots", lambda s: s["asked"] == s["stands"]).alias("same"))


def _usable(items: DataFrame, widths: list[int]) -> DataFrame:
    """The benchmark's windows with their keys, without those that are mostly slots."""
    out = None
    for width in widths:
        one = items.where(F.col("width") == width)
        w = _windows(one, ["item_id", "variant", "width", "words"], width)
        w = w.where(F.size(F.filter(F.slice("words", F.col("pos") + 1, F.col("width")), lambda x: ~is_slot(x))) * 2 >= F.col("width")).drop("words")
        out = w if out is None else out.unionByName(w)
    return out


def _hashed(read: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda w: F.xxhash64(read(w))


#: The readings of a window: each says what a word counts as.
READINGS = {"typed": _typed, "named": _named, "literal": _literal}


def _read_windows(df: DataFrame, carry: list[str], width: int) -> DataFrame:
    """carry, pos and keys: an array of reading and key, one for each of READINGS.
    The literal reading of a window that is mostly numbers and units has no slots."""
    runs = {**{k: _hashed(f) for k, f in READINGS.items()}, "exact": _hashed(_plain), "bare": _bare}
    put = {k: (lambda a, b: a + b) if k == "bare" else (lambda a, b: F.xxhash64(a, b)) for k in runs}
    df = df.where(F.size("words") >= width).select(*carry, F.size("words").alias("n"), *(F.transform("words", f).alias(f"run_{k}") for k, f in runs.items()))
    size, done = 1, 0
    while size <= width:
        if width & size:
            shifted = {k: F.slice(f"run_{k}", done + 1, F.col("n")) if done else F.col(f"run_{k}") for k in runs}
            df = df.withColumns({f"key_{k}": F.zip_with(f"key_{k}", shifted[k], put[k]) if done else shifted[k] for k in runs})
            done += size
        if 2 * size <= width:
            df = df.withColumns({f"run_{k}": F.zip_with(f"run_{k}", F.slice(f"run_{k}", size + 1, F.col("n")), put[k]) for k in runs})
        size *= 2
    df = df.select(*carry, F.posexplode(F.arrays_zip(*(F.slice(f"key_{k}", 1, F.col("n") - width + 1).alias(k) for k in runs))).alias("pos", "k"))
    key = {k: F.col(f"k.{k}") for k in READINGS}
    key["literal"] = F.when(F.col("k.bare") * 2 > width, F.col("k.exact")).otherwise(key["literal"])
    return df.select(*carry, "pos", F.array(*(F.struct(F.lit(k).alias("reading"), c.alias("key")) for k, c in key.items())).alias("keys"))


def _read_items(items: DataFrame, widths: list[int]) -> DataFrame:
    """The benchmark's windows by all readings: item_id, variant, width, item_pos,
    reading, key and usable (not mostly slots of the template)."""
    out = None
    for width in widths:
        w = _read_windows(items.where(F.col("width") == width), ["item_id", "variant", "width", "words"], width)
        own = F.slice("words", F.col("pos") + 1, F.col("width"))
        few = lambda slot: F.size(F.filter(own, lambda x: ~slot(x))) * 2 >= F.col("width")  # noqa: E731, B023
        w = w.withColumns({"usable": few(is_slot), "usable_named": few(lambda x: is_slot(x) | _head(x, _START))})
        w = w.select("item_id", "variant", "width", F.col("pos").alias("item_pos"), "usable", "usable_named", F.explode("keys").alias("k"))
        w = w.where((F.col("k.reading") == "literal") | F.when(F.col("k.reading") == "named", F.col("usable_named")).otherwise(F.col("usable")))
        w = w.select("item_id", "variant", "width", "item_pos", "usable", "k.reading", "k.key")
        out = w if out is None else out.unionByName(w)
    return out


#: Sets of an alignment's windows; any of them can be enough and consistent.
_SETS = {"typed": "reading = 'typed'", "named": "reading = 'named'", "usable": "usable", "every": "true"}


def whole_alignments(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """As ``alignments``, by all readings of a window.  Enough and consistent
    must be the windows of the template reading, those with names that start a
    sentence, or those of all readings together (without or with mostly-slot ones)."""
    items = _all_words(benchmark.where("item_id is not null and text is not null"), ["item_id"]).drop("cutting").distinct()
    items = checkpoint(items.where(F.size("words") >= SHORTEST).select(
        "item_id", F.xxhash64("words").alias("variant"), "words", F.least(F.size("words"), F.lit(WINDOW)).alias("width")))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most WINDOW - SHORTEST + 1
    if not widths:
        return alignments(docs, benchmark)
    place = ["doc_id", "text_hash", "cutting"]
    texts = _all_words(docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), place[:2])
    keys = checkpoint(_read_items(items, widths))
    need = keys.groupBy("item_id", "variant").agg(*(
        F.least(F.count_distinct(F.when(F.expr(which), F.col("item_pos"))), F.lit(ENOUGH)).alias(f"need_{k}") for k, which in _SETS.items()))
    hits = None
    for width in widths:
        own = small(checkpoint(keys.where(F.col("width") == width)))
        found = _read_windows(texts, place, width).select(*place, "pos", F.explode("keys").alias("k")).select(
            *place, "pos", "k.reading", "k.key").join(own, ["key", "reading"]).select(
            *place, "item_id", "variant", (F.col("pos") - F.col("item_pos")).alias("first"), "item_pos", "reading", "usable", "width")
        hits = found if hits is None else hits.unionByName(found)
    enough = F.filter(F.array(*(F.when((F.size(k) >= F.col(f"need_{k}")) & (F.size(k) > 0), F.array_sort(k)) for k in _SETS)), lambda x: x.isNotNull())
    hits = (
        hits.groupBy(*place, "item_id", "variant", "first", "width")
        .agg(*(F.collect_set(F.when(F.expr(which), F.col("item_pos"))).alias(k) for k, which in _SETS.items()))
        .join(need, ["item_id", "variant"])
        .select(*place, "item_id", "variant", "first", "width", F.explode(F.array_distinct(enough)).alias("at"))
    )
    hits = checkpoint(hits.join(items.select("item_id", "variant", F.col("words").alias("item_words")), ["item_id", "variant"]))
    # Only documents with a match are read again for their slot values.
    again = small(checkpoint(hits.select("doc_id", "text_hash").distinct()))
    mine = again.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    full = docs.where("text is not null").withColumn("text_hash", F.xxhash64("text")).select("doc_id", "text_hash", "text").join(
        mine, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    full = _all_words(full, place[:2]).toDF("own_id", "own_hash", "own_cutting", "doc_words")
    covered = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + F.col("width") - 1))))
    slots = F.transform(
        F.filter(covered, lambda p: is_slot(F.get("item_words", p)) | _head(F.get("item_words", p), _START)),
        lambda p: F.struct(_plain(F.get("item_words", p)).alias("asked"), _plain(F.get("doc_words", p + F.col("first"))).alias("stands")),
    )
    put = hits.join(full, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")) & (F.col("cutting") == F.col("own_cutting"))).withColumn("slots", slots)
    pairs, asked, stands = (F.size(F.array_distinct(c)) for c in (F.col("slots"), F.col("slots.asked"), F.col("slots.stands")))
    return put.where((pairs == asked) & (pairs == stands)).select(
        "doc_id", "text_hash", "item_id", "first", F.size("at").alias("n_windows"),
        F.forall("slots", lambda s: s["asked"] == s["stands"]).alias("same"))


def find(docs: DataFrame, benchmark: DataFrame, match: Callable[[DataFrame, DataFrame], DataFrame] = whole_alignments) -> DataFrame:
    """One row for each document: doc_id, contaminated, n_items, items (their
    ids, ascending, joined by commas) and reworded (items only found with other
    slot values).  With ``alignments`` as ``match``, as op4's SQL states it."""
    found = match(docs, benchmark).groupBy("doc_id", "text_hash", "item_id").agg(F.max("same").alias("same"))
    per = found.groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_join(F.transform(F.array_sort(F.collect_list("item_id")), lambda i: i.cast("string")), ",").alias("items"),
        F.sum(F.when(F.col("same"), 0).otherwise(1)).alias("reworded"),
    ).select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "n_items", "items", "reworded")
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash")).join(
        per, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")), "left"
    ).select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
             F.coalesce("items", F.lit("")).alias("items"), F.coalesce("reworded", F.lit(0)).alias("reworded"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents (all their columns) without the contaminated ones."""
    bad = checkpoint(whole_alignments(docs, benchmark).select(F.col("doc_id").alias("id__"), F.col("text_hash").alias("hash__")).distinct())
    return docs.join(small(bad), docs["doc_id"].eqNullSafe(F.col("id__")) & (F.xxhash64(docs["text"]) == F.col("hash__")), "left_anti")
