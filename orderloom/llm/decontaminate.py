"""Benchmark questions in documents, also with other numbers, names and units, found by template and literal windows.

Each word of a text is put in canonical form: lower case without outer punctuation, or a placeholder <num>, <unit>, <qty> (a number
with its unit attached) or <name> (a capitalised word that does not begin a sentence). Windows of WINDOW words of the documents are
hash-joined with those of the items in two forms, canonical and literal (lower case, no placeholders). That first pass carries hashes
only: the few windows that meet an item's leave the scan, and only their documents are read again for the words behind the placeholders.
On one alignment of a document with an item, a placeholder's word must map to one word of the document, or to one in most of its places; template
windows that hold another place are dropped, literal ones are not, as their words are the item's. A document is a leak of an item if the windows left
cover MIN_COVERAGE of the item's windows, or if RUN_WORDS running words of it on one alignment. Built of DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.tables import joinable, staging

WINDOW = 8
MIN_LITERALS = 4
MIN_COVERAGE = 0.5
RUN_WORDS = 13
BROADCAST_WINDOWS = 100_000  # more windows of benchmark items than this are joined by a shuffle
SPACES = r"[\x20\x09-\x0D]+"

# Words that the canonical form takes for a unit or a number.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles", "meter", "meters", "metre", "metres",
    "mg", "g", "kg", "ton", "tons", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "ounce", "ounces", "lb", "lbs", "oz",
    "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "s", "ms", "sec", "second", "seconds", "min", "minute", "minutes",
    "h", "hr", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent", "cents",
    "euro", "euros", "usd", "eur", "percent", "kb", "mb", "gb", "tb", "hz", "khz", "mhz", "ghz", "w", "kw", "v", "volt", "volts", "watt", "watts",
)
NUMBER_WORDS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen",
    "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand",
    "million", "billion",
)
PLACEHOLDERS = ("<num>", "<unit>", "<qty>", "<name>")
OUTER = ".,;:!?()[]{}\"'"
SENTENCE_ENDS = (".", "!", "?", ":")
NUMBER = r"^[0-9]+([.,:/-][0-9]+)*(%|st|nd|rd|th)?$"
QUANTITY = r"^[0-9]+([.,][0-9]+)*[a-z]{1,4}$"


def let(value: Column, body) -> Column:
    """body(value) with value computed once, although body uses it within other functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda x: x != "")


def _bare(word) -> Column:
    return F.lower(F.btrim(word, F.lit(OUTER)))


def _form(low: Column, word: Column, before: Column) -> Column:
    """The canonical form of a word; low: its bare lower case; before: the word in front of it, null for the first."""
    first = F.substring(F.btrim(word, F.lit(OUTER)), 1, 1)
    return (
        F.when((low >= "0") & (low < ":"), F.when(low.rlike(NUMBER), "<num>").when(low.rlike(QUANTITY), "<qty>").otherwise(low))
        .when(low.isin(*UNITS, *NUMBER_WORDS), F.when(low.isin(*UNITS), "<unit>").otherwise("<num>"))
        .when((word != low) & (first != F.lower(first)) & before.isNotNull() & ~F.coalesce(F.substring(before, -1, 1), F.lit("")).isin(*SENTENCE_ENDS), "<name>")
        .otherwise(low))


def _forms(tokens: Column, low: Column) -> Column:
    return F.transform(low, lambda x, i: _form(x, F.get(tokens, i), F.when(i > 0, F.get(tokens, i - 1))))


def canonical(tokens: Column) -> Column:
    return let(tokens, lambda t: let(F.transform(t, _bare), lambda l: _forms(t, l)))


def _keys(size: int, forms: Column, low: Column, at) -> list[Column]:
    """The hashes of the template and the literal window of `size` words at a place; forms, low: arrays of the words' hashes."""
    return [F.xxhash64(F.lit(size), F.lit(kind), *[F.get(words, at + i) for i in range(size)]) for kind, words in (("template", forms), ("literal", low))]


def _windows(of: DataFrame, carry: list[str], sizes: list[int]) -> DataFrame:
    """Columns `carry`, size, pos, key and literal of every window of the given sizes of the texts in `raw` (arrays of words)."""
    hashed = of.select(*carry, "raw", F.transform("raw", _bare).alias("low")).select(
        *carry, F.transform(_forms(F.col("raw"), F.col("low")), lambda x: F.xxhash64(x)).alias("forms"), F.transform("low", lambda x: F.xxhash64(x)).alias("low"))
    places = hashed.select(*carry, "forms", "low", F.size("low").alias("n"), F.explode(F.sequence(F.lit(0), F.size("low") - 1)).alias("pos"))
    keys = [F.struct(F.lit(n).alias("size"), F.lit(k == 1).alias("literal"), F.when(F.col("pos") + n <= F.col("n"), key).alias("key"))
            for n in sizes for k, key in enumerate(_keys(n, F.col("forms"), F.col("low"), F.col("pos")))]
    return places.select(*carry, "pos", F.explode(F.array(*keys)).alias("k")).select(*carry, "pos", "k.*").filter("key IS NOT NULL")


def row_key(docs: DataFrame) -> Column:
    """Names a document row by its id and text: repeated rows, which are all leaks or none, share it."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def leaks(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, min_literals: int = MIN_LITERALS, min_coverage: float = MIN_COVERAGE,
          run_words: int = RUN_WORDS) -> DataFrame:
    """One row per leaked pair of document (doc_id, text) and item (item_id, text): doc_id, item_id, n_windows (of the item), n_matched, coverage,
    run_words (the longest run of matched words), n_slots (places of the item with a placeholder in matched windows), reparametrised (one of them differs), row_key.

    An item of fewer than `window` words is one window of its length. Windows with fewer than min_literals words that are no
    placeholder (or half of a shorter window) match only literally, and count only in items that have no others. Null and empty texts, of either
    side, match nothing. Repeated rows give one pair. Of several texts under one item_id, each is an item of its own, and the one covered best is
    reported. Extra columns are not read.
    """
    stage = staging(docs.sparkSession)
    item = items.select("item_id", words(F.col("text")).alias("raw")).filter("size(raw) > 0")
    item = stage(item.select(F.xxhash64("item_id", "raw").alias("item_key"), "item_id", "raw", F.transform("raw", _bare).alias("words"), canonical(F.col("raw")).alias("forms")).distinct())
    sizes = sorted(r[0] for r in item.select(F.least(F.size("forms"), F.lit(window))).distinct().collect()) or [window]  # at most `window` numbers
    n = F.least(F.size("forms"), F.lit(window))
    cut = _windows(item, ["item_key"], sizes)
    cut = cut.join(item.select(F.col("item_key").alias("key_"), "item_id", "words", "forms"), F.col("item_key") == F.col("key_")).filter(F.col("size") == n)
    part = lambda c: F.slice(c, F.col("pos") + 1, F.col("size"))
    literals = F.size(F.filter(part("forms"), lambda x: ~x.isin(*PLACEHOLDERS)))
    cut = cut.select("item_key", "item_id", "size", F.col("pos").alias("item_pos"), "literal", "key", part("words").alias("item_words"), part("forms").alias("item_forms"),
                     (literals >= F.least(F.lit(min_literals), F.ceil(F.col("size") / 2))).alias("enough"))
    some = cut.groupBy(F.col("item_key").alias("key_")).agg(F.max("enough").alias("templates"))
    cut = stage(cut.join(some, F.col("item_key") == F.col("key_")).filter("enough or not templates").filter("literal or enough").drop("key_", "templates"))
    totals = cut.filter("literal").groupBy(F.col("item_key").alias("key_")).agg(F.count("*").alias("n_windows"))
    small = cut.count() <= BROADCAST_WINDOWS
    asked = cut.select("key", "literal", "size", "item_key", "item_pos")
    # first pass: only windows with a match leave the scan, and no words: texts are never shuffled
    seen = _windows(docs.select("doc_id", row_key(docs).alias("row_key"), words(F.col("text")).alias("raw")).filter("size(raw) > 0"), ["doc_id", "row_key"], sizes)
    met = seen.select("doc_id", "row_key", "pos", "key").join(F.broadcast(asked) if small else asked, "key").select(
        "doc_id", "row_key", "item_key", "item_pos", "size", "literal", "pos")
    met = stage(met.groupBy("doc_id", "row_key", "item_key", "item_pos", "size", "pos").agg(F.max("literal").alias("literal")))
    # second pass: the words of these windows, from the documents that have some
    places = met.groupBy(F.col("doc_id").alias("doc_"), F.col("row_key").alias("row_")).agg(F.collect_set(F.struct("pos", "size")).alias("places"))  # of one text
    same = lambda key: F.col("row_key").eqNullSafe(F.col(f"row{key}")) & F.col("doc_id").eqNullSafe(F.col(f"doc{key}"))
    again = docs.select("doc_id", row_key(docs).alias("row_key"), F.col("text").alias("text_")).join(joinable(places, stage), same("_")).drop("doc_", "row_")
    again = again.dropDuplicates(["doc_id", "row_key"]).select("doc_id", "row_key", "places", F.transform(words(F.col("text_")), _bare).alias("low"))
    of_docs = again.select(F.col("doc_id").alias("doc_"), F.col("row_key").alias("row_"), "low", F.explode("places").alias("p")).select(
        "doc_", "row_", F.col("p.pos").alias("pos_"), F.col("p.size").alias("size_"), F.slice("low", F.col("p.pos") + 1, F.col("p.size")).alias("doc_words"))
    spot = met.join(stage(of_docs), same("_") & (F.col("pos") == F.col("pos_")) & (F.col("size") == F.col("size_"))).drop("doc_", "row_", "pos_", "size_")
    sides = cut.filter("literal").select(F.col("item_key").alias("key_"), F.col("item_pos").alias("at_"), "item_words", "item_forms")
    spot = spot.join(sides, (F.col("item_key") == F.col("key_")) & (F.col("item_pos") == F.col("at_"))).drop("key_", "at_")
    each = F.arrays_zip("item_words", "item_forms", "doc_words")
    spot = spot.filter(F.forall(each, lambda x: x["item_forms"].isin(*PLACEHOLDERS) | (x["item_words"] == x["doc_words"])))  # beyond equal hashes
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    slots = F.filter(F.transform(each, lambda x, i: F.struct((F.col("item_pos") + i).alias("at"), x["item_words"].alias("item_word"), x["doc_words"].alias("doc_word"),
                                                             x["item_forms"].isin(*PLACEHOLDERS).alias("open"))), lambda x: x["open"])
    spot = stage(spot.select("doc_id", "row_key", "item_key", "item_pos", "size", "literal", shift, slots.alias("slots")))
    keys = ["doc_id", "row_key", "item_key", "shift"]
    places = spot.select(*keys, F.explode("slots").alias("s")).select(*keys, "s.at", "s.item_word", "s.doc_word").distinct()
    votes = places.groupBy(*keys, "item_word", "doc_word").agg(F.collect_set("at").alias("places"))  # places of one item
    votes = votes.groupBy(*keys, "item_word").agg(F.sum(F.size("places")).alias("n"), F.collect_list("places").alias("maps"))
    clash = votes.select(*keys, F.flatten(F.filter("maps", lambda m: 2 * F.size(m) <= F.col("n"))).alias("clash")).groupBy(
        F.col("doc_id").alias("doc_"), F.col("row_key").alias("row_"), F.col("item_key").alias("key_"), F.col("shift").alias("shift_")).agg(
        F.flatten(F.collect_list("clash")).alias("clash"))
    kept = spot.join(clash, same("_") & (F.col("item_key") == F.col("key_")) & (F.col("shift") == F.col("shift_")), "left").filter(
        F.col("literal") | ~F.coalesce(F.exists("clash", lambda at: F.exists("slots", lambda x: x["at"] == at)), F.lit(False)))
    row = F.row_number().over(Window.partitionBy(*keys).orderBy("item_pos"))
    runs = kept.select(*keys, "item_pos", "size", "slots", (F.col("item_pos") - row).alias("run"))
    runs = runs.groupBy(*keys, "run").agg((F.count("*") + F.max("size") - 1).alias("run_words"), F.collect_set("item_pos").alias("spots"), F.flatten(F.collect_list("slots")).alias("slots"))
    found = runs.groupBy("doc_id", "row_key", "item_key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("spots")))).cast("long").alias("n_matched"), F.max("run_words").alias("run_words"), F.flatten(F.collect_list("slots")).alias("slots"))
    found = found.join(totals, F.col("item_key") == F.col("key_")).drop("key_").withColumn("coverage", F.col("n_matched") / F.col("n_windows")).filter(
        (F.col("coverage") >= min_coverage) | (F.col("run_words") >= run_words))
    found = found.join(item.select(F.col("item_key").alias("key_"), "item_id"), F.col("item_key") == F.col("key_"))
    best = F.struct("coverage", "n_matched", "n_windows", "run_words", F.size(F.array_distinct(F.transform("slots", lambda x: x["at"]))).cast("long").alias("n_slots"),
                    F.exists("slots", lambda x: x["item_word"] != x["doc_word"]).alias("reparametrised"))
    return found.groupBy("doc_id", "row_key", "item_id").agg(F.max(best).alias("b")).select(
        "doc_id", "item_id", "b.n_windows", "b.n_matched", "b.coverage", "b.run_words", "b.n_slots", "b.reparametrised", "row_key")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that are no leak of any item. Empty tables, of either side, lose nothing."""
    found = joinable(leaks(docs, items).select(F.col("doc_id").alias("leaked_doc_"), F.col("row_key").alias("leaked_")).distinct(), staging(docs.sparkSession))
    return docs.join(found, (row_key(docs) == F.col("leaked_")) & docs["doc_id"].eqNullSafe(F.col("leaked_doc_")), "left_anti")
