"""Benchmark decontamination by templates, with SQL functions only.

A text is cut into words; numbers, units after numbers and capitalised words
inside a sentence become typed placeholders. Windows of WINDOW template words of
the documents are hash-joined to those of the benchmark items; shorter items are
one window of their own length. A document holds an item if the windows found
cover COVER of the item and its slots agree: along one alignment, equal values of
the item stand against equal values of the document. Each alignment that reaches
COVER by its own windows is checked, and one of them is enough.
So a question with other numbers or names is caught, and one whose numbers do
not fit together is not. An item with fewer than LEAST_PLAIN words that are no
placeholders, as `42` or `3 km`, says nothing as a template; it is compared word
by word, its case aside.

A window can only match if each of its words occurs in the benchmark. A filter of
FILTER_BITS bits over the benchmark's words tells the runs of such words in a
document; only their windows are hashed. What passes by mistake finds no partner.
Of the hashes of a window only those go on that a second filter, over the hashes of
the benchmark's windows, lets pass.

A capitalised word that starts a sentence, a line or a quotation may be a name or
not. Windows of items and documents are hashed in all readings of such words. Two
that differ are a slot, unless that contradicts another slot: then they are
different words, and the windows that hold them do not count.

Missing texts count as empty and hold nothing; items without words are in no
document; missing ids are ids of their own; equal rows give one result row; an
empty table on either side gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import guarded, literal, restored, stored, texts_of

WINDOW, COVER = 8, 0.5
LEAST_PLAIN = 3
FILTER_BITS = 1 << 18
NUMBER, UNIT, NAME = "0", "0u", "0n"
MAYBE = NAME + "_"  # before a word that may be a name
UNITS = (
    "mm|cm|dm|m|km|in|ft|yd|mi|miles?|meters?|metres?|inch|inches|feet|mg|g|kg|t|lb|lbs|oz|pounds?|grams?|kilograms?|tons?|"
    "ms|s|sec|secs|seconds?|min|mins|minutes?|h|hr|hrs|hours?|days?|weeks?|months?|years?|ml|cl|l|litres?|liters?|"
    "percent|dollars?|euros?|cents?|usd|eur|gbp|w|kw|v|hz|khz|mhz|ghz|b|kb|mb|gb|tb|degrees?|kmh|mph"
)


def values(text: Column) -> Column:
    """Text whose words are runs of letters, digits and '_'; separators inside numbers become '_'."""
    return F.regexp_replace(text, r"(?<=[0-9])[.,:](?=[0-9])", "_")


def template(text: Column) -> Column:
    """The same words in lower case, with placeholders and marks before possible names; words stay in their places."""
    sure = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;:]\s)\p{Lu}\p{Ll}+(?![\p{L}\p{N}_])", NAME)
    named = F.regexp_replace(sure, r"(?<![\p{L}\p{N}_])(?<![0-9]-)(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}_])", f"{MAYBE}$1")
    numbered = F.regexp_replace(named, r"(?<![\p{L}\p{N}_])[0-9]++(?:_[0-9]++)*+(?![n0-9])", NUMBER)
    measured = F.regexp_replace(numbered, rf"(?i)(?<![\p{{L}}\p{{N}}_])(0[ -]?)(?:{UNITS})(?![\p{{L}}\p{{N}}_])", f"$1{UNIT}")
    return F.lower(F.when(text.rlike("[0-9]"), measured).otherwise(named))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[^\p{L}\p{N}_]+"), "")


def plain(word: Column) -> Column:
    return F.when(word.startswith(MAYBE), F.substring(word, len(MAYBE) + 1, 1 << 30)).otherwise(word)


def masked(word: Column) -> Column:
    return F.when(word.startswith(MAYBE), F.lit(NAME)).otherwise(word)


def xor(numbers: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), numbers)


def readings(word: list[Column], name: list[Column]) -> Column:
    """Hashes of a window in all readings: one, or two for each word whose hash as a name is not 0."""
    as_words = [F.xxhash64(w, F.lit(i)) for i, w in enumerate(word)]
    turns = [F.when(n != 0, F.xxhash64(n, F.lit(i)).bitwiseXOR(w)).otherwise(F.lit(0).cast("bigint")) for i, (n, w) in enumerate(zip(name, as_words, strict=True))]
    one = sum(((n != 0).cast("int") for n in name), F.lit(0))
    whole = F.array(xor(as_words))
    every = F.aggregate(
        F.filter(F.array(*turns), lambda t: t != 0), whole, lambda acc, t: F.concat(acc, F.transform(acc, lambda h: h.bitwiseXOR(t)))
    )
    return F.when(one == 0, whole).when(one == 1, F.array(xor(as_words), xor(as_words + turns))).otherwise(every)


def windows(rows: DataFrame, keys: list[str], size: int, held: list[int] | None = None) -> DataFrame:
    """keys, at, window: the hashes of every `size` words in a row of the array column words, only those in the filter if there is one."""
    n = F.greatest(F.size("words") - (size - 1), F.lit(0))
    rows = rows.select(
        *keys, n.alias("n"), F.transform("words", lambda w: F.xxhash64(plain(w))).alias("p"),
        F.transform("words", lambda w: F.when(w.startswith(MAYBE), F.xxhash64(F.lit(NAME))).otherwise(F.lit(0).cast("bigint"))).alias("m"),
    )
    shifted = F.arrays_zip(*[F.slice(c, i + 1, F.col("n")).alias(f"{c}{i}") for c in ("p", "m") for i in range(size)])
    each = rows.select(*keys, F.posexplode(shifted).alias("at", "w"))
    hashes = readings([F.col(f"w.p{i}") for i in range(size)], [F.col(f"w.m{i}") for i in range(size)])
    if held is not None:
        array = literal(held)
        hashes = F.filter(hashes, lambda h: reduce(lambda a, b: a & b, [known(array, place) for place in places(h)]))
    return each.select(*keys, "at", F.explode(hashes).alias("window"))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, verbatim, words, vals (words before they became placeholders), size (words of a window), n_windows."""
    text = values(F.coalesce("text", F.lit("")))
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text.alias("v")).distinct()
    rows = rows.select("item_id", words(template(F.col("v"))).alias("words"), words(F.col("v")).alias("vals")).filter(F.size("words") > 0)
    is_plain = lambda w: ~w.isin(NUMBER, UNIT, NAME) & ~w.startswith(MAYBE)
    rows = rows.withColumn("verbatim", F.size(F.filter("words", is_plain)) < LEAST_PLAIN)
    rows = rows.withColumn("words", F.when(F.col("verbatim"), F.transform("vals", F.lower)).otherwise(F.col("words")))
    rows = rows.withColumn("size", F.least(F.size("words"), F.lit(WINDOW)))
    return rows.withColumn("n_windows", F.size("words") - F.col("size") + 1)


def bit(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(FILTER_BITS - 1))


def places(window: Column) -> list[Column]:
    """Three bits of the filter for the hash of a window, from parts of it that do not overlap."""
    width = FILTER_BITS.bit_length() - 1
    return [F.shiftrightunsigned(window, i * width).bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int") for i in range(3)]


def known(array: Column, number: Column) -> Column:
    return F.bit_get(F.get(array, F.shiftright(number, 6)), number.bitwiseAND(F.lit(63))) == 1


def filter_of(bits: DataFrame) -> list[int]:
    """The filter with the bits of the column bit as numbers of 64 bits; of fixed size, whatever the number of rows."""
    mask = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    held = dict(bits.distinct().groupBy(F.expr("cast(bit div 64 as int)").alias("at")).agg(F.bit_or(mask)).collect())
    return [held.get(i, 0) for i in range(FILTER_BITS // 64)]


def word_filter(items: DataFrame) -> list[int]:
    word = items.select(F.explode("words").alias("w"))
    return filter_of(word.select(F.explode(F.array(bit(plain(F.col("w"))), bit(masked(F.col("w"))))).alias("bit")))


def window_filter(wanted: DataFrame) -> list[int]:
    return filter_of(wanted.select(F.explode(F.array(*places(F.col("window")))).alias("bit")))


def runs_of(texts: DataFrame, keys: list[str], items: DataFrame) -> DataFrame:
    """keys, start, words: runs of words that all occur in the items, of the least window's length or longer."""
    array = literal(word_filter(items))
    least = items.agg(F.min("size")).first()[0]
    # each word is hashed once; -1 stands for a possible name, which any name of the items may match
    rows = texts.withColumn("name_known", known(array, bit(F.lit(NAME)).cast("int")))
    number = lambda w: F.when(w.startswith(MAYBE) & F.col("name_known"), F.lit(-1)).otherwise(bit(plain(w)).cast("int"))
    flag = lambda n: F.when(n < 0, "1").when(known(array, n), "1").otherwise("0")
    rows = rows.withColumn("numbers", F.transform("words", number))
    rows = rows.withColumn("flags", F.array_join(F.transform("numbers", flag), "")).filter(F.col("flags").contains("1" * least))
    runs = F.array().cast("array<struct<start:int,n:int>>")
    found = F.aggregate(
        F.transform(F.split("flags", "0"), F.length),
        F.struct(F.lit(0).alias("at"), runs.alias("runs")),
        lambda acc, n: F.struct(
            (acc["at"] + n + 1).alias("at"),
            F.when(n >= least, F.concat(acc["runs"], F.array(F.struct(acc["at"].alias("start"), n.alias("n"))))).otherwise(acc["runs"]).alias("runs"),
        ),
        lambda acc: acc["runs"],
    )
    rows = rows.select(*keys, "words", F.explode(found).alias("run"))
    return rows.select(*keys, F.col("run.start").alias("start"), F.slice("words", F.col("run.start") + 1, F.col("run.n")).alias("words"))


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, h, item_id, at (window of the item), shift (place in the document less place in the item)."""
    texts = texts_of(docs).select("doc_id", F.xxhash64("text").alias("h"), values(F.col("text")).alias("v"))
    sizes = items.select("verbatim", "size").distinct().collect()  # at most 2 * WINDOW rows
    found = None
    for verbatim in sorted({r["verbatim"] for r in sizes}):
        own = items.filter(F.col("verbatim") == verbatim)
        body = words(F.lower("v")) if verbatim else words(template(F.col("v")))
        runs = stored(runs_of(texts.select("doc_id", "h", body.alias("words")), ["doc_id", "h"], own), "template-runs")
        for size in sorted(r["size"] for r in sizes if r["verbatim"] == verbatim):
            wanted = windows(own.filter(F.col("size") == size), ["item_id"], size).distinct()
            wanted = stored(wanted, "template-windows").select("item_id", F.col("at").alias("item_at"), "window")
            # Spark broadcasts the benchmark's windows if they are small and shuffles both sides otherwise.
            here = windows(runs, ["doc_id", "h", "start"], size, window_filter(wanted)).join(wanted, "window")
            shift = F.col("start") + F.col("at") - F.col("item_at")
            here = here.select("doc_id", "h", "item_id", F.col("item_at").alias("at"), shift.alias("shift"))
            found = here if found is None else found.union(here)
    return found


def ways(runs: Column, n_windows: Column, cover: float) -> Column:
    """shift, at (windows found along it), more (windows found along others) of the alignments to be checked.

    These are all that reach the cover by their own windows, and, for copies with
    insertions, the one with most windows together with those of others.
    """
    top = F.array_max(F.transform(runs, lambda r: F.struct(F.size(r["at"]).alias("n"), (-r["shift"]).alias("back"))))
    others = F.array_distinct(F.flatten(F.filter(runs, lambda r: r["shift"] != -top["back"])["at"]))
    most = F.transform(
        F.filter(runs, lambda r: r["shift"] == -top["back"]),
        lambda r: F.struct(r["shift"].alias("shift"), r["at"].alias("at"), others.alias("more")),
    )
    alone = F.transform(
        F.filter(runs, lambda r: F.size(r["at"]) / n_windows >= cover),
        lambda r: F.struct(r["shift"].alias("shift"), r["at"].alias("at"), F.array().cast("array<int>").alias("more")),
    )
    return F.concat(alone, F.when((F.size(alone) > 0) & (F.size(others) == 0), F.slice(most, 1, 0)).otherwise(most))


def with_slots(way: Column) -> Column:
    """The alignment with its slots: place, values on both sides, sure (both are placeholders)."""

    def slot(i: Column) -> Column:
        item, doc = F.get("iw", i), F.get("dw", i + way["shift"])
        same = plain(item).eqNullSafe(plain(doc))
        name = F.coalesce(item.startswith(NAME) & (masked(item) == NAME) & (masked(doc) == NAME), F.lit(False))
        return F.struct(
            i.alias("place"), F.lower(F.get("iv", i)).alias("item"), F.lower(F.get("dv", i + way["shift"])).alias("doc"),
            same.alias("sure"), ((same & item.startswith(NUMBER) & ~item.startswith(MAYBE)) | (name & ~same)).alias("is_slot"),
        )

    slots = F.filter(F.transform(F.sequence(F.lit(0), F.size("iw") - 1), slot), lambda s: s["is_slot"])
    return F.struct(way["shift"].alias("shift"), way["at"].alias("at"), way["more"].alias("more"), slots.alias("slots"))


def with_broken(way: Column) -> Column:
    """The alignment with the places whose words are no names after all, as another slot contradicts."""
    pairs = F.array_distinct(F.transform(way["slots"], lambda s: F.struct(s["item"].alias("item"), s["doc"].alias("doc"))))
    once = F.size(pairs) == F.size(F.array_distinct(pairs["item"]))
    against = F.filter(
        way["slots"],
        lambda s: ~s["sure"] & F.exists(pairs, lambda p: (p["item"] == s["item"]) & (p["doc"] != s["doc"])),
    )
    broken = F.when(once, F.array().cast("array<int>")).otherwise(against["place"])
    return F.struct(
        way["shift"].alias("shift"), way["at"].alias("at"), way["more"].alias("more"), way["slots"].alias("slots"), broken.alias("broken")
    )


def judged(way: Column, cover: float) -> Column:
    """Result columns of the alignment, in the order in which alignments are preferred."""
    broken = way["broken"]
    whole = F.filter(way["at"], lambda a: ~F.exists(broken, lambda i: (i >= a) & (i < a + F.col("size"))))
    found = F.size(F.array_union(whole, way["more"]))
    slots = F.filter(way["slots"], lambda s: ~F.array_contains(broken, s["place"]))
    pairs = F.array_distinct(F.transform(slots, lambda s: F.struct(s["item"].alias("item"), s["doc"].alias("doc"))))
    consistent = F.size(pairs) == F.size(F.array_distinct(pairs["item"]))
    coverage = found / F.col("n_windows")
    return F.struct(
        (consistent & (coverage >= cover)).alias("leaked"), (F.size(way["more"]) == 0).alias("alone"), found.alias("windows"), (-way["shift"]).alias("back"),
        coverage.alias("coverage"), F.size(slots).alias("n_slots"),
        F.size(F.filter(slots, lambda s: s["item"] != s["doc"])).alias("n_changed"), consistent.alias("consistent"),
    )


def contaminations(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """doc_id, h, item_id, windows, coverage, n_slots, n_changed, consistent, leaked: items found in documents."""
    items = stored(items_of(benchmark), "template-items")
    found = hits(docs, items)
    if found is None:
        nothing = texts_of(docs).limit(0).withColumn("h", F.xxhash64("text"))
        return nothing.select(
            "doc_id", "h", F.lit(0).cast("bigint").alias("item_id"), F.lit(0).alias("windows"), F.lit(0.0).alias("coverage"),
            F.lit(0).alias("n_slots"), F.lit(0).alias("n_changed"), F.lit(True).alias("consistent"), F.lit(True).alias("leaked"),
        )
    per_shift = found.groupBy("doc_id", "h", "item_id", "shift").agg(F.collect_set("at").alias("at"))  # windows of one item
    runs = F.sort_array(F.collect_list(F.struct("shift", "at")))  # at most as many as the document has windows
    pairs = per_shift.groupBy("doc_id", "h", "item_id").agg(runs.alias("runs"))
    items = items.select(F.col("item_id").alias("i"), F.col("words").alias("iw"), F.col("vals").alias("iv"), "size", "n_windows")
    pairs = pairs.join(items, F.col("item_id").eqNullSafe(F.col("i")))
    union = F.size(F.array_distinct(F.flatten("runs.at")))
    pairs = pairs.filter(union / F.col("n_windows") >= cover)
    pairs = pairs.withColumn("ways", ways(F.col("runs"), F.col("n_windows"), cover))
    pairs = stored(pairs.select("doc_id", "h", "item_id", "ways"), "template-pairs")

    # two numbers a row, so that Spark broadcasts it unless a great many documents hold items
    held = stored(pairs.select(F.col("doc_id").alias("d"), F.col("h").alias("dh")).distinct(), "template-held")
    texts = texts_of(docs).withColumn("h", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh"))
    texts = texts.join(held, same, "left_semi").dropDuplicates(["doc_id", "h"])
    texts = texts.withColumn("v", values(F.col("text"))).select(
        F.col("doc_id").alias("d"), F.col("h").alias("dh"), words(template(F.col("v"))).alias("dw"), words(F.col("v")).alias("dv")
    )
    joined = pairs.join(texts, same).join(items, F.col("item_id").eqNullSafe(F.col("i")))
    joined = joined.withColumn("ways", F.transform("ways", with_slots)).withColumn("ways", F.transform("ways", with_broken))
    best = F.array_max(F.transform("ways", lambda w: judged(w, cover)))  # a leak if there is one, then alone, then most windows
    return joined.withColumn("best", best).select(
        "doc_id", "h", "item_id", "best.windows", "best.coverage", "best.n_slots", "best.n_changed", "best.consistent", "best.leaked"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """The documents that hold no item, with their own columns."""
    leaked = contaminations(docs, benchmark, cover).filter("leaked")
    leaked = stored(leaked.select(F.col("doc_id").alias("d"), F.col("h").alias("dh")).distinct(), "leaked")
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("d")) & (F.col("leak_hash") == F.col("dh"))
    return restored(guarded(docs).withColumn("leak_hash", h).join(leaked, same, "left_anti"), docs)
