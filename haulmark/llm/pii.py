"""Personal data: fixed patterns, and identifiers found by bootstrapping from their contexts.

Base entities (email, ip, card, phone) are found by pattern. They seed the
bootstrapping on a graph of lexical patterns and the words in their slots. A
pattern is the two words or the one word before a slot, or the one after it;
the edges of a text count as words. Round by round, a pattern is scored by the
share of known instances among all its occurrences in the corpus, and a word in
the slot of a trusted pattern by the share of its own occurrences that lie in
such slots. Any word can become known, whatever its letters; its contexts then
count for further patterns. What is known in the end is reported as kind "id",
wherever it occurs. Patterns are named by 64-bit hashes; the name of a seed is
its text without the first character.

The words of the texts are never all shuffled. What is counted over the corpus, a
pattern or a word, must reach a share: it is counted in growing parts of the texts,
and what occurs too often for its hits is left out of the next part. Of the words
and patterns of a text only those become rows that a filter of FILTER numbers over
the wanted ones lets pass. What a round has found or refuted is not counted again.

SQL functions only. Positions are code points, ends are exclusive. Missing
texts count as empty and have no spans; missing ids stay missing; repeated rows
each get their spans; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import guarded, restored, stored, texts_of

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"

# The published patterns, with possessive quantifiers and looks to both sides, so that long runs take linear time.
# A match starts where a run starts or where the last match ended, and a run is taken whole: the matches are the same.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]"}
NUMBERS = r"[0-9](?:\.[0-9]|(?:[ -]?[0-9]){11})"  # the hints of ip and card in one
EDGES = ".,;:!?()[]{}<>\"'"  # not part of an instance where they begin or end a word
OCTET = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"

MARK = "\ue000"  # first character of a base entity in masked texts
BLANKS = rf"[\t\n\x0B\f\r{MARK}]"  # become single blanks in masked texts
SUPPORT, TRUST, ROUNDS = 3, 0.5, 3
PART, PARTS = 16, (1, 4, 16)  # so many PART-ths of the texts are counted after each step
FILTER = 1 << 15  # numbers of 64 bits
BLOCK = 1024

SPAN = "struct<start:bigint,end:bigint,value:string>"
Rows = Callable[[DataFrame, DataFrame], DataFrame]


def matches(text: Column, pattern: str, hint: Column) -> Column:
    """All matches with their places, from the lengths of the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("value"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["piece"])
        end = start + F.char_length(x["value"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    walked = F.aggregate(
        F.filter(steps, lambda x: x["value"].isNotNull()),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
        step,
        lambda acc: acc["out"],
    )
    return F.when(hint, walked).otherwise(F.array().cast(f"array<{SPAN}>"))


def luhn(value: Column) -> Column:
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(OCTET))
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, kind_no, end, value), by start and then kind."""

    def of(kind: str) -> Column:
        hint = {"email": text.contains("@"), "phone": text.contains("+") & text.rlike(HINTS["phone"])}.get(kind, text.rlike(HINTS[kind]))
        held = F.filter(matches(text, PATTERNS[kind], hint), lambda s: valid(kind, s["value"]))
        no = F.lit(KINDS.index(kind)).alias("kind_no")
        return F.transform(held, lambda s: F.struct(s["start"].alias("start"), no, s["end"].alias("end"), s["value"].alias("value")))

    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,value:string>>")
    numbers = F.when(text.rlike(NUMBERS), F.concat(of("ip"), of("card"))).otherwise(none)
    return F.array_sort(F.concat(of("email"), numbers, of("phone")))


def of_kind(places: str, no: int) -> Column:
    return F.filter(places, lambda s: s["kind_no"] == no)


def masked(text: Column, base: Column) -> Column:
    """The text with MARK as first character of each base span and no blanks inside; places stay as they are, all white space is blanks."""
    text = F.regexp_replace(text, BLANKS, " ")

    def part(start: Column, end: Column) -> Column:
        return F.substring(text, (start + 1).cast("int"), F.greatest(end - start, F.lit(0).cast("bigint")).cast("int"))

    def cut(acc: Column, s: Column) -> Column:
        at = F.greatest(s["start"], acc["at"])
        body = F.translate(part(at, s["end"]), " ", "_")
        body = F.when(s["start"] >= acc["at"], F.concat(F.lit(MARK), F.substring(body, F.lit(2), F.char_length(body)))).otherwise(body)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(part(acc["at"], s["start"]), body)).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(base, start, cut, lambda acc: F.concat(F.array_join(acc["out"], ""), part(acc["at"], F.char_length(text).cast("bigint"))))
    return F.when(F.size(base) == 0, text).otherwise(whole)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), places of the base spans, masked text."""
    rows = docs.withColumn("h", F.xxhash64("text")).withColumn("base", base_spans(F.col("text")))
    places = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end")))
    return rows.select("doc_id", "h", places.alias("base"), masked(F.col("text"), F.col("base")).alias("masked"))


def trimmed(word: Column) -> Column:
    at_edge = [F.lit(EDGES).contains(F.substring(word, i, 1)) for i in (1, -1)]  # trimming is slow, and few words need it
    return F.when(at_edge[0] | at_edge[1], F.btrim(word, F.lit(EDGES))).otherwise(word)


def instance(word: Column) -> Column:
    return trimmed(F.lower(word))


def words(scan: DataFrame) -> Column:
    return F.array_remove(F.split(F.lower("masked"), " "), "")


def slots(scan: DataFrame) -> DataFrame:
    """word, far, left, right: each word of the texts in lower case, and the hashes of the words two and one before it and of the one after it."""
    rows = scan.select(words(scan).alias("w"), F.col("masked").contains(MARK).alias("marked"))
    hidden = F.transform("w", lambda x: F.xxhash64(F.when(x.contains(MARK), F.lit(MARK)).otherwise(x)))
    rows = rows.select("w", F.when(F.col("marked"), hidden).otherwise(F.transform("w", lambda x: F.xxhash64(x))).alias("c"))
    edge = F.array(F.xxhash64(F.lit("^")))
    near = {"word": F.col("w"), "far": F.concat(edge, edge, "c"), "left": F.concat(edge, "c"), "right": F.slice("c", 2, F.size("c"))}
    rows = rows.select(F.explode(F.arrays_zip(*[c.alias(name) for name, c in near.items()])).alias("s")).filter(F.col("s.word").isNotNull())
    return rows.select("s.word", "s.far", "s.left", F.coalesce("s.right", F.xxhash64(F.lit("$"))).alias("right"))


def each_pattern(slot_rows: DataFrame, *columns: str) -> DataFrame:
    """The columns given, kind, pattern: a row for each pattern of a slot (two words before, one before, one after)."""
    hashes = F.array(F.xxhash64(F.lit(2), "far", "left"), F.xxhash64(F.lit(1), "left"), F.xxhash64(F.lit(0), "right"))
    return slot_rows.select(*columns, F.posexplode(hashes).alias("kind", "pattern"))


def edges_of(slot_rows: DataFrame) -> DataFrame:
    """pattern, kind, value, n: how often each value stands in each pattern."""
    return each_pattern(slot_rows, "value").groupBy("pattern", "kind", "value").agg(F.count(F.lit(1)).alias("n"))


def sieve(keys: DataFrame) -> Callable[[Column], Column]:
    """Whether a hash may be one of those in the only column; from a filter of fixed size, with three bits of one number for each hash."""
    one = F.lit(1).cast("bigint")

    def at(key: Column) -> Column:
        return key.bitwiseAND(F.lit(FILTER - 1)).cast("int")

    def bits(key: Column) -> Column:
        parts = [F.shiftrightunsigned(key, i).bitwiseAND(F.lit(63)).cast("int") for i in (32, 40, 48)]
        return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", one, part) for part in parts])

    key = F.col(keys.columns[0])
    held = dict(keys.select(at(key).alias("at"), bits(key).alias("bits")).groupBy("at").agg(F.bit_or("bits")).collect())
    array = F.split(F.lit(",".join(str(held.get(i, 0)) for i in range(FILTER))), ",").cast("array<bigint>")
    return lambda key: F.get(array, at(key)).bitwiseAND(bits(key)) == bits(key)


def of_values(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of the rows with other values than the wanted ones only what the filter lets pass."""
    passes = sieve(wanted.select(F.xxhash64("value")))
    # What a generator makes is computed once; the filter would compute another column for each of its uses.
    return rows.select("*", F.explode(F.array(F.xxhash64("value"))).alias("named")).filter(passes(F.col("named"))).drop("named")


def pattern_rows(scan: DataFrame, wanted: DataFrame) -> DataFrame:
    """pattern, kind, word: the slots of patterns, of others than the wanted ones only what the filter lets pass."""
    passes = sieve(wanted.select("pattern"))
    return each_pattern(slots(scan), "word").filter(passes(F.col("pattern")))


def value_rows(scan: DataFrame, wanted: DataFrame) -> DataFrame:
    """value, doc_id, h: the words of all texts as instances, of others than the wanted ones only what the filter lets pass."""
    rows = scan.select("doc_id", "h", F.explode(words(scan)).alias("word"))
    return of_values(rows.select(trimmed(F.col("word")).alias("value"), "doc_id", "h"), wanted)


def texts_with(scan: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of the rows (doc_id, h), and the few others that a filter of fixed size lets pass."""
    passes = sieve(rows.select(F.xxhash64("doc_id", "h")))
    return scan.select("*", F.explode(F.array(F.xxhash64("doc_id", "h"))).alias("named")).filter(passes(F.col("named"))).drop("named")


def counted(scan: DataFrame, wanted: DataFrame, rows_of: Rows, trust: float) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Those of the wanted (key, hits) whose share of hits in all their rows reaches the trust; the others with what was counted; all rows of the first.

    What occurs too often for its hits in a part of the texts can never reach the
    trust, so only the rest is counted in the other texts. The last step meets a few
    rows for each hit only and keeps them.
    """
    key, part = wanted.columns[0], F.pmod("h", F.lit(PART))
    left = stored(wanted.select(key, "hits", F.lit(0).cast("bigint").alias("total")), f"pii-{key}-wanted")
    refuted, rows = left.limit(0), None
    for start, end in zip((0, *PARTS), PARTS, strict=False):
        if left.isEmpty():
            break
        rows = rows_of(scan.filter((part >= start) & (part < end)), left)
        if end == PART:
            rows = stored(rows.join(left.select(key), key, "left_semi"), f"pii-{key}-rows")
        more = rows.groupBy(key).agg(F.count(F.lit(1)).alias("more"))
        total = (F.col("total") + F.coalesce("more", F.lit(0))).alias("total")
        seen = stored(left.join(more, key, "left").select(key, "hits", total), f"pii-{key}-counted")
        reaches = F.col("hits") >= trust * F.col("total")
        left, refuted = seen.filter(reaches), refuted.union(seen.filter(~reaches))
    held, refuted = left.select(key), refuted.select(key, "total")
    if held.isEmpty():
        return held, refuted, None
    before = stored(rows_of(scan.filter(part < start), left).join(held, key, "left_semi"), f"pii-{key}-rows")
    return held, refuted, rows.join(held, key, "left_semi").union(before)


def joint(one: DataFrame | None, other: DataFrame) -> DataFrame:
    return other if one is None else one.union(other)


def open_ones(wanted: DataFrame, found: DataFrame, refuted: DataFrame, trust: float) -> DataFrame:
    """The wanted (key, hits) that are not found yet and that the totals counted so far do not refute."""
    key = wanted.columns[0]
    least = refuted.groupBy(key).agg(F.max("total").alias("least"))
    rows = wanted.join(found, key, "left_anti").join(least, key, "left")
    return rows.filter(F.col("least").isNull() | (F.col("hits") >= trust * F.col("least"))).select(key, "hits")


def bootstrap(scan: DataFrame, support: int, trust: float, rounds: int) -> DataFrame | None:
    """value, doc_id, h: the values that trusted patterns have made known, other than the seeds, and their texts; None if there are none."""
    marked = slots(scan.filter(F.col("masked").contains(MARK))).filter(F.col("word").contains(MARK))
    edges = stored(edges_of(marked.withColumn("value", trimmed(F.col("word")))), "pii-seeds")
    trusted = inside = poor = known = common = None
    for _ in range(rounds):
        likely = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("support"), F.sum("n").alias("hits")).filter(F.col("support") >= support)
        likely = likely.select("pattern", "hits")
        new, refuted, rows = counted(scan, likely if trusted is None else open_ones(likely, trusted, poor, trust), pattern_rows, trust)
        if rows is None:
            break
        trusted, poor = joint(trusted, new), joint(poor, refuted)
        free = rows.select(trimmed(F.col("word")).alias("value"), "kind").filter((F.col("value") != "") & ~F.col("value").contains(MARK))
        inside = joint(inside, stored(free.groupBy("value", "kind").agg(F.count(F.lit(1)).alias("n")), "pii-inside"))
        hits = inside.groupBy("value", "kind").agg(F.sum("n").alias("n")).groupBy("value").agg(F.max("n").alias("hits"))
        reached, refuted, rows = counted(scan, hits if known is None else open_ones(hits, known.select("value"), common, trust), value_rows, trust)
        common = joint(common, refuted)
        if rows is None:
            break
        rows = rows.distinct()
        known = joint(known, rows)
        near = of_values(slots(texts_with(scan, rows)).withColumn("value", trimmed(F.col("word"))), reached)
        edges = edges.union(stored(edges_of(near.join(reached, "value", "left_semi")), "pii-graph"))
    return known


def starts(sizes: str) -> Column:
    """The places of pieces of these sizes that lie one blank apart; summed in blocks, so that long texts take linear time."""

    def step(acc: Column, size: Column) -> Column:
        return F.struct((acc["at"] + size + 1).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def block(acc: Column, first: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            F.slice(sizes, first + 1, BLOCK), start, step,
            lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out")),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(sizes) - 1, F.lit(BLOCK)), start, block, lambda x: F.flatten(x["out"]))


def located(scan: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, h, found: the places of known values, once for equal rows."""
    new = known.select("value").distinct()
    rows = texts_with(scan, known).select("doc_id", "h", F.split("masked", " ").alias("w"))
    rows = rows.select("doc_id", "h", "w", F.transform("w", lambda x: F.char_length(x).cast("bigint")).alias("sizes"))
    rows = rows.select("doc_id", "h", F.explode(F.arrays_zip(F.col("w").alias("word"), starts("sizes").alias("at"))).alias("s"))
    rows = rows.select("doc_id", "h", "s.word", "s.at", instance(F.col("s.word")).alias("value"))
    rows = of_values(rows, new).join(new, "value")
    at = F.col("at") + F.char_length("word") - F.char_length(F.ltrim("word", F.lit(EDGES)))
    size = F.char_length(F.btrim("word", F.lit(EDGES)))
    place = F.struct(at.alias("start"), F.lit(len(KINDS)).alias("kind_no"), (at + size).alias("end"))
    return rows.groupBy("doc_id", "h").agg(F.collect_set(place).alias("found"))


def spans(docs: DataFrame, support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, h, base and found spans: arrays of (start, kind_no, end); kind_no counts KINDS, then FOUND."""
    scan = stored(scanned(texts_of(docs)), "pii-scan")
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")
    known = bootstrap(scan, support, trust, rounds)
    if known is None:
        return scan.select("doc_id", "h", "base", none.alias("found"))
    found = located(scan, known).withColumnsRenamed({"doc_id": "found_id", "h": "found_h"})
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("h") == F.col("found_h"))
    return scan.join(found, same, "left").select("doc_id", "h", "base", F.array_sort(F.coalesce("found", none)).alias("found"))


def listed(places: Column) -> Column:
    """kind:start:end of each span, comma-joined, in the order of the array."""
    names = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])
    return F.array_join(F.transform(places, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """Documents with every span replaced by its kind in brackets; rows without spans stay as they are."""
    places = spans(docs).select("doc_id", "h", F.array_sort(F.concat("base", "found")).alias("places"))
    places = places.filter(F.size("places") > 0).dropDuplicates(["doc_id", "h"])
    rows = guarded(docs).withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    places = places.select(F.col("doc_id").alias("place_id"), F.col("h").alias("place_h"), "places")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("place_id")) & (F.col("h") == F.col("place_h"))
    text, names = F.col("text"), F.array(*[F.lit(k.upper()) for k in (*KINDS, FOUND)])

    def cut(acc: Column, s: Column) -> Column:
        gap = F.greatest(s["start"] - acc["at"], F.lit(0).cast("bigint"))
        piece = F.substring(text, (acc["at"] + 1).cast("int"), gap.cast("int"))
        mark = F.when(s["start"] >= acc["at"], F.concat(piece, F.lit("["), F.get(names, s["kind_no"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], mark).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "places", start, cut, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text)))
    )
    joined = rows.join(places, same, "left").withColumn("clean", F.when(F.col("places").isNull(), text).otherwise(clean))
    if "n_chars" in docs.columns:
        size = F.char_length("clean").cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.when(F.col("places").isNull(), F.col("n_chars")).otherwise(size))
    return restored(joined.withColumn("text", F.col("clean")), docs)
