"""SimHash fingerprints of documents with SQL functions only, and search by permuted block tables.

Terms are pairs of neighbouring lower-case words, weighted by their length.
Each term's 64-bit hash votes with its weight for its set bits and against the
others. Sixteen running sums hold four 16-bit counters each; after PIECE terms
the counters are unpacked, so they never overflow, however long the text is.

Missing texts count as empty; a text without words has fingerprint zero.
Missing ids come first in the order of documents. Repeated rows are rows of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.tables import bounds, bucket_of, literal, order_key, stored, texts_of

LANES = 0x0001000100010001
TOP_WEIGHT = 15
PIECE = 2048  # PIECE * TOP_WEIGHT stays below 2**15
BLOCKS, RADIUS = 5, 3


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def votes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with the fingerprint of its column words; keys tell rows apart.

    A term is a word and the one after it; the last word stands alone.
    """
    pairs = F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("b"))
    exploded = rows.select(*keys, F.posexplode_outer(pairs).alias("at", "pair"))
    exploded = exploded.select(*keys, "at", F.concat_ws(" ", "pair.a", "pair.b").alias("term"))
    h, weight = F.xxhash64("term"), F.coalesce(F.least(F.char_length("term"), F.lit(TOP_WEIGHT)), F.lit(0)).cast("bigint")
    weighed = exploded.select(*keys, F.floor(F.col("at") / PIECE).alias("piece"), h.alias("h"), weight.alias("weight"))
    lanes = [
        F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(LANES)) * F.col("weight")).alias(f"lane{k}")
        for k in range(16)
    ]
    packed = weighed.groupBy(*keys, "piece").agg(F.sum("weight").alias("weight"), *lanes)
    counts = [
        F.sum(F.shiftrightunsigned(f"lane{b % 16}", b // 16 * 16).bitwiseAND(F.lit(0xFFFF))).alias(f"bit{b}")
        for b in range(64)
    ]
    bits = packed.groupBy(*keys).agg(F.sum("weight").alias("weight"), *counts)
    word = F.lit(0).cast("bigint")
    for b in range(64):
        set_bit = F.lit(-(2**63) if b == 63 else 1 << b).cast("bigint")
        word = word.bitwiseOR(F.when(2 * F.col(f"bit{b}") > F.col("weight"), set_bit).otherwise(F.lit(0).cast("bigint")))
    return bits.select(*keys, word.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return (F.lit(64) - F.bit_count(a.bitwiseXOR(b))) / F.lit(64.0)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def with_next(docs: DataFrame, per_bucket: int = 2000) -> DataFrame:
    """Each document with the text of the next one by id; after the last comes the first.

    Ids are cut into ranges. The first document of each range is also sent to
    the range before it (border = 1), so every range holds all it needs.
    """
    rows = texts_of(docs).withColumn("k", order_key())
    ids = docs.select("doc_id")
    cuts = bounds(ids, order_key(), per_bucket)
    firsts = {
        r["bucket"]: r["k"]  # one row for each range
        for r in ids.select(order_key().alias("k"), bucket_of(order_key(), cuts).alias("bucket"))
        .groupBy("bucket").agg(F.min("k").alias("k")).collect()
    }
    held = sorted(firsts)
    previous = [held[held.index(b) - 1] if b in firsts else 0 for b in range(len(cuts) + 1)]
    own = F.struct(F.col("bucket").cast("bigint").alias("bucket"), F.lit(0).alias("border"))
    earlier = F.struct(F.get(literal(previous), F.col("bucket")).alias("bucket"), F.lit(1).alias("border"))
    is_first = F.array_contains(literal([]), F.lit(0).cast("bigint")) if not held else F.col("k").isin(*firsts.values())
    rows = rows.withColumn("bucket", bucket_of(F.col("k"), cuts)).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("place", F.explode(F.when(is_first, F.array(own, earlier)).otherwise(F.array(own))))
    rows = rows.select("doc_id", "k", "h", "text", "place.bucket", "place.border")
    order = Window.partitionBy("bucket").orderBy("border", "k", "h")
    return rows.withColumn("rn", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp: fingerprints of each text, edited text and next text."""
    n = F.char_length("text").cast("bigint")
    swapped = F.floor(n / 4).cast("int")
    rows = with_next(docs).select(
        "doc_id", "bucket", "rn", "border", "text", n.alias("n_chars"),
        F.concat(F.substring("text", 1, n.cast("int") - swapped), F.substring("next_text", 1, swapped)).alias("edited"),
    )
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    about = F.struct("doc_id", "border", "n_chars", "edited_sha256").alias("about")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), words(F.col("text")).alias("words")),
        F.struct(F.lit(1).alias("side"), words(F.col("edited")).alias("words")),
    )
    rows = rows.select("bucket", "rn", about, F.explode(sides).alias("one")).select("bucket", "rn", "about", "one.side", "one.words")
    both = votes(rows, ["bucket", "rn", "about", "side"])
    order = Window.partitionBy("bucket").orderBy("rn")
    one = both.groupBy("bucket", "rn", "about").agg(
        F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fp")
    )
    return (
        one.withColumn("next_fp", F.lead("fp").over(order))
        .filter(F.col("about.border") == 0)
        .select("about.doc_id", "about.n_chars", "about.edited_sha256", "fp", "edited_fp", "next_fp")
    )


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Masks of the tables: any fingerprints within the radius agree on blocks - radius whole blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(masks, blocks - radius)]


def within(fps: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (query, found, bits) of distinct fingerprints at most radius bits apart; both inputs have a column fp.

    Every table keys the fingerprints by the bits under its mask, which stands
    for a permutation that moves those blocks to the front. A pair is reported
    by the first table on which it agrees.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(blocks, radius)]
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).cast("bigint").alias("mask")) for t, m in enumerate(masks)])

    def keyed(df: DataFrame, name: str) -> DataFrame:
        each = df.select("fp").distinct().select(F.col("fp").alias(name), F.explode(tables).alias("m"))
        return each.select(name, F.col("m.t").alias("t"), F.col(name).bitwiseAND(F.col("m.mask")).alias("key"))

    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.lit(len(masks))
    for t, mask in reversed(list(enumerate(masks))):
        first = F.when(differ.bitwiseAND(F.lit(mask).cast("bigint")) == 0, F.lit(t)).otherwise(first)
    asked, held = keyed(queries, "query").alias("a"), keyed(fps, "found").alias("b")
    on = (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key"))
    pairs = asked.join(held, on & (F.bit_count(differ) <= radius) & (first == F.col("a.t")))
    return pairs.select("query", "found", F.bit_count(differ).alias("bits"))


def with_neighbours(found: DataFrame, every: int = 100, radius: int = RADIUS) -> DataFrame:
    """Add n_within: for ids divisible by `every`, how many other documents lie within the radius; else null."""
    asked = F.col("doc_id") % every == 0
    weights = found.groupBy("fp").agg(F.count(F.lit(1)).alias("copies"))
    pairs = within(weights, found.filter(asked), radius)
    counts = pairs.join(weights, pairs["found"] == weights["fp"]).groupBy("query").agg((F.sum("copies") - 1).alias("n_within"))
    queries = found.filter(asked).join(counts, F.col("fp") == F.col("query"), "left").drop("query")
    rest = found.filter(~F.coalesce(asked, F.lit(False))).withColumn("n_within", F.lit(None).cast("bigint"))
    return queries.unionByName(rest)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints, their likenesses, and neighbours of the query documents."""
    found = stored(fingerprints(docs), "fingerprints")
    return with_neighbours(found)
