"""Benchmark decontamination by SimHash windows and exact verification.

Texts and items are words, lower-cased, and their sets are five-word shingles
weighted by how often they occur; fewer than five words are one shingle. An
item that a document holds at the threshold has at least that share of its
shingles somewhere in the document, so only such pairs of document and item go
on. A document's windows for an item have the item's size and stand where a
shared shingle aligns the two, starts the window or ends it: any other window
can be moved to such a place without losing shared weight. Each window gets
a 64-bit SimHash. Six blocks of its bits index it under its item: fingerprints
within 23 bits of each other agree in one block up to three bits, so looking up
all values within three bits of the item's block finds every one of them. What
lies within the radius is verified by the exact weighted similarity. DataFrame
functions only; the benchmark's tables are broadcast behind a look at their
rows and bytes and joined by a shuffle beyond it.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, few, once, staged, text_column

#: words of a shingle, and the similarity of a hit in hundredths
SHINGLE, THRESHOLD = 5, 80
#: largest Hamming distance looked up: at the threshold itself 10 bits differ on average, 3 is the deviation
RADIUS = 23
#: (first bit, bits) of the blocks; RADIUS // len(BLOCKS) bits may differ in one
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))


def shingles(words: str) -> F.Column:
    """The shingle hashes of a column of words, in order."""
    return F.when(F.size(words) >= SHINGLE, F.transform(
        F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)), lambda i: F.xxhash64(F.array_join(F.slice(words, i, SHINGLE), " ")))
    ).when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<long>"))


def simhash(column: str) -> F.Column:
    """64-bit SimHash of an array of shingle hashes with repeats as weights:
    a bit is set where more than half of the weight has it."""
    votes = f"transform(sequence(0, 63), b -> aggregate({column}, 0, (n, x) -> n + cast(shiftright(x, b) & 1L AS int)))"
    return F.expr(f"aggregate(transform({votes}, (v, b) -> if(2 * v > size({column}), shiftleft(1L, b), 0L)), 0L, (h, x) -> h | x)")


def block_value(fingerprint: str, first: int, bits: int) -> str:
    return f"(shiftrightunsigned({fingerprint}, {first}) & {(1 << bits) - 1}L)"


def shared_weight(a: str, b: str) -> F.Column:
    """Weight that two arrays of shingles with repeats share."""
    return F.expr(f"aggregate(array_intersect({a}, {b}), 0, (n, x) -> n + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))")


def _words(text: F.Column) -> F.Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, text_hash, start, n_words, shared, total) of every
    window of ``docs`` (doc_id, text) that an item of ``benchmark`` (item_id,
    text) places and that is at or over the threshold with it; ``start`` counts
    words. A very long text is one row throughout: its windows are cut from it
    in the task that holds it.

    Null and empty texts and items match nothing; a null id is carried as
    null; fewer than five words match only the same whole sequence as one
    shingle; repeated rows give one set of hits; other columns are ignored; an
    empty table on either side gives no rows.
    """
    texts = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), text_column(benchmark).alias("text"))
    items = once(once(texts, "words", _words(F.col("text"))), "item", shingles("words")).filter(F.size("item") > 0)
    items = staged(items.select("item_id", F.size("words").alias("n_words"), "item", simhash("item").alias("item_hash"))
                   .withColumn("item_row", F.monotonically_increasing_id()), "leak-items")
    # the item's shingles are n_words - 4, or one
    anchors = items.select("item_row", F.size("item").alias("size"), F.posexplode("item").alias("at", "shingle"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    read = once(once(rows, "words", _words(F.col("text"))), "sh", shingles("words"))
    met = read.select("doc_id", "text_hash", F.size("sh").alias("n"), F.posexplode("sh").alias("pos", "shingle"))
    aligned = staged(met.join(few(staged(anchors, "leak-anchors")), "shingle").drop("shingle"), "leak-aligned")
    pair = ["doc_id", "text_hash", "item_row"]
    held = aligned.select(*pair, "size", "at").distinct().groupBy(*pair, "size").count().filter(f"100 * count >= {THRESHOLD} * size") \
        .select(F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"), F.col("item_row").alias("at_item"))
    near = aligned.join(few(staged(held, "leak-held")), F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_hash") == F.col("at_hash"))
                        & (F.col("item_row") == F.col("at_item")), "left_semi")
    # the window's shingles [start, stop), cut to the document: aligned, from the shared shingle on, or up to it
    starts = F.array_distinct(F.array(F.col("pos") - F.col("at"), F.col("pos"), F.col("pos") - F.col("size") + 1))
    windows = near.select(*pair, "n", "size", F.explode(starts).alias("first")).select(
        *pair, "size", F.greatest("first", F.lit(0)).alias("start"), F.least(F.col("first") + F.col("size"), F.col("n")).alias("stop")).distinct()
    windows = staged(windows.filter(f"100 * (stop - start) >= {THRESHOLD} * size").drop("size"), "leak-windows")
    places = windows.select(F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"), "start", "stop").distinct()
    at = places.groupBy("at_id", "at_hash").agg(F.collect_list(F.struct("start", "stop")).alias("windows"))
    again = rows.join(few(staged(at, "leak-texts")), F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_hash") == F.col("at_hash")))
    cut = once(once(again, "words", _words(F.col("text"))), "sh", shingles("words")) \
        .select("doc_id", "text_hash", F.size("words").alias("n_words"), "sh", "windows").dropDuplicates(["doc_id", "text_hash"]) \
        .select("doc_id", "text_hash", "n_words", "sh", F.explode("windows").alias("w")) \
        .select(F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"), F.col("w.start").alias("at_start"), F.col("w.stop").alias("at_stop"),
                F.least(F.col("w.stop") - F.col("w.start") + (SHINGLE - 1), F.col("n_words")).alias("n_words"),
                F.slice("sh", F.col("w.start") + 1, F.col("w.stop") - F.col("w.start")).alias("window"))
    seen = staged(cut.withColumn("hash", simhash("window")).withColumn("row", F.monotonically_increasing_id()), "leak-hashes")
    asked = windows.join(seen.select("at_id", "at_hash", "at_start", "at_stop", "row", "hash"), F.col("doc_id").eqNullSafe(F.col("at_id"))
                         & (F.col("text_hash") == F.col("at_hash")) & (F.col("start") == F.col("at_start")) & (F.col("stop") == F.col("at_stop"))) \
        .select("row", "hash", "item_row")

    def index(hash_: str, near: bool) -> F.Column:
        """(block, value) rows; with ``near`` all values that a block may differ to."""
        found = []
        for k, (first, bits) in enumerate(BLOCKS):
            flips = [0] + [sum(1 << b for b in c) for n in range(1, RADIUS // len(BLOCKS) + 1) for c in combinations(range(bits), n)] if near else [0]
            values = ", ".join(f"{x}L" for x in flips)
            found.append(F.expr(f"transform(array({values}), x -> named_struct('block', {k}, 'value', {block_value(hash_, first, bits)} ^ x))"))
        return F.explode(F.concat(*found))

    table = items.select("item_row", "item_hash", index("item_hash", True).alias("i")).select("item_row", "item_hash", "i.*")
    found = asked.select("row", "hash", "item_row", index("hash", False).alias("i")).select("row", "hash", "item_row", "i.*") \
        .join(few(staged(table, "leak-index")), ["item_row", "block", "value"]) \
        .filter(F.bit_count(F.col("hash").bitwiseXOR(F.col("item_hash"))) <= RADIUS).select("row", "item_row").distinct()
    shared = shared_weight("window", "item")
    checked = once(found.join(seen, "row").join(few(items.select("item_row", "item_id", "item")), "item_row"), "shared", shared) \
        .withColumn("total", F.size("window") + F.size("item") - F.col("shared"))
    return checked.filter(f"100 * shared >= {THRESHOLD} * total").select(
        F.col("at_id").alias("doc_id"), "item_id", F.col("at_hash").alias("text_hash"), F.col("at_start").alias("start"), "n_words", "shared", "total")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, n_windows): each document with each item
    it holds, with the best similarity to six places."""
    return find_leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.round(F.max(F.col("shared") / F.col("total")), 6).alias("similarity"), F.count("*").alias("n_windows"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a window that leaks, all columns as they
    are. Rows that repeat id and text stay or go together; null and empty
    texts stay, as do all rows where either table is empty."""
    leaks = staged(find_leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "leak-rows")
    key = docs["doc_id"].cast("long").eqNullSafe(leaks["_id"]) & (F.xxhash64(text_column(docs)) == leaks["_hash"])
    return docs.join(few(leaks), key, "left_anti")
