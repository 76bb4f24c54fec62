"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item becomes windows of up to `width` consecutive words, and a
window the set of its shingles (`shingle` words, fewer in a shorter window).
Exact containment of a window means that all of its shingles occur, so one
shingle is a sufficient prefix: the rarest one, by its count in the documents.

1. One pass over the documents keeps, inside each row, the positions whose
   shingle may occur in an item, with the few words around them. Up to
   `max_inline` item shingles are tested as a set in the row, more as a bitmap of
   BITS_EACH bits a shingle, MAX_BITS at most; what the bitmap lets through by
   chance meets no window later, so the result is the same.
2. The kept positions give the shingle counts; windows keep their rarest shingle.
3. Positions join windows on that prefix; positional and length bounds place
   the window in the document; equality of the words decides. Windows are
   broadcast if their counted number is at most MAX_BROADCAST; else a shingle of
   very many positions is dealt in pieces.
4. Hits of a document are united to word counts and item lists and joined back.

Nothing but kept positions and per-document counts is shuffled. A text is never
cut; matching is exact, hashes only preselect. Items, and in a first pass the
documents, are read when `decontaminate` is called.

Defined results: null and empty texts have no words and are clean; a text of any
length is searched whole, inside its row; an item without words has no window; a
null item_id marks hits but adds no id; repeated document rows each get the same
result; equal item rows count once. Extra columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import ascii_lower, copies, hot_keys, materialize, observed, spread

#: A word, before A-Z is lower-cased: digits, letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

WIDTH = 10
SHINGLE = 5
MAX_INLINE = 20_000
#: The bitmap of item shingles: bits for each, and at most, which are 8 MB.
BITS_EACH, MAX_BITS = 16, 1 << 26
MAX_BROADCAST = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text.cast("string"), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _shingles(hashes: str, size: int) -> Column:
    """Hashes of all runs of `size` words; `hashes` names a column with one hash a word."""
    return F.when(
        F.size(hashes) >= size,
        F.transform(
            F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (size - 1), F.lit(0))),
            lambda x, i: F.xxhash64(F.lit(size), x, *[F.get(hashes, i + k) for k in range(1, size)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _word_hashes(column: str) -> Column:
    # lower() also folds letters beyond ASCII: coarser than the exact test that follows, so nothing is lost.
    return F.transform(column, lambda w: F.xxhash64(F.lower(w)))


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WIDTH, shingle: int = SHINGLE) -> DataFrame:
    """One row for each distinct window of each item: item_id, window (words), size, length, offset, sh."""
    found = (
        items.select(F.col(item_id).cast("string").alias("item_id"), F.transform(words(F.col(text)), ascii_lower).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("size", F.least(F.size("words"), F.lit(width)))
        .select("item_id", "size", F.explode(F.expr("transform(sequence(0, size(words) - size), i -> slice(words, i + 1, size))")).alias("window"))
        .distinct()
        .withColumn("length", F.least("size", F.lit(shingle)))
        .withColumn("hashes", _word_hashes("window"))
    )
    made = F.array().cast("array<bigint>")
    for size in range(1, shingle + 1):
        made = F.when(F.col("length") == size, _shingles("hashes", size)).otherwise(made)
    return found.withColumn("made", made).select("item_id", "window", "size", "length", F.posexplode("made").alias("offset", "sh"))


def bitmap(shingles: DataFrame, count: int) -> Callable[[Column], Column]:
    """A test that every hash of `sh` passes and few others do: two bits each of a literal bitmap, made by partial aggregates."""
    bits = min(MAX_BITS, 1 << (max(1, count) * BITS_EACH - 1).bit_length())
    first = lambda h: F.pmod(h, F.lit(bits))
    second = lambda h: F.pmod(F.shiftright(h, 32), F.lit(bits))
    spots = shingles.select(F.explode(F.array(first(F.col("sh")), second(F.col("sh")))).alias("b"))
    words = spots.groupBy(F.shiftright("b", 5).cast("int").alias("i")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("b") % 32).cast("int"))).alias("w"))
    found = words.toArrow()  # MAX_BITS / 32 rows at most
    filled = np.zeros(max(1, bits // 32), dtype=np.int64)
    filled[found.column("i").to_numpy()] = found.column("w").to_numpy()
    table = F.split(F.lit(",".join(map(str, filled.tolist()))), ",").cast("array<bigint>")
    bit = lambda b: F.call_function("shiftright", F.get(table, F.shiftright(b, 5).cast("int")), (b % 32).cast("int")).bitwiseAND(F.lit(1)) == 1
    return lambda h: bit(first(h)) & bit(second(h))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    shingle: int = SHINGLE,
    max_inline: int = MAX_INLINE,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """doc_id, n_words, spans (start and end of the hit runs of words), n_hit, items (sorted ids), contaminated.

    `doc_id` need not be unique: the text's hash goes with it wherever rows meet.
    """
    windows = materialize(item_windows(items, item_id, item_text, width, shingle), "windows")
    sizes = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most `shingle` values
    known = windows.select("sh").distinct()
    count = known.count()
    if count <= max_inline:
        some = [r[0] for r in known.collect()]  # max_inline at most
        wanted = lambda h: h.isin(some)
    else:
        wanted = bitmap(known, count)

    reach = width - 1
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("text_key"), words(F.col(text)).alias("words"))
    base = base.withColumn("hashes", _word_hashes("words"))
    for size in sizes:
        base = base.withColumn(f"s{size}", _shingles("hashes", size))

    def spots_of(size: int) -> Column:
        at = F.filter(F.transform(f"s{size}", lambda h, i: F.struct(i.alias("pos"), h.alias("sh"))), lambda x: wanted(x["sh"]))
        begin = lambda x: F.greatest(x["pos"] - reach, F.lit(0))
        return F.transform(
            at,
            lambda x: F.struct(
                x["pos"].alias("pos"), x["sh"].alias("sh"), F.lit(size).alias("length"), begin(x).alias("from"), F.slice("words", begin(x) + 1, F.lit(2 * width)).alias("near")
            ),
        )

    empty = F.array().cast("array<struct<pos:int,sh:bigint,length:int,from:int,near:array<string>>>")
    kept = F.concat(empty, *[spots_of(size) for size in sizes])
    marked = materialize(base.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), kept.alias("kept")), "marked")
    counts = marked.select("doc_id", "text_key", "n_words")
    # Rows that repeat id and text hold the same positions.
    hits = marked.where(F.size("kept") > 0).dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", "n_words", F.inline("kept"))

    # Rarity over all documents; a shingle that never occurs rules its window out.
    rarity = hits.groupBy("sh").agg(F.count("*").alias("df"))
    prefix = (
        windows.join(rarity, "sh", "left")
        .groupBy("item_id", "window", "size", "length")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "sh", "offset")).alias("p"))
        .where("p.df > 0")
        .groupBy("window", "size", F.col("length").alias("plen"), F.col("p.sh").alias("psh"), F.col("p.offset").alias("offset"))
        .agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    )
    start = F.col("pos") - F.col("offset")
    same = F.transform(F.slice("near", start - F.col("from") + 1, F.col("size")), ascii_lower) == F.col("window")
    placed = (F.col("length") == F.col("plen")) & (start >= 0) & (start + F.col("size") <= F.col("n_words")) & same
    if windows.count() <= max_broadcast:
        met = hits.join(F.broadcast(prefix), (F.col("sh") == F.col("psh")) & placed)
    else:
        rarity, seen = observed(rarity, "rarity", total=F.sum("df"), most=F.max("df"))
        sh = F.col("sh")
        hot = hot_keys(rarity, sh, seen["total"], seen["most"], "df")
        met = spread(hits, sh, hot, "text_key").join(copies(prefix.withColumnRenamed("psh", "sh"), sh, hot), ["sh", "__salt"]).where(placed)
    found = met.select("doc_id", "text_key", start.alias("start"), (start + F.col("size")).alias("end"), "ids")
    merged = F.aggregate(
        "runs",
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    )
    per_doc = (
        found.groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"))
        .select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), merged.alias("spans"), "items")
    )
    return (
        counts.join(per_doc, counts["doc_id"].eqNullSafe(per_doc["d"]) & (counts["text_key"] == per_doc["t"]), "left")
        .select(
            "doc_id",
            "text_key",
            "n_words",
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"]))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )
