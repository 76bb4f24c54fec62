"""Near-duplicate classes by DartMinHash signatures and banded joining.

A document is the weighted set of its word shingles, weighted by how often they
occur; the similarity of two documents is the weighted Jaccard index, the sum of
the smaller weights over the sum of the larger ones.

Signature. The weight axis of a shingle is cut into regions of width one, and
each region throws darts: a hashed Poisson process on the rank axis, the same
for every document that has the region. Each dart falls on one of `darts`
coordinates; a document keeps, for each coordinate, its dart of least rank. Two
documents agree on a coordinate with the probability of their similarity. Only
darts up to rank t / weight are thrown, with t = k ln k + 2k, so the work is
the document's weight plus t, not their product; a document with an empty
coordinate goes on to twice that rank.

Joining. Equal texts are one node. `bands` hashes of `rows` coordinates each
deal the nodes into buckets; every node of a bucket is tested against its hub,
the node whose buckets hold the most, exactly, on the shingles. Tested pairs
that reach `similarity` are links, and components of links are classes. Then
the buckets that hold more than one class are completed: nodes outside a
bucket's largest class are tested against its nodes of other classes, so no
link between nodes that share a bucket is lost, while a bucket of one class,
however large, costs one test a node. In larger buckets, shingles that only one
of the open nodes has bound the similarity of each pair from above, and pairs
that cannot reach it are not made: edited copies of one text are quadratic in
number, but what each has alone rules nearly all of them out. At the defaults,
two documents of similarity 0.8 share no bucket with probability 3e-6, of 0.9
with 3e-11.

Large groups: copies are counted with partial aggregates. A bucket, hub, class
or text of many rows is dealt in pieces, and what is joined to it is copied to
its pieces; the hot keys are found by counts, and there are fewer than HOT of
them whatever the data, so they are a list in the plan. A hub's shingles are made
once a piece, and its documents stream by them. Components are found by
alternating large-star and small-star rounds, at most O(log(n)^2) of them for n
nodes (Kiveris and others, 2014). Lineage is cut by tables in the shared folder;
all but the last join runs when `near_duplicates` is called.

Defined results: documents without a word (null, empty, blank) are each a class
of their own; a document of fewer words than a shingle has one shingle, all its
words; a text of any length is shingled whole; rows that repeat id and text are
in one class; the class id is the least id in the class (null if it has none).
Ids must be whole numbers. Empty tables give empty results; extra columns of any
name are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import copies, held, hot_keys, materialize, observed, small_batches, spread

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
#: Nodes of a bucket whose open pairs are all tested; beyond, pairs that cannot be links are ruled out first.
SMALL = 12
#: Pieces of a hot bucket whose open rows are joined with each other.
WIDE_PIECES = 8
#: Documents that a task has in arrays at a time.
SLICE = 250

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, a permutation of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def shingles(words: np.ndarray, ends: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the document of each.

    words: word hashes of all documents in turn; ends: where each one ends.
    """
    words = words.astype(np.uint64)
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    count = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    doc = np.repeat(np.arange(len(ends)), count)
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(doc))
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    have = np.repeat(lengths, count)
    out = np.zeros(len(doc), np.uint64)
    for k in range(size):
        word = padded[first + k]
        if (short := have <= k).any():
            word = np.where(short, np.uint64(k + 1), word)
        out = mix((out + word) * _GOLD + np.uint64(k))
    return out, doc


def regions(sh: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Weight regions: the n-th occurrence of a shingle in its document gets a hash of both."""
    key = mix(sh + (doc.astype(np.uint64) + np.uint64(1)) * _GOLD)
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    layer = np.zeros(len(sh), np.uint64)
    if len(twice):
        at = np.flatnonzero(np.isin(key, twice))
        by = at[np.argsort(key[at], kind="stable")]
        new = np.concatenate([[True], key[by][1:] != key[by][:-1]])
        begin = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        layer[by] = np.arange(len(by)) - begin
    return mix(sh ^ (layer * _M1))


def _throw(region: np.ndarray, doc: np.ndarray, docs: int, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Least dart of each coordinate of each document: its hash, and whether there is one."""
    slots, ranks, hashes = [], [], []
    u, d, rank, top = region, doc, np.zeros(len(region)), limit[doc]
    step = 0
    while len(u):
        step += 1
        dart = mix(u + np.uint64(step * int(_GOLD) % 2**64))
        # Gaps of a Poisson process of rate one.
        rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        on = rank <= top
        u, d, rank, top, dart = u[on], d[on], rank[on], top[on], mix(dart[on] ^ _M2)
        slots.append(d * k + (dart % np.uint64(k)).astype(np.int64))
        ranks.append(rank)
        hashes.append(dart)
    best = np.full(docs * k, np.inf)
    found = np.zeros(docs * k, np.uint64)
    if slots:
        slot, rank, dart = np.concatenate(slots), np.concatenate(ranks), np.concatenate(hashes)
        np.minimum.at(best, slot, rank)
        first = rank == best[slot]
        found[slot[first]] = dart[first]
    return found.reshape(docs, k), np.isfinite(best).reshape(docs, k)


def signatures(words: np.ndarray, ends: np.ndarray, k: int = BANDS * ROWS, size: int = SHINGLE) -> np.ndarray:
    """One row of k dart hashes a document; every document needs a word."""
    sh, doc = shingles(words, ends, size)
    region = regions(sh, doc)
    docs = len(ends)
    weight = np.bincount(doc, minlength=docs)
    limit = k * (np.log(k) + 2) / np.maximum(weight, 1)
    out, full = _throw(region, doc, docs, limit, k)
    open_ = np.flatnonzero(~full.all(1) & (weight > 0))
    while len(open_):
        limit[open_] *= 2
        number = np.full(docs, -1)
        number[open_] = np.arange(len(open_))
        mine = number[doc] >= 0
        again, full = _throw(region[mine], number[doc[mine]], len(open_), limit[open_], k)
        out[open_] = again
        open_ = open_[~full.all(1)]
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key for each band; keys of different bands never share a bucket but by chance."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * _M1 + parts[:, :, r])
    return key.view(np.int64)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sums of the smaller and of the larger weights of two sets of regions."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common, len(a) + len(b) - common


def _word_hashes(text):
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, node (digest of the text) and its band keys, null without words."""
    raw = F.col(text).cast("string")
    rows_in = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.md5(raw.cast("binary"))).alias("node"), F.coalesce(_word_hashes(raw), F.array().cast("array<bigint>")).alias("words"))

    def run(batches):
        held()
        kind = pa.list_(pa.int64())
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words = part.column(2)
                ends = words.offsets.to_numpy()[1:].astype(np.int64) - words.offsets[0].as_py()
                values = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                have = np.diff(np.concatenate([[0], ends])) > 0
                keys: list = [None] * part.num_rows
                if have.any():
                    found = band_keys(signatures(values, ends[have], bands * rows), bands, rows)
                    offsets = np.concatenate([[0], np.cumsum(np.where(have, bands, 0))]).astype(np.int32)
                    column = pa.ListArray.from_arrays(pa.array(offsets, mask=np.concatenate([~have, [False]])), pa.array(found.reshape(-1)))
                else:
                    column = pa.array(keys, kind)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), column], ["doc_id", "node", "bands"])

    return rows_in.mapInArrow(run, "doc_id long, node binary, bands array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """node, label for all ends of edges (a, b): the least node that can be reached.

    Large-star joins the greater neighbours of a node to the least node it sees,
    small-star the smaller ones; when neither changes anything each component is
    a star around its least node.
    """
    one = {"rows": F.count("*"), "mark": F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))}
    links, state = observed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", **one)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, seen = observed(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")), "low", most=F.max("n"))
        u = F.col("u")
        hot = hot_keys(low, u, 2 * state["rows"], seen["most"])
        large = spread(both, u, hot, "v").join(copies(low.select("u", "m"), u, hot), ["u", "__salt"]).where("v > u")
        large = materialize(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        links, new = observed(small.select("e.*").where("u <> v").distinct(), "small", **one)
        if new == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("label")).union(links.select("v", F.col("v").alias("label")).distinct())
        state = new


def unique_weights(words: DataFrame, size: int = SHINGLE) -> DataFrame:
    """nid, w (weight of all shingles), u (weight of those that no other of these nodes has)."""
    long = F.transform(F.slice("words", F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get("words", i + k) for k in range(1, size)]))
    rows = words.withColumn("sh", F.when(F.size("words") >= size, long).otherwise(F.array(F.xxhash64("words"))))
    spots = rows.select("nid", F.explode("sh").alias("sh")).groupBy("sh").agg(F.min("nid").alias("nid"), F.max("nid").alias("last"), F.count("*").alias("n"))
    alone = spots.where("nid = last").groupBy("nid").agg(F.sum("n").alias("u"))
    weights = words.select("nid", F.greatest(F.size("words") - (size - 1), F.lit(1)).cast("long").alias("w"))
    return weights.join(alone, "nid", "left").withColumn("u", F.coalesce("u", F.lit(0)))


def region_arrays(words: DataFrame, size: int = SHINGLE) -> DataFrame:
    """nid and the weight regions of its words, from which the similarity is exact."""

    def run(batches):
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                values = batch.column(1)[k].values.to_numpy(zero_copy_only=False).view(np.uint32)
                rows.append(regions(*shingles(values, np.array([len(values)]), size)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], ["nid", "regions"])

    return words.select("nid", "words").mapInArrow(run, "nid long, regions array<bigint>")


def _sides(few: DataFrame, whole: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame, Column]:
    """Rows of few beside rows of whole as columns x and y, to be joined on the returned condition; few has a copy for each piece of a hot bucket."""
    left = few.select(F.col("key").alias("kx"), F.col("__salt").alias("sx"), F.struct("nid", "label", *extra).alias("x"))
    right = whole.select(F.col("key").alias("ky"), F.col("__salt").alias("sy"), F.struct("nid", "label", "top", *extra).alias("y"))
    once = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.top")) | (F.col("x.nid") < F.col("y.nid")))
    return left, right, (F.col("kx") == F.col("ky")) & (F.col("sx") == F.col("sy")) & once


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x.nid", "y.nid").alias("a"), F.greatest("x.nid", "y.nid").alias("b")).distinct()


def _across(rest: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of one bucket and different classes, one of them outside the largest."""
    left, right, on = _sides(rest.where("label <> top"), rest)
    return _pairs(left.join(right, on))


def _links_across(wide: DataFrame, hot: list[int], thousandths: int) -> DataFrame:
    """The same for large buckets, but links only: the whole test is the join's condition.

    A shingle that no other open node has is never common, so c = min(w - u)
    bounds what is common, and c / (w + w - c) the similarity; pairs that cannot
    reach it go no further. Others are tested in the first bucket that they
    share, on their regions.
    """
    # Rows with whole arrays are copied, so a bucket is dealt in few pieces here.
    key, wide = F.col("key"), spread(wide.drop("__salt"), F.col("key"), hot, "nid", WIDE_PIECES)
    least = copies(wide.groupBy("key").agg(F.min("w").alias("least")), key, hot, WIDE_PIECES)
    few = wide.where("label <> top").join(least, ["key", "__salt"]).where(1000 * (F.col("w") - F.col("u")) >= thousandths * (F.col("u") + F.col("least")))
    left, right, on = _sides(copies(few.drop("__salt"), key, hot, WIDE_PIECES), wide, "w", "u", "bands", "regions")
    c = F.least(F.col("x.w") - F.col("x.u"), F.col("y.w") - F.col("y.u"))
    reach = 1000 * c >= thousandths * (F.col("x.w") + F.col("y.w") - c)
    same = F.zip_with("x.bands", "y.bands", lambda p, q: p == q)
    here = F.array_position(same, True) == F.array_position("x.bands", F.col("kx"))
    common = F.size(F.array_intersect("x.regions", "y.regions"))
    link = (1000 + thousandths) * common >= thousandths * (F.col("x.w") + F.col("y.w"))
    return _pairs(left.join(right, on & reach & here & link))


def _regions_of(column: pa.Array, k: int, size: int) -> np.ndarray:
    """Weight regions of a row's word hashes."""
    values = column[k].values.to_numpy(zero_copy_only=False).view(np.uint32)
    return regions(*shingles(values, np.array([len(values)]), size))


def _linked(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(p) for p in pairs], pa.int64()), pa.array([max(p) for p in pairs], pa.int64())], ["a", "b"])


def verify_stars(spokes: DataFrame, words: DataFrame, similarity: float, size: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) of spokes (nid, hub) that reach the similarity; words: nid and 32-bit word hashes.

    A hub's words come first in each of its pieces, its documents after them.
    """
    thousandths = round(similarity * 1000)
    many, seen = observed(spokes.groupBy("hub").agg(F.count("*").alias("n")), "hub-sizes", most=F.max("n"), total=F.sum("n"))
    hub = F.col("hub")
    hot = hot_keys(many, hub, seen["total"], seen["most"])
    around = spread(spokes, hub, hot, "nid").join(words, "nid").select("hub", "__salt", "nid", "words")
    middle = copies(many.join(words.withColumnRenamed("nid", "hub"), "hub"), hub, hot).select("hub", "__salt", F.lit(None).cast("long").alias("nid"), "words")
    dealt = middle.unionByName(around).repartition("hub", "__salt").sortWithinPartitions("hub", "__salt", F.asc_nulls_first("nid"))

    def run(batches):
        centre = None
        for batch in batches:
            hubs, nids, arrays, found = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), []
            for k in range(batch.num_rows):
                mine = _regions_of(arrays, k, size)
                if nids[k] is None:
                    centre = mine
                    continue
                common, union = weighted_jaccard(centre, mine)
                if 1000 * common >= thousandths * union:
                    found.append((nids[k], hubs[k]))
            yield _linked(found)

    return dealt.mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, words: DataFrame, similarity: float, size: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose documents reach the similarity, each document in a few of them."""
    thousandths = round(similarity * 1000)
    b = words.select(F.col("nid").alias("b"), F.col("words").alias("wb"))
    a = words.select(F.col("nid").alias("a"), F.col("words").alias("wa"))
    joined = pairs.join(b, "b").join(a, "a").select("a", "b", "wa", "wb")

    def run(batches):
        last, left = None, None
        for batch in batches:
            ids, others, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for k in range(batch.num_rows):
                if ids[k] != last:
                    last, left = ids[k], _regions_of(batch.column(2), k, size)
                common, union = weighted_jaccard(left, _regions_of(batch.column(3), k, size))
                if 1000 * common >= thousandths * union:
                    found.append((ids[k], others[k]))
            yield _linked(found)

    return joined.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, small: int = SMALL
) -> DataFrame:
    """doc_id, node, class_id, class_size for every row of docs, and `kept`: one row's id and text of each class."""
    small_batches(docs.sparkSession)
    sketches = materialize(sketch(docs, doc_id, text, bands, rows), "sketches")
    # One node for equal texts. Its number is fixed by being written.
    nodes, kept = observed(
        sketches.where("bands IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.count("*").alias("copies"))
        .select(F.monotonically_increasing_id().alias("nid"), "node", "rep", "bands", "copies"),
        "nodes", rows=F.sum("copies"), most=F.max("copies"), count=F.count("*"),
    )
    keyed, key = nodes.select("nid", F.explode("bands").alias("key")), F.col("key")
    sizes, seen = observed(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes", total=F.sum("n"), most=F.max("n"))
    hot = hot_keys(sizes, key, seen["total"], seen["most"])
    shared = materialize(spread(keyed, key, hot, "nid").join(copies(sizes, key, hot), ["key", "__salt"]), "buckets")
    # The node whose buckets hold the most is nearest to the middle of its copies.
    centre = shared.groupBy("nid").agg(F.sum("n").alias("c"))
    hubs = shared.join(centre, "nid").groupBy("key").agg(F.max(F.struct("c", (-F.col("nid")).alias("nid"))).alias("h")).select("key", (-F.col("h.nid")).alias("hub"))
    spots = materialize(shared.join(copies(hubs, key, hot), ["key", "__salt"]), "hubs")
    spokes = materialize(spots.where("nid <> hub").select("nid", "hub").distinct(), "spokes")

    # The words of all nodes that share a bucket, from one row of each text.
    wanted = spokes.select("nid").union(spokes.select("hub")).distinct().join(nodes.select("nid", "node", "rep"), "nid")
    raw = F.col(text).cast("string")
    source = docs.select(F.col(doc_id).cast("long").alias("rep"), F.unhex(F.md5(raw.cast("binary"))).alias("node"), raw.alias("text"))
    texts = source.join(wanted, source["rep"].eqNullSafe(wanted["rep"]) & (source["node"] == wanted["node"])).select("nid", "text").dropDuplicates(["nid"])
    low = F.transform(_word_hashes(F.col("text")), lambda h: F.shiftright(h, 32).cast("int"))
    words = materialize(texts.select("nid", low.alias("words")), "words")

    links = materialize(verify_stars(spokes, words, similarity), "links")
    labels = components(links)
    # Buckets that still hold several classes: nodes outside the largest one meet the others.
    placed = materialize(spots.join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("label", F.coalesce("label", "nid")), "placed")
    by_class = placed.groupBy("key", "label").agg(F.count("*").alias("m"))
    mixed = by_class.groupBy("key").agg(F.count("*").alias("classes"), F.max(F.struct("m", "label")).alias("top")).where("classes > 1").select("key", F.col("top.label").alias("top"))
    rest = materialize(placed.join(copies(mixed, key, hot), ["key", "__salt"]).where("nid <> hub").select("key", "__salt", "nid", "label", "top", "n"), "rest")
    open_ = materialize(_across(rest.where(F.col("n") <= small)), "open")
    wide = rest.where(F.col("n") > small)
    open_words = words.join(wide.select("nid").distinct(), "nid", "left_semi")
    weights = unique_weights(open_words).where(F.col("u") * 1000 <= F.col("w") * (1000 - round(similarity * 1000)))
    weights = weights.join(region_arrays(open_words), "nid").join(nodes.select("nid", "bands"), "nid")
    wide = wide.join(materialize(weights, "weights"), "nid")
    more = verify(open_, words, similarity).union(_links_across(wide, hot, round(similarity * 1000)))
    more = materialize(more, "links")
    if more.limit(1).count():
        labels = components(links.union(more))

    members = materialize(nodes.join(labels.withColumnRenamed("node", "nid"), "nid", "left").select("nid", "node", "rep", "copies", F.coalesce("label", "nid").alias("label")), "members")
    # Nodes, not rows, so a hot text counts once; sums per class with partial aggregates.
    classes = members.groupBy("label").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"), F.count("*").alias("texts"), F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node")).alias("best"))
    classes, seen = observed(classes.where("class_size > 1"), "classes", most=F.max("texts"))
    label, number = F.col("label"), F.xxhash64("node")
    large = hot_keys(classes, label, kept["count"], seen["most"], "texts")
    known = spread(members, label, large, "nid").join(copies(classes, label, large), ["label", "__salt"])
    many = known.select("node", "class_id", "class_size", (F.col("best.node") == F.col("node")).alias("chosen"))
    # Only classes of more than one row need the join back to the rows.
    repeated = hot_keys(nodes, number, kept["rows"], kept["most"], "copies")
    out = spread(sketches.select("doc_id", "node"), number, repeated, "doc_id").join(copies(many, number, repeated), ["node", "__salt"], "left")
    return out.select(
        "doc_id",
        "node",
        F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (F.col("class_size").isNull() | (F.col("chosen") & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept"),
    )
