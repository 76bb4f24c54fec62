"""Mixing sources to target weights by hierarchical budgets and seeded epochs.

Documents belong to leaves of a tree (domain, language, source). A budget of
tokens goes down the tree: siblings share their parent's budget by weight, and
none gets more than its subtree can give (its tokens times `max_epochs`). What
a sibling cannot take goes to its siblings; only what a whole subtree cannot
take reaches the parent's siblings. With the siblings ordered by capacity over
weight, those that are filled come first, so each level is one window over a
table with a row a node, in whole numbers, exact in every engine.

A leaf with budget b and T tokens gives b div T whole epochs and, of the next
epoch, the prefix of b mod T tokens in the order of md5(seed, epoch, id, text).
The cut of each leaf is found by counts, digit by digit: tokens by the next digit
of the digest, in the group that holds the cut, which alone is kept for the next
level, a sixteenth of the one before; at last a running sum over some LAST_ROWS
documents. No leaf is ever sorted or gathered whole, however hot: a leaf is at
most 16 rows of a window. The texts are not shuffled. The
documents are read once: what the result needs of them is written with their
leaf, tokens and digest, and all later steps read that table. Everything up to
the choice runs when `mix` is called.

Defined results: nulls in a path column are the node '' there; nodes without a
positive weight get nothing; a null text has one token, as every document has
one beside its words; rows equal in id and text share a digest and are taken
or left together in a partial epoch; a budget beyond all capacity takes all
epochs; a text of any length counts whole. Columns named like an output,
whatever the case, are replaced; extra columns of any other name pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
MAX_LEAVES = 50_000
#: Documents of a leaf, about, that share the leading digits of a digest when the cut is sought among them.
LAST_ROWS = 16


def n_tokens(text: Column) -> Column:
    return (F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)) + 1).cast("long")


def share(children: DataFrame, parent: list[str], budget: str, weight: str, capacity: str, order: str, out: str) -> DataFrame:
    """children with the column `out`: their parts of the parent's budget, water-filled to capacity.

    Parts are whole, at most the capacity, and sum to the smaller of budget and
    capacities. Products are decimals of 38 digits.
    """
    number = lambda c: F.col(c).cast("decimal(19,0)")
    place = Window.partitionBy(*parent).orderBy((F.col(capacity).cast("double") / F.col(weight).cast("double")), order)
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    onward = place.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    upto = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = children.withColumns({"__left": F.col(budget) - F.coalesce(F.sum(capacity).over(before), F.lit(0)), "__w": F.sum(weight).over(onward)})
    rows = rows.withColumn("__fits", F.when(number(capacity) * number("__w") <= number("__left") * number(weight), 1).otherwise(0))
    rows = rows.withColumn("__full", F.min("__fits").over(upto))
    rest = Window.partitionBy(*parent)
    rows = rows.withColumns(
        {
            "__r": F.col(budget) - F.coalesce(F.sum(F.when(F.col("__full") == 1, F.col(capacity))).over(rest), F.lit(0)),
            "__ow": F.sum(F.when(F.col("__full") == 0, F.col(weight))).over(rest),
            "__cw": F.sum(F.when(F.col("__full") == 0, F.col(weight))).over(upto),
        }
    )
    cut = lambda w: F.expr(f"(CAST(__r AS DECIMAL(19,0)) * CAST({w} AS DECIMAL(19,0))) DIV CAST(__ow AS DECIMAL(19,0))")
    part = F.when(F.col("__full") == 1, F.col(capacity)).otherwise(cut("__cw") - cut(f"__cw - {weight}"))
    return rows.withColumn(out, part.cast("long")).drop("__left", "__w", "__fits", "__full", "__r", "__ow", "__cw")


def budgets(leaves: DataFrame, path: list[str], weights: dict[str, Column], budget: Column, max_epochs: int) -> DataFrame:
    """Leaves (path columns, tokens, rows) with `budget`; weights gives each level's whole weight from the path columns."""
    at = leaves
    for level in path:
        at = at.withColumn(f"w_{level}", F.coalesce(weights[level].cast("long"), F.lit(0)))
    at = at.where(" AND ".join(f"w_{level} > 0" for level in path)).withColumn("capacity", F.col("tokens") * max_epochs)
    parents = at.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("all_tokens")).select(budget.cast("long").alias("budget"), F.lit(1).alias("__root"))
    known: list[str] = []
    for k, level in enumerate(path):
        nodes = at.groupBy(*path[: k + 1]).agg(F.max(f"w_{level}").alias("w"), F.sum("capacity").cast("long").alias("c"))
        nodes = nodes.crossJoin(parents.drop("__root")) if k == 0 else nodes.join(parents, known)  # the root is one row
        nodes = share(nodes, known or [F.lit(1)], "budget", "w", "c", level, "part")
        known = path[: k + 1]
        parents = nodes.select(*known, F.col("part").alias("budget"))
    return leaves.join(parents, path, "left").withColumn("budget", F.coalesce("budget", F.lit(0).cast("long")))


def digest(seed: str, epoch: Column, doc_id: Column, text_hash: Column) -> Column:
    """Place of a document in an epoch's order."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), text_hash).cast("binary"))


def mix(
    docs: DataFrame,
    path: dict[str, Column],
    weights: dict[str, Column],
    budget: Column,
    seed: str = "epoch",
    max_epochs: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The chosen documents, one row for each epoch that takes them, with their path columns, `n_tokens` and `epoch`.

    path: the levels from the root, each an expression over docs; weights: each
    level's weight from path columns; budget: an expression over `all_tokens`;
    keep: the columns of docs that the result has, all by default.
    """
    levels = list(path)
    wanted = [c for c in docs.columns if c.lower() not in ("n_tokens", "epoch")]
    wanted = wanted if keep is None else [c for c in wanted if c in keep]
    # Columns under numbers, so that none of docs can clash with those made here.
    held = {c: f"c{k}" for k, c in enumerate(wanted)}
    keys = [f"k{k}" for k in range(len(levels))]
    hashed = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    leaf_of = [F.coalesce(path[level].cast("string"), F.lit("")).alias(k) for level, k in zip(levels, keys)]
    placed = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in held.items()], *leaf_of, n_tokens(F.col(text)).alias("t"), F.col(doc_id).alias("id"), hashed.alias("h"))
    placed = materialize(placed, "placed")
    leaf_rows = placed.groupBy(*keys).agg(F.sum("t").cast("long").alias("tokens"), F.count("*").alias("rows")).select(*[F.col(k).alias(level) for k, level in zip(keys, levels)], "tokens", "rows")
    leaves = materialize(budgets(materialize(leaf_rows, "leaves"), levels, weights, budget, max_epochs), "budgets")
    size = leaves.agg(F.count("*").alias("n"), F.max("rows").alias("most")).first()  # one row
    # A row a leaf: broadcast while the tree is as small as trees are; else an ordinary join.
    small = (lambda df: F.broadcast(df)) if size["n"] <= MAX_LEAVES else (lambda df: df)
    depth = max(1, math.ceil(math.log(max(1, size["most"] or 1) / LAST_ROWS, 16)))

    plan = leaves.select(*[F.col(level).alias(k) for level, k in zip(levels, keys)], F.expr("CAST(budget DIV tokens AS INT)").alias("whole"), F.expr("budget % tokens").alias("rest"))
    plan = plan.where("whole > 0 OR rest > 0")
    place = digest(seed, F.col("whole"), F.col("id"), F.col("h"))
    rows = placed.join(small(plan.where("rest > 0")), keys).select(*keys, "rest", place.alias("key"), "t", F.lit(0).cast("long").alias("before"))
    rows = materialize(rows, "order")
    upto = Window.partitionBy(*keys).orderBy("g")  # at most 16 rows a leaf
    for digit in range(1, depth + 1):
        group = F.left("key", F.lit(digit))
        groups = rows.groupBy(*keys, "rest", "before", group.alias("g")).agg(F.sum("t").alias("t")).withColumn("sum", F.col("before") + F.sum("t").over(upto))
        cut = groups.where("sum > rest").groupBy(*keys).agg(F.min(F.struct("g", (F.col("sum") - F.col("t")).alias("b"))).alias("at")).select(*keys, "at.g", "at.b")
        rows = rows.join(small(cut), keys).where(group == F.col("g")).select(*keys, "rest", "key", "t", F.col("b").cast("long").alias("before"))
        rows = materialize(rows, "order")
    within = Window.partitionBy(*keys).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = F.when(F.col("before") + F.col("sum") <= F.col("rest"), F.col("key"))
    # Rows that repeat id and text are one by now.
    rows = rows.groupBy(*keys, "rest", "before", "key").agg(F.sum("t").alias("t"))
    # Up to the last key inside the cut's group, or all groups before it if none of its own fits.
    cuts = rows.withColumn("sum", F.sum("t").over(within)).groupBy(*keys).agg(F.coalesce(F.max(fits), F.min(F.left("key", F.lit(depth)))).alias("cut"))
    final = materialize(plan.join(cuts, keys, "left"), "cuts")
    taken = F.col("whole") + F.when((F.col("rest") > 0) & (place <= F.col("cut")), 1).otherwise(0)
    chosen = placed.join(small(final), keys).withColumn("n", taken).where("n > 0")
    return chosen.select(
        *[F.col(k).alias(c) for c, k in held.items() if c not in levels],
        *[F.col(held[level] if level in held else k).alias(level) for level, k in zip(levels, keys)],
        F.col("t").alias("n_tokens"),
        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("epoch"),
    )


#: The production mixture over the corpus tables: domains by source number, weights whole.
DOMAIN_WEIGHT = {"web": 4, "books": 3, "code": 2, "talk": 1}
LANGUAGE_WEIGHT = {"en": 5, "fr": 2, "de": 2, "es": 1}
HOT_SOURCE_WEIGHT = 3


def corpus_path() -> dict[str, Column]:
    number = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), r"(\d+)$", 1).try_cast("long")
    domain = F.element_at(F.array(*[F.lit(d) for d in DOMAIN_WEIGHT]), (F.pmod(F.coalesce(number, F.lit(0)), F.lit(len(DOMAIN_WEIGHT))) + 1).cast("int"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def corpus_weights() -> dict[str, Column]:
    lookup = lambda c, table: F.coalesce(*[F.when(F.col(c) == k, F.lit(w)) for k, w in table.items()], F.lit(1))
    return {"domain": lookup("domain", DOMAIN_WEIGHT), "lang": lookup("lang", LANGUAGE_WEIGHT), "source": lookup("source", {"src0": HOT_SOURCE_WEIGHT})}


def corpus_budget() -> Column:
    """Nine tenths of the tokens there are."""
    return F.expr("all_tokens * 9 DIV 10")
