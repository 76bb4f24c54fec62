"""Quality rules as a bitmask ledger.

`ledger` evaluates every rule once per document and stores the measurements and
one bit per failed rule. Policies are versioned masks over those bits, so a new
policy, or the ablation of a rule, never reads a text again: `apply_policy`
tests `fail_bits & mask` and `ablations` aggregates the bits.

All of it is DataFrame expressions; a document is measured inside its own row,
so no text is ever shuffled and no hot source or group of copies matters.

Defined results: a null text counts as one without words (every measurement 0,
too_few_words fails); an empty text likewise; a text or a line of any length is
measured whole. Repeated rows are measured each on their own. Extra columns are
kept as they are by `ledger`; one named like a measurement, whatever the case, is
replaced. Empty tables give empty ledgers with the full schema.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import fresh_names, let

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutter")


@dataclass(frozen=True)
class Rule:
    """A named bit; `fails` gives the failure from the measurements, in whole numbers."""

    bit: int
    name: str
    sql: str

    @property
    def fails(self) -> Column:
        return F.coalesce(F.expr(self.sql), F.lit(False))


#: Every rule ever used keeps its bit; a retired rule just leaves the masks.
RULES = (
    Rule(0, "too_few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbol_heavy", "100 * n_symbols > 20 * n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
    Rule(6, "stutter", "100 * n_stutter > 20 * n_words"),
)
BIT = {r.name: 1 << r.bit for r in RULES}


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject under it."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


POLICIES = {
    p.version: p
    for p in (
        Policy("base", ("too_few_words", "repeated_windows")),
        Policy("v1", ("too_few_words", "repeated_windows", "symbol_heavy", "repeated_lines", "short_words", "long_words")),
        # v1 without repeated_lines, whose sole failures were good documents, and with stutter.
        Policy("v2", ("too_few_words", "repeated_windows", "symbol_heavy", "short_words", "long_words", "stutter")),
    )
}
CURRENT = "v2"


def _windows(h: Column) -> Column:
    """Hashes of all runs of WINDOW words."""
    starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))


def _repeated_at(grams: Column) -> Column:
    """Sorted places of windows that occur twice; only a text that has an equal pair pays for the sort."""
    pairs = F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    same = lambda x, y: F.coalesce(x["g"] == y["g"], F.lit(False))
    found = lambda s: F.transform(F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1))), lambda x: x["i"])
    return let(pairs, lambda s: F.sort_array(F.coalesce(found(s), F.array().cast("array<int>"))))


def _covered(at: Column) -> Column:
    """Words in the union of the windows that start at these places."""
    return F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + (i + WINDOW) - F.greatest(acc["end"], i)).alias("n"), (i + WINDOW).alias("end")),
        lambda acc: acc["n"].cast("long"),
    )


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the columns of MEASURES.

    Every array is bound before a lambda reads it by index, so it is built once
    whatever is filtered or projected above.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(raw, "\n", -1), lambda x: x.rlike(WORD))

    def of_words(w: Column) -> Column:
        hashed = let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: F.struct(
                let(_windows(h), lambda g: _covered(_repeated_at(g))).alias("repeat"),
                F.size(F.filter(h, lambda x, i: F.coalesce(x == F.get(h, i - 1), F.lit(False)))).cast("long").alias("stutter"),
            ),
        )
        return F.struct(F.size(w).cast("long").alias("words"), F.length(F.array_join(w, "")).cast("long").alias("chars"), hashed.alias("h"))

    out = df.drop(*[c for c in df.columns if c.lower() in MEASURES and c != text])
    by_word, by_line = fresh_names(out, "words", "lines")
    out = out.withColumns(
        {
            by_word: let(F.regexp_extract_all(raw, F.lit(WORD), F.lit(0)), of_words),
            by_line: let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))),
            "n_symbols": F.regexp_count(raw, F.lit(SYMBOLS)).cast("long"),
        }
    )
    parts = {"n_words": "words", "word_chars": "chars", "n_repeat_words": "h.repeat", "n_stutter": "h.stutter"}
    return out.withColumns(
        {name: F.col(f"{by_word}.{part}") for name, part in parts.items()} | {"n_lines": F.col(f"{by_line}.n"), "n_dup_lines": F.col(f"{by_line}.dup")}
    ).drop(by_word, by_line)


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the measurements and `fail_bits`, a bit for each rule of RULES that fails."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.fails, F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(df, text).withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, version: str = CURRENT, column: str = "kept") -> DataFrame:
    """A ledger with a boolean column: no rule of the policy failed."""
    return entries.withColumn(column, F.col("fail_bits").bitwiseAND(F.lit(POLICIES[version].mask)) == 0)


def ablations(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: failures, sole failures (kept if the rule were dropped) and kept documents.

    The first aggregate has at most 2^rules groups whatever the corpus, with map-side partial counts.
    """
    policy = POLICIES[version]
    by_bits = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules]))
    return (
        by_bits.select("bits", "n", rules.alias("r"))
        .groupBy(F.lit(version).alias("policy"), F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("n_sole"),
            F.coalesce(F.sum(F.when(F.col("bits") == 0, F.col("n"))), F.lit(0)).alias("n_kept"),
            F.sum("n").alias("n_documents"),
        )
    )
