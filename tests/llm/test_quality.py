import re
from collections import Counter

import pytest

from gaugework.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


TEXTS = [
    None, "", "  ", "a b c d e a b c d e", "x " * 40, "one two three four five six seven eight nine ten", "a\na\nb\n\na", "#tag & <b> $5 | *", "é ñ ß 漢字", "p q r s t u p q r s t u p q r s t",
    "1 2 3 4 5 6 7 8 9 1 2 3 4 5 0 3 4 5 6 7",
]


def test_measures_equal_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.ledger(df).collect()}
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(text), text
        base = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert bool(r["fail_bits"] & 3) == base


def test_odd_rows_and_empty_table(spark, odd_documents):
    out = quality.apply_policy(quality.ledger(odd_documents))
    assert out.count() == odd_documents.count()
    assert {r["kept"] for r in out.where("text IS NULL OR trim(text) = ''").collect()} == {False}
    assert out.where("kept AND n_words > 0").count() == 3
    empty = quality.ledger(odd_documents.limit(0))
    assert empty.count() == 0 and "fail_bits" in empty.columns and quality.ablations(empty).count() == 0


def test_policies_and_ablations(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "# " * 20), (3, "this is a clean line of more than ten plain words in it")], "doc_id long, text string")
    entries = quality.ledger(df).cache()
    kept = lambda v: {r["doc_id"]: r["kept"] for r in quality.apply_policy(entries, v).collect()}
    assert kept("base") == {1: False, 2: False, 3: True} == kept("v2")
    table = {r["rule"]: r for r in quality.ablations(entries, "v2").collect()}
    assert table["too_few_words"]["n_sole"] == 0 or table["too_few_words"]["n_failed"] >= table["too_few_words"]["n_sole"]
    assert all(r["n_documents"] == 3 and r["n_kept"] == 1 for r in table.values())
    for rule in table:
        without = sum(quality.BIT[r] for r in quality.POLICIES["v2"].rules if r != rule)
        gain = entries.where(f"fail_bits & {without} = 0").count() - 1
        assert table[rule]["n_sole"] == gain


def test_no_python_in_the_plan(spark):
    plan = quality.ledger(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("version", sorted(quality.POLICIES))
def test_masks_name_known_rules(version):
    assert quality.POLICIES[version].mask > 0


def test_a_very_long_line_and_clashing_columns(spark):
    line = " ".join(f"w{k % 1201}" for k in range(200_000))
    df = spark.createDataFrame([(1, f"{line}\n{line}\nend", "x", "y", "z")], "doc_id long, text string, __words string, N_WORDS string, __lines string")
    out = quality.ledger(df)
    row = out.first()
    assert row["n_words"] == 400_001 and row["n_dup_lines"] == 1 and row["n_repeat_words"] == 400_000
    assert row["__words"] == "x" and row["__lines"] == "z" and [c.lower() for c in out.columns].count("n_words") == 1
