import random
import re

import pytest

from gaugework.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((d, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None)), bool(hit)))
    return sorted(out, key=str)


def made():
    rng = random.Random(5)
    vocab = ["the", "of", "É", "é", "Straße", "x1"] + [f"w{k}" for k in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 4, 5, 9, 10, 11, 25])))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "..."), (15, items[0][1]), (0, items[0][1])]
    docs = [(d, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 3, 12, 60])))) for d in range(40)]
    for d in range(40, 80):
        item = rng.choice(items)[1] or ""
        docs.append((d, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 9))) + ", " + item.upper() + "; tail " + rng.choice(["", item])))
    return docs + [(80, None), (81, ""), (79, docs[-1][1]), (None, docs[45][1])], items


@pytest.mark.parametrize(("max_inline", "max_broadcast"), [(20_000, 100_000), (0, 100_000), (0, 0)])
def test_equals_plain_search(spark, max_inline, max_broadcast):
    docs, items = made()
    out = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), max_inline=max_inline, max_broadcast=max_broadcast)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in out.collect()), key=str)
    assert got == plain(docs, items)
    for r in out.collect():
        spans = [tuple(s) for s in r["spans"]]
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_odd_rows_and_empty_sides(spark, odd_documents):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again")], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate(odd_documents, items).where("contaminated").collect()} == {5}
    assert decontaminate(odd_documents, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate(odd_documents.limit(0), items).count() == 0


def test_a_very_long_text_and_clashing_columns(spark):
    """300,000 words with an item at either end, beside columns named like those that are made."""
    item = "one two three four five six seven eight nine ten eleven"
    filler = " ".join(f"v{k % 911}" for k in range(300_000))
    docs = spark.createDataFrame([(1, f"{item} {filler} {item}", 1, "x", "y"), (2, filler, 1, "x", "y")], "doc_id long, text string, n_words int, kept string, `from` string")
    items = spark.createDataFrame([("a", item, 0)], "item_id string, text string, sh int")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in decontaminate(docs, items).collect()}
    assert got == {1: (300_022, 22), 2: (300_000, 0)}
