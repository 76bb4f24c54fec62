"""Near duplicates, sharding, mixture and the pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugework.llm import mixture, neardup, shard
from gaugework.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def bags(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def plain_classes(rows, similarity=0.8):
    texts = sorted({t for _, t in rows if bags(t)})
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = bags(a), bags(b)
            common = sum((x & y).values())
            if common >= similarity * sum((x | y).values()):
                parent[find(a)] = find(b)
    classes = defaultdict(list)
    for d, t in rows:
        classes[find(t) if t in parent else (d, t)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in classes.items()}
    return sorted(((d, least[find(t) if t in parent else (d, t)] if t in parent else d) for d, t in rows), key=str)


def near_rows(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(3000)]
    rows, n = [], 0
    for _ in range(12):
        words = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 60, 200]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((n, " ".join(copy)))
            n += 1
    return rows + [(n, None), (n + 1, ""), (n + 2, "  "), (n + 3, rows[0][1].upper()), (0, rows[0][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, seed):
    rows = near_rows(seed)
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r["doc_id"], r["class_id"]) for r in out.collect()), key=str)
    assert got == plain_classes(rows)
    kept = {r["doc_id"] for r in out.where("kept").collect()}
    assert kept == {c for _, c in got}


def test_chain_needs_several_hubs(spark):
    """A chain of small steps whose ends differ is one class."""
    rng = random.Random(3)
    words, rows = [f"w{k}" for k in range(120)], []
    for k in range(25):
        rows.append((k, " ".join(words)))
        at = rng.randrange(110)
        words[at] = f"z{k}"
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["class_id"]) for r in out.collect()), key=str) == plain_classes(rows)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    base = rng.integers(1, 2**62, 400, dtype=np.uint64)
    other = base.copy()
    other[:60] = rng.integers(1, 2**62, 60, dtype=np.uint64)
    sig = neardup.signatures(np.concatenate([base, other]), np.array([400, 800]), k=2048)
    a, b = (neardup.regions(*neardup.shingles(x, np.array([400]))) for x in (base, other))
    common, union = neardup.weighted_jaccard(a, b)
    assert abs((sig[0] == sig[1]).mean() - common / union) < 0.04
    alone = neardup.signatures(base, np.array([400]), k=2048)
    assert (alone[0] == sig[0]).all()


def test_weights_count_occurrences():
    one = neardup.regions(np.array([5, 5, 5, 9], np.uint64), np.zeros(4, int))
    two = neardup.regions(np.array([5, 9, 9], np.uint64), np.zeros(3, int))
    assert len(set(one.tolist())) == 4 and neardup.weighted_jaccard(one, two) == (2, 5)


def test_near_duplicates_of_odd_rows(spark, odd_documents):
    got = [(r["doc_id"], r["class_id"], r["class_size"]) for r in neardup.near_duplicates(odd_documents).collect()]
    assert Counter(got) == Counter([(1, 1, 1), (2, 2, 1), (3, 3, 1), (None, None, 1), (4, 4, 1), (5, 5, 2), (5, 5, 2), (6, 6, 1), (7, 7, 1)])
    assert neardup.near_duplicates(odd_documents.limit(0)).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(100, 101), (101, 102), (200, 150)], "a long, b long")
    got = {r["node"]: r["label"] for r in neardup.components(edges).collect()}
    assert all(got[k] == 0 for k in range(31)) and got[102] == 100 and got[200] == 150


def shard_rows(spark, rows, n=8):
    out = shard.shard(spark.createDataFrame(rows, "doc_id long, text string"), n).collect()
    size, slots = Counter(), defaultdict(list)
    for r in out:
        assert r["size"] == len((r["text"] or "").encode()) + 1
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(out) == len(rows)
    return size, out


def test_shards_are_even_with_a_hot_text(spark):
    rng = random.Random(0)
    rows = [(k, "hot text " * 20 if k % 3 == 0 else "x" * rng.randrange(1, 400)) for k in range(6000)]
    size, _ = shard_rows(spark, rows)
    mean = sum(size.values()) / 8
    assert len(size) == 8 and max(abs(v - mean) for v in size.values()) < 0.01 * mean


def test_equal_texts_stay_together(spark):
    rows = [(k, f"text {k // 4}") for k in range(2000)]
    _, out = shard_rows(spark, rows)
    by = defaultdict(set)
    for r in out:
        by[r["text"]].add(r["shard"])
    assert sum(len(v) > 1 for v in by.values()) <= 7


def test_shards_of_few_and_odd_rows(spark, odd_documents):
    shard_rows(spark, [(1, None), (1, None), (None, "a"), (2, "")])
    assert shard.shard(odd_documents, 3).count() == odd_documents.count()
    assert shard.shard(odd_documents.limit(0), 3).count() == 0
    one = shard.shard(spark.createDataFrame([(1, "a")] * 10, "doc_id long, text string"), 4)
    assert {r["shard"] for r in one.collect()} <= set(range(4)) and one.select("shard").distinct().count() == 1


def waterfill(budget, nodes):
    """Shares of a budget by weight up to capacity, by repeated rounds of real numbers."""
    part, open_ = dict.fromkeys(nodes, 0.0), set(nodes)
    left = float(budget)
    while open_ and left > 1e-9:
        total = sum(nodes[n][0] for n in open_)
        step = {n: left * nodes[n][0] / total for n in open_}
        full = {n for n in open_ if part[n] + step[n] >= nodes[n][1]}
        if not full:
            return {n: part[n] + step.get(n, 0) for n in nodes}
        for n in full:
            left -= nodes[n][1] - part[n]
            part[n] = nodes[n][1]
        open_ -= full
        for n in open_:
            left += part[n]
            part[n] = 0.0
    return part


@pytest.mark.parametrize("budget", [0, 7, 100, 555, 1000, 99999])
def test_water_filling(spark, budget):
    nodes = {"a": (5, 100), "b": (1, 30), "c": (3, 600), "d": (1, 1000), "e": (2, 0)}
    df = spark.createDataFrame([("p", n, w, c, budget) for n, (w, c) in nodes.items()], "p string, n string, w long, c long, b long")
    got = {r["n"]: r["out"] for r in mixture.share(df, ["p"], "b", "w", "c", "n", "out").collect()}
    want = waterfill(budget, nodes)
    assert sum(got.values()) == min(budget, sum(c for _, c in nodes.values()))
    assert all(abs(got[n] - want[n]) <= 1 and got[n] <= nodes[n][1] for n in nodes)


def test_mixture_takes_prefixes_of_epochs(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(["w"] * rng.randrange(0, 9)), rng.choice(["en", "fr"]), rng.choice(["src0", "src1", "src5"])) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixture.mix(docs, mixture.corpus_path(), mixture.corpus_weights(), mixture.corpus_budget()).collect()
    leaf = lambda r: (r["domain"], r["lang"], r["source"])
    tokens = {d: len((t or "").split()) + 1 for d, t, *_ in rows}
    key = lambda e, d, t: hashlib.md5(f"epoch:{e}:{d}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()
    text = {d: t for d, t, *_ in rows}
    taken = defaultdict(set)
    for r in out:
        assert r["n_tokens"] == tokens[r["doc_id"]]
        taken[leaf(r), r["epoch"]].add(r["doc_id"])
    members = defaultdict(set)
    domain = {"src0": "web", "src1": "books", "src5": "books"}
    for d, _, lang, s in rows:
        members[domain[s], lang, s].add(d)
    for (node, epoch), ids in taken.items():
        order = sorted(members[node], key=lambda d: key(epoch, d, text[d]))
        assert ids == set(order[: len(ids)]) and (epoch == 0 or taken[node, epoch - 1] == members[node])
    total = sum(tokens.values())
    assert total * 0.85 < sum(tokens[r["doc_id"]] for r in out) <= total * 0.9


def test_mixture_of_odd_rows(spark, odd_documents):
    args = (mixture.corpus_path(), mixture.corpus_weights(), mixture.corpus_budget())
    out = mixture.mix(odd_documents, *args)
    assert [c.lower() for c in out.columns].count("epoch") == 1 and out.count() > 0
    assert mixture.mix(odd_documents.limit(0), *args).count() == 0
    every = mixture.mix(odd_documents, mixture.corpus_path(), mixture.corpus_weights(), F.expr("all_tokens * 50"))
    assert every.count() == 2 * odd_documents.count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.cache()
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, first, SF).cache()
        assert out.columns == docs.columns, name
        if name == "language":
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in first.collect() if re.search(r"[^\W\d_]", r["text"] or "")}
        if name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in first.collect()]
            assert sorted(r["doc_id"] for r in out.collect()) == sorted({c for _, c in plain_classes(rows)})
        if name == "decontamination":
            clean = {r["doc_id"] for r in QUERIES["op5_decontaminate"](spark, SF).collect() if not r["contaminated"]}
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in first.collect()} & clean
        first = out
    last = corpus_pipeline.STAGES[4][1](spark, first, SF)
    assert last.count() == first.count()


def test_pipeline_of_odd_rows(spark, odd_documents):
    """What each stage keeps of odd rows: texts without a letter go, one of two equal rows stays, nothing else is lost."""
    docs = odd_documents.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    kept = {}
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF).cache()
        kept[name] = Counter(r["doc_id"] for r in out.collect())
    named = {None, 4, 5, 7}
    assert set(kept["language"]) <= named and kept["language"][5] == 2 and kept["language"][4] == 1
    assert kept["near_duplicates"] == Counter(set(kept["language"])) == kept["decontamination"]
    assert set(kept["mixture"]) <= set(kept["decontamination"]) and kept["tokens"] == kept["mixture"] and len(kept["mixture"]) > 0
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
    assert none.count() == 0


def test_pipeline_stages_keep_columns_of_any_name(spark, odd_documents):
    rows = odd_documents.withColumn("__lang", F.lit("x")).withColumn("__node", F.lit("y")).withColumn("__score", F.lit("z"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, rows, SF)
        assert [c.lower() for c in out.columns] == [c.lower() for c in rows.columns] and out.count() > 0, name


def test_hot_buckets_hubs_and_classes_are_dealt_in_pieces(spark, monkeypatch):
    """The same classes where every bucket of more than three rows counts as hot, and both ways to test open pairs."""
    from gaugework.llm import common

    rows = near_rows(3) + [(1000 + k, f"{'same words again and again ' * 12}{k}") for k in range(40)] + [(2000 + k, "one hot text of some words " * 5) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_classes(rows)
    for piece, small in ((1000, neardup.SMALL), (3, neardup.SMALL), (3, 1), (3, 1000)):
        monkeypatch.setattr(common, "PIECE", piece)
        out = neardup.near_duplicates(docs, small=small)
        assert sorted(((r["doc_id"], r["class_id"]) for r in out.collect()), key=str) == want, (piece, small)


def test_components_in_an_adversarial_order(spark):
    """A path whose least labels lie far apart, a tree of stars, and a hub of many: few rounds, the same classes as a union-find."""
    rng = random.Random(8)
    order = sorted(range(600), key=lambda k: bin(k)[::-1])
    edges = [(order[k], order[k + 1]) for k in range(599)] + [(1000 + k, 1000 + (k - 1) // 3) for k in range(1, 300)] + [(5000, 5000 + k) for k in range(1, 400)]
    rng.shuffle(edges)
    got = {r["node"]: r["label"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(600)} == {0} and {got[1000 + k] for k in range(300)} == {1000} and {got[5000 + k] for k in range(400)} == {5000} and len(got) == 1300


def test_shards_and_slots_equal_a_sorted_list(spark):
    """Slots are the places in (hash of the text, hash of the id) order, boundaries the nearest that spare a group, or cut a large one where bytes are even."""
    rng = random.Random(5)
    rows = [(k, "hot " * 30) for k in range(500)] + [(k, f"text {rng.randrange(300)} " * rng.randrange(1, 9)) for k in range(500, 3000)] + [(9000 + k, None) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = shard.shard(docs.withColumn("h", F.lit(1)), 8, range_bytes=20_000)
    keyed = sorted((r["kh"], r["kd"], r["shard"], r["slot"], r["size"], r["text"] or "") for r in out.withColumns({"kh": F.xxhash64("text"), "kd": F.xxhash64("doc_id")}).collect())
    total, place, last = sum(r[4] for r in keyed), 0, 0
    ends, sums, run = [], [], 0
    for kh, _, number, slot, size, _ in keyed:
        if number != last:
            ends.append(run)
            place, last = 0, number
        assert slot == place
        place, run = place + 1, run + size
        sums.append(run)
    assert len(ends) == 7
    edges = [0] + [sums[k] for k in range(len(keyed) - 1) if keyed[k][0] != keyed[k + 1][0]] + [total]
    for k, end in enumerate(ends, 1):
        target = total * k // 8
        nearest = min(abs(e - target) for e in edges)
        if nearest <= total // 8 * shard.SPARE:
            assert end in edges and abs(end - target) <= total // 8 * shard.SPARE
        else:
            assert abs(end - target) <= max(min(abs(x - target) for x in [0, *sums]), total // 8 * shard.TOLERANCE)
