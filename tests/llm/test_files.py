"""Token store and WARC archive: exact round trips."""

import hashlib
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.llm import storage, tokens, warc
from gaugework.llm.queries import tokenizer_path

BPE = tokenizer_path("byte_bpe_50k.json")


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    return [t.encode(x, add_special_tokens=False).ids + [0] for x in texts]


TEXTS = ["", " ", "\n", "a  b   c\n\n d \n e", "it's 'll\tx  ", "a\nb\n c", " lead", "trail ", "x\x85 y", "Éa ß, ñ.\nfoo###", "漢字 ☃ x\t\t\ny", "x\n\t\ty", "a b c  d", "<|endoftext|> z", "don't stop!! 12,345.67 A_b", "a\x1f b"]


def test_encoder_equals_the_library():
    encoder = tokens.Encoder(BPE, 0)
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder(TEXTS * 2)]
    assert got == reference(TEXTS * 2)


def test_store_round_trip(spark, tmp_path):
    rows = [(k * 3 % 101, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (7, None), (0, "same id"), (0, "same id")]
    folder = f"file://{tmp_path}/store"
    manifest = tokens.write_store(spark.createDataFrame(rows, "doc_id long, text string"), folder, BPE, partitions=3)
    got = [(r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in tokens.read_store(spark, folder).orderBy("start").collect()]
    assert len(got) == len(rows) == manifest["documents"] and sum(g[2] for g in got) == manifest["ids"]
    assert [g[0] for g in got][0] is None and [g[0] for g in got][1:] == sorted(i for i, _ in rows if i is not None)
    want = sorted((-1 if i is None else i, np.array(x, "<u4").tobytes()) for (i, _), x in zip(rows, reference([t or "" for _, t in rows])))
    assert sorted((-1 if g[0] is None else g[0], g[3]) for g in got) == want
    starts = [g[1] for g in got]
    assert starts == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    assert [x.tolist() for x in tokens.read_document(folder, 3)] == reference([TEXTS[1]]) and len(tokens.read_document(folder, 0)) == 3


def test_store_with_a_dictionary_and_repeat(spark, tmp_path):
    docs = spark.createDataFrame([(k, " ".join(f"w{(k * j) % 37} the of" for j in range(120))) for k in range(200)], "doc_id long, text string")
    one, two = (f"file://{tmp_path}/{x}" for x in "ab")
    a, b = (tokens.write_store(docs, x, BPE, partitions=2) for x in (one, two))
    assert a == b and storage.get(one, "shared.zdict")
    assert a["dictionary_sha256"] == hashlib.sha256(storage.get(one, "shared.zdict")).hexdigest()
    storage.put(one, "shared.zdict", b"other")
    with pytest.raises(ValueError, match="dictionary"):
        tokens.read_store(spark, one)


def test_store_of_nothing(spark, tmp_path, odd_documents):
    folder = f"file://{tmp_path}/none"
    assert tokens.write_store(odd_documents.limit(0), folder, BPE)["parts"] == []
    assert tokens.read_store(spark, folder).count() == 0
    assert tokens.write_store(odd_documents, f"file://{tmp_path}/odd", BPE)["documents"] == odd_documents.count()


PAGES = [(1, "http://a", "<p>one</p>"), (2, "http://b", "<p>two</p>"), (3, None, "<p>one</p>"), (4, "http://d", None), (5, "", ""), (None, "http://e", "<p>two</p>"), (2, "http://b", "<p>two</p>"), (6, "http://f", "ünï" * 1000), (7, "http://g\r\nX: y", "<p>\r\n\r\n</p>")]


def archive(spark, folder, **more):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return warc.write_archive(pages, folder, **more)


def test_archive_round_trip(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    manifest = archive(spark, folder, partitions=2, roll_bytes=600)
    assert len(manifest["files"]) > 2 and manifest["records"] == len(PAGES)
    rows = warc.read_archive(spark, folder, payloads=True).collect()
    want = {}
    for i, _, html in PAGES:
        data = (html or "").encode()
        least = min((x for x, _, h in PAGES if (h or "") == (html or "") and x is not None), default=None)
        want[i] = (len(data), warc.digest_of(data), None if least == i or least is None else least)
    assert len(rows) == len(PAGES)
    for r in rows:
        n, digest, refers = want[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"], r["refers_to"]) == (n, digest, refers)
        assert r["record_type"] == ("response" if refers is None else "revisit")
        if refers is None:
            assert warc.digest_of(bytes(r["payload"])) == digest
    again = f"file://{tmp_path}/again"
    assert archive(spark, again, partitions=2, roll_bytes=600) == manifest
    for f in manifest["files"]:
        assert storage.get(folder, f["name"]) == storage.get(again, f["name"])


def test_members_are_records(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    manifest = archive(spark, folder, partitions=1)
    raw = storage.get(folder, manifest["files"][0]["name"])
    seen = 0
    while raw:
        d = zlib.decompressobj(31)
        text = d.decompress(raw)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        raw, seen = d.unused_data, seen + 1
    assert seen == len(PAGES) + 1  # and the file's warcinfo


def test_only_long_payloads_are_shared(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    archive(spark, folder, revisit_bytes=100)
    assert {r["record_type"] for r in warc.read_archive(spark, folder).collect()} == {"response"}


def test_archive_of_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_archive(pages, folder)["files"] == [] and warc.read_archive(spark, folder).count() == 0
    assert json.loads(storage.get(folder, "manifest.json"))["records"] == 0


def test_unfinished_files_do_not_show(tmp_path):
    file = storage.AtomicFile(f"file://{tmp_path}", "a")
    file.write(b"x")
    assert not (tmp_path / "a").exists()
    file.abort()
    assert not list(tmp_path.iterdir())


def test_random_strings_and_added_tokens_equal_the_library():
    import random

    rng = random.Random(11)
    parts = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\t", "don't", "Éa", "ß", "漢字", "☃", "x1", "3.14", "###", " ", "​", "ſ", "ǅ", "the", " of", "'s", "İ", "\r\n", "á"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 12))) for _ in range(4000)] + ["end <|endoftext|> start", "word " * 200_000]
    encoder = tokens.Encoder(BPE, 0)
    assert encoder.by_word
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder(texts)]
    assert got == reference(texts) and 50256 in got[-2]


def test_ids_must_be_whole_numbers(spark, tmp_path):
    docs = spark.createDataFrame([("a", "b", "c")], "doc_id string, text string, ids string")
    with pytest.raises(TypeError, match="whole number"):
        tokens.write_store(docs, f"file://{tmp_path}/s", BPE)
    with pytest.raises(TypeError, match="whole number"):
        warc.write_archive(docs.withColumnsRenamed({"doc_id": "page_id", "text": "html", "ids": "url"}), f"file://{tmp_path}/w")


def test_two_calls_write_the_same_files(spark, tmp_path):
    """Rows in another order and other partitions, over several exact ranges and one hot id."""
    rows = [(k % 700 if k % 3 else 5, f"http://h/{k % 50}", f"<p>{k % 211} {'x' * (k % 97)}</p>") for k in range(5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    again = spark.createDataFrame(rows[::-1], pages.schema).repartition(7)
    for name, write in (("w", lambda df, at: warc.write_archive(df, at, partitions=5)), ("t", lambda df, at: tokens.write_store(df.withColumnsRenamed({"page_id": "doc_id", "html": "text"}), at, BPE, partitions=5))):
        a, b = (write(df, f"file://{tmp_path}/{name}{k}") for k, df in enumerate((pages, again)))
        assert a == b
        for f in a.get("files") or a["parts"]:
            assert storage.get(f"file://{tmp_path}/{name}0", f["name"]) == storage.get(f"file://{tmp_path}/{name}1", f["name"])
        assert len(a.get("files") or a["parts"]) > 3


def test_revisits_name_the_record_that_they_refer_to(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    manifest = archive(spark, folder, partitions=1)
    records, first = {}, None
    with storage.resolve(folder)[0].open_input_stream(f"{tmp_path}/w/{manifest['files'][0]['name']}", compression=None) as stream:
        for headers, _ in warc.read_records(stream):
            first = first or headers
            assert headers["WARC-Record-ID"] not in records
            records[headers["WARC-Record-ID"]] = headers
    assert first["WARC-Type"] == "warcinfo" and first["WARC-Filename"] == manifest["files"][0]["name"]
    revisits = [h for h in records.values() if h["WARC-Type"] == "revisit"]
    assert revisits
    for h in revisits:
        target = records[h["WARC-Refers-To"]]
        assert target["WARC-Type"] == "response" and target["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]
        assert (target["WARC-Target-URI"], target["WARC-Date"], target["X-Page-ID"]) == (h["WARC-Refers-To-Target-URI"], h["WARC-Refers-To-Date"], h["X-Refers-To-Page"])


def test_very_long_texts_are_stored_whole(spark, tmp_path):
    text = " ".join(f"w{k % 5003}" for k in range(400_000))
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, text)], "doc_id long, text string")
    tokens.write_store(docs, f"file://{tmp_path}/s", BPE)
    got = {r["doc_id"]: bytes(r["ids"]) for r in tokens.read_store(spark, f"file://{tmp_path}/s").collect()}
    assert got[1] == got[3] == np.array(reference([text])[0], "<u4").tobytes()
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"), F.lit(1).alias("d"))
    warc.write_archive(pages, f"file://{tmp_path}/w")
    rows = {r["page_id"]: r for r in warc.read_archive(spark, f"file://{tmp_path}/w", payloads=True).collect()}
    assert bytes(rows[1]["payload"]) == text.encode() and rows[3]["refers_to"] == 1
