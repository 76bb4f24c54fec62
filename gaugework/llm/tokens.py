"""Token ids in binary files, each document a zstandard frame over one shared dictionary.

A store is a folder: `part-NNNNN.gwt` files in ascending document order, the
dictionary `shared.zdict` and, last of all, `manifest.json`, which makes it
valid. A part is

    magic(8) | sha256 of the dictionary(32) | frames | index | index offset u64 | documents u64 | magic(8)

and its index holds, for each document, id, null flag, offset and length of the
frame and number of ids, column by column. A reader that wants one short
document reads the trailer, the index and one frame. Frames hold ids of 2 or 4
bytes, little-endian, as the vocabulary needs.

The dictionary is trained on serialized id arrays of `sample` documents at most
(those of the least hashes, at most SAMPLE_IDS ids of SAMPLE_CHARS characters of each): a bounded sample
that changes sizes, never contents. Where it is too small to train, frames have
no dictionary and its hash is that of no bytes.

Documents are dealt by exact ranges of (id, hash of the text), at most about
PART_BYTES of text each, and sorted inside a partition, so no task holds more
than its range, a hot id is split, and the same rows under the same settings
give the same files; a text is encoded once, after that single exchange. The
jobs that train and write run when `write_store` is called.

Defined results: a null text is empty and has just the end id; null ids come
first; repeated rows are stored each, those of one id by the hash of their text;
a text of any length is one frame, encoded whole; ids that are no whole numbers
are refused. An empty table gives a store without documents. Extra columns of
any name are not stored.
"""

from __future__ import annotations

import array
import hashlib
import json
import os
import re
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.llm import ranges, storage
from gaugework.llm.common import held, materialize, small_batches, tasks_for

MAGIC = b"GWTOKEN1"
SAMPLE, SAMPLE_IDS, DICT_BYTES, LEVEL = 1000, 2048, 65_536, 1
ENCODE_CHARS = 1_000_000
SAMPLE_CHARS = 10_000
#: Columns of a part's index: name, array code of 8 bytes or 1, little-endian in the file.
INDEX = (("id", "q"), ("null", "B"), ("offset", "Q"), ("length", "Q"), ("n", "Q"))
#: Words that a worker remembers with their ids.
CACHE_WORDS = 300_000
#: Latin letters, the same in every Unicode version, and marks of ASCII after them.
LATIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@[-`{-~]*)")
#: Bytes of text, and of index, of a part, about; bytes that a reader asks for at a time.
PART_BYTES = 512 * 1024 * 1024
INDEX_BYTES = 64
READ_BYTES = YIELD_BYTES = 4_000_000
#: Rows of a batch that a task turns to Python strings at a time.
SLICE = 500


def _spelling() -> dict[int, str]:
    """How byte-level vocabularies write characters: printable bytes as themselves, the others from U+0100 on."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = (b for b in range(256) if b not in printable)
    letter = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x250)}


SPELLING = _spelling()


#: Words, marks and letters that must come out the same by words and whole.
PROBE = ["The quick brown fox's tail, don't!", "Éa ß ñandú d'été.\nfoo### x12 (a-b) 3.14", "über-straße …漢字 ☃ ĳ ǅ İI ﬁ", "a_b __c__ 'll 's A's"]


class Uncut(Exception):
    """A word whose white space may belong to the white space that it was cut at."""


class Memory(dict):
    """Words with their ids; an unknown word is encoded when it is asked for.

    Full, it becomes the old generation, from which words in use come back.
    """

    def __init__(self, encoder: Encoder, space: str):
        self.encoder, self.space, self.spelled, self.old = encoder, space, space.translate(SPELLING), {}
        self.tokenize, self.code, self.marks = encoder.tokenizer.model.tokenize, encoder.code, encoder.marks

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            if word.isascii():
                if word.isalpha():
                    # One pre-token, spelled as it is.
                    found = array.array(self.code, [x.id for x in self.tokenize(self.spelled + word)]).tobytes()
                elif (mark := word[-1:]) in self.marks and (stem := word[:-1]).isalpha():
                    found = self[stem] + self.marks[mark]
                else:
                    found = self.encoder._unit(word, self.space)
            else:
                found = self.encoder._unit(word, self.space)
        self[word] = found
        return found

    def age(self) -> None:
        if len(self) > CACHE_WORDS:
            self.old = dict(self)
            self.clear()


class Encoder:
    """A tokenizers file as a function from texts to id arrays, with the end id appended.

    Under byte-level pre-tokenization without a normalizer, ids of a text are
    those of its words in turn, a word taking the one space before it; a line
    feed between two words stands alone. So words are encoded by the library
    once and remembered. A text with other white space next to a space or a
    line feed, one that spells an added token of the file, and any text under
    another kind of tokenizer, is encoded whole. PROBE is encoded both ways when
    the file is loaded; where they differ, every text is encoded whole.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 65_536 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        before = json.loads(self.tokenizer.to_str())
        pre = before.get("pre_tokenizer") or {}
        model = before.get("model") or {}
        self.by_word = (
            before.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        )
        self.added = [x["content"] for x in before.get("added_tokens") or []]
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.feed = self._whole(["\n"])[0]
        self.marks: dict[str, bytes] = {}
        self.known = {"": Memory(self, ""), " ": Memory(self, " ")}
        if self.by_word and [self._words(x) for x in PROBE] != self._whole(PROBE):
            self.by_word = False

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.dtype).tobytes() for x in found]

    def _bpe(self, word: str) -> bytes:
        """Ids of one pre-token: the library's model on its bytes in the vocabulary's spelling."""
        return array.array(self.code, [x.id for x in self.tokenizer.model.tokenize(word.translate(SPELLING))]).tobytes()

    def _unit(self, word: str, space: str) -> bytes:
        """Ids of a word and the space before it: letters are one pre-token, marks after them one more; others go through the whole tokenizer."""
        cut = LATIN.fullmatch(word)
        if cut is None:
            if not word or word[0].isspace() or word[-1].isspace():
                raise Uncut
            return self._whole([space + word])[0]
        mark = cut[2]
        if not mark:
            return self._bpe(space + word)
        if mark not in self.marks:
            if len(self.marks) > CACHE_WORDS:
                self.marks.clear()
            self.marks[mark] = self._whole([mark])[0]
        return self.known[space][cut[1]] + self.marks[mark]

    def _words(self, text: str) -> bytes | None:
        """Ids of a text by lines and words, or None where that might not be the same as of the whole.

        Spaces or line feeds beside each other, or at an end, leave an empty word, which is never known.
        """
        if not self.by_word or any(x in text for x in self.added):
            return None
        first, later = self.known[""], self.known[" "].__getitem__
        try:
            lines = []
            for line in text.split("\n"):
                words = iter(line.split(" "))
                lines.append(first[next(words)] + b"".join(map(later, words)))
        except Uncut:
            return None
        return self.feed.join(lines)

    def _some(self, batch: list[str]) -> list[bytes]:
        for known in self.known.values():
            known.age()
        out = [self._words(text) for text in batch]
        whole = iter(self._whole([text for text, x in zip(batch, out) if x is None]))
        return [next(whole) if x is None else x for x in out]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """Serialized ids in the order of the texts; some texts are encoded at a time to bound memory."""
        batch, chars = [], 0
        for text in texts:
            batch.append(text)
            chars += len(text)
            if chars >= ENCODE_CHARS:
                yield from (x + self.end for x in self._some(batch))
                batch, chars = [], 0
        yield from (x + self.end for x in self._some(batch))


def encoder_of(path: str, end_id: int) -> Encoder:
    """The worker's encoder, with the words that it remembers from tasks before."""
    return held("tokens", (path, end_id), lambda: Encoder(path, end_id))


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, sample: int = SAMPLE, size: int = DICT_BYTES) -> bytes:
    """Dictionary bytes from the serialized ids of a bounded sample; empty where there is too little."""

    # Whole-number hashes of the id thin the scan to about twice the sample; the least hashes of id and text are taken.
    share = min(1.0, 2 * sample / max(1, docs.count()))
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    head = F.left(F.coalesce("text", F.lit("")), F.lit(SAMPLE_CHARS)).alias("text")
    rows = some.select(head, F.xxhash64("doc_id", "text").alias("h")).orderBy("h", "text").limit(sample).collect()  # at most sample * SAMPLE_CHARS characters
    encoder = encoder_of(tokenizer, end_id)
    samples = sorted(x[: SAMPLE_IDS * encoder.dtype.itemsize] for x in encoder([r["text"] for r in rows]))
    if sum(map(len, samples)) < 8 * 1024 or len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_store(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", partitions: int | None = None, sample: int = SAMPLE, part_bytes: int = PART_BYTES) -> dict:
    """Encode docs into a store at `folder` and return its manifest."""
    spark = docs.sparkSession
    small_batches(spark)
    if not isinstance(docs.schema[doc_id].dataType, T.IntegralType):
        raise TypeError(f"{doc_id} must be a whole number")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = train_dictionary(docs, tokenizer, end_id, sample)
    digest = hashlib.sha256(shared).digest()

    def write(batches):
        encoder = encoder_of(tokenizer, end_id)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared) if shared else None, write_content_size=True)
        part = TaskContext.get().partitionId()
        file, offset, total = None, 0, 0
        index = {name: array.array(code) for name, code in INDEX}
        try:
            for batch in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
                for i, ids in zip(batch.column(0).to_pylist(), encoder(["" if t is None else t for t in batch.column(1).to_pylist()])):
                    if file is None:
                        file = storage.AtomicFile(folder, f"part-{part:06d}.gwt")
                        file.write(MAGIC + digest)
                        offset = file.size
                    frame, n = compressor.compress(ids), len(ids) // encoder.dtype.itemsize
                    file.write(frame)
                    for column, value in zip(index.values(), (i or 0, i is None, offset, len(frame), n)):
                        column.append(value)
                    offset += len(frame)
                    total += n
            if file is None:
                return
            documents = len(index["id"])
            for column in index.values():
                if sys.byteorder == "big":
                    column.byteswap()
                file.write(column.tobytes())
            file.write(struct.pack("<QQ", offset, documents) + MAGIC)
            sha = file.commit()
        except BaseException:
            if file is not None:
                file.abort()
            raise
        row = {"part": part, "name": file.name, "documents": documents, "ids": total, "bytes": file.size, "sha256": sha}
        yield pa.RecordBatch.from_pylist([row])

    # Null ids come first: the key (LOW, hash), as has an id of that number.
    h, d = F.coalesce("doc_id", F.lit(ranges.LOW)), F.xxhash64("text")
    keys = materialize(docs.select(h.alias("h"), d.alias("d"), (F.coalesce(F.octet_length("text"), F.lit(0)) + INDEX_BYTES).cast("long").alias("size")), "token-keys")
    bounds, _ = ranges.splitters(keys, lambda total, n: ranges.even_cuts(total, n, partitions or tasks_for(spark), part_bytes))
    dealt = ranges.deal(docs, h, d, bounds).sortWithinPartitions(F.asc_nulls_first("doc_id"), d)
    rows = dealt.mapInArrow(write, "part long, name string, documents long, ids long, bytes long, sha256 string").collect()  # one row a file
    parts, start = [], 0
    for r in sorted(rows, key=lambda r: r["part"]):
        parts.append({k: r[k] for k in ("name", "documents", "ids", "bytes", "sha256")} | {"start": start})
        start += r["ids"]
    width = encoder_of(tokenizer, end_id).dtype.itemsize
    manifest = {"format": MAGIC.decode(), "id_bytes": width, "end_id": end_id, "dictionary_sha256": digest.hex(), "documents": sum(p["documents"] for p in parts), "ids": start, "parts": parts}
    storage.put(folder, "shared.zdict", shared)
    storage.put(folder, "manifest.json", json.dumps(manifest).encode())
    return manifest


def _index(tail: bytes, count: int) -> dict[str, np.ndarray]:
    found, at = {}, 0
    for name, code in INDEX:
        kind = np.dtype(code).newbyteorder("<")
        found[name] = np.frombuffer(tail, kind, count, at)
        at += count * kind.itemsize
    return found


class Part:
    """One part file, open for reading."""

    def __init__(self, folder: str, name: str, shared: bytes, width: int):
        fs, root = storage.resolve(folder)
        self.file = fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        if self.file.read_at(8, 0) != MAGIC or self.file.read_at(8, size - 8) != MAGIC:
            raise ValueError(f"{name} is no token file")
        if self.file.read_at(32, 8) != hashlib.sha256(shared).digest():
            raise ValueError(f"{name} needs another dictionary")
        begin, count = struct.unpack("<QQ", self.file.read_at(16, size - 24))
        self.index = _index(self.file.read_at(size - 24 - begin, begin), count)
        self.decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared) if shared else None)
        self.dtype = np.dtype(f"<u{width}")

    def ids(self, k: int) -> np.ndarray:
        frame = self.file.read_at(int(self.index["length"][k]), int(self.index["offset"][k]))
        return np.frombuffer(self.decompressor.decompress(frame), self.dtype)

    def all_ids(self) -> Iterator[np.ndarray]:
        """The ids of every document in turn; the file is read in blocks of READ_BYTES or a frame, once."""
        block, begin, last = b"", 0, int(self.index["offset"][-1] + self.index["length"][-1]) if len(self.index["id"]) else 0
        for at, length in zip(self.index["offset"].tolist(), self.index["length"].tolist()):
            if at + length > begin + len(block):
                block, begin = self.file.read_at(min(max(length, READ_BYTES), last - at), at), at
            yield np.frombuffer(self.decompressor.decompress(block[at - begin : at - begin + length]), self.dtype)

    def close(self) -> None:
        self.file.close()


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (bytes, little-endian unsigned 32 bits) of every document, read from the files."""
    manifest = json.loads(storage.get(folder, "manifest.json"))
    shared, width = storage.get(folder, "shared.zdict"), manifest["id_bytes"]
    if hashlib.sha256(shared).hexdigest() != manifest["dictionary_sha256"]:
        raise ValueError("the dictionary is not the manifest's")
    parts = [(p["name"], p["start"]) for p in manifest["parts"]]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches):
        for batch in batches:
            for name, start in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                part, rows, size = Part(folder, name, shared, width), [], 0
                for k, ids in enumerate(part.all_ids()):
                    if len(ids) != part.index["n"][k]:
                        raise ValueError(f"{name}: document {k} has {len(ids)} ids")
                    rows.append((None if part.index["null"][k] else int(part.index["id"][k]), start, len(ids), ids.astype("<u4").tobytes()))
                    start += len(ids)
                    size += 4 * len(ids)
                    if size >= YIELD_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                part.close()

    files = spark.createDataFrame(parts, "name string, start long")
    return files.repartition(max(1, len(parts))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def read_document(folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of every document of that id: manifest, one index a part and one frame a document are read."""
    manifest, shared, found = json.loads(storage.get(folder, "manifest.json")), storage.get(folder, "shared.zdict"), []
    for p in manifest["parts"]:
        part = Part(folder, p["name"], shared, manifest["id_bytes"])
        found += [part.ids(int(k)) for k in np.flatnonzero((part.index["id"] == doc_id) & (part.index["null"] == 0))]
        part.close()
    return found
