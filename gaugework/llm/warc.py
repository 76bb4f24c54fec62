"""A deterministic, sharded WARC writer and its reader.

Records are sorted by exact ranges of (id, payload digest), one exchange for
all; a task writes its range as gzip members, one a record, each file with a
warcinfo record first, and rolls to a next file when the compressed size passes
`roll_bytes`. Headers and digests are made anew from the payload, dates and
record ids from the input alone, and the ranges come from exact counts, so a
repeated task, and a repeated call under the same settings, writes the same
bytes: a task writes under a temporary name, renames, and only files named in
`manifest.json`, put there last, belong to the archive. The jobs that count and
write run when `write_archive` is called.

Payloads that are equal (by SHA-1) and have at least `revisit_bytes` bytes are
stored once: with the smallest id as a response, with others as a revisit that
refers to it by record id, URI and date. Only digest, id and URL are exchanged
to find it, with partial minima first and a salted join, so copies of one
payload spread; the payloads themselves move once, in the exchange that sorts
them.

Defined results: a null payload is empty; a null id sorts first and is never
referred to unless all ids of its payload are null, which then are responses;
rows that repeat id and payload are stored each, with the same record type, in
one range; a payload of any length is one record. Ids that are no whole numbers
are refused. Empty tables give a manifest without files. Extra columns of any
name are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.llm import ranges, storage
from gaugework.llm.common import materialize, small_batches, tasks_for

ROLL_BYTES = 256 * 1024 * 1024
REVISIT_BYTES = 0
#: Bytes of a record beside its payload, about.
RECORD_BYTES = 500
SALTS = 16
LEVEL = 1
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("00000000-0000-0000-0000-000000000000")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _url(url: str | None) -> str:
    return "".join(url.split()) if url and url.strip() else "urn:unknown"


def record_id(page_id: int | None, uri: str, digest: str, copy: int = 0) -> str:
    """A record's id: of rows equal in id, URI and payload, each copy has its own."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, ' '.join(map(str, (page_id, uri, digest, *([copy] if copy else [])))))}>"


def _pack(headers: list[str], block: bytes) -> bytes:
    return "\r\n".join(["WARC/1.1", *headers, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info_record(name: str) -> bytes:
    """The record that opens a file."""
    block = b"software: gaugework\r\nformat: WARC File Format 1.1\r\n"
    return _pack(
        ["WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(None, name, digest_of(block))}", f"WARC-Date: {DATE}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields",
         f"WARC-Block-Digest: sha1:{digest_of(block)}"], block,
    )


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_url: str | None = None, copy: int = 0) -> bytes:
    """One WARC/1.1 record, uncompressed; with refers_to it is a revisit without payload."""
    uri = _url(url)
    digest = digest_of(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, uri, digest, copy)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha1:{digest_of(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        target = _url(refers_url)
        headers += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, target, digest)}",
            f"WARC-Refers-To-Target-URI: {target}",
            f"WARC-Refers-To-Date: {DATE}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return _pack(headers, block)


def digests(pages: DataFrame) -> DataFrame:
    """page_id, url, sha, size of every page, and `d`, the leading digits of sha: what is needed besides the payloads, written once."""
    payload = F.encode("html", "UTF-8")
    rows = pages.select("page_id", "url", F.sha1(payload).alias("sha"), F.octet_length(payload).cast("long").alias("size"))
    return materialize(rows.withColumn("d", _place("sha")), "payload-digests")


def _place(sha: Column | str) -> Column:
    return F.conv(F.left(sha, F.lit(15)), 16, 10).cast("long")


def revisits(light: DataFrame, revisit_bytes: int = REVISIT_BYTES, salts: int = SALTS) -> DataFrame:
    """page_id, d, sha, response, response_url: ids whose payload of that digest is stored with a smaller id.

    `copies` keeps unique payloads out of the join; the salt deals the ids of
    one payload over `salts` groups.
    """
    light = light.where(F.col("size") >= revisit_bytes)
    first = (
        light.groupBy("sha")
        .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", F.coalesce("url", F.lit("")).alias("url")))).alias("r"), F.count("*").alias("copies"))
        .where("r IS NOT NULL AND copies > 1")
        .select("sha", F.col("r.page_id").alias("response"), F.col("r.url").alias("response_url"), F.explode(F.array(*[F.lit(k) for k in range(salts)])).alias("salt"))
    )
    salted = light.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    found = salted.join(first, ["sha", "salt"]).where(~F.col("page_id").eqNullSafe(F.col("response")))
    return found.select("page_id", "d", "sha", "response", "response_url").distinct()


def write_archive(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    revisit_bytes: int = REVISIT_BYTES, roll_bytes: int = ROLL_BYTES, level: int = LEVEL, partitions: int | None = None,
) -> dict:
    """Write all rows as records below `folder` and return the manifest."""
    spark = pages.sparkSession
    small_batches(spark)
    if not isinstance(pages.schema[page_id].dataType, T.IntegralType):
        raise TypeError(f"{page_id} must be a whole number")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html")
    )

    def write(batches):
        part = TaskContext.get().partitionId()
        file, number, records, low, high = None, 0, 0, None, None
        known: dict = {}
        before, copy = None, 0

        def packed(data):
            packer = zlib.compressobj(level, zlib.DEFLATED, 31)
            return packer.compress(data) + packer.flush()

        def close():
            sha = file.commit()
            return pa.RecordBatch.from_pylist(
                [{"name": file.name, "records": records, "bytes": file.size, "sha256": sha, "first_id": low, "last_id": high}], schema=schema
            )

        schema = pa.schema([("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64())])
        try:
            for batch in batches:
                ids, urls, shas, responses, response_urls = (batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5))
                for k in range(batch.num_rows):
                    if not known or ids[k] != known["id"]:
                        known = {"id": ids[k]}
                    if shas[k] is not None:  # a mark; it precedes the pages of its id and digest
                        known[shas[k]] = (responses[k], response_urls[k])
                        continue
                    if file is None:
                        file = storage.AtomicFile(folder, f"part-{part:06d}-{number:04d}.warc.gz")
                        number, records, low, high = number + 1, 0, ids[k], None
                        file.write(packed(info_record(file.name)))
                    payload = batch.column(2)[k].as_buffer().to_pybytes()
                    refers = known.get(hashlib.sha1(payload).hexdigest(), (None, None)) if len(known) > 1 else (None, None)
                    same = (ids[k], urls[k], payload)
                    copy = copy + 1 if same == before else 0
                    before = same
                    file.write(packed(record(ids[k], urls[k], payload, *refers, copy)))
                    records, high = records + 1, ids[k]
                    if file.size >= roll_bytes:
                        yield close()
                        file = None
            if file is not None:
                yield close()
                file = None
        except BaseException:
            if file is not None:
                file.abort()
            raise

    # Marks of revisits travel with the pages in the one exchange; pages of their id and digest have the same key and come just after them.
    light = digests(rows)
    none = lambda kind: F.lit(None).cast(kind)
    marks = revisits(light, revisit_bytes).select("page_id", none("string").alias("url"), none("string").alias("html"), "sha", "response", "response_url", "d")
    h = F.coalesce("page_id", F.lit(ranges.LOW))
    bounds, _ = ranges.splitters(light.select(h.alias("h"), "d", (F.col("size") + RECORD_BYTES).alias("size")), lambda total, n: ranges.even_cuts(total, n, partitions or 2 * tasks_for(spark)))
    marked = rows.withColumns({"sha": none("string"), "response": none("long"), "response_url": none("string"), "d": _place(F.sha1(F.encode("html", "UTF-8")))}).unionByName(marks)
    dealt = ranges.deal(marked, h, F.col("d"), bounds).sortWithinPartitions(F.asc_nulls_first("page_id"), "d", F.asc_nulls_last("sha"), "url", F.xxhash64("html"))
    files = dealt.mapInArrow(write, "name string, records long, bytes long, sha256 string, first_id long, last_id long").collect()  # one row a file
    listed = [r.asDict() for r in sorted(files, key=lambda r: r["name"])]
    manifest = {"format": "WARC/1.1", "records": sum(r["records"] for r in listed), "files": listed}
    storage.put(folder, "manifest.json", json.dumps(manifest).encode())
    return manifest


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzip file, member by member; nothing larger than a record is held."""
    data, unpacker, out = b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                if out:
                    raise ValueError("the last record is cut off")
                return
        out.append(unpacker.decompress(data))
        data = unpacker.unused_data
        if unpacker.eof:
            head, _, rest = b"".join(out).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("not a WARC record")
            headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
            yield headers, rest[: int(headers["Content-Length"])]
            unpacker, out = zlib.decompressobj(31), []


def read_archive(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row a record: page_id, url, record_type, payload_digest, payload_bytes, refers_to, and payload if asked for.

    Digests of stored payloads are computed again and must agree with the header.
    """
    names = [(f["name"],) for f in json.loads(storage.get(folder, "manifest.json"))["files"]]
    fields = [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
    ] + [("payload", pa.binary())] * payloads
    schema = pa.schema(fields)

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, root = storage.resolve(folder)
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for headers, block in read_records(stream):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and digest_of(payload) != digest:
                            raise ValueError(f"{name}: payload digest of {headers['WARC-Record-ID']} does not agree")
                        size = len(payload) if kind == "response" else int(headers["X-Payload-Length"])
                        rows.append(
                            (int(headers["X-Page-ID"]) if headers["X-Page-ID"] else None, headers["WARC-Target-URI"], kind, digest, size,
                             int(headers["X-Refers-To-Page"]) if kind == "revisit" else None, *([payload] * payloads))
                        )
                        held += 200 + len(payload) * payloads
                        if held > 4_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ddl = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long" + ", payload binary" * payloads
    return spark.createDataFrame(names, "name string").repartition(max(1, len(names))).mapInArrow(read, ddl)
