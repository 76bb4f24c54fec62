"""The corpus queries against their SQL in DuckDB, the library, or a second implementation, on the same tables."""

import html as entities
import re

import duckdb
import numpy as np
import pytest

from gaugework.llm import queries
from gaugework.session import TABLES
from tests.test_catalog import plain, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    found = duck.execute(queries.ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns) and rows
    assert table(rows, df.columns) == table(found.fetchall(), columns) and plain(None) == "~"


def test_token_ids_equal_the_library(spark, duck):
    """Every document of sf0.01 by the library alone, in the order of ids."""
    import zlib

    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.01"
    library = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    rows = duck.execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    start, want = 0, {}
    for i, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.QUERIES["op6_token_store"](spark, sf).collect()}
    assert got == want


BLOCKS = "article blockquote body div h1 h2 h3 h4 li main ol p pre section table td tr ul".split()


def second_extractor(page):
    """Main text by patterns: what lies in the article element, without the elements that are never text, cut at block tags."""
    page = re.sub(r"(?is)<!--.*?-->|<(script|style|nav|header|footer|aside|form|title)\b.*?</\1\s*>", "", page or "")
    page = re.sub(r'(?is)<div class="ad">.*?</div>', "", page)
    inner = re.search(r"(?is)<article\b[^>]*>(.*)</article>", page)
    page = re.sub(rf"(?is)</?(?:{'|'.join(BLOCKS)})\b[^>]*>", "\x00", (inner[1] if inner else page))
    page = re.sub(r"(?is)<br\s*/?>", " ", page)
    blocks = (entities.unescape(re.sub(r"(?s)<[^>]*>", "", b)) for b in page.split("\x00"))
    return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def test_pages_equal_a_second_extractor(spark, duck):
    pages = duck.execute("SELECT page_id, html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    got = {r["page_id"]: r["text"] for r in queries.QUERIES["op10_html_text"](spark, "/root/testdata/sf0.01").collect()}
    assert {i: second_extractor(page) for i, page in pages} == got
