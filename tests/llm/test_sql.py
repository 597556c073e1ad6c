"""The operators' queries against their registered SQL, over the smallest tables and over odd ones."""

import __spark_entry__ as entry_points
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from comparison import connect, differences
from conftest import ODD

from etalage.llm import catalogue

SQL = catalogue.oracle_sql()
# In the odd tables equal pages with equal ids have no defined response, and rows without an item id no defined name.
DOCUMENTS = [*ODD, *[(100 + i, f"only {i}\n Shared LINE \nend {i % 3}") for i in range(30)], (41, "é" * 3000), (41, "é" * 3000),
             *[(200 + i, f"start {i} " + " ".join(f"w{k}" for k in range(120)) + f" stop {i}") for i in range(12)]]
LANGS = [None, "", "en", "en", "de", "Ä", "z"]
PAGES = [(1, None, None), (2, "", ""), (3, "HTTP://WWW.Example.COM/en/x?a#b", "<p>same</p>"), (4, "http://example.com/en/", "<p>same</p>"),
         (5, "x://a.net/es/1", "<p>same</p>"), (6, "no scheme", None), (7, "http://com", "é" * 70_000), (8, "http://xcom/", "z"),
         (9, "http://net/fr/?q", ""), (10, "http://a.b://c.com/d", "a\r\n\r\nb"), (11, "http://www.example.com/en\n/", " "),
         (12, "a\nb://sub.NET/fr/\n?x", "\x00"), (13, "http://Ä.com/", "ß")]
ITEMS = [(1, " ".join(f"w{i}" for i in range(20, 40))), (2, "one Two"), (3, None), (4, ""), (5, "wort"), (2, "w1 w2 w3"),
         (12, " ".join(f"w{i}" for i in range(20, 33)))]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd-sql"))
    docs = [{"doc_id": i, "text": t, "lang": LANGS[n % len(LANGS)], "source": [None, "", "s"][n % 3], "n_chars": None if n % 4 == 0 else n}
            for n, (i, t) in enumerate(DOCUMENTS)]
    tables = {"documents": (docs, [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()),
                                   ("n_chars", pa.int64())]),
              "pages": ([dict(zip(("page_id", "url", "html"), p)) for p in PAGES],
                        [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]),
              "benchmark": ([dict(zip(("item_id", "text"), x)) for x in ITEMS], [("item_id", pa.int64()), ("text", pa.string())])}
    for name, (rows, fields) in tables.items():
        pq.write_table(pa.Table.from_pylist(rows, pa.schema(fields)), f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", list(SQL))
def test_smallest_tables(spark, small, name):
    """The registered SQL is whole: the query's rows, names and types over the whole table."""
    assert differences(entry_points.queries()[name](spark, small), connect(small), SQL[name]) == []


@pytest.mark.parametrize("name", list(SQL))
def test_odd_tables(spark, odd, name):
    assert differences(entry_points.queries()[name](spark, odd), connect(odd), SQL[name]) == []
