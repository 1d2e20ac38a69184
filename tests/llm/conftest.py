"""Small tables with every hard case, as folders of Parquet files."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = ("the of and to in a is that it was for on are with as his they at be this from have or by one had not but "
         "what all were when we there can an your which their said if do will each about how up out them").split()
LONG = " ".join(WORDS[i * 7 % len(WORDS)] + str(i % 13) for i in range(12_000))
TEXTS = [
    (0, " ".join(WORDS)), (1, " ".join(WORDS)), (2, " ".join(WORDS[::-1])),
    (3, " ".join(WORDS[:-1]) + " altered"), (4, None), (5, ""), (6, "   \n\t "), (7, "!!! ... ###"),
    (8, "short"), (9, LONG), (10, "x" * 70_000), (11, 'password = "hunter2hunter" and AKIA' + "Q7" * 9),
    (12, "0123456789abcdef" * 3 + "\nüber Straße é"), (13, "a\u2028b\u00a0c  d <|endoftext|> \n\n e"), (None, "no id here at all"),
    (14, "日本語 のテキスト 🎉 " * 30), (2, " ".join(WORDS[::-1])), (15, "GHP ghp_" + "a1" * 20 + " token: abc"),
]
EXTRA = ("id", "row", "block", "bucket", "spans", "lang_pred", "score", "node", "n_tokens")


def documents(rows) -> pa.Table:
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    langs = ["en" if i % 3 else "de" if i % 2 else None for i in range(len(rows))]
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
                      "lang": pa.array(langs, pa.string()), "source": pa.array(["s"] * len(rows), pa.string()),
                      "n_chars": pa.array([len(t or "") for t in texts], pa.int64())})
    for name in EXTRA:
        table = table.append_column(name, pa.array([None] * len(rows), pa.string()))
    return table


def embeddings(rows) -> pa.Table:
    return pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()),
                     "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                     "label": pa.array([None] * len(rows), pa.int32()),
                     "node": pa.array([0] * len(rows), pa.int64()), "v": pa.array(["x"] * len(rows), pa.string())})


NAN, INF = float("nan"), float("inf")
VECTORS = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [0.99, 0.05, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None),
           (5, []), (6, [0.0, 0.0, 0.0]), (7, [NAN, 1.0, 0.0]), (8, [INF, 0.0, 0.0]), (9, [None, 1.0, 0.0]),
           (50, [2.0, 0.0, 0.0]), (100, [1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (101, [1e30, 0.0, 1e30])]
URLS = [(0, "http://a.example.com/x"), (1, "HTTPS://B.Example.NET/en/1?q"), (2, None), (3, "no scheme"), (4, ""),
        (5, "http://example.com/de/z#f"), (6, "http://org/fr/"), (7, "http://net"), (8, "http://x.co.uk:80/"),
        (None, "http://a.example.com/y"), (0, "http://a.example.com/x"), (9, "http://u@h.net?x://y")]


def pages(rows) -> pa.Table:
    return pa.table({"page_id": pa.array([r[0] for r in rows], pa.int64()), "url": pa.array([r[1] for r in rows], pa.string()),
                     "html": pa.array([None] * len(rows), pa.string()), "host": pa.array(["h"] * len(rows), pa.string()),
                     "n": pa.array([1] * len(rows), pa.int64())})


def labels(rows) -> pa.Table:
    return pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "quality": pa.array([r[1] for r in rows], pa.int32()),
                     "toxic": pa.array([r[2] for r in rows], pa.int32())})


LABELS = [(0, 0, 1), (0, 1, 0), (1, 0, 0), (5, None, 1), (6, None, None), (None, 1, 1), (8, 0, 1), (9, 1, 0)]


ITEMS = [(0, "The of AND to password"), (1, "short x123 ÜBER über"), (2, None), (3, ""), (None, "the of"), (1, "what all were"),
         (4, "no such terms: qqq zzz"), (5, "日本語 altered the"), (0, "The of AND to password")]


def benchmark(rows) -> pa.Table:
    return pa.table({"item_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
                     "term": pa.array(["t"] * len(rows), pa.string()), "score": pa.array([1] * len(rows), pa.int64())})


def write(folder, **tables) -> str:
    for name, table in tables.items():
        pq.write_table(table, folder / f"{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def hard(tmp_path_factory):
    return write(tmp_path_factory.mktemp("hard"), documents=documents(TEXTS), embeddings=embeddings(VECTORS),
                 pages=pages(URLS), labels=labels(LABELS),
                 benchmark=benchmark(ITEMS))


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return write(tmp_path_factory.mktemp("empty"), documents=documents([]), embeddings=embeddings([]),
                 pages=pages([]), labels=labels([]), benchmark=benchmark([]))


@pytest.fixture
def frame(spark):
    """A frame of (doc_id, text) rows."""
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
