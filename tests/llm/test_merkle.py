from __future__ import annotations

import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from adrlens.llm import merkle
from adrlens.llm.queries import QUERIES
from adrlens.llm.sql import ORACLE_SQL


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def tree(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """(root, proof of each leaf) level by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for proof, i in zip(proofs, at):
            run, place = runs[i // fanout], i % fanout
            proof.append(("".join(run[:place]), "".join(run[place + 1:])))
        at = [i // fanout for i in at]
        nodes = [h("".join(run)) for run in runs]
    return nodes[0], proofs


def brute_force(rows, fanout):
    """(group, order, digest) rows -> sorted (order, digest, subroot, root, proof)."""
    groups: dict = {}
    for group, order, digest in rows:
        groups.setdefault(group, []).append((order is not None, order or 0, digest, order))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {g: tree([r[2] for r in sorted(groups[g], key=lambda r: r[:3])], fanout) for g in names}
    root, over = tree([below[g][0] for g in names], fanout)
    return sorted(((r[3], r[2], below[g][0], root, proof + above) for g, above in zip(names, over)
                   for r, proof in zip(sorted(groups[g], key=lambda r: r[:3]), below[g][1])), key=repr)


ROWS = [("a", i, h(f"a{i}")) for i in range(100)] + [("b", i, h(f"b{i}")) for i in range(28)] + [
    ("c", 5, h("c")), (None, 1, h("n1")), (None, None, h("n2")), ("b", 3, h("b3")), ("é", 2, h("e")), ("Z", 9, h("z")),
    ("", 1, h("empty")), ("a", None, h("x")), ("a", None, h("x")), *(("d", i, h(f"d{i}")) for i in range(9))]


@pytest.mark.parametrize("fanout,levels", [(3, 1), (3, 2), (2, 1), (4, 2), (3, 7), (5, 0)])
def test_equals_brute_force(spark, fanout, levels):
    rows = spark.createDataFrame(ROWS, "source string, doc_id long, digest string").withColumn("block", F.lit("clash"))
    found = merkle.manifest(rows, "source", "doc_id", "digest", fanout, levels)
    got = sorted(((r["doc_id"], r["digest"], r["subroot"], r["root"], [tuple(s) for s in r["proof"]])
                  for r in found.collect()), key=repr)
    assert got == brute_force(ROWS, fanout)
    folded = found.select((merkle.folded(F.col("digest"), F.col("proof")) == F.col("root")).alias("ok"), "block").distinct().collect()
    assert [tuple(r) for r in folded] == [(True, "clash")]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 55, 82])
def test_every_size_of_one_group(spark, n):
    rows = [("s", i, h(str(i))) for i in range(n)]
    found = merkle.manifest(spark.createDataFrame(rows, "g string, i long, d string"), "g", "i", "d", 3, 1)
    got = sorted(((r["i"], r["d"], r["subroot"], r["root"], [tuple(s) for s in r["proof"]]) for r in found.collect()), key=repr)
    assert got == brute_force(rows, 3)


def test_leaf_spells_its_values(spark):
    row = spark.createDataFrame([(7, None, "é\n")], "i long, n string, t string").select(
        merkle.leaf([F.col("i"), F.col("n"), F.col("t")]).alias("leaf")).first()
    assert row["leaf"] == h("1:7-3:é\n")


def test_tampering_is_found_where_the_text_changes(spark, hard):
    docs = {(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{hard}/documents.parquet").collect()}
    changed = {i for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and "\n" in (t or "")}
    found = QUERIES["op12_merkle_manifest"](spark, hard).collect()
    assert len(found) == spark.read.parquet(f"{hard}/documents.parquet").count()
    assert {r["doc_id"] for r in found if not r["verified"]} == changed and changed
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in found)


def test_empty_table(spark, empty):
    assert QUERIES["op12_merkle_manifest"](spark, empty).isEmpty()


def test_sql_on_hard_rows(spark, hard):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{hard}/documents.parquet' WHERE doc_id IS NOT NULL")
    want = con.execute(ORACLE_SQL["op12_merkle_manifest"])
    names = [d[0] for d in want.description]
    docs = spark.read.parquet(f"{hard}/documents.parquet").where("doc_id is not null")
    path = f"{hard}/../with_ids"
    docs.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    got = QUERIES["op12_merkle_manifest"](spark, path).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
