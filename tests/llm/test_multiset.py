"""Document fingerprints (op 11)."""

import hashlib

import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from rollcall.llm import multiset as ms, queries


def test_query_against_sql(spark, tables):
    df = queries.op11_multiset_fingerprints(spark, tables)
    assert "Python" not in df._jdf.queryExecution().toString()
    assert spark_rows(df) == duck_rows(connect(tables), ms.SQL)


def lanes_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.lanes for r in ms.fingerprints(rows).collect()}


def test_order_of_paragraphs_is_free_and_their_number_is_not(spark):
    got = lanes_of(spark, ["a b c\nd e\n\nf", "f\na b c\n\nd e", "a b c\nd e\nf", "a b c\nd e\n\nf\nf", "a b c d e\n\nf", "", "\n"])
    assert got[0] == got[1]
    assert len({tuple(v) for v in got.values()}) == 6


def test_putting_in_and_taking_out(spark):
    got = lanes_of(spark, ["one two\nthree", "four five six. Seven!", "one two\nthree\nfour five six. Seven!"])
    rows = spark.createDataFrame([(got[0], got[1], got[2])], "a array<long>, b array<long>, c array<long>")
    both, without = rows.select(ms.combine(F.col("a"), F.col("b")), ms.combine(F.col("c"), F.col("b"), -1)).first()
    assert both == got[2] and without == got[0]


def test_likeness(spark):
    words = [f"w{i}" for i in range(400)]
    lines = [" ".join(words[i : i + 20]) for i in range(0, 400, 20)]
    rows = [("\n".join(lines), "\n".join(lines[::-1]), 1.0, 0.0), ("\n".join(lines), "\n".join(lines[:10] + ["x y z"] * 0 + [f"{x} q" for x in lines[10:]]), 0.85, 0.2),
            ("\n".join(lines[:10]), "\n".join(lines[10:]), 0.0, 0.3), ("", "\n", 0.66, 0.2), ("a", "a", 1.0, 0.0)]
    got = lanes_of(spark, [t for r in rows for t in r[:2]])
    table = spark.createDataFrame([(i, got[2 * i], got[2 * i + 1]) for i in range(len(rows))], "i int, a array<long>, b array<long>")
    found = {r.i: r.x for r in table.select("i", ms.likeness(F.col("a"), F.col("b")).alias("x")).collect()}
    for i, (_, _, want, margin) in enumerate(rows):
        assert abs(found[i] - want) <= margin


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_next_documents(spark, odd_docs, blocks):
    """Whatever the blocks: each row is beside the one after it, in the order of id and text."""
    texts = ms.texts(odd_docs)
    rows = [(r.doc_id, r.text) for r in ms.next_documents(texts, blocks).filter("not ghost").select("doc_id", "text").collect()]
    assert sorted(rows, key=repr) == sorted(((r.doc_id, r.text) for r in texts.collect()), key=repr)
    hashes = {r.text: r.th for r in texts.select("text", F.xxhash64("text").alias("th")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = sorted(((*a, b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True)), key=repr)
    got = ms.next_documents(texts, blocks).filter("not ghost").select("doc_id", "text", "next_text").collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_one_id_on_many_rows(spark):
    """A hot id, and one text on most of its rows, is cut into blocks like any other."""
    rows = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("doc_id"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("same").alias("text"))
    found = ms.next_documents(rows, 16)
    sizes = [r["count"] for r in found.groupBy("block").count().collect()]
    assert max(sizes) < 2 * 4000 / 16 and len(sizes) == 16
    assert found.filter("not ghost and next_text is null").count() == 0
    assert found.filter("not ghost").count() == 4000
    assert found.filter("not ghost and text = 'same' and next_text <> 'same'").count() == 1


def test_odd_rows(spark, odd_docs, no_docs):
    assert ms.edited_documents(no_docs).count() == 0
    got = ms.edited_documents(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = ms.edited_documents(odd_docs.filter("doc_id = 8")).collect()
    text = odd_docs.filter("doc_id = 8").first().text
    half = len(text) // 2
    assert one[0].edited_sha256 == hashlib.sha256((text[: len(text) - half] + text[:half]).encode()).hexdigest()
    assert one[0].near_next == 1.0 and one[0].n_chars == len(text)
    long = next(r for r in got if r.doc_id == 10)
    assert long.n_chars == 5000
