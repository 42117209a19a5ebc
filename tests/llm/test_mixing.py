import duckdb
import pytest
from pyspark.sql import functions as F

from lumetric.llm import mixing
from tests.llm.conftest import SF


def targets(sizes):
    """Water-filling by repeated sharing."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


def check(rows, close):
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = targets(sizes)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in own)
        assert all(r.source_size == sizes[s] and 0 <= r.taken <= 3 * r.size for r in own)
        assert all(r.taken == r.size * r.copies for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= close(own)


def test_documents(documents):
    rows = mixing.mix(documents).collect()
    check(rows, lambda own: max(r.size for r in own) / 2)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(documents.repartition(7)).collect()))


def test_sql_agrees(documents):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got)) == sorted(db.execute(mixing.ORACLE).fetchall())


def test_odd_rows_and_empty(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    check([r for r in rows], lambda own: max(r.size for r in own))
    assert mixing.mix(empty).collect() == []
    assert mixing.mixed(empty).collect() == []
    again = mixing.mixed(odd)
    assert again.columns == odd.columns
    assert again.count() == sum(r.copies for r in rows)


def test_hot_source_meets_its_target(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.expr("repeat('w ', cast(1 + id * 7919 % 400 as int))").alias("text"),
    )
    check(mixing.mix(rows).collect(), lambda own: 2)


def test_a_row_repeated_for_a_third_of_the_table(spark):
    text = F.expr("repeat('w ', cast(5 + id * 7919 % 20 as int))")
    rows = spark.range(600).select(
        F.col("id").alias("doc_id"), F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")).alias("source"),
        text.alias("text"),
    )
    again = spark.range(300).select(F.lit(9999).cast("long").alias("doc_id"), F.lit("c").alias("source"), F.lit("x " * 12).alias("text"))
    docs = rows.union(again)
    found = mixing.mix(docs).collect()
    check(found, lambda own: max(r.size for r in own) / 2)
    copies = {r.copies for r in found if r.doc_id == 9999}
    assert len(copies) > 1
    mixed = mixing.mixed(docs).groupBy("doc_id").count().collect()
    taken = {}
    for r in found:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies
    assert {r.doc_id: r["count"] for r in mixed} == {d: n for d, n in taken.items() if n}
    db = duckdb.connect()
    table = docs.toPandas()
    db.register("documents", table)
    got = [tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()]
    assert sorted(got) == sorted(db.execute(mixing.ORACLE).fetchall())


def test_importance_favours(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"),
        F.lit("one two three").alias("text"), (F.col("id") % 2).alias("good"),
    )
    taken = mixing.mix(rows, importance=F.when(F.col("good") == 1, 4.0).otherwise(1.0)).where("source = 'a'")
    share = {r.good: r.n for r in taken.groupBy((F.col("doc_id") % 2).alias("good")).agg(F.sum("copies").alias("n")).collect()}
    assert share[1] > 1.5 * share[0] > 0


@pytest.mark.parametrize("sizes", [{"a": 0}, {"a": 5}, {"a": 1, "b": 1, "c": 1000, None: 4}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))
