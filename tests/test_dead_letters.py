"""Rejects in one pass, and corrected ones back in exactly one batch."""

from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.context import new_run_dir
from layerforge.plans import dead_letters as D
from layerforge.sources import versions as V

B1, B2, B3 = (RunContext(batch_id=b) for b in ("b1", "b2", "b3"))


def rules():
    return {"price_missing": F.col("price").isNull(), "freight_zero": F.col("freight") == 0}


def items(spark):
    return spark.createDataFrame([(1, 5.0, 1.0), (2, None, 1.0), (2, None, 1.0), (3, None, 0.0), (4, 2.0, None), (5, 2.0, 0.0)],
                                 "id long, price double, freight double")


def fix(rows):
    return rows.withColumn("price", F.coalesce("price", F.lit(9.0)))


def roots(spark):
    return new_run_dir(spark, "rejects"), new_run_dir(spark, "ledger")


def test_one_pass_splits_and_a_retry_adds_nothing(spark):
    rejects, _ = roots(spark)
    reads = spark.sparkContext.accumulator(0)
    source = items(spark).mapInPandas(lambda it: (reads.add(len(p)) or p for p in it), "id long, price double, freight double")
    good, counts = D.split_write(source, "items", rules(), B1, rejects)
    assert counts == {"good": 2, "rejected": 4} and reads.value == 6                       # each row was read once
    assert sorted(r["id"] for r in good.collect()) == [1, 4] and good.columns == ["id", "price", "freight"]
    got = sorted((r["reject_reason"], r["row"]) for r in V.read(spark, rejects).collect())
    assert [g[0] for g in got] == ["freight_zero", "price_missing", "price_missing", "price_missing,freight_zero"]
    assert V.read(spark, rejects).select("reject_id").distinct().count() == 4
    D.split_write(items(spark), "items", rules(), B1, rejects)                             # the batch is run again
    assert V.read(spark, rejects).count() == 4
    none, counts = D.split_write(items(spark).limit(0), "items", rules(), B2, rejects)
    assert none.count() == 0 and counts["rejected"] == 0


def test_a_corrected_row_enters_one_batch(spark):
    rejects, ledger = roots(spark)
    D.split_write(items(spark), "items", rules(), B1, rejects)
    schema = items(spark).schema
    take = lambda ctx: sorted(map(tuple, D.claim(spark, rejects, ledger, "items", schema, fix, rules(), ctx).collect()))
    first = take(B2)
    assert first == [(2, 9.0, 1.0), (2, 9.0, 1.0)]                                         # the others still break a rule
    assert take(B2) == first                                                               # b2 was lost and is run again
    assert take(B3) == []
    left = D.open_rejects(spark, rejects, ledger, "items").select("reject_reason").collect()
    assert sorted(r[0] for r in left) == ["freight_zero", "price_missing,freight_zero"]
    assert D.open_rejects(spark, rejects, ledger, "orders").count() == 0


def test_two_batches_that_claim_at_once(spark, monkeypatch):
    rejects, ledger = roots(spark)
    D.split_write(items(spark), "items", rules(), B1, rejects)
    schema, got, real = items(spark).schema, {}, V.write_files
    take = lambda ctx: D.claim(spark, rejects, ledger, "items", schema, fix, rules(), ctx).count()

    def slow(*a, **kw):
        out = real(*a, **kw)
        monkeypatch.setattr(V, "write_files", real)
        got["b3"] = take(B3)
        return out
    V.replace(spark.createDataFrame([], D.LEDGER), ledger, "empty")
    monkeypatch.setattr(V, "write_files", slow)
    got["b2"] = take(B2)
    assert got == {"b3": 2, "b2": 0}
