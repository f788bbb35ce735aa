"""Z-order: the key, and what the footers of the written files allow to skip."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from layerforge.context import new_run_dir
from layerforge.functions import clustering as Z
from layerforge.plans import curate as C
from layerforge.testing import registry as RG
from layerforge.testing import tables as TT

SF = "/root/testdata/sf0.01"


def test_bins_and_interleaved_bits(spark):
    rows = spark.createDataFrame([(None,), (0,), (9,), (10,), (15,), (20,), (99,)], "x int")
    got = [r[0] for r in rows.select(Z.bin_number(F.col("x"), [10, 20, 30])).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 3]
    assert rows.select(Z.bin_number(F.col("x"), [])).distinct().collect()[0][0] == 0
    key = spark.range(1).select(Z.interleave([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert key == 0b100111


def test_bounds_of_awkward_columns(spark):
    df = spark.createDataFrame([(None, "é"), (None, "z"), (None, None)] + [(None, "hot")] * 500, "a int, b string")
    a, b = Z.bin_bounds(df, ["a", "b"], 3)
    assert a == [] and b == sorted(set(b)) and "hot" in b
    out = Z.clustered(df, ["a", "b"], 4)
    assert out.columns == ["a", "b"] and out.count() == 503
    assert Z.clustered(df.limit(0), ["a", "b"], 4).count() == 0


def files_to_read(path, column, value):
    """Files whose footer allows the value in the column."""
    n = 0
    for f in glob.glob(path.removeprefix("file:") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        n += any(s.min <= value <= s.max for s in stats)
    return n


def test_either_column_alone_prunes_files(spark):
    path, sorted_path = new_run_dir(spark, "z"), new_run_dir(spark, "sorted")
    items = C.curate_order_items(TT.raw_order_items(spark, SF), RG.B1).select("order_id", "seller_id", "product_id", "price")
    Z.clustered(items, ["seller_id", "product_id"], 64).write.parquet(path)
    items.repartitionByRange(64, "seller_id", "product_id").write.parquet(sorted_path)
    n = len(glob.glob(path.removeprefix("file:") + "/*.parquet"))
    assert n >= 48 and spark.read.parquet(path).exceptAll(items).count() == 0
    for column in ("seller_id", "product_id"):
        values = [r[0] for r in items.select(column).distinct().orderBy(column).collect()]
        probes = values[5::len(values) // 20]
        read = [files_to_read(path, column, v) for v in probes]
        assert sum(read) / len(read) <= n / 3, (column, read)
    # sorted by seller first, a product is anywhere
    probes = [r[0] for r in items.select("product_id").distinct().orderBy("product_id").collect()][5::150]
    assert min(files_to_read(sorted_path, "product_id", v) for v in probes) > n / 2


def test_a_hot_pair_is_cut_over_files(spark):
    hot = spark.range(3000).select(F.lit(1).alias("a"), F.lit(2).alias("b"), "id").unionByName(
        spark.range(3000).select((F.col("id") % 50).cast("int").alias("a"), (F.col("id") % 31).cast("int").alias("b"), "id"))
    sizes = [r[1] for r in Z.clustered(hot, ["a", "b"], 12).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2000 and sum(sizes) == 6000
