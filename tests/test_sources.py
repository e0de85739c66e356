import pytest
from pyspark.sql import functions as F

from gramspan.plans import ordering
from gramspan.plans.ordering import OrderedKeys, rows_at, with_row_index
from gramspan.sources import TabularDataset, from_rows, read_csv, read_table


def test_shape_and_literal_rows(spark):
    ds = from_rows(spark, [[1, 2], [3, 4], [5, 6]], [1, 2, 3])
    assert (ds.n_samples(), ds.n_features()) == (3, 2)
    assert ds.shape().head().asDict() == {"n_samples": 3, "n_features": 2}
    with pytest.raises(ValueError):
        from_rows(spark, [[1], [2]], [1])
    with pytest.raises(ValueError):
        from_rows(spark, [])


def test_feature_binding_errors(spark):
    ds = from_rows(spark, [[1, 2]], [1])
    for bad in (["nope"], []):
        with pytest.raises(ValueError):
            TabularDataset(ds.df, bad)
    with pytest.raises(ValueError):
        TabularDataset(ds.df, ["x0"], "nope")
    with pytest.raises(ValueError):
        TabularDataset(ds.df.withColumn("s", F.lit("a")), ["s"])


def test_array_of_wrong_length_is_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<double>")
    ds = TabularDataset(df, "v")
    with pytest.raises(Exception, match="does not hold"):
        df.select(ds.features.vector()).collect()


@pytest.mark.parametrize("n,size,n_test", [(100, 0.2, 20), (5, 0.5, 3), (10, 0.3, 3), (3, 0.01, 0), (2, 0.99, 2)])
def test_ordered_split_is_disjoint_and_complete(spark, n, size, n_test):
    ds = from_rows(spark, [[i, 0] for i in range(n)], list(range(n)))
    shuffled = ds.with_df(ds.df.orderBy(F.xxhash64("row_idx")).repartition(3))
    train, test = shuffled.train_test_split(size)
    assert sorted(r["row_idx"] for r in train.df.collect()) == list(range(n - n_test))
    assert sorted(r["row_idx"] for r in test.df.collect()) == list(range(n - n_test, n))


def test_split_rejects_bad_sizes_and_missing_order(spark):
    ds = from_rows(spark, [[1], [2]])
    for bad in (0.0, 1.0, -0.1, 1.5):
        with pytest.raises(ValueError):
            ds.train_test_split(bad)
    with pytest.raises(ValueError):
        TabularDataset(ds.df, ["x0"]).train_test_split(0.5)


def test_split_of_a_key_with_ties_and_nulls(spark):
    rows = [(None, 1), (None, 2), (1, 3), (1, 4), (1, 5), (2, 6)]
    df = spark.createDataFrame(rows, "k long, v long")
    train, test = OrderedKeys(df, ["k"]).cut(4)
    assert train.count() == 4 and test.count() == 2
    assert sorted(r["v"] for r in train.unionByName(test).collect()) == [1, 2, 3, 4, 5, 6]
    train, test = OrderedKeys(df, ["k", "v"]).cut(2)
    assert sorted(r["v"] for r in train.collect()) == [1, 2]
    assert sorted(r["v"] for r in test.collect()) == [3, 4, 5, 6]


@pytest.mark.parametrize("near", [0.5, 0.1, 0.98])
def test_bracketed_cut_of_a_skewed_key(spark, near):
    # A third of the rows share one value of the leading key.
    k = F.when(F.col("id") % 3 == 0, F.lit(700)).otherwise(F.col("id"))
    df = spark.range(3000).select(k.alias("k"), F.xxhash64("id").alias("t"))
    want = sorted((r["k"], r["t"]) for r in df.collect())
    ordered = OrderedKeys(df, ["k", "t"], near=near)
    assert ordered.last - ordered.first < 3000
    # A wrong hint must not change the answer.
    for position in (int(3000 * near), 17):
        before, after = ordered.cut(position)
        assert sorted(map(tuple, before.collect())) == want[:position]
        assert after.count() == 3000 - position


def test_split_filter_reaches_the_scan(spark, sf):
    orders = TabularDataset(
        read_table(spark, sf, "orders"), ["o_totalprice"], order_by=["o_orderkey"]
    )
    train, _ = orders.train_test_split(0.25)
    plan = train.df._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(o_orderkey" in plan


@pytest.mark.parametrize("parts", [1, 7])
def test_row_index_matches_sorted_order(spark, parts):
    df = spark.range(500).select(F.xxhash64("id").alias("k"), "id").repartition(parts)
    got = [r["k"] for r in with_row_index(df, ["k"]).orderBy("row_idx").collect()]
    assert got == sorted(got) and len(set(got)) == 500


def test_rows_at_small_and_large_positions(spark, monkeypatch):
    df = spark.range(300).select((F.lit(299) - F.col("id")).alias("k"))
    want = [5, 0, 250]
    assert [r["k"] for r in rows_at(df, ["k"], want)] == want
    monkeypatch.setattr(ordering, "TOP_K_LIMIT", 1)
    assert [r["k"] for r in rows_at(df, ["k"], want)] == want


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("feature1, feature2,target\n1, 2.5 ,3\n-4,5e1,6\n7,8,9,10\n")
    ds = read_csv(spark, str(path))
    assert ds.features.names == ("feature1", "feature2") and ds.label == "target"
    assert sorted(tuple(r) for r in ds.df.collect()) == [
        (-4.0, 50.0, 6.0),
        (1.0, 2.5, 3.0),
        (7.0, 8.0, 9.0),
    ]


@pytest.mark.parametrize("row", ["1,x,3", "1,2", "1,,3"])
def test_csv_bad_rows_stop_any_selection(spark, tmp_path, row):
    path = tmp_path / "a.csv"
    path.write_text(f"a,b,y\n1,2,3\n{row}\n")
    with pytest.raises(Exception, match="complete numeric row"):
        read_csv(spark, str(path)).df.select("a").collect()


def test_csv_without_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b,y\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(path))
