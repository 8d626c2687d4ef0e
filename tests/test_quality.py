import pytest
from pyspark.sql import functions as F, types as T

from parcelcast import contracts as K
from parcelcast.operators import cleaning, eda, profiling
from parcelcast.sources import files, standins

SF = "/root/testdata/sf0.001"


def test_key_check_counts_null_as_one_key(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "k bigint")
    r = profiling.key_check(df, ["k"], "t").first()
    assert (r.rows, r.unique_keys, r.duplicate_key_rows, r.is_unique) == (3, 2, 1, False)


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk bigint")
    parent = spark.createDataFrame([(1,), (None,)], "pk bigint")
    r = profiling.foreign_key_check(child, "fk", parent, "pk", "c->p").first()
    assert (r.child_rows_non_null, r.unknown_fk_rows, r.unknown_fk_unique_values, r.integrity_ok) == (3, 2, 1, False)


def test_missing_report_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, s string")
    rows = {r.column: (r.missing_count, r.missing_pct) for r in profiling.missing_report(df).collect()}
    assert rows == {"x": (2, 50.0), "s": (1, 25.0)}
    assert profiling.missing_report(df.fillna(0).fillna("z"), keep_zero=True).count() == 2


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k bigint")
    assert profiling.key_check(df, ["k"], "t").first().rows == 0
    assert profiling.duplicate_report({"t": df}).first().exact_duplicate_rows == 0


def test_bad_timestamps_become_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",), (None,)], "t string")
    got = profiling.parse_timestamps(df, ["t"]).filter(F.col("t").isNotNull())
    assert got.count() == 1


def test_cleaned_population_is_sound(spark):
    orders = standins.view(spark, SF, "orders_raw")
    cleaned = cleaning.clean_orders(orders)
    cleaning.raise_on_violations(cleaning.invariant_check(cleaned))
    assert cleaned.count() == 1003
    funnel = [r.orders for r in cleaning.population_funnel(orders).orderBy("position").collect()]
    assert funnel == sorted(funnel, reverse=True) and funnel[0] == 1500 and funnel[-1] == 1003


def test_invariants_are_raised(spark):
    cleaned = cleaning.clean_orders(standins.view(spark, SF, "orders_raw"))
    with pytest.raises(K.ContractError, match="order_id_is_unique"):
        cleaning.raise_on_violations(cleaning.invariant_check(cleaned.unionByName(cleaned.limit(1))))


def test_all_weekdays_are_listed(spark):
    df = spark.sql("SELECT timestamp '2024-01-01 10:00:00' AS order_purchase_timestamp, 1 AS late_delivery")
    rows = eda.weekday_late_rate(df).collect()
    assert [r.purchase_weekday for r in rows] == eda.WEEKDAYS and rows[0].orders == 1 and rows[6].orders is None


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    assert [r.orders for r in eda.histogram(df, "x", 2).orderBy("bin").collect()] == [1, 2]
    assert eda.histogram(df.filter("x = 5"), "x", 4).agg(F.sum("orders")).first()[0] == 1


def test_seeded_sample_does_not_depend_on_layout(spark):
    df = spark.range(500)
    one = {r.id for r in profiling.seeded_sample(df.repartition(7), 20, "id").collect()}
    two = {r.id for r in profiling.seeded_sample(df.coalesce(1), 20, "id").collect()}
    assert one == two and len(one) == 20


def test_missing_files_are_named(spark):
    with pytest.raises(K.ContractError, match="nothing.parquet"):
        files.require_files(spark, SF, ["orders.parquet", "nothing.parquet"], "*.parquet")


def test_fingerprint_follows_the_content(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"one")
    first = files.artifact_fingerprint(spark, str(tmp_path / "a")).first()
    (tmp_path / "a" / "x").write_bytes(b"two")
    assert first.files == 1 and first.sha256 != files.artifact_fingerprint(spark, str(tmp_path / "a")).first().sha256


def test_metadata_round_trip(spark, tmp_path):
    record = spark.sql("SELECT 'c' AS candidate, named_struct('low', 0.25D, 'rows', 3L) AS body")
    path = files.write_metadata(record, str(tmp_path / "m"))
    assert files.read_metadata(spark, path, record.schema).first() == record.first()


def test_csv_nan_and_bad_cells_become_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text("order_id,price\n1,2.5\n2,NaN\n3,soon\n4,\n")
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("price", T.DoubleType())])
    rows = files.read_csv(spark, str(tmp_path / "x.csv"), schema).orderBy("order_id").collect()
    assert [r.price for r in rows] == [2.5, None, None, None]
