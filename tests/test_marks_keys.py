from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import T, rows
from tidewater import config as C
from tidewater.operators.keys import assign_keys, next_key
from tidewater.operators.marks import (extract_delta, initial_marks, late_rows, read_mark,
                                       read_marks, write_mark)

SALES = "id long, transaction_date timestamp_ntz"


def test_mark_defaults_and_update(spark):
    marks = initial_marks(spark, ["sales"])
    assert read_mark(marks, "sales") == C.EPOCH_MARK
    assert read_mark(marks, "nothing_here") == C.EPOCH_MARK  # no row: 1900-01-01
    marks = write_mark(marks, "sales", T("2024-01-05 10:00:00"), "2024-01-06 00:00:00")
    marks = write_mark(marks, "products", T("2024-01-02 00:00:00"), "2024-01-06 00:00:00")
    got = read_marks(marks)
    assert got == {"sales": "2024-01-05 10:00:00", "products": "2024-01-02 00:00:00"}
    assert marks.count() == 2


def test_strict_extract_and_late_rows(spark):
    src = spark.createDataFrame([(1, T("2024-01-01 00:00:00")), (2, T("2024-01-02 00:00:00")),
                                 (3, T("2024-01-03 00:00:00"))], SALES)
    mark = "2024-01-02 00:00:00"
    assert [r["id"] for r in rows(extract_delta(src, "transaction_date", mark), "id")] == [3]
    assert extract_delta(src, "transaction_date", "2024-01-03 00:00:00").isEmpty()
    mirror = spark.createDataFrame([(1,)], "id long")
    # row 2 sits exactly at the mark and never reached the mirror
    assert [r["id"] for r in rows(late_rows(src, mirror, "transaction_date", mark), "id")] == [2]


def test_assign_keys_matches_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 10007).alias("nk"),
                                     (F.col("id") % 3).alias("payload"))
    keyed = assign_keys(df, "k", ["nk"], start=100, num_partitions=7)
    brute = df.withColumn("k", F.row_number().over(Window.orderBy("nk")) + 100)
    assert sorted(map(tuple, keyed.select("k", "nk", "payload").collect())) == \
        sorted(map(tuple, brute.select("k", "nk", "payload").collect()))
    assert next_key(keyed, "k") == 5100


def test_assign_keys_empty_and_single(spark):
    empty = spark.createDataFrame([], "nk long")
    assert assign_keys(empty, "k", ["nk"], start=5).count() == 0
    one = spark.createDataFrame([(42,)], "nk long")
    assert [r["k"] for r in assign_keys(one, "k", ["nk"], start=5).collect()] == [6]
    assert next_key(empty.withColumn("k", F.lit(1)), "k") == 0
