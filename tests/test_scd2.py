from tests.conftest import D, rows
from tidewater.operators.scd2 import empty_dimension, scd2_merge

SNAP = "customer_id long, customer_name string, country string"


def merge(spark, dim, snap, day, ts):
    return scd2_merge(dim, spark.createDataFrame(snap, SNAP), "customer_id",
                      ["customer_name", "country"], "customer_key", day, ts)


def test_scd2_new_same_changed_absent(spark):
    dim0 = empty_dimension(spark, "customer_key", "customer_id", ["customer_name", "country"])
    dim1 = merge(spark, dim0, [(1, "Ann", "US"), (2, "Bob", "UK"), (3, "Cid", None)],
                 D("2024-01-01"), "2024-01-01 06:00:00")
    assert [(r["customer_key"], r["customer_id"]) for r in rows(dim1, "customer_key")] == \
        [(1, 1), (2, 2), (3, 3)]
    # 1 unchanged, 2 changed country, 3 unchanged with null (null <=> null), 4 new, 5 absent
    dim1 = dim1.unionByName(spark.createDataFrame(
        [(9, 5, "Eve", "FR", D("2024-01-01"), D("9999-12-31"), True, None)],
        dim1.schema))
    dim2 = merge(spark, dim1, [(1, "Ann", "US"), (2, "Bob", "CA"), (3, "Cid", None),
                               (4, "Dan", "DE")], D("2024-02-01"), "2024-02-01 06:00:00")
    got = rows(dim2, "customer_key")
    by = {(r["customer_id"], r["is_current"]): r for r in got}
    assert len(got) == 6
    assert by[(2, False)]["customer_key"] == 2 and by[(2, False)]["valid_to"] == D("2024-02-01")
    assert by[(2, False)]["country"] == "UK"
    assert by[(2, True)]["country"] == "CA" and by[(2, True)]["valid_from"] == D("2024-02-01")
    assert by[(2, True)]["valid_to"] == D("9999-12-31")
    assert by[(3, True)]["customer_key"] == 3  # null compared equal: no new version
    assert by[(5, True)]["customer_key"] == 9  # absent from the snapshot: stays current
    # new keys continue after the maximum, ordered by natural key
    assert (by[(2, True)]["customer_key"], by[(4, True)]["customer_key"]) == (10, 11)
    # one current version per natural key
    cur = [r["customer_id"] for r in got if r["is_current"]]
    assert sorted(cur) == sorted(set(cur))


def test_scd2_changed_twice_in_a_day(spark):
    dim0 = empty_dimension(spark, "customer_key", "customer_id", ["customer_name", "country"])
    d = D("2024-03-01")
    dim1 = merge(spark, dim0, [(1, "Ann", "US")], d, "2024-03-01 01:00:00")
    dim2 = merge(spark, dim1, [(1, "Ann", "UK")], d, "2024-03-01 02:00:00")
    dim3 = merge(spark, dim2, [(1, "Ann", "FR")], d, "2024-03-01 03:00:00")
    got = rows(dim3, "customer_key")
    assert [(r["country"], r["is_current"]) for r in got] == \
        [("US", False), ("UK", False), ("FR", True)]
    # the middle version is an empty half-open interval [d, d)
    assert got[1]["valid_from"] == got[1]["valid_to"] == d
