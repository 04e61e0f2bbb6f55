from pyspark.sql import functions as F

from tests.conftest import D
from tidewater.plans import procedures as P
from tidewater.sources.synthetic import COUNTRIES, GROUPS, synthetic_sources


def test_procedures_log_and_publish(spark):
    from tests.conftest import SMALL
    from tidewater.plans.scenario import warehouse
    wh = warehouse(spark, SMALL)
    rep = P.aggregate_sales_report(wh, D("1998-01-01"), D("1998-12-31"))
    assert spark.table("temp_sales_report").count() == rep.count() > 0
    met = P.refresh_customer_metrics(wh, "2001-11-05 07:00:00")
    assert "calculated_at" in met.columns and met.count() == wh.table("dwh_dim_customers") \
        .filter("is_current").count()
    logs = {r["process_name"]: r for r in wh.log.rows.values()}
    assert logs["sp_aggregate_sales_report"]["status"] == "SUCCESS"
    assert logs["sp_aggregate_sales_report"]["rows_processed"] == rep.count()
    assert '"output_table": "customer_metrics"' in logs["sp_refresh_customer_metrics"]["additional_info"]
    top = P.top_by_transactions(met).collect()
    assert len(top) == 10 and top[0]["total_transactions"] >= top[-1]["total_transactions"]
    # the pipeline persisted its own run log
    assert wh.store.read("etl_logs").filter("status = 'SUCCESS'").count() >= 20


def test_failed_procedure_is_logged(spark):
    from tests.conftest import SMALL
    from tidewater.plans.scenario import warehouse
    wh = warehouse(spark, SMALL)
    try:
        P.aggregate_sales_report(wh, "not-a-date", D("1998-12-31"))
    except Exception:
        pass
    last = wh.log.rows[max(wh.log.rows)]
    assert last["process_name"] == "sp_aggregate_sales_report" and last["status"] == "FAILED"
    assert last["error_message"]


def test_synthetic_sources(spark):
    src = synthetic_sources(spark, customers=50, products=10, sales=300, seed=3)
    assert [src[k].count() for k in ("customers", "products", "sales")] == [50, 10, 300]
    s = src["sales"].agg(F.min("qty"), F.max("qty"), F.min("customer_id"), F.max("customer_id"),
                         F.min("product_id"), F.max("product_id")).first()
    assert 1 <= s[0] <= s[1] <= 10 and 1 <= s[2] <= s[3] <= 50 and 1 <= s[4] <= s[5] <= 10
    assert {r[0] for r in src["customers"].select("country").distinct().collect()} <= set(COUNTRIES)
    assert {r[0] for r in src["products"].select("group_name").distinct().collect()} <= set(GROUPS)
