from __future__ import annotations

from conftest import SF_DIR, values

from viewlog.plans import mart, pipeline, report, views
from viewlog.sinks import files
from viewlog.sources import adapter


def test_sql_over_the_views_equals_the_report(spark, tmp_path):
    root = str(tmp_path)
    files.append_staging(adapter.staging_from_events(spark, SF_DIR), pipeline.staging_folder(root), "all")
    pipeline.refresh(spark, root, None)
    assert len(views.register_views(spark, root)) == 12
    by_sql = spark.sql("""
        SELECT DateValue AS time, TotalDuration_All / 3600.0D AS duration_hours FROM DM_DailySummary
        WHERE DateValue > DATE'2024-01-30' - INTERVAL 30 DAYS""")
    daily = pipeline.stores(spark, root)[1].read(mart.DAILY)
    assert values(by_sql) == values(report.daily_duration(daily, "2024-01-30"))
    joined = spark.sql("""
        SELECT count(*) AS n FROM FactViewingSession f JOIN DimDate d ON f.DateKey = d.DateKey
        JOIN DimContract c ON f.ContractKey = c.ContractKey JOIN DimDevice v ON f.DeviceKey = v.DeviceKey
        JOIN DimApp a ON f.AppKey = a.AppKey JOIN DimContentType t ON f.ContentTypeKey = t.ContentTypeKey""")
    assert joined.first().n == spark.table("FactViewingSession").count()
    assert spark.table("Staging_RawData").count() == 1000
