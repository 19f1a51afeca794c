"""Warehouse and mart tables as temporary views, for SQL written against the table names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewlog.plans import mart, pipeline
from viewlog.plans import warehouse as wh
from viewlog.sinks import files

# The published names of the stored tables.
WAREHOUSE_VIEWS = {
    "DimContract": wh.CONTRACTS,
    "DimDevice": wh.DEVICES,
    "FactViewingSession": wh.FACTS,
    "FactContractSummary": wh.SUMMARY,
}
MART_VIEWS = {
    "DM_ContractAnalytics": mart.ANALYTICS,
    "DM_DailySummary": mart.DAILY,
    "DM_ContentTypeTrend": mart.TREND,
}
MEDIA_VIEW = "Fact_MediaReport"


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Register every table below ``root`` as the last whole refresh left it; returns the view names."""
    store, marts, reports = pipeline.committed(spark, root)
    small = wh.SmallDims.build(spark)
    views: dict[str, DataFrame] = {
        "Staging_RawData": files.read_staging(spark, pipeline.staging_folder(root)),
        "DimDate": small.date,
        "DimApp": small.app,
        "DimContentType": small.content_type,
        **{view: store.read(table) for view, table in WAREHOUSE_VIEWS.items()},
        **{view: marts.read(table) for view, table in MART_VIEWS.items()},
        MEDIA_VIEW: reports.read(mart.MEDIA),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)
