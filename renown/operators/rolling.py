"""Rolling window of complete calendar months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rolling_months(monthly: DataFrame, as_of, months_back: int = 3) -> DataFrame:
    """Views of each page over the last complete months before ``as_of``.

    ``monthly`` has (page_title, month DATE, views). The result carries the
    window bounds as ``YYYYMM0100``, the views of the page's last month in the
    window and the sum; pages without views in the window give no row.
    """
    this_month = F.trunc(F.lit(as_of).cast("date"), "month")
    start = F.add_months(this_month, -months_back)
    end = F.add_months(this_month, -1)
    return (
        monthly.where(F.col("month").between(start, end))
        .groupBy("page_title")
        .agg(
            F.max_by("views", "month").alias("latest_month_views"),
            F.sum("views").alias("total_window_views"),
        )
        .select(
            "page_title",
            F.concat(F.date_format(start, "yyyyMM"), F.lit("0100")).alias("period_start"),
            F.concat(F.date_format(end, "yyyyMM"), F.lit("0100")).alias("period_end"),
            "latest_month_views",
            "total_window_views",
        )
    )
