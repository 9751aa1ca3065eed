"""Request-style filters over the master table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from docstrata.functions.fingerprint import column_list


def list_dockets(
    df: DataFrame,
    project_id: object,
    date_from: dt.date | str,
    date_to: dt.date | str,
    customer_order_id: str = "",
    project_col: str = "PROJECT_ID",
    date_col: str = "ORDER_DATE",
    customer_col: str = "CUSTOMER_ORDER_ID",
    day_col: str = "order_day",
) -> DataFrame:
    """Rows of one project with an order date in the two days and all between.

    ``customer_order_id=""`` means any.  The dates are a range on the column
    itself, so the filter reaches the file scan; a ``day_col``, where there is one, is
    restricted too, so a master laid out by day is read in the folders of those days.
    """
    after = dt.date.fromisoformat(str(date_to)) + dt.timedelta(days=1)
    rows = df.where(
        (F.col(project_col) == F.lit(project_id))
        & (F.col(date_col) >= F.lit(str(date_from)).cast("timestamp_ntz"))
        & (F.col(date_col) < F.lit(str(after)).cast("timestamp_ntz"))
    )
    if day_col in df.columns:
        rows = rows.where(F.col(day_col).between(F.lit(str(date_from)).cast("date"), F.lit(str(date_to)).cast("date")))
    return rows.where(F.col(customer_col) == customer_order_id) if customer_order_id else rows


def restrict_to_projects(
    df: DataFrame, projects: DataFrame, project_col: str = "PROJECT_ID", list_col: str | None = None
) -> DataFrame:
    """Rows of the listed projects; Spark broadcasts the list when it is small."""
    wanted = projects.select(F.col(list_col or project_col).alias(project_col))
    return df.join(wanted, project_col, "left_semi").select(*df.columns)


def preview(df: DataFrame, n: int = 10, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """``n`` rows: the first by ``order_by``, or any."""
    return (df.orderBy(*column_list(order_by)) if order_by else df).limit(n)
