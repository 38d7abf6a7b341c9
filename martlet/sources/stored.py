"""The mart over a stored fact table.

Prices and order headers are joined once, when the fact is written by order month.
Every report then reads only the months and columns it needs, without a join to
products or orders.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import day
from martlet.sources.mart import Mart, Span, header, line_totals
from martlet.sources.tables import Tables

FACT = "sales_fact"
MONTH = "order_month"


def store_fact(m: Mart, tables: Tables) -> DataFrame:
    """Write the line-level fact by month.

    The rebalance hint gathers a month in as few tasks as its size needs: small
    months become one file, a month holding a third of all rows is split.
    """
    rows = m.sales().withColumn(MONTH, F.trunc("order_date", "month"))
    return tables.replace(FACT, rows.hint("rebalance", MONTH), partition_by=(MONTH,))


class StoredMart(Mart):
    """Same tables and reports as :class:`Mart`, with lines read from the fact."""

    def __init__(self, base: Mart, tables: Tables):
        super().__init__(base.spark, base.path, base.as_of)
        self.tables = tables

    @cached_property
    def fact(self) -> DataFrame:
        return self.tables.read(FACT)

    def _fact_in(self, span: Span | None) -> DataFrame:
        if span is None:
            return self.fact
        first = day(span.start.replace(day=1))
        months: Column = F.col(MONTH).between(first, day(span.end))
        return self.fact.filter(months & span.holds())

    def items_in(self, span: Span | None) -> DataFrame:
        return self._fact_in(span)

    @cached_property
    def items(self) -> DataFrame:
        return self.fact

    @cached_property
    def lines(self) -> DataFrame:
        return self.fact

    def lines_with(self, attributes: list[str], span: Span | None = None) -> DataFrame:
        products = self.products.select("product_key", *attributes)
        return self._fact_in(span).join(products, "product_key")

    def placed(self, span: Span | None = None) -> DataFrame:
        return self._fact_in(span)

    def sales(
        self, span: Span | None = None, dim: DataFrame | None = None, on: str | None = None
    ) -> DataFrame:
        rows = self._fact_in(span)
        return rows if dim is None else rows.join(dim, on)

    def order_sales(self, span: Span | None = None) -> DataFrame:
        return self._fact_in(span).groupBy("order_id").agg(*header(), *line_totals())
