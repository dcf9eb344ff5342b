"""The source roles the star schema is built from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Sources:
    """One DataFrame per raw source role, each with (at least) the columns of ``schemas``.

    ``payments`` is declared by the raw layout but no mart consumes it, so it is optional.
    """

    orders: DataFrame
    order_items: DataFrame
    reviews: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    category_translation: DataFrame
    payments: DataFrame | None = None
