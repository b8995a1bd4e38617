"""Products and purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palabre.functions.values import amount
from palabre.schemas import EXPENSIVE_PRICE, PRODUIT


def enrich_purchases(purchases: DataFrame, products: DataFrame, how: str = "inner") -> DataFrame:
    """Purchases with their amount and the product nested as ``produit_details``.

    Spark broadcasts the products if their size is known to be small; else both
    sides are shuffled and adaptive execution splits a product that sells most.
    """
    details = products.select(
        "produit_id",
        F.struct(*[F.col(f"`{c}`") for c in PRODUIT.names]).alias("produit_details"),
    )
    joined = purchases.join(details, "produit_id", how)
    total = amount(F.col("produit_details.prix"), F.col("quantite"))
    kept = [F.col(f"`{c}`") for c in purchases.columns if c != "montant_total"]
    return joined.select(*kept, total.alias("montant_total"), "produit_details")


def amount_mismatches(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """Purchases whose stated amount is not price times quantity."""
    prices = products.select("produit_id", "prix")
    expected = amount(F.col("prix"), F.col("quantite"))
    return (
        purchases.join(prices, "produit_id")
        .withColumn("montant_attendu", expected)
        .filter(~F.col("montant_total").eqNullSafe(F.col("montant_attendu")))
        .select(*purchases.columns, "montant_attendu")
    )


def filter_min_price(products: DataFrame, minimum: float = EXPENSIVE_PRICE) -> DataFrame:
    return products.filter(F.col("prix") >= minimum)


def branch_on_match(
    df: DataFrame, predicate: Column, if_any: str = "action1", if_none: str = "action2"
) -> DataFrame:
    """One row that names the branch to take; the scan stops at the first match."""
    found = df.filter(predicate).exists()
    branch = F.when(found, F.lit(if_any)).otherwise(F.lit(if_none))
    return df.sparkSession.range(0, 1, 1, 1).select(branch.alias("branch"))


def preview_table(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)
