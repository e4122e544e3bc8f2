"""Lookups inside arrays of structs, without exploding them."""
from pyspark.sql import Column, functions as F


def _c(x):
    return x if isinstance(x, Column) else F.col(x)


def label_value(labels, key: str) -> Column:
    """Value of the first label with this key, NULL when there is none."""
    return F.get(F.filter(_c(labels), lambda l: l["key"] == key), F.lit(0))["value"]


def credit_total(credits) -> Column:
    """Sum of the credit amounts, 0 for an empty or NULL array."""
    zero = F.lit(0).cast("decimal(38,9)")
    return F.coalesce(
        F.aggregate(
            _c(credits), zero,
            lambda acc, c: (acc + F.coalesce(c["amount"], zero)).cast("decimal(38,9)"),
        ),
        zero,
    )
