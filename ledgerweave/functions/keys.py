"""Keys and codes as formulas of a dimension's dense id, shared by parents and children."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerweave.functions import pools
from ledgerweave.functions.exprs import (
    case,
    code,
    cyclic_pick,
    every,
    literal_array,
    threshold_index,
    zero_pad,
)

# What a second round through a class's range of seven digits adds to the number.
ROUND = 10_000_000
# Shares no factor with the sum of the account classes' weights.
STRIDE = 61


def profit_center_nbr(id: Column) -> Column:
    return zero_pad(id, 7)


def cost_center_nbr(id: Column) -> Column:
    return code("CC", id, 6)


def customer_nbr(id: Column) -> Column:
    return code("CUST", id, 8)


def functional_area_cd(id: Column) -> Column:
    return code("FA", id, 4)


def company_cd(id: Column) -> Column:
    return (id + 1000).cast("string")


def company_currency(id: Column) -> Column:
    return cyclic_pick([currency for _, currency in pools.COMPANIES], id - 1)


def division_nbr(id: Column) -> Column:
    return zero_pad(id, 2)


def document_type_cd(id: Column) -> Column:
    return _listed([c for c, _ in pools.DOCUMENT_TYPES], id, code("Z", id, 2))


def version_nbr(id: Column) -> Column:
    return _listed([c for c, _ in pools.VERSIONS], id, code("V", id, 3))


def version_group(id: Column) -> Column:
    return _listed([g for _, g in pools.VERSIONS], id, F.lit("Other"))


def statement_item_cd(number: Column) -> Column:
    return code("FSI", number, 5)


def account_class_index(id: Column) -> Column:
    """Position of an account's class: ids go round the classes, which share them by weight.

    A round is as long as the weights' sum and takes them in steps of STRIDE, so that a few
    accounts, too, spread over the classes.  The class follows from the id alone.
    """
    weights = [c.weight for c in pools.ACCOUNT_CLASSES]
    total = sum(weights)
    place = F.pmod(F.pmod(id, F.lit(total)) * STRIDE, F.lit(total))
    return threshold_index(place / F.lit(float(total)), weights)


def account_number(id: Column, class_index: Column) -> Column:
    """A number whose last seven digits lie inside the range of the account's class.

    The digits before them count the rounds through that range.  So the number follows from
    the id and its class alone, and numbers are distinct however many accounts there are.
    """
    start = of_class(class_index, [c.start for c in pools.ACCOUNT_CLASSES]).cast("bigint")
    span = of_class(class_index, [c.end - c.start for c in pools.ACCOUNT_CLASSES])
    return start + F.pmod(id, span) + F.floor(id / span) * F.lit(ROUND).cast("bigint")


def gl_account_nbr(id: Column, style: str = "salted") -> Column:
    """The account dimension's key."""
    if style == "cyclic":
        prefixes = pools.CYCLIC_ACCOUNT_PREFIXES
        return case(
            (
                (F.pmod(id, F.lit(len(prefixes))) == i, code(prefix, id, width))
                for i, (prefix, width) in enumerate(prefixes)
            ),
            F.lit(None).cast("string"),
        )
    return account_number(id, account_class_index(id)).cast("string")


def of_class(class_index: Column, values: Sequence) -> Column:
    """The attribute of an account class."""
    return F.get(literal_array(values), class_index)


def active_unless_every(id: Column, k: int) -> Column:
    return every(id, k, "N", "Y")


def _listed(values: Sequence, id: Column, beyond: Column) -> Column:
    listed = F.get(literal_array(values), (id - 1).cast("int"))
    return F.when(id <= len(values), listed).otherwise(beyond)
