"""Masks for tagged columns.

The described behaviour is the only source for these: one mask per class.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linepulse.fixed import CLASS_BIRTH, CLASS_EMAIL, CLASS_LOCATION, CLASS_NAME, MASKED_NAME

OUTWARD = r"^\s*([A-Za-z]{1,2}[0-9][A-Za-z0-9]?)(?:\s*[0-9][A-Za-z]{2})?\s*\z"


def mask_name(name: Column) -> Column:
    return F.when(name.isNotNull(), F.lit(MASKED_NAME))


def mask_email(email: Column) -> Column:
    """Every character but ``@`` and ``.`` becomes a star."""
    return F.regexp_replace(email, r"[^@.]", "*")


def mask_birth(birth: Column) -> Column:
    """1 January of the year of birth."""
    return F.trunc(birth, "year")


def mask_postcode(postcode: Column) -> Column:
    """The outward code of a postcode, or of one that is masked already; any other text is hidden."""
    outward = F.regexp_extract(postcode, OUTWARD, 1)
    return F.when(postcode.isNotNull(), F.when(outward != "", outward).otherwise(MASKED_NAME))


MASKS = {
    CLASS_NAME: mask_name,
    CLASS_EMAIL: mask_email,
    CLASS_BIRTH: mask_birth,
    CLASS_LOCATION: mask_postcode,
}
