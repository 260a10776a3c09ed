"""Schema names made from e-mail addresses."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .numbers import col_of

_UNSAFE = "[^a-zA-Z0-9_]"


def schema_name(email: str | Column) -> Column:
    """Local part of the address, unsafe characters replaced by ``_``, lower case."""
    local_part = F.substring_index(col_of(email), "@", 1)
    return F.lower(F.regexp_replace(local_part, _UNSAFE, "_"))


def schema_name_for(email: str) -> str:
    """The same rule for one address on the driver."""
    return re.sub(_UNSAFE, "_", email.split("@", 1)[0]).lower()
