"""The JVM's 32-bit string hash as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_31 = 2**31
_TWO_32 = 2**32


def java_hash(code: Column) -> Column:
    """Hash of ``code`` over its UTF-16 units, as a long (``LAX`` gives 75139)."""
    digits = F.hex(F.encode(code, "UTF-16BE"))
    units = F.transform(
        F.sequence(F.lit(0), (F.length(digits) / 4).cast("int") - 1),
        lambda i: F.conv(F.substring(digits, i * 4 + 1, F.lit(4)), 16, 10).cast("long"),
    )
    folded = F.aggregate(
        units,
        F.lit(0).cast("long"),
        lambda h, unit: F.pmod(h * 31 + unit + F.lit(_TWO_31), F.lit(_TWO_32)) - F.lit(_TWO_31),
    )
    return F.when(F.length(code) > 0, folded).when(code.isNotNull(), F.lit(0).cast("long"))
