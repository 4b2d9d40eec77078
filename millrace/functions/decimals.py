"""Doubles as decimal text, rounded from their exact binary value, halves to even.

``format_string`` rounds the shortest decimal digits half up instead: 0.0625 becomes 0.063 there, and 1.0005,
which as a double is a little less, 1.001.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import evaluated_once

_LIMB = 36
_MASK = (1 << _LIMB) - 1


def fixed(value: Column, places: int = 3, signed: bool = False) -> Column:
    """Text like ``0.062`` with 1 to 5 places; ``signed`` puts a plus before values that are not negative.

    Exact for absolute values under 2**52. The fraction is split into two limbs of 36 bits, which hold every
    bit of a double from 2**-20 on; smaller ones are zero in five places. Limbs are multiplied as integers, so
    what is cut off is compared with one half exactly. A null gives null, others ``nan``, ``inf`` or ``-inf``.
    """
    scale = 10**places

    def limbs(v: Column) -> Column:
        size = F.abs(v)
        whole = F.floor(size)
        high = (size - whole) * float(1 << _LIMB)
        first = F.floor(high)
        return F.struct(whole.alias("whole"), first.alias("high"), F.floor((high - first) * float(1 << _LIMB)).alias("low"))

    def scaled(x: Column) -> Column:
        low = x["low"] * scale
        high = x["high"] * scale + F.shiftright(low, _LIMB)
        return F.struct(
            x["whole"].alias("whole"), F.shiftright(high, _LIMB).alias("digits"),
            high.bitwiseAND(F.lit(_MASK)).alias("over"), low.bitwiseAND(F.lit(_MASK)).alias("rest"),
        )

    def rounded(x: Column) -> Column:
        half = F.lit(1 << (_LIMB - 1))
        up = (x["over"] > half) | ((x["over"] == half) & ((x["rest"] > 0) | (x["digits"] % 2 == 1)))
        digits = x["digits"] + up.cast("long")
        whole = (x["whole"] + F.when(digits == scale, 1).otherwise(0)).cast("string")
        return F.concat(whole, F.lit("."), F.lpad((digits % scale).cast("string"), places, "0"))

    def text(v: Column) -> Column:
        number = evaluated_once(evaluated_once(limbs(v), scaled), rounded)
        plain = F.when(F.isnan(v), "nan").when(F.abs(v) == float("inf"), "inf").otherwise(number)
        minus = F.startswith(v.cast("string"), F.lit("-"))
        return F.when(v.isNotNull(), F.concat(F.when(minus, "-").otherwise("+" if signed else ""), plain))

    return evaluated_once(value.cast("double"), text)
