"""Even spread of an n:1 join's rows, whatever their keys.

AQE splits a hot key's partition at run time; that is the default here.
``lookup_join(..., salts=n)`` spreads every key explicitly instead, for
clusters where AQE's skew join is off or the join feeds an operator that
keeps AQE from splitting it:

1. every row of ``big`` gets a salt from its place in its partition, so the
   rows of a key, equal ones too, spread evenly over the salts;
2. every row of ``small`` (one per key at most) is repeated once per salt;
3. the join is on (key, salt).

There is no list of hot keys, no threshold and no extra pass: the price is
``salts`` copies of the small side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", salts: int = 1) -> DataFrame:
    if how not in ("left", "inner"):
        raise ValueError("a lookup join is 'left' or 'inner'")
    if salts <= 1:
        return big.join(small, key, how)
    b = big.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, [key, "_salt"], how).drop("_salt")
