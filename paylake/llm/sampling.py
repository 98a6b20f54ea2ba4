"""Rows of lowest hash, found by counting hashes in buckets, without a sort or a window.

A key's place is 24 bits of its hash. Rows are counted by class and by the upper 8 bits of the place,
then those of the bucket where a class reaches its number by the next 8, and so on. A driver sees
256 counts of a class at a time, and every row decides for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS, STEP = 24, 8


def _place(key: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS)


def lowest(rows: DataFrame, key: str, by: str, most: int | dict) -> Column:
    """Whether a row is among the ``most`` of its class ``by`` whose keys have the lowest hash.

    ``most`` may name a number for each class; there are none of a class that it does not name. Rows
    of one key stay or go together, so distinct rows should be given; the answer may then be asked of
    any table that has both columns. A class that has no more than ``most`` rows stays whole, an
    empty table has no rows to choose.
    """
    place = _place(key)
    inside, limit, held, edge = {}, {}, {}, None
    for shift in range(BITS - STEP, -1, -STEP):
        part = F.shiftright(place, shift)
        counted = rows.withColumn("_part", part)
        if edge is not None:
            counted = counted.where(_by_class(by, edge) == F.shiftright(place, shift + STEP))
        found: dict = {}
        for r in counted.groupBy(by, "_part").count().collect():
            found.setdefault(r[0], []).append((r[1], r[2]))
        inside, edge = {c: sorted(parts) for c, parts in found.items()}, {}
        for c, parts in inside.items():
            wanted = most.get(c, 0) if isinstance(most, dict) else most
            for bucket, n in parts:
                if held.get(c, 0) + n > wanted:
                    limit[c], edge[c] = bucket << shift, bucket
                    break
                held[c] = held.get(c, 0) + n
            else:  # the class, or what it has in this bucket, fits
                limit[c] = (parts[-1][0] + 1) << shift
        if not edge:
            break
    return place < _by_class(by, limit)


def _by_class(by: str, values: dict) -> Column:
    """A value for each class; null for others."""
    pairs = [F.lit(x) for c, v in values.items() if c is not None for x in (c, v)]
    known = F.try_element_at(F.create_map(*pairs), F.col(by)) if pairs else F.lit(None).cast("int")
    return F.when(F.col(by).isNull(), F.lit(values[None])).otherwise(known) if None in values else known
