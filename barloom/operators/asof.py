"""As-of join: to each row the nearest row of another table before or after it in time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import SLICE, time_slices
from barloom.schemas import series_key

_SIDE = "_side"
_CARRIED = "_carried"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] | None = None,
    time: str = "time",
    direction: str = "backward",
    equal: bool = True,
    slices: Callable[[DataFrame], DataFrame] = time_slices,
) -> DataFrame:
    """Every left row with ``values`` of the right row next to it in its series, else null.

    ``backward`` looks for the last right row before a left row, ``forward`` for the first
    one after it; with ``equal`` one at the same time counts too. Right rows are one a time
    and series; left rows may repeat, and one without time finds none.

    Both sides are one sorted frame in which values are carried along, so no left row is
    compared with more than one right row. Series are cut into time slices (``slices``
    adds them); what a slice has to begin with comes from a table of one row for each slice,
    joined by slice, so neither a long series nor its rows meet in one task.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is 'backward' or 'forward'")
    backward = direction == "backward"
    keys = list(keys or series_key(left))
    group = [*keys, SLICE]
    own = [name for name in left.columns if name != SLICE]
    carried = F.struct(*values).alias(_CARRIED)
    kind = right.select(carried).schema[_CARRIED].dataType
    rows = left.withColumns({_SIDE: F.lit(True), _CARRIED: F.lit(None).cast(kind)})
    marks = right.where(F.col(time).isNotNull()).select(
        *[F.col(name) if name in (*keys, time) else F.lit(None).cast(left.schema[name].dataType).alias(name) for name in own],
        F.lit(False).alias(_SIDE),
        carried,
    )
    both = slices(rows.drop(SLICE).unionByName(marks))

    # rows of one time: a right row comes first where it counts, and last where it doesn't
    before = F.col(_SIDE).asc() if equal else F.col(_SIDE).desc()
    order = [F.col(time).asc() if backward else F.col(time).desc(), before]
    within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn(_CARRIED, F.last(_CARRIED, ignorenulls=True).over(within)).where(_SIDE)

    nearest = F.max_by if backward else F.min_by
    ends = (
        both.select(*group, time, _CARRIED)
        .groupBy(*group)
        .agg(nearest(_CARRIED, F.when(F.col(_CARRIED).isNotNull(), F.col(time))).alias("_end"))
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(F.col(SLICE).asc() if backward else F.col(SLICE).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = ends.select(*group, F.last("_end", ignorenulls=True).over(earlier).alias("_start"))
    same = reduce(lambda a, b: a & b, [F.col(f"f.{k}").eqNullSafe(F.col(f"s.{k}")) for k in group])
    joined = found.alias("f").join(starts.alias("s"), same, "left")
    value = F.when(F.col(f"f.{time}").isNotNull(), F.coalesce(f"f.{_CARRIED}", "s._start"))
    return joined.select(*[F.col(f"f.{name}") for name in own], value.alias(_CARRIED)).select(
        *own, *[F.col(f"{_CARRIED}.{name}").alias(name) for name in values]
    )
