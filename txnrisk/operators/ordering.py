"""Global order without a single-task sort.

Positions in a table sorted by ``keys`` are needed in two forms:

* ``ordered_index`` gives every row its 0-based position. Rows are range partitioned
  over *all* keys and the input partition, so many rows with one timestamp, or even
  with one id, still spread, and the sorted table is written once; positions are then partition offset + place in the partition.
* ``keys_at_ranks`` finds only the keys at given positions. It narrows the key range
  by counting rows between a few pivots, and never sorts the table. Pivots come from a quantile
  sketch, close around the positions, so one pass of counting is mostly enough.

Cuts, pages and "rows from index n" need only the second, which reads just the keys.

Null keys come last, in every function and on every path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.sources.scratch import remove, scratch_path, stage

PIVOTS = 31  # rows collected per narrowing step
SKETCH = 1 << 14  # items a quantile sketch keeps
SKETCH_ERROR = 2 / SKETCH  # share of rows by which its ranks are off, with room
SMALL = 100_000  # at most this many distinct keys are ranked in one window
PLACE_BITS = 33  # monotonically_increasing_id keeps the place in the low 33 bits


@dataclass(frozen=True)
class RankedKey:
    values: tuple[Column, ...]  # literals, one per key column
    before: int  # rows with a smaller key
    copies: int  # rows with this key


def _dtypes(df: DataFrame, keys: Sequence[str]) -> list[T.DataType]:
    return [df.select(k).schema[0].dataType for k in keys]


def _carry(name: str, dtype: T.DataType) -> Column:
    """Timestamps pass through the driver as a number: no time zone is involved."""
    return F.unix_micros(name).alias(name) if isinstance(dtype, T.TimestampType) else F.col(name)


def _literal(value: object, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType) and value is not None:
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(dtype)


def _struct(columns: Sequence[Column | str], keys: Sequence[str]) -> Column:
    """The keys as one comparable value that is never null; a null key is larger than any other."""
    parts = []
    for c, k in zip(columns, keys, strict=True):
        value = F.col(c) if isinstance(c, str) else c
        parts += [value.isNull().alias(f"{k}__none"), value.alias(k)]
    return F.struct(*parts)


def _number(name: str, dtype: T.DataType) -> Column | None:
    """The key as a whole number, as quantile sketches take it; None for types that have none."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(dtype, T.DateType):
        return F.unix_date(name)
    return F.col(name).cast("long") if isinstance(dtype, T.IntegralType) else None


def _from_number(value: int, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(F.lit(value).cast("int"))
    return _literal(value, dtype)


def _around(ranks: Sequence[int], before: int, rows: int, most: int) -> list[float]:
    """Shares of ``rows`` at and closely around the ranks, at most ``most``."""
    exact = [(r - before + 0.5) / rows for r in ranks]
    near = [share + sign * SKETCH_ERROR for share in exact for sign in (-1, 0, 1)]
    shares = near if len(near) <= most else exact[:: -(-len(exact) // most)]
    return sorted({min(max(share, 0.0), 1.0) for share in shares})


def _sketched(span: DataFrame, rows: int, name: str, dtype: T.DataType, shares: Sequence[float]) -> list[int]:
    """Values of the key at about these shares of the ``rows``; none where all are null.

    The sketch, whose size is fixed, comes to the driver, as its quantiles ask for constant shares.
    """
    sketch = F.kll_sketch_agg_bigint(_number(name, dtype), SKETCH)
    whole, held = span.agg(sketch.alias("sketch"), F.count(name).alias("held")).first()
    if not held:
        return []
    # The sketch leaves out nulls, which come last.
    scaled = F.array(*(F.lit(min(share * rows / held, 1.0)) for share in shares))
    found = span.sparkSession.range(1).select(F.kll_sketch_get_quantile_bigint(F.lit(whole), scaled)).first()[0]
    return sorted(set(found))


def _sorted_by(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]


def _from_first(keys: Sequence[str], low: Sequence[Column]) -> Column:
    """A condition on the first key alone, so that the scan can skip files below ``low``."""
    return (F.col(keys[0]) >= low[0]) | F.col(keys[0]).isNull()


def _at_or_after(keys: Sequence[str], low: Sequence[Column]) -> Column:
    return (_struct(keys, keys) >= _struct(low, keys)) & _from_first(keys, low)


def _after(keys: Sequence[str], low: Sequence[Column]) -> Column:
    return (_struct(keys, keys) > _struct(low, keys)) & _from_first(keys, low)


def _upto_first(keys: Sequence[str], high: Sequence[Column]) -> Column:
    return (F.col(keys[0]) <= high[0]) | high[0].isNull()


def _before(keys: Sequence[str], high: Sequence[Column]) -> Column:
    return (_struct(keys, keys) < _struct(high, keys)) & _upto_first(keys, high)


def _slot(key: Column, pivots: list[Column], low: int = 0) -> Column:
    """Odd slot 2i+1 for a key equal to pivot i, even slots for the gaps around pivots."""
    if not pivots:
        return F.lit(2 * low)
    mid = len(pivots) // 2
    return (
        F.when(key == pivots[mid], F.lit(2 * (low + mid) + 1))
        .when(key < pivots[mid], _slot(key, pivots[:mid], low))
        .otherwise(_slot(key, pivots[mid + 1 :], low + mid + 1))
    )


def keys_at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    ranks: Sequence[int],
    total: int | None = None,
    small: int = SMALL,
    pivots: int = PIVOTS,
) -> dict[int, RankedKey]:
    """The keys of the rows at the given 0-based positions when sorted by ``keys``.

    Each step counts rows between at most ``pivots`` keys and goes on in the gaps that hold a
    wanted position. Whole numbers, dates and times have a quantile sketch, of a fixed size, whose
    pivots lie closely around the positions: a step leaves some 1 in 4000 of the rows. Other keys get
    random pivots. Counts are exact; pivots only decide how fast it narrows.
    A key equal to a pivot has a slot of its own, so one key on a third of all rows
    ends the search instead of stalling it. The keys are written once for all steps, unless
    one step is enough.
    """
    dtypes = _dtypes(df, keys)
    carried = [_carry(k, t) for k, t in zip(keys, dtypes, strict=True)]

    def literals(row: Row) -> tuple[Column, ...]:
        return tuple(_literal(row[k], t) for k, t in zip(keys, dtypes, strict=True))

    def rank_small(span: DataFrame, before: int, wanted: Sequence[int]) -> dict[int, RankedKey]:
        """At most ``small`` keys are left, so one window may rank them."""
        groups = span.groupBy(*keys).agg(F.count("*").alias("__copies"))
        upto = F.sum("__copies").over(Window.orderBy(*_sorted_by(keys)).rowsBetween(Window.unboundedPreceding, 0))
        ranked = groups.withColumn("__upto", upto)
        hits = " OR ".join(f"(__upto > {r - before} AND __upto - __copies <= {r - before})" for r in wanted)
        out = {}
        for row in ranked.where(hits).select(*carried, "__upto", "__copies").collect():
            start = before + row["__upto"] - row["__copies"]
            found = RankedKey(literals(row), start, row["__copies"])
            out |= {r: found for r in wanted if start <= r < start + found.copies}
        return out

    def search(span: DataFrame, left: int, before: int, wanted: Sequence[int], known: tuple[Column, ...] = ()) -> dict[int, RankedKey]:
        """``known``: values of the leading keys, where they are the same in all rows of the span."""
        if left <= small:
            return rank_small(span, before, wanted)
        done = len(known)
        rest, name, dtype = list(keys[done:]), keys[done], dtypes[done]
        values = []
        if _number(name, dtype) is not None:
            values = _sketched(span, left, name, dtype, _around(wanted, before, left, pivots))
        if values:
            # Pivots of the next key alone; rows equal to one are told apart by the keys after it.
            rest = [name]
            marks = [(_from_number(v, dtype),) for v in values]
        else:
            picked = span.orderBy(F.rand(left)).limit(pivots).distinct().orderBy(*_sorted_by(keys))
            marks = [literals(row)[done:] for row in picked.select(*carried).collect()]
        slot = _slot(_struct(rest, rest), [_struct(v, rest) for v in marks])
        counts = dict(span.groupBy(slot.alias("slot")).count().collect())
        out = {}
        for found in sorted(counts):
            rows, gap = counts[found], found // 2
            mine = [r for r in wanted if before <= r < before + rows]
            if mine and found % 2 and done + len(rest) < len(keys):
                same = span.where(F.col(name) == marks[gap][0])
                out |= search(same, rows, before, mine, (*known, *marks[gap]))
            elif mine and found % 2:
                out |= {r: RankedKey((*known, *marks[gap]), before, rows) for r in mine}
            elif mine:
                part = span.where(_after(rest, marks[gap - 1])) if gap > 0 else span
                part = part.where(_before(rest, marks[gap])) if gap < len(marks) else part
                out |= search(part, rows, before, mine, known)
            before += rows
        return out

    span = df.select(*keys)
    left = span.count() if total is None else total
    if any(not 0 <= r < left for r in ranks):
        raise ValueError(f"ranks {sorted(ranks)} are not all inside 0..{left - 1}")
    if left <= small:
        return search(span, left, 0, sorted(set(ranks)))
    path = scratch_path(df.sparkSession, "keys")
    span.write.parquet(path)
    try:
        return search(df.sparkSession.read.schema(span.schema).parquet(path), left, 0, sorted(set(ranks)))
    finally:
        remove(df.sparkSession, path)


def key_at_rank(df: DataFrame, keys: Sequence[str], rank: int, total: int | None = None, **options: int) -> RankedKey:
    """``keys_at_ranks`` for one position."""
    return keys_at_ranks(df, keys, [rank], total, **options)[rank]


def ordered_index(df: DataFrame, keys: Sequence[str], name: str = "row_index") -> DataFrame:
    """Add the 0-based position in the order of ``keys``; rows with equal keys come in any order.

    The input partition breaks ties, so that copies of one key spread over several
    ranges too. It is the same when a task is run again. The only rows that meet in one
    task are the partition sizes (one row per shuffle partition), which is also why the
    broadcast of them is bounded.
    """
    spot = F.monotonically_increasing_id()
    spread = df.withColumn("__tie", F.spark_partition_id()).orderBy(*_sorted_by(keys), "__tie").drop("__tie")
    sorted_rows = spread.select(
        "*",
        F.shiftright(spot, PLACE_BITS).alias("__part"),
        spot.bitwiseAND((1 << PLACE_BITS) - 1).alias("__place"),
    )
    staged = stage(sorted_rows, "ordered")
    sizes = staged.groupBy("__part").agg((F.max("__place") + 1).alias("__size"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    return (
        staged.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__place"))
        .drop("__part", "__place", "__offset")
    )


def label_by_rank(
    df: DataFrame,
    keys: Sequence[str],
    cuts: Sequence[int],
    labels: Sequence[str],
    name: str,
    total: int | None = None,
    **options: int,
) -> DataFrame:
    """Label contiguous runs in the order of ``keys``.

    ``cuts`` are the ascending start positions of the second run, the third, and so on.
    """
    total = df.count() if total is None else total
    inside = [c for c in cuts if 0 < c < total]
    marks = keys_at_ranks(df, keys, inside, total, **options) if inside else {}
    tied = any(mark.before != cut for cut, mark in marks.items())
    if tied:
        # A cut falls among rows with equal keys: only positions can tell those apart.
        df = ordered_index(df, keys, "__index")
    label = F.lit(labels[0])
    for cut, text in zip(cuts, labels[1:], strict=True):
        if cut <= 0:
            label = F.lit(text)
        elif cut < total:
            reached = F.col("__index") >= cut if tied else _at_or_after(keys, marks[cut].values)
            label = F.when(reached, text).otherwise(label)
    return df.withColumn(name, label).drop("__index")


def _tied_tail(df: DataFrame, keys: Sequence[str], mark: RankedKey, start: int) -> DataFrame:
    """Of the rows that share the key ``mark``, those at position ``start`` and later."""
    same = (_struct(keys, keys) == _struct(mark.values, keys)) & F.col(keys[0]).eqNullSafe(mark.values[0])
    tied = df.where(same)
    return ordered_index(tied, keys, "__index").where(F.col("__index") >= start - mark.before).drop("__index")


def rows_from_index(df: DataFrame, keys: Sequence[str], start: int, **options: int) -> DataFrame:
    """Rows at position ``start`` and later in the order of ``keys``."""
    if start <= 0:
        return df
    total = df.count()
    if start >= total:
        return df.where(F.lit(False))
    mark = key_at_rank(df, keys, start, total, **options)
    if mark.before == start:
        return df.where(_at_or_after(keys, mark.values))
    return df.where(_after(keys, mark.values)).unionByName(_tied_tail(df, keys, mark, start))


def page_by_offset(
    df: DataFrame, keys: Sequence[str], offset: int, limit: int, small: int = SMALL, pivots: int = PIVOTS
) -> DataFrame:
    """Rows ``offset .. offset+limit-1`` in the order of ``keys``.

    Near the start this is a top-k. A far or large page first finds its end keys, so no
    task holds the skipped rows or the whole page.
    """
    if offset + limit <= small:
        return df.orderBy(*_sorted_by(keys)).offset(offset).limit(limit)
    total = df.count()
    if offset >= total:
        return df.where(F.lit(False))
    end = min(offset + limit, total)
    marks = keys_at_ranks(df, keys, [offset, end - 1], total, small, pivots)
    first, last = marks[offset], marks[end - 1]
    page = df.where(_at_or_after(keys, first.values) & ~_after(keys, last.values))
    page = page.where(_upto_first(keys, last.values))
    if first.before == offset and last.before + last.copies == end:
        return page.orderBy(*_sorted_by(keys))
    index = F.col("__index") + first.before
    paged = ordered_index(page, keys, "__index").where((index >= offset) & (index < end))
    return paged.orderBy("__index").drop("__index")


def page_after(df: DataFrame, keys: Sequence[str], last: Sequence[object] | None, limit: int) -> DataFrame:
    """The next ``limit`` rows after the key ``last`` (from the start when None).

    Pages stay whole when rows arrive in between, and the bound on the first key is
    pushed to the scan.
    """
    if last is not None:
        literals = [_literal_key(v, t) for v, t in zip(last, _dtypes(df, keys), strict=True)]
        df = df.where(_after(keys, literals))
    return df.orderBy(*_sorted_by(keys)).limit(limit)


def _literal_key(value: object, dtype: T.DataType) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast(dtype)


