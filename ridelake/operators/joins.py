"""Joins that hold up under NULL-heavy and many-to-many keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.session import materialize


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])


def left_join_spreading_nulls(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], keep_right: Sequence[str]
) -> DataFrame:
    """Left equi join in which unmatched NULL keys do not pile up in one task.

    ``on`` maps left to right key columns and ``keep_right`` lists the right
    columns to add.  NULL keys match nothing, so their rows get a spread value
    that no right row has.
    """
    null_key = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in on])
    keyed_left = left.withColumn("_spread", F.when(null_key, _row_hash(left)).otherwise(0))
    keyed_right = right.dropna(subset=list(on.values())).select(
        *[F.col(r).alias(f"_r_{r}") for r in dict.fromkeys([*on.values(), *keep_right])],
        F.lit(0).cast("bigint").alias("_r_spread"),
    )
    condition = reduce(
        lambda a, b: a & b,
        [F.col(l) == F.col(f"_r_{r}") for l, r in on.items()] + [F.col("_spread") == F.col("_r_spread")],
    )
    return keyed_left.join(keyed_right, condition, "left").select(
        *left.columns, *[F.col(f"_r_{name}").alias(name) for name in keep_right]
    )


#: Bits of a key set; an eighth of it is the most bytes that are ever broadcast.
KEY_BITS = 2**25


def key_set(df: DataFrame, key: str, bits: int = KEY_BITS) -> DataFrame:
    """The keys of ``df`` as bitmaps of their hashes, one row of 4 KiB for each 32,768 bits that are in use.

    Its size is bounded by ``bits / 8`` bytes however many keys there are, so it may always be broadcast.
    """
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    places = df.where(F.col(key).isNotNull()).select(at.alias("_at"))
    return places.groupBy(F.bitmap_bucket_number("_at").alias("_bitmap")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits")
    )


def possibly_in(df: DataFrame, key: str, keys: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """Rows of ``df`` whose key may be in a ``key_set``: all that are, and of others about (keys / bits).

    The rows are filtered where they are read, before anything moves.  ``bits`` must be those of the set.
    """
    at = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(bits))
    placed = df.withColumn("_at", at)
    met = placed.join(F.broadcast(keys), F.bitmap_bucket_number("_at") == F.col("_bitmap"))
    position = F.bitmap_bit_position("_at")
    octet = F.conv(F.hex(F.substring("_bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return met.where(F.getbit(octet, (position % 8).cast("int")) == 1).select(*[F.col(f"`{c}`") for c in df.columns])


def left_join_by_parts(left: DataFrame, right: DataFrame, on: Sequence[str], added: Mapping[str, str]) -> DataFrame:
    """Left join on equally named columns for a ``right`` side that may repeat one key very often.

    Spark can split a skewed key on either side of an inner join, but not on the
    right side of a left join.  So matches come from an inner join, rows without
    a match from an anti join with the distinct keys, and rows with a NULL key
    from no join at all.  ``added`` maps the new columns to their types.
    ``left`` is read three times.
    """
    has_key = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in on])
    keyed = left.where(has_key)
    absent = [F.lit(None).cast(kind).alias(name) for name, kind in added.items()]
    matched = keyed.join(right, list(on)).select(*left.columns, *added)
    unmatched = keyed.join(right.select(*on).distinct(), list(on), "left_anti").select(*left.columns, *absent)
    return matched.unionByName(unmatched).unionByName(left.where(~has_key).select(*left.columns, *absent))


def alternative_key_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    columns: Mapping[str, str],
    stage: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Distinct rows of ``left`` joined to ``right`` by each key in turn, first non-NULL per column.

    ``keys`` lists (left column, right column) pairs in order of preference and
    ``columns`` maps output names to right columns.  The result equals one left
    join per key followed by ``coalesce`` per column and ``DISTINCT``.

    Joining literally would pair every match of the first key with every match
    of the second.  Instead a row that still has NULLs asks the next key only
    for the *distinct fillings* of exactly those columns, so the join emits no
    more rows than the answer needs.  Each step is staged, since the next one
    reads it several times; pass staged frames for ``left`` and ``right`` too.
    """
    names = list(columns)
    # The values travel as one struct: plans stay small however many columns there are.
    candidates = right.select(
        *[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(keys)],
        F.struct(*[F.col(src).alias(out) for out, src in columns.items()]).alias("_v"),
    ).distinct()
    values = candidates.schema["_v"].dataType.simpleString()
    everything = F.lit((1 << len(names)) - 1).cast("bigint")

    found = left.select("*", F.lit(None).cast(values).alias("_v"), everything.alias("_missing"))
    for step, (left_key, _) in enumerate(keys):
        # Complete rows need no further key.
        found = found.withColumn("_ask", F.when(F.col("_missing") != 0, F.col(left_key)))
        if step == 0:
            # Nothing is known yet: every candidate is a filling.
            fillings = candidates.select(F.col("_k0").alias("_ask"), everything.alias("_missing"), F.col("_v").alias("_f"))
        else:
            asked = found.select("_ask", "_missing").dropna(subset=["_ask"]).distinct()
            missing_only = _struct_of(names, "if(getbit(_missing, {bit}) = 1, _v.`{name}`, NULL)")
            fillings = (
                candidates.withColumnRenamed(f"_k{step}", "_ask")
                .join(asked, "_ask")
                .select("_ask", "_missing", missing_only.alias("_f"))
                .distinct()
            )
        found = left_join_by_parts(found, fillings, ["_ask", "_missing"], {"_f": values}).select(
            *left.columns, _struct_of(names, "coalesce(_v.`{name}`, _f.`{name}`)").alias("_v")
        )
        if step < len(keys) - 1:
            found = stage(found.withColumn("_missing", _missing_mask("_v", names)), "alternatives")

    return found.select(*left.columns, "_v.*").distinct()


def _struct_of(names: Sequence[str], rule: str) -> Column:
    """Struct whose fields follow one SQL rule; a single expression, so wide structs build fast."""
    fields = ", ".join(f"'{name}', {rule.format(bit=bit, name=name)}" for bit, name in enumerate(names))
    return F.expr(f"named_struct({fields})")


def _missing_mask(struct: str, names: Sequence[str]) -> Column:
    """Bit per struct field, set where it is NULL."""
    return F.expr(" + ".join(f"if({struct}.`{name}` IS NULL, {1 << bit}L, 0L)" for bit, name in enumerate(names)))
