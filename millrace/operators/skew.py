"""Joins and ranks that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import stored

# A key with more rows than a task should hold is heavy and is split into as
# many parts as it holds such portions.
ROWS_PER_TASK = 1_000_000
# Keys are measured on one row in SAMPLE, so that measuring moves little.
SAMPLE = 64
# Of the heavy keys, the heaviest so many are split; any other then holds less
# than 1/LISTED of the rows.
LISTED = 10_000

Heavy = Mapping[int, int]


def heavy_keys(df: DataFrame, *key_lists: Sequence[str]) -> list[dict[int, int]]:
    """Heavy keys of ``df`` per list of key columns: hash of the key and the
    number of parts it is to be split into.

    One pass over a sample of the rows, counted by key hash with partial sums
    in every task: nothing meets in one place but the counts that are large.
    They decide how rows are spread and never what a join returns.
    """
    some = df.sample(1 / SAMPLE, 42) if SAMPLE > 1 else df
    keyed = F.array(*[F.struct(F.lit(i).alias("list"), F.xxhash64(*keys).alias("hash")) for i, keys in enumerate(key_lists)])
    rows = F.count("*") * SAMPLE
    large = (
        some.select(F.inline(keyed)).groupBy("list", "hash").agg(rows.alias("n"))
        .where(F.col("n") > ROWS_PER_TASK)
        .orderBy(F.desc("n"), "list", "hash").limit(LISTED)
    )
    out: list[dict[int, int]] = [{} for _ in key_lists]
    for r in large.collect():
        out[r["list"]][r["hash"]] = -(-r["n"] // ROWS_PER_TASK)
    return out


def with_parts(df: DataFrame, heavy: Heavy, keys: Sequence[Column | str], name: str) -> DataFrame:
    """Adds the number of parts of each row's key. The heavy keys are a side
    table of at most ``LISTED`` rows that every task holds as a hash table."""
    if not heavy:
        return df.withColumn(name, F.lit(1))
    side = df.sparkSession.createDataFrame([*heavy.items()], "_hash bigint, _cut int")
    found = df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(side), "_hash", "left")
    return found.withColumn(name, F.coalesce("_cut", F.lit(1))).drop("_hash", "_cut")


def own_part(df: DataFrame, heavy: Heavy, keys: Sequence[Column | str], spread: Sequence[Column | str], name: str) -> DataFrame:
    """Adds the part of each row: by the hash of ``spread`` for a heavy key,
    else 0."""
    if not heavy:
        return df.withColumn(name, F.lit(0))
    return with_parts(df, heavy, keys, "_parts").withColumn(name, F.pmod(F.xxhash64(*spread), F.col("_parts")).cast("int")).drop("_parts")


def every_part(df: DataFrame, heavy: Heavy, keys: Sequence[Column | str], name: str) -> DataFrame:
    """Each row once for every part that its key was cut into."""
    if not heavy:
        return df.withColumn(name, F.lit(0))
    return with_parts(df, heavy, keys, "_parts").withColumn(name, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[Column | str],
    how: str = "inner",
    heavy: Heavy | None = None,
    residual: Column | None = None,
    heavy_right: Heavy | None = None,
) -> DataFrame:
    """Equi-join ``left`` to ``right`` on ``keys`` with heavy keys split.

    Left rows of a heavy key go to one of its parts, chosen by a hash of
    ``spread`` (columns that tell the key's rows apart); right rows of that key
    are copied to each part. All other rows keep part 0. Every matching pair
    meets exactly once, so inner and left joins are unchanged. Without a heavy
    key this is the plain join.

    ``heavy`` may bring keys measured elsewhere, such as on the table that
    ``left`` was built from; otherwise ``left`` itself is measured.
    ``heavy_right`` splits the right side as well, so that the rows of a key
    meet on a grid; a left join then is the inner join and the left rows
    without partner, so it takes no ``residual``, a further condition on
    ``l.…`` and ``r.…`` columns.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    if heavy_right and how == "left" and residual is not None:
        raise ValueError("a left join with a residual splits the left side only")
    keys = list(keys)
    heavy = heavy_keys(left, keys)[0] if heavy is None else heavy
    heavy_right = heavy_right or {}
    types = {f.name: f.dataType for f in left.schema}
    same = [F.col(k).try_cast(types[k]) for k in keys]  # hash both sides as one type
    if heavy_right and how == "left":
        met = salted_join(left, right, keys, spread, "inner", heavy, None, heavy_right)
        known = right.select(*[c.alias(k) for c, k in zip(same, keys)]).distinct()
        alone = salted_join(left, known.withColumn("_known", F.lit(True)), keys, spread, "left", heavy).where("_known IS NULL").drop("_known")
        return met.unionByName(alone, allowMissingColumns=True).select(met.columns)
    on = keys
    left_cols, right_cols = left.columns, [c for c in right.columns if c not in keys]
    if heavy:
        left = own_part(left, heavy, keys, spread, "_salt")
        right = every_part(right, heavy, same, "_salt")
        on = [*on, "_salt"]
    if heavy_right:
        left = every_part(left, heavy_right, keys, "_salt_right")
        right = own_part(right, heavy_right, same, right_cols, "_salt_right")
        on = [*on, "_salt_right"]
    if residual is None:
        return left.join(right, on, how).drop("_salt", "_salt_right")
    condition = residual
    for key in on:
        condition = condition & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    return (
        left.alias("l")
        .join(right.alias("r"), condition, how)
        .select(*[F.col(f"l.{c}") for c in left_cols], *[F.col(f"r.{c}") for c in right_cols])
    )


_INSIDE = 33  # bits of the row number that monotonically_increasing_id keeps per task


def running(df: DataFrame, order: Sequence[Column | str], sums: Mapping[str, str], within: Sequence[str] = ()) -> DataFrame:
    """``df`` in global ``order`` with running totals of some columns, the
    row's own value included: ``sums`` maps new names to columns. Totals start
    anew for each value of ``within``, columns that lead the order.

    A window without partitions, or over one large group, would put all rows
    into one task. Here rows are range-partitioned and written once; totals run
    inside each part, and the totals of the earlier parts, one row per part
    (and group in it), are added.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("_row", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_row", _INSIDE))
    keys = [*within, "_part"]
    whole = placed.groupBy(*keys).agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sums.values())])
    # one row per part and group in it
    earlier = (Window.partitionBy(*within) if within else Window).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select(
        *[F.col(c).alias(f"_of{i}") for i, c in enumerate(keys)], *[F.coalesce(F.sum(f"_t{i}").over(earlier), F.lit(0)).alias(f"_b{i}") for i in range(len(sums))]
    )
    inside = Window.partitionBy(*keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumns({f"_s{i}": F.sum(c).over(inside) for i, c in enumerate(sums.values())})
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_of{i}"))
    return rows.join(before, same).select(*df.columns, *[(F.col(f"_s{i}") + F.col(f"_b{i}")).alias(name) for i, name in enumerate(sums)])


def global_rank(df: DataFrame, key: Column | str | Sequence[Column | str], name: str = "rank") -> DataFrame:
    """1-based position of every row in the order of ``key``, one or several
    columns that tell all rows apart: range partitions, row numbers inside
    them, and the sizes of the earlier ones."""
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(ranged.withColumn("_row", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_row", _INSIDE), F.col("_row").bitwiseAND((1 << _INSIDE) - 1)
    # one row per part
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.withColumn("_part", part).join(before, "_part").withColumn(name, inside + F.col("_before") + 1).drop("_part", "_row", "_before")
