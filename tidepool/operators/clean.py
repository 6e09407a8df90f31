"""Cleaning: name disambiguation, recoding, crosswalks, fill-down, exclusions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.functions.joins import bounded_broadcast


def disambiguate_names(df: DataFrame, name: str, qualifier: str) -> DataFrame:
    """Append ``" (<qualifier>)"`` to names seen with more than one qualifier.

    E.g. an institution name used in two countries becomes two names. The
    ambiguous names are found with a grouped distinct count and joined back
    (not a per-name window, which would put a very common name in one task).
    The distinct count de-duplicates (name, qualifier) map-side first.
    """
    ambiguous = (df.groupBy(F.col(name).alias("_amb"))
                 .agg(F.countDistinct(qualifier).alias("_k"))
                 .where(F.col("_k") > 1).select("_amb", F.lit(True).alias("_is_amb")))
    # One row per ambiguous name: broadcast when the checked count allows, so
    # the (large, name-skewed) input is not shuffled by name at all.
    ambiguous = bounded_broadcast(ambiguous)
    joined = df.join(ambiguous, df[name] == ambiguous["_amb"], "left")
    renamed = F.when(F.col("_is_amb"),
                     F.concat(F.col(name), F.lit(" ("), F.col(qualifier), F.lit(")"))
                     ).otherwise(F.col(name))
    return joined.withColumn(name, renamed).drop("_amb", "_is_amb")


def _map_lookup(mapping: Mapping[str, str], col: Column) -> Column:
    pairs: list[Column] = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), col)


def recode(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None,
           default: str | Column | None = None) -> DataFrame:
    """Recode chain: values found in ``mapping`` are replaced; the rest keep
    their value, or get ``default`` when given. NULL falls through.

    A literal map lookup (one expression, no join) replaces a long
    ``CASE WHEN`` chain; for mappings that are tables use ``crosswalk``.
    """
    src = F.col(col)
    hit = _map_lookup(mapping, src)
    fallback = src if default is None else (F.lit(default) if isinstance(default, str) else default)
    return df.withColumn(out or col, F.coalesce(hit, fallback))


def recode_group(df: DataFrame, cols: str | Sequence[str], members: Iterable[str],
                 label: str) -> DataFrame:
    """Replace every member of a group (e.g. EU funders) by one group label.

    Apply it *before* counting distinct works to count each work once per
    group; applying it after summed per-member counts reproduces the
    reference's over-count.
    """
    names = sorted(set(members))
    for c in ([cols] if isinstance(cols, str) else cols):
        df = df.withColumn(c, F.when(F.col(c).isin(*names), F.lit(label)).otherwise(F.col(c)))
    return df


def crosswalk(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, label: str,
              out: str = "label", fixes: Mapping[str, str] | None = None,
              treat_missing: Iterable[str] = (), default: str = "Unclassified",
              check_unique: bool = True) -> DataFrame:
    """Code -> label through a lookup table, with per-code fixes and a default.

    ``fixes`` maps a code straight to a label (overrides the lookup);
    labels in ``treat_missing`` count as missing; missing becomes ``default``.
    The lookup key must be unique: a duplicated key would multiply rows (the
    reference's silent over-count), so it fails loudly (``check_unique``).
    """
    lk = lookup.select(F.col(lookup_key).alias("_lk"), F.col(label).alias("_lbl"))
    if check_unique:
        assert_unique(lk, "_lk")
    lk = bounded_broadcast(lk)
    joined = df.join(lk, df[key] == lk["_lk"], "left")
    lbl = F.col("_lbl")
    bad = sorted(set(treat_missing))
    if bad:
        lbl = F.when(lbl.isin(*bad), F.lit(None)).otherwise(lbl)
    if fixes:
        lbl = F.coalesce(_map_lookup(fixes, F.col(key)), lbl)
    return joined.withColumn(out, F.coalesce(lbl, F.lit(default))).drop("_lk", "_lbl")


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Fail at run time if ``key`` repeats (lookup tables before a left join)."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    if dup.limit(1).count():
        raise ValueError(f"lookup key {keys} is not unique")
    return df


def first_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep one whole row per key: the one smallest in ``order_by`` (then all
    columns); missing values sort last.

    Done as a ``min(struct(...))`` aggregate, which is partially aggregated
    map-side, instead of a ``row_number`` window over the whole key group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ordered = list(order_by) + [c for c in rest if c not in order_by]
    fields = [f for c in ordered for f in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    packed = F.min(F.struct(*fields)).alias("_r")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def enrich(df: DataFrame, details: DataFrame, key: str, detail_key: str,
           order_by: Sequence[str]) -> DataFrame:
    """Attach one detail row per key (the first in ``order_by``) with a left join.

    The detail side is de-duplicated on its key first, so the join can never
    multiply the probe rows.
    """
    one = first_per_key(details, detail_key, order_by)
    return df.join(one, df[key] == one[detail_key], "left").drop(one[detail_key])


def fill_down(df: DataFrame, col: str, partition_by: str, order_by: str,
              chunk: int = 1 << 16, levels: int | None = None) -> DataFrame:
    """Fill NULLs in ``col`` with the last non-NULL value before them.

    Order is given by a numeric sequence column ``order_by`` (Spark rows have no
    file order), per ``partition_by`` group. Exact and split: rows are cut into
    (group, order_by // chunk) blocks, so a group holding a third of all rows is
    spread over many tasks.

    1. per block: last non-NULL value (a grouped aggregate);
    2. per block: carry-in = last of those over earlier blocks of the group,
       computed the same way one level up (blocks of ``chunk`` blocks), for
       ``levels`` levels; only the top level is one window per group, over
       (id range / chunk ** (levels + 1)) rows, so sparse ids cannot make a
       hot group's window large;
    3. per block: running last non-NULL inside the block, else the carry-in.
    Every other window partition holds at most ``chunk`` rows.

    ``levels=None`` derives the level count from the id range (one aggregate
    over the ordering column): just enough levels for the top-level window to
    hold at most ``chunk`` rows per group.
    """
    if levels is None:
        levels = _levels_for(df, order_by, chunk)
    rows = df.withColumn("_blk", F.floor(F.col(order_by) / F.lit(chunk)).cast("bigint"))
    # One row per block; ``_last`` is NULL for blocks without a value (max_by
    # skips rows whose ordering is NULL), and those still get a carry below.
    blocks = (rows.groupBy(partition_by, "_blk")
              .agg(F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order_by)))
                   .alias("_last")))
    carry = _carry_in(blocks, "_last", partition_by, "_blk", chunk, levels)
    inside = W.partitionBy(partition_by, "_blk").orderBy(order_by) \
        .rowsBetween(W.unboundedPreceding, 0)
    # A NULL group is a group: the joins on it are null-safe.
    c = carry.select(F.col(partition_by).alias("_g"), F.col("_blk").alias("_b"), "_carry")
    met = rows.join(c, rows[partition_by].eqNullSafe(c["_g"]) & rows["_blk"].eqNullSafe(c["_b"]), "left").drop("_g", "_b")
    filled = met.withColumn(
        col, F.coalesce(F.last(col, ignorenulls=True).over(inside), F.col("_carry")))
    return filled.drop("_blk", "_carry")


def _levels_for(df: DataFrame, order_by: str, chunk: int) -> int:
    r = df.agg((F.max(order_by) - F.min(order_by)).alias("span")).first()["span"]
    span, levels = (int(r) if r is not None else 0) // chunk, 0
    while span >= chunk:
        span //= chunk
        levels += 1
    return levels


def _carry_in(t: DataFrame, value: str, part: str, pos: str, chunk: int, levels: int) -> DataFrame:
    """For each row of ``t`` (one per (part, pos)): the last non-NULL ``value``
    at an earlier ``pos`` of the same part, as ``_carry``."""
    if levels <= 0:
        w = W.partitionBy(part).orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
        return t.select(part, pos, F.last(value, ignorenulls=True).over(w).alias("_carry"))
    up = f"{pos}_up"
    tt = t.withColumn(up, F.floor(F.col(pos) / F.lit(chunk)).cast("bigint"))
    grouped = (tt.groupBy(part, up)
               .agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(pos))).alias("_v")))
    higher = _carry_in(grouped, "_v", part, up, chunk, levels - 1).withColumnRenamed("_carry", "_hc")
    w = W.partitionBy(part, up).orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    local = tt.select(part, pos, up, F.last(value, ignorenulls=True).over(w).alias("_local"))
    hi = higher.select(F.col(part).alias("_g"), F.col(up).alias("_u"), "_hc")
    return (local.join(hi, local[part].eqNullSafe(hi["_g"]) & local[up].eqNullSafe(hi["_u"]), "left")
            .select(part, pos, F.coalesce("_local", "_hc").alias("_carry")))


def exclude_terms(df: DataFrame, col: str, stop: DataFrame | Iterable[str],
                  stop_col: str = "term") -> DataFrame:
    """Drop rows whose ``col`` is on a stop list (generic words, persons, noise)."""
    if isinstance(stop, DataFrame):
        s = bounded_broadcast(stop.select(F.col(stop_col).alias("_stop")).distinct())
        return df.join(s, df[col] == s["_stop"], "left_anti")
    words = sorted(set(stop))
    return df.where(~F.col(col).isin(*words) | F.col(col).isNull())
