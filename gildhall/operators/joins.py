"""Join operators (JON-1..JON-21).

Join strategy is left to Catalyst and AQE: a side is broadcast only when
its measured runtime size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
(or the static threshold from statistics); otherwise sort-merge with AQE
skew splitting on the streamed side. The only explicit broadcast is of a
global aggregate, whose size is one row by construction.

Every lookup that promises "at most one match" makes the right side unique
with an aggregate whose output raises at runtime when a key has more than
one row, so the check runs inside the same job as the join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildhall.functions._col import col_of
from gildhall.session import stored


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def unique_on(df: DataFrame, keys, values: Sequence[str], what: str = "lookup") -> DataFrame:
    """Collapse ``df`` to one row per key and fail the task if any key had two.

    A group-by (with map-side partial aggregation) instead of a window, so a
    hot key is pre-combined before the shuffle.
    """
    ks = _keys(keys)
    aggs = [F.min(v).alias(v) for v in values] + [F.count(F.lit(1)).alias("_dup_n")]
    g = df.groupBy(*ks).agg(*aggs)
    guard = F.when(F.col("_dup_n") > 1,
                   F.raise_error(F.concat(F.lit(f"{what}: key not unique: "),
                                          F.to_json(F.struct(*ks)))))
    first = values[0] if values else None
    cols = [F.col(k) for k in ks]
    for v in values:
        c = F.col(v)
        if v == first:
            c = F.coalesce(guard.cast(df.schema[v].dataType), c)
        cols.append(c.alias(v))
    if not values:
        cols.append(F.coalesce(guard.cast("int"), F.lit(0)).alias("_unique_ok"))
    out = g.select(*cols)
    return out.drop("_unique_ok") if not values else out


def resolve_sk(df: DataFrame, dim: DataFrame, on: str | Mapping[str, str], sk: str,
               out: str | None = None, missing: int | None = -1,
               current_flag: str | None = "is_current_flag",
               null_key_missing: int | None = None,
               carry: Mapping[str, str] | None = None) -> DataFrame:
    """Natural key → current surrogate key, else the sentinel (JON-3, FLT-7).

    ``on`` is a column name shared by both sides or ``{left_col: dim_col}``.
    The dimension is filtered to its current version first, made unique per
    key (a duplicate current key fails the job) and left-joined; the row
    count of ``df`` never changes. A NULL natural key gets ``null_key_missing``
    (default: the same sentinel); pass None for "not applicable".
    ``carry`` maps further dimension columns to output names; they come
    through the same unique lookup (NULL when unmatched), so a dimension
    needed for two columns is aggregated and joined once.
    """
    carry = dict(carry or {})
    mapping = {on: on} if isinstance(on, str) else dict(on)
    out = out or sk
    d = dim
    if current_flag and current_flag in d.columns:
        d = d.filter(F.col(current_flag))
    dcols = list(mapping.values())
    rn = {dc: f"_rk_{i}" for i, dc in enumerate(dcols)}
    cnames = {c: f"_rk_c{i}" for i, c in enumerate(carry)}
    d = d.select(*[F.col(dc).alias(rn[dc]) for dc in dcols], F.col(sk).alias("_rk_sk"),
                 *[F.col(c).alias(cnames[c]) for c in carry])
    d = unique_on(d, list(rn.values()), ["_rk_sk", *cnames.values()], what=f"resolve_sk({sk})")
    cond = None
    for lc, dc in mapping.items():
        c = df[lc] == d[rn[dc]]
        cond = c if cond is None else cond & c
    j = df.join(d, cond, "left")
    any_null = None
    for lc in mapping:
        c = F.col(lc).isNull()
        any_null = c if any_null is None else any_null | c
    nk_missing = missing if null_key_missing is None else null_key_missing
    val = F.col("_rk_sk")
    if missing is not None:
        val = F.coalesce(val, F.when(any_null, F.lit(nk_missing)).otherwise(F.lit(missing)))
    j = j.withColumn(out, val.cast(dim.schema[sk].dataType))
    for c, o in carry.items():
        j = j.withColumnRenamed(cnames[c], o)
    return j.drop(*rn.values()).drop("_rk_sk")


def decode(df: DataFrame, lookup: DataFrame, code: str, desc: str, out: str | None = None,
           lookup_code: str | None = None, keep_code: bool = True) -> DataFrame:
    """Code → description; the raw code is kept when unknown (JON-4)."""
    lc = lookup_code or code
    out = out or desc
    lk = unique_on(lookup.select(F.col(lc).alias("_dc_code"), F.col(desc).alias("_dc_desc")),
                   "_dc_code", ["_dc_desc"], what=f"decode({code})")
    j = df.join(lk, df[code] == lk["_dc_code"], "left")
    val = F.coalesce(F.col("_dc_desc"), F.col(code).cast("string")) if keep_code else F.col("_dc_desc")
    return j.withColumn(out, val).drop("_dc_code", "_dc_desc")


def valid_rows(lookup: DataFrame, inactive_col: str, as_of: str) -> DataFrame:
    """Rows valid at ``as_of``: inactive date NULL or after it (JON-9).
    Apply before the outer join, never in its WHERE."""
    c = F.col(inactive_col)
    return lookup.filter(c.isNull() | (c > F.lit(as_of).cast(lookup.schema[inactive_col].dataType)))


def pick_one(df: DataFrame, keys, value: str, how: str = "min", out: str | None = None) -> DataFrame:
    """Reduce a many-to-many bridge to one value per key (JON-6)."""
    fn = {"min": F.min, "max": F.max}[how]
    return df.groupBy(*_keys(keys)).agg(fn(value).alias(out or value))


def preagg_join(left: DataFrame, right: DataFrame, on, aggs: Sequence[Column],
                fill: Mapping[str, object] | None = None, right_on=None) -> DataFrame:
    """Aggregate the right side to the join grain, then left-join (JON-7).

    This is the fan-out guard: the right side has one row per key by
    construction, so the left row count is kept. ``fill`` replaces the
    NULLs of unmatched rows (e.g. 0 for sums).
    """
    ks = _keys(on)
    rks = _keys(right_on) if right_on else ks
    r = right.groupBy(*rks).agg(*aggs)
    if rks != ks:
        r = r.select(*[F.col(a).alias(b) for a, b in zip(rks, ks)],
                     *[c for c in r.columns if c not in rks])
    j = left.join(r, on=ks, how="left")
    if fill:
        j = j.fillna(dict(fill))
    return j


def _day(c: str) -> Column:
    return F.unix_date(F.to_date(F.col(c)))


def period_contains(items: DataFrame, periods: DataFrame, on, item_start: str, item_end: str,
                    period_start: str, period_end: str, how: str = "inner", all_periods: DataFrame | None = None) -> DataFrame:
    """Equi-join plus containment ``period_start <= item_start`` and
    ``item_end <= period_end`` (JON-8).

    Joined on the equality keys and a time bin, so one hot key is as many join
    keys as its periods cover bins. Bins are powers of two of days: a period
    goes to the width that is just as long as itself, where it covers at most
    two bins, and an item looks up the one bin its start falls in, for every
    width that some period has (found by one aggregate, no more than the bits
    of a day number). So neither one endless period nor many short ones blow
    anything up. The residual predicate decides. Items that end before they
    start can lie in a period whose bins they miss; those rows (only) are joined
    on the keys alone. ``how``: ``inner`` or ``left`` (an item without a period
    keeps one row). ``all_periods``: a cheaper frame with every period of ``periods``
    (more are harmless) to find the widths in, where ``periods`` comes out of joins.
    Both sides are read twice: store them where they come out of joins.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"period_contains cannot join {how}")
    ks = _keys(on)
    names = {k: f"_pc_{i}" for i, k in enumerate(ks)}
    first, last = _day(period_start), _day(period_end)

    def wide(df: DataFrame) -> DataFrame:
        return df.filter(F.col(period_start) <= F.col(period_end)).withColumn(
            "_pc_width", F.ceil(F.log2((last - first + 1).cast("double"))).cast("int"))
    p = wide(periods)
    p = p.withColumn("_pc_bin", F.explode(F.expr(
        f"sequence(shiftright(unix_date(to_date(`{period_start}`)), _pc_width), shiftright(unix_date(to_date(`{period_end}`)), _pc_width))")))
    p = p.withColumnsRenamed(names)
    widths = wide(periods if all_periods is None else all_periods).agg(F.collect_set("_pc_width").alias("_pc_widths")).scalar()
    inside = (F.col(period_start) <= F.col(item_start)) & (F.col(item_end) <= F.col(period_end))
    straight = F.coalesce(F.col(item_start) <= F.col(item_end), F.lit(False))

    def matched(left: DataFrame, right: DataFrame, more: Sequence[tuple[str, str]] = ()) -> DataFrame:
        cond = inside
        for k in ks:
            cond = cond & (F.col(k) == F.col(names[k]))
        for x, y in more:
            cond = cond & (F.col(x) == F.col(y))
        return left.join(right, cond)

    probe = items.filter(straight).withColumn("_pc_iw", F.explode(widths)).withColumn(
        "_pc_ib", F.expr(f"shiftright(unix_date(to_date(`{item_start}`)), _pc_iw)"))
    binned = matched(probe, p, [("_pc_iw", "_pc_width"), ("_pc_ib", "_pc_bin")])
    # stored: mostly there are none or few, and then the periods are not dealt once more to meet them
    bent = matched(stored(items.filter(~straight & F.col(item_start).isNotNull() & F.col(item_end).isNotNull())),
                   periods.withColumnsRenamed(names))
    keep = [*items.columns, *[c for c in periods.columns if c not in ks]]
    out = binned.select(*keep).unionByName(bent.select(*keep))
    if how == "inner":
        return out
    # rows without a match, repeated and NULL ones included: equal items match alike, so compare whole rows
    item = F.struct(*items.columns)
    some = out.select(F.xxhash64(item).alias("_pc_h"), item.alias("_pc_item")).distinct()
    alone = items.withColumn("_pc_h0", F.xxhash64(item)).join(
        some, (F.col("_pc_h0") == F.col("_pc_h")) & item.eqNullSafe(F.col("_pc_item")), "left_anti").drop("_pc_h0")
    return out.unionByName(alone, allowMissingColumns=True)


def like_literal(text: str) -> str:
    """LIKE pattern from text with ``_`` and ``%`` escaped (fix for D-28)."""
    return text.replace("\\", "\\\\").replace("_", "\\_").replace("%", "\\%")


def poly_ref(df: DataFrame, type_col: str, id_col: str,
             targets: Mapping[str, tuple[Column | str, DataFrame, str, str]]) -> DataFrame:
    """Polymorphic reference (JON-10, JON-11).

    ``targets`` maps an output sk column to ``(match, dim, dim_key, dim_sk)``;
    ``match`` is a Column predicate on the left row or a LIKE pattern on
    ``type_col``. Each target is a left join whose ON carries the left-side
    predicate, so rows of other types pass through with a NULL key and the
    plan stays an equi-join.
    """
    out = df
    for i, (sk_out, (match, dim, dim_key, dim_sk)) in enumerate(targets.items()):
        pred = match if isinstance(match, Column) else F.upper(F.col(type_col)).like(match)
        d = unique_on(dim.select(F.col(dim_key).alias(f"_pk{i}"), F.col(dim_sk).alias(f"_ps{i}")),
                      f"_pk{i}", [f"_ps{i}"], what=f"poly_ref({sk_out})")
        out = (out.join(d, (out[id_col] == d[f"_pk{i}"]) & pred, "left")
                  .withColumnRenamed(f"_ps{i}", sk_out).drop(f"_pk{i}"))
    return out


def const_lookup(df: DataFrame, dim: DataFrame, predicate: Column, cols: Sequence[str]) -> DataFrame:
    """Constant-key lookup (JON-12): attributes of the single dim row matching
    ``predicate`` added to every row.

    Built as scalar subqueries (``DataFrame.scalar()``), so there is no join
    at all; more than one matching row fails the query.
    """
    m = dim.filter(predicate)
    guard = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("const_lookup: more than one row")))
    adds = {}
    for c in cols:
        t = dim.schema[c].dataType
        adds[c] = m.select(F.coalesce(guard.cast(t), F.max(c))).scalar()
    return df.withColumns(adds)


def first_hit(df: DataFrame, paths: Sequence[tuple[DataFrame, Mapping[str, str], str]], out: str) -> DataFrame:
    """Several lookup paths, first non-NULL wins (JON-18).

    ``paths`` holds ``(lookup, {left_col: lookup_col}, value_col)``; every
    lookup is made unique on its key first.
    """
    cur = df
    hits = []
    for i, (lk, mapping, val) in enumerate(paths):
        names = {lc: f"_fh{i}_{j}" for j, lc in enumerate(mapping)}
        u = unique_on(lk.select(*[F.col(rc).alias(names[lc]) for lc, rc in mapping.items()],
                                F.col(val).alias(f"_fh{i}_v")),
                      list(names.values()), [f"_fh{i}_v"], what=f"first_hit path {i}")
        cond = None
        for lc in mapping:
            c = cur[lc] == u[names[lc]]
            cond = c if cond is None else cond & c
        cur = cur.join(u, cond, "left").drop(*names.values())
        hits.append(F.col(f"_fh{i}_v"))
    return cur.withColumn(out, F.coalesce(*hits)).drop(*[f"_fh{i}_v" for i in range(len(paths))])


def prefix_join(df: DataFrame, lookup: DataFrame, code: str, n: int, lookup_key: str,
                values: Sequence[str]) -> DataFrame:
    """``LEFT(code, n) = lookup_key`` as a derived column plus equi-join (JON-17)."""
    u = unique_on(lookup.select(F.col(lookup_key).alias("_px_key"), *values), "_px_key", list(values),
                  what="prefix_join")
    d = df.withColumn("_px", F.substring(F.col(code), 1, n))
    return d.join(u, d["_px"] == u["_px_key"], "left").drop("_px", "_px_key")


def net_new(incoming: DataFrame, existing: DataFrame, on) -> DataFrame:
    """Rows whose key is not in ``existing`` (JON-13)."""
    return incoming.join(existing.select(*_keys(on)).distinct(), on=_keys(on), how="left_anti")


def not_in_guarded(df: DataFrame, other: DataFrame, col: str, other_col: str) -> DataFrame:
    """``col NOT IN (SELECT other_col WHERE other_col IS NOT NULL)`` as an
    anti-join (JON-14); NULL ``col`` rows are kept, as NOT IN with the guard
    would reject them only when the list is non-empty — we keep them as roots."""
    o = other.select(F.col(other_col).alias("_ni")).filter(F.col("_ni").isNotNull()).distinct()
    return df.join(o, df[col] == o["_ni"], "left_anti")


def semi(df: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """Restrict to a key set (JON-21)."""
    return df.join(keys_df.select(*_keys(on)).distinct(), on=_keys(on), how="left_semi")


def cast_join(df: DataFrame, other: DataFrame, left: str, right: str, dtype: str, how: str = "left") -> DataFrame:
    """Join where the id types differ: cast both sides once (JON-16)."""
    l2 = df.withColumn("_cj", col_of(left).cast(dtype))
    r2 = other.withColumn("_cj_r", col_of(right).cast(dtype))
    return l2.join(r2, l2["_cj"] == r2["_cj_r"], how).drop("_cj", "_cj_r")
