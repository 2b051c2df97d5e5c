"""Hierarchical null imputation (#42-#53).

Semantics (SURVEY 2.13): at each level the statistic of a key group is taken
over the column *as already filled by the earlier levels* (T8); NULL keys
never match (T9); a mode ignores NULLs and breaks ties by the smallest value
(T13); the review cascade overwrites with a mask taken once (T15).

Scale design: only key tuples that have something to fill are carried from
level to level -- a small table with a NULL count per tuple and column. Per
level,

* sums and counts of the original values come from one partial aggregate of
  the fact table by the level's key (never a window, so a hot key is one
  pre-aggregated row per task);
* the tuples filled earlier add ``fill x n_null`` to that sum and ``n_null``
  to that count, which reproduces the sequential cascade exactly;
* the level's means go back to the tuples, and only those are written;
* the global level is a one-row aggregate of the fact table plus what the
  tuples' fills add.

What a cascade has learned is a table per level key (a mean or mode per
key, far fewer rows than key tuples) and a few frame-wide values. A row's
fill is read from its keys' tables, level by level. Tables of up to
``BROADCAST_ROWS`` rows are broadcast, so the fact table is not shuffled; a
larger one is joined by its key. The fill operators read disjoint columns
(payment runs on the original review scores, as in the reference), so
``impute_all`` takes every summary from the same filtered mart and applies
all fills in one projection.
"""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import add_days, add_whole_days, floor_days
from ..plans.session import cut_bucketed, cut_lineage

# The columns the cascades fill and their keys.
DATE_COLS = ["order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"]
PURCHASE = "order_purchase_timestamp"
SELLER_KEYS = ["seller_id", "seller_city", "seller_state"]
CUSTOMER_KEYS = ["customer_unique_id", "customer_city", "customer_state"]
PLACE_KEYS = ["customer_city", "customer_state"]
COORD_COLS = ["customer_lat", "customer_lng"]
PRODUCT_INFO_COLS = ["product_description_lenght", "product_name_lenght"]
DIMENSION_COLS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
#: Compression of the written fact tables and key tables.
CODEC = "zstd"
DELIVERED = "delivered"
CATEGORY = "product_category_name"
REVIEW = "review_score"


@dataclass
class MeanSpec:
    """Mean cascade of ``col`` over ``levels`` (key columns, coarsest last),
    optionally ending with the global mean. ``stale=True`` is the review
    variant (T15): from the second level on, every originally-NULL row is
    overwritten by the level mean when any row of the frame is still NULL."""
    col: str
    levels: list[str]
    global_level: bool = False
    stale: bool = False


@dataclass
class Learned:
    """What cascades know: per level key its tables (``_key`` and a column per
    filled one), the stale-mask flags by ``<column>.<key>``, the global means."""
    tables: dict[str, list[DataFrame]] = field(default_factory=dict)
    flags: dict[str, bool] = field(default_factory=dict)
    overall: dict[str, float | None] = field(default_factory=dict)


def _fname(c: str) -> str:
    return f"_f_{c}"


def _safe_div(s: Column, n: Column) -> Column:
    return F.when(n > 0, s / n)


def _keep(S: DataFrame) -> DataFrame:
    """Write a level's table (NULL-bearing key tuples, or their level keys) to
    the shared checkpoint folder and continue from it.

    Each level joins the table with an aggregate of itself; without the cut
    the plan doubles per level and the driver spends its time re-planning.
    """
    return cut_lineage(S, codec=CODEC)


# ---------------------------------------------------------------- summaries
def _any_null(cols: list[str]) -> Column:
    return functools.reduce(lambda x, y: x | y, [F.col(c).isNull() for c in cols])


def null_tuples(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Key tuples with a NULL in a column, and how many rows miss each (``_z_<col>``)."""
    return (df.where(_any_null(cols)).groupBy(*keys)
            .agg(*[F.count_if(F.col(c).isNull()).alias(f"_z_{c}") for c in cols]))


def _known(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Sum and count of the original values per group of ``key``; map-side
    partial aggregation, whatever the skew."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.sum(x).alias(f"_s_{c}"), F.count(x).alias(f"_n_{c}")]
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_kk")).agg(*aggs)


def _level_means(df: DataFrame, S: DataFrame, key: str, cols: list[str], stale: set[str],
                 global_cols: set[str]) -> tuple[DataFrame, dict[str, bool], dict[str, float | None]]:
    """Per group of ``key`` that has a tuple in S (the NULL key its own group):
    the level mean ``_m_`` (NULL for the NULL key, T9).

    Frame-wide values -- the "any NULL left" flag of the stale cascade and the
    global mean after this level -- are one-row aggregates, fetched once.
    """
    aggs = []
    for c in cols:
        f, z = F.col(_fname(c)), F.col(f"_z_{c}")
        aggs += [F.sum(F.when(f.isNotNull(), z * f).otherwise(0.0)).alias(f"_A_{c}"),
                 F.sum(F.when(f.isNotNull(), z).otherwise(0)).alias(f"_B_{c}"),
                 F.sum(F.when(f.isNotNull(), 0).otherwise(z)).alias(f"_C_{c}")]
    earlier = S.groupBy(F.col(key).alias("_lk")).agg(*aggs)
    g = earlier.join(_known(df, key, cols), F.col("_lk") == F.col("_kk"), "left").drop("_kk")
    g = g.withColumns({f"_m_{c}": F.when(F.col("_lk").isNotNull(), _safe_div(
        F.coalesce(f"_s_{c}", F.lit(0.0)) + F.col(f"_A_{c}"), F.coalesce(f"_n_{c}", F.lit(0)) + F.col(f"_B_{c}")))
        for c in cols})
    g = _keep(g.select("_lk", *[f"{x}{c}" for c in cols for x in ("_m_", "_A_", "_B_", "_C_")]))
    means = g.select("_lk", *[f"_m_{c}" for c in cols])
    if not stale and not global_cols:
        return means, {}, {}
    totals = [F.max(F.col(f"_C_{c}") > 0).alias(f"_any_{c}") for c in cols if c in stale]
    for c in (c for c in cols if c in global_cols):
        m = F.col(f"_m_{c}")
        totals += [F.sum(F.col(f"_A_{c}") + F.when(m.isNotNull(), F.col(f"_C_{c}") * m).otherwise(0.0)).alias(f"_s_{c}"),
                   F.sum(F.col(f"_B_{c}") + F.when(m.isNotNull(), F.col(f"_C_{c}")).otherwise(0)).alias(f"_n_{c}")]
    row = g.agg(*totals).first()
    flags = {c: bool(row[f"_any_{c}"]) for c in cols if c in stale}
    overall = {}
    if global_cols:
        all_ = df.agg(*[x for c in global_cols for x in (
            F.sum(F.col(c).cast("double")).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}"))]).first()
        for c in global_cols:
            total = (all_[f"_s_{c}"] or 0.0) + (row[f"_s_{c}"] or 0.0)
            n = all_[f"_n_{c}"] + (row[f"_n_{c}"] or 0)
            overall[c] = total / n if n else None
    return means, flags, overall


def _level_stats(df: DataFrame, S: DataFrame, key: str, cols: list[str], stale: set[str],
                 global_cols: set[str]) -> DataFrame:
    """The level's means with the frame-wide values as literal columns."""
    means, flags, overall = _level_means(df, S, key, cols, stale, global_cols)
    return means.withColumns({f"_any_{c}": F.lit(v) for c, v in flags.items()}
                             | {f"_g_{c}": F.lit(v).cast("double") for c, v in overall.items()})


def _level_order(specs: list[MeanSpec]) -> list[str]:
    """One visiting order of all level keys that keeps every spec's own
    order (a topological sort of the "comes before" relation)."""
    keys = []
    for sp in specs:
        keys += [k for k in sp.levels if k not in keys]
    before = {k: set() for k in keys}
    for sp in specs:
        for i, k in enumerate(sp.levels):
            before[k].update(sp.levels[:i])
    order: list[str] = []
    while len(order) < len(keys):
        ready = [k for k in keys if k not in order and before[k] <= set(order)]
        if not ready:
            raise ValueError("level orders of the cascades contradict each other")
        order.append(ready[0])
    return order


def fill_value(spec: MeanSpec, values: dict, flags: dict, overall: dict) -> Column:
    """The fill of a NULL from its keys' means, level by level."""
    out = F.lit(None).cast("double")
    for i, k in enumerate(spec.levels):
        stale = spec.stale and i > 0 and flags.get(f"{spec.col}.{k}", False)
        out = values[k] if stale else F.coalesce(out, values[k])
    if spec.global_level:
        out = F.coalesce(out, F.lit(overall.get(spec.col)).cast("double"))
    return out


def _cascade(df: DataFrame, keys: list[str], specs: list[MeanSpec], learned: Learned) -> DataFrame:
    """Run mean cascades over ``df`` into ``learned``; gives the key tuples
    with something to fill and their ``_f_<col>`` (after the last level lazily).

    Level keys are visited in one order compatible with every spec; each
    column takes part only at its own levels, so its fills stay sequential.
    Columns that share a level share one aggregate and one join.
    """
    S = _keep(null_tuples(df, keys, [sp.col for sp in specs])
              .withColumns({_fname(sp.col): F.lit(None).cast("double") for sp in specs}))
    order = _level_order(specs)
    by_col = {sp.col: sp for sp in specs}
    for k in order:
        cols = [sp.col for sp in specs if k in sp.levels]
        stale = {c for c in cols if by_col[c].stale and by_col[c].levels[0] != k}
        glob = {c for c in cols if by_col[c].global_level and by_col[c].levels[-1] == k}
        means, flags, overall = _level_means(df, S, k, cols, stale, glob)
        learned.flags.update({f"{c}.{k}": v for c, v in flags.items()})
        learned.overall.update(overall)
        learned.tables.setdefault(k, []).append(means.where(F.col("_lk").isNotNull()).select(
            F.col("_lk").cast("string").alias("_key"), *[F.col(f"_m_{c}").alias(c) for c in cols]))
        S = S.join(means, S[k].eqNullSafe(means["_lk"]), "left").drop("_lk")
        upd = {}
        for c in cols:
            f, m = F.col(_fname(c)), F.col(f"_m_{c}")
            v = m if flags.get(c) else F.coalesce(f, m)
            upd[_fname(c)] = F.coalesce(v, F.lit(overall[c]).cast("double")) if c in glob else v
        S = S.withColumns(upd).drop(*[f"_m_{c}" for c in cols])
        if k != order[-1]:
            S = _keep(S)
    return S.select(*keys, *[_fname(sp.col) for sp in specs])


def cascade_means(df: DataFrame, keys: list[str], specs: list[MeanSpec]) -> DataFrame:
    """Mean cascades over ``df``: per key tuple with something to fill,
    ``_f_<col>`` per spec."""
    return _cascade(df, keys, specs, Learned())


def _mode_cascade(df: DataFrame, col: str, levels: list[str], learned: Learned) -> DataFrame:
    """#47: mode cascade into ``learned``; gives, per key tuple that has NULLs
    in ``col``, the fill ``_f_<col>`` (after the last level lazily).

    Level k sees value counts by (k, value): those of the non-NULL rows,
    straight from the fact table (partial aggregation, so a hot key is one
    row per task), plus the NULL rows already filled by earlier levels,
    which come from a small table of NULL rows per key tuple. A tuple
    filled at level i adds its NULL count to its new value at level i+1
    (T8); ties go to the smallest value (T13).
    """
    f = _fname(col)
    v = F.col(col)
    # counts of the non-NULL rows for every level in one scan: each row is
    # tagged once per level, then one partial aggregate (map-side combine)
    tagged = F.explode(F.array(*[F.struct(F.lit(i).alias("_lvl"), F.col(k).cast("string").alias("_lk"))
                                 for i, k in enumerate(levels)]))
    known_all = _keep(df.where(v.isNotNull()).select(tagged.alias("_t"), v.alias("_v"))
                      .where(F.col("_t._lk").isNotNull())
                      .groupBy(F.col("_t._lvl").alias("_lvl"), F.col("_t._lk").alias("_lk"), "_v")
                      .agg(F.count(F.lit(1)).alias("_cnt")))
    T = _keep(df.where(v.isNull()).groupBy(*levels).agg(F.count(F.lit(1)).alias("_z"))
              .withColumn(f, F.lit(None).cast(df.schema[col].dataType)))
    for i, k in enumerate(levels):
        known = known_all.where(F.col("_lvl") == i).select("_lk", "_v", "_cnt")
        filled = (T.where(F.col(f).isNotNull() & F.col(k).isNotNull())
                   .select(F.col(k).cast("string").alias("_lk"), F.col(f).alias("_v"),
                           F.col("_z").alias("_cnt")))
        modes = _keep(known.unionByName(filled).groupBy("_lk", "_v").agg(F.sum("_cnt").alias("_cnt"))
                      .groupBy("_lk")
                      .agg(F.min_by("_v", F.struct(-F.col("_cnt"), F.col("_v"))).alias("_mode")))
        learned.tables.setdefault(k, []).append(modes.select(F.col("_lk").alias("_key"), F.col("_mode").alias(col)))
        T = T.join(modes, T[k].cast("string") == modes["_lk"], "left") \
             .withColumn(f, F.coalesce(F.col(f), F.col("_mode"))).drop("_lk", "_mode")
        if k != levels[-1]:
            T = _keep(T)
    return T.select(*levels, f)


def mode_fills(df: DataFrame, col: str, levels: list[str]) -> DataFrame:
    """#47: per key tuple that has NULLs in ``col``, the fill ``_f_<col>``."""
    return _mode_cascade(df, col, levels, Learned())


# ------------------------------------------------------------------ apply
#: Parts into which rows without any key are dealt for a fill join.
NO_KEY_PARTS = 64
#: Rows up to which a key's table is broadcast to the fact table.
BROADCAST_ROWS = 500_000


def looked_up(df: DataFrame, key: str, table: DataFrame, small: bool = False) -> DataFrame:
    """The table's columns as ``_L_<key>_<column>``; a NULL key matches
    nothing. Unless the table is ``small`` (broadcast), NULL keys are dealt
    into parts for the join."""
    right = table.select(F.col("_key").alias("_rk"), *[F.col(c).alias(f"_L_{key}_{c}") for c in table.columns if c != "_key"])
    if small:
        return df.join(F.broadcast(right), F.col(key).cast("string") == F.col("_rk"), "left").drop("_rk")
    part = F.pmod(F.xxhash64("order_id", "order_item_id" if "order_item_id" in df.columns else "order_id"), F.lit(NO_KEY_PARTS))
    at = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\0"), part.cast("string")))
    return df.withColumn("_at", at).join(right, (F.col("_at") == F.col("_rk")) & F.col(key).isNotNull(), "left").drop("_at", "_rk")


def merged_tables(learned: list[Learned]) -> dict[str, DataFrame]:
    """One table per level key from those of the cascades, written."""
    parts: dict[str, list[DataFrame]] = {}
    for some in learned:
        for k, ts in some.tables.items():
            parts.setdefault(k, []).extend(ts)
    return {k: cut_lineage(functools.reduce(lambda a, b: a.join(b, "_key", "full"), ts)) for k, ts in parts.items()}


def with_fills(df: DataFrame, tables: dict[str, DataFrame], specs: list[MeanSpec], flags: dict, overall: dict,
               modes: dict[str, list[str]], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with the fill ``_f_<col>`` of every spec and of every column of
    ``modes`` (column -> its levels), looked up by the row's keys.

    With tables to broadcast every row passes, in the order in which it was
    written. Otherwise only rows with a NULL in a filled column are joined
    (a fill never changes a non-NULL value, T15 included), so the joins
    shuffle the missing rows, not the fact table; the two parts are disjoint
    (the test is never NULL)."""
    small = {k: tables[k].count() <= broadcast_rows for k in sorted(tables)}
    fills = {_fname(sp.col): fill_value(sp, {k: F.col(f"_L_{k}_{sp.col}") for k in sp.levels}, flags, overall) for sp in specs}
    # the first mode found; as a higher-order function it leaves the stage's generated method, so the fills are compiled
    # by themselves, in small methods: with the joins, the method was above the 8000 bytes up to which the JVM compiles one
    fills |= {_fname(c): F.get(F.filter(F.array(*[F.col(f"_L_{k}_{c}") for k in levels]), lambda v: v.isNotNull()), F.lit(0))
              for c, levels in modes.items()}
    need = _any_null([sp.col for sp in specs] + list(modes))
    out = df if all(small.values()) else df.where(need)
    for k in small:
        out = looked_up(out, k, tables[k], small[k])
    out = out.select(*df.columns, *[v.alias(c) for c, v in fills.items()])
    if all(small.values()):
        return out
    return out.unionByName(df.where(~need).withColumns({c: F.lit(None).cast(out.schema[c].dataType) for c in fills}))


def _null_safe_join(df: DataFrame, fills: DataFrame, keys: list[str]) -> DataFrame:
    """Fill values to the rows by their key tuple, NULL matching NULL. Rows
    whose keys are all NULL (they may be many) are dealt into parts, to each
    of which goes a copy of their one fill row."""
    def no_key() -> Column:
        return functools.reduce(lambda x, y: x & y, [F.col(k).isNull() for k in keys])

    others = [c for c in df.columns if c not in keys]
    part = F.when(no_key(), F.pmod(F.xxhash64(*others), F.lit(NO_KEY_PARTS)).cast("int")).otherwise(F.lit(0))
    parts = F.when(no_key(), F.sequence(F.lit(0), F.lit(NO_KEY_PARTS - 1))).otherwise(F.array(F.lit(0)))
    r = fills.withColumn("_r_part", F.explode(parts)) \
             .select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_r_part",
                     *[c for c in fills.columns if c.startswith("_f_")])
    left = df.withColumn("_part", part)
    cond = F.col("_part") == F.col("_r_part")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(r, cond, "left").drop("_part", "_r_part", *[f"_k_{k}" for k in keys])


def delivered_only(df: DataFrame) -> DataFrame:
    """#43."""
    return df.where(F.col("order_status") == DELIVERED)


def has_product(df: DataFrame) -> DataFrame:
    """#44 (turns the item and product LEFT joins into INNER joins)."""
    return df.where(F.col("product_id").isNotNull())


def with_day_offsets(df: DataFrame) -> DataFrame:
    """Dates as whole days since purchase (``_d_<col>``, T10)."""
    return df.withColumns({f"_d_{c}": floor_days(c, PURCHASE).cast("double") for c in DATE_COLS})


def _without_dates(df: DataFrame) -> DataFrame:
    """What is written of a mart whose dates are filled: the day offsets say them."""
    return with_day_offsets(df).drop(*DATE_COLS)


def seller_specs(dates: bool = True, product_info: bool = True) -> list[MeanSpec]:
    """#46 and #48: cascades on (seller_id, seller_city, seller_state)."""
    specs = []
    if dates:
        specs += [MeanSpec(f"_d_{c}", SELLER_KEYS, True) for c in DATE_COLS]
    if product_info:
        specs += [MeanSpec(c, SELLER_KEYS, True) for c in PRODUCT_INFO_COLS]
    return specs


def coord_specs() -> list[MeanSpec]:
    """#45: cascades on (customer_city, customer_state)."""
    return [MeanSpec(c, PLACE_KEYS) for c in COORD_COLS]


def customer_specs(dimensions: bool = True, review: bool = True, masked: bool = False) -> list[MeanSpec]:
    """#49 and #51: cascades on (customer_unique_id, city, state)."""
    specs = []
    if dimensions:
        specs += [MeanSpec(c, CUSTOMER_KEYS) for c in DIMENSION_COLS]
    if review:
        specs.append(MeanSpec(REVIEW, CUSTOMER_KEYS, stale=not masked))
    return specs


CATEGORY_KEYS = ["customer_unique_id", "seller_id", "seller_city", "seller_state"]
# the columns ``impute_all`` fills from the cascades (dates as day offsets)
FILLED_COLS = ([f"_d_{c}" for c in DATE_COLS] + PRODUCT_INFO_COLS + COORD_COLS + DIMENSION_COLS
               + [REVIEW, CATEGORY])


def _filled(df: DataFrame, cascades: list[tuple[list[str], list[MeanSpec]]], category: bool = False,
            broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (written) with the fills of the mean cascades and, with
    ``category``, of #47. The cascades are independent chains of small jobs,
    submitted from driver threads so that they overlap on the cluster."""
    def mean(cascade: tuple[list[str], list[MeanSpec]]) -> Learned:
        learned = Learned()
        _cascade(df, *cascade, learned)
        return learned

    def mode(_) -> Learned:
        learned = Learned()
        _mode_cascade(df, CATEGORY, CATEGORY_KEYS, learned)
        return learned

    with ThreadPoolExecutor(max_workers=4) as pool:
        jobs = [pool.submit(mean, c) for c in cascades] + ([pool.submit(mode, None)] if category else [])
        learned = [j.result() for j in jobs]
    return with_fills(df, merged_tables(learned), [sp for _, specs in cascades for sp in specs],
                      {k: v for x in learned for k, v in x.flags.items()}, {k: v for x in learned for k, v in x.overall.items()},
                      {CATEGORY: CATEGORY_KEYS} if category else {}, broadcast_rows)


def payment_modes(base: DataFrame) -> DataFrame:
    """#50: one-row global modes over rows whose (original) score is 1.0."""
    bad = base.where(F.col(REVIEW) == 1.0)
    return bad.agg(F.mode("payment_type", True).alias("_pm_type"),
                   F.mode("payment_sequential", True).alias("_pm_seq"),
                   F.mode("payment_installments", True).alias("_pm_inst"))


def _apply_payment(df: DataFrame, modes: DataFrame) -> DataFrame:
    """The modes are one row of three values (one distributed aggregate,
    fetched once, like a fitted model's parameters) applied as literals:
    no join, and no subquery evaluated once per referencing expression."""
    return payment_filled(df, modes.first().asDict())


def payment_filled(df: DataFrame, modes: dict) -> DataFrame:
    """The payment columns of rows without a total, from known modes."""
    pm = {m: F.lit(modes[m]).cast(df.schema[c].dataType) for m, c in (
        ("_pm_type", "payment_type"), ("_pm_seq", "payment_sequential"), ("_pm_inst", "payment_installments"))}
    miss = F.col("total_payment").isNull()
    return df.withColumns({
        "total_payment": F.when(miss, F.col("freight_value") + F.col("price")).otherwise(F.col("total_payment")),
        "payment_type": F.when(miss, pm["_pm_type"]).otherwise(F.col("payment_type")),
        "payment_sequential": F.when(miss, pm["_pm_seq"]).otherwise(F.col("payment_sequential")),
        "payment_installments": F.when(miss, pm["_pm_inst"]).otherwise(F.col("payment_installments")),
    })


def _apply_dates(df: DataFrame) -> DataFrame:
    """Every date becomes purchase + (filled) days (T11, T12)."""
    out = {}
    for c in DATE_COLS:
        # the days of a known date are whole: only a fill has a fraction to round
        out[c] = add_days(PURCHASE, F.col(f"_d_{c}"), F.col(_fname(f"_d_{c}")))
    return df.withColumns(out).drop(*[f"_d_{c}" for c in DATE_COLS],
                                    *[_fname(f"_d_{c}") for c in DATE_COLS])


def _apply_means(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.col(_fname(c))) for c in cols}) \
             .drop(*[_fname(c) for c in cols])


def fill_review_replies(df: DataFrame) -> DataFrame:
    """#52 (T16): message flag; a missing answer moves the review to the
    delivery date and the answer 999 days after it."""
    no_answer = F.col("review_answer_timestamp").isNull()
    delivered = F.col("order_delivered_customer_date")
    return df.withColumns({
        "has_review_message": F.col("review_comment_message").isNotNull().cast("int"),
        "review_creation_date": F.when(no_answer, delivered).otherwise(F.col("review_creation_date")),
        "review_answer_timestamp": F.when(no_answer, add_whole_days(delivered, 999))
                                    .otherwise(F.col("review_answer_timestamp")),
    })


# ------------------------------------------------- single-operator entries
def fill_coords(df: DataFrame) -> DataFrame:
    """#45: customer coordinates by customer city, then state."""
    df = cut_lineage(df, codec=CODEC)  # several small jobs read it
    return _apply_means(_filled(df, [(PLACE_KEYS, coord_specs())]), COORD_COLS)


def fill_dates(df: DataFrame) -> DataFrame:
    """#46: the four dates by seller -> seller city -> seller state -> global."""
    base = cut_lineage(_without_dates(df), codec=CODEC)  # several small jobs read it
    return _apply_dates(_filled(base, [(SELLER_KEYS, seller_specs(product_info=False))])).select(*df.columns)


def fill_category(df: DataFrame) -> DataFrame:
    """#47: category mode by customer -> seller -> seller city -> seller state."""
    df = cut_lineage(df, codec=CODEC)  # several small jobs read it
    return _apply_means(_filled(df, [], category=True), [CATEGORY])


def fill_product_info(df: DataFrame) -> DataFrame:
    """#48: text lengths by seller -> seller city -> seller state -> global."""
    df = cut_lineage(df, codec=CODEC)  # several small jobs read it
    return _apply_means(_filled(df, [(SELLER_KEYS, seller_specs(dates=False))]), PRODUCT_INFO_COLS)


def fill_dimensions(df: DataFrame) -> DataFrame:
    """#49: weight and sizes by customer -> customer city -> customer state."""
    df = cut_lineage(df, codec=CODEC)  # several small jobs read it
    return _apply_means(_filled(df, [(CUSTOMER_KEYS, customer_specs(review=False))]), DIMENSION_COLS)


def fill_payment(df: DataFrame) -> DataFrame:
    """#50: total = freight + price; type/sequence/instalments = modes of
    the score-1 rows (left NULL when there are none, T14)."""
    df = cut_lineage(df, codec=CODEC)  # the modes and the fill read it
    return _apply_payment(df, payment_modes(df))


def fill_review(df: DataFrame, masked: bool = False) -> DataFrame:
    """#51: review score by customer -> city -> state (stale mask unless
    ``masked=True``, which gives the conventional cascade)."""
    df = cut_lineage(df, codec=CODEC)  # several small jobs read it
    return _apply_means(_filled(df, [(CUSTOMER_KEYS, customer_specs(dimensions=False, masked=masked))]), [REVIEW])


# ------------------------------------------------------------- composite
def impute_all(mart: DataFrame, masked_review: bool = False, broadcast_rows: int = BROADCAST_ROWS,
               by_order: bool = False) -> DataFrame:
    """#53: filters, then every fill from small tables of the same base frame,
    which is written once (this call runs jobs).

    ``by_order``: the mart comes from joins on ``order_id`` (``mart.build_mart``),
    so its rows are dealt by it already. They are then written in buckets of it,
    and an aggregate by order needs no exchange. Another mart would be shuffled
    for that, row by row."""
    # several readers (the cascades, the payment modes, the final joins): write once
    base = _without_dates(has_product(delivered_only(mart)))
    base = cut_bucketed(base, "order_id", codec=CODEC) if by_order else cut_lineage(base, codec=CODEC)
    out = _filled(base, [(SELLER_KEYS, seller_specs()), (PLACE_KEYS, coord_specs()), (CUSTOMER_KEYS, customer_specs(masked=masked_review))],
                  category=True, broadcast_rows=broadcast_rows)
    out = _apply_means(out, COORD_COLS + [CATEGORY] + PRODUCT_INFO_COLS + DIMENSION_COLS + [REVIEW])
    out = _apply_dates(out).select(*mart.columns)
    # payment reads the original review scores: its modes come from ``base``
    out = _apply_payment(out, payment_modes(base))
    return fill_review_replies(out)
