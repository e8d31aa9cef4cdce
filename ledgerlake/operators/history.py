"""Type-2 history (SCD2) on immutable files.

A history table is the entity's columns plus:
  version_id          md5 of key text and valid_from text (stable id of a version)
  version_updated_at  the change time the version was opened with
  valid_from          start of the version
  valid_to            end of the version, NULL while open

One run touches only *open* versions: a single full outer join of open rows with the
source decides, per key, keep / close + open / open. Closed versions pass through
untouched (append-only), so cost follows the number of live keys, not the history length.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.joins import null_spread

HISTORY_COLUMNS = ["version_id", "version_updated_at", "valid_from", "valid_to"]


def _version_id(key: Column, valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), valid_from.cast("string")))


def _open_rows(src: DataFrame, key: str, valid_from: Column, updated: Column) -> DataFrame:
    cols = [F.col(c) for c in src.columns]
    return src.select(
        *cols,
        _version_id(F.col(key), valid_from).alias("version_id"),
        updated.cast("timestamp_ntz").alias("version_updated_at"),
        valid_from.cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def _scd2(
    history: DataFrame | None,
    src: DataFrame,
    key: str,
    changed,
    new_from,
    new_updated,
) -> DataFrame:
    if history is None:
        return _open_rows(src, key, new_from(F.col), new_updated(F.col))
    src_cols = src.columns
    hist_cols = src_cols + HISTORY_COLUMNS
    history = history.select(*hist_cols)
    opened = history.filter(F.col("valid_to").isNull())
    closed = history.filter(F.col("valid_to").isNotNull())

    h = opened.select(F.col(key).alias("_k"), F.struct(*hist_cols).alias("h"))
    s = src.select(F.col(key).alias("_k"), F.struct(*src_cols).alias("s"))
    # NULL keys never match: they open a version each run, and are spread over the shuffle
    h, s = (null_spread(side, F.col("_k").isNull(), "_j").drop("_j_null") for side in (h, s))
    j = h.join(s, ["_k", "_j_salt"], "full_outer")

    hv = lambda c: F.col("h").getField(c)
    sv = lambda c: F.col("s").getField(c)
    has_h, has_s = F.col("h").isNotNull(), F.col("s").isNotNull()
    is_changed = has_h & has_s & changed(hv, sv)
    start = new_from(sv)

    kept = F.when(has_h & ~is_changed, F.col("h"))
    ended = F.when(is_changed, F.col("h").withField("valid_to", start.cast("timestamp_ntz")))
    fresh = F.struct(
        *[sv(c).alias(c) for c in src_cols],
        _version_id(sv(key), start).alias("version_id"),
        new_updated(sv).cast("timestamp_ntz").alias("version_updated_at"),
        start.cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    born = F.when(has_s & (~has_h | is_changed), fresh)
    rows = j.select(F.explode(F.filter(F.array(kept, ended, born), lambda r: r.isNotNull())).alias("r"))
    return closed.unionByName(rows.select("r.*"))


def scd2_check(
    history: DataFrame | None,
    src: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: Column,
) -> DataFrame:
    """*check* strategy: a version changes when any check column IS DISTINCT FROM the open one.

    New key → open (valid_from = run_ts); changed → close at run_ts and open a new one;
    unchanged (other columns may differ) or missing from the source → left open.
    """

    def changed(hv, sv):
        diff = F.lit(False)
        for c in check_cols:
            diff = diff | ~hv(c).eqNullSafe(sv(c))
        return diff

    return _scd2(history, src, key, changed, lambda _g: run_ts, lambda _g: run_ts)


def scd2_timestamp(
    history: DataFrame | None,
    src: DataFrame,
    key: str,
    updated_at: str,
) -> DataFrame:
    """*timestamp* strategy: changed when the source's `updated_at` is later than the open
    version's; valid_from / valid_to are the source timestamps. A NULL never counts as newer."""

    def changed(hv, sv):
        return F.coalesce(sv(updated_at) > hv("version_updated_at"), F.lit(False))

    return _scd2(history, src, key, changed, lambda g: g(updated_at), lambda g: g(updated_at))


def scd2_from_log(
    log: DataFrame,
    key: str,
    order: Sequence[str],
    check_cols: Sequence[str],
    valid_from: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """History from a whole change log in one pass (backfill form of repeated check runs).

    Rows are ordered per key by `order` (ascending, NULLS FIRST; a total order expected); a
    row opens a version when its check columns differ from the previous row's; a version ends
    where the next version of the key starts. Output: log columns + valid_from, valid_to,
    is_current.

    Skew-safe: a key with more rows than an even share (`heavy_segments`) is cut into segments of its order, whose
    bounds are literals, so every branch of the plan cuts alike, whatever is reused or computed again. Neighbours are
    found inside a segment and across its edges through one boundary row per segment of a heavy key, a table of at
    most 2 * `partitions` rows.
    """
    vf = valid_from or order[0]
    n = partitions or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = log.columns
    pos = F.struct(*[F.col(c) for c in order])
    sig = F.struct(*[F.col(c) for c in check_cols])
    segment, heavy = heavy_segments(log, key, order, n)
    cut = log.withColumn("_seg", segment)
    w = Window.partitionBy(key, "_seg").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    in_key = Window.partitionBy("_hk").orderBy("_hs")

    def edges(rows: DataFrame, **aggs: Column) -> DataFrame:
        """One row per segment of the heavy keys."""
        return rows.filter(heavy).groupBy(F.col(key).alias("_hk"), F.col("_seg").alias("_hs")).agg(*[c.alias(k) for k, c in aggs.items()])

    def beside(rows: DataFrame, edge: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(edge), F.col(key).eqNullSafe(F.col("_hk")) & (F.col("_seg") == F.col("_hs")), "left")

    # the last row before each segment of a heavy key
    last = edges(cut, _last=F.max_by(sig, pos))
    carry = last.select("_hk", "_hs", F.lag("_last").over(in_key).alias("_carry"), (F.row_number().over(in_key) > 1).alias("_goes_on"))
    first_here = F.row_number().over(w) == 1
    local = cut.withColumn("_prev", F.lag(sig).over(w)).withColumn("_first_here", first_here)
    j = beside(local, carry)
    goes_on = F.col("_first_here") & F.coalesce(F.col("_goes_on"), F.lit(False))
    prev = F.when(goes_on, F.col("_carry")).otherwise(F.col("_prev"))
    versions = j.filter((F.col("_first_here") & ~goes_on) | ~sig.eqNullSafe(prev)).select(*cols, "_seg")

    # valid_to: the key's next version, inside the segment or in a later one
    start = F.struct(F.col(vf).alias("at"))  # a NULL start is a start, too
    firsts = edges(versions, _from=F.min_by(start, pos))
    nexts = firsts.select("_hk", "_hs", F.lead("_from").over(in_key).alias("_next"))
    v2 = beside(versions.withColumn("_lead", F.lead(start).over(w)), nexts)
    out = v2.select(
        *cols,
        F.col(vf).cast("timestamp_ntz").alias("valid_from"),
        F.coalesce(F.col("_lead"), F.col("_next")).getField("at").cast("timestamp_ntz").alias("valid_to"),
    )
    return out.withColumn("is_current", F.col("valid_to").isNull())


def heavy_segments(df: DataFrame, key: str, order: Sequence[str], parts: int, sampled: int = 50) -> tuple[Column, Column]:
    """(segment number, whether the key is heavy): cuts keys with over 1/parts of the rows along their order.

    There are at most `parts` such keys. Their bounds are quantiles of a sample of about `sampled` rows for each of
    the at most 2 * parts segments; which rows are sampled decides where the cuts lie, not any result.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = df.count()
    heavy = {r[0]: r["_n"] for r in counts.filter(F.col("_n") > F.lit(max(1.0, total / parts))).collect()}
    if not heavy:
        return F.lit(0), F.lit(False)
    kinds = {c: df.schema[c].dataType for c in (key, *order)}
    fixed = lambda c, v: F.lit(None if v is None else str(v)).cast(kinds[c]).alias(c)
    is_key = {k: F.col(key).eqNullSafe(fixed(key, k)) for k in heavy}
    any_key = reduce(lambda a, b: a | b, is_key.values())
    cuts = {k: -(-n * parts // total) for k, n in heavy.items()}
    share = min(1.0, sampled * sum(cuts.values()) / sum(heavy.values()))
    seen: dict = {k: [] for k in heavy}
    for r in df.filter(any_key).select(key, *order).sample(fraction=share, seed=7).collect():
        seen[r[0]].append(tuple(r)[1:])
    pos, out = F.struct(*[F.col(c).alias(c) for c in order]), F.lit(0)
    for k, rows in seen.items():
        rows.sort(key=lambda r: [(v is not None, v) for v in r])
        bounds = sorted({rows[len(rows) * i // cuts[k]] for i in range(1, cuts[k])} if rows else (), key=lambda r: [(v is not None, v) for v in r])
        number = F.lit(0)
        for b in bounds:
            number = number + (pos > F.struct(*[fixed(c, v) for c, v in zip(order, b, strict=True)])).cast("int")
        out = F.when(is_key[k], number).otherwise(out)
    return out, any_key


def present_history(history: DataFrame, keep_version_cols: bool = False) -> DataFrame:
    """Dimension view of a history: effective_from / effective_to / is_current."""
    base = [c for c in history.columns if c not in HISTORY_COLUMNS]
    extra = ["version_id"] if keep_version_cols else []
    return history.select(
        *base,
        *extra,
        F.col("valid_from").alias("effective_from"),
        F.col("valid_to").alias("effective_to"),
        F.when(F.col("valid_to").isNull(), F.lit(True)).otherwise(F.lit(False)).alias("is_current"),
    )


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())
