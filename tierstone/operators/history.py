"""Type-2 history: build, merge, read current and as-of state."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.operators.skew import (
    ROWS_PER_TASK,
    SEGMENT,
    HotKeys,
    find_hot_keys,
    only_hot_keys,
    with_neighbours,
    with_next_two,
    without_hot_keys,
)
from tierstone.sources.shared import cut_lineage
from tierstone.vocab import END_AT, START_AT


def scd2_build(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    untracked: str = "update",
    close_missing: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Versions of each key over time, with ``__START_AT`` and ``__END_AT`` (NULL = open).

    * A version opens when a ``tracked`` column changes (NULL-safe) against the previous sequence;
      ``tracked=None`` means every column that is not a key, the sequence or in ``drop``.
    * ``drop`` columns open no version and are left out; they win over ``tracked``.
    * Any other column, the sequence included, shows the last observation of its version
      (``untracked="update"``) or opens versions too (``untracked="version"``).
    * Rows with one key and sequence: the highest ``tiebreak`` wins, then a hash of the row.
    * Arrival order does not matter.  NULL keys and NULL sequences are left out; see
      :func:`unkeyed_rows`.
    * ``close_missing`` names the columns that scope a snapshot (for example the tenant): a key
      absent from the next snapshot of its scope is closed there.  None leaves it open.

    Keys of normal size take one shuffle and one sort.  Keys above ``rows_per_task`` rows, found by
    a job over the key columns when the frame is built, are cut into sequence segments and their
    copies are combined before the shuffle; without such keys the plan has no such branch.
    ``events`` is read more than once, so pass a stored table.
    """
    keyed = _keyed(events, keys, sequence)
    hot = find_hot_keys(keyed, keys, sequence, rows_per_task)
    if close_missing is not None:
        keyed = _with_due(keyed, sequence, close_missing)
    return _build(keyed, hot, keys, sequence, tracked, drop, tiebreak, untracked)


def _keyed(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    # one condition per column: these reach the scan, a dropna does not
    for c in [*keys, sequence]:
        df = df.filter(F.col(c).isNotNull())
    return df


def unkeyed_rows(events: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The rows :func:`scd2_build` leaves out, to be counted or stored apart."""
    missing = F.lit(False)
    for c in [*keys, sequence]:
        missing = missing | F.col(c).isNull()
    return events.filter(missing)


def _with_due(df: DataFrame, sequence: str, scope: Sequence[str]) -> DataFrame:
    """Add ``_due``: the next snapshot of the scope (one row per snapshot goes to the window)."""
    w = Window.partitionBy(*scope).orderBy(sequence)
    nexts = df.select(*scope, sequence).distinct().withColumn("_due", F.lead(sequence).over(w))
    return df.join(nexts, [*scope, sequence])


INNER = ("_start", "_due")


def _roles(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str] | None,
    drop: Sequence[str],
    untracked: str,
) -> tuple[list[str], list[str]]:
    """The columns a version shows, and those of them that open a new one."""
    if sequence in drop:
        raise ValueError("the sequence column marks the last observation and cannot be dropped")
    if untracked not in ("update", "version"):
        raise ValueError(f"untracked must be 'update' or 'version', not {untracked!r}")
    values = [c for c in df.columns if c not in keys and c not in drop and c not in INNER]
    if untracked == "version":
        return values, values
    if tracked is None:
        return values, [c for c in values if c != sequence]
    return values, [c for c in tracked if c in values]


def _build(
    df: DataFrame,
    hot: HotKeys | None,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str] | None,
    drop: Sequence[str],
    tiebreak: Sequence[str],
    untracked: str,
) -> DataFrame:
    keys = list(keys)
    values, compared = _roles(df, keys, sequence, tracked, drop, untracked)
    kept = [c for c in df.columns if c not in drop]
    # the hash covers what is kept, so dropped columns are not even read unless they break ties
    ranks = {c: c if c in kept else f"_t_{c}" for c in tiebreak}
    df = df.select(
        *kept,
        *[F.col(c).alias(n) for c, n in ranks.items() if n != c],
        F.xxhash64(*[c for c in kept if c not in INNER]).alias("_t_hash"),
    )
    newest = [*ranks.values(), "_t_hash"]

    finish = partial(_versions, keys=keys, sequence=sequence, values=values, compared=compared)
    if hot is None:
        return finish(_newest_by_sort(df, keys, sequence, newest))
    cold = _newest_by_sort(without_hot_keys(df, hot, keys), keys, sequence, newest)
    heavy = only_hot_keys(df, hot, keys, sequence)
    combined = _newest_by_combine(heavy, [*keys, SEGMENT], sequence, newest)
    return finish(cold).unionByName(finish(combined))


def _newest_by_sort(df: DataFrame, keys: list[str], sequence: str, newest: list[str]) -> DataFrame:
    """One row per key and sequence.  A row survives if the next row has another sequence, so the
    sort by (key, sequence, tiebreak) also serves every later window on (key, sequence)."""
    w = Window.partitionBy(*keys).orderBy(sequence, *newest)
    after = F.lead(sequence).over(w)
    return df.withColumn("_after", after).filter(~F.col("_after").eqNullSafe(F.col(sequence))).drop("_after", *_helpers(newest))


def _helpers(newest: list[str]) -> list[str]:
    return [c for c in newest if c.startswith("_t_")]


def _newest_by_combine(df: DataFrame, keys: list[str], sequence: str, newest: list[str]) -> DataFrame:
    """The same by aggregation, so that copies collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c != sequence and c not in _helpers(newest)]
    best = df.groupBy(*keys, sequence).agg(F.max_by(F.struct(*rest), F.struct(*newest)).alias("_best"))
    return best.select(*keys, sequence, "_best.*")


def _versions(
    df: DataFrame, keys: list[str], sequence: str, values: list[str], compared: list[str]
) -> DataFrame:
    """Versions from rows that are unique per key and sequence.

    Only the first and the last row of a version matter: the first gives the start, the last the
    shown values, and the first of the next version gives the end.
    """
    gaps = "_due" in df.columns
    # a carried open version starts before its last observation; any other row starts at its own
    start = F.col("_start") if "_start" in df.columns else F.col(sequence)
    seen = {"t": F.struct(*[F.col(c) for c in compared]) if compared else F.lit(True)}
    if gaps:
        seen |= {"seq": F.col(sequence), "due": F.col("_due")}
    df = with_neighbours(df, keys, sequence, F.struct(*[v.alias(k) for k, v in seen.items()]))
    opens = ~F.col("_prev.t").eqNullSafe(seen["t"])
    ends = ~F.col("_next.t").eqNullSafe(seen["t"])
    if gaps:
        opens = opens | ~F.col("_prev.due").eqNullSafe(F.col(sequence))
        ends = ends | ~F.col("_next.seq").eqNullSafe(F.col("_due"))
    edges = (
        df.withColumns({"_opens": opens, "_ends": ends})
        .filter("_opens OR _ends")
        .drop("_prev", "_next")
    )
    shown = F.struct(*[F.col(c) for c in [*values, *(["_due"] if gaps else [])]])
    edges = with_next_two(edges, keys, sequence, F.struct(start.alias("start"), shown.alias("shown")))
    last = F.when(F.col("_ends"), shown).otherwise(F.col("_n1.shown"))
    following = F.when(F.col("_ends"), F.col("_n1.start")).otherwise(F.col("_n2.start"))
    firsts = edges.filter("_opens").select(
        *keys, last.alias("_last"), start.alias(START_AT), following.alias("_following")
    )
    return firsts.select(
        *keys,
        *[F.col(f"_last.{c}").alias(c) for c in values],
        START_AT,
        (F.col("_last._due") if gaps else F.col("_following")).alias(END_AT),
    )


def scd2_merge(
    target: DataFrame,
    new_events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    history: DataFrame,
    tracked: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    untracked: str = "update",
    close_missing: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """History after ``new_events``; equal to :func:`scd2_build` over everything seen so far.

    :func:`unseen_events` followed by :func:`merge_unseen`, which see.
    """
    news = unseen_events(target, new_events, keys, sequence, tracked, drop, untracked, rows_per_task)
    return merge_unseen(target, news, keys, sequence, history, tracked, drop, tiebreak, untracked, close_missing, rows_per_task)


def unseen_events(
    target: DataFrame,
    new_events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    untracked: str = "update",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The keyed rows of ``new_events`` that ``target`` does not account for, stored in the shared folder.

    Keys with many rows, new ones and stored versions together, are cut into segments like in the build.
    """
    keys = list(keys)
    fresh = _keyed(new_events, keys, sequence)
    values, compared = _roles(fresh, keys, sequence, tracked, drop, untracked)
    places = fresh.select(*keys, F.col(sequence).alias("_at")).unionAll(target.select(*keys, F.col(START_AT).alias("_at")))
    hot = find_hot_keys(places, keys, "_at", rows_per_task)
    return cut_lineage(_unknown(fresh, target, hot, keys, sequence, values, compared))


def merge_unseen(
    target: DataFrame,
    news: DataFrame,
    keys: Sequence[str],
    sequence: str,
    history: DataFrame,
    tracked: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    untracked: str = "update",
    close_missing: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``target`` with the rows that :func:`unseen_events` has found.

    Every step is as large as the news and not as the snapshot they came in.  Keys without news pass through.  Where every new sequence
    lies after the key's last observation, the open version and the news are enough.  Other keys
    had a late or corrected observation; collapsed versions cannot absorb it, so those keys, and
    only those, are rebuilt from ``history``: the retained snapshots, the new ones included.
    ``history`` is not read at all when nothing came late.  With ``close_missing`` a snapshot also says what is
    no longer there, so each scope with news is rebuilt from ``history`` as a whole.
    """
    keys = list(keys)
    if close_missing is not None:
        scope = list(close_missing)
        scopes = news.select(*scope).distinct()
        again = cut_lineage(_keyed(history, keys, sequence).join(scopes, scope, "left_semi"))
        rebuilt = scd2_build(again, keys, sequence, tracked, drop, tiebreak, untracked, close_missing, rows_per_task)
        return target.join(scopes, scope, "left_anti").unionByName(rebuilt, allowMissingColumns=True)
    hot = find_hot_keys(news, keys, sequence, rows_per_task)
    first_new = news.groupBy(*keys).agg(F.min(sequence).alias("_first_new"))
    last_seen = target.join(first_new.select(*keys), keys, "left_semi").groupBy(*keys).agg(
        F.max(F.greatest(F.col(sequence), F.coalesce(F.col(END_AT), F.col(sequence)))).alias("_last_seen")
    )
    marks = cut_lineage(first_new.join(last_seen, keys, "left").select(
        *keys, F.coalesce(F.col("_first_new") <= F.col("_last_seen"), F.lit(False)).alias("_late")
    ))
    build = partial(
        _build, keys=keys, sequence=sequence, tracked=tracked, drop=drop, tiebreak=tiebreak, untracked=untracked
    )
    marked = target.join(marks, keys, "left")
    untouched = marked.filter(F.col("_late").isNull() | (~F.col("_late") & F.col(END_AT).isNotNull()))
    open_rows = marked.filter(~F.col("_late") & F.col(END_AT).isNull())
    in_order = news.join(marks.filter(~F.col("_late")), keys).withColumn("_start", F.col(sequence))
    carried = open_rows.withColumn("_start", F.col(START_AT)).drop(START_AT, END_AT)
    feed = in_order.unionByName(carried, allowMissingColumns=True).drop("_late")
    grown = build(feed, hot)
    merged = untouched.drop("_late").unionByName(grown)
    if marks.filter("_late").isEmpty():
        return merged
    late = _keyed(history, keys, sequence).join(marks.filter("_late"), keys, "left_semi")
    rebuilt = build(late, find_hot_keys(late, keys, sequence, rows_per_task))
    return merged.unionByName(rebuilt)


@dataclass(frozen=True)
class VersionDelta:
    """What a merge adds to a stored history.

    ``opened``: the open version of each touched key, with ``_live`` (false: it has none any more); ``closed``: closed
    versions to add; ``resets``: keys whose earlier closed versions are void; ``changes``: open versions before and
    after; ``scopes``: the last snapshot of each scope (with ``close_missing`` only).
    """

    opened: DataFrame
    closed: DataFrame
    resets: DataFrame | None
    changes: DataFrame
    scopes: DataFrame | None = None

    def parts(self) -> dict[str, DataFrame | None]:
        """By the kinds of a version table."""
        return {"open": self.opened, "closed": self.closed, "resets": self.resets, "changes": self.changes, "scopes": self.scopes}


#: From a frame of keys to rows of these keys: their closed versions (None: there are none), or all their observations.
Lookup = Callable[[DataFrame], DataFrame | None]


def _delta(
    out: DataFrame, open_rows: DataFrame | None, touched: DataFrame, keys: list[str], resets: DataFrame | None,
    scopes: DataFrame | None = None,
) -> VersionDelta:
    """The delta of the touched keys, whose versions (but for closed ones of earlier runs) are ``out``."""
    out = cut_lineage(out)
    shown = [c for c in out.columns if c not in keys and c != END_AT]
    after = out.filter(F.col(END_AT).isNull()).select(*keys, F.struct(*shown).alias("_after"))
    if open_rows is None:
        pairs = after.withColumn("_before", F.lit(None).cast(after.schema["_after"].dataType))
    else:
        # a column that the stored rows lack is NULL there
        image = F.struct(*[(F.col(c) if c in open_rows.columns else F.lit(None).cast(out.schema[c].dataType)).alias(c) for c in shown])
        before = open_rows.join(touched, keys, "left_semi").select(*keys, image.alias("_before"))
        pairs = before.join(after, keys, "full")
    pairs = cut_lineage(pairs.select(*keys, "_before", "_after").filter(~F.col("_before").eqNullSafe(F.col("_after"))))
    live = F.col("_after").isNotNull()
    # a key without an open version shows its last one, which nobody reads
    row = F.coalesce("_after", "_before")
    opened = pairs.withColumn("_row", row).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in shown], live.alias("_live"))
    return VersionDelta(opened, out.filter(F.col(END_AT).isNotNull()), resets, pairs, scopes)


def delta_of_build(history: DataFrame, keys: Sequence[str], scopes: DataFrame | None = None) -> VersionDelta:
    """A whole history as the first delta of a stored one."""
    return _delta(history, None, history.select(*keys), list(keys), None, scopes)


def merge_delta(
    open_rows: DataFrame,
    new_events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    closed_of: Lookup,
    history_of: Lookup,
    tracked: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    untracked: str = "update",
    rows_per_task: int = ROWS_PER_TASK,
) -> VersionDelta:
    """What ``new_events`` change in a history of which only the open versions are at hand.

    An observation at or behind the start of its key's open version needs no other row to be judged. Only for keys
    with an earlier one ``closed_of`` is asked, as it may repeat a closed version; and only keys for which it is news
    (or for which it corrects something before their last observation) are rebuilt from ``history_of``: all their
    observations, the new ones included. The delta is as large as the news and the rebuilt keys.
    """
    keys = list(keys)
    unseen = partial(
        unseen_events, keys=keys, sequence=sequence, tracked=tracked, drop=drop, untracked=untracked, rows_per_task=rows_per_task
    )
    news = unseen(open_rows, new_events)
    columns = news.columns
    starts = open_rows.select(*keys, F.col(START_AT).alias("_open_start"), F.col(sequence).alias("_last_seen"))
    placed = cut_lineage(news.join(starts, keys, "left"))
    is_early = F.coalesce(F.col(sequence) < F.col("_open_start"), F.lit(False))
    early = placed.filter(is_early)
    early_keys = early.select(*keys).distinct()
    if not early.isEmpty():
        early_keys = cut_lineage(early_keys)
        closed = closed_of(early_keys)
        own = open_rows.join(early_keys, keys, "left_semi")
        versions = own if closed is None else closed.unionByName(own, allowMissingColumns=True).select(*own.columns)
        news = cut_lineage(placed.filter(~is_early).select(*columns).unionByName(unseen(cut_lineage(versions), early.select(*columns))))
    first_new = news.groupBy(*keys).agg(F.min(sequence).alias("_first_new"))
    marks = cut_lineage(first_new.join(starts, keys, "left").select(
        *keys, F.coalesce(F.col("_first_new") <= F.col("_last_seen"), F.lit(False)).alias("_late")
    ))
    build = partial(_build, keys=keys, sequence=sequence, tracked=tracked, drop=drop, tiebreak=tiebreak, untracked=untracked)
    in_order = news.join(marks.filter(~F.col("_late")), keys).withColumn("_start", F.col(sequence))
    carried = open_rows.join(marks.filter(~F.col("_late")), keys).withColumn("_start", F.col(START_AT)).drop(START_AT, END_AT)
    out = build(in_order.unionByName(carried, allowMissingColumns=True).drop("_late"), find_hot_keys(news, keys, sequence, rows_per_task))
    late_keys = marks.filter("_late").select(*keys)
    if late_keys.isEmpty():
        return _delta(out, open_rows, marks, keys, None)
    again = cut_lineage(_keyed(history_of(late_keys), keys, sequence))
    rebuilt = build(again, find_hot_keys(again, keys, sequence, rows_per_task))
    return _delta(out.unionByName(rebuilt, allowMissingColumns=True), open_rows, marks, keys, late_keys)


def snapshot_delta(
    open_rows: DataFrame,
    last: DataFrame,
    new_events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    scope: Sequence[str],
    history_of: Lookup,
    tracked: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    untracked: str = "update",
    rows_per_task: int = ROWS_PER_TASK,
) -> VersionDelta:
    """What snapshots change in a history that closes the keys they miss.

    ``open_rows`` are the keys that were in the last snapshot of their scope, ``last`` (scope..., ``_last``) says which
    one that was. The new snapshots of a scope are compared with its open keys by one join; only keys that change,
    vanish or come (back) go on. A scope with a snapshot that is not behind its last one is rebuilt from
    ``history_of`` (asked with a frame of scopes), as that snapshot may close any of its keys.
    """
    keys, scope = list(keys), list(scope)
    fresh = _keyed(new_events, keys, sequence)
    columns = fresh.columns
    dates = cut_lineage(fresh.select(*scope, sequence).distinct())
    named = dates.groupBy(*scope).agg(F.min(sequence).alias("_first"), F.max(sequence).alias("_newest"), F.count("*").alias("_dates"))
    named = cut_lineage(named.join(last, scope, "left").withColumn("_late", F.coalesce(F.col("_first") <= F.col("_last"), F.lit(False))))
    ahead = named.filter(~F.col("_late"))
    scopes = named.select(*scope, F.greatest("_newest", "_last").alias("_last"))

    # what the one new snapshot of a scope repeats of the open versions needs no further look
    values, _ = _roles(fresh, keys, sequence, tracked, drop, untracked)
    compared = [c for c in values if c != sequence]
    fingerprint = F.xxhash64(*[F.col(c) for c in compared]) if compared else F.lit(0).cast("long")
    stored = open_rows
    for f in fresh.schema:
        if f.name in compared and f.name not in stored.columns:
            stored = stored.withColumn(f.name, F.lit(None).cast(f.dataType))
    live = stored.join(ahead.select(*scope, "_dates"), scope).withColumn("_shown", fingerprint)
    rows = fresh.join(ahead.select(*scope, "_dates"), scope).withColumn("_shown", fingerprint)
    seen = rows.groupBy(*keys).agg(F.min("_shown").alias("_low"), F.max("_shown").alias("_high"))
    goes_on = live.join(seen, keys).filter((F.col("_dates") == 1) & (F.col("_low") == F.col("_shown")) & (F.col("_high") == F.col("_shown")))
    goes_on = cut_lineage(goes_on.select(*keys))
    moved = rows.select(*columns).join(goes_on, keys, "left_anti").withColumn("_start", F.col(sequence))
    stayed = stored.join(ahead.select(*scope), scope, "left_semi").join(goes_on, keys, "left_anti")
    stayed = stayed.withColumn("_start", F.col(START_AT)).drop(START_AT, END_AT)
    feed = cut_lineage(moved.unionByName(stayed, allowMissingColumns=True))
    along = Window.partitionBy(*scope).orderBy(sequence)
    known = dates.unionByName(ahead.filter(F.col("_last").isNotNull()).select(*scope, F.col("_last").alias(sequence))).distinct()
    feed = feed.join(known.withColumn("_due", F.lead(sequence).over(along)), [*scope, sequence])
    build = partial(_build, keys=keys, sequence=sequence, tracked=tracked, drop=drop, tiebreak=tiebreak, untracked=untracked)
    touched = feed.select(*keys).distinct()
    out = build(feed, find_hot_keys(feed, keys, sequence, rows_per_task))
    late = named.filter("_late").select(*scope)
    if late.isEmpty():
        return _delta(out, stored, touched, keys, None, scopes)
    again = cut_lineage(_keyed(history_of(late), keys, sequence))
    rebuilt = scd2_build(again, keys, sequence, tracked, drop, tiebreak, untracked, scope, rows_per_task)
    resets = again.select(*keys).distinct()
    return _delta(out.unionByName(rebuilt, allowMissingColumns=True), stored, touched.union(resets), keys, resets, scopes)


def _unknown(
    fresh: DataFrame, target: DataFrame, hot: HotKeys | None, keys: list[str], sequence: str, values: list[str],
    compared: list[str],
) -> DataFrame:
    """The rows of ``fresh`` that the versions in ``target`` do not already account for.

    A row changes nothing if the version that covers its sequence tracks the same values and
    either was observed later too (only the last observation is shown) or shows the very same row.
    """
    def box(columns: list[str]) -> Column:
        return F.struct(*[F.col(c) for c in columns])

    versions = target.select(
        *keys,
        F.col(START_AT).alias("_at"),
        F.struct(F.col(sequence).alias("last"), box(values).alias("shown")).alias("_version"),
    )
    covered = _with_cover(fresh.withColumn("_at", F.col(sequence)), versions, hot, keys)
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"_cover.shown.{c}").eqNullSafe(F.col(c))
    inside = F.col(sequence) < F.col("_cover.last")
    repeated = box(values).eqNullSafe(F.col("_cover.shown"))
    known = F.col("_cover").isNotNull() & same & (inside | repeated)
    return covered.filter(~known).select(*fresh.columns)


def _with_cover(rows: DataFrame, versions: DataFrame, hot: HotKeys | None, keys: list[str]) -> DataFrame:
    """``rows`` with ``_cover``: the ``_version`` of their key that starts last before or at their ``_at``.

    Rows and versions meet in one ordered pass per key and never as pairs.  Hot keys are cut into segments, and the
    last version of a segment goes on into those behind it.
    """
    both = rows.withColumn("_is_row", F.lit(1)).unionByName(versions, allowMissingColumns=True)
    # versions have no _is_row and so come before a row of the same moment
    covered = _covered(both if hot is None else without_hot_keys(both, hot, keys), keys)
    if hot is not None:
        heavy = only_hot_keys(both, hot, keys, "_at")
        along = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        last = heavy.groupBy(*keys, SEGMENT).agg(
            F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_at"))).alias("_last")
        )
        before = last.select(*keys, SEGMENT, F.last("_last", ignorenulls=True).over(along).alias("_before"))
        inner = _covered(heavy, [*keys, SEGMENT]).join(before, [*keys, SEGMENT])
        inner = inner.withColumn("_cover", F.coalesce("_cover", "_before"))
        covered = covered.unionByName(inner.select(*covered.columns))
    return covered.filter(F.col("_is_row").isNotNull()).drop("_is_row", "_version")


def _covered(both: DataFrame, parts: list[str]) -> DataFrame:
    """Add ``_cover``: the version before or at each row of its part."""
    so_far = Window.partitionBy(*parts).orderBy("_at", "_is_row").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_cover", F.last("_version", ignorenulls=True).over(so_far))


def _column_named(df: DataFrame, name: str) -> Column:
    found = next((c for c in df.columns if c.lower() == name.lower()), None)
    if found is None:
        raise ValueError(f"history column {name} not found; columns are {df.columns}")
    return F.col(f"`{found}`")


def filter_current(df: DataFrame) -> DataFrame:
    """Open versions; the end column is found in any casing."""
    return df.filter(_column_named(df, END_AT).isNull())


def as_of(df: DataFrame, moment: Column) -> DataFrame:
    """Versions valid at ``moment``: started by then and not yet ended."""
    end = _column_named(df, END_AT)
    return df.filter((_column_named(df, START_AT) <= moment) & (end.isNull() | (end > moment)))


def as_of_join(
    probes: DataFrame,
    moment: str,
    versions: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Each probe with the ``columns`` of its key's version that was valid at the probe's own ``moment``.

    A version is valid from its start until before its end. Probes and versions are sorted together, key by key, so a
    key with many of both costs their sum and not their product; keys above ``rows_per_task`` are cut into segments of
    time. A probe without a valid version, or with a NULL key or moment, has NULLs (``how="left"``) or goes
    (``"inner"``). Versions of a key must not overlap; a column that probes have too keeps the probe's name and value,
    so rename it before.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    clash = sorted(set(columns) & set(probes.columns))
    if clash:
        raise ValueError(f"probes have columns {clash}, too")
    keys = list(keys)
    start, end = _column_named(versions, START_AT), _column_named(versions, END_AT)
    shown = F.struct(end.alias("_end"), F.struct(*columns).alias("shown"))
    at = versions.select(*keys, start.alias("_at"), shown.alias("_version"))
    rows = probes.withColumn("_at", F.col(moment).cast(at.schema["_at"].dataType))
    places = rows.select(*keys, "_at").unionAll(at.select(*keys, "_at"))
    for c in [*keys, "_at"]:
        places = places.filter(F.col(c).isNotNull())
    covered = _with_cover(rows, at, find_hot_keys(places, keys, "_at", rows_per_task), keys)
    keyed = F.col("_at").isNotNull()
    for c in keys:
        keyed = keyed & F.col(c).isNotNull()
    valid = keyed & F.col("_cover").isNotNull() & (F.col("_cover._end").isNull() | (F.col("_cover._end") > F.col("_at")))
    found = covered.withColumn("_shown", F.when(valid, F.col("_cover.shown")))
    if how == "inner":
        found = found.filter(F.col("_shown").isNotNull())
    return found.select(*probes.columns, *[F.col(f"_shown.{c}").alias(c) for c in columns])


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Change feed between two snapshots: ``insert``, ``delete``, ``update_pre``, ``update_post``.

    Both sides meet in one aggregate instead of a join: one shuffle, and copies of a key collapse
    before it (the greatest row stands for them) instead of pairing up.
    """
    keys, columns = list(keys), list(columns)
    values = F.struct(*columns)
    nothing = F.lit(None)
    both = (
        old.select(*keys, values.alias("_old"), nothing.alias("_new"))
        .unionAll(new.select(*keys, nothing.alias("_old"), values.alias("_new")))
        .groupBy(*keys)
        .agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    )
    before, after = F.col("_old"), F.col("_new")

    def change(kind: str, side: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), side.alias("_values"))

    changes = (
        F.when(before.isNull(), F.array(change("insert", after)))
        .when(after.isNull(), F.array(change("delete", before)))
        .otherwise(F.array(change("update_pre", before), change("update_post", after)))
    )
    return (
        both.filter(~before.eqNullSafe(after))
        .select(*keys, F.explode(changes).alias("_c"))
        .select(*keys, "_c._values.*", "_c._change_type")
    )
