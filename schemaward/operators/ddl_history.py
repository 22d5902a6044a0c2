"""DDL snapshots merged into state with one step of history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemaward import schemas as S
from schemaward.functions.hashing import ddl_hash
from schemaward.plans import skew

KEY = S.OBJECT_KEY


def merge_ddl(state: DataFrame, snapshot: DataFrame, as_of: str) -> DataFrame:
    """M5: one run's snapshot merged into the DDL state.

    ``snapshot``: key, db_name, schema_name, object_name, obj_exists, ddl, notes;
    one row per key. A reappearing object counts as changed from a null hash, so
    its previous text is lost, as the state machine prescribes.
    A run checks most objects, so both sides meet in one full outer join; keys are
    unique on both, which bounds every join group by one pair.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    named = ["db_name", "schema_name", "object_name", "notes"]
    new = snapshot.select(
        *KEY, *[F.col(c).alias(f"n_{c}") for c in named], F.col("obj_exists").alias("n_exists"),
        F.nullif("ddl", F.lit("")).alias("n_ddl"), ddl_hash(F.col("ddl")).alias("n_hash"), F.lit(True).alias("_checked"))
    old = state.withColumn("_known", F.lit(True))
    checked, fresh = F.col("_checked").isNotNull(), F.col("_known").isNull()
    has_ddl = F.col("n_hash").isNotNull()
    changed = ~fresh & has_ddl & ~F.col("n_hash").eqNullSafe(F.col("current_ddl_hash"))
    appeared = ~F.col("obj_exists") & F.col("n_exists")

    def pick(value: Column, kept: str) -> Column:
        return F.when(checked, value).otherwise(F.col(kept)).alias(kept)

    return old.join(new, KEY, "full_outer").select(
        *KEY,
        *[pick(F.col(f"n_{c}"), c) for c in named],
        pick(F.col("n_exists"), "obj_exists"),
        pick(F.col("n_hash"), "current_ddl_hash"),
        pick(F.col("n_ddl"), "current_ddl"),
        pick(F.when(has_ddl, now).otherwise(F.col("last_extracted_on")), "last_extracted_on"),
        pick(F.when(changed, F.col("current_ddl_hash")).otherwise(F.col("previous_ddl_hash")), "previous_ddl_hash"),
        pick(F.when(changed, F.col("current_ddl")).otherwise(F.col("previous_ddl")), "previous_ddl"),
        pick(F.when(fresh | changed | appeared, now).otherwise(F.col("ddl_changed_on")), "ddl_changed_on"),
        pick(now, "last_checked_on"),
    ).select(*S.DDL_STATE.names)


def _order(tie: str | None) -> list[str]:
    return ["checked_on", tie] if tie else ["checked_on"]


def _steps(snapshots: DataFrame, order: list[str], hot_rows: int) -> DataFrame:
    """Snapshots cut into time blocks, each row with the row before it inside its block."""
    rows = snapshots.select(*KEY, *order, "obj_exists", F.nullif("ddl", F.lit("")).alias("ddl"), ddl_hash(F.col("ddl")).alias("hash"))
    rows = skew.time_blocks(rows, KEY, "checked_on", hot_rows)
    inside = Window.partitionBy(*KEY, skew.BLOCK).orderBy(*order)
    return rows.withColumn("before", F.lag(F.struct("hash", "ddl", "obj_exists")).over(inside))


def _replaced(row_hash: Column, before: Column) -> Column:
    """A new text took the place of the one before."""
    return before.isNotNull() & row_hash.isNotNull() & ~row_hash.eqNullSafe(before["hash"])


def _appeared(row_exists: Column, before: Column) -> Column:
    return F.coalesce(~before["obj_exists"] & row_exists, F.lit(False))


def _was(before: Column) -> Column:
    return F.struct(before["hash"].alias("hash"), before["ddl"].alias("ddl"))


def _blocks(steps: DataFrame, order: list[str]) -> DataFrame:
    """One row per object and block: its first and last row and its inner changes."""
    before, at = F.col("before"), F.struct(*order)
    inner = _replaced(F.col("hash"), before)
    moved = before.isNotNull() & (inner | _appeared(F.col("obj_exists"), before))
    return steps.groupBy(*KEY, skew.BLOCK).agg(
        F.min_by(F.struct("hash", "obj_exists", *order), at).alias("first"),
        F.max_by(F.struct("hash", "ddl", "obj_exists", *order), at).alias("last"),
        F.max_by(_was(before), F.when(inner, at)).alias("was"),
        F.max(F.when(moved, F.col("checked_on"))).alias("changed_on"),
        F.max(F.when(F.col("hash").isNotNull(), F.col("checked_on"))).alias("extracted_on"),
    )


def _block_states(steps: DataFrame, order: list[str]) -> DataFrame:
    """One row per object and block: what came before it and the merge state at its end.

    A block is summarised by its first and last row and its inner changes. Whether
    the first row is a change shows next to the last row of the block before.
    """
    blocks = _blocks(steps, order)
    w = Window.partitionBy(*KEY).orderBy(skew.BLOCK)
    earlier, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    old = F.col("old")
    first_changed = _replaced(F.col("first.hash"), old)
    first_moved = old.isNull() | first_changed | _appeared(F.col("first.obj_exists"), old)
    marked = blocks.withColumn("old", F.lag("last").over(w)).select(
        *KEY, skew.BLOCK, "old", "last",
        F.coalesce("was", F.when(first_changed, _was(old))).alias("was"),
        F.coalesce("changed_on", F.when(first_moved, F.col("first.checked_on"))).alias("changed_on"), "extracted_on")
    marks = ["was", "changed_on", "extracted_on"]
    return marked.select(
        *KEY, skew.BLOCK, "old", "last",
        *[F.last(m, ignorenulls=True).over(upto).alias(m) for m in marks],
        *[F.last(m, ignorenulls=True).over(earlier).alias(f"earlier_{m}") for m in marks])


def ddl_history(snapshots: DataFrame, hot_rows: int = skew.HOT_ROWS, tie: str | None = None) -> DataFrame:
    """The merge state after every snapshot of every object.

    ``snapshots``: key, checked_on, obj_exists, ddl (and a tie-breaking column
    where two snapshots of one object may share a time). Adds current, previous,
    changed-on and extracted-on columns, plus is_change. Hot objects are cut into
    time blocks, see ``schemaward.plans.skew``; block states are made for them only.
    """
    order = _order(tie)
    steps = _steps(snapshots, order, hot_rows)
    carried = _block_states(steps.where(skew.HOT), order).drop("last", "was", "changed_on", "extracted_on")
    rows = steps.join(carried, [*KEY, skew.BLOCK], "left")
    earlier = F.when(F.col("old").isNotNull(), F.struct("old.hash", "old.ddl", "old.obj_exists"))
    rows = rows.withColumn("p", F.coalesce("before", earlier))
    p = F.col("p")
    changed = _replaced(F.col("hash"), p)
    rows = rows.withColumn("is_change", p.isNull() | changed | _appeared(F.col("obj_exists"), p))
    upto = Window.partitionBy(*KEY, skew.BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    def latest(mark: Column, carried_mark: str) -> Column:
        return F.coalesce(F.last(mark, ignorenulls=True).over(upto), F.col(carried_mark))

    was = latest(F.when(changed, _was(p)), "earlier_was")
    return rows.select(
        *KEY, *order, "obj_exists", "is_change", F.col("hash").alias("current_ddl_hash"), F.col("ddl").alias("current_ddl"),
        latest(F.when(F.col("hash").isNotNull(), F.col("checked_on")), "earlier_extracted_on").alias("last_extracted_on"),
        was["hash"].alias("previous_ddl_hash"), was["ddl"].alias("previous_ddl"),
        latest(F.when(F.col("is_change"), F.col("checked_on")), "earlier_changed_on").alias("ddl_changed_on"))


def fold_ddl(snapshots: DataFrame, hot_rows: int = skew.HOT_ROWS, tie: str | None = None) -> DataFrame:
    """M6: DDL state after all snapshots at once; equals ``merge_ddl`` run by run.

    Only block states travel on after the one window over the snapshots, so hot
    objects need no second pass and nothing is joined back.
    """
    order = _order(tie)
    states = _block_states(_steps(snapshots, order, hot_rows), order)
    final = states.groupBy(*KEY).agg(F.max_by(F.struct("last", "was", "changed_on", "extracted_on"), skew.BLOCK).alias("s"))
    part = F.split("fqdn", r"\.")
    return final.select(
        *KEY, *[F.get(part, F.lit(i)).alias(n) for i, n in enumerate(("db_name", "schema_name", "object_name"))],
        F.col("s.last.obj_exists").alias("obj_exists"), F.col("s.last.hash").alias("current_ddl_hash"),
        F.col("s.last.ddl").alias("current_ddl"), F.col("s.extracted_on").alias("last_extracted_on"),
        F.col("s.was.hash").alias("previous_ddl_hash"), F.col("s.was.ddl").alias("previous_ddl"),
        F.col("s.changed_on").alias("ddl_changed_on"), F.col("s.last.checked_on").alias("last_checked_on"),
        F.lit("").alias("notes"))


# --- history that grows run by run ---------------------------------------------

_SUMMARY = ["first", "last", "was", "changed_on", "extracted_on"]


def history_summary(snapshots: DataFrame, hot_rows: int = skew.HOT_ROWS, tie: str | None = None) -> DataFrame:
    """One row per object that stands for all its snapshots: key, first, last, was, changed_on, extracted_on.

    ``first`` and ``last`` hold the rows at both ends; ``was`` (text and fingerprint last replaced), ``changed_on`` and
    ``extracted_on`` tell of changes after the first row. Summaries of successive snapshots of an object can be joined
    (``advance_history``), so this table is all that has to be kept. Other columns of ``snapshots`` are not looked at.
    """
    order = _order(tie)
    w = Window.partitionBy(*KEY).orderBy(skew.BLOCK)
    blocks = _blocks(_steps(snapshots, order, hot_rows), order).withColumn("old", F.lag("last").over(w))
    old, block = F.col("old"), F.col(skew.BLOCK)
    was, changed_on = _crossed(old, F.col("first"), F.col("was"), F.col("changed_on"))
    joined = blocks.select(*KEY, block, "first", "last", was.alias("was"), changed_on.alias("changed_on"), "extracted_on")

    def latest(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), block)).alias(c)

    return joined.groupBy(*KEY).agg(F.min_by("first", block).alias("first"), F.max_by("last", block).alias("last"),
                                    latest("was"), latest("changed_on"), latest("extracted_on"))


def _crossed(old: Column, first: Column, was: Column, changed_on: Column) -> tuple[Column, Column]:
    """Inner changes of a stretch of snapshots, with the change from the row before it, ``old``, where that is the last one."""
    replaced = F.coalesce(_replaced(first["hash"], old), F.lit(False))
    moved = old.isNotNull() & (replaced | _appeared(first["obj_exists"], old))
    return F.coalesce(was, F.when(replaced, _was(old))), F.coalesce(changed_on, F.when(moved, first["checked_on"]))


def advance_history(summary: DataFrame, snapshots: DataFrame, hot_rows: int = skew.HOT_ROWS, tie: str | None = None) -> DataFrame:
    """M5, M6 in increments: the summary after further snapshots, equal to that of all snapshots at once.

    Reads the new snapshots and one stored row per object; earlier snapshots are not needed. Both sides have one row
    per object, so the join holds one pair per key. The new snapshots of an object must be later than its stored ones;
    ``late_snapshots`` names those that are not, and their objects are to be summarised from all their snapshots.
    """
    new = history_summary(snapshots, hot_rows, tie).select(*KEY, F.struct(*_SUMMARY).alias("new"))
    rows = summary.select(*KEY, F.struct(*_SUMMARY).alias("kept")).join(new, KEY, "full_outer")
    kept, new = F.col("kept"), F.col("new")
    was, changed_on = _crossed(kept["last"], new["first"], new["was"], new["changed_on"])
    return rows.select(
        *KEY, F.coalesce(kept["first"], new["first"]).alias("first"), F.coalesce(new["last"], kept["last"]).alias("last"),
        F.coalesce(was, kept["was"]).alias("was"), F.coalesce(changed_on, kept["changed_on"]).alias("changed_on"),
        F.coalesce(new["extracted_on"], kept["extracted_on"]).alias("extracted_on"))


def late_snapshots(summary: DataFrame, snapshots: DataFrame, tie: str | None = None) -> DataFrame:
    """Snapshots that are not later than what the summary already holds of their object."""
    order = _order(tie)
    ends = summary.select(*KEY, F.struct(*[F.col(f"last.{c}") for c in order]).alias("_end"))
    return snapshots.join(ends, KEY).where(F.struct(*order) <= F.col("_end")).select(*snapshots.columns)


def state_of_summary(summary: DataFrame) -> DataFrame:
    """The DDL state that a summary stands for; equals ``fold_ddl`` over its snapshots."""
    part = F.split("fqdn", r"\.")
    return summary.select(
        *KEY, *[F.get(part, F.lit(i)).alias(n) for i, n in enumerate(("db_name", "schema_name", "object_name"))],
        F.col("last.obj_exists").alias("obj_exists"), F.col("last.hash").alias("current_ddl_hash"),
        F.col("last.ddl").alias("current_ddl"), F.col("extracted_on").alias("last_extracted_on"),
        F.col("was.hash").alias("previous_ddl_hash"), F.col("was.ddl").alias("previous_ddl"),
        F.coalesce("changed_on", "first.checked_on").alias("ddl_changed_on"), F.col("last.checked_on").alias("last_checked_on"),
        F.lit("").alias("notes"))


def internal_changes(ddl_state: DataFrame) -> DataFrame:
    """objects whose current and previous fingerprints are both known and differ."""
    return ddl_state.where("current_ddl_hash <> '' and previous_ddl_hash <> '' and current_ddl_hash <> previous_ddl_hash")
