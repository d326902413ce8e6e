"""One run over a source: gate, plan, hold or apply, fold the state. All of it are DataFrames between versioned tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .control import RunControl
from .operators import changes, states
from .sinks import Conflict, VersionedTable, upsert

DEST = "source string, item_id bigint, title string, body_hash string"
STATE = "source string, item_id bigint, fingerprint string, published_at timestamp, first_seen_at timestamp, last_detail_at timestamp"
CANDIDATES = "source string, item_id bigint, body_hash string, run_id string, logical_id string, seen_at timestamp"
RUNS = "run_id string, logical_id string, at timestamp, status string"


@dataclass
class Workspace:
    """The four tables that runs hand to each other."""

    spark: SparkSession
    path: str

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}/{name}")

    def read(self, name: str, ddl: str) -> tuple[DataFrame, str | None]:
        t = self.table(name)
        version = t.version()
        return (t.read(version) if version else self.spark.createDataFrame([], ddl)), version


def run(space: Workspace, items: DataFrame, run_id: str, logical_id: str, now: str, control: RunControl, dry_run: bool = False, quarantined: list[str] | None = None) -> DataFrame:
    """items(source, item_id, title, body_hash), gated already. Returns the plan as it was carried out, or in a dry run as
    it would be. A body that differs is held in the first run that sees it and replaced by the next that sees the same."""
    control.check()
    dest, at_dest = space.read("dest", DEST)
    state, at_state = space.read("state", STATE)
    held, at_held = space.read("candidates", CANDIDATES)
    log, at_log = space.read("runs", RUNS)
    last = log.where("status = 'success'").orderBy(F.desc("at"), F.desc("run_id")).limit(1).collect()
    latest, latest_logical = (last[0].run_id, last[0].logical_id) if last else ("", "")
    time = F.lit(now).cast("timestamp")
    ok = changes.consecutive(F.col("run_id"), F.lit(latest), F.col("logical_id"), F.lit(latest_logical), F.lit(logical_id), F.col("seen_at"), time)
    plan = changes.mutation_plan(items, dest, held.where(ok), quarantined or [])
    done = space.table("plans")
    at_plan = done.version()
    if dry_run:
        return plan
    control.check(writes=True)
    # the record comes first, as pending, and last, as done: a run that dies between leaves word of it
    record = lambda status: space.spark.sql("SELECT :r AS run_id, :l AS logical_id, CAST(:t AS TIMESTAMP) AS at, :s AS status", args={"r": run_id, "l": logical_id, "t": now, "s": status})
    before = log.where(F.col("run_id") != run_id)
    at_log = space.table("runs").write(before.unionByName(record("pending")), at_log)
    plan = done.read(done.write(plan.withColumn("run_id", F.lit(run_id)), at_plan)).drop("run_id")
    writes = plan.where("kind IN ('create', 'update_properties', 'replace_body')")
    new = items.join(writes.select("source", "item_id").distinct(), ["source", "item_id"], "left_semi")
    if space.table("dest").version() != at_dest:
        raise Conflict("the destination has changed since the plan was made")
    space.table("dest").write(upsert(dest, new.select("source", "item_id", "title", "body_hash"), ["source", "item_id"]), at_dest)
    waiting = items.join(plan.where("reason = 'unconfirmed_change'").select("source", "item_id"), ["source", "item_id"], "left_semi")
    space.table("candidates").write(waiting.select("source", "item_id", "body_hash", F.lit(run_id).alias("run_id"), F.lit(logical_id).alias("logical_id"), time.alias("seen_at")), at_held)
    seen = items.select("source", "item_id", F.col("body_hash").alias("fingerprint"), F.lit(None).cast("timestamp").alias("published_at"), time.alias("first_seen_at"), time.alias("last_detail_at"))
    space.table("state").write(states.fold_observations(state, seen, ["source", "item_id"]), at_state)
    space.table("runs").write(states.last_runs(before.unionByName(record("success")), "run_id", "at"), at_log)
    return plan
