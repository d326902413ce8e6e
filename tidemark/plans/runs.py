"""Three runs, one after the other, over tables that they hand to each other: held, confirmed and applied changes. Roles: documents are
items; before the second run some bodies and titles change, and before the third some of those bodies change again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..control import RunControl
from ..operators.lineage import cut, shared_folder
from ..runs import DEST, RUNS, STATE, Workspace, run
from .changes import ITEMS_SQL, items
from .registry import query

#: A body that has changed is replaced when the run before has seen the same one; a title at once, unless its item is held.
RUN_SQL = f"""
{ITEMS_SQL}, x AS (SELECT *, item_id % 7 = 0 AS body, item_id % 7 = 0 AND item_id % 3 = 0 AS again, item_id % 11 = 0 AS titled, item_id % 5 = 0 AS late FROM items)
"""


def _runs(spark: SparkSession, sf_dir: str) -> Workspace:
    space = Workspace(spark, f"{shared_folder(spark)}/tidemark-runs-{uuid.uuid4().hex[:12]}")
    first = cut(items(spark, sf_dir))  # the texts are read once, not by every run for every table
    k = F.col("item_id")
    title = F.when(k % 11 == 0, F.concat("title", F.lit(" (new)"))).otherwise(F.col("title"))
    second = first.select("source", "item_id", title.alias("title"), F.when(k % 7 == 0, F.sha2("body_hash", 256)).otherwise(F.col("body_hash")).alias("body_hash"))
    third = second.withColumn("body_hash", F.when((k % 7 == 0) & (k % 3 == 0), F.sha2("body_hash", 256)).otherwise(F.col("body_hash")))
    for n, seen in enumerate((first.where("item_id % 5 <> 0"), second, third)):
        run(space, seen, f"run-{n}", f"{n}", f"2024-01-01 0{n}:00:00", RunControl())
    run(space, third.limit(0), "run-3", "3", "2024-01-01 03:00:00", RunControl(), dry_run=True)
    return space


@query(f"""
WITH {RUN_SQL}
SELECT source, item_id, CASE WHEN titled AND (late OR NOT again) THEN title || ' (new)' ELSE title END AS title, CASE WHEN late AND body THEN sha256(body_hash) WHEN body AND NOT again THEN sha256(body_hash) ELSE body_hash END AS body_hash FROM x
""")
def three_runs_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-02, CDC-03, CTL-07, CDC-13: what the destination holds after three runs."""
    return _runs(spark, sf_dir).read("dest", DEST)[0]


@query(f"""
WITH {RUN_SQL}
SELECT 'runs' AS of, run_id AS id, status AS what, CAST(1 AS BIGINT) AS n FROM (VALUES ('run-0', 'success'), ('run-1', 'success'), ('run-2', 'success')) t(run_id, status), (SELECT 1 FROM x LIMIT 1)
UNION ALL SELECT 'plan', kind, reason, count(*) FROM (
  SELECT CASE WHEN again THEN 'conflict' WHEN body AND NOT late THEN 'replace_body' WHEN NOT body OR late THEN 'noop' END AS kind, CASE WHEN again THEN 'unconfirmed_change' WHEN body AND NOT late THEN 'body_hash' ELSE 'equal' END AS reason FROM x WHERE NOT (titled AND body AND NOT again AND NOT late)
  UNION ALL SELECT unnest(['update_properties', 'replace_body']), unnest(['title', 'body_hash']) FROM x WHERE titled AND body AND NOT again AND NOT late) GROUP BY 1, 2, 3
UNION ALL SELECT 'state', source, 'fingerprint', count(*) FROM x GROUP BY 2
""")
def three_runs_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-08, STA-09, STA-11: what the runs leave behind: their records, the last plan by kind, the state by source."""
    space = _runs(spark, sf_dir)
    one = lambda df, of, id_, what: df.groupBy(F.lit(of).alias("of"), F.col(id_).alias("id"), what.alias("what")).agg(F.count(F.lit(1)).alias("n"))
    runs = one(space.read("runs", RUNS)[0], "runs", "run_id", F.col("status"))
    plan = one(space.table("plans").read(), "plan", "kind", F.col("reason"))
    return runs.unionByName(plan).unionByName(one(space.read("state", STATE)[0], "state", "source", F.lit("fingerprint")))
