"""Problem 2: what changed between consecutive full snapshots of exported items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.snapshots import snapshot_changes
from ledgerloom.storage import table

_META = (
    "source_id, source_item_id, title, normalized_license, rights_classification, is_synthetic, split_group_id, "
    "content_class, period_class, language_class, quality_score, quality_tier, privacy_decision"
)

_SQL = f"""
WITH versions AS (
  SELECT release_version AS version, row_number() OVER (ORDER BY min(exported_at), release_version) AS rnk
  FROM exported_items GROUP BY release_version),
ranked AS (
  SELECT e.*, v.rnk, row_number() OVER (PARTITION BY release_version, item_id ORDER BY ingested_at DESC NULLS LAST) AS pick
  FROM exported_items e JOIN versions v ON e.release_version = v.version),
kept AS (SELECT rnk, item_id, split, exported_assets, row({_META}) AS meta FROM ranked WHERE pick = 1),
pairs AS (SELECT a.rnk AS old_rnk, b.rnk AS new_rnk, a.version AS previous_version, b.version AS version
          FROM versions a JOIN versions b ON b.rnk = a.rnk + 1)
SELECT previous_version, version, item_id, 'added' AS change_type FROM kept k JOIN pairs p ON k.rnk = p.new_rnk
  WHERE NOT EXISTS (SELECT 1 FROM kept o WHERE o.rnk = p.old_rnk AND o.item_id = k.item_id)
UNION ALL
SELECT previous_version, version, item_id, 'removed' FROM kept k JOIN pairs p ON k.rnk = p.old_rnk
  WHERE NOT EXISTS (SELECT 1 FROM kept o WHERE o.rnk = p.new_rnk AND o.item_id = k.item_id)
UNION ALL
SELECT previous_version, version, item_id, change_type FROM (
  SELECT previous_version, version, n.item_id, unnest([
    CASE WHEN o.split IS DISTINCT FROM n.split THEN 'split' END,
    CASE WHEN o.exported_assets IS DISTINCT FROM n.exported_assets THEN 'assets' END,
    CASE WHEN o.meta IS DISTINCT FROM n.meta THEN 'metadata' END]) AS change_type
  FROM pairs p JOIN kept o ON o.rnk = p.old_rnk JOIN kept n ON n.rnk = p.new_rnk AND n.item_id = o.item_id)
WHERE change_type IS NOT NULL
"""


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = snapshot_changes(
        table(spark, sf_dir, "exported_items"),
        key="item_id",
        snapshot="release_version",
        taken_at="exported_at",
        arrived_at="ingested_at",
        groups={"split": ["split"], "assets": ["exported_assets"]},
    )
    return changes.toDF("previous_version", "version", "item_id", "change_type")


QUERIES = {"p2_found": p2_found}
ORACLES = {"p2_found": _SQL}
