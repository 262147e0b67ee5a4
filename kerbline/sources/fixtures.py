"""Input tables of the street network, derived from the star-schema tables.

The star schema holds no geometry, so a street lattice (about 120 m blocks near
lon -122.5, lat 37.7) is derived from it by plain SQL.  The same text runs in
Spark SQL and in the checking engine, which keeps both sides on equal inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "orders", "events", "part")

VIEW_SQL: dict[str, str] = {
    "fx_nodes": """
SELECT CAST(c_custkey AS BIGINT) AS node_id,
  CAST(-122.5e0 + 0.00137e0 * (c_custkey % 40) + 0.00001e0 * (c_custkey % 7) AS DOUBLE) AS lon,
  CAST(37.70e0 + 0.00108e0 * floor(c_custkey / 40.0) + 0.00001e0 * (c_custkey % 5) AS DOUBLE) AS lat
FROM customer
""",
    "fx_edges": """
SELECT edge_id, u, v,
  CASE WHEN edge_id % 11 = 0 THEN NULL
       WHEN abs(u - v) = 1 THEN concat('Row ', CAST(CAST(floor(u / 40.0) AS BIGINT) AS VARCHAR(20)))
       ELSE concat('Col ', CAST(u % 40 AS VARCHAR(20))) END AS name,
  CASE WHEN edge_id % 10 = 0 THEN 'primary' WHEN edge_id % 10 < 3 THEN 'secondary'
       WHEN edge_id % 10 < 9 THEN 'residential' ELSE 'service' END AS highway,
  CASE WHEN edge_id % 13 = 0 THEN 'yes' WHEN edge_id % 17 = 0 THEN '-1' ELSE 'no' END AS oneway,
  CASE WHEN edge_id % 5 = 0 THEN NULL WHEN edge_id % 5 = 1 THEN '25 mph'
       WHEN edge_id % 5 = 2 THEN '40 kph' WHEN edge_id % 5 = 3 THEN 'signals' ELSE '35' END AS maxspeed,
  CASE WHEN edge_id % 4 = 0 THEN NULL ELSE CAST(edge_id % 4 AS VARCHAR(20)) END AS lanes,
  CASE WHEN edge_id % 6 = 0 THEN '3.5' END AS lane_width,
  CASE WHEN edge_id % 7 = 0 THEN 'left' WHEN edge_id % 7 = 1 THEN 'no' END AS sidewalk,
  CASE WHEN edge_id % 9 < 3 THEN 'yes' END AS sidewalk_both,
  CASE WHEN edge_id % 12 = 0 THEN 'separate' WHEN edge_id % 12 = 1 THEN 'none' END AS sidewalk_left_tag,
  CASE WHEN edge_id % 8 = 0 THEN 'lane' WHEN edge_id % 8 = 1 THEN 'no' END AS cycleway,
  CASE WHEN edge_id % 8 = 0 THEN '1.8 m' END AS cycleway_width,
  CASE WHEN edge_id % 14 = 0 THEN '5%' WHEN edge_id % 14 = 1 THEN 'up' WHEN edge_id % 14 = 2 THEN '-3.2' END AS incline
FROM (
  SELECT min(o_orderkey) AS edge_id, u, v FROM (
    SELECT o_orderkey,
      CAST(CASE WHEN o_orderkey % 3 = 0 THEN b ELSE a END AS BIGINT) AS u,
      CAST(CASE WHEN o_orderkey % 3 = 0 THEN a ELSE b END AS BIGINT) AS v
    FROM (
      SELECT o_orderkey, o_custkey AS a,
        CASE WHEN o_orderkey % 2 = 0 THEN o_custkey + 1 ELSE o_custkey + 40 END AS b
      FROM orders
      WHERE o_orderkey % 2 = 1 OR o_custkey % 40 < 39
    ) t0
    WHERE b IN (SELECT c_custkey FROM customer)
  ) t1
  GROUP BY u, v
) t2
""",
    "fx_vertices": """
SELECT e.edge_id, CAST(s.seq AS INT) AS seq,
  CAST(CASE s.seq WHEN 0 THEN a.lon WHEN 2 THEN b.lon
    ELSE (a.lon + b.lon) / 2 - ((e.edge_id % 7) - 3) / 6.0e0 * (b.lat - a.lat) / 2 * (0.00137e0 / 0.00108e0) END AS DOUBLE) AS lon,
  CAST(CASE s.seq WHEN 0 THEN a.lat WHEN 2 THEN b.lat
    ELSE (a.lat + b.lat) / 2 + ((e.edge_id % 7) - 3) / 6.0e0 * (b.lon - a.lon) / 2 * (0.00108e0 / 0.00137e0) END AS DOUBLE) AS lat
FROM fx_edges e
JOIN fx_nodes a ON a.node_id = e.u
JOIN fx_nodes b ON b.node_id = e.v
CROSS JOIN (SELECT 0 AS seq UNION ALL SELECT 1 UNION ALL SELECT 2) s
""",
    "fx_facilities": """
SELECT 10000000 + e.edge_id AS fac_id,
  CASE WHEN e.edge_id % 8 = 1 THEN 'footway' ELSE 'cycleway' END AS highway,
  CASE WHEN e.edge_id % 16 = 1 THEN e.name END AS name,
  CAST(a.lon - 0.07e0 * (b.lat - a.lat) * (0.00137e0 / 0.00108e0) AS DOUBLE) AS lon0,
  CAST(a.lat + 0.07e0 * (b.lon - a.lon) * (0.00108e0 / 0.00137e0) AS DOUBLE) AS lat0,
  CAST(b.lon - 0.07e0 * (b.lat - a.lat) * (0.00137e0 / 0.00108e0) AS DOUBLE) AS lon1,
  CAST(b.lat + 0.07e0 * (b.lon - a.lon) * (0.00108e0 / 0.00137e0) AS DOUBLE) AS lat1
FROM fx_edges e
JOIN fx_nodes a ON a.node_id = e.u
JOIN fx_nodes b ON b.node_id = e.v
WHERE e.edge_id % 4 = 1
""",
    "fx_elev": """
SELECT CAST(c_custkey AS BIGINT) AS node_id, CAST(c_acctbal / 200.0 AS DOUBLE) AS elev_m
FROM customer WHERE c_custkey % 13 <> 0
""",
    "fx_crossings": """
SELECT CAST(ev.event_id AS BIGINT) AS osmid,
  CAST(n.lon + 0.00008e0 * ((ev.event_id % 3) - 1) AS DOUBLE) AS lon, n.lat AS lat,
  CASE ev.event_type WHEN 'click' THEN 'marked' WHEN 'view' THEN 'zebra'
    WHEN 'purchase' THEN 'traffic_signals' WHEN 'error' THEN 'uncontrolled' END AS crossing,
  CASE WHEN ev.event_type = 'signup' AND ev.event_id % 2 = 0 THEN 'crossing' END AS highway,
  CASE WHEN ev.event_id % 4 = 0 THEN 'yes' WHEN ev.event_id % 4 = 1 THEN 'lines' END AS markings,
  CASE WHEN ev.event_id % 5 = 0 THEN 'yes' END AS signals,
  CASE WHEN ev.event_id % 6 = 0 THEN 'lowered' END AS kerb,
  CASE WHEN ev.event_id % 10 = 0 THEN 'yes' END AS tactile_paving
FROM events ev JOIN fx_nodes n ON n.node_id = ev.event_id
""",
    "fx_calming": """
SELECT CAST(p.p_partkey AS BIGINT) AS osmid, p.p_type AS traffic_calming,
  CAST(n.lon + 0.00003e0 * (p.p_size % 4) AS DOUBLE) AS lon, n.lat AS lat
FROM part p JOIN fx_nodes n ON n.node_id = p.p_partkey
""",
    "fx_gov_ramps": """
SELECT CAST(p.p_partkey AS BIGINT) AS locid,
  CASE WHEN p.p_size % 10 = 0 THEN '0' ELSE '1' END AS crexist,
  CASE WHEN p.p_size % 9 = 0 THEN NULL ELSE CAST(n.lon + 0.00004e0 * ((p.p_size % 5) - 2) AS DOUBLE) END AS longitude,
  CASE WHEN p.p_size % 9 = 0 THEN NULL ELSE CAST(n.lat + 0.00003e0 * ((p.p_size % 3) - 1) AS DOUBLE) END AS latitude,
  p.p_brand AS curbreturnloc, p.p_type AS positiononreturn, CAST(p.p_size * 2 AS INT) AS conditionscore
FROM part p JOIN fx_nodes n ON n.node_id = p.p_partkey
""",
    "fx_changes": """
SELECT CAST(event_id AS BIGINT) AS edit_id, ts, CAST(user_id AS BIGINT) AS user_id,
  CASE event_type WHEN 'click' THEN 'attr_edit' WHEN 'view' THEN 'move_point'
    WHEN 'purchase' THEN 'delete_point' WHEN 'signup' THEN 'add_point' ELSE 'undo' END AS edit_type,
  CAST(event_id % 500 AS BIGINT) AS node_id,
  CASE event_id % 3 WHEN 0 THEN 'lanes' WHEN 1 THEN 'lane_width' ELSE 'name' END AS col,
  CASE event_id % 3 WHEN 0 THEN CAST(event_id % 5 AS VARCHAR(20)) WHEN 1 THEN '3.25' ELSE concat('N', CAST(event_id % 50 AS VARCHAR(20))) END AS new_value,
  CAST(-122.5e0 + 0.00137e0 * (event_id % 40) AS DOUBLE) AS x,
  CAST(37.70e0 + 0.00108e0 * (event_id % 37) AS DOUBLE) AS y
FROM events
""",
}


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bind every derived view to the parquet tables in ``sf_dir``."""
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    frames: dict[str, DataFrame] = {}
    for name, sql in VIEW_SQL.items():
        frames[name] = spark.sql(sql)
        frames[name].createOrReplaceTempView(name)
    return frames
