"""Shared parts of the checking SQL, written for the checking engine alone."""

from __future__ import annotations

import re

from kerbline.functions import crs, geom
from kerbline.operators import intersections
from kerbline.sources.fixtures import VIEW_SQL

PARTS: dict[str, str] = dict(VIEW_SQL)


def part(name: str, sql: str) -> None:
    """Define a part; a name can be given once, as queries of all modules share the parts."""
    if PARTS.get(name, sql.strip()) != sql.strip():
        raise ValueError(f"part {name} is defined twice")
    PARTS[name] = sql.strip()


def _quoted(sql: str) -> str:
    """Quote column names that the checking engine reserves; keywords are upper case here."""
    return re.sub(r"\b(by|at)\b", r'"\1"', sql)


def with_parts(sql: str) -> str:
    """Prefix a select with the parts it names, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(PARTS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    sql = _quoted(sql)
    if not order:
        return sql.strip()
    body = ",\n".join(f"{n} AS MATERIALIZED (\n{_quoted(PARTS[n])}\n)" for n in order)
    return f"WITH {body}\n{sql.strip()}"


# -- scalar snippets ---------------------------------------------------------

def r(expr: str, digits: int) -> str:
    return f"round({expr}, {digits}) + 0.0e0"


def dist(x0, y0, x1, y1) -> str:
    return f"sqrt((({x1})-({x0}))*(({x1})-({x0}))+(({y1})-({y0}))*(({y1})-({y0})))"


def tparam(px, py, ax, ay, bx, by) -> str:
    return (f"greatest(0.0e0, least(1.0e0, (({px}-{ax})*({bx}-{ax})+({py}-{ay})*({by}-{ay}))"
            f"/nullif(({bx}-{ax})*({bx}-{ax})+({by}-{ay})*({by}-{ay}),0.0e0)))")


def pseg(px, py, ax, ay, bx, by) -> str:
    t = tparam(px, py, ax, ay, bx, by)
    return dist(px, py, f"{ax}+{t}*({bx}-{ax})", f"{ay}+{t}*({by}-{ay})")


def cross(ax, ay, bx, by) -> str:
    return f"(({ax})*({by})-({ay})*({bx}))"


def bearing(dx, dy) -> str:
    d = f"degrees(atan2({dx},{dy}))"
    return f"({d} - 360.0e0*floor({d}/360.0e0))"


def axis_diff(a, b) -> str:
    d = f"abs(({a}-180.0e0*floor({a}/180.0e0))-({b}-180.0e0*floor({b}/180.0e0)))"
    return f"(CASE WHEN {d} > 90 THEN 180.0e0-{d} ELSE {d} END)"


def haversine(lon0, lat0, lon1, lat1) -> str:
    a = (f"(pow(sin(radians({lat1}-{lat0})/2),2)+cos(radians({lat0}))*cos(radians({lat1}))"
         f"*pow(sin(radians({lon1}-{lon0})/2),2))")
    return f"(2.0e0*{crs.EARTH_RADIUS_M!r}*atan2(sqrt({a}),sqrt(1.0e0-{a})))"


def segseg(a: str, b: str) -> str:
    """Distance of segments a and b given as column prefixes with x0,y0,x1,y1."""
    A = [f"{a}{c}" for c in ("x0", "y0", "x1", "y1")]
    B = [f"{b}{c}" for c in ("x0", "y0", "x1", "y1")]
    return (f"(CASE WHEN {meets(a, b)} THEN 0.0e0 ELSE least({pseg(A[0], A[1], *B)},{pseg(A[2], A[3], *B)},"
            f"{pseg(B[0], B[1], *A)},{pseg(B[2], B[3], *A)}) END)")


def xt(a: str, b: str) -> tuple[str, str]:
    """Parameters of the crossing of segments a and b along a and along b."""
    det = cross(f"{a}x1-{a}x0", f"{a}y1-{a}y0", f"{b}x1-{b}x0", f"{b}y1-{b}y0")
    t = f"({cross(f'{b}x0-{a}x0', f'{b}y0-{a}y0', f'{b}x1-{b}x0', f'{b}y1-{b}y0')}/nullif({det},0.0e0))"
    u = f"({cross(f'{b}x0-{a}x0', f'{b}y0-{a}y0', f'{a}x1-{a}x0', f'{a}y1-{a}y0')}/nullif({det},0.0e0))"
    return t, u


def not_parallel(dax: str, day: str, dbx: str, dby: str) -> str:
    """Do two directions differ by more than the sine below which lines count as parallel?"""
    return (f"(abs({cross(dax, day, dbx, dby)}) > {geom.PARALLEL_SINE!r}*sqrt((({dax})*({dax})+({day})*({day}))"
            f"*(({dbx})*({dbx})+({dby})*({dby}))))")


def meets(a: str, b: str, slack: float = 0.0) -> str:
    t, u = xt(a, b)
    lo, hi = repr(-slack), repr(1.0 + slack)
    return f"coalesce({t} >= {lo} AND {t} <= {hi} AND {u} >= {lo} AND {u} <= {hi}, false)"


def straight_on(a: str, b: str) -> str:
    """End of segment a (0 or 1) at which a parallel segment b goes on from it, else null."""
    def touch(i: int, k: int) -> str:
        way = [f"({p}{c}{1-e}-{p}{c}{e})" for p, e in ((a, i), (b, k)) for c in "xy"]
        near = dist(f"{a}x{i}", f"{a}y{i}", f"{b}x{k}", f"{b}y{k}")
        return f"({near} <= {intersections.TOUCH_M!r} AND {way[0]}*{way[2]}+{way[1]}*{way[3]} < 0)"
    ways = [f"{p}{c}1-{p}{c}0" for p in (a, b) for c in "xy"]
    return f"(CASE WHEN {not_parallel(*ways)} THEN NULL WHEN {touch(0, 0)} OR {touch(0, 1)} THEN 0 WHEN {touch(1, 0)} OR {touch(1, 1)} THEN 1 END)"


def utm(source: str, lon: str = "lon", lat: str = "lat", x: str = "x", y: str = "y", zone: int = 10) -> str:
    """Select * plus UTM columns from ``source``."""
    e = repr(crs.CONFORMAL_E)
    k = repr(crs.UTM_K0 * crs.MERIDIAN_RADIUS)
    ee = "eta" + "".join(f"+({a!r})*cos({2*j}*xi)*sinh({2*j}*eta)" for j, a in enumerate(crs.ALPHA, 1))
    nn = "xi" + "".join(f"+({a!r})*sin({2*j}*xi)*cosh({2*j}*eta)" for j, a in enumerate(crs.ALPHA, 1))
    return (f"SELECT * EXCLUDE (t_, dl_, xi, eta), 500000.0e0+{k}*({ee}) AS {x}, {k}*({nn}) AS {y} FROM ("
            f"SELECT *, atan2(t_, cos(dl_)) AS xi, atanh(sin(dl_)/sqrt(1.0e0+t_*t_)) AS eta FROM ("
            f"SELECT *, sinh(atanh(sin(radians({lat})))-{e}*atanh({e}*sin(radians({lat})))) AS t_, "
            f"radians({lon}-({crs.central_meridian(zone)!r})) AS dl_ FROM {source}))")


def lonlat(source: str, x: str = "x", y: str = "y", lon: str = "lon", lat: str = "lat", zone: int = 10) -> str:
    """Select * plus geographic columns from ``source``."""
    k = repr(crs.UTM_K0 * crs.MERIDIAN_RADIUS)
    p = "xi" + "".join(f"-({b!r})*sin({2*j}*xi)*cosh({2*j}*eta)" for j, b in enumerate(crs.BETA, 1))
    q = "eta" + "".join(f"-({b!r})*cos({2*j}*xi)*sinh({2*j}*eta)" for j, b in enumerate(crs.BETA, 1))
    phi = "chi_" + "".join(f"+({d!r})*sin({2*j}*chi_)" for j, d in enumerate(crs.DELTA, 1))
    return (f"SELECT * EXCLUDE (xi, eta, p_, q_, chi_), ({crs.central_meridian(zone)!r})+degrees(atan2(sinh(q_),cos(p_))) AS {lon}, "
            f"degrees({phi}) AS {lat} FROM (SELECT *, asin(sin(p_)/cosh(q_)) AS chi_ FROM ("
            f"SELECT *, {p} AS p_, {q} AS q_ FROM (SELECT *, {y}/{k} AS xi, ({x}-500000.0e0)/{k} AS eta FROM {source})))")


# -- shared network parts ----------------------------------------------------

part("o_nodes", utm("fx_nodes"))
part("o_lines2", """
SELECT e.*, a.lon AS lon0, a.lat AS lat0, b.lon AS lon1, b.lat AS lat1, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1
FROM fx_edges e JOIN o_nodes a ON a.node_id = e.u JOIN o_nodes b ON b.node_id = e.v""")
part("o_verts", utm("fx_vertices"))
part("o_breaks", """
SELECT edge_id, seq, lon, lat, x, y,
  sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY edge_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS upto, brk
FROM (SELECT *, coalesce(lu >= 1e-9 AND lv >= 1e-9 AND degrees(acos(greatest(-1.0e0, least(1.0e0, dot/(lu*lv))))) > 45, false) AS brk
  FROM (SELECT *, sqrt(ux*ux+uy*uy) AS lu, sqrt(vx*vx+vy*vy) AS lv, ux*vx+uy*vy AS dot
    FROM (SELECT *, x - lag(x) OVER w AS ux, y - lag(y) OVER w AS uy, lead(x) OVER w - x AS vx, lead(y) OVER w - y AS vy
      FROM o_verts WINDOW w AS (PARTITION BY edge_id ORDER BY seq))))""")
part("o_piece_verts", """
SELECT edge_id, CAST(upto AS BIGINT) AS piece, seq, lon, lat, x, y FROM o_breaks
UNION ALL SELECT edge_id, CAST(upto - 1 AS BIGINT), seq, lon, lat, x, y FROM o_breaks WHERE brk""")
part("o_pieces", """
SELECT p.*, e.name, e.highway, e.oneway, e.edge_id * 4096 + p.piece AS seg_id,
  CASE WHEN p.piece = 0 THEN e.u ELSE -(e.edge_id*4096 + p.piece) END AS start_node,
  CASE WHEN p.piece = max(p.piece) OVER (PARTITION BY p.edge_id) THEN e.v ELSE -(e.edge_id*4096 + p.piece + 1) END AS end_node
FROM (SELECT edge_id, piece, count(*) AS n, arg_min(lon, seq) AS lon0, arg_min(lat, seq) AS lat0,
    arg_max(lon, seq) AS lon1, arg_max(lat, seq) AS lat1, arg_min(x, seq) AS x0, arg_min(y, seq) AS y0,
    arg_max(x, seq) AS x1, arg_max(y, seq) AS y1
  FROM o_piece_verts GROUP BY edge_id, piece) p JOIN fx_edges e USING (edge_id)""")


def oriented(source: str) -> str:
    """Bearings of ``source`` (x0..y1, name, oneway) before and after normalisation."""
    b = bearing("x1-x0", "y1-y0")
    rev = "CASE WHEN bearing >= 180 THEN bearing - 180 ELSE bearing + 180 END"
    return f"""
SELECT * EXCLUDE (kind, vote, north), CASE kind WHEN 'f' THEN bearing WHEN 'r' THEN {rev}
  ELSE CASE WHEN (CASE WHEN vote IS NULL THEN bearing >= 180 ELSE (north >= 0.5) <> (bearing < 180) END) THEN {rev} ELSE bearing END END AS normalized_bearing
FROM (SELECT *, avg(CASE WHEN vote IS NULL THEN NULL WHEN bearing < 180 THEN 1.0e0 ELSE 0.0e0 END) OVER (PARTITION BY vote) AS north
  FROM (SELECT *, CASE WHEN kind = 't' THEN nullif(trim(name), '') END AS vote
    FROM (SELECT *, {b} AS bearing, CASE WHEN oneway = 'yes' THEN 'f' WHEN oneway = '-1' THEN 'r' ELSE 't' END AS kind FROM {source})))"""


part("o_junctions", """
SELECT node_id, count(DISTINCT nb) AS n_neighbours FROM (SELECT u AS node_id, v AS nb FROM fx_edges UNION ALL SELECT v, u FROM fx_edges)
GROUP BY node_id HAVING count(DISTINCT nb) >= 3""")


def identified(source: str, cx: str, cy: str) -> str:
    return f"""
SELECT *, CAST(cell_col AS VARCHAR) || '_' || CAST(cell_row AS VARCHAR) || '_' || CAST(cell_seq AS VARCHAR) AS grid_id
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY cell_col, cell_row ORDER BY seg_id) - 1 AS BIGINT) AS cell_seq
FROM (SELECT *, CAST(floor(({cx} - (SELECT min(x) FROM o_nodes)) / 500.0e0) AS BIGINT) AS cell_col,
  CAST(floor(({cy} - (SELECT min(y) FROM o_nodes)) / 500.0e0) AS BIGINT) AS cell_row,
  start_node IN (SELECT node_id FROM o_junctions) AS start_is_intersection,
  end_node IN (SELECT node_id FROM o_junctions) AS end_is_intersection FROM {source}))"""


part("o_straight0", oriented("(SELECT *, edge_id*4096 AS seg_id, u AS start_node, v AS end_node FROM o_lines2)"))
part("o_straight", identified("o_straight0", "(x0+x1)/2", "(y0+y1)/2"))
part("o_split0", oriented("o_pieces"))
part("o_piece_centroids", """
SELECT edge_id, piece, sum(l*mx)/sum(l) AS cx, sum(l*my)/sum(l) AS cy FROM (
  SELECT edge_id, piece, sqrt((nx-x)*(nx-x)+(ny-y)*(ny-y)) AS l, (x+nx)/2 AS mx, (y+ny)/2 AS my
  FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM o_piece_verts WINDOW w AS (PARTITION BY edge_id, piece ORDER BY seq))
  WHERE nx IS NOT NULL) GROUP BY edge_id, piece""")
part("o_split", identified("(SELECT s.*, c.cx, c.cy FROM o_split0 s JOIN o_piece_centroids c USING (edge_id, piece))", "cx", "cy"))
part("o_crossings0", utm("fx_crossings"))
part("o_crossings", """
SELECT osmid, lon, lat, x, y, coalesce(crossing, CASE WHEN highway = 'crossing' THEN 'crossing' END) AS type,
  CASE WHEN crossing IN ('traffic_signals','traffic_light','pelican','puffin','toucan') OR signals IN ('yes','traffic_signals') THEN 'yes' END AS controlled,
  CASE WHEN crossing IN ('marked','zebra','pelican','toucan','puffin','crosswalk') OR markings IN ('yes','lines','dots','dashes') THEN 'yes' END AS marked,
  markings, signals, kerb, tactile_paving
FROM o_crossings0 WHERE crossing IS NOT NULL OR highway = 'crossing' OR kerb IS NOT NULL OR tactile_paving IS NOT NULL""")
part("o_calming", utm("fx_calming"))
part("o_fac", utm(f"({utm('fx_facilities', 'lon0', 'lat0', 'x0', 'y0')})", "lon1", "lat1", "x1", "y1"))
part("o_gov", utm("fx_gov_ramps", "longitude", "latitude"))
part("o_changes", utm("(SELECT * RENAME (x AS lon, y AS lat) FROM fx_changes)"))
