"""DuckDB SQL that says independently what each registered query must return.

The statements are assembled from common table expressions; ``statement`` adds the ones a
query needs. They spell the rules out row by row (lateral lookups, correlated tests, brute
force over all nodes) and share nothing with the Spark plans but the input tables.
"""

from __future__ import annotations

import re

from dataclasses import dataclass

from checks.fixtures import COST, SNAPSHOT_COST, SQL, STREETS_WHERE

VALID = "dropoff_datetime > TIMESTAMP '1900-01-01' AND pickup_datetime > TIMESTAMP '1900-01-01'"
NEIGHBOURS = "(61, 38, 71, 57, 8, 41)"
FIRST, AFTER = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-31'"

CTES: dict[str, str] = dict(SQL)

CTES["places"] = (
    "SELECT DISTINCT node_id, x, y FROM nodes JOIN links USING (link_id) WHERE intrsect = 'Y'")
CTES["points"] = "SELECT DISTINCT x, y FROM intersections WHERE x IS NOT NULL"
CTES["snapped"] = (
    "SELECT p.x, p.y, min(struct_pack(d := (p.x - n.x) * (p.x - n.x) + (p.y - n.y) * (p.y - n.y), "
    "node := n.node_id)) AS best FROM points p, places n GROUP BY p.x, p.y")
CTES["located"] = (
    "SELECT i.int_id, i.x, i.y, s.best.node AS node FROM intersections i "
    "LEFT JOIN snapped s ON s.x = i.x AND s.y = i.y")
# Keyed by row so that equal trips stay apart.
CTES["keyed"] = "SELECT row_number() OVER () AS rid, * FROM trips"
CTES["ends"] = (
    "SELECT t.*, o.x AS ox, o.y AS oy, o.node AS o_node, d.x AS dx, d.y AS dy, d.node AS d_node "
    "FROM keyed t JOIN located o ON o.int_id = t.pickup_gc_intersection_id "
    "JOIN located d ON d.int_id = t.dropoff_gc_intersection_id")


def _gate(direction: str, mun: str, x: str, y: str) -> str:
    d2 = f"(e.{x} - g.x) * (e.{x} - g.x) + (e.{y} - g.y) * (e.{y} - g.y)"
    return (
        f"SELECT rid, min(struct_pack(d := d2, node := node_id)).node AS gate FROM ("
        f"SELECT e.rid, g.node_id, g.short_long, {d2} AS d2 FROM ends e JOIN gateways g ON e.{mun} = g.mun_id "
        f"WHERE g.bound IS NULL OR g.bound = '{direction}') WHERE (d2 <= 9000000 AND short_long = 'shorter_points') "
        f"OR (d2 > 9000000 AND short_long = 'longer_points') GROUP BY rid")


CTES["gate_out"] = _gate("outbound", "dropoff_mun_id", "ox", "oy")
CTES["gate_in"] = _gate("inbound", "pickup_mun_id", "dx", "dy")

_KEPT_COLUMNS = (
    "rid, mlsassignedptc, ptctripid, trippassengerid, provider_id, request_datetime, pickup_datetime, "
    "dropoff_datetime, pickup_mun_id, dropoff_mun_id, pickup_gc_intersection_id, dropoff_gc_intersection_id, "
    "ox IS NOT NULL AS has_orig, dx IS NOT NULL AS has_dest")
CTES["placed_all"] = f"SELECT {_KEPT_COLUMNS}, o_node AS source, d_node AS target FROM ends"
CTES["placed_city"] = (
    f"SELECT {_KEPT_COLUMNS}, coalesce(i.gate, CASE WHEN pickup_mun_id = 69 THEN o_node END) AS source, "
    "coalesce(o.gate, CASE WHEN dropoff_mun_id = 69 THEN d_node END) AS target FROM ends "
    "LEFT JOIN gate_in i USING (rid) LEFT JOIN gate_out o USING (rid)")


@dataclass(frozen=True)
class View:
    """What a view must do, said here once more and not taken from the rule sets under test."""

    name: str
    time_column: str
    snap: str
    endpoint_rule: str
    valid_time: str
    segment_pickup: str
    drop_last: str
    emit_pooled: bool
    emit_ext_trip: bool


VIEWS = (
    View("city", "request_datetime", "all", "has_geom", "row", "stop", "set", True, False),
    View("city_as_written", "request_datetime", "all", "null_geom", "row", "stop", "set", True, False),
    View("city_sentinel", "request_datetime", "all", "sentinel", "having", "passenger", "set", False, False),
    View("external", "request_datetime", "city", "external", "row", "stop", "final", True, False),
    View("all_imputed", "pickup_datetime", "city", "external_or_city", "row", "stop", "final", True, True),
)


def _rule(spec: View, has: tuple[str, str], ints: tuple[str, str], muns: tuple[str, str]) -> str:
    external = f"({muns[1]} IN {NEIGHBOURS} OR {muns[0]} IN {NEIGHBOURS})"
    return {
        "has_geom": f"{has[0]} AND {has[1]}",
        "null_geom": f"NOT {has[0]} AND NOT {has[1]}",
        "sentinel": f"{ints[0]} <> 99999999 AND {ints[1]} <> 99999999",
        "external": external,
        "external_or_city": f"({external} OR {muns[0]} = 69 OR {muns[1]} = 69)",
    }[spec.endpoint_rule]


_ORDER = ", ".join(f"{name} NULLS LAST" for name in
                   ("ts", "trippassengerid", "kind", "mlsassignedptc", "int_id", "node"))


def _view(spec: View) -> None:
    n = spec.name
    CTES[f"{n}_trips"] = (
        f"SELECT CAST({spec.time_column} AS DATE) AS service_date, * FROM placed_{spec.snap} "
        f"WHERE {spec.time_column} IS NOT NULL")
    counted = f" AND {VALID}" if spec.valid_time == "having" else ""
    CTES[f"{n}_keys"] = (
        f"SELECT service_date, mlsassignedptc, ptctripid FROM {n}_trips "
        f"WHERE provider_id IN (28608558, 1608409){counted} GROUP BY ALL HAVING count(DISTINCT trippassengerid) > 1")
    stop_filter = f" WHERE {VALID}" if spec.valid_time == "row" else ""
    CTES[f"{n}_pool"] = (
        f"SELECT t.* FROM {n}_trips t JOIN {n}_keys USING (service_date, mlsassignedptc, ptctripid){stop_filter}")
    CTES[f"{n}_stops"] = (
        "SELECT service_date, mlsassignedptc, ptctripid, trippassengerid, pickup_datetime AS passenger_pickup, 0 AS kind, "
        "pickup_datetime AS ts, source AS node, pickup_mun_id AS mun_id, pickup_gc_intersection_id AS int_id, "
        f"has_orig AS has_point FROM {n}_pool UNION ALL "
        "SELECT service_date, mlsassignedptc, ptctripid, trippassengerid, pickup_datetime, 1, "
        f"dropoff_datetime, target, dropoff_mun_id, dropoff_gc_intersection_id, has_dest FROM {n}_pool")
    leads = ", ".join(f"lead({c}) OVER w AS next_{c}" for c in ("ts", "node", "mun_id", "int_id", "has_point"))
    CTES[f"{n}_next"] = (
        f"SELECT *, {leads}, lead(1) OVER w AS follows FROM {n}_stops "
        f"WINDOW w AS (PARTITION BY service_date, ptctripid ORDER BY {_ORDER})")
    rule = _rule(spec, ("has_point", "next_has_point"), ("int_id", "next_int_id"), ("mun_id", "next_mun_id"))
    in_set = " AND follows = 1" if spec.drop_last == "set" else ""
    CTES[f"{n}_kept"] = f"SELECT * FROM {n}_next WHERE {rule}{in_set}"

    own = _rule(spec, ("has_orig", "has_dest"), ("pickup_gc_intersection_id", "dropoff_gc_intersection_id"),
                ("pickup_mun_id", "dropoff_mun_id"))
    external = f"dropoff_mun_id IN {NEIGHBOURS} OR pickup_mun_id IN {NEIGHBOURS}"
    flags = ", FALSE AS pooled" if spec.emit_pooled else ""
    flags += f", ({external}) AS ext_trip" if spec.emit_ext_trip else ""
    CTES[f"{n}_unpooled"] = (
        "SELECT service_date, mlsassignedptc, ptctripid, trippassengerid, pickup_datetime, pickup_gc_intersection_id, "
        f"source, dropoff_datetime, dropoff_gc_intersection_id, target{flags} FROM {n}_trips t WHERE NOT EXISTS ("
        f"SELECT 1 FROM {n}_kept k WHERE k.service_date = t.service_date AND k.ptctripid = t.ptctripid "
        f"AND k.trippassengerid = t.trippassengerid) AND {own}")
    external = f"next_mun_id IN {NEIGHBOURS} OR mun_id IN {NEIGHBOURS}"
    flags = ", TRUE AS pooled" if spec.emit_pooled else ""
    flags += f", CASE WHEN {external} THEN TRUE ELSE FALSE END AS ext_trip" if spec.emit_ext_trip else ""
    starts = "ts" if spec.segment_pickup == "stop" else "passenger_pickup"
    last = " WHERE next_ts IS NOT NULL" if spec.drop_last == "final" else ""
    CTES[f"{n}_segments"] = (
        f"SELECT service_date, mlsassignedptc, ptctripid, trippassengerid, {starts} AS pickup_datetime, "
        "int_id AS pickup_gc_intersection_id, node AS source, next_ts AS dropoff_datetime, "
        f"next_int_id AS dropoff_gc_intersection_id, next_node AS target{flags} FROM {n}_kept{last}")
    CTES[f"{n}_prepared"] = f"SELECT * FROM {n}_unpooled UNION ALL SELECT * FROM {n}_segments"


for _spec in VIEWS:
    _view(_spec)

# Routing of the all_imputed days.
CTES["bins"] = (
    f"SELECT CAST(b AS DATE) AS service_date, b AS bin_start FROM "
    f"(SELECT unnest(generate_series({FIRST}, {AFTER} - INTERVAL '5' MINUTE, INTERVAL '5' MINUTE)) AS b)")
CTES["binned"] = (
    "SELECT p.*, time_bucket(INTERVAL '5' MINUTE, pickup_datetime) AS pickup_bin, b.bin_start FROM all_imputed_prepared p "
    "LEFT JOIN bins b ON b.service_date = p.service_date AND p.pickup_datetime >= b.bin_start "
    "AND p.pickup_datetime < b.bin_start + INTERVAL '5' MINUTE "
    "WHERE p.service_date >= DATE '2024-01-01' AND p.service_date < DATE '2024-01-31'")
CTES["vertices"] = "SELECT DISTINCT vertex_id, node_id FROM vertex_map"
CTES["od_trips"] = (
    "SELECT DISTINCT b.service_date, b.bin_start, b.mlsassignedptc, b.ptctripid, b.trippassengerid, "
    "s.vertex_id AS source, t.vertex_id AS target FROM binned b JOIN vertices s ON s.node_id = b.source "
    "JOIN vertices t ON t.node_id = b.target WHERE b.bin_start IS NOT NULL")
_STEP = "((hour({b}) * 60 + minute({b})) // 5)"
CTES["od_pairs"] = (
    f"SELECT DISTINCT {_STEP.format(b='bin_start')} AS profile, source, target FROM od_trips WHERE source <> target")
CTES["costed"] = (
    f"SELECT profile, id, source, target, {COST} AS cost FROM edges, (SELECT DISTINCT profile FROM od_pairs)")
CTES["labels"] = """USING KEY (profile, src, node) AS (
  SELECT DISTINCT profile, source AS src, source AS node, CAST(0 AS BIGINT) AS dist, 0 AS hops FROM od_pairs
  UNION
  SELECT c.profile, c.src, c.node, c.dist, c.hops FROM (
    SELECT l.profile, l.src, e.target AS node, CAST(min(l.dist + e.cost) AS BIGINT) AS dist, any_value(l.hops) + 1 AS hops
    FROM labels l JOIN costed e ON e.profile = l.profile AND e.source = l.node
    GROUP BY l.profile, l.src, e.target) c
  LEFT JOIN recurring.labels r ON r.profile = c.profile AND r.src = c.src AND r.node = c.node
  WHERE r.dist IS NULL OR c.dist < r.dist)"""
CTES["final_labels"] = "SELECT * FROM labels"
CTES["found"] = (
    "SELECT p.profile, p.source, p.target, l.dist, l.hops FROM od_pairs p JOIN final_labels l "
    "ON l.profile = p.profile AND l.src = p.source AND l.node = p.target")
# Walk back over tight edges: the smallest edge id whose tail is one hop nearer.
CTES["walk"] = """AS (
  SELECT profile, source, target, target AS node, dist, hops, CAST(-1 AS BIGINT) AS edge, CAST(0 AS BIGINT) AS cost FROM found
  UNION ALL
  SELECT profile, source, target, best.node, best.dist, hops, best.id, best.cost FROM (
    SELECT w.profile, w.source, w.target, w.hops - 1 AS hops,
           min(struct_pack(id := e.id, node := u.node, dist := u.dist, cost := e.cost)) AS best
    FROM walk w JOIN costed e ON e.profile = w.profile AND e.target = w.node
    JOIN final_labels u ON u.profile = w.profile AND u.src = w.source AND u.node = e.source
    WHERE w.hops > 0 AND u.dist + e.cost = w.dist AND u.hops + 1 = w.hops
    GROUP BY w.profile, w.source, w.target, w.hops))"""
CTES["path_rows"] = (
    "SELECT profile, source AS start_vid, target AS end_vid, CAST(hops + 1 AS INT) AS path_seq, node, edge, cost, "
    "dist AS agg_cost FROM walk")
CTES["routed"] = (
    "SELECT t.service_date, t.bin_start, t.mlsassignedptc, t.ptctripid, t.trippassengerid, p.start_vid, p.end_vid, "
    "p.path_seq, p.node, p.edge, p.cost, p.agg_cost FROM od_trips t JOIN path_rows p "
    f"ON p.profile = {_STEP.format(b='t.bin_start')} AND p.start_vid = t.source AND p.end_vid = t.target")
CTES["mapped"] = (
    "SELECT b.service_date, b.bin_start, b.mlsassignedptc, b.ptctripid, b.trippassengerid, b.pickup_datetime, "
    "b.source AS source_node, b.target AS target_node, s.vertex_id AS source, t.vertex_id AS target, f.dist FROM binned b "
    "LEFT JOIN vertices s ON s.node_id = b.source LEFT JOIN vertices t ON t.node_id = b.target "
    f"LEFT JOIN found f ON f.profile = {_STEP.format(b='b.bin_start')} AND f.source = s.vertex_id AND f.target = t.vertex_id")
CTES["judged"] = (
    "SELECT *, CASE WHEN bin_start IS NULL THEN 'outside_bins' WHEN source_node IS NULL OR target_node IS NULL THEN 'no_node' "
    "WHEN source IS NULL OR target IS NULL THEN 'no_vertex' WHEN source = target THEN 'same_vertex' "
    "WHEN dist IS NULL THEN 'unreachable' ELSE 'routed' END AS outcome FROM mapped")

_RECURSIVE = {"labels": "(profile, src, node, dist, hops)", "walk": ""}
_MATERIALIZED = ["keyed", "final_labels", "od_trips", "costed", "found"]
_ROUTING = ["od_pairs", "costed", "labels", "final_labels", "found", "walk", "path_rows", "routed"]


def _routed_on(suffix: str, **replaced: str) -> None:
    """The routing tables once more, under names of their own, on another network."""
    for name in _ROUTING:
        text = re.sub(rf"\b({'|'.join(_ROUTING)})\b", rf"\1_{suffix}", replaced.get(name, CTES[name]))
        CTES[f"{name}_{suffix}"] = text
        if name in _RECURSIVE:
            _RECURSIVE[f"{name}_{suffix}"] = _RECURSIVE[name]
        if name in _MATERIALIZED:
            _MATERIALIZED.append(f"{name}_{suffix}")


_routed_on("streets", costed=f"{CTES['costed']} WHERE {STREETS_WHERE}")
_routed_on(
    "snapshots",
    od_pairs="SELECT DISTINCT bin_start AS profile, source, target FROM od_trips WHERE source <> target",
    costed=f"SELECT profile, id, source, target, {SNAPSHOT_COST.format(step=_STEP.format(b='profile'), bin='profile')} AS cost "
           "FROM edges, (SELECT DISTINCT profile FROM od_pairs)",
    routed=CTES["routed"].replace(_STEP.format(b="t.bin_start"), "t.bin_start"))


def _needed(text: str, seen: list[str]) -> list[str]:
    for name in CTES:
        if name not in seen and re.search(rf"\b{name}\b", text):
            seen.append(name)
            _needed(CTES[name], seen)
    return seen


def statement(final: str) -> str:
    """``final`` with every common table expression it depends on."""
    wanted = set(_needed(final, []))
    # Names may be mentioned before they are needed (a column called like a table), so order by dependency.
    ordered: list[str] = []

    def place(name: str, path: tuple[str, ...] = ()) -> None:
        if name in ordered or name in path:
            return
        for other in wanted:
            if other != name and re.search(rf"(FROM|JOIN|,)\s+\(?{other}\b", CTES[name]):
                place(other, (*path, name))
        ordered.append(name)

    for name in CTES:
        if name in wanted:
            place(name)
    ctes = []
    for name in ordered:
        text = CTES[name]
        if name in _RECURSIVE:
            ctes.append(f"{name}{_RECURSIVE[name]} {text}")
        else:
            # Used many times and costly: computed once.
            how = "AS MATERIALIZED" if name in _MATERIALIZED else "AS"
            ctes.append(f"{name} {how} ({text})")
    return f"WITH RECURSIVE {', '.join(ctes)} {final}" if ctes else final
