"""Shape kernels, publication gates and views on the star tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from arpent.functions import geometry as G, scalars as X
from arpent.operators import ranking as R, search as SE, shapes as S
from arpent.plans import releases as RL
from arpent.plans.catalog import query, relation, table
from arpent.plans.q_features import _SCORED, _evidence
from arpent.plans.q_spatial import _BOX, _CROSS, _DIST, _OV, CELL, _two, boxes, ring_pairs

N = lambda name="n": F.count(F.lit(1)).alias(name)
_INSIDE = "b.xmin > a.xmin AND b.xmax < a.xmax AND b.ymin > a.ymin AND b.ymax < a.ymax"


@query("geo_inscribed_radius", f"WITH a AS ({_BOX}) SELECT vec_id, round(least(a.xmax - a.xmin, a.ymax - a.ymin) / 2, 1) AS radius FROM a WHERE xmax - xmin > 0 AND ymax - ymin > 0")
def geo_inscribed_radius(spark, sf):
    rows = boxes(spark, sf).where("box.xmax > box.xmin and box.ymax > box.ymin").withColumn("ring", G.box_ring("box"))
    return S.inscribed_radii(rows, ["vec_id"], "ring").withColumn("radius", F.round("radius", 1))


@query("geo_boundary_gap", f"WITH a AS ({_BOX}), b AS ({_BOX}) SELECT a.vec_id AS a_id, b.vec_id AS b_id, round(least(b.xmin - a.xmin, a.xmax - b.xmax, b.ymin - a.ymin, a.ymax - b.ymax), 4) AS gap FROM a JOIN b ON {_INSIDE}")
def geo_boundary_gap(spark, sf):
    """From a building within a parcel to the parcel's boundary."""
    a, b = _two(spark, sf)
    inside = (F.col("bbox.xmin") > F.col("abox.xmin")) & (F.col("bbox.xmax") < F.col("abox.xmax")) & (F.col("bbox.ymin") > F.col("abox.ymin")) & (F.col("bbox.ymax") < F.col("abox.ymax"))
    rows = G.grid_join(a, b, "abox", "bbox", CELL).where(inside).withColumns({"ra": G.box_ring("abox"), "rb": G.box_ring("bbox")})
    return S.boundary_gaps(rows, ["a_id", "b_id"], "rb", "ra").withColumn("gap", F.round("gap", 4))


@query("geo_split_zones", f"WITH a AS ({_BOX}), b AS ({_BOX}) SELECT a.vec_id AS a_id, b.label AS b_label, count(*) AS pieces, round(sum({_OV}), 2) AS area FROM a JOIN b ON a.vec_id <> b.vec_id AND {_CROSS} AND {_OV} > 1e-6 GROUP BY 1, 2")
def geo_split_zones(spark, sf):
    """Zones cut by areas: the number of true pieces, and their area by area code. ``shapes.split_rings`` has them as rings."""
    parts = ring_pairs(spark, sf, distance=False).where("a_id <> b_id and area > 1e-6D")
    return parts.groupBy("a_id", F.col("b_id_label").alias("b_label")).agg(N("pieces"), F.round(F.sum("area"), 2).alias("area"))


_ROAD = "SELECT vec_id AS r_id, embedding[6]::DOUBLE * 1000 AS rx, embedding[7]::DOUBLE * 1000 AS ry, embedding[6]::DOUBLE * 1000 + embedding[8]::DOUBLE * 200 AS sx, embedding[7]::DOUBLE * 1000 + embedding[9]::DOUBLE * 200 AS sy FROM embeddings WHERE embedding[8]::DOUBLE > 0"
_DISC = "CASE WHEN abs((px - {x}) * uy - (py - {y}) * ux) <= 3 THEN -((px - {x}) * ux + (py - {y}) * uy) {sign} sqrt(9 - pow((px - {x}) * uy - (py - {y}) * ux, 2)) END"


@query("geo_road_frontage", f"""WITH a AS ({_BOX}), b AS (SELECT *, least(rx, sx) AS xmin, least(ry, sy) AS ymin, greatest(rx, sx) AS xmax, greatest(ry, sy) AS ymax FROM ({_ROAD})),
c AS (SELECT vec_id, a.xmin AS x0, a.ymin AS y0, a.xmax AS x1, a.ymax AS y1, rx, ry, sx, sy, sqrt(pow(sx - rx, 2) + pow(sy - ry, 2)) AS m FROM a JOIN b ON {_DIST} <= 30),
e AS (SELECT *, (sx - rx) / m AS vx, (sy - ry) / m AS vy, 1 AS e, x0 AS px, y0 AS py, 1.0 AS ux, 0.0 AS uy, x1 - x0 AS len FROM c UNION ALL SELECT *, (sx - rx) / m, (sy - ry) / m, 2, x1, y0, 0.0, 1.0, y1 - y0 FROM c
  UNION ALL SELECT *, (sx - rx) / m, (sy - ry) / m, 3, x1, y1, -1.0, 0.0, x1 - x0 FROM c UNION ALL SELECT *, (sx - rx) / m, (sy - ry) / m, 4, x0, y1, 0.0, -1.0, y1 - y0 FROM c),
k AS (SELECT *, (0 - ((px - rx) * vx + (py - ry) * vy)) / (ux * vx + uy * vy) AS a1, (m - ((px - rx) * vx + (py - ry) * vy)) / (ux * vx + uy * vy) AS a2,
  (-3 - (vx * (py - ry) - vy * (px - rx))) / (vx * uy - vy * ux) AS c1, (3 - (vx * (py - ry) - vy * (px - rx))) / (vx * uy - vy * ux) AS c2 FROM e),
t AS (SELECT *, greatest(least(a1, a2), least(c1, c2)) AS lo, least(greatest(a1, a2), greatest(c1, c2)) AS hi FROM k),
s AS (SELECT vec_id, e, greatest(least({_DISC.format(x="rx", y="ry", sign="-")}, {_DISC.format(x="sx", y="sy", sign="-")}, CASE WHEN lo <= hi THEN lo END), 0) AS lo,
  least(greatest({_DISC.format(x="rx", y="ry", sign="+")}, {_DISC.format(x="sx", y="sy", sign="+")}, CASE WHEN lo <= hi THEN hi END), len) AS hi,
  coalesce({_DISC.format(x="rx", y="ry", sign="-")}, {_DISC.format(x="sx", y="sy", sign="-")}, CASE WHEN lo <= hi THEN lo END) IS NOT NULL AS near FROM t),
g AS (SELECT vec_id, CASE WHEN near AND lo < hi THEN greatest(hi - greatest(lo, coalesce(max(CASE WHEN near AND lo < hi THEN hi END) OVER (PARTITION BY vec_id, e, near AND lo < hi ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo)), 0) ELSE 0 END AS n FROM s),
f AS (SELECT vec_id, sum(n) AS frontage FROM g GROUP BY 1)
SELECT a.vec_id, round(frontage, 3) AS frontage, CASE WHEN frontage IS NULL THEN 'source_value_missing' END AS reason FROM a LEFT JOIN f ON a.vec_id = f.vec_id""")  # fmt: skip
def geo_road_frontage(spark, sf):
    """Boundary of each parcel within 3 of a road; missing where no road lies within 30."""
    a = boxes(spark, sf, "abox", "vec_id")
    e = lambda i: F.col("embedding")[i].cast("double")
    x, y = e(5) * 1000, e(6) * 1000
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    roads = table(spark, sf, "embeddings").where(e(7) > 0).select(F.struct(point(x, y).alias("a"), point(x + e(7) * 200, y + e(8) * 200).alias("b")).alias("road"))
    over = lambda f, c: f(F.col(f"road.a.{c}"), F.col(f"road.b.{c}"))
    roads = roads.withColumn("rbox", G.box(over(F.least, "x"), over(F.least, "y"), over(F.greatest, "x"), over(F.greatest, "y")))
    # Roads beyond 3 only tell that there is one, so those pairs are no more than a parcel's id.
    known = G.grid_join(a.select("vec_id", "abox"), roads.select("rbox"), "abox", "rbox", CELL, 30.0).select("vec_id")
    pairs = G.grid_join(a, roads, "abox", "rbox", CELL, 3.0 + 1e-6).withColumn("ring", G.box_ring("abox"))
    rows = a.select("vec_id").join(S.frontages(pairs, "vec_id", "ring", "road", 3.0, known), "vec_id", "left")
    return rows.select("vec_id", F.round("frontage", 3).alias("frontage"), F.when(F.col("frontage").isNull(), "source_value_missing").alias("reason"))


_POINTS = "SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS lon, CAST(c_nationkey AS STRING) AS commune_code FROM customer"


@query("qualify_degraded_precision", f"WITH p AS ({_POINTS}) SELECT c_custkey, CASE WHEN lon IS NULL OR lon < 0 THEN 'commune' ELSE 'point' END AS granularity, CASE WHEN lon IS NULL THEN 'geometry_missing' WHEN lon < 0 THEN 'geometry_outside' END AS reason, CASE WHEN lon >= 0 THEN lon END AS lon FROM p")
def qualify_degraded_precision(spark, sf):
    """A fact whose geometry cannot be used is kept for its commune, with the reason."""
    reason = F.when(F.col("lon").isNull(), "geometry_missing").when(F.col("lon") < 0, "geometry_outside")
    rows = relation(spark, sf, _POINTS).withColumn("reason", reason)
    return rows.select("c_custkey", F.when(F.col("reason").isNull(), "point").otherwise("commune").alias("granularity"), "reason", F.when(F.col("reason").isNull(), F.col("lon")).alias("lon"))


@query("join_alternative_parents", "WITH d AS (SELECT o_custkey AS subject, o_orderkey AS number, true AS direct, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000 UNION ALL SELECT o_custkey + 1, o_orderkey, false, CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 250000) SELECT subject, number, direct FROM (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY direct DESC, day DESC, number) AS k FROM d) WHERE k = 1")
def join_alternative_parents(spark, sf):
    """The best diagnostic of a subject through either of two parents: a direct one first, then the newest."""
    o = table(spark, sf, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("subject"), F.col("o_orderkey").alias("number"), F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    one = o.where("o_orderstatus = 'F'").withColumn("direct", F.lit(True))
    two = o.where("o_orderstatus = 'P'").withColumns({"subject": F.col("subject") + 1, "direct": F.lit(False)})
    return R.first_by(one.unionByName(two), ["subject"], [F.desc("direct"), F.desc("day"), F.asc("number")]).select("subject", "number", "direct")


@query("window_best_component", "SELECT l_orderkey, l_suppkey AS component, q AS size FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY q DESC, l_suppkey) AS k FROM (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)) WHERE k = 1")
def window_best_component(spark, sf):
    parts = table(spark, sf, "lineitem").groupBy("l_orderkey", F.col("l_suppkey").alias("component")).agg(F.sum("l_quantity").alias("size"))
    return R.first_by(parts, ["l_orderkey"], [F.desc("size"), F.asc("component")])


@query("territory_attraction_areas", "SELECT n_nationkey, CASE WHEN n_regionkey = 4 THEN NULL ELSE 'A' || n_regionkey END AS area_code, CASE WHEN n_regionkey = 4 THEN NULL WHEN n_nationkey = m THEN 'pole' ELSE 'ring' END AS category, CASE WHEN n_regionkey = 4 THEN 'not_applicable' WHEN c IS NULL THEN 'source_value_missing' END AS missing_reason, CASE WHEN n_regionkey <> 4 THEN c END AS residents FROM nation JOIN (SELECT n_regionkey AS r, min(n_nationkey) AS m FROM nation GROUP BY 1) ON r = n_regionkey LEFT JOIN (SELECT s_nationkey, count(*) AS c FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey")
def territory_attraction_areas(spark, sf):
    """Area, category and residents of a commune: outside every area is not applicable, an uncited commune is missing."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    pole = n.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("pole"))
    c = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(N("residents"))
    rows, member = n.join(pole, "n_regionkey").join(c, "n_nationkey", "left"), F.col("n_regionkey") != 4
    category = F.when(member, F.when(F.col("n_nationkey") == F.col("pole"), "pole").otherwise("ring"))
    reason = F.when(~member, "not_applicable").when(F.col("residents").isNull(), "source_value_missing")
    return rows.select("n_nationkey", F.when(member, F.concat(F.lit("A"), F.col("n_regionkey").cast("string"))).alias("area_code"), category.alias("category"), reason.alias("missing_reason"), F.when(member, F.col("residents")).alias("residents"))


@query("card_market_context", "WITH s AS (SELECT o_custkey, count(*) AS acts, round(quantile_cont(o_totalprice, 0.5), 3) AS median_price, CAST(max(o_orderdate) AS DATE) AS last_act FROM orders GROUP BY 1), z AS (SELECT o_custkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS zones, count(*) FILTER (WHERE l_linestatus = 'O') AS risks FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) SELECT c_custkey, coalesce(acts, 0) AS acts, median_price, last_act, zones, coalesce(risks, 0) AS risks FROM customer LEFT JOIN s ON s.o_custkey = c_custkey LEFT JOIN z ON z.o_custkey = c_custkey")
def card_market_context(spark, sf):
    """Acts, zones and risks of every unit, side by side."""
    o = table(spark, sf, "orders")
    s = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(N("acts"), F.round(F.percentile("o_totalprice", F.lit(0.5)), 3).alias("median_price"), F.to_date(F.max("o_orderdate")).alias("last_act"))
    lots = o.select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_linestatus"), "o_orderkey")
    z = lots.groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("zones"), F.count_if(F.col("l_linestatus") == "O").alias("risks"))
    rows = table(spark, sf, "customer").select("c_custkey").join(s, "c_custkey", "left").join(z, "c_custkey", "left")
    return rows.select("c_custkey", F.coalesce("acts", F.lit(0)).alias("acts"), "median_price", "last_act", "zones", F.coalesce("risks", F.lit(0)).alias("risks"))


@query("score_publication_gate", f"{_SCORED}, g AS (SELECT subject, count(*) AS parts, bool_or(missing AND requirement = 'required') AS req, bool_or(feature = 'CONF-001' AND value IS NULL) AS unaccepted FROM ev GROUP BY 1) SELECT subject, concat_ws(',', CASE WHEN req THEN 'required_missing' END, CASE WHEN unaccepted THEN 'release_not_accepted' END, CASE WHEN parts <> 4 THEN 'evidence_incomplete' END) AS blockers, NOT req AND NOT unaccepted AND parts = 4 AS publishable FROM g")
def score_publication_gate(spark, sf):
    """What keeps a snapshot from being published: required features, accepted releases, a complete evidence set."""
    e = _evidence(spark, sf)
    g = e.groupBy("subject").agg(N("parts"), F.bool_or(F.col("missing") & (F.col("requirement") == "required")).alias("req"), F.bool_or((F.col("feature") == "CONF-001") & F.col("value").isNull()).alias("un"))
    why = F.array_compact(F.array(F.when(F.col("req"), "required_missing"), F.when(F.col("un"), "release_not_accepted"), F.when(F.col("parts") != 4, "evidence_incomplete")))
    return g.select("subject", F.array_join(why, ",").alias("blockers"), (F.size(why) == 0).alias("publishable"))


@query("score_strongest_evidence", f"{_SCORED} SELECT subject, feature, round(impact, 6) AS impact FROM (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY abs(round(impact, 6)) DESC, feature) AS k FROM ev) WHERE k <= 2")
def score_strongest_evidence(spark, sf):
    """The two pieces of evidence of each subject with the largest impact either way."""
    w = Window.partitionBy("subject").orderBy(F.desc(F.abs("impact")), "feature")
    return _evidence(spark, sf).withColumn("k", F.row_number().over(w)).where("k <= 2").select("subject", "feature", "impact")


@query("bundle_readiness", "WITH w AS (SELECT c_custkey, v.s FROM customer, (VALUES ('F'), ('O'), ('P')) v(s)), h AS (SELECT o_custkey AS k, o_orderstatus AS s, count(*) AS n, max(year(o_orderdate)) AS y FROM orders GROUP BY 1, 2) SELECT c_custkey, count(h.n)::INT AS members, (count(*) - count(h.n))::INT AS missing, count(DISTINCT h.y) AS releases, count(h.n) = 3 AND min(h.n) >= 2 AS ready FROM w LEFT JOIN h ON h.k = c_custkey AND h.s = w.s GROUP BY 1")
def bundle_readiness(spark, sf):
    """Whether a customer has every dataset of a bundle with enough rows."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", F.year("o_orderdate").alias("y"))
    out = RL.coverage(table(spark, sf, "customer"), o, "c_custkey", "o_orderstatus", ["F", "O", "P"], least=2, release="y")
    return out.select("c_custkey", "members", F.size("missing").alias("missing"), "releases", (F.size("weak") == 0).alias("ready"))


# --- Search, codes, labels, refresh ---------------------------------------------------------------------------------

_LABEL = f"trim(regexp_replace(translate(lower({{x}}), '{X.ACCENTED}', '{X.FOLDED}'), '[^a-z0-9]+', ' ', 'g'))"
_GRAMS = "list_distinct(flatten(list_transform(list_filter(string_split({x}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
_ENTITIES = "SELECT 'area' AS kind, 'N' || n_nationkey::VARCHAR AS entity_id, n_name AS label FROM nation UNION ALL SELECT 'parcel', 'P' || p_partkey::VARCHAR, p_name FROM part UNION ALL SELECT 'address', 'S' || s_suppkey::VARCHAR, s_name FROM supplier"
_ASKED = ["Nation_1", "smal ring", "p-12", "Supplier 7"]


@query("search_entities", f"""WITH e AS (SELECT *, {_LABEL.format(x="label")} AS l, regexp_replace(upper(entity_id), '[^0-9A-Z]', '', 'g') AS k FROM ({_ENTITIES})), q AS (SELECT *, {_LABEL.format(x="q")} AS ql, regexp_replace(upper(q), '[^0-9A-Z]', '', 'g') AS qk FROM (VALUES {', '.join(f"('{x}')" for x in _ASKED)}) v(q)),
g AS (SELECT *, {_GRAMS.format(x="l")} AS t, {_GRAMS.format(x="ql")} AS qt FROM e, q), s AS (SELECT q, CASE WHEN l = ql THEN 1.0 WHEN starts_with(l, ql) OR starts_with(k, qk) THEN 0.95 ELSE round(len(list_intersect(t, qt)) / nullif(len(t) + len(qt) - len(list_intersect(t, qt)), 0), 6) END::DOUBLE AS score, kind, entity_id, label FROM g)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, label, kind, entity_id)::INT AS place FROM s WHERE score >= 0.3) WHERE place <= 8""")  # fmt: skip
def search_entities(spark, sf):
    """Areas, parcels and addresses by one search: label, beginning of label or id, or trigrams."""
    one = lambda t, kind, letter, key, label: table(spark, sf, t).select(F.lit(kind).alias("kind"), F.concat(F.lit(letter), F.col(key).cast("string")).alias("entity_id"), F.col(label).alias("label"))
    e = one("nation", "area", "N", "n_nationkey", "n_name").unionByName(one("part", "parcel", "P", "p_partkey", "p_name")).unionByName(one("supplier", "address", "S", "s_suppkey", "s_name"))
    return SE.search_entities(e, _ASKED, 8)


@query("scalar_display_labels", "SELECT c_custkey, concat_ws(' ', nullif(trim(CASE WHEN c_acctbal < 0 THEN ' ' ELSE c_mktsegment END), ''), nullif(trim(c_name), '')) AS label FROM customer")
def scalar_display_labels(spark, sf):
    first = F.when(F.col("c_acctbal") < 0, " ").otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", X.display_label(first, F.col("c_name")).alias("label"))


@query("scalar_first_commune", "SELECT o_orderkey, substr(list_filter([CASE WHEN o_orderstatus = 'F' THEN NULL ELSE '35' END, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE '35' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') || 'AB' END], lambda x: x IS NOT NULL AND length(x) >= 5)[1], 1, 5) AS commune FROM orders")
def scalar_first_commune(spark, sf):
    """The commune of the first nested id that is long enough."""
    ids = F.array(F.when(F.col("o_orderstatus") != "F", "35"), F.when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("35"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit("AB"))))
    return table(spark, sf, "orders").select("o_orderkey", X.first_usable(ids, 5).alias("commune"))


_CELLS = {("F", "_T"): "finished_all", ("O", "R"): "open_returned", ("F", "A"): "finished_accepted"}


@query("scalar_cell_codes", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'finished_accepted' WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'open_returned' END AS indicator,
CASE WHEN l_returnflag = 'N' THEN 'equipements_total' WHEN l_linestatus = 'F' THEN 'equipements_domaine_' || lower(l_returnflag) ELSE 'equipements_sous_domaine_' || lower(l_returnflag || l_linestatus) END AS facility, split_part(l_returnflag || '|' || l_linestatus, '|', 1) AS code FROM lineitem""")  # fmt: skip
def scalar_cell_codes(spark, sf):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    domain, part = F.when(flag == "N", "_T").otherwise(flag), F.when(status == "F", "_T").otherwise(F.concat(flag, status))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", X.cell_code([status, flag], _CELLS).alias("indicator"), X.facility_code(domain, part).alias("facility"), X.code_prefix(F.concat_ws("|", flag, status)).alias("code")
    )


@query("release_refresh_dimensions", """WITH s AS (SELECT o_custkey, o_clerk, c_nationkey FROM (SELECT o_custkey, min(o_orderpriority) AS o_clerk, min(c_nationkey) AS c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1))
SELECT 'parcel' AS dimension, coalesce(s.o_custkey, c.c_custkey)::VARCHAR AS id, CASE WHEN s.o_custkey IS NOT NULL THEN s.o_clerk ELSE c.c_mktsegment END AS label FROM s FULL JOIN customer c ON s.o_custkey = c.c_custkey
UNION ALL SELECT 'area', coalesce(a.c_nationkey, n.n_nationkey)::VARCHAR, CASE WHEN a.c_nationkey IS NOT NULL THEN a.l ELSE n.n_name END FROM (SELECT c_nationkey, min(o_orderpriority) AS l FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1) a FULL JOIN nation n ON a.c_nationkey = n.n_nationkey""")  # fmt: skip
def release_refresh_dimensions(spark, sf):
    """Areas and parcels refreshed from one release; what it does not hold keeps its old row."""
    c = table(spark, sf, "customer")
    source = table(spark, sf, "orders").where("o_orderstatus = 'F'").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_custkey").alias("parcel"), F.col("c_nationkey").alias("area"), F.col("o_orderpriority").alias("label"))
    old_parcels, old_areas = c.select(F.col("c_custkey").alias("parcel"), F.col("c_mktsegment").alias("label")), table(spark, sf, "nation").select(F.col("n_nationkey").alias("area"), F.col("n_name").alias("label"))
    new = RL.refresh_dimensions(source, {"parcel": (old_parcels, ["parcel"], ["label"], []), "area": (old_areas, ["area"], ["label"], [])})
    rows = [df.select(F.lit(name).alias("dimension"), F.col(name).cast("string").alias("id"), "label") for name, df in new.items()]
    return rows[0].unionByName(rows[1])
