"""Small cases of single operators, with values worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from arpent.functions import geometry as G, scalars as X
from arpent.functions.support import missing_support, weighted_quantile, with_scopes
from arpent.operators import matching as M, ranking as R, sales as T, shapes as S
from arpent.operators.asof import first_after, latest_before
from arpent.operators.graph import connected_components
from arpent.plans import barometer as B, features as FT, releases as RL
from arpent.sources import files

LOTS = "sale_id long, lot_no long, local_type string, built_m2 double, land_m2 double, rooms int, lot_label string, parcel_id string, culture string, value_eur double"


def verdicts(spark, rows):
    return {r["sale_id"]: (r["price_eur"], r["complexity"]) for r in T.sale_verdicts(spark.createDataFrame(rows, LOTS)).collect()}


def test_sale_reasons(spark):
    house = (1, 1, "Maison", 110.0, None, 4, "", "A", None, 300000.0)
    rows = [
        house, (1, 2, None, None, 400.0, None, "", "B", "sols", 300000.0),  # house and garden on two parcels keep the price
        (2, 1, "Maison", 90.0, None, 4, "", "A", None, 1.0), (2, 2, "Dépendance", None, None, 0, "", "A", None, 1.0),  # with a garage it does not
        (3, 1, None, None, 100.0, None, "", "A", "prés", 5.0), (3, 2, None, None, None, None, "", "B", "sols", 5.0),  # land on two parcels
        (4, 1, "Maison", 90.0, None, 4, "", "A", None, None),  # no price wins over all else
        (5, 1, None, None, 100.0, None, "", "A", "prés", 7.0), (5, 2, None, None, 50.0, None, "", "A", "terres", 7.0),  # two cultures of one parcel
        (6, 1, "Maison", 0.0, None, 1, "", "A", None, 9.0), (7, 1, "Maison", 10.0, None, 1, "", "A", None, 9.0), (7, 2, "Maison", 10.0, None, 1, "", "A", None, 8.0),
        (8, 1, None, None, None, None, "", "A", None, 3.0),
    ]
    got = verdicts(spark, rows)
    assert got[1] == (300000.0, None)
    assert got[2][1] == "multiple_priced_lots"
    assert got[3][1] == "multiple_parcels"
    assert got[4] == (None, "price_missing")
    assert got[5] == (7.0, None)
    assert got[6][1] == "surface_missing"
    assert got[7] == (None, "price_missing")
    assert got[8][1] == "no_priced_lot"
    lots = T.properties(spark.createDataFrame(rows, LOTS)).where("sale_id = 5").collect()
    assert [(r["priced_m2"], r["allocation_method"]) for r in lots] == [(150.0, "single_land_lot_all_cultures")]


def test_quantiles_and_support(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 1.0), ("a", 10.0, 5.0)], "k string, v double, w double")
    assert weighted_quantile(df, ["k"], "v", "w", 0.5, "q").first()["q"] == 10.0
    n = spark.range(1).select(missing_support(F.lit(3), 15).alias("a"), missing_support(F.lit(15), 15).alias("b")).first()
    assert (n["a"], n["b"]) == ("insufficient support: 3 < 15", None)


def test_scopes_skip_communes_without_area(spark):
    rows = spark.createDataFrame([("1",), ("2",)], "commune_code string")
    area = spark.createDataFrame([("1", "E"), ("2", None)], "commune_code string, epci_code string")
    got = sorted((r["scope_type"], r["scope_code"]) for r in with_scopes(rows, area, "35", ("department", "epci", "commune")).collect())
    assert got == [("commune", "1"), ("commune", "2"), ("department", "35"), ("department", "35"), ("epci", "E")]


def test_pairs_need_181_days(spark):
    d = date(2020, 1, 1)
    rows = [("p", "c", d, 1.0, 1.0), ("p", "c", date(2020, 6, 29), 2.0, 1.0), ("p", "c", date(2020, 12, 27), 3.0, 1.0)]
    sales = spark.createDataFrame(rows, "parcel_id string, commune_code string, mutation_date date, price_eur double, surface_m2 double")
    assert [r["days"] for r in B.successive_pairs(sales).collect()] == [181]


def test_asof(spark):
    left = spark.createDataFrame([(1, "k", date(2024, 1, 2)), (2, "k", date(2024, 1, 5)), (3, "z", date(2024, 1, 1))], "id int, k string, d date")
    right = spark.createDataFrame([("k", date(2024, 1, 2), "x"), ("k", date(2024, 1, 5), "y")], "k string, e date, v string")
    got = {r["id"]: r["n"] for r in first_after(left, right, "k", "d", "e", "n").collect()}
    assert got == {1: date(2024, 1, 5), 2: None, 3: None}
    got = {r["id"]: r["l"] for r in latest_before(left, right, "k", "d", "e", "v", "v", 3, "l").collect()}
    assert got == {1: "x", 2: "y", 3: None}


def test_resolution(spark):
    rows = [("a", "1", 0.95), ("b", "1", 0.95), ("b", "2", 0.91), ("c", "1", 0.7), ("d", "1", 0.3), ("e", "1", 0.95), ("e", "2", 0.6)]
    got = {(r["g"], r["i"]): r["decision"] for r in M.resolve(spark.createDataFrame(rows, "g string, i string, c double"), "g", "c", "i").collect()}
    assert got == {("a", "1"): "certain", ("b", "1"): "ambiguous", ("b", "2"): "ambiguous", ("c", "1"): "ambiguous", ("d", "1"): "rejected", ("e", "1"): "certain", ("e", "2"): "rejected"}


def test_unique_winner_never_breaks_ties(spark):
    rows = spark.createDataFrame([("a", 0.5), ("a", 0.5), ("b", 0.6), ("b", 0.4), ("c", 0.0), ("d", None)], "k string, s double")
    got = sorted((r["k"], r["rationale"]) for r in M.unique_winner(rows, "k", "s").collect())
    assert got == [("a", "tied_maximum"), ("a", "tied_maximum"), ("b", "smaller_share"), ("b", "unique_maximum"), ("c", "share_zero"), ("d", "share_missing")]


def test_mean_rank(spark):
    rows = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None), (3, 1.0, 2.0), (4, None, None)], "id int, a double, b double")
    got = {r["id"]: (round(r["mean_rank"], 6), r["signals"]) for r in R.mean_rank(rows, "id", {"a": True, "b": False}).collect()}
    assert got == {1: (0.5, 1), 2: (0.5, 1), 3: (1.0, 2), 4: (1.0, 0)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (5, 5), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_scalars(spark):
    row = spark.range(1).select(
        X.address_label(F.lit("1 bis, Rue de l'Été 35000 RENNES")).alias("a"), X.parcel_id(F.lit("350010000AB0001")).alias("p"), X.price(F.lit("0,00")).alias("z"), X.price(F.lit("185000,50")).alias("v"),
        X.months_between(F.lit("2024-01-31").cast("date"), F.lit("2024-02-29").cast("date")).alias("m"), X.french_or_iso_date(F.lit("05/03/2016")).alias("d"), X.similarity(X.trigrams(F.lit("word")), X.trigrams(F.lit("two words"))).alias("s"),
    ).first()
    assert row["a"] == "1 bis rue de l ete 35000 rennes"
    assert row["p"] == "35001000AB0001"
    assert (row["z"], row["v"], row["m"], row["d"]) == (None, 185000.5, 0, date(2016, 3, 5))
    assert row["s"] == pytest.approx(4 / 11)


def test_geometry(spark):
    b = spark.createDataFrame([(0.0, 0.0, 3.0, 4.0)], "a double, b double, c double, d double").select(G.box(*[F.col(c) for c in "abcd"]).alias("b")).withColumn("r", G.box_ring("b"))
    hit = lambda x, y: G.inside_ring(F.lit(x), F.lit(y), F.col("r"))
    row = b.select(G.ring_area(F.col("r")).alias("a"), G.ring_length(F.col("r")).alias("l"), hit(1.0, 1.0).alias("i"), hit(4.0, 1.0).alias("o")).first()
    assert tuple(row) == (12.0, 14.0, True, False)
    e, n = spark.range(1).select(*G.lambert93(F.lit(3.0), F.lit(46.5))).first()
    assert e == pytest.approx(700000, abs=0.01) and n == pytest.approx(6600000, abs=0.5)


def test_clipping_and_union():
    import numpy as np

    square = np.array([(0, 0), (2, 0), (2, 2), (0, 2)], float)
    assert S.area(S.clip_convex(square, square + 1)) == pytest.approx(1)
    assert S.area(S.clip_convex(square, square + 5)) == 0
    turn = np.array([(0, 1), (1, 0), (3, 2), (2, 3)], float)
    assert S.shortest_side(turn) == pytest.approx(2**0.5)


def test_observation_and_zone(spark):
    rows = spark.createDataFrame([("a", 2.0, 1, 0.5, False), ("a", 3.0, 1, 0.9, False), ("b", 4.0, 1, 0.5, False), ("b", 9.0, 2, 0.5, False), ("c", 1.0, 1, 0.5, True)], "s string, v double, p int, c double, predicted boolean")
    got = {r["s"]: (r["v"], r["missing_reason"]) for r in FT.choose_observation(rows, "s", "v", "p", "c").collect()}
    assert got == {"a": (None, "ambiguous"), "b": (4.0, None), "c": (None, "source_value_missing")}
    zones = spark.createDataFrame([("a", "U", 0.50), ("a", "N", 0.46), ("b", "U", 0.6), ("b", "N", 0.4)], "s string, z string, share double")
    assert {r["s"]: r["dominant"] for r in FT.dominant_share(zones, "s", "z", "share", 0.05).collect()} == {"a": None, "b": "U"}
    assert {r["s"]: r["dominant"] for r in FT.dominant_share(zones, "s", "z", "share", 0.0).collect()} == {"a": "U", "b": "U"}


def test_upsert(spark):
    new = spark.createDataFrame([(1, "n", None), (2, "n", "x")], "k int, a string, b string")
    old = spark.createDataFrame([(1, "o", "keep"), (3, "o", "y")], "k int, a string, b string")
    got = sorted(tuple(r) for r in RL.keep_latest(new, old, ["k"], ["a"], ["b"]).collect())
    assert got == [(1, "n", "keep"), (2, "n", "x"), (3, "o", "y")]


def test_sources(spark, tmp_path):
    lots = tmp_path / "lots.csv"
    lots.write_text("id_mutation,date_mutation,nature_mutation,valeur_fonciere,code_commune,id_parcelle,type_local,surface_reelle_bati,surface_terrain,nature_culture\n2024-1,2024-05-15,Vente,300000,35000,35000000AA0001,Maison,110,400,sols\n2024-2,,Vente,,35000,,,,0,\n")
    got = files.read_lots(spark, str(lots)).orderBy("sale_id").collect()
    assert (got[0]["value_eur"], got[0]["built_m2"], got[1]["mutation_date"], got[1]["parcel_id"]) == (300000.0, 110.0, None, None)
    arch = tmp_path / "a.txt"
    arch.write_text("No disposition|Date mutation|Nature mutation|Valeur fonciere|Code departement|Code commune|Prefixe de section|Section|No plan|1er lot|Type local|Surface reelle bati|Nombre pieces principales|Surface terrain\n1|05/03/2016|Vente|185000,00|35|51||A|12||Maison|90|4|300\n1|bad|Vente|0,00|35|51||AB|||Maison|90|4|300\n1|05/03/2016|Vente|1,00|22|51||A|1||Maison|90|4|300\n")
    got = files.read_archive(spark, str(arch), "35").collect()
    assert [(r["parcel_id"], r["value_eur"], r["mutation_date"]) for r in got] == [("350510000A0012", 185000.0, date(2016, 3, 5)), (None, None, None)]
    rnb = tmp_path / "rnb.csv"
    rnb.write_text('rnb_id;ext_ids;addresses;plots\nX1;"[{""id"": ""b"", ""source"": ""s""}]";;"[{""id"": ""35001000AA0001"", ""bdg_cover_ratio"": 0.5}]"\nX2;nope;;\n')
    got = {r["rnb_id"]: r for r in files.read_buildings(spark, str(rnb)).collect()}
    assert got["X1"]["plots"][0]["bdg_cover_ratio"] == 0.5 and got["X1"]["unparsed"] == []
    assert got["X2"]["unparsed"] == ["ext_ids"]
    with pytest.raises(ValueError, match="columns missing"):
        files.read_cube(spark, str(lots))
    geo = tmp_path / "g.json"
    geo.write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": "p1", "contenance": 12}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}')
    row = files.read_features(spark, str(geo)).first()
    assert row["properties"]["id"] == "p1" and len(row["rings"][0]) == 4
    out = tmp_path / "facts"
    files.publish(spark.createDataFrame([(1, "r1"), (2, "r2")], "v int, release_id string"), str(out))
    files.publish(spark.createDataFrame([(3, "r2")], "v int, release_id string"), str(out))
    assert sorted(r["v"] for r in spark.read.parquet(str(out)).collect()) == [1, 3]
    with pytest.raises(ValueError, match="not publishable"):
        files.write_measure(spark.range(1).withColumn("parcel_id", F.lit("x")), str(tmp_path / "m"), ["parcel_id"], ["parcel_id"])


def test_risk_pages(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"data": [{"code_insee": "35001", "risques_detail": [{"num_risque": "11", "libelle_risque_long": "Inondation"}, {"num_risque": "15"}]}, {"code_insee": "35002"}]}')
    got = sorted(tuple(r)[0:1] + tuple(r)[3:] for r in files.read_risk_pages(spark, str(tmp_path)).collect())
    assert got[:2] == [("35001", "11", "Inondation"), ("35001", "15", None)] and got[2][0] == "35002"


def test_projection_and_back(spark):
    df = spark.createDataFrame([(-1.68, 48.11), (3.0, 46.5), (7.75, 43.7)], "lon double, lat double")
    x, y = G.lambert93(F.col("lon"), F.col("lat"))
    lon, lat = G.lambert93_inverse(F.col("x"), F.col("y"))
    for r in df.withColumns({"x": x, "y": y}).withColumns({"lon2": lon, "lat2": lat}).collect():
        assert abs(r["lon"] - r["lon2"]) < 1e-9 and abs(r["lat"] - r["lat2"]) < 1e-9


def test_dictionary_and_missing_sources(spark, tmp_path):
    (tmp_path / "d.csv").write_text("COD_VAR;COD_MOD;LIB_VAR;LIB_MOD\nOCS;DW_MAIN;x;main\nOCS;_T;x;all\n")
    assert {tuple(r) for r in files.read_dictionary(spark, str(tmp_path / "d.csv")).collect()} == {("OCS", "DW_MAIN", "main"), ("OCS", "_T", "all")}
    (tmp_path / "bad.csv").write_text("A;B\n1;2\n")
    with pytest.raises(ValueError):
        files.read_dictionary(spark, str(tmp_path / "bad.csv"))


def test_union_areas_against_unit_squares(spark):
    import random

    rnd = random.Random(3)
    rows = [(k % 4 if k % 4 else None, [rnd.randrange(20), rnd.randrange(20)], [rnd.randrange(6), rnd.randrange(6)]) for k in range(60)] + [(9, [1, 1], [0, 5])]
    df = spark.createDataFrame([(k, (float(x), float(y), float(x + w), float(y + h))) for k, (x, y), (w, h) in rows], "k int, b struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    covered = {}
    for k, (x, y), (w, h) in rows:
        covered.setdefault(k, set()).update((i, j) for i in range(x, x + w) for j in range(y, y + h))
    assert {r["k"]: r["union_area"] for r in S.union_areas(df, "k", "b").collect()} == {k: float(len(v)) for k, v in covered.items()}


def test_features_of_every_geometry(spark, tmp_path):
    square = "[[0, 0], [1, 0], [1, 1], [0, 0]]"
    cases = [
        ("Polygon", f"[{square}, {square}]"), ("MultiPolygon", f"[[{square}], [{square}]]"), ("Point", "[2.5, 48]"), ("LineString", "[[0, 0], [1, 1]]"),
        ("Polygon", "[[[0, 0], [1, 0]]]"), ("Point", "[]"), ("Polygon", '"x"'),
    ]
    features = [f'{{"type": "Feature", "properties": {{"id": "{k}"}}, "geometry": {{"type": "{t}", "coordinates": {c}}}}}' for k, (t, c) in enumerate(cases)]
    features.append('{"type": "Feature", "properties": {"id": "7"}, "geometry": null}')
    (tmp_path / "g.json").write_text('{"type": "FeatureCollection", "features": [\n' + ",\n".join(features) + "\n]}\n")
    frames = [{r["properties"]["id"]: r for r in files.read_features(spark, str(tmp_path / "g.json"), by_line).collect()} for by_line in (False, True)]
    assert frames[0] == frames[1]
    got = frames[0]
    assert [got[str(k)]["unread"] for k in range(8)] == [None, None, None, "geometry_type_unsupported", *["coordinates_unreadable"] * 3, "geometry_missing"]
    assert (len(got["0"]["rings"]), len(got["0"]["polygons"]), len(got["1"]["polygons"]), got["2"]["x"], got["2"]["y"]) == (2, 1, 2, 2.5, 48.0)


def test_diagnostics_and_addresses(spark, tmp_path):
    (tmp_path / "d.csv").write_text('\ufeffnumero,label,note,more\n1,A,"two\nlines, and a ""quote""",x\n2,B,,y\n', encoding="utf-8")
    got = files.read_diagnostics(spark, str(tmp_path / "d.csv"), ["numero", "label", "note"]).orderBy("numero").collect()
    assert [tuple(r) for r in got] == [("1", "A", 'two\nlines, and a "quote"'), ("2", "B", None)]
    with pytest.raises(ValueError, match="absent"):
        files.read_diagnostics(spark, str(tmp_path / "d.csv"), ["numero", "absent"])
    (tmp_path / "a.csv").write_text("id;numero;nom_voie;code_postal;code_insee;nom_commune;x;y;cad_parcelles\n1;2;rue A;35000;35238;Rennes;351000.5;x;P1|P2|\n2;;rue B;35000;35238;Rennes;1;2;\n")
    got = files.read_addresses(spark, str(tmp_path / "a.csv")).orderBy("id").collect()
    assert [(r["x"], r["y"], r["parcels"]) for r in got] == [(351000.5, None, ["P1", "P2"]), (1.0, 2.0, [])]


def test_cube_and_measure_file(spark, tmp_path):
    (tmp_path / "c.csv").write_text("GEO;GEO_OBJECT;OBS_VALUE\n35001;COM;12.5\n35;DEP;9\n35002;COM;s\n")
    cube = files.read_cube(spark, str(tmp_path / "c.csv"))
    assert sorted((r["GEO"], r["OBS_VALUE"]) for r in cube.collect()) == [("35001", 12.5), ("35002", None)]
    files.write_measure(cube, str(tmp_path / "m"), ["GEO", "OBS_VALUE"], ["GEO"])
    parts = list((tmp_path / "m").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text().split() == ["GEO,OBS_VALUE", "35001,12.5", "35002,"]


def test_frontage_against_points_along_the_boundary(spark):
    import random

    import numpy as np

    rnd, point = random.Random(8), lambda: (rnd.uniform(0, 30), rnd.uniform(0, 30))
    square = [(5.0, 5.0), (15.0, 5.0), (15.0, 15.0), (5.0, 15.0)]
    rings = {0: [(5.0, 5.0), (20.0, 8.0), (17.0, 20.0), (9.0, 12.0), (2.0, 18.0)], 1: square, 2: square, 3: square}
    roads = {0: [(point(), point()) for _ in range(6)], 1: [((0.0, 3.0), (30.0, 3.0)), ((0.0, 2.5), (12.0, 2.5))], 2: [((5.0, 5.0), (5.0, 5.0))], 3: [((90.0, 0.0), (90.0, 9.0))]}
    rows = [(k, [*ring, ring[0]], (a, b)) for k, ring in rings.items() for a, b in roads[k]]
    xy = "struct<x:double,y:double>"
    df = spark.createDataFrame(rows, f"k int, ring array<{xy}>, road struct<a:{xy},b:{xy}>")
    got = {r["k"]: r["frontage"] for r in S.frontages(df, "k", "ring", "road", 3.0).collect()}
    for k, ring in rings.items():
        want = 0.0
        for p, q in zip(ring, ring[1:] + ring[:1]):
            at = np.array(p) + (np.arange(20_000)[:, None] + 0.5) / 20_000 * (np.array(q) - np.array(p))
            hit = np.zeros(len(at), bool)
            for a, b in roads[k]:
                d = np.array(b) - np.array(a)
                t = np.clip(((at - a) @ d) / max(d @ d, 1e-300), 0, 1)
                hit |= np.hypot(*(at - a - t[:, None] * d).T) <= 3
            want += hit.mean() * np.hypot(*(np.array(q) - np.array(p)))
        assert got[k] == pytest.approx(want, abs=0.01), k
    assert got[3] == 0.0
