"""Country and district layers on hand-made rows in the shapes of their sources."""

import math

import pytest
from pyspark.sql import functions as F

from panelweave.operators import spatial
from panelweave.plans import country_layers as cl
from panelweave.plans import district_layers as dl
from panelweave.plans import panel as pn
from tests.test_spatial import geometry, square


def table(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_income_matrix(frame):
    sheet = frame("iso3 string, FY89 string, FY90 string, FY05 string", ("AAA", "L", "..", "LM*"), ("BBB", " UM ", "", None), ("", "L", "L", "L"))
    out = cl.income_classes(sheet, {"FY89": 1987, "FY90": 1988, "FY05": 2003})
    got = {(r["iso3"], r["fiscal_year"], r["data_year"], r["income_group"], r["raw_code"]) for r in out.collect()}
    assert got == {("AAA", 1989, 1987, "L", "L"), ("AAA", 1990, 1988, "NA", ".."), ("AAA", 2005, 2003, "LM", "LM*"), ("BBB", 1989, 1987, "UM", "UM")}
    with pytest.raises(Exception, match="income code"):
        cl.income_classes(frame("iso3 string, FY89 string", ("AAA", "Q")), {"FY89": 1987}).collect()


def test_price_sheets(frame):
    header = {"c1": {"name": "Lamb **", "unit": "($/kg)"}, "c2": {"name": "Rice, Thai 5%", "unit": "($/mt)"}}
    real_header = {"c1": {"name": "Lamb", "unit": "($/kg)"}, "c2": {"name": "MUV Index", "unit": "(index)"}}
    nominal = cl.price_sheet(frame("year int, c1 string, c2 string", (2000, "1.0", "…"), (2001, "2.0", "10"), (2002, "..", "20")), header)
    real = cl.price_sheet(frame("year int, c1 string, c2 string", (2000, "1.5", "100"), (2001, "2.5", "101")), real_header)
    got = table(cl.prices(nominal, real), "commodity_code", "year")
    assert got["lamb", 2001]["dlog_price"] == pytest.approx(math.log(2)) and got["lamb", 2001]["price_real"] == 2.5
    assert got["rice_thai_5", 2002]["dlog_price"] == pytest.approx(math.log(2)) and got["rice_thai_5", 2001]["dlog_price"] is None
    assert got["muv_index", 2000]["unit"] == "index" and got["muv_index", 2000]["price"] is None
    with pytest.raises(Exception, match="not a number"):
        cl.price_sheet(frame("year int, c1 string, c2 string", (2000, "oops", "1")), header).collect()


def test_coups(frame):
    slots = frame("country string, year string, coup1 string, coup2 string", ('"Chad"', "1990", "1", "2"), ('"Chad"', "1991", "0", ""), ('"Tchad"', "1990", "2", "0"), ('"Zanzibar"', "1964", "2", None))
    xw = frame("country string, iso3 string", ("Chad", "TCD"), ("Tchad", "TCD"))
    got = [tuple(r) for r in cl.coup_counts(slots, xw, ["coup1", "coup2"], (1989, 2025)).collect()]
    assert got == [("TCD", 1990, 3, 2, 1)]
    with pytest.raises(Exception, match="unmapped row"):
        cl.coup_counts(slots, xw, ["coup1", "coup2"], (1950, 2025)).collect()
    with pytest.raises(Exception, match="unexpected coup1"):
        cl.coup_counts(frame("country string, year string, coup1 string", ("Chad", "1990", "3")), xw, ["coup1"], (1989, 2025)).collect()


def test_indicators(frame):
    records = frame("column string, iso3 string, year int, value double", ("wb_a", "AAA", 2000, 1.0), ("wb_b", "AAA", 2000, None), ("wb_a", "WLD", 2000, 5.0), ("wb_a", "A1", 2000, 5.0), ("wb_b", "BBB", 1900, 1.0), ("wb_b", "BBB", 2001, 2.0))
    out = cl.indicators(records, ["wb_a", "wb_b", "wb_c"], frame("iso3 string", ("WLD",)), (1989, 2025))
    assert {tuple(r) for r in out.collect()} == {("AAA", 2000, 1.0, None, None), ("BBB", 2001, None, 2.0, None)}


def test_colonial(frame):
    names = [f"`col.{p}` int, `colstart.{p}_mean` double, `colend.{p}_mean` double" for p in cl.POWER_NAMES]
    def row(iso, **held):
        out = [iso]
        for p in cl.POWER_NAMES:
            a, b = held.get(p, (None, None))
            out += [int(p in held), a, b]
        return tuple(out)
    coldat = frame("iso3 string, " + ", ".join(names), row("AAA", britain=(1900.0, 1960.0), france=(1890.0, 1955.0)), row("BBB"))
    codes = frame("iso3 string, ccodecow int, ht_colonial int, lp_legor int", ("AAA", 10, 5, 1), ("BBB", 11, 0, None), ("CCC", 12, 6, None), ("ERI", 13, 5, None))
    spells = frame("ccode int, styear int, endyear int", (10, 1960, 2016), (10, 1900, 1920), (12, 1961, 2016), (12, 1970, 2016))
    ind = cl.independence(spells, codes.select("ccodecow", "iso3"), frame("iso3 string, independence_year int", ("AAA", 1980)))
    out = cl.colonial(coldat, codes, ind, {"British": "English", "French": "French"}, frame("iso3 string, legal_origin string", ("ERI", "French"), ("AAA", "German")), ["English"])
    got = table(out, "iso3")
    a = got["AAA"]
    assert (a["coldat_colonizer_last"], a["coldat_n_colonizers"], a["col_start_year"], a["col_duration_years"], a["independence_year"]) == ("British", 2, 1890.0, 70.0, 1980)
    assert (a["legal_origin_filled"], a["legal_origin_imputed"], a["civil_vs_common"], a["col_british"]) == ("English", 0, "common", 1)
    assert got["BBB"]["coldat_colonizer_last"] == "None" and got["BBB"]["col_ever_colonized"] == 0 and got["BBB"]["civil_vs_common"] is None
    assert got["CCC"]["independence_year"] == 1970 and got["CCC"]["legal_origin_filled"] == "French" and got["CCC"]["col_french"] == 1
    assert got["ERI"]["legal_origin_filled"] == "French" and got["ERI"]["legal_origin_imputed"] == 1


def test_fiscal(frame):
    raw = frame("ISO string, Country string, Year int, `General (=1 if General)` double, Taxes string, Caution1 string, Caution2 string",
                ("EST", "Estonia", 2000, 1.0, "0.2", "", "1"), ("ETH", "Estonia", 1980, 1.0, "0.9", None, None), ("ETH", "Ethiopia", 2000, None, "x", "bad", "0"), (None, "?", 2000, 1.0, "0.1", "0", "0"))
    out = cl.fiscal(raw, {"Taxes": "grd_tax_pct_gdp"}, "General (=1 if General)", ["Caution1", "Caution2"], frame("ISO string, Country string", ("ETH", "Estonia")))
    assert {tuple(r) for r in out.collect()} == {("EST", 2000, "general", 20.0, 1), ("ETH", 2000, "central", None, 0)}


def test_regime(frame):
    scores = frame("ccode int, year int, polity2 int", (625, 2011, -2), (626, 2011, -4), (626, 2012, 8), (530, 1993, None), (999, 2000, 1), (625, 1980, 3))
    bridge = frame("ccode int, iso3 string", (625, "SDN"), (626, "SSD"), (530, "ETH"))
    pol = cl.polity(scores, bridge, frame("ccode int, iso3 string", (626, "SDN")), (1989, 2025))
    assert {tuple(r) for r in pol.collect()} == {("SDN", 2011, -4.0, 1.0), ("SDN", 2012, 8.0, 0.0), ("ETH", 1993, None, None)}
    vdem = frame("country_text_id string, year int, " + ", ".join(f"{c} double" for c in cl.REGIME_COLUMNS), ("SDN", 2011, *[0.1] * 6), ("TCD", 2011, *[0.2] * 6))
    got = table(cl.regime(vdem, pol, (1989, 2025)), "iso3", "year")
    assert len(got) == 4 and got["SDN", 2011]["vdem_regime"] == 0.1 and got["TCD", 2011]["polity2"] is None


def test_repression(frame):
    raw = frame("WordBank_Code_A string, Year int, PTS_A string, PTS_S string, PTS_H string",
                ("ZAR", 2000, "3", "NA", "5"), ("AAA", 2000, None, None, None), ("AAA", 2000, None, "2", None), (None, 2000, "1", "1", "1"), ("AAA", 1970, "1", "1", "1"))
    got = table(cl.repression(raw, {"ZAR": "COD"}, (1989, 2025)), "iso3", "year")
    assert (got["COD", 2000]["pts_score"], got["COD", 2000]["pts_source"]) == (3.0, "A")
    assert (got["AAA", 2000]["pts_score"], got["AAA", 2000]["pts_source"]) == (2.0, "S") and len(got) == 2


def test_displacement(frame):
    unhcr = frame("coo_iso string, year string, " + ", ".join(f"{c} string" for c in cl.REFUGEE_COLUMNS), ("AAA", "2000", "0", "-", "", "5", None), ("", "2000", *["1"] * 5), ("AAA", "1950", *["1"] * 5))
    idmc = frame("ISO3 string, Year int, " + ", ".join(f"`{c}` double" for c in cl.INTERNAL_COLUMNS), ("AAA", 2000, 1.0, None, 2.0, 3.0), ("BBB", 2010, None, 1.0, None, None))
    got = table(cl.displacement(unhcr, idmc, (1989, 2025)), "iso3", "year")
    a = got["AAA", 2000]
    assert (a["refugees_origin"], a["asylum_seekers_origin"], a["idp_stock_unhcr"], a["returned_refugees"], a["new_disp_disaster"]) == (0.0, None, None, 5.0, 3.0)
    assert set(got) == {("AAA", 2000), ("BBB", 2010)}


PROD = "`Area Code` string, `Area Code (M49)` string, `Item Code` int, `Item Code (CPC)` string, Item string, `Element Code` int, Year int, Unit string, Value string"


def test_production(frame):
    raw = frame(PROD, ("10", "'736", 56, "'0112", "Maize", 5510, 2000, "t", "7"), ("10", "'736", 56, "'0112", "Maize", 5412, 2000, "kg/ha", "900"),
                ("10", "'736", 1717, "'F1717", "Cereals", 5312, 2000, "ha", "3"), ("10", "'736", 1717, "'F1717", "Cereals", 5510, 2000, "t", "9"),
                ("10", "'736", 999, "'2111", "Meat", 5510, 2000, "t", "9"), ("5000", "'001", 56, "'0112", "Maize", 5510, 2000, "t", "70"), ("10", "'736", 56, "'0112", "Maize", 1, 2000, "x", "7"))
    xw = frame("m49 int, iso3 string", (736, "SDN"), (729, "SDN"))
    long = cl.production_long(raw, xw)
    assert long.count() == 5 and {r["item"] for r in long.filter("is_aggregate = 1").collect()} == {"Cereals"}
    wide = cl.production_wide(long).first()
    assert (wide["fao_maize_prod_t"], wide["fao_maize_yield_kgha"], wide["fao_cereal_area_ha"], wide["fao_cereal_prod_t"], wide["fao_rice_prod_t"]) == (7.0, 900.0, 3.0, 9.0, None)
    assert len(cl.production_wide(long).columns) == 2 + 25
    assert cl.crop_rows(raw, (1961, 2024)).count() == 3
    with pytest.raises(Exception, match="unit"):
        cl.production_long(frame(PROD, ("10", "'736", 56, "'0112", "Maize", 5412, 2000, "hg/ha", "1")), xw).collect()


def two_districts(frame):
    return geometry(frame, {"a": [(False, square(0, 0, 1, 1))], "b": [(False, square(1, 0, 2, 1))]}).withColumnRenamed("id", "district_id")


def test_fatal_events(frame):
    events = frame("id int, year int, type_of_violence int, where_prec int, longitude double, latitude double, best int, low int, high int, deaths_civilians int",
                   (1, 2000, 1, 1, 0.5, 0.5, 5, 4, 6, 1), (2, 2000, 3, 3, 0.5, 0.6, 1, 1, 1, 1), (3, 2000, 1, 4, 0.5, 0.5, 99, 9, 9, 9), (4, 2000, 2, 1, 9.0, 9.0, 3, 3, 3, 0), (5, 2001, 2, 2, 1.5, 0.5, 2, 2, 2, 0))
    long, wide = dl.fatal_events(events, two_districts(frame), 0.5)
    got = table(wide, "district_id", "year")
    assert set(got) == {("a", 2000), ("b", 2001)} and len(wide.columns) == 2 + 20
    a = got["a", 2000]
    assert (a["n_events_sb"], a["n_events_os"], a["n_events_ns"], a["n_events_total"], a["deaths_best_total"], a["deaths_civilians_total"]) == (1, 1, 0, 2, 6, 2)
    assert long.count() == 3


def test_unrest_events(frame):
    raw = frame("event_id_cnty string, event_date string, event_type string, iso string, latitude string, longitude string, geo_precision string, fatalities string",
                ("e1", "2018-05-01", "Battles", "AAA", "0.5", "0.5", "1", "3"), ("e1", "2018-05-01", "Battles", "AAA", "0.5", "0.5", "1", "3"),
                ("e2", "2018-06-01", "Riots", "AAA", "0.5", "0.5", "2", "0"), ("e3", "2020-01-01", "Riots", "AAA", "0.5", "0.5", "3", "0"))
    events = dl.tidy_unrest(raw)
    assert events.count() == 3
    wide, span = dl.unrest_events(events, two_districts(frame), 0.5)
    r = wide.first()
    assert (r["acled_events_total"], r["acled_events_battles"], r["acled_events_riots"], r["acled_events_vac"], r["acled_fatalities"]) == (2, 1, 1, 0, 3)
    assert tuple(span.first()) == ("AAA", 2018, 2020)


def test_pests(frame):
    traps = frame("id int, date string, lat string, long string, faw_confirmed_count string, faw_suspected_plus_confirmed_count string",
                  (1, "2019-03-01", "0.5", "0.5", "4", "6"), (2, "2019-04-01", "0.5", "0.5", "x", "1"), (3, "bad", "0.5", "0.5", "1", "1"), (4, "2020-01-01", None, "0.5", "1", "1"))
    r = dl.traps(traps, two_districts(frame), 1.0).collect()
    assert [tuple(x) for x in r] == [("a", 2019, 2, 4.0, 7.0, 1, 2.0)]
    swarm = frame("category string, lat double, lon double, start_date string, area_treated_in_ha string", ("SWARM", 0.5, 1.5, "2020-02-01", "10"))
    band = frame("category string, lat double, lon double, start_date string", ("BAND", 0.5, 1.5, "2020-03-01"))
    x = dl.swarms([swarm, band], two_districts(frame), 1.0).first()
    assert (x["district_id"], x["year"], x["dl_swarm_obs"], x["dl_band_obs"], x["dl_gregarious_obs"], x["dl_area_treated_ha"]) == ("b", 2020, 1, 1, 2, 10.0)


def test_rasters(frame):
    geom = two_districts(frame)
    weights = spatial.coverage_weights(geom, "district_id", 0.5)
    rain = frame("cx bigint, cy bigint, year int, value double", *[(i, j, 2000, float(i)) for i in range(4) for j in range(2)])
    assert {r["district_id"]: r["precip_mm"] for r in dl.rain(rain, weights).collect()} == {"a": pytest.approx(0.5), "b": pytest.approx(2.5)}
    crops = frame("cx bigint, cy bigint, year int, crop string, value double", (0, 0, 2000, "maize", 2.0), (0, 1, 2000, "rice", 3.0), (0, 0, 2001, "rice", None))
    got = dl.yields(crops, weights, 50.0).collect()
    assert [(r["yield_maize"], r["yield_rice"], r["yield_wheat"]) for r in got] == [(2.0, 3.0, None)]
    with pytest.raises(Exception, match="plausible"):
        dl.yields(crops, weights, 1.0).collect()
    temps = frame("cx bigint, cy bigint, year int, value double", *[(0, 0, 1989 + i, 20.0 + i + m) for i in range(8) for m in (0.0, 1.0)])
    out = table(dl.temperature(temps, weights, (1989, 1994)), "year")
    assert out[1989]["temp_mean"] == pytest.approx(20.5) and out[1996]["temp_anomaly"] == pytest.approx((27.5 - 23.0) / 1.8708286934)


def test_excluded_groups(frame):
    overlay = frame("district_id string, district_area double, gwgroupid int, `from` int, `to` int, area double",
                    ("a", 1.0, 1, 1980, 2000, 0.7), ("a", 1.0, 2, 1990, 2030, 0.6), ("a", 1.0, 3, 2000, 2000, 0.1))
    status = frame("gwgroupid int, `from` int, `to` int, status string", (1, 1946, 2025, "powerless"), (2, 1946, 2025, " Discriminated "), (3, 1946, 2025, "MONOPOLY"))
    got = table(dl.excluded_groups(overlay, status, 1999, 2001), "year")
    assert got[2000]["share_area_excluded"] == 1.0 and got[2000]["share_excluded_raw"] == pytest.approx(1.3)
    assert got[2000]["n_groups_overlap"] == 3 and got[2001]["n_groups_overlap"] == 1 and got[2001]["ethnic_fractionalization"] == pytest.approx(0)
    twice = status.union(status)
    with pytest.raises(Exception, match="duplicate key"):
        dl.excluded_groups(overlay, twice, 1999, 2001).collect()


def test_sites(frame):
    sites = frame("LOCDER string, longitude double, latitude double, commod1 string, commod2 string", ("D2; A", 0.1, 0.1, "Gold", None), ("A1", 0.10001, 0.10001, "Gold", "x"), ("A1", 0.10002, 0.1, "gold ore", "Gold"), (None, 0.9, 0.9, "Iron", "Silver, Gold"))
    assert dl.precise_sites(sites).count() == 3
    assert dl.gold_sites(sites, ["commod1", "commod2"], whole=True).count() == 1
    assert dl.gold_sites(sites, ["commod1", "commod2"], whole=False).count() == 4
    fields = frame("RESINFO string", ("Oil",), ("oil and gas",), ("Gas",))
    flags = dl.oil_and_gas(fields)
    assert [tuple(r) for r in fields.select(*[v.alias(k) for k, v in flags.items()]).collect()] == [(True, False), (True, True), (False, True)]


def test_panel_from_layers(frame):
    spine = frame("district_id string, iso3 string", ("a", "AAA"), ("b", "AAA"), ("c", "BBB"))
    layers = [
        pn.Layer("fatal", frame("district_id string, year int, n bigint", ("a", 2000, 2)), "district_year", policy="zero"),
        pn.Layer("coups", frame("iso3 string, year int, coups bigint", ("AAA", 2001, 1)), "country_year", policy="zero"),
        pn.Layer("wdi", frame("iso3 string, year int, wb double", ("BBB", 2000, 9.0)), "country_year"),
        pn.Layer("unrest", frame("district_id string, year int, u double", ("b", 2000, 3.0)), "district_year", policy="mask", span=frame("iso3 string, first_year int, last_year int", ("AAA", 2000, 2000))),
        pn.Layer("crop", frame("district_id string, ha double", ("a", 5.0)), "district"),
        pn.Layer("colony", frame("iso3 string, col string", ("BBB", "x")), "country"),
    ]
    p = pn.assemble(spine, 2000, 2001, layers)
    got = table(p, "district_id", "year")
    assert p.columns == ["district_id", "iso3", "year", "n", "coups", "wb", "u", "ha", "col"] and len(got) == 6
    assert tuple(got["a", 2000])[3:] == (2, 0, None, 0.0, 5.0, None)
    assert tuple(got["b", 2001])[3:] == (0, 1, None, None, None, None)
    assert tuple(got["c", 2000])[3:] == (0, 0, 9.0, None, None, "x")
    assert {r["status"] for r in pn.integrity(p, spine, 2000, 2001).collect()} == {"PASS"}
    assert {r["status"] for r in pn.integrity(p.filter("year = 2000"), spine, 2000, 2001).collect()} == {"PASS", "FAIL"}
    more = pn.enrich(p, [pn.Layer("fiscal", frame("iso3 string, year int, tax double", ("AAA", 2000, 1.0)), "country_year"), pn.Layer("regime", frame("iso3 string, year int, pol double", ("BBB", 2001, 2.0)), "country_year")])
    assert more.count() == 6 and table(more, "district_id", "year")["c", 2001]["pol"] == 2.0
    with pytest.raises(ValueError, match="missing"):
        pn.ordered_panel(p, ["district_id", "zzz"])
    with pytest.raises(ValueError, match="grain"):
        pn.Layer("x", spine, "planet")


def test_regions_and_arrival(frame):
    xw = frame("iso3 string, continent string, unregion string", ("AAA", "Africa", "Eastern Africa"), ("BBB", "America", "South America"))
    regions = pn.regions(xw, ["Africa"])
    assert {(r["iso3"], r["region"], r["kept"]) for r in regions.collect()} == {("AAA", "Africa", True), ("BBB", "South America", False)}
    panel = frame("district_id string, iso3 string, year int", *[("a", "AAA", y) for y in (2019, 2020)], ("b", "BBB", 2019), ("c", "AAA", 2020))
    study = pn.study_subset(panel, regions)
    assert study.count() == 3
    seen = frame("district_id string, year int, n int", ("a", 2020, 3), ("a", 2018, 0), ("c", 2026, 5))
    first = pn.arrival(seen, F.col("n") > 0, 2025, "first")
    out = table(pn.arrival_clock(pn.enrich(study, [pn.Layer("faw", first, "district")]), "first", "since", "arrived"), "district_id", "year")
    assert (out["a", 2019]["since"], out["a", 2019]["arrived"], out["a", 2020]["arrived"]) == (-1.0, 0.0, 1.0)
    assert out["c", 2020]["first"] is None and out["c", 2020]["arrived"] is None
    masked = pn.mask_region(study.withColumn("v", F.lit(1)), "South America", ["v"])
    assert masked.filter("v is not null").count() == 0
