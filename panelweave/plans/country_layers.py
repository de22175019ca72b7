"""Country-year and country layers from their sources' tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.functions import dates, numeric, text
from panelweave.operators import joins, reshape, select, series
from panelweave.sources import contracts, readers

KEY = ["iso3", "year"]

# fixed values: income class vocabulary and the two footnoted codes
INCOME_CLASSES = ("L", "LM", "UM", "H")
INCOME_CODES = {"..": "NA", "LM*": "LM"}

# fixed values: text that stands for a missing price
PRICE_GAPS = ("…", "...", "..", "")

# fixed values: coded colonial power and legal origin
COLONIAL_POWER = {
    0: "None", 1: "Dutch", 2: "Spanish", 3: "Italian", 4: "US", 5: "British",
    6: "French", 7: "Portuguese", 8: "Belgian", 9: "British-French", 10: "Australian",
}
LEGAL_ORIGIN = {1: "English", 2: "French", 3: "Socialist", 4: "German", 5: "Scandinavian"}
POWER_NAMES = {
    "belgium": "Belgian", "britain": "British", "france": "French", "germany": "German",
    "italy": "Italian", "netherlands": "Dutch", "portugal": "Portuguese", "spain": "Spanish",
}
CURRENT_SPELL_END = 2016

# fixed values: regime source columns
REGIME_COLUMNS = {
    "v2x_polyarchy": "vdem_polyarchy", "v2x_libdem": "vdem_libdem", "v2x_rule": "vdem_rule_of_law",
    "v2xnp_regcorr": "vdem_corruption", "v2x_regime": "vdem_regime", "v2svstterr": "vdem_terr_control",
}

# fixed values: displacement source columns
REFUGEE_COLUMNS = {
    "refugees": "refugees_origin", "asylum_seekers": "asylum_seekers_origin", "idps": "idp_stock_unhcr",
    "returned_refugees": "returned_refugees", "returned_idps": "returned_idps",
}
INTERNAL_COLUMNS = {
    "Conflict Stock Displacement": "idp_stock_conflict", "Conflict Internal Displacements": "new_disp_conflict",
    "Disaster Stock Displacement": "idp_stock_disaster", "Disaster Internal Displacements": "new_disp_disaster",
}

# fixed values: crop production elements, group totals and staples by item code
ELEMENTS = {5510: ("Production", "t"), 5312: ("Area harvested", "ha"), 5412: ("Yield", "kg/ha")}
ITEM_GROUPS = {1717: "cereal", 1720: "roots_tubers", 1726: "pulses", 1735: "vegetables", 1738: "fruit", 1765: "meat_total", 1780: "milk_total"}
STAPLES = {15: "wheat", 27: "rice", 56: "maize", 79: "millet", 83: "sorghum", 125: "cassava", 176: "beans", 242: "groundnuts"}
REGION_CODE_FLOOR = 5000
CROP_PREFIX = "01"


def income_classes(sheet: DataFrame, header: Mapping[str, int]) -> DataFrame:
    """Fiscal-year matrix to (iso3, fiscal_year, data_year, income_group, raw_code).

    ``header`` maps a column label like ``FY89`` to its data year. An
    unclassified economy keeps the real category ``NA``.
    """
    attributes = {label: {"label": label, "data_year": year} for label, year in header.items()}
    long = readers.matrix_to_long(sheet.filter(F.trim("iso3") != ""), ["iso3"], attributes, "raw_code")
    raw = F.trim("raw_code")
    known = F.when(raw.isin(list(INCOME_CLASSES)), raw)
    coded = F.coalesce(known, reshape.map_codes(raw, INCOME_CODES), F.raise_error(F.concat(F.lit("income code "), raw)).cast("string"))
    return long.select(
        F.trim("iso3").alias("iso3"), dates.fiscal_year(F.col("label")).alias("fiscal_year"),
        F.col("data_year").cast("int").alias("data_year"), coded.alias("income_group"), raw.alias("raw_code"),
    )


def price_sheet(sheet: DataFrame, header: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One wide price sheet to (commodity_code, commodity_name, unit, year, value)."""
    long = readers.matrix_to_long(sheet, ["year"], header, "raw")
    gaps = F.trim("raw").isin([g for g in PRICE_GAPS if g])
    value = numeric.strict_number(F.when(~gaps, F.col("raw")))
    named = long.select(
        text.strip_footnote(F.col("name")).alias("commodity_name"), text.unwrap(F.col("unit")).alias("unit"),
        F.col("year").cast("int").alias("year"), value.alias("value"),
    )
    return text.with_slug(named, "commodity_name", "commodity_code")


def prices(nominal: DataFrame, real: DataFrame) -> DataFrame:
    """Nominal and real sheets side by side, metadata from the nominal one first."""
    key = ["commodity_code", "year"]
    both = joins.outer_merge(
        nominal.select(*key, F.col("value").alias("price")), real.select(*key, F.col("value").alias("price_real")), key
    )
    meta = ["commodity_code", "commodity_name", "unit"]
    described = select.prefer([nominal.select(*meta), real.select(*meta)], ["commodity_code"])
    return series.log_change(both.join(described, "commodity_code", "left"), ["commodity_code"], "price", "dlog_price")


def coup_counts(slots: DataFrame, crosswalk: DataFrame, columns: Sequence[str], window: tuple[int, int]) -> DataFrame:
    """Event slots per country-year to counts, names mapped, nothing in the window lost."""
    cells = {c: F.coalesce(numeric.strict_number(F.col(c), "int"), F.lit(0)) for c in columns}
    coded = slots.withColumns({**cells, "country": text.unquote(F.col("country")), "year": F.col("year").cast("int")})
    for c in columns:
        coded = contracts.require_values(coded, c, [0, 1, 2])
    counted = coded.select(
        "country", "year",
        reshape.row_count(columns, lambda x: x != 0).alias("coups_total"),
        reshape.row_count(columns, lambda x: x == 2).alias("coups_successful"),
        reshape.row_count(columns, lambda x: x == 1).alias("coups_failed"),
    ).filter("coups_total > 0")
    named = counted.join(joins.one_row_per(crosswalk.select("country", "iso3"), ["country"]), "country", "left")
    guarded = joins.guard_mapped(named, "iso3", F.col("year").between(*window), "coup countries")
    sums = [F.sum(c).alias(c) for c in ("coups_total", "coups_successful", "coups_failed")]
    return guarded.filter(F.col("iso3").isNotNull()).groupBy(*KEY).agg(*sums)


def indicators(records: DataFrame, columns: Sequence[str], aggregates: DataFrame, window: tuple[int, int]) -> DataFrame:
    """Indicator records to one wide country-year table; regional aggregates go."""
    economies = records.filter(F.col("iso3").rlike("^[A-Z]{3}$") & F.col("year").between(*window))
    kept = select.exclude_rows(economies, aggregates, ["iso3"])
    values = F.first("value", ignorenulls=True)  # one value per key: source keys are unique
    return joins.one_row_per(kept.select(*KEY, "column", "value"), [*KEY, "column"]).groupBy(*KEY).pivot("column", list(columns)).agg(values)


def last_powers(wide: DataFrame, powers: Mapping[str, str] = POWER_NAMES) -> DataFrame:
    """Per-power columns to the number of powers, span, and the last one to leave."""
    groups = {p: (f"col.{p}", f"colstart.{p}_mean", f"colend.{p}_mean") for p in powers}
    out = reshape.holders(groups)
    named = reshape.map_codes(out["holder_last"], {**powers, "None": "None"})
    return wide.select(
        "iso3", named.alias("coldat_colonizer_last"), out["n_holders"].alias("coldat_n_colonizers"),
        out["start_year"].alias("col_start_year"), out["end_year"].alias("col_end_year"), out["duration_years"].alias("col_duration_years"),
    )


def independence(spells: DataFrame, bridge: DataFrame, overrides: DataFrame) -> DataFrame:
    """Entry year of each country's current spell, contested cases overridden."""
    linked = spells.filter(F.col("endyear") == CURRENT_SPELL_END).join(bridge, F.col("ccode") == F.col("ccodecow"))
    current = linked.groupBy("iso3").agg(F.max("styear").alias("independence_year"))
    return joins.override_join(current, overrides, ["iso3"], "independence_year")


def colonial(coldat: DataFrame, codes: DataFrame, independent: DataFrame, legal_by_power: Mapping[str, str], legal_overrides: DataFrame, common_law: Sequence[str]) -> DataFrame:
    """Colonial legacy per country from three sources, gaps imputed and flagged."""
    base = codes.select(
        "iso3", reshape.map_codes(F.col("ht_colonial"), COLONIAL_POWER).alias("colonizer"),
        reshape.map_codes(F.col("lp_legor"), LEGAL_ORIGIN).alias("legal_origin"),
    )
    merged = joins.outer_merge(base, last_powers(coldat), ["iso3"]).join(independent, "iso3", "left")
    imputed = merged.withColumns(reshape.impute("legal_origin", "colonizer", legal_by_power))
    fix = legal_overrides.select("iso3", F.col("legal_origin").alias("_fix"))
    filled = F.when(F.col("legal_origin").isNull() & F.col("_fix").isNotNull(), F.col("_fix")).otherwise(F.col("legal_origin_filled"))
    fixed = imputed.join(fix, "iso3", "left").withColumn("legal_origin_filled", filled).drop("_fix")
    power, legal = F.col("colonizer"), F.col("legal_origin_filled")
    return fixed.withColumns({
        "col_ever_colonized": numeric.flag(power != "None"),
        "civil_vs_common": F.when(legal.isNotNull(), F.when(legal.isin(list(common_law)), "common").otherwise("civil")),
        "col_british": numeric.flag(power == "British"),
        "col_french": numeric.flag(power == "French"),
        "col_iberian": numeric.flag(power.isin("Spanish", "Portuguese")),
    })


def fiscal(raw: DataFrame, shares: Mapping[str, str], level: str, cautions: Sequence[str], quarantine: DataFrame) -> DataFrame:
    """Fiscal capacity in percent of output, with government level and a caution flag."""
    kept = select.exclude_rows(raw.na.drop(subset=["ISO", "Year"]), quarantine, ["ISO", "Country"])
    general = F.coalesce(F.col(f"`{level}`").try_cast("double"), F.lit(0.0)) == 1
    return kept.select(
        F.trim("ISO").alias("iso3"), F.col("Year").cast("int").alias("year"),
        F.when(general, "general").otherwise("central").alias("grd_gov_level"),
        *[numeric.percent(F.col(f"`{c}`").try_cast("double")).alias(n) for c, n in shares.items()],
        reshape.any_positive([f"`{c}`" for c in cautions]).alias("grd_quality_flag"),
    )


def polity(scores: DataFrame, bridge: DataFrame, overrides: DataFrame, window: tuple[int, int]) -> DataFrame:
    """Scores by state code to iso3; an override code wins an overlap year."""
    linked = (
        scores.filter(F.col("year").between(*window))
        .join(joins.one_row_per(bridge.select("ccode", F.col("iso3").alias("_b")), ["ccode"]), "ccode", "left")
        .join(overrides.select("ccode", F.col("iso3").alias("_o")), "ccode", "left")
    )
    coded = linked.select(
        F.coalesce("_o", "_b").alias("iso3"), "year", F.col("polity2").cast("double").alias("polity2"), F.col("_o").isNull().cast("int").alias("_late")
    ).filter(F.col("iso3").isNotNull())
    best = select.keep_one(coded, KEY, [F.col("_late")]).drop("_late")
    return best.withColumn("anocracy_flag", numeric.known_flag(F.abs("polity2") <= 5))


def regime(vdem: DataFrame, scores: DataFrame, window: tuple[int, int]) -> DataFrame:
    named = vdem.select(F.col("country_text_id").alias("iso3"), F.col("year").cast("int").alias("year"), *[F.col(c).alias(n) for c, n in REGIME_COLUMNS.items()])
    return joins.outer_merge(named.filter(F.col("year").between(*window)), scores, KEY)


def repression(raw: DataFrame, code_fixes: Mapping[str, str], window: tuple[int, int]) -> DataFrame:
    """Three repression scores, the first known of them and where it came from."""
    code = F.trim("WordBank_Code_A")
    number = {n: F.col(c).cast("string").try_cast("double") for c, n in (("PTS_A", "pts_amnesty"), ("PTS_S", "pts_state"), ("PTS_H", "pts_hrw"))}
    coded = raw.filter(F.col("Year").between(*window)).select(
        F.coalesce(reshape.map_codes(code, code_fixes), code).alias("iso3"), F.col("Year").cast("int").alias("year"), *[v.alias(n) for n, v in number.items()]
    ).filter(F.col("iso3").isNotNull())
    value, source = reshape.first_known({"pts_state": "S", "pts_amnesty": "A", "pts_hrw": "H"})
    scored = coded.withColumns({"pts_score": value, "pts_source": source})
    return select.keep_one(scored, KEY, [F.col("pts_score").isNull().cast("int")])


def displacement(refugees: DataFrame, internal: DataFrame, window: tuple[int, int]) -> DataFrame:
    """Refugee and internal displacement figures, full outer; a reported 0 stays 0."""
    def tidy(df: DataFrame, iso: str, year: str, columns: Mapping[str, str]) -> DataFrame:
        out = df.select(
            F.nullif(F.trim(iso), F.lit("")).alias("iso3"), F.col(year).cast("string").try_cast("int").alias("year"),
            *[F.col(f"`{c}`").cast("string").try_cast("double").alias(n) for c, n in columns.items()],
        )
        return out.na.drop(subset=KEY)

    both = joins.outer_merge(tidy(refugees, "coo_iso", "year", REFUGEE_COLUMNS), tidy(internal, "ISO3", "Year", INTERNAL_COLUMNS), KEY)
    return both.filter(F.col("year").between(*window))


def production_long(raw: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Production records to (iso3, year, item_code, item, element, unit, value, is_aggregate).

    ``crosswalk`` is (m49, iso3), a former state's code pointing at its
    successor. A unit other than the expected one fails the job.
    """
    element, unit = F.col("Element Code").cast("int"), F.col("Unit")
    wanted = reshape.map_codes(element, {c: u for c, (_, u) in ELEMENTS.items()})
    checked = F.when(unit.isNull() | (unit != wanted), F.raise_error(F.concat(F.lit("unit "), unit))).otherwise(unit)
    m49 = text.bare_code(F.col("Area Code (M49)")).try_cast("int")
    coded = raw.filter(element.isin(list(ELEMENTS))).select(
        m49.alias("m49"), F.col("Year").cast("int").alias("year"), F.col("Item Code").cast("int").alias("item_code"), F.col("Item").alias("item"),
        reshape.map_codes(element, {c: n for c, (n, _) in ELEMENTS.items()}).alias("element"), checked.alias("unit"), F.col("Value").cast("string").try_cast("double").alias("value"),
    )
    # the crosswalk holds a row per country code: a few hundred
    mapped = coded.join(crosswalk.select("m49", "iso3"), "m49").drop("m49")
    kept = select.keep_one(mapped, ["iso3", "year", "item_code", "element"], [F.col("value").isNull().cast("int")])
    return kept.withColumn("is_aggregate", numeric.flag(F.col("item_code").isin(list(ITEM_GROUPS))))


def crop_rows(raw: DataFrame, window: tuple[int, int]) -> DataFrame:
    """Crop records of countries: crop division codes only, regional aggregates out."""
    crop = F.startswith(text.bare_code(F.col("Item Code (CPC)")), F.lit(CROP_PREFIX))
    country = F.col("Area Code").cast("int") < REGION_CODE_FLOOR
    return raw.filter(crop & country & F.col("Year").cast("int").between(*window))


def production_wide(long: DataFrame) -> DataFrame:
    """Group totals, cereal area and yield, staples: one pivot, columns ``fao_*``."""
    item, element = F.col("item_code"), F.col("element")
    name = F.coalesce(reshape.map_codes(item, ITEM_GROUPS), reshape.map_codes(item, STAPLES))
    has_yield = item.isin(list(STAPLES)) | (item == 1717)
    column = (
        F.when(element == "Production", F.concat(name, F.lit("_prod_t")))
        .when((element == "Area harvested") & (item == 1717), F.concat(name, F.lit("_area_ha")))
        .when((element == "Yield") & has_yield, F.concat(name, F.lit("_yield_kgha")))
    )
    names = [f"{n}_prod_t" for n in ITEM_GROUPS.values()] + ["cereal_area_ha", "cereal_yield_kgha"]
    names += [f"{n}_prod_t" for n in STAPLES.values()] + [f"{n}_yield_kgha" for n in STAPLES.values()]
    picked = long.withColumn("_c", column).filter(F.col("_c").isNotNull())
    wide = picked.groupBy(*KEY).pivot("_c", names).agg(F.first("value", ignorenulls=True))
    return reshape.prefix_columns(wide, "fao_", KEY)
