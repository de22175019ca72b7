"""Layers onto a dense district x year frame, as one lazy plan.

Each layer is joined at the coarsest grain that holds it: constants onto the
spine before the years unfold, country-year layers onto a country x year
frame that then joins once, and only district-year layers onto the full
frame, all on the same hash key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions import numeric
from panelweave.operators import aggregate, checks, frame, joins, select, series

DISTRICT, COUNTRY, YEAR = "district_id", "iso3", "year"
GRAINS = {
    "district": [DISTRICT],
    "country": [COUNTRY],
    "country_year": [COUNTRY, YEAR],
    "district_year": [DISTRICT, YEAR],
}


@dataclass(frozen=True)
class Layer:
    """A keyed table, its grain, its columns and what an absent row means."""

    name: str
    data: DataFrame
    grain: str
    columns: Sequence[str] = field(default_factory=tuple)
    policy: str = "null"
    span: DataFrame | None = None  # (iso3, first_year, last_year) for policy "mask"
    checked: bool = False  # unique on its key by construction

    def __post_init__(self):
        if self.grain not in GRAINS:
            raise ValueError(f"{self.name}: unknown grain {self.grain}")
        if not self.columns:
            object.__setattr__(self, "columns", tuple(c for c in self.data.columns if c not in (DISTRICT, COUNTRY, YEAR)))

    def onto(self, base: DataFrame) -> DataFrame:
        return frame.attach(base, self.data, GRAINS[self.grain], self.columns, self.policy, self.span, COUNTRY, self.checked)


def assemble(spine: DataFrame, first: int, last: int, layers: Sequence[Layer]) -> DataFrame:
    """The panel: every spine row in every year with all layers attached."""
    named = spine
    for layer in layers:
        if layer.grain in ("district", "country"):
            named = layer.onto(named)
    panel = frame.dense_frame(named, first, last)
    for layer in layers:
        if layer.grain == "district_year":
            panel = layer.onto(panel)
    yearly = [layer for layer in layers if layer.grain == "country_year"]
    if yearly:
        national = frame.dense_frame(spine.select(COUNTRY).distinct(), first, last)
        for layer in yearly:
            national = layer.onto(national)
        panel = panel.join(national, [COUNTRY, YEAR], "left")
    order = [c for layer in layers for c in layer.columns]
    return panel.select(*spine.columns, YEAR, *order)


def enrich(panel: DataFrame, layers: Sequence[Layer]) -> DataFrame:
    """More layers onto a finished panel; country layers are merged first and join once."""
    out = panel
    for grain in ("district_year", "district", "country", "country_year"):
        chosen = [layer for layer in layers if layer.grain == grain]
        if grain == "country_year" and len(chosen) > 1:
            merged = panel.select(*GRAINS[grain]).distinct()
            for layer in chosen:
                merged = layer.onto(merged)
            out = out.join(merged, GRAINS[grain], "left")
            continue
        for layer in chosen:
            out = layer.onto(out)
    return out.select(*panel.columns, *[c for layer in layers for c in layer.columns])


def ordered_panel(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; a missing or extra one is an error."""
    lost, extra = set(columns) - set(panel.columns), set(panel.columns) - set(columns)
    if lost or extra:
        raise ValueError(f"panel columns: missing {sorted(lost)}, unexpected {sorted(extra)}")
    return panel.select(*columns)


def integrity(panel: DataFrame, spine: DataFrame, first: int, last: int) -> DataFrame:
    """Shape and key checks every finished panel must pass."""
    return checks.report(
        checks.unique_key(panel, "panel", "unique key", [DISTRICT, YEAR]),
        checks.balanced(panel, "panel", "every year per district", DISTRICT, first, last),
        checks.key_set_equals(panel, spine, "panel", "same districts as the spine", [DISTRICT]),
        checks.rows_hold(panel, "panel", checks.known_keys([DISTRICT, COUNTRY, YEAR])),
    )


def regions(crosswalk: DataFrame, keep: Sequence[str], split: str = "America") -> DataFrame:
    """Continent, except the sub-region inside ``split``; and whether it is kept."""
    region = F.when(F.col("continent") == split, F.col("unregion")).otherwise(F.col("continent"))
    return crosswalk.withColumn("region", region).withColumn("kept", F.col("region").isin(list(keep)))


def study_subset(panel: DataFrame, region_map: DataFrame) -> DataFrame:
    """Panel rows of the kept countries, with continent and region."""
    kept = region_map.filter("kept").select(COUNTRY, "continent", "region")
    return panel.join(joins.one_row_per(kept, [COUNTRY]), COUNTRY)


def arrival(observed: DataFrame, holds: Column, last: int, name: str) -> DataFrame:
    """First year per district that ``holds``, from observations inside the window only."""
    inside = observed.filter(F.col(YEAR) <= last)
    return inside.groupBy(DISTRICT).agg(aggregate.first_year_where(holds).cast("double").alias(name))


def arrival_clock(panel: DataFrame, anchor: str, since: str, arrived: str) -> DataFrame:
    """Years since arrival and an arrived flag, unknown where it never came."""
    return panel.withColumns({
        since: series.clock(YEAR, anchor),
        arrived: numeric.known_flag(F.col(YEAR) >= F.col(anchor)),
    })


def mask_region(panel: DataFrame, region: str, columns: Sequence[str]) -> DataFrame:
    return select.mask_outside(panel, F.col("region") == region, columns)
