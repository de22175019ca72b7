"""Reading messy sources into tidy frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelweave.functions import geo
from panelweave.sources.contracts import require_columns

POLYGON = "array<array<array<double>>>"
MULTIPOLYGON = "array<array<array<array<double>>>>"


def read_csv(spark: SparkSession, path: str, schema: StructType | str, encoding: str = "UTF-8", sep: str = ",", names_checked: bool = True) -> DataFrame:
    """CSV with declared columns; a header that differs fails the read."""
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding)
    return reader.option("enforceSchema", not names_checked).option("mode", "FAILFAST").csv(path)


def read_text_table(spark: SparkSession, path: str, required: Sequence[str], sep: str = "\t", encoding: str = "UTF-8") -> DataFrame:
    """All columns as text, header names trimmed and freed of a byte-order mark."""
    raw = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("quote", '"').csv(path)
    clean = raw.toDF(*[c.strip().lstrip("﻿").strip() for c in raw.columns])
    return require_columns(clean, required)


def read_long(spark: SparkSession, path: str, schema: StructType | str, keep: Sequence[Column], encoding: str = "UTF-8") -> DataFrame:
    """A large long CSV through a chain of filters; splits replace chunked reading."""
    out = read_csv(spark, path, schema, encoding, names_checked=False)
    for holds in keep:
        out = out.filter(holds)
    return out


def read_many(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """All parquet files of a folder as one source; empty files add nothing."""
    return spark.read.option("pathGlobFilter", pattern).option("mergeSchema", True).parquet(folder)


def name_part(pattern: str, group: int = 1) -> Column:
    """An attribute carried by the file name."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_name"), pattern, group), F.lit(""))


def read_records(spark: SparkSession, path: str, array: str, item: str, header: str = "") -> DataFrame:
    """JSON documents with a nested record list, one row per record.

    ``item`` is the record's schema; ``header`` names fields to carry down.
    """
    fields = f"{header + ', ' if header else ''}{array} array<struct<{item}>>"
    docs = spark.read.schema(fields).option("multiLine", True).json(path)
    carried = [c for c in docs.columns if c != array]
    return docs.select(*carried, F.inline(array))


def read_indicators(spark: SparkSession, path: str) -> DataFrame:
    """Indicator dumps: (column, iso3, year, value); blank and unreadable values become null."""
    item = "countryiso3code string, date string, value string"
    rows = read_records(spark, path, "data", item, "code string, column string")
    return rows.select(
        "code", "column", F.nullif(F.trim("countryiso3code"), F.lit("")).alias("iso3"),
        F.col("date").try_cast("int").alias("year"), F.col("value").try_cast("double").alias("value"),
    )


def read_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """GeoJSON features to rows: properties, file name and rings of every part.

    Returns one row per feature with ``rings``: array of (is_hole, ring).
    """
    feature = f"features array<struct<properties struct<{properties}>, geometry struct<type string, coordinates string>>>"
    raw = spark.read.schema(feature).option("multiLine", True).json(path)
    each = raw.select(F.col("_metadata.file_name").alias("file"), F.explode("features").alias("f"))
    coords, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    parts = F.when(kind == "Polygon", F.array(F.from_json(coords, POLYGON))).when(kind == "MultiPolygon", F.from_json(coords, MULTIPOLYGON))
    rings = F.flatten(F.transform(parts, lambda part: F.transform(part, lambda ring, i: F.struct((i > 0).alias("is_hole"), as_points(ring).alias("ring")))))
    return each.select("file", "f.properties.*", rings.alias("rings")).filter(F.col("rings").isNotNull())


def as_points(ring: Column) -> Column:
    """[[x, y, ...], ...] to points; height is dropped."""
    return F.transform(ring, lambda p: geo.flat_point(F.struct(p[0].alias("x"), p[1].alias("y"))))


def feature_polygons(features: DataFrame, ident: Sequence[str]) -> DataFrame:
    """Ring rows of features, ready for ``spatial.polygons``."""
    return features.select(*ident, F.inline("rings"))


def parse_lines(spark: SparkSession, path: str, pattern: str, names: Sequence[str], expected: int | None = None) -> DataFrame:
    """A lookup written as free text: one regex with a group per column.

    With ``expected`` the read fails unless exactly that many lines match.
    """
    lines = spark.read.text(path).filter(F.col("value").rlike(pattern))
    out = lines.select(*[F.trim(F.regexp_extract("value", pattern, i + 1)).alias(n) for i, n in enumerate(names)])
    if expected is not None and (found := out.count()) != expected:
        raise ValueError(f"{path}: expected {expected} lookup lines, found {found}")
    return out


def split_header(sheet: DataFrame, label: str, rows: Sequence[str]) -> tuple[dict[str, dict[str, object]], DataFrame]:
    """The header rows inside a wide sheet, and its body.

    ``label`` is the column that names the row; those named in ``rows`` are
    header rows, one of each. They come back as ``matrix_to_long`` takes them.
    """
    columns = [c for c in sheet.columns if c != label]
    name = F.trim(label)
    found = {r[label].strip(): r for r in sheet.filter(name.isin(list(rows))).collect()}  # a row for each name
    if missing := [r for r in rows if r not in found]:
        raise ValueError(f"header rows {missing} are not in the sheet")
    header = {c: {r: found[r][c] for r in rows} for c in columns}
    return header, sheet.filter(~F.coalesce(name.isin(list(rows)), F.lit(False)))


def matrix_to_long(sheet: DataFrame, ids: Sequence[str], header: Mapping[str, Mapping[str, object]], value: str) -> DataFrame:
    """A wide sheet with extra header rows to long form.

    ``header`` maps each body column to its attributes from the header rows
    (units, data years, ...); blank cells are dropped.
    """
    columns = list(header)
    attributes = list(next(iter(header.values())))
    rows = [(c, *[header[c][a] for a in attributes]) for c in columns]
    table = sheet.sparkSession.createDataFrame(rows, ["_column", *attributes])
    long = sheet.unpivot(list(ids), columns, "_column", value).filter(F.trim(F.col(value)) != "")
    return long.join(table, "_column").drop("_column")


def cells_of(df: DataFrame, x: str, y: str, value: str, size: float, nodata: float | None = None) -> DataFrame:
    """Gridded values by coordinate to a cell table, longitudes wrapped, nodata null."""
    v = F.col(value).cast("double")
    raw = F.when(F.isnan(v), None).otherwise(v)
    out = F.nullif(raw, F.lit(nodata).cast("double")) if nodata is not None else raw
    rest = [c for c in df.columns if c not in (x, y, value)]
    return df.select(
        F.floor(geo.wrap_longitude(F.col(x)) / size).cast("bigint").alias("cx"), F.floor(F.col(y) / size).cast("bigint").alias("cy"), *rest, out.alias("value")
    )
