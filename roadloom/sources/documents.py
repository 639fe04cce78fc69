"""JSON sources: envelope documents, GeoJSON collections, JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.operators.nested import feature_rows
from roadloom.sources.schemas import CORRUPT, CUSTOMER_ENVELOPE, FEATURE_COLLECTION, RAW_CUSTOMER, VEHICLE_TRACK


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole-file JSON documents (one document per file, ``multiLine``).

    Files are read in parallel, one task per file.  With ``_corrupt_record``
    in the schema a malformed file becomes a row with that column set instead
    of failing the job.
    """
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
    if CORRUPT in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


read_documents = read_json_documents


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines files (the stage written by ``write_json_lines``); splittable."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_customer_envelopes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``{data: [...], metadata: {...}}`` files -> (customer rows, metadata rows)."""
    docs = read_json_documents(spark, path, CUSTOMER_ENVELOPE)
    docs = docs.where(F.col(CORRUPT).isNull()).withColumn("__file", F.col("_metadata.file_path"))
    rows = docs.select(F.explode("data").alias("r")).select("r.*")
    meta = docs.select("__file", "metadata.*", F.size("data").alias("rows_in_file"))
    return rows, meta


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON FeatureCollection files -> one typed row per feature."""
    docs = read_json_documents(spark, path, FEATURE_COLLECTION).where(F.col(CORRUPT).isNull())
    return feature_rows(docs.select(F.explode("features").alias("feature")))


REJECT = "file string, level string, reason string, content string"


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """(file, content, doc): the whole text of every file and its JSON as VARIANT, a NULL doc where it is no JSON."""
    raw = spark.read.option("wholetext", True).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"), F.try_parse_json("value").alias("doc"))


def checked_elements(docs: DataFrame, array: str) -> tuple[DataFrame, DataFrame]:
    """((file, element VARIANT) of the array ``$.<array>`` of each document, rejected documents).

    A document is rejected with ``not_json`` when it does not parse and with ``no_<array>`` when it has no such array.
    """
    items = docs.withColumn("items", F.expr(f"try_variant_get(doc, '$.{array}', 'array<variant>')"))
    elements = items.where("items IS NOT NULL").select("file", F.explode("items").alias("element"))
    reason = F.when(F.col("doc").isNull(), F.lit("not_json")).otherwise(F.lit(f"no_{array}"))
    rejects = items.where("items IS NULL").select("file", F.lit("document").alias("level"), reason.alias("reason"), "content")
    return elements, rejects


def checked_rows(elements: DataFrame, fields: dict[str, tuple[str, str]], required: list[str], level: str, extra: Column | None = None,
                 more: list[tuple[Column, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows with their file, rejected elements with a reason) of VARIANT elements.

    ``fields`` maps a column to its path and type.  An element is rejected as ``not_an_object``, as ``missing:<column>`` when
    a required field is not there or null, as ``bad_type:<column>`` when a field that is there has another type, and for
    the first of ``more`` (condition, reason) that holds.  ``extra`` is one more column of the element.
    """
    def at(path: str, kind: str) -> Column:
        return F.expr(f"try_variant_get(element, '{path}', '{kind}')")

    def there(path: str) -> Column:
        found = at(path, "variant")
        return found.isNotNull() & ~F.is_variant_null(found)

    values = [at(path, kind).alias(c) for c, (path, kind) in fields.items()] + ([extra] if extra is not None else [])
    reason = F.when(~F.schema_of_variant("element").startswith("OBJECT"), F.lit("not_an_object"))
    for c in required:
        reason = reason.when(~there(fields[c][0]), F.lit(f"missing:{c}"))
    for c, (path, kind) in fields.items():
        reason = reason.when(there(path) & at(path, kind).isNull(), F.lit(f"bad_type:{c}"))
    # the values and the reason are worked out once, whichever output is written
    rows = elements.select("file", "element", F.explode(F.array(F.struct(F.struct(*values).alias("v"), reason.alias("reason")))).alias("r"))
    late = F.col("r.reason")
    for condition, name in more or []:
        late = F.coalesce(late, F.when(condition, F.lit(name)))
    rows = rows.withColumn("reason", late)
    bad = rows.where("reason IS NOT NULL").select("file", F.lit(level).alias("level"), "reason", F.to_json("element").alias("content"))
    return rows.where("reason IS NULL").select("file", "r.v.*"), bad


FEATURE_FIELDS = {
    "vehicle_id": ("$.properties.vehicleId", "string"), "name": ("$.properties.name", "string"), "speed": ("$.properties.speed", "bigint"),
    "geometry_type": ("$.geometry.type", "string"), "coordinates": ("$.geometry.coordinates", "array<double>"),
}


def read_geojson_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """GeoJSON files -> (one row per feature, rejects): documents that are no JSON or have no features, and features that are no
    objects, lack a vehicle or a position, or have fields of another type, each with its reason and text.

    Rows have the columns of `read_geojson` and ``other_properties`` (map of text), so a property that nobody named stays.
    Every document is read or rejected, and so is every feature of a document read.
    """
    elements, documents = checked_elements(read_variants(spark, path), "features")
    rest = F.expr("""transform_values(map_filter(try_variant_get(element, '$.properties', 'map<string,variant>'),
        (k, v) -> k NOT IN ('vehicleId', 'name', 'speed')), (k, v) -> coalesce(try_variant_get(v, '$', 'string'), to_json(v)))""")
    position = F.col("r.v.coordinates")
    rows, features = checked_rows(
        elements, FEATURE_FIELDS, ["vehicle_id", "coordinates"], "feature", rest.alias("other_properties"),
        [(F.col("r.v.geometry_type").isNull() | (F.col("r.v.geometry_type") != "Point"), "not_a_point"),
         (F.get(position, 0).isNull() | F.get(position, 1).isNull(), "no_position")])
    out = rows.select("vehicle_id", "name", "speed", "geometry_type", F.get("coordinates", 0).alias("longitude"),
                      F.get("coordinates", 1).alias("latitude"), "other_properties")
    return out, documents.unionByName(features)


def _fields_of(schema: T.StructType) -> dict[str, tuple[str, str]]:
    return {f.name: (f"$.{f.name}", f.dataType.simpleString()) for f in schema if f.name != CORRUPT}


def read_envelopes_checked(spark: SparkSession, path: str, schema: T.StructType = RAW_CUSTOMER, required: list[str] | None = None,
                           level: str = "record") -> tuple[DataFrame, DataFrame]:
    """``{data: [...]}`` files -> (records of ``schema``, rejects with a reason), as `read_geojson_checked` does for features."""
    elements, documents = checked_elements(read_variants(spark, path), "data")
    rows, records = checked_rows(elements, _fields_of(schema), ["id"] if required is None else required, level)
    return rows.drop("file"), documents.unionByName(records)


def read_tracks_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``{data: [...]}`` files of vehicle tracks -> (tracks, rejects); no field may be missing, as the source scripts drop
    rows with missing values."""
    return read_envelopes_checked(spark, path, VEHICLE_TRACK, VEHICLE_TRACK.fieldNames(), "track")
