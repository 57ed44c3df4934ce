"""Readers and writers: CSV, GeoJSON whole or broken, rasters, JSON documents."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.sources.workers import map_arrow

GEOMETRY = "type string, coordinates array<double>"


def points(spark: SparkSession, path: str) -> DataFrame:
    """A point table in Parquet."""
    return spark.read.parquet(path)


def csv(spark: SparkSession, path: str, schema: str | None = None, comment: str | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header; quotes are doubled inside fields, lines may break in quotes, ``comment`` lines and rows without ``required`` are passed over."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    reader = reader.option("comment", comment) if comment else reader
    rows = (reader.schema(schema) if schema else reader).csv(path)
    return rows.na.drop(subset=list(required)) if required else rows


def geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of a GeoJSON file: ``lon``, ``lat`` of points and the given properties."""
    schema = f"features array<struct<type:string,geometry:struct<type:string,coordinates:array<double>>,properties:struct<{properties}>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline("features"))
    return rows.select(F.col("geometry.type").alias("geometry"), F.col("geometry.coordinates")[0].alias("lon"), F.col("geometry.coordinates")[1].alias("lat"), "properties.*")


def box_of(spark: SparkSession, path: str) -> tuple[float, float, float, float]:
    """Bounds of the first ring of a GeoJSON file's first feature: four numbers, all that the driver needs of it."""
    schema = "features array<struct<geometry:struct<coordinates:array<array<array<double>>>>>>"
    ring = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode(F.col("features")[0]["geometry"]["coordinates"][0]).alias("p"))
    row = ring.agg(F.min(F.col("p")[0]), F.min(F.col("p")[1]), F.max(F.col("p")[0]), F.max(F.col("p")[1])).first()
    return tuple(float(v) for v in row)


def _objects(text: str) -> Iterator[str]:
    """Closed brace pairs of a text that name a feature, inner ones first; braces in strings do not count."""
    starts: list[int] = []
    quoted = escaped = False
    for i, c in enumerate(text):
        if quoted:
            quoted, escaped = not (c == '"' and not escaped), c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c == "{":
            starts.append(i)
        elif c == "}" and starts:
            chunk = text[starts.pop() : i + 1]
            if '"Feature"' in chunk:
                yield chunk


def salvage(text: str) -> list[str]:
    """Features of a GeoJSON text, as JSON; of a broken one those that are whole."""
    text = text.replace("\r", "")
    try:
        return [json.dumps(f) for f in json.loads(text).get("features", [])]
    except json.JSONDecodeError:
        out = []
        for chunk in _objects(text):
            try:
                out.append(json.dumps(json.loads(chunk)))
            except json.JSONDecodeError:
                continue
        return out


def geojson_tolerant(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """As ``geojson``, from files that may be cut off or broken; bytes that are no UTF-8 are replaced. A file is read whole by a task."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(salvage(content.as_py().decode("utf-8", "replace")), pa.string())], names=["feature"])

    feature = f"type string, geometry struct<type:string,coordinates:array<double>>, properties struct<{properties}>"
    parsed = map_arrow(files, run, "feature string").select(F.from_json("feature", feature).alias("f")).where("f.type = 'Feature'")
    return parsed.select(F.col("f.geometry.type").alias("geometry"), F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.geometry.coordinates")[1].alias("lat"), "f.properties.*")


def raster_window(cells: DataFrame, grid, rows: tuple[int, int], cols: tuple[int, int], z: str = "z") -> DataFrame:
    """Cells of a window with a value, as points at their centres."""
    inside = F.col("y").between(*rows) & F.col("x").between(*cols) & F.col(z).isNotNull()
    return cells.where(inside).select("y", "x", grid.lon(F.col("x")).alias("lon"), grid.lat(F.col("y")).alias("lat"), F.col(z).alias("z"))


def first_file(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows of the first file, by name, that matches a pattern of Parquet files."""
    rows = spark.read.parquet(pattern).withColumn("_file", F.col("_metadata.file_path"))
    return rows.join(F.broadcast(rows.agg(F.min("_file").alias("_file"))), "_file").drop("_file")


def is_tiff(spark: SparkSession, path: str) -> DataFrame:
    """Files with ``tiff``: whether they begin as one and are longer than 1024 bytes."""
    files = spark.read.format("binaryFile").load(path)
    magic = F.hex(F.substring("content", 1, 4))
    return files.select("path", "length", (magic.isin("49492A00", "4D4D002A") & (F.col("length") > 1024)).alias("tiff"))


def backup_edits(text: DataFrame, column: str) -> DataFrame:
    """Edits from backup documents: ``id``, ``name``, ``removed``."""
    return text.select(F.explode(F.from_json(column, "map<string,struct<name:string,removed:boolean>>")).alias("id", "e")).select("id", "e.name", "e.removed")


def select_scenes(catalogue: DataFrame, box: tuple[float, float, float, float], start: str, end: str, cloud: float = 5.0, cover: float = 0.98, most: int = 12) -> DataFrame:
    """The clearest scenes that cover a box, in a time interval: unknown cloud counts as 100; equal ones by id."""
    width = F.greatest(F.lit(0.0), F.least(F.col("lon_max"), F.lit(box[2])) - F.greatest(F.col("lon_min"), F.lit(box[0])))
    height = F.greatest(F.lit(0.0), F.least(F.col("lat_max"), F.lit(box[3])) - F.greatest(F.col("lat_min"), F.lit(box[1])))
    share = width * height / ((box[2] - box[0]) * (box[3] - box[1]))
    known = F.coalesce("cloud", F.lit(100.0))
    chosen = catalogue.withColumn("share", share).where((F.col("share") >= cover) & F.col("ts").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")) & (known < cloud))
    return chosen.orderBy(known, "id").limit(most)


def write_points(points: DataFrame, path: str, by: str = "holdout") -> None:
    """Points as Parquet, parted by a column such as the side of a split."""
    points.write.mode("overwrite").partitionBy(by).parquet(path)


def write_cells(cells: DataFrame, path: str, block: int = 256) -> None:
    """Cells as Parquet, sorted by block, so that a window reads few row groups."""
    from gridweave.functions.geo import block_of

    keyed = cells.withColumn("block", block_of(F.col("y"), F.col("x"), block))
    keyed.repartitionByRange("block").sortWithinPartitions("block", "y", "x").write.mode("overwrite").parquet(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_text(document: DataFrame, path: str) -> None:
    """A one-row document, such as GeoJSON, GPX, SVG or a report."""
    document.coalesce(1).write.mode("overwrite").text(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any store that Spark reaches; stages whose output is there can be passed over."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def produce(spark: SparkSession, path: str, make: Callable[[], DataFrame], force: bool = False, dry_run: bool = False) -> DataFrame | None:
    """The table at ``path``: as it is if it is there, else, or with ``force``, made and put there. ``dry_run`` shows the plan and writes nothing.

    A table is written beside its place and renamed when it is whole, so a run that fails leaves what was there, and ``make`` may read it.
    """
    if exists(spark, path) and not force:
        return spark.read.parquet(path)
    rows = make()
    if dry_run:
        rows.explain("formatted")
        return None
    place = path.rstrip("/")
    fresh, old = f"{place}.new-{uuid.uuid4().hex[:12]}", f"{place}.old-{uuid.uuid4().hex[:12]}"
    rows.write.parquet(fresh)
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = to_path(place).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    replaced = exists(spark, place)
    if replaced and not store.rename(to_path(place), to_path(old)) or not store.rename(to_path(fresh), to_path(place)):
        raise OSError(f"{fresh} could not be put in place of {place}")
    if replaced:
        store.delete(to_path(old), True)
    return spark.read.parquet(path)


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """The first of some candidate paths that is there."""
    return next((p for p in paths if exists(spark, p)), None)


def flags(spark: SparkSession, path: str) -> DataFrame:
    """One row with a JSON file of names and booleans as a map; an absent file is an empty map."""
    if not exists(spark, path):
        return spark.range(1).select(F.create_map().cast("map<string,boolean>").alias("flags"))
    return spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,boolean>").alias("flags"))


def editor_points(spark: SparkSession, path: str) -> DataFrame:
    """Raw points of the editor from a JSON array."""
    schema = "id string, zone string, origName string, suggestedName string, lat double, lon double, depth string, remarks string, sourceNotes string, clusterId string, flags array<string>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.withColumnsRenamed({"origName": "orig_name", "suggestedName": "suggested", "sourceNotes": "source_notes", "clusterId": "cluster"})
