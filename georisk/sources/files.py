"""File sources: yearly CSV unions, lenient CSV scans and road edges."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def discover_sources(spark: SparkSession, pattern: str, fallback=()) -> list[str]:
    """Sorted file list for a glob (any Hadoop filesystem); fallback when empty."""
    jvm = spark.sparkContext._jvm
    jsc = spark.sparkContext._jsc
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(jsc.hadoopConfiguration())
    stats = fs.globStatus(path) or []
    found = sorted(str(s.getPath().toString()) for s in stats if s.isFile())
    sources = found or list(fallback)
    if not sources:
        raise ValueError(f"no source files for {pattern!r}")
    return sources


SEPARATORS = (",", ";", "\t", "|")


def sniff_separator(header: str) -> str:
    """The separator that occurs most in a header line (first of ``SEPARATORS`` on a tie)."""
    return max(SEPARATORS, key=lambda x: (header.count(x), -SEPARATORS.index(x)))


def _files(spark: SparkSession, paths) -> list[str]:
    """The files of ``paths``, folders opened (their visible files, sorted)."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for p in [paths] if isinstance(paths, str) else paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        if not fs.getFileStatus(at).isDirectory():
            out.append(p)
            continue
        out += sorted(s.getPath().toString() for s in fs.listStatus(at)
                      if s.isFile() and not s.getPath().getName().startswith(("_", ".")))
    return out


def _csv_forms(spark: SparkSession, paths, sep: str | None) -> dict[tuple, list[str]]:
    """Files by (separator, column names), found from each file's header line."""
    alike: dict[tuple, list[str]] = {}
    for p in _files(spark, paths):                    # one line per file
        first = spark.read.text(p).first()
        if first is None:
            continue                                  # an empty file has no rows
        line = (first[0] or "").lstrip("\ufeff")
        own = sep or sniff_separator(line)
        alike.setdefault((own, tuple(x.strip() for x in next(csv.reader([line], delimiter=own), []))), []).append(p)
    return alike


def _by_name(df: DataFrame, name: str):
    have = {c.lower() for c in df.columns}
    return F.col(name) if name.lower() in have else F.lit(None).cast("string")


def scan_csv_union(spark: SparkSession, paths, sep: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Several CSV files with a header, unioned by column name; missing columns are NULL.

    Every field is read as text, so nothing is inferred that differs from file
    to file ('14:30' stays '14:30', '2A' stays '2A').  Without ``sep`` each
    file's separator is found from its header line.  Files with the same
    header are one scan.  ``schema`` picks the columns by name and converts
    them with ``try_cast`` (NULL where a field doesn't fit).
    """
    alike = _csv_forms(spark, paths, sep)
    if not alike:
        raise ValueError("no CSV source given")
    frames = []
    for (own, names), files in alike.items():
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        frames.append(spark.read.option("header", True).option("sep", own).option("enforceSchema", True)
                      .schema(text).csv(files))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if schema is None:
        return out
    return out.select(*[_by_name(out, f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def scan_csv_lenient(spark: SparkSession, paths, schema: T.StructType, sep: str | None = None) -> DataFrame:
    """Rows that do not fit ``schema`` are dropped; the source file of every row is kept as ``filename``.

    Columns are matched by name, whatever their order, and files may lack some
    (NULL) or have others; without ``sep`` each file's separator is found from
    its header line.  Every field is read as text (with a corrupt-record column
    for rows with a wrong field count) and converted with ``try_cast``; a row is
    dropped when any non-empty field of the schema fails to convert.  Doing the
    check explicitly keeps the result independent of which columns a query later
    selects (the CSV reader's own DROPMALFORMED only checks the parsed columns).
    """
    frames = []
    for (own, names), files in _csv_forms(spark, paths, sep).items():
        text = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "_corrupt")])
        raw = (spark.read.option("header", True).option("sep", own).option("mode", "PERMISSIVE")
               .option("enforceSchema", True).option("columnNameOfCorruptRecord", "_corrupt")
               .option("columnPruning", False).schema(text).csv(files))   # else fields are counted among the columns read
        typed = {f.name: _by_name(raw, f.name).try_cast(f.dataType) for f in schema.fields}
        ok = F.col("_corrupt").isNull()
        for f in schema.fields:
            ok = ok & (_by_name(raw, f.name).isNull() | typed[f.name].isNotNull())
        frames.append(raw.filter(ok).select(*[typed[f.name].alias(f.name) for f in schema.fields],
                                            F.col("_metadata.file_path").alias("filename")))
    if not frames:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("filename", T.StringType())]))
    return reduce(DataFrame.unionByName, frames)


# properties and coordinates differ from file to file: both are read as JSON text
ROAD_FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
    T.StructField("properties", T.StringType()),
])
_LINE = "array<array<double>>"
FEATURE_START = r'\{\s*"type"\s*:\s*"Feature"\s*,'


def feature_start(spark: SparkSession, path: str) -> str | None:
    """The text with which the features of a document begin, as its first feature has it (in the first MB)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return jvm.java.util.Scanner(stream, "UTF-8").findWithinHorizon(FEATURE_START, 1 << 20)
    finally:
        stream.close()


def read_feature_collection(spark: SparkSession, path: str) -> DataFrame:
    """Features of FeatureCollection documents (a file or a folder of them), each document parsed by many tasks.

    The text with which a feature begins is the record separator of a plain
    text scan, which Spark splits at any byte; a record is then one feature
    without its beginning.  Documents in which that text doesn't stand before
    every feature (members in another order, other white space) are parsed
    whole, one task each.
    """
    forms: dict[str | None, list[str]] = {}
    for p in _files(spark, path):
        forms.setdefault(feature_start(spark, p), []).append(p)
    frames, whole = [], forms.pop(None, [])
    for start, files in forms.items():
        records = spark.read.option("lineSep", start).text(files).withColumn("file", F.col("_metadata.file_path"))
        text = F.concat(F.lit(start), F.col("value"))
        # before the first separator stands the head of the document, which begins like an object
        features = records.filter(F.ltrim("value").startswith('"')).withColumn("text", text)
        uneven = [r["file"] for r in features.filter(F.regexp_count("text", F.lit(r'"type"\s*:\s*"Feature"')) > 1)
                  .select("file").distinct().collect()]   # at most one per document
        if uneven:
            whole += uneven
            features = features.filter(~F.col("file").isin(uneven))
        frames.append(features.select(F.from_json("text", ROAD_FEATURE_SCHEMA).alias("f")).select("f.*"))
    if whole or not frames:
        doc = T.StructType([T.StructField("features", T.ArrayType(ROAD_FEATURE_SCHEMA))])
        raw = spark.read.option("multiLine", True).schema(doc).json(whole) if whole else spark.createDataFrame([], doc)
        frames.append(raw.select(F.explode("features").alias("f")).select("f.*"))
    return reduce(DataFrame.unionByName, frames)


def _first_text(properties: str, name: str):
    """First element of a property that is a string, a number or a list of them, as text; numbers without fraction."""
    s = F.from_json(properties, "map<string,string>")[name]
    is_list = s.startswith("[")
    text = F.when(is_list, F.try_element_at(F.from_json(s, "array<string>"), F.lit(1))).otherwise(s)
    # a quoted text is no number for the parser, so '80.0' in quotes stays text
    number = F.coalesce(F.from_json(properties, f"{name} double")[name],
                        F.try_element_at(F.from_json(properties, f"{name} array<double>")[name], F.lit(1)))
    return F.coalesce(number.cast("long").cast("string"), text)


def read_road_edges(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Road edges from GeoJSON features -> one row per segment.

    ``multiline=False`` reads one feature per line; ``multiline=True`` reads
    FeatureCollection documents (`read_feature_collection`), by many tasks too.
    A LineString is one edge, a MultiLineString one edge of several lines;
    other geometries have no segments.  Features without an ``edge_id`` are
    keyed by a hash of their coordinates.  ``highway`` / ``maxspeed`` may be a
    string, a number or a JSON list; all are normalised to the first element,
    numbers to their whole part.  A property that no feature has is no column
    of the result, as attribute defaults depend on that.
    """
    feats = read_feature_collection(spark, path) if multiline else spark.read.schema(ROAD_FEATURE_SCHEMA).json(path)
    names = ("highway", "maxspeed")
    props = F.from_json("properties", "map<string,string>")
    held = feats.agg(*[F.bool_or(F.map_contains_key(props, n)).alias(n) for n in names]).first()
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    lines = (F.when(kind == "LineString", F.array(F.from_json(text, _LINE)))
             .when(kind == "MultiLineString", F.from_json(text, f"array<{_LINE}>")))
    edges = feats.select(
        F.coalesce(props["edge_id"].try_cast("long"), F.xxhash64(lines)).alias("edge_id"),
        *[_first_text("properties", n).alias(n) for n in names if held[n]], lines.alias("lines"))
    parts = edges.select(*[c for c in edges.columns if c != "lines"], F.posexplode("lines").alias("part", "coords"))
    return edges_to_segments(parts)


def edges_to_segments(edges: DataFrame) -> DataFrame:
    """coords ARRAY<ARRAY<lon,lat>> -> rows (edge_id, seg, lon1, lat1, lon2, lat2, ...)."""
    seg = edges.select(
        "*", F.posexplode(F.arrays_zip(F.slice("coords", 1, F.size("coords") - 1).alias("a"),
                                       F.slice("coords", 2, F.size("coords")).alias("b"))).alias("seg", "ab"))
    return seg.select(
        *[c for c in edges.columns if c != "coords"], "seg",
        F.col("ab.a")[0].alias("lon1"), F.col("ab.a")[1].alias("lat1"),
        F.col("ab.b")[0].alias("lon2"), F.col("ab.b")[1].alias("lat2"),
    )


def write_road_edges(roads: DataFrame, path: str) -> None:
    """Edges -> GeoJSON features, one per line, deduplicated by whole geometry (the smallest edge_id stays).

    ``roads`` has a row per two-point edge, or, with columns ``seg`` (and
    ``part``), a row per segment: an edge of n segments is one LineString of
    n + 1 points, one of several parts a MultiLineString.
    """
    names = [c for c in ("edge_id", "highway", "maxspeed") if c in roads.columns]
    if "seg" not in roads.columns:
        lines = roads.select(*names, F.array(F.array(F.array("lon1", "lat1"), F.array("lon2", "lat2"))).alias("lines"))
    else:
        part = F.col("part") if "part" in roads.columns else F.lit(0)
        segs = roads.withColumn("part", part).groupBy("edge_id", "part").agg(   # the segments of one line
            *[F.min(c).alias(c) for c in names if c != "edge_id"],
            F.sort_array(F.collect_list(F.struct("seg", "lon1", "lat1", "lon2", "lat2"))).alias("s"))
        points = F.concat(F.transform("s", lambda x: F.array(x["lon1"], x["lat1"])),
                          F.array(F.array(F.element_at("s", -1)["lon2"], F.element_at("s", -1)["lat2"])))
        lines = segs.withColumn("points", points).groupBy("edge_id").agg(
            *[F.min(c).alias(c) for c in names if c != "edge_id"],
            F.transform(F.sort_array(F.collect_list(F.struct("part", "points"))), lambda x: x["points"]).alias("lines"))
    single = F.size("lines") == 1
    feats = lines.select(
        F.struct(*names).alias("properties"),
        F.concat(F.lit('"type":"'), F.when(single, "LineString").otherwise("MultiLineString"), F.lit('","coordinates":'),
                 F.when(single, F.to_json(F.col("lines")[0])).otherwise(F.to_json("lines"))).alias("geometry"))
    # same geometry twice -> keep the smallest edge_id (deterministic, partial aggregation)
    feats = feats.groupBy("geometry").agg(F.min("properties").alias("properties"))
    feats.select(F.concat(F.lit('{"type":"Feature","geometry":{'), "geometry", F.lit('},"properties":'),
                          F.to_json("properties"), F.lit("}"))).write.mode("overwrite").text(path)
