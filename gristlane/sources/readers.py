"""Readers and sinks of the logs, manifests and labels that the operators start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def captures(spark: SparkSession, root: str, schema: T.StructType, limit: int | None = None) -> DataFrame:
    """JSON documents (one a file) below a folder with dated subfolders, newest file first; malformed ones are left out.

    ``limit`` is clamped to 1..500.  A day's folder prunes as the partition column it is named for.
    """
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    d = spark.read.schema(full).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(root)
    d = d.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"))
    d = d.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return d if limit is None else d.orderBy(F.desc("modified"), "path").limit(max(1, min(500, limit)))


def json_lines(spark: SparkSession, path, schema: T.StructType, ts: str | None = None, strict: bool = False) -> DataFrame:
    """JSON lines; malformed lines (and lines without a readable time zone, if ``ts`` is named) are left out, or fail if strict."""
    if strict:
        d = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    else:
        full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        d = spark.read.schema(full).json(path).withColumn("_bad", F.col("_corrupt_record").isNotNull()).where("not _bad").drop("_bad", "_corrupt_record")
    if ts is None:
        return d
    zoned = F.col(ts).rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return d.where(zoned).withColumn(ts, F.try_to_timestamp(F.col(ts))).where(F.col(ts).isNotNull())


def strict_lines(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """JSON lines that must all be objects without a repeated key; the first bad line is an error that shows it."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    keys = F.json_object_keys("value")
    bad = lines.where(keys.isNull() | (F.size(keys) != F.size(F.array_distinct(keys)))).first()
    if bad is not None:
        raise ValueError(f"not an object, or a key twice: {bad['value'][:200]}")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("x")).select("x.*")


def manifests(spark: SparkSession, paths: dict[str, int], training_only: bool = False) -> DataFrame:
    """CSV manifests as strings, the rows of each file repeated so many times (``copy`` from 1), missing columns null."""
    out = None
    for path, n in paths.items():
        d = spark.read.option("header", True).csv(path).withColumn("manifest", F.lit(path)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n))))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out.where("split = 'training'") if training_only else out


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """df, or an error that names a repeated key."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").first()
    if twice is not None:
        raise ValueError(f"repeated key: {twice.asDict()}")
    return df


def pinned(spark: SparkSession, root: str, digests: DataFrame) -> DataFrame:
    """(path, sha256, matches) of files against a table (name, sha256); files without an entry do not match."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    got = files.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.sha2("content", 256).alias("found"))
    return got.join(digests, "name", "left").select("path", F.col("found").alias("sha256"), F.coalesce(F.col("found") == F.col("sha256"), F.lit(False)).alias("matches"))


# Reasons against a label line, and how far a box may reach beyond the image.
LABEL_REASONS = ["not_single_object", "invalid_column_count", "non_numeric_label", "invalid_class_id", "non_finite_bbox", "invalid_bbox", "bbox_outside_image"]
BEYOND = 0.01


def label_line(text: Column, classes: int = 9) -> tuple[Column, Column]:
    """(class and centred box as a struct, reason) of a label file: one object as ``class x y w h``, the class a whole number however written; the other is null.

    A file without a line is an empty scene: neither has a value.  A null text is one too.
    """
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    parts = F.split(F.get(lines, F.lit(0)), r"\s+")
    raw, x, y, w, h = (F.get(parts, F.lit(i)).try_cast("double") for i in range(5))
    odd = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    several, columns, number, cls, finite, box, outside = LABEL_REASONS
    reason = (
        F.when(F.size(lines) == 0, F.lit(None))
        .when(F.size(lines) != 1, several)
        .when(F.size(parts) != 5, columns)
        .when(raw.isNull() | x.isNull() | y.isNull() | w.isNull() | h.isNull(), number)
        .when(odd(raw) | (raw != F.floor(raw)) | (raw < 0) | (raw >= classes), cls)
        .when(odd(x) | odd(y) | odd(w) | odd(h), finite)
        .when(~(x.between(0, 1) & y.between(0, 1) & (w > 0) & (w <= 1) & (h > 0) & (h <= 1)), box)
        .when((x - w / 2 < -BEYOND) | (x + w / 2 > 1 + BEYOND) | (y - h / 2 < -BEYOND) | (y + h / 2 > 1 + BEYOND), outside)
    )
    value = F.when(reason.isNull() & (F.size(lines) == 1), F.struct(raw.cast("int").alias("class_id"), x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h")))
    return value, reason


def pair_files(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Images with the label file of their stem and folder (a trailing number of the folder's name is ignored): first extension wins."""

    def keyed(d: DataFrame) -> DataFrame:
        folder = F.regexp_replace(F.regexp_replace(F.regexp_extract("path", r"([^/]*)/[^/]*$", 1), r"^(TL|TS)_", ""), r"_\d+$", "")
        return d.withColumns({"folder": folder, "stem": F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1), "ext": F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))})

    order = F.array_position(F.array(*[F.lit(e) for e in ("jpg", "jpeg", "png", "bmp", "webp", "tif")]), F.col("ext"))
    w = W.partitionBy("folder", "stem").orderBy(order, "path")
    i = keyed(images).where(order > 0).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("folder", "stem", F.col("path").alias("image"))
    return keyed(labels).select("folder", "stem", F.col("path").alias("label")).join(i, ["folder", "stem"], "inner")


def reply(text: Column, schema: str, keys: list[str]) -> tuple[Column, Column]:
    """(struct, reason) of a model's JSON reply: exactly these keys, values of the schema."""
    value = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    found = F.json_object_keys(text)
    reason = F.when(found.isNull(), "not_an_object").when(F.size(F.array_except(found, F.array(*map(F.lit, keys)))) > 0, "unexpected_key").when(F.size(F.array_except(F.array(*map(F.lit, keys)), found)) > 0, "missing_key")
    return F.when(reason.isNull(), value), reason


def append_json(df: DataFrame, path: str) -> None:
    """One object a line, appended."""
    df.write.mode("append").json(path)


def write_daily(df: DataFrame, ts: str, path: str) -> None:
    """Rows in folders by day, appended."""
    df.withColumn("date", F.to_date(ts)).write.mode("append").partitionBy("date").parquet(path)


def publish(df: DataFrame, path: str) -> None:
    """Write where nothing is yet; an existing result is an error."""
    df.write.mode("errorifexists").parquet(path)


def write_manifest(df: DataFrame, path: str, first: list[str], kind: str = "csv") -> None:
    """A manifest with the named columns first and the others in alphabetical order."""
    out = df.select(*first, *sorted(c for c in df.columns if c not in first))
    out.write.mode("errorifexists").option("header", True).csv(path) if kind == "csv" else out.write.mode("errorifexists").json(path)
