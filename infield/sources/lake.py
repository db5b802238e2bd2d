"""The lake: day-partitioned Parquet tables, read by snapshot, day or range, written idempotently.

``dt`` stays a string; predicates on it prune partitions.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from infield.operators.relational import latest_fetch


def days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row for each day from start to end, both included."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day")).select(F.col("day").cast("string").alias("dt"))


def periods(listed: DataFrame, unit: str) -> DataFrame:
    """The first days of the months or years of ``listed`` (dt): partitions of entities that come by period."""
    return listed.select(F.trunc(F.to_date("dt"), unit).cast("string").alias("dt")).distinct()


def read(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A table, or None if it isn't there or has no file; sentinel rows of empty days are dropped.

    With a declared ``schema`` no footer is opened; without one, the files' schemas are merged. Other errors are raised.
    """
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    was = spark.conf.get(inference)
    spark.conf.set(inference, "false")
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
        df = reader.parquet(f"{root}/{table}")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    finally:
        spark.conf.set(inference, was)
    return without_sentinels(df)


def without_sentinels(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(F.col("empty").cast("boolean"), F.lit(False))).drop("empty") if "empty" in df.columns else df


def between(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col("dt").between(start, end))


def as_of(df: DataFrame, dt: str | None = None) -> DataFrame:
    """The rows of one day, by default the newest: one aggregate over the partition column."""
    newest = F.lit(dt) if dt else F.lit(df.agg(F.max("dt")).first()[0])
    return df.where(F.col("dt") == newest)


def newest_before(df: DataFrame, dt: str) -> str | None:
    return df.where(F.col("dt") < dt).agg(F.max("dt")).first()[0]


def existing_days(df: DataFrame, start: str, end: str) -> list[str]:
    return sorted(r.dt for r in between(df, start, end).select("dt").distinct().collect())


def bronze(df: DataFrame) -> DataFrame:
    """Of every day the rows of the newest fetch."""
    return latest_fetch(df, ["dt"], "response_checksum", "ingested_at_utc")


CORRUPT = "_corrupt_record"


def json_records(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Records of JSON files, a list or a single object each, with the file of each; an unreadable one keeps a row.

    Such a row has its text in _corrupt_record and nulls elsewhere. counted_write() counts these rows and leaves them out;
    readable() leaves them out uncounted.
    """
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("multiLine", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path if isinstance(path, str) else list(path)).withColumn("file", F.col("_metadata.file_path"))


def json_lines(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """The same for files of one record a line, which tasks share."""
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path if isinstance(path, str) else list(path)).withColumn("file", F.col("_metadata.file_path"))


def readable(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


AUDIT = "stage string, table_name string, started_at_utc string, seconds double, rows long, bad_rows long, bad_files long, days long, status string, error string, dt string"


def append_audit(spark: SparkSession, root: str, row: Mapping[str, object], table: str = "audit_run") -> None:
    """Adds one row to the run audit, which is never rewritten."""
    schema = T._parse_datatype_string(AUDIT)
    spark.createDataFrame([tuple(row.get(f.name) for f in schema)], schema).coalesce(1).write.mode("append").partitionBy("dt").parquet(f"{root}/{table}")


def counted_write(records: DataFrame, root: str, table: str, covered: Sequence[str], stage: str, make: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, object]:
    """Writes the days ``covered`` of a table from ``records``, and what was read and left out to the run audit.

    Rows, corrupt rows and their files, and the days that came are counted by the job that writes, by observation: the
    input is read once. ``make`` turns readable records into rows (with dt). Days outside ``covered`` are left out. A covered
    day without rows ends up empty. If the write fails, the audit says so and the error is raised.
    """
    spark = records.sparkSession
    started, clock = datetime.now(UTC), time.perf_counter()
    read_in, written = Observation(), Observation()
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in records.columns else F.lit(False)
    file = F.col("file") if "file" in records.columns else F.lit(None).cast("string")
    seen = records.observe(read_in, F.count("*").alias("read"), F.count_if(bad).alias("bad_rows"), F.size(F.collect_set(F.when(bad, file))).alias("bad_files"))
    good = seen.where(~bad).drop(CORRUPT, "file")
    rows = make(good).where(F.col("dt").isin(list(covered))).withColumn("ingested_at_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    rows = rows.observe(written, F.count("*").alias("rows"), F.collect_set("dt").alias("days"))
    told: dict[str, object] = {"stage": stage, "table_name": table, "started_at_utc": started.strftime("%Y-%m-%dT%H:%M:%SZ"), "dt": started.strftime("%Y-%m-%d")}
    try:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{root}/{table}")
        a, b = read_in.get, written.get
        _empty_days(spark, root, table, set(covered) - set(b["days"]))
        told |= {"rows": b["rows"], "bad_rows": a["bad_rows"], "bad_files": a["bad_files"], "days": len(b["days"]), "status": "partial" if a["bad_rows"] else "ok"}
    except Exception as e:
        append_audit(spark, root, told | {"seconds": round(time.perf_counter() - clock, 3), "status": "failed", "error": str(e)[:200]})
        raise
    append_audit(spark, root, told | {"seconds": round(time.perf_counter() - clock, 3)})
    return told


def _empty_days(spark: SparkSession, root: str, table: str, days: set[str]) -> None:
    """Deletes days by name: dynamic overwrite leaves those without new rows alone."""
    for d in sorted(days):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/dt={d}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").csv(path)


def listing(spark: SparkSession, root: str, names: str = "*.csv") -> DataFrame:
    """path, size and modified of the files under ``root``, and the season in each one's path (its last four digits there that are a year).

    Files are listed, not read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(root)
    years = F.regexp_extract_all("path", F.lit(r"(?<!\d)((?:18|19|20)\d\d)(?!\d)"), F.lit(1))
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.try_element_at(years, F.lit(-1)).cast("int").alias("season"))


def iso_day(column: str | Column) -> Column:
    """A day as ISO text from ISO text, digits or the start of a time stamp; null for anything else."""
    c = F.trim((F.col(column) if isinstance(column, str) else column).cast("string"))
    digits = F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.nullif(F.regexp_extract(digits, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def csv_range(spark: SparkSession, root: str, schema: str, date_column: str | None, start: str, end: str, names: str = "*.csv") -> DataFrame | None:
    """Rows of sharded CSV files from ``start`` to ``end``, with dt and file; None if no file may have any.

    Only files of the range's seasons, or of none, are opened, whatever there is beside them; the rest of the range is a
    filter on the day. Without a date column rows count for their file's season. Files whose header is not ``schema``'s are
    an error, as columns would be taken for others.
    """
    first, last = int(start[:4]), int(end[:4])
    chosen = listing(spark, root, names).where(F.col("season").isNull() | F.col("season").between(first, last)).select("path").collect()  # a row a file
    if not chosen:
        return None
    df = spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(sorted(r.path for r in chosen)).withColumn("file", F.col("_metadata.file_path"))
    if date_column is None:
        return df
    return df.withColumn("dt", iso_day(date_column)).where(F.col("dt").between(start, end))


def on_day(df: DataFrame, column: str, dt: str) -> DataFrame:
    """Rows whose date column is the day, as ISO text, as digits, or as the start of a time stamp."""
    c = F.col(column).cast("string")
    return df.where((c == dt) | (c == dt.replace("-", "")) | c.startswith(dt))


def require(df: DataFrame, expected: Sequence[str], name: str) -> DataFrame:
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df


def stable_json(*columns: str) -> Column:
    return F.to_json(F.struct(*sorted(columns)))


def append_new(df: DataFrame, root: str, table: str, checksum: str = "response_checksum") -> DataFrame:
    """Appends the rows whose content isn't there yet, by checksum; returns them."""
    spark = df.sparkSession
    there = read(spark, root, table)
    fresh = df if there is None else df.join(there.select(checksum).distinct(), checksum, "left_anti")
    fresh.write.mode("append").partitionBy("dt").parquet(f"{root}/{table}")
    return fresh


RAW = "source string, entity string, dt string, url string, status_code int, fetched_at_utc string, response_checksum string, body_text string"


def write_raw(responses: DataFrame, root: str, force: bool = False) -> DataFrame:
    """Responses as compressed JSON by source, entity and day; gives the number written, as one row.

    A response is known by the SHA-256 of its text. One that is there already is left out, unless ``force`` says to keep it
    again; of equal ones in ``responses`` the first fetched counts. Nothing that is there is rewritten.
    """
    spark = responses.sparkSession
    keys = ["source", "entity", "dt", "response_checksum"]
    told = responses.withColumn("response_checksum", F.sha2(F.coalesce("body_text", F.lit("")), 256))
    fresh = told.groupBy(*keys).agg(F.min_by(F.struct("url", "status_code", "fetched_at_utc", "body_text"), F.struct("fetched_at_utc", "url")).alias("r")).select(*keys, "r.*")
    if not force:
        there = raw(spark, root)
        fresh = fresh if there is None else fresh.join(there.select(*keys), keys, "left_anti")
    before = Observation()
    fresh.observe(before, F.count("*").alias("rows")).write.mode("append").partitionBy("source", "entity", "dt").option("compression", "gzip").json(f"{root}/bronze")
    return spark.createDataFrame([(before.get["rows"],)], "written long")


def raw(spark: SparkSession, root: str, source: str | None = None, entity: str | None = None) -> DataFrame | None:
    """Bronze responses, of one source or entity if given; None if there are none."""
    try:
        df = spark.read.schema(RAW).json(f"{root}/bronze")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    for column, value in (("source", source), ("entity", entity)):
        df = df if value is None else df.where(F.col(column) == value)
    return df


def write_days(df: DataFrame, root: str, table: str, covered: Sequence[str], force: bool = True) -> None:
    """Replaces the days ``covered`` of a table by ``df``, in one job; a covered day without rows ends up empty.

    Without ``force`` days that exist stay as they are. ``df`` is evaluated once, and may read this very table: which days
    have rows is observed by the job that writes. Dynamic overwrite leaves days without new rows alone, so those are deleted
    by name after it; until then, readers see their old rows, and a call that fails in between has to be made again.
    """
    spark = df.sparkSession
    there = read(spark, root, table)
    existing = set() if there is None else {r.dt for r in there.select("dt").distinct().collect()}
    wanted = [d for d in covered if force or d not in existing]
    rows = df.where(F.col("dt").isin(wanted)).withColumn("ingested_at_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    made = Observation()
    rows.observe(made, F.collect_set("dt").alias("days")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{root}/{table}")
    _empty_days(spark, root, table, set(wanted) & existing - set(made.get["days"]))


def publish_range(layer: DataFrame, root: str, table: str, start: str, end: str) -> None:
    """The days of a range in the target as the layer has them, and no others of that range."""
    target = read(layer.sparkSession, root, table)
    have = [] if target is None else existing_days(target, start, end)
    write_days(between(layer, start, end), root, table, sorted(set(have) | set(existing_days(layer, start, end))))


def publishable(df: DataFrame) -> DataFrame:
    """Names that any engine takes (``2b`` as ``c_2b``, unique), and nested values as JSON."""
    names: list[str] = []
    for c in df.columns:
        name = re.sub(r"[^0-9A-Za-z_]", "_", c)
        name = f"c_{name}" if name[:1].isdigit() else name
        while name in names:
            name += "_1"
        names.append(name)
    flat = [F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(*[c.alias(n) for c, n in zip(flat, names, strict=True)])


_RANK = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3, "float": 4, "double": 5}


def aligned(df: DataFrame, target: Mapping[str, str]) -> DataFrame:
    """``df`` cast to the target's types where nothing is lost: wider numbers, nulls, whole doubles; else an error. New columns stay."""
    out, doubtful = {}, []
    for name, kind in df.dtypes:
        want = target.get(name, kind)
        if kind == want:
            continue
        wider = kind in _RANK and want in _RANK and _RANK[kind] <= _RANK[want] and not (kind == "bigint" and want == "float")
        if kind == "void" or wider:
            out[name] = F.col(name).cast(want)
        elif kind == "double" and want in ("bigint", "int", "smallint"):
            doubtful.append(name)
            out[name] = F.col(name).cast(want)
        else:
            raise ValueError(f"{name}: {kind} doesn't fit {want}")
    if doubtful:
        bad = df.agg(*[F.count_if((F.col(c) != F.floor(c)) | (F.abs(c) >= 9e15)).alias(c) for c in doubtful]).first()
        lost = [c for c in doubtful if bad[c]]
        if lost:
            raise ValueError("not whole numbers: " + ", ".join(lost))
    return df.withColumns(out)


def write_each(tables: Mapping[str, DataFrame], write) -> dict[str, str]:
    """Writes every table; what fails is collected and raised only after the others are there."""
    failed = {}
    for name, df in tables.items():
        try:
            write(name, df)
        except (ValueError, AnalysisException) as e:
            failed[name] = str(e)[:200]
    if failed:
        raise RuntimeError(f"not published: {failed}")
    return failed


def register(spark: SparkSession, root: str, tables: Mapping[str, str], database: str = "default") -> list[str]:
    """Makes the folders of a lake tables of the catalog, with comments (table: comment); those that aren't there are skipped."""
    made = []
    for name, comment in sorted(tables.items()):
        df = read(spark, root, name)
        if df is not None:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            spark.catalog.createTable(f"{database}.{name}", path=f"{root}/{name}", source="parquet", description=comment)
            spark.catalog.recoverPartitions(f"{database}.{name}")
            made.append(name)
    return made


def logged(df: DataFrame, source: str, entity: str) -> DataFrame:
    """One row for each request behind bronze rows, for the request log."""
    return df.groupBy("dt", "response_checksum").agg(F.min("ingested_at_utc").alias("fetched_at"), F.count("*").alias("rows")).withColumns({"source": F.lit(source), "entity": F.lit(entity)})


def seasons_to_refresh(changed: Sequence[str], published: Sequence[str]) -> list[str]:
    """Published days whose season-to-date tables depend on the changed ones: all later days of the same year."""
    first: dict[str, str] = {}
    for d in changed:
        first[d[:4]] = min(d, first.get(d[:4], d))
    return sorted(p for p in published if p[:4] in first and p > first[p[:4]])
