"""Readers: JSONL (plain or zstd), event logs, CSV and TSV tables, allowlists, result trees, SQLite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.messages import content_parts, normalize_role

#: The first record of an event log has one of these types.
EVENT_TYPES = ("session", "message", "model_change", "thinking_level_change")


def lines(spark: SparkSession, path: str, glob: str = "*.jsonl*", recursive: bool = True) -> DataFrame:
    """(file, block, value) of every line of the files, in order of (file, block) and, within a block, of the rows.

    Plain files are split; .gz ones are read by Spark as a whole; those that end in .zst are decompressed by the tasks as a
    stream, one file a row, so a compressed file must fit in memory, its text need not.
    """
    opened = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    file, start = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    plain = opened.text(path).where(~F.col("_metadata.file_path").endswith(".zst")).select(file, start, "value")
    packed = opened.format("binaryFile").load(path).where(F.col("path").endswith(".zst")).select(F.col("path").alias("file"), "content")

    def unpack(stream):
        import io

        import pyarrow as pa
        import zstandard

        for batch in stream:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content.as_py()), read_across_frames=True)
                text, held, size, block = io.TextIOWrapper(reader, encoding="utf-8"), [], 0, 0
                for line in text:
                    held.append(line.rstrip("\r\n"))
                    size += len(line)
                    if size > 1_000_000:
                        yield pa.RecordBatch.from_pydict({"file": [name] * len(held), "block": [block] * len(held), "value": held}, schema=kinds)
                        held, size, block = [], 0, block + 1
                yield pa.RecordBatch.from_pydict({"file": [name] * len(held), "block": [block] * len(held), "value": held}, schema=kinds)

    import pyarrow as pa

    kinds = pa.schema([("file", pa.string()), ("block", pa.int64()), ("value", pa.string())])
    return plain.unionByName(packed.mapInArrow(unpack, "file string, block long, value string"))


def numbered_lines(spark: SparkSession, path: str, glob: str = "*.jsonl*") -> DataFrame:
    """(file, line, value), lines from 0. Blocks of a file are read by several tasks; one sorts a file's lines."""
    rows = lines(spark, path, glob).withColumn("_n", F.monotonically_increasing_id())
    n = F.row_number().over(Window.partitionBy("file").orderBy("block", "_n")) - 1
    return rows.select("file", n.alias("line"), "value")


def normalized_examples(spark: SparkSession, path: str, per_file: int = 0, glob: str = "*.jsonl*") -> DataFrame:
    """(file, line, example) of every row of JSONL files that holds something to learn; example is JSON text.

    Messages come from the first of messages, conversations, conversation and trajectory that is a list, else a question
    and its answer make two. Bad lines and rows without an assistant target go; at most per_file lines of a file are
    read where that is not 0. Event logs have a reader of their own, `event_logs`, and their files give nothing here.
    """
    from millrace.functions.examples import normalized

    rows = numbered_lines(spark, path, glob).where(F.trim("value") != "")
    if per_file:
        rows = rows.where(F.col("line") < per_file)
    first = F.first(F.get_json_object("value", "$.type")).over(Window.partitionBy("file").orderBy("line"))
    rows = rows.withColumn("_first", first).where(F.col("_first").isNull() | ~F.col("_first").isin(*EVENT_TYPES))
    return rows.select("file", "line", normalized(F.col("value")).alias("example")).where("example is not null")


def text_set(spark: SparkSession, path: str) -> DataFrame:
    """(value): the distinct lines of a text file, blank ones aside; a missing file has none."""
    try:
        rows = spark.read.text(path)
    except Exception as e:  # the path does not exist in its store
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "value string")
    return rows.select(F.trim("value").alias("value")).where("value <> ''").distinct()


def jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False, glob: str = "*.jsonl*") -> DataFrame:
    """Objects of JSONL files. Blank lines go; other lines that are no object go too, or, if strict, stop the query."""
    rows = lines(spark, path, glob).where(F.trim("value") != "")
    whole = F.try_parse_json("value")
    is_object = F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
    if strict:
        rows = rows.withColumn("value", F.when(is_object, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("bad JSON in "), F.col("file")))))
    else:
        rows = rows.where(is_object)
    return rows.select("file", F.from_json("value", schema).alias("row")).select("file", "row.*")


def event_logs(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """One example per event-log file: (file, messages, bad_json). Other files give none."""
    rows = numbered_lines(spark, path, glob).where(F.trim("value") != "")
    field = lambda p: F.get_json_object("value", p)
    ok = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    w = Window.partitionBy("file").orderBy("line")
    first = F.first(field("$.type")).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("_first", first).where(F.col("_first").isin(*EVENT_TYPES)).withColumn("_ok", ok)
    is_message = F.col("_ok") & (field("$.type") == "message")
    parts = content_parts(field("$.message.content"))
    turn = F.struct("line", normalize_role(field("$.message.role")).alias("role"), parts["text"].alias("content"), parts["reasoning"].alias("reasoning_content"), parts["tool_calls"].alias("tool_calls"))
    out = rows.groupBy("file").agg(F.sort_array(F.collect_list(F.when(is_message, turn))).alias("messages"), F.sum((~F.col("_ok")).cast("long")).alias("bad_json"))
    return out.withColumn("messages", F.filter("messages", lambda m: m["role"].isNotNull()))


def csv_by_id(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A CSV with header, one row per key: the last in the file's order wins."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.withColumn("_at", F.monotonically_increasing_id())
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_at")))
    return df.withColumn("_n", last).where("_n = 1").drop("_n", "_at")


def manifest_tsv(spark: SparkSession, path: str, columns: dict[str, int], least: int = 5) -> DataFrame:
    """Columns by position of TSV manifests; short rows and header rows go; (file, columns 1 and 2) count once."""
    rows = lines(spark, path, "*.tsv").withColumn("c", F.split("value", "\t")).where(F.size("c") >= least)
    rows = rows.where(~F.lower(F.get("c", F.lit(0))).isin("index", "idx", "id"))
    rows = rows.dropDuplicates(["file", "value"]).withColumn("_n", F.row_number().over(Window.partitionBy("file", F.get("c", F.lit(1)), F.get("c", F.lit(2))).orderBy(F.get("c", F.lit(0)).cast("long")))).where("_n = 1")
    return rows.select("file", *(F.get("c", F.lit(i)).alias(n) for n, i in columns.items()))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of an allowlist: comments and blank lines go; a JSON line gives its uuid, another its first word."""
    v = F.trim("value")
    rows = spark.read.text(path).where((v != "") & ~v.startswith("#"))
    return rows.select(F.when(v.startswith("{"), F.get_json_object("value", "$.uuid")).otherwise(F.get(F.split(v, r"\s+"), F.lit(0))).alias("uuid")).where("uuid is not null").distinct()


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """Line numbers, 0 or more, of an allowlist; anything else stops the query."""
    rows = id_list(spark, path).select(F.col("uuid").try_cast("long").alias("line"))
    return rows.select(F.when(F.col("line") >= 0, F.col("line")).otherwise(F.raise_error(F.lit("a line number must be an integer from 0")).cast("long")).alias("line"))


def result_tree(spark: SparkSession, pattern: str, parts: dict[str, int]) -> DataFrame:
    """Whole JSON files under a glob, with parts of their paths, counted from the file name backwards from 1."""
    df = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json"))
    pieces = F.split("path", "/")
    return df.select("path", "json", *(F.element_at(pieces, -i).alias(n) for n, i in parts.items()))


def sqlite_distinct(spark: SparkSession, path: str, table: str, column: str) -> DataFrame:
    """Distinct non-empty values of a column of a SQLite index; read by one task, as the file has one writer format."""

    def run(stream):
        import sqlite3

        import pandas as pd

        for _ in stream:
            with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                yield pd.read_sql_query(f'select distinct "{column}" as value from "{table}" where "{column}" <> \'\'', db)  # noqa: S608

    return spark.range(1, numPartitions=1).mapInPandas(run, "value string")


def capped_files(df: DataFrame, per_file: int, order: Column, most: int | None = None) -> DataFrame:
    """At most so many rows of each file, and of all."""
    out = df.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy(order))).where(F.col("_n") <= per_file).drop("_n")
    return out if most is None else out.limit(most)


def parquet_shape(df: DataFrame) -> dict:
    """Columns with types, and the number of rows from file footers alone."""
    return {"schema": dict(df.dtypes), "rows": df.count()}


def json_or_list(col: Column) -> Column:
    """A list of strings from JSON text; text that is no list stops the query."""
    out = F.from_json(col, "array<string>")
    return F.when(out.isNull() & col.isNotNull(), F.raise_error(F.concat(F.lit("no list: "), col)).cast("array<string>")).otherwise(out)


def file_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, format, value) below a path: JSONL lines and Parquet rows as JSON text; folders named .cache are left out."""
    text = lines(spark, path).select("file", F.lit("jsonl").alias("format"), "value")
    tables = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("mergeSchema", "true")
    try:
        rows = tables.parquet(path)
    except Exception as e:  # a tree without Parquet files has no schema to read
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return text.where(~F.col("file").contains("/.cache/"))
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.lit("parquet").alias("format"), F.to_json(F.struct(*rows.columns)).alias("value"))
    return text.unionByName(rows).where(~F.col("file").contains("/.cache/"))


def shuffled_files(rows: DataFrame, seed: str) -> DataFrame:
    """rows with the order of their file under a seed: by hash, so it is the same on every cluster."""
    return rows.withColumn("file_order", F.sha2(F.concat(F.lit(seed), F.lit("\0"), F.col("file")), 256))
