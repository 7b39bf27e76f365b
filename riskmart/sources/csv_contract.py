"""CSV sources read under a declared contract."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.contracts import SourceContract
from riskmart.operators.row_contracts import SourceContractError
from riskmart.sources.tables import broadcast_if_small, new_folder, write_table

BOM = "﻿"
FOLD = 1024
#: A quoted field with the comma before it; a quote inside a plain field is a character like any other.
QUOTED = '(^|,)"(?:[^"]++|"")*+"'
#: A quoted field that has more characters is taken for one that is never closed.
FIELD_LIMIT = 131_072
#: A field that ends on its line; a quote opens one only at its start, and what follows a closing quote belongs to the field.
_FIELD = r'(?:"(?:[^"]++|"")*+"(?:[^",][^,]*+)?|[^",][^,]*+|)'
_CLOSED = rf'^{_FIELD}(?:,{_FIELD})*+$'
_CLOSED_INSIDE = rf'^(?:[^"]++|"")*+"(?:[^",][^,]*+)?(?:,{_FIELD})*+$'


def check_header(spark: SparkSession, paths: Sequence[str], contract: SourceContract) -> None:
    """Compares the first line of every file with the contract before any load, in one job."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"), "value",
    )
    first = lines.where("_block = 0").groupBy("path").agg(F.min_by("value", "_position").alias("line"))
    plain = [mark + ",".join(contract.columns) for mark in ("", BOM)]
    # One row for each other spelling: a quoted header is still right, and the scan checks every header again.
    for row in first.where(~F.col("line").isin(plain)).groupBy("line").agg(F.min("path").alias("path")).limit(100).collect():
        header = tuple(next(csv.reader(io.StringIO(row.line.removeprefix(BOM))), ()))
        if header != contract.columns:
            raise SourceContractError(f"{row.path}: header does not match the {contract.name} contract: {','.join(header)}")
    if first.count() < len(paths):  # a scan skips files without a byte
        raise SourceContractError(f"a file of the {contract.name} contract is empty")


def _options() -> dict[str, str]:
    return {"escape": '"', "nullValue": "\u0001", "emptyValue": "", "columnNameOfCorruptRecord": "_corrupt_record"}


def _with_cells(rows: DataFrame, width: int) -> DataFrame:
    """``cells`` counts the cells of a row, ``extra_cells`` marks a row that is too wide."""
    raw = F.regexp_replace("raw_line", QUOTED, "$1")
    cells = F.when(F.col("raw_line").isNull(), width).otherwise(F.length(raw) - F.length(F.replace(raw, F.lit(","), F.lit(""))) + 1)
    return rows.withColumn("cells", cells).withColumn("extra_cells", F.col("cells") > width)


def read_contract_csv(spark: SparkSession, paths: Sequence[str], contract: SourceContract) -> DataFrame:
    """All columns as text, with the file name, split position and row width, of files whose rows are single lines.

    ``raw_line`` is the source line of a row of another width, so that a quarantine loses nothing of it.
    """
    rows = spark.read.schema(contract.csv_schema()).options(header=True, enforceSchema=False, **_options()).csv(list(paths))
    placed = rows.select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"),
        *contract.columns,
        F.col("_corrupt_record").alias("raw_line"),
    )
    return _with_cells(placed, len(contract.columns))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"), F.regexp_replace("value", "\r$", "").alias("line"), "value",
    )


def _opens(line: str) -> Column:
    """A row that begins with this line goes on after it."""
    return F.contains(line, F.lit('"')) & ~F.rlike(line, F.lit(_CLOSED))


def _through(partition: list[str], order: str) -> tuple[Column, Column]:
    """State before each item, if the partition begins outside a quoted field and if it begins inside one.

    An item maps the state before it to that after it (``from_out``, ``from_in``: 1 is inside): it keeps it, turns it round, or sets it. So the state before
    an item is what the last item before it that sets one has set, turned as often as items since then turn it.
    """
    before = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    turns = F.when((F.col("from_out") == 1) & (F.col("from_in") == 0), 1).otherwise(0)
    turned = F.coalesce(F.sum(turns).over(before), F.lit(0))
    sets = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out"))
    turned_there = F.when(sets.isNotNull(), F.sum(turns).over(upto))
    value, there = F.last(sets, ignorenulls=True).over(before), F.last("_turned_there", ignorenulls=True).over(before)
    state = lambda start: F.when(value.isNull(), F.lit(start).bitwiseXOR(turned % 2)).otherwise(value.bitwiseXOR((turned - there) % 2))
    return turned_there, (state(0).cast("int"), state(1).cast("int"))


def _states(items: DataFrame, partition: list[str], order: str) -> DataFrame:
    """Adds ``if_out`` and ``if_in``: the state before each item for either start."""
    there, (if_out, if_in) = _through(partition, order)
    return items.withColumn("_turned_there", there).withColumn("if_out", if_out).withColumn("if_in", if_in).drop("_turned_there")


def read_quoted_csv(spark: SparkSession, paths: Sequence[str], contract: SourceContract, folder: str) -> DataFrame:
    """Rows of files with line ends inside quoted fields, numbered in their file, read by as many tasks as the files have splits.

    Each line tells where it ends if it begins outside or inside a quoted field. Joined up within each split and then over the splits of a file, this gives the
    state before every line, and with it the lines on which rows begin. Only rows of several lines are put together; then each row is parsed.
    """
    check_header(spark, paths, contract)
    opens = _opens("line")
    inside = F.when(F.contains("line", F.lit('"')), (~F.rlike("line", F.lit(_CLOSED_INSIDE))).cast("int")).otherwise(1)
    flagged = _states(_lines(spark, paths).withColumn("from_out", opens.cast("int")).withColumn("from_in", inside), ["source_file", "_block"], "_position")
    flagged = write_table(flagged, f"{folder}/flagged")
    after = lambda state: F.when(F.col(state) == 1, F.col("from_in")).otherwise(F.col("from_out"))
    splits = flagged.groupBy("source_file", "_block").agg(
        F.max_by(after("if_out"), "_position").alias("from_out"), F.max_by(after("if_in"), "_position").alias("from_in"),
    )
    splits = write_table(_states(splits, ["source_file"], "_block").select("source_file", "_block", F.col("if_out").alias("start")), f"{folder}/splits")
    begins = (F.col("state") == 0) & (F.trim("line") != "")
    known = flagged.join(broadcast_if_small(splits), ["source_file", "_block"]).withColumn("state", F.when(F.col("start") == 1, F.col("if_in")).otherwise(F.col("if_out")))
    known = known.where((F.col("state") == 1) | begins).withColumn("begins", begins)
    inner = Window.partitionBy("source_file", "_block").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    counted = known.select("source_file", "_block", "_position", "line", "value", "begins", F.sum(F.col("begins").cast("long")).over(inner).alias("_row"))
    counted = write_table(counted, f"{folder}/counted")
    before = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    rows = counted.groupBy("source_file", "_block").agg(F.max("_row").alias("_rows"))
    starts = write_table(rows.select("source_file", "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")), f"{folder}/starts")
    numbered = counted.join(broadcast_if_small(starts), ["source_file", "_block"]).withColumn("row", F.col("_start") + F.col("_row"))
    longer = write_table(numbered.where(~F.col("begins")).select("source_file", "row").distinct(), f"{folder}/longer")
    many = numbered.join(broadcast_if_small(longer), ["source_file", "row"], "left_semi")
    limit = FIELD_LIMIT * len(contract.columns)
    endless = many.groupBy("source_file", "row").agg(F.sum(F.length("value") + 1).alias("length")).where(F.col("length") > limit).first()
    if endless:
        raise SourceContractError(f"{endless.source_file}: row {endless.row - 1} has a quoted field that is not closed within {FIELD_LIMIT} characters")
    whole = many.groupBy("source_file", "row").agg(F.sort_array(F.collect_list(F.struct("_block", "_position", "value"))).alias("lines"))  # FIELD_LIMIT bounds it
    whole = whole.select("source_file", "row", F.regexp_replace(F.array_join(F.transform("lines", lambda x: x["value"]), "\n"), "\r$", "").alias("text"))
    single = numbered.join(broadcast_if_small(longer), ["source_file", "row"], "left_anti").select("source_file", "row", F.col("line").alias("text"))
    parsed = single.unionByName(whole).where("row > 1").withColumn("cells_of", F.from_csv("text", ", ".join(f"`{f.name}` string" for f in contract.csv_schema()), {**_options(), "multiLine": "true"}))
    placed = parsed.select("source_file", (F.col("row") - 1).alias("source_row_number"), *[F.col(f"cells_of.{c}") for c in contract.columns], F.col("cells_of._corrupt_record").alias("raw_line"))
    return _with_cells(placed, len(contract.columns))


def land_with_row_numbers(spark: SparkSession, paths: Sequence[str], contract: SourceContract, folder: str | None = None) -> DataFrame:
    """Source rows with their 1-based place in their file.

    The text is parsed once and written; row numbers then follow from the
    counts per file split (one row per split), without sorting rows. Only if a
    line ends inside a quoted field are rows put together first.
    """
    folder = folder or new_folder(spark, "landing")
    if _lines(spark, paths).where(_opens("line")).isEmpty():
        return number_rows(write_table(read_contract_csv(spark, paths, contract), f"{folder}/rows"), f"{folder}/starts")
    return write_table(read_quoted_csv(spark, paths, contract, folder), f"{folder}/rows")


def number_rows(landed: DataFrame, folder: str) -> DataFrame:
    """Adds ``source_row_number``. The first numbers of the splits are a table of one row each, written and read back under its true
    size, so that the checked broadcast moves no source row."""
    splits = landed.groupBy("source_file", "_block").agg(F.count("*").alias("_rows"), F.min("_position").alias("_first"))
    before = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = write_table(splits.select(
        "source_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    ), folder)
    kept = [c for c in landed.columns if c not in ("_block", "_position", "source_file")]
    return landed.join(broadcast_if_small(starts), ["source_file", "_block"]).select(
        "source_file", (F.col("_start") + F.col("_position") - F.col("_first") + 1).alias("source_row_number"), *kept
    )


def file_sizes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "path", "length")


def fingerprints(spark: SparkSession, paths: Sequence[str], folder: str | None = None) -> DataFrame:
    """Version id per file, by one definition for files of any size.

    Every line has a SHA-256, a carriage return before its end included. ``FOLD``
    digests in order make one of the next level until one is left (a block of one
    keeps its digest); the id is the SHA-256 of that and of the file's length,
    which tells whether the last line is ended. No task holds a file.
    """
    folder = folder or new_folder(spark, "lines")
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"),
        F.sha2(F.col("value").cast("binary"), 256).alias("line"),
    )
    level = number_rows(write_table(lines, f"{folder}/lines"), f"{folder}/line-starts").select("source_file", (F.col("source_row_number") - 1).alias("at"), "line")
    most = level.agg(F.max("at")).first()[0] or 0
    while most:
        block = F.sort_array(F.collect_list(F.struct("at", "line")))  # FOLD entries at most
        folded = level.groupBy("source_file", F.expr(f"at div {FOLD}").alias("above")).agg(block.alias("block"))
        joined = F.sha2(F.concat_ws("", F.transform("block", lambda x: x["line"])), 256)
        level = folded.select("source_file", F.col("above").alias("at"), F.when(F.size("block") == 1, F.col("block")[0]["line"]).otherwise(joined).alias("line"))
        most //= FOLD
    sizes = file_sizes(spark, paths)
    root = F.concat(F.col("length").cast("string"), F.lit(":"), F.coalesce("line", F.lit("")))
    return sizes.join(level, "source_file", "left").select("source_file", F.upper(F.sha2(root, 256)).alias("source_version"), "length")


def require_manifest(files: DataFrame, manifest: DataFrame) -> None:
    """Every file must be canonical and have the expected byte count."""
    joined = files.join(manifest.where("is_canonical"), "source_file", "left")
    row = joined.where("expected_source_rows is null or expected_source_bytes <> length").orderBy("source_file").first()
    if row and row.expected_source_rows is None:
        raise SourceContractError(f"{row.source_file} is not in the canonical manifest")
    if row:
        raise SourceContractError(f"{row.source_file}: {row.length} bytes, manifest expects {row.expected_source_bytes}")
