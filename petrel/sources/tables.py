"""Many gene tables in one scan: lines by block, records across quoted line ends, headers and verdicts by file.

Files are split where Spark splits them, so neither a large file nor a thousand small ones are a task of their own.
The text is read once and its lines become a Parquet table in the shared folder: a second scan could be split elsewhere,
as splits depend on the cores at hand, and lines are numbered by split. Records are another such table; blocks and headers
are small ones beside them.
The jobs are as many for a thousand files as for one.
"""

from __future__ import annotations

import re
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.functions.columns import clean_name
from petrel.operators.checkpoints import written
from petrel.sources.contract import ADJUSTED, ALIASES, SEPARATORS, checks, separator_of, typed

#: Headers of so many files are broadcast: some hundred bytes each.
BROADCAST_FILES = 100_000
#: Rows that a verdict names.
NAMED_ROWS = 20


def scanned(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, id, line): ids grow by one with the lines of a block, as a block is read by one task."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def _odd(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2


def blocks(lines: DataFrame) -> DataFrame:
    """A row a block: its first id, the lines before it, whether it begins inside quotes, and the quotes of its file.

    ``spans``: a field of the file goes over a line's end; ``closed``: its quotes are even.
    """
    counts = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.sum(_odd(F.col("line"))).alias("odd"))
    whole = W.partitionBy("file")
    before = whole.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    odd = F.sum("odd").over(whole)
    return counts.select("file", "block", "first", earlier("n").alias("offset"), (earlier("odd") % 2).alias("inside"), (odd > 0).alias("spans"), (odd % 2 == 0).alias("closed"))


def records(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """(file, input_row, record) of the files whose quotes are even: the line of the file, from 0, on which a record begins.

    Files without quoted line ends, which is most, are not sorted or exchanged for this.
    """
    numbered = lines.join(starts.where("closed"), ["file", "block"]).withColumn("input_row", F.col("id") - F.col("first") + F.col("offset"))
    plain = numbered.where("NOT spans").select("file", "input_row", F.col("line").alias("record")).where("record <> ''")
    if starts.where("closed AND spans").isEmpty():
        return plain
    in_block = W.partitionBy("file", "block").orderBy("input_row")
    quotes = F.coalesce(F.sum(_odd(F.col("line"))).over(in_block.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    spanning = numbered.where("spans").withColumn("start", F.when((F.col("inside") + quotes) % 2 == 0, F.col("input_row")))
    spanning = spanning.withColumn("start", F.last("start", ignorenulls=True).over(in_block))
    # What a block begins with may belong to the last record of an earlier one.
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = spanning.groupBy("file", "block").agg(F.max("start").alias("last")).select("file", "block", F.max("last").over(earlier).alias("carried"))
    joined = spanning.join(carried, ["file", "block"]).groupBy("file", F.coalesce("start", "carried").alias("input_row")).agg(F.sort_array(F.collect_list(F.struct("input_row", "line"))).alias("parts"))
    return plain.union(joined.select("file", "input_row", F.array_join("parts.line", "\n").alias("record")).where("record <> ''"))


def fields(record: Column, sep: Column) -> Column:
    """A record's fields: a quoted one may hold separators, line ends and doubled quotes."""

    def cut(s: str) -> Column:
        return F.regexp_extract_all(F.concat(F.lit(s), record), F.lit(f'{s}("[^"]*+(?:""[^"]*+)*+"[^{s}]*+|[^{s}]*+)'), F.lit(1))

    found = F.when(sep == SEPARATORS[0], cut(SEPARATORS[0])).when(sep == SEPARATORS[1], cut(SEPARATORS[1])).when(sep == SEPARATORS[2], cut(SEPARATORS[2]))
    inner = lambda x: F.replace(F.regexp_replace(x, '^"|"[^"]*$', ""), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda x: F.when(x.startswith('"'), inner(x)).otherwise(x))


def headers(found: DataFrame) -> DataFrame:
    """(file, header_row, sep, gene_at, logFC_at, pvalue_at, fault): where each file has its columns, or why it has none."""
    first = found.groupBy("file").agg(F.min("input_row").alias("input_row"))
    line = F.regexp_replace("record", "^\\uFEFF", "")
    cut = found.join(first, ["file", "input_row"]).select("file", F.col("input_row").alias("header_row"), line.alias("line"), separator_of(line).alias("sep"))
    cut = cut.withColumn("cells", fields(F.col("line"), F.col("sep"))).withColumn("names", F.transform("cells", clean_name))

    def named(aliases: list[str]) -> Column:
        return F.transform("names", lambda x: x.isin(aliases))

    hit = {c: named(a) for c, a in ALIASES.items()}
    many = {c: F.size(F.filter(h, lambda x: x)) for c, h in hit.items()}
    listed = lambda c: F.array_join(F.filter("cells", lambda x: clean_name(x).isin(ALIASES[c])), ", ")
    missing = F.array_join(F.array_compact(F.array(*(F.when(n == 0, F.lit(c)) for c, n in many.items()))), ", ")
    fault = F.coalesce(
        F.when(F.col("sep").isNull(), F.lit("the header has no separator")),
        *(F.when(n > 1, F.concat(F.lit(f"several columns for {c}: "), listed(c))) for c, n in many.items()),
        F.when((missing == "pvalue") & F.exists("names", lambda x: x.isin(ADJUSTED)), F.lit("only adjusted p-values are given; raw p-values are needed")),
        F.when(missing != "", F.concat(F.lit("missing columns: "), missing)),
    )
    return cut.select("file", "header_row", "sep", *(F.array_position(h, F.lit(True)).cast("int").alias(f"{c}_at") for c, h in hit.items()), fault.alias("fault"))


def _parts(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Blocks, headers, and the rows of files whose header is right."""
    lines = scanned(spark, paths)
    few = len(lines.inputFiles()) <= BROADCAST_FILES
    lines = written(lines)
    starts = written(blocks(lines))
    # headers, their lines and the rows are read from records that are put together once
    found = written(records(lines, starts))
    heads = written(headers(found))
    at = heads.where("fault IS NULL")
    body = found.join(F.broadcast(at) if few else at, "file").where("input_row > header_row").withColumn("v", fields(F.col("record"), F.col("sep")))
    rows = typed(body.select("file", "input_row", *(F.get("v", F.col(f"{c}_at") - 1).alias(c) for c in ALIASES)), "file")
    return starts, heads, rows


def read_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, input_row, gene, logFC, pvalue) of every file, or file below a folder, whose header is right. Values are not checked.

    ``input_row`` is the line of its file, from 0, on which a row begins. Blank lines are no rows; a file with
    a quote that is not closed has none (``verdicts`` says so). A short row has nulls.
    """
    return _parts(spark, paths)[2]


def verdicts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, rows, fault) of every file that is not empty: null, or the first rule that it breaks with the first rows that do."""
    starts, heads, rows = _parts(spark, paths)
    rows = written(rows)
    quotes = starts.groupBy("file").agg(F.min("closed").alias("closed"))
    count = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    found = checks(rows, "file")
    worst = found.groupBy("file").agg(F.min("position").alias("position"))
    by_row = W.partitionBy("file").orderBy("input_row")
    named = found.join(worst, ["file", "position"]).withColumn("k", F.row_number().over(by_row)).where(F.col("k") <= NAMED_ROWS + 1)
    listed = named.groupBy("file", "rule").agg(F.sort_array(F.collect_list("input_row")).alias("r"))
    text = F.concat("rule", F.lit(": rows "), F.array_join(F.slice("r", 1, NAMED_ROWS), ", "), F.when(F.size("r") > NAMED_ROWS, F.lit(", ...")).otherwise(F.lit("")))
    out = quotes.join(heads, "file", "left").join(count, "file", "left").join(listed.select("file", text.alias("broken")), "file", "left")
    fault = F.coalesce(F.when(~F.col("closed"), F.lit("a quote is not closed")), F.when(F.col("header_row").isNull(), F.lit("the input is empty")), "fault", F.when(F.col("rows").isNull(), F.lit("the input has no rows")), "broken")
    return out.select("file", F.coalesce("rows", F.lit(0)).alias("rows"), fault.alias("fault"))


def located(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """Path to the file as Spark names it, null where there is none. Lists files only; nothing is read."""

    def files(given: list[str]) -> list[str]:
        try:
            return spark.read.option("recursiveFileLookup", True).text(given).inputFiles()
        except AnalysisException:
            return []

    plain = lambda p: unquote(urlsplit(p).path) if re.match("[A-Za-z][A-Za-z0-9+.-]*:/", p) else p
    known = {plain(f): f for f in files(paths)}
    return {p: known.get(plain(p)) or next(iter(files([p])), None) for p in dict.fromkeys(paths)}


def preflight(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, status, message) of a list of files, by the same few jobs whatever their number."""
    at = located(spark, paths)
    given = spark.createDataFrame(list(at.items()), "path string, file string")
    there = [p for p, f in at.items() if f]
    if not there:
        return given.select("path", F.lit("FAIL").alias("status"), F.lit("the input can't be read").alias("message"))
    # One name of a file may have one slash after the scheme and the other three.
    name = lambda c: F.regexp_replace(c, "^([A-Za-z][A-Za-z0-9+.-]*:)/+", "$1/")
    out = given.join(verdicts(spark, there).select(name("file").alias("name"), "rows", "fault"), name("file") == F.col("name"), "left")
    absent = F.when(F.col("file").isNull(), F.lit("the input can't be read")).when(F.col("rows").isNull(), F.lit("the input is empty"))
    message = F.coalesce(absent, "fault", F.lit(""))
    return out.select("path", F.when(message == "", F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"), message.alias("message"))
