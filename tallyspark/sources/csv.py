"""Typed CSV loading with the warehouse's file-format options and bad-row
policies.

Files are read line by line in splits, as text.  A quoted field may hold
delimiters, doubled quotes and line breaks, so a line is a record only if no
quote is open at its borders.  Each line is reduced to what it does to that
state (``open_after`` for both states it may start in); these effects are
composed along the lines of a split, the splits' effects along a file (one row
per split), and only splits in which a quote stays open at some line's end have
their lines put in order and joined to records.  No file is read by one task.

Every record is split by ``from_csv`` into text fields, cleaned of null tokens
and cast.  A record is bad if its number of fields is wrong, a field that is
not a null token does not cast, or its quote never closes; all declared columns
take part in that test whatever columns a query selects later, and no session
setting changes it.

* ``on_error='continue'``: bad records are set aside as they stand in the file,
  the rest loads.
* ``on_error='abort'``: the first bad record fails whatever reads the table.

Line breaks inside quotes are read as LF, whatever the file's are.  Blank lines
outside quotes are skipped; the header is the first other line of a file.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.sizing import lookup_join
from tallyspark.operators.views import materialize

CORRUPT = "_corrupt_record"
LINE, FILE, SPLIT, OPEN = "_line", "_file", "_split", "_open"


@dataclass(frozen=True)
class CsvFormat:
    delimiter: str = ","
    header: bool = True
    quote: str = '"'
    null_tokens: Sequence[str] = field(default_factory=lambda: ("null", ""))
    date_format: str = "yyyy-MM-dd"
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
    #: A quoted field that runs over more lines than this counts as not closed.
    max_record_lines: int = 10_000


def raw_lines(reader, path: str) -> DataFrame:
    """The lines below ``path`` (batch or stream) with file and split."""
    return reader.format("text").load(path).select(
        F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(SPLIT))


def open_after(line: Column, fmt: CsvFormat, inside: bool) -> Column:
    """Whether a quote is open after ``line`` (1 or 0) that starts ``inside`` a
    quoted field or not.  A quote opens a field only at its start (elsewhere it
    is a plain character), the next one closes it, unless it is doubled."""
    parts = F.split(line, "\\Q" + fmt.quote + "\\E", -1)
    outside, within, closed = F.lit(0), F.lit(1), F.lit(2)

    def step(state, text):
        """State 0, 1, 2: outside, inside, right after a closing quote.
        ``before`` is the text since the last quote, or the field's start."""
        before, was = state["before"], state["state"]
        opens = F.endswith(before, F.lit(fmt.delimiter)) | ((was == closed) & (before == ""))
        now = F.when(was == within, closed).when(opens, within).otherwise(outside)
        return F.struct(now.alias("state"), text.alias("before"))

    head = F.element_at(parts, 1)
    start = F.struct((within if inside else outside).alias("state"),
                     (head if inside else F.concat(F.lit(fmt.delimiter), head)).alias("before"))
    end = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), start, step)
    none = F.lit(int(inside))
    return F.when(F.contains(line, F.lit(fmt.quote)), F.when(end["state"] == within, 1).otherwise(0)).otherwise(none)


def state_before(df: DataFrame, by: Sequence[str], order: Sequence[str], entering: Column, name: str) -> DataFrame:
    """``df`` plus ``name``: the state before each row, where a row turns state
    0 into ``_from0`` and 1 into ``_from1``.  It is that of the last row with a
    fixed outcome, turned by every row since that exchanges the two."""
    earlier = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when(F.col("_from0") > F.col("_from1"), 1).otherwise(0)
    df = df.withColumn("_turned", F.coalesce(F.sum(turns).over(earlier), F.lit(0)))
    fixed = F.when(F.col("_from0") == F.col("_from1"),
                   F.struct(F.col("_from0").alias("to"), F.col("_turned").alias("at")))
    df = df.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(earlier))
    state = (F.coalesce("_fixed.to", entering) + F.col("_turned") - F.coalesce("_fixed.at", F.lit(0))) % 2
    return df.withColumn(name, state).drop("_turned", "_fixed")


def split_effects(lines: DataFrame) -> DataFrame:
    """One row per split: its first line that is not blank (``_first``), whether
    some line changes the state (``_mixed``), what the split as a whole turns
    the states into, and the state it starts in (``_enter``); ``_head``: the
    file's first line.  A split's changing lines meet in one row, bounded by the
    split's size."""
    changing = (F.col("_from0") == 1) | (F.col("_from1") == 0)
    effects = F.sort_array(F.collect_list(F.when(changing, F.struct("_seq", "_from0", "_from1"))))
    splits = lines.groupBy(FILE, SPLIT).agg(F.min(F.when(F.trim(LINE) != "", F.col("_seq"))).alias("_first"),
                                            effects.alias("_effects"))

    def through(start: int) -> Column:
        return F.aggregate("_effects", F.lit(start), lambda s, e: F.when(s == 0, e["_from0"]).otherwise(e["_from1"]))

    splits = splits.select(FILE, SPLIT, "_first", (F.size("_effects") > 0).alias("_mixed"),
                           through(0).alias("_from0"), through(1).alias("_from1"))
    splits = state_before(splits, [FILE], [SPLIT], F.lit(0), "_enter")
    head = F.min(F.when(F.col("_first").isNotNull(), F.struct(SPLIT, "_first"))).over(Window.partitionBy(FILE))
    return splits.select(FILE, SPLIT, "_enter", head.alias("_head"),
                         (F.col("_mixed") | (F.col("_enter") == 1)).alias("_mixed"))


def records(lines: DataFrame, fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """The records of ``lines`` (``raw_lines``): ``_line``, and ``_open``: a
    quote that does not close holds this line (such lines come one by one)."""
    lines = (lines.withColumn("_seq", F.monotonically_increasing_id())
             .withColumn("_from0", open_after(F.col(LINE), fmt, False))
             .withColumn("_from1", open_after(F.col(LINE), fmt, True)))
    splits = materialize(split_effects(lines), "csv_splits")
    filled = F.trim(LINE) != ""
    near = splits.select(F.col(FILE).alias("_f"), F.col(SPLIT).alias("_s"), "_enter", "_head", "_mixed")
    known = lookup_join(lines, near, (F.col(FILE) == F.col("_f")) & (F.col(SPLIT) == F.col("_s")), "left",
                        max_rows=200_000)
    if fmt.header:
        known = known.filter(~((F.col(SPLIT) == F.col("_head")[SPLIT]) & (F.col("_seq") == F.col("_head._first"))))
    # a column of the split, so that no test of a record is made before the header is out
    plain = known.filter(~F.col("_mixed") & filled).select(LINE, F.col("_enter").isNull().alias(OPEN))
    if splits.filter("_mixed").isEmpty():
        return plain

    mixed = state_before(known.filter("_mixed"), [FILE, SPLIT], ["_seq"], F.col("_enter"), "_before")
    mixed = mixed.withColumn("_after", F.when(F.col("_before") == 0, F.col("_from0")).otherwise(F.col("_from1")))
    inside = (F.col("_before") == 1) | (F.col("_after") == 1)
    single = mixed.filter(~inside & filled).select(LINE, F.lit(False).alias(OPEN))

    # a record's lines are told by its first one; a split may start inside one
    so_far = Window.partitionBy(FILE, SPLIT).orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.when(F.col("_before") == 0, F.struct(F.col(SPLIT).alias("split"), F.col("_seq").alias("seq")))
    parts = mixed.filter(inside).select(FILE, SPLIT, "_seq", LINE, "_after",
                                        F.last(begins, ignorenulls=True).over(so_far).alias("_start"))
    earlier = Window.partitionBy("_f").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    last = parts.groupBy(F.col(FILE).alias("_f"), F.col(SPLIT).alias("_s")).agg(F.max("_start").alias("_last"))
    last = last.select("_f", "_s", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    parts = lookup_join(parts, last, (F.col(FILE) == F.col("_f")) & (F.col(SPLIT) == F.col("_s")), "left",
                        max_rows=200_000)
    parts = parts.withColumn("_start", F.coalesce("_start", "_carried"))
    sizes = parts.groupBy(F.col(FILE).alias("_rf"), F.col("_start").alias("_rs")).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.struct(SPLIT, "_seq", "_after")).alias("_end"))
    sizes = sizes.select("_rf", "_rs", ((F.col("_n") > fmt.max_record_lines) | (F.col("_end._after") == 1)).alias(OPEN))
    parts = lookup_join(parts, sizes, (F.col(FILE) == F.col("_rf")) & (F.col("_start") == F.col("_rs")),
                        max_rows=200_000)
    joined = (parts.filter(~F.col(OPEN)).groupBy(FILE, "_start")
              .agg(F.sort_array(F.collect_list(F.struct(SPLIT, "_seq", LINE))).alias("_all"))
              .select(F.array_join(F.transform("_all", lambda x: x[LINE]), "\n").alias(LINE), F.lit(False).alias(OPEN)))
    return plain.unionByName(single).unionByName(joined).unionByName(
        parts.filter(F.col(OPEN) & filled).select(LINE, OPEN))


def typed_lines(lines: DataFrame, schema: T.StructType, fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """``lines`` (``raw_lines``) as the columns of ``schema`` plus
    ``_corrupt_record`` (the raw record) and ``_ok``."""
    broken = "_tally_broken"
    text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields],
                         T.StructField(broken, T.StringType())])
    options = {"sep": fmt.delimiter, "quote": fmt.quote, "escape": fmt.quote, "mode": "PERMISSIVE", "nullValue": "\u0000",
               "emptyValue": "", "columnNameOfCorruptRecord": broken}
    ddl = ", ".join(f"`{f.name}` string" for f in text.fields)
    raw = records(lines, fmt).select(F.col(LINE).alias(CORRUPT), OPEN, F.from_csv(LINE, ddl, options).alias("_r"))
    tokens = list(fmt.null_tokens)
    typed, ok = [], F.col(f"_r.{broken}").isNull() & ~F.col(OPEN)
    for f in schema.fields:
        c = F.col(f"_r.`{f.name}`")
        if tokens:
            c = F.when(~c.isin(*tokens), c)
        if isinstance(f.dataType, T.DateType):
            cast = F.try_to_timestamp(c, F.lit(fmt.date_format)).cast("date")
        elif isinstance(f.dataType, T.TimestampType):
            cast = F.try_to_timestamp(c, F.lit(fmt.timestamp_format))
        elif isinstance(f.dataType, T.StringType):
            cast = c
        else:
            cast = c.try_cast(f.dataType)
        typed.append(cast.alias(f.name))
        # a non-NULL text that does not cast is a bad row
        ok = ok & (c.isNull() | cast.isNotNull())
    return raw.select(*typed, CORRUPT, ok.alias("_ok"))


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: CsvFormat = CsvFormat(),
               on_error: str = "continue", select: Sequence[Column] | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """Load CSV file(s) at ``path`` into ``schema``.

    Returns (good, rejects).  ``rejects`` has the raw record in ``_corrupt_record``
    (empty for ``abort``).  ``select`` applies a load-time transformation
    (positional fields, casts, literal columns) to the good rows."""
    if on_error not in ("abort", "continue"):
        raise ValueError(on_error)
    rows = typed_lines(raw_lines(spark.read, path), schema, fmt)
    if on_error == "abort":
        failed = F.raise_error(F.concat(F.lit("bad line: "), F.col(CORRUPT))).cast("boolean")
        rows = rows.filter(F.when(F.col("_ok"), F.lit(True)).otherwise(failed))
        rejects = spark.createDataFrame([], f"{CORRUPT} string")
    else:
        rejects = rows.filter(~F.col("_ok")).select(CORRUPT)
        rows = rows.filter("_ok")
    good = rows.drop("_ok", CORRUPT)
    return (good if select is None else good.select(*select)), rejects


def write_csv(df: DataFrame, path: str, fmt: CsvFormat = CsvFormat()) -> str:
    """Export as CSV with header (text columns should be pre-formatted); values
    are written as they are, white space at their ends included."""
    (df.write.mode("errorifexists").option("header", fmt.header).option("sep", fmt.delimiter)
     .option("quote", fmt.quote).option("escape", fmt.quote).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
