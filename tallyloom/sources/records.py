"""Records of CSV files with line breaks inside quotes, cut by as many tasks as a file has blocks.

Whether a line ends inside quotes depends on whether it began there, and so on back to the start of the file. So each line is taken
as a function of two states, outside and inside, and these functions are composed: within a block in the order of its
lines, over the blocks of a file by a running window. Each block then knows how it begins and is cut on its own; records that cross
blocks are put together from one piece a block. Lines are shuffled once, by block; all steps are built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

# File position of a raw row; rows of one file order by it, files by name.
FILE, BLOCK, ROW = "_file", "_block", "_row"

# What a line or block does: bit 0 is set if it ends inside quotes having begun outside, bit 1 if having begun inside.
OUTSIDE, SWAP, KEEP, INSIDE = range(4)

# A quoted stretch at the start of a field or right after another one (a doubled quote within a field), and
# a quote that opens a field.
_STRETCH = r'((?:^|,)|\G)"[^"]*+"'
_OPENING = r'(?:^|,)"'


def _opens(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside. A quote elsewhere than at the start of a field is text."""
    return F.regexp_replace(line, _STRETCH, "$1").rlike(_OPENING).cast("int")


def line_effect(line: Column) -> Column:
    quoted = _opens(line) + 2 * _opens(F.concat(F.lit('"'), line))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(KEEP)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their position. A block lies in one partition, its lines in order."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
        "value",
    )


def has_breaks(lines: DataFrame) -> bool:
    """Whether any record has a line break inside quotes: outside is where every file begins."""
    return not lines.where(line_effect(F.col("value")).bitwiseAND(1) == 1).isEmpty()


def _composed(frame: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds the effect of everything in ``by`` from its start up to each row: ``fixed``, whether it ends alike from both states, and
    ``turned``, the state in which it ends having begun outside.

    The last row that fixes the state counts, turned by each swap since.
    """
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    effect = F.col("effect")
    swaps = frame.withColumn("swaps", F.sum((effect == SWAP).cast("int")).over(upto))
    fixing = F.when(effect.isin(OUTSIDE, INSIDE), F.struct(order, effect.bitwiseAND(1).alias("to"), "swaps"))
    last = swaps.withColumn("last", F.max(fixing).over(upto))
    turns = F.col("swaps") - F.coalesce("last.swaps", F.lit(0)) + F.coalesce("last.to", F.lit(0))
    return last.withColumns({"fixed": F.col("last").isNotNull(), "turned": turns % 2}).drop("swaps", "last")


def _after(start: Column) -> Column:
    """1 if a row of ``_composed`` ends inside, for the state in which the composition began."""
    return F.when(F.col("fixed"), F.col("turned")).otherwise((F.col("turned") + start) % 2)


def open_blocks(lines: DataFrame) -> DataFrame:
    """(tag, block) of the blocks that begin inside quotes; tag names the file.

    Only lines that change the state are sent to find the effect of a block; then there is one row a block.
    """
    tagged = lines.select(F.xxhash64(FILE).alias("tag"), F.col(BLOCK).alias("block"), ROW, line_effect(F.col("value")).alias("effect"))
    changing = _composed(tagged.where(F.col("effect") != KEEP), ["tag", "block"], ROW)
    ends = changing.groupBy("tag", "block").agg(F.max_by(F.struct("fixed", "turned"), ROW).alias("end"))
    whole = F.when(F.col("end.fixed"), F.col("end.turned") * INSIDE).when(F.col("end.turned") == 1, SWAP)
    blocks = tagged.select("tag", "block").distinct().join(ends, ["tag", "block"], "left")
    blocks = blocks.select("tag", "block", F.coalesce(whole, F.lit(KEEP)).alias("effect"))
    after = _composed(blocks, ["tag"], "block").withColumn("after", _after(F.lit(0)))
    begins = F.lag("after", 1, 0).over(Window.partitionBy("tag").orderBy("block"))
    return after.select("tag", "block", begins.alias("inside")).where("inside = 1").select("tag", "block")


def cut(lines: DataFrame) -> DataFrame:
    """(file position, record, first): the records of the files, without empty lines; ``first`` marks each file's header."""
    opened = stored(open_blocks(lines), "open-blocks").select("tag", F.col("block").alias(BLOCK), F.lit(1).alias("inside"))
    empty = F.col("value").isin("", "\r")
    tagged = lines.select(
        "*", line_effect(F.col("value")).alias("effect"), F.xxhash64(FILE).alias("tag"), (~empty).cast("int").alias("filled")
    )
    known = tagged.join(opened, ["tag", BLOCK], "left").withColumn("inside", F.coalesce("inside", F.lit(0)))
    block = Window.partitionBy("tag", BLOCK).orderBy(ROW)
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = _composed(known, ["tag", BLOCK], ROW).withColumn("after", _after(F.col("inside")))
    states = states.withColumn("before", F.coalesce(F.lag("after").over(block), F.col("inside")))
    first = (F.col(BLOCK) == 0) & (F.col("filled") == 1) & (F.sum("filled").over(upto) == 1)
    # nearly all records are one line and need no more than their states
    placed = states.select(
        FILE, "tag", BLOCK, ROW, "value", "before", "after", "filled", first.alias("first"),
        F.sum(1 - F.col("before")).over(upto).alias("n"),
    )
    alone = placed.where("before = 0 AND after = 0 AND filled = 1")
    alone = alone.select(FILE, BLOCK, ROW, _record(F.col("value")), "first")
    pieces = placed.where("before = 1 OR after = 1").groupBy(FILE, "tag", BLOCK, "n").agg(
        F.min(ROW).alias(ROW),
        _lines_joined(F.struct(ROW, "value")).alias("record"),
        F.bool_or("first").alias("first"),
        F.bool_or(F.col("before") == 0).alias("begins"),
        F.bool_or(F.col("after") == 0).alias("ends"),
    )
    whole = pieces.where("begins AND ends").select(FILE, BLOCK, ROW, _record(F.col("record")), "first")
    # at most two pieces a block
    apart = stored(pieces.where("NOT (begins AND ends)"), "record-pieces")
    place = Window.partitionBy("tag").orderBy(BLOCK, ROW)
    numbered = apart.withColumn("piece", F.sum(F.col("begins").cast("int")).over(place))
    joined = numbered.groupBy(FILE, "tag", "piece").agg(
        F.min(BLOCK).alias(BLOCK),
        F.min_by(ROW, F.struct(BLOCK, ROW)).alias(ROW),
        _lines_joined(F.struct(BLOCK, ROW, F.col("record").alias("value"))).alias("record"),
        F.bool_or("first").alias("first"),
    )
    joined = joined.select(FILE, BLOCK, ROW, _record(F.col("record")), "first")
    return alone.unionByName(whole).unionByName(joined)


def _lines_joined(lines: Column) -> Column:
    """Aggregate: the values of structs that end with ``value``, in the order of what stands before it."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(lines)), lambda line: line["value"]), "\n")


def _record(text: Column) -> Column:
    """Of a record that ends in CR LF the reader has left the CR; its other line breaks are then CR LF too."""
    bare = F.replace(F.rtrim(text, F.lit("\r")), F.lit("\r\n"), F.lit("\n"))
    return F.when(F.endswith(text, F.lit("\r")), bare).otherwise(text).alias("record")
