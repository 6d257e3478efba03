"""Repair, re-assembly and shape audit of single-quoted delimited text.

Input is a table of lines: (file, line_no, text), line_no counting from 0
within its file. Whether a line starts a record depends on how far the lines
before it have got through the record's columns, so each line needs a value
carried over all earlier lines of its file. That carry is an associative scan:
a block of lines is summarised by where it leads from every possible column,
summaries of blocks are combined level by level, and entry values are handed
back down. No task ever holds more than one block, however long a file is, and
malformed lines are treated exactly as a line-by-line reading would.

The carried value packs (records started so far) * cols + (column reached).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstar.functions.text import escape_quotes
from fieldstar.session import stage

SPLITTER = "','"  # fixed value: what separates two single-quoted fields
ESCAPED_SPLITTER = "'',''"  # the splitter once every quote is doubled
BLOCK = 1024  # lines (or block summaries) per group
CHUNK = 32  # of a block, while its entries are worked out
PIECE_LINES = 4096  # of a record that comes in pieces
MOST_LINES = 100_000  # of a record that is parsed


def field_count_by_splitter(c: Column) -> Column:
    """Number of fields in a line of single-quoted text."""
    cut = F.length(F.replace(c, F.lit(SPLITTER), F.lit("")))
    return ((F.length(c) - cut) / len(SPLITTER) + 1).cast("long")


def _advance(value: Column, fields: Column, cols: int) -> Column:
    """Carry value after a line with that many fields.

    A line that lands on the last column ends its record; otherwise its last
    field continues on the next line and is counted there once more.
    """
    column = F.pmod(value, F.lit(cols))
    reached = column + fields
    ended = F.pmod(reached, F.lit(cols)) == 0
    begun = F.when(column == 0, F.lit(cols)).otherwise(F.lit(0))
    return value - column + begun + F.when(ended, F.lit(0)).otherwise(F.pmod(reached - 1, F.lit(cols)))


def _jump(value: Column, table: Column, cols: int) -> Column:
    """Carry value after a whole block, given the block's summary."""
    column = F.pmod(value, F.lit(cols))
    return value - column + F.element_at(table, (column + 1).cast("int"))


def _blocks(df: DataFrame, index: str, payload: list[str]) -> DataFrame:
    """Group consecutive rows of a file into arrays of at most BLOCK, in order."""
    rows = F.array_sort(F.collect_list(F.struct(index, *payload)))
    number = F.floor(F.col(index) / BLOCK).cast("long")
    return df.withColumn("block", number).groupBy("file", "block").agg(rows.alias("rows"))


def _dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt by key to as many tasks as a shuffle has, however few bytes they are.

    Working out a block takes far longer than its few numbers are large, so
    tasks must not be merged by size.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _leads(step: str, cols: int) -> Column:
    """Where a block of rows leads from each column."""

    def through(table: Column, row: Column) -> Column:
        if step == "fields":
            return F.transform(table, lambda v: _advance(v, row["fields"], cols))
        return F.transform(table, lambda v: _jump(v, row["leads"], cols))

    identity = F.sequence(F.lit(0).cast("long"), F.lit(cols - 1).cast("long"))
    return F.aggregate("rows", identity, through)


def _summaries(df: DataFrame, index: str, step: str, cols: int) -> DataFrame:
    """One row per block: where it leads from each column."""
    return _blocks(df, index, [step]).select("file", "block", _leads(step, cols).alias("leads"))


def _bound(value: Column, use) -> Column:
    """`use(value)`, the value being computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _entries(rows: Column, entry: Column, move) -> Column:
    """The carry value each row of a block is entered with, chunk by chunk so that appending stays cheap."""

    def through(values: Column, start: Column) -> Column:
        none = F.array().cast("array<bigint>")
        first = F.struct(start.cast("long").alias("value"), none.alias("entries"))

        def step(acc: Column, row: Column) -> Column:
            seen = F.array_append(acc["entries"], acc["value"])
            return F.struct(move(acc["value"], row).alias("value"), seen.alias("entries"))

        return F.aggregate(values, first, step)

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / CHUNK).cast("int")), lambda c: F.slice(rows, c * CHUNK + 1, CHUNK)
    )
    none = F.array().cast("array<array<bigint>>")
    first = F.struct(entry.cast("long").alias("value"), none.alias("entries"))

    def step(acc: Column, chunk: Column) -> Column:
        return _bound(
            through(chunk, acc["value"]),
            lambda g: F.struct(g["value"].alias("value"), F.array_append(acc["entries"], g["entries"]).alias("entries")),
        )

    return F.flatten(F.aggregate(chunks, first, step)["entries"])


def _with_entries(blocks: DataFrame, entry: Column, move, out: str) -> DataFrame:
    """Unnest blocks, giving each row the carry value it is entered with."""
    paired = F.arrays_zip(F.col("rows").alias("row"), _entries(F.col("rows"), entry, move).alias(out))
    cells = blocks.withColumn("_cell", F.explode(paired))
    return cells.select("file", "_cell.row.*", F.col(f"_cell.{out}").alias(out))


def carries(lines: DataFrame, cols: int) -> DataFrame:
    """(file, line_no, starts, ends, record, cuts) of each line, written once: all that repair needs besides the text."""
    fields = field_count_by_splitter(F.col("text")).alias("fields")
    number = F.floor(F.col("line_no") / BLOCK).cast("long")
    dealt = _dealt(lines.select("file", "line_no", fields).withColumn("block", number), "file", "block")
    blocks = _blocks(dealt, "line_no", ["fields"])
    blocks = stage(blocks.withColumn("leads", _leads("fields", cols)), "line-blocks")

    levels = [blocks.select("file", "block", "leads")]
    reach = levels[0].agg(F.max("block")).first()[0] or 0
    while reach > 0:
        upper = _summaries(levels[-1].withColumnRenamed("block", "index"), "index", "leads", cols)
        levels.append(stage(upper, "blocks"))
        reach //= BLOCK

    entries = levels.pop().select("file", "block", F.lit(0).cast("long").alias("entry"))
    for level in reversed(levels):
        groups = _blocks(level.withColumnRenamed("block", "index"), "index", ["leads"])
        entered = groups.join(entries, ["file", "block"])
        entries = _with_entries(
            entered, F.col("entry"), lambda v, row: _jump(v, row["leads"], cols), "entry"
        ).select("file", F.col("index").alias("block"), "entry")

    entered = blocks.select("file", "block", "rows").join(entries, ["file", "block"])
    carried = _with_entries(entered, F.col("entry"), lambda v, row: _advance(v, row["fields"], cols), "_carry")
    before, after = F.col("_carry"), _advance(F.col("_carry"), F.col("fields"), cols)
    flags = carried.select(
        "file",
        "line_no",
        (F.pmod(before, F.lit(cols)) == 0).alias("starts"),
        (F.pmod(after, F.lit(cols)) == 0).alias("ends"),
        F.floor(after / cols).cast("long").alias("record"),
        (F.col("fields") - 1).alias("cuts"),
    )
    return stage(flags, "carries")


def carry_columns(lines: DataFrame, cols: int) -> DataFrame:
    """Add to each line: `starts` and `ends` a record (flags), and `record` (1, 2, ...)."""
    return _with_text(lines, carries(lines, cols)).drop("cuts")


def _with_text(lines: DataFrame, carried: DataFrame) -> DataFrame:
    return lines.select("file", "line_no", "text").join(carried, ["file", "line_no"])


def repair_quotes(lines: DataFrame, cols: int) -> DataFrame:
    """Double every quote inside fields, keeping those that bound fields and records.

    All quotes are doubled first, then splitters and record edges put back.
    """
    return carry_columns(lines, cols).withColumn("text", _repaired())


def _repaired() -> Column:
    escaped = F.replace(escape_quotes(F.col("text")), F.lit(ESCAPED_SPLITTER), F.lit(SPLITTER))
    opened = F.when(F.col("starts"), F.regexp_replace(escaped, "^''", "'")).otherwise(escaped)
    return F.when(F.col("ends"), F.regexp_replace(opened, r"''(\s*)$", "'$1")).otherwise(opened)


def assemble_records(lines: DataFrame, cols: int) -> DataFrame:
    """Join the lines of each record: (file, record, piece, text).

    A record of up to `PIECE_LINES` lines is one piece, number 0. A longer one,
    such as the rest of a file behind a quote that never closes, comes in
    pieces of that many lines: its text is its pieces' in order, joined by line
    breaks, and is never put together in one row or task.
    """
    carried = carries(lines, cols)
    return join_pieces(_with_text(lines, carried), PIECE_LINES, carried)


def join_pieces(carried: DataFrame, piece_lines: int = PIECE_LINES, numbers: DataFrame | None = None) -> DataFrame:
    """Join lines that already carry their record number, piece by piece.

    `numbers` may give the lines' records without their text.
    """
    reach = (carried if numbers is None else numbers).groupBy("file", "record").agg(F.min("line_no").alias("_from"), F.max("line_no").alias("_to"))
    # Few records are that long, if any: only these cost the lines a look-up.
    long = stage(reach.filter(F.col("_to") - F.col("_from") >= piece_lines).drop("_to"), "long-records")
    placed = carried.join(long, ["file", "record"], "left")
    piece = F.coalesce(F.floor((F.col("line_no") - F.col("_from")) / piece_lines), F.lit(0)).cast("long")
    return _joined(placed.withColumn("piece", piece), "file", "record", "piece")


def join_lines(carried: DataFrame) -> DataFrame:
    """Join lines that already carry their record number, each record in one row."""
    return _joined(carried, "file", "record")


def _joined(lines: DataFrame, *by: str) -> DataFrame:
    pieces = F.array_sort(F.collect_list(F.struct("line_no", "text")))
    text = F.array_join(F.transform(pieces, lambda p: p["text"]), "\n")
    return lines.groupBy(*by).agg(text.alias("text"))


def running_total(lines: DataFrame, value: str, out: str) -> DataFrame:
    """Add the sum of a column over all earlier lines of the file.

    Sums of blocks are carried over a file, sums of lines over a block: no
    task orders a whole file's lines.
    """
    return _totalled(_in_blocks(lines), value, out).drop("_block")


def _in_blocks(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_block", F.floor(F.col("line_no") / BLOCK).cast("long"))


def _totalled(placed: DataFrame, value: str, out: str) -> DataFrame:
    """`running_total` of lines with their block, which they keep: a second total moves no line again."""
    sums = placed.groupBy("file", "_block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("file", "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy("file", "_block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = own.join(sums, ["file", "_block"])
    return joined.withColumn(out, F.col("_carried") + F.col("_own")).drop("_own", "_carried")


def quoted_lines(lines: DataFrame, quote: str = '"', sep: str = ",") -> DataFrame:
    """Add to each line of well-quoted text: `record` (1, 2, ...) and `cuts`, its separators outside quotes.

    A line starts a record where the quotes before it are even in number.
    """
    quotes = (F.length("text") - F.length(F.replace(F.col("text"), F.lit(quote), F.lit("")))).cast("long")
    edge = lambda when: F.when(when, F.lit(quote)).otherwise(F.lit(""))

    def cuts(inside: bool) -> Column:
        open_end = F.col("_quotes") % 2 == (0 if inside else 1)
        text = F.concat(F.lit(quote if inside else ""), F.col("text"), edge(open_end))
        bare = F.regexp_replace(text, f"{quote}[^{quote}]*{quote}", "")
        return ((F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep)).cast("long")

    # Cut both ways before it is known which holds: who asks for widths only moves numbers, no text.
    both = _in_blocks(lines).withColumn("_quotes", quotes).withColumns({"_out": cuts(False), "_in": cuts(True)})
    counted = _totalled(both, "_quotes", "_before")
    inside = F.col("_before") % 2 == 1
    cut = counted.withColumn("cuts", F.when(inside, F.col("_in")).otherwise(F.col("_out")))
    cut = cut.withColumn("_starts", F.when(inside, 0).otherwise(1).cast("long"))
    numbered = _totalled(cut, "_starts", "_started")
    record = (F.col("_started") + F.col("_starts")).alias("record")
    return numbered.select("file", "line_no", "text", record, "cuts")


def card_lines(lines: DataFrame, cols: int, numbers: DataFrame | None = None) -> DataFrame:
    """Single-quoted lines repaired, with `record` and `cuts` as `quoted_lines` has them.

    `numbers` may give the lines' `carries`, where these are needed besides.
    """
    carried = _with_text(lines, carries(lines, cols) if numbers is None else numbers)
    return carried.select("file", "line_no", _repaired().alias("text"), "record", "cuts")


def record_widths(lines: DataFrame) -> DataFrame:
    """(file, record, first_line, fields, size): sums over the lines of each record, without its text."""
    return lines.groupBy("file", "record").agg(
        F.min("line_no").alias("first_line"),
        (F.sum("cuts") + 1).cast("int").alias("fields"),
        F.count("*").alias("size"),
    )


def _sound(widths: DataFrame, cols: int) -> Column:
    return (F.col("fields") == cols) & (F.col("size") <= MOST_LINES)


def width_faults(lines: DataFrame, cols: int, numbers: DataFrame | None = None) -> DataFrame:
    """Records whose field count is not the declared one: file, record, first_line, fields, text of that line.

    A quote that never closes makes the rest of its file one such record; it
    is reported without being put together, even if its width happens to be
    the declared one: no record has more than `MOST_LINES` lines. `numbers` may
    give the lines' records and cuts without their text.
    """
    widths = record_widths(lines if numbers is None else numbers)
    wrong = stage(widths.filter(~_sound(widths, cols)).drop("size"), "width-faults")
    # One small row per block of lines says which of them are asked for: other lines' text is not moved to the faults.
    asked = wrong.groupBy("file", F.floor(F.col("first_line") / BLOCK).cast("long").alias("_asked")).agg(
        F.collect_set((F.col("first_line") % BLOCK).cast("short")).alias("_lines")
    )
    placed, asked = _in_blocks(lines.select("file", "line_no", "text")), asked.withColumnRenamed("file", "_of")
    own = F.array_contains("_lines", (F.col("line_no") % BLOCK).cast("short"))
    met = (F.col("file") == F.col("_of")) & (F.col("_block") == F.col("_asked")) & own
    first = placed.join(asked, met, "left_semi").select("file", F.col("line_no").alias("first_line"), "text")
    return wrong.join(first, ["file", "first_line"])


def parsed_records(
    lines: DataFrame, names: Sequence[str], quote: str, sep: str = ",", numbers: DataFrame | None = None
) -> DataFrame:
    """Cells of all sound records (see `width_faults`), parsed one record at a time: file, record and the columns.

    `numbers` may give the lines' records and cuts without their text.
    """
    schema = ", ".join(f"`{n}` string" for n in names)
    return typed_records(lines, schema, len(names), {"sep": sep, "quote": quote, "escape": quote}, numbers)


def typed_records(
    lines: DataFrame, schema: str, cols: int, options: dict[str, str], numbers: DataFrame | None = None
) -> DataFrame:
    """The same with typed columns and the parser's options given."""
    widths = record_widths(lines if numbers is None else numbers)
    whole = widths.filter(_sound(widths, cols)).select("file", "record")
    records = join_lines(lines.join(whole, ["file", "record"]))
    cells = F.from_csv("text", schema, {"mode": "PERMISSIVE", **options})
    return records.select("file", "record", cells.alias("_cells")).select("file", "record", "_cells.*")


def header_names(lines: DataFrame, quote: str, sep: str = ",") -> list[str]:
    """Column names in the first record, on one line, of the first file."""
    first = lines.filter("record = 1 and line_no = 0").orderBy("file").limit(1)
    width = first.select((F.col("cuts") + 1).alias("n")).first()
    if width is None:
        return []
    schema = ", ".join(f"c{i} string" for i in range(width["n"]))
    options = {"sep": sep, "quote": quote, "escape": quote}
    return list(first.select(F.from_csv("text", schema, options).alias("c")).select("c.*").first())


def field_count(c: Column, sep: str = ",", quote: str | None = "'") -> Column:
    """Fields in one record, not counting separators inside quoted fields."""
    bare = F.regexp_replace(c, f"{quote}[^{quote}]*{quote}", "") if quote else c
    cut = F.length(F.replace(bare, F.lit(sep), F.lit("")))
    return ((F.length(bare) - cut) / len(sep) + 1).cast("int")


def bad_width(records: DataFrame, cols: int, sep: str = ",", quote: str | None = "'", text: str = "text") -> DataFrame:
    """All records whose field count is not the declared one, with that count."""
    counted = records.withColumn("fields", field_count(F.col(text), sep, quote))
    return counted.filter(F.col("fields") != cols)
