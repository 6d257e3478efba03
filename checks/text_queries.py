"""Markup rows and the repair, assembly and audit of quoted text."""

from pyspark.sql import functions as F

from checks.registry import VIEWS, query, table, view
from fieldstar.operators import textrepair
from fieldstar.session import delete_path, staging_path
from fieldstar.sources.html import LIST_ITEM, html_rows
from fieldstar.sources.text import read_lines

COLS = 3


def quoted_lines(spark, sf_dir, split_docs=None):
    """Lines of the documents as single-quoted records that span two lines each."""
    split_docs = view(spark, sf_dir, "split_docs") if split_docs is None else split_docs
    lines = split_docs.select(
        F.col("doc_id").alias("file"),
        F.size("parts").alias("n"),
        F.posexplode("parts").alias("p", "part"),
    )
    p = F.col("p")
    opened = F.concat(F.lit("'"), F.col("file"), F.lit("','"), F.col("part"))
    first = F.when(p == F.col("n") - 1, F.concat(opened, F.lit("','end'"))).otherwise(opened)
    text = F.when(p % 2 == 0, first).otherwise(F.concat("part", F.lit("','end'")))
    return lines.select("file", p.cast("long").alias("line_no"), text.alias("text"))


def written_cards(spark, sf_dir):
    """Path of text files that hold these lines, many documents to a file.

    Documents are dealt by id before they are cut, which also spreads a raw table: their text moves once.
    """
    path = staging_path(spark, "cards")
    dealt = table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    lines = quoted_lines(spark, sf_dir, spark.sql(VIEWS["split_docs"], documents=dealt))
    lines.sortWithinPartitions("file", "line_no").select("text").write.text(path)
    return path


LINES = """
select doc_id as file, n, p, case when p % 2 = 1 then part || chr(39) || ',' || chr(39) || 'end' || chr(39)
  when p = n - 1 then chr(39) || doc_id || chr(39) || ',' || chr(39) || part || chr(39) || ',' || chr(39) || 'end' || chr(39)
  else chr(39) || doc_id || chr(39) || ',' || chr(39) || part end as text, part
from (select doc_id, len(parts) as n, unnest(parts) as part, generate_subscripts(parts, 1) - 1 as p from (
  select doc_id, string_split(replace(text, 'e ', chr(39) || 'e '), chr(10)) as parts from {documents}))
"""


@query(
    "quote_repair",
    f"""select file, p as line_no, case when p % 2 = 1 then q || chr(39) || ',' || chr(39) || 'end' || chr(39)
      when p = n - 1
        then chr(39) || file || chr(39) || ',' || chr(39) || q || chr(39) || ',' || chr(39) || 'end' || chr(39)
      else chr(39) || file || chr(39) || ',' || chr(39) || q end as text
    from (select *, replace(part, chr(39), chr(39) || chr(39)) as q from ({LINES}))""",
)
def quote_repair(spark, sf_dir):
    return textrepair.repair_quotes(quoted_lines(spark, sf_dir), COLS).select("file", "line_no", "text")


@query(
    "record_assembly",
    f"""select file, p // 2 + 1 as record, string_agg(text, chr(10) order by p) as text from ({LINES})
    group by file, p // 2""",
)
def record_assembly(spark, sf_dir):
    records = textrepair.assemble_records(quoted_lines(spark, sf_dir), COLS)
    return records.select("file", "record", "text")


@query(
    "bad_width",
    """select doc_id, line_no, len(string_split(text, ', ')) as fields, text from (
      select doc_id, unnest(string_split(text, chr(10))) as text,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from {documents})
    where len(string_split(text, ', ')) <> 3""",
)
def bad_width(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    wrong = textrepair.bad_width(lines, 3, sep=", ", quote=None)
    return wrong.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("fields").cast("long").alias("fields"), "text")


@query(
    "html_rows",
    r"""select page_id, row, nullif(trim(regexp_replace(replace(replace(replace(replace(replace(replace(
        regexp_replace(item, '<[^>]*>', '', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
        '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')), '') as item
    from (select page_id, unnest(items) as item, generate_subscripts(items, 1) - 1 as row from (
      select page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1) as items from {pages}))""",
)
def html_rows_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    rows = html_rows(pages, "html", ["item"], row_regex=LIST_ITEM, cell_regex=None)
    return rows.select("page_id", F.col("row").cast("long").alias("row"), "item")


@query(
    "card_file_lines",
    f"""select case when p % 2 = 1 then q || chr(39) || ',' || chr(39) || 'end' || chr(39)
      when p = n - 1
        then chr(39) || file || chr(39) || ',' || chr(39) || q || chr(39) || ',' || chr(39) || 'end' || chr(39)
      else chr(39) || file || chr(39) || ',' || chr(39) || q end as text
    from (select *, replace(part, chr(39), chr(39) || chr(39)) as q from ({LINES}))""",
)
def card_file_lines(spark, sf_dir):
    """The same repair over text files on disk, many documents to a file."""
    path = written_cards(spark, sf_dir)
    return textrepair.repair_quotes(read_lines(spark, path, "UTF-8"), COLS).select("text")


@query(
    "card_file_table",
    f"""select file as id, string_agg(part, chr(10) order by p) as body, 'end' as mark from ({LINES}) group by file, p // 2""",
)
def card_file_table(spark, sf_dir):
    """Cells of single-quoted files on disk: repaired, put together and parsed, cells of one or two lines."""
    path = written_cards(spark, sf_dir)
    numbered = read_lines(spark, path, "UTF-8")
    numbers = textrepair.carries(numbered, COLS)
    cut = textrepair.card_lines(numbered, COLS, numbers)
    cells = textrepair.parsed_records(cut, ["id", "body", "mark"], "'", numbers=numbers)
    return cells.select(F.col("id").cast("long").alias("id"), "body", "mark")


@query(
    "card_file_faults",
    """select kind, len(string_split(text, chr(10))[1]) as width, fields, count(*) as n from (
      select 'double' as kind, case when doc_id % 10 = 3 then 2 else 4 end as fields,
        chr(34) || doc_id || chr(34) || ',' || chr(34) || replace(text, chr(34), chr(34) || chr(34)) || chr(34) as text
      from {documents} where doc_id % 10 in (3, 7)
      union all select 'single', case when doc_id % 10 = 3 then 2 else 4 end,
        chr(39) || doc_id || chr(39) || ',' || chr(39) || replace(text, chr(39), chr(39) || chr(39)) || chr(39)
      from {documents} where doc_id % 10 in (3, 7)) group by all""",
)
def card_file_faults(spark, sf_dir):
    """Files of both quotes whose cells hold line breaks: only records of another width are faults."""
    found = []
    for kind, quote in (("double", '"'), ("single", "'")):
        path = staging_path(spark, "cards")
        doubled = F.replace(F.col("text"), F.lit(quote), F.lit(quote * 2))
        cell = lambda c: F.concat(F.lit(quote), c, F.lit(quote))  # noqa: E731, B023
        end = F.when(F.col("doc_id") % 10 == 3, F.array())
        end = end.when(F.col("doc_id") % 10 == 7, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1")))
        cells = F.concat(F.array(cell(F.col("doc_id").cast("string")), cell(doubled)), end)
        table(spark, sf_dir, "documents").select(F.array_join(cells, ",")).write.text(path)
        lines = read_lines(spark, path, "UTF-8")
        delete_path(spark, path)  # its lines are staged: it is not read again
        faults = textrepair.width_faults(lines, COLS, textrepair.quoted_lines(lines, quote))
        # What follows the text on its last line is no part of the first line's width.
        own = F.regexp_replace("text", f"{quote}(,1,2)?$", quote)
        found.append(faults.select(F.lit(kind).alias("kind"), F.length(own).cast("long").alias("width"), F.col("fields").cast("long").alias("fields")))
    both = found[0].unionByName(found[1])
    return both.groupBy("kind", "width", "fields").agg(F.count("*").alias("n"))
