import random

import pytest

from fieldstar.operators import textrepair


def line_by_line(lines, cols):
    """(starts, ends, record) of each line, reading one after the other."""
    column, record, out = 0, 0, []
    for text in lines:
        starts = column % cols == 0
        record += starts
        column += text.count("','") + 1
        if column % cols:
            column -= 1
        out.append((starts, column % cols == 0, record))
    return out


def line_table(spark, files):
    rows = [(f, i, t) for f, lines in files.items() for i, t in enumerate(lines)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "file string, line_no long, text string")


@pytest.mark.parametrize("cols", [1, 2, 3, 7])
def test_carry_equals_line_by_line_even_when_malformed(spark, monkeypatch, cols):
    monkeypatch.setattr(textrepair, "BLOCK", 4)  # many levels from few lines
    rng = random.Random(cols)
    files = {
        f"f{n}": ["','".join("x" for _ in range(rng.choice([cols, cols, 1, 2, cols + 1]))) for _ in range(n)]
        for n in (1, 4, 5, 70, 300)
    }
    out = textrepair.carry_columns(line_table(spark, files), cols)
    got = {(r.file, r.line_no): (r.starts, r.ends, r.record) for r in out.collect()}
    want = {(f, i): v for f, lines in files.items() for i, v in enumerate(line_by_line(lines, cols))}
    assert got == want


def test_repair_and_assembly(spark, rows):
    lines = ["'1','it's a', 'x','end'", "'2','two", "lines','end'  ", "'3','','''"]
    table = line_table(spark, {"f": lines})
    fixed = [r.text for r in textrepair.repair_quotes(table, 3).orderBy("line_no").collect()]
    assert fixed == ["'1','it''s a'', ''x','end'", "'2','two", "lines','end'  ", "'3','',''''"]
    records = textrepair.assemble_records(table, 3)
    assert rows(records, "record", "text")[1] == (2, "'2','two\nlines','end'  ")


def test_bad_width_ignores_quoted_separators(spark, rows):
    df = spark.createDataFrame([(1, "'a,b','c'"), (2, "'a','b','c'"), (3, "x")], "id int, text string")
    assert rows(textrepair.bad_width(df, 2), "id", "fields") == [(2, 3), (3, 1)]


def test_repair_equals_field_by_field_on_random_quotes(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice("'','x ") for _ in range(rng.randrange(14))) for _ in range(600)]
    flags = line_by_line(lines, 3)

    def by_field(text, starts, ends):
        fields = [f.replace("'", "''") for f in text.split("','")]
        if starts and fields[0].startswith("''"):
            fields[0] = fields[0][1:]
        bare = fields[-1].rstrip()
        if ends and bare.endswith("''"):
            fields[-1] = bare[:-1] + fields[-1][len(bare) :]
        return "','".join(fields)

    out = textrepair.repair_quotes(line_table(spark, {"f": lines}), 3)
    got = [r.text for r in out.orderBy("line_no").collect()]
    assert got == [by_field(t, starts, ends) for t, (starts, ends, _) in zip(lines, flags)]
