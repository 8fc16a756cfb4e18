import csv
import io
import os
import random

import pytest

from conftest import rows
from wellnote.sources.csv_dir import read_csv_text, whole_records

PIECES = ["a", 'say ""x""', "line\nbreak", "two\n\nbreaks", "comma, here", "", 'end ""', "é\r\nx", '""', "\n"]


def quoted_file(rng, n, width):
    out = ["h" + ",".join(str(i) for i in range(width)).replace(",", ",h")]
    for _ in range(n):
        cells = []
        for _ in range(width):
            p = rng.choice(PIECES)
            cells.append(f'"{p}"' if rng.random() < 0.7 or any(c in p for c in '\n,"') else p)
        out.append(",".join(cells[: rng.randint(1, width)] if rng.random() < 0.2 else cells))
    return "\n".join(out) + rng.choice(["", "\n"])


def expected(text, width):
    got = [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
    return sorted((tuple((r + [None] * width)[:width]) for r in got), key=repr)


def read(spark, path):
    # An unquoted empty value is NULL, a quoted one an empty text; both are missing values to a load.
    return sorted((tuple(v or None for v in r) for r in read_csv_text(spark, path, line_breaks=True).collect()), key=repr)


def same(spark, path, text, width):
    want = sorted((tuple(v or None for v in r) for r in expected(text, width)), key=repr)
    want = [r for r in want if any(v is not None for v in r) or width > 1]
    assert read(spark, path) == want


@pytest.mark.parametrize("seed", range(4))
def test_records_across_lines_in_small_splits(spark, scratch, seed):
    rng = random.Random(seed)
    text = quoted_file(rng, 300, 3)
    path = os.path.join(scratch, "t.csv")
    with open(path, "w", newline="") as f:
        f.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(rng.choice([97, 500, 1 << 20])))
    try:
        assert len(read(spark, path)) > 250
        same(spark, path, text, 3)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quotes_inside_plain_values_open_nothing(spark, scratch):
    text = 'id,size,note\n1,5 1/2" pipe,x\n2,7" casing,"a\nb"\n3,"8"" liner",y"\n'
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write(text)
    assert rows(read_csv_text(spark, path, line_breaks=True)) == [
        ("1", '5 1/2" pipe', "x"), ("2", '7" casing', "a\nb"), ("3", '8" liner', 'y"')]


@pytest.mark.parametrize("line_breaks", [False, True])
def test_short_rows_are_filled_and_long_ones_fail(spark, scratch, line_breaks):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write('a,b,c\n1,2\n3\n\n"x,y",5,6\r\n7,8,9\n')
    got = read_csv_text(spark, path, line_breaks)
    assert rows(got) == sorted([("1", "2", None), ("3", None, None), ("x,y", "5", "6"), ("7", "8", "9")], key=repr)
    assert rows(got.select("a")) == [("1",), ("3",), ("7",), ("x,y",)]
    with open(path, "a") as f:
        f.write('1,2,3,4\n')
    for df in (read_csv_text(spark, path, line_breaks), read_csv_text(spark, path, line_breaks).select("a")):
        with pytest.raises(Exception, match="more than 3 values"):
            df.collect()


def test_parts_of_a_table_have_one_header(spark, scratch):
    for name, text in (("p0.csv", 'a,b\n1,"x\ny"\n'), ("p1.csv", 'a,b\n"2\n2",z\n')):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    assert rows(read_csv_text(spark, scratch, line_breaks=True)) == [("1", "x\ny"), ("2\n2", "z")]
    with open(os.path.join(scratch, "p2.csv"), "w") as f:
        f.write("b,a\n1,2\n")
    with pytest.raises(Exception, match="headers"):
        read_csv_text(spark, scratch, line_breaks=True).collect()


def test_records_are_numbered_by_file(spark, scratch):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write('h\n"a\nb"\nc\n"d\ne\nf"\n')
    assert [(r.number, r.record) for r in whole_records(spark, path).orderBy("number").collect()] == [
        (0, "h"), (1, '"a\nb"'), (2, "c"), (3, '"d\ne\nf"')]


def test_an_open_quote_at_the_end_is_one_record(spark, scratch):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write('a,b\n1,"x\ny\n')
    assert whole_records(spark, path).where("number = 1").first().record == '1,"x\ny'


def test_records_are_put_together_once(spark, scratch):
    from conftest import plan_text
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write('id,note\n1,"a\nb"\n\n2,c\n')
    read = read_csv_text(spark, path, line_breaks=True)
    assert "Exchange" not in plan_text(read)
    assert rows(read) == [("1", "a\nb"), ("2", "c")]
