"""Typed CSV loading: bad-row policies, null tokens, blank lines, quotes."""

import os
import tempfile

import pytest
from pyspark.sql import types as T

from tallyspark.sources.csv import CORRUPT, CsvFormat, read_table

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                       T.StructField("price", T.DecimalType(10, 2)), T.StructField("day", T.DateType())])


def _file(text):
    d = tempfile.mkdtemp(prefix="tally-csv-")
    p = os.path.join(d, "in.csv")
    with open(p, "w", newline="") as f:
        f.write(text)
    return p


TEXT = ("\r\nid,name,price,day\r\n1,Tea,2.50,2026-07-01\r\n2,\"Cake, lemon\",x1,2026-07-02\r\n"
        "3,null,4.00,2026-07-03\r\n4,,5.00,not-a-date\r\n5,Pie,NULL,2026-07-05")


def test_continue_keeps_good_rows_and_rejects(spark):
    good, bad = read_table(spark, _file(TEXT), SCHEMA, CsvFormat(null_tokens=("null", "", "NULL")))
    got = sorted(tuple(r) for r in good.collect())
    assert [g[0] for g in got] == [1, 3, 5]
    assert got[1][1] is None and got[2][2] is None
    rej = sorted(r[CORRUPT] for r in bad.collect())
    assert rej == ['2,"Cake, lemon",x1,2026-07-02', "4,,5.00,not-a-date"]


def test_abort_fails(spark):
    good, _ = read_table(spark, _file(TEXT), SCHEMA, CsvFormat(null_tokens=("null", "", "NULL")), on_error="abort")
    with pytest.raises(Exception):
        good.collect()


@pytest.mark.parametrize("text", [
    "id,name,price,day\n1,Tea,2.50,2026-07-01\n2,Tea\n", "id,name,price,day\n1,Tea,2.50,2026-07-01,9\n",
    "id,name,price,day\nx,Tea,2.50,2026-07-01\n"])
@pytest.mark.parametrize("read", [lambda df: df.count(), lambda df: df.select("name").collect()])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_abort_whatever_is_read(spark, text, read, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good, _ = read_table(spark, _file(text), SCHEMA, on_error="abort")
        with pytest.raises(Exception, match="bad line"):
            read(good)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_same_date_format_for_both_policies(spark):
    text = "id,name,price,day\n1,Tea,2.50,31/07/2026\n"
    got = [read_table(spark, _file(text), SCHEMA, CsvFormat(date_format="dd/MM/yyyy"), on_error=e)[0].first().day
           for e in ("continue", "abort")]
    assert [str(d) for d in got] == ["2026-07-31"] * 2


def test_blank_tail_and_transform(spark):
    from pyspark.sql import functions as F
    p = _file("id,name,price,day\r\n1,Tea,2.50,2026-07-01\r\n\r\n")
    good, bad = read_table(spark, p, SCHEMA, select=[F.col("id"), F.lit(True).alias("is_current")])
    assert [tuple(r) for r in good.collect()] == [(1, True)] and bad.count() == 0


QUOTED = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                       T.StructField("note", T.StringType())])


@pytest.mark.parametrize("split", ["128m", "37", "64"])
def test_quoted_records(spark, split):
    """Doubled quotes, delimiters, line and blank lines in quotes, quotes that
    are plain characters; with splits shorter than a record."""
    text = ('id,name,note\r\n1,"a, ""b""","x"\r\n2,"two\r\nlines",y\r\n\r\n3,"with\r\n\r\n""blank""\r\nlines, here",z\r\n'
            '4,5" pipe,6"\r\n5,plain,"""quoted"""\r\n6,"","a\r\n,b"\r\n"7","e""","f"\r\n' +
            "".join(f'{i},"long {"x" * 50}\n{i}",n{i}\n' for i in range(10, 40)))
    want = [(1, 'a, "b"', "x"), (2, "two\nlines", "y"), (3, 'with\n\n"blank"\nlines, here', "z"),
            (4, '5" pipe', '6"'), (5, "plain", '"quoted"'), (6, None, "a\n,b"), (7, 'e"', "f")]
    want += [(i, f'long {"x" * 50}\n{i}', f"n{i}") for i in range(10, 40)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        good, bad = read_table(spark, _file(text), QUOTED)
        assert sorted(map(tuple, good.collect())) == want and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bad_quoted_records_are_rejected_whole(spark):
    text = 'id,name,note\n1,"a\nb",c\nx,"d\ne",f\n2,g,h\n3,"open\n4,i,j\n'
    good, bad = read_table(spark, _file(text), QUOTED)
    assert sorted(map(tuple, good.collect())) == [(1, "a\nb", "c"), (2, "g", "h")]
    assert sorted(r[0] for r in bad.collect()) == ['3,"open', "4,i,j", 'x,"d\ne",f']
    good, bad = read_table(spark, _file('id,name,note\n1,"a\nb\nc\nd",e\n2,f,g\n'), QUOTED, CsvFormat(max_record_lines=3))
    assert [r.id for r in good.collect()] == [2] and bad.count() == 4


def test_written_quotes_read_back(spark, tmp_path):
    from tallyspark.sources.csv import write_csv
    rows = [(1, 'a "b", c', "x\ny"), (2, '"', '""'), (3, "\n", ',"'), (4, "back\\slash", '\\"'), (5, "'", "z\n\n\nz")]
    path = write_csv(spark.createDataFrame(rows, QUOTED).repartition(2), str(tmp_path / "out"))
    good, bad = read_table(spark, path, QUOTED)
    assert sorted(map(tuple, good.collect())) == rows and bad.count() == 0
