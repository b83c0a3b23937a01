import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalgrain.sources import csvrecords, tables


def write(tmp_path, text):
    p = tmp_path / "t.csv"
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_inference_and_tokens(spark, tmp_path):
    path = write(tmp_path, 'i,f,b,t,m,none,big,d,inf\n1,1.5,TRUE,x,NA,,18446744073709551615,2020-01-01,inf\n 2,-3e2,False,?,7,NULL,1,2020-01-02,1\n,nan,true," None ",8,n/a,2,,2\n')
    df = tables.read_csv(spark, path)
    assert dict(df.dtypes) == {"i": "bigint", "f": "double", "b": "boolean", "t": "string", "m": "bigint", "none": "double", "big": "decimal(20,0)", "d": "string", "inf": "double"}
    rows = df.collect()
    assert [r.i for r in rows] == [1, 2, None] and [r.t for r in rows] == ["x", "?", " None "] and [r.f for r in rows] == [1.5, -300.0, None]
    assert [r.none for r in rows] == [None] * 3 and rows[0].inf == float("inf")
    assert [r.t for r in tables.read_csv(spark, path, placeholders=("?",)).collect()] == ["x", None, " None "]


def test_absent_and_empty(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, str(tmp_path / "no.csv"))
    for text in ("", "a,b\n"):
        with pytest.raises(ValueError):
            tables.read_csv(spark, write(tmp_path, text))


def test_short_and_long_rows(spark, tmp_path):
    assert [tuple(r) for r in tables.read_csv(spark, write(tmp_path, 'a,b\n1\n2,"x,y"\n')).orderBy("a").collect()] == [(1, None), (2, "x,y")]
    with pytest.raises(ValueError, match="more fields"):
        tables.read_csv(spark, write(tmp_path, "a,b\n1,2\n1,2,3\n"))


def test_repeated_headers(spark, tmp_path):
    assert tables.read_csv(spark, write(tmp_path, "a,a,,a\n1,2,3,4\n")).columns == ["a", "a.1", "Unnamed: 2", "a.2"]


def test_row_ids_are_dense(spark, sf_dir):
    df = tables.with_row_id(spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(7))
    ids = [r.row_id for r in df.select("row_id").collect()]
    assert sorted(ids) == list(range(len(ids)))


def test_ingest(spark, tmp_path):
    df, n = tables.ingest(spark, write(tmp_path, "patient_id,sex,age\n1,M,45\n1,F,45\n2,F,30\n3,M,72\n"))
    assert n == 4 and df.columns == ["patient_id", "sex", "age"]
    with pytest.raises(FileNotFoundError):
        tables.read_parquet(spark, str(tmp_path / "no.parquet"))


def test_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path, 'a,"x\ny",c\n1,"line one\nline, two",5\n2,plain,6\n3,"5"" pipe",7\n')
    df = tables.read_csv(spark, path)
    assert df.columns == ["a", "x\ny", "c"]
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, "line one\nline, two", 5), (2, "plain", 6), (3, '5" pipe', 7)]
    # each line of this record has as many fields as the header
    df = tables.read_csv(spark, write(tmp_path, 'a,b,c\n1,2,"x\ny,z,w"\n'))
    assert [tuple(r) for r in df.collect()] == [(1, 2, "x\ny,z,w")]
    with pytest.raises(ValueError, match="more fields"):
        tables.read_csv(spark, write(tmp_path, 'a,b\n"1\n2",2,3\n'))


def test_row_ids_of_plans_that_shuffle(spark, sf_dir):
    """Such a plan may be dealt otherwise in each job; the numbers belong to the rows of one."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg({"l_quantity": "sum"}).withColumn("__at", F.lit(1))
    numbered = tables.with_row_id(df)
    assert numbered.columns == [*df.columns, "row_id"]
    ids = [r.row_id for r in numbered.collect()]
    assert sorted(ids) == list(range(df.count()))
    assert tables.with_row_id(numbered).columns == numbered.columns


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from vitalgrain.sources import scratch

    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or scratch.shared_folder(spark) == named.rstrip("/")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: {"spark.master": "local[2]"})
    assert scratch.shared_folder(spark).startswith("file://")
    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: {"spark.master": "spark://host:7077"})
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch.shared_folder(spark)


def pieces_of_csv(seed, rows, breaks=True):
    """A header of three columns and rows with quotes inside, line breaks of all kinds, junk after quotes and blank lines."""
    rng = random.Random(seed)
    plain = ["x", "", "5\" pipe", "a\"\"b", " \"q\" ", "é", "NA", "7", "tail\"", "  "]
    quoted = ["", "a,b", "say \"\"hi\"\"", ",", "\"\"", *(["one\ntwo", "\n", "crlf\r\nend", "cr\rx", "deep\n,\n\"\",\n1,2,3", "\r\n\r\n"] if breaks else [])]
    lines = ["a,b,c"]
    for i in range(rows):
        cells = [str(i), *(f'"{rng.choice(quoted)}"' + rng.choice(["", "", "", "zz", " \"y"]) if rng.random() < 0.5 else rng.choice(plain) for _ in range(2))]
        lines.append(",".join(cells[: rng.choice([3, 3, 3, 2])]))
        if rng.random() < 0.1:
            lines.append(rng.choice(["", "  "]))
    return "".join(line + rng.choice(["\n", "\r\n"]) for line in lines)


@pytest.mark.parametrize("breaks", [True, False])
@pytest.mark.parametrize("split", ["37b", "128m"])
def test_equals_pandas_on_generated_files(spark, tmp_path, breaks, split):
    """Also where ranges of 37 bytes begin and end within records, of which some fill whole ranges."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for seed in range(3):
        path = tmp_path / f"{seed}.csv"
        path.write_bytes(pieces_of_csv(seed, 60, breaks).encode())
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            text = tables.CsvText.of(spark, str(path))
            rows = text.rows(numbered=True)
            assert split == "128m" or rows.rdd.getNumPartitions() > 8
            got = [tuple(r) for r in rows.orderBy(tables.ROW_ID).collect()]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        want = pd.read_csv(path, dtype=str, na_values=list(tables.NA_TOKENS), keep_default_na=False)
        want = [(*(None if isinstance(v, float) else v for v in r), i) for i, r in enumerate(want.itertuples(index=False, name=None))]
        assert got == want


def test_long_rows_with_quotes_fail(spark, tmp_path):
    for text in ('a,b\n5" x,6" y,7\n', 'a,b\n"1",2,"3"\n', 'a,b\n"1\n2",3\n5" x,6" y,7\n', 'a,b\n"1"x,2,3\n', 'a,b\n1,2,\n'):
        with pytest.raises(ValueError, match="more fields"):
            tables.read_csv(spark, write(tmp_path, text))
    for text in ('a,b\n1,"2\n', 'a,"b\n1,2\n'):
        with pytest.raises(ValueError, match="closed|header"):
            tables.read_csv(spark, write(tmp_path, text))
    ok = tables.read_csv(spark, write(tmp_path, 'a,b\n5" x,6" y\n"1,2","3,""4"\n'))
    assert [tuple(r) for r in ok.collect()] == [('5" x', '6" y'), ("1,2", '3,"4')]


def test_numbers_follow_the_order_of_files(spark, tmp_path):
    """The reader deals large files first; numbers go by path and place, over files of many ranges too."""
    sizes = {"a": 2, "b": 5, "c": 400, "d": 1, "e": 30}
    for kind, note in (("plain", "x"), ("quoted", '"x\ny"')):
        at = 0
        (tmp_path / kind).mkdir()
        for name, n in sizes.items():
            (tmp_path / kind / f"{name}.csv").write_bytes(("k,note\n" + "".join(f"{at + i},{note}\n" for i in range(n))).encode())
            at += n
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        for split in ("200b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            try:
                rows = tables.read_csv(spark, str(tmp_path / kind), row_ids=True).collect()
            finally:
                spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            assert len(rows) == at and all(r.k == r.row_id for r in rows)


def test_a_column_named_like_the_number(spark, tmp_path):
    for text in ("row_id,b\n7,x\n8,y\n", 'row_id,b\n7,"x\n"\n8,y\n'):
        df = tables.read_csv(spark, write(tmp_path, text), row_ids=True)
        assert df.columns == ["b", "row_id"] and sorted(r.row_id for r in df.collect()) == [0, 1]


def test_state_of_lines():
    for line, after in (('"a', True), ('a"', False), ('"a""', True), ('"a"b"', False), ('x,"', True), ('"a"",b', True), ('"a",b"', False), ("", False)):
        assert csvrecords.is_open_after(line, False) == after, line
    for line, after in (("x", True), ('"', False), ('""', True), ('a",b', False), ('a","b', True), ('a"b"', False), ('a"b,"c', True)):
        assert csvrecords.is_open_after(line, True) == after, line
