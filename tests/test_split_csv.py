"""The split CSV reader against the whole-file reader and Python's csv module."""

import csv
import io
import random
from contextlib import contextmanager

import pytest

from arrearium.session import scratch_path
from arrearium.sources import bronze, split_csv

SMALL = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}


@contextmanager
def small_splits(spark, **more):
    old = {k: spark.conf.get(k, None) for k in SMALL | more}
    for k, v in (SMALL | more).items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, name, rows, ending="\n"):
    path.mkdir(parents=True, exist_ok=True)
    out = io.StringIO()
    csv.writer(out, lineterminator=ending).writerows(rows)
    (path / name).write_bytes(out.getvalue().encode())


def table(df, *columns):
    return sorted(tuple(r[c] or "" for c in columns) for r in df.collect())


@pytest.mark.parametrize(("seed", "ending"), [(1, "\n"), (2, "\r\n"), (3, "\n"), (4, "\n")])
def test_random_quotes_equal_the_whole_file_reader(spark, tmp_path, seed, ending):
    r = random.Random(seed)
    marks = {1: 'ab", \n', 2: 'ab",é\n', 3: 'abcdefgh,', 4: '"\n'}[seed]
    rows = [
        [f"k{seed}-{i}", *("".join(r.choice(marks) for _ in range(r.choice([0, 1, 3, 9, 60]))) for _ in range(2))] for i in range(150)
    ]
    for part in range(2):
        write(tmp_path / "csv", f"{part}.csv", [["ID", "one", "two,quoted"], *rows[part::2]], ending)
    path, names = str(tmp_path / "csv"), ("ID", "one", "two,quoted")
    with small_splits(spark):
        got = bronze.read_csv_export(spark, path)
        splits = got.select("file_path", "block_start").distinct().count()
        mine = table(got, *names)
        whole = table(bronze.read_csv_export(spark, path, whole_files=True), *names)
    keep = lambda x: "" if x in bronze.values.CSV_NA_TOKENS else x
    assert mine == whole == sorted(tuple(map(keep, row)) for row in rows)
    assert splits > 20


def test_order_of_records_and_long_cells(spark, tmp_path):
    """Records keep the file's order; a cell may cover many splits."""
    rows = [[str(i), "x\n" * (300 if i == 7 else i % 3)] for i in range(40)]
    write(tmp_path / "csv", "page.csv", [["n", "text"], *rows])
    with small_splits(spark):
        got = bronze.read_csv_export(spark, str(tmp_path / "csv"), ["n", "text"]).collect()
    got.sort(key=lambda r: (r.block_start, r.position))
    assert [[r.n, r.text or ""] for r in got] == rows


def test_headers_bytes_and_empty_lines(spark, tmp_path):
    day = tmp_path / "csv" / "ingest_date=2025-01-01"
    write(day, "a.csv", [["ID", "", "x", "x"], ["1", "e", "p", "q"]])
    (day / "a.csv").write_bytes(b"\xef\xbb\xbf" + (day / "a.csv").read_bytes() + b"\n\r\n2,N/A,,last")
    write(tmp_path / "csv" / "ingest_date=2025-01-02", "b.csv", [["more", "ID"], ["m", "3"]], "\r\n")
    got = {(r.ID, r._c1, r.x2, r.x3, r.more, str(r.ingest_date)) for r in bronze.read_csv_export(spark, str(tmp_path / "csv")).collect()}
    assert got == {("1", "e", "p", "q", None, "2025-01-01"), ("2", None, None, "last", None, "2025-01-01"), ("3", None, None, None, "m", "2025-01-02")}
    write(day, "other.csv", [["ID"], ["4"]])
    with pytest.raises(ValueError, match="different headers"):
        bronze.read_csv_export(spark, str(tmp_path / "csv"))
    write(tmp_path / "none", "only.csv", [["ID"]])
    assert bronze.read_csv_export(spark, str(tmp_path / "none"), ["ID"]).collect() == []


def test_stray_quotes(spark, tmp_path):
    """A stray quote is found and the export read whole; one that looks like an end of a cell stops the job."""
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_text('ID,size\n1,a 5" pipe\n2,"b ""6"" \npipe"\n3,c\n')
    assert table(bronze.read_csv_export(spark, str(path)), "ID", "size") == [("1", 'a 5" pipe'), ("2", 'b "6" \npipe'), ("3", "c")]
    (path / "a.csv").write_text('size,ID\na 5",1\nb,2\nc 6",3\n')
    with pytest.raises(Exception, match="neither doubled nor around a cell"):
        bronze.read_csv_export(spark, str(path)).collect()


def test_exports_without_line_breaks_are_not_shuffled(spark):
    path = scratch_path(spark, "plain")
    spark.range(1000).selectExpr("cast(id as string) ID", "concat('\"', id, '\", x') name").coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    with small_splits(spark, **{"spark.sql.files.maxPartitionBytes": "4096"}):
        got = bronze.read_csv_export(spark, path)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and got.rdd.getNumPartitions() > 4
        assert got.count() == 1000


def test_names():
    assert split_csv.names_of('a,"b ""c"", d",,a') == ["a0", 'b "c", d', "_c2", "a3"]


def test_filters_on_cells_parse_a_record_once(spark, tmp_path):
    write(tmp_path / "ingest_date=2025-01-01", "x.csv", [["id", "n"], ["a, b", "1"], ["", "2"], ["c", "3"]])
    got = bronze.read_csv_export(spark, str(tmp_path)).where("id is not null and id <> ''").where("n > 1")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
    assert table(got, "id", "n") == [("c", "3")]


def test_compressed_landings_hold_what_plain_ones_do(spark, tmp_path, monkeypatch):
    """Files of bounded size, a task each; cells with quotes and line breaks come back as they were."""
    monkeypatch.setattr(bronze, "FILE_ITEMS", 70)
    text = "concat('a \"', id, IF(id % 3 = 0, '\\n', ','), '\", b')"
    rows = spark.range(1000).selectExpr("string(id) ID", f"{text} name", "DATE '2025-01-01' ingest_date")
    bronze.land_csv(rows, f"{tmp_path}/plain")
    bronze.land_csv(rows, f"{tmp_path}/small", compressed=True)
    files = list((tmp_path / "small").rglob("part-*"))
    assert all(f.name.endswith(".csv.gz") for f in files) and len(files) >= 15
    assert sum(f.stat().st_size for f in files) < sum(f.stat().st_size for f in (tmp_path / "plain").rglob("part-*"))
    got = [sorted(map(tuple, bronze.read_csv_export(spark, f"{tmp_path}/{name}").select("ID", "name").collect())) for name in ("plain", "small")]
    assert got[0] == got[1] == sorted(map(tuple, rows.select("ID", "name").collect()))
