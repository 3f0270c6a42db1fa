import io
import zipfile

import pytest

from barsieve.operators.silver import project_bars, typed_bars
from barsieve.plans import views
from barsieve.schemas import BARS_SCHEMA, STAGED_BAR_COLUMNS
from barsieve.sources.archives import list_archives, scan_staged_entries, stage_entries, unzip_lines, unzip_rows
from tests.conftest import rows

HEADER = ",".join(STAGED_BAR_COLUMNS)
A = "AAA,EQ,1.5,2,1,1.75,1.75,1.25,100,150.5,01-JAN-2016,7,INA"
B = "M&M,BE,10,20,5,15,15,,1,15,01-JAN-2016,1,INB"


def _zip(path, entries):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in entries.items():
            archive.writestr(name, text)
    path.write_bytes(buffer.getvalue())


@pytest.fixture
def archives(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _zip(folder / "cm01JAN2016bhav.csv.zip", {"cm01JAN2016bhav.csv": f"{HEADER}\n{A}\n{B}\n"})
    reordered = ",".join(reversed(STAGED_BAR_COLUMNS)) + ",\n" + ",".join(reversed(A.split(","))) + ",\n"
    _zip(folder / "cm02JAN2016bhav.csv.zip", {"x.csv": reordered, "sub/": "", "empty.csv": "", "head.csv": HEADER + "\n"})
    (folder / "readme.txt").write_text("no archive")
    return folder


def test_rows_of_every_entry(spark, archives):
    df = unzip_rows(list_archives(spark, str(archives)))
    assert df.columns == ["entry", *STAGED_BAR_COLUMNS]
    a, b = tuple(A.split(",")), tuple(x or None for x in B.split(","))
    assert rows(df) == sorted([("cm01JAN2016bhav.csv", *a), ("cm01JAN2016bhav.csv", *b), ("x.csv", *a)], key=repr)


def test_absent_columns_fail(spark, tmp_path):
    _zip(tmp_path / "a.zip", {"a.csv": "SYMBOL,MORE\nAAA,1\n"})
    archives = list_archives(spark, str(tmp_path))
    assert rows(unzip_rows(archives, ["MORE"])) == [("a.csv", "1")]
    with pytest.raises(Exception, match="no column ISIN in .*a.csv"):
        unzip_rows(archives, ["SYMBOL", "ISIN"]).collect()


def test_columns_beyond_the_parsed_cells_fail(spark, tmp_path):
    for spare in (32, 33):
        (tmp_path / str(spare)).mkdir()
        names, values = [f"M{i}" for i in range(spare)], ["x"] * spare
        _zip(tmp_path / str(spare) / "a.zip", {"a.csv": ",".join([*names, "N"]) + "\n" + ",".join([*values, "1"]) + "\n"})
    read = lambda spare: unzip_rows(list_archives(spark, str(tmp_path / str(spare))), ["N"])
    assert rows(read(32)) == [("a.csv", "1")]
    with pytest.raises(Exception, match="column N beyond 33 cells in .*a.csv"):
        read(33).collect()


def test_entries_of_one_name_stay_apart(spark, tmp_path):
    for k, symbol in enumerate("ABC"):
        folder = tmp_path / "in" / str(k // 2)
        folder.mkdir(parents=True, exist_ok=True)
        _zip(folder / f"{k % 2}.zip", {"e.csv": f"SYMBOL,N\n{symbol}{symbol}{symbol},{k}\n"})
    stage_entries(list_archives(spark, str(tmp_path / "in")).coalesce(1), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").rglob("*.txt"))) == 3
    got = rows(scan_staged_entries(spark, str(tmp_path / "out"), ["N", "SYMBOL"]))
    assert got == [("0", "AAA"), ("1", "BBB"), ("2", "CCC")]


def test_windows_line_ends_and_quotes(spark, tmp_path):
    _zip(tmp_path / "a.zip", {"a.csv": 'SYMBOL,"N, M",X\r\n"A,B",1,\r\nC,,\r\n'})
    df = unzip_rows(list_archives(spark, str(tmp_path)), ["N, M", "SYMBOL"])
    assert rows(df) == [("a.csv", "1", "A,B"), ("a.csv", None, "C")]


def test_staged_entries_keep_their_lines(spark, archives, tmp_path):
    files = list_archives(spark, str(archives), "cm01*")
    lines = [r["line"] for r in unzip_lines(files).orderBy("line_no").collect()]
    assert lines == [HEADER, A, B]
    stage_entries(files, str(tmp_path / "staged"))
    staged = list((tmp_path / "staged").rglob("*.txt"))
    assert [p.parent.name for p in staged] == ["entry=cm01JAN2016bhav.csv"]
    assert staged[0].read_text() == f"{HEADER}\n{A}\n{B}\n"
    again = scan_staged_entries(spark, str(tmp_path / "staged"))
    assert again.count() == 2
    typed = typed_bars(project_bars(again))
    assert typed.schema.names == BARS_SCHEMA.names
    assert [f.dataType for f in typed.schema] == [f.dataType for f in BARS_SCHEMA]
    first = typed.where("symbol = 'AAA'").collect()[0]
    assert (first["open"], first["tottrdqty"], str(first["generated_date"])) == (1.5, 100, "2016-01-01")


def test_long_entries_keep_their_order(spark, tmp_path):
    body = [f"{i}" for i in range(300_000)]
    _zip(tmp_path / "a.zip", {"a.csv": "\n".join(["n", *body]) + "\n"})
    stage_entries(list_archives(spark, str(tmp_path)), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").rglob("*.txt")
    assert file.read_text().splitlines() == ["n", *body]
    assert unzip_rows(list_archives(spark, str(tmp_path)), ["n"]).distinct().count() == 300_000


def test_written_archives_are_valid(spark, sf_dir, tmp_path):
    views.write_archives(views.staged_bars(spark, sf_dir), str(tmp_path))
    found = 0
    for path in tmp_path.rglob("part-*"):
        with zipfile.ZipFile(path) as archive:
            assert archive.testzip() is None and archive.comment == b"\n"
            found += sum(len(archive.read(n).decode().splitlines()) - 1 for n in archive.namelist())
    assert found == views.bars(spark, sf_dir).count()
