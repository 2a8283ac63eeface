import os

from cityzones.sources.files import read_csv_columns, read_json_lines
from conftest import row_key, rows


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_folder_columns_reads_only_csv_files(spark, tmp_dir):
    d = _local(f"{tmp_dir}/folder")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("BARRI,X,DISTRICTE\nel Raval,1,Ciutat Vella\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("BARRI,X,DISTRICTE\nla Salut,2,Gràcia\n")
    with open(f"{d}/notes.txt", "w") as f:
        f.write("BARRI,DISTRICTE\nignored,ignored\n")
    out = read_csv_columns(spark, f"{tmp_dir}/folder", ["BARRI", "DISTRICTE"])
    assert out.columns == ["BARRI", "DISTRICTE"]
    assert rows(out) == [("el Raval", "Ciutat Vella"), ("la Salut", "Gràcia")]


def test_csv_folder_columns_per_file_header(spark, tmp_dir):
    import pytest
    d = _local(f"{tmp_dir}/mixed")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("BARRI,X,DISTRICTE\nel Raval,1,Ciutat Vella\n\"Sant Antoni, l'Eixample\",2,Eixample\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("DISTRICTE,BARRI\nGràcia,la Salut\nGràcia,\n")   # other order; an empty name
    out = read_csv_columns(spark, f"{tmp_dir}/mixed", ["BARRI", "DISTRICTE"])
    assert rows(out) == sorted([("el Raval", "Ciutat Vella"), ("Sant Antoni, l'Eixample", "Eixample"),
                                ("la Salut", "Gràcia"), (None, "Gràcia")], key=row_key)
    # the plain reader would read b.csv shifted by position: it refuses instead
    with pytest.raises(Exception):
        read_csv_columns(spark, f"{tmp_dir}/mixed", ["BARRI", "DISTRICTE"], per_file_header=False).collect()
    # a file without a requested column fails the job
    with open(f"{d}/c.csv", "w") as f:
        f.write("BARRI\nx\n")
    with pytest.raises(Exception, match="column DISTRICTE missing"):
        read_csv_columns(spark, f"{tmp_dir}/mixed", ["BARRI", "DISTRICTE"]).collect()


def test_json_lines_missing_key_is_null(spark, tmp_dir):
    d = _local(f"{tmp_dir}/json")
    os.makedirs(d)
    with open(f"{d}/x.json", "w") as f:
        f.write('{"a": "1", "b": 2}\n{"a": "2"}\n')
    df = read_json_lines(spark, f"{tmp_dir}/json", "a string, b bigint")
    assert rows(df) == [("1", 2), ("2", None)]


def test_csv_layouts_with_quotes_and_line_breaks(spark, tmp_dir):
    d = _local(f"{tmp_dir}/layouts")
    os.makedirs(d)
    for name, text in (("a", 'x,y,z\n1,"b, c",\n2,"d""e",""\n'), ("b", 'z,"x",y\r\nk,3,"two\r\nlines"\r\n'),
                       ("c", 'y,z,x,w,w\n"q ""r, s""\nt",m,4,,\n'), ("d", "x,y,z\n"), ("e", "x,y,z\n5,last,n")):
        with open(f"{d}/{name}.csv", "w", newline="") as f:
            f.write(text)
    open(f"{d}/empty.csv", "w").close()
    out = read_csv_columns(spark, f"{tmp_dir}/layouts", ["x", "y", "z"])
    got = [(x, y.replace("\r\n", "\n"), z) for x, y, z in rows(out)]
    assert got == [("1", "b, c", None), ("2", 'd"e', None), ("3", "two\nlines", "k"), ("4", 'q "r, s"\nt', "m"),
                   ("5", "last", "n")]
    # one native scan per distinct header, nothing joined or shuffled
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3 and "Exchange" not in plan and "Join" not in plan


def test_csv_columns_of_an_empty_folder(spark, tmp_dir):
    os.makedirs(_local(f"{tmp_dir}/none"))
    assert read_csv_columns(spark, f"{tmp_dir}/none", ["x"]).collect() == []



def test_strict_csv_drops_malformed_rows_under_any_selection(spark, tmp_dir):
    import pytest

    from cityzones.sources.files import read_csv_strict
    d = _local(f"{tmp_dir}/strict")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write('a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,"x, y",12\n')
    df = read_csv_strict(spark, f"{tmp_dir}/strict", ["a", "b", "c"])
    assert rows(df) == [("1", "2", "3"), ("10", "x, y", "12")]
    assert rows(df.select("b")) == [("2",), ("x, y",)]
    assert rows(df.select("c", "a")) == [("12", "10"), ("3", "1")]
    assert df.count() == 2
    read_csv_strict(spark, f"{tmp_dir}/strict", ["a", "b", "c"], check_header=True).collect()
    with pytest.raises(Exception):
        read_csv_strict(spark, f"{tmp_dir}/strict", ["a", "c", "b"], check_header=True).collect()


def test_json_value_of_another_type_fails(spark, tmp_dir):
    import pytest
    d = _local(f"{tmp_dir}/json-bad")
    os.makedirs(d)
    with open(f"{d}/x.json", "w") as f:
        f.write('{"a": "1", "b": "1.234"}\n')
    with pytest.raises(Exception):
        read_json_lines(spark, f"{tmp_dir}/json-bad", "a string, b bigint").collect()


def test_scratch_is_cleared_from_a_mark(spark):
    from cityzones.session import clear_scratch, materialize, scratch_mark
    kept = materialize(spark.range(3), "kept")
    mark = scratch_mark()
    gone = materialize(spark.range(3), "gone")
    folder = os.path.dirname(_local(gone.inputFiles()[0].replace("file://", "")))
    assert os.path.exists(folder)
    clear_scratch(spark, mark)
    assert not os.path.exists(folder) and kept.count() == 3
