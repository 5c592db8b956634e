"""The sparse_table data source."""

import random

import pytest

from vitalair.sources import sparse_format as s


def test_entries():
    names = ["n_a", "n_b", "n_c"]
    assert s.cells("({1,3},{x,y})", names) == {"n_a": "x", "n_c": "y"}
    assert s.cells('"({0,2},{x,y})"', names) == {"n_a": "x", "n_c": "y"}
    assert s.cells('("{1,2}","{""a, b"",c!}")', names) == {"n_a": "a, b", "n_b": "c!"}
    assert s.cells('"({1},{""a """" b""})"', names) == {"n_b": 'a " b'}
    assert s.cells("", names) == s.cells("({},{})", names) == s.cells('""', names) == {}
    assert s.split_outside('1!"a!b"!({1},{"x!y"})!', "!") == ["1", '"a!b"', '({1},{"x!y"})', ""]
    for bad in ("({1,2},{x})", "({4},{x})", "({0},{x})", "{1}", "({1})", "(1,{x})", "({x},{1})"):
        with pytest.raises(ValueError):
            s.cells(bad, names)


def written(folder, rows, names):
    (folder / "filemeta").write_text("id!lab_code!note!icd\n")
    (folder / "lab").write_text("{" + ",".join(f'"{n}"' for n in names) + "}\n")
    (folder / "icd").write_text("{A.1,B.2}\n")
    out = []
    for i, held, note, quoted in rows:
        inner = ",".join(str(p + (not quoted)) for p in held), ",".join('"' + v.replace('"', '\\"') + '"' for v in held.values())
        entry = "({%s},{%s})" % inner if held else ""
        entry = '"' + entry.replace('"', '""').replace("\\", "\\\\") + '"' if quoted and held else entry
        out.append(f'{i}!{entry}!"{note}"!' + ("({2},{1})" if i % 3 == 0 else ""))
    (folder / "rows").mkdir()
    half = len(out) // 2
    (folder / "rows" / "a.txt").write_text("\n".join(out[:half]) + "\n")
    (folder / "rows" / "b.txt").write_text("\n".join(out[half:]))
    (folder / "rows" / "_SUCCESS").write_text("")


@pytest.mark.parametrize("size", [37, 1000, 1 << 20])
def test_rows_in_splits_of_any_size(spark, tmp_path, size):
    rng = random.Random(size)
    names = [f"code {k}" for k in range(30)]
    rows = [(i, {p: rng.choice(["1", "x, y", "a!b", "é日", 'q "z"']) for p in sorted(rng.sample(range(30), rng.randint(0, 5)))}, "ü" * rng.randint(0, 9), rng.random() < 0.5) for i in range(300)]
    written(tmp_path, rows, names)
    spark.dataSource.register(s.SparseTable)
    df = spark.read.format("sparse_table").option("filemeta", f"{tmp_path}/filemeta").option("colmeta.lab", f"{tmp_path}/lab").option("colmeta.icd", f"{tmp_path}/icd").option("splitSize", size).load(f"{tmp_path}/rows")
    assert df.dtypes == [("id", "string"), ("lab_code", "map<string,string>"), ("note", "string"), ("icd", "map<string,string>")]
    got = {int(r.id): (r.lab_code, r.note, r.icd) for r in df.collect()}
    assert df.rdd.getNumPartitions() >= (100 if size == 37 else 2)
    assert got == {i: ({f"lab_code_{names[p]}": v for p, v in held.items()}, note or None, {"icd_B.2": "1"} if i % 3 == 0 else {}) for i, held, note, _ in rows}


def test_an_empty_folder_and_a_short_row(spark, tmp_path):
    written(tmp_path, [(1, {}, "x", False)], ["a"])
    spark.dataSource.register(s.SparseTable)
    read = lambda at: spark.read.format("sparse_table").option("filemeta", f"{tmp_path}/filemeta").option("colmeta.lab", f"{tmp_path}/lab").load(str(at))
    (tmp_path / "none").mkdir()
    assert read(tmp_path / "none").count() == 0
    (tmp_path / "bad.txt").write_text("1!2\n")
    with pytest.raises(Exception, match="2 entries for 4 columns"):
        read(tmp_path / "bad.txt").count()
