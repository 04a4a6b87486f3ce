"""Formats told from the files' beginnings, and CSV that is read in splits where it can be."""

import pytest

from labelloom.sources import readers


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


KINDS = [
    ('{"a": 1}\n{"a": 2}\n', True),
    ('\n \n{"a": 1}', True),
    ('{"a": 1}', True),
    ('{"a": broken\n{"a": 2}\n', True),
    ('{"a": broken', True),
    ('[{"a": 1}]', False),
    ("[\n]", False),
    ('{\n"a": 1\n}', False),
    ('{"a": [\n1]}', False),
    ("7\n8", False),
    ('{"a": "' + "x" * 200_000 + '"}\n{"a": "y"}', True),
]


@pytest.mark.parametrize("text, by_line", KINDS)
def test_kinds(spark, tmp_path, text, by_line):
    write(tmp_path / "in" / "a b%.json", text)
    assert [r["by_line"] for r in readers.json_kinds(spark, str(tmp_path / "in")).collect()] == [by_line]


def test_blank_files_have_no_kind(spark, tmp_path):
    write(tmp_path / "in" / "a.json", "\n \n")
    write(tmp_path / "in" / "b.json", '{"a": 1}')
    assert readers.json_kinds(spark, str(tmp_path / "in")).count() == 1
    assert [r["a"] for r in readers.read_any_json(spark, str(tmp_path / "in"), "a int").collect()] == [1]


def test_files_that_tasks_cannot_open_are_looked_at_by_lines(spark, tmp_path, monkeypatch):
    write(tmp_path / "in" / "a.json", '{"a": 1}\n{"a": 2}')
    write(tmp_path / "in" / "b.json", '[{"a": 3}]')
    none = lambda s, p: spark.createDataFrame([("x", None)], "key string, by_line boolean")
    monkeypatch.setattr(readers, "json_kinds", none)
    assert sorted(r["a"] for r in readers.read_any_json(spark, str(tmp_path / "in"), "a int").collect()) == [1, 2, 3]


def test_a_broken_first_line_can_be_kept(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"a": broken\n{"a": 2}\n')
    rows = readers.read_any_json(spark, path, "a int, _corrupt_record string", mode="PERMISSIVE").collect()
    assert sorted((r["a"] or 0) for r in rows) == [0, 2]


@pytest.mark.parametrize(
    "text, split, rows",
    [
        ('a,b\n1,x\n2,"y ""z"""\n', True, [("1", "x"), ("2", 'y "z"')]),
        ('a,b\n1,"two\nlines"\n2,y\n', False, [("1", "two\nlines"), ("2", "y")]),
        ("a,b\n", True, []),
    ],
)
def test_csv_is_read_in_splits_unless_a_line_end_is_quoted(spark, tmp_path, text, split, rows):
    path = write(tmp_path / "a.csv", text)
    assert readers.has_quoted_line_ends(spark, path) is not split
    assert [tuple(r) for r in readers.load_raw(spark, path).collect()] == rows


def test_a_large_csv_is_read_by_many_tasks(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\n" + "".join(f'{i},"value, {i}"\n' for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = readers.load_raw(spark, path)
        assert df.rdd.getNumPartitions() > 2 and df.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
