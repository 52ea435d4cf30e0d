"""Places of lines that do not parse, over files of several splits."""

import pytest

from fieldkit.session import new_path
from fieldkit.sources.places import is_blip, is_point, reject_places


@pytest.fixture(scope="module")
def folder_of_lines(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lines")
    files = {
        "a.txt": [f"{k} 1 2 3" if k % 10 else f"bad {k}" for k in range(500)],
        "b.txt": [], "c.txt": ["", "1 2 3 4", "é x", "1 2 3"],
        "d.txt": ["broken " * 300, *["1 2 3 4"] * 300, "1 2 3 4 5"]}
    for name, lines in files.items():
        (folder / name).write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
    return folder, files


@pytest.mark.parametrize("split_bytes", ["300", "128m"])
def test_places_are_line_numbers_whatever_the_splits(spark, folder_of_lines, split_bytes):
    folder, files = folder_of_lines
    want, row = set(), 0
    for name, lines in files.items():
        for number, line in enumerate(lines, 1):
            row += 1
            fine = len(line.split()) == 4 and all(t.isdigit() for t in line.split())
            if not fine:
                want.add((name, number, row, line))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = reject_places(spark.read.text(str(folder)), is_blip()).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == len(want)
    assert {(r["file"].rsplit("/", 1)[1], r["line"], r["row"], r["value"]) for r in rows} == want
    if split_bytes == "300":
        assert len({(r["file"], r["range_start"]) for r in rows}) > 10
        assert {r["range_length"] for r in rows} <= set(range(1, 301))


def test_no_lines_and_no_rejects(spark):
    path = new_path(spark, "no-lines")
    spark.createDataFrame([], "value string").write.text(path)
    assert reject_places(spark.read.text(path), is_point(2)).collect() == []
    path = new_path(spark, "good-lines")
    spark.createDataFrame([("1 2",), ("3, 4",)], "value string").write.text(path)
    assert reject_places(spark.read.text(path), is_point(2)).collect() == []
    assert reject_places(spark.read.text(path), is_point(3)).count() == 2


def test_a_line_is_parsed_once(spark):
    """The numbers of a line are worked out once for all that is asked of them."""
    lines = spark.createDataFrame([("1 2",), ("1 x",), ("1e999 2",), ("",), (None,), ("1 2 3",)], "value string")
    text = lines.select(is_point(2).alias("good"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("split(") == 1 and text.count("rlike(") + text.count("RLIKE") == 1
    good = [r.good for r in lines.select(is_point(2).alias("good")).collect()]
    assert good[0] is True and not any(good[1:])
