"""Records of one length out of files cut into ranges."""

import random

import pytest

from fieldkit.sources.records import read_image_records, read_records


def test_records_of_files_of_several_ranges(spark, tmp_path):
    rng = random.Random(4)
    rows = [(k % 256, [rng.randrange(256) for _ in range(9)]) for k in range(700)]
    for name, part in (("a.bin", rows[:650]), ("b.bin", rows[650:]), ("c.bin", [])):
        (tmp_path / name).write_bytes(b"".join(bytes([label, *pixels, 7]) for label, pixels in part))
    for split_bytes in (64, None):
        records = read_records(spark, str(tmp_path), 11, split_bytes)
        assert records.columns == ["record"]
        if split_bytes:
            assert records.rdd.getNumPartitions() > 50
        images = read_image_records(spark, str(tmp_path), 9, 1, split_bytes).collect()
        assert sorted((r["label"], r["pixels"]) for r in images) == sorted(rows)


def test_a_file_of_another_record_length_fails(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 25)
    with pytest.raises(Exception):
        read_records(spark, str(tmp_path), 10).collect()
    with pytest.raises(ValueError):
        read_records(spark, str(tmp_path), 0)


def test_no_bytes_no_records(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"")
    assert read_image_records(spark, str(tmp_path), 4).collect() == []
