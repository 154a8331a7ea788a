"""SRC2: large media files are read in pieces, never as one value."""

import hashlib
import random

import pytest

import __spark_entry__ as E
from inferframe.sources import readers as R


def files():
    r = random.Random(5)
    mark = R._Digest.MARK if hasattr(R, "_Digest") else b"\xef\xbb\xbf"
    return {
        "plain.parquet": r.randbytes(150_000), "a b.parquet": r.randbytes(120_001) + b"\n", "p%20+q.parquet": mark + r.randbytes(100_100),
        "ü.parquet": mark + b"\n\n\r\n" + r.randbytes(100_100) + b"\n\n", "empty lines.parquet": b"\n" * 100_100,
        "long.parquet": b"x" * 300_000, "two marks.parquet": mark * 2 + r.randbytes(100_100) + b"\r",
        "small.parquet": r.randbytes(900), "marked.parquet": mark + b"\n", "other.txt": b"not asked for"}


@pytest.fixture
def small_values(spark, monkeypatch):
    """No value of a file may be longer than 100,000 bytes."""
    monkeypatch.setattr(R, "WHOLE_BYTES", 100_000, raising=False)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100000")
    yield
    spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_files_longer_than_a_value_are_hashed_whole(spark, tmp_path, small_values):
    for name, data in files().items():
        (tmp_path / name).write_bytes(data)
    got = sorted(map(tuple, E.queries()["src_media"](spark, str(tmp_path)).collect()))
    assert got == sorted((n, "parquet", len(d), hashlib.md5(d).hexdigest(), "application/vnd.apache.parquet")
                         for n, d in files().items() if n.endswith(".parquet"))


def test_packed_files_stay_whole_values(spark, tmp_path, monkeypatch):
    import gzip

    monkeypatch.setattr(R, "WHOLE_BYTES", 10)
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"text\n" * 100))
    (tmp_path / "a.txt").write_bytes(b"text\n" * 100)
    whole = [r.file_name for r in R.read_media(spark, str(tmp_path), large=False).collect()]
    assert whole == ["a.gz"] and R.read_media(spark, str(tmp_path)).count() == 2
    assert [(r.file_name, bytes(r.piece)) for r in R.read_media_pieces(spark, str(tmp_path)).collect()] == [("a.txt", b"text")] * 100


def test_each_large_file_is_one_partition(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "WHOLE_BYTES", 100_000)
    for i in range(12):
        (tmp_path / f"{i}.bin").write_bytes(random.Random(i).randbytes(100_001 + 50_000 * i))
    pieces = R.read_media_pieces(spark, str(tmp_path))
    assert pieces.rdd.getNumPartitions() == 12
    assert {r.path.rsplit("/", 1)[1]: r.content_md5 for r in R.md5_of_pieces(pieces).collect()} == {
        f.name: hashlib.md5(f.read_bytes()).hexdigest() for f in tmp_path.iterdir()}
