"""Headers from the first block of a file."""

import gzip
import io

import pytest

from tierstone.sources.csv_drops import files_by_header, scanned_headers
from tierstone.sources.heads import BLOCK, file_heads, first_line


@pytest.mark.parametrize("data, line", [
    (b"a,b\n1,2\n", "a,b"), (b"\xef\xbb\xbfa,b\r\n1,2", "a,b"), (b"\r\n \t\n\x00\na;\xc3\xa9\rx", "a;é"), (b"only", "only"), (b"", None), (b"\n \n", None),
    (b"x" * 50 + b"\n1", "x" * 50),
])
@pytest.mark.parametrize("block", [1, 3, 7, 1 << 16])
def test_first_line_whatever_the_block(data, line, block):
    assert first_line(io.BytesIO(data), block)[0] == line


def test_what_is_read_does_not_grow_with_the_file(spark, tmp_path):
    paths = []
    for name, n in (("a b+%25.csv", 10), ("large.csv", 400_000)):
        (tmp_path / name).write_text("id,len\n" + "x,1.5,some words\n" * n)
        paths.append(f"file://{tmp_path}/{name}")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write("id,other\n" + "1,2\n" * 10)
    paths.append(f"file://{tmp_path}/packed.csv.gz")
    rows = {r.path: r for r in file_heads(spark, paths).collect()}
    assert [rows[p].header for p in paths] == ["id,len", "id,len", "id,other"]
    assert all(r.bytes_read <= BLOCK and r.error is None for r in rows.values())
    assert files_by_header(spark, [*paths, *paths]) == {"id,len": paths[:2], "id,other": paths[2:]}
    assert sorted((r.file_path, r.header) for r in scanned_headers(spark, paths).collect()) == sorted((p, rows[p].header) for p in paths)


def test_a_store_that_only_spark_reads_is_scanned(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\nid,len\n1,2\n")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.heads.link./in", f"file://{tmp_path}")
    path = "viewfs://heads/in/a.csv"
    (row,) = file_heads(spark, [path]).collect()
    assert row.header is None and row.error
    assert files_by_header(spark, [path]) == {"id,len": [path]}
