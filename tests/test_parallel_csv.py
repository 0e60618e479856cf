"""Quoted CSV by blocks against the reader that takes one task per file."""

import random
from urllib.parse import unquote

import pytest

from daybrook.sources import parallel_csv, readers as R


def cell(rng):
    return rng.choice(["", "plain", " spaced ", 'say ""hi""', "two\nlines", "three\r\n\nlines", "a,b", "é漢", "x" * 300, "\n", '""', ","])


def field(text, rng):
    if any(c in text for c in '",\r\n') or rng.random() < 0.1:
        return '"' + text + '"'  # quotes inside are doubled already
    return text


def csv_text(seed, rows=400, columns=4, end="\n", header=True, bom=False, last_end=True):
    rng = random.Random(seed)
    lines = [",".join(f"c{k}" for k in range(columns))] if header else []
    for _ in range(rows):
        n = columns if rng.random() < 0.95 else rng.choice([1, columns - 1, columns + 1])
        line = ",".join(field(cell(rng), rng) for _ in range(n))
        lines.append(line if line else '""')
        if rng.random() < 0.03:
            lines.append("")
    return ("﻿" if bom else "") + end.join(lines) + (end if last_end else "")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed, options", [
    (1, {}), (2, {"end": "\r\n"}), (3, {"bom": True}), (4, {"last_end": False}), (5, {"header": False}), (6, {"rows": 0})])
def test_blocks_equal_one_task(small_blocks, tmp_path, seed, options):
    spark, header = small_blocks, options.get("header", True)
    for k in range(3):
        (tmp_path / f"part-{k}.csv").write_bytes(csv_text(seed * 10 + k, **options).encode())
    columns = [f"c{k}" for k in range(4)]
    got = R.read_split_csv(spark, str(tmp_path), columns, header)
    want = R.read_quoted_csv(spark, str(tmp_path), columns, header)
    # in a file of CR LF lines Spark's reader turns those inside cells into LF; by blocks cells stay verbatim
    same = [[tuple(None if c is None else c.replace("\r\n", "\n") for c in r) for r in rows_of(R.good_rows(df))] for df in (got, want)]
    assert sorted(same[0]) == sorted(same[1])
    if options.get("end") != "\r\n":
        assert rows_of(R.good_rows(got)) == rows_of(R.good_rows(want))
    assert len(rows_of(R.malformed_rows(got))) == len(rows_of(R.malformed_rows(want)))
    if options.get("rows") != 0:
        assert parallel_csv.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 10


def test_a_field_longer_than_blocks(small_blocks, tmp_path):
    text = "a,b\n1,x\n2,\"" + "line\n" * 3000 + "\"\n3,\"last\n\"\n"
    (tmp_path / "one.csv").write_text(text)
    got = R.good_rows(R.read_split_csv(small_blocks, str(tmp_path / "one.csv"), ["a", "b"])).collect()
    assert sorted((r["a"], r["b"]) for r in got) == [("1", "x"), ("2", "line\n" * 3000), ("3", "last\n")]


def test_pieces_stay_few(small_blocks, tmp_path):
    """Only the lines at borders inside a field leave their task."""
    (tmp_path / "one.csv").write_text(csv_text(9, rows=3000))
    rows = parallel_csv.lines(small_blocks, str(tmp_path / "one.csv"))
    borders = parallel_csv.open_blocks(rows)
    starts = borders.where("starts_open").count()
    assert 0 < starts < borders.count()
    opened = frozenset(r[0] for r in borders.where("starts_open").select("block_key").collect())
    near = rows.join(borders.where("starts_open OR ends_open").select("block_key"), "block_key", "left_semi").select(*rows.columns)
    pieces = parallel_csv._assemble(near, opened, True, "pieces", parallel_csv.PIECES)
    assert starts <= pieces.count() <= 2 * starts + 1


def test_headers_come_from_the_first_bytes(spark, tmp_path, monkeypatch):
    """Byte order mark, CR LF, gzip, one line without an end, a header longer than the first bytes, empty files, odd names."""
    import gzip
    monkeypatch.setattr(R, "HEAD_BYTES", 8)
    wide = ",".join(f"column_{k}" for k in range(200))
    texts = {"a.csv": "x,y\n1,2\n" * 5000, "b 100%.csv": "﻿x,y\r\n1,2\r\n", "c.csv": "x,y", "d.csv": wide + "\n1\n", "e.csv": "", "f.csv": "\n1\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    (tmp_path / "g.csv.gz").write_bytes(gzip.compress(b"x,y\n" + b"1,2\n" * 9000))
    found = R.csv_headers(spark, str(tmp_path))
    assert sorted((len(c), len(f)) for c, f in found) == [(2, 4), (200, 1)]
    assert R.csv_headers(spark, str(tmp_path / "none*.csv")) is None and R.csv_headers(spark, str(tmp_path / "e.csv")) == []
    two = next(files for columns, files in found if columns == ["x", "y"])
    rows = R.good_rows(R.read_split_csv(spark, [unquote(f) for f in two], ["x", "y"]))
    assert rows.count() == 9999 + 1 + 0 + 9000
