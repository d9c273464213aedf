"""CSV files with line breaks in texts, split over tasks, against Spark's reader of one task a file."""

import random

import pytest

from tidemark.sources import files, quoted


def plain(spark, path):
    return spark.read.options(header="true", **quoted.OPTIONS).csv(path)


def rows(df):
    return sorted(df.collect(), key=str)


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def field(rng):
    kind = rng.randrange(8)
    if kind == 0:
        return ""
    if kind == 1:
        return rng.choice(['in "quotes"', '"', '""', '",', ',"', '"\n', '\n"', '\n",\n', ',",', '",\n,"'])
    return "".join(rng.choice(["a", "bc", " ", "\n", ",", '"', "é", "\n\n"]) for _ in range(rng.randrange(40)))


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    for n in range(2):
        body = "".join(",".join('"' + field(rng).replace('"', '""') + '"' if rng.random() < 0.8 else "plain" for _ in range(3)) + "\n" for _ in range(300))
        (tmp_path / f"{n}.csv").write_text("a,b,c\n" + body, newline="")
    got = quoted.read(spark, str(tmp_path))
    assert quoted.lines_of(spark, str(tmp_path)).select("_file", "_split").distinct().count() > 20
    want = rows(plain(spark, str(tmp_path)))
    assert len(want) == 600
    assert rows(got) == want


def test_line_ends_stray_quotes_and_empty_lines(spark, tmp_path, small_splits):
    text = 'a,b\r\n1,"x\r\ny"\r\n\r\n2,5" wide\r\n3,"z"\r\n4,"",\r\n5,""\r\n6,"last'
    (tmp_path / "one.csv").write_text(text + '"', newline="")
    assert rows(quoted.read(spark, str(tmp_path))) == rows(plain(spark, str(tmp_path)))


def test_an_unclosed_text_is_one_record(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b\n1,x\n2,"open\n3,y\n')
    assert quoted.records(spark, str(tmp_path)).where("not _first").count() == 2


def test_a_file_of_a_header_alone_gives_no_rows(spark, tmp_path):
    (tmp_path / "one.csv").write_text("url,headline\n")
    assert quoted.read(spark, str(tmp_path)).columns == ["url", "headline"]
    assert files.articles_csv(spark, str(tmp_path)).isEmpty()
