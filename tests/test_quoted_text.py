"""Quoted text with line breaks, cut anywhere, against the reader of whole files."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from marketmill.schemas import RAW_COLUMNS
from marketmill.sources import csv_files, quoted_text
from marketmill.sources.csv_files import load_csv_tables, text_cells
from tests.conftest import write_files

CELLS = [
    "x", "plain", "", '"q"', '"a,b"', '"line\nbreak"', '"two\n\nbreaks"', '"say ""hi"""', '""',
    '"""\n"""', '"end\n"', "é", '"é\né"', 'mid"quote', "NA", '"tail"x', '" sp"', " sp", '"a\r\nb"',
    '"' + "long\n" * 30 + '"',
]
NAMES = ["a", "b", "c"]


def drawn(seed, rows, end="\n", mark=""):
    chosen = random.Random(seed)
    lines = [
        ",".join(chosen.choice(CELLS) for _ in NAMES) + end * chosen.choice([1, 1, 1, 2])
        for _ in range(rows)
    ]
    return f"{mark}a,B,c{end}" + "".join(lines)


def read(spark, path, range_bytes):
    return sorted(map(repr, text_cells(spark, path, NAMES, True, range_bytes).collect()))


@pytest.mark.parametrize(
    "case", [("\n", "", 1), ("\n", "", 2), ("\n", "", 17), ("\n", "﻿", 64), ("\r\n", "", 5), ("\r\n", "﻿", 40)]
)
def test_every_cut_gives_the_same_cells(spark, tmp_path, case):
    end, mark, size = case
    texts = {f"part{k}.csv": drawn(k, 12, end, mark) for k in range(3)}
    path = write_files(tmp_path / "parts", texts)
    cut = read(spark, path, size)
    assert len(cut) == 36
    assert cut == read(spark, path, 1 << 30)


@pytest.mark.parametrize("inside", [False, True])
def test_states_of_lines(inside):
    cases = {
        "plain": inside, '"': not inside, '""': inside, 'x"y': False, '"a","b': True,
        'a,"b': not inside, 'end",x': False, '"a""b': True if not inside else False, "": inside,
    }
    for line, after in cases.items():
        assert quoted_text.inside_after(line, inside) == after, line


def test_states_of_many_lines_at_once():
    chosen = random.Random(3)
    lines = ["".join(chosen.choices('",aé \r', k=chosen.randrange(12))) for _ in range(4000)]
    outside, inside = quoted_text.insides_after(pa.array(lines))
    assert outside == [quoted_text.inside_after(line, False) for line in lines]
    assert inside == [quoted_text.inside_after(line, True) for line in lines]


def test_ranges_are_tasks_whatever_the_session_says(spark, tmp_path):
    path = write_files(tmp_path / "one", {"f.csv": "a,b,c\n" + '1,"two\nlines",3\n' * 2000})
    lines = quoted_text.lines_of(spark, path, 1000)
    size = len('1,"two\nlines",3\n') * 2000 + 6
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    try:
        assert lines.rdd.getNumPartitions() >= size // 1000
        starts = [row[0] for row in lines.select("start").distinct().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(starts) >= size // 1000 and all(start % 1000 == 0 for start in starts)
    found = text_cells(spark, path, NAMES, True, 1000)
    assert found.distinct().collect() == [("1", "two\nlines", "3")] and found.count() == 2000


def test_small_ranges_share_tasks(spark, tmp_path):
    path = write_files(tmp_path / "one", {"f.csv": "a,b,c\n" + '1,"two\nlines",3\n' * 2000})
    records = quoted_text.quoted_records(spark, path, 100)
    most = 2 * spark.sparkContext.defaultParallelism
    tasks = records.rdd.getNumPartitions()
    assert tasks <= most + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert records.filter("NOT header").count() == 2000
    assert quoted_text.tasks_for(spark, path) == most


def test_a_record_over_many_ranges(spark, tmp_path):
    cell = "word\n" * 400
    path = write_files(tmp_path / "one", {"f.csv": f'a,b,c\n1,"{cell}",3\n4,5,6\n'})
    assert read(spark, path, 50) == read(spark, path, 1 << 30)


@pytest.mark.parametrize(
    "text", ["a,b,d\n1,2,3\n", "a,b,c\n1,2\n", 'a,b,c\n1,"2\n2",3,4\n', "a,b,c\n   \n1,2,3\n"]
)
def test_malformed_files_fail(spark, tmp_path, text):
    path = write_files(tmp_path / "one", {"f.csv": text})
    for size in (4, 1 << 30):
        with pytest.raises((PySparkException, Exception), match="(?i)header|malformed|conform"):
            text_cells(spark, path, NAMES, True, size).collect()


def test_empty_files_have_no_rows(spark, tmp_path):
    path = write_files(tmp_path / "parts", {"e.csv": "", "h.csv": "a,b,c\n", "f.csv": 'a,b,c\n1,2,"3\n4"'})
    assert read(spark, path, 3) == read(spark, path, 1 << 30) == ["Row(a='1', b='2', c='3\\n4')"]


def test_more_states_than_fit_are_not_held(spark, tmp_path, monkeypatch):
    path = write_files(tmp_path / "one", {"f.csv": drawn(5, 20)})
    whole = read(spark, path, 1 << 30)
    monkeypatch.setattr(quoted_text, "MOST_RANGES", 2)
    assert quoted_text.quoted_records(spark, path, 7) is None
    assert read(spark, path, 7) == whole


def test_load_of_a_review_file_in_ranges(spark, warehouse, marketplace_files):
    files = {"olist_order_reviews_dataset.csv": "olist_order_reviews"}
    assert csv_files.longest_file(spark, f"{marketplace_files}/olist_order_reviews_dataset.csv") > 64
    whole = load_csv_tables(warehouse, marketplace_files, files, "whole")
    cut = load_csv_tables(warehouse, marketplace_files, files, "cut", range_bytes=64)
    assert whole == cut
    one, two = (warehouse.read(space, "olist_order_reviews") for space in ("whole", "cut"))
    assert one.columns == two.columns == [name for name, _ in RAW_COLUMNS["olist_order_reviews"]]
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
