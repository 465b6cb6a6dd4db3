from __future__ import annotations

import pytest
from conftest import rows

from tallywise.plans import files
from tallywise.session import scratch_path, shared_folder
from tallywise.sinks import write_pairs
from tallywise.sources import (
    count_files,
    read_documents,
    read_pairs,
    read_query,
    read_stop_words,
    read_texts,
    spread,
)


@pytest.fixture
def folder(tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "f1.txt").write_text("the cat sat\nthe cat ran\n")
    (docs / "f2.txt").write_text("the dog sat of a dog dog\n")
    (docs / "f 3+%.txt").write_text("a bird sang the song\n")
    (docs / "f4.txt").write_text("cat bird")
    (docs / "empty.txt").write_text("")
    (tmp_path / "stop.txt").write_text("the\nof\na\n the\nthe\n")
    (tmp_path / "query.txt").write_text("cat dog the cat\nbird\n")
    return tmp_path


def lines(spark, path):
    return [r.value for r in spark.read.text(str(path)).collect()]


def test_sources(spark, folder):
    docs = read_documents(spark, str(folder / "docs"))
    assert {r.doc for r in docs.collect()} == {"f1.txt", "f2.txt", "f 3+%.txt", "f4.txt"}
    assert count_files(spark, str(folder / "docs")) == 5
    both = [str(folder / "docs" / name) for name in ("f1.txt", "f4.txt")]
    assert rows(read_texts(spark, both)) == [("cat bird",), ("the cat ran",), ("the cat sat",)]
    assert rows(read_stop_words(spark, str(folder / "stop.txt"))) == [
        (" the",), ("a",), ("of",), ("the",)
    ]
    assert rows(read_query(spark, str(folder / "query.txt"))) == [("cat",), ("dog",), ("the",)]


def test_missing_file_raises(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_stop_words(spark, str(folder / "none.txt"))


def test_pairs(spark, tmp_path):
    data = [('"quoted', 1), ("a,b", 2), (" ", 3), ("back\\slash", 4)]
    df = spark.createDataFrame(data, "word string, n int")
    out = str(tmp_path / "out")
    write_pairs(df, out, files=2)
    assert rows(read_pairs(spark, out)) == sorted((w, str(n)) for w, n in data)
    assert len(list((tmp_path / "out").glob("part-*.txt"))) == 2
    with pytest.raises(Exception, match="already exists"):
        write_pairs(df, out)
    (tmp_path / "raw.txt").write_text("no tab\nk\tv\tw\n\tonly value\n")
    assert rows(read_pairs(spark, str(tmp_path / "raw.txt"))) == [
        ("", "only value"), ("k", "v\tw"), ("no tab", "")
    ]


def test_word_count_program(spark, folder):
    files.word_count_files(spark, [str(folder / "docs")], str(folder / "wc"))
    assert lines(spark, folder / "wc")[:3] == ["a\t2", "bird\t2", "cat\t3"]
    two = [str(folder / "docs" / "f1.txt"), str(folder / "docs" / "f4.txt")]
    files.word_count_files(spark, two, str(folder / "wc2"), str(folder / "stop.txt"))
    assert lines(spark, folder / "wc2") == ["bird\t1", "cat\t3", "ran\t1", "sat\t1"]


def test_common_words_programs(spark, folder):
    (folder / "a.txt").write_text("the cat and the hat\ncat cat dog dog\n")
    (folder / "b.txt").write_text("a cat cat dog dog. dog\nhat hat\n")
    args = [str(folder / name) for name in ("a.txt", "b.txt")]
    stop = str(folder / "stop.txt")
    files.common_words_files(spark, *args, str(folder / "common"), stop)
    assert lines(spark, folder / "common") == ["1\that", "2\tcat", "2\tdog"]
    files.top_common_words_files(spark, *args, str(folder / "top"), stop, k=1)
    assert lines(spark, folder / "top") == ["2\tcat", "2\tdog"]


def test_search_program(spark, folder):
    args = [str(folder / name) for name in ("docs", "query.txt")]
    stop = str(folder / "stop.txt")
    files.search_files(spark, *args, str(folder / "found"), stop, n_docs=4)
    assert lines(spark, folder / "found") == [
        "0.972771695\tf2.txt", "0.707106781\tf4.txt", "0.603666547\tf1.txt"
    ]
    files.search_files(spark, *args, str(folder / "counted"), stop)
    files.search_files(spark, *args, str(folder / "five"), stop, n_docs=5)
    assert lines(spark, folder / "counted") == lines(spark, folder / "five")


def test_pagerank_program(spark, folder):
    (folder / "graph.txt").write_text("A\tB\tC\nB\tC\nC\tA\n")
    files.pagerank_files(spark, str(folder / "graph.txt"), str(folder / "ranks"), iterations=1)
    assert sorted(lines(spark, folder / "ranks")) == ["A\t0.9 B C", "B\t0.475 C", "C\t1.325 A"]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(shared_folder(spark))


def test_spread_leaves_wide_scans_alone(spark):
    narrow, wide = spark.range(10).coalesce(1), spark.range(0, 10, 1, 50)
    assert spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(wide) is wide


def test_order_goes_on_from_file_to_file(spark, folder):
    files.word_count_files(spark, [str(folder / "docs")], str(folder / "wc"))
    files.word_count_files(spark, [str(folder / "docs")], str(folder / "wc3"), files=3)
    parts = sorted((folder / "wc3").glob("part-*.txt"))
    assert 1 < len(parts) <= 3
    assert "".join(p.read_text() for p in parts).splitlines() == lines(spark, folder / "wc")


@pytest.mark.parametrize("value", ["a\tb", "a\nb"])
def test_pairs_that_no_line_can_hold(spark, tmp_path, value):
    df = spark.createDataFrame([(value, 1)], "word string, n int")
    with pytest.raises(Exception, match="separator"):
        write_pairs(df, str(tmp_path / "out"))
