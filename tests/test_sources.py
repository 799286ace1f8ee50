"""Delimited scan, word list and query lines: edge cases of the text formats."""

from __future__ import annotations

from pyspark.sql import types as T

from geoscribe.sources import scan_delimited, scan_query_lines, scan_word_list

SCHEMA = [("a", T.StringType()), ("n", T.LongType()), ("off", T.IntegerType()), ("x", T.DoubleType()),
          ("b", T.StringType())]


def test_delimited_edge_cases(spark, tmp_path):
    path = tmp_path / "rows.tsv"
    path.write_bytes("\r\n".join([
        'q"uote\t1\t3600.0\t-1.5\tend',      # unbalanced quote, decimal offset
        "trail\t2\t0\t0.5\t",                # trailing empty field stays ''
        "extra\t3\t-7\t2e3\tb\tignored",     # more fields than the schema
        "bad\tx\t1.5e3\tnan?\t",             # unparsable numbers -> NULL
        "short\t4",                          # missing fields -> NULL
    ]).encode("utf-8") + b"\r\n")
    rows = {r.a: r for r in scan_delimited(spark, str(path), SCHEMA).collect()}
    assert len(rows) == 5
    assert rows['q"uote'].n == 1 and rows['q"uote'].off == 3600 and rows['q"uote'].b == "end"
    assert rows["trail"].b == ""
    assert rows["extra"].x == 2000.0 and rows["extra"].b == "b"
    assert rows["bad"].n is None and rows["bad"].off == 1500 and rows["bad"].x is None
    assert rows["short"].n == 4 and rows["short"].off is None and rows["short"].b is None


def test_word_list_keeps_words_as_written(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("The\nand\r\n\nof\n", encoding="utf-8")
    assert [r.word for r in scan_word_list(spark, str(path)).collect()] == ["The", "and", "", "of"]


def test_query_lines_all_lines(spark, tmp_path):
    path = tmp_path / "q.txt"
    path.write_text("A b a\nsecond  LINE \n\n", encoding="utf-8")
    rows = scan_query_lines(spark, str(path), first_line_only=False).orderBy("query_id").collect()
    assert [r.words for r in rows] == [["a", "b"], ["second", "", "line"], [""]]


def test_single_file_sink_is_globally_sorted(spark, tmp_path):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from geoscribe import sinks
    from geoscribe.sources import table

    ev = table(spark, SF_SMALL, "events").repartition(16).select("event_id", "value")
    out = tmp_path / "sorted"
    sinks.write_tsv(ev, str(out), ["value", "event_id"], order_by=[F.col("value").desc(), F.col("event_id")],
                    single_file=True)
    parts = sorted(out.glob("part-*"))
    assert len(parts) == 1
    rows = [line.split("\t") for line in parts[0].read_text(encoding="utf-8").splitlines()]
    keys = [(-float(v), int(i)) for v, i in rows]
    assert len(keys) == ev.count() and keys == sorted(keys)
