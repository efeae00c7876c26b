"""Columns named like the operators' helpers, and archives that others wrote, or broke."""

import gzip
import io
from collections import Counter

import pytest

from equilibra.llm import dedup, mixing, neardup, warc
from equilibra.llm._work import files_of

HELPERS = "whole cut_h cut_id __h __hit __word __top __bits __norm __s __gh __sha __keep __domain __lang __source __times __epoch row __text __id __node __stays rest bucket tokens"
PROSE = " ".join(f"north{k} wind" for k in range(60))


@pytest.fixture(scope="module")
def odd(spark):
    names = HELPERS.split()
    rows = [(k, t, "en", "src1", *[f"{n}{k}" for n in names]) for k, t in enumerate([PROSE, PROSE + "  ", PROSE + " more", "a b c", None, ""])]
    return spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *names])


@pytest.mark.parametrize("stage", [dedup.drop_copies, neardup.drop_near_copies, lambda d: mixing.mixed(d, mixing.Mix({}, share=1.0, epochs=1))])
def test_helper_names_may_be_columns(odd, stage):
    got = stage(odd)
    assert got.columns == odd.columns
    assert not Counter(map(tuple, got.collect())) - Counter(map(tuple, odd.collect())) and got.count() >= 3


def test_of_one_id_and_text_the_least_as_written_stays(spark):
    rows = [(1, "a  b"), (1, "a b"), (1, "a\tb"), (2, "a b")]
    got = dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(1, "a\tb")]


def test_equal_rows_have_records_of_their_own(spark, tmp_path):
    rows = [(7, "u", "<p>")] * 300 + [(7, None, "<p>")] * 5 + [(3, "u", "<p>")] * 4 + [(None, "u", "<q>")] * 50
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}"
    records = warc.read_records(warc.write_archives(pages, folder), folder)
    assert records.count() == 3 * len(rows) and records.select("record_id").distinct().count() == 3 * len(rows)
    captures = warc.assemble(records).collect()
    assert len(captures) == len(rows) and {(len(c["requests"]), len(c["metadata"])) for c in captures} == {(1, 1)}
    got = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect())
    assert got == {(7, "response", None): 305, (3, "revisit", 7): 4, (None, "response", None): 50}


def test_a_truncated_archive_raises():
    one = warc.member("response", "<a>", b"HTTP/1.1 200 OK\r\n\r\n" + b"x" * 5000)
    whole = one + warc.member("metadata", "<b>", b"")
    assert len(list(warc.members(io.BytesIO(whole)))) == 2
    for cut in (1, 20, len(whole) - len(one) - 1):
        with pytest.raises(ValueError, match="ends inside"):
            list(warc.members(io.BytesIO(whole[:-cut])))
    assert list(warc.members(io.BytesIO(b""))) == []


def test_archives_of_others(spark, tmp_path):
    """Field names in any case, no digest, no blank after the colon."""
    record = b"WARC/1.0\r\nwarc-type:response\r\nWarc-Record-Id: <x>\r\nCONTENT-LENGTH: 21\r\n\r\nHTTP/1.1 200 OK\r\n\r\nhi\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record))
    got = warc.read_records(spark.createDataFrame([("a.warc.gz",)], "file string"), f"file://{tmp_path}").collect()
    assert [(r["kind"], r["record_id"], r["payload_bytes"]) for r in got] == [("response", "<x>", 2)]


def test_names_of_stores():
    assert files_of("file:/a/b")[1] == files_of("file:///a/b")[1] == files_of("/a/b")[1] == "/a/b"
    assert files_of("dbfs:/a/b")[1] == "/dbfs/a/b"
