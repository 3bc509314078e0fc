"""Round trip through archives, order of the merged index, the loser tree."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import warc
from orderloom.llm.tables import staging


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_loser_tree_is_stable():
    class Item(tuple):
        pass
    runs = [[(1, "a"), (2, "a")], [(1, "a")], []]
    assert list(warc.LoserTree(runs)) == [(1, "a"), (1, "a"), (2, "a")]


def test_url_key():
    cases = {"https://www.Example.com:443/A/b?x=1#top": "com,example)/A/b?x=1", "http://a.b.c": "c,b,a)/", "http://u:p@h.org?q": "org,h)/?q", "mailto:x": "mailto:x", "": "", None: ""}
    assert {u: warc.url_key(u) for u in cases} == cases


def rows_of():
    big, crlf = "x" * 1000, "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc" * 40
    rows = [(i, f"http://h{i % 5}.com/p{i % 7}", f"<p>{i}</p>") for i in range(40)]
    rows += [(100 + i, "http://copy.com/", big) for i in range(6)] + [(200 + i, f"http://c{i}.com/", crlf) for i in range(3)]
    rows += [(300, None, "é" * 600), (301, "http://x.com/a\r\nb", "é" * 600), (302, "http://s.com/", "short"), (303, "http://s.com/", "short"), (304, "http://n.com/", None),
             (305, "http://n.com/", None), (306, "http://e.com/", ""), (None, "http://null.com/", big), (None, None, None), (105, "http://copy.com/", big), (307, "not a url", "y\x00z")]
    return rows


def brute(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == raw]
        top = max(same) if len(raw) >= 1000 and page is not None else page
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if page == top else "revisit", None if page == top else top))
    return sorted(out, key=str)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 9000)  # several records a file, several files
    pages = spark.createDataFrame(rows_of(), "page_id long, url string, html string").selectExpr("*", "page_id AS digest", "html AS record", "page_id AS size").repartition(3)
    out = warc.archive_roundtrip(pages)
    got = out.collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows_of())
    assert len({r.file for r in got}) > 3
    ranked = sorted(got, key=lambda r: r.history_rank)
    assert [r.history_rank for r in ranked] == list(range(len(got)))
    order = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in ranked]
    assert order == sorted(order)
    for r in got:  # the index leads to the record
        with open(r.file.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            assert f.read(9) == b"WARC/1.1\r"


def test_ranges(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "http://hot.com/" if i % 3 else f"http://h{i}.com/", f"{i}") for i in range(500)], "page_id long, url string, html string").repartition(4)
    path = f"{staging(spark).root}-ranges"
    warc.write_archives(pages, path)
    merged = warc.merge_runs(warc.read_archives(spark, path), range_rows=40).collect()
    ranked = sorted(merged, key=lambda r: r.history_rank)
    assert [r.history_rank for r in ranked] == list(range(500))
    assert [(r.url_key, r.page_id) for r in ranked] == sorted((r.url_key, r.page_id) for r in merged)


def test_ill_formed_archives_are_errors():
    for content in (b"no warc", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse(content))


def test_empty(spark):
    assert warc.archive_roundtrip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
