"""Feed pages, seeds and profiles."""

from __future__ import annotations

import json
from datetime import datetime

from trendspark.sources import landing
from trendspark.sources.feeds import feed_rows, read_feed
from trendspark.sources.seeds import default_source_config, load_profile, read_source_config

PAGE = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom">
  <title>query results</title>
  <entry>
    <id>http://example.org/abs/2601.00001v2</id>
    <title>A title
      over  two lines</title>
    <summary>
  Body &amp; more.
    </summary>
    <published>2026-01-05T10:00:00Z</published>
    <updated>2026-01-06T10:00:00Z</updated>
    <author><name>Ada</name></author>
    <author><name> Bob </name></author>
    <category term="cs.DB" scheme="x"/>
    <category term="cs.AI" scheme="x"/>
    <link href="http://example.org/abs/2601.00001v2" rel="alternate"/>
    <link href="http://example.org/pdf/2601.00001v2" rel="related" title="pdf"/>
  </entry>
  <entry>
    <id>http://example.org/abs/2601.00002</id>
    <title>Plain</title>
    <published>not a date</published>
    <author><name>Cy</name></author>
    <category term="cs.DB"/>
    <link href="http://example.org/abs/2601.00002" rel="alternate"/>
  </entry>
  <entry>
    <title>No id</title>
  </entry>
</feed>
"""


def test_feed_entries_become_rows(spark, tmp_path):
    (tmp_path / "page.xml").write_text(PAGE, encoding="utf-8")
    rows = {r.native_id: r for r in feed_rows(read_feed(spark, str(tmp_path)), "arxiv:cs.DB").collect()}
    assert set(rows) == {"2601.00001", "2601.00002"}
    first = json.loads(rows["2601.00001"].payload)
    assert first["title"] == "A title over two lines"
    assert first["summary"] == "Body & more."
    assert first["version"] == "v2"
    assert first["authors"] == ["Ada", "Bob"]
    assert first["categories"] == ["cs.DB", "cs.AI"]
    assert first["abs_url"] == "http://example.org/abs/2601.00001v2"
    assert first["pdf_url"] == "http://example.org/pdf/2601.00001v2"
    assert rows["2601.00001"].event_ts == datetime(2026, 1, 5, 10)
    second = json.loads(rows["2601.00002"].payload)
    assert second["version"] is None and second["pdf_url"] is None and second["summary"] == ""
    assert rows["2601.00002"].event_ts is None


def test_source_config_from_csv(spark, tmp_path):
    path = tmp_path / "config.csv"
    path.write_text("source,half_life_hours,digest_quota,authority_note\narxiv,72,4,a note\n")
    row = read_source_config(spark, str(path)).first()
    assert (row.source, row.half_life_hours, row.digest_quota) == ("arxiv", 72, 4)
    assert default_source_config(spark).count() == 3


def test_profile_text_is_folded(spark, tmp_path):
    path = tmp_path / "profile.json"
    path.write_text(json.dumps({"key": "k", "label": "L", "text": " a\n  b "}) + "\n")
    row = load_profile(spark, str(path)).first()
    assert (row.interest_key, row.text) == ("k", "a b")


def test_seed_notes_keep_quotes_and_line_ends(spark, tmp_path):
    text = 'source,half_life_hours,digest_quota,authority_note\r\nblog,12,,"says ""why"",\nthen stops"\n'
    (tmp_path / "config.csv").write_text(text, encoding="utf-8")
    (row,) = read_source_config(spark, str(tmp_path)).collect()
    assert tuple(row) == ("blog", 12, None, 'says "why",\nthen stops')


def test_torn_pages_and_lines_fail_their_source_alone(spark, tmp_path):
    def put(kind, source, name, text):
        folder = tmp_path / kind / f"source_name={source}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text, encoding="utf-8")

    entry = "<entry><id>http://example.org/abs/{}</id><title>{}</title></entry>"
    put("feeds", "whole", "a.xml", f"<feed>{entry.format('a1', 'x &amp; y')}{entry.format('a2', '')}</feed>")
    put("feeds", "torn", "a.xml", f"<feed>{entry.format('b1', 'fine')}</feed>")
    put("feeds", "torn", "b.xml", f"<feed>{entry.format('b2', 'fine')}<entry><id>b3</id><title>cut")
    put("items", "lines", "a.json", '{"id": 1, "type": "story"}\n\n{"id": 2, "type": "job"}\n')
    put("items", "half", "a.json", '{"id": 3, "type": "story"}\n{"id": 4, "ty\n')
    feeds = landing.landed_feeds(spark, str(tmp_path / "feeds"))
    items = landing.landed_items(spark, str(tmp_path / "items"))
    assert {r.source_name for r in landing.failures(feeds, items).collect()} == {"torn", "half"}
    rows = {(r.source_name, r.native_id) for r in landing.readable_rows(feeds, items).collect()}
    assert {r for r in rows if r[0] in ("whole", "lines")} == {("whole", "a1"), ("whole", "a2"), ("lines", "1")}
    assert landing.failures(feeds.filter("source_name = 'whole'")).count() == 0
