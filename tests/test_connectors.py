from pyspark.sql import functions as F

from gristmill.sources import connectors

RSS = '<rss><channel><item><title><![CDATA[A & B]]></title><link>http://x/1</link><pubDate>d1</pubDate></item><item><title>no link</title></item></channel></rss>'
ATOM = '<feed><entry><title>T</title><link rel="alternate" href="http://x/2"/><updated>d2</updated></entry></feed>'


def test_feeds_and_sitemaps(spark):
    feeds = spark.createDataFrame([(1, RSS), (2, ATOM), (3, "<!DOCTYPE x><rss><item><link>http://bad</link></item></rss>"), (4, None)], "id int, xml string")
    got = sorted(tuple(r) for r in connectors.feed_entries(feeds).collect())
    assert got == [(1, "http://x/1", "A & B", "d1"), (2, "http://x/2", "T", "d2")]
    maps = spark.createDataFrame([(1, "<urlset><url><loc> http://x/?a=1&amp;b </loc></url></urlset>"), (2, "<sitemapindex><sitemap><loc>http://x/s.xml</loc></sitemap></sitemapindex>")], "id int, xml string")
    assert sorted(tuple(r) for r in connectors.sitemap_locations(maps).collect()) == [(1, "http://x/?a=1&b", False), (2, "http://x/s.xml", True)]


def test_unseen_and_dates(spark):
    c = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4)], "url string, pos int")
    assert sorted(tuple(r) for r in connectors.unseen(c, c.where("url = 'b'"), order="pos").collect()) == [("a", 1), ("c", 4)]
    d = spark.createDataFrame([("2024-05-06T01:00", "", ""), (None, "http://x/2023/1-2/a", ""), (None, "", "s_20220304T050607"), (None, "", "")], "m string, u string, k string")
    assert [r[0] for r in d.select(connectors.event_date(F.col("m"), F.col("u"), F.col("k"))).collect()] == ["2024-05-06", "2023-01-02", "2022-03-04", None]
