"""Extraction on the hand-made listing pages (FIXTURES F7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import f7_pages as P
from offerlake.functions import html as H
from offerlake.operators import extract as X

def crawled():
    return F.lit("2024-01-22 10:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def olx(spark):
    pages = spark.createDataFrame(
        [(1, "https://www.olx.pl/d/oferta/a", P.OLX_PAGE), (2, "u", P.OLX_PAGE_TODAY), (3, "u", P.OLX_BROKEN)],
        "page_id long, url string, html string")
    return {r["page_id"]: r for r in X.olx_bronze(pages, crawled()).collect()}


@pytest.fixture(scope="module")
def otodom(spark):
    pages = spark.createDataFrame(
        [(1, "u", P.OTODOM_PAGE), (2, "u", P.OTODOM_NO_DISTRICT), (3, "u", P.OTODOM_BROKEN)],
        "page_id long, url string, html string")
    return {r["page_id"]: r for r in X.otodom_bronze(pages, crawled()).collect()}


def test_olx_page(olx):
    r = olx[1]
    assert r["offer_source"] == "olx" and r["offer_id"] == "884512"
    assert r["title"] == "Mieszkanie 52,5 m² & balkon"
    assert r["canonical_url"].endswith("mieszkanie-CID3-ID1.html")
    assert r["short_description"] == "Słoneczne mieszkanie\nprzy parku"
    assert r["description"] == "Pierwszy akapit opisu."
    assert (r["price_total"], r["city"], r["district"], r["region"]) == ("450 000 zł", "Warszawa", "Mokotów", "mazowieckie")
    assert r["location"] == "Mokotów;Warszawa;mazowieckie"
    assert (r["offer_type"], r["price_per_msq"], r["primary_market"]) == ("Prywatne", "12345.67", True)
    assert (r["floor"], r["building_type"], r["size"], r["n_rooms"]) == ("Parter", "Blok", "52.5", "2")
    assert r["offer_date"] == "2024-01-12" and r["modified_date"] == "2024-01-12"
    assert r["image_urls"] == ["https://img.example/1.jpg", "https://img.example/2.jpg"]
    assert r["date_scraped"] == dt.datetime(2024, 1, 22, 10, 0)


def test_olx_today_left_for_silver(olx):
    assert olx[2]["offer_date"] == "Dzisiaj 12:00"


def test_olx_broken_gives_nulls(olx):
    r = olx[3]
    assert r["offer_id"] is None and r["title"] is None and r["price_total"] is None
    assert r["primary_market"] is False and r["image_urls"] == [] and r["offer_date"] is None


def test_otodom_page(otodom):
    r = otodom[1]
    assert r["offer_id"] == "otodom_65432"
    assert (r["city"], r["district"], r["region"]) == ("Kraków", "Podgórze", "malopolskie")
    assert (r["offer_date"], r["modified_date"]) == ("2024-01-21", "2024-02-01")
    assert r["image_urls"] == ["https://img.example/m1.jpg", "https://img.example/m2.jpg"]
    assert (r["price_total"], r["price_per_msq"], r["location"]) == ("799 000 zł", "15 215 zł/m²", "Kraków, Podgórze")
    assert (r["size"], r["n_rooms"], r["floor"], r["rent"], r["market"]) == ("52,5 m²", "3", "parter/4", "650 zł", "pierwotny")
    assert r["lift"] == "tak" and r["media_types"] == "internet, telefon" and r["building_material"] == "cegła"
    assert r["heating_type"] is None and r["description"] == "Pierwszy akapit."


def test_otodom_missing_district_and_empty_cell(otodom):
    r = otodom[2]
    assert r["district"] == "" and r["rent"] is None


def test_otodom_without_script(otodom):
    r = otodom[3]
    assert r["offer_id"] is None and r["city"] is None and r["image_urls"] is None and r["offer_date"] is None
    assert r["title"] == "Mieszkanie, Kraków"


def test_extracted_rows_flow_to_silver(spark, olx):
    from offerlake.plans.pipeline import bronze_to_silver

    pages = spark.createDataFrame([(1, "u", P.OLX_PAGE), (2, "u", P.OLX_PAGE_TODAY)], "page_id long, url string, html string")
    bronze = X.olx_bronze(pages, crawled()).drop("page_id")
    silver = bronze_to_silver(bronze, "olx").collect()
    assert len(silver) == 1  # same id and short description: one survivor
    s = silver[0]
    assert s["offer_id"] == "olx_884512" and s["price_total"] == 450000.0 and s["floor"] == 0
    assert s["offer_type"] == "private_owner" and s["building_type"] == "block" and s["city"] == "warszawa"
    assert s["size"] == 52.5 and s["n_rooms"] == 2


def test_links_and_seeds(spark):
    html = '<a href="/d/oferta/x">a</a><a href="https://otodom.pl/d/oferta/y">b</a><a href="rel">c</a><a href="/d/oferta/x">d</a>'
    pages = spark.createDataFrame([(1, "https://www.olx.pl/list/?page=3", html)], "page_id long, url string, html string")
    links = sorted(r["link"] for r in X.harvest_links(pages, [r"d/oferta"], ["otodom"]).collect())
    assert links == ["https://www.olx.pl/d/oferta/x"]
    every = sorted(r["link"] for r in X.harvest_links(pages).collect())
    assert "https://www.olx.pl/list/rel" in every and len(every) == 3
    seeds = [r["seed_url"] for r in X.crawl_seeds(pages).orderBy("page").collect()]
    assert seeds == [f"https://www.olx.pl/list/?page={i}" for i in (1, 2, 3)]


BASE = "https://h.pl/a/b?page=1"


@pytest.mark.parametrize(
    "base,href,want",
    [
        (BASE, "?page=2", "https://h.pl/a/b?page=2"),
        (BASE, "../z", "https://h.pl/z"),
        (BASE, "#f", "https://h.pl/a/b?page=1"),
        (BASE, "", "https://h.pl/a/b?page=1"),
        (BASE, "c#x", "https://h.pl/a/c"),
        (BASE, "/d/oferta/x?q=1", "https://h.pl/d/oferta/x?q=1"),
        (BASE, "//o.pl/p", "https://o.pl/p"),
        (BASE, "//o.pl", "https://o.pl"),
        (BASE, "http://o.pl/../p", "http://o.pl/../p"),
        (BASE, "  x y ", "https://h.pl/a/x y"),
        ("https://h.pl", "x", "https://h.pl/x"),
        ("https://h.pl?q", "?r", "https://h.pl?r"),
        # The examples of RFC 3986, 5.4.
        *[
            ("http://a/b/c/d;p?q", r, "http://a" + w)
            for r, w in (
                ("g", "/b/c/g"), ("./g", "/b/c/g"), ("g/", "/b/c/g/"), ("/g", "/g"), ("?y", "/b/c/d;p?y"), ("g?y", "/b/c/g?y"),
                (";x", "/b/c/;x"), (".", "/b/c/"), ("./", "/b/c/"), ("..", "/b/"), ("../", "/b/"), ("../g", "/b/g"), ("../..", "/"),
                ("../../g", "/g"), ("../../../g", "/g"), ("/./g", "/g"), ("/../g", "/g"), ("g.", "/b/c/g."), ("..g", "/b/c/..g"),
                ("./../g", "/b/g"), ("./g/.", "/b/c/g/"), ("g/./h", "/b/c/g/h"), ("g/../h", "/b/c/h"), ("g;x=1/../y", "/b/c/y"),
            )
        ],
    ],
)
def test_links_resolve_as_defined(spark, base, href, want):
    got = spark.createDataFrame([(href, base)], "h string, b string").select(X.resolve_url(F.col("h"), F.col("b")).alias("x"))
    assert got.first()["x"] == want


def page(spark, html, url="https://www.olx.pl/l/?page=1"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_links_by_anchor_domain_and_scheme(spark):
    html = """<a data-testid="pagination-forward" href="?page=2">n</a><a href='mailto:x@y.pl'>m</a><a href="javascript:f()">j</a>
    <a data-href="/no" href="/yes">y</a><a name="t">no link</a><A HREF="https://m.olx.pl/d/oferta/1">a</A>
    <a href="https://notolx.pl/1">b</a><a href="https://olx.pl.evil.com/1">c</a><a href="ftp://olx.pl/f">f</a>"""
    df = page(spark, html)

    def links(**kw):
        return sorted(r["link"] for r in X.harvest_links(df, **kw).collect())

    assert links(anchor=("data-testid", "pagination-forward")) == ["https://www.olx.pl/l/?page=2"]
    assert links(domains=["olx.pl"]) == [
        "ftp://olx.pl/f", "https://m.olx.pl/d/oferta/1", "https://www.olx.pl/l/?page=2", "https://www.olx.pl/yes",
    ]
    assert len(links()) == 6


def one(spark, html, expr):
    return page(spark, html).select(expr.alias("x")).first()["x"]


def test_values_match_in_their_case_and_names_in_any(spark):
    html = """<div ARIA-LABEL="CENA">1</div><DIV aria-label='Cena'>2</DIV>"""
    assert one(spark, html, H.direct_text("html", "div", "aria-label", "Cena")) == "2"


def test_attribute_names_are_whole_and_quotes_match(spark):
    html = """<script data-id="S">no</script><script id='S" x'>no</script><script id="S">yes</script>"""
    assert one(spark, html, H.script_body("html", "S")) == "yes"
    assert one(spark, """<meta name="description" data-content="n" content='it"s'>""", X.meta_description()) == 'it"s'
    assert one(spark, """<meta name="description">""", X.meta_description()) is None


def test_nested_elements_are_kept_whole(spark):
    bar = '<div data-cy="ad-footer-bar-section"><div><div>x</div></div><span>ID:</span><span>77</span><span></span></div><div><span>9</span></div>'
    assert one(spark, bar, X.olx_offer_id()) == "77"
    html = "<div id='a'>1<div>2<DIV class='q'>3</DIV></div>4<divider>5</divider></div>6"
    assert one(spark, html, H.element_inner("html", "div", "id", "a")) == "1<div>2<DIV class='q'>3</DIV></div>4<divider>5</divider>"
    assert one(spark, "<div id='a'>open", H.element_inner("html", "div", "id", "a")) == "open"
    assert one(spark, "<p>x</p>", H.element_inner("html", "div", "id", "a")) is None


def test_text_nodes_skip_inner_tags(spark):
    assert one(spark, "<p><b class='x'>bold</b> rest</p>", X.first_paragraph_text()) == "bold"


def test_seeds_of_a_page_number_that_nobody_saw_a_table_of(spark):
    pages = page(spark, "", "https://h.pl/x?page=2000003")
    got = X.crawl_seeds(pages)
    assert got.agg(F.count("*"), F.max("page"), F.countDistinct("page")).first()[:] == (2000003, 2000003, 2000003)


def test_a_json_document_is_read_like_its_text(spark):
    """By VARIANT where it can hold the text, else from the text: keys that occur twice, texts that are no JSON."""
    docs = ['{"a": {"b": 1, "c": null, "d": "x", "e": true}}', '{"a": {"b": 1, "b": 2}}', "no json", "", "[1]", None, '{"a": {"b": 12345678901234567890}}']
    df = spark.createDataFrame([(d,) for d in docs], "t string").select("t", H.json_document(F.col("t")).alias("j"))
    for path in ("$.a.b", "$.a.c", "$.a.d", "$.a.e", "$.x"):
        rows = df.select(H.json_text(F.col("j"), path).alias("got"), F.get_json_object("t", path).alias("want")).collect()
        assert [r["got"] for r in rows] == [r["want"] for r in rows], path


def test_cells_are_found_in_one_pass_and_named_by_their_first_attribute(spark):
    from offerlake.operators import extract

    page = (
        '<div data-testid="other" data-testid="table-value-floor">wrong</div><div data-testid="table-value-floor"></div>'
        "<DIV class='x' DATA-TESTID = 'table-value-area' title='a\"b'>5\" > 4 &amp; more</div><div data-testid=\"table-value-area\">wrong</div>"
        '<div data-testid="table-value-lift\'>wrong</div><div xdata-testid="table-value-rent">wrong</div>'
        '<div\ndata-testid="table-value-rent" data-testid="table-value-car"\n>table-value-car<b>no</b></div>'
    )
    df = spark.createDataFrame([(1, page), (2, ""), (3, None)], "page_id long, html string").withColumn("cells", extract.otodom_cells())
    got = {r["page_id"]: r.asDict() for r in df.select("page_id", *[e.alias(n) for n, e in extract.otodom_details(F.col("cells")).items()]).collect()}
    want = {"size": '5" > 4 & more', "rent": "table-value-car"}
    assert {k: v for k, v in got[1].items() if v is not None and k != "page_id"} == want
    assert all(v is None for i in (2, 3) for k, v in got[i].items() if k != "page_id")
    out = extract.otodom_bronze(df.drop("cells").withColumn("url", F.lit("u")))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("table-value-area|") <= 3  # in the lookahead twice: one pattern, not one for each column


def test_a_page_is_searched_once_for_each_anchor(spark):
    pages = spark.createDataFrame([(1, "")], "page_id long, html string")
    for column in (X.canonical_url(), X.meta_description(), X.next_data(), X.page_title(), H.direct_text("html", "a", "x", "y")):
        plan = pages.select(column)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract(html#") == 1


@pytest.mark.parametrize(
    "tag,want",
    [
        ('<div a="1" id="v">', "in"),
        ("<DIV\n\tID\x0b = 'v' b>", "in"),
        ('<div id="w" id="v">', "in"),  # any attribute of the name
        ('<div x="<b" id="v">', "in"),
        ('<div x=" id="v">', "in"),  # white space before the name is all that is asked for
        ('<div\xa0id="v">', None),
        ('<div x="a>b" id="v">', None),  # a tag ends at the first '>'
        ('<div xid="v">', None),
        ('<div id="V">', None),
        ('<divid="v">', None),
        ('<div id="v"><p>first</p></div><div id="v">', "<p>first</p>"),
        ('<b title="v">v</b> v <div id="v">', "in"),  # the value elsewhere before the tag
        ('<div title="v" id="v">', "in"),
    ],
)
def test_start_tags_are_found_by_an_attribute(spark, tag, want):
    page = f'<p>{tag}in</div id="z"> v <i id="v">'
    assert one(spark, page, H.element_inner("html", "div", "id", "v")) == (want if want != "in" else 'in</div id="z"> v <i id="v">')


def test_a_tag_of_very_many_attributes_does_not_exhaust_the_stack(spark):
    tag = "<div" + ' a="b"' * 50_000
    assert one(spark, f'{tag} aria-label="x">1', H.direct_text("html", "div", "aria-label", "x")) == "1"
    assert one(spark, f"{tag}>1", H.direct_text("html", "div", "aria-label", "x")) is None


def test_attribute_values_in_either_quotes(spark):
    for tag, want in (("<a href=\"x'y&amp;\">", "x'y&"), ("<a HREF = 'x\"y'>", 'x"y'), ("<a href=''>", ""), ("<a href=x>", None), ('<a href="x>', None)):
        assert one(spark, tag, H.attribute_value(F.col("html"), "href")) == want


def test_one_row_group_is_spread_though_its_file_has_many_splits(spark, tmp_root):
    """A file of a single row group and of enough bytes for a split per core is still read by one task."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from offerlake.sources import fixtures

    n = 400_000
    pq.write_table(pa.table({"k": list(range(n)), "x": [hash(i) * 0.37 % 1 for i in range(n)]}), f"{tmp_root}/t.parquet", row_group_size=n)
    at, key = f"{tmp_root}/t.parquet", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        scan = spark.read.parquet(at)
        want = spark.sparkContext.defaultParallelism
        assert scan.rdd.getNumPartitions() >= want
        sizes = [r["count"] for r in fixtures.spread(scan).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == want and max(sizes) < 2 * n / want
        many = scan.repartition(2 * want)
        many.write.parquet(f"{tmp_root}/many")
        stored = spark.read.parquet(f"{tmp_root}/many")
        assert fixtures.spread(stored) is stored
    finally:
        spark.conf.set(key, before)


def test_tasks_of_too_many_rows_get_smaller_splits_where_row_groups_allow(spark, tmp_root, monkeypatch):
    """A file of many row groups needs no shuffle: its splits are cut smaller."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from offerlake.sources import fixtures

    n, key = 400_000, "spark.sql.files.maxPartitionBytes"
    pq.write_table(pa.table({"k": list(range(n)), "x": [hash(i) * 0.37 % 1 for i in range(n)]}), f"{tmp_root}/t.parquet", row_group_size=5_000)
    before = spark.conf.get(key)
    monkeypatch.setattr(fixtures, "TASK_ROWS", 20_000)
    try:
        scan = spark.read.parquet(f"{tmp_root}/t.parquet")
        assert max(fixtures.task_rows(scan)) > 2 * 20_000
        assert fixtures.spread(scan) is scan
        sizes = fixtures.task_rows(scan)
        assert sum(sizes) == n and max(sizes) <= 2 * 20_000
    finally:
        spark.conf.set(key, before)


def test_tasks_of_too_many_rows_are_spread(spark, tmp_root, monkeypatch):
    """Row groups enough for every core, but with more rows than a task should sort."""
    from offerlake.sources import fixtures

    monkeypatch.setattr(fixtures, "TASK_ROWS", 500)
    want = spark.sparkContext.defaultParallelism
    spark.range(4000 * want).repartition(want).write.parquet(f"{tmp_root}/large")
    scan = spark.read.parquet(f"{tmp_root}/large")
    sizes = [r["count"] for r in fixtures.spread(scan).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 * want and max(sizes) <= 2 * 500
    monkeypatch.setattr(fixtures, "TASK_ROWS", 250_000)
    empty = spark.range(0)
    assert fixtures.spread(empty).count() == 0


def test_row_groups_that_fit_the_memory_of_a_task_are_not_shuffled(spark, tmp_root, monkeypatch):
    from offerlake.sources import fixtures

    n = 4 * spark.sparkContext.defaultParallelism
    spark.range(n * 3000).repartition(n).write.parquet(f"{tmp_root}/large")
    cost = "spark.sql.files.openCostInBytes"
    before = {k: spark.conf.get(k) for k in (fixtures.SPLIT, cost)}
    try:
        spark.conf.set(cost, spark.conf.get(fixtures.SPLIT))  # a task for each file
        scan = spark.read.parquet(f"{tmp_root}/large")
        monkeypatch.setattr(fixtures, "TASK_ROWS", 1000)  # each row group holds three times as many
        monkeypatch.setattr(fixtures, "task_memory", lambda _: 4 * fixtures.TASK_BYTES)
        assert fixtures.most_rows(spark) == 4000 and fixtures.spread(scan) is scan
        monkeypatch.setattr(fixtures, "task_memory", lambda _: fixtures.TASK_BYTES)
        assert fixtures.most_rows(spark) == 2000 and fixtures.spread(scan) is not scan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_memory_of_a_task_is_its_share_of_the_heap(spark):
    from offerlake.session import task_memory

    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert 0 < task_memory(spark) * spark.sparkContext.defaultParallelism <= 0.6 * heap
