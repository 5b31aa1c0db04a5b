"""Payload adapters: Dataverse JSON, OAI XML, item HTML, folder inventory."""

import json

from pyspark.sql import functions as F

from cataloguer.sources import dataverse as DV
from cataloguer.sources import adapters, disk, html, oai


def _detail(latest):
    return json.dumps({"data": {"latestVersion": latest}})


def test_dataverse_details_shapes(spark):
    fields = [
        {"typeName": "language", "value": ["en", "nl"]},
        {"typeName": "dsDescription", "value": [{"dsDescriptionValue": {"value": "first"}},
                                                {"dsDescriptionValue": {"value": "second"}}]},
        {"typeName": "keyword", "value": [{"keywordValue": {"value": "old"}}]},
        {"typeName": "keyword", "value": [{"keywordValue": {"value": "new"}}, {"keywordValue": {"value": ""}}]},
        {"typeName": "subject", "value": ["Social Sciences", 5, ""]},
        {"typeName": "author", "value": [{"authorName": {"value": "Ann"}}, {"authorName": {"value": ""}}]},
    ]
    rows = [
        (1, _detail({"versionNumber": 1, "versionMinorNumber": 0, "license": {"name": "CC0 1.0", "uri": "u"},
                     "metadataBlocks": {"citation": {"fields": fields}},
                     "files": [{"restricted": False, "dataFile": {"id": 7, "filename": "a.QDPX", "filesize": 3,
                                                                  "restricted": True}}]})),
        (2, _detail({"versionNumber": 2, "versionMinorNumber": None, "license": "DANS Licence",
                     "metadataBlocks": {"citation": {"fields": [{"typeName": "language", "value": "de"}]}},
                     "files": [{"dataFile": {"id": 9}}]})),
        (3, _detail({"license": {"name": "", "uri": "http://x"},
                     "metadataBlocks": {"citation": {"fields": [{"typeName": "language", "value": []}]}}})),
        (4, json.dumps({"data": {}})),
    ]
    df = spark.createDataFrame(rows, "ds int, json string")
    d = DV.parse_details(df, keep=["ds"])
    out = {r["ds"]: r for r in d.select(
        "ds", DV.version().alias("v"), DV.language().alias("lang"), DV.description().alias("desc"),
        DV.keywords().alias("kw"), DV.authors().alias("au"), DV.license_value().alias("lic"),
        F.size("files").alias("nf")).collect()}
    assert out[1]["v"] == "v1.0" and out[2]["v"] == "v2.None" and out[3]["v"] is None
    assert out[1]["lang"] == "en, nl" and out[2]["lang"] == "de" and out[3]["lang"] is None
    assert out[1]["desc"] == "first" and out[2]["desc"] is None
    assert out[1]["kw"] == ["new", "Social Sciences"]  # last keyword field wins; non-strings and blanks dropped
    assert out[1]["au"] == ["Ann"]
    assert out[1]["lic"] == "CC0 1.0" and out[2]["lic"] == "DANS Licence" and out[3]["lic"] == "http://x"
    assert out[4]["lic"] is None and out[4]["nf"] == 0
    files = {(r["ds"], r["file_name"]): r for r in DV.dataset_files(d, "https://api", ["ds"]).collect()}
    assert files[(1, "a.QDPX")]["restricted"] is True and files[(1, "a.QDPX")]["file_type"] == "qdpx"
    assert files[(1, "a.QDPX")]["file_url"] == "https://api/access/datafile/7"
    assert files[(2, "file_9")]["file_size"] is None and files[(2, "file_9")]["restricted"] is False


def test_oai_record_parsing(spark):
    rec = ('<record xmlns="http://www.openarchives.org/OAI/2.0/"><header><identifier> oai:x:1/2 </identifier></header>'
           '<metadata><oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/" '
           'xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title></dc:title><dc:title>Second</dc:title>'
           '<dc:identifier>http://a</dc:identifier><dc:identifier>https://doi.org/1</dc:identifier>'
           '<dc:identifier>https://doi.org/2</dc:identifier><dc:identifier>http://b</dc:identifier>'
           '<dc:identifier>https://opendata.uni-halle.de/handle/1/5</dc:identifier>'
           '<dc:subject> </dc:subject><dc:subject>s1</dc:subject></oai_dc:dc></metadata></record>')
    deleted = ('<record><header status="deleted"><identifier>oai:x:1/3</identifier></header><metadata/></record>')
    df = spark.createDataFrame([(1, rec), (2, deleted)], "rec int, xml string")
    r = oai.parse_records(df, keep=["rec"])
    p = oai.project_rows(r, keep=["rec"]).collect()
    assert len(p) == 1
    row = p[0]
    assert row["oai_id"] == "oai:x:1/2"
    assert row["title"] == "untitled"  # only the first element counts, and it is blank
    assert row["doi"] == "https://doi.org/2" and row["handle"] == "https://opendata.uni-halle.de/handle/1/5"
    assert row["project_url"] == row["handle"]
    assert row["subjects"] == ["s1"]
    assert row["download_project_folder"] == "1_2_untitled"
    ids = spark.createDataFrame([(["http://a", "http://b"],)], "ids array<string>")
    doi, handle = oai.identifiers(F.col("ids"))
    got = ids.select(doi, handle).first()
    assert got[0] == "http://a" and got[1] is None


def test_html_links_and_files(spark):
    page = ('<a href="/bitstream/h/1/a.qdpx">x</a><a href="/bitstream/h/1/a.qdpx">dup</a>'
            '<a href="/bitstream/h/1/thumb.gif">t</a><a href="/bitstream/h/1/b.pdf?sequence=1">q</a>'
            '<a href="/bitstream/h/2/a.qdpx">same name</a><a href="/bitstream/h/1/c.txt">c</a>'
            '<a href="/bitstream/h/1/isAllowed=n/d.txt">kept</a><a href="/bitstream/h/1/dir/">empty</a>')
    df = spark.createDataFrame([(1, 200, page), (2, 404, page), (3, 200, "<p>none</p>")],
                               "page_id int, http_status int, html string")
    links = df.select("page_id", html.bitstream_links(F.col("html"), F.col("http_status")).alias("l")).collect()
    by = {r[0]: r[1] for r in links}
    assert by[1] == ["/bitstream/h/1/a.qdpx", "/bitstream/h/1/thumb.gif", "/bitstream/h/2/a.qdpx",
                     "/bitstream/h/1/c.txt", "/bitstream/h/1/isAllowed=n/d.txt", "/bitstream/h/1/dir/"]
    assert by[2] == [] and by[3] == []
    files = html.page_files(df, keep=["page_id"]).orderBy("page_id", "file_index").collect()
    p1 = [(r["file_name"], r["file_url"]) for r in files if r["page_id"] == 1]
    assert p1 == [("a.qdpx", html.BASE_URL + "/bitstream/h/1/a.qdpx"), ("c.txt", html.BASE_URL + "/bitstream/h/1/c.txt"),
                  ("d.txt", html.BASE_URL + "/bitstream/h/1/isAllowed=n/d.txt")]
    p2 = [(r["file_name"], r["file_type"], r["file_url"]) for r in files if r["page_id"] == 2]
    assert p2 == [("no_files_found.txt", "txt", None)]


def test_disk_usage_excludes_tmp(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"12345")
    (tmp_path / "y.tmp").write_bytes(b"123")
    (tmp_path / "z.TMP").write_bytes(b"12")
    row = disk.disk_usage(spark, str(tmp_path)).first()
    assert row["n_files"] == 2 and row["total_bytes"] == 7


def test_versioned_store_partition_pruning(spark):
    from cataloguer.session import scratch_path
    from cataloguer.sources.store import current_version, read_current, write_version

    base = scratch_path(spark, "t-store")
    df = spark.createDataFrame([(1, "dans"), (2, "uni_halle"), (3, "dans")], "id long, source string")
    assert write_version(spark, df, base, "projects", partition_by=["source"]) == 1
    assert write_version(spark, df.where("id > 1"), base, "projects", partition_by=["source"]) == 2
    assert current_version(spark, base, "projects") == 2
    cur = read_current(spark, base, "projects").where(F.col("source") == "uni_halle")
    plan = cur._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "uni_halle" in plan
    assert [r["id"] for r in cur.collect()] == [2]


def test_search_pages_until_stop(spark):
    rows = [(0, 1, 0, ["a"], None), (0, 1, 20, ["b"], None), (0, 1, 40, [], None), (0, 1, 60, ["c"], None),
            (0, 2, 0, ["d"], None), (0, 2, 20, ["e"], "500"), (0, 2, 40, ["f"], None),
            (1, 1, 0, ["g"], None), (1, 1, 20, ["h"], None)]
    df = spark.createDataFrame(rows, "station_ord int, keyword_ord int, start long, items array<string>, "
                                     "error_code string")
    kept = sorted((r[0], r[1], r[2]) for r in DV.pages_until_stop(df).collect())
    assert kept == [(0, 1, 0), (0, 1, 20), (0, 2, 0), (1, 1, 0), (1, 1, 20)]


def test_page_with_many_links_reads_the_page_once(spark):
    """Names keep their first path, in page order; the plan holds one regex pass, none below a lambda."""
    import re

    from cataloguer.sources import html

    links = [f"/bitstream/1/{i}/name{(i * 7) % 900}.pdf" for i in range(1500)]
    page = "".join(f'<a href="{x}">' for x in links)
    df = html.page_files(spark.createDataFrame([(1, page, 200)], "page_id int, html string, http_status int"), ["page_id"])
    want, seen = [], set()
    for x in links:
        name = x.rsplit("/", 1)[1]
        if name not in seen:
            seen.add(name)
            want.append((name, x))
    got = [(r.file_name, r.file_url) for r in df.orderBy("file_index").collect()]
    assert [g[0] for g in got] == [w[0] for w in want] and all(u.endswith(w[1]) for (_, u), w in zip(got, want))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("regexp_extract_all", plan)) == 1


def test_payloads_are_parsed_once(spark):
    """Filters on parsed fields stay above the parse."""
    from cataloguer.sources import dataverse, oai

    xml = oai.project_rows(oai.parse_records(spark.createDataFrame([(1, "<record/>")], "rec int, xml string")), ["rec"])
    detail = dataverse.parse_details(spark.createDataFrame([(1, "{}")], "ds int, json string")).select("ds", dataverse.license_value().alias("license"))
    for df, parse in ((xml, "from_xml|XmlToStructs|xmltostructs"), (detail.where("license is not null"), "parse_json|parseJson")):
        import re

        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(parse, plan, re.I)) == 1, plan


def test_details_meet_the_first_hits_of_their_own_station(spark):
    """Details of other stations never count; the first valid station owns the DOI; payloads are shuffled by DOI alone."""
    item = "station_ord int, keyword_ord int, start long, item_index int, global_id string, name string, url string, published_at string"
    hits = spark.createDataFrame([(s, 1, 0, i, f"doi:{i}", f"n{s}", f"u{i}", None) for s in (0, 1, 2) for i in range(3)], item)

    def detail(n, version):
        files = ",".join(f'{{"dataFile":{{"id":{k},"filename":"a.qdpx"}}}}' for k in range(n))
        return f'{{"data":{{"latestVersion":{{"versionNumber":{version},"files":[{files}]}}}}}}'

    details = spark.createDataFrame([
        (0, "doi:0", detail(0, 1)), (1, "doi:0", detail(1, 2)), (2, "doi:0", detail(2, 3)),  # station 0 lists no file
        (3, "doi:1", detail(1, 4)), (2, "doi:1", detail(2, 5)),  # station 3 had no hit of it
        (0, "doi:2", "<html>"), (None, "doi:2", detail(1, 6))], "station_ord int, global_id string, json string")
    out = adapters.dataverse(hits, details)
    assert sorted((r.doi, r.seq, r.version, r.title, r.has_qda) for r in out.projects.collect()) == [
        ("doi:0", 1, "v2.None", "n1", True), ("doi:1", 2, "v5.None", "n2", True)]
    assert sorted((r.seq, r.file_index, r.file_name) for r in out.files.collect()) == [(1, 0, "a.qdpx"), (2, 0, "a.qdpx"), (2, 1, "a.qdpx")]


def test_landed_oai_pages_share_files(spark):
    """A file and a folder a page made 720,000 of them at 6 GB; a broken page must still cost itself only."""
    from cataloguer.session import scratch_path

    good = '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords><record><header><identifier>r%d &amp; x</identifier></header></record></ListRecords></OAI-PMH>'
    odd = {
        3: "<OAI-PMH><ListRecords><record><header>", 4: "<OAI-PMH><!-- cut", 5: "<OAI-PMH><![CDATA[ cut", 6: "<html>502</html>", 7: "", 8: None,
        9: (good % 9).replace("x<", "\x01<"), 10: "</page></pages>", 11: '<OAI-PMH><error code="badResumptionToken">gone</error></OAI-PMH>',
    }
    fine = {1: '\r\n <?xml version="1.0"?>\r\n' + good % 1, 2: (good % 2).replace("<Li", "\n  <Li")}
    rows = [(n, odd.get(n, fine.get(n, good % n))) for n in range(400)]
    path = scratch_path(spark, "t-pages")
    oai.land_pages(spark.createDataFrame(rows, "page_no long, value string").repartition(4), path)
    assert 0 < len(spark.read.text(path).inputFiles()) <= 4
    read = oai.read_landed_pages(spark, path)
    assert sorted((r.page_no, r.error_code) for r in read.collect()) == [
        (n, None if n not in odd else "badResumptionToken" if n == 11 else "unreadable") for n in range(400)]
    kept = oai.pages_until_error(read.where("page_no > 11 or page_no < 5").withColumn("harvest", F.lit("h")))
    assert sorted((r.page_no, r.oai_id) for r in oai.page_records(kept).collect()) == [(n, f"r{n} & x") for n in range(3)]
