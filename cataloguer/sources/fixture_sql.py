"""Fixture views over the driver tables (same SQL text in Spark and DuckDB).

The texts are the portable views of FIXTURES.md section 4; ``register`` makes them
temp views in Spark, ``with_clause`` turns them into CTEs for the DuckDB oracle.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["fx_projects"] = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 5 = 4 THEN 'OAI-PMH full harvest' ELSE 'qdpx' END AS query_string,
  CASE WHEN o_orderkey % 5 = 4 THEN 16 ELSE 5 END AS repository_id,
  'https://h' || CAST(o_orderkey % 5 AS VARCHAR(9)) || '.example' AS repository_url,
  'https://h' || CAST(o_orderkey % 5 AS VARCHAR(9)) || '.example/d/' || CAST(o_orderkey AS VARCHAR(20)) AS project_url,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'v' || CAST(o_orderkey % 4 AS VARCHAR(9)) || '.0' END AS version,
  o_orderpriority AS title,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus || ', "quoted" text' END AS description,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'en' END AS language,
  'doi:10.1/' || CAST(o_custkey AS VARCHAR(20)) AS doi,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS upload_date,
  CASE WHEN o_orderkey % 5 = 4 THEN 'opendata' ELSE 'DANS' END AS download_repository_folder,
  'doi_10.1_' || CAST(o_custkey AS VARCHAR(20)) AS download_project_folder,
  CASE WHEN o_orderkey % 5 = 4 THEN 'SCRAPING' ELSE 'API-CALL' END AS download_method
FROM orders
"""

VIEWS["fx_files_raw"] = """
SELECT l.l_orderkey AS project_id,
  p.p_name || ' ' || CAST(l.l_linenumber AS VARCHAR(9)) || '.' ||
    split_part('QDPX,pdf,mp3,nvpx,csv,xyz,tar.gz,mx24', ',', CAST(l.l_partkey % 8 + 1 AS INT)) AS file_name,
  l.l_returnflag = 'R' AS restricted,
  CASE WHEN l.l_returnflag = 'R' THEN 'RESTRICTED'
       ELSE split_part('SUCCESS,FAILED,SKIPPED,SUCCESS', ',', CAST(l.l_suppkey % 4 + 1 AS INT)) END AS status,
  CAST(floor(l.l_extendedprice) AS BIGINT) AS size_bytes,
  l.l_suppkey AS ord1, l.l_partkey AS ord2
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

VIEWS["fx_keywords_raw"] = """
SELECT l.l_orderkey AS project_id,
  CASE WHEN p.p_size % 10 = 0 THEN '  ' WHEN p.p_size % 10 = 1 THEN ' ' || p.p_type || ' ' ELSE p.p_type END AS keyword
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
UNION ALL
SELECT l.l_orderkey AS project_id, p.p_brand AS keyword
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

VIEWS["fx_persons_raw"] = """
SELECT o.o_orderkey AS project_id, c.c_name AS name,
  split_part('AUTHOR,creator, Depositor ,DATA_MANAGER,CONTRIBUTOR,owner,,gardener', ',', CAST(o.o_custkey % 8 + 1 AS INT)) AS role
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT DISTINCT l.l_orderkey AS project_id, s.s_name AS name, 'CONTRIBUTOR' AS role
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

VIEWS["fx_licenses_raw"] = """
SELECT o_orderkey AS project_id,
  split_part('http://creativecommons.org/licenses/by/4.0/;CC BY-NC-SA 4.0;cc0;DANS Licence;unrestricted access;http://rightsstatements.org/vocab/InC/1.0/;MIT-X;custom terms; ;CC-BY-4.0;https://opensource.org/licenses/MIT', ';', CAST(o_custkey % 11 + 1 AS INT)) AS license
FROM orders
"""

VIEWS["fx_hits"] = """
SELECT CAST(l_suppkey % 4 AS INT) AS station_ord, l_linenumber AS keyword_ord,
  l_partkey - l_partkey % 20 AS start, l_partkey % 20 AS pos,
  CASE WHEN l_quantity = 1 THEN '' ELSE 'doi:10.1/' || CAST(l_orderkey AS VARCHAR(20)) END AS global_id
FROM lineitem
"""

VIEWS["fx_details"] = """
SELECT n.n_nationkey AS station_ord, 'doi:10.1/' || CAST(o.o_orderkey AS VARCHAR(20)) AS global_id,
  (o.o_orderkey + n.n_nationkey) % 3 AS n_files, o.o_orderstatus = 'F' AS has_qda
FROM orders o JOIN nation n ON n.n_nationkey < 4
"""

VIEWS["fx_ledger"] = """
SELECT 5 AS repository_id,
  'https://h' || CAST(o_orderkey % 5 AS VARCHAR(9)) || '.example/d/' || CAST(o_orderkey AS VARCHAR(20)) AS project_url
FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 5 < 4
"""

VIEWS["fx_fetch_log"] = """
SELECT user_id AS file_id, event_id AS seq,
  CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 200 WHEN 'signup' THEN 403 WHEN 'error' THEN 503 ELSE NULL END AS http_status
FROM events
"""

VIEWS["fx_oai"] = """
SELECT p_partkey AS rec, p_size % 7 = 0 AS deleted, p_size % 11 = 0 AS no_dc,
  'oai:x:1/' || CAST(p_partkey AS VARCHAR(20)) AS oai_id, p_name AS title,
  CASE WHEN p_size % 5 = 0 THEN 'Interview study' WHEN p_size % 5 = 1 THEN 'qualitative' ELSE p_type END AS description,
  CASE WHEN p_size % 5 = 1 THEN 'data' ELSE p_brand END AS subject,
  CASE WHEN p_size % 3 = 0 THEN 'http://other.example/' || CAST(p_partkey AS VARCHAR(20)) ELSE 'plain-id' END AS ident1,
  CASE WHEN p_size % 2 = 0 THEN 'https://doi.org/10.1/' || CAST(p_partkey AS VARCHAR(20)) ELSE 'http://second.example/' END AS ident2,
  CASE WHEN p_size % 4 = 0 THEN 'https://opendata.uni-halle.de/handle/1/' || CAST(p_partkey AS VARCHAR(20)) ELSE 'x' END AS ident3
FROM part
"""

VIEWS["fx_oai_xml"] = """
SELECT p_partkey AS rec,
  '<record xmlns="http://www.openarchives.org/OAI/2.0/"><header' ||
  CASE WHEN p_size % 7 = 0 THEN ' status="deleted"' ELSE '' END || '><identifier>oai:x:1/' || CAST(p_partkey AS VARCHAR(20)) ||
  '</identifier></header><metadata>' ||
  CASE WHEN p_size % 11 = 0 THEN '' ELSE
    '<oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/" xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>' || p_name ||
    '</dc:title><dc:description>' || CASE WHEN p_size % 5 = 0 THEN 'Interview study' WHEN p_size % 5 = 1 THEN 'qualitative' ELSE p_type END ||
    '</dc:description><dc:subject>' || CASE WHEN p_size % 5 = 1 THEN 'data' ELSE p_brand END ||
    '</dc:subject><dc:identifier>' || CASE WHEN p_size % 3 = 0 THEN 'http://other.example/' || CAST(p_partkey AS VARCHAR(20)) ELSE 'plain-id' END ||
    '</dc:identifier><dc:identifier>' || CASE WHEN p_size % 2 = 0 THEN 'https://doi.org/10.1/' || CAST(p_partkey AS VARCHAR(20)) ELSE 'http://second.example/' END ||
    '</dc:identifier><dc:identifier>' || CASE WHEN p_size % 4 = 0 THEN 'https://opendata.uni-halle.de/handle/1/' || CAST(p_partkey AS VARCHAR(20)) ELSE 'x' END ||
    '</dc:identifier></oai_dc:dc>' END || '</metadata></record>' AS xml
FROM part
"""

VIEWS["fx_dataset"] = """
SELECT o_orderkey AS ds, 'doi:10.1/' || CAST(o_orderkey AS VARCHAR(20)) AS global_id,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'v1.None'
       ELSE 'v' || CAST(o_orderkey % 4 AS VARCHAR(9)) || '.0' END AS version,
  CASE WHEN o_orderkey % 3 = 0 THEN 'en, nl' WHEN o_orderkey % 3 = 1 THEN 'de' ELSE NULL END AS language,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'About ' || o_orderpriority END AS description,
  CASE o_orderkey % 5 WHEN 0 THEN 'CC0 1.0' WHEN 1 THEN 'http://creativecommons.org/licenses/by/4.0/' WHEN 2 THEN 'DANS Licence' ELSE NULL END AS license,
  'Customer ' || CAST(o_custkey AS VARCHAR(20)) AS author,
  'kw' || CAST(o_custkey % 7 AS VARCHAR(9)) AS keyword, o_orderpriority AS subject,
  CAST(o_orderkey % 3 AS INT) AS n_files
FROM orders
"""

VIEWS["fx_dataset_json"] = """
SELECT o_orderkey AS ds,
  '{"data":{"latestVersion":{' ||
  CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN '"versionNumber":1,"versionMinorNumber":null,'
       ELSE '"versionNumber":' || CAST(o_orderkey % 4 AS VARCHAR(9)) || ',"versionMinorNumber":0,' END ||
  CASE o_orderkey % 5 WHEN 0 THEN '"license":{"name":"CC0 1.0","uri":"u"},' WHEN 1 THEN '"license":{"name":"","uri":"http://creativecommons.org/licenses/by/4.0/"},'
       WHEN 2 THEN '"license":"DANS Licence",' WHEN 3 THEN '"license":null,' ELSE '' END ||
  '"metadataBlocks":{"citation":{"fields":[{"typeName":"language","value":' ||
  CASE WHEN o_orderkey % 3 = 0 THEN '["en","nl"]' WHEN o_orderkey % 3 = 1 THEN '"de"' ELSE '[]' END ||
  '},{"typeName":"dsDescription","value":' ||
  CASE WHEN o_orderstatus = 'P' THEN '[]' ELSE '[{"dsDescriptionValue":{"value":"About ' || o_orderpriority || '"}},{"dsDescriptionValue":{"value":"second"}}]' END ||
  '},{"typeName":"author","value":[{"authorName":{"value":"Customer ' || CAST(o_custkey AS VARCHAR(20)) ||
  '"}}]},{"typeName":"keyword","value":[{"keywordValue":{"value":"overwritten"}}]},{"typeName":"keyword","value":[{"keywordValue":{"value":"kw' ||
  CAST(o_custkey % 7 AS VARCHAR(9)) || '"}}]},{"typeName":"subject","value":["' || o_orderpriority || '"]}]}},"files":[' ||
  CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '{"restricted":true,"dataFile":{"id":1,"filename":"a.qdpx","filesize":10}}'
       ELSE '{"restricted":false,"dataFile":{"id":1,"filename":"a.PDF","filesize":10,"restricted":true}},{"dataFile":{"id":2}}' END ||
  ']}}}' AS json
FROM orders
"""

VIEWS["fx_pages"] = """
SELECT page_id, url AS page_url, 200 AS http_status,
  replace(html, 'href="/', 'href="/bitstream/handle/1/') AS html
FROM pages
"""
