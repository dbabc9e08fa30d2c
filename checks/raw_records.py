"""Messy raw records derived from ``documents`` and ``pages``.

One SQL text serves Spark and DuckDB, so both sides start from the same rows. Both tables
grow with the data, so the join is a shuffled one. Whole texts
are used: the title is a document's first line, the summary all that follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_SQL = """
SELECT
  CASE WHEN d % 37 = 1 THEN concat('R', lpad(CAST(d - 1 AS STRING), 9, '0'))
       ELSE concat('R', lpad(CAST(d AS STRING), 9, '0')) END AS record_id,
  source,
  CASE d % 6 WHEN 0 THEN 'detail' WHEN 1 THEN ' Table ' WHEN 2 THEN 'api'
             WHEN 3 THEN 'NEWS' WHEN 4 THEN 'misc' ELSE 'other' END AS source_type,
  CASE WHEN n % 2 = 0 THEN ''
       WHEN d % 11 = 1 THEN concat(main, '-XX')
       WHEN d % 3 = 0 THEN concat(main, '-', suffix)
       WHEN d % 3 = 1 THEN concat(' ', main, ' / ', suffix, ' ')
       ELSE concat(main, suffix) END AS bulletin_number,
  CASE WHEN d % 29 = 0 THEN '   '
       WHEN d % 7 = 3 THEN concat('<p><b>', title, '</b></p>')
       WHEN d % 7 = 4 THEN concat(title, ' &amp; <!-- note -->co')
       WHEN d % 7 = 5 THEN translate(title, 'abcdefghijklmnopqrstuvwxyz',
                                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ')
       WHEN d % 2 = 0 THEN concat('  ', chr(9), title, ' ')
       ELSE title END AS title_raw,
  substr(text, length(title) + 2) AS summary_raw,
  CASE WHEN d % 9 = 0 THEN concat(y, '-', m, '-', dd)
       WHEN d % 9 = 1 THEN concat(dd, '/', m, '/', y)
       WHEN d % 9 = 2 THEN concat(y, '-', m, '-', dd, 'T', hh, ':', mi)
       WHEN d % 9 = 3 THEN concat(y, '-', m, '-', dd, ' ', hh, ':', mi, ':07+03:00')
       WHEN d % 9 = 4 THEN concat(y, '/', m, '/', dd)
       WHEN d % 9 = 5 THEN concat(dd, ' ', mon, '. ', y)
       WHEN d % 9 = 6 THEN concat(y, m, dd)
       WHEN d % 9 = 7 THEN 'sin fecha'
       ELSE '' END AS published_at_raw,
  CASE WHEN n % 7 = 0 THEN concat(mon, ' ', dd, ', ', y)
       WHEN n % 7 = 1 THEN concat('  ', dd, '-', m, '-', y, ' ')
       WHEN n % 7 = 2 THEN concat(y, '-', m, '-', dd, 'T', hh, ':', mi, ':59Z')
       WHEN n % 7 = 3 THEN y
       WHEN n % 7 = 4 THEN concat(y, '-', m, '-45')
       WHEN n % 7 = 5 THEN concat(y, '-', m, '-', dd, 'T', hh, ':', mi, ':01.250-0400')
       ELSE ' ' END AS event_date_raw,
  concat('  ', lang, ' ') AS status_raw,
  concat(source, '  ') AS initiative_raw,
  CASE d % 10
    WHEN 0 THEN concat('["Ana ', lang, '", "Berta", "ana ', lang, '"]')
    WHEN 1 THEN concat('[{{"name": "Ana ', lang, '"}}, {{"author": "Zoe"}}, {{"full_name": " ', source, ' "}}]')
    WHEN 2 THEN concat('Ana ', lang, ' | Berta, Jr | ANA ', lang)
    WHEN 3 THEN concat('Ana ', lang, '; Berta, Jr;; ', source)
    WHEN 4 THEN concat('Ana ', lang, ', Berta')
    WHEN 5 THEN concat(' ', source, ' ')
    WHEN 6 THEN '[]'
    WHEN 7 THEN '[1, 2]'
    WHEN 8 THEN concat('{{"author": "', source, '"}}')
    ELSE '' END AS authors_raw,
  CASE WHEN d % 23 = 5 THEN 'not a url'
       WHEN d % 23 = 6 THEN 'mailto:x@example.com'
       WHEN n % 3 = 0 OR url IS NULL THEN ''
       WHEN d % 4 = 1 THEN concat(split_part(url, '#', 1),
              CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END, 'UTM_Campaign=mail&gclid=', main,
              CASE WHEN url LIKE '%#%' THEN concat('#', split_part(url, '#', 2)) ELSE '' END)
       WHEN d % 4 = 2 THEN replace(replace(url, 'https://', 'HTTPS://'), 'example', 'EXAMPLE')
       WHEN d % 4 = 3 THEN concat('  ', url, ' ')
       ELSE url END AS url_raw,
  CASE WHEN d % 8 = 0 THEN ''
       WHEN d % 8 = 1 THEN concat('https://Docs.Example.com/Doc.aspx?prmTIPO=x&prmID=', main, '/')
       WHEN d % 8 = 2 THEN 'http://docs.example.com/'
       ELSE concat('https://Docs.Example.com/d/', main, '//?b=2&a=', lang,
                   '&&utm_medium=x&c&a=one two#p') END AS document_url_raw,
  CASE WHEN d % 13 = 0 THEN '' ELSE substr(md5(text), 1, 8) END AS content_hash_hint,
  concat('<p>', lang, '</p>') AS html_snippet
FROM (
  SELECT /*+ MERGE(p) */
    doc_id AS d, n_chars AS n, text, lang, source, url,
    split_part(text, chr(10), 1) AS title,
    CAST(10000 + n_chars % 90000 AS STRING) AS main,
    lpad(CAST(n_chars % 100 AS STRING), 2, '0') AS suffix,
    CAST(2000 + n_chars % 25 AS STRING) AS y,
    lpad(CAST(1 + n_chars % 12 AS STRING), 2, '0') AS m,
    lpad(CAST(1 + n_chars % 28 AS STRING), 2, '0') AS dd,
    lpad(CAST(n_chars % 24 AS STRING), 2, '0') AS hh,
    lpad(CAST(n_chars % 60 AS STRING), 2, '0') AS mi,
    split_part('Jan,Feb,Mar,Apr,May,Jun,Jul,Aug,Sep,Oct,Nov,Dec', ',',
               CAST(1 + n_chars % 12 AS INT)) AS mon
  FROM {documents} LEFT JOIN {pages} AS p
    ON page_id = CAST(floor(doc_id / 3.0) AS BIGINT)
) AS base
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        RAW_SQL,
        documents=table(spark, sf_dir, "documents"),
        pages=table(spark, sf_dir, "pages").select("page_id", "url"),
    )


def raw_records_duckdb() -> str:
    return RAW_SQL.format(documents="documents", pages="pages").strip()
