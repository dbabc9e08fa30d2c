"""Result pages derived from ``customer`` and ``orders``.

Each customer is a seed. Its orders are the event rows of its result pages; one page holds
the orders of one range of order keys, so its length is bounded. Labels, headings and
author blocks vary by customer, date forms and row shapes by order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.raw_records import table

KEYS_PER_PAGE = 4096

# Shared by Spark and DuckDB: what the pages are made of.
SEED_SQL = """
SELECT c, name, segment, 'N' || CAST(nation AS STRING) AS nation,
  'S' || CAST(c % 7 AS STRING) AS state,
  CASE WHEN c % 10 = 7 THEN '' ELSE bulletin END AS bulletin,
  CASE WHEN c % 10 = 7 THEN 'https://h.example/t.aspx?prmBoletin=&q=a b.' || CAST(c AS STRING)
       WHEN c % 2 = 0 THEN 'https://h.example/t.aspx?prmBOLETIN=' || bulletin || '&prmID=' || CAST(c AS STRING)
       ELSE 'https://h.example/t.aspx?prmID=' || CAST(c AS STRING) || '&prmBoletin=' || bulletin
  END AS seed_url
FROM (
  SELECT c_custkey AS c, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation,
    CAST(10000 + c_custkey % 90000 AS STRING) || '-' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') AS bulletin
  FROM {customer}
) AS seeds
"""

ROW_SQL = """
SELECT o, c, page_no, kind, priority, CAST(o AS STRING) AS key_text,
  CASE kind WHEN 0 THEN dd || '/' || m || '/' || y
            WHEN 1 THEN y || '-' || m || '-' || dd
            WHEN 2 THEN dd || ' ' || mon || '. ' || y
            ELSE 'Sin fecha ' || CAST(o AS STRING) END AS date_text
FROM (
  SELECT o_orderkey AS o, o_custkey AS c, o_orderpriority AS priority,
    CAST(1 + floor(o_orderkey / {keys_per_page}.0) AS INT) + CASE WHEN o_custkey % 17 = 7 THEN 1 ELSE 0 END AS page_no,
    CAST(o_orderkey % 4 AS INT) AS kind,
    CAST(year(o_orderdate) AS STRING) AS y,
    lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m,
    lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS dd,
    split_part('Ene,Feb,Mar,Abr,May,Jun,Jul,Ago,Sep,Oct,Nov,Dic', ',',
               CAST(month(o_orderdate) AS INT)) AS mon
  FROM {orders}
) AS parts
"""

_HTML_SQL = """
SELECT /*+ MERGE(s, p) */ s.seed_url, k.page_no, 1 AS version,
  CASE WHEN broken AND s.c % 17 = 4 THEN CAST(NULL AS INT) WHEN broken AND s.c % 17 = 6 THEN 500
       WHEN broken THEN 404 ELSE 200 END AS http_status,
  CASE WHEN broken AND s.c % 17 <> 6 THEN CAST(NULL AS STRING) ELSE
    '<!DOCTYPE html><html><head><title>x</title>'
    || CASE s.c % 3 WHEN 0 THEN '<link rel="canonical" href="/detail/' || s.c || '">'
                    WHEN 1 THEN '<link rel="alternate canonical" href="https://other.example/x">'
                    ELSE '' END
    || '</head><body>'
    || CASE s.c % 4 WHEN 0 THEN '<h1> Proyecto <b>de</b>' || chr(10) || s.name || '</h1>'
                    WHEN 1 THEN '<h1> </h1><h2>' || s.name || ' &amp; co</h2>'
                    WHEN 2 THEN '<div class="x titulo-proyecto">' || s.name || '</div>'
                    ELSE '<table><tr><td>T&iacute;tulo:<td>' || s.name || '</table>' END
    || CASE s.c % 3 WHEN 0 THEN
        '<table><tr><th>Legislatura</th><td>' || s.segment || '</td></tr>'
        || '<tr><td>Fecha de INGRESO</td><td><b>' || s.nation || '</b></td></tr>'
        || '<tr><td>Estado<td> ' || s.state || ' <tr><td>Iniciativa<td>Mensaje</table>'
        || '<div id="autores">Ana ' || s.c || '; Berta, Ana ' || s.c || '</div>'
      WHEN 1 THEN
        '<div><span>Per&iacute;odo</span> <span>' || s.segment || '</span></div>'
        || '<p><strong>Situación</strong></p><p>' || s.state || '</p>'
        || '<label>Tipo iniciativa</label><i>x</i><span>Moción</span>'
        || '<span class="autores"> </span><dl><dt>Autores</dt><dd>Zoe,' || s.nation || '</dd></dl>'
      ELSE
        '<dl><dt>LEGISLATURA:<dd>' || s.segment || '<dt>Origen<dd>C<i>' || s.nation || '</i></dl>'
        || '<script>var t="<td>Estado</td><td>no</td>";</script><!-- <b>Estado</b> -->'
      END
    || '<table class="x"><tr><th>Fecha</th><th>Etapa</th></tr><tr><td>Detalle</td><td>-</td></tr>'
    || coalesce(p.rows, '') || '</table>'
    || CASE WHEN s.c % 5 = 0 THEN
         '<table><tr><td>01/01/1999</td><td>otra</td></tr></table>' ELSE '' END
    || '</body></html>' END AS html,
  CASE WHEN broken AND s.c % 17 = 4 THEN 'timed out' WHEN broken AND s.c % 17 = 3 THEN 'Not Found'
       ELSE CAST(NULL AS STRING) END AS fetch_error
FROM (
  SELECT *, page_no = 1 AND c % 17 IN (3, 4, 6) AS broken FROM (
    SELECT c, page_no FROM {rows} UNION SELECT c, 1 FROM {seeds} WHERE c % 17 <> 7
  ) AS wanted
) AS k
JOIN {seeds} AS s ON s.c = k.c
LEFT JOIN {rows} AS p ON p.c = k.c AND p.page_no = k.page_no
UNION ALL
SELECT seed_url, 1, 2, 503, '<p>busy</p>', CAST(NULL AS STRING) FROM {seeds} WHERE c % 17 = 9
"""

_ROW_HTML = """
  CASE kind
    WHEN 0 THEN '<tr><td>' || date_text || '</td><td>Sesión ' || key_text || '</td><td>' || priority
      || '</td><td>sub</td><td>Oficio &#171;a&#187;</td><td><a href="#">ver</a><a href="/doc/'
      || key_text || '">doc</a></td></tr>'
    WHEN 1 THEN '<tr><td>Sesión ' || key_text || '<td>' || date_text || '<td>' || priority
      || '<tr><td>solo una</td>'
    WHEN 2 THEN '<tr><td><b>' || replace(date_text, ' ', '</b>&nbsp;<b>') || '</b></td><td>'
      || '<a href="' || CASE WHEN c % 17 = 5 THEN 'http://[bad' ELSE 'docs/../d.pdf?k=' || key_text END
      || '">' || priority || '</a></td></tr>'
    ELSE '<tr><td>' || date_text || '</td><td>' || priority || '</td></tr>' END
"""


def page_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SEED_SQL, customer=table(spark, sf_dir, "customer"))


def page_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        ROW_SQL, orders=table(spark, sf_dir, "orders"), keys_per_page=KEYS_PER_PAGE
    )


def seed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all customers. A page's rows are at most KEYS_PER_PAGE, by construction.

    Some seeds have a first page that was not fetched, with or without a body, some none at
    all, and some a second version of it, which was not fetched.

    Pages are dealt out in as many partitions as a shuffle has: by the bytes of their rows they
    would be put into few, one for each core and a rest, but reading a page takes long for its bytes.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = page_orders(spark, sf_dir).repartition(partitions, "c", "page_no")
    rows = spark.sql(
        "SELECT c, page_no, string_agg(html, '') WITHIN GROUP (ORDER BY o) AS rows FROM "
        f"(SELECT *, {_ROW_HTML} AS html FROM {{orders}}) GROUP BY c, page_no",
        orders=orders,
    )
    return spark.sql(_HTML_SQL, seeds=page_seeds(spark, sf_dir), rows=rows)


SEEDS = "seeds AS (" + SEED_SQL.format(customer="customer").strip() + ")"
ROWS = "page_orders AS (" + ROW_SQL.format(orders="orders", keys_per_page=KEYS_PER_PAGE).strip() + ")"

# What extraction must find, computed from the tables and not from the pages.
EXPECTED = f"""
{SEEDS},
{ROWS},
wanted AS (SELECT c, page_no FROM page_orders UNION SELECT c, 1 FROM seeds WHERE c % 17 <> 7),
first_dated AS (
  SELECT c, page_no, min(o) AS first_o, count(*) AS dated
  FROM page_orders WHERE kind <> 3 GROUP BY 1, 2),
page_facts AS (
  SELECT s.*, w.page_no, coalesce(dated, 0) AS dated, first_o,
    w.page_no = 1 AND s.c % 17 IN (3, 4, 6) AS broken,
    CAST((s.c % 4 = 3) AS INTEGER) + CAST((s.c % 3 = 0) AS INTEGER) AS tables_before
  FROM wanted w JOIN seeds s USING (c) LEFT JOIN first_dated f ON f.c = w.c AND f.page_no = w.page_no),
event_rows AS (
  SELECT p.c, p.seed_url, p.bulletin AS bulletin_number, p.page_no, o, date_text AS event_date,
    CASE WHEN kind IN (0, 1) THEN 'Sesión ' || key_text ELSE priority END AS session,
    CASE WHEN kind IN (0, 1) THEN priority ELSE '' END AS stage,
    CASE WHEN kind = 0 THEN 'sub' ELSE '' END AS substage,
    CASE WHEN kind = 0 THEN 'Oficio «a»' ELSE '' END AS description,
    CASE WHEN kind = 0 THEN 'https://h.example/doc/' || key_text
         WHEN kind = 2 AND p.c % 17 <> 5 THEN 'https://h.example/d.pdf?k=' || key_text
         ELSE '' END AS document_url,
    kind = 2 AND p.c % 17 = 5 AS bad_link
  FROM page_facts p JOIN page_orders r ON r.c = p.c AND r.page_no = p.page_no AND r.o >= p.first_o
  WHERE NOT broken
  UNION ALL
  SELECT c, seed_url, bulletin, page_no, 0, '01/01/1999', 'otra', '', '', '', '', FALSE
  FROM page_facts WHERE dated = 0 AND c % 5 = 0 AND NOT broken),
all_events AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY c, page_no ORDER BY o) - 1 AS INTEGER) AS row_order
  FROM event_rows),
bad_seeds AS (
  SELECT c FROM event_rows WHERE bad_link UNION SELECT c FROM page_facts WHERE broken
  UNION SELECT c FROM seeds WHERE c % 17 = 7),
facts AS (
  SELECT seed_url,
    CASE c % 3 WHEN 0 THEN 'https://h.example/detail/' || c
               WHEN 1 THEN 'https://other.example/x' ELSE seed_url END AS detail_url,
    bulletin AS bulletin_number,
    CASE c % 4 WHEN 0 THEN 'Proyecto de ' || name WHEN 1 THEN name || ' & co' ELSE name END AS title,
    segment AS legislature,
    CASE c % 3 WHEN 0 THEN nation ELSE '' END AS entry_date,
    CASE c % 3 WHEN 2 THEN '' ELSE state END AS status,
    CASE c % 3 WHEN 0 THEN 'Mensaje' WHEN 1 THEN 'Moción' ELSE '' END AS initiative,
    CASE c % 3 WHEN 2 THEN 'C ' || nation ELSE '' END AS origin_chamber,
    CASE c % 3 WHEN 0 THEN ['Ana ' || c, 'Berta', 'Ana ' || c]
               WHEN 1 THEN ['Zoe', nation] ELSE [] END AS authors,
    c, page_no, broken, dated, tables_before
  FROM page_facts)
"""


def expected(select: str) -> str:
    return f"WITH {EXPECTED.strip()}\n{select}"
