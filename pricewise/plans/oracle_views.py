"""The retail fixture views as DuckDB CTE text (FIXTURES.md part 2).

Written independently of the Spark code in ``pricewise.sources.fixtures``;
the SQL oracle of every registered query starts with ``WITH`` + these views.
"""

VIEWS = {
    "type_codes": """
  SELECT p_type, CAST(100 * dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS type_code
  FROM (SELECT DISTINCT p_type FROM part) t""",
    "part_sku": """
  SELECT p.p_partkey, p.p_name, p.p_type, p.p_size,
         CAST(split_part(p.p_brand, '#', 2) AS INTEGER) AS brand_no,
         lpad(split_part(p.p_brand, '#', 2), 6, '0') AS style_cd,
         lpad(split_part(p.p_brand, '#', 2), 6, '0') || '-' || CAST(tc.type_code AS VARCHAR) AS prod_code
  FROM part p JOIN type_codes tc ON p.p_type = tc.p_type""",
    "sales_trans": """
  SELECT o.o_orderpriority AS store_nm,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'SIDE' ELSE 'MAIN' END AS platform,
         CAST(l.l_shipdate AS DATE) AS sales_date,
         (CASE quarter(l.l_shipdate - t.back) WHEN 1 THEN 'SP' WHEN 2 THEN 'SU' WHEN 3 THEN 'FA' ELSE 'HO' END)
           || CAST(year(l.l_shipdate - t.back) AS VARCHAR) AS season1,
         CASE WHEN (s.brand_no + quarter(l.l_shipdate)) % 3 = 0 THEN 'N' ELSE 'Y' END AS inseason_flag1,
         s.style_cd, s.prod_code, CAST(s.p_size AS VARCHAR) AS size_cd,
         CAST(s.p_size * 50 AS DOUBLE) AS MSRP,
         (100.0 - 5.0 * round(l.l_discount * 100.0)) / 100.0 AS md_line,
         l.l_quantity AS sales_qty,
         CAST(s.p_size * 50 AS DOUBLE) * (100.0 - 5.0 * round(l.l_discount * 100.0)) * l.l_quantity / 100.0 AS sales_amt,
         l.l_linenumber AS line_no
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part_sku s ON l.l_partkey = s.p_partkey
  JOIN (VALUES (true, INTERVAL 3 MONTH), (false, INTERVAL 0 MONTH)) AS t(off, back)
    ON t.off = ((s.brand_no + quarter(l.l_shipdate)) % 3 = 0)""",
    "attributes": """
  SELECT prod_code, style_cd AS style_number,
         CASE WHEN p_type = 'PROMO' THEN 'OTHER' ELSE 'FOOTWEAR' END AS division,
         'G' || CAST(brand_no % 2 AS VARCHAR) AS gender_group,
         CASE WHEN brand_no <> 23 THEN 'C' || CAST(brand_no % 3 AS VARCHAR) END AS gc_category,
         'M' || CAST(brand_no % 5 AS VARCHAR) AS model,
         p_type AS class_platform,
         CASE WHEN brand_no % 4 = 0 THEN NULL ELSE 'P' || CAST(brand_no % 4 AS VARCHAR) END AS power_item,
         min(p_name) || '/' || p_type AS color_desc
  FROM part_sku GROUP BY prod_code, style_cd, brand_no, p_type""",
    "inventory": """
  SELECT store_nm, prod_code, CAST(sales_date - INTERVAL 1 DAY AS DATE) AS eop_dt,
         sum(100.0 - sales_qty) AS eop_qty,
         CAST(sum(line_no) AS DOUBLE) AS in_transit_qty,
         CAST(2 * sum(line_no) AS DOUBLE) AS warehouse_transit_qty
  FROM sales_trans GROUP BY store_nm, prod_code, CAST(sales_date - INTERVAL 1 DAY AS DATE)""",
    "season_calendar": """
  SELECT CAST(d AS DATE) AS cal_date,
         (CASE quarter(d) WHEN 1 THEN 'SP' WHEN 2 THEN 'SU' WHEN 3 THEN 'FA' ELSE 'HO' END)
           || CAST(year(d) AS VARCHAR) AS season
  FROM (SELECT unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE),
                                      INTERVAL 1 DAY)) AS d FROM lineitem) g""",
    "rm_events": """
  SELECT * FROM (VALUES (0, '618', 6, 16, 3), (1, '99', 9, 9, 2), (2, '1111', 11, 11, 1), (3, '1212', 12, 12, 1))
    AS e(ev_idx, rm_name, mon, dy, n_days)""",
    "rm_calendar": """
  SELECT CAST(make_date(CAST(y.yr AS INTEGER), e.mon, e.dy) + CAST(dn.day_number - 1 AS INTEGER) AS DATE) AS sales_date,
         e.rm_name,
         CAST((y.yr - y.y0) * 4 + e.ev_idx + 1 AS INTEGER) AS number,
         CAST(dn.day_number AS INTEGER) AS day_number
  FROM (SELECT year(min(l_shipdate)) AS y0,
               unnest(generate_series(year(min(l_shipdate)), year(max(l_shipdate)))) AS yr
        FROM lineitem) y
  CROSS JOIN rm_events e
  JOIN (SELECT unnest(generate_series(1, 3)) AS day_number) dn ON dn.day_number <= e.n_days""",
    "traffic": """
  SELECT o_orderpriority AS store_nm, CAST(o_orderdate AS DATE) AS sales_date,
         count(*) * 1000 AS site_traffic
  FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)""",
    "color_lexicon": """
  SELECT DISTINCT split_part(p_name, ' ', 1) AS color FROM part""",
    # data master for platform MAIN, inventory lagged one day
    "master": """
  SELECT d.platform, d.sales_date, d.prod_code, d.season1, d.inseason_flag1,
         d.sales_qty, d.sales_amt, d.MSRP,
         a.style_number, a.division, a.gender_group, a.gc_category, a.model,
         a.class_platform, a.power_item, a.color_desc,
         CASE WHEN round_even(d.sales_amt / d.sales_qty / d.MSRP, 2) > 1 THEN 1.0
              ELSE round_even(d.sales_amt / d.sales_qty / d.MSRP, 2) END AS md,
         i.inv_qty
  FROM (SELECT platform, sales_date, prod_code, season1, inseason_flag1,
               sum(sales_qty) AS sales_qty, sum(sales_amt) AS sales_amt, median(MSRP) AS MSRP
        FROM sales_trans WHERE platform = 'MAIN'
        GROUP BY platform, sales_date, prod_code, season1, inseason_flag1) d
  LEFT JOIN attributes a ON d.prod_code = a.prod_code
  LEFT JOIN (SELECT CASE WHEN store_nm = '4-NOT SPECIFIED' THEN 'SIDE' ELSE 'MAIN' END AS platform,
                    prod_code, CAST(eop_dt + INTERVAL 1 DAY AS DATE) AS sales_date, sum(eop_qty) AS inv_qty
             FROM inventory GROUP BY 1, 2, 3) i
    ON d.platform = i.platform AND d.sales_date = i.sales_date AND d.prod_code = i.prod_code""",
    # SKU feature base: footwear rows of the master with md keys and group
    "sku": """
  SELECT m.*, substr(m.prod_code, 1, 6) AS style_cd,
         CAST(round_even(m.md * 10, 0) AS INTEGER) AS md10,
         CAST(round_even(m.md * 10, 0) AS DOUBLE) / 10 AS md1,
         m.gc_category || '_' || m.gender_group AS grp
  FROM master m WHERE m.division = 'FOOTWEAR'""",
    "bounds": """
  SELECT season AS season1, min(cal_date) AS season_start, max(cal_date) AS season_end
  FROM season_calendar GROUP BY season""",
    # style rollup: sums, mean md, attributes of the best-selling SKU
    "style": """
  SELECT k.sales_date, k.style_cd, k.season1, k.inseason_flag1, k.sales_qty, k.sales_amt,
         k.inv_qty, k.md,
         CAST(round_even(k.md * 10, 0) AS INTEGER) AS md10,
         CAST(round_even(k.md * 10, 0) AS DOUBLE) / 10 AS md1,
         b.platform, b.MSRP, b.prod_code, b.style_number, b.division, b.gender_group,
         b.gc_category, b.model, b.class_platform, b.power_item, b.color_desc, b.grp
  FROM (SELECT sales_date, style_cd, season1, inseason_flag1, sum(sales_qty) AS sales_qty,
               sum(sales_amt) AS sales_amt, coalesce(sum(inv_qty), 0) AS inv_qty,
               sum(round_even(md * 100, 0)) / count(md) / 100.0 AS md
        FROM sku GROUP BY sales_date, style_cd, season1, inseason_flag1) k
  JOIN (SELECT *, row_number() OVER (PARTITION BY sales_date, style_cd, season1, inseason_flag1
                                     ORDER BY sales_qty DESC, prod_code DESC) AS rn FROM sku) b
    ON b.rn = 1 AND k.sales_date = b.sales_date AND k.style_cd = b.style_cd
   AND k.season1 = b.season1 AND k.inseason_flag1 = b.inseason_flag1""",
}


def with_views(query: str, extra: dict | None = None) -> str:
    """Prefix a query with all fixture views (DuckDB inlines unused CTEs)."""
    views = dict(VIEWS)
    views.update(extra or {})
    ctes = ",\n".join(f"{name} AS ({body}\n)" for name, body in views.items())
    q = query.lstrip()
    if q[:4].upper() == "WITH":
        return f"WITH {ctes},\n{q[4:].lstrip()}"
    return f"WITH {ctes}\n{query}"
