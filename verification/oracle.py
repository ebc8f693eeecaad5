"""SQL for DuckDB that states, from the semantics, what each registered query returns.

``BASE`` derives the raw tables by the rules of FIXTURES.md and the star schema from
them; a query is BASE plus one final SELECT.
"""

from __future__ import annotations

BASE = """
WITH
master AS (
  SELECT CASE c_custkey % 3 WHEN 0 THEN 'ZF2526' WHEN 1 THEN 'ZF2627' ELSE 'ZFN2526' END AS folder,
         c_custkey + rep * 1000000000000 AS seq,
         CASE WHEN c_custkey % 101 = 100 THEN 'G' ELSE '' END || CAST(c_custkey // 3 AS VARCHAR) AS code,
         CASE WHEN rep = 1 THEN 'DUP ' ELSE '' END || c_name AS name,
         c_mktsegment AS grp,
         CAST(c_nationkey AS VARCHAR) AS state,
         lower(c_mktsegment) AS place,
         CAST(c_custkey + 9000000000 AS VARCHAR) AS mobile,
         CAST(c_acctbal AS DECIMAL(18,2)) - 100.00 AS opening,
         CASE WHEN rep = 1 THEN 0 ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS balance,
         CASE WHEN rep = 0 AND c_nationkey <> 24 THEN (c_nationkey % 10) * 1000 END AS climit,
         'GST' || CAST(c_custkey AS VARCHAR) AS gst
  FROM customer CROSS JOIN (VALUES (0), (1)) AS reps(rep)
  WHERE rep = 0 OR c_custkey % 50 = 7
),
item AS (
  SELECT f.folder, p_partkey AS seq,
         CASE WHEN p_partkey % 89 = 88 THEN 'G' ELSE '' END || CAST(p_partkey AS VARCHAR) AS code,
         p_name AS descr, p_brand AS grp, substr(p_type, 1, 3) AS uom,
         CAST(p_size + 1000 AS VARCHAR) AS hsn, p_type AS valuation,
         CAST(p_retailprice AS DECIMAL(18,2)) + 0.0025 AS rate,
         p_size AS qty,
         CAST(p_retailprice AS DECIMAL(18,2)) * p_size AS val,
         CASE p_size % 5 WHEN 0 THEN 'y' WHEN 1 THEN 'TRUE' WHEN 3 THEN 'N' WHEN 4 THEN 'F' END AS service
  FROM part, (VALUES ('ZF2526'), ('ZF2627'), ('ZFN2526')) AS f(folder)
),
ord AS (
  SELECT *, CASE o_custkey % 3 WHEN 0 THEN 'ZF2526' WHEN 1 THEN 'ZF2627' ELSE 'ZFN2526' END AS folder,
         CAST(o_custkey // 3 AS VARCHAR) AS cust,
         CAST(o_orderdate AS DATE) AS day,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total
  FROM orders
),
sales1 AS (
  SELECT folder, o_orderkey + rep * 1000000000000 AS seq,
         o_orderkey + CASE WHEN o_orderkey % 53 = 52 THEN 1000000000000000 ELSE 0 END AS no,
         CAST(day + CASE WHEN rep = 1 THEN 7 ELSE 0 END AS DATE) AS day,
         CASE WHEN rep = 1 THEN 'CN' WHEN rep IN (0, 2) THEN 'SI' END AS type,
         cust,
         total + CASE WHEN rep = 2 THEN 1 ELSE 0 END - 10 AS bill,
         total + CASE WHEN rep = 2 THEN 1 ELSE 0 END AS total,
         o_orderpriority AS transport,
         o_orderkey % 60 + 1 AS due
  FROM ord, (VALUES (0), (1), (2), (3), (4)) AS reps(rep)
  WHERE rep = 0 OR (rep = 1 AND o_orderkey % 40 = 3) OR (rep = 2 AND o_orderkey % 60 = 5)
     OR (rep >= 3 AND o_orderkey % 200 = 9)
),
sales2 AS (
  SELECT folder, l_orderkey AS no, 'SI' AS type, cust,
         CAST(l_partkey + CASE WHEN l_partkey % 97 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS item,
         CAST(l_suppkey AS VARCHAR) AS rep, CAST(l_quantity AS DECIMAL(18,3)) AS qty,
         100 + l_partkey % 900 + 0.0001 * (l_partkey % 10000) AS rate, CAST(l_discount AS DECIMAL(18,2)) AS disc, l_linenumber AS disamt,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag || l_linestatus AS batch, l_orderkey
  FROM lineitem JOIN ord ON o_orderkey = l_orderkey
),
trans AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'ZF2526' WHEN 1 THEN 'ZF2627' ELSE 'ZFN2526' END AS folder,
         event_id AS no, CAST(ts AS DATE) AS day, CAST(user_id // 3 AS VARCHAR) AS code, props AS narration,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'D' WHEN event_type IN ('click', 'view') THEN 'C' END AS flag,
         CAST(value AS DECIMAL(18,2)) AS amount, event_type AS rep
  FROM events
),
billadj AS (
  SELECT folder, o_orderkey AS no, CAST(day + 30 AS DATE) AS day, cust, total,
         CASE o_orderstatus WHEN 'F' THEN total WHEN 'P' THEN total - 100 END AS adjusted
  FROM ord
),
dim_customer AS (
  SELECT folder || '|' || code AS customer_key, folder AS source_folder, code AS ledger_code, name AS customer_name,
         grp AS account_group, state, place, mobile, opening AS opening_balance, balance AS current_balance,
         climit AS credit_limit, gst AS gst_number, TRUE AS is_active,
         code IN ('26', '72', '62', 'CSTK', '25', 'C', 'P', 'S', '01', '02', '2') AS is_internal_account
  FROM (SELECT *, row_number() OVER (PARTITION BY folder, code ORDER BY seq) AS rn FROM master) WHERE rn = 1
),
dim_product AS (
  SELECT folder || '|' || code AS product_key, folder AS source_folder, code AS item_code, descr AS item_description,
         grp AS item_group, uom, hsn AS hsn_code, valuation AS valuation_method, rate AS standard_rate,
         qty AS opening_qty, val AS opening_value,
         service IS NOT NULL AND upper(service) IN ('Y', 'T', '1', 'TRUE') AS is_service
  FROM (SELECT *, row_number() OVER (PARTITION BY folder, code ORDER BY seq) AS rn FROM item) WHERE rn = 1
),
fact_sales AS (
  SELECT s.folder AS source_folder, CAST(s.no AS VARCHAR) AS invoice_no, h.day AS invoice_date, s.type AS invoice_type,
         c.customer_key, p.product_key, s.rep AS rep_code, s.qty AS quantity, s.rate, s.disc AS discount_pct,
         s.disamt AS discount_amt, s.amount AS line_amount, s.batch AS batch_no, h.type AS header_type
  FROM sales2 s
  LEFT JOIN sales1 h ON h.folder = s.folder AND h.no = s.no
  LEFT JOIN dim_customer c ON c.source_folder = s.folder AND c.ledger_code = s.cust
  LEFT JOIN dim_product p ON p.source_folder = s.folder AND p.item_code = s.item
),
fact_sales_header AS (
  SELECT h.folder AS source_folder, CAST(h.no AS VARCHAR) AS invoice_no, h.day AS invoice_date, h.type AS invoice_type,
         c.customer_key, h.bill AS bill_amount, 10.00 AS tax_amount, 0.00 AS round_off, h.total AS total_amount,
         h.transport, h.due AS due_days
  FROM (SELECT *, row_number() OVER (PARTITION BY folder, no, type ORDER BY seq) AS rn FROM sales1) h
  LEFT JOIN dim_customer c ON c.source_folder = h.folder AND c.ledger_code = h.cust
  WHERE h.rn = 1 OR h.type IS NULL
),
fact_finance AS (
  SELECT t.folder AS source_folder, CAST(t.no AS VARCHAR) AS voucher_no, t.day AS voucher_date,
         c.customer_key AS ledger_key, t.narration, t.flag AS debit_credit, t.amount, t.rep AS rep_code
  FROM trans t LEFT JOIN dim_customer c ON c.source_folder = t.folder AND c.ledger_code = t.code
),
fact_receivables AS (
  SELECT b.folder AS source_folder, CAST(b.no AS VARCHAR) AS voucher_no, b.day AS voucher_date, c.customer_key,
         b.total AS voucher_amount, b.adjusted AS bill_adjusted, b.total AS bill_amount,
         CAST(b.no AS VARCHAR) AS ref_invoice_no
  FROM billadj b LEFT JOIN dim_customer c ON c.source_folder = b.folder AND c.ledger_code = b.cust
),
ext AS (
  SELECT f.*, c.ledger_code, c.customer_name, c.current_balance
  FROM fact_sales f JOIN dim_customer c USING (customer_key)
  WHERE NOT c.is_internal_account
),
overview AS (
  SELECT f.source_folder, count(DISTINCT invoice_no) AS total_invoices, sum(line_amount) AS total_revenue,
         count(DISTINCT customer_key) AS active_customers,
         max((SELECT sum(current_balance) FROM dim_customer d
              WHERE d.source_folder = f.source_folder AND current_balance > 0 AND NOT is_internal_account)) AS total_receivables
  FROM ext f GROUP BY f.source_folder
),
today AS (
  SELECT source_folder, count(DISTINCT invoice_no) AS invoice_count, sum(line_amount) AS total_sales
  FROM ext WHERE invoice_date = DATE '1998-06-15' GROUP BY source_folder
),
daily AS (
  SELECT source_folder, invoice_date, count(DISTINCT invoice_no) AS invoice_count,
         sum(line_amount) AS total_sales, sum(quantity) AS total_qty
  FROM ext WHERE invoice_date IS NOT NULL GROUP BY ALL
),
monthly AS (
  SELECT source_folder, CAST(date_trunc('month', invoice_date) AS DATE) AS month,
         count(DISTINCT invoice_no) AS invoice_count, sum(line_amount) AS total_sales
  FROM fact_sales WHERE invoice_date IS NOT NULL GROUP BY ALL
),
buyers AS (
  SELECT source_folder, ledger_code, customer_name, count(DISTINCT invoice_no) AS invoice_count,
         sum(line_amount) AS total_purchases, current_balance AS outstanding_balance,
         max(invoice_date) AS last_purchase_date
  FROM ext GROUP BY source_folder, ledger_code, customer_name, current_balance
),
sellers AS (
  SELECT p.source_folder, p.item_code, p.item_description, p.item_group, sum(f.quantity) AS total_qty_sold,
         sum(f.line_amount) AS total_revenue, count(DISTINCT f.invoice_no) AS times_ordered
  FROM fact_sales f JOIN dim_product p USING (product_key) GROUP BY ALL
),
slow AS (
  SELECT p.source_folder, p.item_code, p.item_description, p.opening_qty, max(f.invoice_date) AS last_sold_date,
         date_diff('day', max(f.invoice_date), DATE '1998-06-15') AS days_since_last_sale
  FROM dim_product p LEFT JOIN fact_sales f USING (product_key)
  GROUP BY p.source_folder, p.item_code, p.item_description, p.opening_qty
  HAVING max(f.invoice_date) IS NULL OR date_diff('day', max(f.invoice_date), DATE '1998-06-15') > 90
),
owing AS (
  SELECT source_folder, ledger_code, customer_name, current_balance AS outstanding_amount, credit_limit,
         credit_limit IS NOT NULL AND credit_limit > 0 AND current_balance > credit_limit AS over_credit_limit
  FROM dim_customer WHERE current_balance > 0 AND NOT is_internal_account
),
flow AS (
  SELECT source_folder, voucher_date,
         sum(amount) FILTER (WHERE debit_credit = 'D') AS deb,
         sum(amount) FILTER (WHERE debit_credit = 'C') AS cre,
         sum(amount) FILTER (WHERE debit_credit IS NULL OR debit_credit <> 'D') AS other
  FROM fact_finance WHERE voucher_date IS NOT NULL GROUP BY ALL
),
cash AS (
  SELECT source_folder, voucher_date, coalesce(deb, 0) AS total_debit, coalesce(cre, 0) AS total_credit,
         coalesce(deb, 0) - coalesce(other, 0) AS net_movement
  FROM flow
),
ltv AS (
  SELECT source_folder, ledger_code, customer_name, min(invoice_date) AS first_purchase,
         max(invoice_date) AS last_purchase, count(DISTINCT invoice_no) AS total_orders,
         sum(line_amount) AS lifetime_value, CAST(sum(line_amount) * 100 AS HUGEINT) AS cents
  FROM ext GROUP BY source_folder, ledger_code, customer_name
),
rawcount AS (
  SELECT folder, 'MASTER' AS tbl, count(*) AS n FROM master GROUP BY folder
  UNION ALL SELECT folder, 'ITEM', count(*) FROM item GROUP BY folder
  UNION ALL SELECT folder, 'SALES1', count(*) FROM sales1 GROUP BY folder
  UNION ALL SELECT folder, 'SALES2', count(*) FROM sales2 GROUP BY folder
  UNION ALL SELECT folder, 'TRANS', count(*) FROM trans GROUP BY folder
  UNION ALL SELECT folder, 'BILLADJ', count(*) FROM billadj GROUP BY folder
),
fields AS (
  SELECT unnest(string_split(names, ' ')) AS field_name, tbl, kind FROM (VALUES
    ('MASTER', 'text', 'CODECBG DESCCBG GROUPCDBG STATECODE PLACE_CDBG MOBILENO APGSTTBG'),
    ('MASTER', 'money', 'OPBALCBG BALANCEBG CRELIMITBG'),
    ('ITEM', 'text', 'ITEMCODE DESC ITEMGROUP UOM HSNCODE VALUATION IS_SERVICE'),
    ('ITEM', 'money', 'OPBALVAL'),
    ('ITEM', 'rate', 'ITEMRATE'),
    ('ITEM', 'quantity', 'OPBALQTY'),
    ('SALES1', 'text', 'INVTYPEBG CUSCODEBG TRANSPORTG'),
    ('SALES1', 'number', 'INVNOEBG'),
    ('SALES1', 'day', 'INVDATEBG'),
    ('SALES1', 'money', 'BILLAMTG TAXAMTNG ROUNDOFFG TOTALIONG'),
    ('SALES1', 'days', 'DUEDAYSG'),
    ('SALES2', 'text', 'INVTYPE CUSCODE ITEMCODE REPCODE BATCHNO'),
    ('SALES2', 'number', 'INVNO'),
    ('SALES2', 'quantity', 'QTY'),
    ('SALES2', 'money', 'DISCOUNT DISAMT AMOUNT'),
    ('SALES2', 'rate', 'ITEMRATE'),
    ('TRANS', 'text', 'CODEE NARATION DRCRATE REPCODE'),
    ('TRANS', 'number', 'VOUNOE'),
    ('TRANS', 'day', 'VOUDATE'),
    ('TRANS', 'money', 'VOU_AMT'),
    ('BILLADJ', 'text', 'CUSCODE'),
    ('BILLADJ', 'number', 'VOUNO INVNO'),
    ('BILLADJ', 'day', 'VOUDATE'),
    ('BILLADJ', 'money', 'VOU_AMT BILLADJ BILLAMT')) AS t(tbl, kind, names)
)
"""

# Output columns by kind: money and quantities are compared as DOUBLE, counts as BIGINT.
_DIM_CUSTOMER = """customer_key, source_folder, ledger_code, customer_name, account_group, state, place, mobile,
  CAST(opening_balance AS DOUBLE) AS opening_balance, CAST(current_balance AS DOUBLE) AS current_balance,
  CAST(credit_limit AS DOUBLE) AS credit_limit, gst_number, is_active, is_internal_account"""
_DIM_PRODUCT = """product_key, source_folder, item_code, item_description, item_group, uom, hsn_code, valuation_method,
  CAST(standard_rate AS DOUBLE) AS standard_rate, CAST(opening_qty AS DOUBLE) AS opening_qty,
  CAST(opening_value AS DOUBLE) AS opening_value, is_service"""
_SALES = """source_folder, invoice_no, invoice_date, invoice_type, customer_key, product_key, rep_code,
  CAST(quantity AS DOUBLE) AS quantity, CAST(rate AS DOUBLE) AS rate, CAST(discount_pct AS DOUBLE) AS discount_pct,
  CAST(discount_amt AS DOUBLE) AS discount_amt, CAST(line_amount AS DOUBLE) AS line_amount, batch_no"""
_HEADER = """source_folder, invoice_no, invoice_date, invoice_type, customer_key, CAST(bill_amount AS DOUBLE) AS bill_amount,
  CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(round_off AS DOUBLE) AS round_off,
  CAST(total_amount AS DOUBLE) AS total_amount, transport, CAST(due_days AS BIGINT) AS due_days"""
_FINANCE = """source_folder, voucher_no, voucher_date, ledger_key, narration, debit_credit,
  CAST(amount AS DOUBLE) AS amount, rep_code"""
_RECEIVABLES = """source_folder, voucher_no, voucher_date, customer_key, CAST(voucher_amount AS DOUBLE) AS voucher_amount,
  CAST(bill_adjusted AS DOUBLE) AS bill_adjusted, CAST(bill_amount AS DOUBLE) AS bill_amount, ref_invoice_no"""
_OVERVIEW = """source_folder, total_invoices, CAST(total_revenue AS DOUBLE) AS total_revenue, active_customers,
  CAST(total_receivables AS DOUBLE) AS total_receivables"""
_COUNT_TOTAL = "source_folder, invoice_count, CAST(total_sales AS DOUBLE) AS total_sales"
_DAILY = "source_folder, invoice_date, invoice_count, CAST(total_sales AS DOUBLE) AS total_sales, CAST(total_qty AS DOUBLE) AS total_qty"
_MONTHLY = "source_folder, month, invoice_count, CAST(total_sales AS DOUBLE) AS total_sales"
_BUYERS = """source_folder, ledger_code, customer_name, invoice_count, CAST(total_purchases AS DOUBLE) AS total_purchases,
  CAST(outstanding_balance AS DOUBLE) AS outstanding_balance, last_purchase_date"""
_SELLERS = """source_folder, item_code, item_description, item_group, CAST(total_qty_sold AS DOUBLE) AS total_qty_sold,
  CAST(total_revenue AS DOUBLE) AS total_revenue, times_ordered"""
_SLOW = """source_folder, item_code, item_description, CAST(opening_qty AS DOUBLE) AS opening_qty, last_sold_date,
  CAST(days_since_last_sale AS BIGINT) AS days_since_last_sale"""
_OWING = """source_folder, ledger_code, customer_name, CAST(outstanding_amount AS DOUBLE) AS outstanding_amount,
  CAST(credit_limit AS DOUBLE) AS credit_limit, over_credit_limit"""
_CASH = """source_folder, voucher_date, CAST(total_debit AS DOUBLE) AS total_debit,
  CAST(total_credit AS DOUBLE) AS total_credit, CAST(net_movement AS DOUBLE) AS net_movement"""
_LTV = """source_folder, ledger_code, customer_name, first_purchase, last_purchase, total_orders,
  CAST(lifetime_value AS DOUBLE) AS lifetime_value,
  CAST(sign(cents) * ((2 * abs(cents) + total_orders) // (2 * total_orders)) AS BIGINT) / 100.0 AS avg_order_value"""
_FIRST_FOLDER = "source_folder = 'ZF2526'"

_PROJECTIONS = {
    "dim_customer": (_DIM_CUSTOMER, "dim_customer"),
    "dim_product": (_DIM_PRODUCT, "dim_product"),
    "fact_sales": (_SALES, "fact_sales"),
    "fact_sales_header": (_HEADER, "fact_sales_header"),
    "fact_finance": (_FINANCE, "fact_finance"),
    "fact_receivables": (_RECEIVABLES, "fact_receivables"),
    "sales_summary": (_DAILY, "daily"),
    "today_sales": (_COUNT_TOTAL, "today"),
    "monthly_sales": (_MONTHLY, "monthly"),
    "top_customers": (_BUYERS, "buyers"),
    "top_products": (_SELLERS, "sellers"),
    "slow_moving": (_SLOW, "slow"),
    "outstanding_receivables": (_OWING, "owing"),
    "cash_flow": (_CASH, "cash"),
    "customer_ltv": (_LTV, "ltv"),
    "company_overview": (_OVERVIEW, "overview"),
    "q_overview": (_OVERVIEW, "overview"),
    "q_overview_folder": (_OVERVIEW, f"overview WHERE {_FIRST_FOLDER}"),
    "q_today_sales": (_COUNT_TOTAL, "today"),
    "q_monthly_sales": (_MONTHLY, "monthly ORDER BY month DESC NULLS FIRST, source_folder LIMIT 12"),
    "q_sales_summary": (_DAILY, "daily WHERE invoice_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"),
    "q_top_customers": (_BUYERS, "buyers ORDER BY total_purchases DESC NULLS FIRST, source_folder, ledger_code LIMIT 20"),
    "q_top_customers_folder": (
        _BUYERS,
        f"buyers WHERE {_FIRST_FOLDER} ORDER BY total_purchases DESC NULLS FIRST, ledger_code LIMIT 15",
    ),
    "q_receivables": (_OWING, "owing ORDER BY outstanding_amount DESC NULLS FIRST, source_folder, ledger_code LIMIT 50"),
    "q_customer_ltv": (_LTV, "ltv ORDER BY lifetime_value DESC NULLS FIRST, source_folder, ledger_code LIMIT 20"),
    "q_customer_detail": (_DIM_CUSTOMER, "dim_customer WHERE ledger_code = '11'"),
    "q_top_products": (_SELLERS, "sellers ORDER BY total_revenue DESC NULLS FIRST, source_folder, item_code LIMIT 20"),
    "q_slow_moving": (_SLOW, "slow ORDER BY last_sold_date ASC NULLS FIRST, source_folder, item_code LIMIT 50"),
    "q_product_detail": (_DIM_PRODUCT, "dim_product WHERE item_code = '42'"),
    "q_cash_flow": (_CASH, "cash WHERE voucher_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"),
    "q_inventory_items": (
        _DIM_PRODUCT,
        "dim_product WHERE item_group = 'Brand#2' ORDER BY item_description ASC NULLS LAST, source_folder, item_code LIMIT 100",
    ),
    "q_invoice_header": (_HEADER, "fact_sales_header WHERE invoice_no = '83'"),
    "folder_filter": (_SALES, "fact_sales WHERE source_folder = 'ZFN2526'"),
    "fact_sales_match_type": (
        _SALES,
        """(
  SELECT * FROM fact_sales WHERE header_type = invoice_type
  UNION ALL
  SELECT s.folder, CAST(s.no AS VARCHAR), NULL, s.type, c.customer_key, p.product_key, s.rep, s.qty, s.rate, s.disc,
         s.disamt, s.amount, s.batch, NULL
  FROM sales2 s
  LEFT JOIN dim_customer c ON c.source_folder = s.folder AND c.ledger_code = s.cust
  LEFT JOIN dim_product p ON p.source_folder = s.folder AND p.item_code = s.item
  WHERE NOT EXISTS (SELECT 1 FROM sales1 h WHERE h.folder = s.folder AND h.no = s.no AND h.type = s.type)
)""",
    ),
}

_SELECTS = {
    "dim_date": """
SELECT CAST(d AS DATE) AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
       rpad(monthname(d), 9, ' ') AS month_name, day(d) AS day, rpad(dayname(d), 9, ' ') AS day_name,
       CAST(strftime(d, '%V') AS BIGINT) AS week_of_year, isodow(d) >= 6 AS is_weekend,
       CASE WHEN month(d) > 3 THEN 'FY' || year(d) || '-' || right(CAST(year(d) + 1 AS VARCHAR), 2)
            ELSE 'FY' || (year(d) - 1) || '-' || right(CAST(year(d) AS VARCHAR), 2) END AS financial_year
FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS d FROM ord)""",
    "dim_customer_rejects": "SELECT folder AS source_folder, seq AS _seq, name AS desccbg, mobile AS mobileno FROM master WHERE seq % 10 = 4",
    "dim_ledger_group": """
SELECT folder || '|' || grp AS group_key, folder AS source_folder, grp AS group_code,
       arg_min(valuation || ' ' || descr, seq) AS group_name, arg_min(uom, seq) AS main_group_code
FROM item GROUP BY folder, grp""",
    "union_folders": """
SELECT folder AS source_folder, code AS item_code, descr AS item_description,
       CASE WHEN folder <> 'ZF2627' THEN uom END AS uom, CAST(val AS DOUBLE) AS opening_value
FROM item""",
    "financial_year": """
SELECT 'FY' || CAST(fy AS VARCHAR) || '-' || right(CAST(fy + 1 AS VARCHAR), 2) AS financial_year, count(*) AS invoices,
       CAST(sum(total) AS DOUBLE) AS total_amount
FROM (SELECT *, year(day) - CASE WHEN month(day) <= 3 THEN 1 ELSE 0 END AS fy FROM sales1) GROUP BY fy""",
    "parse_service_flag": """
SELECT folder AS source_folder, service AS raw_text, coalesce(lower(service) IN ('y', 't', '1', 'true'), FALSE) AS is_service,
       count(*) AS items
FROM item GROUP BY ALL""",
    "internal_flag": """
SELECT source_folder, ledger_code, customer_name FROM dim_customer WHERE is_internal_account""",
    "over_limit_flag": """
SELECT source_folder, credit_limit IS NULL AS no_limit,
       coalesce(credit_limit > 0 AND current_balance > credit_limit, FALSE) AS over_credit_limit, count(*) AS customers
FROM dim_customer GROUP BY ALL""",
    "display_labels": """
SELECT s.source_folder, s.item_code, coalesce(s.item_description, s.item_code) AS display_name,
       CASE WHEN length(coalesce(s.item_description, s.item_code)) > 8
            THEN left(coalesce(s.item_description, s.item_code), 8) || '…'
            ELSE coalesce(s.item_description, s.item_code) END AS short_name,
       CASE WHEN days_since_last_sale IS NULL THEN 'Never sold' ELSE days_since_last_sale || 'd' END AS idle,
       CASE WHEN p.is_service THEN 'Service' ELSE 'Goods' END AS kind
FROM slow s JOIN dim_product p ON p.source_folder = s.source_folder AND p.item_code = s.item_code""",
    "display_labels_customers": """
SELECT source_folder, ledger_code, customer_name AS display_name,
       CASE WHEN over_credit_limit THEN 'Over Limit' ELSE 'OK' END AS limit_status
FROM owing""",
    "display_labels_vouchers": """
SELECT source_folder, CASE debit_credit WHEN 'D' THEN 'Debit' WHEN 'C' THEN 'Credit' ELSE '—' END AS movement,
       count(*) AS vouchers
FROM fact_finance GROUP BY ALL""",
    "clean_text": r"""
SELECT doc_id, md5(cleaned) AS cleaned_md5, length(cleaned) AS cleaned_chars
FROM (SELECT doc_id, nullif(regexp_replace(
        regexp_replace(text, '[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}\x{fffd}]', '', 'g'),
        '^[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$',
        '', 'g'), '') AS cleaned FROM documents)""",
    "coerce_types": """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 11 = 4 THEN NULL WHEN o_orderkey % 13 = 6 THEN NULL ELSE CAST(total AS DOUBLE) END AS number,
       CASE WHEN o_orderkey % 17 = 9 THEN NULL ELSE day END AS day,
       CASE WHEN o_orderkey % 19 = 2 THEN NULL ELSE o_orderkey % 100000 END AS whole,
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag
FROM ord""",
    "dbf_scan": """
SELECT o_orderkey AS invno, CASE WHEN o_orderkey % 97 = 13 THEN NULL ELSE day END AS invdate,
       CASE WHEN o_orderkey % 89 = 7 THEN NULL ELSE CAST(total AS DOUBLE) END AS total,
       o_orderpriority || CASE WHEN o_orderkey % 2 = 1 THEN ' €é' ELSE '' END AS label,
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS paid
FROM ord WHERE o_orderkey % 37 NOT IN (5, 6)""",
    "exact_dedup": """
SELECT DISTINCT folder AS source_folder, CAST(no AS VARCHAR) AS invno, cust AS cuscode, item AS itemcode, rep AS repcode,
       CAST(qty AS DOUBLE) AS qty, CAST(rate AS DOUBLE) AS itemrate, CAST(disc AS DOUBLE) AS discount,
       CAST(disamt AS DOUBLE) AS disamt, CAST(amount AS DOUBLE) AS amount, batch AS batchno, type AS invtype,
       CAST(no * 8 + disamt AS BIGINT) AS _seq
FROM sales2""",
    "duplicate_counts": """
SELECT source_folder, CAST(sum(n) AS BIGINT) AS rows_read, count(*) AS rows_kept, CAST(sum(n) - count(*) AS BIGINT) AS duplicates_skipped
FROM (SELECT folder AS source_folder, sum(CASE WHEN l_orderkey % 70 = 1 THEN 2 ELSE 1 END) AS n
      FROM sales2 GROUP BY folder, no, cust, item, rep, qty, rate, disc, disamt, amount, batch)
GROUP BY source_folder""",
    "row_hash": """
SELECT folder AS source_folder, code AS codecbg, seq AS _seq,
       substr(md5('{"apgsttbg":"' || gst || '","balancebg":' || CAST(CAST(balance AS DECIMAL(18,2)) AS VARCHAR)
         || ',"codecbg":"' || code || '","crelimitbg":' || coalesce(CAST(CAST(climit AS DECIMAL(18,2)) AS VARCHAR), 'null')
         || ',"desccbg":"' || name || '","groupcdbg":"' || grp || '","mobileno":"' || mobile
         || '","opbalcbg":' || CAST(CAST(opening AS DECIMAL(18,2)) AS VARCHAR) || ',"place_cdbg":"' || place || '","statecode":' || CASE WHEN state = '24' THEN 'null' ELSE '"' || state || '"' END || '}'), 1, 16) AS row_hash
FROM master""",
    "lineage_columns": """
SELECT folder AS _source_folder, 'SALES1' AS _source_table, count(*) AS rows,
       count(DISTINCT (no, day, type, cust, bill, total, transport, due)) AS hashes
FROM sales1 GROUP BY folder""",
    "evolve_schema": """
SELECT folder AS source_folder, code AS codecbg, seq AS _seq, CASE WHEN folder = 'ZF2526' THEN NULL ELSE gst END AS apgsttbg,
       CASE WHEN folder = 'ZF2526' THEN place END AS place_cdbg, CAST(balance AS DOUBLE) AS balancebg
FROM master""",
    "changed_files": """
SELECT folder AS source_folder, 'MASTER' AS table_name, md5(CAST(count(*) AS VARCHAR) || '|' || CAST(sum(seq) AS VARCHAR)) AS file_hash
FROM master GROUP BY folder
UNION ALL
SELECT folder, 'ITEM', md5(CAST(count(*) AS VARCHAR) || '|' || CAST(sum(seq) AS VARCHAR))
FROM item WHERE folder = 'ZFN2526' GROUP BY folder""",
    "file_state_upsert": """
SELECT source_folder, table_name, max(last_synced) AS last_synced, arg_max(row_count, last_synced) AS row_count FROM (
  SELECT folder AS source_folder, 'SALES1' AS table_name, day AS last_synced, count(*) AS row_count FROM sales1 GROUP BY folder, day
  UNION ALL
  SELECT folder, 'BILLADJ', day, count(*) FROM billadj GROUP BY folder, day)
GROUP BY source_folder, table_name""",
    "replace_slice": """
SELECT source_folder, table_name, rows, CAST(total AS DOUBLE) AS total FROM (
  SELECT folder AS source_folder, 'SALES1' AS table_name, count(*) AS rows, sum(total) AS total FROM sales1 WHERE folder <> 'ZF2627' GROUP BY folder
  UNION ALL
  SELECT folder, 'SALES1', count(*), sum(total) FROM billadj WHERE folder = 'ZF2627' GROUP BY folder)""",
    "sync_history": """
SELECT source_folder, table_name, CAST(day AS DATE) AS started_day, n AS rows_written FROM (
  SELECT folder AS source_folder, 'SALES1' AS table_name, day, count(*) AS n FROM sales1 GROUP BY folder, day)
ORDER BY day DESC NULLS FIRST, source_folder, table_name LIMIT 50""",
    "file_freshness": """
SELECT folder AS source_folder, 'SALES1' AS table_name, max(day) AS last_day, count(*) AS row_count FROM sales1 GROUP BY folder
UNION ALL
SELECT folder, 'TRANS', max(day), count(*) FROM trans GROUP BY folder""",
    "q_transactions": f"""
SELECT f.source_folder, f.ledger_key, f.voucher_no, f.voucher_date, f.narration, f.debit_credit,
       CAST(f.amount AS DOUBLE) AS amount, f.rep_code, c.customer_name
FROM fact_finance f LEFT JOIN dim_customer c ON c.customer_key = f.ledger_key
ORDER BY f.voucher_date DESC NULLS FIRST, f.source_folder, f.voucher_no LIMIT 100""",
    "q_transactions_ledger": f"""
SELECT f.source_folder, f.ledger_key, f.voucher_no, f.voucher_date, f.narration, f.debit_credit,
       CAST(f.amount AS DOUBLE) AS amount, f.rep_code, c.customer_name
FROM fact_finance f LEFT JOIN dim_customer c ON c.customer_key = f.ledger_key
WHERE c.ledger_code = '7'
ORDER BY f.voucher_date DESC NULLS FIRST, f.source_folder, f.voucher_no LIMIT 25""",
    "q_invoice_lines": f"""
SELECT f.* FROM (SELECT {_SALES}, product_key AS pk FROM fact_sales WHERE invoice_no = '83') f""",
    "kpi_totals": """
SELECT CAST(coalesce(sum(total_revenue), 0) AS DOUBLE) AS total_revenue, CAST(coalesce(sum(total_invoices), 0) AS BIGINT) AS total_invoices,
       CAST(coalesce(sum(active_customers), 0) AS BIGINT) AS total_customers,
       CAST(coalesce(sum(total_receivables), 0) AS DOUBLE) AS total_receivables,
       CAST(coalesce((SELECT sum(total_sales) FROM today), 0) AS DOUBLE) AS today_sales_total,
       CAST(coalesce((SELECT sum(invoice_count) FROM today), 0) AS BIGINT) AS today_invoice_count
FROM overview""",
    "monthly_trend_series": f"SELECT {_MONTHLY} FROM monthly ORDER BY month DESC, source_folder LIMIT 12",
    "cash_flow_series": """
SELECT source_folder, voucher_date, CAST(total_debit AS DOUBLE) AS debit, CAST(total_credit AS DOUBLE) AS credit
FROM cash ORDER BY voucher_date DESC, source_folder LIMIT 30""",
    "top_products_series": """
SELECT source_folder, item_code,
       CASE WHEN length(item_description) > 18 THEN left(item_description, 18) || '…' ELSE item_description END AS label,
       CAST(total_revenue AS DOUBLE) AS revenue
FROM sellers ORDER BY total_revenue DESC, source_folder, item_code LIMIT 10""",
    "check_revenue_reconciles": """
SELECT source_folder, raw_lines, CAST(raw_amount AS DOUBLE) AS raw_amount, fact_lines, CAST(fact_amount AS DOUBLE) AS fact_amount,
       CAST(fact_amount - raw_amount AS DOUBLE) AS difference
FROM (SELECT folder AS source_folder, count(*) AS raw_lines, sum(amount) AS raw_amount FROM sales2 GROUP BY folder)
FULL JOIN (SELECT source_folder, count(*) AS fact_lines, sum(line_amount) AS fact_amount FROM fact_sales GROUP BY source_folder)
  USING (source_folder)""",
    "check_orphan_customers": "SELECT count(*) - count(customer_key) AS orphan_lines FROM fact_sales",
    "check_orphan_products": "SELECT count(*) - count(product_key) AS orphan_lines FROM fact_sales",
    "row_counts": """
SELECT 'dim_date' AS table_name, date_diff('day', DATE '2020-01-01', DATE '2030-12-31') + 1 AS rows
UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
UNION ALL SELECT 'dim_product', count(*) FROM dim_product
UNION ALL SELECT 'fact_sales', count(*) FROM fact_sales
UNION ALL SELECT 'fact_sales_header', count(*) FROM fact_sales_header
UNION ALL SELECT 'fact_finance', count(*) FROM fact_finance
UNION ALL SELECT 'fact_receivables', count(*) FROM fact_receivables""",
    "raw_load_counts": "SELECT folder AS _source_folder, tbl AS _source_table, n AS row_count FROM rawcount",
    "latest_invoice_date": "SELECT max(invoice_date) AS latest_invoice_date FROM fact_sales",
    "all_null_check": """
SELECT r.folder AS _source_folder, r.tbl AS _source_table, n AS rows,
       CASE WHEN r.tbl = 'TRANS' THEN coalesce(e.empty, 0) ELSE 0 END AS all_null_rows,
       CASE WHEN r.tbl = 'TRANS' THEN coalesce(e.empty, 0) ELSE 0 END / n AS all_null_share
FROM rawcount r LEFT JOIN (SELECT folder, count(*) AS empty FROM trans WHERE no % 10 = 3 GROUP BY folder) e ON e.folder = r.folder""",
    "header_multiplicity": """
SELECT folder AS source_folder, CAST(no AS VARCHAR) AS invoice_no, n_headers, n_lines, n_headers * n_lines AS n_rows
FROM (SELECT folder, no, count(*) AS n_headers FROM sales1 GROUP BY folder, no HAVING count(*) > 1)
JOIN (SELECT folder, no, count(*) AS n_lines FROM sales2 GROUP BY folder, no) USING (folder, no)""",
    "dictionary_json": """
SELECT 'report' AS section, 'totals' AS name, NULL AS record_count, NULL AS fields, NULL AS tables,
       count(*) AS total_tables, CAST(sum(n) AS BIGINT) AS total_records
FROM rawcount
UNION ALL
SELECT 'table', r.folder || '/' || r.tbl, any_value(n),
       string_agg(entry, ',' ORDER BY entry), NULL, NULL, NULL
FROM rawcount r
JOIN (SELECT tbl, field_name || ':' || CASE kind WHEN 'text' THEN 'C:0' WHEN 'day' THEN 'D:8' WHEN 'days' THEN 'N:10' ELSE 'N:18' END || ':' ||
             CASE kind WHEN 'money' THEN 2 WHEN 'rate' THEN 4 WHEN 'quantity' THEN 3 WHEN 'days' THEN 1 ELSE 0 END AS entry
      FROM fields) f ON f.tbl = r.tbl
GROUP BY r.folder, r.tbl
UNION ALL
SELECT 'relationship', field_name, NULL, NULL, string_agg(folder || '/' || r.tbl, ', ' ORDER BY folder || '/' || r.tbl), NULL, NULL
FROM rawcount r JOIN fields f ON r.tbl = f.tbl
GROUP BY field_name HAVING count(*) > 1""",
    "sample_rows_all": """
SELECT folder AS source_folder, tbl AS table_name, row_no, a || '|' || b || '|' || c AS shown
FROM (
  SELECT *, row_number() OVER (PARTITION BY folder, tbl ORDER BY seq) AS row_no FROM (
    SELECT folder, 'MASTER' AS tbl, seq, coalesce(code, '') AS a, coalesce(name, '') AS b, coalesce(grp, '') AS c FROM master
    UNION ALL SELECT folder, 'ITEM', seq, coalesce(code, ''), coalesce(descr, ''), coalesce(grp, '') FROM item
    UNION ALL SELECT folder, 'SALES1', seq, CAST(no AS VARCHAR), strftime(day, '%Y-%m-%d'), coalesce(type, '') FROM sales1
    UNION ALL SELECT folder, 'SALES2', no * 8 + disamt, CAST(no AS VARCHAR), type, cust FROM sales2
    UNION ALL SELECT folder, 'TRANS', no, CAST(no AS VARCHAR), strftime(day, '%Y-%m-%d'), code FROM trans
    UNION ALL SELECT folder, 'BILLADJ', no, CAST(no AS VARCHAR), strftime(day, '%Y-%m-%d'), cust FROM billadj))
WHERE row_no <= 5""",
    "table_summary": """
SELECT folder AS source_folder, tbl AS table_name, n AS record_count,
       CASE tbl WHEN 'MASTER' THEN 10 WHEN 'ITEM' THEN 10 WHEN 'SALES1' THEN 10 WHEN 'SALES2' THEN 11 WHEN 'TRANS' THEN 7 ELSE 7 END AS field_count,
       CASE tbl WHEN 'MASTER' THEN 'Ledger Master (Customers, Suppliers, Accounts)' WHEN 'ITEM' THEN 'Product / Item Master'
                WHEN 'SALES1' THEN 'Sales Invoice Header' WHEN 'SALES2' THEN 'Sales Invoice Line Items'
                WHEN 'TRANS' THEN 'Accounting Transactions / Vouchers' ELSE '— To be analysed' END AS known_purpose
FROM rawcount
UNION ALL
SELECT 'TOTAL', CAST(count(*) AS VARCHAR), CAST(sum(n) AS BIGINT), NULL, NULL FROM rawcount""",
    "find_relationships": """
SELECT field_name, string_agg(folder || '/' || r.tbl, ', ' ORDER BY folder || '/' || r.tbl) AS tables,
       CASE field_name WHEN 'INVNO' THEN 'SALES1.INVNO  = SALES2.INVNO   (Header ↔ Lines)'
                       WHEN 'ITEMCODE' THEN 'SALES2.ITEMCODE  = ITEM.ITEMCODE  (Lines ↔ Product)'
                       ELSE '— Analyse manually' END AS join_hint
FROM rawcount r JOIN fields f ON r.tbl = f.tbl
GROUP BY field_name HAVING count(*) > 1""",
    "field_dictionary": """
SELECT r.folder AS source_folder, r.tbl AS table_name, f.field_name,
       CASE kind WHEN 'text' THEN 'C' WHEN 'day' THEN 'D' ELSE 'N' END AS type,
       CASE kind WHEN 'text' THEN 'Character' WHEN 'day' THEN 'Date' ELSE 'Numeric' END AS type_label,
       CASE kind WHEN 'text' THEN 0 WHEN 'day' THEN 8 WHEN 'days' THEN 10 ELSE 18 END AS length,
       CASE kind WHEN 'money' THEN 2 WHEN 'rate' THEN 4 WHEN 'quantity' THEN 3 WHEN 'days' THEN 1 ELSE 0 END AS decimals,
       CASE f.field_name WHEN 'INVNO' THEN 'Invoice Number' WHEN 'ITEMCODE' THEN 'Item Code' WHEN 'QTY' THEN 'Quantity'
                         WHEN 'AMOUNT' THEN 'Line Amount' WHEN 'UOM' THEN 'Unit of Measure' ELSE '' END AS meaning,
       (SELECT count(*) FROM fields g JOIN rawcount q ON q.tbl = g.tbl WHERE g.field_name = f.field_name) > 1 AS is_join_key
FROM rawcount r JOIN fields f ON r.tbl = f.tbl""",
    "sample_rows": """
SELECT folder AS source_folder, row_no, CAST(no AS VARCHAR) AS vounoe, strftime(day, '%Y-%m-%d') AS voudate, code AS codee,
       narration AS naration, coalesce(flag, '') AS drcrate, CAST(amount AS VARCHAR) AS vou_amt, rep AS repcode
FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY no) AS row_no FROM trans) WHERE row_no <= 5""",
    "incremental_rebuild": """
SELECT source_folder, CAST(date_trunc('month', invoice_date) AS DATE) AS month, count(*) AS rows,
       CAST(sum(line_amount + CASE WHEN changed THEN 1 ELSE 0 END) AS DOUBLE) AS revenue,
       CASE WHEN bool_or(changed) THEN 'second' ELSE 'first' END AS written_by
FROM (SELECT *, source_folder = 'ZF2526' AND CAST(invoice_no AS BIGINT) % 7 = 0 AS changed FROM fact_sales)
GROUP BY ALL""",
    "read_write_table": f"SELECT {_SALES} FROM fact_sales",
}
_SELECTS["q_invoice_lines"] = f"""
SELECT {_SALES}, item_description
FROM (SELECT f.*, p.item_description FROM fact_sales f
      LEFT JOIN (SELECT product_key AS pk, item_description FROM dim_product) p ON p.pk = f.product_key
      WHERE f.invoice_no = '83')"""


def oracle_sql() -> dict[str, str]:
    plain = {key: f"{BASE}SELECT {columns} FROM {source}" for key, (columns, source) in _PROJECTIONS.items()}
    return plain | {key: f"{BASE}{select.strip()}" for key, select in _SELECTS.items()}
