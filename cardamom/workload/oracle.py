"""Check SQL for DuckDB, one statement per query.

Money is added up in whole cents and averages are rounded in integer
arithmetic, so the check does not lean on either engine's decimal rules.
"""

from __future__ import annotations

# Cents of an amount column, and the half-up rounded mean of a group of cents.
_CENTS = "CAST(round({0} * 100) AS BIGINT)"


def _sum(col: str) -> str:
    return f"CAST(sum({_CENTS.format(col)}) AS DOUBLE) / 100.0"


def _mean(col: str) -> str:
    cents = f"CAST(sum({_CENTS.format(col)}) AS HUGEINT)"
    return f"CAST((2 * {cents} + count({col})) // (2 * count({col})) AS DOUBLE) / 100.0"


TX = """tx AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS business_id, o_custkey AS card_id,
         o_custkey AS user_id, o_orderdate AS timestamp, o_totalprice AS amount,
         o_orderstatus = 'F' AS declined
  FROM orders)"""

EV = """ev AS (
  SELECT event_id AS transaction_id, CAST(props->>'$.k' AS BIGINT) AS business_id,
         user_id AS card_id, user_id, ts AS timestamp, value AS amount,
         event_type = 'error' AS declined
  FROM events)"""

CO = """co AS (
  SELECT c_custkey AS company_id, c_name AS company_name,
         '+' || c_nationkey || ' ' || c_custkey AS phone, c_custkey || '@example.com' AS email,
         n_name AS country, c_mktsegment AS website
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

RAW = """raw AS (
  SELECT o_orderkey AS id, o_custkey, o_orderdate, o_totalprice, o_orderstatus, o_orderpriority,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN o_custkey || ', ' || (o_orderkey % 3) || ', ' || o_orderkey
      WHEN '2-HIGH' THEN ' ' || o_custkey || ' ,  ' || (o_orderkey % 3)
      WHEN '3-MEDIUM' THEN CAST(o_custkey AS VARCHAR)
      WHEN '4-NOT SPECIFIED' THEN (o_orderkey % 3) || ',n/a,' || o_custkey
      ELSE CASE WHEN o_orderstatus <> 'P' THEN '' END END AS product_ids
  FROM orders)"""

ITEMS = f"""{RAW}, items AS (
  SELECT id, o_orderstatus, item FROM (
    SELECT id, o_orderstatus,
           TRY_CAST(trim(unnest(string_split(product_ids, ','))) AS BIGINT) AS item FROM raw)
  WHERE item IS NOT NULL)"""

LISTS = """lists AS (
  SELECT id, array_to_string([TRY_CAST(trim(x) AS BIGINT) FOR x IN string_split(product_ids, ',')
      IF TRY_CAST(trim(x) AS BIGINT) IS NOT NULL], ',') AS product_ids
  FROM raw)"""

CLEAN = """SELECT raw.id AS transaction_id, o_custkey AS business_id, o_custkey AS card_id,
  o_orderdate AS timestamp,
  CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS amount,
  o_orderstatus = 'F' AS declined, coalesce(lists.product_ids, '') AS product_ids,
  o_custkey AS user_id, (o_custkey % 90) + 0.25::DOUBLE AS lat,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey % 180 AS DOUBLE) END AS longitude
  FROM raw JOIN lists USING (id)"""

RANKING = f"""WITH {ITEMS},
  sold AS (SELECT item, count(*) AS n FROM items WHERE o_orderstatus <> 'F' GROUP BY item)
  SELECT p_partkey AS product_id, p_name AS name, p_retailprice AS price,
         coalesce(n, 0) AS total_sold, p_type AS colour
  FROM part LEFT JOIN sold ON p_partkey = item"""

STAGED_USERS = """su AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS surname, '+' || c_custkey AS phone,
         c_custkey || '@example.com' AS email,
         CAST(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT) AS DATE) AS birth,
         n_name AS country, n_regionkey,
         CAST(DATE '2015-01-01' + CAST(c_custkey % 3000 AS INT) AS DATE) AS signup,
         c_mktsegment AS segment, c_nationkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

EXPIRY = "CAST(DATE '1975-01-01' + CAST(c_custkey % 20000 AS INT) AS DATE)"

DIM_CARD = f"""SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS INT) AS user_id,
  'IBAN' || (c_custkey // 2) AS iban, {EXPIRY} AS expiring_date,
  CASE WHEN c_custkey % 2 = 0 THEN 'debit' ELSE 'credit' END AS card_type,
  c_custkey % 3 = 0 AS card_renewal_flag
  FROM customer"""

DAILY = f"""daily AS (
  SELECT CAST(timestamp AS DATE) AS day, sum({_CENTS.format('amount')}) AS cents
  FROM tx WHERE NOT declined GROUP BY 1)"""

REDATED = f"""{TX}, redated AS (
  SELECT transaction_id, business_id, card_id, user_id, amount, declined,
         TIMESTAMP '2024-03-01 00:00:00' - to_days(CAST(round(
           ((transaction_id * 7919) % 10007) / 10007.0::DOUBLE * 50) AS INT)) AS timestamp
  FROM tx)"""

RECENT = f"""WITH {REDATED}
  SELECT * FROM redated WHERE timestamp >= TIMESTAMP '2024-01-31 00:00:00'"""

STATUS = f"""{TX}, last3 AS (
  SELECT card_id, declined, row_number() OVER (
    PARTITION BY card_id ORDER BY timestamp DESC, transaction_id DESC) AS rn FROM tx),
  status AS (
  SELECT card_id, CAST(sum(CAST(declined AS INT)) AS BIGINT) AS n_declined FROM last3
  WHERE rn <= 3 GROUP BY card_id)"""

KPIS = f"""{TX}, {CO}, kpi AS (
  SELECT company_id AS id, company_name AS company, phone, country,
         {_mean('amount')} AS avg_amount,
         CASE WHEN sum({_CENTS.format('amount')}) > 26000000 * count(amount)
              THEN 'Premium' ELSE 'Standard' END AS type
  FROM co JOIN tx ON company_id = business_id WHERE NOT declined
  GROUP BY company_id, company_name, phone, country)"""

# The texts of messages, levels and bands below, as in plans/candidates.py.
CAND = """cand AS (
  SELECT c_custkey AS seq, c_nationkey AS n,
    CASE c_nationkey WHEN 0 THEN '  ' WHEN 1 THEN c_name ELSE ' ' || c_mktsegment END AS name,
    CASE c_nationkey WHEN 2 THEN '123' WHEN 3 THEN '600 00000' WHEN 4 THEN '60000000x'
      WHEN 5 THEN '' ELSE lpad(CAST(c_custkey AS VARCHAR), 9, '6') END AS phone,
    CAST(c_custkey % 60 AS VARCHAR) AS experience, CAST(c_custkey % 5 AS VARCHAR) AS catalan,
    CASE c_nationkey WHEN 6 THEN '1.0' ELSE CAST(c_custkey % 4 AS VARCHAR) END AS excel,
    CAST((c_custkey // 7) % 4 AS VARCHAR) AS degree
  FROM customer),
  verdict AS (
  SELECT *, CASE
    WHEN n = 0 THEN ['name', name, 'el nombre no puede estar vacío.']
    WHEN n = 1 THEN ['name', name, 'el nombre no puede contener números ni símbolos.']
    WHEN n = 2 THEN ['phone', phone,
      'el formato del teléfono es incorrecto (debe tener 9 dígitos).']
    WHEN n = 3 THEN ['phone', phone, 'el teléfono no puede contener espacios en blanco.']
    WHEN n = 4 THEN ['phone', phone, 'el teléfono debe contener solo números.']
    WHEN n = 5 THEN ['phone', phone, 'el teléfono no puede estar vacío.']
    WHEN CAST(experience AS INT) > 50
      THEN ['experience', experience, 'la experiencia debe estar entre 0 y 50 años.']
    WHEN catalan = '4' THEN ['catalan', catalan, 'debes escribir una opción entre 0 y 3.']
    WHEN n = 6 THEN ['excel', excel, 'debes escribir un número entero.']
    END AS bad
  FROM cand),
  ok AS (
  SELECT seq, trim(name) AS name, CAST(phone AS BIGINT) AS phone,
    CAST(experience AS BIGINT) AS experience, CAST(catalan AS BIGINT) AS catalan,
    CAST(excel AS BIGINT) AS excel, CAST(degree AS BIGINT) AS degree,
    ['sense coneixement', 'fins a nivell B1', 'nivell B2', 'C1 o superior']
      [CAST(catalan AS INT) + 1] AS catalan_level,
    ['nivell basic', 'ús de funcions', 'taules dinàmiques', 'Visual Basic i Macros']
      [CAST(excel AS INT) + 1] AS excel_level,
    ['ESO', 'FP', 'Universitat', 'Master o superior'][CAST(degree AS INT) + 1] AS degree_level,
    CAST(experience AS INT) * 1.5::DOUBLE + CAST(catalan AS INT) + CAST(excel AS INT)
      + CAST(degree AS INT) AS score
  FROM verdict WHERE bad IS NULL),
  banded AS (
  SELECT *, CASE WHEN score >= 12 THEN 'Prioritat alta' WHEN score >= 8
    THEN 'Candidat adequat' ELSE 'No prioritari' END AS band FROM ok),
  rejects AS (
  SELECT seq, name AS candidate, bad[1] AS field, bad[2] AS value, bad[3] AS reason
  FROM verdict WHERE bad IS NOT NULL)"""

# The products of the fixed factors, each rounded as Python does.
_RISKS = "CASE " + " ".join(
    f"WHEN code = {code} AND age_group = '{group}' THEN {round(factor * of_age, 3)!r}::DOUBLE"
    for code, factor in enumerate([0.10, 0.25, 0.50, 0.75, 0.90])
    for group, of_age in [("18-25", 1.20), ("26-40", 1.00), ("41-60", 0.85), ("60+", 0.70)]
) + " END"

# The texts and factors below, as in plans/scoring.py.
RISK = f"""risks AS (
  SELECT c_custkey AS client_id, c_name AS name, 18 + c_custkey % 60 AS age,
    CASE WHEN c_custkey % 60 <= 7 THEN '18-25' WHEN c_custkey % 60 <= 22 THEN '26-40'
         WHEN c_custkey % 60 <= 42 THEN '41-60' ELSE '60+' END AS age_group,
    c_custkey % 5 AS code,
    ['Navega pero no añade productos', 'Agrega productos pero no llega al checkout',
     'Llega al checkout pero no paga', 'Cesta de compra abandonado (<24h)',
     'Cesta de compra abandonado (>24h)'][c_custkey % 5 + 1] AS segment,
    ['Descubre las ultimas novedades exclusivas de la semana.',
     'Tus artículos en cesta te esperan.',
     'Completa tu pedido ahora y disfruta de envío gratuito.',
     '¡Date prisa! Tu cesta de la compra caducará muy pronto.',
     'Te ofrecemos un cupon del 10% de descuento en tu cesta de compra']
     [c_custkey % 5 + 1] AS message,
    ([0.10, 0.25, 0.50, 0.75, 0.90]::DOUBLE[])[c_custkey % 5 + 1] AS code_factor,
    CASE WHEN c_custkey % 60 <= 7 THEN 1.2::DOUBLE WHEN c_custkey % 60 <= 22 THEN 1.0::DOUBLE
         WHEN c_custkey % 60 <= 42 THEN 0.85::DOUBLE ELSE 0.7::DOUBLE END AS age_factor
  FROM customer),
  scored AS (SELECT *, {_RISKS} AS risk FROM risks)"""

PRICED = """priced AS (
  SELECT c_custkey AS client_id, c_name AS name, 18 + c_custkey % 60 AS age,
    ['Baix risc', 'Risc mitjà', 'Risc alt', 'Risc crític'][c_custkey % 4 + 1] AS category,
    CAST([120, 200, 350, 500][c_custkey % 4 + 1] AS BIGINT) AS base_price,
    [120, 200, 350, 500][c_custkey % 4 + 1]
      * (1 + CAST(18 + c_custkey % 60 AS DOUBLE) / 100) AS final_price,
    ([0.01, 0.05, 0.15, 0.30]::DOUBLE[])[c_custkey % 4 + 1] AS fraud
  FROM customer)"""

LEAGUE = """WITH m AS (
  SELECT l_suppkey AS h, l_partkey % 100 AS a, CAST(l_linenumber AS INT) AS hg,
         CAST(l_quantity AS INT) % 5 AS ag FROM lineitem WHERE l_suppkey <> l_partkey % 100),
  sides AS (SELECT 'team ' || h AS team, hg AS f, ag AS g FROM m
            UNION ALL SELECT 'team ' || a, ag, hg FROM m)
  SELECT team, CAST(sum(f) AS BIGINT) AS goals_for, CAST(sum(g) AS BIGINT) AS goals_against,
    count(*) FILTER (WHERE f > g) AS won, count(*) FILTER (WHERE f = g) AS drawn,
    count(*) FILTER (WHERE f < g) AS lost,
    3 * count(*) FILTER (WHERE f > g) + count(*) FILTER (WHERE f = g) AS points,
    count(*) AS played
  FROM sides GROUP BY team"""

LINES = """lines AS (
  SELECT p_name || ' ' || p_partkey AS name, p_size, upper(replace(p_name, ' ', ' , ')) AS words
  FROM part)"""

SUB = """sub AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_suppkey AS user_id, l_shipdate AS timestamp,
         l_extendedprice * l_discount / 1000 AS amount, l_returnflag = 'R' AS declined,
         CAST(round(l_extendedprice * l_discount / 1000 * 1000000) AS BIGINT) AS units
  FROM lineitem)"""

# Sums and means of millionths, rounded half up once.
_SUB_SUM = "CAST((CAST(sum(units) AS HUGEINT) + 5000) // 10000 AS DOUBLE) / 100.0"
_SUB_MEAN = "CAST((2 * CAST(sum(units) AS HUGEINT) + 10000 * count(*)) // (20000 * count(*)) AS DOUBLE) / 100.0"

_TEN = "(SELECT max(seq) FROM (SELECT seq FROM ok ORDER BY seq LIMIT 10))"


def all_oracles() -> dict[str, str]:
    return {
        "p01_selling_countries": f"""WITH {TX}, {CO}
            SELECT DISTINCT country FROM co JOIN tx ON company_id = business_id
            WHERE NOT declined AND amount >= 0""",
        "p02_n_countries": f"""WITH {TX}, {CO}
            SELECT count(DISTINCT country) AS n_countries
            FROM co JOIN tx ON company_id = business_id WHERE NOT declined AND amount >= 0""",
        "p03_top_company": f"""WITH {TX}, {CO}, g AS (
              SELECT company_id, company_name AS company, {_mean('amount')} AS avg_sale
              FROM co JOIN tx ON company_id = business_id WHERE NOT declined GROUP BY 1, 2)
            SELECT company, avg_sale FROM g ORDER BY avg_sale DESC, company_id LIMIT 1""",
        "p04_country_tx_semi": f"""WITH {TX}, {CO} SELECT * FROM tx
            WHERE EXISTS (SELECT 1 FROM co WHERE country = 'NATION_7' AND NOT declined
                          AND company_id = business_id)""",
        "p05_above_avg": f"""WITH {TX}, {CO}, avgs AS (
              SELECT sum({_CENTS.format('amount')}) AS s, count(*) AS n FROM tx WHERE NOT declined),
            g AS (SELECT business_id, {_mean('amount')} AS avg_sale FROM tx, avgs
              WHERE NOT declined AND {_CENTS.format('amount')} * n > s GROUP BY 1)
            SELECT (SELECT company_name FROM co WHERE company_id = business_id) AS company,
                   avg_sale FROM g""",
        "p06_global_avg": f"""WITH {TX} SELECT {_mean('amount')} AS avg_sale
            FROM tx WHERE NOT declined""",
        "p07_no_tx_anti": f"""WITH {TX}, {CO} SELECT company_name AS company FROM co
            WHERE company_id NOT IN (SELECT business_id FROM tx WHERE declined)""",
        "p08_star_load": """SELECT CAST(event_id AS VARCHAR) AS id, props->>'$.k' AS company_id,
            CAST(user_id AS VARCHAR) AS card_id, CAST(user_id AS INT) AS user_id,
            props->>'$.k' AS product_ids, CAST(ts AS DATE) AS tr_date,
            strftime(ts, '%H:%M:%S') AS tr_time, value AS amount,
            event_type = 'error' AS declined,
            CAST(CAST(CAST(value AS DECIMAL(10,2)) * CAST('0.0123457' AS DECIMAL(8,7))
              AS DECIMAL(10,6)) AS DOUBLE) AS lat,
            CAST(-CAST(CAST(value AS DECIMAL(10,2)) * CAST('0.0123457' AS DECIMAL(8,7))
              AS DECIMAL(10,6)) AS DOUBLE) AS longitude,
            event_type AS channel,
            CASE WHEN event_type = 'error' THEN 'error' END AS decline_reason FROM events""",
        "p08_dim_users": f"""WITH {STAGED_USERS} SELECT CAST(id AS INT) AS id, name, surname,
            birth AS birth_date, country, signup AS signup_date, segment AS user_segment
            FROM su""",
        "p08_dim_companies": f"""WITH {CO} SELECT CAST(company_id AS VARCHAR) AS id,
            company_name, phone, email, country, website, website AS merchant_category,
            country AS merchant_price_position FROM co""",
        "p08_dim_credit_card": DIM_CARD,
        "p08_dim_products": """SELECT CAST(p_partkey AS INT) AS id, p_name AS product_name,
            p_retailprice AS price, p_type AS colour, CAST(p_size AS DOUBLE) AS weight,
            replace(p_brand, 'Brand#', 'WH-') AS warehouse_id,
            p_size + 0.5::DOUBLE AS cost,
            CAST(DATE '2014-01-01' + p_size AS DATE) AS launch_date FROM part""",
        "p09_heavy_users": f"""WITH {EV} SELECT
            (SELECT c_name FROM customer WHERE c_custkey = user_id) AS "user",
            count(*) AS n_transactions FROM ev GROUP BY user_id HAVING count(*) > 80""",
        "p10_avg_per_account": f"""WITH {EV} SELECT 'IBAN' || (c_custkey // 2) AS iban,
            {_mean('amount')} AS avg_amount
            FROM ev JOIN customer ON card_id = c_custkey
            JOIN supplier ON business_id = s_suppkey
            WHERE s_name = 'Supplier#000000007' AND NOT declined GROUP BY 1""",
        "p11_top_days": f"""WITH {TX} SELECT CAST(timestamp AS DATE) AS day,
            {_sum('amount')} AS revenue FROM tx WHERE NOT declined GROUP BY 1
            ORDER BY revenue DESC, day LIMIT 5""",
        "p11y_top_days_year": f"""WITH {TX} SELECT CAST(timestamp AS DATE) AS day,
            {_sum('amount')} AS revenue FROM tx
            WHERE NOT declined AND year(timestamp) = 1997 GROUP BY 1
            ORDER BY revenue DESC, day LIMIT 5""",
        "p12_range_dates": f"""WITH {TX}, {CO} SELECT company_name AS company, phone, country,
            CAST(timestamp AS DATE) AS day, amount
            FROM tx JOIN co ON company_id = business_id
            WHERE NOT declined AND amount BETWEEN 100000 AND 200000 AND CAST(timestamp AS DATE)
              IN (DATE '1995-04-29', DATE '1998-07-20', DATE '2000-03-13')""",
        "p13_volume_band": f"""WITH {TX}, {CO} SELECT company_name AS company,
            count(*) AS n_transactions,
            CASE WHEN count(*) >= 10 THEN '>= 10' ELSE '< 10' END AS band
            FROM tx JOIN co ON company_id = business_id GROUP BY company_id, company_name""",
        "p13_volume_band_strict": f"""WITH {TX}, {CO} SELECT company_name AS company,
            count(*) AS n_transactions,
            CASE WHEN count(*) > 10 THEN '>= 10' ELSE '< 10' END AS band
            FROM tx JOIN co ON company_id = business_id GROUP BY company_id, company_name""",
        "p14_marketing_kpis": f"WITH {KPIS} SELECT * FROM kpi",
        "p14v_marketing_view_sql": f"""WITH {KPIS}
            SELECT company, phone, country, avg_amount FROM kpi""",
        "p15_card_status": f"""WITH {STATUS} SELECT card_id,
            CASE WHEN n_declined = 3 THEN 'inactive' ELSE 'active' END AS status, n_declined
            FROM status""",
        "p15c_active_count": f"""WITH {STATUS}
            SELECT count(*) AS n_active FROM status WHERE n_declined <> 3""",
        "p16_bridge": f"""WITH {ITEMS} SELECT id AS transaction_id, item AS product_id
            FROM items JOIN raw USING (id) WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
        "p16_malformed_lists": f"""WITH {RAW} SELECT id AS transaction_id, product_ids FROM raw
            WHERE o_orderpriority = '4-NOT SPECIFIED'""",
        "p16_units_per_product": """SELECT l_partkey AS product_id, count(*) AS n_sales,
            p_name AS product FROM lineitem JOIN part ON p_partkey = l_partkey
            GROUP BY l_partkey, p_name""",
        "p17_products_clean": """SELECT p_partkey AS product_id, p_name AS name,
            CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS warehouse_id,
            p_retailprice AS price, p_type AS category, CAST(p_size AS DOUBLE) AS weight,
            p_brand AS brand, '$' || p_size || '.50' AS cost, p_type AS colour,
            CAST(DATE '2014-01-01' + p_size AS DATE) AS launch_date FROM part""",
        "p17_tx_clean": f"WITH {RAW}, {LISTS} {CLEAN}",
        "p17_users_combined": f"""WITH {STAGED_USERS} SELECT id AS user_id, name, surname, phone,
            email, strftime(birth, '%b ') || day(birth) || strftime(birth, ', %Y') AS birth_date,
            country, surname AS city, CAST(c_nationkey AS VARCHAR) AS postal_code,
            CASE r_name WHEN 'AMERICA' THEN 'American' ELSE 'Europe' END AS origin
            FROM su JOIN region ON n_regionkey = r_regionkey
            WHERE r_name IN ('AMERICA', 'EUROPE')""",
        "p17_companies_clean": f"""WITH {CO} SELECT CAST(company_id AS VARCHAR) AS company_id,
            company_name, phone, email, country, website FROM co""",
        "p17_cards_clean": f"""SELECT CAST(c_custkey AS VARCHAR) AS card_id, c_custkey AS user_id,
            'IBAN' || (c_custkey // 2) AS iban, strftime({EXPIRY}, '%m/%d/%y') AS expiring_date
            FROM customer""",
        "p18_sales_ranking": RANKING,
        "p19_country_day": f"""WITH {TX}, {CO} SELECT * FROM co JOIN tx
            ON company_id = business_id
            WHERE country = 'NATION_7' AND CAST(timestamp AS DATE) = DATE '1997-05-28'""",
        "p20_recent_30d": RECENT,
        "snk4_partitioned_fact": RECENT,
        "p21_daily_sales": f"""WITH {TX}, {DAILY}
            SELECT day, CAST(cents AS DOUBLE) / 100.0 AS sales FROM daily""",
        "vw3_daily_table": f"""WITH {EV} SELECT CAST(timestamp AS DATE) AS day,
            {_sum('amount')} AS sales FROM ev WHERE NOT declined GROUP BY 1""",
        "p22_vip": f"""WITH {TX}, g AS (
              SELECT user_id, count(*) AS n_purchases, {_mean('amount')} AS avg_ticket,
                     max(amount) AS max_purchase, {_sum('amount')} AS total_spent
              FROM tx WHERE NOT declined GROUP BY user_id
              HAVING sum({_CENTS.format('amount')}) > 250000000)
            SELECT user_id, c_name || ' ' || c_mktsegment AS full_name,
                   c_custkey || '@example.com' AS email, n_purchases, avg_ticket, max_purchase,
                   total_spent FROM g JOIN customer ON user_id = c_custkey""",
        "p23_day_over_day": f"""WITH {TX}, {DAILY}, s AS (
              SELECT day, CAST(cents AS DOUBLE) / 100.0 AS today,
                     lag(CAST(cents AS DOUBLE) / 100.0) OVER (ORDER BY day) AS yesterday
              FROM daily)
            SELECT *, round(CASE WHEN yesterday <> 0
              THEN (today - yesterday) / yesterday END * 100, 2) + 0.0 AS diff_pct FROM s""",
        "p24_ytd": f"""WITH {TX}, {DAILY} SELECT day, CAST(cents AS DOUBLE) / 100.0 AS today,
            CAST(sum(cents) OVER (PARTITION BY year(day) ORDER BY day
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100.0 AS ytd
            FROM daily""",
        "p25_third_purchase": f"""WITH {TX}, o AS (
              SELECT *, row_number() OVER (PARTITION BY user_id
                ORDER BY timestamp, transaction_id) AS rn FROM tx WHERE NOT declined),
            m AS (SELECT user_id, {_mean('amount')} AS avg_first FROM o WHERE rn <= 3 GROUP BY 1)
            SELECT o.user_id, c_name || ' ' || c_mktsegment AS full_name,
                   c_custkey || '@example.com' AS email, CAST(timestamp AS DATE) AS nth_day,
                   amount AS nth_amount, avg_first
            FROM o JOIN m ON o.user_id = m.user_id JOIN customer ON o.user_id = c_custkey
            WHERE rn = 3""",
        "p26_flat_tax": f"""WITH {ITEMS}, {LISTS}, clean AS ({CLEAN})
            SELECT clean.*, p_partkey AS product_sku, p_name AS product_name,
                   p_retailprice AS product_price,
                   CAST(CAST(p_retailprice AS DECIMAL(10,2))
                     + round(CAST(p_retailprice AS DECIMAL(10,2)) * CAST('0.21' AS DECIMAL(2,2)), 2)
                     AS DOUBLE) AS product_price_tax_inc
            FROM clean JOIN items ON transaction_id = items.id
            LEFT JOIN part ON p_partkey = item""",
        "p27_top_products": f"""WITH {ITEMS} SELECT p_name AS product, count(*) AS units
            FROM items LEFT JOIN part ON p_partkey = item GROUP BY p_partkey, p_name
            ORDER BY units DESC, p_partkey NULLS LAST LIMIT 5""",
        "p28_candidates_ok": f"WITH {CAND} SELECT * FROM banded",
        "p28_candidates_rejects": f"WITH {CAND} SELECT * FROM rejects",
        "p28_report": f"""WITH {CAND} SELECT row_number() OVER (ORDER BY
              CASE band WHEN 'Prioritat alta' THEN 3 WHEN 'Candidat adequat' THEN 2 ELSE 1 END DESC,
              score DESC, name DESC, phone DESC, experience DESC, catalan_level DESC,
              excel_level DESC, degree_level DESC, seq) AS position, name, phone, score, band
            FROM banded""",
        "p28_first_ten": f"""WITH {CAND} SELECT seq, name, phone, score, band FROM banded
            ORDER BY seq LIMIT 10""",
        "p28_first_ten_rejects": f"WITH {CAND} SELECT * FROM rejects WHERE seq < {_TEN}",
        "p28_last_candidate": f"""WITH {CAND} SELECT seq, name, phone, score, band FROM banded
            ORDER BY seq DESC LIMIT 1""",
        "p28_nth_candidate": f"""WITH {CAND} SELECT seq, name, phone, score, band FROM banded
            ORDER BY seq LIMIT 1 OFFSET 6""",
        "src9_chunk_records": f"""WITH {CAND}
            SELECT seq, name, phone, experience, catalan, excel, degree FROM cand""",
        "p29_risk": f"WITH {RISK} SELECT * FROM scored",
        "p29_contact_first": f"""WITH {RISK} SELECT name, segment, risk FROM scored
            ORDER BY risk DESC, client_id LIMIT 4""",
        "p29_low_interest": f"WITH {RISK} SELECT client_id, name FROM scored WHERE risk < 0.20",
        "p29_most_profitable": f"""WITH {RISK} SELECT name, risk FROM scored
            ORDER BY risk DESC, client_id LIMIT 1""",
        "p30_triage": """SELECT p_name || ' ' || p_partkey AS name, CAST(p_size AS BIGINT) AS age,
            replace(p_name, ' ', ',') AS symptoms,
            CAST(list_sum([
              CASE w WHEN 'hot' THEN 3 WHEN 'red' THEN 5 WHEN 'large' THEN 4 WHEN 'cold' THEN 1
                WHEN 'old' THEN 1 WHEN 'bolt' THEN 2 WHEN 'gear' THEN 1 ELSE 0 END
              FOR w IN string_split(p_name, ' ')]) AS BIGINT) AS risk FROM part""",
        "p31_insurance": f"WITH {PRICED} SELECT * FROM priced",
        "p31_findings": f"""WITH {PRICED}, f AS (
              SELECT * FROM priced ORDER BY fraud DESC, final_price DESC, client_id LIMIT 1),
            h AS (SELECT * FROM priced ORDER BY final_price DESC, client_id LIMIT 1)
            SELECT 'max_fraud' AS finding, name, printf('%.0f%%', fraud * 100) AS shown FROM f
            UNION ALL SELECT 'top_price', name, printf('%.2f €', final_price) FROM f
            UNION ALL SELECT 'manual_review', name, category FROM f
            UNION ALL SELECT 'highest_price', name, printf('%.2f €', final_price) FROM h""",
        "p32_league": LEAGUE,
        "src7_tsv_league": LEAGUE,
        "p33_update": """SELECT c_custkey AS card_id, CASE WHEN c_custkey = 42
            THEN 'IBAN-corrected' ELSE 'IBAN' || (c_custkey // 2) END AS iban FROM customer""",
        "p33_retype_date": f"""SELECT CAST(c_custkey AS VARCHAR) AS id,
            {EXPIRY} AS expiring_date FROM customer""",
        "p33_insert": f"""WITH {TX} SELECT * FROM tx UNION ALL
            SELECT -9999, NULL, NULL, 9999, NULL, 111.11, false""",
        "p33_delete": f"WITH {TX} SELECT * FROM tx WHERE transaction_id <> 7",
        "p33_drop_column": """SELECT c_custkey, c_name, c_nationkey, c_mktsegment
            FROM customer""",
        "p34_docs_json": """SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k
            FROM events""",
        "dml_rewrite_table": f"""WITH {EV} SELECT transaction_id, business_id, card_id, user_id,
            timestamp, CASE WHEN day(timestamp) = 7 AND user_id = 7 THEN 0.0 ELSE amount END
            AS amount, declined, CAST(timestamp AS DATE) AS tr_date FROM ev
            WHERE day(timestamp) <> 3 AND NOT (day(timestamp) = 5 AND declined)""",
        "udf1_tax_sql": """SELECT p_partkey,
            floor(p_retailprice * 0.21::DOUBLE * 100 + 0.5) / 100 AS tax,
            floor(p_retailprice * 0.21::DOUBLE + 0.5) AS whole_tax FROM part""",
        "src2_flags_01": """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS card_id,
            props->>'$.k' AS company_id, value AS amount, event_type = 'error' AS declined FROM events""",
        "src4_flags_01": f"WITH {RAW}, {LISTS} {CLEAN}",
        "load_star_rejects": f"""WITH {RAW} SELECT CAST(id AS VARCHAR) AS transaction_id, product_ids FROM raw
            WHERE o_orderpriority = '4-NOT SPECIFIED'""",
        "src10_records": """SELECT r_regionkey, r_name, CASE WHEN r_name = 'ASIA' THEN 'x' END AS note
            FROM region WHERE r_name IN ('ASIA', 'EUROPE')""",
        "src11_external_table": "SELECT c_custkey, c_name, c_nationkey FROM customer",
        "srt7_preview": """SELECT 'preview' AS table_name, least(10, count(*)) AS n_rows,
            CAST(10 AS BIGINT) AS n_expected, count(*) >= 10 AS ok FROM orders""",
        "dml8_namespace": "SELECT * FROM nation",
        "dml_move_partition": f"""WITH {EV} SELECT transaction_id, business_id, card_id, user_id,
            CASE WHEN day(timestamp) = 7 AND user_id % 10 = 7 THEN timestamp + INTERVAL 1 DAY
                 ELSE timestamp END AS timestamp, amount, declined,
            CAST(CASE WHEN day(timestamp) = 7 AND user_id % 10 = 7 THEN timestamp + INTERVAL 1 DAY
                 ELSE timestamp END AS DATE) AS tr_date FROM ev""",
        "dml_delete_null_day": f"""WITH {EV}, lost AS (
              SELECT * REPLACE (CASE WHEN user_id % 10 <> 3 THEN timestamp END AS timestamp) FROM ev)
            SELECT *, CAST(timestamp AS DATE) AS tr_date FROM lost
            WHERE timestamp IS NOT NULL OR NOT declined""",
        "dml_insert_checked": """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'CcU-' || o_custkey AS credit_card_id,
              CAST(o_custkey AS VARCHAR) AS company_id, o_totalprice AS amount, o_orderstatus = 'F' AS declined FROM orders
            UNION ALL SELECT '108B1D1D', 'CcU-none', 'b-9999', 111.11, false""",
        "dml_stored_columns": """SELECT 'CcU-' || c_custkey AS id, c_mktsegment AS iban, DATE '2022-10-30' AS expiring_date
            FROM customer""",
        "dml_delete_text_partition": """SELECT o_orderkey, o_totalprice,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'it''s x=y' WHEN o_totalprice < 100000 THEN 'new/one' ELSE '01' END AS k
            FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')""",
        "vw3_null_day": f"""WITH {EV} SELECT CASE WHEN user_id % 10 <> 3 THEN CAST(timestamp AS DATE) END AS day,
            {_sum('amount')} AS sales FROM ev
            WHERE NOT declined AND (user_id % 10 <> 3 OR transaction_id % 3 <> 0) GROUP BY 1""",
        "p06_large_decimals": """SELECT l_returnflag, CAST(CAST(sum(CAST(CAST(l_orderkey AS DECIMAL(18,0)) * 1000000007 AS DECIMAL(38,2))
              + CAST(CAST(l_linenumber AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2))) AS DECIMAL(34,6)) AS VARCHAR) AS total,
            count(*) AS n FROM lineitem GROUP BY l_returnflag""",
        "vw3_after_delete": f"""WITH {EV} SELECT CAST(timestamp AS DATE) AS day,
            {_sum('amount')} AS sales FROM ev WHERE NOT declined AND day(timestamp) <> 3 GROUP BY 1""",
        "p21_subcent_days": f"""WITH {SUB} SELECT CAST(timestamp AS DATE) AS day, {_SUB_SUM} AS sales
            FROM sub WHERE NOT declined GROUP BY 1""",
        "p06_subcent_mean": f"""WITH {SUB} SELECT {_SUB_MEAN} AS avg_sale, {_SUB_SUM} AS total_sale
            FROM sub WHERE NOT declined""",
        "p22_subcent_vip": f"""WITH {SUB}, g AS (
              SELECT user_id, count(*) AS n_purchases, {_SUB_MEAN} AS avg_ticket,
                     max(amount) AS max_purchase, {_SUB_SUM} AS total_spent
              FROM sub WHERE NOT declined GROUP BY user_id HAVING sum(units) > 100000000)
            SELECT user_id, s_name || ' Ltd' AS full_name, s_suppkey || '@example.com' AS email,
                   n_purchases, avg_ticket, max_purchase, total_spent
            FROM g JOIN supplier ON user_id = s_suppkey""",
        "p16_units_from_text": f"""WITH {ITEMS} SELECT item AS product_id, count(*) AS n_sales,
            p_name AS product FROM items JOIN raw USING (id) JOIN part ON p_partkey = item
            WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY item, p_name""",
        "p18_ranking_from_lines": """WITH n AS (
              SELECT l_partkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              WHERE o_orderstatus <> 'F' GROUP BY l_partkey)
            SELECT p_partkey AS product_id, p_name AS name, p_retailprice AS price,
                   coalesce(n, 0) AS total_sold, p_type AS colour
            FROM part LEFT JOIN n ON p_partkey = l_partkey""",
        "p20_recent_random": """SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_transactions,
            true AS none_before, true AS none_after, true AS recent_share_as_expected,
            CAST(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS DOUBLE) AS amounts,
            'amount,business_id,card_id,declined,timestamp,transaction_id,user_id' AS columns FROM orders""",
        "flt2_point_lookup": f"WITH {TX} SELECT * FROM tx WHERE transaction_id = 7",
        "dq1_pk": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
            GROUP BY ALL HAVING count(*) > 1""",
        "dq2_composite_pk": """SELECT l_orderkey AS transaction_id, l_partkey AS product_id,
            count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
        "dq2_deduped_bridge": """SELECT DISTINCT l_orderkey AS transaction_id,
            l_partkey AS product_id FROM lineitem""",
        "dq3_fk": f"""WITH {ITEMS} SELECT item AS product_id, count(*) AS n_rows FROM items
            WHERE item NOT IN (SELECT p_partkey FROM part) GROUP BY item""",
        "dq_key_report": f"""WITH {ITEMS}, bridge AS (
              SELECT id, item FROM items JOIN raw USING (id)
              WHERE o_orderpriority <> '4-NOT SPECIFIED'),
            rep AS (SELECT sum(n - 1) AS n FROM (
              SELECT count(*) AS n FROM bridge GROUP BY id, item))
            SELECT t AS table_name, 'repeated' AS "check", k AS key, CAST(0 AS BIGINT) AS n_bad
            FROM (VALUES ('dim_users', 'id'), ('dim_companies', 'id'), ('dim_credit_card', 'id'),
              ('dim_products', 'id'), ('fact_transactions', 'id')) v(t, k)
            UNION ALL SELECT 'transaction_products', 'repeated', 'transaction_id, product_id',
              CAST(n AS BIGINT) FROM rep
            UNION ALL SELECT t, 'missing', k, 0
            FROM (VALUES ('dim_users', 'id'), ('dim_companies', 'id'), ('dim_credit_card', 'id'),
              ('dim_products', 'id'), ('fact_transactions', 'id'),
              ('transaction_products', 'transaction_id, product_id')) v(t, k)
            UNION ALL SELECT 'fact_transactions', 'not in dim_companies', 'company_id', count(*)
              FROM events WHERE CAST(props->>'$.k' AS BIGINT) NOT IN (SELECT c_custkey FROM customer)
            UNION ALL SELECT 'fact_transactions', 'not in dim_credit_card', 'card_id', count(*)
              FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)
            UNION ALL SELECT 'fact_transactions', 'not in dim_users', 'user_id', count(*)
              FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)
            UNION ALL SELECT 'transaction_products', 'not in fact_transactions', 'transaction_id',
              count(*) FROM bridge WHERE id NOT IN (SELECT event_id FROM events)
            UNION ALL SELECT 'transaction_products', 'not in dim_products', 'product_id', count(*)
              FROM bridge WHERE item NOT IN (SELECT p_partkey FROM part)""",
        "dq4_row_count": """SELECT 'orders' AS table_name, count(*) AS n_rows,
              count(*) AS n_expected, true AS ok FROM orders
            UNION ALL SELECT 'lineitem', count(*), count(*), true FROM lineitem
            UNION ALL SELECT 'customer', count(*), count(*), true FROM customer""",
        "src1_csv_load": DIM_CARD,
        "src2_csv_semicolon": """SELECT CAST(event_id AS VARCHAR) AS id,
            CAST(user_id AS VARCHAR) AS card_id, props->>'$.k' AS business_id,
            strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, value AS amount,
            event_type = 'error' AS declined, CAST(user_id AS INT) AS user_id FROM events""",
        "src3_two_files": f"""WITH {STAGED_USERS} SELECT CAST(id AS INT) AS id, name,
            birth AS birth_date, country, signup AS signup_date
            FROM su JOIN region ON n_regionkey = r_regionkey
            WHERE r_name IN ('AMERICA', 'EUROPE')""",
        "src4_csv_inferred": "SELECT * FROM part",
        "src5_csv_declared": f"""WITH {CO} SELECT CAST(company_id AS VARCHAR) AS company_id,
            company_name, phone, email, country, website FROM co""",
        "src1_lines_kept": """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
            WHERE c_custkey % 7 NOT IN (1, 2, 3)""",
        "src1_rejected_lines": """SELECT CASE c_custkey % 7 WHEN 1 THEN c_custkey || ',' || c_name
              WHEN 2 THEN c_custkey || ',' || c_name || ',' || c_nationkey || ',more'
              ELSE 'none,' || c_name || ',' || c_nationkey END AS line
            FROM customer WHERE c_custkey % 7 IN (1, 2, 3)""",
        "src4_external_inferred": """SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_day, o_orderstatus,
            o_custkey * 10000000000 AS o_long, 'int, double, date, string, bigint' AS kinds FROM orders""",
        "src6_json_documents": """SELECT 'id' || c_custkey AS session_id, c_name AS user_id
            FROM customer""",
        "src8_pipe_lines": f"""WITH {LINES} SELECT name, CAST(p_size AS VARCHAR) AS age_text,
            words AS symptom_text FROM lines""",
        "snk1_create_table": f"WITH {RAW}, {LISTS} {CLEAN}",
        "snk2_native_copy": "SELECT o_orderkey AS id FROM orders",
        "snk3_insert_select": f"""WITH {STATUS} SELECT CAST(card_id AS VARCHAR) AS card_id,
            CASE WHEN n_declined = 3 THEN 'inactive' ELSE 'active' END AS status FROM status""",
        "snk5_ranking_export": RANKING,
    }
