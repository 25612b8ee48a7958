"""SQL for the queries of ``model_queries``."""

from __future__ import annotations

from quayside.oracle import AS_OF, CHURN, DEMAND, ORACLE as TABLE_ORACLE, SCORE, STOCKOUT, TABLE_VIEWS, with_ctes


def bin_of(column: str, *edges: int) -> str:
    return " + ".join(f"CAST({column} >= {e} AS BIGINT)" for e in edges)


# (1/2 - y) and 1/4, times the weight of a row and the scale of four
HISTOGRAM = f"""{STOCKOUT},
cells AS (SELECT CASE WHEN demanded >= 30 THEN 3 ELSE 2 END AS node, CASE WHEN is_stockout = 1 THEN 3 ELSE 1 END AS w,
    2 - 4 * is_stockout AS slope, [{bin_of("produced", 20, 50, 100)}, {bin_of("demanded", 10, 30, 60)}, {bin_of("gap", -20, 0, 40)}] AS bins
    FROM stockout_features),
histogram AS (SELECT CAST(node AS BIGINT) AS node, CAST(f AS BIGINT) AS feature, CAST(bins[f + 1] AS BIGINT) AS bin,
    CAST(SUM(w * slope) AS BIGINT) AS g, CAST(SUM(w) AS BIGINT) AS h FROM cells, RANGE(3) AS r(f) GROUP BY ALL)"""

CUTS = f"""{HISTOGRAM},
sides AS (SELECT node, feature, bin, COALESCE(SUM(g) OVER below, 0) / 4.0 AS gl, COALESCE(SUM(h) OVER below, 0) / 4.0 AS hl,
    SUM(g) OVER (PARTITION BY node, feature) / 4.0 AS gt, SUM(h) OVER (PARTITION BY node, feature) / 4.0 AS ht FROM histogram
    WINDOW below AS (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
numbers AS (SELECT node, feature, bin, CAST(gl AS DOUBLE) AS gl, CAST(hl AS DOUBLE) AS hl, CAST(gt AS DOUBLE) AS gt, CAST(ht AS DOUBLE) AS ht FROM sides),
gains AS (SELECT *, (gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1)) / 2 AS gain FROM numbers),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin) AS place FROM gains
    WHERE hl >= 1 AND ht - hl >= 1 AND gain > 0),
cuts AS (SELECT t.node, t.gt AS g, t.ht AS h, feature, bin AS cut, gain, gl AS g_left, hl AS h_left
    FROM (SELECT DISTINCT node, gt, ht FROM numbers) t LEFT JOIN ranked r ON t.node = r.node AND place = 1)"""

# balanced weights make both classes weigh the same
FLAG = f"""{CHURN},
flags AS (SELECT customer_id, churned, active_months >= 8 AS often FROM churn),
parts AS (SELECT often, CAST(SUM(churned) AS DOUBLE) / SUM(SUM(churned)) OVER () AS p,
    CAST(SUM(1 - churned) AS DOUBLE) / SUM(SUM(1 - churned)) OVER () AS n FROM flags GROUP BY often)"""


def flag_scores(digits: int) -> str:
    return with_ctes(
        f"""SELECT customer_id, ROUND(p / (p + n), {digits}) AS churn_probability,
        CAST(CASE WHEN p / (p + n) >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS label, {AS_OF} AS prediction_date
        FROM flags JOIN parts USING (often)""",
        FLAG,
    )


def early_step(k: str) -> str:
    return (
        f"CASE WHEN {k} <= 4 THEN CASE WHEN frequency >= 4 * {k} THEN -0.25 ELSE 0.25 END "
        f"ELSE CASE WHEN customer_id % {k} = 0 THEN 0.5 ELSE -0.25 END END"
    )


EARLY = f"""{CHURN},
margins AS (SELECT k AS prefix, churned, CAST(SUM({early_step("k")}) OVER (PARTITION BY customer_id ORDER BY k) AS DOUBLE) AS m
    FROM churn, RANGE(1, 9) AS r(k)),
buckets AS (SELECT prefix, LEAST(FLOOR(65536 / (1 + EXP(-m))), 65535) AS bucket, COUNT(*) FILTER (WHERE churned = 1) AS pos,
    COUNT(*) FILTER (WHERE churned = 0) AS neg FROM margins GROUP BY ALL),
below AS (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY prefix ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower FROM buckets),
areas AS (SELECT prefix, SUM(pos) AS positives, SUM(neg) AS negatives,
    CAST(SUM(pos * (2 * lower + neg)) AS DOUBLE) / NULLIF(2 * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE), 0) AS auc FROM below GROUP BY prefix),
bests AS (SELECT *, (SELECT MIN(b.prefix) FROM areas b WHERE b.prefix <= a.prefix
    AND b.auc = (SELECT MAX(c.auc) FROM areas c WHERE c.prefix <= a.prefix)) AS best FROM areas a)"""

TREES = """CASE WHEN gap >= 0 THEN -0.5 WHEN demanded >= 30 THEN 0.75 ELSE 0.25 END
    + CASE WHEN demand_trend >= 0.5 THEN 0.125 ELSE -0.125 END"""

ORACLE: dict[str, str] = {
    "boosted_histogram": with_ctes("SELECT * FROM histogram", HISTOGRAM),
    "boosted_first_cuts": with_ctes(
        "SELECT node, g, h, feature, cut, ROUND(gain, 6) AS gain, g_left, h_left FROM cuts", CUTS
    ),
    "boosted_importances": with_ctes(
        """SELECT name AS feature, ROUND(COALESCE(mean / NULLIF(SUM(mean) OVER (), 0), 0), 6) AS importance
        FROM (SELECT f.name, COALESCE(AVG(gain), 0) AS mean FROM (VALUES (0, 'produced'), (1, 'demanded'), (2, 'gap')) f(number, name)
            LEFT JOIN cuts ON feature = number GROUP BY f.name) a""",
        CUTS,
    ),
    "predictions_stockout_given": with_ctes(
        f"""SELECT branch_id, product_id, week, ROUND(1 / (1 + EXP(-m)), 9) AS stockout_probability,
        CAST(CASE WHEN 1 / (1 + EXP(-m)) >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS risk_label, {AS_OF} AS prediction_date
        FROM (SELECT *, CAST({TREES} AS DOUBLE) AS m FROM stockout_features
            WHERE fill_rate_rolling IS NOT NULL AND demand_trend IS NOT NULL) s""",
        STOCKOUT,
    ),
    "boosted_early_stop": with_ctes(
        """SELECT CAST(prefix AS BIGINT) AS prefix, CAST(positives AS BIGINT) AS positives, CAST(negatives AS BIGINT) AS negatives,
        ROUND(auc, 9) AS auc, CAST(best AS BIGINT) AS best, prefix - best >= 3 AS stops,
        (SELECT CAST(best AS BIGINT) FROM bests WHERE prefix = COALESCE((SELECT MIN(prefix) FROM bests WHERE prefix - best >= 3), 8)) AS chosen
        FROM bests""",
        EARLY,
    ),
    "predictions_churn_flag_forest": flag_scores(6),
    "predictions_churn_flag_logistic": flag_scores(2),
    "decomposed_given_weights": with_ctes(
        """SELECT d.region_id, d.ds, ROUND((0.5 + 0.2 * t + 0.3 * GREATEST(t - 0.16, 0))
            * (1 + 0.1 * SIN(2 * PI() * number / 7) + 0.2 * COS(2 * PI() * number / 365.25)
               + 0.05 * (avg_unit_price - price_mean) / price_std + 0.02 * (rolling_7d_avg - rolling_mean) / rolling_std) * y_scale, 3) AS yhat
        FROM (SELECT f.*, s.* EXCLUDE (region_id), CAST(f.ds - DATE '1970-01-01' AS DOUBLE) AS number,
                CAST(f.ds - first_ds AS DOUBLE) / GREATEST(last_ds - first_ds, 1) AS t
            FROM demand_features f JOIN scales s ON f.region_id = s.region_id) d""",
        f"""{DEMAND},
scales AS (SELECT region_id, MIN(ds) AS first_ds, MAX(ds) AS last_ds, CAST(MAX(y) AS DOUBLE) AS y_scale, AVG(avg_unit_price) AS price_mean,
    STDDEV_POP(avg_unit_price) AS price_std, AVG(rolling_7d_avg) AS rolling_mean, STDDEV_POP(rolling_7d_avg) AS rolling_std
    FROM demand_features WHERE avg_unit_price IS NOT NULL AND rolling_7d_avg IS NOT NULL GROUP BY region_id)""",
    ),
    "forecast_bands_of_paths": with_ctes(
        """SELECT region_id, day_of_week, ROUND(QUANTILE_CONT(CAST(total_units AS DOUBLE), 0.1), 6) AS yhat_lower,
        ROUND(QUANTILE_CONT(CAST(total_units AS DOUBLE), 0.9), 6) AS yhat_upper FROM demand_features GROUP BY 1, 2""",
        DEMAND,
    ),
    "feature_files": TABLE_ORACLE["churn_features"],
    "refreshed_scores": with_ctes("SELECT customer_id, churned, ROUND(score, 9) AS score FROM scores", SCORE),
    "catalog_staging_view": TABLE_ORACLE["stg_orders"],
    "catalog_mart_table": TABLE_ORACLE["mart_monthly_sales"],
    "model_store": with_ctes(
        "SELECT region_id, MIN(ds) AS first_ds, MAX(ds) AS last_ds, CAST(MAX(y) AS DOUBLE) AS y_scale FROM demand_features GROUP BY region_id", DEMAND
    ),
    "clustered_lookup": with_ctes(
        """SELECT order_id, customer_id, order_date FROM sc_orders
        WHERE customer_id BETWEEN 20 AND 60 AND order_date >= DATE '1999-01-01' AND order_date < DATE '2000-01-01'"""
    ),
    "common_values": with_ctes(
        """SELECT 'orders' AS table_name, 'status' AS "column", CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_nulls,
        status AS value, COUNT(*) AS n FROM sc_orders GROUP BY status
        UNION ALL SELECT 'customers', 'branch_id', CAST(SUM(COUNT(*)) OVER () AS BIGINT), CAST(0 AS BIGINT),
        CAST(branch_id AS VARCHAR), COUNT(*) FROM sc_customers GROUP BY branch_id"""
    ),
    "join_salted_buckets": with_ctes(
        """SELECT i.order_id, product_id, CAST(quantity AS BIGINT) AS quantity, customer_id
        FROM sc_items i JOIN sc_orders o ON i.order_id = o.order_id"""
    ),
    "csv_products": """SELECT p_name AS product_name, p_type AS category,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) + CAST(0.01 AS DECIMAL(12,2)) AS DOUBLE) AS unit_cost,
        TIMESTAMP '2001-08-01 12:00:00' AS created_at, TRUE AS stamped_now FROM part""",
    "ingest_job": with_ctes(
        "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_loaded, COUNT(*) AS n_stored FROM {v}" for t, v in TABLE_VIEWS.items())
    ),
}
