"""Plain Spark SQL forms of the questions: what a first answer would be.

They are the baseline the operators are timed against (``bench.py``) and a
third implementation the tests compare results with.  Each one states its
question directly, with windows, EXISTS, self-joins and grids, and no thought
of skew or scale.  They are not registered as queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.tables import TABLES, Tables

_PAIRS = """
pairs AS (
  SELECT l.event_id AS match_id, l.user_id AS one_id, r.user_id AS two_id,
         CAST(floor(l.value) AS BIGINT) AS one_time, CAST(floor(r.value) AS BIGINT) AS two_time
  FROM events l, events r WHERE r.event_id = l.event_id + 1 AND l.event_id % 2 = 0
)"""

_MOVED = """
moved AS (
  SELECT explode(array(c_nationkey, s_nationkey)) AS airport,
         CAST(l_quantity AS DECIMAL(18,2)) * if(l_returnflag = 'R', 2, 1) AS seats
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
),
traffic AS (SELECT airport, SUM(seats) AS total FROM moved GROUP BY airport)"""

_POSTS = """
posts AS (
  SELECT to_date(ts) AS day, user_id, COUNT(event_id) AS num_posts FROM events
  WHERE to_date(ts) IN (DATE'2024-01-05', DATE'2024-01-06') GROUP BY 1, 2
)"""

_REACH = """
WITH RECURSIVE follows AS (
  SELECT DISTINCT l.user_id AS src, r.user_id AS dst FROM events l JOIN events r ON r.event_id = l.event_id + 1
  WHERE l.event_type = 'error' AND r.event_type = 'error'
),
reach AS (
  SELECT src AS follower_id, 1 AS hops FROM follows WHERE dst = (SELECT MIN(dst) FROM follows)
  UNION ALL
  SELECT src, hops + 1 FROM follows JOIN reach ON dst = follower_id WHERE hops < 4
)
SELECT DISTINCT follower_id FROM reach WHERE hops {} 4"""

_BEST_PARTS = """
SELECT l_orderkey AS order_id, p_partkey AS part_id
FROM (SELECT l_orderkey, p_partkey, p_retailprice, MAX(p_retailprice) OVER (PARTITION BY l_orderkey) AS best
      FROM lineitem JOIN part ON p_partkey = l_partkey)
WHERE p_retailprice = best"""

_BASKET = """
SELECT c_custkey AS customer_id, c_name AS name FROM customer
JOIN (SELECT o_custkey, collect_set(p_type) AS types FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      JOIN part ON p_partkey = l_partkey GROUP BY o_custkey) ON o_custkey = c_custkey
WHERE array_contains(types, 'PROMO') AND array_contains(types, 'ECONOMY') AND NOT array_contains(types, 'LARGE')"""

_GRID = """
WITH sums AS (
  SELECT l_partkey AS part_id, month(o_orderdate) AS month, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS total
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2
),
filled AS (
  SELECT part_id, month, total, SUM(COALESCE(total, 0)) OVER (PARTITION BY part_id ORDER BY month ROWS 2 PRECEDING) AS three,
         MAX(IF(total <> 0, month, NULL)) OVER (PARTITION BY part_id) AS last_month
  FROM (SELECT DISTINCT part_id FROM sums) CROSS JOIN (SELECT DISTINCT month FROM sums)
  LEFT JOIN sums USING (part_id, month)
)
SELECT part_id, month, CAST(three AS DOUBLE) AS part_summary FROM filled WHERE total <> 0 AND month < last_month"""

_GAPS = """
SELECT user_id, CAST(COALESCE(MAX(gap), 0) AS BIGINT) AS biggest_window
FROM (SELECT user_id, event_id, datediff(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) AS gap,
             COUNT(event_id) OVER (PARTITION BY user_id) AS n FROM events)
WHERE n > 10 GROUP BY user_id"""

LITERAL_SQL: dict[str, str] = {
    "children_threshold": """
SELECT o_custkey AS parent_id FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey HAVING COUNT(*) >= 10""",
    "count_threshold": """
SELECT user_id FROM events WHERE event_type = 'purchase' GROUP BY user_id HAVING COUNT(event_id) >= 10""",
    "weekday_weekend_pivot": """
SELECT COUNT(IF(weekday(ts) < 5, 1, NULL)) AS working_cnt, COUNT(IF(weekday(ts) >= 5, 1, NULL)) AS weekend_cnt FROM events""",
    "exact_length_count": "SELECT COUNT(*) AS char_limit_count FROM part WHERE length(p_name) = 9",
    "two_entity_daily_diff": """
SELECT to_date(ts) AS day FROM events GROUP BY 1
HAVING ABS(SUM(IF(event_type = 'click', 1, 0)) - SUM(IF(event_type = 'view', 1, 0))) > 2""",
    "star_revenue_filtered": """
SELECT p_type, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
WHERE p_type LIKE '%M%' AND year(o_orderdate) = 1997 GROUP BY p_type""",
    "distinct_count_and_list": """
SELECT c_name AS customer_name, COUNT(DISTINCT n_nationkey) AS distinct_nations,
       array_join(array_sort(collect_set(n_name)), ',') AS list_of_nations
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE r_name ILIKE '%asia%' GROUP BY c_name""",
    "percentage_bonus": """
SELECT s_name AS name, CAST(ROUND(SUM(CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2))) * 0.1) AS BIGINT) AS bonus
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
GROUP BY s_name""",
    "weekday_totals": """
SELECT to_date(ts) AS day, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events
WHERE event_type = 'purchase' AND weekday(ts) = 4 AND date_format(ts, 'yyyy-MM') = '2024-01' GROUP BY 1""",
    "anti_join_spend": """
SELECT c_custkey AS customer_id, c_name AS name FROM customer JOIN orders ON o_custkey = c_custkey
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
GROUP BY c_custkey, c_name HAVING SUM(CAST(o_totalprice AS DECIMAL(18,2))) >= 1000000""",
    "strictly_increasing": """
SELECT customer_id
FROM (SELECT customer_id, total > LAG(total, 1, -1) OVER (PARTITION BY customer_id ORDER BY yr) AS more
      FROM (SELECT o_custkey AS customer_id, year(o_orderdate) AS yr, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total
            FROM orders WHERE year(o_orderdate) < 2001 GROUP BY 1, 2))
GROUP BY customer_id HAVING every(more)""",
    "nth_exceeds_prior": """
SELECT o_custkey AS customer_id, CAST(spent[2].s AS DOUBLE) AS nth_spend, spent[2].d AS nth_date
FROM (SELECT o_custkey, slice(array_sort(collect_list(struct(to_date(o_orderdate) AS d, o_orderkey AS k, s))), 1, 3) AS spent
      FROM orders JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY l_orderkey)
      ON l_orderkey = o_orderkey GROUP BY o_custkey)
WHERE size(spent) = 3 AND spent[2].s > spent[1].s AND spent[2].s > spent[0].s""",
    "consecutive_days": """
SELECT user_id, day AS consecutive_start, date_add(day, 3) AS consecutive_end
FROM (SELECT user_id, day, COUNT(*) OVER (PARTITION BY user_id ORDER BY unix_date(day) RANGE BETWEEN CURRENT ROW AND 3 FOLLOWING) AS n
      FROM (SELECT DISTINCT user_id, to_date(ts) AS day FROM events)) WHERE n = 4""",
    "largest_gap": _GAPS,
    "first_last_same": """
SELECT DISTINCT o_custkey AS user_id
FROM (SELECT o_custkey, FIRST_VALUE(o_orderpriority) OVER w AS a, LAST_VALUE(o_orderpriority) OVER w AS z,
             COUNT(IF(o_orderstatus = 'F', 1, NULL)) OVER w AS n FROM orders
      WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND a = z AND n >= 2""",
    "match_points": "WITH " + _PAIRS.strip() + """
SELECT COALESCE(player, c_custkey) AS entity_id, c_name AS name, COALESCE(points, 0L) AS num_points
FROM (SELECT player, SUM(CASE WHEN own < other THEN 3 WHEN own = other THEN 1 ELSE 0 END) AS points
      FROM (SELECT inline(array(struct(one_id AS player, one_time AS own, two_time AS other), struct(two_id AS player, two_time AS own, one_time AS other))) FROM pairs)
      GROUP BY player)
FULL JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON c_custkey = player""",
    "argmin_per_entity": "WITH " + _PAIRS.strip() + """,
runs AS (SELECT inline(array(struct(one_id AS entity_id, one_time AS t, match_id), struct(two_id AS entity_id, two_time AS t, match_id))) FROM pairs)
SELECT match_id, entity_id, t AS best_time
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY t NULLS LAST, match_id) AS nth FROM runs) WHERE nth = 1""",
    "semi_any_role": "WITH " + _PAIRS.strip() + """
SELECT c_name AS name FROM customer WHERE EXISTS (SELECT 1 FROM pairs WHERE c_custkey IN (one_id, two_id))""",
    "union_distinct_roles": "WITH " + _PAIRS.strip() + """
SELECT c_name AS name FROM customer JOIN pairs ON one_id = c_custkey
UNION SELECT c_name FROM customer JOIN pairs ON two_id = c_custkey""",
    "top_with_ties": """
SELECT name FROM (SELECT c_name AS name, n, MAX(n) OVER () AS most
                  FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) JOIN customer ON c_custkey = o_custkey)
WHERE n = most""",
    "basket_intersect_except": _BASKET,
    "rolling_dense_sum": _GRID + " ORDER BY part_id, month DESC LIMIT 10",
    "rolling_dense_sum_all": _GRID,
    "max_per_group_ties": _BEST_PARTS + " ORDER BY order_id, part_id LIMIT 5",
    "max_per_group_ties_all": _BEST_PARTS,
    "daily_max_ties": """
SELECT event_id FROM (SELECT event_id, floor(value) AS v, MAX(floor(value)) OVER (PARTITION BY to_date(ts)) AS best FROM events
                      WHERE event_type = 'purchase' AND date_format(ts, 'yyyy-MM') = '2024-01') WHERE v = best""",
    "max_above_max_avg": """
WITH u AS (SELECT user_id, MAX(CAST(value AS DECIMAL(18,2))) AS top, AVG(CAST(value AS DECIMAL(18,2))) AS mean FROM events
           WHERE event_type = 'purchase' GROUP BY user_id HAVING COUNT(DISTINCT event_id) >= 2)
SELECT user_id FROM u WHERE top > (SELECT MAX(mean) FROM u)""",
    "two_sided_traffic_top1": "WITH " + _MOVED.strip() + " SELECT airport FROM traffic WHERE total IS NOT NULL ORDER BY total DESC, airport LIMIT 1",
    "traffic_percent_rank": "WITH " + _MOVED.strip() + """
SELECT airport, CAST(ROUND(CAST(100 * PERCENT_RANK() OVER (ORDER BY total) AS DECIMAL(18,6)), 1) AS DOUBLE) AS percent_rank FROM traffic""",
    "k_hop": _REACH.format("="),
    "k_hop_within": _REACH.format("<="),
    "top_n_per_day": "WITH " + _POSTS.strip() + """
SELECT day, user_id, num_posts
FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY day ORDER BY num_posts DESC) AS place FROM posts) WHERE place <= 2""",
    "top_two_values_global": "WITH " + _POSTS.strip() + """
SELECT day, user_id, num_posts
FROM (SELECT *, DENSE_RANK() OVER (ORDER BY num_posts DESC) AS place FROM posts) WHERE place <= 2""",
}


def literal_query(spark: SparkSession, key: str, root: str) -> DataFrame:
    """Run the literal form of ``key`` over the tables of ``root``."""
    t = Tables(spark, root)
    for name in TABLES[:8]:
        t.load(name).createOrReplaceTempView(name)
    return spark.sql(LITERAL_SQL[key])
