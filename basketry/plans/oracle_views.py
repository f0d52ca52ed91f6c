"""The same inputs and stages as SQL views, for the side-by-side check."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "shop_events": """
        SELECT ts AS timestamp, CAST(user_id AS INT) AS visitorid,
               CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction'
                    ELSE event_type END AS event,
               CAST(json_extract_string(props, '$.k') AS INT) AS itemid,
               CASE WHEN event_type = 'purchase' THEN CAST(event_id AS INT) END AS transactionid
        FROM events""",
    "order_events": """
        SELECT o_orderdate AS timestamp, CAST(o_custkey AS INT) AS visitorid,
               CASE l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'addtocart'
                    ELSE 'transaction' END AS event,
               CAST(l_partkey AS INT) AS itemid,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_orderkey AS INT) END AS transactionid
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_events": """
        SELECT epoch_us(timestamp) // 1000 AS timestamp, visitorid, event, itemid, transactionid
        FROM shop_events
        UNION ALL
        SELECT epoch_us(timestamp) // 1000, visitorid, event, itemid, transactionid
        FROM shop_events WHERE visitorid % 50 = 0""",
    "property_catalogue": """
        SELECT TIMESTAMP '1995-01-01 00:00:00' AS timestamp, CAST(p_partkey AS INT) AS itemid,
               'categoryid' AS property, CAST(p_size AS VARCHAR) AS value
        FROM part
        UNION ALL
        SELECT TIMESTAMP '1995-01-01 00:00:00', CAST(p_partkey AS INT), 'brand', p_brand
        FROM part
        UNION ALL
        SELECT TIMESTAMP '1995-01-01 00:00:00', CAST(p_partkey AS INT), 'type',
               CASE WHEN p_partkey % 7 = 0 THEN ' ' ELSE p_type END
        FROM part
        UNION ALL
        SELECT TIMESTAMP '1995-01-01 00:00:00', CAST(p_partkey AS INT), '159', 'n1.0'
        FROM part""",
    "property_changes": """
        SELECT l_shipdate AS timestamp, CAST(l_partkey AS INT) AS itemid, 'available' AS property,
               CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS value
        FROM lineitem
        UNION ALL
        SELECT l_shipdate, CAST(l_partkey AS INT), 'categoryid',
               CASE WHEN l_quantity = 50 THEN 'n/a'
                    ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END
        FROM lineitem""",
    "item_properties": """
        SELECT * FROM property_catalogue UNION ALL SELECT * FROM property_changes""",
    "category_tree": """
        SELECT CAST(r_regionkey AS SMALLINT) AS categoryid, CAST(NULL AS SMALLINT) AS parentid
        FROM region
        UNION ALL
        SELECT CAST(100 + n_nationkey AS SMALLINT), CAST(n_regionkey AS SMALLINT) FROM nation
        UNION ALL
        SELECT CAST(200 + s_suppkey % 30000 AS SMALLINT), CAST(100 + s_nationkey AS SMALLINT)
        FROM supplier""",
    "item_categories": """
        SELECT timestamp, itemid, CAST(TRY_CAST(value AS DOUBLE) AS SMALLINT) AS categoryid
        FROM item_properties
        WHERE property = 'categoryid' AND TRY_CAST(value AS DOUBLE) BETWEEN -32768 AND 32767""",
    "latest_category": """
        SELECT itemid, categoryid FROM (
          SELECT *, row_number() OVER (PARTITION BY itemid
                                       ORDER BY timestamp DESC, categoryid DESC) AS place
          FROM item_categories) WHERE place = 1""",
    "events_with_category": """
        SELECT e.*, c.categoryid FROM order_events e LEFT JOIN latest_category c USING (itemid)""",
    "category_matrix": """
        SELECT categoryid,
               count(*) FILTER (event = 'view') AS "view",
               count(*) FILTER (event = 'addtocart') AS addtocart,
               count(*) FILTER (event = 'transaction') AS "transaction",
               count(*) AS total
        FROM events_with_category WHERE categoryid IS NOT NULL GROUP BY categoryid""",
    "shop_bounds": """
        SELECT max(timestamp) + INTERVAL 1 MILLISECOND - INTERVAL 14 DAY AS ranker_start,
               max(timestamp) + INTERVAL 1 MILLISECOND - INTERVAL 7 DAY AS evaluation_start,
               max(timestamp) + INTERVAL 1 MILLISECOND AS data_end
        FROM shop_events""",
    "order_bounds": """
        SELECT max(timestamp) + INTERVAL 1 MILLISECOND - INTERVAL 360 DAY AS ranker_start,
               max(timestamp) + INTERVAL 1 MILLISECOND - INTERVAL 180 DAY AS evaluation_start,
               max(timestamp) + INTERVAL 1 MILLISECOND AS data_end
        FROM order_events""",
    "shop_canonical": """
        SELECT timestamp, visitorid AS user_id, event, itemid AS item_id, transactionid
        FROM shop_events""",
    "order_canonical": """
        SELECT timestamp, visitorid AS user_id, event, itemid AS item_id, transactionid
        FROM order_events""",
    "shop_history": """
        SELECT * FROM shop_canonical WHERE timestamp < (SELECT ranker_start FROM shop_bounds)""",
    "shop_ranker": """
        SELECT * FROM shop_canonical
        WHERE timestamp >= (SELECT ranker_start FROM shop_bounds)
          AND timestamp < (SELECT evaluation_start FROM shop_bounds)""",
    "shop_evaluation": """
        SELECT * FROM shop_canonical
        WHERE timestamp >= (SELECT evaluation_start FROM shop_bounds)
          AND timestamp < (SELECT data_end FROM shop_bounds)""",
    "order_history": """
        SELECT * FROM order_canonical WHERE timestamp < (SELECT ranker_start FROM order_bounds)""",
    "order_ranker": """
        SELECT * FROM order_canonical
        WHERE timestamp >= (SELECT ranker_start FROM order_bounds)
          AND timestamp < (SELECT evaluation_start FROM order_bounds)""",
    "order_evaluation": """
        SELECT * FROM order_canonical
        WHERE timestamp >= (SELECT evaluation_start FROM order_bounds)
          AND timestamp < (SELECT data_end FROM order_bounds)""",
    "positives": """
        SELECT DISTINCT user_id, item_id FROM shop_ranker
        WHERE event IN ('addtocart', 'transaction')""",
    "truth": """
        SELECT DISTINCT user_id, item_id FROM shop_evaluation
        WHERE event IN ('addtocart', 'transaction')""",
    "conversion": """
        SELECT count(*) FILTER (has_view AND has_cart) AS users_with_both,
               count(*) FILTER (has_view) AS users_with_source,
               greatest(CAST(count(*) FILTER (has_view AND has_cart) AS DOUBLE)
                        / greatest(count(*) FILTER (has_view), 1), 0.001) AS probability
        FROM (SELECT user_id, bool_or(event = 'view') AS has_view,
                     bool_or(event = 'addtocart') AS has_cart
              FROM shop_history GROUP BY user_id)""",
    "weights": """
        SELECT 'view' AS event, CAST(1.0 AS DOUBLE) AS weight
        UNION ALL SELECT 'addtocart', sqrt(1.0 / probability) FROM conversion
        UNION ALL SELECT 'transaction', sqrt(1.0 / probability) * 1.3 FROM conversion""",
    "interactions": """
        SELECT user_id, item_id, sum(weight) AS weight
        FROM shop_history JOIN weights USING (event) GROUP BY user_id, item_id""",
    "popular": """
        SELECT item_id AS itemid, score,
               CAST(row_number() OVER (ORDER BY score DESC, item_id) AS INT) AS rank
        FROM (SELECT item_id, count(DISTINCT user_id) AS score FROM shop_history
              WHERE event IN ('addtocart', 'transaction') GROUP BY item_id
              ORDER BY score DESC, item_id LIMIT 20)""",
    "personal": """
        SELECT * FROM (
          SELECT user_id AS visitorid, item_id AS itemid, score,
                 CAST(row_number() OVER (PARTITION BY user_id
                                         ORDER BY score DESC, item_id) AS INT) AS rank
          FROM (SELECT user_id, item_id,
                       CAST(sum(CASE event WHEN 'view' THEN 1 WHEN 'addtocart' THEN 2
                                           ELSE 3 END) AS DOUBLE) AS score
                FROM shop_history WHERE event IN ('view', 'addtocart', 'transaction')
                GROUP BY user_id, item_id)) WHERE rank <= 20""",
    "similarity": """
        SELECT a.vec_id AS itemid, b.vec_id AS similar_itemid,
               CAST(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),
                                           CAST(b.embedding AS DOUBLE[])) AS FLOAT) AS score
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id""",
    "neighbours": """
        SELECT * FROM (
          SELECT CAST(itemid AS INT) AS itemid, CAST(similar_itemid AS INT) AS similar_itemid,
                 score,
                 CAST(row_number() OVER (PARTITION BY itemid
                                         ORDER BY score DESC, similar_itemid) AS INT) AS rank
          FROM similarity) WHERE rank <= 10""",
    "products": """
        SELECT CAST(a.vec_id AS INT) AS visitorid, CAST(b.vec_id AS INT) AS itemid,
               CAST(list_dot_product(CAST(a.embedding AS DOUBLE[]),
                                     CAST(b.embedding AS DOUBLE[])) AS FLOAT) AS score
        FROM embeddings a JOIN embeddings b ON true""",
    "best_products": """
        SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY visitorid
                                            ORDER BY score DESC, itemid) AS INT) AS rank
          FROM products) WHERE rank <= 10""",
    "history": """
        SELECT user_id, item_id AS source_item_id FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id
                                       ORDER BY last_time DESC, item_id) AS place
          FROM (SELECT user_id, item_id, max(timestamp) AS last_time FROM shop_history
                WHERE event IN ('view', 'addtocart', 'transaction')
                GROUP BY user_id, item_id)) WHERE place <= 5""",
    "similar_features": """
        SELECT h.user_id, s.similar_itemid AS item_id, max(s.score) AS similarity_score,
               min(s.rank) AS similarity_rank,
               CAST(count(DISTINCT h.source_item_id) AS INT) AS similarity_sources
        FROM history h JOIN neighbours s ON s.itemid = h.source_item_id AND s.rank <= 10
        GROUP BY h.user_id, s.similar_itemid""",
    "popular_pairs": """
        SELECT u.user_id, p.itemid AS item_id
        FROM (SELECT DISTINCT user_id FROM history) u JOIN popular p ON p.rank <= 5""",
    "pairs": """
        SELECT visitorid AS user_id, itemid AS item_id FROM personal
        UNION SELECT user_id, item_id FROM similar_features
        UNION SELECT user_id, item_id FROM popular_pairs""",
    "candidates": """
        SELECT c.user_id, c.item_id, a.score AS als_score, a.rank AS als_rank,
               CAST(p.score AS DOUBLE) AS popular_score, p.rank AS popular_rank,
               s.similarity_score, s.similarity_rank, s.similarity_sources,
               CASE WHEN a.score IS NULL THEN 0 ELSE 1 END AS from_als,
               CASE WHEN p.score IS NULL THEN 0 ELSE 1 END AS from_popular,
               CASE WHEN s.similarity_score IS NULL THEN 0 ELSE 1 END AS from_similar,
               ln(1 + CAST(p.score AS DOUBLE)) AS popular_score_log
        FROM pairs c
        LEFT JOIN personal a ON a.visitorid = c.user_id AND a.itemid = c.item_id
        LEFT JOIN popular p ON p.itemid = c.item_id
        LEFT JOIN similar_features s ON s.user_id = c.user_id AND s.item_id = c.item_id""",
    "labelled": """
        SELECT c.*, CASE WHEN p.item_id IS NULL THEN 0 ELSE 1 END AS target
        FROM candidates c
        LEFT JOIN positives p ON p.user_id = c.user_id AND p.item_id = c.item_id
        WHERE c.user_id IN (SELECT user_id FROM positives)""",
    "valid": """
        SELECT * FROM labelled WHERE user_id IN (
          SELECT user_id FROM labelled GROUP BY user_id HAVING max(target) = 1 AND min(target) = 0)""",
    "scored": """
        SELECT *, 100 * coalesce(popular_score, 0) - item_id AS score FROM candidates""",
    "recommendations": """
        SELECT user_id, item_id, score,
               CAST(row_number() OVER (PARTITION BY user_id
                                       ORDER BY score DESC, item_id) AS INT) AS rank
        FROM scored""",
    "eval_users": """
        SELECT user_id FROM truth INTERSECT SELECT visitorid FROM personal WHERE rank <= 10""",
    "eval_truth": """
        SELECT * FROM truth WHERE user_id IN (SELECT user_id FROM eval_users)""",
    "eval_popular": """
        SELECT u.user_id, p.itemid AS item_id, p.rank
        FROM eval_users u JOIN popular p ON p.rank <= 10""",
    "eval_personal": """
        SELECT visitorid AS user_id, itemid AS item_id, rank FROM personal
        WHERE rank <= 10 AND visitorid IN (SELECT user_id FROM eval_users)""",
    "eval_final": """
        SELECT user_id, item_id, rank FROM recommendations
        WHERE rank <= 10 AND user_id IN (SELECT user_id FROM eval_users)""",
    "item_novelty": """
        SELECT item_id, -log2(count(*) * 1.0 / (SELECT count(*) FROM shop_canonical
            WHERE timestamp < (SELECT evaluation_start FROM shop_bounds))) AS novelty
        FROM shop_canonical WHERE timestamp < (SELECT evaluation_start FROM shop_bounds)
        GROUP BY item_id""",
}


def with_views(sql: str) -> str:
    """``sql`` with the views it mentions, directly or through others, as CTEs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"(?<![\w']){name}(?![\w'])", text):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {ctes}\n{sql}"
