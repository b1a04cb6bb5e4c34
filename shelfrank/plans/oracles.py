"""The registered queries as DuckDB SQL, for checking results only."""

from __future__ import annotations

PARTS: dict[str, str] = {
    "sale_lines": """
        SELECT l_orderkey AS order_id, l_suppkey AS seller_id, l_partkey AS book_id,
               CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS line_total,
               CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'pending' END AS item_status
        FROM lineitem""",
    "fact_sales": """
        SELECT s.*, o_custkey AS buyer_id, o_orderdate + INTERVAL 8218 DAY AS order_date
        FROM sale_lines s JOIN orders ON order_id = o_orderkey""",
    "fact_cart": """
        SELECT event_id AS cart_id, user_id AS buyer_id,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS book_id, ts AS added_at
        FROM events WHERE event_type = 'click'""",
    "fact_reviews": """
        SELECT event_id AS review_id, user_id AS buyer_id,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS book_id,
               CAST(5 - least(floor(value / 30), 4) AS DOUBLE) AS score, ts AS snapshot_date
        FROM events WHERE event_type = 'view'""",
    "catalogue": """
        SELECT p_partkey AS book_id, p_name AS title, p_brand AS author, p_type AS category_name,
               p_retailprice AS price
        FROM part""",
    "dim_users": "SELECT c_custkey AS user_id, c_name AS username, c_mktsegment AS role FROM customer",
    "purchase_counts": "SELECT book_id, count(*) AS purchase_count FROM sale_lines GROUP BY book_id",
    "ratings": "SELECT book_id, round(avg(score), 2) AS rating_avg FROM fact_reviews GROUP BY book_id",
    "dim_books": """
        SELECT c.*, coalesce(purchase_count, 0) AS purchase_count, coalesce(rating_avg, 0.0) AS rating_avg
        FROM catalogue c LEFT JOIN purchase_counts USING (book_id) LEFT JOIN ratings USING (book_id)""",
    "event_rows": """
        SELECT buyer_id AS user_id, book_id, order_date AS event_ts, CAST(10 AS DOUBLE) AS base_score
        FROM fact_sales WHERE item_status = 'completed'
        UNION ALL SELECT buyer_id, book_id, added_at, CAST(3 AS DOUBLE) FROM fact_cart
        UNION ALL SELECT buyer_id, book_id, snapshot_date, CAST(5 AS DOUBLE)
        FROM fact_reviews WHERE score >= 4""",
    "decayed": """
        SELECT *, base_score * exp(CAST(-0.05 AS DOUBLE)
                 * (CAST(date_diff('day', CAST(event_ts AS DATE), DATE '2024-02-01') AS DOUBLE) / CAST(30 AS DOUBLE)))
                 AS decayed_score
        FROM event_rows WHERE event_ts < TIMESTAMP '2024-02-02'""",
    "scores": """
        SELECT user_id, book_id, sum(decayed_score) AS interaction_score
        FROM decayed GROUP BY user_id, book_id""",
    "user_n": "SELECT user_id, count(*) AS n_books FROM scores GROUP BY user_id",
    "book_n": "SELECT book_id, count(*) AS n_users FROM scores GROUP BY book_id",
    "kept": """
        SELECT * FROM scores WHERE book_id NOT IN (SELECT book_id FROM book_n WHERE n_users < 8)""",
    "kept_n": "SELECT user_id, count(*) AS n_books FROM kept GROUP BY user_id",
    "groups": """
        SELECT user_id, coalesce(n_books, 0) AS n_books,
               CASE WHEN coalesce(n_books, 0) = 0 THEN 'cold' WHEN n_books < 5 THEN 'hybrid'
                    ELSE 'warm' END AS user_group
        FROM (SELECT user_id FROM dim_users UNION SELECT user_id FROM kept) LEFT JOIN kept_n USING (user_id)""",
    "ranked_books": """
        SELECT *, percent_rank() OVER (ORDER BY purchase_count) AS purchase_rank,
               percent_rank() OVER (ORDER BY rating_avg) AS rating_rank
        FROM dim_books WHERE rating_avg >= 3.5""",
    "pool": """
        SELECT book_id, title, round(full_score, 6) AS popularity_score
        FROM (SELECT *, round(purchase_rank * CAST(0.6 AS DOUBLE) + rating_rank * CAST(0.4 AS DOUBLE), 12)
                     AS full_score FROM ranked_books)
        ORDER BY full_score DESC, book_id LIMIT 10""",
    "sample_all": """
        SELECT user_id, book_id, title, popularity_score,
               row_number() OVER (PARTITION BY user_id
                   ORDER BY md5(concat(user_id, ':', book_id))) AS rank
        FROM (SELECT user_id FROM dim_users UNION SELECT user_id FROM scores), pool""",
    "category_w": """
        SELECT user_id, category_name, round(sum(interaction_score), 6) AS weight
        FROM scores JOIN catalogue USING (book_id) GROUP BY user_id, category_name""",
    "author_w": """
        SELECT user_id, author, round(sum(interaction_score), 6) AS weight
        FROM scores JOIN catalogue USING (book_id) GROUP BY user_id, author""",
    "top_cat": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY weight DESC, category_name) AS rank FROM category_w) WHERE rank <= 3""",
    "top_aut": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY weight DESC, author) AS rank FROM author_w) WHERE rank <= 3""",
    "recent": """
        SELECT * FROM (SELECT buyer_id AS user_id, book_id, order_date, title, row_number() OVER (
            PARTITION BY buyer_id ORDER BY order_date DESC, book_id) AS rank
            FROM fact_sales JOIN catalogue USING (book_id) WHERE item_status = 'completed')
        WHERE rank <= 2""",
    "rated": """
        SELECT * FROM (SELECT buyer_id AS user_id, book_id, score, snapshot_date, title, row_number() OVER (
            PARTITION BY buyer_id ORDER BY score DESC, snapshot_date DESC, book_id) AS rank
            FROM fact_reviews JOIN catalogue USING (book_id) WHERE score >= 4)
        WHERE rank <= 2""",
    "profiles": """
        SELECT u.user_id, concat_ws(chr(10), 'User strongly prefers:',
            '- Categories: ' || (SELECT string_agg(category_name, ', ' ORDER BY rank) FROM top_cat x WHERE x.user_id = u.user_id),
            '- Authors: ' || (SELECT string_agg(author, ', ' ORDER BY rank) FROM top_aut x WHERE x.user_id = u.user_id),
            '- Highly rated books: ' || (SELECT string_agg(title, ', ' ORDER BY rank) FROM rated x WHERE x.user_id = u.user_id),
            '- Recently purchased: ' || (SELECT string_agg(title, ', ' ORDER BY rank) FROM recent x WHERE x.user_id = u.user_id)
            ) AS user_profile
        FROM (SELECT DISTINCT user_id FROM scores) u""",
    "descriptions": """
        SELECT book_id, concat('Title: ', title, chr(10), 'Author: ', author, chr(10), 'Category: ',
            category_name, chr(10), 'Average Rating: ', CAST(round(rating_avg, 1) AS VARCHAR), chr(10),
            'Popularity rank: ', purchase_count) AS item_description
        FROM dim_books""",
    "vectors": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings",
    "dots": """
        SELECT u.id AS user_id, v.id AS book_id, round(list_dot_product(u.f, v.f), 12) + 0.0 AS mf_score
        FROM vectors u, vectors v""",
    "depth_100": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY mf_score DESC, book_id) AS r FROM dots
            WHERE user_id IN (SELECT user_id FROM scores)) WHERE r <= 100""",
    "cands": """
        SELECT user_id, book_id, mf_score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY mf_score DESC, book_id) AS rank
            FROM dots d WHERE user_id IN (SELECT user_id FROM scores) AND NOT EXISTS (
                SELECT 1 FROM scores s WHERE s.user_id = d.user_id AND s.book_id = d.book_id))
        WHERE rank <= 50""",
    "profile_words": """
        SELECT user_id, list_filter(list_distinct(string_split(
            regexp_replace(lower(user_profile), '[^a-z0-9]+', ' ', 'g'), ' ')), lambda x: x <> '') AS a
        FROM profiles""",
    "description_words": """
        SELECT book_id, list_filter(list_distinct(string_split(
            regexp_replace(lower(item_description), '[^a-z0-9]+', ' ', 'g'), ' ')), lambda x: x <> '') AS b
        FROM descriptions""",
    "pairs": """
        SELECT c.*, len(list_intersect(a, b)) AS common, len(a) + len(b) AS both_n
        FROM cands c JOIN profile_words USING (user_id) JOIN description_words USING (book_id)""",
    "semantic": """
        SELECT p.user_id, p.book_id, p.mf_score, round(1 / (1 + exp(-(
            CAST(common AS DOUBLE) / (both_n - common) * 4
            + CASE WHEN t.user_id IS NOT NULL THEN 1 ELSE 0 END
            + (rating_avg - 3) * CAST(0.2 AS DOUBLE) - 1))), 12) AS semantic_score
        FROM pairs p JOIN dim_books USING (book_id)
        LEFT JOIN top_cat t ON t.user_id = p.user_id AND t.category_name = dim_books.category_name""",
    "reranked_all": """
        SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY semantic_score DESC, mf_score DESC, book_id) AS rank FROM semantic""",
    "truth": """
        SELECT buyer_id AS user_id, book_id FROM all_sales WHERE item_status = 'completed'
            AND order_date >= TIMESTAMP '2024-01-16' AND order_date < TIMESTAMP '2024-02-01'
        UNION SELECT buyer_id, book_id FROM all_reviews WHERE score >= 4
            AND snapshot_date >= TIMESTAMP '2024-01-16' AND snapshot_date < TIMESTAMP '2024-02-01'""",
    "halved": "SELECT user_id, book_id FROM scores WHERE user_id % 2 = book_id % 2",
    "halved_later": """
        SELECT user_id, book_id FROM truth WHERE user_id % 2 = book_id % 2
            AND book_id IN (SELECT book_id FROM halved) AND user_id IN (SELECT user_id FROM halved)
        EXCEPT SELECT user_id, book_id FROM halved""",
    "all_changes": """
        SELECT buyer_id AS user_id, order_date AS event_ts FROM all_sales WHERE item_status = 'completed'
        UNION ALL SELECT buyer_id, snapshot_date FROM all_reviews""",
    "all_sales": """
        SELECT l_partkey AS book_id, o_custkey AS buyer_id, o_orderdate + INTERVAL 8218 DAY AS order_date,
               CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'pending' END AS item_status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "all_reviews": """
        SELECT user_id AS buyer_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS book_id,
               CAST(5 - least(floor(value / 30), 4) AS DOUBLE) AS score, ts AS snapshot_date
        FROM events WHERE event_type = 'view'""",
    "metric_users": """
        SELECT user_id, count(*) AS relevant, count(c.rank) AS hits50
        FROM truth LEFT JOIN cands c USING (user_id, book_id) GROUP BY user_id""",
    "hit_rows": """
        SELECT t.user_id, r.rank, row_number() OVER (PARTITION BY t.user_id ORDER BY r.rank) AS running
        FROM truth t JOIN reranked_all r USING (user_id, book_id) WHERE r.rank <= 5""",
    "order_users": """
        SELECT user_id, relevant, coalesce(dcg, 0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, 6) x(i)
                WHERE i <= least(relevant, 5)) AS ndcg,
            coalesce(ap, 0) / least(relevant, 5) AS ap, coalesce(1 / first_rank, 0) AS rr
        FROM (SELECT user_id, count(*) AS relevant FROM truth GROUP BY user_id)
        LEFT JOIN (SELECT user_id, sum(1 / log2(rank + 1)) AS dcg, sum(running / rank) AS ap,
            CAST(min(rank) AS DOUBLE) AS first_rank FROM hit_rows GROUP BY user_id) USING (user_id)""",
    "requests": "SELECT c_custkey AS user_id, nullif(c_nationkey % 8, 0) AS top_k FROM customer",
    "served": """
        SELECT user_id, CASE WHEN user_group = 'warm' AND user_id NOT IN (SELECT user_id FROM cands)
                             THEN 'cold' ELSE user_group END AS user_group FROM groups""",
    "routes": """
        SELECT DISTINCT user_id, CAST(coalesce(top_k, 5) AS BIGINT) AS top_k, user_group
        FROM requests JOIN served USING (user_id)""",
    "places": """
        SELECT book_id, row_number() OVER (ORDER BY md5(CAST(book_id AS VARCHAR))) - 1 AS place
        FROM (SELECT DISTINCT book_id FROM scores)""",
    "lacking": """
        SELECT u.user_id, p.book_id, row_number() OVER (PARTITION BY u.user_id ORDER BY p.place) - 1 AS nth,
               count(*) OVER (PARTITION BY u.user_id) AS n_free
        FROM (SELECT DISTINCT user_id FROM scores) u CROSS JOIN places p
        WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.user_id = u.user_id AND s.book_id = p.book_id)""",
    "blended": """
        SELECT user_id, top_k, book_id, round(coalesce(mf_score, 0) * CAST(0.3 AS DOUBLE)
            + coalesce(popularity_score, 0) * CAST(0.7 AS DOUBLE), 12) AS hybrid_score
        FROM (SELECT user_id, top_k, book_id, mf_score FROM cands JOIN routes USING (user_id)
              WHERE user_group = 'hybrid')
        FULL JOIN (SELECT user_id, top_k, book_id, popularity_score FROM sample_all JOIN routes
              USING (user_id) WHERE user_group = 'hybrid' AND rank <= top_k) USING (user_id, top_k, book_id)""",
    "routed": """
        SELECT top_k, user_id, 'warm' AS source, rank, book_id, round(mf_score, 6) AS mf_score,
               round(semantic_score, 6) AS semantic_score,
               CAST(NULL AS DOUBLE) AS popularity_score, CAST(NULL AS DOUBLE) AS hybrid_score
        FROM reranked_all JOIN routes USING (user_id) WHERE user_group = 'warm' AND rank <= top_k
        UNION ALL
        SELECT top_k, user_id, 'cold', rank, book_id, NULL, NULL, popularity_score, NULL
        FROM sample_all JOIN routes USING (user_id) WHERE user_group = 'cold' AND rank <= top_k
        UNION ALL
        SELECT top_k, user_id, 'hybrid', rank, book_id, NULL, NULL, NULL,
               CAST(round(CAST(hybrid_score AS DECIMAL(20, 12)), 6) AS DOUBLE)
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, top_k
              ORDER BY hybrid_score DESC, book_id) AS rank FROM blended) WHERE rank <= top_k""",
    "content_terms": """
        SELECT book_id, 'category=' || category_name AS term, CAST(1 AS DOUBLE) AS w FROM dim_books
        UNION ALL SELECT book_id, 'author=' || author, CAST(1 AS DOUBLE) FROM dim_books
        UNION ALL SELECT book_id, 'title=' || unnest(string_split(lower(trim(title)), ' ')),
            1 / sqrt(len(string_split(lower(trim(title)), ' '))) FROM dim_books""",
    "content": """
        SELECT book_id, term, sum(w) AS w FROM (
            SELECT book_id, term, w FROM content_terms UNION ALL SELECT book_id, 'rating', (rating_avg - 3) / 4 FROM dim_books)
        GROUP BY book_id, term""",
    "is_cold": """
        SELECT book_id, coalesce(n_users, 0) < 8 AS cold FROM dim_books LEFT JOIN book_n USING (book_id)""",
    "stored": """
        SELECT * EXCLUDE (made), made AS generated_at, made + INTERVAL 86400 SECOND AS expires_at,
               CAST(1 AS BIGINT) AS model_version
        FROM (SELECT user_id, source, rank, book_id FROM routed)
        JOIN (SELECT user_id, max(event_ts) AS made FROM event_rows GROUP BY user_id) USING (user_id)""",
    "dates": """
        SELECT CAST(order_date AS DATE) AS date FROM fact_sales
        UNION SELECT CAST(added_at AS DATE) FROM fact_cart
        UNION SELECT CAST(snapshot_date AS DATE) FROM fact_reviews""",
    "sweep_w": """
        SELECT user_id, category_name, rate, sum(base_score * exp(-rate * (CAST(date_diff('day',
            CAST(event_ts AS DATE), DATE '2024-01-08') AS DOUBLE) / CAST(30 AS DOUBLE)))) AS weight
        FROM event_rows JOIN catalogue USING (book_id), rates GROUP BY user_id, category_name, rate""",
    "rates": "SELECT CAST(unnest([0.01, 0.05, 0.1, 0.5]) AS DOUBLE) AS rate",
    "sweep_ranked": """
        SELECT * FROM (SELECT user_id, book_id, rate, row_number() OVER (PARTITION BY user_id, rate
            ORDER BY round(coalesce(weight, 0), 6) DESC, mf_score DESC, book_id) AS rank
            FROM cands JOIN catalogue USING (book_id) CROSS JOIN rates
            LEFT JOIN sweep_w USING (user_id, category_name, rate)) WHERE rank <= 5""",
    "sweep_hits": """
        SELECT user_id, rate, rank, row_number() OVER (PARTITION BY user_id, rate ORDER BY rank) AS running
        FROM truth JOIN sweep_ranked USING (user_id, book_id)""",
    "sweep_users": """
        SELECT user_id, rate, coalesce(dcg, 0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, 6) x(i)
            WHERE i <= least(relevant, 5)) AS ndcg, coalesce(ap, 0) / least(relevant, 5) AS ap
        FROM (SELECT user_id, count(*) AS relevant FROM truth GROUP BY user_id) CROSS JOIN rates
        LEFT JOIN (SELECT user_id, rate, sum(1 / log2(rank + 1)) AS dcg, sum(running / rank) AS ap
                   FROM sweep_hits GROUP BY user_id, rate) USING (user_id, rate)""",
}

# The same parts over events before the cut only.
TRAIN = {
    "fact_sales": PARTS["fact_sales"] + " WHERE o_orderdate + INTERVAL 8218 DAY < TIMESTAMP '2024-01-16'",
    "fact_cart": PARTS["fact_cart"] + " AND ts < TIMESTAMP '2024-01-16'",
    "fact_reviews": PARTS["fact_reviews"] + " AND ts < TIMESTAMP '2024-01-16'",
    "decayed": PARTS["decayed"].replace("2024-02-01", "2024-01-16"),
    "purchase_counts": "SELECT book_id, count(*) AS purchase_count FROM fact_sales GROUP BY book_id",
}


def _needs(text: str, parts: dict[str, str]) -> list[str]:
    """Names of the parts a text refers to, each after the parts it needs itself."""
    import re

    out: list[str] = []

    def visit(sql: str, skip: str) -> None:
        for word in re.findall(r"\b[a-z_0-9]+\b", sql):
            if word in parts and word != skip and word not in out:
                visit(parts[word], word)
                out.append(word)

    visit(text, "")
    return out


def build(text: str, changed: dict[str, str] | None = None) -> str:
    """The query with the parts it needs as common table expressions."""
    parts = {**PARTS, **(changed or {})}
    heads = ",\n".join(f"{name} AS ({parts[name].strip()})" for name in _needs(text, parts))
    return f"WITH {heads}\n{text.strip()}" if heads else text.strip()


BODIES: dict[str, str] = {
    "param_sql": """
        SELECT item_status, count(*) AS n_lines, round(sum(line_total), 2) AS total FROM fact_sales
        WHERE quantity >= 10 AND order_date >= TIMESTAMP '2020-01-01' GROUP BY item_status""",
    "scan_tables": """
        SELECT 'dim_books' AS table_name, count(*) AS row_count FROM catalogue
        UNION ALL SELECT 'dim_date', count(*) FROM dates
        UNION ALL SELECT 'dim_users', count(*) FROM dim_users
        UNION ALL SELECT 'fact_cart', count(*) FROM fact_cart
        UNION ALL SELECT 'fact_reviews', count(*) FROM fact_reviews
        UNION ALL SELECT 'fact_sales', count(*) FROM fact_sales""",
    "published_tables": """
        SELECT user_id, n_books, n_lines, total FROM user_n JOIN (
            SELECT buyer_id AS user_id, count(*) AS n_lines, round(sum(line_total), 2) AS total FROM fact_sales
            GROUP BY buyer_id) USING (user_id)""",
    "preview_rows": "SELECT * FROM catalogue ORDER BY book_id LIMIT 5",
    "source_manifest": """
        SELECT 'lineitem' AS table_name, true AS present, count(*) AS row_count, CAST(11 AS BIGINT) AS column_count FROM lineitem
        UNION ALL SELECT 'orders', true, count(*), 6 FROM orders
        UNION ALL SELECT 'part', true, count(*), 6 FROM part
        UNION ALL SELECT 'customer', true, count(*), 5 FROM customer
        UNION ALL SELECT 'supplier', true, count(*), 4 FROM supplier
        UNION ALL SELECT 'events', true, count(*), 6 FROM events
        UNION ALL SELECT 'embeddings', true, count(*), 3 FROM embeddings""",
    "factors_roundtrip": """
        SELECT kind, id, CAST(len(f) AS BIGINT) AS n_factors, round(list_dot_product(f, f), 6) AS squared_norm
        FROM vectors, (SELECT unnest(['user', 'item']) AS kind)""",
    "csv_roundtrip": """
        SELECT author, book_id, category_name, price, purchase_count, rating_avg,
               CAST(NULL AS VARCHAR) AS seller_username, title FROM dim_books""",
    "json_seed": """
        SELECT 'buyer' AS kind, c_name AS name, CAST(NULL AS VARCHAR) AS author,
               CAST(NULL AS VARCHAR) AS category_name, CAST(NULL AS DOUBLE) AS price FROM customer
        UNION ALL SELECT 'seller', s_name, NULL, NULL, NULL FROM supplier
        UNION ALL SELECT 'product', p_name, p_brand, p_type, p_retailprice FROM part""",
    "completed_sales": """
        SELECT order_id, buyer_id, book_id, order_date, quantity, line_total FROM fact_sales
        WHERE item_status = 'completed'""",
    "positive_reviews": "SELECT review_id, book_id, buyer_id, score, snapshot_date FROM fact_reviews WHERE score >= 4",
    "event_union": "SELECT * FROM event_rows",
    "decayed_events": """
        SELECT user_id, book_id, event_ts, base_score, round(decayed_score, 6) AS decayed_score FROM decayed""",
    "interaction_scores": "SELECT user_id, book_id, round(interaction_score, 6) AS interaction_score FROM scores",
    "validated_interactions": """
        SELECT user_id, book_id, round(interaction_score, 6) AS interaction_score FROM scores
        WHERE interaction_score > 0""",
    "quality_counts": """
        SELECT count(*) AS row_count, count(*) FILTER (interaction_score IS NULL) AS null_scores,
               count(*) FILTER (interaction_score <= 0) AS non_positive_scores FROM scores""",
    "single_user": """
        SELECT user_id, book_id, round(interaction_score, 6) AS interaction_score FROM scores
        WHERE user_id = (SELECT user_id FROM scores GROUP BY user_id
                         ORDER BY round(sum(interaction_score), 6) DESC, user_id LIMIT 1)""",
    "eval_period": """
        SELECT order_id, buyer_id, book_id, order_date FROM fact_sales
        WHERE item_status = 'completed' AND year(order_date) = 2024 AND month(order_date) = 1""",
    "user_counts": "SELECT * FROM kept_n",
    "book_counts": "SELECT * FROM book_n",
    "interaction_stats": """
        SELECT count(*) AS row_count, count(DISTINCT user_id) AS n_users, count(DISTINCT book_id) AS n_books
        FROM scores""",
    "score_describe": """
        SELECT s.statistic, round(s.value, 6) AS value FROM (
            SELECT unnest([
                {'statistic': 'count', 'value': CAST(count(*) AS DOUBLE)}, {'statistic': 'mean', 'value': avg(x)},
                {'statistic': 'std', 'value': stddev_samp(x)}, {'statistic': 'min', 'value': min(x)},
                {'statistic': '25%', 'value': quantile_cont(x, 0.25)},
                {'statistic': '50%', 'value': quantile_cont(x, 0.5)},
                {'statistic': '75%', 'value': quantile_cont(x, 0.75)}, {'statistic': 'max', 'value': max(x)}]) AS s
            FROM (SELECT round(interaction_score, 6) AS x FROM scores))""",
    "count_distribution": """
        SELECT coalesce(min(n_books), 0) AS min_n, coalesce(max(n_books), 0) AS max_n,
               coalesce(quantile_cont(n_books, 0.5), 0) AS median_n FROM user_n""",
    "warm_interactions": "SELECT user_id, book_id, round(interaction_score, 6) AS interaction_score FROM kept",
    "cold_books": "SELECT * FROM book_n WHERE n_users < 8",
    "user_universe": "SELECT user_id FROM dim_users UNION SELECT user_id FROM kept",
    "user_groups": "SELECT * FROM groups",
    "group_sizes": "SELECT user_group, count(*) AS n_users FROM groups GROUP BY user_group",
    "percent_rank_pop": """
        SELECT book_id, purchase_count, rating_avg, round(purchase_rank, 6) AS purchase_rank,
               round(rating_rank, 6) AS rating_rank FROM ranked_books""",
    "popularity_pool": "SELECT * FROM pool",
    "popularity_sample": """
        SELECT user_id, book_id, title, popularity_score, rank FROM sample_all
        WHERE rank <= 5 AND user_id IN (SELECT user_id FROM dim_users)""",
    "cold_recs": """
        SELECT user_id, user_group, book_id, title, popularity_score, rank
        FROM sample_all JOIN groups USING (user_id) WHERE rank <= 5 AND user_group <> 'warm'""",
    "hybrid_blend": """
        SELECT user_id, book_id, CAST(round(CAST(hybrid_score AS DECIMAL(20, 12)), 6) AS DOUBLE) AS hybrid_score, rank
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hybrid_score DESC, book_id) AS rank
            FROM (SELECT user_id, book_id, round(coalesce(mf_score, 0) * CAST(0.3 AS DOUBLE)
                      + coalesce(popularity_score, 0) * CAST(0.7 AS DOUBLE), 12) AS hybrid_score
                  FROM cands FULL JOIN (SELECT user_id, book_id, popularity_score FROM sample_all
                      WHERE rank <= 5 AND user_id IN (SELECT user_id FROM cands)) USING (user_id, book_id)))
        WHERE rank <= 5""",
    "cold_book_similar": """
        SELECT book_id, similar_book_id, round(similarity, 6) + 0.0 AS similarity, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY similarity DESC, similar_book_id) AS rank
            FROM (SELECT a.book_id, b.book_id AS similar_book_id, round(sum(a.w * b.w), 12) + 0.0 AS similarity
                  FROM content a JOIN content b USING (term)
                  WHERE a.book_id IN (SELECT book_id FROM is_cold WHERE cold)
                    AND b.book_id IN (SELECT book_id FROM is_cold WHERE NOT cold)
                  GROUP BY a.book_id, b.book_id)) WHERE rank <= 5""",
    "category_weights": "SELECT * FROM category_w",
    "author_weights": "SELECT * FROM author_w",
    "top_categories": "SELECT * FROM top_cat",
    "top_authors": "SELECT * FROM top_aut",
    "recent_purchases": "SELECT * FROM recent",
    "high_rated": "SELECT * FROM rated",
    "user_profiles": "SELECT * FROM profiles WHERE user_id IN (SELECT user_id FROM kept)",
    "item_descriptions": "SELECT * FROM descriptions",
    "candidate_books": """
        SELECT book_id, title, author, category_name, rating_avg, purchase_count FROM dim_books
        WHERE book_id IN (SELECT book_id FROM cands)""",
    "missing_books": """
        SELECT DISTINCT book_id FROM sale_lines
        WHERE book_id NOT IN (SELECT book_id FROM dim_books WHERE rating_avg > 0)""",
    "score_pairs": """
        SELECT user_id, book_id, coalesce(round(list_dot_product(u.f, v.f), 6), 0) + 0.0 AS mf_score
        FROM scores LEFT JOIN vectors u ON u.id = user_id LEFT JOIN vectors v ON v.id = book_id""",
    "dot_topk": """
        SELECT user_id, book_id, round(mf_score, 6) + 0.0 AS mf_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY mf_score DESC, book_id) AS rank
                       FROM dots) WHERE rank <= 50""",
    "candidates_topk": """
        SELECT user_id, book_id AS candidate_book_id, round(mf_score, 6) + 0.0 AS mf_score, rank FROM cands""",
    "candidates_overfetch": """
        SELECT user_id, book_id AS candidate_book_id, round(mf_score, 6) + 0.0 AS mf_score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY mf_score DESC, book_id) AS rank
            FROM depth_100 d WHERE NOT EXISTS (
                SELECT 1 FROM scores s WHERE s.user_id = d.user_id AND s.book_id = d.book_id))
        WHERE rank <= 50""",
    "negative_samples": """
        SELECT s.user_id, s.book_id, 0 AS draw, l.book_id AS negative_book_id
        FROM scores s JOIN lacking l ON l.user_id = s.user_id
            AND l.nth = CAST('0x' || substr(md5(concat('42:0:', s.user_id, ':', s.book_id, ':0')), 1, 12) AS BIGINT) % l.n_free""",
    "als_factors": """
        SELECT DISTINCT 'user' AS kind, user_id AS id, CAST(64 AS BIGINT) AS n_factors, true AS is_finite FROM kept
        UNION ALL SELECT DISTINCT 'item', book_id, 64, true FROM kept""",
    "bpr_factors": """
        SELECT DISTINCT 'user' AS kind, user_id AS id, CAST(64 AS BIGINT) AS n_factors, true AS is_finite FROM kept
        UNION ALL SELECT DISTINCT 'item', book_id, 64, true FROM kept""",
    "bpr_ranking": """
        SELECT 'learnt' AS pairs, count(*) AS n_pairs, 'PASS' AS status FROM halved
        WHERE book_id + 1 IN (SELECT book_id FROM halved)
        UNION ALL SELECT 'later', count(*), 'PASS' FROM halved_later WHERE book_id + 1 IN (SELECT book_id FROM halved)""",
    "als_ranking": """
        SELECT 'learnt' AS pairs, count(*) AS n_pairs, 'PASS' AS status FROM halved
        WHERE book_id + 1 IN (SELECT book_id FROM halved)
        UNION ALL SELECT 'later', count(*), 'PASS' FROM halved_later WHERE book_id + 1 IN (SELECT book_id FROM halved)""",
    "candidate_lists": """
        SELECT user_id, string_agg(CAST(book_id AS VARCHAR), ',' ORDER BY rank) AS books FROM cands GROUP BY user_id""",
    "candidate_quality": """
        SELECT count(*) AS candidate_rows, count(s.user_id) AS leaked_rows
        FROM cands LEFT JOIN scores s USING (user_id, book_id)""",
    "warm_candidates": """
        SELECT user_id, book_id AS candidate_book_id, round(mf_score, 6) + 0.0 AS mf_score, rank FROM cands
        WHERE user_id IN (SELECT user_id FROM groups WHERE user_group = 'warm')""",
    "unseen_pairs": """
        SELECT buyer_id AS user_id, book_id FROM fact_cart
        EXCEPT SELECT buyer_id, book_id FROM fact_sales WHERE item_status = 'completed'""",
    "recommend_subset": """
        SELECT user_id, CAST(coalesce(top_k, 5) AS BIGINT) AS top_k, book_id, round(mf_score, 6) + 0.0 AS mf_score, rank
        FROM requests JOIN (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY mf_score DESC, book_id) AS rank FROM dots) USING (user_id)
        WHERE rank <= coalesce(top_k, 5)""",
    "reranked": """
        SELECT user_id, book_id, round(mf_score, 6) AS mf_score, round(semantic_score, 6) AS semantic_score, rank
        FROM reranked_all WHERE rank <= 5""",
    "pair_score": """
        SELECT user_id, book_id, round(1 / (1 + exp(-(4 * CAST(common AS DOUBLE) / (both_n - common) - 1))), 6) AS score
        FROM pairs""",
    "pair_lengths": """
        SELECT user_id, book_id, least(a, greatest(24 - b, 12)) AS profile_words, least(b, greatest(24 - a, 12)) AS description_words
        FROM cands JOIN (SELECT user_id, len(regexp_split_to_array(user_profile, '\\s+')) AS a FROM profiles) USING (user_id)
        JOIN (SELECT book_id, len(regexp_split_to_array(item_description, '\\s+')) AS b FROM descriptions) USING (book_id)""",
    "temporal_split": """
        SELECT user_id, book_id, event_ts, CASE WHEN event_ts < TIMESTAMP '2024-01-08' THEN 'train'
            WHEN event_ts < TIMESTAMP '2024-01-16' THEN 'validation' ELSE 'test' END AS split
        FROM event_rows""",
    "ground_truth": "SELECT * FROM truth",
    "gt_stats": """
        SELECT count(DISTINCT user_id) AS n_users, count(*) AS n_pairs,
               round(count(*) / greatest(count(DISTINCT user_id), 1), 6) AS mean_relevant FROM truth""",
    "relevant_retrieved": "SELECT user_id, book_id, rank FROM cands JOIN truth USING (user_id, book_id)",
    "recall_at_k": "SELECT round(coalesce(avg(hits50 / relevant), 0), 6) AS recall FROM metric_users",
    "hit_rate_at_k": """
        SELECT round(coalesce(avg(CASE WHEN hits50 > 0 THEN 1.0 ELSE 0.0 END), 0), 6) AS hit_rate FROM metric_users""",
    "ndcg_at_k": "SELECT round(coalesce(avg(ndcg), 0), 6) AS ndcg FROM order_users",
    "map_at_k": "SELECT round(coalesce(avg(ap), 0), 6) AS map FROM order_users",
    "mrr": "SELECT round(coalesce(avg(rr), 0), 6) AS mrr FROM order_users",
    "metric_report": """
        SELECT metric, value, target, CASE WHEN value >= target THEN 'PASS' ELSE 'FAIL' END AS status FROM (
            SELECT 'recall' AS metric, round(avg(hits50 / relevant), 6) AS value, CAST(0.75 AS DOUBLE) AS target FROM metric_users
            UNION ALL SELECT 'hit_rate', round(avg(CASE WHEN hits50 > 0 THEN 1.0 ELSE 0.0 END), 6), 0.85 FROM metric_users
            UNION ALL SELECT 'ndcg', round(avg(ndcg), 6), 0.35 FROM order_users
            UNION ALL SELECT 'map', round(avg(ap), 6), 0.25 FROM order_users
            UNION ALL SELECT 'mrr', round(avg(rr), 6), 0.4 FROM order_users)""",
    "lambda_sweep": """
        SELECT rate AS lambda_rate, round(avg(ndcg), 6) AS ndcg, round(avg(ap), 6) AS map
        FROM sweep_users GROUP BY rate""",
    "recommendations": "SELECT * EXCLUDE (top_k) FROM routed",
    "two_stage_batch": "SELECT * FROM routed",
    "book_purchase_count": "SELECT * FROM purchase_counts",
    "book_rating": "SELECT * FROM ratings",
    "dim_books": """
        SELECT book_id, title, author, category_name, price, 'unknown' AS seller_username,
               purchase_count, rating_avg FROM dim_books""",
    "dim_users": """
        SELECT user_id, username, 'Unknown' AS full_name, 'unknown@example.com' AS email,
               coalesce(nullif(role, 'HOUSEHOLD'), 'buyer') AS role, true AS is_active FROM dim_users""",
    "dim_date": """
        SELECT CAST(date AS VARCHAR) AS date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               CAST(day(date) AS INTEGER) AS day, dayname(date) AS day_of_week,
               CAST(quarter(date) AS INTEGER) AS quarter, dayofweek(date) IN (0, 6) AS is_weekend FROM dates""",
    "review_running_count": """
        SELECT review_id, book_id, row_number() OVER (PARTITION BY book_id
            ORDER BY snapshot_date, buyer_id, review_id) AS total_reviews_at_snapshot FROM fact_reviews""",
    "surrogate_keys": """
        SELECT row_number() OVER (ORDER BY md5(username)) AS user_key, username
        FROM (SELECT DISTINCT username FROM dim_users)""",
    "sales_line_total": """
        SELECT order_id, k.book_id, s.seller_id, quantity, c.price AS unit_price,
               round(c.price * quantity, 2) AS line_total
        FROM sale_lines s JOIN catalogue c ON c.book_id = s.book_id
        JOIN (SELECT title, max(book_id) AS book_id FROM catalogue GROUP BY title) k USING (title)""",
    "clean_texts": r"""
        SELECT doc_id, md5(c) AS text_md5, length(c) AS n_chars FROM (
            SELECT doc_id, coalesce(nullif(trim(regexp_replace(nfc_normalize(text),
                '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), ''), 'Unknown') AS c
            FROM documents)""",
    "snapshot_valid": "SELECT * FROM stored WHERE expires_at > TIMESTAMP '2024-01-31 12:00:00' AND model_version = 1",
    "snapshot_store": """
        SELECT user_id, book_id, rank,
               CASE WHEN stale THEN TIMESTAMP '2024-01-31 12:00:00' ELSE TIMESTAMP '2024-01-16' END AS generated_at
        FROM (SELECT *, user_id IN (SELECT user_id FROM all_changes WHERE event_ts > TIMESTAMP '2024-01-16') AS stale FROM cands)
        WHERE user_id % 7 <> 3 AND rank <= CASE WHEN stale THEN 5 ELSE 10 END""",
    "stale_lists": """
        SELECT DISTINCT user_id, TIMESTAMP '2024-01-16' AS generated_at, CAST(1 AS BIGINT) AS n_marks FROM events
        WHERE event_type IN ('purchase', 'view') AND ts > TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-26'
            AND user_id IN (SELECT user_id FROM scores)""",
    "changed_users": """
        SELECT user_id, max(ts) AS last_event FROM events WHERE event_type IN ('purchase', 'view') GROUP BY user_id""",
    "daily_volume": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_events FROM events GROUP BY CAST(ts AS DATE) HAVING count(*) >= 340",
    "forward_decay": "SELECT user_id, book_id, round(interaction_score, 6) AS interaction_score FROM scores",
    "dedup_events": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
}

# Users with a train interaction have a stored list made at the cut.
STALE_USERS = """
    SELECT user_id, max(event_ts) AS last_event FROM (
        SELECT buyer_id AS user_id, order_date AS event_ts FROM all_sales WHERE item_status = 'completed'
        UNION ALL SELECT buyer_id, snapshot_date FROM all_reviews)
    WHERE user_id IN (SELECT user_id FROM scores)
    GROUP BY user_id HAVING max(event_ts) > TIMESTAMP '2024-01-16'"""

# In the routed flow only books that enough users know are candidates.
FLOW = {
    "cands": PARTS["cands"].replace(
        "FROM dots d WHERE", "FROM dots d WHERE book_id IN (SELECT book_id FROM kept) AND"
    )
}

# Without requests every known user gets a list of five.
ALL_ROUTES = FLOW | {"routes": "SELECT user_id, CAST(5 AS BIGINT) AS top_k, user_group FROM served"}

# The decay rate is chosen on the days before the test days.
VALIDATION = {name: text.replace("2024-01-16", "2024-01-08") for name, text in TRAIN.items()} | {
    "truth": PARTS["truth"].replace("2024-01-16", "2024-01-08").replace("2024-02-01", "2024-01-16")
}

# Queries over train-period lists.
TRAIN_KEYS = {
    "relevant_retrieved",
    "recall_at_k",
    "hit_rate_at_k",
    "ndcg_at_k",
    "map_at_k",
    "mrr",
    "metric_report",
    "stale_users",
    "bpr_ranking",
    "als_ranking",
    "stale_lists",
}


def oracle_sql() -> dict[str, str]:
    bodies = {**BODIES, "stale_users": STALE_USERS}
    changed = {name: TRAIN for name in TRAIN_KEYS} | {
        "recommendations": ALL_ROUTES,
        "snapshot_valid": ALL_ROUTES,
        "two_stage_batch": FLOW,
        "lambda_sweep": VALIDATION,
    }
    return {name: build(body, changed.get(name)) for name, body in bodies.items()}
