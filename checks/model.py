"""DuckDB views of the menu model over the driver's tables, for the SQL oracles.

Each entry is one common table expression; :func:`over_model` prefixes a statement with the
ones it uses. Written independently of the Spark code, from the definitions in FIXTURES.md.
"""

from __future__ import annotations

import re

MODEL: dict[str, str] = {
    "order_lines": """
        SELECT l.*, date_trunc('month', o.o_orderdate)::DATE AS month, o.o_orderpriority
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "menus": """
        SELECT o_orderkey AS id, 'menu/' || o_orderkey AS url,
               (year(o_orderdate) * 100 + week(o_orderdate))::INTEGER AS year_week,
               date_trunc('month', o_orderdate)::DATE AS start_date,
               date_trunc('month', o_orderdate)::DATE AS first_seen_date,
               o_orderdate::DATE AS last_seen_date,
               (o_orderstatus <> 'P')::INTEGER AS is_active
        FROM orders""",
    "recipe_spans": """
        SELECT l_partkey, min(month) AS lo, max(month) AS hi FROM order_lines GROUP BY 1""",
    "recipes": """
        SELECT p_partkey AS id, p_name AS name, p_brand AS headline,
               p_size::DOUBLE AS difficulty,
               CASE p_size % 10 WHEN 0 THEN NULL WHEN 5 THEN p_size::VARCHAR
                    ELSE p_size || ' mins' END AS prep_time,
               (p_size + 10) || ' mins' AS total_time,
               CASE WHEN p_size % 17 <> 0 THEN p_type END AS cuisine,
               lo AS first_seen_date, hi AS last_seen_date,
               coalesce(hi >= DATE '2001-06-01', false)::INTEGER AS is_active
        FROM part LEFT JOIN recipe_spans ON l_partkey = p_partkey""",
    "ingredients": """
        SELECT s_suppkey AS ingredient_id, s_name AS name, n_name AS family,
               (s_acctbal >= 0)::INTEGER AS is_active,
               min(l_shipdate)::DATE AS first_seen_date,
               max(l_shipdate)::DATE AS last_seen_date
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
        LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY ALL""",
    "allergens": """
        SELECT p_brand AS allergen_id, p_brand AS name, 'brand' AS type,
               min(first_seen_date) AS first_seen_date, max(last_seen_date) AS last_seen_date,
               max(is_active) AS is_active
        FROM part JOIN recipes ON id = p_partkey GROUP BY p_brand""",
    "tags": """
        SELECT p_type AS tag_id, p_type AS name, 'type' AS type,
               min(first_seen_date) AS first_seen_date, max(last_seen_date) AS last_seen_date,
               max(is_active) AS is_active
        FROM part JOIN recipes ON id = p_partkey GROUP BY p_type""",
    "labels": """
        SELECT o_orderpriority AS label_id, o_orderpriority AS name,
               min(start_date) AS first_seen_date, max(start_date) AS last_seen_date,
               max(is_active) AS is_active
        FROM orders JOIN menus ON id = o_orderkey GROUP BY o_orderpriority""",
    "menu_recipes": """
        SELECT l_orderkey AS menu_id, l_partkey AS recipe_id,
               (min(l_linenumber) - 1)::INTEGER AS position,
               min(l_shipdate)::DATE AS first_seen_date, max(l_shipdate)::DATE AS last_seen_date,
               bool_or(l_returnflag <> 'R')::INTEGER AS is_active
        FROM lineitem GROUP BY 1, 2""",
    "recipe_ingredients": """
        SELECT l_partkey AS recipe_id, l_suppkey AS ingredient_id,
               (min(l_linenumber) - 1)::INTEGER AS position,
               sum(l_quantity)::BIGINT AS quantity, min(l_linestatus) AS unit,
               min(l_shipdate)::DATE AS first_seen_date, max(l_shipdate)::DATE AS last_seen_date,
               bool_or(l_returnflag <> 'R')::INTEGER AS is_active
        FROM lineitem GROUP BY 1, 2""",
    "recipe_allergens": """
        SELECT p_partkey AS recipe_id, p_brand AS allergen_id, lo AS first_seen_date,
               hi AS last_seen_date, (p_size > 4)::INTEGER AS is_active
        FROM part LEFT JOIN recipe_spans ON l_partkey = p_partkey""",
    "recipe_tags": """
        SELECT p_partkey AS recipe_id, p_type AS tag_id, lo AS first_seen_date,
               hi AS last_seen_date, (p_size % 9 <> 0)::INTEGER AS is_active
        FROM part LEFT JOIN recipe_spans ON l_partkey = p_partkey""",
    "recipe_labels": """
        SELECT l_partkey AS recipe_id, o_orderpriority AS label_id,
               min(month) AS first_seen_date, max(month) AS last_seen_date,
               bool_or(l_returnflag <> 'R')::INTEGER AS is_active
        FROM order_lines GROUP BY 1, 2""",
    "api_responses": """
        SELECT event_id, ts::DATE AS pull_date, event_type AS endpoint, 'en-GB' AS locale,
               user_id AS page_number, props AS payload, ts AS ingestion_timestamp
        FROM events""",
    # Gold tables, computed row-wise (no pre-aggregation) so that they check the Spark plans.
    "menu_rows": """
        SELECT m.start_date AS wk, m.is_active AS menu_on, x.recipe_id, r.id AS known_id,
               r.first_seen_date, r.difficulty, r.prep_time
        FROM menus m
        LEFT JOIN menu_recipes x ON x.menu_id = m.id AND x.is_active = 1
        LEFT JOIN recipes r ON r.id = x.recipe_id
        WHERE m.start_date IS NOT NULL""",
    "live_rows": "SELECT * FROM menu_rows WHERE menu_on = 1",
    "weekly_menu_metrics": r"""
        SELECT wk AS week_start_date, 'en-GB' AS locale,
               count(DISTINCT recipe_id) AS total_recipes,
               count(DISTINCT recipe_id) AS unique_recipes,
               count(DISTINCT recipe_id) FILTER (first_seen_date = wk) AS new_recipes,
               count(DISTINCT recipe_id) FILTER (first_seen_date < wk) AS returning_recipes,
               round(avg(difficulty), 2) AS avg_difficulty,
               round(avg(try_cast(regexp_extract(prep_time, '^\s*(\d+)', 1) AS INTEGER)), 2)
                   AS avg_prep_time_minutes
        FROM live_rows GROUP BY wk""",
    "weekly_menu_metrics_compat": r"""
        SELECT wk AS week_start_date, 'en-GB' AS locale,
               count(DISTINCT recipe_id) AS total_recipes,
               count(DISTINCT recipe_id) AS unique_recipes,
               count(*) FILTER (first_seen_date = wk) AS new_recipes,
               count(*) FILTER (first_seen_date < wk) AS returning_recipes,
               round(avg(difficulty), 2) AS avg_difficulty,
               round(avg(CASE WHEN contains(prep_time, ' ')
                              THEN split_part(prep_time, ' ', 1)::INTEGER ELSE 0 END), 2)
                   AS avg_prep_time_minutes
        FROM live_rows GROUP BY wk""",
    "recipe_survival_metrics": """
        SELECT id AS recipe_id, name AS recipe_name,
               first_seen_date AS first_appearance_date,
               last_seen_date AS last_appearance_date,
               CASE WHEN last_seen_date IS NOT NULL THEN
                    greatest(1, trunc((last_seen_date - first_seen_date) / 7 + 1))::INTEGER
               END AS total_weeks_active,
               CASE WHEN is_active = 0 THEN 0 ELSE
                    greatest(1, trunc((last_seen_date - first_seen_date) / 7 + 1))::INTEGER
               END AS consecutive_weeks_active,
               CASE WHEN last_seen_date IS NOT NULL THEN
                    greatest(0, trunc((DATE '2001-09-01' - last_seen_date) / 7))::INTEGER
               END AS weeks_since_last_seen,
               is_active AS is_currently_active
        FROM recipes""",
    "ingredient_counts": """
        SELECT i.ingredient_id, i.name AS ingredient_name, w.wk AS week_start_date,
               count(DISTINCT w.known_id) AS recipe_count
        FROM menu_rows w
        JOIN recipe_ingredients x ON x.recipe_id = w.known_id AND x.is_active = 1
        JOIN ingredients i ON i.ingredient_id = x.ingredient_id AND i.is_active = 1
        GROUP BY ALL""",
    "ingredient_trends": """
        SELECT *, recipe_count - lag(recipe_count) OVER (
                      PARTITION BY ingredient_id ORDER BY week_start_date)
                  AS week_over_week_change,
               row_number() OVER (PARTITION BY week_start_date ORDER BY recipe_count DESC,
                      ingredient_id)
                  AS popularity_rank
        FROM ingredient_counts""",
    "week_sets": """
        SELECT wk, list(DISTINCT recipe_id) FILTER (recipe_id IS NOT NULL) AS members
        FROM live_rows GROUP BY wk""",
    "week_pairs": """
        SELECT wk, coalesce(members, []) AS cur,
               lag(coalesce(members, [])) OVER (ORDER BY wk) AS prev
        FROM week_sets""",
    "week_overlap": """
        SELECT wk, len(cur) AS n_cur, len(prev) AS n_prev,
               coalesce(len(list_intersect(cur, prev)), 0) AS kept FROM week_pairs""",
    "menu_stability_metrics": """
        SELECT wk AS week_start_date, 'en-GB' AS locale,
               round(100e0 * kept / nullif(n_prev, 0), 2) AS overlap_with_prev_week,
               round(100e0 * (n_cur - kept) / nullif(n_prev, 0), 2) AS new_recipe_rate,
               round(100e0 * (n_prev - kept) / nullif(n_prev, 0), 2) AS churned_recipe_rate,
               kept AS recipes_retained, n_cur - kept AS recipes_added,
               coalesce(n_prev - kept, 0) AS recipes_removed
        FROM week_overlap""",
    "allergen_density": """
        SELECT a.allergen_id, w.wk AS week_start_date, a.name AS allergen_name,
               count(DISTINCT w.known_id) AS recipe_count,
               round(100e0 * count(DISTINCT w.known_id) / nullif((
                   SELECT count(DISTINCT t.recipe_id) FROM live_rows t WHERE t.wk = w.wk), 0),
                   2) AS percentage_of_menu
        FROM live_rows w
        JOIN recipe_allergens x ON x.recipe_id = w.known_id AND x.is_active = 1
        JOIN allergens a ON a.allergen_id = x.allergen_id
        GROUP BY a.allergen_id, a.name, w.wk""",
}


def _used(text: str) -> set[str]:
    return {name for name in MODEL if re.search(rf"\b{name}\b", text)}


def over_model(statement: str) -> str:
    """Prefix a SELECT with the model tables it uses, in dependency order."""
    wanted, queue = set(), list(_used(statement))
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue.extend(_used(MODEL[name]) - {name})
    tables = [f"{name} AS ({MODEL[name].strip()})" for name in MODEL if name in wanted]
    return ("WITH " + ",\n".join(tables) + "\n" if tables else "") + statement.strip()
