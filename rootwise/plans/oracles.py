"""The same results in plain SQL, worked out from the tables by other means."""

from __future__ import annotations

from rootwise.sources.generators import degree_sql

_FORMULAS = """
    SELECT 'P' || p_partkey AS id, p_name AS name,
           CASE WHEN p_partkey >= 2
                THEN 'item(P' || (p_partkey // 2) || ') + item(P' || (p_partkey // 3) || ') + ' || p_size
                ELSE CAST(p_size AS VARCHAR) END AS formula,
           CAST(0 AS INTEGER) AS value
    FROM part"""

# (src, dst, weight) as part keys.
_SUM_LINKS = """
    SELECT DISTINCT src, dst, weight FROM (
        SELECT p_partkey // 2 AS src, p_partkey AS dst, p_retailprice AS weight FROM part WHERE p_partkey >= 2
        UNION ALL
        SELECT p_partkey // 3, p_partkey, p_retailprice FROM part WHERE p_partkey >= 2)"""

# Depth by walking down all edges; few distinct (key, depth) pairs exist.
_SUM_DEPTH = f"""
    links AS ({_SUM_LINKS}),
    walk(k, d) AS (
        SELECT p_partkey, 1 FROM part WHERE p_partkey < 2
        UNION
        SELECT links.dst, walk.d + 1 FROM walk JOIN links ON links.src = walk.k),
    depths AS (SELECT k, CAST(max(d) AS INTEGER) AS depth FROM walk GROUP BY k)"""

# Value as the sum of the sizes met on all ways up.
_SUM_VALUES = """
    up(k, a) AS (
        SELECT p_partkey, p_partkey FROM part
        UNION ALL
        SELECT k, unnest([a // 2, a // 3]) FROM up WHERE a >= 2),
    vals AS (
        SELECT k, CAST(sum(p_size) AS BIGINT) AS v FROM up JOIN part ON p_partkey = a GROUP BY k)"""

_SHORTEST = f"""
    WITH RECURSIVE links AS ({_SUM_LINKS}),
    walk(k, far) AS (
        SELECT CAST(1 AS BIGINT), CAST(0 AS DOUBLE)
        UNION ALL
        SELECT links.dst, walk.far + links.weight FROM walk JOIN links ON links.src = walk.k),
    best AS (SELECT k, min(far) AS far FROM walk GROUP BY k)
    SELECT 'P' || p_partkey AS id, round(far, 2) AS distance
    FROM part LEFT JOIN best ON k = p_partkey"""

_ACCOUNTS = """
    accounts AS (
        SELECT 'N' || n_nationkey AS id, n_name AS name, CAST(n_regionkey - 1 AS DOUBLE) AS value FROM nation
        UNION ALL SELECT 'C' || c_custkey, c_name, c_acctbal FROM customer
        UNION ALL SELECT 'S' || s_suppkey, s_name, s_acctbal FROM supplier),
    ties AS (
        SELECT 'N' || c_nationkey AS src, 'C' || c_custkey AS dst FROM customer
        UNION ALL SELECT 'N' || s_nationkey, 'S' || s_suppkey FROM supplier),
    kept AS (SELECT * FROM accounts WHERE value >= 0),
    kept_ties AS (
        SELECT * FROM ties WHERE src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept))"""

_BELOW_NATION = """
    cust AS (SELECT * FROM customer WHERE c_nationkey = 3),
    ords AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM cust)),
    uses AS (
        SELECT DISTINCT l_orderkey, l_partkey FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM ords))"""

_BLOCK_LINKS = """
    links AS (
        SELECT p_partkey AS src,
               p_partkey - p_partkey % 10 + (p_partkey % 10 + p_size) % 10 AS dst FROM part
        UNION
        SELECT p_partkey, (p_partkey // 20) * 10 FROM part)"""

_BLOCK_GROUPS = f"""
    {_BLOCK_LINKS},
    below(a, b) AS (
        SELECT src, dst FROM links
        UNION
        SELECT below.a, links.dst FROM below JOIN links ON links.src = below.b),
    mutual AS (
        SELECT x.a, x.b FROM below x JOIN below y ON y.a = x.b AND y.b = x.a WHERE x.a <> x.b),
    members AS (
        SELECT least('P' || a, min('P' || b)) AS cycle_id, a AS k FROM mutual GROUP BY a
        UNION ALL
        SELECT 'P' || src || '#self', src FROM links WHERE src = dst)"""

_BLOCK_AFFECTED = f"""
    {_BLOCK_GROUPS},
    affected AS (
        SELECT cycle_id, k FROM members
        UNION
        SELECT cycle_id, b FROM members JOIN below ON a = k)"""

# One row per part with its state under its only possible parent, part k/2.
_FAULTY = """
    walk(k, depth, state, value, status) AS (
        SELECT p_partkey, CAST(1 AS INTEGER), CAST('reached' AS VARCHAR),
               CAST(p_size AS DOUBLE), CAST('ok' AS VARCHAR)
        FROM part WHERE p_partkey = 0
        UNION ALL
        SELECT k, depth, state, value,
               CASE WHEN p_size = 31 THEN 'no_formula'
                    WHEN state = 'below_cycle' THEN 'blocked'
                    WHEN state <> 'reached' THEN state
                    WHEN value IS NOT NULL THEN 'ok'
                    WHEN p_size = 17 AND sent IS NOT NULL THEN 'parse_error'
                    ELSE 'blocked' END
        FROM (
            SELECT k, depth, state, sent, p_size,
                   CASE WHEN state <> 'reached' OR p_size IN (13, 17, 37) THEN NULL
                        WHEN p_size = 19 THEN sent * CAST('inf' AS DOUBLE)
                        ELSE sent + p_size END AS value
            FROM (
                SELECT p.p_partkey AS k, p.p_size,
                       CASE WHEN p.p_size IN (11, 29, 31) OR w.state = 'unreachable' THEN 'unreachable'
                            WHEN p.p_size = 23 THEN 'cyclic'
                            WHEN w.state = 'reached' THEN 'reached'
                            ELSE 'below_cycle' END AS state,
                       CASE WHEN p.p_size NOT IN (11, 29, 31, 23) AND w.state = 'reached'
                            THEN w.depth + 1 END AS depth,
                       CASE WHEN w.value < CAST('inf' AS DOUBLE) THEN trunc(w.value) END AS sent
                FROM walk w JOIN part p ON p.p_partkey // 2 = w.k AND p.p_partkey > 0)))"""

_RINGS = """
    up AS (
        SELECT p_partkey AS k, p_name,
               p_partkey - p_partkey % 10 + (p_partkey % 10 + p_size) % 10 AS parent FROM part),
    walk(k, here, step) AS (
        SELECT k, k, 0 FROM up
        UNION ALL
        SELECT walk.k, up.parent, step + 1 FROM walk JOIN up ON up.k = walk.here WHERE step < 20),
    rings AS (SELECT k, min(step) AS n FROM walk WHERE here = k AND step > 0 GROUP BY k),
    levels AS (
        SELECT walk.k, min(step) AS off, arg_min(n, step) + min(step) AS level
        FROM walk JOIN rings ON rings.k = walk.here GROUP BY walk.k),
    rows_up AS (
        SELECT walk.k, level, string_agg('P' || here, '/' ORDER BY step DESC) AS path,
               arg_max('P' || here, step) AS root
        FROM walk JOIN levels ON levels.k = walk.k WHERE step < level GROUP BY walk.k, level)"""

def _log_normal(seed: int, count: str) -> str:
    """``links(src, dst)`` over all parts; ``count`` is a scalar SQL expression."""
    def draw(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"

    return f"""
    sizes AS (SELECT {count} AS count),
    drawn AS (SELECT p_partkey AS src, {draw(f"'{seed}-degree-' || p_partkey")} AS draw FROM part),
    degrees AS (
        SELECT src, CAST({degree_sql("draw", "count")} AS INTEGER) AS degree
        FROM drawn, sizes),
    outs AS (SELECT src, unnest(range(1, degree + 1)) AS nth FROM degrees WHERE degree > 0),
    links AS (
        SELECT src, {draw(f"'{seed}-target-' || src || '-' || nth")} % (SELECT count FROM sizes) AS dst FROM outs)"""


ORACLES = {
    "formula_vertices": f"{_FORMULAS} UNION ALL SELECT 'r00t', 'root', '', 0",
    "formula_edges": f"SELECT 'P' || dst AS dst, 'P' || src AS src FROM ({_SUM_LINKS})",
    "formula_root_edges": "SELECT 'P' || p_partkey AS dst, 'r00t' AS src FROM part WHERE p_partkey < 2",
    "named_views": f"""
        SELECT 'P' || p_partkey AS id, CASE WHEN p_partkey < 2 THEN 1 ELSE count(src) END AS parents
        FROM part LEFT JOIN ({_SUM_LINKS}) ON dst = p_partkey GROUP BY p_partkey
        UNION ALL SELECT 'r00t', 0""",
    "graph_problems": """
        SELECT CASE WHEN v > 1 THEN 'duplicate_id' ELSE 'dangling_end' END AS problem, id,
               CAST(CASE WHEN v > 1 THEN v ELSE e END AS BIGINT) AS n
        FROM (
            SELECT id, sum(v) AS v, sum(e) AS e FROM (
                SELECT 'O' || l_orderkey AS id, 1 AS v, 0 AS e FROM lineitem
                UNION ALL SELECT 'O' || o_orderkey, 0, 1 FROM orders
                UNION ALL SELECT 'C' || o_custkey, 0, 1 FROM orders)
            GROUP BY id)
        WHERE v > 1 OR v = 0""",
    "induced_subgraph_vertices": f"WITH {_ACCOUNTS} SELECT id, name, value FROM kept",
    "induced_subgraph_edges": f"WITH {_ACCOUNTS} SELECT src, dst FROM kept_ties",
    "drop_isolated": f"""
        WITH {_ACCOUNTS} SELECT id, name, value FROM kept
        WHERE id IN (SELECT src FROM kept_ties UNION SELECT dst FROM kept_ties)""",
    "region_hops": """
        SELECT 'R' || r_regionkey AS id, 'R' || r_regionkey AS landmark, CAST(0 AS INTEGER) AS distance FROM region
        UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 1 FROM nation
        UNION ALL SELECT 'C' || c_custkey, 'R' || n_regionkey, 2 FROM customer JOIN nation ON n_nationkey = c_nationkey
        UNION ALL SELECT 'S' || s_suppkey, 'R' || n_regionkey, 2 FROM supplier JOIN nation ON n_nationkey = s_nationkey
        UNION ALL SELECT DISTINCT 'P' || l_partkey, 'R' || n_regionkey, 3
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "reachable_subgraph_vertices": f"""
        WITH {_BELOW_NATION}
        SELECT 'N' || n_nationkey AS id, n_name AS name, CAST(0 AS DOUBLE) AS value FROM nation WHERE n_nationkey = 3
        UNION ALL SELECT 'C' || c_custkey, c_name, c_acctbal FROM cust
        UNION ALL SELECT 'O' || o_orderkey, o_orderstatus, o_totalprice FROM ords
        UNION ALL SELECT 'P' || p_partkey, p_name, p_retailprice FROM part
        WHERE p_partkey IN (SELECT l_partkey FROM uses)""",
    "reachable_subgraph_edges": f"""
        WITH {_BELOW_NATION}
        SELECT 'N3' AS src, 'C' || c_custkey AS dst FROM cust
        UNION ALL SELECT 'C' || o_custkey, 'O' || o_orderkey FROM ords
        UNION ALL SELECT 'O' || l_orderkey, 'P' || l_partkey FROM uses""",
    "reachable_ring": """
        WITH RECURSIVE links AS (
            SELECT p_partkey AS src, (p_partkey + p_size) % (SELECT count(*) FROM part) AS dst FROM part
            UNION SELECT p_partkey, p_partkey // 2 FROM part),
        hit(k) AS (
            SELECT CAST(1 AS BIGINT)
            UNION SELECT links.dst FROM hit JOIN links ON links.src = hit.k)
        SELECT 'P' || p_partkey AS id, p_name AS name, p_retailprice AS value
        FROM part WHERE p_partkey IN (SELECT k FROM hit)""",
    "shortest_paths": _SHORTEST,
    "self_loop_parts": f"""
        WITH {_BLOCK_LINKS}
        SELECT 'P' || p_partkey AS id, p_name AS name, p_retailprice AS value
        FROM part WHERE p_partkey IN (SELECT src FROM links WHERE src = dst)""",
    "cycle_members": f"WITH RECURSIVE {_BLOCK_GROUPS} SELECT cycle_id, 'P' || k AS id FROM members",
    "cycle_edges": f"""
        WITH RECURSIVE {_BLOCK_GROUPS}
        SELECT x.cycle_id, 'P' || src AS src, 'P' || dst AS dst
        FROM links JOIN members x ON x.k = src JOIN members y ON y.k = dst AND y.cycle_id = x.cycle_id""",
    "cycle_affected_vertices": f"WITH RECURSIVE {_BLOCK_AFFECTED} SELECT cycle_id, 'P' || k AS id FROM affected",
    "cycle_affected_edges": f"""
        WITH RECURSIVE {_BLOCK_AFFECTED}
        SELECT x.cycle_id, 'P' || src AS src, 'P' || dst AS dst
        FROM links JOIN affected x ON x.k = src JOIN affected y ON y.k = dst AND y.cycle_id = x.cycle_id""",
    "formula_depth": f"""
        WITH RECURSIVE {_SUM_DEPTH}
        SELECT 'P' || k AS id, depth, 'reached' AS state FROM depths
        UNION ALL SELECT 'r00t', 0, 'reached'""",
    "formula_depth_faulty": f"""
        WITH RECURSIVE {_FAULTY}
        SELECT 'P' || k AS id, depth, state FROM walk UNION ALL SELECT 'r00t', 0, 'reached'""",
    "formula_values": f"""
        WITH RECURSIVE {_SUM_DEPTH}, {_SUM_VALUES}
        SELECT 'P' || p_partkey AS id,
               CASE WHEN p_partkey >= 2
                    THEN a.v || ' + ' || b.v || ' + ' || p_size ELSE CAST(p_size AS VARCHAR) END AS formula,
               depth, CAST(own.v AS DOUBLE) AS value, 'ok' AS status
        FROM part JOIN depths ON depths.k = p_partkey
             JOIN vals own ON own.k = p_partkey
             JOIN vals a ON a.k = p_partkey // 2
             JOIN vals b ON b.k = p_partkey // 3
        UNION ALL SELECT 'r00t', '', 0, 0.0, 'ok'""",
    "formula_values_mixed": """
        WITH RECURSIVE walk(k, formula, depth, v) AS (
            SELECT p_partkey, CAST(p_size AS VARCHAR), CAST(1 AS INTEGER), CAST(p_size AS FLOAT)
            FROM part WHERE p_partkey = 0
            UNION ALL
            SELECT k,
                   CASE kind WHEN 0 THEN x || ' / 2 - ' || s || ' - 3'
                             WHEN 1 THEN '(' || x || ' + ' || s || ') * 2 / 5'
                             WHEN 2 THEN s || ' - ' || x || ' - 1.5'
                             ELSE x || '* -1 + ' || s || '/ 4' END,
                   depth,
                   CASE kind WHEN 0 THEN CAST(x AS FLOAT) / CAST(2 AS FLOAT) - (CAST(s AS FLOAT) - CAST(3 AS FLOAT))
                             WHEN 1 THEN (CAST(x AS FLOAT) + CAST(s AS FLOAT)) * (CAST(2 AS FLOAT) / CAST(5 AS FLOAT))
                             WHEN 2 THEN CAST(s AS FLOAT) - (CAST(x AS FLOAT) - CAST(1.5 AS FLOAT))
                             ELSE CAST(x AS FLOAT) * CAST(-1 AS FLOAT) + CAST(s AS FLOAT) / CAST(4 AS FLOAT) END
            FROM (
                SELECT p_partkey AS k, p_partkey % 4 AS kind, p_size AS s, walk.depth + 1 AS depth,
                       CAST(trunc(walk.v) AS INTEGER) AS x
                FROM walk JOIN part ON p_partkey // 2 = walk.k AND p_partkey > 0))
        SELECT 'P' || k AS id, formula, depth, CAST(v AS DOUBLE) AS value, 'ok' AS status FROM walk
        UNION ALL SELECT 'r00t', '', 0, 0.0, 'ok'""",
    "formula_values_lines": """
        WITH lines AS (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                         l_returnflag, l_linestatus, l_shipdate) AS place
            FROM lineitem)
        SELECT 'L' || l_orderkey || '_' || l_linenumber || '_' || place AS id,
               '(' || p_size || ' + 0.5) * ' || l_quantity AS formula, CAST(2 AS INTEGER) AS depth,
               (p_size + CAST(0.5 AS DOUBLE)) * l_quantity AS value, 'ok' AS status
        FROM lines JOIN part ON p_partkey = l_partkey
        UNION ALL SELECT 'P' || p_partkey, CAST(p_size AS VARCHAR), 1, CAST(p_size AS DOUBLE), 'ok' FROM part
        UNION ALL SELECT 'r00t', '', 0, 0.0, 'ok'""",
    "formula_status": f"""
        WITH RECURSIVE {_FAULTY}
        SELECT 'P' || k AS id, depth, value, status FROM walk UNION ALL SELECT 'r00t', 0, 0.0, 'ok'""",
    "formula_arguments": f"""
        WITH RECURSIVE {_SUM_VALUES}
        SELECT 'P' || dst AS id, 'P' || src AS arg, CAST(v AS DOUBLE) AS value
        FROM ({_SUM_LINKS}) JOIN vals ON k = src
        UNION ALL SELECT 'P' || p_partkey, 'r00t', 0.0 FROM part WHERE p_partkey < 2""",
    "expression_values": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CAST(CASE WHEN l_returnflag = 'A'
                    THEN (CAST(l_extendedprice AS FLOAT) + CAST(l_tax AS FLOAT))
                         / (CAST(l_quantity AS FLOAT) + CAST(0.5 AS FLOAT))
                    ELSE CAST(l_quantity AS FLOAT) * (CAST(l_extendedprice AS FLOAT) / CAST(7 AS FLOAT))
                         - (CAST(l_tax AS FLOAT) - CAST(l_discount AS FLOAT)) END AS DOUBLE) AS value,
               true AS parse_ok
        FROM lineitem""",
    "sales_hierarchy": """
        SELECT 'R' || r_regionkey AS id, CAST(1 AS INTEGER) AS level, r_name AS root, '/' || r_name AS path,
               CAST(0 AS INTEGER) AS iscyclic,
               CAST(CASE WHEN r_regionkey IN (SELECT n_regionkey FROM nation) THEN 0 ELSE 1 END AS INTEGER) AS isleaf
        FROM region
        UNION ALL
        SELECT 'N' || n_nationkey, 2, r_name, '/' || r_name || '/' || n_name, 0,
               CASE WHEN n_nationkey IN (SELECT c_nationkey FROM customer) THEN 0 ELSE 1 END
        FROM nation JOIN region ON r_regionkey = n_regionkey
        UNION ALL
        SELECT 'C' || c_custkey, 3, r_name, '/' || r_name || '/' || n_name || '/' || c_name, 0,
               CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 0 ELSE 1 END
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        UNION ALL
        SELECT 'O' || o_orderkey, 4, r_name,
               '/' || r_name || '/' || n_name || '/' || c_name || '/O' || o_orderkey, 0, 1
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
             JOIN region ON r_regionkey = n_regionkey""",
    "part_hierarchy": """
        WITH RECURSIVE walk(k, level, root, path) AS (
            SELECT p_partkey, CAST(1 AS INTEGER), p_name, '/P' || p_partkey FROM part WHERE p_partkey = 0
            UNION ALL
            SELECT p_partkey, level + 1, root, path || '/P' || p_partkey
            FROM walk JOIN part ON p_partkey // 2 = k AND p_partkey > 0)
        SELECT 'P' || p_partkey AS part_id, p_name, p_brand,
               CASE WHEN p_partkey > 0 THEN 'P' || (p_partkey // 2) END AS parent_id,
               level, root, path, CAST(0 AS INTEGER) AS iscyclic,
               CAST(CASE WHEN p_partkey IN (SELECT p_partkey // 2 FROM part WHERE p_partkey > 0)
                    THEN 0 ELSE 1 END AS INTEGER) AS isleaf
        FROM part JOIN walk ON k = p_partkey""",
    "cyclic_hierarchy": f"""
        WITH RECURSIVE {_RINGS}
        SELECT 'P' || up.k AS part_id, p_name, 'P' || parent AS parent_id, CAST(level AS INTEGER) AS level,
               root, '/' || path AS path, CAST(1 AS INTEGER) AS iscyclic,
               CAST(CASE WHEN up.k IN (SELECT parent FROM up WHERE parent <> k) THEN 0 ELSE 1 END AS INTEGER) AS isleaf
        FROM up JOIN rows_up ON rows_up.k = up.k""",
    "propagated_depth": f"""
        WITH RECURSIVE {_SUM_DEPTH}
        SELECT 'P' || k AS id, depth FROM depths UNION ALL SELECT 'r00t', 0""",
    "propagated_distance": _SHORTEST,
    "log_normal_graph": f"""
        WITH {_log_normal(7, "(SELECT count(*) FROM part)")}
        SELECT src, dst, CAST(1 AS DOUBLE) AS weight FROM links""",
    # No part is more than 16 hops away: degrees are about 50, so hops grow with the logarithm.
    "log_normal_distances": f"""
        WITH RECURSIVE {_log_normal(7, "(SELECT count(*) FROM part)")},
        pairs AS (SELECT DISTINCT src, dst FROM links),
        walk(k, hops) AS (
            SELECT CAST(42 AS BIGINT), 0
            UNION
            SELECT pairs.dst, hops + 1 FROM walk JOIN pairs ON pairs.src = walk.k WHERE hops < 16)
        SELECT p_partkey AS id, CAST(min(hops) AS DOUBLE) AS distance
        FROM part LEFT JOIN walk ON k = p_partkey GROUP BY p_partkey""",
    "cycle_vertices": f"""
        WITH RECURSIVE {_BLOCK_GROUPS}
        SELECT cycle_id, 'P' || k AS id, p_name AS name, p_retailprice AS value
        FROM members JOIN part ON p_partkey = k""",
    "cycle_affected_any": f"""
        WITH RECURSIVE {_BLOCK_AFFECTED}
        SELECT 'P' || p_partkey AS id, p_name AS name, p_retailprice AS value
        FROM part WHERE p_partkey IN (SELECT k FROM affected)""",
    "formula_args_text": f"""
        WITH RECURSIVE {_SUM_VALUES},
        args AS (
            SELECT dst AS k, 'P' || src AS arg, CAST(v AS BIGINT) AS v FROM ({_SUM_LINKS}) JOIN vals ON vals.k = src
            UNION ALL SELECT p_partkey, 'r00t', 0 FROM part WHERE p_partkey < 2)
        SELECT 'P' || k AS id, '{{' || string_agg('"' || arg || '":' || v || '.0', ',' ORDER BY arg) || '}}' AS args
        FROM args GROUP BY k
        UNION ALL SELECT 'r00t', '{{}}'""",
    "region_hops_text": """
        WITH hops AS (
            SELECT 'R' || r_regionkey AS id, 'R' || r_regionkey AS landmark, 0 AS distance FROM region
            UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 1 FROM nation
            UNION ALL SELECT 'C' || c_custkey, 'R' || n_regionkey, 2 FROM customer JOIN nation ON n_nationkey = c_nationkey
            UNION ALL SELECT 'S' || s_suppkey, 'R' || n_regionkey, 2 FROM supplier JOIN nation ON n_nationkey = s_nationkey
            UNION ALL SELECT DISTINCT 'P' || l_partkey, 'R' || n_regionkey, 3
            FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
        SELECT id, '{' || string_agg('"' || landmark || '":' || distance, ',' ORDER BY landmark) || '}' AS distances
        FROM hops GROUP BY id""",
    "supply_hierarchy": """
        WITH above AS (SELECT l_partkey AS k, min('S' || l_suppkey) AS parent FROM lineitem GROUP BY l_partkey),
        kept AS (SELECT DISTINCT parent FROM above)
        SELECT 'S' || s_suppkey AS id, CAST(1 AS INTEGER) AS level, s_name AS root, '/S' || s_suppkey AS path,
               CAST(0 AS INTEGER) AS iscyclic,
               CAST(CASE WHEN 'S' || s_suppkey IN (SELECT parent FROM kept) THEN 0 ELSE 1 END AS INTEGER) AS isleaf
        FROM supplier
        UNION ALL
        SELECT 'P' || p_partkey, CASE WHEN parent IS NULL THEN 1 ELSE 2 END, coalesce(s_name, p_name),
               CASE WHEN parent IS NULL THEN '' ELSE '/' || parent END || '/P' || p_partkey, 0, 1
        FROM part LEFT JOIN above ON k = p_partkey LEFT JOIN supplier ON 'S' || s_suppkey = parent""",
    "orphaned_hierarchy": """
        SELECT 'C' || c_custkey AS id, CAST(1 AS INTEGER) AS level, 'C' || c_custkey AS root,
               '/C' || c_custkey AS path, CAST(0 AS INTEGER) AS iscyclic,
               CAST(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F') THEN 0 ELSE 1 END
                    AS INTEGER) AS isleaf
        FROM customer
        UNION ALL
        SELECT 'O' || o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN 2 ELSE 1 END,
               CASE WHEN o_orderstatus <> 'F' THEN 'C' || o_custkey ELSE 'O' || o_orderkey END,
               CASE WHEN o_orderstatus <> 'F' THEN '/C' || o_custkey ELSE '' END || '/O' || o_orderkey, 0, 1
        FROM orders""",
    "formula_values_extreme": """
        WITH calc AS (
            SELECT p_partkey AS k, p_size AS s, p_partkey % 5 AS kind FROM part),
        base AS (
            SELECT k, s, kind,
                   CASE kind WHEN 0 THEN CAST(s AS FLOAT) * CAST(900000000 AS FLOAT)
                             WHEN 1 THEN CAST(s AS FLOAT) * CAST(-900000000 AS FLOAT)
                             WHEN 2 THEN CAST('nan' AS FLOAT)
                             WHEN 3 THEN CAST('inf' AS FLOAT)
                             ELSE CAST('-inf' AS FLOAT) END AS v
            FROM calc),
        texts AS (
            SELECT k, v,
                   CASE kind WHEN 0 THEN s || ' * 900000000' WHEN 1 THEN s || ' * -900000000'
                             WHEN 2 THEN '0 / 0' WHEN 3 THEN s || ' / 0' ELSE '-1 / 0' END AS formula,
                   CASE WHEN isnan(v) THEN '0' WHEN v = CAST('inf' AS FLOAT) THEN NULL
                        WHEN v >= 2147483647 THEN '2147483647' WHEN v <= -2147483648 THEN '-2147483648'
                        ELSE CAST(CAST(trunc(CAST(v AS DOUBLE)) AS BIGINT) AS VARCHAR) END AS sent
            FROM base)
        SELECT 'P' || k AS id, formula, CAST(1 AS INTEGER) AS depth, CAST(v AS DOUBLE) AS value, 'ok' AS status FROM texts
        UNION ALL
        SELECT 'Q' || k, coalesce(sent, 'item(P' || k || ')') || ' + 1', 2,
               CAST(CAST(sent AS FLOAT) + CAST(1 AS FLOAT) AS DOUBLE), CASE WHEN sent IS NULL THEN 'blocked' ELSE 'ok' END
        FROM texts
        UNION ALL SELECT 'r00t', '', 0, 0.0, 'ok'""",
}
