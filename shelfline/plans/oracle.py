"""DuckDB SQL for every registered query, over the same tables and independent of the Spark code."""

from __future__ import annotations

_CATALOG = """
n AS (SELECT count(*) AS k FROM supplier),
r AS (
  SELECT l_partkey, year(l_shipdate) AS yr,
    CAST(sum(CASE WHEN l_partkey % 97 <> 0 AND l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS positive,
    CAST(sum(CASE WHEN l_partkey % 97 <> 0 AND l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS negative,
    CAST(sum(l_quantity) * 10 AS BIGINT) AS average_forever,
    CAST(sum(CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0 END) AS BIGINT) AS average_2weeks,
    count(DISTINCT l_orderkey) AS ccu, max(l_shipdate) AS ingestion_timestamp
  FROM lineitem GROUP BY l_partkey, year(l_shipdate)
),
catalog_daily AS (
  SELECT p_partkey AS appid, lower(p_name) AS game_title,
    CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN ''
      ELSE concat('supplier#', CAST(p_partkey % n.k AS VARCHAR),
        CASE p_partkey % 5 WHEN 0 THEN ', llc' WHEN 1 THEN ', co., ltd.' WHEN 2 THEN ', inc.'
          WHEN 3 THEN ', incredible works' ELSE '' END,
        ', supplier#', CAST((p_partkey * 7 + 3) % n.k AS VARCHAR)) END AS developer,
    lower(concat(p_brand, CASE p_size % 3 WHEN 0 THEN ', corp.' WHEN 1 THEN ', brand#0' ELSE '' END)) AS publisher,
    CAST(NULL AS VARCHAR) AS score_rank, positive, negative, CAST(0 AS BIGINT) AS userscore,
    CASE WHEN average_forever < 500 THEN '0 .. 20,000' WHEN average_forever < 1000 THEN '20,000 .. 50,000'
      WHEN average_forever < 1500 THEN '200,000 .. 500,000' ELSE '1,000,000 .. 2,000,000' END AS owners,
    average_forever, average_2weeks, CAST(0 AS BIGINT) AS median_forever, CAST(0 AS BIGINT) AS median_2weeks,
    ccu, CAST(NULL AS VARCHAR) AS price,
    CASE WHEN p_partkey % 10 = 0 THEN '0' WHEN p_partkey % 37 = 0 THEN '12.5' WHEN p_partkey % 31 = 0 THEN NULL
      ELSE CAST(p_size * 100 - 1 AS VARCHAR) END AS initialprice,
    '0' AS discount, 'seed' AS run_id, ingestion_timestamp,
    concat(CAST(yr AS VARCHAR), '-01-01') AS dt
  FROM r JOIN part ON p_partkey = l_partkey CROSS JOIN n
)"""

_STAGED = """,
staged AS (
  SELECT appid AS app_id, game_title, developer, publisher, score_rank, owners, price,
    initialprice AS initial_price, discount, run_id, positive, negative, userscore,
    average_forever AS average_playtime_forever, average_2weeks AS average_playtime_2weeks,
    median_forever AS median_playtime_forever, median_2weeks AS median_playtime_2weeks,
    ccu, ingestion_timestamp AS ingested_at, dt AS partition_date
  FROM catalog_daily
)"""

_Z = "CAST(1.96 AS DOUBLE)"

_GAMES = _STAGED + f""",
shares AS (
  SELECT *, positive + negative AS total_reviews,
    CASE WHEN positive + negative > 0 THEN positive / (positive + negative) END AS share
  FROM staged
),
games AS (
  SELECT * EXCLUDE (share, run_id),
    round_even(CASE WHEN total_reviews > 0 THEN share * 100 ELSE CAST(0 AS DOUBLE) END, 1) AS approval_pct,
    round_even(CASE WHEN total_reviews > 0 THEN
      (share + {_Z} * {_Z} / (2 * total_reviews)
        - {_Z} * sqrt((share * (1 - share) + {_Z} * {_Z} / (4 * total_reviews)) / total_reviews))
      / (1 + {_Z} * {_Z} / total_reviews)
      ELSE CAST(0 AS DOUBLE) END, 4) + 0.0::DOUBLE AS wilson_score
  FROM shares
)"""


def _exploded(entity: str) -> str:
    return f"""
    SELECT DISTINCT app_id, positive, negative, partition_date, {entity} FROM (
      SELECT app_id, positive, negative, partition_date,
        trim(replace(part, '|||', ', ')) AS {entity}
      FROM (
        SELECT app_id, positive, negative, partition_date, unnest(string_split(
          regexp_replace(regexp_replace({entity}, ',\\s*(co\\.,\\s*ltd\\.?)', '|||\\1', 'g'),
            ',\\s*(llc\\.?|inc\\.?|ltd\\.?|l\\.l\\.c\\.?|co\\.|corp\\.?)', '|||\\1', 'g'), ',')) AS part
        FROM staged WHERE {entity} IS NOT NULL AND {entity} <> ''))
    WHERE {entity} <> ''"""


def _strict(entity: str) -> str:
    # RE2 has no lookahead: each pass consumes the following comma and is therefore run twice
    passes = [r"co\.\s*,\s*ltd\.?", r"llc\.?", r"inc\.?", r"ltd\.?", r"l\.l\.c\.?", r"co\.", r"corp\.?"]
    text = entity
    for suffix in passes:
        for _ in range(2):
            text = f"regexp_replace({text}, ',\\s*({suffix})(\\s*,|\\s*$)', chr(1) || '\\1\\2', 'g')"
    return f"""
    SELECT DISTINCT app_id, positive, negative, partition_date, {entity} FROM (
      SELECT app_id, positive, negative, partition_date,
        trim(replace(unnest(string_split({text}, ',')), chr(1), ', ')) AS {entity}
      FROM staged WHERE {entity} IS NOT NULL AND {entity} <> '')
    WHERE {entity} <> ''"""


def _mart(entity: str, where: str = "TRUE") -> str:
    return f"""
    SELECT {entity}, count(DISTINCT app_id) AS num_games,
      CAST(sum(positive + negative) AS BIGINT) AS total_reviews,
      CAST(sum(positive) AS BIGINT) AS total_positive, CAST(sum(negative) AS BIGINT) AS total_negative,
      round_even(CASE WHEN sum(positive + negative) > 0
        THEN sum(positive) / sum(positive + negative) * 100 ELSE CAST(0 AS DOUBLE) END, 1) AS avg_approval_pct,
      partition_date
    FROM ({_exploded(entity)}) WHERE {where} GROUP BY {entity}, partition_date"""


def _ranked(entity: str, where: str = "TRUE") -> str:
    order = f"total_reviews DESC, {entity}, partition_date"
    return f"""
    SELECT row_number() OVER (ORDER BY {order}) AS rank, {entity}, num_games, total_reviews,
      total_positive, total_negative, avg_approval_pct
    FROM ({_mart(entity)}) WHERE total_reviews > 0 AND {where} ORDER BY {order} LIMIT 20"""


_TOP_GAMES = """
  SELECT row_number() OVER (ORDER BY positive DESC, app_id, partition_date) AS rank,
    game_title, total_reviews, positive, negative, approval_pct, wilson_score
  FROM (SELECT * FROM games WHERE total_reviews > 0
        ORDER BY wilson_score DESC, app_id, partition_date LIMIT 500)
  ORDER BY positive DESC, app_id, partition_date LIMIT 50"""

_WORST_GAMES = """
  SELECT row_number() OVER (ORDER BY negative DESC, app_id, partition_date) AS rank,
    game_title, positive, negative, total_reviews, approval_pct
  FROM games WHERE total_reviews > 0 ORDER BY negative DESC, app_id, partition_date LIMIT 10"""

# Words left out of title counts.
_STOP_WORDS = "the of and a an in to is for on with at by from or be as it my no ii".split()
_STOP = ", ".join(f"'{w}'" for w in _STOP_WORDS)


def _words(column: str, table: str, pattern: str = r"[\s[:punct:]]+") -> str:
    return f"""
    SELECT word, count(*) AS word_count
    FROM (SELECT unnest(regexp_split_to_array({column}, '{pattern}')) AS word
          FROM {table} WHERE {column} IS NOT NULL)
    WHERE strlen(word) > 1 AND word NOT IN ({_STOP}) GROUP BY word"""


_CENTS = """CASE WHEN {c} IS NULL THEN NULL WHEN regexp_full_match({c}, '[+-]?[0-9]+')
  THEN coalesce(TRY_CAST({c} AS INTEGER), 0) ELSE 0 END"""

_LO = "CAST(replace(string_split(owners, ' .. ')[1], ',', '') AS BIGINT)"
_HI = "CAST(replace(string_split(owners, ' .. ')[2], ',', '') AS BIGINT)"


def _short(n: str) -> str:
    return (f"CASE WHEN {n} >= 1000000 THEN ({n} // 1000000) || 'M' "
            f"WHEN {n} >= 1000 THEN ({n} // 1000) || 'k' ELSE CAST({n} AS VARCHAR) END")


_LABEL = f"({_short(_LO)}) || '–' || ({_short(_HI)})"

_LADDER = _STAGED + f""",
ladder AS (
  SELECT owners, {_LO} AS lo, {_HI} AS hi, {_LABEL} AS label,
    coalesce(avg({_CENTS.format(c='initial_price')}) / 100, 0) AS avg_price_usd,
    coalesce(avg(positive / nullif(positive + negative, 0)) * 100, 0) AS avg_approval,
    coalesce(avg(average_playtime_forever) / 60, 0) AS avg_playtime_hrs,
    coalesce(avg(average_playtime_2weeks) / 60, 0) AS avg_2w_hrs
  FROM staged WHERE owners IS NOT NULL AND owners <> '' GROUP BY owners
)"""

_POWER = _STAGED + """,
studios AS (
  SELECT developer, count(*) AS num_games, CAST(sum(positive + negative) AS BIGINT) AS total_reviews,
    coalesce(avg(positive / nullif(positive + negative, 0)) * 100, 0) AS avg_approval,
    CAST(sum(positive) AS BIGINT) AS total_positive, CAST(sum(negative) AS BIGINT) AS total_negative
  FROM staged WHERE developer IS NOT NULL AND developer <> ''
  GROUP BY developer HAVING count(*) >= 5 AND sum(positive + negative) >= 50
),
power AS (
  SELECT row_number() OVER (ORDER BY total_reviews DESC, developer) AS rank, *,
    array_to_string(list_transform(
      list_filter(regexp_split_to_array(developer, '\\s+'), lambda w: w <> ''),
      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS display_name,
    greatest(num_games * 30, 80) AS bubble_size
  FROM studios ORDER BY total_reviews DESC, developer LIMIT 20
)"""

_LOG = """
years AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS yr, max(o_orderdate) AS committed_at
          FROM orders GROUP BY 1),
snapshots AS (SELECT yr * 7919 % 1009 AS snapshot_id, committed_at FROM years),
months AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS yr,
             strftime(o_orderdate, '%Y-%m-01') AS dt FROM orders)"""

_VERSIONED = """
o AS (SELECT o_orderkey, o_orderstatus, o_orderdate AS placed, CAST(year(o_orderdate) AS BIGINT) AS yr,
        strftime(o_orderdate, '%Y-%m-01') AS dt, month(o_orderdate) = 1 AS january FROM orders),
y AS (SELECT yr, max(placed) AS committed_at, max(yr) OVER () AS last, min(yr) OVER () AS first FROM o GROUP BY yr),
newest AS (SELECT max(yr) AS last FROM y)"""


def _as_of(year: str) -> str:
    return f"yr <= {year} AND NOT (january AND yr < {year} AND o_orderstatus = 'O')"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _catalog(body: str, ctes: str = "") -> str:
    return _with(_CATALOG + ctes, body)


_PAGES = """,
entries AS (
  SELECT dt, appid // 500 AS page FROM catalog_daily
  UNION ALL SELECT dt, appid // 500 - 1 FROM catalog_daily WHERE appid >= 500
)"""

_PAGE_REPORT = """
  SELECT dt, min(page) AS first_page, max(page) AS last_page, count(DISTINCT page) AS n_pages,
    count(DISTINCT page) AS n_files, min(page) = 0 AND count(DISTINCT page) = max(page) + 1 AS is_complete
  FROM entries GROUP BY dt"""

_ENTITY_DIM = """
  SELECT row_number() OVER (PARTITION BY partition_date ORDER BY {e}) - 1 AS {e}_id, {e}, partition_date
  FROM (SELECT DISTINCT {e}, partition_date FROM ({x}))"""

_SCAN = "SELECT appid, game_title, positive, negative, dt FROM catalog_daily WHERE "

_LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


def _latest(table: str, keys: str, order: str) -> str:
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


ORACLES: dict[str, str] = {
    "stg_games": _catalog("SELECT * FROM staged", _STAGED),
    "review_metrics": _catalog("SELECT * FROM games", _GAMES),
    "entity_explode": _catalog(_exploded("developer"), _STAGED),
    "entity_explode_publishers": _catalog(_exploded("publisher"), _STAGED),
    "entity_explode_strict": _catalog(_strict("developer"), _STAGED),
    "developers_mart": _catalog(_mart("developer"), _STAGED),
    "publishers_mart": _catalog(_mart("publisher"), _STAGED),
    "developers_mart_full_list": _catalog(
        f"""SELECT l.developer, num_games, total_reviews, total_positive, total_negative,
              avg_approval_pct, l.partition_date
            FROM (SELECT DISTINCT developer, partition_date FROM ({_exploded('developer')})) l
            LEFT JOIN ({_mart('developer', 'positive + negative > 0')}) m
              ON l.developer = m.developer AND l.partition_date = m.partition_date""",
        _STAGED,
    ),
    "developers_all_time": _catalog(
        f"""SELECT developer, count(DISTINCT app_id) AS num_games, count(DISTINCT partition_date) AS n_dates
            FROM ({_exploded('developer')}) GROUP BY developer""", _STAGED),
    "latest_bucketed": _latest("events", "user_id", "ts DESC, event_id DESC"),
    "merge_partitions": _catalog("""
        SELECT id, CASE WHEN dt = '1996-01-01' AND appid % 5 = 0 THEN -1 ELSE positive END AS positive,
          CASE WHEN dt = '1997-01-01' AND appid % 7 = 0 THEN '1997-02-01' ELSE dt END AS dt
        FROM (SELECT appid, appid * 10000 + CAST(dt[1:4] AS BIGINT) AS id, positive, dt FROM catalog_daily)
        UNION ALL SELECT -(appid * 10000 + 1998), positive, '1998-02-01' FROM catalog_daily WHERE dt = '1998-01-01'"""),
    "list_tables": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, true AS is_temporary,
              (SELECT count(*) FROM (DESCRIBE {t})) AS n_columns, (SELECT count(*) FROM {t}) AS n_rows"""
        for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
                  "conversations").split()),
    "array_unnest": """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS place,
        CAST(unnest(embedding) AS DOUBLE) AS component FROM embeddings""",
    "replicate_list": _catalog("""SELECT dt, count(*) AS n_rows, 'present' AS replicated, CAST(1 AS BIGINT) AS last_snapshot_id,
        'replication failed for: [''absent'']' AS failed FROM catalog_daily GROUP BY dt"""),
    "layered_marts": _catalog(_mart("developer"), _STAGED),
    "developer_rankings": _catalog(_ranked("developer"), _STAGED),
    "publisher_rankings": _catalog(_ranked("publisher"), _STAGED),
    "developer_rankings_latest": _catalog(
        _ranked("developer", "partition_date = (SELECT max(dt) FROM catalog_daily)"), _STAGED
    ),
    "top_games_ranked": _catalog(_TOP_GAMES, _GAMES),
    "worst_games_ranked": _catalog(_WORST_GAMES, _GAMES),
    "top_games_chart": _catalog(
        f"SELECT rank, game_title, positive, approval_pct, wilson_score FROM ({_TOP_GAMES})", _GAMES
    ),
    "worst_games_chart": _catalog(f"SELECT rank, game_title, negative FROM ({_WORST_GAMES})", _GAMES),
    "title_words": _catalog(_words("game_title", "staged"), _STAGED),
    "title_words_letters": _catalog(_words("publisher", "staged", r"[^\p{L}]+"), _STAGED),
    "document_words": _words("text", "documents"),
    "document_words_letters": _words("text", "documents", r"[^\p{L}]+"),
    "word_cloud_200": f"SELECT * FROM ({_words('text', 'documents')}) ORDER BY word_count DESC, word LIMIT 200",
    "tier_labels": _catalog(
        f"SELECT appid, dt, owners, {_LO} AS lo, {_HI} AS hi, {_LABEL} AS label FROM catalog_daily"
    ),
    "price_parse": _catalog(
        f"SELECT appid, dt, initialprice, CAST({_CENTS.format(c='initialprice')} AS BIGINT) AS cents "
        "FROM catalog_daily"
    ),
    "tier_profile": _catalog(
        """SELECT owners, lo, hi, label, round(avg_price_usd, 6) AS avg_price_usd,
             round(avg_approval, 6) AS avg_approval, round(avg_playtime_hrs, 6) AS avg_playtime_hrs,
             round(avg_2w_hrs, 6) AS avg_2w_hrs FROM ladder""",
        _LADDER,
    ),
    "tier_index": _catalog(
        """SELECT owners, l.lo, label,
             round(avg_price_usd / CASE WHEN b.p = 0 THEN 1 ELSE b.p END, 6) AS avg_price_usd_idx,
             round(avg_approval / CASE WHEN b.a = 0 THEN 1 ELSE b.a END, 6) AS avg_approval_idx,
             round(avg_playtime_hrs / CASE WHEN b.h = 0 THEN 1 ELSE b.h END, 6) AS avg_playtime_hrs_idx
           FROM ladder l, (SELECT avg_price_usd AS p, avg_approval AS a, avg_playtime_hrs AS h
                           FROM ladder ORDER BY lo LIMIT 1) b""",
        _LADDER,
    ),
    "tier_retention": _catalog(
        """SELECT owners, lo, label, round(avg_playtime_hrs, 6) AS avg_playtime_hrs,
             round(avg_2w_hrs, 6) AS avg_2w_hrs FROM ladder WHERE avg_2w_hrs > 0.1""",
        _LADDER,
    ),
    "scatter_points": _catalog(
        f"""SELECT *, CASE WHEN price_usd = 0 THEN 'Free' WHEN price_usd < 5 THEN 'Under $5'
              WHEN price_usd < 15 THEN '$5–$15' WHEN price_usd < 30 THEN '$15–$30'
              WHEN price_usd IS NOT NULL THEN '$30+' END AS price_band
            FROM (
              SELECT app_id, partition_date, round(average_playtime_forever / 60, 6) AS playtime_hrs,
                round(positive / (positive + negative) * 100, 6) AS approval,
                {_CENTS.format(c='initial_price')} / CAST(100 AS DOUBLE) AS price_usd
              FROM staged
              WHERE positive + negative > 3 AND average_playtime_forever > 0 AND positive > 0
                AND negative > 0 AND average_playtime_forever / 60 <= 300)""",
        _STAGED,
    ),
    "dev_power": _catalog(
        "SELECT * REPLACE (round(avg_approval, 6) AS avg_approval) FROM power", _POWER
    ),
    "fans_vs_critics": _catalog(
        """SELECT rank, display_name, total_positive / 1e6::DOUBLE AS positive_m,
             -total_negative / 1e6::DOUBLE AS negative_m FROM power WHERE rank <= 15""",
        _POWER,
    ),
    "latest_by_key": _latest("events", "user_id, event_type", "ts DESC, event_id DESC"),
    "dedup_latest": _latest("events", "user_id", "ts DESC, event_id DESC"),
    "last_written_by_key": _latest("orders", "o_custkey", "o_orderkey DESC"),
    "entity_dim": _catalog(_ENTITY_DIM.format(e="developer", x=_exploded("developer")), _STAGED),
    "entity_dim_publishers": _catalog(
        _ENTITY_DIM.format(e="publisher", x=_exploded("publisher")), _STAGED
    ),
    "scan_partition": _catalog(_SCAN + "dt = (SELECT max(dt) FROM catalog_daily)"),
    "scan_changed": _catalog(
        _SCAN + """dt IN (SELECT year(o_orderdate) || '-01-01' FROM orders GROUP BY 1
          HAVING count(*) FILTER (o_orderstatus = 'F') > count(*) FILTER (o_orderstatus = 'O'))"""
    ),
    "scan_glob": _catalog(_SCAN + "dt LIKE '199%'"),
    "partition_list": _catalog("SELECT DISTINCT dt FROM catalog_daily"),
    "latest_partition": _catalog("SELECT max(dt) AS dt FROM catalog_daily"),
    "publish_partitions": _catalog(
        "SELECT appid, CASE WHEN dt >= '1998-01-01' THEN ccu ELSE -1 END AS ccu, dt FROM catalog_daily"
    ),
    "publish_table": _catalog(
        "SELECT appid, CASE WHEN dt >= '1998-01-01' THEN ccu ELSE -1 END AS ccu, dt FROM catalog_daily"
    ),
    "verify_counts": _catalog(
        "SELECT dt, count(*) AS expected_rows, count(*) AS actual_rows FROM catalog_daily GROUP BY dt"
    ),
    "partition_sink": _catalog(
        """SELECT dt, count(*) AS n_rows, CAST(sum(positive) AS BIGINT) AS positive,
             (SELECT count(*) FROM catalog_daily) AS sink_total FROM catalog_daily GROUP BY dt"""
    ),
    "partition_stats": _catalog("SELECT dt, count(*) AS record_count, true AS has_files, true AS has_bytes "
                                "FROM catalog_daily GROUP BY dt"),
    "partition_records": _catalog("SELECT dt, count(*) AS record_count FROM catalog_daily GROUP BY dt"),
    "describe_table": " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
        f"count({c}) AS non_null FROM lineitem"
        for i, (c, t) in enumerate(_LINEITEM_TYPES.items(), 1)
    ),
    "json_introspect": """SELECT key, count(*) AS n_docs
        FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key""",
    "json_map_explode": """SELECT event_id, key, json_extract_string(props, '$.' || key) AS value
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""",
    "json_array_unnest": """SELECT event_id, user_id AS fact FROM events
        UNION ALL SELECT event_id, length(event_type) FROM events""",
    "bronze_ingest": _catalog(
        """SELECT dt, page, 'catalog' AS source, 'run-1' AS run_id, count(*) AS n_entries, true AS dated
           FROM entries GROUP BY dt, page""",
        _PAGES,
    ),
    "silver_games": _catalog(
        """SELECT appid, positive, negative, average_forever, average_2weeks, ccu, game_title, developer,
             publisher, score_rank, owners, initialprice, 'run-1' AS run_id, dt FROM catalog_daily"""
    ),
    "page_gaps": _catalog(_PAGE_REPORT, _PAGES),
    "landing_stream": _catalog(_PAGE_REPORT, _PAGES),
    "latest_snapshot": _with(
        _LOG, "SELECT snapshot_id, committed_at FROM snapshots ORDER BY committed_at DESC LIMIT 1"
    ),
    "changed_partitions": _with(_LOG, "SELECT dt FROM months WHERE yr > 1997"),
    "replication_plan": _with(
        _LOG,
        """SELECT s.scenario, s.mode, m.dt FROM months m, (VALUES
             ('no_state', 'full', 0), ('behind', 'incremental', 1998), ('expired_state', 'full', 0),
             ('full_load', 'full', 0), ('override', 'incremental', 1998)) s(scenario, mode, first_yr)
           WHERE m.yr >= s.first_yr""",
    ),
    "replication_state": """SELECT table_name, last_snapshot_id, updated_at FROM (
        SELECT o_orderpriority AS table_name, o_orderkey AS last_snapshot_id, o_orderdate AS updated_at
        FROM orders)
        QUALIFY row_number() OVER (PARTITION BY table_name
          ORDER BY updated_at DESC, last_snapshot_id DESC) = 1""",
    "replicate_table": _catalog("SELECT appid, game_title, positive, negative, dt FROM catalog_daily"),
    "changed_by_mtime": _catalog("SELECT max(dt) AS dt FROM catalog_daily"),
    "snapshot_history": _with(_VERSIONED, """
        SELECT committed_at AS made_current_at, yr * 7919 % 1009 AS snapshot_id,
          CASE WHEN yr > first THEN (yr - 1) * 7919 % 1009 END AS parent_id, true AS is_current_ancestor FROM y
        UNION ALL SELECT committed_at - INTERVAL 1 HOUR, yr * 7919 % 1009 + 5000, (yr - 1) * 7919 % 1009, false
        FROM y WHERE yr = last - 1"""),
    "live_files": _with(_VERSIONED, f"""
        SELECT dt, (CASE WHEN january AND yr < last THEN yr + 1 ELSE yr END) * 7919 % 1009 AS added_by,
          count(*) AS record_count, count(*) AS footer_rows, true AS has_bytes
        FROM o, newest WHERE {_as_of('last')} GROUP BY ALL"""),
    "read_as_of": _with(_VERSIONED, f"SELECT o_orderkey, o_orderstatus, dt FROM o WHERE {_as_of('1997')}"),
    "read_between": _with(_VERSIONED, f"""
        SELECT o_orderkey, o_orderstatus, dt, 'added' AS change FROM o
        WHERE (yr > 1996 AND {_as_of('1998')}) OR (yr = 1996 AND january AND o_orderstatus <> 'O')
        UNION ALL SELECT o_orderkey, o_orderstatus, dt, 'removed' FROM o WHERE yr = 1996 AND january"""),
    "replicate_from_log": _with(
        _VERSIONED, f"SELECT o_orderkey, o_orderstatus, dt FROM o, newest WHERE {_as_of('last')}"),
    "dq_not_null": _catalog(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failing_rows FROM staged"
            for c in ("app_id", "developer", "initial_price", "partition_date")
        ),
        _STAGED,
    ),
    "dq_unique_key": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_relationship": """SELECT doc_id, lang, n_chars FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "dq_orders_customer": """SELECT * FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)""",
    "upsert_merge": """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'P' ELSE o_orderstatus END
          AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
          CAST(CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END AS BIGINT) AS version FROM orders
        UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
          o_orderpriority, 1 FROM orders WHERE o_orderstatus = 'F'""",
    "soft_delete_flag": """SELECT *, EXISTS (SELECT 1 FROM orders
          WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS is_deleted FROM customer""",
    "union_sources": """SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nationkey,
          c_acctbal AS acctbal, 'customer' AS source FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier""",
    "pivot_status": """SELECT o_custkey,
          round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS f_amount,
          round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS o_amount,
          round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END), 2) AS p_amount,
          round(sum(o_totalprice), 2) AS total_amount FROM orders GROUP BY o_custkey""",
    "customer_mart": """SELECT c_custkey, any_value(c_name) AS c_name, min(o_orderdate) AS first_order,
          max(o_orderdate) AS last_order, count(o_orderkey) AS n_orders,
          round(sum(o_totalprice), 2) AS lifetime_value
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "fan_out_quantity": """SELECT l_returnflag, unit_no, count(*) AS n_units
        FROM (SELECT l_returnflag, unnest(range(1, CAST(l_quantity AS BIGINT) + 1)) AS unit_no FROM lineitem)
        GROUP BY l_returnflag, unit_no""",
    "stage_categorise": """SELECT o_orderkey AS order_id,
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'express' ELSE 'standard' END AS order_type,
          CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents,
          CAST(round(o_totalprice * 100) AS BIGINT) / CAST(100 AS DOUBLE) AS amount,
          o_orderstatus = 'F' AS is_completed,
          CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month FROM orders""",
    "scd2_history": _catalog(
        """SELECT appid, owners, dt AS valid_from,
             lead(dt) OVER w AS valid_to, lead(dt) OVER w IS NULL AS is_current
           FROM (SELECT appid, owners, dt, lag(owners) OVER (PARTITION BY appid ORDER BY dt) AS before
                 FROM catalog_daily)
           WHERE before IS NULL OR before <> owners
           WINDOW w AS (PARTITION BY appid ORDER BY dt)"""
    ),
    "seed_lookup": """SELECT c_custkey, c_name, n_name, r_name FROM customer
        LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey""",
    "events_funnel": """WITH RECURSIVE want AS (
          SELECT * FROM (VALUES (1, 'view'), (2, 'click'), (3, 'signup'), (4, 'purchase')) v(i, step)),
        walk(user_id, i, hit) AS (
          SELECT user_id, 1, min(ts) FROM events WHERE event_type = 'view' GROUP BY user_id
          UNION ALL
          SELECT e.user_id, w.i, min(e.ts) FROM walk JOIN want w ON w.i = walk.i + 1
            JOIN events e ON e.user_id = walk.user_id AND e.event_type = w.step AND e.ts >= walk.hit
          GROUP BY e.user_id, w.i),
        deep AS (SELECT user_id, max(i) AS depth FROM walk GROUP BY user_id)
        SELECT f.*, CAST(coalesce(depth, 0) AS BIGINT) AS steps_reached
        FROM (SELECT user_id, min(ts) FILTER (event_type = 'view') AS first_view,
                min(ts) FILTER (event_type = 'click') AS first_click,
                min(ts) FILTER (event_type = 'signup') AS first_signup,
                min(ts) FILTER (event_type = 'purchase') AS first_purchase
              FROM events GROUP BY user_id) f LEFT JOIN deep USING (user_id)""",
    "date_spine": """WITH daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events
            GROUP BY 1),
          days AS (SELECT CAST(unnest(generate_series(min(day) - INTERVAL 3 DAY, max(day) + INTERVAL 3 DAY,
                     INTERVAL 1 DAY)) AS DATE) AS day FROM daily)
        SELECT day, coalesce(n, 0) AS n_rows FROM days LEFT JOIN daily USING (day)""",
    "landing_to_rankings": _catalog(_ranked("developer"), _STAGED),
    "incremental_marts_emptied": _catalog(
        f"SELECT * FROM ({_mart('developer')}) WHERE partition_date <> '1996-01-01'", _STAGED),
    "gated_marts": _catalog(
        f"SELECT *, partition_date = '1996-01-01' AS held_back FROM ({_mart('developer')})",
        _STAGED.replace("positive, negative, userscore", "CASE WHEN dt = '1999-01-01' THEN 0 ELSE positive END AS positive, negative, userscore")),
    "marts_over_versions": _catalog(_mart("publisher"), _STAGED),
    "incremental_marts": _catalog(_mart("developer"), _STAGED),
    "stored_rankings": _catalog(
        _TOP_GAMES.replace("total_reviews > 0", "total_reviews > 0 AND partition_date = "
                           "(SELECT max(dt) FROM catalog_daily)"), _GAMES
    ),
}
