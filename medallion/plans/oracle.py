"""The registered queries in SQL for the checking engine, over the same test tables."""

from __future__ import annotations

USERS = """
users_src AS (
  SELECT CASE WHEN c_custkey % 41 = 5 THEN 'bad-' || cast(c_custkey AS varchar)
              WHEN c_custkey % 53 = 11 THEN '-' || cast(c_custkey AS varchar)
              ELSE cast(c_custkey AS varchar) END AS id,
         CASE WHEN c_custkey % 31 = 4 THEN NULL
              ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
         lower(c_mktsegment) AS firstname,
         replace(lower(n_name), '_', ' ') AS lastname,
         cast(c_custkey AS varchar) || ' ' || c_mktsegment || ' street' AS address,
         n_name AS city,
         CASE WHEN c_custkey % 50 = 7 THEN '2019-01-01'
              ELSE strftime(o_orderdate + to_days(6575), '%m-%d-%Y %H:%M:%S') END AS creation_date,
         strftime(o_orderdate + to_days(6575) + to_days(cast(c_custkey % 1000 AS int)),
                  '%m-%d-%Y %H:%M:%S') AS last_activity_date,
         '10.0.' || cast(c_nationkey AS varchar) || '.' || cast(c_custkey % 256 AS varchar) AS last_ip,
         lpad(cast(c_custkey % 97 AS varchar), 5, '0') AS postcode,
         CASE WHEN c_custkey % 37 = 3 THEN 'gold' END AS loyalty
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_orderkey = c_custkey
)"""

SPEND = """
spend_src AS (
  SELECT cast(c_custkey AS int) AS id,
         CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE cast(18 + c_custkey % 60 AS int) END AS age,
         CASE WHEN c_custkey % 43 = 2 THEN NULL ELSE cast(floor(c_acctbal) AS int) END AS annual_income,
         cast(1 + (c_custkey * 37) % 100 AS int) AS spending_core
  FROM customer WHERE c_custkey % 10 <> 9
  UNION ALL
  SELECT cast(c_custkey AS int), 99, 0, 1 FROM customer WHERE c_custkey % 211 = 1
)"""

RAW_NAMES = (
    "id, email, firstname, lastname, address, city, creation_date, last_activity_date, last_ip, postcode"
)

NO_RESCUE = "cast(NULL AS varchar) AS _rescued_data"


def _capital(column: str) -> str:
    word = "upper(x[1]) || lower(x[2:])"
    return f"array_to_string(list_transform(string_split({column}, ' '), lambda x: {word}), ' ')"


def _time(column: str) -> str:
    return f"try_strptime({column}, '%m-%d-%Y %H:%M:%S')"


SILVER = f"""
silver AS (
  SELECT id, sha1(email) AS email, {_capital('firstname')} AS firstname, {_capital('lastname')} AS lastname,
         address, city, {_time('creation_date')} AS creation_date,
         {_time('last_activity_date')} AS last_activity_date, last_ip, postcode
  FROM users_src
)"""

DECLARED = f"""
declared AS (
  SELECT try_cast(id AS int) AS id, sha1(email) AS email, {_time('creation_date')} AS creation_date,
         {_time('last_activity_date')} AS last_activity_date, firstname, lastname, address, city,
         last_ip, postcode
  FROM users_src
)"""

SPEND_FLOAT = """
spend_float AS (
  SELECT id, age, cast(annual_income AS float) AS annual_income, cast(spending_core AS float) AS spending_core
  FROM spend_src
)"""

GOLD = """
gold AS (
  SELECT s.*, p.age, p.annual_income, p.spending_core
  FROM silver s JOIN spend_src p ON try_cast(s.id AS int) = p.id
)"""

LEFT_GOLD = """
left_gold AS (
  SELECT d.*, p.age, p.annual_income, p.spending_core
  FROM declared d LEFT JOIN spend_float p ON d.id = p.id
),
checked AS (
  SELECT * FROM left_gold
  WHERE age IS NOT NULL AND annual_income IS NOT NULL AND spending_core IS NOT NULL
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_USERS = _with(USERS)
_SPEND = _with(SPEND, SPEND_FLOAT)
_GOLD = _with(USERS, SPEND, SILVER, GOLD)
_DECLARED = _with(USERS, SPEND, SPEND_FLOAT, DECLARED, LEFT_GOLD)

EARLY = "coalesce(creation_date < TIMESTAMP '2015-01-01', false)"

SCALED = """
lim AS (
  SELECT min(cast(age AS double)) AS a0, max(cast(age AS double)) AS a1,
         min(cast(annual_income AS double)) AS i0, max(cast(annual_income AS double)) AS i1,
         min(cast(spending_core AS double)) AS s0, max(cast(spending_core AS double)) AS s1
  FROM checked
),
scaled AS (
  SELECT id, (cast(age AS double) - a0) / (a1 - a0) * 10 AS age,
         (cast(annual_income AS double) - i0) / (i1 - i0) * 10 AS annual_income,
         (cast(spending_core AS double) - s0) / (s1 - s0) * 10 AS spending_core
  FROM checked, lim
)"""

NEAR = """
distances AS (
  SELECT *, (age-2)*(age-2) + (annual_income-2)*(annual_income-2) + (spending_core-2)*(spending_core-2) AS d0,
         (age-7)*(age-7) + (annual_income-3)*(annual_income-3) + (spending_core-4)*(spending_core-4) AS d1,
         (age-3)*(age-3) + (annual_income-7)*(annual_income-7) + (spending_core-6)*(spending_core-6) AS d2,
         (age-7)*(age-7) + (annual_income-7)*(annual_income-7) + (spending_core-8)*(spending_core-8) AS d3
  FROM scaled
),
near AS (
  SELECT id, age, annual_income, spending_core, least(d0, d1, d2, d3) AS distance,
         CASE least(d0, d1, d2, d3) WHEN d0 THEN 0 WHEN d1 THEN 1 WHEN d2 THEN 2 ELSE 3 END AS cluster
  FROM distances
)"""

_SCALED = _with(USERS, SPEND, SPEND_FLOAT, DECLARED, LEFT_GOLD, SCALED)
_NEAR = _with(USERS, SPEND, SPEND_FLOAT, DECLARED, LEFT_GOLD, SCALED, NEAR)

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rule(flow: str, rule: str, source: str, condition: str, drop: bool) -> str:
    failed = f"count(*) FILTER (WHERE NOT coalesce({condition}, false))"
    return (
        f"SELECT '{flow}' AS flow, '{rule}' AS rule, cast(count(*) - {failed} AS bigint) AS passed, "
        f"cast({failed} AS bigint) AS failed, cast({failed if drop else 0} AS bigint) AS dropped FROM {source}"
    )


def _rules() -> str:
    return "\nUNION ALL\n".join(
        [
            _rule("users_bronze_dlt", "correct_schema", "users_src", "loyalty IS NULL", False),
            _rule("user_silver_dlt", "valid_id", "declared", "id IS NOT NULL AND id > 0", False),
            _rule("spend_silver_dlt", "valid_id", "spend_float", "id IS NOT NULL AND id > 0", False),
            _rule("user_gold_dlt", "valid_age", "left_gold", "age IS NOT NULL", True),
            _rule("user_gold_dlt", "valid_income", "left_gold", "annual_income IS NOT NULL", True),
            _rule("user_gold_dlt", "valid_score", "left_gold", "spending_core IS NOT NULL", True),
        ]
    )


def _profile() -> str:
    def part(c: str) -> str:
        number = c in (*MEASURES, "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        low, high = f"cast(min({c}) AS double)", f"cast(max({c}) AS double)"
        text = f"cast(NULL AS varchar) AS min_text, cast(NULL AS varchar) AS max_text, true AS distinct_close, true AS median_close"
        if number:
            values = f"round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS stddev, {low} AS min, {high} AS max, {text}"
        else:
            nothing = ", ".join(f"cast(NULL AS double) AS {name}" for name in ("mean", "stddev", "min", "max"))
            values = f"""{nothing}, left(cast(min({c}) AS varchar), 10) AS min_text,
                left(cast(max({c}) AS varchar), 10) AS max_text, true AS distinct_close, cast(NULL AS boolean) AS median_close"""
        return f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, {values} FROM lineitem"""

    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return "\nUNION ALL\n".join(part(c) for c in [*keys, *MEASURES, "l_returnflag", "l_linestatus", "l_shipdate"])


def _landing_profile() -> str:
    columns = [name.strip() for name in RAW_NAMES.split(",")] + ["loyalty"]
    parts = [
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
            min({c}) AS min, max({c}) AS max, true AS distinct_close FROM users_src"""
        for c in columns
    ]
    return _USERS + "\nUNION ALL\n".join(parts)


def _frequent() -> str:
    cells = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", cast({c} AS varchar) AS value FROM lineitem"
        for c in ("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey")
    )
    return f"""
WITH cells AS ({cells}),
counts AS (SELECT "column", value, count(*) AS c FROM cells WHERE value IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, cast(row_number() OVER (PARTITION BY "column" ORDER BY c DESC, value) AS int) AS rank
           FROM counts)
SELECT * FROM ranked WHERE rank <= 5"""


def _regression() -> str:
    pairs = [(x, y) for i, x in enumerate(MEASURES) for y in MEASURES[i + 1 :]]
    return "\nUNION ALL\n".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(regr_slope({y}, {x}), 6) AS slope, "
        f"round(regr_intercept({y}, {x}), 6) AS intercept, round(corr({x}, {y}), 6) AS corr FROM lineitem"
        for x, y in pairs
    )


def _bins(column: str, bins: int) -> str:
    """CTE ``b_<column>``: the bin of every row, and the range it was cut from."""
    return f"""
r_{column} AS (
  SELECT min({column}) AS low, (max({column}) - min({column})) / {bins} AS width,
         stddev({column}) AS sigma, count({column}) AS n FROM lineitem
)"""


def _bin(column: str, bins: int) -> str:
    return f"cast(least(floor(({column} - r_{column}.low) / r_{column}.width), {bins - 1}) AS int)"


def _histograms() -> str:
    columns = ["l_quantity", "l_extendedprice"]
    parts = [
        f"SELECT '{c}' AS \"column\", {_bin(c, 20)} AS bin, count(*) AS c FROM lineitem, r_{c} "
        f"WHERE {c} IS NOT NULL GROUP BY 1, 2"
        for c in columns
    ]
    return _with(*[_bins(c, 20) for c in columns]) + "\nUNION ALL\n".join(parts)


def _pair_histograms() -> str:
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    parts = [
        f"SELECT '{x}' AS x, '{y}' AS y, {_bin(x, 20)} AS x_bin, {_bin(y, 20)} AS y_bin, count(*) AS c "
        f"FROM lineitem, r_{x}, r_{y} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1, 2, 3, 4"
        for i, x in enumerate(columns)
        for y in columns[i + 1 :]
    ]
    return _with(*[_bins(c, 20) for c in columns]) + "\nUNION ALL\n".join(parts)


def _kernel(at: str, mid: str, h: str) -> str:
    return f"exp(-(({at}) - ({mid})) / ({h}) * (({at}) - ({mid})) / ({h}) / 2) / (({h}) * sqrt(2 * pi()))"


def _curve() -> str:
    parts = []
    for c in ("l_quantity", "l_extendedprice"):
        at = "low + point * (width * 100 / 49)"
        kernel = _kernel(at, "low + (bin + 0.5) * width", "sigma * pow(n, -1.0 / 5)")
        parts.append(
            f"SELECT '{c}' AS \"column\", cast(point AS int) AS point, round({at}, 6) AS at, "
            f"round(sum(c / n * {kernel}), 9) AS density "
            f"FROM (SELECT {_bin(c, 100)} AS bin, cast(count(*) AS double) AS c FROM lineitem, r_{c} "
            f"WHERE {c} IS NOT NULL GROUP BY 1) AS h, r_{c}, range(0, 50) AS g(point) "
            f"GROUP BY point, low, width"
        )
    return _with(*[_bins(c, 100) for c in ("l_quantity", "l_extendedprice")]) + "\nUNION ALL\n".join(parts)


def _surface() -> str:
    x, y = "l_quantity", "l_extendedprice"
    spots = []
    for axis, c in (("x", x), ("y", y)):
        r = f"r_{c}"
        at = f"{r}.low + {axis}_point * {r}.width * 30 / 19"
        spots.append(
            _kernel(at, f"{r}.low + ({axis}_bin + 0.5) * {r}.width", f"{r}.sigma * pow({r}.n, -1.0 / 6)")
        )
    return (
        _with(_bins(x, 30), _bins(y, 30))
        + f"SELECT '{x}' AS x, '{y}' AS y, cast(x_point AS int) AS x_point, cast(y_point AS int) AS y_point, "
        f"round(sum(c / r_{x}.n * {spots[0]} * {spots[1]}), 12) AS density "
        f"FROM (SELECT {_bin(x, 30)} AS x_bin, {_bin(y, 30)} AS y_bin, cast(count(*) AS double) AS c "
        f"FROM lineitem, r_{x}, r_{y} GROUP BY 1, 2) AS h, r_{x}, r_{y}, "
        f"range(0, 20) AS gx(x_point), range(0, 20) AS gy(y_point) GROUP BY x_point, y_point"
    )


def oracle_sql() -> dict[str, str]:
    rescued = """CASE WHEN loyalty IS NOT NULL THEN '{"loyalty":"gold"}' END AS _rescued_data"""
    bad_id = "try_cast(id AS bigint) IS NULL"
    copied = f"""CASE WHEN {bad_id} AND loyalty IS NOT NULL THEN '{{"id":"' || id || '","loyalty":"gold"}}'
        WHEN {bad_id} THEN '{{"id":"' || id || '"}}'
        WHEN loyalty IS NOT NULL THEN '{{"loyalty":"gold"}}' END AS _rescued_data"""
    names = RAW_NAMES.split(", ")
    rest = ", ".join(names[1:])
    silver_names = ", ".join(f"s.{name}" for name in names[1:])
    features = "age, annual_income, spending_core"
    gold_names = f"{RAW_NAMES}, {features}"
    others = [name.strip() for name in gold_names.split(",") if name.strip() != "address"]
    no_address, from_given = ", ".join(others), ", ".join(f"n.{name}" for name in others)
    merged = f"""
touched AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY spending_core DESC, age DESC NULLS LAST) AS rn
  FROM gold WHERE try_cast(id AS int) % 7 = 0
),
newest AS (
  SELECT {RAW_NAMES}, age, annual_income, 100 AS spending_core FROM touched WHERE rn = 1
),
fresh AS (
  SELECT 'new-' || id AS id, {rest}, {features} FROM newest WHERE try_cast(id AS int) % 2 = 0
)"""
    return {
        "bronze_json_stream": f"{_USERS} SELECT {RAW_NAMES}, {rescued} FROM users_src",
        "bronze_json_evolved": f"{_USERS} SELECT * FROM users_src",
        "copy_into_twice": f"{_USERS} SELECT try_cast(id AS bigint) AS id, {rest}, {copied} FROM users_src",
        "copy_csv_twice": f"{_SPEND} SELECT *, {NO_RESCUE} FROM spend_src",
        "json_in_place": f"""{_USERS} SELECT count(*) AS users, count(DISTINCT id) AS ids,
            count(email) AS emails, count(*) FILTER (WHERE loyalty = 'gold') AS gold FROM users_src""",
        "spend_csv_int": f"{_SPEND} SELECT *, {NO_RESCUE} FROM spend_src",
        "spend_csv_float": f"{_SPEND} SELECT *, {NO_RESCUE} FROM spend_float",
        "spend_csv_drift": f"""{_SPEND} SELECT *,
            CASE WHEN id % 3 = 0 THEN '{{"channel":"web"}}' END AS _rescued_data FROM spend_float""",
        "spend_csv_evolved": f"""{_SPEND} SELECT *, {NO_RESCUE},
            CASE WHEN id % 3 = 0 THEN 'web' END AS channel FROM spend_float""",
        "silver_notebook": f"{_with(USERS, SILVER)} SELECT * FROM silver",
        "silver_declarative": f"{_with(USERS, DECLARED)} SELECT * FROM declared",
        "date_and_pattern": f"""{_USERS} SELECT id, cast({_time('creation_date')} AS date) AS created_on,
            regexp_extract(email, '\\.([0-9]+)@', 1) AS email_number,
            regexp_extract(address, '^([0-9]+) (\\S+)', 2) AS street_name,
            true AS from_parquet FROM users_src""",
        "gold_overview": f"""{_with(USERS, SPEND, SILVER)}
            SELECT p.id::bigint AS id, {silver_names}, p.age, p.annual_income, p.spending_core
            FROM silver s JOIN spend_src p ON try_cast(s.id AS bigint) = p.id""",
        "gold_notebook": f"{_GOLD} SELECT * FROM gold",
        "gold_declarative": f"{_DECLARED} SELECT *, {NO_RESCUE} FROM checked",
        "quality_metrics": f"{_DECLARED} {_rules()}",
        "top_postcodes": f"""{_USERS} SELECT postcode, count(*) AS c FROM users_src
            GROUP BY postcode ORDER BY c DESC, postcode LIMIT 10""",
        "gold_delete": f"{_GOLD} SELECT * FROM gold WHERE NOT {EARLY}",
        "gold_as_of": f"{_GOLD} SELECT * FROM gold",
        "gold_as_of_time": f"{_GOLD} SELECT * FROM gold",
        "gold_restore": f"{_GOLD} SELECT * FROM gold",
        "gold_clone": f"""{_GOLD} SELECT *, 'deep' AS kind FROM gold
            UNION ALL SELECT *, 'shallow' AS kind FROM gold WHERE NOT {EARLY}""",
        "gold_history": f"""{_GOLD}, sizes AS (
              SELECT count(*) AS a, count(*) FILTER (WHERE {EARLY}) AS d FROM gold)
            SELECT 0 AS version, 'append' AS operation, a AS inserted, 0::bigint AS deleted FROM sizes
            UNION ALL SELECT 1, 'delete', 0, d FROM sizes
            UNION ALL SELECT 2, 'restore', d, 0 FROM sizes""",
        "gold_changes": f"""{_GOLD} SELECT *, 0 AS _commit_version, 'insert' AS _change_type FROM gold
            UNION ALL SELECT *, 1, 'delete' FROM gold WHERE {EARLY}""",
        "gold_change_stream": f"""{_GOLD} SELECT *, 0 AS version, 'insert' AS change FROM gold
            UNION ALL SELECT *, 1, 'delete' FROM gold WHERE {EARLY}""",
        "gold_merge": f"""{_GOLD}, {merged},
            given AS (SELECT {no_address} FROM newest UNION ALL SELECT {no_address} FROM fresh)
            SELECT g.address, {from_given} FROM gold g JOIN given n ON g.id = n.id
            UNION ALL SELECT address, {no_address} FROM gold g
                WHERE NOT EXISTS (SELECT 1 FROM given n WHERE n.id = g.id)
            UNION ALL SELECT NULL, {no_address} FROM given n
                WHERE NOT EXISTS (SELECT 1 FROM gold g WHERE n.id = g.id)""",
        "gold_by_name": f"{_GOLD} SELECT * FROM gold WHERE NOT {EARLY}",
        "late_files": f"{_USERS} SELECT * FROM users_src",
        "landing_inventory": """SELECT 'users' AS folder, true AS has_bytes, true AS all_files
            UNION ALL SELECT 'spend', true, true UNION ALL SELECT 'absent', false, true""",
        "landing_profile": _landing_profile(),
        "sample_rand": "SELECT count(*) AS draws, true AS in_range, true AS mean_in_bounds FROM customer",
        "preview": """SELECT least(100, count(*)) AS shown, least(100, count(*)) AS members FROM lineitem""",
        "latest_sweep_run": """SELECT 'FINISHED' AS status, 'retail_segmentation' AS tag, true AS k_in_range,
            true AS has_inertia""",
        "elbow_sweep": """SELECT cast(k AS int) AS k, true AS falls, true AS agrees
            FROM (SELECT unnest([2, 3, 4, 5, 6, 7, 8, 9]) AS k)""",
        "segment_kmeans": f"""{_DECLARED} SELECT id, age, annual_income, spending_core, true AS nearest
            FROM checked""",
        "labelled_points": f"{_DECLARED} SELECT age, annual_income, spending_core, true AS nearest FROM checked",
        "silhouette": f"""{_NEAR}, points AS (SELECT row_number() OVER () AS point, * FROM near),
            sums AS (SELECT cluster, count(*) AS n, sum(age) AS sa, sum(annual_income) AS si, sum(spending_core) AS ss,
                sum(age * age + annual_income * annual_income + spending_core * spending_core) AS q
                FROM near GROUP BY cluster),
            away AS (SELECT point, p.cluster = s.cluster AS own,
                (s.n * (age * age + annual_income * annual_income + spending_core * spending_core) + s.q
                 - 2 * (age * sa + annual_income * si + spending_core * ss))
                / CASE WHEN p.cluster = s.cluster THEN nullif(s.n - 1, 0) ELSE s.n END AS d
                FROM points p CROSS JOIN sums s),
            sides AS (SELECT point, max(CASE WHEN own THEN d END) AS a, min(CASE WHEN NOT own THEN d END) AS b
                FROM away GROUP BY point)
            SELECT 4 AS k, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
            FROM sides""",
        "classify_search": """SELECT 'quality' AS name, true AS known_family, true AS is_best, true AS reused""",
        "gold_update": f"""{_GOLD} SELECT {RAW_NAMES.replace('city, ', '')},
            CASE WHEN {EARLY} THEN 'archived' ELSE city END AS city, age, annual_income,
            CASE WHEN {EARLY} THEN spending_core + 1 ELSE spending_core END AS spending_core FROM gold""",
        "compact_table": f"{_GOLD} SELECT * FROM gold WHERE NOT {EARLY} AND NOT postcode < '00010'",
        "compact_files": "SELECT * FROM orders",
        "pack_files": "SELECT * FROM orders",
        "cluster_files": """SELECT f.filter, l_orderkey, l_linenumber, l_partkey, l_shipdate
            FROM lineitem, (VALUES ('few'), ('early')) AS f(filter)
            WHERE CASE f.filter WHEN 'few' THEN l_partkey <= 20 ELSE l_shipdate < DATE '1992-03-01' END""",
        "table_profile": _profile(),
        "frequent_values": _frequent(),
        "latest_orders": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
            o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
        "latest_run": """SELECT * FROM orders WHERE o_orderstatus = 'F'
            ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",
        "pair_regression": _regression(),
        "density_bins": _histograms(),
        "pair_density_bins": _pair_histograms(),
        "density_curve": _curve(),
        "density_surface": _surface(),
        "minmax_scale": f"""{_SCALED} SELECT id, round(age, 6) AS age,
            round(annual_income, 6) AS annual_income, round(spending_core, 6) AS spending_core FROM scaled""",
        "nearest_centre": f"""{_NEAR} SELECT id, cluster,
            CASE cluster WHEN 0 THEN 'small_spenders' WHEN 1 THEN 'medium_spenders'
                         WHEN 2 THEN 'large_spenders' ELSE 'critical_spenders' END AS segment,
            round(distance, 6) AS distance FROM near""",
        "segment_arrow": f"""{_NEAR} SELECT id,
            CASE cluster WHEN 0 THEN 'small_spenders' WHEN 1 THEN 'medium_spenders'
                         WHEN 2 THEN 'large_spenders' ELSE 'critical_spenders' END AS segment FROM near""",
        "segment_stream": f"""{_NEAR} SELECT c.*, {NO_RESCUE}, n.segment FROM checked c JOIN (
            SELECT DISTINCT id, age, annual_income, spending_core, segment FROM (
              SELECT c.id, c.age, c.annual_income, c.spending_core,
                CASE cluster WHEN 0 THEN 'small_spenders' WHEN 1 THEN 'medium_spenders'
                             WHEN 2 THEN 'large_spenders' ELSE 'critical_spenders' END AS segment
              FROM checked c JOIN near n ON c.id = n.id
               AND abs(n.age - (c.age - (SELECT a0 FROM lim)) / (SELECT a1 - a0 FROM lim) * 10) < 1e-9
               AND abs(n.spending_core - (c.spending_core - (SELECT s0 FROM lim))
                       / (SELECT s1 - s0 FROM lim) * 10) < 1e-9)) n
            ON c.id = n.id AND c.age = n.age AND c.annual_income = n.annual_income
            AND c.spending_core = n.spending_core""",
        "inertia": f"{_NEAR} SELECT round(sum(distance), 3) AS inertia FROM near",
        "cluster_profile": f"""{_NEAR} SELECT cluster, round(avg(age), 6) AS age,
            round(avg(annual_income), 6) AS annual_income, round(avg(spending_core), 6) AS spending_core
            FROM near GROUP BY cluster""",
        "distinct_labels": f"{_NEAR} SELECT DISTINCT cluster FROM near",
    }
