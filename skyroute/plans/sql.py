"""The reference SQL (DuckDB dialect) that the queries are compared with."""

from __future__ import annotations

from skyroute.schema import LINE

# Rounds the recursive queries run; they fail if the last one still changed something.
COST_ROUNDS = 24
RANK_ROUNDS = 8

FLIGHTS = """flights AS (
 SELECT CAST(l_orderkey AS INT) AS num, CAST(l_linenumber AS INT) AS no,
  CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
  CAST(day(l_shipdate) AS TINYINT) AS dayofmonth,
  CAST(isodow(l_shipdate) AS TINYINT) AS dayofweek,
  CAST(floor(l_extendedprice) AS BIGINT) % 1440 + l_quantity AS DepTime,
  CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1440 AS DOUBLE) AS CRSDepTime,
  CAST(floor(l_extendedprice) AS BIGINT) % 1440 + 60 + 10 * l_linenumber
    + l_quantity + round(l_discount * 100) AS ArrTime,
  CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1440 + 60 + 10 * l_linenumber AS DOUBLE) AS CRSArrTime,
  concat(l_returnflag, l_linestatus) AS UniqueCarrier,
  CAST(l_suppkey AS VARCHAR) AS FlightNum, CAST(l_partkey % 500 AS VARCHAR) AS TailNum,
  60 + 10 * l_linenumber + round(l_discount * 100) AS ActualElapsedTime,
  CAST(60 + 10 * l_linenumber AS DOUBLE) AS CRSElapsedTime,
  40 + 10 * l_linenumber + round(l_discount * 100) AS AirTime,
  l_quantity + round(l_discount * 100) AS ArrDelay, l_quantity AS DepDelay,
  ns.n_name AS Origin, nc.n_name AS Dest,
  CAST(floor(l_extendedprice / 100) AS DOUBLE) AS Distance
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ns ON s_nationkey = ns.n_nationkey
  JOIN nation nc ON c_nationkey = nc.n_nationkey)"""

ROUTES = "routes AS (SELECT DISTINCT Origin AS src, Dest AS dst, Distance AS distance FROM flights)"

CODE_HASH = """list_reduce(
  list_prepend(CAST(0 AS BIGINT), list_transform(string_split(code, ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda h, c: ((h * 31 + c + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648)"""

AIRPORTS = f"""airports AS (
 SELECT code, {CODE_HASH} AS vertex_id
 FROM (SELECT Origin AS code FROM flights UNION SELECT Dest FROM flights))"""

TRIPLETS = """triplets AS (
 SELECT s.vertex_id AS src_id, src, d.vertex_id AS dst_id, dst, distance
 FROM routes JOIN airports s ON src = s.code JOIN airports d ON dst = d.code)"""

GRAPH = f"{FLIGHTS}, {ROUTES}, {AIRPORTS}"

DIRTY = f"""{FLIGHTS}, dirty AS (
 SELECT * REPLACE (
  CASE WHEN bad <> 0 THEN Origin END AS Origin, CASE WHEN bad <> 1 THEN Dest END AS Dest,
  CASE WHEN bad = 3 THEN CAST('NaN' AS DOUBLE) WHEN bad <> 2 THEN Distance END AS Distance,
  CASE WHEN bad = 4 THEN -DepDelay WHEN bad = 5 THEN CAST('NaN' AS DOUBLE)
       WHEN bad <> 6 THEN DepDelay END AS DepDelay)
 FROM (SELECT *, (num * 7 + no) % 23 AS bad FROM flights))"""

NO_ROUTE = "Origin IS NULL OR Dest IS NULL OR Distance IS NULL OR isnan(Distance)"

DIRTY_LABELLED = f"""{DIRTY}, labelled AS (
 SELECT *, CASE WHEN DepDelay < 40 THEN CAST(0 AS DOUBLE)
                WHEN DepDelay >= 40 THEN CAST(1 AS DOUBLE) END AS label
 FROM dirty WHERE DepDelay IS NULL OR NOT (DepDelay < 0 OR isnan(DepDelay)))"""

# A negative or NaN delay fails here as it does in the query.
LABELLED = f"""{FLIGHTS}, labelled AS (
 SELECT *, CASE WHEN DepDelay < 0 OR isnan(DepDelay) THEN CAST(error('no bucket for a delay') AS DOUBLE)
                WHEN DepDelay < 40 THEN CAST(0 AS DOUBLE)
                WHEN DepDelay >= 40 THEN CAST(1 AS DOUBLE) END AS label FROM flights)"""

HOPS = """hops AS (
 SELECT DISTINCT src, dst, dist FROM (
  SELECT l_partkey AS src,
   lead(l_partkey) OVER (PARTITION BY l_orderkey
     ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS dst,
   CAST(floor(l_extendedprice / 100) AS DOUBLE) AS dist
  FROM lineitem) t
 WHERE dst IS NOT NULL),
stops AS (SELECT src AS code FROM hops UNION SELECT dst FROM hops)"""

SCORED = """scored AS (
 SELECT CASE WHEN l_quantity >= 40 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
  (l_quantity + round(l_discount * 100)) / 100 AS score,
  CASE WHEN l_quantity + round(l_discount * 100) >= 45 THEN CAST(1 AS DOUBLE)
       ELSE CAST(0 AS DOUBLE) END AS prediction
 FROM lineitem)"""

SPLIT_KEY = "CAST(num AS BIGINT) * 7919 + CAST(no AS BIGINT) * 104729 + CAST(FlightNum AS BIGINT) * 31"

# Spreads the key over 2**53 values; the product passes 2**63 beyond scale 0.1.
WIDE_FACTOR = 999_999_937

# Another draw from the same key, for the split of a sample that was drawn by it.
SECOND_KEY = f"({SPLIT_KEY}) {{div}} 1000"

# The tenth field of a short line is its last; a number fewer of fields is malformed as well.
MALFORMED_CSV = f"""WITH {FLIGHTS} SELECT count(*) AS n_lines,
 count(*) FILTER (dayofweek = 7 OR no = 5) AS malformed, count(*) FILTER (no = 5) AS short_lines FROM flights"""

PROJECTED = ", ".join(f"{f.name.lower()} AS {f.name}" for f in LINE)


def cost_rounds(src: str, dst: str, keys: str, start: str) -> str:
    """Relax from ``start`` round by round; a zero-cost edge to itself keeps old costs."""
    return f"""links AS (
 SELECT {src} AS src, {dst} AS dst, min(50 + dist / 2) AS cost FROM hops GROUP BY src, dst),
steps AS (SELECT * FROM links UNION ALL SELECT code, code, CAST(0 AS DOUBLE) FROM stops),
relaxed AS (
 {start}
 UNION ALL
 SELECT round + 1, steps.dst, {keys} min(relaxed.cost + steps.cost)
 FROM relaxed JOIN steps ON steps.src = relaxed.vertex
 WHERE round < {COST_ROUNDS} GROUP BY ALL),
changed AS (
 SELECT count(*) AS n FROM (
  SELECT * EXCLUDE (round) FROM relaxed WHERE round = {COST_ROUNDS}
  EXCEPT SELECT * EXCLUDE (round) FROM relaxed WHERE round = {COST_ROUNDS} - 1)),
settled AS (
 SELECT relaxed.* EXCLUDE (round) FROM relaxed, changed WHERE round = {COST_ROUNDS}
  AND CASE WHEN n > 0 THEN CAST(error('costs need more rounds') AS BOOLEAN) ELSE true END)"""


FROM_SOURCE = f"""{HOPS}, {cost_rounds(
    "src", "dst", "",
    "SELECT 0 AS round, code AS vertex, CAST(0 AS DOUBLE) AS cost FROM stops WHERE code = 0")}"""

TREE = f"""{FROM_SOURCE}, tree AS (
 SELECT links.dst AS vertex, min(links.src) AS head FROM links
  JOIN settled a ON a.vertex = links.src JOIN settled b ON b.vertex = links.dst
 WHERE a.cost + links.cost = b.cost AND links.dst <> 0 GROUP BY links.dst),
paths AS (
 SELECT CAST(0 AS BIGINT) AS vertex, '0' AS path, 1 AS stops_on_path
 UNION ALL
 SELECT tree.vertex, path || '->' || CAST(tree.vertex AS VARCHAR), stops_on_path + 1
 FROM paths JOIN tree ON tree.head = paths.vertex)"""

TO_LANDMARKS = f"""{HOPS}, {cost_rounds(
    "dst", "src", "landmark,",
    "SELECT 0 AS round, code AS vertex, code AS landmark, CAST(0 AS DOUBLE) AS cost "
    "FROM stops WHERE code IN (0, 7, 42)")}"""


def rank_rounds(vertices: str, edges: str, tolerance: float = 0.1) -> str:
    """PageRank by deltas; the rows with keep = 1 carry each rank into the next round."""
    return f"""copies AS (SELECT src, dst, count(*) AS n FROM {edges} GROUP BY src, dst),
degrees AS (SELECT src, sum(n) AS degree FROM copies GROUP BY src),
steps AS (
 SELECT copies.src, dst, CAST(n AS DOUBLE) / CAST(degree AS DOUBLE) AS share, 0 AS keep
 FROM copies JOIN degrees ON degrees.src = copies.src
 UNION ALL SELECT code, code, CAST(0 AS DOUBLE), 1 FROM {vertices}),
rounds AS (
 SELECT 0 AS round, code AS vertex, CAST(0.15 AS DOUBLE) AS rank, CAST(0.15 AS DOUBLE) AS delta
 FROM {vertices}
 UNION ALL
 SELECT round + 1, dst,
  max(CASE WHEN keep = 1 THEN rank END)
   + 0.85 * sum(CASE WHEN keep = 0 AND delta > {tolerance} THEN delta * share ELSE 0 END),
  0.85 * sum(CASE WHEN keep = 0 AND delta > {tolerance} THEN delta * share ELSE 0 END)
 FROM rounds JOIN steps ON steps.src = rounds.vertex
 WHERE round < {RANK_ROUNDS} GROUP BY round, dst),
ranks AS (
 SELECT vertex, rank * count(*) OVER () / sum(rank) OVER () AS rank
 FROM rounds WHERE round = {RANK_ROUNDS}
  AND CASE WHEN delta > {tolerance} THEN CAST(error('ranks need more rounds') AS BOOLEAN) ELSE true END)"""


# Figures of the 2 x 2 confusion counts.
MACRO = """counts AS (
 SELECT CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn,
  CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
  CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp FROM scored),
macro AS (
 SELECT (tp / (tp + fp) + tn / (tn + fn)) / 2 AS precision,
  (tp / (tp + fn) + tn / (tn + fp)) / 2 AS recall,
  (fp / (fp + tn) + fn / (fn + tp)) / 2 AS fpr,
  (2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2 AS f1,
  (tp + tn) / (tp + tn + fp + fn) AS accuracy,
  (1 + tp / (tp + fn) - fp / (fp + tn)) / 2 AS balanced_accuracy FROM counts)"""

POINTS = """by_score AS (
 SELECT score AS threshold, sum(label) AS p, count(*) - sum(label) AS n FROM scored GROUP BY score),
points AS (
 SELECT threshold, sum(p) OVER later AS tp, sum(n) OVER later AS fp,
  sum(p) OVER () AS all_p, sum(n) OVER () AS all_n
 FROM by_score WINDOW later AS (ORDER BY threshold DESC)),
rates AS (
 SELECT threshold, fp / all_n AS fpr, tp / all_p AS recall, tp / (tp + fp) AS precision FROM points)"""

AREAS = f"""{POINTS}, areas AS (
 SELECT sum((fpr - coalesce(old_fpr, 0)) * (recall + coalesce(old_recall, 0)) / 2) AS auroc,
  sum((recall - coalesce(old_recall, 0)) * (precision + coalesce(old_precision, precision)) / 2) AS auprc
 FROM (SELECT *, lag(fpr) OVER w AS old_fpr, lag(recall) OVER w AS old_recall,
   lag(precision) OVER w AS old_precision FROM rates WINDOW w AS (ORDER BY threshold DESC)))"""


def profile_sql() -> str:
    rows = []
    for position, field in enumerate(LINE, start=1):
        name, text = field.name, field.dataType.simpleString() == "string"
        number = "CAST(NULL AS DOUBLE)" if text else f"CAST({name} AS DOUBLE)"
        string = name if text else "CAST(NULL AS VARCHAR)"
        rows.append(
            f"SELECT {position} AS position, '{name}' AS name, '{field.dataType.simpleString()}' AS type,"
            f" count({name}) AS non_null, count(DISTINCT {name}) AS distinct_values,"
            f" min({number}) AS min_number, max({number}) AS max_number,"
            f" min({string}) AS min_text, max({string}) AS max_text FROM flights"
        )
    return f"WITH {FLIGHTS} " + " UNION ALL ".join(rows)


BALANCE = """balance AS (
 SELECT count(*) FILTER (label = 1) AS late, count(*) AS total FROM labelled),
ratios AS (SELECT *, CAST(late AS DOUBLE) / CAST(total - late AS DOUBLE) AS ratio FROM balance)"""

INDEXES = """flight_index AS (
 SELECT FlightNum AS value, count(*) AS n,
  CAST(row_number() OVER (ORDER BY count(*) DESC, FlightNum) - 1 AS DOUBLE) AS position
 FROM flights GROUP BY FlightNum),
tail_index AS (
 SELECT TailNum AS value, count(*) AS n,
  CAST(row_number() OVER (ORDER BY count(*) DESC, TailNum) - 1 AS DOUBLE) AS position
 FROM flights GROUP BY TailNum)"""

FEATURES = f"""{LABELLED}, {INDEXES}, features AS (
 SELECT num, no, label, f.position AS f0, t.position AS f1, CAST(dayofweek AS DOUBLE) AS f2,
  DepTime AS f3, CRSDepTime AS f4, ArrTime AS f5, CRSArrTime AS f6
 FROM labelled JOIN flight_index f ON f.value = FlightNum JOIN tail_index t ON t.value = TailNum)"""

# The same of the evened-out sample.
SAMPLE_FEATURES = f"""{LABELLED}, {BALANCE}, sampled AS (
 SELECT labelled.* FROM labelled, ratios WHERE label = 1 OR ({SPLIT_KEY}) % 1000 < least(1, ratio) * 1000),
{INDEXES.replace("FROM flights", "FROM sampled")}, features AS (
 SELECT num, no, label, f.position AS f0, t.position AS f1, CAST(dayofweek AS DOUBLE) AS f2,
  DepTime AS f3, CRSDepTime AS f4, ArrTime AS f5, CRSArrTime AS f6
 FROM sampled JOIN flight_index f ON f.value = FlightNum JOIN tail_index t ON t.value = TailNum)"""


def bayes_sql() -> str:
    sums = ", ".join(f"sum(f{i}) AS s{i}" for i in range(7))
    whole = " + ".join(f"s{i}" for i in range(7))
    rows = " UNION ALL ".join(
        f"SELECT label, {i} AS feature, round(ln((s{i} + 1) / ({whole} + 7)), 6) AS log_theta,"
        f" round(ln((n + 1) / (sum(n) OVER () + 2)), 6) AS log_pi FROM sums"
        for i in range(7)
    )
    return (
        f"WITH {FEATURES}, sums AS (SELECT label, CAST(count(*) AS DOUBLE) AS n, {sums}"
        f" FROM features GROUP BY label) {rows}"
    )


def bayes_predictions_sql() -> str:
    """Each row's class by the sums of the training rows."""
    sums = ", ".join(f"sum(f{i}) AS s{i}" for i in range(7))
    whole = " + ".join(f"s{i}" for i in range(7))
    value = " + ".join(f"f{i} * ln((s{i} + 1) / ({whole} + 7))" for i in range(7))
    return f"""WITH {FEATURES}, sums AS (
 SELECT label AS class, CAST(count(*) AS DOUBLE) AS n, {sums} FROM features GROUP BY label),
classes AS (SELECT *, ln((n + 1) / (sum(n) OVER () + 2)) AS prior FROM sums)
SELECT num, no, label, class AS prediction FROM (
 SELECT num, no, label, class, row_number() OVER (PARTITION BY rid ORDER BY prior + {value} DESC, class) AS place
 FROM (SELECT *, row_number() OVER () AS rid FROM features), classes) WHERE place = 1"""


_CATEGORICAL = (0, 1)


def _splits() -> str:
    """Every split of every feature: numbers at midpoints, categories in the
    learner's order, by how many rows of class 1 they have."""
    cells = " UNION ALL ".join(f"SELECT {i} AS feature, f{i} AS value, label FROM features" for i in range(7))
    order = f"CASE WHEN feature IN {_CATEGORICAL} THEN p ELSE value END, value"

    def gini(ones: str, rows: str) -> str:
        return f"(1 - ({ones} / {rows}) ** 2 - (({rows} - {ones}) / {rows}) ** 2)"

    return f"""cells AS ({cells}),
counts AS (SELECT feature, value, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n FROM cells GROUP BY ALL),
running AS (
 SELECT feature, value, row_number() OVER w AS place, sum(p) OVER w AS lp, sum(n) OVER w AS ln,
  sum(p) OVER (PARTITION BY feature) AS p, sum(n) OVER (PARTITION BY feature) AS n, lead(value) OVER w AS following
 FROM counts WINDOW w AS (PARTITION BY feature ORDER BY {order})),
splits AS (
 SELECT *, {gini("p", "n")} - ln / n * {gini("lp", "ln")} - (n - ln) / n * {gini("(p - lp)", "(n - ln)")} AS gain
 FROM running WHERE ln < n),
best AS (SELECT * FROM splits ORDER BY gain DESC, feature, place LIMIT 1),
root AS (
 SELECT feature, place, gain, lp, ln, p, n,
  CASE WHEN feature NOT IN {_CATEGORICAL} THEN (value + following) / 2 END AS threshold,
  CASE WHEN feature IN {_CATEGORICAL} THEN (SELECT list(CAST(value AS BIGINT) ORDER BY value) FROM running r
   WHERE r.feature = best.feature AND r.place <= best.place) END AS left_categories FROM best)"""


def root_split_sql() -> str:
    return f"""WITH {SAMPLE_FEATURES}, {_splits()}
SELECT CAST(feature AS INT) AS feature, threshold, array_to_string(left_categories, ',') AS left_categories,
 round(gain, 9) AS gain FROM root"""


def stump_predictions_sql() -> str:
    value = " ".join(f"WHEN {i} THEN f{i}" for i in range(7))
    return f"""WITH {SAMPLE_FEATURES}, {_splits()}
SELECT num, no, label, CASE WHEN CASE WHEN threshold IS NULL THEN list_contains(left_categories, CAST(x AS BIGINT))
  ELSE x <= threshold END
 THEN CASE WHEN lp > ln - lp THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
 ELSE CASE WHEN p - lp > n - ln - p + lp THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS prediction
FROM (SELECT *, CASE feature {value} END AS x FROM features, root)"""


def stump_importances_sql() -> str:
    names = ("IndexedFlightNum", "IndexedTailNum", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime")
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(names))
    return f"""WITH {SAMPLE_FEATURES}, {_splits()}
SELECT name, CASE WHEN i = feature THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance
FROM root, (VALUES {rows}) AS named(i, name)"""
