"""Every query by name, with the SQL it is compared with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute import schema
from skyroute.functions.costmaps import add_to_costs, cheaper_costs
from skyroute.functions.scratch import new_folder, write_table
from skyroute.operators import evaluate, graph, learn, paths, prep, ranks
from skyroute.plans import sql
from skyroute.sources import flights as source
from skyroute.sources import testviews

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SOURCE = 0
LANDMARKS = (0, 7, 42)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def _graph(spark: SparkSession, sf: str, store: bool = True) -> graph.RouteGraph:
    return graph.build_graph(testviews.flights(spark, sf), store)


def _hop_graph(spark: SparkSession, sf: str) -> graph.RouteGraph:
    routes = write_table(testviews.hops(spark, sf).withColumnRenamed("dist", "distance"))
    codes = routes.select(F.explode(F.array("src", "dst")).alias("code")).distinct()
    return graph.RouteGraph(codes, routes)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return prep.label_delays(testviews.flights(spark, sf))


def _tally(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.tally(testviews.scored(spark, sf))


def _split_key() -> Column:
    return F.expr(sql.SPLIT_KEY)


def _second_key() -> Column:
    return F.expr(sql.SECOND_KEY.format(div="div"))


def _as_csv(table: DataFrame) -> str:
    path = new_folder(table.sparkSession)
    table.write.option("header", True).csv(path)
    return path


# --- sources ---


@query("scan_flights_csv", f"WITH {sql.FLIGHTS} SELECT {sql.PROJECTED} FROM flights")
def scan_flights_csv(spark, sf):
    flights = testviews.flights(spark, sf)
    rest = [f.name for f in schema.FLIGHTS if f.name not in flights.columns]
    path = _as_csv(flights.select("*", *[F.lit(None).cast("string").alias(c) for c in rest]))
    return source.project(source.read_csv(spark, path))


@query(
    "flights_preview",
    f"WITH {sql.FLIGHTS} SELECT {sql.PROJECTED} FROM flights ORDER BY ALL LIMIT 10",
)
def flights_preview(spark, sf):
    return source.preview(testviews.flights(spark, sf), 10)


@query("flights_count", f"WITH {sql.FLIGHTS} SELECT count(*) AS n FROM flights")
def flights_count(spark, sf):
    return testviews.flights(spark, sf).agg(F.count(F.lit(1)).alias("n"))


@query("flights_profile", sql.profile_sql())
def flights_profile(spark, sf):
    return source.profile(source.project(testviews.flights(spark, sf)))


def _as_lines(flights: DataFrame) -> DataFrame:
    path = new_folder(flights.sparkSession)
    flights.select(F.concat_ws(",", *flights.columns).alias("line")).write.text(path)
    return source.read_lines(flights.sparkSession, path)


@query("parse_flight_lines", f"WITH {sql.FLIGHTS} SELECT {sql.PROJECTED} FROM flights")
def parse_flight_lines(spark, sf):
    return source.parse_lines(_as_lines(source.project(testviews.flights(spark, sf))))


@query(
    "parse_malformed_lines",
    f"""WITH {sql.FLIGHTS} SELECT Origin, dayofweek = 7 AS malformed, count(*) AS n,
    count(CASE WHEN dayofweek <> 7 THEN 1 END) AS days FROM flights GROUP BY ALL""",
)
def parse_malformed_lines(spark, sf):
    """The lines of Sundays hold a name for the day, which is no number."""
    flights = source.project(testviews.flights(spark, sf))
    day = F.when(F.col("DayOfWeek") == 7, "Sun").otherwise(F.col("DayOfWeek").cast("string"))
    parsed = source.parse_lines(_as_lines(flights.withColumn("DayOfWeek", day)), strict=False)
    return parsed.groupBy("Origin", "malformed").agg(
        F.count(F.lit(1)).alias("n"), F.count("DayOfWeek").alias("days")
    )


@query("scan_malformed_csv", sql.MALFORMED_CSV)
def scan_malformed_csv(spark, sf):
    """Sundays hold a name for the day, and every fifth line ends after ten fields."""
    flights = testviews.flights(spark, sf)
    known = {c.lower(): c for c in flights.columns}
    cells = [F.col(known[f.name.lower()]).cast("string") if f.name.lower() in known else F.lit("0") for f in schema.FLIGHTS]
    cells = [F.when(F.col("dayofweek") == 7, "Sun").otherwise(c) if f.name == "dayofweek" else c
             for f, c in zip(schema.FLIGHTS, cells)]
    whole, short = F.concat_ws(",", *cells), F.concat_ws(",", *cells[:10])
    path = new_folder(spark)
    flights.select(F.when(F.col("no") == 5, short).otherwise(whole).alias("line")).write.text(path)
    return source.csv_report(source.read_csv(spark, path, corrupt=True, header=False))


def _upper_layout(flights: DataFrame) -> DataFrame:
    known = {
        "YEAR": "year", "MONTH": "month", "DAY": "dayofmonth", "DAY_OF_WEEK": "dayofweek",
        "AIRLINE": "UniqueCarrier", "FLIGHT_NUMBER": "FlightNum", "TAIL_NUMBER": "TailNum",
        "ORIGIN_AIRPORT": "Origin", "DESTINATION_AIRPORT": "Dest", "DISTANCE": "Distance",
    }
    return flights.select(
        *[
            (F.col(known[f.name]) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.UPPER_LAYOUT
        ]
    )


_ROUTE_ROWS = f"WITH {sql.FLIGHTS} SELECT Origin, Dest, Distance FROM flights"


@query("layout_normalize", _ROUTE_ROWS)
def layout_normalize(spark, sf):
    path = _as_csv(_upper_layout(testviews.flights(spark, sf)))
    return source.normalize_layout(source.read_csv(spark, path, schema.UPPER_LAYOUT))


@query("layout_normalize_short", _ROUTE_ROWS)
def layout_normalize_short(spark, sf):
    table = _upper_layout(testviews.flights(spark, sf)).select(*schema.SHORT_COLUMNS)
    return source.normalize_layout(source.read_csv(spark, _as_csv(table), schema.SHORT_LAYOUT))


@query("project_flights", f"WITH {sql.FLIGHTS} SELECT {sql.PROJECTED} FROM flights")
def project_flights(spark, sf):
    return source.project(testviews.flights(spark, sf))


# --- graph construction and listings ---


@query("graph_vertices", f"WITH {sql.GRAPH} SELECT code FROM airports")
def graph_vertices(spark, sf):
    return graph.airports(testviews.flights(spark, sf)).select("code")


@query("vertex_hash_ids", f"WITH {sql.GRAPH} SELECT code, vertex_id FROM airports")
def vertex_hash_ids(spark, sf):
    return graph.airports(testviews.flights(spark, sf))


@query("graph_edges", f"WITH {sql.GRAPH} SELECT src, dst, distance FROM routes")
def graph_edges(spark, sf):
    return graph.routes(testviews.flights(spark, sf))


@query(
    "rejected_flights",
    f"""WITH {sql.FLIGHTS} SELECT count(*) FILTER (Origin IS NULL OR Dest IS NULL OR Distance IS NULL)
    AS rejected FROM flights""",
)
def rejected_flights(spark, sf):
    return graph.rejected_flights(testviews.flights(spark, sf))


@query(
    "graph_dangling",
    f"""WITH {sql.FLIGHTS}, {sql.ROUTES},
    listed AS (SELECT n_name AS code FROM nation WHERE n_regionkey <> 0)
    SELECT src, dst, distance, coalesce(s.code, 'nowhere') AS src_code,
     coalesce(d.code, 'nowhere') AS dst_code
    FROM routes LEFT JOIN listed s ON src = s.code LEFT JOIN listed d ON dst = d.code""",
)
def graph_dangling(spark, sf):
    """The airport list leaves out one region, so routes to it dangle."""
    listed = testviews.table(spark, sf, "nation").filter(F.col("n_regionkey") != 0)
    airports = listed.select(F.col("n_name").alias("code"))
    return graph.attach_codes(graph.RouteGraph(airports, _graph(spark, sf, store=False).routes))


@query(
    "graph_size",
    f"""WITH {sql.GRAPH} SELECT (SELECT count(*) FROM airports) AS airports,
    (SELECT count(*) FROM routes) AS routes""",
)
def graph_size(spark, sf):
    return graph.graph_size(_graph(spark, sf))


@query(
    "list_vertices",
    f"""WITH {sql.GRAPH} SELECT row_number() OVER (ORDER BY code) AS number, vertex_id, code
    FROM airports""",
)
def list_vertices(spark, sf):
    return graph.list_airports(_graph(spark, sf))


@query(
    "list_edges",
    f"""WITH {sql.GRAPH}, {sql.TRIPLETS}
    SELECT row_number() OVER (ORDER BY src, dst, distance) AS number, * FROM triplets""",
)
def list_edges(spark, sf):
    return graph.list_routes(_graph(spark, sf))


@query("triplets", f"WITH {sql.GRAPH}, {sql.TRIPLETS} SELECT * FROM triplets")
def triplets(spark, sf):
    return graph.triplets(_graph(spark, sf))


@query(
    "edges_longer_than",
    f"""WITH {sql.GRAPH}, {sql.TRIPLETS}
    SELECT row_number() OVER (ORDER BY distance, src, dst) AS number, * FROM triplets
    WHERE distance > 500""",
)
def edges_longer_than(spark, sf):
    return graph.routes_longer_than(_graph(spark, sf), 500)


@query("edge_costs", f"WITH {sql.GRAPH} SELECT *, 50 + distance / 2 AS cost FROM routes")
def edge_costs(spark, sf):
    return graph.route_costs(_graph(spark, sf, store=False).routes)


# --- degrees and top-k ---


@query("in_degrees", f"WITH {sql.GRAPH} SELECT dst AS code, count(*) AS routes FROM routes GROUP BY dst")
def in_degrees(spark, sf):
    return graph.in_degrees(_graph(spark, sf, store=False))


@query("out_degrees", f"WITH {sql.GRAPH} SELECT src AS code, count(*) AS routes FROM routes GROUP BY src")
def out_degrees(spark, sf):
    return graph.out_degrees(_graph(spark, sf, store=False))


_ENDS = "ends AS (SELECT src AS code FROM routes UNION ALL SELECT dst FROM routes)"


@query(
    "total_degrees",
    f"WITH {sql.GRAPH}, {_ENDS} SELECT code, count(*) AS routes FROM ends GROUP BY code",
)
def total_degrees(spark, sf):
    return graph.total_degrees(_graph(spark, sf, store=False))


@query(
    "max_degrees",
    f"""WITH {sql.GRAPH}, {_ENDS}, degrees AS (
     SELECT 'incoming' AS kind, dst AS code, count(*) AS routes FROM routes GROUP BY dst
     UNION ALL SELECT 'outgoing', src, count(*) FROM routes GROUP BY src
     UNION ALL SELECT 'total', code, count(*) FROM ends GROUP BY code)
    SELECT kind, code, routes FROM degrees
    QUALIFY row_number() OVER (PARTITION BY kind ORDER BY routes DESC, code) = 1""",
)
def max_degrees(spark, sf):
    return graph.max_degrees(_graph(spark, sf, store=False))


def _top_sql(end: str, limit: str) -> str:
    return f"""WITH {sql.GRAPH}, degrees AS (
     SELECT {end} AS code, count(*) AS routes FROM routes GROUP BY {end})
    SELECT row_number() OVER (ORDER BY routes DESC, code) AS rank, code, routes
    FROM degrees ORDER BY rank {limit}"""


@query("top_incoming", _top_sql("dst", "LIMIT 10"))
def top_incoming(spark, sf):
    return graph.top_incoming(_graph(spark, sf))


@query("ranked_incoming", _top_sql("dst", ""))
def ranked_incoming(spark, sf):
    return graph.top_incoming(_graph(spark, sf), rows=None)


@query("top_outgoing", _top_sql("src", "LIMIT 10"))
def top_outgoing(spark, sf):
    return graph.top_outgoing(_graph(spark, sf))


@query(
    "cheapest_routes",
    f"""WITH {sql.GRAPH} SELECT row_number() OVER (ORDER BY cost, src, dst) AS rank, src, dst, cost
    FROM (SELECT src, dst, 50 + distance / 2 AS cost FROM routes) ORDER BY rank LIMIT 10""",
)
def cheapest_routes(spark, sf):
    return graph.cheapest_routes(_graph(spark, sf))


# --- iterative graph queries ---


def _rank_sql(vertices: str, edges: str, base: str) -> str:
    return f"""WITH RECURSIVE {base}, {sql.rank_rounds(vertices, edges)}
    SELECT vertex, round(rank, 6) AS rank FROM ranks"""


def _rounded(ranked: DataFrame) -> DataFrame:
    return ranked.select("vertex", F.round("rank", 6).alias("rank"))


@query("pagerank", _rank_sql("airports", "routes", sql.GRAPH))
def pagerank(spark, sf):
    flights = _graph(spark, sf)
    return _rounded(ranks.page_rank(flights.airports, flights.routes))


@query("pagerank_hops", _rank_sql("stops", "hops", sql.HOPS))
def pagerank_hops(spark, sf):
    hops = _hop_graph(spark, sf)
    return _rounded(ranks.page_rank(hops.airports, hops.routes))


@query(
    "top_pagerank",
    f"""WITH RECURSIVE {sql.GRAPH}, {sql.rank_rounds("airports", "routes")}
    SELECT row_number() OVER (ORDER BY rank DESC, vertex) AS rank, vertex AS code,
     round(rank, 6) AS score FROM ranks ORDER BY ranks.rank DESC, vertex LIMIT 10""",
)
def top_pagerank(spark, sf):
    top = ranks.top_ranked(_graph(spark, sf))
    return top.withColumn("score", F.round("score", 6))


@query(
    "sssp_costs",
    f"""WITH RECURSIVE {sql.FROM_SOURCE}
    SELECT code AS vertex, coalesce(cost, CAST('Infinity' AS DOUBLE)) AS cost
    FROM stops LEFT JOIN settled ON vertex = code""",
)
def sssp_costs(spark, sf):
    hops = _hop_graph(spark, sf)
    return paths.cheapest_costs(hops.airports, graph.route_costs(hops.routes), SOURCE)


@query(
    "sssp_paths",
    f"""WITH RECURSIVE {sql.TREE}
    SELECT vertex, cost, path FROM paths JOIN settled USING (vertex)""",
)
def sssp_paths(spark, sf):
    hops = _hop_graph(spark, sf)
    found = paths.cheapest_paths(hops.airports, graph.route_costs(hops.routes), SOURCE)
    return found.select("vertex", "cost", paths.render_path(F.col("path")).alias("path"))


@query(
    "cheapest_paths",
    f"""WITH RECURSIVE {sql.TREE}
    SELECT row_number() OVER (ORDER BY cost, vertex) AS rank, vertex, path, cost
    FROM paths JOIN settled USING (vertex) WHERE stops_on_path > 2 ORDER BY rank LIMIT 10""",
)
def cheapest_paths(spark, sf):
    return paths.cheapest_multi_hop_paths(_hop_graph(spark, sf), SOURCE)


@query(
    "cheapest_airports",
    f"""WITH RECURSIVE {sql.FROM_SOURCE}
    SELECT row_number() OVER (ORDER BY cost, vertex) AS rank, vertex AS code, cost
    FROM settled ORDER BY rank LIMIT 10""",
)
def cheapest_airports(spark, sf):
    return paths.cheapest_airports(_hop_graph(spark, sf), SOURCE)


@query(
    "landmark_costs",
    f"WITH RECURSIVE {sql.TO_LANDMARKS} SELECT vertex, landmark, cost FROM settled",
)
def landmark_costs(spark, sf):
    hops = _hop_graph(spark, sf)
    return paths.costs_to_landmarks(hops.airports, graph.route_costs(hops.routes), LANDMARKS)


@query(
    "landmark_maps",
    f"""WITH RECURSIVE {sql.TO_LANDMARKS}
    SELECT code AS vertex, coalesce(string_agg(landmark || '=' || cost, ',' ORDER BY landmark), '') AS costs
    FROM stops LEFT JOIN settled ON vertex = code GROUP BY code""",
)
def landmark_maps(spark, sf):
    """Each vertex's map, its entries in order as text."""
    hops = _hop_graph(spark, sf)
    maps = paths.landmark_maps(hops.airports, graph.route_costs(hops.routes), LANDMARKS)
    entries = F.transform(F.array_sort(F.map_entries("costs")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return maps.select("vertex", F.array_join(entries, ",").alias("costs"))


@query(
    "landmark_map_merge",
    f"WITH RECURSIVE {sql.TO_LANDMARKS} SELECT vertex, landmark, cost + 50 AS cost FROM settled",
)
def landmark_map_merge(spark, sf):
    """The maps of two landmark lists that overlap, merged, with a fee on every cost."""
    hops = _hop_graph(spark, sf)
    airports = write_table(hops.airports)
    edges = paths.lay_out_backwards(graph.route_costs(hops.routes))
    try:
        first = paths.landmark_maps(airports, edges, LANDMARKS[:2])
        second = paths.landmark_maps(airports, edges, LANDMARKS[1:])
    finally:
        edges.drop()
    merged = first.join(second.withColumnRenamed("costs", "others"), "vertex").select(
        "vertex", add_to_costs(cheaper_costs(F.col("costs"), F.col("others")), F.lit(50)).alias("costs")
    )
    return merged.select("vertex", F.explode("costs").alias("landmark", "cost"))


# --- labels, samples, features ---


@query("delay_label", f"WITH {sql.LABELLED} SELECT num, no, DepDelay, label FROM labelled")
def delay_label(spark, sf):
    return _labelled(spark, sf).select("num", "no", "DepDelay", "label")


@query("label_counts", f"WITH {sql.LABELLED} SELECT label, count(*) AS n FROM labelled GROUP BY label")
def label_counts(spark, sf):
    return prep.label_counts(_labelled(spark, sf))


_BALANCE = sql.BALANCE


@query(
    "class_balance",
    f"""WITH {sql.LABELLED}, {_BALANCE}
    SELECT late, total, ratio, least(1, ratio) AS fraction FROM ratios""",
)
def class_balance(spark, sf):
    return prep.class_balance(_labelled(spark, sf))


@query(
    "rejected_delays",
    f"""WITH {sql.DIRTY} SELECT count(*) FILTER (DepDelay < 0) AS negative,
    count(*) FILTER (isnan(DepDelay)) AS nan, count(*) FILTER (DepDelay IS NULL) AS missing,
    count(*) AS total FROM dirty""",
)
def rejected_delays(spark, sf):
    return prep.rejected_delays(testviews.dirty_flights(spark, sf))


def _dirty_labelled(spark: SparkSession, sf: str) -> DataFrame:
    return prep.label_delays(testviews.dirty_flights(spark, sf), invalid="skip")


@query("delay_label_dirty", f"WITH {sql.DIRTY_LABELLED} SELECT num, no, DepDelay, label FROM labelled")
def delay_label_dirty(spark, sf):
    return _dirty_labelled(spark, sf).select("num", "no", "DepDelay", "label")


@query("label_counts_dirty", f"WITH {sql.DIRTY_LABELLED} SELECT label, count(*) AS n FROM labelled GROUP BY label")
def label_counts_dirty(spark, sf):
    return prep.label_counts(_dirty_labelled(spark, sf))


@query(
    "class_balance_dirty",
    f"""WITH {sql.DIRTY_LABELLED}, {_BALANCE}
    SELECT late, total, ratio, least(1, ratio) AS fraction FROM ratios""",
)
def class_balance_dirty(spark, sf):
    return prep.class_balance(_dirty_labelled(spark, sf))


@query(
    "rejected_flights_dirty",
    f"WITH {sql.DIRTY} SELECT count(*) FILTER ({sql.NO_ROUTE}) AS rejected FROM dirty",
)
def rejected_flights_dirty(spark, sf):
    return graph.rejected_flights(testviews.dirty_flights(spark, sf))


@query(
    "graph_edges_dirty",
    f"""WITH {sql.DIRTY} SELECT DISTINCT Origin AS src, Dest AS dst, Distance AS distance
    FROM dirty WHERE NOT ({sql.NO_ROUTE})""",
)
def graph_edges_dirty(spark, sf):
    return graph.routes(testviews.dirty_flights(spark, sf))


@query("stratified_sample")
def stratified_sample(spark, sf):
    return prep.stratified_sample(_labelled(spark, sf))


@query("balanced_sample")
def balanced_sample(spark, sf):
    return prep.balanced_sample(_labelled(spark, sf))


@query(
    "balanced_by_key",
    f"""WITH {sql.LABELLED}, {_BALANCE}
    SELECT num, no, DepDelay, label FROM labelled, ratios
    WHERE label = 1 OR ({sql.SPLIT_KEY}) % 1000 < least(1, ratio) * 1000""",
)
def balanced_by_key(spark, sf):
    sample = prep.balanced_by_key(_labelled(spark, sf), _split_key(), values=1000)
    return sample.select("num", "no", "DepDelay", "label")


@query(
    "stratified_by_key",
    f"""WITH {sql.LABELLED}, {_BALANCE}
    SELECT num, no, DepDelay, label FROM labelled, ratios
    WHERE label IS NOT NULL AND ({sql.SPLIT_KEY}) % 1000 < least(1, ratio) * 1000""",
)
def stratified_by_key(spark, sf):
    sample = prep.stratified_by_key(_labelled(spark, sf), _split_key(), values=1000)
    return sample.select("num", "no", "DepDelay", "label")


@query("random_split")
def random_split(spark, sf):
    train, test = prep.random_split(_labelled(spark, sf))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query(
    "hash_split",
    f"""WITH {sql.LABELLED} SELECT num, no, label,
    CASE WHEN ({sql.SPLIT_KEY}) % 1000 < 700 THEN 'train' ELSE 'test' END AS part FROM labelled""",
)
def hash_split(spark, sf):
    return prep.split_by_key(_labelled(spark, sf), _split_key(), values=1000).select("num", "no", "label", "part")


@query("string_index", f"WITH {sql.FLIGHTS}, {sql.INDEXES} SELECT * FROM flight_index")
def string_index(spark, sf):
    return prep.index_values(testviews.flights(spark, sf), "FlightNum")


@query("assemble_features", f"WITH {sql.FEATURES} SELECT * FROM features")
def assemble_features(spark, sf):
    rows = prep.assemble_features(_labelled(spark, sf))
    features = prep.feature_array()
    return rows.select("num", "no", "label", *[features[i].alias(f"f{i}") for i in range(7)])


@query(
    "split_counts",
    f"""WITH {sql.LABELLED} SELECT CASE WHEN ({sql.SPLIT_KEY}) % 1000 < 700 THEN 'train' ELSE 'test' END AS part,
    label, count(*) AS n FROM labelled GROUP BY ALL""",
)
def split_counts(spark, sf):
    split = prep.split_by_key(_labelled(spark, sf), _split_key(), values=1000)
    return split.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fold_counts",
    f"""WITH {sql.LABELLED} SELECT CAST(floor(({sql.SPLIT_KEY}) % 1000 * 3 / 1000) AS INT) AS fold,
    label, count(*) AS n FROM labelled GROUP BY ALL""",
)
def fold_counts(spark, sf):
    """The folds of a cross-validation, drawn from a key of the row."""
    folded = prep.fold_by_key(_labelled(spark, sf), _split_key(), values=1000)
    return folded.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stratified_finely",
    f"""WITH {sql.LABELLED}, {_BALANCE}
    SELECT num, no, DepDelay, label FROM labelled, ratios WHERE label IS NOT NULL
    AND CAST(({sql.SPLIT_KEY}) AS HUGEINT) * {sql.WIDE_FACTOR} % {prep.DRAWS} < least(1, ratio) / 100 * {prep.DRAWS}""",
)
def stratified_finely(spark, sf):
    """A hundredth of the class ratio, which a draw of a thousandth could not keep."""
    labelled = _labelled(spark, sf)
    share = prep.class_balance(labelled).first()["fraction"] / 100
    drawn = prep.draw_below(prep.spread_key(_split_key(), sql.WIDE_FACTOR), share, prep.DRAWS)
    return labelled.filter(F.col("label").isNotNull() & drawn).select("num", "no", "DepDelay", "label")


# --- learners ---


def _training_rows(spark: SparkSession, sf: str) -> DataFrame:
    inputs = [*prep.STRING_COLUMNS, *prep.NUMERIC_COLUMNS, "label", "num", "no"]
    return prep.stratified_by_key(write_table(_labelled(spark, sf).select(*inputs)), _split_key(), values=1000)


def _scores(name: str) -> Query:
    return lambda spark, sf: learn.train(name, _training_rows(spark, sf)).metrics


@query("nb_parameters", sql.bayes_sql())
def nb_parameters(spark, sf):
    rows = _labelled(spark, sf)
    model = learn.fit("Naive Bayes", rows)
    return learn.naive_bayes_parameters(model, rows).select(
        "label", "feature", F.round("log_theta", 6).alias("log_theta"), F.round("log_pi", 6).alias("log_pi")
    )


_FEATURES = ("IndexedFlightNum", "IndexedTailNum", *prep.NUMERIC_COLUMNS)


@query("nb_predictions", sql.bayes_predictions_sql())
def nb_predictions(spark, sf):
    """Every flight with the class that the fitted parameters give it, by plain columns."""
    rows = write_table(_labelled(spark, sf).select(*prep.STRING_COLUMNS, *prep.NUMERIC_COLUMNS, "label", "num", "no"))
    model = learn.fit("Naive Bayes", rows)
    parameters = learn.naive_bayes_parameters(model, rows)
    scored = learn.score_by_parameters(learn.indexed_rows(model, rows), parameters, _FEATURES)
    return scored.select("num", "no", "label", "prediction")


def _stump(spark: SparkSession, sf: str) -> tuple[learn.Fitted, DataFrame]:
    """A tree of one split, and the evened-out rows it was fitted on.

    The learner takes back a split whose sides predict the same class.
    """
    inputs = [*prep.STRING_COLUMNS, *prep.NUMERIC_COLUMNS, "label", "num", "no"]
    labelled = write_table(_labelled(spark, sf).select(*inputs))
    rows = write_table(prep.balanced_by_key(labelled, _split_key(), values=1000))
    return learn.fit("Decision Tree", rows, params={"maxDepth": 1}), rows


@query("dt_root_split", sql.root_split_sql())
def dt_root_split(spark, sf):
    """The first split of a decision tree, against a search of all splits of all features."""
    root = learn.tree_nodes(_stump(spark, sf)[0]).filter("node = 0")
    left = F.array_join(F.transform("left_categories", lambda c: c.cast("long").cast("string")), ",")
    return root.select("feature", "threshold", left.alias("left_categories"), F.round("gain", 9).alias("gain"))


@query("dt_stump_predictions", sql.stump_predictions_sql())
def dt_stump_predictions(spark, sf):
    """Every row of the sample with the prediction of the node table of that tree."""
    model, rows = _stump(spark, sf)
    scored = learn.score_by_nodes(learn.indexed_rows(model, rows), learn.tree_nodes(model), _FEATURES)
    return scored.select("num", "no", "label", "prediction")


@query("dt_stump_importances", sql.stump_importances_sql())
def dt_stump_importances(spark, sf):
    model, rows = _stump(spark, sf)
    return learn.importances(model, _FEATURES, rows)


query("nb_scores")(_scores("Naive Bayes"))
query("dt_scores")(_scores("Decision Tree"))
query("svc_scores")(_scores("Linear SVC"))
query("rf_scores")(_scores("Random Forest"))
query("gbt_scores")(_scores("Gradient-Boosted Tree"))


@query("cv_grid")
def cv_grid(spark, sf):
    """All points of the tree's tuned grid."""
    return learn.train("Decision Tree", _training_rows(spark, sf), tune=True).grid


@query("scored_rows")
def scored_rows(spark, sf):
    """The test rows with their keys, predictions and scores."""
    trained = learn.train(
        "Naive Bayes", _training_rows(spark, sf), keys=("num", "no"), draw=_second_key(), draw_values=1000
    )
    return trained.predictions


@query(
    "scored_row_keys",
    f"""WITH {sql.LABELLED}, {_BALANCE}
    SELECT num, no, label FROM labelled, ratios WHERE label IS NOT NULL
    AND ({sql.SPLIT_KEY}) % 1000 < least(1, ratio) * 1000 AND ({sql.SECOND_KEY.format(div="//")}) % 1000 >= 700""",
)
def scored_row_keys(spark, sf):
    """Which rows are scored, and their labels."""
    return scored_rows(spark, sf).select("num", "no", "label")


@query("feature_importance")
def feature_importance(spark, sf):
    return learn.train("Decision Tree", _training_rows(spark, sf)).importances


# --- evaluation ---


@query(
    "confusion_matrix",
    f"WITH {sql.SCORED} SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction",
)
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_tally(spark, sf))


@query(
    "confusion_table",
    f"""WITH {sql.SCORED} SELECT label, count(*) FILTER (prediction = 0) AS predicted_0,
    count(*) FILTER (prediction = 1) AS predicted_1 FROM scored GROUP BY label""",
)
def confusion_table(spark, sf):
    return evaluate.confusion_table(_tally(spark, sf))


def _metric(column: str) -> Query:
    return lambda spark, sf: evaluate.class_metrics(_tally(spark, sf)).select(
        F.round(column, 9).alias(column)
    )


for _name, _column in {
    "macro_precision": "precision",
    "macro_recall": "recall",
    "macro_fpr": "fpr",
    "macro_f1": "f1",
    "accuracy": "accuracy",
    "balanced_accuracy": "balanced_accuracy",
}.items():
    query(_name, f"WITH {sql.SCORED}, {sql.MACRO} SELECT round({_column}, 9) AS {_column} FROM macro")(
        _metric(_column)
    )


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.thresholds(_tally(spark, sf))


@query("auroc", f"WITH {sql.SCORED}, {sql.AREAS} SELECT round(auroc, 9) AS auroc FROM areas")
def auroc(spark, sf):
    return evaluate.areas(_points(spark, sf)).select(F.round("auroc", 9).alias("auroc"))


@query("auprc", f"WITH {sql.SCORED}, {sql.AREAS} SELECT round(auprc, 9) AS auprc FROM areas")
def auprc(spark, sf):
    return evaluate.areas(_points(spark, sf)).select(F.round("auprc", 9).alias("auprc"))


@query(
    "roc_curve",
    f"""WITH {sql.SCORED}, {sql.POINTS} SELECT threshold, round(fpr, 9) AS fpr, round(recall, 9) AS tpr FROM rates
    UNION ALL SELECT NULL, 0, 0 UNION ALL SELECT NULL, 1, 1""",
)
def roc_curve(spark, sf):
    curve = evaluate.roc_curve(_points(spark, sf))
    return curve.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query(
    "pr_curve",
    f"""WITH {sql.SCORED}, {sql.POINTS} SELECT threshold, round(recall, 9) AS recall, round(precision, 9) AS precision
    FROM rates UNION ALL SELECT NULL, 0, round(arg_max(precision, threshold), 9) FROM rates""",
)
def pr_curve(spark, sf):
    curve = evaluate.pr_curve(_points(spark, sf))
    return curve.select(
        "threshold", F.round("recall", 9).alias("recall"), F.round("precision", 9).alias("precision")
    )


@query(
    "threshold_metrics",
    f"""WITH {sql.SCORED}, {sql.POINTS} SELECT threshold, round(precision, 9) AS precision, round(recall, 9) AS recall,
     round(2 * precision * recall / (precision + recall), 9) AS f1,
     round(1.25 * precision * recall / (0.25 * precision + recall), 9) AS f05 FROM
     (SELECT * FROM rates WHERE recall > 0)
    UNION ALL SELECT threshold, round(precision, 9), 0, 0, 0 FROM rates WHERE recall = 0""",
)
def threshold_metrics(spark, sf):
    table = evaluate.threshold_metrics(_points(spark, sf))
    return table.select("threshold", *[F.round(c, 9).alias(c) for c in table.columns[1:]])


@query(
    "metrics_report",
    f"""WITH {sql.SCORED}, {sql.MACRO}, {sql.AREAS},
    named AS (
     SELECT 'Precision' AS "Name", precision AS score FROM macro
     UNION ALL SELECT 'Recall', recall FROM macro
     UNION ALL SELECT 'FPR', fpr FROM macro
     UNION ALL SELECT 'F1-Score', f1 FROM macro
     UNION ALL SELECT 'areaUnderPR', auprc FROM areas
     UNION ALL SELECT 'areaUnderROC', auroc FROM areas
     UNION ALL SELECT 'BalancedAccuracy', balanced_accuracy FROM macro
     UNION ALL SELECT 'Accuracy', accuracy FROM macro)
    SELECT "Name", printf('%.2f', score * 100) AS "Score%", round(score, 9) AS score FROM named""",
)
def metrics_report(spark, sf):
    report = evaluate.metrics_report(_tally(spark, sf))
    return report.withColumn("score", F.round("score", 9))
