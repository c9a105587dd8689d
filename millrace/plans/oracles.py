"""The jobs of the catalog as SQL over the same tables."""

from __future__ import annotations

from millrace.functions.regions import OFFICE_REGIONS, Region
from millrace.operators.counts import SEGMENTS
from millrace.plans import arrivals, catalog, exchange
from millrace.plans.graph import KINDS

CUSTOMER, ORDER, PART, SUPPLIER = range(len(KINDS))

# Text ---------------------------------------------------------------------------------------------


def _words(text: str) -> str:
    return (
        f"list_filter(list_transform(regexp_split_to_array({text}, '[ \\t\\n\\r\\f]+'), "
        "lambda w: regexp_replace(lower(w), '^[^a-z]+|[^a-z]+$', '', 'g')), lambda w: w <> '')"
    )


# A final line break opens no further line; every other line counts, blank ones too.
CUT = (
    "cut AS (SELECT doc_id, CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END AS l FROM "
    "(SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS l FROM documents))"
)
LINES = f"{CUT}, lines AS (SELECT doc_id, unnest(l) AS line FROM cut)"
LINE_TOKENS = f"{LINES}, tokens AS (SELECT doc_id, {_words('line')} AS tk FROM lines)"
LINE_WORDS = f"{LINE_TOKENS}, led AS (SELECT len(tk) AS n_raw, list_distinct(tk) AS ws FROM tokens)"
DOC_WORDS = f"occurrences AS (SELECT doc_id, unnest({_words('text')}) AS term FROM documents)"
POSTINGS = f"{DOC_WORDS}, postings AS (SELECT term, doc_id, count(*) AS tf FROM occurrences GROUP BY ALL)"
BIGRAMS = (
    f"{LINE_TOKENS}, two AS (SELECT unnest(list_zip(tk[1:len(tk)-1], tk[2:len(tk)])) AS p FROM tokens WHERE len(tk) > 1), "
    'bigrams AS (SELECT p[1] AS "left", p[2] AS "right", count(*) AS n FROM two GROUP BY ALL), '
    'totals AS (SELECT "left", sum(n)::BIGINT AS total, count(*) AS partners FROM bigrams GROUP BY ALL)'
)


def _segment(entry: str) -> str:
    return f"(('0x' || substr(md5({entry}), 1, 8))::BIGINT % {SEGMENTS})::INTEGER"


def _pmi(where: str) -> str:
    # A pair is on no more lines than its rarer word, so words on fewer lines than a pair needs are dropped first.
    return (
        f"WITH {LINE_WORDS}, uni AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM led {where}) GROUP BY w), "
        "numbered AS (SELECT row_number() OVER () AS no, ws FROM led), "
        "met AS (SELECT no, unnest(ws) AS w FROM numbered), "
        f"often AS (SELECT w FROM met GROUP BY w HAVING count(*) >= {catalog.PMI_THRESHOLD}), "
        "kept AS (SELECT no, list(w) AS ws FROM met JOIN often USING (w) GROUP BY no), "
        "firsts AS (SELECT unnest(ws) AS x, ws FROM kept), "
        "pairs AS (SELECT x, y, count(*) AS n FROM (SELECT x, unnest(ws) AS y FROM firsts) WHERE x <> y GROUP BY ALL "
        f"HAVING count(*) >= {catalog.PMI_THRESHOLD}) "
        "SELECT x, y, round(log10(p.n::DOUBLE * (SELECT count(*) FROM lines) / (a.n::DOUBLE * b.n)), 9) AS pmi, p.n AS n "
        "FROM pairs p JOIN uni a ON p.x = a.w JOIN uni b ON p.y = b.w"
    )


def text_oracles() -> dict[str, str]:
    pmi = _pmi("")
    return {
        "line_tokens": f"WITH {CUT}, "
        "lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line FROM cut) "
        f"SELECT doc_id, line_no::INTEGER AS line_no, len({_words('line')})::INTEGER AS n_tokens FROM lines",
        "word_count": f"WITH {DOC_WORDS} SELECT term AS word, count(*) AS n FROM occurrences GROUP BY term",
        "word_count_in_sql": f"WITH {DOC_WORDS} SELECT term AS word, count(*) AS n FROM occurrences GROUP BY term",
        "line_frequency": f"WITH {LINE_WORDS} SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM led) GROUP BY word",
        "successor_count": f"WITH {BIGRAMS} SELECT \"right\" AS successor, n FROM bigrams WHERE \"left\" = '{catalog.WORD}' AND n > 1",
        "bigram_counts": f"WITH {BIGRAMS} SELECT * FROM bigrams",
        "bigram_marginals": f"WITH {BIGRAMS} SELECT * FROM totals",
        "bigram_relfreq_pairs": f"WITH {BIGRAMS} SELECT b.\"left\", b.\"right\", n::DOUBLE / total AS value "
        'FROM bigrams b JOIN totals t ON b."left" = t."left" '
        "UNION ALL SELECT \"left\", '*', total::DOUBLE FROM totals",
        "bigram_relfreq_stripes": f"WITH {BIGRAMS} SELECT b.\"left\", {_segment('b.\"right\"')} AS segment, b.\"right\", n::DOUBLE / total AS value "
        'FROM bigrams b JOIN totals t ON b."left" = t."left"',
        "pmi_pairs": pmi,
        "pmi_pairs_multi": _pmi("WHERE n_raw > 1"),
        "pmi_stripes": f"SELECT x, {_segment('y')} AS segment, y, pmi, n FROM ({pmi})",
    }


# Retrieval ----------------------------------------------------------------------------------------


def _index(width: int) -> str:
    return (
        f"{POSTINGS}, freq AS (SELECT term, count(*) AS df FROM postings GROUP BY term), "
        "numbers AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS number FROM (SELECT DISTINCT doc_id FROM postings)), "
        f"placed AS (SELECT p.*, df, CASE WHEN df > {width} THEN number // {width} ELSE 0 END AS segment, "
        "doc_id - coalesce(lag(doc_id) OVER (PARTITION BY p.term ORDER BY doc_id), 0) AS gap "
        "FROM postings p JOIN freq f ON p.term = f.term JOIN numbers USING (doc_id))"
    )


def _lists(width: int, entry: str, name: str) -> str:
    return (
        f"WITH {_index(width)} SELECT term, segment, df, string_agg({entry} || ':' || tf, ' ' ORDER BY doc_id) AS {name} "
        "FROM placed GROUP BY term, segment, df"
    )


def _postfix(query: str) -> str:
    """The condition a query puts on the list ``ts`` of a document's words."""
    stack: list[str] = []
    for token in query.split():
        if token in ("AND", "OR"):
            right, left = stack.pop(), stack.pop()
            stack.append(f"({left} {token} {right})")
        else:
            stack.append(f"list_contains(ts, '{token}')")
    return stack.pop()


SNIPPET = "CASE WHEN length(text) > 80 THEN substring(text, 1, 80) || '...' ELSE text END AS line"


def retrieval_oracles() -> dict[str, str]:
    docs = f"WITH docs AS (SELECT doc_id, text, {_words('text')} AS ts FROM documents) "
    either = " UNION ALL ".join(
        f"SELECT {qid} AS qid, doc_id, {SNIPPET} FROM docs WHERE {_postfix(query)}" for qid, query in enumerate(catalog.QUERIES)
    )
    return {
        "term_frequency": f"WITH {POSTINGS} SELECT term, doc_id, tf::INTEGER AS tf FROM postings",
        "document_frequency": f"WITH {POSTINGS} SELECT term, count(*) AS df FROM postings GROUP BY term",
        "inverted_index": _lists(65536, "doc_id", "postings"),
        "inverted_index_segments": _lists(64, "doc_id", "postings"),
        "gap_encode": _lists(64, "gap", "gaps"),
        "gap_decode": f"WITH {POSTINGS} SELECT term, doc_id, tf::INTEGER AS tf FROM postings",
        "matching_all": f"WITH {POSTINGS} SELECT doc_id FROM postings WHERE term = '{catalog.ALL_OF[0]}' "
        f"INTERSECT SELECT doc_id FROM postings WHERE term = '{catalog.ALL_OF[1]}'",
        "matching_any": f"WITH {POSTINGS} SELECT DISTINCT doc_id FROM postings WHERE term IN {catalog.ANY_OF}",
        "indexed_retrieval": docs + either,
        "boolean_retrieval": docs + either,
        "snippets": f"SELECT doc_id, {SNIPPET} FROM documents",
    }


def _significant(value: str, digits: int = catalog.DIGITS) -> str:
    """Rounded to significant digits."""
    scale = f"pow(10.0::DOUBLE, {digits - 1} - floor(log10(abs({value}))))"
    return f"CASE WHEN {value} = 0 THEN {value} ELSE round({value} * {scale}) / {scale} END"


# Graph --------------------------------------------------------------------------------------------


def _node(kind: int, key: str) -> str:
    return f"{key} * {len(KINDS)} + {kind}"


GRAPH = (
    "edges AS ("
    f"SELECT {_node(CUSTOMER, 'o_custkey')} AS src, {_node(ORDER, 'o_orderkey')} AS dst FROM orders "
    f"UNION ALL SELECT {_node(ORDER, 'l_orderkey')}, {_node(PART, 'l_partkey')} FROM lineitem "
    f"UNION ALL SELECT {_node(ORDER, 'l_orderkey')}, {_node(SUPPLIER, 'l_suppkey')} FROM lineitem "
    f"UNION ALL SELECT {_node(PART, 'l_partkey')}, {_node(CUSTOMER, 'o_custkey')} "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'), "
    "ids AS ("
    f"SELECT {_node(CUSTOMER, 'c_custkey')} AS id FROM customer UNION ALL SELECT {_node(ORDER, 'o_orderkey')} FROM orders "
    f"UNION ALL SELECT {_node(PART, 'p_partkey')} FROM part UNION ALL SELECT {_node(SUPPLIER, 's_suppkey')} FROM supplier), "
    "nodes AS (SELECT id, coalesce(deg, 0) AS deg FROM ids LEFT JOIN (SELECT src, count(*) AS deg FROM edges GROUP BY src) ON id = src)"
)


def _sources(sources: list[int]) -> str:
    return f"id IN ({', '.join(map(str, sources))})"


def _ranks(sources: list[int], steps: int) -> str:
    """CTEs r0 to r<steps>."""
    k = len(sources)
    ctes = [f"WITH {GRAPH}, r0 AS (SELECT id, deg, CASE WHEN {_sources(sources)} THEN 1.0::DOUBLE / {k} ELSE 0 END AS rank FROM nodes)"]
    for i in range(steps):
        ctes.append(
            f"m{i} AS (SELECT dst, sum(rank / deg) AS mass FROM edges JOIN r{i} ON src = id GROUP BY dst), "
            f"d{i} AS (SELECT coalesce(sum(rank), 0) AS lost FROM r{i} WHERE deg = 0), "
            f"r{i + 1} AS (SELECT id, deg, CASE WHEN {_sources(sources)} "
            f"THEN 0.15::DOUBLE / {k} + 0.85::DOUBLE * (coalesce(mass, 0) + lost / {k}) "
            f"ELSE 0.85::DOUBLE * coalesce(mass, 0) END AS rank FROM nodes LEFT JOIN m{i} ON id = dst, d{i})"
        )
    return ", ".join(ctes)


def _step_statistics(sources: list[int], steps: int) -> str:
    """Per step, with the suppliers left out of the nodes: what nodes with rank send, and how much of it to no node."""
    k = len(sources)
    ctes = _ranks(sources, steps).replace("nodes AS (SELECT", f"nodes AS (SELECT * FROM (SELECT", 1)
    ctes = ctes.replace("ON id = src)", f"ON id = src) WHERE id % {len(KINDS)} <> {SUPPLIER})", 1)
    rows = " UNION ALL ".join(
        f"SELECT {i + 1} AS step, count(*) AS nodes, count(*) FILTER (rank > 0) AS ranked, "
        f"coalesce(sum(CASE WHEN deg > 0 THEN deg ELSE {k} END) FILTER (rank > 0), 0)::BIGINT AS messages, "
        f"round((SELECT coalesce(sum(mass), 0) FROM m{i} WHERE dst NOT IN (SELECT id FROM nodes)), {catalog.LOG_DIGITS}) AS lost_mass FROM r{i}"
        for i in range(steps)
    )
    return f"{ctes} {rows}"


def graph_oracles() -> dict[str, str]:
    sources, steps = catalog.SOURCES, catalog.STEPS
    k = len(sources)
    many = _ranks(sources, steps)
    top = f"SELECT id, {_significant('r.rank')} AS rank FROM r{steps} r ORDER BY rank DESC, id LIMIT"
    return {
        "graph_build": f"WITH {GRAPH} SELECT id, deg AS degree, "
        f"{_significant(f'(CASE WHEN {_sources(sources)} THEN 1.0::DOUBLE / {k} ELSE 0 END)')} AS rank FROM nodes",
        "graph_statistics": f"WITH {GRAPH} SELECT count(*) AS nodes, sum(deg)::BIGINT AS edges, "
        "count(*) FILTER (deg > 0) AS active_nodes FROM nodes",
        "message_statistics": f"WITH {GRAPH} SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges, "
        f"(SELECT count(*) FROM edges) + {k} * (SELECT count(*) FROM nodes WHERE deg = 0) AS messages, "
        "(SELECT count(DISTINCT dst) FROM edges WHERE dst NOT IN (SELECT id FROM nodes)) AS missing",
        "missing_targets": f"WITH {GRAPH} SELECT dst, count(*) AS messages FROM edges "
        f"WHERE dst NOT IN (SELECT id FROM nodes WHERE id % {len(KINDS)} <> {SUPPLIER}) GROUP BY dst",
        "step_statistics": _step_statistics(sources, steps),
        "personalized_pagerank": f"{many} SELECT id, {_significant('rank')} AS rank FROM r{steps}",
        "single_source_pagerank": f"{_ranks(sources[:1], steps)} "
        f"SELECT id, CASE WHEN rank > 0 THEN round(ln(rank), {catalog.LOG_DIGITS}) END AS log_rank FROM r{steps}",
        "top_ranked_nodes": f"{many} {top} 100",
        "printed_ranks": f"{many} SELECT printf('%.5f', rank) AS rank, id FROM ({top} 20)",
        "log_mass": f"{_ranks(sources, 1)}, arrived AS (SELECT dst, sum(rank / deg) AS mass FROM edges JOIN r1 ON src = id GROUP BY dst) "
        f"SELECT dst AS id, CASE WHEN mass > 0 THEN round(ln(mass), {catalog.LOG_DIGITS}) END AS log_mass FROM arrived",
    }


# Classification -----------------------------------------------------------------------------------


def _training(model: str, epochs: int) -> str:
    """CTEs of the instances and of the weights w1 to w<epochs>."""
    ctes = [
        "WITH instances AS (SELECT doc_id, CASE WHEN quality = 0 THEN 'spam' ELSE 'ham' END AS label, "
        f"{model} AS model_id, {_words('text')} AS fs FROM documents JOIN labels USING (doc_id)), "
        "occ AS (SELECT doc_id, label, model_id, unnest(fs) AS feature FROM instances), "
        "counts AS (SELECT doc_id, CASE WHEN label = 'spam' THEN 1.0::DOUBLE ELSE 0 END AS y, model_id, feature, count(*) AS n "
        "FROM occ GROUP BY ALL), "
        "sizes AS (SELECT model_id, count(*) AS size FROM instances GROUP BY model_id), "
        "w0 AS (SELECT DISTINCT model_id, feature, 0.0::DOUBLE AS weight FROM counts)"
    ]
    for i in range(epochs):
        ctes.append(
            f"s{i} AS (SELECT doc_id, y - 1 / (1 + exp(-sum(n * weight))) AS residual "
            f"FROM counts JOIN w{i} USING (model_id, feature) GROUP BY doc_id, y), "
            f"g{i} AS (SELECT model_id, feature, sum(residual * n) AS g FROM counts JOIN s{i} USING (doc_id) GROUP BY ALL), "
            f"w{i + 1} AS (SELECT model_id, feature, weight + 0.002::DOUBLE / size * g AS weight "
            f"FROM w{i} JOIN g{i} USING (model_id, feature) JOIN sizes USING (model_id))"
        )
    return ", ".join(ctes)


def classification_oracles() -> dict[str, str]:
    epochs = catalog.EPOCHS
    one, several = _training("'all'", epochs), _training("lang", epochs)
    weights = f"SELECT model_id, feature, {_significant('weight')} AS weight FROM w{epochs}"
    everyone = (
        "everyone AS (SELECT doc_id, CASE WHEN quality = 0 THEN 'spam' WHEN quality IS NOT NULL THEN 'ham' END AS label, "
        f"{_words('text')} AS fs FROM documents LEFT JOIN labels USING (doc_id)), "
        "met AS (SELECT doc_id, unnest(fs) AS feature FROM everyone)"
    )
    # Occurrences by feature first: each document meets every model.
    scores = (
        f"{several}, {everyone}, models AS (SELECT DISTINCT model_id FROM w{epochs}), "
        "per AS (SELECT i.doc_id, i.label, m.model_id, coalesce(s, 0) AS s FROM everyone i CROSS JOIN models m LEFT JOIN "
        f"(SELECT doc_id, w.model_id, sum(weight) AS s FROM met JOIN w{epochs} w USING (feature) GROUP BY ALL) x "
        "ON x.doc_id = i.doc_id AND x.model_id = m.model_id), "
    )
    labelled = f"SELECT doc_id, label, {_significant('score', catalog.SCORE_DIGITS)} AS score, CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS predicted FROM t"
    return {
        "train_classifier": f"{one} {weights}",
        "train_models": f"{several} {weights}",
        "apply_classifier": f"{one}, {everyone}, t AS (SELECT i.doc_id, i.label, coalesce(s, 0) AS score FROM everyone i LEFT JOIN "
        f"(SELECT doc_id, sum(weight) AS s FROM met JOIN w{epochs} USING (feature) GROUP BY doc_id) x ON x.doc_id = i.doc_id) {labelled}",
        "apply_ensemble_average": f"{scores} t AS (SELECT doc_id, label, avg(s) AS score FROM per GROUP BY ALL) {labelled}",
        "apply_ensemble_vote": f"{scores} t AS (SELECT doc_id, label, "
        f"sum(CASE WHEN s > 0 THEN 1 ELSE -1 END)::DOUBLE AS score FROM per GROUP BY ALL) {labelled}",
    }


# Streams ------------------------------------------------------------------------------------------


def _inside(region: Region) -> str:
    return f"x > {region.min_x} AND x < {region.max_x} AND y > {region.min_y} AND y < {region.max_y}"


def _regional() -> str:
    cases = " ".join(f"WHEN {_inside(r)} THEN '{r.name}'" for r in arrivals.EVENT_REGIONS)
    return (
        "points AS (SELECT ts, CASE event_type WHEN 'click' THEN value "
        "WHEN 'view' THEN regexp_extract(props, '\"k\": *([-0-9.]+)', 1)::DOUBLE END AS x, "
        "CASE event_type WHEN 'click' THEN user_id::DOUBLE WHEN 'view' THEN value END AS y FROM events), "
        f"regional AS (SELECT * FROM (SELECT ts, CASE {cases} END AS key FROM points) WHERE key IS NOT NULL)"
    )


def _windowed(source: str, minutes: int, key: str = "key") -> str:
    return (
        f"counts AS (SELECT time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL {minutes} MINUTE AS window_end, "
        f"{key} AS key, count(*) AS n FROM {source} GROUP BY ALL)"
    )


def arrival_oracles() -> dict[str, str]:
    minutes = 60
    counted = f"WITH {_regional()}, {_windowed('regional', minutes)}"
    trends = (
        f"{counted}, merged AS (SELECT window_end, key, n AS cur, 0 AS prev FROM counts UNION ALL "
        f"SELECT window_end + INTERVAL {minutes} MINUTE, key, 0, n FROM counts), "
        "trends AS (SELECT key, sum(cur)::BIGINT AS cur, epoch_ms(window_end) AS ts, sum(prev)::BIGINT AS prev FROM merged "
        "WHERE window_end <= (SELECT max(window_end) FROM counts) GROUP BY window_end, key)"
    )
    titles = " ".join(f"WHEN '{r.name}' THEN '{r.title}'" for r in arrivals.EVENT_REGIONS)
    per_job = {
        "event_count_hourly": f"WITH {_windowed('events', 60, chr(39) + 'all' + chr(39))} SELECT * FROM counts",
        "region_count_hourly": f"{counted} SELECT * FROM counts",
        "trending_arrivals": f"{trends} SELECT * FROM trends",
        "trending_alerts": f"{trends} SELECT *, 'Number of arrivals to ' || CASE key {titles} END || ' has doubled from ' || prev "
        f"|| ' to ' || cur || ' at ' || ts || '!' AS message FROM trends "
        f"WHERE cur >= {catalog.TREND_MIN} AND cur >= {catalog.TREND_FACTOR} * prev",
    }
    # Streams with a watermark of two hours leave out the windows that end later.
    closed, closed_in_region = (f"<= (SELECT max(ts) - INTERVAL 2 HOUR FROM {source})" for source in ("events", "regional"))
    kept = (
        f"{counted}, firsts AS (SELECT key, min(window_end) AS f FROM counts GROUP BY key), "
        "grid AS (SELECT key, unnest(generate_series(f, (SELECT max(window_end) FROM counts), INTERVAL 60 MINUTE)) AS window_end FROM firsts), "
        "filled AS (SELECT window_end, key, coalesce(n, 0) AS cur FROM grid LEFT JOIN counts USING (window_end, key)) "
        "SELECT key, cur, epoch_ms(window_end) AS ts, coalesce(lag(cur) OVER (PARTITION BY key ORDER BY window_end), 0) AS prev "
        f"FROM filled WHERE window_end {closed_in_region}"
    )
    over = "to_timestamp(ts / 1000)::TIMESTAMP"
    # Trends that were not cut at the last arrival: the watermark cuts them before it.
    both = (
        f"WITH {_regional()}, every AS ({per_job['trending_arrivals']}), raised AS ({per_job['trending_alerts']}) "
        f"SELECT 'trend' AS kind, key, cur, ts, prev, NULL::VARCHAR AS message FROM every WHERE {over} {closed_in_region} "
        f"UNION ALL SELECT 'alert', key, cur, ts, prev, message FROM raised WHERE {over} {closed_in_region}"
    )
    return {
        **per_job,
        **{f"{name}_batch": sql for name, sql in per_job.items()},
        "trending_arrivals_kept": kept,
        "trends_and_alerts_stream": both,
        "event_count_hourly_closed": f"WITH {_windowed('events', 60, chr(39) + 'all' + chr(39))} SELECT * FROM counts WHERE window_end {closed}",
        "event_count_hourly_batches": per_job["event_count_hourly"],
        "event_count_ten_minutes_batches": f"WITH {_windowed('events', 10, chr(39) + 'all' + chr(39))} SELECT * FROM counts",
        "region_count_ten_minutes_stream": f"WITH {_regional()}, {_windowed('regional', 10)} SELECT * FROM counts",
        "region_count_ten_minutes": f"WITH {_regional()}, {_windowed('regional', 10)} SELECT * FROM counts",
        "region_count_dense": f"{counted}, firsts AS (SELECT key, min(window_end) AS f FROM counts GROUP BY key), "
        "grid AS (SELECT key, unnest(generate_series(f, (SELECT max(window_end) FROM counts), INTERVAL 60 MINUTE)) AS window_end FROM firsts) "
        "SELECT g.window_end, g.key, coalesce(n, 0) AS n FROM grid g LEFT JOIN counts c ON c.key = g.key AND c.window_end = g.window_end",
    }


# Reports ------------------------------------------------------------------------------------------


def report_oracles() -> dict[str, str]:
    month = f"strftime(l_shipdate, '%Y-%m-%d') LIKE '%{catalog.MONTH}%'"
    revenue = "l_extendedprice * (1 - l_discount)"
    per_job = {
        "q1_shipped_count": f"SELECT count(*) AS answer FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') LIKE '%{catalog.DAY}%'",
        "q2_orders_of_date": "SELECT o_orderpriority AS clerk, o_orderkey AS orderkey FROM orders WHERE o_orderkey IN "
        f"(SELECT l_orderkey FROM lineitem WHERE {month}) ORDER BY o_orderkey LIMIT 20",
        "q2_orders_of_date_fanout": "SELECT o_orderpriority AS clerk, o_orderkey AS orderkey FROM orders JOIN lineitem "
        f"ON o_orderkey = l_orderkey WHERE {month} ORDER BY o_orderkey LIMIT 20",
        "q3_part_supplier": "SELECT l_orderkey AS orderkey, p_name, s_name FROM lineitem JOIN part ON l_partkey = p_partkey "
        f"JOIN supplier ON l_suppkey = s_suppkey WHERE {month} ORDER BY 1, 2, 3 LIMIT 20",
        "q4_shipped_by_nation": "SELECT n_nationkey, n_name, count(*) AS items FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        f"JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE {month} GROUP BY ALL",
        "q5_monthly_by_nation": "SELECT n_nationkey, n_name, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS items "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey IN (3, 24) GROUP BY ALL",
        "q6_pricing_summary": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 6) AS sum_qty, "
        f"round(sum(l_extendedprice), 6) AS sum_base_price, round(sum({revenue}), 6) AS sum_disc_price, "
        f"round(sum({revenue} * (1 + l_tax)), 6) AS sum_charge, round(avg(l_quantity), 6) AS avg_qty, "
        "round(avg(l_extendedprice), 6) AS avg_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order "
        f"FROM lineitem WHERE {month} GROUP BY l_returnflag, l_linestatus",
        "q7_top_unshipped": f"SELECT c_name, o_orderkey AS orderkey, round(sum({revenue}), 6) AS revenue, "
        "strftime(o_orderdate, '%Y-%m-%d') AS orderdate, o_orderpriority AS priority FROM lineitem "
        "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
        f"WHERE strftime(l_shipdate, '%Y-%m-%d') > '{catalog.DAY}' AND strftime(o_orderdate, '%Y-%m-%d') < '{catalog.DAY}' "
        "GROUP BY ALL ORDER BY revenue DESC, orderkey LIMIT 5",
    }
    return {
        **per_job,
        **{f"{name}_text": sql for name, sql in per_job.items()},
        "date_piece_count": "SELECT count(*) AS answer FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') LIKE '%-11-0%'",
        "year_count": "SELECT count(*) AS answer FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') LIKE '%1996%'",
    }


# Text records and files ---------------------------------------------------------------------------


def exchange_oracles() -> dict[str, str]:
    x = f"(({exchange.WEST} + event_id % 1000 * {exchange.STEP_X}) / {exchange.SCALE}::DOUBLE)"
    y = f"(({exchange.SOUTH} + event_id * {exchange.SPREAD} % 1000 * {exchange.STEP_Y}) / {exchange.SCALE}::DOUBLE)"
    cases = " ".join(
        f"WHEN x > {r.min_x} AND x < {r.max_x} AND y > {r.min_y} AND y < {r.max_y} THEN '{r.name}'" for r in OFFICE_REGIONS
    )
    graph, models = graph_oracles(), classification_oracles()
    blocks = f"FROM lineitem GROUP BY l_orderkey, l_linenumber // {exchange.BLOCK_LINES}"
    return {
        "trips_per_region": f"WITH points AS (SELECT {x} AS x, {y} AS y FROM events WHERE event_type IN ('click', 'view')) "
        f"SELECT key, count(*) AS n FROM (SELECT CASE {cases} END AS key FROM points) WHERE key IS NOT NULL GROUP BY key",
        "trips_by_minute": f"WITH points AS (SELECT {x} AS x, {y} AS y, 60 * hour(ts) + minute(ts) AS m FROM events "
        "WHERE event_type IN ('click', 'view')), "
        f"placed AS (SELECT m, CASE {cases} END AS key FROM points) "
        f"SELECT TIMESTAMP '{exchange.DAY}' + to_minutes((m // 10 + 1) * 10) AS window_end, key, count(*) AS n "
        "FROM placed WHERE key IS NOT NULL GROUP BY ALL",
        "duplicate_orders": f"SELECT l_orderkey AS id, count(DISTINCT l_linenumber // {exchange.BLOCK_LINES}) AS definitions "
        "FROM lineitem GROUP BY l_orderkey HAVING definitions > 1",
        "text_ensemble_vote": models["apply_ensemble_vote"],
        "order_instances": "SELECT l_orderkey::VARCHAR AS doc_id, CASE WHEN l_orderkey % 3 = 0 THEN 'spam' ELSE 'ham' END AS label, "
        f"count(*)::INTEGER AS n_features, sum(l_partkey)::BIGINT AS feature_sum {blocks}",
        "order_adjacency": "SELECT l_orderkey AS src, count(*) AS edges, sum(l_partkey)::BIGINT AS targets FROM lineitem GROUP BY l_orderkey",
        "text_model": f"SELECT feature, weight FROM ({models['train_classifier']})",
        "model_table": models["train_models"],
        "sorted_text": text_oracles()["word_count"],
        "resumed_pagerank": graph["personalized_pagerank"],
    }


def all_oracles() -> dict[str, str]:
    return {
        **report_oracles(),
        **text_oracles(),
        **retrieval_oracles(),
        **graph_oracles(),
        **classification_oracles(),
        **arrival_oracles(),
        **exchange_oracles(),
    }
