"""Every job by name, with the parameters it is checked and timed with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scores import significant
from millrace.operators import boolean, index, ranking
from millrace.plans import arrivals, classify, exchange, graph, relational, retrieval, text
from millrace.session import fresh_path
from millrace.sinks.files import write_tbl
from millrace.sources.tables import read_table
from millrace.streaming import windows

Job = Callable[[SparkSession, str], DataFrame]

DAY, MONTH = "1996-11-01", "1996-11"
WORD = "the"
PMI_THRESHOLD = 10
SOURCES = graph.customers(range(1, 8))
STEPS = 4
# Sums of doubles depend on the order of addition in their last bits. They are compared in significant
# digits, so that small values count as much as large ones: scores, whose terms cancel, in fewer.
DIGITS = 8
SCORE_DIGITS = 7
LOG_DIGITS = 9
EPOCHS = 2
TREND_LENGTH = "60 minutes"
TREND_MIN = 3
TREND_FACTOR = 2
MINUTES_PER_BATCH = 360
QUERIES = (
    "the",
    "from this AND",
    "been beau OR",
    "from this OR des que OR AND",
    "la de AND beau OR the AND",
    "The",
    "nowhere-to-be-found been OR",
)
ALL_OF, ANY_OF = ("from", "this"), ("been", "beau")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round amounts and logarithms to decimals."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def shortened(df: DataFrame, column: str, digits: int = DIGITS) -> DataFrame:
    """Round ranks, weights and scores to significant digits."""
    return df.withColumn(column, significant(F.col(column), digits))


# Reports ------------------------------------------------------------------------------------------

_tbl_copies: dict[tuple[str, str], str] = {}
_tbl_tables: set[tuple[str, str]] = set()


def tbl_copy(spark: SparkSession, directory: str, *tables: str) -> str:
    """A directory with tables as delimited text, each written once per session.

    The tables come as Parquet only, so this stands for text that is there already; it is no part of a report.
    """
    key = (spark.sparkContext.applicationId, directory)
    target = _tbl_copies.setdefault(key, fresh_path(spark, "tbl"))
    for name in tables:
        if (target, name) not in _tbl_tables:
            write_tbl(read_table(spark, directory, name), target, name)
            _tbl_tables.add((target, name))
    return target


def _money(df: DataFrame) -> DataFrame:
    """Products of prices and rates have at most six exact decimals."""
    return rounded(df, 6, *[c for c in df.columns if c.startswith(("sum_", "avg_")) or c == "revenue"])


def _reports(fmt: str) -> dict[str, tuple[Job, tuple[str, ...]]]:
    """The reports over a directory of tables in a format, and the tables each reads."""
    # Only the tables with a clerk and a shipping priority would show them; both formats show the same here.
    shown = "o_orderpriority"
    items, orders, by_nation = ("lineitem",), ("lineitem", "orders"), ("lineitem", "orders", "customer", "nation")
    return {
        "q1_shipped_count": (lambda s, d: relational.q1_shipped_count(s, d, DAY, fmt=fmt), items),
        "q2_orders_of_date": (lambda s, d: relational.q2_orders_of_date(s, d, MONTH, clerk=shown, fmt=fmt), orders),
        "q2_orders_of_date_fanout": (
            lambda s, d: relational.q2_orders_of_date(s, d, MONTH, fanout=True, clerk=shown, fmt=fmt), orders
        ),
        "q3_part_supplier": (lambda s, d: relational.q3_part_supplier(s, d, MONTH, fmt=fmt), ("lineitem", "part", "supplier")),
        "q4_shipped_by_nation": (lambda s, d: relational.q4_shipped_by_nation(s, d, MONTH, fmt=fmt), by_nation),
        "q5_monthly_by_nation": (lambda s, d: relational.q5_monthly_by_nation(s, d, fmt=fmt), by_nation),
        "q6_pricing_summary": (lambda s, d: _money(relational.q6_pricing_summary(s, d, MONTH, fmt=fmt)), items),
        "q7_top_unshipped": (
            lambda s, d: _money(relational.q7_top_unshipped(s, d, DAY, priority=shown, fmt=fmt)), ("lineitem", "orders", "customer")
        ),
    }


def _from_text(job: Job, tables: tuple[str, ...]) -> Job:
    return lambda s, d: job(s, tbl_copy(s, d, *tables))


def report_jobs() -> dict[str, Job]:
    return {
        **{name: job for name, (job, _) in _reports("parquet").items()},
        **{f"{name}_text": _from_text(job, tables) for name, (job, tables) in _reports("tbl").items()},
        # A piece of a date that is no whole year, month or day.
        "date_piece_count": lambda s, d: relational.q1_shipped_count(s, d, "-11-0"),
        "year_count": lambda s, d: relational.q1_shipped_count(s, d, "1996"),
    }


# Text ---------------------------------------------------------------------------------------------


def _flat_stripes(df: DataFrame, key: str, entry: str) -> DataFrame:
    return df.select(key, "segment", F.explode("stripe").alias(entry, "_value"))


def _flat_relfreq(s: SparkSession, d: str) -> DataFrame:
    flat = _flat_stripes(text.bigram_relfreq_stripes(s, d), "left", "right")
    return flat.select("left", "segment", "right", F.col("_value").alias("value"))


def _flat_pmi(s: SparkSession, d: str) -> DataFrame:
    flat = _flat_stripes(text.pmi_stripes(s, d, PMI_THRESHOLD), "x", "y")
    return rounded(flat.select("x", "segment", "y", "_value.*"), 9, "pmi")


def text_jobs() -> dict[str, Job]:
    return {
        "line_tokens": text.line_tokens,
        "word_count": text.word_count,
        "word_count_in_sql": text.word_count_in_sql,
        "line_frequency": text.line_frequency,
        "successor_count": lambda s, d: text.successor_count(s, d, WORD),
        "bigram_counts": text.bigram_counts,
        "bigram_marginals": text.bigram_marginals,
        "bigram_relfreq_pairs": text.bigram_relfreq_pairs,
        "bigram_relfreq_stripes": _flat_relfreq,
        "pmi_pairs": lambda s, d: rounded(text.pmi_pairs(s, d, PMI_THRESHOLD), 9, "pmi"),
        "pmi_pairs_multi": lambda s, d: rounded(text.pmi_pairs(s, d, PMI_THRESHOLD, marginals="multi"), 9, "pmi"),
        "pmi_stripes": _flat_pmi,
    }


# Retrieval ----------------------------------------------------------------------------------------


def _joined(entries: str, first: str) -> Column:
    """A list as text ``first:tf first:tf ...`` in its own order."""
    return F.array_join(F.transform(entries, lambda p: F.concat_ws(":", p[first].cast("string"), p["tf"].cast("string"))), " ")


def retrieval_jobs() -> dict[str, Job]:
    return {
        "term_frequency": retrieval.term_frequency,
        "document_frequency": retrieval.document_frequency,
        "inverted_index": lambda s, d: retrieval.inverted_index(s, d).withColumn("postings", _joined("postings", "doc_id")),
        # Short segments, so that frequent terms are cut into many.
        "inverted_index_segments": lambda s, d: retrieval.inverted_index(s, d, max_postings=64).withColumn(
            "postings", _joined("postings", "doc_id")
        ),
        "gap_encode": lambda s, d: retrieval.inverted_index(s, d, max_postings=64, gaps=True).withColumn(
            "gaps", _joined("gaps", "gap")
        ),
        "gap_decode": lambda s, d: index.gap_decode(retrieval.inverted_index(s, d, max_postings=64, gaps=True)),
        "matching_all": lambda s, d: retrieval.matching_all(s, d, *ALL_OF),
        "matching_any": lambda s, d: retrieval.matching_any(s, d, *ANY_OF),
        "indexed_retrieval": lambda s, d: retrieval.indexed_retrieval(s, d, QUERIES),
        "boolean_retrieval": lambda s, d: retrieval.boolean_retrieval(s, d, QUERIES),
        "snippets": lambda s, d: text.documents(s, d).select("doc_id", boolean.snippet(F.col("text")).alias("line")),
    }


# Graph --------------------------------------------------------------------------------------------


def _ranks(s: SparkSession, d: str) -> DataFrame:
    return graph.personalized_ranks(s, d, SOURCES, STEPS)


def graph_jobs() -> dict[str, Job]:
    return {
        "graph_build": lambda s, d: shortened(graph.graph_build(s, d, SOURCES), "rank"),
        "graph_statistics": graph.graph_statistics,
        "message_statistics": lambda s, d: graph.message_statistics(s, d, SOURCES),
        "missing_targets": graph.missing_targets,
        "step_statistics": lambda s, d: rounded(graph.step_statistics(s, d, SOURCES, STEPS), LOG_DIGITS, "lost_mass"),
        "personalized_pagerank": lambda s, d: shortened(_ranks(s, d), "rank"),
        "single_source_pagerank": lambda s, d: rounded(
            ranking.log_ranks(graph.personalized_ranks(s, d, SOURCES[:1], STEPS)), LOG_DIGITS, "log_rank"
        ),
        "top_ranked_nodes": lambda s, d: ranking.top_nodes(_ranks(s, d), 100, DIGITS),
        "printed_ranks": lambda s, d: ranking.format_ranks(ranking.top_nodes(_ranks(s, d), 20, DIGITS)),
        # Minus infinity, where nothing arrives, as null: SQL has no logarithm of zero.
        "log_mass": lambda s, d: rounded(graph.log_mass(s, d, SOURCES, 1), LOG_DIGITS, "log_mass").withColumn(
            "log_mass", F.when(F.col("log_mass") > float("-inf"), F.col("log_mass"))
        ),
    }


# Classification -----------------------------------------------------------------------------------


def _models(s: SparkSession, d: str) -> DataFrame:
    return classify.train_classifier(s, d, per_language=True, epochs=EPOCHS)


def _ensemble(method: str) -> Job:
    return lambda s, d: shortened(classify.apply_ensemble(s, d, _models(s, d), method), "score", SCORE_DIGITS)


def classification_jobs() -> dict[str, Job]:
    return {
        "train_classifier": lambda s, d: shortened(classify.train_classifier(s, d, epochs=EPOCHS), "weight"),
        "train_models": lambda s, d: shortened(_models(s, d), "weight"),
        "apply_classifier": lambda s, d: shortened(
            classify.apply_classifier(s, d, classify.train_classifier(s, d, epochs=EPOCHS)), "score", SCORE_DIGITS
        ),
        "apply_ensemble_average": _ensemble("average"),
        "apply_ensemble_vote": _ensemble("vote"),
    }


# Streams ------------------------------------------------------------------------------------------


def _arrival_jobs(suffix: str, streaming: bool) -> dict[str, Job]:
    def trends(s: SparkSession, d: str) -> DataFrame:
        return arrivals.trends(s, d, TREND_LENGTH, streaming)

    jobs: dict[str, Job] = {
        "event_count_hourly": lambda s, d: arrivals.event_count(s, d, streaming=streaming),
        "region_count_hourly": lambda s, d: arrivals.region_count(s, d, streaming=streaming),
        "trending_arrivals": lambda s, d: windows.trend_rows(trends(s, d)),
        "trending_alerts": lambda s, d: windows.alerts(
            trends(s, d), TREND_MIN, TREND_FACTOR, arrivals.EVENT_REGIONS
        ),
    }
    out = {}
    for name, job in jobs.items():
        out[name + suffix] = lambda s, d, job=job: _plain_end(job(s, d))
    return out


def _plain_end(df: DataFrame) -> DataFrame:
    """Window ends as timestamps without zone, like the events' own."""
    return df.withColumn("window_end", windows.without_zone(F.col("window_end"))) if "window_end" in df.columns else df


def arrival_jobs() -> dict[str, Job]:
    return {
        **_arrival_jobs("", streaming=True),
        **_arrival_jobs("_batch", streaming=False),
        "event_count_hourly_batches": lambda s, d: _plain_end(arrivals.event_count_in_batches(s, d)),
        "event_count_ten_minutes_batches": lambda s, d: _plain_end(arrivals.event_count_in_batches(s, d, "10 minutes")),
        "trending_arrivals_kept": lambda s, d: windows.trend_rows(arrivals.kept_trends(s, d, TREND_LENGTH)),
        "trends_and_alerts_stream": lambda s, d: arrivals.trends_and_alerts(s, d, TREND_MIN, TREND_FACTOR, TREND_LENGTH),
        "event_count_hourly_closed": lambda s, d: _plain_end(arrivals.closed_windows(s, d)),
        "region_count_ten_minutes_stream": lambda s, d: _plain_end(arrivals.region_count(s, d, "10 minutes", streaming=True)),
        "region_count_ten_minutes": lambda s, d: _plain_end(arrivals.region_count(s, d, "10 minutes")),
        "region_count_dense": lambda s, d: _plain_end(windows.dense(arrivals.region_count(s, d), "60 minutes")),
    }


def exchange_jobs() -> dict[str, Job]:
    return {
        "trips_per_region": exchange.trips_per_region,
        "trips_by_minute": lambda s, d: _plain_end(exchange.trips_by_minute(s, d, "10 minutes", MINUTES_PER_BATCH, "10 minutes")),
        "order_instances": exchange.order_instances,
        "order_adjacency": exchange.order_adjacency,
        "duplicate_orders": exchange.duplicate_orders,
        "text_ensemble_vote": lambda s, d: shortened(exchange.text_ensemble(s, d, EPOCHS), "score", SCORE_DIGITS),
        "text_model": lambda s, d: shortened(exchange.text_model(s, d, EPOCHS), "weight"),
        "model_table": lambda s, d: shortened(exchange.model_table(s, d, EPOCHS), "weight"),
        "sorted_text": exchange.sorted_text,
        "resumed_pagerank": lambda s, d: shortened(exchange.resumed_ranks(s, d, SOURCES, STEPS // 2, STEPS), "rank"),
    }


def all_jobs() -> dict[str, Job]:
    return {
        **report_jobs(),
        **text_jobs(),
        **retrieval_jobs(),
        **graph_jobs(),
        **classification_jobs(),
        **arrival_jobs(),
        **exchange_jobs(),
    }
