"""Benchmark decontamination by winnowing, in DataFrame operations only.

Every run of 13 words keeps the smallest of the hashes of its 6-word grams. Document and benchmark windows that
are equal keep the same gram, so joining the kept grams finds every shared window; the hit is then extended over
all item windows that keep this gram, and each is compared word by word. Whether a gram is the smallest of a window is
only asked of those that the benchmark has. Items of fewer words are one window and
keep the hash of the whole. A bitmap of the benchmark's grams, built before, spares the join nearly all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import native
from millrace.llm.common import stored

SPAN = 13
GRAM = 6
_HIT = "struct<fp:bigint,at:int,begin:int,near:array<string>>"


def fingerprints(benchmark: DataFrame, span: int, gram: int) -> DataFrame:
    """``(fp, item, span, ahead, extra, segment)``: a kept gram, and the words of the windows that keep it.

    The windows are those of ``span`` words that begin 0 to ``extra`` words into ``segment``; the gram begins
    ``ahead`` words into it.
    """
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item"), native.alnum_words(F.col("text").cast("string")).alias("words")
    ).where(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(span))
    sized = words.select("item", "words", n.alias("span"), F.least(n, F.lit(gram)).alias("gram"))
    # An item that is shorter than a window keeps one gram: all of its words.
    sized = sized.withColumn("gram", F.when(F.col("span") < span, F.col("span")).otherwise(F.lit(gram)))
    at = F.sequence(F.lit(1), F.size("words") - F.col("gram") + 1)
    hashes = F.transform(at, lambda i: F.xxhash64(F.col("gram"), F.slice("words", i, F.col("gram"))))
    hashed = sized.withColumn("hashes", hashes)
    starts = hashed.select(
        "item", "words", "span", "gram", "hashes", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("span") + 1)).alias("start")
    )
    kept = F.slice("hashes", F.col("start"), F.col("span") - F.col("gram") + 1)
    grams = starts.select(
        "item", "words", "span", "start",
        F.array_min(kept).alias("fp"),
        (F.array_position(kept, F.array_min(kept)).cast("int") + F.col("start") - 1).alias("place"),
    )
    return (
        grams.groupBy("item", "words", "span", "fp", "place")
        .agg(F.min("start").alias("first"), F.max("start").alias("last"))
        .select(
            "fp", "item", "span",
            (F.col("place") - F.col("first")).alias("ahead"),
            (F.col("last") - F.col("first")).alias("extra"),
            F.slice("words", F.col("first"), F.col("last") - F.col("first") + F.col("span")).alias("segment"),
        )
        .distinct()
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, keep: Sequence[str] | None = None
) -> DataFrame:
    """All columns of ``docs(doc_id, text)``, or those to ``keep``, with the words of each row that a benchmark window covers.

    Columns that are kept are moved with their row. Adds ``n_words``, ``n_hit``, ``items`` (sorted ids, as text, of the items with a window in the text) and
    ``contaminated``: at least one word in twenty is hit. Columns of these names are replaced, any other names are fine. Null, empty and
    wordless texts have no words and are clean, and so is everything if the benchmark is empty. Every row is judged
    by itself, so repeated rows and null ids stay. Windows of items without an id count as hits but name no item.
    The work is linear in the length of a text, however much of it is hit.
    """
    added = ("n_words", "n_hit", "items", "contaminated")
    rest = [c for c in (docs.columns if keep is None else keep) if c not in added]
    prints = stored(fingerprints(benchmark, span, gram), "prints")
    facts = prints.agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length(F.concat_ws(" ", "segment")) + 100).alias("size"),
        F.collect_set(F.when(F.col("span") < span, F.col("span"))).alias("short"),
    ).first()
    schemes = [(span, gram)] + [(n, n) for n in sorted(facts["short"])]
    map_, bits = native.bitmap(prints, "fp")

    def kept(words: Column, span: int, gram: int) -> Column:
        """Grams of benchmark fingerprints that are the smallest of some window, with the words of their windows."""
        width = span - gram + 1

        def smallest(h: Column, i: Column) -> Column:
            windows = F.sequence(F.greatest(i - (width - 1), F.lit(1)), F.least(i, F.size(h) - (width - 1)))
            return (F.size(h) >= width) & F.exists(windows, lambda s: F.array_min(F.slice(h, s, width)) == F.element_at(h, i))

        def places(h: Column) -> Column:
            at = F.when(F.size(h) > 0, F.sequence(F.lit(1), F.size(h))).otherwise(F.array().cast("array<int>"))
            known = F.filter(at, lambda i: native.marked(F.col("map"), bits, F.element_at(h, i)))
            if width > 1:
                known = F.filter(known, lambda i: smallest(h, i))
            return F.transform(known, lambda i: native.let(F.greatest(i - (width - 1), F.lit(1)), lambda begin: hit(h, i, begin)))

        def hit(h: Column, i: Column, begin: Column) -> Column:
            near = F.slice(words, begin, i - begin + span)
            return F.struct(F.element_at(h, i).alias("fp"), i.alias("at"), begin.alias("begin"), near.alias("near"))

        return native.let(native.gram_hashes(words, gram), places)

    def judged(words: Column) -> Column:
        return F.struct(F.size(words).alias("n"), F.concat(*[kept(words, *scheme) for scheme in schemes]).alias("hits"))

    whole = F.struct(*[docs[f"`{c}`"].alias(c) for c in rest])
    rows = (
        docs.select(whole.alias("doc"), docs["text"].cast("string").alias("text"))
        .withColumns({"row": F.monotonically_increasing_id(), "map": map_})
        .select("row", "doc", native.let(native.alnum_words(F.col("text")), judged).alias("judged"))
    )
    # The document goes along once, beside its hits and not with each of them.
    itself = F.struct(F.col("doc"), F.col("judged.n").alias("n"), F.lit(None).cast(_HIT).alias("hit"))
    each = F.transform(
        "judged.hits", lambda h: F.struct(F.lit(None).cast(rows.schema["doc"].dataType).alias("doc"), F.col("judged.n").alias("n"), h.alias("hit"))
    )
    spread = rows.select("row", F.explode(F.concat(F.array(itself), each)).alias("e")).select("row", "e.*")
    # Rows without a hit meet nothing; a key of their own keeps them from one partition where the sides are shuffled.
    key = F.when(F.col("hit").isNotNull(), F.col("hit.fp")).otherwise(F.xxhash64("row"))
    known = native.broadcast_if_small(prints, facts["size"] or 0)
    joined = spread.withColumn("key", key).join(known, (F.col("key") == F.col("fp")) & F.col("hit").isNotNull(), "left")
    first = F.col("hit.at") - F.col("ahead")
    matching = F.filter(
        F.sequence(F.lit(0), F.col("extra")),
        lambda t: (first + t >= 1)
        & (first + t + F.col("span") - 1 <= F.col("n"))
        & (
            F.slice("hit.near", F.greatest(first + t, F.lit(1)) - F.col("hit.begin") + 1, F.col("span"))
            == F.slice("segment", t + 1, F.col("span"))
        ),
    )
    matched = joined.withColumn("begins", F.when(F.col("fp").isNotNull(), F.transform(matching, lambda t: first + t)))
    found = F.when(F.size("begins") > 0, F.struct("item", "span", "begins"))
    grouped = matched.groupBy("row").agg(
        F.first("doc", ignorenulls=True).alias("doc"), F.first("n").cast("long").alias("n_words"), F.collect_list(found).alias("hits")
    )
    covered = F.array_distinct(
        F.flatten(F.transform("hits", lambda s: F.flatten(F.transform(s["begins"], lambda b: F.sequence(b, b + s["span"] - 1)))))
    )
    items = F.array_sort(F.array_distinct(F.filter(F.transform("hits", lambda s: s["item"]), lambda x: x.isNotNull())))
    n_hit = F.size(covered).cast("long")
    return grouped.select("doc", "n_words", n_hit.alias("n_hit"), items.alias("items")).select(
        *[F.col("doc").getField(c).alias(c) for c in rest],
        "n_words",
        "n_hit",
        "items",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
