"""Merkle manifest of a table of documents, with the proof of every row by pointer jumping.

The rows of a source, in order of their ids, are the leaves of a tree of ``fanout`` children a node; the roots of the
sources, in order of the sources, are the leaves of one more tree. A node that is not the root begins with a pointer
to its parent and the segment of a proof that lies between them: its siblings. A round joins the nodes to themselves:
every pointer moves on to where the one it points to leads, and the segments are put end to end, so the distance doubles
and a tree of depth d needs log2(d) rounds. Only inner nodes jump, a sixteenth of the rows; leaves take the last hop to
their parent as a run, so what they share of their proofs is moved once per run.

Nodes that point to one ancestor are dealt to as many copies of it as keep a key at a run of siblings (``COPIES`` per
shuffle partition at most), so neither a large source nor the root draws many rows into a task. Leaves are numbered by a
sort by range of (source, id), which cuts a large source into parts.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import Scratch, stored
from millrace.session import shuffle_partitions

FANOUT = 16
COPIES = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # the number of the tree over the sources
PART_BITS = 33  # of a row's place within its partition, in ids that increase monotonically


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts, end to end, in lower-case hexadecimal."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(fields: Mapping[str, Column]) -> Column:
    """Digest of values: each is ``-`` if null, else its length in UTF-8 bytes, a colon and itself."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[framed(value) for value in fields.values()])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    steps = F.filter(F.split(path, ";"), lambda step: step != "")
    return F.aggregate(
        steps, leaf, lambda below, step: digest(F.substring_index(step, "|", 1), below, F.substring_index(step, "|", -1))
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, end to end."""
    return digest(F.translate(path, "|;", ""))


def _siblings(digests: Column, at: Column) -> Column:
    """The step of a path at child ``at`` (from 0) of a run: siblings before it, a bar, siblings after it, a semicolon."""
    before = F.array_join(F.slice(digests, F.lit(1), at), "")
    after = F.array_join(F.slice(digests, at + 2, F.size(digests)), "")
    return F.concat(before, F.lit("|"), after, F.lit(";"))


def _node(tree: Column, level: Column, at: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), at.cast("long").alias("at"))


class Trees(NamedTuple):
    nodes: DataFrame  # (id, up, path, digest): all nodes but the roots, pointing to their parent
    roots: DataFrame  # (id, tree, digest)


def _numbered(leaves: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """Leaves with their numbers, the number of sources, and the leaves of the largest.

    Adds ``tree``, the number of the source from 0 in order, ``at``, that of the leaf in it, and ``width``, its leaves."""
    order = [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "leaf", "_row")]
    sorted_ = leaves.repartitionByRange(shuffle_partitions(leaves.sparkSession), *order).sortWithinPartitions(*order)
    placed = scratch.stored(sorted_.drop("_row").withColumn("_place", F.monotonically_increasing_id()), "leaves")
    placed = placed.withColumn("_part", F.shiftright("_place", PART_BITS))
    # One row per part and source, in the order of the leaves: at most one per source and one more per part.
    spans = placed.groupBy("_part", "source").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    of_source = Window.partitionBy("source")
    earlier = of_source.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumns(
        {
            "_shift": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "width": F.sum("_rows").over(of_source),
            "_begins": F.min("_first").over(of_source),
        }
    )
    spans = scratch.stored(spans, "spans")
    # Sources are numbered within the part they begin in; the table of parts has one row per shuffle partition at most.
    begun = spans.where(F.col("_shift") == 0).select("_begins", F.shiftright("_begins", PART_BITS).alias("_home"))
    in_home = begun.withColumn("_nth", F.row_number().over(Window.partitionBy("_home").orderBy("_begins")) - 1)
    before = Window.orderBy("_home").rowsBetween(Window.unboundedPreceding, -1)
    homes = begun.groupBy("_home").agg(F.count("*").alias("_n")).select(
        "_home", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_of_home")
    )
    trees = in_home.join(homes, "_home").select("_begins", (F.col("_nth") + F.col("_of_home")).alias("tree"))
    known = spans.join(trees, "_begins").select(
        F.col("_part").alias("_p"), F.col("source").alias("_s"), "_first", "_shift", "width", "tree"
    )
    met = (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s"))
    facts = spans.agg(F.count(F.when(F.col("_shift") == 0, 1)).alias("sources"), F.max("width").alias("widest")).first()
    numbered = placed.join(known, met).withColumn("at", F.col("_place") - F.col("_first") + F.col("_shift"))
    return numbered, facts["sources"], facts["widest"] or 0


def _height(width: int, fanout: int) -> int:
    """Levels above ``width`` nodes."""
    height = 0
    while width > 1:
        width, height = -(-width // fanout), height + 1
    return height


def _climb(nodes: DataFrame, fanout: int, level: int, height: int, scratch: Scratch) -> Trees:
    """Build trees over ``(id, tree, at, digest, width)``, whose first inner level is ``level``.

    ``width`` is the number of nodes of the tree at this level, and no tree is higher than ``height``.
    """
    nodes = scratch.stored(nodes, "nodes")
    below = [nodes.where("false").select("id", F.col("id").alias("up"), F.lit("").alias("path"), "digest")]
    roots = []
    for level in range(level, level + height):
        roots.append(nodes.where("width = 1").select("id", "tree", "digest"))
        wide = nodes.where("width > 1")
        # At most ``fanout`` rows to a group.
        runs = wide.groupBy("tree", "width", F.expr(f"at div {fanout}").alias("up_at")).agg(
            F.array_sort(F.collect_list(F.struct("at", "id", "digest"))).alias("children")
        )
        runs = scratch.stored(runs, "runs")
        parent = _node(F.col("tree"), F.lit(level), F.col("up_at"))
        digests = F.transform("children", lambda c: c["digest"])
        below.append(
            runs.select(parent.alias("up"), digests.alias("digests"), F.posexplode("children").alias("nth", "child")).select(
                F.col("child.id").alias("id"), "up", _siblings(F.col("digests"), F.col("nth")).alias("path"), "child.digest"
            )
        )
        nodes = runs.select(
            parent.alias("id"), "tree", F.col("up_at").alias("at"), digest(F.array_join(digests, "")).alias("digest"),
            F.ceil(F.col("width") / fanout).cast("long").alias("width"),
        )
    return Trees(_union(below), _union([*roots, nodes.where("width = 1").select("id", "tree", "digest")]))


def _union(tables: list[DataFrame]) -> DataFrame:
    all_ = tables[0]
    for table in tables[1:]:
        all_ = all_.unionByName(table)
    return all_


def _jump(nodes: DataFrame, root, fanout: int, depth: int, scratch: Scratch) -> DataFrame:
    """``(id, path, subroot)``: the path of every inner node to the root, and the root of its source on it.

    No node is further than ``depth`` from the root.
    """
    spark = nodes.sparkSession
    if root is None:
        return nodes.select("id", "path", "subroot")
    at_root = F.col("up") == _node(F.lit(root["tree"]), F.lit(root["level"]), F.lit(root["at"]))
    most = COPIES * shuffle_partitions(spark)
    distance = 1
    while distance < depth:
        nodes = scratch.stored(nodes, "pointers")
        waiting = nodes.where(~at_root)
        copies = min(fanout ** (distance - 1), most)
        # Nodes of a source that others point to over this distance lie above it.
        ahead = nodes.where((F.col("id.tree") == TOP) | (F.col("id.level") > distance)).select(
            F.col("id").alias("_at"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.col("subroot").alias("_subroot"),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy"),
        )
        dealt = waiting.withColumn("_to", F.pmod(F.xxhash64("id"), F.lit(copies)).cast("int"))
        moved = dealt.join(ahead, (F.col("up") == F.col("_at")) & (F.col("_to") == F.col("_copy"))).select(
            "id", F.col("_up").alias("up"), F.concat("path", "_path").alias("path"), F.coalesce("subroot", "_subroot").alias("subroot")
        )
        nodes = nodes.where(at_root).unionByName(moved)
        distance *= 2
    return nodes.select("id", "path", "subroot")


def manifest(docs: DataFrame, carried: Mapping[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT) -> DataFrame:
    """``(doc_id, source, leaf, subroot, root, path)`` and the ``carried`` columns for every row of ``docs``.

    ``path`` is the proof: for each level from the leaf up, the digests of the siblings before the node, a bar, those
    after it, and a semicolon; see ``folded`` and ``proof_digest``. ``carried`` holds expressions over ``docs`` that come
    back with their row. Leaves of a source ascend by ``doc_id``, null first, and by digest where ids are equal, so
    repeated rows are leaves side by side and the order of the input does not matter. A null source is a source, which comes
    first. A source of one row is its own subroot, and a single subroot the root. Null, empty and long values are just
    other digests; columns that are not in ``fields`` are not read. An empty table has no root and gives no rows.
    """
    carried = dict(carried or {})
    values = {name: docs[name] for name in fields}
    leaves = docs.select(
        docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), leaf_digest(values).alias("leaf"),
        F.monotonically_increasing_id().alias("_row"), F.struct(F.lit(1).alias("_"), *[c.alias(n) for n, c in carried.items()]).alias("_more"),
    )
    scratch = Scratch(docs.sparkSession)
    numbered, n_sources, widest = _numbered(scratch.stored(leaves, "digests"), scratch)
    runs = numbered.groupBy("tree", "width", F.expr(f"at div {fanout}").alias("at")).agg(
        F.first("source").alias("source"), F.array_sort(F.collect_list(F.struct("at", "leaf", "doc_id", "_more"))).alias("leaves")
    )
    runs = stored(runs, "leaf-runs")
    alone = F.col("width") == 1  # a source of one row: the leaf is the node above which the paths begin
    digests = F.transform("leaves", lambda leaf: leaf["leaf"])
    first_level = runs.select(
        _node(F.col("tree"), F.when(alone, 0).otherwise(1), F.col("at")).alias("id"),
        "tree", "at",
        F.when(alone, F.element_at(digests, 1)).otherwise(digest(F.array_join(digests, ""))).alias("digest"),
        F.ceil(F.col("width") / fanout).cast("long").alias("width"),
    )
    height, height_above = _height(-(-widest // fanout), fanout), _height(n_sources, fanout)
    sources = _climb(first_level, fanout, 2, height, scratch)
    subroots = scratch.stored(sources.roots, "subroots")
    top = _climb(
        subroots.select(
            "id", F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), "digest",
            F.lit(n_sources).cast("long").alias("width"),
        ),
        fanout, 1, height_above, scratch,
    )
    root = top.roots.select("id.*", "digest").first()
    # The path of a node crosses the root of its source where that one's own pointer is part of it.
    none = F.lit(None).cast("string").alias("subroot")
    crossing = F.when(F.col("id.tree") != TOP, F.col("digest")).alias("subroot")
    pointers = [
        sources.nodes.select("id", "up", "path", none),
        top.nodes.select("id", "up", "path", crossing),
        top.roots.select("id", F.col("id").alias("up"), F.lit("").alias("path"), none),
    ]
    paths = stored(_jump(_union(pointers), root, fanout, height + height_above, scratch), "paths").select(
        F.col("id").alias("_id"), F.col("path").alias("_path"), "subroot"
    )
    scratch.delete()
    above = _node(F.col("tree"), F.when(alone, 0).otherwise(1), F.col("at"))
    root_digest = F.lit(root["digest"] if root else None).cast("string")
    joined = runs.join(paths, above == F.col("_id")).select(
        "source", "width", "subroot", "_path", digests.alias("_digests"), F.posexplode("leaves").alias("_nth", "_leaf")
    )
    own = F.when(alone, F.lit("")).otherwise(_siblings(F.col("_digests"), F.col("_nth")))
    return joined.select(
        F.col("_leaf.doc_id").alias("doc_id"), "source", F.col("_leaf.leaf").alias("leaf"),
        F.coalesce("subroot", root_digest).alias("subroot"), root_digest.alias("root"), F.concat(own, "_path").alias("path"),
        *[F.col("_leaf._more").getField(name).alias(name) for name in carried],
    )
