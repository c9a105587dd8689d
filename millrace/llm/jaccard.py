"""Exact Jaccard join of documents on word shingles by PartEnum signatures.

Sets of similar size share a size band, and two sets whose Jaccard similarity reaches the threshold differ in at
most k elements, k following from their sizes. The hashes of all shingles are cut into n partitions, more than
k + q of them. Two such sets then agree on at least n - k partitions, and if each keeps the signatures of the
k + 1 + q partitions that come first in an order that depends on the partition's content alone (most shingles first,
empty ones last), at least q + 1 of the kept ones agree. Because q are to spare, every set may give up its q
signatures with the most holders, which are those that a frequent passage makes, without losing a partner.

Sets that share a signature are compared exactly, but not all with all: first every set with the one it shares the
most with among neighbours in a random order, in several turns where groups stay large. Where many sets hold much the same
signatures and are still in several components, those outside of the largest are compared with all, tile by tile in memory, and only the
links that keep a component together leave the task. What is then left are pairs of different components in small
groups. A pair that shares fewer signatures than it must is not compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import blocks as B
from millrace.llm.common import Scratch, grams, hash_words, mix, small_batches, stored, text_words, tidy, tidy_group
from millrace.llm.components import components, with_links
from millrace.operators.skew import hot_keys, join_spread

SHINGLE = 5
THRESHOLD = Fraction(3, 4)
GROWTH = Fraction(4, 3)
PART_SIZE = 2.5
SPARE = 0.1
HOT_HOLDERS = 32
CROWD = 64
CROWD_ROWS = 5_000
TURNS = 4  # at most, for groups of more than ``MANY_TILES``
TILE_ROWS = 1024
TILE_COLUMNS = 4096
MANY_TILES = 4


class Bands:
    """Size bands, and for a set of a size the signatures it needs in each."""

    def __init__(self, threshold: Fraction) -> None:
        self.threshold = threshold
        self.tops = [1]
        self.known: dict[int, list[tuple[int, int, int, int]]] = {}

    def of(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * GROWTH)))
        return int(np.searchsorted(self.tops, size))

    def differ(self, total: int) -> int:
        """Most elements in which two sets of this total size can differ."""
        t = self.threshold
        return int(total * (1 - t) / (1 + t))

    def needed(self, size: int) -> list[tuple[int, int, int, int]]:
        """``(band, partitions, signatures to keep, spare)`` for every band of the larger set of a pair."""
        if size not in self.known:
            largest = int(size / self.threshold)
            bands, last = [], self.of(largest)
            for band in range(self.of(size), last + 1):
                top = self.tops[band]
                most = self.differ(2 * top)
                spare = int(SPARE * most)
                parts = max(most + 1 + spare, int(top / PART_SIZE))
                bands.append((band, parts, self.differ(size + min(top, largest)) + 1 + spare, spare))
            self.known[size] = bands
        return self.known[size]


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes; of the whole if there are fewer words."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    return np.unique(grams(words, min(SHINGLE, len(words))))


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    if not len(shingles):
        return 0, 0
    with np.errstate(over="ignore"):
        sums = [int(mix(shingles, seed).sum(dtype=np.uint64)) for seed in (101, 202)]
    return tuple(s - (1 << 64) if s >> 63 else s for s in sums)


def signatures(shingles: np.ndarray, bands: Bands) -> Iterator[tuple[int, np.ndarray]]:
    """The signatures of a set in every band it takes part in."""
    spread = mix(shingles, 7) >> np.uint64(32)
    content = mix(shingles, 11)
    for band, parts, keep, _ in bands.needed(len(shingles)):
        where = (spread * np.uint64(parts)) >> np.uint64(32)
        order = np.argsort(where, kind="stable")
        where = where[order]
        firsts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        value = mix(np.add.reduceat(content[order], firsts), 13)
        value = mix(value + where[firsts] * np.uint64(0x9E3779B97F4A7C15), band + 1000)
        if len(value) > keep:
            size = np.diff(np.r_[firsts, len(where)])
            value = value[np.lexsort((value, -size))[:keep]]
        elif len(value) < keep:
            # Too few partitions have shingles, so agreeing on an empty one has to count as well.
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), where[firsts])
            marks = np.sort(mix(mix(empty, 17), band + 1000))
            value = np.r_[value, marks[: keep - len(value)]]
        yield band, value


# Stages ---------------------------------------------------------------------------------------------

RECORD = np.dtype([("sig", "<u8"), ("doc", "<u2"), ("band", "u1")])
PACKED = 9
FACT = np.dtype([("uid", "<i8"), ("k1", "<i8"), ("k2", "<i8"), ("n", "<i8"), ("doc", "<i8"), ("known", "<i8")])
ASKED = "kind int, bucket int, block long, blob binary"
FOUND = "kind int, k1 long, k2 long, n long, doc long, uids array<long>"
FACTS, GROUPS, HOT = 0, 1, 2


def pack_records(records: np.ndarray) -> bytes:
    """Records without the lowest 16 bits of the signature: the few that then meet by chance are told apart later."""
    kept = (records["sig"] >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]
    return kept.tobytes() + records["doc"].tobytes() + records["band"].tobytes()


def unpack_records(blob: bytes) -> np.ndarray:
    n = len(blob) // PACKED
    sig = np.zeros((n, 8), dtype=np.uint8)
    sig[:, :6] = np.frombuffer(blob, np.uint8, 6 * n).reshape(-1, 6)
    records = np.empty(n, dtype=RECORD)
    records["sig"] = sig.view("<u8").ravel()
    records["doc"] = np.frombuffer(blob, "<u2", n, 6 * n)
    records["band"] = np.frombuffer(blob, "u1", n, 8 * n)
    return records


def first_uid(block: int) -> int:
    """Row number of the first document of a block: 20 bits of task, 21 of block, 22 of row."""
    task, seq = block >> 32, block & 0xFFFFFFFF
    if task >> 20 or seq >> 21:
        raise ValueError("too many blocks for row numbers")
    return (task << 43) | (seq << 22)


def _block_of(uid: Column) -> Column:
    """The block of a row number, as a column."""
    high = F.shiftright(uid, 43)
    return F.call_function("shiftleft", high, F.lit(32)) + F.shiftright(uid, 22).bitwiseAND(F.lit((1 << 21) - 1))


def _sets(blob) -> tuple[list, list[np.ndarray]]:
    ids, texts = B.open_block(blob)
    buf, starts, ends, offsets = text_words(texts, lower=True)
    words = hash_words(buf, starts, ends)
    return ids, [shingle_set(words[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]


def _ask(buckets: int):
    """Pack the facts and signatures of every block for the buckets of the signatures."""

    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        bands = Bands(THRESHOLD)
        for batch in rows:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("docs"), strict=True):
                ids, sets = _sets(blob.as_buffer())
                base = first_uid(block)
                facts = np.zeros(len(ids), dtype=FACT)
                seen, parts = set(), []
                for i, (doc, shingles) in enumerate(zip(ids, sets, strict=True)):
                    key = set_key(shingles)
                    facts[i] = (base + i, *key, len(shingles), doc or 0, doc is not None)
                    if len(shingles) and key not in seen:
                        seen.add(key)
                        for band, found in signatures(shingles, bands):
                            part = np.empty(len(found), dtype=RECORD)
                            part["sig"], part["doc"], part["band"] = found, i, band
                            parts.append(part)
                out = [(FACTS, block % buckets, block, facts.tobytes())]
                if parts:
                    records = np.concatenate(parts)
                    records = records[np.argsort(records["sig"], kind="stable")]
                    out += [(GROUPS, b, block, pack_records(records[x:y])) for b, x, y in B.cuts(records["sig"], buckets)]
                types = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "bucket", "block", "blob"])

    return run


def _meet(table):
    """Facts of the documents, and the documents that share a signature, of one bucket."""
    import pyarrow as pa

    facts, parts, uids = [], [], []
    for kind, block, blob in zip(
        table.column("kind").to_pylist(), table.column("block").to_pylist(), table.column("blob").to_pylist(), strict=True
    ):
        if kind == FACTS:
            facts.append(np.frombuffer(blob, dtype=FACT))
        else:
            part = unpack_records(blob)
            parts.append(part)
            uids.append(part["doc"].astype(np.int64) + first_uid(block))
    out = []
    if facts:
        fact = np.concatenate(facts)
        n = len(fact)
        out.append((np.full(n, FACTS), fact["k1"], fact["k2"], fact["n"], fact["doc"], fact["known"] == 0, fact["uid"], np.arange(n + 1)))
    if parts:
        records, uid = np.concatenate(parts), np.concatenate(uids)
        order = np.lexsort((uid, records["sig"]))
        records, uid = records[order], uid[order]
        firsts = np.flatnonzero(np.r_[True, records["sig"][1:] != records["sig"][:-1]])
        holders = np.diff(np.r_[firsts, len(uid)])
        shared = holders > 1
        hot = holders >= HOT_HOLDERS
        out += [_small(uid, firsts[shared & ~hot], holders[shared & ~hot])]
        out += [_hot(uid, records, firsts[hot], holders[hot])]
    names = [part.split()[0] for part in FOUND.split(", ")]
    tables = []
    for kind, k1, k2, n, doc, unknown, flat, offsets in out:
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))
        columns = [pa.array(kind, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(n, pa.int64())]
        tables.append(pa.table([*columns, pa.array(doc, pa.int64(), mask=unknown), lists], names=names))
    return pa.concat_tables(tables)


def _ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of all ranges, one after another."""
    total = int(sizes.sum())
    begins = np.repeat(firsts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) if len(sizes) else np.empty(0, np.int64)
    return begins + np.arange(total)


def _small(uid: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> tuple:
    """Groups of few holders, equal ones counted."""
    weights = mix(uid[_ranges(firsts, sizes)].astype(np.uint64), 23)
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    sums = np.add.reduceat(weights, offsets[:-1]) if len(sizes) else np.empty(0, np.uint64)
    key, first, count = np.unique(sums, return_index=True, return_counts=True)
    n = len(key)
    flat = uid[_ranges(firsts[first], sizes[first])]
    zeros = np.zeros(n, np.int64)
    none = np.ones(n, dtype=bool)
    return np.full(n, GROUPS), key.astype(np.int64), zeros, count, zeros, none, flat, np.r_[0, np.cumsum(sizes[first])]


def _hot(uid: np.ndarray, records: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> tuple:
    """Groups of many holders, a row for each holder."""
    flat = _ranges(firsts, sizes)
    n = len(flat)
    none = np.ones(n, dtype=bool)
    sig, band = records["sig"][flat].astype(np.int64), records["band"][flat].astype(np.int64)
    return np.full(n, HOT), sig, band, np.repeat(sizes, sizes), np.zeros(n, np.int64), none, uid[flat], np.arange(n + 1)


def _wanted_sets(rows: Iterator) -> Iterator:
    """Shingle sets of the documents asked for."""
    import pyarrow as pa

    for batch in rows:
        for block, blob, uids in zip(
            batch.column("block").to_pylist(), batch.column("docs"), batch.column("uids").to_pylist(), strict=True
        ):
            ids, texts = B.open_block(blob.as_buffer())
            base = first_uid(block)
            uids = sorted(set(uids))
            buf, starts, ends, offsets = text_words([texts[u - base] for u in uids], lower=True)
            words = hash_words(buf, starts, ends)
            sets = [shingle_set(words[a:b]).astype(np.int64) for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["uid", "shingles"]
            )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold."""
    first = sets.select(F.col("uid").alias("a"), F.col("shingles").alias("_x"))
    second = sets.select(F.col("uid").alias("b"), F.col("shingles").alias("_y"))
    same = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - F.col("_same")
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .withColumn("_same", same)
        .where(THRESHOLD.denominator * F.col("_same") >= THRESHOLD.numerator * union)
        .select("a", "b")
    )


def _spares(band: Column) -> Column:
    """Spare signatures of a band, as a column."""
    bands = Bands(THRESHOLD)
    bands.of(1 << 40)
    spares = [int(SPARE * bands.differ(2 * top)) for top in bands.tops]
    return F.element_at(F.array(*[F.lit(n) for n in spares]), (band + 1).cast("int"))


def _band_of(size: Column) -> Column:
    """The band of a size, as a column."""
    bands = Bands(THRESHOLD)
    bands.of(1 << 40)
    return F.size(F.filter(F.array(*[F.lit(top) for top in bands.tops]), lambda top: top < size))


def _places(hot: DataFrame) -> DataFrame:
    """Holders of hot groups, with whether they can spare the group."""
    hottest = Window.partitionBy("uid", "band").orderBy(F.desc("holders"), "sig")
    return hot.withColumn("spared", F.row_number().over(hottest) <= _spares(F.col("band")))


def _sharing_enough(holders: DataFrame, facts: DataFrame) -> DataFrame:
    """Holders that share more signatures, with whomever, than any pair of their size has to spare."""
    totals = holders.groupBy("rep").agg(F.sum("weight").alias("total"))
    known = totals.join(facts, F.col("rep") == F.col("uid"))
    enough = known.where(F.col("total") + F.col("spared") > _spares(_band_of(F.col("n")))).select(F.col("rep").alias("_rep"))
    return holders.join(enough, F.col("rep") == F.col("_rep")).drop("_rep")


def _neighbours(holders: DataFrame, turn: int = 0) -> DataFrame:
    """Pairs of holders of a group, at most one per holder and group, with how much of its groups a pair shares.

    Large groups are dealt to parts at random, in another way each ``turn``. Holders that are known to be in one
    component are no pair.
    """
    part = F.pmod(F.xxhash64("rep", F.lit(turn)), F.ceil(F.col("holders") / HOT_HOLDERS).cast("int"))
    line = Window.partitionBy("g", "_part").orderBy(F.xxhash64("rep", F.lit(-turn)), "rep")
    return (
        holders.withColumn("_part", part)
        .select("rep", "root", "weight", "holders", F.lag("rep").over(line).alias("b"), F.lag("root").over(line).alias("_root"))
        .where("b IS NOT NULL AND root <> _root")
        .groupBy(F.col("rep").alias("a"), "b")
        .agg(F.sum(F.col("weight") / F.col("holders")).alias("w"))
    )


def _crowds(holders: DataFrame, scratch: Scratch) -> DataFrame:
    """Open groups with the crowd they belong to, and how many holders it has.

    Groups whose holder with the smallest hash is the same form a crowd: groups of much the same holders do.
    """
    least = F.min(F.struct(F.xxhash64("rep").alias("hash"), "rep"))
    crowds = holders.groupBy("g").agg(least["rep"].alias("crowd")).withColumnRenamed("g", "_g")
    named = scratch.stored(holders.join(crowds, F.col("g") == F.col("_g")).drop("_g"), "jaccard-named")
    per_rep = named.groupBy("crowd", "rep").agg(F.count("*").alias("_rows"))
    sizes = per_rep.groupBy("crowd").agg(F.count("*").alias("crowd_size"), F.sum("_rows").alias("_rows"))
    sizes = scratch.stored(sizes, "jaccard-crowd-sizes")
    hot = hot_keys(sizes, "crowd", "_rows", CROWD_ROWS)
    return join_spread(named, sizes.drop("_rows"), "crowd", "rep", hot, CROWD_ROWS)


def _compare_all(table):
    """Links between the known components of a tile of documents, by comparing all of them.

    A link is of the roots of two components, and a tile has fewer links than components, however many documents they have.
    """
    import pyarrow as pa

    roots, firsts, known = np.unique(table.column("root").to_numpy(), return_index=True, return_inverse=True)
    lists = table.column("shingles").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    m = len(known)
    _, which, counts = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    common = counts[which] > 1
    column = np.cumsum(counts > 1)[which[common]] - 1
    owner = owner[common]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    same = np.zeros((m, m), dtype=np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, TILE_COLUMNS):
        x, y = np.searchsorted(column, (first, first + TILE_COLUMNS))
        held = np.zeros((m, TILE_COLUMNS), dtype=np.float32)
        held[owner[x:y], column[x:y] - first] = 1
        same += held @ held.T
    union = sizes[:, None] + sizes[None, :] - same
    linked = (THRESHOLD.denominator * same >= THRESHOLD.numerator * union) | (known[:, None] == known)
    root = np.full(m, -1)
    for i in firsts:  # so that tiles which join the same components name the same one, that of the smallest root
        if root[i] < 0:
            reached = np.zeros(m, dtype=bool)
            edge = np.array([i])
            while len(edge):
                reached[edge] = True
                edge = np.flatnonzero(linked[edge].any(axis=0) & ~reached)
            root[reached] = i
    joined = roots[known[root[firsts]]]
    out = joined != roots
    return pa.table({"a": pa.array(roots[out], pa.int64()), "b": pa.array(joined[out], pa.int64())})


def _compare_crowds(crowds: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Links inside large crowds, whose documents are dealt to tiles and compared tile by tile.

    Links are wanted between components only, so the documents of a crowd's largest component, which may be nearly
    all of it, meet the others but not each other.
    """
    people = scratch.stored(crowds.select("crowd", "rep", "root").distinct(), "jaccard-people")
    parts = people.groupBy("crowd", "root").agg(F.count("*").alias("n"))
    tops = parts.groupBy("crowd").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("_rows"))
    tops = scratch.stored(tops, "jaccard-tops")
    hot = hot_keys(tops, "crowd", "_rows", CROWD_ROWS)
    placed = join_spread(people, tops, "crowd", "rep", hot, CROWD_ROWS)
    tiles = lambda n: F.ceil(n / TILE_ROWS).cast("int")
    few, many = tiles(F.col("_rows") - F.col("top.n")), tiles(F.col("top.n"))
    largest = F.col("root") == F.col("top.root")
    tile = F.xxhash64("rep", F.lit(3))
    own = F.when(largest, few + F.pmod(tile, many)).otherwise(F.pmod(tile, few)).cast("int")
    dealt = placed.where(F.col("_rows") > F.col("top.n")).select(
        "crowd", "rep", "root", own.alias("_own"), F.explode(F.sequence(F.lit(0), F.when(largest, few).otherwise(few + many) - 1)).alias("_other")
    )
    shingles = sets.withColumnRenamed("uid", "_uid")
    return (
        dealt.join(shingles, F.col("rep") == F.col("_uid"))
        .groupBy("crowd", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"))
        .applyInArrow(tidy_group(_compare_all), "a long, b long")
        .distinct()  # components that meet in many crowds or tiles are linked in each
    )


def _best(pairs: DataFrame) -> DataFrame:
    """The pairs that are the best of either of their ends."""
    ends = pairs.select("a", "w", "b").union(pairs.select("b", "w", "a")).toDF("end", "w", "other")
    best = ends.groupBy("end").agg(F.max(F.struct("w", "other")).alias("best"))
    return best.select(F.greatest("end", "best.other").alias("a"), F.least("end", "best.other").alias("b")).distinct()


def _rooted(holders: DataFrame, roots: DataFrame) -> DataFrame:
    """Holders of the groups that still have several components, with their components."""
    placed = holders.drop("root").join(roots, F.col("rep") == F.col("id"), "left").withColumn("root", F.coalesce("root", "rep"))
    split = placed.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("holders"))
    split = split.where("low < high").select(F.col("g").alias("_g"), "holders")
    return placed.select("g", "rep", "weight", "root").join(split, F.col("g") == F.col("_g")).drop("_g")


class Joined:
    """The result of a join: rows by number, and the blocks they are in."""

    def __init__(self, blocks: B.Bucketed, rows: DataFrame) -> None:
        self.blocks, self.rows = blocks, rows


def jaccard_join(docs: DataFrame) -> Joined:
    """Link documents whose sets of lower-cased five-word shingles have a Jaccard similarity of 0.75 or more.

    ``rows`` has, per row of ``docs(doc_id, text)``, ``(uid, doc_id, n_shingles, component_id, first)``: the
    component is the smallest ``doc_id`` reachable by links, and ``first`` marks one row per component, of that id.
    A text of one to four words is one shingle; null, empty and blank texts have none and are linked with nothing.
    Repeated rows are linked like other equal texts. A null id is larger than all others; a component without any
    id is null. Other columns are not looked at; an empty table gives no rows.
    """
    rows = docs.withColumns({"doc_id": docs["doc_id"].cast("long"), "text": docs["text"].cast("string")})
    blocks = B.write_blocks(rows, "jaccard-blocks")
    buckets = B.bucket_count(blocks.table)
    scratch = Scratch(docs.sparkSession)
    asked = blocks.table.mapInArrow(tidy(_ask(buckets)), ASKED)
    met = asked.groupBy("bucket").applyInArrow(tidy_group(_meet), FOUND)
    path = scratch.path("jaccard-met")
    with small_batches(docs.sparkSession):
        met.write.partitionBy("kind").parquet(path)
    found = docs.sparkSession.read.schema(FOUND).parquet(path)
    facts = found.where(F.col("kind") == FACTS).select(F.col("uids")[0].alias("uid"), "k1", "k2", "n", "doc")
    classes = scratch.stored(
        facts.where("n > 0").groupBy("k1", "k2").agg(F.min("uid").alias("rep")).withColumnRenamed("k1", "c1").withColumnRenamed("k2", "c2"),
        "jaccard-classes",
    )
    same = (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    members = scratch.stored(facts.join(classes, same, "left").select("uid", "doc", "n", "rep"), "jaccard-members")
    copies = members.where("uid <> rep").select(F.col("uid").alias("copy"), "rep")

    hot = found.where(F.col("kind") == HOT).select(
        F.col("k1").alias("sig"), F.col("k2").alias("band"), F.col("n").alias("holders"), F.col("uids")[0].alias("uid")
    )
    small = found.where(F.col("kind") == GROUPS).groupBy("uids").agg(F.sum("n").alias("weight"))
    hot = scratch.stored(_places(hot), "jaccard-hot")
    spared = hot.where("spared").groupBy("uid").agg(F.count("*").alias("spared"))
    held = small.select(F.xxhash64(F.lit(1), "uids").alias("g"), "weight", F.explode("uids").alias("uid")).union(
        hot.where("not spared").select(F.xxhash64(F.lit(2), "sig").alias("g"), F.lit(1).cast("long").alias("weight"), "uid")
    )
    placed = held.join(copies, F.col("uid") == F.col("copy"), "left")
    distinct = placed.groupBy("g", F.coalesce("rep", "uid").alias("rep")).agg(F.max("weight").alias("weight"))
    facts_of = members.where("uid = rep").join(spared.withColumnRenamed("uid", "_u"), F.col("uid") == F.col("_u"), "left")
    facts_of = scratch.stored(facts_of.select("uid", "n", F.coalesce("spared", F.lit(0)).alias("spared")), "jaccard-facts")
    alone = docs.sparkSession.createDataFrame([], "id long, root long")
    holders = scratch.stored(_rooted(_sharing_enough(scratch.stored(distinct, "jaccard-shared"), facts_of), alone), "jaccard-holders")
    requests = holders.select("rep").distinct().groupBy(_block_of(F.col("rep")).alias("block")).agg(F.collect_list("rep").alias("uids"))
    sets = scratch.stored(blocks.table.join(requests, "block").mapInArrow(tidy(_wanted_sets), "uid long, shingles array<long>"), "jaccard-sets")

    # Each list of components is made from the one before, a link for each document, and the links found since.
    roots = components(scratch.stored(_verified(_best(_neighbours(holders)), sets), "jaccard-links"))
    open_ = scratch.stored(_rooted(holders, roots), "jaccard-open")
    for turn in range(1, TURNS):
        large = open_.where(F.col("holders") > MANY_TILES * TILE_ROWS)
        if large.isEmpty():
            break
        roots = with_links(roots, scratch.stored(_verified(_best(_neighbours(large, turn)), sets), "jaccard-links"))
        open_ = scratch.stored(_rooted(open_, roots), "jaccard-open")
    open_ = scratch.stored(_crowds(open_, scratch), "jaccard-crowds")
    tiled = scratch.stored(_compare_crowds(open_.where(F.col("crowd_size") >= CROWD), sets, scratch), "jaccard-tiled")
    roots = with_links(roots, tiled)
    open_ = scratch.stored(_rooted(open_.where(F.col("crowd_size") < CROWD), roots), "jaccard-rest")

    sized = open_.join(facts_of, F.col("rep") == F.col("uid")).drop("uid")
    other = sized.select(
        F.col("g").alias("_g"), F.col("rep").alias("b"), F.col("root").alias("_root"), F.col("n").alias("_n"), F.col("spared").alias("_spared")
    )
    t = THRESHOLD
    near = (F.least("n", "_n") * t.denominator) >= (F.greatest("n", "_n") * t.numerator)
    shared = F.sum("weight") + F.max(F.least("spared", "_spared"))
    crossing = (
        sized.join(other, (F.col("g") == F.col("_g")) & (F.col("root") < F.col("_root")))
        .where(near)
        .groupBy(F.col("rep").alias("a"), "b")
        .agg(shared.alias("shared"), F.max(F.greatest("n", "_n")).alias("n"))
        .where(F.col("shared") > _spares(_band_of(F.col("n"))))
        .select("a", "b")
    )
    more = scratch.stored(_verified(crossing, sets), "jaccard-more")
    final = with_links(roots, more)
    linked = members.join(final, F.col("rep") == F.col("id"), "left").select(
        "uid", F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("root", "rep", "uid").alias("root")
    )
    linked = stored(linked, "jaccard-linked")
    scratch.delete()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    names = linked.groupBy("root").agg(F.min(order).alias("least")).withColumnRenamed("root", "_root")
    rows = linked.join(names, F.col("root") == F.col("_root")).select(
        "uid", "doc_id", "n_shingles",
        F.col("least.doc_id").alias("component_id"),
        (F.col("uid") == F.col("least.uid")).alias("first"),
    )
    return Joined(blocks, rows)


def _take(rows: Iterator) -> Iterator:
    """The rows of each block that are asked for."""
    import pyarrow as pa

    for batch in rows:
        for block, blob, uids in zip(
            batch.column("block").to_pylist(), batch.column("docs"), batch.column("uids").to_pylist(), strict=True
        ):
            table = pa.ipc.open_stream(blob.as_buffer()).read_all()
            yield from table.take(_numbers(uids, first_uid(block))).combine_chunks().to_batches()


def _numbers(uids: list[int], base: int):
    import pyarrow as pa

    return pa.array(sorted(u - base for u in uids), pa.int64())


def distinct_documents(docs: DataFrame) -> DataFrame:
    """All columns of one row of each component, the first of its smallest id; rows without shingles all stay.

    See ``jaccard_join`` for the treatment of nulls, short texts and repeated rows.
    """
    found = jaccard_join(docs)
    kept = found.rows.where("first").groupBy(_block_of(F.col("uid")).alias("block")).agg(F.collect_list("uid").alias("uids"))
    schema = docs.withColumns({"doc_id": docs["doc_id"].cast("long"), "text": docs["text"].cast("string")}).schema
    return found.blocks.table.join(kept, "block").mapInArrow(tidy(_take), schema)
