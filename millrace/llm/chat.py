"""Conversations as token-budgeted windows of chat-formatted text with a mask of what is learned.

Turns are numbered and given the sum of the tokens before them by a sort by range of (conversation, turn), so that a very
long conversation is spread over tasks like any other rows. A window begins where that sum passes a multiple of
``step`` and at each turn of more than ``step`` tokens, which stands alone: that needs the sums only, no other window, and
leaves less than two steps of new tokens in a window of smaller turns. A window after the first repeats the system turn
and, as far as the budget allows, the turns that lie within the last ``history`` tokens before it. Only assistant
texts that are new in a window are learned, so each is learned once.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings in roles and texts get a backslash after their
first character, and one more where there are backslashes already; in roles, % and line feeds are written as %25 and %0A.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from millrace.llm.common import Scratch, batches_of, stored, tidy
from millrace.llm.packing import Encoder
from millrace.session import shuffle_partitions

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
# Strings that chat and text models read as control.
CONTROLS = (BEGIN, "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BUDGET, STEP, HISTORY = 2048, 768, 512
SYSTEM, LEARNED = "system", "assistant"
TURNS_PER_COPY = 64


def _rests(first: str) -> str:
    return "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == first)


_AHEAD = {first: rf"(?=\\*(?:{_rests(first)}))" for first in "<["}
TO_ESCAPE = "|".join(re.escape(first) + ahead for first, ahead in _AHEAD.items())
ESCAPED = "|".join(rf"(?<={re.escape(first)})\\{ahead}" for first, ahead in _AHEAD.items())


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, TO_ESCAPE, r"$0\\")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape(text: str) -> str:
    return re.sub(ESCAPED, "", text)


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def _counted(tokenizer: str, step: int, names: list[str]):
    """Add to sorted turns their tokens, and what lies before them in the same partition and conversation."""

    def run(rows: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(tokenizer)
        part = TaskContext.get().partitionId()
        now, nth, before, large = object(), 0, 0, 0
        for batch in batches_of(rows, width="piece"):
            _, offsets = encoder.encoded(batch.column("piece").cast(pa.binary()).to_pylist())
            sizes = (offsets[1:] - offsets[:-1]).tolist()
            out = []
            for conv, size in zip(batch.column("conv_id").to_pylist(), sizes, strict=True):
                if conv != now:
                    now, nth, before, large = conv, 0, 0, 0
                out.append((part, nth, before, large, size))
                nth, before, large = nth + 1, before + size, large + (size > step)
            columns = zip(*out, strict=True)
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=[*names, "part", "nth", "before", "large", "tokens"],
            )

    return run


def _turns(conversations: DataFrame, tokenizer: str, step: int, scratch: Scratch) -> DataFrame:
    """Turns with ``at``, their number in the conversation, ``start``, the tokens before them, and what spans they are of."""
    order = ["conv_id", "turn", "_tie", "_row"]
    rows = conversations.select(
        "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.xxhash64("role", "text").alias("_tie"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ascending = [F.col(c).asc_nulls_first() for c in order]
    sorted_ = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *ascending).sortWithinPartitions(*ascending)
    head = F.concat(F.lit(BEGIN), escaped_role(F.col("role")), F.lit("\n"))
    formatted = sorted_.withColumns({"head": head, "body": escaped(F.col("text"))}).select(
        "conv_id", "role", F.concat("head", "body", F.lit(END)).alias("piece"),
        F.length("head").alias("text_at"), F.length("body").alias("text_size"),
    )
    schema = StructType(formatted.schema.fields + [StructField("part", IntegerType())])
    for name in ("nth", "before", "large", "tokens"):
        schema.add(name, LongType())
    placed = scratch.stored(formatted.mapInArrow(tidy(_counted(tokenizer, step, formatted.columns)), schema), "turns")
    # One row per part and conversation.
    runs = placed.groupBy(F.col("part").alias("_p"), F.col("conv_id").alias("_c")).agg(
        F.count("*").alias("_turns"), F.sum("tokens").alias("_tokens"), F.sum((F.col("tokens") > step).cast("long")).alias("_large")
    )
    whole = Window.partitionBy("_c")
    earlier = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        "_p", "_c", F.sum("_turns").over(whole).alias("n_turns"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_turns", "_tokens", "_large")],
    )
    met = (F.col("part") == F.col("_p")) & F.col("conv_id").eqNullSafe(F.col("_c"))
    large = F.col("tokens") > step
    start = F.col("before") + F.col("_tokens_before")
    return placed.join(shifts, met).select(
        "conv_id", "role", "piece", "text_at", "text_size", "tokens", "n_turns",
        (F.col("nth") + F.col("_turns_before")).alias("at"),
        start.alias("start"),
        (2 * (F.col("large") + F.col("_large_before")) + large.cast("long")).alias("stretch"),
        F.when(large, -1).otherwise(F.floor(start / step)).cast("long").alias("cell"),
    )


def chat_windows(
    conversations: DataFrame, tokenizer: str, budget: int = BUDGET, step: int = STEP, history: int = HISTORY
) -> DataFrame:
    """``(conv_id, first_turn, n_turns, n_repeated, n_tokens, text, loss)``, a row per window of a conversation.

    Takes ``conversations(conv_id, turn, role, text)``; other columns are not read. ``text`` holds ``n_repeated`` turns
    of earlier windows (the system turn first), then the ``n_turns`` turns from number ``first_turn`` (from 0) on.
    ``loss`` has the places ``(start, end)``, in code points, of the new assistant texts. ``n_tokens`` is above ``budget`` only
    where the system turn and the new turns alone are; turns are never cut.

    Turns are in order of ``turn``, null first; those of one number in an order that depends on role and text alone. A null
    role or text is empty. Only a first turn whose role is ``system`` is retained. A null ``conv_id`` is a conversation like any other,
    repeated rows are turns of their own, and an empty table gives no rows.
    """
    scratch = Scratch(conversations.sparkSession)
    turns = scratch.stored(_turns(conversations, tokenizer, step, scratch), "placed")
    parts = ["at", "start", "tokens", "role", "piece", "text_at", "text_size"]
    span = turns.groupBy("conv_id", "stretch", "cell").agg(F.min("at").alias("first"), F.min("start").alias("from"))
    later = scratch.stored(span.where("first > 0").select(F.col("conv_id").alias("_c"), "first", "from"), "spans")
    is_system = (F.col("at") == 0) & (F.col("role") == SYSTEM)
    # Earlier turns by cells of ``history`` tokens: a cell holds few turns, as each has the tokens of its markers.
    asked = later.withColumn(
        "_cell", F.explode(F.sequence(F.floor((F.col("from") - history) / history), F.floor((F.col("from") - 1) / history)))
    )
    near = (
        F.col("conv_id").eqNullSafe(F.col("_c"))
        & (F.floor(F.col("start") / history) == F.col("_cell"))
        & (F.col("start") >= F.col("from") - history)
        & (F.col("at") < F.col("first"))
    )
    recent = turns.where(~is_system).join(asked, near).select("conv_id", "first", *parts)
    # The system turn goes to as many keys as the conversation has stretches of turns.
    copies = turns.where(is_system).withColumn("_copy", F.explode(F.expr(f"sequence(0L, n_turns div {TURNS_PER_COPY})")))
    of = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_copy") == F.expr(f"first div {TURNS_PER_COPY}"))
    retained = copies.join(later, of).select("conv_id", "first", *parts)
    named = span.select(F.col("conv_id").alias("_c"), F.col("stretch").alias("_s"), F.col("cell").alias("_l"), "first")
    new = turns.join(
        named, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("stretch") == F.col("_s")) & (F.col("cell") == F.col("_l"))
    ).select("conv_id", "first", *parts)
    # A window's turns: less than two steps of new tokens or one turn, at most ``history`` tokens, and the system turn.
    gathered = new.unionByName(recent).unionByName(retained).groupBy("conv_id", "first").agg(
        F.array_sort(F.collect_list(F.struct(*parts))).alias("turns")
    )
    windows = stored(_formatted(gathered, budget), "windows")
    scratch.delete()
    return windows


def _formatted(gathered: DataFrame, budget: int) -> DataFrame:
    first = F.col("first")
    system = lambda t: (t["at"] == 0) & (t["role"] == SYSTEM)
    total = lambda turns: F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + t["tokens"])
    needed = F.filter("turns", lambda t: (t["at"] >= first) | system(t))
    begins = F.element_at(F.filter("turns", lambda t: t["at"] >= first), 1)["start"]
    measured = gathered.withColumns({"needed": total(needed), "begins": begins})
    fits = lambda t: F.col("begins") - t["start"] <= F.lit(budget) - F.col("needed")
    kept = measured.withColumn("kept", F.filter("turns", lambda t: (t["at"] >= first) | system(t) | fits(t)))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

    def passed(done: Column, t: Column) -> Column:
        start = done["at"] + t["text_at"]
        here = F.array(F.struct(start.alias("start"), (start + t["text_size"]).alias("end")))
        learned = (t["at"] >= first) & (t["role"] == LEARNED)
        return F.struct(
            (done["at"] + F.length(t["piece"])).alias("at"),
            F.when(learned, F.concat(done["loss"], here)).otherwise(done["loss"]).alias("loss"),
        )

    repeated = F.size(F.filter("kept", lambda t: t["at"] < first))
    return kept.select(
        "conv_id", F.col("first").alias("first_turn"), (F.size("kept") - repeated).alias("n_turns"), repeated.alias("n_repeated"),
        total(F.col("kept")).alias("n_tokens"),
        F.array_join(F.transform("kept", lambda t: t["piece"]), "").alias("text"),
        F.aggregate("kept", nothing, passed)["loss"].alias("loss"),
    )


def parsed(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of a window, unescaped."""
    for piece in text.split(BEGIN)[1:]:
        role, body = piece[: -len(END)].split("\n", 1)
        yield unescape_role(role), unescape(body)


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(rows: Iterator) -> Iterator:
    import pyarrow as pa

    def result() -> tuple:
        return (now, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), size)

    begun, now, kind = False, None, None
    for batch in batches_of(rows):
        out, kind = [], batch.column("conv_id").type
        for row in batch.to_pylist():
            if not begun or row["conv_id"] != now:
                if begun:
                    out.append(result())
                begun, now = True, row["conv_id"]
                turns, loss, n_turns, loss_chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for nth, (role, text) in enumerate(parsed(row["text"])):
                if nth >= row["n_repeated"]:
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    n_turns += 1
            for span in row["loss"]:
                learned = unescape(row["text"][span["start"] : span["end"]])
                loss.update(learned.encode("utf-8", "surrogatepass"))
                loss_chars += len(learned)
            size += len(row["text"])
        if out:
            yield _digest_batch(pa, out, kind)
    if begun:
        yield _digest_batch(pa, [result()], kind)


def _digest_batch(pa, out: list[tuple], kind):
    types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of every conversation, read from its windows: turns without repeats, and the learned texts end to end.

    A digest runs over its input in order, so the windows of a conversation pass through one task, a batch at a time.
    """
    kind = windows.schema["conv_id"].dataType.simpleString()
    near = windows.select("conv_id", "first_turn", "n_repeated", "text", "loss").repartition("conv_id")
    sorted_ = near.sortWithinPartitions("conv_id", "first_turn")
    return sorted_.mapInArrow(tidy(_digests), f"conv_id {kind}, {DIGESTS}")
