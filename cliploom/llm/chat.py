"""Chat formatting in windows of a token budget.

Turns are marked ``<|im_start|>role\\ntext<|im_end|>\\n``. Prefix sums of their tokens deal a
conversation's turns into spans; a window is a span behind the conversation's system turn and a
limited number of tokens of the turns before the span. The loss mask holds the texts of the
assistant in the span itself, so a repeated target is masked and each counts once.

Inside texts and roles a backslash comes between ``<`` and ``|``, one more than there are, so
formatted text holds ``<|`` in marks only and every text can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliploom.llm.graph import written
from cliploom.llm.words import tool

START, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
_SPAN = ["key", "breaks", "small", "cell"]


@dataclass(frozen=True)
class Settings:
    budget: int = 4096
    #: Tokens of earlier turns that a window repeats at most.
    history: int = 1024

    @property
    def longest_small(self) -> int:
        """A turn of more tokens is a span by itself; spans hold twice as much at least."""
        return max(1, (self.budget - self.history) // 4)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def tokenizer_at(ranks_path: str, pattern: str):
    """The worker's tokenizer, read once for all of its tasks."""
    def read():
        import base64

        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        return tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return tool(("chat", ranks_path, pattern), read)


def marked(conversations: DataFrame) -> DataFrame:
    """Each row with its conversation's key and its marked text; null texts and roles are empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(START), escaped_role(role), F.lit("\n"))
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), F.concat(head, escaped(text), F.lit(END + "\n")).alias("shown"),
        F.length(head).cast("long").alias("from"), F.length(escaped(text)).cast("long").alias("chars"),
    ).withColumn("md5", F.md5("shown"))


def counted(turns: DataFrame, ranks_path: str, pattern: str, settings: Settings) -> DataFrame:
    """``turns``, ordered inside their partitions, with ``tokens`` and, over the rows of their key up to them, the numbers ``n`` of turns, ``sum`` of tokens and ``long`` of long turns."""
    added = ("tokens", "n", "sum", "long")
    schema = turns.select("*").schema
    for name in added:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_at(ranks_path, pattern)
        at, n, total, long = None, 0, 0, 0
        for batch in batches:
            rows = []
            for key, shown in zip(batch.column("key").to_pylist(), batch.column("shown").to_pylist(), strict=True):
                tokens = len(tokenizer.encode_ordinary(shown))
                if key != at:
                    at, n, total, long = key, 0, 0, 0
                n, total, long = n + 1, total + tokens, long + (tokens > settings.longest_small)
                rows.append((tokens, n, total, long))
            columns = zip(*rows, strict=True) if rows else [[]] * len(added)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in columns)], names=[*batch.schema.names, *added])

    return turns.mapInArrow(run, schema)


def placed(turns: DataFrame, ranks_path: str, pattern: str, settings: Settings) -> DataFrame:
    """``turns`` with their tokens, their place in the conversation, the tokens before them and the long turns up to them.

    The rows are range-partitioned by conversation and order, so a conversation of any length
    spreads over slices; a slice adds up its own turns, and totals of a conversation's earlier
    slices are added, fewer rows than there are slices.
    """
    order = ["key", F.asc_nulls_last("turn"), "role", "md5"]
    slices = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id())
    cut = written(counted(dealt, ranks_path, pattern, settings), "chat-turns")
    totals = cut.groupBy("key", "slice").agg(*(F.max(c).alias(c) for c in ("n", "sum", "long")))
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("key", "slice", *(F.sum(c).over(earlier).alias(f"{c}_before") for c in ("n", "sum", "long"))).where("n_before is not null")
    carried = written(carried, "chat-carried")
    n, total, long = (F.col(c) + F.coalesce(f"{c}_before", F.lit(0).cast("long")) for c in ("n", "sum", "long"))
    return cut.join(F.broadcast(carried), ["key", "slice"], "left").select(
        "key", "conv_id", "role", "shown", "from", "chars", "tokens", (n - 1).alias("place"), (total - F.col("tokens")).alias("before"), long.alias("breaks"),
    ).withColumn("system", (F.col("place") == 0) & (F.col("role") == "system"))


def windows(conversations: DataFrame, ranks_path: str, settings: Settings = Settings(), pattern: str | None = None) -> DataFrame:
    """Windows of ``conversations(conv_id, turn, role, text)``.

    Columns: conv_id, first_turn (place of the window's first own turn), text, loss (array of
    ``start, end`` in code points of text), n_turns, n_repeated (leading turns that an earlier
    window has as its own), n_tokens. Turns go by ``turn``, nulls last, then by role and md5 of
    the marked text; repeated rows are turns of their own; null ids are one conversation. The
    system turn is a first turn of that role; it begins every window. Tokens are counted turn by
    turn. A window holds more than ``budget`` tokens only where one turn and the system turn
    alone exceed it. No turn is cut. Texts that a tokenizer splits slowly cost time only. Other
    columns are ignored; an empty table gives no rows.
    """
    if not 0 <= settings.history < settings.budget:
        raise ValueError("history must lie below the budget")
    if pattern is None:
        from public_tokenizers import PATTERN as pattern
    turns = placed(marked(conversations), ranks_path, pattern, settings)
    convs = turns.groupBy("key").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("system"), F.col("tokens"))).alias("system_tokens"), F.max(F.when(~F.col("system"), F.col("tokens"))).alias("longest"),
    ).select("key", "n", F.coalesce("system_tokens", F.lit(0)).alias("system_tokens"), F.col("system_tokens").isNotNull().alias("has_system"), "longest")
    room = F.greatest(F.lit(settings.budget - settings.history) - F.col("system_tokens"), F.lit(2 * settings.longest_small))
    step = room - F.least("longest", F.lit(settings.longest_small))  # a span begins in its cell and ends one small turn behind it at most
    small = F.col("tokens") <= settings.longest_small
    dealt = turns.where(~F.col("system")).join(convs.select("key", "has_system", "system_tokens", step.alias("step")), "key").select(
        "key", "conv_id", "role", "shown", "from", "chars", "tokens", "place", "before", "breaks", small.alias("small"),
        F.when(small, F.floor(F.col("before") / F.col("step"))).otherwise(F.lit(-1)).cast("long").alias("cell"), "has_system", "system_tokens",
    )
    spans = written(dealt.groupBy(*_SPAN).agg(
        F.min("place").alias("first_turn"), F.min("before").alias("start"), F.sum("tokens").alias("own"), F.first("has_system").alias("has_system"),
        F.first("system_tokens").alias("system_tokens"),
    ), "chat-spans")
    own = dealt.select(*_SPAN, "conv_id", "place", F.lit(False).alias("repeated"), "role", "shown", "from", "chars", "tokens")
    columns = [*_SPAN, "conv_id", "place", "repeated", "role", "shown", "from", "chars", "tokens"]
    systems = turns.where("system").select("key", "conv_id", "place", "role", "shown", "from", "chars", "tokens")
    retained = spans.where("has_system").select(*_SPAN, (F.col("first_turn") > 1).alias("repeated")).join(systems, "key").select(*columns)
    lonely = systems.join(convs.where("n = 1"), "key").select(
        "key", F.lit(0).cast("long").alias("breaks"), F.lit(True).alias("small"), F.lit(0).cast("long").alias("cell"), "conv_id", "place", F.lit(False).alias("repeated"), "role", "shown", "from", "chars", "tokens",
    )
    members = own.union(retained).union(lonely)
    if settings.history:
        reach = F.greatest(F.lit(0), F.least(F.lit(settings.history), F.lit(settings.budget) - F.col("system_tokens") - F.col("own")))
        asking = spans.select(*_SPAN, "start", reach.alias("reach")).where("reach > 0 and start > 0")
        least = F.greatest(F.lit(0), F.floor((F.col("start") - F.col("reach")) / settings.history))
        asking = asking.withColumn("bucket", F.explode(F.sequence(least, F.floor((F.col("start") - 1) / settings.history))))
        past = turns.where(~F.col("system")).withColumn("bucket", F.floor(F.col("before") / settings.history)).drop("breaks")
        near = past.join(asking, ["key", "bucket"]).where((F.col("before") + F.col("tokens") <= F.col("start")) & (F.col("before") >= F.col("start") - F.col("reach")))
        members = members.union(near.withColumn("repeated", F.lit(True)).select(*columns))
    item = F.struct("place", "repeated", "role", "shown", F.length("shown").cast("long").alias("length"), "from", "chars", "tokens")
    whole = members.groupBy(*_SPAN).agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(item)).alias("turns"))  # bounded by the budget
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))

    def add(state: Column, turn: Column) -> Column:
        first = state["at"] + turn["from"]
        span = F.array(F.struct(first.alias("start"), (first + turn["chars"]).alias("end")))
        target = (turn["role"] == "assistant") & ~turn["repeated"]
        return F.struct((state["at"] + turn["length"]).alias("at"), F.when(target, F.concat(state["loss"], span)).otherwise(state["loss"]).alias("loss"))

    loss = F.aggregate("turns", start, add)["loss"]
    return whole.select(
        "conv_id", F.array_min(F.transform(F.filter("turns", lambda t: ~t["repeated"]), lambda t: t["place"])).alias("first_turn"),
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("text"), loss.alias("loss"), F.size("turns").alias("n_turns"),
        F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"), F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("n_tokens"),
    )


def read_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of formatted text."""
    return [(unescaped_role(role), unescaped(said)) for role, said in _TURN.findall(text)]


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what the windows give back: turns, the text under the loss mask, and characters.

    A digest follows a conversation's windows in order, so these pass one task, one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        done: list[tuple] = []
        n, turns, loss_chars, loss, chars = 0, hashlib.sha256(), 0, hashlib.sha256(), 0

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )
            done.clear()
            return batch

        for batch in batches:
            for row in batch.to_pylist():
                if at is None or row["conv_id"] != at[0]:
                    if at is not None:
                        done.append((at[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    at = (row["conv_id"],)
                    n, turns, loss_chars, loss, chars = 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                own = read_turns(row["text"])[row["n_repeated"] :]
                n += len(own)
                chars += len(row["text"])
                turns.update("".join(f"{role}\n{said}\n" for role, said in own).encode())
                for span in row["loss"]:
                    target = unescaped(row["text"][span["start"] : span["end"]])
                    loss_chars += len(target)
                    loss.update(target.encode())
            if done:
                yield flushed()
        if at is not None:
            done.append((at[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            yield flushed()

    ordered = formatted.select("conv_id", "first_turn", "text", "loss", "n_repeated").repartition("conv_id").sortWithinPartitions("conv_id", "first_turn")
    return ordered.mapInArrow(run, DIGESTS)
