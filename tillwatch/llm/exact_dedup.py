"""Exact deduplication by sorting contents.

Sampled splitters cut texts (and, within equal texts, identifiers) into ranges,
each task sorts its range on disk, and equal texts then stand side by side: every
text is compared in full with the one before it. As identifiers take part in the
ranges, a text with very many copies spreads over several tasks. Runs of equal
texts that cross a task's border are joined up from the border rows, one or two
for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillwatch.llm.text import written

FIRST, LAST = 1, 2
RUN = T.StructType(
    [
        T.StructField("text_sha256", T.StringType()),
        T.StructField("keep_id", T.LongType()),
        T.StructField("group_size", T.LongType()),
        T.StructField("lead", T.BooleanType()),
        T.StructField("task", T.IntegerType()),
        T.StructField("edge", T.IntegerType()),
        T.StructField("edge_text", T.StringType()),
    ]
)


def content_sort(
    docs: DataFrame, keep: str = "min", normalised=None, prefix: str = "", texts: bool = True
) -> DataFrame:
    """All columns of `docs` and, with `prefix`: keep_id, group_size, kept, text_sha256.

    Of rows with equal texts the one with the smallest (`keep="min"`) or largest
    (`"max"`) `doc_id` is kept. `normalised` maps the text column to what is compared
    (default: no change); a null counts as empty. Exactly one row of a group is kept,
    also where ids repeat; null ids count as last choice, and `keep_id` is null only
    if a group has no other. An empty table gives no rows. The hash is of the
    normalised text in UTF-8. `texts=False` leaves out the text column.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    names = [f"{prefix}{n}" for n in ("keep_id", "group_size", "kept", "text_sha256")]
    if clash := {c.lower() for c in docs.columns} & {n.lower() for n in names}:
        raise ValueError(f"choose another prefix: {sorted(clash)} are taken")
    text = F.col("text").cast("string")
    body = F.coalesce(normalised(text) if normalised else text, F.lit(""))
    apart = normalised is None  # the compared text itself then serves as the text column
    others = [f"`{c}`" for c in docs.columns if c != "text" or (texts and not apart)]
    rows = docs.select(
        F.struct(*others).alias("row"),
        text.isNull().alias("no_text"),
        F.col("doc_id").cast("long").alias("id"),
        body.alias("body"),
    )
    order = F.col("id").asc_nulls_last() if keep == "min" else F.col("id").desc_nulls_last()
    ranged = rows.repartitionByRange("body", order).sortWithinPartitions("body", order)
    kept_columns = ranged if texts and apart else ranged.drop("body")
    schema = T.StructType([*kept_columns.schema.fields, *RUN.fields])
    runs = written(ranged.mapInArrow(lambda x: _runs(x, schema.names), schema), "content-sort")
    joined = runs.drop("edge_text").join(F.broadcast(_borders(runs, keep)), ["task", "edge"], "left")
    columns = [
        F.when(~F.col("no_text"), F.col("body")).alias("text") if c == "text" and apart else F.col(f"row.`{c}`")
        for c in docs.columns
        if c != "text" or texts
    ]
    # An edge run that goes on in another task takes the figures of the whole run.
    return joined.select(
        *columns,
        F.coalesce("whole_id", "keep_id").alias(names[0]),
        F.coalesce("whole_size", "group_size").alias(names[1]),
        (F.col("lead") & F.coalesce("whole_lead", F.lit(True))).alias(names[2]),
        F.col("text_sha256").alias(names[3]),
    )


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted task.

    Batches wait until the run at their end is closed; that is one batch, or the
    part of a large group of copies that fell into this task.
    """
    task = TaskContext.get().partitionId()
    closed: dict[int, tuple] = {}  # run: hash, first identifier, size, edge, text if at an edge
    waiting: list[tuple[pa.RecordBatch, list[int], list[bool]]] = []
    current: str | None = None
    number, size, keep_id = -1, 0, None

    def close(last: bool) -> None:
        edge = (FIRST if number == 0 else 0) | (LAST if last else 0)
        digest = hashlib.sha256(current.encode()).hexdigest()
        closed[number] = digest, keep_id, size, edge, current if edge else None

    def flush(done: int) -> Iterator[pa.RecordBatch]:
        for batch, numbers, leads in waiting:
            if not numbers:
                continue
            found = [closed[n] for n in numbers]
            digests, ids, sizes, edges, texts = zip(*found, strict=True)
            edge_texts = [t if lead else None for t, lead in zip(texts, leads, strict=True)]
            columns = digests, ids, sizes, leads, [task] * len(found), edges, edge_texts
            kinds = pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.string()
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            own = [batch.column(n) for n in names if n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*own, *arrays], names)
        waiting.clear()
        for n in [n for n in closed if n < done]:
            del closed[n]

    for batch in batches:
        numbers, leads = [], []
        for text, doc_id in zip(batch.column("body").to_pylist(), batch.column("id").to_pylist(), strict=True):
            lead = text != current
            if lead:
                if number >= 0:
                    close(False)
                    if waiting:  # they end with the run that was closed just now, at the latest
                        yield from flush(number)
                current, size, keep_id = text, 0, doc_id
                number += 1
            size += 1
            numbers.append(number)
            leads.append(lead)
        waiting.append((batch, numbers, leads))
    if number >= 0:
        close(True)
    yield from flush(number)


def _borders(runs: DataFrame, keep: str) -> DataFrame:
    """For each edge run (task, edge): identifier, size and leading task of the whole run.

    There are at most two rows a task. Neighbours are compared by their full texts;
    only the numbers go through the window over all tasks.
    """
    edges = runs.filter("edge > 0 and lead").select("task", "edge", "keep_id", "group_size", "edge_text")
    place = Window.orderBy("task", "edge")
    numbered = edges.select("task", "edge").withColumn("at", F.row_number().over(place))
    placed = edges.join(numbered, ["task", "edge"])
    before = placed.select((F.col("at") + 1).alias("at"), F.col("edge_text").alias("before_text"))
    linked = placed.join(before, "at", "left").select(
        "task", "edge", "keep_id", "group_size", "at",
        F.coalesce(F.col("edge_text") == F.col("before_text"), F.lit(False)).alias("linked"),
    )
    chain = F.sum(F.when(F.col("linked"), 0).otherwise(1)).over(Window.orderBy("at"))
    chained = linked.withColumn("chain", chain)
    whole = chained.groupBy("chain").agg(
        (F.min if keep == "min" else F.max)("keep_id").alias("whole_id"),
        F.sum("group_size").alias("whole_size"),
        F.min("at").alias("first"),
    )
    return chained.join(whole, "chain").select(
        "task", "edge", "whole_id", "whole_size", (F.col("at") == F.col("first")).alias("whole_lead")
    )
