"""Sums of every grouping shape from keyed window rows.

``rows`` are window rows, or rows merged earlier: a stream's closed windows or
panes have the same columns. The plan is three shuffles deep:

1. window rows to *fine* sums: conversations by DSCP, and each endpoint by
   DSCP and name;
2. fine conversations to the shapes above them, fine hosts to the two host
   shapes;
3. the ranking, which moves at most K rows per task and parent.

The branches of step 2 read one and the same shuffle of step 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netrill.operators.aggregate import BASE_COLUMNS, VALUES, sum_by, sum_shapes
from netrill.plans import groupings as G
from netrill.schema import CONVERSATION_COLUMNS, EXPORTER_COLUMNS

CONVERSATIONS, FIRST_HOSTS, SECOND_HOSTS = "conversations", "first_hosts", "second_hosts"
RANKED = "ranked"
KEY_COLUMNS = (*BASE_COLUMNS, "dscp", *CONVERSATION_COLUMNS)


def leaf_sums(rows: DataFrame) -> DataFrame:
    """Sums by the finest key, with the smallest name of each endpoint."""
    return sum_by(rows, KEY_COLUMNS[1:], ("hostname", "hostname2"))


def _own(shape: str) -> list[str]:
    """Columns of a shape besides exporter and interface."""
    return [name for name in G.GROUPINGS[shape].columns if name not in BASE_COLUMNS]


def _conversation_shapes(wanted: Sequence[str]) -> list[str]:
    return [
        name for name in wanted if not G.GROUPINGS[name].is_host and name != G.TOS_CONVERSATION
    ]


def fine_sums(
    rows: DataFrame, with_conversations: bool, with_hosts: bool, rankable: Column
) -> DataFrame:
    """Step 1. Whether a conversation takes part in rankings travels as a flag:

    filtering by its key columns would be pushed below the shuffle, in one
    branch only, and the branches could no longer share it.
    """
    shapes: dict[str, list[str]] = {}
    if with_conversations:
        shapes[CONVERSATIONS] = ["dscp", *CONVERSATION_COLUMNS]
    if with_hosts:
        shapes[FIRST_HOSTS] = ["dscp", "address", "hostname"]
        shapes[SECOND_HOSTS] = ["dscp", "larger_address", "hostname2"]
    marked = rows.withColumn(RANKED, rankable)
    return sum_shapes(marked, BASE_COLUMNS, shapes, "piece", flags=[RANKED])


def host_pieces(fine: DataFrame) -> DataFrame:
    """Both endpoints' sums as ``address`` and ``hostname``."""
    second = F.col("piece") == SECOND_HOSTS
    return fine.filter(F.col("piece").isin(FIRST_HOSTS, SECOND_HOSTS)).select(
        *BASE_COLUMNS,
        "dscp",
        F.when(second, F.col("larger_address")).otherwise(F.col("address")).alias("address"),
        F.when(second, F.col("hostname2")).otherwise(F.col("hostname")).alias("hostname"),
        *VALUES,
        RANKED,
    )


def _aligned(sums: DataFrame, shape: str | None = None) -> DataFrame:
    """The common columns of all shapes, null where a shape has none."""
    if shape is not None:
        sums = sums.withColumn("grouped_by", F.lit(shape))
    present = set(sums.columns)
    types = {"protocol": "int", "dscp": "int", "if_index": "int"}
    columns = []
    for name in ("grouped_by", *KEY_COLUMNS, "hostname", *VALUES, RANKED):
        if name in present:
            columns.append(F.col(name))
        else:
            columns.append(F.lit(None).cast(types.get(name, "string")).alias(name))
    return sums.select(*columns)


def shape_sums(
    rows: DataFrame, wanted: Sequence[str] = G.EMITTED, rankable: Column | None = None
) -> DataFrame:
    """Unlimited sums of the wanted shapes, one row per shape, window and key.

    ``rankable`` is a condition on conversation keys, noted in the ``ranked``
    column of the conversation shapes; it is true for all others.

    Spark gives every repeated use of ``fine`` in a union new column ids, but
    not the first, and compares plans by them. The empty first part, which the
    optimizer removes, makes all real parts repeated uses, so that they are
    seen to share one shuffle.
    """
    rankable = F.lit(True) if rankable is None else rankable
    hosts = [name for name in wanted if G.GROUPINGS[name].is_host]
    above = _conversation_shapes(wanted)
    parts: list[DataFrame] = []
    readers = (G.TOS_CONVERSATION in wanted) + bool(above) + bool(hosts)
    needs_leaf = G.TOS_CONVERSATION in wanted or G.CONVERSATION in wanted
    fine = None
    if needs_leaf or hosts:
        fine = fine_sums(rows, needs_leaf, bool(hosts), rankable)
        if readers > 1:
            parts.append(_aligned(fine.filter(F.lit(False)), G.TOS_CONVERSATION))
    if needs_leaf:
        conversations = fine.filter(F.col("piece") == CONVERSATIONS)
        if G.TOS_CONVERSATION in wanted:
            parts.append(_aligned(conversations, G.TOS_CONVERSATION))
    else:
        conversations = rows.withColumn(RANKED, F.lit(True))
    if above:
        base = list(BASE_COLUMNS)
        if G.EXPORTER in above:
            base.remove("if_index")
        shapes = {name: [c for c in G.GROUPINGS[name].columns if c not in base] for name in above}
        parts.append(_aligned(sum_shapes(conversations, base, shapes, "grouped_by", flags=[RANKED])))
    if hosts:
        shapes = {name: _own(name) for name in hosts}
        merged = sum_shapes(
            host_pieces(fine), BASE_COLUMNS, shapes, "grouped_by", ["hostname"], [RANKED]
        )
        parts.append(_aligned(merged))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    conversation_names = [name for name in wanted if G.GROUPINGS[name].is_conversation]
    return result.withColumn(
        RANKED, F.col(RANKED) | ~F.col("grouped_by").isin(*conversation_names)
    )
