"""Conversation prefix trie: burst tries over turn ids.

A conversation is the sequence of its turns' ids. Equal sequences are one
class. Trie heads hold containers of suffixes: what follows the head's prefix
in the classes that have it. An oversized container bursts: the suffixes move
on by their next turn to containers below new heads, one job for all
containers of a depth. What is left fits into a task: a container's suffixes
are sorted there and swept, with a stack of open nodes, into nodes. Sums over
subtrees come back from containers to heads, depth by depth.

Only ids, lengths and numbers move after the first step; texts are read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderspark.llm.common import TASK_ROWS
from larderspark.session import cut_lineage

#: Turns that a container may hold; larger ones of two classes or more burst.
CONTAINER_TURNS = 20_000
#: Conversation ids that are joined to one text at a time.
CHUNK_IDS = 1_000
#: Lead turns that ``rebuild`` takes over, at most, and conversations that share a lead.
MOST_LEAD, SHARED = 5, 100
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = "conv long, depth long, parent_conv long, n_convs long, n_children long, n_leaves long, saved long, end long"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, k1, k2, chars): the turns of every conversation, numbered from 0, by 128-bit id and code points.

    Null role or text is empty. The order is by turn, null first, then (equal
    turns) by the turn's id, so it does not depend on partitions. Rows without
    a conversation id are left out. Numbers come from one range-partitioned
    sort of narrow rows and counts per partition, so a conversation need not
    fit into a task.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = cut_lineage(
        conversations.filter("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv"), "turn",
            F.xxhash64(F.lit(1), role, text).alias("k1"), F.xxhash64(F.lit(2), text, role).alias("k2"),
            F.length(text).cast("long").alias("chars")),
        "turns",
    )
    placed = cut_lineage(
        turns.orderBy("conv", F.asc_nulls_first("turn"), "k1", "k2").withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33)).drop("turn"),
        "placed",
    )
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("conv", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    shift = parts.select("conv", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")).alias("shift"))
    return cut_lineage(
        placed.join(shift, ["conv", "part"]).select("conv", (F.col("at") + F.col("shift")).alias("pos"), "k1", "k2", "chars"),
        "ordered",
    )


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members): conversations with a lead of another one of their hundred, and all conversation ids.

    Conversation c takes the first h turns of conversation c - c % 100 (fewer
    if it has fewer, none if there is none), h = crc32(decimal c) % 6, and
    drops its own first h.
    """
    convs = turns.groupBy("conv").agg(F.count("*").alias("n")).withColumns({
        "donor": F.col("conv") - F.col("conv") % SHARED,
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_LEAD + 1),
    })
    convs = cut_lineage(convs, "conversations")
    donors = convs.select(F.col("conv").alias("donor"), F.col("n").alias("donor_n"))
    leads = convs.join(donors, "donor", "left").select(
        "conv", "donor", "h", F.least("h", F.coalesce("donor_n", F.lit(0))).alias("lead"))
    own = turns.join(leads.drop("donor"), "conv").filter("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("lead")).alias("pos"), "k1", "k2", "chars")
    lent = turns.filter((F.col("conv") % SHARED == 0) & (F.col("pos") < MOST_LEAD)).withColumnRenamed("conv", "donor")
    taken = lent.join(leads.select("conv", "donor", "h"), "donor").filter("pos < h").select("conv", "pos", "k1", "k2", "chars")
    return cut_lineage(own.unionByName(taken), "rebuilt"), convs.select("conv")


def classes_of(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members with their class ``rep``, classes): equal sequences are a class, named by the least id.

    A sequence's identity is its length and two 64-bit sums (xor) of digests
    of (number, id) of its turns, gathered map-side: no sequence is collected.
    """
    mark = lambda n: F.bit_xor(F.xxhash64(F.lit(n), "pos", "k1", "k2"))
    each = turns.groupBy("conv").agg(F.count("*").alias("n"), mark(1).alias("x1"), mark(2).alias("x2"))
    held = cut_lineage(members.join(each, "conv", "left").fillna(0), "members")
    classes = cut_lineage(
        held.groupBy("n", "x1", "x2").agg(F.min("conv").alias("rep"), F.count("*").alias("times")), "classes")
    repeated = held.join(classes.filter("times > 1"), ["n", "x1", "x2"]).select("rep", "conv")
    return repeated, classes.select(F.col("rep").alias("conv"), "n", "times")


def runs_by(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups, in order, of rows that come sorted by ``keys``; several groups may come together."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        same = (batch[keys] == batch[keys].iloc[-1]).all(axis=1).to_numpy()
        start = len(batch) - int(same[::-1].argmin() if not same.all() else len(batch))
        if start:
            yield pd.concat([*held, batch.iloc[:start]], ignore_index=True)
            held = []
        elif held and (held[-1][keys].iloc[-1] != batch[keys].iloc[0]).any():
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(batch.iloc[start:])
    if held:
        yield pd.concat(held, ignore_index=True)


def id_digests(repeated: DataFrame) -> DataFrame:
    """(rep, sha): SHA-256 of each class's ids, ascending, comma-joined.

    Ids are sorted over all tasks and joined to chunks there; per class the
    chunks, a thousandth of the rows, are then hashed as they stream by.
    """

    def chunks(batches):
        for batch in batches:
            for rep, part in batch.groupby("rep", sort=False):
                ids = part["conv"].tolist()
                rows = [(rep, ids[at], ",".join(map(str, ids[at : at + CHUNK_IDS]))) for at in range(0, len(ids), CHUNK_IDS)]
                yield pd.DataFrame(rows, columns=["rep", "first", "part"])

    def digests(batches):
        state, now = None, None
        for batch in batches:
            out = []
            for rep, part in zip(batch["rep"].tolist(), batch["part"].tolist()):
                if rep != now:
                    if state:
                        out.append((now, state.hexdigest()))
                    state, now = hashlib.sha256(part.encode()), rep
                else:
                    state.update(b"," + part.encode())
            yield pd.DataFrame(out, columns=["rep", "sha"])
        if state:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["rep", "sha"])

    parts = repeated.repartitionByRange("rep", "conv").sortWithinPartitions("rep", "conv")
    joined = parts.mapInPandas(chunks, "rep long, first long, part string")
    return joined.repartition("rep").sortWithinPartitions("rep", "first").mapInPandas(digests, "rep long, sha string")


def sweep(rows: list[tuple], head: int, depth: int) -> tuple[list[list], tuple[int, int, int]]:
    """Nodes below a head, and the head's (children, leaves, saved code points below).

    ``rows``: (conv, times, [(k1, k2)], [code points]) per suffix, distinct.
    Nodes are (conv, depth, parent_conv, n_convs, n_children, n_leaves, saved,
    end): ``end`` is the class that ends there. Sorted suffixes share their
    beginnings with the one before, whose nodes are on the stack.
    """
    CONV, DEPTH, PARENT, CONVS, CHILDREN, LEAVES, SAVED, END, CHARS = range(9)
    top = [head, depth, None, 0, 0, 0, 0, None, 0]
    stack, nodes, before = [top], [], []

    def close():
        node = stack.pop()
        node[LEAVES] = node[LEAVES] or 1
        node[SAVED] += (node[CONVS] - 1) * node[CHARS]
        up = stack[-1]
        up[CONV] = min(up[CONV], node[CONV])
        up[CONVS] += node[CONVS]
        up[CHILDREN] += 1
        up[LEAVES] += node[LEAVES]
        up[SAVED] += node[SAVED]
        node[PARENT] = up
        nodes.append(node)

    for conv, times, ids, chars in sorted(rows, key=lambda r: r[2]):
        shared = 0
        while shared < len(before) and shared < len(ids) and before[shared] == ids[shared]:
            shared += 1
        while len(stack) > shared + 1:
            close()
        for at in range(shared, len(ids)):
            stack.append([conv, depth + at + 1, None, 0, 0, 0, 0, None, chars[at]])
        end = stack[-1]
        end[CONV], end[CONVS], end[END] = min(end[CONV], conv), end[CONVS] + times, conv
        before = ids
    while len(stack) > 1:
        close()
    return (
        [[n[CONV], n[DEPTH], n[PARENT][CONV], n[CONVS], n[CHILDREN], n[LEAVES], n[SAVED], n[END]] for n in nodes],
        (top[CHILDREN], top[LEAVES], top[SAVED]),
    )


def swept(suffixes: DataFrame) -> DataFrame:
    """NODE columns and (c1, c2): the nodes of all containers, and per container a row without ``conv`` for its head.

    ``suffixes``: (c1, c2, head, depth, conv, times, pos, k1, k2, chars). Rows
    are dealt by container and stream by in order; one container is held at a time.
    """
    keys = ["c1", "c2", "head", "depth"]

    def work(batches):
        for groups in runs_by(batches, keys):
            out = []
            for (c1, c2, head, depth), part in groups.groupby(keys, sort=False):
                rows = []
                for conv, one in part.groupby("conv", sort=False):
                    rows.append((int(conv), int(one["times"].iloc[0]), list(zip(one["k1"], one["k2"])), one["chars"].tolist()))
                nodes, below = sweep(rows, int(head), int(depth))
                out += [(*n, c1, c2) for n in nodes]
                out.append((None, depth, None, None, *below, None, c1, c2))
            columns = [c.split()[0] for c in NODE.split(", ")] + ["c1", "c2"]
            yield pd.DataFrame(out, columns=columns).astype({c: "Int64" for c in columns})

    shuffle = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffle, -(-suffixes.count() // TASK_ROWS))
    dealt = suffixes.repartition(parts, "c1", "c2").sortWithinPartitions(*keys, "conv", "pos")
    return dealt.mapInPandas(work, f"{NODE}, c1 long, c2 long")


def chains(turns: DataFrame, single: DataFrame) -> DataFrame:
    """NODE columns and (c1, c2) as in ``swept``, for containers of one class: a chain needs no sorting."""
    rows = turns.join(single, "conv").filter("pos >= depth")
    onward = Window.partitionBy("conv").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("pos") + 1 == F.col("n")

    def nodes(rows: DataFrame, saved: Column) -> DataFrame:
        return rows.select(
            "conv", (F.col("pos") + 1).alias("depth"),
            F.when(F.col("pos") == F.col("depth"), F.col("head")).otherwise(F.col("conv")).alias("parent_conv"),
            F.col("times").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"), saved.alias("saved"), F.when(last, F.col("conv")).alias("end"),
            F.lit(None).cast("long").alias("c1"), F.lit(None).cast("long").alias("c2"))

    once = nodes(rows.filter("times = 1"), F.lit(0).cast("long"))
    more = nodes(rows.filter("times > 1"), (F.col("times") - 1) * F.sum("chars").over(onward))
    none, one = F.lit(None).cast("long"), F.lit(1).cast("long")
    heads = rows.groupBy("c1", "c2").agg(
        F.max("depth").alias("depth"), F.sum((F.col("times") - 1) * F.col("chars")).alias("saved"))
    heads = heads.select(
        none.alias("conv"), "depth", none.alias("parent_conv"), none.alias("n_convs"), one.alias("n_children"),
        one.alias("n_leaves"), "saved", none.alias("end"), "c1", "c2")
    return once.unionByName(more).unionByName(heads)


def trie(turns: DataFrame, members: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame | None:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node.

    ``turns`` as from ``ordered_turns``, ``members`` (conv) all conversations,
    those without a turn too. A node is a sequence of first turns that some
    conversation has, from the root (none); its id is its smallest member's
    and its depth. A job per depth down to the deepest oversized container.
    None without members.
    """
    repeated, classes = classes_of(turns, members)
    zero = F.lit(0).cast("long")
    root = cut_lineage(classes.agg(
        F.min("conv").alias("conv"), F.sum("times").alias("n_convs"), F.sum("n").alias("turns"),
        F.count("*").alias("classes"), F.max(F.when(F.col("n") == 0, F.col("conv"))).alias("end"),
    ).select(
        zero.alias("c1"), zero.alias("c2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
        F.lit(None).cast("long").alias("parent_conv"), "conv", "n_convs", zero.alias("chars"), "turns", "classes", "end"),
        "heads")
    top = root.first()
    if top["conv"] is None:
        return None
    kind_of = F.when(F.col("classes") == 1, "chain").when(F.col("turns") > container_turns, "burst").otherwise("sweep")
    heads, resting = [root], []
    at, kinds = classes.withColumns({"c1": zero, "c2": zero}), None
    while True:
        depth = len(heads) - 1
        # what every class's container is: one that bursts, one to be swept, a chain
        if kinds is None:
            first = {"head": F.lit(top["conv"]), "classes": F.lit(top["classes"]), "turns": F.lit(top["turns"])}
            placed = at.withColumns(first).withColumn("kind", kind_of).drop("classes", "turns")
        else:
            placed = at.join(kinds, ["c1", "c2"])
        placed = cut_lineage(placed.filter(F.col("n") > depth).withColumn("depth", F.lit(depth).cast("long")), "containers")
        resting.append(placed.filter("kind <> 'burst'"))
        bursting = placed.filter("kind = 'burst'")
        if bursting.isEmpty():
            break
        key = lambda n: F.xxhash64(F.lit(n), "p1", "p2", "k1", "k2")
        at = cut_lineage(
            bursting.withColumnsRenamed({"c1": "p1", "c2": "p2", "head": "parent_conv"}).drop("kind", "depth")
            .join(turns.filter(F.col("pos") == depth).drop("pos"), "conv")
            .withColumns({"c1": key(1), "c2": key(2)}).drop("k1", "k2"),
            "burst",
        )
        ends = F.max(F.when(F.col("n") == depth + 1, F.col("conv")))
        heads.append(cut_lineage(
            at.groupBy("c1", "c2", "p1", "p2", "parent_conv").agg(
                F.min("conv").alias("conv"), F.sum("times").alias("n_convs"), F.max("chars").alias("chars"),
                F.sum(F.col("n") - depth - 1).alias("turns"), F.count("*").alias("classes"), ends.alias("end")),
            "heads"))
        at = at.select("conv", "n", "times", "c1", "c2")
        kinds = heads[-1].select("c1", "c2", F.col("conv").alias("head"), kind_of.alias("kind"))
    rest = resting[0]
    for more in resting[1:]:
        rest = rest.unionByName(more)
    rest = cut_lineage(rest, "resting")
    suffixes = rest.filter("kind = 'sweep'").drop("kind", "n").join(turns, "conv").filter("pos >= depth")
    below = cut_lineage(
        swept(cut_lineage(suffixes, "suffixes")).unionByName(chains(turns, rest.filter("kind = 'chain'").drop("kind"))), "nodes")

    totals = below.filter("conv is null").select("c1", "c2", "depth", "n_children", "n_leaves", "saved")
    nodes, lower = below.filter("conv is not null").drop("c1", "c2"), None
    for depth in range(len(heads) - 1, -1, -1):
        known = totals.filter(F.col("depth") == depth).drop("depth")
        known = known if lower is None else known.unionByName(lower)
        level = heads[depth].join(known, ["c1", "c2"], "left").fillna({"n_children": 0, "n_leaves": 1, "saved": 0})
        level = cut_lineage(
            level.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("chars"))
            .withColumn("depth", F.lit(depth).cast("long")), "totals")
        lower = level.groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(
            F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        nodes = nodes.unionByName(level.select(*nodes.columns))
    multiple = id_digests(repeated).withColumnRenamed("rep", "end")
    ended = nodes.filter("end is not null").join(multiple, "end", "left").withColumn(
        "sha", F.coalesce("sha", F.sha2(F.col("end").cast("string").cast("binary"), 256)))
    passed = nodes.filter("end is null").withColumn("sha", F.lit(EMPTY_SHA))
    return ended.unionByName(passed).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, rebuilt: bool = False, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The trie of (conv_id, turn, role, text), columns as in ``trie``; ``rebuilt``: after ``rebuild``.

    Turns are equal if role and text are (null is empty). Repeated rows are
    repeated turns; equal turn numbers go by the turns' ids. Rows without
    a conversation id belong to none. An empty table has no node, not even a root.
    """
    turns = ordered_turns(conversations.select("conv_id", "turn", "role", "text"))
    turns, members = rebuild(turns) if rebuilt else (turns, turns.select("conv").distinct())
    found = trie(turns, members, container_turns)
    if found is None:
        schema = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                  "saved_tokens long, ends_sha256 string")
        return conversations.sparkSession.createDataFrame([], schema)
    return found
