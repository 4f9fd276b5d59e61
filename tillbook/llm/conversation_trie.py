"""Prefix trie of conversations with totals over subtrees, by centroid decomposition of its parent edges.

A node is a distinct sequence of first turns. Turns become digests once, so texts are not shuffled; the digest of a prefix is
chained over blocks of BLOCK turns (first inside the blocks, then over them), so a conversation of any length spreads over
tasks. A node is named by its owner, the least conversation that begins with it, and its depth: the conversation that
owns a node passes through all nodes above it, so (conversation, depth) -> owner answers every question about ancestors by
an equi-join.

Totals: as long as a component weighs more than `local_weight` (visits of its nodes by conversations), Spark finds its
centroid, the deepest node that holds at least half of the weight; sums what lies at and below the centroid; adds that sum
to the nodes on the path from the centroid to the component's top; and splits the component at the centroid into the
subtrees of its children and the rest above. Every round halves the weights, so there are at most log2 of them, for
chains and stars alike. Smaller components are decomposed the same way inside a task, one at a time.

Defined cases: turns in ascending order, null first, equal ones in the order of the digest of role and text; null role or
text is empty; rows without a conv_id are left out; repeated rows are turns of their own; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.operators.scale import broadcast_if_small, numbered
from tillbook.session import pin

BLOCK = 1024
LOCAL_WEIGHT = 50_000
IDS = 4096

ROOT = bytes(16)
NODE = ["owner", "depth"]
TOP = ["top_owner", "top_depth"]


# ---------------------------------------------------------------- turns
def sequences(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, pos (from 1), digest and chars of every turn."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256), 1, 32))
    turns = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), F.char_length(said).cast("long").alias("chars")
    )
    placed = numbered(pin(turns, "turns"), ["conv"], ["turn", "digest"], "pos")
    return pin(placed.select("conv", F.col("pos").cast("long").alias("pos"), "digest", "chars"), "sequences")


def with_shared_heads(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Sequences whose first h turns are those of the first conversation of their family, and (conv, len) of all, turnless ones too.

    h is crc32 of the decimal id modulo `most`. A head has fewer than `most` turns, so the join by family stays small.
    """
    h = F.crc32(F.col("conv").cast("string")) % most
    base = F.col("conv") - F.col("conv") % family
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    shape = sizes.withColumns({"h": h, "base": base}).join(bases, "base", "left")
    shape = shape.withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))).cast("long"))
    shape = pin(shape.withColumn("len", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "shape")
    heads = turns.filter(F.col("pos") < most).withColumnRenamed("conv", "base")
    borrowed = shape.select("conv", "base", "h").join(heads, "base").filter("pos <= h").select("conv", "pos", "digest", "chars")
    own = turns.join(shape.select("conv", "h", "k"), "conv").filter("pos > h")
    own = own.select("conv", (F.col("k") + F.col("pos") - F.col("h")).alias("pos"), "digest", "chars")
    return pin(borrowed.unionByName(own), "rebuilt"), shape.select("conv", "len")


# ---------------------------------------------------------------- prefixes
def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chained digest from the start of the block, and the one before it; rows come in the order of their blocks."""
    key, chained = None, b""
    for batch in batches:
        within, before = [], []
        for conv, block, digest in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            before.append(chained if key == (conv, block) else b"")
            key, chained = (conv, block), hashlib.md5(before[-1] + digest).digest()
            within.append(chained)
        columns = [batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array(within, pa.binary()), pa.array(before, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "block", "depth", "chars", "within", "before"])


def _over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chained digest of all blocks before each one but the first; block 1 begins a conversation."""
    carry = ROOT
    for batch in batches:
        carries = []
        for block, total in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            carry = hashlib.md5((ROOT if block == 1 else carry) + total).digest()
            carries.append(carry)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(carries, pa.binary())], ["conv", "block", "carry"])


def _md5(*columns: Column) -> Column:
    return F.unhex(F.md5(F.concat(*columns)))


def prefixes(turns: DataFrame, lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv, depth, id, parent_id, chars, len for every prefix of every conversation, the empty one (depth 0) too."""
    cut = turns.select("conv", F.floor((F.col("pos") - 1) / block).alias("block"), "digest", F.col("pos").alias("depth"), "chars")
    cut = cut.repartition("conv", "block").sortWithinPartitions("conv", "block", "depth")
    chained = pin(cut.mapInArrow(_inside, "conv long, block long, depth long, chars long, within binary, before binary"), "chained")
    totals = chained.filter(F.col("depth") % block == 0).select("conv", (F.col("block") + 1).alias("block"), "within")
    totals = totals.repartition("conv").sortWithinPartitions("conv", "block")
    carries = pin(totals.mapInArrow(_over, "conv long, block long, carry binary"), "carries")
    first = chained.filter("block = 0").withColumn("carry", F.lit(ROOT))
    later = chained.filter("block > 0").join(broadcast_if_small(carries), ["conv", "block"])
    both = first.unionByName(later)
    before = F.when(F.length("before") == 0, F.col("carry")).otherwise(_md5(F.col("carry"), F.col("before")))
    found = both.select("conv", "depth", _md5(F.col("carry"), F.col("within")).alias("id"), before.alias("parent_id"), "chars")
    roots = lengths.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("parent_id"), F.lit(0).cast("long").alias("chars")
    )
    return pin(found.join(lengths, "conv").unionByName(roots.join(lengths, "conv")), "prefixes")


def nodes_of(prefixed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (owner, depth, parent_owner, n_convs, n_children, chars, visits) and visits (conv, depth, owner, next_owner, len).

    visits of a node: how often conversations pass it and the nodes below it.
    """
    found = prefixed.groupBy("depth", "id").agg(
        F.min("conv").alias("owner"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("chars").alias("chars"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("visits"),
    )
    found = pin(found, "trie-nodes")
    owned = prefixed.select("conv", "depth", "id", "len").join(found.select("depth", "id", "owner"), ["depth", "id"])
    owned = pin(owned.select("conv", "depth", "owner", "len"), "owned")
    below = owned.select("conv", (F.col("depth") - 1).alias("depth"), F.col("owner").alias("next_owner"))
    visits = pin(owned.join(below, ["conv", "depth"], "left"), "visits")
    above = owned.select(F.col("conv").alias("owner"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_owner"))
    nodes = pin(found.drop("id").join(above, NODE, "left"), "trie-parents")
    children = nodes.filter("depth > 0").groupBy("parent_owner", (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children.withColumnRenamed("parent_owner", "owner"), NODE, "left").fillna(0, ["n_children"])
    return pin(nodes, "trie"), visits


# ---------------------------------------------------------------- centroid decomposition
def subtree_sums(parents: list[int], leaves: list[int], saved: list[int]) -> tuple[list[int], list[int]]:
    """Sums over the subtrees of one component; parents come before children, the parent of the top is -1."""
    out = [0] * len(parents), [0] * len(parents)
    home = [0] * len(parents)
    number, open_ = 0, [(0, list(range(len(parents))))]
    while open_:
        name, members = open_.pop()
        size = dict.fromkeys(members, 1)
        for i in reversed(members):
            if 2 * size[i] >= len(members):
                centroid = i
                break
            size[parents[i]] += size[i]
        pieces: dict[int, list[int]] = {}
        a, b = leaves[centroid], saved[centroid]
        for i in members:
            if i == centroid:
                home[i] = -1
            elif home[i] == name and parents[i] == centroid:
                number += 1
                home[i], pieces[number] = number, [i]
            elif parents[i] >= 0 and home[i] == name and home[parents[i]] in pieces:
                home[i] = home[parents[i]]
                pieces[home[i]].append(i)
            else:
                continue
            if i != centroid:
                a, b = a + leaves[i], b + saved[i]
        out[0][centroid] += a
        out[1][centroid] += b
        up = parents[centroid]
        while up >= 0 and home[up] == name:
            out[0][up] += a
            out[1][up] += b
            up = parents[up]
        open_.extend(pieces.items())
        rest = [i for i in members if home[i] == name]
        if rest:
            open_.append((name, rest))
    return out


def _in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of all nodes of components that arrive one after the other, nodes from the top down."""
    names = ["owner", "depth", "n_leaves", "saved_tokens"]
    top, rows, done = None, [], []

    def close() -> None:
        if not rows:
            return
        places = {(owner, depth): i for i, (owner, depth, *_) in enumerate(rows)}
        parents = [places.get((parent, depth - 1), -1) for _, depth, parent, *_ in rows]
        sums = subtree_sums(parents, [r[3] for r in rows], [r[4] for r in rows])
        done.extend((r[0], r[1], a + r[5], b + r[6]) for r, a, b in zip(rows, *sums, strict=True))

    for batch in batches:
        for *row, top_owner, top_depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if top != (top_owner, top_depth):
                close()
                top, rows = (top_owner, top_depth), []
            rows.append(row)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done, strict=True)], names)
            done = []
    close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done, strict=True)], names)


def _split(large: DataFrame, visits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over components: (totals of their centroids, nodes of the components that are left)."""
    deepest = F.max_by(F.struct(F.col("owner").alias("c_owner"), F.col("depth").alias("c_depth"), F.col("visits").alias("c_visits")), F.col("depth"))
    centroids = large.filter(2 * F.col("visits") >= F.col("weight")).groupBy(*TOP).agg(deepest.alias("c")).select(*TOP, "c.*")
    centroids = pin(centroids, "centroids")
    under = F.col("depth") >= F.col("c_depth")
    asked = large.join(broadcast_if_small(centroids), TOP).withColumns(
        {"conv": F.when(under, F.col("owner")).otherwise(F.col("c_owner")), "at": F.when(under, F.col("c_depth")).otherwise(F.col("depth"))}
    )
    seen = visits.select("conv", F.col("depth").alias("at"), F.col("owner").alias("through"), "next_owner")
    asked = asked.join(seen, ["conv", "at"]).withColumns(
        {
            "below": under & (F.col("through") == F.col("c_owner")),
            "above": ~under & (F.col("through") == F.col("owner")),
        }
    )
    asked = pin(asked.drop("conv", "at", "through"), "asked")
    held = [F.sum(F.when(F.col("below"), F.col(c))).alias(f"t_{c}") for c in ("leaf", "saved")]
    totals = broadcast_if_small(pin(asked.groupBy(*TOP).agg(*held), "centroid-totals"))
    asked = asked.join(totals, TOP)
    is_centroid = (F.col("depth") == F.col("c_depth")) & (F.col("owner") == F.col("c_owner"))
    done = asked.filter(is_centroid).select(
        *NODE, (F.col("t_leaf") + F.col("leaf_above")).alias("n_leaves"), (F.col("t_saved") + F.col("saved_above")).alias("saved_tokens")
    )
    gained = {f"{c}_above": F.col(f"{c}_above") + F.when(F.col("above"), F.col(f"t_{c}")).otherwise(0) for c in ("leaf", "saved")}
    left = asked.filter(~is_centroid).withColumns(
        gained
        | {
            "visits": F.col("visits") - F.when(F.col("above"), F.col("c_visits")).otherwise(0),
            "top_owner": F.when(F.col("below"), F.col("next_owner")).otherwise(F.col("top_owner")),
            "top_depth": F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")),
        }
    )
    left = pin(left.select(*[c for c in large.columns if c != "weight"]), "components")
    weights = left.groupBy(*TOP).agg(F.max("visits").alias("weight"))
    return done, pin(left.join(weights, TOP).select(*large.columns), "weighted")


def totals_below(nodes: DataFrame, visits: DataFrame, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """owner, depth, n_leaves and saved_tokens of every node."""
    root = nodes.filter("depth = 0").select("owner", "visits").first()
    zero = F.lit(0).cast("long")
    state = nodes.select(
        *NODE,
        "parent_owner",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        zero.alias("leaf_above"),
        zero.alias("saved_above"),
        "visits",
        F.lit(root[0] if root else None).cast("long").alias("top_owner"),
        zero.alias("top_depth"),
        F.lit(root[1] if root else 0).cast("long").alias("weight"),
    )
    # Written, so that the planner does not take the one top for a constant and the join by it for a join without a key.
    state, small, done = pin(state, "trie-state"), [], []
    while True:
        small.append(state.filter(F.col("weight") <= local_weight))
        large = state.filter(F.col("weight") > local_weight)
        if large.isEmpty():
            break
        found, state = _split(large, visits)
        done.append(found)
    ready = reduce(DataFrame.unionByName, small).select(*NODE, "parent_owner", "leaf", "saved", "leaf_above", "saved_above", *TOP)
    ready = ready.repartition(*TOP).sortWithinPartitions(*TOP, "depth")
    local = ready.mapInArrow(_in_task, "owner long, depth long, n_leaves long, saved_tokens long")
    return reduce(DataFrame.unionByName, [local, *done])


# ---------------------------------------------------------------- conversations that end at a node
def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node as texts of at most IDS ids, in order."""
    rows, key, ids = [], None, []

    def close() -> None:
        if ids:
            rows.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for owner, depth, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (owner, depth) or len(ids) == IDS:
                close()
                key, ids = (owner, depth), []
            ids.append(conv)
        if rows:
            yield _columns(rows, ["owner", "depth", "first", "ids"])
            rows = []
    close()
    if rows:
        yield _columns(rows, ["owner", "depth", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of a node's texts in a row, fed piece by piece."""
    key, state = None, None
    for batch in batches:
        rows = []
        for owner, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if key == (owner, depth):
                state.update(b",")
            else:
                if key:
                    rows.append((*key, state.hexdigest()))
                key, state = (owner, depth), hashlib.sha256()
            state.update(ids.encode())
        if rows:
            yield _columns(rows, ["owner", "depth", "ends_sha256"])
    if key:
        yield _columns([(*key, state.hexdigest())], ["owner", "depth", "ends_sha256"])


def _columns(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def end_digests(visits: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256 of nodes at which conversations end: digest of their ids, ascending and comma-joined.

    Ids are sorted and joined by ranges, so that copies of one conversation spread over tasks; the last step, which a digest
    over all of them cannot avoid, reads one row for IDS ids.
    """
    ends = pin(visits.filter("depth = len").select(*NODE, "conv"), "ends")
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ends.repartitionByRange(parts, *NODE, "conv").sortWithinPartitions(*NODE, "conv")
    texts = ranges.mapInArrow(_joined, "owner long, depth long, first long, ids string")
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_digests, "owner long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, local_weight: int = LOCAL_WEIGHT, block: int = BLOCK) -> DataFrame:
    """Every node of the trie of sequences(conv, pos, digest, chars); lengths(conv, len) also names conversations without turns.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    nodes, visits = nodes_of(prefixes(turns, lengths, block))
    totals = totals_below(nodes, visits, local_weight)
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    out = nodes.select(*NODE, "parent_owner", "n_convs", "n_children").join(totals, NODE).join(end_digests(visits), NODE, "left")
    return out.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.col("parent_owner").alias("parent_conv_id"),
        *("n_convs", "n_children", "n_leaves", "saved_tokens", ends),
    )


def trie(conversations: DataFrame, **names: str) -> DataFrame:
    """Trie of conversations as they stand."""
    turns = sequences(conversations, **names)
    return prefix_trie(turns, turns.groupBy("conv").agg(F.max("pos").alias("len")))
