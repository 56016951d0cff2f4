"""Conversation prefix trie by van Emde Boas recursion, over tables.

Sequences of turns are cut at half their greatest depth, the halves again, and so on down to tries of HEIGHT levels. All
pieces of one level are worked on at once, in joins and aggregations on (conversation, piece): digests of pieces go up
the recursion, the names of the prefixes at the cuts go down it. Every small trie below a cut is then built by itself,
and its totals are grafted upward: first those of lower tries onto the roots of the upper ones, halves by halves, then
back onto every node. A node goes up through one row for each level, not one for each of its ancestors, so chains of any
length and nodes with any number of children are no large groups.

Turns are named by the SHA-256 of role and text, and prefixes by that of the names they are made of; 128 bits of it are
kept, so equal names are taken for equal sequences.

Null roles and texts count as empty; turns are ordered by their number, nulls first, and those of equal number, repeated
rows among them, by the digest of role and text. Rows without conversation belong to nobody and are left out. Other
columns, whatever their names, are not read. An empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.graph import landed
from pulsegrid.operators.skew import with_parts

#: Levels of the tries that are built in one piece.
HEIGHT = 16
#: Turns of a conversation that share a copy of its row; ids in a piece of a list of ends.
SLICE, LISTED = 4096, 4096
#: Keys that hold more than one in so many rows are joined by broadcast: there are fewer of them than this.
HEAVY = 2048
ROOT = "0" * 32
EMPTY = hashlib.sha256(b"").hexdigest()


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("long"))


def _name(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def numbered(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, digest, bytes)``: the turns of every conversation, numbered from 0 in their order.

    Conversations are cut into ranges of rows of about equal size, so that one with a large part of all rows is numbered
    by many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        _name(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    parted = with_parts(rows, "conv_id", ["turn", "digest"])
    of_part = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "digest")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (parted.where("part >= 0").groupBy("conv_id", "part").agg(F.count("*").alias("n"))
              .select("conv_id", "part", F.sum("n").over(earlier).alias("before")))
    placed = parted.withColumn("row", F.row_number().over(of_part)).join(before, ["conv_id", "part"], "left")
    pos = (F.col("row") - 1 + F.coalesce("before", F.lit(0))).cast("long")
    return landed(placed.select("conv_id", pos.alias("pos"), "digest", "bytes"), "trie-turns")


def rebuilt(turns: DataFrame, siblings: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """The turns of conversations whose first turns come from another one, and the ids of all conversations.

    Conversation c takes the first h turns of conversation ``c - c % siblings`` (fewer if it has fewer, none if it is not
    there), then its own turns after its first h; ``h = crc32(c in decimal) % heads``.
    """
    head = F.crc32(F.col("conv_id").cast("string")) % heads
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = landed(
        sizes.select("conv_id", "n", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % siblings).alias("base"))
        .join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
        .withColumn("n_head", F.least("h", F.coalesce("base_n", F.lit(0)))), "trie-convs")
    copies = convs.select("conv_id", "n_head", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("n") - 1, SLICE))).alias("slice"))
    own = (turns.where(F.col("pos") >= head).withColumn("slice", _div(F.col("pos"), SLICE)).join(copies, ["conv_id", "slice"])
           .select("conv_id", (F.col("n_head") + F.col("pos") - head).alias("pos"), "digest", "bytes"))
    taken = (turns.where(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base").join(convs.select("conv_id", "base", "h"), "base")
             .where(F.col("pos") < F.col("h")).select("conv_id", "pos", "digest", "bytes"))
    return landed(own.unionByName(taken), "trie-rebuilt"), convs.select("conv_id")


def _cut_names(blocks: DataFrame, full_blocks: int) -> DataFrame:
    """``(conv_id, j, name)`` of the prefixes of HEIGHT * j turns, of conversations that have as many as HEIGHT.

    Digests of runs of blocks go up, two to one; then each level names the cuts in the middle of its pieces.
    """
    runs = [landed(blocks.where(F.size("bytes") == HEIGHT).select("conv_id", "j", _name(F.col("digests")).alias("digest")), "trie-runs")]
    levels = full_blocks.bit_length()
    for _ in range(1, levels):
        two = runs[-1].groupBy("conv_id", _div(F.col("j"), 2).alias("j")).agg(
            F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("j", "digest"))).alias("halves"))
        runs.append(landed(two.where("n = 2").select("conv_id", "j", _name(
            F.col("halves")[0]["digest"], F.col("halves")[1]["digest"]).alias("digest")), "trie-runs"))
    names = runs[0].where("j = 0").select("conv_id", "j", F.lit(ROOT).alias("name"))
    for level in reversed(range(levels)):
        run = runs[level].select("conv_id", (F.col("j") * 2**level).alias("j"), "digest")
        cut = names.join(run, ["conv_id", "j"]).select("conv_id", (F.col("j") + 2**level).alias("j"), _name(F.col("name"), F.col("digest")).alias("name"))
        names = landed(names.unionByName(cut), "trie-names")
    return names


def _paths(blocks: DataFrame, names: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv_id, j, path, bytes, next)``: a conversation's nodes in its small trie j, the trie's root first, the bytes of
    the texts that lead from each to the one after it, and the root that follows."""
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("j"), F.lit(ROOT).alias("name")).unionByName(names.where("j > 0"))
    after = names.select("conv_id", (F.col("j") - 1).alias("j"), F.col("name").alias("next"))
    inner = F.least(F.coalesce(F.size("bytes"), F.lit(0)), F.lit(HEIGHT - 1))
    below = F.transform(F.sequence(F.lit(1), inner), lambda i: _name(F.col("name"), F.substring(F.col("digests"), F.lit(1), i * 32)))
    path = F.concat(F.array("name"), F.when(inner > 0, below).otherwise(F.array().cast("array<string>")))
    return landed(
        roots.join(blocks, ["conv_id", "j"], "left").join(after, ["conv_id", "j"], "left")
        .select("conv_id", "j", path.alias("path"), "bytes", "next"), "trie-paths")


def _nodes(paths: DataFrame) -> DataFrame:
    """``(name, parent, depth, bytes, conv_id, n_convs)`` of every node."""
    depth = F.col("j") * HEIGHT
    line = F.concat("path", F.array_compact(F.array("next")))
    steps = F.transform(F.slice(line, 2, HEIGHT), lambda name, i: F.struct(
        name.alias("name"), F.get("path", i).alias("parent"), (depth + i + 1).alias("depth"), F.get("bytes", i).alias("bytes")))
    root = F.struct(F.lit(ROOT).alias("name"), F.lit(None).cast("string").alias("parent"), depth.alias("depth"), F.lit(0).cast("long").alias("bytes"))
    visits = paths.select("conv_id", F.inline(F.concat(F.when(F.col("j") == 0, F.array(root)).otherwise(F.array().cast(
        "array<struct<name:string,parent:string,depth:bigint,bytes:bigint>>")), steps)))
    return landed(visits.groupBy("name", "parent", "depth", "bytes").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")), "trie-nodes")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _grafted(nodes: DataFrame, names: DataFrame, up: int) -> DataFrame:
    """Totals of ``nodes(conv_id, j, leaves, saved)``, each brought to its ancestor ``up`` cuts above, summed by name."""
    return _summed(nodes.select("conv_id", (F.col("j") - up).alias("j"), "leaves", "saved").join(names, ["conv_id", "j"]))


def _plus(nodes: DataFrame, more: DataFrame) -> DataFrame:
    more = more.select("name", F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved"))
    return nodes.join(more, "name", "left").select(
        "name", "conv_id", "j", (F.col("leaves") + F.coalesce("_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved"))


def _totals(nodes: DataFrame, paths: DataFrame, names: DataFrame, full_blocks: int) -> DataFrame:
    """``(name, leaves, saved)`` summed over the subtree of every node; ``nodes`` has them for the node alone.

    A node is counted along the path of its smallest member, so each conversation brings a small trie's nodes one sum each.
    """
    own = nodes.groupBy("conv_id", _div(F.col("depth"), HEIGHT).alias("j")).agg(
        F.collect_list(F.struct((F.col("depth") % HEIGHT).alias("i"), "leaves", "saved")).alias("own"))

    def below(field: str, at: Column) -> Column:
        return F.aggregate(F.filter("own", lambda x: x["i"] >= at), F.lit(0).cast("long"), lambda sum_, x: sum_ + x[field])

    within = own.join(paths, ["conv_id", "j"]).select(F.inline(F.transform("path", lambda name, at: F.struct(
        name.alias("name"), below("leaves", at).alias("leaves"), below("saved", at).alias("saved")))))
    tries = landed(_summed(within), "trie-within")
    levels = full_blocks.bit_length()
    if not levels:
        return tries
    roots = nodes.where(F.col("depth") % HEIGHT == 0).select("name", "conv_id", _div(F.col("depth"), HEIGHT).alias("j"))
    parts = [landed(roots.join(tries, "name"), "trie-roots")]
    for level in range(levels):
        lower = parts[-1].where(_div(F.col("j"), 2**level) % 2 == 1)
        upper = parts[-1].where(F.col("j") % 2 ** (level + 1) == 0)
        parts.append(landed(_plus(upper, _grafted(lower, names, 2**level)), "trie-roots"))
    whole = parts.pop()
    for level in reversed(range(levels)):
        middle = parts.pop().where(_div(F.col("j"), 2**level) % 2 == 1)
        whole = landed(whole.unionByName(_plus(middle, _grafted(whole.where("j > 0"), names, 2**level))), "trie-whole")
    onto = (whole.where("j > 0").select("conv_id", (F.col("j") - 1).alias("j"), "leaves", "saved").join(paths, ["conv_id", "j"])
            .select(F.explode("path").alias("name"), "leaves", "saved"))
    return _summed(tries.unionByName(onto))


def _ends(paths: DataFrame) -> DataFrame:
    """``(name, ends_sha256)`` of the nodes at which conversations end: the digest of their ids, ascending, comma-joined.

    Ranges of (node, id) join their ids to pieces; a node's pieces are digested one after the other in one task, as the
    digest asks, which never holds more than one of them.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, run in groupby(zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()), lambda r: r[0]):
                ids = [i for _, i in run]
                out += [(name, ids[at], ",".join(map(str, ids[at:at + LISTED]))) for at in range(0, len(ids), LISTED)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["name", "first", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if name == now:
                    state.update(f",{ids}".encode())
                    continue
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = name, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["name", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["name", "ends_sha256"])

    last = paths.where(F.col("next").isNull()).select(F.element_at("path", -1).alias("name"), "conv_id")
    listed = (last.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
              .mapInArrow(pieces, "name string, first long, ids string"))
    return listed.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digested, "name string, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations ``convs(conv_id)`` with ``turns(conv_id, pos, digest, bytes)``.

    A node is a distinct sequence of first turns, the root that of none; its members are the conversations that begin
    with it. Per node: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null at the root), n_convs
    (members), n_children, n_leaves (nodes without children in its subtree, itself included), saved_tokens (over the
    subtree, (n_convs - 1) times the bytes of the last text), ends_sha256 (digest of the ids of the members that end here).
    """
    full_blocks = (turns.agg(F.max("pos")).first()[0] or 0) + 1
    full_blocks //= HEIGHT
    blocks = turns.groupBy("conv_id", _div(F.col("pos"), HEIGHT).alias("j")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns"))
    blocks = landed(blocks.select("conv_id", "j", F.array_join("turns.digest", "").alias("digests"), F.col("turns.bytes").alias("bytes")),
                    "trie-blocks")
    names = _cut_names(blocks, full_blocks)
    paths = _paths(blocks, names, convs)
    nodes = _nodes(paths)
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = landed(
        nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "trie-weighed")

    own = nodes.select("name", "parent", "conv_id", "depth", "n_convs", "n_children")
    found = (own.join(_totals(nodes, paths, names, full_blocks), "name").join(_ends(paths), "name", "left")
             .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))))
    found = landed(found, "trie-found")
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("weight"))
    total = nodes.count()
    wide = parents.where(F.col("weight") * HEAVY > total)
    marked = found.join(F.broadcast(wide), "parent", "left")
    narrow = marked.where(F.col("weight").isNull()).drop("parent_conv_id", "weight").join(
        parents.where(F.col("weight") * HEAVY <= total), "parent", "left")
    return marked.where(F.col("weight").isNotNull()).unionByName(narrow).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), "ends_sha256")
