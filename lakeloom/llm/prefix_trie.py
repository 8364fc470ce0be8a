"""The trie of conversations: which beginnings they share, and sums over what follows each.

A node is known by a sum of hashes of its turns and their places, 128 bits wide. Sums can be taken in
any order, so the prefixes of a conversation are window sums over blocks of turns plus the sums of the
blocks before, and a conversation of any length is spread over many tasks.

Sums over subtrees go by bands of :data:`BAND` depths. Inside a band each node counts at its ancestors
down to the band's first depth, at most ``BAND`` of them. The nodes at which bands begin make a tree of
their own, ``BAND`` times lower, whose sums are found in the same way; each of these is then added to
the ``BAND`` ancestors in the band above. So the rounds follow the logarithm of the longest
conversation, and no row is copied more than ``BAND`` times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.numbering import dense_id
from lakeloom.sources.staging import stage

#: Depths of a band; turns that are summed by one window; ids that are joined to one text, as a power of 2.
BAND, BLOCK, IDS_BITS = 8, 1024, 12

_LANES = ["s1", "s2", "s3", "s4"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, nth, digest, n_bytes``: the turns of each conversation numbered from 0.

    Turns go by ``turn``, NULL first; those of one ``turn`` by the SHA-256 of role and text. ``digest``
    is that hash, of NULL as of an empty string, and ``n_bytes`` the text's length in UTF-8. Rows
    without a ``conv_id`` are in no conversation. Rows that repeat are each a turn, other columns are not
    read, and an empty table gives no rows.

    Turns are numbered through all conversations by ranges and counted from each one's first, so that
    a conversation with most of the turns, or a turn with most of the copies, is cut into ranges too.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(digest).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("copy"),
    )
    numbered = dense_id(turns, "conv_id", F.asc_nulls_first("turn"), "digest", "copy").drop("copy", "turn")
    spans = numbered.groupBy("conv_id").agg(F.min("id").alias("first"), F.count("*").alias("n_turns"))
    # By stretches of numbers, so that no key of the join has more than a block of turns.
    stretch = lambda c: F.floor(F.col(c) / BLOCK)
    spans = spans.withColumn("last", F.col("first") + F.col("n_turns") - 1)
    spans = spans.withColumn("stretch", F.explode(F.sequence(stretch("first"), stretch("last"))))
    placed = numbered.withColumn("stretch", stretch("id")).join(spans.drop("last"), ["conv_id", "stretch"])
    return placed.select("conv_id", "n_turns", (F.col("id") - F.col("first")).alias("nth"), "digest", "n_bytes")


def grafted(turns: DataFrame, source: Column, head: Column, most_head: int) -> DataFrame:
    """Conversations whose first turns are replaced by those of another.

    Each conversation c of :func:`ordered_turns` gets the first ``head`` turns, or all if there are fewer,
    of the conversation ``source``, none if there is no such one, and then its own after its first
    ``head``. Both are of ``conv_id``; ``head`` is at most ``most_head``, and few conversations share a
    source. Returns ``conv_id, depth, total, digest, n_bytes``: depths from 1 to ``total``, and a row of depth
    0 for each conversation.
    """
    facts = turns.select("conv_id", "n_turns", "nth").where("nth = 0").drop("nth")
    of_source = facts.select(F.col("conv_id").alias("source"), F.col("n_turns").alias("source_turns"))
    facts = facts.withColumns({"source": source, "head": head.cast("long")}).join(of_source, "source", "left")
    taken = F.least(F.col("head"), F.coalesce("source_turns", F.lit(0)))
    facts = facts.withColumn("taken", taken).withColumn(
        "total", F.col("taken") + F.greatest(F.col("n_turns") - F.col("head"), F.lit(0))
    )
    facts = stage(facts.select("conv_id", "source", "head", "taken", "total", "n_turns"), "grafts")

    own = turns.withColumn("stretch", F.floor(F.col("nth") / BLOCK)).drop("n_turns")
    whole = facts.withColumn(
        "stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_turns") - 1) / BLOCK)))
    ).drop("source", "n_turns")
    tails = own.join(whole, ["conv_id", "stretch"]).where("nth >= head").select(
        "conv_id", (F.col("nth") - F.col("head") + F.col("taken") + 1).alias("depth"), "total", "digest", "n_bytes"
    )
    first = turns.where(F.col("nth") < most_head).select(F.col("conv_id").alias("source"), "nth", "digest", "n_bytes")
    heads = facts.drop("head", "n_turns").join(first, "source").where("nth < taken").select(
        "conv_id", (F.col("nth") + 1).alias("depth"), "total", "digest", "n_bytes"
    )
    roots = facts.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), "total",
        F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"),
    )
    return tails.unionByName(heads).unionByName(roots)


def whole(turns: DataFrame) -> DataFrame:
    """Conversations as they are, in the columns of :func:`grafted`."""
    return grafted(turns, F.col("conv_id"), F.lit(0), 0)


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums])))


def _prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, n_bytes, ends`` of every row: the node that its turns up to it make."""
    halves = []
    for seed in (1, 2):
        both = F.xxhash64(F.lit(seed), F.col("depth"), F.col("digest"))
        halves += [both.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(both, 32)]
    zero = F.col("depth") == 0
    lanes = rows.withColumns(
        {"block": F.floor(F.col("depth") / BLOCK)}
        | {name: F.when(zero, F.lit(0)).otherwise(half).cast("long") for name, half in zip(_LANES, halves, strict=True)}
    )
    along = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    within = lanes.withColumns({f"up_{name}": F.sum(name).over(along) for name in _LANES})
    # Only conversations of several blocks have sums of earlier ones: a row for a block.
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lanes.where(F.col("total") >= BLOCK).groupBy("conv_id", "block").agg(*[F.sum(n).alias(n) for n in _LANES])
    before = blocks.select("conv_id", "block", *[F.sum(n).over(earlier).alias(f"before_{n}") for n in _LANES])
    joined = within.join(before, ["conv_id", "block"], "left")
    sums = [F.col(f"up_{n}") + F.coalesce(f"before_{n}", F.lit(0)) for n in _LANES]
    less = [s - F.col(n) for s, n in zip(sums, _LANES, strict=True)]
    depth = F.col("depth")
    return joined.select(
        "conv_id", "depth", _node(depth, sums).alias("node"),
        F.when(depth > 0, _node(depth - 1, less)).alias("parent"), "n_bytes", (depth == F.col("total")).alias("ends"),
    )


def _paths(prefixes: DataFrame, nodes: DataFrame, step: int) -> DataFrame:
    """``node, closing, ups`` for the nodes whose depth is a multiple of ``step``.

    ``ups`` are the nodes of the same band that lead to it, itself included. A node at which a band
    begins has a second, ``closing`` row with the nodes of the whole band above.
    """
    place = F.floor(F.col("depth") / step)
    band = F.floor(F.col("place") / BAND)
    begins = (F.col("place") % BAND == 0) & (F.col("place") > 0)
    rows = prefixes.where(F.col("depth") % step == 0).select("conv_id", "node", place.alias("place"))
    rows = rows.withColumn("band", F.explode(F.when(begins, F.array(band - 1, band)).otherwise(F.array(band))))
    along = Window.partitionBy("conv_id", "band").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    listed = rows.select(
        "conv_id", "node", (F.col("band") < band).alias("closing"), F.collect_list("node").over(along).alias("ups")
    )
    listed = listed.withColumn("ups", F.when(F.col("closing"), F.slice("ups", 1, BAND)).otherwise(F.col("ups")))
    # Every member of a node has the same path; the smallest one's is kept.
    return listed.join(nodes.select("node", "conv_id"), ["node", "conv_id"], "left_semi").drop("conv_id")


def _counted_above(paths: DataFrame, values: DataFrame) -> DataFrame:
    names = [c for c in values.columns if c != "node"]
    spread = paths.join(values, "node").select(F.explode("ups").alias("node"), *names)
    return spread.groupBy("node").agg(*[F.sum(n).alias(n) for n in names])


def _subtree_sums(prefixes: DataFrame, nodes: DataFrame, values: DataFrame, deepest: int, step: int = 1) -> DataFrame:
    """``values`` of each node, given for depths that are multiples of ``step``, summed over its subtree."""
    paths = stage(_paths(prefixes, nodes, step), "trie-paths")
    inside = _counted_above(paths.where("not closing"), values)
    if deepest < step * BAND:
        return inside
    inside = stage(inside, "trie-bands")
    begin = paths.where("not closing and size(ups) = 1").select("node")
    whole_sums = _subtree_sums(prefixes, nodes, inside.join(begin, "node", "left_semi"), deepest, step * BAND)
    below = _counted_above(paths.where("closing"), whole_sums)
    names = [c for c in values.columns if c != "node"]
    return inside.unionByName(below).groupBy("node").agg(*[F.sum(n).alias(n) for n in names])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (node, text), those of a node together and in order, to the SHA-256 of the texts joined by
    commas. One text is held at a time."""
    node, digest = None, hashlib.sha256()
    nodes, digests = [], []
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    nodes.append(node)
                    digests.append(digest.hexdigest())
                node, digest = key, hashlib.sha256()
            digest.update(text.encode())
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests)], ["node", "ends_sha256"])
            nodes, digests = [], []
    if node is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"]
        )


def _ends(prefixes: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the conversations that end at a node: their ids in rising order."""
    chunk = F.shiftright("conv_id", IDS_BITS)
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = prefixes.where("ends").groupBy("node", chunk.alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))
    return (
        chunks.repartition("node").sortWithinPartitions("node", "chunk")
        .select("node", "ids").mapInArrow(_digests, "node binary, ends_sha256 string")
    )


def prefix_trie(rows: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations given as :func:`grafted` or :func:`whole` returns them.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node, parent``.
    A node is a distinct sequence of ``depth`` first turns, its members the conversations that begin
    with it; ``conv_id`` is the smallest. ``n_leaves`` counts the nodes without children in its subtree, and
    ``saved_tokens`` sums over the subtree the bytes of each node's last text that need not be stored
    for all members but one. ``ends_sha256`` is of the ids, joined by commas, of members that end there.

    A conversation without turns is a member of the root alone; no conversations make no nodes. Two
    different beginnings agree with a chance of about one in 2**128.
    """
    prefixes = stage(_prefixes(stage(rows, "trie-turns")), "trie-prefixes")
    # All but the conversation follows from the node, so that counts and ids are all that is aggregated.
    nodes = stage(
        prefixes.groupBy("node", "parent", "depth", "n_bytes").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")
        ),
        "trie-nodes",
    )
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = stage(
        nodes.join(parents, "parent", "left").join(children, "node", "left").fillna(0, ["n_children"]), "trie-known"
    )
    values = known.select(
        "node",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    deepest = nodes.agg(F.max("depth").alias("depth")).first()["depth"] or 0
    sums = _subtree_sums(prefixes, nodes, values, deepest)
    return known.join(sums, "node").join(_ends(prefixes), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"), "node", "parent",
    )
