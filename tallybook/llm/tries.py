"""Prefix trie of conversations: every distinct beginning of a turn sequence, with counts over its subtree.

A turn is known by the MD5 digest of role and text, so texts are read once and never shuffled. Conversations are cut into segments
of ``SEGMENT`` turns; the segments of one depth that follow the same beginning form a trie of their own, whose totals are added
where it hangs on. Segments are range-partitioned by their digests in a row (then by id, so copies of one conversation are dealt
to several parts) and each part is worked on in blocks of bounded size:

* the block is a matrix of turn ids, padded with zeros, in lexicographic order (``lexsort``);
* a row differs from the one before in some column; OR-accumulated along the row, these changes mark where nodes begin;
* ``reduceat`` over the beginnings gives each depth its counts, from the deepest up also those over subtrees.

Nodes inside a block are final. Those that hold its first or last row (one path each) may go on in the next block; they are
sent as partial rows and recombined by their digest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.operators.joins import lookup_join
from tallybook.operators.ordering import ranged, sequence_within
from tallybook.staging import Stage, stage_of

#: Turns of a segment; a conversation that is alone beyond its first segments needs no matrix there.
SEGMENT = 256
#: Cells of a block's matrix.
CELLS = 1 << 22
#: Ids that are sent together to be hashed.
IDS_AT_ONCE = 1 << 16
#: A conversation with id c begins with up to ``HEADS`` - 1 turns of the first one of its hundred.
HEADS, FAMILY = 6, 100
EMPTY = hashlib.sha256(b"").hexdigest()

_NODE, _EDGE, _ENDS, _GROUP = range(4)
_OUT = ("kind int, depth long, conv long, parent_conv long, mark binary, parent_mark binary, n_convs long, n_children long, "
        "n_leaves long, saved long, chars long, more boolean, shard long, side int, at int, ends string")
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}


def in_order(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", stage: Stage | None = None
) -> DataFrame:
    """``conv``, ``place`` (from 1), ``key`` (hex digest of role and text) and ``chars`` of every turn with a conversation id.

    Turns stand in the order of ``turn``, nulls first, ties by digest. Null roles and texts count as empty.
    """
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t)).alias("key"), F.char_length(t).cast("long").alias("chars"))
    placed = sequence_within(rows.filter("conv is not null"), "conv", ["turn", "key"], "place", stage=stage_of(turns, stage))
    return placed.select("conv", "place", "key", "chars")


def as_they_are(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turn sequences (``conv``, ``depth``, ``key``, ``chars``) and lengths (``conv``, ``length``) of the conversations themselves."""
    lengths = placed.groupBy("conv").agg(F.max("place").cast("long").alias("length"))
    return placed.withColumnRenamed("place", "depth"), lengths


def with_family_heads(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for rebuilt conversations: the first h turns come from the first conversation of the hundred, if it has them.

    h is the CRC32 of the decimal id, modulo ``HEADS``. Remainders of negative ids are negative.
    """
    h = (F.crc32(F.col("conv").cast("string")) % HEADS).cast("int")
    base = F.col("conv") - F.col("conv") % FAMILY
    own = placed.groupBy("conv").agg(F.max("place").alias("own"))
    heads = own.filter(F.col("conv") % FAMILY == 0).select(
        F.col("conv").alias("base"), F.least("own", F.lit(HEADS - 1)).alias("has"))
    taken = F.least(h, F.coalesce("has", F.lit(0)))
    convs = own.withColumn("base", base).join(heads, "base", "left").select(
        "conv", "base", taken.alias("taken"), (taken + F.greatest(F.col("own") - h, F.lit(0))).cast("long").alias("length"))
    first = placed.filter((F.col("place") < HEADS) & (F.col("conv") % FAMILY == 0)).select(
        F.col("conv").alias("base"), "place", "key", "chars")
    inherited = convs.join(first, "base").filter(F.col("place") <= F.col("taken")).select(
        "conv", F.col("place").alias("depth"), "key", "chars")
    rest = lookup_join(placed.filter(F.col("place") > h).withColumn("base", base), heads, "base")
    rest = rest.select("conv", (taken + F.col("place") - h).alias("depth"), "key", "chars")
    return inherited.unionAll(rest), convs.select("conv", "length")


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Numbers from 1 in the order of 16-byte keys."""
    if not len(keys):
        return np.zeros(0, np.int32)
    halves = keys.reshape(-1, 16).view(">u8").astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.r_[True, (halves[order[1:]] != halves[order[:-1]]).any(axis=1)]
    ranks = np.empty(len(order), np.int32)
    ranks[order] = np.cumsum(new)
    return ranks


def _rows(n: int, **columns) -> pa.RecordBatch:
    """A batch in the shape of ``_OUT``; columns left out are null."""
    arrays = []
    for spec in _OUT.split(", "):
        name, kind = spec.split()
        value = columns.get(name)
        if value is None:
            arrays.append(pa.nulls(n, _TYPES[kind]))
        elif np.isscalar(value):
            arrays.append(pa.array([value] * n, _TYPES[kind]))
        else:
            arrays.append(pa.array(value, _TYPES[kind]))
    return pa.RecordBatch.from_arrays(arrays, [s.split()[0] for s in _OUT.split(", ")])


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest() if len(ids) else EMPTY


def _block(level: int, segment: int, shard: int, rows: dict[str, np.ndarray]):
    """All output rows of one block. Column 0 of the matrix is the group (the root at level 0), then come the turns."""
    n, conv = rows["n"], rows["conv"]
    height, width = len(n), int(n.max()) + 1
    inside = np.arange(1, width) <= n[:, None]
    matrix, chars = np.zeros((height, width), np.int32), np.zeros((height, width), np.int64)
    group = np.column_stack([rows["q1"], rows["q2"]]).view(np.uint64) ^ np.uint64(1 << 63)  # bytes in the order of the numbers
    matrix[:, 0] = _ranks(group.astype(">u8").view(np.uint8))
    matrix[:, 1:][inside] = _ranks(rows["keys"])
    chars[:, 1:][inside] = rows["chars"]
    order = np.lexsort((conv, *matrix.T[::-1]))
    ends = np.cumsum(n) * 16
    paths = [rows["keys"][ends[i] - 16 * n[i]:ends[i]].tobytes() for i in (order[0], order[-1])]
    groups = [f"{level}:{rows['q1'][i]}:{rows['q2'][i]}:".encode() for i in (order[0], order[-1])]
    matrix, chars, n, conv = matrix[order], chars[order], n[order], conv[order]
    more, up, below = rows["more"][order], rows["up"][order], rows["below"][order]

    change = np.ones((height, width), bool)
    change[1:] = matrix[1:] != matrix[:-1]
    np.logical_or.accumulate(change, axis=1, out=change)
    depths = []
    for j in range(width):
        cuts = np.flatnonzero(change[:, j])
        real = matrix[cuts, j] > 0
        start, stop = cuts[real], np.r_[cuts[1:], height][real]
        last = n == j  # members whose segment ends here
        final = np.add.reduceat(last.astype(np.int64), cuts)[real]
        hanging = np.add.reduceat(np.where(last[:, None], below, 0), cuts)[real]
        parent = np.searchsorted(depths[-1]["start"], start, "right") - 1 if j else None
        depths.append({
            "start": start, "stop": stop, "conv": np.minimum.reduceat(conv, cuts)[real], "final": final, "parent": parent,
            "edge": (start == 0) | (stop == height), "more": np.add.reduceat((last & more).astype(np.int64), cuts)[real] > 0,
            "hanging": hanging, "chars": chars[start, j] if j else np.zeros(len(start), np.int64)})
    for j in range(width - 1, -1, -1):
        d = depths[j]
        inner = np.zeros(len(d["start"]), np.int64)
        if j + 1 < width:
            child = depths[j + 1]
            inner += np.bincount(child["parent"][~child["edge"]], minlength=len(inner))
        d["children"] = inner + d["hanging"][:, 0]
        # An edge's own part waits until its counts are complete.
        leaf = ~d["edge"] & (d["children"] == 0) & ~d["more"]
        own = np.where(d["edge"], 0, (d["stop"] - d["start"] - 1) * d["chars"])
        d["leaves"], d["saved"] = leaf + d["hanging"][:, 1], own + d["hanging"][:, 2]
        if j + 1 < width and len(child["start"]):
            firsts = np.flatnonzero(np.r_[True, child["parent"][1:] != child["parent"][:-1]])
            for name in ("leaves", "saved"):
                d[name][child["parent"][firsts]] += np.add.reduceat(child[name], firsts)

    marks = [[xxhash.xxh3_128_digest(g + p[:16 * j]) for j in range(len(p) // 16 + 1)] for g, p in zip(groups, paths)]
    for j, d in enumerate(depths):
        keep = ~d["edge"]
        start, size = d["start"][keep], int(keep.sum())
        if size:
            members = [conv[s:s + f][~more[s:s + f]] for s, f in zip(start, d["final"][keep])]
            shown = {"depth": np.full(size, level * segment + j), "conv": d["conv"][keep], "n_convs": (d["stop"] - d["start"])[keep],
                     "n_children": d["children"][keep], "n_leaves": d["leaves"][keep], "saved": d["saved"][keep]}
            if j == 0:
                yield _rows(size, kind=_GROUP, **shown)
            elif j == 1 and level:
                yield _rows(size, kind=_NODE, parent_conv=up[start], ends=[_digest(m) for m in members], **shown)
            else:
                over = depths[j - 1]
                above = d["parent"][keep]
                open_ = over["edge"][above]
                first = over["start"][above] == 0
                at = [None if not o else marks[0 if f else 1][j - 1] for o, f in zip(open_.tolist(), first.tolist())]
                yield _rows(size, kind=_NODE, parent_conv=pa.array(over["conv"][above], mask=open_), parent_mark=at,
                            ends=[_digest(m) for m in members], **shown)
        for side in (0, 1):  # the path of the first row, then of the last
            found = np.flatnonzero(d["start"] == 0 if side == 0 else d["stop"] == height)
            if not len(found):
                continue
            i = int(found[0])
            counted = side == 0 or d["start"][i] > 0
            s = int(d["start"][i])
            numbers = {"n_convs": d["stop"][i] - s, "n_children": d["children"][i], "n_leaves": d["leaves"][i], "saved": d["saved"][i]}
            numbers = {c: [int(v) if counted else 0] for c, v in numbers.items()}
            parent_mark = None if j == 0 else [marks[side][j - 1]]
            yield _rows(1, kind=_EDGE, depth=[level * segment + j], conv=[int(d["conv"][i])], mark=[marks[side][j]],
                        parent_mark=parent_mark, parent_conv=[int(up[s])] if level and j == 1 else None,
                        chars=[int(d["chars"][i])], more=[bool(d["more"][i])], shard=[shard], side=[side], **numbers)
            ids = conv[s:s + d["final"][i]][~more[s:s + d["final"][i]]] if counted else conv[:0]
            for at in range(0, len(ids), IDS_AT_ONCE):
                text = ",".join(map(str, ids[at:at + IDS_AT_ONCE].tolist()))
                yield _rows(1, kind=_ENDS, mark=[marks[side][j]], shard=[shard], at=[at // IDS_AT_ONCE], ends=[text])


def _shards(level: int, segment: int):
    """Task function: a sorted part, in blocks."""
    def arrays(batch):
        def column(name):
            return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False)

        paths = batch.column("path").cast(pa.large_binary())
        offsets = np.frombuffer(paths.buffers()[1], np.int64)[paths.offset:paths.offset + len(paths) + 1]
        data = np.frombuffer(paths.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        return {"n": np.diff(offsets) // 16, "keys": data, "chars": batch.column("chars").flatten().to_numpy(zero_copy_only=False),
                "more": batch.column("more").to_numpy(zero_copy_only=False), **{c: column(c) for c in ("conv", "q1", "q2", "up")},
                "below": np.column_stack([column(c) for c in ("below_children", "below_leaves", "below_saved")])}

    def run(batches):
        part, held, blocks, height, width = TaskContext.get().partitionId(), [], 0, 0, 1

        def flush():
            return _block(level, segment, part << 32 | blocks, {c: np.concatenate([h[c] for h in held]) for c in held[0]})

        for batch in batches:
            while batch.num_rows:
                n = batch.column("chars").value_lengths().to_numpy(zero_copy_only=False)
                widths = np.maximum(width, np.maximum.accumulate(n) + 1)
                fits = int(np.searchsorted((height + np.arange(1, len(n) + 1)) * widths, CELLS, "right"))
                if not fits and held:
                    yield from flush()
                    held, blocks, height, width = [], blocks + 1, 0, 1
                    continue
                fits = max(fits, 1)
                held.append(arrays(batch.slice(0, fits)))
                height, width = height + fits, int(widths[fits - 1])
                batch = batch.slice(fits)
        if held:
            yield from flush()
    return run


def _hashed(batches):
    """Digest of each mark's ids, which come in order; nothing but the running hash is held."""
    mark = running = None
    for batch in batches:
        for now, text in zip(batch.column("mark").to_pylist(), batch.column("ends").to_pylist()):
            if now != mark:
                if mark is not None:
                    yield _digested(mark, running)
                mark, running = now, hashlib.sha256()
            else:
                running.update(b",")
            running.update(text.encode())
    if mark is not None:
        yield _digested(mark, running)


def _digested(mark, running):
    return pa.RecordBatch.from_arrays([pa.array([mark], pa.binary()), pa.array([running.hexdigest()])], ["mark", "ends"])


def _recombined(found: DataFrame, stage: Stage) -> DataFrame:
    """Nodes that span blocks, whole: at most two paths a block come in."""
    edges = found.filter(F.col("kind") == _EDGE)
    total = edges.groupBy("mark").agg(
        *[F.min(c).alias(c) for c in ("depth", "conv", "parent_mark", "parent_conv", "chars")], F.max("more").alias("more"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.min(F.struct("shard", "side")).alias("owner"))
    total = stage.table(total, "edges")
    kids = total.filter("parent_mark is not null").groupBy(F.col("parent_mark").alias("mark")).agg(F.count("*").alias("kids"))
    nodes = total.join(kids, "mark", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    leaf = ((F.col("n_children") == 0) & ~F.col("more")).cast("long")
    nodes = stage.table(nodes.withColumns(
        {"leaf": leaf, "own": (F.col("n_convs") - 1) * F.col("chars")}).drop("kids"), "whole-edges")
    # A node counts for its ancestors once: on the path that owns it.
    mine = (F.struct("shard", "side") == F.col("owner"))
    path = edges.select("mark", "shard", "side", "depth").join(nodes.select("mark", "owner", "leaf", "own"), "mark")
    deeper = W.partitionBy("shard", "side").orderBy(F.col("depth").desc())
    sums = {f"sum_{c}": F.sum(F.when(mine, F.col(c)).otherwise(0)).over(deeper) for c in ("leaf", "own")}
    below = path.withColumns(sums).groupBy("mark").agg(F.sum("sum_leaf").alias("sum_leaf"), F.sum("sum_own").alias("sum_own"))
    ends = found.filter(F.col("kind") == _ENDS).select("mark", "shard", "at", "ends")
    ends = ends.repartition("mark").sortWithinPartitions("mark", "shard", "at").select("mark", "ends")
    ends = ends.mapInArrow(_hashed, "mark binary, ends string")
    whole = nodes.join(below, "mark").join(ends, "mark", "left")
    parents = nodes.select(F.col("mark").alias("parent_mark"), F.col("conv").alias("over"))
    whole = whole.join(parents, "parent_mark", "left")
    return stage.table(whole.select(
        "mark", "depth", "conv", F.coalesce("parent_conv", "over").alias("parent_conv"), "n_convs", "n_children",
        (F.col("n_leaves") + F.col("sum_leaf")).alias("n_leaves"), (F.col("saved") + F.col("sum_own")).alias("saved"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends")), "recombined")


_NODES = ("conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends")
_BELOW = ("below_children", "below_leaves", "below_saved")


def _level(rows: DataFrame, level: int, segment: int, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """Nodes of the segments of one depth, and the totals of their groups for the level above."""
    order = ["q1", "q2", "path", "conv"]
    placed = ranged(rows.select(*order, "chars", "more", "up", *_BELOW), order).sortWithinPartitions(*order)
    found = stage.table(placed.mapInArrow(_shards(level, segment), _OUT), f"level-{level}")
    edges = _recombined(found, stage)
    inner = found.filter(F.col("kind") == _NODE).select(*_NODES, "parent_mark")
    over = edges.select(F.col("mark").alias("parent_mark"), F.col("conv").alias("over"))
    inner = lookup_join(inner, over, "parent_mark").withColumn("parent_conv", F.coalesce("parent_conv", "over"))
    lowest = level * segment
    nodes = inner.select(*_NODES).unionAll(edges.filter(F.col("depth") >= (lowest + 1 if level else 0)).select(*_NODES))
    groups = found.filter(F.col("kind") == _GROUP).select("conv", "n_children", "n_leaves", "saved").unionAll(
        edges.filter(F.col("depth") == lowest).select("conv", "n_children", "n_leaves", "saved"))
    return nodes, groups.toDF("conv", *_BELOW)


def trie(paths: DataFrame, lengths: DataFrame, stage: Stage | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row for each distinct beginning of the turn sequences, the empty one (root) among them.

    ``conv_id`` smallest member, ``depth``, ``parent_conv_id`` that of the beginning without the last turn (root: null), ``n_convs``
    members, ``n_children``, ``n_leaves`` beginnings of the subtree that nobody continues, ``saved_tokens`` characters of last
    turns that members share with another, summed over the subtree, ``ends_sha256`` of the sorted ids of members that end here.
    No conversations give no rows.
    """
    stage = stage_of(paths, stage)
    turns = F.array_sort(F.collect_list(F.struct("depth", "key", "chars")))  # a segment's turns at most
    cut = paths.groupBy("conv", F.expr(f"cast((depth - 1) div {segment} as int)").alias("seg")).agg(turns.alias("turns"))
    path = F.unhex(F.array_join("turns.key", ""))
    rows = cut.select("conv", "seg", path.alias("path"), F.col("turns.chars").alias("chars"))
    none = lengths.filter("length = 0").select(
        "conv", F.lit(0).alias("seg"), F.lit(b"").alias("path"), F.expr("cast(array() as array<long>)").alias("chars"))
    rows = stage.table(rows.unionAll(none), "segments")
    no = {"q1": F.lit(0).cast("long"), "q2": F.lit(0).cast("long"), "up": F.lit(None).cast("long")}
    zero = {c: F.lit(0).cast("long") for c in _BELOW}
    if (rows.agg(F.max("seg")).first()[0] or 0) == 0:
        nodes, _ = _level(rows.withColumns({**no, **zero, "more": F.lit(False)}), 0, segment, stage)
        return _named(nodes)

    # What a segment follows, and what follows it: XOR of two hashes of each segment and its place.
    before = W.partitionBy("conv").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    hashes = {c: F.xxhash64("path", "seg", F.lit(c)) for c in ("q1", "q2")}
    last = W.partitionBy("conv").orderBy("seg")
    linked = rows.withColumns({f"own_{c}": h for c, h in hashes.items()}).withColumns({
        **{c: F.coalesce(F.bit_xor(f"own_{c}").over(before), F.lit(0).cast("long")) for c in hashes},
        "more": F.lead("seg").over(last).isNotNull()})
    linked = stage.table(linked, "linked")
    group = ["seg", "q1", "q2"]
    sizes = linked.filter("seg > 0").groupBy(*group).agg(F.count("*").alias("members"))
    full = linked.filter(F.size("chars") == segment).groupBy(
        (F.col("seg") + 1).alias("seg"), *[F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(c) for c in hashes]).agg(
        F.min("conv").alias("up"))
    linked = stage.table(linked.join(sizes.join(full, group), group, "left"), "grouped")
    alone = linked.filter("members = 1")
    deepest = linked.filter("members > 1").agg(F.max("seg")).first()[0] or 0

    place = F.posexplode("chars").alias("at", "_chars")
    tail = alone.select("conv", "seg", "up", "more", F.size("chars").alias("n"), place)
    ends = (F.col("at") == F.col("n") - 1) & ~F.col("more")
    nodes = tail.select(
        "conv", (F.col("seg").cast("long") * segment + F.col("at") + 1).alias("depth"),
        F.when(F.col("at") == 0, F.col("up")).otherwise(F.col("conv")).alias("parent_conv"), F.lit(1).cast("long").alias("n_convs"),
        F.when(ends, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved"),
        F.when(ends, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends"))
    single = alone.select("seg", "conv", F.lit(1).cast("long"), F.lit(1).cast("long"), F.lit(0).cast("long"))
    below = single.filter(F.col("seg") == deepest + 1).drop("seg").toDF("conv", *_BELOW)
    for level in range(deepest, -1, -1):  # one round for each segment that two conversations share
        rows = linked.filter((F.col("seg") == level) & (F.lit(level == 0) | (F.col("members") > 1)))
        rows = rows.join(below, "conv", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in _BELOW})
        found, groups = _level(rows, level, segment, stage)
        nodes = nodes.unionAll(found)
        below = groups.unionAll(single.filter(F.col("seg") == level).drop("seg"))
    return _named(nodes)


def _named(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def rebuilt_trie(turns: DataFrame, stage: Stage | None = None, segment: int = SEGMENT) -> DataFrame:
    """The trie of conversations rebuilt by ``with_family_heads``.

    Turns without a conversation id are left out. A conversation whose rebuilt sequence is empty counts for the root alone.
    Null roles and texts are empty, null turn numbers come first, ties stand in the order of their digests, repeated rows are turns
    of their own. Texts are read whole. An empty table gives no rows. Other columns do not matter, whatever their names.
    """
    stage = stage_of(turns, stage)
    return trie(*with_family_heads(in_order(turns, stage=stage)), stage, segment)


def shared_trie(turns: DataFrame, stage: Stage | None = None, segment: int = SEGMENT) -> DataFrame:
    """The trie of the conversations as they are; otherwise like ``rebuilt_trie``."""
    stage = stage_of(turns, stage)
    return trie(*as_they_are(in_order(turns, stage=stage)), stage, segment)
