"""Chat formatting as a prefix tree.

A node of the tree is a prefix of turns: its id is a polynomial in the hashes
of its turns (modulo 2^127 - 1, the base from ``key``), so conversations that
begin alike share nodes however many they are.  Every node's formatted text is
emitted once, depth first, with its position (the characters before it on its
path) and its attention intervals: the merged ranges of the layout that its
ancestors and itself occupy.

No row and nothing on the driver grows with a conversation's length.  Turns
are sorted into range blocks that may cut a conversation; a block's hashes are
made without the blocks before it, and one row a block carries id, depth and
position on.  A node belongs to the smallest conversation through it, so a
conversation's own nodes are the end of its path, one gapless range.  The
child of the same conversation is laid out first, then the others by
conversation.  Conversations are sorted by the list of conversations that own
parts of their path, which is as long as the path has branches to others, as
are the intervals; a running sum of sizes gives the places.

Rows are taken in the order of turn, role and text.  Rows of one conversation,
turn and role whose texts are over KEY_CHARS long and begin alike share a
task.  Null texts and roles are empty.  Rows with a null conversation id are
one conversation.  Repeated rows are repeated turns.  Conversations without
rows do not exist; an empty table gives empty results.  Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incidex.llm.common import write_shared

# how turns are marked; other roles: "<|role|>text<|end|>" with the role percent-encoded
TEMPLATE = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>")}
CONTROL = r"(<|\[)(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|)"
_ESCAPE = re.compile(CONTROL)
_UNESCAPE = re.compile(r"(<|\[)\\(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|)")
LOSS_ROLE = "assistant"
BATCH_ROWS = 2000
PRIME = 2 ** 127 - 1
KEY_CHARS = 128     # of a text in the sort key that cuts the blocks
PATH_CHUNK = 1024   # nodes in one row of ``PrefixTree.paths``
LAYOUT_BLOCK = 1024   # characters of the layout by which intervals meet nodes


def escape(text: str) -> str:
    """Put a backslash behind the first character of every control string (one
    more where there are some already)."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def marks(role: str) -> tuple[str, str]:
    return TEMPLATE[role] if role in TEMPLATE else (f"<|{quote(role, safe='')}|>", "<|end|>")


def format_turn(role: str, text: str) -> str:
    before, after = marks(role)
    return before + escape(text) + after


def parse_turn(turn: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if turn.startswith("<|"):
        role, text = turn[2:].split("|>", 1)
        return unquote(role), unescape(text.removesuffix("<|end|>"))
    for role in ("user", "system", "assistant"):
        before, after = TEMPLATE[role]
        if turn.startswith(before):
            return role, unescape(turn[len(before):len(turn) - len(after)])
    raise ValueError(f"not a formatted turn: {turn[:40]!r}")


# kind 0: a turn; ends is null for the last of its block.  kind 1: a block, its first conversation ...
_HASHED = ("kind int, block int, conv string, head boolean, depth int, node binary, pos long, ends boolean, formatted string, "
           "loss_from int, loss_chars int, chars long, tail_conv string, tail_depth int, tail_node binary, tail_pos long")
_HASHED_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.binary(), pa.int64(), pa.bool_(), pa.string(),
                 pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int64()]


def _batches(rows: Iterator[tuple], ddl: str, types: list) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in re.split(r", (?![^<]*>)", ddl)]
    part = []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names=names)

    for row in rows:
        part.append(row)
        if len(part) >= BATCH_ROWS:
            yield out()
            part = []
    if part:
        yield out()


def hash_base(key: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(key, digest_size=16).digest(), "little") % (PRIME - 2) + 2


def hashed_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str, base: int) -> DataFrame:
    """Sorted blocks of turns (kind 0: formatted text, where its loss lies) and one row for
    each block (kind 1).  The first conversation of a block (head) counts depth, position and
    node from the block's beginning, the others from their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()

        def rows():
            now, head, depth, value, pos, held, first = None, True, 0, 0, 0, None, None
            for batch in batches:
                for c, r, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if held:
                        yield (*held[:7], c != now, *held[8:])
                    if c != now:
                        if now is not None and head:
                            first, head = (now, depth, value, pos), False
                        now, depth, value, pos = c, 0, 0 if head else 1, 0
                    h = hashlib.blake2b(digest_size=16)
                    for x in (r, t):
                        x = x.encode()
                        h.update(len(x).to_bytes(8, "little"))
                        h.update(x)
                    value = (value * base + int.from_bytes(h.digest(), "little")) % PRIME
                    formatted = format_turn(r, t)
                    before, after = marks(r)
                    loss = r == LOSS_ROLE
                    held = (0, block, c, head, depth, value.to_bytes(16, "little"), pos, None, formatted, len(before) if loss else 0,
                            len(formatted) - len(before) - len(after) if loss else 0, len(formatted), None, None, None, None)
                    depth, pos = depth + 1, pos + len(formatted)
            if held:
                yield held
                c, d, v, p = first or (now, depth, value, pos)
                yield (1, block, c, head, d, v.to_bytes(16, "little"), p, None, None, None, None, None,
                       now, depth, value.to_bytes(16, "little"), pos)
        return _batches(rows(), _HASHED, _HASHED_TYPES)

    def column(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = conversations.select(F.coalesce(F.col(conv).cast("string"), F.lit("null")).alias("conv"),
                                column(role).alias("role"), column(text).alias("text"), F.col(turn).alias("turn"))
    # equal rows may stand in any order, so a running id parts them
    tie = F.when(F.length("text") <= KEY_CHARS, F.monotonically_increasing_id()).otherwise(F.lit(0))
    rows = rows.withColumn("begins", F.substring("text", 1, KEY_CHARS)).withColumn("tie", tie)
    return (rows.repartitionByRange("conv", "turn", "role", "begins", "tie").sortWithinPartitions("conv", "turn", "role", "text")
            .select("conv", "role", "text").mapInArrow(run, _HASHED))


def carried(hashed: DataFrame, base: int) -> DataFrame:
    """Turns with node, depth and position from the beginning of their conversation, and
    whether they are its last."""
    begin: dict[int, tuple[int, int, int]] = {}
    over: dict[int, bool] = {}
    conv, state, block = None, (0, 1, 0), None
    blocks = hashed.where("kind = 1").select("block", "conv", "head", "depth", "node", "pos", "tail_conv", "tail_depth", "tail_node", "tail_pos")
    for r in sorted(blocks.collect(), key=lambda r: r["block"]):       # one row a block
        if block is not None:
            over[block] = r["conv"] != conv
        block = r["block"]
        begin[block] = state if r["conv"] == conv else (0, 1, 0)
        conv = r["tail_conv"]
        if r["head"]:       # the block has one conversation
            depth, value, pos = begin[block]
            state = (depth + r["depth"], (value * pow(base, r["depth"], PRIME) + int.from_bytes(r["node"], "little")) % PRIME, pos + r["pos"])
        else:
            state = (r["tail_depth"], int.from_bytes(r["tail_node"], "little"), r["tail_pos"])
    if block is not None:
        over[block] = True

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in ("block", "head", "depth", "node", "pos", "ends")}
            block, head, depth, node, pos, ends = (batch.column(i).to_pylist() for i in at.values())
            for i, (k, first) in enumerate(zip(block, head, strict=True)):
                if first:
                    d, value, p = begin[k]
                    value = (value * pow(base, depth[i] + 1, PRIME) + int.from_bytes(node[i], "little")) % PRIME
                    depth[i], node[i], pos[i] = depth[i] + d, value.to_bytes(16, "little"), pos[i] + p
                if ends[i] is None:
                    ends[i] = over[k]
            for n, values in (("depth", depth), ("node", node), ("pos", pos), ("ends", ends)):
                batch = batch.set_column(at[n], batch.schema.field(at[n]), pa.array(values, batch.schema.field(at[n]).type))
            yield batch

    turns = hashed.where("kind = 0").select("block", "head", "conv", "depth", "node", "pos", "ends", "chars", "formatted", "loss_from", "loss_chars")
    return turns.mapInArrow(place, turns.schema).drop("block", "head")


def layout(links: DataFrame) -> DataFrame:
    """``(owner, own_pos, own_start, before)``: for each conversation that owns nodes, where
    its own part begins on its path and in the layout, and the merged ranges of the part before."""
    spark = links.sparkSession
    owners = links.groupBy("node").agg(F.min("conv").alias("owner"))
    parts = (links.select("node", "conv", "depth", "pos", "chars").join(owners, "node").groupBy("conv", "owner")
             .agg(F.min("depth").alias("depth"), F.min("pos").alias("pos"), F.max(F.col("pos") + F.col("chars")).alias("end")))
    parts = write_shared(parts, "parts")
    own = parts.where("conv = owner").select("conv", F.col("pos").alias("own_pos"), (F.col("end") - F.col("pos")).alias("size"))
    # deeper branches come before shallower ones, as the way back from the end of a path meets them
    order = F.sort_array(F.collect_list(F.struct("depth", "owner")))
    keys = (parts.groupBy("conv").agg(order.alias("order")).join(own, "conv")
            .withColumn("order", F.transform("order", lambda x: F.struct((-x["depth"]).alias("depth"), x["owner"].alias("owner")))))
    keys = write_shared(keys.repartitionByRange("order").withColumn("block", F.spark_partition_id()), "order")
    sums = sorted(keys.groupBy("block").agg(F.sum("size").alias("n")).collect(), key=lambda r: r["block"])
    bases, at = [], 0
    for r in sums:
        bases.append((r["block"], at))
        at += r["n"]
    bases = spark.createDataFrame(bases, "block int, base long")
    earlier = Window.partitionBy("block").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    starts = (keys.withColumn("sum", F.coalesce(F.sum("size").over(earlier), F.lit(0))).join(F.broadcast(bases), "block")
              .select(F.col("conv").alias("owner"), "own_pos", (F.col("base") + F.col("sum")).alias("own_start")))
    starts = write_shared(starts, "starts")
    ranges = (parts.where("conv <> owner").join(starts, "owner")
              .select("conv", "depth", F.col("own_start").alias("a"), (F.col("own_start") + F.col("end") - F.col("pos")).alias("b")))
    held = F.transform(F.sort_array(F.collect_list(F.struct("depth", "a", "b"))), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    ranges = ranges.groupBy(F.col("conv").alias("owner")).agg(held.alias("r")).select("owner", F.expr(
        "zip_with(filter(r, (x, i) -> i = 0 OR get(r, i - 1).b <> x.a), filter(r, (x, i) -> i = size(r) - 1 OR get(r, i + 1).a <> x.b), "
        "(x, y) -> named_struct('a', x.a, 'b', y.b))").alias("before"))
    return starts.join(ranges, "owner", "left")


class PrefixTree:
    """``nodes``: every node once, with formatted text, place, position and
    attention intervals; ``paths``: distinct conversations as lists of nodes, in
    rows of PATH_CHUNK of them; ``conversations``: the last node of each
    conversation.  With a secret ``key`` nobody can make two prefixes of one id."""

    def __init__(self, conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", key: bytes = b""):
        self.key, self.key_type = conv, conversations.schema[conv].dataType
        base = hash_base(key)
        turns = carried(write_shared(hashed_turns(conversations, conv, turn, role, text, base), "turns"), base)
        links = write_shared(turns.select("conv", "depth", "node", "pos", "chars", "ends"), "links")
        self.conversations = links.where("ends").select("conv", F.col("node").alias("leaf"), (F.col("depth") + 1).alias("depth"))
        one = self.conversations.groupBy("leaf").agg(F.min("conv").alias("conv"))
        self.steps = links.join(one, "conv").select("leaf", "depth", "node", "chars")
        held = F.sort_array(F.collect_list(F.struct("depth", "node", "chars")))
        self.paths = (self.steps.groupBy("leaf", F.floor(F.col("depth") / PATH_CHUNK).alias("chunk")).agg(held.alias("s"))
                      .select("leaf", "chunk", F.col("s.node").alias("path"), F.col("s.chars").alias("chars")))
        told = F.struct("depth", "pos", "chars", "formatted", "loss_from", "loss_chars")
        texts = (turns.groupBy("node").agg(F.min("conv").alias("owner"), F.max("ends").alias("leaf"), F.first(told).alias("x"))
                 .select("node", "owner", "leaf", "x.*"))
        start = F.col("own_start") + F.col("pos") - F.col("own_pos")
        nodes = texts.join(layout(links), "owner").withColumn("start", start)
        nodes = nodes.withColumn("intervals", F.expr(
            "CASE WHEN before IS NULL THEN array(named_struct('a', own_start, 'b', start + chars)) "
            "WHEN element_at(before, -1).b = own_start THEN concat(slice(before, 1, size(before) - 1), "
            "array(named_struct('a', element_at(before, -1).a, 'b', start + chars))) "
            "ELSE concat(before, array(named_struct('a', own_start, 'b', start + chars))) END"))
        self.nodes = write_shared(nodes.select("node", "start", F.col("pos").alias("position"), F.col("chars").cast("int").alias("chars"),
                                               "intervals", "leaf", "depth", "formatted", "loss_from", "loss_chars"), "nodes")

    def read_back(self) -> DataFrame:
        """One row per conversation, from the emitted layout alone: number of turns,
        digests of turns and of the text under the loss mask, characters.

        A conversation is what the intervals of its last node show of the layout: the
        nodes that start in them, in layout order.  Intervals meet nodes by blocks of
        the layout.  A place, position or interval that does not fit raises ValueError;
        a conversation without any has nulls."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows():
                now = last = None

                def whole_path():
                    if last != now:
                        raise ValueError(f"the intervals of node {now.hex()} do not end with it")

                for batch in batches:
                    for leaf, node, position, formatted, at, n in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                        if leaf != now:
                            if now is not None:
                                whole_path()
                                yield now, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), total
                            now, turns, total, loss_chars = leaf, 0, 0, 0
                            whole, loss = hashlib.sha256(), hashlib.sha256()
                        if position != total:
                            raise ValueError(f"node {node.hex()} at position {position} follows {total} characters")
                        role, text = parse_turn(formatted)
                        whole.update(f"{role}\n{text}\n".encode())
                        under = unescape(formatted[at:at + n])
                        loss.update(under.encode())
                        turns, total, loss_chars, last = turns + 1, total + len(formatted), loss_chars + len(under), node
                if now is not None:
                    whole_path()
                    yield now, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), total
            return _batches(rows(), out, [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])

        out = "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
        shown = (self.nodes.where("leaf").select(F.col("node").alias("leaf"), F.inline("intervals"))
                 .withColumn("block", F.explode(F.expr(f"sequence(a div {LAYOUT_BLOCK}, (b - 1) div {LAYOUT_BLOCK})"))))
        placed = self.nodes.select(F.expr(f"start div {LAYOUT_BLOCK}").alias("block"), "start", "node", "position", "formatted",
                                   "loss_from", "loss_chars")
        told = (shown.join(placed, "block").where("start >= a AND start < b")
                .repartition("leaf").sortWithinPartitions("leaf", "start")
                .select("leaf", "node", "position", "formatted", "loss_from", "loss_chars").mapInArrow(run, out))
        key = F.when(F.col("conv") != "null", F.col("conv")).cast(self.key_type).alias(self.key)
        return (self.conversations.join(told, "leaf", "left")
                .select(key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))
