"""Chat formatting: conversations as one prefix tree of formatted turns.

Conversations that share their first turns share those tokens: a turn is a node, named by
the hash of all turns up to it, and each node's text is emitted once, depth first.  A
token is a code point of the formatted text.  Its place in the tree's stream, its position
in a conversation and the intervals of the stream that it may attend to are three things:

    tokens   (tree, start, edge, position, text, loss_from, loss_to)   a row a turn of the tree
    paths    (conv_id, n_turns, tree, intervals)                       a row a conversation

An *edge* is a run of turns without a branch.  A conversation is the intervals of its
edges, in order; the tokens of an edge attend to those before it in that list and to the
earlier ones of their own edge.  Positions count on along the path, whatever lies between.

No task holds a tree or a conversation's texts: turns stream through sorted partitions,
conversations are ordered by the edges of their paths (which is depth-first order), and
offsets are running sums within range partitions plus one number a partition.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from attrix.llm.common import stored
from attrix.session import scratch_path

# The template.  Fixed control strings; texts hold them only behind the escape character.
BEGIN, END = "<s>", "</s>"
USER, USER_END = "[INST] ", " [/INST]"
SYSTEM, SYSTEM_END = "[SYS] ", " [/SYS]"
ROLE, ROLE_END = "[ROLE] ", " [/ROLE]"
ANSWER = " "             # between the turn before and an assistant's text
ESCAPE = "\\"
CONTROL = r"</?s>|\[/?(?:INST|SYS|ROLE)\]"

_NEXT = regex.compile(rf"\\.|{CONTROL}", regex.DOTALL)
_ESCAPED = regex.compile(r"\\(.)", regex.DOTALL)


def escape(col):
    """Column: every control string and escape character of a text behind an escape character."""
    return F.regexp_replace(col, rf"(\\|{CONTROL})", r"\\$1")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role, text, first):
    """Columns (text, loss_from, loss_to) of one formatted turn; an assistant's text is under the loss mask."""
    body, begin = escape(text), F.when(first, F.lit(BEGIN)).otherwise(F.lit(""))
    lead = (F.when(role == "user", F.lit(USER)).when(role == "system", F.lit(SYSTEM)).when(role == "assistant", F.lit(ANSWER))
            .otherwise(F.concat(F.lit(ROLE), escape(role), F.lit(ROLE_END + ANSWER))))
    tail = F.when(role == "user", F.lit(USER_END)).when(role == "system", F.lit(SYSTEM_END)).otherwise(F.lit(END))
    start = F.char_length(begin) + F.char_length(lead)
    answer = role == "assistant"
    return (F.concat(begin, lead, body, tail).alias("text"), F.when(answer, start).otherwise(0).alias("loss_from"),
            F.when(answer, start + F.char_length(body)).otherwise(0).alias("loss_to"))


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text that starts at a turn."""
    turns, at = [], len(BEGIN) if formatted.startswith(BEGIN) else 0

    def until(close: str, start: int) -> tuple[str, int]:
        mark = close.strip()
        for found in _NEXT.finditer(formatted, start):
            if found.group() == mark:
                if formatted[found.start() - (len(close) - len(mark)):found.end()] != close:
                    break
                return unescape(formatted[start:found.start() - (len(close) - len(mark))]), found.end()
            if not found.group().startswith(ESCAPE):
                break
        raise ValueError(f"no {close!r} closes the turn at {start}")

    while at < len(formatted):
        role = "assistant"
        for name, lead, close in (("user", USER, USER_END), ("system", SYSTEM, SYSTEM_END)):
            if formatted.startswith(lead, at):
                text, at = until(close, at + len(lead))
                turns.append((name, text))
                break
        else:
            if formatted.startswith(ROLE, at):
                role, at = until(ROLE_END, at + len(ROLE))
            if not formatted.startswith(ANSWER, at):
                raise ValueError(f"no turn starts at {at}")
            text, at = until(END, at + len(ANSWER))
            turns.append((role, text))
    return turns


def _name_nodes(batches):
    """Turns, sorted by conversation, to (c, k, node, size): k counts turns, a node is the hash of all up to its own."""
    now, k, node = None, 0, b""
    for b in batches:
        cs, rows = b.column(0).to_pylist(), b.column(1).to_pylist()
        ks, nodes = [], []
        for c, h in zip(cs, rows):
            if c != now:
                now, k, node = c, 0, b""
            node = hashlib.blake2b(node + h, digest_size=16).digest()
            ks.append(k)
            nodes.append(node)
            k += 1
        yield pa.record_batch([b.column(0), pa.array(ks, pa.int64()), pa.array(nodes, pa.binary()), *b.columns[2:]],
                              names=["c", "k", "node", *b.schema.names[2:]])


def _name_edges(batches):
    """Nodes, sorted by conversation, with their edge, place in it and position; an edge ends where the tree branches."""
    now, count, edge, inside, position = None, 0, b"", 0, 0
    for b in batches:
        edges, places, positions = [], [], []
        for c, node, size, n in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
            if c != now:
                now, count, position = c, 0, 0
            if n != count:
                count, edge, inside = n, node, 0
            edges.append(edge)
            places.append(inside)
            positions.append(position)
            inside += size
            position += size
        yield pa.record_batch([*b.columns[:4], pa.array(edges, pa.binary()), pa.array(places, pa.int64()), pa.array(positions, pa.int64())],
                              names=["c", "k", "node", "size", "edge", "inside", "position"])


def _ranged(df: DataFrame, *cols) -> DataFrame:
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)


def format_conversations(turns: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the prefix tree of all conversations; returns its tables ``tokens`` and ``paths`` (see the module).

    ``turns`` has conv_id, turn, role and text.  A conversation's turns are ordered by turn
    (nulls first), equal ones by content, and all stay, rows that repeat too.  Rows without a
    conv_id are one conversation.  A null role or text is empty.  Other columns are ignored; an
    empty table gives empty tables.  Conversations with equal turns share all tokens.
    ``path`` is where the tables go (default: a new folder in the shared folder).
    """
    spark = turns.sparkSession
    path = path or scratch_path(spark, "chat")
    ids = dict(turns.dtypes)["conv_id"]
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # a conversation's own key: unlike null, it meets itself in a join
    own = turns.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("c"), "conv_id",
                       "turn", role.alias("role"), text.alias("text"))
    h = F.unhex(F.sha2(F.concat(F.col("role"), F.lit("\n"), F.col("text")), 256))
    # k is only known below, so the first turn's longer text is measured there; content breaks ties of turn
    plain = own.select("c", h.alias("h"), "conv_id", "turn", "role", "text")
    sorted_turns = plain.repartition("c").sortWithinPartitions("c", "turn", "h")
    named = sorted_turns.select("c", "h", "conv_id", "role", "text").mapInArrow(
        _name_nodes, f"c string, k long, node binary, conv_id {ids}, role string, text string")
    pieces = stored(named.select("c", "k", "node", "conv_id", *format_turn(F.col("role"), F.col("text"), F.col("k") == 0)), "turns")

    nodes = pieces.select("c", "k", "node", F.char_length("text").cast("long").alias("size"))
    shared = stored(nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    counted = (nodes.join(shared, "node", "left").select("c", "k", "node", "size", F.coalesce("n", F.lit(1).cast("long")).alias("n"))
               .repartition("c").sortWithinPartitions("c", "k"))
    steps = stored(counted.mapInArrow(_name_edges, "c string, k long, node binary, size long, edge binary, inside long, position long"), "steps")

    # a conversation's path; sorted by their paths, conversations stand in depth-first order
    first = F.when(F.col("node") == F.col("edge"), F.struct("k", "edge", "position"))
    paths = (steps.groupBy("c").agg(F.sort_array(F.collect_list(first)).alias("path"), F.count("*").alias("n_turns"))
             .withColumn("order", F.transform("path", lambda s: s["edge"])))
    paths = stored(_ranged(paths, "order", "c").select("c", "n_turns", "path", F.monotonically_increasing_id().alias("rank")), "paths")
    at = F.posexplode("path").alias("i", "s")
    seen = paths.select("c", "rank", F.col("path")[0]["edge"].alias("tree"), at)
    owners = (seen.groupBy(F.col("s.edge").alias("edge"))
              .agg(F.min(F.struct("rank", "i", "c")).alias("owner"), F.first("tree").alias("tree")))
    sizes = steps.groupBy("edge").agg(F.max(F.col("inside") + F.col("size")).alias("size"))
    edges = _ranged(owners.join(sizes, "edge").select("edge", "tree", "owner", "size"), "owner").withColumn("p", F.spark_partition_id())
    edges = stored(edges, "edges")
    # where an edge starts: sizes before it in its partition, plus the partitions before, less where its tree starts
    within = F.sum("size").over(Window.partitionBy("p").orderBy("owner")) - F.col("size")
    before = edges.groupBy("p").agg(F.sum("size").alias("s"))
    before = before.select("p", (F.sum("s").over(Window.orderBy("p")) - F.col("s")).alias("before"))   # a row a partition
    placed = stored(edges.withColumn("at", within).join(F.broadcast(before), "p")
                    .select("edge", "tree", "owner", "size", (F.col("at") + F.col("before")).alias("at")), "placed")
    roots = placed.groupBy("tree").agg(F.min("at").alias("root"))
    placed = stored(placed.join(stored(roots, "roots"), "tree")
                    .select("edge", F.hex("tree").alias("tree"), F.col("owner.c").alias("c"), (F.col("at") - F.col("root")).alias("start"), "size"), "edge_places")

    # each turn of the tree once, from the conversation that owns its edge
    mine = steps.join(placed.drop("size"), ["edge", "c"]).select("c", "k", "tree", "edge", (F.col("start") + F.col("inside")).alias("start"),
                                                  F.col("start").alias("edge_start"), "position")
    tokens = (pieces.join(mine, ["c", "k"])
              .select("tree", "start", "edge_start", "position", "text", "loss_from", "loss_to"))
    _ranged(tokens, "tree", "start").write.parquet(f"{path}/tokens")
    names = pieces.where("k = 0").select("c", "conv_id")
    spans = (paths.select("c", "n_turns", F.posexplode("path").alias("i", "s")).select("c", "n_turns", "i", F.col("s.edge").alias("edge"))
             .join(placed.select("edge", "tree", "start", (F.col("start") + F.col("size")).alias("end")), "edge"))
    (spans.groupBy("c").agg(F.first("n_turns").alias("n_turns"), F.first("tree").alias("tree"),
                            F.sort_array(F.collect_list(F.struct("i", "start", "end"))).alias("spans"))
     .select("c", "n_turns", "tree", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("intervals"))
     .join(names, "c").select("conv_id", "n_turns", "tree", "intervals").write.parquet(f"{path}/paths"))
    return spark.read.parquet(f"{path}/tokens"), spark.read.parquet(f"{path}/paths")


def read_conversations(tokens: DataFrame, paths: DataFrame) -> DataFrame:
    """(c, conv_id, position, text, loss_from, loss_to): the formatted turns of every conversation, by its path's intervals."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    spans = paths.select(key.alias("c"), "conv_id", "tree", F.explode("intervals").alias("s")).select(
        "c", "conv_id", "tree", F.col("s.start").alias("edge_start"))
    return spans.join(tokens, ["tree", "edge_start"]).select("c", "conv_id", "position", "text", "loss_from", "loss_to")


def _digest(batches):
    now, row, said, loss = None, None, None, None
    schema = ["c", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def close():
        row[2], row[4] = said.hexdigest(), loss.hexdigest()
        return row

    for b in batches:
        done = []
        for c, position, text, low, high in zip(*(b.column(i).to_pylist() for i in range(5))):
            if c != now:
                if row is not None:
                    done.append(close())
                now, row, said, loss = c, [c, 0, "", 0, "", 0], hashlib.sha256(), hashlib.sha256()
            if position != row[5]:
                raise ValueError(f"position {position} of conversation {c} follows {row[5]}")
            for role, turn in parse(text):
                row[1] += 1
                said.update(f"{role}\n{turn}\n".encode())
            under = unescape(text[low:high])
            row[3] += len(under)
            loss.update(under.encode())
            row[5] += len(text)
        if done:
            yield pa.record_batch([pa.array(x) for x in zip(*done)], names=schema)
    if row is not None:
        yield pa.record_batch([pa.array([x]) for x in close()], names=schema)


def conversation_digests(tokens: DataFrame, paths: DataFrame) -> DataFrame:
    """Per conversation, read back from the written tree: turns, text under the loss mask, and the formatted length."""
    turns = read_conversations(tokens, paths).select("c", "position", "text", "loss_from", "loss_to")
    found = turns.repartition("c").sortWithinPartitions("c", "position").mapInArrow(
        _digest, "c string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    return found.join(paths.select(key.alias("c"), "conv_id"), "c").select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
