"""Repair of conversation structure: cheapest edits, ties ranked by prefix doubling.

A conversation is well formed if its roles' initials are nothing, or an optional system message
and then pairs of user and assistant. Rows are kept (0), given the role user or assistant (1) or
deleted (2, a must for blank and duplicate rows); messages without text are inserted (5); a
truncated row that is not deleted costs 5 more.

A node is a place between rows together with what was put out last: nothing, system, user or
assistant. Rows are cut into blocks of ``BLOCK`` in their order. The cost DP runs backwards: over
a block whose costs behind it are known, or, for conversations of several blocks, first as a table
of costs from each state at a block's start to each at its end. These tables, sixteen numbers a
block, are folded per conversation and give every block the costs behind it.

Arcs that keep to the least cost are optimal. All nodes of a block are ranked by the least audit
of one arc, and of two, four, eight and so on arcs: the rank of a node's next ``2n`` arcs is that
of its rank over ``n`` and the rank of the node that its pointer over ``n`` leads to, and pointers
double alike. A node's arcs are compared by their own letter and then by the rank of where they
lead. A node has at most one arc per letter (keeping, giving a role and inserting each lead to one
state), so pointers are unique. The least path is unrolled by the doubled pointers, from one node
to two, four and so on. Blocks do this for all four states they can be entered in; which one it is
follows by one more fold over the blocks.

Equal rows of one turn fall together first. The copies behind the first are duplicates and
have to go; an insertion never stands before a deletion in the least audit, so they are
deleted right behind their first row and need no nodes.

The hash of a repaired conversation depends on its whole text in order, so its rows pass one task,
which takes them batch by batch and holds none. All other work on a conversation of any size is
spread over blocks.

Defined results: a null role or text counts as one blank; a role's initial is its first
character, and an empty role has one that fits nowhere. Null turns come first; rows that share a
turn are ordered by hash of role and text. Rows with a null conversation id are one conversation.
Long texts are read whole. Repeated rows are rows of their own. An empty table gives no rows.
Other columns are not read, whatever their names.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.frames import BLANKS, let
from ringledger.operators.numbering import number_rows
from ringledger.operators.staging import staged

BLOCK = 4096
# Nodes ranked at once.
CHUNK = 1 << 16
RETYPE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# Where a user and where an assistant message may follow.
BEFORE_USER = (START, SYSTEM, ASSISTANT)
NEVER = 1 << 40
# Letters of the audit in the order of their codes.
DROP, ADD, KEEP, GIVE = range(1, 5)
LETTERS = {DROP: "D", ADD: "I", KEEP: "K", GIVE: "R"}
ROLES = {USER: "user", ASSISTANT: "assistant"}

# Faults of a row.
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


def prepared(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """``conv, turn, mark, role, text, copies`` per row: nulls filled, ``mark`` a hash of role
    and text, ``copies`` 1."""
    return _marked(rows.select(
        F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"), F.lit(1).alias("copies"),
    ))


def _marked(rows: DataFrame) -> DataFrame:
    mark = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return rows.select("conv", "turn", F.unhex(mark).alias("mark"), "role", "text", "copies")


def damaged(rows: DataFrame) -> DataFrame:
    """``prepared`` rows as a deterministic test damages them, by a hash of id and turn.

    Of twenty residues, 0 drops the row (``copies`` 0), 1 empties its text, 2 takes the ends of
    its sentences, 3 doubles it and 4 makes it the user's.
    """
    key = F.concat(
        F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    how = (F.crc32(key.cast("binary")) % 20).alias("how")
    told = rows.select("*", how)
    return _marked(told.select(
        "conv", "turn",
        F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(
            F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")
        ).otherwise(F.col("text")).alias("text"),
        F.when(F.col("how") == 0, 0).when(F.col("how") == 3, F.col("copies") * 2)
        .otherwise(F.col("copies")).alias("copies"),
    ))


def _slim(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn and mark: state, fault and the number of copies."""
    def end(text: Column) -> Column:
        return let(F.rtrim(text, F.lit(BLANKS)), lambda bare: F.when(bare == "", BLANK).when(
            ~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED))

    initial = F.substring("role", 1, 1)
    state = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(
        initial == "a", ASSISTANT).otherwise(START)
    told = rows.select("conv", "turn", "mark", "copies", state.cast("int").alias("state"),
                       end(F.col("text")).alias("fault"))
    return told.groupBy("conv", "turn", "mark").agg(
        F.sum("copies").alias("copies"), F.first("state").alias("state"),
        F.first("fault").alias("fault"),
    )


def _numbered(slim: DataFrame) -> DataFrame:
    """Adds ``row``, the place in the order of conversations and turns, and marks rows whose role
    and text an earlier turn had."""
    first = slim.where("copies > 0").groupBy("conv", "mark").agg(
        F.bool_or(F.col("turn").isNull()).alias("no_turn"), F.min("turn").alias("first_turn"),
        F.count("*").alias("n"),
    ).where("n > 1").select(
        F.col("conv").alias("c"), F.col("mark").alias("m"), "no_turn", "first_turn"
    )
    again = (F.col("no_turn") & F.col("turn").isNotNull()) | (F.col("turn") > F.col("first_turn"))
    met = slim.join(first, slim["conv"].eqNullSafe(first["c"]) & (slim["mark"] == first["m"]), "left")
    told = met.select(
        "conv", "turn", "mark", "copies", "state",
        F.when(F.col("fault") == BLANK, BLANK).when(again, DUPLICATE)
        .otherwise(F.col("fault")).alias("fault"),
    )
    return number_rows(told, "conv", "turn", "mark", name="row")


def _blocks(numbered: DataFrame, block: int) -> DataFrame:
    """One row per conversation and block with its rows in order."""
    held = F.struct("row", "turn", "copies", "state", "fault")
    return numbered.groupBy("conv", F.expr(f"(row - 1) div {block}").alias("block")).agg(
        F.array_sort(F.collect_list(held)).alias("rows")
    )


class Block:
    """Rows of one block that are there, as arrays."""

    def __init__(self, rows: list[dict]):
        self.end = max((row["row"] for row in rows), default=0) + 1
        rows = [row for row in rows if row["copies"]]
        self.rows = [row["row"] for row in rows]
        self.turns = [row["turn"] for row in rows]
        self.copies = [row["copies"] for row in rows]
        self.states = [row["state"] for row in rows]
        self.faults = [row["fault"] for row in rows]
        self.forced = [fault in (BLANK, DUPLICATE) for fault in self.faults]
        self.extra = [CUT_OFF if fault == TRUNCATED else 0 for fault in self.faults]

    def counts(self) -> dict[str, int]:
        """Faults, forbidden neighbours and turns within the block."""
        again = sum(n - 1 for n, fault in zip(self.copies, self.faults) if fault != BLANK)
        pairs = sum(_illegal(a, b) for a, b in zip(self.states, self.states[1:]))
        known = [turn for turn in self.turns if turn is not None]
        return {
            BLANK: sum(n for n, fault in zip(self.copies, self.faults) if fault == BLANK),
            DUPLICATE: again + self.faults.count(DUPLICATE),
            TRUNCATED: self.faults.count(TRUNCATED),
            "illegal": pairs + sum(n - 1 for n in self.copies),
            "n": len(self.rows), "turns": len(set(known)),
            "low": known[0] if known else None, "high": known[-1] if known else None,
            "left": self.states[0] if self.rows else None,
            "right": self.states[-1] if self.rows else None,
        }

    def moves(self, k: int) -> list[tuple[int, int, int, int]]:
        """``state, next state, cost, letter`` of every arc over row ``k``; the duplicates
        behind it are deleted with it."""
        spare = DELETE * (self.copies[k] - 1)
        found = [(state, state, DELETE + spare, DROP) for state in range(STATES)]
        if not self.forced[k]:
            cost = self.extra[k] + spare
            own = self.states[k]
            if own == SYSTEM:
                found.append((START, SYSTEM, cost, KEEP))
            for state in range(STATES):
                to = USER if state in BEFORE_USER else ASSISTANT
                if own == to:
                    found.append((state, to, cost, KEEP))
                found.append((state, to, cost + RETYPE, GIVE))
        return found

    def costs(self, behind: list[int]) -> list[list[int]]:
        """The least cost from each state at each place, insertions there among them."""
        found = [behind]
        for k in range(len(self.rows) - 1, -1, -1):
            now = [NEVER] * STATES
            for state, to, cost, _ in self.moves(k):
                now[state] = min(now[state], cost + found[-1][to])
            found.append(with_insertions(now))
        return found[::-1]

    def table(self) -> list[int]:
        """The least cost from each state at the start to each at the end."""
        exits = [
            self.costs([0 if state == end else NEVER for state in range(STATES)])[0]
            for end in range(STATES)
        ]
        return [exits[end][state] for state in range(STATES) for end in range(STATES)]


def with_insertions(costs: list[int]) -> list[int]:
    """The least costs if user and assistant messages may be put in before."""
    user = min(costs[USER], costs[ASSISTANT] + INSERT)
    assistant = min(costs[ASSISTANT], costs[USER] + INSERT)
    return [min(costs[START], user + INSERT), min(costs[SYSTEM], user + INSERT), user, assistant]


# Costs behind the last row: nothing put out and complete pairs are well formed.
AT_END = with_insertions([0, NEVER, NEVER, 0])


def _illegal(left: int, right: int) -> bool:
    return (left, right) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


class Paths:
    """The optimal arcs of some blocks, ranked; ``node`` is 4 * place + state."""

    def __init__(self, blocks: list[tuple[Block, list[int], bool, bool]]):
        arcs, self.starts, self.costs, base = [], [], [], 0
        for block, behind, last, _ in blocks:
            costs = block.costs(behind)
            self.starts.append(base)
            self.costs.append(costs[0][START])
            for place, now in enumerate(costs):
                at = base + STATES * place
                ends = place == len(block.rows)
                if not ends:
                    after = costs[place + 1]
                    arcs += [(at + s, letter, at + STATES + to) for s, to, cost, letter in
                             block.moves(place) if now[s] == cost + after[to] < NEVER]
                if not ends or last:
                    arcs += [
                        (at + s, ADD, at + to) for s in range(STATES)
                        for to in [USER if s in BEFORE_USER else ASSISTANT]
                        if now[s] == INSERT + now[to] < NEVER
                    ]
            base += STATES * len(costs)
        self._ranked(np.array(arcs, dtype=np.int64).reshape(-1, 3), base)

    def _ranked(self, arcs: np.ndarray, n: int) -> None:
        source, letter, to = arcs.T
        # A node without an arc is the end of its audit and leads to itself.
        ranks = np.zeros(n, dtype=np.int64)
        self.letters, pointers, span = np.zeros(n, np.int64), np.arange(n), 1
        order = np.lexsort((letter, source))
        first = order[np.unique(source[order], return_index=True)[1]]
        self.letters[source[first]], pointers[source[first]] = letter[first], to[first]
        ranks[:] = self.letters
        self.pointers = [pointers]
        while True:
            # Audits twice as long: of the next arcs and of those behind the pointer.
            ahead = self.pointers[-1]
            pairs = ranks * (int(ranks.max(initial=0)) + 1) + ranks[ahead]
            longer = np.unique(pairs, return_inverse=True)[1]
            doubled = ahead[ahead]
            if (doubled == ahead).all():
                break
            ranks, span = longer, 2 * span
            self.pointers.append(doubled)
        # Arcs by their letter, then by the rank of where they lead.
        order = np.lexsort((ranks[to], letter, source))
        best = order[np.unique(source[order], return_index=True)[1]]
        self.pointers[0][source[best]] = to[best]
        self.ranks = ranks

    def unrolled(self, node: int) -> np.ndarray:
        """All nodes of the least path from a node, by doubled pointers."""
        path = np.array([node])
        for pointers in self.pointers:
            path = np.concatenate((path, pointers[path]))
        ends = np.flatnonzero(self.letters[path] == 0)
        return path[: ends[0] + 1]


def _solved(blocks: list[tuple[Block, list[int], bool, bool]]) -> Iterator[tuple[int, list[tuple]]]:
    """Per block its least cost from the start, and per state it is entered in: state at the end,
    audit and messages put out. A block that is a conversation's only one is entered in one.

    A message is a row that stays, with its new role if it gets one, or one that is put in before
    a row or at the end.
    """
    paths = Paths(blocks)
    for (block, _, _, alone), start, cost in zip(blocks, paths.starts, paths.costs):
        found = []
        for entry in [START] if alone else range(STATES):
            nodes = paths.unrolled(start + entry)
            letters, nodes = paths.letters[nodes[:-1]].tolist(), (nodes - start).tolist()
            audit, out = [], []
            for node, letter, then in zip(nodes, letters, nodes[1:]):
                place, put_in = node // STATES, letter == ADD
                audit.append(LETTERS[letter])
                if not put_in:
                    audit.append("D" * (block.copies[place] - 1))
                if letter != DROP:
                    role = None if letter == KEEP else ROLES[then % STATES]
                    at = block.rows[place] if place < len(block.rows) else block.end
                    out.append({"row": at, "put_in": put_in, "role": role})
            found.append((nodes[-1] % STATES, "".join(audit), out))
        yield cost, found


MESSAGE = "row:bigint,put_in:boolean,role:string"
COUNTS = ["blank", "duplicate", "truncated", "illegal", "n", "turns", "low", "high", "left", "right"]
COUNTED_SQL = ", ".join(f"{name} long" for name in COUNTS)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[dict], list[Block]]]:
    """Rows of blocks, as many at a time as bound the nodes."""
    rows, blocks, size = [], [], 0
    for at in range(batch.num_rows):
        row = batch.slice(at, 1).to_pylist()[0]
        block = Block(row.pop("rows"))
        rows.append(row)
        blocks.append(block)
        size += STATES * (len(block.rows) + 1)
        if size >= CHUNK:
            yield rows, blocks
            rows, blocks, size = [], [], 0
    if rows:
        yield rows, blocks


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, blocks in _chunks(batch):
            found = [row | {"costs": block.table()} for row, block in zip(rows, blocks)]
            yield pa.RecordBatch.from_pylist(found, schema=_schema(batch, TABLES))


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs behind every block of a conversation, from the tables of its blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            now, out = AT_END, []
            for block in sorted(row["tables"], key=lambda x: -x["block"]):
                out.append({"conv": row["conv"], "block": block["block"], "behind": now,
                            "last": not out})
                costs = block["costs"]
                now = [
                    min(costs[STATES * state + end] + now[end] for end in range(STATES))
                    for state in range(STATES)
                ]
            yield pa.RecordBatch.from_pylist(out, schema=_schema(batch, BEHIND))


TABLES = [("block", pa.int64()), ("costs", pa.list_(pa.int64()))]
BEHIND = [("block", pa.int64()), ("behind", pa.list_(pa.int64())), ("last", pa.bool_())]
PATHS = [
    ("block", pa.int64()), ("cost", pa.int64()), ("ends", pa.list_(pa.int32())),
    ("audits", pa.list_(pa.string())),
    ("messages", pa.list_(pa.list_(pa.struct([
        ("row", pa.int64()), ("put_in", pa.bool_()), ("role", pa.string())
    ])))), *[(name, pa.int64()) for name in COUNTS],
]


def _schema(batch: pa.RecordBatch, columns: list[tuple]) -> pa.Schema:
    return pa.schema([("conv", batch.schema.field("conv").type), *columns])


def _pathed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, blocks in _chunks(batch):
            told = [
                (block, row["behind"] or AT_END, row["last"] is not False, row["behind"] is None)
                for row, block in zip(rows, blocks)
            ]
            found = [
                {
                    "conv": row["conv"], "block": row["block"], "cost": cost,
                    "ends": [way[0] for way in ways], "audits": [way[1] for way in ways],
                    "messages": [way[2] for way in ways],
                } | block.counts()
                for row, block, (cost, ways) in zip(rows, blocks, _solved(told))
            ]
            yield pa.RecordBatch.from_pylist(found, schema=_schema(batch, PATHS))


def _joined(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """By conversation and block; a null conversation meets itself."""
    named = right.withColumnsRenamed({"conv": "c", "block": "b"})
    same = left["conv"].eqNullSafe(named["c"]) & (left["block"] == named["b"])
    return left.join(named, same, how).drop("c", "b")


def repaired(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Repairs ``prepared`` rows: reports, and the messages of the repaired conversations.

    Reports have ``conv``, the counts of faults, ``cost`` and ``audit``; messages ``conv``, their
    order (``row, put_in, nth``), ``role`` and ``text``.
    """
    numbered = staged(_numbered(_slim(rows)), "numbered-turns")
    kind = numbered.schema["conv"].dataType.simpleString()
    blocks = staged(_blocks(numbered, block), "blocks")
    several = blocks.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv").alias("c"))
    long_ones = blocks.join(several, blocks["conv"].eqNullSafe(several["c"]), "left_semi")
    tables = staged(long_ones.mapInArrow(
        _tables, f"conv {kind}, block long, costs array<long>"
    ), "tables")
    behind = staged(tables.groupBy("conv").agg(
        F.collect_list(F.struct("block", "costs")).alias("tables")
    ).mapInArrow(_behind, f"conv {kind}, block long, behind array<long>, last boolean"), "behind")
    pathed = staged(_joined(blocks, behind).select(
        "conv", "block", "rows", "behind", "last"
    ).mapInArrow(
        _pathed, f"conv {kind}, block long, cost long, ends array<int>, audits array<string>, "
        f"messages array<array<struct<{MESSAGE}>>>, {COUNTED_SQL}"
    ), "paths")
    # Which state each block is entered in, and what its neighbours have in common.
    slim = F.struct("block", "ends", *COUNTS, "cost")
    reports = pathed.groupBy("conv").agg(F.array_sort(F.collect_list(slim)).alias("all"))
    entered = staged(reports.mapInArrow(_entered, (
        f"conv {kind}, block long, entry int, gaps long, blank long, duplicate long, "
        "truncated long, illegal long, cost long"
    )), "entries")
    chosen = _joined(pathed.select("conv", "block", "audits", "messages"), entered, "inner").select(
        *entered.columns, F.get("audits", F.col("entry")).alias("audit"),
        F.get("messages", F.col("entry")).alias("messages"),
    )
    chosen = staged(chosen, "chosen")
    audits = F.array_sort(F.collect_list(F.struct("block", "audit")))
    told = chosen.groupBy("conv").agg(
        *[F.sum(name).alias(name) for name in REPORT],
        F.array_join(F.transform(audits, lambda x: x["audit"]), "").alias("audit"),
    )
    out = chosen.select("conv", F.posexplode("messages").alias("nth", "m")).select(
        "conv", "nth", "m.row", "m.put_in", F.col("m.role").alias("new_role")
    )
    put_in = out.where("put_in").select(
        "conv", "row", "put_in", "nth", F.col("new_role").alias("role"), F.lit("").alias("text")
    )
    kept = out.where("not put_in").join(numbered.select(
        F.col("row").alias("r"), "turn", "mark"), F.col("row") == F.col("r"))
    kept = kept.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("mark").alias("m"),
                       "row", "put_in", "nth", "new_role")
    texts = rows.where("copies > 0").select("conv", "turn", "mark", "role", "text")
    met = texts.join(kept, texts["conv"].eqNullSafe(kept["c"]) & texts["turn"].eqNullSafe(kept["t"])
                     & (texts["mark"] == kept["m"]))
    found = met.select(
        "conv", "row", "put_in", "nth", F.coalesce("new_role", "role").alias("role"), "text"
    )
    return told, found.unionByName(put_in)


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the state it is entered in; the counts of a whole conversation stand on its
    first block, the others have zero."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            state, right, low, high, turns = START, None, None, None, 0
            first = None
            for block in row["all"]:
                sums = dict.fromkeys(REPORT, 0)
                mine = {"conv": row["conv"], "block": block["block"], "entry": state} | sums
                if first is None:
                    first = mine | {"cost": block["cost"]}
                    mine = first
                for name in (BLANK, DUPLICATE, TRUNCATED, "illegal"):
                    first[name] += block[name]
                if block["n"]:
                    first["illegal"] += right is not None and _illegal(right, block["left"])
                    right = block["right"]
                if block["low"] is not None:
                    turns += block["turns"] - (high == block["low"])
                    low, high = block["low"] if low is None else low, block["high"]
                state = block["ends"][state]
                out.append(mine)
            if low is not None:
                first["gaps"] = high - low + 1 - turns
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_schema(batch, [
                ("block", pa.int64()), ("entry", pa.int32()),
                *[(name, pa.int64()) for name in REPORT],
            ]))


def digests(messages: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of all conversations that have messages, each ``role:text``, joined
    by line feeds."""
    kind = messages.schema["conv"].dataType.simpleString()
    line = F.concat("role", F.lit(":"), "text").alias("line")
    # Messages that are put in stand before the row whose number they carry.
    placed = messages.select("conv", "row", (~F.col("put_in")).alias("own"), "nth", line)
    order = ["conv", "row", "own", "nth"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, digest = None, None, None
        for batch in batches:
            out = []
            for conv, row, own, nth, line in zip(*(batch.column(c) for c in range(5))):
                conv, place = (conv.as_py(),), (row.as_py(), own.as_py(), nth.as_py())
                if conv != now:
                    if now is not None:
                        out.append((now[0], digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                elif place == seen:
                    continue  # a copy of the row
                else:
                    digest.update(b"\n")
                seen = place
                digest.update(line.as_py().encode("utf-8", "surrogatepass"))
            if out:
                yield told(out, batch)
        if now is not None:
            yield told([(now[0], digest.hexdigest())], batch)

    def told(out: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"conv": conv, "repaired_sha256": code} for conv, code in out],
            schema=_schema(batch, [("repaired_sha256", pa.string())]),
        )

    return placed.repartition("conv").sortWithinPartitions(*order).mapInArrow(
        hashed, f"conv {kind}, repaired_sha256 string"
    )


def repairs(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Reports of ``prepared`` rows with the hash of every repaired conversation."""
    reports, messages = repaired(rows, block)
    codes = digests(messages).withColumnRenamed("conv", "c")
    nothing = hashlib.sha256().hexdigest()
    return reports.join(codes, reports["conv"].eqNullSafe(codes["c"]), "left").select(
        "conv", *REPORT, "audit",
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
