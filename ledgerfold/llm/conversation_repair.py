"""Conversation structure repair by a persistent audit dynamic program.

Rows of a conversation, in the order of their turns, are kept, given another role, deleted or have
empty turns inserted between them, at least cost, so that the initials of the roles read ``(s?(ua)+)?``.
An audit is the string of the edits' initials; among the cheapest the first in ASCII order counts.

- The state of the program is what the output ended with (nothing, s, u, a).  Each state holds its
  cost and a node of an ``AuditTree``: audits share their beginnings as linked nodes with ancestors at
  powers of two and rolling hashes.  Equal costs are compared by a search for the longest common
  prefix; a prefix found equal by its hash is verified on the nodes' letters.
- Audits of one state and one cost are never beginnings of each other (the longer one would have
  one more insertion, at a cost), so the order of two beginnings is the order of all that follows.
  An insertion right before a deletion is never least, as the deletion can come first: insertions are
  tried before kept rows and at the end only.
- A conversation may hold any share of the rows.  Light rows (ids, turns, hashes, no texts) are
  range-sorted by conversation and order, equal rows combined to one with a count before.  A task cuts
  its rows into pieces, a piece a conversation and ``BLOCK`` rows at most, and runs the program from each
  state that the output can be in before it; a second step joins the pieces of a conversation in order.  Only the
  hash of the repaired text, which is sequential, reads a conversation's rows in one
  task: streamed, a row at a time.

Defined results: rows of one turn are ordered by role and the SHA-256 of their text.  A null or empty role has no legal initial.
A null conv_id is a conversation of its own.  Repeated rows are duplicates of the first.  An empty table
gives no rows; extra columns are not read.  The audit of a conversation is one value, so its edits are bounded by the 2 GB of one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm.token_files import scratch

#: Fixed values of the task: costs, and what a row's checksum modulo 20 does to it.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
DROP, EMPTY, STRIP, REPEAT, USER = 0, 1, 2, 3, 4
ROLES = {"u": "user", "a": "assistant"}
#: What the output ended with, and the initials that may follow.
STATES = ["", "s", "u", "a"]
FOLLOW = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ENDS = (0, 3)
#: Rows of a piece.
BLOCK = 2_000
SPACE = " \t\n\x0b\f\r"
PIECES = ("conv_id long, part int, block int, rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
          "turns long, least long, most long, costs array<long>, audits array<string>")
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
MODULUS, BASE = (1 << 61) - 1, 911_382_323


class AuditTree:
    """Strings that share their beginnings.  A node adds a string (of one letter or more) to its parent's; node 0 is empty."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... nodes above
        self.depth, self.hash, self.text = [0], [0], [""]
        self.proven: dict[int, int] = {}  # nodes whose strings were verified to be that of another

    def _extend(self, h: int, text: str) -> int:
        for c in text:
            h = (h * BASE + ord(c)) % self.modulus
        return h

    def add(self, parent: int, text: str) -> int:
        if not text:
            return parent
        node = len(self.text)
        ancestors, at, k = [parent], parent, 0
        while k < len(self.up[at]):
            at = self.up[at][k]
            ancestors.append(at)
            k += 1
        self.up.append(ancestors)
        self.depth.append(self.depth[parent] + len(text))
        self.hash.append(self._extend(self.hash[parent], text))
        self.text.append(text)
        return node

    def drop(self, node: int) -> None:
        """Forget the node that was added last."""
        if node and node == len(self.text) - 1:
            for held in (self.up, self.depth, self.hash, self.text):
                held.pop()
            self.proven.pop(node, None)

    def holder(self, node: int, depth: int) -> int:
        """The ancestor (or the node itself) whose own letters hold the string's letter number ``depth`` (from 1)."""
        while node and self.depth[parent := self.up[node][0]] >= depth:
            best = parent
            for up in self.up[node]:
                if self.depth[up] < depth:
                    break
                best = up
            node = best
        return node

    def prefix_hash(self, node: int, depth: int) -> int:
        node = self.holder(node, depth)
        if self.depth[node] == depth:
            return self.hash[node]
        parent = self.up[node][0]
        return self._extend(self.hash[parent], self.text[node][:depth - self.depth[parent]])

    def letter(self, node: int, at: int) -> str:
        """Letter ``at`` (from 0) of the node's string."""
        node = self.holder(node, at + 1)
        return self.text[node][at - self.depth[self.up[node][0]]]

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix of two nodes' strings."""
        low, high = 0, min(self.depth[a], self.depth[b])
        if self.prefix_hash(a, high) == self.prefix_hash(b, high):
            low = high
        while low < high - 1:  # prefixes of length low agree, of length high do not
            mid = (low + high) // 2
            if self.prefix_hash(a, mid) == self.prefix_hash(b, mid):
                low = mid
            else:
                high = mid
        return self._verified(a, b, low)

    def _verified(self, a: int, b: int, length: int) -> int:
        """``length``, or less if the letters of the equal hashes differ: the first place of a difference."""
        x, y, first, i = self.holder(a, length), self.holder(b, length), None, length
        whole = length and self.depth[x] == length == self.depth[y]
        top = (x, y)
        while i > 0:
            x, y = self.holder(x, i), self.holder(y, i)
            if x == y or self.depth[x] == i == self.depth[y] and self.proven.get(max(x, y)) == min(x, y):
                break  # one node, or two proven equal: all letters above agree
            above_x, above_y = self.depth[self.up[x][0]], self.depth[self.up[y][0]]
            to = max(above_x, above_y)
            p, q = self.text[x][to - above_x:i - above_x], self.text[y][to - above_y:i - above_y]
            if p != q:
                first = to + next(k for k in range(i - to) if p[k] != q[k])
            i = to
        if first is None and whole and top[0] != top[1]:
            self.proven[max(top)] = min(top)
        return length if first is None else first

    def less(self, a: int, b: int) -> bool:
        """Whether a's string comes before b's."""
        if a == b:
            return False
        if a and b and self.up[a][0] == self.up[b][0]:  # the same beginning
            return self.text[a] < self.text[b]
        n = self.common(a, b)
        if n == min(self.depth[a], self.depth[b]):
            return self.depth[a] < self.depth[b]
        return self.letter(a, n) < self.letter(b, n)

    def string(self, node: int) -> str:
        out = []
        while node:
            out.append(self.text[node])
            node = self.up[node][0]
        return "".join(reversed(out))


#: For each state its cost and its audit's node, or None.
Vector = list[tuple[int, int] | None]


def _better(tree: AuditTree, out: Vector, state: int, cost: int, parent: int, text: str) -> None:
    held = out[state]
    if held is None or cost < held[0]:
        out[state] = cost, tree.add(parent, text)
    elif cost == held[0]:
        node = tree.add(parent, text)
        if tree.less(node, held[1]):
            out[state] = cost, node
        elif node not in (parent, held[1]):
            tree.drop(node)


def insertions(tree: AuditTree, vector: Vector) -> Vector:
    """The vector with empty turns inserted: two in a row reach every state."""
    out = list(vector)
    for _ in range(2):
        for state, held in enumerate(list(out)):
            if held:
                for initial in ROLES:
                    if initial in FOLLOW[state]:
                        _better(tree, out, FOLLOW[state][initial], held[0] + INSERT, held[1], "I")
    return out


def step(tree: AuditTree, vector: Vector, initial: str, must_go: bool, truncated: bool, times: int = 1) -> Vector:
    """The vector after a row; ``times`` - 1 equal rows after it are duplicates."""
    out: Vector = [None] * len(STATES)
    run = "D" * (times if must_go else 1)
    for state, held in enumerate(vector):
        if held:
            _better(tree, out, state, held[0] + DELETE * len(run), held[1], run)
    if not must_go:
        extra = TRUNCATED if truncated else 0
        for state, held in enumerate(insertions(tree, vector)):
            if held:
                for next_initial, after in FOLLOW[state].items():
                    if next_initial == initial:
                        _better(tree, out, after, held[0] + KEEP + extra, held[1], "K")
                    elif next_initial in ROLES:
                        _better(tree, out, after, held[0] + REROLE + extra, held[1], "R")
        if times > 1:
            out = [h and (h[0] + DELETE * (times - 1), tree.add(h[1], "D" * (times - 1))) for h in out]
    return out


def finish(tree: AuditTree, vector: Vector) -> tuple[int, str]:
    """Cost and audit of the best legal end."""
    best: Vector = [None]
    closed = insertions(tree, vector)
    for state in ENDS:
        if closed[state]:
            cost, node = closed[state]
            if best[0] is None or cost < best[0][0] or cost == best[0][0] and tree.less(node, best[0][1]):
                best[0] = cost, node
    return best[0][0], tree.string(best[0][1])


def audit_of(rows: Iterable[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Cost and audit for rows (initial, blank or duplicate, truncated)."""
    tree = AuditTree()
    vector: Vector = [(0, 0), None, None, None]
    for row in rows:
        vector = step(tree, vector, *row)
    return finish(tree, vector)


class _Piece:
    """Rows of one conversation that follow each other: counts, and the program from each state before them."""

    def __init__(self, conv_id: int | None, block: int, entries: list[int]):
        self.conv_id, self.block = conv_id, block
        self.tree, self.entries = AuditTree(), entries
        self.vectors: list[Vector] = [[(0, 0) if s == e else None for s in range(len(STATES))] for e in entries]
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.steps = 0
        self.first = self.last = self.least = self.most = None

    def add(self, turn: int | None, initial: str, blank: bool, again: bool, truncated: bool, times: int) -> None:
        self.steps += 1
        if turn is not None and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        self.illegal += (self.last is not None and self.last + initial not in LEGAL) + (times - 1) * (initial + initial not in LEGAL)
        self.first = initial if self.first is None else self.first
        self.last = initial
        self.rows += times
        if blank:
            self.blank += times
        else:
            self.duplicate += times - (not again)
            self.truncated += truncated and not again
        self.vectors = [step(self.tree, v, initial, blank or again, truncated, times) for v in self.vectors]

    def row(self, part: int) -> tuple:
        costs, audits = [None] * 16, [None] * 16
        for e, vector in zip(self.entries, self.vectors):
            for s, held in enumerate(vector):
                if held:
                    costs[4 * e + s], audits[4 * e + s] = held[0], self.tree.string(held[1])
        return (self.conv_id, part, self.block, self.rows, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last,
                self.turns, self.least, self.most, costs, audits)


#: Adjacent initials that are no fault.
LEGAL = {"su", "ua", "au"}
PIECE_TYPES = pa.schema([(n, t) for n, t in zip([c.split()[0] for c in PIECES.split(", ")], [
    pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.string())])])
RESULT_TYPES = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in RESULT.split(", ")])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _pieces(block: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows (conv_id, turn, initial, blank, again, truncated, times); times 0: the conversation has a row that was dropped."""
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        piece, out, every = None, [], [0, 1, 2, 3]
        for batch in batches:
            for conv_id, turn, initial, blank, again, truncated, times in zip(*(c.to_pylist() for c in batch.columns)):
                if piece is None:
                    piece = _Piece(conv_id, 0, every)  # its conversation may have begun in an earlier task
                elif piece.conv_id != conv_id:
                    out.append(piece.row(part))
                    piece = _Piece(conv_id, 0, [0])
                elif piece.steps >= block:
                    out.append(piece.row(part))
                    piece = _Piece(conv_id, piece.block + 1, every)
                if times:
                    piece.add(turn, initial, blank, again, truncated, times)
                if len(out) >= 1000:
                    yield _batch(out, PIECE_TYPES)
                    out = []
        if piece is not None:
            out.append(piece.row(part))
        yield _batch(out, PIECE_TYPES)

    return rows


class _Whole:
    """The pieces of a conversation, joined in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.tree = conv_id, AuditTree()
        self.vector: Vector = [(0, 0), None, None, None]
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last = self.least = self.most = None

    def add(self, p: dict) -> None:
        if not p["rows"]:
            return
        self.illegal += p["illegal"] + (self.last is not None and self.last + p["first"] not in LEGAL)
        self.last = p["last"]
        for name in ("blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + p[name])
        if p["turns"]:
            self.turns += p["turns"] - (p["least"] == self.most)
            self.least = p["least"] if self.least is None else self.least
            self.most = p["most"]
        out: Vector = [None] * len(STATES)
        for e, held in enumerate(self.vector):
            for s in range(len(STATES)):
                if held and p["costs"][4 * e + s] is not None:
                    _better(self.tree, out, s, held[0] + p["costs"][4 * e + s], held[1], p["audits"][4 * e + s])
        self.vector = out

    def row(self) -> tuple:
        cost, audit = finish(self.tree, self.vector)
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole, out = None, []
    for batch in batches:
        for k in range(batch.num_rows):
            p = {n: c[k].as_py() for n, c in zip(batch.schema.names, batch.columns)}
            if whole is None or whole.conv_id != p["conv_id"]:
                if whole is not None:
                    out.append(whole.row())
                whole = _Whole(p["conv_id"])
            whole.add(p)
            if len(out) >= 1000:
                yield _batch(out, RESULT_TYPES)
                out = []
    if whole is not None:
        out.append(whole.row())
    yield _batch(out, RESULT_TYPES)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and times of every row after damage: 0 if it is dropped, 2 if repeated."""
    blank = F.lit(" ")
    row = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                               F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    row = row.withColumn("fate", F.crc32(key.cast("binary")) % 20)
    fate = F.col("fate")
    return row.select("conv_id", "turn", F.when(fate == USER, "user").otherwise(F.col("role")).alias("role"),
                      F.when(fate == EMPTY, "").when(fate == STRIP, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                      F.when(fate == DROP, 0).when(fate == REPEAT, 2).otherwise(1).cast("long").alias("times"))


def undamaged(conversations: DataFrame) -> DataFrame:
    """Rows as they are, each once, for a table that is to be repaired as it came."""
    return damage(conversations.limit(0)).unionByName(conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).cast("long").alias("times")))


def _digest() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256)


def light_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: order, initial, faults, and how often each occurs."""
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    light = rows.select("conv_id", "turn", F.when(F.col("times") > 0, F.col("role")).alias("role"), F.when(F.col("times") > 0, _digest()).alias("digest"),
                        F.when(F.col("times") > 0, last).alias("last"), "times")
    # equal rows of a turn are one row with a count, combined before the shuffle
    light = light.groupBy("conv_id", "turn", "role", "digest").agg(F.first("last").alias("last"), F.sum("times").alias("times"))
    # the first of equal role and text in the conversation; nulls first
    order = F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn").alias("turn"))
    light = light.withColumn("order", order)
    firsts = light.filter("times > 0").groupBy(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest")).agg(F.min("order").alias("head"))
    on = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    end = F.coalesce("last", F.lit(""))
    return light.join(firsts, on, "left").select(
        "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"),
        ((F.col("times") > 0) & ~F.col("order").eqNullSafe(F.col("head"))).alias("again"), (~end.isin(".", "!", "?")).alias("truncated"), "times")


def audits(light: DataFrame, block: int = BLOCK) -> DataFrame:
    """Counts, cost and audit of every conversation of ``light_rows``."""
    order = ["conv_id", "turn", "role", "digest"]
    columns = ["conv_id", "turn", "initial", "blank", "again", "truncated", "times"]
    pieces = light.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns).mapInArrow(_pieces(block), PIECES)
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").mapInArrow(_join, RESULT)


class _Repair:
    """Applies an audit to the rows of a conversation as they come; ``out`` takes (role, text) of each repaired row."""

    def __init__(self, audit: str, out):
        self.audit, self.out, self.at, self.ended = audit, out, 0, ""

    def _put(self, role: str, text: str) -> None:
        self.out(role, text)
        self.ended = role[0]

    def insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._put(ROLES["a" if self.ended == "u" else "u"], "")

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text)
        elif edit == "R":
            self._put(ROLES["a" if self.ended == "u" else "u"], text)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, tag, audit, role, text, times): a conversation's audit (tag 0), then its rows."""
    digest, repair, parted, conv, ids, hashes = None, None, False, None, [], []

    def put(role: str, text: str) -> None:
        nonlocal parted
        digest.update((f"\n{role}:{text}" if parted else f"{role}:{text}").encode())
        parted = True

    def close() -> None:
        if repair is not None:
            repair.insert()
            ids.append(conv)
            hashes.append(digest.hexdigest())

    for batch in batches:
        for conv_id, tag, audit, role, text, times in zip(*(batch.column(i) for i in range(6))):
            if tag.as_py() == 0:
                close()
                digest, parted, conv = hashlib.sha256(), False, conv_id.as_py()
                repair = _Repair(audit.as_py(), put)
            else:
                role, text = role.as_py(), text.as_py()
                for _ in range(times.as_py()):
                    repair.row(role, text)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])
        ids, hashes = [], []
    close()
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])


def _with_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    heads = found.select("conv_id", F.lit(0).alias("tag"), F.lit(None).cast("long").alias("turn"), "audit", F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("digest"), F.lit(1).cast("long").alias("times"))
    texts = rows.filter("times > 0").select("conv_id", F.lit(1).alias("tag"), "turn", F.lit(None).cast("string").alias("audit"), "role", "text", _digest().alias("digest"), "times")
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "tag", "turn", "role", "digest")
    return both.select("conv_id", "tag", "audit", "role", "text", "times")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    repair, conv, at, out = None, None, 0, []

    def put(role: str, text: str) -> None:
        nonlocal at
        out.append((conv, at, role, text))
        at += 1

    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    for batch in batches:
        for conv_id, tag, audit, role, text, times in zip(*(batch.column(i) for i in range(6))):
            if tag.as_py() == 0:
                if repair is not None:
                    repair.insert()
                conv, at = conv_id.as_py(), 0
                repair = _Repair(audit.as_py(), put)
            else:
                for _ in range(times.as_py()):
                    repair.row(role.as_py(), text.as_py())
        yield _batch(out, schema)
        out = []
    if repair is not None:
        repair.insert()
    yield _batch(out, schema)


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (numbered from 0), role, text."""
    return _with_rows(rows, found).mapInArrow(_texts, "conv_id long, turn long, role string, text string")


def find_repairs(spark: SparkSession, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for every conversation of ``rows`` (those of ``damage`` or ``undamaged``): counts of faults, cost and audit."""
    folder = scratch(spark, "conversations")
    # written, since a range sort reads its input twice
    light_rows(rows).write.parquet(f"{folder}/light")
    light = spark.read.schema("conv_id long, turn long, role string, digest string, initial string, blank boolean, again boolean, truncated boolean, times long").parquet(f"{folder}/light")
    audits(light, block).write.parquet(f"{folder}/audits")
    return spark.read.schema(RESULT).parquet(f"{folder}/audits")


def repair_digests(spark: SparkSession, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Faults, cost, audit and the hash of the repaired text of every conversation, after damage."""
    rows = damage(conversations)
    found = find_repairs(spark, rows, block)
    digests = _with_rows(rows, found).mapInArrow(_hashes, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "digest_id")
    return found.join(digests, found["conv_id"].eqNullSafe(digests["digest_id"])).drop("digest_id")
