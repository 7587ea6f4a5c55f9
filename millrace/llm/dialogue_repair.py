"""Repair of conversations: the cheapest edits that give a legal order of roles.

A legal conversation has role initials ``(s?(ua)+)?``. A row is kept (K, free),
gets the role user or assistant (R, 3), or is deleted (D, 4; blank rows and
duplicates must be); rows without text are inserted (I, 3); a row that stays though
its text is cut off costs 3 more. Of the cheapest edits the ASCII-least are taken.

The edits are found by dynamic programming over four states (nothing yet, after
system, after user, after assistant). From the end backwards, the costs to
finish are a vector of four. It is stored at checkpoints only: a conversation of
n rows is cut into pieces of about the square root of n rows (``SHORT`` rows or more).
Every piece is turned into a matrix of least costs by itself, one pass over the
matrices gives the vector at each checkpoint, and every piece is then computed again
from the vector behind it, walking forward, to emit its edits. Which state a piece is entered
in follows from one more pass over the pieces' states. So a conversation that
holds a third of all rows is spread over many tasks, and the two passes read one short row a piece.

A walk may take the smallest tight edit at once: in each state an edit leads to
one state only, so that no two edits of one letter compete.

Defined results: null role and text count as one space, in the damage as well a
null id or turn; rows come by turn (nulls first), then role, then text; a role whose first
character isn't s, u or a, or that is empty, can't be kept; a null conversation id is
a conversation like any other; repeated rows are duplicates; an empty table gives
no rows; columns beyond the four are left out. A digest over a whole conversation is
computed in one task, which reads it piece by piece and holds one piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.storage import land

REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
WHITE = " \t\n\v\f\r"
SHORT = 64
BYTES_AT_ONCE = 1 << 22
INFINITE = 1 << 60

BEFORE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the one state that an inserted or renamed row leads to
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
LEGAL_PAIRS = ("su", "ua", "au")
NOTHING_LEFT = (0, 2 * INSERT, INSERT, 0)

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
Vector = tuple[int, int, int, int]


class Steps:
    """Single steps of the programme, each computed once: vectors less their least entry are few."""

    def __init__(self):
        self.backs: dict[tuple[Vector, str, int], tuple[Vector, int]] = {}
        self.walks: dict[tuple[int, str, int, Vector], list[tuple[str, int]]] = {}

    @staticmethod
    def scaled(v) -> tuple[Vector, int]:
        low = min(v)
        return tuple(INFINITE if x >= INFINITE // 2 else x - low for x in v), low

    @staticmethod
    def _choices(state: int, initial: str, fault: int, after) -> dict[str, tuple[int, int]]:
        """Cost and state behind the row for each edit of it, inserts apart."""
        found = {"D": (DELETE + after[state], state)}
        if fault in (SOUND, TRUNCATED):
            cut = CUT_OFF if fault == TRUNCATED else 0
            if initial in KEPT[state]:
                to = KEPT[state][initial]
                found["K"] = (cut + after[to], to)
            found["R"] = (REROLE + cut + after[NEXT[state]], NEXT[state])
        return found

    def _before(self, initial: str, fault: int, after) -> list[int]:
        own = [min(cost for cost, _ in self._choices(s, initial, fault, after).values()) for s in STATES]
        for _ in range(2):  # two inserts lead back to where a third would
            own = [min(own[s], INSERT + own[NEXT[s]]) for s in STATES]
        return own

    def back(self, after: Vector, initial: str, fault: int) -> tuple[Vector, int]:
        """The vector before a row from the scaled vector behind it, scaled, and what it was scaled by."""
        key = (after, initial, fault)
        if key not in self.backs:
            self.backs[key] = self.scaled(self._before(initial, fault, after))
        return self.backs[key]

    def walk(self, state: int, initial: str, fault: int, after: Vector) -> list[tuple[str, int]]:
        """The tight edits up to and with that of the row, and the state behind each."""
        key = (state, initial, fault, after)
        if key not in self.walks:
            before, found = self._before(initial, fault, after), []
            while True:
                choices = self._choices(state, initial, fault, after)
                tight = {e: to for e, (cost, to) in choices.items() if cost == before[state]}
                if before[NEXT[state]] + INSERT == before[state]:
                    tight["I"] = NEXT[state]
                edit = min(tight)
                state = tight[edit]
                found.append((edit, state))
                if edit != "I":
                    break
            self.walks[key] = found
        return self.walks[key]

    def vectors(self, initials: str, faults: bytes, after) -> tuple[list[Vector], list[int]]:
        """Scaled vectors behind each row, last that before the first; and their true scales."""
        v, low = self.scaled(after)
        out, lows = [v], [low]
        for initial, fault in zip(reversed(initials), reversed(faults)):
            v, more = self.back(v, initial, fault)
            low += more
            out.append(v)
            lows.append(low)
        return out[::-1], lows[::-1]

    def matrix(self, initials: str, faults: bytes) -> list[int]:
        """Least cost from each state before the piece to each state behind it, row by row."""
        columns = []
        for to in STATES:
            vectors, lows = self.vectors(initials, faults, [0 if s == to else INFINITE for s in STATES])
            columns.append([min(INFINITE, x + lows[0]) for x in vectors[0]])
        return [columns[to][s] for s in STATES for to in STATES]

    def exits(self, initials: str, faults: bytes, after) -> list[int]:
        """The state behind the piece for each state before it."""
        vectors, _ = self.vectors(initials, faults, after)
        states = list(STATES)
        for i, (initial, fault) in enumerate(zip(initials, faults)):
            states = [self.walk(s, initial, fault, vectors[i + 1])[-1][1] for s in states]
        return states


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage that crc32 of ``conv_id:turn`` deals."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    hit = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hit.filter("fate <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("again")).drop("again")


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows in order over the partitions, with what can be said of each without its neighbours."""
    named = turns.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    said = named.withColumn("said", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # struct comparison puts nulls first, as the order of turns does
    firsts = said.groupBy("conv_id", "said").agg(F.min(F.struct("turn")).alias("first"))
    firsts = firsts.withColumnsRenamed({"conv_id": "c", "said": "s"})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s"))
    marked = said.join(firsts, same).withColumn("later", F.struct("turn") > F.col("first"))
    long = named.groupBy("conv_id").count().filter(F.col("count") > SHORT * SHORT)
    long = land(long.select(F.col("conv_id").alias("c"), F.ceil(F.sqrt("count")).cast("int").alias("span")), "long-conversations")
    sized = marked.drop("c").join(long, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    end = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    return (
        sized.select(
            "conv_id", "turn", "role", "text", "later",
            F.coalesce("span", F.lit(SHORT)).alias("span"),
            (F.length(F.rtrim("text", F.lit(WHITE))) == 0).alias("blank"),
            (~end.isin(".", "!", "?")).alias("open"),
        )
        .repartitionByRange("conv_id", "turn", "role", "text")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )


def _piece_schema(conv_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("conv_id", conv_type), ("piece", pa.int64()), ("initials", pa.string()), ("faults", pa.binary()),
            ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
            ("matrix", pa.list_(pa.int64())),
        ]
    )


def _batched(rows: Iterator[tuple[int, tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows with their sizes in bytes, as batches of about BYTES_AT_ONCE."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for n, row in rows:
        held.append(row)
        size += n
        if size >= BYTES_AT_ONCE:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _initial(role: str) -> str:
    return role[0] if role and role[0] in INITIALS else "-"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
    steps, number = Steps(), TaskContext.get().partitionId() << 33
    held: list[tuple] = []
    last = conv = None
    size = 0

    def piece() -> tuple:
        initials, faults = "".join(_initial(r[1]) for r in held), bytes(r[3] for r in held)
        return conv, number, initials, faults, [r[0] for r in held], [r[1] for r in held], [r[2] for r in held], steps.matrix(initials, faults)

    for batch in batches:
        for c, turn, role, text, later, span, blank, is_open in zip(*(batch[n].to_pylist() for n in ("conv_id", "turn", "role", "text", "later", "span", "blank", "open"))):
            if held and (c != conv or len(held) >= span):
                yield size, piece()
                held, size, number = [], 0, number + 1
            conv, row = c, (c, turn, role, text)
            fault = BLANK if blank else DUPLICATE if later or row == last else TRUNCATED if is_open else SOUND
            last = row
            held.append((turn, role, text, fault))
            size += 64 + len(text)
    if held:
        yield size, piece()


def _states(batches: Iterator[pa.RecordBatch], fold: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Fold the pieces of each conversation in the order they come; ``fold`` gets None as state at its start."""

    def rows() -> Iterator[tuple[int, tuple]]:
        conv, state = object(), None
        for batch in batches:
            for c, piece, value in zip(*(batch[i].to_pylist() for i in range(3))):
                if c != conv:
                    conv, state = c, None
                state, out = fold(state, value)
                yield 64, (piece, *out)

    return _batched(rows(), schema)


def _checkpoints(pieces: DataFrame) -> DataFrame:
    """``after``, the vector behind each piece, and whether it is the last of its conversation."""
    schema = pa.schema([("piece", pa.int64()), ("after", pa.list_(pa.int64())), ("last", pa.bool_())])

    def fold(after, matrix):
        out = NOTHING_LEFT if after is None else after
        before = [min(INFINITE, *(matrix[4 * s + to] + out[to] for to in STATES)) for s in STATES]
        return before, (out, after is None)

    rows = pieces.select("conv_id", "piece", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece"))
    return rows.mapInArrow(lambda batches: _states(batches, fold, schema), "piece long, after array<long>, last boolean")


def _entries(pieces: DataFrame, checked: DataFrame) -> DataFrame:
    """The state that each piece is entered in."""
    schema = pa.schema([("piece", pa.int64()), ("entry", pa.int32())])

    def leaving(initials: pa.Array, faults: pa.Array, after: pa.Array) -> pa.Array:
        steps = Steps()
        return pa.array([steps.exits(*row) for row in zip(*(c.to_pylist() for c in (initials, faults, after)))], pa.list_(pa.int32()))

    def fold(entry, exits):
        own = BEFORE if entry is None else entry
        return exits[own], (own,)

    exits = F.arrow_udf(leaving, "array<int>")("initials", "faults", "after").alias("exits")
    rows = pieces.select("conv_id", "piece", "initials", "faults").join(checked, "piece").select("conv_id", "piece", exits)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return ordered.mapInArrow(lambda batches: _states(batches, fold, schema), "piece long, entry int")


def _emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
    steps = Steps()
    names = ("conv_id", "piece", "initials", "faults", "turns", "roles", "texts", "after", "entry", "last")
    for batch in batches:
        for conv, piece, initials, faults, turns, roles, texts, after, state, last in zip(*(batch[n].to_pylist() for n in names)):
            vectors, lows = steps.vectors(initials, faults, after)
            cost = vectors[0][state] + lows[0]
            audit, new_roles, new_texts = [], [], []
            for i, (initial, fault) in enumerate(zip(initials, faults)):
                for edit, state in steps.walk(state, initial, fault, vectors[i + 1]):
                    audit.append(edit)
                    if edit != "D":
                        new_roles.append(roles[i] if edit == "K" else ROLE_OF[state])
                        new_texts.append("" if edit == "I" else texts[i])
            cost -= after[state]
            while last and state in (SYSTEM, USER):
                state = NEXT[state]
                cost += INSERT
                audit.append("I")
                new_roles.append(ROLE_OF[state])
                new_texts.append("")
            known = [t for t in turns if t is not None]
            pairs = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
            counts = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
            ends = (initials[:1], initials[-1:], known[0] if known else None, known[-1] if known else None)
            distinct = sum(a != b for a, b in zip(known, [None, *known]))
            yield 64 + sum(map(len, new_texts)), (conv, piece, "".join(audit), cost, new_roles, new_texts, *counts, pairs, *ends, distinct)


_REPAIRED = (
    "piece long, audit string, cost long, roles array<string>, texts array<string>, blank long, duplicate long, truncated long,"
    " illegal long, first_initial string, last_initial string, first_turn long, last_turn long, turns long"
)
_REPAIRED_TYPES = {
    "piece": pa.int64(), "audit": pa.string(), "cost": pa.int64(), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()),
    "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "first_initial": pa.string(),
    "last_initial": pa.string(), "first_turn": pa.int64(), "last_turn": pa.int64(), "turns": pa.int64(),
}


def _conv_type(turns: DataFrame) -> tuple[str, pa.DataType]:
    text = turns.schema["conv_id"].dataType.simpleString()
    return text, pa.string() if text == "string" else pa.int64()


def repair(turns: DataFrame) -> DataFrame:
    """Pieces of repaired conversations, for rows of conv_id (integer or string), turn, role and text.

    ``piece`` orders the pieces of a conversation. ``audit`` holds the edits in order,
    ``cost`` their cost, ``roles`` and ``texts`` the rows that the piece now has. The
    faults and the ends that ``report`` needs are those of the rows given.
    """
    cast = turns if turns.schema["conv_id"].dataType.simpleString() == "string" else turns.withColumn("conv_id", F.col("conv_id").cast("long"))
    sql, arrow = _conv_type(cast)
    rows = _ordered(cast.withColumn("turn", F.col("turn").cast("long")))
    schema = _piece_schema(arrow)
    pieces = land(
        rows.mapInArrow(
            lambda batches: _batched(_cut(batches), schema),
            f"conv_id {sql}, piece long, initials string, faults binary, turns array<long>, roles array<string>, texts array<string>, matrix array<long>",
        ),
        "pieces",
    )
    checked = land(_checkpoints(pieces), "checkpoints")
    entered = _entries(pieces, checked)
    whole = pieces.drop("matrix").join(checked, "piece").join(entered, "piece")
    out = pa.schema([("conv_id", arrow), *_REPAIRED_TYPES.items()])
    return whole.mapInArrow(lambda batches: _batched(_emitted(batches), out), f"conv_id {sql}, {_REPAIRED}")


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """One row per row of the repaired conversations: conv_id, piece, its place in the piece, role and text."""
    return pieces.select("conv_id", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "row")).select(
        "conv_id", "piece", "at", F.col("row.roles").alias("role"), F.col("row.texts").alias("text")
    )


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_REPORT_FIELDS = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


class _Summary:
    def __init__(self):
        self.sums = [0, 0, 0, 0, 0]  # blank, duplicate, truncated, illegal, cost
        self.audit: list[str] = []
        self.digest, self.lines = hashlib.sha256(), 0
        self.initial = self.first = self.last = None
        self.distinct = 0

    def add(self, r: dict) -> None:
        for i, name in enumerate(("blank", "duplicate", "truncated", "illegal", "cost")):
            self.sums[i] += r[name]
        if self.initial and r["first_initial"] and self.initial + r["first_initial"] not in LEGAL_PAIRS:
            self.sums[3] += 1
        self.initial = r["last_initial"] or self.initial
        if r["first_turn"] is not None:
            self.distinct += r["turns"] - (r["first_turn"] == self.last)
            self.first = r["first_turn"] if self.first is None else self.first
            self.last = r["last_turn"]
        self.audit.append(r["audit"])
        for role, text in zip(r["roles"], r["texts"]):
            self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return gaps, *self.sums, "".join(self.audit), self.digest.hexdigest()


def report(pieces: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation id of ``conversations``: its faults, the edits and a digest of the repaired ``role:text`` lines."""
    sql, arrow = _conv_type(pieces)
    ids = conversations.select(F.col("conv_id").cast(sql).alias("conv_id")).distinct()
    rows = pieces.unionByName(ids.withColumn("piece", F.lit(-1).cast("long")), allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    schema = pa.schema([("conv_id", arrow), *_REPORT_FIELDS])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        conv, own = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if own is None or r["conv_id"] != conv:
                    if own is not None:
                        yield 256, (conv, *own.row())
                    conv, own = r["conv_id"], _Summary()
                if r["piece"] >= 0:
                    own.add(r)
        if own is not None:
            yield 256, (conv, *own.row())

    return ordered.mapInArrow(lambda batches: _batched(summed(batches), schema), f"conv_id {sql}, {_REPORT}")
