"""Repair of conversations: the cheapest edits that give turns their order back.

A conversation's roles should read: perhaps a system turn, then user and
assistant by turns, an assistant last, or nothing at all. Turns may be kept,
given another role, deleted, and empty ones inserted. What an edit costs, and
where it leads, depends on the class of the turn (its role's initial and its
fault) and on the last role only. So a turn is one byte, and a conversation's
bytes, in order, are all that the search for the cheapest edits needs.

Costs come first, from the last turn to the first: a dynamic program over four
states. Its cost vectors, less their least entry, are few, so a step is one
look-up. The arcs that keep to the least cost make a graph of (turn, state). Its
nodes are ranked by the first letter of their least audit, by the first two,
four, eight and so on: the rank of 2n letters is that of the node's rank and of
the rank of the node n letters further on, which doubled pointers name. Ranks
select the least arc of each node, and the pointers from the start give the
path. All nodes of many conversations are ranked together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from landfall.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
# Letters in ASCII order; an arc's slot is its letter's place here.
LETTERS = "DIKR"

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
# What the last turn was, and the initials of the roles that lead there.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
OTHER = 3
# The role that may follow, and the states a conversation may end in.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = {START, ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 40

# Turns whose nodes are ranked together.
WINDOW = 1 << 16

AUDITS = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long,"
    " illegal long, cost long, audit string"
)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn, as faults occur in the wild.

    ``copies`` says how often a row stands there: 0 for a dropped one, 2 for a
    repeated one. A NULL counts as one space in the hash, the role and the text.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDINGS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


# ---------------------------------------------------------------- cheapest edits


def _state_after(state: int, initial: int) -> int | None:
    """Where a kept turn leads, if its role may stand there."""
    if state == START and initial == 0:
        return SYSTEM
    return FOLLOWS[state] if FOLLOWS[state] - 1 == initial else None


class Costs:
    """Cost vectors of the dynamic program, and the arcs of least cost.

    A vector holds the cost to the end from each state, less its least entry. A
    step is a vector and the class of the turn before it.
    """

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int, int]] = {}
        self.arcs: list[list[list[int]]] = []
        end = [0 if s in ENDS else NEVER for s in range(4)]
        self.end = self._inserted(end)
        low, self.last = self._number(self.end)
        assert low == 0
        # Step 0 stands for the end of a conversation.
        self._add_arcs(self.end, [{} for _ in range(4)])

    def _inserted(self, costs: list[int]) -> list[int]:
        for _ in range(2):
            costs = [min(c, INSERT_COST + costs[FOLLOWS[s]]) for s, c in enumerate(costs)]
        return costs

    def _number(self, costs: list[int]) -> tuple[int, int]:
        low = min(costs)
        vector = tuple(c - low for c in costs)
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
        return low, self.numbers[vector]

    def _add_arcs(self, costs: list[int], moves: list[dict[str, tuple[int, int]]]) -> int:
        """Arcs of least cost out of each state: by slot the state they lead to, or -1."""
        table = []
        for state in range(4):
            slots = [-1] * len(LETTERS)
            into = FOLLOWS[state]
            if costs[state] == INSERT_COST + costs[into]:
                slots[LETTERS.index(INSERT)] = into
            for letter, (cost, to) in moves[state].items():
                if cost == costs[state]:
                    slots[LETTERS.index(letter)] = to
            table.append(slots)
        self.arcs.append(table)
        return len(self.arcs) - 1

    def step(self, vector: int, kind: int) -> tuple[int, int, int]:
        """The vector before a turn, what it lost of its height, and the step's arcs."""
        known = self.steps.get((vector, kind))
        if known is None:
            known = self.steps[vector, kind] = self._step(self.vectors[vector], *divmod(kind, 4))
        return known

    def _step(self, after: tuple[int, ...], initial: int, fault: int) -> tuple[int, int, int]:
        moves = []
        for state in range(4):
            found = {DELETE: (DELETE_COST + after[state], state)}
            if fault not in (BLANK, DUPLICATE):
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                kept, given = _state_after(state, initial), FOLLOWS[state]
                if kept is not None:
                    found[KEEP] = more + after[kept], kept
                found[REROLE] = REROLE_COST + more + after[given], given
            moves.append(found)
        costs = self._inserted([min(c for c, _ in m.values()) for m in moves])
        low, number = self._number(costs)
        return number, low, self._add_arcs(costs, moves)


COSTS = Costs()


def cheapest(kinds: bytes) -> tuple[int, np.ndarray]:
    """The least cost for turns of these classes, and the step of each turn."""
    steps = np.zeros(len(kinds) + 1, np.int32)
    vector, cost = COSTS.last, 0
    for k in range(len(kinds) - 1, -1, -1):
        vector, low, steps[k] = COSTS.step(vector, kinds[k])
        cost += low
    return cost + COSTS.vectors[vector][START], steps


def least_paths(steps: list[np.ndarray], starts: list[int]) -> list[tuple[str, int]]:
    """The least audit of each conversation or window of one, and the state it ends in.

    ``steps`` has those of a window's turns and one for the place behind them:
    0 at a conversation's end, where turns may still be inserted, and -1 at the
    end of a window, where the path goes on later.
    """
    sizes = np.array([len(s) for s in steps])
    bases = np.cumsum(sizes) - sizes
    step = np.concatenate(steps)
    table = np.array(COSTS.arcs, np.int32)  # step, state, slot
    to = table[step]
    to[step < 0] = -1
    places = np.arange(len(step))[:, None, None]
    moves = np.array([0 if c == INSERT else 1 for c in LETTERS])
    ends = np.where(to >= 0, 4 * (places + moves) + to, -1).reshape(-1, len(LETTERS))

    # By first letters: arcs of a node differ in their letters, as a letter, a
    # state and a class lead to one place only.
    nodes = np.arange(len(ends))
    some = (ends >= 0).any(axis=1)
    first = np.argmax(ends >= 0, axis=1)
    rank = np.where(some, first + 1, 0).astype(np.int64)
    jump = np.where(some, ends[nodes, first], nodes)
    while some[jump].any():
        rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]
        jump = jump[jump]

    # Of each node's arcs the one of least letter, then of least rank behind it.
    worth = np.where(ends >= 0, np.arange(len(LETTERS)) * (rank.max() + 1) + rank[ends], NEVER)
    slot = np.argmin(worth, axis=1)
    jumps = [np.where(some, ends[nodes, slot], nodes)]
    length = some.astype(np.int64)
    while some[jumps[-1]].any():
        length = length + length[jumps[-1]]
        jumps.append(jumps[-1][jumps[-1]])

    begin = 4 * bases + np.array(starts)
    on_path = begin
    for hop in reversed(jumps):
        on_path = np.unique(np.concatenate([on_path, hop[on_path]]))
    on_path = on_path[some[on_path]]
    owner = np.searchsorted(4 * (bases + sizes), on_path, "right")
    on_path = on_path[np.lexsort((-length[on_path], owner))]
    letters = np.frombuffer(LETTERS.encode(), np.uint8)[slot[on_path]].tobytes().decode()
    cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(steps)))])
    finals = jumps[-1][begin] % 4
    return [(letters[a:b], int(s)) for a, b, s in zip(cuts[:-1], cuts[1:], finals)]


def least_audits(turns: list[bytes]) -> list[tuple[int, str]]:
    """Least cost and least audit of each conversation.

    Conversations are ranked together up to ``WINDOW`` turns; a longer one goes
    window by window, so beside its bytes and steps no more is held.
    """
    out: list[tuple[int, str]] = []
    held: list[tuple[int, np.ndarray]] = []
    waiting = 0

    def flush() -> None:
        nonlocal waiting
        if held:
            paths = least_paths([s for _, s in held], [START] * len(held))
            out.extend((cost, path) for (cost, _), (path, _) in zip(held, paths))
        held.clear()
        waiting = 0

    for kinds in turns:
        cost, steps = cheapest(kinds)
        if len(steps) <= WINDOW:
            held.append((cost, steps))
            waiting += len(steps)
            if waiting > WINDOW:
                flush()
            continue
        flush()
        state, parts = START, []
        for at in range(0, len(steps), WINDOW):
            window = steps[at : at + WINDOW]
            if at + WINDOW < len(steps):
                window = np.append(window, np.int32(-1))
            (path, state), = least_paths([window], [state])
            parts.append(path)
        out.append((cost, "".join(parts)))
    flush()
    return out


# ---------------------------------------------------------------- audits


@dataclass
class _Turns:
    """What is gathered of one conversation: a byte a turn, and its turn numbers."""

    conv_id: object
    kinds: list[bytes] = field(default_factory=list)
    first: int | None = None
    last: int | None = None
    numbers: int = 0

    def add(self, kinds: np.ndarray, turns: np.ndarray) -> None:
        self.kinds.append(kinds.astype(np.uint8).tobytes())
        if len(turns):
            new = np.count_nonzero(turns[1:] != turns[:-1]) + (self.last != turns[0])
            self.numbers += int(new)
            self.first = int(turns[0]) if self.first is None else self.first
            self.last = int(turns[-1])

    @property
    def gaps(self) -> int:
        return self.last - self.first + 1 - self.numbers if self.numbers else 0


def _conversations(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """Slices of one conversation each, and whether it is the conversation's first."""
    before: object = None
    begun = False
    for batch in batches:
        ids = batch["conv_id"].to_pylist()
        cuts = [k for k in range(len(ids)) if not k or ids[k] != ids[k - 1]]
        for a, b in zip(cuts, [*cuts[1:], len(ids)]):
            new = not begun or ids[a] != before
            before, begun = ids[a], True
            yield ids[a], new, batch.slice(a, b - a)


def _audit_batches(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    def solved(done: list[_Turns]) -> pa.RecordBatch:
        rows = [b"".join(t.kinds) for t in done]
        found = least_audits(rows)
        out: dict[str, list] = {c: [] for c in ("blank", "duplicate", "truncated", "illegal")}
        for kinds in rows:
            row = np.frombuffer(kinds, np.uint8)
            faults = np.bincount(row % 4, minlength=4)
            initial = row // 4
            pair = initial[:-1] * 4 + initial[1:]
            legal = np.isin(pair, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
            counts = *faults[1:].tolist(), len(pair) - int(np.count_nonzero(legal))
            for column, n in zip(out.values(), counts):
                column.append(n)
        return pa.RecordBatch.from_pydict(
            {"conv_id": pa.array([t.conv_id for t in done], id_type), "gaps": [t.gaps for t in done]}
            | {c: pa.array(v, pa.int64()) for c, v in out.items()}
            | {"cost": [c for c, _ in found], "audit": [a for _, a in found]}
        )

    done: list[_Turns] = []
    waiting = 0
    for conv_id, new, rows in _conversations(batches):
        if new:
            if waiting >= WINDOW:
                yield solved(done)
                done, waiting = [], 0
            done.append(_Turns(conv_id))
        copies = rows["copies"].to_numpy()
        kinds = np.repeat(rows["again"].to_numpy(), copies)
        there = copies > 0
        kinds[(np.cumsum(copies) - copies)[there]] = rows["once"].to_numpy()[there]
        turns = rows.filter(pa.array(there))["turn"].drop_null().to_numpy()
        done[-1].add(kinds, turns)
        waiting += len(kinds) + 1
    if done:
        yield solved(done)


def _filled(rows: DataFrame) -> DataFrame:
    """The columns that count; a missing role or text is an empty one."""
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("copies").cast("int").alias("copies"),
    )


def audits(rows: DataFrame) -> DataFrame:
    """Faults and cheapest edits of each conversation.

    ``rows`` have ``conv_id``, ``turn``, ``role``, ``text`` and ``copies``, as
    from ``damage``; others are left out. Each ``conv_id``, a NULL one too, gives
    a row, even where all its rows have no copies: zeros and an empty audit. Rows
    go by turn, NULLs first, then by role and by text's hash. Roles count by their
    initial; an empty or other one can only be changed or deleted. Texts do not
    move: a turn's class, role and text hash are shuffled once, by conversation,
    and a task that has a very long one holds a byte and a number for each turn.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    blank, whole = F.length(bare) == 0, F.instr(F.lit(ENDINGS), F.right(bare, F.lit(1))) > 0
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    initial = F.when((F.length("role") == 0) | (initial < 0), OTHER).otherwise(initial)
    light = _filled(rows).select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.md5("text")).alias("mark"),
        "copies",
        (initial * 4).cast("int").alias("initial"),
        blank.alias("blank"),
        whole.alias("whole"),
    ).repartition("conv_id")
    turn = F.asc_nulls_first("turn")
    same = Window.partitionBy("conv_id", "role", "mark").orderBy(turn)
    so_far = F.sum("copies").over(same.rowsBetween(Window.unboundedPreceding, 0))
    light = light.withColumn("earlier", so_far - F.col("copies"))
    once = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("earlier") > 0, DUPLICATE)
        .when(~F.col("whole"), TRUNCATED)
        .otherwise(FINE)
    )
    again = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
    ready = light.select(
        "conv_id",
        "turn",
        "role",
        "mark",
        "earlier",
        "copies",
        (F.col("initial") + once).cast("int").alias("once"),
        (F.col("initial") + again).cast("int").alias("again"),
    ).sortWithinPartitions("conv_id", turn, "role", "mark", "earlier")
    id_type = rows.schema["conv_id"].dataType
    arrow_id = to_arrow_type(id_type)
    return ready.select("conv_id", "turn", "copies", "once", "again").mapInArrow(
        lambda batches: _audit_batches(batches, arrow_id), AUDITS.format(id=id_type.simpleString())
    )


# ---------------------------------------------------------------- repairs


class _Repair:
    """Applies an audit to the turns of a conversation as they come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _insertions(self) -> Iterator[tuple[str, str]]:
        while self.audit.startswith(INSERT, self.at):
            self.at += 1
            self.state = FOLLOWS[self.state]
            yield ROLES[self.state], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == KEEP:
            self.state = SYSTEM if self.state == START and role.startswith("s") else FOLLOWS[self.state]
            yield role, text
        elif letter == REROLE:
            self.state = FOLLOWS[self.state]
            yield ROLES[self.state], text

    def rest(self) -> Iterator[tuple[str, str]]:
        yield from self._insertions()


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit row, then its rows in order, all in one task."""
    head = found.select(
        "*",
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("binary").alias("mark"),
        F.lit(0).alias("copies"),
    )
    body = _filled(rows).where("copies > 0").select(
        "conv_id",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema if f.name != "conv_id"],
        F.lit(1).alias("kind"),
        "turn",
        "role",
        "text",
        F.unhex(F.md5("text")).alias("mark"),
        "copies",
    )
    order = ["conv_id", "kind", F.asc_nulls_first("turn"), "role", "mark"]
    return head.unionByName(body).repartition("conv_id").sortWithinPartitions(*order)


def _repairs(
    batches: Iterator[pa.RecordBatch],
    begin: Callable[[pa.RecordBatch, int], None],
    take: Callable[[str, str], None],
    end: Callable[[], None],
) -> Iterator[None]:
    """Walk through sorted rows: ``begin`` at an audit, ``take`` each repaired turn.

    Comes back after each batch, for the caller to give out what it has.
    """
    repair: _Repair | None = None

    def close() -> None:
        if repair is not None:
            for turn in repair.rest():
                take(*turn)
            end()

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("kind", "audit", "role", "text", "copies")]
        for k, (kind, audit, role, text, copies) in enumerate(zip(*columns)):
            if kind == 0:
                close()
                repair = _Repair(audit)
                begin(batch, k)
                continue
            for _ in range(copies):
                for turn in repair.turn(role, text):
                    take(*turn)
        yield
    close()
    yield


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``position`` from 0, ``role``, ``text``."""
    id_type = rows.schema["conv_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, position, out = None, 0, []

        def begin(batch: pa.RecordBatch, k: int) -> None:
            nonlocal conv_id, position
            conv_id, position = batch["conv_id"][k].as_py(), 0

        def take(role: str, text: str) -> None:
            nonlocal position
            out.append((conv_id, position, role, text))
            position += 1

        for _ in _repairs(batches, begin, take, lambda: None):
            if out:
                ids, places, roles, texts = map(list, zip(*out))
                out.clear()
                yield pa.RecordBatch.from_pydict(
                    {"conv_id": pa.array(ids, arrow_id), "position": places, "role": roles, "text": texts}
                )

    schema = f"conv_id {id_type.simpleString()}, position long, role string, text string"
    return _with_audits(rows, found).mapInArrow(run, schema)


def repair_hashes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``repaired_sha256``, of the repaired ``role:text`` lines.

    Turns come by in order and go through the hash one by one, so a conversation
    of any length takes no memory.
    """
    names = found.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        heads: list[pa.RecordBatch] = []
        hashes: list[str] = []

        def begin(batch: pa.RecordBatch, k: int) -> None:
            state.update(hash=hashlib.sha256(), some=False)
            heads.append(batch.slice(k, 1).select(names))

        def take(role: str, text: str) -> None:
            state["hash"].update(f"{chr(10) if state['some'] else ''}{role}:{text}".encode())
            state["some"] = True

        def end() -> None:
            hashes.append(state["hash"].hexdigest())

        for _ in _repairs(batches, begin, take, end):
            if n := len(hashes):
                made = pa.Table.from_batches(heads[:n]).append_column("repaired_sha256", pa.array(hashes))
                del heads[:n], hashes[:n]
                yield from made.combine_chunks().to_batches()

    return _with_audits(rows, found).mapInArrow(run, f"{fields}, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Audits of ``rows`` with the hash of each repaired conversation."""
    found = materialize(rows.sparkSession, audits(rows), "audits")
    return repair_hashes(rows, found)
