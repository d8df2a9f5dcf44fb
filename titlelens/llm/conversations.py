"""Repair of conversations: the cheapest edits that make the turns an optional system turn and
then user and assistant in turn, or nothing at all.

The edits of a conversation are paths over a lattice: a node is how many rows are used up and
which role came last, an edge keeps, reroles or deletes the next row, or inserts an empty one.
Dijkstra's search runs from both ends, always on the side whose heap has the nearer node.  When
the two nearest nodes are together farther than the best path found, every path of that cost
crosses from nodes settled on one side to nodes settled on the other.  All these crossings are
kept, the nodes that lead to one are marked, and a walk from the start takes the least letter
that stays on such a path.  A letter leads from a node to one other, so that walk spells the
least audit of all, and the audit alone says what the repaired rows are.

Two shuffles by conversation, both streamed in order.  The first carries a few numbers of each
row and finds the edits; equal sequences of kinds of rows are solved once per worker.  The second
brings the rows with their texts to the edits and applies them row by row, so that no task holds
the texts of a conversation.  It does hold some dozens of bytes for each row of the conversation
at hand; its audit, which has a letter for each row, is a single value of the result anyway.

Edge cases: a null role or text is one space; a null conversation id is a conversation of its
own; null turns come first; rows of equal turn go by a hash of role and text, so equal ones stand
side by side; a role is known by its first character; a conversation of which no row is present
has zeros, an empty audit and the hash of the empty string; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Costs, and the characters that end a finished row or are blank.
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
ENDS = ".!?"
BLANKS = " \t\n\x0b\x0c\r"
DAMAGE_EVERY = 20

# States: what came last.  Only an untouched conversation and an assistant's turn may end it.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_FINAL = (_START, _ASSISTANT)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
# The state that a new user or assistant turn leads to.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
# What state a kept row of that initial leads to.
_KEPT = {("s", _START): _SYSTEM, ("u", _START): _USER, ("u", _SYSTEM): _USER,
         ("a", _USER): _ASSISTANT, ("u", _ASSISTANT): _USER}
# Kinds of rows: an initial (o: any other), in upper case if the row is unfinished; must go.
GOES = "x"
REMEMBERED_ROWS, REMEMBERED = 64, 50_000


def _onward(kinds: str, node: int) -> list[tuple[str, int, int]]:
    """The edges from a node: letter, cost, other node."""
    at, state = divmod(node, 4)
    edges = [("I", INSERT, node - state + _NEXT[state])]
    if at < len(kinds):
        kind, after = kinds[at], node - state + 4
        edges.append(("D", DELETE, after + state))
        if kind != GOES:
            more = UNFINISHED if kind.isupper() else 0
            edges.append(("R", REROLE + more, after + _NEXT[state]))
            kept = _KEPT.get((kind.lower(), state))
            if kept is not None:
                edges.append(("K", KEEP + more, after + kept))
    return edges


def _backward(kinds: str, node: int) -> list[tuple[int, int]]:
    """The edges that lead to a node: cost, other node."""
    at, state = divmod(node, 4)
    rows = range(node - state, node - state + 4)
    if at:
        rows = range(node - state - 4, node - state + 4)
    return [(cost, other) for other in rows for _, cost, to in _onward(kinds, other) if to == node]


def solve(kinds: str) -> tuple[int, str]:
    """The least cost and, among the edits of that cost, the least audit in ASCII order."""
    n = len(kinds)
    ends = [n * 4 + state for state in _FINAL]
    near, far = {0: 0}, dict.fromkeys(ends, 0)  # the best known distances
    ahead, behind = [(0, 0)], [(0, end) for end in ends]
    settled, resolved = {}, {}
    best = min((near[e] + far[e] for e in ends if e in near), default=None)
    while ahead and behind:
        while ahead and ahead[0][1] in settled:
            heappop(ahead)
        while behind and behind[0][1] in resolved:
            heappop(behind)
        if not ahead or not behind or (best is not None and ahead[0][0] + behind[0][0] > best):
            break
        if ahead[0][0] <= behind[0][0]:
            d, node = heappop(ahead)
            settled[node] = d
            mine, other, heap = near, far, ahead
            edges = [(cost, to) for _, cost, to in _onward(kinds, node)]
        else:
            d, node = heappop(behind)
            resolved[node] = d
            mine, other, heap = far, near, behind
            edges = _backward(kinds, node)
        for cost, to in edges:
            if d + cost < mine.get(to, d + cost + 1):
                mine[to] = d + cost
                heappush(heap, (d + cost, to))
            if to in other and (best is None or d + cost + other[to] < best):
                best = d + cost + other[to]
    # An end is no way from itself, though the search from it may not have begun.
    return best, _least_audit(kinds, settled, dict.fromkeys(ends, 0) | resolved, best)


def _least_audit(kinds: str, settled: dict[int, int], resolved: dict[int, int], best: int) -> str:
    """The least letters along the paths of cost `best`, from all crossings of the two searches."""
    def leads(node: int, d: int, cost: int, to: int, marked: set[int]) -> bool:
        if to in resolved:
            return d + cost + resolved[to] == best
        return to in marked and settled[to] == d + cost

    # Nodes were settled by distance and place, so an edge of such a path leads to a later one.
    marked: set[int] = set()
    for node in reversed(settled):
        if node not in resolved and any(leads(node, settled[node], cost, to, marked)
                                        for _, cost, to in _onward(kinds, node)):
            marked.add(node)
    letters, node, d = [], 0, 0
    while d < best or node // 4 < len(kinds):
        letter, cost, node = min(e for e in _onward(kinds, node)
                                 if leads(node, d, e[1], e[2], marked))
        letters.append(letter)
        d += cost
    return "".join(letters)


_solved = lru_cache(REMEMBERED)(solve)


def edits(kinds: str) -> tuple[int, str]:
    """`solve`, with short sequences remembered."""
    return _solved(kinds) if len(kinds) <= REMEMBERED_ROWS else solve(kinds)


def applied(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """The repaired rows as (letter, role, text), from the audit and the rows in order."""
    rows, state = iter(rows), _START
    for letter in audit:
        role, text = (None, "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = _KEPT[role[0], state]
        else:
            state = _NEXT[state]
            role = _NAMES[state]
        yield letter, role, text


# --- the rows and their faults -----------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: planted faults, by a checksum of conversation and turn.

    0 of 20 drops the row (it stays as one that is not present), 1 empties its text, 2 takes the
    marks that end sentences out of it, 3 repeats it, 4 makes it the user's.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    which = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % DAMAGE_EVERY
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"),
                                shown("text").alias("text"), which.alias("which"))
    text = (F.when(F.col("which") == 1, "")
            .when(F.col("which") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")))
    twice = F.explode(F.sequence(F.lit(0), (F.col("which") == 3).cast("int")))
    return rows.select("conv_id", "turn",
                       F.when(F.col("which") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("which") != 0).alias("present"),
                       twice.alias("again")).drop("again")


_ORDER = ["turn", "h1", "h2"]


def _rows(conversations: DataFrame, present: str | None) -> DataFrame:
    role = F.coalesce(F.col("role"), F.lit(" "))
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"),
        text.alias("text"), (F.lit(True) if present is None else F.col(present)).alias("present"))
    # Two hashes of 64 bits tell role and text from others.
    return rows.withColumns({"h1": F.xxhash64("role", "text"),
                             "h2": F.xxhash64(F.lit(1), "text", "role")})


_FOUND = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string")


def _judged(conv_id: object, rows: Iterable[tuple]) -> tuple:
    kinds, seen, turns, held = [], set(), 0, ""
    least = most = last = None
    blank = duplicate = truncated = illegal = n = 0
    for _, turn, initial, h1, h2, empty, ended in rows:
        if turn is not None:
            if least is None:
                least = turn
            turns += turn != last
            most = last = turn
        illegal += n > 0 and held + initial not in ("su", "ua", "au")
        held, n = initial, n + 1
        kind = initial if initial in ("s", "u", "a") else "o"
        if empty:
            blank, kind = blank + 1, GOES
        elif (h1, h2) in seen:
            duplicate, kind = duplicate + 1, GOES
        else:
            seen.add((h1, h2))
            if not ended:
                truncated, kind = truncated + 1, kind.upper()
        kinds.append(kind)
    gaps = 0 if least is None else min(most - least + 1 - turns, (1 << 63) - 1)
    return conv_id, gaps, blank, duplicate, truncated, illegal, *edits("".join(kinds))


def _stream(batches: Iterator[pa.RecordBatch], results: Callable[[Iterator[tuple]], Iterator[tuple]],
            fields: list[tuple[str, pa.DataType]], most: int = 1 << 20
            ) -> Iterator[pa.RecordBatch]:
    """`results` over the rows of all batches, in batches of some thousand rows or of about
    `most` characters.  The first column, the conversation, keeps its type."""
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return
    schema = pa.schema([first.schema.field(0), *fields])
    rows = (row for batch in chain([first], batches)
            for row in zip(*[column.to_pylist() for column in batch.columns]))

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], names=schema.names)

    held, chars = [], 0
    for row in results(rows):
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) == 4096 or chars > most:
            yield batch(held)
            held, chars = [], 0
    if held:
        yield batch(held)


_FOUND_FIELDS = [*[(name, pa.int64()) for name in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())]


def find_edits(conversations: DataFrame, present: str | None = None) -> DataFrame:
    """Per conversation its faults, the least cost and the audit.  Rows that are false in the
    column named by `present` only have their conversation listed."""
    rows = _rows(conversations, present)
    stripped = F.rtrim("text", F.lit(BLANKS))
    judged = rows.select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "h1", "h2",
        (stripped == "").alias("empty"),
        F.substring(stripped, -1, 1).isin(*ENDS).alias("ended"), "present")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(stream: Iterator[tuple]) -> Iterator[tuple]:
            for conv_id, rows in groupby(stream, key=lambda r: r[0]):
                yield _judged(conv_id, (r[:-1] for r in rows if r[-1]))

        yield from _stream(batches, results, _FOUND_FIELDS)

    kind = rows.schema["conv_id"].dataType.simpleString()
    return (judged.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
            .mapInArrow(judge, f"conv_id {kind}, {_FOUND}"))


def _with_edits(conversations: DataFrame, found: DataFrame, present: str | None) -> DataFrame:
    """The edits of a conversation, then its rows in order, in one partition."""
    rows = _rows(conversations, present).filter("present")
    names = [f.name for f in found.schema if f.name != "conv_id"]
    edits_first = found.select("conv_id", F.lit(0).alias("kind"), *[
        F.lit(None).cast(t).alias(c) for c, t in (
            ("turn", "long"), ("h1", "long"), ("h2", "long"), ("role", "string"),
            ("text", "string"))], F.struct(*names).alias("found"))
    then_rows = rows.select("conv_id", F.lit(1).alias("kind"), *_ORDER, "role", "text", F.lit(
        None).cast(edits_first.schema["found"].dataType).alias("found"))
    both = edits_first.unionByName(then_rows)
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER)
            .select("conv_id", "role", "text", "found"))


def repair_report(conversations: DataFrame, present: str | None = None) -> DataFrame:
    """One row per conversation: its faults, cost, audit, and the SHA-256 of the repaired rows."""
    found = find_edits(conversations, present)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(stream: Iterator[tuple]) -> Iterator[tuple]:
            for conv_id, rows in groupby(stream, key=lambda r: r[0]):
                told = next(rows)[3]
                sha, between = hashlib.sha256(), ""
                for _, role, text in applied(told["audit"], ((r[1], r[2]) for r in rows)):
                    sha.update(f"{between}{role}:{text}".encode())
                    between = "\n"
                yield conv_id, *told.values(), sha.hexdigest()

        yield from _stream(batches, results, [*_FOUND_FIELDS, ("repaired_sha256", pa.string())])

    kind = found.schema["conv_id"].dataType.simpleString()
    return _with_edits(conversations, found, present).mapInArrow(
        digest, f"conv_id {kind}, {_FOUND}, repaired_sha256 string")


def repair(conversations: DataFrame, present: str | None = None) -> DataFrame:
    """conv_id, position (from 0), role, text, edit (K, R or I): the repaired rows themselves."""
    found = find_edits(conversations, present)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(stream: Iterator[tuple]) -> Iterator[tuple]:
            for conv_id, rows in groupby(stream, key=lambda r: r[0]):
                told = next(rows)[3]
                for i, (letter, role, text) in enumerate(
                        applied(told["audit"], ((r[1], r[2]) for r in rows))):
                    yield conv_id, i, role, text, letter

        yield from _stream(batches, results, [
            ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()),
            ("edit", pa.string())])

    kind = found.schema["conv_id"].dataType.simpleString()
    return _with_edits(conversations, found, present).mapInArrow(
        write, f"conv_id {kind}, position long, role string, text string, edit string")
