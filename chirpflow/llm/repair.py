"""Conversation structure repair by a rank-convergent parallel Viterbi search.

The cheapest edits that give a conversation's roles the form ``(s?(ua)+)?`` are a
shortest path over four states: nothing yet, after s, after u, after a.  Costs to
the end run backwards over the rows as vectors of four numbers, and only their
differences decide anything.

Rows are sorted by conversation and turn over all tasks and cut into chunks of
bounded size, so a conversation of any length is many rows of a table, never a
group.  Every chunk first runs from a speculative vector at its end.  Fix-up
passes hand each chunk the vector at its successor's start and run it again, only
until old and new vectors differ by a constant (their rank has converged); they
end when no chunk's vector at the end changes.  Passes cover 1, 2, 4, ... chunks
in a row at a time, so also rows that never converge need few passes.  The costs
are stitched by adding the constants up.  The edits are then traced forwards, the
state at a chunk's start settled in the same way, always taking the least letter
among the edits that lie on a cheapest path.

Rows that must go (blank, duplicate) leave every vector as it is but for the cost
of one Delete; they are not searched.

Edge cases: rows go by turn (NULL first), rows of equal turn by role, then by the
first 64 characters of the text, then by its hash; NULLs are one space, also in
the damage's key; a role with another initial than s, u, a, or with none, cannot be
kept; a conversation without rows gives zeros, an empty audit and the digest of the
empty string; rows without an id are one conversation; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prepare import partition_bases
from . import common as C

# The contract's costs, white space and role initials.
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
LEGAL = {"su", "ua", "au"}
ROLES = {2: "user", 3: "assistant"}

#: States: nothing yet, after s, after u, after a.  What one more user or
#: assistant row leads to, and where a kept row of initial s, u, a leads.
NEXT = (2, 2, 3, 2)
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
INITIALS = "sua"

CHUNK_ROWS, CHUNK_BYTES = 128, 1 << 20
#: A fix-up pass lets one task follow at most so many chunks.
MOST_CHUNKS = 1 << 14


# ------------------------------------------------------------------- damage

def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, there)``: the rows after damage by
    ``crc32(conv_id:turn) % 20``; dropped rows stay, with ``there`` false."""
    def spelled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                spelled("role").alias("role"), spelled("text").alias("text"))
    kind = F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", kind.alias("kind"), "role", "text")
    text = (F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("kind") != 0).alias("there"), F.explode(copies).alias("copy")).drop("copy")


# ------------------------------------------------------------------- search

def closed(v: list[int]) -> list[int]:
    """Costs if rows may be inserted first; from any state two lead through both
    states that inserted rows reach."""
    return [min(v[x], INSERT + v[NEXT[x]], 2 * INSERT + v[NEXT[NEXT[x]]]) for x in range(4)]


#: Costs after the last row: the forms end with nothing or after an a.
DONE = bytes(closed([0, 1 << 20, 1 << 20, 0]))
SPECULATIVE = DONE


def symbol(initial: str, cut_short: bool) -> int:
    """A row as the search sees it: its initial and whether its text is cut short."""
    return 2 * (INITIALS.find(initial) if initial else -1) + 2 + cut_short


def row_costs(code: int, v: bytes) -> list[list[tuple[str, int, int]]]:
    """Per state the row's edits ``(letter, cost to the end, next state)``."""
    initial, extra = code // 2 - 1, CUT_SHORT * (code & 1)
    out = []
    for x in range(4):
        own = [("D", DELETE + v[x], x)]
        to = KEPT[INITIALS[initial]][x] if initial >= 0 else None
        if to is not None:
            own.append(("K", KEEP + extra + v[to], to))
        own.append(("R", REROLE + extra + v[NEXT[x]], NEXT[x]))
        out.append(own)
    return out


class Search:
    """Backward steps and forward traces, each computed once per vector, symbol and state.
    Vectors are four bytes whose least is 0, so few occur."""

    def __init__(self):
        self.steps: dict[tuple[bytes, int], tuple[bytes, int]] = {}
        self.moves: dict[tuple[bytes, int, int], tuple[list[int], str, int]] = {}

    def step(self, v: bytes, code: int) -> tuple[bytes, int]:
        """The vector before a row and the constant taken off it."""
        known = self.steps.get((v, code))
        if known is None:
            full = closed([min(cost for _, cost, _ in own) for own in row_costs(code, v)])
            least = min(full)
            known = self.steps[v, code] = bytes([c - least for c in full]), least
        return known

    def back(self, codes: bytes, v: bytes) -> tuple[bytes, int]:
        """The vector before all rows, and the constants' sum."""
        gain = 0
        for code in reversed(codes):
            v, least = self.step(v, code)
            gain += least
        return v, gain

    def fixed(self, codes: bytes, old: bytes, new: bytes, start: bytes, gain: int) -> tuple[bytes, int]:
        """``back`` from ``new``, given its result from ``old``: both run until they are equal."""
        at = len(codes)
        while old != new and at:
            at -= 1
            old, a = self.step(old, codes[at])
            new, b = self.step(new, codes[at])
            gain += b - a
        return (start if old == new else new), gain

    def vectors(self, codes: bytes, v: bytes) -> list[bytes]:
        """The vector after each row."""
        out = []
        for code in reversed(codes):
            out.append(v)
            v = self.step(v, code)[0]
        return out[::-1]

    def move(self, v: bytes, code: int, x: int) -> tuple[list[int], str, int]:
        """From state ``x`` before a row: states of inserted rows, the row's letter, the next state."""
        known = self.moves.get((v, code, x))
        if known is None:
            costs = row_costs(code, v)
            full = closed([min(cost for _, cost, _ in own) for own in costs])
            inserted, at = [], x
            while True:  # letters in ASCII order: D, I, K, R
                own = {letter: to for letter, cost, to in costs[at] if cost == full[at]}
                if "D" not in own and INSERT + full[NEXT[at]] == full[at]:
                    at = NEXT[at]
                    inserted.append(at)
                    continue
                letter = min(own)
                break
            known = self.moves[v, code, x] = inserted, letter, own[letter]
        return known

    def passed(self, codes: bytes, end: bytes) -> bytes:
        """The state after all rows for each state before them."""
        after = self.vectors(codes, end)
        out = []
        for x in range(4):
            for v, code in zip(after, codes):
                x = self.move(v, code, x)[2]
            out.append(x)
        return bytes(out)


def search() -> Search:
    return C.kept_by("repair", Search)


# ------------------------------------------------------------------- chunks

CHUNKS = ("at long, conv_id long, whole boolean, turns array<long>, roles array<string>, texts array<string>, "
          "keys array<binary>")
_CHUNK_TYPES = pa.schema([("at", pa.int64()), ("conv_id", pa.int64()), ("whole", pa.bool_()),
                          ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
                          ("texts", pa.list_(pa.string())), ("keys", pa.list_(pa.binary()))])


def is_blank(text: str) -> bool:
    return not text.strip(SPACE)


def row_key(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def chunked(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Sorted rows in chunks (``CHUNKS``), written once.  ``at`` grows along the
    order and is NULL for a chunk without rows (a conversation, or a task's share
    of one, of which all is dropped); ``whole`` chunks hold all of a conversation.
    ``keys`` are digests of role and text for looking up duplicates in other chunks."""
    def run(batches):
        part, number = TaskContext.get().partitionId() << 33, 0
        run_id: list = []          # the conversation whose rows are being read
        first_run, n_chunks = True, 0
        held: list[tuple] = []
        size = 0
        ready: list[dict] = []

        def close(whole: bool):
            nonlocal number, n_chunks, held, size
            if held or not n_chunks:
                turns, roles, texts = map(list, zip(*held)) if held else ([], [], [])
                keys = [] if whole else sorted({row_key(r, t) for r, t in zip(roles, texts) if not is_blank(t)})
                ready.append({"at": part + number if held else None, "conv_id": run_id[0], "whole": whole,
                              "turns": turns, "roles": roles, "texts": texts, "keys": keys})
                number += bool(held)
                n_chunks += 1
                held, size = [], 0

        def flushed():
            out = pa.RecordBatch.from_pylist(ready, schema=_CHUNK_TYPES)
            ready.clear()
            return out
        for batch in C.small_batches(batches, 4 << 20):
            for conv_id, turn, role, text, there in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "turn", "role", "text", "there"))):
                if not run_id or conv_id != run_id[0]:
                    if run_id:
                        close(whole=not first_run and not n_chunks)
                        first_run = False
                    run_id, n_chunks = [conv_id], 0
                if there:
                    if held and (len(held) >= chunk_rows or size >= chunk_bytes):
                        close(whole=False)
                    held.append((turn, role, text))
                    size += len(text) + len(role)
            if ready:
                yield flushed()
        if run_id:
            close(whole=False)
            yield flushed()
    ordered = (rows.withColumn("_tie", F.monotonically_increasing_id())
               .orderBy(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", F.substring("text", 1, 64),
                        F.xxhash64("text"), "_tie").drop("_tie"))
    return C.write_once(ordered.mapInArrow(run, CHUNKS), "repair_chunks")


def numbered(chunks: DataFrame) -> DataFrame:
    """``idx`` instead of ``at``: chunks with rows are numbered without gaps, so a
    conversation's next chunk is the next number.  Broadcasts one row per partition."""
    bases = partition_bases(chunks.filter(F.col("at").isNotNull()), "at")
    placed = chunks.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(bases), "part", "left")
    return placed.withColumn("idx", F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "base", "at")


def seen_before(parts: DataFrame) -> DataFrame:
    """``(idx, seen)``: keys of a chunk that an earlier chunk of its conversation holds."""
    keys = parts.select("conv_id", "idx", F.explode("keys").alias("key"))
    first = keys.groupBy("conv_id", "key").agg(F.min("idx").alias("first")).select(
        F.col("conv_id").alias("of"), F.col("key").alias("own"), "first")
    again = keys.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("own")))
    return again.filter(F.col("idx") > F.col("first")).groupBy("idx").agg(F.collect_list("key").alias("seen"))


def faults(roles: list[str], texts: list[str], seen: set[bytes]) -> list[str]:
    """Each row's first fault: ``blank``, ``duplicate``, ``truncated`` or none."""
    out, own = [], set()
    for role, text in zip(roles, texts):
        core = text.rstrip(SPACE)
        if not core:
            out.append("blank")
        elif (role, text) in own or (seen and row_key(role, text) in seen):
            out.append("duplicate")
        else:
            own.add((role, text))
            out.append("" if core[-1] in ENDS else "truncated")
    return out


def searched(roles: list[str], faulty: list[str]) -> bytes:
    """Symbols of the rows that may stay."""
    return bytes([symbol(r[:1], f == "truncated") for r, f in zip(roles, faulty) if f in ("", "truncated")])


# ----------------------------------------------------------------- stitching

def in_order(t: pa.Table) -> list[dict]:
    return t.sort_by("idx").to_pylist()


def settled(spark_rows: DataFrame, name: str, side: int, given: Column, fix, schema: str) -> DataFrame:
    """Passes of ``fix`` until it changes nothing.  ``fix(row, incoming)`` updates a
    row from its neighbour on ``side`` (1: the next chunk, -1: the one before) and
    returns what the neighbour on the other side is to get; ``given`` is that value
    as a column of the table.  Each pass is written once."""
    types = pa.schema([(k, {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "int": pa.int32()}[v])
                       for k, v in (x.split(" ") for x in schema.split(", "))])
    width, rows = 1, spark_rows

    def run(t: pa.Table) -> pa.Table:
        own = in_order(t)
        carried, at = None, None
        for row in own[::-side]:
            incoming = carried if at is not None and row["idx"] + side == at else row["given"]
            row["changed"] = False
            carried, at = fix(row, incoming), row["idx"]
        return pa.Table.from_pylist(own, schema=types)
    while True:
        passed = rows.select((F.col("idx") - side).alias("idx"), given.alias("given"))
        joined = rows.join(passed, "idx", "left").withColumn("block", F.floor(F.col("idx") / width))
        rows = C.write_once(joined.groupBy("block").applyInArrow(run, schema), f"repair_{name}")
        if not rows.filter("changed").limit(1).count():
            return rows
        width = min(2 * width, MOST_CHUNKS)


STATES = ("idx long, ahead boolean, behind boolean, codes binary, end binary, start binary, gain long, moves binary, "
          "state int, changed boolean")


def stitched(parts: DataFrame) -> DataFrame:
    """For chunks of conversations that have several: ``idx, end, gain, state``
    (the cost vector after the chunk, its constants, the state before it), and of
    the chunk before its last turn and initial."""
    links = C.write_once(parts, "repair_links")
    ahead = links.select((F.col("idx") - 1).alias("idx"), F.col("conv_id").alias("next_id"), F.lit(True).alias("more"))
    behind = links.select((F.col("idx") + 1).alias("idx"), F.col("conv_id").alias("before_id"), F.lit(True).alias("had"),
                          F.col("last_turn").alias("before_turn"), F.col("last_initial").alias("before_initial"))
    same_next = F.coalesce(F.col("more"), F.lit(False)) & F.col("conv_id").eqNullSafe(F.col("next_id"))
    same_before = F.coalesce(F.col("had"), F.lit(False)) & F.col("conv_id").eqNullSafe(F.col("before_id"))
    chain = links.join(ahead, "idx", "left").join(behind, "idx", "left").select(
        "idx", same_next.alias("ahead"), same_before.alias("behind"), "codes",
        F.when(same_before, F.col("before_turn")).alias("before_turn"),
        F.when(same_before, F.col("before_initial")).alias("before_initial"))
    chain = C.write_once(chain, "repair_chain")

    def first(batches):
        find = search()
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row["end"] = SPECULATIVE if row["ahead"] else DONE
                row["start"], row["gain"] = find.back(row["codes"], row["end"])
                row |= {"moves": b"", "state": 0, "changed": False}
            yield pa.RecordBatch.from_pylist(rows, schema=_STATE_TYPES)

    def backward(row: dict, incoming: bytes | None) -> bytes:
        if row["ahead"] and incoming != row["end"]:
            row["start"], row["gain"] = search().fixed(row["codes"], row["end"], incoming, row["start"], row["gain"])
            row["end"], row["changed"] = incoming, True
        return row["start"]

    def moves(batches):
        find = search()
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row["moves"] = find.passed(row["codes"], row["end"])
                row["state"] = 3 if row["behind"] else 0
            yield pa.RecordBatch.from_pylist(rows, schema=_STATE_TYPES)

    def forward(row: dict, incoming: int | None) -> int:
        if row["behind"] and incoming != row["state"]:
            row["state"], row["changed"] = incoming, True
        return row["moves"][row["state"]]
    speculated = chain.select("idx", "ahead", "behind", "codes").mapInArrow(first, STATES)
    costs = settled(C.write_once(speculated, "repair_first"), "costs", 1, F.col("start"), backward, STATES)
    traced = C.write_once(costs.mapInArrow(moves, STATES), "repair_moves")
    reached = F.conv(F.hex(F.substring("moves", F.col("state") + 1, F.lit(1))), 16, 10).cast("int")
    states = settled(traced, "states", -1, reached, forward, STATES)
    return states.select("idx", "ahead", "end", "start", "gain", "state").join(
        chain.select("idx", "behind", "before_turn", "before_initial"), "idx")


_STATE_TYPES = pa.schema([("idx", pa.int64()), ("ahead", pa.bool_()), ("behind", pa.bool_()), ("codes", pa.binary()),
                          ("end", pa.binary()), ("start", pa.binary()), ("gain", pa.int64()), ("moves", pa.binary()),
                          ("state", pa.int32()), ("changed", pa.bool_())])


# ------------------------------------------------------------------- repair

PIECES = ("conv_id long, idx long, blank long, duplicate long, truncated long, illegal long, cost long, low long, "
          "high long, distinct long, audit string, repaired string")
_PIECE_TYPES = pa.schema([(k, pa.string() if v == "string" else pa.int64())
                          for k, v in (x.split(" ") for x in PIECES.split(", "))])


def piece(chunk: dict, find: Search) -> dict:
    """A chunk's counts, its part of the audit and its repaired rows (NULL: none).
    A whole conversation has no ``end``, ``state`` or neighbours."""
    roles, texts, turns = chunk["roles"], chunk["texts"], chunk["turns"]
    faulty = faults(roles, texts, set(chunk.get("seen") or ()))
    codes = searched(roles, faulty)
    behind, ahead = bool(chunk.get("behind")), bool(chunk.get("ahead"))
    end = chunk.get("end") or DONE
    if "gain" in chunk and chunk["gain"] is not None:
        start, gain = chunk["start"], chunk["gain"]
    else:
        start, gain = find.back(codes, end)
    state = chunk.get("state") or 0
    cost = gain + (0 if behind else start[0]) + DELETE * sum(f in ("blank", "duplicate") for f in faulty)
    after = iter(zip(find.vectors(codes, end), codes))
    audit, out = [], []
    for role, text, fault in zip(roles, texts, faulty):
        if fault in ("blank", "duplicate"):
            audit.append("D")
            continue
        inserted, letter, state = find.move(*next(after), state)
        audit.append("I" * len(inserted) + letter)
        out += [f"{ROLES[x]}:" for x in inserted]
        if letter != "D":
            out.append(f"{role if letter == 'K' else ROLES[state]}:{text}")
    if not ahead:
        while state in (1, 2):
            state = NEXT[state]
            audit.append("I")
            out.append(f"{ROLES[state]}:")
    initials = [r[:1] for r in roles]
    if behind:
        initials.insert(0, chunk["before_initial"])
    known = [t for t in turns if t is not None]
    distinct = len(set(known)) - (behind and bool(known) and known[0] == chunk["before_turn"])
    return {"conv_id": chunk["conv_id"], "idx": chunk["idx"], "blank": faulty.count("blank"),
            "duplicate": faulty.count("duplicate"), "truncated": faulty.count("truncated"),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "cost": cost,
            "low": min(known, default=None), "high": max(known, default=None), "distinct": distinct,
            "audit": "".join(audit), "repaired": "\n".join(out) if out else None}


def pieces_of(batches):
    find = search()
    for batch in C.small_batches(batches, 4 << 20):
        yield pa.RecordBatch.from_pylist([piece(row, find) for row in batch.to_pylist()], schema=_PIECE_TYPES)


REPAIRED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string")
_REPAIRED_TYPES = pa.schema([(k, pa.string() if v == "string" else pa.int64())
                             for k, v in (x.split(" ") for x in REPAIRED.split(", "))])


def summed_up(batches):
    """One row per conversation from its pieces, which follow each other; a
    running digest holds the repaired rows."""
    COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost", "distinct")
    own: dict = {}

    def row():
        gaps = own["high"] - own["low"] + 1 - own["distinct"] if own["low"] is not None else 0
        return {"conv_id": own["conv_id"], "gaps": gaps, **{k: own[k] for k in COUNTS if k != "distinct"},
                "audit": "".join(own["audit"]), "repaired_sha256": own["hash"].hexdigest()}
    for batch in batches:
        done = []
        for p in batch.to_pylist():
            if not own or own["conv_id"] != p["conv_id"]:
                if own:
                    done.append(row())
                own = {"conv_id": p["conv_id"], "low": None, "high": None, "audit": [], "hash": hashlib.sha256(),
                       "some": False, **dict.fromkeys(COUNTS, 0)}
            for k in COUNTS:
                own[k] += p[k]
            for k, better in (("low", min), ("high", max)):
                own[k] = better([x for x in (own[k], p[k]) if x is not None], default=None)
            own["audit"].append(p["audit"])
            if p["repaired"] is not None:
                own["hash"].update((("\n" if own["some"] else "") + p["repaired"]).encode())
                own["some"] = True
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_REPAIRED_TYPES)
    if own:
        yield pa.RecordBatch.from_pylist([row()], schema=_REPAIRED_TYPES)


def repair(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``REPAIRED`` for every ``conv_id`` of the rows after damage.  A conversation
    in one chunk needs nothing else; the chunks of all others are joined with
    their neighbours' vectors and states."""
    C.ready(conversations.sparkSession)
    chunks = numbered(chunked(damaged(conversations), chunk_rows))
    columns = ["conv_id", "idx", "turns", "roles", "texts"]
    whole = chunks.filter("whole").select(*columns).mapInArrow(lambda b: summed_up(pieces_of(b)), REPAIRED)
    parts = chunks.filter("NOT whole AND idx IS NOT NULL")
    empty = chunks.filter("NOT whole AND idx IS NULL").select(*columns).mapInArrow(pieces_of, PIECES)
    seen = C.write_once(seen_before(parts.select("conv_id", "idx", "keys")), "repair_seen")
    known = parts.select(*columns).join(seen, "idx", "left")

    def codes(batches):
        for batch in C.small_batches(batches, 4 << 20):
            out = []
            for c in batch.to_pylist():
                faulty = faults(c["roles"], c["texts"], set(c["seen"] or ()))
                out.append({"idx": c["idx"], "conv_id": c["conv_id"], "codes": searched(c["roles"], faulty),
                            "last_turn": c["turns"][-1], "last_initial": c["roles"][-1][:1]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("idx", pa.int64()), ("conv_id", pa.int64()), ("codes", pa.binary()), ("last_turn", pa.int64()),
                ("last_initial", pa.string())]))
    links = known.mapInArrow(codes, "idx long, conv_id long, codes binary, last_turn long, last_initial string")
    several = known.join(stitched(links), "idx").mapInArrow(pieces_of, PIECES).unionByName(empty)
    in_turn = several.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("idx"))
    return whole.unionByName(in_turn.mapInArrow(summed_up, REPAIRED))
