"""Conversation repair (13) against exhaustive search over edits."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chirpflow.llm import repair as R

FORM = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, idx long, state int, seen string"


def damage(rows):
    """Rows of one conversation after damage, in order; a row is (conv_id, turn, role, text)."""
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind in (0, 1):
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: ((r[0] is not None, r[0] or 0), r[1], r[2]))


def plain_faults(rows):
    out = []
    for i, (_, role, text) in enumerate(rows):
        core = re.findall(r"[^\x20\x09-\x0D]", text)
        if not core:
            out.append("blank")
        elif (role, text) in [(r, x) for _, r, x in rows[:i]]:
            out.append("duplicate")
        else:
            out.append("" if core[-1] in ".!?" else "truncated")
    return out


def cheapest(rows, faulty):
    """(cost, audit, repaired rows) by trying every edit, over the distinct role
    initials written so far that can still be completed."""
    best = {"": (0, "", ())}

    def keep(best, form, new):
        if FORM.fullmatch(form) or FORM.fullmatch(form + "a") or FORM.fullmatch(form + "ua"):
            last = form[-1:]  # what may follow depends on the last initial alone
            if last not in best or new[:2] < best[last][:2]:
                best[last] = new
    # a form is kept by its last initial: rebuild a legal form that ends with it
    legal = {"": "", "s": "s", "u": "u", "a": "ua"}
    for (_, role, text), fault in zip(rows, faulty):
        start = {legal[f]: v for f, v in best.items()}
        wide = {}
        for form, v in start.items():
            keep(wide, form, v)
        for _ in range(3):
            for f, (cost, audit, out) in list(wide.items()):
                for name in ("user", "assistant"):
                    keep(wide, legal[f] + name[0], (cost + 3, audit + "I", out + (f"{name}:",)))
        best = {}
        extra = 3 if fault == "truncated" else 0
        for f, (cost, audit, out) in wide.items():
            keep(best, legal[f], (cost + 4, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            if role:
                keep(best, legal[f] + role[0], (cost + extra, audit + "K", out + (f"{role}:{text}",)))
            for name in ("user", "assistant"):
                keep(best, legal[f] + name[0], (cost + 3 + extra, audit + "R", out + (f"{name}:{text}",)))
    for _ in range(3):
        for f, (cost, audit, out) in list(best.items()):
            for name in ("user", "assistant"):
                keep(best, legal[f] + name[0], (cost + 3, audit + "I", out + (f"{name}:",)))
    return min(v for f, v in best.items() if f in ("", "a"))


def wanted(conv_rows):
    rows = damage(conv_rows)
    faulty = plain_faults(rows)
    cost, audit, out = cheapest(rows, faulty)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv_rows[0][0], gaps, faulty.count("blank"), faulty.count("duplicate"), faulty.count("truncated"),
            illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for c in [None, *range(n)]:
        kind = rng.random()
        roles = ["user", "assistant"] if kind < 0.4 else ["user", "assistant", "system", None, "tool", "", "ua"]
        texts = ["Fine. ", "yes", "No!", "", " \n", None, "a b", "é.", "."] if kind < 0.8 else ["cut short"]
        start = rng.choice([0, 0, 5, 100])
        for i in range(rng.choice([1, 2, 3, 8, longest])):
            turn = rng.choice([start + i] * 12 + [None, start + 2 * i, start])
            text = rng.choice(texts)
            role = roles[i % 2] if rng.random() < 0.5 else rng.choice(roles)
            out.append((c, turn, role, text if text is None or rng.random() < 0.3 else f"{i} {text}"))
    return out


def test_one_conversation_equals_exhaustive_search():
    for seed in range(6):
        rows = conversations(seed, 60, 14)
        for c in {r[0] for r in rows}:
            own = [r for r in rows if r[0] == c]
            after = damage(own)
            chunk = {"conv_id": c, "idx": 0, "turns": [t for t, _, _ in after], "roles": [r for _, r, _ in after],
                     "texts": [x for _, _, x in after]}
            got = R.piece(chunk, R.Search())
            want = wanted(own)
            sha = hashlib.sha256((got["repaired"] or "").encode()).hexdigest()
            assert (got["blank"], got["duplicate"], got["truncated"], got["illegal"], got["cost"], got["audit"],
                    sha) == want[2:], own


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=40), st.lists(st.integers(0, 7), max_size=40))
def test_a_rerun_stops_where_vectors_differ_by_a_constant(a, b):
    find = R.Search()
    a, b = bytes(a), bytes(b)
    start, gain = find.back(a, R.SPECULATIVE)
    end, later = find.back(b, R.DONE)
    assert find.fixed(a, R.SPECULATIVE, end, start, gain) == find.back(a, end)
    whole = find.back(a + b, R.DONE)
    again = find.back(a, end)
    assert whole == (again[0], again[1] + later)


@pytest.mark.parametrize("chunk_rows", [128, 3, 1])
def test_repair_equals_exhaustive_search_whatever_the_chunks(spark, chunk_rows):
    rows = conversations(11, 25, 30)
    df = spark.createDataFrame([(*r, 5, 1, "s") for r in rows], SCHEMA).repartition(3)
    got = {tuple(r) for r in R.repair(df, chunk_rows).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == {wanted([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}


def test_a_long_conversation_that_never_converges(spark):
    """Rows of an unknown role, cut short: every vector keeps its rank, so what
    the last chunk says reaches the first one by passes alone."""
    rows = [(1, i, "tool", f"row {i}") for i in range(400)] + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    df = spark.createDataFrame([(*r, 5, 1, "s") for r in rows], SCHEMA)
    got = {tuple(r) for r in R.repair(df, 5).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == {wanted([r for r in rows if r[0] == c]) for c in (1, 2)}


def test_copies_in_other_chunks_are_duplicates(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "Same text here." if i % 3 else f"Own {i}.") for i in range(60)]
    df = spark.createDataFrame([(*r, 5, 1, "s") for r in rows], SCHEMA)
    (row,) = R.repair(df, 4).collect()
    assert tuple(row)[:9] == wanted(rows)


def test_empty_tables_and_conversations(spark):
    assert R.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = R.repair(spark.createDataFrame([(gone, 0, "user", "Hi.", 1, 1, "s")], SCHEMA)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
