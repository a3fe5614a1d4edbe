import hashlib
import heapq
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import conversations as C
from landfall.llm.queries import QUERIES

from .conftest import FOLDER

BLANK = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}


def damaged(rows):
    """Rows (conv_id, turn, role, text) after damage, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    return out


def faults_of(turns):
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.strip(BLANK)
        if not bare:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif bare[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
    return faults


def repaired(turns):
    """Least (cost, audit, roles and texts), by search over all edits in that order."""
    faults = faults_of(turns)
    heap = [(0, "", 0, ())]
    best = set()
    while heap:
        cost, audit, at, out = heapq.heappop(heap)
        shape = "".join(r[:1] or "?" for r, _ in out)
        state = at, shape[-1:], shape == "s"
        if at == len(turns) and (not out or (shape[-1] == "a")):
            return cost, audit, out
        if state in best:
            continue
        best.add(state)
        nexts = []
        need = {"": "u", "s": "u", "u": "a", "a": "u"}[shape[-1:]]
        name = {"u": "user", "a": "assistant"}[need]
        nexts.append((cost + 3, audit + "I", at, (*out, (name, ""))))
        if at < len(turns):
            _, role, text = turns[at]
            nexts.append((cost + 4, audit + "D", at + 1, out))
            if faults[at] not in ("blank", "duplicate"):
                more = 3 if faults[at] == "truncated" else 0
                if role[:1] == need or (not out and role[:1] == "s"):
                    nexts.append((cost + more, audit + "K", at + 1, (*out, (role, text))))
                nexts.append((cost + 3 + more, audit + "R", at + 1, (*out, (name, text))))
        for item in nexts:
            heapq.heappush(heap, item)


def expected(rows):
    out = {}
    for conv, turns in damaged(rows).items():
        cost, audit, left = repaired(turns)
        faults = faults_of(turns)
        numbers = sorted({t for t, _, _ in turns if t is not None})
        gaps = numbers[-1] - numbers[0] + 1 - len(numbers) if numbers else 0
        shapes = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in LEGAL for a, b in itertools.pairwise(shapes))
        text = "\n".join(f"{r}:{t}" for r, t in left)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def result(frame):
    return {r["conv_id"]: tuple(r)[1:] for r in frame.collect()}


def frame_of(session, rows):
    rows = [(*r, "x", 1) for r in rows]
    schema = "conv_id long, turn long, role string, text string, kind string, copies int"
    return session.createDataFrame(rows, schema)


def test_query_equals_brute_force(session):
    rows = session.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = rows.select("conv_id", "turn", "role", "text").collect()
    found = QUERIES["op12_conversation_repair"](session, FOLDER)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    assert result(found) == expected([tuple(r) for r in rows])


def made_up(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "assistant", "system", "tool", "", None, "usher", "User"]
    texts = ["Hi.", "Why?", "cut off", "", " \x0b\t", None, "Hi. ", " ", "é!"]
    return [
        (
            rng.choice([None, *range(60)]),
            rng.choice([None, -3, *range(12), 10**12]),
            rng.choice(roles),
            rng.choice(texts),
        )
        for _ in range(n)
    ]


def test_odd_rows_nulls_ties_and_repeats(session):
    rows = made_up(1, 500)
    rows += rows[:50] + [(99, None, None, None)] * 3 + [(100, t, "user", "same.") for t in range(400)]
    found = C.repair(C.damage(frame_of(session, rows)))
    assert result(found) == expected(rows)


def test_conversation_without_rows_after_damage(session):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:5".encode()) % 20 == 0)
    found = result(C.repair(C.damage(frame_of(session, [(conv, 5, "user", "x")]))))
    assert found == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(session):
    assert C.repair(C.damage(frame_of(session, []))).collect() == []


def test_repaired_turns_are_the_hashed_ones(session):
    rows = C.damage(frame_of(session, made_up(2, 300))).cache()
    found = C.audits(rows)
    turns = C.repaired_turns(rows, found).withColumn("line", F.concat("role", F.lit(":"), "text"))
    lines = {}
    for r in turns.orderBy("conv_id", "position").collect():
        lines.setdefault(r["conv_id"], []).append(r["line"])
    for r in C.repair_hashes(rows, found).collect():
        text = "\n".join(lines.get(r["conv_id"], []))
        assert r["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("window", [1, 2, 7, 1 << 16])
def test_windows_of_a_long_conversation_do_not_matter(monkeypatch, window):
    rng = np.random.default_rng(3)
    kinds = [rng.integers(0, 16, n).astype(np.uint8).tobytes() for n in (0, 1, 3, 50, 400)]
    whole = C.least_audits(kinds)
    monkeypatch.setattr(C, "WINDOW", window)
    assert C.least_audits(kinds) == whole


def test_least_audits_of_all_short_conversations():
    names = ["system", "user", "assistant", "tool"]
    every = [bytes(k) for n in range(4) for k in itertools.product([0, 4, 8, 12, 1, 6, 7], repeat=n)]
    for kinds, (cost, audit) in zip(every, C.least_audits(every)):
        turns = []
        for n, kind in enumerate(kinds):
            text = {0: f"{n}.", 1: "", 2: "same", 3: f"{n}"}[kind % 4]
            turns.append((n, names[kind // 4], text))
        if any(k % 4 == 2 for k in kinds):
            continue  # a duplicate needs the turn it repeats
        assert (cost, audit) == repaired(turns)[:2]
