"""Conversation repair against a plain search over all edits, whole and cut into small pieces."""

import hashlib
import random
import re
import zlib

import pytest

from odflow.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, place long, audit string, seen int"
PATTERN = re.compile(r"(s?(ua)+)?\Z")


def plain_edits(rows):
    """(cost, audit, repaired) by rising cost and audit over every edit sequence that can be cheapest, row by row."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    forced = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    seen, best = [], {"": (0, "", ())}

    def inserted(labels):
        out = dict(labels)
        for _ in range(3):
            for state, (cost, audit, done) in list(out.items()):
                role = forced[state]
                found = (cost + 2, audit + "I", (*done, f"{role}:"))
                if role[0] not in out or found[:2] < out[role[0]][:2]:
                    out[role[0]] = found
        return out

    best = inserted(best)
    facts = [0, 0, 0]
    for role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else None
        if fault is not None:
            facts[fault] += 1
        seen.append((role, text))
        found = []
        for state, (cost, audit, done) in best.items():
            found.append((state, (cost + 3, audit + "D", done)))
            if fault in (0, 1):
                continue
            more = 1 if fault == 2 else 0
            if role[:1] in after[state]:
                found.append((after[state][role[:1]], (cost + more, audit + "K", (*done, f"{role}:{text}"))))
            to = forced[state]
            found.append((to[0], (cost + 2 + more, audit + "R", (*done, f"{to}:{text}"))))
        best = {}
        for state, label in found:
            if state not in best or label[:2] < best[state][:2]:
                best[state] = label
        best = inserted(best)
    return min(best[state] for state in ("", "a") if state in best), facts


def plain(rows):
    """All columns by conv_id of rows as they are."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        pairs = [(r[2], r[3]) for r in own]
        (cost, audit, done), facts = plain_edits(pairs)
        assert PATTERN.match("".join(d[0] for d in done))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        out[conv] = (gaps, *facts, illegal, cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


def run(spark, rows, **options):
    table = spark.createDataFrame([(*r, "clash", 1, "x", 0) for r in rows], SCHEMA)
    named = repair.rows_of(table.repartition(3))
    got = repair.digests(named, *repair.repair(named, **options)).collect()
    found = {r.conv_id: (*[r[c] for c in [*repair.COUNTS, "audit"]], r.repaired_sha256) for r in got}
    assert len(found) == len(got)
    return found


def conversation(rng, conv, length):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", " "]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", "A\nlong one. ", "é.", "."]
    return [(conv, rng.choice([None, *range(length + 2)]), rng.choice(roles), rng.choice([*texts, f"own {rng.random()}."]))
            for _ in range(length)]


def test_short_conversations(spark):
    rng = random.Random(11)
    rows = [r for conv in [None, *range(300)] for r in conversation(rng, conv, rng.randrange(1, 9))]
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_a_hot_conversation_in_many_pieces(spark, bits):
    rng = random.Random(bits)
    rows = [r for conv in range(20) for r in conversation(rng, conv, 3)] + conversation(rng, 7, 150)
    rows += [(7, 3, "user", "again.")] * 40 + [(99, k, "user", "same.") for k in range(60)]
    assert run(spark, rows, piece_bits=bits, rows_per_task=20) == plain(rows)


def test_every_pair_of_states_by_the_lattice():
    rng = random.Random(5)
    for _ in range(400):
        steps = tuple((rng.choice("suat"), rng.choice([0, 0, 1, 2])) for _ in range(rng.randrange(0, 7)))
        for start in range(4):
            for end in range(4):
                # All labels of all nodes, one row after the other, with up to three inserts between.
                labels = {start: (0, "")}
                for k in range(len(steps) + 1):
                    for _ in range(3):
                        for state, (cost, audit) in list(labels.items()):
                            into = repair.AFTER[state][repair.FORCED[state][0]]
                            labels[into] = min(labels.get(into, (1 << 30, "")), (cost + 2, audit + "I"))
                    if k < len(steps):
                        onward = {}
                        for state, (cost, audit) in labels.items():
                            for price, at, into, letter in repair._onward(steps, k, state):
                                if at == k + 1:
                                    onward[into] = min(onward.get(into, (1 << 30, "")), (cost + price, audit + letter))
                        labels = onward
                assert repair.cheapest(steps, start, (end,)) == labels.get(end)


def test_damage_and_missing_values(spark):
    rng = random.Random(8)
    rows = []
    for conv in [None, *range(60)]:
        for turn in [None, *range(5)]:
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None]), rng.choice(["Hm. Yes!", None, "a", f"{conv}?"])))
    want = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    table = spark.createDataFrame([(*r, "clash", 1, "x", 0) for r in rows], SCHEMA)
    named = repair.rows_of(table)
    broken = repair.damaged(named)
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in broken.select("conv_id", "turn", "role", "text").collect()), key=key) == sorted(want, key=key)
    got = {r.conv_id: r.audit for r in repair.digests(named, *repair.repair(broken)).collect()}
    expected = {conv: row[6] for conv, row in plain(want).items()}
    assert got == {conv: expected.get(conv, "") for conv in {r[0] for r in rows}}


def test_a_conversation_without_rows_and_an_empty_table(spark):
    table = repair.rows_of(spark.createDataFrame([(1, 0, "user", "a", "", 0, "", 0)], SCHEMA))
    got, = repair.digests(table, *repair.repair(table.limit(0))).collect()
    assert (got.conv_id, got.cost, got.audit, got.repaired_sha256) == (1, 0, "", hashlib.sha256().hexdigest())
    nothing = repair.rows_of(spark.createDataFrame([], SCHEMA))
    assert repair.digests(nothing, *repair.repair(repair.damaged(nothing))).collect() == []


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "x" * 1_000_000), (1, 2, "user", "word " * 200_000 + ".")]
    assert run(spark, rows) == plain(rows)
