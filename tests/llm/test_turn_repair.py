"""Turn repair against all edits of short conversations, and conversations longer than a block."""

import functools
import hashlib
import itertools
import random
import re

import pytest

from starloom.llm import queries, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, _conv string, choices int"
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute(rows):
    """Counts, audit and repaired turns of one conversation, rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.sub(r"[ \t-\r]+", "", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))

    @functools.cache
    def best(i, said):
        ways = []
        for role in "ua":
            if (said, role) in AFTER and i <= len(rows) and not (said == "" and role == "a"):
                ways.append(("I", 3, i, AFTER[said, role]))
        if i < len(rows):
            extra = 3 if faults[i] == "truncated" else 0
            ways.append(("D", 4, i + 1, said))
            if faults[i] not in ("blank", "duplicate"):
                if (said, rows[i][1][:1]) in AFTER:
                    ways.append(("K", extra, i + 1, AFTER[said, rows[i][1][:1]]))
                ways += [("R", 3 + extra, i + 1, AFTER[said, role]) for role in "ua" if (said, role) in AFTER]
        return ways

    @functools.cache
    def cheapest(i, said, inserts):
        """Cost and audit; more than two inserts in a row never help."""
        found = [(0, "")] if i == len(rows) and said in ("", "a") else []
        for letter, cost, after, now in best(i, said):
            if letter == "I" and inserts == 3:
                continue
            rest = cheapest(after, now, inserts + 1 if letter == "I" else 0)
            if rest:
                found.append((cost + rest[0], letter + rest[1]))
        return min(found, default=None)

    cost, audit = cheapest(0, "", 0)
    kept, i, said = [], 0, ""
    for letter in audit:
        if letter in "IR":
            said = "a" if said == "u" else "u"
            kept.append(({"u": "user", "a": "assistant"}[said], "" if letter == "I" else rows[i][2]))
        elif letter == "K":
            said = rows[i][1][:1]
            kept.append(rows[i][1:])
        i += letter != "I"
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
    )


def made(seed, conv, n):
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "sure", "u"]
    texts = ["Fine.", "cut off", "", " \t\n", "Fine!\n", "Why?", "x", ". . a", " ", "\x1c."]
    turn, rows = 0, []
    for _ in range(n):
        turn += pick.choice([1, 1, 1, 1, 3])
        rows.append((conv, turn, pick.choice(roles), pick.choice(texts) + (f" {turn}." if pick.random() < 0.6 else "")))
        if pick.random() < 0.15:
            rows.append(rows[-1])
    return rows


def test_every_way_of_short_conversations(spark):
    rows = [r for seed in range(150) for r in made(seed, seed, seed % 9 + 1)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.summarize(turn_repair.repair(frame)).collect()}
    want = {k: brute([r[1:] for r in g]) for k, g in itertools.groupby(rows, key=lambda r: r[0])}
    assert {k: got.get(k) for k in want} == want and len(got) == len(want)
    assert len({c for v in want.values() for c in v[6]}) == 4


def test_blocks_of_back_pointers(spark):
    rows = [r for seed in range(40) for r in made(seed, seed, 30)]
    rows += [(99, 1, "user", "Same.")] * 25
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    order = ["conv_id", "n"]
    whole = turn_repair.repair(frame).orderBy(order).collect()
    assert turn_repair.repair(frame, block_rows=4).orderBy(order).collect() == whole


def test_odd_rows(spark):
    rows = [
        (None, None, "user", "No number. "), (None, None, "assistant", "Yes."), (1, None, None, None), (1, 5, "user", "A."), (1, 5, "user", "A."),
        (2, 3, "user", "Same."), (2, 3, "user", "Same."), (2, 9, "assistant", "x" * 200_000 + "."), (3, 1, "user", None),
    ]
    frame = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    got = {r.conv_id: r for r in turn_repair.summarize(turn_repair.repair(frame), ordered=True).collect()}
    assert (got[None].audit, got[None].cost, got[None].gaps) == ("IKKI", 6, 0)  # of one turn: the assistant's row first
    assert (got[1].gaps, got[1].blank, got[1].duplicate, got[1].audit, got[1].cost) == (0, 1, 1, "DKDI", 11)
    assert (got[2].gaps, got[2].duplicate, got[2].audit, got[2].cost) == (5, 1, "KDK", 4)
    assert (got[3].audit, got[3].repaired_sha256) == ("D", hashlib.sha256(b"").hexdigest())
    edits = turn_repair.repair(frame)
    assert edits.where("conv_id = 2 AND edit = 'K'").count() == 2
    assert sorted(turn_repair.summarize(edits).collect(), key=str) == sorted(got.values(), key=str)
    assert turn_repair.repair(frame.where("conv_id = -1")).count() == 0


def test_query_has_conversations_that_lost_all_rows(spark, tmp_path):
    import zlib

    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Lost."), (-5, None, "user", "Kept here.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_turn_repair(spark, str(tmp_path)).collect()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and len(got) == 2


@pytest.mark.parametrize("said", range(4))
def test_cost_vectors_are_few(said):
    costs, vectors, todo = turn_repair.Costs(), set(), [turn_repair._FINISH]
    while todo:
        vector = todo.pop()
        for fault in range(4):
            for one in {said, *range(4)}:
                after, _, _ = costs.step(vector, one, fault)
                if after not in vectors:
                    vectors.add(after)
                    todo.append(after)
    assert len(vectors) < 200
