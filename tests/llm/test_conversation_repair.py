"""Conversation repair against a search that carries whole audits."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulebeam.llm.conversation_repair import cost_matrix, damage, op13_conversation_repair, repair

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}
KEEP = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 1:
            text = ""
        elif case == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        elif case == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(case, 1)
    return out


def with_inserts(base):
    out = {}
    for state in base:
        options, at, lines = [base[state]], state, []
        for n in (1, 2, 3):
            at = FOLLOWS[at]
            lines = lines + [NAMES[at] + ":"]
            cost, audit, rest = base[at]
            options.append((cost + 5 * n, "I" * n + audit, lines + rest))
        out[state] = min(options)
    return out


def brute_repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else
                      "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    far = (10 ** 9, "", [])
    best = with_inserts({"": (0, "", []), "s": far, "u": far, "a": (0, "", [])})
    for (_, role, text), fault in reversed(list(zip(rows, faults))):
        base = {}
        for state in best:
            options = [(best[state][0] + 2, "D" + best[state][1], best[state][2])]
            if fault not in ("blank", "duplicate"):
                more, initial, due = 5 * (fault == "truncated"), role[:1], FOLLOWS[state]
                if (state, initial) in KEEP:
                    cost, audit, rest = best[initial]
                    options.append((cost + more, "K" + audit, [f"{role}:{text}"] + rest))
                cost, audit, rest = best[due]
                options.append((cost + 1 + more, "R" + audit, [f"{NAMES[due]}:{text}"] + rest))
            base[state] = min(options)
        best = with_inserts(base)
    cost, audit, lines = best[""]
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def report(df, bits=10):
    out, _ = repair(damage(df), bits)
    return {r.conv: tuple(r)[1:] for r in out.collect()}


def want(rows):
    return {" " if c is None else str(c): brute_repair(v) for c, v in brute_damage(rows).items() if v}


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"]
TEXTS = ["Hi.", "ok", "Yes!", "", "  ", "no?", "a b", "é.", None, "x.\n\t", "long " * 5000 + "."]


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_random_conversations(spark, bits):
    rng = random.Random(bits)
    rows = [(rng.choice([None, *range(150)]), rng.choice([None, *range(12)]), rng.choice(ROLES),
             rng.choice(TEXTS) if rng.random() < .5 else f"{rng.randrange(60)}{rng.choice(['.', '', '!'])}") for _ in range(1200)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit(3), "conv": F.lit("c"), "edits": F.lit(None)})
    assert report(df, bits) == want(rows)


def test_one_hot_conversation_over_many_blocks(spark):
    rng = random.Random(9)
    rows = [(1, i, rng.choice(ROLES), f"t{rng.randrange(1500)}{rng.choice(['.', '!', '.', ''])}") for i in range(2500)]
    rows += [(i, 0, "user", "A.") for i in range(2, 40)]
    assert report(spark.createDataFrame(rows, SCHEMA).repartition(5), 4) == want(rows)


def test_cost_matrix_is_a_product():
    rng = random.Random(2)
    for _ in range(50):
        a, b = ("".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(1, 6))) for _ in range(2))
        left, right = cost_matrix(a, False), cost_matrix(b, True)
        product = (left[:, :, None] + right[None]).min(axis=1)
        whole = cost_matrix(a + b, True)
        assert np.array_equal(np.minimum(product, 1000), np.minimum(whole, 1000))


def test_empty_and_fully_damaged(spark):
    assert report(spark.createDataFrame([], SCHEMA)) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert report(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)) == {}


def test_repaired_rows(spark):
    keep = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 > 4 for t in range(3)))
    rows = [(keep, 0, "system", "S."), (keep, 1, "assistant", "A."), (keep, 2, "assistant", "B.")]
    out, lines = repair(damage(spark.createDataFrame(rows, SCHEMA)))
    assert out.first().audit == "KRK"
    assert [(r.role, r.text) for r in lines.orderBy("pos", "step").collect()] == [("system", "S."), ("user", "A."), ("assistant", "B.")]


def test_query_equals_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text"))
            for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    found = {r.conv_id: tuple(r)[1:] for r in op13_conversation_repair(spark, sf).collect()}
    assert found == {c: brute_repair(v) for c, v in brute_damage(rows).items()}
    # Every original conversation has a row, also one that lost all of its rows.
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi."), (None, None, None, None)], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    small = {r.conv_id: tuple(r)[1:] for r in op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert small[gone] == (0, 0, 0, 0, 0, 0, "", EMPTY) and set(small) == {gone, None}
