"""Conversation repair against a plain forward search over whole conversations."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from joblens.llm import conversation as conv

SCHEMA = "conv_id long, turn long, role string, text string"
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for c, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if d == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if d == 2 else text
        out += [(c, turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def cheapest(rows, flaws):
    """Least (cost, letters, lines) over all edits, by the last initial written."""
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(2):
            for at, (c, a, t) in list(best.items()):
                new = (c + 3, a + "I", t + (f"{NAME[AFTER[at]]}:",))
                best[AFTER[at]] = min(best.get(AFTER[at], new), new)

    insert(best)
    for (_, _, role, text), flaw in zip(rows, flaws):
        extra, behind = 3 * (flaw == "truncated"), {}

        def offer(at, way):
            behind[at] = min(behind.get(at, way), way)

        for at, (c, a, t) in best.items():
            offer(at, (c + 4, a + "D", t))
            if flaw not in ("blank", "duplicate"):
                to = AFTER[at]
                offer(to, (c + 3 + extra, a + "R", t + (f"{NAME[to]}:{text}",)))
                if role[:1] == to or role[:1] == "s" and at == "":
                    offer(role[:1], (c + extra, a + "K", t + (f"{role}:{text}",)))
        best = behind
        insert(best)
    return min(best[at] for at in ("", "a") if at in best)


def plain(rows):
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    for c, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, flaws = set(), []
        for _, _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            flaws.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, lines = cheapest(own, flaws)
        yield (
            c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(flaws.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )


def run(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.lit("clash")).withColumn("open", F.lit(1)).repartition(3)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r) for r in conv.op11_conversation_repair(spark, str(tmp_path)).collect()), key=str)


def some_rows(n, seed, hot=0):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "super"]
    texts = ["Yes.", "No!", "why?", "cut", " \n", "", None, "end. \t", "é.", "long " * 3000]
    one = lambda c, t: (c, t, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"text {rnd.random()}.")
    rows = [one(c, rnd.choice([t, t, t, None, t + 3])) for c in [None, *range(n)] for t in range(rnd.randint(1, 9))]
    return rows + [one(-1, t // 2) for t in range(hot)]


@pytest.mark.parametrize("chunk", [3, 4096])
def test_equals_plain_search(spark, tmp_path, monkeypatch, chunk):
    """Small chunks send most conversations through the fix-up passes."""
    monkeypatch.setattr(conv, "CHUNK_ROWS", chunk)
    rows = some_rows(60, 1, hot=150) + [(77, t, "user", "Same.") for t in range(40)] + [(78, None, "user", f"{t}.") for t in range(8)]
    assert run(spark, tmp_path, rows) == sorted(plain(rows), key=str)


def test_chunk_size_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conv, "CHUNK_BYTES", 2000)
    rows = [(1, t, "user" if t % 2 else "assistant", f"{t} " * 400 + ".") for t in range(30)]
    assert run(spark, tmp_path, rows) == list(plain(rows))


def test_alternating_users_need_many_passes(spark, tmp_path, monkeypatch):
    """A run of rows without faults hands a change at its end far to the front."""
    monkeypatch.setattr(conv, "CHUNK_ROWS", 2)
    rows = [(5, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(31)]
    assert run(spark, tmp_path, rows) == list(plain(rows))


def test_rows_all_dropped_and_no_rows(spark, tmp_path):
    c = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(c, 0, "user", "gone.")]
    got = run(spark, tmp_path / "a", rows)
    assert got == list(plain(rows)) == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert run(spark, tmp_path / "b", []) == []


def test_fix_up_equals_a_full_run():
    rnd = random.Random(4)
    ends = {conv.END} | {conv.backward(bytes(rnd.randrange(16) for _ in range(5)), conv.END)[:4] for _ in range(50)}
    for _ in range(500):
        codes = bytes(rnd.randrange(16) for _ in range(rnd.randint(1, 30)))
        a, b = rnd.choice(sorted(ends)), rnd.choice(sorted(ends))
        assert conv.fix_up(codes, conv.backward(codes, a), b) == conv.backward(codes, b)


def test_repaired_rows_are_legal(spark):
    import re

    rows = spark.createDataFrame(some_rows(40, 2), SCHEMA)
    for r in conv.repair(conv.damage(rows)).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "repaired"))).alias("parts")).collect():
        lines = [x for p in r.parts for x in re.findall(r"^(s\w*|user|u|assistant):", p.repaired, re.M)]
        assert re.fullmatch(r"(s?(ua)+)?", "".join(x[0] for x in lines))
