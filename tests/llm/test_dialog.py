from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import zlib

import pytest

from capturelake.llm import dialog

KIND = "conv_id long, turn long, role string, text string"
SPACE = re.compile(r"[\x20\x09-\x0D]")


def faults_of(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = SPACE.sub("", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired rows) by trying every edit of each row and up to two inserts at each place."""
    best = None
    faults = faults_of(rows)
    choices = []
    for (role, text), fault in zip(rows, faults, strict=True):
        own = [(3, "D", None)]
        if fault not in ("blank", "duplicate"):
            cut = fault == "truncated"
            own += [(cut, "K", (role, text)), (2 + cut, "R", ("user", text)), (2 + cut, "R", ("assistant", text))]
        choices.append(own)
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    for picked in itertools.product(*choices):
        for runs in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(c for c, _, _ in picked) + 2 * sum(map(len, runs))
            if best is not None and cost > best[0]:
                continue
            out, audit = [], ""
            for i in range(len(rows) + 1):
                audit += "I" * len(runs[i])
                out += [(r, "") for r in runs[i]]
                if i < len(rows):
                    audit += picked[i][1]
                    out += [picked[i][2]] if picked[i][2] else []
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
                found = (cost, audit, out)
                best = found if best is None else min(best, found)
    return best


def solve(rows):
    p = dialog.Piece()
    for i, (role, text) in enumerate(rows):
        p.add(i, role, text)
    return dialog.solved(p)


def digest(rows):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()


def test_cheapest_edits_match_brute_force():
    rng = random.Random(3)
    for _ in range(250):
        rows = [(rng.choice(["user", "assistant", "system", "tool", " "]), rng.choice(["a.", "b!", "c", "d?", " ", "", "e"])) for _ in range(rng.randint(0, 3))]
        cost, audit, out = brute(rows)
        got = solve(rows)
        assert (got["cost"], got["audit"], got["repaired_sha256"]) == (cost, audit, digest(out)), rows


def table(rng, convs, longest):
    rows = []
    for c in range(convs):
        for t in range(rng.randint(0, longest)):
            rows.append((c if c else None, rng.choice([t, t, t, t - 1, None]), rng.choice(["user", "assistant", "system", None]), rng.choice([f"text {rng.randint(0, 9)}.", "cut off", "", None, "é 🙂 fine!"])))
    rows += [(999, t, "user" if t % 2 else "assistant", f"turn {t % 50}" + "." * (t % 3)) for t in range(400)]  # a third of all rows
    return rows


def shown(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_results_do_not_depend_on_where_partitions_end(spark, partitions):
    """With 40 partitions most conversations and the longest lie in several."""
    rows = table(random.Random(5), 60, 14)
    df = spark.createDataFrame(rows, KIND)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["conv_id"]: r.asDict() for r in dialog.repair(dialog.damaged(df)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == {r[0] for r in rows}
    by = {}
    for conv, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        own = by.setdefault(conv, [])
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        own += [(turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        want = solve([r[1:] for r in own])
        turns = {r[0] for r in own} - {None}
        want["gaps"] = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        assert {k: got[conv][k] for k in want} == want, conv


def test_empty_table_long_text_and_clashing_columns(spark):
    assert dialog.repair(dialog.damaged(spark.createDataFrame([], KIND))).count() == 0
    long = "word " * 200_000 + "end."
    df = spark.createDataFrame([(5, 1, "user", long, "x", True), (5, 2, "assistant", "ok.", "y", False)], KIND + ", part string, whole boolean")
    rows = dialog.repair(df.selectExpr("conv_id", "turn", "role", "text", "false as gone")).collect()
    assert [(r["audit"], r["cost"], r["repaired_sha256"]) for r in rows] == [("KK", 0, digest([("user", long), ("assistant", "ok.")]))]


def test_a_conversation_without_rows_left(spark):
    dropped = next((c, t) for c in range(1000) for t in range(20) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = dialog.repair(dialog.damaged(spark.createDataFrame([(*dropped, "user", "x.")], KIND))).collect()
    assert [tuple(r[c] for c in ("conv_id", *dialog.COUNTS, "audit", "repaired_sha256")) for r in got] == [(dropped[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_gives_the_rows_of_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = c.execute(dialog.OP12_SQL)
    names = [d[0] for d in want.description]
    got = dialog.op12_structure_repair(spark, SF).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
