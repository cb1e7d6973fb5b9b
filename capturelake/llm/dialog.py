"""Repair of the structure of conversations: the cheapest edits after which roles read ``(s?(ua)+)?``.

A conversation is a row for each turn. Each row is kept (K), given the role user or assistant (R, cost 2) or
deleted (D, cost 3, and the only choice for a blank or repeated row); empty user and assistant rows may be inserted
anywhere (I, cost 2); a truncated row that stays costs 1. Of equally cheap edits the least audit string (the
initials in order) wins.

The method is a rank-compressed DP. A layer is a row; its states are what the repaired text ends in (nothing, s, u
or a). An edge is a macro edit, a run of inserts and then the row's own edit. The codes of macro edits (``CODES``)
are prefix-free, so of two audit strings of as many rows the one with the first smaller code is smaller, and the
best string of a state is the pair (rank of its parent's string in the layer before, code). A layer therefore keeps
four costs and four ranks, and each row four parent pointers of one byte; strings are written once, backwards.

Rows are dealt by range and sorted, so a conversation lies in one partition or in several that follow each other.
One that may go on in another partition is solved in pieces: each piece gives costs and ranks from each state to
each state, the pieces of a conversation are chained (a few numbers each), and each piece then reconstructs its own
part. So a conversation with a third of all rows is shared by as many tasks as its rows fill. Only the digest of the
repaired text, which is one stream by its definition, is read piece by piece by one task.

Null roles and texts count as one space. Rows of one turn are ordered by role and text;
rows with a null turn come first. Rows with a null conv_id are one conversation. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.scratch import Scratch

SPACES = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: the states that may follow a state
FOLLOW = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: inserts before a row, from each state: longer runs come back to a state for nothing
RUNS = {START: ((0, START), (1, USER), (2, ASSISTANT)), SYSTEM: ((0, SYSTEM), (1, USER), (2, ASSISTANT)), USER: ((0, USER), (1, ASSISTANT)), ASSISTANT: ((0, ASSISTANT), (1, USER))}
#: prefix-free, in their order as strings
CODES = sorted("I" * k + e for k in range(3) for e in "DKR")
#: inserts after the last row, by the state before them
ENDS = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _edges(initial: str, kept: bool, truncated: bool) -> list[tuple[int, int, int, int]]:
    """(from state, to state, cost, code) of all macro edits of a row; for each pair of states and cost the least code."""
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for before in STATES:
        for k, at in RUNS[before]:
            ends = [("D", at, 3)]
            if kept:
                ends += [("K", INITIAL[initial], int(truncated))] if INITIAL.get(initial) in FOLLOW[at] else []
                ends += [("R", to, 2 + truncated) for to in FOLLOW[at] if to != SYSTEM]
            for edit, to, cost in ends:
                new = (2 * k + cost, CODES.index("I" * k + edit))
                found[before, to] = min(found.get((before, to), new), new)
    return [(before, to, cost, code) for (before, to), (cost, code) in sorted(found.items())]


EDGES = {(i, kept, cut): _edges(i, kept, cut) for i in ("s", "u", "a", "") for kept in (False, True) for cut in (False, True)}


class Layers:
    """Costs and ranks of the states after the rows so far, from each of some first states, with parent pointers.

    A key is (first state, state). ranks are dense and common to all keys, so equal ranks are equal strings.
    """

    def __init__(self, firsts: tuple[int, ...]):
        self.best = {(f, f): (0, 0) for f in firsts}
        self.parents: dict[int, bytearray] = {f: bytearray() for f in firsts}

    def add(self, initial: str, kept: bool, truncated: bool) -> None:
        new: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        edges = EDGES[initial if initial in INITIAL else "", kept, truncated]
        for first in self.parents:
            for before, to, more, code in edges:
                if old := self.best.get((first, before)):
                    x = (old[0] + more, old[1], code, before)
                    if x < new.get((first, to), (1 << 62,)):
                        new[first, to] = x
        order = {x: i for i, x in enumerate(sorted({(r, c) for _, r, c, _ in new.values()}))}
        self.best = {k: (cost, order[rank, code]) for k, (cost, rank, code, _) in new.items()}
        for first, pointers in self.parents.items():
            for to in STATES:
                x = new.get((first, to))
                pointers.append(255 if x is None else x[3] * len(CODES) + x[2])

    def codes(self, first: int, last: int) -> list[int]:
        """The macro edits of the best way from the first state to the last one."""
        pointers, out, state = self.parents[first], [], last
        for at in range(len(pointers) // 4 - 1, -1, -1):
            state, code = divmod(pointers[4 * at + state], len(CODES))
            out.append(code)
        return out[::-1]


def end(best: dict[int, tuple[int, int]]) -> tuple[int, int, int]:
    """(cost, last state, inserts after it) of the cheapest accepted end."""
    cost, _, k, state = min((cost + 2 * ENDS[s], rank, ENDS[s], s) for s, (cost, rank) in best.items())
    return cost, state, k


class Piece:
    """The rows of a conversation, or of a part of it, in order."""

    def __init__(self, seen: set | None = None):
        self.rows: list[tuple[str, str]] = []
        self.faults: list[str] = []
        self.seen: set = set() if seen is None else seen
        self.turns, self.first_turn, self.last_turn = 0, None, None

    def add(self, turn, role: str, text: str) -> None:
        bare = text.rstrip(SPACES)
        own = hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).hexdigest()  # noqa: S324
        fault = "blank" if not bare else "duplicate" if own in self.seen else "truncated" if bare[-1] not in ".!?" else ""
        self.seen.add(own)
        self.rows.append((role, text))
        self.faults.append(fault)
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1

    def layers(self, firsts: tuple[int, ...]) -> Layers:
        out = Layers(firsts)
        for (role, _), fault in zip(self.rows, self.faults, strict=True):
            out.add(role[:1], fault not in ("blank", "duplicate"), fault == "truncated")
        return out

    def illegal(self) -> int:
        initials = [role[:1] for role, _ in self.rows]
        return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))

    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0

    def written(self, codes: list[int], state: int, after: int) -> tuple[str, list[str]]:
        """The audit string and the repaired rows of macro edits that begin in a state."""
        audit, out = [], []

        def put(role: str, text: str) -> None:
            nonlocal state
            state = INITIAL[role[0]]
            out.append(f"{role}:{text}")

        def insert(n: int) -> None:
            for _ in range(n):
                put("assistant" if state == USER else "user", "")

        for (role, text), code in zip(self.rows, codes, strict=True):
            edits = CODES[code]
            audit.append(edits)
            insert(len(edits) - 1)
            if edits[-1] == "K":
                put(role, text)
            elif edits[-1] == "R":
                put("assistant" if state == USER else "user", text)
        insert(after)
        return "".join(audit) + "I" * after, out


def solved(piece: Piece) -> dict:
    """All columns of the result for a whole conversation."""
    layers = piece.layers((START,))
    cost, state, after = end({s: x for (_, s), x in layers.best.items()})
    audit, rows = piece.written(layers.codes(START, state), START, after)
    digest = hashlib.sha256("\n".join(rows).encode("utf-8", "surrogatepass")).hexdigest()
    counts = {f: piece.faults.count(f) for f in ("blank", "duplicate", "truncated")}
    return counts | {"gaps": piece.gaps(), "illegal": piece.illegal(), "cost": cost, "audit": audit, "repaired_sha256": digest}


# the first pass: sorted rows of a partition


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")), strict=True)


_NONE = object()
LEFT = "part long, at long, turn long, role string, text string, gone boolean"


def _portion(names: list[str], conv_type, size: int):
    """Solves the conversations that lie within a partition; the rows of its first and its last one are handed on."""
    kinds = {"conv_id": conv_type, "whole": pa.bool_()} | {c: pa.int64() for c in (*COUNTS, "part", "at", "turn")} | {c: pa.string() for c in ("audit", "repaired_sha256", "role", "text")} | {"gone": pa.bool_()}

    def run(batches):
        part = TaskContext.get().partitionId()
        out: list[dict] = []

        def table():
            nonlocal out
            made, out = out, []
            return pa.RecordBatch.from_pydict({c: pa.array([r.get(c) for r in made], kinds[c]) for c in names}, pa.schema([(c, kinds[c]) for c in names]))

        def left(conv, at, turn, role, text, gone):
            out.append({"conv_id": conv, "whole": False, "part": part, "at": at, "turn": turn, "role": role, "text": text, "gone": gone})

        now, first, at, piece, held = _NONE, True, 0, Piece(), []
        for conv, turn, role, text, gone in _rows(batches):
            if now is _NONE or conv != now:
                if now is not _NONE and not first:
                    out.append({"conv_id": now, "whole": True} | solved(piece))
                if now is not _NONE:
                    first = False
                now, at, piece, held = conv, 0, Piece(), []
            if first:
                left(conv, at, turn, role, text, gone)
            else:
                held.append((turn, role, text, gone))
                if not gone:
                    piece.add(turn, role, text)
            at += 1
            if len(out) >= size:
                yield table()
        if not first:
            for i, row in enumerate(held):
                left(now, i, *row)
        yield table()

    return run


# conversations at the edges of partitions


def _piece(rows: pa.Table, before: set) -> Piece:
    rows = rows.sort_by("at")
    out = Piece(set(before))
    for turn, role, text, gone in zip(*(rows.column(c).to_pylist() for c in ("turn", "role", "text", "gone")), strict=True):
        if not gone:
            out.add(turn, role, text)
    return out


TABLE = "conv string, part long, keys array<long>, costs array<long>, ranks array<long>, n long, first string, last string, turns long, first_turn long, last_turn long"
CHOICE = "conv string, part long, before long, state long, after long, gaps long, illegal long, cost long"
DONE = "conv string, part long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string"


def _batch(ddl: str, rows: list[dict]) -> pa.Table:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split(" ") for x in ddl.split(", ")]
    return pa.Table.from_pydict({c: pa.array([r[c] for r in rows], kinds[k]) for c, k in fields}, pa.schema([(c, kinds[k]) for c, k in fields]))


def _summary(key, rows, earlier):
    p = _piece(rows, set(earlier.column("own").to_pylist()))
    best = p.layers(tuple(STATES)).best
    keys = sorted(best)
    return _batch(TABLE, [{
        "conv": key[0].as_py(), "part": key[1].as_py(), "keys": [4 * f + s for f, s in keys], "costs": [best[k][0] for k in keys], "ranks": [best[k][1] for k in keys],
        "n": len(p.rows), "first": p.rows[0][0][:1] if p.rows else None, "last": p.rows[-1][0][:1] if p.rows else None, "turns": p.turns, "first_turn": p.first_turn, "last_turn": p.last_turn,
    }])


def _chain(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Goes through the pieces of a conversation as Layers goes through rows, with the rank of a piece's string as its code."""
    parts = sorted(rows.to_pylist(), key=lambda r: r["part"])
    best, parents = {START: (0, 0)}, []
    turns, first_turn, last_turn, illegal, last = 0, None, None, 0, None
    for r in parts:
        new: dict[int, tuple] = {}
        for k, cost, rank in zip(r["keys"], r["costs"], r["ranks"], strict=True):
            before, to = divmod(k, 4)
            if before in best:
                x = (best[before][0] + cost, best[before][1], rank, before)
                new[to] = min(new.get(to, x), x)
        order = {x: i for i, x in enumerate(sorted({(a, b) for _, a, b, _ in new.values()}))}
        best = {s: (x[0], order[x[1], x[2]]) for s, x in new.items()}
        parents.append({s: x[3] for s, x in new.items()})
        if r["n"]:
            illegal += last is not None and last + r["first"] not in ("su", "ua", "au")
            last = r["last"]
        if r["turns"]:
            turns += r["turns"] - (last_turn == r["first_turn"])
            first_turn = r["first_turn"] if first_turn is None else first_turn
            last_turn = r["last_turn"]
    cost, state, after = end(best)
    out = []
    for i in range(len(parts) - 1, -1, -1):
        tail = i == len(parts) - 1
        gaps = last_turn - first_turn + 1 - turns if tail and turns else 0
        out.append({"conv": key[0].as_py(), "part": parts[i]["part"], "before": parents[i][state], "state": state, "after": after if tail else 0, "gaps": gaps, "illegal": int(illegal) if tail else 0, "cost": cost if tail else 0})
        state = parents[i][state]
    return _batch(CHOICE, out)


def _build(key, rows, told):
    """A piece's own part of the result. told: its choice, and the digests of earlier rows that it repeats."""
    told = told.to_pylist()
    p = _piece(rows, {r["own"] for r in told if r["own"] is not None})
    c = next(r for r in told if r["before"] is not None)
    audit, lines = p.written(p.layers((c["before"],)).codes(c["before"], c["state"]), c["before"], c["after"])
    counts = {f: p.faults.count(f) for f in ("blank", "duplicate", "truncated")}
    return _batch(DONE, [counts | {"conv": key[0].as_py(), "part": key[1].as_py(), "gaps": c["gaps"], "illegal": c["illegal"] + p.illegal(), "cost": c["cost"], "audit": audit, "repaired": "\n".join(lines) if lines else None}])


def _joined(batches):
    """Streams the sorted pieces of conversations: sums, the joined audit strings and the digest of the whole text."""
    now, sums, audit, sha, any_text = None, None, [], None, False

    def row():
        return pa.RecordBatch.from_pydict({"conv": [now]} | {c: pa.array([sums[c]], pa.int64()) for c in COUNTS} | {"audit": ["".join(audit)], "repaired_sha256": [sha.hexdigest()]})

    for b in batches:
        for r in b.to_pylist():
            if r["conv"] != now:
                if now is not None:
                    yield row()
                now, sums, audit, sha, any_text = r["conv"], dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), False
            for c in COUNTS:
                sums[c] += r[c]
            audit.append(r["audit"])
            if r["repaired"] is not None:
                sha.update((b"\n" if any_text else b"") + r["repaired"].encode("utf-8", "surrogatepass"))
                any_text = True
    if now is not None:
        yield row()


def _edges_repaired(left: DataFrame) -> DataFrame:
    """(conv, counts, audit, repaired_sha256) of the conversations whose rows the first pass handed on."""
    own = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    seen = left.where("not gone").select("conv", "part", own.alias("own")).distinct()
    first = seen.groupBy("conv", "own").agg(F.min("part").alias("first"))
    # a row a piece and text: no key of this join has more rows than there are partitions
    later = seen.join(first, ["conv", "own"]).where("part > first").select(F.col("conv").alias("conv_"), F.col("part").alias("part_"), "own")
    keys = ("conv", "part")
    tables = left.groupBy(*keys).cogroup(later.groupBy("conv_", "part_")).applyInArrow(_summary, TABLE)
    choice = tables.groupBy("conv").applyInArrow(_chain, CHOICE)
    told = choice.withColumn("own", F.lit(None).cast("string")).unionByName(later.withColumnsRenamed({"conv_": "conv", "part_": "part"}), allowMissingColumns=True)
    done = left.groupBy(*keys).cogroup(told.groupBy(*keys)).applyInArrow(_build, DONE)
    out = "conv string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return done.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(_joined, out)


def repair(rows: DataFrame, batch: int = 500) -> DataFrame:
    """conv_id, the COUNTS, audit and repaired_sha256 for each conversation of (conv_id, turn, role, text, gone).

    A row that is gone only tells that its conversation exists. Rows are shuffled once; what a partition solves is
    written with the rows it hands on, so that nothing runs twice.
    """
    spark = rows.sparkSession
    work = Scratch(spark, "dialog")
    conv = rows.schema["conv_id"].dataType
    dealt = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "gone", F.substr("text", F.lit(1), F.lit(64)).alias("tie"))
    order = ["conv_id", "turn", "role", "tie"]
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order, "text").drop("tie")
    ddl = f"conv_id {conv.simpleString()}, whole boolean, " + ", ".join(f"{c} long" for c in COUNTS) + f", audit string, repaired_sha256 string, {LEFT}"
    names = ["conv_id", "whole", *COUNTS, "audit", "repaired_sha256", "part", "at", "turn", "role", "text", "gone"]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[conv.simpleString()]
    saved = work.save(dealt.mapInArrow(_portion(names, arrow, batch), ddl), "portions")
    result = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    # a null id is a conversation too
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    edges = _edges_repaired(saved.where("not whole").select(key.alias("conv"), *[x.split(" ")[0] for x in LEFT.split(", ")]))
    edges = edges.withColumn("conv_id", F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(conv))
    return saved.where("whole").select(*result).unionByName(edges.select(*result))


# the query


def space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by the digest of their place."""
    place = (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).cast("int")
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), place.alias("d"))
    text = F.when(F.col("d") <= 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("d") == 4, "user").when(F.col("d") == 0, "").otherwise(F.col("role"))
    times = F.when(F.col("d") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("d") == 0).alias("gone"), F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _sql_step() -> str:
    """The four states after a row, as lists of {c, a, r}; whole strings are carried, without ranks."""
    out = []
    for to in STATES:
        options = []
        for before in STATES:
            for k, at in RUNS[before]:
                names = []
                state = at
                where = before
                for _ in range(k):
                    names.append("assistant" if where == USER else "user")
                    where = INITIAL[names[-1][0]]
                inserted = "".join(f"|| '\n{n}:' " for n in names)
                s, cost = f"s{before}", 2 * k
                if state == to:
                    options.append(f"case when {s} is not null then {{'c': {s}.c + {cost + 3}, 'a': {s}.a || '{'I' * k}D', 'r': {s}.r {inserted}}} end")
                if to in FOLLOW[state]:
                    options.append(f"case when {s} is not null and fault not in ('blank', 'duplicate') and role[1] = '{' sua'[to]}' then {{'c': {s}.c + {cost} + cut, 'a': {s}.a || '{'I' * k}K', 'r': {s}.r {inserted}|| '\n' || role || ':' || text}} end")
                    if to != SYSTEM:
                        options.append(f"case when {s} is not null and fault not in ('blank', 'duplicate') then {{'c': {s}.c + {cost + 2} + cut, 'a': {s}.a || '{'I' * k}R', 'r': {s}.r {inserted}|| '\n{NAMES['u' if to == USER else 'a']}:' || text}} end")
        out.append(f"list_min([{', '.join(options)}]) as s{to}")
    return ",\n         ".join(out)


OP12_SQL = rf"""
with recursive crc as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab
), k as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as place from conversations
), p as (
  select k.*, xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(place, ''), lambda ch: ascii(ch)::bigint)),
         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 as d from k, crc
), w as (
  select conv_id, turn, case when d = 4 then 'user' else role end as role,
         case when d = 1 then '' when d = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from p, unnest(case when d = 3 then [1, 2] else [1] end) where d <> 0
), o as (
  select *, row_number() over (partition by conv_id, role, text order by i) as again
  from (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from w)
), f as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when again > 1 then 'duplicate'
                 when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else '' end as fault,
         lag(role) over (partition by conv_id order by i) as behind from o
), g as (select *, (fault = 'truncated')::bigint as cut from f), dp as (
  select conv_id, 0::bigint as i, {{'c': 0::bigint, 'a': '', 'r': ''}} as s0, null::struct(c bigint, a varchar, r varchar) as s1,
         null::struct(c bigint, a varchar, r varchar) as s2, null::struct(c bigint, a varchar, r varchar) as s3
  from (select distinct conv_id from conversations)
  union all
  select dp.conv_id, g.i,
         {_sql_step()}
  from dp join g on g.conv_id is not distinct from dp.conv_id and g.i = dp.i + 1
), z as (
  select conv_id, max_by(list_min([s0, case when s1 is not null then {{'c': s1.c + 4, 'a': s1.a || 'II', 'r': s1.r || '
user:
assistant:'}} end, case when s2 is not null then {{'c': s2.c + 2, 'a': s2.a || 'I', 'r': s2.r || '
assistant:'}} end, s3]), i) as b from dp group by conv_id
), n as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
         count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (behind is not null and (behind[1] || role[1]) not in ('su', 'ua', 'au')) as illegal from g group by conv_id
)
select z.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, b.c as cost, b.a as audit, sha256(substr(b.r, 2)) as repaired_sha256
from z left join n on n.conv_id is not distinct from z.conv_id
"""
