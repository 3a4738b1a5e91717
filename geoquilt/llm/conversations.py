"""Damaged conversations: faults of each row, and the cheapest repair, by Viterbi that runs in parallel over chunks.

The states of a repair are what stands last: nothing, a system turn, a user turn, an assistant turn.
Conversations are cut into chunks of rows. Each chunk computes backwards what it costs to finish from
each state, from speculative costs at its end; passes then compare what a chunk took for its end with
what the next one begins with, and only chunks where the two vectors differ by more than a constant
run again, until none does. With the costs stitched so, each chunk traces the least audit from every
state that it may be entered in, and the states are stitched forwards by the same kind of passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

START, SYSTEM, USER, ASSISTANT = range(4)
#: What the next turn that is put in must be, and where that leads: a user after all but a user.
_AFTER = (USER, USER, ASSISTANT, USER)
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
FAR = 1 << 40
#: Nothing or an assistant stands last at the end.
_END = (0, FAR, FAR, 0)
_GUESS = (3, 3, 3, 0)
#: Rows of a chunk, and characters of its texts, after which it ends.
CHUNK, CHUNK_TEXT = 1 << 14, 4_000_000

# A row's code: its role's initial (0 other, or the state that it leads to), and what it lacks.
_SHORT, _GONE, _DROPPED = 4, 8, 16


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n, dropped) of rows (conv, turn, role, text): each with n copies after the damage, equal rows together.

    A row's damage is crc32 of ``conv:turn``, null written as one space, modulo 20: 0 drops it, 1 empties its text, 2 removes
    its ``[.!?]``, 3 repeats it, 4 makes it the user's. A null role or text is one space. Rows without a copy stay with n = 0.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(kind == 4, "user").otherwise(blank("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long")
    hit = rows.select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("n"))
    return hit.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _coded(rows: DataFrame) -> DataFrame:
    """rows with ``code`` and ``kept``: the copies after the first, and rows whose role and text stood earlier, are duplicates."""
    last = F.substring(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), -1, 1)
    live = rows.where("n > 0")
    first = live.where(last != "").groupBy("conv", "role", "text").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("at"))
    names = ("conv", "turn", "role", "text")
    first = first.select(F.col("conv").alias("conv2"), F.col("at.turn").alias("turn2"), F.col("role").alias("role2"), F.col("text").alias("text2"), F.lit(True).alias("first"))
    # On all four columns no key is hot: equal rows are one.
    marked = rows.join(first, [F.col(c).eqNullSafe(F.col(f"{c}2")) for c in names], "left").select(*names, "n", "first")
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    code = code + F.when(last.isin(".", "!", "?"), 0).otherwise(_SHORT) + F.when(F.col("n") == 0, _DROPPED).otherwise(0)
    return marked.select("conv", "turn", "role", F.when(last == "", "").otherwise(F.col("text")).alias("text"), "n", (code + F.when(F.col("first") & (last != ""), 0).otherwise(_GONE)).cast("int").alias("code"), (last == "").alias("blank"))


class _Chunk:
    """Rows of one conversation, in order, as far as the repair and the counts need them."""

    def __init__(self) -> None:
        self.codes, self.lines, self.size = bytearray(), [], 0
        self.turns: list[int] = []  # distinct ones, the first and the last
        self.n_turns = self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.initials = (None, None)
        self.jumps: list[tuple[int, int]] = []  # (place in codes, further rows that are deleted there)

    def add(self, turn, role: str, text: str, n: int, code: int, blank: bool) -> None:
        if code & _DROPPED:
            return
        if turn is not None and (not self.turns or turn != self.turns[-1]):
            self.n_turns += 1
            self.turns = [self.turns[0] if self.turns else turn, turn]
        initial = role[:1]
        if self.rows:
            self.illegal += (self.initials[1] + initial) not in ("su", "ua", "au")
        self.illegal += n - 1  # a copy follows a row of the same role
        self.initials = (self.initials[0] if self.rows else initial, initial)
        self.rows += n
        kept = not code & _GONE
        if blank:
            self.blank += n
        else:
            self.duplicate += n - kept
            self.truncated += bool(kept and code & _SHORT)
        if kept:
            self.codes.append(code)
            self.lines.append((role, text))
            self.size += len(text)
        if n - kept:
            if self.jumps and self.jumps[-1][0] == len(self.codes):
                self.jumps[-1] = (len(self.codes), self.jumps[-1][1] + n - kept)
            else:
                self.jumps.append((len(self.codes), n - kept))

    def row(self) -> dict:
        return {"codes": bytes(self.codes), "roles": [r for r, _ in self.lines], "texts": [t for _, t in self.lines], "places": [p for p, _ in self.jumps], "gone": [g for _, g in self.jumps]} | {"turns": self.turns, "n_turns": self.n_turns, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "n_rows": self.rows, "initials": [x for x in self.initials if x is not None]}


_FIELDS = "codes binary, roles array<string>, texts array<string>, places array<long>, gone array<long>, turns array<long>, n_turns long, blank long, duplicate long, truncated long, illegal long, n_rows long, initials array<string>"
_PARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(x.split(" ")[0], _PARROW[x.split(" ")[1]]) for x in text.split(", ")])


_CHUNKS = "conv string, known int, part long, seq long, " + _FIELDS


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Chunks of sorted rows (conv, turn, role, text, n, code, blank)."""
    part, seq, open_, chunk, out, held = TaskContext.get().partitionId(), 0, None, None, [], 0

    def close():
        nonlocal seq, held
        if open_ is not None:
            held += chunk.size
            out.append({"conv": open_[0], "known": int(open_[0] is not None), "part": part, "seq": seq} | chunk.row())
            seq += 1

    for batch in batches:
        for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if open_ is None or open_[0] != conv or len(chunk.codes) >= most or len(chunk.jumps) >= most or chunk.size >= CHUNK_TEXT:
                close()
                open_, chunk = (conv,), _Chunk()
            chunk.add(*row)
            if len(out) >= 256 or held >= CHUNK_TEXT:
                yield pa.RecordBatch.from_pylist(out, schema=_schema(_CHUNKS))
                out, held = [], 0
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_schema(_CHUNKS))


_moves: dict[tuple, tuple] = {}


def _before(code: int, after: tuple) -> tuple[tuple, int]:
    """The costs before a row from those after it, less their least, which comes second. Few vectors occur, so each is worked out once."""
    known = _moves.get((code, after))
    if known is None:
        short = CUT_SHORT if code & _SHORT else 0
        cost = []
        for state in range(4):
            least = DELETE + after[state]
            if code & 3 == _AFTER[state] or (code & 3 == SYSTEM and state == START):
                least = min(least, KEEP + short + after[code & 3])
            cost.append(min(least, REROLE + short + after[_AFTER[state]]))
        known = _moves[code, after] = _levelled(_with_inserts(cost))
    return known


def _with_inserts(cost: list) -> list:
    for _ in range(2):
        cost = [min(c, INSERT + cost[_AFTER[state]]) for state, c in enumerate(cost)]
    return cost


def _levelled(cost: list | tuple) -> tuple[tuple, int]:
    least = min(cost)
    return tuple(min(FAR, c - least) for c in cost), least


def costs(codes: bytes, end: tuple) -> tuple[list[tuple], int]:
    """The levelled costs before each row and at the end, and what was levelled off in all."""
    now, total = _levelled(_with_inserts(list(end)))
    out = [now]
    for code in reversed(codes):
        now, less = _before(code, now)
        total += less
        out.append(now)
    return out[::-1], total


def trace(codes: bytes, at: list[tuple], state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, row, state after it) of the least audit among the cheapest from ``state``; after the last row only turns that are put in."""
    for i, code in enumerate(codes):
        short, here, after = CUT_SHORT if code & _SHORT else 0, at[i], at[i + 1]
        level = min(_with_inserts(_raw(code, after)))
        while True:
            to, want = _AFTER[state], here[state] + level
            if DELETE + after[state] == want:
                yield "D", i, state
                break
            if INSERT + here[to] + level == want:
                yield "I", i, to
                state = to
                continue
            kept = code & 3 == to or (code & 3 == SYSTEM and state == START)
            if kept and KEEP + short + after[code & 3] == want:
                state = code & 3
                yield "K", i, state
            else:
                state = to
                yield "R", i, state
            break


def _raw(code: int, after: tuple) -> list:
    short = CUT_SHORT if code & _SHORT else 0
    return [min(DELETE + after[s], REROLE + short + after[_AFTER[s]], *([KEEP + short + after[code & 3]] if code & 3 == _AFTER[s] or (code & 3 == SYSTEM and s == START) else [])) for s in range(4)]


def _repaired(chunk: dict, end: tuple, state: int, last: bool) -> tuple[str, list[str], int]:
    """(audit, repaired lines, cost) of a chunk that is entered in ``state``, and with the turns put in after its end if it is the last."""
    at, _ = costs(chunk["codes"], end)
    gone = dict(zip(chunk["places"], chunk["gone"], strict=True))
    audit, lines, cost, row = [], [], 0, 0

    def deleted(place: int) -> None:
        # Deletions come before anything that can be put in there: D is the least letter.
        nonlocal cost
        n = gone.pop(place, 0)
        if n:
            audit.append("D" * n)
            cost += DELETE * n

    deleted(0)
    for edit, i, to in trace(chunk["codes"], at, state):
        if edit == "I":
            lines.append("user:" if to == USER else "assistant:")
            cost += INSERT
        else:
            role, text = chunk["roles"][i], chunk["texts"][i]
            if edit == "D":
                cost += DELETE
            else:
                lines.append(f"{role if edit == 'K' else 'user' if to == USER else 'assistant'}:{text}")
                cost += (REROLE if edit == "R" else KEEP) + (CUT_SHORT if chunk["codes"][i] & _SHORT else 0)
            row = i + 1
        audit.append(edit)
        if edit != "I":
            deleted(row)
        state = to
    if last:
        while state not in (START, ASSISTANT):
            state = _AFTER[state]
            audit.append("I")
            lines.append("user:" if state == USER else "assistant:")
            cost += INSERT
    return "".join(audit), lines, cost


def _exits(codes: bytes, end: tuple) -> list[int]:
    """The state after a chunk for each in which it may be entered."""
    at, _ = costs(codes, end)
    out = []
    for state in range(4):
        for _, _, state in trace(codes, at, state):  # noqa: B007, PLW2901
            pass
        out.append(state)
    return out


def _begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, known, no, end, start) of (conv, known, no, codes, end): the costs before a chunk, from those at its end."""
    for batch in batches:
        conv, known, no, codes, end = (c.to_pylist() for c in batch.columns)
        start = [list(costs(c, tuple(e))[0][0]) for c, e in zip(codes, end, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(4), pa.array(start, pa.list_(pa.int64()))], names=["conv", "known", "no", "end", "start"])


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, end = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        exits = [_exits(c, tuple(e)) for c, e in zip(codes, end, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(exits, pa.list_(pa.int64()))], names=["conv", "known", "no", "exits"])


def stitched_ends(chunks: DataFrame) -> DataFrame:
    """(conv, known, no, end): the costs at the end of each of the chunks (conv, known, no, last, codes), a written table.

    All chunks but the last of a conversation begin with a guess. A pass runs those again whose end differs by more than a
    constant from what the next one begins with, and ends when there is none. Chunks of many rows forget their end, so few
    passes are needed; were that not so, each would still settle one more chunk of each conversation.
    """
    vector = lambda v: F.array(*[F.lit(x).cast("long") for x in v])
    key = ["conv", "known", "no"]
    level = lambda v: vector(_levelled(_with_inserts(list(v)))[0])
    run = lambda df: df.select(*key, "codes", "end").mapInArrow(_begun, "conv string, known int, no long, end array<long>, start array<long>")
    now = common.written(run(chunks.withColumn("end", F.when(F.col("last"), level(_END)).otherwise(level(_GUESS)))), "begun")
    while True:
        ahead = now.select(F.col("conv").alias("conv2"), F.col("known").alias("known2"), (F.col("no") - 1).alias("no2"), F.col("start").alias("wanted"))
        met = now.join(ahead, F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("known") == F.col("known2")) & (F.col("no") == F.col("no2")), "left").select(*now.columns, "wanted")
        met = common.written(met.withColumn("wrong", F.coalesce(F.col("wanted") != F.col("end"), F.lit(False))), "met")
        wrong = met.where("wrong").select(*key, F.col("wanted").alias("end"))
        if wrong.isEmpty():
            return now.select(*key, "end")
        again = run(chunks.select(*key, "codes").join(wrong.withColumnsRenamed({c: f"{c}2" for c in key}), F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("no") == F.col("no2")) & (F.col("known") == F.col("known2"))))
        now = common.written(met.where("not wrong").select(*now.columns).unionByName(again), "begun")


def stitched_states(chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """(conv, known, no, end, state): also the state in which each chunk is entered, by passes over the chunks' exits."""
    key = ["conv", "known", "no"]
    same = lambda a, b: a["conv"].eqNullSafe(b["conv"]) & (a["known"] == b["known"]) & (a["no"] == b["no"])
    with_end = chunks.join(ends, same(chunks, ends)).select(*[chunks[c] for c in key], "codes", "end")
    left = with_end.mapInArrow(_left, "conv string, known int, no long, exits array<long>")
    now = common.written(left.withColumn("state", F.when(F.col("no") == 0, START).otherwise(ASSISTANT).cast("long")), "entered")
    while True:
        before = now.select(F.col("conv").alias("conv2"), F.col("known").alias("known2"), (F.col("no") + 1).alias("no2"), F.element_at("exits", (F.col("state") + 1).cast("int")).alias("wanted"))
        met = now.join(before, F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("known") == F.col("known2")) & (F.col("no") == F.col("no2")), "left")
        met = common.written(met.select(*key, "exits", F.coalesce("wanted", "state").alias("state"), F.coalesce(F.col("wanted") != F.col("state"), F.lit(False)).alias("wrong")), "entered")
        now = met.drop("wrong")
        if met.where("wrong").isEmpty():
            return now.join(ends, same(now, ends)).select(*[now[c] for c in key], "end", "state")


_PARTS = "conv string, known int, no long, audit string, repaired string, has_lines int, cost long, turns array<long>, n_turns long, blank long, duplicate long, truncated long, illegal long, n_rows long, initials array<string>"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 8):
            out = []
            for c in batch.slice(begin, 8).to_pylist():
                audit, lines, cost = _repaired(c, tuple(c["end"]), c["state"], c["last"])
                out.append({k: c[k] for k in ("conv", "known", "no", "turns", "n_turns", "blank", "duplicate", "truncated", "illegal", "n_rows", "initials")} | {"audit": audit, "repaired": "\n".join(lines), "has_lines": int(bool(lines)), "cost": cost})
            yield pa.RecordBatch.from_pylist(out, schema=_schema(_PARTS))


_FOUND = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of the sorted parts; of a conversation only its audit grows in memory."""
    open_, out = None, []

    def close():
        if open_ is not None:
            turns = open_["turns"]
            out.append({"conv": open_["conv"], "gaps": turns[1] - turns[0] + 1 - open_["n_turns"] if turns else 0, **{k: open_[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")}, "audit": "".join(open_["audit"]), "repaired_sha256": open_["hash"].hexdigest()})

    for batch in batches:
        for begin in range(0, batch.num_rows, 32):
            for c in batch.slice(begin, 32).to_pylist():
                if open_ is None or (open_["conv"], open_["known"]) != (c["conv"], c["known"]):
                    close()
                    open_ = {"conv": c["conv"], "known": c["known"], "turns": [], "initial": None, "audit": [], "hash": hashlib.sha256(), "lines": 0} | dict.fromkeys(("n_turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
                o = open_
                for k in ("n_turns", "blank", "duplicate", "truncated", "illegal", "cost"):
                    o[k] += c[k]
                if c["turns"]:
                    if o["turns"] and o["turns"][1] == c["turns"][0]:
                        o["n_turns"] -= 1  # a turn whose rows end one chunk and begin the next
                    o["turns"] = [o["turns"][0] if o["turns"] else c["turns"][0], c["turns"][-1]]
                if c["n_rows"]:
                    if o["initial"] is not None:
                        o["illegal"] += (o["initial"] + c["initials"][0]) not in ("su", "ua", "au")
                    o["initial"] = c["initials"][1]
                o["audit"].append(c["audit"])
                if c["has_lines"]:
                    o["hash"].update((("\n" if o["lines"] else "") + c["repaired"]).encode())
                    o["lines"] = 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_schema(_FOUND))
                out = []
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_schema(_FOUND))


def repairs(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The parts of all conversations of rows (conv string, turn, role, text, n), and how many chunks each has: see ``repaired``."""
    spark = rows.sparkSession
    common.importable(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = _coded(rows).select("conv", F.col("turn").cast("long").alias("turn"), "role", "text", "n", "code", "blank")
    placed = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    chunks = common.written(placed.mapInArrow(lambda it: _chunks(it, chunk), _CHUNKS), "chunks")
    key = [F.col(c).eqNullSafe(F.col(f"{c}2")) for c in ("conv", "known", "part", "seq")]
    several = chunks.groupBy("conv", "known").agg(F.count(F.lit(1)).alias("n_chunks")).where("n_chunks > 1").withColumnsRenamed({"conv": "conv2", "known": "known2"})
    several = common.written(several, "several")
    of_several = chunks.join(common.small_or_not(several), F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("known") == F.col("known2")))
    # Numbered by their ranges: one narrow row for each chunk of a conversation goes through the window.
    at = Window.partitionBy("conv", "known").orderBy("part", "seq")
    numbered = of_several.select("conv", "known", "part", "seq", "n_chunks").withColumn("no", F.row_number().over(at).cast("long") - 1)
    numbered = common.written(numbered.withColumn("last", F.col("no") == F.col("n_chunks") - 1), "numbered")
    names = numbered.select(*[F.col(c).alias(f"{c}2") for c in ("conv", "known", "part", "seq")], "no", "last")
    table = common.written(chunks.join(names, key).select("conv", "known", "no", "last", "codes"), "codes")
    solved = stitched_states(table, stitched_ends(table))
    solved = solved.select(F.col("conv").alias("conv3"), F.col("known").alias("known3"), F.col("no").alias("no3"), "end", "state")
    solved = common.written(names.join(solved, F.col("conv2").eqNullSafe(F.col("conv3")) & (F.col("known2") == F.col("known3")) & (F.col("no") == F.col("no3"))).select(*names.columns, "end", "state"), "solved")
    end = F.array(*[F.lit(x).cast("long") for x in _END])
    done = chunks.join(common.small_or_not(solved), key, "left")
    done = done.select("conv", "known", F.coalesce("no", F.lit(0)).alias("no"), F.coalesce("last", F.lit(True)).alias("last"), F.coalesce("end", end).alias("end"), F.coalesce("state", F.lit(0)).alias("state"), *[x.split(" ")[0] for x in _FIELDS.split(", ")])
    return done.mapInArrow(_parts, _PARTS), several


def repaired(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of damaged rows (conv string, turn, role, text, n).

    A conversation's rows stand by turn, null first, then by role and text; equal ones are copies (n). A row is blank without
    a character other than ASCII white space, else a duplicate if its role and text stood earlier, else truncated if its last
    such character is not ``[.!?]``. Blank rows and duplicates are deleted (4). Others are kept, if they then fit, or get
    another role (3), either plus 3 if truncated, or deleted (4); user and assistant turns without text are put in (3), so that
    the initials of the roles read (s?(ua)+)?. audit has the initials of the cheapest edits, the least in ASCII of equals.
    Rows with n = 0 were dropped; a conversation that has none else has zeros and the hash of nothing. Null is a conversation
    of its own. An empty table gives no rows. A conversation's audit is one string, and its text is hashed in order by one
    task, which is what the result asks for; all else of a long conversation is spread by chunks.
    """
    parts, several = repairs(rows, chunk)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.join(common.small_or_not(several), F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("known") == F.col("known2")), "left")
    parts = common.written(parts.withColumn("whole", F.col("n_chunks").isNull()).drop("conv2", "known2", "n_chunks"), "repaired")
    names = [x.split(" ")[0] for x in _PARTS.split(", ")]
    alone = parts.where("whole").select(*names).mapInArrow(_whole, _FOUND)
    rest = parts.where("not whole").select(*names).repartition(n, "conv", "known").sortWithinPartitions("conv", "known", "no")
    return alone.unionByName(rest.mapInArrow(_whole, _FOUND))


def repair(conversations: DataFrame, chunk: int = CHUNK, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of conversations after ``damaged``; see ``repaired``.

    conv_id keeps its type. Repeated rows count. Other columns are ignored.
    """
    rows = conversations.select(F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    found = repaired(common.written(damaged(rows), "damaged"), chunk)
    return found.select(F.col("conv").cast(conversations.schema[conv_col].dataType).alias("conv_id"), *[x.split(" ")[0] for x in _FOUND.split(", ")[1:]])
