"""Operator 12: cheapest repair of conversations, by one integer minimum over a DAG.

Nodes are (row, role state); an edge is what happens before and at a row: up to two inserts, then keep,
rerole or delete. Its weight is one integer: the cost in the high digits, then three base-8 digits for
each row with the audit letters (D 1, I 2, K 3, R 4 in ASCII order), zeros after them. No letter code of
a row begins another's, so the order of the integers is the order of cost, then of audits as text, and
ordinary minima decide both. (Three inserts in a row would pass one state twice, so two are enough.)

A conversation of any length is split: rows, without their texts, are sorted by ranges over all tasks and
cut into units of at most ``UNIT`` rows. Each unit's minimum from every state to every state follows from
its codes alone; units of a conversation are then chained, where the digits of what came before shrink to
their rank among the four states, and traced back, so weights stay narrow. One stream for each
conversation writes the audit and the digest, which is sequential by its nature, and holds no rows.

Damage and order: a row's key is ``conv_id:turn`` (nulls: one space, also for null roles and texts). Rows
go by turn, nulls first; rows of one turn by a hash of role and text, so that equal ones are adjacent.

Defined results: one row per conversation id of the input, null included; a conversation without rows
after damage has zeros, an empty audit and the digest of nothing. A role is judged by its first letter; an
empty one fits nowhere. Empty texts are blank. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import text as tx
from cellweave.session import cut, discard, shuffle_parts

#: Rows of a unit.
UNIT = 64
#: Digits of a row, in bits, and the digit of each letter.
SLOT, DIGIT = 9, {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {v: k for k, v in DIGIT.items()}
#: Role states: nothing yet, after a system, a user, an assistant row. An insert leads on; so does the end.
ON, END = {0: 2, 1: 2, 2: 3, 3: 2}, {0: 0, 1: 2, 2: 1, 3: 0}
NAME = {2: "user", 3: "assistant"}
WHITE = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, copies after damage; a repeated row has two copies."""
    key = F.concat(F.coalesce(F.col(conv).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    d = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("k")).filter("k <> 0")
    to_text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return d.select("conv", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), to_text.alias("text"), F.when(F.col("k") == 3, 2).otherwise(1).alias("copies"))


def coded(rows: DataFrame) -> DataFrame:
    """Damaged rows with ``has`` (a turn), ``h`` and ``h2`` of role and text, and ``code``: initial and T if truncated, or B if blank."""
    rest = F.rtrim("text", F.lit(WHITE))
    code = F.when(rest == "", "B").otherwise(F.concat(F.when(F.substring(rest, -1, 1).isin(".", "!", "?"), "-").otherwise("T"), F.substring("role", 1, 1)))
    return rows.select("conv", F.col("turn").isNotNull().cast("int").alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"), F.xxhash64(F.lit(1), "role", "text").alias("h"), F.xxhash64(F.lit(2), "role", "text").alias("h2"), code.alias("code"), F.substring("role", 1, 1).alias("initial"), "role", "text", "copies")


def same(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by null-safe keys; the keys of ``b`` fall away."""
    b = b.select(*[F.col(k).alias("_" + k) for k in keys], *[c for c in b.columns if c not in keys])
    on = a[keys[0]].eqNullSafe(b["_" + keys[0]])
    for k in keys[1:]:
        on = on & (a[k] == b["_" + k])
    return a.join(b, on, how).drop(*["_" + k for k in keys])


KEY = ["has", "turn", "h", "h2"]


@lru_cache(maxsize=64)
def row_edges(code: str) -> tuple[tuple[int, int, int, int], ...]:
    """(from, to, cost, digits) of a row: the least for each pair of states. ``code``: D, or T or - and the initial."""
    best: dict[tuple[int, int], int] = {}

    def offer(p: int, q: int, cost: int, letters: str) -> None:
        digits = 0
        for k, x in enumerate(letters):
            digits |= DIGIT[x] << (SLOT - 3 * (k + 1))
        best[p, q] = min(best.get((p, q), 1 << 60), cost << SLOT | digits)

    for p in range(4):
        at, ins = p, ""
        for _ in range(3):
            cost = 2 * len(ins)
            offer(p, at, cost + 3, ins + "D")
            if code != "D":
                late, initial = int(code[0] == "T"), code[1:]
                keep = {"s": 1 if at == 0 else None, "u": 2 if at != 2 else None, "a": 3 if at == 2 else None}.get(initial)
                if keep is not None:
                    offer(p, keep, cost + late, ins + "K")
                offer(p, ON[at], cost + 2 + late, ins + "R")
            at, ins = ON[at], ins + "I"
    return tuple((p, q, w >> SLOT, w & ((1 << SLOT) - 1)) for (p, q), w in sorted(best.items()))


@lru_cache(maxsize=1 << 15)
def unit_paths(codes: tuple[str, ...]) -> dict[tuple[int, int], int]:
    """(from, to) of a unit: its least weight, cost << SLOT * rows | digits."""
    n = len(codes)
    out = {}
    for start in range(4):
        here = {start: 0}
        for k, code in enumerate(codes):
            low, nxt = SLOT * (n - 1 - k), {}
            for p, q, cost, digits in row_edges(code):
                if p in here:
                    w = here[p] + (cost << SLOT * n) + (digits << low)
                    if q not in nxt or w < nxt[q]:
                        nxt[q] = w
            here = nxt
        out |= {(start, q): w for q, w in here.items()}
    return out


def letters(weight: int, n: int) -> list[str]:
    """Letters of each row of a unit's weight."""
    out = []
    for k in range(n):
        slot = weight >> SLOT * (n - 1 - k) & ((1 << SLOT) - 1)
        out.append("".join(LETTER[d] for d in (slot >> 6, slot >> 3 & 7, slot & 7) if d))
    return out


UNITS = "unit long, codes array<string>, first string, last string, illegal long, t0 long, t1 long, turns long, blank long, duplicate long, truncated long, keys array<struct<at:int,has:int,turn:long,h:long,h2:long>>"
LEGAL = {"su", "ua", "au"}


def units(compact: DataFrame) -> DataFrame:
    """conv and ``UNITS``: runs of at most UNIT rows of a conversation in its order."""
    kind = compact.schema["conv"].dataType.simpleString()
    order = ["conv", *KEY]
    ranged = compact.repartitionByRange(shuffle_parts(compact.sparkSession), *order).sortWithinPartitions(*order)
    ranged = ranged.select(*order, "code", "initial", "n", "later", F.spark_partition_id().cast("long").alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        u: dict | None = None
        number = 0
        for batch in batches:
            for conv, has, turn, h, h2, code, initial, n, later, task in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                left, must = n, code == "B" or later
                while left:
                    if u is None or u["conv"] != conv or len(u["codes"]) == UNIT:
                        if u:
                            made.append(u)
                        u = {"conv": conv, "unit": task << 40 | number, "codes": [], "first": initial, "last": None, "illegal": 0, "t0": None, "t1": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "keys": []}
                        number += 1
                    if u["last"] is not None and u["last"] + initial not in LEGAL:
                        u["illegal"] += 1
                    u["last"] = initial
                    if has and u["t1"] != turn:
                        u["turns"] += 1
                        u["t0"], u["t1"] = turn if u["t0"] is None else u["t0"], turn
                    if must or left < n:
                        u["codes"].append("D")
                        u["blank" if code == "B" else "duplicate"] += 1
                    else:
                        u["truncated"] += code[0] == "T"
                        u["keys"].append({"at": len(u["codes"]), "has": has, "turn": turn, "h": h, "h2": h2})
                        u["codes"].append(code)
                    left -= 1
                if len(made) >= 512:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made = []
        if u:
            yield pa.RecordBatch.from_pylist([*made, u], schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(f"conv {kind}, {UNITS}"))
    return cut(ranged.mapInArrow(tx.tidy(run), f"conv {kind}, {UNITS}"))


def chain(made: DataFrame) -> DataFrame:
    """Of each conversation: a row of totals (unit null), and for each unit the states it is entered and left in and the inserts after it."""
    kind = made.schema["conv"].dataType.simpleString()
    cols = ["conv", "unit", "codes", "first", "last", "illegal", "t0", "t1", "turns", "blank", "duplicate", "truncated"]
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    rows = made.select(*cols).repartition(shuffle_parts(made.sparkSession), "conv").sortWithinPartitions("conv", "unit")
    types = [("conv", None), ("unit", pa.int64()), ("p", pa.int32()), ("q", pa.int32()), ("tail", pa.int32()), *[(s, pa.int64()) for s in sums]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, here, back, names, total = None, None, None, None, None

        def close(conv_type):
            best, tail, q = min(((cost + 2 * END[q]) << 12 | rank << 6 | (2 << 3 | 2) >> 3 * (2 - END[q]), END[q], q) for q, (cost, rank) in here.items())
            t = total
            gaps = t["t1"] - t["t0"] + 1 - t["turns"] if t["t0"] is not None else 0
            done = {"conv": [conv], "unit": [None], "p": [None], "q": [None], "tail": [None], "gaps": [gaps], "cost": [best >> 12], **{s: [t[s]] for s in sums[1:5]}}
            yield batch_of(done, conv_type)
            for end in range(len(names), 0, -1 << 14):  # from the last unit back
                start, piece = max(0, end - (1 << 14)), {"unit": [], "p": [], "q": [], "tail": []}
                for k in range(end - 1, start - 1, -1):
                    p = back[4 * k + q]
                    for c, v in zip(piece, (names[k], p, q, tail), strict=True):
                        piece[c].append(v)
                    q, tail = p, 0
                n = len(piece["unit"])
                yield batch_of({"conv": [conv] * n, **piece, **{s: [None] * n for s in sums}}, conv_type)

        def batch_of(columns, conv_type):
            return pa.RecordBatch.from_arrays([pa.array(columns[c], conv_type if t is None else t) for c, t in types], [c for c, _ in types])

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for r in batch.to_pylist():
                if here is None or r["conv"] != conv:
                    if here is not None:
                        yield from close(conv_type)
                    conv, here, back, names, total = r["conv"], {0: (0, 0)}, bytearray(), array("q"), dict.fromkeys(["illegal", "turns", "blank", "duplicate", "truncated"], 0) | {"t0": None, "t1": None, "last": None}
                for c in ("illegal", "blank", "duplicate", "truncated"):
                    total[c] += r[c]
                total["illegal"] += total["last"] is not None and total["last"] + r["first"] not in LEGAL
                total["last"] = r["last"]
                if r["t0"] is not None:
                    total["turns"] += r["turns"] - (total["t1"] == r["t0"])
                    total["t0"] = r["t0"] if total["t0"] is None else total["t0"]
                    total["t1"] = r["t1"]
                n = len(r["codes"])
                width, best = SLOT * n, {}
                for (p, q), w in unit_paths(tuple(r["codes"])).items():
                    if p in here:
                        cost, rank = here[p]
                        v = ((cost << 2 + width) + (w >> width << 2 + width) | rank << width | w & ((1 << width) - 1), p)
                        best[q] = min(best.get(q, v), v)
                low = (1 << 2 + width) - 1
                order = sorted({v & low for v, _ in best.values()})
                here = {q: (v >> 2 + width, order.index(v & low)) for q, (v, _) in best.items()}
                back += bytes(best[q][1] if q in best else 0 for q in range(4))
                names.append(r["unit"])
        if here is not None:
            yield from close(conv_type)

    return cut(rows.mapInArrow(tx.tidy(run), f"conv {kind}, unit long, p int, q int, tail int, " + ", ".join(f"{s} long" for s in sums)))


ITEM = "has int, turn long, h long, h2 long, kind int, role string, text string"


def traced(made: DataFrame, states: DataFrame) -> DataFrame:
    """conv and ``ITEM``: audit letters of units (has -1, turn: the unit; text), and what goes before and at each row that stays (kind 0; text: roles put in, one letter each)."""
    kind = made.schema["conv"].dataType.simpleString()
    rows = made.select("unit", "conv", "codes", "keys").join(states.filter("unit is not null").select("unit", "p", "q", "tail"), "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                codes = r["codes"]
                at, slots = r["p"], letters(unit_paths(tuple(codes))[r["p"], r["q"]], len(codes))
                keys = {k["at"]: k for k in r["keys"]}
                for k, slot in enumerate(slots):
                    put = ""
                    for _ in slot[:-1]:
                        at = ON[at]
                        put += NAME[at][0]
                    if slot[-1] == "D":
                        continue
                    key, role = keys[k], None
                    if slot[-1] == "R":
                        at = ON[at]
                        role = NAME[at]
                    else:
                        at = {"s": 1, "u": 2, "a": 3}[codes[k][1:]]
                    out.append({"conv": r["conv"], **{c: key[c] for c in KEY}, "kind": 0, "role": role, "text": put})
                put = ""
                for _ in range(r["tail"]):
                    at = ON[at]
                    put += NAME[at][0]
                out.append({"conv": r["conv"], "has": -1, "turn": r["unit"], "h": 0, "h2": 0, "kind": 0, "role": None, "text": "".join(slots) + "I" * r["tail"]})
                if put:
                    out.append({"conv": r["conv"], "has": 2, "turn": 0, "h": 0, "h2": 0, "kind": 0, "role": None, "text": put})
            yield pa.RecordBatch.from_pylist(out, pa.schema([batch.schema.field("conv"), *[(c, pa.int32() if t == "int" else pa.int64() if t == "long" else pa.string()) for c, t in (x.split() for x in ITEM.split(", "))]]))

    return rows.mapInArrow(tx.tidy(run), f"conv {kind}, {ITEM}")


def written(items: DataFrame) -> DataFrame:
    """conv, audit, repaired_sha256: items of a conversation in order, each row (kind 1) behind its item."""
    kind = items.schema["conv"].dataType.simpleString()
    rows = items.repartition(shuffle_parts(items.sparkSession), "conv").sortWithinPartitions("conv", *KEY, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, parts, digest, wait = None, None, None, None
        done: list[tuple] = []

        def close():
            done.append((conv, "".join(parts), digest.hexdigest()))

        for batch in batches:
            for name, has, turn, h, h2, what, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if parts is None or name != conv:
                    if parts is not None:
                        close()
                    conv, parts, digest, wait, empty = name, [], hashlib.sha256(), None, True
                if has == -1:
                    parts.append(text)
                    continue
                lines = []
                if what == 0:
                    lines = ["user:" if x == "u" else "assistant:" for x in text]
                    wait = (has, turn, h, h2, role) if has < 2 else None
                elif wait and wait[:4] == (has, turn, h, h2):
                    lines, wait = [f"{wait[4] or role}:{text}"], None
                for line in lines:
                    digest.update((line if empty else "\n" + line).encode())
                    empty = False
            if len(done) > 1024:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field("conv").type), *[pa.array([d[k] for d in done], pa.string()) for k in (1, 2)]], ["conv", "audit", "repaired_sha256"])
                done.clear()
        if parts is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field("conv").type), *[pa.array([d[k] for d in done], pa.string()) for k in (1, 2)]], ["conv", "audit", "repaired_sha256"])

    return rows.select("conv", *KEY, "kind", "role", "text").mapInArrow(tx.tidy(run), f"conv {kind}, audit string, repaired_sha256 string")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation of ``rows`` after damage."""
    all_rows = coded(damage(rows, conv, turn, role, text))
    grouped = cut(all_rows.groupBy("conv", *KEY).agg(F.sum("copies").alias("n"), F.first("code").alias("code"), F.first("initial").alias("initial")))
    first = grouped.filter("code <> 'B'").groupBy("conv", "h", "h2").agg(F.min(F.struct("has", "turn")).alias("early"))
    compact = same(grouped, first.hint("merge"), ["conv", "h", "h2"], "left").withColumn("later", F.coalesce(F.struct("has", "turn") > F.col("early"), F.lit(False)))
    made = units(compact)
    states = chain(made)
    items = traced(made, states)
    kept = all_rows.filter("code <> 'B'").select("conv", *KEY, F.lit(1).alias("kind"), "role", "text")
    texts = cut(written(items.unionByName(kept)))
    totals = states.filter("unit is null").drop("unit", "p", "q", "tail")
    discard(grouped)
    out = rows.select(F.col(conv).alias("conv")).distinct()
    out = same(same(out, totals, ["conv"], "left"), texts, ["conv"], "left")
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("conv").alias(conv), *sums, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"))
