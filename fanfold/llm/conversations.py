"""Conversation structure repair by Wagner-Fischer alignment with a grammar.

A conversation is repaired to role initials ``(s?(ua)+)?``: rows are kept, given the other
role, deleted or inserted, at the least cost.  The grammar has one string of each length at
most, so the turns are aligned with the string of each feasible length.  All these strings
end alike, so the costs of aligning the last rows with the last letters are one table whose
columns serve all lengths: a new length adds a column.  A column holds only the rows within
Ukkonen's bands, for a repair that costs no more than the incumbent deletes at most
cost / 2 rows and inserts at most cost / 5; the incumbent is a greedy repair first, then the
cheapest length met.  Lengths of equal cost are traced back, and their audits compared.

A conversation of up to LONG rows and LONG_BYTES of text is repaired whole in a task.  A
longer one is dealt to blocks of BLOCK rows by position.  Each block is aligned from each
state of the grammar to each other (nothing yet, after s, after u, after a), in tasks of
their own and without texts; the blocks' costs and audits are then chained in order.  This is
exact: audits of one cost over the same rows never begin with each other, so the least ones
of the parts make the least whole.  Only the digest of the repaired text, which is a chain
over it by nature, takes a single task, which streams the rows in order and holds one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import with_ranks
from .common import SPACE_CHARS, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LONG, LONG_BYTES, BLOCK = 4096, 8 << 20, 256
#: Roles that a row may be given, by initial, and ends of whole sentences.
ROLES, STOPS = {"u": "user", "a": "assistant"}, ".!?"
#: States of the grammar: nothing yet, after s, after u, after a.
STATES = "0sua"
#: Letters that may follow a state, and pairs of states that a block can join.
FOLLOWS = {"0": "su", "s": "u", "u": "a", "a": "u"}
JOINS = [("0", "0"), ("0", "s"), ("0", "u"), ("0", "a"), ("s", "s"), ("s", "u"), ("s", "a"), ("u", "u"), ("u", "a"), ("a", "u"), ("a", "a")]
_NEVER = 1 << 60
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` damaged by the hash of conversation and turn, nulls as one
    space: one in twenty each is dropped, loses its text or its stops, comes twice, or gets
    the role user.  Dropped rows stay, marked ``gone``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    hurt = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), what.alias("what"))
    new = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("what") == 4, ROLES["u"]).otherwise(F.col("role"))
    times = F.explode(F.when(F.col("what") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return hurt.select("conv_id", "turn", role.alias("role"), new.alias("text"), (F.col("what") == 0).alias("gone"), times.alias("_n")).drop("_n")


# alignment: a mark is (role initial, must be deleted, cost of staying)


def _upper(marks, start: str, end: str) -> int:
    """The cost of a greedy repair from state ``start`` to ``end``."""
    state, cost = start, 0
    for letter, must, stay in marks:
        if must:
            cost += DELETE
        else:
            if letter and letter in FOLLOWS[state]:
                state = letter
            else:
                state, cost = FOLLOWS[state][-1], cost + REROLE
            cost += stay
    while state != end:
        state, cost = FOLLOWS[state][-1], cost + INSERT
    return cost


def align(marks, start: str, end: str) -> tuple[int, str] | None:
    """``(cost, audit)`` of the cheapest repair whose letters lead from ``start`` to ``end``,
    the ASCII-least of equal ones; None if there is none."""
    n = len(marks)
    if end in "0s":
        return _deleted(marks, start, end)
    best = _upper(marks, start, end)
    first = FOLLOWS[start][-1]
    with_s = start == "0" and any(letter == "s" and not must for letter, must, _ in marks)
    columns, found, r = [], [], 0
    while (r - n) * INSERT <= best:
        letter = end if r % 2 else ("u" if end == "a" else "a")  # of the first of the last r letters
        low, high = max(0, n - r - best // DELETE), min(n, n - r + best // INSERT)
        column, last = [_NEVER] * (n + 2), columns[-1] if columns else None
        for i in range(high, low - 1, -1):
            if i == n:
                cost = INSERT * r
            else:
                cost = column[i + 1] + DELETE
                if last:
                    cost = min(cost, last[i] + INSERT)
                    mark, must, stay = marks[i]
                    if not must:
                        cost = min(cost, last[i + 1] + stay + (KEEP if mark == letter else REROLE))
            column[i] = cost
        columns.append(column)
        if start == end if r == 0 else letter == first:
            found.append((column[0], r, None))
        if with_s and r and letter == "u":
            front = [_NEVER] * (n + 1)
            for i in range(n - 1, -1, -1):
                mark, must, stay = marks[i]
                front[i] = min(front[i + 1] + DELETE, column[i + 1] + stay + KEEP if mark == "s" and not must else _NEVER)
            found.append((front[0], r, front))
        if found:
            best = min(best, *(f[0] for f in found[-2:]))
        r += 1
    if not found:
        return None
    cost = min(f[0] for f in found)
    return None if cost >= _NEVER else (cost, min(_audit(marks, columns, r, front, end) for c, r, front in found if c == cost))


def _deleted(marks, start: str, end: str) -> tuple[int, str] | None:
    """Repairs that leave nothing, or one row with an s."""
    n = len(marks)
    if start == end:
        return DELETE * n, "D" * n
    kept = [(DELETE * (n - 1) + stay, "D" * i + "K" + "D" * (n - 1 - i)) for i, (letter, must, stay) in enumerate(marks) if letter == "s" and not must]
    return min(kept, default=None)


def _audit(marks, columns, r: int, front, end: str) -> str:
    """The ASCII-least trace through the columns from the first row and the last ``r`` letters."""
    out, i, n = [], 0, len(marks)
    while front is not None:  # up to the row with the s
        if front[i + 1] + DELETE == front[i]:
            out.append("D")
            i += 1
        else:
            out.append("K")
            i, front = i + 1, None
    while i < n or r:
        column = columns[r]
        if i < n and column[i + 1] + DELETE == column[i]:
            out.append("D")
            i += 1
        elif r and columns[r - 1][i] + INSERT == column[i]:
            out.append("I")
            r -= 1
        else:
            letter = end if r % 2 else ("u" if end == "a" else "a")
            out.append("K" if marks[i][0] == letter else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def cheapest(marks) -> tuple[int, str]:
    return min(x for x in (align(marks, "0", "0"), align(marks, "0", "a")) if x is not None)


def repaired(rows, audit: str, state: str = "0"):
    """The lines ``role:text`` that an audit makes of ``rows``, an iterable of
    ``(role, text)``, from a state of the grammar on."""
    rows = iter(rows)
    for step in audit:
        role, text = ("", "") if step == "I" else next(rows)
        if step == "D":
            continue
        state = role[0] if step == "K" else FOLLOWS[state][-1]
        yield f"{role if step == 'K' else ROLES[state]}:{text}"


def faults(rows) -> list[str]:
    """The first fault of each of ``rows``, pairs of role and text: blank, duplicate, truncated or none."""
    seen, out = set(), []
    for row in rows:
        text = row[1].strip(SPACE_CHARS)
        out.append("blank" if not text else "duplicate" if row in seen else "truncated" if text[-1] not in STOPS else "")
        seen.add(row)
    return out


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def repair_one(rows) -> tuple:
    """``(blank, duplicate, truncated, illegal, cost, audit, digest)`` of one conversation."""
    fault = faults(rows)
    marks = [(role[:1], f in ("blank", "duplicate"), TRUNCATED * (f == "truncated")) for (role, _), f in zip(rows, fault, strict=True)]
    illegal = sum(not legal(x[0], y[0]) for x, y in zip(marks, marks[1:], strict=False))
    cost, audit = cheapest(marks)
    digest = hashlib.sha256("\n".join(repaired(rows, audit)).encode()).hexdigest()
    return fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, audit, digest


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """One row per conversation: ``conv``, ``gaps`` in its turns, rows that are ``blank``,
    ``duplicate`` or ``truncated``, ``illegal`` neighbours, ``cost``, ``audit`` and
    ``repaired_sha256``.  Rows for which ``gone`` holds take no part, but their conversation is
    returned.

    Rows go by turn, null turns first, rows of one turn by role and text; a null role or text
    is one space, a null conversation one of its own.  A row without an initial can't be kept.
    Repeated rows are duplicates.  Very long texts and conversations are repaired whole, the
    latter in blocks.  Further columns are not read; an empty table gives an empty result."""
    plain = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c if c not in (role, text) else {role: "role", text: "text"}[c])
    dropped = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    turns = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), plain(role), plain(text), dropped.alias("gone"))
    size = F.sum(F.when(~F.col("gone"), F.octet_length("text") + 1))
    long = stored(turns.groupBy("conv").agg(F.count(F.when(~F.col("gone"), 1)).alias("n"), size.alias("bytes")).where((F.col("n") > LONG) | (F.col("bytes") > LONG_BYTES)).select(F.col("conv").alias("l")), "long")
    if long.isEmpty():
        return _whole(turns).withColumnRenamed("conv", conv)
    mine = F.col("conv").eqNullSafe(F.col("l"))
    out = _whole(turns.join(long, mine, "left_anti")).unionByName(_in_blocks(turns.join(long, mine, "left_semi").where("NOT gone").drop("gone")))
    return out.withColumnRenamed("conv", conv)


def _gaps():
    turns = F.countDistinct("turn")
    return F.coalesce(F.max("turn") - F.min("turn") + 1 - turns, F.lit(0)).cast("long").alias("gaps")


def _whole(turns: DataFrame) -> DataFrame:
    kind = turns.schema["conv"].dataType.simpleString()
    row = F.when(~F.col("gone"), F.struct("turn", "role", "text"))
    whole = turns.groupBy("conv").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    at = F.filter(F.array_distinct(F.col("rows.turn")), lambda t: t.isNotNull())
    gaps = F.coalesce(F.array_max(at) - F.array_min(at) + 1 - F.size(at), F.lit(0)).cast("long")
    names = ["conv", *FIGURES, "audit", "repaired_sha256"]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            roles, texts = (c.to_pylist() for c in (batch.column(2), batch.column(3)))
            found = [repair_one(list(zip(x, y, strict=True))) for x, y in zip(roles, texts, strict=True)]
            columns = list(zip(*found, strict=True)) if found else [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])], names)

    schema = f"conv {kind}, {', '.join(f'{f} long' for f in FIGURES)}, audit string, repaired_sha256 string"
    return whole.select("conv", gaps.alias("gaps"), F.col("rows.role").alias("roles"), F.col("rows.text").alias("texts")).mapInArrow(run, schema)


def _in_blocks(turns: DataFrame) -> DataFrame:
    """Long conversations; none of them is ever held by one task but for what it returns."""
    kind = turns.schema["conv"].dataType.simpleString()
    whole = F.regexp_extract("text", rf"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$", 1)
    ranked = stored(with_ranks(turns, ["conv"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "place").withColumn("block", F.expr(f"place div {BLOCK}")), "ranked")
    told = [F.sha2(F.col(c), 256) for c in ("role", "text")]
    marked = ranked.select("conv", "turn", "place", "block", F.substring("role", 1, 1).alias("initial"), whole.alias("last"), F.concat(*told).alias("told"))
    # the first place of each text that comes again; a partial step keeps a hot text small
    again = marked.groupBy("conv", "told").agg(F.min("place").alias("least"), F.count("*").alias("n")).where("n > 1").select(F.col("conv").alias("c"), F.col("told").alias("d"), "least")
    fault = F.when(F.col("last") == "", "blank").when(F.col("place") > F.col("least"), "duplicate").when(~F.col("last").isin(*STOPS), "truncated").otherwise("")
    met = marked.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("told") == F.col("d")), "left").select("conv", "turn", "place", "block", "initial", fault.alias("fault"))
    met = stored(met, "marks")
    gaps = met.groupBy("conv").agg(_gaps()).select(F.col("conv").alias("g"), "gaps")
    lists = met.groupBy("conv", "block").agg(F.sort_array(F.collect_list(F.struct("place", "initial", "fault"))).alias("m"))
    joins = [f"{a}{b}" for a, b in JOINS]
    names = ["conv", "block", "edges", "counts", *(f"cost_{j}" for j in joins), *(f"audit_{j}" for j in joins)]

    def blocks(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for conv, block, initials, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marks = [(i, f in ("blank", "duplicate"), TRUNCATED * (f == "truncated")) for i, f in zip(initials, found, strict=True)]
                illegal = sum(not legal(x[0], y[0]) for x, y in zip(marks, marks[1:], strict=False))
                paths = [align(marks, a, b) or (None, None) for a, b in JOINS]
                out.append((conv, block, [initials[0], initials[-1]], [found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal], *(p[0] for p in paths), *(p[1] for p in paths)))
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            types = [batch.column(0).type, pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.int64()] * len(joins), *[pa.string()] * len(joins)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"conv {kind}, block long, edges array<string>, counts array<long>, {', '.join(f'cost_{j} long' for j in joins)}, {', '.join(f'audit_{j} string' for j in joins)}"
    aligned = stored(lists.select("conv", "block", F.col("m.initial").alias("i"), F.col("m.fault").alias("f")).mapInArrow(blocks, schema), "blocks")

    def chain(batches):
        """Rows of blocks in order, of one conversation after another: the way through them.

        Of each state's audit only its rank among the states' is kept, without the inserts at
        its end, whose number is kept besides: without these, audits over the same rows
        never begin with each other, so ranks and what is added decide every comparison."""
        import pyarrow as pa

        def ended(conv, states, sums, back):
            cost, _, _, end = min((*states[k], k) for k in ("0", "a") if k in states)
            way = []
            for joined in reversed(back):
                way.append(joined[end])
                end = way[-1][0]
            n = len(way)
            return pa.RecordBatch.from_arrays([pa.array([conv] * n, conv_type), pa.array(range(n), pa.int64()), pa.array(way[::-1]), pa.array([[*sums, cost]] * n, pa.list_(pa.int64()))], ["conv", "block", "path", "figures"])

        conv_type, now = pa.int64(), None
        for batch in batches:
            conv_type = batch.column(0).type
            for row in batch.to_pylist():
                if now is None or row["conv"] != now[0]:
                    if now is not None:
                        yield ended(*now[:4])
                    now = [row["conv"], {"0": (0, 0, "")}, [0] * 4, [], None]
                best = {}
                for join in joins:
                    a, b = join
                    if a in now[1] and row[f"cost_{join}"] is not None:
                        cost, rank, tail = now[1][a]
                        new = (cost + row[f"cost_{join}"], rank, tail + row[f"audit_{join}"], join)
                        best[b] = min(best.get(b, new), new)
                order = {x: k for k, x in enumerate(sorted({(rank, rest.rstrip("I")) for _, rank, rest, _ in best.values()}))}
                now[1] = {b: (cost, order[rank, rest.rstrip("I")], rest[len(rest.rstrip("I")) :]) for b, (cost, rank, rest, _) in best.items()}
                now[3].append({b: x[3] for b, x in best.items()})
                seam = now[4] is not None and not legal(now[4], row["edges"][0])
                now[2] = [x + y for x, y in zip(now[2], [*row["counts"][:3], row["counts"][3] + seam], strict=True)]
                now[4] = row["edges"][1]
        if now is not None:
            yield ended(*now[:4])

    ways = aligned.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(chain, f"conv {kind}, block long, path string, figures array<long>")
    ways = stored(ways, "ways")
    pieces = F.create_map(*(x for j in joins for x in (F.lit(j), F.col(f"audit_{j}"))))
    steps = aligned.select(F.col("conv").alias("pc"), F.col("block").alias("pb"), pieces.alias("pieces")).join(ways.select("conv", "block", "path"), F.col("pc").eqNullSafe(F.col("conv")) & (F.col("pb") == F.col("block")))
    steps = steps.select("pc", "pb", "path", F.col("pieces")[F.col("path")].alias("piece"))
    audits = steps.groupBy("pc").agg(F.sort_array(F.collect_list(F.struct("pb", "piece"))).alias("s")).select("pc", F.array_join(F.col("s.piece"), "").alias("audit"))
    with_steps = ranked.join(steps, F.col("conv").eqNullSafe(F.col("pc")) & (F.col("block") == F.col("pb"))).select("conv", "place", "block", "role", "text", "path", "piece")

    def digest(batches):
        """Rows in order, of one conversation after another: the digest of the repaired text."""
        import pyarrow as pa

        def lines(state, piece, row):
            """What stands before and for the next row of a piece, the state and the rest."""
            at = next(i for i, c in enumerate(piece) if c != "I") + 1
            end = at if any(c != "I" for c in piece[at:]) else len(piece)
            out = list(repaired([row], piece[:end], state))
            for c in piece[:end]:
                state = state if c == "D" else row[0][0] if c == "K" else FOLLOWS[state][-1]
            return out, state, piece[end:]

        now, conv_type = None, pa.int64()
        close = lambda: pa.RecordBatch.from_pydict({"conv": pa.array([now[0]], conv_type), "repaired_sha256": [now[1].hexdigest()]})
        for batch in batches:
            conv_type = batch.column(0).type
            for conv, block, role, text, path, piece in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6)), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        yield close()
                    now = [conv, hashlib.sha256(), None, "", "", True]
                if now[2] != block:
                    now[2], now[3], now[4] = block, path[0], piece
                made, now[3], now[4] = lines(now[3], now[4], (role, text))
                for line in made:
                    now[1].update(line.encode() if now[5] else b"\n" + line.encode())
                    now[5] = False
        if now is not None:
            yield close()

    digests = with_steps.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(digest, f"conv {kind}, repaired_sha256 string")
    heads = ways.where("block = 0").select(F.col("conv").alias("h"), "figures")
    out = heads.join(gaps, F.col("h").eqNullSafe(F.col("g"))).join(audits, F.col("h").eqNullSafe(F.col("pc"))).join(digests, F.col("h").eqNullSafe(F.col("conv")))
    named = [F.col("figures")[i].alias(f) for i, f in enumerate(FIGURES[1:])]
    return out.select("conv", "gaps", *named, "audit", "repaired_sha256")
