"""op13: conversation repair against a plain search over rows and states, whole and in blocks."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from fanfold.llm import conversations, registry

NEXT = {"0": "su", "s": "u", "u": "a", "a": "u"}


def searched(marks):
    """Least ``(cost, audit)`` by a recursion over rows and grammar states."""

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        out = []
        if i == len(marks) and state in "0a":
            out.append((0, ""))
        if inserts < 2:
            for x in NEXT[state]:
                if x != "s":
                    c, a = best(i, x, inserts + 1)
                    out.append((c + 5, "I" + a))
        if i < len(marks):
            letter, must, stay = marks[i]
            c, a = best(i + 1, state, 0)
            out.append((c + 2, "D" + a))
            for x in NEXT[state] if not must else ():
                c, a = best(i + 1, x, 0)
                if letter == x:
                    out.append((c + stay, "K" + a))
                if x != "s":
                    out.append((c + stay + 1, "R" + a))
        return min(out, default=(1 << 40, ""))

    return best(0, "0", 0)


def expected(rows):
    """``{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)}``, row by row."""
    space = " \t\n\x0b\x0c\r"
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if what == 1 else "".join(c for c in text if c not in ".!?") if what == 2 else text
        kept += [(turn, "user" if what == 4 else role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {r[0] for r in kept if r[0] is not None}
        n, seen, marks = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in kept:
            body = text.strip(space)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            marks.append((role[:1], fault in ("blank", "duplicate"), 5 if fault == "truncated" else 0))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, audit = searched(tuple(marks))
        state, lines, left = "0", [], list(kept)
        for step in audit:
            row = None if step == "I" else left.pop(0)
            if step != "D":
                state = row[1][0] if step == "K" else "a" if state == "u" else "u"
                lines.append(f"{row[1] if step == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{row[2] if row else ''}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_alignment_equals_search():
    random.seed(13)
    for _ in range(4000):
        marks = tuple((random.choice("uuuaaas x"), random.random() < 0.2, random.choice((0, 0, 0, 5))) for _ in range(random.randrange(0, 9)))
        marks = tuple((m[0].strip(), m[1], 0 if m[1] else m[2]) for m in marks)
        assert conversations.cheapest(marks) == searched(marks), marks


def test_long_alignment_equals_search():
    random.seed(14)
    marks = tuple(("ua"[i % 2] if random.random() < 0.9 else random.choice("uas"), random.random() < 0.05, 0) for i in range(300))
    assert conversations.cheapest(marks) == searched(marks)


ODD = [
    (None, None, None, None),
    (None, 1, "user", "hi."),
    (1, 0, "user", None),
    (2, 0, "", "x."),
    (2, 1, "user", "y."),
    (2, 1, "user", "y."),
    (2, 1, "assistant", "tie."),
    (3, None, "system", "s."),
    (3, 5, "user", "q?"),
    (3, 9, "assistant", " "),
    (4, 0, "user", "w " * 500_000),
    (5, 0, "usr", "a."),
    (5, 1, "é", "b."),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def of(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


@pytest.mark.parametrize("blocks", [False, True])
def test_odd_rows_equal_search(spark, monkeypatch, tmp_path, blocks):
    if blocks:
        monkeypatch.setattr(conversations, "LONG", 2)
        monkeypatch.setattr(conversations, "BLOCK", 2)
    random.seed(15)
    words = ["a.", "b?", "c", "", "d!", None]
    rows = [*ODD, *((100 + c, t, random.choice(["user", "assistant", "user", "assistant", "system"]), random.choice(words)) for c in range(30) for t in range(random.randrange(1, 12)))]
    df = spark.createDataFrame([(*r, "x", 1, False) for r in rows], SCHEMA + ", conv string, block int, gone boolean")
    df.drop("gone").write.parquet(f"{tmp_path}/conversations.parquet")
    got = of(registry.op13_conversation_repair(spark, str(tmp_path)))
    assert got == expected(rows)
    df.limit(0).drop("gone").write.parquet(f"{tmp_path}/empty/conversations.parquet")
    assert registry.op13_conversation_repair(spark, f"{tmp_path}/empty").collect() == []


@pytest.mark.parametrize("blocks", [False, True])
def test_tables_equal_search(spark, sf_dir, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(conversations, "LONG", 3)
        monkeypatch.setattr(conversations, "BLOCK", 3)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert of(registry.op13_conversation_repair(spark, sf_dir)) == expected(rows)


def test_one_long_conversation_in_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(conversations, "LONG", 100)
    monkeypatch.setattr(conversations, "BLOCK", 16)
    random.seed(16)
    rows = [(7, t, random.choice(["user", "assistant"]) if random.random() < 0.2 else ("user", "assistant")[t % 2], random.choice(["a.", f"{t}?", f"{t}"])) for t in range(250)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert of(registry.op13_conversation_repair(spark, str(tmp_path))) == expected(rows)
