"""Line edit scripts of pairs of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _middle(a: list[int], b: list[int]) -> tuple[int, int, int, int]:
    """Start and end, in both sequences, of a run of equal items in the middle of a shortest
    edit script: searches from both ends meet there, and hold a number for each diagonal only."""
    n, m = len(a), len(b)
    delta, ahead, back = n - m, {1: 0}, {1: 0}
    for d in range((n + m + 1) // 2 + 1):
        for own, other, forward in ((ahead, back, True), (back, ahead, False)):
            for k in range(-d, d + 1, 2):
                x = own[k + 1] if k == -d or (k != d and own[k - 1] < own[k + 1]) else own[k - 1] + 1
                first = x
                while x < n and x - k < m and (a[x] == b[x - k] if forward else a[n - 1 - x] == b[m - 1 - x + k]):
                    x += 1
                own[k] = x
                reach = d - 1 if forward else d
                if delta % 2 == forward and abs(delta - k) <= reach and x + other[delta - k] >= n:
                    return (first, first - k, x, x - k) if forward else (n - x, m - x + k, n - first, m - first + k)
    raise AssertionError("the searches meet")


def edits(left: list, right: list) -> tuple[list[int], list[int]]:
    """Places of ``left`` that go and of ``right`` that come, in a shortest edit script."""
    numbers: dict = {}
    a, b = ([numbers.setdefault(x, len(numbers)) for x in side] for side in (left, right))
    gone, come, todo = [], [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, p, q = todo.pop()
        while i < j and p < q and a[i] == b[p]:
            i, p = i + 1, p + 1
        while i < j and p < q and a[j - 1] == b[q - 1]:
            j, q = j - 1, q - 1
        if i == j or p == q:
            gone += range(i, j)
            come += range(p, q)
            continue
        x, y, u, v = _middle(a[i:j], b[p:q])
        todo += [(i, i + x, p, p + y), (i + u, j, p + v, q)]
    return sorted(gone), sorted(come)


def diff_lines(pairs: DataFrame, keys: list[str], left: str = "left", right: str = "right") -> DataFrame:
    """``(keys, seq, side, line_no, line)``: the lines that go (``<``) and come (``>``) to make
    the text ``right`` of ``left``, in order, lines that go first; numbers count from 0 in the
    line's own text.  The script is a shortest one.

    Texts without a difference have no rows; a null or empty text has no lines, and a line end
    at the end of a text begins none.  A pair of texts must fit a task, as a row does; the
    search takes time by lines and differences, and memory by lines.  Repeated pairs stay."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select(*keys).schema)

    def lines(text):
        return (text.removesuffix("\n").split("\n")) if text else []

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at, out = [], []
            for row, (x, y) in enumerate(zip(batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist(), strict=True)):
                x, y = lines(x), lines(y)
                gone, come = edits(x, y)
                # a line that comes stands behind as many kept lines as one that goes
                rows = sorted([(n - k, 0, n, "<", x[n]) for k, n in enumerate(gone)] + [(n - k, 1, n, ">", y[n]) for k, n in enumerate(come)])
                out += [(seq, side, n, line) for seq, (_, _, n, side, line) in enumerate(rows)]
                at += [row] * len(rows)
            seq, side, number, line = zip(*out, strict=True) if out else ((), (), (), ())
            kept = [batch.column(i).take(pa.array(at, pa.int64())) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(seq, pa.int64()), pa.array(side, pa.string()), pa.array(number, pa.int64()), pa.array(line, pa.string())], [*keys, "seq", "side", "line_no", "line"])

    return pairs.select(*keys, left, right).mapInArrow(run, f"{schema}, seq long, side string, line_no long, line string")
