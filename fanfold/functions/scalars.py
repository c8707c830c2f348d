"""Scalar, string, math, array and map functions: each returns a Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The characters that clean_text turns into spaces besides controls.
SPECIAL = "\\\"'`"
#: Bytes in a unit of memory text and in a file size unit.
UNITS = {
    "B": 1, "KB": 10**3, "MB": 10**6, "GB": 10**9, "TB": 10**12, "K": 10**3, "M": 10**6, "G": 10**9, "T": 10**12,
    "KIB": 2**10, "MIB": 2**20, "GIB": 2**30, "TIB": 2**40, "KI": 2**10, "MI": 2**20, "GI": 2**30, "TI": 2**40,
}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """``fn`` of ``value``, which is computed once: Catalyst doesn't copy a lambda's argument
    to each place that uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def fail_unless(ok: Column, value: Column, message) -> Column:
    """``value`` where ``ok`` is true, else the query fails with ``message``."""
    message = F.lit(message) if isinstance(message, str) else message
    return F.when(ok, value).otherwise(F.raise_error(message))


def ceil(x) -> Column:
    return F.ceil(col(x)).cast("int")


def floor(x) -> Column:
    return F.floor(col(x)).cast("int")


def round_(x) -> Column:
    """Half away from zero."""
    return F.round(col(x), 0).cast("int")


def divide_int(a, b) -> Column:
    """Quotient of whole numbers, cut towards zero, of their own type."""
    return F.call_function("div", col(a), col(b)).cast("int")


def modulo(a, b) -> Column:
    """Remainder that is never negative for a positive divisor."""
    return F.pmod(col(a), col(b))


def sub(s, pattern: str, replacement: str) -> Column:
    """Replace every match of a regular expression."""
    return F.regexp_replace(col(s), pattern, replacement)


def basename(path, suffix: str | None = None) -> Column:
    """What follows the last slash, without ``suffix`` where it ends so."""
    name = F.regexp_extract(col(path), r"[^/]*$", 0)
    if not suffix:
        return name
    return F.when(name.endswith(suffix), F.left(name, F.length(name) - len(suffix))).otherwise(name)


def folder_of(path) -> Column:
    return F.regexp_extract(col(path), "^(.*)/", 1)


def same_folder(a, b) -> Column:
    return folder_of(a) == folder_of(b)


def select_first(*cols) -> Column:
    """The first value that isn't null; all null is an error."""
    return F.coalesce(*map(col, cols), F.raise_error(F.lit("select_first: every value is null")))


def select_all(arr) -> Column:
    """The array without its nulls."""
    return F.array_compact(col(arr))


def length(arr) -> Column:
    return F.size(col(arr))


def range_(n) -> Column:
    """``[0, n)`` as an array; empty for 0."""
    n = col(n)
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def zip_(a, b) -> Column:
    """Pairs by position; unequal lengths are an error."""
    a, b = col(a), col(b)
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("left"), y.alias("right")))
    return fail_unless(F.size(a) == F.size(b), pairs, "zip: arrays of unequal length")


def flatten(arrays) -> Column:
    """One array of all inner elements; null inner arrays add nothing."""
    return F.flatten(F.array_compact(col(arrays)))


def transpose(matrix) -> Column:
    """Rows and columns swapped; rows of unequal length are an error."""
    m = col(matrix)
    width = F.coalesce(F.size(F.get(m, F.lit(0))), F.lit(0))
    swapped = F.transform(range_(width), lambda i: F.transform(m, lambda row: F.get(row, i)))
    return fail_unless(F.forall(m, lambda row: F.size(row) == width), swapped, "transpose: ragged matrix")


def as_pairs(m) -> Column:
    return F.transform(F.map_entries(col(m)), lambda e: F.struct(e["key"].alias("left"), e["value"].alias("right")))


def non_empty(arr) -> Column:
    return fail_unless(F.size(col(arr)) > 0, col(arr), "non_empty: the array is empty")


def item_at(arr, i) -> Column:
    """Element at a position from 0; out of range is an error."""
    arr, i = col(arr), i if isinstance(i, Column) else F.lit(i)
    return fail_unless((i >= 0) & (i < F.size(arr)), F.get(arr, i), "index out of range")


def concat_text(*parts) -> Column:
    """Texts and numbers joined; null if any is null."""
    return F.concat(*(col(p).cast("string") for p in parts))


def interpolate(template: str, default: str = "", **values) -> Column:
    """``template`` with ``~{name}`` or ``${name}`` filled in; null gives ``default``."""
    import re

    parts, at = [], 0
    for m in re.finditer(r"[~$]\{(\w+)\}", template):
        parts += [F.lit(template[at : m.start()]), F.coalesce(col(values[m[1]]).cast("string"), F.lit(default))]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def join_str(arr, sep: str) -> Column:
    return F.array_join(F.transform(col(arr), lambda x: x.cast("string")), sep)


def split_url(url) -> Column:
    """Struct ``protocol, project, file_id, folder, name`` of ``dx://project:/folder/name``,
    of ``dx://project:id::/folder/name`` and of plain paths; another protocol is an error.
    Fixed value: the protocol's name."""

    def halves(u):
        protocol = F.regexp_extract(u, "^([a-z0-9]+)://", 1)
        known = fail_unless(F.coalesce(protocol.isin("", "dx"), F.lit(True)), protocol, F.concat(F.lit("unknown protocol: "), protocol))
        return F.struct(known.alias("protocol"), F.regexp_replace(u, "^[a-z0-9]+://", "").alias("rest"))

    def places(h):
        rest, remote = h["rest"], h["protocol"] != ""
        split = remote & F.contains(rest, F.lit(":"))
        project = F.when(split, F.split_part(rest, F.lit(":"), F.lit(1)))
        return F.struct(
            F.when(remote, h["protocol"]).otherwise(F.lit("file")).alias("protocol"),
            F.when(project != "", project).alias("project"),
            F.when(split, F.regexp_replace(rest, "^[^:]*:", "")).otherwise(rest).alias("body"),
        )

    def ids(p):
        body = p["body"]
        logical = F.when(F.contains(body, F.lit("::")), F.regexp_replace(body, "^.*?::", "")).when(body.rlike("^file-[A-Za-z0-9]+$"), F.lit(None)).otherwise(body)
        file_id = F.when(body.rlike("^file-[A-Za-z0-9]+($|::)"), F.split_part(body, F.lit("::"), F.lit(1)))
        return F.struct(p["protocol"].alias("protocol"), p["project"].alias("project"), file_id.alias("file_id"), logical.alias("logical"))

    def parts(x):
        folder, name = folder_of(x["logical"]), basename(x["logical"])
        folder = F.when(F.contains(x["logical"], F.lit("/")), let(folder, lambda f: F.when(f == "", F.lit("/")).otherwise(f)))
        name = let(name, lambda n: F.when(n != "", n))
        return F.struct(x["protocol"].alias("protocol"), x["project"].alias("project"), x["file_id"].alias("file_id"), folder.alias("folder"), name.alias("name"))

    return let(let(let(let(col(url), halves), places), ids), parts)


def logical_url(project, file_id, folder, name) -> Column:
    """The url that split_url takes apart again."""
    project, file_id, folder, name = map(col, (project, file_id, folder, name))
    path = F.concat(F.when(folder == "/", F.lit("/")).otherwise(F.concat(folder, F.lit("/"))), name)
    return F.concat(F.lit("dx://"), F.coalesce(project, F.lit("")), F.lit(":"), F.coalesce(F.concat(file_id, F.lit("::")), F.lit("")), path)


def memory_mib(text) -> Column:
    """Memory text (``14 GB``, ``230MiB``, no unit: bytes) in MiB, cut; bad text is an error."""
    t = F.trim(col(text))
    number = F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)?)\s*[A-Za-z]*$", 1)
    unit = F.upper(F.regexp_extract(t, r"^[0-9.]+\s*([A-Za-z]*)$", 1))
    size = reduce(lambda c, kv: c.when(unit == kv[0], F.lit(kv[1])), UNITS.items(), F.when(unit == "", F.lit(1)))
    value = F.floor(number.try_cast("double") * size / 2**20).cast("long")
    return F.when(t.isNull(), F.lit(None).cast("long")).otherwise(fail_unless(value.isNotNull(), value, F.concat(F.lit("bad memory: "), t)))


def disk_gib(text) -> Column:
    """Disk text (``local-disk 1024 HDD``, ``50``) as a whole number."""
    t = F.trim(col(text))
    value = F.regexp_extract(t, r"(?:^|\s)([0-9]+)(?:\s|$)", 1).try_cast("int")
    return F.when(t.isNull(), F.lit(None).cast("int")).otherwise(fail_unless(value.isNotNull(), value, F.concat(F.lit("bad disks: "), t)))


def cpu_count(text) -> Column:
    """Number text, cut to a whole number."""
    t = F.trim(col(text).cast("string"))
    value = t.try_cast("double")
    return F.when(t.isNull(), F.lit(None).cast("int")).otherwise(fail_unless(value.isNotNull(), value.cast("int"), F.concat(F.lit("bad cpu: "), t)))


def duration(text) -> Column:
    """Struct ``days, hours, minutes, total`` (minutes) of ``1D6H30M``; null for bad text."""
    t = col(text)
    part = lambda unit: F.coalesce(F.regexp_extract(t, f"([0-9]+){unit}", 1).try_cast("int"), F.lit(0))
    d, h, m = part("D"), part("H"), part("M")
    ok = t.rlike(r"^(?=.)([0-9]+D)?([0-9]+H)?([0-9]+M)?$")
    return F.when(ok, F.struct(d.alias("days"), h.alias("hours"), m.alias("minutes"), (d * 1440 + h * 60 + m).alias("total")))


def clean_text(s) -> Column:
    """Controls and special characters as spaces."""
    import re

    return F.regexp_replace(col(s), f"[\\x00-\\x1F\\x7F{re.escape(SPECIAL)}]", " ")


def unqualified(name) -> Column:
    return F.substring_index(col(name), ".", -1)


def archive_name(name, created) -> Column:
    """The name and the time of creation, ``EE MMM dd kk:mm:ss yyyy``."""
    return F.concat(col(name), F.lit(" "), F.date_format(col(created), "EEE MMM dd kk:mm:ss yyyy"))


def limited_label(arr, max_len: int) -> Column:
    """``[a, b, ...]`` with as many items as keep the inner text under ``max_len``; the
    first is always there."""
    items = F.transform(col(arr), lambda x: x.cast("string"))
    zero = F.struct(F.lit("").alias("out"), F.lit(True).alias("open"), F.lit(True).alias("first"))

    def step(acc, x):
        longer = F.concat(acc["out"], F.lit(", "), x)
        fits = acc["open"] & (F.length(longer) <= max_len)
        out = F.when(acc["first"], x).when(fits, longer).otherwise(acc["out"])
        return F.struct(out.alias("out"), (acc["first"] | fits).alias("open"), F.lit(False).alias("first"))

    return F.concat(F.lit("["), F.aggregate(items, zero, step, lambda a: a["out"]), F.lit("]"))


def item_label(value, kind: T.DataType) -> Column:
    """Readable text of an item by its type: a primitive's text, the base name of a path, a
    pair as ``(l, r)``, the first three of an array; null for other types."""
    v = col(value)
    if isinstance(kind, T.StringType):
        return F.when(F.contains(v, F.lit("://")) | v.startswith("/"), basename(v)).otherwise(v)
    if isinstance(kind, T.ArrayType):
        return limited_label(F.transform(F.slice(v, 1, 3), lambda x: item_label(x, kind.elementType)), 40)
    if isinstance(kind, T.StructType):
        if kind.names != ["left", "right"]:
            return F.lit(None).cast("string")
        return F.concat(F.lit("("), item_label(v["left"], kind["left"].dataType), F.lit(", "), item_label(v["right"], kind["right"].dataType), F.lit(")"))
    if isinstance(kind, T.MapType):
        return F.lit(None).cast("string")
    return v.cast("string")


def row_digest(*names: str) -> Column:
    """Upper-case MD5 of the row's canonical JSON: columns, fields of structs and keys of maps
    in the order of their names at every depth, arrays as they are, nulls kept.  A variant
    keeps its objects' keys sorted, so the way through one sorts them."""
    written = F.to_json(F.struct(*sorted(names)), {"ignoreNullFields": "false"})
    return F.upper(F.md5(F.to_json(F.parse_json(written)).cast("binary")))
