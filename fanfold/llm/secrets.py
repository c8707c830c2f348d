"""Secrets in texts, found with built-in expressions, and multipart credentials.

Spans: Spark gives the matches of a pattern and, by splitting at it, what lies
between them; both lists in order give the place of every match.  Three base kinds
stand on their own.  A credential of several parts (an access identifier, a secret,
an endpoint) is linked by an interval join: the parts of a document are dealt to
the scopes of ``SCOPE`` characters that they touch, parts meet in a scope, and two
link when at most ``REACH`` characters lie between them.  A secret that is weak by
itself (a long mixed token of some entropy) is reported only where it links to an
access identifier or an endpoint, and an endpoint only where it links to one of the others.

Web texts are full of urls and of tokens inside them, so neither says much there: an
endpoint is a host with a label of ``SERVICES`` or with a port of its own, and what
stands inside a url is no weak secret.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

#: Base kinds in the order that breaks ties, then the linked kinds.
KINDS = ("assign", "access", "hex", "weak", "endpoint")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
#: The runs of these are maximal, so asking for their least length in the pattern
#: finds what dropping short matches afterwards would leave.
ACCESS, HEX = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}"
#: A url is one match, so that no token is found inside it; it isn't kept.
URL = r"""https?://[^\x20\x09-\x0D"'<>]++"""
WEAK = URL + "|[A-Za-z0-9+/_=-]{20,}"
#: Bits a character that a weak secret has at least.
MIN_ENTROPY = 3.5
#: A run of host characters is tried once, at its start, and never given back: a long run
#: costs neither stack nor squared time.
ENDPOINT = r"https?://[A-Za-z0-9.-]++(?::[0-9]++)?|(?<![a-z0-9.-])[a-z0-9.-]++(?<=[a-z0-9-]\.amazonaws\.com)"
#: Host labels of services that credentials open, digits after them aside.
SERVICES = ("amazonaws", "api", "auth", "blob", "console", "db", "gateway", "iam", "login", "oauth", "queue", "registry", "s3", "sso", "storage", "sts", "token", "vault")
SERVICE = r"(?i)(?<=^|[/.-])(?:" + "|".join(SERVICES) + r")[0-9]*+(?=[.:-]|$)|:[0-9]++$"
SCOPE = REACH = 200
SPAN = "struct<start:int,rank:int,end:int>"
#: Spans gathered before they are set aside: lists never grow one by one for long.
CHUNK = 256
MASK = "[SECRET]"


def spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Array of ``struct<start, rank, end>`` for the matches of a pattern: code points,
    end exclusive, ``rank`` the place of the kind in KINDS; ``keep`` decides by a
    match's text."""
    empty = F.array().cast(f"array<{SPAN}>")

    def placed(found, gaps):
        parts = F.transform(found, lambda x, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(x).alias("n"), (keep(x) if keep else F.lit(True)).alias("keep")))
        zero = F.struct(F.lit(0).alias("at"), empty.alias("chunk"), F.array().cast(f"array<array<{SPAN}>>").alias("chunks"))

        def step(acc, p):
            a = acc["at"] + p["gap"]
            row = F.array(F.struct(a.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (a + p["n"]).alias("end")))
            full = F.size(acc["chunk"]) >= CHUNK
            chunk = F.when(~p["keep"], acc["chunk"]).when(full, row).otherwise(F.concat(acc["chunk"], row))
            chunks = F.when(p["keep"] & full, F.concat(acc["chunks"], F.array(acc["chunk"]))).otherwise(acc["chunks"])
            return F.struct((a + p["n"]).alias("at"), chunk.alias("chunk"), chunks.alias("chunks"))

        return F.aggregate(parts, zero, step, lambda acc: F.flatten(F.concat(acc["chunks"], F.array(acc["chunk"]))))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, empty).otherwise(let(F.split(text, pattern), lambda g: placed(m, g))))


def entropy(text: Column) -> Column:
    """Bits a character of a text that isn't empty."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return -F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda a, c: a + let(share(c), lambda p: p * F.log2(p)))


def text_parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, doc, base, weak, endpoint)``: the spans of each text; ``doc`` is the
    digest of the text.  A null text has none."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), t.alias("t"), F.lower(t).alias("low"))
    empty = F.array().cast(f"array<{SPAN}>")
    t = F.col("t")
    has = lambda *xs: F.lit(False) if not xs else F.contains("low", F.lit(xs[0])) | has(*xs[1:])
    long_value = lambda x: F.length(F.regexp_extract(x, ASSIGN, 1)) >= ASSIGN_VALUE
    mixed = lambda x: ~x.rlike("^https?://") & x.rlike("[0-9]") & x.rlike("[A-Z]") & x.rlike("[a-z]") & (entropy(x) >= MIN_ENTROPY)
    assign = F.when(has("password", "passwd", "secret", "token", "apikey", "api_key"), spans(t, ASSIGN, "assign", long_value)).otherwise(empty)
    access = F.when(F.contains(t, F.lit("AKIA")), spans(t, ACCESS, "access")).otherwise(empty)
    endpoint = F.when(has("://", ".amazonaws.com"), spans(t, ENDPOINT, "endpoint", lambda x: x.rlike(SERVICE))).otherwise(empty)
    base = F.sort_array(F.concat(assign, access, spans(t, HEX, "hex")))
    return rows.select("id", F.xxhash64("t").alias("doc"), base.alias("base"), spans(t, WEAK, "weak", mixed).alias("weak"), endpoint.alias("endpoint"))


def linked_parts(parts: DataFrame) -> DataFrame:
    """``(id, doc, linked)``: the weak secrets and endpoints of each text that link to
    a complementary part, as spans in order; texts without links are left out.  Repeated
    rows are one text here."""
    parts = parts.dropDuplicates(["id", "doc"])
    touches = lambda by: F.explode(F.sequence(F.floor((F.col("s.start") - by) / SCOPE), F.floor((F.col("s.end") + by) / SCOPE)))
    rows = lambda array, by: parts.select("id", "doc", F.explode(array).alias("s")).withColumn("scope", touches(by))
    access = F.filter("base", lambda s: s["rank"] == KINDS.index("access"))
    anchors = rows(F.concat(access, "endpoint"), REACH).toDF("a_id", "a_doc", "a", "a_scope")
    others = rows(F.concat("weak", access), 0).withColumnRenamed("s", "b")
    apart = F.greatest(F.col("a.start") - F.col("b.end"), F.col("b.start") - F.col("a.end"))
    pairs = anchors.join(others, F.col("a_id").eqNullSafe(F.col("id")) & (F.col("a_doc") == F.col("doc")) & (F.col("a_scope") == F.col("scope")))
    pairs = pairs.where((apart >= 0) & (apart <= REACH) & (F.col("a.rank") != F.col("b.rank"))).select("id", "doc", F.explode(F.array("a", "b")).alias("s"))
    weak_kinds = pairs.where(F.col("s.rank") >= KINDS.index("weak"))
    return weak_kinds.groupBy("id", "doc").agg(F.sort_array(F.collect_set("s")).alias("linked"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, doc, base, found)`` per row of ``docs``: the base spans, and with them the
    linked parts that no base span overlaps, both by start, then kind.

    A null or empty text has none; texts of any length are read whole; repeated rows and
    null ids each get their spans; of spans that start together the kind named first
    comes first; further columns are not read; an empty table gives an empty result.
    The text is read once: its spans are stored and the links are made from them."""
    parts = stored(text_parts(docs, id_col, text_col), "parts")
    linked = linked_parts(parts.where("size(endpoint) > 0 OR exists(base, s -> s.rank = 1)")).withColumnsRenamed({"id": "l_id", "doc": "l_doc"})
    met = parts.join(linked, F.col("id").eqNullSafe(F.col("l_id")) & (F.col("doc") == F.col("l_doc")), "left")
    clear = F.filter("linked", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    found = F.when(F.col("linked").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", clear)))
    return met.select(F.col("id").alias(id_col), "doc", "base", found.alias("found"))


def spans_text(array: Column) -> Column:
    """``kind:start:end`` of the spans in order, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(array: Column, kind: str) -> Column:
    return F.size(F.filter(array, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def masked(text: Column, array: Column) -> Column:
    """The text with every run of overlapping spans replaced by MASK."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        new = F.concat(acc["out"], gap, F.lit(MASK))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    return F.aggregate(array, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
