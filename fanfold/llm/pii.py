"""Personal data in texts: proposed by patterns, confirmed by checksums, scored
by the words around.

Each kind has a pattern that proposes spans and a validator that confirms them:
the Luhn sum for cards, mod-97 for bank accounts (IBAN), number ranges for
addresses.  A confirmed span starts with the score of its kind; a context word of
the kind within ``CONTEXT_CHARS`` before or behind it adds to the score, a word that
speaks against it takes from it; words are English, French, German and Spanish.  The
base kinds never fall below the threshold, so context doesn't remove them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone", "short_card")
THRESHOLD = 0.5
CONTEXT_CHARS = 40
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_ACCOUNT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_WORD = _ACCOUNT | frozenset("abcdefghijklmnopqrstuvwxyz")
#: Characters of an account by country; other countries may have 15 to 34.
IBAN_LENGTHS = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 "
        "GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 "
        "NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.(-])(?:\([0-9]{2,5}\)\x20?)?[0-9]{2,5}[\x20.-][0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,2}(?![0-9])")
_NOT_DIGIT = re.compile("[^0-9]")


_LETTERS = re.compile(r"[^\W\d_]+")
#: What a word near a span adds to its score or takes from it.
STEP = 0.4


@dataclass(frozen=True)
class Context:
    """Start score of a kind, the least that context leaves of it, and the words near a
    span that raise or lower it."""

    score: float
    least: float = 0.0
    near: frozenset[str] = field(default_factory=frozenset)
    against: frozenset[str] = field(default_factory=frozenset)


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


#: Context words, in English, French, German and Spanish.
PHONE_WORDS = _words("phone telephone tel call mobile cell fax téléphone appelez portable telefon anruf handy mobil teléfono llame móvil")
CARD_WORDS = _words("card visa mastercard credit debit carte crédit karte kreditkarte tarjeta crédito débito")
BANK_WORDS = _words("iban account bank transfer compte banque virement konto überweisung cuenta banco transferencia")
SOCIAL_WORDS = _words("ssn social security sécurité sociale sozialversicherung seguridad seguro")
MAIL_WORDS = _words("email mail contact courriel contacter kontakt schreiben correo contacto")
HOST_WORDS = _words("ip host server address serveur adresse rechner servidor dirección")
TRADE_WORDS = _words("order invoice part isbn version serial commande facture pièce série bestellung rechnung teil seriennummer pedido factura pieza versión serie")
PART_WORDS = _words("part isbn serial pièce série teil seriennummer pieza serie")
VERSION_WORDS = _words("version release section chapter chapitre abschnitt kapitel versión sección capítulo")
CONTEXT = {
    "email": Context(0.9, THRESHOLD, MAIL_WORDS),
    "ip": Context(0.7, THRESHOLD, HOST_WORDS, VERSION_WORDS),
    "card": Context(0.8, THRESHOLD, CARD_WORDS, TRADE_WORDS),
    "phone": Context(0.8, THRESHOLD, PHONE_WORDS, TRADE_WORDS),
    "iban": Context(0.7, 0.0, BANK_WORDS, PART_WORDS),
    "ssn": Context(0.3, 0.0, SOCIAL_WORDS, TRADE_WORDS),
    "local_phone": Context(0.2, 0.0, PHONE_WORDS, TRADE_WORDS),
    "short_card": Context(0.3, 0.0, CARD_WORDS, TRADE_WORDS),
}
#: Kinds that only context words prove, which give way to spans of the other kinds.
WEAK = frozenset(k for k, c in CONTEXT.items() if c.score < THRESHOLD)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod97(account: str) -> bool:
    """The check of an IBAN without spaces: letters count as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str):
    """Leftmost, non-overlapping.  An address starts where the run of local
    characters before its ``@`` starts, so each ``@`` is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def ibans(text: str):
    """Leftmost, non-overlapping.  An account ends at a word's end, where the length of its
    country is reached; for other countries the longest that passes the check counts."""
    done = 0
    for m in _IBAN.finditer(text):
        if m.start() < done:
            continue
        account, at, ends = m[0], m.end(), []
        while len(account) < 34:
            at += text.startswith(" ", at)
            if text[at : at + 1] not in _ACCOUNT:
                break
            account += text[at]
            at += 1
            if len(account) >= 15 and text[at : at + 1] not in _WORD:
                ends.append((len(account), at))
        size = IBAN_LENGTHS.get(m[0][:2])
        for n, end in reversed(ends):
            if size in (None, n) and mod97(account[:n]):
                yield m.start(), end
                done = end
                break


def propose(text: str):
    """(kind, start, end) of all spans that a pattern finds and a validator confirms."""
    if "@" in text:
        for a, b in emails(text):
            yield "email", a, b
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) < 256 for x in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() > 11 and 11 < len(d := _NOT_DIGIT.sub("", m[0])) < 20 and luhn(d):
            yield ("card" if len(d) > 13 else "short_card"), m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for a, b in ibans(text):
        yield "iban", a, b
    for m in _SSN.finditer(text):
        area = m[0][:3]
        if area not in ("000", "666") and area < "900" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", m.start(), m.end()
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= len(_NOT_DIGIT.sub("", m[0])) <= 12:
            yield "local_phone", m.start(), m.end()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Start score of the kind, raised and lowered by whole words shortly before and behind
    the span, between ``least`` and 1."""
    c = CONTEXT[kind]
    low, high = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS)
    while 0 < low < start and text[low - 1].isalpha() and text[low].isalpha():  # a word that the window cuts says nothing
        low += 1
    while end < high < len(text) and text[high].isalpha() and text[high - 1].isalpha():
        high -= 1
    around = {w.lower() for part in (text[low:start], text[end:high]) for w in _LETTERS.findall(part)}
    raised = c.score + STEP * bool(around & c.near) - STEP * bool(around & c.against)
    return round(min(1.0, max(c.least, raised)), 2)


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of the spans of a text that reach THRESHOLD, by
    start, then kind; code points, end exclusive.  Spans of a kind that needs
    context give way to overlapping spans of the kinds before it."""
    out: list[tuple[str, int, int, float]] = []
    taken: list[tuple[int, int]] = []
    text = text or ""
    weak = []
    for kind, a, b in propose(text):
        if kind in WEAK:
            weak.append((kind, a, b))
        elif (s := score(text, kind, a, b)) >= THRESHOLD:
            out.append((kind, a, b, s))
            taken.append((a, b))
    if weak:
        import bisect

        taken.sort()
        starts = [a for a, _ in taken]
        ends = []
        for _, b in taken:
            ends.append(max(b, ends[-1] if ends else 0))
        for kind, a, b in weak:
            i = bisect.bisect_left(starts, b)
            if (i == 0 or ends[i - 1] <= a) and (s := score(text, kind, a, b)) >= THRESHOLD:
                out.append((kind, a, b, s))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, pii)`` per row: the spans of ``find`` as an array of structs.

    A null or empty text has none; repeated rows and null keys stay; an empty table stays
    empty; other columns aren't looked at.  Texts are searched whole, whatever their
    length.  Spans of one place are ordered as KINDS."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        schema = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, schema)], ["key", "pii"])

    return df.select(F.col(id_col).alias("key"), F.col(text_col).alias("t")).mapInArrow(run, f"key {kind}, pii {SPANS}").withColumnRenamed("key", id_col)


def spans_text(spans, kinds=None):
    """``kind:start:end`` of the spans, comma-joined, in their order."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
