"""Personal data: regular expressions propose spans, checksums confirm them,
context words nearby adjust their scores.

Base kinds (contract): email, ip (parts <= 255), card (16 to 19 digits,
Luhn), phone (8 to 15 digits). They stay whatever their score. The method
adds iban (ISO 13616 lengths are not needed: mod-97 confirms) and the weak
shapes ssn (3-2-4 digits) and dial (a local number of 3-3-4 digits), which
need a context word near them to reach ``KEEP``.

Every pattern is searched in time linear in the text: emails start from
their "@", numbers from the start of their digit run.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "dial")
KEEP = 0.5
NEAR = 40  # code points on either side that are searched for context words

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit run that fails from its start fails from within, so only starts are tried
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
# kind: score by shape and checksum alone, score with a context word near it
_SCORES = {
    "email": (0.9, 1.0), "ip": (0.6, 0.9), "card": (0.8, 1.0), "phone": (0.6, 0.95),
    "iban": (0.85, 1.0), "ssn": (0.35, 0.85), "dial": (0.3, 0.7),
}
_CONTEXT = {k: re.compile(rf"\b(?:{w})\b", re.I) for k, w in {
    "email": "e-?mail|mail|contact|write", "ip": "ip|host|server|address|login", "card": "card|visa|mastercard|credit|payment",
    "phone": "phone|tel|call|mobile|fax", "iban": "iban|bank|account|transfer", "ssn": "ssn|social security|tax id",
    "dial": "phone|tel|call|mobile|fax",
}.items()}


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064: country and check digits moved to the end, letters as 10 to 35."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _shapes(text: str) -> Iterator[tuple[str, int, int]]:
    for a, b in _emails(text):
        yield "email", a, b
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield "iban", m.start(), m.end()
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", m.start(), m.end()
    for m in _DIAL.finditer(text):
        yield "dial", m.start(), m.end()


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of a whole text: by kind, then start; code points, end exclusive. None: empty."""
    out = []
    for kind, a, b in _shapes(text or ""):
        near = text[max(0, a - NEAR) : a] + " " + text[b : b + NEAR]
        score = _SCORES[kind][bool(_CONTEXT[kind].search(near))]
        if kind in BASE or score >= KEEP:
            out.append((kind, a, b, score))
    # an added span that overlaps a base span tells nothing new
    taken: list[list[int]] = []  # the base spans, merged, in order
    for a, b in sorted((a, b) for k, a, b, _ in out if k in BASE):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    ends = [b for _, b in taken]

    def overlaps(start: int, end: int) -> bool:
        i = bisect_right(ends, start)  # the first base span that ends after the start
        return i < len(taken) and taken[i][0] < end

    return [s for s in out if s[0] in BASE or not overlaps(s[1], s[2])]


def joined(spans, kinds=None) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans if kinds is None or k in kinds)


def masked(text: str, spans) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, end = [], 0
    merged: list[list] = []
    for k, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([k, a, b])
    for k, a, b in merged:
        out += [text[end:a], f"[{k.upper()}]"]
        end = b
    return "".join([*out, text[end:]])


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): one row for each row of docs, found an array of
    (kind, start, end, score). NULL and empty texts have none; a NULL doc_id
    stays NULL; other columns are not read."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            found = [[{"kind": k, "start": x, "end": y, "score": s} for k, x, y, s in find(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["doc_id", "found"])

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, f"doc_id long, found {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_personal_data``: counts, the hash of the base spans, all spans."""
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE),
        F.sha2(F.concat_ws(",", F.transform(base, name)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("found", name)).alias("spans"),
    )


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span in the text replaced by its kind, and n_chars (if
    there is one) set to the new length; other columns and NULL texts unchanged."""
    t = docs.columns.index(text_col)
    n = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for b in batches:
            new = [x and masked(x, find(x)) for x in b.column(t).to_pylist()]
            arrays = list(b.columns)
            arrays[t] = pa.array(new, b.schema.field(t).type)
            if n is not None:
                arrays[n] = pa.array([None if x is None else len(x) for x in new], b.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=b.schema)

    return arrow_map(docs, run, docs.schema)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
