"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and
identifier cues. At each anchor a small deterministic parser expands to the borders of an
email, a number, an address or an account, and validates it.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import query, slices, table, thrifty

KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = KINDS[:4]
SLICE_BYTES = 2 << 20  # of text that a task redacts at once
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://", "mailto:", "tel:", "sip:")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "ssn", "passport")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9][0-9.\x20-]*")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AUTHORITY = re.compile(r"(?:[^\s/?#@<>\"']+@)[A-Za-z0-9.-]+(?::[0-9]{1,5})?|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])(?::[0-9]{1,5})?")
OPAQUE = re.compile(r"[^\s<>\"',;]*[A-Za-z0-9]")
AFTER_CUE = re.compile(r"(?:\x20?(?:no|nr|number|num)\.?)?\x20?[:#=]?\x20?", re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NUMBER = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])|[A-Z]{0,2}[0-9]{6,18}(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "@+0123456789":
        found.add_word(c, (c if c in "@+" else "digit", 1))
    for kind, needles in (("scheme", SCHEMES), ("cue", CUES)):
        for n in needles:
            for form in {n, n.upper(), n.capitalize()}:
                found.add_word(form, (kind, len(n)))
    found.make_automaton()
    return found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _account(text: str, at: int) -> tuple[int, int] | None:
    start = AFTER_CUE.match(text, at).end()
    m = IBAN.match(text, start)
    if m and iban_valid(m[0]):
        return m.span()
    m = NUMBER.match(text, start)
    return m.span() if m else None


def find(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind. Null and empty texts have none."""
    out: list[tuple[str, int, int]] = []
    mail_end = numbers_end = 0
    text = text or ""
    for last, (what, n) in anchors.iter(text):
        at = last - n + 1
        if what == "@":
            start = at
            while start > mail_end and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                out.append(("email", start, m.end()))
                mail_end = m.end()
        elif what == "digit":
            if at < numbers_end:
                continue
            numbers_end = NUMBERS.match(text, at).end()
            for m in IP.finditer(text, at, numbers_end):
                if all(len(d) <= 3 and int(d or "0") <= 255 for d in (p.lstrip("0") for p in m[0].split("."))):
                    out.append(("ip", *m.span()))
            for m in CARD.finditer(text, at, numbers_end):
                d = _digits(m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append(("card", *m.span()))
        elif what == "+":
            m = PHONE.match(text, at)
            if m and 10 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
        elif at and (text[at - 1].isalnum() or text[at - 1] == "_"):
            continue
        elif what == "scheme":
            rest = OPAQUE if text[last] == ":" else AUTHORITY
            m = rest.match(text, last + 1)
            if m:
                out.append(("address", at, m.end()))
        elif span := _account(text, last + 1):
            out.append(("account", *span))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(out), key=lambda s: (s[1], order[s[0]], s[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    if not spans:
        return text
    parts, done, i = [], 0, 0
    while i < len(spans):
        kind, a, b = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < b:
            i += 1
            b = max(b, spans[i][2])
        parts += [text[done:a], f"<{kind.upper()}>"]
        done, i = b, i + 1
    return "".join(parts) + text[done:]


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) for every row; spans are an array of (kind, start, stop).

    Rows are read one by one: null keys stay, repeated rows repeat their result, other columns
    are ignored.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        anchors = automaton()
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "stop"), s)) for s in find(t, anchors)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(span))], [key, "spans"]
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, spans array<struct<kind string, start long, stop long>>"
    )


def redact(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with personal data in ``text`` replaced, and ``n_chars`` to match."""

    at = docs.columns.index("text")

    def run(batches):
        anchors = automaton()
        for batch in slices(batches, at, SLICE_BYTES):
            texts = [redacted(t, find(t, anchors)) for t in batch.column(at).to_pylist()]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if (n := batch.schema.get_field_index("n_chars")) >= 0:
                old = batch.column(n).to_pylist()
                new = [o if o is None or t is None else len(t) for o, t in zip(old, texts)]
                batch = batch.set_column(n, batch.schema.field(n), pa.array(new, batch.schema.field(n).type))
            yield batch

    return docs.mapInArrow(thrifty(run), docs.schema)


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows: list[dict] = []
            for doc_id, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [(s["kind"], s["start"], s["stop"]) for s in spans]
                base = written([s for s in own if s[0] in BASE])
                rows.append(
                    {"doc_id": doc_id}
                    | {f"n_{k}": sum(s[0] == k for s in own) for k in KINDS}
                    | {"base_sha256": hashlib.sha256(base.encode()).hexdigest(), "spans": written(own)}
                )
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            kinds = [pa.int64()] * (1 + len(KINDS)) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string")
