"""Personal data by anchor expansion.

An Aho-Corasick automaton passes over each text once and reports anchors: at-signs, plus signs,
digits, schemes (``://``) and identifier cues (``iban``, ``token`` ...). From each anchor a
deterministic local parser expands to the left and right and validates what it found. The four
base kinds follow fixed grammars and give the leftmost, non-overlapping matches of those
grammars; the method adds kinds of its own, each with a validator:

``url``      a link whose authority carries a user name (``scheme://user:password@host``)
``iban``     an account number that passes the mod-97 test, with or without a cue
``account``  what a cue (``account``, ``acct``, ``ssn``, ``passport``, ``iban`` ...) introduces
             after ``:``, ``=``, ``#`` or ``no``: an identifier of 6 characters or more, 4 of
             them digits
``secret``   what ``token``, ``secret``, ``password``, ``api_key`` ... introduce after ``:`` or
             ``=``: 8 characters or more, quoted or with a digit, up to its very end

Cues count in any case. Spans are in code points, end exclusive; all parsers are linear in the
text, however long it or one value is. Nulls count as empty texts (no spans); repeated rows are
handled each; an empty table gives an empty one; spans of different kinds may overlap (ties are
settled by the earlier start, then the longer span, when a text is redacted). Other columns aren't
touched, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import pieces, strings

KINDS = ("email", "ip", "card", "phone", "url", "iban", "account", "secret")
BASE = KINDS[:4]
ACCOUNT_CUES = ("account", "acct", "ssn", "passport", "iban", "konto", "cuenta", "compte")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "access_key")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_RUN = re.compile(r"[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AUTHORITY = re.compile(r"://[^\s/?#@<>\"']++@[A-Za-z0-9.-]+(?::[0-9]{1,5})?[^\s<>\"']*")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"(?:[ _-]?(?:no|nr|number|id))?[ .]{0,2}[:=#][ ]{0,2}\"?([A-Za-z0-9]++(?:[ -]?[0-9]++)*+)")
_ASSIGNED = re.compile(r"[ ]{0,2}[:=][ ]{0,2}")
_QUOTED = {'"': re.compile(r"\"([^\s\"]{8,}+)\""), "'": re.compile(r"'([^\s']{8,}+)'")}
_BARE = re.compile(r"[A-Za-z0-9_+/=.-]++")
#: Characters of an account number by country; others are taken as far as the format reaches.
_IBAN_LENGTHS = dict(
    AD=24, AE=23, AT=20, BE=16, BG=22, BR=29, CH=21, CY=28, CZ=24, DE=22, DK=18, EE=20, ES=24, FI=18, FR=27, GB=22, GR=27, HR=21,
    HU=28, IE=22, IL=23, IS=26, IT=27, LI=21, LT=20, LU=20, LV=21, MC=27, MT=31, NL=18, NO=15, PL=28, PT=25, RO=24, SE=24, SI=19, SK=24, TR=26,
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _mod97(text: str) -> bool:
    text = text.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _iban(text: str, at: int) -> tuple[int, int] | None:
    """The account number that begins here, as long as its country's are, if it passes the test."""
    m = _IBAN.match(text, at)
    if m is None:
        return None
    end, want = m.end(), _IBAN_LENGTHS.get(text[at : at + 2])
    if want is not None:
        count = 0
        for end in range(at + 1, m.end() + 1):
            count += text[end - 1] != " "
            if count == want:
                break
        if count < want or text[end : end + 1].isalnum():
            return None
    return (at, end) if _mod97(text[at:end]) else None


def _lowered(text: str) -> str:
    """In lower case, every character at its place: a letter whose lower case is longer stays."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


@lru_cache(maxsize=1)
def automaton():
    """Anchors in lower case, each with the parser that it starts."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for word, what in [("@", "@"), ("+", "+"), ("://", "/"), *((d, "9") for d in "0123456789")]:
        machine.add_word(word, (what, len(word)))
    for cues, what in ((ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
        for cue in cues:
            machine.add_word(cue, (what, len(cue)))
    machine.make_automaton()
    return machine


def find(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of every kind in one text, by start."""
    out: dict[str, list[tuple[int, int]]] = {}
    email_end = ip_end = card_end = url_end = secret_end = account_end = iban_end = 0
    for last, (what, width) in automaton().iter(_lowered(text)):
        at = last - width + 1
        if what == "9":
            if at > iban_end + 1 and "A" <= text[at - 1] <= "Z" and "A" <= text[at - 2] <= "Z" and (at == 2 or not text[at - 3].isalnum()):
                span = _iban(text, at - 2)
                if span:
                    iban_end = span[1]
                    out.setdefault("iban", []).append(span)
            if at >= card_end:
                m = _CARD.match(text, at)
                card_end = m.end() if m else at + 1
                if m:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out.setdefault("card", []).append(m.span())
            if at >= ip_end:
                m = _IP.match(text, at)
                ip_end = m.end() if m else _RUN.match(text, at).end()
                if m and all(map(_small, m.group().split("."))):
                    out.setdefault("ip", []).append(m.span())
        elif what == "@":
            m = _DOMAIN.match(text, at) if at > email_end else None
            if m:
                start = at
                while start > email_end and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    email_end = m.end()
                    out.setdefault("email", []).append((start, email_end))
        elif what == "+":
            m = _PHONE.match(text, at)
            if m and 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.setdefault("phone", []).append(m.span())
        elif what == "/":
            m = _AUTHORITY.match(text, at) if at >= url_end else None
            if m:
                start = at
                while start > url_end and text[start - 1] in _SCHEME:
                    start -= 1
                while start < at and not text[start].isalpha():
                    start += 1
                if start < at:
                    url_end = m.end()
                    out.setdefault("url", []).append((start, url_end))
        elif what == "account":
            m = _ACCOUNT.match(text, last + 1)
            if m and m.start(1) >= account_end and _iban(text, m.start(1)) is None:  # a valid one is found by its digits
                if len(m.group(1)) >= 6 and sum(c.isdigit() for c in m.group(1)) >= 4:
                    account_end = m.end(1)
                    out.setdefault("account", []).append(m.span(1))
        else:
            m = _ASSIGNED.match(text, last + 1)
            if m is None or m.end() < secret_end:  # inside a value that was looked at
                continue
            begin = m.end()
            quoted = _QUOTED.get(text[begin : begin + 1])
            value = quoted.match(text, begin) if quoted else _BARE.match(text, begin)
            if value is None:
                continue
            secret_end = value.end()
            a, b = value.span(1 if quoted else 0)
            if b - a >= 8 and (quoted or any(c.isdigit() for c in value.group())):
                out.setdefault("secret", []).append((a, b))
    return out


def joined(spans: dict[str, list[tuple[int, int]]], kinds=KINDS) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans.get(k, ()))


def redact(text: str) -> str:
    """The text with each span (overlapping ones as one, named by the first) replaced by ``<KIND>``."""
    spans = sorted((a, -b, k) for k, found in find(text).items() for a, b in found)
    if not spans:
        return text
    parts, at, group = [], 0, None
    for a, b, kind in [*spans, (len(text) + 1, 0, "")]:
        if group and a < group[1]:
            group[1] = max(group[1], -b)
            continue
        if group:
            parts += [text[at : group[0]], f"<{group[2].upper()}>"]
            at = group[1]
        group = [a, -b, kind]
    return "".join([*parts, text[at:]])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest and spans for every row; one map over the table, no shuffle."""
    none = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1024, text=1):
            counts: list[list[int]] = [[], [], [], []]
            digests, spans = [], []
            for text in strings(batch.column(1)):
                found = find(text)
                for at, kind in enumerate(BASE):
                    counts[at].append(len(found.get(kind, ())))
                base = joined(found, BASE) if found else ""
                digests.append(hashlib.sha256(base.encode()).hexdigest() if base else none)
                spans.append(joined(found) if found else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    )


def redact_pii(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The same table with personal data replaced in ``text_col``; ``size_col``, where there is one, follows.

    A null text stays null. All columns are kept, whatever their names.
    """
    names = docs.columns
    where = names.index(text_col)
    size = names.index(size_col) if size_col in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1024, text=where):
            columns = list(batch.columns)
            texts = [None if t is None else redact(t) for t in columns[where].to_pylist()]
            columns[where] = pa.array(texts, pa.string())
            if size >= 0:
                columns[size] = pc.utf8_length(columns[where]).cast(batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
