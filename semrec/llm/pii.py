"""Personal data by anchor expansion.

One Aho-Corasick pass over a text, A-Z read as a-z, finds the anchors: at-signs,
plus signs before a digit, digits (behind a country prefix also of an IBAN),
schemes and identifier cues.  From each anchor a small
deterministic parser walks left and right to the boundaries of an address or
account and validates it (octet range, Luhn, digit counts, mod 97).  No regular
expression runs over a whole text.

Span kinds and offsets (code points, end exclusive):

* base: ``email``, ``ip``, ``card``, ``phone`` - per kind leftmost and non-overlapping; a
  candidate that fails its check is dropped and its characters stay consumed;
* added by the method: ``account`` (an IBAN passing mod 97, after a cue or standing alone
  with its country's length, or the identifier of 6 or more characters with a digit after a
  cue such as ``account`` or ``passport``, with ``number``, ``no.`` and the like between)
  and ``url`` (a web or mail address from its scheme to the next blank or quote).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, text_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "url")
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("iban", "account", "acct", "passport", "ssn", "tax id", "customer id", "member id")
#: Words that may stand between a cue and its identifier.
FILLERS = frozenset(("number", "no", "nr", "is"))
MIN_IDENTIFIER = 6
#: Rows whose texts a task holds as Python strings at once.
ROWS = 256
#: Characters of an IBAN by country (ISO 13616 registry).
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 "
    "DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 "
    "IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 "
    "MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
    "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_ALNUM = _DIGITS | _LETTERS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\n\r\x0b\x0c\"'<>`")
_IDENTIFIER = _ALNUM | frozenset("-")
_LOWER = {c: c + 32 for c in range(65, 91)}

Span = tuple[str, int, int]


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of ``allowed`` characters that starts at ``at``."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def iban_valid(code: str) -> bool:
    if not 15 <= len(code) <= 34 or not (code[:2].isalpha() and code[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Address around the at-sign at ``at``, not reaching left of ``floor``."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    end = _run(text, at + 1, _LABEL)
    if end == at + 1:
        return None
    dots = 0
    while end < len(text) and text[end] == ".":
        label = _run(text, end + 1, _LABEL)
        if label == end + 1:
            break
        end, dots = label, dots + 1
    return (start, end) if dots else None


def ip_at(text: str, start: int) -> tuple[int, bool] | None:
    """(end, valid) of four dotted numbers whose digits begin at ``start``."""
    end = _run(text, start, _DIGITS)
    parts = [text[start:end]]
    for _ in range(3):
        if end >= len(text) or text[end] != ".":
            return None
        stop = _run(text, end + 1, _DIGITS)
        if stop == end + 1:
            return None
        parts.append(text[end + 1:stop])
        end = stop
    return end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def card_at(text: str, start: int) -> tuple[int, bool] | None:
    """(end, valid) of the digits with single blanks or hyphens from ``start``."""
    end, n = start + 1, len(text)
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    if end == start + 1:
        return None
    digits = text[start:end].replace(" ", "").replace("-", "")
    return end, 16 <= len(digits) <= 19 and luhn(digits)


def phone_at(text: str, start: int) -> tuple[int, bool] | None:
    """(end, valid) of an international number from the plus sign at ``start``."""
    end = _run(text, start + 2, _PHONE)
    while end > start + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < start + 4:  # a digit, at least one more character, a digit
        return None
    return end, 8 <= sum([c in _DIGITS for c in text[start:end]]) <= 15


def behind_cue(text: str, cue_end: int) -> int:
    """Where an identifier may begin: behind up to four separators, and again behind each
    of up to three fillers."""
    at = cue_end
    for _ in range(4):
        start = at
        while at < len(text) and at - start < 4 and text[at] in " :#=":
            at += 1
        end = at
        while end < len(text) and end - at < 8 and text[end] in _LETTERS:
            end += 1
        word = text[at:end].lower()
        if at == start or word not in FILLERS or end < len(text) and text[end] in _IDENTIFIER:
            break
        if word in ("no", "nr") and end < len(text) and text[end] == ".":
            end += 1
        if end < len(text) and text[end] not in " :#=" and text[end - 1] != ".":
            break
        at = end
    return at


def account_after(text: str, cue_end: int) -> tuple[int, int] | None:
    """Identifier behind a cue: separators and fillers, then letters, digits, hyphens."""
    if cue_end < len(text) and text[cue_end] in _LETTERS:
        return None
    at = behind_cue(text, cue_end)
    if at == cue_end:
        return None
    end = _run(text, at, _IDENTIFIER)
    while end > at and text[end - 1] == "-":
        end -= 1
    body = text[at:end]
    if len(body) < MIN_IDENTIFIER or not any(c in _DIGITS for c in body):
        return None
    return at, end


def iban_after(text: str, cue_end: int) -> tuple[int, int] | None:
    """IBAN, written together or in blocks of four, behind its cue."""
    at = end = behind_cue(text, cue_end)
    while end < len(text) and end - at < 42 and (
            text[end] in _ALNUM or text[end] == " " and end + 1 < len(text) and text[end + 1] in _ALNUM):
        end += 1
    while end > at:
        if iban_valid(text[at:end].replace(" ", "").upper()):
            return at, end
        end = text.rfind(" ", at, end)
    return None


def iban_at(text: str, start: int) -> tuple[int, int] | None:
    """IBAN whose country prefix is at ``start``: of its country's length, written together
    or in blocks of four, and not part of a longer word."""
    size = IBAN_LENGTHS.get(text[start:start + 2].upper())
    if not size or start and text[start - 1] in _ALNUM:
        return None
    end, blocks = start, text[start + 4:start + 5] in (" ", "-")
    for k in range(size):
        if blocks and k and k % 4 == 0:
            if text[end:end + 1] != text[start + 4]:
                return None
            end += 1
        if end >= len(text) or text[end] not in _ALNUM:
            return None
        end += 1
    if end < len(text) and text[end] in _ALNUM:
        return None
    code = text[start:end].replace(" ", "").replace("-", "").upper()
    return (start, end) if iban_valid(code) else None


def url_at(text: str, start: int, body: int) -> tuple[int, int] | None:
    end = body
    while end < len(text) and text[end] not in _URL_END:
        end += 1
    while end > body and text[end - 1] in ".,;:!?)":
        end -= 1
    return (start, end) if end > body else None


_AUTOMATON = None


def _automaton():
    """Anchors of every kind; built once per worker."""
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        a.add_word("@", ("@", 1))
        a.add_word("+", ("+", 1))
        for d in _DIGITS:
            a.add_word(d, ("0", 1))
        for word, kind in [(s, "url") for s in SCHEMES] + [(c, "cue") for c in CUES]:
            a.add_word(word, ("iban" if word == "iban" else kind, len(word)))
        a.make_automaton()
        _AUTOMATON = a
    return _AUTOMATON


def find_spans(text: str) -> list[Span]:
    """Every span of ``text``, by kind as in ``KINDS``, then by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)  # where the next span of a kind may start
    n, digits_end = len(text), 0
    low = text.lower()
    if len(low) != n:  # a dotted I became two characters; nothing else moves offsets
        low = text.translate(_LOWER)
    for last, (anchor, size) in _automaton().iter(low):
        at = last + 1 - size
        if anchor == "0":
            if at >= free["account"] + 2 and text[at - 1] in _LETTERS and text[at - 2] in _LETTERS:
                got = iban_at(text, at - 2)
                if got:
                    found["account"].append(got)
                    free["account"] = got[1]
            if at >= free["card"]:
                got = card_at(text, at)
                if got:
                    free["card"] = got[0]
                    if got[1]:
                        found["card"].append((at, got[0]))
            if at >= free["ip"] and at >= digits_end:
                # a number that does not open four dotted ones can be skipped as a whole
                got = ip_at(text, at)
                if got:
                    free["ip"] = got[0]
                    if got[1]:
                        found["ip"].append((at, got[0]))
                else:
                    digits_end = _run(text, at, _DIGITS)
        elif anchor == "@":
            got = email_at(text, at, free["email"])
            if got:
                found["email"].append(got)
                free["email"] = got[1]
        elif anchor == "+":
            if at >= free["phone"] and at + 1 < n and text[at + 1] in _DIGITS:
                got = phone_at(text, at)
                if got:
                    free["phone"] = got[0]
                    if got[1]:
                        found["phone"].append((at, got[0]))
        else:
            kind = "url" if anchor == "url" else "account"
            if at < free[kind] or (at and anchor != "url" and text[at - 1] in _LETTERS):
                continue
            if anchor == "url":
                got = url_at(text, at, last + 1)
            else:
                got = (iban_after(text, last + 1) if anchor == "iban" else None) or \
                    account_after(text, last + 1)
            if got:
                found[kind].append(got)
                free[kind] = got[1]
    return [(k, s, e) for k in KINDS for s, e in found[k]]


def _joined(spans: list[Span]) -> str:
    return ",".join([f"{k}:{s}:{e}" for k, s, e in spans])


def redact(text: str, spans: list[Span], mark: str = "[{}]") -> str:
    """``text`` with every span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= done:
            out += [text[done:start], mark.format(kind.upper())]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _mapped(docs: DataFrame, text_col: str, fields: list[T.StructField], row) -> DataFrame:
    """``docs`` with the fields that ``row(text)`` gives appended, in Arrow batches of at most ``ROWS`` rows."""
    names = {f.name for f in fields}
    rest = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*rest, *fields])

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in fields]
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            rows = [row(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), *made],
                names=[f.name for f in schema.fields])

    return (python_ready(docs)
            .select(*[F.col(f"`{f.name}`") for f in rest], F.col(f"`{text_col}`").alias("__text"))
            .mapInArrow(work, schema))


def pii_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text plus ``n_email, n_ip, n_card, n_phone``,
    ``base_sha256`` (of the base spans as ``kind:start:end`` joined by commas) and
    ``spans`` (all of them).  A null or empty text has no spans.  Repeated rows
    stay; input columns with the names of the results are replaced.
    """
    fields = [T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS] + [
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]

    def row(text: str | None) -> tuple:
        spans = find_spans(text or "")
        base = [s for s in spans if s[0] in BASE_KINDS]
        kinds = [s[0] for s in base]
        return (*(kinds.count(k) for k in BASE_KINDS),
                hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))

    return _mapped(docs, text_col, fields, row).drop(text_col)


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in its text replaced by ``[KIND]``.  A null text stays null."""
    field = T.StructField("__redacted", T.StringType())

    def row(text: str | None) -> tuple:
        return (None if text is None else redact(text, find_spans(text)),)

    out = _mapped(docs, text_col, [field], row)
    return out.select(*[F.col("__redacted").alias(c) if c == text_col else F.col(f"`{c}`")
                        for c in docs.columns])
