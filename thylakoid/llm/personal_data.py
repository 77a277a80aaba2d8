"""Personal data by anchors: one Aho-Corasick scan, then local parsers around each hit (operator 11)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import carried, map_texts
from thylakoid.llm.decontamination import lowered

#: Kinds in the order in which spans that begin at one place are listed; the first four have a base.
KINDS = ("email", "ip", "card", "phone", "login", "account")
BASE = KINDS[:4]
#: Cues of account numbers, in lower case.
ACCOUNT_CUES = ("iban", "account", "acct", "a/c", "ssn", "passport")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")

# parsers that begin at a place that an anchor gave
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TELEPHONE = re.compile(r"[0-9][().0-9-]+[0-9]")
_LOGIN = re.compile(r"[A-Za-z0-9._%+-]+:[^\s/?#@:]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_NUMBER = re.compile(r"(?:[ \t]*(?i:numbers?\b|no\b\.?|nr\b\.?|#))?[ \t]*[:=]?[ \t]*(?:([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})|([A-Z]{0,2}[0-9](?:[ -]?[0-9]){5,19}))(?![A-Za-z0-9])", re.ASCII)


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban(text: str) -> bool:
    """The check sum of international account numbers."""
    code = text.replace(" ", "").upper()
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def anchors():
    """The automaton over at-signs, digits, plus signs before digits, schemes and cues of accounts."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for d in "0123456789":
        automaton.add_word(d, ("digit", 1))
        automaton.add_word(f"+{d}", ("plus", 2))
    for word in ("@", "://", "tel:", *ACCOUNT_CUES):
        automaton.add_word(word, ({"@": "at", "://": "scheme", "tel:": "tel"}.get(word, "cue"), len(word)))
    automaton.make_automaton()
    return automaton


_automaton = None


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the base and further ones (kind, start, end in code points) of a text.

    Every anchor is a place where a kind's pattern can begin or, for addresses, has its at-sign; the kind's
    parser goes on from there unless an earlier match of the kind has passed it. A match that fails its check is dropped;
    what its parser finds inside by stricter rules comes as a further span.
    """
    global _automaton
    _automaton = _automaton or anchors()
    base, more = [], []
    past = dict.fromkeys((*KINDS, "dotted"), 0)
    for last, (anchor, size) in _automaton.iter(lowered(text)):
        at = last - size + 1
        if anchor == "digit":
            if at >= past["card"] and (m := _DIGITS.match(text, at)):
                past["card"] = m.end()
                digits = _only_digits(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    base.append(("card", at, m.end()))
                elif len(digits) >= 14:
                    more += (("card", at + a, at + b) for a, b in _cards(m.group()))
            if at >= past["dotted"]:
                m = _DOTTED.match(text, at)
                past["dotted"] = m.end()
                base += (("ip", a, b) for a, b in _fours(m.group(), at))
        elif anchor == "at":
            start = at
            while start > past["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                past["email"] = m.end()
                base.append(("email", start, m.end()))
        elif anchor == "plus":
            if m := _PHONE.match(text, at):
                if 10 <= len(_only_digits(m.group())) <= 15:
                    base.append(("phone", at, m.end()))
                elif shorter := _phone(m.group()):
                    more.append(("phone", at, at + shorter))
        elif anchor == "tel":
            m = _TELEPHONE.match(text, last + 1)
            if m and 10 <= len(_only_digits(m.group())) <= 15 and (at == 0 or text[at - 1] not in _LETTERS):
                more.append(("phone", m.start(), m.end()))
        elif anchor == "scheme":
            if last + 1 >= past["login"] and (m := _LOGIN.match(text, last + 1)):
                past["login"] = m.end()
                more.append(("login", m.start(), m.end()))
        elif at >= past["account"] and (at == 0 or text[at - 1] not in _LETTERS) and (m := _NUMBER.match(text, last + 1)):
            start, end = m.span(1 if m.group(1) else 2)
            while m.group(1) and end > start and not iban(text[start:end]):  # words may follow the last group
                end = text.rfind(" ", start, end)
            if end > start:
                past["account"] = end
                more.append(("account", start, end))
    base.sort(key=_order)
    known = set(base)
    return base, sorted({s for s in more if s not in known}, key=_order)


_RANK = {k: i for i, k in enumerate(KINDS)}


def _order(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], _RANK[span[0]], span[2]


def _fours(chain: str, at: int) -> Iterator[tuple[int, int]]:
    """Runs of digits joined by dots, four at a time; those of four parts up to 255."""
    parts = chain.split(".")
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        size = sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
            yield at, at + size
        at += size + 1


def _groups(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer("[0-9]+", text)]


def _cards(chain: str) -> Iterator[tuple[int, int]]:
    """Card numbers among the groups of a longer chain: one group of 14 to 19 digits, or groups of 4-4-4-4 or 4-6-5."""
    groups, i = _groups(chain), 0
    while i < len(groups):
        for shape in ((4, 4, 4, 4), (4, 6, 5), None):
            last = i + (len(shape) if shape else 1) - 1
            sizes = tuple(b - a for a, b in groups[i : last + 1])
            fits = sizes == shape if shape else 14 <= sizes[0] <= 19
            if fits and luhn(_only_digits(chain[groups[i][0] : groups[last][1]])):
                yield groups[i][0], groups[last][1]
                i = last
                break
        i += 1


def _phone(run: str) -> int | None:
    """Where a telephone number ends that goes on with other numbers: the most whole groups of 10 to 15 digits."""
    best, digits = None, 0
    for a, b in _groups(run):
        digits += b - a
        if digits > 15:
            break
        if digits >= 10:
            best = b
    return best


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: bool = True, carry: bool = False) -> DataFrame:
    """Personal data in whole texts.

    Base: addresses of e-mail and of hosts (``ip``), card numbers (Luhn) and telephone numbers, leftmost and
    without overlaps by kind, those that fail their check dropped. Further: telephone and card numbers inside
    dropped matches, where whole groups of digits fit; numbers behind ``tel:``; names with passwords behind a scheme
    (``login``); numbers behind words for accounts (``account``), international ones by their check sum.

    Returns one row per document row: the id column, ``n_email, n_ip, n_card, n_phone`` (of the base), ``base``
    and ``spans`` (all), each ``kind, start, end`` in code points, end exclusive, by start and kind; with ``redact`` the
    text with the spans' letters replaced by their kind in angle brackets (``redacted``, of spans that overlap the one
    that begins first; null for null texts); with ``carry`` the input row as the struct ``row``. Other columns aren't
    read. Null and empty texts hold nothing; null ids and repeated rows stay. Nothing is shuffled.
    """

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in arrow}
        for text in batch.column(1).to_pylist():
            base, more = find(text) if text else ([], [])
            every = sorted(base + more, key=_order)
            for kind in BASE:
                out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
            for name, spans in (("base", base), ("spans", every)):
                out[name].append([dict(zip(("kind", "start", "end"), s)) for s in spans])
            if redact:
                out["redacted"].append(redacted(text, every))
        return {n: pa.array(v, arrow[n]) for n, v in out.items()} | {"id": batch.column(0)} | ({"row": batch.column(2)} if carry else {})

    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carried(docs, carry))
    kinds = dict(whole.dtypes)
    counts = [f"n_{k}" for k in BASE]
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    arrow = dict.fromkeys(counts, pa.int64()) | {"base": spans, "spans": spans} | ({"redacted": pa.string()} if redact else {})
    schema = {"id": kinds["id"], **dict.fromkeys(counts, "long"), **dict.fromkeys(("base", "spans"), "array<struct<kind: string, start: int, end: int>>")}
    schema |= {"redacted": "string"} if redact else {}
    schema |= {"row": kinds["row"]} if carry else {}
    return map_texts(whole, run, schema).withColumnRenamed("id", id_col)


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    if not text:
        return text
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def joined(spans: str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
