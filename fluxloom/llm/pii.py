"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs and
digits, schemes of web addresses, and words that announce an identifier. At
each anchor a parser of its kind expands to the boundaries and validates.
"""

from __future__ import annotations

import re

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Order of the kinds in results. The last two are found beside the base ones.
KINDS = ("email", "ip", "card", "phone", "url", "account")

SCHEMES = ("http://", "https://", "ftp://", "sftp://")
CUES = ("token", "api_key", "api-key", "apikey", "api key", "secret", "password", "passwd", "iban", "account", "acct", "ssn", "passport", "customer id", "customer_id")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
RUN = re.compile(r"[0-9]+")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ADDRESS = re.compile(r"(?:[^\s/@<>\"'|]+@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?(?:[/?#][^\s<>\"'|]*)?")
#: What may stand between a cue and its value.
GAP = re.compile(r"(?:\s+(?:number|no\.?|id))?\s*[:=#]?\s*[\"']?")
#: A value in one piece, to its true end: letters and digits, and what joins them in web tokens, keys and base64.
TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_./+=-]{5,}")
#: An account number written in groups.
GROUPS = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{1,4}\b)+")
#: Fixed value: letters and digits an IBAN has at most.
LONGEST_IBAN = 34
NOT_DIGIT = re.compile(r"[^0-9]+")
SPOT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for d in "0123456789":
        found.add_word(d, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for scheme in SCHEMES:
        found.add_word(scheme, ("scheme", len(scheme)))
    for cue in CUES:
        found.add_word(cue, ("cue", len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban(plain: str) -> bool:
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def account(text: str, at: int) -> int:
    """The end of the identifier that starts at ``at``; ``at`` itself if none does.

    An IBAN, in one piece or in groups, by its check digits; any other token
    by holding at least four digits.
    """
    if m := GROUPS.match(text, at):
        # Other words may follow the groups: the longest run of them that checks out counts.
        ends = [i for i, c in enumerate(text[at : min(m.end(), at + 2 * LONGEST_IBAN)] + " ", at) if c == " " and i <= m.end()]
        for end in reversed(ends):
            plain = text[at:end].replace(" ", "")
            if 15 <= len(plain) <= LONGEST_IBAN and iban(plain):
                return end
    if m := TOKEN.match(text, at):
        value = m[0].rstrip("._/+-")
        if re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
            return at + len(value) * iban(value)
        if len(value) > 5 and sum(map(value.count, "0123456789")) >= 4:
            return at + len(value)
    return at


def scan(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """Spans as ``(kind, start, end)``, by kind and start.

    Every parser starts no earlier than the end of its kind's last match, so
    the spans are the leftmost ones that don't overlap within their kind.
    """
    spans: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    email, ip, card, phone, url, owner, run = 0, 0, 0, 0, 0, 0, 0
    # One letter more in lower case would move what follows it; all others keep their place.
    for last, (what, n) in automaton.iter(text.replace("İ", "I").lower()):
        at = last - n + 1
        if what == "digit":
            if at >= run:
                run = RUN.match(text, at).end()
                if at >= ip:
                    if m := IP.match(text, at):
                        ip = m.end()
                        if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m.groups()):
                            spans[1].append(m.span())
                    else:
                        ip = run
                if at >= card:
                    if m := CHAIN.match(text, at):
                        card = m.end()
                        if m.end() - at >= 13:
                            digits = NOT_DIGIT.sub("", m[0])
                            if 13 <= len(digits) <= 19 and luhn(digits):
                                spans[2].append(m.span())
                    else:
                        card = run
        elif what == "at":
            # Left to the last match's end at most: the part before the sign.
            begin = at
            while begin > email and text[begin - 1] in SPOT:
                begin -= 1
            if begin < at and (m := DOMAIN.match(text, at + 1)):
                email = m.end()
                spans[0].append((begin, email))
        elif what == "plus":
            if at >= phone and (m := PHONE.match(text, at)):
                phone = m.end()
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    spans[3].append(m.span())
        elif what == "scheme":
            if at >= url and not (at and text[at - 1].isalnum()) and (m := ADDRESS.match(text, last + 1)):
                url = last + 1 + len(m[0].rstrip(".,;:!?)]}*"))
                spans[4].append((at, url))
        elif at >= owner and not (at and text[at - 1].isalnum()):
            begin = GAP.match(text, last + 1).end()
            if (end := account(text, begin)) > begin:
                owner = end
                spans[5].append((begin, end))
    return [(k, s, e) for k, found in enumerate(spans) for s, e in found]


def find(text: Column) -> Column:
    """Spans of personal data in a text, each as ``kind:start:end`` (``array<string>``).

    Positions are code points, the end exclusive; spans are ordered by kind
    (``KINDS``), then start. Spans of different kinds may overlap. NULL and
    empty texts have none. Whole texts are scanned, in time linear in their
    length.
    """

    @F.pandas_udf("array<string>")
    def spans(texts: pd.Series) -> pd.Series:
        automaton = anchors()
        return pd.Series([[f"{KINDS[k]}:{s}:{e}" for k, s, e in scan(t, automaton)] if t else [] for t in texts], dtype=object)

    return spans(text)


def redact(text: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one. NULL stays NULL."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        automaton = anchors()
        return pd.Series([replace(t, scan(t, automaton)) if t else t for t in texts], dtype=object)

    return cleaned(text)


def replace(text: str, spans: list[tuple[int, int, int]]) -> str:
    parts, end = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= end:
            parts += [text[end:s], f"<{KINDS[k].upper()}>"]
        end = max(end, e)
    return "".join([*parts, text[end:]])
