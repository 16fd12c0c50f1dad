"""Base rules for personal data: e-mail addresses, IP addresses, card and phone numbers.

Each rule finds leftmost non-overlapping matches of its pattern; matches that
fail the rule's test are dropped without another try.  All searches take time
in proportion to the text: where a plain search would start anew inside a run
that cannot match, the rule starts at the run's one possible place.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]  # start, end, kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def digits(s: str) -> str:
    return _NOT_DIGIT.sub("", s)


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def small_parts(ip: str) -> bool:
    """Every part is at most 255; zeros in front do not count."""
    return all(len(p := part.lstrip("0")) < 3 or len(p) == 3 and int(p) <= 255 for part in ip.split("."))


def emails(text: str) -> list[Span]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            last = m.end()
        else:
            last = at  # what follows may not reach back over this sign
        at = text.find("@", max(at + 1, last))
    return out


def ips(text: str) -> list[Span]:
    return [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if small_parts(m.group())]


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), m.end(), "card"))
    return out


def phones(text: str) -> list[Span]:
    found = ((m.start(), m.end(), "phone") for m in _PHONE.finditer(text))
    return [s for s in found if 10 <= len(digits(text[s[0] : s[1]])) <= 15]


_ANY = re.compile(r"[0-9@]")


def base_spans(text: str) -> list[Span]:
    """All base spans, by start and then in the order of KINDS."""
    first = _ANY.search(text)
    if not first:
        return []
    out = emails(text) if "@" in text else []
    out += ips(text) + cards(text)
    if "+" in text:
        out += phones(text)
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
