"""Plain Python versions of the operators, one document at a time or all pairs."""

from __future__ import annotations

import hashlib
import re

SECRET_KINDS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


PII_KINDS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
     lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"),
     lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(digits(m[0])) <= 15),
]


def spans(text, kinds):
    """Spans of all kinds by start, then as listed."""
    found = [(m.start(), i, m.end(), name) for i, (name, pattern, passes) in enumerate(kinds)
             for m in pattern.finditer(text or "") if passes(m)]
    return sorted(found)


def joined(found):
    return ",".join(f"{name}:{start}:{end}" for start, _, end, name in found)


def digest(found):
    return hashlib.sha256(joined(found).encode()).hexdigest()
