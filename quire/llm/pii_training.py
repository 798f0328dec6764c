"""Labelled text for the tagger of personal data: spans that patterns verified, and made-up ones in the forms that patterns miss.

Values are made by a seeded generator and set into stretches of the corpus between two words, written plainly or disguised:
spelled-out or spaced marks in addresses, bracketed dots in IP addresses, other separators in card and phone numbers. Numbers and
phrases that only look alike (dates, versions, sums, "at noon") are set in without a label.
"""

from __future__ import annotations

import numpy as np

ENDINGS = ("com", "org", "net", "de", "fr", "es", "io", "co.uk")
SYLLABLES = ("an", "be", "co", "di", "el", "fa", "gu", "ho", "im", "ja", "ko", "lu", "ma", "no", "pe", "ri", "sa", "to", "ve", "wo")


def _word(r: np.random.Generator, least: int = 1, most: int = 4) -> str:
    return "".join(SYLLABLES[k] for k in r.integers(len(SYLLABLES), size=r.integers(least, most + 1)))


def _pick(r: np.random.Generator, options):
    return options[int(r.integers(len(options)))]


def _digits(r: np.random.Generator, n: int) -> str:
    return "".join(map(str, r.integers(0, 10, n)))


def _luhn_digit(digits: str) -> str:
    """The check digit that digits need."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 - k % 2)
        total += n - 9 * (n > 9)
    return str(-total % 10)


def email(r: np.random.Generator, disguised: bool) -> str:
    local = _word(r) + _pick(r, ["", ".", "_"]) + _pick(r, [_word(r), str(r.integers(1000))])
    host, ending = _word(r, 2) + _pick(r, ["", "-mail", "." + _word(r, 1, 2)]), _pick(r, ENDINGS)
    at, dot = _pick(r, [("(at)", "(dot)"), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" at ", " dot "), (" AT ", " DOT "), (" @ ", " . "), ("＠", "."), (" [at] ", ".")]) if disguised else ("@", ".")
    return local + at + host.replace(".", dot) + dot + ending.replace(".", dot)


def ip(r: np.random.Generator, disguised: bool) -> str:
    return (_pick(r, ["[.]", "(.)", " . ", "(dot)", " [.] "]) if disguised else ".").join(str(p) for p in r.integers(0, 256, 4))


def card(r: np.random.Generator, disguised: bool) -> str:
    digits = _pick(r, ["4", "51", "37", "6011"])
    digits += _digits(r, int(_pick(r, [15, 15, 15, 14, 12])) - len(digits))
    digits += _luhn_digit(digits)
    between = _pick(r, [".", "/", "_", "  ", " - ", "\u00a0"] if disguised else ["", " ", "-"])
    return between.join(digits[k : k + 4] for k in range(0, len(digits), 4))


def phone(r: np.random.Generator, disguised: bool) -> str:
    land, area, rest = str(r.integers(1, 99)), _digits(r, int(r.integers(2, 4))), _digits(r, int(r.integers(6, 8)))
    if not disguised:
        return "+" + _pick(r, [" ", "-", ""]).join([land, area, rest[:3], rest[3:]])
    head = _pick(r, ["00" + land + " " + area, "(+" + land + ") " + area, "(0" + area + ")", "0" + area, "+" + land + "/" + area])
    return head + _pick(r, [" ", "/", "-", " - "]) + rest[:3] + _pick(r, [" ", "-", "."]) + rest[3:]


MAKERS = {"email": email, "ip": ip, "card": card, "phone": phone}


def lookalike(r: np.random.Generator) -> str:
    """Something with digits or marks that is no personal data."""
    n = lambda most: str(int(r.integers(1, most)))
    return _pick(
        r,
        [
            f"{n(29)}.{n(13)}.20{_digits(r, 2)}", f"20{_digits(r, 2)}-{n(13)}-{n(29)}", f"{n(24)}:{_digits(r, 2)}", f"v{n(9)}.{n(30)}.{n(9)}", f"{n(999)},{_digits(r, 3)}.{_digits(r, 2)}",
            f"${n(9999)}", f"#{_digits(r, 6)}", f"at {_word(r)}", f"at {n(12)} o'clock", f"@{_word(r)}", f"{_digits(r, 4)}/{_digits(r, 2)}", f"{n(99)}%", f"0x{int(r.integers(1 << 40)):x}",
            f"{int(r.integers(1 << 60)):016x}", f"look at {_word(r)}.{_pick(r, ENDINGS)}", f"(at {_word(r)})", f"{n(99)} - {n(99)}", f"{n(9)}.{n(9)}.{n(9)}.{n(9)}.{n(9)}", f"item {n(9999)}", f"{n(99)} {n(99)} {n(99)}",
        ],
    )


def inserted(text: str, value: str, r: np.random.Generator) -> tuple[str, int]:
    """text with value between two of its words, and its place."""
    gaps = [k for k, c in enumerate(text) if c == " "]
    at = _pick(r, gaps) if gaps else len(text)
    return f"{text[:at]} {value}{_pick(r, [' ', ' ', ', ', '. '])}{text[at:]}", at + 1


def made(texts: list[str], n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """n of texts with one made value each, and its span: two in three disguised, one in four only alike and without a span."""
    r = np.random.default_rng(seed)
    out = []
    for _ in range(n if texts else 0):
        text = _pick(r, texts)
        if r.random() < 0.25:
            out.append((inserted(text, lookalike(r), r)[0], []))
            continue
        kind = _pick(r, list(MAKERS))
        value = MAKERS[kind](r, bool(r.random() < 0.67))
        text, at = inserted(text, value, r)
        out.append((text, [(kind, at, at + len(value))]))
    return out
