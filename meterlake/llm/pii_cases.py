"""Labelled cases for the candidates of ``pii``: texts that hold one span each,
made from rules. A case is personal data of its kind, or of no kind at all and
only looks alike. What it is follows from the rule that made it."""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass

# Cases of one format, each with other values and other words around it.
CASES = 24


@dataclass(frozen=True)
class Case:
    number: int  # of its format
    kind: str | None  # None: not personal data
    text: str
    start: int
    end: int


_USERS = ["ann", "bob", "carla", "d.miller", "eve_k", "jo", "info", "sales.desk", "x42", "maria-l"]
_HOSTS = ["mail", "example", "uni", "post-box", "site7", "acme", "a.co", "host"]
_DOMAINS = ["com", "org", "net", "edu", "de", "io", "fr", "uk"]
_PLAIN = ["", "see ", "and then ", "(", "we saw ", "of the ", '="', "the answer: "]
_AFTER = ["", " or so", ". Then", ", and", "!", '"', ") too"]
_CALL = ["call ", "tel: ", "Phone ", "mobile no. ", "fax ", "reach me on ", "text me at ", "dial "]
_MAIL = ["mail: ", "write to ", "contact ", "reach me: ", "mail me at "]
_ORDER = ["order ", "invoice no. ", "ref ", "ticket ", "part number ", "serial ", "tracking ", "SKU ", "id: ", "isbn ", "batch "]
_VERSION = ["version ", "release ", "v", "section ", "chapter ", "build ", "page ", "article "]
_PAY = ["card ", "visa: ", "card number ", "account ", "Mastercard "]
_NET = ["ip ", "host ", "server ", "address: ", "from "]
_LIST = ["numbers ", "table ", "scores ", "sum ", "total ", "", "we saw "]


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _email(r: random.Random, at: str, dot: str) -> str:
    return f"{r.choice(_USERS)}{at}{r.choice(_HOSTS).replace('.', dot)}{dot}{r.choice(_DOMAINS)}"


def _ip(r: random.Random, dot: str, top: int = 255) -> str:
    return dot.join(str(r.randrange(1, top + 1)) for _ in range(4))


def _card(r: random.Random, cut: str, good: bool = True) -> str:
    d = r.choice(["4", "51", "55", "6011"])
    d += _digits(r, 15 - len(d))
    odd = sum(int(x) if i % 2 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(d))
    check = -odd % 10 if good else (-odd + 1 + r.randrange(8)) % 10
    d += str(check)
    return cut.join(d[i:i + 4] for i in range(0, 16, 4))


def _pattern(r: random.Random, shape: str) -> str:
    """``#`` is any digit, ``%`` one that is not zero."""
    return "".join(r.choice("0123456789") if c == "#" else r.choice("123456789") if c == "%" else c for c in shape)


def _formats() -> list[tuple[str | None, Callable[[random.Random], str], list[str], list[str]]]:
    """(kind or None, maker, what stands before, what stands after)."""
    out: list = []
    for at, dot in ((" (at) ", " (dot) "), ("[at]", "[dot]"), ("{at}", "{dot}"), (" AT ", " DOT "), (" at ", " dot "), (" @ ", " . "),
                    ("@", "[.]"), (" (at) ", "."), ("(AT)", "(DOT)"), (" [at] ", " [dot] "), (" @ ", "."), ("@", " . ")):
        out.append(("email", lambda r, a=at, d=dot: _email(r, a, d), _MAIL + _PLAIN, _AFTER))
    out.append(("email", lambda r: f"{r.choice('abcxyz')} @ {r.choice('bcde')} . {r.choice('cdef')}", _MAIL + _PLAIN, _AFTER))
    for make in (lambda r: f"{r.choice(_USERS)} @ {r.randrange(1, 99)}.{_digits(r, 2)}", lambda r: f"{r.choice(_USERS)} @ home. Thanks",
                 lambda r: f"two @ {r.randrange(1, 9)} . {_digits(r, 2)}", lambda r: f"lunch @ {r.choice(['noon', 'one', 'school'])}. bye"):
        out.append((None, make, _PLAIN, _AFTER))
    for make in (lambda r: f"{r.choice(['arrive', 'look', 'be', 'meet'])} at {r.choice(['noon', 'ten', 'page'])} dot {r.choice(['late', 'five', 'again'])}",
                 lambda r: f"{r.choice(['stay', 'look'])} at {r.choice(['home', 'once'])}.{r.choice(['Then', 'Later', 'After'])}"):
        out.append((None, make, _PLAIN, _AFTER))
    for dot in ("[.]", " . ", "(.)", " dot "):
        out.append(("ip", lambda r, d=dot: _ip(r, d), _NET + _PLAIN, _AFTER))
        out.append((None, lambda r, d=dot: d.join(["%d" % r.randrange(256, 999)] + [str(r.randrange(1, 400)) for _ in range(3)]), _NET + _PLAIN, _AFTER))
        out.append((None, lambda r, d=dot: _ip(r, d, 12), _VERSION, _AFTER))
    for cut in (".", "/", "_", "  "):
        out.append(("card", lambda r, c=cut: _card(r, c), _PAY + _PLAIN, _AFTER))
        out.append((None, lambda r, c=cut: _card(r, c, False), _PAY + _PLAIN, _AFTER))
        out.append((None, lambda r, c=cut: _card(r, c), _ORDER, _AFTER))
        out.append((None, lambda r, c=cut: c.join(_digits(r, 4) for _ in range(3)), _ORDER + _PLAIN, _AFTER))
    for shape in ("00%# %# ######", "00%% %## #######", "(%##) ###-####", "(0%#) #### ####", "%## ### ####", "%##.###.####", "%##-###-####", "0%# ### ####",
                  "0%## #### ###", "0%##/#######", "020 %### ####", "1-%##-###-####"):
        out.append(("phone", lambda r, s=shape: _pattern(r, s), _CALL * 2 + _PLAIN, _AFTER))
    for shape in ("%### #### ####", "%## ### ####", "%##-###-####", "%#####-###", "0%# ### ####", "%##.###.####", "%###-####-####", "0%##/#######"):
        out.append((None, lambda r, s=shape: _pattern(r, s), _ORDER, _AFTER))
    out.append((None, lambda r: _pattern(r, "%### #### ####"), _PLAIN, _AFTER))
    for shape in ("%#.##.###.##", "%.##.###", "%#.%#.%##.%#", "%.%.%%%%"):
        out.append((None, lambda r, s=shape: _pattern(r, s), _VERSION + _PLAIN, _AFTER))
    for shape in ("%## ### ###", "%#.###.###", "%.###.###.###", "%# ### ###", "%## ###"):
        out.append((None, lambda r, s=shape: _pattern(r, s), _PLAIN, _AFTER + [" EUR", " people", "%", " km"]))
    for n, cut in ((6, " "), (5, " "), (4, "-"), (7, "/"), (6, ", ")):
        out.append((None, lambda r, n=n, c=cut: c.join(_pattern(r, "%#") for _ in range(n)), _LIST, _AFTER))
    for make in (lambda r: f"{r.choice(['19', '20'])}{_digits(r, 2)}-0{r.randrange(1, 10)}-{r.randrange(10, 29)}",
                 lambda r: f"{r.randrange(10, 29)}.0{r.randrange(1, 10)}.20{_digits(r, 2)}", lambda r: f"{r.randrange(1, 29)}/{r.randrange(1, 13)}/19{_digits(r, 2)}"):
        out.append((None, make, _PLAIN, _AFTER))
    out.append((None, lambda r: _pattern(r, "%##-##-####"), ["ssn ", "SSN: ", "id ", ""] + _PLAIN, _AFTER))
    out.append((None, lambda r: f"{_pattern(r, '%#%#')}-{_pattern(r, '%#%#')}", _PLAIN + _LIST, _AFTER))
    out.append((None, lambda r: f"97{r.choice('89')}-{_pattern(r, '%-####-####-#')}", ["isbn ", "ISBN: "], _AFTER))
    return out


def make(cases: int = CASES, seed: int = 11) -> list[Case]:
    r, out = random.Random(seed), []
    for kind, maker, befores, afters in _formats():
        for i in range(cases):
            before, span, after = r.choice(befores), maker(r), r.choice(afters)
            out.append(Case(i, kind, before + span + after, len(before), len(before) + len(span)))
    return out
