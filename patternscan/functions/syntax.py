"""Rule text -> regular expressions that Spark's built-ins can run.

A rule is parsed once with the parser behind Python's own ``re`` and written
out again with every flag spelled out (``.``, ``^``, ``$`` and ``\\b`` become
explicit classes and assertions), so the same text means the same thing to the
JVM and to Python.  The tree is also written *backwards*: an end of the rule in
a text is a start of the reversed rule in the reversed text, and starts can be
found for any rule, bounded or not, in one pass with a look-ahead.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

try:
    from re import _constants as C
    from re import _parser
except ImportError:  # before Python 3.11
    import sre_constants as C
    import sre_parse as _parser

# Flag letters, their bits, and the deprecated spellings.
FLAG_BITS = {
    "i": 1,
    "s": 2,
    "m": 4,
    "H": 8,
    "V": 16,
    "8": 32,
    "W": 64,
    "P": 128,
    "L": 256,
    "C": 512,
    "Q": 1024,
}
DEPRECATED_FLAGS = {"o": "H", "e": "V", "u": "8", "p": "W", "f": "P", "l": "L"}
LEFTMOST_FLAGS = "imsH8W"

POSIX_CLASSES = {
    "alpha": "a-zA-Z",
    "digit": "0-9",
    "alnum": "a-zA-Z0-9",
    "upper": "A-Z",
    "lower": "a-z",
    "space": r"\s",
    "blank": r" \t",
    "punct": r"!-/:-@\[-`{-~",
    "xdigit": "0-9A-Fa-f",
    "word": r"\w",
    "cntrl": r"\x00-\x1f\x7f",
    "print": " -~",
    "graph": "!-~",
}

ALL_ENDS, LEFTMOST, LITERAL = "all_ends", "leftmost", "literal"


class RuleError(ValueError):
    """A rule that cannot be used; the message says why."""


@dataclass(frozen=True)
class Rule:
    """One rule as the user writes it."""

    rule_id: int
    expression: str
    flags: str = ""
    ext: dict = field(default_factory=dict)
    kind: str = ALL_ENDS


@dataclass(frozen=True)
class Prepared:
    """A validated rule with the regular expressions derived from it."""

    rule: Rule
    forward: str  # JVM pattern, reading direction
    backward: str | None  # JVM pattern of the reversed rule (not for leftmost rules)
    min_width: int
    max_width: int | None  # None = unbounded
    literal: str | None  # text every match contains
    caseless: bool
    any_of: tuple[str, ...]  # every match contains one of these (lower case if caseless)
    at_end: bool  # may match only because the data ends
    only_at_end: bool
    looks_right: bool  # needs the bytes after a match
    one_variable: bool  # at most one part of the rule varies in width
    anchored: bool  # matches only at the start of the data
    stack_risk: bool  # deep recursion in the JVM matcher on long runs
    ascii_only: bool  # same answer on characters and on bytes
    fence: str | None  # class of bytes no match can contain, None if there is none

    @property
    def rule_id(self) -> int:
        return self.rule.rule_id

    def has(self, letter: str) -> bool:
        return letter in self.rule.flags

    @property
    def nullable(self) -> bool:
        return self.min_width == 0

    @property
    def fixed_width(self) -> bool:
        return self.max_width == self.min_width

    @property
    def wants_start(self) -> bool:
        return self.has("L") or self.rule.ext.get("min_length") is not None


# --------------------------------------------------------------------------
# parsing

_TOKEN = re.compile(
    r"\\Q(?P<quoted>.*?)(?:\\E|\Z)"
    r"|\\x\{(?P<hex>[0-9A-Fa-f]+)\}"
    r"|\\(?P<esc>.)"
    r"|\[:(?P<neg>\^?)(?P<posix>[a-z]+):\]"
    r"|\(\?<(?P<name>[A-Za-z_]\w*)>"
    r"|(?P<char>.)",
    re.S,
)


def _to_python_syntax(expr: str, kind: str) -> str:
    """Spell the few PCRE-only escapes in the syntax Python's parser reads."""
    out, in_class, class_start = [], False, -1
    for m in _TOKEN.finditer(expr):
        if m["quoted"] is not None:
            out.append(re.escape(m["quoted"]))
        elif m["hex"]:
            out.append(re.escape(chr(int(m["hex"], 16))))
        elif m["posix"]:
            if m["posix"] not in POSIX_CLASSES or m["neg"]:
                raise RuleError(f"POSIX class {m[0]} not supported.")
            out.append(POSIX_CLASSES[m["posix"]])
        elif m["name"]:
            out.append(f"(?P<{m['name']}>")
        elif m["esc"]:
            out.append(_escape(m["esc"], m.start(), in_class, kind))
        else:
            c = m["char"]
            if in_class and c == "[":
                c = r"\["
            elif not in_class and c == "[":
                in_class, class_start = True, m.end()
            elif in_class and c == "]":
                body = expr[class_start : m.start()]
                in_class = body in ("", "^")
            out.append(c)
    return "".join(out)


def _escape(c: str, at: int, in_class: bool, kind: str) -> str:
    if c == "z" and not in_class:
        return r"\Z"
    if c == "Z" and not in_class:
        return "(?-m:$)"
    if c == "h":
        return r"\t\ " if in_class else r"[\t\ ]"
    if c == "N" and not in_class:
        return r"[^\n]"
    if c == "e":
        return r"\x1b"
    if c == "R" and kind == LEFTMOST and not in_class:
        return r"(?:\r\n|[\n\x0b\f\r])"
    if c in "RKGXCHVpPEQ":
        raise RuleError(rf"\{c} at index {at} not supported.")
    return "\\" + c


def byte_text(text: str) -> str:
    """The byte view of a string: one character per UTF-8 byte."""
    return text.encode("utf-8").decode("latin-1")


def parse(rule: Rule):
    """Parse a rule's expression; raises :class:`RuleError`."""
    expr = rule.expression
    if "8" not in rule.flags:
        expr = byte_text(expr)
    if rule.kind == LITERAL:
        source = re.escape(expr)
    else:
        source = _to_python_syntax(expr, rule.kind)
    bits = re.ASCII if "W" not in rule.flags else re.UNICODE
    for letter, bit in (("i", re.I), ("s", re.S), ("m", re.M)):
        if letter in rule.flags:
            bits |= bit
    try:
        # compiling (not only parsing) also checks look-behind widths
        re.compile(source, bits)
        return _parser.parse(source, bits)
    except re.error as e:
        if "missing )" in e.msg:
            raise RuleError(f"Missing close parenthesis for group started at index {e.pos}.") from e
        raise RuleError(f"{e.msg} at index {e.pos}.") from e
    except (RecursionError, OverflowError) as e:
        raise RuleError(f"expression too large: {e}") from e


# --------------------------------------------------------------------------
# writing

# By name: the parser's own constants cannot be sent to workers.
_SHORT = {
    "CATEGORY_DIGIT": r"\d",
    "CATEGORY_NOT_DIGIT": r"\D",
    "CATEGORY_SPACE": r"\s",
    "CATEGORY_NOT_SPACE": r"\S",
    "CATEGORY_WORD": r"\w",
    "CATEGORY_NOT_WORD": r"\W",
}
_REPEATS = {"MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"}
_DENIED = {
    "GROUPREF": "back-reference",
    "GROUPREF_EXISTS": "conditional group",
    "ASSERT": "look-around",
    "ASSERT_NOT": "look-around",
    "ATOMIC_GROUP": "atomic group",
    "POSSESSIVE_REPEAT": "possessive quantifier",
}


@dataclass(frozen=True)
class Spans:
    """A rule written so that every part of a match is a group of the pattern.

    Lengths of the parts, in order, place each capture group of the rule:
    ``groups`` has (number, first part, part after its last, whether it may take
    no part in a match; a group that may do so is never empty otherwise).
    """

    pattern: str
    parts: int
    groups: tuple[tuple[int, int, int, bool], ...]


class _NoSpans(Exception):
    """A capture group where lengths do not tell its place."""


@dataclass(frozen=True)
class Writer:
    """Writes a parsed rule.

    ``captures`` keeps groups, laziness and atomicity (leftmost rules); without
    it only the language of the rule matters.  ``eod`` False writes the
    assertions that hold only because the data ends as never matching, which is
    how a stream behaves until it is closed.
    """

    java: bool = True
    backward: bool = False
    captures: bool = False
    eod: bool = True
    flags: int = 0

    @property
    def end(self) -> str:
        return r"\z" if self.java else r"\Z"

    def char(self, c: int) -> str:
        if c < 0x80:
            ch = chr(c)
            if ch.isalnum() or ch == "_":
                return ch
            return "\\" + ch if ch.isprintable() else f"\\x{c:02x}"
        if c <= 0xFFFF:
            return f"\\u{c:04x}"
        return f"\\x{{{c:x}}}" if self.java else f"\\U{c:08x}"

    def char_class(self, items) -> str:
        out = []
        for op, av in items:
            if op is C.NEGATE:
                out.append("^")
            elif op is C.LITERAL:
                out.append(self.char(av))
            elif op is C.RANGE:
                out.append(f"{self.char(av[0])}-{self.char(av[1])}")
            elif op is C.CATEGORY:
                out.append(_SHORT[av.name])
        return "[" + "".join(out) + "]"

    def assertion(self, at) -> str:
        many, end, data_ends = self.flags & re.M, self.end, self.eod
        if at in (C.AT_BOUNDARY, C.AT_NON_BOUNDARY):
            # what is beside the position: a word character, or not one; in an
            # open stream the byte after the position must have arrived
            before, not_before = r"(?<=\w)", r"(?<!\w)"
            after, not_after = r"(?=\w)", r"(?!\w)"
            if not data_ends and self.backward:
                not_before = r"(?<=\W)"
            elif not data_ends:
                not_after = r"(?=\W)"
            if at is C.AT_BOUNDARY:
                return f"(?:{before}{not_after}|{not_before}{after})"
            return f"(?:{before}{after}|{not_before}{not_after})"
        if at is C.AT_BEGINNING and many:
            if self.backward:
                return rf"(?:{end}|(?!\A)(?=\n))"
            return rf"(?:\A|(?<=\n)(?!{end}))"
        if at in (C.AT_BEGINNING, C.AT_BEGINNING_STRING):
            return end if self.backward else r"\A"
        if at is C.AT_END and many:
            if self.backward:
                return r"(?:\A|(?<=\n))" if data_ends else r"(?<=\n)"
            return rf"(?=\n|{end})" if data_ends else r"(?=\n)"
        if not data_ends:
            return "(?!)"
        if at is C.AT_END:
            return r"(?:\A|(?<=\A\n))" if self.backward else rf"(?=\n?{end})"
        return r"\A" if self.backward else end

    def sequence(self, items) -> str:
        items = list(items)
        if self.backward:
            items.reverse()
        return "".join(self.item(op, av) for op, av in items)

    def item(self, op, av) -> str:
        if op is C.LITERAL:
            return self.char(av)
        if op is C.NOT_LITERAL:
            return f"[^{self.char(av)}]"
        if op is C.ANY:
            return r"[\s\S]" if self.flags & re.S else r"[^\n]"
        if op is C.IN:
            return self.char_class(av)
        if op is C.AT:
            return self.assertion(av)
        if op is C.BRANCH:
            return "(?:" + "|".join(self.sequence(x) for x in av[1]) + ")"
        if op.name in _REPEATS:
            return self.repeat(op, *av)
        if op is C.SUBPATTERN:
            return self.group(*av)
        if op is C.GROUPREF:
            return f"(?:\\{av})"
        if op in (C.ASSERT, C.ASSERT_NOT):
            direction, body = av
            sign = "=" if op is C.ASSERT else "!"
            return f"(?{'<' if direction < 0 else ''}{sign}{self.sequence(body)})"
        if op is C.ATOMIC_GROUP:
            return f"(?>{self.sequence(av)})"
        if op is C.FAILURE:
            return "(?!)"
        raise RuleError(f"{str(op).lower()} not supported.")

    def repeat(self, op, low, high, body) -> str:
        if high == C.MAXREPEAT and not self.captures:
            body = _unnested(body)
        text = self.sequence(body)
        grouped = (C.LITERAL, C.NOT_LITERAL, C.ANY, C.IN, C.SUBPATTERN)
        if len(body) != 1 or body[0][0] not in grouped:
            text = f"(?:{text})"
        if high == C.MAXREPEAT:
            count = {0: "*", 1: "+"}.get(low, f"{{{low},}}")
        elif (low, high) == (0, 1):
            count = "?"
        else:
            count = f"{{{low}}}" if low == high else f"{{{low},{high}}}"
        if self.captures and op is C.MIN_REPEAT:
            count += "?"
        elif self.captures and op is C.POSSESSIVE_REPEAT:
            count += "+"
        return text + count

    def group(self, number, add, drop, body) -> str:
        inner = replace(self, flags=(self.flags | add) & ~drop).sequence(body)
        turn_on = "i" if add & re.I else ""
        turn_off = "-i" if drop & re.I else ""
        if turn_on or turn_off:
            inner = f"(?{turn_on}{turn_off}:{inner})"
        if self.captures and number is not None:
            return f"({inner})"
        return f"(?:{inner})"

    def write(self, tree, letters: str, items=None) -> str:
        """``items`` are written in place of those of the tree."""
        text = replace(self, flags=tree.state.flags).sequence(tree if items is None else items)
        # every rule is usable inside a larger pattern, hence the group
        return f"{self.opening(tree.state.flags, letters)}{text})"

    def opening(self, flags: int, letters: str) -> str:
        prefix = ""
        if flags & re.I:
            prefix += "i"
            if "8" in letters and self.java:
                prefix += "u"
        if "W" in letters and self.java:
            prefix += "U"
        return f"(?{prefix}:"


    def spans(self, tree, letters: str) -> Spans | None:
        """The rule as ``Spans``; None if a group repeats, is referred to, stands
        in a look-around or an atomic group, or may be empty or absent alike."""
        if any(op in (C.GROUPREF, C.GROUPREF_EXISTS) for op, _ in _walk(tree)):
            return None
        groups: list[tuple[int, int, int, bool]] = []
        try:
            text, parts = replace(self, flags=tree.state.flags)._parts(tree, 0, False, groups)
        except _NoSpans:
            return None
        return Spans(f"{self.opening(tree.state.flags, letters)}{text})", parts, tuple(sorted(groups)))

    def _parts(self, items, at: int, maybe: bool, groups: list) -> tuple[str, int]:
        """Items with their parts numbered from ``at``, and the next number."""
        out, gap = [], []

        def close() -> int:
            if not gap:
                return at
            out.append(f"({self.sequence(gap)})")
            gap.clear()
            return at + 1

        for op, av in items:
            if not any(inner is C.SUBPATTERN and x[0] is not None for inner, x in _walk([(op, av)])):
                gap.append((op, av))
                continue
            at = close()
            if op is C.SUBPATTERN:
                number, add, drop, body = av
                if number is not None and maybe and _width(body)[0] == 0:
                    raise _NoSpans
                first = at
                inner = replace(self, flags=(self.flags | add) & ~drop)
                text, at = inner._parts(body, at, maybe, groups)
                switch = ("i" if add & re.I else "") + ("-i" if drop & re.I else "")
                out.append(f"(?{switch}:{text})")
                if number is not None:
                    groups.append((number, first, at, maybe))
            elif op is C.BRANCH:
                texts = []
                for branch in av[1]:
                    text, at = self._parts(branch, at, True, groups)
                    texts.append(text)
                out.append(f"(?:{'|'.join(texts)})")
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and tuple(av[:2]) == (0, 1):
                text, at = self._parts(av[2], at, True, groups)
                out.append(f"(?:{text})?{'?' if op is C.MIN_REPEAT else ''}")
            else:
                raise _NoSpans
        return "".join(out) if not gap else "".join((*out, f"({self.sequence(gap)})")), at + bool(gap)


# --------------------------------------------------------------------------
# properties of a parsed rule


def _unnested(body):
    """``(n x+)*`` as ``(n x)*`` where ``n`` may be empty: the same language,
    but no longer exponentially many ways to match one text."""
    parts = list(_flatten(body))
    if not parts or parts[-1][0] not in (C.MAX_REPEAT, C.MIN_REPEAT):
        return body
    low, high, inner = parts[-1][1]
    if low != 1 or high != C.MAXREPEAT:
        return body
    if any(_part_width(body, op, av)[0] > 0 or op is C.AT for op, av in parts[:-1]):
        return body
    return _parser.SubPattern(body.state, parts[:-1] + list(inner))


def _walk(items):
    for op, av in items:
        yield op, av
        if op.name in _REPEATS:
            yield from _walk(av[2])
        elif op is C.SUBPATTERN:
            yield from _walk(av[3])
        elif op is C.BRANCH:
            for x in av[1]:
                yield from _walk(x)
        elif op in (C.ASSERT, C.ASSERT_NOT):
            yield from _walk(av[1])
        elif op is C.ATOMIC_GROUP:
            yield from _walk(av)


def _width(items) -> tuple[int, int | None]:
    low, high = items.getwidth()
    return low, (None if high >= 1 << 31 else high)


def _flatten(items):
    """Top-level parts, with plain groups opened."""
    for op, av in items:
        if op is C.SUBPATTERN and not av[1] and not av[2]:
            yield from _flatten(av[3])
        else:
            yield op, av


def _part_width(tree, op, av):
    part = _parser.SubPattern(tree.state, [(op, av)])
    return _width(part)


def _one_variable(tree) -> bool:
    variable = []
    for op, av in _flatten(tree):
        low, high = _part_width(tree, op, av)
        if low != high:
            variable.append((op, av))
    if len(variable) > 1:
        return False
    for op, av in variable:
        if op not in (C.MAX_REPEAT, C.MIN_REPEAT):
            return False
        low, high = _width(av[2])
        if low != high:
            return False
    return True


def _anchored(items, flags: int) -> bool:
    for op, av in _flatten(items):
        start = (C.AT_BEGINNING, C.AT_BEGINNING_STRING)
        if op is not C.AT or av not in start:
            return False
        return av is C.AT_BEGINNING_STRING or not flags & re.M
    return False


def _free_ends(tree) -> list:
    """The items of a rule, for finding its ends.  After ``\\A``, any number of any
    characters says only how many there must be; read backwards, such a run
    would read all of the text again for each end."""
    items = list(tree)
    if len(items) < 2 or not _anchored(items[:1], tree.state.flags) or not tree.state.flags & re.S:
        return items
    op, av = items[1]
    if op not in (C.MAX_REPEAT, C.MIN_REPEAT) or av[1] is not C.MAXREPEAT or [o for o, _ in av[2]] != [C.ANY]:
        return items
    return [(C.MAX_REPEAT, (av[0], av[0], av[2])), *items[2:]] if av[0] else items[2:]


def _required_literal(tree) -> str | None:
    """Longest text that every match contains."""
    runs, run = [], []
    for op, av in _flatten(tree):
        if op is C.LITERAL:
            run.append(chr(av))
            continue
        if op is C.AT:
            continue
        runs.append("".join(run))
        run = []
        if op in (C.MAX_REPEAT, C.MIN_REPEAT) and av[0] >= 1:
            body = list(_flatten(av[2]))
            if all(o is C.LITERAL for o, _ in body):
                runs.append("".join(chr(a) for _, a in body))
    runs.append("".join(run))
    best = max(runs, key=len)
    return best or None


MAX_ANY_OF = 16


def _folded(text: str, wide: bool) -> str:
    """The longest part of a text that any spelling in other cases contains in
    lower case: ASCII, and with Unicode folding without the letters that others
    beyond ASCII equal (a dotless i, a long s, the Kelvin sign)."""
    return max(re.split(r"[^\x00-\x7f]|[iksIKS]" if wide else r"[^\x00-\x7f]", text), key=len).lower()


def _any_of(tree, caseless: bool, wide: bool) -> tuple[str, ...]:
    """A few texts of which every match contains one; empty if none are known.

    The texts are only a cheap first test, so the shortest decides how good a
    choice is.
    """

    def choose(items) -> tuple[str, ...]:
        own = _required_literal(items)
        choices = [(own,)] if own else []
        for op, av in _flatten(items):
            if op is C.BRANCH:
                sets = [choose(x) for x in av[1]]
                if all(sets):
                    choices.append(tuple(dict.fromkeys(t for s in sets for t in s)))
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and av[0] >= 1:
                choices.append(choose(av[2]))
        fit = [c for c in choices if 0 < len(c) <= MAX_ANY_OF]
        return max(fit, key=lambda c: min(map(len, c)), default=())

    best = choose(tree)
    if caseless:
        parts = tuple(dict.fromkeys(_folded(t, wide) for t in best))
        return parts if all(parts) else ()
    return best


def _stack_risk(tree) -> bool:
    for op, av in _walk(tree):
        if op in (C.MAX_REPEAT, C.MIN_REPEAT) and (av[1] == C.MAXREPEAT or av[1] > 256):
            body = list(_walk(av[2]))
            single = len(av[2]) == 1 and av[2][0][0] in (C.LITERAL, C.NOT_LITERAL, C.ANY, C.IN)
            if not single and any(o is C.BRANCH or o.name in _REPEATS for o, _ in body):
                return True
    return False


def _ascii_only(tree) -> bool:
    """True when characters and bytes give the same yes/no answer."""
    for op, av in _walk(tree):
        if op in (C.ANY, C.NOT_LITERAL):
            return False
        if op is C.LITERAL and av >= 0x80:
            return False
        if op is C.IN:
            for kind, value in av:
                if kind is C.NEGATE:
                    return False
                if kind is C.LITERAL and value >= 0x80:
                    return False
                if kind is C.RANGE and value[1] >= 0x80:
                    return False
                if kind is C.CATEGORY and _SHORT[value.name].isupper():
                    return False
    return True


def _class_set(items) -> set[int]:
    chars, negate = set(), False
    for kind, value in items:
        if kind is C.NEGATE:
            negate = True
        elif kind is C.LITERAL:
            chars.add(value)
        elif kind is C.RANGE:
            chars.update(range(value[0], min(value[1], 255) + 1))
        elif kind is C.CATEGORY:
            short = re.compile(_SHORT[value.name], re.ASCII)
            chars.update(c for c in range(256) if short.match(chr(c)))
    return set(range(256)) - chars if negate else chars


def _alphabet(tree, dotall: bool) -> set[int]:
    """Every byte value a match may contain."""
    chars: set[int] = set()
    for op, av in _walk(tree):
        if op is C.LITERAL:
            chars.add(av)
        elif op is C.NOT_LITERAL:
            chars.update(set(range(256)) - {av})
        elif op is C.ANY:
            chars.update(range(256) if dotall else set(range(256)) - {10})
        elif op is C.IN:
            chars.update(_class_set(av))
        elif op is C.SUBPATTERN and av[1] & re.S:
            return set(range(256))
    if any(chr(c).isalpha() for c in chars if c < 128):
        chars.update(
            ord(x) for c in list(chars) if c < 128 for x in (chr(c).lower(), chr(c).upper())
        )
    return chars


def _fence(tree, letters: str) -> str | None:
    if "8" in letters:
        return None
    matched = _alphabet(tree, bool(tree.state.flags & re.S))
    if any(op is C.AT and av is C.AT_END for op, av in _walk(tree)):
        matched.add(10)  # an end may look past a final newline
    outside = sorted(set(range(256)) - matched)
    if not outside:
        return None
    ranges = []
    for c in outside:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    w = Writer()
    return "[" + "".join(
        w.char(a) if a == b else f"{w.char(a)}-{w.char(b)}" for a, b in ranges
    ) + "]"


def _end_class(tree) -> tuple[bool, bool]:
    """(may, must) match only because the data ends."""
    ends = (C.AT_END, C.AT_END_STRING)
    many = tree.state.flags & re.M
    at_end = any(op is C.AT and av in ends for op, av in _walk(tree))

    def must(items) -> bool:
        for op, av in items:
            if op is C.AT and (av is C.AT_END_STRING or (av is C.AT_END and not many)):
                return True
            if op is C.SUBPATTERN and must(av[3]):
                return True
            if op is C.BRANCH and all(must(x) for x in av[1]):
                return True
            if op.name in _REPEATS and av[0] > 0 and must(av[2]):
                return True
        return False

    return at_end, must(tree)


def check_flags(rule: Rule) -> str:
    """Canonical flag letters; unknown ones, or ones the kind lacks, raise."""
    if rule.kind == LEFTMOST:
        known, letters = LEFTMOST_FLAGS, set(rule.flags)
    else:
        known = "".join(FLAG_BITS)
        letters = {DEPRECATED_FLAGS.get(c, c) for c in rule.flags}
    for c in letters:
        if c not in known:
            raise RuleError(f"flag `{c}` invalid for {rule.kind} rules")
    return "".join(sorted(letters))


def prepare(rule: Rule, eod: bool = True) -> Prepared:
    """Validate one rule and derive its regular expressions."""
    rule = replace(rule, flags=check_flags(rule))
    tree = parse(rule)
    leftmost = rule.kind == LEFTMOST
    if not leftmost:
        for op, _ in _walk(tree):
            if op.name in _DENIED:
                raise RuleError(f"{_DENIED[op.name]} not supported.")
    low, high = _width(tree)
    if low == 0 and not leftmost and "V" not in rule.flags:
        raise RuleError("Pattern matches empty buffer; use AllowEmpty (V) to enable support.")
    at_end, only_at_end = _end_class(tree)
    caseless = bool(tree.state.flags & re.I)
    wide = "8" in rule.flags or "W" in rule.flags
    forward = Writer(captures=leftmost, eod=eod).write(tree, rule.flags)
    backward = None if leftmost else Writer(backward=True, eod=eod).write(tree, rule.flags, _free_ends(tree))
    return Prepared(
        rule=rule,
        forward=forward,
        backward=backward,
        min_width=low,
        max_width=high,
        literal=None if tree.state.flags & re.I else _required_literal(tree),
        caseless=caseless,
        any_of=_any_of(tree, caseless, wide),
        at_end=at_end,
        only_at_end=only_at_end,
        looks_right=any(op is C.AT for op, _ in _walk(tree)),
        one_variable=_one_variable(tree),
        anchored=_anchored(tree, tree.state.flags),
        stack_risk=_stack_risk(tree),
        ascii_only="W" not in rule.flags and _ascii_only(tree),
        fence=None if leftmost or "W" in rule.flags else _fence(tree, rule.flags),
    )


def capture_spans(p: Prepared) -> Spans | None:
    """How the JVM places the capture groups of a leftmost rule, if it can."""
    return Writer(captures=True).spans(parse(p.rule), p.rule.flags)


def python_pattern(rule: Rule, backward: bool = False, eod: bool = True) -> str:
    """The same rule for Python's ``re`` (Python workers only)."""
    rule = replace(rule, flags=check_flags(rule))
    tree = parse(rule)
    captures = rule.kind == LEFTMOST
    return Writer(java=False, backward=backward, captures=captures, eod=eod).write(tree, rule.flags)


def python_flags(rule: Rule) -> int:
    return re.UNICODE if "W" in rule.flags else re.ASCII
