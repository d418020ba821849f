"""Secret scan: a trigram index says which texts can match a rule, the rule's pattern then decides.

From each pattern a Boolean query over lower-cased trigrams is derived: all of its clauses must hold, and a clause holds
where all trigrams of one of its strings occur. Each batch of texts gets an inverted index: postings for those trigrams
which some rule asks for. Clauses are answered by intersecting and uniting postings, and only the texts left are matched. A
rule without a mandatory trigram is matched against all texts. A batch is indexed where it is read, so nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.tables import map_texts, whole_rows

_parser, _ops = re._parser, re._constants  # the parse tree of a pattern

#: Strings kept apart while a query is derived, and characters a class may have to be spelled out.
MANY, CLASS = 64, 4


@dataclass(frozen=True)
class Rule:
    """A pattern, and what a match must have: ``least`` characters, in group ``group``."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)


# The patterns to look for, in the order in which equal starts are listed.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("payment", r"[sr]k_live_[A-Za-z0-9]+", 24),
)

Clause = frozenset[frozenset[str]]


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def _trigrams(text: str) -> frozenset[str]:
    data = text.encode()
    return frozenset(data[i : i + 3].decode("latin-1") for i in range(len(data) - 2))


def _clause(strings: set[str]) -> Clause | None:
    grams = [_trigrams(s) for s in strings]
    return frozenset(grams) if grams and all(grams) else None


def _class(items: list) -> set[str] | None:
    """The lower-cased characters of a class, or None where they are too many to spell out."""
    chars: set[str] = set()
    for op, value in items:
        if op is _ops.LITERAL:
            chars.add(_lower(chr(value)))
        elif op is _ops.RANGE and value[1] - value[0] < CLASS:
            chars.update(_lower(chr(c)) for c in range(value[0], value[1] + 1))
        else:
            return None
    return chars if len(chars) <= CLASS else None


def _walk(tree, strings: set[str], clauses: list[Clause]) -> set[str]:
    """Go through a sequence; ``strings`` are what can stand just before the current place, all of them whole.

    Where the strings become too many or a part cannot be spelled out, they are turned into a clause and start anew.
    """

    def cut() -> set[str]:
        if (clause := _clause(strings)) is not None:
            clauses.append(clause)
        return {""}

    for op, value in tree:
        parts: set[str] | None = None
        if op is _ops.LITERAL:
            parts = {_lower(chr(value))}
        elif op is _ops.IN:
            parts = _class(value)
        elif op is _ops.SUBPATTERN:
            parts = _strings(value[3])
            if parts is None:
                strings = cut()
                strings = _walk(value[3], strings, clauses)
                cut()
                strings = {""}
                continue
        elif op is _ops.BRANCH:
            parts = set()
            for branch in value[1]:
                spelled = _strings(branch)
                parts = None if spelled is None or parts is None else parts | spelled
        elif op in (_ops.MAX_REPEAT, _ops.MIN_REPEAT):
            low, high, body = value
            spelled = _strings(body)
            if spelled is not None and low == 0 and high == 1:
                parts = spelled | {""}
            elif spelled is not None and low == high and len(spelled) ** low <= MANY:
                parts = {""}
                for _ in range(low):
                    parts = {a + b for a in parts for b in spelled}
        elif op is _ops.AT:
            parts = {""}
        if parts is None or len(strings) * len(parts) > MANY:
            strings = cut()
            strings = parts if parts is not None and len(parts) <= MANY else {""}
            if parts is None:
                strings = {""}
        else:
            strings = {a + b for a in strings for b in parts}
    return strings


def _strings(tree) -> set[str] | None:
    """All strings a part can match, or None where they cannot be spelled out."""
    clauses: list[Clause] = []
    marked = _walk([(_ops.LITERAL, 0), *tree, (_ops.LITERAL, 0)], {""}, clauses)
    whole = all(len(s) >= 2 and s[0] == "\0" and s[-1] == "\0" for s in marked)
    return {s[1:-1] for s in marked} if whole and not clauses else None


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that every text with a match fulfils; none where the pattern has no mandatory trigram."""
    clauses: list[Clause] = []
    last = _clause(_walk(_parser.parse(pattern, re.ASCII), {""}, clauses))
    return list(dict.fromkeys(clauses + ([last] if last is not None else [])))


class Index:
    """The postings of one batch of texts, for the trigrams that some rule asks for."""

    def __init__(self, grams: list[str]):
        self.grams = grams
        codes = [int.from_bytes(g.encode("latin-1"), "big") for g in grams]
        # Two bytes give 65,536 places to look at, the third decides.
        self.first = np.zeros(1 << 16, bool)
        self.first[[c >> 8 for c in codes]] = True
        self.codes = np.array(sorted(codes), np.uint32)
        self.lower = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

    def postings(self, encoded: list[bytes]) -> dict[str, np.ndarray]:
        """The sorted numbers of the texts that hold each trigram."""
        data = self.lower[np.frombuffer(b"\0\0".join(encoded) + b"\0\0", np.uint8)]
        ends = np.cumsum([len(x) + 2 for x in encoded])
        pairs = data[:-1].astype(np.uint16) << 8 | data[1:]
        at = np.flatnonzero(self.first[pairs[:-1]])
        code = pairs[at].astype(np.uint32) << 8 | data[at + 2]
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[place] == code
        key = np.unique(place[hit].astype(np.int64) * len(encoded) + np.searchsorted(ends, at[hit], "right"))
        gram, text = np.divmod(key, len(encoded))
        out = {g: np.empty(0, np.int64) for g in self.grams}
        for i, numbers in zip(*_runs(gram, text), strict=True):
            out[int(self.codes[i]).to_bytes(3, "big").decode("latin-1")] = numbers
        return out


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    if not len(keys):
        return keys, []
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.split(values, starts[1:])


def _answer(query: list[Clause], postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    """The texts that fulfil every clause."""
    left = np.arange(n)
    for clause in query:
        some = [np.empty(0, np.int64)]
        for grams in clause:
            held = None
            for gram in sorted(grams, key=lambda g: len(postings[g])):
                held = postings[gram] if held is None else np.intersect1d(held, postings[gram], assume_unique=True)
            some.append(held)
        left = np.intersect1d(left, np.unique(np.concatenate(some)), assume_unique=True)
    return left


def find(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, str]]]:
    """Each text's (start, end, kind), by start, then in the rules' order."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    grams = sorted({g for query in queries for clause in query for some in clause for g in some})
    postings = Index(grams).postings([t.encode() for t in texts]) if grams else {}
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        # Runs of a single class need not be matched when they are too short to count.
        pattern = rule.compiled()
        if not query and rule.group == 0 and (run := re.fullmatch(r"(\[[^\]\\]+\])\+", rule.pattern)):
            pattern = re.compile(run[1] + "{%d,}" % rule.least, re.ASCII)
        for i in _answer(query, postings, len(texts)):
            for m in pattern.finditer(texts[i]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found[i].append((m.start(), number, m.end()))
    return [[(start, end, rules[number].kind) for start, number, end in sorted(spans)] for spans in found]


SPANS = "array<struct<start:int,end:int,kind:string>>"


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(doc_id, spans): every match of the rules in every whole text, in code points, by start, then in the rules' order.

    Matches of one rule don't overlap, those of different rules may. A null or empty text has no span; repeated rows give
    repeated results; other columns are ignored.
    """

    def scan(texts: list[str | None]) -> list:
        return [[[{"start": s, "end": e, "kind": k} for s, e, k in one] for one in find([t or "" for t in texts], rules)]]

    return map_texts(docs.select("doc_id", "text"), scan, f"spans {SPANS}")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, mask: str = "[secret]") -> DataFrame:
    """The same rows and columns with every span, or overlapping spans together, replaced by ``mask``.

    ``n_chars``, where there is such a column, follows the new text. Null texts stay null.
    """

    def clean(texts: list[str | None]) -> list:
        return [[_masked(t, spans, mask) if spans else t for t, spans in zip(texts, find([t or "" for t in texts], rules), strict=True)]]

    cleaned = map_texts(whole_rows(docs), clean, "cleaned string")
    changed = lambda c: F.when(F.col("cleaned").isNotNull(), F.length("cleaned")).cast(docs.schema["n_chars"].dataType)
    return cleaned.select(
        *[(F.col("cleaned") if c == "text" else changed(c) if c == "n_chars" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]
    )


def _masked(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    parts, end = [], 0
    for start, stop, _ in spans:
        if start >= end:
            parts += [text[end:start], mask]
        end = max(end, stop)
    return "".join(parts) + text[end:]


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
