"""Secret scan: three fixed patterns, and a lexer that follows literals to the names they are given to.

The lexer reads source and configuration syntax of many languages into pairs of a name and what it is given: assignments
(``=``, ``:=``, ``=>``, ``:``, also behind a type), keys of maps and subscripts, named arguments, calls with a quoted name first
(``set("password", "...")``), elements (``<password>...</password>``), command-line options, bare values of settings files, and
the user part of addresses. A literal given to a plain name is remembered under it; where that name, or a sum or
interpolation that holds it, is given to another, the literal is known to be given to that one too. So constants are
propagated along any chain in the order of the text. Names are nodes of a graph in which nothing is copied, and a node is
visited at most once for each level of sensitivity: the work stays in proportion to the text.

Each literal, also each part of a sum, is scored by itself: the sensitivity of the most telling name that it reaches, plus what speaks for a made-up secret (length,
kinds of characters, entropy), less what speaks against one (placeholders, interpolations, words, paths). Literals from
THRESHOLD on are reported as ``literal`` spans; the spans of the fixed patterns always stay.

Offsets are code points, ends exclusive. Null and empty texts have no spans. Repeated rows are scanned one by one, a null id
stays null. Very long texts are scanned whole: every step is linear in the text. An empty table gives no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from parcelcast.llm.common import bound_batches, slices, table

THRESHOLD = 4.0
KINDS = ("assign", "access", "hex", "literal")

# Fixed patterns of the contract: kind, pattern, group whose length counts, least length.
BASE = [
    ("assign", re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),  # a run has no shorter match, so the least length may stand in the pattern
]
# What a text must hold to have any span: read by a linear matcher before any text becomes a Python string.
SIGN = r"(?i)pass(?:word|wd|phrase|code)|pwd|secret|token|key|credential|bearer|AKIA|[0-9a-f]{32}|://"

# Sensitivity of a name's words; keys of several words must follow each other.
STRONG = {"password", "passwd", "pwd", "passphrase", "secret", "apikey", "api key", "secret key", "private key", "access key",
          "client secret", "auth token", "access token", "refresh token", "signing key", "encryption key", "master key", "userinfo"}
WEAK = {"token", "passcode", "credential", "credentials", "bearer", "auth key", "service key", "account key", "session key", "webhook secret"}
# Words that make a name one of something about a secret, not the secret.
ABOUT = {"id", "name", "names", "file", "path", "url", "uri", "type", "length", "len", "count", "size", "field", "label", "hint", "policy",
         "expiry", "expires", "ttl", "limit", "limits", "index", "max", "min", "prompt", "reset", "regex", "pattern", "format", "public"}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|_+|0+|changeme|change[_-]?it|example.*|your[_-].*|my[_-]?(?:password|secret|token)|<.*>|\[.*\]|"
                         r"none|null|true|false|undefined|todo|fixme|placeholder|dummy|redacted|password|secret|token|test|default)$")
TYPE_WORDS = {"str", "string", "bytes", "final", "const", "var", "let", "text", "any", "object", "char", "optional", "val", "static"}

_TOKEN = re.compile(r"""(?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.-](?=[A-Za-z_$])[A-Za-z0-9_$]+)*)|(?P<quote>["'`])|(?P<op>:=|=>|->|==|!=|<=|>=|\+=|[-=:+,;(){}\[\]<>?&\n\r])""")
_BODY = {q: re.compile(rf"[^{q}\\\n]*+(?:\\.[^{q}\\\n]*+)*+") for q in "\"'`"}
_SETTING = re.compile(r"""^[ \t]*+(?:export[ ]|set[ ]|-[ ])?+[ \t]*+(?P<name>[A-Za-z_][A-Za-z0-9_.-]*)[ \t]*[=:][ \t]*(?P<value>[^\s"'`#;,(){}\[\]<>]+)[ \t]*(?:[#;].*)?$""", re.M)
_OPTION = re.compile(r"""(?<![\w-])--(?P<name>[A-Za-z][A-Za-z0-9_-]*)[ =](?P<value>[^\s"'`;,(){}\[\]<>-][^\s"'`;,(){}\[\]<>]*)""")
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.:-]*)>(?P<value>[^<>\n]+)</(?P=name)>")
_ADDRESS = re.compile(r"://[^\s/@:\"'`]{1,256}:(?P<value>[^\s/@\"'`]{1,1024})@")
_REFERENCE = re.compile(r"\$\{?(?P<name>[A-Za-z_][A-Za-z0-9_]*)\}?|\{(?P<braced>[A-Za-z_][A-Za-z0-9_.]*)\}")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def sensitivity(name: str) -> int:
    """3 for names of secrets, 2 for names that often are, 0 for others."""
    words = [w.lower() for w in _PARTS.findall(name)]
    if not words or words[-1] in ABOUT:
        return 0
    level = 0
    for i, word in enumerate(words):
        for term in (word, f"{word} {words[i + 1]}" if i + 1 < len(words) else word):
            if term in STRONG or term.rstrip("s") in STRONG:
                return 3
            if term in WEAK or term.rstrip("s") in WEAK:
                level = 2
    return level


def quality(literal: str) -> float:
    """What speaks for a made-up secret, less what speaks against it."""
    n = len(literal)
    if n < 6 or PLACEHOLDER.match(literal) or _REFERENCE.fullmatch(literal):
        return -9.0
    kinds = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    score = min(n, 32) / 16 + 0.4 * (kinds - 1) + (entropy - 2.5) / 2
    if any(c.isspace() for c in literal):
        score -= 1.5
    if re.fullmatch(r"[A-Za-z]+(?:[ _.-][A-Za-z]+)*", literal):
        score -= 1.5  # words
    if "/" in literal and re.fullmatch(r"(?:\.{0,2}/|[a-z]+://)[\w./-]*", literal):
        score -= 2.0  # a path
    return score


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    return [(m.start(), m.end(), kind) for kind, pattern, group, least in BASE for m in pattern.finditer(text)
            if m.end(group) - m.start(group) >= least]


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end): ``name``, ``str`` (without its quotes) and operators, which are their own kind.

    A quote that no other of its kind closes on the same line is skipped; so is one right behind a letter or digit, an
    apostrophe, unless a one- or two-letter prefix stands there.
    """
    out, at, open_until = [], 0, {}
    while m := _TOKEN.search(text, at):
        kind, start, at = m.lastgroup, m.start(), m.end()
        if kind == "quote":
            quote = text[start]
            if start < open_until.get(quote, 0):
                continue
            if start and (text[start - 1].isalnum() or text[start - 1] == "_"):
                if not (out and out[-1][0] == "name" and out[-1][2] == start and start - out[-1][1] <= 2 and text[out[-1][1]: start].lower() in ("r", "b", "f", "u", "l", "rb", "br", "fr", "rf")):
                    continue
                out.pop()
            end = _BODY[quote].match(text, start + 1).end()
            if end < len(text) and text[end] == quote:
                out.append(("str", start + 1, end))
                at = end + 1
            else:
                open_until[quote] = end
        elif kind == "name":
            out.append(("name", start, at))
        else:
            out.append((text[start:at], start, at))
    return out


class Names:
    """What names are given: a graph of values, each a list of literals and of other values."""

    def __init__(self) -> None:
        self.literals: list[list[tuple[int, int]]] = []
        self.parts: list[list[int]] = []
        self.of: dict[str, int] = {}
        self.given: list[tuple[int, int]] = []  # (value, level)

    def value(self, literals: list[tuple[int, int]], names: list[str]) -> int:
        self.literals.append(literals)
        self.parts.append([self.of[n] for n in names if n in self.of])
        return len(self.literals) - 1

    def give(self, targets: list[str], literals: list[tuple[int, int]], names: list[str], add: bool = False) -> None:
        value = self.value(literals, names + targets if add else names)
        for target in targets:
            self.of[target] = value
            if level := sensitivity(target):
                self.given.append((value, level))

    def reached(self) -> dict[tuple[int, int], int]:
        """The highest level that each literal reaches."""
        out, level_of = {}, [0] * len(self.literals)
        for level in (3, 2):
            todo = [v for v, given in self.given if given == level]
            while todo:
                v = todo.pop()
                if level_of[v] >= level:
                    continue
                level_of[v] = level
                for span in self.literals[v]:
                    out[span] = max(out.get(span, 0), level)
                todo += self.parts[v]
        return out


_ENDS = {"\n", "\r", ",", ";", ")", "}", "]", "=>", ":", "?", "<", ">"}


def read(text: str) -> Names:
    """All pairs of the text, in its order."""
    seen, out = tokens(text), Names()
    extra = [(m.start("name"), m.group("name"), m.span("value")) for p in (_SETTING, _OPTION, _ELEMENT) for m in p.finditer(text)]
    extra += [(m.start(), "userinfo", m.span("value")) for m in _ADDRESS.finditer(text)]
    extra.sort(reverse=True)

    def word(token: tuple[str, int, int]) -> str:
        return text[token[1]: token[2]]

    def references(span: tuple[int, int]) -> list[str]:
        return [m.group("name") or m.group("braced") for m in _REFERENCE.finditer(text, *span)] if "{" in text[span[0]: span[1]] or "$" in text[span[0]: span[1]] else []

    def value_at(i: int) -> tuple[list[tuple[int, int]], list[str]]:
        """Literals and names of the sum that begins at token i."""
        literals, names = [], []
        while i < len(seen) and seen[i][0] not in _ENDS:
            kind, start, end = seen[i]
            if kind == "str":
                literals.append((start, end))
                names += references((start, end))
            elif kind == "name":
                if i + 1 < len(seen) and seen[i + 1][0] == "(":
                    break  # a call: its arguments are read as pairs of their own
                names.append(word(seen[i]))
            elif kind not in ("+", "&", "("):
                break
            i += 1
        return literals, names

    def flush(until: int) -> None:
        while extra and extra[-1][0] < until:
            _, name, span = extra.pop()
            inner = text[span[0]: span[1]]
            if inner in out.of:
                out.give([name], [], [inner])
            else:
                out.give([name], [span], references(span))

    i, chained = 0, []
    while i < len(seen):
        kind, start, end = seen[i]
        flush(start)
        if kind not in ("name", "str"):
            i += 1
            continue
        target, j = word(seen[i]), i + 1
        if kind == "str" and (len(target) > 80 or not re.fullmatch(r"[\w.$ -]+", target)):
            i += 1
            continue
        while j < len(seen) and seen[j][0] in ("]", "?"):
            j += 1
        op = seen[j][0] if j < len(seen) else ""
        if op == ":" and kind == "name":  # a type may stand between the name and its value
            k = j + 1
            while k < len(seen) and k < j + 8 and (seen[k][0] in ("[", "]") or seen[k][0] == "name"):
                k += 1
            if k > j + 1 and k < len(seen) and seen[k][0] == "=" and any(word(t).lower() in TYPE_WORDS or word(t)[0].isupper() for t in seen[j + 1: k] if t[0] == "name"):
                j, op = k, "="
        if op == "=" and [t[0] for t in seen[j + 1: j + 3]] == ["name", "="]:  # a = b = ...: both get the value
            chained.append(target)
            i = j + 1
            continue
        if op in ("=", ":=", "=>", ":", "+="):
            literals, names = value_at(j + 1)
            if literals or names:
                out.give([*chained, target], literals, names, add=op == "+=")
            chained, i = [], j + 1
            continue
        if op == "," and kind == "str" and i and seen[i - 1][0] == "(":  # call("name", "value")
            literals, names = value_at(j + 1)
            if literals:
                out.give([target], literals, names)
        i += 1
    flush(len(text) + 1)
    return out


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name and score enough."""
    return [(a, b, "literal") for (a, b), level in read(text).reached().items() if level + quality(text[a:b]) >= THRESHOLD]


def joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in ordered)


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long"


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with the counts of its spans, the digest of the fixed ones and the list of all."""
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for batch, texts in slices(batches):
            signed = pc.match_substring_regex(texts, SIGN).to_pylist()
            columns: list[list] = [[], [], [], [], [], []]
            for i, sign in enumerate(signed):
                row = (0, 0, 0, nothing, "", 0)
                if sign:
                    text = texts[i].as_py()
                    base, more = base_spans(text), literal_spans(text)
                    kinds = Counter(s[2] for s in base)
                    row = (kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined(base).encode()).hexdigest(),
                           joined(base + more), len(set(more)))
                for column, x in zip(columns, row):
                    column.append(x)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])

    return bound_batches(docs).select("doc_id", "text").mapInArrow(run, RESULT)


def op11_secrets(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
