"""Secret scans: fixed patterns, and guess costs of credential-context values.

The fixed patterns find assignments, access keys and long hexadecimal runs.
The method adds values that stand behind an identifier with a credential name
among its parts (``DB_PWD``, ``client_secret``, ``dbPassword``): a dynamic programme
segments the value into known words, dates, repeats, keyboard walks and
brute-force spans at the least total guess cost (log10 guesses); values that
cost at least ``min_cost`` are secrets of kind ``guess``, unless a fixed pattern
already covers them.

Null and empty texts have no spans; text of any length is scanned whole;
repeated rows give repeated results; an empty table gives an empty result.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
# an identifier and what assigns (plain space after ``bearer`` only); the value stands behind it.  It is
# not part of the match, so that a name inside a value is met too
_CONTEXT = re.compile(r"""(?<![\w-])([\w-]+)["']?(?:[ \t]{0,8}(?:[:=]|->)[ \t]{0,8}|(?<=(?ai:bearer))([ \t]{1,8}))["']?""")
_VALUE_END = re.compile(r"""[\s"'`,;<>()\[\]{}|]""")
_NAME = re.compile(r"(?i:(?<![^\W_])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth|bearer"
                   r"|private[_-]?key|pin)(?![^\W_]))")
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_PROSE = re.compile(r"[^\W\d_][^\W\d_A-Z]*(?:-[^\W\d_A-Z]+)*|[A-Z]+")      # a word after ``bearer`` is no token

#: words by how soon they are guessed; a caller may pass a longer list
COMMON_WORDS = ("password 123456 qwerty admin welcome login letmein dragon master monkey sunshine princess football "
                "shadow secret hello freedom whatever trustno1 iloveyou starwars summer winter spring autumn access "
                "user guest root test default changeme pass example sample dummy placeholder your token key api "
                "value here none null true false redacted hidden xxxx the and for with this that from have not are "
                "you all new was can has one our out day get use man two how its may old see now way who did").split()
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_NEXT = {(a, b) for row in _ROWS for x in (row, row[::-1]) for a, b in zip(x, x[1:])}
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d)")
_LEET = str.maketrans("@4301$5!7", "aaeoissit")


def _class_log(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100)


def guess_cost(value: str, ranks: dict[str, int]) -> tuple[float, list[tuple[int, int, str]]]:
    """Least log10 guesses over all segmentations, and the segmentation.

    One step per end position and span that ends there; spans other than
    repeats and walks are at most as long as the longest word, so the work
    grows with the length of the value."""
    low, n = value.lower(), len(value)
    plain, longest = low.translate(_LEET), max(map(len, ranks), default=1)
    dates = [m.span() for i in range(n) for m in [_DATE.match(value, i)] if m]
    by_end: dict[int, list[int]] = {}
    for a, b in dates:
        by_end.setdefault(b, []).append(a)
    cost, back = [0.0] + [math.inf] * n, [(0, "")] * (n + 1)
    repeat_from, walk_from = 0, 0
    for end in range(1, n + 1):
        i = end - 1
        if i and value[i] != value[i - 1]:
            repeat_from = i
        if i and (low[i - 1], low[i]) not in _NEXT:
            walk_from = i
        # brute force goes on character by character: the classes of its span multiply
        options = [(cost[i] + _class_log(value[i]) + (0 if back[i][1] == "brute" or not i else 0.3), i, "brute")]
        for a in range(max(0, end - longest), end - 1):
            word = low[a:end]
            rank = ranks.get(word)
            extra = 0.0 if value[a:end] == word else 0.5
            if rank is None and (rank := ranks.get(plain[a:end])) is not None:
                extra = 1.0
            if rank is not None:
                options.append((cost[a] + math.log10(rank + 1) + extra + 0.3, a, "word"))
        for a in by_end.get(end, ()):
            options.append((cost[a] + (2.2 if end - a == 4 else 4.8), a, "date"))
        if end - repeat_from >= 3:
            options.append((cost[repeat_from] + _class_log(value[i]) + math.log10(end - repeat_from), repeat_from, "repeat"))
        if end - walk_from >= 3:
            options.append((cost[walk_from] + 2.0 + math.log10(end - walk_from), walk_from, "walk"))
        cost[end], at, kind = min(options)
        back[end] = (at, kind)
    spans, end = [], n
    while end:
        at, kind = back[end]
        if spans and kind == spans[-1][2] == "brute":
            spans[-1] = (at, spans[-1][1], kind)
        else:
            spans.append((at, end, kind))
        end = at
    return cost[n], spans[::-1]


def find_spans(text: str, ranks: dict[str, int], min_cost: float) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in order."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    fixed = list(found)
    done, run_end = 0, -1
    for m in _CONTEXT.finditer(text):
        a = m.end()
        if a < done or not (_NAME.search(m[1]) or _NAME.search(_HUMP.sub("_", m[1]))):
            continue
        if a > run_end:                                # names inside one run of value characters share its end
            end = _VALUE_END.search(text, a)
            run_end = end.start() if end else len(text)
        b = run_end
        while b > a and text[b - 1] in ".!?:":
            b -= 1
        if b - a < 8:
            continue
        value = text[a:b]
        if m[2] and _PROSE.fullmatch(value):
            continue
        if not any(s <= a and b <= e for s, _, e in fixed) and guess_cost(value, ranks)[0] >= min_cost:
            found.append((a, 3, b))
            done = b
    return sorted(found)


def scan(docs: DataFrame, min_cost: float = 10.0, words: list[str] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans array<struct<kind, start, end>>)`` of every text."""
    ranks = {w: i + 1 for i, w in reversed(list(enumerate(words or COMMON_WORDS)))}
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find_spans(t.as_py(), ranks, min_cost)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind))], ["id", "spans"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return src.mapInArrow(run, "id long, spans array<struct<kind: string, start: long, end: long>>") \
        .withColumnRenamed("id", id_col)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the fixed kinds, and all spans as text."""
    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(id_col, *(n(k) for k in KINDS[:3]), F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", min_cost: float = 10.0, words: list[str] | None = None) -> DataFrame:
    """The rows with every span (overlapping spans as one) replaced by ``mark``
    and ``n_chars`` set anew; null texts stay null, other columns as they are."""
    ranks = {w: i + 1 for i, w in reversed(list(enumerate(words or COMMON_WORDS)))}

    def clean(text: str) -> str:
        out, at = [], 0
        for a, _, b in find_spans(text, ranks, min_cost):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join([*out, text[at:]])

    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([None if not t.is_valid else clean(t.as_py()) for t in batch.column(at)], batch.column(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else batch.column(i) for i in range(batch.num_columns)],
                                             batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
