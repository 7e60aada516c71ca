"""Secret scans: a trigram index of each batch of texts picks the texts to verify.

A rule's regular expression is turned into a Boolean query over the trigrams that every
match must contain. Each task indexes its texts batch by batch, for the trigrams that the
rules ask for: trigram -> texts that hold it. Intersecting and uniting these postings
leaves the candidates, which the expression itself then verifies. A rule whose matches
need no trigram scans every text.

The index lives in the task that reads the texts, so nothing is shuffled or stored: a
scan with all rules reads the corpus once, as building a stored index would.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexipost.llm.arrow import gathered, map_batches

BATCH_CHARS = 4 << 20
_STRINGS = 64  # alternatives followed through one expression before it is cut
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` of a match must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII


#: The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        re.ASCII | re.IGNORECASE,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)

# A query is None (every text), a trigram, or ("and" | "or", queries).
Query = None | bytes | tuple


def _all(parts: Sequence[Query]) -> Query:
    kept = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not kept else kept[0] if len(kept) == 1 else ("and", tuple(kept))


def _any(parts: Sequence[Query]) -> Query:
    kept = list(dict.fromkeys(parts))
    return None if None in kept or not kept else kept[0] if len(kept) == 1 else ("or", tuple(kept))


def _of_string(text: str) -> Query:
    at = text.encode()
    return _all([at[i : i + 3] for i in range(len(at) - 2)])


def _strings(op: object, value: object) -> list[str] | None:
    """The strings that a node can match if they are few; None if they are not."""
    if op is parser.LITERAL:
        return [chr(value).lower()]
    if op is parser.IN:
        if any(kind is not parser.LITERAL for kind, _ in value) or len(value) > 8:
            return None
        return sorted({chr(code).lower() for _, code in value})
    if op is parser.SUBPATTERN:
        return _strings_of_all(value[-1])
    if op is parser.BRANCH:
        found = [_strings_of_all(branch) for branch in value[1]]
        return None if None in found else sorted({s for part in found for s in part})
    if op in (parser.MAX_REPEAT, parser.MIN_REPEAT) and value[1] <= 2:
        once = _strings_of_all(value[2])
        if once is None:
            return None
        return sorted(
            {"".join(p) for n in range(value[0], value[1] + 1) for p in product(once, repeat=n)}
        )
    return None


def _strings_of_all(nodes: Sequence) -> list[str] | None:
    sofar = [""]
    for op, value in nodes:
        more = _strings(op, value)
        if more is None or len(sofar) * len(more) > _STRINGS:
            return None
        sofar = sorted({a + b for a in sofar for b in more})
    return sofar


def _query_of_all(nodes: Sequence) -> Query:
    parts: list[Query] = []
    run = [""]

    def end_run() -> None:
        nonlocal run
        parts.append(_any([_of_string(s) for s in run]))
        run = [""]

    for op, value in nodes:
        more = _strings(op, value)
        if more is not None and len(run) * len(more) <= _STRINGS:
            run = sorted({a + b for a in run for b in more})
            continue
        end_run()
        if more is not None and len(more) <= _STRINGS:
            run = more
        elif op is parser.SUBPATTERN:
            parts.append(_query_of_all(value[-1]))
        elif op is parser.BRANCH:
            parts.append(_any([_query_of_all(branch) for branch in value[1]]))
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT) and value[0] >= 1:
            parts.append(_query_of_all(value[2]))
    end_run()
    return _all(parts)


def trigram_query(pattern: str) -> Query:
    """The trigrams, in lower case, that a text must hold for ``pattern`` to match."""
    return _query_of_all(parser.parse(pattern))


def _trigrams(query: Query) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


def _postings(texts: Sequence[bytes], trigrams: Sequence[bytes]) -> dict[bytes, np.ndarray]:
    """The ascending numbers of the texts that hold each trigram, A-Z lower-cased."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    joined = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    if len(joined) < 3 or not trigrams:
        return {t: np.empty(0, np.int64) for t in trigrams}
    wanted = np.zeros((3, 256), np.uint8)  # bytes that some trigram has at each place
    for t in trigrams:
        wanted[np.arange(3), list(t)] = 1
    at = np.flatnonzero(
        wanted[0][joined[:-2]] & wanted[1][joined[1:-1]] & wanted[2][joined[2:]]
    )
    code = (
        joined[at].astype(np.int32) << 16 | joined[at + 1].astype(np.int32) << 8 | joined[at + 2]
    )
    return {
        t: np.unique(np.searchsorted(ends, at[code == int.from_bytes(t)], "right"))
        for t in trigrams
    }


def _candidates(query: Query, postings: dict[bytes, np.ndarray], texts: int) -> np.ndarray:
    if query is None:
        return np.arange(texts)
    if isinstance(query, bytes):
        return postings[query]
    found = [_candidates(part, postings, texts) for part in query[1]]
    joined = found[0]
    for more in found[1:]:
        joined = (np.intersect1d if query[0] == "and" else np.union1d)(joined, more)
    return joined


def scanner(rules: Sequence[Rule]) -> Callable[[Sequence[str]], list[list[tuple[str, int, int]]]]:
    """A function that gives the spans of each text of a batch, by start, then rule."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    trigrams = sorted(set().union(*map(_trigrams, queries)))
    compiled = [re.compile(rule.pattern, rule.flags) for rule in rules]

    def scan(texts: Sequence[str]) -> list[list[tuple[str, int, int]]]:
        postings = _postings([t.encode("utf-8", "surrogatepass") for t in texts], trigrams)
        found: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
        for order, (rule, query, expression) in enumerate(
            zip(rules, queries, compiled, strict=True)
        ):
            for n in _candidates(query, postings, len(texts)).tolist():
                for m in expression.finditer(texts[n]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[n].append((m.start(), order, rule.kind, m.end()))
        return [[(kind, start, end) for start, _, kind, end in sorted(f)] for f in found]

    return scan


def find_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = BASE_RULES + MORE_RULES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row (key, spans) per row of ``docs``: spans of code points, end exclusive.

    Each rule finds leftmost matches that do not overlap one another; those of different
    rules may. Spans are ordered by start, then by the order of the rules. A null text is
    an empty one and has no spans. Repeated rows are scanned each; other columns are left
    out, whatever their names; an empty table gives no rows. A text is held whole in its
    task, whatever its length.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in gathered(batches, "_text", BATCH_CHARS):
            found = scan([t or "" for t in batch.column("_text").to_pylist()])
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found]
            span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(spans, pa.list_(span))], ["_key", "spans"]
            )

    kept = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    schema = f"_key {dict(kept.dtypes)['_key']}, spans {SPANS}"
    return map_batches(kept, work, schema).withColumnRenamed("_key", key)


def redacted(
    docs: DataFrame,
    mark: str,
    rules: Sequence[Rule] = BASE_RULES + MORE_RULES,
    text: str = "text",
    length: str | None = None,
) -> DataFrame:
    """``docs``, all columns, with every stretch of secrets in ``text`` replaced by ``mark``.

    A column ``length``, a bigint, gets the code points of the new text. Null texts stay.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in gathered(batches, text, BATCH_CHARS):
            given = batch.column(text).to_pylist()
            spans = scan([t or "" for t in given])
            new = [without(t, s, mark) for t, s in zip(given, spans, strict=True)]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns[text] = pa.array(new, pa.string())
            if length is not None:
                sizes = [None if t is None else len(t) for t in new]
                columns[length] = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return map_batches(docs, work, docs.schema)


def without(text: str | None, spans: Sequence[tuple[str, int, int]], mark: str) -> str | None:
    """``text`` with each stretch of spans replaced by ``mark``."""
    if text is None or not spans:
        return text
    out: list[str] = []
    at = 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
