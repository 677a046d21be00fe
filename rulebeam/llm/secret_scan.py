"""Secret scans with one automaton for all rules.

The rules are compiled into one minimal deterministic automaton (``automaton.build``) that reads
a text from its end: the one pass over its bytes marks every place where a match of some rule
begins. From the leftmost such place of a kind the rule's own small automaton is followed to the
longest end; the next match of that kind begins after it. So matches are leftmost, longest and
non-overlapping per kind, as with a regular-expression library; for the rules here longest and
greedy are the same, because after each part the next byte decides alone.

A rule has a head, a tail and the least length of its tail; shorter matches are
found, use up their text, and are then dropped. The hex rule counts its 32 characters in the automaton instead: a run of
hex characters matches as a whole, so this drops the same runs and keeps every
letter from a to f out of the list of places.

Base kinds are assign, access and hex. The method adds github, slack, jwt and private_key, the published forms
of such credentials.

Defined results: null and empty texts have no spans; repeated rows and null doc_ids are scanned row by
row; extra columns pass by unread; an empty table gives an empty table. Offsets
are code points, the end exclusive. Texts are read whole, in windows of 4 MB.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import automaton
from .common import read_table, text_slices


class Rule(NamedTuple):
    kind: str
    head: str
    tail: str
    least: int = 1   # bytes of the tail
    either: bool = False  # letters of the head in either case


# The base rules of the task, and public forms of credentials.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=\-]+", 8, True),
    Rule("access", "AKIA", "[A-Z0-9]+", 12),
    Rule("hex", "", "[0-9a-f]{32,}", 32),
)
ADDED = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]\-", r"[A-Za-z0-9\-]+", 10),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.", r"[A-Za-z0-9_\-]+", 1),
    Rule("private_key", r"\-\-\-\-\-BEGIN\x20", r"([A-Z0-9]+\x20)*PRIVATE\x20KEY\-\-\-\-\-", 1),
)
RULES = BASE + ADDED


class Scanner:
    """The compiled rules: ``first`` marks where matches begin, ``whole`` and ``heads`` measure them."""

    def __init__(self, rules=RULES):
        self.rules = tuple(rules)
        if len({r.kind for r in self.rules}) < len(self.rules):
            raise ValueError("each kind has one rule")
        signs = ["(?i)" if r.either else "" for r in self.rules]
        patterns = [s + r.head + r.tail for s, r in zip(signs, self.rules)]
        self.first = automaton.build(patterns, backwards=True, anywhere=True)
        self.whole = [automaton.build([p]) for p in patterns]
        self.heads = [automaton.build([s + r.head]) for s, r in zip(signs, self.rules)]
        self._rows = [(m.rows(), m.masks.tolist(), m.start) for m in self.whole]
        self._head_rows = [(m.rows(), m.masks.tolist(), m.start) for m in self.heads]

    def starts(self, data: np.ndarray, offsets: np.ndarray):
        """Ascending byte positions in ``data`` where a match begins, with the mask of rules."""
        n = len(offsets) - 1
        # One break before each text keeps matches inside it.
        buffer = np.full(len(data) + n, self.first.break_code, np.uint8)
        where = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
        buffer[where] = self.first.codes[data]
        places, masks = [], []
        for at, mask in automaton.scan(self.first, buffer, backwards=True):
            places.append(at)
            masks.append(mask)
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, mask = np.concatenate(places)[::-1], np.concatenate(masks)[::-1]
        # A break ends at the start state, which no rule accepts, so every place is a byte of a text.
        text = np.searchsorted(offsets[:-1] + np.arange(n), at, side="right") - 1
        return at - text - 1, mask

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, int, int]]]:
        """Per text its spans (kind, start, end) by start, then order of rules."""
        out: list[list] = [[] for _ in range(len(offsets) - 1)]
        at, mask = self.starts(data, offsets)
        text = np.searchsorted(offsets, at, side="right") - 1
        for t in np.unique(text).tolist():
            lo, hi = int(offsets[t]), int(offsets[t + 1])
            raw = data[lo:hi]
            body = raw.tobytes()
            mine = text == t
            found = []
            for i, rule in enumerate(self.rules):
                free = 0
                for start in (at[mine][(mask[mine] >> i) & 1 == 1] - lo).tolist():
                    if start < free:
                        continue
                    end = _longest(self._rows[i], body, start)
                    head = _longest(self._head_rows[i], body, start)
                    free = end
                    if end - head >= rule.least:
                        found.append((start, i, end))
            found.sort()
            signs = np.cumsum((raw & 0xC0) != 0x80)
            out[t] = [(self.rules[i].kind, int(signs[s]) - 1, int(signs[e - 1])) for s, i, e in found]
        return out


def _longest(machine, body: bytes, start: int) -> int:
    """Where the longest match from ``start`` ends (``start`` itself without a byte)."""
    rows, masks, state = machine
    end = at = start
    n = len(body)
    while at < n:
        state = rows[state][body[at]]
        if state < 0:
            break
        at += 1
        if masks[state]:
            end = at
    return end


def scan_secrets(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) of each row of ``docs``; spans: array of (kind, start, end)."""
    scanner = Scanner(rules)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for part, data, offs in text_slices(batches, "text"):
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in scanner.spans(data, offs)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(kind))], names=["key", "spans"])

    cols = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    out = cols.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, spans array<struct<kind:string,start:long,end:long>>")
    return out.select(F.col("key").alias(key), "spans")


def _joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of ``documents``."""
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("doc_id").cast("long").alias("doc_id"), *[count(r.kind) for r in BASE],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op11_sql() -> str:
    """The same from regular expressions: matches and the pieces between them give the places."""
    def rule_sql(i: int, rule: Rule) -> str:
        head = rule.head
        if rule.either:  # ASCII letters only: (?i) would add the long s and the Kelvin sign
            head = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() and head[j - 1] != "\\" else c
                           for j, c in enumerate(head))
        sql = lambda s: s.replace("'", "''")
        whole = sql(f"(?:{head})(?:{rule.tail})")
        cut = f"length(regexp_replace(m, '^(?:{sql(head)})', ''))" if head else "length(m)"
        return f"""
  SELECT r, {i} AS k, '{rule.kind}' AS kind, s, s + length(m) AS e FROM (
    SELECT r, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda j:
             list_sum(list_transform(ps[1:j], lambda p: length(p)))
             + coalesce(list_sum(list_transform(ms[1:j - 1], lambda p: length(p))), 0))) AS s
    FROM (SELECT r, regexp_extract_all(text, '{whole}') AS ms, string_split_regex(text, '{whole}') AS ps FROM d))
  WHERE {cut} >= {rule.least}"""
    found = "\n  UNION ALL".join(rule_sql(i, rule) for i, rule in enumerate(RULES))
    counts = ", ".join(f"CAST(count(k) FILTER (kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE)
    token = "concat_ws(':', kind, CAST(CAST(s AS BIGINT) AS VARCHAR), CAST(CAST(e AS BIGINT) AS VARCHAR))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({found})
SELECT d.doc_id, {counts},
       sha256(coalesce(string_agg({token}, ',' ORDER BY s, k) FILTER (k < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg({token}, ',' ORDER BY s, k) FILTER (k IS NOT NULL), '') AS spans
FROM d LEFT JOIN m USING (r) GROUP BY d.r, d.doc_id
"""
