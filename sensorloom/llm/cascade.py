"""Quality rules as a short-circuit cascade.

Every rule is cheap or dear and rejects much or little.  Both are measured on a bounded sample of the rows, and the
rules then run in the order of rejections per second, each one only on what the rules before it have left.  The order
changes the time, never the verdict: a text is kept if no rule rejects it.

Some figures (words, symbols, repeated lines and windows) are returned for every row; rules that use them get them for
free, and the cascade decides about the rest.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: Words numbered below this fit three to a 64-bit number.
PACKED = 1 << 21


@dataclass
class Facts:
    """A text and what is known of it; the dear parts are made when first asked for."""

    text: str
    words: list[bytes] = field(init=False)
    n_symbols: int = field(init=False)
    n_dup_lines: int = field(init=False)
    n_repeat_words: int = field(init=False)

    def __post_init__(self) -> None:
        # bytes.split() cuts at the six ASCII white spaces and nothing else
        self.words = self.text.encode("utf-8", "surrogatepass").split()
        self.n_symbols = sum(map(self.text.count, SYMBOLS))
        self.n_dup_lines = duplicate_lines(self.text)
        self.n_repeat_words = repeated_words(self.words)

    @property
    def n_words(self) -> int:
        return len(self.words)

    @property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @property
    def n_lines(self) -> int:
        return self.text.count("\n") + 1


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[str] = set()
    n = 0
    for line in lines:
        if line.strip(SPACES):
            n += line in seen
            seen.add(line)
    return n


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) < PACKED:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        pairs = np.unique(np.stack([ids[:-2], ids[1:-1]]), axis=1, return_inverse=True)[1].ravel()
        windows = pairs * np.int64(len(numbers)) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(len(words), bool)
    starts = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        hit[starts + k] = True
    return int(hit.sum())


@dataclass(frozen=True)
class Rule:
    """``rejects`` says of a text's facts whether the text goes."""

    name: str
    rejects: Callable[[Facts], bool]


_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SMALL = re.compile(r"[a-zß-öø-ÿ]")
_LETTER = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]")
_SENTENCE = re.compile(r"[.!?]")

RULES = (
    Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("repeated_lines", lambda f: 10 * f.n_dup_lines > 6 * f.n_lines),
    Rule("word_length", lambda f: f.word_chars > 20 * f.n_words or f.word_chars < 2 * f.n_words),
    Rule("shouting", lambda f: len(_CAPITALS.findall(f.text)) > len(_SMALL.findall(f.text))),
    Rule("exclamations", lambda f: 5 * f.text.count("!") > f.n_words),
    Rule("no_sentences", lambda f: not _SENTENCE.search(f.text)),
    Rule("few_letters", lambda f: 2 * len(_LETTER.findall(f.text)) < f.word_chars),
)


def base_failed(f: Facts) -> bool:
    return f.n_words < 50 or 100 * f.n_repeat_words > 50 * f.n_words


def measured_order(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int) -> list[str]:
    """Names of the rules by rejections per second on about ``sample_rows`` rows; at equal yield the cheaper first.

    The rows are those whose id's hash falls into one of n / sample_rows classes, so the sample is the same in each
    run.  Tasks measure; the driver sees one line per rule.
    """
    classes = max(1, docs.count() // max(1, sample_rows))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(classes)) == 0).limit(2 * sample_rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {rule.name: [0, 1e-9] for rule in rules}
        for batch in batches:
            facts = [f for t in batch.column("text") if not base_failed(f := Facts(t.as_py() or ""))]
            for rule in rules:
                began = time.perf_counter()
                total[rule.name][0] += sum(map(rule.rejects, facts))
                total[rule.name][1] += time.perf_counter() - began
        names = list(total)
        yield pa.RecordBatch.from_pydict({"rule": names, "rejected": [total[n][0] for n in names], "cost": [total[n][1] for n in names]})

    found = sample.mapInArrow(measure, "rule string, rejected long, cost double").groupBy("rule").agg(F.sum("rejected"), F.sum("cost"))
    measured = {name: (rejected, cost) for name, rejected, cost in found.collect()}
    return sorted((r.name for r in rules), key=lambda n: (-measured[n][0] / measured[n][1], measured[n][1], n) if n in measured else (0, 0, n))


def screen(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = 400,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: the figures, ``base_failed``, ``kept`` and ``rejected_by`` (the first rule in force, null if kept).

    ``sample_rows`` is the size of the sample from which the order comes; only the order depends on it.  Null and empty texts
    have no words and fail the base; an empty table gives an empty one; no row depends on another.
    """
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    order = measured_order(texts, rules, sample_rows)
    ranked = sorted(rules, key=lambda r: order.index(r.name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                f = Facts(t.as_py() or "")
                base = base_failed(f)
                by = "base" if base else next((r.name for r in ranked if r.rejects(f)), None)
                rows.append((f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, base, by is None, by))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", *(f.name for f in schema.fields[1:])],
            )

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType)])
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("base_failed", T.BooleanType()).add("kept", T.BooleanType()).add("rejected_by", T.StringType())
    return texts.mapInArrow(run, schema)
