"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, whole_text

#: Documents that the costs and rejections of the rules are measured on.
SAMPLE_ROWS = 1_000
SAMPLE_SEED = 9
WINDOW_WORDS = 8
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_STEPS = np.random.default_rng(8).integers(1, 1 << 63, WINDOW_WORDS, dtype=np.uint64) | np.uint64(1)


class Measures:
    """Measures of one text (UTF-8), each worked out when a rule first asks for it."""

    def __init__(self, text: bytes) -> None:
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_bytes(self) -> bytes:
        return self.text.translate(None, _BLANKS)

    @cached_property
    def word_chars(self) -> int:
        data = self.word_bytes
        return len(data) if data.isascii() else len(data.decode("utf-8"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, _SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines that have a word."""
        return [line for line in self.text.split(b"\n") if line.strip(_BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words covered by runs of eight words that the text has twice or more.

        Runs are compared by a hash of their words' hashes first; only runs that
        share one are compared word by word.
        """
        n = self.n_words - WINDOW_WORDS + 1
        if n < 2:
            return 0
        hashes = np.fromiter(map(hash, self.words), np.int64, self.n_words).view(np.uint64)
        runs = hashes[:n] * _STEPS[0]
        for k in range(1, WINDOW_WORDS):
            runs += hashes[k : k + n] * _STEPS[k]
        order = np.argsort(runs, kind="stable")
        ranked = runs[order]
        same = ranked[1:] == ranked[:-1]
        if not same.any():
            return 0
        in_group = np.zeros(n, bool)
        in_group[1:] |= same
        in_group[:-1] |= same
        firsts: dict[tuple[bytes, ...], int] = {}
        covered = np.zeros(self.n_words + 1, np.int64)
        for at in np.sort(order[in_group]).tolist():
            run = tuple(self.words[at : at + WINDOW_WORDS])
            first = firsts.setdefault(run, at)
            if first != at:
                for start in (first, at):
                    covered[start] += 1
                    covered[start + WINDOW_WORDS] -= 1
        return int((np.cumsum(covered)[:-1] > 0).sum())


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``rejects`` is true of its measures."""

    name: str
    rejects: Callable[[Measures], bool]


def few_words(m: Measures) -> bool:
    return m.n_words < 20


def repeated_runs(m: Measures) -> bool:
    return 100 * m.n_repeat_words > 30 * m.n_words


def many_symbols(m: Measures) -> bool:
    return 100 * m.n_symbols > 10 * m.word_chars


def repeated_lines(m: Measures) -> bool:
    return 2 * m.n_dup_lines > len(m.lines)


def odd_word_length(m: Measures) -> bool:
    return not 2 * m.n_words <= m.word_chars <= 20 * m.n_words


BASE_RULES = (Rule("few_words", few_words), Rule("repeated_runs", repeated_runs))
RULES = (
    *BASE_RULES,
    Rule("many_symbols", many_symbols),
    Rule("repeated_lines", repeated_lines),
    Rule("odd_word_length", odd_word_length),
)


def order_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules by rejections per second of work, best first.

    Each rule is timed alone on some ``sample_rows`` documents drawn at random, each in the
    task that reads it: no text moves, and only the sums per rule reach the driver. The
    order changes the cost of the cascade, never its verdicts.
    """
    names = [r.name for r in rules]

    def work(texts: pa.Array) -> list[pa.Array]:
        costs, rejected = [], []
        for text in texts:
            data = text.as_py()
            row, hits = [], []
            for rule in rules:
                fresh = Measures(data)
                began = time.perf_counter()
                hits.append(bool(rule.rejects(fresh)))
                row.append(time.perf_counter() - began)
            costs.append(row)
            rejected.append(hits)
        return [pa.array(costs, pa.list_(pa.float64())), pa.array(rejected, pa.list_(pa.bool_()))]

    texts = docs.select(whole_text(f"`{text_col}`").alias("text"))
    rows = docs.count()
    sample = texts.sample(sample_rows / rows, SAMPLE_SEED) if rows > sample_rows else texts
    seen = map_texts(sample, work, {"costs": "array<double>", "rejected": "array<boolean>"})
    sums = seen.select(
        *[F.sum(F.element_at("costs", k + 1)).alias(f"cost_{k}") for k in range(len(names))],
        *[F.count_if(F.element_at("rejected", k + 1)).alias(f"hits_{k}") for k in range(len(names))],
    ).first()
    worth = {
        rule.name: (sums[f"hits_{k}"] or 0) / max(sums[f"cost_{k}"] or 0.0, 1e-9) for k, rule in enumerate(rules)
    }
    return sorted(rules, key=lambda rule: -worth[rule.name])


def judge_documents(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    measures: Sequence[str] = (),
    text_col: str = "text",
    keep_text: bool = False,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Verdict of the cascade: ``doc`` (the row as a struct), ``kept``, ``base_failed``
    and the integer ``measures`` asked for (names of :class:`Measures`).

    Rules run in the order of :func:`order_rules` and stop at the first that
    rejects; measures are worked out once per text and only when needed.
    ``base_failed`` is given with measures only, else null. No shuffle apart from
    the sample.

    Defined cases: null and empty texts have no words and fail. Repeated rows are
    judged each, alike. Null ids and other columns are carried. Empty tables give
    an empty result. Very long texts are measured whole, in time n log n.
    """
    ordered = order_rules(docs, rules, text_col, sample_rows)
    base = [r for r in ordered if r.name in {b.name for b in BASE_RULES}]

    def work(texts: pa.Array) -> list[pa.Array]:
        kept, failed, found = [], [], {name: [] for name in measures}
        for text in texts:
            m = Measures(text.as_py())
            kept.append(not any(rule.rejects(m) for rule in ordered))
            failed.append(any(rule.rejects(m) for rule in base) if measures else None)
            for name, values in found.items():
                values.append(getattr(m, name))
        return [
            pa.array(kept, pa.bool_()),
            pa.array(failed, pa.bool_()),
            *[pa.array(v, pa.int64()) for v in found.values()],
        ]

    fields = {"kept": "boolean", "base_failed": "boolean", **dict.fromkeys(measures, "long")}
    return map_texts(docs, work, fields, text_col, keep_text)
