"""Counts over one text that quality rules and labellers share. Words are runs of anything but ASCII white space."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .hashing import lean

WINDOW = 5
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_digits", "n_lines", "n_ends")


def repeat_words(words: list[bytes]) -> int:
    """Words inside windows of five that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for at, w in enumerate(windows):
        before = first.setdefault(w, at)
        if before != at:
            covered[at : at + WINDOW] = covered[before : before + WINDOW] = b"\1" * WINDOW
    return sum(covered)


def text_stats(text: str | None) -> tuple[int, ...]:
    """The values of STATS; zeros for a null text."""
    if not text:
        return (0,) * len(STATS)
    raw = text.encode()
    words = raw.split()
    chars = len(b"".join(words).decode())
    seen, dup, lines, ends = set(), 0, 0, 0
    for line in raw.split(b"\n"):
        if bare := line.strip():
            lines += 1
            ends += bare[-1:] in b".!?"
            dup += line in seen
            seen.add(line)
    return (len(words), chars, sum(map(text.count, SYMBOLS)), dup, repeat_words(words), len(set(words)), sum(map(text.count, "0123456789")), lines, ends)


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of keep and STATS, one row per document, computed where the document is read."""
    rows = docs.select(*keep, "text")
    schema = rows.select(*keep).schema

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [text_stats(x.as_py()) for x in batch.column(len(keep))]
            columns = zip(*got, strict=True) if got else [()] * len(STATS)
            arrays = [*batch.columns[: len(keep)], *(pa.array(x, pa.int64()) for x in columns)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *STATS])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), *(f"{x} long" for x in STATS)])
    return rows.mapInArrow(run, ddl)
